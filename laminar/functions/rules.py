"""Rule-based classifiers expressed as chained CASE WHEN expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Product-name keyword -> category id, first match wins, else OTHER.
# Keywords are the warehouse's own: 手机 (phone), 电脑 (computer), 服装 (clothing).
REFERENCE_CATEGORY_RULES: tuple[tuple[str, str], ...] = (
    ("手机", "PHONE"),
    ("电脑", "COMPUTER"),
    ("服装", "CLOTHING"),
)
DEFAULT_CATEGORY = "OTHER"

# The same categories bound to the English part names of the driver tables
# (the Chinese keywords never occur there).
SCALE_CATEGORY_RULES: tuple[tuple[str, str], ...] = (
    ("widget", "PHONE"),
    ("gear", "COMPUTER"),
    ("ring", "CLOTHING"),
)


def keyword_classifier(c: Column | str, rules: Sequence[tuple[str, str]],
                       default: str = DEFAULT_CATEGORY) -> Column:
    """First rule whose keyword occurs in the text wins; NULL text -> default."""
    col = F.col(c) if isinstance(c, str) else c
    if not rules:
        return F.lit(default)
    expr = None
    for keyword, label in rules:
        cond = col.contains(keyword)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def status_is_active(status: Column | str) -> Column:
    """``status == 'active'``; every other value, including NULL, is False."""
    col = F.col(status) if isinstance(status, str) else status
    return F.when(col == "active", True).otherwise(False)


# Status -> user level (case-sensitive), else Regular.
USER_LEVELS: tuple[tuple[str, str], ...] = (("vip", "VIP"), ("premium", "Premium"))
DEFAULT_USER_LEVEL = "Regular"


def user_level(status: Column | str) -> Column:
    col = F.col(status) if isinstance(status, str) else status
    expr = None
    for value, label in USER_LEVELS:
        expr = F.when(col == value, label) if expr is None else expr.when(col == value, label)
    return expr.otherwise(DEFAULT_USER_LEVEL)
