"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from laminar.functions.parsing import lenient_date, lenient_timestamp, resolve_run_date, run_date_literal
from laminar.functions.rules import (
    REFERENCE_CATEGORY_RULES, SCALE_CATEGORY_RULES, keyword_classifier, status_is_active, user_level,
)
from laminar.functions.rounding import half_up_ratio
from laminar.functions.masking import hash_email, mask_phone

__all__ = [
    "lenient_date", "lenient_timestamp", "resolve_run_date", "run_date_literal",
    "REFERENCE_CATEGORY_RULES", "SCALE_CATEGORY_RULES", "keyword_classifier", "status_is_active",
    "user_level", "half_up_ratio", "hash_email", "mask_phone",
]
