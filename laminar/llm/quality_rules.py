"""Quality rules: hashed n-gram log-likelihood ratio with a fixed threshold.

Unigrams and bigrams of words are hashed into ``buckets``. Two smoothed multinomials
are estimated over them: the trusted target (documents labelled good) and the raw
corpus (every document). A document's score is the mean over its n-grams of
``log p_target - log p_raw``; it is kept if the score reaches the threshold and the
base rules pass. The threshold is a low quantile of the trusted documents' scores, so
the decision is the same for every run and every document.

All of it is DataFrame expressions. A text is split once; windows, n-grams and sums are
array expressions inside the row, so no word is shuffled. Both counts are one
aggregate whose state is ``buckets`` rows, combined before the shuffle. What reaches the
driver is the ``buckets`` weights and, for the threshold, counts per bin and at most
``IN_BIN`` scores (``quantile_of``).

The trusted set is every document labelled good, the raw corpus every document; the
threshold is read off the scores of all trusted documents. The trusted ids are written once.
Up to ``broadcast_ids`` of them meet the documents as a broadcast; more are shuffled by id
and hashed per partition beside the texts, which are not sorted.

Defined results: a NULL or word-less text has zero counts, score zero, and fails the
base rules. NULL ids are judged like others but are never trusted. An id whose label
rows disagree is not trusted. Without labels every weight is zero and the base rules
alone decide. Repeated rows are counted and returned as often as they come. Columns
other than the id and the text are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import WORD_BREAK, materialise, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5                    # words of a repeated window
MIN_WORDS = 10
REPEAT_PERCENT = 20


@dataclass(frozen=True)
class Model:
    """Weights per bucket and the threshold, both bounded by ``buckets``."""
    buckets: int
    weights: tuple[float, ...]
    threshold: float


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it.

    A lambda's variable cannot be inlined by the optimizer, as a column's expression can
    when a filter moves below a projection.
    """
    return F.transform(F.array(value), use).getItem(0)


def repeated_words(hashes: Column) -> Column:
    """Words inside ``WINDOW``-word windows that occur at least twice in the text.

    ``hashes`` holds one hash per word. Windows are sorted as (hash, position); those
    equal to a neighbour are repeated, and the union of their spans is summed from the
    sorted positions. Texts without a repeated window skip the sort.
    """
    def at(i):
        return F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])

    zero = F.lit(0).cast("bigint")
    windows = F.when(F.size(hashes) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW), at)).otherwise(
        F.array().cast("array<bigint>"))

    def spans(places):
        return F.transform(places, lambda x, k: F.least(F.coalesce(F.get(places, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))

    def places(ranked):
        twins = F.filter(ranked, lambda x, k: (F.get(ranked, k - 1)["h"] == x["h"]) | (F.get(ranked, k + 1)["h"] == x["h"]))
        return F.array_sort(F.transform(twins, lambda x: x["i"]))

    def covered(w):
        ranked = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        total = F.aggregate(bind(bind(ranked, places), spans), zero, lambda s, x: s + x)
        return F.when(F.size(F.array_distinct(w)) == F.size(w), zero).otherwise(total)

    return bind(windows, covered)


def hashed_words(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def base_measures(text: Column, hashes: Column) -> list[Column]:
    """The base measures of a text (not NULL) and its word hashes."""
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    n = F.size(hashes).cast("bigint")
    return [n.alias("n_words"),
            F.length(F.regexp_replace(text, WORD_BREAK, "")).cast("bigint").alias("word_chars"),
            F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
            bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
            repeated_words(hashes).alias("n_repeat_words")]


def ngram_buckets(hashes: Column, buckets: int) -> Column:
    """Buckets of all word unigrams and bigrams of a text."""
    one = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    two = F.transform(hashes, lambda h, i: F.when(
        i + 1 < F.size(hashes), F.pmod(F.xxhash64(h, F.get(hashes, i + 1)), F.lit(buckets)).cast("int")))
    return F.array_compact(F.concat(one, two))


def trusted_ids(labels: DataFrame, label_bound: int | None = None) -> DataFrame:
    """Ids labelled good: all of them (as ``fit`` takes them), or with a ``label_bound`` at
    most about that many (a hash decides which)."""
    good = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
            .agg(F.min("quality").alias("q")).where("q = 1").select("doc_id"))
    if label_bound is None:
        return good
    n = good.count()
    if n <= label_bound:
        return good
    share = int(0.95 * label_bound / n * (1 << 30))
    return good.where(F.pmod(F.xxhash64(F.lit("trusted"), "doc_id"), F.lit(1 << 30)) < share)


BINS = 4096                   # bins that a round of ``ranked`` counts
IN_BIN = 10000                # values that are few enough to be sorted at once


def ranked(values: DataFrame, column: str, rank: int) -> float:
    """The value at ``rank`` (from 0) of a column of finite doubles, exactly.

    Each round counts the values per bin and goes on with the bin that holds the rank, so
    neither a task nor the driver sees more than ``BINS`` counts or ``IN_BIN`` values.
    """
    v = F.col(column)
    low, high, n = values.agg(F.min(v), F.max(v), F.count(v)).first()
    while low < high and n > IN_BIN:
        at = F.least(F.floor((v - F.lit(low)) / F.lit(high - low) * BINS), F.lit(BINS - 1))
        bins = (values.where(v.between(low, high)).groupBy(at.alias("at"))
                .agg(F.min(v).alias("low"), F.max(v).alias("high"), F.count(v).alias("n")).collect())
        for r in sorted(bins, key=lambda r: r["at"]):
            if rank < r["n"]:
                break
            rank -= r["n"]
        low, high, n = r["low"], r["high"], r["n"]
    return low if low == high else sorted(x[0] for x in values.where(v.between(low, high)).select(v).collect())[rank]


def quantile_of(values: DataFrame, column: str, share: float) -> float | None:
    """The exact quantile, interpolated as ``percentile`` does; None without values."""
    n = values.count()
    if n == 0:
        return None
    at = (n - 1) * share
    below, above = math.floor(at), math.ceil(at)
    x = ranked(values, column, below)
    y = x if above == below else ranked(values, column, above)
    return x if x == y else (above - at) * x + (at - below) * y


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        buckets: int = 16384, quantile: float = 0.002, alpha: float = 1.0, broadcast_ids: int = 1 << 20) -> Model:
    """Count both multinomials over all documents, then place the threshold."""
    trusted = materialise(trusted_ids(labels).select(F.col("doc_id").cast("bigint").alias("_t")), "trusted-ids")
    trusted = F.broadcast(trusted) if trusted.count() <= broadcast_ids else trusted.hint("shuffle_hash")
    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    hashes = hashed_words(F.col("_text"))
    counts = (texts.join(trusted, F.col("_id") == F.col("_t"), "left")
              .select(F.col("_t").isNotNull().alias("good"), F.explode(bind(hashes, lambda h: ngram_buckets(h, buckets))).alias("b"))
              .groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.count_if("good").alias("target")).collect())
    raw, target = [0] * buckets, [0] * buckets
    for r in counts:                                  # at most ``buckets`` rows
        raw[r["b"]], target[r["b"]] = r["raw"], r["target"]
    n_raw, n_target = sum(raw) + alpha * buckets, sum(target) + alpha * buckets
    none = sum(target) == 0
    weights = tuple(0.0 if none else math.log((t + alpha) / n_target) - math.log((r + alpha) / n_raw)
                    for t, r in zip(target, raw))
    model = Model(buckets, weights, float("-inf"))
    if none:
        return Model(buckets, weights, 0.0)
    scored = texts.join(trusted, F.col("_id") == F.col("_t")).select(bind(hashes, lambda h: F.when(
        F.size(h) >= MIN_WORDS, mean_ratio(h, model))).alias("s"))
    scores = materialise(scored, "trusted-scores").where("s IS NOT NULL")      # filtered here: a score is computed once
    low = quantile_of(scores, "s", quantile)
    return Model(buckets, weights, 0.0 if low is None else min(0.0, low))


def mean_ratio(hashes: Column, model: Model) -> Column:
    """Length-normalised log-likelihood ratio of a text's n-grams."""
    weights = F.split(F.lit(",".join(map(repr, model.weights))), ",").cast("array<double>")
    found = ngram_buckets(hashes, model.buckets)
    total = F.aggregate(found, F.lit(0.0), lambda s, b: s + F.get(weights, b))
    n = 2 * F.size(hashes) - 1
    return F.when(F.size(hashes) > 0, total / n).otherwise(F.lit(0.0))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def judge(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus the columns ``MEASURES``."""
    clash = set(MEASURES) & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made by judge")

    def verdict(m):
        failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"])
        kept = ~failed & (m["score"] >= F.lit(model.threshold))
        return F.struct(*[m[c].alias(c) for c in MEASURES if c not in ("base_failed", "kept")],
                        failed.alias("base_failed"), kept.alias("kept"))

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    measured = bind(hashed_words(text), lambda h: F.struct(*base_measures(text, h), mean_ratio(h, model).alias("score")))
    return docs.withColumn("_m", bind(measured, verdict)).select(*docs.columns, *[F.col(f"_m.{c}").alias(c) for c in MEASURES])
