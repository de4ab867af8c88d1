"""Filter interaction audit: what each filter removes in every order of applying them.

Five conditions fail a text: A to D look at the text alone, E at an equal text under a
smaller id anywhere in the table. Which of them a document fails is a mask of five bits,
and documents with the same mask behave alike under every order. So documents are first
reduced to mask cells per part (at most 32), and each cell is folded across the array of
the 120 orders: ``aggregate`` walks an order with the state "removed already", ``transform``
does so for every order, and the resulting 600 structs, weighted by the cell's counts, are
merged by elementwise sums.

Scale
- The text is looked at once and leaves the scan as a SHA-256 digest and four bits. Equal
  digests count as equal texts.
- Copies are counted before any key is a hot one: first per (digest, id, part), which spreads
  a large group of copies over all tasks, then per (digest, part, labels) with a map-side
  partial step. Only then does a window over a digest look for its smallest id, over rows
  that are at most as many as the digest's parts times the label classes.
- The labels are reduced to one row per id and written, so that the join has an exchange
  directly below each side and a hot id can be split.
- The fold runs on at most 32 cells of a part in one row; a part with a third of all documents
  is one row there as any other.

Defined results: a NULL text is empty, a NULL part is the empty string. A document without
an id, or without labels, loses nothing good or toxic; it fails no duplicate condition and is
no reason for another to fail it. Rows repeated with the same id and text have no smaller id
among them. An id whose label rows differ is good (toxic) if one of them says so. An empty
table has no parts, so no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laminar.llm.common import materialise, words

LETTERS = "ABCDE"
DUPLICATE = "E"               # decided by the table, not by the text
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
SYMBOLS = r"[#$%&*|]"

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def content_mask(text: Column) -> Column:
    """Bits of the conditions that look at one text (not NULL)."""
    def flag(letter: str, failing: Column) -> Column:
        return F.when(failing, F.lit(bit(letter))).otherwise(F.lit(0))

    def of_words(w: Column) -> Column:
        n = F.size(w)
        return flag("A", n < MIN_WORDS) + flag("B", 100 * F.size(F.array_distinct(w)) < MIN_DISTINCT_PERCENT * n)

    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    crowded = 100 * capitals.cast("bigint") > MAX_CAPITAL_PERCENT * F.length(text).cast("bigint")
    # The words are bound to a lambda's variable, so the text is split once.
    return (F.transform(F.array(words(text)), of_words).getItem(0)
            + flag("C", crowded) + flag("D", text.rlike(SYMBOLS)))


def mask_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               part_col: str = "source", mask: Callable[[Column], Column] = content_mask) -> DataFrame:
    """(part, mask, n, good, toxic): documents per failure mask."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    seen = docs.select(F.col(id_col).cast("bigint").alias("_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.sha2(text, 256).alias("_digest"), mask(text).alias("_mask"))
    rows = seen.groupBy("_digest", "_id", "part").agg(F.count(F.lit(1)).alias("_n"), F.max("_mask").alias("_mask"))
    marks = materialise(
        labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("_label_id")).agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("_good"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("_toxic")), "audit-labels")
    marked = rows.join(marks, F.col("_id") == F.col("_label_id"), "left").select(
        "_digest", "part", "_id", "_n", "_mask",
        *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("_good", "_toxic")])
    known = F.col("_id").isNotNull()
    classes = marked.groupBy("_digest", "part", "_good", "_toxic").agg(
        F.max("_mask").alias("_mask"), F.sum("_n").alias("_all"),
        F.sum(F.when(known, F.col("_n")).otherwise(F.lit(0))).alias("_known"),
        F.min(F.when(known, F.struct("_id", "_n"))).alias("_low"))
    smallest = F.min("_low._id").over(Window.partitionBy("_digest"))
    originals = F.when(F.col("_low._id") == smallest, F.col("_low._n")).otherwise(F.lit(0))
    split = classes.withColumn("_copies", F.col("_known") - originals)
    either = F.explode(F.array(
        F.struct(F.col("_mask").alias("mask"), (F.col("_all") - F.col("_copies")).alias("n")),
        F.struct((F.col("_mask") + bit(DUPLICATE)).alias("mask"), F.col("_copies").alias("n"))))
    cells = split.select("part", "_good", "_toxic", either.alias("c")).where("c.n > 0")
    return cells.groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum("c.n").alias("n"),
        F.sum(F.when(F.col("_good"), F.col("c.n")).otherwise(F.lit(0))).alias("good"),
        F.sum(F.when(F.col("_toxic"), F.col("c.n")).otherwise(F.lit(0))).alias("toxic"))


def _orders() -> list[str]:
    return ["".join(p) for p in permutations(LETTERS)]


def order_bits() -> Column:
    """Every order as an array of filter bits (a literal of 120 arrays of five)."""
    return F.array(*[F.array(*[F.lit(bit(c)) for c in o]) for o in _orders()])


def _zero_counts() -> list[Column]:
    return [F.lit(0).cast("bigint").alias(c) for c in COUNTS]


def fold_cell(cell: Column, orders: Column) -> Column:
    """One cell across all orders: an array of 600 structs of its weighted counts."""
    def where(cond: Column, value: Column) -> Column:
        return F.when(cond, value).otherwise(F.lit(0)).cast("bigint")

    def walk(state: Column, f: Column) -> Column:
        fails = cell["mask"].bitwiseAND(f) != 0
        gone, lost = state["gone"], fails & ~state["gone"]
        step = F.struct(
            where(~gone & ~fails, cell["n"]).alias("kept"), where(lost, cell["n"]).alias("removed"),
            where(fails & gone, cell["n"]).alias("redundant"), where(cell["mask"] == f, cell["n"]).alias("unique_fails"),
            where(lost, cell["good"]).alias("good_lost"), where(lost, cell["toxic"]).alias("toxic_lost"))
        return F.struct((gone | fails).alias("gone"), F.concat(state["steps"], F.array(step)).alias("steps"))

    # A slice of nothing: an empty array of the structs' type.
    none = F.slice(F.array(F.struct(*_zero_counts())), 1, 0)
    start = F.struct(F.lit(False).alias("gone"), none.alias("steps"))
    return F.flatten(F.transform(orders, lambda o: F.aggregate(o, start, walk, lambda s: s["steps"])))


def _added(x: Column, y: Column) -> Column:
    return F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """One row per part, order and step: the counts ``COUNTS`` and the filter's ``shapley``,
    its removals summed over all orders."""
    cells = mask_cells(docs, labels, id_col, text_col, part_col)
    names = _orders()
    per_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    zeros = F.array_repeat(F.struct(*_zero_counts()), len(names) * len(LETTERS))
    orders = order_bits()
    merged = F.aggregate("cells", zeros, lambda acc, cell: F.zip_with(acc, fold_cell(cell, orders), _added))
    # The filter of each of the 600 places, as the letters of all orders in one string.
    letters = F.lit("".join(names))
    steps = per_part.select("part", merged.alias("steps"))

    def removals(letter: str) -> Column:
        mine = F.array(*[F.lit(i) for i, c in enumerate("".join(names)) if c == letter])
        return F.aggregate(mine, F.lit(0).cast("bigint"), lambda s, i: s + F.get(F.col("steps"), i)["removed"])

    shares = F.array(*[removals(c) for c in LETTERS])
    out = steps.select("part", shares.alias("shares"), F.posexplode("steps").alias("at", "x"))
    step = F.pmod(F.col("at"), F.lit(len(LETTERS)))
    order = F.floor(F.col("at") / len(LETTERS)).cast("int")
    letter = F.substring(letters, F.col("at") + 1, F.lit(1))
    return out.select("part", F.get(F.array(*[F.lit(o) for o in names]), order).alias("filter_order"),
                      (step + 1).cast("int").alias("step"), *[F.col(f"x.{c}").alias(c) for c in COUNTS],
                      F.get("shares", F.ascii(letter) - ord("A")).alias("shapley"))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
worded AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS copy
  FROM docs),
marks AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
masked AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN copy THEN 16 ELSE 0 END AS mask
  FROM worded LEFT JOIN marks USING (doc_id)),
cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM masked GROUP BY 1, 2),
f(c, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT f1.c || f2.c || f3.c || f4.c || f5.c AS filter_order, [f1.b, f2.b, f3.b, f4.b, f5.b] AS bits
  FROM f f1 JOIN f f2 ON f2.c <> f1.c JOIN f f3 ON f3.c NOT IN (f1.c, f2.c)
  JOIN f f4 ON f4.c NOT IN (f1.c, f2.c, f3.c) JOIN f f5 ON f5.c NOT IN (f1.c, f2.c, f3.c, f4.c)),
steps AS (
  SELECT filter_order, s AS step, bits[s] AS b, coalesce(list_sum(bits[1:s - 1]), 0)::INTEGER AS before
  FROM orders, range(1, 6) r(s)),
counted AS (
  SELECT part, filter_order, step::INTEGER AS step, b,
         sum(CASE WHEN mask & (before + b) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & b <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & before <> 0 AND mask & b <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = b THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & b <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & b <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, b))::BIGINT AS shapley
FROM counted
"""
