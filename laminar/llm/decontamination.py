"""Benchmark decontamination: a prefix-filtered join of benchmark windows with documents.

A window is ten consecutive words of a benchmark item (an item of fewer words is one window).
A document contains a window if its words occur there in a row. Finding that is a set join
with containment one:

1. Shingles (three words, or the window's words if it has fewer) of all windows are ordered
   by rarity: their number of occurrences in all documents, counted in one pass.
2. For containment ``t`` of a window of ``m`` shingles a join needs the ``m - ceil(t * m) + 1``
   rarest of them, its prefix; for ``t = 1`` that is one. A window with a shingle that no
   document has is dropped here.
3. Documents' shingles join the prefix shingles. The shingle's offset in the window places
   the window in the document: the place must not begin before the text (positional bound)
   nor end after it (length bound).
4. The words at the place must be the window's words, compared as text. The join key is a
   hash; this comparison makes the result exact.

Scale
- A document's shingles are exploded and joined inside the task that read it. The words
  stay in place: only the words at a found place are cut out. What is shuffled are found
  places and one row per document, keyed by the row, so no passage or item is a hot key.
- The window side is the benchmark. It is broadcast in blocks of at most ``block`` windows,
  each a pass over the documents, so its size is bounded however large the benchmark. With
  more than one block the documents are written once with their row numbers.
- Which items a window belongs to is looked up by a broadcast only if that table has at
  most ``block`` rows, else by a join whose window side is salted.

Defined results: a NULL or word-less text has no words and no hits; a NULL or word-less item
has no windows. An item without an id marks words but is not counted or listed. Items that
share an id are one. Overlapping windows count a word once. Repeated document rows are
returned as often as they come. An empty benchmark leaves every document clean. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import materialise

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3
BLOCK = 200_000               # windows of one broadcast
SALTS = 16


def tokens(text: Column) -> Column:
    """Words of a text with A-Z lower-cased (empty for NULL)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # All of an ASCII text can be lower-cased; else only the letters A-Z are.
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(lowered, SEPARATOR), "")


def shingle_at(found: Column, i: Column, size: int) -> Column:
    """Hash of ``size`` words from place ``i`` (NULL past the end)."""
    key = F.xxhash64(F.lit(size), *[F.get(found, i + k) for k in range(size)])
    return F.when(i + size <= F.size(found), key)


def shingles(found: Column, sizes: list[int]) -> Column:
    """One hash per word and size: place ``p`` of the array is word ``p % n``."""
    def of(size: int) -> Column:
        return F.transform(found, lambda w, i: shingle_at(found, i, size))

    parts = [of(k) for k in sizes]
    return F.concat(*parts) if parts else F.array().cast("array<bigint>")


def each_shingle(hashes: Column) -> Column:
    """The array to explode: a NULL, then the hashes. The optimizer adds a filter on the size of
    an exploded column and moves it below, where it would split the text again; it does not for
    an expression."""
    return F.concat(F.array(F.lit(None).cast("bigint")), hashes)


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, words): every window of every item."""
    found = items.select(F.col(id_col).cast("string").alias("item"), tokens(F.col(text_col)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = F.transform(starts, lambda i: F.slice("w", i, window))
    return found.where(F.size("w") > 0).select("item", F.explode(cut).alias("words"))


def rarest_shingles(windows: DataFrame, docs: DataFrame, block: int) -> DataFrame:
    """The prefix of each window ``(window, words)``: (window, key, offset, length, text).

    ``docs`` is one array of shingle hashes per row.
    """
    size = F.least(F.size("words"), F.lit(SHINGLE))
    own = F.filter(F.transform("words", lambda w, i: F.struct(
        reduce(lambda rest, k: F.when(size == k, shingle_at(F.col("words"), i, k)).otherwise(rest),
               range(1, SHINGLE + 1), F.lit(None).cast("bigint")).alias("key"), i.alias("offset"))),
        lambda s: s["key"].isNotNull())
    listed = windows.select("window", F.size("words").alias("length"), F.array_join("words", " ").alias("text"),
                            F.explode(own).alias("s"))
    listed = listed.select("window", "length", "text", "s.key", "s.offset")
    wanted = materialise(listed.select("key").distinct(), "decontamination-shingles")
    counts = None
    for part in blocks(wanted, "key", block):
        seen = docs.select(F.explode(each_shingle(F.col("hashes"))).alias("key")).join(F.broadcast(part), "key").groupBy("key").agg(
            F.count(F.lit(1)).alias("n"))
        counts = seen if counts is None else counts.unionByName(seen)
    counts = materialise(counts, "decontamination-counts")
    ranked = listed.join(counts, "key", "left").select(
        "window", "length", "text", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "offset").alias("s"))
    rarest = ranked.groupBy("window", "length", "text").agg(F.min("s").alias("s")).where("s.n > 0")
    return rarest.select("window", "s.key", "s.offset", "length", "text")


def blocks(table: DataFrame, column: str, size: int) -> list[DataFrame]:
    """``table`` (written) in parts of about ``size`` rows at most, dealt by a hash of ``column``."""
    n = max(1, -(-table.count() // size))
    if n == 1:
        return [table]
    return [table.where(F.pmod(F.xxhash64(F.lit("block"), column), F.lit(n)) == i) for i in range(n)]


def places(docs: DataFrame, prefix: DataFrame, first: bool) -> DataFrame:
    """Places of ``prefix`` windows in ``docs`` (row, id, words, hashes): (row, id, n, start,
    length, window). With ``first`` every document has one more row, without a window."""
    opened = docs.select("row", "id", "words", F.size("words").alias("n"),
                         F.posexplode(each_shingle(F.col("hashes"))).alias("p", "key"))
    joined = opened.join(F.broadcast(prefix), "key", "left" if first else "inner")
    start = F.pmod(F.col("p") - 1, F.greatest(F.col("n"), F.lit(1))) - F.col("offset")
    bounded = F.col("window").isNotNull() & (start >= 0) & (start + F.col("length") <= F.col("n"))
    # A place out of bounds is not cut out: ``when`` keeps slice() from seeing it.
    equal = F.when(bounded, F.array_join(F.slice("words", start + 1, F.col("length")), " ") == F.col("text"))
    found = F.coalesce(equal, F.lit(False))
    keep = found | (F.col("p") == 0) if first else found
    return joined.where(keep).select("row", "id", "n", start.alias("start"), "length", "window")


def covered(spans: Column) -> Column:
    """Words inside any of the (start, length) spans."""
    zero = F.lit(0).cast("bigint")

    def add(s, x):
        end = (x["start"] + x["length"]).cast("bigint")
        new = F.greatest(end - F.greatest(s["end"], x["start"].cast("bigint")), zero)
        return F.struct((s["total"] + new).alias("total"), F.greatest(s["end"], end).alias("end"))

    return F.aggregate(F.array_sort(spans), F.struct(zero.alias("total"), zero.alias("end")), add, lambda s: s["total"])


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block: int = BLOCK) -> DataFrame:
    """Per document row: (id, n_words, n_hit, items, contaminated); ``items`` are the ids of
    the items with a window in the document, sorted as strings."""
    windows = materialise(item_windows(items, item_col, item_text, window), "decontamination-items")
    distinct = materialise(windows.select("words").distinct().select(
        F.monotonically_increasing_id().alias("window"), "words"), "decontamination-windows")
    member = materialise(windows.where("item IS NOT NULL").join(distinct, "words").select("window", "item").distinct(),
                         "decontamination-members")
    size = F.least(F.size("words"), F.lit(SHINGLE)).alias("k")
    sizes = sorted(r["k"] for r in distinct.select(size).distinct().collect())          # three rows at most

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       F.col(text_col).cast("string").alias("text"))
    if distinct.count() > block:
        rows = materialise(rows, "decontamination-docs")
    opened = rows.select("row", "id", tokens(F.col("text")).alias("words"))
    opened = opened.select("row", "id", "words", shingles(F.col("words"), sizes).alias("hashes"))
    prefix = materialise(rarest_shingles(distinct, opened.select("hashes"), block), "decontamination-prefix")
    found = None
    for i, part in enumerate(blocks(prefix, "window", block)):
        some = places(opened, part, first=i == 0)
        found = some if found is None else found.unionByName(some)
    found = materialise(found, "decontamination-places")

    span = F.when(F.col("window").isNotNull(), F.struct("start", "length"))
    per_row = found.groupBy("row").agg(F.max("id").alias("id"), F.max("n").cast("bigint").alias("n_words"),
                                       F.collect_set(span).alias("spans"))
    here = found.where("window IS NOT NULL").select("row", "window").distinct()
    if member.count() <= block:
        named = here.join(F.broadcast(member), "window")
    else:
        salt = F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("salt")
        each = member.select("*", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(SALTS)])).alias("salt"))
        named = here.select("*", salt).join(each, ["window", "salt"])
    listed = named.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = per_row.join(listed, "row", "left")
    hit = covered(F.col("spans"))
    return out.select("id", "n_words", hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      (hit > 0).alias("contaminated"))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, w[i:i + 9] AS words
  FROM items, range(1, greatest(len(w) - 9, 1) + 1) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(words) AS k FROM windows),
spans AS (
  SELECT r, i, k, w[i:i + k - 1] AS words
  FROM docs, sizes, range(1, len(w) - k + 2) t(i)),
places AS (
  SELECT DISTINCT r, i, k, item_id FROM spans JOIN windows USING (words)),
hits AS (
  SELECT r, count(DISTINCT j) AS n_hit FROM places, range(i, i + k) t(j) GROUP BY 1),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM places WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""
