"""SimHash near-duplicate detection by pigeonhole blocks.

A text's fingerprint is the bitwise majority of its shingles' XXH64 hashes. Two
fingerprints are linked if they differ in at most ``max_bits`` bits. The 64 bits are
split into ``max_bits + 2`` blocks: a linked pair agrees on at least two of them, so
joining on every pair of blocks finds every link (``C(5, 2) = 10`` tables of 25 or 26
key bits for three differing bits). Every candidate's Hamming distance is verified.

Scale
- Equal fingerprints are collapsed first by a map-side aggregate, so a group of exact
  copies is one fingerprint, whatever its size.
- A bucket of many different fingerprints (a large group of near copies) is dealt into
  chunks of about ``chunk`` fingerprints, and every pair of chunks is a group of its
  own: the work stays exact, and no task holds more than about two chunks of a bucket.
- A group returns a spanning forest of its links (fewer rows than members), not all pairs.
- Components come from large-star / small-star rounds over those edges; each round is
  written to the shared storage root.

Defined results: NULL and word-less texts have fingerprint zero, linked like any other.
A text of fewer words than a shingle is one shingle. NULL ids are kept as rows; a
component's id is its smallest non-NULL id (NULL if it has none). Repeated rows are
returned as often as they come. Other columns of the input are ignored.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import bounded_batches, materialise

SEED = 42                     # of XXH64
BITS = 64
HOT_SHARE = 1000              # a fingerprint with one row in so many is hot
CHUNK = 2048                  # fingerprints of a bucket that one side of a chunk pair holds


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Majority fingerprint of one text (UTF-8 bytes) as an unsigned 64-bit integer."""
    import xxhash
    found = (text or b"").lower().split()          # lower-cases A-Z only; splits on the word break
    if not found:
        return 0
    if len(found) < shingle:
        parts, n = [b" ".join(found)], 1
    else:
        n = len(found) - shingle + 1
        parts = map(b" ".join, zip(*(found[i:] for i in range(shingle))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 16):                # bounded scratch for very long texts
        lanes = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(lanes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > n, bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(id, text_hash, fp) per row; fp is the fingerprint as a signed BIGINT."""
    schema = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for batch in bounded_batches(batches):
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps)], schema=schema)

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_hash(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(run, "id bigint, text_hash bigint, fp bigint")


def text_hash(text: Column) -> Column:
    """Tells different texts under one id apart."""
    return F.xxhash64(text)


def block_keys(fp: Column, max_bits: int) -> Column:
    """The pigeonhole tables of a fingerprint: (table, key) per pair of blocks."""
    n = max_bits + 2
    edges = [BITS * i // n for i in range(n + 1)]
    spans = list(zip(edges, edges[1:]))
    keys = []
    for table, (a, b) in enumerate(combinations(spans, 2)):
        mask = sum(1 << bit for lo, hi in (a, b) for bit in range(lo, hi))
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(table).alias("table"), fp.bitwiseAND(F.lit(signed)).alias("key")))
    return F.array(*keys)


def spanning_links(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, root) that connect what links of at most ``max_bits`` connect."""
    left = np.unique(fps)
    member, root = [], []
    while len(left) > 1:
        start, left = left[0], left[1:]
        frontier = [start]
        while frontier and len(left):
            near = np.bitwise_count(left ^ frontier.pop()) <= max_bits
            if near.any():
                got, left = left[near], left[~near]
                member.append(got)
                root.append(np.full(len(got), start))
                frontier.extend(got)
    none = np.zeros(0, dtype=fps.dtype)
    return (np.concatenate(member), np.concatenate(root)) if member else (none, none)


def links(distinct: DataFrame, max_bits: int = 3, chunk: int = CHUNK) -> DataFrame:
    """Edges (u, v) between fingerprints whose connected components are those of all
    links of at most ``max_bits`` differing bits. ``distinct`` has one row per ``fp``."""
    buckets = (distinct.select("fp", F.explode(block_keys(F.col("fp"), max_bits)).alias("b"))
               .select("fp", "b.table", "b.key"))
    sizes = buckets.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / chunk).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = (buckets.join(sizes, ["table", "key"])
             .withColumn("parts", parts).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("table", "key", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j"), "fp"))
    group = ["table", "key", "i", "j"]
    ordered = dealt.repartition(*group).sortWithinPartitions(*group)
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        held = None                                 # the last group may go on in the next batch
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(5)], axis=1)
            rows = rows if held is None else np.concatenate([held, rows])
            starts = np.flatnonzero(np.r_[True, (rows[1:, :4] != rows[:-1, :4]).any(axis=1)])
            yield from forest(rows[:starts[-1]], starts[:-1])
            held = rows[starts[-1]:]
        if held is not None:
            yield from forest(held, np.array([0]))

    def forest(rows, starts):
        us, vs = [], []
        for lo, hi in zip(starts, np.r_[starts[1:], len(rows)]):
            u, v = spanning_links(np.ascontiguousarray(rows[lo:hi, 4]).view(np.uint64), max_bits)
            us.append(u)
            vs.append(v)
        if us and sum(map(len, us)):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)],
                                             schema=schema)

    return ordered.mapInArrow(run, "u bigint, v bigint").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the component's smallest node.

    Alternating large-star and small-star rounds until the edges no longer change. Every
    round is an aggregate and a join over the remaining edges, written to shared storage.
    """
    def stars(e: DataFrame, large: bool) -> DataFrame:
        if large:
            sides = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            sides = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = sides.join(least, "u")
        if large:
            out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = materialise(edges.where("u <> v").select("u", "v"), label)
    before = None
    while True:
        now = materialise(stars(stars(now, True), False), label)
        after = mark(now)
        if after == before or after[0] == 0:
            break
        before = after
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 3, chunk: int = CHUNK) -> DataFrame:
    """(id, text_hash, fp, component_id, root) per row of ``docs``; ``root`` tells components apart
    that share their smallest id (an id may have several texts)."""
    marked = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash-fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    roots = components(links(distinct, max_bits, chunk), "simhash-components")
    linked = distinct.join(roots, F.col("fp") == F.col("node"))
    # Unlinked fingerprints are their own component; linked ones take the least id of the root's.
    by_root = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_linked = linked.join(by_root, "root").select("fp", "component_id", "root")
    of_all = (distinct.join(of_linked, "fp", "left")
              .select("fp", F.coalesce("component_id", "first_id").alias("component_id"),
                      F.coalesce("root", "fp").alias("root"), "copies"))
    of_all = materialise(of_all, "simhash-labels")
    # A fingerprint with a thousandth of all rows or more (at most 1,000 of them) meets its rows where
    # they are; only the others are shuffled.
    often = F.col("copies") * HOT_SHARE >= marked.count()
    hot, rest = (of_all.where(x).drop("copies") for x in (often, ~often))
    labelled = (marked.join(F.broadcast(hot), "fp").unionByName(
        marked.join(F.broadcast(hot.select("fp")), "fp", "left_anti").join(rest, "fp")))
    return labelled.select("id", "text_hash", "fp", "component_id", "root")
