"""Approximate nearest neighbours by multiprobe p-stable hashing.

Unit vectors are projected on Gaussian directions; ``hashes`` quantised projections make
a bucket, ``tables`` times. A query visits the ``probes`` buckets of each table with the
best estimated success: perturbations of one step per projection, ordered by the summed
squared distance from the query to the crossed boundaries (generated in that order from
a heap, so nothing of size 3^hashes is built). The candidates of all tables are reranked
by exact cosine on the original vectors in double precision.

Scale
- Equal vectors are one entry with their ``top + 1`` smallest ids: more can never be among
  a query's results. So a vector that a third of the rows share is one entry.
- The index side is dealt by (table, bucket, chunk) and the queries by (table, bucket,
  chunk, block): a hot bucket becomes many groups of at most about ``chunk`` entries and
  ``block`` queries, every entry against every query, so no candidate is dropped.
- A group returns each query's best ``top + 1`` entries, not its candidate pairs; the
  lists of all buckets and tables are merged per query.
- A query that finds fewer than ``top + 1`` ids in its buckets (an outlier, or a small table)
  is compared with every entry, in chunks and blocks of the same size.

The hash family depends on the dimension and the seed alone, so nothing is fitted, and
every row is indexed. The number of probes is a parameter; the tests measure recall
against brute force.

Defined results: rows with a NULL id, or a vector that is NULL, zero, of another length
than the most frequent one, or holds a NULL or non-finite component take no part.
Repeated rows count once. A query's own id is never among its results; queries get all
candidates if there are fewer than ``top``. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import materialise

SEED = 20


class Family:
    """``tables`` hash functions of ``hashes`` quantised Gaussian projections."""

    def __init__(self, dim: int, tables: int, hashes: int, width: float, seed: int = SEED):
        rng = np.random.default_rng(seed)
        # Scaled so that the projection of a unit vector has the same spread in any dimension.
        self.lines = rng.standard_normal((tables, dim, hashes))
        self.shift = rng.random((tables, hashes)) * width
        self.width, self.dim, self.hashes = width, dim, hashes
        self.mix = rng.integers(1, 1 << 62, hashes, dtype=np.int64) | 1

    def places(self, unit: np.ndarray, table: int) -> np.ndarray:
        """Projections in units of a bucket's width."""
        return (unit @ self.lines[table] + self.shift[table]) / self.width

    def key(self, buckets: np.ndarray) -> np.ndarray:
        """One integer per bucket (wrapping multiply-add)."""
        with np.errstate(over="ignore"):
            return (buckets.astype(np.int64) * self.mix).sum(axis=-1)


def probe_buckets(place: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` buckets around ``place`` in order of estimated success."""
    base = np.floor(place).astype(np.int64)
    inside = place - base
    # One step down costs the distance to the lower boundary, one step up to the upper one.
    cost = np.concatenate([inside ** 2, (1 - inside) ** 2])
    axis = np.tile(np.arange(len(base)), 2)
    move = np.repeat([-1, 1], len(base))
    order = np.argsort(cost, kind="stable")
    cost, axis, move = cost[order], axis[order], move[order]
    out, heap = [base], [(cost[0], (0,))]
    while heap and len(out) < probes:
        score, chosen = heapq.heappop(heap)
        if len(set(axis[list(chosen)])) == len(chosen):     # not both ways on one axis
            step = base.copy()
            step[axis[list(chosen)]] += move[list(chosen)]
            out.append(step)
        last = chosen[-1]
        if last + 1 < len(cost):                             # shift the last step, or add one
            heapq.heappush(heap, (score - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (score + cost[last + 1], (*chosen, last + 1)))
    return np.array(out)


def entries(vectors: DataFrame, id_col: str, vector_col: str, top: int) -> DataFrame:
    """(gid, vec, ids): one row per different usable vector with its smallest ids."""
    usable = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    usable = usable.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
    usable = usable.where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                          & F.exists("vec", lambda x: x != 0.0))
    sizes = usable.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    common = sizes.orderBy(F.desc("rows"), "n").limit(1).first()
    dim = common["n"] if common else 0
    usable = usable.where(F.size("vec") == dim).distinct()
    from pyspark.sql import Window
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = usable.withColumn("nth", nth).where(F.col("nth") <= top + 1)
    return few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(
        F.element_at("ids", 1).alias("gid"), "vec", "ids")


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    raw = flat.reshape(len(column), -1)
    # Scaled first, so that the square of a large component stays finite.
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw, scaled / np.sqrt((scaled ** 2).sum(axis=1, keepdims=True))


def search(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", top: int = 5,
           tables: int = 2, hashes: int = 7, width: float = 3.0, probes: int = 128, chunk: int = 8192,
           block: int = 4096) -> DataFrame:
    """(query_id, rank, id, score): the nearest found of every query row.

    ``is_query`` is a condition on the id column's values, given as a function of a column.
    """
    spark = vectors.sparkSession
    index = materialise(entries(vectors, id_col, vector_col, top), "ann-entries")
    asked = vectors.select(F.col(id_col).cast("bigint").alias("query_id"), F.col(vector_col).cast("array<double>").alias("vec"))
    asked = asked.where(is_query(F.col("query_id"))).distinct()
    asked = materialise(asked.join(index.select("gid", "vec"), "vec").select("query_id", "gid"), "ann-queries")
    first = index.select(F.size("vec").alias("n")).limit(1).first()
    if first is None:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score double")
    dim, keep = first["n"], top + 1
    family = Family(dim, tables, hashes, width)

    def place(as_query: bool):
        schema = pa.schema([("tab", pa.int32()), ("key", pa.int64()), ("gid", pa.int64()), ("vec", pa.list_(pa.float64()))])

        def run(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    gid, vec = part.column(0), part.column(1)
                    _, unit = _units(vec)
                    for t in range(tables):
                        where = family.places(unit, t)
                        if as_query:
                            near = [family.key(probe_buckets(p, probes)) for p in where]
                            rows = np.repeat(np.arange(len(near)), [len(k) for k in near])
                            keys = np.concatenate(near)
                        else:
                            rows, keys = np.arange(len(where)), family.key(np.floor(where))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), t, dtype=np.int32)), pa.array(keys),
                             gid.take(pa.array(rows)), vec.take(pa.array(rows))], schema=schema)

        return run

    layout = "tab int, key bigint, gid bigint, vec array<double>"
    # Entries by gid and vector; each group's salt comes from the size of its bucket.
    held = index.select("gid", "vec").mapInArrow(place(False), layout)
    sizes = held.groupBy("tab", "key").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    wanted = asked.select("gid").distinct().join(index.select("gid", "vec"), "gid").mapInArrow(place(True), layout)
    demand = wanted.groupBy("tab", "key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    deal = materialise(sizes.join(demand, ["tab", "key"]), "ann-buckets")
    salt = F.xxhash64("gid")
    left = (held.join(deal, ["tab", "key"]).withColumn("chunk", F.pmod(salt, F.col("chunks")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    right = (wanted.join(deal, ["tab", "key"]).withColumn("block", F.pmod(salt, F.col("blocks")).cast("int"))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
    group = ["tab", "key", "chunk", "block"]
    both = (left.select(*group, F.lit(0).alias("side"), "gid", "vec")
            .unionByName(right.select(*group, F.lit(1).alias("side"), "gid", "vec")))

    def dealt(rows):
        return rows.repartition(*group).sortWithinPartitions(*group, "side")

    schema = pa.schema([("query", pa.int64()), ("entry", pa.int64()), ("score", pa.float64())])

    def rerank(batches):
        held = None                                          # the last group may go on
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            marks = np.stack([held.column(c).to_numpy() for c in group], axis=1)
            starts = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(axis=1)])
            yield from groups(held.slice(0, starts[-1]), starts)
            held = held.slice(starts[-1])
        if held is not None:
            yield from groups(held, np.array([0, held.num_rows]))

    def groups(rows, starts):
        if rows.num_rows == 0:
            return
        rows = rows.combine_chunks()
        raw, unit = _units(rows.column("vec").combine_chunks())
        side, gids = rows.column("side").to_numpy(), rows.column("gid").to_numpy()
        found = [[], [], []]
        for lo, hi in zip(starts, starts[1:]):
            cut = lo + int(np.searchsorted(side[lo:hi], 1))
            if lo == cut or cut == hi:
                continue
            for at in range(cut, hi, 512):
                to = min(at + 512, hi)
                near = unit[at:to] @ unit[lo:cut].T
                k = min(keep, cut - lo)
                best = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < cut - lo else np.tile(np.arange(k), (to - at, 1))
                # Entries that tie with the last kept one, up to rounding, stay as well.
                last = np.take_along_axis(near, best, axis=1).min(axis=1) - 1e-9
                q, e = np.nonzero(near >= last[:, None])
                found[0].append(gids[at + q])
                found[1].append(gids[lo + e])
                found[2].append(exact_cosine(raw[at + q], raw[lo + e]))
        if found[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(f)) for f in found], schema=schema)

    layout = "query bigint, entry bigint, score double"
    merged = materialise(best_entries(dealt(both).mapInArrow(rerank, layout), keep), "ann-merged")
    ids = index.select(F.col("gid").alias("entry"), F.size("ids").alias("n"))
    found = merged.join(ids, "entry").groupBy("query").agg(F.sum("n").alias("n"))
    short = asked.select("gid").distinct().join(found, F.col("gid") == F.col("query"), "left")
    short = materialise(short.where(F.coalesce("n", F.lit(0)) < keep).select("gid"), "ann-short")
    n_short = short.count()
    if n_short:
        chunks, blocks = -(-index.count() // chunk), -(-n_short // block)
        every = index.select(F.lit(-1).alias("tab"), F.lit(0).cast("bigint").alias("key"), "gid", "vec",
                             F.pmod(salt, F.lit(chunks)).cast("int").alias("chunk"),
                             F.pmod(salt, F.lit(blocks)).cast("int").alias("block"))
        left = every.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        right = every.join(short, "gid").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        both = (left.select(*group, F.lit(0).alias("side"), "gid", "vec")
                .unionByName(right.select(*group, F.lit(1).alias("side"), "gid", "vec")))
        exact = dealt(both).mapInArrow(rerank, layout)
        merged = materialise(best_entries(merged.unionByName(exact.select(*merged.columns)), keep), "ann-merged")
    ids = merged.join(index.select(F.col("gid").alias("entry"), "ids"), "entry").select(
        "query", "score", F.explode("ids").alias("id"))
    nearest = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "id"))), 1, keep)
    per_vector = ids.groupBy("query").agg(nearest.alias("list"))
    answers = asked.join(per_vector, F.col("gid") == F.col("query")).select(
        "query_id", F.slice(F.filter("list", lambda x: x["id"] != F.col("query_id")), 1, top).alias("list"))
    return answers.select("query_id", F.posexplode("list").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("id"), (-F.col("x.far")).alias("score"))


def best_entries(scored: DataFrame, keep: int) -> DataFrame:
    """Merge the tables' lists: each query's ``keep`` best different entries."""
    once = scored.groupBy("query", "entry").agg(F.max("score").alias("score"))
    from pyspark.sql import Window
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "entry"))
    return once.withColumn("nth", nth).where(F.col("nth") <= keep).drop("nth")


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of row pairs in double precision, on vectors scaled by their largest component."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
