"""Byte-level BPE encoding and decoding with DuckDB recursive queries per partition.

``encode`` splits every text by the tokenizer's pattern. The different pre-tokens of a
batch become rows of a word's tokens (bytes at first) and the ranks of its pairs; a
recursive query contracts each word's leftmost pair of minimum rank and joins the two new
pairs beside it with the merge table, until no pair is left. A pre-token that is itself in
the vocabulary is that token. ``decode`` joins (document, position, token) rows with the
vocabulary and puts the bytes together with an ordered aggregate.

No text is compared with another or shuffled: each Python worker keeps an in-memory DuckDB
of one thread and bounded memory, holding the fixed vocabulary and one batch at a time.
Words that the worker has contracted before are looked up in a cache of bounded size.

Words over ``LONG`` bytes go through a keyed form of the query, which has a row per position,
keeps one state of it instead of every round's and contracts all non-overlapping repeats of the
minimum-rank pair in a round. That gives the same result: a merge only makes pairs of
higher rank, so the repeats are contracted next anyway.

Defined results: a NULL or empty text has no ids and decodes to no bytes. NULL ids and
repeated rows are kept as they come. ``decode`` gives every other column back as it is.
An id outside the vocabulary is an error.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laminar.llm.common import bounded_batches, worker_state

LONG = 64                      # bytes of a word
WORDS_PER_QUERY = 20_000
SQUARES = 20_000_000           # a query's rounds hold about 4 bytes per squared byte of its words
CACHE = 200_000                # words in each of two generations that a worker remembers
SHIFT = 1 << 32                # rank and position packed into one integer for the minimum

NONE = (1 << 31) - 1           # rank of a pair that does not merge
BEST = f"""
   pair AS (SELECT word, pos, tok, lead(tok) OVER w AS nxt, lead(pos) OVER w AS nxtpos
            FROM now WINDOW w AS (PARTITION BY word ORDER BY pos)),
   ranked AS (SELECT p.word, p.pos, p.nxtpos, m.id FROM pair p
              JOIN merges m ON m.pair = p.tok::BIGINT * {SHIFT} + p.nxt)"""
SHORT_SQL = f"""
WITH RECURSIVE step AS (
  SELECT word, toks, ranks, list_min(ranks) AS id FROM start
  UNION ALL (
   WITH best AS (SELECT *, list_position(ranks, id) AS i FROM step WHERE id < {NONE}),
   met AS (SELECT *, toks[i - 1]::BIGINT * {SHIFT} + id AS before, id::BIGINT * {SHIFT} + toks[i + 2] AS after FROM best),
   now AS (SELECT word, list_concat(toks[:i - 1], [met.id], toks[i + 2:]) AS toks,
           list_concat(ranks[:greatest(i - 2, 0)], CASE WHEN i > 1 THEN [coalesce(l.id, {NONE})] ELSE [] END,
                       CASE WHEN i + 1 < len(toks) THEN [coalesce(r.id, {NONE})] ELSE [] END, ranks[i + 2:]) AS ranks
           FROM met LEFT JOIN merges l ON l.pair = before LEFT JOIN merges r ON r.pair = after)
   SELECT word, toks, ranks, list_min(ranks) FROM now))
SELECT word, toks AS ids FROM step WHERE id IS NULL OR id = {NONE} ORDER BY word"""
LONG_SQL = f"""
WITH RECURSIVE step(word, pos, tok) USING KEY (word, pos) AS (
  SELECT word, pos, tok FROM start
  UNION (
   WITH now AS (SELECT * FROM recurring.step WHERE tok >= 0 AND word IN (SELECT word FROM step)), {BEST},
   hit AS (SELECT * FROM ranked QUALIFY id = min(id) OVER (PARTITION BY word)),
   linked AS (SELECT *, coalesce(lag(nxtpos) OVER (PARTITION BY word ORDER BY pos) = pos, false) AS joined FROM hit),
   runs AS (SELECT *, sum((NOT joined)::INT) OVER (PARTITION BY word ORDER BY pos) AS run FROM linked),
   taken AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY word, run ORDER BY pos) % 2 = 1)
   SELECT word, unnest([pos, nxtpos]), unnest([id, -1]) FROM taken))
SELECT word, list(tok ORDER BY pos) AS ids FROM step WHERE tok >= 0 GROUP BY word ORDER BY word"""
DECODE_SQL = """
SELECT doc, list(v.bytes ORDER BY t.pos) AS parts FROM tokens t JOIN vocab v ON v.id = t.id GROUP BY doc ORDER BY doc"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _connect():
    import duckdb
    # No file is ever written: a batch is bounded, and its query stays in memory.
    return duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "450MB", "temp_directory": ""})


class Contractor:
    """Ids of pre-tokens, through the recursive queries over one vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.db = _connect()
        pair = np.array(left, dtype=np.int64) * SHIFT + np.array(right, dtype=np.int64)
        merges = pa.table({"pair": pair, "id": pa.array(merged, pa.int32())})
        self.db.register("loaded", merges)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM loaded")
        self.db.unregister("loaded")
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.double = np.full((256, 256), NONE, dtype=np.int32)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.double[token[0], token[1]] = rank

    def _lists(self, words: list[bytes]) -> pa.Table:
        """The bytes of every word, and the ranks of their pairs."""
        ends = np.cumsum([0, *map(len, words)]).astype(np.int32)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        left = np.delete(np.arange(len(raw)), ends[1:] - 1)
        toks = pa.ListArray.from_arrays(ends, self.single[raw])
        ranks = pa.ListArray.from_arrays(ends - np.arange(len(ends), dtype=np.int32), self.double[raw[left], raw[left + 1]])
        return pa.table({"word": np.arange(len(words), dtype=np.int32), "toks": toks, "ranks": ranks})

    def _rows(self, words: list[bytes]) -> pa.Table:
        sizes = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        pos = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return pa.table({"word": word, "pos": pos, "tok": self.single[np.frombuffer(b"".join(words), dtype=np.uint8)]})

    def _run(self, start: pa.Table, sql: str) -> list[np.ndarray]:
        self.db.register("start", start)
        got = self.db.sql(sql).to_arrow_table()["ids"].combine_chunks()
        self.db.unregister("start")
        flat = got.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        edges = got.offsets.to_numpy()
        return np.split(flat, edges[1:-1] - edges[0])

    def ids(self, words: list[bytes]) -> list[np.ndarray]:
        out: list = [None] * len(words)
        short, long_ = [], []
        for i, w in enumerate(words):
            whole = self.ranks.get(w)
            if whole is not None:
                out[i] = np.array([whole], dtype="<u4")
            else:
                (short if len(w) <= LONG else long_).append(i)
        part, squares = [], 0
        for n, i in enumerate(short, 1):
            part.append(i)
            squares += len(words[i]) ** 2
            if n == len(short) or len(part) == WORDS_PER_QUERY or squares > SQUARES:
                for j, ids in zip(part, self._run(self._lists([words[j] for j in part]), SHORT_SQL)):
                    out[j] = ids
                part, squares = [], 0
        for i in long_:
            out[i] = self._run(self._rows([words[i]]), LONG_SQL)[0]
        return out


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids) per row; ids are little-endian unsigned 32-bit integers."""
    schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        import regex
        split = regex.compile(pattern).findall
        contractor = worker_state("contractor " + ranks_path, lambda: Contractor(read_ranks(ranks_path)))
        known, older = worker_state("contracted " + ranks_path, lambda: ({}, {}))
        for batch in bounded_batches(batches, 4 << 20):
            found = [split(t or "") for t in batch.column(1).to_pylist()]
            if len(known) > CACHE:                          # a full generation becomes the older one
                older.clear()
                older.update(known)
                known.clear()
            new = {w for words in found for w in words if w not in known}
            known.update([(w, older[w]) for w in new if w in older])
            new = [w for w in new if w not in known]
            known.update(zip(new, (x.tobytes() for x in contractor.ids([w.encode() for w in new]))))
            coded = [b"".join([known[w] for w in words]) for words in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(c) // 4 for c in coded], pa.int64()),
                                              pa.array(coded, pa.binary())], schema=schema)

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id bigint, n_tokens bigint, ids binary")


def vocabulary_db(ranks_path: str):
    ranks, db = read_ranks(ranks_path), _connect()
    db.register("loaded", pa.table({"id": pa.array(ranks.values(), pa.int32()),
                                    "bytes": pa.array(ranks.keys(), pa.binary())}))
    db.execute("CREATE TABLE vocab AS SELECT * FROM loaded")
    db.unregister("loaded")
    return db


def decode(coded: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The other columns of ``coded`` plus ``out_col``, the bytes of its ids."""
    others = [c for c in coded.columns if c != ids_col]
    schema = T.StructType([*coded.select(*others).schema.fields, T.StructField(out_col, T.BinaryType())])

    def run(batches):
        db = worker_state("vocabulary " + ranks_path, lambda: vocabulary_db(ranks_path))
        for batch in bounded_batches(batches, 4 << 20):
            ids = [np.frombuffer(x or b"", dtype="<u4") for x in batch.column(len(others)).to_pylist()]
            sizes = np.array([len(x) for x in ids])
            flat = np.concatenate([*ids, np.zeros(0, "<u4")]).astype(np.int32)
            db.register("tokens", pa.table({"doc": np.repeat(np.arange(len(ids), dtype=np.int32), sizes),
                                            "pos": np.arange(len(flat), dtype=np.int64), "id": flat}))
            got = db.sql(DECODE_SQL).to_arrow_table()
            db.unregister("tokens")
            texts = [b""] * len(ids)
            parts = got["parts"].combine_chunks()
            values, edges = parts.values, parts.offsets.to_numpy()
            if edges[-1] - edges[0] != len(flat):
                raise ValueError("an id is not in the vocabulary")
            at = np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset:] if len(values) else np.zeros(1, int)
            data = values.buffers()[2]
            for doc, lo, hi in zip(got["doc"].to_pylist(), edges, edges[1:]):
                texts[doc] = data[at[lo]:at[hi]].to_pybytes()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary())],
                                             names=[*others, out_col])

    return coded.select(*others, ids_col).mapInArrow(run, schema)
