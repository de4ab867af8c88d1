"""Language-model scoring: causal self-attention over subword ids, trained in numpy.

Texts become ids of a public subword vocabulary, then an end id. The model predicts the
next id in two steps, p(id | past) = p(class | past) p(id | class):

- Classes are clusters of ids by the ids that stand next to them, from the corpus-wide
  counts of adjacent pairs; the most frequent ids have classes of their own. Similar
  classes share a block.
- p(id | class) is the smoothed share of the id in its class, from the same counts.
- p(class | past) = p(block | past) p(class | block, past), each a softmax over the class
  bigram statistics of the last id plus the output of a causal self-attention layer over
  the window (queries, keys and values per class, a learned bias per distance). Its
  weights are trained by gradient steps. Two small softmaxes cost a tenth of one large one.

Windows overlap: each holds ``stride`` positions to predict and ``overlap`` positions of
context before them, so every id is scored once. Windows are scored in batches; a mask
hides later positions and the padding before a text's start.

Only training rows (CRC-32 of the id's decimal text, modulo 10, not 0) give counts and
gradients, and all of them do: every id of a training text is a target of one step.
Training is data-parallel: in each of ``rounds`` rounds every task makes steps over its
own share of windows (each window has one round), starting from the same weights, and an
aggregate averages the results by the number of windows behind them.

Scale: ids are made once and written; every later pass reads that table. What reaches the
driver is bounded by the vocabulary and the model: class statistics, pair counts with a
frequent id on one side, and the averaged weights. Word counts for the base score are
split by a share of the corpus: at most ``1 / heavy_share`` frequent words go to the tasks
as a dictionary, and all others are joined by word, none of which is hot.

Defined results: a NULL or empty text is the end alone. A NULL id counts as empty text for
the training split. Repeated rows count and are scored as often as they come. Without
training rows the model is uniform over the vocabulary. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import bounded_batches, forget, materialise, split_words
from laminar.llm.packing import word_encoder

VOCABULARY = 49408             # ids of the vocabulary, its two special ids included
START, END = 49406, 49407
ALPHA = 0.1                    # of the base score
BLOCKS, BLOCK = 16, 24         # classes are BLOCKS blocks of BLOCK
CLASSES = BLOCKS * BLOCK
SINGLE = 2 * BLOCK             # most frequent ids, one class each
CONTEXTS = 160                 # frequent ids whose pairs describe an id
DIM = 8
STRIDE, OVERLAP = 32, 8
BATCH = 512                    # windows per step
ATTENDED, SCORED = 128, 2048   # windows that are computed, and handed over, at once


def held_out(id_: Column) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 10 == 0


# ---------------------------------------------------------------- the model
@dataclass
class Model:
    cls: np.ndarray            # class per id
    log_share: np.ndarray      # log10 p(id | class)
    tables: tuple[np.ndarray, np.ndarray]   # p(block | last class); per block, p(class | block, last class)
    weights: np.ndarray        # flat: see unpack


def bigram_tables(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the blocks, and of the classes in their block, per last class."""
    blocks = counts.reshape(CLASSES, BLOCKS, BLOCK).sum(axis=2)
    inside = counts / np.repeat(np.maximum(blocks, 1e-30), BLOCK, axis=1)
    inside = np.ascontiguousarray(inside.reshape(CLASSES, BLOCKS, BLOCK).transpose(1, 0, 2), dtype=np.float32)
    return (blocks / blocks.sum(axis=1, keepdims=True)).astype(np.float32), inside


def unpack(weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Queries, keys, values (classes x dim), output to classes and to blocks (dim x ...), distance bias."""
    n = CLASSES * DIM
    q, k, v, u = (weights[i * n:(i + 1) * n] for i in range(4))
    top = weights[4 * n:4 * n + DIM * BLOCKS].reshape(DIM, BLOCKS)
    return q.reshape(CLASSES, DIM), k.reshape(CLASSES, DIM), v.reshape(CLASSES, DIM), u.reshape(DIM, CLASSES), top, weights[4 * n + top.size:]


def first_weights(seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    n = CLASSES * DIM
    parts = [rng.standard_normal(n) * 0.3 for _ in range(3)]
    out = [rng.standard_normal(m) * 0.05 for m in (n, DIM * BLOCKS)]
    return np.concatenate([*parts, *out, np.zeros(STRIDE + OVERLAP)]).astype(np.float32)


def windows(classes: list[np.ndarray], start_class: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of a batch of texts.

    Returns inputs (windows x length, -1 is padding), targets (windows x stride, -1 is
    none), the text of every window, and the window's number in its text. Position i of a
    text is predicted from the start class and the positions before it.
    """
    length = STRIDE + OVERLAP
    counts = [-(-len(c) // STRIDE) for c in classes]
    total = sum(counts) * STRIDE
    texts = np.repeat(np.arange(len(classes)), counts)
    inputs = np.full(total + OVERLAP * len(classes), -1, dtype=np.int32)
    targets = np.full(total, -1, dtype=np.int32)
    begins, at, to = [], 0, 0
    for c, n in zip(classes, counts):
        inputs[at + OVERLAP] = start_class
        inputs[at + OVERLAP + 1:at + OVERLAP + len(c)] = c[:-1]
        targets[to:to + len(c)] = c
        begins.append(at + STRIDE * np.arange(n))
        at += OVERLAP + n * STRIDE
        to += n * STRIDE
    begins = np.concatenate(begins) if begins else np.zeros(0, dtype=np.int64)
    numbers = np.concatenate([np.arange(n) for n in counts]) if counts else np.zeros(0, dtype=np.int64)
    return inputs[begins[:, None] + np.arange(length)], targets.reshape(-1, STRIDE), texts, numbers


# Distance from a query (rows) to a key (columns); negative ones lie ahead and are masked.
DISTANCE = (np.arange(STRIDE)[:, None] + OVERLAP) - np.arange(STRIDE + OVERLAP)[None, :]


def bounded(a: np.ndarray, b: np.ndarray, extra: float = 0.0) -> bool:
    """Whether products of rows of ``a`` and ``b`` are small enough to take exponentials of."""
    longest = (float(np.sqrt((x * x).sum(axis=1).max())) for x in (a, b))
    return np.prod(list(longest)) + extra < 60


def attention(parts: tuple[np.ndarray, ...]) -> tuple:
    """What ``attend`` needs of the weights: scaled queries, keys, values with a last column
    of ones, and the distance bias with whether exponentials are small enough to be taken as
    they are; then it is a factor."""
    q, k, v, _, _, bias = parts
    scaled, near = q * np.float32(DIM ** -0.5), np.maximum(DISTANCE, 0)
    small = bounded(scaled, k, float(np.abs(bias).max()))
    if small:
        shift = np.where(DISTANCE >= 0, np.exp(bias)[near], np.float32(0))
    else:
        shift = np.where(DISTANCE >= 0, bias[near], np.float32(-1e9))
    return scaled, k, np.concatenate([v, np.ones((len(v), 1), np.float32)], axis=1), shift, small


def attend(heads: tuple, inputs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Attention of the query positions ``at`` of every window: outputs, weights before their
    division by their sum, and that sum. The ones in the values give it with the outputs."""
    queries, keys, values, shift, small = heads
    shown = np.maximum(inputs, 0).astype(np.intp)
    last = shown[:, OVERLAP + at]
    qs, ks, vs = queries.take(last, axis=0), keys.take(shown, axis=0), values.take(shown, axis=0)
    scores = np.matmul(qs, ks.transpose(0, 2, 1))
    padded = np.flatnonzero(inputs[:, 0] < 0)               # padding stands before a text's first window only
    if small:
        np.exp(scores, out=scores)
        scores *= shift[at]
        scores[padded] *= (inputs[padded] >= 0)[:, None, :]
    else:
        scores += shift[at]
        scores[padded] += np.where(inputs[padded] < 0, np.float32(-1e9), np.float32(0))[:, None, :]
        scores -= scores.max(axis=2, keepdims=True)
        np.exp(scores, out=scores)
    sums = np.matmul(scores, vs)
    return sums[..., :DIM] / sums[..., DIM:], scores, sums[..., DIM], last, shown, qs, ks, vs


def by_block(targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, slice]]]:
    """Places of all targets in the order of their blocks, their blocks, their numbers in the
    block, and (block, its rows of that order)."""
    places = np.flatnonzero(targets >= 0)
    goal = targets.ravel()[places]
    blocks = goal // BLOCK
    order = np.argsort(blocks.astype(np.uint8), kind="stable")
    places, blocks, goal = places[order], blocks[order], goal[order]
    edges = np.searchsorted(blocks, np.arange(BLOCKS + 1)).tolist()
    return places, blocks, goal - blocks * BLOCK, [(b, slice(*e)) for b, e in enumerate(zip(edges, edges[1:])) if e[0] < e[1]]


def block_logits(out: np.ndarray, u: np.ndarray, parts: list[tuple[int, slice]]) -> np.ndarray:
    """Products of the rows with the classes of their own block."""
    logits = np.empty((len(out), BLOCK), dtype=np.float32)
    for b, rows in parts:
        np.matmul(out[rows], u[:, b * BLOCK:(b + 1) * BLOCK], out=logits[rows])
    return logits


def weigh(logits: np.ndarray, share: np.ndarray, small: bool) -> np.ndarray:
    """Puts ``share * exp(logits)`` into ``logits`` and returns its sums; ``small`` says that
    no exponential can overflow."""
    if not small:
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits *= share
    return logits @ np.ones(logits.shape[1], dtype=np.float32)


def softmax_logs(logits: np.ndarray, share: np.ndarray, goal: np.ndarray, small: bool) -> np.ndarray:
    """log of ``share * exp(logits)``, normalised, at ``goal``; changes ``logits``."""
    if not small:
        logits -= logits.max(axis=1, keepdims=True)
    cells = np.arange(0, logits.size, logits.shape[1]) + goal
    picked, of = logits.ravel()[cells], share.ravel()[cells]
    return picked + np.log(of / weigh(logits, share, True))


def small_logits(parts: tuple[np.ndarray, ...]) -> list[bool]:
    return [bounded(parts[2], u.T) for u in (parts[4], parts[3])]           # an output is a mean of value rows


def log_probabilities(parts: tuple[np.ndarray, ...], tables: tuple[np.ndarray, np.ndarray], inputs: np.ndarray,
                      targets: np.ndarray) -> np.ndarray:
    """Natural log p(class) of every target (0 where there is none)."""
    got = np.zeros(targets.shape, dtype=np.float64)
    heads, small, inner = attention(parts), small_logits(parts), tables[1].reshape(-1, BLOCK)
    for at in range(0, len(inputs), ATTENDED):
        out, _, _, last, *_ = attend(heads, inputs[at:at + ATTENDED], np.arange(STRIDE))
        places, blocks, goal, cuts = by_block(targets[at:at + ATTENDED])
        out, last = out.reshape(-1, DIM)[places], last.ravel()[places]
        logs = softmax_logs(out @ parts[4], tables[0].take(last, axis=0), blocks, small[0])
        logs += softmax_logs(block_logits(out, parts[3], cuts), inner.take(blocks * CLASSES + last, axis=0), goal, small[1])
        got[at:at + ATTENDED].reshape(-1)[places] = logs
    return got


def sums_by_class(classes: np.ndarray, grads: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``grads`` per class."""
    flat = classes.ravel().astype(np.int16)
    order = np.argsort(flat, kind="stable")
    sizes = np.bincount(flat, minlength=CLASSES)
    found = np.flatnonzero(sizes)
    out = np.zeros((CLASSES, grads.shape[-1]), dtype=np.float32)
    out[found] = np.add.reduceat(grads.reshape(len(flat), -1).take(order, axis=0), (np.cumsum(sizes) - sizes)[found], axis=0)
    return out


def gradient(weights: np.ndarray, tables: tuple[np.ndarray, np.ndarray], inputs: np.ndarray, targets: np.ndarray,
             at: np.ndarray) -> np.ndarray:
    """Gradient of the mean negative log-probability over the query positions ``at``."""
    parts = unpack(weights)
    heads, small = attention(parts), small_logits(parts)
    goals = targets[:, at]
    n = np.float32(max(1, (goals >= 0).sum()))
    return sum((_gradient(parts, heads, small, tables, inputs[i:i + ATTENDED], goals[i:i + ATTENDED], at, n)
                for i in range(0, len(inputs), ATTENDED)), np.zeros_like(weights))


def _gradient(parts: tuple[np.ndarray, ...], heads: tuple, small: list[bool], tables: tuple[np.ndarray, np.ndarray],
              inputs: np.ndarray, goals: np.ndarray, at: np.ndarray, n: np.float32) -> np.ndarray:
    """The share of these windows in the gradient of a mean over ``n`` targets."""
    u, top, bias = parts[3:]
    out, scores, total, last, shown, qs, ks, vs = attend(heads, inputs, at)
    places, blocks, goal, cuts = by_block(goals)
    rows_out, rows_last = out.reshape(-1, DIM)[places], last.ravel()[places]

    def error(p, share, g, fits):
        p *= (1 / (weigh(p, share, fits) * n))[:, None]
        p.reshape(-1)[np.arange(0, p.size, p.shape[1]) + g] -= 1 / n
        return p

    e = error(rows_out @ top, tables[0].take(rows_last, axis=0), blocks, small[0])
    d_top, d_rows, d_u = rows_out.T @ e, e @ top.T, np.zeros_like(u)
    share = tables[1].reshape(-1, BLOCK).take(blocks * CLASSES + rows_last, axis=0)
    e = error(block_logits(rows_out, u, cuts), share, goal, small[1])
    for b, rows in cuts:
        cut = slice(b * BLOCK, (b + 1) * BLOCK)
        d_u[:, cut] = rows_out[rows].T @ e[rows]
        d_rows[rows] += e[rows] @ u[:, cut].T
    # The last column takes the mean of the weights' gradients off, by the ones in vs.
    d_out = np.zeros((*last.shape, DIM + 1), dtype=np.float32)
    mean = (d_rows * rows_out) @ np.ones(DIM, dtype=np.float32)
    d_out.reshape(-1, DIM + 1)[places] = np.column_stack([d_rows, -mean]) / total.ravel()[places, None]
    d_s = np.matmul(d_out, vs.transpose(0, 2, 1))
    d_s *= scores
    dist = DISTANCE[at]
    ahead = dist >= 0
    d_bias = np.bincount(dist[ahead], weights=d_s.sum(axis=0)[ahead], minlength=len(bias))
    d_q = np.matmul(d_s, ks) * np.float32(DIM ** -0.5)
    d_kv = np.empty((*shown.shape, 2 * DIM), dtype=np.float32)
    d_kv[..., :DIM] = np.matmul(d_s.transpose(0, 2, 1), qs)          # the queries are scaled already
    d_kv[..., DIM:] = np.matmul(scores.transpose(0, 2, 1), d_out[..., :DIM])
    d_kv = sums_by_class(shown, d_kv)
    return np.concatenate([sums_by_class(last, d_q).ravel(), d_kv[:, :DIM].ravel(), d_kv[:, DIM:].ravel(), d_u.ravel(),
                           d_top.ravel(), d_bias]).astype(np.float32)


class Adam:
    def __init__(self, weights: np.ndarray, rate: float):
        self.w, self.rate, self.t = weights.copy(), rate, 0
        self.m, self.s = np.zeros_like(weights), np.zeros_like(weights)

    def step(self, g: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (g - self.m)
        self.s += 0.01 * (g * g - self.s)
        m, s = self.m / (1 - 0.9 ** self.t), self.s / (1 - 0.99 ** self.t)
        self.w -= self.rate * m / (np.sqrt(s) + 1e-8)


# ---------------------------------------------------------------- corpus passes
def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(row, id, held_out, text, ids) per document; ids are unsigned 16-bit and end with
    ``END``; ``row`` is unique. Beside it (word, c) over all training texts, A-Z lower-cased,
    without the end. Both are made in one pass and written: the words of a batch follow its
    documents, with their number in ``c``, and are added up after it."""
    fields = [("row", pa.int64()), ("id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.string()), ("ids", pa.binary()),
              ("c", pa.int64())]
    schema = pa.schema(fields)

    def run(batches):
        coder = None
        for batch in bounded_batches(batches, 4 << 20):
            coder = coder or word_encoder(vocabulary)
            if coder.full:
                coder.clear()
            words = split_words(batch.column(3))
            ids, sizes = coder.encode(words)
            ends = np.cumsum(sizes)
            ids = np.insert(ids.astype("<u2"), ends, END)
            places = np.concatenate([[0], 2 * (ends + np.arange(1, len(ends) + 1))])
            coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(places), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([*batch.columns, coded.cast(pa.binary()), pa.nulls(len(ends), pa.int64())], schema=schema)
            trained = np.repeat(~batch.column(2).to_numpy(zero_copy_only=False), words.sizes)
            n = np.bincount(words.which[trained], minlength=len(words.kinds))
            kinds = pc.ascii_lower(words.kinds.filter(pa.array(n > 0)))
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(kinds), t) for _, t in fields[:3]), kinds,
                                              pa.nulls(len(kinds), pa.binary()), pa.array(n[n > 0], pa.int64())], schema=schema)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"),
                       held_out(F.col(id_col)).alias("held_out"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    made = materialise(rows.mapInArrow(run, "row bigint, id bigint, held_out boolean, text string, ids binary, c bigint"),
                       "lm-encoded", compression="zstd")
    counts = made.where("c IS NOT NULL").groupBy(F.col("text").alias("word")).agg(F.sum("c").alias("c"))
    return made.where("c IS NULL").drop("c"), counts


def pair_counts(train: DataFrame) -> DataFrame:
    """(a, b, n): adjacent ids over all training rows; a text begins after ``START``."""
    schema = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])

    def run(batches):
        kept = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def send():
            pairs = pa.array((kept[0] >> 16).astype(np.int32)), pa.array((kept[0] & 0xFFFF).astype(np.int32))
            return pa.RecordBatch.from_arrays([*pairs, pa.array(kept[1])], schema=schema)

        for batch in bounded_batches(batches, 8 << 20):
            texts = [np.frombuffer(x, dtype="<u2").astype(np.int64) for x in batch.column(0).to_pylist()]
            pairs = np.concatenate([(np.r_[START, t[:-1]] << 16) | t for t in texts])
            new, n = np.unique(pairs, return_counts=True)
            both, where = np.unique(np.concatenate([kept[0], new]), return_inverse=True)
            kept = both, np.bincount(where, weights=np.concatenate([kept[1], n])).astype(np.int64)
            if len(both) > 2_000_000:                       # bounded state; sums go on in the aggregate
                yield send()
                kept = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        if len(kept[0]):
            yield send()

    return train.select("ids").mapInArrow(run, "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def in_order(centres: np.ndarray, parts: int) -> np.ndarray:
    """An order of the centres in which ``parts`` even runs hold similar ones: halved again
    and again along the direction of largest spread."""
    if parts <= 1 or len(centres) < 3:
        return np.arange(len(centres))
    flat = centres - centres.mean(axis=0)
    line = np.ones(flat.shape[1])
    for _ in range(20):
        line = flat.T @ (flat @ line)
        line /= max(np.linalg.norm(line), 1e-30)
    order = np.argsort(flat @ line, kind="stable")
    half = parts // 2
    cut = len(order) * half // parts
    left, right = order[:cut], order[cut:]
    return np.concatenate([left[in_order(centres[left], half)], right[in_order(centres[right], parts - half)]])


def cluster(counts: np.ndarray, pairs: np.ndarray, seed: int = 11) -> np.ndarray:
    """Class per id: singletons for the most frequent, k-means on neighbour profiles for the rest.

    ``pairs`` (rows a, b, n) hold at least one of the ``CONTEXTS`` most frequent ids.
    """
    order = np.argsort(-counts, kind="stable")
    cls = np.zeros(len(counts), dtype=np.int32)
    single = order[:SINGLE]
    frequent = np.full(len(counts), -1)
    frequent[order[:CONTEXTS]] = np.arange(CONTEXTS)
    seen = np.setdiff1d(np.flatnonzero(counts > 0), single)
    k = CLASSES - SINGLE - 1
    profile = np.zeros((len(counts), 2 * CONTEXTS), dtype=np.float32)
    a, b, n = pairs
    for me, other, shift in ((a, b, 0), (b, a, CONTEXTS)):
        hit = frequent[other] >= 0
        np.add.at(profile, (me[hit], frequent[other[hit]] + shift), n[hit])
    base = profile.sum(axis=0) / max(profile.sum(), 1)
    rows = profile[seen]
    rows = np.sqrt(rows / np.maximum(rows.sum(axis=1, keepdims=True), 1)) - np.sqrt(base)
    weight = np.sqrt(counts[seen]).astype(np.float32)
    rng = np.random.default_rng(seed)
    if len(seen) > k:
        centres = rows[rng.choice(len(seen), k, replace=False, p=weight / weight.sum())]
        for _ in range(12):
            near = np.argmax(rows @ centres.T - 0.5 * (centres ** 2).sum(axis=1), axis=1)
            mass = np.bincount(near, weights=weight, minlength=k)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, rows * weight[:, None])
            centres = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-9)[:, None], centres)
        centres = centres[in_order(centres, BLOCKS - SINGLE // BLOCK)]
        cls[seen] = SINGLE + np.argmax(rows @ centres.T - 0.5 * (centres ** 2).sum(axis=1), axis=1)
    else:
        cls[seen] = SINGLE + np.arange(len(seen))
    cls[counts == 0] = CLASSES - 1                          # ids that training never saw
    cls[single] = np.arange(SINGLE)
    return cls


def train(encoded: DataFrame, rounds: int = 2, rate: float = 0.01) -> Model:
    """Counts, classes and weights from all training rows."""
    spark = encoded.sparkSession
    rows = encoded.where("NOT held_out")
    pairs = materialise(pair_counts(rows), "lm-pairs")
    unigram = np.zeros(VOCABULARY, dtype=np.int64)
    for r in pairs.groupBy("b").agg(F.sum("n").alias("n")).collect():       # at most one row per id
        unigram[r["b"]] = r["n"]
    if unigram.sum() == 0:
        only = np.zeros((CLASSES, CLASSES))
        only[:, 0] = 1                                      # one class that holds every id
        return Model(np.zeros(VOCABULARY, dtype=np.int32), np.full(VOCABULARY, -np.log10(VOCABULARY)),
                     bigram_tables(only), np.zeros_like(first_weights()))
    top = [int(i) for i in np.argsort(-unigram, kind="stable")[:CONTEXTS]]
    near = pairs.where(F.col("a").isin(top) | F.col("b").isin(top)).select("a", "b", "n").toArrow()
    cls = cluster(unigram, np.stack([near.column(c).to_numpy().astype(np.int64) for c in ("a", "b", "n")]))
    size = np.bincount(cls, minlength=CLASSES)
    mass = np.bincount(cls, weights=unigram, minlength=CLASSES)
    log_share = np.log10((unigram + 0.5) / (mass + 0.5 * size)[cls])
    of = spark.createDataFrame(list(enumerate(cls.tolist())), "id int, c int")
    left, right = F.broadcast(of.toDF("a", "ca")), F.broadcast(of.toDF("b", "cb"))   # one row per id of the vocabulary
    table = np.full((CLASSES, CLASSES), 0.5)
    for r in pairs.join(left, "a").join(right, "b").groupBy("ca", "cb").agg(F.sum("n").alias("n")).collect():
        table[r["ca"], r["cb"]] += r["n"]
    tables, weights = bigram_tables(table), first_weights()
    for r in range(rounds):
        weights = _round(rows, cls, tables, weights, r, rounds, rate)
    return Model(cls, log_share, tables, weights)


def _round(rows: DataFrame, cls: np.ndarray, tables: tuple[np.ndarray, np.ndarray], weights: np.ndarray, number: int,
           rounds: int, rate: float) -> np.ndarray:
    """One round: steps in every task over the windows of this round, then the average."""
    schema = pa.schema([("weight", pa.float64()), ("values", pa.list_(pa.float64()))])
    shared = rows.sparkSession.sparkContext.broadcast((cls, tables, weights))

    def run(batches):
        cls_, tables_, start = shared.value
        forget("encoder")
        opt, done = Adam(start, rate / (1 + number)), 0
        rng = np.random.default_rng(number)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def steps(last: bool):
            nonlocal held, done
            inputs, targets = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            order = rng.permutation(len(inputs))
            whole = len(order) if last else len(order) // BATCH * BATCH
            for at in range(0, whole, BATCH):
                pick = order[at:at + BATCH]
                opt.step(gradient(opt.w, tables_, inputs[pick], targets[pick], np.arange(STRIDE)))
                done += len(pick)
            rest = order[whole:]
            held = [(inputs[rest], targets[rest])] if len(rest) else []

        for batch in bounded_batches(batches, 2 << 20):
            texts = [cls_[np.frombuffer(x, dtype="<u2")] for x in batch.column(0).to_pylist()]
            inputs, targets, _, numbers = windows(texts, int(cls_[START]))
            mine = numbers % rounds == number
            if mine.any():
                held.append((inputs[mine], targets[mine]))
            if sum(len(h[0]) for h in held) >= 4 * BATCH:
                steps(False)
        if held:
            steps(True)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([float(done)]), pa.array([opt.w.astype(np.float64)], pa.list_(pa.float64()))],
                                             schema=schema)

    sent = rows.select("ids").mapInArrow(run, "weight double, values array<double>")
    mean = (sent.select("weight", F.posexplode("values").alias("i", "v")).groupBy("i")
            .agg((F.sum(F.col("weight") * F.col("v")) / F.sum("weight")).alias("v")).collect())
    shared.unpersist()
    out = weights.copy()
    for r in mean:                                          # one row per weight of the model
        out[r["i"]] = r["v"]
    return out


# ---------------------------------------------------------------- base counts and scores
def score(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
          heavy_share: float = 1e-6, rounds: int = 2) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row."""
    spark = docs.sparkSession
    encoded, counts = encode(docs, vocabulary, id_col, text_col)
    counts = materialise(counts, "lm-words")
    ends = encoded.where("NOT held_out").count()
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, kinds = size["n"] + ends, size["v"] + (1 if ends else 0)
    limit = total * heavy_share                              # so there are at most 1 / heavy_share heavy words
    heavy = {r["word"]: r["c"] for r in counts.where(F.col("c") > limit).collect()}
    model = train(encoded, rounds)
    down = total + ALPHA * (kinds + 1)
    scored = materialise(_score_rows(encoded, model, heavy, ends, down), "lm-scored", compression="zstd")
    # The other words meet their counts by a join; none of them is frequent.
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    known = rare.join(counts.where(F.col("c") <= limit), "word")
    part = known.groupBy("row").agg(F.sum("n").alias("k"), F.sum(
        F.col("n") * (F.log10(F.col("c") + ALPHA) - float(np.log10(ALPHA)))).alias("s"))
    joined = scored.drop("rare").join(part, "row", "left")
    return joined.select("id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
                         F.lit(total).cast("bigint").alias("train_tokens"),
                         (F.col("base_score") + F.coalesce("s", F.lit(0.0))).alias("base_score"), "score")


def _score_rows(encoded: DataFrame, model: Model, heavy: dict[str, int], ends: int, down: float) -> DataFrame:
    """Model scores, and base scores with every rare word taken as unknown; ``rare`` lists them."""
    rare_type = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))
    schema = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("rare", rare_type)])
    shared = encoded.sparkSession.sparkContext.broadcast((
        model.cls, model.log_share, model.tables, model.weights, list(heavy), np.log10(np.array(list(heavy.values())) + ALPHA)))

    def run(batches):
        cls, log_share, tables, weights, frequent, logs = shared.value
        parts, frequent = unpack(weights), pa.array(frequent, pa.string())
        forget("encoder")                                   # its cache is of no use from here on
        log_of, norm = np.append(logs, np.log10(ALPHA)), float(np.log10(down))      # unknown words come last
        for batch in bounded_batches(batches, 4 << 20):
            words = split_words(pc.ascii_lower(batch.column(3)))
            n, sizes = len(words.sizes), words.sizes + 1
            place = pc.fill_null(pc.index_in(words.kinds, value_set=frequent), -1).to_numpy()[words.which]
            owner, absent = np.repeat(np.arange(n), words.sizes), np.flatnonzero(place < 0)
            knowns = words.sizes - np.bincount(owner[absent], minlength=n) + (1 if ends else 0)
            bases = np.bincount(owner, weights=log_of[place], minlength=n) + np.log10(ends + ALPHA) - sizes * norm
            rare, times = np.unique(owner[absent] * len(words.kinds) + words.which[absent], return_counts=True)
            edges = np.searchsorted(rare, np.arange(n + 1) * len(words.kinds)).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays(
                [words.kinds.take(pa.array(rare % max(1, len(words.kinds)))), pa.array(times, pa.int64())], names=["word", "n"]))
            ids = [np.frombuffer(x, dtype="<u2") for x in batch.column(4).to_pylist()]
            totals = np.array([log_share[i].sum() for i in ids])
            inputs, targets, texts, _ = windows([cls[i] for i in ids], int(cls[START]))
            for at in range(0, len(inputs), SCORED):
                logs = log_probabilities(parts, tables, inputs[at:at + SCORED], targets[at:at + SCORED])
                totals += np.bincount(texts[at:at + SCORED], weights=logs.sum(axis=1) / np.log(10), minlength=len(ids))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(knowns, pa.int64()),
                                              pa.array(bases), pa.array(totals), listed], schema=schema)

    return encoded.select("row", "id", "held_out", "text", "ids").mapInArrow(
        run, "row bigint, id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, "
             "rare array<struct<word:string,n:bigint>>")
