"""Toxicity by a classifier chain of linear models.

The labels hold one verdict (toxic or not). The categories of the chain are derived from
it on the fit sample, in this order:

1. ``explicit``: toxic, and holds an indicator term (one strongly tied to the label);
2. ``severe``: toxic, and holds at least as many different indicators as the median of
   the explicit documents;
3. ``implicit``: toxic without an indicator;
4. ``toxic``: the label itself, which gives the verdict.

Each category has a logistic model over term features (words and word beginnings) and
the probabilities of the categories before it. In training those probabilities are out
of fold: a document's value comes from models that have not seen it, so a later model
does not learn to trust an overfitted input. The verdict's threshold is the lowest that
keeps out-of-fold false alarms at ``alarm_rate`` of the clean documents.

Scale: the fit uses a bounded sample of the labelled rows (``label_bound``, chosen by a
hash of the id). Terms are counted by one aggregate over the sample, ``features`` of them
are kept, and at most ``label_bound`` sparse rows reach the driver. Scoring is one pass
over all documents in Arrow batches with the bounded model in the task; nothing is
shuffled. Whole texts are read, never prefixes.

Defined results: a NULL or empty text has no terms and gets the models' base rates. Ids
with contradicting labels are not used in the fit; neither are NULL ids. Without both
toxic and clean labels nothing is toxic. NULL ids and repeated rows are judged as they
come; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laminar.llm.common import bounded_batches, materialise

CHAIN = ("explicit", "severe", "implicit", "toxic")
TRIM = ".,;:!?*#$%&|<>\"'()[]{}"
BEGINNINGS = (5, 6, 7)         # code points of a word's beginning that make a feature
FOLDS = 5


def terms(text: str | None) -> set[str]:
    """The different term features of a text: trimmed lower-case words and their beginnings."""
    found = {w.strip(TRIM) for w in set((text or "").lower().split())}
    found.discard("")
    out = set(found)
    for w in found:
        for n in BEGINNINGS:
            if len(w) > n:
                out.add(w[:n] + "~")
    return out


@dataclass
class Model:
    features: dict[str, int] = field(default_factory=dict)
    weights: list[np.ndarray] = field(default_factory=list)    # per category: features, earlier ones, bias
    threshold: float = 2.0


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Rows:
    """Sparse 0/1 term rows plus dense columns (the earlier categories)."""
    cols: np.ndarray               # term of every entry, row after row
    sizes: np.ndarray              # entries per row
    terms: int
    dense: np.ndarray              # rows x earlier categories

    def __post_init__(self):
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def times(self, w: np.ndarray) -> np.ndarray:
        linear = np.bincount(self.row, weights=w[self.cols], minlength=len(self.sizes))
        return linear + self.dense @ w[self.terms:-1] + w[-1]

    def back(self, g: np.ndarray) -> np.ndarray:
        terms = np.bincount(self.cols, weights=g[self.row], minlength=self.terms)
        return np.concatenate([terms, self.dense.T @ g, [g.sum()]])

    def take(self, mask: np.ndarray) -> "Rows":
        return Rows(self.cols[mask[self.row]], self.sizes[mask], self.terms, self.dense[mask])

    def with_column(self, p: np.ndarray) -> "Rows":
        return Rows(self.cols, self.sizes, self.terms, np.concatenate([self.dense, p[:, None]], axis=1))


def rows_of(found: list[list[int]], terms: int) -> Rows:
    sizes = np.array([len(f) for f in found], dtype=np.int64)
    cols = np.array([t for f in found for t in f], dtype=np.int64)
    return Rows(cols, sizes, terms, np.zeros((len(found), 0)))


def fit_linear(x: Rows, y: np.ndarray, ridge: float = 0.5, steps: int = 150) -> np.ndarray:
    """L2-regularised logistic regression by accelerated gradient steps. The weights are
    those of the terms, of the dense columns, and the bias, which is not regularised."""
    d = x.terms + x.dense.shape[1] + 1
    # Step length from the largest eigenvalue of X'X / 4, found by power iteration.
    v = np.ones(d)
    for _ in range(12):
        v = x.back(x.times(v))
        size = float(np.linalg.norm(v))
        v /= size
    rate = 1.0 / (size / 4 + ridge)
    keep = np.full(d, ridge)
    keep[-1] = 0.0
    w = np.zeros(d)
    p = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    w[-1] = np.log(p / (1 - p))
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        new = ahead - rate * (x.back(sigmoid(x.times(ahead)) - y) + keep * ahead)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + ((t - 1) / t_new) * (new - w), new, t_new
    return w


def apply_chain(x: Rows, weights: list[np.ndarray]) -> list[np.ndarray]:
    """Probabilities of the categories, each fed to the next."""
    out = []
    for w in weights:
        p = sigmoid(x.times(w))
        out.append(p)
        x = x.with_column(p)
    return out


def fit_chain(x: Rows, targets: list[np.ndarray], folds: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Weights per category, and each category's out-of-fold probabilities."""
    weights, outside = [], []
    for y in targets:
        p = np.full(len(y), y.mean())
        for k in range(FOLDS):
            seen = folds != k
            if (~seen).any() and seen.any():
                p[~seen] = sigmoid(x.take(~seen).times(fit_linear(x.take(seen), y[seen])))
        weights.append(fit_linear(x, y))
        outside.append(p)
        x = x.with_column(p)
    return weights, outside


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_bound: int) -> DataFrame:
    """(id, text, y) of at most about ``label_bound`` labelled documents, one row of each id."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
             .agg(F.min("toxic").alias("y"), F.max("toxic").alias("y2")).where("y = y2").select("doc_id", "y"))
    n = known.count()
    if n > label_bound:
        share = int(0.95 * label_bound / n * (1 << 30))
        known = known.where(F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 30)) < share)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    labelled = rows.join(F.broadcast(known), F.col("id") == F.col("doc_id"))
    # Of repeated rows of an id the one with the least hash, so the bound holds for rows.
    return labelled.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("id", "text", "y")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_bound: int = 12000,
        features: int = 1024, alarm_rate: float = 0.002) -> Model:
    def spread(batches):
        schema = pa.schema([("id", pa.int64()), ("y", pa.int32()), ("terms", pa.list_(pa.string()))])
        for batch in bounded_batches(batches, 1 << 20):
            found = [list(terms(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2).cast(pa.int32()), pa.array(found, pa.list_(pa.string()))],
                                             schema=schema)

    sample = materialise(labelled_sample(docs, labels, id_col, text_col, label_bound).mapInArrow(
        spread, "id bigint, y int, terms array<string>"), "toxic-sample")
    size = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("t")).first()
    clean_n, toxic_n = size["n"] - size["t"], size["t"]
    if not clean_n or not toxic_n:
        return Model()
    # Smoothed log-odds over its standard error ranks the terms.
    counted = (sample.select("y", F.explode("terms").alias("term")).groupBy("term")
               .agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).where("a + b >= 3"))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (toxic_n + 1 - a)) - F.log(b / (clean_n + 1 - b))
    ranked = counted.select("term", (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
    best = ranked.orderBy(F.desc(F.abs("z")), "term").limit(features).collect()
    names = {r["term"]: i for i, r in enumerate(best)}
    indicators = {names[r["term"]] for r in best if r["z"] > 4.0}
    wanted = F.array(*[F.lit(n) for n in names])
    rows = (sample.select("id", "y", F.array_intersect("terms", wanted).alias("terms")).orderBy("id").collect())
    found = [[names[t] for t in r["terms"]] for r in rows]
    y = np.array([r["y"] for r in rows], dtype=np.float64)
    hits = np.array([len(indicators.intersection(f)) for f in found])
    explicit = (y == 1) & (hits > 0)
    severe = explicit & (hits >= (np.median(hits[explicit]) if explicit.any() else np.inf))
    targets = [t.astype(np.float64) for t in (explicit, severe, (y == 1) & (hits == 0), y == 1)]
    ids = np.array([r["id"] for r in rows], dtype=np.int64).astype(np.uint64)
    folds = ((ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(FOLDS)
    weights, outside = fit_chain(rows_of(found, len(names)), targets, folds.astype(int))
    clean = np.sort(outside[-1][y == 0])
    allowed = clean[min(len(clean) - 1, int(np.ceil(len(clean) * (1 - alarm_rate))))]
    return Model(names, weights, float(max(0.5, np.nextafter(allowed, 2.0))))


def judge(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) plus ``toxic_<category>``
    probabilities and the verdict ``is_toxic``."""
    out = [f"toxic_{c}" for c in CHAIN] + ["is_toxic"]
    columns = docs.columns if keep is None else list(keep)
    clash = set(out) & set(columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made by judge")
    rows = docs.select(*columns, F.col(text_col).cast("string").alias("_text"))

    schema = T.StructType([*docs.select(*columns).schema.fields, *[T.StructField(c, T.DoubleType()) for c in out[:-1]],
                           T.StructField("is_toxic", T.BooleanType())])

    def run(batches):
        known = model.features
        for batch in bounded_batches(batches, 1 << 20):
            texts = batch.column(len(columns)).to_pylist()
            found = [[known[t] for t in terms(text) & known.keys()] if known else [] for text in texts]
            earlier = apply_chain(rows_of(found, len(known)), model.weights)
            while len(earlier) < len(CHAIN):
                earlier.append(np.zeros(len(texts)))
            verdict = earlier[-1] >= model.threshold
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(p.astype(np.float64)) for p in earlier],
                                              pa.array(verdict)], names=[*columns, *out])

    return rows.mapInArrow(run, schema)
