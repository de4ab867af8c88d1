"""Embedding whitening from an exact characteristic polynomial.

Every vector entry ``c`` becomes an integer ``x = floor(64 * c) + 1000000``. With ``n``
vectors, sums ``S`` and second moments ``G`` the scatter matrix ``M = n * G - S * S'`` is an
integer matrix, ``n * n`` times the covariance ``V``. It does not change under a shift, so
all sums are taken over ``x - 1000000``.

1. Sums and moments are exact: tasks add products of 20-bit limbs in floating point, where
   they are exact, and Spark sums the tasks' results as decimals.
2. The characteristic polynomial of ``M`` modulo each of many primes: reduction to Hessenberg
   form and its recurrence. The primes are rows of a Spark job.
3. Chinese remaindering gives the integer coefficients. They are, up to sign, elementary
   symmetric functions of eigenvalues that are not negative, which bounds them.
4. All roots are real, so Descartes' rule counts the roots above a point exactly, with
   multiplicity. Bisection over shifted integer polynomials isolates the largest roots, then
   narrows each to less than 2**-120 of the trace.
5. Components span the null space of ``M - root``: inverse iteration in extended precision,
   as a block for a multiple root, made orthogonal to the components before.

Only sums of size ``d * d`` and ``d`` coefficients per prime reach the driver, whatever the
number of vectors. Vectors are read four times (lengths, sums, check of the identity, output)
and never shuffled.

Defined results: vectors that are NULL, empty, or hold a NULL, a NaN, an infinity or an entry
of 2**56 and more (its integer is no BIGINT) are dropped, as are vectors of another length
than the most common one (of equally common ones the longest). Ids may be NULL or repeated;
each row is returned for itself. There are as many components as the covariance has positive
eigenvalues, ``top`` at most: one vector, or equal vectors, have none, so no rows. Equal
eigenvalues get orthogonal components. ``deviation`` is NULL where it exceeds a BIGINT. Other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction
from math import comb, gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import bounded_batches

SCALE = 64.0
SHIFT = 1_000_000
LIMB = 20                     # bits; a block of 4,096 rows sums products below 2**53
ROWS = 4096
LARGEST = float(1 << 56)
WIDE = 1 << 60                # moments travel as high * WIDE + low


@dataclass(frozen=True)
class Model:
    """Exact sums and the components: ``vectors`` has one column per component."""
    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: tuple[float, ...]           # eigenvalues of the covariance
    explained: tuple[float, ...]

    @property
    def dim(self) -> int:
        return len(self.sums)


# ---------------------------------------------------------------- rows
def usable(vec: Column) -> Column:
    """Whether a vector has entries and all are numbers of a size that fits."""
    v = vec.cast("array<double>")
    return F.coalesce((F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False))), F.lit(False))


def usual_length(rows: DataFrame) -> int | None:
    lengths = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return None if first is None else first["d"]


def vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part, whatever their length."""
    return table.where(usable(F.col(vec_col))).select(F.col(id_col).cast("bigint").alias("id"),
                                                      F.col(vec_col).cast("array<double>").alias("vec"))


def integers(column: pa.Array, dim: int) -> np.ndarray:
    """``x - SHIFT`` of a batch of vectors, as a matrix of int64."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * SCALE).astype(np.int64).reshape(-1, dim)


# ---------------------------------------------------------------- 1. exact sums
def limbs(y: np.ndarray) -> list[np.ndarray]:
    """Signed 20-bit pieces, lowest first, as exact floats: y = sum(piece << 20 * i)."""
    out, sign, rest = [], np.sign(y).astype(np.float64), np.abs(y)
    while True:
        out.append(sign * (rest & ((1 << LIMB) - 1)))
        rest = rest >> LIMB
        if not rest.any():
            return out


def moments(y: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums and sums of products of the columns of ``y``."""
    dim = y.shape[1]
    s, g = [0] * dim, np.zeros((dim, dim), dtype=object)
    for at in range(0, len(y), ROWS):
        parts = limbs(y[at:at + ROWS])
        for i, a in enumerate(parts):
            s = [t + (int(v) << LIMB * i) for t, v in zip(s, a.sum(axis=0))]
            for j, b in enumerate(parts):
                g += (a.T @ b).astype(np.int64).astype(object) * (1 << LIMB * (i + j))
    return s, g.tolist()


def scatter(rows: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, S, M): at most ``dim * dim`` sums reach the driver."""
    number = pa.decimal128(38, 0)
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("high", number), ("low", number)])

    def run(batches):
        from decimal import Decimal, localcontext
        n, s, g = 0, [0] * dim, np.zeros((dim, dim), dtype=object)
        for batch in bounded_batches(batches):
            y = integers(batch.column(0), dim)
            one, two = moments(y)
            n, s, g = n + len(y), [a + b for a, b in zip(s, one)], g + np.array(two, dtype=object)
        if n == 0:
            return
        found = [(-1, -1, n)] + [(-1, j, v) for j, v in enumerate(s)]
        found += [(i, j, g[i, j]) for i in range(dim) for j in range(i, dim)]
        with localcontext() as ctx:
            ctx.prec = 60
            high, low = ([Decimal(v) for v in side] for side in zip(*[divmod(v, WIDE) for _, _, v in found]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32()),
                 pa.array(high, number), pa.array(low, number)], schema=schema)

    sums = (rows.select("vec").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
            .groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect())
    at = {(r["i"], r["j"]): int(r["high"]) * WIDE + int(r["low"]) for r in sums}
    n = at.get((-1, -1), 0)
    s = [at.get((-1, j), 0) for j in range(dim)]
    m = [[n * at.get((min(i, j), max(i, j)), 0) - s[i] * s[j] for j in range(dim)] for i in range(dim)]
    return n, s, m


# ---------------------------------------------------------------- 2. modular polynomials
def is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every number below 2**32."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(r - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2**31, the largest first, whose product exceeds ``bound``."""
    out, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """Similar matrix modulo ``p`` with zeros below the first subdiagonal."""
    a, d = a.copy(), len(a)
    for k in range(1, d - 1):
        below = np.flatnonzero(a[k:, k - 1])
        if len(below) == 0:
            continue
        pivot = k + below[0]
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            a[:, [k, pivot]] = a[:, [pivot, k]]
        u = a[k + 1:, k - 1] * pow(int(a[k, k - 1]), -1, p) % p
        a[k + 1:] = (a[k + 1:] - u[:, None] * a[k] % p) % p
        a[:, k] = (a[:, k] + (a[:, k + 1:] * u % p).sum(axis=1)) % p
    return a


def polynomial_mod(a: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - a) modulo ``p``, lowest power first."""
    h, d = hessenberg(a, p), len(a)
    polys = np.zeros((d + 1, d + 1), dtype=np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        new = np.zeros(d + 1, dtype=np.int64)
        new[1:] = polys[k - 1, :-1]
        weights, t = np.zeros(k, dtype=np.int64), 1
        weights[k - 1] = h[k - 1, k - 1]
        for i in range(k - 2, -1, -1):
            t = t * int(h[i + 1, i]) % p
            weights[i] = int(h[i, k - 1]) * t % p
        polys[k] = (new - (weights[:, None] * polys[:k] % p).sum(axis=0)) % p
    return polys[d].tolist()


def symmetric_functions(spark, m: list[list[int]], trace: int) -> list[int]:
    """Elementary symmetric functions e_0..e_d of the eigenvalues of ``m``, which are not negative."""
    d = len(m)
    mean = -(-trace // d)                                # Maclaurin: e_k <= C(d, k) * mean**k
    primes = primes_beyond(max(comb(d, k) * mean ** k for k in range(d + 1)))

    def run(batches):
        for batch in batches:
            for p in batch.column(0).to_pylist():
                a = np.array([[v % p for v in row] for row in m], dtype=np.int64)
                yield pa.RecordBatch.from_pydict({"p": [p], "c": [polynomial_mod(a, p)]})

    jobs = spark.createDataFrame([(p,) for p in primes], "p bigint")
    jobs = jobs.repartition(max(1, min(len(primes), 32)), "p")
    e, product = [0] * (d + 1), 1
    for r in jobs.mapInArrow(run, "p bigint, c array<bigint>").collect():
        p, inverse = r["p"], pow(product, -1, r["p"])
        for k in range(d + 1):
            value = r["c"][d - k] * (-1) ** k % p
            e[k] += product * ((value - e[k]) * inverse % p)
        product *= p
    return e


# ---------------------------------------------------------------- 4. real roots
def shifted(coefficients: list[int], a: int) -> list[int]:
    """Coefficients (highest first) of q(x + a)."""
    c = list(coefficients)
    for end in range(len(c) - 1, 0, -1):
        for i in range(1, end + 1):
            c[i] += a * c[i - 1]
    return c


def roots_above(coefficients: list[int], a: int) -> int:
    """Roots greater than ``a`` of a polynomial with real roots only (Descartes, exact here)."""
    signs = [c > 0 for c in shifted(coefficients, a) if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def value_at(coefficients: list[int], a: int) -> int:
    v = 0
    for c in coefficients:
        v = v * a + c
    return v


def largest_roots(coefficients: list[int], top: int, upper: int) -> list[tuple[int, int]]:
    """(root, multiplicity) of the ``top`` largest positive roots, each rounded up to an integer;
    roots within the same unit count as one multiple root. ``upper`` is a bound on all roots."""
    out, found = [], 0
    stack = [(0, upper, roots_above(coefficients, 0), 0)]      # (low, high], roots above low and above high
    while stack and found < top:
        low, high, above_low, above_high = stack.pop()
        count = above_low - above_high
        if count == 0:
            continue
        if count == 1:
            # Above the root the sign is (-1) ** above_high.
            while high - low > 1:
                mid = (low + high) // 2
                v = value_at(coefficients, mid)
                if v == 0:
                    low, high = mid - 1, mid
                elif (v > 0) == (above_high % 2 == 0):
                    high = mid
                else:
                    low = mid
        if high - low == 1:
            out.append((high, count))
            found += count
            continue
        mid = (low + high) // 2
        above_mid = roots_above(coefficients, mid)
        stack += [(low, mid, above_low, above_mid), (mid, high, above_mid, above_high)]
    return out


# ---------------------------------------------------------------- 5. components
def extended(v: int, unit: int) -> np.longdouble:
    """v / unit in extended precision."""
    q = (v << 160) // unit
    sign, q = (-1, -q) if q < 0 else (1, q)
    drop = max(0, q.bit_length() - 64)
    return np.ldexp(np.longdouble(sign) * np.longdouble(np.uint64(q >> drop)), drop - 160)


def factored(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """LU with row pivots; a zero pivot becomes tiny, as inverse iteration wants it."""
    a, d = a.copy(), len(a)
    order = np.arange(d)
    tiny = np.finfo(np.longdouble).eps * max(np.abs(a).max(), np.longdouble(1e-300))
    for k in range(d):
        pivot = k + int(np.argmax(np.abs(a[k:, k])))
        if pivot != k:
            a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        a[k + 1:, k] /= a[k, k]
        a[k + 1:, k + 1:] -= a[k + 1:, k, None] * a[k, k + 1:]
    return a, order


def solved(lu: np.ndarray, order: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = b[order].copy()
    d = len(lu)
    for k in range(d):
        x[k + 1:] -= lu[k + 1:, k, None] * x[k]
    for k in range(d - 1, -1, -1):
        x[k] /= lu[k, k]
        x[:k] -= lu[:k, k, None] * x[k]
    return x


def orthonormal(block: np.ndarray, before: list[np.ndarray]) -> np.ndarray:
    """Columns made orthogonal to ``before`` and to each other, of length one."""
    done = []
    for v in block.T:
        v = v / np.sqrt((v * v).sum())
        for _ in range(2):
            for u in before + done:
                v = v - u * (u * v).sum()
            v = v / np.sqrt((v * v).sum())
        done.append(v)
    return np.array(done).T


def null_space(m: list[list[int]], scale: int, root: int, multiplicity: int, trace: int,
               before: list[np.ndarray]) -> np.ndarray:
    """Orthonormal columns that span the eigenspace of ``m`` at ``root / scale``."""
    d = len(m)
    a = np.array([[extended(m[i][j] * scale - (root if i == j else 0), trace * scale) for j in range(d)] for i in range(d)],
                 dtype=np.longdouble)
    lu, order = factored(a)
    start = np.random.default_rng(d).standard_normal((d, len(before) + multiplicity))[:, len(before):]
    block = orthonormal(start.astype(np.longdouble), before)
    for _ in range(4):
        block = orthonormal(solved(lu, order, block), before)
    return block


def fit(rows: DataFrame, dim: int, top: int) -> Model | None:
    """The components of the vectors ``(id, vec)``, all of length ``dim``."""
    n, sums, m = scatter(rows, dim)
    trace = sum(m[i][i] for i in range(dim))
    if trace == 0:
        return None
    unit = gcd(*[v for row in m for v in row])
    small = [[v // unit for v in row] for row in m]
    trace //= unit
    e = symmetric_functions(rows.sparkSession, small, trace)
    bits = max(0, 121 - trace.bit_length())
    coefficients = [(-1) ** k * v << bits * k for k, v in enumerate(e)]     # of the matrix times 2**bits
    while coefficients[-1] == 0:                                            # eigenvalues zero
        coefficients.pop()
    columns, values = [], []
    for root, multiplicity in largest_roots(coefficients, top, trace << bits):
        block = null_space(small, 1 << bits, root, multiplicity, trace, columns)
        columns += list(block.T)
        values += [Fraction(root, 1 << bits)] * multiplicity
    signed = [v * np.sign(v[np.argmax(np.abs(v))]) for v in columns[:top]]
    values = values[:top]
    return Model(n, tuple(sums), np.array(signed).T.astype(np.float64),
                 tuple(float(v * unit / (n * n)) for v in values), tuple(float(v / trace) for v in values))


# ---------------------------------------------------------------- output
def centred(y: np.ndarray, model: Model) -> np.ndarray:
    """n * x - S per entry, exact."""
    largest = int(np.abs(y).max(initial=0)) * model.n + max(map(abs, model.sums))
    if largest < 1 << 62:
        return y * model.n - np.array(model.sums, dtype=np.int64)
    return y.astype(object) * model.n - np.array(model.sums, dtype=object)


def projected(c: np.ndarray, model: Model) -> np.ndarray:
    return (c / model.n).astype(np.float64) @ (model.vectors / np.sqrt(model.values))


def identity_error(rows: DataFrame, model: Model) -> float:
    """Largest entry of the covariance of all whitened vectors minus the identity. Tasks
    return sums and products; Spark adds them up to one row per pair of components."""
    k = model.vectors.shape[1]

    def run(batches):
        s, g = np.zeros(k), np.zeros((k, k))
        for batch in bounded_batches(batches):
            z = projected(centred(integers(batch.column(0), model.dim), model), model)
            s, g = s + z.sum(axis=0), g + z.T @ z
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(np.concatenate([np.full(k, -1), i]), pa.int32()),
            "j": pa.array(np.concatenate([np.arange(k), j]), pa.int32()), "v": np.concatenate([s, g[i, j]])})

    found = (rows.select("vec").mapInArrow(run, "i int, j int, v double")
             .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    at = {(r["i"], r["j"]): r["v"] / model.n for r in found}
    return max(abs(v - at[-1, i] * at[-1, j] - (i == j)) for (i, j), v in at.items() if i >= 0)


def deviations(c: np.ndarray) -> list[int | None]:
    if c.dtype != object and int(np.abs(c).max(initial=0)) ** 2 * c.shape[1] < 1 << 63:
        return (c * c).sum(axis=1).tolist()
    sums = [sum(int(v) ** 2 for v in row) for row in c]
    return [v if v < 1 << 63 else None for v in sums]


OUTPUT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
          "identity_error double")


def whiten(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", top: int = 32) -> DataFrame:
    """One row per vector that takes part and component: the columns of ``OUTPUT``."""
    spark = table.sparkSession
    rows = vectors(table, id_col, vec_col)
    dim = usual_length(rows)
    if dim is None:
        return spark.createDataFrame([], OUTPUT)
    rows = rows.where(F.size("vec") == dim)
    model = fit(rows, dim, top)
    if model is None:
        return spark.createDataFrame([], OUTPUT)
    error, k = identity_error(rows, model), model.vectors.shape[1]

    def run(batches):
        for batch in bounded_batches(batches, 256 << 10):
            c = centred(integers(batch.column(1), model.dim), model)
            n = len(c)
            each = np.repeat(np.arange(n), k)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(0).take(pa.array(each)),
                "component": pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                "n": pa.array(np.full(n * k, model.n), pa.int64()),
                "deviation": pa.array(deviations(c), pa.int64()).take(pa.array(each)),
                "whitened": projected(c, model).reshape(-1),
                "explained": np.tile(model.explained, n),
                "identity_error": np.full(n * k, error)})

    return rows.mapInArrow(run, OUTPUT)
