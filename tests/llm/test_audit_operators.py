"""Decontamination, whitening and the filter audit against brute force, with edge cases."""

import os
import random
import re
import sys
from collections import Counter
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))

from conftest import SF_SMALL  # noqa: E402
from laminar.llm import decontamination, filter_audit, queries, whitening  # noqa: E402
from oracle_check import duck, norm  # noqa: E402


def same_as_sql(spark, name, sf_dir=SF_SMALL):
    got = queries.queries()[name](spark, sf_dir)
    cur = duck(sf_dir).execute(queries.oracle_sql()[name])
    names = sorted(got.columns)
    want = [d[0] for d in cur.description]
    assert names == sorted(want)
    rows = Counter(tuple(norm(r[c]) for c in names) for r in got.collect())
    assert rows == Counter(tuple(norm(r[want.index(c)]) for c in names) for r in cur.fetchall())


# ---------------------------------------------------------------- decontamination
def brute_words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_hits(text, items, window=10):
    """(n_words, n_hit, item ids) of one text."""
    w, hit, named = brute_words(text), set(), set()
    for item, item_text in items:
        x = brute_words(item_text)
        size = min(window, len(x))
        for i in range(len(x) - size + 1 if x else 0):
            for j in range(len(w) - size + 1):
                if w[j:j + size] == x[i:i + size]:
                    hit.update(range(j, j + size))
                    named |= {str(item)} - {"None"}
    return len(w), len(hit), sorted(named)


def check_hits(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id bigint, text string, row string, window int, items string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = Counter((r["id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"])
                  for r in decontamination.decontaminate(d, b, **options).collect())
    want = Counter()
    for doc_id, text, *_ in docs:
        n, hit, named = brute_hits(text, items)
        want[(doc_id, n, hit, tuple(named), hit > 0)] += 1
    assert got == want


def corpus(rng, size):
    vocabulary = ["Alpha", "beta", "gamma", "delta", "été", "Zug", "x1"]
    return " ".join(rng.choice(vocabulary) for _ in range(size))


def test_decontamination_matches_sql(spark):
    same_as_sql(spark, "op11_decontamination")


@pytest.mark.parametrize("block", [200_000, 7])
def test_decontamination_matches_brute_force(spark, block):
    """Few different words, so that shingles repeat everywhere; items of 1 to 30 words."""
    rng = random.Random(3)
    items = [(i, corpus(rng, n)) for i, n in enumerate((1, 2, 3, 4, 9, 10, 11, 30))][1:]
    items += [(None, corpus(rng, 12)), (20, items[-1][1]), (21, "...  ")]
    docs = [(i, corpus(rng, rng.randrange(0, 60)), "r", 1, "x") for i in range(40)]
    docs += [(100 + i, f"{corpus(rng, 5)}! {text.upper()} {corpus(rng, 3)}", None, None, None)
             for i, (_, text) in enumerate(items)]
    check_hits(spark, docs, items, block=block)


def test_decontamination_edges(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    items = [(1, passage), (2, "solo"), (3, None), (4, ""), (2, "other solo")]
    docs = [(1, None), (1, ""), (None, passage), (7, passage), (7, passage), (8, "Ten, eleven one two."),
            (9, f"{passage} filler " * 3000), (10, "SOLO"), (11, "one two three four five six seven eight nine")]
    check_hits(spark, [(i, t, "a", 0, "b") for i, t in docs], items)
    check_hits(spark, [(i, t, "a", 0, "b") for i, t in docs], [])
    check_hits(spark, [], items)


# ---------------------------------------------------------------- whitening
def embeddings(spark, vectors, ids=None):
    rows = [(i, v, 0.5, 3) for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, whitened double, n int")


def test_whitening_of_the_table(spark):
    rows = queries.queries()["op12_whitening"](spark, SF_SMALL).toPandas().sort_values(["vec_id", "component"])
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(64 * np.array([r["embedding"] for r in table], dtype=float)).astype(np.int64) + 1000000
    n, c = len(x), x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    z = rows.whitened.to_numpy().reshape(n, 32)
    want = c @ vectors / np.sqrt(values)
    signs = np.sign((z * want).sum(axis=0))
    assert np.abs(z - want * signs).max() < 1e-9
    assert np.abs(z.T @ z / n - np.eye(32)).max() < 1e-9
    assert rows.identity_error.nunique() == 1 and rows.identity_error.iloc[0] < 1e-9
    assert np.allclose(rows.explained[:32], values / np.trace(c.T @ c / n), rtol=1e-10)
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, x.sum(axis=0))) for row in x]
    assert rows.deviation.tolist() == [v for v in deviation for _ in range(32)]
    assert set(rows.n) == {n} and rows.component.tolist() == list(range(1, 33)) * n


def test_scatter_is_exact_for_entries_of_any_size(spark):
    rng = random.Random(5)
    big = [[rng.randrange(-1 << 61, 1 << 61), rng.randrange(-50, 50), rng.randrange(1 << 40)] for _ in range(70)]
    s, g = whitening.moments(np.array(big, dtype=np.int64))
    assert s == [sum(r[i] for r in big) for i in range(3)]
    assert g == [[sum(r[i] * r[j] for r in big) for j in range(3)] for i in range(3)]
    table = embeddings(spark, [[v / 64 for v in r] for r in big])
    used = [[int(v / 64 * 64) for v in r] for r in big]
    n, sums, m = whitening.scatter(whitening.vectors(table, "vec_id", "embedding"), 3)
    assert (n, sums) == (70, [sum(r[i] for r in used) for i in range(3)])
    assert m[0][1] == 70 * sum(r[0] * r[1] for r in used) - sums[0] * sums[1]


def test_characteristic_polynomial_by_remainders(spark):
    rng = random.Random(2)
    for d in (1, 2, 5, 8):
        b = [[rng.randrange(-9, 10) for _ in range(d)] for _ in range(d)]
        m = [[sum(x * y for x, y in zip(r, q)) for q in b] for r in b]
        e = whitening.symmetric_functions(spark, m, sum(m[i][i] for i in range(d)))
        # Faddeev and LeVerrier's recurrence in exact fractions.
        c, k = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
        for step in range(1, d + 1):
            k = [[sum(m[i][t] * k[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
            c.append(-sum(m[i][t] * k[t][i] for i in range(d) for t in range(d)) / step)
        assert e == [(-1) ** i * v for i, v in enumerate(c)]


def test_roots_are_isolated_with_multiplicity():
    roots = [3, 3, 7, 50, 51, 51, 51, 1000, 2]
    q = [1]
    for r in roots:
        q = [a - r * b for a, b in zip(q + [0], [0] + q)]
    assert whitening.largest_roots(q, 9, 2000) == [(1000, 1), (51, 3), (50, 1), (7, 1), (3, 2), (2, 1)]
    assert whitening.largest_roots(q, 2, 2000) == [(1000, 1), (51, 3)]


def test_whitening_of_equal_eigenvalues_and_low_rank(spark):
    # The corners of a cube have one threefold eigenvalue; a fourth entry never changes.
    cube = [[float(x), float(y), float(z), 5.0] for x in (-1, 1) for y in (-1, 1) for z in (-1, 1)]
    rows = whitening.whiten(embeddings(spark, cube)).toPandas().sort_values(["vec_id", "component"])
    z = rows.whitened.to_numpy().reshape(8, 3)
    assert np.abs(z.T @ z / 8 - np.eye(3)).max() < 1e-12
    assert np.allclose(rows.explained, 1 / 3)


def test_whitening_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.0, 1.0], [2.0, 3.5], [-1.0, 0.25]]
    bad = [None, [], [None, 1.0], [nan, 1.0], [inf, 0.0], [1.0], [1e300, 0.0]]
    ids = [1, None, 2] + list(range(10, 17))
    rows = whitening.whiten(embeddings(spark, good + bad, ids)).collect()
    assert Counter(r["vec_id"] for r in rows) == {1: 2, None: 2, 2: 2}
    assert {r["n"] for r in rows} == {3}
    twice = whitening.whiten(embeddings(spark, good + good, [1, 1, 2, 2, 3, 3])).collect()
    assert len(twice) == 12
    for none in ([], bad[:5], [[1.0, 2.0]], [[1.0, 2.0]] * 4):
        assert whitening.whiten(embeddings(spark, none)).collect() == []
    far = whitening.whiten(embeddings(spark, [[1e12, 0.0], [-1e12, 0.0], [0.0, 1.0]])).collect()
    assert {r["deviation"] for r in far if r["vec_id"] < 2} == {None}


# ---------------------------------------------------------------- filter audit
def brute_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    smallest = {}
    for i, text, _ in docs:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))

    def failing(i, text):
        t = text or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        return {c for c, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            re.search(r"[#$%&*|]", t), i is not None and i > smallest[t])) if bad}

    out = {}
    fails = [(i, source or "", failing(i, text)) for i, text, source in docs]
    for part in {p for _, p, _ in fails}:
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            alive = [(i, f) for i, p, f in fails if p == part]
            gone = []
            for step, c in enumerate(order, 1):
                lost = [(i, f) for i, f in alive if c in f]
                alive = [(i, f) for i, f in alive if c not in f]
                out[part, order, step] = [
                    len(alive), len(lost), sum(c in f for _, f in gone), sum(f == {c} for _, p, f in fails if p == part),
                    sum(i in good for i, _ in lost if i is not None), sum(i in toxic for i, _ in lost if i is not None)]
                gone += lost
                shapley[c] += len(lost)
        for key in out:
            if key[0] == part:
                out[key].append(shapley[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in out.items()}


def check_audit(spark, docs, labels):
    d = spark.createDataFrame([(*r, 1, "m") for r in docs], "doc_id bigint, text string, source string, mask int, part string")
    found = spark.createDataFrame([(*r, "x") for r in labels], "doc_id bigint, quality int, toxic int, text string")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in filter_audit.audit(d, found).collect()}
    assert got == brute_audit(docs, labels)


def test_audit_matches_sql(spark):
    same_as_sql(spark, "op13_filter_audit")


def test_audit_matches_brute_force(spark):
    rng = random.Random(11)
    pool = [corpus(rng, n) + rng.choice(["", " 50%", " A|B"]) for n in (0, 3, 190, 210, 400)]
    pool += [" ".join(f"w{i}" for i in range(250)), " ".join(f"W{i}" for i in range(250)), None, ""]
    docs = [(rng.choice([None, *range(60)]), rng.choice(pool), rng.choice([None, "", "a", "b"])) for _ in range(90)]
    labels = [(i % 40, i % 2, rng.choice([0, 1, None])) for i in range(50)] + [(None, 1, 1)]
    check_audit(spark, docs, labels)


def test_audit_edges(spark):
    check_audit(spark, [], [])
    check_audit(spark, [(1, None, None)], [])
    # Copies of one text under one id, under no id, and in two parts.
    check_audit(spark, [(5, "x", "a"), (5, "x", "a"), (5, "x", "b"), (None, "x", "a"), (6, "x", "b"), (7, "y" * 200000, "b")],
                [(6, 1, 1), (6, 0, 0), (5, None, None)])

