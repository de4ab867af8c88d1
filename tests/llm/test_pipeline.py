"""The corpus pipeline against a brute-force version, stage by stage, and its edges."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from laminar.llm import quality_rules, toxicity
from test_models_and_search import brute_spans
from test_text_operators import WORD, brute_base, brute_components, brute_fingerprint, brute_pieces, check_layout


def hashes(text):
    return [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text or "")]


def grams(text, buckets):
    h = hashes(text)
    pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(h, h[1:])]
    return [(x - (1 << 64) if x >> 63 else x) % buckets for x in h + pairs]


def brute_quality(docs, labels):
    """Ids that the quality rules keep."""
    good = {r["doc_id"] for r in labels if r["quality"] == 1}
    buckets = 16384
    found = {r["doc_id"]: grams(r["text"], buckets) for r in docs}
    raw = Counter(b for g in found.values() for b in g)
    target = Counter(b for i, g in found.items() if i in good for b in g)
    n_raw, n_target = sum(raw.values()) + buckets, sum(target.values()) + buckets
    weight = [math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw) for b in range(buckets)]
    score = {i: float(np.mean([weight[b] for b in g])) if g else 0.0 for i, g in found.items()}
    trusted = [score[r["doc_id"]] for r in docs if r["doc_id"] in good and len(hashes(r["text"])) >= 10]
    limit = min(0.0, float(np.percentile(trusted, 0.2)))
    return {r["doc_id"] for r in docs if not brute_base(r["text"])[-1] and score[r["doc_id"]] >= limit - 1e-12}


def brute_toxic(docs, model):
    """Ids that the chain calls toxic, one document at a time."""
    out = set()
    for r in docs:
        on = np.zeros(len(model.features))
        on[[model.features[t] for t in toxicity.terms(r["text"]) if t in model.features]] = 1
        chain = []
        for w in model.weights:
            z = on @ w[:len(on)] + np.dot(w[len(on):-1], chain) + w[-1]
            chain.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        if chain and chain[-1] >= model.threshold:
            out.add(r["doc_id"])
    return out


def brute_first(docs):
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs]
    return {i for (i, _, component) in brute_components(rows) if i == component}


def brute_private(docs):
    """id -> text with base spans and revealing terms replaced; different texts are the events."""
    label = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}
    marks, words, places = {}, {}, {}
    for t in {r["text"] or "" for r in docs}:
        marks[t] = []
        for kind, spans in brute_spans(t).items():
            for a, b in spans:
                plain = t[a:b].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", t[a:b])
                marks[t].append((a, b, f"{kind}:{plain}", label[kind]))
        rest = list(t)
        for a, b, entity, _ in marks[t]:
            if entity.startswith("email:"):
                rest[a:b] = " " * (b - a)
        words[t] = {w.lower() for w in re.findall(r"[^\W_]+", "".join(rest)) if re.search(r"[^\W\d_]", w)}
        places[t] = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", t)
                     if not any(a < m.end() and m.start() < b for a, b, _, _ in marks[t])]
    entities = {t: {m[2] for m in marks[t]} for t in marks}
    n = len(marks) - 1
    n_t = Counter(w for t in words for w in words[t])
    n_c = Counter(e for t in entities for e in entities[t])
    n_ct = Counter((e, w) for t in words for e in entities[t] for w in words[t])
    tells = {(e, w): math.log2((k - 1) * n / ((n_c[e] - 1) * (n_t[w] - 1))) / math.log2(n / (n_c[e] - 1))
             for (e, w), k in n_ct.items() if k >= 2 and n_c[e] <= n}
    out = {}
    for r in docs:
        t = r["text"] or ""
        edits = [(a, b, x) for a, b, _, x in marks[t]]
        for w, a, b in places[t]:
            d = max((tells.get((e, w.lower()), 0) for e in entities[t]), default=0)
            shape = "<CODE>" if re.search(r"\d", w) else "<NAME>" if w[0].isupper() else "<WORD>"
            edits += [(a, b, "" if d >= 0.8 else shape)] if d >= 0.6 else []
        merged = []
        for a, b, x in sorted(edits):
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b, x])
        for a, b, x in reversed(merged):
            t = t[:a] + x + t[b:]
        out[r["doc_id"]] = t if r["text"] is not None else None
    return out


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's input and output rows, run as the pipeline runs them."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = []
    for name, f in corpus_pipeline.STAGES:
        after = corpus_pipeline.materialise(f(spark, docs, SF_SMALL), "test-stage")
        out.append((name, docs, after))
        docs = after
    return out


def test_the_stages_are_in_order(stages):
    assert [n for n, *_ in stages] == ["quality_rules", "toxicity", "simhash", "pii", "packing"]
    for _, before, after in stages[:-1]:
        assert before.dtypes == after.dtypes


def test_stages_match_brute_force(spark, stages):
    labels_table = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = [(before.collect(), after.collect()) for _, before, after in stages]

    def ids(rs):
        return {r["doc_id"] for r in rs}

    before, after = rows[0]
    assert ids(after) == brute_quality(before, labels_table.collect())
    assert Counter(map(tuple, after)) == Counter(tuple(r) for r in before if r["doc_id"] in ids(after))
    before, after = rows[1]
    assert ids(after) == ids(before) - brute_toxic(before, toxicity.fit(stages[1][1], labels_table))
    before, after = rows[2]
    assert ids(after) == brute_first(before) and len(after) == len(ids(after))
    before, after = rows[3]
    want = brute_private(before)
    assert {r["doc_id"]: r["text"] for r in after} == want
    assert any("<EMAIL>" in t or "<CARD>" in t or "<PHONE>" in t or "<IP>" in t for t in want.values())
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    before, after = rows[4]
    pieces = Counter(p for r in before for p in brute_pieces(r["doc_id"], r["text"]))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in after) == pieces
    check_layout(after, 2048)


def test_run_gives_the_last_stage(spark, stages):
    digest = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SF_SMALL).select(*digest)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, stages[-1][2].select(*digest).collect()))


def test_stages_on_odd_rows(spark, area):
    """NULLs in every column, empty and repeated rows, extra columns; then no rows at all."""
    text = "these are ten plain words of a kind note number "
    rows = [(1, text + "one", "en", "s", 1), (1, text + "one", "en", "s", 1), (2, None, None, None, None), (None, text + "two", None, "s", 3),
            (None, text + "two", None, "s", 3), (3, "", "", "", 0), (4, text + "mail a@b.co " + "x" * 4000, "en", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int").withColumn("length", F.lit("own"))
    spark.createDataFrame([(9, 1, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{area}/labels.parquet")
    found = {}
    at = docs
    for name, f in corpus_pipeline.STAGES[:-1]:
        at = corpus_pipeline.materialise(f(spark, at, area), "odd")
        assert at.columns == docs.columns
        found[name] = Counter(r["doc_id"] for r in at.collect())
    assert found["quality_rules"] == found["toxicity"] == Counter({1: 2, None: 2, 4: 1})
    assert found["simhash"] == found["pii"] == Counter({1: 1, None: 2, 4: 1})
    assert "<EMAIL>" in at.where("doc_id = 4").first()["text"]
    name, last = corpus_pipeline.STAGES[-1]
    assert last(spark, at, area).count() == 4
    none = docs.limit(0)
    for name, f in corpus_pipeline.STAGES:
        none = corpus_pipeline.materialise(f(spark, none, area), "none")
        assert none.count() == 0


def test_unlike_texts_under_one_id_both_stay(spark, area):
    one, two = ("one kind of words " + "alpha beta gamma delta " * 5, "another " + "sigma tau omega phi rho " * 6)
    rows = [(1, one), (1, two), (1, two), (2, one), (3, two), (None, one)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("root", F.lit("own"))
    got = corpus_pipeline.near_duplicates(spark, docs, area)
    assert got.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter([(1, one), (1, two), (None, one)])


def test_quality_stage_filters_by_the_verdict_column(spark):
    """The filter on the verdict must not change what the unfiltered rows say."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = quality_rules.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    judged = quality_rules.judge(docs, model)
    kept = {r["doc_id"] for r in judged.where("kept").select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in judged.collect() if r["kept"]}
