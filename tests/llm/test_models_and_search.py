"""Personal data, language model, toxicity, url filters and vector search against brute
force, with NULLs, empty and long texts, ties, repeated rows, empty tables and clashes."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from laminar.llm import ann, lm_scoring, packing, pii, queries, toxicity, url_filters

DOCS = "doc_id bigint, text string, lang string, source string, n_chars int"
SF = SF_SMALL.replace("0.001", "0.01")


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)], DOCS)


# ---------------------------------------------------------------- personal data
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
            "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def brute_spans(text):
    return {k: [m.span() for m in re.finditer(p, text or "") if valid(k, m.group())] for k, p in PATTERNS.items()}


def test_base_spans_match_brute_force(spark):
    import hashlib
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op2_pii(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        want = brute_spans(t)
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [len(want[k]) for k in PATTERNS]
        joined = ",".join(f"{k}:{a}:{b}" for k in PATTERNS for a, b in want[k])
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert got[i]["spans"] == joined or got[i]["spans"].startswith(joined)


TRICKY = [None, "", "a@b", "a@b.c", "x@y.z_q@w.e", "..@..", "a@b..c", "a@b.c-d_x@y.z", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.256",
          "0001.002.003.0255", "1.2.3", "4111111111111111", "4111 1111-1111 1111", "5 - 4111111111111111", "41111111111111111111111",
          "+1 (555) 123-4567", "+12", "+1........2", "+123456789+987654321", "\U0001F600 é+49 30 1234567 ü a@b.co 4111111111111111 10.0.0.1",
          "1 " * 3000, "9" * 5000, "a" * 20000 + "@", "a." * 5000 + "@x.y", "+" + "1 " * 4000, "1." * 4000, "x@" + "y." * 3000 + "z"]


def test_spans_of_tricky_texts(spark):
    rng = random.Random(1)
    texts = TRICKY + ["".join(rng.choice("ab1290.@+- ()_") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    ids = [None, None] + list(range(len(texts) - 2))
    got = pii.find(frame(spark, texts, ids).withColumn("email", F.lit("clash"))).collect()
    want = Counter((i, *[tuple(s) for s in brute_spans(t).values()]) for i, t in zip(ids, texts))
    assert Counter((r["id"], *[tuple((s["start"], s["end"]) for s in r[k]) for k in PATTERNS]) for r in got) == want
    assert pii.find(frame(spark, [])).count() == 0


def revealing(spark):
    """One person's address stands in six different texts, each time near a rare byname."""
    told = [f"note {i} the and Zanzibo Quark: jo@ex.org wrote about item{i} and the rest of it" for i in range(6)]
    rest = [f"plain text {i} the and about rest of it wrote note" for i in range(40)]
    return told, rest


def test_terms_that_reveal_an_entity(spark):
    told, rest = revealing(spark)
    docs = frame(spark, told + rest)
    rows = {r["id"]: r for r in pii.find(docs).collect()}
    for i, t in enumerate(told):
        named = {t[s["start"]:s["end"]].lower() for s in rows[i]["term"]}
        assert named == {"zanzibo", "quark"}
        assert all(s["action"] == "remove" for s in rows[i]["term"])
    assert all(not rows[i]["term"] for i in range(6, 46))


def flagged(docs):
    marked = pii.materialise(pii._marked(docs, "doc_id", "text"), "test-marked")
    pairs = pii.cooccurrences(docs, marked, pii._holders(marked))
    return {(r["entity"], r["term"]): r["disclosure"] for r in pii.flagged_terms(pairs).collect()}


def test_disclosure_by_its_definition(spark):
    told, rest = revealing(spark)
    # "quark" stands in two other texts as well: 6 of its 8 texts hold the address.
    docs = frame(spark, told + [rest[0] + " quark", rest[1] + " Quark", *rest[2:]])
    got = flagged(docs)
    assert got["email:jo@ex.org", "zanzibo"] == pytest.approx(1.0)
    assert got["email:jo@ex.org", "quark"] == pytest.approx(math.log2(5 * 45 / (5 * 7)) / math.log2(45 / 5))
    assert got["email:jo@ex.org", "quark"] > 0.8 and len(got) == 2


def test_a_far_name_in_every_text_goes(spark):
    filler = "the and of it wrote plain text about rest note " * 4
    told = [f"Zanzibarius {filler} part{i} jo@ex.org, +49 30 1234567 {filler} note zanzibarius" for i in range(5)]
    docs = frame(spark, told + [f"{filler} other{i}" for i in range(40)])
    rows = {r["id"]: r for r in pii.find(docs).collect()}
    for i, t in enumerate(told):
        assert [t[s["start"]:s["end"]] for s in rows[i]["term"]] == ["Zanzibarius", "zanzibarius"]
    assert all(not rows[i]["term"] for i in range(5, 45))


def test_two_texts_are_evidence_and_one_is_not(spark):
    rest = [f"plain text {i} the and about rest of it wrote note" for i in range(40)]
    docs = frame(spark, ["note by Quark: jo@ex.org", "about Quark wrote jo@ex.org", "rest Flummox al@ex.org it", *rest])
    assert set(flagged(docs)) == {("email:jo@ex.org", "quark")}


def test_generalised_terms_get_a_class(spark):
    row = spark.createDataFrame([("Ann ann x9y @", {"ann": "generalise", "x9y": "generalise"})], "t string, m map<string,string>")
    marks = F.array().cast("array<struct<start:bigint,end:bigint>>")
    got = row.select(pii._places(F.col("t"), marks, F.col("m")).alias("p")).first()["p"]
    assert [(p["start"], p["end"], p["label"]) for p in got] == [(0, 3, "<NAME>"), (4, 7, "<WORD>"), (8, 11, "<CODE>")]


def test_copies_are_no_evidence_of_their_own(spark):
    told, rest = revealing(spark)
    rows = pii.find(frame(spark, [told[0]] * 8 + rest)).collect()
    assert all(not r["term"] for r in rows) and len(rows) == 48


def test_sanitised_texts(spark):
    told, rest = revealing(spark)
    texts = told + rest + [None, "", "mail a@b.co now", "x 10.0.0.1 y +49 30 1234567", "mail a@b.co now"]
    docs = frame(spark, texts, list(range(len(texts) - 1)) + [None]).withColumn("extra", F.lit(7))
    out = pii.sanitise(docs)
    assert out.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    want = Counter()
    for r, t in zip(docs.collect(), texts):
        if t is not None:
            t = t.replace("jo@ex.org", "<EMAIL>").replace("a@b.co", "<EMAIL>").replace("10.0.0.1", "<IP>").replace("+49 30 1234567", "<PHONE>")
            t = t.replace("Zanzibo", "").replace("Quark", "")
        want[(r["doc_id"], t)] += 1
    assert got == want


def test_overlapping_edits_merge(spark):
    edits = F.array(*[F.struct(F.lit(a).cast("bigint").alias("start"), F.lit(b).cast("bigint").alias("end"), F.lit(x).alias("label"))
                      for a, b, x in ((0, 3, "<A>"), (2, 5, "<B>"), (5, 6, "<C>"), (8, 9, ""))])
    row = spark.createDataFrame([("0123456789é",)], "t string").select(pii._rewrite(F.col("t"), edits).alias("t")).first()
    assert row["t"] == "<A><C>679é"


# ---------------------------------------------------------------- language model
def test_base_scores_match_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in queries.op3_lm_scoring(spark, SF).collect()}
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in rows}
    split = {r["doc_id"]: [*r["text"].encode().lower().split(), None] for r in rows}
    count = Counter(w for i, ws in split.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    assert got.keys() == split.keys()
    for i, ws in split.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(count[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        assert r["score"] < 0 and math.isfinite(r["score"])


def random_tables(rng):
    return lm_scoring.bigram_tables(rng.random((lm_scoring.CLASSES, lm_scoring.CLASSES)))


def test_every_id_is_scored_once_and_later_ids_are_hidden():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 9, n) for n in (1, 2, 31, 32, 33, 100)]
    inputs, targets, owner, numbers = lm_scoring.windows(texts, 9)
    for i, t in enumerate(texts):
        mine = targets[owner == i]
        assert mine[mine >= 0].tolist() == t.tolist()
        assert numbers[owner == i].tolist() == list(range(-(-len(t) // lm_scoring.STRIDE)))
    parts, tables = lm_scoring.unpack(lm_scoring.first_weights() * 3), random_tables(rng)
    before = lm_scoring.log_probabilities(parts, tables, inputs, targets)
    changed = texts[-1].copy()
    changed[60:] = (changed[60:] + 1) % 9
    a, b, _, _ = lm_scoring.windows([changed], 9)
    after = lm_scoring.log_probabilities(parts, tables, a, b)
    same = before[owner == 5].ravel()[:60], after.ravel()[:60]
    assert np.allclose(*same, atol=1e-4) and not np.allclose(before[owner == 5].ravel()[61:100], after.ravel()[61:100])


def test_windows_score_alike_in_any_batch():
    rng = np.random.default_rng(3)
    inputs, targets, _, _ = lm_scoring.windows([rng.integers(0, lm_scoring.CLASSES, n) for n in (500, 3, 90)], 0)
    parts, tables = lm_scoring.unpack(lm_scoring.first_weights() * 8), random_tables(rng)
    together = lm_scoring.log_probabilities(parts, tables, inputs, targets)
    single = [lm_scoring.log_probabilities(parts, tables, inputs[i:i + 1], targets[i:i + 1])[0] for i in range(len(inputs))]
    assert np.allclose(together, np.stack(single), atol=1e-3)
    assert lm_scoring.log_probabilities(parts, tables, inputs[:0], targets[:0]).shape == (0, lm_scoring.STRIDE)


def test_class_probabilities_sum_to_one_and_gradient_is_right():
    rng = np.random.default_rng(1)
    weights, tables = (lm_scoring.first_weights() * 2).astype(np.float32), random_tables(rng)
    inputs, targets, _, _ = lm_scoring.windows([rng.integers(0, 12, 30)], 0)
    parts = lm_scoring.unpack(weights)
    total = sum(np.exp(lm_scoring.log_probabilities(parts, tables, inputs, np.where(targets >= 0, c, -1)))
                for c in range(lm_scoring.CLASSES))
    assert np.allclose(total[targets >= 0], 1, atol=1e-4)

    def loss(w):
        logs = lm_scoring.log_probabilities(lm_scoring.unpack(w), tables, inputs, targets)
        return -logs.sum() / (targets >= 0).sum()

    grad = lm_scoring.gradient(weights, tables, inputs, targets, np.arange(lm_scoring.STRIDE))
    largest = np.argsort(-np.abs(grad))[:60]
    for i in [*largest, *rng.choice(len(weights), 20, replace=False)]:
        step = np.zeros_like(weights)
        step[i] = 1e-2
        assert (loss(weights + step) - loss(weights - step)) / 2e-2 == pytest.approx(grad[i], abs=2e-3)


def test_a_gradient_is_made_in_chunks_of_windows():
    import tracemalloc
    rng = np.random.default_rng(4)
    tables, at = random_tables(rng), np.arange(lm_scoring.STRIDE)
    inputs, targets, _, _ = lm_scoring.windows([rng.integers(0, lm_scoring.CLASSES, 32 * 7 + 5) for _ in range(64)], 0)

    def peak(weights, n):
        tracemalloc.start()
        lm_scoring.gradient(weights, tables, inputs[:n], targets[:n], at)
        try:
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    for weights in (lm_scoring.first_weights(), lm_scoring.first_weights() * 20):        # small and large exponents
        whole, count = lm_scoring.gradient(weights, tables, inputs, targets, at), (targets >= 0).sum()
        parts = sum(lm_scoring.gradient(weights, tables, inputs[i:i + 100], targets[i:i + 100], at)
                    * ((targets[i:i + 100] >= 0).sum() / count) for i in range(0, len(inputs), 100))
        assert np.isfinite(whole).all() and np.allclose(whole, parts, rtol=1e-3, atol=1e-4 * np.abs(whole).max())
        assert peak(weights, 512) < 2 * peak(weights, 128)


def test_similar_centres_share_a_block():
    rng = np.random.default_rng(0)
    far = np.repeat(np.eye(4) * 10, 6, axis=0) + rng.standard_normal((24, 4)) * 0.01
    mixed = rng.permutation(24)
    order = lm_scoring.in_order(far[mixed], 4)
    assert sorted(order) == list(range(24))
    assert all(len(set(mixed[order[i:i + 6]] // 6)) == 1 for i in range(0, 24, 6))


def test_attention_learns_what_bigrams_cannot():
    """Texts alternate a filler with words of one of two groups: the group is further back."""
    rng = np.random.default_rng(0)

    def text():
        t = np.zeros(60, dtype=np.int32)
        t[1::2] = rng.integers(1, 4, 30) + 3 * rng.integers(0, 2)
        return t

    train, held = ([text() for _ in range(n)] for n in (600, 100))
    pairs = np.full((lm_scoring.CLASSES, lm_scoring.CLASSES), 1e-6)
    for t in train:
        np.add.at(pairs, (np.r_[7, t[:-1]], t), 1)
    tables = lm_scoring.bigram_tables(pairs)
    inputs, targets, _, _ = lm_scoring.windows(train, 7)
    opt = lm_scoring.Adam(lm_scoring.first_weights(), 0.02)
    for step in range(300):
        pick = rng.choice(len(inputs), 128)
        opt.step(lm_scoring.gradient(opt.w, tables, inputs[pick], targets[pick], np.arange(step % 4, lm_scoring.STRIDE, 4)))
    inputs, targets, _, _ = lm_scoring.windows(held, 7)
    scores = [lm_scoring.log_probabilities(lm_scoring.unpack(w), tables, inputs, targets).sum()
              for w in (opt.w, np.zeros_like(opt.w))]
    assert scores[0] > 0.75 * scores[1]            # about log 3 instead of log 6 for every second word


def test_every_position_of_a_training_window_is_a_target(spark):
    rng = np.random.default_rng(2)
    cls, tables, weights = np.arange(lm_scoring.VOCABULARY) % lm_scoring.CLASSES, random_tables(rng), lm_scoring.first_weights()
    ids = rng.integers(0, 300, 70).astype("<u2")
    rows = spark.createDataFrame([(ids.tobytes(),)], "ids binary").coalesce(1)
    inputs, targets, _, _ = lm_scoring.windows([cls[ids]], int(cls[lm_scoring.START]))
    for number in (0, 1):                                     # windows 0 and 2, then window 1
        mine = np.flatnonzero(np.arange(3) % 2 == number)
        mine = mine[np.random.default_rng(number).permutation(len(mine))]
        want = lm_scoring.Adam(weights, 0.01 / (1 + number))
        want.step(lm_scoring.gradient(weights, tables, inputs[mine], targets[mine], np.arange(lm_scoring.STRIDE)))
        got = lm_scoring._round(rows, cls, tables, weights, number, 2, 0.01)
        assert np.allclose(got, want.w, atol=1e-6)


def test_model_beats_unigram_words_on_held_out_text(spark):
    sf = SF_SMALL.replace("0.001", "0.1")
    held = queries.op3_lm_scoring(spark, sf).where("held_out").agg(F.sum("score").alias("m"), F.sum("base_score").alias("b")).first()
    assert held["m"] > held["b"]


def test_lm_edges(spark):
    texts = [None, "", " \n", "a", "a b " * 4000, "Ünï 日本 \U0001F600", "A a", "A a"]
    docs = frame(spark, texts, [None, 1, 2, 3, 4, 5, 6, 6]).withColumn("row", F.lit("clash"))
    vocabulary = queries.vocabulary_path("word_bpe_49k.json")
    for share in (4e-6, 0.5):                                 # all words heavy, and most by the join
        got = lm_scoring.score(docs, vocabulary, heavy_share=share).collect()
        assert Counter(r["n_tokens"] for r in got) == Counter([1, 1, 1, 2, 8001, 4, 3, 3])
        keep = [(i, t) for i, t in zip([None, 1, 2, 3, 4, 5, 6, 6], texts) if zlib.crc32(str("" if i is None else i).encode()) % 10]
        count = Counter(w for _, t in keep for w in [*(t or "").lower().split(), None])
        n, v = sum(count.values()), len(count)
        want = Counter()
        for t in texts:
            ws = [*(t or "").lower().split(), None]
            want[(len(ws), sum(count[w] > 0 for w in ws), round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6))] += 1
        assert Counter((r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert lm_scoring.score(docs.limit(0), vocabulary).count() == 0
    alone = lm_scoring.score(docs.where("doc_id IS NULL"), vocabulary).first()     # no training row
    assert alone["train_tokens"] == 0 and alone["n_known"] == 0 and alone["score"] == pytest.approx(-math.log10(49408))


def test_different_chunks_are_encoded_once_and_together():
    from tokenizers import Tokenizer

    from laminar.llm.common import split_words
    vocabulary = queries.vocabulary_path("word_bpe_49k.json")
    texts = ["It's an onthering, onthering\tAÉß. x", None, "", " \n ", "<|endoftext|> 日本 \u0130 e\u0301 \x1f", "ab" * 50 + " " + "c" * 64,
             "12 a's 'S thoninti&&& ***", "\u01c6 Ł\u0301 J\u030c"]
    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True
    want = [tokenizer.encode(w, add_special_tokens=False).ids for t in texts for w in (t or "").encode().split() for w in [w.decode()]]
    sizes = [len((t or "").encode().split()) for t in texts]
    coder = packing.WordEncoder(vocabulary, cache_size=4)
    for _ in range(2):                                      # all new, then all known
        words = split_words(pa.array(texts, pa.string()))
        ids, counts = coder.encode(words)
        assert words.sizes.tolist() == sizes and len(words.kinds) == len(set(words.kinds.to_pylist()))
        assert ids.tolist() == [i for w in want for i in w]
        ends = np.cumsum([0, *sizes])
        assert counts.tolist() == [sum(map(len, want[a:b])) for a, b in zip(ends, ends[1:])]
        assert set(coder.known) == {w for t in texts for w in (t or "").encode().split()} and coder.full
    coder.clear()
    assert coder.encode(split_words(pa.array([], pa.string())))[0].size == 0 and not coder.full


def test_words_are_counted_in_the_pass_that_encodes(spark):
    texts, ids = ["The the  THE É é", None, "", "a The", "x"], [3, 1, 2, 4, None]
    docs, counts = lm_scoring.encode(frame(spark, texts, ids), queries.vocabulary_path("word_bpe_49k.json"))
    rows = docs.collect()
    assert Counter(r["text"] for r in rows) == Counter(t or "" for t in texts) and len({r["row"] for r in rows}) == len(texts)
    assert all(np.frombuffer(r["ids"], "<u2").tolist().index(lm_scoring.END) == len(r["ids"]) // 2 - 1 for r in rows)
    trained = [t for t, i in zip(texts, ids) if zlib.crc32(str("" if i is None else i).encode()) % 10]
    assert {r["word"]: r["c"] for r in counts.collect()} == Counter(
        w.decode() for t in trained for w in (t or "").encode().lower().split())


# ---------------------------------------------------------------- toxicity
def test_toxicity_on_held_out_labels(spark):
    sf = SF_SMALL.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi").select("doc_id", "text")
    model = toxicity.fit(docs, labels.where("doc_id % 2 = 0"))
    seen = toxicity.judge(docs, model, keep=["doc_id"]).join(labels.where("doc_id % 2 = 1"), "doc_id")
    found = {(r["toxic"], r["is_toxic"]): r["count"] for r in seen.groupBy("toxic", "is_toxic").count().collect()}
    assert found[1, True] / (found[1, True] + found[1, False]) > 0.8
    assert found.get((0, True), 0) / (found.get((0, True), 0) + found[0, False]) < 0.01


def test_chain_feeds_probabilities_forward():
    x = toxicity.rows_of([[0], [1], [0, 1], []], 2)
    weights = [np.array([4.0, 0.0, -2.0]), np.array([0.0, 0.0, 8.0, -4.0])]
    first, second = toxicity.apply_chain(x, weights)
    assert np.allclose(first, toxicity.sigmoid(np.array([2.0, -2, 2, -2])))
    assert np.allclose(second, toxicity.sigmoid(8 * first - 4))


def test_linear_fit_reaches_the_optimum():
    rng = np.random.default_rng(0)
    found = [sorted(rng.choice(6, rng.integers(0, 4), replace=False).tolist()) for _ in range(400)]
    y = np.array([float(0 in f or rng.random() < 0.1) for f in found])
    x = toxicity.rows_of(found, 6)
    w = toxicity.fit_linear(x, y, ridge=1.0, steps=3000)
    grad = x.back(toxicity.sigmoid(x.times(w)) - y) + np.r_[w[:-1], 0.0]
    assert np.abs(grad).max() < 1e-3 and w[0] == max(w[:6])


def test_toxicity_edges(spark):
    texts = [None, "", "you idiot " * 3, "x" * 5000, "fine words"]
    docs = frame(spark, texts + texts, list(range(9)) + [None]).withColumn("y", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, none)
    assert toxicity.judge(docs, model).where("is_toxic").count() == 0
    assert toxicity.judge(docs, model).drop(*[f"toxic_{c}" for c in toxicity.CHAIN], "is_toxic").exceptAll(docs).count() == 0
    assert toxicity.judge(docs.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        toxicity.judge(docs.withColumn("is_toxic", F.lit(1)), model)
    many = frame(spark, [f"you moron number{i}" if i % 3 == 0 else f"a kind note number{i}" for i in range(150)])
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(100)] + [(1, 1, 1), (None, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r["is_toxic"] for r in toxicity.judge(many, toxicity.fit(many, labels), keep=["doc_id"]).collect()}
    assert all(got[i] == (i % 3 == 0) for i in range(150))


# ---------------------------------------------------------------- url filters
def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    best = None
    for r in url_filters.RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.text) > len(best.text)):
            best = r
    return host, path, best and best.text, best and best.verdict


def test_rules_match_brute_force(spark):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in queries.op9_url_filters(spark, SF).collect()}
    assert got.keys() == urls.keys()
    for i, u in urls.items():
        host, path, rule, verdict = brute_rule(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] in ("allow", "block") and verdict in (None, got[i]["verdict"])


URLS = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.Com/EN/x", "http://example.com/en/x", "http://example.com/en", "http://example.com",
        "http://example.com?x=/en/", "http://www.example.com/en/1", "http://a.www.example.com/en/1", "http://badexample.com/en/", "x://net/es/",
        "http://a.net/fr/b", "http://a.net:80/fr/b", "http://a.net/de/", "a://b://c.net/es/", "http://İ.com/\U0001F600", "http://x.com/" + "a/" * 3000,
        "http://a.com/\nq", "http://com#/x", "http://a.com//"]


def test_url_edges(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(None, URLS[5]), (5, URLS[5])], "page_id bigint, url string")
    got = url_filters.judge(pages.withColumn("host", F.lit("clash"))).collect()
    want = Counter((i, *brute_rule(u)[:3]) for i, u in [*enumerate(URLS), (None, URLS[5]), (5, URLS[5])])
    assert Counter((r["id"], r["host"], r["path"], r["rule"]) for r in got) == want
    assert url_filters.judge(pages.limit(0)).count() == 0


def test_templates_generalise_merge_and_reject(spark):
    """One host: ads/<digits> is blocked where rules reach it, news and blog are alike."""
    rules = (url_filters.Rule("block", "h.org", "/ads/1"), url_filters.Rule("allow", "h.org", "/news/1"))
    urls = [f"http://h.org/{kind}/{i}" for kind in ("ads", "news", "blog") for i in range(100, 300)]
    urls += [f"http://h.org/slug-{i}x/page" for i in range(30)] + [f"http://h.org/{w}" for w in ("alpha", "beta", "gamma")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rows = {r["path"]: r for r in url_filters.judge(pages, rules=rules).collect()}
    assert rows["/ads/250"]["template"] == "/ads/*" and rows["/ads/250"]["verdict"] == "block" and rows["/ads/250"]["rule"] is None
    assert rows["/news/250"]["verdict"] == rows["/blog/250"]["verdict"] == "allow"
    assert rows["/slug-3x/page"]["template"] == "/*/page"
    assert rows["/alpha"]["template"] == rows["/beta"]["template"] == "/*"
    same = [f"http://g.org/{kind}/{i}" for kind in ("en", "de") for i in range(50)]
    pages = spark.createDataFrame(list(enumerate(same)), "page_id bigint, url string")
    assert {r["template"] for r in url_filters.judge(pages).collect()} == {"/de|en/*"}


def test_a_blocked_section_does_not_block_its_neighbours(spark):
    """Sixty sections beside one blocked one; a host of three urls; many alike sections."""
    urls = [f"http://big.net/sec{chr(97 + i // 26)}{chr(97 + i % 26)}/p{j}x" for i in range(60) for j in range(10)]
    clean = len(urls)
    urls += [f"http://big.net/es/p{j}x" for j in range(10)] + ["http://b.net/es/x", "http://b.net/about/x", "http://b.net/help/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rows = {r["id"]: r for r in url_filters.judge(pages).collect()}
    assert len(rows) == len(urls)
    assert {rows[i]["verdict"] for i in range(clean)} == {"allow"}
    assert {rows[i]["verdict"] for i in range(clean, clean + 11)} == {"block"}
    assert rows[clean + 11]["verdict"] == rows[clean + 12]["verdict"] == "allow"
    assert {rows[i]["template"] for i in range(clean)} == {"/secaa|secab|secac|secad|secae|secaf|secag|secah|+52/*"}


def test_templates_reach_below_the_third_segment(spark):
    rules = (url_filters.Rule("block", "h.org", "/a/b/c/ads/1"), url_filters.Rule("allow", "h.org", "/a/b/c/news/1"))
    urls = [f"http://h.org/a/b/c/{kind}/{i}" for kind in ("ads", "news") for i in range(100, 300)] + ["http://k.org/" + "z/" * 50] * 6
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rows = {r["path"]: r for r in url_filters.judge(pages, rules=rules).collect()}
    assert (rows["/a/b/c/ads/250"]["template"], rows["/a/b/c/ads/250"]["verdict"]) == ("/a/b/c/ads/*", "block")
    assert (rows["/a/b/c/news/250"]["template"], rows["/a/b/c/news/250"]["verdict"]) == ("/a/b/c/news/*", "allow")
    assert rows["/" + "z/" * 50]["template"] == "/" + "z/" * 50


# ---------------------------------------------------------------- vector search
def brute_nearest(rows, divisor, top=5):
    """query id -> exact sorted list of (-score, id)."""
    vectors = [(i, np.array(v, dtype=float)) for i, v in rows]
    out = {}
    for q, a in vectors:
        if q % divisor == 0:
            near = sorted((-float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), i) for i, b in vectors if i != q)
            out[q] = near[:top]
    return out


def test_recall_and_scores(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/embeddings.parquet").collect()]
    want = brute_nearest(rows, 50)
    got = defaultdict(list)
    for r in queries.op10_ann(spark, SF_SMALL.replace("0.001", "0.1")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert got.keys() == want.keys()
    exact = {q: {i: -s for s, i in brute_nearest([r for r in rows if r[0] == q] + [r for r in rows if r[0] != q], q or 1, 10 ** 9)[q]}
             for q in list(want)[:3]}
    for q, scores in exact.items():
        assert all(s == pytest.approx(scores[i], abs=1e-12) for _, i, s in got[q])
    for q, found in got.items():
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i in near}) for q, near in want.items())
    assert hits / (5 * len(want)) >= 0.9


def test_search_edges(spark):
    rng = np.random.default_rng(0)
    hot = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, hot) for i in range(0, 40)] + [(i, [2 * x for x in hot]) for i in range(40, 44)]
    rows += [(100 + i, rng.standard_normal(4).tolist()) for i in range(60)]
    odd = [(200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan")] * 4), (204, [float("inf"), 0.0, 0.0, 0.0]),
           (205, [1.0, 2.0]), (None, hot), (206, []), (0, hot), (207, [1e300, 2e300, 3e300, 4e300])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id bigint, embedding array<double>, gid int")
    got = defaultdict(list)
    for r in ann.search(table, lambda c: c % 20 == 0, probes=400, chunk=8, block=4).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["id"], r["score"]))
    assert got.keys() == {0, 20, 40, 100, 120, 140}
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[20]] == [0, 1, 2, 3, 4]
    usable = [(i, v) for i, v in rows if True]
    want = brute_nearest(usable + [(207, [x * 1.0 for x in hot])], 20)
    for q in (100, 120, 140):
        assert [round(s, 9) for _, s in got[q]] == [round(-s, 9) for s, _ in want[q]]
    few = table.where("vec_id IN (100, 101)")
    assert [(r["query_id"], r["rank"], r["id"]) for r in ann.search(few, lambda c: c % 20 == 0, probes=400).collect()] == [(100, 1, 101)]
    assert ann.search(table.limit(0), lambda c: c % 20 == 0).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_small_tables_return_all_candidates_at_production_parameters(spark, seed):
    """Few vectors in many dimensions seldom share a probed bucket; none may be lost."""
    rng = np.random.default_rng(seed)
    rows = [(i, rng.standard_normal(64).tolist()) for i in range(0, 300, 50)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    want = brute_nearest(rows, 50)
    got = defaultdict(list)
    for r in ann.search(table, lambda c: c % 50 == 0, chunk=4, block=3).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["id"], round(r["score"], 9)))
    assert {q: len(v) for q, v in got.items()} == {i: 5 for i, _ in rows}
    assert all(got[q] == [(i, round(-s, 9)) for s, i in want[q][:5]] for q in got)


def test_probes_come_in_order_of_estimated_success():
    place = np.array([0.1, 0.45, 0.8])
    got = ann.probe_buckets(place, 27)
    assert len({tuple(b) for b in got}) == len(got) == 27

    def cost(b):
        d = b - np.floor(place)
        return sum((place[i] - np.floor(place[i])) ** 2 if s < 0 else (1 - (place[i] - np.floor(place[i]))) ** 2 if s > 0 else 0
                   for i, s in enumerate(d))

    costs = [cost(b) for b in got]
    assert costs == sorted(costs)


def test_fit_sample_has_one_row_of_an_id(spark):
    """Repeated rows and several texts of a labelled id are one row; which one does not depend on their order."""
    rows = [(1, "a")] * 50 + [(1, "b")] * 30 + [(2, None), (2, None), (3, ""), (None, "x"), (4, "left out")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (None, 1), (4, 0), (4, 1)], "doc_id bigint, toxic int")
    got = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id bigint, text string").repartition(3)
        got.append(sorted((r["id"], r["text"] or "", r["y"]) for r in toxicity.labelled_sample(docs, labels, "doc_id", "text", 100).collect()))
    assert got[0] == got[1] and [(i, y) for i, _, y in got[0]] == [(1, 1), (2, 0), (3, 0)]
