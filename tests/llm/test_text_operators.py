"""Quality rules, SimHash, byte-level BPE, token counts and packing against brute force,
with NULLs, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import functools
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF_SMALL
from laminar.llm import byte_bpe, packing, quality_rules, queries, simhash, token_counts

DOCS = "doc_id bigint, text string, lang string, source string, n_chars int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)], DOCS)


ODD = [None, "", " \t\n", "a", "one two", "tie tie tie", "x" * 3000, ("ab cd " * 4000).strip(), "Ünï cödé 日本語 \U0001F600   nb",
       "line one\nline one\n\nline two\nline one", "don't WE'LL 123 4567 ###", "\x0b\x0c\x1c a\x1db", "ΑΣ ΟΔΟΣ İ ǅ"]


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(small):
    return {r["doc_id"]: r["text"] for r in small.collect()}


# ---------------------------------------------------------------- quality rules
def brute_base(text):
    words = WORD.findall(text or "")
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered), failed)


def measures(r):
    return tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))


def test_base_rules_match_brute_force(spark, texts):
    got = {r["doc_id"]: r for r in queries.op5_quality_rules(spark, SF_SMALL).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        assert measures(got[i]) == brute_base(t)
        assert not (got[i]["kept"] and got[i]["base_failed"])


def test_likelihood_ratio_matches_brute_force(spark):
    good, bad = ["alpha beta gamma delta " * 3 + str(i) for i in range(8)], ["zip zap zop " * 4 + str(i) for i in range(8)]
    docs = frame(spark, good + bad)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)] + [(8, 0, 0)], "doc_id bigint, quality int, toxic int")
    buckets = 64
    model = quality_rules.fit(docs, labels, buckets=buckets, quantile=0.0)

    def signed(h):
        return h - (1 << 64) if h >= 1 << 63 else h

    def grams(text):
        h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text)]
        pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
                 for a, b in zip(h, h[1:])]
        return [signed(x) % buckets for x in h + pairs]

    raw = Counter(b for t in good + bad for b in grams(t))
    target = Counter(b for t in good[:6] for b in grams(t))
    n_raw, n_target = sum(raw.values()) + buckets, sum(target.values()) + buckets
    weight = [np.log((target[b] + 1) / n_target) - np.log((raw[b] + 1) / n_raw) for b in range(buckets)]
    assert np.allclose(model.weights, weight)
    scores = {r["doc_id"]: r for r in quality_rules.judge(docs, model).collect()}
    for i, t in enumerate(good + bad):
        assert scores[i]["score"] == pytest.approx(np.mean([weight[b] for b in grams(t)]))
        assert scores[i]["kept"] == (not scores[i]["base_failed"] and scores[i]["score"] >= model.threshold)


def test_quality_rules_keep_good_and_reject_junk(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op5_quality_rules(spark, sf).join(labels, "doc_id").where("NOT base_failed")
    share = {r["quality"]: r["k"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert share[1] > 0.99 and share[0] < 0.1


def test_quality_edges(spark):
    docs = frame(spark, ODD + ["x"], list(range(len(ODD) - 1)) + [None, None]).withColumn("h", F.lit(1)).withColumn("i", F.lit(2))
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = quality_rules.fit(docs, none)
    assert set(model.weights) == {0.0} and model.threshold == 0.0
    rows = quality_rules.judge(docs, model).collect()
    assert Counter(measures(r) for r in rows) == Counter(brute_base(t) for t in ODD + ["x"])
    assert all(r["score"] == 0 and r["kept"] == (not r["base_failed"]) and r["i"] == 2 for r in rows)
    assert quality_rules.judge(docs.limit(0), model).count() == 0
    assert quality_rules.fit(docs.limit(0), none).threshold == 0.0
    twice = docs.unionByName(docs)
    assert quality_rules.judge(twice, model).count() == 2 * docs.count()
    with pytest.raises(ValueError):
        quality_rules.judge(docs.withColumn("kept", F.lit(1)), model)


def test_trusted_sample_is_bounded(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    ids = quality_rules.trusted_ids(labels, 500)
    assert 350 < ids.count() <= 600
    assert ids.exceptAll(quality_rules.trusted_ids(labels, 500)).count() == 0
    clash = labels.unionByName(labels.where("doc_id < 10").withColumn("quality", F.lit(0)))
    assert quality_rules.trusted_ids(clash, 10000).where("doc_id < 10").count() == 0


def test_every_trusted_document_is_counted_and_scored(spark):
    """More labelled rows than any bound: weights and threshold are those of all of them."""
    n, buckets = 24000, 64
    docs = spark.range(n).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN concat_ws(' ', array_repeat('zip zap', 6), 'w' || id) "
                                     "ELSE concat_ws(' ', array_repeat('alpha beta', 6), 'w' || id) END AS text")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 50 <> 1 AS int) AS quality", "0 AS toxic")
    counted = docs.select("doc_id", F.explode(quality_rules.ngram_buckets(quality_rules.hashed_words(F.col("text")), buckets)).alias("b"))
    raw, target = Counter(), Counter()
    for r in counted.groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.count_if(F.col("doc_id") % 50 != 1).alias("good")).collect():
        raw[r["b"]], target[r["b"]] = r["raw"], r["good"]
    model = quality_rules.fit(docs, labels, buckets=buckets, quantile=0.01)
    n_raw, n_target = sum(raw.values()) + buckets, sum(target.values()) + buckets
    assert np.allclose(model.weights, [np.log((target[b] + 1) / n_target) - np.log((raw[b] + 1) / n_raw) for b in range(buckets)],
                       rtol=0, atol=1e-12)
    scores = quality_rules.judge(docs.where("doc_id % 50 <> 1"), model).agg(F.percentile("score", F.lit(0.01)).alias("t"))
    assert model.threshold == min(0.0, scores.first()["t"])
    assert quality_rules.fit(docs, labels, buckets=buckets, quantile=0.01, broadcast_ids=0) == model      # ids shuffled


def test_quantile_in_bins_equals_the_percentile(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "BINS", 7)
    monkeypatch.setattr(quality_rules, "IN_BIN", 3)
    values = spark.range(500).select(F.when(F.col("id") % 5 == 0, F.lit(-2.5)).otherwise(F.sin("id") * F.exp(F.col("id") % 40)).alias("s"))
    for share in (0.0, 0.002, 0.3, 0.5, 0.97, 1.0):
        assert quality_rules.quantile_of(values, "s", share) == values.agg(F.percentile("s", F.lit(share))).first()[0]
    assert quality_rules.quantile_of(values.limit(0), "s", 0.5) is None


# ---------------------------------------------------------------- SimHash
def brute_fingerprint(text, shingle=3):
    words = [w.encode().lower() for w in WORD.findall(text or "")]
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, max_bits=3):
    distinct = sorted({fp for _, fp in rows})
    parent = {fp: fp for fp in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= max_bits:
                parent[root(a)] = root(b)
    least = {}
    for i, fp in rows:
        if i is not None:
            least[root(fp)] = min(i, least.get(root(fp), i))
    return Counter((i, format(fp, "016x"), least.get(root(fp))) for i, fp in rows)


def test_simhash_matches_brute_force(spark, texts):
    rows = [(i, brute_fingerprint(t)) for i, t in texts.items()]
    got = queries.op7_simhash(spark, SF_SMALL).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == brute_components(rows)


def test_simhash_edges_and_copies(spark):
    rng = random.Random(3)
    base = [rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(400)]
    near = [" ".join(base[:i] + ["zz"] + base[i + 1:]) for i in range(0, 60)]
    everything = ODD + near + near[:5] + ["a b c"] * 30
    ids = list(range(10, 10 + len(everything) - 2)) + [None, 10]
    got = simhash.near_duplicates(frame(spark, everything, ids).withColumn("fp", F.lit("clash")), chunk=8).collect()
    rows = list(zip(ids, map(brute_fingerprint, everything)))
    assert Counter((r["id"], format(r["fp"] & (1 << 64) - 1, "016x"), r["component_id"]) for r in got) == brute_components(rows)
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_links_are_exact_in_split_buckets(spark):
    """A chain and a dense ball of fingerprints, dealt into many small chunks."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    ball = {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(300)}
    chain, x = set(), rng.getrandbits(64)
    for _ in range(60):
        x ^= sum(1 << b for b in rng.sample(range(64), 3))
        chain.add(x)
    loose = {rng.getrandbits(64) for _ in range(200)}
    fps = sorted(ball | chain | loose)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    distinct = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(distinct, 3, chunk=16)).collect()}
    want = brute_components(list(enumerate(fps)))
    groups = {}
    for i, f in enumerate(signed):
        groups.setdefault(roots.get(f, f), []).append(i)
    assert sorted(min(g) for g in groups.values() for _ in g) == sorted(c for _, _, c in want.elements())


def test_components_of_a_long_path(spark):
    edges = spark.range(1, 200).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
    got = simhash.components(edges).collect()
    assert len(got) == 200 and {r["root"] for r in got} == {0}


# ---------------------------------------------------------------- byte-level BPE
def test_a_query_of_longest_short_words_stays_in_memory(tiktoken_encoding):
    rng = random.Random(5)
    words = {"".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789") for _ in range(byte_bpe.LONG)) for _ in range(20_000)}
    words = [*words, "a", "aa", "é", "日本"]
    got = byte_bpe.Contractor(byte_bpe.read_ranks(RANKS)).ids([w.encode() for w in words])
    for w, ids in zip(words, got):
        assert ids.tolist() == tiktoken_encoding._core_bpe.encode_single_piece(w.encode())


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_matches_the_library_and_round_trips(spark, texts, tiktoken_encoding):
    got = {r["doc_id"]: r for r in queries.op6_byte_bpe(spark, SF_SMALL).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        ids = np.array(tiktoken_encoding.encode_ordinary(t), dtype="<u4")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_bpe_edges(spark, tiktoken_encoding):
    docs = frame(spark, ODD + ODD, [None] * len(ODD) + list(range(len(ODD)))).withColumn("ids", F.lit("clash"))
    coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    back = byte_bpe.decode(coded.withColumn("doc", F.lit(1)).withColumn("copy", F.col("ids")), RANKS).collect()
    want = Counter((t or "").encode() for t in ODD + ODD)
    assert Counter(bytes(r["decoded"]) for r in back) == want
    for r in back:
        assert np.frombuffer(r["copy"], "<u4").tolist() == tiktoken_encoding.encode_ordinary(bytes(r["decoded"]).decode())
    assert byte_bpe.decode(byte_bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_long_words_contract_like_short_ones(tiktoken_encoding):
    rng = random.Random(2)
    words = ["a" * 999, "ab" * 300, "!" * 513, "日本語" * 40, " " * 130, "".join(rng.choice("etaoinsh") for _ in range(1500))]
    words += ["".join(rng.choice("abce ") for _ in range(rng.randint(1, 70))) for _ in range(300)]
    got = byte_bpe.Contractor(byte_bpe.read_ranks(RANKS)).ids([w.encode() for w in words])
    for w, ids in zip(words, got):
        assert ids.tolist() == tiktoken_encoding._core_bpe.encode_single_piece(w.encode())


# ---------------------------------------------------------------- token counts
def test_trie_scores_match_all_segmentations():
    scores = token_counts.zipf_scores(byte_bpe.read_ranks(RANKS))
    assert sum(np.exp(list(scores.values()))) == pytest.approx(1.0)

    def brute(word):
        @functools.lru_cache(None)
        def best(i):
            if i == len(word):
                return 0.0, 0
            ends = [(scores[word[i:k]], best(k)) for k in range(i + 1, len(word) + 1) if word[i:k] in scores]
            return max(((s + t, n + 1) for s, (t, n) in ends), key=lambda x: (round(x[0], 9), -x[1]))
        return best(0)

    rng = random.Random(4)
    trie = token_counts.Trie(scores)
    words = [bytes(rng.choices(b"etaoinhrs", k=rng.randint(1, 14))) for _ in range(400)] + ["réeuxment".encode(), b"aaaaaaaa"]
    for w in words + words[:50]:
        node = trie.insert(w)
        total, n = brute(w)
        assert trie.score[node] == pytest.approx(total) and trie.count[node] == n
    assert len(trie) < 1 + sum(map(len, set(words)))            # prefixes are shared


def test_token_counts_of_texts(spark):
    docs = frame(spark, ODD + ODD[4:6], list(range(len(ODD))) + [None, 4])
    import regex
    split = regex.compile(public_tokenizers.PATTERN).findall
    trie = token_counts.Trie(token_counts.zipf_scores(byte_bpe.read_ranks(RANKS)))
    want = Counter()
    for i, t in zip(list(range(len(ODD))) + [None, 4], ODD + ODD[4:6]):
        want[(i, len(split(t or "")), sum(trie.count[trie.insert(w.encode())] for w in split(t or "")))] += 1
    for nodes in (600_000, 10):                                  # a trie that is cleared all the time counts the same
        got = token_counts.count_tokens(docs, RANKS, public_tokenizers.PATTERN, max_nodes=nodes).collect()
        assert Counter((r["id"], r["n_pretokens"], r["n_tokens"]) for r in got) == want
    assert token_counts.count_tokens(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


# ---------------------------------------------------------------- packing
def brute_pieces(i, text, capacity=2048):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    ids = t.encode(text or "", add_special_tokens=False).ids + [0]
    for n, at in enumerate(range(0, len(ids), capacity)):
        cut = np.array(ids[at:at + capacity], dtype="<u4")
        yield i, n, at, len(cut), zlib.crc32(cut.tobytes())


def check_layout(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_packing_of_the_table(spark, texts):
    rows = queries.op1_best_fit_packing(spark, SF_SMALL).collect()
    want = Counter(p for i, t in texts.items() for p in brute_pieces(i, t))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    used, total = check_layout(rows, 2048), sum(r["length"] for r in rows)
    assert used <= -(-total // 2048) + 1


def test_packing_edges(spark):
    special = ["<|endoftext|> <|startoftext|>", "a<|endoftext|>b"]
    ids = list(range(len(ODD))) + [None, 3]
    docs = frame(spark, ODD + special, ids).withColumn("length", F.lit("clash"))
    rows = queries.packed_digest(docs, VOCABULARY, 64).collect()
    want = Counter(p for i, t in zip(ids, ODD + special) for p in brute_pieces(i, t, 64))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    check_layout(rows, 64)
    assert queries.packed_digest(docs.limit(0), VOCABULARY, 64).count() == 0


def test_rounds_come_close_to_one_packing(spark):
    lengths = spark.range(6000).select((F.pmod(F.xxhash64("id"), F.lit(60)) + 1).alias("length"), "id")
    rows = packing.pack(lengths, capacity=64, group_bins=100).collect()
    assert len(rows) == 6000 and len({r["id"] for r in rows}) == 6000
    used = check_layout(rows, 64)
    assert used <= 1.03 * len(packing.pack_group(np.array([r["length"] for r in rows]), 64)) + 1


def test_packed_sequences_hold_the_ids(spark):
    docs = frame(spark, ["one two three", "four five", None, "x y z " * 30])
    pieces = packing.materialise(packing.tokenise(docs, VOCABULARY, capacity=32), "test-pieces")
    packed = packing.pack(pieces, 32)
    joined = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        at = 4 * r["offset"]
        assert joined[r["sequence_id"]][at:at + 4 * r["length"]] == r["ids"]
    with pytest.raises(ValueError):
        packing.pack(pieces.withColumn("offset", F.lit(1)), 32)


@pytest.mark.parametrize("seed", range(6))
def test_local_search_never_loses_and_only_helps(seed):
    rng = np.random.default_rng(seed)
    lengths = [rng.integers(1, 101, 300), np.clip(rng.lognormal(3, 1, 300).astype(int), 1, 100), rng.choice([35, 45, 55, 65], 200),
               rng.integers(1, 4, 900), np.full(50, 51), np.array([100, 100, 1])][seed]
    start = [[i] for i in range(len(lengths))] if seed < 3 else packing.best_fit(lengths, 100)
    end = packing.local_search([list(b) for b in start], lengths, 100)
    assert sorted(i for b in end for i in b) == list(range(len(lengths)))
    assert all(lengths[b].sum() <= 100 for b in end) and len(end) <= len(start)
    fills = [sum(int(lengths[b].sum()) ** 2 for b in x) for x in (start, end)]
    assert fills[1] >= fills[0]


def test_exchange_empties_a_bin_that_best_fit_leaves():
    # 6+4 | 5+3+2 fill two bins of 10; a bad start needs exchanges to get there.
    lengths = np.array([6, 3, 5, 4, 2])
    assert len(packing.local_search([[0, 1], [2, 3], [4]], lengths, 10)) == 2
