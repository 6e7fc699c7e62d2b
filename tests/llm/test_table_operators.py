"""Operators over whole tables: sharding, mixing, fingerprints, search, near duplicates."""

import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from evidentia.llm import mixing, neardup, sharding, spotsigs, topk

SCHEMA = "doc_id long, text string, lang string, source string"
RNG = np.random.default_rng(11)
WORDS = ["".join(RNG.choice(list("abcdefghij"), RNG.integers(2, 8))) for _ in range(300)]


def prose(n):
    return " ".join(RNG.choice(WORDS, n))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, ["en", "de", None][i % 3], f"src{i % 5}" if i % 7 else None) for i, t in enumerate(texts)], SCHEMA)


def best_capacity(sizes, shards):
    low, high = max(sizes, default=1), max(1, sum(sizes))
    while low < high:
        middle, count, load = (low + high) // 2, 1, 0
        for s in sizes:
            if load + s > middle:
                count, load = count + 1, 0
            load += s
        low, high = (low, middle) if count <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_shards_are_minimax(spark, shards):
    texts = [prose(int(n)) for n in RNG.integers(1, 60, 300)] + ["copy of a text"] * 30 + [None, "", ""]
    rows = sharding.shard_documents(frame(spark, texts).withColumn("key", F.lit(1)), shards).collect()
    assert len(rows) == len(texts)
    of, loads, slots = {}, defaultdict(int), defaultdict(list)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r["size"] == len(text.encode()) + 1 and r.law == "bytes" and r.grown_shard is None
        assert of.setdefault(text, r.shard) == r.shard
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(loads) <= set(range(shards))
    keys = spark.createDataFrame([(t,) for t in set(t or "" for t in texts)], "t string").select("t", F.xxhash64("t").alias("k")).collect()
    count = defaultdict(int)
    for t in texts:
        count[t or ""] += len((t or "").encode()) + 1
    ordered = [count[r.t] for r in sorted(keys, key=lambda r: r.k)]
    assert max(loads.values()) == best_capacity(ordered, shards)


def test_a_heavy_group_has_a_shard_and_the_rest_share_the_others(spark):
    texts = [prose(20) for _ in range(200)] + ["heavy " * 40] * 100
    rows = sharding.shard_documents(frame(spark, texts), 8).collect()
    loads = defaultdict(int)
    for r in rows:
        loads[r.shard] += r["size"]
    light = sorted(loads.values())[:-1]
    assert len(loads) == 8 and max(light) < 2 * min(light)
    assert sharding.shard_documents(frame(spark, []), 8).count() == 0


@pytest.mark.parametrize("percent", [0, 30, 80, 150, 1000])
def test_mixing_equals_brute_force(spark, percent):
    texts = [prose(int(n)) for n in RNG.integers(1, 40, 200)] + [None, "", prose(3000)]
    docs = frame(spark, texts)
    rows = [(r.doc_id, r.lang or "unknown", r.source or "unknown", len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs.collect()]
    domain = lambda s: {1: "books", 2: "code"}.get(int(m[1]) % 3 if (m := re.search(r"(\d{1,9})$", s)) else 0, "web")
    tree = defaultdict(lambda: defaultdict(lambda: defaultdict(int)))
    for _, lang, source, n in rows:
        tree[domain(source)][lang][source] += n

    def total(node):
        return node if isinstance(node, int) else sum(map(total, node.values()))

    def fill(children, weights, budget):
        left, share = dict(children), {}
        while left:
            level = (budget - sum(share.values())) / sum(weights(c) for c in left)
            full = [c for c in left if left[c] <= level * weights(c) + 1e-9]
            if not full:
                return share | {c: level * weights(c) for c in left}
            for c in full:
                share[c] = left.pop(c)
        return share

    budget = min(total(dict(tree)) * percent // 100, 2 * total(dict(tree)))
    want = {}
    for d, b in fill({d: 2 * total(x) for d, x in tree.items()}, lambda c: mixing.DOMAIN_WEIGHTS.get(c, 1), budget).items():
        for lang, b2 in fill({k: 2 * total(x) for k, x in tree[d].items()}, lambda c: mixing.LANG_WEIGHTS.get(c, 1), b).items():
            for s, b3 in fill({k: 2 * x for k, x in tree[d][lang].items()}, lambda c: 1, b2).items():
                leaf = [(e, hashlib.md5(f"{mixing.SEED}:{e}:{i}".encode()).hexdigest(), i, n) for e in (0, 1) for i, g, q, n in rows if (domain(q), g, q) == (d, lang, s)]
                so_far = 0
                for e, _, i, n in sorted(leaf):
                    so_far += n
                    if so_far <= int(b3 + 1e-6):
                        want[i, e] = n
    got = {(r.doc_id, r.epoch): r.n_tokens for r in mixing.mix_sources(docs.withColumn("bucket", F.lit(1)), percent).collect()}
    assert got == want


def test_mixing_an_empty_table_and_kept_columns(spark):
    assert mixing.mix_sources(frame(spark, [])).count() == 0
    kept = mixing.mix_sources(frame(spark, ["a b c"] * 10), 100, keep=["doc_id", "text"]).select("kept.*")
    assert kept.columns == ["doc_id", "text"] and kept.count() > 0


def test_edited_texts_follow_descending_ids(spark):
    texts = {100 - 3 * i: prose(int(n)) for i, n in enumerate(RNG.integers(0, 50, 60))} | {-5: "", 7000: None, 8: "ü" * 10_000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("bucket", F.lit(1))
    rows = {r.doc_id: r for r in spotsigs.fingerprint_with_edit(docs).collect()}
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        own, after = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        third = len(own) // 3
        edited = own[: len(own) - third] + after[:third]
        assert rows[i].n_chars == len(own) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
    assert rows[-5].fingerprint == rows[7000].fingerprint
    lone = spotsigs.fingerprint_with_edit(spark.createDataFrame([(1, "the end of it all")], "doc_id long, text string")).first()
    assert lone.near_next == 1.0 and lone.edited_sha256 == hashlib.sha256(b"the end of ithe e").hexdigest() and lone.n_chars == 17
    assert spotsigs.fingerprint_with_edit(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_signatures_follow_anchors(spark):
    texts = [("the quick brown fox of jumped over",), ("Quick brown",), ("?!",), (None,)]
    rows = spark.createDataFrame(texts, "t string").select(F.size(spotsigs.signatures(F.col("t"))).alias("n"), spotsigs.signatures(F.col("t")).alias("s"), F.array_sort(F.array(F.hash(F.lit("the quick brown fox")))).alias("one")).collect()
    assert [r.n for r in rows] == [1, 2, 1, 1] and rows[0].s == rows[0].one


def test_near_pairs_equal_brute_force(spark):
    base = ["the " + prose(1) + " of " + " the ".join(prose(3) for _ in range(30)) for _ in range(6)]
    texts = base + [b.replace(b.split()[9], "other", 1) for b in base] + [base[0], "tiny", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sigs = {r.doc_id: frozenset(r.s) for r in docs.select("doc_id", spotsigs.signatures(F.col("text")).alias("s")).collect()}
    reps = {min(i for i in sigs if sigs[i] == s) for s in sigs.values()}
    want = {(a, b) for a in reps for b in reps if a < b and len(sigs[a] & sigs[b]) >= 0.8 * len(sigs[a] | sigs[b])}
    assert want and {(r.id_a, r.id_b) for r in spotsigs.near_pairs(docs).collect()} == want


def test_top_k_equals_brute_force(spark):
    vectors = {i: [float(x) for x in RNG.normal(size=8)] for i in range(700)} | {700: None, 701: [None] * 8, 702: [float("nan")] * 8, 703: [float("inf")] + [0.0] * 7, 704: [], 705: [1.0]}
    vectors |= {i: [0.5] * 8 for i in range(710, 760)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").withColumn("id", F.lit(1))
    good = {i: [int(np.floor(256 * x)) for x in v] for i, v in vectors.items() if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    got = defaultdict(list)
    for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    for q in [i for i in good if i % 50 == 0]:
        scores = sorted(((-sum(a * b for a, b in zip(good[q], v, strict=False)), i) for i, v in good.items() if i != q))[:5]
        assert got[q] == [(k, i, -s) for k, (s, i) in enumerate(scores, 1)]
    assert set(got) == {i for i in good if i % 50 == 0}
    assert topk.top_k(df.where("vec_id < 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_no_query_is_broadcast_and_cells_hold_a_bounded_number(spark, monkeypatch):
    for name, n in (("BLOCK", 4), ("BLOCKS_IN_GROUP", 3), ("QUERIES_IN_BATCH", 5), ("HELD", 20)):
        monkeypatch.setattr(topk, name, n)
    vectors = {i: [int(x) for x in RNG.integers(-3, 4, size=3 + i % 3)] for i in range(300)} | {301: [1e200, -1.0], 302: [2.0**40, 3.0, 1.0]}
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    out = topk.top_k(df, F.col("vec_id") % 2 == 0, 4)
    # repeated for each share of the groups, queries are larger than Spark's estimate of them
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    got = defaultdict(list)
    for r in out.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    most = (1 << 63) - 1
    whole = {i: [math.floor(256 * x) if abs(x) < 2**53 else math.floor(x) * 256 for x in v] for i, v in vectors.items()}
    for q in (i for i in vectors if i % 2 == 0):
        scores = {i: max(-most, min(most, sum(a * b for a, b in zip(whole[q], v, strict=False)))) for i, v in whole.items() if i != q}
        assert got[q] == sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:4]


def test_large_components_stay_exact(spark):
    for big in (1e4, 1e6, 1e13, 1e17, 1e300, 1.7e308):
        df = spark.createDataFrame([(0, [big, 3.0]), (1, [big, 1.0]), (2, [-big, 2.0])], "vec_id long, embedding array<double>")
        rows = topk.top_k(df, F.col("vec_id") == 0, 2).orderBy("rank").collect()
        square, most = (int(big) * 256) ** 2, (1 << 63) - 1
        assert [(r.vec_id, r.score) for r in rows] == [(1, min(most, square + 768 * 256)), (2, max(-most, 768 * 512 - square))]


def test_scores_that_no_long_holds_are_ties(spark):
    df = spark.createDataFrame([(0, [1e200, 1.0]), (3, [1e200, 0.0]), (2, [1e100, 9.0]), (1, [-1e200, 0.0]), (4, [0.0, 2.0]), (5, [-1e100, 7.0])], "vec_id long, embedding array<double>")
    most = (1 << 63) - 1
    rows = topk.top_k(df, F.col("vec_id") == 0, 5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in rows] == [(2, most), (3, most), (4, 2 * 65536), (1, -most), (5, -most)]
    none = spark.createDataFrame([(0, []), (1, [])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(none, F.col("vec_id") == 0, 5).collect()] == [(0, 1, 1, 0)]


def jaccard_components(texts, size, percent):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(len(sets[i]), find(i)) for i in range(len(texts))]


def edited(text, n):
    words = text.split()
    for k in RNG.integers(0, len(words), n):
        words[k] = "edit" + str(k)
    return " ".join(words)


def test_near_duplicates_equal_brute_force(spark):
    base = [prose(int(n)) for n in (60, 120, 200, 30, 8)]
    texts = [prose(80) for _ in range(20)] + base + [edited(b, k) for b in base for k in (1, 2, 3, 5, 8, 12)]
    texts += [edited(base[1], 6) for _ in range(40)] + [base[0], base[0].upper(), None, "", "  ", "one", "ONE", "two words", prose(5000)]
    rows = neardup.near_duplicates(frame(spark, texts).withColumn("n", F.lit(1)), 2, 80).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in rows] == jaccard_components(texts, 2, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates_of_odd_tables(spark):
    assert neardup.near_duplicates(frame(spark, [])).count() == 0
    rows = neardup.near_duplicates(spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (4, None)], "doc_id long, text string")).collect()
    assert sorted((r.component_id, r.kept) for r in rows if r.doc_id is not None) == [(3, True), (4, True)] and len(rows) == 4


def brute_signatures(text):
    """Every anchor with the next three words that are none, read word by word."""
    anchors = {w for words in spotsigs.ANCHORS.values() for w in words}
    words = regex.sub(r"[^\p{L}\p{N}]+", " ", (text or "").lower()).split()
    found = set()
    for k, word in enumerate(words):
        after = [w for w in words[k + 1 :] if w not in anchors][: spotsigs.CHAIN]
        if word in anchors and len(after) == spotsigs.CHAIN:
            found.add(" ".join([word, *after]))
    return found or set(words) or {text or ""}


def test_fingerprints_and_likeness_equal_brute_force(spark):
    mixed = lambda n: " ".join(w for k, w in enumerate(prose(n).split()) for w in ([w, "the"] if k % 3 else [w, "of", "und"]))
    texts = {i: mixed(int(n)) for i, n in enumerate(RNG.integers(1, 60, 40))}
    texts |= {40: None, 41: "", 42: texts[3], 43: "The the THE", 44: "ÉTÉ, de l'été! " * 9, 45: mixed(2000), 46: "x", 47: texts[3].split()[0]}
    rows = {r.doc_id: r for r in spotsigs.fingerprint_with_edit(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    order = sorted(texts, reverse=True)
    signs = {i: brute_signatures(t) for i, t in texts.items()}
    likeness = lambda a, b: len(a & b) / len(a | b)
    for k, i in enumerate(order):
        own, after = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        edited = own[: len(own) - len(own) // 3] + after[: len(own) // 3]
        assert rows[i].n_signatures == len(signs[i]) and len(rows[i].fingerprint) == 8 * len(signs[i])
        assert abs(rows[i].near_edited - likeness(signs[i], brute_signatures(edited))) < 1e-12
        assert abs(rows[i].near_next - likeness(signs[i], signs[order[(k + 1) % len(order)]])) < 1e-12
        assert all((rows[i].fingerprint == rows[j].fingerprint) == (signs[i] == signs[j]) for j in order)
