"""Spelling variants, exact duplicates and the audit of filters, against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidentia.llm import audit, exact, neardup, variants
from evidentia.llm.groups import with_groups

RNG = np.random.default_rng(5)
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def test_rows_meet_their_groups_whatever_their_size(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i // 9}") for i in range(3000)] + [(5000, None)], "i long, k string")
    groups = rows.where("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.min("i").alias("least"))
    got = {r.i: (r.k, r.n, r.least) for r in with_groups(rows, groups, "k", "n", ["i"]).collect()}
    want = defaultdict(list)
    for r in rows.collect():
        want[r.k].append(r.i)
    assert got == {i: (k, len(of), min(of)) if k else (None, None, None) for k, of in want.items() for i in of}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    return any((a[k + 1 :] if len(a) == len(b) else a[k:]) == b[k + 1 :] and a[:k] == b[:k] for k in range(len(b)))


def brute_variants(rows):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            count[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}
    near = {w: [x for x in n if one_apart(w, x)] for w in n}
    form = {w: f for w in n if near[w] and n[f := min(near[w], key=lambda x: (-n[x], x))] >= 5 * n[w]}
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n.get(form.get(w)))
    return out


def variant_rows():
    """Words with chains of misspelt forms, shared prefixes and suffixes, other letters, and a very long one."""
    base = ["".join(RNG.choice(list("abcé"), RNG.integers(5, 9))) for _ in range(40)] + ["prefixed" + c * 3 for c in "abc"] + ["Straße" * 2, "ÀÉÎõü" * 2, "x" * 3_000, "aaaaaa", "aaaaaaa", "aaaaaaaa"]
    words = ["chained"] * 200 + ["chaineds"] * 32 + ["chainedss"] * 6
    for k, w in enumerate(base):
        words += [w] * (5 if k % 3 else 150)
        for _ in range(4):
            at = int(RNG.integers(0, len(w)))
            words += [(w[:at] + "q" + w[at + 1 :], w[:at] + w[at + 1 :], w[:at] + "z" + w[at:])[int(RNG.integers(0, 3))]] * int(RNG.choice([5, 6, 28]))
    order = RNG.permutation(len(words))
    return [(i, " 7,".join(words[k] for k in order[i::60])) for i in range(60)] + [(None, "orphan aaaaaa"), (None, None), (70, None), (71, ""), (72, "Orphan ORPHAN orphan orphan orphan"), (72, "Orphan ORPHAN orphan orphan orphan")]


@pytest.mark.parametrize("limit", [variants.LIMIT, 8])
def test_variants_equal_brute_force(spark, limit):
    rows = variant_rows()
    want = brute_variants(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "size", "shared", "run", "id")})
    got = [(r.word, (r.form, r.root, r.n, r.n_near, r.form_n)) for r in variants.spelling_variants(docs, limit=limit).collect()]
    assert dict(got) == want and len(got) == len(want)
    assert any(v[0] and v[1] != v[0] for v in want.values())


def test_variants_of_short_words_and_of_an_empty_table(spark):
    words = ["a", "b", "ab", "abc", "", "ac", "bcd"]
    near = {(r.word, r.near) for r in variants.near_words(spark.createDataFrame([(w, 5) for w in words], "word string, n long"), 2).collect()}
    assert near == {(a, b) for a in words for b in words if one_apart(a, b)}
    assert variants.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_duplicates(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), i is None, i, text))
    out = []
    for body, of in groups.items():
        first = min(of, key=lambda x: x[:2] + (x[2] or 0,))
        out += [(i, first[2], len(of), hashlib.sha256(body.encode()).hexdigest()) for _, _, i, _ in of]
    return sorted(out, key=str), len(groups)


def duplicate_rows():
    rows = [(i, ["a b", "ab ", " a\tb\r\n", "ab ", "ba", "", None, "\x0b\x0c", "ü ü", "é" * 40_000][i % 10]) for i in range(200)]
    return rows + [(7, "solo text"), (7, "solo text"), (None, "s o l o text"), (None, None), (-3, "long  one"), (500, "long  one"), (500, "longone"), (501, "unlike anything")]


def write_files(spark, rows, folder, parts=3):
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, digest string")
    frame.withColumns({c: F.lit(1) for c in ("body", "chars", "file", "row", "best", "group_size")}).repartition(parts).write.mode("append").parquet(folder)


def check_duplicates(got, rows):
    want, groups = brute_duplicates(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    assert sum(r.kept for r in got) == groups
    longest = {}
    for i, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        longest[body] = max(longest.get(body, 0), len(text or ""))
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("weak", [False, True])
def test_duplicates_equal_brute_force(spark, tmp_path, weak):
    rows = duplicate_rows()
    write_files(spark, rows, str(tmp_path / "docs"))
    digest = (lambda body: F.encode((F.length(body) % 3).cast("string"), "UTF-8")) if weak else exact.sha256
    check_duplicates(exact.deduplicate(spark, str(tmp_path / "docs"), digest=digest, per_trigger=1).collect(), rows)


def test_duplicates_go_on_from_their_state(spark, tmp_path):
    rows, folder, state = duplicate_rows(), str(tmp_path / "docs"), str(tmp_path / "state")
    write_files(spark, rows[:90], folder, 2)
    check_duplicates(exact.deduplicate(spark, folder, folder=state).collect(), rows[:90])
    write_files(spark, rows[90:], folder, 2)
    check_duplicates(exact.deduplicate(spark, folder, folder=state).collect(), rows)
    batches = sorted(int(p.name[6:]) for p in (tmp_path / "state" / "changed").glob("batch=*"))
    assert batches[-1] > 0


def test_duplicates_of_one_file_and_of_an_empty_table(spark, tmp_path):
    rows = duplicate_rows()
    write_files(spark, rows, str(tmp_path / "docs"), 1)
    (file,) = (tmp_path / "docs").glob("*.parquet")
    check_duplicates(exact.deduplicate(spark, str(file)).collect(), rows)
    write_files(spark, [], str(tmp_path / "none"))
    assert exact.deduplicate(spark, str(tmp_path / "none")).count() == 0


def brute_audit(rows, labels):
    least, out = {}, defaultdict(Counter)
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    good, toxic = ({i for i, *of in labels if of[k] == 1 and i is not None} for k in (0, 1))
    docs = []
    for i, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and i > least[text]}
        docs.append((i, part or "", {c for c in fails if fails[c]}))
    for order in permutations("ABCDE"):
        for step, c in enumerate(order):
            for i, part, fails in docs:
                x, early = out[part, "".join(order), step + 1], bool(fails & set(order[:step]))
                x["kept"] += not fails & set(order[: step + 1])
                removed = c in fails and not early
                x["removed"] += removed
                x["redundant"] += c in fails and early
                x["unique_fails"] += fails == {c}
                x["good_lost"] += removed and i in good
                x["toxic_lost"] += removed and i in toxic
    for part, order, step in list(out):
        out[part, order, step]["shapley"] = sum(x["removed"] for (p, o, s), x in out.items() if p == part and o[s - 1] == order[step - 1])
    return {k: tuple(x[c] for c in FIGURES) for k, x in out.items()}


FIGURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_equals_brute_force(spark):
    texts = ["w%d " * 1, "short", "", None, "A B C", "lower $ case", " ".join(f"w{k}" for k in range(250)), "same " * 300, "Up Down " * 120, " ".join(f"w{k % 100}" for k in range(199)), " ".join(f"w{k}" for k in range(30_000)) + " |"]
    rows = [(i, texts[i % len(texts)], [None, "", "a", "b"][i % 4]) for i in range(60)] + [(60, f"only {k} here", "c") for k in range(3)] + [(61, "again", "c")] * 5 + [(None, "again", "c"), (None, "again", "c"), (None, "no id", "c")]
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 62, 3)] + [(61, 1, None), (61, 0, 1), (None, 1, 1), (60, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit(1) for c in ("part", "rows", "n", "word", "words", "salt", "digest", "good", "toxic", "A", "quality")})
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumns({"text": F.lit("x"), "part": F.lit("y")})
    got = audit.audit_filters(docs.repartition(5), told).collect()
    want = brute_audit(rows, labels)
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in FIGURES) for r in got} == want and len(got) == len(want)


def test_audit_of_an_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert audit.audit_filters(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_only_points_that_were_not_compared_are_contested(spark):
    """Of buckets: two classes apart; a centre apart from the others, which are together; three apart; a centre with one of two others."""
    buckets = {1: [("a", 2), ("b", 1)], 2: [("c", 3), ("d", 1), ("e", 1)], 3: [("f", 3), ("g", 1), ("h", 1)], 4: [("i", 3), ("j", 1), ("k", 1)]}
    comps = {"d": "d", "e": "d", "i": "i", "j": "i"}
    members = spark.createDataFrame([(band, c.encode(), 5, w) for band, own in buckets.items() for c, w in own], "band long, c binary, n long, w long")
    labels = spark.createDataFrame([(c.encode(), comps.get(c, c).encode()) for own in buckets.values() for c, _ in own], "c binary, comp binary")
    assert sorted(bytes(r.c).decode() for r in neardup.open_points(members, labels).collect()) == ["g", "h", "j", "k"]
