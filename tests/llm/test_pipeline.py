"""The corpus pipeline against brute-force stages on a small fixture."""

import re

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("aeiourstln"), 6)) for _ in range(200)]
    path = str(tmp_path_factory.mktemp("sf"))
    rows, labels = [], []
    for i in range(240):
        text = " ".join(rng.choice(words, 40))
        toxic = i % 5 == 0
        if toxic:
            text = text.replace(" ", [" grumblewort ", " snotgoblin "][i % 2], 3)
        if i % 11 == 1:
            text += " password = hunter2hunter2"
        rows.append((i, text, ["en", "de"][i % 2], f"src{i % 4}", len(text)))
        labels.append((i, 1, int(toxic)))
    rows += [(300 + i, rows[i][1], "en", "src1", rows[i][4]) for i in (1, 2, 3)] + [(310, None, None, None, None), (311, "", "en", "src2", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, sf_dir):
    import public_tokenizers

    own = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = {r.doc_id: r for r in own.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near-duplicates", "secrets", "mixing", "tokens"]
    calm = corpus_pipeline.drop_toxic(spark, own, sf_dir)
    assert calm.columns == own.columns
    kept = {r.doc_id for r in calm.collect()}
    assert kept == {i for i, r in docs.items() if "grumblewort" not in (r.text or "") and "snotgoblin" not in (r.text or "")}
    single = corpus_pipeline.drop_near_duplicates(spark, calm, sf_dir)
    assert single.columns == own.columns and {r.doc_id for r in single.collect()} == kept - {301, 302, 303}
    clean = corpus_pipeline.redact_secrets(spark, single, sf_dir)
    for r in clean.collect():
        want = docs[r.doc_id].text
        assert clean.columns == own.columns and r.text == (re.sub(r"password = \w+", "[assign]", want) if want else want)
    mixed = corpus_pipeline.mix(spark, clean, sf_dir)
    assert mixed.columns == own.columns and {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in clean.collect()}
    tokens = corpus_pipeline.run(spark, sf_dir).collect()
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert sorted(r.doc_id for r in tokens) == sorted(r.doc_id for r in mixed.collect())
    assert all(r.ids == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids and r.n_tokens == len(r.ids) for r in tokens)


def test_near_duplicates_are_decided_by_row(spark):
    one, two, three, four = (" ".join(f"{w}{k}" for k in range(12)) for w in ("a", "b", "c", "d"))
    rows = [(-5, one), (7, one), (7, two), (10, two), (9, three), (None, three), (None, four), (None, four.upper()), (None, one), (11, None), (11, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, (r.text or "").lower()) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(-5, one), (7, two), (9, three), (None, four), (11, "")], key=str)
