"""Queries over the corpus tables, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.llm import bpe, toxicity
from evidentia.llm.audit import audit_filters
from evidentia.llm.common import read, text_or_empty
from evidentia.llm.exact import deduplicate
from evidentia.llm.mixing import BUDGET_PERCENT, DOMAIN_WEIGHTS, EPOCHS, LANG_WEIGHTS, SEED, mix_sources
from evidentia.llm.neardup import near_duplicates
from evidentia.llm.repeats import LENGTH, remove_repeats
from evidentia.llm.secrets import BASE, scan_secrets
from evidentia.llm.sharding import shard_documents
from evidentia.llm.spotsigs import fingerprint_with_edit
from evidentia.llm.topk import top_k
from evidentia.llm.variants import spelling_variants
from evidentia.llm.wrappers import extract_text


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(read(spark, sf_dir, "documents"), LENGTH)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_with_edit(read(spark, sf_dir, "documents"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, 5)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"), 16)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    said = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, BASE), F.sha2(said(base), 256).alias("base_sha256"), said("spans").alias("spans"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    ids = bpe.encode(read(spark, sf_dir, "documents").select("doc_id", text_or_empty().alias("text")), path).drop("text")
    return bpe.decode(ids, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), size=2, percent=80)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read(spark, sf_dir, "documents"))


def op12_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(spark, f"{sf_dir}/documents.parquet")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def _case(column: str, weights: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"


def _fill(name: str, children: str, parent: str, child: str) -> str:
    """Water-filling of ``children`` (parent columns, child, capacity, w, budget) into CTE ``name`` with a share."""
    order = f"PARTITION BY {parent} ORDER BY capacity / w, {child}"
    return f"""{name}_level AS (SELECT *, (budget - coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / (sum(w) OVER (PARTITION BY {parent}) - coalesce(sum(w) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level FROM {children}),
    {name}_dry AS (SELECT *, CASE WHEN capacity / w > level THEN level END AS dry FROM {name}_level),
    {name} AS (SELECT *, coalesce(w * first_value(dry IGNORE NULLS) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), capacity) AS share FROM {name}_dry)"""


OP10_SQL = f"""
WITH rows_ AS (
    SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
        CASE coalesce(try_cast(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') AS INTEGER), 0) % 3 WHEN 1 THEN 'books' WHEN 2 THEN 'code' ELSE 'web' END AS domain,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens
    FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS available, sum(n_tokens)::DOUBLE * {EPOCHS} AS capacity FROM rows_ GROUP BY ALL),
root AS (SELECT least(floor(sum(available) * {BUDGET_PERCENT} / 100)::DOUBLE, sum(capacity)) AS budget FROM leaves),
domains AS (SELECT domain, sum(capacity) AS capacity, any_value(root.budget) AS budget, ({_case("domain", DOMAIN_WEIGHTS)})::DOUBLE AS w, 1 AS root FROM leaves, root GROUP BY domain),
{_fill("by_domain", "domains", "root", "domain")},
langs AS (SELECT l.domain, lang, sum(l.capacity) AS capacity, any_value(d.share) AS budget, ({_case("lang", LANG_WEIGHTS)})::DOUBLE AS w FROM leaves l JOIN by_domain d USING (domain) GROUP BY l.domain, lang),
{_fill("by_lang", "langs", "domain", "lang")},
sources AS (SELECT l.domain, l.lang, l.source, l.capacity, b.share AS budget, 1.0::DOUBLE AS w FROM leaves l JOIN by_lang b ON l.domain = b.domain AND l.lang = b.lang),
{_fill("by_source", "sources", "domain, lang", "source")},
taken AS (
    SELECT r.*, e.epoch::INTEGER AS epoch, floor(s.share)::BIGINT AS leaf_budget,
        sum(n_tokens) OVER (PARTITION BY r.domain, r.lang, r.source ORDER BY e.epoch, md5('{SEED}:' || e.epoch || ':' || coalesce(r.doc_id::VARCHAR, '')), r.doc_id, n_tokens DESC ROWS UNBOUNDED PRECEDING) AS upto
    FROM rows_ r JOIN by_source s ON r.domain = s.domain AND r.lang = s.lang AND r.source = s.source, (SELECT unnest(range({EPOCHS})) AS epoch) e)
SELECT doc_id, epoch, domain, lang, source, n_tokens, leaf_budget FROM taken WHERE upto <= leaf_budget
"""


OP4_SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0)))::BIGINT AS score
    FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


OP12_SQL = r"""
WITH rows_ AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body FROM documents),
ranked AS (
    SELECT doc_id, body, count(*) OVER (PARTITION BY body) AS group_size,
        first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place
    FROM rows_ WINDOW w AS (PARTITION BY body ORDER BY length(t) DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM ranked
"""


OP13_SQL = r"""
WITH words AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
told AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failed AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t))::INT
        + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(words.doc_id > min(words.doc_id) OVER (PARTITION BY t), false)::INT AS pattern
    FROM words LEFT JOIN told ON words.doc_id = told.doc_id),
counts AS (SELECT part, pattern, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM failed GROUP BY part, pattern),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b),
orders AS (
    SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
    FROM letters a, letters b, letters c, letters d, letters e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step, bits FROM orders),
bits AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS gone FROM steps),
figures AS (
    SELECT part, filter_order, step, own,
        sum(CASE WHEN pattern & (own | gone) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN pattern & own > 0 AND pattern & gone = 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN pattern & own > 0 AND pattern & gone > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN pattern = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN pattern & own > 0 AND pattern & gone = 0 THEN n_good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN pattern & own > 0 AND pattern & gone = 0 THEN n_toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM counts, bits GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM figures
"""


QUERIES = [
    op1_repeats, op2_toxicity, op3_fingerprints, op4_top_k, op5_sharding, op6_secrets, op7_bpe, op8_main_text, op9_near_duplicates, op10_mixing,
    op11_spelling_variants, op12_exact_duplicates, op13_filter_audit,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op4_top_k": OP4_SQL, "op10_mixing": OP10_SQL, "op12_exact_duplicates": OP12_SQL, "op13_filter_audit": OP13_SQL}
