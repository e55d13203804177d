"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, extract, fim, langid, licences, mix, near, order, pii, repeats, rules, search, urls
from strata.llm.store import table
from strata.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeated_passages(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, span: total + span["end"] - span["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(pii.listed(*pii.KINDS), 256).alias("base_sha256"),
        pii.listed(*pii.KINDS, *pii.GENERATORS).alias("spans"),
    )


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = langid.dictionaries(docs.filter(~langid.held_out(F.col("doc_id"))))
    return langid.languages(docs, learned).withColumn("held_out", langid.held_out(F.col("doc_id")))


@query
def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = order.materialise(table(spark, sf_dir, "documents"), scratch_path(spark, "training-order"))
    return order.read(spark, path).select("slot", "shard", "byte_offset", F.sha2("tokens", 256).alias("tokens_sha256"))


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(table(spark, sf_dir, "documents"))


@query
def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op9_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 13))::BIGINT AS draw FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS source_docs FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sources
), weighted AS (
  SELECT *, (rank - 1) % 3 + 1 AS weight, 3 * source_size AS most FROM ranked
), summed AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS total, sum(weight) OVER ()::BIGINT AS weights,
    (sum(most) OVER o - most)::BIGINT AS most_before, (sum(weight) OVER o - weight)::BIGINT AS weight_before
  FROM weighted WINDOW o AS (ORDER BY most / weight, rank ROWS UNBOUNDED PRECEDING)
), stopped AS (
  SELECT *, weight * ((total - most_before) / (weights - weight_before)) >= most AS stops FROM summed
), targets AS (
  SELECT source, source_size, source_docs, CASE WHEN stops THEN most::DOUBLE ELSE weight * (
    (total - sum(CASE WHEN stops THEN most ELSE 0 END) OVER ()::BIGINT) / sum(CASE WHEN stops THEN 0 ELSE weight END) OVER ()::BIGINT
  ) END AS target FROM stopped
), shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS times FROM targets
), parts AS (
  SELECT *, floor(times) AS whole, times - floor(times) AS part, target - floor(times) * source_size AS rest FROM shares
), drawn AS (
  SELECT doc_id, sized.source, size, draw, source_size, target, whole, part, rest,
    (draw + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u,
    sqrt(greatest(size, 1)::DOUBLE / (source_size::DOUBLE / source_docs::DOUBLE)) AS lift
  FROM sized JOIN parts ON sized.source IS NOT DISTINCT FROM parts.source
), keyed AS (
  SELECT *, CASE WHEN part > 0 AND part < 1 THEN (u / (1 - u)) / ((part / (1 - part)) * lift) END AS key FROM drawn
), ordered AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size, draw ROWS UNBOUNDED PRECEDING) AS upto FROM keyed
)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN key IS NOT NULL AND upto - size / 2 < rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    return urls.url_filter(table(spark, sf_dir, "pages"), labels)


@query
def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = extract.main_text(pages, extract.train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "n_blocks", "n_main")


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    digests = F.sha2("output", 256), F.sha2(fim.restored(F.col("output"), F.col("form")), 256)
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digests[0].alias("output_sha256"), digests[1].alias("restored_sha256"),
    )


ORACLE["op12_fill_in_middle"] = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents
), drawn AS (
  SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || substr(d, 1, 8))::BIGINT % (len(u) + 1) AS a,
    ('0x' || substr(d, 9, 8))::BIGINT % (len(u) + 1) AS b,
    t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(d, 17, 8))::BIGINT % 100 >= 90 AS plain,
    ('0x' || substr(d, 25, 8))::BIGINT % 100 < 20 AS spm FROM cut
), pieces AS (
  SELECT *, array_to_string(u[:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
    array_to_string(u[greatest(a, b) + 1:], '') AS s FROM drawn
)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN NOT plain THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN NOT plain THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END)
    AS output_sha256, sha256(t) AS restored_sha256
FROM pieces
"""


@query
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""
  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')
"""
ORACLE["op13_search"] = f"""
WITH terms AS (
  SELECT doc_id, unnest({_TERMS}) AS term FROM documents
), lengths AS (
  SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id
), total AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM lengths
), asked AS (
  SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), counted AS (
  SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
  FROM counted CROSS JOIN total GROUP BY term, docs
), scored AS (
  SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // len))))::BIGINT AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) CROSS JOIN total GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
