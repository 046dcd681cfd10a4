"""One query per operator of this subpackage, over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.llm import ann, bpe, html, langid, mixing, phrases, pii, quality, simhash, spelling, substrings, tokenfile, topk
from gridmill.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Where the public vocabularies are; a parameter of every operator that needs one.
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode(docs, MULTI_RANKS, keep=("ids", "decoded")).select(
        "doc_id",
        F.expr("CAST(length(ids) / 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def remainder(divisor: int):
    """crc32 of the id as text, modulo a divisor; null ids have none."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    # a row without an id cannot be told to be a training row, so it is held out
    held_out = F.coalesce(remainder(4) == 2, F.lit(True))
    prototypes = langid.learn(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", "text", held_out.alias("held_out")), prototypes)


@query
def op8_curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.assign(docs).select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["words"]).alias("taken"),
        F.try_element_at("copies", F.lit(1))["position"].alias("position"),
    ).orderBy("position", "doc_id")


SQL["op8_curriculum_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), laid AS (
  SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY k, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM sized
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][(i % 3 + 1)::INT]::DOUBLE AS w, [-1, 0, 1][(i % 3 + 1)::INT]::DOUBLE / 2::DOUBLE AS tilt, 2 * source_size AS stop
  FROM sums
), ranked AS (
  SELECT *, coalesce(sum(stop) OVER before, 0)::DOUBLE AS stopped, coalesce(sum(w) OVER before, 0)::DOUBLE AS gone,
         (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget, sum(w) OVER () AS weights
  FROM weighed WINDOW before AS (ORDER BY stop / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), goals AS (
  SELECT source, source_size, tilt,
         least(stop::DOUBLE, coalesce((SELECT arg_min((budget - stopped) / (weights - gone), (stop / w, i)) FROM ranked
               WHERE stop / w >= (budget - stopped) / (weights - gone)) * w, stop::DOUBLE)) AS target
  FROM ranked
), copies AS (
  SELECT laid.*, source_size, target, tilt, floor(target)::BIGINT AS goal, e,
         greatest(0, least(size, floor(target)::BIGINT - start - e * source_size))::BIGINT AS words
  FROM laid JOIN goals ON laid.source IS NOT DISTINCT FROM goals.source, (VALUES (0), (1)) AS passes(e)
), placed AS (
  SELECT *, least(1::DOUBLE, ((start + e * source_size)::DOUBLE + words::DOUBLE / 2::DOUBLE) / goal::DOUBLE) AS q FROM copies
)
SELECT doc_id, size, source_size, target, sum(words)::BIGINT AS taken,
       min(2::DOUBLE * q / ((1::DOUBLE - tilt) + sqrt((1::DOUBLE - tilt) * (1::DOUBLE - tilt) + 4::DOUBLE * tilt * q))) FILTER (words > 0) AS position
FROM placed GROUP BY doc_id, k, start, size, source_size, target
"""


def quality_model(spark: SparkSession, folder: str):
    """Learned from the labelled rows that are not held out."""
    labels = table(spark, folder, "labels").where(remainder(5) != 0).select("doc_id", F.col("quality").alias("label"))
    return quality.fit(table(spark, folder, "documents"), labels)


@query
def op10_quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", F.coalesce(remainder(5) == 0, F.lit(True)).alias("held_out"))
    return quality.score(docs, quality_model(spark, folder))


@query
def op4_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.digests(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op5_adaptive_ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)


@query
def op7_dual_tree_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


@query
def op3_tag_path_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages").select("page_id", "url", "html"))


@query
def op6_token_file(spark: SparkSession, folder: str) -> DataFrame:
    store = shared_dir(spark)
    tokenfile.write(table(spark, folder, "documents").select("doc_id", "text"), store, BYTE_BPE, end=0, special=True)
    return tokenfile.read(spark, store, ids=False).drop("ids")


@query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents").select("lang", "text"))


SQL["op11_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
), starts AS (
  SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM worded, (VALUES (1), (2), (3), (4), (5)) AS sizes(m) WHERE len(w) >= m
), counts AS (
  SELECT lang, w[i:i + m - 1] AS p, count(*)::BIGINT AS f FROM starts GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, p, f AS a, unnest(range(1, len(p))) AS k FROM counts WHERE len(p) > 1
), scored AS (
  SELECT c.lang, c.p, c.a, c.k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.p = c.p[:c.k] JOIN counts y ON y.lang = c.lang AND y.p = c.p[c.k + 1:]
  JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), longer AS (
  SELECT lang, f, p AS q, unnest(range(2, len(p))) AS m FROM counts WHERE len(p) > 2
), inner_parts AS (
  SELECT lang, f, q, m, unnest(range(1, len(q) - m + 2)) AS i FROM longer
), inside AS (
  SELECT lang, q[i:i + m - 1] AS p, max(f) AS longest FROM inner_parts GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inside s ON s.lang = b.lang AND s.p = b.p WHERE s.longest IS NULL OR 100 * s.longest < 100 * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
       array_to_string(p, ' ') AS phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""


@query
def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents").select("doc_id", "text"))
