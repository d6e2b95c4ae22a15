"""The thin queries opN_<name>: each applies its operator to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    covertree, decontamination, katz, language, mixing, pii, quality, resampling, sharding, simhash, templates, urls, whitening,
)
from .common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~language.held_out()))
    found = language.predict(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs.where(~quality.held_out()), table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, distance=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(table(spark, sf_dir, "documents"), katz.held_out())


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op8_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.cosine_links(table(spark, sf_dir, "embeddings"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_sharding, op3_quality, op4_simhash, op5_katz, op6_decontamination, op7_personal_data, op8_covertree,
        op9_url_filter, op10_mixing, op11_resampling, op12_html_extraction, op13_whitening,
    )
}

_SPACE = r"[\x20\x09-\x0D]+"

ORACLE_SQL = {
    "op6_decontamination": f"""
        WITH items AS (
            SELECT item_id, list_filter(string_split_regex(lower(text), '{_SPACE}'), lambda x: x <> '') AS w FROM benchmark
        ), item_words AS (
            SELECT item_id, w, least(5, len(w)) AS k FROM items WHERE len(w) > 0
        ), item_shingles AS (
            SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
            FROM item_words
        ), sizes AS (
            SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id
        ), docs AS (
            SELECT doc_id, list_filter(string_split_regex(lower(text), '{_SPACE}'), lambda x: x <> '') AS w FROM documents
        ), doc_shingles AS (
            SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
            FROM docs, (SELECT DISTINCT k FROM item_words) WHERE len(w) >= k
        )
        SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_found
        FROM doc_shingles JOIN item_shingles USING (k, s) JOIN sizes USING (item_id)
        GROUP BY doc_id, item_id, n HAVING count(*) >= ceil(0.8 * n - 1e-9)
    """,
    "op8_covertree": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
        ), usable AS (
            SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM vectors
            WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0
        ), links AS (
            SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.9
        ), reach AS (
            SELECT vec_id AS u, vec_id AS v FROM vectors
            UNION
            SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v
        ), least AS (
            SELECT u, min(v) AS component_id FROM reach GROUP BY u
        )
        SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.u = e.vec_id) AS n_links, c.component_id,
               e.vec_id = c.component_id AS kept
        FROM embeddings e JOIN least c ON c.u = e.vec_id
    """,
    "op10_mixing": """
        WITH sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
                   substr(md5(concat_ws(':', 'mix', CAST(doc_id AS VARCHAR), md5(text))), 1, 15) AS k FROM documents
        ), sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM sized GROUP BY source
        ), ranked AS (
            SELECT *, 3 * source_size / weight AS fill, sum(source_size) OVER () AS whole,
                   coalesce(sum(3 * source_size) OVER before, 0) AS held, sum(weight) OVER later AS free
            FROM sources WINDOW
                before AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                later AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        ), level AS (
            -- the first source, by how soon it fills up, that stays below its cap
            SELECT CAST(whole - held AS DOUBLE) / free AS level FROM ranked
            WHERE CAST(whole - held AS DOUBLE) / free < fill ORDER BY fill LIMIT 1
        ), targets AS (
            SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * coalesce((SELECT level FROM level), 0)) AS target
            FROM sources
        ), budgets AS (
            SELECT *, least(3 * source_size, CAST(round(target) AS BIGINT)) AS budget FROM targets
        ), ordered AS (
            SELECT s.doc_id, s.size, b.source_size, b.target, b.budget,
                   coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM sized s JOIN budgets b ON b.source IS NOT DISTINCT FROM s.source
        )
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
               CAST(CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
                    + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
        FROM ordered
    """,
    "op11_resampling": """
        WITH crc_table AS (
            -- CRC-32 of a byte by its rule: eight steps of the reflected polynomial
            SELECT list(c ORDER BY b) AS t FROM (
                SELECT b, list_reduce([CAST(b AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS c
                FROM range(256) AS r(b))
        ), words AS (
            SELECT doc_id, true AS raw, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
            UNION ALL
            SELECT NULL, false, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark
        ), terms AS (
            SELECT doc_id, raw, unnest(w) AS word FROM words
        ), vocabulary AS (
            SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM terms)
        ), bucketed AS (
            SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2),
                    lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
                lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
            FROM vocabulary, crc_table
        ), counts AS (
            SELECT bucket, count(*) FILTER (raw) AS s, count(*) FILTER (NOT raw) AS t FROM terms JOIN bucketed USING (word) GROUP BY bucket
        ), gains AS (
            SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * (sum(s) OVER () + 10000))
                / (CAST(s + 1 AS DOUBLE) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain FROM counts
        ), weights AS (
            SELECT doc_id, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
            FROM terms JOIN bucketed USING (word) JOIN gains USING (bucket) WHERE raw GROUP BY doc_id
        ), scored AS (
            SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
                + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
            FROM words d LEFT JOIN weights USING (doc_id) WHERE d.raw
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                10 * count(*) OVER (PARTITION BY n_features >= 20) // 100 AS drawn FROM scored
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM placed
    """,
}
