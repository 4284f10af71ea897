"""Registered queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cartlake.llm import bitslices, conversations, decontaminate, embeddings, licenses, pieces, quality, simhash, spotsigs, suffix_dedup, token_counts, toxicity, warc
from cartlake.llm.common import table
from cartlake.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


@query("op5_simhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"), pieces.model_path(), limit=4096)


@query("op6_sentencepiece")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), pieces.model_path())


@query(
    "op7_decontaminate",
    r"""
    WITH cut AS (
      SELECT doc_id, rowid AS r, list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '),
        lambda x: x <> '') AS w FROM (SELECT *, row_number() OVER () AS rowid FROM documents)),
    item AS (
      SELECT item_id, list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '),
        lambda x: x <> '') AS w FROM benchmark),
    win AS (
      SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS g
      FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0)),
    size AS (SELECT DISTINCT k FROM win),
    gram AS (
      SELECT r, i, k, array_to_string(w[i + 1 : i + k], ' ') AS g
      FROM (SELECT r, w, k, unnest(range(len(w) - k + 1)) AS i FROM cut, size WHERE len(w) >= k)),
    hit AS (SELECT r, i, gram.k, item_id FROM gram JOIN win USING (g, k)),
    word AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
    owner AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
              FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(word.n, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(owner.n, 0) AS BIGINT) AS n_items, sha256(coalesce(owner.ids, '')) AS items_sha256,
           coalesce(word.n, 0) > 0 AS contaminated
    FROM cut LEFT JOIN word USING (r) LEFT JOIN owner USING (r)""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


@query("op3_warc")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.graded(docs, toxicity.learned(docs, labels)).withColumn("held_out", quality.held_out())


@query(
    "op1_embedding_near_dedup",
    """
    WITH RECURSIVE unit AS (
      SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    link AS (
      SELECT x.vec_id AS a, y.vec_id AS b FROM unit x JOIN unit y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
      WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
    reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
    home AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
    n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
    SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(home.b, vec_id)) AS component_id,
           vec_id = least(vec_id, coalesce(home.b, vec_id)) AS kept
    FROM embeddings LEFT JOIN home ON home.a = vec_id LEFT JOIN n ON n.a = vec_id""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.links(table(spark, sf_dir, "embeddings"), cosine=0.98)


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


@query("op8_suffix_array_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"), length=200)


@query(
    "op12_ranked_search",
    r"""
    WITH doc AS (
      SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '),
        lambda x: x <> '') AS w FROM documents),
    item AS (
      SELECT row_number() OVER () AS q, item_id, list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '),
        lambda x: x <> '') AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
    total AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM doc WHERE len(w) > 0),
    asked AS (SELECT q, item_id, t, count(*) AS c FROM (SELECT q, item_id, unnest(w) AS t FROM item) GROUP BY ALL),
    term AS (
      SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM doc) GROUP BY ALL),
    held AS (SELECT t, count(*) AS df FROM term GROUP BY t),
    score AS (
      SELECT q, item_id, r, doc_id, CAST(sum(c * CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM asked JOIN term USING (t) JOIN held USING (t), total GROUP BY ALL),
    ranked AS (
      SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank
      FROM score WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslices.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


@query("op11_document_fingerprints")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edits(table(spark, sf_dir, "documents"))


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repaired(conversations.damaged(rows), rows)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
