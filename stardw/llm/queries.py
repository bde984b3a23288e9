"""The registered queries of this package: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw.llm import adaptive_rules, lattice_sampling, line_blocks, maxent_lm, mixing, partenum, perfect_dedup, secret_forest, segment_trees, toxic_terms, training_order, warc, zone_maps
from stardw.llm.tables import stored, table
from stardw.session import work_folder


def op7_line_blocks(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return line_blocks.extracted(pages).withColumn("n_chars", F.length("text").cast("long"))


def op8_adaptive_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    counts = stored(adaptive_rules.measured(documents).drop("text"), "op8-counts")
    judged = adaptive_rules.verdicts(counts, adaptive_rules.fences(counts))
    shown = [F.col(f"quality.{c}").alias(c) for c in adaptive_rules.COUNTS[:5]]
    return judged.select("doc_id", *shown, "base_failed", "kept", "lang", "source")


def op1_lattice_sampling(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return lattice_sampling.encoded(documents).select(
        F.col("key").alias("doc_id"), "sample", F.size("ids").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_digest"), "log_prob", "perturbed", "log_inclusion", "exact",
    )


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.taken(documents).withColumnRenamed("key", "doc_id")


def op3_training_order(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    placed = training_order.write(documents, work_folder(spark, "op3-shards"))
    return stored(placed, "op3-placed").withColumnRenamed("key", "doc_id")


def op4_maxent_lm(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return maxent_lm.score(documents).withColumnRenamed("key", "doc_id")


def op5_partenum(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return partenum.classes(documents).select(
        F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id")
    )


def op6_perfect_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    kept = F.col("key").eqNullSafe(F.col("keep"))
    return perfect_dedup.deduplicate(documents).select(
        F.col("key").alias("doc_id"), F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"), kept.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op9_secret_forest(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return secret_forest.scan(documents).select(
        F.col("key").alias("doc_id"), "at", "run", F.sha2("value", 256).alias("value_sha256"),
        F.length("value").alias("value_chars"), "label", "held_out", "probability", "is_secret",
    )


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = warc.round_trip(pages, work_folder(spark, "op10-archive"))
    return found.select(
        F.col("record_id").cast("long").alias("page_id"),
        F.coalesce(F.length("payload"), "length").cast("long").alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), "digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"),
    )


def op11_toxic_terms(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = toxic_terms.train(documents, table(spark, folder, "labels").select("doc_id", "toxic"))
    return toxic_terms.scored(documents, model).withColumnRenamed("key", "doc_id")


def op12_zone_maps(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return zone_maps.clustered(embeddings).select(
        F.col("key").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_segment_trees(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("text", "lang", "source")
    return segment_trees.audited(documents)


def _lloyd_sql(rounds: int = 3) -> str:
    """The contract of op12 with every distance computed."""
    parts = ["""
        v AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x:
                CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        e AS MATERIALIZED (SELECT row, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM v),
        first AS (SELECT row, row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c FROM v
            QUALIFY c < 16),
        c0 AS MATERIALIZED (SELECT c, i, x FROM first JOIN e USING (row))"""]
    for turn in range(rounds + 1):
        parts.append(f"""
        d{turn} AS MATERIALIZED (
            SELECT row, c, CAST(sum((e.x - o.x) * (e.x - o.x)) AS BIGINT) AS distance
            FROM e JOIN c{turn} o USING (i) GROUP BY row, c
            QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, c) = 1)""")
        if turn < rounds:
            parts.append(f"""
        c{turn + 1} AS MATERIALIZED (
            SELECT o.c, o.i, coalesce(m.x, o.x) AS x FROM c{turn} o LEFT JOIN (
                SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x
                FROM (SELECT c, i, sum(x) AS s, count(*) AS n FROM e JOIN d{turn} USING (row) GROUP BY ALL)) m
            ON m.c = o.c AND m.i = o.i)""")
    return "WITH " + ",".join(parts) + f"""
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance,
            CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
            CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM d{rounds} JOIN v USING (row)
        JOIN (SELECT c, sha256(string_agg(x, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c) USING (c)
    """


QUERIES = {f.__name__: f for f in [
    op1_lattice_sampling, op2_mixing, op3_training_order, op4_maxent_lm, op5_partenum, op6_perfect_dedup, op7_line_blocks,
    op8_adaptive_rules, op9_secret_forest, op10_warc, op11_toxic_terms, op12_zone_maps, op13_segment_trees,
]}

ORACLES: dict[str, str] = {
    "op12_zone_maps": _lloyd_sql(),
    "op13_segment_trees": r"""
        WITH d AS MATERIALIZED (
            SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        t AS MATERIALIZED (
            SELECT lang, source, doc, term, count(*) AS n
            FROM (SELECT lang, source, doc, unnest(terms) AS term FROM d) GROUP BY ALL),
        kept AS MATERIALIZED (
            SELECT lang, term, CAST(sum(n) AS HUGEINT) AS lang_n FROM t GROUP BY ALL HAVING count(*) >= 30),
        c AS MATERIALIZED (
            SELECT lang, source, term, CAST(sum(n) AS HUGEINT) AS n FROM t SEMI JOIN kept USING (lang, term)
            GROUP BY ALL),
        v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY ALL),
        g AS MATERIALIZED (
            SELECT lang, source, coalesce(any_value(v.v), 0) AS v, coalesce(any_value(lang_total), 0) AS lang_total,
                coalesce(any_value(s.total), 0) AS total
            FROM (SELECT DISTINCT lang, source FROM d)
            LEFT JOIN v USING (lang)
            LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) s USING (lang, source) GROUP BY ALL),
        p AS MATERIALIZED (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) AS p,
                1 + (1000000000 * (k.lang_n + 5)) // (g.lang_total + 5 * g.v) AS q
            FROM g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
                FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) x
            ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
        ranked AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value,
            CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM ranked QUALIFY part = 'pair' OR rank <= 50
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM p)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END
                AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
        FROM g
    """,
    "op6_perfect_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
            doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)
    """,
}
