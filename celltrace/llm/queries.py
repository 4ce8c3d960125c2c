"""Registered queries ``opN_<name>`` and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltrace.llm import centroids, contain, divergence, hash_forest, mixing, neardup, page_text, quality, secret_scan, simhash, token_counts, tokenfiles, warc
from celltrace.llm.scratch import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op3_circulant_minhash")
def circulant_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates among all documents, on two-word shingles."""
    return neardup.near_duplicates(table(spark, folder, "documents"), width=2, percent=80)


@query(
    "op7_minhash_containment",
    """
    WITH item_words AS (
        SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM benchmark),
    item_shingles AS MATERIALIZED (
        SELECT DISTINCT item_id, unnest(list_transform(generate_series(1, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
        FROM item_words WHERE len(w) > 0),
    doc_words AS (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    doc_shingles AS (
        SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
        FROM doc_words WHERE len(w) > 0),
    sizes AS (SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id),
    shared AS (SELECT doc_id, item_id, count(*) AS k FROM doc_shingles JOIN item_shingles USING (s) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, n AS n_shingles, k AS n_shared, k::DOUBLE / n AS containment
    FROM shared JOIN sizes USING (item_id) WHERE 100 * k >= 80 * n
    """,
)
def minhash_containment(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items held by documents, on five-word shingles."""
    return contain.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op2_empirical_bayes")
def empirical_bayes(spark: SparkSession, folder: str) -> DataFrame:
    """Posterior quality of every document; its source is the site, the language its section."""
    return judged_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def judged_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, source, lang, evidence, host_share, path_share, posterior, kept)`` per row of ``docs``. Without labels of both kinds
    nothing is known: no evidence, all shares one half, all documents kept."""
    model, plain = quality.train(docs, labels), docs.select("doc_id", "source", "lang", "text")
    if model is None:
        unknown = [F.lit(0.0).alias("evidence"), *(F.lit(0.5).alias(c) for c in ("host_share", "path_share", "posterior"))]
        return plain.select("doc_id", "source", "lang", *unknown, F.lit(True).alias("kept"))
    scored = quality.with_evidence(plain, model).drop("text")
    judged = quality.with_posterior(Scratch(docs.sparkSession).cut(scored, "scored"), model, "source", "lang")
    return judged.select("doc_id", "source", "lang", "evidence", "host_share", "path_share", "posterior", (F.col("posterior") >= 0.5).alias("kept"))


@query("op9_block_mix")
def block_mix(spark: SparkSession, folder: str) -> DataFrame:
    """What a mix of all sources to their target weights takes from every document."""
    return mixing.mix_report(table(spark, folder, "documents"))


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op8_token_files")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents, written as files and read back."""
    return tokenfiles.token_table(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))


@query(
    "op1_seekable_warc",
    """
    WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
    g AS (SELECT hex, max(page_id) AS first FROM p GROUP BY hex)
    SELECT page_id, payload_bytes,
        array_to_string(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            ((((instr('0123456789abcdef', substr(hex, (5 * i // 4)::INT + 1, 1)) - 1) * 16
              + instr('0123456789abcdef', substr(hex, (5 * i // 4)::INT + 2, 1)) - 1) >> (3 - (5 * i) % 4)::INT) & 31)::INT + 1, 1)), '') AS payload_digest,
        CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
    FROM p JOIN g USING (hex)
    """,
)
def seekable_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as WARC records in seekable bundles, read back."""
    return warc.archive_report(table(spark, folder, "pages"))


@query("op4_randomness_scan")
def randomness_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents, by patterns and by randomness."""
    return secret_scan.scan(table(spark, folder, "documents"))


@query("op5_digest_cache")
def digest_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all documents through a cache that starts empty."""
    cache = Scratch(spark).path("token-counts")
    return token_counts.count_tokens(table(spark, folder, "documents"), cache, tokenizer("piece_bpe_32k.model"))


@query("op6_hash_forest")
def forest_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    return hash_forest.search(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


@query("op10_site_templates")
def site_templates(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    return page_text.extract(table(spark, folder, "pages"))


@query(
    "op11_divergence_cube",
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents),
    w AS MATERIALIZED (
        SELECT id, lang, source, term, count(*) AS n
        FROM (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d) GROUP BY ALL),
    kept AS MATERIALIZED (SELECT lang, term, sum(n)::HUGEINT AS whole FROM w GROUP BY lang, term HAVING count(*) >= 30),
    langs AS (SELECT lang, count(*) AS v, sum(whole) + 5 * count(*) AS total FROM kept GROUP BY lang),
    groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
    c AS MATERIALIZED (SELECT lang, source, term, sum(n)::HUGEINT AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
    totals AS (SELECT g.lang, g.source, coalesce(sum(n), 0) + 5 * any_value(v) AS total FROM groups g JOIN langs USING (lang) LEFT JOIN c USING (lang, source) GROUP BY ALL),
    p AS MATERIALIZED (
        SELECT k.lang, t.source, k.term, coalesce(n, 0) AS n, (1 + (1000000000 * (coalesce(n, 0) + 5)) // t.total)::BIGINT AS p,
            (1 + (1000000000 * (whole + 5)) // l.total)::BIGINT AS q
        FROM kept k JOIN langs l USING (lang) JOIN totals t USING (lang) LEFT JOIN c ON c.lang = k.lang AND c.source = t.source AND c.term = k.term),
    sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    terms AS (SELECT lang, source, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q)
    SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item))::INT AS rank FROM pairs
    UNION ALL
    SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item))::INT AS r FROM terms QUALIFY r <= 50
    """,
)
def divergence_cube(spark: SparkSession, folder: str) -> DataFrame:
    """How far the sources of each language differ, and by which terms."""
    return divergence.divergences(table(spark, folder, "documents"))


@query("op12_deletion_simhash")
def deletion_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates among all documents by SimHash fingerprints."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


def _clusters_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds one after the other, every vector against all centroids."""
    steps = [
        """v AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q, sha256('3:' || vec_id) AS hash FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "x AS MATERIALIZED (SELECT vec_id, unnest(q) AS x, generate_subscripts(q, 1) AS j FROM v)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY hash) - 1 AS c, q FROM v QUALIFY c < {k})",
    ]
    for r in range(rounds + 1):
        nearest = "list_sum(list_transform(list_zip(v.q, m.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, min({{'d': d, 'c': c}}) AS b FROM (SELECT vec_id, c, {nearest} AS d FROM v, c{r} m) GROUP BY vec_id)")
        if r < rounds:
            steps.append(
                f"""c{r + 1} AS MATERIALIZED (
                SELECT c, list(floor_mean ORDER BY j) AS q FROM (
                    SELECT b.c AS c, j, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS floor_mean FROM a{r} JOIN x USING (vec_id) GROUP BY ALL)
                GROUP BY c UNION ALL SELECT c, q FROM c{r} WHERE c NOT IN (SELECT b.c FROM a{r}))"""
            )
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, b.c::INT AS cluster, b.d::BIGINT AS distance, (sum(b.d) OVER (PARTITION BY b.c))::BIGINT AS cluster_inertia,
            (sum(b.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(q, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} m ON m.c = b.c"""


@query("op13_vantage_centroids", _clusters_sql())
def vantage_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Eight clusters of all vectors after ten rounds."""
    return centroids.cluster_vectors(table(spark, folder, "embeddings"))
