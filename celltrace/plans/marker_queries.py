"""Queries on marker enrichment, rankings, annotation and cell cycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from celltrace.functions import scalars
from celltrace.operators import cycle, markers
from celltrace.plans.count_queries import CLUSTERS, UP_TO_LOGNORM
from celltrace.plans.proxies import Tables, text
from celltrace.plans.registry import long, query, rounded
from celltrace.schema import CELL
from celltrace.session import cut

ORA = """
dense AS MATERIALIZED (SELECT c.sample, c.cell, g.gene, coalesce(l.x, 0) AS x FROM good c CROSS JOIN (SELECT DISTINCT gene FROM f3) g
          LEFT JOIN lognorm l ON l.sample = c.sample AND l.cell = c.cell AND l.gene = g.gene),
nup AS (SELECT CAST(ceil(count(DISTINCT gene) * 0.05) AS BIGINT) AS n FROM f3),
drawn AS MATERIALIZED (SELECT sample, cell, gene FROM (SELECT *, row_number() OVER (PARTITION BY sample, cell ORDER BY x DESC, gene) AS rn FROM dense), nup WHERE rn <= n),
net AS (SELECT p_brand AS cell_type, gene FROM genes_of WHERE gene IN (SELECT gene FROM f3)),
sz AS (SELECT cell_type, count(*) AS k FROM net GROUP BY 1 HAVING count(*) >= 3),
ov AS (SELECT sample, cell, cell_type, count(*) AS a FROM drawn JOIN net USING (gene) GROUP BY 1, 2, 3),
grid AS MATERIALIZED (SELECT c.sample, c.cell, sz.cell_type, k, coalesce(a, 0) AS a FROM good c CROSS JOIN sz
         LEFT JOIN ov ON ov.sample = c.sample AND ov.cell = c.cell AND ov.cell_type = sz.cell_type),
pairs AS (SELECT DISTINCT k, a, n FROM grid, nup),
terms AS (SELECT k, a, n, unnest(range(a, least(k, n) + 1)) AS i FROM pairs),
tail AS MATERIALIZED (SELECT k, a, sum(exp(lgamma(k + 1) - lgamma(i + 1) - lgamma(k - i + 1) + lgamma(20001 - k) - lgamma(n - i + 1) - lgamma(20001 - k - n + i)
                - lgamma(20001) + lgamma(n + 1) + lgamma(20001 - n))) AS p FROM terms GROUP BY k, a),
ora AS (SELECT sample, cell, cell_type, a AS overlap, k AS set_size, CASE WHEN a = 0 THEN 0 ELSE greatest(0, -log10(p)) END AS score FROM grid JOIN tail USING (k, a))"""
UP_TO_ORA = UP_TO_LOGNORM + "," + ORA


def ora(t: Tables):
    t.keep("filtered", "good_cells")
    return markers.ora_scores(t.lognorm, t.good_cells.select(*CELL), t.genes, t.net)


@query("ora_scores", f"WITH {UP_TO_ORA} SELECT sample, cell, cell_type, overlap, set_size, round(score, 4) + 0.0 AS score FROM ora")
def _(t: Tables):
    return ora(t).withColumn("score", rounded("score", 4))


@query(
    "replace_nonfinite",
    """WITH s AS (SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_discount = 0 THEN 'Infinity'::DOUBLE WHEN l_tax = 0 THEN 'NaN'::DOUBLE ELSE -log10(l_discount) END AS score FROM lineitem)
       SELECT l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
              round(CASE WHEN isfinite(score) THEN score ELSE (SELECT max(score) FROM s WHERE isfinite(score)) END, 6) + 0.0 AS score FROM s""",
)
def _(t: Tables):
    score = F.when(F.col("l_discount") == 0, float("inf")).when(F.col("l_tax") == 0, float("nan")).otherwise(-F.log10("l_discount"))
    rows = t.read("lineitem").select("l_orderkey", "l_partkey", long("l_linenumber").alias("l_linenumber"), score.alias("score"))
    return markers.replace_nonfinite(rows).withColumn("score", rounded("score"))


def t_test_sql(rows: str, group: str, source: str, value: str) -> str:
    """Group against rest by direct moments of both sides."""
    return f"""
g AS (SELECT {group}, {source}, count(*)::DOUBLE AS n1, avg({value}) AS m1, var_samp({value}) AS v1 FROM {rows} GROUP BY 1, 2),
rest AS (SELECT q.{group}, r.{source}, avg(r.{value}) AS m0, var_samp(r.{value}) AS v0
         FROM (SELECT DISTINCT {group} FROM {rows}) q JOIN {rows} r ON r.{group} <> q.{group} GROUP BY 1, 2),
tt AS (SELECT g.{group}, g.{source}, (m1 - m0) / sqrt(v1 / n1 + v0 / n1) AS statistic, m1 - m0 AS meanchange,
              pow(v1 / n1 + v0 / n1, 2) / ((pow(v1 / n1, 2) + pow(v0 / n1, 2)) / (n1 - 1)) AS df
       FROM g JOIN rest USING ({group}, {source}))"""


EMBEDDED = """
emb AS (SELECT CAST(vec_id AS VARCHAR) AS cell, CAST(label AS VARCHAR) AS grp, unnest(embedding)::DOUBLE AS score, CAST(generate_subscripts(embedding, 1) - 1 AS VARCHAR) AS source FROM embeddings)"""


def embedding_scores(t: Tables):
    """Every dimension of a vector as one source."""
    long_rows = t.vectors.select(F.lit("e").alias("sample"), text("id").alias("cell"), F.posexplode("v").alias("source", "score"))
    scores = long_rows.withColumn("source", text("source"))
    groups = t.vectors.select(F.lit("e").alias("sample"), text("id").alias("cell"), F.col("label").alias("group"))
    return scores, groups


@query(
    "rank_sources",
    f"""WITH {EMBEDDED}, {t_test_sql('emb', 'grp', 'source', 'score')}
        SELECT grp AS "group", source, round(statistic, 6) + 0.0 AS statistic, round(meanchange, 6) + 0.0 AS meanchange, round(df, 6) + 0.0 AS df FROM tt""",
)
def _(t: Tables):
    scores, groups = embedding_scores(t)
    ranked = markers.rank_sources(scores, groups, "source")
    return ranked.select("group", "source", *[rounded(c).alias(c) for c in ("statistic", "meanchange", "df")])


@query("source_rankings")
def _(t: Tables):
    """Full ranking table with p-values (checked in the tests by numerical integration)."""
    scores, groups = embedding_scores(t)
    return markers.source_rankings(scores, groups, "source")


@query(
    "source_pvalues",
    f"""WITH {EMBEDDED}, {t_test_sql('emb', 'grp', 'source', 'score')},
        -- two-sided tail of Student's t: with t = sqrt(df) tan(a) its density is c cos(a)^(df - 1); Simpson's rule in 2,000 steps
        a AS (SELECT grp, source, df, atan(abs(statistic) / sqrt(df)) AS top, exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi()) AS c FROM tt),
        s AS (SELECT grp, source, any_value(c) * any_value(top) / 2000 / 3 * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * pow(cos(top * i / 2000), df - 1)) AS half
              FROM a, generate_series(0, 2000) AS g(i) GROUP BY grp, source)
        SELECT grp AS "group", source, round(greatest(1 - 2 * half, 0), 6) + 0.0 AS pvalue FROM s""",
)
def _(t: Tables):
    scores, groups = embedding_scores(t)
    return markers.source_rankings(scores, groups, "source").select("group", "source", rounded("pvalue").alias("pvalue"))


@query(
    "bh_adjust",
    """WITH p AS (SELECT event_id, event_type, value / 500.0 AS pvalue FROM events),
       r AS (SELECT *, rank() OVER (PARTITION BY event_type ORDER BY pvalue) + count(*) OVER (PARTITION BY event_type, pvalue) - 1 AS k, count(*) OVER (PARTITION BY event_type) AS m FROM p),
       q AS (SELECT *, least(1.0, min(pvalue * m / k) OVER (PARTITION BY event_type ORDER BY pvalue DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS padj FROM r)
       SELECT event_id, event_type, round(pvalue, 6) + 0.0 AS pvalue, round(padj, 6) + 0.0 AS padj FROM q""",
)
def _(t: Tables):
    tests = t.read("events").select("event_id", "event_type", (F.col("value") / 500.0).alias("pvalue"))
    done = markers.bh_adjust(tests, ["event_type"])
    return done.select("event_id", "event_type", rounded("pvalue").alias("pvalue"), rounded("padj").alias("padj"))


ANNOTATION = f"""
acts AS (SELECT c.leiden, o.cell_type, o.score FROM ora o JOIN clusters c USING (sample, cell)),
{t_test_sql('acts', 'leiden', 'cell_type', 'score')},
placed AS (SELECT *, row_number() OVER (PARTITION BY leiden ORDER BY statistic DESC NULLS LAST, cell_type) AS place FROM tt),
tops AS (SELECT leiden, string_agg(cell_type, '; ' ORDER BY place) AS names, min(cell_type) FILTER (WHERE place = 1) AS best FROM placed WHERE place <= 10 GROUP BY leiden)"""


def annotation(t: Tables):
    scores = markers.replace_nonfinite(cut(ora(t)))
    ranked = markers.rank_sources(scores, t.clusters.withColumnRenamed("leiden", "group"))
    return markers.top_celltypes(ranked)


@query("top_celltypes", f"WITH {UP_TO_ORA}, {CLUSTERS}, {ANNOTATION} SELECT leiden, names FROM tops")
def _(t: Tables):
    return annotation(t).select(F.col("group").alias("leiden"), F.array_join("names", "; ").alias("names"))


@query(
    "annotate_cells",
    f"""WITH {UP_TO_ORA}, {CLUSTERS}, {ANNOTATION}
        SELECT c.sample, c.cell, c.leiden, best AS ora_cell_type, coalesce(names, '') AS ora_top_celltypes FROM clusters c LEFT JOIN tops USING (leiden)""",
)
def _(t: Tables):
    return markers.annotate_cells(t.clusters, annotation(t))


@query(
    "marker_table",
    """SELECT cell_type, upper(substr(s, 1, 1)) || lower(substr(s, 2)) AS genesymbol
       FROM (SELECT DISTINCT p_brand AS cell_type, p_name AS s FROM part WHERE p_size % 2 = 0)""",
)
def _(t: Tables):
    rows = t.read("part").select(F.col("p_brand").alias("cell_type"), F.col("p_name").alias("genesymbol"), (F.col("p_size") % 2 == 0).alias("mouse"))
    return markers.marker_table(rows)


@query(
    "ortholog_map",
    """SELECT min(p_partkey) AS pos, upper(substr(w, 1, 1)) || lower(substr(w, 2)) AS mouse_symbol
       FROM (SELECT p_partkey, split_part(p_name, ' ', 2) AS w FROM part WHERE p_name NOT LIKE 'red %') GROUP BY w""",
)
def _(t: Tables):
    part = t.read("part")
    human = F.upper("p_name").alias("human_symbol")
    mouse = scalars.capitalize(F.split_part("p_name", F.lit(" "), F.lit(2))).alias("mouse_symbol")
    table = part.filter("p_name NOT LIKE 'red %'").select(human, mouse).distinct()
    return markers.ortholog_map(part.select(F.col("p_partkey").alias("pos"), human), table)


BINS = """
avgs AS (SELECT g.gene, coalesce(sum(l.x), 0) / (SELECT count(*) FROM good) AS a FROM (SELECT DISTINCT gene FROM f3) g LEFT JOIN lognorm l USING (gene) GROUP BY g.gene),
bins AS (SELECT gene, CAST(floor(rank() OVER (ORDER BY a) / greatest(1, round_even(count(*) OVER () / 24.0, 0))) AS BIGINT) AS bin FROM avgs)"""


def set_sql(name: str, p_type: str, size: str) -> str:
    return f"""
m_{name} AS (SELECT b.gene, b.bin FROM bins b JOIN genes_of USING (gene) WHERE p_type = '{p_type}'),
c_{name} AS (SELECT gene FROM (SELECT gene, row_number() OVER (PARTITION BY bin ORDER BY gene) AS rn FROM bins
             WHERE bin IN (SELECT bin FROM m_{name}) AND gene NOT IN (SELECT gene FROM m_{name})) WHERE rn <= {size}),
{name} AS (SELECT c.sample, c.cell,
           coalesce(sum(l.x) FILTER (WHERE l.gene IN (SELECT gene FROM m_{name})), 0) / (SELECT count(*) FROM m_{name})
           - coalesce(sum(l.x) FILTER (WHERE l.gene IN (SELECT gene FROM c_{name})), 0) / (SELECT count(*) FROM c_{name}) AS score
           FROM good c LEFT JOIN lognorm l USING (sample, cell) GROUP BY 1, 2)"""


SIZE = "(SELECT least(count(*) FILTER (WHERE p_type = 'SMALL'), count(*) FILTER (WHERE p_type = 'LARGE')) FROM bins JOIN genes_of USING (gene))"
PHASES = f"""{BINS}, {set_sql('s', 'SMALL', SIZE)}, {set_sql('g', 'LARGE', SIZE)},
phases AS (SELECT s.sample, s.cell, s.score AS s_score, g.score AS g2m_score,
           CASE WHEN s.score < 0 AND g.score < 0 THEN 'G1' WHEN g.score > s.score THEN 'G2M' ELSE 'S' END AS phase FROM s JOIN g USING (sample, cell))"""


@query(
    "gene_set_score",
    f"WITH {UP_TO_LOGNORM}, {BINS}, {set_sql('s', 'SMALL', '50')} SELECT sample, cell, round(score, 6) + 0.0 AS score FROM s",
)
def _(t: Tables):
    t.keep("counts", "passed", "filtered", "good_cells", "lognorm")
    scored = cycle.gene_set_score(t.lognorm, t.good_cells.select(*CELL), t.genes, t.gene_set("SMALL"), draw=F.col("gene"))
    return scored.withColumn("score", rounded("score"))


def phases(t: Tables):
    t.keep("counts", "passed", "filtered", "good_cells", "lognorm")
    return cycle.cell_cycle_phase(t.lognorm, t.good_cells.select(*CELL), t.genes, t.gene_set("SMALL"), t.gene_set("LARGE"), draw=F.col("gene"))


@query(
    "cell_cycle_phase",
    f"WITH {UP_TO_LOGNORM}, {PHASES} SELECT sample, cell, round(s_score, 6) + 0.0 AS s_score, round(g2m_score, 6) + 0.0 AS g2m_score, phase FROM phases",
)
def _(t: Tables):
    return phases(t).select(*CELL, rounded("s_score").alias("s_score"), rounded("g2m_score").alias("g2m_score"), "phase")


@query(
    "phase_proportions",
    f"""WITH {UP_TO_LOGNORM}, {PHASES}, {CLUSTERS},
        n AS (SELECT leiden, phase, count(*) AS n FROM phases JOIN clusters USING (sample, cell) GROUP BY 1, 2),
        k AS (SELECT leiden, sum(n) AS total FROM n GROUP BY 1)
        SELECT k.leiden, p.phase, coalesce(n.n, 0) AS n, round(coalesce(n.n, 0) / total, 6) + 0.0 AS fraction
        FROM k CROSS JOIN (SELECT DISTINCT phase FROM n) p LEFT JOIN n ON n.leiden = k.leiden AND n.phase = p.phase""",
)
def _(t: Tables):
    called = cut(phases(t).join(t.clusters, CELL))
    return cycle.phase_proportions(called).withColumn("fraction", rounded("fraction"))
