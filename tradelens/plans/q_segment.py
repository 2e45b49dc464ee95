"""Segmentation bound to the test tables: key = buyer (customer).

History 1996-2000 (CAGR 1996 -> 2000, n = 4), last full year 2000; 2001 is
partial like the reference's 2024.  The rule labels (M-7) are the
SQL-checkable twin of the k-means labels.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelens.functions.numeric import fround
from tradelens.operators import segment as G
from tradelens.operators import warehouse as W
from tradelens.params import SegmentParams
from tradelens.plans.registry import register
from tradelens.sources.tables import read_table, trade, with_trade

PARAMS = SegmentParams(start_year=1996, end_year=2000, last_year=2000)
KMEANS_RESTARTS = 10


def features(spark, sf_dir):
    return G.segment_features(trade(spark, sf_dir), "buyer", "shipment_date", "value", PARAMS)


def rules(spark, sf_dir):
    return G.rule_labels(features(spark, sf_dir), PARAMS)


FEAT_SQL = (
    """monthly AS (SELECT buyer AS key, shipment_date AS ym, sum(value) AS m_value, count(*) AS n
                  FROM trade WHERE year(shipment_date) BETWEEN 1996 AND 2000 GROUP BY 1, 2)""",
    """per AS (SELECT key,
       CAST(coalesce(sum(CASE WHEN year(ym) = 1996 THEN m_value END), 0) AS DOUBLE) AS start_total,
       CAST(coalesce(sum(CASE WHEN year(ym) = 2000 THEN m_value END), 0) AS DOUBLE) AS end_total,
       CAST(coalesce(sum(CASE WHEN year(ym) = 2000 THEN m_value END), 0) AS DOUBLE) AS last_year_fob,
       count(*) AS order_frequency, CAST(sum(m_value) AS DOUBLE) / sum(n) AS avg_order_value
       FROM monthly GROUP BY key)""",
    """feat AS (SELECT key, coalesce(pow(end_total / nullif(start_total, 0), 1.0 / 4.0) - 1, 0.0) AS cagr,
                       order_frequency, avg_order_value, last_year_fob
                FROM per WHERE order_frequency >= 6)""",
    """lab AS (SELECT feat.*,
                      CASE WHEN cagr >= 0 AND last_year_fob >= m THEN 'Core'
                           WHEN cagr >= 0 THEN 'Rising Star'
                           WHEN last_year_fob >= m THEN 'Declining' ELSE 'Untapped' END AS cluster_label
               FROM feat CROSS JOIN (SELECT quantile_cont(last_year_fob, 0.5) AS m FROM feat) q)""",
)


@register("segment_features", with_trade("""
SELECT key, round(cagr, 6) AS cagr, order_frequency, round(avg_order_value, 6) AS avg_order_value,
       last_year_fob FROM feat""", *FEAT_SQL), ids=("A-17", "J-5"))
def segment_features(spark, sf_dir):
    f = features(spark, sf_dir)
    return f.select("key", fround("cagr", 6).alias("cagr"), "order_frequency",
                    fround("avg_order_value", 6).alias("avg_order_value"), "last_year_fob")


@register("segment_scaled", with_trade("""
SELECT key, round((cagr - avg(cagr) OVER ()) / stddev_pop(cagr) OVER (), 6) AS cagr,
       round((order_frequency - avg(order_frequency) OVER ()) / stddev_pop(order_frequency) OVER (), 6)
         AS order_frequency,
       round((ln(1 + avg_order_value) - avg(ln(1 + avg_order_value)) OVER ())
             / stddev_pop(ln(1 + avg_order_value)) OVER (), 6) AS avg_order_value,
       round((ln(1 + last_year_fob) - avg(ln(1 + last_year_fob)) OVER ())
             / stddev_pop(ln(1 + last_year_fob)) OVER (), 6) AS last_year_fob
FROM feat""", *FEAT_SQL), ids=("M-1",))
def segment_scaled(spark, sf_dir):
    s = G.scale_features(features(spark, sf_dir))
    return s.select("key", *[fround(c, 6).alias(c) for c in G.FEATURES])


@register("segment_rules", with_trade("""
SELECT key, cluster_label, round(cagr, 6) AS cagr, last_year_fob FROM lab""", *FEAT_SQL),
          ids=("M-7",))
def segment_rules(spark, sf_dir):
    r = rules(spark, sf_dir)
    return r.select("key", "cluster_label", fround("cagr", 6).alias("cagr"), "last_year_fob")


@register("watchlist", with_trade("""
SELECT key, cluster_label, round(cagr, 6) AS cagr, last_year_fob FROM lab
WHERE cluster_label IN ('Declining') AND cagr < 0""", *FEAT_SQL), ids=("L-4",))
def watchlist(spark, sf_dir):
    w = G.watchlist(rules(spark, sf_dir), ["Declining"])
    return w.select("key", "cluster_label", fround("cagr", 6).alias("cagr"), "last_year_fob")


@register("label_counts", with_trade("""
SELECT cluster_label, count(*) AS n FROM lab GROUP BY 1""", *FEAT_SQL), ids=("A-24",))
def label_counts(spark, sf_dir):
    from tradelens.operators.marts import value_counts
    return value_counts(rules(spark, sf_dir), "cluster_label")


@register("top8_per_label", with_trade("""
SELECT key, cluster_label, last_year_fob, rank FROM (
  SELECT key, cluster_label, last_year_fob,
         CAST(row_number() OVER (PARTITION BY cluster_label ORDER BY last_year_fob DESC, key) AS INTEGER) AS rank
  FROM lab) WHERE rank <= 8""", *FEAT_SQL), ids=("L-2",))
def top8_per_label(spark, sf_dir):
    t = G.top_per_label(rules(spark, sf_dir), 8)
    return t.select("key", "cluster_label", "last_year_fob", "rank")


@register("label_writeback", with_trade("""
SELECT c.c_custkey AS company_id, c.c_name AS company_name, lab.cluster_label
FROM customer c LEFT JOIN lab ON lab.key = c.c_custkey""", *FEAT_SQL), ids=("S-16", "K-6"))
def label_writeback(spark, sf_dir):
    comp = (read_table(spark, sf_dir, "customer")
            .select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("company_name"),
                    F.lit(None).cast("string").alias("cluster_label")))
    labels = rules(spark, sf_dir).select(F.col("key").alias("company_id"), "cluster_label")
    return W.write_back_labels(comp, labels, "company_id", "cluster_label")


#: Lloyd steps of every fit (fits that settle sooner stay as they are).
STEPS = 15
F4 = ("f0", "f1", "f2", "f3")

SCALED_SQL = """scaled AS (SELECT key, (cagr - avg(cagr) OVER ()) / stddev_pop(cagr) OVER () AS f0,
  (order_frequency - avg(order_frequency) OVER ()) / stddev_pop(order_frequency) OVER () AS f1,
  (ln(1 + avg_order_value) - avg(ln(1 + avg_order_value)) OVER ()) / stddev_pop(ln(1 + avg_order_value)) OVER () AS f2,
  (ln(1 + last_year_fob) - avg(ln(1 + last_year_fob)) OVER ()) / stddev_pop(ln(1 + last_year_fob)) OVER () AS f3 FROM feat)"""


def lloyd_sql(lo: int, hi: int) -> list[str]:
    """CTEs up to ``best``: the numbered centroids of the best restart for every k in lo..hi, and its inertia."""
    dist = " + ".join(f"(p.{f} - c.{f}) * (p.{f} - c.{f})" for f in F4)
    ctes = [SCALED_SQL,
            f"""st AS (SELECT r, rk, f0, f1, f2, f3 FROM (SELECT scaled.*, r, row_number() OVER (
                  PARTITION BY r ORDER BY md5(CAST({PARAMS.seed} + r AS VARCHAR) || ':' || CAST(key AS VARCHAR))) - 1 AS rk
                  FROM scaled, (SELECT unnest(range({KMEANS_RESTARTS})) AS r) rr) WHERE rk < {hi})""",
            f"c0 AS MATERIALIZED (SELECT k, r, rk AS i, f0, f1, f2, f3 FROM st JOIN (SELECT unnest(range({lo}, {hi + 1})) AS k) kk ON rk < k)"]
    for s in range(STEPS + 1):
        ctes.append(f"""a{s} AS MATERIALIZED (SELECT k, r, key, f0, f1, f2, f3, near.i AS i, near.d AS d FROM (
            SELECT c.k, c.r, p.key, any_value(p.f0) AS f0, any_value(p.f1) AS f1, any_value(p.f2) AS f2, any_value(p.f3) AS f3,
                   min(struct_pack(d := {dist}, i := c.i)) AS near
            FROM scaled p, c{s} c GROUP BY c.k, c.r, p.key))""")
        if s < STEPS:
            mean = ", ".join(f"coalesce(m.{f}, c.{f}) AS {f}" for f in F4)
            ctes.append(f"""c{s + 1} AS MATERIALIZED (SELECT c.k, c.r, c.i, {mean} FROM c{s} c LEFT JOIN (
                SELECT k, r, i, {', '.join(f'avg({f}) AS {f}' for f in F4)} FROM a{s} GROUP BY k, r, i) m USING (k, r, i))""")
    ctes.append(f"inertia AS (SELECT k, r, sum(d) AS inertia FROM a{STEPS} GROUP BY k, r)")
    ctes.append("chosen AS (SELECT k, min(struct_pack(v := round(inertia, 6), r := r)).r AS r FROM inertia GROUP BY k)")
    ctes.append(f"""best AS (SELECT c.k, CAST(row_number() OVER (PARTITION BY c.k ORDER BY f3 DESC, f2 DESC, f1 DESC, f0 DESC) - 1 AS INTEGER)
                      AS cluster_id, f0, f1, f2, f3 FROM c{STEPS} c JOIN chosen USING (k, r))""")
    return ctes


CLUSTER_SQL = (
    *lloyd_sql(PARAMS.k, PARAMS.k),
    """assigned AS (SELECT key, near.i AS cluster_id FROM (SELECT p.key, min(struct_pack(
         d := (p.f0 - c.f0) * (p.f0 - c.f0) + (p.f1 - c.f1) * (p.f1 - c.f1) + (p.f2 - c.f2) * (p.f2 - c.f2) + (p.f3 - c.f3) * (p.f3 - c.f3),
         i := c.cluster_id)) AS near FROM scaled p, best c GROUP BY p.key))""",
    """cents AS (SELECT cluster_id, f0 * s.d0 + s.m0 AS cagr, f1 * s.d1 + s.m1 AS order_frequency,
                       exp(f2 * s.d2 + s.m2) - 1 AS avg_order_value, exp(f3 * s.d3 + s.m3) - 1 AS last_year_fob,
                       (SELECT count(*) FROM assigned a WHERE a.cluster_id = best.cluster_id) AS n_keys
                FROM best, (SELECT avg(cagr) AS m0, stddev_pop(cagr) AS d0, avg(order_frequency) AS m1, stddev_pop(order_frequency) AS d1,
                                   avg(ln(1 + avg_order_value)) AS m2, stddev_pop(ln(1 + avg_order_value)) AS d2,
                                   avg(ln(1 + last_year_fob)) AS m3, stddev_pop(ln(1 + last_year_fob)) AS d3 FROM feat) s)""",
    """labelled AS (SELECT *, CASE WHEN grp = 0 AND w = 1 THEN 'Core' WHEN grp = 0 THEN 'Rising Star'
                                   WHEN w = 1 THEN 'Declining' ELSE 'Untapped' END AS cluster_label
                    FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY last_year_fob DESC, cluster_id) AS w
                          FROM (SELECT *, CASE WHEN row_number() OVER (ORDER BY cagr DESC, cluster_id) <= 2 THEN 0 ELSE 1 END AS grp
                                FROM cents)))""",
)


def _kmeans(spark, sf_dir):
    f = features(spark, sf_dir)
    centroids, assigned, cost = G.kmeans_best(G.scale_features(f), PARAMS.k, PARAMS.seed, KMEANS_RESTARTS)
    return f, assigned, G.centroids_frame(centroids, f, assigned), cost


@register("segment_kmeans", with_trade("""
SELECT key, cluster_id, cluster_label FROM assigned JOIN labelled USING (cluster_id)""", *FEAT_SQL, *CLUSTER_SQL), ids=("M-2", "M-5", "L-6"))
def segment_kmeans(spark, sf_dir):
    f, assigned, cents, _ = _kmeans(spark, sf_dir)
    labels = G.label_clusters(cents, PARAMS)
    return assigned.join(F.broadcast(labels), "cluster_id").select("key", "cluster_id",
                                                                    "cluster_label")


@register("segment_centroids", with_trade("""
SELECT cluster_id, round(cagr, 6) AS cagr, round(order_frequency, 6) AS order_frequency, round(avg_order_value, 4) AS avg_order_value,
       CASE WHEN round(last_year_fob, 2) = 0 THEN 0.0 ELSE round(last_year_fob, 2) END AS last_year_fob, n_keys, cluster_label FROM labelled""", *FEAT_SQL, *CLUSTER_SQL), ids=("M-4", "L-6"))
def segment_centroids(spark, sf_dir):
    _, _, cents, _ = _kmeans(spark, sf_dir)
    c = cents.join(G.label_clusters(cents, PARAMS), "cluster_id")
    return c.select("cluster_id", fround("cagr", 6).alias("cagr"), fround("order_frequency", 6).alias("order_frequency"),
                    fround("avg_order_value", 4).alias("avg_order_value"), F.when(fround("last_year_fob", 2) == 0, 0.0).otherwise(fround("last_year_fob", 2)).alias("last_year_fob"),  # no -0.0
                    "n_keys", "cluster_label")


@register("segment_elbow", with_trade("""
SELECT CAST(k AS INTEGER) AS k, round(inertia, 4) AS inertia,
       round((t.total - inertia) / t.total * 100, 4) AS improvement_vs_k1_pct
FROM inertia JOIN chosen USING (k, r), (SELECT inertia AS total FROM inertia JOIN chosen USING (k, r) WHERE k = 1) t""",
    *FEAT_SQL, *lloyd_sql(1, PARAMS.max_k_elbow)), ids=("M-3",))
def segment_elbow(spark, sf_dir):
    e = G.elbow(G.scale_features(features(spark, sf_dir)), PARAMS.max_k_elbow, PARAMS.seed, KMEANS_RESTARTS)
    return e.select("k", fround("inertia", 4).alias("inertia"), fround("improvement_vs_k1_pct", 4).alias("improvement_vs_k1_pct"))


def _cell(i: int, j: int) -> str:
    return f"a{max(i, j)}{min(i, j)}"


CELLS = [(i, j) for i in range(4) for j in range(i + 1)]


def eigen_sql(name: str, source: str, squarings: int = 16) -> list[str]:
    """CTE ``<name>`` (v0..v3, ev) of the leading eigenvector of the symmetric matrix in ``source``
    (cells a00, a10, ... a33), by repeated squaring; its entry of largest size is positive."""
    ctes, at = [], source
    for s in range(squarings):
        cells = ", ".join(f"({' + '.join(f'{_cell(i, m)} * {_cell(m, j)}' for m in range(4))}) / pow(a00 + a11 + a22 + a33, 2) AS a{i}{j}"
                          for i, j in CELLS)
        ctes.append(f"{name}_{s} AS (SELECT {cells} FROM {at})")
        at = f"{name}_{s}"
    column = ", ".join("CASE " + " ".join(f"WHEN a{j}{j} = g THEN {_cell(i, j)}" for j in range(4)) + f" END AS u{i}" for i in range(4))
    ctes.append(f"{name}_u AS (SELECT {column} FROM (SELECT *, greatest(a00, a11, a22, a33) AS g FROM {at}))")
    size = "sqrt(u0 * u0 + u1 * u1 + u2 * u2 + u3 * u3)"
    big = "greatest(abs(u0), abs(u1), abs(u2), abs(u3))"
    sign = "CASE " + " ".join(f"WHEN abs(u{i}) = {big} THEN sign(u{i})" for i in range(4)) + " END"
    ctes.append(f"{name}_v AS (SELECT {', '.join(f'u{i} / {size} * {sign} AS v{i}' for i in range(4))} FROM {name}_u)")
    form = " + ".join(f"{_cell(i, j)} * v{i} * v{j}" for i in range(4) for j in range(4))
    ctes.append(f"{name} AS (SELECT {name}_v.*, {form} AS ev FROM {name}_v, {source})")
    return ctes


@register("segment_pca", with_trade("""
SELECT key, round(f0 * e1.v0 + f1 * e1.v1 + f2 * e1.v2 + f3 * e1.v3, 6) AS pc1,
       round(f0 * e2.v0 + f1 * e2.v1 + f2 * e2.v2 + f3 * e2.v3, 6) AS pc2,
       round(e1.ev / tr, 6) AS explained_variance_pc1, round(e2.ev / tr, 6) AS explained_variance_pc2
FROM scaled, e1, e2, (SELECT a00 + a11 + a22 + a33 AS tr FROM cov) t""", *FEAT_SQL, SCALED_SQL,
    f"cov AS (SELECT {', '.join(f'covar_pop(f{i}, f{j}) AS a{i}{j}' for i, j in CELLS)} FROM scaled)",
    *eigen_sql("e1", "cov"),
    f"rest AS (SELECT {', '.join(f'a{i}{j} - ev * v{i} * v{j} AS a{i}{j}' for i, j in CELLS)} FROM cov, e1)",
    *eigen_sql("e2", "rest")), ids=("M-6",))
def segment_pca(spark, sf_dir):
    out, ev = G.pca_2d(G.scale_features(features(spark, sf_dir)))
    return out.select("key", fround("pc1", 6).alias("pc1"), fround("pc2", 6).alias("pc2"),
                      fround(F.lit(ev[0]), 6).alias("explained_variance_pc1"), fround(F.lit(ev[1]), 6).alias("explained_variance_pc2"))
