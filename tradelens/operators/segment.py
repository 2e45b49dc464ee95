"""Market segmentation: per-key features, scaling, rule and k-means labels.

IDs: A-17, M-1..M-7, L-2, L-4, L-6.

Features come from ONE conditional aggregate per key over a (key, month)
pre-aggregate (no joins between per-feature frames, J-5).  Scaling uses a
1-row aggregate broadcast.  K-means runs Lloyd's step of all restarts (and,
for the elbow, of all k) in one scan: a task measures whole blocks of points and
returns its sums per cluster; the best restart (least inertia) wins.  Clusters are labelled from their centroids, a
k-row frame.
"""

from __future__ import annotations

import json
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelens.functions.dates import years_between
from tradelens.functions.numeric import money_sum
from tradelens.functions.stats import attach_scalars, materialize, quantile_scalars, zscore
from tradelens.params import SegmentParams

FEATURES = ("cagr", "order_frequency", "avg_order_value", "last_year_fob")
LOG_FEATURES = ("avg_order_value", "last_year_fob")


def segment_features(df: DataFrame, key: str, date_col: str, value_col: str,
                     params: SegmentParams = SegmentParams(), fill_cagr: bool = True
                     ) -> DataFrame:
    """A-17: CAGR(start->end), distinct active months, mean row value and the
    last-year total, over rows with start_year <= year <= end_year; keys with
    fewer than ``min_active_months`` are dropped.

    CAGR = (end/start)^(1/(end_year-start_year)) - 1, NULL when the start total
    is 0; ``fill_cagr`` turns NULL into 0 as the study does (trap T-6).
    """
    hist = df.filter(years_between(date_col, params.start_year, params.end_year))
    monthly = (hist.groupBy(F.col(key).alias("key"), F.trunc(date_col, "month").alias("ym"))
                   .agg(money_sum(hist, value_col).alias("m_value"), F.count("*").alias("n")))
    y = F.year("ym")
    per = (monthly.groupBy("key")
                  .agg(F.coalesce(F.sum(F.when(y == params.start_year, F.col("m_value"))), F.lit(0))
                        .cast("double").alias("start_total"),
                       F.coalesce(F.sum(F.when(y == params.end_year, F.col("m_value"))), F.lit(0))
                        .cast("double").alias("end_total"),
                       F.coalesce(F.sum(F.when(y == params.last_year, F.col("m_value"))), F.lit(0))
                        .cast("double").alias("last_year_fob"),
                       F.count("*").alias("order_frequency"),
                       (F.sum("m_value").cast("double") / F.sum("n")).alias("avg_order_value")))
    n = float(params.end_year - params.start_year)
    start = F.when(F.col("start_total") != 0, F.col("start_total"))
    cagr = F.pow(F.col("end_total") / start, 1.0 / n) - 1
    if fill_cagr:
        cagr = F.coalesce(cagr, F.lit(0.0))
    return (per.filter(F.col("order_frequency") >= params.min_active_months)
               .select("key", cagr.alias("cagr"), "order_frequency", "avg_order_value",
                       "last_year_fob"))


def scale_features(features: DataFrame, log_cols=LOG_FEATURES, cols=FEATURES) -> DataFrame:
    """M-1: log1p on the skewed money features, then z-score every feature with
    the POPULATION std (as the reference's scaler; Spark ML's uses sample)."""
    x = features.withColumns({c: F.log1p(F.col(c)) for c in log_cols})
    return zscore(x.select("key", *[F.col(c).cast("double") for c in cols]), list(cols),
                  sample=False)


def rule_labels(features: DataFrame, params: SegmentParams = SegmentParams(),
                checkpoint: bool = True) -> DataFrame:
    """M-7: rule twin of k-means -- growth (CAGR >= 0) x size (last-year value
    >= median) -> Core / Rising Star / Declining / Untapped.  The per-key
    features are checkpointed (rows + median branch read them once)."""
    if checkpoint:
        features = materialize(features)
    med = quantile_scalars(features, "last_year_fob", {"__median": 0.5})
    f = attach_scalars(features, med)
    grow = F.col("cagr") >= 0
    big = F.col("last_year_fob") >= F.col("__median")
    hi1, hi2 = params.labels_high
    lo1, lo2 = params.labels_low
    label = (F.when(grow & big, hi1).when(grow, hi2).when(big, lo1).otherwise(lo2))
    return f.withColumn("cluster_label", label).drop("__median")


def watchlist(labelled: DataFrame, labels, value_col: str = "last_year_fob") -> DataFrame:
    """L-4: keys with one of ``labels`` and a negative CAGR, by value desc."""
    return (labelled.filter(F.col("cluster_label").isin(list(labels)) & (F.col("cagr") < 0))
                    .orderBy(F.col(value_col).desc(), F.col("key")))


def top_per_label(labelled: DataFrame, n: int = 8, value_col: str = "last_year_fob"
                  ) -> DataFrame:
    """L-2: top-n keys per label by value (two-phase top-n, see
    ``marts.top_n_per_group``: no label's keys are sorted in one task)."""
    from tradelens.operators.marts import top_n_per_group
    return top_n_per_group(labelled, "cluster_label", value_col, n, "key")


# --- k-means (M-2..M-6, L-6) ---------------------------------------------------------

def start_points(scaled: DataFrame, k: int, restarts: int, seed: int, cols=FEATURES) -> dict[int, list]:
    """Restart -> k keys' vectors, the first in the order of md5("seed+restart:key"); a
    smaller k starts from the first of them.  One job; k * restarts rows reach the driver."""
    per = []
    for r in range(restarts):
        order = F.md5(F.concat(F.lit(f"{seed + r}:"), F.col("key").cast("string")))
        per.append(scaled.select(F.lit(r).alias("r"), order.alias("o"), F.array(*cols).alias("x")).orderBy("o").limit(k))
    rows = reduce(DataFrame.union, per).collect()
    return {r: [x["x"] for x in sorted((y for y in rows if y["r"] == r), key=lambda y: y["o"])] for r in range(restarts)}


def _step(scaled: DataFrame, models: dict, cols) -> dict:
    """(model, cluster) -> (rows, inertia, sums of the columns): every point meets every model
    in one scan; a task returns a row per cluster."""
    names = list(models)
    if not names:
        return {}
    parts = cluster_sums(scaled, [models[m] for m in names], cols)
    rows = parts.groupBy("m", "i").agg(*[F.sum(c).alias(c) for c in parts.columns[2:]]).collect()
    return {(names[r["m"]], r["i"]): (r["n"], r["d"], [r[f"s{j}"] for j in range(len(cols))]) for r in rows}


#: Points that meet the models together (their distances to as many models stay in the cache).
POINT_BLOCK = 2048


def cluster_sums(scaled: DataFrame, models: list, cols=FEATURES) -> DataFrame:
    """m, i, n, d, s0, s1, ...: per task, model and nearest cluster (the first of equals) the points,
    their squared distances and the sums of their columns, added up batch by batch.

    Models with as many clusters are taken together, each distance over a whole block of points.
    As in SQL, NaN is the largest distance; a point with a NULL belongs to cluster 0, and its
    distance and its NULLs are in no sum."""
    dims = len(cols)
    alike = {k: [m for m, c in enumerate(models) if len(c) == k] for k in sorted({len(c) for c in models})}
    centers = {k: np.array([models[m] for m in ms], dtype=float) for k, ms in alike.items()}

    def nearest(x, c):
        best, at = None, np.zeros((c.shape[0], x.shape[1]), dtype=np.int64)
        for i in range(c.shape[1]):
            d = np.zeros(at.shape)
            for j in range(dims):
                apart = x[j] - c[:, i, j, None]
                apart *= apart
                d += apart
            if best is None:
                best = d
                continue
            closer = d < best
            if np.isnan(best).any():
                closer |= np.isnan(best) & ~np.isnan(d)
            np.copyto(best, d, where=closer)
            np.copyto(at, i, where=closer)
        return best, at

    def add(batches):
        sums = {k: np.zeros((2 + dims, len(ms) * k)) for k, ms in alike.items()}
        for batch in batches:
            points = np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns], dtype=float)
            null = np.array([c.is_null().to_numpy(zero_copy_only=False) for c in batch.columns])
            for lo in range(0, batch.num_rows, POINT_BLOCK):
                x, no = points[:, lo:lo + POINT_BLOCK], null[:, lo:lo + POINT_BLOCK]
                held, whole = np.where(no, 0.0, x), ~no.any(axis=0)
                for k, c in centers.items():
                    with np.errstate(invalid="ignore", over="ignore"):
                        best, at = nearest(x, c)
                    to = (at + np.arange(len(c))[:, None] * k).ravel()
                    weights = [np.where(whole, best, 0.0), *[np.broadcast_to(h, at.shape) for h in held]]
                    sums[k] += [np.bincount(to, minlength=len(c) * k),
                                *[np.bincount(to, w.ravel(), len(c) * k) for w in weights]]
        for k, ms in alike.items():
            took = np.flatnonzero(sums[k][0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(ms, dtype=np.int32)[took // k]), pa.array((took % k).astype(np.int32)),
                 pa.array(sums[k][0, took].astype(np.int64)), *[pa.array(v[took]) for v in sums[k][1:]]],
                ["m", "i", "n", "d", *[f"s{j}" for j in range(dims)]])

    schema = "m int, i int, n long, d double, " + ", ".join(f"s{j} double" for j in range(dims))
    return scaled.select(*[F.col(c).cast("double") for c in cols]).mapInArrow(add, schema)


def _distance(x, c):
    return F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)


def lloyd(scaled: DataFrame, models: dict, steps: int, cols=FEATURES) -> tuple[dict, dict]:
    """Lloyd's iterations of all ``models`` (name -> centroids) together: one job a step, until
    nothing moves or ``steps`` are done.  A cluster that loses its points keeps its place.
    Returns the centroids and, per model, the inertia around them."""
    models = {m: [list(map(float, c)) for c in cs] for m, cs in models.items()}
    for _ in range(steps):
        got, moved = _step(scaled, models, cols), 0.0
        for m, centroids in models.items():
            for i, c in enumerate(centroids):
                n, _, sums = got.get((m, i), (0, 0.0, c))
                new = [v / n for v in sums] if n else c
                moved = max(moved, *(abs(a - b) for a, b in zip(c, new)))
                centroids[i] = new
        if moved < 1e-12:
            break
    last = _step(scaled, models, cols)
    return models, {m: sum(last.get((m, i), (0, 0.0, None))[1] for i in range(len(cs))) for m, cs in models.items()}


def best_models(scaled: DataFrame, ks: list[int], seed: int, restarts: int, steps: int = 15, cols=FEATURES) -> dict:
    """M-2, M-3: k -> (inertia, centroids) of the restart of least inertia (to 6 digits; ties ->
    first restart).  All k and restarts share every scan; centroids (at most sum(ks) * restarts
    short vectors) are the only rows that reach the driver.  Clusters are numbered by their last
    feature, the largest first."""
    starts = start_points(scaled, max(ks), restarts, seed, cols)
    models = {(k, r): starts[r][:k] for k in ks for r in range(restarts) if starts[r]}
    centroids, inertia = lloyd(scaled, models, steps, cols)
    best = {}
    for k in ks:
        found = [(round(inertia[k, r], 6), r) for r in range(restarts) if (k, r) in inertia]
        if found:
            _, r = min(found)
            best[k] = inertia[k, r], sorted(centroids[k, r], key=lambda c: [-v for v in reversed(c)])
    return best


def assign(scaled: DataFrame, centroids: list, cols=FEATURES) -> DataFrame:
    """key, cluster_id of the nearest centroid (the first of equals)."""
    cs = F.from_json(F.lit(json.dumps(centroids)), "array<array<double>>")
    x = F.array(*[F.col(c).cast("double") for c in cols])
    near = F.array_min(F.transform(cs, lambda c, i: F.struct(_distance(x, c).alias("d"), i.alias("i"))))
    return scaled.select("key", near["i"].alias("cluster_id"))


def kmeans_best(scaled: DataFrame, k: int, seed: int, restarts: int, cols=FEATURES):
    """M-2: best of ``restarts`` k-means fits.  The scaled vectors are written once
    (``materialize``), so steps re-read them and not the fact.  Returns (centroids,
    assignments, inertia)."""
    scaled = materialize(scaled)
    inertia, centroids = best_models(scaled, [k], seed, restarts, cols=cols)[k]
    return centroids, assign(scaled, centroids, cols), inertia


def elbow(scaled: DataFrame, max_k: int, seed: int, restarts: int, cols=FEATURES) -> DataFrame:
    """M-3: inertia for k = 1..max_k (best of ``restarts``); all fits share their scans."""
    spark = scaled.sparkSession
    best = best_models(materialize(scaled), list(range(1, max_k + 1)), seed, restarts, cols=cols)
    out = spark.createDataFrame([(k, float(v[0])) for k, v in best.items()], "k int, inertia double")
    total = float(best[1][0]) if best else None
    return out.withColumn("improvement_vs_k1_pct", F.try_divide(F.lit(total) - F.col("inertia"), F.lit(total)) * 100)


def centroids_frame(centroids: list, features: DataFrame, assigned: DataFrame, cols=FEATURES, log_cols=LOG_FEATURES) -> DataFrame:
    """M-4: centroids mapped back to original units (inverse z-score with the
    population std, then expm1 for log features) with cluster sizes."""
    spark = features.sparkSession
    centers = [(i, *[float(v) for v in c]) for i, c in enumerate(centroids)]
    cdf = spark.createDataFrame(centers, "cluster_id int, " + ", ".join(f"{c} double" for c in cols))
    x = features.withColumns({c: F.log1p(F.col(c)) for c in log_cols})
    stats = x.agg(*[F.avg(c).alias(f"__mu_{c}") for c in cols],
                  *[F.stddev_pop(c).alias(f"__sd_{c}") for c in cols])
    c2 = attach_scalars(cdf, stats)
    back = {c: F.col(c) * F.col(f"__sd_{c}") + F.col(f"__mu_{c}") for c in cols}
    back.update({c: F.expm1(back[c]) for c in log_cols})
    sizes = assigned.groupBy("cluster_id").agg(F.count("*").alias("n_keys"))
    return (c2.select("cluster_id", *[v.alias(k) for k, v in back.items()])
              .join(sizes, "cluster_id", "left"))


def label_clusters(centroids: DataFrame, params: SegmentParams = SegmentParams()) -> DataFrame:
    """L-6: the two highest-CAGR clusters are 'growth'; within each pair the
    higher last-year value gets the first label.  Input has k rows."""
    order = Window.orderBy(F.col("cagr").desc(), F.col("cluster_id"))
    c = centroids.withColumn("__grp", F.when(F.row_number().over(order) <= 2, 0).otherwise(1))
    within = Window.partitionBy("__grp").orderBy(F.col("last_year_fob").desc(), F.col("cluster_id"))
    c = c.withColumn("__r", F.row_number().over(within))
    hi1, hi2 = params.labels_high
    lo1, lo2 = params.labels_low
    label = (F.when((F.col("__grp") == 0) & (F.col("__r") == 1), hi1)
              .when(F.col("__grp") == 0, hi2)
              .when(F.col("__r") == 1, lo1).otherwise(lo2))
    return c.select("cluster_id", label.alias("cluster_label"))


def pca_2d(scaled: DataFrame, cols=FEATURES):
    """M-6: first two principal components and their shares of the variance.

    The covariance of the columns is one aggregate; its eigenvectors (a matrix of
    ``len(cols)`` squared numbers) are computed on the driver, and their entry of
    largest size is made positive."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1)]
    row = scaled.agg(*[F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    cov = np.zeros((len(cols), len(cols)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"c{i}_{j}"] or 0.0
    values, vectors = np.linalg.eigh(cov)
    top = [vectors[:, -1 - c] * np.sign(vectors[np.argmax(np.abs(vectors[:, -1 - c])), -1 - c]) for c in (0, 1)]
    parts = [reduce(lambda a, b: a + b, [F.col(c) * float(v) for c, v in zip(cols, t)]) for t in top]
    out = scaled.select("key", parts[0].alias("pc1"), parts[1].alias("pc2"))
    return out, [float(values[-1 - c] / values.sum()) if values.sum() else 0.0 for c in (0, 1)]
