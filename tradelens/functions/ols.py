"""Least squares per group as aggregates and expressions (no Python, no gathered group).

One aggregate gives the means of target and terms per group, a second one the
sums of products of what is left of them (plain sums, combined map-side).  The correlation
matrix, at most ``len(terms)`` wide, is then decomposed by Cholesky in one
expression over arrays, so the work per group does not depend on its rows.
(Do not filter on the coefficients: the optimizer would write out the whole
decomposition in the pushed filter.  Filter on n_obs, or on the rows before.)

Defined cases: rows with a NULL or NaN in the target or any term take no part; a
term that is constant, or a linear combination of the terms before it, gets the
coefficient 0 (``tolerance`` is the share of its variance that must be its own);
a group without complete rows, or with a NULL key, has no result; a constant
target has all coefficients 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 1e-9


def _sum(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts, F.lit(0.0))


def complete(columns: list[str]) -> Column:
    """No column is NULL or NaN."""
    each = [F.col(c).cast("double") for c in columns]
    return reduce(lambda a, b: a & b, [c.isNotNull() & ~F.isnan(c) for c in each])


def fit(df: DataFrame, keys: list[str], target: str, terms: list[str], prefix: str = "b_",
        tolerance: float = TOLERANCE) -> DataFrame:
    """keys, n_obs, rss, one coefficient per term, that of the constant (``<prefix>const``),
    and ``last_scale``: the last term's coefficient has variance s2 * last_scale."""
    k = range(len(terms))
    known = df.where(complete([target, *terms])).select(*keys, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate([*terms, target])])
    columns = {f"_x{i}": name for i, name in enumerate([*(f"_m{i}" for i in k), "_my"])}
    means = known.groupBy(*keys).agg(*[F.avg(x).alias(m) for x, m in columns.items()])
    moved = known.join(means, keys).withColumns({x: F.col(x) - F.col(m) for x, m in columns.items()})
    y = f"_x{len(terms)}"

    def cov(a: str, b: str) -> Column:
        return F.sum(F.col(a) * F.col(b)) / F.count(F.lit(1))

    def var(x: str) -> Column:
        """0 if what is left of the values is their rounding."""
        return F.when(cov(x, x) > 1e-24 * F.col(columns[x]) * F.col(columns[x]), cov(x, x)).otherwise(0.0)

    g = moved.groupBy(*keys, *columns.values()).agg(
        F.count(F.lit(1)).alias("n_obs"), var(y).alias("_vy"), *[var(f"_x{i}").alias(f"_v{i}") for i in k], *[cov(f"_x{i}", y).alias(f"_y{i}") for i in k],
        *[cov(f"_x{i}", f"_x{j}").alias(f"_c{i}_{j}") for i in k for j in range(i)])

    def scaled(value: str, a: str, b: str) -> Column:
        return F.when((F.col(a) > 0) & (F.col(b) > 0), F.col(value) / F.sqrt(F.col(a) * F.col(b))).otherwise(0.0)

    cor = F.array(*[F.array(*[scaled(f"_c{i}_{j}", f"_v{i}", f"_v{j}") for j in range(i)],
                            F.when(F.col(f"_v{i}") > 0, 1.0).otherwise(0.0)) for i in k])
    g = g.withColumns({"_s": cor, "_r": F.array(*[scaled(f"_y{i}", f"_v{i}", "_vy") for i in k])})
    g = g.withColumn("_f", _factor(F.col("_s"), F.col("_r"), len(terms), tolerance))
    g = g.withColumn("_g", _back(F.col("_f"), len(terms)))
    coef = {t: F.when(F.col(f"_v{i}") > 0, F.col("_g")[i] * F.sqrt(F.col("_vy") / F.col(f"_v{i}"))).otherwise(0.0)
            for i, t in enumerate(terms)}
    last = len(terms) - 1
    own = F.when(F.col(f"_v{last}") > 0, F.col("_f.q")[last] * F.col("_f.q")[last] / (F.col("n_obs") * F.col(f"_v{last}")))
    left = 1 - F.aggregate("_f.z", F.lit(0.0), lambda a, z: a + z * z)
    return g.select(
        *keys, "n_obs", F.greatest(F.lit(0.0), F.col("n_obs") * F.col("_vy") * left).alias("rss"),
        (F.col("_my") - _sum([coef[t] * F.col(f"_m{i}") for i, t in enumerate(terms)])).alias(f"{prefix}const"),
        *[c.alias(f"{prefix}{t}") for t, c in coef.items()], own.alias("last_scale"))


def _none() -> Column:
    return F.array().cast("array<double>")


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _factor(cor: Column, right: Column, n: int, tolerance: float) -> Column:
    """The rows below the diagonal of the Cholesky factor (l), its inverted diagonal (q, 0 for a
    dropped term), and the solution of the lower system (z)."""
    rows = F.array(*[F.lit(i) for i in range(n)])
    empty = F.struct(F.array().cast("array<array<double>>").alias("l"), _none().alias("q"), _none().alias("z"))

    def step(a, i):
        row = F.aggregate(F.slice(rows, F.lit(1), i), _none(), lambda r, j: F.concat(
            r, F.array((cor[i][j] - _dot(r, a["l"][j])) * a["q"][j])))

        def diagonal(r):
            own = cor[i][i] - _dot(r, r)
            return F.struct(r.alias("r"), F.when(own > tolerance, 1 / F.sqrt(own)).otherwise(0.0).alias("q"))

        return _bound(_bound(row, diagonal), lambda x: F.struct(
            F.concat(a["l"], F.array(x["r"])).alias("l"), F.concat(a["q"], F.array(x["q"])).alias("q"),
            F.concat(a["z"], F.array((right[i] - _dot(x["r"], a["z"])) * x["q"])).alias("z")))

    return F.aggregate(rows, empty, step)


def _back(f: Column, n: int) -> Column:
    """The standardised coefficients, from the last term to the first."""
    rows = F.array(*[F.lit(i) for i in reversed(range(n))])

    def step(g, j):  # g holds the coefficients after j
        column = F.transform(F.slice(f["l"], j + 2, F.lit(n)), lambda r: r[j])
        return F.concat(F.array((f["z"][j] - _dot(column, g)) * f["q"][j]), g)

    return F.aggregate(rows, _none(), step)


def fitted(terms: list[str], prefix: str = "b_", of: Column | None = None) -> Column:
    """The fitted value of a row that carries its group's coefficients; the terms are its columns, or the fields of ``of``."""
    return _sum([F.col(f"{prefix}{t}") * (F.col(t) if of is None else of[t]) for t in terms]) + F.col(f"{prefix}const")
