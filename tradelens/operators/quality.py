"""Declarative data-quality suite compiled to ONE aggregate (Q-1..Q-10, S-18).

A suite is a list of :class:`Expectation` objects -- adding a check is one
line.  ``run_suite`` compiles every check into aggregate expressions of a
single ``df.agg(...)`` (one scan of the data, partial aggregation on every
partition), then turns the one-row result into one row per expectation with
``inline(array(struct...))`` -- still lazy, no driver round trip.

Contract (same as the reference): a missing column gives a failed result
with an error text; percentages are 100 * n / max(1, rows) rounded to 4 dp;
every check runs (no fail-fast); ``gate`` raises after the whole suite ran.
NULL is always unexpected for length, regex and set checks (trap T-23).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelens.functions.text import full_match

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)

RESULT_COLUMNS = ("idx", "expectation_type", "column", "kwargs", "success", "observed_value",
                  "unexpected_count", "unexpected_percent", "error")


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str | None = None
    kwargs: dict[str, Any] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return "expect_" + self.kind


def columns_exist(columns) -> Expectation:
    return Expectation("columns_to_exist", None, {"columns": list(columns)})


def row_count_at_least(min_rows: int) -> Expectation:
    return Expectation("table_row_count_to_be_above", None, {"min_rows": min_rows})


def not_null(column: str) -> Expectation:
    return Expectation("column_values_to_not_be_null", column)


def between(column: str, min_value=None, max_value=None, strict_min=False,
            strict_max=False) -> Expectation:
    return Expectation("column_values_to_be_between", column,
                       {"min_value": min_value, "max_value": max_value,
                        "strict_min": strict_min, "strict_max": strict_max})


def length_equals(column: str, value: int) -> Expectation:
    return Expectation("column_value_lengths_to_equal", column, {"value": value})


def in_set(column: str, value_set) -> Expectation:
    return Expectation("column_values_to_be_in_set", column, {"value_set": list(value_set)})


def matches_regex(column: str, pattern: str) -> Expectation:
    return Expectation("column_values_to_match_regex", column, {"pattern": pattern})


def unexpected_condition(df: DataFrame, e: Expectation) -> Column | None:
    """Row-level 'unexpected' predicate of a column expectation (never NULL)."""
    c = F.col(e.column)
    if e.kind == "column_values_to_not_be_null":
        dtype = df.schema[e.column].dataType
        isnan = F.isnan(c) if isinstance(dtype, (T.FloatType, T.DoubleType)) else F.lit(False)
        return c.isNull() | isnan
    if e.kind == "column_values_to_be_between":
        s = c.try_cast("double")
        ok = F.lit(True)
        k = e.kwargs
        if k.get("min_value") is not None:
            ok = ok & ((s > k["min_value"]) if k.get("strict_min") else (s >= k["min_value"]))
        if k.get("max_value") is not None:
            ok = ok & ((s < k["max_value"]) if k.get("strict_max") else (s <= k["max_value"]))
        return ~F.coalesce(ok, F.lit(False))
    if e.kind == "column_value_lengths_to_equal":
        return ~F.coalesce(F.length(c.cast("string")) == e.kwargs["value"], F.lit(False))
    if e.kind == "column_values_to_be_in_set":
        return ~F.coalesce(c.isin(list(e.kwargs["value_set"])), F.lit(False))
    if e.kind == "column_values_to_match_regex":
        return ~F.coalesce(full_match(c.cast("string"), e.kwargs["pattern"]), F.lit(False))
    return None


def _observed(df: DataFrame, e: Expectation, n_bad: Column) -> Column:
    c = F.col(e.column) if e.column else None
    if e.kind == "column_values_to_not_be_null":
        return n_bad.cast("string")
    if e.kind == "column_values_to_be_between":
        s = c.try_cast("double")
        return F.to_json(F.struct(F.min(s).alias("min"), F.max(s).alias("max")))
    if e.kind == "column_value_lengths_to_equal":
        # the set of distinct lengths is bounded by the longest value
        return F.to_json(F.struct(F.sort_array(F.collect_set(F.length(c.cast("string"))))
                                  .alias("unique_lengths")))
    return F.lit(None).cast("string")


def _sql_str(v: str | None) -> str:
    """A Spark SQL string literal (backslashes and quotes escaped)."""
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def run_suite(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """Run every expectation in ONE aggregate; one result row per expectation.

    The per-check conditions are Column expressions inside the single
    aggregate; the result rows are one SQL ``inline(array(named_struct...))``
    over that 1-row aggregate (assembled as text, which keeps plan building
    cheap for long suites)."""
    cols = set(df.columns)
    aggs: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    specs = []   # (idx, expectation, kwargs json, success, observed, n, error) as SQL
    for i, e in enumerate(suite):
        kwargs = json.dumps(e.kwargs, sort_keys=True, default=str)
        if e.kind == "columns_to_exist":
            missing = [c for c in e.kwargs["columns"] if c not in cols]
            specs.append((i, e, kwargs, "false" if missing else "true",
                          _sql_str(json.dumps({"missing": missing})),
                          "CAST(0 AS BIGINT)", None))
            continue
        if e.kind == "table_row_count_to_be_above":
            specs.append((i, e, kwargs, f"__rows >= {int(e.kwargs['min_rows'])}",
                          "CAST(__rows AS STRING)", "CAST(0 AS BIGINT)", None))
            continue
        if e.column not in cols:
            specs.append((i, e, kwargs, "false", "CAST(NULL AS STRING)", "CAST(0 AS BIGINT)",
                          f"column missing: {e.column}"))
            continue
        bad = unexpected_condition(df, e)
        n_bad = F.count_if(bad)
        aggs += [n_bad.alias(f"__n{i}"), _observed(df, e, n_bad).alias(f"__o{i}")]
        specs.append((i, e, kwargs, f"__n{i} = 0", f"CAST(__o{i} AS STRING)",
                      f"CAST(__n{i} AS BIGINT)", None))
    one = df.agg(*aggs)
    structs = []
    for i, e, kwargs, success, observed, n, err in specs:
        # same arithmetic as functions.numeric.fround(100 * n / max(rows, 1), 4)
        pct = f"round(100D * {n} / greatest(__rows, 1) * 10000D, 0) / 10000D"
        structs.append(
            f"named_struct('idx', {i}, 'expectation_type', {_sql_str(e.name)}, "
            f"'column', {_sql_str(e.column)}, 'kwargs', {_sql_str(kwargs)}, "
            f"'success', {success}, 'observed_value', {observed}, "
            f"'unexpected_count', {n}, 'unexpected_percent', {pct}, "
            f"'error', {_sql_str(err)})")
    return one.selectExpr(f"inline(array({', '.join(structs)}))")


def unexpected_examples(df: DataFrame, e: Expectation, n: int = 5) -> DataFrame:
    """L-5: the n smallest distinct offending values of one expectation.

    distinct + TakeOrderedAndProject: each task keeps n values, so memory is
    bounded regardless of how many rows fail.
    """
    bad = unexpected_condition(df, e)
    return (df.filter(bad).select(F.col(e.column).cast("string").alias("value"))
              .distinct().orderBy(F.col("value").asc_nulls_first()).limit(n))


def summary(results: DataFrame) -> DataFrame:
    """S-18: header counts of a results frame (one row)."""
    return results.agg(F.count("*").alias("n_expectations"),
                       F.count_if("success").alias("success_count"),
                       F.count_if(~F.col("success")).alias("failure_count"),
                       (F.count_if(~F.col("success")) == 0).alias("overall_success"))


def failures(results: DataFrame) -> DataFrame:
    """S-18: failures-only view of a results frame."""
    return results.filter(~F.col("success"))


def write_report(results: DataFrame, path: str) -> DataFrame:
    """S-18 sink: one JSON record per check under ``checks`` and the header counts under
    ``header``; returns the checks as written, so the suite is not run again."""
    results.coalesce(1).write.json(f"{path}/checks")
    written = results.sparkSession.read.schema(results.schema).json(f"{path}/checks")
    summary(written).coalesce(1).write.json(f"{path}/header")
    return written


def gate(results: DataFrame) -> dict:
    """Q-9: raise if any expectation failed (after the whole suite ran)."""
    s = summary(results).first().asDict()
    if not s["overall_success"]:
        bad = [r["expectation_type"] + ":" + str(r["column"])
               for r in failures(results).select("expectation_type", "column").collect()]
        raise ValueError(f"quality gate failed: {s['failure_count']} expectations: {bad}")
    return s


# --- Q-10: constraint checks from the DDL --------------------------------------------

def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """PK / UNIQUE: keys occurring more than once, with their count.

    SQL NULL-distinct semantics: a key with a NULL part never conflicts.
    """
    keys = list(keys)
    nn = F.lit(True)
    for k in keys:
        nn = nn & F.col(k).isNotNull()
    return (df.filter(nn).groupBy(*keys).agg(F.count("*").alias("n"))
              .filter(F.col("n") > 1))


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str
                ) -> DataFrame:
    """FK: non-NULL child keys missing from the parent (left anti join)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return (child.filter(F.col(child_key).isNotNull())
                 .join(p, F.col(child_key) == F.col("__pk"), "left_anti"))


def constraint_summary(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """CHECK / NOT NULL: violation count of each named predicate, one aggregate."""
    return df.agg(*[F.count_if(~F.coalesce(cond, F.lit(False))).alias(name)
                    for name, cond in checks.items()])
