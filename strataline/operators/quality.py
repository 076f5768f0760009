"""Data-quality checks. Each check is one row; a rule set is one DataFrame of such rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline.functions.casts import lenient_double
from strataline.operators.dedupe import duplicated_keys
from strataline.operators.joins import orphan_keys
from strataline.operators.topk import count_and_first
from strataline.plans.concurrent import run_all
from strataline.session import control_table, stage
from strataline.settings import AtLeast, NotNull, QualityRules, References, Unique

RESULT_DDL = "check_type string, table string, passed boolean, violation_count bigint, details string"

# How many offending keys a result names.
ORPHAN_SAMPLE = 10
ROW_SAMPLE = 5
SAMPLE_TYPE = "array<string>"


class QualityError(RuntimeError):
    """A snapshot failed its checks."""


def _result(check_type: str, table: str, violations: Column, passed: Column, details: Column) -> list[Column]:
    return [
        F.lit(check_type).alias("check_type"),
        F.lit(table).alias("table"),
        passed.alias("passed"),
        violations.cast("bigint").alias("violation_count"),
        details.alias("details"),
    ]


def _unpivot(one_row: DataFrame, results: Sequence[list[Column]]) -> DataFrame:
    return one_row.select(F.inline(F.array(*[F.struct(*r) for r in results])))


def _with_sample(counted: DataFrame, sample: DataFrame) -> DataFrame:
    """Put a sample (one row, column ``sample``) beside a count (one row, column ``n``)."""
    both = counted.select("n", F.lit(None).cast(SAMPLE_TYPE).alias("sample")).unionByName(
        sample.select(F.lit(None).cast("bigint").alias("n"), "sample")
    )
    return both.agg(F.max("n").alias("n"), F.max("sample").alias("sample"))


def _top(df: DataFrame, columns: Sequence[str], limit: int) -> DataFrame:
    """The first ``limit`` rows by ``columns`` as one array of texts (top-k, then one small group)."""
    head = df.select(*columns).orderBy(*columns).limit(limit)
    rows = F.sort_array(F.collect_list(F.struct(*columns)))
    single = columns[0] if len(columns) == 1 else None
    texts = F.transform(rows, lambda r: r[single].cast("string") if single else F.to_json(r))
    return head.agg(texts.alias("sample"))


def null_checks(df: DataFrame, rule: NotNull) -> DataFrame:
    """Null count over required columns, one pass. An absent column counts every row."""
    counts = [F.count_if(F.col(c).isNull()) if c in df.columns else F.count(F.lit(1)) for c in rule.columns]
    one = df.agg(*[n.alias(f"n{i}") for i, n in enumerate(counts)])
    total = reduce(lambda a, b: a + b, [F.col(f"n{i}") for i in range(len(counts))])
    # to_json leaves out nulls, so only offending columns are named.
    offending = [F.when(F.col(f"n{i}") > 0, F.col(f"n{i}")).alias(c) for i, c in enumerate(rule.columns)]
    details = F.to_json(F.struct(F.struct(*offending).alias("columns")))
    return one.select(*_result("null_check", rule.table, total, total == 0, details))


def range_checks(df: DataFrame, rules: Sequence[AtLeast], sample_by: Sequence[str]) -> DataFrame:
    """Values below a minimum, all rules of a table in one pass. Nulls and non-numbers do not violate.

    An absent column violates with every row and fails even on an empty table. Samples name the keys
    of the first violating rows.
    """
    return column_checks(df, [], rules, sample_by)


def column_checks(
    df: DataFrame, not_null: Sequence[NotNull], ranges: Sequence[AtLeast], sample_by: Sequence[str]
) -> DataFrame:
    """All null and range rules of a table from one scan, with the first rows that break a range.

    The rules are a filter of the scan, so files and row groups without violations are skipped by their statistics.
    """
    required = [(r, c) for r in not_null for c in r.columns]
    absent = F.lit(True)
    broken = [F.col(c).isNull() if c in df.columns else absent for _, c in required]
    broken += [_below(df, r) if r.column in df.columns else absent for r in ranges]
    found = count_and_first(df, broken, sample_by, ROW_SAMPLE)
    # One row per rule: their counts side by side, and the samples of ranges.
    n = [F.max(F.when(F.col("rule") == i, F.col("n"))).alias(f"n{i}") for i in range(len(broken))]
    sample = [F.max(F.when(F.col("rule") == i, _texts("first", sample_by))).alias(f"s{i}") for i in range(len(required), len(broken))]
    one = found.agg(*n, *sample)
    results = []
    for r in not_null:
        mine = [(c, F.col(f"n{i}")) for i, (rule, c) in enumerate(required) if rule is r]
        total = reduce(lambda a, b: a + b, [count for _, count in mine])
        # to_json leaves out nulls, so only offending columns are named.
        offending = [F.when(count > 0, count).alias(c) for c, count in mine]
        details = F.to_json(F.struct(F.struct(*offending).alias("columns")))
        results.append(_result("null_check", r.table, total, total == 0, details))
    for i, r in enumerate(ranges, len(required)):
        count = F.col(f"n{i}")
        if r.column in df.columns:
            details = F.to_json(
                F.struct(
                    F.lit(r.column).alias("column"), F.lit(float(r.min)).alias("min"),
                    F.lit(",".join(sample_by)).alias("sample_of"), F.col(f"s{i}").alias("sample"),
                )
            )
            results.append(_result("valid_range", r.table, count, count == 0, details))
        else:
            details = F.to_json(
                F.struct(F.lit(r.column).alias("column"), F.lit(r.min).alias("min"), F.lit(True).alias("missing_column"))
            )
            results.append(_result("valid_range", r.table, count, F.lit(False), details))
    return _unpivot(one, results)


def _texts(first: str, columns: Sequence[str]) -> Column:
    """Key structs as texts: the value of a single column, else JSON by name."""
    if len(columns) == 1:
        return F.transform(first, lambda r: r["k0"].cast("string"))
    return F.transform(first, lambda r: F.to_json(F.struct(*[r[f"k{i}"].alias(c) for i, c in enumerate(columns)])))


def _below(df: DataFrame, rule: AtLeast) -> Column:
    numeric = df.schema[rule.column].dataType.simpleString() in ("bigint", "int", "smallint", "double", "float")
    # A comparison on the bare column can be pushed to the scan; text needs the cast.
    value = F.col(rule.column) if numeric else lenient_double(rule.column)
    return value < rule.min


def reference_check(child: DataFrame, parent: DataFrame, rule: References) -> DataFrame:
    """Distinct child keys without a parent, with the first of them.

    The keys are found in a job of their own, over as many tasks as their size asks for, and written once to be counted
    and ordered; among the other checks of a report they would share a few tasks.
    """
    orphans = stage(orphan_keys(child, rule.child_column, parent, rule.parent_column), "orphans")
    both = _with_sample(orphans.agg(F.count(F.lit(1)).alias("n")), _top(orphans, ["key"], ORPHAN_SAMPLE))
    details = F.to_json(
        F.struct(
            F.lit(rule.child_column).alias("child_column"),
            F.lit(rule.parent_table).alias("parent_table"),
            F.lit(rule.parent_column).alias("parent_column"),
            F.col("sample").alias("orphan_keys_sample"),
        )
    )
    return both.select(*_result("referential_integrity", rule.child_table, F.col("n"), F.col("n") == 0, details))


def duplicate_check(df: DataFrame, rule: Unique) -> DataFrame:
    """Rows that share a key with another row (all of them), with the first duplicated keys, found as orphans are."""
    dup = stage(duplicated_keys(df, list(rule.columns)), "duplicates")
    counted = dup.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    both = _with_sample(counted, _top(dup, list(rule.columns), ROW_SAMPLE))
    details = F.to_json(
        F.struct(F.lit(",".join(rule.columns)).alias("columns"), F.col("sample").alias("duplicate_keys_sample"))
    )
    return both.select(*_result("duplicate_check", rule.table, F.col("n"), F.col("n") == 0, details))


def drift_check(metrics: DataFrame, layer: str = "bronze") -> DataFrame:
    """Tables whose source had undeclared columns, from load metrics (``table``, ``extra_columns``)."""
    drifted = metrics.filter(F.size("extra_columns") > 0)
    one = drifted.agg(
        F.count(F.lit(1)).alias("n"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("table", "extra_columns")))).alias("extra"),
    )
    details = F.to_json(F.struct(F.col("extra").alias("tables_with_extra_columns")))
    return one.select(*_result("schema_drift", layer, F.col("n"), F.col("n") == 0, details))


def run_checks(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    rules: QualityRules,
    metrics: DataFrame | None = None,
    keys: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """All results of a rule set. The drift check needs load metrics and is skipped without them."""
    keys = keys or {}
    parts = []
    for name in dict.fromkeys(r.table for r in (*rules.not_null, *rules.ranges)):
        nulls, ranges = ([r for r in of if r.table == name] for of in (rules.not_null, rules.ranges))
        sample_by = list(keys.get(name) or tables[name].columns[:1])
        parts += [column_checks(tables[name], nulls, ranges, sample_by)] if ranges else [null_checks(tables[name], r) for r in nulls]
    jobs = [lambda r=r: reference_check(tables[r.child_table], tables[r.parent_table], r) for r in rules.references]
    parts += run_all(jobs + [lambda r=r: duplicate_check(tables[r.table], r) for r in rules.unique])
    if rules.schema_drift and metrics is not None:
        parts.append(drift_check(metrics))
    if not parts:
        return control_table(spark, [], RESULT_DDL)
    return reduce(DataFrame.unionByName, parts)


def roll_up(results: DataFrame) -> DataFrame:
    """One row over all results; no checks at all pass."""
    return results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.coalesce(F.sum("violation_count"), F.lit(0)).alias("total_violations"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"),
    )
