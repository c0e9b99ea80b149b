"""Integrity reports: Parquet enforces no rule, so violations are rows.

Every report has the columns rule, table, key, detail.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.schemas import (
    REFERENCE_RULES,
    ROW_RULES,
    UNIQUE_RULES,
    ReferenceRule,
    RowRule,
    UniqueRule,
)


def row_violations(df: DataFrame, rules: list[RowRule], key: str = "id") -> DataFrame:
    """Rows breaking any rule: one scan, one output row per broken rule."""
    broken = [
        F.when(~F.coalesce(F.expr(rule.condition), F.lit(True)), F.lit(f"{rule.table}.{rule.name}"))
        for rule in rules
    ]
    return df.select(
        F.explode(F.filter(F.array(*broken), lambda name: name.isNotNull())).alias("rule"),
        F.lit(rules[0].table).alias("table"),
        F.col(key).cast("string").alias("key"),
        F.lit("check").alias("detail"),
    )


def duplicate_keys(df: DataFrame, rule: UniqueRule) -> DataFrame:
    """Keys held by more than one row; counts are summed per task before the shuffle."""
    columns = list(rule.columns)
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") > 1))
        .select(
            F.lit(f"{rule.table}.unique({','.join(columns)})").alias("rule"),
            F.lit(rule.table).alias("table"),
            F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("key"),
            F.concat(F.lit("rows="), F.col("_n")).alias("detail"),
        )
    )


def orphans(df: DataFrame, target: DataFrame, rule: ReferenceRule, key: str = "id") -> DataFrame:
    """Rows whose reference finds no target row; null references are fine.

    The distinct references meet the target, not the rows: of a target that a third
    of the rows points to, each task ships one value. The rows come back only for
    the references that failed.
    """
    references = df.where(F.col(rule.column).isNotNull()).select(F.col(rule.column).alias("_ref")).distinct()
    targets = target.select(F.col(rule.target_column).alias("_ref"))
    missing = references.join(targets, "_ref", "left_anti")
    return df.join(missing, F.col(rule.column) == F.col("_ref"), "left_semi").select(
        F.lit(f"{rule.table}.{rule.column}->{rule.target}").alias("rule"),
        F.lit(rule.table).alias("table"),
        F.col(key).cast("string").alias("key"),
        F.col(rule.column).cast("string").alias("detail"),
    )


def integrity_report(
    tables: dict[str, DataFrame],
    row_rules: list[RowRule] = ROW_RULES,
    unique_rules: list[UniqueRule] = UNIQUE_RULES,
    reference_rules: list[ReferenceRule] = REFERENCE_RULES,
) -> DataFrame:
    """All violations of all rules whose tables are given."""
    parts = []
    for name, df in tables.items():
        rules = [rule for rule in row_rules if rule.table == name]
        if rules:
            parts.append(row_violations(df, rules))
    parts += [duplicate_keys(tables[rule.table], rule) for rule in unique_rules if rule.table in tables]
    parts += [
        orphans(tables[rule.table], tables[rule.target], rule)
        for rule in reference_rules
        if rule.table in tables and rule.target in tables
    ]
    return reduce(DataFrame.unionByName, parts)
