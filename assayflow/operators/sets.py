"""Set operations on records and runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_records(frames: list[DataFrame]) -> DataFrame:
    """All rows by column name; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def not_processed(sheets: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return sheets.join(done, keys, "left_anti")


def run_diff(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of either run that the other lacks, with repeats counted, and the ``side`` they are on."""
    columns = first.columns
    second = second.select(*columns)
    counted = first.withColumn("__d", F.lit(1)).unionByName(second.withColumn("__d", F.lit(-1))).groupBy(*columns).agg(F.sum("__d").alias("__d")).where("__d <> 0")
    return counted.select(*columns, F.when(F.col("__d") > 0, "first").otherwise("second").alias("side"), F.abs("__d").alias("n"))


def same_runs(first: DataFrame, second: DataFrame, by: str) -> DataFrame:
    """Per ``by`` whether both runs have the same rows."""
    keys = first.select(by).unionByName(second.select(by)).distinct()
    differ = run_diff(first, second).select(by).distinct().withColumn("differs", F.lit(True))
    return keys.join(differ, by, "left").select(by, F.coalesce(~F.col("differs"), F.lit(True)).alias("same"))


def batch_summary(runs: DataFrame) -> DataFrame:
    """Number of units per outcome."""
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def usage_totals(calls: DataFrame) -> DataFrame:
    """Calls and tokens per kind of call and over all (kind is null)."""
    return calls.rollup("kind").agg(F.count(F.lit(1)).alias("calls"), F.sum("tokens").alias("tokens"))


def require_columns(df: DataFrame, names: set[str]) -> None:
    missing = names - set(df.columns)
    if missing:
        raise ValueError(f"missing columns: {', '.join(sorted(missing))}")
