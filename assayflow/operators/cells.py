"""Operators on sheets in long form: one row per cell with sheet, row_idx, col_idx, value, is_string."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.drugs import ANTIBIOTICS, names_drug
from ..functions.text import strip


def header_rows(cells: DataFrame, head: int = 15) -> DataFrame:
    """``sheet, header_row``: the first of the top rows with enough text cells, else row 0.

    Enough is two, or 40 % of the fullest row's count if that's more.
    """
    scored = cells.where(F.col("row_idx") < head).groupBy("sheet", "row_idx").agg(F.count_if(F.col("is_string") & (strip(F.col("value")) != "")).alias("score"))
    most = F.max("score").over(Window.partitionBy("sheet"))
    judged = scored.withColumn("most", most).withColumn("threshold", F.greatest(F.lit(2), F.floor(F.col("most") * 0.4)))
    first = F.min(F.when((F.col("most") > 1) & (F.col("score") >= F.col("threshold")), F.col("row_idx")))
    return judged.groupBy("sheet").agg(F.coalesce(first, F.lit(0)).alias("header_row"))


def flat_headers(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """``sheet, col_idx, col_name`` with the labels of spanning rows above the header in front.

    A row above counts if it has more than one label; its labels are carried over merged cells.
    """
    top = cells.join(headers, "sheet").where(F.col("row_idx") <= F.col("header_row"))
    label = F.when(F.col("is_string"), F.nullif(strip(F.col("value")), F.lit("")))
    w = Window.partitionBy("sheet", "row_idx")
    marked = top.withColumn("label", label).withColumn("n", F.count("label").over(w))
    parents = marked.where((F.col("row_idx") == F.col("header_row")) | (F.col("n") > 1))
    carried = F.when(F.col("row_idx") < F.col("header_row"), F.last("label", ignorenulls=True).over(w.orderBy("col_idx").rowsBetween(Window.unboundedPreceding, 0))).otherwise(F.col("label"))
    named = parents.withColumn("part", carried).withColumn("part", F.when(~F.col("part").rlike(r"^Unnamed:") & (F.lower("part") != "nan"), F.col("part")))
    parts = F.array_sort(F.collect_list(F.when(F.col("part").isNotNull(), F.struct("row_idx", "part"))))
    joined = F.array_join(F.transform(parts, lambda x: x["part"]), "_")
    return named.groupBy("sheet", "col_idx").agg(F.coalesce(F.nullif(joined, F.lit("")), F.lit("Unnamed")).alias("col_name"))


def stacked_sheets(cells: DataFrame, drugs: tuple[str, ...] = ANTIBIOTICS, min_drugs: int = 2, min_gap: int = 5, near: int = 3) -> DataFrame:
    """``sheet, stacked``: whether header rows occur in groups with ``min_gap`` rows or more between two of them."""
    hits = cells.where("is_string").groupBy("sheet", "row_idx").agg(F.count_if(names_drug(F.col("value"), drugs)).alias("n")).where(F.col("n") >= min_drugs)
    gap = F.col("row_idx") - F.lag("row_idx").over(Window.partitionBy("sheet").orderBy("row_idx"))
    # Rows up to ``near`` apart form a group; between groups the rows in between count.
    far = hits.withColumn("gap", gap).groupBy("sheet").agg(F.bool_or((F.col("gap") > near) & (F.col("gap") - 1 >= min_gap)).alias("far"))
    return cells.select("sheet").distinct().join(far, "sheet", "left").select("sheet", F.coalesce("far", F.lit(False)).alias("stacked"))


def fill_down(cells: DataFrame, columns: list[int]) -> DataFrame:
    """Cells of ``columns`` with blanks replaced by the last value above, as merged id cells need."""
    value = F.nullif(strip(F.col("value")), F.lit(""))
    w = Window.partitionBy("sheet", "col_idx").orderBy("row_idx").rowsBetween(Window.unboundedPreceding, 0)
    return cells.where(F.col("col_idx").isin(columns)).withColumn("value", F.last(value, ignorenulls=True).over(w))


def preview(cells: DataFrame, rows: int = 6) -> DataFrame:
    """``sheet, row_idx, line``: the first rows of each sheet as CSV."""
    ordered = F.array_sort(F.collect_list(F.struct("col_idx", F.coalesce("value", F.lit("")).alias("value"))))
    quoted = lambda v: F.when(v.rlike('[,"\\n]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v)
    shown = cells.where(F.col("row_idx") < rows).groupBy("sheet", "row_idx").agg(ordered.alias("c"))
    return shown.select("sheet", "row_idx", F.array_join(F.transform("c", lambda x: quoted(x["value"])), ",").alias("line"))
