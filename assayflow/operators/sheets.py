"""Rule-based classification of sheets and columns, in place of a language model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.accession import PUBLIC
from ..functions.drugs import drug_of_header
from ..functions.text import parse_mic, strip


def column_profiles(cells: DataFrame, names: DataFrame) -> DataFrame:
    """Shares of measured values, calls and accessions among each column's non-blank cells."""
    v = strip(F.col("value"))
    body = cells.join(names, ["sheet", "col_idx"]).where(v != "")
    share = lambda x: F.avg(F.coalesce(x, F.lit(False)).cast("double"))
    return body.groupBy("sheet", "col_idx", "col_name").agg(
        share(parse_mic(F.col("value"))["value"].isNotNull()).alias("mic_share"), share(F.upper(v).isin("S", "I", "R", "SDD", "NS")).alias("sir_share"), share(v.rlike(PUBLIC)).alias("accession_share")
    )


def column_roles(profiles: DataFrame) -> DataFrame:
    """A role for each column, with its drug and, for a call column right of a measured one, the pairing."""
    name, drug = F.lower("col_name"), drug_of_header(F.col("col_name"))
    role = (
        F.when(drug.isNotNull() & (F.col("mic_share") >= 0.5), "drug_mic").when(drug.isNotNull() & (F.col("sir_share") >= 0.5), "drug_sir")
        .when(F.col("accession_share") >= 0.5, "public_accession").when(name.rlike("isolate|strain|sample|specimen|cvm|sequenc"), "local_id")
        .when(name.rlike("organism|species|genus"), "organism").when(name.startswith("unnamed") & (F.col("sir_share") >= 0.3), "drug_sir").otherwise("metadata")
    )
    w = Window.partitionBy("sheet").orderBy("col_idx")
    roles = profiles.withColumns({"drug_name": drug, "role": role})
    # Without any id, the first column that is no drug's is the id.
    whole = Window.partitionBy("sheet")
    is_id, open_ = F.col("role").isin("local_id", "public_accession"), F.col("role").isin("metadata", "organism") & F.col("drug_name").isNull()
    first = F.min(F.when(open_, F.col("col_idx"))).over(whole)
    fallback = ~F.max(is_id).over(whole) & open_ & (F.col("col_idx") == first)
    roles = roles.withColumn("fallback", fallback).withColumn("role", F.when(F.col("fallback"), "local_id").otherwise(F.col("role"))).drop("fallback")
    adjacent = (F.lead("role").over(w) == "drug_sir") & F.lower(F.lead("col_name").over(w)).startswith("unnamed") & (F.col("role") == "drug_mic")
    return roles.withColumn("paired_with", F.when(adjacent, F.lead("col_name").over(w)))


def classify(roles: DataFrame) -> DataFrame:
    """``sheet, contains_ast_data, has_mic_values, has_sir_calls, status``."""
    has = lambda r: F.bool_or(F.col("role") == r)
    flags = roles.groupBy("sheet").agg(has("drug_mic").alias("has_mic_values"), has("drug_sir").alias("has_sir_calls"))
    status = F.when(F.col("has_mic_values") & F.col("has_sir_calls"), "MIC + SIR").when(F.col("has_mic_values"), "MIC VALUES").when(F.col("has_sir_calls"), "SIR-ONLY").otherwise("SKIPPED")
    return flags.select("sheet", (F.col("has_mic_values") | F.col("has_sir_calls")).alias("contains_ast_data"), "has_mic_values", "has_sir_calls", status.alias("status"))


def target_sheets(classes: DataFrame, workbook: str = "workbook") -> DataFrame:
    """Sheets with measured values; in workbooks without any, those with calls."""
    any_mic = F.max("has_mic_values").over(Window.partitionBy(workbook))
    return classes.withColumn("any_mic", any_mic).where(F.when(F.col("any_mic"), F.col("has_mic_values")).otherwise(F.col("has_sir_calls"))).drop("any_mic")
