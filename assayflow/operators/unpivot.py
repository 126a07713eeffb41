"""Wide sheets to long records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.accession import PUBLIC
from ..functions.text import NON_MIC, parse_mic, strip
from .qc import drop_header_rows

_CALL_WORDS = ("s", "r", "i", "susceptible", "resistant", "intermediate")


def sir_columns(roles: DataFrame) -> DataFrame:
    """``sheet, column_name, sir_column``: the paired call column of each measured column.

    A column's own pairing comes first, if that column exists; else a call column that names it.
    """
    mic, sir = roles.where("role = 'drug_mic'"), roles.where("role = 'drug_sir'")
    forward = mic.select("sheet", "column_name", "paired_with").join(roles.select("sheet", F.col("column_name").alias("paired_with")), ["sheet", "paired_with"])
    backward = sir.where("paired_with is not null").groupBy("sheet", F.col("paired_with").alias("column_name")).agg(F.min("column_name").alias("back"))
    joined = mic.select("sheet", "column_name").join(forward, ["sheet", "column_name"], "left").join(backward, ["sheet", "column_name"], "left")
    return joined.select("sheet", "column_name", F.coalesce("paired_with", "back").alias("sir_column"))


def primary_ids(roles: DataFrame) -> DataFrame:
    """``sheet, id_column, accession_column``: a local id named after a sequence, isolate or strain, else the first local id, else an accession; and the first accession."""
    local, public = F.col("role") == "local_id", F.col("role") == "public_accession"
    rank = F.when(local & F.lower("column_name").rlike("seq|isolate|strain"), 0).when(local, 1).when(public, 2)
    ranked = roles.withColumn("rank", rank).where("rank is not null")
    first = F.min_by(F.when(F.col("rank") == 2, F.col("column_name")), F.when(F.col("rank") == 2, F.col("col_idx")))
    return ranked.groupBy("sheet").agg(F.min_by("column_name", F.struct("rank", "col_idx")).alias("id_column"), first.alias("accession_column"))


def paired_records(cells: DataFrame, roles: DataFrame, id_name: str = "Isolate ID") -> DataFrame:
    """Long records of measured columns and their paired call columns.

    ``cells`` has sheet, row_idx, column_name and value, and may lack blank cells; ``roles`` sheet, col_idx, column_name, role, paired_with.
    A record is named by its row's id cell, else its accession cell, else ``isolate_N``.  The map of roles has one row per column of a sheet, so the joins on it are small ones.
    """
    data = cells.select("sheet", "row_idx", "column_name", "value")
    mic = data.join(sir_columns(roles), ["sheet", "column_name"])
    calls = data.select("sheet", "row_idx", F.col("column_name").alias("sir_column"), F.col("value").alias("paired_value"))
    named = data.join(primary_ids(roles), "sheet").where((F.col("column_name") == F.col("id_column")) | (F.col("column_name") == F.col("accession_column")))
    given = lambda c: F.max(F.when(F.col("column_name") == F.col(c), F.nullif(strip(F.col("value")), F.lit(""))))
    ids = named.groupBy("sheet", "row_idx").agg(F.coalesce(given("id_column"), given("accession_column")).alias("id_value"))
    joined = mic.join(calls, ["sheet", "row_idx", "sir_column"], "left").join(ids, ["sheet", "row_idx"], "left")
    joined = drop_header_rows(joined, "id_value", id_name)
    name = F.coalesce("id_value", F.concat(F.lit("isolate_"), (F.col("row_idx") + 1).cast("string")))
    out = joined.select("sheet", "row_idx", name.alias("isolate_name"), F.col("column_name").alias("drug_raw"), parse_mic(F.col("value")).alias("m"), paired_call(F.col("paired_value"), F.col("value")).alias("sir_call"))
    kept = out.where("m.value is not null or sir_call is not null")
    return kept.select("sheet", "row_idx", "isolate_name", "drug_raw", F.col("m.operator").alias("mic_operator"), F.col("m.value").alias("mic_value"), "sir_call")


def paired_call(paired: Column, own: Column) -> Column:
    """Call of a cell: the paired cell if it is S, R or I or no null-like word, else a call word in the measured cell itself."""
    p, o = strip(paired), strip(own)
    return F.coalesce(
        F.when((p != "") & (p.isin("S", "R", "I") | ~F.lower(p).isin(*NON_MIC)), p), F.when(o.isin("S", "R", "I", "Susceptible", "Resistant", "Intermediate"), o)
    )


def wide_to_long(df: DataFrame, ids: list[str], drugs: list[str]) -> DataFrame:
    return df.unpivot(ids, [f"`{d}`" for d in drugs], "drug", "raw").where("raw is not null and trim(raw) <> ''")


def parse_cell(raw: Column, upper_bound: bool = True) -> Column:
    """Struct ``mic_sign, mic, sir_call, notes`` of a table cell.

    A call may stand alone, in parentheses or at the end.  A range counts as its upper bound, or, with
    ``upper_bound`` off, as no value.  A sign that isn't written is ``=``, with a note.
    """
    text = F.replace(F.replace(F.translate(strip(raw), "–—−", "---"), F.lit("≤"), F.lit("<=")), F.lit("≥"), F.lit(">="))
    call = F.upper(F.regexp_extract(text, r"(?i)(?:^|[\s(\[]|(?<=\d))(S|I|R|NS|SDD)[)\]]?$", 1))
    rest = strip(F.regexp_replace(text, r"(?i)(?:^|[\s(\[]+|(?<=\d))(S|I|R|NS|SDD)[)\]]?$", ""))
    low_high = r"^(<=|>=|<|>|=)?\s*(\d+(?:\.\d+)?)\s*-\s*(\d+(?:\.\d+)?)$"
    high = F.regexp_extract(rest, low_high, 3)
    parsed = parse_mic(rest)
    value = F.when(high != "", F.when(F.lit(upper_bound), high)).otherwise(parsed["value"])
    written = F.nullif(F.regexp_extract(rest, r"^(<=|>=|<|>|=)", 1), F.lit(""))
    sign = F.when(value.isNotNull(), F.coalesce(F.when(high == "", written), F.lit("=")))
    note = F.when(value.isNotNull() & (high != ""), "upper bound of range").when(value.isNotNull() & written.isNull(), "mic_sign '=' inferred")
    return F.struct(sign.alias("mic_sign"), value.alias("mic"), F.nullif(call, F.lit("")).alias("sir_call"), note.alias("notes"))


def mined_accessions(values: Column) -> Column:
    """Distinct accessions in an array of cells, sorted and joined; null for none."""
    found = F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(values, lambda v: v.isNotNull()), lambda v: F.regexp_extract_all(v, F.lit(PUBLIC), F.lit(1))))))
    return F.when(F.size(found) > 0, F.array_join(found, ","))
