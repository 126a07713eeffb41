"""Writers of record tables and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import safe_file_name


def write_tsv(df: DataFrame, path: str, single: bool = False) -> bool:
    """A TSV with a header and empty cells for nulls; nothing at all for no rows.  Tells whether it was written.

    Written in parts, each with the header and at least one row; ``single`` is for reports, whose rows go through one task.
    """
    if df.isEmpty():
        return False
    text = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])
    out = (text.coalesce(1) if single else text).write.mode("overwrite").option("sep", "\t").option("header", True)
    out.option("quote", "").option("emptyValue", "").option("nullValue", "").csv(path)
    _drop_part_without_rows(df.sparkSession, path)
    return True


def _drop_part_without_rows(spark: SparkSession, path: str) -> None:
    """Delete the first part if there is nothing but a header in it: Spark writes that of its first partition even without rows, of no other."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    parts = [status.getPath() for status in fs.listStatus(folder) if status.getPath().getName().startswith("part-")]
    for part in parts if len(parts) > 1 else []:
        if part.getName().startswith("part-00000-") and part.getName().endswith(".csv"):
            lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(part), "UTF-8"))
            lines.readLine()
            bare = lines.readLine() is None
            lines.close()
            if bare:
                fs.delete(part, False)


def write_records(df: DataFrame, path: str) -> bool:
    return write_tsv(df.select(*schemas.RECORD_FINAL.fieldNames()), path)


def write_version(df: DataFrame, path: str, version: str) -> str:
    """A new Parquet version beside the old ones, which are its backup; nothing is changed in place."""
    target = f"{path}/version={version}"
    df.write.mode("errorifexists").parquet(target)
    return target


def write_specs(attempts: DataFrame, path: str) -> None:
    """The transforms of all attempts as JSON lines; ``attempts`` has sheet, pass_no, attempt, spec, n_valid and errors."""
    attempts.write.mode("overwrite").json(path)


def mic_data(records: DataFrame) -> DataFrame:
    """The eleven columns of extracted data, without nulls, from ten-column records with ``file_name`` and ``sheet_name``."""
    names = ("file_name", "sheet_name", "pubmed_id", "isolate_name", "accession", "accession_type", "organism", "drug_raw", "mic_operator", "mic_value", "sir_call")
    return records.select(*[F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) for n in names])


def run_log(passes: DataFrame, retained: DataFrame, conflicts: DataFrame, usage: DataFrame | None = None, seconds: float | None = None) -> DataFrame:
    """One row: records, keys retained, keys dropped and the most frequent reasons, calls, tokens and duration.

    ``usage`` has one row per call, with input_tokens and output_tokens.
    """
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    reasons = conflicts.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason").limit(10)
    top = reasons.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "reason"))).alias("r")).select(F.transform("r", lambda x: x["reason"]).alias("reasons"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    calls = passes.sparkSession.createDataFrame([], "input_tokens bigint, output_tokens bigint") if usage is None else usage
    spent = calls.agg(F.count(F.lit(1)).alias("calls"), total("input_tokens"), total("output_tokens"))
    # Five one-row frames.
    joined = count(passes, "records").join(count(retained, "retained")).join(count(conflicts, "dropped")).join(top).join(spent)
    return joined.withColumn("seconds", F.lit(seconds).cast("double"))


def sheet_summary(classes: DataFrame) -> DataFrame:
    """Sheets with reasoning on one line."""
    return classes.withColumn("reasoning", F.regexp_replace(F.coalesce("reasoning", F.lit("")), r"[\t\r\n]+", " "))


def sheet_summary_text(classes: DataFrame, by: str) -> DataFrame:
    """Per workbook, one line whether measured values were found."""
    found = F.when(F.bool_or("has_mic_values"), "MIC data FOUND").otherwise("MIC data NOT FOUND")
    return classes.groupBy(by).agg(found.alias("summary"), F.count(F.lit(1)).alias("n_sheets"))


def strategy_log(roles: DataFrame) -> DataFrame:
    """Per sheet and role the columns, in order."""
    ordered = F.array_sort(F.collect_list(F.struct("col_idx", "col_name")))
    return roles.groupBy("sheet", "role").agg(F.array_join(F.transform(ordered, lambda x: x["col_name"]), ", ").alias("columns"))


def table_text(label: Column, caption: Column, rows: Column) -> Column:
    """A saved table: its caption as a comment line, then tab-separated rows."""
    lines = F.transform(rows, lambda r: F.array_join(r, "\t"))
    return F.concat(F.lit("# "), label, F.lit(": "), caption, F.lit("\n"), F.array_join(lines, "\n"), F.lit("\n"))


def table_file_name(label: Column) -> Column:
    return F.concat(safe_file_name(label), F.lit(".tsv"))


def write_tables(tables: DataFrame, path: str) -> None:
    """Each table as text under its paper and file name."""
    tables.select("pmid", table_file_name(F.col("label")).alias("file"), table_text(F.col("label"), F.col("caption"), F.col("rows")).alias("value")).write.mode("overwrite").partitionBy("pmid", "file").text(path)


def write_download_report(papers: DataFrame, failures: DataFrame, path: str) -> None:
    """Both parts of the report as JSON lines, in parts, for any number of papers."""
    papers.write.mode("overwrite").json(f"{path}/summary")
    failures.write.mode("overwrite").json(f"{path}/failures")


def download_report(papers: DataFrame, failures: DataFrame) -> DataFrame:
    """One JSON document ``{"summary": [...], "failures": [...]}``, for lists of papers that a person reads; one row holds it all."""
    gathered = lambda df, name: df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name))
    return gathered(papers, "summary").join(gathered(failures, "failures")).select(F.to_json(F.struct("summary", "failures")).alias("report"))
