"""End-to-end workflows over files, each one lazy plan with actions only at its sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.accession import accession_type
from ..functions.drugs import drug_of_header
from ..functions.text import base_name, pmid_in_path
from ..operators import cells as cell_ops
from ..operators import enrich, ensemble, evaluate, match, metadata, papers, qc, sheets, unpivot
from ..operators.sets import union_records
from ..providers import extract_sheet, provider, wide_sheet
from ..sources import jats, readers, sinks, xlsx
from .materialise import materialised


def workbook_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of all workbooks below a folder; a sheet is known as ``file|sheet``."""
    cells = xlsx.cells_of(xlsx.workbooks(spark, folder))
    return cells.withColumns({"pmid": pmid_in_path(F.col("file_name")), "sheet": F.concat_ws("|", "file_name", "sheet")})


def classify_workbooks(cells: DataFrame, provider_name: str = "rules") -> tuple[DataFrame, DataFrame]:
    """Roles of all columns, and classes of all sheets with ``workbook``."""
    roles = provider(provider_name).roles(cells)
    classes = sheets.classify(roles).withColumn("workbook", F.substring_index("sheet", "|", 1))
    return roles, classes


def extract(cells: DataFrame, provider_name: str = "rules") -> DataFrame:
    """Records of the measured sheets: stacked sheets are left out, headers found, columns given roles, cells unpivoted.

    Cells and roles are materialised, as every step reads them.
    """
    cells = materialised(cells)
    flat = materialised(cells.join(cell_ops.stacked_sheets(cells).where("stacked"), "sheet", "left_anti"))
    roles = materialised(provider(provider_name).roles(flat))
    targets = sheets.target_sheets(sheets.classify(roles).withColumn("workbook", F.substring_index("sheet", "|", 1))).select("sheet")
    chosen = flat.join(targets, "sheet", "left_semi")
    headers = cell_ops.header_rows(chosen)
    body = chosen.join(headers, "sheet").where(F.col("row_idx") > F.col("header_row"))
    named = materialised(body.join(roles.select("sheet", "col_idx", F.col("col_name").alias("column_name")), ["sheet", "col_idx"]))
    long = unpivot.paired_records(named, roles.withColumnRenamed("col_name", "column_name"))
    accessions = (
        named.join(roles.where("role = 'public_accession'").select("sheet", "col_idx"), ["sheet", "col_idx"], "left_semi")
        .groupBy("sheet", "row_idx").agg(unpivot.mined_accessions(F.array_sort(F.collect_list("value"))).alias("accession"))
    )
    info = cells.select("sheet", "pmid").distinct()
    return long.join(accessions, ["sheet", "row_idx"], "left").join(info, "sheet").select(
        "pmid", F.substring_index("sheet", "|", 1).alias("file_name"), F.substring_index("sheet", "|", -1).alias("sheet_name"), "row_idx", F.col("isolate_name").alias("isolate_id"), "accession",
        F.coalesce(drug_of_header(F.col("drug_raw")), F.col("drug_raw")).alias("drug"), F.col("mic_operator").alias("mic_sign"), F.col("mic_value").alias("mic"), "sir_call", F.lit(None).cast("string").alias("notes"),
    )


def with_metadata(records: DataFrame, cells: DataFrame, provider_name: str = "rules") -> tuple[DataFrame, DataFrame]:
    """Records enriched from the sheets without measurements, and the log of the sheets looked at."""
    records, cells = materialised(records), materialised(cells)
    roles = materialised(provider(provider_name).roles(cells))
    done = sheets.target_sheets(sheets.classify(roles).withColumn("workbook", F.substring_index("sheet", "|", 1))).select("sheet")
    below = cells.join(cell_ops.header_rows(cells), "sheet").where(F.col("row_idx") > F.col("header_row"))
    body = materialised(below.withColumn("row_idx", F.col("row_idx") - F.col("header_row") - 1).drop("header_row"))
    maps, log = metadata.discover(body, roles.withColumnRenamed("col_name", "column_name"), records, done)
    maps = materialised(maps.select("isolate_id", "accession", "secondary_accession"))
    return enrich.apply_metadata(records, [maps], between=materialised), log


def extract_with_attempts(cells: DataFrame, provider_name: str = "rules", passes: int = 1) -> tuple[list[DataFrame], DataFrame]:
    """Per pass the valid records of all measured sheets by proposed transforms, and a table of the attempts.

    One sheet after the other, as each is a question to the provider; the rows of a sheet stay with the executors.
    """
    how, cells = provider(provider_name), materialised(cells)
    roles = materialised(how.roles(cells))
    classes = sheets.classify(roles).withColumn("workbook", F.substring_index("sheet", "|", 1))
    wanted = {r["sheet"] for r in sheets.target_sheets(classes).select("sheet").collect()}
    heads = {r["sheet"]: r["header_row"] for r in cell_ops.header_rows(cells).collect() if r["sheet"] in wanted}
    columns: dict[str, list[dict]] = {}
    for r in roles.orderBy("sheet", "col_idx").collect():
        columns.setdefault(r["sheet"], []).append({"col_idx": r["col_idx"], "column_name": r["col_name"], "role": r["role"], "drug_name": r["drug_name"]})
    out, log = [], []
    for n in range(passes):
        found = []
        for name in sorted(wanted):
            records, attempts = extract_sheet(name, wide_sheet(cells.where(F.col("sheet") == name), columns[name], heads[name]), columns[name], how, pass_no=n)
            log += attempts
            if records is not None:
                found.append(records.withColumn("sheet", F.lit(name)))
        if found:
            out.append(union_records(found))
    rows = [(a.sheet, a.pass_no, a.attempt, a.spec, a.n_valid, list(a.errors)) for a in log]
    return out, cells.sparkSession.createDataFrame(rows, "sheet string, pass_no int, attempt int, spec string, n_valid bigint, errors array<string>")


def records_v1(records: DataFrame, organisms: DataFrame | None = None) -> DataFrame:
    """The ten-column form of extracted records; ``organisms`` has file_name, sheet_name, row_idx and organism."""
    named = records.withColumn("organism", F.lit(None).cast("string")) if organisms is None else records.join(organisms, ["file_name", "sheet_name", "row_idx"], "left")
    return named.select(
        F.col("pmid").alias("pubmed_id"), F.col("sheet_name").alias("source_sheet"), F.col("isolate_id").alias("isolate_name"), "accession", accession_type(F.col("accession")).alias("accession_type"),
        "organism", F.col("drug").alias("drug_raw"), F.col("mic_sign").alias("mic_operator"), F.col("mic").alias("mic_value"), "sir_call",
    ).select(*schemas.RECORD_V1.fieldNames())


def organisms(cells: DataFrame, roles: DataFrame) -> DataFrame:
    """``file_name, sheet_name, row_idx, organism`` from the first organism column of each sheet."""
    first = roles.where("role = 'organism'").groupBy("sheet").agg(F.min("col_idx").alias("col_idx"))
    found = cells.join(first, ["sheet", "col_idx"]).select("sheet", "row_idx", F.nullif(F.trim("value"), F.lit("")).alias("organism"))
    return found.select(F.substring_index("sheet", "|", 1).alias("file_name"), F.substring_index("sheet", "|", -1).alias("sheet_name"), "row_idx", "organism")


def publish(passes: list[DataFrame], metas: list[DataFrame], order: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Quality control, consensus, enrichment and final layout: final records, quarantined ones, conflicts."""
    judged = [qc.split(p) for p in passes]
    quarantined = judged[0][1]
    for _, bad in judged[1:]:
        quarantined = quarantined.unionByName(bad, allowMissingColumns=True)
    kept, conflicts = ensemble.ensemble([good for good, _ in judged], order)
    if conflicts is None:
        conflicts = quarantined.select(F.lit("").alias("k_id"), F.lit("").alias("k_drug"), F.lit("").alias("reason"), F.lit(0).cast("bigint").alias("n_records")).limit(0)
    final = enrich.finalize(enrich.apply_metadata(kept, metas), F.col("file_name"), F.col("sheet_name"), F.col("pmid"))
    return final, quarantined, conflicts


def evaluate_files(spark: SparkSession, extracted: str, truth: str, out: str) -> DataFrame:
    """Compare TSV files, write comparison, errors and metrics below ``out``; returns the long metrics.

    Rows are numbered within each file, as a spreadsheet shows them.
    """
    rows = readers.lines(spark, extracted).where("line <> ''")
    names = F.split(F.first(F.when(F.col("line_no") == 0, F.col("line")), ignorenulls=True), "\t").alias("names")
    header = rows.groupBy("path").agg(names)
    cellsets = rows.where("line_no > 0").join(header, "path").select((F.col("line_no") + 1).alias("extracted_row"), F.map_from_arrays("names", F.slice(F.concat(F.split("line", "\t"), F.array_repeat(F.lit(""), 40)), F.lit(1), F.size("names"))).alias("m"))
    columns = ["pmid", "isolate_id", "drug", "mic_sign", "mic", "sir_call", *evaluate.EXTRACTED_ACCESSIONS]
    records = cellsets.select("extracted_row", *[F.coalesce(F.try_element_at("m", F.lit(c)), F.lit("")).alias(c) for c in columns])
    compared = evaluate.compare(records, readers.strict_tsv(spark, truth))
    compared.write.mode("overwrite").parquet(f"{out}/compared")
    stored = spark.read.parquet(f"{out}/compared")
    long = evaluate.metrics_long(evaluate.metrics(stored))
    sinks.write_tsv(stored, f"{out}/comparison")
    sinks.write_tsv(qc.incorrect_rows(stored), f"{out}/errors")
    sinks.write_tsv(long, f"{out}/metrics", single=True)
    return long


def match_files(spark: SparkSession, records: str, strains: str, out: str, fill: bool = False) -> DataFrame:
    """Match report of record TSVs against a strain TSV; on request a version of the records with blanks filled."""
    rows = readers.strict_tsv(spark, records, schemas.RECORD_FINAL)
    known = readers.strict_tsv(spark, strains).withColumn("ordinal", F.col("ordinal").cast("bigint"))
    report = match.match_all(readers.isolate_ids(rows), known).select(*schemas.MATCH.fieldNames())
    sinks.write_tsv(report, f"{out}/matches")
    if fill:
        # Rows of one file and normalised id match the same strain, so their order only has to be a fixed one.
        filled = match.fill_blanks(rows, report.withColumn("ordinal", F.col("isolate_id")))
        if match.n_filled(rows, filled):
            sinks.write_version(filled, f"{out}/records", "filled")
    return report


def find_evidence(spark: SparkSession, pmids: str, articles: str) -> DataFrame:
    """Papers of a list, classified by their article XML (files named after the pmid)."""
    listed = readers.pmid_list(spark, pmids)
    text = spark.read.text(articles, wholetext=True).select(pmid_in_path(base_name(F.col("_metadata.file_path"))).alias("pmid"), F.col("value").alias("text"))
    found = listed.join(text, "pmid", "left")
    with_xml = found.select("pmid", F.col("text").alias("xml")).where("xml is not null")
    refs = jats.supplement_refs(with_xml).groupBy("pmid").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "href"))), lambda r: r["href"]).alias("supplement_files"))
    tables = papers.keep_tables(jats.tables(with_xml)).groupBy("pmid").agg(F.count(F.lit(1)).cast("int").alias("n_tables"))
    stated = jats.data_availability(with_xml).select("pmid", F.col("accessions").alias("data_availability_accessions"))
    joined = found.join(refs, "pmid", "left").join(tables, "pmid", "left").join(stated, "pmid", "left")
    judged = papers.classify(joined, F.col("supplement_files"), F.col("n_tables"))
    location = F.when(F.col("text").isNull(), "no_fulltext").otherwise(F.col("ast_location"))
    confirmed = papers.confirmed(F.col("data_availability_accessions"), F.col("text"))
    return judged.withColumns({"ast_location": location, "accession_confirmed": confirmed, "bvbrc_genome_ids": F.array().cast("array<string>")}).drop("text")
