"""Text, TSV, CSV and JSON readers, all through Spark's own sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import base_name, scorer_clean, strip
from ..operators import papers


def strict_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """A TSV with every cell as text and empty cells as empty strings.

    Without a schema the header names the columns; nothing is inferred.
    """
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("nullValue", "\u0001").option("emptyValue", "")
    df = (reader.schema(schema) if schema else reader.option("inferSchema", False)).csv(path)
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def glob_tsv(spark: SparkSession, pattern: str, schema: T.StructType | None = None) -> DataFrame:
    """All files of a pattern as one table; header lines are not rows."""
    return strict_tsv(spark, pattern, schema)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``path, line_no, line`` of text files, numbered within each file."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))
    return whole


def pmid_list(spark: SparkSession, path: str) -> DataFrame:
    return papers.parse_pmid_lines(lines(spark, path))


def antibiotics(spark: SparkSession, path: str) -> DataFrame:
    """``name`` per non-blank line; a missing file is an error at once."""
    return spark.read.text(path).select(strip(F.col("value")).alias("name")).where("name <> ''")


def discover(spark: SparkSession, folder: str, recursive: bool = False, pattern: str = r"\.(xlsx|xls)$", skip: str = r"^(~\$|\.)") -> tuple[DataFrame, DataFrame]:
    """Paths of matching files and of the others, sorted; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(folder).select("path", base_name(F.col("path")).alias("file_name"))
    hit = F.lower("file_name").rlike(pattern) & ~F.col("file_name").rlike(skip)
    return files.where(hit).orderBy("path"), files.where(~hit).orderBy("path")


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """``pmid, files``: sorted file names in each paper's folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    return files.select(F.element_at(F.split("path", "/"), -2).alias("pmid"), base_name(F.col("path")).alias("f")).groupBy("pmid").agg(F.array_sort(F.collect_list("f")).alias("files"))


def ast_tables(spark: SparkSession, path: str) -> DataFrame:
    """``path, caption, header, row_idx, cells`` of saved tables: a ``#`` caption line, then ragged rows.

    A first line that spans columns, narrower than the two equally wide lines after it, is skipped.
    """
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.split("value", r"\r?\n").alias("all"))
    return table_rows(whole)


def table_rows(whole: DataFrame) -> DataFrame:
    """The same from ``path, all``, where ``all`` is a file's array of lines."""
    caption = F.regexp_replace(F.get(F.filter("all", lambda x: x.startswith("#")), F.lit(0)), r"^#\s*", "")
    body = whole.select("path", F.coalesce(caption, F.lit("")).alias("caption"), F.filter("all", lambda x: (strip(x) != "") & ~x.startswith("#")).alias("rows"))
    width = lambda i: F.size(F.split(F.get("rows", F.lit(i)), "\t"))
    spanning = (F.size("rows") >= 3) & (width(0) < width(1)) & (width(1) == width(2))
    kept = body.withColumn("rows", F.when(spanning, F.slice("rows", 2, F.size("rows"))).otherwise(F.col("rows"))).where(F.size("rows") > 0)
    kept = kept.withColumn("header", F.split(F.col("rows")[0], "\t"))
    return kept.select("path", "caption", "header", F.posexplode(F.slice("rows", 2, F.size("rows"))).alias("row_idx", "line")).select("path", "caption", "header", "row_idx", F.split("line", "\t").alias("cells"))


def classification_row(spark: SparkSession, pattern: str, pmid: str) -> DataFrame:
    """The first row for a paper, by sorted file path."""
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("inferSchema", False)
    df = reader.csv(pattern).withColumn("__path", F.col("_metadata.file_path"))
    return df.where(F.col("pmid") == pmid).orderBy("__path").limit(1).drop("__path")


def isolate_ids(records: DataFrame) -> DataFrame:
    """Distinct non-blank (file, isolate) pairs."""
    return records.select("pmid", F.col("file_name").alias("source_file"), scorer_clean(F.col("isolate_id")).alias("isolate_id")).where("isolate_id <> ''").dropDuplicates()


def starter(spark: SparkSession, folder: str) -> DataFrame:
    """``pmid, title, pmcid, doi, xml`` of papers saved in folders named after their pmid, with metadata.json and fulltext.xml."""
    paper = lambda df: df.withColumn("pmid", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    about = paper(spark.read.option("multiLine", True).schema("title string, pmcid string, doi string").json(f"{folder}/*/metadata.json"))
    text = paper(spark.read.text(f"{folder}/*/fulltext.xml", wholetext=True)).select("pmid", F.col("value").alias("xml"))
    return about.join(text, "pmid", "full").select("pmid", "title", "pmcid", "doi", "xml")


def json_documents(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of measured values with markdown links and JSON arrays in quoted cells."""
    df = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
    link = F.regexp_extract("accession_id", r"\[([^\]]*)\]", 1)
    arrays = {c: F.from_json(F.col(c), "array<string>") for c in df.columns if c.endswith("_ids") or c.endswith("uuids")}
    return df.withColumns({"accession": F.coalesce(F.nullif(link, F.lit("")), F.col("accession_id")), **arrays})
