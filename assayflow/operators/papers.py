"""Classification and mining of article texts, and the paper report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_pmid, let, strip

# Keyword families.
TOPIC = (
    r"(?i)\bMICs?\b|minimum inhibitory concentration|\bsusceptib\w*|\bresistan\w*|\bintermediate\b|disk diffusion|disc diffusion|zone diameter|"
    r"\bCLSI\b|\bEUCAST\b|breakpoint|Sensititre|broth microdilution|agar dilution|\bE-?test\b|\bVITEK\b|\bPhoenix\b|antibiogram"
)
SUPPLEMENT = r"(?i)(Table\s*S\d+[A-Za-z]?|Supplementary\s+(Table|Data|File|Material)s?\s*\d*|Additional\s+file\s*\d*|Dataset\s*S\d+)"
MAIN_TABLE = r"(?i)\bTable\s*\d+[A-Za-z]?\b(?!\s*S)"
SUPPLEMENT_LABEL = r"(?i)^\s*(Table\s*S|Supplementary|Additional\s+file|Dataset\s*S)"
GENE_TABLE = r"(?i)\bgenes?\b"
STRONG_TOPIC = (
    r"(?i)\bMICs?\b|susceptib\w*|resistan\w*\s*(test|phenotyp)\w*|\bCLSI\b|\bEUCAST\b|breakpoint|disk diffusion|disc diffusion|broth microdilution|"
    r"Sensititre|\bE-?test\b|\bVITEK\b"
)
ACCESSION = r"\b(SAMN\d+|SAMEA\d+|SAMD\d+|PRJNA\d+|PRJEB\d+|PRJDB\d+|SRR\d+|ERR\d+|DRR\d+|BioSample|BioProject)\b"
DEPOSITED = (
    r"\b(SAMN\d+|SAMEA\d+|SAMD\d+|PRJNA\d+|PRJEB\d+|PRJDB\d+|SRR\d+|ERR\d+|DRR\d+|SRX\d+|ERX\d+|DRX\d+|"
    r"GCA_\d+(?:\.\d+)?|GCF_\d+(?:\.\d+)?|(?:NZ_|NC_)[A-Z]{2,4}\d+(?:\.\d+)?)\b"
)
AVAILABILITY_HEADING = r"data\s+availab|availability\s+of\s+data|accession\s+number|data\s+deposition|sequence\s+data\s+availab"
RESTRICTED = "does not allow downloading of the full text"
# What is said of papers without evidence.
RESTRICTED_DETAILS = (
    "Publisher restricts full-text XML via the PMC API (efetch returned only front matter/abstract, no <body>). "
    "View this paper's tables/supplements manually at its PMC article page or PDF."
)
NO_KEYWORDS = "No AST-related keywords found in full text."


def parse_pmid_lines(lines: DataFrame) -> DataFrame:
    """``pmid, ordinal, genome_ids`` from lines ``genome<TAB>..<TAB>pmid``, ``genome<TAB>pmid`` or ``pmid``.

    ``lines`` has line_no and line.  Blank and non-numeric pmids go; genomes are distinct, in order.
    """
    f = F.transform(F.split("line", "\t"), strip)
    n = F.size(f)
    pmid = F.when(n >= 3, F.get(f, F.lit(2))).when(n == 1, F.get(f, F.lit(0))).otherwise(F.element_at(f, -1))
    genome = F.when(n >= 2, F.nullif(F.get(f, F.lit(0)), F.lit("")))
    rows = lines.where(strip(F.col("line")) != "").select("line_no", pmid.alias("pmid"), genome.alias("genome")).where(is_pmid(F.col("pmid")))
    seen = F.array_sort(F.collect_list(F.when(F.col("genome").isNotNull(), F.struct("line_no", "genome"))))
    return rows.groupBy("pmid").agg(F.min("line_no").alias("ordinal"), F.array_distinct(F.transform(seen, lambda x: x["genome"])).alias("genome_ids"))


def keyword_hits(text: Column) -> Column:
    """Topic keywords in lower case, in order, with repeats."""
    return F.transform(F.regexp_extract_all(text, F.lit(TOPIC), F.lit(0)), F.lower)


def keyword_details(hits: Column, top: int = 4) -> Column:
    """The most frequent of ``hits`` with their counts, ties by first appearance; no shuffle."""

    def body(h: Column) -> Column:
        counted = F.transform(F.array_distinct(h), lambda k, i: F.struct((-F.size(F.filter(h, lambda x: x == k))).alias("n"), i.alias("i"), k.alias("k")))
        return F.array_join(F.transform(F.slice(F.array_sort(counted), 1, top), lambda x: F.concat(x["k"], F.lit("×"), (-x["n"]).cast("string"))), ", ")

    return let(hits, body)


def classify(papers: DataFrame, supplement_files: Column | None = None, table_count: Column | None = None) -> DataFrame:
    """Add ``ast_location``, ``biosample_hint`` and ``details`` to papers with ``text``."""
    t = F.coalesce("text", F.lit(""))
    files = F.lit(0) if supplement_files is None else F.coalesce(F.size(supplement_files), F.lit(0))
    tables = F.lit(0) if table_count is None else F.coalesce(table_count, F.lit(0))
    restricted = F.contains(t, F.lit(RESTRICTED)) | ~F.contains(F.lower(t), F.lit("<body"))
    papers = papers.withColumn("__hits", F.when(~restricted, keyword_hits(t)))
    hits = F.col("__hits")
    topical, supplement, main = F.size(hits) > 0, t.rlike(SUPPLEMENT) | (files > 0), t.rlike(MAIN_TABLE) | (tables > 0)
    location = (
        F.when(restricted, "no_fulltext_restricted").when(~topical, "none_found").when(main & supplement, "main_text_and_supplement")
        .when(main, "main_text_table").when(supplement, "supplement").otherwise("main_text_prose")
    )
    hint = F.when(restricted | ~topical, "unclear").when(t.rlike(ACCESSION), "yes").otherwise("no")
    found = F.concat(F.lit("AST keyword hits: "), keyword_details(hits), F.lit(". "), tables.cast("string"), F.lit(" candidate AST table(s) in main text."))
    details = F.when(restricted, RESTRICTED_DETAILS).when(~topical, NO_KEYWORDS).otherwise(found)
    return papers.withColumns({"ast_location": location, "biosample_hint": hint, "details": details}).drop("__hits")


def keep_tables(tables: DataFrame) -> DataFrame:
    """Tables (label, caption, rows) of measured results: no supplement labels, no gene tables without strong evidence."""
    head = F.array_join(F.flatten(F.slice("rows", 1, 6)), " ")
    gene = F.col("caption").rlike(GENE_TABLE) & ~F.col("caption").rlike(STRONG_TOPIC) & ~head.rlike(STRONG_TOPIC)
    return tables.where(~F.col("label").rlike(SUPPLEMENT_LABEL) & ~gene & (F.col("caption").rlike(TOPIC) | head.rlike(TOPIC)))


def deposited(text: Column) -> Column:
    """Sorted distinct accessions of a data-availability statement."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(DEPOSITED), F.lit(1))))


def confirmed(accessions: Column, text: Column) -> Column:
    """``yes`` if one of the accessions occurs in the text, ``no`` if none does, ``unclear`` without accessions."""
    return F.when(F.coalesce(F.size(accessions), F.lit(0)) <= 0, "unclear").when(F.exists(accessions, lambda a: F.contains(text, a)), "yes").otherwise("no")


def with_summaries(papers: DataFrame, summaries: DataFrame) -> DataFrame:
    return papers.join(summaries, "pmid", "left")


def report(papers: DataFrame) -> DataFrame:
    """Flat report: lists joined by ``;``, notes by `` | ``, tabs and line ends as blanks, most genomes first."""
    n = F.coalesce(F.nullif(F.size("genome_ids"), F.lit(0)), F.size("bvbrc_genome_ids"))
    flat = []
    for name, kind in papers.dtypes:
        if name == "ordinal":
            continue
        value = F.array_join(F.col(name), " | " if name == "notes" else ";") if kind.startswith("array") else F.coalesce(F.col(name).cast("string"), F.lit(""))
        flat.append(F.regexp_replace(value, r"[\t\r\n]", " ").alias(name))
    return papers.withColumn("rank", n).orderBy(F.desc("rank"), "ordinal").select(*flat)


def top_keywords(papers: DataFrame, k: int = 4) -> DataFrame:
    """``pmid, keyword, n, place`` of the ``k`` most frequent keywords of each paper."""
    hits = papers.select("pmid", F.posexplode(keyword_hits(F.col("text"))).alias("pos", "keyword"))
    counted = hits.groupBy("pmid", "keyword").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    place = F.row_number().over(Window.partitionBy("pmid").orderBy(F.desc("n"), "first"))
    return counted.withColumn("place", place).where(F.col("place") <= k).select("pmid", "keyword", "n", "place")
