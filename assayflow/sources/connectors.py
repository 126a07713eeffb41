"""Projections of repository answers (JSON) to columns; fetching them is not part of this library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import publication_year

_SUMMARY = "title string, sortfirstauthor string, pubdate string, articleids array<struct<idtype: string, value: string>>"
_GENOME = "genome_id string, biosample_accession string, assembly_accession string, genbank_accessions string, refseq_accessions string, sra_accession string, bioproject_accession string"


def article_summaries(answers: DataFrame) -> DataFrame:
    """``pmid, title, first_author, year, pmcid, doi`` from answers with column ``json``: ``{"result": {pmid: {..}}}``."""
    entries = answers.select(F.from_json("json", "result map<string,string>").alias("j")).select(F.explode("j.result").alias("pmid", "entry"))
    parsed = entries.where("pmid rlike '^[0-9]+$'").select("pmid", F.from_json("entry", _SUMMARY).alias("s"))
    one = lambda kind: F.get(F.transform(F.filter("s.articleids", lambda a: a["idtype"] == kind), lambda a: a["value"]), F.lit(0))
    pmc = one("pmc")
    return parsed.select(
        "pmid", F.regexp_replace("s.title", r"\.+$", "").alias("title"), F.col("s.sortfirstauthor").alias("first_author"), publication_year(F.col("s.pubdate")).alias("year"),
        F.when(pmc.startswith("PMC"), pmc).otherwise(F.concat(F.lit("PMC"), pmc)).alias("pmcid"), one("doi").alias("doi"),
    )


def genomes_of_papers(answers: DataFrame) -> DataFrame:
    """Distinct accessions per paper from genome answers with ``pmid`` and ``json``: a list, or a list under response.docs or docs."""
    raw = F.coalesce(F.get_json_object("json", "$.response.docs"), F.get_json_object("json", "$.docs"), F.col("json"))
    rows = answers.select("pmid", F.explode_outer(F.from_json(raw, f"array<struct<{_GENOME.replace(' string', ':string')}>>")).alias("g"))
    listed = lambda c: F.array_sort(F.array_distinct(F.filter(F.flatten(F.collect_list(F.split(F.coalesce(F.col(f"g.{c}"), F.lit("")), r"[,;]\s*"))), lambda x: x != ""))).alias(c)
    return rows.groupBy("pmid").agg(*[listed(c.split()[0]) for c in _GENOME.split(", ")])
