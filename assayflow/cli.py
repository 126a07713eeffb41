"""Command line: ``python -m assayflow.cli COMMAND ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import papers
from .plans import workflows
from .plans.materialise import materialised
from .sources import sinks, xlsx


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="assayflow", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    e = sub.add_parser("evaluate", help="score extracted TSV files against a truth TSV")
    e.add_argument("extracted"), e.add_argument("truth"), e.add_argument("out")
    m = sub.add_parser("match", help="link isolates to repository strains")
    m.add_argument("records"), m.add_argument("strains"), m.add_argument("out"), m.add_argument("--fill", action="store_true")
    x = sub.add_parser("extract", help="records of all workbooks below a folder")
    x.add_argument("folder"), x.add_argument("out"), x.add_argument("--provider", default="rules")
    s = sub.add_parser("scan", help="classes and column roles of all sheets below a folder")
    s.add_argument("folder"), s.add_argument("out"), s.add_argument("--provider", default="rules")
    f = sub.add_parser("find", help="classify the papers of a list by their article XML")
    f.add_argument("pmids"), f.add_argument("articles"), f.add_argument("out")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("assayflow").getOrCreate()
    if a.command == "evaluate":
        for r in workflows.evaluate_files(spark, a.extracted, a.truth, a.out).collect():
            print(f"{r.Section}\t{r.Metric}\t{r.Value}")
    elif a.command == "match":
        workflows.match_files(spark, a.records, a.strains, a.out, a.fill)
    elif a.command == "extract":
        cells = materialised(workflows.workbook_cells(spark, a.folder))
        records, log = workflows.with_metadata(workflows.extract(cells, a.provider), cells, a.provider)
        final, quarantined, _ = workflows.publish([records], [], ["row_idx"])
        sinks.write_records(final, f"{a.out}/records")
        sinks.write_tsv(log, f"{a.out}/metadata_sheets", single=True)
        sinks.write_tsv(xlsx.failures(xlsx.workbooks(spark, a.folder)), f"{a.out}/unreadable", single=True)
        quarantined.write.mode("overwrite").parquet(f"{a.out}/quarantined")
    elif a.command == "scan":
        roles, classes = workflows.classify_workbooks(workflows.workbook_cells(spark, a.folder), a.provider)
        sinks.write_tsv(sinks.sheet_summary(classes.withColumnRenamed("status", "reasoning")), f"{a.out}/sheets", single=True)
        sinks.write_tsv(sinks.strategy_log(roles), f"{a.out}/roles", single=True)
    else:
        sinks.write_tsv(papers.report(workflows.find_evidence(spark, a.pmids, a.articles)), f"{a.out}/papers", single=True)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
