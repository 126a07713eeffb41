"""Pluggable answers to structured questions about sheets; the default is rule-based.

A provider gives roles of columns, and proposes the transform of a wide sheet.  A proposal is applied, its records go through
quality control, and what is wrong with them goes into the next attempt; the last attempt's valid records are kept.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .operators import cells as cell_ops
from .operators import qc, sheets, unpivot


class Provider(Protocol):
    def roles(self, cells: DataFrame) -> DataFrame:
        """A role for each column of each sheet."""

    def propose(self, columns: list[dict], errors: list[str], attempt: int, pass_no: int) -> TransformSpec:
        """A transform of a sheet from its columns' names, roles and drugs, in view of what was wrong with the attempt before."""


def unique_names(names: DataFrame) -> DataFrame:
    """Column names that are unique in a sheet: blank ones by place, repeated ones with a number."""
    again = F.row_number().over(Window.partitionBy("sheet", "col_name").orderBy("col_idx")) - 1
    named = F.when(F.col("col_name") == "Unnamed", F.concat(F.lit("Unnamed: "), F.col("col_idx").cast("string")))
    return names.withColumn("again", again).select(
        "sheet", "col_idx", named.when(F.col("again") > 0, F.concat_ws(".", "col_name", F.col("again").cast("string"))).otherwise(F.col("col_name")).alias("col_name")
    )


class RuleProvider:
    """Header detection, column profiles and role rules, all as DataFrame expressions."""

    def roles(self, cells: DataFrame) -> DataFrame:
        headers = cell_ops.header_rows(cells)
        names = unique_names(cell_ops.flat_headers(cells, headers))
        body = cells.join(headers, "sheet").where(F.col("row_idx") > F.col("header_row")).drop("header_row")
        return sheets.column_roles(sheets.column_profiles(body, names))

    def propose(self, columns: list[dict], errors: list[str], attempt: int, pass_no: int) -> TransformSpec:
        """Ids by role, else the first column without a drug; after errors also accessions as ids, and no upper bounds of ranges."""
        drugs = {c["column_name"]: c["drug_name"] for c in columns if c["role"] in ("drug_mic", "drug_sir") and c["drug_name"]}
        accessions = tuple(c["column_name"] for c in columns if c["role"] == "public_accession")
        ids = tuple(c["column_name"] for c in columns if c["role"] == "local_id") or tuple(c["column_name"] for c in columns if c["column_name"] not in drugs)[:1]
        if any("identifier" in e for e in errors):
            ids += accessions
        return TransformSpec(ids, drugs, accessions, range_upper_bound=not any("mic" in e for e in errors))


_PROVIDERS: dict[str, Callable[[], Provider]] = {"rules": RuleProvider}


def register(name: str, make: Callable[[], Provider]) -> None:
    _PROVIDERS[name] = make


def provider(name: str = "rules") -> Provider:
    if name not in _PROVIDERS:
        raise ValueError(f"unknown provider {name!r}; known: {', '.join(sorted(_PROVIDERS))}")
    return _PROVIDERS[name]()


@dataclass(frozen=True)
class TransformSpec:
    """A reviewed, declarative transform of one wide table, in place of generated code."""

    id_columns: tuple[str, ...]
    drug_columns: dict[str, str]
    accession_columns: tuple[str, ...] = ()
    range_upper_bound: bool = True

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> TransformSpec:
        raw = json.loads(text)
        return TransformSpec(tuple(raw["id_columns"]), raw["drug_columns"], tuple(raw["accession_columns"]), raw["range_upper_bound"])

    def apply(self, df: DataFrame) -> DataFrame:
        """Records with isolate_id, accession, drug, mic_sign, mic, sir_call and notes."""
        if not self.id_columns or not self.drug_columns:
            raise ValueError("a transform needs an id column and a drug column")
        column = lambda c: F.col(f"`{c}`")
        ids = F.coalesce(*[F.nullif(F.trim(column(c)), F.lit("")) for c in self.id_columns])
        accession = unpivot.mined_accessions(F.array(*map(column, self.accession_columns))) if self.accession_columns else F.lit(None).cast("string")
        wide = df.select(ids.alias("isolate_id"), accession.alias("accession"), *map(column, self.drug_columns))
        long = unpivot.wide_to_long(wide, ["isolate_id", "accession"], list(self.drug_columns))
        name: Column = F.create_map(*[F.lit(x) for pair in self.drug_columns.items() for x in pair])[F.col("drug")]
        parsed = long.select("isolate_id", "accession", name.alias("drug"), unpivot.parse_cell(F.col("raw"), self.range_upper_bound).alias("c"))
        return parsed.select("isolate_id", "accession", "drug", "c.*").where("mic is not null or sir_call is not null")


#: Attempts at a sheet, and messages of one that go into the next.
ATTEMPTS, FEEDBACK = 2, 10


@dataclass(frozen=True)
class Attempt:
    """What one attempt at a sheet proposed and gave."""

    sheet: str
    pass_no: int
    attempt: int
    spec: str
    n_valid: int
    errors: tuple[str, ...]


def extract_sheet(name: str, df: DataFrame, columns: list[dict], how: Provider, attempts: int = ATTEMPTS, pass_no: int = 0) -> tuple[DataFrame | None, list[Attempt]]:
    """Valid records of one wide sheet, and the attempts made.

    An attempt counts when all its records are valid; else the next one is told the first ``FEEDBACK`` messages, most frequent first.  Of the
    last one the valid records are kept.  Only a count and these messages reach the driver.
    """
    errors: list[str] = []
    valid, log = None, []
    for attempt in range(1, attempts + 1):
        spec = how.propose(columns, errors, attempt, pass_no)
        try:
            records = spec.apply(df)
            valid, bad = qc.split(records)
            found = bad.select(F.explode("errors").alias("e")).groupBy("e").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "e").limit(FEEDBACK).collect()
            errors, n = [r["e"] for r in found], valid.count()
        except (AnalysisException, ValueError) as e:  # a column that isn't there, or no id column at all
            errors, n = [f"the transform failed: {str(e).splitlines()[0] if str(e) else type(e).__name__}"], 0
        log.append(Attempt(name, pass_no, attempt, spec.to_json(), n, tuple(errors)))
        if not errors:
            break
    return valid, log


def wide_sheet(cells: DataFrame, columns: list[dict], header_row: int) -> DataFrame:
    """One sheet's rows below its header as columns by name."""
    value = lambda c: F.max(F.when(F.col("col_idx") == c["col_idx"], F.col("value"))).alias(c["column_name"])
    return cells.where(F.col("row_idx") > header_row).groupBy("row_idx").agg(*map(value, columns))
