"""Rule-based quality control with quarantine, and row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.accession import TYPED_COLUMNS
from ..functions.text import BLANK, computed, is_blank, null_if, strip

# What a record may say.
MIC_SIGNS = ("=", ">", ">=", "<", "<=")
CALLS = ("S", "I", "R", "SDD", "NS")
MIC_NUMERIC = r"^\d+(\.\d+)?(/\d+(\.\d+)?)*$"
HEADER_WORDS = (
    "cvm_number", "isolate", "isolate_id", "isolate id", "isolate_name", "sample", "sample_id", "sample id", "specimen",
    "sequencing_number", "accession", "nucleotide accession", "accession number", "genus", "organism", "species",
    "range measured", "cutoff", "cutoff (>= x)", "breakpoint",
)


def with_errors(df: DataFrame) -> DataFrame:
    """Add ``errors``, the messages of all rules that a record breaks, in rule order."""
    c = {n: F.col(n) for n in df.columns}
    no_id = F.lit(True)
    for n in ("isolate_id", "accession", *TYPED_COLUMNS):
        if n in c:
            no_id = no_id & is_blank(c[n])
    # What the rules read, once a record: the optimiser would copy it into each use and the whole into each filter.
    parts = {"no_drug": is_blank(c["drug"]), "no_id": no_id, "sir": null_if(c["sir_call"], BLANK), "sign": null_if(c["mic_sign"], BLANK), "mic": null_if(c["mic"], BLANK)}
    judged = computed(df, {f"qc_{n}": x for n, x in parts.items()})
    no_drug, no_id, sir, sign, mic = (F.col(f"qc_{n}") for n in parts)
    rules = [
        (no_drug, F.lit("missing drug")),
        (no_id, F.lit("missing identifier")),
        (sir.isNotNull() & ~F.upper(sir).isin(*CALLS), F.concat(F.lit("invalid sir_call "), c["sir_call"])),
        (sir.isNull() & (mic.isNull() | sign.isNull()), F.lit("missing measurement and call")),
        (sign.isNotNull() & ~sign.isin(*MIC_SIGNS), F.concat(F.lit("invalid mic_sign "), c["mic_sign"])),
        (mic.isNotNull() & ~mic.rlike(MIC_NUMERIC), F.concat(F.lit("non-numeric mic "), c["mic"])),
    ]
    # Flattened rather than filtered: a lambda would take all rules out of generated code.
    none = F.array().cast("array<string>")
    errors = F.flatten(F.array(*[F.when(hit, F.array(message)).otherwise(none) for hit, message in rules]))
    return computed(judged, {"errors": errors}).drop(*[f"qc_{n}" for n in parts])


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid records, and quarantined ones with their ``errors``."""
    judged = with_errors(df)
    return judged.where(F.size("errors") == 0).drop("errors"), judged.where(F.size("errors") > 0)


def errors(df: DataFrame) -> DataFrame:
    """One row for each broken rule of each record, with its place among the record's errors."""
    return with_errors(df).select(*df.columns, F.posexplode("errors").alias("error_no", "error"))


def drop_empty(df: DataFrame, mic: str = "mic", call: str = "sir_call") -> DataFrame:
    return df.where(F.col(mic).isNotNull() | F.col(call).isNotNull())


def drop_header_rows(df: DataFrame, id_col: str, id_name: str) -> DataFrame:
    """Without rows that repeat a header inside the data."""
    low = F.lower(strip(F.col(id_col)))
    polluted = low.isin(*HEADER_WORDS) | (low == id_name.lower()) | low.contains("range measured") | low.contains("cutoff")
    return df.where(~F.coalesce(polluted, F.lit(False)))


def incorrect_rows(compared: DataFrame) -> DataFrame:
    missing = {"sir_result", "mic_result"} - set(compared.columns)
    if missing:
        raise ValueError(f"missing columns: {', '.join(sorted(missing))}")
    return compared.where((F.upper("sir_result") == "INCORRECT") | (F.upper("mic_result") == "INCORRECT"))


def incorrect_counts(compared: DataFrame) -> DataFrame:
    sir, mic = (F.coalesce(F.upper(c) == "INCORRECT", F.lit(False)) for c in ("sir_result", "mic_result"))
    count = lambda x, name: F.count_if(x).alias(name)
    return compared.agg(F.count(F.lit(1)).alias("n_rows"), count(sir, "sir_incorrect"), count(mic, "mic_incorrect"), count(sir & mic, "both_incorrect"), count(sir | mic, "any_incorrect"))
