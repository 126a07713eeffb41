"""Column functions on sequence-repository accessions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ACCESSION_BLANK, let, null_if, scorer_clean, strip

# Columns of the typed split, in output order, and their patterns in order of trial.
TYPED_COLUMNS = ("bioproject_accession", "biosample_accession", "assembly_accession", "genbank_accessions", "refseq_accessions", "sra_accession", "other_accessions")
PATTERNS = {
    "bioproject_accession": r"(?i)^PRJ(NA|EB|DB)?[A-Z]?\d+$",
    "biosample_accession": r"(?i)^SAM(N|EA?|D)\d+(\.\d+)?$",
    "assembly_accession": r"(?i)^GC[AF]_\d+(\.\d+)?$",
    "refseq_accessions": r"(?i)^(NZ_|NC_|NM_|NR_|NP_|XM_|XR_|XP_)[A-Z]{2,6}_?\d+(\.\d+)?$",
    "sra_accession": r"(?i)^[SED]R[RAXPXZS]\d+$",
    "genbank_accessions": r"(?i)^([A-Z]{1,2}\d{5,6}|[A-Z]{4,6}\d{2}\d{6,8}|[A-Z]{4,6}\d{6,8})(\.\d+)?$",
}
PUBLIC = r"(?i)(PRJ\w*\d+|SAM[NED]\w*\d+|GC[AF]_\d+|[SED]R[RAXPXZS]\d+|[A-Z]{1,6}\d{5,8})"
# Prefixes of accession types, in order of trial.
TYPES = (("BioSample", ("SAMN", "SAME", "SRS")), ("BioProject", ("PRJN", "PRJE")), ("SRA_Run", ("SRR", "ERR", "DRR")), ("SRA_Experiment", ("SRX", "ERX", "DRX")))


def accession_type(c: Column) -> Column:
    s = F.upper(strip(c))
    out = F.when(F.coalesce(c, F.lit("")) == "", F.lit(None).cast("string"))
    for name, prefixes in TYPES:
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | s.startswith(p)
        out = out.when(hit, name)
    return out.otherwise("Accession")


def tokens(c: Column) -> Column:
    """Accessions in a delimited text, without quotes and null-like words; an empty array for none."""
    parts = F.transform(F.split(null_if(c, ACCESSION_BLANK), r"[,;\s]+"), lambda p: F.regexp_replace(strip(p), r"^['\"]+|['\"]+$", ""))
    return F.coalesce(F.filter(parts, lambda p: ~F.lower(p).isin(*ACCESSION_BLANK)), F.array().cast("array<string>"))


def distinct_by_upper(a: Column) -> Column:
    """First spelling of each token, whatever its case, in order."""
    upper = F.transform(a, F.upper)
    firsts = lambda u: F.filter(a, lambda t, i: F.array_position(u, F.get(u, i)) == i + 1)
    return F.when(F.size(a) < 2, a).otherwise(let(upper, firsts))


def is_biosample(c: Column) -> Column:
    return F.coalesce(strip(c).rlike(PATTERNS["biosample_accession"]), F.lit(False))


def has_biosample(c: Column) -> Column:
    return F.exists(tokens(c), is_biosample)


def format_combined(a: Column) -> Column:
    """Tokens without repeats, sample accessions first, each part sorted; null for none."""

    def body(d: Column) -> Column:
        parts = F.concat(F.array_sort(F.filter(d, is_biosample)), F.array_sort(F.filter(d, lambda t: ~is_biosample(t))))
        return F.when(F.size(d) > 0, F.array_join(parts, ","))

    return let(let(a, distinct_by_upper), body)


def token_kind(t: Column) -> Column:
    out = None
    for name, pattern in PATTERNS.items():
        out = F.when(t.rlike(pattern), name) if out is None else out.when(t.rlike(pattern), name)
    return out.otherwise("other_accessions")


def typed_split(c: Column) -> Column:
    """Struct with a field for each accession type: its tokens, sorted and joined; null for none.

    Tokens are found and told apart once for all fields.
    """
    kinds = F.transform(let(tokens(c), distinct_by_upper), lambda t: F.struct(t.alias("t"), token_kind(t).alias("k")))

    def field(k: Column, name: str) -> Column:
        own = F.transform(F.filter(k, lambda x: x["k"] == name), lambda x: x["t"])
        return F.nullif(F.array_join(F.array_sort(own), ","), F.lit("")).alias(name)

    return let(kinds, lambda k: F.struct(*[field(k, name) for name in TYPED_COLUMNS]))


def variants(c: Column) -> Column:
    """All equivalent spellings of one accession: assemblies without version and with either prefix."""
    s = F.upper(scorer_clean(c))
    base = F.regexp_extract(s, r"^(GC[AF]_\d+)(\.\d+)?$", 1)
    version = F.regexp_extract(s, r"^(GC[AF]_\d+)(\.\d+)?$", 2)
    other = F.concat(F.when(base.startswith("GCF_"), "GCA_").otherwise("GCF_"), F.substring(base, 5, 1000))
    more = F.array(s, base, other, F.concat(base, version), F.concat(other, version))
    return F.when(s == "", F.array().cast("array<string>")).when(base == "", F.array(s)).otherwise(F.array_distinct(more))


def split_variants(c: Column) -> Column:
    """Distinct variants of every accession in a delimited text."""
    return F.array_distinct(F.flatten(F.transform(F.split(scorer_clean(c), r"[,;|\s]+"), variants)))
