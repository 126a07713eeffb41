"""Linking of isolate ids to repository strains, and the update that fills blanks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_id, strip

_SAMPLE = ("bioproject_accession", "biosample_accession", "sra_accession")
#: Shorter ids never match in part.
GRAM = 3


def first_by_strain(strains: DataFrame) -> DataFrame:
    """The first record of each normalised strain, by ``ordinal``."""
    named = strains.withColumn("key", normalize_id(F.col("strain"))).where("key <> ''")
    return named.groupBy("key").agg(F.min_by(F.struct("strain", *_SAMPLE, "ordinal"), "ordinal").alias("s")).select("key", "s.*")


def match_exact(isolates: DataFrame, strains: DataFrame) -> DataFrame:
    known = first_by_strain(strains)
    return isolates.withColumn("key", normalize_id(F.col("isolate_id"))).join(known, "key")


def _parts(df: DataFrame, column: str, sizes: DataFrame) -> DataFrame:
    """Each string with its substrings of each of the ``sizes`` in ``part``."""
    at = F.sequence(F.lit(1), F.length(column) - F.col("size") + 1)
    each = df.join(F.broadcast(sizes), F.length(column) >= F.col("size")).select(*df.columns, "size", F.explode(at).alias("at"))
    return each.select(*df.columns, F.substring(F.col(column), F.col("at"), F.col("size")).alias("part"))


def _inside(short: DataFrame, a: str, long: DataFrame, b: str) -> DataFrame:
    """Pairs of rows, ``a`` of ``short``, where it's distinct, a part of ``b`` of ``long``.

    A part is looked up whole, among the substrings of the lengths that parts have, so only true pairs are made: a gram of ids
    that are numbered is in ever more of them. Parts whose first characters are nowhere add no length.
    """
    starts = _parts(long.select(b), b, long.sparkSession.range(1).select(F.lit(GRAM).alias("size"))).select("part").distinct()
    likely = short.join(starts, F.substring(F.col(a), 1, GRAM) == F.col("part"), "left_semi")
    sizes = likely.select(F.length(a).alias("size")).distinct()
    return _parts(long, b, sizes).join(likely, F.col("part") == F.col(a)).select(*short.columns, *long.columns)


def match_fuzzy(keys: DataFrame, known: DataFrame) -> DataFrame:
    """For each ``key`` the first strain that contains it or is contained in it, both of 3 characters or more."""
    k = keys.select("key").where(F.length("key") >= GRAM).distinct()
    s = known.where(F.length("key") >= GRAM).withColumnRenamed("key", "strain_key")
    short = s.select("strain_key", "ordinal")
    pairs = _inside(k, "key", short, "strain_key").unionByName(_inside(short, "strain_key", k, "key"))
    first = pairs.groupBy("key").agg(F.min(F.struct("ordinal", "strain_key")).alias("f")).select("key", F.col("f.strain_key").alias("strain_key"))
    return first.join(s, "strain_key").select("key", "strain", *_SAMPLE, "ordinal")


def match_all(isolates: DataFrame, strains: DataFrame) -> DataFrame:
    """A match row for each isolate: exact, else fuzzy, else no_match with blanks."""
    known = first_by_strain(strains)
    keyed = isolates.withColumn("key", normalize_id(F.col("isolate_id")))
    keys = keyed.select("key").distinct()
    rest = keys.join(known.select("key"), "key", "left_anti")
    found = known.drop("ordinal").withColumn("match_type", F.lit("exact")).unionByName(
        match_fuzzy(rest, known).drop("ordinal").withColumn("match_type", F.lit("fuzzy"))
    )
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return keyed.join(found, "key", "left").select(
        *isolates.columns, F.coalesce("match_type", F.lit("no_match")).alias("match_type"), F.coalesce("strain", F.lit("")).alias("matched_strain"), *map(blank, _SAMPLE)
    )


def _filled(old: Column, new: Column) -> Column:
    empty = lambda c: F.nullif(strip(c), F.lit(""))
    return F.when(empty(old).isNull() & empty(new).isNotNull(), new).otherwise(old)


def fill_blanks(records: DataFrame, matches: DataFrame) -> DataFrame:
    """Records with blank accession columns filled from exact matches of the same file; nothing is overwritten.

    Of several matches of an id in a file the last one (largest ``ordinal``) counts.
    """
    key = normalize_id(F.col("isolate_id"))
    best = (
        matches.where("match_type = 'exact'").withColumn("m_key", key).groupBy("source_file", "m_key")
        .agg(F.max_by(F.struct(*_SAMPLE), "ordinal").alias("m"))
    )
    joined = records.withColumn("key", key).join(best, (records["file_name"] == best["source_file"]) & (F.col("key") == F.col("m_key")), "left")
    return joined.select(*[_filled(records[c], F.col(f"m.{c}")).alias(c) if c in _SAMPLE else records[c] for c in records.columns])


def n_filled(before: DataFrame, after: DataFrame) -> int:
    """Number of accession cells that ``fill_blanks`` filled; files without these columns have none."""
    given = lambda df: [F.count_if(F.coalesce(strip(F.col(c)), F.lit("")) != "").alias(c) for c in _SAMPLE if c in df.columns]
    if not given(before):
        return 0
    a, b = before.agg(*given(before)).first(), after.agg(*given(after)).first()
    return sum(b) - sum(a)


def project_accessions(papers: DataFrame) -> DataFrame:
    """Project accessions of each paper: its own list, else those among its data-availability accessions; sorted."""
    listed = F.filter(F.transform(F.split(F.coalesce("bioproject_accessions", F.lit("")), ";"), strip), lambda a: a != "")
    mined = F.filter(F.transform(F.split(F.coalesce("data_availability_accessions", F.lit("")), ";"), strip), lambda a: a.rlike(r"^PRJ(?:NA|EB|DB)\d+$"))
    chosen = F.when(F.size(listed) > 0, listed).otherwise(mined)
    return papers.select("pmid", F.array_join(F.array_sort(F.array_distinct(chosen)), ";").alias("bioprojects"))


def strain_of(sample_data: Column, title: Column) -> Column:
    """Strain in a sample's summary: the strain field, else the title's ``str.`` suffix, else the title."""
    field = F.nullif(strip(F.regexp_extract(sample_data, r"(?i)strain:\s*([^;]+)", 1)), F.lit(""))
    return F.coalesce(field, F.nullif(F.regexp_extract(title, r"(?i)str\.\s*(\S+)\s*$", 1), F.lit("")), title)


def run_of(identifiers: Column) -> Column:
    return F.nullif(F.regexp_extract(identifiers, r"\bSRA:\s*([A-Z]{3}\d+)", 1), F.lit(""))


def samples_of_projects(projects: DataFrame, links: DataFrame, summaries: DataFrame) -> DataFrame:
    """Two hops over local tables: project -> sample uid -> sample record."""
    return projects.join(links, "bioproject_accession").join(summaries, "biosample_uid").select(
        "bioproject_accession", "biosample_uid", "biosample_accession", strain_of(F.col("sample_data"), F.col("title")).alias("strain"), F.coalesce(run_of(F.col("identifiers")), F.lit("")).alias("sra_accession")
    )
