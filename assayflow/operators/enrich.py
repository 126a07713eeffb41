"""Accession enrichment from metadata sheets, and the final record layout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.accession import PUBLIC, TYPED_COLUMNS, format_combined, has_biosample, is_biosample, tokens, typed_split
from ..functions.text import BLANK, base_name, null_if, strip


def needs_enrichment(df: DataFrame) -> DataFrame:
    """One row: whether some record lacks a sample accession."""
    return df.agg(F.coalesce(F.bool_or(~has_biosample(F.col("accession"))), F.lit(False)).alias("needed"))


def _accession_columns(meta: DataFrame) -> list[str]:
    return [c for c in meta.columns if c in ("accession", "secondary_accession") or (c != "isolate_id" and "accession" in c.lower())]


def metadata_index(meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All accessions of a metadata table, by isolate and by accession token.

    Aggregated before any join, so that joins keep the number of records.
    """
    all_tokens = F.flatten(F.array(*[tokens(F.col(c)) for c in _accession_columns(meta)]))
    rows = meta.select(null_if(F.col("isolate_id"), BLANK).alias("iso"), all_tokens.alias("accs")).where(F.size("accs") > 0)
    combined = lambda name: F.array_sort(F.array_distinct(F.flatten(F.collect_set("accs")))).alias(name)
    by_isolate = rows.where("iso is not null").groupBy("iso").agg(combined("iso_accs"))
    by_token = rows.select(F.explode(F.array_distinct("accs")).alias("token"), "accs").groupBy("token").agg(combined("token_accs"))
    return by_isolate, by_token


def match_tokens(df: DataFrame, by_isolate: DataFrame, by_token: DataFrame) -> DataFrame:
    """For every distinct accession text the accessions its tokens lead to: a token's own rows, else an isolate of that name."""
    texts = df.select(F.col("accession").alias("acc_text")).where("accession is not null").distinct()
    each = texts.select("acc_text", F.explode(tokens(F.col("acc_text"))).alias("token"))
    found = each.join(by_token, "token", "left").join(by_isolate.withColumnsRenamed({"iso": "token", "iso_accs": "named"}), "token", "left")
    hit = F.coalesce("token_accs", "named")
    return found.where(hit.isNotNull()).groupBy("acc_text").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(hit)))).alias("by_token"))


def enrich(df: DataFrame, meta: DataFrame) -> DataFrame:
    """Records with their accessions completed: by isolate, else by token; a replaced accession is noted."""
    by_isolate, by_token = metadata_index(meta)
    texts = match_tokens(df, by_isolate, by_token)
    joined = (
        df.withColumn("iso", null_if(F.col("isolate_id"), BLANK))
        .join(by_isolate, "iso", "left")
        .join(texts, F.col("accession") == F.col("acc_text"), "left")
    )
    current, found = tokens(F.col("accession")), F.coalesce("iso_accs", "by_token")
    merged = format_combined(F.concat(current, F.coalesce(found, F.array().cast("array<string>"))))
    was = null_if(F.col("accession"), BLANK)
    gained = found.isNotNull() & was.isNotNull() & ~F.exists(current, is_biosample) & has_biosample(merged)
    note, old = F.concat(F.lit("original accession: "), was), null_if(F.col("notes"), BLANK)
    noted = F.when(gained & ~F.coalesce(F.contains(old, note), F.lit(False)), F.concat_ws("; ", old, note)).otherwise(F.col("notes"))
    accession = F.when(found.isNotNull() | (F.size(current) > 0), merged).otherwise(F.col("accession"))
    return joined.withColumns({"accession": accession, "notes": noted}).select(*df.columns)


def apply_metadata(df: DataFrame, metas: list[DataFrame], hops: int = 2, between: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """All metadata maps at once, ``hops`` times, so that an accession found may lead to the next.

    ``between`` is applied after every hop; a step that materialises keeps the plan of the records from being repeated by each hop's joins.
    """
    if not metas:
        return df
    whole = metas[0]
    for m in metas[1:]:
        whole = whole.unionByName(m, allowMissingColumns=True)
    for _ in range(hops):
        df = between(enrich(df, whole))
    return df


def finalize(df: DataFrame, file_path: Column, sheet_name: Column, pmid: Column) -> DataFrame:
    """The 16 ordered output columns; accessions by type, columns that are absent as nulls."""
    out = df.withColumns({"pmid": pmid, "file_name": base_name(file_path), "sheet_name": sheet_name})
    if "accession" in df.columns:
        # The struct is computed in a projection of its own, as its seven fields would each repeat it.
        kept = [c for c in out.columns if c not in TYPED_COLUMNS]
        out = out.select(*kept, typed_split(F.col("accession")).alias("__typed")).select(*kept, "__typed.*")
    names = schemas.RECORD_FINAL.fieldNames()
    return out.select(*[F.col(n).cast("string").alias(n) if n in out.columns else F.lit(None).cast("string").alias(n) for n in names])


def candidate_metadata_sheets(cells: DataFrame, ids: DataFrame, head: int = 8) -> DataFrame:
    """Per sheet, whether it may map isolates to accessions.

    ``cells`` has sheet, row_idx, col_name and value; ``ids`` one column ``known`` of
    isolate ids and accessions and a boolean ``is_isolate``.
    """
    shown = cells.where(F.col("row_idx") < head).withColumn("low", F.lower(strip(F.col("value"))))
    known = ids.select(F.lower(strip(F.col("known"))).alias("low"), "is_isolate").where("low <> ''").distinct()
    any_isolate = known.agg(F.coalesce(F.bool_or("is_isolate"), F.lit(False)).alias("any_isolate"))
    hits = shown.join(known.select("low").distinct(), "low", "left_semi").select("sheet").distinct().withColumn("overlap", F.lit(True))
    per = shown.groupBy("sheet").agg(
        F.bool_or(F.coalesce(F.col("value").rlike(PUBLIC), F.lit(False))).alias("has_accession"),
        F.bool_or(F.lower("col_name").rlike(r"(sample|isolate|strain|cvm|specimen)")).alias("id_name"),
    )
    # The one-row frame holds a single boolean.
    judged = per.join(hits, "sheet", "left").join(F.broadcast(any_isolate))
    return judged.select("sheet", (F.col("has_accession") & (F.coalesce("overlap", F.lit(False)) | (F.col("any_isolate") & F.col("id_name")))).alias("candidate"))
