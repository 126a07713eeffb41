"""Maps from isolates to accessions, found in sheets that hold no measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.accession import PUBLIC, is_biosample
from ..functions.text import strip
from . import enrich, unpivot


def metadata_map(cells: DataFrame, roles: DataFrame) -> DataFrame:
    """``sheet, row_idx, isolate_id, accession, secondary_accession`` of every row with an id or an accession.

    ``cells`` has sheet, row_idx, col_idx and value, ``roles`` sheet, col_idx, column_name and role.  The id is the sheet's primary
    one; all accessions of a row are joined, and those that are not of a sample once more in the second column.
    """
    names = roles.select("sheet", "col_idx", "column_name", "role")
    first = unpivot.primary_ids(roles).select("sheet", "id_column")
    data = cells.select("sheet", "row_idx", "col_idx", strip(F.col("value")).alias("value")).where("value <> ''").join(names, ["sheet", "col_idx"]).join(first, "sheet", "left")
    own = F.max(F.when((F.col("column_name") == F.col("id_column")) & (F.col("role") != "public_accession"), F.col("value"))).alias("isolate_id")
    # A row has as many accessions as its cells hold.
    found = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.regexp_extract_all("value", F.lit(PUBLIC), F.lit(1))))))
    rows = data.groupBy("sheet", "row_idx").agg(own, found.alias("accs"))
    joined = lambda a: F.when(F.size(a) > 0, F.array_join(a, ","))
    out = rows.select("sheet", "row_idx", "isolate_id", joined(F.col("accs")).alias("accession"), joined(F.filter("accs", lambda a: ~is_biosample(a))).alias("secondary_accession"))
    return out.where("isolate_id is not null or accession is not null")


def discover(cells: DataFrame, roles: DataFrame, records: DataFrame, done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The maps of all candidate sheets outside of ``done`` (column sheet), and a log of the sheets looked at.

    ``cells`` are those below the headers, with rows numbered from there.
    The log has ``sheet, candidate, n_rows``: the rows of the map that a candidate gave.
    """
    left = cells.join(done.select("sheet").distinct(), "sheet", "left_anti")
    names = roles.select("sheet", "col_idx", F.col("column_name").alias("col_name"))
    tokens = records.select(F.explode(F.split(F.coalesce("accession", F.lit("")), r"[,;\s]+")).alias("known"), F.lit(False).alias("is_isolate"))
    ids = records.select(F.col("isolate_id").alias("known"), F.lit(True).alias("is_isolate")).unionByName(tokens).distinct()
    judged = enrich.candidate_metadata_sheets(left.join(names, ["sheet", "col_idx"]).select("sheet", "row_idx", "col_name", "value"), ids)
    maps = metadata_map(left.join(judged.where("candidate").select("sheet"), "sheet", "left_semi"), roles)
    counts = maps.groupBy("sheet").agg(F.count(F.lit(1)).alias("n_rows"))
    return maps, judged.join(counts, "sheet", "left").select("sheet", "candidate", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
