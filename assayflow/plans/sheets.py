"""Queries of sheet, column and cell operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.drugs import drug_of_header, split_combined
from ..operators import cells as C
from ..operators import enrich, metadata, sheets, unpivot
from .registry import query

HEADER = """
sc AS (SELECT sheet, row_idx, count(*) FILTER (is_string AND trim(coalesce(value, '')) <> '') AS score FROM cells WHERE row_idx < 15 GROUP BY 1, 2),
mx AS (SELECT *, max(score) OVER (PARTITION BY sheet) AS most FROM sc),
hd AS (SELECT sheet, CAST(coalesce(min(row_idx) FILTER (most > 1 AND score >= greatest(2, floor(most * 0.4))), 0) AS INTEGER) AS header_row FROM mx GROUP BY sheet)
"""


@query("header_row_detect", f"WITH {HEADER} SELECT * FROM hd", ("cells",))
def header_row_detect(get):
    return C.header_rows(get("cells"))


_MERGED = """
mc AS (SELECT sheet, CAST(row_idx + 1 AS INTEGER) AS row_idx, col_idx, value, is_string FROM cells WHERE row_idx < 3
  UNION ALL SELECT DISTINCT sheet, 0, col_idx, CASE col_idx WHEN 1 THEN 'MIC' WHEN 3 THEN 'Other' END, TRUE FROM cells)
"""


def _merged(get):
    """Cells with a spanning row above."""
    c = get("cells")
    spanning = c.select("sheet", "col_idx").distinct().select("sheet", F.lit(0).alias("row_idx"), "col_idx", F.when(F.col("col_idx") == 1, "MIC").when(F.col("col_idx") == 3, "Other").alias("value"), F.lit(True).alias("is_string"))
    return c.where("row_idx < 3").withColumn("row_idx", F.col("row_idx") + 1).unionByName(spanning)


@query("header_flatten", f"""WITH {_MERGED}, p AS (SELECT sheet, row_idx, col_idx, CASE WHEN is_string THEN nullif(trim(value), '') END AS label FROM mc WHERE row_idx <= 2),
q AS (SELECT *, count(label) OVER (PARTITION BY sheet, row_idx) AS n, last_value(label IGNORE NULLS) OVER (PARTITION BY sheet, row_idx ORDER BY col_idx) AS filled FROM p),
r AS (SELECT sheet, col_idx, row_idx, CASE WHEN row_idx < 2 THEN filled ELSE label END AS part FROM q WHERE row_idx = 2 OR n > 1)
SELECT sheet, col_idx, coalesce(nullif(coalesce(string_agg(part, '_' ORDER BY row_idx) FILTER (part NOT LIKE 'Unnamed:%' AND lower(part) <> 'nan'), ''), ''), 'Unnamed') AS col_name FROM r GROUP BY 1, 2""", ("cells",))
def header_flatten(get):
    merged = _merged(get)
    return C.flat_headers(merged, merged.select("sheet").distinct().withColumn("header_row", F.lit(2)))


@query("stacked_sheet_detect", """WITH h AS (SELECT sheet, row_idx FROM cells WHERE is_string AND regexp_matches(lower(value), 'vancomycin|oxacillin') GROUP BY 1, 2 HAVING count(*) >= 2),
g AS (SELECT sheet, row_idx - lag(row_idx) OVER (PARTITION BY sheet ORDER BY row_idx) AS gap FROM h)
SELECT s.sheet, coalesce(bool_or(gap > 3 AND gap - 1 >= 5), FALSE) AS stacked FROM (SELECT DISTINCT sheet FROM cells) s LEFT JOIN g ON g.sheet = s.sheet GROUP BY s.sheet""", ("cells",))
def stacked_sheet_detect(get):
    return C.stacked_sheets(get("cells"))


@query("ffill_ids", """SELECT sheet, row_idx, last_value(nullif(trim(value), '') IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY row_idx) AS value FROM cells WHERE col_idx = 0""", ("cells",))
def ffill_ids(get):
    return C.fill_down(get("cells"), [0]).select("sheet", "row_idx", "value")


@query("sheet_preview", """SELECT sheet, row_idx, string_agg(CASE WHEN regexp_matches(v, '[,"\\n]') THEN '"' || replace(v, '"', '""') || '"' ELSE v END, ',' ORDER BY col_idx) AS line
FROM (SELECT sheet, row_idx, col_idx, coalesce(value, '') AS v FROM cells WHERE row_idx < 6) GROUP BY 1, 2""", ("cells",))
def sheet_preview(get):
    return C.preview(get("cells"))


_NAMES = ("Isolate ID", "vancomycin (MIC)", "Unnamed: 2", "oxacillin", "Unnamed: 4", "BioSample")


def _named(get):
    return get("cells").where("row_idx > 1").withColumn("column_name", F.element_at(F.array(*map(F.lit, _NAMES)), F.col("col_idx") + 1))


def _roles(get):
    roles = ("local_id", "drug_mic", "drug_sir", "drug_mic", "drug_sir", "public_accession")
    rows = F.array(*[F.struct(F.lit(i).alias("col_idx"), F.lit(n).alias("column_name"), F.lit(r).alias("role"), F.lit("Unnamed: 2" if i == 1 else "oxacillin" if i == 4 else None).cast("string").alias("paired_with")) for i, (n, r) in enumerate(zip(_NAMES, roles, strict=True))])
    return get("cells").select("sheet").distinct().select("sheet", F.inline(rows))


@query("unpivot_paired", r"""WITH d AS (SELECT sheet, row_idx, max(CASE WHEN col_idx = 0 THEN value END) AS c0, max(CASE WHEN col_idx = 1 THEN value END) AS c1, max(CASE WHEN col_idx = 2 THEN value END) AS c2,
  max(CASE WHEN col_idx = 3 THEN value END) AS c3, max(CASE WHEN col_idx = 4 THEN value END) AS c4, max(CASE WHEN col_idx = 5 THEN value END) AS c5 FROM cells WHERE row_idx > 1 GROUP BY 1, 2),
l AS (SELECT sheet, row_idx, coalesce(nullif(trim(c0), ''), c5) AS c0, 'vancomycin (MIC)' AS drug_raw, c1 AS m, c2 AS s FROM d UNION ALL SELECT sheet, row_idx, coalesce(nullif(trim(c0), ''), c5), 'oxacillin', c3, c4 FROM d),
p AS (SELECT *, regexp_extract(trim(m), '^(<=|>=|<|>|=)?\s*(\d+(?:\.\d+)?)$', 2) AS v FROM l WHERE coalesce(lower(trim(c0)), '') NOT IN ('isolate id')),
r AS (SELECT sheet, row_idx, coalesce(nullif(trim(c0), ''), 'isolate_' || CAST(row_idx + 1 AS VARCHAR)) AS isolate_name, drug_raw, CASE WHEN v <> '' THEN coalesce(nullif(regexp_extract(trim(m), '^(<=|>=|<|>|=)', 1), ''), '=') END AS mic_operator,
  nullif(v, '') AS mic_value, CASE WHEN s IN ('S', 'R', 'I', 'x') OR s LIKE 'Unnamed%' THEN s END AS sir_call FROM p)
SELECT * FROM r WHERE mic_value IS NOT NULL OR sir_call IS NOT NULL""", ("cells",))
def unpivot_paired(get):
    return unpivot.paired_records(_named(get), _roles(get))


@query("unpivot_wide", """SELECT o_orderkey, o_custkey, 'price' AS drug, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS raw FROM orders UNION ALL SELECT o_orderkey, o_custkey, 'status', o_orderstatus FROM orders WHERE trim(o_orderstatus) <> ''
UNION ALL SELECT o_orderkey, o_custkey, 'priority', o_orderpriority FROM orders WHERE trim(o_orderpriority) <> ''""")
def unpivot_wide(get):
    o = get("orders").select("o_orderkey", "o_custkey", F.floor("o_totalprice").cast("bigint").cast("string").alias("price"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return unpivot.wide_to_long(o, ["o_orderkey", "o_custkey"], ["price", "status", "priority"])


@query("split_combined_drug", """SELECT l_orderkey * 10 + l_linenumber AS k, unnest(['EM', 'CLDM']) AS drug, unnest([CAST(l_linenumber AS VARCHAR), CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_suppkey AS VARCHAR) END]) AS value FROM lineitem""")
def split_combined_drug(get):
    value = F.when(F.col("l_linenumber") % 2 == 0, F.concat_ws("/", F.col("l_linenumber").cast("string"), F.col("l_suppkey").cast("string"))).otherwise(F.col("l_linenumber").cast("string"))
    li = get("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), F.explode(split_combined(value, F.lit("EM/CLDM"))).alias("x"))
    return li.select("k", "x.drug", "x.value")


_RAW = "CASE l_suppkey % 9 WHEN 0 THEN '2–4' WHEN 1 THEN '8 (R)' WHEN 2 THEN 'S' WHEN 3 THEN '≤0.5' WHEN 4 THEN '>=64 S' WHEN 5 THEN 'ND' WHEN 6 THEN '32/16' WHEN 7 THEN '0.25-1 (I)' END"
_CELL_SQL = f"""WITH c AS (SELECT l_orderkey * 10 + l_linenumber AS k, l_suppkey % 9 AS r FROM lineitem) SELECT k,
  CASE r WHEN 0 THEN '=' WHEN 1 THEN '=' WHEN 3 THEN '<=' WHEN 4 THEN '>=' WHEN 6 THEN '=' WHEN 7 THEN '=' END AS mic_sign, CASE r WHEN 0 THEN '4' WHEN 1 THEN '8' WHEN 3 THEN '0.5' WHEN 4 THEN '64' WHEN 6 THEN '32/16' WHEN 7 THEN '1' END AS mic,
  CASE r WHEN 1 THEN 'R' WHEN 2 THEN 'S' WHEN 4 THEN 'S' WHEN 7 THEN 'I' END AS sir_call, CASE WHEN r IN (0, 7) THEN 'upper bound of range' WHEN r IN (1, 6) THEN 'mic_sign ''='' inferred' END AS notes FROM c"""


def _raw_cells(get):
    return get("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), F.expr(_RAW).alias("raw"))


@query("cell_parse", _CELL_SQL)
def cell_parse(get):
    return _raw_cells(get).select("k", unpivot.parse_cell(F.col("raw")).alias("c")).select("k", "c.*")


@query("mic_range_policy", f"SELECT k, mic AS upper_bound, CASE WHEN notes LIKE 'upper%' THEN NULL ELSE mic END AS rejected FROM ({_CELL_SQL})")
def mic_range_policy(get):
    both = _raw_cells(get).select("k", unpivot.parse_cell(F.col("raw"))["mic"].alias("upper_bound"), unpivot.parse_cell(F.col("raw"), upper_bound=False)["mic"].alias("rejected"))
    return both


@query("drug_header_map", """SELECT p_partkey AS k, CASE p_partkey % 8 WHEN 0 THEN 'vancomycin' WHEN 1 THEN 'trimethoprim/sulfamethoxazole' WHEN 2 THEN 'oxacillin' WHEN 4 THEN 'trimethoprim/sulfamethoxazole' WHEN 5 THEN 'rifampin' WHEN 6 THEN 'trimethoprim' END AS drug FROM part""")
def drug_header_map(get):
    header = F.element_at(F.array(*map(F.lit, ("Vancomycin MIC (mg/L)", "SXT", "oxa", "Isolate", "Trimethoprim/sulfamethoxazole [ug/mL]", "rif (MIC)", "trimethoprim, mg", "xoxacilline"))), (F.col("p_partkey") % 8 + 1).cast("int"))
    return get("part").select(F.col("p_partkey").alias("k"), drug_of_header(header).alias("drug"))


@query("accession_mining", """SELECT o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN 'PRJNA' || CAST(o_custkey AS VARCHAR) || ',SAMN' || CAST(o_orderkey AS VARCHAR) WHEN 1 THEN 'ERR' || CAST(o_orderkey AS VARCHAR) END AS accs FROM orders""")
def accession_mining(get):
    o = get("orders")
    first = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("see SAMN"), F.col("o_orderkey").cast("string"), F.lit(" in PRJNA"), F.col("o_custkey").cast("string"))).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("run ERR"), F.col("o_orderkey").cast("string")))
    return o.select(F.col("o_orderkey").alias("k"), unpivot.mined_accessions(F.array(first, F.lit("none"), F.lit(None).cast("string"))).alias("accs"))


_PROFILE = r"""
pv AS (SELECT sheet, col_idx, trim(value) AS v FROM cells WHERE row_idx > 1 AND trim(value) <> ''),
pr AS (SELECT sheet, col_idx, avg(CASE WHEN regexp_full_match(v, '(<=|>=|<|>|=)?\s*\d+(\.\d+)?(\s*/\s*\d+(\.\d+)?)*') THEN 1 ELSE 0 END) AS mic, avg(CASE WHEN upper(v) IN ('S','I','R','SDD','NS') THEN 1 ELSE 0 END) AS sir FROM pv GROUP BY 1, 2),
rl AS (SELECT sheet, col_idx, CASE WHEN col_idx IN (1, 3) AND mic >= 0.5 THEN 'drug_mic' WHEN col_idx = 0 THEN 'local_id' WHEN col_idx = 5 THEN 'public_accession' WHEN col_idx IN (2, 4) AND sir >= 0.3 THEN 'drug_sir' ELSE 'metadata' END AS role FROM pr)
"""


def _profiles(get):
    names = _named(get).select("sheet", "col_idx", F.col("column_name").alias("col_name")).distinct()
    return sheets.column_roles(sheets.column_profiles(get("cells").where("row_idx > 1"), names))


@query("column_role_rules", f"""WITH {_PROFILE} SELECT a.sheet, a.col_idx, a.role, CASE WHEN a.role = 'drug_mic' AND b.role = 'drug_sir' THEN CASE a.col_idx WHEN 1 THEN 'Unnamed: 2' ELSE 'Unnamed: 4' END END AS paired_with
FROM rl a LEFT JOIN rl b ON a.sheet = b.sheet AND b.col_idx = a.col_idx + 1""", ("cells",))
def column_role_rules(get):
    return _profiles(get).select("sheet", "col_idx", "role", "paired_with")


@query("sheet_classify_rules", f"""WITH {_PROFILE}, f AS (SELECT sheet, bool_or(role = 'drug_mic') AS m, bool_or(role = 'drug_sir') AS s FROM rl GROUP BY sheet)
SELECT sheet, m OR s AS contains_ast_data, m AS has_mic_values, s AS has_sir_calls, CASE WHEN m AND s THEN 'MIC + SIR' WHEN m THEN 'MIC VALUES' WHEN s THEN 'SIR-ONLY' ELSE 'SKIPPED' END AS status FROM f""", ("cells",))
def sheet_classify_rules(get):
    return sheets.classify(_profiles(get))


_CLS = "SELECT c_custkey AS sheet, c_nationkey AS workbook, c_custkey % 3 = 0 AND c_nationkey % 2 = 0 AS has_mic_values, c_custkey % 2 = 0 AS has_sir_calls FROM customer"


@query("target_sheet_select", f"WITH c AS ({_CLS}), w AS (SELECT *, bool_or(has_mic_values) OVER (PARTITION BY workbook) AS any_mic FROM c) SELECT sheet, workbook, has_mic_values, has_sir_calls FROM w WHERE CASE WHEN any_mic THEN has_mic_values ELSE has_sir_calls END")
def target_sheet_select(get):
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    c = get("customer").select(key.alias("sheet"), nation.alias("workbook"), ((key % 3 == 0) & (nation % 2 == 0)).alias("has_mic_values"), (key % 2 == 0).alias("has_sir_calls"))
    return sheets.target_sheets(c)


@query("candidate_metadata_sheet", """WITH m AS (SELECT concat('m', CAST(s_suppkey % 13 AS VARCHAR)) AS sheet, CAST(s_suppkey // 13 AS INTEGER) AS row_idx, s_suppkey FROM supplier),
h AS (SELECT sheet, bool_or(s_suppkey % 13 < 6) AS acc, bool_or(s_suppkey % 13 % 2 = 0 AND s_suppkey % 4 = 0) AS hit, bool_or(s_suppkey % 13 = 5) AS named FROM m WHERE row_idx < 8 GROUP BY sheet)
SELECT sheet, acc AND (hit OR named) AS candidate FROM h""")
def candidate_metadata_sheet(get):
    s = F.col("s_suppkey")
    m = get("supplier").select(F.concat(F.lit("m"), (s % 13).cast("string")).alias("sheet"), F.floor(s / 13).cast("int").alias("row_idx"), s)
    first = m.select("sheet", "row_idx", F.when(s % 13 == 5, "Strain").otherwise("c0").alias("col_name"), F.when(s % 13 < 6, F.concat(F.lit("SAMN"), s.cast("string"))).otherwise("text").alias("value"))
    second = m.select("sheet", "row_idx", F.lit("c1").alias("col_name"), F.when(s % 13 % 2 == 0, F.concat(F.lit(" iso-"), s.cast("string"))).otherwise("?").alias("value"))
    ids = get("supplier").select(F.when(s % 4 == 0, F.concat(F.lit("ISO-"), s.cast("string"))).alias("known"), F.lit(True).alias("is_isolate"))
    return enrich.candidate_metadata_sheets(first.unionByName(second), ids)


_MAPPED = """
SELECT concat('m', CAST(s_suppkey % 7 AS VARCHAR(20))) AS sheet, s_suppkey AS row_idx, c.col_idx,
  CASE c.col_idx WHEN 0 THEN CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE concat(' ISO-', CAST(s_suppkey AS VARCHAR(20)), ' ') END
    WHEN 1 THEN CASE s_suppkey % 3 WHEN 0 THEN concat('see SAMN', CAST(s_suppkey AS VARCHAR(20)), ', ERR', CAST(s_suppkey AS VARCHAR(20))) WHEN 1 THEN 'none' ELSE concat('CP', CAST(100000 + s_suppkey AS VARCHAR(20))) END
    ELSE CASE WHEN s_suppkey % 4 = 0 THEN concat('GCA_', CAST(s_suppkey AS VARCHAR(20))) ELSE 'a word' END END AS value
FROM {0} CROSS JOIN (SELECT 0 AS col_idx UNION ALL SELECT 1 UNION ALL SELECT 2) c
"""
_MAP_SQL = f"""
m AS ({_MAPPED.format('supplier')}),
x AS (SELECT sheet, row_idx, max(CASE WHEN col_idx = 0 THEN nullif(trim(value), '') END) AS isolate_id, list_sort(list_distinct(flatten(list(regexp_extract_all(value, 'SAMN[0-9]+|ERR[0-9]+|GCA_[0-9]+|CP[0-9]+'))))) AS accs
  FROM m WHERE value IS NOT NULL GROUP BY 1, 2),
mm AS (SELECT sheet, row_idx, isolate_id, nullif(array_to_string(accs, ','), '') AS accession, nullif(array_to_string(list_filter(accs, lambda a: a NOT LIKE 'SAM%'), ','), '') AS secondary_accession FROM x WHERE isolate_id IS NOT NULL OR len(accs) > 0)
"""


def _mapped(get):
    s = get("supplier")
    cells = s.sparkSession.sql(_MAPPED.format("{supplier}"), supplier=s)
    columns = F.array(*[F.struct(F.lit(i).alias("col_idx"), F.lit(n).alias("column_name"), F.lit(r).alias("role")) for i, (n, r) in enumerate((("Isolate", "local_id"), ("Sample", "public_accession"), ("Notes", "metadata")))])
    return cells, cells.select("sheet").distinct().select("sheet", F.inline(columns))


@query("metadata_map", f"WITH {_MAP_SQL} SELECT sheet, row_idx, isolate_id, accession, secondary_accession FROM mm")
def metadata_map(get):
    return metadata.metadata_map(*_mapped(get))


@query("metadata_discovery", f"""WITH {_MAP_SQL}, k AS (SELECT sheet, row_idx FROM m WHERE sheet <> 'm3' AND row_idx < 8),
c AS (SELECT sheet, bool_or(regexp_matches(coalesce(value, ''), 'SAMN[0-9]+|ERR[0-9]+|GCA_[0-9]+|CP[0-9]+')) AS candidate FROM m WHERE sheet <> 'm3' AND row_idx < 8 GROUP BY sheet),
n AS (SELECT sheet, count(*) AS n FROM mm GROUP BY sheet)
SELECT c.sheet, c.candidate, CASE WHEN c.candidate THEN n.n ELSE 0 END AS n_rows FROM c LEFT JOIN n ON c.sheet = n.sheet""")
def metadata_discovery(get):
    """The log of candidate sheets, one sheet already done; ids are among the records, or the id column is named for isolates."""
    cells, roles = _mapped(get)
    records = get("supplier").select(F.concat(F.lit("ISO-"), F.col("s_suppkey").cast("string")).alias("isolate_id"), F.lit(None).cast("string").alias("accession"))
    done = roles.where("sheet = 'm3'").select("sheet").distinct()
    return metadata.discover(cells, roles, records, done)[1]


@query("id_column_fallback", """SELECT concat('t', CAST(c_custkey AS VARCHAR)) AS sheet, CASE WHEN c_custkey % 3 = 0 THEN 'Strain' WHEN c_custkey % 3 = 1 THEN 'Number' ELSE 'Key' END AS id_column FROM customer""")
def id_column_fallback(get):
    """A named id, else the first column that is no drug's; an accession column is an id, too."""
    k = F.col("c_custkey")
    names = F.when(k % 3 == 0, F.array(*map(F.lit, ("Number", "Strain", "vancomycin")))).when(k % 3 == 1, F.array(*map(F.lit, ("vancomycin", "Number", "Ward")))).otherwise(F.array(*map(F.lit, ("Ward", "Key", "vancomycin"))))
    share = lambda hit: F.when(hit, 1.0).otherwise(0.0)
    rows = get("customer").select(F.concat(F.lit("t"), k.cast("string")).alias("sheet"), F.posexplode(names).alias("col_idx", "col_name"))
    profiles = rows.select("*", share(F.col("col_name") == "vancomycin").alias("mic_share"), F.lit(0.0).alias("sir_share"), share(F.col("col_name") == "Key").alias("accession_share"))
    return unpivot.primary_ids(sheets.column_roles(profiles).withColumnRenamed("col_name", "column_name")).select("sheet", "id_column")
