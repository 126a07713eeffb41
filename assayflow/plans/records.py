"""Queries of record operators: evaluation, quality control, consensus, enrichment, matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import normalize_id
from ..operators import enrich, ensemble, evaluate, match, qc
from .registry import query
from .scalars import _drug, _number_or_text, _sign, _sir

_V = r"""CASE WHEN regexp_full_match({0}, 'GC[AF]_\d+(\.\d+)?') THEN ['GCA_' || regexp_extract({0}, '_(.*)$', 1), 'GCF_' || regexp_extract({0}, '_(.*)$', 1), 'GCA_' || regexp_extract({0}, '_(\d+)', 1), 'GCF_' || regexp_extract({0}, '_(\d+)', 1)] ELSE [{0}] END"""
_SPLIT = r"unnest(regexp_split_to_array(upper(trim({0})), '[,;|\s]+'))"
COMPARE = rf"""
ea AS (SELECT DISTINCT acc, unnest({_V.format('a')}) AS v FROM (
  SELECT concat_ws('#', biosample_accession, assembly_accession, genbank_accessions, refseq_accessions, sra_accession, other_accessions) AS acc, {_SPLIT.format("concat_ws(',', biosample_accession, assembly_accession, genbank_accessions, refseq_accessions, sra_accession, other_accessions)")} AS a FROM extracted) WHERE a NOT IN ('', 'NONE')),
ta AS (SELECT DISTINCT genome_id, unnest({_V.format('a')}) AS v FROM (SELECT genome_id, {_SPLIT.format("concat_ws(',', \"genome.biosample_accession\", \"genome.assembly_accession\", \"genome.genbank_accessions\", \"genome.refseq_accessions\", \"genome.sra_accession\")")} AS a FROM truth WHERE genome_id <> '')),
h AS (SELECT ea.acc, count(DISTINCT genome_id) AS n, string_agg(DISTINCT genome_id, ',' ORDER BY genome_id) AS gs, string_agg(DISTINCT ea.v, ',' ORDER BY ea.v) AS vs FROM ea JOIN ta ON ea.v = ta.v GROUP BY ea.acc),
s AS (SELECT e.*, concat_ws('#', biosample_accession, assembly_accession, genbank_accessions, refseq_accessions, sra_accession, other_accessions) AS acc FROM extracted e),
m AS (SELECT s.*, CASE WHEN s.acc = '' THEN 'NO_ACCESSIONS' WHEN h.n IS NULL THEN 'NO_GENOME_MATCH' WHEN h.n > 1 THEN 'AMBIGUOUS:' || h.gs ELSE 'MATCHED' END AS genome_match_status,
  CASE WHEN h.n = 1 THEN h.gs ELSE '' END AS genome_id, CASE WHEN h.n = 1 THEN h.vs ELSE '' END AS matched_accessions, {_drug('s.drug')} AS normalized_drug FROM s LEFT JOIN h ON s.acc = h.acc),
tn AS (SELECT genome_id, {_drug('antibiotic')} AS d, nullif(trim(coalesce(resistant_phenotype, '')), '') AS raw, nullif({_sir('resistant_phenotype')}, '') AS sir,
  coalesce(nullif({_sign('measurement_sign')}, ''), '=') AS sg, nullif({_number_or_text('measurement_value')}, '') AS val FROM truth WHERE genome_id <> ''),
ts AS (SELECT genome_id AS tg, d, coalesce(string_agg(DISTINCT raw, ',' ORDER BY raw), '') AS t_raw, coalesce(string_agg(DISTINCT sir, ',' ORDER BY sir), '') AS t_sir,
  coalesce(string_agg(DISTINCT sg, ',' ORDER BY sg) FILTER (val IS NOT NULL), '') AS t_sign, coalesce(string_agg(DISTINCT val, ',' ORDER BY val), '') AS t_val,
  coalesce(list(DISTINCT sg || ' ' || val) FILTER (val IS NOT NULL), []) AS pairs, coalesce(list(DISTINCT sir) FILTER (sir IS NOT NULL), []) AS sirs FROM tn GROUP BY genome_id, d),
j AS (SELECT m.*, trim(coalesce(sir_call, '')) AS sir_raw, {_sir('sir_call')} AS sir, trim(coalesce(mic_sign, '')) AS sign_raw, CASE WHEN lower(trim(mic)) IN ('', 'nan', 'none', 'na', 'n/a', '-') THEN '' ELSE trim(mic) END AS mic_raw,
  {_number_or_text('mic')} AS val, {_sign('mic_sign')} AS sg0, ts.* FROM m LEFT JOIN ts ON m.genome_match_status = 'MATCHED' AND m.genome_id = ts.tg AND m.normalized_drug = ts.d),
k AS (SELECT *, CASE WHEN mic_raw <> '' AND sg0 = '' THEN '=' ELSE sg0 END AS sg FROM j),
c AS (SELECT extracted_row, pmid, isolate_id, drug, normalized_drug, genome_id, matched_accessions, genome_match_status, sir_raw AS extracted_sir_raw, sir AS extracted_sir,
  coalesce(t_raw, '') AS ground_truth_sir_raw, coalesce(t_sir, '') AS ground_truth_sir,
  CASE WHEN genome_match_status <> 'MATCHED' THEN 'NOT_EVALUATED' WHEN tg IS NULL THEN 'NO_GT_DRUG' WHEN sir_raw <> '' THEN CASE WHEN len(sirs) = 0 THEN 'NO_GT_VALUE' WHEN sir = '' THEN 'UNRECOGNIZED_CALL' WHEN list_contains(sirs, sir) THEN 'CORRECT' ELSE 'INCORRECT' END
    WHEN len(sirs) > 0 THEN 'MISSING_EXTRACTION' ELSE 'NOT_APPLICABLE' END AS sir_result,
  sign_raw AS extracted_mic_sign_raw, mic_raw AS extracted_mic_raw, sg AS extracted_mic_sign, val AS extracted_mic, coalesce(t_sign, '') AS ground_truth_mic_sign, coalesce(t_val, '') AS ground_truth_mic,
  CASE WHEN genome_match_status <> 'MATCHED' THEN 'NOT_EVALUATED' WHEN tg IS NULL THEN 'NO_GT_DRUG' WHEN val <> '' THEN CASE WHEN len(pairs) = 0 THEN 'NO_GT_VALUE' WHEN list_contains(pairs, sg || ' ' || val) THEN 'CORRECT' ELSE 'INCORRECT' END
    WHEN len(pairs) > 0 THEN 'MISSING_EXTRACTION' ELSE 'NOT_APPLICABLE' END AS mic_result FROM k)
"""
_REL = ("ast_long", "extracted", "truth")
_N = lambda x, name: f"count(*) FILTER ({x}) AS {name}"
COUNTS = ", ".join(
    ["count(*) AS n_rows", _N("genome_match_status = 'MATCHED'", "matched"), _N("genome_match_status = 'NO_GENOME_MATCH'", "no_match"), _N("genome_match_status = 'NO_ACCESSIONS'", "no_accessions"), _N("genome_match_status LIKE 'AMBIGUOUS%'", "ambiguous")]
    + [_N(f"sir_result = '{r}'", f"sir_{r.lower()}") for r in evaluate._SIR]
    + [_N(f"mic_result = '{r}'", f"mic_{r.lower()}") for r in evaluate._MIC]
)


def _metrics(columns: str, grouping: str) -> str:
    return f"""{COMPARE}, n AS (SELECT {columns} FROM c {grouping}),
o AS (SELECT *, sir_correct + sir_incorrect AS sir_compared, sir_correct + sir_incorrect + sir_missing_extraction + sir_unrecognized_call AS sir_available,
  sir_correct + sir_incorrect + sir_unrecognized_call + sir_no_gt_value AS sir_extracted, mic_correct + mic_incorrect AS mic_compared,
  mic_correct + mic_incorrect + mic_missing_extraction AS mic_available, mic_correct + mic_incorrect + mic_no_gt_value AS mic_extracted FROM n),
metrics AS (SELECT *, matched / nullif(n_rows, 0) AS match_rate, sir_correct / nullif(sir_compared, 0) AS sir_accuracy, sir_compared / nullif(sir_available, 0) AS sir_coverage,
  sir_correct / nullif(sir_available, 0) AS sir_overall, mic_correct / nullif(mic_compared, 0) AS mic_accuracy, mic_compared / nullif(mic_available, 0) AS mic_coverage, mic_correct / nullif(mic_available, 0) AS mic_overall FROM o)
"""


METRICS = _metrics(COUNTS, "")


def _compared(get):
    return evaluate.compare(get("extracted"), get("truth"))


@query("eval_metrics", f"WITH {METRICS} SELECT * FROM metrics", _REL)
def eval_metrics(get):
    return evaluate.metrics(_compared(get))


@query("eval_compare_rows", f"WITH {COMPARE} SELECT * FROM c", _REL)
def eval_compare_rows(get):
    return _compared(get)


@query("eval_status_counts", f"WITH {COMPARE} SELECT genome_match_status AS status, count(*) AS n FROM c GROUP BY 1", _REL)
def eval_status_counts(get):
    """Value counts, most frequent first."""
    return _compared(get).groupBy(F.col("genome_match_status").alias("status")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "status")


_LONG = " UNION ALL ".join(
    f"SELECT '{s}' AS \"Section\", '{m}' AS \"Metric\", " + (f"format('{{:.2f}}%', {c} * 100)" if p else f"CAST({c} AS VARCHAR)") + f' AS "Value" FROM metrics WHERE {c} IS NOT NULL' for s, m, c, p in evaluate.REPORT
)


@query("eval_metrics_long", f"WITH {METRICS} {_LONG}", _REL)
def eval_metrics_long(get):
    return evaluate.metrics_long(evaluate.metrics(_compared(get)))


@query("eval_rollup_by_paper", f"WITH {_metrics(f'pmid, {COUNTS}', 'GROUP BY ROLLUP (pmid)')} SELECT * FROM metrics", _REL)
def eval_rollup_by_paper(get):
    return evaluate.metrics_by_paper(_compared(get))


@query("eval_error_rows", f"WITH {COMPARE} SELECT * FROM c WHERE sir_result = 'INCORRECT' OR mic_result = 'INCORRECT'", _REL)
def eval_error_rows(get):
    return qc.incorrect_rows(_compared(get))


@query("eval_error_counts", f"WITH {COMPARE} SELECT count(*) AS n_rows, {_N("sir_result = 'INCORRECT'", 'sir_incorrect')}, {_N("mic_result = 'INCORRECT'", 'mic_incorrect')}, {_N("sir_result = 'INCORRECT' AND mic_result = 'INCORRECT'", 'both_incorrect')}, {_N("sir_result = 'INCORRECT' OR mic_result = 'INCORRECT'", 'any_incorrect')} FROM c", _REL)
def eval_error_counts(get):
    return qc.incorrect_counts(_compared(get))


@query("eval_report_parsed", f"WITH {METRICS} {_LONG}", _REL)
def eval_report_parsed(get):
    """The long metrics written as a text report and read back from it."""
    long = evaluate.metrics_long(evaluate.metrics(_compared(get)))
    sections = list(dict.fromkeys(r[0] for r in evaluate.REPORT))
    order = {(s, m): i for i, (s, m, _, _) in enumerate(evaluate.REPORT)}
    number = F.create_map(*[F.lit(x) for (s, m), i in order.items() for x in (f"{s}|{m}", 10 * (i + sections.index(s) + 1) + 5)])
    body = long.select(F.try_element_at(number, F.concat_ws("|", "Section", "Metric")).alias("line_no"), F.concat(F.rpad("Metric", 40, " "), F.lit(": "), "Value").alias("line"), "Section")
    first = body.groupBy("Section").agg(F.min("line_no").alias("at"))
    heads = first.select(F.explode(F.array(*[F.struct((F.col("at") - 4 + i).alias("line_no"), t.alias("line")) for i, t in enumerate((F.lit("=" * 60), F.col("Section"), F.lit("=" * 60)))])).alias("h")).select("h.*")
    text = body.select("line_no", F.regexp_replace("line", r"\s+:", ":").alias("line")).unionByName(heads)
    return evaluate.parse_report(text.withColumn("path", F.lit("report"))).select("Section", "Metric", "Value")


@query("genome_match", f"WITH {COMPARE} SELECT extracted_row, genome_match_status, genome_id AS matched_genome, matched_accessions FROM m", _REL)
def genome_match(get):
    return evaluate.match_genomes(get("extracted"), get("truth")).select("extracted_row", "genome_match_status", "matched_genome", "matched_accessions")


@query("truth_sets", f"WITH {COMPARE} SELECT tg AS t_genome, d AS t_drug, t_raw, t_sir, t_val FROM ts WHERE d <> ''", _REL)
def truth_sets(get):
    join = lambda x: F.array_join(x, ",")
    return evaluate.truth_sets(get("truth")).select("t_genome", "t_drug", join("t_raw").alias("t_raw"), join("t_sir").alias("t_sir"), join(F.array_sort(F.array_distinct(F.transform("t_mic", lambda m: m["value"])))).alias("t_val"))


@query("truth_counts", f"WITH {COMPARE} SELECT (SELECT count(DISTINCT genome_id) FROM truth) AS genomes, (SELECT count(DISTINCT v) FROM ta) AS accession_keys, (SELECT count(*) FROM truth) AS n_rows", _REL)
def truth_counts(get):
    t = get("truth")
    keys = evaluate.truth_index(t).agg(F.count_distinct("acc").alias("accession_keys"))
    return t.agg(F.count_distinct("genome_id").alias("genomes"), F.count(F.lit(1)).alias("n_rows")).join(F.broadcast(keys))


_B = lambda c: f"({c} IS NULL OR lower(trim({c})) IN ('', 'none', 'nan', 'null'))"
QC = f"""
q AS (SELECT *, list_filter([
  CASE WHEN {_B('drug')} THEN 'missing drug' END, CASE WHEN {_B('isolate_id')} AND {_B('accession')} THEN 'missing identifier' END,
  CASE WHEN NOT {_B('sir_call')} AND upper(trim(sir_call)) NOT IN ('S', 'I', 'R', 'SDD', 'NS') THEN 'invalid sir_call ' || sir_call END,
  CASE WHEN {_B('sir_call')} AND ({_B('mic')} OR {_B('mic_sign')}) THEN 'missing measurement and call' END,
  CASE WHEN NOT {_B('mic_sign')} AND trim(mic_sign) NOT IN ('=', '>', '>=', '<', '<=') THEN 'invalid mic_sign ' || mic_sign END,
  CASE WHEN NOT {_B('mic')} AND NOT regexp_full_match(trim(mic), '\\d+(\\.\\d+)?(/\\d+(\\.\\d+)?)*') THEN 'non-numeric mic ' || mic END], lambda e: e IS NOT NULL) AS errors FROM ast_long)
"""


@query("qc_valid", f"WITH {QC} SELECT * EXCLUDE (errors) FROM q WHERE len(errors) = 0", ("ast_long",))
def qc_valid(get):
    return qc.split(get("ast_long"))[0]


@query("qc_quarantine", f"WITH {QC} SELECT * EXCLUDE (errors), array_to_string(errors, '; ') AS errors FROM q WHERE len(errors) > 0", ("ast_long",))
def qc_quarantine(get):
    return qc.split(get("ast_long"))[1].withColumn("errors", F.array_join("errors", "; "))


@query("qc_errors", f"WITH {QC} SELECT extracted_row, CAST(generate_subscripts(errors, 1) - 1 AS INTEGER) AS error_no, unnest(errors) AS error FROM q", ("ast_long",))
def qc_errors(get):
    return qc.errors(get("ast_long")).select("extracted_row", "error_no", "error")


@query("qc_counts", f"WITH {QC}, x AS (SELECT unnest(errors) AS error FROM q) SELECT error, count(*) AS n FROM x GROUP BY error", ("ast_long",))
def qc_counts(get):
    return qc.errors(get("ast_long")).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query("qc_first_errors", f"WITH {QC} SELECT extracted_row, array_to_string(errors[1:2], '; ') AS first_errors FROM q WHERE len(errors) > 0", ("ast_long",))
def qc_first_errors(get):
    """The first two messages of each rejected record, as a retry would be told."""
    return qc.split(get("ast_long"))[1].select("extracted_row", F.array_join(F.slice("errors", 1, 2), "; ").alias("first_errors"))


@query("drop_empty_measurements", "SELECT extracted_row, mic, sir_call FROM (SELECT extracted_row, nullif(mic, '') AS mic, sir_call FROM ast_long) WHERE mic IS NOT NULL OR sir_call IS NOT NULL", ("ast_long",))
def drop_empty_measurements(get):
    return qc.drop_empty(get("ast_long").select("extracted_row", F.nullif("mic", F.lit("")).alias("mic"), "sir_call"))


@query("header_pollution_guard", """SELECT sheet, row_idx, value FROM cells WHERE col_idx = 0 AND (value IS NULL OR NOT (lower(trim(value)) IN ('isolate id', 'isolate', 'sample') OR contains(lower(value), 'range measured') OR contains(lower(value), 'cutoff')))""", ("cells",))
def header_pollution_guard(get):
    return qc.drop_header_rows(get("cells").where("col_idx = 0"), "value", "Isolate ID").select("sheet", "row_idx", "value")


_ORDER = ["pass_no", "extracted_row", "mic_order", "sign_order", "notes_order"]
_ENS = """
e AS (SELECT *, CASE WHEN trim(isolate_id) = '' THEN accession ELSE trim(isolate_id) END AS k_id, nullif(trim(drug), '') AS k_drug FROM ast_long),
f AS (SELECT *, CASE WHEN mic = '1e400' THEN 'inf' WHEN regexp_full_match(mic, '\\d+(\\.\\d+)?') THEN format('{:.6g}', CAST(mic AS DOUBLE)) ELSE nullif(mic, '') END AS m FROM e WHERE k_id IS NOT NULL AND k_drug IS NOT NULL),
w AS (SELECT pmid || ' ' || k_id AS k_id, k_drug, string_agg(DISTINCT mic_sign, ',' ORDER BY mic_sign) AS signs, count(DISTINCT mic_sign) AS ns, string_agg(DISTINCT m, ',' ORDER BY m) AS mics, count(DISTINCT m) AS nm,
  string_agg(DISTINCT upper(sir_call), ',' ORDER BY upper(sir_call)) AS calls, count(DISTINCT upper(sir_call)) AS nc, count(*) AS n_records, min(CASE WHEN accession LIKE 'SAMN%' THEN accession END) AS sam,
  min(CASE WHEN accession LIKE 'ERR%' THEN split_part(accession, ';', 1) || ',' || split_part(accession, '; ', 2) END) AS err FROM f GROUP BY pmid || ' ' || k_id, k_drug)
"""


def _passes(get):
    """Records of one paper, isolate and drug as passes; the id is made unique per paper."""
    a = get("ast_long")
    unique = F.when(F.trim("isolate_id") != "", F.concat_ws(" ", "pmid", F.trim("isolate_id"))).otherwise(F.lit(None))
    fallback = F.when(unique.isNull() & F.col("accession").isNotNull(), F.concat_ws(" ", "pmid", "accession"))
    return a.withColumns({"isolate_id": F.coalesce(unique, fallback), "mic_order": F.col("mic"), "sign_order": F.col("mic_sign"), "notes_order": F.coalesce("notes", F.lit(""))})


@query("ensemble_consensus", f"WITH {_ENS} SELECT k_id, k_drug, coalesce(sam, err) AS accession, signs AS mic_sign, coalesce(mics, '') AS mic, calls AS sir_call FROM w WHERE ns < 2 AND nm < 2 AND nc < 2", ("ast_long",))
def ensemble_consensus(get):
    kept, _ = ensemble.consensus(_passes(get), _ORDER)
    return kept.select("k_id", "k_drug", "accession", "mic_sign", "mic", "sir_call")


@query("ensemble_conflicts", f"""WITH {_ENS} SELECT k_id, k_drug, concat_ws('; ', CASE WHEN ns > 1 THEN 'conflicting mic_sign: ' || signs END, CASE WHEN nm > 1 THEN 'conflicting mic: ' || mics END,
  CASE WHEN nc > 1 THEN 'conflicting sir_call: ' || calls END) AS reason, n_records FROM w WHERE ns > 1 OR nm > 1 OR nc > 1""", ("ast_long",))
def ensemble_conflicts(get):
    return ensemble.consensus(_passes(get), _ORDER)[1]


_META = """
mt AS (SELECT isolate_id AS iso, accession AS a, secondary_accession AS b FROM meta),
mi AS (SELECT iso, list_sort(list_distinct(flatten(list([a, b])))) AS accs FROM mt GROUP BY iso),
ml AS (SELECT iso, list_filter(accs, lambda x: x <> 'none') AS accs FROM mi WHERE len(list_filter(accs, lambda x: x <> 'none')) > 0),
mk AS (SELECT token, list_sort(list_distinct(flatten(list(accs)))) AS accs FROM (SELECT unnest(list_filter([a, b], lambda x: x <> 'none')) AS token, list_filter([a, b], lambda x: x <> 'none') AS accs FROM mt) GROUP BY token),
r AS (SELECT DISTINCT isolate_id, accession FROM ast_long),
rt AS (SELECT accession, unnest(string_split(accession, '; ')) AS token FROM (SELECT DISTINCT accession FROM r WHERE accession IS NOT NULL)),
rk AS (SELECT rt.accession, flatten(list(mk.accs)) AS accs FROM rt JOIN mk ON rt.token = mk.token GROUP BY rt.accession),
x AS (SELECT r.isolate_id, r.accession, ml.accs IS NOT NULL AS by_iso, coalesce(ml.accs, rk.accs) AS found, string_split(r.accession, '; ') AS cur
  FROM r LEFT JOIN ml ON trim(r.isolate_id) = ml.iso LEFT JOIN rk ON r.accession = rk.accession),
y AS (SELECT isolate_id, accession AS was, by_iso, found, list_distinct(list_concat(coalesce(cur, []), coalesce(found, []))) AS al FROM x),
z AS (SELECT isolate_id, was, by_iso, found, CASE WHEN len(al) > 0 THEN array_to_string(list_concat(list_sort(list_filter(al, lambda t: t LIKE 'SAM%')), list_sort(list_filter(al, lambda t: t NOT LIKE 'SAM%'))), ',') END AS accession FROM y)
"""


def _distinct_pairs(get):
    return get("ast_long").select("isolate_id", "accession").distinct().withColumn("notes", F.lit(None).cast("string"))


@query("enrich_by_isolate", f"WITH {_META} SELECT isolate_id, was, accession FROM z WHERE by_iso", ("ast_long", "meta"))
def enrich_by_isolate(get):
    by_isolate, _ = enrich.metadata_index(get("meta"))
    rows = _distinct_pairs(get).join(by_isolate, F.trim("isolate_id") == F.col("iso"), "left_semi").withColumn("was", F.col("accession"))
    return enrich.enrich(rows, get("meta")).select("isolate_id", "was", "accession")


@query("enrich_by_token", f"WITH {_META} SELECT isolate_id, was, accession FROM z WHERE NOT by_iso AND found IS NOT NULL", ("ast_long", "meta"))
def enrich_by_token(get):
    by_isolate, by_token = enrich.metadata_index(get("meta"))
    rows = _distinct_pairs(get).join(by_isolate, F.trim("isolate_id") == F.col("iso"), "left_anti").withColumn("was", F.col("accession"))
    found = enrich.match_tokens(rows, by_isolate, by_token)
    return enrich.enrich(rows.join(found, F.col("accession") == F.col("acc_text"), "left_semi"), get("meta")).select("isolate_id", "was", "accession")


@query("enrich_notes", f"""WITH {_META} SELECT isolate_id, was, accession,
  CASE WHEN found IS NOT NULL AND was IS NOT NULL AND was NOT LIKE 'SAM%' AND accession LIKE '%SAM%' THEN 'original accession: ' || was END AS notes FROM z""", ("ast_long", "meta"))
def enrich_notes(get):
    return enrich.enrich(_distinct_pairs(get).withColumn("was", F.col("accession")), get("meta")).select("isolate_id", "was", "accession", "notes")


@query("needs_enrichment", "SELECT bool_or(NOT coalesce(regexp_matches(accession, '(^|[,; ])SAM(N|EA?|D)\\d'), FALSE)) AS needed FROM ast_long", ("ast_long",))
def needs_enrichment(get):
    return enrich.needs_enrichment(get("ast_long"))


@query("finalize_records", """SELECT pmid, file_name, sheet_name, isolate_id, CAST(NULL AS VARCHAR) AS bioproject_accession, CASE WHEN accession LIKE 'SAMN%' THEN accession END AS biosample_accession,
  CASE WHEN accession LIKE 'ERR%' THEN split_part(accession, '; ', 2) END AS assembly_accession, CAST(NULL AS VARCHAR) AS genbank_accessions, CAST(NULL AS VARCHAR) AS refseq_accessions,
  CASE WHEN accession LIKE 'ERR%' THEN split_part(accession, ';', 1) END AS sra_accession, CAST(NULL AS VARCHAR) AS other_accessions, drug, mic_sign, mic, sir_call, notes FROM ast_long""", ("ast_long",))
def finalize_records(get):
    return enrich.finalize(get("ast_long"), F.concat(F.lit("/data/"), "file_name"), F.col("sheet_name"), F.col("pmid"))


MATCH = r"""
k AS (SELECT lower(regexp_replace(trim(strain), '\s+', ' ', 'g')) AS key, arg_min(strain, ordinal) AS strain, arg_min(bioproject_accession, ordinal) AS bp, arg_min(biosample_accession, ordinal) AS bs, arg_min(sra_accession, ordinal) AS sra, min(ordinal) AS ordinal FROM strains GROUP BY 1),
i AS (SELECT *, lower(regexp_replace(trim(isolate_id), '\s+', ' ', 'g')) AS key FROM isolates),
d AS (SELECT DISTINCT key FROM i WHERE key NOT IN (SELECT key FROM k)),
f AS (SELECT d.key, arg_min(k.strain, k.ordinal) AS strain, arg_min(k.bp, k.ordinal) AS bp, arg_min(k.bs, k.ordinal) AS bs, arg_min(k.sra, k.ordinal) AS sra FROM d JOIN k ON (contains(k.key, d.key) OR contains(d.key, k.key)) AND length(d.key) >= 3 AND length(k.key) >= 3 GROUP BY d.key),
a AS (SELECT i.pmid, i.source_file, i.isolate_id, CASE WHEN k.key IS NOT NULL THEN 'exact' WHEN f.key IS NOT NULL THEN 'fuzzy' ELSE 'no_match' END AS match_type, coalesce(k.strain, f.strain, '') AS matched_strain,
  coalesce(k.bp, f.bp, '') AS bioproject_accession, coalesce(k.bs, f.bs, '') AS biosample_accession, coalesce(k.sra, f.sra, '') AS sra_accession FROM i LEFT JOIN k ON i.key = k.key LEFT JOIN f ON i.key = f.key)
"""
_MREL = ("isolates", "strains")


@query("strain_match_all", f"WITH {MATCH} SELECT * FROM a", _MREL)
def strain_match_all(get):
    return match.match_all(get("isolates"), get("strains"))


@query("strain_match_exact", f"WITH {MATCH} SELECT pmid, source_file, isolate_id, matched_strain, biosample_accession FROM a WHERE match_type = 'exact'", _MREL)
def strain_match_exact(get):
    return match.match_exact(get("isolates"), get("strains")).select("pmid", "source_file", "isolate_id", F.col("strain").alias("matched_strain"), "biosample_accession")


@query("strain_match_fuzzy", f"WITH {MATCH} SELECT key, strain AS matched_strain FROM f", _MREL)
def strain_match_fuzzy(get):
    """The join on the rarest gram."""
    known = match.first_by_strain(get("strains"))
    keys = get("isolates").select(normalize_id(F.col("isolate_id")).alias("key")).distinct().join(known.select("key"), "key", "left_anti")
    return match.match_fuzzy(keys, known).select("key", F.col("strain").alias("matched_strain"))


@query("strain_match_counts", f"WITH {MATCH} SELECT pmid, match_type, count(*) AS n FROM a GROUP BY 1, 2", _MREL)
def strain_match_counts(get):
    return match.match_all(get("isolates"), get("strains")).groupBy("pmid", "match_type").agg(F.count(F.lit(1)).alias("n"))


@query("fill_blank_accessions", f"""WITH {MATCH}, e AS (SELECT source_file, lower(regexp_replace(trim(isolate_id), '\\s+', ' ', 'g')) AS key, max(bioproject_accession) AS bp, max(biosample_accession) AS bs, max(sra_accession) AS sra FROM a WHERE match_type = 'exact' GROUP BY 1, 2)
SELECT i.source_file AS file_name, i.isolate_id, i.pmid, CASE WHEN i.pmid = 'pm1' THEN 'PRJKEPT' ELSE coalesce(nullif(e.bp, ''), ' ') END AS bioproject_accession, coalesce(nullif(e.bs, ''), '') AS biosample_accession, coalesce(nullif(e.sra, ''), NULL) AS sra_accession
FROM i LEFT JOIN e ON i.source_file = e.source_file AND i.key = e.key""", _MREL)
def fill_blank_accessions(get):
    isolates = get("isolates")
    matches = match.match_all(isolates, get("strains")).withColumn("ordinal", F.lit(1))
    records = isolates.select(F.col("source_file").alias("file_name"), "isolate_id", "pmid", F.when(F.col("pmid") == "pm1", "PRJKEPT").otherwise(" ").alias("bioproject_accession"), F.lit("").alias("biosample_accession"), F.lit(None).cast("string").alias("sra_accession"))
    return match.fill_blanks(records, matches)


_BP = "CASE o_orderkey % 3 WHEN 0 THEN concat('PRJNA', CAST(o_custkey AS VARCHAR(20)), ';PRJEB1') ELSE '' END"
_DA = "CASE o_orderkey % 4 WHEN 0 THEN concat('PRJDB', CAST(o_custkey AS VARCHAR(20)), '; SAMN1;PRJX2') WHEN 1 THEN 'PRJNA9;PRJNA10' END"


@query("bioproject_fallback", f"""WITH p AS (SELECT o_orderkey AS pmid, {_BP} AS a, {_DA} AS b FROM orders), l AS (SELECT pmid, list_filter(string_split(a, ';'), lambda x: x <> '') AS a,
  list_filter(list_transform(string_split(coalesce(b, ''), ';'), lambda x: trim(x)), lambda x: regexp_full_match(x, 'PRJ(NA|EB|DB)\\d+')) AS b FROM p)
SELECT pmid, array_to_string(list_sort(list_distinct(CASE WHEN len(a) > 0 THEN a ELSE b END)), ';') AS bioprojects FROM l""")
def bioproject_fallback(get):
    o = get("orders").select(F.col("o_orderkey").alias("pmid"), F.expr(_BP).alias("bioproject_accessions"), F.expr(_DA).alias("data_availability_accessions"))
    return match.project_accessions(o)


@query("biosample_chain", """SELECT 'PRJNA' || CAST(c_nationkey AS VARCHAR) AS bioproject_accession, CAST(c_custkey AS VARCHAR) AS biosample_uid, 'SAMN' || CAST(c_custkey AS VARCHAR) AS biosample_accession,
  CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN 'T' || CAST(c_custkey AS VARCHAR) ELSE 'Whole title' END AS strain, CASE WHEN c_custkey % 2 = 0 THEN 'SRS' || CAST(c_custkey AS VARCHAR) ELSE '' END AS sra_accession FROM customer""")
def biosample_chain(get):
    c = get("customer").withColumn("uid", F.col("c_custkey").cast("string"))
    project = F.concat(F.lit("PRJNA"), F.col("c_nationkey").cast("string"))
    projects = c.select(project.alias("bioproject_accession")).distinct()
    links = c.select(project.alias("bioproject_accession"), F.col("uid").alias("biosample_uid"))
    summaries = c.select(
        F.col("uid").alias("biosample_uid"), F.concat(F.lit("SAMN"), "uid").alias("biosample_accession"),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("x; strain: "), "c_name", F.lit("; y"))).otherwise("").alias("sample_data"),
        F.when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("Genus str. T"), "uid", F.lit(" "))).otherwise("Whole title").alias("title"),
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("BioSample: 1; SRA: SRS"), "uid")).otherwise("none").alias("identifiers"),
    )
    return match.samples_of_projects(projects, links, summaries)
