"""Queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import accession as A
from ..functions import text as X
from .registry import query

_T = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def _clean(c: str) -> str:
    t = _T.format(c)
    return f"CASE WHEN {c} IS NULL OR lower({t}) IN ('', 'nan', 'none', 'na', 'n/a', '-') THEN '' ELSE {t} END"


NUM = r"'^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$|^[+-]?([iI][nN][fF]|[iI]nfinity)$'"


def _number(s: str, digits: int) -> str:
    return (
        f"CASE WHEN isinf(CAST({s} AS DOUBLE)) THEN CASE WHEN CAST({s} AS DOUBLE) < 0 THEN '-inf' ELSE 'inf' END WHEN abs(CAST({s} AS DOUBLE)) >= 2.0**124 THEN CAST(CAST({s} AS DOUBLE) AS VARCHAR) "
        f"WHEN CAST({s} AS DOUBLE) = floor(CAST({s} AS DOUBLE)) THEN CAST(CAST(CAST({s} AS DOUBLE) AS HUGEINT) AS VARCHAR) "
        f"ELSE format('{{:.{digits}g}}', CAST({s} AS DOUBLE)) END"
    )


def _number_or_text(c: str) -> str:
    s = f"({_clean(c)})"
    return f"CASE WHEN regexp_full_match({s}, {NUM}) THEN {_number(s, 12)} ELSE lower({s}) END"


def _sign(c: str) -> str:
    s = f"replace(replace(({_clean(c)}), '≤', '<='), '≥', '>=')"
    return f"CASE WHEN {s} IN ('=', '==') THEN '=' WHEN {s} IN ('<', '<=', '>', '>=') THEN {s} ELSE '' END"


def _sir(c: str) -> str:
    s = rf"regexp_replace(lower({_clean(c)}), '\s+', ' ', 'g')"
    return (
        f"CASE WHEN {s} IN ('s', 'susceptible', 'susceptibility') THEN 'S' WHEN {s} IN ('i', 'intermediate') THEN 'I' WHEN {s} IN ('r', 'resistant', 'resistance') THEN 'R' "
        f"WHEN regexp_full_match({s}, 'ns|non[- ]?susceptib(le|ility)') THEN 'NS' WHEN regexp_full_match({s}, 'nr|non[- ]?resistan(t|ce)') THEN 'NR' ELSE '' END"
    )


def _drug(c: str) -> str:
    s = rf"regexp_replace(lower({_clean(c)}), '\s+', ' ', 'g')"
    return f"CASE WHEN {s} = 'rifampicin' THEN 'rifampin' WHEN regexp_full_match({s}, 'co-?trimoxazole|trimethoprim[- ]sulfamethoxazole') THEN 'trimethoprim/sulfamethoxazole' ELSE {s} END"


@query("mic_parse", r"""
SELECT k, CASE WHEN m <> '' THEN coalesce(nullif(regexp_extract(t, '^\s*(<=|>=|<|>|=)?', 1), ''), '=') END AS operator, CASE WHEN m <> '' THEN regexp_replace(m, '\s*/\s*', '/', 'g') END AS value
FROM (SELECT k, t, CASE WHEN lower(t) IN ('s','r','i','susceptible','resistant','intermediate','nd','na','n/a','none','null','-','') THEN ''
  ELSE regexp_extract(t, '^(<=|>=|<|>|=)?\s*(\d+(?:\.\d+)?(?:\s*/\s*\d+(?:\.\d+)?)*)$', 2) END AS m
  FROM (SELECT k, trim(v) AS t FROM measures))""", ("measures",))
def mic_parse(get):
    return get("measures").select("k", X.parse_mic(F.col("v")).alias("m")).select("k", "m.operator", "m.value")


@query("mic_sign_norm", f"SELECT k, {_sign('sign')} AS sign FROM measures", ("measures",))
def mic_sign_norm(get):
    return get("measures").select("k", X.normalize_sign(F.col("sign")).alias("sign"))


@query("mic_number_norm", f"SELECT k, {_number_or_text('v')} AS value FROM measures", ("measures",))
def mic_number_norm(get):
    return get("measures").select("k", X.normalize_number(F.col("v")).alias("value"))


@query("mic_ratio_norm", rf"""
SELECT k, CASE WHEN lower(t) IN ('', 'none', 'nan', 'null') THEN NULL
  WHEN list_bool_and(list_transform(string_split(t, '/'), lambda p: regexp_full_match(trim(p), {NUM})))
    THEN array_to_string(list_transform(string_split(t, '/'), lambda p: {_number('TRY_CAST(trim(p) AS DOUBLE)', 6)}), '/') ELSE t END AS value
FROM (SELECT k, trim(v) AS t FROM measures)""", ("measures",))
def mic_ratio_norm(get):
    return get("measures").select("k", X.normalize_mic(F.col("v")).alias("value"))


@query("sir_norm", f"SELECT k, {_sir('call')} AS sir FROM measures", ("measures",))
def sir_norm(get):
    return get("measures").select("k", X.normalize_sir(F.col("call")).alias("sir"))


@query("drug_norm", f"SELECT k, {_drug('drug')} AS drug FROM measures", ("measures",))
def drug_norm(get):
    return get("measures").select("k", X.normalize_drug(F.col("drug")).alias("drug"))


@query("null_tokens", """
SELECT lower(trim(v)) IN ('', 'none', 'nan', 'null') OR v IS NULL AS blank, lower(trim(v)) IN ('', 'nan', 'none', 'na', 'n/a', '-') OR v IS NULL AS scorer_blank, count(*) AS n
FROM (SELECT v FROM measures UNION ALL SELECT drug FROM measures UNION ALL SELECT call FROM measures) GROUP BY 1, 2""", ("measures",))
def null_tokens(get):
    m = get("measures")
    v = m.select("v").unionAll(m.select("drug")).unionAll(m.select("call"))
    return v.groupBy(X.is_blank(F.col("v")).alias("blank"), (X.scorer_clean(F.col("v")) == "").alias("scorer_blank")).agg(F.count(F.lit(1)).alias("n"))


TOKENS_SQL = r"""
t AS (SELECT k, acc, CASE WHEN acc IS NULL OR lower(trim(acc)) IN ('', 'none', 'nan', 'null', '-') THEN CAST([] AS VARCHAR[])
  ELSE list_filter(list_transform(regexp_split_to_array(trim(acc), '[,;\s]+'), lambda p: trim(p, '''"')), lambda p: lower(p) NOT IN ('', 'none', 'nan', 'null', '-')) END AS w FROM tokens),
u AS (SELECT k, unnest(w) AS tok, generate_subscripts(w, 1) AS pos FROM t),
d AS (SELECT k, upper(tok) AS up, arg_min(tok, pos) AS tok, min(pos) AS pos FROM u GROUP BY k, upper(tok))
"""
KIND_SQL = r"""CASE WHEN regexp_full_match(up, 'PRJ(NA|EB|DB)?[A-Z]?\d+') THEN 'bioproject' WHEN regexp_full_match(up, 'SAM(N|EA?|D)\d+(\.\d+)?') THEN 'biosample'
  WHEN regexp_full_match(up, 'GC[AF]_\d+(\.\d+)?') THEN 'assembly' WHEN regexp_full_match(up, '(NZ_|NC_|NM_|NR_|NP_|XM_|XR_|XP_)[A-Z]{2,6}_?\d+(\.\d+)?') THEN 'refseq'
  WHEN regexp_full_match(up, '[SED]R[RAXPXZS]\d+') THEN 'sra' WHEN regexp_full_match(up, '([A-Z]{1,2}\d{5,6}|[A-Z]{4,6}\d{2}\d{6,8}|[A-Z]{4,6}\d{6,8})(\.\d+)?') THEN 'genbank' ELSE 'other' END"""


@query("accession_tokens", f"WITH {TOKENS_SQL} SELECT k, CAST(len(w) AS INTEGER) AS n, array_to_string(w, '|') AS toks FROM t", ("tokens",))
def accession_tokens(get):
    t = A.tokens(F.col("acc"))
    return get("tokens").select("k", F.size(t).alias("n"), F.array_join(t, "|").alias("toks"))


@query("accession_format", f"""WITH {TOKENS_SQL}, g AS (SELECT k, string_agg(tok, ',' ORDER BY CASE WHEN {KIND_SQL} = 'biosample' THEN 0 ELSE 1 END, tok) AS accs FROM d GROUP BY k)
SELECT tokens.k, g.accs FROM tokens LEFT JOIN g ON tokens.k = g.k""", ("tokens",))
def accession_format(get):
    return get("tokens").select("k", A.format_combined(A.tokens(F.col("acc"))).alias("accs"))


@query("accession_split_typed", f"""WITH {TOKENS_SQL}, e AS (SELECT k, tok, {KIND_SQL} AS kind FROM d)
SELECT tokens.k, {', '.join(f"string_agg(e.tok, ',' ORDER BY e.tok) FILTER (e.kind = '{n.split('_')[0]}') AS {n}" for n in A.TYPED_COLUMNS)}
FROM tokens LEFT JOIN e ON tokens.k = e.k GROUP BY tokens.k""", ("tokens",))
def accession_split_typed(get):
    return get("tokens").select("k", A.typed_split(F.col("acc")).alias("s")).select("k", "s.*")


VARIANTS_SQL = r"""
p AS (SELECT DISTINCT k, upper(trim(p)) AS a FROM (SELECT k, unnest(regexp_split_to_array(CASE WHEN acc IS NULL OR lower(trim(acc)) IN ('', 'nan', 'none', 'na', 'n/a', '-') THEN '' ELSE trim(acc) END, '[,;|\s]+')) AS p FROM tokens)
  WHERE lower(trim(p)) NOT IN ('', 'nan', 'none', 'na', 'n/a', '-')),
v AS (SELECT k, a FROM p UNION SELECT k, unnest([regexp_extract(a, '^(GC[AF]_\d+)', 1), 'GCA_' || regexp_extract(a, '^GC[AF]_(.*)$', 1), 'GCF_' || regexp_extract(a, '^GC[AF]_(.*)$', 1),
  'GCA_' || regexp_extract(a, '^GC[AF]_(\d+)', 1), 'GCF_' || regexp_extract(a, '^GC[AF]_(\d+)', 1)]) FROM p WHERE regexp_full_match(a, 'GC[AF]_\d+(\.\d+)?'))
"""


@query("accession_variants", f"WITH {VARIANTS_SQL} SELECT tokens.k, coalesce(string_agg(v.a, ',' ORDER BY v.a), '') AS variants FROM tokens LEFT JOIN v ON tokens.k = v.k GROUP BY tokens.k", ("tokens",))
def accession_variants(get):
    return get("tokens").select("k", F.array_join(F.array_sort(A.split_variants(F.col("acc"))), ",").alias("variants"))


@query("accession_type", """
SELECT k, CASE WHEN coalesce(acc, '') = '' THEN NULL WHEN regexp_matches(u, '^(SAMN|SAME|SRS)') THEN 'BioSample' WHEN regexp_matches(u, '^PRJ[NE]') THEN 'BioProject'
  WHEN regexp_matches(u, '^[SED]RR') THEN 'SRA_Run' WHEN regexp_matches(u, '^[SED]RX') THEN 'SRA_Experiment' ELSE 'Accession' END AS kind
FROM (SELECT k, acc, upper(trim(acc)) AS u FROM tokens)""", ("tokens",))
def accession_type(get):
    return get("tokens").select("k", A.accession_type(F.col("acc")).alias("kind"))


@query("biosample_flag", f"WITH {TOKENS_SQL} SELECT tokens.k, coalesce(bool_or({KIND_SQL} = 'biosample'), FALSE) AS has FROM tokens LEFT JOIN d ON tokens.k = d.k GROUP BY tokens.k", ("tokens",))
def biosample_flag(get):
    return get("tokens").select("k", A.has_biosample(F.col("acc")).alias("has"))


_PATHS = "concat('/tmp/papers/', CASE WHEN o_orderkey % 3 = 0 THEN concat('pmid_', CAST(20000000 + o_orderkey AS VARCHAR(20))) WHEN o_orderkey % 3 = 1 THEN CAST(3000000 + o_orderkey AS VARCHAR(20)) ELSE 'none' END, '/t.xlsx')"


@query("pmid_from_path", f"""
SELECT o_orderkey AS k, nullif(regexp_extract(p, '\\b(\\d{{7,8}})\\b', 1), '') AS strict_pmid,
  coalesce(nullif(regexp_extract(p, '(?:^|[^0-9])([0-9]{{7,9}})(?:[^0-9]|$)', 1), ''), 'UNKNOWN') AS loose_pmid FROM (SELECT o_orderkey, {_PATHS} AS p FROM orders)""")
def pmid_from_path(get):
    o = get("orders").select(F.col("o_orderkey").alias("k"), F.expr(_PATHS).alias("p"))
    return o.select("k", X.pmid_of_path(F.col("p")).alias("strict_pmid"), X.pmid_in_path(F.col("p")).alias("loose_pmid"))


@query("id_norm", r"SELECT ordinal, lower(regexp_replace(trim('  ' || upper(strain) || '   X '), '\s+', ' ', 'g')) AS id FROM strains", ("strains",))
def id_norm(get):
    return get("strains").select("ordinal", X.normalize_id(F.concat(F.lit("  "), F.upper("strain"), F.lit("   X "))).alias("id"))


@query("numeric_id_repair", r"SELECT p_partkey AS k, regexp_replace(CAST(p_retailprice AS VARCHAR), '^(\d+)\.0$', '\1') AS id FROM (SELECT p_partkey, CAST(round(p_retailprice, 1) AS DECIMAL(18,1)) AS p_retailprice FROM part)")
def numeric_id_repair(get):
    return get("part").select(F.col("p_partkey").alias("k"), X.repair_numeric_id(F.round("p_retailprice", 1).cast("decimal(18,1)").cast("string")).alias("id"))


@query("filename_sanitize", r"""SELECT p_partkey AS k, coalesce(nullif(regexp_replace(regexp_replace('(' || p_name || ') é/' || p_brand || '!', '[^A-Za-z0-9_.-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'table') AS name FROM part""")
def filename_sanitize(get):
    return get("part").select(F.col("p_partkey").alias("k"), X.safe_file_name(F.concat(F.lit("("), "p_name", F.lit(") é/"), "p_brand", F.lit("!"))).alias("name"))


@query("json_projection", """SELECT event_id, CAST(json_extract(j, '$.k') AS BIGINT) AS k FROM (SELECT event_id, CAST(props AS JSON) AS j FROM events)""")
def json_projection(get):
    fenced = F.concat(F.lit("```json\n"), "props", F.lit("\n```"))
    return get("events").select("event_id", F.from_json(X.strip_fence(fenced), "k bigint").alias("j")).select("event_id", "j.k")


@query("publication_year", r"SELECT o_orderkey AS k, nullif(regexp_extract('Pub ' || CAST(o_orderdate AS VARCHAR), '\d{4}', 0), '') AS y FROM orders")
def publication_year(get):
    return get("orders").select(F.col("o_orderkey").alias("k"), X.publication_year(F.concat(F.lit("Pub "), F.col("o_orderdate").cast("string"))).alias("y"))
