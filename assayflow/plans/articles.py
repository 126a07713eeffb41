"""Queries of article, set and streaming operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import papers as P
from ..operators import sets
from ..sources import connectors, jats, readers, sinks
from ..streaming import ingest
from .registry import query

_TOPIC = P.TOPIC.replace("(?i)", "")
RE2_MAIN = r"(?i)\bTable\s*\d+[A-Za-z]?\b\s*([^\sS]|$)"
CLASSIFY = rf"""
c AS (SELECT pmid, text, contains(lower(text), '<body') AS body, regexp_matches(text, '(?i){_TOPIC}') AS topical, regexp_matches(text, '{P.SUPPLEMENT}') AS sup, regexp_matches(text, '{RE2_MAIN}') AS main,
  regexp_matches(text, '{P.ACCESSION}') AS acc, list_transform(regexp_extract_all(text, '(?i){_TOPIC}'), lambda x: lower(x)) AS hits FROM papers),
k AS (SELECT pmid, h, count(*) AS n, min(pos) AS first FROM (SELECT pmid, unnest(hits) AS h, generate_subscripts(hits, 1) AS pos FROM c) GROUP BY 1, 2),
t AS (SELECT pmid, h, n, row_number() OVER (PARTITION BY pmid ORDER BY n DESC, first) AS place FROM k),
d AS (SELECT pmid, string_agg(h || '×' || CAST(n AS VARCHAR), ', ' ORDER BY place) AS details FROM t WHERE place <= 4 GROUP BY pmid)
"""


@query("paper_classify", f"""WITH {CLASSIFY} SELECT c.pmid, CASE WHEN NOT body THEN 'no_fulltext_restricted' WHEN NOT topical THEN 'none_found' WHEN main AND sup THEN 'main_text_and_supplement' WHEN main THEN 'main_text_table' WHEN sup THEN 'supplement' ELSE 'main_text_prose' END AS ast_location,
  CASE WHEN NOT body OR NOT topical THEN 'unclear' WHEN acc THEN 'yes' ELSE 'no' END AS biosample_hint, CASE WHEN NOT body THEN 'Publisher restricts full-text XML via the PMC API (efetch returned only front matter/abstract, no <body>). View this paper''s tables/supplements manually at its PMC article page or PDF.'
  WHEN NOT topical THEN 'No AST-related keywords found in full text.' ELSE 'AST keyword hits: ' || d.details || '. 0 candidate AST table(s) in main text.' END AS details FROM c LEFT JOIN d ON c.pmid = d.pmid""", ("papers",))
def paper_classify(get):
    return P.classify(get("papers")).select("pmid", "ast_location", "biosample_hint", "details")


@query("keyword_top4", f"WITH {CLASSIFY} SELECT pmid, h AS keyword, n, CAST(place AS INTEGER) AS place FROM t WHERE place <= 4", ("papers",))
def keyword_top4(get):
    return P.top_keywords(get("papers"))


@query("paper_accessions", rf"SELECT pmid, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{P.DEPOSITED}', 1))), ',') AS accs FROM papers", ("papers",))
def paper_accessions(get):
    return get("papers").select("pmid", F.array_join(P.deposited(F.col("text")), ",").alias("accs"))


@query("accession_confirmed", "SELECT pmid, CASE doc_id % 3 WHEN 0 THEN 'unclear' WHEN 1 THEN CASE WHEN contains(text, 'SAMN123') THEN 'yes' ELSE 'no' END ELSE CASE WHEN contains(text, 'PRJNA77') OR contains(text, 'GCA_9') THEN 'yes' ELSE 'no' END END AS confirmed FROM papers", ("papers",))
def accession_confirmed(get):
    known = F.when(F.col("doc_id") % 3 == 1, F.array(F.lit("SAMN123"))).when(F.col("doc_id") % 3 == 2, F.array(F.lit("PRJNA77"), F.lit("GCA_9"))).otherwise(F.array().cast("array<string>"))
    return get("papers").select("pmid", P.confirmed(known, F.col("text")).alias("confirmed"))


_LINES = "CASE o_orderkey % 6 WHEN 0 THEN concat('g', CAST(o_custkey AS VARCHAR(20)), chr(9), 'x', chr(9), CAST(o_custkey % 50 AS VARCHAR(20))) WHEN 1 THEN CAST(o_custkey % 60 AS VARCHAR(20)) WHEN 2 THEN '' WHEN 3 THEN '-' WHEN 4 THEN concat('h', CAST(o_custkey AS VARCHAR(20)), chr(9), CAST(o_custkey % 50 AS VARCHAR(20))) ELSE 'abc' END"
_PMIDS = f"""
l AS (SELECT o_orderkey AS line_no, {_LINES} AS line FROM orders),
p AS (SELECT line_no, string_split(line, chr(9)) AS f FROM l WHERE trim(line) <> ''),
q AS (SELECT line_no, CASE WHEN len(f) >= 3 THEN f[3] WHEN len(f) = 1 THEN f[1] ELSE f[2] END AS pmid, CASE WHEN len(f) >= 2 THEN f[1] END AS genome FROM p),
g AS (SELECT pmid, genome, min(line_no) AS first FROM q WHERE regexp_full_match(pmid, '[0-9]+') GROUP BY 1, 2),
h AS (SELECT pmid, min(first) AS ordinal, coalesce(string_agg(genome, ';' ORDER BY first) FILTER (genome IS NOT NULL), '') AS genome_ids, count(genome) AS n FROM g GROUP BY pmid)
"""


def _pmids(get):
    return P.parse_pmid_lines(get("orders").select(F.col("o_orderkey").alias("line_no"), F.expr(_LINES).alias("line")))


@query("pmid_input_parse", f"WITH {_PMIDS} SELECT pmid, ordinal, genome_ids FROM h")
def pmid_input_parse(get):
    return _pmids(get).withColumn("genome_ids", F.array_join("genome_ids", ";"))


@query("paper_sort", f"WITH {_PMIDS} SELECT pmid, genome_ids, '' AS bvbrc_genome_ids, 'a | b c' AS notes FROM h")
def paper_sort(get):
    """The flat report; rows come most genomes first."""
    papers = _pmids(get).withColumns({"bvbrc_genome_ids": F.array().cast("array<string>"), "notes": F.array(F.lit("a"), F.lit("b\tc"))})
    return P.report(papers)


@query("summary_join", "SELECT p.pmid, o_totalprice AS price FROM (SELECT CAST(c_custkey AS VARCHAR) AS pmid FROM customer) p LEFT JOIN (SELECT CAST(o_custkey AS VARCHAR) AS pmid, max(o_totalprice) AS o_totalprice FROM orders GROUP BY o_custkey) s ON p.pmid = s.pmid")
def summary_join(get):
    summaries = get("orders").groupBy(F.col("o_custkey").cast("string").alias("pmid")).agg(F.max("o_totalprice").alias("price"))
    return P.with_summaries(get("customer").select(F.col("c_custkey").cast("string").alias("pmid")), summaries)


# The articles' XML taken apart by patterns: table elements, their labels, captions and rows, with tags dropped and blanks joined.
_FLAT = r"trim(regexp_replace(replace(replace(regexp_replace({0}, '<[^>]*>', '', 'g'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))"
_TABLES_SQL = rf"""
a AS (SELECT pmid, xml, doc_id % 9 <> 8 AS sound FROM articles),
wr AS (SELECT pmid, unnest(w) AS wrap, generate_subscripts(w, 1) - 1 AS table_idx FROM (SELECT pmid, regexp_extract_all(xml, '(?s)<table-wrap.*?</table-wrap>') AS w FROM a WHERE sound)),
tr AS (SELECT pmid, table_idx, {_FLAT.format("regexp_extract(wrap, '<label>(.*?)</label>', 1)")} AS label, {_FLAT.format("regexp_extract(wrap, '<caption>(.*?)</caption>', 1)")} AS caption,
  list_transform(regexp_extract_all(wrap, '<tr>.*?</tr>'), lambda r: list_transform(regexp_extract_all(replace(r, '<td/>', '<td></td>'), '<t[dh]>.*?</t[dh]>'), lambda c: {_FLAT.format('c')})) AS rws FROM wr),
tb AS (SELECT pmid, CAST(table_idx AS INTEGER) AS table_idx, label, caption, list_filter(rws, lambda r: array_to_string(r, '') <> '') AS rws FROM tr),
kt AS (SELECT *, array_to_string(flatten(rws[1:6]), ' ') AS head FROM tb),
ak AS (SELECT * FROM kt WHERE NOT regexp_matches(label, '{P.SUPPLEMENT_LABEL}')
  AND NOT (regexp_matches(caption, '{P.GENE_TABLE}') AND NOT regexp_matches(caption, '{P.STRONG_TOPIC}') AND NOT regexp_matches(head, '{P.STRONG_TOPIC}'))
  AND (regexp_matches(caption, '{P.TOPIC}') OR regexp_matches(head, '{P.TOPIC}')))
"""


@query("xml_tables", f"WITH {_TABLES_SQL} SELECT pmid, table_idx, label, caption, array_to_string(list_transform(rws, lambda r: array_to_string(r, '|')), '#') AS rows FROM tb", ("articles",))
def xml_tables(get):
    return jats.tables(get("articles")).withColumn("rows", F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "#"))


@query("ast_table_filter", f"WITH {_TABLES_SQL} SELECT pmid, table_idx, label FROM ak", ("articles",))
def ast_table_filter(get):
    return P.keep_tables(jats.tables(get("articles"))).select("pmid", "table_idx", "label")


@query("ast_table_text", rf"""WITH {_TABLES_SQL} SELECT pmid, table_idx, coalesce(nullif(regexp_replace(regexp_replace(label, '[^A-Za-z0-9_.-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'table') || '.tsv' AS file,
  '# ' || label || ': ' || caption || chr(10) || array_to_string(list_transform(rws, lambda r: array_to_string(r, chr(9))), chr(10)) || chr(10) AS text FROM ak""", ("articles",))
def ast_table_text(get):
    t = P.keep_tables(jats.tables(get("articles")))
    return t.select("pmid", "table_idx", sinks.table_file_name(F.col("label")).alias("file"), sinks.table_text(F.col("label"), F.col("caption"), F.col("rows")).alias("text"))


@query("ast_table_scan", f"""WITH {_TABLES_SQL} SELECT path, caption, header, CAST(i - 2 AS INTEGER) AS row_idx, cells FROM (
  SELECT pmid || '-' || CAST(table_idx AS VARCHAR) AS path, label || ': ' || caption AS caption, array_to_string(rws[1], '|') AS header, unnest(list_transform(rws, lambda r: array_to_string(r, '|'))) AS cells, generate_subscripts(rws, 1) AS i FROM ak) WHERE i > 1""", ("articles",))
def ast_table_scan(get):
    """Saved tables read back, with a spanning line in front that is skipped where two equally wide lines follow."""
    t = P.keep_tables(jats.tables(get("articles")))
    spanned = F.when(F.size("rows") > 1, F.concat(F.array(F.array(F.lit("MIC"))), F.col("rows"))).otherwise(F.col("rows"))
    text = sinks.table_text(F.col("label"), F.col("caption"), spanned)
    rows = readers.table_rows(t.select(F.concat_ws("-", "pmid", F.col("table_idx").cast("string")).alias("path"), F.split(text, "\n").alias("all")))
    return rows.select("path", "caption", F.array_join("header", "|").alias("header"), "row_idx", F.array_join("cells", "|").alias("cells"))


@query("supplement_refs", """WITH r AS (SELECT pmid, list_distinct(regexp_extract_all(regexp_extract(xml, '<supplementary-material.*?</supplementary-material>'), 'href="([^"]*)"', 1)) AS d,
  regexp_extract_all(regexp_extract(xml, '<supplementary-material.*?</supplementary-material>'), 'href="([^"]*)"', 1) AS all_refs FROM articles WHERE doc_id % 9 <> 8),
f AS (SELECT pmid, list_filter(all_refs, lambda h, i: NOT starts_with(h, 'http') AND list_position(all_refs, h) = i) AS refs FROM r)
SELECT pmid, CAST(generate_subscripts(refs, 1) - 1 AS INTEGER) AS ordinal, unnest(refs) AS href FROM f""", ("articles",))
def supplement_refs(get):
    return jats.supplement_refs(get("articles"))


@query("data_availability", rf"""WITH b AS (SELECT pmid, doc_id % 9 <> 8 AS sound, regexp_extract(xml, '<back>(.*)</back>', 1) AS back FROM articles),
s AS (SELECT pmid, sound AND (contains(back, 'sec-type="data-availability"') OR regexp_matches(lower(regexp_extract(back, '<title>(.*?)</title>', 1)), '{P.AVAILABILITY_HEADING}')) AS found, back FROM b)
SELECT pmid, found, CASE WHEN found THEN array_to_string(list_sort(list_distinct(regexp_extract_all(regexp_replace(back, '<[^>]*>', ' ', 'g'), '{P.DEPOSITED}', 1))), ',') ELSE '' END AS accessions FROM s""", ("articles",))
def data_availability(get):
    return jats.data_availability(get("articles")).withColumn("accessions", F.array_join("accessions", ","))


@query("article_summaries", """SELECT CAST(o_orderkey AS VARCHAR) AS pmid, 'T' || o_orderstatus AS title, 'A' || o_orderstatus AS first_author, '2020' AS year, CASE WHEN o_orderkey % 2 = 0 THEN 'PMC7' END AS pmcid, '10.1/' || CAST(o_orderkey AS VARCHAR) AS doi FROM (SELECT DISTINCT o_orderkey, o_orderstatus FROM orders)""")
def article_summaries(get):
    k = F.col("o_orderkey").cast("string")
    body = F.concat(
        F.lit('{"result": {"uids": [], "'), k, F.lit('": {"uid": "1", "title": "T'), "o_orderstatus", F.lit('..", "sortfirstauthor": "A'), "o_orderstatus", F.lit('", "pubdate": "Mar 2020", "articleids": ['),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit('{"idtype": "pmc", "value": "7"}, ')).otherwise(""), F.lit('{"idtype": "doi", "value": "10.1/'), k, F.lit('"}]}}}'),
    )
    return connectors.article_summaries(get("orders").select("o_orderkey", "o_orderstatus").distinct().select(body.alias("json")))


@query("genome_projection", """SELECT CAST(c_custkey AS VARCHAR) AS pmid, CAST(c_custkey AS VARCHAR) || '.1' AS genome_id, CASE WHEN c_nationkey % 2 = 0 THEN 'A1,B' ELSE 'A1,A2,B' END || CAST(c_custkey AS VARCHAR) AS genbank_accessions FROM customer""")
def genome_projection(get):
    k, n = F.col("c_custkey").cast("string"), F.col("c_nationkey")
    more = F.when(n % 2 == 0, F.lit("A1")).otherwise("A1,A2")
    docs = F.concat(F.lit('[{"genome_id": "'), k, F.lit('.1", "genbank_accessions": "B'), k, F.lit(", "), more, F.lit('"}, {"genome_id": "'), k, F.lit('.1"}]'))
    body = F.when(n % 3 == 0, docs).when(n % 3 == 1, F.concat(F.lit('{"response": {"docs": '), docs, F.lit("}}"))).otherwise(F.concat(F.lit('{"docs": '), docs, F.lit("}")))
    found = connectors.genomes_of_papers(get("customer").select(k.alias("pmid"), body.alias("json")))
    return found.select("pmid", F.array_join("genome_id", ",").alias("genome_id"), F.array_join("genbank_accessions", ",").alias("genbank_accessions"))


@query("dumped_collection", "SELECT p_partkey AS k, p_partkey % 4 < 2 AS dumped FROM part")
def dumped_collection(get):
    from ..functions.literals import is_dumped_collection

    value = F.element_at(F.array(F.lit("('4', nan)"), F.lit("{'a': [1, 2]}"), F.lit("(R)"), F.lit("4 [mg/L]")), (F.col("p_partkey") % 4 + 1).cast("int"))
    return get("part").select(F.col("p_partkey").alias("k"), is_dumped_collection(value).alias("dumped"))


@query("usage_totals", "SELECT event_type AS kind, count(*) AS calls, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS tokens FROM events GROUP BY ROLLUP (event_type)")
def usage_totals(get):
    return sets.usage_totals(get("events").select(F.col("event_type").alias("kind"), F.get_json_object("props", "$.k").cast("bigint").alias("tokens")))


@query("windowed_usage", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2")
def windowed_usage(get):
    return ingest.usage_by_window(get("events"))


@query("batch_summary", "SELECT CASE event_id % 4 WHEN 0 THEN 'empty' WHEN 1 THEN 'error' ELSE 'produced' END AS status, count(*) AS n FROM events GROUP BY 1")
def batch_summary(get):
    return sets.batch_summary(get("events").select(F.when(F.col("event_id") % 4 == 0, "empty").when(F.col("event_id") % 4 == 1, "error").otherwise("produced").alias("status")))


_RUN2 = "SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 97 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity FROM lineitem"


def _runs(get):
    first = get("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return first, first.withColumn("l_quantity", F.when(F.col("l_orderkey") % 97 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))


@query("run_diff", f"""WITH a AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem), b AS ({_RUN2}), d AS (SELECT l_orderkey, l_linenumber, l_quantity, sum(x) AS s FROM (SELECT *, 1 AS x FROM a UNION ALL SELECT *, -1 FROM b) GROUP BY 1, 2, 3)
SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN s > 0 THEN 'first' ELSE 'second' END AS side, CAST(abs(s) AS BIGINT) AS n FROM d WHERE s <> 0""")
def run_diff(get):
    return sets.run_diff(*_runs(get))


@query("run_same", "SELECT DISTINCT l_orderkey, l_orderkey % 97 <> 0 AS same FROM lineitem")
def run_same(get):
    return sets.same_runs(*_runs(get), by="l_orderkey")


@query("union_records", "SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
def union_records(get):
    s = get("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    c = get("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return sets.union_records([s, c])


@query("sheets_except", "SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM (SELECT CASE WHEN o_orderkey % 10 = 0 THEN o_custkey END AS k FROM orders) o WHERE o.k = c.c_custkey)")
def sheets_except(get):
    done = get("orders").select(F.when(F.col("o_orderkey") % 10 == 0, F.col("o_custkey")).alias("c_custkey")).distinct()
    return sets.not_processed(get("customer").select("c_custkey", "c_name"), done, ["c_custkey"])


@query("isolate_ids", "SELECT DISTINCT pmid, file_name AS source_file, trim(isolate_id) AS isolate_id FROM ast_long WHERE trim(isolate_id) <> ''", ("ast_long",))
def isolate_ids(get):
    return readers.isolate_ids(get("ast_long"))
