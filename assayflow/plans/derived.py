"""Record-shaped relations derived from the test tables.

The SQL is a common subset that Spark and DuckDB read alike; ``{name}`` stands for a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AST_LONG = """
SELECT l_orderkey * 10 + l_linenumber AS extracted_row, CAST(l_linenumber % 3 AS INT) AS pass_no,
  CAST(10000000 + l_partkey % 40 AS STRING) AS pmid, concat('file', CAST(l_suppkey % 7 AS STRING), '.xlsx') AS file_name, 'Sheet1' AS sheet_name,
  CASE WHEN l_partkey % 11 = 0 THEN ' ' ELSE concat('ISO-', CAST(l_suppkey AS STRING)) END AS isolate_id,
  CASE l_suppkey % 3 WHEN 0 THEN concat('SAMN', CAST(l_suppkey AS STRING)) WHEN 1 THEN concat('ERR', CAST(l_suppkey AS STRING), '; GCA_', CAST(l_suppkey AS STRING), '.1') END AS accession,
  CASE l_partkey % 5 WHEN 0 THEN 'Rifampicin' WHEN 1 THEN 'vancomycin' WHEN 2 THEN 'co-trimoxazole' WHEN 3 THEN ' Oxacillin ' ELSE '' END AS drug,
  CASE l_linenumber % 4 WHEN 0 THEN '=' WHEN 1 THEN '<=' WHEN 2 THEN '>' ELSE '~' END AS mic_sign,
  CASE CAST(l_quantity AS INT) % 6 WHEN 0 THEN '0.50' WHEN 1 THEN '1.0' WHEN 2 THEN '32/16' WHEN 3 THEN 'ND' WHEN 4 THEN CASE WHEN l_partkey % 31 = 0 THEN '1e400' ELSE '' END ELSE '4' END AS mic,
  CASE l_returnflag WHEN 'A' THEN 'S' WHEN 'R' THEN 'Resistant' WHEN 'N' THEN CASE WHEN l_partkey % 2 = 0 THEN 'SDD' END END AS sir_call,
  CASE WHEN l_partkey % 13 = 0 THEN 'seen' END AS notes
FROM {lineitem}
"""

EXTRACTED = """
SELECT extracted_row, pmid, isolate_id, drug, mic_sign, mic, sir_call,
  CASE WHEN accession LIKE 'SAMN%' THEN accession END AS biosample_accession,
  CASE WHEN accession LIKE 'ERR%' THEN concat('GCF_', substring(isolate_id, 5), '.2') END AS assembly_accession,
  CASE WHEN accession IS NULL AND isolate_id LIKE 'ISO-%5' THEN concat('CP', substring(isolate_id, 5), '; cq', substring(isolate_id, 5)) END AS genbank_accessions,
  CASE WHEN accession IS NULL AND isolate_id LIKE 'ISO-%8' THEN concat('NZ_CP', substring(isolate_id, 5), '.1') END AS refseq_accessions,
  CASE WHEN accession LIKE 'ERR%' THEN split_part(accession, ';', 1) WHEN accession IS NULL AND isolate_id LIKE 'ISO-%1' THEN concat('SRR', substring(isolate_id, 5)) END AS sra_accession,
  CASE WHEN accession IS NULL AND isolate_id LIKE 'ISO-%4' THEN concat('Odd', substring(isolate_id, 5), ' none') END AS other_accessions
FROM {ast_long}
"""

TRUTH = """
SELECT CASE WHEN s_suppkey % 5 = 2 THEN '' ELSE concat('g', CAST(s_suppkey AS STRING)) END AS genome_id, antibiotic,
  CASE WHEN (s_suppkey + k) % 4 = 0 THEN 'Susceptible' WHEN (s_suppkey + k) % 4 = 1 THEN 'resistant' WHEN (s_suppkey + k) % 4 = 2 THEN '' ELSE 'S' END AS resistant_phenotype,
  CASE (s_suppkey + k) % 3 WHEN 0 THEN '' WHEN 1 THEN '<=' ELSE '>' END AS measurement_sign,
  CASE (s_suppkey * k) % 4 WHEN 0 THEN '0.5' WHEN 1 THEN '1' WHEN 2 THEN '' ELSE '32/16' END AS measurement_value,
  CASE WHEN s_suppkey % 7 = 0 THEN concat('SAMN', CAST(s_suppkey + 2 AS STRING)) ELSE concat('SAMN', CAST(s_suppkey AS STRING)) END AS `genome.biosample_accession`,
  concat('GCA_', CAST(s_suppkey AS STRING), '.1') AS `genome.assembly_accession`, CASE WHEN s_suppkey % 10 = 5 THEN concat('CQ', CAST(s_suppkey AS STRING), ',CP', CAST(s_suppkey AS STRING)) END AS `genome.genbank_accessions`,
  CASE WHEN s_suppkey % 10 = 8 THEN concat('nz_cp', CAST(s_suppkey AS STRING), '.1') WHEN s_suppkey % 10 = 4 THEN concat('ODD', CAST(s_suppkey AS STRING)) END AS `genome.refseq_accessions`,
  CASE WHEN s_suppkey % 4 < 3 THEN concat('SRR', CAST(s_suppkey AS STRING)) END AS `genome.sra_accession`
FROM {supplier} CROSS JOIN (SELECT 1 AS k, 'rifampin' AS antibiotic UNION ALL SELECT 2, 'Vancomycin' UNION ALL SELECT 3, 'trimethoprim/sulfamethoxazole' UNION ALL SELECT 3, 'Vancomycin') d
"""

META = """
SELECT CASE s_suppkey % 4 WHEN 0 THEN concat('ISO-', CAST(s_suppkey AS STRING)) WHEN 1 THEN concat('OTHER-', CAST(s_suppkey AS STRING)) END AS isolate_id,
  CASE s_suppkey % 4 WHEN 0 THEN concat('SAMEA', CAST(s_suppkey AS STRING)) WHEN 1 THEN concat('SAMN', CAST(s_suppkey + 1000 AS STRING)) END AS accession,
  CASE WHEN s_suppkey % 4 < 2 THEN concat('ERR', CAST(s_suppkey AS STRING)) END AS secondary_accession
FROM {supplier}
UNION ALL SELECT concat('ISO-', CAST(s_suppkey AS STRING)), 'none', CASE WHEN s_suppkey % 8 = 0 THEN concat('CP', CAST(100000 + s_suppkey AS STRING)) END FROM {supplier}
"""

ISOLATES = """
SELECT DISTINCT concat('pm', CAST(c_nationkey % 5 AS STRING)) AS pmid, concat('f', CAST(c_nationkey % 7 AS STRING), '.tsv') AS source_file,
  CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN concat('  ', upper(c_name), ' ') WHEN 2 THEN substring(c_name, 1, 16) ELSE concat('x', CAST(c_custkey AS STRING)) END AS isolate_id
FROM {customer}
"""

STRAINS = """
SELECT c_custkey AS ordinal, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE '' END AS strain, concat('PRJNA', CAST(c_nationkey AS STRING)) AS bioproject_accession, concat('SAMN', CAST(c_custkey AS STRING)) AS biosample_accession,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('SRR', CAST(c_custkey AS STRING)) END AS sra_accession
FROM {customer}
UNION ALL SELECT c_custkey + 1000000, CASE WHEN c_custkey % 10 = 0 THEN lower(c_name) ELSE ' ' END, 'PRJNA0', 'SAMN0', 'SRR0' FROM {customer}
"""

TOKENS = """
SELECT o_orderkey AS k, CASE o_orderkey % 9
  WHEN 0 THEN concat('PRJNA', CAST(o_orderkey AS STRING), ', GCA_', CAST(o_orderkey AS STRING), '.1;samn', CAST(o_orderkey AS STRING), ' SAMN', CAST(o_orderkey AS STRING))
  WHEN 1 THEN concat('''GCF_', CAST(o_orderkey AS STRING), '''  NZ_CP0', CAST(10000 + o_orderkey AS STRING), '.1')
  WHEN 2 THEN concat('ERR', CAST(o_custkey AS STRING), ',nan,SRR', CAST(o_custkey AS STRING), ',-')
  WHEN 3 THEN '-' WHEN 4 THEN 'None' WHEN 5 THEN ''
  WHEN 6 THEN concat('CP', CAST(100000 + o_custkey AS STRING), '; XYZ123;SAMEA', CAST(o_custkey AS STRING), '.1')
  WHEN 7 THEN concat('NC_000', CAST(o_custkey AS STRING), '.3,ERX', CAST(o_custkey AS STRING), ',SAMD', CAST(o_custkey AS STRING)) END AS acc
FROM {orders}
"""

MEASURES = """
SELECT l_orderkey * 10 + l_linenumber AS k, CASE l_partkey % 23
  WHEN 16 THEN '1e400' WHEN 17 THEN '1e300' WHEN 18 THEN '1e19' WHEN 19 THEN '-Inf' WHEN 20 THEN '12345678901234567890/1.5E-120' WHEN 21 THEN '2.5e-7' WHEN 22 THEN '1.5e30'
  WHEN 0 THEN '>64' WHEN 1 THEN '<= 0.5' WHEN 2 THEN ' 32 / 16 ' WHEN 3 THEN 'ND' WHEN 4 THEN 'Susceptible' WHEN 5 THEN '4-64' WHEN 6 THEN '==2' WHEN 7 THEN '1e3' WHEN 8 THEN '0.000050'
  WHEN 9 THEN concat(CAST(l_linenumber AS STRING), '.', CAST(l_suppkey % 10 AS STRING), '0') WHEN 10 THEN '-' WHEN 11 THEN 'NaN' WHEN 12 THEN '123456.789' WHEN 13 THEN '0.25/4.750' WHEN 14 THEN '8.0/a'
  ELSE CAST(l_suppkey AS STRING) END AS v,
  CASE l_suppkey % 9 WHEN 0 THEN 's' WHEN 1 THEN ' Resistant' WHEN 2 THEN 'non  susceptible' WHEN 3 THEN 'NR' WHEN 4 THEN 'SDD' WHEN 5 THEN 'n/a' WHEN 6 THEN 'Non-Resistance' WHEN 7 THEN 'intermediate' END AS call,
  CASE l_suppkey % 8 WHEN 0 THEN '=' WHEN 1 THEN '==' WHEN 2 THEN '≤' WHEN 3 THEN '>=' WHEN 4 THEN ' < ' WHEN 5 THEN '~' WHEN 6 THEN 'na' END AS sign,
  CASE l_suppkey % 7 WHEN 0 THEN ' Rifampicin' WHEN 1 THEN 'Co-Trimoxazole' WHEN 2 THEN 'trimethoprim  sulfamethoxazole' WHEN 3 THEN 'none' WHEN 4 THEN 'Vancomycin' WHEN 5 THEN 'null' END AS drug
FROM {lineitem}
"""

# A sheet in long form: two panels of ten rows, one below the other in every third sheet.  Below its first rows blank cells are absent.
CELLS = """
SELECT * FROM (SELECT concat('s', CAST(p_partkey % 40 AS STRING)) AS sheet, CAST(floor(p_partkey / 40.0) AS INT) AS row_idx, c.col_idx,
  CASE WHEN p_partkey < 40 AND c.col_idx > 0 THEN CAST(NULL AS STRING)
    WHEN (p_partkey >= 40 AND p_partkey < 80) OR (p_partkey % 3 = 0 AND p_partkey >= 1200 AND p_partkey < 1240) THEN element_text
    WHEN c.col_idx = 0 THEN CASE WHEN p_partkey % 3 = 0 THEN p_name END
    WHEN c.col_idx = 1 THEN concat('>', CAST(p_size AS STRING)) WHEN c.col_idx = 2 THEN 'S' WHEN c.col_idx = 3 THEN CAST(p_size AS STRING)
    WHEN c.col_idx = 5 THEN CASE WHEN p_size % 3 = 0 THEN concat('SAMN', CAST(p_partkey AS STRING)) END ELSE CASE WHEN p_size % 2 = 0 THEN 'R' ELSE 'x' END END AS value,
  c.col_idx <> 3 OR p_partkey < 80 AS is_string
FROM {part} CROSS JOIN (SELECT 0 AS col_idx, 'Isolate ID' AS element_text UNION ALL SELECT 1, 'vancomycin (MIC)' UNION ALL SELECT 2, 'Unnamed: 2' UNION ALL SELECT 3, 'oxacillin' UNION ALL SELECT 4, 'Unnamed: 4' UNION ALL SELECT 5, 'BioSample') c) x
WHERE row_idx < 2 OR value IS NOT NULL
"""

PAPERS = """
SELECT CAST(20000000 + doc_id AS STRING) AS pmid, doc_id, coalesce(source, '') AS title,
  concat(CASE WHEN doc_id % 6 = 0 THEN '<front>' ELSE '<body>' END, coalesce(text, ''),
    CASE doc_id % 7 WHEN 0 THEN ' MIC and MICs by CLSI; susceptible, susceptible. Table 1 gives it. SAMN123 ' WHEN 1 THEN ' resistance by EUCAST, see Table S2. ' WHEN 2 THEN ' Broth microdilution; PRJNA77 GCA_000123.1 '
      WHEN 3 THEN ' Table 2 and Supplementary Table 3: breakpoint, MIC, MIC ' ELSE '' END) AS text
FROM {documents}
"""

# An article for every document; its words fill tables, captions, references and statements.  Every ninth is malformed.
ARTICLES = """
SELECT CAST(doc_id AS STRING) AS pmid, doc_id,
  CASE WHEN doc_id % 9 = 8 THEN concat('<article><body>', x, '</article>')
  ELSE concat('<article><front/><body><sec><p>', x, '</p><table-wrap id="t"><label>Table ', CASE WHEN doc_id % 4 = 3 THEN 'S' ELSE '' END, CAST(doc_id % 5 AS STRING), '</label><caption><p>',
    CASE doc_id % 5 WHEN 0 THEN 'MIC of <i>' WHEN 1 THEN 'Resistance genes <i>' WHEN 2 THEN 'Genes and MICs by CLSI <i>' WHEN 3 THEN 'Colours <i>' ELSE 'Zone diameter <i>' END, split_part(x, ' ', 2), '</i></p></caption><table><tr><th>Isolate</th><th> ',
    split_part(x, ' ', 3), ' </th></tr><tr><td/><td></td></tr><tr><td>', split_part(x, ' ', 4), '</td><td><b>&gt;<i>', CAST(doc_id % 64 AS STRING), '</i></b> </td></tr></table></table-wrap>',
    CASE WHEN doc_id % 3 = 0 THEN concat('<table-wrap><label>Table 7</label><caption>', split_part(x, ' ', 5), '</caption><table><tr><td>', split_part(x, ' ', 6), '</td></tr></table></table-wrap>') ELSE '' END,
    CASE WHEN doc_id % 2 = 0 THEN concat('<supplementary-material href="s', CAST(doc_id AS STRING), '.xlsx"><media href="m', CAST(doc_id % 7 AS STRING), '.pdf"/><media href="http://x/y"/><graphic href="s', CAST(doc_id AS STRING), '.xlsx"/></supplementary-material>') ELSE '' END,
    '</sec></body>', CASE doc_id % 4 WHEN 0 THEN concat('<back><sec sec-type="data-availability"><title>Data</title><p>In PRJNA', CAST(doc_id AS STRING), ' and GCA_000', CAST(doc_id AS STRING), '.1; SAMN', CAST(doc_id AS STRING), '.</p></sec></back>')
      WHEN 1 THEN concat('<back><notes><title>Accession numbers</title><p>ERR', CAST(doc_id AS STRING), ', ERR', CAST(doc_id AS STRING), '</p></notes></back>') WHEN 2 THEN '<back><sec><title>Data availability</title><p>On request.</p></sec></back>' ELSE '' END, '</article>') END AS xml
FROM (SELECT doc_id, concat('w ', trim(regexp_replace(regexp_replace(substring(coalesce(text, ''), 1, 400), '[^A-Za-z ]', ' '{g}), ' +', ' '{g})), ' a b c d e f') AS x FROM {documents}) d
"""

_SQL = {"articles": ARTICLES, "ast_long": AST_LONG, "extracted": EXTRACTED, "truth": TRUTH, "meta": META, "isolates": ISOLATES, "strains": STRAINS, "tokens": TOKENS, "measures": MEASURES, "cells": CELLS, "papers": PAPERS}
_TABLES = ("lineitem", "supplier", "customer", "orders", "part", "documents", "nation", "events", "pages")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived relation, or a test table itself."""
    if name not in _SQL:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = _SQL[name].replace("{g}", "")
    sources = {n: frame(spark, sf_dir, n) for n in (*_SQL, *_TABLES) if "{" + n + "}" in text}
    return spark.sql(text, **sources)


def sql(name: str) -> str:
    """The relation as a DuckDB subquery."""
    # DuckDB replaces only the first match unless it is told otherwise.
    text = _SQL[name].replace("`", '"').replace("{g}", ", 'g'")
    for n in (*_SQL, *_TABLES):
        if "{" + n + "}" in text:
            text = text.replace("{" + n + "}", f"({sql(n)})" if n in _SQL else n)
    return text


def with_tables(query: str, *names: str) -> str:
    """``query`` with the named relations as common table expressions."""
    ctes = ", ".join(f"{n} AS ({sql(n)})" for n in names)
    head = query.lstrip()
    if head.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes}, {head[14:]}"
    return f"WITH {ctes}, {head[4:]}" if head.upper().startswith("WITH") else f"WITH {ctes} {head}"
