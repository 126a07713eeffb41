"""Sources, sheet operators, article operators, sinks and streams."""

import io
import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from assayflow import schemas
from assayflow.functions.drugs import names_drug
from assayflow.operators import cells as C
from assayflow.operators import papers, sets
from assayflow.providers import provider
from assayflow.sources import jats, readers, sinks, xlsx
from assayflow.sources.xlsx import cells_of, column_index
from assayflow.streaming import ingest

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def workbook(rows):
    out = io.BytesIO()
    shared = sorted({v for row in rows for v in row if isinstance(v, str)})
    cell = lambda r, c, v: f'<c r="{chr(65 + c)}{r + 1}" t="s"><v>{shared.index(v)}</v></c>' if isinstance(v, str) else f'<c r="{chr(65 + c)}{r + 1}"><v>{v}</v></c>'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {NS}><sheets><sheet name="One" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {NS}>" + "".join(f"<si><t>{escape(s)}</t></si>" for s in shared) + "</sst>")
        body = "".join(f'<row r="{r + 1}">' + "".join(cell(r, c, v) for c, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(rows))
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {NS}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


def test_workbooks(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook([["Title"], ["Isolate ID", "vancomycin", "Unnamed: 2"], ["i1", 4, "S"], ["i2", 0.5, "R"]]))
    (tmp_path / "~$a.xlsx").write_bytes(b"lock")
    (tmp_path / "bad.xlsx").write_bytes(b"not a zip")
    files = spark.read.format("binaryFile").load(f"{tmp_path}/*.xlsx")
    cells = cells_of(files)
    assert cells.count() == 10
    assert {(r.row_idx, r.value, r.is_string) for r in cells.where("col_idx = 1").collect()} == {(1, "vancomycin", True), (2, "4", False), (3, "0.5", False)}
    assert C.header_rows(cells).first().header_row == 1
    roles = {r.col_name: (r.role, r.paired_with) for r in provider().roles(cells).collect()}
    assert roles == {"Isolate ID": ("local_id", None), "vancomycin": ("drug_mic", "Unnamed: 2"), "Unnamed: 2": ("drug_sir", None)}
    (tmp_path / "odd.xlsx").write_bytes(workbook([["a"]]).replace(b"sharedStrings.xml", b"sharedStrinks.xml"))
    assert {r.file_name.rsplit("/", 1)[-1]: r.error.split(":")[0] for r in xlsx.failures(xlsx.workbooks(spark, str(tmp_path))).collect()} == {"bad.xlsx": "BadZipFile", "odd.xlsx": "IndexError"}
    few = xlsx.read(spark, str(tmp_path), max_rows=2, pmid="7")
    assert few.count() == 4 and few.schema.simpleString() == spark.createDataFrame([], schemas.CELLS).schema.simpleString()
    assert [column_index(x) for x in ("A1", "Z9", "AA3")] == [0, 25, 26]


def sheet(spark, rows):
    return spark.createDataFrame([("s", r, c, v, True) for r, row in enumerate(rows) for c, v in enumerate(row)], "sheet string, row_idx int, col_idx int, value string, is_string boolean")


def test_drug_names_are_sought_in_one_cleaned_cell(spark):
    df = spark.createDataFrame([("x VANCOMYCIN\u00a0",), (" fa ",), ("antibiotics",), ("sulfa(x).y+",), ("sulfa(x)zy",), ("",), (None,)], "c string")
    named = df.select(names_drug(F.col("c"), ("Vancomycin", "fa", "ant", "sulfa(x).y+")).alias("n"))
    assert [r.n for r in named.collect()] == [True, False, False, True, False, False, False]
    # A lambda over the names would clean the cell for each of them.
    assert "lambda" not in named._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("at", "stacked"), [([0], False), ([0, 1], False), ([0, 15], True), ([0, 5], False)])
def test_stacked_sheets(spark, at, stacked):
    rows = [["vancomycin", "Oxacillin MIC"] if r in at else ["x", "1"] for r in range(20)]
    assert C.stacked_sheets(sheet(spark, rows)).first().stacked is stacked


def test_merged_headers_and_fill_down(spark):
    s = sheet(spark, [["x", "MIC", None], ["Isolate", "VAN", "OXA"], ["a", "1", "2"], ["", "3", "4"]])
    names = C.flat_headers(s, spark.createDataFrame([("s", 1)], "sheet string, header_row int")).orderBy("col_idx")
    assert [r.col_name for r in names.collect()] == ["x_Isolate", "MIC_VAN", "MIC_OXA"]
    assert [r.value for r in C.fill_down(s.where("row_idx > 1"), [0]).orderBy("row_idx").collect()] == ["a", "a"]


def test_articles(spark):
    xml = (
        '<a xmlns:x="http://www.w3.org/1999/xlink"><body>MIC by CLSI, MICs; see Table 1<table-wrap><label>T1</label><caption>MIC</caption><tr><td>a <b>b</b></td><td>c</td></tr></table-wrap>'
        '<supplementary-material x:href="s.xlsx"/></body><sec><title>Data availability</title><p>SRR1 and PRJNA2</p></sec></a>'
    )
    df = spark.createDataFrame([("1", xml), ("2", "<broken"), ("3", None)], "pmid string, xml string")
    assert [r.asDict() for r in jats.tables(df).collect()] == [{"pmid": "1", "table_idx": 0, "label": "T1", "caption": "MIC", "rows": [["a b", "c"]]}]
    assert [(r.pmid, r.href) for r in jats.supplement_refs(df).collect()] == [("1", "s.xlsx")]
    assert {r.pmid: (r.found, r.accessions) for r in jats.data_availability(df).collect()} == {"1": (True, ["PRJNA2", "SRR1"]), "2": (False, []), "3": (False, [])}
    got = {r.pmid: (r.ast_location, r.details) for r in papers.classify(df.withColumnRenamed("xml", "text")).collect()}
    assert got["1"][0] == "main_text_table" and got["1"][1].startswith("AST keyword hits: mic×2, clsi×1")
    assert got["3"] == ("no_fulltext_restricted", papers.RESTRICTED_DETAILS)


def test_text_readers(spark, tmp_path):
    (tmp_path / "p.txt").write_text("g1\tx\t111\n222\n\n-\ng2\t111\nabc\ng1\tx\t111\n")
    got = {r.pmid: r.genome_ids for r in readers.pmid_list(spark, str(tmp_path / "p.txt")).collect()}
    assert got == {"111": ["g1", "g2"], "222": []}
    (tmp_path / "t.tsv").write_text("# T1: cap\nspan\nid\tVAN\na\t4\nb\t8\tx\n")
    rows = readers.ast_tables(spark, str(tmp_path / "t.tsv")).orderBy("row_idx").collect()
    assert [(r.caption, r.header, r.cells) for r in rows] == [("T1: cap", ["id", "VAN"], ["a", "4"]), ("T1: cap", ["id", "VAN"], ["b", "8", "x"])]
    (tmp_path / "s.tsv").write_text("a\tb\nNA\t\n\"q\t1\n")
    assert [tuple(r) for r in readers.strict_tsv(spark, str(tmp_path / "s.tsv")).collect()] == [("NA", ""), ('"q', "1")]
    found, others = readers.discover(spark, str(tmp_path))
    assert found.count() == 0 and others.count() == 3


def test_table_and_folder_readers(spark, tmp_path):
    for name, rows in (("b", "pmid\tkind\n1\t\"late\n"), ("a", "pmid\tkind\n2\tx\n1\t\"early\n")):
        (tmp_path / f"{name}.tsv").write_text(rows)
    assert readers.classification_row(spark, f"{tmp_path}/*.tsv", "1").first().kind == '"early'
    assert readers.classification_row(spark, f"{tmp_path}/*.tsv", "9").count() == 0
    assert sorted(tuple(r) for r in readers.glob_tsv(spark, f"{tmp_path}/*.tsv").collect()) == [("1", '"early'), ("1", '"late'), ("2", "x")]
    (tmp_path / "drugs.txt").write_text(" vancomycin \n\noxacillin\n")
    assert [r.name for r in readers.antibiotics(spark, str(tmp_path / "drugs.txt")).collect()] == ["vancomycin", "oxacillin"]
    with pytest.raises(AnalysisException):
        readers.antibiotics(spark, str(tmp_path / "missing.txt"))
    for pmid, file in (("11", "s2.pdf"), ("11", "s1.xlsx"), ("12", "x.csv")):
        (tmp_path / "sup" / pmid).mkdir(parents=True, exist_ok=True)
        (tmp_path / "sup" / pmid / file).write_text("x")
    assert {r.pmid: r.files for r in readers.inventory(spark, str(tmp_path / "sup")).collect()} == {"11": ["s1.xlsx", "s2.pdf"], "12": ["x.csv"]}
    (tmp_path / "seed.csv").write_text('accession_id,mic,genome_ids\n"[GCA_1](http://x/y)",<= 2,"[""a"", ""b""]"\nSAMN2,== 16,\n')
    seed = {r.accession: (r.mic, r.genome_ids) for r in readers.seed_csv(spark, str(tmp_path / "seed.csv")).collect()}
    assert seed == {"GCA_1": ("<= 2", ["a", "b"]), "SAMN2": ("== 16", None)}
    (tmp_path / "starter" / "123").mkdir(parents=True)
    (tmp_path / "starter" / "123" / "metadata.json").write_text('{\n"title": "T", "pmcid": "PMC1", "other": 1}')
    (tmp_path / "starter" / "123" / "fulltext.xml").write_text("<a>\n</a>")
    assert [tuple(r) for r in readers.starter(spark, str(tmp_path / "starter")).collect()] == [("123", "T", "PMC1", None, "<a>\n</a>")]
    sets.require_columns(seed_frame := spark.range(1), {"id"})
    with pytest.raises(ValueError, match="missing columns: a, b"):
        sets.require_columns(seed_frame, {"id", "b", "a"})


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", None)], "pmid string, file_name string")
    full = df.select(*[F.col(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in schemas.RECORD_FINAL.fieldNames()])
    assert sinks.write_records(full, str(tmp_path / "out"))
    assert not sinks.write_records(full.limit(0), str(tmp_path / "none")) and not (tmp_path / "none").exists()
    text = next((tmp_path / "out").glob("part*")).read_text().split("\n")
    assert text[0].split("\t")[0] == "pmid" and text[1] == "1" + "\t" * 15
    target = sinks.write_version(full, str(tmp_path / "v"), "1")
    assert spark.read.parquet(target).count() == 1
    report = sinks.download_report(df, df.limit(0)).first().report
    assert report == '{"summary":[{"pmid":"1"}],"failures":[]}'
    log = sinks.run_log(df, df, spark.createDataFrame([("x",)], "reason string")).first()
    assert (log.records, log.retained, log.dropped, log.reasons, log.calls, log.input_tokens) == (1, 1, 1, ["x"], 0, 0)
    usage = spark.createDataFrame([(10, 2), (5, 1)], "input_tokens int, output_tokens int")
    log = sinks.run_log(df, df, spark.createDataFrame([("x",)], "reason string"), usage, 1.5).first()
    assert (log.calls, log.input_tokens, log.output_tokens, log.seconds) == (2, 15, 3, 1.5)
    sinks.write_download_report(df, df.limit(0), str(tmp_path / "dl"))
    assert spark.read.json(str(tmp_path / "dl/summary")).first().pmid == "1"


def test_no_part_of_a_table_is_without_rows(spark, tmp_path):
    for at in range(4):  # the row is in each of four partitions in turn
        df = spark.createDataFrame([(i, "" if i % 2 else None, None) for i in range(4)], "i int, x string, y string").where(f"i = {at}").drop("i")
        assert df.rdd.getNumPartitions() == 4 and sinks.write_tsv(df, str(tmp_path / f"out{at}"))
        assert [p.read_text() for p in (tmp_path / f"out{at}").glob("part*")] == ["x\ty\n\t\n"]


def test_stream_publishes_each_batch_once(spark, tmp_path):
    kind = "isolate_id string, accession string, drug string, mic_sign string, mic string, sir_call string, notes string"
    rows = spark.createDataFrame([("i", None, "van", "=", "4", None, None), ("i", None, None, "=", "4", None, None)], kind)
    rows.write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        ingest.publish(ingest.record_stream(spark, str(tmp_path / "in"), rows.schema), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/valid")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out/quarantine")).count() == 1
