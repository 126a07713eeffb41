"""Workflows over files, through the command line."""

import pytest
from pyspark.sql import functions as F

from assayflow import cli, schemas
from assayflow.plans import workflows
from assayflow.providers import RuleProvider, TransformSpec, provider, register
from assayflow.sources import sinks

from .test_sources import workbook


def _tsv(path, rows):
    path.write_text("\n".join("\t".join(r) for r in rows) + "\n")
    return str(path)


def _read(folder):
    rows = [line.split("\t") for p in sorted(folder.glob("part*")) for line in p.read_text().splitlines()]
    return rows[:1] + [r for r in rows if r != rows[0]]


def test_extract_and_scan(spark, tmp_path):
    (tmp_path / "pmid_12345678").mkdir()
    (tmp_path / "pmid_12345678" / "a.xlsx").write_bytes(workbook([["Supplement"], ["Strain", "BioSample", "vancomycin", "Unnamed: 3", "oxacillin"], ["i1", "SAMN12345", "<=4", "S", 8], ["i2", "SAMN12346", 0.5, "R", "ND"]]))
    assert cli.main(["extract", str(tmp_path), str(tmp_path / "out")], spark) == 0
    rows = _read(tmp_path / "out" / "records")
    got = [dict(zip(rows[0], r, strict=False)) for r in rows[1:]]
    assert sorted((r["isolate_id"], r["drug"], r["mic_sign"], r["mic"], r["sir_call"]) for r in got) == [("i1", "oxacillin", "=", "8", ""), ("i1", "vancomycin", "<=", "4", "S"), ("i2", "vancomycin", "=", "0.5", "R")]
    assert {r["pmid"] for r in got} == {"12345678"} and {r["biosample_accession"] for r in got} == {"SAMN12345", "SAMN12346"}
    assert cli.main(["scan", str(tmp_path), str(tmp_path / "scan")], spark) == 0
    assert len(_read(tmp_path / "scan" / "sheets")) == 2
    v1 = workflows.records_v1(workflows.extract(workflows.workbook_cells(spark, str(tmp_path))))
    assert v1.columns == schemas.RECORD_V1.fieldNames() and {r.accession_type for r in v1.collect()} == {"BioSample"}


def test_sparse_sheets_keep_their_rows(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook([["Strain", "BioSample", "vancomycin", "oxacillin"], ["i1", "SAMN12345", "<=4", 8], [None, "SAMN12346", 0.5, None], [None, None, 2, 16], ["Strain", "BioSample", "vancomycin", "oxacillin"]]))
    cells = workflows.workbook_cells(spark, str(tmp_path))
    got = {(r.isolate_id, r.drug, r.mic) for r in workflows.extract(cells).collect()}
    assert got == {("i1", "vancomycin", "4"), ("i1", "oxacillin", "8"), ("SAMN12346", "vancomycin", "0.5"), ("isolate_4", "vancomycin", "2"), ("isolate_4", "oxacillin", "16")}


def test_metadata_sheets_of_other_workbooks(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook([["Strain", "vancomycin"], ["i1", 4], ["i2", 8]]))
    (tmp_path / "b.xlsx").write_bytes(workbook([["Isolate", "Run", "Sample acc"], ["i1", "ERR100001", "SAMN1"], ["i2", "SRR200002", None], [None, None, "SAMN3"]]))
    (tmp_path / "c.xlsx").write_bytes(workbook([["Isolate", "Colour"], ["i1", "red"], ["i9", "blue"]]))
    cells = workflows.workbook_cells(spark, str(tmp_path))
    records, log = workflows.with_metadata(workflows.extract(cells), cells)
    assert {r.isolate_id: r.accession for r in records.collect()} == {"i1": "SAMN1,ERR100001", "i2": "SRR200002"}
    assert {r.sheet.rsplit("/", 1)[-1]: (r.candidate, r.n_rows) for r in log.collect()} == {"b.xlsx|One": (True, 3), "c.xlsx|One": (False, 0)}


class Stubborn(RuleProvider):
    """Begins with a column that isn't there, then with ids that are blank in places."""

    def propose(self, columns, errors, attempt, pass_no):
        spec = super().propose(columns, errors, attempt, pass_no)
        return TransformSpec(("Missing",), spec.drug_columns) if pass_no == 1 and attempt == 1 else spec


def test_attempts_learn_from_errors(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook([["Strain", "BioSample", "vancomycin"], ["i1", "SAMN12345", "<=4"], [None, None, 0.5], ["i3", "SAMN12347", "8"]]))
    cells = workflows.workbook_cells(spark, str(tmp_path)).cache()
    register("stubborn", Stubborn)
    (first, second), log = workflows.extract_with_attempts(cells, "stubborn", passes=2)
    assert sorted(r.isolate_id for r in first.collect()) == ["i1", "i3"] == sorted(r.isolate_id for r in second.collect())
    attempts = {(r.pass_no, r.attempt): (r.n_valid, r.errors) for r in log.collect()}
    assert attempts[0, 1] == (2, ["missing identifier"]) and attempts[0, 2] == (2, ["missing identifier"])
    assert attempts[1, 1][0] == 0 and attempts[1, 1][1][0].startswith("the transform failed") and attempts[1, 2][0] == 2
    spec = TransformSpec.from_json(log.where("pass_no = 0 and attempt = 2").first().spec)
    assert spec.id_columns == ("Strain", "BioSample") and spec.drug_columns == {"vancomycin": "vancomycin"}
    sinks.write_specs(log, str(tmp_path / "specs"))
    assert spark.read.json(str(tmp_path / "specs")).count() == 4
    with pytest.raises(ValueError, match="unknown provider"):
        provider("nobody")


def test_first_free_column_is_the_id(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook([["vancomycin", "Number", "Ward", "Organism"], [4, "n1", "w1", "S. aureus"], [8, "n2", "w2", None]]))
    cells = workflows.workbook_cells(spark, str(tmp_path))
    records = workflows.extract(cells)
    assert {(r.isolate_id, r.mic) for r in records.collect()} == {("n1", "4"), ("n2", "8")}
    roles, _ = workflows.classify_workbooks(cells)
    v1 = workflows.records_v1(records, workflows.organisms(cells, roles))
    assert {r.isolate_name: r.organism for r in v1.collect()} == {"n1": "S. aureus", "n2": None}
    data = sinks.mic_data(v1.withColumnsRenamed({"source_sheet": "sheet_name"}).withColumn("file_name", F.lit("a.xlsx")))
    assert len(data.columns) == 11 and {r.organism for r in data.collect()} == {"S. aureus", ""}


def test_evaluate_and_match(spark, tmp_path):
    names = schemas.RECORD_FINAL.fieldNames()
    record = lambda **k: [k.get(n, "") for n in names]
    records = _tsv(tmp_path / "r.tsv", [names, record(pmid="1", file_name="f", isolate_id="A 1", biosample_accession="SAMN1", drug="Vancomycin", mic="2.0", mic_sign="=", sir_call="S"), record(pmid="1", file_name="f", isolate_id="b", drug="x", sir_call="R")])
    truth = _tsv(tmp_path / "t.tsv", [["genome_id", "antibiotic", "resistant_phenotype", "measurement_sign", "measurement_value", *schemas.TRUTH_ACCESSIONS], ["g", "vancomycin", "Susceptible", "", "2", "SAMN1", "", "", "", ""]])
    assert cli.main(["evaluate", records, truth, str(tmp_path / "out")], spark) == 0
    metrics = {(r[0], r[1]): r[2] for r in _read(tmp_path / "out" / "metrics")}
    assert metrics["GENOME MATCHING", "Genome matched"] == "1" and metrics["MIC EXTRACTION", "Overall correct MIC"] == "100.00%"
    assert not (tmp_path / "out" / "errors").exists()
    strains = _tsv(tmp_path / "s.tsv", [["ordinal", "strain", "bioproject_accession", "biosample_accession", "sra_accession"], ["1", "a  1", "PRJNA1", "SAMN9", "SRR9"]])
    assert cli.main(["match", records, strains, str(tmp_path / "m"), "--fill"], spark) == 0
    filled = {r.isolate_id: (r.bioproject_accession, r.biosample_accession) for r in spark.read.parquet(str(tmp_path / "m/records")).collect()}
    assert filled == {"A 1": ("PRJNA1", "SAMN1"), "b": ("", "")}


def test_find(spark, tmp_path):
    (tmp_path / "p.txt").write_text("g1\t1234567\n7654321\n")
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "1234567.xml").write_text('<a><body>MIC by CLSI. Table 1 gives it. SAMN1</body><sec sec-type="data-availability">SAMN1</sec></a>')
    assert cli.main(["find", str(tmp_path / "p.txt"), str(tmp_path / "x"), str(tmp_path / "out")], spark) == 0
    rows = _read(tmp_path / "out" / "papers")
    got = {r[0]: dict(zip(rows[0], r, strict=False)) for r in rows[1:]}
    assert got["1234567"]["ast_location"] == "main_text_table" and got["1234567"]["accession_confirmed"] == "yes"
    assert got["7654321"]["ast_location"] == "no_fulltext"
