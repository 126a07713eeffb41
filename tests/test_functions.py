"""Scalar functions on known input and output pairs."""

import pytest
from pyspark.sql import functions as F

from assayflow.functions import accession as A
from assayflow.functions import drugs as D
from assayflow.functions import text as X
from assayflow.functions.literals import is_dumped_collection
from assayflow.operators import unpivot


def values(spark, f, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.out for r in df.select("i", f(F.col("v")).alias("out")).orderBy("i").collect()]


def test_parse_mic(spark):
    cases = {
        ">64": (">", "64"), "<=0.5": ("<=", "0.5"), "32/16": ("=", "32/16"), "4": ("=", "4"), "<0.25/4.75": ("<", "0.25/4.75"), " 8 ": ("=", "8"), "32 / 16": ("=", "32/16"),
        "S": None, "ND": None, "-": None, "": None, None: None, "Susceptible": None, "4 - 64": None, "4 mg/L": None, "≤2": None, "n/a": None, "abc": None,
    }
    out = values(spark, X.parse_mic, list(cases))
    assert [(r.operator, r.value) if r.value else None for r in out] == list(cases.values())


def test_numbers(spark):
    assert values(spark, X.normalize_number, ["2", "2.0", "0.50", "1e3", "abc", "nan", None, "0.00005", "123456.789", "32/16", "0", "-0.5", "1234567890123.5", "4d"]) == [
        "2", "2", "0.5", "1000", "abc", "", "", "5e-05", "123456.789", "32/16", "0", "-0.5", "1.23456789012e+12", "4d",
    ]
    assert values(spark, X.normalize_mic, ["4.0", "0.50", "32.0/16", "ND", "none", None, "123456.789", "8/a", "1000000"]) == ["4", "0.5", "32/16", "ND", None, None, "123457", "8/a", "1000000"]


def test_extreme_numbers(spark):
    cases = ["1e400", "-1e400", "inf", "-Infinity", "1e300", "-1e300", "1e19", "12345678901234567890", "-9223372036854775808", "4611686018427387904", "1.5e30", "1e-300", "1.5E-120", "1e37", "5e307"]
    want = ["inf", "-inf", "inf", "-inf", "1e+300", "-1e+300", "10000000000000000000", "12345678901234567168", "-9223372036854775808", "4611686018427387904", str(int(1.5e30)), "1e-300", "1.5e-120", str(int(1e37)), "5e+307"]
    assert values(spark, X.normalize_number, cases) == want
    assert values(spark, X.normalize_mic, [*cases, "1e400/1e19"]) == [*want, "inf/10000000000000000000"]
    assert values(spark, X.strip, ["\x1c \u3000a b\u2003\n", "\xa0", "", None]) == ["a b", "", "", None]


def test_signs_calls_and_drugs(spark):
    assert values(spark, X.normalize_sign, ["≤", "≥", "==", "=", "<", "~", None, " > "]) == ["<=", ">=", "=", "=", "<", "", "", ">"]
    assert values(spark, X.normalize_sir, ["s", "Resistant", "non–susceptible", "NR", "SDD", None, "intermediate", "non  resistance"]) == ["S", "R", "NS", "NR", "", "", "I", "NR"]
    assert values(spark, X.normalize_drug, ["Rifampicin", "Co-trimoxazole", "trimethoprim  sulfamethoxazole", "none", " Oxacillin "]) == ["rifampin", "trimethoprim/sulfamethoxazole", "trimethoprim/sulfamethoxazole", "", "oxacillin"]


def test_ids_and_paths(spark):
    assert values(spark, X.normalize_id, ["  A  b C "]) == ["a b c"]
    assert values(spark, X.repair_numeric_id, ["12.0", "12.5", "x.0"]) == ["12", "12.5", "x.0"]
    assert values(spark, X.safe_file_name, ["Table 1 (a)", "__", "é"]) == ["Table_1_a", "table", "table"]
    assert values(spark, X.pmid_in_path, ["/tmp/papers/pmid_27381390", "/tmp/none"]) == ["27381390", "UNKNOWN"]
    assert values(spark, X.pmid_of_path, ["/a/1234567/b.xlsx", "/a/pmid_1234567/b", "/12345678/7654321"]) == ["1234567", None, "7654321"]
    assert values(spark, X.strip_fence, ['```json\n{"a": 1}\n```', "{}"]) == ['{"a": 1}', "{}"]


def test_accession_tokens_and_split(spark):
    text = "PRJNA12345,SAMN001,SAMEA002,GCA_001.1,NZ_CP012345.1,SRR100,ERR200,CP099999,XYZ123"
    df = spark.createDataFrame([(text,)], "v string")
    row = df.select(A.typed_split(F.col("v")).alias("s")).select("s.*").first().asDict()
    assert row == {
        "bioproject_accession": "PRJNA12345", "biosample_accession": "SAMEA002,SAMN001", "assembly_accession": "GCA_001.1", "genbank_accessions": "CP099999",
        "refseq_accessions": "NZ_CP012345.1", "sra_accession": "ERR200,SRR100", "other_accessions": "XYZ123",
    }
    assert values(spark, A.tokens, ["a, 'b';none  \"c\"", "nan", None, "-"]) == [["a", "b", "c"], [], [], []]
    assert values(spark, lambda c: A.format_combined(A.tokens(c)), ["ERR100,SAMN001;SRR200,err100", ""]) == ["SAMN001,ERR100,SRR200", None]


def test_accession_kinds(spark):
    assert values(spark, A.is_biosample, ["SAMN1", "SAMEA2", "SAME3", "SAMD4", "SAMN1.1", "GCA_1", "ERR1", "JYTM01", None]) == [True] * 5 + [False] * 4
    assert values(spark, A.accession_type, ["SAMN1", "PRJEB1", "SRR1", "ERX1", "SAMD1", "", None]) == ["BioSample", "BioProject", "SRA_Run", "SRA_Experiment", "Accession", None, None]
    assert [sorted(v) for v in values(spark, A.variants, ["GCF_001.1", "gca_2", "SAMN1", "nan"])] == [["GCA_001", "GCA_001.1", "GCF_001", "GCF_001.1"], ["GCA_2", "GCF_2"], ["SAMN1"], []]


def test_drug_headers(spark):
    assert values(spark, D.drug_of_header, ["Vancomycin MIC (mg/L)", "SXT", "isolate", "trimethoprim/sulfamethoxazole"]) == ["vancomycin", "trimethoprim/sulfamethoxazole", None, "trimethoprim/sulfamethoxazole"]
    assert len(D.ANTIBIOTICS) == 52
    assert values(spark, lambda c: D.split_combined(c, F.lit("EM/CLDM")), ["4/8", "4"]) == [[("EM", "4"), ("CLDM", "8")], [("EM", "4"), ("CLDM", None)]]


@pytest.mark.parametrize(("raw", "expected"), [("2–4", ("=", "4", None)), ("8 (R)", ("=", "8", "R")), ("S", (None, None, "S")), ("≤0.5", ("<=", "0.5", None)), ("ND", (None, None, None)), (None, (None, None, None)), ("64R", ("=", "64", "R"))])
def test_cells(spark, raw, expected):
    r = values(spark, unpivot.parse_cell, [raw])[0]
    assert (r.mic_sign, r.mic, r.sir_call) == expected


def test_dumped_collections(spark):
    assert values(spark, is_dumped_collection, ["('4', nan)", "[1]", "{}", "(R)", "4", None, "("]) == [True, True, True, False, False, False, False]


def test_plain_numbers_keep_their_form(spark):
    cases = ["0", "7", "999999999999999", "9007199254740993", "1234567890123456789", "0.0", "0.000", "10.0", "12345678.125", "123456789.125", "0.001", "0.0001", "007", "1.", ".5", "+4", "4D", "iNf", "Info", "4/8", "10/20.50", "128.125", "1024.125", "1/", "x"]
    number = ["0", "7", "999999999999999", "9007199254740992", "1234567890123456768", "0", "0", "10", "12345678.125", "123456789.125", "0.001", "0.0001", "7", "1", "0.5", "4", "4d", "inf", "info", "4/8", "10/20.50", "128.125", "1024.125", "1/", "x"]
    mic = ["0", "7", "999999999999999", "9007199254740992", "1234567890123456768", "0", "0", "10", "1.23457e+07", "1.23457e+08", "0.001", "0.0001", "7", "1", "0.5", "4", "4D", "inf", "Info", "4/8", "10/20.5", "128.125", "1024.13", "1/", "x"]
    assert values(spark, X.normalize_number, cases) == number
    assert values(spark, X.normalize_mic, cases) == mic
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string").withColumns({"n": X.number_of(F.col("c")), "m": X.mic_of(F.col("c"))})
    assert [(r.n, r.m) for r in df.orderBy("i").collect()] == list(zip(number, mic, strict=True))
