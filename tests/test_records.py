"""Quality control, consensus, enrichment, matching and evaluation on small frames."""

import pytest
from pyspark.sql import functions as F

from assayflow.operators import enrich, ensemble, evaluate, match, qc, sets
from assayflow.providers import TransformSpec, provider

INNER = "isolate_id string, accession string, drug string, mic_sign string, mic string, sir_call string, notes string"


def test_qc(spark):
    rows = [
        ("i", None, "van", "=", "4", None, None), (None, "SAMN1", "van", None, None, "s", None), ("i", None, None, "=", "4", None, None), (None, " ", "van", "=", "4", None, None),
        ("i", None, "van", "~", "4", None, None), ("i", None, "van", "!=", "4mg/L", None, None), ("i", None, "van", None, None, "Susceptible", None), ("i", None, "van", "=", None, "R", None), ("i", None, "van", "=", "32/16", None, None),
    ]
    df = spark.createDataFrame(rows, INNER)
    valid, invalid = qc.split(df)
    assert (valid.count(), invalid.count()) == (4, 5)
    assert qc.errors(df).count() == 6
    assert qc.split(df.limit(0))[0].count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_quality_rules_read_each_value_once(spark):
    df = spark.createDataFrame([("i", None, "van", "=", "4", None, None)], INNER)
    for judged in (*qc.split(df), qc.errors(df)):
        lines = _plan(judged.where("size(split(mic, '/')) > 0")).split("\n")
        assert not any("RLIKE" in x and "Filter" in x or "trim(" in x and "Filter" in x for x in lines)
        assert sum(x.count("RLIKE") for x in lines) == 1
    odd = spark.createDataFrame([("i", None, "\u00a0", "\t=", "4\u2003", "\x1fs ", None), ("i", None, "van", "<\u00a0", "\x1c4 x", " NaN\n", None), ("\u3000", "none", "van", "", "", "é", None)], INNER)
    assert [r.errors for r in qc.with_errors(odd).collect()] == [["missing drug"], ["non-numeric mic \x1c4 x"], ["missing identifier", "invalid sir_call é"]]


def _passes(spark, *frames):
    return [spark.createDataFrame([(i, *r) for i, r in enumerate(f)], "row_idx int, " + INNER) for f in frames]


@pytest.mark.parametrize(
    ("a", "b", "kept"),
    [(("=", "4.0", "S"), ("=", "4", "s"), True), (("=", "4", None), ("=", "8", None), False), (("=", "4", "S"), ("=", "4", "R"), False), (("=", "4", None), ("<=", "4", None), False), ((None, None, "S"), ("=", "4", None), True)],
)
def test_ensemble(spark, a, b, kept):
    frames = _passes(spark, [("i", "ERR1", "van", *a, None)], [("i", "SAMN1", "van", *b, "n")])
    good, bad = ensemble.ensemble(frames, ["row_idx"])
    assert (good.count(), bad.count()) == (int(kept), int(not kept))
    if kept:
        row = good.first()
        assert (row.accession, row.notes, row.mic) == ("SAMN1,ERR1", "n", "4")


def test_consensus_computes_keys_once_and_gathers_no_sets_for_kept_keys(spark):
    frames = _passes(spark, [("i", "ERR1", "van", " ", "nan", "S", None), ("j", None, "van", None, None, " ", None), ("k", None, "van", "=", "4", None, None)], [("i", "err1", " van", None, None, "s", "n"), ("j", None, "van", " ", None, None, None), ("k", None, "van", "=", "8", "R", None)])
    good, bad = ensemble.ensemble(frames, ["row_idx"])
    assert {r.k_id: (r.accession, r.mic_sign, r.mic, r.sir_call) for r in good.collect()} == {"i": ("ERR1", " ", "nan", "S"), "j": (None, " ", None, " ")}
    assert [(r.k_id, r.reason, r.n_records) for r in bad.collect()] == [("k", "conflicting mic: 4,8", 2)]
    assert not any("trim(" in x and "Filter" in x for x in _plan(good).split("\n"))
    assert "collect_set(c_sign" not in _plan(good) and "collect_set(c_sign" in _plan(bad)


def test_ensemble_of_one_pass_is_untouched(spark):
    frame = _passes(spark, [("i", None, "van", "=", "4", None, None), ("i", None, "van", "=", "8", None, None)])[0]
    good, bad = ensemble.ensemble([frame, None], ["row_idx"])
    assert good is frame and bad is None
    assert ensemble.ensemble([], ["row_idx"]) == (None, None)


def test_enrichment(spark):
    df = spark.createDataFrame([("i1", "ERR100", "van", "=", "4", None, None), ("x", "ERR555", "van", "=", "4", None, "kept"), ("y", None, "van", "=", "4", None, None), ("i2", "SAMN9", "v", None, None, "S", None)], INNER)
    meta = spark.createDataFrame([("i1", "SAMN001", None), ("i1", "SRR200", "CP012345"), ("other", "SAMN999", "ERR555"), ("i2", "SRR1", None)], "isolate_id string, accession string, secondary_accession string")
    out = {r.isolate_id: (r.accession, r.notes) for r in enrich.enrich(df, meta).collect()}
    assert out == {"i1": ("SAMN001,CP012345,ERR100,SRR200", "original accession: ERR100"), "x": ("SAMN999,ERR555", "kept; original accession: ERR555"), "y": (None, None), "i2": ("SAMN9,SRR1", None)}
    assert enrich.apply_metadata(df, [meta]).count() == df.count()
    assert enrich.needs_enrichment(df).first().needed and not enrich.needs_enrichment(df.limit(0)).first().needed
    final = enrich.finalize(df, F.lit("/a/b.xlsx"), F.lit("S"), F.lit("1"))
    assert len(final.columns) == 16 and final.first().file_name == "b.xlsx"


def test_matching_prefers_exact_then_first_substring(spark):
    strains = spark.createDataFrame([(1, "ATCC 25923", "P1", "S1", ""), (2, "atcc  25923", "P2", "S2", "R2"), (3, "ST-398 x", "P3", "S3", "R3"), (4, "ST-398", "P4", "S4", "R4")], "ordinal int, strain string, bioproject_accession string, biosample_accession string, sra_accession string")
    isolates = spark.createDataFrame([("p", "f", "atcc 25923"), ("p", "f", "st-39"), ("p", "f", "my st-398 x!"), ("p", "f", "s"), ("p", "f", "zzz")], "pmid string, source_file string, isolate_id string")
    out = {r.isolate_id: (r.match_type, r.biosample_accession) for r in match.match_all(isolates, strains).collect()}
    assert out == {"atcc 25923": ("exact", "S1"), "st-39": ("fuzzy", "S3"), "my st-398 x!": ("fuzzy", "S3"), "s": ("no_match", ""), "zzz": ("no_match", "")}
    known = match.first_by_strain(strains)
    keys = isolates.select(F.col("isolate_id").alias("key"))
    strings = [r.key for r in known.collect()]
    for r in keys.select(F.lower("key").alias("key")).collect():
        near = [s for s in strings if len(r.key) >= 3 and len(s) >= 3 and (r.key in s or s in r.key)]
        got = [x.strain for x in match.match_fuzzy(keys.select(F.lower("key").alias("key")), known).where(F.col("key") == r.key).collect()]
        assert bool(got) == bool(near) and all(g.lower() in " ".join(near) for g in got)


def test_parts_are_looked_up_whole(spark):
    strains = spark.createDataFrame([(i, f"Lab#{i:06d}", "P", f"S{i}", "") for i in range(0, 600, 2)] + [(999, "aaa", "P", "S999", ""), (1000, "0001", "P", "S1000", "")], "ordinal int, strain string, bioproject_accession string, biosample_accession string, sra_accession string")
    names = [f"lab#{i:06d}" for i in range(1, 600, 2)] + [f"lab#{i:05d}" for i in range(60)] + [f"x{i}" for i in range(300)] + ["aaaaaa", "b#00", "b#0", "01", "xlab#000004x", "00010001"]
    known, keys = match.first_by_strain(strains), spark.createDataFrame([(n,) for n in names], "key string")
    strings = {r.key: (r.ordinal, r.strain) for r in known.collect()}
    want = {n: min(near)[1] for n in names if len(n) >= 3 and (near := [v for s, v in strings.items() if n in s or s in n])}
    fuzzy = match.match_fuzzy(keys, known)
    assert {r.key: r.strain for r in fuzzy.collect()} == want
    # No candidates that share a gram only, which numbered ids do with ever more others.
    assert "Contains(" not in _plan(fuzzy)


def _evaluated(spark, extracted):
    columns = "extracted_row int, pmid string, isolate_id string, drug string, mic_sign string, mic string, sir_call string, biosample_accession string, assembly_accession string, genbank_accessions string, refseq_accessions string, sra_accession string, other_accessions string"
    truth = "genome_id string, antibiotic string, resistant_phenotype string, measurement_sign string, measurement_value string, `genome.biosample_accession` string, `genome.assembly_accession` string, `genome.genbank_accessions` string, `genome.refseq_accessions` string, `genome.sra_accession` string"
    t = spark.createDataFrame([("g1", "vancomycin", "Susceptible", "", "2.0", "SAMN1", "GCA_1.1", None, None, None), ("g1", "rifampin", "", "<=", "0.5", "SAMN1", None, None, None, None), ("g2", "vancomycin", "R", None, None, "SAMN2", None, None, None, None), ("g3", "vancomycin", "R", None, None, "SAMN2", None, None, None, None)], truth)
    rows = [(i + 2, "p", "i", *r, None, None, None, None) for i, r in enumerate(extracted)]
    return evaluate.compare(spark.createDataFrame(rows, columns), t)


def test_evaluation(spark):
    out = _evaluated(
        spark,
        [("Vancomycin", "=", "2", "s", "SAMN1", None), ("vancomycin", "", "4", "R", None, "GCF_1.2"), ("rifampicin", None, None, None, "samn1", None), ("vancomycin", None, None, "SDD", "SAMN1", None), ("x", "=", "1", "S", "SAMN1", None), ("vancomycin", "=", "1", "S", "SAMN2", None), ("vancomycin", "=", "1", "S", "SAMN7", None), ("vancomycin", "=", "1", "S", None, None)],
    )
    got = [(r.genome_match_status, r.sir_result, r.mic_result) for r in out.orderBy("extracted_row").collect()]
    assert got == [
        ("MATCHED", "CORRECT", "CORRECT"), ("MATCHED", "INCORRECT", "INCORRECT"), ("MATCHED", "NOT_APPLICABLE", "MISSING_EXTRACTION"), ("MATCHED", "UNRECOGNIZED_CALL", "MISSING_EXTRACTION"), ("MATCHED", "NO_GT_DRUG", "NO_GT_DRUG"),
        ("AMBIGUOUS:g2,g3", "NOT_EVALUATED", "NOT_EVALUATED"), ("NO_GENOME_MATCH", "NOT_EVALUATED", "NOT_EVALUATED"), ("NO_ACCESSIONS", "NOT_EVALUATED", "NOT_EVALUATED"),
    ]
    assert qc.incorrect_rows(out).count() == 1
    with pytest.raises(ValueError, match="missing columns"):
        qc.incorrect_rows(out.drop("mic_result"))


def test_comparison_passes_over_records_once(spark):
    out = _evaluated(spark, [("Vancomycin", "=", "2", "s", "SAMN1", None), ("vancomycin", "", "4", "R", "none", None), ("vancomycin", "", "4", "R", None, ""), ("vancomycin", "", "4", "R", "", "SAMN7")])
    for df in (out, qc.incorrect_rows(out), evaluate.metrics_by_paper(out)):
        # The other scan is that of the distinct accessions.
        assert _plan(df).count("Scan ExistingRDD[extracted_row") == 2
    assert [r.genome_match_status for r in out.orderBy("extracted_row").collect()] == ["MATCHED", "NO_ACCESSIONS", "NO_ACCESSIONS", "NO_GENOME_MATCH"]


def test_metrics_of_nothing_are_zero(spark):
    m = evaluate.metrics(_evaluated(spark, [("x", "=", "1", "S", "SAMN1", None)]).limit(0)).first()
    assert m.n_rows == 0 and m.sir_accuracy is None


def test_transform_spec_and_providers(spark):
    df = spark.createDataFrame([("i1", "see SAMN12345", "4 (S)", "2-8"), ("", "x", None, "R")], "strain string, data string, VAN string, OXA string")
    spec = TransformSpec(("strain", "data"), {"VAN": "vancomycin", "OXA": "oxacillin"}, ("data",))
    got = {(r.isolate_id, r.drug): (r.accession, r.mic, r.sir_call) for r in spec.apply(df).collect()}
    assert got == {("i1", "vancomycin"): ("SAMN12345", "4", "S"), ("i1", "oxacillin"): ("SAMN12345", "8", None), ("x", "oxacillin"): (None, None, "R")}
    with pytest.raises(ValueError, match="unknown provider"):
        provider("nobody")


def test_runs(spark):
    a, b = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert [(r.k, r.side, r.n) for r in sets.run_diff(a, b).collect()] == [(1, "first", 1)]
    assert {r.k: r.same for r in sets.same_runs(a, b, "k").collect()} == {1: False, 2: True}
