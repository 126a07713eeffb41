"""Evaluation of extracted records against a curated truth table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.accession import TYPED_COLUMNS, split_variants
from ..functions.text import computed, drug_of, normalize_drug, normalize_number, normalize_sign, normalize_sir, number_of, scorer_clean, sign_of, sir_of
from ..schemas import TRUTH_ACCESSIONS

EXTRACTED_ACCESSIONS = tuple(c for c in TYPED_COLUMNS if c != "bioproject_accession")


def _all_variants(columns) -> Column:
    return F.array_distinct(F.flatten(F.array(*[split_variants(F.col(f"`{c}`")) for c in columns])))


def truth_index(truth: DataFrame) -> DataFrame:
    """Distinct (accession variant, genome)."""
    genome = scorer_clean(F.col("genome_id"))
    return truth.select(genome.alias("genome"), F.explode(_all_variants(TRUTH_ACCESSIONS)).alias("acc")).where("genome <> ''").distinct()


def _combination(columns: list[str]) -> dict[str, Column]:
    """``combo``, one text for each combination of accession columns, and ``combo_hash``.

    Records without accessions have an empty ``combo`` and are spread by a hash of themselves, so that no task gets them all.
    """
    given = [F.coalesce(F.col(c), F.lit("")) for c in EXTRACTED_ACCESSIONS]
    empty = F.concat(*given) == ""
    text = F.concat(*[x for v in given for x in (F.length(v).cast("string"), F.lit(":"), v)])
    return {"combo": F.when(empty, "").otherwise(text), "combo_hash": F.when(empty, F.xxhash64(*[F.col(f"`{c}`") for c in columns])).otherwise(F.xxhash64(*given))}


def _judged(extracted: DataFrame, truth: DataFrame) -> DataFrame:
    """Status, genome and accessions of each distinct combination of accession columns."""
    combos = extracted.select(*EXTRACTED_ACCESSIONS).distinct()
    known = truth_index(truth).select("genome", F.col("acc").alias("t_acc"))
    found = (
        computed(combos, _combination(list(EXTRACTED_ACCESSIONS))).select("combo", "combo_hash", F.explode_outer(_all_variants(EXTRACTED_ACCESSIONS)).alias("acc"))
        .join(known, F.col("acc") == F.col("t_acc"), "left").groupBy("combo", "combo_hash")
        .agg(F.count("acc").alias("n"), F.array_sort(F.collect_set("genome")).alias("genomes"), F.array_sort(F.collect_set("t_acc")).alias("found"))
    )
    one = F.size("genomes") == 1
    status = (
        F.when(F.col("n") == 0, "NO_ACCESSIONS").when(F.size("genomes") == 0, "NO_GENOME_MATCH")
        .when(one, "MATCHED").otherwise(F.concat(F.lit("AMBIGUOUS:"), F.array_join("genomes", ",")))
    )
    return found.select(
        F.col("combo").alias("j_combo"), F.col("combo_hash").alias("j_hash"), status.alias("j_status"), F.when(one, F.col("genomes")[0]).alias("j_genome"), F.when(one, F.array_join("found", ",")).alias("j_accessions")
    )


def _matched(extracted: DataFrame, judged: DataFrame, *more: str) -> DataFrame:
    keyed = computed(extracted, _combination(extracted.columns))
    return keyed.join(judged, (F.col("combo_hash") == F.col("j_hash")) & (F.col("combo") == F.col("j_combo")), "left").select(
        *extracted.columns, F.coalesce("j_status", F.lit("NO_ACCESSIONS")).alias("genome_match_status"), F.coalesce("j_genome", F.lit("")).alias("matched_genome"),
        F.coalesce("j_accessions", F.lit("")).alias("matched_accessions"), *more,
    )


def match_genomes(extracted: DataFrame, truth: DataFrame) -> DataFrame:
    """Add ``genome_match_status``, ``matched_genome`` and ``matched_accessions`` to every record.

    Matching is done once per distinct combination of accession columns,
    not per record, and joined back on that combination. Records are read twice, once for the combinations.
    """
    return _matched(extracted, _judged(extracted, truth))


def truth_sets(truth: DataFrame) -> DataFrame:
    """Per genome and normalised drug the sets of calls and of (sign, value) pairs, aggregated before any join."""
    clean = truth.select(
        scorer_clean(F.col("genome_id")).alias("t_genome"), normalize_drug(F.col("antibiotic")).alias("t_drug"), scorer_clean(F.col("resistant_phenotype")).alias("raw"),
        normalize_sir(F.col("resistant_phenotype")).alias("sir"), normalize_number(F.col("measurement_value")).alias("value"), normalize_sign(F.col("measurement_sign")).alias("sign"),
    )
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    mic = F.when(F.col("value") != "", F.struct(F.coalesce(given("sign"), F.lit("=")).alias("sign"), "value"))
    as_set = lambda x, name: F.array_sort(F.collect_set(x)).alias(name)
    return clean.where("t_genome <> '' and t_drug <> ''").groupBy("t_genome", "t_drug").agg(as_set(given("raw"), "t_raw"), as_set(given("sir"), "t_sir"), as_set(mic, "t_mic"))


def _drugs_of_genomes(truth: DataFrame) -> DataFrame:
    """Per genome a map of its drugs to what the truth says, as sets and as texts."""
    text = lambda x: F.coalesce(F.array_join(x, ","), F.lit(""))
    part = lambda name: text(F.array_sort(F.array_distinct(F.transform("t_mic", lambda m: m[name])))).alias(name)
    drug = F.struct(text("t_raw").alias("raw"), text("t_sir").alias("sir"), part("sign"), part("value"), F.col("t_sir").alias("sirs"), F.col("t_mic").alias("mics"))
    return truth_sets(truth).groupBy("t_genome").agg(F.map_from_entries(F.collect_list(F.struct("t_drug", drug))).alias("t_drugs"))


def _with_drugs(judged: DataFrame, truth: DataFrame) -> DataFrame:
    """Combinations with the truth of their genome; those without a genome are spread over the tasks."""
    drugs = _drugs_of_genomes(truth).withColumn("t_part", F.lit(0))
    part = F.when(F.col("j_genome").isNull(), 1 + F.pmod("j_hash", F.lit(1009))).otherwise(0).cast("int")
    keyed = computed(judged, {"j_part": part, "j_key": F.coalesce("j_genome", F.lit(""))})
    return keyed.join(drugs, (F.col("j_part") == F.col("t_part")) & (F.col("j_key") == F.col("t_genome")), "left")


def compare(extracted: DataFrame, truth: DataFrame) -> DataFrame:
    """The 20 comparison columns of every extracted record (``extracted_row`` is carried along).

    The truth of a genome travels with the combinations of accession columns, so that records are joined once, and with few rows.
    Each cleaned value, and each result, is computed once a record.
    """
    joined = _matched(extracted, _with_drugs(_judged(extracted, truth), truth), "t_drugs")
    clean = computed(joined, {"x_drug": scorer_clean(F.col("drug")), "x_sir_raw": scorer_clean(F.col("sir_call")), "x_sign_raw": scorer_clean(F.col("mic_sign")), "x_mic_raw": scorer_clean(F.col("mic"))})
    sign0 = sign_of(F.col("x_sign_raw"))
    normal = clean.withColumns(
        {"drug_key": drug_of(F.col("x_drug")), "x_sir": sir_of(F.col("x_sir_raw")), "x_value": number_of(F.col("x_mic_raw")),
         "x_sign": F.when((F.col("x_mic_raw") != "") & (sign0 == ""), "=").otherwise(sign0)}
    )
    known = normal.withColumn("t", F.try_element_at("t_drugs", F.col("drug_key")))
    matched, has_drug = F.col("genome_match_status") == "MATCHED", F.col("t").isNotNull()
    sir_raw, sir, sign, value = (F.col(c) for c in ("x_sir_raw", "x_sir", "x_sign", "x_value"))
    t_sir, t_mic = F.size("t.sirs") > 0, F.size("t.mics") > 0
    before = lambda x: F.when(~matched, "NOT_EVALUATED").when(~has_drug, "NO_GT_DRUG").otherwise(x)
    sir_result = (
        F.when((sir_raw != "") & ~t_sir, "NO_GT_VALUE").when((sir_raw != "") & (sir == ""), "UNRECOGNIZED_CALL")
        .when((sir_raw != "") & F.array_contains("t.sirs", sir), "CORRECT").when(sir_raw != "", "INCORRECT")
        .when(t_sir, "MISSING_EXTRACTION").otherwise("NOT_APPLICABLE")
    )
    pair_found = F.array_contains("t.mics", F.struct(sign.alias("sign"), value.alias("value")))
    mic_result = (
        F.when((value != "") & ~t_mic, "NO_GT_VALUE").when((value != "") & pair_found, "CORRECT").when(value != "", "INCORRECT")
        .when(t_mic, "MISSING_EXTRACTION").otherwise("NOT_APPLICABLE")
    )
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return computed(known, {"sir_result": before(sir_result), "mic_result": before(mic_result)}).select(
        "extracted_row", text("pmid").alias("pmid"), text("isolate_id").alias("isolate_id"), text("drug").alias("drug"), F.col("drug_key").alias("normalized_drug"),
        F.col("matched_genome").alias("genome_id"), "matched_accessions", "genome_match_status", sir_raw.alias("extracted_sir_raw"), sir.alias("extracted_sir"),
        text("t.raw").alias("ground_truth_sir_raw"), text("t.sir").alias("ground_truth_sir"), "sir_result",
        F.col("x_sign_raw").alias("extracted_mic_sign_raw"), F.col("x_mic_raw").alias("extracted_mic_raw"), sign.alias("extracted_mic_sign"), value.alias("extracted_mic"),
        text("t.sign").alias("ground_truth_mic_sign"), text("t.value").alias("ground_truth_mic"), "mic_result",
    )


_SIR = ("CORRECT", "INCORRECT", "MISSING_EXTRACTION", "UNRECOGNIZED_CALL", "NO_GT_VALUE", "NOT_APPLICABLE", "NO_GT_DRUG", "NOT_EVALUATED")
_MIC = tuple(r for r in _SIR if r != "UNRECOGNIZED_CALL")


def count_columns() -> list[Column]:
    status = F.col("genome_match_status")
    count = lambda x, name: F.count_if(x).alias(name)
    return [
        F.count(F.lit(1)).alias("n_rows"), count(status == "MATCHED", "matched"), count(status == "NO_GENOME_MATCH", "no_match"),
        count(status == "NO_ACCESSIONS", "no_accessions"), count(status.startswith("AMBIGUOUS"), "ambiguous"),
        *[count(F.col("sir_result") == r, f"sir_{r.lower()}") for r in _SIR], *[count(F.col("mic_result") == r, f"mic_{r.lower()}") for r in _MIC],
    ]


def metrics(compared: DataFrame, *by: str) -> DataFrame:
    """All counts and ratios in one pass, over everything or per ``by``; a ratio with a zero denominator is null."""
    return _with_ratios(compared.groupBy(*by).agg(*count_columns()))


def metrics_by_paper(compared: DataFrame) -> DataFrame:
    """The same counts and ratios per paper and, with a null pmid, over all, from one rollup."""
    return _with_ratios(compared.rollup("pmid").agg(*count_columns()))


def _with_ratios(grouped: DataFrame) -> DataFrame:
    c = F.col
    derived = {
        "sir_compared": c("sir_correct") + c("sir_incorrect"),
        "sir_available": c("sir_correct") + c("sir_incorrect") + c("sir_missing_extraction") + c("sir_unrecognized_call"),
        "sir_extracted": c("sir_correct") + c("sir_incorrect") + c("sir_unrecognized_call") + c("sir_no_gt_value"),
        "mic_compared": c("mic_correct") + c("mic_incorrect"),
        "mic_available": c("mic_correct") + c("mic_incorrect") + c("mic_missing_extraction"),
        "mic_extracted": c("mic_correct") + c("mic_incorrect") + c("mic_no_gt_value"),
    }
    ratios = {
        "match_rate": F.try_divide("matched", "n_rows"),
        "sir_accuracy": F.try_divide("sir_correct", "sir_compared"), "sir_coverage": F.try_divide("sir_compared", "sir_available"), "sir_overall": F.try_divide("sir_correct", "sir_available"),
        "mic_accuracy": F.try_divide("mic_correct", "mic_compared"), "mic_coverage": F.try_divide("mic_compared", "mic_available"), "mic_overall": F.try_divide("mic_correct", "mic_available"),
    }
    return grouped.withColumns(derived).withColumns(ratios)


# The report's layout as (section, metric, column, whether it is a percentage).
REPORT = (
    ("GENOME MATCHING", "Extracted rows", "n_rows", False),
    ("GENOME MATCHING", "Genome matched", "matched", False),
    ("GENOME MATCHING", "No genome match", "no_match", False),
    ("GENOME MATCHING", "No accessions supplied", "no_accessions", False),
    ("GENOME MATCHING", "Ambiguous genome match", "ambiguous", False),
    ("GENOME MATCHING", "Genome match rate", "match_rate", True),
    ("GENOME + DRUG MATCHING", "Matched genome, missing GT drug", "sir_no_gt_drug", False),
    ("S/I/R/NS/NR EXTRACTION", "LLM categorical calls", "sir_extracted", False),
    ("S/I/R/NS/NR EXTRACTION", "Correct calls", "sir_correct", False),
    ("S/I/R/NS/NR EXTRACTION", "Incorrect calls", "sir_incorrect", False),
    ("S/I/R/NS/NR EXTRACTION", "Missing LLM calls", "sir_missing_extraction", False),
    ("S/I/R/NS/NR EXTRACTION", "Unrecognized LLM calls", "sir_unrecognized_call", False),
    ("S/I/R/NS/NR EXTRACTION", "Extracted calls without GT", "sir_no_gt_value", False),
    ("S/I/R/NS/NR EXTRACTION", "Neither side has SIR value", "sir_not_applicable", False),
    ("S/I/R/NS/NR EXTRACTION", "Drug absent from GT", "sir_no_gt_drug", False),
    ("S/I/R/NS/NR EXTRACTION", "Genome not evaluable", "sir_not_evaluated", False),
    ("S/I/R/NS/NR EXTRACTION", "Categorical rows compared", "sir_compared", False),
    ("S/I/R/NS/NR EXTRACTION", "GT categorical values avail.", "sir_available", False),
    ("S/I/R/NS/NR EXTRACTION", "Accuracy when comparable", "sir_accuracy", True),
    ("S/I/R/NS/NR EXTRACTION", "LLM categorical coverage", "sir_coverage", True),
    ("S/I/R/NS/NR EXTRACTION", "Overall correct extraction", "sir_overall", True),
    ("MIC EXTRACTION", "LLM MIC values", "mic_extracted", False),
    ("MIC EXTRACTION", "Correct MICs", "mic_correct", False),
    ("MIC EXTRACTION", "Incorrect MICs", "mic_incorrect", False),
    ("MIC EXTRACTION", "Missing LLM MICs", "mic_missing_extraction", False),
    ("MIC EXTRACTION", "Extracted MICs without GT", "mic_no_gt_value", False),
    ("MIC EXTRACTION", "Neither side has MIC value", "mic_not_applicable", False),
    ("MIC EXTRACTION", "Drug absent from GT", "mic_no_gt_drug", False),
    ("MIC EXTRACTION", "Genome not evaluable", "mic_not_evaluated", False),
    ("MIC EXTRACTION", "MIC rows compared", "mic_compared", False),
    ("MIC EXTRACTION", "GT MIC values available", "mic_available", False),
    ("MIC EXTRACTION", "MIC accuracy when comparable", "mic_accuracy", True),
    ("MIC EXTRACTION", "LLM MIC coverage", "mic_coverage", True),
    ("MIC EXTRACTION", "Overall correct MIC", "mic_overall", True),
)


def metrics_long(measured: DataFrame) -> DataFrame:
    """One row of metrics as (Section, Metric, Value); ratios without a denominator are left out."""
    value = lambda c, percent: F.format_string("%.2f%%", F.col(c) * 100) if percent else F.col(c).cast("string")
    rows = F.array(*[F.struct(F.lit(s).alias("Section"), F.lit(m).alias("Metric"), F.when(F.col(c).isNotNull(), value(c, p)).alias("Value")) for s, m, c, p in REPORT])
    return measured.select(F.inline(rows)).where("Value is not null")


def parse_report(lines: DataFrame) -> DataFrame:
    """Metrics read back from text reports with columns ``path``, ``line_no`` and ``line``; ``path, line_no, Section, Metric, Value``.

    A line after an odd number of rules of ``=`` names the section of the lines that follow in its report.
    """
    w = Window.partitionBy("path").orderBy("line_no")
    rule = F.col("line").rlike(r"^=+$")
    rules = F.sum(rule.cast("int")).over(w)
    titled = lines.withColumn("title", F.when(~rule & (rules % 2 == 1), F.trim("line")))
    carried = titled.withColumn("Section", F.last("title", ignorenulls=True).over(w))
    parts = F.split("line", ":", 2)
    pair = carried.where(F.size(parts) == 2).select("path", "line_no", "Section", F.trim(parts[0]).alias("Metric"), F.trim(parts[1]).alias("Value"))
    return pair.where("Section is not null and Metric <> '' and Value <> ''")
