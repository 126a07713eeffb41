"""Consensus of several extraction passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.accession import format_combined, tokens
from ..functions.text import BLANK, computed, mic_of, null_if


def keyed(df: DataFrame) -> DataFrame:
    """Records with a drug and an id, under ``k_id`` (isolate, else accession) and ``k_drug``."""
    iso, acc, drug = (null_if(F.col(c), BLANK) for c in ("isolate_id", "accession", "drug"))
    # The filter would otherwise take copies of all that the columns are made of.
    return computed(df, {"k_id": F.coalesce(iso, acc), "k_drug": drug}).where("k_id is not null and k_drug is not null")


def _reasons() -> Column:
    one = lambda name, values: F.when(F.size(values) > 1, F.concat(F.lit(f"conflicting {name}: "), F.array_join(values, ",")))
    return F.concat_ws("; ", one("mic_sign", "signs"), one("mic", "mics"), one("sir_call", "calls"))


def consensus(df: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Retained and conflicting keys of records in ``order`` (a total order of passes and rows).

    Sets of signs, canonical values and calls per key, the first non-null of every other column, all accessions combined.
    Records are first reduced to one per key and distinct text of each measured column and accession, so that a key with very
    many records meets in a task only as its few distinct ones.
    """
    measured = ("accession", "mic_sign", "mic", "sir_call")
    at = F.struct(*order)
    rest = [c for c in df.columns if c not in (*measured, *order)]
    earliest = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(at.alias("at"), F.col(c).alias("v")))).alias(c)
    texts = keyed(df).groupBy("k_id", "k_drug", *[F.col(c).alias(f"v_{c}") for c in measured]).agg(
        *map(earliest, rest), F.min(at).alias("at"), F.count(F.lit(1)).alias("n")
    )
    v = lambda c: F.col(f"v_{c}")
    clean = computed(texts, {"c_sign": null_if(v("mic_sign"), BLANK), "c_text": null_if(v("mic"), BLANK), "c_call": F.upper(null_if(v("sir_call"), BLANK))}).withColumn("c_mic", mic_of(F.col("c_text")))
    as_set = lambda c, name: F.array_sort(F.collect_set(c)).alias(name)
    # A text of its own stays only where no record of the key has a value.
    own = lambda c, value: F.min(F.when(v(c).isNotNull() & F.col(value).isNull(), F.struct("at", v(c).alias("v"))))["v"].alias(c)
    # Retained keys need the ends of each set only; the sets are gathered for the reasons of conflicts.
    values = {"mic_sign": "c_sign", "mic": "c_mic", "sir_call": "c_call"}
    ends = [end(c).alias(f"{name}_{c}") for c in values.values() for name, end in (("low", F.min), ("high", F.max))]
    grouped = clean.groupBy("k_id", "k_drug").agg(
        *[F.min(c)["v"].alias(c) for c in rest], *[own(c, value) for c, value in values.items()], *ends, as_set("c_sign", "signs"), as_set("c_mic", "mics"), as_set("c_call", "calls"),
        F.array_sort(F.collect_set(F.when(v("accession").isNotNull(), F.struct("at", v("accession").alias("a"))))).alias("accs"), F.sum("n").alias("n_records"),
    )
    conflict = F.lit(False)
    for c in values.values():
        conflict = conflict | F.coalesce(F.col(f"low_{c}") != F.col(f"high_{c}"), F.lit(False))
    merged = F.flatten(F.transform("accs", lambda x: tokens(x["a"])))
    one = lambda c: F.coalesce(f"low_{values[c]}", c).alias(c)
    kept = grouped.where(~conflict).select("k_id", "k_drug", *rest, format_combined(merged).alias("accession"), *map(one, values))
    return kept, grouped.where(conflict).select("k_id", "k_drug", _reasons().alias("reason"), "n_records")


def passes(frames: list[DataFrame]) -> DataFrame:
    """Passes as one table with their number in ``pass_no``."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumn("pass_no", F.lit(i)) for i, f in enumerate(frames)])


def ensemble(frames: list[DataFrame], order: list[str]) -> tuple[DataFrame | None, DataFrame | None]:
    """No pass gives nothing, a single one comes back untouched; more of them go through ``consensus``."""
    used = [f for f in frames if f is not None]
    if len(used) < 2:
        return (used[0] if used else None), None
    return consensus(passes(used), ["pass_no", *order])
