"""Operator 7, language identification by hierarchical discrimination.

First the language family is predicted, then one-versus-one linear support
vector machines separate the languages within that family.  Features are counts
of byte trigrams of the lower-cased whole text, hashed into ``BUCKETS`` cells and
scaled to unit length.

Fitting: executors turn the sampled texts, whole ones, into sparse features; only these
reach the driver, ``SAMPLE_PER_LANGUAGE`` rows of a language at most.  The weights go to the
executors in one broadcast, of ``BUCKETS`` numbers for each pair of families, and of languages of a family.

Edge cases: a null text, or one without any letter, is ``und`` with score 0, is not learned
from and takes no place in the sample; with no labelled row at all every text is ``und``; null labels are not learned from;
a language not in ``FAMILIES`` forms a family of its own; repeated rows are learned from once and
predicted alike; a column named as ``out`` is replaced, other columns pass through untouched.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import trimmed

BUCKETS = 1 << 14
#: Bound of the sample that the machines are fitted on, in rows of a language; their texts and all predictions are whole.
SAMPLE_PER_LANGUAGE = 300
#: Parts in which a language's rows are ranked first.
PARTS = 32
UNDETERMINED = "und"
# Families of languages.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "pl": "slavic", "cs": "slavic", "uk": "slavic", "bg": "slavic",
}
_LETTER = regex.compile(r"\p{L}")
#: Bytes of a text whose trigrams are counted at a time, which bounds the memory for very long ones.
_PART = 1 << 22

Sparse = tuple[np.ndarray, np.ndarray]


def features(text: str) -> Sparse:
    """Cells in rising order and their values."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), dtype=np.uint8)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, max(len(raw) - 2, 0), _PART):
        part = raw[at : at + _PART + 2].astype(np.uint32)
        grams = (part[:-2] << 16) | (part[1:-1] << 8) | part[2:]
        counts += np.bincount((grams * np.uint32(2654435761)) >> np.uint32(18), minlength=BUCKETS)
    cells = np.flatnonzero(counts)
    values = counts[cells].astype(np.float32)
    return cells.astype(np.uint16), values / max(float(np.sqrt(values @ values)), 1e-12)


def fit_svm(rows: list[Sparse], y: np.ndarray, c: float = 10.0, epochs: int = 30) -> np.ndarray:
    """Weights of a linear SVM with hinge loss, by dual coordinate descent; the last weight is that of a constant feature, the bias."""
    w, alpha = np.zeros(BUCKETS + 1, dtype=np.float32), np.zeros(len(rows))
    norms = np.array([float(v @ v) + 0.25 for _, v in rows])
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            cells, values = rows[i]
            margin = float(w[cells] @ values) + 0.5 * float(w[-1])
            new = min(max(alpha[i] - (y[i] * margin - 1) / norms[i], 0.0), c)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                moved = max(moved, abs(step))
                w[cells] += np.float32(step) * values
                w[-1] += np.float32(0.5 * step)
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


class Model:
    """A one-versus-one machine for each pair of families and each pair of languages in a family."""

    def __init__(self, rows: list[Sparse], labels: list[str]):
        lang, family = np.array(labels, dtype=object), np.array([FAMILIES.get(v, v) for v in labels], dtype=object)
        self.families = sorted(set(family))
        self.members = {f: sorted(set(lang[family == f])) for f in self.families}
        self.pairs: list[tuple[str, str, str]] = []
        weights = []
        for level, groups, names in [("family", family, self.families), *(("language", lang, m) for m in self.members.values())]:
            for a, b in itertools.combinations(names, 2):
                own = np.flatnonzero((groups == a) | (groups == b))
                weights.append(fit_svm([rows[i] for i in own], np.where(groups[own] == a, 1.0, -1.0)))
                self.pairs.append((level, a, b))
        self.weights = np.stack(weights, 1) if weights else np.zeros((BUCKETS + 1, 0), np.float32)

    def _choose(self, level: str, names: list[str], margin: dict) -> tuple[str, float]:
        if len(names) == 1:
            return names[0], 1.0
        votes = {n: [0, 0.0, np.inf] for n in names}
        for a, b in itertools.combinations(names, 2):
            m = margin[level, a, b]
            for name, own in ((a, m), (b, -m)):
                votes[name] = [votes[name][0] + (own > 0), votes[name][1] + own, min(votes[name][2], own)]
        best = max(names, key=lambda n: (votes[n][0], votes[n][1], n))
        return best, float(1 / (1 + np.exp(-3 * votes[best][2])))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        cells, values = features(text)
        margins = values @ self.weights[cells] + 0.5 * self.weights[-1]
        margin = {p: float(m) for p, m in zip(self.pairs, margins, strict=True)}
        family, sure = self._choose("family", self.families, margin)
        lang, surer = self._choose("language", self.members[family], margin)
        return lang, min(max(sure * surer, 0.0), 1.0)


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that is never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, id_col: str = "doc_id", per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """``lang, id, text`` of at most ``per_language`` rows of each language outside the held-out fold, without repeats.

    Those with the smallest hash of their id, among texts with a letter.  Only ids, labels and hashes of texts
    are ranked, a bounded number of each partition; the chosen texts are found by a broadcast of that bounded list.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(id_col))
    rows = usable.select(F.col("lang").alias("lang"), F.col(id_col).alias("id"), F.xxhash64("text").alias("h"), F.col("text").alias("text"))
    order = (F.xxhash64("id"), "id", "h")
    # First the smallest of each of ``PARTS`` parts of a language, so that the task with all of a language has a bounded number of rows.
    chosen = rows.select("lang", "id", "h", F.pmod(F.xxhash64("h", "id"), F.lit(PARTS)).alias("part")).distinct()
    for by in (("lang", "part"), ("lang",)):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        chosen = chosen.withColumn("place", place).where(F.col("place") <= per_language).drop("place")
    chosen = chosen.drop("part")
    wanted = F.broadcast(chosen.select(F.col("lang").alias("c_lang"), F.col("id").alias("c_id"), F.col("h").alias("c_h")))
    same = (F.col("lang") == F.col("c_lang")) & F.col("id").eqNullSafe(F.col("c_id")) & (F.col("h") == F.col("c_h"))
    return rows.join(wanted, same, "left_semi")


def fit(docs: DataFrame, id_col: str = "doc_id", per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on ``sample``; executors compute the features, of which each distinct row comes to the driver once."""

    @F.pandas_udf("cells binary, values binary")
    @trimmed
    def sparse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [features(t) for t in texts]
            yield pd.DataFrame({"cells": [c.tobytes() for c, _ in found], "values": [v.tobytes() for _, v in found]})

    seen = sample(docs, id_col, per_language).withColumn("x", sparse("text")).select("lang", "id", "h", "x").dropDuplicates(["lang", "id", "h"])
    rows = seen.orderBy("lang", F.xxhash64("id"), "id", "h").select("lang", "x.*").collect()
    return Model([(np.frombuffer(r["cells"], np.uint16), np.frombuffer(r["values"], np.float32)) for r in rows], [r["lang"] for r in rows])


def predict(docs: DataFrame, model: Model, text_col: str = "text", out: str = "language") -> DataFrame:
    """Add a struct column ``out`` with ``lang_pred`` and ``score``, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    @trimmed
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn(out, language(F.col(text_col)))
