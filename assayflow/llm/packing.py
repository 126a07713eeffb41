"""Operator 1, best-fit packing by minimum bin slack.

Documents are tokenised and cut into pieces of at most ``capacity`` ids.
A histogram of piece lengths, at most ``capacity`` rows whatever the input, is all that
reaches the driver.  There, bin by bin, a bitset subset-sum dynamic programme
over the available lengths finds the fullest feasible combination containing the
longest length left, which is then removed, as often as the counts allow at a time.
The plan (combination, repeats) has a size bounded by ``capacity`` alone.  Pieces
of one length are numbered without gaps by per-bucket counts, and a
number decides a piece's sequence and offset; no length, however frequent, is gathered in a task.

Edge cases: a null text is an empty one, which has only the end id; a null or
repeated doc_id is packed like any other row; an empty table gives no rows;
other columns are not carried along, so their names don't matter.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import checkpointed, python_batches, slices, trim, trimmed

CAPACITY, END_ID = 1024, 2
#: Entries of the cache of encoded words in each Python worker, and characters of the longest word in it.
CACHE, LONGEST_WORD = 400_000, 64
#: Texts that a Python worker holds at a time; texts that it encodes at a time, and about how many characters of them.
TEXTS, ENCODED, CHARS = 512, 256, 1_000_000
# Letters of Latin texts, and how the tokenizer's own pattern splits a text of these, blanks, digits and signs.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
LATIN = re.compile(r"[\t\n\r\x20-\x7e¡-±´-¸º»¿-ɏ]*")
LATIN_WORDS = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes, by the tokenizer file at ``path``.

    A byte-level tokenizer encodes the words of its pre-tokenisation one by one.  Latin texts
    are split here, and each distinct word is encoded by the tokenizer once and then looked up;
    any other text, and one that holds the string of an added token, is given to the tokenizer whole.  Both
    give the ids of the tokenizer's plain call.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) if added else r"(?!)")
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.opens[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        self.known: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(ids)}I", *ids) for e in found for ids in (e.ids,)]

    def _words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each word with its ids.  Words of a blank and letters are encoded in runs: every one
        starts a pre-token, so that a token with a blank in front marks where its ids begin."""
        spaced = [w for w in words if w[0] == " " and w[1:].isalpha()]
        rest = [w for w in words if not (w[0] == " " and w[1:].isalpha())]
        runs = [spaced[i : i + 200] for i in range(0, len(spaced), 200)]
        for run, raw in zip(runs, self._encoded(["".join(r) for r in runs]) if runs else [], strict=True):
            starts = np.flatnonzero(self.opens[np.frombuffer(raw, dtype="<u4")])
            if len(starts) == len(run):
                cuts = [*(4 * starts).tolist(), len(raw)]
                yield from zip(run, map(raw.__getitem__, map(slice, cuts, cuts[1:])), strict=True)
            else:
                rest += run
        yield from zip(rest, self._encoded(rest) if rest else [], strict=True)

    def __call__(self, texts: list[str]) -> list[bytes]:
        latin = [bool(LATIN.fullmatch(t)) and not self.added.search(t) for t in texts]
        words = [LATIN_WORDS.findall(t) for t, ok in zip(texts, latin, strict=True) if ok]
        known = self.known
        new = list(set().union(*words) - known.keys())
        if new and len(known) + len(new) > CACHE:
            known.clear()
            new = list(set().union(*words))
        known.update(self._words(new))
        get = known.__getitem__
        whole = [t for t, ok in zip(texts, latin, strict=True) if not ok]
        ours, theirs = iter([b"".join(map(get, w)) for w in words]), iter(self._encoded(whole) if whole else [])
        found = [next(ours if ok else theirs) for ok in latin]
        for w in new:
            if len(w) > LONGEST_WORD:
                del known[w]
        return found


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; tasks that share a worker share its cache."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, on request, ``ids`` of each piece.

    Of a longer document the first piece takes what ``capacity`` doesn't divide.
    """
    kind = f"array<struct<start:bigint,length:bigint,ids_crc32:bigint{',ids:array<bigint>' if with_ids else ''}>>"

    @F.pandas_udf(kind)
    @trimmed
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode, end = encoder(path), np.array([END_ID], dtype="<u4").tobytes()
        for texts in batches:
            values, out = ["" if t is None else t for t in texts], []
            for part in slices([len(t) for t in values], ENCODED, CHARS):
                for raw in encode(values[part]):
                    raw += end
                    n, rows = len(raw) // 4, []
                    head = n if n <= capacity else n % capacity or capacity
                    for start in [0, *range(head, n, capacity)]:
                        own = raw[4 * start : 4 * min(n, start + capacity if start else head)]
                        row = {"start": start, "length": len(own) // 4, "ids_crc32": zlib.crc32(own)}
                        rows.append(row | {"ids": np.frombuffer(own, dtype="<u4").astype(np.int64)} if with_ids else row)
                    out.append(rows)
            trim()  # what the tokenizer returns is many times the size of the ids
            yield pd.Series(out)

    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(cut(F.col(text_col))).alias("piece", "p")).select("doc_id", "piece", "p.*")


Plan = list[tuple[list[tuple[int, int]], int]]
#: Slacks that are tried; a little slack leaves short lengths for later bins.
SLACKS = (0, 1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan with the fewest bins among ``SLACKS``, the strictest first."""
    best, fewest = [], None
    least = -(-sum(n * c for n, c in counts.items() if c > 0 and 0 < n <= capacity) // capacity)
    for slack in SLACKS:
        plan = minimum_slack(counts, capacity, slack)
        bins = sum(repeats for _, repeats in plan)
        if fewest is None or bins < fewest:
            best, fewest = plan, bins
        if fewest == least:
            break
    return best


def minimum_slack(counts: dict[int, int], capacity: int, slack: int = 0) -> Plan:
    """Minimum bin slack over a histogram: a list of (combination as (length, times), repeats).

    Lengths enter the subset sums from the longest on, until a sum leaves no more than ``slack``; else
    the fullest sum of all is taken.
    """
    left = {n: c for n, c in counts.items() if c > 0 and 0 < n <= capacity}
    plan = []
    while left:
        first = max(left)
        room = capacity - first
        own = {n: c - (n == first) for n, c in left.items() if n <= room and c - (n == first) > 0}
        lengths, reach, steps = sorted(own, reverse=True), 1, []
        mask = (1 << (room + 1)) - 1
        full = mask >> max(0, room - slack) << max(0, room - slack)
        for n in lengths:
            most, times = min(own[n], room // n), 1
            while most > 0 and not reach & full:  # binary splitting of a bounded count
                k = min(times, most)
                steps.append((n, k, reach))
                reach |= (reach << (n * k)) & mask
                most, times = most - k, times * 2
            if reach & full:
                break
        total, used = reach.bit_length() - 1, {first: 1}
        for n, k, before in reversed(steps):
            if not before >> total & 1:
                used[n] = used.get(n, 0) + k
                total -= n * k
        repeats = min(left[n] // t for n, t in used.items())
        for n, t in used.items():
            left[n] -= t * repeats
            if not left[n]:
                del left[n]
        plan.append((sorted(used.items(), reverse=True), repeats))
    return plan


def pack(cut: DataFrame, capacity: int = CAPACITY, buckets: int | None = None) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the pieces; ``cut`` is materialised first, as it is read twice."""
    spark = cut.sparkSession
    buckets = buckets or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with python_batches(spark, TEXTS):
        cut = checkpointed(cut.withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int")))
    sizes = cut.groupBy("length", "__bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("__bucket")
    base = sizes.select("length", "__bucket", (F.sum("n").over(before) - F.col("n")).alias("__base"))
    counts = {int(r["length"]): int(r["n"]) for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    spans, sequence, taken = [], 0, dict.fromkeys(counts, 0)
    for combination, repeats in plan_bins(counts, capacity):
        offset = 0
        for n, times in combination:
            spans.append((n, taken[n], taken[n] + times * repeats, times, sequence, offset))
            taken[n] += times * repeats
            offset += n * times
        sequence += repeats
    # From Arrow, which the JVM reads by itself: rows of Python would start further Python workers on every executor.
    names = ("length", "lo", "hi", "times", "first_sequence", "first_offset")
    plan = spark.createDataFrame(pa.table({name: pa.array([s[i] for s in spans], pa.int64()) for i, name in enumerate(names)}))
    # Of a length, its spans as a sorted array: a piece finds its own by its number; one row a length, at most ``capacity`` rows.
    plan = plan.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "times", "first_sequence", "first_offset"))).alias("__spans"))
    order = Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    numbered = cut.withColumn("__row", F.row_number().over(order) - 1).join(base, ["length", "__bucket"])
    numbered = numbered.join(F.broadcast(plan), "length").withColumn("__rank", F.col("__row") + F.col("__base"))
    span = F.filter("__spans", lambda s: (s["lo"] <= F.col("__rank")) & (F.col("__rank") < s["hi"]))[0]
    at = numbered.withColumn("__s", span).withColumn("__k", F.col("__rank") - F.col("__s.lo"))
    return at.select(
        *[c for c in cut.columns if c != "__bucket"],
        (F.col("__s.first_sequence") + F.floor(F.col("__k") / F.col("__s.times"))).cast("bigint").alias("sequence_id"),
        (F.col("__s.first_offset") + F.col("length") * (F.col("__k") % F.col("__s.times"))).cast("bigint").alias("offset"),
    )
