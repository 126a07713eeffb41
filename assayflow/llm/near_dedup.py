"""Operator 4, near-duplicate documents by SetSketch.

A document's set is its distinct five-word shingles (words: runs of bytes other
than blank and U+0009 to U+000D, with A-Z lower-cased).  A sketch of ``REGISTERS``
registers holds exponentially spaced, truncated minima: every shingle is the
start of a Poisson process that visits random registers, a register keeps the earliest
arrival x as floor(1 - log_b x).  Equal registers become likely with
similarity, sketches of parts merge by their maxima.

1. Documents with the same set of words in order are one class; a class has one sketch.
2. Bands of ``ROWS`` registers are bucketed.  Members of a bucket are first compared with its
   smallest id.  Then small buckets are compared whole, and in larger ones those outside the largest
   component with random members of that one, and at last the few that are still outside with all
   members of other components, block by block.  Members already known to be connected need no comparison.  No pair is dropped and no bucket is gathered
   or sorted in a task: what is known of a bucket comes from partial aggregates and is joined back by a broadcast
   of all buckets, or of the large ones where there are too many.
3. A pair goes on when the joint likelihood of its registers at the threshold is
   within ``SIGMAS`` standard deviations of the best one.
4. Its full shingle sets, built anew from whole texts, confirm or refute the link exactly.

With 32 bands of 4 registers a pair at similarity 0.75 shares no bucket with a
probability of 5e-6.

Edge cases: ids are integers below 2^62; null and empty texts have an empty set and link with nothing; a
null doc_id gets component null and is kept; rows that share a doc_id count as
one document and share a component, whatever their texts, so that these link each other's groups (rows without
words stay by themselves); an empty table gives no rows; other columns don't matter.  A text is held whole by a Python worker, very long ones fewer
at a time (``BYTES``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpointed, connected_components, join_by_key, python_batches, release, sized, slices, trimmed

WIDTH, THRESHOLD_PERCENT = 5, 75
REGISTERS, ROWS = 128, 4
BASE, RATE, LAST = 1.02, 20.0, (1 << 12) - 1
SIGMAS = 5.0
#: Ids up to which the documents to compare are filtered by a broadcast; beyond it by a shuffle join.
BROADCAST_IDS = 1_000_000
#: Texts that a Python worker holds at a time, and about how many bytes of them.
TEXTS, BYTES = 400, 64 << 20
#: Texts that are sketched at a time, and about how many characters of them.
SKETCHED, CHARS = 200, 2_000_000
#: Words whose hashes a Python worker remembers, and the longest of these in bytes.
WORDS, LONGEST_WORD = 200_000, 64
#: Members of a small bucket, random pivots of a larger one, members of a block compared at a time; none limits the pairs.
SMALL, PIVOTS, BLOCK = 32, 4, 1000
#: Shingles of a block's members, about, which bounds its bytes.
BLOCK_SHINGLES = 2_000_000
#: Ids from here on stand for the further texts of a repeated id.
SURROGATE = 1 << 62
_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; forgotten when there are too many of them, and not remembered for very long ones."""

    def __missing__(self, word: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= LONGEST_WORD:
            if len(self) >= WORDS:
                self.clear()
            self[word] = h
        return h


def tokens(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], hashes: dict) -> np.ndarray:
    """Sorted distinct hashes of the shingles; of fewer words the whole sequence is one."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(1, len(h) - WIDTH + 1)
    s = np.full(n, min(len(h), WIDTH), dtype=np.uint64)
    for k in range(min(WIDTH, len(h))):
        s = mix(s * _STEP + h[k : k + n])
    return np.unique(s)


def sketch(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """A row of registers for each set, by arrivals of one Poisson process per element."""
    d = len(sets)
    low = np.full(d * registers, np.inf)
    doc = np.repeat(np.arange(d), [len(s) for s in sets])
    state = np.concatenate(sets) if d else np.empty(0, dtype=np.uint64)
    x = np.zeros(len(state))
    with np.errstate(over="ignore"):
        while len(state):
            state = mix(state + _STEP)
            x = x - np.log((state >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / (RATE * registers)
            cell = doc * registers + (mix(state) % np.uint64(registers)).astype(np.intp)
            np.minimum.at(low, cell, x)
            live = x < low.reshape(d, registers).max(1)[doc]
            state, x, doc = state[live], x[live], doc[live]
    k = np.floor(1 - np.log(np.maximum(low, 1e-300)) / np.log(BASE))
    return np.where(np.isinf(low), 0, np.clip(k, 0, LAST)).reshape(d, registers).astype(np.uint16)


def band_keys(regs: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    parts = regs.reshape(len(regs), -1, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64) * _STEP, parts.shape[:2])
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = mix(key * np.uint64(31) + parts[:, :, r] + np.uint64(1))
    return key.view(np.int64) if key.flags.c_contiguous else np.ascontiguousarray(key).view(np.int64)


def may_link(na: np.ndarray, nb: np.ndarray, ra: np.ndarray, rb: np.ndarray, threshold: float) -> np.ndarray:
    """Joint likelihood of two sketches with known set sizes: False where the threshold is ruled out."""
    above, below = (ra > rb).sum(1)[:, None], (ra < rb).sum(1)[:, None]
    same = ra.shape[1] - above - below
    u = (na / (na + nb))[:, None]
    v = 1 - u
    top = np.minimum(u / v, v / u)
    at = np.hstack([np.linspace(0, 1, 41)[None, :] * top, np.minimum(threshold, top)])

    def p(z):
        return np.maximum(-np.log1p(-np.clip(z, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-9)

    pa, pb = p(u - v * at), p(v - u * at)
    like = above * np.log(pa) + below * np.log(pb) + same * np.log(np.maximum(1 - pa - pb, 1e-9))
    best = like[:, :-1].argmax(1)
    estimate = at[np.arange(len(at)), best]
    return (estimate >= threshold) | (like[:, -1] >= like[:, :-1].max(1) - SIGMAS**2 / 2)


@trimmed
def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for whole in batches:
        for part in slices([len(t or "") for t in whole["text"]], SKETCHED, CHARS):
            batch = whole.iloc[part]
            sets, keys = [], []
            for text in batch["text"]:
                words = tokens(text) if text else []
                sets.append(shingle_hashes(words, hashes))
                digest = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
                keys.append((int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)))
            regs = sketch(sets)
            yield pd.DataFrame(
                {
                    "id": batch["id"].array, "th": batch["th"].array, "k1": [k[0] for k in keys], "k2": [k[1] for k in keys],
                    "n": np.array([len(s) for s in sets], dtype=np.int64), "regs": [r.tobytes() for r in regs], "bands": list(band_keys(regs)),
                }
            )


@trimmed
def _estimate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for whole in batches:
        for at in range(0, len(whole), 2000):
            b = whole.iloc[at : at + 2000]
            ra, rb = (np.frombuffer(b"".join(b[c]), dtype=np.uint16).reshape(len(b), -1) for c in ("ra", "rb"))
            likely = may_link(b["na"].to_numpy(float), b["nb"].to_numpy(float), ra, rb, THRESHOLD_PERCENT / 100)
            yield b[["a", "b"]].assign(score=(ra == rb).mean(1)).loc[likely]


def _compare_block(rows: pd.DataFrame) -> pd.DataFrame:
    """Spanning links among the components in one block of a bucket, each confirmed on full sets.

    Every outlier is compared with every member of another component, unless they share an earlier
    band as well: that band's bucket compares them.  Registers rule out most pairs first.
    """
    first, second = rows[rows["outlier"]], rows[~rows["outlier"]]
    links: list[tuple] = []
    if len(first) and len(second):
        ro, rm = (np.frombuffer(b"".join(x["regs"]), dtype=np.uint16).reshape(len(x), -1) for x in (first, second))
        bo, bm = (np.stack(x["bands"].to_list()) for x in (first, second))
        no, nm, lo, lm, io, im = (x[c].to_numpy() for c in ("n", "label", "id") for x in (first, second))
        band = int(np.argmax(bm[0] == rows["h"].iloc[0]))
        hashes = WordHashes()
        so, sm = ([shingle_hashes(tokens(t), hashes) for t in x["text"]] for x in (first, second))
        known, dense = np.unique(np.concatenate(sm), return_inverse=True)
        starts, marked = np.concatenate([[0], np.cumsum([len(x) for x in sm])[:-1]]), np.zeros(len(known) + 1, dtype=np.int64)
        root: dict = {}

        def find(v):
            while root.setdefault(v, v) != v:
                root[v] = v = root[root[v]]
            return v

        least = (THRESHOLD_PERCENT / 100 - SIGMAS * 0.5 / np.sqrt(ro.shape[1])) * ro.shape[1]
        for i in range(len(first)):
            fits = (lm != lo[i]) & (100 * np.minimum(nm, no[i]) >= THRESHOLD_PERCENT * np.maximum(nm, no[i])) & ((rm == ro[i]).sum(1) >= least) & ~(bm[:, :band] == bo[i, :band]).any(1)
            j = np.flatnonzero(fits)
            if len(j):
                j = j[may_link(np.full(len(j), float(no[i])), nm[j].astype(float), np.broadcast_to(ro[i], (len(j), ro.shape[1])), rm[j], THRESHOLD_PERCENT / 100)]
            if len(j):
                at = np.minimum(np.searchsorted(known, so[i]), len(known) - 1)
                mine = at[known[at] == so[i]]
                marked[mine] = 1
                inter = np.add.reduceat(marked[dense], starts)[j]
                marked[mine] = 0
                for k in j[100 * inter >= THRESHOLD_PERCENT * (no[i] + nm[j] - inter)]:
                    x, y = find(lo[i]), find(lm[k])
                    if x != y:
                        root[x] = y
                        links.append((io[i], im[k]))
    return pd.DataFrame(links, columns=["a", "b"], dtype=rows["id"].dtype)


@trimmed
def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for whole in batches:
        for at in range(0, len(whole), 500):
            b, sets, found = whole.iloc[at : at + 500], {}, []
            for ta, tb in zip(b["ta"], b["tb"], strict=True):
                x, y = (sets[t] if t in sets else sets.setdefault(t, shingle_hashes(tokens(t), hashes)) for t in (ta, tb))
                inter = len(np.intersect1d(x, y, assume_unique=True))
                found.append(100 * inter >= THRESHOLD_PERCENT * (len(x) + len(y) - inter))
            yield b[["a", "b"]].assign(linked=found)


class _Search:
    """The state of one run: sketches of classes, links found, labels of components, refuted pairs."""

    def __init__(self, nodes: DataFrame, texts: DataFrame, longest: int):
        self.nodes, self.texts, self.longest = nodes, texts, longest
        self.labels: DataFrame | None = None
        self.refuted: DataFrame | None = None

    def among(self, frame: DataFrame, ids: DataFrame, per: int = 20_000) -> DataFrame:
        """Rows of ``frame`` with one of the ``ids``, by a broadcast if these are few; materialised.

        The scan keeps its tasks; only the reading of the materialised rows is merged into fewer.
        """
        n = ids.count()
        self.found = checkpointed(frame.join(broadcast_if_small(ids, n, BROADCAST_IDS), "id", "left_semi"))
        return sized(self.found, n, per)

    def batch(self) -> int:
        """Rows of two texts that go to Python at a time."""
        return max(1, min(TEXTS, BYTES // (16 * max(1, self.longest))))

    def _ends(self, pairs: DataFrame, rows: int) -> DataFrame:
        ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
        return checkpointed(sized(sized(ends, 2 * rows).distinct(), 2 * rows))

    def relabel(self, slots: DataFrame) -> DataFrame:
        rest = slots.drop("label")
        if self.labels is None:
            return rest.withColumn("label", F.col("id"))
        return rest.join(self.labels, "id", "left").withColumn("label", F.coalesce("label", "id"))

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs ``a, b, score`` whose registers don't rule out the threshold."""
        pairs = checkpointed(pairs)
        n = pairs.count()
        pairs = sized(pairs, n)
        side = self.among(self.nodes.select("id", "n", "regs"), self._ends(pairs, n))
        joined = sized(pairs.join(side.toDF("a", "na", "ra"), "a"), n, 20_000).join(side.toDF("b", "nb", "rb"), "b")
        fits = joined.where(F.lit(100) * F.least("na", "nb") >= F.lit(THRESHOLD_PERCENT) * F.greatest("na", "nb"))
        return sized(fits, n, 20_000).mapInPandas(_estimate, "a bigint, b bigint, score double")

    def settle(self, likely: DataFrame, best_first: bool) -> None:
        """Confirm or refute pairs on full sets.  ``best_first`` tries the best partner of each class
        before the others, which need no comparison where that one connected them."""
        pending = checkpointed(likely)
        if self.refuted is not None:
            pending = checkpointed(pending.join(self.refuted, ["a", "b"], "left_anti"))
        n = pending.count()
        pending = sized(pending, n)
        if best_first:
            both = pending.select(F.col("a").alias("v"), "a", "b", "score").unionByName(pending.select(F.col("b").alias("v"), "a", "b", "score"))
            best = sized(sized(both, 2 * n).groupBy("v").agg(F.max_by(F.struct("a", "b"), F.struct("score", "a", "b")).alias("p")), 2 * n)
            best = checkpointed(sized(best.select("p.*").distinct(), 2 * n))
            self._check(best)
            pending = sized(pending.join(best, ["a", "b"], "left_anti"), n)
            la, lb = (sized(self.relabel(sized(pending.select(F.col(c).alias("id")).distinct(), n)), n).select(F.col("id").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b"))
            pending = checkpointed(sized(sized(pending.join(la, "a"), n).join(lb, "b").where("la <> lb"), n))
        self._check(pending.select("a", "b"))

    def _check(self, pairs: DataFrame) -> None:
        n = pairs.count()
        if not n:
            return
        texts = self.among(self.texts, self._ends(pairs, n), TEXTS)
        both = sized(pairs.join(texts.toDF("b", "tb"), "b"), n, 10 * TEXTS).join(texts.toDF("a", "ta"), "a")
        with python_batches(pairs.sparkSession, self.batch()):
            checked = checkpointed(sized(both, n, 10 * TEXTS).mapInPandas(_confirm, "a bigint, b bigint, linked boolean"))
        release(self.found)
        failed = sized(checked.where("not linked").select("a", "b"), n)
        self.refuted = failed if self.refuted is None else self.refuted.unionByName(failed)
        self.link(sized(checked.where("linked").select("a", "b"), n))

    def link(self, links: DataFrame) -> None:
        if self.labels is not None:
            links = links.unionByName(self.labels.select(F.col("id").alias("a"), F.col("label").alias("b")))
        self.labels = connected_components(links)

    def open_slots(self, slots: DataFrame, rows: int) -> tuple[DataFrame, int]:
        """``h, id, label, size``: slots of the buckets that hold more than one component, and their number."""
        named = sized(self.relabel(slots.select("h", "id")), rows)
        split = named.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi")
        split = split.select("h", "size", F.col("size").alias("n"))
        found = checkpointed(sized(join_by_key(named, sized(split, rows), "h", "n", rows), rows))
        n = found.count()
        return sized(found, n), n


def _by_smallest(slots: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of each bucket's smallest id with the other members, and the slots of these."""
    least = slots.groupBy("h").agg(F.min("id").alias("p"), F.count(F.lit(1)).alias("n"))
    rest = join_by_key(slots, least, "h", "n", rows).where("id > p")
    return rest.select(F.col("p").alias("a"), F.col("id").alias("b")).distinct(), rest


def _with_mode(slots: DataFrame, rows: int) -> DataFrame:
    """Slots with the label that most members of their bucket have, the smallest of these."""
    labels = slots.groupBy("h", "label").agg(F.count(F.lit(1)).alias("k"))
    modes = labels.groupBy("h").agg(F.max_by("label", F.struct("k", -F.col("label"))).alias("mode"), F.sum("k").alias("n"))
    return join_by_key(slots, modes, "h", "n", rows)


def _in_small(slots: DataFrame) -> DataFrame:
    """All pairs with different labels of buckets with ``SMALL`` members at most."""
    members = slots.where(F.col("size") <= SMALL).groupBy("h").agg(F.collect_list(F.struct("id", "label")).alias("m"))
    pairs = "flatten(transform(m, x -> transform(filter(m, y -> y.id > x.id AND y.label <> x.label), y -> struct(x.id AS a, y.id AS b))))"
    return members.select(F.explode(F.expr(pairs)).alias("p")).select("p.*")


def _by_random_pivots(slots: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of up to ``PIVOTS`` random members of a large bucket's largest component with the members
    outside it, and the slots without these pivots, which are settled."""
    moded = checkpointed(_with_mode(slots.where(F.col("size") > SMALL), rows).withColumn("inside", F.col("label") == F.col("mode")))
    pick = lambda k: F.min_by("id", F.struct(F.xxhash64("id", F.lit(k)), "id"))
    heads = moded.where("inside").groupBy("h").agg(F.array_distinct(F.array(*map(pick, range(PIVOTS)))).alias("p"), F.count(F.lit(1)).alias("n"))
    headed = join_by_key(moded, heads, "h", "n", rows)
    rivals = headed.where("not inside").groupBy("id").agg(F.array_distinct(F.flatten(F.collect_set("p"))).alias("p"))
    pairs = rivals.select("id", F.explode("p").alias("p")).select(F.least("id", "p").alias("a"), F.greatest("id", "p").alias("b"))
    return pairs, headed.where(~F.col("inside") | ~F.array_contains("p", F.col("id")))


def _by_blocks(slots: DataFrame, rows: int, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of all members outside a bucket's largest component with all members of other components, in blocks."""
    full = nodes.join(texts, "id")
    moded = _with_mode(slots, rows).withColumn("outlier", F.col("label") != F.col("mode")).join(nodes.select("id", "n"), "id")
    moded = checkpointed(moded.select("h", "id", "label", "outlier", "n"))
    blocks = lambda own, n: F.greatest(F.ceil(F.count_if(own) / BLOCK), F.ceil(F.sum(F.when(own, n)) / BLOCK_SHINGLES)).cast("int")
    plan = moded.groupBy("h").agg(blocks(F.lit(True), F.col("n")).alias("blocks"), blocks(F.col("outlier"), F.col("n")).alias("guests"), F.count(F.lit(1)).alias("m"))
    planned, salt = join_by_key(moded.drop("n"), plan, "h", "m", rows), F.xxhash64("id", F.lit(5))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = planned.withColumns({"block": F.pmod(salt, F.col("blocks")).cast("int"), "guest": spread("guests"), "outlier": F.lit(False)})
    outliers = planned.where("outlier").withColumns({"guest": F.pmod(salt, F.col("guests")).cast("int"), "block": spread("blocks")})
    columns = ["h", "block", "guest", "outlier", "id", "label"]
    cast = [F.col(c).cast("int") if c in ("block", "guest") else F.col(c) for c in columns]
    both = members.select(*cast).unionByName(outliers.select(*cast)).join(full, "id")
    return both.groupBy("h", "block", "guest").applyInPandas(_compare_block, "a bigint, b bigint")


def _one_text_each(rows: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Rows and texts with a surrogate id for every further text of an id, and the links between these ids and their own.

    Without repeated ids, both come back as they are.
    """
    of = F.struct("k1", "k2")
    own = rows.where("id is not null and n > 0").groupBy("id").agg(F.min(of).alias("lo"), F.max(of).alias("hi")).where("lo <> hi")
    own = checkpointed(own.select("id", "lo"))
    n = own.count()
    if not n:
        return rows, texts, None
    joined = rows.join(broadcast_if_small(own, n, BROADCAST_IDS), "id", "left")
    other = F.lit(SURROGATE) + F.xxhash64("id", "k1", "k2").bitwiseAND(F.lit(SURROGATE - 1))
    named = checkpointed(joined.withColumn("node", F.when(F.col("lo").isNull() | (of == F.col("lo")) | (F.col("n") == 0), F.col("id")).otherwise(other)).drop("lo"))
    moved = checkpointed(named.where("node <> id").select("id", "th", "node").distinct())
    m = moved.count()
    renamed = texts.join(broadcast_if_small(moved, m, BROADCAST_IDS), ["id", "th"], "left").select(F.coalesce("node", "id").alias("id"), "th", "text")
    return named.withColumns({"doc": F.col("id"), "id": F.col("node")}).drop("node"), renamed, moved.select(F.col("id").alias("a"), F.col("node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    kind = dict(docs.dtypes)[id_col]
    with python_batches(docs.sparkSession, TEXTS):
        rows = checkpointed(texts.mapInPandas(_sketches, "id bigint, th bigint, k1 bigint, k2 bigint, n bigint, regs binary, bands array<bigint>"))
    rows, texts, same = _one_text_each(rows.withColumn("doc", F.col("id")), texts)
    live = rows.where("id is not null and n > 0")
    of_class = live.groupBy("k1", "k2").agg(F.min_by(F.struct("n", "regs", "bands"), "id").alias("s"), F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    nodes = checkpointed(of_class.select("id", "s.*", "k1", "k2", "copies"))
    classes = nodes.select("k1", "k2", "copies", F.col("id").alias("rep"))
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.max("n").alias("longest"), F.sum("copies").alias("rows")).first()
    nodes = nodes.select("id", "n", "regs", "bands")
    search = _Search(nodes, texts.where("text is not null").drop("th"), size["longest"] or 0)
    slots, n = search.open_slots(nodes.select("id", F.explode("bands").alias("h")), size["n"] * (REGISTERS // ROWS))
    if n:
        pairs, slots = _by_smallest(slots, n)
        search.settle(search.likely(sized(pairs, n)), best_first=False)
        slots, n = search.open_slots(sized(slots, n), n)
    if n:
        pairs, rest = _by_random_pivots(slots, n)
        search.settle(search.likely(sized(_in_small(slots).unionByName(pairs).distinct(), n)), best_first=True)
        slots, n = search.open_slots(sized(rest, n), n)
    if n:
        ids = checkpointed(sized(slots.select("id").distinct(), n))
        search.link(_by_blocks(slots, n, search.among(nodes, ids), search.among(search.texts, ids)))
    if same is not None:
        # Both ends of these links are rows' ids; links go between representatives.
        ends = classes.join(live.select("id", "k1", "k2").distinct(), ["k1", "k2"]).select("id", "rep")
        first, second = ends.toDF("a", "ra"), ends.toDF("b", "rb")
        search.link(same.join(first, "a").join(second, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    if search.labels is not None:
        classes = classes.join(search.labels.toDF("rep", "label"), "rep", "left").withColumn("rep", F.coalesce("label", "rep")).drop("label")
    linked = join_by_key(live, classes, ["k1", "k2"], "copies", size["rows"] or 0).select("doc", "n", F.col("rep").alias("component"))
    alone = rows.where("id is null or n = 0").select("doc", "n", F.col("doc").alias("component"))
    return linked.unionByName(alone).select(
        F.col("doc").cast(kind).alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").cast(kind).alias("component_id"),
        F.coalesce(F.col("doc") == F.col("component"), F.lit(True)).alias("kept"),
    )
