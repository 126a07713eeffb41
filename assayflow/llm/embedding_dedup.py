"""Operator 5, near-duplicate embeddings by product quantisation.

Vectors of one label are compared by cosine.  A coarse quantiser, fitted on a bounded
sample of unit vectors, assigns every vector to its nearest list.  Within a
list, residuals are coded subspace by subspace, and asymmetric distances from a query to the coded vectors
come from lookup tables:

* Probes: a partner of query q can only be in list c if q is within r of the bisector between c
  and its own list.  q visits every such list, so no partner is lost, however the vectors lie.
* Codes: a coded vector keeps its quantisation error e; if q's table distance exceeds
  r + e, the vector is farther than r.  This bound is exact, and so is the rerank by cosine
  in double precision.  r follows from the threshold: |q - x|^2 = 2 - 2 cos for unit vectors.

Equal vectors of one label are one class with a weight.  Neighbouring lists of a label are joined to
cells of about ``BLOCK_BYTES`` of members, to which a query travels once however many of their lists it visits.  Larger cells are cut
into blocks, and visitors too, so that a task holds one block pair whatever the size of a list; from each pair of blocks come a count per query and a spanning forest of its links,
never all pairs.  Copies of vectors on their way are about the label's size by a block's for each, where the vectors have no structure that lets lists be skipped.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and
rows with a null label, link with nothing; vectors of different lengths are
never linked; a null vec_id gets component null and is kept; an empty table gives
no rows; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, connected_components

THRESHOLD = 0.93
#: Bounds of the sample that the quantisers are fitted on, and of their sizes.
SAMPLE, LISTS, SUBSPACES, CODES = 10_000, 1024, 8, 64
#: Vectors per list that are aimed at.
PER_LIST = 512
#: Bytes of the vectors in a block, and pairs of vectors whose table distances are held at a time.
BLOCK_BYTES, PAIRS = 16 << 20, 1_000_000
#: Rows of a plan over lists up to which it is broadcast.
FEW = 100_000


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1) - 2 * x @ centres.T).argmin(1)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        order, counts = np.argsort(own, kind="stable"), np.bincount(own, minlength=len(centres))
        used = np.flatnonzero(counts)
        starts = (np.cumsum(counts) - counts)[used]
        centres[used] = np.add.reduceat(x[order], starts, axis=0) / counts[used, None]
    return centres


def chain(centres: np.ndarray) -> np.ndarray:
    """An order of the centres in which neighbours are near each other: from each to the nearest that is left."""
    out, left = [0], np.arange(1, len(centres))
    while len(left):
        k = int(((centres[left] - centres[out[-1]]) ** 2).sum(1).argmin())
        out.append(int(left[k]))
        left = np.delete(left, k)
    return np.array(out)


class Quantiser:
    """Coarse centres and one codebook of residuals per subspace."""

    def __init__(self, sample: np.ndarray, lists: int, threshold: float):
        self.reach = float(np.sqrt(max(2 - 2 * threshold, 0.0))) + 1e-6
        centres = kmeans(sample, max(1, min(lists, LISTS, len(sample) // 20)))
        self.centres = centres[chain(centres)]
        residual = sample - self.centres[nearest(sample, self.centres)]
        self.cuts = [c for c in np.array_split(np.arange(sample.shape[1]), SUBSPACES) if len(c)]
        self.books = [kmeans(residual[:, c], CODES) for c in self.cuts]
        norms = (self.centres**2).sum(1)
        self.between = np.sqrt(np.maximum(norms[:, None] + norms - 2 * self.centres @ self.centres.T, 0))

    def encode(self, residual: np.ndarray) -> np.ndarray:
        return np.stack([nearest(residual[:, c], b) for c, b in zip(self.cuts, self.books, strict=True)], 1).astype(np.uint8)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty((len(codes), sum(map(len, self.cuts))))
        for k, (c, b) in enumerate(zip(self.cuts, self.books, strict=True)):
            out[:, c] = b[codes[:, k]]
        return out

    def tables(self, queries: np.ndarray) -> list[np.ndarray]:
        """Products of the queries with the codes of each subspace; the same for every list."""
        return [queries[:, c] @ b.T for c, b in zip(self.cuts, self.books, strict=True)]

    def probes(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """For each row the lists that it visits, as a mask; its own is among them."""
        square = (self.centres**2).sum(1) - 2 * x @ self.centres.T
        gap = square - square[np.arange(len(x)), own][:, None]
        return (gap <= 2 * self.reach * self.between[own] + 1e-9) | (np.arange(len(self.centres)) == own[:, None])


def block_size(size: int) -> int:
    """Vectors of a block."""
    return max(256, BLOCK_BYTES // (8 * size))


def _usable(values) -> bool:
    return values is not None and len(values) > 0 and all(v is not None for v in values)


def _unit(batch: pd.Series, size: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision and a mask of the usable rows of length ``size``."""
    rows = [np.asarray(v, dtype=np.float64) if _usable(v) and (size is None or len(v) == size) else None for v in batch]
    ok = np.array([v is not None and bool(np.isfinite(v).all()) and bool(v.any()) for v in rows], dtype=bool)
    x = np.stack([v for v, k in zip(rows, ok, strict=True) if k]) if ok.any() else np.empty((0, size or 0))
    # Scaled by the largest component first, in two steps, as its inverse may be infinite for the smallest doubles.
    x = np.where(np.abs(x).max(1, keepdims=True) < 2.0**-512, x * 2.0**512, x) if len(x) else x
    x = x / np.abs(x).max(1, keepdims=True) if len(x) else x
    return x / np.sqrt((x * x).sum(1, keepdims=True)) if len(x) else x, ok


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("string").alias("label"))
    kind = dict(vectors.dtypes)[id_col]
    good = F.coalesce(
        F.col("label").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists("v", lambda x: x != 0),
        F.lit(False),
    )
    keyed = rows.withColumn("good", good & F.col("id").isNotNull()).withColumns({"k1": F.xxhash64("label", "v"), "k2": F.xxhash64("v", F.lit(1), "label")})
    usable = keyed.where("good")
    classes = checkpointed(usable.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("label").alias("label"), F.first("v").alias("v")))
    sizes = [r["n"] for r in classes.groupBy(F.size("v").alias("n")).count().collect()]
    links, counts = None, None
    for size in sizes:  # one for each vector length that occurs
        part = classes.where(F.size("v") == size)
        sample, _ = _unit(pd.Series([r["v"] for r in part.orderBy(F.xxhash64("k1", "k2"), "k1", "k2").limit(SAMPLE).select("v").collect()]), size)
        if not len(sample):
            continue
        forest, n = _search(part, Quantiser(sample, part.count() // PER_LIST, threshold), size, threshold, kind)
        links, counts = (forest, n) if links is None else (links.unionByName(forest), counts.unionByName(n))
    ids = keyed.join(classes.select("k1", "k2", "rep", "weight"), ["k1", "k2"], "left").withColumns({"rep": F.when(F.col("good"), F.col("rep")), "weight": F.when(F.col("good"), F.col("weight"))})
    if links is None:
        ids = ids.withColumns({"label_id": F.col("rep"), "n": F.lit(0).cast("bigint")})
    else:
        ids = ids.join(connected_components(links).toDF("rep", "label_id"), "rep", "left").join(counts.toDF("rep", "n"), "rep", "left")
    component = F.coalesce("label_id", "rep", "id")
    return ids.select(
        F.col("id").alias("vec_id"), (F.coalesce("n", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _search(classes: DataFrame, quantiser: Quantiser, size: int, threshold: float, kind: str) -> tuple[DataFrame, DataFrame]:
    """Spanning links ``a, b`` between classes, and for each ``id`` the weight ``n`` it is linked with."""
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 500):
                b = whole.iloc[at : at + 500]
                x, ok = _unit(b["v"], size)
                b = b.loc[ok]
                own = nearest(x, quantiser.centres)
                mask = quantiser.probes(x, own)
                yield b[["rep", "weight", "label"]].assign(x=[v.tobytes() for v in x], own=own.astype(np.int32), lists=[np.flatnonzero(m).astype(np.int32) for m in mask])

    block = block_size(size)
    placed = checkpointed(classes.select("rep", "weight", "label", "v").mapInPandas(assign, f"rep {kind}, weight bigint, label string, x binary, own int, lists array<int>"))
    lists = checkpointed(placed.groupBy("label", F.col("own").alias("list")).agg(F.count(F.lit(1)).alias("n")))
    small = F.broadcast if lists.count() <= FEW else lambda df: df
    ahead = F.sum("n").over(Window.partitionBy("label").orderBy("list")) - F.col("n")
    celled = lists.withColumn("cell", F.floor(ahead / block).cast("int"))
    sizes = celled.groupBy("label", "cell").agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
    entry = F.map_from_entries(F.collect_list(F.struct("list", F.struct("cell", "blocks"))))
    cells = celled.join(sizes, ["label", "cell"]).groupBy("label").agg(entry.alias("m"))
    cells = cells.select("label", F.transform(F.sequence(F.lit(0), F.lit(len(quantiser.centres) - 1)), lambda i: F.col("m")[i]).alias("cells"))
    routed = placed.join(small(cells), "label")
    there = F.array_distinct(F.filter(F.transform("lists", lambda c: F.get("cells", c)), lambda c: c.isNotNull()))
    visits = routed.select("rep", "weight", "label", "x", "own", F.explode(there).alias("at")).select("*", "at.cell", "at.blocks")
    guests = small(checkpointed(visits.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("guests"))))
    salt = F.xxhash64("rep", F.lit(3))
    member = (
        routed.withColumn("at", F.get("cells", F.col("own"))).select("rep", "weight", "label", "x", "own", "at.cell", "at.blocks").join(guests, ["label", "cell"])
        .withColumns({"block": F.pmod(salt, F.col("blocks")), "guest": F.explode(F.sequence(F.lit(0), F.col("guests") - 1)), "member": F.lit(True)})
    )
    guest = (
        visits.join(guests, ["label", "cell"])
        .withColumns({"guest": F.pmod(salt, F.col("guests")), "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "member": F.lit(False)})
    )
    columns = ["label", "cell", "block", "guest", "member", "rep", "weight", "x", "own"]
    both = member.select(*[F.col(c).cast("int") if c in ("block", "guest") else c for c in columns]).unionByName(guest.select(*[F.col(c).cast("int") if c in ("block", "guest") else c for c in columns]))

    def compare(b: pd.DataFrame) -> pd.DataFrame:
        m, g = b[b["member"]].sort_values("own"), b[~b["member"]].sort_values("own")
        empty = pd.DataFrame({"a": [], "b": [], "n": []})
        if not len(m) or not len(g):
            return empty
        x = np.frombuffer(b"".join(m["x"]), dtype=np.float64).reshape(len(m), size)
        lists = m["own"].to_numpy()
        centre = quantiser.centres[lists]
        codes = quantiser.encode(x - centre)
        coded = centre + quantiser.decode(codes)
        error = np.sqrt(((x - coded) ** 2).sum(1))
        # |q - coded|^2 = |q|^2 - 2 q.centre - 2 q.code + |coded|^2, of which q.code is looked up.
        square = (coded * coded).sum(1)
        mid, gid, weight = m["rep"].to_numpy(), g["rep"].to_numpy(), m["weight"].to_numpy()
        root: dict = {}

        def find(v):
            while root.setdefault(v, v) != v:
                root[v] = v = root[root[v]]
            return v

        out_a, out_b, out_n = [], [], []
        step = max(16, PAIRS // len(m))
        for at in range(0, len(g), step):
            ids = gid[at : at + step]
            q = np.frombuffer(b"".join(g["x"].iloc[at : at + step]), dtype=np.float64).reshape(-1, size)
            visited = quantiser.probes(q, g["own"].to_numpy()[at : at + step])
            use = np.flatnonzero(visited.any(0)[lists])
            if not len(use):
                continue
            product = sum(t[:, codes[use, k]] for k, t in enumerate(quantiser.tables(q)))
            product += (q @ quantiser.centres.T)[:, lists[use]]
            distance = (q * q).sum(1)[:, None] - 2 * product + square[use]
            i, j = np.nonzero((distance <= (quantiser.reach + error[use]) ** 2) & visited[:, lists[use]] & (ids[:, None] != mid[use][None]))
            j = use[j]
            for s in range(0, len(i), 200_000):
                cos = np.einsum("ij,ij->i", q[i[s : s + 200_000]], x[j[s : s + 200_000]])
                near = cos >= threshold
                ii, jj = i[s : s + 200_000][near], j[s : s + 200_000][near]
                total = np.bincount(ii, weights=weight[jj], minlength=len(ids)).astype(np.int64)
                for k in np.flatnonzero(total):
                    out_a.append(ids[k]), out_b.append(ids[k]), out_n.append(int(total[k]))
                for u, v in zip(ids[ii], mid[jj], strict=True):
                    fu, fv = find(u), find(v)
                    if fu != fv:
                        root[fu] = fv
                        out_a.append(u), out_b.append(v), out_n.append(0)
        return pd.DataFrame({"a": out_a, "b": out_b, "n": out_n}) if out_a else empty

    found = checkpointed(both.groupBy("label", "cell", "block", "guest").applyInPandas(compare, f"a {kind}, b {kind}, n bigint"))
    return found.where("a <> b").select("a", "b"), found.where("n > 0").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
