"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows (a key and a number) up to which a list of keys is broadcast; beyond it only its heavy keys are.
BROADCAST_KEYS = 500_000
#: Rows of one key from which on it counts as heavy, at least.
HEAVY = 10_000


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; set one only where it is unset and the session is a local one (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ckpt-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(*frames: DataFrame | None) -> None:
    """Delete the checkpoints of ``frames``, which nothing may read any more."""
    for df in frames:
        if df is not None:
            sc = df.sparkSession.sparkContext
            path = sc._jvm.org.apache.hadoop.fs.Path(df._jdf.queryExecution().logical().rdd().getCheckpointFile().get())
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def sized(df: DataFrame, rows: int, per: int = 200_000) -> DataFrame:
    """``df`` in no more partitions than ``rows`` at most need, ``per`` rows each.

    Small intermediate results otherwise go through every later shuffle as one file per
    partition of the session.  Large ones keep all their partitions.  Not for a frame that reads
    a table: without an exchange in between the scan itself would be merged into these few tasks.
    """
    return df.coalesce(max(1, -(-rows // per)))


@contextmanager
def python_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand at most ``rows`` rows to Python at a time in what runs meanwhile, which bounds a worker's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def trim() -> None:
    """Give the memory that this process has freed back to the system, which the allocators else keep."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if give_back:
        give_back(0)


def trimmed(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``function`` of a task's batches, after which a Python worker, which lives on for other stages, holds no freed memory."""

    @functools.wraps(function)
    def wrapped(batches):
        try:
            yield from function(batches)
        finally:
            trim()

    return wrapped


def slices(sizes: list[int], rows: int, most: int) -> Iterator[slice]:
    """Consecutive slices of ``rows`` entries at most, whose sizes add up to ``most`` at most unless there is but one."""
    start, total = 0, 0
    for at, size in enumerate(sizes):
        if at > start and (at - start == rows or total + size > most):
            yield slice(start, at)
            start, total = at, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name made of ``name`` that ``df`` doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Hint a broadcast only when the counted ``rows`` are at most ``limit``; else leave the join to shuffle."""
    return F.broadcast(df) if rows <= limit else df


def join_by_key(frame: DataFrame, per_key: DataFrame, key: str | list[str], count: str, rows: int) -> DataFrame:
    """Inner join of ``frame``, of ``rows`` rows at most, with ``per_key``, which has one row per key and the key's number of rows as ``count``.

    Few keys are broadcast.  Of many, only those that are heavy are, as their rows would meet in one
    task otherwise; there can't be more than ``BROADCAST_KEYS`` of these.  ``count`` isn't in the result.
    """
    if rows > BROADCAST_KEYS:
        per_key = checkpointed(per_key)
    if rows <= BROADCAST_KEYS or per_key.count() <= BROADCAST_KEYS:
        return frame.join(F.broadcast(per_key.drop(count)), key)
    heavy = F.col(count) > max(HEAVY, rows // BROADCAST_KEYS)
    heavies = per_key.where(heavy).drop(count)
    light = frame.join(F.broadcast(heavies.select(key)), key, "left_anti").join(per_key.where(~heavy).drop(count), key)
    return frame.join(F.broadcast(heavies), key).unionByName(light)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id per vertex of an undirected edge list.

    ``edges`` has columns ``a`` and ``b``.  Alternating large-star and
    small-star rounds; the edge list shrinks to one star per component in a logarithmic number of rounds.
    The smallest neighbours are found by partial aggregation and joined back without gathering the edges of a
    vertex, so the centre of a large star is no hot key.  Nothing but one
    row of totals per round reaches the driver.  Returns ``id, label`` for every
    vertex of an edge (self loops are ignored).
    """
    edges = checkpointed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    rows, seen = edges.count(), None
    small = lambda df: sized(df, 2 * rows)
    edges = small(edges)
    lowest = (F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    for _ in range(max_rounds):
        both = small(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        low = small(both.groupBy("u").agg(*lowest)).select("u", F.least("u", "m").alias("m"), "n")
        large = small(small(join_by_key(both, low, "u", "n", 2 * rows)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = small(large.groupBy("u").agg(*lowest))
        pairs = small(join_by_key(large, low, "u", "n", 2 * rows))
        stars = (
            pairs.where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
        )
        edges = checkpointed(small(small(stars).distinct()))
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == (now["n"], now["h"]):
            break
        seen = (now["n"], now["h"])
    else:
        raise RuntimeError("connected components did not settle")
    # Settled edges are stars: every vertex but a root has one edge, to its root.
    roots = small(edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
    return small(edges.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(roots))
