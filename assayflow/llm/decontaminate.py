"""Operator 9, benchmark decontamination by size-partitioned MinHash containment search.

A test item is found in a document when at least ``threshold`` of the item's distinct
five-word shingles are in the document.  An item of fewer words has its whole sequence as its one shingle, which is
looked for among the documents' runs of as many words.

1. Items are partitioned by shingle width and by the power of two of their number of shingles.  An item's signature are its
   smallest hash values: as many as it may miss, and ``need`` more, a quarter of what its partition's
   smallest size must share.  They are a random sample of its shingles.
2. A document's signature are its hash values up to the largest that a signature holds in the partitions whose items could be contained in
   a document of its size.  Longer documents have longer signatures, so containment can be estimated however unequal the sizes are.
3. The estimate for a pair is the share of the item's signature that is in the document's.  An item that reaches
   the threshold has at least ``need`` of its values there, however its shingles are scattered, so what is below that is ruled out and
   no true pair is lost.
4. The pairs left are verified on the exact shingle strings.

Built-in functions only.  Words are the runs of letters and digits in lower
case, so that changed punctuation and spacing do not hide a passage.

Edge cases: null, empty and wordless texts match nothing; an item of a single word is found in every document with that word;
rows with one id, or none, count as one item or document, which has the shingles of all of them; null ids are reported as null;
repeated rows change nothing; empty tables give no rows; other columns don't matter.  ``remove_contaminated`` judges each row by its own text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpointed, unused

WIDTH, THRESHOLD = 5, 0.75
#: Shingles of all items, and documents with a candidate, up to which they are broadcast; beyond it the joins shuffle.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _runs(words_col: str, width: int, of, kind: str) -> Column:
    """``of(i)`` for each start of a run of ``width`` words."""
    last = F.size(words_col) - width
    found = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), of)
    return F.when(last >= 0, found).otherwise(F.array().cast(f"array<{kind}>"))


def shingles(words_col: str, width: int = WIDTH) -> Column:
    """Strings of ``width`` consecutive words, with repeats; none for a shorter text."""
    return _runs(words_col, width, lambda i: F.array_join(F.slice(words_col, i + 1, width), " "), "string")


def hashed_shingles(words_col: str, width: int = WIDTH) -> Column:
    """64-bit hashes of the shingles, without building their strings."""
    w = F.col(words_col)
    return _runs(words_col, width, lambda i: F.xxhash64(*[w[i + k] for k in range(width)]), "bigint")


def item_shingles(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """``item, width, s, h``: the distinct shingles of items with columns ``item`` and ``text``."""
    worded = items.select("item", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    own = F.least(F.size("w"), F.lit(width)).alias("width")
    of_width = lambda f: F.coalesce(*[F.when(F.least(F.size("w"), F.lit(width)) == k, f("w", k)) for k in range(1, width + 1)])
    both = F.arrays_zip(of_width(shingles).alias("s"), of_width(hashed_shingles).alias("h"))
    return worded.select("item", own, F.explode(both).alias("z")).select("item", "width", "z.s", "z.h").distinct()


def signatures(tests: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``item, width, part, n_item, need, signature`` from ``item_shingles``."""
    # An item id may have rows of fewer words beside longer ones: its size counts all, its signature those of its widest shingles.
    per = tests.groupBy("item").agg(F.count_distinct("s").alias("n_item"), F.max("width").alias("width"))
    own = tests.join(per, ["item", "width"]).groupBy("item", "width", "n_item").agg(F.array_sort(F.collect_set("h")).alias("minima"))
    n, have = F.col("n_item"), F.size("minima")
    part = F.ceil(F.log2(n.cast("double"))).cast("int")
    smallest = F.when(part == 0, F.lit(1)).otherwise(F.pow(F.lit(2.0), part - 1) + 1)
    must = F.ceil(n * threshold) - (n - have)  # of the widest shingles
    need = F.greatest(F.lit(1), F.least(F.floor(smallest * threshold / 4), must)).cast("int")
    length = F.when(must < 1, have).otherwise(F.least(have, have - must + need)).cast("int")
    return own.select("item", "width", part.alias("part"), "n_item", need.alias("need"), F.slice("minima", F.lit(1), length).alias("signature"))


def up_to(values: Column, limit: Column) -> Column:
    return F.filter(values, lambda v: v <= limit)


def document_signature(words_col: str, parts: list, threshold: float = THRESHOLD) -> Column:
    """Hash values of a document that may be in an item's signature, by the bounds ``parts`` (width, part, largest value)."""
    out = []
    for width in sorted({p["width"] for p in parts}):
        limit = None
        for p in sorted((p for p in parts if p["width"] == width), key=lambda p: p["part"]):
            smallest = 1 if p["part"] == 0 else 2 ** (p["part"] - 1) + 1
            fits = F.size(words_col) - width + 1 >= math.ceil(smallest * threshold) if width == WIDTH else F.lit(True)
            own = F.when(fits, F.lit(p["top"]).cast("bigint"))
            limit = own if limit is None else F.greatest(limit, own)
        out.append(up_to(hashed_shingles(words_col, width), limit))
    return F.array_distinct(F.concat(*out))


def contained(texts: DataFrame, items: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """``doc, item, n_item, n_shared`` from ``doc, text`` and ``item, text`` with n_shared >= threshold * n_item."""
    tests = checkpointed(item_shingles(items, width))
    signed = checkpointed(signatures(tests, threshold))
    # At most one row for each width and power of two.
    parts = signed.groupBy("width", "part").agg(F.max(F.array_max("signature")).alias("top")).collect()
    widths = sorted(r["width"] for r in tests.select("width").distinct().collect())
    rows = tests.count()
    small = lambda frame: broadcast_if_small(frame, rows, BROADCAST_ROWS)
    if not parts:
        return tests.select(F.lit(None).cast(texts.schema["doc"].dataType).alias("doc"), "item", F.lit(0).cast("bigint").alias("n_item"), F.lit(0).cast("bigint").alias("n_shared")).limit(0)

    worded = texts.where(F.col("text").isNotNull()).select("doc", words(F.col("text")).alias("w"))
    values = signed.select("item", "need", F.explode("signature").alias("h"))
    found = checkpointed(
        worded.select("doc", F.explode(document_signature("w", parts, threshold)).alias("h"))
        .join(small(values.select("h").distinct()), "h", "left_semi")
        .distinct()
        .join(small(values), "h")
        .groupBy("doc", "item", "need").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= F.col("need"))
        .select("doc", "item")
    )
    suspects = broadcast_if_small(found.select("doc").distinct(), found.count(), BROADCAST_ROWS)
    again = worded.join(suspects, "doc", "left_semi")
    again = again.select("doc", F.explode(F.array_distinct(F.concat(*[shingles("w", k) for k in widths]))).alias("s")).join(small(tests.select("s").distinct()), "s", "left_semi").distinct()
    shared = again.join(small(tests.select("item", "s").distinct()), "s").groupBy("doc", "item").agg(F.count(F.lit(1)).alias("n_shared"))
    sized = shared.join(small(signed.select("item", "n_item")), "item").where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item"))
    return sized.join(found, ["doc", "item"], "left_semi").select("doc", "item", "n_item", "n_shared")


def find(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """Pairs ``doc_id, item_id, n_item, n_shared`` with n_shared >= threshold * n_item, n_item > 0."""
    # Ids go in structs, as null ids then join like any other.
    texts = docs.select(F.struct(F.col(doc_id).alias("id")).alias("doc"), "text")
    found = contained(texts, items.select(F.struct(F.col(item_id).alias("id")).alias("item"), "text"), threshold, width)
    return found.select(F.col("doc.id").alias("doc_id"), F.col("item.id").alias("item_id"), "n_item", "n_shared")


def remove_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents in which no test item is found; each row is judged by its text, known by two 64-bit hashes, whatever its id."""
    key = unused(docs, "text_key")
    keyed = docs.withColumn(key, F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")))
    found = contained(keyed.select(F.col(key).alias("doc"), "text"), items.select(F.struct("item_id").alias("item"), "text"), threshold)
    bad = checkpointed(found.select(F.col("doc").alias(key)).distinct())
    return keyed.join(broadcast_if_small(bad, bad.count(), BROADCAST_ROWS), key, "left_anti").select(*docs.columns)
