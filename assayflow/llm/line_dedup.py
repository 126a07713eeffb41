"""Operator 2, line dedup by site-relative frequency.

Pages are grouped by host.  A line is boilerplate on a host when the number of
its pages with that line, divided by the host's page total, exceeds ``ratio``.
Pages with the same host and text count once in both numbers, so that copies of a page don't
turn its own lines into boilerplate; and a line on fewer than ``min_pages`` pages stays, as on a host of a few pages
every line would exceed the ratio.  Lines are compared after trimming.

Only hashes of lines are shuffled, with partial aggregation, so that a very common line
or a host with a third of all pages doesn't gather in a task.  Texts stay where they are: each page
gets its host's list of boilerplate lines, broadcast after the lines were counted.  Where there are too many
lines for that, each host's list is dealt to ``SALTS`` tasks, and the host's pages among them.  A list is cut into ``CELLS`` by hash, so that
looking up a line doesn't walk through all of it.

Edge cases: a null text stays null and an empty one empty; a null host is a host of
its own; blank lines are never dropped; repeated rows are treated alike; hosts
with few pages are safe through ``min_pages``; an empty table gives no rows; the column ``out`` is added or
replaced, all other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, release, unused

#: A line goes when it is on more than this share of a host's pages, and on this many at least.
RATIO, MIN_PAGES = 0.05, 5
#: Boilerplate lines of all hosts up to which their lists are broadcast; beyond it the join shuffles, with a host's pages in so many parts.
BROADCAST_LINES, SALTS = 200_000, 64
#: Parts of a host's list, by hash of the line.
CELLS = 64


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit("\x20\t\r"))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))


def html_lines(html: Column) -> Column:
    """Visible text of a page, one block element or source line per line."""
    text = F.regexp_replace(html, r"(?is)<(?:script[^>]*>.*?</script>|style[^>]*>.*?</style>|!--.*?-->)", "")
    text = F.regexp_replace(text, r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|tr|td|th|table|article|section|nav|header|footer|title|body|head|html)(?:\s[^>]*)?/?>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def drop_boilerplate(pages: DataFrame, host: Column, text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, out: str = "lines") -> DataFrame:
    """``pages`` with ``text_col`` cleaned, and a struct ``out`` (n_lines, n_dropped) added.

    Pages and lines are known by two 64-bit hashes each.  A host has fewer boilerplate lines than its
    mean number of lines per page divided by ``ratio``, so they fit in one array per host.
    """
    columns = [c for c in pages.columns if c.lower() != out.lower()]
    site = F.coalesce(host, F.lit("\u0000"))
    key = lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"))
    # All other columns of the input go in one struct, so that no name of theirs meets one of these.
    others = F.struct(F.lit(0).alias(unused(pages, "none")), *[F.col(f"`{c}`") for c in columns if c != text_col])
    keyed = pages.select(site.alias("host"), F.col(f"`{text_col}`").alias("text"), others.alias("row"))
    page = keyed.where(F.col("text").isNotNull()).select("host", key(F.col("text")).alias("page"), F.split("text", "\n").alias("all"))
    # Every page also counts for the null line, whose number of pages is the host's total.
    hashes = F.array_distinct(F.transform(F.filter(F.transform("all", trimmed), lambda x: x != ""), key))
    each = F.explode(F.concat(hashes, F.array(F.lit(None).cast("struct<a:bigint,b:bigint>"))))
    counts = page.select("host", "page", each.alias("line")).groupBy("host", "line").agg(F.count_distinct("page").alias("n"))
    counts = checkpointed(counts.where(F.col("line").isNull() | (F.col("n") >= min_pages)))
    total = counts.where(F.col("line").isNull()).select("host", F.col("n").alias("pages"))
    boiler = checkpointed(counts.where(F.col("line").isNotNull()).join(total, "host").where(F.col("n") > F.lit(ratio) * F.col("pages")).select("host", "line"))
    n = boiler.count()
    release(counts)
    cell = lambda line: F.pmod(line["a"], F.lit(CELLS)).cast("int")
    celled = boiler.groupBy("host", cell(F.col("line")).alias("cell")).agg(F.collect_list("line").alias("own"))
    per_host = celled.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("cell", "own"))).alias("m"))
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")
    per_host = per_host.select("host", F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda i: F.coalesce(F.col("m")[i], none)).alias("boiler"))
    if n <= BROADCAST_LINES:
        joined = keyed.join(F.broadcast(per_host), "host", "left")
    else:
        dealt = per_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = keyed.withColumn("salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int")).join(dealt, ["host", "salt"], "left")
    lines, listed = F.split("text", "\n"), F.col("boiler").isNotNull() & F.col("text").isNotNull()
    is_boiler = lambda k: F.array_contains(F.get(F.col("boiler"), cell(k)), k)
    kept = F.filter(lines, lambda x: ~is_boiler(key(trimmed(x))))
    full = F.coalesce(F.size(F.filter(F.transform(lines, trimmed), lambda x: x != "")), F.lit(0)).cast("long")
    joined = joined.withColumns({"kept": F.when(listed, kept), "full": full})
    dropped = F.when(F.col("kept").isNull(), 0).otherwise(F.size(lines) - F.size("kept")).cast("long")
    info = F.struct(F.col("full").alias("n_lines"), dropped.alias("n_dropped")).alias(out)
    clean = F.when(F.col("kept").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n"))
    return joined.select(*[clean.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in columns], info)
