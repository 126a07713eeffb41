"""Article XML: tables, supplement references and availability sections, as Python table functions.

Spark's xpath functions can't return nested rows, lose mixed content and fail on
malformed input, so the tree is walked here.  Elements are found by local name; malformed
XML gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.papers import AVAILABILITY_HEADING, deposited

_LINK = "{http://www.w3.org/1999/xlink}href"
_HEADING = re.compile(AVAILABILITY_HEADING, re.IGNORECASE)


def local_name(tag) -> str:
    return tag.rsplit("}", 1)[-1] if isinstance(tag, str) else ""


def _tree(xml: str | None):
    try:
        return ElementTree.fromstring(xml) if xml else None
    except (ElementTree.ParseError, ValueError):
        return None


def _text(element) -> str:
    return " ".join("".join(element.itertext()).split()) if element is not None else ""


def _spaced_text(element) -> str:
    """Text of a section, with a blank between its elements."""
    return " ".join(" ".join(element.itertext()).split())


def _all(root, *names: str) -> Iterator:
    return (e for e in root.iter() if local_name(e.tag) in names)


@F.udtf(returnType="table_idx int, label string, caption string, row_idx int, cells array<string>")
class XmlTables:
    """Rows of every table-wrap in document order; blank rows and tables without rows are left out."""

    def eval(self, xml: str):
        root = _tree(xml)
        for t, wrap in enumerate(_all(root, "table-wrap") if root is not None else ()):
            label, caption = (_text(next(_all(wrap, n), None)) for n in ("label", "caption"))
            at = 0
            for row in _all(wrap, "tr"):
                cells = [_text(c) for c in _all(row, "td", "th")]
                if any(cells):
                    yield t, label, caption, at, cells
                    at += 1


@F.udtf(returnType="ordinal int, href string")
class SupplementRefs:
    """Distinct local references of supplementary-material elements and their media and graphics."""

    def eval(self, xml: str):
        root, seen = _tree(xml), []
        for block in _all(root, "supplementary-material") if root is not None else ():
            for e in (block, *_all(block, "media", "graphic")):
                href = e.get(_LINK) or e.get("href")
                if href and not href.startswith(("http://", "https://")) and href not in seen:
                    seen.append(href)
                    yield len(seen) - 1, href


@F.udtf(returnType="section_idx int, section_text string")
class AvailabilitySections:
    """Text of sections, notes and footnotes that state where data is deposited, by type or heading."""

    def eval(self, xml: str):
        root, n = _tree(xml), 0
        for e in _all(root, "sec", "notes", "fn") if root is not None else ():
            kind = " ".join(v for k, v in e.attrib.items() if k.endswith("type")).lower()
            titled = any(local_name(c.tag) == "title" and _HEADING.search(_text(c)) for c in e)
            if "data-availability" in kind or titled:
                yield n, _spaced_text(e)
                n += 1


def tables(papers: DataFrame, xml: str = "xml") -> DataFrame:
    """``pmid, table_idx, label, caption, rows`` of every paper."""
    spread = papers.lateralJoin(XmlTables(F.col(xml).outer()))
    ordered = F.array_sort(F.collect_list(F.struct("row_idx", "cells")))
    return spread.groupBy("pmid", "table_idx", "label", "caption").agg(F.transform(ordered, lambda r: r["cells"]).alias("rows"))


def supplement_refs(papers: DataFrame, xml: str = "xml") -> DataFrame:
    return papers.lateralJoin(SupplementRefs(F.col(xml).outer())).select("pmid", "ordinal", "href")


def data_availability(papers: DataFrame, xml: str = "xml") -> DataFrame:
    """``pmid, found, accessions``: whether a statement exists, and its accessions, which may be none."""
    found = papers.lateralJoin(AvailabilitySections(F.col(xml).outer())).groupBy("pmid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section_idx", "section_text"))), lambda s: s["section_text"]), " ").alias("t"))
    joined = papers.select("pmid").join(found, "pmid", "left")
    return joined.select("pmid", F.col("t").isNotNull().alias("found"), F.coalesce(deposited(F.col("t")), F.array().cast("array<string>")).alias("accessions"))
