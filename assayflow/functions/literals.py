"""Cells that hold a printed collection, the one check that needs Python's own parser."""

from __future__ import annotations

import ast
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

_ODD = re.compile(r"\b(nan|inf)\b")


def _is_collection(text: str) -> bool:
    try:
        return isinstance(ast.literal_eval(_ODD.sub("None", text.strip())), (tuple, list, dict))
    except (ValueError, SyntaxError, MemoryError, RecursionError):
        return False


@F.pandas_udf(BooleanType())
def _parsed(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v is not None and _is_collection(v)).astype(bool)


def is_dumped_collection(c: Column) -> Column:
    """True for a printed tuple, list or dict; only cells in brackets reach Python."""
    bracketed = F.coalesce(c.rlike(r"^\s*[\(\[\{][\s\S]*[\)\]\}]\s*$"), F.lit(False))
    return bracketed & _parsed(F.when(bracketed, c))
