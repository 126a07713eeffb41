"""Column functions on measured values, calls, drugs, ids and paths.

All are built-in expressions.  Where two consumers treat null-like words differently, the word
list is a parameter; the lists themselves are fixed values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that stand for "no value", by consumer.
NON_MIC = ("s", "r", "i", "susceptible", "resistant", "intermediate", "nd", "na", "n/a", "none", "null", "-", "")
BLANK = ("", "none", "nan", "null")
ACCESSION_BLANK = ("", "none", "nan", "null", "-")
SCORER_BLANK = ("", "nan", "none", "na", "n/a", "-")
# Synonyms of calls and drugs.
SIR_CALLS = {
    "s": "S", "susceptible": "S", "susceptibility": "S",
    "i": "I", "intermediate": "I",
    "r": "R", "resistant": "R", "resistance": "R",
    "ns": "NS", "non-susceptible": "NS", "non susceptible": "NS", "nonsusceptible": "NS",
    "non-susceptibility": "NS", "non susceptibility": "NS", "nonsusceptibility": "NS",
    "nr": "NR", "non-resistant": "NR", "non resistant": "NR", "nonresistant": "NR",
    "non-resistance": "NR", "non resistance": "NR", "nonresistance": "NR",
}
DRUG_ALIASES = {
    "rifampicin": "rifampin",
    "co-trimoxazole": "trimethoprim/sulfamethoxazole",
    "cotrimoxazole": "trimethoprim/sulfamethoxazole",
    "trimethoprim-sulfamethoxazole": "trimethoprim/sulfamethoxazole",
    "trimethoprim sulfamethoxazole": "trimethoprim/sulfamethoxazole",
}
MIC_PATTERN = r"^\s*(<=|>=|<|>|=)?\s*(\d+(?:\.\d+)?(?:\s*/\s*\d+(?:\.\d+)?)*)\s*$"
_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def lookup(values: dict[str, str]) -> Column:
    """A map literal of a small dictionary."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


# Fixed value: characters that are white space in some script.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with more columns, each computed once a row, however often later steps use them.

    They come out of a generator, as the optimiser would copy those of a projection into every filter above it. Lambdas don't belong here: they run outside of generated code.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def strip(c: Column) -> Column:
    """Without surrounding white space of any script."""
    return F.btrim(c, F.lit(WHITE))


def _strip_plain(c: Column) -> Column:
    """As ``strip``, for a column: its search for each end among all white space runs only where an end isn't a visible ASCII character."""
    seen = lambda x: F.ascii(x).between(33, 126)
    return F.when(seen(c) & seen(F.substring(c, -1, 1)), c).otherwise(strip(c))


def collapse(c: Column) -> Column:
    """Runs of white space as one blank."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def null_if(c: Column, words: tuple[str, ...]) -> Column:
    """Stripped, or null where the value is one of ``words``."""
    s = _strip_plain(c)
    return F.when(~F.lower(s).isin(*words), s)


def is_blank(c: Column) -> Column:
    return null_if(c, BLANK).isNull()


def scorer_clean(c: Column) -> Column:
    """As the evaluator reads a cell: stripped, null-like words as the empty string."""
    return F.coalesce(null_if(c, SCORER_BLANK), F.lit(""))


def parse_mic(raw: Column) -> Column:
    """Struct ``operator, value`` of a measured value such as ``<= 0.5`` or ``32 / 16``; nulls where it's none."""
    text = null_if(raw, NON_MIC)
    value = F.nullif(F.regexp_extract(text, MIC_PATTERN, 2), F.lit(""))
    sign = F.coalesce(F.nullif(F.regexp_extract(text, MIC_PATTERN, 1), F.lit("")), F.lit("="))
    return F.struct(F.when(value.isNotNull(), sign).alias("operator"), F.regexp_replace(value, r"\s*/\s*", "/").alias("value"))


def general_format(x: Column, digits: int) -> Column:
    """A double with ``digits`` significant digits, no trailing zeros, and an exponent outside 1e-4 to 10^digits."""
    stripped = lambda s: F.regexp_replace(F.regexp_replace(s, r"(\.\d*?)0+$", "$1"), r"\.$", "")

    def body(sci: Column) -> Column:
        exponent = F.regexp_extract(sci, r"e([+-]\d+)$", 1).try_cast("int")
        plain = stripped(sci.try_cast("decimal(38,18)").cast("string"))
        size = F.abs(exponent).cast("string")
        power = F.concat(F.when(exponent < 0, "-").otherwise("+"), F.when(F.length(size) < 2, F.lpad(size, 2, "0")).otherwise(size))
        far = F.concat(stripped(F.regexp_extract(sci, r"^(.*)e", 1)), F.lit("e"), power)
        return F.when((exponent < -4) | (exponent >= digits), far).otherwise(plain)

    odd = F.when(F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf").when(x == 0, F.lit("0"))
    return odd.otherwise(let(F.format_string(f"%.{digits - 1}e", x), body))


def as_number(c: Column) -> Column:
    """Double, or null where the text isn't a decimal number or an infinity."""
    s = strip(c)
    endless = F.regexp_extract(s, r"(?i)^([+-]?)inf(?:inity)?$", 1)
    return F.when(s.rlike(_NUMBER), s.try_cast("double")).when(s.rlike(r"(?i)^[+-]?inf(inity)?$"), F.when(endless == "-", float("-inf")).otherwise(float("inf")))


def _integral_or(x: Column, digits: int) -> Column:
    """An integral value in full, up to 38 digits, and beyond in its shortest form with an exponent; others with ``digits`` digits."""
    size = F.abs(x)
    # Both parts of a larger value are exact.
    high = F.floor(size / 2.0**62)
    low = (size - high.cast("double") * 2.0**62).cast("bigint")
    large = high.cast("decimal(20,0)") * F.lit(2**62).cast("decimal(19,0)") + low.cast("decimal(20,0)")
    written = F.concat(F.when(x < 0, "-").otherwise(""), large.cast("decimal(38,0)").cast("string"))
    return (
        F.when((size < 2.0**62) & (x == x.try_cast("bigint").cast("double")), x.try_cast("bigint").cast("string"))
        .when((size >= 2.0**62) & (size < 2.0**124), written).when((size >= 2.0**124) & (size < float("inf")), general_format(x, 17))
        .otherwise(general_format(x, digits))
    )


# Numbers that are their own canonical form, but for zeros at the end of a fraction, and characters that no number has.
_WHOLE = r"(0|[1-9][0-9]{0,14})"
_NO_NUMBER = "[^0-9+.eEinftyINFTY-]"
_NO_RATIO = "[^0-9+.eEinftyINFTY/" + WHITE + "-]"


def _short_fraction(s: Column) -> Column:
    return F.rtrim(F.rtrim(s, F.lit("0")), F.lit("."))


def number_of(s: Column) -> Column:
    """``normalize_number`` of a cleaned column. Plain numbers and words, nearly all there is, don't take the way over doubles."""
    slow = let(as_number(s), lambda x: F.when(x.isNull(), F.lower(s)).otherwise(_integral_or(x, 12)))
    return (
        F.when(s == "", s).when(s.rlike(f"^{_WHOLE}$"), s).when(s.rlike(r"^(0|[1-9][0-9]{0,7})\.[0-9]{1,3}$"), _short_fraction(s))
        .when(s.rlike(_NO_NUMBER), F.lower(s)).otherwise(slow)
    )


def normalize_number(c: Column) -> Column:
    """Evaluator's canonical number: integral values without a point, others with 12 digits, the rest in lower case."""
    return let(scorer_clean(c), number_of)


def mic_of(s: Column) -> Column:
    """``normalize_mic`` of a column without blanks; as ``number_of``."""
    sides = F.transform(F.split(s, "/"), as_number)
    slow = let(sides, lambda x: F.when(F.forall(x, lambda v: v.isNotNull()), F.array_join(F.transform(x, lambda v: _integral_or(v, 6)), "/")).otherwise(s))
    return F.when(s.rlike(f"^{_WHOLE}(/{_WHOLE})*$") | s.rlike(_NO_RATIO), s).when(s.rlike(r"^(0|[1-9][0-9]{0,2})\.[0-9]{1,3}$"), _short_fraction(s)).otherwise(slow)


def normalize_mic(c: Column) -> Column:
    """Consensus' canonical value: each side of a ratio integral or with six digits; text that isn't a number stays."""
    return let(null_if(c, BLANK), mic_of)


def sign_of(s: Column) -> Column:
    """``normalize_sign`` of a cleaned column."""
    s = F.replace(F.replace(s, F.lit("≤"), F.lit("<=")), F.lit("≥"), F.lit(">="))
    return F.when(s.isin("=", "=="), "=").when(s.isin("<", "<=", ">", ">="), s).otherwise("")


def normalize_sign(c: Column) -> Column:
    return sign_of(scorer_clean(c))


def sir_of(s: Column) -> Column:
    """``normalize_sir`` of a cleaned column."""
    s = collapse(F.translate(F.lower(s), "‐‑‒–—", "-----"))
    return F.coalesce(F.try_element_at(lookup(SIR_CALLS), s), F.lit(""))


def normalize_sir(c: Column) -> Column:
    return sir_of(scorer_clean(c))


def drug_of(s: Column) -> Column:
    """``normalize_drug`` of a cleaned column."""
    s = collapse(F.lower(s))
    return F.coalesce(F.try_element_at(lookup(DRUG_ALIASES), s), s)


def normalize_drug(c: Column) -> Column:
    return drug_of(scorer_clean(c))


def normalize_id(c: Column) -> Column:
    return F.lower(collapse(strip(c)))


def repair_numeric_id(c: Column) -> Column:
    return F.regexp_replace(strip(c), r"^(\d+)\.0$", "$1")


def safe_file_name(c: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9_.-]+", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("table"))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def pmid_of_path(*paths: Column) -> Column:
    """First 7 or 8 digit word in a path's components, from the last one back; earlier paths win."""

    def one(path: Column) -> Column:
        found = F.transform(F.reverse(F.split(path, "/")), lambda p: F.regexp_extract(p, r"\b(\d{7,8})\b", 1))
        return F.get(F.filter(found, lambda x: x != ""), F.lit(0))

    return F.coalesce(*map(one, paths))


def pmid_in_path(path: Column) -> Column:
    """First run of 7 to 9 digits, else UNKNOWN."""
    return F.coalesce(F.nullif(F.regexp_extract(path, r"(?<!\d)(\d{7,9})(?!\d)", 1), F.lit("")), F.lit("UNKNOWN"))


def is_pmid(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[0-9]+$"), F.lit(False))


def strip_fence(c: Column) -> Column:
    """A JSON answer without its code fence."""
    return strip(F.regexp_replace(F.regexp_replace(strip(c), r"^```[A-Za-z]*\s*", ""), r"```\s*$", ""))


def publication_year(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"\d{4}", 0), F.lit(""))
