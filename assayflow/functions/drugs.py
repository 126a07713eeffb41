"""Drug names in headers and cells."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Drugs that may be reported.
ANTIBIOTICS = (
    "amoxicillin/clavulanic acid", "ampicillin", "antibiotic", "arbekacin", "azithromycin", "biapenem", "cefazolin", "cefoxitin", "ceftarolin", "ceftaroline",
    "chloramphenicol", "chlorhexidine gluconate", "ciprofloxacin", "clarithromycin", "clindamycin", "dalbavancin", "daptomycin", "doripenem", "erythromycin",
    "florfenicol", "fosfomycin", "fusidic acid", "gentamicin", "imipenem", "kanamycin", "levofloxacin", "linezolid", "meropenem", "methicillin", "minocycline",
    "moxifloxacin", "mupirocin", "norfloxacin", "oritavancin", "oxacillin", "penicillin", "phosphomycin", "quinupristin/dalfopristin", "rifampin", "streptomycin",
    "sulfamethoxazole/trimethoprim", "tedizolid", "teicoplanin", "telavancin", "tetracycline", "tiamulin", "tigecycline", "tobramycin", "trimethoprim",
    "trimethoprim/sulfamethoxazole", "trimethoprim/sulfonamide", "vancomycin",
)
# Abbreviations in table headers.
ABBREVIATIONS = {
    "amc": "amoxicillin/clavulanic acid", "amp": "ampicillin", "an": "amikacin", "cfz": "cefazolin", "czo": "cefazolin", "fox": "cefoxitin", "cpt": "ceftaroline", "chl": "chloramphenicol",
    "cip": "ciprofloxacin", "clr": "clarithromycin", "cli": "clindamycin", "cc": "clindamycin", "dal": "dalbavancin", "dap": "daptomycin", "dor": "doripenem", "ery": "erythromycin",
    "ffc": "florfenicol", "fof": "fosfomycin", "fos": "fosfomycin", "fus": "fusidic acid", "fa": "fusidic acid", "gen": "gentamicin", "gm": "gentamicin", "cn": "gentamicin",
    "ipm": "imipenem", "imi": "imipenem", "kan": "kanamycin", "lvx": "levofloxacin", "lev": "levofloxacin", "lnz": "linezolid", "lzd": "linezolid", "mem": "meropenem", "mer": "meropenem",
    "met": "methicillin", "min": "minocycline", "mxf": "moxifloxacin", "mox": "moxifloxacin", "mup": "mupirocin", "nor": "norfloxacin", "ori": "oritavancin", "oxa": "oxacillin",
    "pen": "penicillin", "qda": "quinupristin/dalfopristin", "syn": "quinupristin/dalfopristin", "rif": "rifampin", "ra": "rifampin", "str": "streptomycin",
    "sxt": "trimethoprim/sulfamethoxazole", "tmp-smx": "trimethoprim/sulfamethoxazole", "tzd": "tedizolid", "tec": "teicoplanin", "tlv": "telavancin", "tet": "tetracycline",
    "tia": "tiamulin", "tgc": "tigecycline", "tob": "tobramycin", "nn": "tobramycin", "tmp": "trimethoprim", "van": "vancomycin", "va": "vancomycin",
}


def _quoted(name: str) -> str:
    return re.sub(r"([./()])", r"\\\1", name)


def drug_of_header(header: Column, drugs: tuple[str, ...] = ANTIBIOTICS) -> Column:
    """Drug that a column header names: an abbreviation, else the longest listed name in it; null for none."""
    low = F.lower(strip(header))
    bare = F.trim(F.regexp_replace(F.regexp_replace(low, r"\(.*?\)|\[.*?\]", ""), r"\b(mic|mg/l|mg/liter|ug/ml|µg/ml|sir)\b", ""))
    abbreviation = F.create_map(*[F.lit(x) for k, v in ABBREVIATIONS.items() if v in drugs for x in (k, v)])
    longest = sorted(drugs, key=lambda d: (-len(d), d))
    named = F.regexp_extract(low, "(?<![a-z])(" + "|".join(map(_quoted, longest)) + ")(?![a-z])", 1)
    first = F.array(*[F.when(low.rlike(f"(?<![a-z]){_quoted(d)}(?![a-z])"), F.lit(d)) for d in longest])
    return F.coalesce(F.try_element_at(abbreviation, bare), F.when(named != "", F.get(F.filter(first, lambda x: x.isNotNull()), F.lit(0))))


def names_drug(cell: Column, drugs: tuple[str, ...] = ANTIBIOTICS) -> Column:
    """Whether a cell is a drug of 3 characters or more, or contains one of more than 4."""
    low = F.lower(strip(cell))
    known = [d.lower().strip() for d in drugs if len(d.strip()) >= 3]
    # One pattern: a lambda would clean and lower the cell anew for each drug.
    long = [r"\Q" + d + r"\E" for d in known if len(d) > 4]
    contained = low.rlike("|".join(long)) if long else F.lit(False)
    return F.coalesce(low.isin(*known) | contained, F.lit(False)) & (F.coalesce(low, F.lit("")) != "")


def split_combined(value: Column, names: Column) -> Column:
    """``array<struct<drug, value>>`` of a column such as ``EM/CLDM`` with cells such as ``4/8``, by place."""
    drugs, values = F.split(names, "/"), F.split(value, "/")
    return F.transform(drugs, lambda d, i: F.struct(strip(d).alias("drug"), strip(F.get(values, i)).alias("value")))
