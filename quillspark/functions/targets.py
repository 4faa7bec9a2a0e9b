"""Biological targets in the names of drug classes: what a target is, lists of them, their order, and where they stand in a name.

A target is a name with two capitals or digits, with hyphens inside: PD-1, CTLA-4, 4-1BB, BCR-ABL, CD20. Lists are joined by slashes, commas or "and".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.text import let

#: Endings that a hyphen may join to a target without being a part of it.
_NOT_PART = r"(?!(?i:targeted|inhibitors?|related|induced|associated|specific)\b)"
TARGET = rf"(?=[A-Za-z0-9-]*?[A-Z0-9][A-Za-z0-9-]*?[A-Z0-9])[A-Z0-9][A-Za-z0-9]*+(?:-{_NOT_PART}[A-Za-z0-9]++)*+"
SLASHED = rf"{TARGET}(?:/{TARGET})*+"
LIST = rf"{TARGET}(?:(?:/|, and | and |, ){TARGET})*+"


def natural_key(name: Column) -> Column:
    """Sorts names by their letters, and runs of digits by their number: CD3 before CD20."""
    runs = F.regexp_extract_all(F.upper(name), F.lit("[0-9]+|[^0-9]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike("^[0-9]"), F.lpad(F.regexp_replace(r, "^0+(?=.)", ""), F.greatest(F.length(r), F.lit(9)), "0")).otherwise(r)), "")


def in_order(targets: Column) -> Column:
    """A list of targets in natural order, joined by slashes."""
    names = F.transform(F.split(targets, "/|, and | and |, "), lambda t: F.struct(natural_key(t).alias("key"), t.alias("name")))
    return F.array_join(F.transform(F.array_sort(names), lambda t: t["name"]), "/")


def targeted(name: Column) -> Column:
    """A class name with its targets in order and in front.

    "... targeting X and Y", "anti-X ...", "X-targeted ..." and "X targeted ..." become "X-Targeted ...", and so do several targets in front of an
    antibody or engager; a degrader, an inhibitor and other modalities have their targets in front without that word.
    """
    part = lambda pattern, k: F.regexp_extract(name, pattern, k)
    behind = rf"^(.+?) targeting ({LIST})$"
    anti, before = rf"^(?i:anti)[- ]({SLASHED})[- ](.+)$", rf"^({SLASHED})[- ](?i:targeted)[- ](.+)$"
    several = rf"^({TARGET}(?:/{TARGET})++)[- ](.+)$"
    put = lambda pattern, of, rest, by: let(in_order(part(pattern, of)), lambda t: F.concat(t, by, part(pattern, rest)))
    return (
        F.when(name.rlike(rf"^(?i:(?:PROTAC )?degraders?) targeting {LIST}$"), F.concat(in_order(part(behind, 2)), F.lit(" Degrader")))
        .when(name.rlike(behind), put(behind, 2, 1, F.lit("-Targeted ")))
        .when(name.rlike(anti), put(anti, 1, 2, F.lit("-Targeted ")))
        .when(name.rlike(before), put(before, 1, 2, F.lit("-Targeted ")))
        .when(name.rlike(several), put(several, 1, 2, F.when(name.rlike(r"(?i)(?:antibod(?:y|ies)|engagers?|conjugates?)$"), "-Targeted ").otherwise(" ")))
        .otherwise(name)
    )
