"""Text functions, Column to Column: all stay in the JVM.

"Missing" is what is null, empty, or an empty list. White space is what ASCII has of it, and the no-break space.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

WHITE = r"[ \t\n\x0B\f\r ]"
STRINGS = "array<string>"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{WHITE}+|{WHITE}+$", "")


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def first_truthy(*texts: Column) -> Column:
    """The first text that is neither null nor empty."""
    return F.coalesce(*[F.when(t != "", t) for t in texts])


def first_filled(*lists: Column) -> Column:
    """The first list that is neither null nor empty; else an empty one."""
    return F.coalesce(*[F.when(F.size(a) > 0, a) for a in lists], F.array().cast(STRINGS))


def filled(items: Column) -> Column:
    """Items that are not missing, stripped afterwards, so blank ones become empty."""
    return F.transform(F.filter(items, lambda x: x.isNotNull() & (x != "")), strip)


def listed(items: Column, by: str = ";;") -> Column:
    """a;;b of a list; empty for none."""
    return or_empty(F.array_join(filled(items), by))


def keyed_lines(entries: Column, skip_empty: bool = False) -> Column:
    """Lines `"key": a;;b` of array<struct<key, items>>; skip_empty leaves out keys without items."""
    if skip_empty:
        entries = F.filter(entries, lambda e: listed(e["items"]) != "")
    return or_empty(F.array_join(F.transform(entries, lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), listed(e["items"]))), "\n"))


def json_text(value: Column) -> Column:
    """Compact JSON; empty for null."""
    return or_empty(F.to_json(value))


def pretty_json(value: Column, kind: DataType | str) -> Column:
    """JSON with an indent of two, other scripts as they are; empty for null. kind: the value's type. Fields that are null are left out."""
    return or_empty(_pretty(value, kind if isinstance(kind, DataType) else DataType.fromDDL(kind), ""))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value computed once however often `then` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _pretty(value: Column, kind: DataType, indent: str) -> Column:
    deeper = indent + "  "

    def block(items: Column, opening: str, closing: str) -> Column:
        """Null items are left out; no item is an empty text."""
        lines = lambda joined: F.when(joined == "", opening + closing).otherwise(F.concat(F.lit(f"{opening}\n{deeper}"), joined, F.lit(f"\n{indent}{closing}")))
        return let(F.array_join(items, f",\n{deeper}"), lines)

    def named(name: Column, item: Column, item_kind: DataType) -> Column:
        return F.concat(_quoted(name), F.lit(": "), F.coalesce(_pretty(item, item_kind, deeper), F.lit("null")))

    if isinstance(kind, ArrayType):
        return block(F.transform(value, lambda x: F.coalesce(_pretty(x, kind.elementType, deeper), F.lit("null"))), "[", "]")
    if isinstance(kind, MapType):
        return block(F.transform(F.map_entries(value), lambda e: named(e["key"].cast("string"), e["value"], kind.valueType)), "{", "}")
    if isinstance(kind, StructType):
        fields = F.array(*[F.when(value[f.name].isNotNull(), named(F.lit(f.name), value[f.name], f.dataType)) for f in kind.fields])
        return F.when(value.isNotNull(), block(fields, "{", "}"))
    return _quoted(value) if isinstance(kind, StringType) else value.cast("string")


def _quoted(text: Column) -> Column:
    return F.when(text.isNotNull(), let(F.to_json(F.array(text)), lambda t: F.substring(t, F.lit(2), F.length(t) - 2)))


def parsed_list(text: Column) -> Column:
    """A list from JSON, `;;` or comma separated text, or one value; items stripped, empty ones dropped. Bad JSON falls through."""
    bare = strip(or_empty(text))
    parsed = F.when(bare.startswith("["), F.from_json(bare, STRINGS))
    split = F.when(bare.contains(";;"), F.split(bare, ";;")).when(bare.contains(","), F.split(bare, ",")).otherwise(F.array(bare))
    return F.filter(F.transform(F.coalesce(parsed, split), lambda x: strip(or_empty(x))), lambda x: x != "")


def comma_list(text: Column) -> Column:
    return F.filter(F.transform(F.split(or_empty(text), ","), strip), lambda x: x != "")


def without_rank(text: Column) -> Column:
    """Without a leading <number>, stripped."""
    return strip(F.regexp_replace(strip(text), r"^<\d+>", ""))


def cache_key(name: Column) -> Column:
    return F.translate(strip(F.lower(name)), " /-", "___")


def file_name(name: Column) -> Column:
    return F.translate(name, r"/\:", "___")


def step_path(record: Column, step: Column) -> Column:
    return F.concat(F.lit("abstracts/"), record, F.lit("/"), step, F.lit(".json"))


def cache_path(name: Column) -> Column:
    return F.concat(F.lit("search_cache/"), cache_key(name), F.lit(".json"))


def workflow_id(record: Column) -> Column:
    return F.concat(F.lit("entity-extraction-"), record)


FENCED_JSON = r"(?s)```json\s*(.*?)\s*```"
FENCED = r"(?s)```(?:json)?\s*(.*?)\s*```"
BRACES = r"(?s)\{.*\}"


def first_json(text: Column) -> Column:
    """What stands in the first block fenced as JSON; else the text itself."""
    return F.when(text.rlike(FENCED_JSON), F.regexp_extract(text, FENCED_JSON, 1)).otherwise(text)


def last_json(text: Column) -> Column:
    """What stands in the last fenced block; else from the first to the last brace; else null."""
    blocks = F.regexp_extract_all(text, F.lit(FENCED), F.lit(1))
    return F.when(F.size(blocks) > 0, F.element_at(blocks, -1)).when(text.rlike(BRACES), F.regexp_extract(text, BRACES, 0))


def is_json(text: Column) -> Column:
    return F.call_function("try_parse_json", text).isNotNull()


def conforms(text: Column, required: dict[str, str]) -> Column:
    """Whether text is a JSON object with all required keys of the right kind (string or array)."""
    checks = [F.get_json_object(text, f"$['{k}']").isNotNull() & ((F.get_json_object(text, f"$['{k}']").startswith("[")) if kind == "array" else F.lit(True)) for k, kind in required.items()]
    met = is_json(text)
    for c in checks:
        met = met & c
    return F.coalesce(met, F.lit(False))


def section(text: Column, begin: str, end: str) -> Column:
    """What stands between two markers, without the rest of the first marker's line, stripped; null if a marker is missing."""
    quoted = lambda s: "".join(f"\\{c}" if not c.isalnum() and c not in " _" else c for c in s)
    pattern = f"(?s){quoted(begin)}[^\\n]*\\n(.*?){quoted(end)}"
    return F.when(text.rlike(pattern), strip(F.regexp_extract(text, pattern, 1)))


def fill(template: Column, values: dict[str, Column]) -> Column:
    """Replaces {name} by each value, in the order given."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), or_empty(value))
    return template


def shortened(text: Column, most: int = 5000) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("... [truncated]"))).otherwise(text)


def model_parts(name: Column, default: str = "openai") -> tuple[Column, Column]:
    """Provider and model of provider/model; the default provider if there is no slash."""
    parts = F.split(name, "/")
    slash = name.contains("/")
    return F.when(slash, F.get(parts, 0)).otherwise(default), F.when(slash, F.get(parts, 1)).otherwise(name)


def equivalence_key(name: Column) -> Column:
    """Equal for names that differ in case, hyphens and spaces only."""
    return F.lower(F.regexp_replace(name, r"[-\s]", ""))


def utc_stamp(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def file_stamp(time: Column) -> Column:
    return F.date_format(time, "yyyyMMdd_HHmmss")


def shown(text: Column, reason: str) -> Column:
    """The text, or a note that it is empty."""
    return F.when(strip(or_empty(text)) == "", F.lit(f"(EMPTY - {reason})")).otherwise(text)


def without_bom(text: Column) -> Column:
    return F.regexp_replace(text, "^﻿+", "")


def rounded(seconds: Column) -> Column:
    return F.round(seconds, 2)


# What a search for a drug's classes asks for, and where.
CLASS_TERMS = ("Mechanism of Action", "12.1 Mechanism of Action", "MoA", "mode of action", "Pharmacologic Class", "Pharmacological Class", "Chemical Class", "Therapeutic Class", "Drug Class")
CLASS_DOMAINS = ("nih.gov", "fda.gov", "clinicaltrials.gov")


def class_query(drug: Column) -> Column:
    """The boolean query for a drug's classes."""
    return F.concat(F.lit('("'), drug, F.lit('" AND (' + " OR ".join(f'"{t}"' for t in CLASS_TERMS) + "))"))


def in_domains(url: Column, domains: tuple[str, ...] = CLASS_DOMAINS) -> Column:
    """Whether a URL's host is one of the domains or lies below one."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/:?#]+)", 1))
    return F.exists(F.array(*[F.lit(d) for d in domains]), lambda d: (host == d) | host.endswith(F.concat(F.lit("."), d)))


def firms_key(firms: Column) -> Column:
    """Canonical JSON text of a set of names: lower case, stripped, sorted, as `["a", "b"]`."""
    names = F.array_sort(F.filter(F.transform(firms, lambda x: strip(F.lower(x))), lambda x: x != ""))
    return F.concat(F.lit("["), F.array_join(F.transform(names, lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ", "), F.lit("]"))


def search_query(drug: Column, firms: Column) -> Column:
    """(d AND f) or (d AND (f1 OR f2)); null without names."""
    any_of = F.when(F.size(firms) == 1, F.get(firms, 0)).otherwise(F.concat(F.lit("("), F.array_join(firms, " OR "), F.lit(")")))
    return F.when(F.size(firms) > 0, F.concat(F.lit("("), drug, F.lit(" AND "), any_of, F.lit(")")))


def numbered(items: Column, render: Callable[[Column, Column], Column], by: str = "\n\n") -> Column:
    """Joins render(number from 1, item) of a list."""
    return or_empty(F.array_join(F.transform(items, lambda x, i: render((i + 1).cast("string"), x)), by))
