"""Rules on titles, drug classes and indications, as Column expressions. Word lists are fixed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.targets import targeted
from quillspark.functions.text import let, strip

# What stands between drugs of a title, by the role of the drug after it.
SECONDARY = (
    "single agent or in combination with", "monotherapy and/or in combination with", "monotherapy or in combination with",
    "alone or in combination with", "or in combination with", "with or without", "alone or with", "plus/minus", "and/or", "±",
)
COMPARATOR = ("compared with", "to compare with", "comparing to", "to compare", "comparing", "versus", "vs")
PRIMARY = (
    "single agent and in combination with", "monotherapy and in combination with", "alone and in combination with", "given together with",
    "in combination with", "combined with", "in combo with", "followed by", "plus", "with", "and", "or", "+",
)
MARK = {"secondary": "\x01", "comparator": "\x02", "primary": "\x03"}
# What is never a drug.
EXCLUDED = r"(?i)^(?:placebo|chemotherapy|radiotherapy|immunotherapy|fluoropyrimidine|nct[0-9]+|intravenous|subcutaneous|oral|topical|i\.v\.|s\.c\.|inhibitor|blockade|antagonist|agonist|blocker)$"
DOSAGE = r"(?i)\s*\b[0-9]+(?:\.[0-9]+)?\s?(?:mg|mcg)\b"
# Labels too general to be a class.
GENERIC = (
    "Chemotherapy", "Immunotherapy", "Radiation Therapy", "Immunosuppressant", "Anti-tumor", "Anti-cancer", "Antibody", "Targeted Therapy", "Small Molecule", "Hormone", "Immunotherapeutic",
    "Hormone Stimulation Therapy", "Antineoplastic Agent", "Adjuvant", "Agent", "Inhibitor", "Agonist", "Antagonist", "Modulator", "Degrader", "Engager", "Conjugate", "Stimulant",
)
# Abbreviations and what they stand for.
ABBREVIATIONS = {"ADC": "Antibody Drug Conjugate", "ICI": "Immune Checkpoint Inhibitor", "TKI": "Tyrosine Kinase Inhibitor", "BITE": "Bispecific T-cell Engager"}
# Texts that make a class whatever else they say, by pattern.
OVERRIDES = (
    (r"(?i)\b(?:pet imaging|diagnostic|radiotracer|18f-|68ga-|technetium)", "Diagnostic Imaging Agent"),
    (r"(?i)\b(?:magnesium|calcium|potassium|zinc(?! finger)|iron)\b(?! (?:channel|antagonist|blocker|inhibitor|receptor)s?\b)", "Mineral Supplement"),
    (r"(?i)\bvaccine", "Vaccine"),
    (r"(?i)platelet-rich plasma", "Plasma Therapy"),
    (r"(?i)\b(?:androgen deprivation|adt|hormonal therapy)\b", "Hormonal Therapy"),
)
# Regimens and their parts.
REGIMENS = {"CHOP": ("Cyclophosphamide", "Doxorubicin", "Vincristine", "Prednisone"), "FOLFIRI": ("Folinic Acid", "Fluorouracil", "Irinotecan")}
CLASS_PRIORITY = {"MoA": 1, "Chemical": 2, "Mode": 3, "Therapeutic": 4}
# Modalities that must stay what the source calls them.
MODALITIES = ("antibody", "inhibitor", "agonist", "antagonist", "modulator", "degrader", "engager", "vaccine")


def _between(words: tuple[str, ...]) -> str:
    quoted = "|".join("".join(f"\\{c}" if c in "+/." else c for c in w) for w in words)
    return rf"(?i)(?:^|[\s,]+)(?:{quoted})\s+"


def marked(title: Column) -> Column:
    """The title with a mark of the role before each drug but the first; longer phrases go first."""
    out = F.regexp_replace(title, r"(?i)\bas a (single agent)", "$1")
    for role, words in (("secondary", SECONDARY), ("comparator", COMPARATOR), ("primary", PRIMARY)):
        out = F.regexp_replace(out, _between(words), MARK[role])
    return out


def by_role(title: Column, role: str) -> Column:
    """The drugs of a title that have a role; the first drug is primary. Exclusions and dosages are taken out."""
    parts = F.filter(F.split(F.regexp_replace(marked(title), r"([\x01-\x03])", "\x04$1"), "\x04"), lambda p: p != "")
    mine = F.filter(parts, lambda p: (p.startswith(MARK[role])) | ((~p.rlike(r"^[\x01-\x03]")) & F.lit(role == "primary")))
    return F.filter(F.transform(mine, lambda p: strip(F.regexp_replace(F.regexp_replace(p, r"[\x01-\x03]", ""), DOSAGE, ""))), lambda p: (p != "") & ~p.rlike(EXCLUDED))


def with_primary(primary: Column, secondary: Column) -> tuple[Column, Column]:
    """Primary is never empty while there is another drug: the first secondary is promoted."""
    promote = (F.size(primary) == 0) & (F.size(secondary) > 0)
    return F.when(promote, F.slice(secondary, 1, 1)).otherwise(primary), F.when(promote, F.slice(secondary, F.lit(2), F.size(secondary))).otherwise(secondary)


def kept_drugs(names: Column) -> Column:
    return F.filter(names, lambda n: ~n.rlike(EXCLUDED))


def cell_name(name: Column) -> Column:
    """Stem-cell procedures become cells, CAR-T becomes CAR-T Cell."""
    bare = strip(F.regexp_replace(name, r"(?i)\s*\btransplant(?:ation)?\b", ""))
    return F.when(bare.rlike(r"(?i)^car[- ]?t(?:[- ]cells?)?$"), "CAR-T Cell").otherwise(bare)


def title_case(text: Column) -> Column:
    """First letters in upper case; gene names (letters, then digits) in capitals; other words in capitals or with digits stay."""
    word = lambda w: F.when(w.rlike(r"^[a-z]+[0-9]+$"), F.upper(w)).when(w.rlike(r"[0-9]") | (w.rlike(r"[A-Z]") & ~w.rlike(r"[a-z]")), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w))))
    return F.array_join(F.transform(F.split(text, " "), word), " ")


def singular(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"ies$", "y"), r"([^sui])s$", "$1")


def class_name(text: Column) -> Column:
    """Abbreviations, blockers, cells, targets with their modality; then title case and singular."""
    out = F.regexp_replace(strip(text), r"\s+", " ")
    for short, long in ABBREVIATIONS.items():
        out = F.regexp_replace(out, rf"^(?i:{short})s?$|\b{short}s?\b", long)
    out = F.regexp_replace(out, r"(?i)\b(?:blockers?|blockade)\b", "Inhibitor")
    out = F.regexp_replace(F.regexp_replace(out, r"(?i)\bbi-specific\b", "Bispecific"), r"(?i)\btri-specific\b", "Trispecific")
    out = F.regexp_replace(out, r"(?i)\b((?:bi|tri)specific) T cell (engagers?)\b", "$1 T-Cell $2")
    out = F.regexp_replace(let(out, targeted), r"(?i)\b(cells?)$", "Cell Therapy")
    return singular(title_case(out))


def overridden(text: Column) -> Column:
    """The one class that a text's words force, or null."""
    return F.coalesce(*[F.when(text.rlike(p), F.lit(c)) for p, c in OVERRIDES])


def classes(texts: Column) -> Column:
    """Class names of texts: overrides, then formatting, then exclusions; NA if none is left."""
    named = F.transform(texts, lambda t: F.coalesce(overridden(t), class_name(t)))
    left = F.array_except(named, F.array(*[F.lit(g) for g in GENERIC]))
    return F.when(F.size(left) > 0, left).otherwise(F.array(F.lit("NA")))


def without_general(names: Column) -> Column:
    """Anti-Metabolite goes where another class is named, and Immune Checkpoint Inhibitor where an inhibitor of a target is."""
    special = F.filter(names, lambda n: ~F.lower(n).isin("anti-metabolite", "antimetabolite"))
    left = F.when(F.size(special) > 0, special).otherwise(names)
    inhibitors = F.exists(left, lambda n: n.rlike(r"(?i)[- ]inhibitor$") & (F.lower(n) != "immune checkpoint inhibitor"))
    return F.when(inhibitors, F.filter(left, lambda n: F.lower(n) != "immune checkpoint inhibitor")).otherwise(left)


def keeps_wording(name: Column, source: Column) -> Column:
    """Whether every word of a class occurs in the text it was taken from, but for Targeted, Therapy and Inhibitor, which the formatting adds."""
    words = F.filter(F.split(F.lower(name), r"[^a-z0-9]+"), lambda w: (w != "") & ~w.isin("targeted", "therapy", "inhibitor"))
    return F.forall(words, lambda w: F.contains(_said(source), w))


def _said(source: Column) -> Column:
    """A text in lower case, with abbreviations in full, plurals in -ies singular and multispecifics in one word."""
    out = F.regexp_replace(F.regexp_replace(F.lower(source), r"ies\b", "y"), r"\b(bi|tri)-specific\b", "$1specific")
    for short, long in ABBREVIATIONS.items():
        out = F.regexp_replace(out, rf"\b{short.lower()}s?\b", long.lower())
    return out


def keeps_modality(name: Column, source: Column) -> Column:
    """Whether the modality of a class is one that its text names; blockers and blockades count as inhibitors."""
    said = F.regexp_replace(_said(source), r"block(?:ers?|ade)", "inhibitor")
    mine = F.filter(F.array(*[F.lit(m) for m in MODALITIES]), lambda m: F.contains(F.lower(name), m))
    return F.forall(mine, lambda m: F.contains(said, m))


def accepted(confidence: Column, choice: Column, choices: tuple[str, ...], low: float = 0.0, high: float = 1.0) -> Column:
    """Whether a number is within its bounds and a choice is one of those allowed; null is not."""
    return F.coalesce(confidence.between(low, high) & choice.isin(*choices), F.lit(False))


def within_limits(temperature: Column, max_tokens: Column, provider: Column, providers: tuple[str, ...] = ("openai", "anthropic", "google")) -> tuple[Column, Column]:
    """Whether a model's settings are allowed, and what is wrong with them: temperature from 0 to 2, from 1 to 100,000 tokens, a known provider. Null is not allowed."""
    checks = {"temperature": temperature.between(0.0, 2.0), "max_tokens": max_tokens.between(1, 100_000), "provider": provider.isin(*providers)}
    wrong = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
    return F.size(wrong) == 0, wrong


def quarantined(rows: DataFrame, accepted_rows: Column) -> tuple[DataFrame, DataFrame]:
    """The rows that meet a condition, and the others; null doesn't meet it."""
    ok = F.coalesce(accepted_rows, F.lit(False))
    return rows.where(ok), rows.where(~ok)


def components(drugs: DataFrame, drug: str, regimens: DataFrame) -> DataFrame:
    """drugs with `component` and its place: a regimen's drugs by a table of regimens (regimen, place, component), in any case; what is no regimen is itself."""
    table = regimens.select(F.upper(strip(F.col("regimen"))).alias("_regimen"), "place", F.col("component")).distinct()
    found = drugs.join(table, F.upper(strip(F.col(drug))) == F.col("_regimen"), "left")
    return found.select(*drugs.columns, F.coalesce("place", F.lit(1)).alias("place"), F.coalesce("component", drug).alias("component"))


def regimen_table(spark: SparkSession) -> DataFrame:
    """The regimens that are given as examples, as a table that others can be added to: regimen, place, component."""
    return spark.createDataFrame([(r, k, c) for r, cs in REGIMENS.items() for k, c in enumerate(cs, 1)], "regimen string, place int, component string")


def parts_of(drug: Column) -> Column:
    """A regimen's drugs; an unknown one is itself."""
    known = F.coalesce(*[F.when(F.upper(drug) == r, F.array(*[F.lit(c) for c in cs])) for r, cs in REGIMENS.items()])
    return F.coalesce(known, F.array(drug))


def source_of(title: Column, session: Column, disease: str) -> tuple[Column, Column]:
    """Which single source names a disease, and its text: the title, else the session, else none."""
    name = F.when(title.rlike(disease), "abstract_title").when(session.rlike(disease), "session_title").otherwise("none")
    return name, F.when(name == "abstract_title", title).when(name == "session_title", session).otherwise("")


def indication(text: Column) -> Column:
    """One indication: without gender, ethnicity and what induced it, single spaces, title case, singular."""
    out = F.regexp_replace(text, r"(?i)\b(?:male|female|men|women|chinese|asian)\b", "")
    out = F.regexp_replace(out, r"(?i)\b[a-z]+[- ](?:induced|related|associated)\b", "")
    return singular(title_case(strip(F.regexp_replace(out, r"\s+", " "))))


def supported(evidence: Column, source: Column) -> Column:
    """Whether the evidence occurs in the source, in any case."""
    return F.coalesce(F.contains(F.lower(source), F.lower(evidence)), F.lit(False))


def well_formed(text: Column) -> Column:
    """Separator and spacing rules of an indication list."""
    return ~text.rlike(r"\s;;|;;\s|^\s|\s$|\s\s|[^;];[^;]|,")
