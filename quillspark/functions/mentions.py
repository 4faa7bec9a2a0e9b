"""Drug classes that a text's own words name, each within its clause.

Contexts in which a class says nothing of the drug are spans of the text: what follows "previously treated with" or "resistant to" up to the end of its
clause, the name before "-induced" or "related", and the title of a stewardship program. They are blanked, so a mention that touches one isn't there, and
others of the same text stay. What is left is read by one grammar in one pass, leftmost first: words that qualify, a modality, and its targets.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.rules import ABBREVIATIONS, GENERIC, class_name, overridden, without_general
from quillspark.functions.targets import LIST, SLASHED, TARGET

# Words that don't qualify a class.
STOP = (
    "a", "an", "the", "is", "are", "was", "were", "be", "been", "and", "or", "with", "of", "for", "by", "to", "in", "on", "from", "through", "via", "as", "both", "plus", "vs", "versus", "that", "which", "this", "it", "its", "not",
    "uses", "used", "use", "using", "works", "acts", "received", "receives", "receiving", "contains", "includes", "has", "have", "called", "named", "stops", "blocks", "targets", "treats", "inhibits", "drug", "drugs", "medication", "than", "but", "against", "after", "before",
)
# Contexts whose classes come after them, and those whose classes come before.
AHEAD = ("previously treated with", "prior treatment with", "previous treatment with", "pretreated with", "failed prior", "failed previous", "refractory to", "resistant to", "resistance to", "intolerant to")
BEHIND = ("related", "induced", "associated")
# Modalities, platforms, cell types, and classes that are captured whole.
HEADS = ("inhibitors?", "blockers?", "blockade", "agonists?", "antagonists?", "modulators?", "degraders?", "antibod(?:y|ies)", "engagers?", "agents?", "stimulants?")
PLATFORMS = ("BIKE", "TRIKE", "SMITE", "PROTAC")
CELLS = ("autologous", "allogeneic", "hematopoietic", "mesenchymal", "stem", "progenitor", "NK", "CAR[- ]?T", "dendritic", "T", "B")
WHOLE = ((r"TIL therap(?:y|ies)|tumou?r[- ]infiltrating lymphocyte therap(?:y|ies)", "TIL Therapy"), (r"exon[- ]skipping therap(?:y|ies)", "Exon Skipping Therapy"), (r"gene therap(?:y|ies)", "Gene Therapy"), (r"anti-?metabolites?", "Anti-Metabolite"))

_WORD = r"[A-Za-z0-9]++(?:[/-][A-Za-z0-9]++)*+"
_MORE = rf"(?:(?!(?i:{'|'.join(STOP)})\b(?![/-])){_WORD} )"
_CLAUSE = r"(?:[^.;!?\n]++|[.](?=\S))*+"
_SHORT = "|".join([*PLATFORMS, *ABBREVIATIONS])
_HEAD = rf"(?i:antibody[- ]drug conjugates?|{'|'.join(HEADS)}|targeted therap(?:y|ies))"
CONTEXT = (
    rf"(?i)\b(?:{'|'.join(AHEAD)})\b{_CLAUSE}",
    rf"(?<![A-Za-z0-9/-])(?:{_MORE}){{0,5}}[A-Za-z0-9]++(?:[/-](?!(?i:{'|'.join(BEHIND)})\b)[A-Za-z0-9]++)*+[- ](?i:{'|'.join(BEHIND)})\b",
    rf"(?<![A-Za-z0-9/-])(?:{_MORE}){{0,5}}(?i:stewardship programs?)\b",
)
MENTION = (
    r"(?<![A-Za-z0-9/-])(?:"
    + "|".join(
        (
            rf"(?i:{'|'.join(p for p, _ in WHOLE)})",
            rf"(?:{SLASHED}[- ](?i:targeted) )?(?:{_SHORT})s?(?![A-Za-z0-9])(?! (?i:degraders?|engagers?)\b)(?: targeting {LIST})?",
            rf"(?:(?i:{'|'.join(CELLS)}) )++(?i:cells?)(?=\s+(?i:products?|therap(?:y|ies)|infusions?)\b|\s*(?:$|[.,;)])|\s(?i:and|or|for|in)\b)",
            rf"(?i:anti)-{SLASHED} (?:{_MORE}){{0,2}}(?i:therap(?:y|ies))",
            rf"(?:{_MORE}){{0,5}}(?:(?!(?i:antibody-drug)\b)[A-Za-z0-9]++[/-])*+{_HEAD}(?: targeting {LIST})?",
            rf"(?i:inhibits) {TARGET}",
        )
    )
    + r")(?![A-Za-z0-9])"
)


def without_contexts(text: Column) -> Column:
    """The text, with a break in place of each context in which no class is captured."""
    out = text
    for pattern in CONTEXT:
        out = F.regexp_replace(out, pattern, " ; ")
    return out


def _named(found: Column) -> Column:
    """The class that a mention stands for."""
    whole = F.coalesce(*[F.when(found.rlike(f"^(?i:{p})$"), F.lit(c)) for p, c in WHOLE])
    inhibited = F.when(found.rlike("^(?i:inhibits) "), F.concat(F.regexp_replace(found, "^(?i:inhibits) ", ""), F.lit("-Inhibitor")))
    cells = F.when(found.rlike("(?i) cells?$"), class_name(F.regexp_replace(found, r"^(?i:car)[- ]?t ", "CAR-T ")))
    return F.coalesce(whole, inhibited, cells, class_name(found))


def captured(text: Column) -> Column:
    """The classes that a text names, in its order, each once: nothing from contexts, no label that is too general."""
    found = F.regexp_extract_all(without_contexts(F.coalesce(text, F.lit(""))), F.lit(MENTION), F.lit(0))
    return F.array_except(F.array_distinct(F.transform(found, _named)), F.array(*[F.lit(g) for g in GENERIC]))


def classes_of(text: Column) -> Column:
    """The classes of a text by all rules: the one that its words force, else those that it names without the general ones beside them, else NA."""
    forced = overridden(text)
    named = without_general(captured(text))
    return F.when(forced.isNotNull(), F.array(forced)).when(F.size(named) > 0, named).otherwise(F.array(F.lit("NA")))
