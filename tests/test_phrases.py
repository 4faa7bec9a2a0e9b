"""Dictionary phrases in titles against a walk of a trie, and the roles that they give."""

import random
import re


from quillspark.operators import phrases

TOKEN = re.compile(r"[^\W_]+(?:[-/'][^\W_]+)*|[+±]")


def walk(text, entries):
    """The leftmost longest matches, token by token."""
    trie = {}
    for phrase, kind, value in entries:
        node = trie
        for t in TOKEN.findall(phrase.lower()):
            node = node.setdefault(t, {})
        if node is not trie:
            node.setdefault("", []).append((phrases.KINDS.index(kind), kind, value))
    words, at, out = TOKEN.findall((text or "").lower()), 0, []
    while at < len(words):
        node, best = trie, None
        for k in range(at, len(words)):
            node = node.get(words[k])
            if node is None:
                break
            if "" in node:
                best = (at, k + 1 - at, *min(node[""])[1:])
        out += [best] if best else []
        at += best[1] if best else 1
    return out


def test_matches_are_those_of_a_trie(spark):
    draw = random.Random(3)
    words = ["a", "b", "ab", "a-b", "with", "or", "without", "é", "+", "±", "Drug"]
    entries = list({(" ".join(draw.choice(words) for _ in range(draw.randrange(1, 5))), draw.choice(phrases.KINDS)) for _ in range(60)})
    entries = [(p, k, p.upper() if k == "drug" else None) for p, k in entries]
    titles = [(k, draw.choice([" ", ", "]).join(draw.choice(words) for _ in range(draw.randrange(0, 40)))) for k in range(200)] + [(500, None), (501, "...")]
    df = spark.createDataFrame(titles, "id int, title string").repartition(3)
    got = {r.id: [tuple(m) for m in r.found] for r in phrases.matches(df, "id", "title", spark.createDataFrame(entries, "phrase string, kind string, value string")).collect()}
    want = {k: walk(t, entries) for k, t in titles}
    assert got == {k: v for k, v in want.items() if v}


def test_roles(spark):
    cases = {
        "Drug A (Drug B) plus Drug C vs. DRUG A + drug d": (["Drug A", "Drug B", "Drug C"], [], ["Drug A", "Drug D"]),
        "Drug A ± Drug B + Drug C": (["Drug A", "Drug C"], ["Drug B"], []),
        "with or without Drug A ± Drug B": (["Drug A"], ["Drug B"], []),
        "Comparing Drug A with Drug B and Drug C": (["Drug A"], [], ["Drug B", "Drug C"]),
        "Drug A Extra in drug a extra": (["Drug A Extra"], [], []),
        "refractory to Drug A": ([], [], []), "": ([], [], []), None: ([], [], []), "oral placebo or Drug D": (["Drug D"], [], []),
    }
    drugs = spark.createDataFrame([(f"Drug {x}",) for x in "ABCD"] + [("Drug A Extra",), ("Drug A",)], "name string")
    df = spark.createDataFrame(list(enumerate(cases)), "id int, title string")
    found = {r.id: (r.primary, r.secondary, r.comparator) for r in phrases.roles(df, "id", "title", phrases.dictionary(drugs, "name")).collect()}
    assert found == dict(enumerate(cases.values()))
    plan = phrases.roles(df, "id", "title", phrases.dictionary(drugs, "name"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
