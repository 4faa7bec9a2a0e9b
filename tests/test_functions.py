"""Functions and rules on hand-picked values."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions import mentions as N
from quillspark.functions import rules as U
from quillspark.functions import text as T
from quillspark.functions.targets import in_order
from quillspark.operators import incremental as I
from quillspark.operators import providers as L
from quillspark.operators import records as R


def one(spark, column, **values):
    """The value of a column over one row."""
    if not values:
        return spark.range(1).select(column.alias("v")).first().v
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "items, text",
    [(["a", "", " b "], "a;;b"), ([], ""), (None, ""), (["  "], ""), ([" NA "], "NA"), (["x", None, "y"], "x;;y")],
)
def test_listed(spark, items, text):
    assert one(spark, T.listed(F.col("a")), a=items) == text if items else one(spark, T.listed(F.lit(None).cast("array<string>"))) == ""


@pytest.mark.parametrize(
    "text, items",
    [
        ('["A", " B "]', ["A", "B"]), ("<0>A;;B", ["<0>A", "B"]), ("[bad", ["[bad"]), ("A, Inc.", ["A", "Inc."]), ("  ", []), (None, []),
        ("[bad, c", ["[bad", "c"]), ('["a", null]', ["a"]), ("A;;;;B", ["A", "B"]),
    ],
)
def test_parsed_list(spark, text, items):
    assert one(spark, T.parsed_list(F.col("a")), a=text) == items


@pytest.mark.parametrize(
    "text, first, last",
    [
        ("x\n```json\n{\"a\": 1}\n```\n```json\n[2]\n```", '{"a": 1}', "[2]"),
        ("no fence {\"a\": {\"b\": 1}} end", "no fence {\"a\": {\"b\": 1}} end", '{"a": {"b": 1}}'),
        ("nothing", "nothing", None),
        ("```\nplain\n```", "```\nplain\n```", "plain"),
    ],
)
def test_fences(spark, text, first, last):
    assert one(spark, T.first_json(F.col("a")), a=text) == first
    assert one(spark, T.last_json(F.col("a")), a=text) == last


def test_small_ones(spark):
    assert one(spark, T.cache_key(F.col("a")), a=" Drug A/B-c ") == "drug_a_b_c"
    assert one(spark, T.without_rank(F.col("a")), a=" <12> Firm ") == "Firm"
    assert one(spark, T.firms_key(F.col("a")), a=["B ", "a", ""]) == json.dumps(["a", "b"])
    assert one(spark, T.search_query(F.lit("d"), F.col("a")), a=["x", "y"]) == "(d AND (x OR y))"
    assert one(spark, T.search_query(F.lit("d"), F.col("a")), a=["x"]) == "(d AND x)"
    assert one(spark, T.search_query(F.lit("d"), F.array().cast("array<string>"))) is None
    assert one(spark, T.section(F.col("a"), "<!-- A -->", "<!-- B -->"), a="p\n<!-- A --> t\n\n body \n<!-- B -->") == "body"
    assert one(spark, T.section(F.col("a"), "[", "]"), a="none") is None
    assert one(spark, T.shortened(F.col("a"), 3), a="abcd") == "abc... [truncated]"
    assert one(spark, T.equivalence_key(F.col("a")), a="PD-1 Inhibitor") == "pd1inhibitor"
    assert one(spark, T.without_bom(F.col("a")), a="﻿x") == "x"
    assert one(spark, T.shown(F.col("a"), "none"), a=" ") == "(EMPTY - none)"
    assert one(spark, T.conforms(F.col("a"), {"r": "array"}), a='{"r": ["x"]}') is True
    assert one(spark, T.conforms(F.col("a"), {"r": "array"}), a='{"q": 1}') is False


@pytest.mark.parametrize(
    "title, primary, secondary, comparator",
    [
        ("A plus B", ["A", "B"], [], []), ("A with or without B", ["A"], ["B"], []), ("A ± B", ["A"], ["B"], []), ("A vs B", ["A"], [], ["B"]),
        ("A as a single agent or in combination with B", ["A"], ["B"], []), ("A 20 mg followed by B versus placebo", ["A", "B"], [], []), ("A alone and in combination with B", ["A", "B"], [], []), ("A and/or B", ["A"], ["B"], []),
    ],
)
def test_title_roles(spark, title, primary, secondary, comparator):
    row = spark.createDataFrame([(title,)], "t string").select(*[U.by_role(F.col("t"), r).alias(r) for r in ("primary", "secondary", "comparator")]).first()
    assert (row.primary, row.secondary, row.comparator) == (primary, secondary, comparator)


@pytest.mark.parametrize(
    "text, name",
    [("flt3 inhibitor", "FLT3 Inhibitor"), ("  PD-1 blockers", "PD-1 Inhibitor"), ("CD20/CD3-Targeted T Cell Engager", "CD3/CD20-Targeted T Cell Engager"), ("tki", "Tyrosine Kinase Inhibitor"), ("anti-PD1 antibody", "PD1-Targeted Antibody"), ("stem cell", "Stem Cell Therapy")],
)
def test_class_names_settle(spark, text, name):
    assert one(spark, U.class_name(F.col("a")), a=text) == name
    assert one(spark, U.class_name(F.col("a")), a=name) == name


def test_classes_of_nothing_are_na(spark):
    assert one(spark, U.classes(F.col("a")), a=["chemotherapy"]) == ["NA"]
    assert one(spark, U.classes(F.col("a")), a=["chemotherapy", "magnesium sulfate"]) == ["Mineral Supplement"]


def test_parents_and_last_wins(spark):
    df = spark.createDataFrame([("a", 1, "B#1"), ("a", 2, "B#13"), ("b", 1, "B#1")], "k string, pos int, c string")
    assert {tuple(r) for r in R.without_parents(df, ["k"], "c").collect()} == {("a", "B#13"), ("b", "B#1")}
    assert {tuple(r) for r in R.last_wins(df, ["k"], ["pos"], ["c"]).collect()} == {("a", 1, "B#13"), ("b", 1, "B#1")}


def test_memoised_step_is_idempotent(spark):
    rows = spark.range(10).withColumnRenamed("id", "k")
    step = lambda new: new.withColumn("v", F.lit("x"))
    first, kept = I.memoised(rows, spark.createDataFrame([], "k long, v string"), ["k"], step)
    again, new = I.memoised(rows, kept, ["k"], lambda n: n.withColumn("v", F.lit("y")))
    assert sorted(first.collect()) == sorted(again.collect())
    assert new.count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.text(alphabet="ab c-/", max_size=5), max_size=4), min_size=1, max_size=30))
def test_lists_survive_a_round_trip(spark, lists):
    rows = [(x,) for x in lists]
    df = spark.createDataFrame(rows, "a array<string>").withColumn("t", T.listed(F.col("a")))
    for r in df.withColumn("b", T.parsed_list(F.concat("t", F.lit(";;")))).collect():
        assert r.b == [x.strip() for x in r.a if x.strip()]


def test_pretty_json_is_what_python_writes(spark):
    rows = [
        (1, ["a", 'q"\\ \n', "é🙂"], {"k": [1, 2]}, (True, None, ["x"])), (2, [], {}, (False, "t", [])), (3, None, None, None), (4, [None, "z"], {"a": [], "b": None}, (None, None, None)),
    ]
    kinds = {"l": "array<string>", "m": "map<string,array<int>>", "s": "struct<ok:boolean,note:string,items:array<string>>"}
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} {k}" for c, k in kinds.items()))
    got = {r.id: r for r in df.select("id", *[T.pretty_json(F.col(c), k).alias(c) for c, k in kinds.items()]).collect()}
    text = lambda x: "" if x is None else json.dumps(x, indent=2, ensure_ascii=False)
    for i, items, pairs, s in rows:
        fields = None if s is None else {n: v for n, v in zip(("ok", "note", "items"), s, strict=True) if v is not None}
        assert (got[i].l, got[i].m, got[i].s) == (text(items), text(pairs), text(fields))


def test_outside_work_is_done_once(spark):
    """Calls are counted in executors, however often their results are read."""
    calls = spark.sparkContext.accumulator(0)

    def counted(rows):
        def run(batches):
            for pdf in batches:
                calls.add(len(pdf))
                yield pdf

        return rows.mapInPandas(run, rows.schema)

    rows = spark.range(6).withColumn("n", F.lit(0))
    out = L.agent_loop(rows, lambda rest: counted(rest).withColumn("n", F.col("n") + 1), F.col("n") > F.col("id") % 3, most=5)
    assert out.count() == 6 and out.agg(F.sum("n")).first()[0] == 12
    assert calls.value == 6 + 4 + 2
    done = spark.createDataFrame([(0, 9)], "id long, n int")
    every, new = I.memoised(rows.select("id"), done, ["id"], lambda rest: counted(rest.withColumn("n", F.lit(1))))
    assert every.count() == 6 and new.count() == 5 and calls.value == 12 + 5
    full, fetched = I.cached_lookup(rows.select("id"), spark.createDataFrame([(0, [1]), (1, [])], "id long, r array<int>"), ["id"], "r", lambda rest: counted(rest.withColumn("r", F.array(F.lit(1)))))
    assert full.count() == 6 and fetched.count() == 5 and calls.value == 17 + 5


def test_standalone_steps_keep_whole_records_only(spark):
    items = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2), (3, 1)], "id int, pos int")
    answers = spark.createDataFrame([(1, 1, "success", "a"), (1, 2, "success", "b"), (2, 1, "success", "c"), (2, 2, "failed", "d")], "id int, pos int, status string, output string")
    out = I.standalone(items, ["id"], "pos", lambda rows: rows.join(answers, ["id", "pos"]))
    assert sorted(out.collect()) == [(1, 1, "a"), (1, 2, "b")]


def test_rules_have_no_length_limits(spark):
    many = [f"d{i}" for i in range(1500)]
    row = spark.createDataFrame([([], many, "x" * 3000 + " ends")], "p array<string>, s array<string>, t string")
    primary, secondary = U.with_primary(F.col("p"), F.col("s"))
    got = row.select(primary.alias("p"), secondary.alias("s"), U.title_case(F.col("t")).alias("t")).first()
    assert (got.p, got.s, got.t) == (["d0"], many[1:], "X" + "x" * 2999 + " Ends")


def test_formatting_twice_changes_nothing(spark):
    texts = ["flt3 inhibitors", "PD-1 blockade", "anti-PD1 antibody", "CD20/CD3-Targeted T Cell Engagers", "monoclonal antibodies", "BM1 targeted therapy", "bi-specific antibodies", "BCR-ABL inhibitor", "alkylating agents", "dendritic cells"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(U.class_name(F.col("t")).alias("once")).select("once", U.class_name(F.col("once")).alias("twice"))
    assert all(r.once == r.twice for r in rows.collect())


def test_captured_classes(spark):
    cases = {
        "Drug G is a bispecific antibody targeting CD3 and CD20.": ["CD3/CD20-Targeted Bispecific Antibody"], "Drug H is a trispecific antibody.": ["Trispecific Antibody"], "Drug E is a GLP-1 agonist.": ["GLP-1 Agonist"],
        "Drug N is a BIKE targeting CD3/CD19.": ["CD3/CD19-Targeted BIKE"], "Drug is an exon skipping therapy.": ["Exon Skipping Therapy"], "Patient failed prior EGFR antagonist": [], "Drug J is an estrogen receptor modulator.": ["Estrogen Receptor Modulator"],
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", N.captured(F.col("t")).alias("c"))
    assert {r.t: r.c for r in rows.collect()} == cases


def test_contexts_hide_their_own_mentions_only(spark):
    cases = {
        "Drug is an estrogen receptor antagonist; stops drug-induced nausea": "Estrogen Receptor Antagonist",
        "A MEK inhibitor for patients resistant to a BRAF inhibitor of v1.2 and an ALK inhibitor. It is no TKI": "MEK Inhibitor;;Tyrosine Kinase Inhibitor",
        "immune checkpoint inhibitor-related colitis, treated with a JAK2 inhibitor": "JAK2 Inhibitor",
        "previously treated with a PD-1 inhibitor\nnow on a CTLA-4 inhibitor": "CTLA-4 Inhibitor",
        "Antimicrobial Agent Stewardship Program: an H2 antagonist": "H2 Antagonist",
        "platinum-refractory disease refractory to ADC": "", "": "", "ADCs and a HER2-targeted ADC, and ADC": "Antibody Drug Conjugate;;HER2-Targeted Antibody Drug Conjugate",
    }
    rows = spark.createDataFrame([(t,) for t in cases] + [(None,)], "t string").select("t", F.array_join(N.captured(F.col("t")), ";;").alias("c")).collect()
    assert {r.t: r.c for r in rows} == cases | {None: ""}


def test_targets_have_a_natural_order(spark):
    cases = {"PD-L1/CTLA-4": "CTLA-4/PD-L1", "CD20 and CD3": "CD3/CD20", "CD123, CD19, and CD3": "CD3/CD19/CD123", "IL-17/IL-6": "IL-6/IL-17", "HER2/4-1BB": "4-1BB/HER2", "BCR-ABL": "BCR-ABL", "CD3/CD3": "CD3/CD3"}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", in_order(F.col("t")).alias("o")).collect()
    assert {r.t: r.o for r in rows} == cases


def test_mentions_take_time_in_proportion_to_the_text(spark):
    texts = [("word " * 40_000,), ("PD-1/" * 20_000 + "x",), ("anti-" * 20_000,), ("a-b-" * 20_000 + "induced",)]
    rows = spark.createDataFrame(texts, "t string").select(F.size(N.captured(F.col("t"))).alias("n"))
    assert rows.count() == 4 and rows.agg(F.sum("n")).first()[0] is not None
