"""The retry queue across restarts, and agents that look rules up."""

from itertools import groupby

from pyspark.sql import functions as F

from quillspark.operators import retries, tool_loop

POLICIES = {"a": retries.Policy(1, 3.0, 5, 4, ("ValueError",)), "b": retries.Policy(10, 2.0, 60, 2)}


def counted(spark, calls, plan):
    """A step that fails as plan says for (id, attempt), and counts how often it is asked."""

    def step(due):
        out = []
        for r in due.collect():
            calls.append(r.id)
            out.append((r.id, plan.get((r.id, calls.count(r.id)))))
        return spark.createDataFrame([o for o in out if o[1] != "lost"], "id long, error string")

    return step


def test_only_due_rows_are_tried_and_a_restart_goes_on(spark, tmp_path):
    items = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a"), (5, "none"), (6, "a"), (7, "b")], "id long, kind string")
    plan = {(2, 1): "E", (2, 2): "E", (3, 1): "E", (3, 2): "E", (4, 1): "ValueError", (5, 1): "E", (6, 1): "E", (6, 2): "E", (6, 3): "E", (6, 4): "E", (7, 1): "lost"}
    calls, clock, path = [], retries.Jumping(), str(tmp_path / "log")
    first = retries.retried(items, ["id"], "kind", counted(spark, calls, plan), path, POLICIES, clock, most_rounds=1)
    assert {r.id: r.state for r in first.collect()} == {1: "done", 2: "waiting", 3: "waiting", 4: "gave_up", 5: "gave_up", 6: "waiting", 7: "waiting"}
    assert sorted(calls) == [1, 2, 3, 4, 5, 6, 7]
    later = spark.createDataFrame([(8, "a")], "id long, kind string")  # a new job: what is open goes on, with a row more
    got = retries.retried(items.union(later), ["id"], "kind", counted(spark, calls, plan), path, POLICIES, clock)
    assert {r.id: (r.attempts, r.state, r.error) for r in got.collect()} == {
        1: (1, "done", None), 2: (3, "done", None), 3: (2, "gave_up", "E"), 4: (1, "gave_up", "ValueError"), 5: (1, "gave_up", "E"), 6: (4, "gave_up", "E"), 7: (2, "done", None), 8: (1, "done", None),
    }
    assert {i: calls.count(i) for i in set(calls)} == {1: 1, 2: 3, 3: 2, 4: 1, 5: 1, 6: 4, 7: 2, 8: 1}
    log = {(r.id, r.attempt): r["at"] for r in retries.attempts(spark, path).collect()}
    assert [log[2, k] for k in (1, 2, 3)] == [0, 1, 4] and [log[6, k] for k in (1, 2, 3, 4)] == [0, 1, 4, 9] and log[3, 2] == log[7, 2] == 10
    before = len(calls)
    assert retries.retried(items, ["id"], "kind", counted(spark, calls, plan), path, POLICIES, clock).count() == 8 and len(calls) == before


def test_an_empty_queue(spark, tmp_path):
    none = spark.createDataFrame([], "id long, kind string")
    assert retries.retried(none, ["id"], "kind", lambda due: due.withColumn("error", F.lit("E")), str(tmp_path / "log"), POLICIES, retries.Jumping()).count() == 0


RULES = [(1, "Role", "plus", "first"), (2, "Role", "vs", "second"), (3, "Role", "plus", "third"), (4, "Other", "plus", "fourth"), (5, None, None, "no one's")]


def test_calls_are_joined_with_the_rules(spark):
    rules = spark.createDataFrame(RULES, "rule_id int, category string, name string, rule string")
    calls = "array(named_struct('category', ' Role ', 'names', array(' plus', 'vs', 'vs')), named_struct('category', 'role', 'names', array('plus')), named_struct('category', cast(null as string), 'names', cast(null as array<string>)))"
    rows = spark.createDataFrame([(1,)], "id int").withColumn("calls", F.expr(calls))
    found = tool_loop.looked_up(rows, ["id"], rules).first().found
    assert [m.text for m in found] == ["1. first\n2. second\n3. third", "No rules found.", "No rules found."]


def test_agents_end_with_an_answer_or_without(spark):
    rules = spark.createDataFrame(RULES, "rule_id int, category string, name string, rule string")
    rows = tool_loop.started(spark.createDataFrame([(k, k) for k in range(5)], "id int, wants int"), F.lit("go"))

    def model(rest):
        n = F.size(F.filter("messages", lambda m: m["kind"] == "tool"))
        asked = F.expr("array(named_struct('category', 'Role', 'names', array('vs')))")
        return rest.withColumns({"calls": asked, "answer": F.when(n >= F.col("wants"), F.concat(F.lit("pass: "), n.cast("string")))})

    ran = {r.id: [m.kind for m in r.messages] for r in tool_loop.with_rules(rows, ["id"], rules, model, most=3).collect()}
    assert ran == {k: ["user"] + ["calls", "tool"] * min(k, 3) + ["answer"] * (k < 3) for k in range(5)}
    judged = {r.id: (r.validation_status, r.reason) for r in tool_loop.validated(rows, ["id"], rules, model, most=3).collect()}
    assert judged == {0: ("PASS", "0"), 1: ("PASS", "1"), 2: ("PASS", "2"), 3: ("REVIEW", "system_error"), 4: ("REVIEW", "system_error")}


def test_equal_calls_of_many_records_are_looked_up_once_and_kept_by_reference(spark):
    """The messages of 200 records with two lookups each hold no rule text; the texts are kept once a distinct call."""
    rules = spark.createDataFrame([(i, "c", f"n{i % 4}", "x" * 1000) for i in range(40)], "rule_id int, category string, name string, rule string")
    rows = tool_loop.started(spark.createDataFrame([(k,) for k in range(200)], "id int"), F.lit("go"))
    call = lambda *names: F.array(F.struct(F.lit(" c ").alias("category"), F.array(*names).alias("names")))
    n = F.size(F.filter("messages", lambda m: m["kind"] == "tool"))
    name = F.concat(F.lit("n"), (F.col("id") % 4).cast("string"))

    def model(rest):
        calls = F.when(n == 0, call(name, F.lit("n0"))).when(F.col("id") % 3 == 0, call(F.lit("n0"), F.concat(name, F.lit(" "))))
        return rest.withColumns({"calls": calls, "answer": F.when((n > 1) | (n > 0) & (F.col("id") % 3 != 0), F.lit("PASS: done"))})

    ran, texts = tool_loop.by_reference(rows, ["id"], rules, model, lambda text: F.size(F.split(text, "\n")).cast("string"))
    said = {r.id: [(m.text, m.lookup) for m in r.messages if m.kind == "tool"] for r in ran.collect()}
    found = {r.lookup: r.text for r in texts.collect()}
    assert len(found) == texts.count() == 4  # n0 alone and with each of the others
    assert all(len(said[k]) == 2 - (k % 3 != 0) and {t for t, _ in said[k]} == {"10" if k % 4 == 0 else "20"} for k in range(200))
    asked = ran.select("id", F.transform(F.filter("messages", lambda m: m["kind"] == "tool"), lambda m: m["lookup"]).alias("asked"))
    whole = {r.id: r.texts for r in tool_loop.with_texts(asked, texts, "asked", "texts").collect()}
    plain = {r.id: [m.text for m in r.messages if m.kind == "tool"] for r in tool_loop.with_rules(rows, ["id"], rules, model).collect()}
    assert whole == plain and len(whole) == 200 and len(whole[3]) == 2


def test_long_texts_are_neither_sorted_nor_handed_on_in_runs(spark):
    """Parquet's writer ran out of memory on rows in the order of their texts, beside a sort of rows with texts. Texts are too large to be broadcast here."""
    texts = spark.createDataFrame([(f"l{i}", f"text {i}") for i in range(20)], "lookup string, text string")
    asked = {k: [f"l{k // 100}"] + [f"l{(k // 100 + 7) % 20}"] * (k >= 1000) for k in range(2000)}
    rows = spark.createDataFrame(list(asked.items()), "id int, asked array<string>")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = tool_loop.with_texts(rows, texts, "asked", "texts")
        plan = found._jdf.queryExecution().sparkPlan().toString()
        got = found.withColumn("part", F.spark_partition_id()).collect()  # in the order in which a writer gets them
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert {r.id: r.texts for r in got} == {k: [f"text {x[1:]}" for x in v] for k, v in asked.items()} and len(got) == 2000
    assert plan.count("ShuffledHashJoin") == 3
    one = [r for r in got if len(r.texts) == 1]
    several = {p for p in {r.part for r in one} if len({r.texts[0] for r in one if r.part == p}) > 2}
    runs = [len(list(g)) for (part, _), g in groupby(one, lambda r: (r.part, r.texts)) if part in several]
    assert several and max(runs) < 50  # of 100 rows with the same texts
