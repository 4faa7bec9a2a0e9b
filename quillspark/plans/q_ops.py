"""Queries of filters, joins, aggregations, ordered, ranked and set operations, and of incremental work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import rules as U
from quillspark.functions import text as T
from quillspark.operators import incremental as I
from quillspark.operators import records as R
from quillspark.operators import retries as Y
from quillspark.operators import status as S
from quillspark.plans import views as V
from quillspark.plans.q_text import FENCED, LAST, fenced
from quillspark.plans.registry import query
from quillspark.sources.scratch import scratch_path, written
from quillspark.sources.tables import limited, with_places


def _ids(spark: SparkSession, d: str) -> DataFrame:
    return V.abstracts(spark, d).select("abstract_id", "abstract_title", "session_title")


# Filters


@query(V.sql("select abstract_id from abstracts where length(abstract_id) > 0", "abstracts"))
def f01_id_present(spark: SparkSession, d: str) -> DataFrame:
    return _ids(spark, d).where(F.length("abstract_id") > 0).select("abstract_id")


@query(V.sql("select abstract_id, abstract_title from abstracts where abstract_id <> '' and abstract_title <> ''", "abstracts"))
def f02_id_and_title(spark: SparkSession, d: str) -> DataFrame:
    return _ids(spark, d).where((F.col("abstract_id") != "") & (F.col("abstract_title") != "")).select("abstract_id", "abstract_title")


@query(V.sql("select abstract_id from abstracts where abstract_id not in (select abstract_id from validations where validation_status = 'PASS')", "abstracts", "validations"))
def f03_j04_pending(spark: SparkSession, d: str) -> DataFrame:
    done = V.validations(spark, d).withColumn("status", F.when(F.col("validation_status") == "PASS", "success").otherwise("failed"))
    return S.pending(_ids(spark, d).select("abstract_id"), done, "abstract_id")


def _two_steps(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "pending")
    return V.table(spark, d, "orders").select("o_orderkey", status.alias("extraction"), F.when(F.col("o_orderkey") % 3 == 0, "success").when(F.col("o_orderkey") % 3 == 1, "failed").alias("validation"))


_TWO = "select o_orderkey, case o_orderstatus when 'F' then 'success' when 'O' then 'pending' end as extraction, case o_orderkey % 3 when 0 then 'success' when 1 then 'failed' end as validation from orders"


@query(f"select o_orderkey from ({_TWO}) where extraction = 'success' and coalesce(validation, '') <> 'success'")
def f04_ready_for_validation(spark: SparkSession, d: str) -> DataFrame:
    steps = _two_steps(spark, d)
    return S.ready(steps.select("o_orderkey"), steps, "o_orderkey", "extraction", "validation")


@query(f"select o_orderkey from ({_TWO}) t where extraction = 'success' and (coalesce(validation, '') <> 'success' or not exists (select 1 from lineitem l where l.l_orderkey = t.o_orderkey and l.l_linenumber = 1))")
def f05_ready_or_output_missing(spark: SparkSession, d: str) -> DataFrame:
    steps = _two_steps(spark, d)
    files = V.table(spark, d, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"))
    missing = steps.where("extraction = 'success' and validation = 'success'").join(files, "o_orderkey", "left_anti").select("o_orderkey")
    return S.ready(steps.select("o_orderkey"), steps, "o_orderkey", "extraction", "validation").unionByName(missing)


@query(V.sql("select a.abstract_id from abstracts a left join validations v using (abstract_id) where v.validation_status is null or v.validation_status <> 'PASS'", "abstracts", "validations"))
def f06_missing_or_failed(spark: SparkSession, d: str) -> DataFrame:
    both = _ids(spark, d).join(V.validations(spark, d), "abstract_id", "left")
    return both.where(~F.col("validation_status").eqNullSafe("PASS")).select("abstract_id")


def _by_abstract(spark: SparkSession, d: str) -> DataFrame:
    rows = V.drugs(spark, d)
    items = R.ordered_distinct(rows, ["abstract_id"], ["pos", "drug"], "drug")
    good = rows.groupBy("abstract_id").agg(F.collect_set(F.when(F.col("status") == "success", F.col("drug"))).alias("good"))
    return items.join(good, "abstract_id")


_FIRSTS = "firsts as (select abstract_id, drug, min(struct_pack(a := pos, b := drug)) as f, bool_or(status = 'success') as good from drugs group by abstract_id, drug)"


@query(V.sql(f"+{_FIRSTS} select abstract_id, coalesce(string_agg(drug, '|' order by f) filter (not good), '') as open, bool_and(good) as complete from firsts group by abstract_id", "drugs"))
def f07_f08_open_drugs(spark: SparkSession, d: str) -> DataFrame:
    rows = _by_abstract(spark, d)
    return rows.select("abstract_id", F.array_join(S.still_open(F.col("items"), F.col("good")), "|").alias("open"), S.all_done(F.col("items"), F.col("good")).alias("complete"))


_STEPS5 = "select l_orderkey as id, " + ", ".join(f"max(case when l_linenumber = {i} then case l_linestatus when 'F' then 'success' else case when l_returnflag = 'N' then 'pending' else 'odd' end end end) as s{i}" for i in range(1, 6)) + " from lineitem group by 1"
_NEXT = "case " + " ".join(f"when s{i} in ('pending', 'running', 'failed') then 'step{i}'" for i in range(1, 6)) + " else 'complete' end"


def _five(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("l_linestatus") == "F", "success").when(F.col("l_returnflag") == "N", "pending").otherwise("odd")
    wide = V.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(*[F.max(F.when(F.col("l_linenumber") == i, status)).alias(f"s{i}") for i in range(1, 6)])
    return wide.withColumn("next_step", S.next_step({f"step{i}": F.col(f"s{i}") for i in range(1, 6)}))


@query(f"select id, {_NEXT} as next_step from ({_STEPS5})")
def f09_next_step(spark: SparkSession, d: str) -> DataFrame:
    return _five(spark, d).select("id", "next_step")


@query(f"select id from ({_STEPS5}) where {_NEXT} = 'step2'")
def f10_at_step(spark: SparkSession, d: str) -> DataFrame:
    return _five(spark, d).where("next_step = 'step2'").select("id")


@query(V.sql("select abstract_id, count(distinct coalesce(nullif(case when pos % 2 = 0 then '' else drug_class end, ''), drug)) > 1 as needs_selection from drugs group by abstract_id", "drugs"))
def f11_needs_selection(spark: SparkSession, d: str) -> DataFrame:
    normal = F.when(F.col("pos") % 2 == 0, "").otherwise(F.col("drug_class"))
    return V.drugs(spark, d).groupBy("abstract_id").agg((F.size(F.collect_set(T.first_truthy(normal, F.col("drug")))) > 1).alias("needs_selection"))


@query(
    "with i as (select l_orderkey as id, l_linenumber as pos, max(l_partkey) as p, max(l_suppkey) as s from lineitem group by all),"
    " k as (select id, n, (s + n) % 3 = 0 as kept, (p + 7 * n) % 11 <> 0 as good from i, range(1, 6) t(n)),"
    " o as (select id, n, bool_and(kept or good) as ok, count(*) filter (not kept) as computed, count(*) filter (not kept and not good) as failed from k group by all),"
    " r as (select *, coalesce(bool_and(ok) over (partition by id order by n rows between unbounded preceding and 1 preceding), true) as reached from o)"
    " select id, coalesce('step' || min(n) filter (reached and not ok), 'complete') as stopped_at, (sum(computed) filter (reached))::bigint as computed, (sum(failed) filter (reached))::bigint as failed from r group by id"
)
def c05_c06_five_steps(spark: SparkSession, d: str) -> DataFrame:
    """Lines stand for the drugs of a record. Five steps run one after the other over all records, on what no checkpoint has."""
    items = V.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("pos")).agg(F.max("l_partkey").alias("p"), F.max("l_suppkey").alias("s"))
    items = written(items, "items")
    kept = items.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(5)))).where("(s + n) % 3 = 0").select("id", "pos", F.concat(F.lit("step"), "n").alias("step"), F.lit("success").alias("status"))

    def step(n: int) -> I.Step:
        return lambda new: new.join(items, ["id", "pos"]).withColumn("status", F.when((F.col("p") + 7 * n) % 11 != 0, "success").otherwise("failed"))

    rows = I.resumable(items, kept, ["id"], "pos", {f"step{n}": step(n) for n in range(1, 6)}, written)
    return rows.groupBy("id").agg(
        F.coalesce(F.min(F.when(F.col("status") == "failed", F.col("step"))), F.lit("complete")).alias("stopped_at"),
        F.count_if("computed").alias("computed"), F.count_if(F.col("status") == "failed").alias("failed"),
    )


@query(V.sql("select abstract_id, coalesce(string_agg(distinct drug_class, ';;' order by drug_class) filter (tokens > 40), '') as classes from drugs group by abstract_id having count(*) filter (tokens > 40) = 0", "drugs"))
def f12_fallback_needed(spark: SparkSession, d: str) -> DataFrame:
    lists = V.drugs(spark, d).groupBy("abstract_id").agg(F.array_sort(F.collect_set(F.when(F.col("tokens") > 40, F.col("drug_class")))).alias("classes"))
    return lists.where((F.size("classes") == 0) | (F.col("classes") == F.array(F.lit("NA")))).select("abstract_id", T.listed(F.col("classes")).alias("classes"))


@query(V.sql("select abstract_id, count(*) filter (class_type = 'MoA' and drug_class <> 'NA') > 0 and count(*) filter (status = 'success') > 0 as consolidate from drugs group by abstract_id", "drugs"))
def f13_consolidation_needed(spark: SparkSession, d: str) -> DataFrame:
    explicit, chosen = (F.col("class_type") == "MoA") & (F.col("drug_class") != "NA"), F.col("status") == "success"
    return V.drugs(spark, d).groupBy("abstract_id").agg(((F.count_if(explicit) > 0) & (F.count_if(chosen) > 0)).alias("consolidate"))


@query("select p_partkey, p_type, p_brand from part where p_type = 'SMALL' and p_brand in ('Brand#11', 'Brand#13')")
def f14_j09_rule_match(spark: SparkSession, d: str) -> DataFrame:
    asked = spark.createDataFrame([(" SMALL ", [" Brand#11", "Brand#13 "])], "category string, subcategories array<string>")
    rules = asked.select(T.strip(F.col("category")).alias("p_type"), F.explode(F.transform("subcategories", T.strip)).alias("p_brand"))
    return V.table(spark, d, "part").join(F.broadcast(rules), ["p_type", "p_brand"], "left_semi").select("p_partkey", "p_type", "p_brand")  # the rules that a call names


@query("select n_nationkey, case when n_nationkey % 2 = 0 then 'bogus' else '' end as invalid, n_nationkey % 3 = 0 as runs_drug from nation")
def f15_u02_pipeline_names(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    asked = F.concat(F.when(k % 2 == 0, F.array(F.lit("bogus"))).otherwise(F.array().cast("array<string>")), F.when(k % 3 == 0, F.array(F.lit("drug"))).otherwise(F.array(F.lit("indication"))))
    known = F.array(*[F.lit(x) for x in ("drug", "drug_class", "indication")])
    return V.table(spark, d, "nation").select("n_nationkey", F.array_join(F.array_except(asked, known), ",").alias("invalid"), F.array_contains(asked, "drug").alias("runs_drug"))


@query(f"select o_orderkey, coalesce(extraction, '') <> 'success' as run_extraction, coalesce(extraction = 'success', false) and coalesce(validation, '') <> 'success' as run_validation from ({_TWO})")
def f16_should_run(spark: SparkSession, d: str) -> DataFrame:
    tree = _two_steps(spark, d).select("o_orderkey", F.struct(F.struct(F.col("extraction").alias("status")).alias("extraction"), F.struct(F.col("validation").alias("status")).alias("validation")).alias("drug"))
    done = lambda step: F.col(f"drug.{step}.status").eqNullSafe("success")
    return tree.select("o_orderkey", (~done("extraction")).alias("run_extraction"), (done("extraction") & ~done("validation")).alias("run_validation"))


@query(V.sql("select abstract_id, drug, count(*) as n from drugs where class_type = 'Therapeutic' group by abstract_id, drug", "drugs"))
def f17_requires_validation(spark: SparkSession, d: str) -> DataFrame:
    return V.drugs(spark, d).withColumn("method", F.when(F.col("class_type") == "Therapeutic", "grounded").otherwise("search")).where("method = 'grounded'").groupBy("abstract_id", "drug").agg(F.count("*").alias("n"))


@query("select l_orderkey, l_linenumber, l_partkey, l_discount * 12 <= 1 and l_discount >= 0 and l_returnflag in ('A', 'R') as accepted from lineitem")
def f18_constraints(spark: SparkSession, d: str) -> DataFrame:
    confidence = F.col("l_discount") * 12
    return V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", U.accepted(confidence, F.col("l_returnflag"), ("A", "R")).alias("accepted"))


@query("""select p_partkey, p_retailprice >= 0 and p_retailprice / 500 <= 2 and p_size * 4000 between 1 and 100000 and p_brand <> 'Brand#3' as allowed,
  concat_ws(',', case when p_retailprice / 500 > 2 then 'temperature' end, case when p_size * 4000 > 100000 then 'max_tokens' end, case when p_brand = 'Brand#3' then 'provider' end) as wrong from part""")
def f18_model_limits(spark: SparkSession, d: str) -> DataFrame:
    """A model's settings that are allowed, and the others with what is wrong."""
    rows = V.table(spark, d, "part")
    ok, wrong = U.within_limits(F.col("p_retailprice") / 500, F.col("p_size") * 4000, F.when(F.col("p_brand") != "Brand#3", "openai").otherwise(F.col("p_brand")))
    checked = rows.select("p_partkey", ok.alias("allowed"), F.array_join(wrong, ",").alias("wrong"))
    kept, others = U.quarantined(checked, F.col("allowed"))
    return kept.unionByName(others)


# Joins


@query(V.sql("""select a.abstract_id, a.session_title, coalesce(v.validation_status, '') as validation_status, coalesce(m.last_text, '') as last_text
  from abstracts a left join validations v using (abstract_id) left join (select cast(conv_id as varchar) as abstract_id, arg_max(text, turn) as last_text from messages group by 1) m using (abstract_id)""", "abstracts", "validations", "messages"))
def j01_left_documents(spark: SparkSession, d: str) -> DataFrame:
    m = V.messages(spark, d).groupBy(F.col("conv_id").cast("string").alias("abstract_id")).agg(F.max_by("text", "turn").alias("last_text"))
    rows = _ids(spark, d).join(V.validations(spark, d), "abstract_id", "left").join(m, "abstract_id", "left")
    return rows.select("abstract_id", "session_title", T.or_empty(F.col("validation_status")).alias("validation_status"), T.or_empty(F.col("last_text")).alias("last_text"))


@query(V.sql("select 'used' as part, count(*) as n from abstracts join validations using (abstract_id) union all select 'skipped', count(*) from abstracts where abstract_id not in (select abstract_id from validations)", "abstracts", "validations"))
def j02_inner_and_skipped(spark: SparkSession, d: str) -> DataFrame:
    a, v = _ids(spark, d), V.validations(spark, d)
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
    return count(a.join(v, "abstract_id"), "used").unionByName(count(a.join(v, "abstract_id", "left_anti"), "skipped"))


@query(V.sql("select abstract_id from abstracts where abstract_id in (select abstract_id from validations)", "abstracts", "validations"))
def j03_exists(spark: SparkSession, d: str) -> DataFrame:
    return _ids(spark, d).select("abstract_id").join(V.validations(spark, d), "abstract_id", "left_semi")


@query(V.sql("select d.abstract_id, d.drug, coalesce(string_agg(distinct s.drug_class, ';;' order by s.drug_class), 'NA') as classes from (select distinct abstract_id, drug from drugs) d left join drugs s on s.abstract_id = d.abstract_id and s.drug = d.drug and s.status = 'success' group by all", "drugs"))
def j05_p18_selection_or_na(spark: SparkSession, d: str) -> DataFrame:
    rows = V.drugs(spark, d)
    chosen = rows.where("status = 'success'").groupBy("abstract_id", "drug").agg(F.array_sort(F.collect_set("drug_class")).alias("classes"))
    both = rows.select("abstract_id", "drug").distinct().join(chosen, ["abstract_id", "drug"], "left")
    return both.select("abstract_id", "drug", T.listed(F.coalesce("classes", F.array(F.lit("NA")))).alias("classes"))


@query("select a.p_partkey, b.n from part a join (select translate(p_name, '/\\: ', '____') as k, count(*) as n from part group by 1) b on b.k = translate(a.p_name, '/\\: ', '____')")
def j06_sanitised_key(spark: SparkSession, d: str) -> DataFrame:
    part = V.table(spark, d, "part").withColumn("k", F.translate(T.file_name(F.col("p_name")), " ", "_"))
    return part.join(part.groupBy("k").agg(F.count("*").alias("n")), "k").select("p_partkey", "n")


@query(f"select p.p_partkey, c.n from part p join (select translate(lower(p_name), ' /-', '___') as k, count(*) as n from part where p_size > 25 group by 1) c on c.k = translate({'lower(p.p_name)'}, ' /-', '___')")
def j07_cache_key(spark: SparkSession, d: str) -> DataFrame:
    part = V.table(spark, d, "part").withColumn("k", T.cache_key(F.col("p_name")))
    return part.join(part.where("p_size > 25").groupBy("k").agg(F.count("*").alias("n")), "k").select("p_partkey", "n")


@query("select l_orderkey, l_linenumber, l_partkey, s_name as cached from lineitem left join supplier on s_suppkey = l_suppkey and s_nationkey = l_linenumber")
def j08_composite_cache(spark: SparkSession, d: str) -> DataFrame:
    cache = V.table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("l_linenumber"), F.col("s_name").alias("cached"))
    return V.table(spark, d, "lineitem").join(cache, ["l_suppkey", "l_linenumber"], "left").select("l_orderkey", "l_linenumber", "l_partkey", "cached")


@query("select count(*) as total, round(count(*) / 8.0 + 12.5, 2) as duration_seconds, '2020-01-01T00:00:00Z' as started_at from orders")
def j10_a13_batch_update(spark: SparkSession, d: str) -> DataFrame:
    now = V.table(spark, d, "orders").agg(F.count("*").alias("total"), (F.count("*") / F.lit(8.0)).alias("duration_seconds"), F.lit("2024-01-01T00:00:00Z").alias("started_at"))
    return S.batch_update(now, spark.createDataFrame([(12.5, "2020-01-01T00:00:00Z")], "duration_seconds double, started_at string"))


@query("select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey")
def j11_zip(spark: SparkSession, d: str) -> DataFrame:
    n = V.table(spark, d, "nation").join(V.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = n.agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name", "r_name"))).alias("r"))  # 25 rows
    zipped = rows.select(F.explode(F.arrays_zip(F.col("r.n_nationkey").alias("k"), F.col("r.n_name").alias("n"), F.col("r.r_name").alias("g"))).alias("z"))
    return zipped.select(F.col("z.k").alias("n_nationkey"), F.col("z.n").alias("n_name"), F.col("z.g").alias("r_name"))


# Aggregations


@query(f"select count(*) filter (validation = 'success') as success, count(*) filter (validation = 'failed') as failed, count(*) filter (validation is null) as not_processed, sum(case when validation = 'failed' then o_orderkey end)::bigint as failed_ids from ({_TWO})")
def a01_batch_counts(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("validation")
    return _two_steps(spark, d).agg(F.count_if(v == "success").alias("success"), F.count_if(v == "failed").alias("failed"), F.count_if(v.isNull()).alias("not_processed"), F.sum(F.when(v == "failed", F.col("o_orderkey"))).alias("failed_ids"))


@query(V.sql("select count(*) filter (validation_status = 'PASS') as success, count(*) filter (validation_status is not null and validation_status <> 'PASS') as failed, count(*) filter (validation_status is null) as not_processed from abstracts left join validations using (abstract_id)", "abstracts", "validations"))
def a02_census(spark: SparkSession, d: str) -> DataFrame:
    status = V.validations(spark, d).select("abstract_id", F.when(F.col("validation_status") == "PASS", "success").otherwise(F.col("validation_status")).alias("status"))
    return S.census(_ids(spark, d), status, "abstract_id")


_VALID = "select abstract_id, case severity when 'low' then 'PASS' when 'medium' then 'REVIEW' when 'high' then case when pos = 1 then 'ERR' else 'FAIL' end end as s from drugs"


def _checks(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("severity") == "low", "PASS").when(F.col("severity") == "medium", "REVIEW").when(F.col("pos") == 1, "ERR").otherwise("FAIL")
    return V.drugs(spark, d).select("abstract_id", status.alias("validation_status"))


_TALLY = "count(*) filter (s = 'PASS') as pass, count(*) filter (s = 'REVIEW') as review, count(*) filter (s = 'FAIL') as fail, count(*) filter (s = 'ERR') as error, bool_and(s <> 'ERR') as all_success"


@query(V.sql(f"select abstract_id, {_TALLY} from ({_VALID}) group by abstract_id", "drugs"))
def a03_validation_tally(spark: SparkSession, d: str) -> DataFrame:
    return S.tally(_checks(spark, d), ["abstract_id"])


@query(V.sql(f"select {_TALLY} from ({_VALID})", "drugs"))
def a04_grand_totals(spark: SparkSession, d: str) -> DataFrame:
    return S.tally(_checks(spark, d), [])


@query(V.sql("select abstract_id, count(*) filter (status = 'success') as llm_calls, coalesce(sum(tokens) filter (status = 'success'), 0)::bigint as tokens from drugs group by abstract_id", "drugs"))
def a05_metrics_rollup(spark: SparkSession, d: str) -> DataFrame:
    return S.totals(V.drugs(spark, d), ["abstract_id"])


@query(V.sql("select abstract_id, pos, sum(tokens)::bigint as tokens from drugs group by abstract_id, pos", "drugs"))
def a06_step_tokens(spark: SparkSession, d: str) -> DataFrame:
    return V.drugs(spark, d).groupBy("abstract_id", "pos").agg(F.sum("tokens").alias("tokens"))


@query("select user_id, sum(coalesce(cast(case when event_id % 2 = 0 then json_extract_string(props, '$.k') end as bigint), event_id % 7, 0))::bigint as tokens from events group by user_id")
def a07_token_fallback(spark: SparkSession, d: str) -> DataFrame:
    named = F.when(F.col("event_id") % 2 == 0, F.get_json_object("props", "$.k").cast("long"))
    return V.table(spark, d, "events").groupBy("user_id").agg(F.sum(F.coalesce(named, F.col("event_id") % 7, F.lit(0))).alias("tokens"))


@query(V.sql(f"+{_FIRSTS} select abstract_id, string_agg(drug, '|' order by f) as components from firsts group by abstract_id", "drugs"))
def a08_ordered_distinct(spark: SparkSession, d: str) -> DataFrame:
    return R.ordered_distinct(V.drugs(spark, d), ["abstract_id"], ["pos", "drug"], "drug").select("abstract_id", F.array_join("items", "|").alias("components"))


@query(V.sql("select abstract_id, drug, min(pos) as first_pos, arg_max(drug_class, struct_pack(a := pos, b := drug_class)) as drug_class from drugs group by abstract_id, drug", "drugs"))
def a09_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return R.last_wins(V.drugs(spark, d), ["abstract_id", "drug"], ["pos"], ["drug_class"])


@query(V.sql("select abstract_id, coalesce(string_agg(distinct c, ';;' order by c), '') as combined from (select abstract_id, case when status = 'success' then drug_class when severity = 'high' then 'NA' else class_type end as c from drugs) where c <> 'NA' or c is null group by abstract_id union all select abstract_id, '' from drugs group by abstract_id having bool_and(status <> 'success' and severity = 'high')", "drugs"))
def a10_u01_combined_classes(spark: SparkSession, d: str) -> DataFrame:
    success = F.col("status") == "success"
    rows = V.drugs(spark, d).groupBy("abstract_id").agg(
        F.collect_set(F.when(success, F.concat(F.lit(""), "drug_class"))).alias("selected"),
        F.collect_set(F.when(~success & (F.col("severity") == "high"), "NA").when(~success, F.col("class_type"))).alias("refined"),
    )
    return rows.select("abstract_id", R.combined([F.col("selected"), F.col("refined")]).alias("combined"))


@query(V.sql("select count(*) as total, count(*) filter (abstract_title <> '') as with_title, count(*) filter (coalesce(validation_status, '') <> '') as with_validation from abstracts left join validations using (abstract_id)", "abstracts", "validations"))
def a11_availability(spark: SparkSession, d: str) -> DataFrame:
    rows = _ids(spark, d).join(V.validations(spark, d), "abstract_id", "left")
    return rows.agg(F.count("*").alias("total"), F.count_if(F.col("abstract_title") != "").alias("with_title"), F.count_if(T.or_empty(F.col("validation_status")) != "").alias("with_validation"))


@query(V.sql("select count(*) as total, count(*) filter (b <> '') as with_firms, count(*) filter (raw <> c) as changed, count(*) filter (contains(c, ';;')) as multi from (select raw, regexp_replace(raw, '^[ ]+|[ ]+$', '', 'g') as b, regexp_replace(regexp_replace(regexp_replace(raw, '^[ ]+|[ ]+$', '', 'g'), '^<[0-9]+>', ''), '^[ ]+|[ ]+$', '', 'g') as c from firms)", "firms"))
def a12_k12_cleaning(spark: SparkSession, d: str) -> DataFrame:
    rows = V.firms(spark, d).withColumn("clean", T.without_rank(F.col("raw")))
    return rows.agg(F.count("*").alias("total"), F.count_if(T.strip(F.col("raw")) != "").alias("with_firms"), F.count_if(F.col("raw") != F.col("clean")).alias("changed"), F.count_if(F.col("clean").contains(";;")).alias("multi"))


@query(V.sql("select outcome, count(*) as n from (select case when n_failed = n then 'failed' when n_failed > 0 then 'partial' else 'success' end as outcome from (select abstract_id, count(*) as n, count(*) filter (status = 'failed') as n_failed from attempts group by 1)) group by 1", "attempts"))
def a14_outcomes(spark: SparkSession, d: str) -> DataFrame:
    by = V.attempts(spark, d).groupBy("abstract_id").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "failed").alias("bad"))
    return by.groupBy(F.when(F.col("bad") == F.col("n"), "failed").when(F.col("bad") > 0, "partial").otherwise("success").alias("outcome")).agg(F.count("*").alias("n"))


@query(V.sql("select abstract_id, string_agg(pos || '=' || drug || '=' || drug_class, '|' order by pos, drug, drug_class) as entries from drugs group by abstract_id", "drugs"))
def a15_nest(spark: SparkSession, d: str) -> DataFrame:
    rows = R.nested(V.drugs(spark, d), ["abstract_id"], ["pos", "drug", "drug_class"], ["pos", "drug", "drug_class"])
    return rows.select("abstract_id", F.array_join(F.transform("entries", lambda e: F.concat_ws("=", e["pos"].cast("string"), e["drug"], e["drug_class"])), "|").alias("entries"))


@query(V.sql("select abstract_id, count(distinct drug) filter (status = 'success') as succeeded, count(*) filter (status <> 'success') as failed from drugs group by abstract_id", "drugs"))
def a16_drug_counts(spark: SparkSession, d: str) -> DataFrame:
    ok = F.col("status") == "success"
    rows = V.drugs(spark, d).groupBy("abstract_id").agg(F.collect_set(F.when(ok, F.col("drug"))).alias("s"), F.count_if(~ok).alias("failed"))
    return rows.select("abstract_id", F.size("s").cast("long").alias("succeeded"), "failed")


# Ordered and ranked operations


@query(f"with {FENCED} select conv_id, arg_max(b, turn) as answer from (select conv_id, turn, {LAST} as b from fenced where role = 'assistant') where json_valid(b) group by conv_id")
def w01_last_valid_answer(spark: SparkSession, d: str) -> DataFrame:
    rows = fenced(spark, d).where("role = 'assistant'").withColumn("b", T.last_json(F.col("text")))
    return rows.where(T.is_json(F.col("b"))).groupBy("conv_id").agg(F.max_by("b", "turn").alias("answer"))


@query(V.sql("select conv_id, arg_max(text, turn) as last_text from messages group by conv_id", "messages"))
def w02_last_message(spark: SparkSession, d: str) -> DataFrame:
    return V.messages(spark, d).groupBy("conv_id").agg(F.max_by("text", "turn").alias("last_text"))


@query(V.sql("select abstract_id, arg_min(drug_class, struct_pack(a := pos, b := drug, c := drug_class)) as drug_class from drugs group by abstract_id", "drugs"))
def w03_first_detail(spark: SparkSession, d: str) -> DataFrame:
    rows = R.nested(V.drugs(spark, d), ["abstract_id"], ["pos", "drug", "drug_class"], ["drug_class"])
    return rows.select("abstract_id", F.get("entries", F.lit(0))["drug_class"].alias("drug_class"))


@query("select p_partkey, row_number() over (partition by p_partkey // 50 order by p_partkey) as number from part")
def w04_enumerate(spark: SparkSession, d: str) -> DataFrame:
    return R.numbered_rows(V.table(spark, d, "part").withColumn("page", F.expr("p_partkey div 50")), ["p_partkey"], "number", ["page"]).select("p_partkey", F.col("number").cast("long").alias("number"))


@query(V.sql("select abstract_id, step, status, attempt_id from attempts qualify row_number() over (partition by abstract_id, step order by ts desc, attempt_id desc) = 1", "attempts"))
def w05_c03_latest_state(spark: SparkSession, d: str) -> DataFrame:
    return R.latest(V.attempts(spark, d), ["abstract_id", "step"], ["ts", "attempt_id"]).select("abstract_id", "step", "status", "attempt_id")


@query(V.sql("select attempt_id, sum((status = 'failed')::int) over (partition by abstract_id order by ts, attempt_id rows unbounded preceding)::bigint as attempt from attempts", "attempts"))
def w06_attempt_counter(spark: SparkSession, d: str) -> DataFrame:
    return R.running_failures(V.attempts(spark, d), ["abstract_id"], ["ts", "attempt_id"], F.col("status") == "failed").select("attempt_id", "attempt")


@query("select o_orderkey from (select * from orders order by o_orderkey limit 100) where o_orderstatus = 'F'")
def o01_limit_then_filter(spark: SparkSession, d: str) -> DataFrame:
    return V.table(spark, d, "orders").orderBy("o_orderkey").limit(100).where("o_orderstatus = 'F'").select("o_orderkey")


@query("select o_orderkey from orders where o_orderstatus = 'F' order by o_orderkey limit 100")
def o02_filter_then_limit(spark: SparkSession, d: str) -> DataFrame:
    return V.table(spark, d, "orders").where("o_orderstatus = 'F'").orderBy("o_orderkey").limit(100).select("o_orderkey")


@query("select n_nationkey from nation")
def o03_limit_zero_is_all(spark: SparkSession, d: str) -> DataFrame:
    return limited(V.table(spark, d, "nation").select("n_nationkey"), 0, ["n_nationkey"])


@query(V.sql("select abstract_id, row_number() over (order by abstract_id) as place from (select distinct abstract_id from attempts)", "attempts"))
def o04_o05_string_order(spark: SparkSession, d: str) -> DataFrame:
    ids = V.attempts(spark, d).select("abstract_id").distinct()
    return with_places(ids, ["abstract_id"], "place")


@query(V.sql("select page_id, site from (select page_id, page_id % 40 as site, row_number() over (partition by page_id % 40 order by length(raw_content) desc, page_id) as k from search_results) where k <= 3", "search_results"))
def o07_top_k(spark: SparkSession, d: str) -> DataFrame:
    rows = V.search_results(spark, d).withColumn("site", F.col("page_id") % 40)
    return R.top_k(rows, ["site"], [F.length("raw_content").desc(), F.col("page_id")], 3).select("page_id", "site")


@query("select p_type, case when count(*) > 5 then array_to_string(list_slice(list(p_partkey order by p_partkey), 1, 5), ', ') || '...' else string_agg(p_partkey, ', ' order by p_partkey) end as preview from part group by p_type")
def o08_preview(spark: SparkSession, d: str) -> DataFrame:
    first = R.top_k(V.table(spark, d, "part"), ["p_type"], [F.col("p_partkey")], 6).groupBy("p_type").agg(F.array_sort(F.collect_list("p_partkey")).alias("ids"))
    text = F.array_join(F.slice("ids", 1, 5).cast("array<string>"), ", ")
    return first.select("p_type", F.when(F.size("ids") > 5, F.concat(text, F.lit("..."))).otherwise(text).alias("preview"))


@query(V.sql(r"select abstract_id, drug_class from (select distinct abstract_id, drug_class from drugs where class_type = 'MoA') e where not exists (select 1 from drugs s where s.abstract_id = e.abstract_id and s.class_type = 'Chemical' and lower(regexp_replace(s.drug_class, '[-\s]', '', 'g')) = lower(regexp_replace(e.drug_class, '[-\s]', '', 'g')))", "drugs"))
def u03_explicit_minus_selected(spark: SparkSession, d: str) -> DataFrame:
    rows = V.drugs(spark, d).withColumn("k", T.equivalence_key(F.col("drug_class")))
    return rows.where("class_type = 'MoA'").join(rows.where("class_type = 'Chemical'").select("abstract_id", "k"), ["abstract_id", "k"], "left_anti").select("abstract_id", "drug_class").distinct()


@query(V.sql("select distinct drug, drug_class from drugs", "drugs"))
def u04_distinct_classes(spark: SparkSession, d: str) -> DataFrame:
    return V.drugs(spark, d).select("drug", "drug_class").distinct()


@query(V.sql("select site, string_agg(distinct url, ',' order by url) as urls from (select page_id // 5 as site, url from search_results) group by site", "search_results"))
def u05_source_urls(spark: SparkSession, d: str) -> DataFrame:
    return V.search_results(spark, d).groupBy(F.expr("page_id div 5").alias("site")).agg(F.array_join(F.array_sort(F.collect_set("url")), ",").alias("urls"))


@query(V.sql("select conv_id, turn, role from messages union all select conv_id, 1000 + turn, role from messages where role = 'user'", "messages"))
def u06_append_messages(spark: SparkSession, d: str) -> DataFrame:
    m = V.messages(spark, d).select("conv_id", "turn", "role")
    return m.unionByName(m.where("role = 'user'").withColumn("turn", 1000 + F.col("turn")))


# Incremental work and control


@query("select o_orderkey, case when o_orderkey % 4 = 0 then 'cached' else 'computed' end as origin from orders")
def c01_memoised_step(spark: SparkSession, d: str) -> DataFrame:
    keys = V.table(spark, d, "orders").select("o_orderkey")
    done = keys.where("o_orderkey % 4 = 0").withColumn("origin", F.lit("cached"))
    return I.memoised(keys, done, ["o_orderkey"], lambda new: new.withColumn("origin", F.lit("computed")))[0]


@query("select p_name, case when max(p_size) > 48 then 'hit' else 'fetched' end as origin from part group by p_name")
def c02_cache_through(spark: SparkSession, d: str) -> DataFrame:
    part = V.table(spark, d, "part")
    cache = part.groupBy("p_name").agg(F.collect_list(F.when(F.col("p_size") > 48, "hit")).alias("results"))
    rows, _ = I.cached_lookup(part, cache, ["p_name"], "results", lambda new: new.withColumn("results", F.array(F.lit("fetched"))))
    return rows.select("p_name", F.get("results", F.lit(0)).alias("origin"))


@query("""select o_orderkey, case o_orderstatus when 'F' then 'success' when 'O' then 'running' else 'failed' end as status, case when o_orderstatus = 'O' then 'now' when o_orderkey % 2 = 0 then 't0' end as started_at,
  case when o_orderstatus = 'F' then 'now' end as completed_at, case when o_orderstatus = 'P' then 'now' when o_orderkey % 2 = 0 then 't1' end as failed_at, case when o_orderstatus = 'P' then 'late' when o_orderstatus = 'O' and o_orderkey % 2 = 0 then 'old' end as error,
  (case when o_orderkey % 2 = 0 then 1 else 0 end + case when o_orderstatus = 'P' then 1 else 0 end)::bigint as attempts, case when o_orderkey % 2 = 0 then 'running' else 'pending' end as resumed, 0::bigint as n_errors from orders""")
def c04_c08_status_transition(spark: SparkSession, d: str) -> DataFrame:
    """Half of the records have a failed run behind them."""
    rows = V.table(spark, d, "orders")
    before = F.when(F.col("o_orderkey") % 2 == 0, F.from_json(F.lit('{"status":"failed","llm_calls":1,"started_at":"t0","failed_at":"t1","error":"old","attempts":1}'), "status string, llm_calls int, started_at string, completed_at string, failed_at string, error string, attempts int"))
    outcome = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "running").otherwise("failed")
    after = rows.select("o_orderkey", before.alias("before"), outcome.alias("outcome")).select("o_orderkey", "before", I.transition(F.col("before"), F.col("outcome"), F.lit("now"), F.lit(1), F.lit("late")).alias("a"))
    status, errors = I.resumed(F.col("before.status"))
    return after.select("o_orderkey", "a.status", "a.started_at", "a.completed_at", "a.failed_at", "a.error", F.col("a.attempts").cast("long").alias("attempts"), status.alias("resumed"), F.size(errors).cast("long").alias("n_errors"))


@query(V.sql("select abstract_id, coalesce(string_agg(distinct drug_class, ';;' order by drug_class) filter (tokens > 40), 'Grounded') as classes from drugs group by abstract_id", "drugs"))
def c07_fallback_chain(spark: SparkSession, d: str) -> DataFrame:
    lists = V.drugs(spark, d).groupBy("abstract_id").agg(F.array_sort(F.collect_set(F.when(F.col("tokens") > 40, F.col("drug_class")))).alias("classes"))
    return I.fallback(lists, "classes", lambda rows: rows.withColumn("classes", F.array(F.lit("Grounded")))).select("abstract_id", T.listed(F.col("classes")).alias("classes"))


@query(V.sql("select attempt_id, k as attempt, least(pow(2.0, k - 1), 30.0) as seconds from (select attempt_id, row_number() over (partition by abstract_id, step order by ts, attempt_id) as k from attempts where status = 'failed')", "attempts"))
def c10_backoff(spark: SparkSession, d: str) -> DataFrame:
    """How long to wait after each failure of a step."""
    failed = V.attempts(spark, d).where("status = 'failed'")
    numbered = R.numbered_rows(failed, ["ts", "attempt_id"], "attempt", ["abstract_id", "step"])
    return numbered.select("attempt_id", F.col("attempt").cast("long").alias("attempt"), I.backoff(F.col("attempt"), 1.0, 2.0, 30.0).alias("seconds"))


_WAITS = "case p_size % 4 when 0 then [1, 2] when 1 then [5, 10] when 2 then [15] else [2, 4] end"
_TRIES = f"select p_partkey, ['storage', 'fast_llm', 'slow_llm', 'search'][p_size % 4 + 1] as kind, p_partkey % 5 as fails, p_partkey % 7 = 0 as fatal, {_WAITS} as waits from part"


@query(f"""with t as ({_TRIES}), n as (select *, case when fatal and fails > 0 then 1 else least(fails, len(waits)) + 1 end as attempts from t)
  select p_partkey, kind, attempts, case when fails = 0 then 'done' when fatal or fails > len(waits) then 'gave_up' else 'done' end as state, case when fails = 0 or (not fatal and fails <= len(waits)) then '' when fatal then 'ValueError' else 'TimeoutError' end as error,
  cast(coalesce(list_sum(waits[1:attempts - 1]), 0) as double) as waited from n""")
def c10_retry_queue(spark: SparkSession, d: str) -> DataFrame:
    """Work of four kinds, of which some fail again and again: attempts, final states and time waited by the kinds' policies. The clock jumps."""
    kind = F.element_at(F.array(*[F.lit(k) for k in ("storage", "fast_llm", "slow_llm", "search")]), (F.col("p_size") % 4 + 1).cast("int"))
    items = V.table(spark, d, "part").select("p_partkey", kind.alias("kind"), (F.col("p_partkey") % 5).alias("fails"))
    path = scratch_path(spark, "attempts")

    def step(due: DataFrame) -> DataFrame:
        """Fails as often as the row says: what the log has is what was tried before."""
        log = Y.attempts(spark, path)
        tried = due.withColumn("n", F.lit(0)) if log is None else due.join(log.groupBy("p_partkey").agg(F.count("*").alias("n")), "p_partkey", "left")
        failing = F.coalesce("n", F.lit(0)) < F.col("fails")
        return tried.withColumn("error", F.when(failing, F.when(F.col("p_partkey") % 7 == 0, "ValueError").otherwise("TimeoutError")))

    found = Y.retried(items, ["p_partkey"], "kind", step, path, clock=Y.Jumping())
    return found.select("p_partkey", "kind", F.col("attempts").cast("long").alias("attempts"), "state", T.or_empty(F.col("error")).alias("error"), F.col("at").alias("waited"))


@query(V.sql("select abstract_id, count(*) as idle_periods from (select abstract_id, ts, lag(ts) over (partition by abstract_id order by ts) as p from attempts) where p is not null and ts - p >= interval 6 hour group by abstract_id", "attempts"))
def c12_idle_periods(spark: SparkSession, d: str) -> DataFrame:
    rows = V.attempts(spark, d).groupBy("abstract_id", F.session_window(F.col("ts").cast("timestamp"), "6 hours")).agg(F.count("*").alias("n"))
    return rows.groupBy("abstract_id").agg((F.count("*") - 1).alias("idle_periods")).where("idle_periods > 0")
