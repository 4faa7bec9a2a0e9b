"""Queries of the text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.plans import views as V
from quillspark.plans.registry import query

_STRIP = r"regexp_replace({}, '^[ \t\n\x0B\f\r ]+|[ \t\n\x0B\f\r ]+$', '', 'g')"
strip = _STRIP.format


def _ordered(d: DataFrame, value) -> DataFrame:
    """Per abstract, the list of values in order of position, then drug."""
    items = F.array_sort(F.collect_list(F.struct("pos", "drug", value.alias("v"))))
    return d.groupBy("abstract_id").agg(F.transform(items, lambda x: x["v"]).alias("items"))


@query(V.sql(f"select abstract_id, coalesce(string_agg({strip('v')}, ';;' order by pos, drug) filter (v <> ''), '') as drugs from (select *, case pos % 3 when 0 then '' when 1 then '  ' || drug else drug end as v from drugs) group by abstract_id", "drugs"))
def x01_list_semicolon(spark: SparkSession, d: str) -> DataFrame:
    noisy = F.when(F.col("pos") % 3 == 0, "").when(F.col("pos") % 3 == 1, F.concat(F.lit("  "), "drug")).otherwise(F.col("drug"))
    return _ordered(V.drugs(spark, d), noisy).select("abstract_id", T.listed(F.col("items")).alias("drugs"))


def _entries(spark: SparkSession, d: str) -> DataFrame:
    """Per abstract, drugs in order of first position with their classes of tokens over 10."""
    by_drug = V.drugs(spark, d).groupBy("abstract_id", "drug").agg(F.min("pos").alias("first"), F.array_sort(F.collect_set(F.when(F.col("tokens") > 25, F.col("drug_class")))).alias("items"))
    return by_drug.groupBy("abstract_id").agg(F.array_sort(F.collect_list(F.struct("first", F.col("drug").alias("key"), "items"))).alias("entries"))


_ENTRIES = "select abstract_id, drug, min(pos) as first, coalesce(string_agg(distinct drug_class, ';;' order by drug_class) filter (tokens > 25), '') as items from drugs group by abstract_id, drug"


@query(V.sql(f"""select abstract_id, string_agg('"' || drug || '": ' || items, chr(10) order by first, drug) as lines from ({_ENTRIES}) group by abstract_id""", "drugs"))
def x02_map_lines(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d).select("abstract_id", T.keyed_lines(F.col("entries")).alias("lines"))


@query(V.sql(f"""select abstract_id, coalesce(string_agg('"' || drug || '": ' || items, chr(10) order by first, drug) filter (items <> ''), '') as lines from ({_ENTRIES}) group by abstract_id""", "drugs"))
def x03_map_lines_skip_empty(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d).select("abstract_id", T.keyed_lines(F.col("entries"), skip_empty=True).alias("lines"))


@query(V.sql("""select abstract_id, pos, drug, tokens, '{' || chr(10) || '  "drug": "' || drug || '",' || chr(10) || '  "tokens": ' || tokens || ',' || chr(10) || '  "classes": [' || chr(10) || '    "é ' || drug_class || '"' || chr(10) || '  ]' || chr(10) || '}' as document from drugs""", "drugs"))
def x04_json_text(spark: SparkSession, d: str) -> DataFrame:
    return V.drugs(spark, d).select("abstract_id", "pos", "drug", "tokens", T.pretty_json(F.struct("drug", "tokens", F.array(F.concat(F.lit("é "), "drug_class")).alias("classes")), "struct<drug:string,tokens:long,classes:array<string>>").alias("document"))


_SPLIT = f"""case when starts_with(b, '[') and json_valid(b) then json_extract_string(b, '$[*]') when contains(b, ';;') then string_split(b, ';;') when contains(b, ',') then string_split(b, ',') else [b] end"""


@query(V.sql(f"""select firm_id, coalesce(array_to_string(list_filter(list_transform({_SPLIT}, lambda x: {strip('x')}), lambda x: x <> ''), '|'), '') as firms from (select *, {strip('raw')} as b from firms)""", "firms"))
def x05_parse_list(spark: SparkSession, d: str) -> DataFrame:
    return V.firms(spark, d).select("firm_id", F.array_join(T.parsed_list(F.col("raw")), "|").alias("firms"))


@query(V.sql(f"select firm_id, coalesce(array_to_string(list_filter(list_transform(string_split(raw, ','), lambda x: {strip('x')}), lambda x: x <> ''), '|'), '') as firms from firms", "firms"))
def x06_comma_list(spark: SparkSession, d: str) -> DataFrame:
    return V.firms(spark, d).select("firm_id", F.array_join(T.comma_list(F.col("raw")), "|").alias("firms"))


@query(V.sql(f"select firm_id, {strip(f'''regexp_replace({strip('raw')}, '^<[0-9]+>', '')''')} as firm from firms", "firms"))
def x07_clean_firm(spark: SparkSession, d: str) -> DataFrame:
    return V.firms(spark, d).select("firm_id", T.without_rank(F.col("raw")).alias("firm"))


@query(f"select p_partkey, translate({strip('lower(p_name)')}, ' /-', '___') as cache_key from part")
def x08_cache_key(spark: SparkSession, d: str) -> DataFrame:
    return V.table(spark, d, "part").select("p_partkey", T.cache_key(F.col("p_name")).alias("cache_key"))


@query(V.sql(f"select attempt_id, 'abstracts/' || abstract_id || '/' || step || '.json' as step_path, 'search_cache/' || translate({strip('lower(step)')}, ' /-', '___') || '.json' as cache_path, 'entity-extraction-' || abstract_id as workflow_id from attempts", "attempts"))
def x09_paths(spark: SparkSession, d: str) -> DataFrame:
    record, step = F.col("abstract_id"), F.col("step")
    return V.attempts(spark, d).select("attempt_id", T.step_path(record, step).alias("step_path"), T.cache_path(step).alias("cache_path"), T.workflow_id(record).alias("workflow_id"))


#: Message texts with blocks put around them, since the tables' texts have none.
def fenced(spark: SparkSession, d: str) -> DataFrame:
    m = V.messages(spark, d)
    k, turn = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(5)), F.col("turn").cast("string")
    body = F.concat(F.lit('{"turn": '), turn, F.lit("}"))
    text = (
        F.when(k == 0, F.concat(F.lit("See\n```json\n"), body, F.lit("\n```\nthen\n```\n[1]\n```")))
        .when(k == 1, F.concat(F.lit("Result "), body, F.lit(" done"))).when(k == 2, F.lit("no data"))
        .when(k == 3, F.lit("```json\n{bad\n```")).otherwise(F.concat(F.lit("```json\n[0]\n``` and ```json\n"), body, F.lit("\n```")))
    )
    return m.select("conv_id", "turn", "role", text.alias("text"))


_BODY = """'{"turn": ' || turn || '}'"""
_FENCED = f"""select conv_id, turn, role, case (conv_id + turn) % 5 when 0 then 'See' || chr(10) || '```json' || chr(10) || {_BODY} || chr(10) || '```' || chr(10) || 'then' || chr(10) || '```' || chr(10) || '[1]' || chr(10) || '```'
  when 1 then 'Result ' || {_BODY} || ' done' when 2 then 'no data' when 3 then '```json' || chr(10) || '{{bad' || chr(10) || '```'
  else '```json' || chr(10) || '[0]' || chr(10) || '``` and ```json' || chr(10) || {_BODY} || chr(10) || '```' end as text from conversations"""
FIRST = r"case when regexp_matches(text, '(?s)```json\s*(.*?)\s*```') then regexp_extract(text, '(?s)```json\s*(.*?)\s*```', 1) else text end"
LAST = r"case when regexp_matches(text, '(?s)```(?:json)?\s*(.*?)\s*```') then list_extract(regexp_extract_all(text, '(?s)```(?:json)?\s*(.*?)\s*```', 1), -1) when regexp_matches(text, '(?s)\{.*\}') then regexp_extract(text, '(?s)\{.*\}') end"
FENCED = f"fenced as ({_FENCED})"


@query(f"with {FENCED} select conv_id, turn, {FIRST} as block from fenced")
def x10_first_fence(spark: SparkSession, d: str) -> DataFrame:
    return fenced(spark, d).select("conv_id", "turn", T.first_json(F.col("text")).alias("block"))


@query(f"with {FENCED} select conv_id, turn, {LAST} as block from fenced")
def x11_last_fence(spark: SparkSession, d: str) -> DataFrame:
    return fenced(spark, d).select("conv_id", "turn", T.last_json(F.col("text")).alias("block"))


@query(f"with {FENCED} select conv_id, turn, coalesce(json_valid({LAST}), false) as valid from fenced")
def x12_json_valid(spark: SparkSession, d: str) -> DataFrame:
    return fenced(spark, d).select("conv_id", "turn", F.coalesce(T.is_json(T.last_json(F.col("text"))), F.lit(False)).alias("valid"))


@query(f"with {FENCED} select conv_id, turn, coalesce(json_valid({LAST}) and json_extract_string(case when json_valid({LAST}) then {LAST} else 'null' end, '$.turn') is not null, false) as conforms from fenced")
def x13_schema_conforms(spark: SparkSession, d: str) -> DataFrame:
    return fenced(spark, d).select("conv_id", "turn", T.conforms(T.last_json(F.col("text")), {"turn": "string"}).alias("conforms"))


@query(r"select page_id, regexp_replace(regexp_extract(doc, '(?s)\[BEGIN\][^\n]*\n(.*?)\[END\]', 1), '^[ \t\n\x0B\f\r ]+|[ \t\n\x0B\f\r ]+$', '', 'g') as section from (select page_id, 'intro' || chr(10) || '[BEGIN] part' || chr(10) || chr(10) || url || chr(10) || ' tail ' || chr(10) || '[END]' || chr(10) || 'rest' as doc from pages)")
def x14_prompt_section(spark: SparkSession, d: str) -> DataFrame:
    doc = F.concat(F.lit("intro\n[BEGIN] part\n\n"), "url", F.lit("\n tail \n[END]\nrest"))
    return V.table(spark, d, "pages").select("page_id", T.section(doc, "[BEGIN]", "[END]").alias("section"))


@query("select p_partkey, 'Classes of ' || p_name || ' by ' || p_brand || '.' as prompt from part")
def x15_template_fill(spark: SparkSession, d: str) -> DataFrame:
    return V.table(spark, d, "part").select("p_partkey", T.fill(F.lit("Classes of {drug} by {firm}."), {"drug": F.col("p_name"), "firm": F.col("p_brand")}).alias("prompt"))


@query(V.sql("select page_id, case when length(raw_content) > 5000 then substr(raw_content, 1, 5000) || '... [truncated]' else raw_content end as content from search_results", "search_results"))
def x16_truncate(spark: SparkSession, d: str) -> DataFrame:
    return V.search_results(spark, d).select("page_id", T.shortened(F.col("raw_content")).alias("content"))


_SHORTENED = "case when length(raw_content) > 5000 then substr(raw_content, 1, 5000) || '... [truncated]' else raw_content end"


@query(V.sql(f"select site, string_agg('### Result ' || i || chr(10) || 'URL: ' || url || chr(10) || {_SHORTENED}, chr(10) || chr(10) order by i) as block from (select *, row_number() over (partition by site order by url, page_id) as i from (select *, page_id // 5 as site from search_results)) group by site", "search_results"))
def x17_whole_result_block(spark: SparkSession, d: str) -> DataFrame:
    """The block with all of each page up to 5000 characters."""
    rows = V.search_results(spark, d).groupBy(F.expr("page_id div 5").alias("site")).agg(F.array_sort(F.collect_list(F.struct("url", "page_id", T.shortened(F.col("raw_content")).alias("content")))).alias("r"))
    return rows.select("site", T.numbered(F.col("r"), lambda i, x: F.concat(F.lit("### Result "), i, F.lit("\nURL: "), x["url"], F.lit("\n"), x["content"])).alias("block"))


@query("select page, string_agg(i || '. [' || p_partkey || '] ' || p_name, chr(10) order by i) as rules from (select *, p_partkey // 20 as page, row_number() over (partition by p_partkey // 20 order by p_partkey) as i from part) group by page")
def x18_rule_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = V.table(spark, d, "part").groupBy(F.expr("p_partkey div 20").alias("page")).agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))).alias("r"))
    return rows.select("page", T.numbered(F.col("r"), lambda i, x: F.concat(i, F.lit(". ["), x["p_partkey"].cast("string"), F.lit("] "), x["p_name"]), "\n").alias("rules"))


_MODEL = "case p_partkey % 3 when 0 then p_name when 1 then p_brand || '/' || p_name else p_brand || '/' || p_name || '/' || p_type end"


@query(f"select p_partkey, case when contains(m, '/') then split_part(m, '/', 1) else 'openai' end as provider, case when contains(m, '/') then split_part(m, '/', 2) else m end as model from (select p_partkey, {_MODEL} as m from part)")
def x19_model_parts(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).when(F.col("p_partkey") % 3 == 1, F.concat_ws("/", "p_brand", "p_name")).otherwise(F.concat_ws("/", "p_brand", "p_name", "p_type"))
    provider, model = T.model_parts(name)
    return V.table(spark, d, "part").select("p_partkey", provider.alias("provider"), model.alias("model"))


@query(r"select lower(regexp_replace(p_name, '[-\s]', '', 'g')) as equivalent, count(*) as n from part group by 1")
def x20_equivalence_key(spark: SparkSession, d: str) -> DataFrame:
    return V.table(spark, d, "part").groupBy(T.equivalence_key(F.col("p_name")).alias("equivalent")).agg(F.count("*").alias("n"))


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as stamp, strftime(o_orderdate, '%Y%m%d_%H%M%S') as file_stamp from orders")
def x21_stamps(spark: SparkSession, d: str) -> DataFrame:
    return V.table(spark, d, "orders").select("o_orderkey", T.utc_stamp(F.col("o_orderdate")).alias("stamp"), T.file_stamp(F.col("o_orderdate")).alias("file_stamp"))


@query(V.sql(f"select firm_id, case when {strip('raw')} = '' then '(EMPTY - no sponsor given)' else raw end as shown from firms", "firms"))
def x22_empty_shown(spark: SparkSession, d: str) -> DataFrame:
    return V.firms(spark, d).select("firm_id", T.shown(F.col("raw"), "no sponsor given").alias("shown"))


@query("select p_partkey, coalesce(nullif(case when p_size % 2 = 0 then '' else p_brand end, ''), nullif(case when p_size % 3 = 0 then '' else p_type end, ''), 'NA') as class from part")
def x23_first_truthy(spark: SparkSession, d: str) -> DataFrame:
    a = F.when(F.col("p_size") % 2 == 0, "").otherwise(F.col("p_brand"))
    b = F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_type"))
    return V.table(spark, d, "part").select("p_partkey", T.first_truthy(a, b, F.lit("NA")).alias("class"))


@query("select n_nationkey, regexp_replace(chr(65279) || n_name, '^' || chr(65279) || '+', '') as name from nation")
def x24_without_bom(spark: SparkSession, d: str) -> DataFrame:
    return V.table(spark, d, "nation").select("n_nationkey", T.without_bom(F.concat(F.lit(chr(65279)), "n_name")).alias("name"))


@query("select abstract_id, round(s / 8.0, 2) as seconds from (select cast(user_id as varchar) as abstract_id, count(*) as s from events group by 1)")
def x25_rounded(spark: SparkSession, d: str) -> DataFrame:
    return V.attempts(spark, d).groupBy("abstract_id").agg(T.rounded(F.count("*") / F.lit(8.0)).alias("seconds"))


@query(r"select p_partkey, translate('a/' || p_name || '\b:' || p_brand, '/\:', '___') as file_name from part")
def k11_file_name(spark: SparkSession, d: str) -> DataFrame:
    return V.table(spark, d, "part").select("p_partkey", T.file_name(F.concat(F.lit("a/"), "p_name", F.lit("\\b:"), "p_brand")).alias("file_name"))


@query(V.sql("""select team, '[' || string_agg('"' || lower(name) || '"', ', ' order by lower(name)) || ']' as firms_key, case when count(*) = 1 then '(drug AND ' || min(name) || ')' else '(drug AND (' || string_agg(name, ' OR ' order by name) || '))' end as search_query from (select *, firm_id // 4 as team from firms) group by team""", "firms"))
def o06_s19_firms_key(spark: SparkSession, d: str) -> DataFrame:
    names = V.firms(spark, d).groupBy(F.expr("firm_id div 4").alias("team")).agg(F.array_sort(F.collect_list("name")).alias("names"))
    return names.select("team", T.firms_key(F.col("names")).alias("firms_key"), T.search_query(F.lit("drug"), F.col("names")).alias("search_query"))
