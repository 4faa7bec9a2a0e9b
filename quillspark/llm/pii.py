"""Personal data in texts by candidate gradient boosting. DataFrame functions and Spark ML only.

1. Generators with high recall propose overlapping spans: the base patterns, and looser ones
   (addresses spelt with "at" and "dot", national telephone numbers, spaced or dashed card and address numbers).
2. Boosted trees score each looser candidate by its format (lengths, separators, digit groups, check digits) and its
   context (neighbouring characters, keywords before it).
3. A threshold a kind, calibrated on the half of the labelled candidates that the trees don't see, selects redactions: the least
   score from which on at least ``PRECISION`` of the candidates are true.

The trees are trained here, on ``TRAINING`` lines composed of templates, fillers and generated values, true ones and
look-alikes (dates, versions, amounts, order and serial numbers), which pass through the same generators. Spark ML's
trees are part of Spark and run in the JVM; the same seeds give the same trees, and a Spark application trains them once.

Base matches always stay. An added span never overlaps a base span or a better added one.

Edge cases: null texts are empty. Rows that repeat doc_id and text get the same spans each. Positions are code points.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.common import durable, plain
from quillspark.llm.spans import bound, count_of, listed, same_row, spans_of, with_matches

KINDS = ("email", "ip", "card", "phone")
#: Lines that the trees are trained and calibrated on, trees and their depth, and the precision asked for.
TRAINING, TREES, DEPTH, PRECISION = 6000, 12, 4, 0.99
#: Code points of context on either side, of the buckets in which spans meet, and of the chunks that contexts are cut from.
CONTEXT, BUCKET, CHUNK = 24, 200, 1000
SPANS = "array<struct<kind:string,start:int,stop:int>>"

# Possessive forms of the base patterns: the same matches, in time proportional to the text. A match can only
# start where a run of its first characters does, or where the match before it ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"

# Looser generators.
MORE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[a-z0-9][a-z0-9._%+-]{1,40}\s?(?:\(at\)|\[at\]|\{at\}|\sat\s)\s?[a-z0-9-]{2,40}(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\}|\sdot\s)\s?[a-z0-9-]{2,20}){1,3}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\s?\.\s?[0-9]{1,3}){3}(?![0-9.])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\s./_-]{1,2}[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\(?0[0-9]{1,4}\)?[\s./-]{0,2}|\(?[2-9][0-9]{2}\)?[\s./-]{1,2}|00[1-9][0-9]{0,2}[\s./-]{1,2})[0-9]{2,4}(?:[\s./-]?[0-9]{2,4}){1,3}(?![0-9])",
}
_WORDS = {"email": "mail|contact|write|reach", "ip": r"\bip\b|host|address|server|login", "card": "card|visa|credit|payment|master", "phone": r"phone|tel\b|tel\.|call|mobile|fax|dial"}


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit fits."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0


def _is_card(found: Column) -> Column:
    digits = F.translate(found, " -", "")
    return F.length(digits).between(12, 19) & luhn(F.when(F.length(digits).between(12, 19), digits).otherwise("0"))


def _is_phone(found: Column) -> Column:
    return F.length(F.translate(found, "+ ().-", "")).between(9, 15)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    df = plain(docs, id_col, text_col).toDF("doc_id", "text").select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return df.withColumn("version", F.xxhash64("text"))


def candidates(texts: DataFrame) -> DataFrame:
    """doc_id, version, base (spans) and loose (struct<kind, start, stop, found, left, right>) of every row."""
    text = F.col("text")
    numeric = text.rlike("[0-9]")
    df = with_matches(texts, "email", "text", EMAIL, text.contains("@"))
    df = with_matches(df, "ip", "text", IP, numeric & text.rlike(r"[0-9]\.[0-9]"))
    df = with_matches(df, "card", "text", CARD, numeric & text.rlike("[0-9](?:[ -]?[0-9]){11}"))
    df = with_matches(df, "phone", "text", PHONE, text.contains("+"))
    gates = {"email": text.rlike(r"(?i)[(\[{\s]at[)\]}\s]") & text.rlike(r"(?i)\.|dot"), "ip": text.rlike(r"[0-9]\s?\.\s?[0-9]"), "card": text.rlike("[0-9]{4}"), "phone": text.rlike(r"(?:[0-9][()\s./-]{0,3}){5}[0-9]")}
    for kind in KINDS:
        df = with_matches(df, f"loose_{kind}", "text", MORE[kind], gates[kind] if kind == "email" else numeric & gates[kind])
    base = F.concat(
        spans_of("email", "email"),
        spans_of("ip", "ip", lambda m: m.rlike(_PARTS)),
        spans_of("card", "card", _is_card),
        spans_of("phone", "phone", _is_phone),
    )
    # Contexts are cut from chunks, since a substring is counted from its text's start.
    chunk = lambda own, b: F.coalesce(F.get(own, b), F.lit(""))
    at = lambda place: F.floor(place / CHUNK).cast("int")
    left = lambda own, m: F.substring(
        F.concat(chunk(own, at(m["start"]) - 1), chunk(own, at(m["start"]))),
        F.greatest(m["start"] - CONTEXT, F.lit(0)) - F.greatest(at(m["start"]) - 1, F.lit(0)) * CHUNK + 1,
        F.least(m["start"], F.lit(CONTEXT)),
    )
    right = lambda own, m: F.substring(F.concat(chunk(own, at(m["stop"])), chunk(own, at(m["stop"]) + 1)), m["stop"] - at(m["stop"]) * CHUNK + 1, F.lit(4))
    around = lambda own, kind: F.transform(
        F.col(f"loose_{kind}"),
        lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["stop"].alias("stop"), m["found"].alias("found"), F.lower(left(own, m)).alias("left"), right(own, m).alias("right")),
    )
    any_loose = sum((F.size(f"loose_{k}") for k in KINDS), F.lit(0)) > 0
    chunks = F.when(any_loose, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))).otherwise(F.array().cast("array<string>"))
    loose = bound(chunks, lambda own: F.concat(*[around(own, k) for k in KINDS]))
    return df.select("doc_id", "version", base.alias("base"), loose.alias("loose"))


def apart_from_base(parts: DataFrame) -> DataFrame:
    """doc_id, version and the columns of each looser candidate that no base span overlaps. They meet in buckets of a text, so work doesn't grow with the square of its spans."""
    each = parts.where(F.size("loose") > 0).select("doc_id", "version", F.explode("loose").alias("c")).select("doc_id", "version", "c.*").distinct()
    touched = lambda start, stop: F.explode(F.sequence(F.floor(start / BUCKET), F.floor((stop - 1) / BUCKET)))
    base = parts.where(F.size("loose") > 0).select("doc_id", "version", F.explode("base").alias("b")).select(F.col("doc_id").alias("b_id"), F.col("version").alias("b_version"), F.col("b.start").alias("b_start"), F.col("b.stop").alias("b_stop")).distinct()
    base = base.withColumn("b_bucket", touched(F.col("b_start"), F.col("b_stop")))
    spread = each.select("doc_id", "version", "kind", "start", "stop").withColumn("bucket", touched(F.col("start"), F.col("stop")))
    meet = F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("version") == F.col("b_version")) & (F.col("bucket") == F.col("b_bucket")) & F.expr("b_start < stop and b_stop > start")
    over = spread.join(base, meet, "left_semi").select(*[F.col(c).alias(f"o_{c}") for c in ("doc_id", "version", "kind", "start", "stop")]).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("o_doc_id"))
    for c in ("version", "kind", "start", "stop"):
        same = same & (F.col(c) == F.col(f"o_{c}"))
    return each.join(over, same, "left_anti")


def without_overlaps(chosen: DataFrame) -> DataFrame:
    """doc_id, version, more: of the spans that overlap, the one of the best score stays. Spans are parted where nothing overlaps, and each part decides for itself."""
    by_start = Window.partitionBy("doc_id", "version").orderBy("start", "stop", "kind")
    reach = F.max("stop").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    parts = chosen.withColumn("opens", F.coalesce((reach <= F.col("start")).cast("int"), F.lit(1))).withColumn("part", F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = parts.groupBy("doc_id", "version", "part").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "start", "stop", "kind"))).alias("all"))
    kept = F.aggregate(
        "all",
        F.array().cast(SPANS),
        lambda acc, c: F.when(F.exists(acc, lambda k: (k["start"] < c["stop"]) & (k["stop"] > c["start"])), acc).otherwise(F.concat(acc, F.array(F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["stop"].alias("stop"))))),
    )
    return ranked.select("doc_id", "version", kept.alias("kept")).groupBy("doc_id", "version").agg(F.flatten(F.collect_list("kept")).alias("more"))


def features(loose: DataFrame) -> DataFrame:
    """Adds the vector `features` to rows with kind, found, left and right."""
    found, left = F.col("found"), F.col("left")
    digits = _digits(found)
    groups = F.filter(F.split(found, "[^0-9]+"), lambda g: g != "")
    sizes = F.transform(groups, lambda g: F.length(g))
    number = lambda c: c.cast("double")
    columns = {
        **{f"is_{k}": number(F.col("kind") == k) for k in KINDS},
        "length": number(F.length(found)), "digits": number(F.length(digits)), "groups": number(F.size(groups)),
        "longest": number(F.coalesce(F.array_max(sizes), F.lit(0))), "shortest": number(F.coalesce(F.array_min(sizes), F.lit(0))),
        "spaces": number(F.length(F.regexp_replace(found, r"\S", ""))), "dots": number(F.length(F.regexp_replace(found, r"[^.]", ""))), "dashes": number(F.length(F.regexp_replace(found, "[^-]", ""))),
        "slashes": number(F.length(F.regexp_replace(found, "[^/]", ""))), "brackets": number(F.length(F.regexp_replace(found, r"[^()\[\]{}]", ""))),
        "zero": number(digits.startswith("0")), "checked": number(F.when(F.length(digits).between(12, 19), luhn(F.when(F.length(digits).between(12, 19), digits).otherwise("0"))).otherwise(False)),
        "small_parts": number(F.forall(groups, lambda g: (F.length(g) < 4) & (F.when(F.length(g) < 4, g).otherwise("0").cast("int") < 256))),
        "date": number(found.rlike(r"^(?:19|20)[0-9]{2}[-./ ]|[-./ ](?:19|20)[0-9]{2}$")),
        "domain": number(found.rlike(r"(?i)(?:\.|dot[)\]}]?)\s?(?:com|org|net|edu|info|example|de|fr|es|io|co|uk)$")), "sentence": number(found.rlike(r"[a-z]\.\s+[A-Z]")),
        "glued": number(left.rlike(r"[\p{L}0-9_.$€#/-]$")), "runs_on": number(F.col("right").rlike(r"^(?:[\p{L}0-9_%]|[.,/-][0-9])")),
        "keyword": number(F.coalesce(*[F.when(F.col("kind") == k, left.rlike(w)) for k, w in _WORDS.items()])),
        "other_word": number(left.rlike(r"order|serial|version|page|isbn|ref|invoice|part|id|no\.|total|date|on the|year")),
    }
    named = loose.select("*", *[F.coalesce(c, F.lit(0.0)).alias(f"f_{n}") for n, c in columns.items()])
    vectors = VectorAssembler(inputCols=[f"f_{n}" for n in columns], outputCol="features").transform(named)
    return vectors.drop(*[f"f_{n}" for n in columns])


def _pick(options: list[str], salt: int) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(options))) + 1).cast("int"))


def _number(size: int, salt: int) -> Column:
    return F.lpad(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(10**size)).cast("string"), size, "0")


def training_lines(spark: SparkSession, lines: int = TRAINING) -> DataFrame:
    """doc_id, text, truth (whether the value is personal) and kind of composed lines."""
    sep = _pick([" ", "-", ".", "/"], 1)
    name, host = _pick(["anna", "j.smith", "office", "lee_42", "info", "marc.d", "k-weber"], 2), _pick(["mail", "example", "post-box", "acme", "lab2"], 3)
    at, dot = _pick(["(at)", "[at]", " at ", " (at) ", " [at] ", "{at}"], 4), _pick([".", "(dot)", " dot ", "[dot]", " (dot) "], 5)
    part = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(256)).cast("string")
    fifteen = F.concat(F.lit("4"), _number(14, 6))
    check = F.lpad(F.pmod(10 - F.aggregate(F.transform(F.split(F.reverse(fifteen), ""), lambda d, i: F.when(i % 2 == 1, d.cast("int")).otherwise(F.pmod(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0), F.lit(10)))), F.lit(0), lambda s, d: s + d), F.lit(10)).cast("string"), 1, "0")
    card = F.concat(fifteen, check)
    joined = lambda by, *parts: F.call_function("concat_ws", by, *parts)
    spaced = lambda s, by: joined(by, F.substring(s, 1, 4), F.substring(s, 5, 4), F.substring(s, 9, 4), F.substring(s, 13, 4))
    true = {
        "email": F.concat(name, at, host, dot, _pick(["com", "org", "net", "de", "fr"], 7)),
        "ip": joined(_pick([" . ", ". ", " ."], 8), part(9), part(10), part(11), part(12)),
        "card": spaced(card, _pick([".", "/", "_", "  ", "--"], 13)),
        "phone": F.when(F.pmod("id", F.lit(16)) < 8, F.concat(F.lit("("), _pick(["274", "555", "312", "808"], 14), F.lit(") "), _number(3, 15), F.lit("-"), _number(4, 16))).otherwise(F.concat(_pick(["030", "0171", "089", "00 49 30"], 17), sep, _number(3, 18), sep, _number(4, 19))),
    }
    false = {
        "email": F.concat(_pick(["look", "met", "arrived", "sold", "stay", "him"], 20), F.lit(" at "), _pick(["home", "noon", "the", "least", "work"], 21), _pick([". the", ". a", " dot on", ". in", ". he", ". Then", ".\nThese", ". Es", ". Denes", " . co", ". Come"], 22)),
        "ip": joined(_pick([". ", " . ", "."], 23), F.lit("3"), _number(1, 24), _number(3, 25), _number(2, 26)),
        "card": spaced(F.concat(_pick(["2019", "1998", "0012", "7310"], 27), _number(12, 28)), _pick(["/", ".", "-", "_"], 29)),
        "phone": _pick_false_phone(sep),
    }
    kind = _pick(list(KINDS), 30)
    good = F.pmod(F.xxhash64("id", F.lit(31)), F.lit(2)) == 0
    value = F.coalesce(*[F.when((kind == k) & good, true[k]).when(kind == k, false[k]) for k in KINDS])
    lead = F.coalesce(
        *[F.when((kind == k) & good, _pick(words, 32)) for k, words in {"email": ["contact ", "mail: ", "write to ", "and ", ""], "ip": ["ip ", "address ", "host ", "server "], "card": ["card ", "visa: ", "credit card ", "payment "], "phone": ["call ", "tel. ", "phone: ", "fax ", "mobile "]}.items()],
        _pick(["order ", "serial ", "page ", "total ", "version ", "ref ", "and ", "in ", "on ", "$"], 33),
    )
    tail = F.when(good, _pick([" today", ".", ", thanks", ""], 34)).otherwise(_pick([" items", "%", " pages", "", ".5"], 35))
    rows = spark.range(lines)
    return rows.select(F.col("id").alias("doc_id"), F.concat(_pick(["Please ", "Then ", "We ", ""], 36), lead, value, tail).alias("text"), good.alias("truth"), kind.alias("planted"))


def _pick_false_phone(sep: Column) -> Column:
    year = _pick(["2019", "2021", "1998"], 40)
    return F.when(F.pmod("id", F.lit(3)) == 0, F.concat(_pick(["01", "07", "05"], 41), sep, _pick(["02", "11", "12"], 42), sep, year)).when(F.pmod("id", F.lit(3)) == 1, F.concat(_number(3, 43), F.lit("."), _number(3, 44), F.lit("."), _number(3, 45))).otherwise(F.concat(F.lit("0"), _number(3, 46), F.lit("/"), _number(2, 47), F.lit("-"), _number(2, 48)))


_kept: dict[str, tuple[GBTClassificationModel, dict[str, float]]] = {}


def trained(spark: SparkSession) -> tuple[GBTClassificationModel, dict[str, float]]:
    """The trees, and the threshold of each kind; trained once in a Spark application."""
    application = spark.sparkContext.applicationId
    if application not in _kept:
        _kept.clear()
        _kept[application] = _train(spark)
    return _kept[application]


def _train(spark: SparkSession) -> tuple[GBTClassificationModel, dict[str, float]]:
    lines = durable(training_lines(spark), "lines")
    found = apart_from_base(candidates(lines.withColumn("version", F.col("doc_id")).select("doc_id", "text", "version"))).drop("version")
    rows = durable(found.join(F.broadcast(lines.select("doc_id", "truth", "planted")), "doc_id"), "candidates")  # TRAINING rows
    rows = features(rows).select("doc_id", "kind", "features", (F.col("truth") & (F.col("kind") == F.col("planted"))).cast("double").alias("label"))
    rows = durable(rows.coalesce(1), "features")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=5, checkpointInterval=-1).fit(rows.where("doc_id % 2 = 0"))
    held = model.transform(rows.where("doc_id % 2 = 1")).select("kind", "label", F.floor(vector_to_array("probability")[1] * 100).alias("bin"))
    counts = held.groupBy("kind", "bin").agg(F.count("*").alias("n"), F.sum("label").alias("true")).orderBy("kind", "bin").collect()  # at most 101 rows a kind
    thresholds = {}
    for kind in KINDS:
        n = true = 0
        for r in sorted((r for r in counts if r.kind == kind), key=lambda r: -r.bin):
            n, true = n + r.n, true + r.true
            if true >= PRECISION * n and r.bin >= 50:
                thresholds[kind] = r.bin / 100
    return model, {k: thresholds.get(k, 1.01) for k in KINDS}


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans (base and selected candidates) of every row of docs."""
    model, thresholds = trained(docs.sparkSession)
    parts = durable(candidates(_texts(docs, id_col, text_col)), "pii")
    scored = model.transform(features(apart_from_base(parts))).withColumn("score", vector_to_array("probability")[1])
    least = F.coalesce(*[F.when(F.col("kind") == k, F.lit(t)) for k, t in thresholds.items()])
    chosen = durable(scored.where(F.col("score") >= least).select("doc_id", "version", "kind", "start", "stop", "score"), "chosen")
    both = same_row(parts, without_overlaps(chosen), "left")
    return both.select("doc_id", "base", F.concat("base", F.coalesce("more", F.array().cast(SPANS))).alias("spans"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_spans of every row of docs."""
    counts = [count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS]
    return find(docs).select("doc_id", *counts, F.sha2(listed(F.col("base"), KINDS), 256).alias("base_sha256"), listed(F.col("spans"), KINDS).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
