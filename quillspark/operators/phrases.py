"""Dictionary phrases in titles, and the roles of the drugs that they name, without a pass for each phrase.

A dictionary of any size gives phrases and what they mean: drugs, words between drugs, words that are never a drug, and words after which nothing counts.
It is matched as a trie of tokens by joins: a title's tokens meet the first tokens of phrases, which say how long the phrases that begin so are; windows of these lengths
then meet the phrases themselves. Of the matches of a title, the leftmost stays, and the longest of those that begin together, as a trie walked
from left to right would find them. The sequence that is left is read once, with the role that the last words between drugs gave.

Tokens are words with inner hyphens, slashes and apostrophes, and the signs + and ±, in lower case. A null title has none. A phrase that has several
meanings has the first of them in the order of KINDS. Drugs are named as the dictionary names them, each once in a role, in their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import rules as U

#: What a phrase can mean: words between drugs by the role of the drugs after them, a drug, never a drug, and what ends the part of a title that counts.
KINDS = ("secondary", "comparator", "primary", "stop", "excluded", "drug")
# Words that are never a drug, and words after which drugs aren't the title's own.
NEVER = ("placebo", "chemotherapy", "radiotherapy", "immunotherapy", "fluoropyrimidine", "intravenous", "subcutaneous", "oral", "topical", "inhibitor", "blockade", "antagonist", "agonist", "blocker")
STOPS = ("previously treated with", "pretreated with", "prior treatment with", "refractory to", "resistant to", "a type of")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+(?:[-/'][\p{L}\p{N}]+)*|[+±]"), F.lit(0))


def dictionary(drugs: DataFrame, name: str) -> DataFrame:
    """phrase, kind, value: the fixed words of titles, and the names in a column of drugs."""
    fixed = [(p, "secondary") for p in U.SECONDARY] + [(p, "comparator") for p in U.COMPARATOR] + [(p, "primary") for p in U.PRIMARY] + [(p, "stop") for p in STOPS] + [(p, "excluded") for p in NEVER]
    words = drugs.sparkSession.createDataFrame(fixed, "phrase string, kind string").withColumn("value", F.lit(None).cast("string"))
    return words.unionByName(drugs.select(F.col(name).alias("phrase"), F.lit("drug").alias("kind"), F.col(name).alias("value")).distinct())


def trie(phrases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first tokens with the lengths of phrases that begin so, and the phrases by their tokens, one meaning each."""
    cut = phrases.withColumn("t", tokens(F.col("phrase"))).where("size(t) > 0")
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    leaves = cut.groupBy(F.array_join("t", " ").alias("gram"), F.size("t").alias("n"), F.element_at("t", 1).alias("first")).agg(F.min(F.struct(rank.alias("rank"), "kind", "value")).alias("m"))
    return leaves.groupBy("first").agg(F.collect_set("n").alias("lengths")), leaves.select("gram", "n", "m.kind", "m.value")


def matches(titles: DataFrame, key: str, text: str, phrases: DataFrame) -> DataFrame:
    """key, found: array<struct<at, n, kind, value>> of the leftmost longest matches of each title that has any."""
    first, leaves = trie(phrases)
    cut = titles.select(key, tokens(F.col(text)).alias("t"))
    begins = cut.select(key, "t", F.posexplode("t").alias("at", "first")).join(first, "first")
    grams = begins.select(key, "at", F.explode("lengths").alias("n"), "t").where(F.col("at") + F.col("n") <= F.size("t"))
    hits = grams.select(key, "at", F.array_join(F.slice("t", F.col("at") + 1, F.col("n")), " ").alias("gram")).join(leaves, "gram")
    every = hits.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", (-F.col("n")).alias("minus"), "kind", "value"))).alias("all"))
    kept = "array<struct<at:int,n:int,kind:string,value:string>>"
    end = lambda acc: F.coalesce(F.try_element_at(acc, F.lit(-1))["at"] + F.try_element_at(acc, F.lit(-1))["n"], F.lit(0))
    walk = F.aggregate("all", F.array().cast(kept), lambda acc, m: F.when(m["at"] >= end(acc), F.concat(acc, F.array(F.struct(m["at"].alias("at"), (-m["minus"]).alias("n"), m["kind"].alias("kind"), m["value"].alias("value"))))).otherwise(acc))
    return every.select(key, walk.alias("found"))


def _read(found: Column) -> Column:
    """The drugs of a sequence of matches with their roles.

    Words for a primary or secondary role hold for the drugs up to the next such words; a comparator's arm goes on to the end, whatever joins its drugs. A
    comparator's words before the first drug compare that drug with those after it. Nothing counts after a stop.
    """
    start = F.struct(F.lit("primary").alias("role"), F.lit(False).alias("compares"), F.lit(False).alias("over"), F.array().cast("array<struct<role:string,drug:string>>").alias("out"))

    def step(s: Column, m: Column) -> Column:
        is_drug, first = m["kind"] == "drug", F.size(s["out"]) == 0
        arm = s["role"] == "comparator"
        by_words = F.when(arm, "comparator").when(m["kind"] == "comparator", F.when(first, "primary").otherwise("comparator")).when(m["kind"].isin("primary", "secondary"), m["kind"]).otherwise(s["role"])
        role = F.when(is_drug & s["compares"] & ~s["over"], "comparator").otherwise(by_words)  # for what comes after the first of two compared
        out = F.when(is_drug & ~s["over"], F.concat(s["out"], F.array(F.struct(s["role"].alias("role"), m["value"].alias("drug"))))).otherwise(s["out"])
        return F.struct(role.alias("role"), (s["compares"] | ((m["kind"] == "comparator") & first)).alias("compares"), (s["over"] | (m["kind"] == "stop")).alias("over"), out.alias("out"))

    return F.aggregate(found, start, step, lambda s: s["out"])


def roles(titles: DataFrame, key: str, text: str, phrases: DataFrame) -> DataFrame:
    """key, primary, secondary, comparator: the drugs of every title by role; a title without a primary drug has its first other one there, and only there."""
    read = titles.select(key).join(matches(titles, key, text, phrases), key, "left").withColumn("drugs", F.coalesce(_read(F.col("found")), F.array().cast("array<struct<role:string,drug:string>>")))
    mine = lambda role: F.array_distinct(F.transform(F.filter("drugs", lambda d: d["role"] == role), lambda d: d["drug"]))
    primary, secondary = U.with_primary(mine("primary"), mine("secondary"))
    both = read.select(key, primary.alias("primary"), secondary.alias("secondary"), mine("comparator").alias("comparator"))
    primary, comparator = U.with_primary(F.col("primary"), F.col("comparator"))
    return both.select(key, primary.alias("primary"), "secondary", comparator.alias("comparator"))
