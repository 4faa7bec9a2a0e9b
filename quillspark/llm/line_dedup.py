"""Removal of repeated line runs by a suffix array of lines, with DataFrame functions only.

A document is a sequence of lines (128-bit ids; lines without words are passed over), and a suffix begins at each.

1. ``suffix_array``: prefix doubling. The distinct lines are sorted over all tasks; a line's place is the rank of the suffixes
   that begin with it. Each round pairs a suffix's rank with that of the suffix 1, 2, 4, ... lines later, sorts the
   distinct pairs over all tasks and numbers them: ranks by twice as many lines. A suffix that has `min_words` words within the lines
   compared is closed and keeps its place among the others, and the rounds end when no open suffix shares its rank:
   a longer common run starts with one of `min_words` words.
2. ``_intervals``: neighbours in that order are compared. Where a suffix shares its lines up to `min_words` words with the one before, its
   longest-common-prefix interval of at least that much goes on; otherwise one begins. (Ranks may tell apart what lies behind
   those words.) Neighbours meet in blocks of consecutive ranks; each block also gets the last rank of the one before, and
   the interval that is still going on there.
3. The first suffix of an interval in document order stays, all others mark their prefix; runs that overlap or touch
   merge into the maximal repeated runs, and those are deleted.

Lines that occur once leave the array at once, unless they stand within `min_words` lines after the start of an open suffix, whose order
may depend on them. Ranks and intervals are counted with map-side combination. Those that make up a thousandth of all rows or
more are at most a thousand and are joined by broadcast; all others are joined by shuffle, so that no
common line gathers in one task.

Edge cases: null texts stay null and have no lines. Lines are what `\\n` separates. Rows that repeat
both doc_id and text share one verdict. The order is by doc_id (null first), then by a hash of the text, then by line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import durable, fresh, join_counted, plain

#: Consecutive ranks whose neighbours are compared in one group.
BLOCK = 1024


def _suffixes(docs: DataFrame, min_words: int) -> DataFrame:
    """t, doc_id, version, at, start, stop, n, near, a, b: each suffix with its text's number and its first line.

    n: its lines until min_words words are reached, 0 if the text ends sooner; near: a suffix that isn't closed by its first line begins less than min_words lines before.
    """
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(i.alias("pos"), F.xxhash64(F.lit(1), line).alias("a"), F.xxhash64(F.lit(2), line).alias("b"), _n_words(line, min_words).alias("w")),
    )
    numbered = docs.select(F.monotonically_increasing_id().alias("t"), "doc_id", "version", "text")
    kept = numbered.select("t", "doc_id", "version", F.filter(lines, lambda x: x["w"] > 0).alias("lines")).where(F.size("lines") > 0)

    def reach(i: Column) -> Column:
        count = F.aggregate(
            F.slice("lines", i + 1, min_words),
            F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines")),
            lambda acc, x: F.when(acc["words"] >= min_words, acc).otherwise(F.struct((acc["words"] + x["w"]).alias("words"), (acc["lines"] + 1).alias("lines"))),
        )
        return F.when(count["words"] >= min_words, count["lines"]).otherwise(0)

    starts = kept.withColumn("reach", F.transform(F.sequence(F.lit(0), F.size("lines") - 1), reach))

    def suffix(n: Column, i: Column) -> Column:
        line, back = F.get(F.col("lines"), i), F.least(i, F.lit(min_words - 1))
        near = F.exists(F.slice("reach", i - back + 1, back), lambda x: x != 1)
        return F.struct(i.alias("at"), line["pos"].alias("start"), F.get(F.col("lines"), i + n - 1)["pos"].alias("stop"), n.alias("n"), near.alias("near"), line["a"].alias("a"), line["b"].alias("b"))

    return starts.select("t", "doc_id", "version", F.explode(F.transform("reach", suffix)).alias("s")).select("t", "doc_id", "version", "s.*")


def _n_words(line: Column, most: int) -> Column:
    """Words of a line, counted up to `most`."""
    bare = F.regexp_replace(line, r"^[ \t-\r]+", "")
    return F.when(bare == "", 0).otherwise(F.least(F.size(F.filter(F.split(bare, r"[ \t-\r]+", most + 1), lambda w: w != "")), F.lit(most)))


def _versioned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return plain(docs, id_col, text_col).toDF("doc_id", "text").withColumn("version", F.xxhash64("text"))


def _numbered(keys: DataFrame, by: list[str], most: int) -> DataFrame:
    """keys, which are distinct, sorted over all tasks; place: their number in that order, from 1."""
    part, own = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit(2**33 - 1))
    ordered = durable(keys.orderBy(*by).withColumn("id", F.monotonically_increasing_id()), "order", most)
    parts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))  # one row a task
    before = parts.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    return ordered.join(F.broadcast(before), part == F.col("part")).select(*keys.columns, (F.col("before") + own + 1).alias("place"))


def suffix_array(suffixes: DataFrame, min_words: int) -> DataFrame:
    """The suffixes with rank, their place by at least their first n lines, and prefix, the ranks of these lines; equal rows of the order have equal ranks.

    suffixes: a table of `_suffixes` that `durable` has written.
    """
    within = Window.partitionBy("t").orderBy("at")
    lines = suffixes.groupBy("a", "b").agg(F.count("*").alias("c"), F.max("near").alias("near"), F.max("n").alias("n")).where("c > 1 or near")
    names = _numbered(lines, ["a", "b"], suffixes.rows)
    array = join_counted(suffixes.drop("near"), names.select("a", "b", "c", F.col("place").alias("rank")), ["a", "b"], "c", suffixes.rows).drop("a", "b", "c")
    ahead = F.collect_list("rank").over(within.rangeBetween(0, min_words - 1))
    array = array.withColumn("prefix", F.when(F.col("n") == 1, F.array("rank")).otherwise(F.slice(ahead, 1, F.col("n"))))
    depth = 1
    while depth < min_words and not names.where((F.col("c") > 1) & (F.col("n") > depth)).isEmpty():
        later = F.first("rank").over(within.rangeBetween(depth, depth))  # none: the text has ended
        pairs = durable(array.withColumn("then", F.when(F.col("n").between(1, depth), 0).otherwise(F.coalesce(later, F.lit(0)))), "pairs", suffixes.rows)
        names = _numbered(pairs.groupBy("rank", "then").agg(F.count("*").alias("c"), F.max("n").alias("n")), ["rank", "then"], pairs.rows)
        array = join_counted(pairs, names.drop("n"), ["rank", "then"], "c", pairs.rows).drop("rank", "then", "c").withColumnRenamed("place", "rank")
        depth *= 2
    return durable(array, "array", suffixes.rows)


def _intervals(array: DataFrame) -> DataFrame:
    """rank, c, first: the ranks in intervals of more than one suffix, with their rows and the interval's first suffix."""
    keys = array.groupBy("rank").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "version", "at")).alias("first"), F.any_value("prefix").alias("prefix"))
    block = F.expr(f"rank div {BLOCK}")
    dealt = keys.withColumn("block", F.explode(F.when(F.col("rank") % BLOCK == BLOCK - 1, F.array(block, block + 1)).otherwise(F.array(block))))
    order = Window.partitionBy("block").orderBy("rank")
    goes_on = (F.size("prefix") > 0) & F.col("prefix").eqNullSafe(F.lag("prefix").over(order))
    own = F.col("block") == block  # not the last rank of the block before
    compared = dealt.withColumn("head", F.when(own & ~goes_on, F.col("rank"))).withColumn("since", F.max("head").over(order)).where(own)
    compared = durable(compared.drop("prefix"), "compared", array.rows)
    ends = compared.groupBy("block").agg(F.max("head").alias("head"))  # one row a block
    ends = ends.select("block", F.max("head").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("open"))
    members = compared.join(F.broadcast(ends), "block").select("rank", "c", "first", F.coalesce("since", "open").alias("interval"))
    found = members.groupBy("interval").agg(F.sum("c").alias("n"), F.count("*").alias("ranks"), F.min("first").alias("first")).where("n > 1")
    found = durable(found, "intervals", compared.rows)
    return join_counted(members.select("rank", "c", "interval"), found, ["interval"], "ranks", compared.rows).select("rank", "c", "first")


def repeated_runs(docs: DataFrame, min_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, version, runs: the maximal runs of lines (start, stop inclusive, from 0) that are later copies."""
    texts = _versioned(docs, id_col, text_col)
    array = suffix_array(durable(_suffixes(texts, min_words), "suffixes"), min_words)
    repeated = durable(_intervals(array), "repeated")
    later = F.struct("doc_id", "version", "at") > F.col("first")
    marked = join_counted(array.where("n > 0"), repeated, ["rank"], "c", array.rows).where(later).select("doc_id", "version", "start", "stop")
    spans = marked.groupBy("doc_id", "version").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    merged = F.aggregate(
        "spans",
        F.struct(F.array().cast("array<struct<start:int,stop:int>>").alias("done"), F.lit(None).cast("struct<start:int,stop:int>").alias("open")),
        lambda acc, s: F.when(acc["open"].isNull(), F.struct(acc["done"].alias("done"), s.alias("open")))
        .when(s["start"] <= acc["open"]["stop"] + 1, F.struct(acc["done"].alias("done"), F.struct(acc["open"]["start"].alias("start"), F.greatest(acc["open"]["stop"], s["stop"]).alias("stop")).alias("open")))
        .otherwise(F.struct(F.concat(acc["done"], F.array(acc["open"])).alias("done"), s.alias("open"))),
        lambda acc: F.concat(acc["done"], F.array(acc["open"])),
    )
    return spans.select("doc_id", "version", merged.alias("runs"))


def dedup_lines(docs: DataFrame, min_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with repeated runs cut out of the text column, and n_lines, n_removed, n_runs after its columns (not among them)."""
    names = docs.columns
    id_, version, own, runs_, lines_, rest_ = (fresh(n, names) for n in ("run id", "run version", "own version", "runs", "lines", "rest"))
    runs = repeated_runs(docs, min_words, id_col, text_col).toDF(id_, version, runs_)
    held = docs.select(*[F.col(f"`{c}`") for c in names], F.xxhash64(F.col(f"`{text_col}`")).alias(own))
    both = held.join(runs, F.col(f"`{id_col}`").eqNullSafe(F.col(f"`{id_}`")) & (F.col(f"`{own}`") == F.col(f"`{version}`")), "left")
    lines = F.split(F.col(f"`{text_col}`"), "\n")
    gaps = F.transform(
        F.sequence(F.lit(0), F.size(runs_)),
        lambda j: F.struct(
            F.when(j == 0, 0).otherwise(F.get(F.col(runs_), j - 1)["stop"] + 1).alias("begin"),
            F.when(j == F.size(runs_), F.size(lines_)).otherwise(F.get(F.col(runs_), j)["start"]).alias("end"),
        ),
    )
    rest = F.array_join(F.flatten(F.transform(gaps, lambda g: F.slice(F.col(lines_), g["begin"] + 1, g["end"] - g["begin"]))), "\n")
    removed = F.aggregate(runs_, F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"] + 1)
    cut = both.withColumn(lines_, lines).withColumn(rest_, F.when(F.col(runs_).isNull(), F.col(f"`{text_col}`")).otherwise(rest))
    return cut.select(
        *[F.col(rest_).alias(c) if c == text_col else F.col(f"`{c}`") for c in names],
        F.coalesce(F.size(lines_), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(removed, F.lit(0).cast("long")).alias("n_removed"), F.greatest(F.size(runs_), F.lit(0)).cast("long").alias("n_runs"),
    )


def digest(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs and the SHA-256 of what is left of every row of docs."""
    return dedup_lines(docs.select("doc_id", "text"), min_words).select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
