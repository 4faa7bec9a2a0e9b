"""Secrets in texts, with multipart credential linking. DataFrame functions only.

Base spans (assign, access, hex) are reported wherever they stand. Weak candidates say little by themselves:

* ``identity``: a user, account or client name after its keyword,
* ``endpoint``: a URL with a host, or a host and port after their keyword,
* ``key``: a mixed run of 16 or more letters and digits, or 16 to 23 hexadecimal digits.

They are linked with other parts by an interval join: parts of a text are dealt to buckets of ``SCOPE`` code points
by their start and by their stop, a weak candidate meets those in the buckets of its scope, and two link if at most
``SCOPE`` code points lie between them, however long they are.
A weak candidate is reported if its links complement it: an identity or an endpoint needs a secret (assign, hex or key)
in its scope, and a key needs an access identifier or an identity there.

Edge cases: null texts are empty. Rows that repeat doc_id and text get the same spans each. In a text with very many parts
only those of neighbouring buckets meet; spans that are wholly inside a base span are not candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import durable, plain
from quillspark.llm.spans import count_of, listed, same_row, spans_of, with_matches

BASE, WEAK = ("assign", "access", "hex"), ("identity", "endpoint", "key")
KINDS = BASE + WEAK
#: Code points within which parts belong together.
SCOPE = 200

_WORD = r"(?i:password|passwd|secret|token|api_?key)"
ASSIGN = _WORD + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
_ASSIGN_VALUE = "^" + _WORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Possessive: a repeated group that may give back is matched by recursion, which a long host name would carry too deep.
IDENTITY = r"""(?i:\b(?:user(?:_?name)?|login|account|client_?id)\b)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9._@-]{3,}+"""
ENDPOINT = r"""(?i:\bhttps?://[a-z0-9.-]++(?::[0-9]{1,5})?|\b(?:host|endpoint|server)\b["']?\x20*+[:=]\x20*+["']?[a-z0-9-]++(?:\.[a-z0-9-]++)++(?::[0-9]{1,5})?)"""
KEY = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{16,}+"


def _mixed(found: Column) -> Column:
    """Digits together with both cases, or 16 to 23 hexadecimal digits with both kinds."""
    both = found.rlike("[0-9]") & found.rlike("[A-Z]") & found.rlike("[a-z]")
    return both | (found.rlike("^[0-9a-f]{16,23}$") & found.rlike("[0-9]") & found.rlike("[a-f]"))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, version, base and weak spans of every row of docs."""
    df = plain(docs, id_col, text_col).toDF("doc_id", "text").select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    df = df.withColumn("version", F.xxhash64("text"))
    text = F.col("text")
    df = with_matches(df, "assign", "text", ASSIGN, text.rlike(r"(?i:passw|secret|token|api_?key)"))
    df = with_matches(df, "access", "text", ACCESS, text.contains("AKIA"))
    df = with_matches(df, "hex", "text", HEX, text.rlike("[0-9a-f]{24}"))
    df = with_matches(df, "identity", "text", IDENTITY, text.rlike(r"(?i:user|login|account|client)"))
    df = with_matches(df, "endpoint", "text", ENDPOINT, text.rlike(r"(?i:https?://|host|endpoint|server)"))
    df = with_matches(df, "key", "text", KEY, text.rlike("[0-9]") & text.rlike(r"[A-Za-z0-9+/]{16}"))
    base = F.concat(spans_of("assign", "assign", lambda m: F.length(F.regexp_extract(m, _ASSIGN_VALUE, 1)) >= 6), spans_of("access", "access"), spans_of("hex", "hex"))
    return df.select("doc_id", "version", base.alias("base"), F.concat(spans_of("identity", "identity"), spans_of("endpoint", "endpoint"), spans_of("key", "key", _mixed)).alias("weak"))


def linked(parts: DataFrame) -> DataFrame:
    """doc_id, version, more: the weak spans that other parts in their scope complement."""
    rows = parts.where(F.size("weak") > 0).distinct()
    each = rows.select("doc_id", "version", F.explode(F.concat("base", "weak")).alias("s")).select("doc_id", "version", "s.*").distinct()
    touched = lambda low, high: F.explode(F.sequence(F.floor(low / SCOPE), F.floor(high / SCOPE)))
    # What lies wholly inside a base span is not a candidate. Base spans of a kind don't overlap, so a bucket holds few.
    around = each.where(F.col("kind").isin(*BASE)).select(*[F.col(c).alias(f"b_{c}") for c in ("doc_id", "version", "start", "stop")]).withColumn("b_bucket", touched(F.col("b_start"), F.col("b_stop")))
    inside = F.col("doc_id").eqNullSafe(F.col("b_doc_id")) & (F.col("version") == F.col("b_version")) & (F.floor(F.col("start") / SCOPE) == F.col("b_bucket"))
    free = each.where(F.col("kind").isin(*WEAK)).join(around, inside & F.expr("b_start <= start and b_stop >= stop"), "left_anti")
    each = durable(free.unionByName(each.where(F.col("kind").isin(*BASE))), "parts")
    # A candidate lies in every bucket that it touches, and its scope reaches the buckets beside them. What begins or ends there meets it.
    weak = each.where(F.col("kind").isin(*WEAK)).withColumn("bucket", touched(F.col("start") - SCOPE, F.col("stop") + SCOPE))
    other = each.select(F.col("doc_id").alias("o_id"), F.col("version").alias("o_version"), F.col("kind").alias("o_kind"), F.col("start").alias("o_start"), F.col("stop").alias("o_stop"))
    other = other.withColumn("o_bucket", F.explode(F.array_distinct(F.array(F.floor(F.col("o_start") / SCOPE), F.floor(F.col("o_stop") / SCOPE)))))
    near = weak.join(other, F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("version") == F.col("o_version")) & (F.col("bucket") == F.col("o_bucket")))
    near = near.where(f"o_start - stop <= {SCOPE} and start - o_stop <= {SCOPE} and (o_start >= stop or start >= o_stop)")
    secret = F.col("o_kind").isin("assign", "hex", "key")
    complement = F.when(F.col("kind") == "key", F.col("o_kind").isin("access", "identity")).otherwise(secret)
    spans = near.where(complement).select("doc_id", "version", F.struct("kind", "start", "stop").alias("s")).distinct()
    return spans.groupBy("doc_id", "version").agg(F.collect_list("s").alias("more"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans (base and linked weak ones) of every row of docs."""
    parts = durable(candidates(docs, id_col, text_col), "secrets")
    both = same_row(parts, durable(linked(parts), "linked"), "left")
    return both.select("doc_id", "base", F.concat("base", F.coalesce("more", F.array().cast("array<struct<kind:string,start:int,stop:int>>"))).alias("spans"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_spans of every row of docs."""
    counts = [count_of(F.col("base"), k).alias(f"n_{k}") for k in BASE]
    return find(docs).select("doc_id", *counts, F.sha2(listed(F.col("base"), KINDS), 256).alias("base_sha256"), listed(F.col("spans"), KINDS).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
