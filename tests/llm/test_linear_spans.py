"""Work on the spans of one text grows in proportion to them, and contexts are those of the text; word encodings at every letter."""

import random
import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quillspark.llm import packing, pii, secrets_scan
from quillspark.llm.spans import before, with_matches

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def test_sums_before_each_element(spark):
    draw = random.Random(1)
    rows = [[draw.randrange(9) for _ in range(n)] for n in (0, 1, 255, 256, 257, 1000, 70_000)]
    got = spark.createDataFrame([(r,) for r in rows], "v array<int>").select(before(F.col("v")).alias("s")).collect()
    for row, r in zip(rows, got, strict=True):
        assert r.s == _running(row)


def _running(row):
    out, total = [], 0
    for x in row:
        out.append(total)
        total += x
    return out


def seconds(run):
    began = time.time()
    run()
    return time.time() - began


@pytest.mark.parametrize(("op", "many"), [(secrets_scan, 200_000), (pii, 50_000)])
def test_very_many_matches_in_one_text(spark, op, many):
    """Twice the matches take about twice the time, not four times."""
    if op is pii:
        pii.trained(spark)
        unit, column = "a@b.de 4.4. 4 .4 ", "n_email"
    else:
        unit, column = "token=abcdef ", "n_assign"
    took = {}
    for n in (1000, many // 2, many):
        df = spark.createDataFrame([(1, unit * n)], "doc_id long, text string")
        took[n] = seconds(lambda df=df, n=n: _same(op.digest(df).first()[column], n))
    assert took[many] < 3.2 * took[many // 2] + 2, took


def _same(got, want):
    assert got == want


def test_contexts_are_cut_from_the_text(spark):
    draw = random.Random(2)
    words = ["call", "030 1234 5678", "(274) 274-2744", "é🙂", "x", "1.2 .3.4", "4444/4444/4444/4444", "me (at) post (dot) de"]
    texts = ["", "030 1234 5678", *(" ".join(draw.choice(words) for _ in range(draw.randrange(1, 900))) for _ in range(12))]
    parts = pii.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("version", F.lit(1)))
    n = 0
    for r in parts.collect():
        text = texts[r.doc_id]
        for c in r.loose:
            n += 1
            assert c.found == text[c.start : c.stop]
            assert (c.left, c.right) == (text[max(0, c.start - pii.CONTEXT) : c.start].lower(), text[c.stop : c.stop + 4])
    assert n > 1000


def test_matches_have_their_places(spark):
    draw = random.Random(3)
    text = "".join(draw.choice("ab🙂 é") for _ in range(5000))
    r = with_matches(spark.createDataFrame([(text,)], "text string"), "m", "text", "a+b?", F.lit(True)).first()
    assert r.m and all(text[m.start : m.stop] == m.found for m in r.m)


def test_word_ids_at_every_letter_and_symbol():
    """Each letter below U+0250 before each symbol is encoded as in the whole text."""
    enc = packing.Encoder(open(WORD_BPE, encoding="utf-8").read())
    letters = [chr(c) for c in range(0x21, 0x250) if chr(c).isalpha()]
    for symbol in packing.SYMBOLS.decode():
        for tail in (symbol, symbol + symbol, symbol + "x", symbol + "к"):
            texts = [f"{a}{tail} q{a}{tail}{symbol} c" for a in letters]
            assert [enc.encode(t.encode()) for t in texts] == [enc.whole(t) for t in texts], tail


def test_random_texts_are_encoded_as_a_whole():
    draw = random.Random(4)
    enc = packing.Encoder(open(WORD_BPE, encoding="utf-8").read())
    pool = [*map(chr, range(0x21, 0x250)), *"İİıßΣкщ'’ \n \t<|%🙂", *packing.SYMBOLS.decode() * 3]
    for _ in range(6000):
        text = "".join(draw.choice(pool) for _ in range(draw.randrange(1, 14)))
        assert enc.encode(text.encode()) == enc.whole(text), text
