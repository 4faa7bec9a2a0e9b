"""Periodic runs against a scan of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from quillspark.llm import queries, tandem

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def scan(words, least=6, times=4):
    """Each period by itself: stretches in which words a period apart agree; the smallest period of a stretch stays."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, times * q):
                found.setdefault((start, i + q - start), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def periodic_texts(draw, many):
    for _ in range(many):
        words = []
        for _ in range(draw.randrange(0, 8)):
            words += [draw.choice("abcd"[: draw.randrange(1, 5)]) for _ in range(draw.randrange(1, 8))] * draw.randrange(1, 9)
        yield words


@pytest.mark.parametrize(("least", "times"), [(6, 4), (2, 2), (6, 2), (5, 3), (40, 4)])
def test_runs_are_those_of_a_scan(least, times):
    draw = random.Random(least * 10 + times)
    for _ in range(150):
        texts = list(periodic_texts(draw, draw.randrange(1, 7)))
        got = list(tandem._groups([" ".join(w).encode() for w in texts], [0] * len(texts), None, least, times))
        assert [runs for _, runs in got] == [scan(w, least, times) for w in texts]


def test_small_pieces_of_work_change_nothing(monkeypatch):
    texts = list(periodic_texts(random.Random(9), 60))
    monkeypatch.setattr(tandem, "TOGETHER", 50)
    monkeypatch.setattr(tandem, "LEAVES", 3)
    assert [r for _, r in tandem._groups([" ".join(w).encode() for w in texts], [0] * len(texts), None, 6, 4)] == [scan(w) for w in texts]


def test_keys_without_room_for_positions_are_ranked_too():
    keys = np.array([5, 1 << 61, 7, 5, 0])
    assert tandem._ranked(keys).tolist() == [1, 3, 2, 1, 0]


def test_a_long_text_of_one_word_and_a_long_period():
    words = [b"ha"] * 50_000
    assert next(tandem._groups([b" ".join(words)], [0], None, 6, 4))[1] == [(0, 50_000, 1)]
    block = [b"%d" % k for k in range(9000)]
    ((_, found),) = tandem._groups([b" ".join([b"x", *block * 4, block[0], b"y"])], [0], None, 6, 4)
    assert found == [(1, 36_001, 9000)]


def expected(doc_id, text):
    words = SPACE.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = scan(words)
    dropped = {k for s, length, q in found for k in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
    hashes = tuple(hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{length},{q}\n" for s, length, q in found), kept))
    return (len(found), *best, 1000 * best[1] // best[2] if found else None, *hashes)


def test_frames(spark):
    draw = random.Random(4)
    texts = [" ".join(w).replace("a", "é\x85à", draw.randrange(3)) for w in periodic_texts(draw, 80)]
    rows = [(k, draw.choice([" ", "\t\n", "\x0b\x0c\r"]).join(t.split(" ")), 1) for k, t in enumerate(texts)]
    rows += [(None, "a b " * 9, 1), (7, None, 1), (8, "", 1), (9, " \n ", 1), (10, "x y z " * 12, 1), (10, "x y z " * 12, 1), (11, "no break here " * 5, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, START int").repartition(3)
    columns = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: str(r)
    got = sorted(((r.doc_id, *(r[c] for c in columns)) for r in tandem.digest(docs).collect()), key=key)
    assert got == sorted(((d, *expected(d, t)) for d, t, _ in rows), key=key)
    listed = sorted((tuple(r) for r in tandem.runs(docs).collect()), key=key)
    assert listed == sorted(((d, *r) for d, t, _ in rows for r in scan(SPACE.findall(t or ""))), key=key)
    short = {r.doc_id: (r.text, r.n_dropped) for r in tandem.without_repeats(docs).collect()}
    assert short[10] == ("x y z", 33) and short[7] == ("", 0)
    assert tandem.digest(docs.limit(0)).count() == tandem.runs(docs.limit(0)).count() == 0


def test_the_query_covers_all_documents(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, sf_dir).collect()}
    assert got == {d: expected(d, t) for d, t in texts.items()}
