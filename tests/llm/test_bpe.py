"""Byte-level encoding against the library that the vocabulary is made for, and round trips."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(open(PATH, encoding="ascii").read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(vocabulary, texts):
    out = []
    for ids, ends in vocabulary.encode(texts):
        out += [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    return out


def odd_texts():
    draw = random.Random(5)
    pools = [range(32, 127), range(0x80, 0x250), range(0x250, 0x2000), range(0x4E00, 0x9FFF), range(0x1F300, 0x1F700), (9, 10, 13, 28, 31, 32, 0x85, 0xA0, 0x2003, 0x3000)]
    made = ["".join(chr(draw.choice(draw.choice(pools))) for _ in range(draw.randrange(1, 120))) for _ in range(1500)]
    return ["", None, "a", "\n", "é" * 3000, "ab" * 2000, "x" * 5001, " " * 777, "<|endoftext|>", "it's we'll IT'S", "İıſ", *made]


def test_ids_are_those_of_the_library(vocabulary, library):
    texts = odd_texts()
    got = ids_of(vocabulary, texts)
    assert got == [library.encode_ordinary(t or "") for t in texts]
    assert [vocabulary.decode(ids) for ids in got] == [(t or "").encode() for t in texts]


def test_every_code_point_is_cut_as_the_library_does(vocabulary, library):
    for begin in range(0, 0x30000, 0x800):
        points = [c for c in range(begin, begin + 0x800) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{chr(c)}b 1{chr(c)}2 !{chr(c)}? {chr(c)}  {chr(c)}" for c in points)
        assert ids_of(vocabulary, [text])[0] == library.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_round_trip(vocabulary, texts):
    assert [vocabulary.decode(ids).decode() for ids in ids_of(vocabulary, texts)] == texts


def slow_merge(ranks, piece):
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts[:-1], parts[1:], strict=True)) if a + b in ranks]
        if not pairs:
            return tuple(ranks[p] for p in parts)
        _, k = min(pairs)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_merges_are_the_leftmost_of_least_rank(vocabulary):
    draw = random.Random(2)
    pieces = [bytes(draw.choice(b"aab ethn\xc3\xa9") for _ in range(draw.randrange(2, 70))) for _ in range(600)]
    assert vocabulary.merged(pieces) == [slow_merge(vocabulary.ids, p) for p in pieces]


def test_what_is_kept_is_bounded_and_changes_nothing(monkeypatch, vocabulary):
    texts = odd_texts()[:400]
    want = ids_of(vocabulary, texts)
    monkeypatch.setattr(bpe, "KEPT_PIECES", 50)
    monkeypatch.setattr(bpe, "TOGETHER", 300)
    assert ids_of(bpe.Vocabulary(open(PATH, encoding="ascii").read(), public_tokenizers.PATTERN), texts) == want


def test_a_vocabulary_without_some_bytes_is_an_error():
    with pytest.raises(ValueError, match="255 single bytes"):
        bpe.Vocabulary(base64.b64encode(b"a").decode() + " 0", public_tokenizers.PATTERN)


def test_frames(spark, library):
    texts = odd_texts()[:60]
    rows = [(k, t, k) for k, t in enumerate(texts)] + [(None, "twice", 0), (3, "twice", 1), (3, "twice", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, TOKEN_IDS int").repartition(3)
    got = {}
    for r in bpe.digest(docs, PATH, public_tokenizers.PATTERN).collect():
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_sha256, r.decoded_sha256))
    want = {}
    for doc_id, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        want.setdefault(doc_id, []).append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    tokens = bpe.encoded(docs, PATH, public_tokenizers.PATTERN)
    assert tokens.columns == ["doc_id", "text", "TOKEN_IDS", "token_ids_"]  # the name was taken
    back = bpe.decoded(tokens, PATH, public_tokenizers.PATTERN, "token_ids_").collect()
    assert len(back) == len(rows) and all(bytes(r.decoded).decode() == (r.text or "") and list(r.token_ids_) == library.encode_ordinary(r.text or "") for r in back)
    assert bpe.token_totals(tokens, "token_ids_").agg({"n": "sum"}).first()[0] == sum(len(r.token_ids_) for r in back)
    some = spark.createDataFrame([([],), (None,), ([72, None],)], "token_ids array<int>")
    assert [None if r.decoded is None else bytes(r.decoded) for r in bpe.decoded(some, PATH, public_tokenizers.PATTERN).collect()] == [b"", None, {v: k for k, v in library._mergeable_ranks.items()}[72]]
    assert bpe.digest(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_the_query_covers_all_documents(spark, sf_dir, library):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = queries.op13_byte_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
