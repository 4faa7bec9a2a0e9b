"""Byte-level byte-pair encoding and decoding, with a segment tree over byte positions.

A text is cut by the vocabulary's pattern, and each match is encoded by itself: as one token, if the vocabulary has it,
else from its bytes. The pair of neighbours of least rank, the leftmost of equals, is merged until no pair of neighbours is a token.

The leaves of a segment tree hold, for the byte position at which a live token starts, the rank of the pair that it makes with its right
neighbour; a leaf's key is (rank, position), so the least key of a node is the leftmost of its least pairs, and the
root holds the next merge. A merge changes three leaves (the pair itself, the pair before it, and the right
token's, which dies) and the nodes above them; live neighbours are linked in both directions. So a match of n bytes takes O(n log n).

Matches of up to the same power of two bytes share a forest: their trees are columns of one array, and each round performs
the next merge in all of them. Merges of a match still follow one another in their own order. What matches encode to is kept by
a worker for matches that come again, up to a bound.

Documents don't move: one pass, no shuffle. Edge cases: null is encoded as the empty text, which has no tokens; special tokens
are not known, so their strings are ordinary text; repeated rows count each for itself; ids that the vocabulary lacks can't be decoded, an
error; a null array of ids decodes to null, a null id to no bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from quillspark.llm.common import fresh, held, lean, plain, widened

#: Matches whose tokens a worker keeps, their characters, and characters of texts that are encoded together.
KEPT_PIECES, KEPT_CHARS, TOGETHER = 500_000, 20_000_000, 2_000_000
#: Leaves of the trees that are merged at once.
FOREST = 1 << 15
#: The key of a leaf without a pair.
NONE = np.iinfo(np.int64).max


class _Kept(dict):
    """piece -> its number; tokens() gives what numbered pieces encode to. New pieces get their numbers first, and their tokens, all together, by add()."""

    def __init__(self) -> None:
        self.new: list[str] = []
        self.chars = 0
        self.flat, self.starts = np.empty(0, np.int32), np.zeros(1, np.int64)

    def __missing__(self, piece: str) -> int:
        k = self[piece] = len(self)
        self.new.append(piece)
        return k

    def is_full(self) -> bool:
        return len(self) > KEPT_PIECES or self.chars > KEPT_CHARS

    def add(self, tokens: list[tuple[int, ...]]) -> None:
        self.chars += sum(map(len, self.new))
        self.new = []
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(tokens), np.int32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))])

    def tokens(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all pieces, and where those of each end."""
        start = self.starts[codes]
        many = self.starts[codes + 1] - start
        ends = np.cumsum(many)
        return self.flat[np.repeat(start - ends + many, many) + np.arange(ends[-1] if len(ends) else 0)], ends


def _ranges(points: list[int]) -> str:
    """The points as the inside of a character class."""
    at = np.array(sorted(points))
    first, last = at[np.diff(at, prepend=-2) > 1], at[np.diff(at, append=at[-1] + 2 if len(at) else 0) > 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first.tolist(), last.tolist(), strict=True))


def cutter(pattern: str) -> Callable[[str], list[str]]:
    """Cuts a text into the matches of the pattern, with letters, numbers and spaces as the vocabulary's library knows them.

    The library that matches here may follow a later version of Unicode. Where the two disagree on a character that a text has, the text is
    cut with \\p{L}, \\p{N}, \\s and \\S spelt out.
    """
    import regex
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    inside, odd = {}, set()
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        seen = tiktoken.Encoding("own", pat_str=name, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        theirs = set(bytes(seen.encode_ordinary(every)).decode())  # what a pattern doesn't match is left out
        inside[name] = _ranges([ord(c) for c in theirs])
        odd |= theirs ^ set(regex.findall(name, every))
    fast = regex.compile(pattern).findall
    if not odd:
        return fast

    def spelt(part: re.Match) -> str:
        if part[1]:  # a class in brackets
            return re.sub(r"\\p\{[LN]\}|\\s|\\.", lambda m: inside.get(m[0], m[0]), part[1])
        return f"[^{inside[chr(92) + 's']}]" if part[0] == r"\S" else f"[{inside[part[0]]}]" if part[0] in inside else part[0]

    exact = regex.compile(re.sub(r"(\[(?:\\.|[^\]\\])*\])|\\p\{[LN]\}|\\.", spelt, pattern)).findall
    differs = re.compile(f"[{_ranges([ord(c) for c in odd])}]").search
    return lambda text: exact(text) if not text.isascii() and differs(text) else fast(text)


class Vocabulary:
    """Ranks of byte strings, which are their token ids too, and the pattern that cuts texts."""

    def __init__(self, lines: str, pattern: str) -> None:
        self.ids = {base64.b64decode(a): int(b) for a, b in map(str.split, lines.splitlines())}
        self.cut = cutter(pattern)
        self.bytes = dict(zip(self.ids.values(), self.ids, strict=True))
        #: By token id: its bytes and its decimal digits.
        self.table = pa.array([self.bytes.get(i) for i in range(max(self.bytes) + 1)], pa.binary())
        self.digits = pa.array(map(str, range(len(self.table))), pa.string())
        lacking = [b for b in range(256) if bytes([b]) not in self.ids]
        if lacking:
            raise ValueError(f"the vocabulary has no token for {len(lacking)} single bytes")
        self.of_byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        made = [(self.ids[t[:k]], self.ids[t[k:]], i) for t, i in self.ids.items() for k in range(1, len(t)) if t[:k] in self.ids and t[k:] in self.ids]
        left, right, rank = (np.array(x, np.int64) for x in zip(*made, strict=True)) if made else [np.empty(0, np.int64)] * 3
        order = np.argsort(left << 32 | right)
        #: The pairs of tokens that are tokens together, sorted, and those tokens; a last pair that no one asks for.
        self.pairs, self.joined = np.append((left << 32 | right)[order], NONE), np.append(rank[order], -1)
        self.kept = _Kept()

    def pair_keys(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, shift: int) -> np.ndarray:
        """The keys of leaves at positions `at` for pairs of neighbours."""
        pair = left << 32 | right
        k = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[k] == pair, self.joined[k] << shift | at, NONE)

    def merged(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The token ids of each piece. Pieces have 2 bytes or more."""
        width = np.array([len(p) for p in pieces], np.int64)
        shifts = np.ceil(np.log2(width)).astype(np.int64)
        out: list = [None] * len(pieces)
        for shift in np.unique(shifts).tolist():
            own, many = np.flatnonzero(shifts == shift), max(1, FOREST >> shift)
            for begin in range(0, len(own), many):
                some = own[begin : begin + many]
                for k, tokens in zip(some.tolist(), self._forest([pieces[k] for k in some.tolist()], width[some], shift), strict=True):
                    out[k] = tokens
        return out

    def _forest(self, pieces: list[bytes], width: np.ndarray, shift: int) -> list[tuple[int, ...]]:
        """One tree of 2**shift leaves a piece; node k of the tree of piece p is at tree[k, p], and its children are 2k and 2k + 1."""
        leaves, trees = 1 << shift, len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), np.uint8).reshape(trees, leaves).T
        token = self.of_byte[raw]
        places = np.arange(leaves)[:, None]
        after, before = np.repeat(places + 1, trees, 1), np.repeat(places - 1, trees, 1)
        live = places < width
        tree = np.full((2 * leaves, trees), NONE, np.int64)
        paired = places[:-1] + 1 < width
        tree[leaves : 2 * leaves - 1] = np.where(paired, self.pair_keys(token[:-1], token[1:], places[:-1], shift), NONE)
        for level in range(shift - 1, -1, -1):
            nodes = tree[2 << level : 4 << level]
            tree[1 << level : 2 << level] = np.minimum(nodes[0::2], nodes[1::2])
        # from here on, tree, token, after and before are flat: what belongs to place or node k of piece p stands at k * trees + p
        shape = token.shape
        tree, token, after, before, live = (x.ravel() for x in (tree, token, after, before, live))
        active = np.flatnonzero(tree[trees : 2 * trees] != NONE)
        while len(active):
            key = tree[trees + active]
            at = key & (leaves - 1)
            here = at * trees + active
            gone = after[here] * trees + active
            end = after[gone]
            new = key >> shift
            token[here] = new
            live[gone] = False
            after[here] = end
            leaf = leaves * trees
            tree[leaf + gone] = NONE
            more = end < width[active]
            right = np.where(more, end * trees + active, here)
            before[right[more]] = at[more]
            tree[leaf + here] = np.where(more, self.pair_keys(new, token[right], at, shift), NONE)
            ahead = before[here]
            has = np.flatnonzero(ahead >= 0)
            left, ahead = (ahead * trees + active)[has], ahead[has]
            tree[leaf + left] = self.pair_keys(token[left], new[has], ahead, shift)
            of = np.concatenate([active, active, active[has]])
            node = (np.concatenate([gone, here, left]) - of) // trees + leaves
            for _ in range(shift):
                node >>= 1
                low = 2 * node * trees + of
                tree[node * trees + of] = np.minimum(tree[low], tree[low + trees])
            active = active[tree[trees + active] != NONE]
        token, live = token.reshape(shape), live.reshape(shape)
        flat = token.T[live.T].tolist()
        ends = np.cumsum(live.sum(0)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def encode(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For consecutive texts together: the token ids of all, and where those of each end."""
        group, size = [], 0
        for text in texts:
            group.append(self.cut(text or ""))
            size += len(text or "")
            if size > TOGETHER:
                yield self._encode_cut(group)
                group, size = [], 0
        if group:
            yield self._encode_cut(group)

    def _encode_cut(self, group: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        if self.kept.is_full():
            self.kept = _Kept()
        many = np.fromiter(map(len, group), np.int64, len(group))
        codes = np.fromiter(map(self.kept.__getitem__, chain.from_iterable(group)), np.int64, int(many.sum()))
        if self.kept.new:
            self.kept.add(self._tokens(self.kept.new))
        ids, ends = self.kept.tokens(codes)
        return ids, np.concatenate([[0], ends])[np.cumsum(many)]

    def _tokens(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """The tokens of each piece."""
        raw = [p.encode() for p in pieces]
        whole = [self.ids.get(b) for b in raw]
        merged = iter(self.merged([b for b, i in zip(raw, whole, strict=True) if i is None]))
        return [next(merged) if i is None else (i,) for i in whole]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode_all(self, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The bytes that all ids stand for, and where those of each end."""
        taken = self.table.take(pa.array(ids))
        ends = np.frombuffer(taken.buffers()[1], np.int32, len(taken) + 1)[1:]
        return memoryview(taken.buffers()[2] or b""), ends

    def spelt(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The decimal ids of each text, joined by commas."""
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), self.digits.take(pa.array(ids)))
        return pc.binary_join(lists, ",").to_pylist()


def _vocabulary(lines: Broadcast, pattern: str) -> Vocabulary:
    return held(("byte pairs", hash((lines.value, pattern))), lambda: Vocabulary(lines.value, pattern))


def _lines(df: DataFrame, path: str) -> Broadcast:
    return df.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="ascii"))  # a vocabulary file: about a MB


def encoded(docs: DataFrame, vocabulary_path: str, pattern: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """docs with an array<int> of the token ids of each text."""
    lines, name = _lines(docs, vocabulary_path), fresh(ids_col, docs.columns)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(lines, pattern)
        for batch in batches:
            parts = list(vocabulary.encode(batch.column(at).to_pylist()))
            sizes = np.concatenate([np.diff(ends, prepend=0) for _, ends in parts] or [np.empty(0, np.int64)])
            every = pa.array(np.concatenate([ids for ids, _ in parts] or [np.empty(0, np.int32)]), pa.int32())
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), every)
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, name])

    return docs.mapInArrow(lean(run), widened(docs, **{name: ArrayType(IntegerType())}))


def decoded(tokens: DataFrame, vocabulary_path: str, pattern: str, ids_col: str = "token_ids", bytes_col: str = "decoded") -> DataFrame:
    """tokens with the bytes (binary) that each array of ids stands for."""
    lines, name = _lines(tokens, vocabulary_path), fresh(bytes_col, tokens.columns)
    at = tokens.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(lines, pattern)
        for batch in batches:
            raw = [None if ids is None else vocabulary.decode(i for i in ids if i is not None) for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=[*batch.schema.names, name])

    return tokens.mapInArrow(lean(run), widened(tokens, **{name: "binary"}))


def digest(docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: of the ids of each text, and of the bytes that they are decoded to."""
    lines = _lines(docs, vocabulary_path)
    rows = plain(docs, id_col, text_col).toDF("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(lines, pattern)
        for batch in batches:
            n, of_ids, of_bytes = [], [], []
            for ids, ends in vocabulary.encode(batch.column(1).to_pylist()):
                raw, stops = vocabulary.decode_all(ids)
                stops = np.concatenate([[0], stops])[np.concatenate([[0], ends])].tolist()
                n += np.diff(ends, prepend=0).tolist()
                of_ids += [hashlib.sha256(text.encode()).hexdigest() for text in vocabulary.spelt(ids, ends)]
                of_bytes += [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(stops[:-1], stops[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(lean(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def token_totals(tokens: DataFrame, ids_col: str = "token_ids") -> DataFrame:
    """token_id, n: how often each token occurs in all rows of tokens."""
    return tokens.select(F.explode(ids_col).alias("token_id")).groupBy("token_id").agg(F.count("*").alias("n"))
