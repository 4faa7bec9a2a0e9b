"""Best-fit packing of tokenised documents into fixed-length training sequences.

1. ``pieces`` tokenises whole documents (Arrow batches), ends each with an end token and cuts those
   longer than a sequence. A white-space delimited word always has the same tokens, so words are encoded once per
   worker and looked up after that; texts with a special token's string are encoded whole.
2. ``pack`` range-sorts the pieces by length, which gives each a rank among those of its length without
   gathering a length in one task: tasks count their share of each length, the counts are summed up in order.
3. Best fit runs in bulk-synchronous rounds, one per length from the longest: the gaps are kept sorted,
   a sweep from the length's successor upwards matches the round's pieces to gaps, conflicts are resolved
   by rank (the i-th piece takes the i-th place), the gaps are updated, and pieces without a gap open sequences.
   Pieces of one length, and sequences of one gap, are interchangeable, so both sorted lists are held as runs
   (size, first, count). There are at most `capacity` lengths and gaps however large the corpus, so a round
   matches runs with runs; the outcome is the same as matching the rows.
4. The rounds' matches, (length, ranks) -> (sequences, offset), are broadcast, and each task places its
   own pieces. Their number depends on the capacity C alone: a length adds at most three runs of sequences (what it opens, and two by
   splitting the last run it takes from), and a run that is matched whole keeps less than half of its gap, so it is matched log2(C) times
   at most. That makes 3 C (log2(C) + 1) + C matches at most, 76,000 of 48 bytes each for 2048 tokens.

Edge cases: null and empty texts are one piece with the end token only. Repeated rows are packed each for itself.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from operator import itemgetter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import durable, held, lean, plain, widened

CAPACITY, END_ID = 2048, 0
#: Words kept in each of a worker's two generations of cached encodings.
CACHED = 300_000
#: Words of these letters are one run of the tokenizer's pattern.
LATIN = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: Byte-level vocabularies write a byte as the character of its number if that is a visible one, and else as one from 256 on, in order.
BYTE_CHARACTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b))}
#: What may stand behind a word: symbols, but for the apostrophe, with which contractions begin.
SYMBOLS = b""".,;:!?#%&*$()[]{}"/\\+-=<>@^_`~|"""
#: Pieces of a partition of the range sort.
PARTITION_PIECES = 500_000


class Encoder(dict):
    """word (lower-case bytes without white space) -> its token ids, as little-endian uint32 bytes."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        self.before: dict[bytes, bytes] = {}
        self.wanted: list[bytes] = []

    def __missing__(self, word: bytes) -> None:
        self.wanted.append(word)

    def _fill(self) -> dict[bytes, bytes]:
        """Encodes the wanted words, all at once, and keeps and returns their ids."""
        if len(self) >= CACHED:
            self.before = dict(self)
            self.clear()
        ids, cut, new, before = {}, [], {}, self.before
        for word in dict.fromkeys(self.wanted):
            if word in before:
                ids[word] = before[word]
                continue
            stem = word.rstrip(SYMBOLS)
            # Symbols behind a letter are a token run of their own.
            if len(stem) < len(word) and stem and (97 <= stem[-1] <= 122 or self._letter(stem)):
                tail = word[len(stem) :]
                cut.append((word, stem, tail))
                for part in (stem, tail):
                    if part in self:
                        ids[part] = self[part]
                    elif part in before:
                        ids[part] = before[part]
                    else:
                        new[part] = None
            else:
                new[word] = None
        self.wanted.clear()
        rest = []
        for word in new:
            letters = word.decode() if word.isalpha() else self._letters(word)
            if letters:
                ids[word] = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
            else:
                rest.append(word)
        ids.update(zip(rest, self._each(rest), strict=True))
        for word, stem, tail in cut:
            ids[word] = ids[stem] + ids[tail]
        self.update(ids)
        return ids

    @staticmethod
    def _letters(word: bytes) -> str | None:
        """The form in which the vocabulary has a word that is one run of Latin letters, which no normalisation but lower case changes; else null."""
        text = word.decode("utf-8", "replace")
        return text.lower().encode().decode("latin-1").translate(BYTE_CHARACTERS) if LATIN.fullmatch(text) else None

    def _each(self, words: list[bytes]) -> Iterator[bytes]:
        """The ids of each word, by encoding many as one text and cutting it at the words' first characters."""
        for begin in range(0, len(words), 2000):
            texts = [w.decode("utf-8", "replace") for w in words[begin : begin + 2000]]
            encoding = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ids = np.array(encoding.ids, dtype="<u4").tobytes()
            starts = np.cumsum([0] + [len(t) + 1 for t in texts])
            cuts = 4 * np.searchsorted(np.fromiter(map(itemgetter(0), encoding.offsets), np.int64, len(ids) // 4), starts)
            yield from (ids[a:z] for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))

    @staticmethod
    def _letter(stem: bytes) -> bool:
        """Whether it ends in a letter that is one letter in lower case too. The capital dotted I becomes an i and a combining dot, which joins the symbols behind it."""
        last = stem[-4:].decode("utf-8", "ignore")[-1:]
        return bool(last) and last.isalpha() and ord(last) < 0x250 and len(last.lower()) == 1

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: bytes) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text. Unknown words are encoded together, after all texts have been looked up."""
        parts: list[list[bytes | None]] = []
        missing: list[tuple[list[bytes | None], int]] = []
        for text in texts:
            if b"<|" in text:
                parts.append([self.whole(text.decode("utf-8", "replace"))])
                continue
            known = len(self.wanted)
            found = list(map(self.__getitem__, text.lower().split()))
            at = -1
            for _ in range(len(self.wanted) - known):
                at = found.index(None, at + 1)
                missing.append((found, at))
            parts.append(found)
        if missing:
            words = self.wanted[:]
            ids = self._fill()
            for (found, at), word in zip(missing, words, strict=True):
                found[at] = ids[word]
        return list(map(b"".join, parts))


def encoder(tokenizer_json: str) -> Encoder:
    """The worker's encoder, kept between tasks."""
    return held(("encoder", hash(tokenizer_json)), lambda: Encoder(tokenizer_json))


def _cutter(tokenizer, capacity: int, end_id: int, with_ids: bool):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                of, piece, start, length, crc, ids = [], [], [], [], [], []
                for k, tokens in enumerate(enc.encode_all([t or b"" for t in part.column(1).to_pylist()])):
                    tokens += end
                    total = len(tokens) // 4
                    for i, at in enumerate(range(0, total, capacity)):
                        chunk = tokens[4 * at : 4 * (at + capacity)]
                        of.append(k)
                        piece.append(i)
                        start.append(at)
                        length.append(len(chunk) // 4)
                        crc.append(zlib.crc32(chunk))
                        if with_ids:
                            ids.append(np.frombuffer(chunk, "<u4").astype(np.int32))
                columns = [part.column(0).take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, names=names + ["ids"] * with_ids)

    return run


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every row of docs."""
    tokenizer = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))  # a vocabulary file: a few MB
    texts = plain(docs, id_col, text_col).toDF("doc_id", "text").withColumn("text", F.col("text").cast("binary"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(lean(_cutter(tokenizer, capacity, end_id, with_ids)), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def best_fit(lengths: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Matches (length, rank, per, sequence, offset, until) and the number of sequences.

    The piece of rank r, rank <= r < until, among those of its length goes to sequence + (r - rank) // per, at
    offset + (r - rank) % per * length.
    """
    gaps: list[int] = []  # sorted
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, count)
    matches, sequences = [], 0

    def free(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in runs:
                insort(gaps, gap)
            runs.setdefault(gap, []).append((first, count))

    for length in sorted(lengths, reverse=True):
        rank, left = 0, lengths[length]
        while left:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, count = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], gaps[at]
            else:
                gap, first = capacity, sequences
                count = -(-left // (capacity // length))
                sequences += count
            per = gap // length
            taken = min(left, per * count)
            matches.append((length, rank, per, first, capacity - gap, rank + taken))
            full, over = divmod(taken, per)
            free(gap - per * length, first, full)
            if over:
                free(gap - over * length, first + full, 1)
            free(gap, first + full + (over > 0), count - full - (over > 0))
            rank, left = rank + taken, left - taken
    return np.array(sorted(matches), dtype=np.int64).reshape(-1, 6), sequences


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task's number and each piece's rank among the task's pieces of its length."""
    task, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        length = batch.column("length").to_numpy()
        rank = np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        values, begin, counts = np.unique(length[order], return_index=True, return_counts=True)
        rank[order] = np.arange(len(length)) - np.repeat(begin, counts)
        rank += np.array([seen.get(v, 0) for v in values.tolist()], np.int64)[np.searchsorted(values, length)] if len(values) else 0
        for v, c in zip(values.tolist(), counts.tolist(), strict=True):
            seen[v] = seen.get(v, 0) + c
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), task, np.int64)), pa.array(rank)], names=[*batch.schema.names, "task", "task_rank"])


def _placer(matches, before):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, earlier = matches.value, before.value
        key = plan[:, 0] << 42 | plan[:, 1]
        for batch in batches:
            length, task = batch.column("length").to_numpy(), batch.column("task").to_numpy()
            pairs, inverse = np.unique(np.stack([task, length], 1), axis=0, return_inverse=True)
            base = np.array([earlier[t, n] for t, n in pairs.tolist()], np.int64)
            rank = batch.column("task_rank").to_numpy() + base[inverse.ravel()] if len(base) else np.empty(0, np.int64)
            m = plan[np.searchsorted(key, length << 42 | rank, side="right") - 1]
            inner = rank - m[:, 1]
            keep = [c for c in batch.schema.names if c not in ("task", "task_rank")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(m[:, 3] + inner // m[:, 2]), pa.array(m[:, 4] + inner % m[:, 2] * length)], names=[*keep, "sequence_id", "offset"])

    return run


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """rows (with doc_id, piece and length, 1 to capacity) with sequence_id and offset added."""
    context = rows.sparkSession.sparkContext
    rows = durable(rows, "pieces")
    parts = max(1, -(-rows.rows // PARTITION_PIECES), min(context.defaultParallelism, 64))
    by_length = rows.repartitionByRange(parts, F.col("length").desc(), F.col("doc_id"), F.col("piece"))
    ranked = durable(by_length.mapInArrow(_ranked, widened(rows, task="long", task_rank="long")), "ranked")
    before, lengths = {}, {}
    # Sorted by range: at most one row a task and length, and each task has its own few lengths.
    for task, length, n in ranked.groupBy("task", "length").count().orderBy("task", "length").toLocalIterator():
        before[task, length] = lengths.get(length, 0)
        lengths[length] = before[task, length] + n
    matches, _ = best_fit(lengths, capacity)
    return ranked.mapInArrow(_placer(context.broadcast(matches), context.broadcast(before)), widened(rows, sequence_id="long", offset="long"))


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id, ids: the packed token ids (of pieces made with_ids), at most `capacity` a row."""
    listed = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return listed.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))


def digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return pack(pieces(docs, tokenizer_path))
