"""Token counts of the sections of documents, by offset-mapped attribution.

Whole documents are encoded once, so a count never depends on where a section is cut. Tokens of a byte-level
vocabulary are runs of the text's bytes; their lengths, summed up, are their spans. Spans of tokens and of sections are joined as
intervals, by binary search in the sorted ends: a section has the tokens wholly inside it, and at most one that crosses
each of its ends. A crossing token goes by an explicit rule:

* ``most`` (default): to the section that holds most of its bytes, the earlier one of equals;
* ``start``: to the section that holds its first byte.

``share`` gives, besides, each section the part of a crossing token that its bytes are. With either rule the counts of
sections that cover a text add up to its tokens, and so do the shares.

Sections are the lines, each with its line end, or spans given by the caller. Documents don't move: one pass, no shuffle.
Edge cases: null and empty texts have no sections; an empty section has no tokens; given sections may leave
gaps, whose tokens then count nowhere, and may overlap, in which case `most` and `start` give a token to one of them. Repeated rows count each for itself.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import held, plain

def _encoder(vocabulary: str, pattern: str) -> tuple:
    """The worker's encoder and the byte length of each token, kept between tasks."""

    def make() -> tuple:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, vocabulary.splitlines())}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        lengths[list(ranks.values())] = [len(t) for t in ranks]
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths

    return held(("offsets", hash((vocabulary, pattern))), make)


def attributed(ends: np.ndarray, start: np.ndarray, stop: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per section: tokens, tokens that cross its ends, share. ends: where each token ends; start, stop: of the sections. All in bytes."""
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    filled = stop > start
    low = np.searchsorted(ends, start, side="right")  # the first token that reaches into the section
    high = np.searchsorted(begins, stop, side="left")  # and past the last
    touched = np.where(filled, np.maximum(high - low, 0), 0)
    tokens, share = touched.astype(np.int64), touched.astype(float)
    edges = []
    for token, other in ((low, None), (high - 1, low)):
        ok = touched > 0
        if other is not None:
            ok &= token != other
        section = np.flatnonzero(ok)
        t = token[section]
        crosses = (begins[t] < start[section]) | (ends[t] > stop[section])
        edges.append((t[crosses], section[crosses]))
    t, section = (np.concatenate(x) for x in zip(*edges, strict=True))
    inside = np.minimum(ends[t], stop[section]) - np.maximum(begins[t], start[section])
    crossing = np.bincount(section, minlength=len(start))
    tokens = tokens - crossing
    np.add.at(share, section, inside / np.maximum(ends[t] - begins[t], 1) - 1)
    weight = inside if rule == "most" else (begins[t] >= start[section]).astype(np.int64)
    order = np.lexsort((section, start[section], -weight, t))
    t, section, weight = t[order], section[order], weight[order]
    first = np.concatenate([[True], t[1:] != t[:-1]]) if len(t) else np.empty(0, bool)
    np.add.at(tokens, section[first & (weight > 0)], 1)
    return tokens, crossing, share


def _line_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    breaks = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    bounds = np.unique(np.concatenate([[0], breaks, [len(text)]]))
    return bounds[:-1], bounds[1:]


def _counter(vocabulary, pattern: str, rule: str, given: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = _encoder(vocabulary.value, pattern)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                rows = batch.slice(begin, 256)
                of, parts = [], []
                for k, text in enumerate(rows.column(1).to_pylist()):
                    if not text:
                        continue
                    raw = text.encode()
                    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])  # code points before each byte
                    if given:
                        spans = rows.column(2)[k].as_py() or []
                        at = np.array([[s["start"], s["stop"]] for s in spans], np.int64).reshape(-1, 2)
                        start, stop = (_byte_of(points, x) for x in (at[:, 0], at[:, 1]))
                    else:
                        start, stop = _line_bounds(raw)
                    ends = np.cumsum(lengths[encoding.encode_ordinary(text)])
                    tokens, crossing, share = attributed(ends, start, stop, rule)
                    of.append(np.full(len(start), k))
                    parts.append((np.arange(len(start)), points[start], points[stop], tokens, crossing, share))
                row = pa.array(np.concatenate(of) if of else np.empty(0, np.int64), pa.int64())
                columns = [np.concatenate(x) for x in zip(*parts, strict=True)] or [np.empty(0)] * 6
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([rows.column(0).take(row), *(pa.array(c).cast(t) for c, t in zip(columns, kinds, strict=True))], names=["doc_id", "section", "start", "stop", "n_tokens", "n_crossing", "share"])

    return run


def _byte_of(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The byte at which the code points `at` begin."""
    first = np.flatnonzero(np.concatenate([np.diff(points) > 0, [True]]))
    return first[np.clip(at, 0, len(first) - 1)]


def section_tokens(docs: DataFrame, vocabulary_path: str, pattern: str, rule: str = "most", id_col: str = "doc_id", text_col: str = "text", sections_col: str | None = None) -> DataFrame:
    """doc_id, section (its number), start, stop (code points), n_tokens, n_crossing, share of each section of each row of docs.

    sections_col: a column array<struct<start, stop>> of code points; without it, the lines.
    """
    if rule not in ("most", "start"):
        raise ValueError("rule is most or start")
    vocabulary = docs.sparkSession.sparkContext.broadcast(Path(vocabulary_path).read_text(encoding="ascii"))  # a vocabulary file: about a MB
    rows = plain(docs, id_col, text_col, *([sections_col] if sections_col else [])).toDF("doc_id", "text", *(["sections"] if sections_col else []))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_counter(vocabulary, pattern, rule, sections_col is not None), f"doc_id {kind}, section int, start long, stop long, n_tokens long, n_crossing long, share double")


def document_tokens(sections: DataFrame) -> DataFrame:
    """doc_id, n_sections, n_tokens of the documents that have sections."""
    return sections.groupBy("doc_id").agg(F.count("*").alias("n_sections"), F.sum("n_tokens").alias("n_tokens"))
