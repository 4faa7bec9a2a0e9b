"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding maps every code point to one code point, so positions stay those of the text: letters
are lower-cased and lose their accents, look-alike letters of other scripts become Latin ones, digits
that stand in for letters become them, ``l`` and ``1`` fall together with ``i``, and everything else is a space.

Learning (``learn``) takes a sample of the labelled rows, bounded by ``TRAIN_TOXIC`` and ``TRAIN_CLEAN``,
the rows of least hash of each class; their texts bound all that is learnt, and the lexicon has no other limit.
Near copies share one weight: a text counts by 1 / n among the n of its class with the same smallest shingle hash, so
none is dropped and a family of copies can't make its words look toxic.
Terms are whole words and word stems (a word's first 4 to 8 letters); a term enters the lexicon if
its share of toxic texts passes a binomial test over all candidates, with its log-odds as weight.
Exception phrases are pairs of words around a lexicon term that the clean texts hold at least as often.
A two-feature logistic curve turns the weight found, plain and by length, into a score.

Scoring (``score``) is one pass over whole texts, without a shuffle.

Edge cases: null and empty texts have no hits and get the score of such texts (below 0.5 unless most
of the sample is toxic). Without labelled rows of both classes the lexicon is empty and every score is 0.
A null doc_id is scored and never used for learning. doc_id may be of any type; of the rows that repeat one, one is learnt from.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import WordHashes, durable, fresh, join_counted, lean, let_go, plain, widened, word_shingles

#: The most labelled rows of each class that are learnt from.
TRAIN_TOXIC, TRAIN_CLEAN = 10_000, 20_000
STEMS = range(4, 9)
#: Least log-odds of a lexicon term, and the chance allowed for any false term.
LEAST_WEIGHT, FALSE_TERMS, LEAST_TEXTS = 1.2, 0.05, 4
#: By how much a longer stem or word must be surer to stand beside, or replace, a shorter stem.
SURER = 1.0

# Look-alikes of Latin letters in the Greek and Cyrillic scripts, and digits read as letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ӏ": "i", "ո": "n", "ս": "u", "α": "a", "β": "b", "ε": "e",
    "η": "n", "ι": "i", "κ": "k", "μ": "m", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i",
    "ß": "s", "ø": "o", "æ": "e", "œ": "e", "đ": "d", "ł": "i",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}


class _Folds(dict):
    """code point -> code point, filled on demand."""

    def __missing__(self, point: int) -> int:
        c = unicodedata.normalize("NFKD", chr(point))[0].lower()[0]
        c = LOOKALIKES.get(c, DIGITS.get(c, c))
        c = "i" if c == "l" else c if c.isalnum() else " "
        self[point] = ord(c)
        return self[point]


_FOLDS = _Folds()
_ASCII = bytes(_FOLDS[i] for i in range(128)) + bytes(range(128, 256))


def fold(text: str) -> str:
    """The folded text, of the same length."""
    return text.encode().translate(_ASCII).decode() if text.isascii() else text.translate(_FOLDS)


@dataclass
class Lexicon:
    """Weights by term; stems end in `*`. Exceptions are phrases of folded words that void hits inside them."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] | None = None

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            pattern = f" {term[:-1]}" if term.endswith("*") else f" {term} "
            found.add_word(pattern, (weight, len(pattern)))
        for phrase in self.exceptions:
            pattern = f" {phrase} "
            found.add_word(pattern, (None, len(pattern)))
        found.make_automaton()
        return found


def weigh(folded: str, automaton: ahocorasick.Automaton) -> tuple[float, float]:
    """Over the hit words outside exception phrases, each with its largest weight: sum over distinct words, sum over all."""
    if not len(automaton):
        return 0.0, 0.0
    padded = f" {folded} "
    best: dict[int, float] = {}
    void: list[tuple[int, int]] = []
    for end, (weight, length) in automaton.iter(padded):
        at = end - length + 1
        if weight is None:
            void.append((at, end))
        elif weight > best.get(at, 0.0):
            best[at] = weight
    if void:
        begins, reach = [a for a, _ in sorted(void)], list(accumulate((b for _, b in sorted(void)), max))
        best = {at: w for at, w in best.items() if not ((k := bisect_right(begins, at)) and at < reach[k - 1])}
    words = {padded[at + 1 : padded.index(" ", at + 1)]: w for at, w in best.items()}
    return sum(words.values()), sum(best.values())


def terms(folded: str) -> set[str]:
    words = set(folded.split())
    return words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) >= k}


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the smallest shingle hash of each text."""
    let_go()
    cache = WordHashes()
    for batch in batches:
        keys = [int(h.min() >> np.uint64(1)) if len(h := word_shingles(cache.of((t or "").lower().encode().split()), 4)) else 0 for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=["doc_id", "text", "toxic", "copy_key"])


def _weighted(seen: dict[tuple[int, float], Counter]) -> pa.RecordBatch:
    """term, toxic, clean of counts by label and weight; a term may have several rows."""
    names: list[str] = []
    sides: tuple[list[float], list[float]] = ([], [])
    for (label, weight), found in seen.items():
        names += found
        sides[label].extend(weight * n for n in found.values())
        sides[1 - label].extend([0.0] * len(found))
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sides[1], pa.float64()), pa.array(sides[0], pa.float64())], names=["term", "toxic", "clean"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for batch in batches:
        for begin in range(0, batch.num_rows, 1000):
            seen: dict[tuple[int, float], Counter] = {}
            for text, label, weight in zip(*(c.to_pylist() for c in batch.slice(begin, 1000).columns), strict=True):
                seen.setdefault((label, weight), Counter()).update(terms(fold(text or "")))
            yield _weighted(seen)


def _phrases(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[int, float], Counter] = {}
            for text, label, weight in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = fold(text or "").split()
                hits = [i for i, w in enumerate(words) if w in lexicon.weights or any(f"{w[:k]}*" in lexicon.weights for k in STEMS)]
                seen.setdefault((label, weight), Counter()).update({f"{words[i]} {words[i + 1]}" for j in hits for i in (j - 1, j) if 0 <= i < len(words) - 1})
            yield _weighted(seen)

    return run


def _features(distinct: float, total: float, n_words: int) -> tuple[float, float]:
    """Evidence by distinct words, and all of it for its share of the length."""
    return distinct, math.log1p(100.0 * total / max(n_words, 1))


def _weigher(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [_features(*weigh(f, automaton), len(f.split())) for t in batch.column(0).to_pylist() for f in (fold(t or ""),)]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64()), *batch.columns[1:]], names=["words", "share", "toxic", "weight"])

    return run


def binomial_tail(hits: float, n: float, share: float) -> float:
    """log P(X >= hits), X binomial: the Chernoff bound."""
    p = hits / n
    if p <= share:
        return 0.0
    return -n * (p * math.log(p / share) + ((1 - p) * math.log((1 - p) / (1 - share)) if p < 1 else 0.0))


def _sure(counted: DataFrame, toxic: float, clean: float, candidates: int) -> DataFrame:
    """The terms that pass the test, which _chosen repeats: only these go to the driver."""
    share, t, n = toxic / (toxic + clean), F.col("toxic"), F.col("toxic") + F.col("clean")
    weight = F.log((t + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    p = t / n
    tail = -n * (p * F.log(p / share) + F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - share))).otherwise(0.0))
    return counted.where((p > share) & (weight >= LEAST_WEIGHT - 1e-9) & (tail <= math.log(FALSE_TERMS / max(candidates, 1)) + 1e-9))


def _chosen(counts: list[tuple[str, float, float]], toxic: float, clean: float, candidates: int) -> dict[str, float]:
    share, limit = toxic / (toxic + clean), math.log(FALSE_TERMS / max(candidates, 1))
    weight = lambda t, c: math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
    sure = lambda t, c: t > 0 and weight(t, c) >= LEAST_WEIGHT and binomial_tail(t, t + c, share) <= limit
    found = {term: (weight(t, c), t, c) for term, t, c in counts if sure(t, c)}
    # A stem that is only found because of a surer longer one goes.
    names = sorted(found)
    for term in sorted(found, key=len):
        if term.endswith("*"):
            w, t, c = found[term]
            same = names[bisect_left(names, term[:-1]) : bisect_left(names, term[:-1] + chr(0x10FFFF))]
            longer = [found[name] for name in same if name != term and name in found and found[name][0] >= w + SURER]
            if longer:
                top = max(longer, key=lambda x: x[1])
                if not sure(t - top[1], max(c - top[2], 0)):
                    del found[term]
    # A stem stands for its longer stems and words unless those are surer.
    kept: dict[str, float] = {}
    for term in sorted(found, key=lambda t: (len(t.rstrip("*")), not t.endswith("*"), t)):
        shorter = [kept[s] for k in STEMS if (s := f"{term[:k]}*") in kept and k <= len(term.rstrip("*")) and s != term]
        if not shorter or found[term][0] > max(shorter) + SURER:
            kept[term] = found[term][0]
    return kept


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Weighted ridge logistic fit by Newton steps, with slopes of at least 0."""
    a = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(3)
    ridge = np.diag([1e-6, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + ridge, a.T @ (weight * (y - p)) - ridge @ b)
        b = b + step
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), max(float(b[1]), 0.0), max(float(b[2]), 0.0)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic") -> Lexicon:
    """A lexicon from labelled texts. labels: the rows that may be learnt from."""
    known = plain(labels, id_col, toxic_col).toDF("doc_id", "toxic").where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    bounded = known.where("toxic = 1").orderBy(*order).limit(TRAIN_TOXIC).unionByName(known.where("toxic = 0").orderBy(*order).limit(TRAIN_CLEAN))
    texts = plain(docs, id_col, text_col).toDF("doc_id", "text").join(F.broadcast(bounded), "doc_id")  # at most TRAIN_TOXIC + TRAIN_CLEAN pairs of numbers
    keyed = texts.select("doc_id", "text", "toxic").mapInArrow(_copies, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, text string, toxic int, copy_key long")
    keyed = durable(keyed.groupBy("doc_id", "toxic").agg(F.min(F.struct("copy_key", "text")).alias("one")).select("toxic", "one.*"), "labelled")
    groups = keyed.groupBy("copy_key", "toxic").agg(F.count("*").alias("copies"))
    train = durable(join_counted(keyed, durable(groups, "copies", keyed.rows), ["copy_key", "toxic"], "copies", keyed.rows).select("text", "toxic", (1.0 / F.col("copies")).alias("weight")), "train")
    sizes = dict(train.groupBy("toxic").agg(F.sum("weight")).collect())
    toxic, clean = sizes.get(1, 0.0), sizes.get(0, 0.0)
    if not toxic or not clean:
        return Lexicon()
    counted = train.mapInArrow(lean(_counts), "term string, toxic double, clean double").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(f"toxic + clean >= {LEAST_TEXTS}")
    counted = durable(counted, "terms")
    candidates = counted.count()
    lexicon = Lexicon(_chosen([tuple(r) for r in _sure(counted, toxic, clean, candidates).collect()], toxic, clean, candidates))
    benign = train.mapInArrow(lean(_phrases(lexicon)), "term string, toxic double, clean double").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    lexicon.exceptions = [r[0] for r in benign.where(f"clean >= {LEAST_TEXTS} and clean >= toxic").collect()]
    rows = train.mapInArrow(_weigher(lexicon), "words double, share double, toxic int, weight double").toPandas()  # bounded as the sample is
    lexicon.curve = _curve(rows[["words", "share"]].to_numpy(float), rows.toxic.to_numpy(float), rows.weight.to_numpy(float))
    return lexicon


def _scorer(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        automaton = lexicon.automaton()
        for batch in batches:
            out = []
            for begin in range(0, batch.num_rows, 512):
                for text in batch.column(batch.num_columns - 1).slice(begin, 512).to_pylist():
                    if lexicon.curve is None:
                        out.append(0.0)
                        continue
                    folded = fold(text or "")
                    distinct, total = weigh(folded, automaton)
                    x = _features(distinct, total, len(folded.split()) if total else 0)
                    out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, lexicon.curve[0] + lexicon.curve[1] * x[0] + lexicon.curve[2] * x[1])))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.float64())], names=[*batch.schema.names[:-1], "score"])

    return run


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row of docs."""
    texts = plain(docs, id_col, text_col).toDF("doc_id", "text")
    return texts.mapInArrow(lean(_scorer(lexicon)), f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, score double")


def keep_civil(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose score is below 0.5, all columns."""
    names = docs.columns
    scored, found = fresh("scored", names), fresh("score", names)
    held = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text_col}`").alias(scored))
    run = _scorer(lexicon)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch.rename_columns([*names, found])

    return held.mapInArrow(lean(named), widened(docs, **{found: "double"})).where(f"{found} < 0.5").drop(found)


def held_out(id_column) -> object:
    """Rows that are never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(id_column.cast("string")) % 5 == 0


def learnable(labels: DataFrame) -> DataFrame:
    return labels.where(~held_out(F.col("doc_id")))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs."""
    scored = score(docs, learn(docs, learnable(labels)))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
