"""Quality rules and robust multivariate outliers.

``statistics`` counts, in one pass over whole texts, words, symbols, repeated lines and words in repeated windows.
A fixed rule on them fails a document; the others are judged by how far their transformed statistics lie
from those usual for their language and source:

* Each statistic is a rate with pseudo-counts, so short texts lie near the middle instead of scattering.
* Location and scatter are minimum-covariance-determinant estimates: from a start at medians and median
  deviations, concentration steps keep the share ``SUBSET`` of rows of least Mahalanobis distance and
  estimate anew from them, until the determinant stops falling. A step is one aggregation: rows give
  moments by group and distance bin (bins of equal width in log distance), and the bins up to the share are summed up, group by group.
  All rows count, and no group's rows meet in one task.
* Groups of fewer than ``LEAST_GROUP`` rows take the estimates of all rows.
* A floor on each statistic's deviation keeps the scatter regular where a statistic hardly varies.
* Distances are scaled so that their middle is that of a chi-square variable; beyond the quantile ``CUT`` a document is rejected.

Edge cases: null and empty texts have zero counts and fail the rule. A null language or source is a
group of its own. Rows are judged each for itself, repeated or not; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import WordHashes, durable, let_go, plain, word_shingles

SUBSET, LEAST_GROUP, STEPS = 0.75, 200, 8
#: Two-sided normal deviate whose square, per statistic, is the cut: 1 in 10^9 of regular texts.
CUT = 1e-9
#: Pseudo-counts: words, characters of a word, lines.
WORDS, LETTERS, LINES = 50, 6, 5
FEATURES = ("word_length", "symbols", "capitals", "marks", "dup_lines", "repeats")
#: Least deviation of each statistic.
FLOORS = (0.6, 0.02, 0.04, 0.04, 0.05, 0.04)
#: Distance bins per factor of e.
BINS = 20

WHITE, SYMBOLS, CAPITALS = b" \t\n\r\x0b\x0c", b"#*$%&|<>", bytes(range(65, 91))
MARKS = b"!?;:()[]{}=+/\\^~@_\"`"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 5


def _repeat_words(ids: np.ndarray) -> int:
    """Words inside windows of WINDOW words that occur more than once."""
    if len(ids) <= WINDOW:
        return 0
    windows = word_shingles(ids, WINDOW)
    ordered = np.sort(windows)
    if not (twice := ordered[1:] == ordered[:-1]).any():
        return 0
    starts = np.flatnonzero(np.isin(windows, ordered[1:][twice]))
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[starts] += 1
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def counts_of(text: bytes, cache: WordHashes) -> tuple[int, ...]:
    """COUNTS, then capitals, marks and lines with a word."""
    words = text.split()
    solid = text.translate(None, WHITE)
    without = lambda chars: len(solid) - len(solid.translate(None, chars))
    seen, dup, lines = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip(WHITE):
            lines += 1
            dup += line in seen
            seen.add(line)
    chars = len(solid) - len(solid.translate(None, bytes(range(128)) + bytes(range(192, 256))))  # less continuation bytes
    return len(words), chars, without(SYMBOLS), dup, _repeat_words(cache.of(words)), without(CAPITALS), without(MARKS), lines


def _rates(c: np.ndarray) -> np.ndarray:
    words, chars, symbols, dup, repeat, capitals, marks, lines = c.T.astype(float)
    letters = chars + WORDS * LETTERS
    return np.column_stack([letters / (words + WORDS), np.sqrt(symbols / letters), capitals / letters, np.sqrt(marks / letters), dup / (lines + LINES), repeat / (words + WORDS)])


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    cache = WordHashes()
    for batch in batches:
        for begin in range(0, batch.num_rows, 512):
            part = batch.slice(begin, 512)
            c = np.array([counts_of(t or b"", cache) for t in part.column(2).to_pylist()], np.int64).reshape(-1, 8)
            x = _rates(c)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:2], *(pa.array(c[:, i]) for i in range(5)), *(pa.array(x[:, i]) for i in range(len(FEATURES)))],
                names=["doc_id", "grp", *COUNTS, *FEATURES],
            )


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """doc_id, grp (the group's columns as JSON, without nulls), COUNTS and FEATURES of every row of docs."""
    grp = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in group_cols]))
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(grp, F.lit("{}")).alias("grp"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_counter, f"doc_id {kind}, grp string, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{c} double" for c in FEATURES))


def chi_square(p_above: float, k: int) -> float:
    """The value that a chi-square variable of k degrees exceeds with p_above (Wilson-Hilferty)."""
    low, high = 0.0, 40.0
    for _ in range(100):
        z = (low + high) / 2
        low, high = (z, high) if math.erfc(z / math.sqrt(2)) / 2 > p_above else (low, z)
    z = low if p_above < 0.5 else 0.0
    return k * (1 - 2 / (9 * k) + z * math.sqrt(2 / (9 * k))) ** 3


K = len(FEATURES)
PAIRS = [(i, j) for i in range(K) for j in range(i, K)]
PARAMETERS = "grp string, n long, center array<double>, inverse array<double>, logdet double, scale double"


def _parameters(grp: str, n: int, center: np.ndarray, cov: np.ndarray, scale: float = 1.0) -> pd.DataFrame:
    cov = cov + np.diag(np.square(FLOORS))
    return pd.DataFrame({"grp": [grp], "n": [n], "center": [center.tolist()], "inverse": [np.linalg.inv(cov).ravel().tolist()], "logdet": [float(np.linalg.slogdet(cov)[1])], "scale": [scale]})


def _concentrated(pdf: pd.DataFrame) -> pd.DataFrame:
    """New estimates of one group from its distance bins; the old ones if the determinant doesn't fall."""
    pdf = pdf.sort_values("bin")
    n, old = int(pdf.n.sum()), float(pdf.logdet.iloc[0])
    reached = pdf.n.cumsum().to_numpy()
    last = int(np.searchsorted(reached, SUBSET * n))
    inside = pdf.iloc[: last + 1]
    m = float(inside.n.sum())
    center = np.array([inside[f"s{i}"].sum() for i in range(K)]) / m
    cov = np.empty((K, K))
    for i, j in PAIRS:
        cov[i, j] = cov[j, i] = inside[f"q{i}_{j}"].sum() / m - center[i] * center[j]
    middle = math.exp((float(pdf.bin.iloc[int(np.searchsorted(reached, 0.5 * n))]) + 0.5) / BINS)
    new = _parameters(pdf.grp.iloc[0], n, center, cov, max(1.0, middle / chi_square(0.5, K)))
    if new.logdet[0] >= old - 1e-6 and old < 1e299:
        row = pdf.iloc[0]
        new = pd.DataFrame({"grp": [row.grp], "n": [n], "center": [list(row.center)], "inverse": [list(row.inverse)], "logdet": [old], "scale": [new.scale[0]]})
    return new


def _distance(x: list, center, inverse):
    d = [x[i] - F.get(center, F.lit(i)) for i in range(K)]
    return sum((F.get(inverse, F.lit(i * K + j)) * d[i] * d[j] * (1 if i == j else 2) for i, j in PAIRS), F.lit(0.0))


def _with_parameters(rows: DataFrame, parameters: DataFrame) -> DataFrame:
    """Joins a group's estimates to its rows. Groups with a thousandth of all rows or more are at most a thousand and are broadcast; the others join by shuffle."""
    total = rows.rows
    large = F.broadcast(parameters.where(F.col("n") * 1000 >= total))
    small = parameters.where(F.col("n") * 1000 < total)
    return rows.join(large, "grp").unionByName(rows.join(large.select("grp"), "grp", "left_anti").join(small, "grp"))


def estimates(stats: DataFrame) -> DataFrame:
    """PARAMETERS of each group, and of all rows under an empty name."""
    x = stats.select("grp", *FEATURES)
    rows = durable(x.unionByName(x.withColumn("grp", F.lit(""))), "rates")
    medians = rows.groupBy("grp").agg(F.count("*").alias("n"), *[F.percentile_approx(c, [0.25, 0.5, 0.75], 1000).alias(c) for c in FEATURES])

    def begun(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                quartiles = np.array([getattr(r, c) for c in FEATURES], float)
                start = _parameters(r.grp, r.n, quartiles[:, 1], np.diag(((quartiles[:, 2] - quartiles[:, 0]) / 1.349) ** 2))
                yield start.assign(logdet=1e300)

    parameters = durable(medians.mapInPandas(begun, PARAMETERS), "estimates", rows.rows, 100_000)
    moments = [F.count("*").alias("n"), F.first("logdet").alias("logdet"), F.first("center").alias("center"), F.first("inverse").alias("inverse"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(FEATURES)], *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"q{i}_{j}") for i, j in PAIRS]]
    before = None
    for _ in range(STEPS):
        near = _with_parameters(rows, parameters).withColumn("d", _distance([F.col(c) for c in FEATURES], F.col("center"), F.col("inverse")))
        bins = near.withColumn("bin", F.floor(F.log(F.greatest("d", F.lit(1e-6))) * BINS)).groupBy("grp", "bin").agg(*moments)
        parameters = durable(bins.groupBy("grp").applyInPandas(_concentrated, PARAMETERS), "estimates", parameters.rows, 10_000)
        now = parameters.agg(F.round(F.sum("logdet"), 3)).first()[0]
        if now == before:
            break
        before = now
    return parameters


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """doc_id, COUNTS, base_failed, distance (scaled, squared) and kept of every row of docs."""
    stats = durable(statistics(docs, id_col, text_col, group_cols), "statistics")
    parameters = estimates(stats)
    overall = parameters.where("grp = ''").select(*[F.col(c).alias(f"all_{c}") for c in ("center", "inverse", "scale")])
    own = parameters.where("grp <> ''").join(F.broadcast(overall), how="left")  # one row
    pick = lambda c: F.when(F.col("n") >= LEAST_GROUP, F.col(c)).otherwise(F.col(f"all_{c}")).alias(c)
    chosen = durable(own.select("grp", "n", pick("center"), pick("inverse"), pick("scale")), "chosen", parameters.rows, 10_000)
    placed = _with_parameters(stats, chosen)
    distance = _distance([F.col(c) for c in FEATURES], F.col("center"), F.col("inverse")) / F.col("scale")
    failed = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    return placed.select("doc_id", *COUNTS, failed.alias("base_failed"), distance.alias("distance"), (~failed & (distance <= chi_square(CUT, K))).alias("kept"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every row of docs. A null text has no words and fails the base rules; repeated rows share a verdict."""
    return judged(docs)
