"""Text quality by gradient-boosted trees over histograms of document statistics.

Statistics of a text (character classes, word and line lengths, repetition) are read from its
bytes in one pass over arrays. Trees are grown in numpy level by level from histograms of binned
statistics, then kept as flat arrays, so that a batch walks down all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.textbytes import Words, find_words, mix, runs, word_hashes

# Bound of the model: labelled documents of each class that it learns from.
MOST_LABELLED = 20_000
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.2
RIDGE = 1.0
# Least sum of second derivatives on each side of a split.
LEAST_WEIGHT = 2.0
# A document counts as good from this score on.
GOOD = 0.7

CLASSES = ("upper", "lower", "digit", "blank", "line", "point", "exclaim", "symbol", "bracket", "other", "inner", "lead")
STATISTICS = (
    "log_chars", "log_words", "mean_word", "spread_word", "longest_word", "long_words", "marked_words", "letterless_words",
    "distinct_words", "distinct_windows", "log_lines", "mean_line", "distinct_lines",
    *(f"{c}_share" for c in CLASSES),
)
SCORES = "doc_id long, score double"
WINDOW = 5


def _classes() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), np.int64)
    for name, members in (
        ("upper", range(65, 91)), ("lower", range(97, 123)), ("digit", range(48, 58)), ("blank", b" \t"),
        ("line", b"\n\r\x0b\x0c"), ("point", b".,;:'-"), ("exclaim", b"!?"), ("symbol", b"#*$%&|<>@^~=+_"),
        ("bracket", b"()[]{}\"/\\`"), ("inner", range(128, 192)), ("lead", range(192, 256)),
    ):
        table[list(members)] = CLASSES.index(name)
    return table


_CLASS = _classes()


def held_out() -> Column:
    """Rows that the model never learns from: a quarter, by the checksum of doc_id as text."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _distinct(marks: np.ndarray, document: np.ndarray, n: int) -> np.ndarray:
    """How many different marks each document has."""
    _, at = np.unique(mix(marks ^ mix(document.astype(np.uint64) + np.uint64(1))), return_index=True)
    return np.bincount(document[at], minlength=n)


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each line that isn't empty, without its line feed."""
    feeds = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([offsets[:-1], feeds + 1]))
    end = np.unique(np.concatenate([offsets[1:], feeds]))
    start = start[start < len(data)]
    start = start[data[start] != 10]
    return start, end[np.searchsorted(end, start, "right")]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each text of a run; all zero for an empty text."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    counts = np.bincount(np.repeat(np.arange(n), sizes) * len(CLASSES) + _CLASS[data], minlength=n * len(CLASSES))
    counts = counts.reshape(n, len(CLASSES)).astype(float)
    words = find_words(data, offsets)
    n_words = np.diff(words.first)
    of = np.repeat(np.arange(n), n_words)
    length = (words.end - words.start).astype(float)
    some = np.maximum(n_words, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(of, mask, minlength=n) / some

    mean = share(length)
    spread = np.sqrt(np.maximum(share(length**2) - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, of, length)
    letters = np.concatenate([[0], np.cumsum((_CLASS[data] <= 1) | (data >= 192))])
    last = _CLASS[data[words.end - 1]]
    marked = (last == CLASSES.index("symbol")) | (last == CLASSES.index("exclaim"))
    hashes = word_hashes(words, fold=True)
    distinct = _distinct(hashes, of, n) / some
    width = max(len(hashes) - WINDOW + 1, 0)
    windows = np.zeros(width, np.uint64)
    for k in range(WINDOW):
        windows = mix(windows + hashes[k : k + width])
    inside = of[:width] == of[WINDOW - 1 :][:width]
    n_windows = np.maximum(n_words - WINDOW + 1, 1)
    distinct_windows = np.where(n_words >= WINDOW, _distinct(windows[inside], of[:width][inside], n) / n_windows, 1)
    start, end = _lines(data, offsets)
    line_of = np.searchsorted(offsets, start, "right") - 1
    n_lines = np.bincount(line_of, minlength=n)
    line_hashes = word_hashes(Words(data, start, end, None, offsets), fold=False)
    distinct_lines = np.where(n_lines > 0, _distinct(line_hashes, line_of, n) / np.maximum(n_lines, 1), 1)
    found = np.column_stack([
        np.log1p(sizes - counts[:, CLASSES.index("inner")]), np.log1p(n_words), mean, spread, longest,
        share(length > 20), share(marked), share(letters[words.end] == letters[words.start]),
        distinct, distinct_windows, np.log1p(n_lines), sizes / np.maximum(n_lines, 1), distinct_lines,
        counts / np.maximum(sizes, 1)[:, None],
    ])
    found[sizes == 0] = 0
    return found


@dataclass
class Forest:
    """Complete trees as flat arrays: inner nodes level by level, tree after tree, then the leaves' values.

    A row goes right where its statistic is above the threshold; a node that is not split has an
    infinite one.
    """

    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def margins(self, rows: np.ndarray) -> np.ndarray:
        inner, leaves = (1 << self.depth) - 1, 1 << self.depth
        trees = np.arange(len(self.value) // leaves)
        at = np.arange(len(rows))[:, None]
        node = np.zeros((len(rows), len(trees)), np.int64)
        for _ in range(self.depth):
            place = trees * inner + node
            node = 2 * node + 1 + (rows[at, self.feature[place]] > self.threshold[place])
        return self.base + self.value[trees * leaves + node - inner].sum(axis=1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(rows), -500, 500)))


def bin_edges(rows: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """For each statistic up to ``bins`` - 1 edges at its quantiles; bin b holds values up to edge b."""
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(column, quantiles, method="lower")) if len(column) else column for column in rows.T]


def best_splits(
    cells: np.ndarray, node: np.ndarray, n_nodes: int, bins: int, gradient: np.ndarray, weight: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistic, bin and gain of each node's best split, from histograms of both derivatives.

    ``cells`` numbers (statistic, bin) for each row and statistic.
    """
    n_features = cells.shape[1]
    flat = (cells + node[:, None] * (n_features * bins)).ravel()
    size = n_nodes * n_features * bins
    shape = (n_nodes, n_features, bins)
    g = np.bincount(flat, np.repeat(gradient, n_features), minlength=size).reshape(shape).cumsum(axis=2)
    h = np.bincount(flat, np.repeat(weight, n_features), minlength=size).reshape(shape).cumsum(axis=2)
    all_g, all_h = g[:, :, -1:], h[:, :, -1:]
    gain = g**2 / (h + RIDGE) + (all_g - g) ** 2 / (all_h - h + RIDGE) - all_g**2 / (all_h + RIDGE)
    gain[(h < LEAST_WEIGHT) | (all_h - h < LEAST_WEIGHT)] = -np.inf
    gain = gain.reshape(n_nodes, -1)
    best = gain.argmax(axis=1)
    return best // bins, best % bins, gain[np.arange(n_nodes), best]


def grow(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Forest:
    """Boost trees for the logistic loss. Without rows of both classes every score is the base rate."""
    n = len(rows)
    rate = (labels.sum() + 0.5) / (n + 1)
    base = float(np.log(rate / (1 - rate)))
    if not 0 < labels.sum() < n:
        trees = 0
    edges = bin_edges(rows, bins)
    binned = np.column_stack([np.searchsorted(e, column, "left") for e, column in zip(edges, rows.T, strict=True)])
    cells = binned + np.arange(rows.shape[1]) * bins
    margin = np.full(n, base)
    inner = (1 << depth) - 1
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    for tree in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = p - labels, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first = (1 << level) - 1
            which, where, gain = best_splits(cells, node, 1 << level, bins, gradient, weight)
            for k in np.flatnonzero(gain > 1e-9).tolist():
                if where[k] < len(edges[which[k]]):
                    feature[tree, first + k] = which[k]
                    threshold[tree, first + k] = edges[which[k]][where[k]]
            node = 2 * node + (rows[np.arange(n), feature[tree, first + node]] > threshold[tree, first + node])
        g = np.bincount(node, gradient, minlength=inner + 1)
        h = np.bincount(node, weight, minlength=inner + 1)
        value[tree] = -RATE * g / (h + RIDGE)
        margin += value[tree][node]
    return Forest(depth, feature.ravel(), threshold.ravel(), value.ravel(), base)


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of up to ``most`` documents of each class that are not held out.

    Documents are drawn by a hash of doc_id. One with contradicting labels counts as bad; of rows with
    equal statistics and label, such as copies, one is used.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    dice = F.xxhash64("doc_id", F.lit("quality"))
    sample = (
        known.filter("quality = 1").orderBy(dice, "doc_id").limit(most)
        .union(known.filter("quality = 0").orderBy(dice, "doc_id").limit(most))
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in runs(batch.column("text")):
                found = statistics(data, offsets)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("quality").slice(at, len(found)), lists], names=["quality", "found"]
                )

    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most 2 * most rows
    rows = texts.select("quality", "text").mapInArrow(measure, "quality int, found array<double>").distinct()
    # copies of a document can't be told from repeated rows before this, so rows are bounded again
    rows = rows.orderBy(F.xxhash64("found"), "quality").limit(2 * most).toArrow()
    if not rows.num_rows:
        return np.zeros((0, len(STATISTICS))), np.zeros(0)
    found = rows.column("found").combine_chunks()
    return found.values.to_numpy().reshape(-1, len(STATISTICS)), rows.column("quality").to_numpy().astype(float)


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Forest:
    return grow(*labelled_rows(docs, labels, most))


def predict(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id and score of each document, one row in, one row out.

    Whole texts are measured; null and empty ones have statistics of zero and are scored like any
    other. Only doc_id and text are read; repeated and null doc_ids change nothing.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [forest.scores(statistics(data, offsets)) for _, data, offsets in runs(batch.column("text"))]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(scores)], names=["doc_id", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(score, SCORES)
