"""Quality rules: counts of every text, fixed base limits, and an isolation forest on rule statistics.

A rule statistic is a ratio on a scale from 0 to 1. The forest is grown on rows
labelled good; its splits are drawn at random over the whole scale of a
statistic, also where no good row lies, so that a document which random splits
set apart from all good ones after few steps has a short path and is an anomaly.
Splits don't depend on the rows: every task draws the same whole trees and counts
all its good rows in their leaves, and the counts say where trees end. The
threshold on scores comes from all labelled rows, good and bad.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefleet.llm.common import SharedTables, label_of_ids, once_an_id, slices, small_batches

SPACES, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
TREES, DEPTH = 100, 12
#: How many rejected good rows weigh as much as one kept bad row.
GOOD_WEIGHT = 20
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_distinct", "n_exclaim")


def text_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS and EXTRA of one text; null counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: at ASCII white space, and no other
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        times, until = Counter(windows), 0
        for i, w in enumerate(windows):
            if times[w] > 1:
                repeated += i + 5 - max(i, until)
                until = i + 5
    return (
        len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated,
        len(lines), len(set(words)), raw.count(b"!"),
    )


def base_failed(counts: np.ndarray) -> np.ndarray:
    n, repeated = counts[:, 0], counts[:, 4]
    return (n < 10) | (100 * repeated > 20 * n)


def statistics(counts: np.ndarray) -> np.ndarray:
    """What the forest splits, each from 0 to 1, which a text's mere length does not move: symbols, word length (2 letters: 0, 16: 1), repeated lines, repeated windows, different words, exclamations."""
    c = counts.astype(float)
    n, lines = np.maximum(c[:, 0], 1), np.maximum(c[:, 5], 1)
    many = lambda x: 1 - 1 / (1 + 10 * x)
    length = np.clip((np.log2(np.maximum(c[:, 1] / n, 1)) - 1) / 3, 0, 1)
    different = (np.log1p(c[:, 6]) / np.log1p(n)) ** 4
    return np.stack([many(c[:, 2] / n), length, c[:, 3] / lines, np.minimum(c[:, 4] / n, 1), different, many(c[:, 7] / n)], axis=1)


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    m = np.maximum(n, 2)
    return np.where(n < 2, 0.0, np.where(n == 2, 1.0, 2 * (np.log(m - 1) + 0.5772156649) - 2 * (m - 1) / m))


@dataclass
class Forest:
    """All trees' nodes in arrays: feature (-1 at a leaf), split, the node below it (the one above follows), path length at a leaf; where trees begin; and the threshold on scores."""

    feature: np.ndarray
    split: np.ndarray
    below: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    norm: float
    threshold: float = math.inf

    def paths(self, x: np.ndarray) -> np.ndarray:
        """Mean path length of each row."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for root in self.roots:
            node, live = np.full(len(x), root), rows
            while len(live):
                at = node[live]
                f = self.feature[at]
                inner = f >= 0
                live, at, f = live[inner], at[inner], f[inner]
                node[live] = self.below[at] + (x[live, f] >= self.split[at])
            total += self.path[node]
        return total / len(self.roots)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores from 0 to 1 of rows of statistics: the shorter the mean path, the higher."""
        return 2.0 ** (-self.paths(x) / self.norm)


@dataclass
class Trees:
    """Whole trees of random splits of 0 to 1, a row each: what nodes split, those below node i being 2i + 1 and 2i + 2."""

    feature: np.ndarray
    split: np.ndarray
    depth: int

    @classmethod
    def drawn(cls, columns: int, seed: int = 7, trees: int = TREES, depth: int = DEPTH) -> Trees:
        rng = np.random.default_rng(seed)
        feature, split = rng.integers(columns, size=(trees, 2**depth - 1), dtype=np.int8), rng.random((trees, 2**depth - 1))
        for t in range(trees):
            low, high = np.zeros((1, columns)), np.ones((1, columns))
            for level in range(depth):
                here, each = slice(2**level - 1, 2 ** (level + 1) - 1), np.arange(2**level)
                f = feature[t, here]
                s = split[t, here] = low[each, f] + (high[each, f] - low[each, f]) * split[t, here]
                less, more = high.copy(), low.copy()
                less[each, f] = more[each, f] = s
                low, high = (np.stack(x, 1).reshape(-1, columns) for x in ((low, more), (less, high)))
        return cls(feature, split, depth)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """For each row the leaf of each tree, numbered over all trees."""
        out, rows = np.zeros((len(x), len(self.feature)), np.int32), np.arange(len(x))
        for t, (feature, split) in enumerate(zip(self.feature, self.split, strict=True)):
            node = np.zeros(len(x), np.int32)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] >= split[node])
            out[:, t] = node - (2**self.depth - 1) + t * 2**self.depth
        return out

    def held(self, counts: np.ndarray) -> Forest:
        """The forest by how many rows each leaf has: a node of one row or none, or so many levels down, is a leaf."""
        trees, inner = len(self.feature), 2**self.depth - 1
        levels = [counts.reshape(trees, -1)]
        while levels[0].shape[1] > 1:
            levels.insert(0, levels[0].reshape(trees, -1, 2).sum(2))
        n, level = np.concatenate(levels, 1), np.repeat(np.arange(self.depth + 1), 2 ** np.arange(self.depth + 1))
        parted = (n >= 2) & (level < self.depth)
        kept = np.ones_like(parted)
        kept[:, 1:] = np.repeat(parted[:, :inner], 2, axis=1)
        index = (np.cumsum(kept) - 1).reshape(kept.shape)
        feature, split, below = np.full(n.shape, -1, np.int8), np.zeros(n.shape), np.zeros(n.shape, np.int32)
        feature[:, :inner], split[:, :inner], below[:, :inner] = self.feature, self.split, index[:, 1::2]
        feature[~parted], split[~parted], below[~parted] = -1, 0.0, 0
        path = np.where(parted, 0.0, level + _mean_path(n))
        return Forest(feature[kept], split[kept], below[kept], path[kept], index[:, 0], max(float(_mean_path(n[0, 0])), 1e-9))


def grow(x: np.ndarray, seed: int = 7, trees: int = TREES, per_tree: int | None = None, depth: int = DEPTH) -> Forest:
    """The forest of rows of statistics: each tree has all of them or, with per_tree, a random part of so many at most."""
    drawn = Trees.drawn(x.shape[1], seed, trees, depth)
    leaves = drawn.leaves(x)
    if per_tree and per_tree < len(x):
        leaves = np.random.default_rng(seed).permuted(leaves, axis=0)[:per_tree]
    return drawn.held(np.bincount(leaves.ravel(), minlength=trees * 2**depth))


@dataclass
class Cut:
    """A run of falling scores: the first, the cost of rejecting all, and the least cost of rejecting some of the highest, with the scores on either side of where that ends (after: None if that is the run's end)."""

    first: float
    total: int
    least: int
    at: float
    after: float | None

    @classmethod
    def of(cls, scores: np.ndarray, cost: np.ndarray) -> Cut:
        along = np.cumsum(cost)
        i = int(np.argmin(along))
        return cls(float(scores[0]), int(along[-1]), int(along[i]), float(scores[i]), float(scores[i + 1]) if i + 1 < len(scores) else None)

    def then(self, other: Cut) -> Cut:
        """The run with a lower one behind it; of equal costs the higher threshold."""
        if self.total + other.least < self.least:
            return Cut(self.first, self.total + other.total, self.total + other.least, other.at, other.after)
        return Cut(self.first, self.total + other.total, self.least, self.at, other.first if self.after is None else self.after)

    def threshold(self) -> float:
        return (self.at + (self.after or 0.0)) / 2 if self.least < 0 else math.inf


def calibrated(counts: np.ndarray, good: np.ndarray, seed: int = 7) -> Forest | None:
    """The forest, with the threshold that errs least on the labelled rows that pass the base limits; None without such good rows.

    Rejected are scores at or over the threshold, which lies midway between two
    rows' scores; of equally good thresholds the highest is taken, and rows of
    equal scores are never parted. fit() does the same in tasks.
    """
    left = ~base_failed(counts)
    x, good = statistics(counts[left]), good[left].astype(bool)
    if not good.any():
        return None
    forest = grow(x[good], seed)
    scores, group = np.unique(-forest.scores(x), return_inverse=True)  # highest first
    forest.threshold = Cut.of(-scores, np.bincount(group, np.where(good, GOOD_WEIGHT, -1))).threshold()
    return forest


def _counted(batch: pa.RecordBatch) -> np.ndarray:
    found = [text_counts(t) for part in slices(batch, "text") for t in part.column("text").to_pylist()]
    return np.array(found, np.int64).reshape(-1, len(COUNTS) + len(EXTRA))


def _kept(counts: np.ndarray, forest: Forest | None) -> np.ndarray:
    passed = ~base_failed(counts)
    return passed & (forest.scores(statistics(counts)) < forest.threshold) if forest else passed


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, COUNTS, EXTRA) of each row of docs."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, _counted(batch).T)], ["doc_id", *COUNTS, *EXTRA])

    rows = docs.select("doc_id", "text")
    return small_batches(rows).mapInArrow(counts, f"doc_id {dict(rows.dtypes)['doc_id']}, " + ", ".join(f"{c} long" for c in (*COUNTS, *EXTRA)))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy() for c in (*COUNTS, *EXTRA)], 1)


def fit(docs: DataFrame, labels: DataFrame) -> Forest | None:
    """Forest and threshold from all labelled ids; of an id's labels or texts the least counts."""
    return _fitted(counted(docs), labels)


def _fitted(counts: DataFrame, labels: DataFrame) -> Forest | None:
    """fit() by the rows of counted(). To the driver come numbers of rows by leaf and a cut a partition."""
    spark, tables = counts.sparkSession, SharedTables(counts.sparkSession)
    joined = counts.join(label_of_ids(labels, "quality"), F.col("doc_id") == F.col("id")).select("id", "quality", *COUNTS, *EXTRA)
    rows = tables.keep(once_an_id(joined), few=True)

    def passed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        c = _matrix(batch)
        left = ~base_failed(c)
        return statistics(c[left]), batch.column("quality").to_numpy()[left].astype(bool)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn, n = None, None
        for batch in batches:
            x, good = passed(batch)
            if drawn is None:
                drawn, n = Trees.drawn(x.shape[1]), np.zeros(TREES * 2**DEPTH, np.int64)
            n += np.bincount(drawn.leaves(x[good]).ravel(), minlength=len(n))
        if drawn is not None:
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["leaf", "n"])

    found = rows.mapInArrow(leaves, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).toArrow()  # TREES * 2**DEPTH rows at most
    if not found.num_rows:
        return None
    sizes = np.zeros(TREES * 2**DEPTH, np.int64)
    sizes[found.column("leaf").to_numpy()] = found.column("n").to_numpy()
    forest = Trees.drawn(len(statistics(np.zeros((1, len(COUNTS) + len(EXTRA)), np.int64))[0])).held(sizes)

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, good = passed(batch)
            yield pa.RecordBatch.from_arrays([pa.array(forest.scores(x)), pa.array(np.where(good, GOOD_WEIGHT, -1))], ["score", "cost"])

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = [Cut.of(b.column("score").to_numpy(), b.column("cost").to_numpy()) for b in batches if b.num_rows]
        if runs:
            yield pa.RecordBatch.from_pylist([vars(functools.reduce(Cut.then, runs))])

    scored = tables.keep(rows.mapInArrow(costs, "score double, cost long").groupBy("score").agg(F.sum("cost").alias("cost")))
    ranges = scored.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), F.desc("score")).sortWithinPartitions(F.desc("score"))
    runs = ranges.mapInArrow(cuts, "first double, total long, least long, at double, after double").collect()
    forest.threshold = functools.reduce(Cut.then, (Cut(**r.asDict()) for r in sorted(runs, key=lambda r: -r["first"]))).threshold()
    tables.drop(scored)
    tables.drop(rows)
    return forest


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, COUNTS, base_failed, anomaly (the forest's score; null without labelled rows), kept.

    Null and empty texts have no words and fail; texts of any length are counted
    whole; a score of just the threshold is rejected; repeated rows and null ids
    get their results and don't move the fit; an empty table gives none; without
    labelled rows only the base limits judge. Other columns are not read. Texts
    are counted once, into a table in the shared folder.
    """
    rows = SharedTables(docs.sparkSession).keep(counted(docs))
    forest = _fitted(rows, labels)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = _matrix(batch)
            score = pa.array(forest.scores(statistics(counts))) if forest else pa.nulls(len(counts), pa.float64())
            columns = [batch.column("doc_id"), *map(pa.array, counts.T[: len(COUNTS)]), pa.array(base_failed(counts)), score, pa.array(_kept(counts, forest))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *COUNTS, "base_failed", "anomaly", "kept"])

    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, anomaly double, kept boolean"
    return rows.mapInArrow(judged, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that judge() keeps, with all their columns.

    Null and empty texts have no words and go; texts of any length are counted
    whole; repeated rows and null ids fare as their texts do; columns of any names
    stay as they are; an empty table stays empty.
    """
    forest = fit(docs, labels)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_kept(_counted(batch), forest)))

    return small_batches(docs).mapInArrow(passed, docs.schema)
