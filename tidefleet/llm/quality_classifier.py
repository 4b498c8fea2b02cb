"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)):
all pairwise interactions in time linear in a document's features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefleet.llm.common import crc32_text, labelled_ids, once_an_id, slices, small_batches
from tidefleet.llm.hashed import PACKED, Hasher, Rows, gathered, packed, sigmoid
from tidefleet.llm.quality_rules import text_counts

WORD_SLOTS, BINS = 1 << 14, 16
STATISTICS = ("words", "word length", "symbols", "capitals", "digits", "exclamations", "repeated lines", "repeated windows", "different words", "words a line", "listed length")
SLOTS = WORD_SLOTS + BINS * len(STATISTICS)
#: Labelled rows that the machine is fitted on at most, chosen by the hash of their ids.
LABELLED_ROWS = 4096
FACTORS, EPOCHS, BATCH, RATE, DECAY = 8, 8, 64, 0.05, 1e-4
KEEP = 0.7

_hasher = Hasher(WORD_SLOTS)
_CAPITALS, _DIGITS = bytes(range(65, 91)), b"0123456789"


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of one document: its different hashed words, and one bin of each statistic."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    n, chars, symbols, repeated_lines, repeated_words, lines, different, exclaims = text_counts(text)
    size, per = max(1, len(raw)), max(1, n)
    shares = (symbols / per, (size - len(raw.translate(None, _CAPITALS))) / size, (size - len(raw.translate(None, _DIGITS))) / size, exclaims / per, repeated_lines / max(1, lines), repeated_words / per)
    values = (1.2 * np.log1p(n), chars / per, *(15 * np.sqrt(s) for s in shares), 15 * np.log1p(different) / np.log1p(per), 2 * np.log1p(n / max(1, lines)), 1.2 * np.log1p(max(0, n_chars or 0)))
    bins = WORD_SLOTS + BINS * np.arange(len(STATISTICS)) + np.minimum(BINS - 1, np.array(values)).astype(np.int64)
    words = _hasher.slots_of(set(text.lower().split()))
    slots = np.concatenate([words, bins.astype(np.int32)])
    return slots, np.concatenate([np.full(len(words), 1 / np.sqrt(max(1, len(words)))), np.ones(len(bins))]).astype(np.float32)


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def parts(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Margins, and what their gradients need: v_if x_i and its sums by row."""
        x = rows.value[:, None] * self.factor[rows.slot]
        total = rows.sums(x)
        margin = self.bias + rows.sums(self.weight[rows.slot] * rows.value) + 0.5 * (total**2 - rows.sums(x**2)).sum(1)
        return margin, x, total

    def scores(self, rows: Rows) -> np.ndarray:
        return sigmoid(self.parts(rows)[0]) if len(rows) else np.zeros(0)


def fit_rows(rows: Rows, target: np.ndarray, seed: int = 7) -> Machine:
    """Adagrad over mini-batches of rows."""
    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(SLOTS), rng.normal(0, 0.02, (SLOTS, FACTORS)))
    seen_b, seen_w, seen_f = 1e-3, np.full(SLOTS, 1e-3), np.full((SLOTS, FACTORS), 1e-3)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            which = order[at : at + BATCH]
            part = rows.pick(which)
            margin, x, total = m.parts(part)
            g = (sigmoid(margin) - target[which]) / len(which)
            each = np.repeat(g, np.diff(part.ends))
            slots, place = np.unique(part.slot, return_inverse=True)
            gw, gf = np.zeros(len(slots)), np.zeros((len(slots), FACTORS))
            np.add.at(gw, place, each * part.value)
            np.add.at(gf, place, (each * part.value)[:, None] * (np.repeat(total, np.diff(part.ends), axis=0) - x))
            gw, gf, gb = gw + DECAY * m.weight[slots], gf + DECAY * m.factor[slots], g.sum()
            seen_w[slots] += gw**2
            seen_f[slots] += gf**2
            seen_b += gb**2
            m.weight[slots] -= RATE * gw / np.sqrt(seen_w[slots])
            m.factor[slots] -= RATE * gf / np.sqrt(seen_f[slots])
            m.bias -= RATE * gb / np.sqrt(seen_b)
    return m


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.pmod(crc32_text(doc_id), F.lit(4)) == 2, F.lit(False))


def _with_length(docs: DataFrame, *more: str) -> DataFrame:
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.length("text").cast("long")
    return docs.select("doc_id", "text", n_chars.alias("n_chars"), *more)


def _features(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    return [features(t, n) for t, n in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist(), strict=True)]


def fit(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> Machine | None:
    """The machine, from labelled_rows ids at most of those that aren't held out, a row each; None if there are none."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), *packed(_features(batch)), batch.column("quality")], ["id", "slots", "row_values", "quality"])

    some = labelled_ids(labels.filter(~held_out(F.col("doc_id"))), "quality", labelled_rows)
    joined = _with_length(docs).join(F.broadcast(some), F.col("doc_id") == F.col("id")).select("id", "text", "n_chars", "quality")
    found, target = gathered(once_an_id(small_batches(joined).mapInArrow(rows, f"id {dict(some.dtypes)['id']}, {PACKED}, quality int")), "quality")
    return fit_rows(found, target) if len(found) else None


def classify(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """Per row of docs: doc_id, held_out, score (0 to 1), predicted (1 if score >= KEEP).

    Null and empty texts are scored by their statistics; texts of any length are
    read whole; a score of just KEEP is predicted 1; null ids are not held out;
    repeated rows get a result each and don't move the fit; an empty table gives
    none; without labels every score is 0.5. Only text, n_chars and doc_id are read.
    """
    machine = fit(docs, labels, labelled_rows)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                score = machine.scores(Rows.of(_features(batch))) if machine else np.full(batch.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    found = small_batches(_with_length(docs)).mapInArrow(scored, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= KEEP, 1).otherwise(0).alias("predicted"))
