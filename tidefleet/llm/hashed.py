"""Hashed words and sparse rows, shared by the classifiers."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidefleet.llm.common import Remembered

LETTERS = re.compile(r"[^\W\d_]+")


class Hasher(Remembered):
    """crc32 of a word, modulo a number of slots."""

    def __init__(self, slots: int):
        super().__init__(300_000)
        self.slots = slots

    def __missing__(self, word: str) -> int:
        self[word] = value = zlib.crc32(word.encode("utf-8", "surrogatepass")) % self.slots
        return value

    def slots_of(self, words: set[str]) -> np.ndarray:
        """The different slots of some words, ascending."""
        self.age()
        return np.unique(np.fromiter(map(self.__getitem__, words), np.int32, len(words)))


@dataclass
class Rows:
    """Sparse rows: slots and values of all rows one after another, and where each row ends."""

    slot: np.ndarray
    value: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        if not rows:
            return cls(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(1, np.int64))
        return cls(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), np.cumsum([0, *(len(r[0]) for r in rows)]))

    def __len__(self) -> int:
        return len(self.ends) - 1

    def pick(self, which: np.ndarray) -> Rows:
        at = np.concatenate([np.arange(self.ends[i], self.ends[i + 1]) for i in which])
        return Rows(self.slot[at], self.value[at], np.cumsum([0, *(self.ends[which + 1] - self.ends[which])]))

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Sum of x, which has an entry for each slot listed, over each row. No row is empty."""
        return np.add.reduceat(x, self.ends[:-1], axis=0)


def packed(rows: list[tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
    """Rows as two binary columns."""
    return [pa.array([r[0].astype(np.int32).tobytes() for r in rows], pa.binary()), pa.array([r[1].astype(np.float32).tobytes() for r in rows], pa.binary())]


PACKED = "slots binary, row_values binary"


def gathered(df: DataFrame, target: str) -> tuple[Rows, np.ndarray]:
    """Rows and targets of a bounded sample, brought to the driver in an order that doesn't depend on tasks."""
    table = df.toArrow().to_pydict()
    found = sorted(zip(table["slots"], table["row_values"], table[target], strict=True))
    return Rows.of([(np.frombuffer(a, np.int32), np.frombuffer(b, np.float32)) for a, b, _ in found]), np.array([t for *_, t in found], float)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
