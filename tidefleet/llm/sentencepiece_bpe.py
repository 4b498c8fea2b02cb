"""Merge-type SentencePiece encoding with a score-ordered agenda, and decoding.

A text becomes word-start marks and characters; the agenda holds adjacent pairs
whose joint piece is in the vocabulary, best score first, then leftmost. Where no
piece of the vocabulary spans a boundary (before a mark, around a line's end,
between letters and others), the pieces of a text are those of its units on
either side; every new unit of an Arrow batch is checked against the library.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidefleet.llm.common import Remembered, slices, small_batches

MARK = "▁"
LETTERS = "[A-Za-zÀ-ÖØ-öø-ɏ]"
LETTER = re.compile(LETTERS)
#: Units in each generation of a worker's cache, about 80 MB.
REMEMBERED = 250_000


def unit_pattern(pieces: list[str]) -> re.Pattern:
    """What cuts a marked text into units, as fine as these pieces allow."""
    if any(MARK in p.lstrip(MARK) for p in pieces):
        return re.compile("(?s:.+)")
    mixed = re.compile(f"{LETTERS}(?!{LETTERS}).|(?!{LETTERS})[^{MARK}]{LETTERS}", re.DOTALL)
    end, line = ("", "") if any("\n" in p and len(p) > 1 for p in pieces) else ("\n", "|\n")
    if any(map(mixed.search, pieces)):
        return re.compile(f"{MARK}+[^{MARK}{end}]*|[^{MARK}{end}]+{line}")
    return re.compile(f"{MARK}*{LETTERS}+|{MARK}*(?:(?!{LETTERS})[^{MARK}{end}])+|{MARK}+{line}")


class Encoder:
    """Pieces, scores and remembered units of one model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = one = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [(i, one.id_to_piece(i)) for i in range(one.get_piece_size()) if not (one.is_control(i) or one.is_unknown(i) or one.is_byte(i) or one.is_unused(i))]
        self.ids = {p: i for i, p in pieces}
        self.costs = {p: -one.get_score(i) for i, p in pieces}
        self.bytes = [one.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.units = unit_pattern(list(self.ids))
        self.known = Remembered(REMEMBERED)
        self.differing: set[str] = set()
        self.lead = {b: one.encode(b) for b in ("", ",", "a")}

    def agenda(self, unit: str) -> list[int]:
        """Ids of a unit by merging adjacent symbols in the order of their scores."""
        parts: list[str] = list(unit)
        n, costs = len(parts), self.costs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        todo = [(costs[joint], i, joint) for i in range(n - 1) if (joint := parts[i] + parts[i + 1]) in costs]
        heapify(todo)
        while todo:
            _, a, joint = heappop(todo)
            b = after[a]
            if b >= n or not parts[a] or parts[a] + parts[b] != joint:
                continue  # one of the two has merged meanwhile
            parts[a], parts[b] = joint, ""
            after[a] = c = after[b]
            if c < n:
                before[c] = a
                if (more := joint + parts[c]) in costs:
                    heappush(todo, (costs[more], a, more))
            if (c := before[a]) >= 0 and (more := parts[c] + joint) in costs:
                heappush(todo, (costs[more], c, more))
        out: list[int] = []
        for p in parts:
            if p:
                out += [self.ids[p]] if p in self.ids else [self.bytes[b] for b in p.encode("utf-8", "surrogatepass")]
        return out

    def learn(self, units: set[str]) -> None:
        """Encode new units, checked against the library; where they differ, the library's ids hold, and the unit is kept in differing, as is one that can't be checked."""
        new = list(units)
        # the library puts a mark before a text: units without one stand after a sign, or a letter, that no piece joins to them
        before = ["" if u[0] == MARK and len(u) > 1 else "," if LETTER.match(u) else "a" for u in new]
        texts = [(u[1:] if not b else b + u).replace(MARK, " ") for u, b in zip(new, before, strict=True)]
        asked = self.library.encode(texts, num_threads=1)
        for u, b, whole in zip(new, before, asked, strict=True):
            ids, lead = self.agenda(u), self.lead[b]
            if whole != lead + ids:
                right = whole[len(lead) :] if whole[: len(lead)] == lead else self.after_another(u)
                if right != ids:
                    self.differing.add(u)
                    ids = ids if right is None else right
            self.known[u] = np.array(ids, np.int32).tobytes()

    def after_another(self, unit: str) -> list[int] | None:
        """The library's ids of a unit after the first of some signs that no piece joins to it; None if all are joined."""
        for sign in (";", "(", "z", "7"):
            head, whole = self.library.encode([sign, (sign + unit).replace(MARK, " ")], num_threads=1)
            if whole[: len(head)] == head:
                return whole[len(head) :]
        return None

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[int]]:
        """Each text's ids as 32-bit integers, and of how many of its units the agenda's ids weren't the library's or couldn't be checked."""
        known, cut = self.known, self.units.findall
        known.age()
        split = [cut(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self.learn({u for s in split for u in s if not (u in known or u in known.older)})
        counts = [sum(u in self.differing for u in s) for s in split] if self.differing else [0] * len(split)
        return [b"".join(map(known.__getitem__, s)) for s in split], counts

    def decode(self, ids: list[bytes]) -> list[str]:
        return self.library.decode([np.frombuffer(x, np.int32).tolist() for x in ids], num_threads=1) if ids else []


@functools.cache
def encoder(model_file: str) -> Encoder:
    """One encoder per model and worker."""
    return Encoder(model_file)


def id_lists(ids: list[bytes]) -> pa.Array:
    """Lists of 32-bit integers from their bytes."""
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def encode_decode(docs: DataFrame, model_file: str) -> DataFrame:
    """Per row of docs: doc_id, ids (array of int), decoded (what those ids decode to), n_differing.

    n_differing counts the units of a text whose ids by the agenda weren't those
    of the library, which hold then; zero says that the agenda was right. Null
    and empty texts have no ids and decode to the empty text; whole texts,
    however long, are encoded; repeated rows and null ids get their results; of
    pairs of equal score the leftmost merges first; an empty table gives none.
    Other columns are not read.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(model_file)
        for whole in batches:
            for batch in slices(whole, "text", 500):
                ids, differing = one.encode(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), id_lists(ids), pa.array(one.decode(ids), pa.string()), pa.array(differing, pa.int32())], ["doc_id", "ids", "decoded", "n_differing"])

    rows = docs.select("doc_id", "text")
    return small_batches(rows).mapInArrow(encoded, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>, decoded string, n_differing int")
