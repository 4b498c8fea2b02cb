"""Token ids in ORC: run-length encoded integers, row indexes, Bloom filters on document ids.

Files hold documents in ascending doc_id order, one range of ids a file; each
row knows its place in its file (row_id) and how many ids stand before it there
(before), so that stripes can be read in parallel and in any order.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidefleet.llm.common import Remembered, slices, small_batches, spread

END_ID = 2
ORC = {
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true", "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20), "orc.encoding.strategy": "SPEED", "compression": "zstd",
}
FILE_SCHEMA = "doc_id {0}, before long, n_tokens long, ids array<int>"
#: Letters that normalization leaves as they are, but for their case, whatever stands around them, but for a combining mark; and signs that are tokenized alone after letters.
PLAIN_WORD = "^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<sign>[.,;:!?]?)$"
#: Entries in each generation of a worker's cache, and words in one call of the library.
REMEMBERED, TOGETHER = 300_000, 200


class Encoder:
    """The tokenizers library, asked once for each different piece of text between blanks that a worker remembers.

    A blank or a line's end separates tokens for good in a vocabulary that drops
    white space, and a final sign is a token of its own after plain letters.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_file)
        self.known = Remembered(REMEMBERED)
        suffix = json.loads(self.library.to_str())["model"].get("end_of_word_suffix")
        vocabulary = self.library.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word, where the vocabulary tells
        if suffix:
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _ask(self, pieces: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(pieces, add_special_tokens=False) if pieces else []
        return [np.array(e.ids, np.uint32).tobytes() for e in found]

    def _ask_words(self, words: list[str]) -> list[bytes]:
        """The same for words that are one token run each: many in one text, cut where words end."""
        out: list[bytes] = []
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            ids = np.array(self.library.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends = 4 * (np.flatnonzero(self.last[ids]) + 1)
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)] if len(ends) == len(some) else self._ask(some)
        return out

    def _listed(self, atoms: pa.Array, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of atoms, and where each atom's begin and how many it has; plain says which atoms are words."""
        coded = atoms.dictionary_encode()
        different, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        known = self.known
        known.age()
        new = [i for i, a in enumerate(different) if not known.has(a)]
        is_word = np.zeros(len(different), bool)
        is_word[at[plain]] = True
        for which, ask in ((True, self._ask_words), (False, self._ask)):
            some = [different[i] for i in new if is_word[i] == which]
            known.update(zip(some, ask(some), strict=True))
        found = [known[a] for a in different]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), np.uint32), (np.cumsum(size) - size)[at], size[at]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text begins; the last entry is the end.

        Arrow cuts the texts into pieces and parts words from signs; only different ones are looked up one by one.
        """
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        pieces, at = coded.dictionary, coded.indices.to_numpy()
        parts = pc.extract_regex(pieces, PLAIN_WORD)
        plain = pc.is_valid(parts)
        word = pc.if_else(plain, pc.utf8_lower(pc.struct_field(parts, "word")), pieces)
        sign = pc.if_else(plain, pc.struct_field(parts, "sign"), "")
        ids, first, size = self._listed(word, plain.to_numpy(zero_copy_only=False))
        sign_ids, sign_first, sign_size = self._listed(sign.cast(pa.large_string()), np.zeros(len(pieces), bool))
        both = np.stack([size, sign_size], 1)
        listed = spread(np.concatenate([ids, sign_ids]), np.stack([first, len(ids) + sign_first], 1).ravel(), both.ravel())
        size = both.sum(1)
        sizes = size[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        offsets = split.offsets.to_numpy()
        return spread(listed, (np.cumsum(size) - size)[at], sizes), ends[offsets - offsets[0]]


@functools.cache
def encoder(tokenizer_file: str) -> Encoder:
    """One encoder per vocabulary and worker."""
    return Encoder(tokenizer_file)


def write(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID) -> None:
    """Encode every whole text of docs and write the ids, with end_id after each document, to ORC files at path.

    Null and empty texts have the end id only; texts of any length are encoded
    whole; null ids come first; rows of one id keep an order of their own, by
    their texts; an empty table gives a file without rows. Other columns are not
    read. Rows of one id, or without one, come to one file, as files are ranges
    of ids.
    """
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, before = encoder(tokenizer_file), 0
        for whole in batches:
            for batch in slices(whole, "text", 2000, 4 << 20):
                ids, begin = one.encode(batch.column(1))
                begin = begin + np.arange(len(begin))  # with the end ids before
                lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(np.insert(ids, begin[1:] - np.arange(1, len(begin)), end_id).view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(before + begin[:-1]), pa.array(np.diff(begin)), lists], ["doc_id", "before", "n_tokens", "ids"])
                before += int(begin[-1])

    rows = docs.select("doc_id", "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = small_batches(ordered).mapInArrow(encoded, FILE_SCHEMA.format(dict(rows.dtypes)["doc_id"])).withColumn("row_id", F.monotonically_increasing_id())
    files.write.options(**ORC).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, row_id, start, n_tokens, ids): the files' documents; start counts the ids of all documents before.

    Every written row comes back once, repeated ones and those without an id too;
    empty texts hold the end id alone; files of an empty table give none.
    """
    files = spark.read.orc(path)
    shard = F.shiftright("row_id", 33)  # the upper bits are the writing task's number, which follows doc_id
    sums = files.groupBy(shard.alias("shard")).agg(F.sum("n_tokens").alias("tokens"))  # a row per file
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("shard", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("first"))
    joined = files.withColumn("shard", shard).join(F.broadcast(starts), "shard")
    return joined.select("doc_id", "row_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        flat, ends = memoryview(ids.values.to_numpy().astype("<u4", copy=False)).cast("B"), ids.offsets.to_numpy().astype(np.int64) * 4
        crc = pa.array([zlib.crc32(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)], pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), crc], ["doc_id", "start", "n_tokens", "ids_crc32"])


def checksums(read_back: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of documents that read() gave, a row each, null ids and repeated rows too; none of none."""
    rows = read_back.select("doc_id", "start", "n_tokens", "ids")
    return rows.mapInArrow(_checksums, f"doc_id {dict(rows.dtypes)['doc_id']}, start long, n_tokens long, ids_crc32 long")
