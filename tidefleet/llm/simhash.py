"""SimHash near-duplicates found through Golay-code keys.

A 64-bit fingerprint is three segments of 21, 21 and 22 bits. A segment decodes,
as it is and with each of its bits flipped, to the indices of nearby words of
the binary Golay code (23, 12, 7): six at most, and any two segments that differ
in two bits or fewer share one. Two fingerprints that differ in four bits or
fewer either agree in a whole segment, so that one of the other two differs in
two bits or fewer, or differ in every segment, so that two segments differ in one
bit (one of their halves agrees) and the third in two or fewer. Keys for both
cases are joined, every candidate pair is verified, and links are followed to
components.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefleet.llm.common import SharedTables, as_row, slices, small_batches, with_groups

SHINGLE, SEED, MOST_BITS = 4, 42, 4
SEGMENTS = ((0, 21), (21, 21), (42, 22))  # first bit, bits
GENERATOR = 0b110001110101  # of the Golay code
#: Fingerprints of one key that are compared in one piece; more get narrower keys, and where even one of those has more, pieces are compared in tasks of their own.
PIECE = 16_384
#: Parts that the bits which a key leaves open are dealt into: of MOST_BITS + 2, two agree at least.
PARTS = MOST_BITS + 2
#: Links whose components one task finds at a time.
LOCAL_LINKS = 100_000
#: Fingerprints whose keys, about ninety each, one task makes.
KEYED_ROWS = 50_000
#: Rows to leave out whose hashes a broadcast may hold (about 64 MB); with more, rows are joined by their hashes.
BROADCAST_ROWS = 1_000_000


def fingerprint(text: bytes | None) -> int:
    """Fingerprint of a UTF-8 text; null and texts without words: zero. bytes.lower and bytes.split know ASCII only, as asked."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - SHINGLE + 1)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    ends = starts[min(SHINGLE, len(words)) :]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, 65_536):
        raw = b"".join([digest(line[a : b - 1], SEED) for a, b in zip(starts[at : min(n, at + 65_536)], ends[at:], strict=False)])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text and further columns to doc_id, fp and those."""
    for batch in batches:
        each = np.array([fingerprint(t) for part in slices(batch, "text") for t in part.column(1).cast(pa.binary()).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(each.view(np.int64)), *batch.columns[2:]], ["doc_id", "fp", *batch.schema.names[2:]])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text, as a signed long."""
    rows = docs.select("doc_id", "text")
    return small_batches(rows).mapInArrow(_fingerprints, f"doc_id {dict(rows.dtypes)['doc_id']}, fp long")


@functools.cache
def _decoder() -> np.ndarray:
    """Index of the Golay codeword nearest to each 23-bit word."""

    def remainder(x: np.ndarray) -> np.ndarray:
        for bit in range(22, 10, -1):
            x = np.where(x >> bit & 1, x ^ (GENERATOR << (bit - 11)), x)
        return x

    one = 1 << np.arange(23)
    errors = np.array([0, *one, *(a | b for i, a in enumerate(one) for b in one[:i]), *(a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j])])
    leader = np.zeros(2048, np.int64)
    leader[remainder(errors)] = errors
    out = np.empty(1 << 23, np.uint16)
    for at in range(0, 1 << 23, 1 << 17):  # in pieces: the whole would take hundreds of MB on its way
        words = np.arange(at, at + (1 << 17))
        out[at : at + (1 << 17)] = (words ^ leader[remainder(words)]) >> 11
    return out


def _indices(segment: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and indices of the codewords near each segment, each once."""
    flips = np.concatenate([[0], 1 << np.arange(bits)])
    near = np.sort(_decoder()[segment[:, None] ^ flips], axis=1)
    new = np.ones(near.shape, bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    rows, at = np.nonzero(new)
    return rows, near[rows, at].astype(np.int64)


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) rows: fingerprints that differ in MOST_BITS bits or fewer share a key."""
    parts = [((fps >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS]
    halves = [[p & 0x3FF, p >> 10] for p in parts]
    out, source, kind = [], [], 0
    for c, (_, bits) in enumerate(SEGMENTS):
        rows, index = _indices(parts[c], bits)
        a, b = (x for x in range(3) if x != c)
        exact = [parts[a], parts[b], *(x | y << 12 for x in halves[a] for y in halves[b])]
        for value in exact:
            out.append((kind << 40) | (value[rows] << 12) | index)
            source.append(fps[rows])
            kind += 1
    return np.concatenate(out), np.concatenate(source)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(fps), 2000):
            key, fp = keys(fps[at : at + 2000])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp.view(np.int64))], ["key", "fp"])


def _open_bits(kind: int) -> list[int]:
    """Bits of a fingerprint that a key of this kind doesn't fix: 43 for a whole segment, 41 to 44 for two halves. Key kinds as keys numbers them."""
    c, way = divmod(kind, 6)
    a, b = (x for x in range(3) if x != c)
    half = lambda s, high: set(range(SEGMENTS[s][0] + (10 if high else 0), SEGMENTS[s][0] + (SEGMENTS[s][1] if high else 10)))
    fixed = half((a, b)[way], 0) | half((a, b)[way], 1) if way < 2 else half(a, way - 2 >> 1) | half(b, way - 2 & 1)
    return [bit for bit in range(64) if bit not in fixed]


def narrower_keys(key: int, fps: np.ndarray) -> Iterator[np.ndarray]:
    """Fifteen longs for each fingerprint of a key: any two that differ in MOST_BITS bits or fewer have one in common.

    All have the bits that the key fixes, so they differ in the open ones only.
    Those are dealt into PARTS parts, of which two agree; each two parts, fourteen
    bits or so, are a narrower key. Keys are hashes: two that fall together cost
    comparisons, no links.
    """
    bits = _open_bits(key >> 40)
    masks = [sum(1 << bit for bit in bits[i::PARTS]) for i in range(PARTS)]
    for n, (one, other) in enumerate(combinations(masks, 2)):
        seed = xxhash.xxh64_intdigest(f"{key}:{n}")
        mixed = ((fps & np.uint64(one | other)) ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        yield ((mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def _narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (key, fps) as (key, fp) of narrower keys."""
    for batch in batches:
        for at, key in enumerate(batch.column(0).to_pylist()):
            fps = batch.column(1)[at].values
            for narrow in narrower_keys(key, fps.to_numpy(zero_copy_only=False).view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(narrow), fps], ["key", "fp"])


def spanning_links(fps: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(one, others): verified links that connect what links of MOST_BITS bits or fewer connect; one less than there are fingerprints at most.

    Each fingerprint is compared with those that nothing has reached yet, so
    dense groups take few comparisons and no pair is listed twice.
    """
    out, rest = [], fps
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            one = reached.pop()
            near = np.bitwise_count(rest ^ one) <= MOST_BITS
            if near.any():
                found = rest[near]
                out.append((one, found))
                reached.extend(found)
                rest = rest[~near]
    return out


def _link_batch(pairs: list[tuple[np.ndarray, np.ndarray]], pieces: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    a = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.uint64)
    b = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.uint64)
    n, m = len(a), len(pieces)
    low, high = np.minimum(a.view(np.int64), b.view(np.int64)), np.maximum(a.view(np.int64), b.view(np.int64))
    columns = [
        pa.array([*low, *[None] * m], pa.int64()) if m else pa.array(low),
        pa.array([*high, *[None] * m], pa.int64()) if m else pa.array(high),
        pa.array([None] * n + [p[0] for p in pieces], pa.int64()),
        pa.array([None] * n + [p[1] for p in pieces], pa.int32()),
        pa.array([None] * n + [p[2].view(np.int64) for p in pieces], pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "key", "piece", "fps"])


LINKS = "a long, b long, key long, piece int, fps array<long>"


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among the fingerprints of each key; rows come sorted by key. What exceeds PIECE for one key goes out in pieces instead."""
    key, fps, piece = np.zeros(0, np.int64), np.zeros(0, np.uint64), 0

    def linked(runs: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        two = [r for r in runs if len(r) == 2]
        out = []
        if two:
            pair = np.stack(two)
            pair = pair[np.bitwise_count(pair[:, 0] ^ pair[:, 1]) <= MOST_BITS]
            out.append((pair[:, 0], pair[:, 1]))
        for r in runs:
            if len(r) > 2:
                out += [(np.full(len(others), one, np.uint64), others) for one, others in spanning_links(r)]
        return out

    for batch in batches:
        key = np.concatenate([key, batch.column(0).to_numpy(zero_copy_only=False)])
        fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(key):
            continue
        edges = np.flatnonzero(np.diff(key)) + 1
        pieces, runs = [], []
        if len(edges):
            if piece:  # the key that came in pieces ends here
                pieces.append((int(key[0]), piece, fps[: edges[0]]))
                piece = 0
            else:
                runs.append(fps[: edges[0]])
            sizes = np.diff(edges)
            runs += [fps[edges[i] : edges[i + 1]] for i in np.flatnonzero(sizes > 1)]
            key, fps = key[edges[-1] :], fps[edges[-1] :]
        while len(fps) > PIECE:
            pieces.append((int(key[0]), piece, fps[:PIECE]))
            piece += 1
            key, fps = key[PIECE:], fps[PIECE:]
        pairs = linked([r for r in runs if len(r) > 1])
        if pairs or pieces:
            yield _link_batch(pairs, pieces)
    if piece and len(fps):
        yield _link_batch([], [(int(key[0]), piece, fps)])
    elif len(fps) > 1 and (pairs := linked([fps])):
        yield _link_batch(pairs, [])


def _piece_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            both = np.array([*x, *(y or [])], np.int64).view(np.uint64)
            pairs = [(np.full(len(others), one, np.uint64), others) for one, others in spanning_links(both)]
            if pairs:
                yield _link_batch(pairs, [])


def _local_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a task, replaced by links to the smallest member they reach, LOCAL_LINKS at a time."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.setdefault(top, top)) != top:
            top = up
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    def out() -> pa.RecordBatch:
        rows = [(x, r) for x in list(root) if (r := find(x)) != x]
        root.clear()
        return pa.RecordBatch.from_arrays([pa.array([r for _, r in rows], pa.int64()), pa.array([x for x, _ in rows], pa.int64())], ["a", "b"])

    seen = 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
        seen += batch.num_rows
        if seen > LOCAL_LINKS:
            yield out()
            seen = 0
    yield out()


def components(links: DataFrame, tables: SharedTables) -> DataFrame:
    """(node, root): each linked node but the smallest of its component, with that smallest one.

    Large-star and small-star rounds, each a groupBy and a join, until nothing
    changes; links stay as many as nodes at most, whatever the size of a group.
    """
    now = tables.keep(links.select("a", "b").mapInArrow(_local_components, "a long, b long").distinct(), few=True)
    before = None
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("least")).select("n", F.least("n", "least").alias("least"))
        large = both.join(least, F.col("a") == F.col("n")).filter("b > a and least < b").select(F.col("least").alias("a"), "b").distinct()  # a < b
        down = large.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("least"))
        small = large.join(down, F.col("b") == F.col("n")).select("a", "b", "least")
        star = small.select(F.col("least").alias("x"), F.col("a").alias("y")).unionAll(down.select(F.col("least").alias("x"), F.col("n").alias("y"))).filter("x <> y").distinct()
        after = tables.keep(star.select(F.col("x").alias("a"), F.col("y").alias("b")), few=True)
        tables.drop(now)
        state = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).collect()[0]
        now = after
        if state == before or not state[0]:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = state


def _row_hash(text: Column, doc_id: Column) -> list[Column]:
    """Two hashes that tell rows apart by id and text."""
    text, doc_id = F.coalesce(text, F.lit("")), F.coalesce(doc_id.cast("string"), F.lit("null"))
    return [F.xxhash64(doc_id, text).alias("h1"), F.xxhash64(text, F.lit(1), doc_id).alias("h2")]


def with_components(prints: DataFrame, tables: SharedTables) -> DataFrame:
    """prints, rows with doc_id and fp, with root, one fingerprint for each component, and component_id, the smallest doc_id that links reach."""
    members = tables.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("copies")))
    tasks = max(-(-members.count() // KEYED_ROWS), members.sparkSession.sparkContext.defaultParallelism)
    links, pieces = linked(members.select("fp").repartition(tasks, "fp").mapInArrow(_keyed, "key long, fp long"), tables)
    if not pieces.isEmpty():
        more, pieces = linked(pieces.select("key", "fps").mapInArrow(_narrowed, "key long, fp long"), tables)
        links = links.unionAll(more)
        if not pieces.isEmpty():
            links = links.unionAll(crossed(pieces))
    roots = components(links, tables)
    rooted = members.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least_id", "copies", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = tables.keep(rooted.join(least, "root").select("fp", "copies", "root", "component_id"))
    return with_groups(prints, named, ["fp"], "copies", prints.count()).drop("copies")


def linked(keyed: DataFrame, tables: SharedTables) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) among the fingerprints of each key of (key, fp), and what is too much for one task: pieces (key, piece, fps)."""
    found = tables.keep(keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_links, LINKS), few=True)
    return found.filter("a is not null").select("a", "b"), found.filter("piece is not null").select("key", "piece", "fps")


def crossed(pieces: DataFrame) -> DataFrame:
    """(a, b): links among the pieces (key, piece, fps) of each key, of which each has two at least; every pair of pieces is a unit of its own."""
    counted = pieces.groupBy("key").agg(F.count("*").alias("n"))
    pairs = counted.agg(F.sum(F.expr("n * (n - 1) div 2"))).collect()[0][0]
    tasks = max(pieces.sparkSession.sparkContext.defaultParallelism, min(2000, pairs))
    mine = pieces.join(counted, "key").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).filter("other <> piece")
    mine = mine.select("key", "piece", "fps", F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high")).repartition(tasks, "key", "low", "high")
    both = mine.groupBy("key", "low", "high").agg(F.min_by("fps", "piece").alias("fps"), F.max_by("fps", "piece").alias("more"))
    return both.select("fps", "more").mapInArrow(_piece_links, LINKS).select("a", "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, fp (signed long) and component_id, the smallest doc_id that links reach.

    Null and empty texts have fingerprint zero and are linked like any other;
    texts of any length are hashed whole. Repeated rows and rows of one id each
    get their result; a null id never is a component's smallest unless there is
    no other. An empty table gives an empty result. Other columns are not read.
    """
    tables = SharedTables(docs.sparkSession)
    return with_components(tables.keep(fingerprints(docs)), tables).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """docs with one document of each group: the one of the smallest doc_id. Columns stay as they are.

    Null and empty texts are one group. Of rows of one id and one text one stays,
    by the order of their other columns; of rows of one id and different texts
    each group keeps one, that of the least hash. Rows without an id stay only in
    groups where no row has one. An empty table stays empty. Texts aren't
    shuffled unless there are more than broadcast_rows rows to leave out.
    """
    tables = SharedTables(docs.sparkSession)
    hashed = docs.select("doc_id", "text", *_row_hash(F.col("text"), F.col("doc_id")))
    prints = tables.keep(small_batches(hashed).mapInArrow(_fingerprints, f"doc_id {dict(docs.dtypes)['doc_id']}, fp long, h1 long, h2 long"))
    each = with_components(prints, tables).groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("root").alias("root"), F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("least"))
    each = tables.keep(each)
    best = each.filter("least").groupBy("root").agg(F.min(F.struct("h1", "h2")).alias("one")).select("one.*")
    gone = tables.keep(each.join(best, ["h1", "h2"], "left_anti").select("h1", "h2"))
    again = tables.keep(each.filter("n > 1").join(best, ["h1", "h2"], "left_semi").select("h1", "h2"))
    repeated = again.count()
    rows = as_row(docs)
    rows = rows.select("row", *_row_hash(F.col("row.text"), F.col("row.doc_id")))
    rest = F.to_json(F.struct(F.lit(0).alias("0"), *(F.col(f"row.`{c}`") for c in docs.columns if c != "text")))
    if gone.count() + repeated <= broadcast_rows:
        once = rows.join(F.broadcast(gone.unionAll(again)), ["h1", "h2"], "left_anti").select("row.*")
        if not repeated:
            return once
        several = rows.join(F.broadcast(again), ["h1", "h2"], "left_semi")
        return once.unionAll(several.groupBy("h1", "h2").agg(F.min_by("row", rest).alias("row")).select("row.*"))
    kept = rows.join(each.join(gone, ["h1", "h2"], "left_anti").select("h1", "h2"), ["h1", "h2"], "left_semi")
    return (kept.groupBy("h1", "h2").agg(F.min_by("row", rest).alias("row")) if repeated else kept).select("row.*")
