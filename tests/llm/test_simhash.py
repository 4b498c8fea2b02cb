import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tests.llm.fixtures import documents, odd_texts, prose
from tidefleet.llm import simhash as S
from tidefleet.llm.common import SharedTables

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> k & 1 for h in hashes) > len(hashes)) << k for k in range(64)) if hashes else 0


def plain_components(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, p in enumerate(prints):
        for j in range(i):
            if bin(p ^ prints[j]).count("1") <= 4 and (a := find(i)) != (b := find(j)):
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_odd_texts_and_brute_force(spark):
    texts = odd_texts() + [prose(5, 200) + f" w{i % 7}" for i in range(40)] + [prose(50 + i, 30) for i in range(40)]
    found = {r.doc_id: r for r in S.near_duplicates(documents(spark, texts)).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    assert [found[i].fp & (2**64 - 1) for i in range(len(texts))] == prints
    assert [found[i].component_id for i in range(len(texts))] == plain_components(prints)


def test_keys_are_shared_within_four_bits():
    r = np.random.default_rng(3)
    for n in range(500):
        u = v = r.integers(0, 1 << 64, dtype=np.uint64)
        for b in r.choice(64, n % 5, replace=False):
            v ^= np.uint64(1) << np.uint64(b)
        assert set(S.keys(np.array([u]))[0].tolist()) & set(S.keys(np.array([v]))[0].tolist())


def test_decoder_is_perfect():
    index, size = np.unique(S._decoder(), return_counts=True)
    assert len(index) == 4096 and (size == 2048).all()


def test_runs_in_pieces_lose_no_link(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 5)
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 64, dtype=np.uint64)
    fps = np.unique(np.array([base ^ (np.uint64(1) << np.uint64(b)) for b in r.integers(0, 64, 40)] + [r.integers(0, 1 << 64, dtype=np.uint64) for _ in range(4)], np.uint64))
    keys = np.concatenate([np.full(len(fps), 7), [8, 8, 9]])
    rows = np.concatenate([fps, fps[:2], fps[:1]])
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[a : a + 6]), pa.array(rows[a : a + 6].view(np.int64))], ["key", "fp"]) for a in range(0, len(keys), 6)]
    found = pa.Table.from_batches(list(S._links(iter(batches)))).to_pylist()
    links = [(x["a"], x["b"]) for x in found if x["a"] is not None]
    pieces = [x for x in found if x["piece"] is not None]
    assert sorted(f for p in pieces for f in p["fps"]) == sorted(fps.view(np.int64).tolist())
    for i, p in enumerate(pieces):
        for q in pieces[:i]:
            batch = pa.RecordBatch.from_arrays([pa.array([p["fps"]]), pa.array([q["fps"]])], ["x", "y"])
            links += [(x["a"], x["b"]) for b in S._piece_links(iter([batch])) for x in b.to_pylist()]
    order = {f: i for i, f in enumerate(fps.view(np.int64).tolist())}
    root = list(range(len(order)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(order[a]), find(order[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(order))] == plain_components(fps.tolist())


@pytest.mark.parametrize("most", [S.BROADCAST_ROWS, 0])
def test_one_of_each_group_stays(spark, most):
    texts = [prose(1, 50), prose(1, 50), prose(2, 50), None, "", prose(2, 50)]
    docs = documents(spark, texts, ids=[4, 2, 9, 7, 8, None])
    kept = S.drop_near_duplicates(docs, most)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7, 9]
    twice = documents(spark, [prose(3, 20)] * 3, sources=["b", "a", "c"], ids=[5, 5, 5])
    assert [r.source for r in S.drop_near_duplicates(twice, most).collect()] == ["a"]


@pytest.mark.parametrize("most", [S.BROADCAST_ROWS, 0])
def test_rows_of_one_id_are_kept_apart(spark, most):
    """Two texts of id 1 are groups of their own: one is a copy of id 0's and goes, the other stays; of two texts of one group and id one stays."""
    near = prose(6, 200)
    docs = documents(spark, [prose(1, 50), prose(1, 50), prose(2, 50), near + " x", near + " y", prose(4, 30), prose(4, 30), prose(5, 30)], ids=[0, 1, 1, 3, 3, None, None, None])
    kept = sorted((r.doc_id if r.doc_id is not None else -1, r.text[-1:]) for r in S.drop_near_duplicates(docs, most).collect())
    assert [k[0] for k in kept] == [-1, -1, 0, 1, 3]


def test_ten_thousand_fingerprints_of_one_key(spark, monkeypatch):
    """Pieces of one key are compared pair by pair, in several tasks, and lose no link."""
    r = np.random.default_rng(8)
    one = r.integers(0, 1 << 64, dtype=np.uint64)
    fps = np.unique([one ^ sum((np.uint64(1) << np.uint64(b) for b in r.choice(64, 3, replace=False)), np.uint64(0)) for _ in range(10_000)]).astype(np.uint64)
    rows = [(7, i, [int(f) for f in fps[at : at + 1500].view(np.int64)]) for i, at in enumerate(range(0, len(fps), 1500))]
    pieces = spark.createDataFrame(rows, "key long, piece int, fps array<long>")
    found = S.crossed(pieces)
    assert found.rdd.getNumPartitions() >= len(rows) * (len(rows) - 1) // 2
    root = {int(f): int(f) for f in fps.view(np.int64)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for link in found.collect():
        assert bin((link.a ^ link.b) & (2**64 - 1)).count("1") <= 4
        a, b = find(link.a), find(link.b)
        root[max(a, b)] = min(a, b)
    expected = S.spanning_links(fps)
    assert len({find(int(f)) for f in fps.view(np.int64)}) == len(fps) - sum(len(others) for _, others in expected)


@pytest.mark.parametrize("kind", range(18))
def test_narrower_keys_are_shared_within_four_bits(kind):
    """Fingerprints that share a key of any kind have a narrower one in common, if they differ in four bits or fewer; else mostly none."""
    r = np.random.default_rng(kind)
    bits = S._open_bits(kind)
    assert 41 <= len(bits) <= 44
    key = kind << 40
    near = far = 0
    for n in range(200):
        u = r.integers(0, 1 << 64, dtype=np.uint64)
        v, w = u, u
        for b in r.choice(bits, n % 5, replace=False):
            v ^= np.uint64(1 << int(b))
        for b in r.choice(bits, 20, replace=False):
            w ^= np.uint64(1 << int(b))
        of_u, of_v, of_w = ({int(k[0]) for k in S.narrower_keys(key, np.array([x], np.uint64))} for x in (u, v, w))
        near += bool(of_u & of_v)
        far += bool(of_u & of_w)
    assert near == 200 and far < 10


def test_open_bits_are_those_that_keys_leave_open():
    """A flipped bit outside the codeword's segment and the open bits changes the key; one among them outside that segment doesn't."""
    r = np.random.default_rng(1)
    u = r.integers(0, 1 << 64, dtype=np.uint64)
    for kind in range(18):
        at, size = S.SEGMENTS[kind // 6]
        of_kind = lambda x: {k for k in S.keys(np.array([x], np.uint64))[0].tolist() if k >> 40 == kind}  # noqa: B023, E731
        for b in set(range(64)) - set(range(at, at + size)):
            assert (of_kind(u) == of_kind(u ^ np.uint64(1 << b))) == (b in S._open_bits(kind))


def test_a_key_of_twenty_thousand_fingerprints(spark):
    """More than a piece of one segment and codeword get narrower keys: all links are kept, and components are those of brute force."""
    r = np.random.default_rng(11)
    first, low = r.integers(0, 1 << 21), r.integers(0, 1 << 21, 20_000)
    ball = [sum(1 << int(b) for b in r.choice(22, r.integers(0, 4), replace=False)) for _ in range(20_000)]
    fps = np.unique(np.array([int(first) | int(m) << 21 | c << 42 for m, c in zip(low, ball, strict=True)], np.uint64))
    assert len(fps) > S.PIECE
    prints = spark.createDataFrame([(i, int(f)) for i, f in enumerate(fps.view(np.int64))], "doc_id long, fp long")
    found = {row.doc_id: row.component_id for row in S.with_components(prints, SharedTables(spark)).collect()}
    place = {int(f): i for i, f in enumerate(fps)}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for one, others in S.spanning_links(fps):
        for other in others:
            a, b = find(place[int(one)]), find(place[int(other)])
            root[max(a, b)] = min(a, b)
    expected = [find(i) for i in range(len(fps))]
    assert [found[i] for i in range(len(fps))] == expected
    assert 100 < len(set(expected)) < len(fps) - 100


def test_a_fingerprint_of_most_rows(spark):
    """Copies beyond a task's share meet their group by broadcast; every row gets its component."""
    texts = [prose(1, 50)] * 300 + [""] * 5 + [prose(9 + i, 50) for i in range(3)]
    found = {r.doc_id: r.component_id for r in S.near_duplicates(documents(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == [0] * 300 + [300] * 5 + [305, 306, 307]


def test_empty_table(spark):
    assert S.near_duplicates(documents(spark, [])).collect() == []
