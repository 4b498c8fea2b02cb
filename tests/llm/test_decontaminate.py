import re

from tests.llm.fixtures import documents, odd_texts, prose
from tidefleet.llm import decontaminate as D

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOW))


def plain(texts, items):
    windows = {}
    for item, t in items:
        w = words(t)
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add("" if item is None else str(item))
    out = []
    for t in texts:
        w, hit, who = words(t), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if found := windows.get(tuple(w[i : i + m])):
                    hit |= set(range(i, i + m))
                    who |= found
        out.append((len(w), len(hit), sorted(who)))
    return out


def tables(spark):
    item = prose(7, 25)
    items = [(1, item), (2, prose(8, 14)), (10, item), (3, "Only, Four-words here"), (4, None), (5, "!!!"), (None, prose(9, 11)), (6, "É dort")]
    texts = odd_texts() + [prose(20, 30) + " " + " ".join(item.split()[3:18]) + " " + prose(21, 30), item.upper().replace(" ", ", "), "so only four; words here and", prose(8, 14) + " " + prose(8, 14), "é dort É DORT", prose(9, 11)]
    return texts, items, spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_hit string")


def test_brute_force_and_blocks(spark):
    texts, items, bench = tables(spark)
    expected = plain(texts, items)
    for most in (D.BROADCAST_WINDOWS, 7):
        found = {r.doc_id: r for r in D.contamination(documents(spark, texts), bench, most).collect()}
        assert [(found[i].n_words, found[i].n_hit, found[i].item_ids) for i in range(len(texts))] == expected
        assert all(found[i].contaminated == (found[i].n_hit > 0) for i in found)


def test_rows_are_kept_apart(spark):
    texts, items, bench = tables(spark)
    docs = documents(spark, [items[0][1], prose(30, 20), items[0][1], "x"], ids=[1, 1, None, None])
    found = sorted((r.n_words, r.n_hit) for r in D.contamination(docs, bench).collect())
    assert found == [(1, 0), (20, 0), (25, 25), (25, 25)]
    assert D.drop_contaminated(docs, bench, broadcast_rows=0).count() == 2
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.text for r in kept.collect()) == sorted(["x", prose(30, 20)])


def test_spans_are_cut(spark):
    _, items, bench = tables(spark)
    docs = documents(spark, ["Start, here. " + items[0][1] + "! end", "clean text", None])
    cut = {r.doc_id: r.text for r in D.remove_spans(docs, bench).collect()}
    assert words(cut[0]) == ["start", "here", "end"] and cut[0].startswith("Start, here. ") and cut[1] == "clean text" and cut[2] is None


def test_empty_tables(spark):
    texts, _, bench = tables(spark)
    assert D.contamination(documents(spark, []), bench).collect() == []
    assert not any(r.contaminated for r in D.contamination(documents(spark, texts), bench.limit(0)).collect())
