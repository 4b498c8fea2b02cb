"""Importance resampling, the filter audit and the licence scan by brute force, on odd tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

from tests.llm.fixtures import documents, labels, odd_texts, prose
from tidefleet.llm import common, filter_audit, importance, license_scan

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOW))


def features(t):
    w = words(t)
    return [zlib.crc32(f.encode()) % 10000 for f in w + [" ".join(w[i : i + 2]) for i in range(len(w) - 1)]]


def resampled(rows, target):
    s, t = Counter(b for _, x in rows for b in features(x)), Counter(b for x in target for b in features(x))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((float(t[b]) + 1) * (total_s + 10000) / ((s[b] + 1) * float(total_t + 10000)))) for b in range(10000)]
    out = []
    for i, x in rows:
        f = features(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(x)) >= 20))
    placed = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    drawn = placed[: 25 * len(placed) // 100]
    ranks = defaultdict(list)
    for k, r in enumerate(drawn):
        ranks[r].append(k + 1)
    return [(*r[:4], ranks[r].pop(0) if ranks[r] else None) for r in out]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_resampling_by_brute_force(spark):
    texts = odd_texts() + [prose(i % 40, 15 + i % 30) for i in range(80)] + [prose(3, 40)] * 60
    ids = [None, 5, 5, *range(100, 97 + len(texts))]
    target = [prose(i, 30) for i in range(6)] + [None, "", prose(1, 30)]
    bench = documents(spark, target)
    found = importance.resample(documents(spark, texts, ids=ids), bench)
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert in_order(map(tuple, found.collect())) == in_order(resampled(list(zip(ids, texts, strict=True)), target))
    alone = importance.resample(documents(spark, texts[:20]), bench.limit(0))
    assert in_order(map(tuple, alone.collect())) == in_order(resampled(list(enumerate(texts[:20])), []))
    assert importance.resample(documents(spark, []), bench).collect() == []


def test_ties_go_to_smaller_ids(spark, monkeypatch):
    monkeypatch.setattr(importance, "noise", lambda doc_id: importance.F.lit(0))
    rows = importance.resample(documents(spark, [prose(1, 30)] * 41, ids=[*range(40, -1, -1)]), documents(spark, [prose(2, 9)]), percent=50).collect()
    assert sorted((r.rank, r.doc_id) for r in rows if r["rank"]) == [(i + 1, i) for i in range(20)]


def test_ranks_and_hot_groups(spark):
    tables = common.SharedTables(spark)
    rows = tables.keep(spark.range(5000).selectExpr("id", "id * 7919 % 1000 AS v", "if(id % 3 = 0, 0, id) AS g"))
    order = [x.id for x in sorted(rows.collect(), key=lambda x: (-x.v, x.id))]
    assert [r.id for r in sorted(common.ranked(rows, tables, common.F.desc("v"), common.F.asc("id")).collect(), key=lambda r: r["rank"])] == order
    groups = tables.keep(rows.groupBy("g").agg(common.F.count("*").alias("n"), common.F.min("id").alias("first")))
    joined = common.with_groups(rows, groups, ["g"], "n", 5000)
    assert sorted((r.id, r.n, r.first) for r in joined.collect()) == sorted((r.id, 1667 if r.g == 0 else 1, r.g) for r in rows.collect())
    plan = joined._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def audited(rows, marks):
    known = {}
    for i, q, t in marks:
        if i is not None:
            old = known.get(i, (None, None))
            known[i] = tuple(min((y for y in (a, b) if y is not None), default=None) for a, b in zip(old, (q, t), strict=True))
    first = {}
    for i, x, _ in rows:
        if i is not None:
            first[x or ""] = min(i, first.get(x or "", i))
    docs = []
    for i, x, part in rows:
        x = x or ""
        w = re.findall("[^\x20\x09-\x0d]+", x)
        fails = (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", x)) > 5 * len(x), bool(re.search(r"[#$%&*|]", x)), i is not None and i > first[x])
        docs.append((part or "", {f for f, y in zip("ABCDE", fails, strict=True) if y}, *known.get(i, (None, None))))
    out, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {d[0] for d in docs}:
            for step in range(1, 6):
                out[part, order, step] = [0] * 6
        for part, fails, q, t in docs:
            gone = min((order.index(f) + 1 for f in fails), default=6)
            for step, f in enumerate(order, 1):
                c = out[part, order, step]
                for k, y in enumerate((gone > step, gone == step, f in fails and gone < step, fails == {f}, gone == step and q == 1, gone == step and t == 1)):
                    c[k] += y
            if gone < 6:
                shapley[part, order[gone - 1]] += 1
    return sorted((*k, *c, shapley[k[0], k[1][k[2] - 1]]) for k, c in out.items())


def test_audit_by_brute_force(spark):
    texts = odd_texts() + ["LOUD " * 60, prose(5, 70) + " $", prose(5, 70), prose(5, 70), "word " * 80, prose(6, 55).upper(), prose(7, 90)] + [prose(8, 64)] * 20
    sources = [("s0", "s1", None, "")[i % 4] for i in range(len(texts))]
    ids = [None, 3, 3, *range(7, 4 + len(texts))]
    marks = [(3, 1, 1), (3, 0, 1), (9, 1, None), (None, 1, 1), (12, 1, 0), (20, 0, 1), (21, 1, 1), (25, 1, 0)]
    docs, known = documents(spark, texts, sources, ids), labels(spark, marks)
    found = filter_audit.audit(docs, known)
    assert found.columns == ["part", "filter_order", "step", *filter_audit.COUNTS, "shapley"]
    assert sorted(map(tuple, found.collect())) == audited(list(zip(ids, texts, sources, strict=True)), marks)
    assert all(r.good_lost == r.toxic_lost == 0 for r in filter_audit.audit(docs, known.limit(0)).collect())
    assert filter_audit.audit(documents(spark, []), known).collect() == []


def places(w, phrase):
    p = phrase.split()
    return [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]


def test_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    texts = odd_texts() + [
        "Released under the MIT License. Under the mit  license", "x CC BY-NC 4.0", "cc by nc cc by nc", "under the new mit license", prose(1, 300) + "\n" + mit + "\n" + prose(2, 50), mit.replace("associated", "other"), "free of charge to any person a copy",
        "This work is licensed under the GNU General Public License, version 3.", "licensed under the gnu public license", "Apache License, Version 2.0 " * 3000, "apache license version 2", "license version apache 2", "Redistribution, and use, in source and binary forms, with or without any modification, are permitted provided that these following conditions are met",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
    ]
    found = {r.doc_id: r for r in license_scan.scan(documents(spark, texts + texts[-3:-2])).collect()}
    for i, t in enumerate(texts):
        w, r = words(t), found[i]
        at = {p.label: places(w, p.text) for p in license_scan.PHRASES}
        every = sorted(x for v in at.values() for x in v)
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(every), every[0] if every else None, every[-1] if every else None), t
        assert r.base_labels == ",".join(sorted(k for k, v in at.items() if v)) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    own = [found[i].labels for i in range(len(odd_texts()), len(texts))]
    assert own == ["mit", "cc-by-nc", "cc-by-nc", "", "mit", "", "", "gpl-3", "", "apache-2", "apache-2", "", "bsd", "agpl-3"]
    assert all((r.score > 0) == (r.labels != "") for r in found.values())
    again = license_scan.scan(documents(spark, [texts[-2], texts[-2]], ids=[None, None])).collect()
    assert len(again) == 2 and again[0] == again[1] and again[0].labels == "bsd"
    assert license_scan.scan(documents(spark, [])).collect() == []


def test_license_scan_needs_no_python_and_shuffles_no_texts(spark):
    plan = license_scan.scan(documents(spark, odd_texts()))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_rare_words_are_those_of_the_documents(spark):
    t = license_scan.Template("x", "alpha beta gamma delta", ("alpha beta",))
    texts = ["alpha beta", "alpha gamma", "alpha beta delta", "alpha beta gamma"] * 3
    frequencies = license_scan.document_frequencies(documents(spark, texts), (t,))
    assert frequencies == {"": 12, "alpha": 12, "beta": 9, "gamma": 6, "delta": 3}
    postings, listed = license_scan.index((t,), frequencies)
    assert postings == {"delta": [{"template": 0, "at": 3}]} and [a["word"] for a in listed[0]["anchors"]] == ["delta", "gamma", "beta", "alpha"]
