"""Quality rules, lines, tokens, urls and pages on odd tables and against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm.fixtures import documents, labels, odd_texts, prose
from tidefleet.llm import line_dedup, quality_rules, sentencepiece_bpe, token_files, url_filter
from tidefleet.llm.common import vocabulary


def test_counts_by_brute_force():
    for t in odd_texts() + ["a b c d e f a b c d e", "x\n x\nx\n\n\ny", "a b c d e a b c d e a b c d e"]:
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        rep = {j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        seen, dup = set(), 0
        for line in (t or "").split("\n"):
            if re.search("[^\x20\x09-\x0d]", line):
                dup += line in seen
                seen.add(line)
        assert quality_rules.text_counts(t)[:5] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(rep))


def test_forest_rejects_junk_and_keeps_prose(spark):
    good = [prose(i, 40 + i % 60) for i in range(120)]
    junk = [" ".join(f"{w}###" for w in prose(200 + i, 40).split()) for i in range(12)]
    texts = good + junk + odd_texts()
    docs = documents(spark, texts)
    marks = labels(spark, [(i, 1, 0) for i in range(100)] + [(i, 0, 0) for i in range(120, 126)] + [(None, 1, 0), (3, None, 0)])
    found = {r.doc_id: r for r in quality_rules.judge(docs, marks).collect()}
    assert all(found[i].kept for i in range(120)) and not any(found[i].kept for i in range(120, 132))
    assert not found[132].kept and found[132].base_failed and found[132].n_words == 0
    kept = quality_rules.keep_good(docs, marks)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.kept}
    plain = {r.doc_id: r for r in quality_rules.judge(docs, marks.limit(0)).collect()}
    assert all(r.kept != r.base_failed and r.anomaly is None for r in plain.values())
    assert quality_rules.judge(docs.limit(0), marks).collect() == []


def test_forest_rejects_what_lies_inside_every_range():
    """Good rows have short words and few different ones, or long words and many: short words and many different ones are in range of each statistic, but where no good row is."""
    r = np.random.default_rng(9)

    def rows(n, length, different):
        counts = np.zeros((n, 8), np.int64)
        counts[:, 0], counts[:, 5] = 200, 10
        counts[:, 1] = 200 * r.normal(length, 0.25, n)
        counts[:, 6] = r.normal(different, 6, n)
        return counts

    good = np.concatenate([rows(400, 4, 60), rows(400, 11, 160)])
    bad, more_bad, more_good = rows(60, 4, 160), rows(100, 4, 160), np.concatenate([rows(100, 4, 60), rows(100, 11, 160)])
    x, low, high = quality_rules.statistics(more_bad), quality_rules.statistics(good).min(0), quality_rules.statistics(good).max(0)
    inside = ((x >= low) & (x <= high)).all(1)
    assert inside.sum() > 30  # what ranges can't tell
    forest = quality_rules.calibrated(np.concatenate([good, bad]), np.repeat([1, 0], [len(good), len(bad)]))
    assert not quality_rules._kept(more_bad[inside], forest).any()
    assert quality_rules._kept(more_good, forest).mean() > 0.97


def test_forest_by_plain_code():
    """Paths, scores and the threshold, row by row and node by node."""
    r = np.random.default_rng(5)
    x = np.clip(np.concatenate([r.normal(0.4, 0.02, (300, 6)), r.uniform(0, 1, (20, 6))]), 0, 1)
    f = quality_rules.grow(x[:300], trees=20)
    for row, path, score in zip(x, f.paths(x), f.scores(x), strict=True):
        lengths = []
        for root in f.roots:
            node, depth = root, 0
            while f.feature[node] >= 0:
                node, depth = f.below[node] + (row[f.feature[node]] >= f.split[node]), depth + 1
            assert depth <= quality_rules.DEPTH and f.path[node] >= depth
            lengths.append(f.path[node])
        assert abs(path - sum(lengths) / len(lengths)) < 1e-9 and abs(score - 2 ** (-path / f.norm)) < 1e-9
    assert f.scores(x[300:]).mean() > f.scores(x[:300]).max() > 0
    assert len(f.roots) == 20


def test_trees_hold_their_rows():
    """Each leaf's path is its depth and the mean path among the rows that reach it."""
    x = np.random.default_rng(6).uniform(0, 1, (64, 6))
    f = quality_rules.grow(x, trees=1, per_tree=64)
    reached = {}
    for row in x:
        node, depth = f.roots[0], 0
        while f.feature[node] >= 0:
            node, depth = f.below[node] + (row[f.feature[node]] >= f.split[node]), depth + 1
        reached.setdefault((int(node), depth), []).append(row)
    for (node, depth), rows in reached.items():
        n = len(rows)
        mean = 0 if n < 2 else 1 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n
        assert abs(f.path[node] - depth - mean) < 1e-9 and (n < 2 or depth == quality_rules.DEPTH)


def test_threshold_errs_least():
    """No other threshold on the labelled rows' scores costs less, and rows of one score share a verdict."""
    r = np.random.default_rng(7)
    counts = np.stack([np.full(400, 100), r.integers(450, 560, 400), np.where(np.arange(400) < 40, r.integers(0, 60, 400), 0), np.zeros(400), np.zeros(400), np.full(400, 5), r.integers(80, 95, 400), np.zeros(400)], 1).astype(np.int64)
    good = np.arange(400) >= 35
    f = quality_rules.calibrated(counts, good)
    scores = f.scores(quality_rules.statistics(counts))
    cost = lambda t: quality_rules.GOOD_WEIGHT * (good & (scores >= t)).sum() - (~good & (scores >= t)).sum()
    assert cost(f.threshold) == min(map(cost, [*np.unique(scores), np.inf])) < 0


def test_repeated_rows_do_not_move_the_forest(spark):
    texts = [prose(i, 40 + i) for i in range(60)] + [" ".join(f"{w}###" for w in prose(300 + i, 40).split()) for i in range(6)]
    docs = documents(spark, texts)
    marks = labels(spark, [(i, int(i < 60), 0) for i in range(66)])
    a, b = (quality_rules.fit(d, m) for d, m in ((docs, marks), (docs.unionAll(docs.limit(30)).repartition(7), marks.unionAll(marks))))
    assert a.threshold == b.threshold and np.array_equal(a.split, b.split)


def test_forest_and_threshold_come_from_all_labelled_rows(spark):
    """9000 labelled rows: each tree counts all the good ones, and tasks find the threshold that one array of all rows gives."""
    texts = [prose(i, 12 + i % 9) + "!" * (i % 7) for i in range(8600)] + [" ".join(f"{w}{'#' * (1 + i % 3)}" for w in prose(9000 + i, 14).split()) for i in range(400)]
    good = np.arange(9000) < 8600
    docs, marks = documents(spark, texts).repartition(5), labels(spark, [(i, int(g), 0) for i, g in enumerate(good)])
    counts = np.array([quality_rules.text_counts(t) for t in texts])
    plain, found = quality_rules.calibrated(counts, good), quality_rules.fit(docs, marks)
    assert np.array_equal(found.split, plain.split) and np.array_equal(found.path, plain.path) and found.threshold == plain.threshold < 1
    x = quality_rules.statistics(counts[good & ~quality_rules.base_failed(counts)])
    assert len(x) > 8192 and abs(found.norm - (2 * (np.log(len(x) - 1) + 0.5772156649) - 2 * (len(x) - 1) / len(x))) < 1e-9


def test_cuts_of_runs_join():
    """Runs of scores, cut at any places, give the threshold of the whole run, the highest of equally good ones."""
    r = np.random.default_rng(8)
    for _ in range(200):
        scores, cost = np.sort(r.random(12))[::-1], r.integers(-2, 3, 12)
        at = np.sort(r.choice(np.arange(1, 12), 3, replace=False))
        runs = [quality_rules.Cut.of(s, c) for s, c in zip(np.split(scores, at), np.split(cost, at), strict=True)]
        a, b, c, d = runs
        along = np.concatenate([[0], np.cumsum(cost)])
        cut = int(np.argmin(along))
        wanted = (scores[cut - 1] + (scores[cut] if cut < 12 else 0)) / 2 if cut else np.inf
        assert a.then(b).then(c).then(d).threshold() == a.then(b.then(c.then(d))).threshold() == wanted


def test_boilerplate_lines_by_site(spark):
    texts, sources = [], []
    for i in range(60):
        texts.append(f"{prose(i, 8)}\nsubscribe now\n\n{prose(1000 + i, 9)}" if i % 3 else prose(i, 8))
        sources.append("a" if i < 50 else "b")
    texts += ["subscribe now", None, "", "copy of one page\nwith two lines"] + ["copy of one page\nwith two lines"] * 9
    sources += ["a", "a", None] + ["a"] * 10
    docs = documents(spark, texts, sources)
    found = {r.row.doc_id: r for r in line_dedup.clean(docs).collect()}
    assert {r.row.doc_id: r for r in line_dedup.clean(docs, broadcast_lines=0).collect()} == found
    for i in range(60):
        dropped = "subscribe now" in texts[i]  # on two thirds of the pages of either site
        assert found[i].row.text == (texts[i].replace("subscribe now\n", "") if dropped else texts[i]) and found[i].dropped == int(dropped)
    assert found[60].row.text == "" and found[60].dropped == 1  # all of the page
    assert found[61].row.text is None and found[62].row.text == "" and found[63].row.text == texts[63]
    out = line_dedup.without_boilerplate(docs)
    assert out.columns == docs.columns and all(r.n_chars == len(r.text) for r in out.collect() if r.text is not None)
    assert line_dedup.clean(docs.limit(0)).collect() == []


def test_small_sites_keep_what_few_pages_share(spark):
    """A line on all three pages of a site, or on three of fifty, stays; on four of fifty it goes."""
    rows = [(f"shared\nown {i}", "small") for i in range(3)] + [((f"three\n" if i < 3 else "") + ("four\n" if i < 4 else "") + f"own {i}", "mid") for i in range(50)]
    found = line_dedup.clean(documents(spark, [t for t, _ in rows], [s for _, s in rows])).select("row.text", "row.source").collect()
    assert sum("shared" in r.text for r in found) == 3 and sum("three" in r.text for r in found) == 3 and not any("four" in r.text for r in found)


def test_units_after_another_sign():
    """A unit whose lead the library joins to it is asked for after another one."""
    e = sentencepiece_bpe.encoder(vocabulary("piece_bpe_32k.model"))
    for unit in ("ing", "ation", "漢字", ".", "1234"):
        ids = e.after_another(unit)
        assert ids is not None and e.library.decode(ids).strip() == unit

    class Joined:
        def encode(self, texts, num_threads=1):
            return [[1], [2, 3]]

    other = object.__new__(sentencepiece_bpe.Encoder)
    other.library = Joined()
    assert other.after_another("x") is None


def test_every_line_over_the_ratio_goes(spark):
    """Also where it is most of a page: the lines that are left are on 5 % of a site's pages at most."""
    docs = documents(spark, [f"first {i}\nthe same long line of every page of this site\n{'pair' + str(i // 2)}" for i in range(40)])
    left = [r.text.split("\n") for r in line_dedup.without_boilerplate(docs).collect()]
    assert sorted(left) == sorted([f"first {i}", f"pair{i // 2}"] for i in range(40))


ALPHABET = [*" \n\t ▁abceo.,th\x00\x01ﬁéß漢字😀áΣσÀİ　​\r\x85̧́", "the ", "  ", "▁▁", "<s>", "</s>", "<unk>", "<0x0A>", "ing", "\n\n", "'s", "'ll", "<|endoftext|>", "1", "²", "Ω", "É", "×", "ÿ"]


def noise(n):
    r = random.Random(5)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 16))) for _ in range(n)]


def test_sentencepiece_matches_the_library(spark):
    model = vocabulary("piece_bpe_32k.model")
    e = sentencepiece_bpe.encoder(model)
    for t in [*noise(3000), None, "", " ", "  a   b ", "\x01 \x02"]:
        assert np.frombuffer(e.encode([t])[0][0], np.int32).tolist() == e.library.encode(t or ""), repr(t)
    assert not e.differing
    texts = odd_texts()
    found = {r.doc_id: r for r in sentencepiece_bpe.encode_decode(documents(spark, texts), model).collect()}
    for i, t in enumerate(texts):
        ids = e.library.encode(t or "")
        assert found[i].ids == ids and found[i].decoded == e.library.decode(ids) and found[i].n_differing == 0
    assert sentencepiece_bpe.encode_decode(documents(spark, []), model).collect() == []


def test_differences_from_the_library_are_counted():
    right = sentencepiece_bpe.encoder(vocabulary("piece_bpe_32k.model"))
    e = sentencepiece_bpe.Encoder(vocabulary("piece_bpe_32k.model"))
    e.agenda = lambda u: right.agenda(u)[::-1] + [5] if "two" in u or u == "," else right.agenda(u)
    ids, counts = e.encode(["one two, two", "one", None])
    assert ids == right.encode(["one two, two", "one", None])[0] and counts == [3, 0, 0] and len(e.differing) == 2
    assert e.encode(["one two, two"])[1] == [3]  # also when remembered


def test_units_fall_back_for_other_vocabularies():
    assert sentencepiece_bpe.unit_pattern(["a▁b"]).findall("▁x▁y") == ["▁x▁y"]
    assert sentencepiece_bpe.unit_pattern(["a.", "▁a"]).findall("▁x.y▁z") == ["▁x.y", "▁z"]
    assert sentencepiece_bpe.unit_pattern(["ab", "▁a"]).findall("▁x.y▁▁z\n") == ["▁x", ".", "y", "▁▁z", "\n"]


def test_token_files_read_back(spark, tmp_path):
    file = vocabulary("word_bpe_49k.json")
    e = token_files.encoder(file)
    some = [*noise(3000), None, ""]
    for step in (1, 7, len(some)):
        for at in range(0, len(some), step):
            ids, begin = e.encode(pa.array(some[: at + step], pa.string()).slice(at))
            assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == [e.library.encode(t or "", add_special_tokens=False).ids for t in some[at : at + step]]
    texts = odd_texts()
    token_files.write(documents(spark, texts), f"file://{tmp_path}/t", file)
    back = token_files.read(spark, f"file://{tmp_path}/t")
    found = sorted(token_files.checksums(back).collect())
    at = 0
    for i, t in enumerate(texts):
        ids = [*e.library.encode(t or "", add_special_tokens=False).ids, 2]
        assert tuple(found[i]) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    pick = back.filter("doc_id = 5")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,5)]" in pick._jdf.queryExecution().toString() and pick.count() == 1
    token_files.write(documents(spark, []), f"file://{tmp_path}/e", file)
    assert token_files.checksums(token_files.read(spark, f"file://{tmp_path}/e")).collect() == []


def test_token_files_skip_row_groups(spark, tmp_path):
    """A lookup reads the row group of its id; one of an id that lies between others but isn't there reads none, by the Bloom filter."""
    n = 12_000
    docs = spark.range(n).selectExpr("id * 2 as doc_id", "concat('text ', id) as text")
    token_files.write(docs, f"file://{tmp_path}/t", vocabulary("word_bpe_49k.json"))

    def scanned(doc_id):
        found = spark.read.orc(f"file://{tmp_path}/t").filter(f"doc_id = {doc_id}").select("doc_id")
        rows = found.collect()
        leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return len(rows), leaf.metrics().apply("numOutputRows").value()

    found, read = scanned(9000)
    assert found == 1 and 0 < read <= 2000  # of 12 000
    absent = [scanned(i) for i in (4001, 9001, 17_001)]
    assert all(x[0] == 0 for x in absent) and sum(x[1] == 0 for x in absent) >= 2


URLS = [
    (0, "http://A.Example.ORG/es/1?x", "a.example.org", "/es/1", "example.org/es/", "block"), (1, "https://example.org/en/12#a", "example.org", "/en/12", "example.org/en/1", "block"),
    (2, "https://x.org", "x.org", "", None, "allow"), (3, "https://x.org/", "x.org", "/", "org/", "allow"), (4, None, "", "", None, "allow"), (5, "nothing", "", "", None, "allow"),
    (6, "http://shop.com/de/a?b=/fr/", "shop.com", "/de/a", "com/de/", "block"), (7, "http://shop.com/fr/", "shop.com", "/fr/", "com/fr/", "allow"), (8, "http://bad.example.net/en/1", "bad.example.net", "/en/1", None, "block"),
    (9, "http://good.example.net/en/1://x", "good.example.net", "/en/1://x", None, "allow"), (10, "http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"), (None, "http://u@h.co.uk:80/p", "u@h.co.uk:80", "/p", None, "allow"),
]


def test_url_rules_and_reputation(spark):
    more = [(100 + i, f"http://bad.example.net/{i}") for i in range(40)] + [(200 + i, f"http://good.example.net/{i}") for i in range(40)] + [(300 + i, f"http://h{i % 9}.example.com/") for i in range(90)]
    pages = spark.createDataFrame([(p, u, "x", "x") for p, u, *_ in URLS] + [(p, u, "x", "x") for p, u in more], "page_id long, url string, host string, rule string")
    outcomes = spark.createDataFrame([(p, int(not 100 <= p < 140)) for p, _ in more] + [(None, 0), (101, 1)], "page_id long, good int")
    found = {r.page_id: r for r in url_filter.judge(pages, outcomes).collect()}
    for p, _, host, path, rule, verdict in URLS:
        assert (found[p].host, found[p].path, found[p].rule, found[p].verdict) == (host, path, rule, verdict), p
    kept = url_filter.allowed(pages, outcomes)
    assert kept.columns == pages.columns and {r.page_id for r in kept.collect()} == {p for p, r in found.items() if r.verdict == "allow"}
    assert all(r.verdict == "allow" or r.rule for r in url_filter.judge(pages, outcomes.limit(0)).collect())
    assert url_filter.judge(pages.limit(0), outcomes).collect() == []


def test_hosts_beyond_a_broadcast(spark, monkeypatch):
    """Hosts of many pages are broadcast, others are joined by host: rows are those of one broadcast of all."""
    monkeypatch.setattr("tidefleet.llm.common.HOT_GROUPS", 10)
    pages = [(i, f"http://hot.example.net/{i}" if i % 3 == 0 else f"http://h{i % 50}.example.com/{i}") for i in range(600)] + [(None, None), (7, ""), (8, "http://hot.example.net/" + "x" * 100_000)]
    pages = spark.createDataFrame(pages, "page_id long, url string")
    outcomes = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(600)], "page_id long, good int")
    rows = lambda df: sorted(map(str, df.collect()))
    all_at_once = rows(url_filter.judge(pages, outcomes))
    assert len(all_at_once) == 603 and rows(url_filter.judge(pages, outcomes, broadcast_hosts=0)) == all_at_once
    assert {r.verdict for r in url_filter.judge(pages, outcomes, broadcast_hosts=0).filter("host = 'hot.example.net'").collect()} == {"block"}


def test_one_bad_outcome_blocks_nothing_elsewhere(spark):
    """Fifty pages on hosts of seven domains, one or two outcomes: nothing can be learnt about hosts without one."""
    pages = spark.createDataFrame([(i, f"http://h{i}.d{i % 7}.net/") for i in range(50)], "page_id long, url string")
    for marks in ([(0, 0)], [(0, 0), (1, 1)], [(0, 0), (7, 0), (1, 1)], [(i, 1) for i in range(1, 50)] + [(0, 0)]):
        found = url_filter.judge(pages, spark.createDataFrame(marks, "page_id long, good int")).collect()
        assert {r.page_id for r in found if r.verdict == "block"} <= {p for p, good in marks if not good}


def test_a_bad_host_is_blocked_and_its_domain_suspected(spark):
    pages = [(i, f"http://bad.site.net/{i}") for i in range(40)] + [(100, "http://other.site.net/"), (101, "http://elsewhere.org/")] + [(200 + i, f"http://g{i % 6}.good{i % 3}.net/{i}") for i in range(60)]
    marks = [(i, 0) for i in range(40)] + [(200 + i, int(i % 10 > 0)) for i in range(60)]
    found = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(marks, "page_id long, good int")).collect()}
    assert all(found[i].verdict == "block" for i in range(40)) and all(found[200 + i].verdict == "allow" for i in range(60))
    assert found[101].verdict == "allow" and found[100].posterior < found[101].posterior


def plain_reputations(hosts):
    """Posterior means and bounds from (host, suffix, domain, n, good), by loops over members."""
    total_n, total_good = sum(h[3] for h in hosts), sum(h[4] for h in hosts)
    inherited, strength, out = {}, None, {}
    for depth in (1, 2, 3):
        members = {}
        for host, suffix, domain, n, good in hosts:
            key = (suffix, domain, host)[:depth]
            a, b = members.get(key, (0, 0))
            members[key] = (a + n, b + good)
        means = {}
        for key, (n, good) in members.items():
            if depth == 1:
                means[key] = (total_good - good + 1) / (total_n - n + 2)
            else:
                p, (up_n, up_good) = inherited[key[:-1]]
                means[key] = (strength * p + up_good - good) / (strength + up_n - n)
        more = spread = 0
        for key, (n, good) in members.items():
            if n > 1:
                spread += (good - n * means[key]) ** 2 / (n * means[key] * (1 - means[key])) - 1
                more += n - 1
        rho = (spread + 10 * 0.5) / (more + 10)
        strength = min(1000, max(1, 1 / rho - 1)) if rho > 0 else 1000
        inherited = {k: (means[k], members[k]) for k in members}
    for key, (p, (n, good)) in inherited.items():
        a, b = strength * p + good, strength * (1 - p) + n - good
        out[key[-1]] = (a / (a + b), min(1, max(0, a / (a + b) + 1.64 * (a * b / ((a + b) ** 2 * (a + b + 1))) ** 0.5)))
    return out


def test_reputations_by_brute_force(spark):
    r = random.Random(3)
    hosts = []
    for i in range(60):
        n = r.choice([0, 0, 1, 2, 5, 30])
        hosts.append((f"h{i}.d{i % 11}.{'net' if i % 11 < 6 else 'org'}", "net" if i % 11 < 6 else "org", f"d{i % 11}.{'net' if i % 11 < 6 else 'org'}", n, sum(r.random() < (0.2 if i % 4 == 0 else 0.9) for _ in range(n))))
    found = {x.host: (x.posterior, x.bound) for x in url_filter.reputations(spark.createDataFrame([(h[0], h[3], h[4]) for h in hosts], "host string, n long, good long")).collect()}
    expected = plain_reputations(hosts)
    assert found.keys() == expected.keys() and all(np.allclose(found[h], expected[h], atol=1e-9) for h in found)
