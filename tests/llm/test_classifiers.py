"""Held-out accuracy of the trained classifiers, and odd tables."""

import os

import numpy as np
import pytest

from tests.llm.fixtures import documents, labels, odd_texts, prose
from tidefleet.llm import quality_classifier, toxicity
from tidefleet.llm.common import SharedTables
from tidefleet.llm.hashed import Rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize(("operator", "label", "least"), [(quality_classifier, "quality", 0.97), (toxicity, "toxic", 0.93)])
def test_held_out_accuracy(spark, operator, label, least):
    docs, marks = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = operator.classify(docs, marks).filter("held_out").join(marks, "doc_id").select(label, "predicted", "score").collect()
    right = sum(r[0] == r.predicted for r in scored)
    assert len(scored) > 80 and right / len(scored) >= least and all(0 <= r.score <= 1 for r in scored)


@pytest.mark.parametrize("operator", [quality_classifier, toxicity])
def test_odd_tables(spark, operator):
    docs = documents(spark, odd_texts(), ids=[None, *range(1, len(odd_texts()))])
    marks = labels(spark, [(i, i % 2, 1 - i % 2) for i in range(1, 9)] + [(None, 1, 1), (5, None, None)])
    found = operator.classify(docs, marks).collect()
    assert len(found) == len(odd_texts()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    assert operator.classify(docs.limit(0), marks).collect() == []
    assert len(operator.classify(docs, marks.limit(0)).collect()) == len(odd_texts())


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs = documents(spark, [prose(i, 30) for i in range(40)])
    marks = labels(spark, [(i, i % 2, i % 2) for i in range(40)])
    for operator in (quality_classifier, toxicity):
        a = {r.doc_id: r for r in operator.classify(docs, marks).collect()}
        flipped = labels(spark, [(i, (i % 2) ^ a[i].held_out, (i % 2) ^ a[i].held_out) for i in range(40)])
        assert {r.doc_id: r.score for r in operator.classify(docs, flipped).collect()} == {i: r.score for i, r in a.items()}


def code(**levels):
    return sum(level << 2 * toxicity.VOTERS.index(name.replace("_", " ")) for name, level in levels.items())


def test_posteriors_follow_the_votes():
    both, words = code(nouns=2, adjectives=2, words_a=1), code(nouns=1, words_a=2, words_b=2)
    counts = {0: 900.0, code(nouns=1): 10.0, both: 40.0, words: 30.0, code(disguised=1): 5.0}
    p = toxicity.label_model(counts, {(0, 0): 90.0, (both, 1): 5.0, (words, 1): 4.0})
    assert p[0] < 0.05 and p[both] > 0.9 and p[words] > 0.9
    assert toxicity.label_model({}, {}) == {}


def test_label_model_by_enumeration():
    """Expectation maximisation document by document, with a table a voter, class and length, against the one by patterns."""
    r = np.random.default_rng(3)
    truth = r.random(400) < 0.2
    levels = np.where(truth[:, None], r.choice(3, (400, len(toxicity.VOTERS)), p=[0.4, 0.3, 0.3]), r.choice(3, (400, len(toxicity.VOTERS)), p=[0.9, 0.08, 0.02]))
    length = r.choice(len(toxicity.LENGTHS) + 1, 400)
    start = np.where(levels.sum(1) > 4, 0.9, 0.1)
    posterior = start.copy()
    for _ in range(5):
        prior = [sum(1 - posterior) + 1, sum(posterior) + 1]
        odds = []
        for row, own in zip(levels, length, strict=True):
            p = list(prior)
            for v, level in enumerate(row):
                for y in (0, 1):
                    weight = posterior if y else 1 - posterior
                    whole = (weight[levels[:, v] == level].sum() + 1.5 / toxicity.LEVELS) / (weight.sum() + 1.5)
                    p[y] *= (weight[(levels[:, v] == level) & (length == own)].sum() + toxicity.PRIOR * whole) / (weight[length == own].sum() + toxicity.PRIOR)
            odds.append(p[1] / (p[0] + p[1]))
        posterior = np.array(odds)
    patterns, place, count = np.unique(np.column_stack([levels, length]), axis=0, return_inverse=True, return_counts=True)
    begin = np.zeros(len(patterns))
    begin[place] = start
    found = toxicity.fitted(patterns[:, :-1], patterns[:, -1], count.astype(float), np.zeros((len(patterns), 2)), [[i] for i in range(len(toxicity.VOTERS))], begin, 5)
    assert np.allclose(found[place], posterior, atol=1e-9) and ((posterior > 0.5) == truth).mean() > 0.95


def test_votes_do_not_depend_on_length():
    """The same words of abuse give the same votes among 50 and 5000 different words; only the length tells the texts apart."""
    found = [toxicity.Lexicons().votes(" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(n)) + " idiot moron scum") for n in (50, 260, 520, 800, 5000)]
    assert all(np.array_equal(f[0], found[0][0]) and f[1] == 3 for f in found) and found[0][0][0] == 2
    assert [toxicity.length_of(len(f[2])) for f in found] == [0, 1, 2, 2, 3]
    codes = [toxicity._code(f[0], toxicity.length_of(len(f[2]))) for f in found]
    assert np.array_equal(toxicity.levels_of(np.array(codes)), np.stack([f[0] for f in found]))


def test_what_votes_say_in_long_texts_is_learnt():
    """A vote that most long texts have by chance says little there and much in short ones."""
    one, long = code(words_a=1), 3 << 2 * len(toxicity.VOTERS)
    sure = code(words_a=1, nouns=2, stems_a=2)
    p = toxicity.label_model({0: 9000.0, one: 30.0, sure: 300.0, long: 300.0, long + one: 700.0, long + sure: 20.0}, {(0, 0): 100.0, (one, 1): 10.0, (sure, 1): 30.0, (long + one, 0): 20.0, (long + sure, 1): 4.0})
    assert p[one] > 0.5 > 0.1 > p[long + one] and p[sure] > 0.9 and p[long + sure] > 0.9


def test_rows_weigh_what_all_documents_have():
    weight, bare, more = toxicity.weighed(np.array([5, 5, 7]), {5: 600.0, 7: 300.0, 9: 100.0})
    assert bare == [9] and np.allclose(weight, [300, 300, 300]) and np.allclose(more, [100])


def test_copies_of_a_voter_count_once():
    """Voters that always agree get one joint table, so that they say no more than one of them."""
    r = np.random.default_rng(4)
    truth = r.random(4000) < 0.3
    vote = lambda: np.where(truth, r.random(4000) < 0.7, r.random(4000) < 0.2).astype(int)
    one, two = vote(), vote()
    copied = np.stack([one, one, one, two], 1)
    groups = toxicity.together(copied, np.stack([~truth, truth]).astype(float))
    assert sorted(map(sorted, groups)) == [[0, 1, 2], [3]]
    fit = lambda levels, groups: toxicity.fitted(levels, np.zeros(4000, int), np.zeros(4000), np.stack([~truth, truth], 1).astype(float), groups, np.zeros(4000), 1)
    assert np.allclose(fit(copied, groups), fit(np.stack([one, two], 1), [[0], [1]]), atol=0.01)


def test_lexicons_come_from_both_halves(spark):
    docs = documents(spark, [prose(i, 30) + (" vexatious vexations glumly" if i % 4 == 0 else "") for i in range(400)])
    marks = labels(spark, [(i, 1, int(i % 4 == 0)) for i in range(400)])
    sample = toxicity.sampled(docs, marks, 1000, SharedTables(spark))
    found = toxicity.mine(sample)
    assert all("glumly" in w and "vexatious" in w for w in found.words) and all("vexat" in s for s in found.stems)
    level, hits, words = found.votes("Vexatious vexations, glumly! You 1diot; ABSCHAUM")
    assert {v: int(n) for v, n in zip(toxicity.VOTERS, level) if n} == {"german": 1, "disguised": 1, "words a": 2, "words b": 2, "stems a": 1, "stems b": 1} and hits == 4
    assert toxicity.mine(sample.filter("toxic = 0")) == toxicity.Lexicons()


def test_no_disguise_escapes_the_quick_look():
    """Every spelling of a lexicon word with one letter replaced, and with signs between letters, is found."""
    for w in sorted(toxicity.WORDS["nouns"] | toxicity.WORDS["adjectives"]):
        if len(w) > 3:
            spelled = [w[:i] + sign + w[i + 1 :] for i, c in enumerate(w) for sign in toxicity.DISGUISES.get(c, "")] + [sign.join(w) for sign in ".-*_"]
            for x in spelled:
                assert toxicity.Lexicons().votes(f"so {x} it")[0][toxicity.VOTERS.index("disguised")] == 1, x


def test_factorisation_by_all_pairs():
    """The linear-time margin and the gradient of a step against loops over all pairs of features."""
    r = np.random.default_rng(5)
    size = quality_classifier.SLOTS
    m = quality_classifier.Machine(0.3, r.normal(0, 1, size), r.normal(0, 0.5, (size, quality_classifier.FACTORS)))
    rows = [(np.sort(r.choice(size, n, replace=False)).astype(np.int32), r.normal(0, 1, n).astype(np.float32)) for n in (1, 2, 9, 40)]

    def margin(weight, factor, slots, values):
        total = 0.3 + sum(weight[i] * x for i, x in zip(slots, values))
        for a in range(len(slots)):
            for b in range(a):
                total += float(factor[slots[a]] @ factor[slots[b]]) * values[a] * values[b]
        return total

    packed_rows = Rows.of(rows)
    found, x, total = m.parts(packed_rows)
    assert np.allclose(found, [margin(m.weight, m.factor, *row) for row in rows], rtol=1e-4)
    for k, (slots, values) in enumerate(rows):
        begin = packed_rows.ends[k]
        for i in range(min(3, len(slots))):
            for f in (0, 5):
                up, down = m.factor.copy(), m.factor.copy()
                up[slots[i], f] += 1e-4
                down[slots[i], f] -= 1e-4
                slope = (margin(m.weight, up, slots, values) - margin(m.weight, down, slots, values)) / 2e-4
                assert np.isclose(slope, float(values[i]) * (total[k, f] - x[begin + i, f]), rtol=1e-2, atol=1e-2)


@pytest.mark.parametrize("operator", [quality_classifier, toxicity])
def test_repeated_rows_do_not_move_the_fit(spark, operator):
    docs = documents(spark, [prose(i, 30) + (" idiot ###" if i % 5 == 0 else "") for i in range(60)])
    marks = labels(spark, [(i, int(i % 5 > 0), int(i % 5 == 0)) for i in range(60)])
    a = {r.doc_id: r.score for r in operator.classify(docs, marks).collect()}
    b = {r.doc_id: r.score for r in operator.classify(docs.repartition(5), marks.unionAll(marks)).collect()}
    assert a == b
    if operator is quality_classifier:  # toxicity counts votes over all rows
        assert a == {r.doc_id: r.score for r in operator.classify(docs.unionAll(docs.limit(20)), marks).distinct().collect()}
