"""Each stage of the pipeline against its operator on the rows that its predecessor kept."""

import os

import pytest

import corpus_pipeline as P
from tidefleet.llm import common, decontaminate, quality_rules, simhash
from tidefleet.llm.common import table

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names, before = docs.columns, docs
    out = []
    for name, stage in P.STAGES:
        before = stage(spark, before, SF).cache()
        out.append((name, before))
    (_, good), (_, lines), (_, unique), (_, clean), (_, tokens) = out
    assert all(df.columns == names for _, df in out[:4])
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(good) == ids(quality_rules.judge(docs, table(spark, SF, "labels")).filter("kept"))
    assert ids(lines) == ids(good)
    assert ids(unique) == ids(simhash.near_duplicates(lines).filter("doc_id = component_id"))
    assert ids(clean) == ids(decontaminate.contamination(unique, table(spark, SF, "benchmark")).filter("not contaminated"))
    assert ids(tokens) == ids(clean) and 0 < len(ids(clean)) < len(ids(docs))
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, tokens.collect()))


def test_odd_documents(spark):
    """What each stage makes of nulls, empty and long texts, repeated rows and clashing names, stated in its docstring."""
    from tests.llm.fixtures import documents, labels, odd_texts, prose

    texts = odd_texts() + [prose(1, 60)]
    docs = documents(spark, texts, ids=[None, *range(1, len(texts) - 1), 5])
    names = docs.columns
    docs = docs.unionAll(docs.filter("doc_id = 7"))
    rows = lambda df: sorted(((-1 if r.doc_id is None else r.doc_id), r.text or "") for r in df.select("doc_id", "text").collect())
    quality, lines, near, bench, tokens = (f for _, f in P.STAGES)
    good = quality(spark, docs, SF)
    kept = rows(good)
    assert good.columns == names and all(len(t.split()) >= 10 for _, t in kept) and [i for i, _ in kept].count(7) == 2 and 9 in [i for i, _ in kept]
    cleaned = lines(spark, docs, SF)
    assert cleaned.columns == names and rows(cleaned) == rows(docs)  # no line is on over four pages
    unique = near(spark, docs, SF)
    left = rows(unique)
    assert unique.columns == names and [i for i, _ in left].count(7) == 0 and sum(not t.split() for _, t in left) == 1  # 7 is near 5, empty texts are one group
    assert [i for i, t in left if t == prose(1, 60)] == [5] and [i for i, t in left if len(t.split()) == 30_000] == [9]
    clean = bench(spark, docs, SF)
    assert clean.columns == names and rows(clean) == rows(docs)
    ids = tokens(spark, docs, SF)
    assert ids.count() == docs.count() and all(r.n_tokens == len(r.ids) for r in ids.collect()) and ids.filter("n_tokens = 0").count() == 2
    empty = documents(spark, [])
    for _, stage in P.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


class Settings:
    """What stands for a session where only settings are read."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key.replace(".", "_"), default)


def test_folders_are_deleted_and_shared(spark, tmp_path, monkeypatch):
    """run() leaves its last table only; without a shared folder a cluster's session is refused."""
    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    assert P.run(spark, SF).count() > 0
    assert len(os.listdir(tmp_path)) == 1
    monkeypatch.undo()
    for master in ("local-cluster[3,2,1000]", "yarn", "spark://host:7077"):
        with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
            common.shared_dir(Settings(spark_master=master))
    assert common.shared_dir(Settings(spark_master="yarn", spark_checkpoint_dir="hdfs:///x/")) == "hdfs:///x"
    assert common.shared_dir(Settings(spark_master="local[4]")).startswith("file:///")
