"""Small tables with nulls, empty and long texts, repeated rows, and columns whose names clash with the operators' own."""

import random

from pyspark.sql import types as T

CLASHING = "all at fp key kept score start row_key site own line lines component_id __key __bad __row_key n_words host path a b".split()
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.IntegerType()), *(T.StructField(c, T.StringType()) for c in CLASHING)])
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 40)) for _ in range(n))


def documents(spark, texts, sources=None, ids=None):
    rows = [(ids[i] if ids else i, t, "en", sources[i] if sources else "s", len(t) if t is not None else None, *("x" for _ in CLASHING)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts() -> list:
    long = prose(99, 30_000)
    return [None, "", " \n\t ", "one", "É é Ünder σς 漢字 😀 a\tb", prose(1, 60), prose(1, 60), prose(1, 59) + " other", "\n".join([prose(2, 20)] * 3), long, long, "#*$%&|<>" * 20, prose(3, 12) + "\r\n" + prose(4, 12)]


def labels(spark, rows):
    return spark.createDataFrame([(i, q, t, "x") for i, q, t in rows], "doc_id long, quality int, toxic int, score string")
