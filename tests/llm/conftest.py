import random

import pytest
from pyspark.sql import functions as F

#: columns that operators use for their own results
CLASHES = ("score", "kept", "shard", "slot", "pii", "license", "component_id", "ids", "_t", "_row", "_id", "_gone")


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, repeated, tied, very long and unbroken texts."""
    rnd = random.Random(11)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "no", "pu", "ré") for b in ("s", "t", "ra", "ne", "")]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base = prose(40)
    return [
        (1, None), (2, ""), (3, "  \n\t "), (4, "One"), (5, "ONE"), (6, base), (7, base.upper()), (7, base.upper()),
        (8, base + " end"), (9, prose(9000)), (10, "x" * 60_000), (11, "日本 \U0001f600 ▁é\u0301\x00z"),
        (12, prose(300)), (None, base), (None, None), (13, "a@b.cd " * 700), (14, prose(4)), (15, prose(5)),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_texts):
    """The same as documents, with columns whose names operators use themselves."""
    df = spark.createDataFrame(odd_texts, "doc_id long, text string").repartition(3)
    df = df.withColumns(
        {
            "lang": F.when(F.col("doc_id") > 3, "en"),
            "source": F.lit(None).cast("string"),
            "n_chars": F.length("text").cast("long"),
        }
    )
    return df.withColumns({c: F.lit(c) for c in CLASHES})


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("doc_id < -1")


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
