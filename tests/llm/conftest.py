import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
# Names that the operators use inside; an input may have them too.
CLASHING = ("k", "t", "tag", "fp", "id", "row", "spans", "bucket", "root", "least", "list", "score", "key", "starts",
            "ids", "kept", "component_id", "n", "v", "side", "place")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) rows, with extra columns whose names clash."""
    def make(rows, clash=True):
        df = spark.createDataFrame(rows, DOCS)
        if clash:
            for c in CLASHING:
                df = df.selectExpr("*", f"'x' AS `{c}`")
        return df
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "Épsilon", "zeta", "eta", "theta", "日本", "iota"]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 90))) + "." for _ in range(40)]
    passage = " ".join(rng.choice(words) for _ in range(60)) + ". End of it! Is it so? Yes."
    rows = [(i, p) for i, p in enumerate(prose)]
    rows += [(100, None), (101, ""), (102, "   \n\t "), (None, prose[0]), (None, passage), (103, "x" * 3000),
             (104, "x" * 2500), (105, prose[3]), (105, prose[3]), (106, prose[5]), (106, prose[6])]
    rows += [(110 + i, prose[i] + " " + passage + " " + prose[i + 1]) for i in range(12)]
    rows += [(200, " ".join(prose) * 40), (201, " ".join(prose) * 40 + " tail")]
    rows += [(300 + i, " ".join(rng.sample(words, 1)) + " " + prose[7] * 3) for i in range(12)]
    return rows
