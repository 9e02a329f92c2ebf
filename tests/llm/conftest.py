import random

import pytest
from pyspark.sql import types as T

# Columns whose names the operators use for their own results or steps.
CLASHES = ["score", "kept", "id", "component_id", "spans", "held_out", "row", "key", "words", "label", "slot", "n"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows, clashing column names."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(300)]
    plain = " ".join(rng.choices(vocabulary, k=120))
    texts = {
        1: plain, 2: plain, 3: plain + " coda", 4: None, 5: "", 6: " \n\t ", 7: "one two", 8: "one two", 9: "ÄÖ ẞtraße 漢字 12 x  y ",
        10: " ".join(rng.choices(vocabulary, k=60_000)), 11: "same " * 400, 12: "!!! ??? 123", 13: "b" * 250,
    }
    rows = [(i, t, "en" if i % 2 else None, None, None, *["x"] * len(CLASHES)) for i, t in texts.items()]
    rows += [rows[0], rows[6], (None, plain, None, "s", 3, *[None] * len(CLASHES)), (None, None, None, None, None, *[None] * len(CLASHES))]
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]
    schema = T.StructType([T.StructField(n, t) for n, t in [*fields, *((c, T.StringType()) for c in CLASHES)]])
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
