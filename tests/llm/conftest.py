import random

import pytest
from pyspark.sql import functions as F

#: Names that the operators use inside.
CLASHING = "doc body line numbers lines dropped_lines h g halves words fp node shard part score label base found key at n m".split()


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text) rows as a frame, with columns whose names clash with the operators' own."""

    def make(rows, clashing=True):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING}) if clashing else df

    return make


@pytest.fixture(scope="session")
def prose():
    """Invented texts by a seed: words of few syllables."""

    def make(seed, words):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(["ta", "ri", "mon", "el", "su", "ka"]) for _ in range(rng.randint(1, 4))) for _ in range(words))

    return make


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Nulls, empties, a very long text, repeated rows and ids."""
    long = "\n".join(prose(i, 40) for i in range(400))
    return [
        (1, None),
        (2, ""),
        (3, "   \n\t "),
        (None, prose(1, 30)),
        (4, prose(2, 30)),
        (4, prose(2, 30)),
        (4, prose(3, 30)),
        (5, long),
        (6, "naïve Ⅷ ½ Σίσυφος \U0001f600 İstanbul̇ é  two  spaces \n \n x\r\n"),
        (7, "x" * 5000),
        (None, None),
    ]
