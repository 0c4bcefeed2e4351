import pytest

DOCS = "doc_id long, text string"
# Columns that operators use inside, and one of an unusual type.
CLASHES = "doc_id long, text string, id string, mark long, s1 string, s2 string, spans array<int>, n_words string, row int, bin_id string, u map<string,int>"


@pytest.fixture
def frame(spark):
    def make(rows, schema=DOCS):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def clashing(spark):
    """Documents with columns named like the operators' own, several partitions."""

    def make(rows):
        wide = [(d, t, "x", 7, "y", "z", [1], "w", 3, "b", {"k": 1}) for d, t in rows]
        return spark.createDataFrame(wide, CLASHES).repartition(3)

    return make


@pytest.fixture(scope="session")
def prose():
    """Deterministic text: the same seed gives the same words."""
    import random

    def make(seed, n, vocabulary=5000):
        draw = random.Random(seed)
        return " ".join(f"w{draw.randrange(vocabulary):04d}x" for _ in range(n))

    return make
