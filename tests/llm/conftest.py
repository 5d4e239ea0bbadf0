import random

import pytest

#: A table's columns, and some that clash with names used inside the operators.
COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
           "id bigint, h string, kept string, print string, start string, shard string")


@pytest.fixture(scope="session")
def documents(spark):
    """Make a documents table from (doc_id, text) or (doc_id, text, lang) rows."""
    def make(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None,
                 1, "h", "k", "p", "s", "x") for r in rows]
        return spark.createDataFrame(full, COLUMNS).repartition(partitions)
    return make


@pytest.fixture()
def words():
    """A source of texts of invented words, the same on every run."""
    r = random.Random(7)
    vocabulary = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(r.randint(1, 9)))
                  for _ in range(400)]
    return lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
