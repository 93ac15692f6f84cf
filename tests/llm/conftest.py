import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Ids and texts with copies, near copies, shared passages, empties and odd characters."""
    rng = random.Random(5)
    words = ["the", "of", "und", "Maße", "été", "zwölf", "river", "stone", "cloud", "paper", "x1", "don't", "日本"]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "s", "er", ".\n"]) for _ in range(n))
    rows = [(i, text(rng.randint(1, 120))) for i in range(40)]
    long = text(900)
    near = long.split(" ")
    for i in range(40, 70):
        changed = near.copy()
        changed[rng.randrange(len(near))] = f"edit{i}"
        rows.append((i, " ".join(changed)))
    passage = text(60)
    rows += [(i, text(30) + passage + text(30)) for i in range(70, 80)]
    rows += [(i, rows[3][1]) for i in range(80, 85)]
    rows += [(85, ""), (86, None), (87, " \n "), (88, "ab" * 300), (89, "q" * 199), (90, "q" * 200), (91, "z" * 450)]
    rows += [(92, "One two"), (93, "one  TWO"), (94, "<|endoftext|> a<|endoftext|>b"), (95, "\x1c x \x85y\xa0 z  \n\n w ")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, "doc_id long, text string").repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(spark):
    """Extra columns with names the operators use inside, and null ids."""
    rows = [(1, "a b c\nd e\nf g h", 7, "n", 1.0, "g", "s"), (2, "a b c\nd e\nf g h", 8, "m", 2.0, "g", "s"), (None, "x y", 9, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, id long, node string, kept double, `group.a` string, spans string")
