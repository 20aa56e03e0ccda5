import random

import pytest

from bloomline.llm.shipping import ship

WORDS = [a + b for a in ("th", "er", "on", "re", "an", "st", "ble", "in") for b in ("ou", "at", "es", "ti", "ng", "or", "ed", "a")]

#: Column names that the operators use inside, as columns of the input.
CLASH = "key long, row long, fp long, shard long, term string, bucket int, score double, label int, held_out int, _key string, _spans string, _kept int"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


def sentence(rng, low=4, high=14):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(low, high))).capitalize() + "."


def prose(rng, sentences):
    return " ".join(sentence(rng) for _ in range(sentences))


@pytest.fixture(scope="session")
def texts():
    """Odd and plain texts: null, empty, blanks, repeated rows, ties, long, other scripts, special strings."""
    rng = random.Random(7)
    plain = [prose(rng, 12) for _ in range(30)]
    rows = list(enumerate(plain))
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "x"), (104, "Éa ß 漢字 😀 it's 12 3½ z ."), (105, plain[0]),
             (106, plain[1].replace("a", "e", 1)), (107, (plain[2] + "\n") * 40), (108, "<|endoftext|> a<|endoftext|>"),
             (109, "<|startoftext|>b  c\n\nd "), (110, "w" * 5000), (111, plain[3] + " " + plain[4]), (112, "a b\x1cc\x0bd\x85e"),
             (3, plain[3]), (3, plain[3]), (None, plain[5]), (None, None), (113, "# * $ % & | < >"), (114, "the the the " * 300)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents, with further columns whose names clash with those inside the operators."""
    names = [c.split()[0] for c in CLASH.split(", ")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + CLASH
    rows = [(i, t, "en", "s", None if t is None else len(t), *[None] * len(names)) for i, t in texts]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark, texts):
    rows = [(i, n % 2, 0) for n, (i, _) in enumerate(texts)]
    return spark.createDataFrame(rows + [(None, 1, 0), (5, None, None), (9999, 1, 0)], "doc_id long, quality int, toxic int")
