import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, hits string, version string"


def prose(seed: int, words: int, letters: str = "abcdefghij") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(words))


def variant(text: str, seed: int, every: int) -> str:
    words = text.split(" ")
    rng = random.Random(seed)
    for place in rng.sample(range(len(words)), max(len(words) // every, 1)):
        words[place] = "X" + words[place]
    return " ".join(words)


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text): NULLs, blanks, copies, near copies, shared passages, a very long text, repeated rows."""
    base = [prose(seed, 120) for seed in range(6)]
    rows = [(i, text) for i, text in enumerate(base)]
    rows += [(20 + i, variant(base[0], i, 30)) for i in range(8)]
    rows += [(40, base[1]), (41, base[1].upper()), (41, base[1].upper()), (None, base[1]), (None, prose(50, 30))]
    passage = prose(70, 20)
    rows += [(50 + i, prose(80 + i, 40) + "\n" + passage + "\t" + prose(90 + i, 9)) for i in range(4)]
    rows += [(60, None), (61, ""), (62, " \t\r\n "), (63, "one two"), (64, "One TWO"), (65, "ünï cödé wörds " * 9)]
    rows += [(None, None), (70, prose(99, 30_000)), (71, "a " * 300), (72, "a " * 301), (41, prose(44, 50))]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    full = [(i, t, "en", "s", 1, 2, "x", "y") for i, t in texts]
    return spark.createDataFrame(full, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
