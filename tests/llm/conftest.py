"""Small corpora for the corpus operators."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; extra columns may carry them too.
CLASHING = "key string, fp string, h string, n string, w string, class string, label string, start string, value string"


def words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8))) for _ in range(n)]


@pytest.fixture(scope="session")
def make(spark):
    """documents of the given texts (a list, or pairs of id and text), with further columns of clashing names."""

    def run(texts):
        pairs = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(texts)]
        rows = [(i, t, "en" if k % 2 else None, "web" if k % 3 else None, len(t or "")) + ("x",) * 9 for k, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(rows, f"{SCHEMA}, {CLASHING}").repartition(3)

    return run


@pytest.fixture(scope="session")
def odd_texts():
    """NULL, empty, blank, one word, ties and repeated rows, a long text, a NULL id."""
    plain = " ".join(words(1, 40))
    return [(0, None), (1, ""), (2, " \n\t "), (3, "word"), (4, plain), (5, plain), (5, plain), (6, " ".join(words(2, 20_000))), (None, plain)]
