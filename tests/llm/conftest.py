import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()

#: Null, empty, white space, one word, repeated rows, long, symbols, other scripts.
ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "word",
    "same words here again and again",
    "same words here again and again",
    " ".join(WORDS * 400),
    "### %%% $$$ *** ||| <<< >>> &&&",
    "naïve café 中文 한국어 😀\r\nline\x0b\x0cend",
    "A A A A A A A A",
    "x\ny\nx\n\n \nx\ny",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with every odd text, a null id, and extra columns whose names clash."""
    rows = [(i, text, "x", 1, True, 0.5) for i, text in enumerate(ODD_TEXTS)]
    rows.append((None, "a null id with some words", None, None, None, None))
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, n_words int, kept boolean, id double"
    )


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


@pytest.fixture(scope="module")
def prose():
    """A function that makes texts of so many random words; it starts anew in every module."""
    rng = random.Random(7)

    def make(n, letters="abcdefghij"):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))

    return make
