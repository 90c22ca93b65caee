import random

import pytest

#: Columns whose names the operators use for themselves.
CLASHING = {"key": 1, "n": 2, "digest": 3, "keep": 4, "gone": 5, "batch": 6, "part": 7, "size": 8, "score": 9, "u": 10, "v": 11, "c": 12, "g": 13, "place": 14, "label": 15, "th": 16}


def make(spark, rows, extra=True):
    """documents of (doc_id, text, lang, source) rows, with clashing columns."""
    names = list(CLASHING) if extra else []
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{n}` int" for n in names)
    return spark.createDataFrame([(*r, len(r[1] or ""), *(CLASHING[n] for n in names)) for r in rows], schema)


@pytest.fixture(scope="session")
def vocabulary():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(3000)]


@pytest.fixture(scope="session")
def odd_rows(vocabulary):
    """Nulls, empty texts, blanks, repeated rows, ties, a very long text and one word."""
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice(vocabulary) + ("." if rng.random() < 0.1 else "") for _ in range(n))
    same = text(60)
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, " \n\t ", "en", "b"), (4, same, "en", "a"), (5, same, "fr", "a"), (6, same + " more", "en", None), (6, same + " more", "en", None), (7, text(20000), "de", "b"), (8, "One", "en", "b"), (9, "...", "en", "b"), (None, text(30), "en", "a"), (10, "É é   É", "fr", "a"), (11, "a\n\n\nb\n", "en", "a")]
    return rows + [(i, text(rng.randint(5, 80)), rng.choice(["en", "de"]), rng.choice(["a", "b"])) for i in range(20, 50)]
