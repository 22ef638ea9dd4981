from __future__ import annotations

import pytest

TEXTS = [
    (1, "one two three four five six seven eight nine ten"),
    (2, "one two three four five six seven eight nine ten"),
    (3, ""),
    (4, None),
    (None, "a text without an id, one two three"),
    (5, "Short."),
    (5, "Short."),
    (6, " \t\n \x1c   　"),
    (7, "ünïcödé ß 你好 <|endoftext|> it's 42!! \U0001f600 a̐b\r\nnew  line\x00"),
    (-8, "word " * 5000 + "end."),
    (9, "x" * 9000),
]
NAMES = "n_tokens n_bytes key node block part token component score matches base spans h1 n i words rank label host marks page".split()


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like those the operators make."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES)
    rows = [(k, t, "en", None, len(t or ""), *["?"] * len(NAMES)) for k, t in TEXTS]
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is not None, str(type(v)), v) if not isinstance(v, (list, dict)) else (True, "", str(v)) for v in r])
