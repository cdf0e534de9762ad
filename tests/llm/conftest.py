import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from gustline.session import local_session  # noqa: E402

TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog. " * 6),
    (1, "the quick  brown fox jumps over the lazy dog.\n" * 6),
    (2, None),
    (3, ""),
    (4, "  \t\n "),
    (5, "one"),
    (6, "a b c a b c a b c a b c a b c"),
    (6, "a b c a b c a b c a b c a b c"),
    (7, "x" * 500 + " é😀 中文 слово"),
    (8, "ordinary words and more of them, " * 400),
    (None, "a row without a number"),
    (None, None),
]


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture(scope="session")
def docs(spark):
    """NULLs, empty and long texts, repeated rows and columns whose names clash."""
    rows = [(i, t, f"s{(i or 0) % 3}" if i != 5 else None, "en", 1, 2, "z", 3) for i, t in TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, lang string, fp long, row long, key string, spans int"
    )


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
