from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, digest int, `words` string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows,
    and extra columns whose names helper columns would like to have."""
    base = " ".join(f"w{i}" for i in range(80))
    near = base.replace("w40 ", "changed ")
    long_text = " ".join(f"v{i % 5000}" for i in range(60_000)) + " " + "x" * 200_000
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 2), (3, near, "en", None, 3), (4, None, "de", "b", None),
        (5, "", None, "b", 0), (6, " \n\t ", "de", None, 4), (None, base, "en", "a", 5), (8, long_text, "en", "a", 6),
        (9, "one", "fr", "c", 7), (10, "one", "fr", "c", 7), (11, "one  two three é 日本\n\nfour", None, None, 8),
        (12, "l1 x\nl1 x\n\nl2 # $", "en", "a", 9), (2, base, "en", "a", 2), (13, None, None, None, None),
        (14, "start " + base + " end", "es", "c", 10),
    ]
    return spark.createDataFrame([(*r, "r", 7, None) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    """The same table without rows."""
    return odd.filter("1 = 0")


def pytest_configure(config):
    config.addinivalue_line("markers", "llm: training-data operators")
