import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tallyrill.session import local_session  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    return local_session("8", 4)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, a long one, repeated rows, and a column whose name may clash."""
    long_text = " ".join(f"w{i % 997}" for i in range(30_000))
    rows = [(1, "one two three four five six seven", "en"), (1, "one two three four five six seven", "en"),
            (2, None, "en"), (3, "", None), (4, " \n\t ", "fr"), (None, "lost id here", "en"), (None, None, None),
            (5, long_text, "en"), (6, "123 456", "fr"), (7, "Ünï çödé \U0001F600 text", "fr")]
    full = [(i, t, lang, "s", len(t or ""), 0.5, "x") for i, t, lang in rows]
    return spark.createDataFrame(full, DOCS + ", score double, `rejected` string")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
