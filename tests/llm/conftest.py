import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept int, digest string, size string, key string, mark long, __id int"


@pytest.fixture
def docs_frame(spark):
    """Documents with clashing extra columns; rows are (doc_id, text, source)."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, 0, 7, "d", "s", "k", 1, 2) for i, t, s in rows], DOCS)
    return make


ODD = [(1, "a b c d", "x"), (1, "a b c d", "x"), (2, None, None), (3, "", "x"), (None, "a b c d", "x"), (4, "long " * 60_000, "y"), (5, "é\u00a0\u0085 A", None), (6, " \t\n", "y")]


@pytest.fixture
def odd_docs(docs_frame):
    return docs_frame(ODD)
