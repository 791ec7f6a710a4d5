import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from cases import COLUMNS, texts  # noqa: E402


@pytest.fixture
def documents(spark):
    """A frame of texts, with repeated rows, a null doc_id and columns whose names operators could use themselves."""

    def make(seed: int = 1, n: int = 60):
        found = texts(seed, n)
        rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "k", 1, "t") for i, t in enumerate(found)]
        rows += [rows[5], rows[5], (None, found[7], None, None, None, None, None, None)]
        return spark.createDataFrame(rows, COLUMNS)

    return make


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], COLUMNS)
