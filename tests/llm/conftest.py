import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture
def documents(spark):
    """Makes a documents-like table from texts or (doc_id, text) rows."""

    def make(rows, **more):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        names = ", ".join(f"{k} {v}" for k, v in more.items())
        filled = [(*r, *[None] * len(more)) for r in rows]
        return spark.createDataFrame(filled, "doc_id long, text string" + (f", {names}" if names else ""))

    return make
