import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"

#: Columns with names that operators use themselves.
CLASH = "doc_id long, text string, lang string, hash long, node string, n long, words string, check string, kept string, n_replaced string, label long, spans string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with clashing further columns, from (doc_id, text) or (doc_id, text, lang)."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", 7, "a", 1, "w", "c", "k", "z", 5, "s") for r in rows]
        return spark.createDataFrame(full, CLASH)
    return make
