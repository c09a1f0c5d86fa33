import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def documents(spark):
    """Builds a documents table from (doc_id, text) pairs or (doc_id, text, source) triples."""

    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return build
