import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

#: The columns of documents, and one more that clashes with a name an operator uses.
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, size string"


@pytest.fixture
def documents(spark):
    """Makes documents from (doc_id, text) or (doc_id, text, source)."""

    def make(rows):
        full = [
            (id, text, "en", *(rest or ["a"]), len(text or ""), "extra") for id, text, *rest in rows
        ]
        return spark.createDataFrame(full, DOCUMENTS)

    return make
