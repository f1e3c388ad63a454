from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table from texts, or from (doc_id, text[, lang[, source]])."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            doc_id, text, lang, source = (*row, *("en", "src0")[len(row) - 2 :])
            full.append((doc_id, text, lang, source, len(text) if text is not None else None))
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture
def odd(documents):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977} of{i % 13}" for i in range(60_000))
    return documents(
        [
            (1, None, None, None),
            (None, "a text without an id that has several words in it", "en", "src1"),
            (2, "", "en", "src0"),
            (3, " \t\n ", "en", "src0"),
            (4, long, "en", "src0"),
            (5, "same text twice in the table here", "en", "src0"),
            (5, "same text twice in the table here", "en", "src0"),
            (6, "same text twice in the table here", "de", None),
            (7, "x" * 700_000, "en", "src0"),
            (8, "été 😀 ß Σ", "fr", "src0"),
        ]
    )
