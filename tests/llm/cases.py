"""Small documents for the operator tests."""

from __future__ import annotations

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows):
    """``rows``: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1]) if r[1] is not None else None)
            for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


#: Null and empty texts, a null id, ties, repeated rows, a long text.
ODD_TEXTS = [
    (1, "One two three four five. Six seven.\nEight"), (2, None), (3, ""), (4, "   \n\t "),
    (5, "One two three four five. Six seven.\nEight"), (None, "no id here at all, is it"),
    (6, "same row"), (6, "same row"), (7, "é漢字🙂 x"), (8, "long word " * 30_000),
]
