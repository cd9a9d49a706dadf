"""Small document tables with awkward rows."""

from __future__ import annotations

AWKWARD = [None, "", " \n\n ", "one", "one", "Ünïcode é\nline two\n\nline four", "x" * 3000]

# Names that the operators use themselves.
EXTRA = "version long, term string, n_hit string, bits string, window string, label string"


def documents(spark, texts, first_id=0):
    """Rows of the documents table, one per text, with columns that nobody asked for."""
    rows = [
        (first_id + n, text, "en", "src", len(text or ""), 1, "t", "n", "b", "w", "l")
        for n, text in enumerate(texts)
    ]
    return spark.createDataFrame(
        rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    )


def collected(frame, key="doc_id"):
    """Rows by id; ids must not repeat."""
    rows = frame.collect()
    found = {row[key]: row for row in rows}
    assert len(found) == len(rows)
    return found
