"""Tables with the awkward rows that every operator must take."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, kind string, size int, hash string"
PAGES = "page_id long, url string, html string, text string, payload_digest string"


def docs(spark, rows):
    """Rows (doc_id, text) or (doc_id, text, source), with further columns whose names operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 7, 5, "k", 3, "h") for r in rows]
    return spark.createDataFrame(full, DOCS)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "t", "d") for i, u, h in rows], PAGES)


def words(prefix: str, n: int) -> str:
    return " ".join(f"{prefix}{i}" for i in range(n))


def awkward():
    """Nulls, empty and blank texts, repeated rows, ties, a very long text and one very long word."""
    long_text = words("w", 30_000)
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "a b c"), (4, "a b c"), (5, "a  b\tc"), (6, long_text),
        (7, long_text + " end"), (8, "x" * 100_000), (None, "a b c"), (None, None), (9, "é😀 ß"), (10, long_text),
    ]
