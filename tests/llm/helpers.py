"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

LONG = "wordy sentence number one. " * 4000

#: doc_id, text, lang, source, n_chars, and columns whose names operators use inside
DOCS = [
    (1, "A plain text about nothing much, with a few words in it.", "en", "a", 10, 1.0, "x"),
    (2, None, "en", "a", None, 2.0, None),
    (3, "", None, None, 0, None, "x"),
    (4, LONG, "en", "b", 5, 1.0, "x"),
    (5, "A plain text about nothing much, with a few words in it.", "de", "b", 10, 1.0, "x"),
    (5, "A plain text about nothing much, with a few words in it.", "de", "b", 10, 1.0, "x"),
    (None, "No id at all, but a text all the same.", "en", None, 1, 1.0, "x"),
    (None, None, None, None, None, None, None),
    (9, "   \t\n ", "fr", "c", 4, 1.0, "x"),
    (10, "12345 67890 !!! ---", "fr", "c", 4, 1.0, "x"),
]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size string"


def docs(spark, rows=None):
    return spark.createDataFrame(DOCS if rows is None else rows, DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def groups(nodes, links):
    """The smallest member that each node reaches."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
