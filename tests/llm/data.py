"""Small inputs shared by the tests."""

import random

#: Columns that clash with names the operators use themselves.
EXTRA = ("n_words bigint, spans string, items string, sig bigint, token bigint, row bigint, w string, kept boolean, "
         "held_out int, edits int, digest string, root bigint")


def make_docs(spark, rows):
    """documents with clashing extra columns, from (doc_id, text)."""
    return spark.createDataFrame([(i, t, 7, "s", "i", 1, 2, 3, "w", True, 0, 9, "d", 5) for i, t in rows],
                                 f"doc_id bigint, text string, {EXTRA}")


def edge_rows():
    """Nulls, empty and blank texts, ties, repeated rows, odd characters, one long text."""
    r = random.Random(4)
    words = ["the", "of", "And", "licénse", "tion", "heed", "mail", "x1", "ß", "Ünder", "42"]
    prose = lambda n: " ".join(r.choice(words) + r.choice(["", "", "", ".", ",\n"]) for _ in range(n))
    base = prose(60)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, "one"), (5, "one two THREE"), (6, base), (7, base), (7, base),
            (8, base.replace("heed", "need", 1)), (9, base + " tail end words here"), (None, "null id text of some words"),
            (None, None), (10, "line a b c\nline a b c\nline a b c\n" * 5), (11, prose(30_000)), (12, "\x00 \u00a0 \u2003 \U0001F600 é"),
            (13, base.upper()), (-1, base + " x")]
    return rows + [(100 + i, prose(r.randint(5, 120))) for i in range(25)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
