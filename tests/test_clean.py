"""Cleaning (B1-B5): hand-written cases, an independent checker on random inputs, and
the line form against the whole-text form."""

import random
import sys

from pyspark.sql import functions as F

from conftest import docs_df
from lectern.functions import text as tx
from lectern.operators.lines import clean_lines

START = "START OF THIS PROJECT GUTENBERG EBOOK"
END = "End of the Project Gutenberg"
BLANK = {c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()}


def checked(t: str) -> str:
    """The cleaned text by searching strings: the last start marker that is followed by
    three asterisks opens the cut, the first three asterisks after it close it; the
    first end marker in what is left ends the text; white space is collapsed."""
    stars = t.rfind("***")
    opens = t.rfind(START, 0, max(stars, 0))
    if opens >= 0:
        t = t[t.index("***", opens + len(START)) + 3:]
    ends = t.find(END)
    if ends >= 0:
        t = t[:ends]
    words, word = [], ""
    for c in t:
        if c in BLANK:
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    return " ".join(words + [word] * bool(word))


def run(spark, texts, fn):
    df = docs_df(spark, texts).select("doc_id", fn("text").alias("t")).orderBy("doc_id")
    return [r.t for r in df.collect()]


def test_whole_book(spark):
    body = ["Chapter one.\nIt was late,\n\tand the lamp   was out.", "Chapter two.", "No one came."]
    raw = (f"Some archive note\n*** {START} NIGHT LAMP ***\r\n\n" + "\n\n".join(body)
           + f"\n\n{END} EBook of Night Lamp\nlegal text ***\n")
    assert run(spark, [raw], tx.clean_text) == ["Chapter one. It was late, and the lamp was out. Chapter two. No one came."]


def test_header_edge_cases(spark):
    cases = {
        f"a *** {START} X *** b {START} Y *** c": " c",                    # the last closed marker counts
        f"pre {START} never closed": f"pre {START} never closed",
        f"pre {START} X **** body": "* body",                              # four asterisks: one is left
        "pre START OF THE PROJECT GUTENBERG EBOOK X *** body": "pre START OF THE PROJECT GUTENBERG EBOOK X *** body",
        "": "",
        f"x {START} *** y {START} z": f" y {START} z",                     # the second marker is never closed
        f"x {START}\n\nA ***\nbody": "\nbody",                             # closed on a later line
    }
    assert run(spark, list(cases), tx.strip_header) == list(cases.values())


def test_footer_cut_at_first(spark):
    assert run(spark, [f"body {END} one {END} two"], tx.strip_footer) == ["body "]


def test_whitespace_set(spark):
    blanks = ["\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", " ", "　", "\x0b"]
    texts = [f"a{c}b" for c in blanks] + ["a​b", "  \t\n ", "\r\nx\ry\n"]
    assert run(spark, texts, tx.clean_text) == ["a b"] * len(blanks) + ["a​b", "", "x y"]


def pieces():
    rnd = random.Random(7)
    alphabet = ["a", "b", " ", "\n", "\t", "\xa0", "*", "***", "\x1c", f" {START} ", END, f"{START}***", "****"]
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(400)]


def test_random_agreement(spark):
    assert run(spark, pieces(), tx.clean_text) == [checked(t) for t in pieces()]


def test_lines_equal_whole_text(spark):
    """Header and footer by position: every marker case, with lines as rows."""
    texts = pieces() + [f"n\n*** {START} X ***\nbody {i}\nmore\n{END}\nx" for i in range(5)]
    lines = docs_df(spark, texts).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "text"), F.lit("k").alias("kept"))
    out = clean_lines(lines.repartition(5), "doc_id", "line_no")
    assert out.columns == ["doc_id", "line_no", "text", "kept"]
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r.doc_id, r.line_no)):
        got.setdefault(r.doc_id, []).append(r.text)
    assert [" ".join(x for x in got.get(i, []) if x) for i in range(len(texts))] == [checked(t) for t in texts]


def test_clean_idempotent_without_markers(spark):
    texts = ["  a  b\n\nc ", "x", "", "　y　"]
    once = run(spark, texts, tx.clean_text)
    assert run(spark, once, tx.clean_text) == once


def test_strip_ws_and_lines(spark):
    assert run(spark, ["  hi there \x1c\n"], tx.strip_ws) == ["hi there"]
    df = docs_df(spark, ["a\r\nb\rc\n", "", "one"]).select(
        "doc_id", tx.split_lines("text").alias("l")).orderBy("doc_id")
    assert [r.l for r in df.collect()] == [["a", "b", "c"], [], ["one"]]


def test_sanitize_and_paths(spark):
    df = spark.createDataFrame([("Aesop: Fables?", "The Fox / Grapes / Book 1 ")], "author string, title string")
    r = df.select(tx.sanitize_name("author").alias("a"),
                  tx.landing_path(F.lit("root"), "author", "title").alias("p"),
                  tx.archive_query("author", "title").alias("q")).first()
    assert r.a == "Aesop Fables"
    assert r.p == "root/Aesop Fables/The Fox  Grapes  Book 1.txt"
    assert r.q == 'creator:"Aesop: Fables?" AND title:"The Fox / Grapes / Book 1 " AND mediatype:texts AND language:"English"'
