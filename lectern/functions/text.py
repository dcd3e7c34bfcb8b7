"""Column expressions for text cleaning and naming.

Everything here returns a ``Column`` built from Spark's own string functions,
so it runs inside whole-stage codegen and accepts batch or streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's behaviour for right results.
# Boilerplate markers (case-sensitive, "THIS" not "THE"):
HEADER_MARKER = "START OF THIS PROJECT GUTENBERG EBOOK"
FOOTER_MARKER = "End of the Project Gutenberg"
# The set of characters Python's str `\s` matches (29 code points):
# \t \n \v \f \r, U+001C-U+001F, space, U+0085, U+00A0, U+1680,
# U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
WS_CHARS = (r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS_CLASS = "[" + WS_CHARS + "]"
# The same set behind two range checks, which letters fail at once (Java regex only).
WS_QUICK = r"[\x00-\x20\x7F-\x{3000}&&" + WS_CLASS + "]"
# Characters a landing file name keeps besides letters and digits:
NAME_EXTRA_CHARS = " ._-"
# Catalogue search text for one work (author, title), no quote escaping:
ARCHIVE_QUERY_FORMAT = 'creator:"%s" AND title:"%s" AND mediatype:texts AND language:"English"'
# ---------------------------------------------------------------------------

# Anchored at the start of the text: the unanchored form retries `.*` from every
# offset and is quadratic; anchoring gives the same result (the leftmost match,
# if any, starts at offset 0, and the greedy `.*` reaches the last marker that
# still has a later `***`, so nothing after the cut can match again).
HEADER_PATTERN = r"(?s)\A.*" + HEADER_MARKER + r".*?\*{3}"
FOOTER_PATTERN = r"(?s)" + FOOTER_MARKER + r".*"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_header(text) -> Column:
    t = _c(text)
    return F.when(F.instr(t, HEADER_MARKER) > 0,
                  F.regexp_replace(t, F.lit(HEADER_PATTERN), F.lit(""))).otherwise(t)


def strip_footer(text) -> Column:
    t = _c(text)
    return F.when(F.instr(t, FOOTER_MARKER) > 0,
                  F.regexp_replace(t, F.lit(FOOTER_PATTERN), F.lit(""))).otherwise(t)


def normalize_ws(text) -> Column:
    """Every run of (Python) whitespace becomes one space."""
    return F.regexp_replace(_c(text), F.lit(WS_QUICK + "+"), F.lit(" "))


def strip_ws(text) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace."""
    return F.regexp_replace(_c(text), F.lit(r"\A" + WS_CLASS + r"+|" + WS_CLASS + r"+\z"),
                            F.lit(""))


def clean_text(text, header: bool = True, footer: bool = True) -> Column:
    """Header -> footer -> collapse whitespace -> strip, in that order."""
    t = _c(text)
    if header:
        t = strip_header(t)
    if footer:
        t = strip_footer(t)
    # after collapsing, the only whitespace left is single spaces
    return F.trim(normalize_ws(t))


def universal_newlines(text) -> Column:
    """Text-mode reading: CRLF and lone CR become LF."""
    return F.regexp_replace(_c(text), F.lit("\r\n?"), F.lit("\n"))


def split_lines(text) -> Column:
    """Lines of a text as a line-oriented text reader yields them.

    Splits on LF, CRLF and CR; a final terminator does not open an empty line;
    an empty text has no lines.
    """
    t = _c(text)
    body = F.regexp_replace(t, F.lit(r"(\r\n|\r|\n)\z"), F.lit(""))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(
        F.split(body, r"\r\n|\r|\n"))


def sanitize_name(name) -> Column:
    """Keep letters, digits, space, '.', '_', '-'; then right-strip."""
    return F.rtrim(F.regexp_replace(_c(name), F.lit(r"[^\p{L}\p{N} ._-]"), F.lit("")))


def landing_path(root, author, title) -> Column:
    """``root/author/title.txt`` with sanitised parts."""
    return F.concat_ws("/", _c(root), sanitize_name(author),
                       F.concat(sanitize_name(title), F.lit(".txt")))


def archive_query(author, title) -> Column:
    """The catalogue search text (no quote escaping, as in the original)."""
    return F.format_string(ARCHIVE_QUERY_FORMAT, _c(author), _c(title))


def two_decimals(x) -> Column:
    """``%.2f`` (half-even on the binary value, as printf does)."""
    return F.format_string("%.2f", _c(x).cast("double"))
