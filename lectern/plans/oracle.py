"""DuckDB SQL fragments used by the oracle strings of the registered queries.

They restate each operator's semantics in plain SQL (DuckDB dialect) over the
driver's pre-registered views. Integer results are cast to BIGINT and doubles
rounded the same way as in the Spark queries.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values, written out here on their own so that a wrong constant in the engine
# shows as a difference: the markers, the reserved tokens, and the white space
# characters (tab to carriage return, U+001C to U+001F, space, next line, no-break
# space, ogham space, en quad to hair space, line and paragraph separator, narrow
# no-break space, medium mathematical space, ideographic space).
HEADER_MARKER = "START OF THIS PROJECT GUTENBERG EBOOK"
FOOTER_MARKER = "End of the Project Gutenberg"
UNK_TOKEN, EOS_TOKEN = "<unk>", "<|endoftext|>"
WS = "[" + "".join(chr(c) for c in (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003,
    0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)) + "]"
# ---------------------------------------------------------------------------
HEADER_RE = r"(?s)\A.*" + HEADER_MARKER + r".*?\*{3}"
FOOTER_RE = r"(?s)" + FOOTER_MARKER + r".*"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip_header(e: str) -> str:
    return (f"(CASE WHEN instr({e}, {q(HEADER_MARKER)}) > 0 "
            f"THEN regexp_replace({e}, {q(HEADER_RE)}, '') ELSE {e} END)")


def strip_footer(e: str) -> str:
    return (f"(CASE WHEN instr({e}, {q(FOOTER_MARKER)}) > 0 "
            f"THEN regexp_replace({e}, {q(FOOTER_RE)}, '') ELSE {e} END)")


def normalize_ws(e: str) -> str:
    return f"regexp_replace({e}, {q(WS + '+')}, ' ', 'g')"


def strip_ws(e: str) -> str:
    return f"regexp_replace({e}, {q(r'\A' + WS + '+|' + WS + r'+\z')}, '', 'g')"


def clean(e: str) -> str:
    return f"trim({normalize_ws(strip_footer(strip_header(e)))}, ' ')"


def ws_tokens(e: str) -> str:
    return f"list_filter(string_split({e}, ' '), lambda x: x <> '')"


def md5key(seed: int, *cols: str) -> str:
    return "md5(" + " || ':' || ".join([q(str(seed))] + [f"CAST({c} AS VARCHAR)" for c in cols]) + ")"


def uniform01(seed: int, *cols: str) -> str:
    return (f"(CAST(CAST(('0x' || substr({md5key(seed, *cols)}, 1, 8)) AS BIGINT) AS DOUBLE)"
            f" / CAST(4294967296 AS DOUBLE))")


# documents -> cleaned text -> token rows -> vocabulary, as CTEs
def corpus_ctes(source: str = "documents", clean_text: bool = True,
                token_expr: str | None = None) -> str:
    text = clean("text") if clean_text else "text"
    tokens = token_expr or ws_tokens("text")
    return f"""
cdocs AS (SELECT doc_id, lang, source, {text} AS text FROM {source}),
toks AS (
  SELECT doc_id, lang, unnest(l) AS tok, generate_subscripts(l, 1) - 1 AS pos
  FROM (SELECT doc_id, lang, {tokens} AS l FROM cdocs)),
vcounts AS (SELECT tok, count(*) AS cnt FROM toks
            WHERE tok NOT IN ({q(UNK_TOKEN)}, {q(EOS_TOKEN)}) GROUP BY tok),
vocab AS (SELECT tok, CAST(row_number() OVER (ORDER BY cnt DESC, tok) + 1 AS BIGINT) AS id,
                 cnt FROM vcounts),
tids AS (SELECT t.doc_id, t.lang, t.pos, t.tok, coalesce(v.id, 0) AS id
         FROM toks t LEFT JOIN vocab v USING (tok))"""


def split_label(rank: str = "r", n: str = "n", test_size: float = 0.1) -> str:
    return (f"unnest(CASE WHEN {n} < 2 THEN ['train', 'validation'] ELSE "
            f"[CASE WHEN {rank} < ceil({test_size} * {n}) THEN 'validation' ELSE 'train' END] END)")
