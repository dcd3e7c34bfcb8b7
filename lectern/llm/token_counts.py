"""Edit-aware token counting with a segment tree per document.

A document's text is cut behind white space into leaves of about ``LEAF`` characters; the
tokenizer never merges across white space, so a text's token count is the sum of its leaves'
counts. A segment tree over the leaves holds characters and tokens of every subtree. An
edit finds its leaf by the character sums in logarithmic time, changes the
leaves it touches, takes in the start of the next leaf if a word now runs across the
border, and marks what has to be encoded again; after all edits only marked
leaves are encoded, and the sums on the way to the root are updated.

``build`` counts documents and returns the leaves as arrays, which can be stored;
``apply_edits`` takes such rows with a column of edits and returns the same for the edited
text, so further edits never need a full count. Documents are only mapped;
``with_edits`` brings an edit table to its documents by one join, grouped by document
(a group is one document's edits).

Edits apply in order; each one's positions are code points of the text left by those
before it. Defined cases: a null text is empty; null edits mean none, a null
replacement deletes; positions beyond the text are moved to its end, an end before
its start is moved to it; edits of unknown documents are ignored; documents
repeated under one id each get its edits; empty tables work; other columns are kept
by ``build`` and ``apply_edits``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .packing import WordIds
from .words import chunks

LEAF = 400
CACHE = 200_000       # cached pre-tokens of a Python worker; several workers serve one task here
SPACE = re.compile("[ \n]")
EDITS = "array<struct<start:bigint,end:bigint,text:string>>"
_STATE = ["leaf_chars", "leaf_tokens", "n_tokens"]
_LIST = pa.list_(pa.int64())


def cut_leaves(text: str, size: int = LEAF) -> list[str]:
    """``text`` in order, every leaf but the last ending with a blank or line end."""
    out, at = [], 0
    while at < len(text):
        m = SPACE.search(text, at + size - 1)
        to = m.end() if m else len(text)
        out.append(text[at:to])
        at = to
    return out or [""]


class Tree:
    """Sums of characters and tokens over leaves; node 1 is the root."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.cap = 1 << max(0, (len(chars) - 1).bit_length())
        pad = [0] * (self.cap - len(chars))
        self.sums = [[0] * self.cap + list(v) + pad for v in (chars, tokens)]
        for s in self.sums:
            for i in range(self.cap - 1, 0, -1):
                s[i] = s[2 * i] + s[2 * i + 1]

    @property
    def chars(self) -> int:
        return self.sums[0][1]

    @property
    def tokens(self) -> int:
        return self.sums[1][1]

    def put(self, which: int, leaf: int, value: int) -> None:
        s, i = self.sums[which], self.cap + leaf
        change = value - s[i]
        while change and i:
            s[i] += change
            i >>= 1

    def find(self, position: int) -> tuple[int, int]:
        """Leaf that holds a character position, and the position in it."""
        s, i = self.sums[0], 1
        while i < self.cap:
            i *= 2
            if position >= s[i]:
                position -= s[i]
                i += 1
        return i - self.cap, position


class Document:
    def __init__(self, text: str, chars: list[int], tokens: list[int]):
        self.tree, self.leaves, at = Tree(chars, tokens), [], 0
        for n in chars:
            self.leaves.append(text[at:at + n])
            at += n
        self.marked: set[int] = set()

    def _set(self, i: int, text: str) -> None:
        self.leaves[i] = text
        self.tree.put(0, i, len(text))
        self.marked.add(i)

    def edit(self, start: int, end: int, new: str) -> None:
        total = self.tree.chars
        start = min(max(start, 0), total)
        end = min(max(end, start), total)
        if start < total:
            i, off = self.tree.find(start)
        else:
            i = max((k for k, t in enumerate(self.leaves) if t), default=0)
            off = len(self.leaves[i])
        gone, j, tail = off + end - start, i, self.leaves[i]
        while gone > len(tail):
            gone -= len(tail)
            j += 1
            tail = self.leaves[j]
            self._set(j, "")
        self._set(i, self.leaves[i][:off] + new + tail[gone:])
        # boundary context: a leaf that no longer ends a word takes the rest of it
        j = max(i, j)
        while self.leaves[i] and self.leaves[i][-1] not in " \n" and j + 1 < len(self.leaves):
            j += 1
            nxt = self.leaves[j]
            if nxt:
                m = SPACE.search(nxt)
                to = m.end() if m else len(nxt)
                self._set(i, self.leaves[i] + nxt[:to])
                self._set(j, nxt[to:])


def count(words: WordIds, texts: list[str]) -> list[int]:
    return [len(ids) // 4 for ids in words.encode(texts)]


def _state(schema: T.StructType, cols: list[str]) -> T.StructType:
    fields = [schema[c] for c in cols]
    longs = T.ArrayType(T.LongType())
    return T.StructType([*fields, T.StructField("leaf_chars", longs), T.StructField("leaf_tokens", longs),
                         T.StructField("n_tokens", T.LongType())])


def build(docs: DataFrame, tokenizer: str, leaf: int = LEAF) -> DataFrame:
    """``docs`` with ``leaf_chars``, ``leaf_tokens`` and ``n_tokens``."""
    docs = docs.drop(*_STATE)
    cols = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.at(tokenizer, CACHE)
        for batch in batches:
            for b in chunks(batch, "text"):
                leaves = [cut_leaves(t or "", leaf) for t in b.column("text").to_pylist()]
                flat = iter(count(words, [x for d in leaves for x in d]))
                tokens = [[next(flat) for _ in d] for d in leaves]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in cols), pa.array([[len(x) for x in d] for d in leaves], _LIST),
                     pa.array(tokens, _LIST), pa.array([sum(d) for d in tokens], pa.int64())], names=[*cols, *_STATE])

    return docs.mapInArrow(run, _state(docs.schema, cols))


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """``docs`` with the rows of ``edits`` (doc_id, seq, start, end, text) as ``edits``."""
    grouped = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("seq", "start", "end", "text"))).alias("all"))
    grouped = grouped.select("doc_id", F.transform("all", lambda e: F.struct(e["start"], e["end"], e["text"])).cast(EDITS).alias("edits"))
    return docs.drop("edits").join(grouped, "doc_id", "left")


def apply_edits(state: DataFrame, tokenizer: str, keep_text: bool = True, propose=None) -> DataFrame:
    """``build``'s rows with a column ``edits`` (or with the edits that the function
    ``propose`` makes of each text, see ``cleaning_edits_of``), after them: new text (left out if not
    ``keep_text``), leaves and ``n_tokens``; also ``n_edits``, ``n_tokens_before`` and
    ``n_encoded``, the code points that had to be encoded again."""
    cols = [c for c in state.columns if c not in {*_STATE, "edits", "n_edits", "n_tokens_before", "n_encoded"}]
    if not keep_text:
        cols.remove("text")
    schema = _state(state.schema, cols)
    for c in ("n_edits", "n_tokens_before", "n_encoded"):
        schema = schema.add(c, T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.at(tokenizer, CACHE)
        for batch in batches:
            for b in chunks(batch, "text"):
                edits = [propose(t or "") for t in b.column("text").to_pylist()] if propose else b.column("edits").to_pylist()
                before = b.column("n_tokens").to_pylist()
                touched = [d for d, e in enumerate(edits) if e]
                text, new = b.column("text"), {}
                chars, tokens = b.column("leaf_chars"), b.column("leaf_tokens")
                for d in touched:
                    new[d] = doc = Document(text[d].as_py() or "", chars[d].as_py(), tokens[d].as_py())
                    for e in edits[d]:
                        doc.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
                marked = [(doc, i) for doc in new.values() for i in sorted(doc.marked)]
                for (doc, i), n in zip(marked, count(words, [doc.leaves[i] for doc, i in marked])):
                    doc.tree.put(1, i, n)
                if new:
                    value = lambda old, of: pa.array(
                        [of(new[i]) if i in new else x for i, x in enumerate(old.to_pylist())], old.type)
                    leaf_sum = lambda doc, which: doc.tree.sums[which][doc.tree.cap:doc.tree.cap + len(doc.leaves)]
                    text = value(text, lambda doc: "".join(doc.leaves)) if keep_text else text
                    chars = value(chars, lambda doc: leaf_sum(doc, 0))
                    tokens = value(tokens, lambda doc: leaf_sum(doc, 1))
                encoded = [0] * b.num_rows
                for d in touched:
                    encoded[d] = sum(len(new[d].leaves[i]) for i in new[d].marked)
                after = [new[d].tree.tokens if d in new else n for d, n in enumerate(before)]
                yield pa.RecordBatch.from_arrays(
                    [*(text if c == "text" else b.column(c) for c in cols), chars, tokens, pa.array(after, pa.int64()),
                     pa.array([len(e or ()) for e in edits], pa.int64()), pa.array(before, pa.int64()), pa.array(encoded, pa.int64())],
                    names=schema.names)

    return state.mapInArrow(run, schema)


MARKS = re.compile(r"[#*$%&|<>!]+|[0-9]{4,}")


def cleaning_edits_of(text: str, pattern: re.Pattern = MARKS) -> list[dict]:
    """The edits that a cleaning step would make: runs of markup characters are deleted,
    long digit runs become ``0``."""
    edits, shift = [], 0
    for m in pattern.finditer(text):
        new = "0" if m.group()[0].isdigit() else ""
        edits.append({"start": m.start() + shift, "end": m.end() + shift, "text": new})
        shift += len(new) - (m.end() - m.start())
    return edits
