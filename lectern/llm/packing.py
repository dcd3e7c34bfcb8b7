"""Packing token ids into training sequences with bounded space.

Each task packs its documents online with ``open_windows`` open windows: a document is
cut into whole windows as far as it reaches, the rest goes to the open window it fits
best, and when none fits the fullest window is topped up with the front of the
piece and emitted, so emitted windows carry no padding. What is still open at a
task's end (at most ``open_windows`` windows) is merged afterwards in rounds: groups of
``fan_in`` remainders are joined, full windows are cut off, and one remainder per group goes
on, until one is left; it is cut into lengths that are powers of two, which need
no padding.

Documents never shuffle; only the open windows of the tasks do, with their ids, in
groups of bounded size. Tasks keep a bounded cache of the ids of seen words: the
tokenizer drops white space and never merges across it, so a text's ids are those of its
words in order.

Defined cases: a null or empty text holds only the end id; a null ``doc_id`` stays null;
repeated documents are packed once each; an empty table gives no pieces; extra
columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import chunks

SIZE = 4096
END_ID = 2
OPEN_WINDOWS = 8
FAN_IN = 16
CACHE_PIECES = 800_000
#: Characters that the tokenizer's normaliser only lower-cases, without white space.
PLAIN = [(0x21, 0x7E), (0xA1, 0x24F), (0x2010, 0x2027), (0x2030, 0x205E), (0x20A0, 0x20BF)]

_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "open", "ids"]


def _plain_pattern():
    """The tokenizer's pre-token pattern for plain characters: letters, one digit,
    contractions, other runs. A contraction starts with an apostrophe, so trying letters
    first changes nothing."""
    plain = [chr(c) for a, b in PLAIN for c in range(a, b + 1)]
    kind = lambda k: "".join(c for c in plain if unicodedata.category(c)[0] == k)
    letters, digits = kind("L"), kind("N")
    cut = re.compile(f"[{letters}]+|[{digits}]|'s|'t|'re|'ve|'m|'ll|'d|[^\\s{letters}{digits}]+")
    return cut.findall, re.compile("[\\t\\n\\r " + "".join(f"{chr(a)}-{chr(b)}" for a, b in PLAIN) + "]*").fullmatch


class WordIds:
    """Little-endian 32-bit ids of texts, by a cache of pre-token ids.

    Texts of plain characters (Latin letters and common punctuation, which the
    normaliser only lower-cases) are cut into pre-tokens by the tokenizer's own pattern,
    and only unseen ones are encoded; words with other characters are encoded whole. New
    strings are encoded many at a time, as one text with a mark between them: the
    mark is one id of its own, so the ids are cut at it. Strings that hold the mark's
    character are encoded alone. The cache is emptied when full."""

    MARK = "\x01"
    TOGETHER = 500
    _loaded: dict[tuple[str, int], WordIds] = {}

    def __init__(self, path: str, most: int = CACHE_PIECES):
        self.most = most
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        mark = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.cut, self.plain = _plain_pattern()

    @classmethod
    def at(cls, path: str, most: int = CACHE_PIECES) -> WordIds:
        """One per Python worker."""
        if (path, most) not in cls._loaded:
            cls._loaded[path, most] = cls(path, most)
        return cls._loaded[path, most]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[str]) -> None:
        alone = [w for w in words if self.mark is None or self.MARK in w]
        for w, ids in zip(alone, self._ids(alone)):
            self.known[w] = ids.tobytes()
        if alone:
            words = [w for w in words if w not in self.known]
        for at in range(0, len(words), 40 * self.TOGETHER):
            parts = [words[i:i + self.TOGETHER] for i in range(at, min(len(words), at + 40 * self.TOGETHER), self.TOGETHER)]
            for part, ids in zip(parts, self._ids([f" {self.MARK} ".join(p) for p in parts])):
                cut = (4 * np.flatnonzero(ids == self.mark)).tolist()
                raw = ids.tobytes()
                for w, x, y in zip(part, [0, *(c + 4 for c in cut)], [*cut, len(raw)], strict=True):
                    self.known[w] = raw[x:y]

    def pieces(self, text: str) -> list[str]:
        """Lower-case pre-tokens of a plain text; of another, its plain words' and its other
        words whole. Joining the pieces' ids gives the text's."""
        if self.plain(text):
            return self.cut(text.lower())
        return [p for w in text.replace("\n", " ").split(" ") if w
                for p in (self.cut(w.lower()) if self.plain(w) else (w,))]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        pieces = [self.pieces(t or "") for t in texts]
        new = set().union(*pieces).difference(self.known)
        if len(self.known) + len(new) > self.most:
            self.known = {}
            new = set().union(*pieces)
        self.learn(list(new))
        find = self.known.__getitem__
        return [b"".join(map(find, p)) for p in pieces]


class Packer:
    """Bounded-space online packing of one task. Rows are lists in ``_COLUMNS`` order."""

    def __init__(self, base: int, size: int = SIZE, open_windows: int = OPEN_WINDOWS, with_ids: bool = False):
        self.size, self.most, self.with_ids = size, open_windows, with_ids
        self.open: list[tuple[int, list]] = []            # tokens used, pieces
        self.next, self.rows = base, []

    def _piece(self, doc, start, ids, total):
        return [doc, start, len(ids) // 4, zlib.crc32(ids), total, ids]

    def emit(self, pieces: list, still_open: bool = False) -> None:
        at = 0
        for doc, start, length, crc, total, ids in pieces:
            self.rows.append([doc, start, length, crc, total, self.next, at, still_open,
                              ids if still_open or self.with_ids else None])
            at += length
        self.next += 1

    def add(self, doc, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        while total - at >= self.size:
            self.emit([self._piece(doc, at, ids[4 * at:4 * (at + self.size)], total)])
            at += self.size
        while at < total:
            rest = total - at
            fits = [i for i, (used, _) in enumerate(self.open) if used + rest <= self.size]
            if not fits and len(self.open) < self.most:
                self.open.append((0, []))
                fits = [len(self.open) - 1]
            if fits:
                best = max(fits, key=lambda i: self.open[i][0])
                take = rest
            else:
                best = max(range(len(self.open)), key=lambda i: self.open[i][0])
                take = self.size - self.open[best][0]
            used, pieces = self.open[best]
            pieces.append(self._piece(doc, at, ids[4 * at:4 * (at + take)], total))
            at += take
            if used + take == self.size:
                self.emit(pieces)
                del self.open[best]
            else:
                self.open[best] = (used + take, pieces)

    def finish(self) -> None:
        for _, pieces in self.open:
            self.emit(pieces, still_open=True)
        self.open = []

    def taken(self) -> list:
        rows, self.rows = self.rows, []
        return rows


def cut_windows(pieces: list, sizes: Iterator[int]) -> list[list]:
    """The pieces (doc, start, length, crc, doc_tokens, ids) joined and cut into windows
    of the given sizes; the last window may be shorter."""
    out, now, room = [], [], next(sizes)
    for doc, start, length, crc, total, ids in pieces:
        while length:
            take = min(length, room)
            part = ids[:4 * take]
            now.append((doc, start, take, zlib.crc32(part), total, part))
            start, length, ids, room = start + take, length - take, ids[4 * take:], room - take
            if not room:
                out.append(now)
                now, room = [], next(sizes)
    return out + [now] if now else out


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, open_windows: int = OPEN_WINDOWS,
         fan_in: int = FAN_IN, end_id: int = END_ID, with_ids: bool = False, cache: int = CACHE_PIECES) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset; with ``with_ids`` also ``ids`` (little-endian 32-bit). ``cache`` bounds the
    pre-tokens that a Python worker remembers, about 200 bytes each."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ddl = (f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
           "sequence_id bigint, offset bigint, open boolean, ids binary")
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.at(tokenizer, cache)
        packer = Packer(TaskContext.get().partitionId() << 32, size, open_windows, with_ids)
        schema = None
        for batch in batches:
            schema = schema or pa.schema([pa.field("doc_id", batch.schema.field("doc_id").type), *_FIELDS])
            for b in chunks(batch, "text"):
                for doc, ids in zip(b.column("doc_id").to_pylist(), words.encode(b.column("text").to_pylist())):
                    packer.add(doc, ids + end)
                if len(packer.rows) >= 5000:
                    yield _batch(packer.taken(), schema)
        packer.finish()
        if packer.rows:
            yield _batch(packer.taken(), schema)

    done = cut_lineage(docs.select("doc_id", "text").mapInArrow(run, ddl))
    out, left = done.where("not open"), done.where("open")
    tasks = (left.agg(F.max(F.shiftright("sequence_id", 32))).first()[0] or 0) + 1
    level = 0
    while True:
        level += 1
        tasks = -(-tasks // fan_in)
        merged = left.groupBy((F.shiftright("sequence_id", 32).bitwiseAND(0xFFFFFF) / fan_in).cast("bigint").alias("group"))
        merged = cut_lineage(merged.applyInArrow(_merger(size, level, tasks == 1, with_ids), ddl))
        out, left = out.unionByName(merged.where("not open")), merged.where("open")
        if tasks == 1:
            break
    return out.select(*[c for c in _COLUMNS if c != "open" and (with_ids or c != "ids")])


_FIELDS = [*(pa.field(c, pa.int64()) for c in _COLUMNS[1:7]), pa.field("open", pa.bool_()), pa.field("ids", pa.binary())]


def _merger(size: int, level: int, last: bool, with_ids: bool):
    """Arrow tables, not pandas: an id beside a null one stays an exact integer."""
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        base = (level << 56) | (int(key[0].as_py()) << 32)
        rows = rows.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        pieces = list(zip(*(rows[c].to_pylist() for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"))))
        total = sum(p[2] for p in pieces)
        rest = total % size
        sizes = [size] * (total // size)
        sizes += [1 << b for b in range(size.bit_length(), -1, -1) if rest >> b & 1] if last else [rest] if rest else []
        out = []
        for n, window in enumerate(cut_windows(pieces, iter([*sizes, size]))):
            keep_open, at = not last and n >= total // size, 0
            for doc, start, length, crc, doc_tokens, ids in window:
                out.append([doc, start, length, crc, doc_tokens, base + n, at, keep_open,
                            ids if keep_open or with_ids else None])
                at += length
        schema = pa.schema([pa.field("doc_id", rows.schema.field("doc_id").type), *_FIELDS])
        return pa.Table.from_batches([_batch(out, schema)] if out else [], schema=schema)
    return run
