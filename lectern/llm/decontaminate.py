"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items are put into one suffix automaton (one
string per item, so no match crosses two items). Training documents stream
through it word by word; the longest match ending at each word gives every
occurrence of a window: ``k`` consecutive item words, or a whole item of fewer.
Words inside an occurrence are hit; ``clean`` cuts the hit spans out of the
text and drops a document whose hit share exceeds the coverage limit.

Streaming skips what cannot match: a match of two or more words lies in a run of
words whose neighbouring pairs all occur in some item, so runs that are too short
for any window are passed over with array operations and only the rest is fed to
the automaton.

Scale: documents are only mapped, never shuffled. The items may be many: they are
dealt by hash into shards of about ``shard_words`` words, each with its own automaton
(size bounded by the shard), and documents pass through the shards one after the
other, carrying spans and items found so far. Only one shard's items are on the
driver at a time.

Defined cases: null or empty text has no words and no hits, an item without words
matches nothing, a null ``item_id`` is reported as an empty string, repeated
documents are judged one by one, items with equal text all count, an empty item
table leaves every document clean. Extra columns stay, but for
those that ``scan`` names itself; ``clean`` keeps all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import ALNUM, LOWER, chunks, hashes, words_of

K = 10
SHARD_WORDS = 1_000_000
MIN_SPAN = 10
MAX_COVERAGE = 0.8

_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


class Automaton:
    """Generalised suffix automaton over word ids, with the windows of each item."""

    def __init__(self, items: list[tuple[str, np.ndarray]], k: int = K):
        """``items``: (item id, word hashes)."""
        self.k = k
        self.vocab = np.unique(np.concatenate([np.zeros(0, np.uint64), *(h for _, h in items)]))
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts = [(item, np.searchsorted(self.vocab, h).tolist()) for item, h in items if len(h)]
        for _, ids in texts:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        # by state: items with a window of k words there, and short items with their length
        self.full: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        pairs = set()
        for item, ids in texts:
            state = 0
            for i, c in enumerate(ids):
                state = self.next[state][c]
                while self.length[self.link[state]] >= k:
                    state = self.link[state]
                if i + 1 >= k:
                    self.full.setdefault(state, set()).add(item)
            if len(ids) < k:
                self.short.setdefault(state, []).append((len(ids), item))
            pairs.update(zip(ids, ids[1:]))
        self.least = min([k, *(n for v in self.short.values() for n, _ in v)])
        self.pairs = np.sort(np.array([a * len(self.vocab) + b for a, b in pairs], np.int64))
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.vocab & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.has_short = bool(self.short)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of ``q`` for its strings no longer than ``p``'s plus one."""
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def runs(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word ids (-1: not in any item), and bounds of the runs worth streaming."""
        ids = np.full(len(h), -1, np.int64)
        if not len(self.vocab):
            return ids, ids[:0], ids[:0]
        near = np.flatnonzero(self.seen[(h & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocab, h[near]), len(self.vocab) - 1)
        ok = self.vocab[at] == h[near]
        ids[near[ok]] = at[ok]
        joined = (ids[:-1] >= 0) & (ids[1:] >= 0)
        joined[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(h))] - 1] = False
        where = np.flatnonzero(joined)
        code = ids[where] * len(self.vocab) + ids[where + 1]
        if len(self.pairs):
            p = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            joined[where[self.pairs[p] != code]] = False
        else:
            joined[:] = False
        known = ids >= 0
        begins, ends = known.copy(), known.copy()
        begins[1:] &= ~joined
        ends[:-1] &= ~joined
        b, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        keep = e - b >= self.least
        return ids, b[keep], e[keep]

    def stream(self, ids: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word ranges (end exclusive) and items of a run of word ids."""
        nxt, link, length, k = self.next, self.link, self.length, self.k
        state, n, spans, items = 0, 0, [], set()
        for i, c in enumerate(ids):
            while state and c not in nxt[state]:
                state = link[state]
                n = length[state]
            if c in nxt[state]:
                state, n = nxt[state][c], n + 1
            top, low = state, 0
            while top > 0:
                if self.has_short and top in self.short:
                    for m, item in self.short[top]:
                        if m <= n:
                            items.add(item)
                            low = max(low, m)
                if length[link[top]] < k <= n and top in self.full and length[top] >= k:
                    items |= self.full[top]
                if not self.has_short and length[top] < k:
                    break
                top = link[top]
            low = n if n >= k else low
            if low:
                if spans and spans[-1][1] >= i + 1 - low:
                    # an earlier span may begin later than this one's
                    at = i + 1 - low
                    while spans and spans[-1][1] >= at:
                        at = min(at, spans.pop()[0])
                    spans.append((at, i + 1))
                else:
                    spans.append((i + 1 - low, i + 1))
        return spans, items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_words(texts: list[str | None]) -> list[np.ndarray]:
    w = words_of(pa.array(texts, pa.large_string()), ALNUM)
    h = hashes(w.data, w.starts, w.ends, LOWER)
    return [h[a:b] for a, b in zip(w.first, w.first[1:])]


def shards(items: DataFrame, k: int, shard_words: int, id_col: str,
           text_col: str) -> Iterator[tuple[bool, Automaton]]:
    """Automata of the item shards, the last one marked. The number of shards follows the items' bytes, so
    one shard (the most the driver holds) stays near ``shard_words`` words."""
    src = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // (shard_words * 6)))
    for s in range(n):
        part = src if n == 1 else src.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == s)
        rows = part.collect()
        yield s + 1 == n, Automaton([(r["item"], h) for r, h in zip(rows, item_words([r["text"] for r in rows]))], k)


def scan(docs: DataFrame, items: DataFrame, k: int = K, shard_words: int = SHARD_WORDS, text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` (without the text if not ``keep_text``) with ``n_words``, ``spans`` (hit word
    ranges, end exclusive) and ``items`` (sorted ids of items with an occurring window) in
    place of equally named columns."""
    def last(out, automaton, cols):
        kept = [c for c in cols if keep_text or c != text_col]
        schema = T.StructType([out.schema[c] for c in (*kept, "n_words", "spans", "items")])
        return out.mapInArrow(_mapper(automaton, kept, text_col), schema)

    return _through(docs.drop("n_words", "spans", "items"), items, k, shard_words, text_col, item_id, item_text, last)


def clean(docs: DataFrame, items: DataFrame, k: int = K, min_span: int = MIN_SPAN, max_coverage: float = MAX_COVERAGE,
          shard_words: int = SHARD_WORDS, text_col: str = "text", item_id: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """``docs`` without the hit spans of at least ``min_span`` words (shorter ones stay) and
    without the documents of which more than ``max_coverage`` of the words are hit. A
    cut takes the words with the gaps between them; the rest of the text is unchanged.
    All columns are kept; the cut happens in the pass that finds the last spans."""
    work = {"n_words": "_n_words", "spans": "_spans", "items": "_items"}      # names that the scan would take
    names = docs.columns
    renamed = docs.withColumnsRenamed({c: n for c, n in work.items() if c in names})

    def last(out, automaton, cols):
        schema = T.StructType([out.schema[c] for c in cols])
        return out.mapInArrow(_mapper(automaton, cols, text_col, (min_span, max_coverage)), schema)

    out = _through(renamed, items, k, shard_words, text_col, item_id, item_text, last)
    return out.withColumnsRenamed({n: c for c, n in work.items() if c in names}).select(*names)


def _through(docs, items, k, shard_words, text_col, item_id, item_text, last) -> DataFrame:
    """``docs`` passed through the automata of all shards; ``last`` adds the last one."""
    cols = docs.columns
    out = docs.selectExpr("*", "cast(0 as bigint) n_words",
                          "cast(array() as array<struct<first:bigint,last:bigint>>) spans",
                          "cast(array() as array<string>) items")
    sc = docs.sparkSession.sparkContext
    for at_end, automaton in shards(items, k, shard_words, item_id, item_text):
        automaton = sc.broadcast(automaton)
        out = last(out, automaton, cols) if at_end else out.mapInArrow(_mapper(automaton, cols, text_col), out.schema)
    return out


def _mapper(shared, cols, text_col, limits=None):
    """Finds spans and items; with ``limits`` (least span, most coverage) cuts the spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            for b in chunks(batch, text_col):
                w = words_of(b.column(text_col), ALNUM)
                ids, begin, end = automaton.runs(hashes(w.data, w.starts, w.ends, LOWER), w.first)
                found: dict[int, tuple[list, set]] = {}
                for at, to, d in zip(begin.tolist(), end.tolist(),
                                     (np.searchsorted(w.first, begin, side="right") - 1).tolist()):
                    spans, items = automaton.stream(ids[at:to].tolist())
                    if spans:
                        own = found.setdefault(d, ([], set()))
                        base = at - int(w.first[d])
                        own[0].extend((x + base, y + base) for x, y in spans)
                        own[1].update(items)
                spans, items = b.column("spans"), b.column("items")
                if found:
                    spans, items = spans.to_pylist(), items.to_pylist()
                    for d, (s, i) in found.items():
                        s = merge(s + [(x["first"], x["last"]) for x in spans[d]])
                        spans[d] = [{"first": x, "last": y} for x, y in s]
                        items[d] = sorted({*items[d], *i})
                    spans, items = pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))
                if limits:
                    text, keep = _cut(w, b.column(text_col), spans, *limits)
                    yield pa.RecordBatch.from_arrays([text if c == text_col else b.column(c) for c in cols],
                                                     names=cols).filter(keep)
                else:
                    yield pa.RecordBatch.from_arrays(
                        [*(b.column(c) for c in cols), pa.array(w.counts, pa.int64()), spans, items],
                        names=[*cols, "n_words", "spans", "items"])
    return run


def _cut(w, text: pa.Array, spans: pa.Array, min_span: int, max_coverage: float) -> tuple[pa.Array, pa.Array]:
    """The texts without their spans, and which documents stay."""
    counts, new, keep = w.counts, {}, np.ones(len(text), bool)
    for d in np.flatnonzero(np.diff(spans.offsets.to_numpy())).tolist():
        at, base, parts = int(w.offsets[d]), int(w.first[d]), []
        own = [(s["first"], s["last"]) for s in spans[d].as_py()]
        keep[d] = sum(y - x for x, y in own) <= max_coverage * counts[d]
        for x, y in own:
            if y - x >= min_span:
                parts.append(w.data[at:int(w.starts[base + x])].tobytes())
                at = int(w.ends[base + y - 1])
        new[d] = b"".join([*parts, w.data[at:int(w.offsets[d + 1])].tobytes()]).decode("utf-8", "replace")
    if new:
        text = pa.array([new.get(i, t) for i, t in enumerate(text.to_pylist())], text.type)
    return text, pa.array(keep)


def digest(found: DataFrame) -> DataFrame:
    """The query's columns from ``scan``'s."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["last"] - s["first"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


def brute_force(docs: list[tuple], items: list[tuple], k: int = K) -> list[tuple]:
    """The query's rows by comparing every window with every position (for tests)."""
    import re
    words = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+",
                                 "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - k + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add("" if item is None else str(item))
    sizes, out = {len(w) for w in windows}, []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit)))
    return out
