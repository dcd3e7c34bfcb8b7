"""URL filters: a bit-parallel wildcard automaton.

All glob rules are packed side by side into one multiword Shift-And bit set. A
state bit stands for a matched prefix of one rule; each character of a canonical
URL (host and path) shifts the whole set once, masked by the character's
word of allowed moves, so every rule is simulated at the same time:

    D' = ((D << 1) & MOVE[c]) | (D & STAY[c])

``*`` stays on any character but ``/``, ``**`` on any character, ``?`` moves on
any character but ``/``. The carry of the shift crosses word limits. A batch of
URLs is advanced character by character in numpy, so memory is the batch's text
plus one bit set per URL. There is no shuffle: rules are a driver-side argument.

Defined cases: a null url, or one without ``://``, has an empty host and path and
matches only a rule whose glob is empty; repeated rows give repeated results;
extra columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Site rules of the production query: verdict, then host and path prefix as one string.
SITE_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
              ("allow", "com/fr/"), ("block", "com/de/")]
#: Globs over host and path that decide where no site rule fits; the last match wins.
GLOBS = [("block", ""), ("block", "**/login**"), ("block", "**/cart/**"), ("block", "**/tag?/**"),
         ("block", "*.example.net/de/**"), ("block", "ads.**"), ("allow", "ads.*/privacy")]
DEFAULT = "allow"


@dataclass(frozen=True)
class Rule:
    """``globs`` match the canonical URL; ``name`` is reported for site rules."""

    globs: tuple[str, ...]
    verdict: str
    name: str | None = None


def site_rule(verdict: str, rule: str) -> Rule:
    """A host with all subdomains and a path prefix, as globs."""
    plain = rule.replace("\\", "\\\\").replace("*", "\\*").replace("?", "\\?")
    return Rule((plain + "**", "*." + plain + "**"), verdict, rule)


def compile_rules(site: Iterable[tuple[str, str]], globs: Iterable[tuple[str, str]]) -> list[Rule]:
    """Rules from the weakest to the strongest: globs in order, then site rules by
    length (ties: by the rule string), so the longest fitting site rule wins."""
    return [Rule((g,), v) for v, g in globs] + [
        site_rule(v, r) for v, r in sorted(site, key=lambda x: (len(x[1]), x[1]))]


def parse_glob(glob: str) -> list[str | None]:
    """Elements of a glob: a character, ``?``/``*``/``**`` as ``(kind,)`` tuples."""
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        if c == "\\" and i + 1 < len(glob):
            out.append(glob[i + 1])
            i += 2
        elif c == "*":
            n = 2 if glob[i:i + 2] == "**" else 1
            out.append(("**",) if n == 2 else ("*",))
            i += n
        elif c == "?":
            out.append(("?",))
            i += 1
        else:
            out.append(c)
            i += 1
    return out


class Automaton:
    """All globs of all rules as one bit set of ``words`` 64-bit words."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        bit, stays, moves, start, final = 0, [], [], [], []
        for r, rule in enumerate(rules):
            for glob in rule.globs:
                start.append(bit)
                for e in parse_glob(glob):
                    if e in (("*",), ("**",)):
                        stays.append((bit, e == ("*",)))
                    else:
                        bit += 1
                        moves.append((bit, None if e == ("?",) else e))
                final.append((bit, r))
                bit += 1
        self.words = bit // 64 + 1
        chars = sorted({c for _, c in moves if c is not None} | {"/"})
        self.code = {c: i + 1 for i, c in enumerate(chars)}          # 0: any other character
        self.move = np.zeros((len(chars) + 1, self.words), np.uint64)
        self.stay = np.zeros_like(self.move)
        slash = self.code["/"]
        for b, c in moves:
            for k in range(len(chars) + 1):
                if k == self.code[c] if c is not None else k != slash:
                    self.move[k, b >> 6] |= np.uint64(1 << (b & 63))
        for b, inside in stays:
            for k in range(len(chars) + 1):
                if not inside or k != slash:
                    self.stay[k, b >> 6] |= np.uint64(1 << (b & 63))
        self.start = np.zeros(self.words, np.uint64)
        for b in start:
            self.start[b >> 6] |= np.uint64(1 << (b & 63))
        self.final = final
        top = max(ord(c) for c in chars)
        self.table = np.zeros(top + 2, np.int64)
        for c, i in self.code.items():
            self.table[ord(c)] = i

    def match(self, urls: list[str]) -> np.ndarray:
        """Index of the strongest rule that matches each URL as a whole, or -1."""
        points = np.frombuffer("".join(urls).encode("utf-32-le"), np.uint32)
        codes = self.table[np.minimum(points, len(self.table) - 1)]
        size = np.array([len(u) for u in urls], np.int64)
        at = np.concatenate(([0], np.cumsum(size)))[:-1]
        order = np.argsort(-size, kind="stable")           # the longest first: active rows are a prefix
        at, left = at[order], size[order]
        state = np.tile(self.start, (len(urls), 1))
        active = len(urls)
        for step in range(int(left[0]) if len(urls) else 0):
            active = int(np.searchsorted(-left[:active], -step, side="left"))
            d, c = state[:active], codes[at[:active] + step]
            up = d << np.uint64(1)
            up[:, 1:] |= d[:, :-1] >> np.uint64(63)
            state[:active] = (up & self.move[c]) | (d & self.stay[c])
        best = np.full(len(urls), -1, np.int64)
        for b, r in self.final:
            hit = (state[:, b >> 6] >> np.uint64(b & 63)) & np.uint64(1) == 1
            best[hit] = np.maximum(best[hit], r)
        out = np.empty_like(best)
        out[order] = best
        return out


def url_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``host`` (after the first ``://`` up to ``/ ? #``, A-Z lower-cased) and
    ``path`` (then up to ``? #``); both empty for null or without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    raw = F.regexp_extract("_rest", r"\A[^/?#]*", 0)
    return (pages.withColumn("_rest", F.coalesce(rest, F.lit("")))
            .withColumn("host", F.translate(raw, UPPER, LOWER))
            .withColumn("path", F.regexp_extract("_rest", r"\A[^/?#]*([^?#]*)", 1))
            .drop("_rest"))


def filter_urls(pages: DataFrame, site_rules=tuple(SITE_RULES), globs=tuple(GLOBS), default: str = DEFAULT,
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule (the site rule that won, else
    null), verdict (that rule's; else the strongest glob's, else ``default``) and
    pattern (the glob that decided where no site rule did, else null)."""
    rules = compile_rules(site_rules, globs)
    src = url_parts(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url")), "_url").drop("_url")
    id_type = src.schema["page_id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(rules)
        names = [r.name for r in rules] + [None]
        verdicts = [r.verdict for r in rules] + [default]
        shown = [None if r.name is not None else r.globs[0] for r in rules] + [None]
        for b in batches:
            urls = [h + p for h, p in zip(b.column("host").to_pylist(), b.column("path").to_pylist())]
            best = automaton.match(urls).tolist()
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([names[k] for k in best], pa.string()),
                 pa.array([verdicts[k] for k in best], pa.string()),
                 pa.array([shown[k] for k in best], pa.string())],
                names=["page_id", "host", "path", "rule", "verdict", "pattern"])

    return src.select("page_id", "host", "path").mapInArrow(
        judge, f"page_id {id_type}, host string, path string, rule string, verdict string, pattern string")
