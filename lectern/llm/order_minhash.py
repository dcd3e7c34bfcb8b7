"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text is cut into words; every ``K`` consecutive words are a k-mer (a shorter text is one
k-mer), numbered by occurrence, so the second time a k-mer appears it counts as another
element. For each of ``m`` hash functions the ``L`` elements of least hash are selected, put
back in text order, and the tuple is hashed to one component. Two texts agree in a component
only if they share the selected k-mers *and* have them in the same order, which makes the
share of equal components fall with edit distance, not only with set overlap.

The ``m`` hash functions are rotations of one: function ``i`` orders elements by
``hash - i * 2**64 / m`` modulo ``2**64``. An element is then the least one of each function with
the same chance, and one sorted array of hashes serves all functions: the selected elements are
the ``L`` successors of ``m`` evenly spaced points, going round at the end, so short texts fill
every component too.

Everything is an expression over one text's array (``let`` binds a value once, so no lambda
recomputes it); only the neighbour search shuffles. In it equal rows collapse first, an order over
narrow keys is found in range slices, and each text meets only the quarter of the next text
that it needs.

Defined cases: a null text is empty; an empty text has no words and the fingerprint ``""``; two empty
fingerprints are alike (1), an empty and a non-empty one are not (0). Texts with equal words in equal
order have equal fingerprints. Rows are ordered by doc_id, null first, rows that share an id by a
hash of the text; equal rows follow each other, and each is returned. A single row is its own
next one. Characters of scripts written without blanks are words of their own. Beyond 2**24 words,
text order is kept in steps of two or more words. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import dense_ordinal
from .staging import stage

K, L, M = 3, 2, 64
#: Low bits of a packed element: its place in the text; the rest is its hash.
PLACE_BITS = 24
PLACE = (1 << PLACE_BITS) - 1
HASH = (1 << (64 - PLACE_BITS)) - 1
#: Copies of a row are laid out in chunks.
CHUNK = 4096

#: Scripts written without blanks (Thai and Lao, Burmese, Khmer, East Asian).
NO_BLANKS = r"([฀-໿က-႟ក-៿⺀-鿿豈-﫿\x{20000}-\x{3FFFF}])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def words(text: Column) -> Column:
    spaced = F.regexp_replace(text, NO_BLANKS, " $1 ")
    return F.array_remove(F.split(spaced, r"\s+"), "")


def count_to(n: Column) -> Column:
    """0 .. n - 1, for n of at least 1."""
    return F.sequence(F.lit(0), n - 1)


def elements(hashes: Column, k: int) -> Column:
    """Sorted packed elements (hash of k-mer and occurrence number, place) of an array of word hashes."""
    n = F.greatest(F.size(hashes) - k + 1, F.lit(1))
    # place in at most PLACE_BITS bits
    drop = F.greatest(F.length(F.bin(F.size(hashes))) - PLACE_BITS, F.lit(0))
    mer = lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)])
    packed = let(drop, lambda s: F.transform(count_to(n), lambda i: mer(i).bitwiseAND(F.lit(~PLACE)).bitwiseOR(
        F.floor(i / F.pow(F.lit(2), s)).cast("long"))))
    same = lambda p, q: F.shiftright(p, PLACE_BITS) == F.shiftright(q, PLACE_BITS)

    def numbered(p):
        """First occurrences keep their hash, later ones are hashed again with their number."""
        firsts = F.filter(p, lambda e, j: (j == 0) | ~same(e, F.get(p, j - 1)))
        return let(firsts, lambda f: F.when(F.size(f) == F.size(p), f).otherwise(
            F.sort_array(F.concat(f, let(F.filter(count_to(F.size(p)), lambda j: (j == 0) | ~same(F.get(p, j), F.get(p, j - 1))),
                                         lambda starts: again(p, starts))))))

    def again(p, starts):
        end = lambda r: F.coalesce(F.get(starts, r + 1), F.size(p))
        runs = F.filter(count_to(F.size(starts)), lambda r: end(r) - F.get(starts, r) > 1)
        return F.flatten(F.transform(runs, lambda r: F.transform(
            F.slice(p, F.get(starts, r) + 2, end(r) - F.get(starts, r) - 1),
            lambda e, o: F.xxhash64(F.shiftright(e, PLACE_BITS), o + 1).bitwiseAND(F.lit(~PLACE)).bitwiseOR(
                e.bitwiseAND(F.lit(PLACE))))))

    return let(F.sort_array(packed), numbered)


def components(e: Column, l: int, m: int) -> Column:  # noqa: E741
    """One 32-bit number per hash function from the sorted elements ``e``."""
    shift = 64 - (m.bit_length() - 1)
    n = F.size(e)
    bin_of = lambda x: F.shiftright(x, shift)

    def tuple_hash(first):
        # by place, then hashed without it
        chosen = F.transform(F.sequence(F.lit(0), F.lit(l - 1)), lambda t: let(
            F.get(e, F.pmod(first + t, n)),
            lambda x: F.shiftleft(x.bitwiseAND(F.lit(PLACE)), 64 - PLACE_BITS).bitwiseOR(F.shiftrightunsigned(x, PLACE_BITS))))
        return F.shiftright(F.xxhash64(F.transform(F.sort_array(chosen), lambda x: x.bitwiseAND(F.lit(HASH)))), 32).cast("int")

    def from_edges(edges):
        """``edges``: where a new bin begins among the sorted elements."""
        return let(F.transform(edges, lambda j: bin_of(F.get(e, j))), lambda bins: F.transform(
            F.sequence(F.lit(-(m // 2)), F.lit(m // 2 - 1)),
            lambda v: let(F.array_position(bins, v.cast("long")), lambda at: tuple_hash(F.when(
                at > 0, F.get(edges, (at - 1).cast("int"))).otherwise(F.coalesce(
                    F.get(F.filter(edges, lambda j: bin_of(F.get(e, j)) > v), F.lit(0)), F.lit(0)))))))

    return let(F.filter(count_to(n), lambda j: (j == 0) | (bin_of(F.get(e, j)) != bin_of(F.get(e, j - 1)))), from_edges)


def signature(text: Column, k: int = K, l: int = L, m: int = M) -> Column:  # noqa: E741
    """``array<int>`` of ``m`` components (``m`` a power of two), empty for a text without words."""
    if m < 2 or m & (m - 1) or k < 1 or l < 1:
        raise ValueError("m must be a power of two of at least 2, k and l at least 1")
    return let(words(F.coalesce(text, F.lit(""))), lambda w: F.when(F.size(w) == 0, none("int")).otherwise(
        let(F.transform(w, lambda x: F.xxhash64(x)), lambda hashes: let(elements(hashes, k), lambda e: components(e, l, m)))))


def shown(sig: Column) -> Column:
    """A signature as text: eight hex digits a component."""
    return F.array_join(F.transform(sig, lambda x: F.lower(F.right(F.concat(F.lit("0000000"), F.hex(x)), F.lit(8)))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal components."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0),
                        lambda s, x: s + F.coalesce(x, F.lit(0)))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(
        F.coalesce(equal / F.greatest(F.size(a), F.size(b)), F.lit(0.0)))


def fingerprints(docs: DataFrame, k: int = K, l: int = L, m: int = M) -> DataFrame:  # noqa: E741
    """doc_id, signature, fingerprint; no shuffle."""
    out = docs.select("doc_id", signature(F.col("text"), k, l, m).alias("signature"))
    return out.withColumn("fingerprint", shown(F.col("signature")))


def neighbours(keyed: DataFrame) -> DataFrame:
    """Distinct rows (h1, h2, doc_id, n_chars, copies) in order: ordinal, next_ordinal, and for the row
    before, round the end, its key and its quarter: prev_h1, prev_h2, wanted."""
    keys = keyed.groupBy("h1", "h2").agg(F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"),
                                         F.count(F.lit(1)).alias("copies"))
    ranked = stage(dense_ordinal(keys, [F.col("doc_id").asc_nulls_first(), F.col("h1").asc(), F.col("h2").asc()]))
    n = F.lit(max(ranked.count(), 1))
    before = ranked.select(F.pmod(F.col("ordinal") + 1, n).alias("ordinal"), F.col("h1").alias("prev_h1"), F.col("h2").alias("prev_h2"),
                           F.floor(F.col("n_chars") / 4).cast("int").alias("wanted"))
    return stage(ranked.withColumn("next_ordinal", F.pmod(F.col("ordinal") + 1, n)).join(before, "ordinal"))


def compare(docs: DataFrame, k: int = K, l: int = L, m: int = M) -> DataFrame:  # noqa: E741
    """Fingerprints of every text, of its edited text (its last quarter replaced by as much of the next
    text's start) and of the next text, compared: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", F.xxhash64("doc_id", F.col("doc_id").isNull(), "text").alias("h1"),
        F.xxhash64(F.lit(1), "text", F.col("doc_id").isNull(), "doc_id").alias("h2"))
    order = neighbours(keyed.select("doc_id", "h1", "h2", F.length("text").cast("long").alias("n_chars")))
    # one row per different row; the only shuffle of whole texts, used twice
    texts = keyed.groupBy("h1", "h2").agg(F.first("text").alias("text"))
    starts = texts.join(order.select("h1", "h2", "prev_h1", "prev_h2", "wanted"), ["h1", "h2"]).select(
        F.col("prev_h1").alias("h1"), F.col("prev_h2").alias("h2"), F.expr("substring(text, 1, wanted)").alias("start"))
    met = (texts.join(order.select("h1", "h2", "doc_id", "n_chars", "copies", "ordinal", "next_ordinal"), ["h1", "h2"])
           .join(starts, ["h1", "h2"]))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    # of several equal rows, all but the last are followed by their own text
    last = F.struct(F.col("start").alias("start"), F.lit(1).cast("long").alias("times"), F.lit(True).alias("last"))
    own = F.struct(F.substring("text", F.lit(1), quarter).alias("start"), (F.col("copies") - 1).alias("times"), F.lit(False).alias("last"))
    rows = met.withColumn("e", F.explode(F.when(F.col("copies") > 1, F.array(last, own)).otherwise(F.array(last))))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - quarter), F.col("e.start"))
    prints = stage(rows.select("doc_id", "n_chars", "ordinal", "next_ordinal", "e.times", "e.last", "text", edited.alias("edited")).select(
        "doc_id", "n_chars", "ordinal", "next_ordinal", "times", "last", F.sha2("edited", 256).alias("edited_sha256"),
        signature(F.col("text"), k, l, m).alias("sig"), signature(F.col("edited"), k, l, m).alias("edited_sig")))
    after = prints.where("last").select(F.col("ordinal").alias("next_ordinal"), F.col("sig").alias("next_sig"))
    out = prints.join(after, "next_ordinal").withColumn("near_next", F.when(
        F.col("last"), likeness(F.col("sig"), F.col("next_sig"))).otherwise(F.lit(1.0)))
    chunked = out.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / CHUNK))))
    each = F.array_repeat(F.lit(0), F.least(F.lit(CHUNK), F.col("times") - F.col("_c") * CHUNK).cast("int"))
    return chunked.withColumn("_e", F.explode(each)).select(
        "doc_id", "n_chars", "edited_sha256", shown(F.col("sig")).alias("fingerprint"), shown(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), "near_next")
