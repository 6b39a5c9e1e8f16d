"""Held-out passages inside a training corpus, by winnowed fingerprints and extended hits.

Both sides reduce to words in a common form. Of every window of consecutive k-word hashes the least
is kept as fingerprint, which guarantees a common fingerprint for every exactly shared span of
k + window - 1 words, wherever it stands. The order of the hashes is the same on both sides and puts
k-grams that several held-out items have last, so that phrases of everyday use are kept only where
nothing rarer stands beside them. Documents keep only fingerprints that the held-out side may have (a
bitmap of fixed size), each with the words around it. Equal fingerprints are joined; a hit whose
surroundings share too few words for a passage goes; the others are extended over changed, missing
and added words, and a passage that is long enough makes a leak.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.runtime import broadcast_if_small, materialize, spread

K, SPAN = 3, 4  # every shared span of 4 words is seen; 12 words with 2 changes always hold one
WINDOW = SPAN - K + 1
MATCHED = 9  # kept words of a passage, at least
DENSITY = 3  # kept words for each edit of a passage, at least
AROUND, DRIFT = 12, 3  # words on each side of a hit that are compared first, and how far they may be shifted: 9 kept words have at most 3 edits
BITS = 1 << 23  # bits of the held-out side's bitmaps, 1 MB each
BROADCAST_ROWS = 100_000  # fingerprints of the held-out side, some 20 MB with their surroundings
PAIRS_ROWS = 200_000  # surviving pairs up to this number are broadcast to the documents
# Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans("аеорсухіјѕԁһԛԝкмтвнαοερικνυτ", "aeopcyxijsdhqwkmtbnaoepiknut")
TAGS = re.compile(r"</?[A-Za-z][^<>]*>|<!--.*?-->", re.S)
INLINE = ("b", "i", "u", "em", "s")
HYPHENS = re.compile(r"[-‐‑](?<=[^\W\d_].)(?:\s*[\r\n]\s*)?(?=[^\W\d_])")
WORDS = re.compile(r"[^\W_]+")
KEPT_WORDS = 500_000


# combining marks and format characters (soft hyphens, zero-width blanks) vanish
BEYOND_ASCII = re.compile(r"[^\x00-\x7f]+")


def _seen(m: re.Match) -> str:
    return "".join([c for c in m[0] if unicodedata.category(c) not in ("Mn", "Cf", "Me")])


OTHER_SCRIPTS = re.compile("[\u0370-\u052f]")


class _Hashes(dict):
    """64-bit hashes of words, the same on every worker; frequent words are looked up."""

    def __missing__(self, word: str) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _Hashes()


def _tag(m: re.Match) -> str:
    """Closing and inline tags vanish within a word, others break it."""
    name = m[0].strip("</>!- ").split(" ", 1)[0].lower()
    return "" if m[0][1] == "/" or name in INLINE else " "


def words_of(text: str | None) -> list[str]:
    """The words of a text without case, accents, markup, punctuation, hyphens and odd forms."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = TAGS.sub(_tag, text)
    if text.isascii():
        return WORDS.findall(HYPHENS.sub("", text).lower())
    text = BEYOND_ASCII.sub(_seen, unicodedata.normalize("NFKD", text)).casefold()
    if OTHER_SCRIPTS.search(text):
        text = text.translate(LOOKALIKES)
    return WORDS.findall(HYPHENS.sub("", text))


def _marked(bitmap: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Whether the bits of the buckets are set."""
    return (bitmap[buckets >> 3] >> (buckets & 7).astype(np.uint8)) & 1 == 1


def grams(texts: list[list[str]], k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts' words in a row: their hashes, the text of each, its place in the text, and the hash of the k-gram that starts there (-1: none)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    each = np.fromiter((_hashes[w] for t in texts for w in t), np.uint64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(each)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    n = max(0, len(each) - k + 1)
    mixed = np.zeros(n, np.uint64)
    for i in range(k):  # a polynomial in the word hashes, then a finaliser so that least values are spread
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + each[i : i + n]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    h = np.full(len(each), -1, np.int64)
    h[:n] = (mixed >> np.uint64(2)).astype(np.int64)
    h[place + k > sizes[owner]] = -1
    return each, owner, place, h


def winnowed(owner: np.ndarray, h: np.ndarray, common: np.ndarray | None = None, window: int = WINDOW) -> np.ndarray:
    """Places (in the row of all words) of the fingerprints: the least k-gram of each window, the rightmost of equal ones.

    k-grams whose bit is set in `common` come after all others. A text with fewer k-grams than a
    window has one window.
    """
    n = len(h)
    none = np.int64(2**63 - 1)
    key = np.where(h < 0, none, h | np.where(_marked(common, h & (BITS - 1)), np.int64(1) << 62, 0) if common is not None else h)
    best, at = key.copy(), np.arange(n)
    whole = h >= 0  # windows with all their k-grams within the text
    for j in range(1, min(window, n)):
        other = np.full(n, none)
        other[: n - j] = key[j:]
        same = np.zeros(n, bool)
        same[: n - j] = owner[j:] == owner[: n - j]
        inside = same & (other != none)
        whole &= inside
        less = inside & (other <= best)
        best, at = np.where(less, other, best), np.where(less, np.arange(n) + j, at)
    first = np.ones(n, bool)
    first[1:] = owner[1:] != owner[:-1]
    return np.unique(at[whole | (first & (h >= 0))])


def fingerprints(words: list[str], k: int = K, window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Hashes and word positions of one text's fingerprints."""
    _, owner, _, h = grams([words], k)
    at = winnowed(owner, h, None, window)
    return h[at].tolist(), at.tolist()


def _surroundings(each: np.ndarray, owner: np.ndarray, at: np.ndarray, k: int, fill: int) -> np.ndarray:
    """32-bit hashes of the words from AROUND before a k-gram to AROUND after it; `fill` beyond the text."""
    spots = at[:, None] + np.arange(-AROUND, k + AROUND)[None, :]
    inside = (spots >= 0) & (spots < len(each))
    spots = np.where(inside, spots, 0)
    inside &= owner[spots] == owner[at][:, None]
    return np.where(inside, (each[spots].astype(np.uint32) | np.uint32(4)), np.uint32(fill))


def _run(doc: list[str], item: list[str], dpos: int, ipos: int) -> tuple[int, int, int]:
    """Start in the document, start in the item and length of the exactly shared words around a hit."""
    back, ahead = 0, 0
    while back < min(dpos, ipos) and doc[dpos - back - 1] == item[ipos - back - 1]:
        back += 1
    while dpos + ahead < len(doc) and ipos + ahead < len(item) and doc[dpos + ahead] == item[ipos + ahead]:
        ahead += 1
    return dpos - back, ipos - back, back + ahead


def _shared(a: list[str], b: list[str]) -> int:
    """Words in common, each as often as both have it: no order keeps more."""
    return sum((Counter(a) & Counter(b)).values())


def _kept(a: list[str], b: list[str], edits: int, most: int) -> list[int]:
    """Most words kept from the front of both, for 0, 1, ... edits (a changed, missing or added word each); `most` bounds them."""
    n, m = len(a), len(b)
    layer, seen, out = {(0, 0): 0}, {}, []
    for _ in range(edits + 1):
        ahead: dict[tuple[int, int], int] = {}
        best = out[-1] if out else 0
        for (i, j), kept in layer.items():
            while i < n and j < m and a[i] == b[j]:  # to keep an equal word is never worse than an edit
                i, j, kept = i + 1, j + 1, kept + 1
            if kept <= seen.get((i, j), -1):
                continue
            seen[i, j] = kept
            best = max(best, kept)
            for at in ((i + 1, j + 1), (i + 1, j), (i, j + 1)):
                if at[0] <= n and at[1] <= m and kept > ahead.get(at, -1):
                    ahead[at] = kept
        out.append(best)
        if best >= most:  # further edits keep nothing more
            break
        layer = ahead
    return out


def extended(doc: list[str], item: list[str], dpos: int, ipos: int) -> int:
    """Kept words of the best passage through a hit, 0 if under MATCHED.

    The words shared around the hit are extended both ways, as far as the item goes. Edits may stand
    anywhere; over the whole passage there is at most one for DENSITY kept words.
    """
    d0, i0, run = _run(doc, item, dpos, ipos)
    d1, i1 = d0 + run, i0 + run
    # no passage has more edits, so none reaches further into the document
    edits = len(item) // DENSITY
    left, right = (doc[max(0, d0 - i0 - edits) : d0][::-1], item[:i0][::-1]), (doc[d1 : d1 + len(item) - i1 + edits], item[i1:])
    before, after = _shared(*left), _shared(*right)
    most = run + before + after
    if most < MATCHED:
        return 0
    lefts, rights = _kept(*left, most // DENSITY, before), _kept(*right, most // DENSITY, after)
    best = 0
    for e, x in enumerate(lefts):
        for f, y in enumerate(rights):
            if run + x + y >= DENSITY * (e + f):
                best = max(best, run + x + y)
    return best if best >= MATCHED else 0


def _bitmaps(items: DataFrame, item_id: str, text: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the k-grams that any item has, and of those that more than one has.

    Counted by bucket with map-side combine and folded into bitmaps by Spark; BITS bits are collected
    in all, whatever the number of items.
    """
    kind = items.schema[item_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, owner, _, h = grams([words_of(t) for t in b.column(1).to_pylist()], k)
            ok = h >= 0
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owner[ok])), pa.array(h[ok] & (BITS - 1))], names=["key", "bucket"])

    rows = items.select(F.col(item_id).alias("key"), F.col(text).alias("text")).where("key is not null").mapInArrow(run, f"key {kind}, bucket bigint")
    per = rows.groupBy("bucket").agg((F.min("key") != F.max("key")).alias("several"))
    page, bit = F.bitmap_bucket_number(F.col("bucket") + 1), F.bitmap_bit_position(F.col("bucket") + 1)
    found = per.select(page.alias("page"), bit.alias("bit"), "several").groupBy("page").agg(F.bitmap_construct_agg("bit").alias("any"), F.bitmap_construct_agg(F.when(F.col("several"), F.col("bit"))).alias("several")).collect()
    out = [np.zeros(BITS // 8 + 8192, np.uint8), np.zeros(BITS // 8 + 8192, np.uint8)]
    for r in found:  # bits are numbered from 1, bytes from the page's start
        for bits, name in zip(out, ("any", "several")):
            own = np.frombuffer(bytes(r[name]), np.uint8)
            bits[(r["page"] - 1) * len(own) : r["page"] * len(own)] = own
    return out[0], out[1]


def _prints(rows: DataFrame, key: str, text: str, k: int, window: int, present: np.ndarray, common: np.ndarray, fill: int) -> DataFrame:
    """`(key, hash, pos, near)`, a row per fingerprint that the bitmap of the held-out side has; near holds the words around it."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each, owner, place, h = grams([words_of(t) for t in b.column(1).to_pylist()], k)
            at = winnowed(owner, h, common, window)
            at = at[_marked(present, h[at] & (BITS - 1))]
            near = _surroundings(each, owner, at, k, fill)
            binary = pa.FixedSizeBinaryArray.from_buffers(pa.binary(near.shape[1] * 4), len(at), [None, pa.py_buffer(near.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owner[at])), pa.array(h[at]), pa.array(place[at].astype(np.int32)), binary], names=["key", "hash", "pos", "near"])

    source = rows.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null")
    return spread(source).mapInArrow(run, f"key {kind}, hash bigint, pos int, near binary")


def alike_around(ours: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Words of each row of `ours` that stand in `theirs` at most DRIFT places off."""
    met = np.zeros(ours.shape, bool)
    for d in range(-DRIFT, DRIFT + 1):
        a, b = (slice(max(0, -d), ours.shape[1] - max(0, d)), slice(max(0, d), ours.shape[1] - max(0, -d)))
        met[:, a] |= ours[:, a] == theirs[:, b]
    return met.sum(axis=1)


def hits(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", k: int = K, window: int = WINDOW, matched: int = MATCHED) -> DataFrame:
    """`(doc_id, item_id, pos, item_pos)` of equal fingerprints around which at least `matched` words are alike.

    Passages of 12 words or more with one change in eight, or 9 kept words with 3 edits, always have
    such a hit: nine of its words lie within AROUND words of it.
    """
    present, common = _bitmaps(items, item_id, text, k)
    ours = _prints(documents, doc_id, text, k, window, present, common, 0).withColumnRenamed("key", "doc_id")
    theirs = _prints(items, item_id, text, k, window, present, common, 1).select("hash", F.col("key").alias("item_id"), F.col("pos").alias("item_pos"), F.col("near").alias("item_near"))
    met = ours.join(broadcast_if_small(theirs, BROADCAST_ROWS), "hash").select("doc_id", "item_id", "pos", "item_pos", "near", "item_near")
    kinds = [documents.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(b.num_rows, -1) for c in (4, 5)]
            good = pa.array(alike_around(*words) >= matched) if b.num_rows else pa.array([], pa.bool_())
            yield b.select([0, 1, 2, 3]).filter(good)

    return met.mapInArrow(run, f"doc_id {kinds[0]}, item_id {kinds[1]}, pos int, item_pos int")


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", matched: int = MATCHED) -> DataFrame:
    """Distinct `(doc_id, item_id, matched)` of documents that hold a passage of a held-out item.

    A passage is some 12 words of the item in order, about one in eight of them changed, missing or
    added: at least `matched` words of it stay. `matched` is the longest such run of a pair. Null and
    empty texts hold and leak nothing; rows without id are left out; items under `matched` words
    cannot leak. Repeated rows give one result row. Texts are searched in whole.
    """
    pairs = hits(documents, items, doc_id, item_id, text, matched=min(matched, MATCHED)).groupBy("doc_id", "item_id").agg(F.collect_set(F.struct("pos", "item_pos")).alias("at"))
    pairs = materialize(pairs, "hits")
    known = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("item_text")).where("item_id is not null")
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = texts.join(broadcast_if_small(pairs, PAIRS_ROWS), "doc_id").join(broadcast_if_small(known, 20_000), "item_id").select("doc_id", "item_id", "text", "item_text", "at")
    dtype, itype = documents.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, list[str]] = {}
        last, words = None, []
        for b in batches:
            kept = []
            for text_, item_text, at in zip(*(b.column(c).to_pylist() for c in (2, 3, 4))):
                if text_ != last:
                    last, words = text_, words_of(text_)
                if item_text not in cache:
                    if len(cache) > 5_000:
                        cache.clear()
                    cache[item_text] = words_of(item_text)
                item, most, done = cache[item_text], 0, set()
                for h in at:
                    start = _run(words, item, h["pos"], h["item_pos"])[:2]  # hits of one run extend to the same passage
                    if start not in done:
                        done.add(start)
                        most = max(most, extended(words, item, *start))
                kept.append(most)
            most = np.array(kept, np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(most)], names=["doc_id", "item_id", "matched"]).filter(pa.array(most >= matched))

    judged = rows.mapInArrow(run, f"doc_id {dtype}, item_id {itype}, matched int")
    return judged.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))


def leak_report(documents: DataFrame, items: DataFrame, **names) -> DataFrame:
    """Per leaked item: the documents that hold a passage of it and the longest one."""
    return leaks(documents, items, **names).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("matched").alias("longest"))
