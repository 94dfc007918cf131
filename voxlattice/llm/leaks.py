"""Problem 7: evaluation items that leaked into documents.

Winnowing: of the hashes of K neighbouring words, the least in every run of W is kept, so any shared span of
K + W - 1 words leaves a common fingerprint. Every document is read once: those that hold fingerprints of any item are
written as numbers of words with the places of the fingerprints. These small rows are then joined with the items'
fingerprints, block by block of items, and hits are extended by chains of shared words that tell how many of the item's words
stand in order.

Which fingerprints items have is told to the readers by a Bloom filter of bounded size. Items come in blocks of bounded
size, so what is sent to the executors doesn't grow with the items; documents are never shuffled.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlattice.llm.batches import by_size
from voxlattice.llm.lookalikes import SAME_AS, SHAPES
from voxlattice.runtime import drop_stage, stage

#: Words in a hashed gram, and grams in a window of which one is kept.
K, W = 3, 2
#: Bytes of the words and fingerprints of a block of items, which are sent to the executors; an item is never cut.
BLOCK_BYTES = 32 << 20
#: Bits of the Bloom filter for each fingerprint, and at most: then more documents pass that have no hits.
BLOOM_BITS, MOST_BLOOM_BITS = 16, 1 << 28
#: Pairs of a text and an item whose hits are counted at a time.
COUNTERS = 4_000_000
#: Words whose number a worker remembers.
REMEMBERED = 500_000
#: Share of an item's words that makes a leak.
SHARE = 0.5
#: Chains are looked for if so many of an item's fingerprints, and at least that share of its words, are in the document.
#: Half an item in runs of LEAST_RUN words has a quarter of its grams left, of which about every second is kept.
HITS, HIT_SHARE = 2, 0.1
#: Chains: a shared word gains 1; a word in between in the document costs ASIDE, a whole run of them ASIDE_MOST at
#: most; a word of the item left out costs LEFT_OUT. A part of a passage ends where NEAR words come in between; what
#: follows is a part of its own.
ASIDE, ASIDE_MOST, NEAR, LEFT_OUT = 0.3, 3.0, 60, 0.5
#: Shared words in a run, on average, of a passage and of each of its parts: chance chains of common phrases have
#: shorter ones. A part has half of what makes a leak at least.
LEAST_RUN, LEAST_PART = 4.2, SHARE / 2

_ROWS = [r.split() for r in SHAPES.split("\n") if r]
_FOLD = {ord(c): next(x for x in (r[1], *r) if x != "-") for r in _ROWS for c in r if c != "-"} | {ord(k): v for k, v in SAME_AS.items()}
# Stress marks, formats and markup of stress, which stand within words.
_WITHIN = r"\\_\u0300-\u0305\u0307\u0309-\u036F\u00AD\u200B-\u200F\u2060\uFEFF"
_UNSEEN = re.compile(f"[{_WITHIN}]")
_ONE = "[\u3040-\u30FF\u4E00-\u9FFF\u0E00-\u0E7F]"
_WORD = re.compile(rf"{_ONE}|[^\W_]+")
#: Words as they are written: with what can't be seen, and with the marks of й and ё.
_WRITTEN = re.compile(rf"{_ONE}|(?:[^\W_]|[{_WITHIN}\u0306\u0308])+")


def words(text: str) -> list[str]:
    """Words without case, stress marks, formats, punctuation and script of look-alikes; unspaced scripts by character."""
    return [w for x in _WRITTEN.findall(text) if (w := _folded(x))]


def _folded(written: str) -> str:
    """The one form of a word; empty if nothing of it can be seen."""
    text = _UNSEEN.sub("", unicodedata.normalize("NFKC", _UNSEEN.sub("", written)))
    return "".join(_WORD.findall(text.translate(_FOLD).lower()))


class Numbers(dict):
    """Written word -> a number of 63 bits of its one form, found once; 0 if nothing can be seen."""

    def __missing__(self, written: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        form = _folded(written)
        number = int.from_bytes(hashlib.blake2b(form.encode(), digest_size=8).digest()) >> 1 or 1 if form else 0
        self[written] = number
        return number

    def of(self, text: str | None) -> np.ndarray:
        """The numbers of the words of a text."""
        found = np.fromiter(map(self.__getitem__, _WRITTEN.findall(text or "")), np.int64)
        return found[found != 0]


def gram_hashes(ids: np.ndarray, text: np.ndarray, k: int = K) -> np.ndarray:
    """A hash of the k words from each place on, all ones where a text has no more of them; of a text with fewer than k
    words the whole text is one gram. text: which text a word is of."""
    n = len(ids)
    padded = np.concatenate([ids, np.zeros(k - 1, np.int64)])
    last = np.concatenate([text, np.full(k - 1, -1)])
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = (h ^ np.where(last[j : j + n] == text, padded[j : j + n], 0).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    short = last[k - 1 : k - 1 + n] != text
    first = np.concatenate([[True], text[1:] != text[:-1]]) if n else np.zeros(0, bool)
    return np.where(~short | first, h, np.uint64(2**64 - 1))


def winnow(ids: np.ndarray, text: np.ndarray, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the kept grams: every window of w grams of one text keeps its least, and all equal to it;
    texts with fewer grams keep one too."""
    h = gram_hashes(ids, text, k)
    n, most = len(h), np.uint64(2**64 - 1)
    kept = np.zeros(n, bool)
    for j in range(w):
        least = h.copy()
        for o in range(-j, w - j):
            if o:
                moved, same = np.full(n, most), np.zeros(n, bool)
                if o > 0:
                    moved[:-o], same[:-o] = h[o:], text[o:] == text[:-o]
                else:
                    moved[-o:], same[-o:] = h[:o], text[:o] == text[-o:]
                least = np.where(same, np.minimum(least, moved), least)
        kept |= h == least
    kept &= h != most
    at = np.flatnonzero(kept)
    return h[at], at


class Bloom:
    """Which of all hashes may be among those added."""

    def __init__(self, expected: int):
        bits = 1 << max(10, (max(1, expected) * BLOOM_BITS - 1).bit_length())
        self.mask = np.uint64(min(bits, MOST_BLOOM_BITS) - 1)
        self.set = np.zeros((int(self.mask) + 1) // 8, np.uint8)

    def _bits(self, h: np.ndarray) -> Iterator[np.ndarray]:
        for shift in (0, 21, 42):
            yield ((h >> np.uint64(shift)) ^ (h << np.uint64(7))) & self.mask

    def add(self, h: np.ndarray) -> None:
        for b in self._bits(h):
            np.bitwise_or.at(self.set, (b >> np.uint64(3)).astype(np.int64), (1 << (b & np.uint64(7)).astype(np.int64)).astype(np.uint8))

    def may_have(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for b in self._bits(h):
            out &= (self.set[(b >> np.uint64(3)).astype(np.int64)] >> (b & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out


class Items:
    """Words and fingerprints of a block of items: keys, and the numbers of their words."""

    def __init__(self, keys: list, texts: list[np.ndarray]):
        self.keys, self.texts = keys, [np.asarray(t, np.int64) for t in texts]
        size = np.array([len(t) for t in self.texts], np.int64)
        of = np.repeat(np.arange(len(size)), size)
        all_ids = np.concatenate([np.zeros(0, np.int64), *self.texts])
        grams, (h, at) = gram_hashes(all_ids, of), winnow(all_ids, of)
        start = size.cumsum() - size
        order = np.argsort(h, kind="stable")
        self.hashes, self.item, self.place = h[order], of[at][order], (at - start[of[at]])[order]
        self.longest = int(size.max(initial=1))
        kept = np.bincount(self.item, minlength=len(size))
        self.need = np.maximum(1, np.minimum(kept, np.maximum(HITS, np.ceil(HIT_SHARE * size))))
        # The grams of each item by hash, with their places, for counting those that stand in order.
        self.grams = []
        for a, n in zip(start.tolist(), size.tolist()):
            g = grams[a : a + max(1, n - K + 1)]
            o = np.argsort(g, kind="stable")
            self.grams.append((g[o], o))


def parts(item: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """Chains of words that doc shares with the item in its order, nowhere NEAR words apart: (words, runs, first and last
    place in the document, first and last in the item) of the best chain from each word that one begins with."""
    where: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(item.tolist()):
        where[w].append(i)
    js, is_ = [], []
    for j in np.flatnonzero(np.isin(doc, item)).tolist():
        for i in reversed(where[int(doc[j])]):
            js.append(j)
            is_.append(i)
    n = len(js)
    dj, di = np.array(js, np.int64), np.array(is_, np.int64)
    score, count, runs, root = np.ones(n), [1] * n, [1] * n, list(range(n))
    best = list(range(n))
    a = 0
    # Each word continues the best earlier chain, if it gains by that.
    for x in range(1, n):
        while js[x] - js[a] > NEAR:
            a += 1
        if a == x:
            continue
        gap_i, gap_j = is_[x] - di[a:x] - 1, js[x] - dj[a:x] - 1
        total = score[a:x] - np.minimum(gap_j * ASIDE, ASIDE_MOST) - gap_i * LEFT_OUT
        total[(gap_i < 0) | (gap_j < 0)] = -1.0
        b = int(total.argmax())
        if total[b] > 0:
            score[x], root[x] = 1 + total[b], root[a + b]
            count[x] = count[a + b] + 1
            runs[x] = runs[a + b] + bool(gap_i[b] > 0 or gap_j[b] > 0)
            if score[x] > score[best[root[x]]]:
                best[root[x]] = x
    return [(count[e], runs[e], js[r], js[e], is_[r], is_[e]) for r, e in enumerate(best) if root[r] == r]


def held_in_parts(item: np.ndarray, doc: np.ndarray) -> int:
    """How many of the item's words doc holds in its order: in one part, or in several that are passages themselves,
    however far apart."""
    found = parts(item, doc)
    sound = sorted((p for p in found if p[0] >= min(LEAST_RUN, len(item)) * p[1]), key=lambda p: p[3])
    most = max((p[0] for p in sound), default=0)
    long_ = [p for p in sound if p[0] >= max(K, LEAST_PART * len(item))]
    held = []
    for k, (words_, _, first, _, start, _) in enumerate(long_):
        held.append(words_ + max((held[m] for m in range(k) if long_[m][3] < first and long_[m][5] < start), default=0))
    return max([most, *held])


def grams_in_order(grams: tuple[np.ndarray, np.ndarray], doc: np.ndarray) -> int:
    """The most grams of an item that doc holds in the item's order (longest increasing subsequence). grams: sorted
    hashes and their places; doc: hashes of its grams in order."""
    g, place = grams
    lo, hi = np.searchsorted(g, doc, "left"), np.searchsorted(g, doc, "right")
    tails: list[int] = []
    for j in np.flatnonzero(hi > lo).tolist():
        # Of equal grams of the item at most one can follow at this place: the greatest first.
        for i in sorted(place[lo[j] : hi[j]].tolist(), reverse=True):
            at = bisect_left(tails, i)
            tails[at : at + 1] = [i]
    return len(tails)


def leaked(block: Items, i: int, doc: np.ndarray, grams: np.ndarray) -> bool:
    """Whether the document's best passage holds enough of the item, in runs of shared words and not here and there."""
    item = block.texts[i]
    if len(item) >= K and grams_in_order(block.grams[i], grams) < SHARE * len(item) * (1 - (K - 1) / LEAST_RUN):
        return False  # r runs of m words in all share at least m - (K - 1) r grams in order
    return held_in_parts(item, doc) >= SHARE * len(item)


def candidates(block: Items, h: np.ndarray, of: np.ndarray) -> list[tuple[int, int]]:
    """(text, item) with enough of the item's fingerprints in the text, in order. h: hashes of kept grams; of: which text
    each is of, in order. Hits are counted by pair before the few pairs with enough are counted by place."""
    out: list[tuple[int, int]] = []
    n = len(block.texts)
    if not len(block.hashes) or not len(h):
        return out
    lo, hi = np.searchsorted(block.hashes, h, "left"), np.searchsorted(block.hashes, h, "right")
    some = hi > lo
    lo, times, of = lo[some], (hi - lo)[some], of[some]
    per = max(1, COUNTERS // n)
    for first in range(0, int(of[-1]) + 1 if len(of) else 0, per):
        a, z = np.searchsorted(of, [first, first + per])
        if a == z:
            continue
        t = times[a:z]
        found = np.repeat(lo[a:z] - t.cumsum() + t, t) + np.arange(t.sum())
        item = block.item[found]
        pair = np.repeat(of[a:z] - first, t) * n + item
        enough = np.bincount(pair)[pair] >= block.need[item]
        pair, place = pair[enough], block.place[found[enough]]
        # Each of an item's places counts once.
        kept, places = np.unique(np.unique(pair * block.longest + place) // block.longest, return_counts=True)
        text, item = np.divmod(kept[places >= block.need[kept % n]], n)
        out += zip((text + first).tolist(), item.tolist())
    return out


def _fingerprinted(docs: DataFrame, bloom, key: str) -> DataFrame:
    """key, words, at: the documents that hold HITS fingerprints of items, or the only one they have."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        for batch in by_size(batches, 1):
            parts = [numbers.of(t) for t in batch.column(1).to_pylist()]
            size = np.array([len(p) for p in parts], np.int64)
            ids, of, start = np.concatenate([np.zeros(0, np.int64), *parts]), np.repeat(np.arange(len(parts)), size), size.cumsum() - size
            h, at = winnow(ids, of)
            hit = bloom.value.may_have(h)
            h, at = h[hit], at[hit]
            doc = of[at]
            kept = np.flatnonzero(np.bincount(doc, minlength=len(parts)) >= np.minimum(HITS, np.maximum(1, size - K + 1)))
            chosen = np.isin(doc, kept)
            bounds = np.searchsorted(doc[chosen], kept)
            hashes = pa.ListArray.from_arrays(pa.array(np.append(bounds, chosen.sum()), pa.int32()), pa.array(h[chosen].view(np.int64)))
            taken = [parts[i] for i in kept.tolist()]
            ends = np.cumsum([0, *map(len, taken)])
            numbers_of = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *taken])))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), numbers_of, hashes], ["doc_key", "words", "hashes"])

    return docs.select(key, "text").where("text IS NOT NULL").mapInArrow(run, f"doc_key {kind}, words array<bigint>, hashes array<bigint>")


def _numbered(items: DataFrame) -> DataFrame:
    """item_key and words of the items that have any, one row for each distinct item."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        for batch in batches:
            found = [numbers.of(t).tolist() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["item_key", "words"])

    return items.select("item_id", "text").where("text IS NOT NULL").mapInArrow(run, f"item_key {kind}, words array<bigint>").where("size(words) > 0").distinct()


def leaks(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Distinct (item_id, doc_id) where the document's text holds at least SHARE of the item's words as one passage.

    NULL and empty texts on either side match nothing, nor do texts without words; equal rows give one result; an
    empty table gives an empty one. An item of fewer than K words is found only in texts that have no more. Documents
    are read and cut into words once, whole, whatever the number of items; each block of items, of about block_bytes,
    is then one pass over the written rows of those documents that hold fingerprints at all.
    """
    spark = docs.sparkSession
    numbered = stage(_numbered(items))
    sized = numbered.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("n")).first()["n"]
    # A word takes 8 bytes for itself, 16 for its gram and its place, and about 16 for what is kept of it.
    blocks = max(1, -(-sized * 40 // block_bytes))
    block_of = F.pmod(F.xxhash64("item_key"), F.lit(blocks))

    def block(k: int) -> Items:
        rows = numbered.where(block_of == k).toArrow()
        return Items(rows.column(0).to_pylist(), [np.asarray(x) for x in rows.column(1).to_pylist()])

    bloom = Bloom(sized)
    for k in range(blocks):
        bloom.add(block(k).hashes)
    sent_bloom = spark.sparkContext.broadcast(bloom)
    found = stage(_fingerprinted(docs, sent_bloom, "doc_id"))
    sent_bloom.unpersist()
    kinds = f"item_id {items.schema['item_id'].dataType.simpleString()}, doc_id {docs.schema['doc_id'].dataType.simpleString()}"
    out = []
    for k in range(blocks):
        sent = spark.sparkContext.broadcast(block(k))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            one = sent.value
            for batch in batches:
                h = batch.column(2)
                size = np.diff(h.offsets.to_numpy())
                flat = h.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                words_, last, pairs = batch.column(1), -1, []
                for t, i in candidates(one, flat, np.repeat(np.arange(len(size)), size)):
                    if t != last:
                        doc, last = words_[t].values.to_numpy(zero_copy_only=False).astype(np.int64), t
                        grams = gram_hashes(doc, np.zeros(len(doc), np.int64))
                    if leaked(one, i, doc, grams):
                        pairs.append((t, i))
                ids = pa.array([one.keys[i] for _, i in pairs])
                yield pa.RecordBatch.from_arrays([ids if pairs else ids.cast(pa.int64()), batch.column(0).take(pa.array([t for t, _ in pairs], pa.int64()))], ["item_id", "doc_id"])

        out.append(stage(found.mapInArrow(run, kinds)))
        sent.unpersist()
    drop_stage(found)
    drop_stage(numbered)
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole.distinct()
