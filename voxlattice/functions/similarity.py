"""Similarities of texts, token sets and vectors."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from voxlattice.functions.text import norm_edit


def dice(a: Column, b: Column) -> Column:
    """M-01: twice the shared distinct tokens by all distinct tokens of both; 0 if either side is empty or NULL."""
    shared, size = F.size(F.array_intersect(a, b)), F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    some = a.isNotNull() & b.isNotNull() & (F.size(a) > 0) & (F.size(b) > 0)
    return F.when(some, 2.0 * shared / size).otherwise(0.0)


def edit_similarity(a: Column, b: Column, normalised: bool = False) -> Column:
    """M-02: 1 less the edit distance by the longer length, of the N-5 forms; 0 if either is empty or NULL."""
    x, y = (a, b) if normalised else (norm_edit(a), norm_edit(b))
    longest = F.greatest(F.length(x), F.length(y))
    return F.when((F.length(x) > 0) & (F.length(y) > 0), 1 - F.levenshtein(x, y) / longest).otherwise(0.0)


def cosine(a: Column, b: Column) -> Column:
    """M-06: cosine of two vectors; 0 if either is NULL or has no length."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    times = lambda x, y: total(F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double")))
    size = F.sqrt(times(a, a)) * F.sqrt(times(b, b))
    return F.when(size > 0, times(a, b) / size).otherwise(0.0)


def length_ratio_ok(a: Column, b: Column, most: float = 2.0) -> Column:
    """F-11: both lengths are above 0 and neither is more than `most` times the other."""
    return (a > 0) & (b > 0) & (F.greatest(a / b, b / a) <= most)


def _masks(a: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def _common(a: str, b: str, masks: dict[str, int] | None = None) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    masks = _masks(a) if masks is None else masks
    whole = (1 << len(a)) - 1
    state = whole
    for c in b:
        if u := state & masks.get(c, 0):
            state = (state + u) | (state - u)
    return len(a) - (state & whole).bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence by both lengths, in per cent; two empty texts are equal."""
    return 100.0 * 2 * _common(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial_ratio(a: str, b: str, enough: float = 100.0) -> float:
    """The best ratio of the shorter text with a part of the longer one of its length (at the ends also shorter parts).

    Moving a part by k characters adds at most k to what is shared, so parts that can't be better are passed over.
    The search ends as soon as a ratio of `enough` is found.
    """
    short, long_ = sorted((a, b), key=len)
    n, m = len(short), len(long_)
    if not n:
        return 0.0 if m else 100.0
    masks, best, i = _masks(short), 0.0, 0
    while i <= m - n:
        shared = _common(short, long_[i : i + n], masks)
        best = max(best, 100.0 * shared / n)
        if best >= enough:
            return best
        i += max(1, int(best * n / 100.0 + 1e-9) + 1 - shared)
    for ends in (lambda k: long_[:k], lambda k: long_[m - k :]):
        k, shared = n - 1, n
        while k > 0 and 200.0 * k / (n + k) > best:
            if 200.0 * shared / (n + k) > best:
                shared = _common(short, ends(k), masks)
                best = max(best, 200.0 * shared / (n + k))
                if best >= enough:
                    return best
            k -= 1
    return best


def token_set_ratio(a: str, b: str, blanks: bool = False) -> float:
    """The best ratio among the shared words and the shared words with either side's rest; 0 if a side has no words.

    With blanks, words are what stands between blanks, in their case (M-04, M-05); else runs of word characters in lower
    case (M-03).
    """
    x, y = (set(t.split()) if blanks else set(re.findall(r"\w+", t.lower())) for t in (a, b))
    if not x or not y:
        return 0.0
    return word_set_ratio(x, y)


def word_set_ratio(x: set[str], y: set[str]) -> float:
    """token_set_ratio() of sets of words, neither of them empty. What both texts begin with is in their longest common
    subsequence, so only the rests are compared."""
    shared = x & y
    if shared and (len(shared) == len(x) or len(shared) == len(y)):
        return 100.0
    left, right = sorted((" ".join(sorted(x - shared)), " ".join(sorted(y - shared))), key=len)
    both = len(" ".join(shared))
    head = both + 1 if both else 0
    one, two = head + len(left), head + len(right)
    best = 100.0 * 2 * (head + _common(left, right)) / (one + two)
    return max(best, *(100.0 * 2 * both / (both + n) for n in (one, two))) if both else best


class PackedWords:
    """Sets of words, none of them empty, of which all are compared with another set at once.

    The sorted words of each set, a blank before each, are a field of one long bit vector, and at least one bit above it takes
    what the sums carry over. Words that both sets have are left out by masks.
    """

    def __init__(self, sets: list[set[str]]):
        said = [sorted(x) for x in sets]
        size = [sum(map(len, x)) + len(x) for x in said]
        self.bits = np.array([n // 8 * 8 + 8 for n in size], dtype=np.int64)
        self.starts = self.bits.cumsum() - self.bits
        self.letters, self.number = np.array(size, dtype=np.int64), np.array([len(x) for x in said], dtype=np.int64)
        self.of: dict[str, list[int]] = {}
        places: dict[str, list[int]] = {}
        own: dict[str, list[int]] = {}
        for k, (words, at) in enumerate(zip(said, self.starts.tolist())):
            for w in words:
                self.of.setdefault(w, []).append(k)
                own.setdefault(w, []).append(at)
                for c in " " + w:
                    places.setdefault(c, []).append(at)
                    at += 1
        self.total = int(self.bits.sum())
        self.masks = {c: self._ones(np.array(at)) for c, at in places.items()}
        self.own, self.memo = own, {}
        self.whole = self._ones(self._spread(self.starts, self.letters))

    @staticmethod
    def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The places of ranges."""
        return np.repeat(starts - (sizes.cumsum() - sizes), sizes) + np.arange(sizes.sum())

    def _ones(self, at: np.ndarray) -> int:
        bits = np.zeros(self.total, np.uint8)
        bits[at] = 1
        return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")

    def _word(self, w: str) -> tuple[int, int, np.ndarray]:
        """The bits of the word and the blank before it, the bits of the sets that lack it, and the numbers of those that have it."""
        if w not in self.memo:
            of, at = np.array(self.of[w]), np.array(self.own[w])
            has = self._ones(self._spread(self.starts[of], self.bits[of]))
            self.memo[w] = self._ones(self._spread(at, np.full(len(at), len(w) + 1))), self.whole & ~has, of
        return self.memo[w]

    def ratios(self, y: set[str]) -> np.ndarray:
        """word_set_ratio() of each set with y, to the last digit."""
        words = sorted(y)
        met = {w: self._word(w) for w in words if w in self.of}
        number, letters, gone = np.zeros(len(self.bits), np.int64), np.zeros(len(self.bits), np.int64), 0
        for w, (own, _, of) in met.items():
            gone |= own
            number[of] += 1
            letters[of] += len(w) + 1
        kept = {c: m & ~gone for c in {" "}.union(*words) if (m := self.masks.get(c))}
        state = whole = self.whole
        for w in words:
            lacks = met[w][1] if w in met else whole
            for c in " " + w:
                if m := kept.get(c):
                    u = state & m & lacks
                    state = ((state + u) | (state ^ u)) & whole
        ones = np.bitwise_count(np.frombuffer(state.to_bytes(self.total // 8, "little"), np.uint8))
        # The first blanks are no part of the rests.
        common = self.letters - np.add.reduceat(ones, self.starts // 8, dtype=np.int64) - 1
        mine, theirs = self.letters - letters - 1, sum(map(len, words)) + len(words) - letters - 1
        both = np.maximum(letters - 1, 0)
        head = np.where(number > 0, both + 1, 0)
        one, two = head + mine, head + theirs
        best = 100.0 * 2 * (head + common) / (one + two)
        if met:
            best = np.where(number > 0, np.maximum(best, 100.0 * 2 * both / (both + np.minimum(one, two))), best)
        return np.where((number > 0) & ((number == self.number) | (number == len(words))), 100.0, best)


def strict_scores(a: str, b: str) -> tuple[int, int]:
    """M-03: word-set and partial ratio as whole numbers."""
    return round(token_set_ratio(a, b)), round(partial_ratio(a, b))


@F.pandas_udf(StructType([StructField("words", IntegerType()), StructField("part", IntegerType())]))
def strict_scores_udf(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([strict_scores(x or "", y or "") for x, y in zip(a, b)], columns=["words", "part"]).astype("int32")


@F.pandas_udf(StructType([StructField("words", DoubleType()), StructField("part", DoubleType())]))
def loose_scores_udf(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """M-04: the same ratios as they are, of words between blanks; 0 if a side is empty."""
    return pd.DataFrame([(token_set_ratio(x, y, blanks=True), partial_ratio(x, y)) if x and y else (0.0, 0.0) for x, y in zip(a, b)], columns=["words", "part"], dtype=float)
