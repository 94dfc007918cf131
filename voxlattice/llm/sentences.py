"""Problem 3: sentence boundaries across languages and scripts.

A hidden-event model: between the tokens of a text stand unseen events, boundary or none, which are learnt from the texts
themselves by expectation maximisation; the forward-backward algorithm gives each place its posterior, in learning as in
deciding.

Where a text writes marks, its places are those after marks (in Thai, blanks). The model has the probability of a
boundary after a word and its mark, that of a word and the one after it behind a boundary or behind none, that of letter
case behind each mark, and that of an event after the event before it. Structure is certain: nothing ends within
quotation marks or brackets, and a bracketed question is a unit of its own. What marks and letter case suggest only
starts the first round.

A stretch without any mark that is much longer than those between marks is taken for one that writes none: in it every
gap between words, or characters where words aren't spaced, is a place. There an n-gram model of the tokens, trained
with boundary tokens at the boundaries found before, and the lengths of units decide.

Words are hashed into a fixed number of cells, so the models have one size whatever the corpus.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlattice.llm.batches import by_size
from voxlattice.runtime import stage

#: Cells that words on the left and on the right are hashed into, per language.
LEFT, RIGHT = 8191, 65521
#: Cells of single tokens and of pairs of tokens, of all languages, in the model of texts without marks.
TOKENS, PAIRS = 1 << 17, 1 << 20
#: Rounds of expectation maximisation; few, as what depends on each other counts as if it did not, the more so each round.
ROUNDS = 3
#: Weight of what all words of a shape, or all words before a mark, do, in places of one word.
BACK_OFF = 3.0
#: Weight of the second word on the right, which isn't independent of the first.
NEXT_WEIGHT = 0.5
#: Observations that events are taken to depend on the events before them as if they didn't.
STEP_BACK_OFF = 5.0
#: Share of the dependence that is taken for true; the rest of the weight is on events that don't depend on each other.
STEP_WEIGHT = 0.3
#: A stretch writes no marks if it is so many times as long as the OPEN_QUANTILE of those between places of its language.
OPEN_TIMES, OPEN_QUANTILE = 2.0, 0.9
#: Lengths of units that are told apart, in words, or in characters where words aren't spaced.
LONGEST = 256
#: Weight of pairs of tokens against single ones.
PAIR_WEIGHT = 0.7

_UNSPACED = ("zh", "ja", "th")
LANGUAGES = ("ru", "latin", "el", "hy", "ar", "hi", "th", "ja", "zh", "other")
_SCRIPTS = (("ru", "Ѐ", "ӿ"), ("latin", "A", "ɏ"), ("el", "Ͱ", "Ͽ"), ("hy", "԰", "֏"), ("ar", "؀", "ۿ"), ("hi", "ऀ", "ॿ"), ("th", "฀", "๿"), ("ja", "぀", "ヿ"), ("zh", "一", "鿿"))
BASES, CLOSERS, GAPS = (".", "!", "…", "。", " "), ("", "q", "p"), ("", " ", "\n")
MARKS = {(b, c, g): i for i, (b, c, g) in enumerate((b, c, g) for b in BASES for c in CLOSERS for g in GAPS)}
#: What the word before a mark is counted with: the mark and what closes after it, but not the gap.
BASE_OF = np.array([BASES.index(b) * len(CLOSERS) + CLOSERS.index(c) for b, c, _ in MARKS])
SHAPES = {s: i for i, s in enumerate(("U", "Xi", "l", "c", "num", "date", "dash", "QU", "Ql", "Qc", "other"))}

# Marks that may end a sentence, and marks that open and close.
_ENDS = ".!?…。！？\u0589\u061f\u0964\u0965．｡\u2024"
_MAYBE = {";": "el", "\u037e": "el", ":": "hy"}
_PAIRS = {"«": "»", "“": "”", "„": "“”", "「": "」", "『": "』", "(": ")", "（": "）", "[": "]", "‹": "›"}
_CLOSING = "»”」』)）]›\""
_QUOTES = frozenset("»”“」』›\"")
_SEEN_THROUGH = re.compile("[\\\\_̀-̅̇̉-ͯ­​-‏⁠﻿]")
_SPECIAL = re.compile(rf"[{re.escape(_ENDS + ''.join(_MAYBE) + _CLOSING)}]+|[{re.escape(''.join(_PAIRS))}]")
_DATE = re.compile(r"\d{1,2}\.\d{1,2}\.\d{4}")
_RIGHT = re.compile(r"[^\W\d_]+|\d[\d.,]*")


#: Classes of distance between places: one word, two, more.
_NEAR = 3


def script(c: str) -> str:
    for name, a, b in _SCRIPTS:
        if a <= c <= b:
            return name
    return "other"


class _Letters(dict):
    """Character -> its script, or "" if it is no letter; each found once."""

    def __missing__(self, c: str) -> str:
        self[c] = script(c) if c.isalpha() else ""
        return self[c]


_SCRIPT_OF = _Letters()


def _language(text: str) -> str:
    counts: dict[str, int] = {}
    for c, n in Counter(text).items():
        if name := _SCRIPT_OF[c]:
            counts[name] = counts.get(name, 0) + n
    if counts.get("ja", 0) * 4 > counts.get("zh", 0) > 0:
        return "ja"
    return max(counts, key=counts.get) if counts else "other"


@lru_cache(maxsize=1 << 17)
def _cell(word: str, cells: int) -> int:
    return zlib.crc32(word.encode()) % cells


def _left(before: str, lang: str) -> tuple[str, bool]:
    """The word before a mark, with an abbreviation before it, and whether it is short like an abbreviation."""
    end = len(before)
    while end and not (before[end - 1].isalnum() or before[end - 1] == "_"):
        end -= 1
    start = end
    while start and (before[start - 1].isalnum() or before[start - 1] in "._"):
        start -= 1
    word = before[start:end]
    if word and start > 2 and before[start - 1].isspace() and before[start - 2] == "." and before[start - 3].isalpha():
        # At most three letters of it.
        at = start - 3
        while at and at > start - 5 and before[at - 1].isalpha():
            at -= 1
        word = before[at : start - 1] + word
    last = word.rpartition(".")[2]
    if last.isdigit():
        return "0", False
    if lang in _UNSPACED:
        return word[-2:], False
    if len(last) == 1 and last.isupper():
        return "X", True
    low = word.lower()
    return low, len(last) <= 3 or "." in low


#: What is known of a place: no boundary, a boundary, nothing; the end of a text, of which the word and mark count as those
#: of a boundary; the start of one, of which what follows does, and which isn't a place itself.
OPEN, ENDS, STARTS = 2, 3, 4
#: What is told of a place. end: offset in the raw text; sure: 0 or 1 or one of the above; words: since the place before, in words or thirds of characters; first: what the first round takes for the probability of a boundary.
PLACE = {"ends": np.int32, "sure": np.int8, "mark": np.int32, "left": np.int32, "shape": np.int32, "right": np.int32, "following": np.int32, "words": np.int32, "first": np.float32}


def _first_guess(base: str, closer: str, gap: str, short: bool, left: str, shape: str, unspaced: bool) -> float:
    """Where expectation maximisation starts: what marks and letter case suggest."""
    if base == " ":
        return 0.95
    if shape in ("l", "Ql"):
        return 0.3 if gap == "\n" else 0.02
    if shape == "dash":
        return 0.05 if closer == "q" else 0.3
    if gap == "\n":
        return 0.98
    if closer == "p":
        return 0.3
    caseless = shape in ("c", "Qc")
    if base in ("!", "。"):
        # After speech, scripts without spaces and letter case give no hint whether the author goes on.
        return 0.95 if not (closer and caseless) else 0.5 if unspaced and gap != "\n" else 0.75
    if base == "…":
        return 0.5 if caseless else 0.85
    guess = 0.3 if left == "0" else 0.35 if short else 0.9
    return guess * 0.8 if gap == "" else guess


def _stretches(clean: str, specials: list[tuple[int, int]], unspaced: bool) -> list[tuple[int, int, int]]:
    """(start, end, length) of what stands between marks, in words or thirds of characters, where it may be long."""
    out, a = [], 0
    least = 3 if unspaced else 1
    for start, end in [*specials, (len(clean), len(clean))]:
        if start - a > 12 * least:
            piece = clean[a:start]
            n = (len(piece) - sum(map(str.isspace, piece))) // 3 if unspaced else len(piece.split())
            out.append((a, start, n))
        a = end
    return out


def _seen(text: str) -> tuple[str, Callable[[int], int]]:
    """The text without what is seen through, and a function from its ends to ends in the raw text."""
    dropped = [m.start() for m in _SEEN_THROUGH.finditer(text)]
    if not dropped:
        return text, lambda end: end
    # Before how many clean characters each of them stands.
    before = [at - k for k, at in enumerate(dropped)]
    return _SEEN_THROUGH.sub("", text), lambda end: end + bisect_right(before, end - 1) if end else 0


def _right(rest: str, word: str, unspaced: bool) -> tuple[str, str, str]:
    """Shape of what begins with `rest`, its first word, and the one after that. word: what stands before."""
    found = _RIGHT.search(rest)
    head, right = rest[0], found.group() if found else ""
    cased = lambda c: "U" if c.isupper() else "l" if c.islower() else "c"
    if head in "—–-":
        shape = "dash"
    elif head in _PAIRS or head == '"':
        shape = "Q" + (cased(right[0]) if right else "c")
    elif head.isdigit():
        shape = "date" if _DATE.match(rest) else "num"
    elif not head.isalpha():
        shape = "other"
    elif len(right) == 1 and right.isupper() and rest[1:2] == ".":
        # Initials follow each other within a name, but may begin one anywhere.
        shape = "Xi"
    else:
        shape = cased(head)
    # Where words aren't spaced, the second is what the next clause ends with.
    if unspaced:
        following = right[-2:]
    else:
        second = _RIGHT.search(rest, found.end()) if found else None
        following = second.group() if second else ""
    if shape in ("date", "num"):
        return shape, shape[:2] if unspaced else shape, following
    if shape == "Xi":
        return shape, "Xi after X" if word == "X" else "Xi", following
    return shape, right[:2] if unspaced else right, following


def places(text: str) -> tuple[str, int, list[tuple]]:
    """Language, longest stretch without marks, and all places of a text, as PLACE has them; the last is its end."""
    clean, to_raw = _seen(text)
    lang = _language(clean)
    n = len(clean.rstrip())
    unspaced = lang in _UNSPACED
    out: list[list] = []
    stack: list[str] = []
    unit_from = last_place = 0

    def add(end: int, base: str, closer: str, sure: int | None = None) -> None:
        nonlocal unit_from, last_place
        after = clean[end : end + 60]
        blank = len(after) - len(after.lstrip())
        rest = after[blank:]
        count = (end - last_place) // 3 if unspaced else len(clean[last_place:end].split())
        if sure is None and rest and rest[0] in ",:;)]»”":
            sure = 0
        place = [to_raw(end), sure, 0, 0, 0, 0, 0, count, 0.5]
        if sure is None:
            gap = "\n" if "\n" in after[:blank] else " " if blank else ""
            word, short = _left(clean[max(0, end - 40) : end], lang)
            if not rest:
                place = [to_raw(end), ENDS, MARKS[base, closer, gap], _cell(word, LEFT), 0, 0, 0, count, 0.5]
            else:
                shape, right, following = _right(rest, word, unspaced)
                if gap == "" and base == "." and shape in ("l", "num", "date"):
                    place[1] = 0
                else:
                    first = _first_guess(base, closer, gap, short, word, shape, unspaced)
                    place = [to_raw(end), OPEN, MARKS[base, closer, gap], _cell(word, LEFT), SHAPES[shape], _cell(right, RIGHT), _cell(following, RIGHT), count, first]
        out.append(place)
        last_place = end
        if place[1] in (1, ENDS):
            unit_from = end

    head = clean[:80].lstrip()
    if head:
        shape, right, following = _right(head[:60], "", unspaced)
        out.append([0, STARTS, len(MARKS), 0, SHAPES[shape], _cell(right, RIGHT), _cell(following, RIGHT), 0, 0.5])
    blanks = re.compile(r"\s+") if lang == "th" else None
    specials = [(m.start(), m.end()) for m in _SPECIAL.finditer(clean)]
    if blanks:
        specials += [(m.start(), m.end()) for m in blanks.finditer(clean)]
        specials.sort()
    stretch = max((n for _, _, n in _stretches(clean, specials, unspaced)), default=0)
    for a, b in specials:
        if a >= n:
            break
        run = clean[a:b]
        if run.isspace():
            if not stack and out and out[-1][0] == to_raw(a) or stack or not a:
                continue
            beside = clean[a - 1].isdigit() or clean[b : b + 1].isdigit()
            add(a, " ", "", 0 if beside else None)
            continue
        if run in _PAIRS and len(run) == 1 and not (run == "“" and stack and "“" in _PAIRS.get(stack[-1], "")):
            if run == "[" and not stack and clean[unit_from:a].strip():
                end = len(clean[:a].rstrip())
                if out and out[-1][0] == to_raw(end):
                    out[-1][1] = 1
                    unit_from = last_place = end
                else:
                    add(end, ".", "", 1)
            stack.append(run)
            continue
        ended = closer = ""
        bracket = False
        for k, c in enumerate(run):
            if c in _CLOSING or c == "“":
                if c == '"' and '"' not in stack:
                    stack.append('"')
                    continue
                for s in range(len(stack) - 1, -1, -1):
                    if c in _PAIRS.get(stack[s], stack[s]):
                        bracket |= stack[s] == "[" and s == 0
                        del stack[s:]
                        break
                closer = "q" if c in _QUOTES else "p" if c in ")）" else closer
            elif c in _MAYBE:
                before = clean[a + k - 1] if a + k else ""
                if before and script(before) == _MAYBE[c] and not (c == ":" and clean[b : b + 2].lstrip()[:1] in tuple(_PAIRS)):
                    ended += c
            else:
                ended += c
        if stack:
            continue
        if bracket:
            add(b, ".", "", 1)
            continue
        if not ended:
            continue
        if b < n and ended == "." and clean[b].isdigit() and a and clean[a - 1].isdigit():
            continue
        base = "!" if any(c in "!?！？\u061f\u037e;" for c in ended) else "。" if any(c in "。｡\u0589\u0964\u0965:" for c in ended) else "…" if "…" in ended or ended.count(".") > 1 else "."
        add(b, base, closer)
    if n and (not out or out[-1][0] < to_raw(n)):
        add(n, ".", "", 1)
    if out:
        # The last unit ends with the text, marks seen through and all.
        out[-1][:2] = len(text.rstrip()), ENDS if out[-1][1] == ENDS else 1
    return lang, stretch, out


_K, _M, _B, _S = len(LANGUAGES), len(MARKS) + 1, len(BASES) * len(CLOSERS), len(SHAPES)
#: Tables of expected counts of events, none and boundary, laid out one after another.
TABLES = {"mark": (_K, _M), "shape": (_K, _M, _S), "left": (_K, _B, LEFT), "right": (_K, RIGHT), "following": (_K, RIGHT), "step": (_NEAR, 2), "length": (_K, LONGEST)}
OFFSET = dict(zip(TABLES, np.cumsum([0, *map(math.prod, TABLES.values())]).tolist()))
CELLS = sum(map(math.prod, TABLES.values()))


class Model:
    """Expected counts of events: by language and mark; by mark and shape of what follows; by mark and word before it; by
    the word behind it and the one after that; by the event before and how near it is. length: lengths between places."""

    def __init__(self, cells: np.ndarray | None = None):
        self.ready = cells is not None
        flat = np.zeros((CELLS, 2)) if cells is None else cells
        for name, shape in TABLES.items():
            table = flat[OFFSET[name] : OFFSET[name] + math.prod(shape)].reshape(*shape, 2)
            setattr(self, name, table if name in ("step", "length") else table.astype(np.float32))
        self.by_shape = self.shape.sum(1)
        self.total = self.by_shape.sum(1)
        # How much likelier an event is after the one before it than at such a distance at all.
        step = self.step + STEP_BACK_OFF * (self.step.sum(1, keepdims=True) + 1) / (self.step.sum((1, 2))[:, None, None] + 2)
        of_any = step.sum(1, keepdims=True)
        ratio = step / step.sum(2, keepdims=True) / (of_any / of_any.sum(2, keepdims=True))
        self.steps = np.log(STEP_WEIGHT * ratio + 1 - STEP_WEIGHT)

    def logit(self, lang, mark, left, shape, right, following) -> np.ndarray:
        """Log odds of a boundary at places given as arrays, without what stands at other places."""
        odds = lambda x: np.log(x[..., 1] / x[..., 0])
        by_mark = self.mark[lang, mark] + 0.5
        prior = self.left[lang, BASE_OF[mark], left] + BACK_OFF * by_mark / by_mark.sum(-1, keepdims=True)
        total = self.total[lang] + 1.0
        by_shape = (self.by_shape[lang, shape] + 0.1) / (total + 0.1 * _S)
        after_mark = (self.shape[lang, mark, shape] + BACK_OFF * by_shape) / (self.mark[lang, mark] + BACK_OFF)
        # A word's share backs off to that of its shape behind the mark, the share of the one after it to what the language does.
        word = (self.right[lang, right] + BACK_OFF * after_mark) / (total + BACK_OFF)
        second = (self.following[lang, following] + BACK_OFF * total / total.sum(-1, keepdims=True)) / total
        return odds(prior) + odds(word) + NEXT_WEIGHT * odds(second)

    def open_from(self) -> np.ndarray:
        """By language, the length from which a stretch is one that writes no marks."""
        counts = self.length.sum(-1)
        below = counts.cumsum(1) / np.maximum(counts.sum(1, keepdims=True), 1)
        at = (below >= OPEN_QUANTILE).argmax(1)
        return np.where(counts.sum(1) > 0, np.maximum(12, OPEN_TIMES * at), OPEN_TIMES * LONGEST)


#: Log odds that stand for certainty.
CERTAIN = 60.0


def forward_backward(logit: np.ndarray, near: np.ndarray, text: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds, after all evidence, of a boundary at each place, and the posterior of each pair of events, [place][before][now].

    logit: of the place alone; near: class of the distance to the place before; text: which text it is in, in order; steps:
    weights of events after events. Before the first place of a text stands a boundary. All texts go together, one
    place of each at a time.
    """
    n = len(logit)
    if not n:
        return np.zeros(0), np.zeros((0, 2, 2))
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    size = np.diff(np.append(first, n))
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    own = np.stack([np.zeros(n), logit], 1)
    edge = steps[near]
    edge[first, 0] = -np.inf
    ahead, behind = np.empty((n, 2)), np.zeros((n, 2))
    ahead[first] = edge[first, 1] + own[first]
    longest = int(size[0])
    many = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")
    for k in range(1, longest):
        at = first[: many[k]] + k
        x = np.logaddexp(ahead[at - 1, :1] + edge[at, 0], ahead[at - 1, 1:] + edge[at, 1]) + own[at]
        ahead[at] = x - x.max(1, keepdims=True)
    for k in range(longest - 1, 0, -1):
        at = first[: many[k]] + k
        x = (behind[at] + own[at])[:, None, :] + edge[at]
        x = np.logaddexp(x[:, :, 0], x[:, :, 1])
        behind[at - 1] = x - x.max(1, keepdims=True)
    odds = ahead[:, 1] + behind[:, 1] - ahead[:, 0] - behind[:, 0]
    before = np.vstack([[0.0, 0.0], ahead[:-1]])
    before[first] = (-np.inf, 0.0)
    both = before[:, :, None] + edge + (own + behind)[:, None, :]
    both = np.exp(both - both.max((1, 2), keepdims=True))
    return odds, both / both.sum((1, 2), keepdims=True)


class Batch:
    """The places of some texts as arrays."""

    def __init__(self, batch: pa.RecordBatch):
        lists = {name: batch.column(batch.schema.get_field_index(name)) for name in PLACE}
        size = np.diff(lists["ends"].offsets.to_numpy())
        self.texts = len(size)
        self.text = np.repeat(np.arange(len(size)), size)
        for name, kind in PLACE.items():
            setattr(self, name, lists[name].flatten().to_numpy(zero_copy_only=False).astype(kind))
        self.lang = np.repeat(batch.column(batch.schema.get_field_index("lang")).to_numpy(zero_copy_only=False), size)
        self.near = np.minimum(np.maximum(self.words, 1), _NEAR) - 1
        self.open = self.sure == OPEN

    def posterior(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        o = self.open
        alone = np.where(self.sure == 0, -CERTAIN, CERTAIN)
        if model.ready:
            alone[o] = model.logit(self.lang[o], self.mark[o], self.left[o], self.shape[o], self.right[o], self.following[o])
        else:
            alone[o] = np.log(self.first[o] / (1 - self.first[o]))
        return forward_backward(alone, self.near, self.text, model.steps)

    def add_counts(self, model: Model, cells: np.ndarray) -> None:
        """Add what is expected of these places to the cells."""
        odds, both = self.posterior(model)
        o = self.open
        p = 1 / (1 + np.exp(-np.clip(odds[o], -CERTAIN, CERTAIN)))
        lang, mark, shape = self.lang[o], self.mark[o], self.shape[o]
        at = {"mark": (lang, mark), "shape": (lang, mark, shape), "left": (lang, BASE_OF[mark], self.left[o]), "right": (lang, self.right[o]), "following": (lang, self.following[o])}
        for name, index in at.items():
            cell = OFFSET[name] + np.ravel_multi_index(index, TABLES[name])
            np.add.at(cells[:, 0], cell, 1 - p)
            np.add.at(cells[:, 1], cell, p)
        ends, starts = self.sure == ENDS, self.sure == STARTS
        np.add.at(cells[:, 1], OFFSET["left"] + np.ravel_multi_index((self.lang[ends], BASE_OF[self.mark[ends]], self.left[ends]), TABLES["left"]), 1.0)
        lang, mark, shape = self.lang[starts], self.mark[starts], self.shape[starts]
        for name, index in {"mark": (lang, mark), "shape": (lang, mark, shape), "right": (lang, self.right[starts]), "following": (lang, self.following[starts])}.items():
            np.add.at(cells[:, 1], OFFSET[name] + np.ravel_multi_index(index, TABLES[name]), 1.0)
        for before in (0, 1):
            np.add.at(cells, OFFSET["step"] + self.near[o] * 2 + before, both[o][:, before])
        real = ~starts
        np.add.at(cells[:, 0], OFFSET["length"] + self.lang[real] * LONGEST + np.minimum(self.words[real], LONGEST - 1), 1.0)


def _sums(rows: DataFrame, add, cells: int) -> np.ndarray:
    """The sum over all rows of what add(batch, cells) puts into cells, an array of `cells` pairs of numbers. Each task adds
    up its own before they are shuffled, and no more than the cells come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((cells, 2))
        for batch in batches:
            add(batch, held)
        at = np.flatnonzero(held.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at, 0]), pa.array(held[at, 1])], ["cell", "none", "one"])

    found = rows.mapInArrow(run, "cell bigint, none double, one double").groupBy("cell").agg(F.sum("none").alias("none"), F.sum("one").alias("one")).toArrow()
    out = np.zeros((cells, 2))
    out[found.column("cell").to_numpy()] = np.stack([found.column("none").to_numpy(), found.column("one").to_numpy()], 1)
    return out


_CODE = {lang: i for i, lang in enumerate(LANGUAGES)}


def _as_rows(found: list[tuple[str, int, list[tuple]]]) -> list[pa.Array]:
    """lang, stretch and the lists of PLACE of texts."""
    offsets = pa.array(np.cumsum([0, *(len(ps) for _, _, ps in found)]), pa.int32())
    columns = list(zip(*(p for _, _, ps in found for p in ps))) or [()] * len(PLACE)
    lists = [pa.ListArray.from_arrays(offsets, pa.array(np.array(c, kind))) for c, kind in zip(columns, PLACE.values())]
    return [pa.array([_CODE[lang] for lang, _, _ in found], pa.int32()), pa.array([n for _, n, _ in found], pa.int32()), *lists]


def _placed(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, lang, stretch, and the places of every text that has any."""
    kinds = {np.int32: "int", np.int8: "tinyint", np.float32: "float"}
    schema = ", ".join([*[f"k{i} {texts.schema[k].dataType.simpleString()}" for i, k in enumerate(keys)], "lang int, stretch int", *[f"{name} array<{kinds[kind]}>" for name, kind in PLACE.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, len(keys)):
            found = [places(t) if t else None for t in batch.column(len(keys)).to_pylist()]
            kept = [i for i, x in enumerate(found) if x and x[2]]
            take = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(i).take(take) for i in range(len(keys))], *_as_rows([found[i] for i in kept])], [*[f"k{i}" for i in range(len(keys))], "lang", "stretch", *PLACE])

    return texts.select(*keys, text).mapInArrow(run, schema)


def fit(placed: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model learnt from all places."""
    rows = placed.select("lang", *PLACE)
    model, spark = Model(), placed.sparkSession
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)
        model = Model(_sums(rows, lambda batch, cells, sent=sent: Batch(batch).add_counts(sent.value, cells), CELLS))
        sent.unpersist()
    return model


def _decided(placed: DataFrame, keys: list[str], sent) -> DataFrame:
    """keys and end_char of the boundaries among the places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = Batch(batch)
            found = (b.posterior(sent.value)[0] > 0) & (b.sure != STARTS)
            take = pa.array(b.text[found])
            yield pa.RecordBatch.from_arrays([*[batch.column(i).take(take) for i in range(len(keys))], pa.array(b.ends[found], pa.int32())], [*[f"k{i}" for i in range(len(keys))], "end_char"])

    kinds = {f.name: f.dataType.simpleString() for f in placed.schema}
    return placed.drop("stretch").mapInArrow(run, ", ".join([*[f"k{i} {kinds[f'k{i}']}" for i in range(len(keys))], "end_char int"]))


def boundaries(texts: list[str], model: Model) -> list[tuple[str, list[int]]]:
    """Language and ends of the sentence units of texts that write marks."""
    found = [places(t) for t in texts]
    b = Batch(pa.RecordBatch.from_arrays(_as_rows(found), ["lang", "stretch", *PLACE]))
    ends: list[list[int]] = [[] for _ in texts]
    kept = (b.posterior(model)[0] > 0) & (b.sure != STARTS)
    for i, end in zip(b.text[kept].tolist(), b.ends[kept].tolist()):
        ends[i].append(end)
    return [(lang, e) for (lang, _, _), e in zip(found, ends)]


# ---- Texts without marks: an n-gram model over all gaps.

_SPACED_TOKEN = re.compile(r"[^\s]+")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
#: Tables of the model: tokens that end a unit or not, tokens that begin one or not, pairs not parted, lengths of units.
GRAMS = {"ends": TOKENS, "starts": TOKENS, "pairs": PAIRS, "totals": _K, "units": _K * LONGEST}
GRAM_OFFSET = dict(zip(GRAMS, np.cumsum([0, *GRAMS.values()]).tolist()))
GRAM_CELLS = sum(GRAMS.values())


def tokens(text: str, unspaced: bool, start: int = 0, end: int | None = None) -> list[tuple[int, int, str]]:
    """(start, end, form) of the words of a text, or of its characters where words aren't spaced, without marks and case."""
    end = len(text) if end is None else end
    if unspaced:
        return [(i, i + 1, c) for i in range(start, end) if not (c := text[i]).isspace() and c not in _ENDS and c not in _CLOSING and c not in _PAIRS and (c.isalnum() or script(c) == "th")]
    out = []
    for m in _SPACED_TOKEN.finditer(text, start, end):
        form = m.group()
        if not (form[0].isalnum() and form[-1].isalnum()):
            form = _EDGES.sub("", form) or form
        if any(map(str.isalnum, form)):
            out.append((m.start(), m.end(), "0" if form[0].isdigit() else form.lower()))
    return out


def _token_cells(forms: list[str], lang: int, unspaced: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of what stands before each gap, of what follows it, and of both. Where words aren't spaced two characters
    on either side count as one token."""
    before = ["".join(forms[max(0, i - 1) : i + 1]) for i in range(len(forms) - 1)] if unspaced else forms[:-1]
    after = ["".join(forms[i : i + 2]) for i in range(1, len(forms))] if unspaced else forms[1:]
    cell = lambda x, n: _cell(f"{lang} {x}", n)
    return np.array([cell(x, TOKENS) for x in before], np.int64), np.array([cell(x, TOKENS) for x in after], np.int64), np.array([cell(f"{a} {b}", PAIRS) for a, b in zip(before, after)], np.int64)


class Grams:
    """Counts of tokens and pairs of tokens with and without a boundary between them."""

    def __init__(self, cells: np.ndarray):
        for name, n in GRAMS.items():
            setattr(self, name, cells[GRAM_OFFSET[name] : GRAM_OFFSET[name] + n].astype(np.float32))
        self.units = self.units[:, 0].reshape(_K, LONGEST)

    @staticmethod
    def add(text: str, lang: int, ends: list[int], cells: np.ndarray) -> None:
        """Count the tokens of a text whose units end at `ends`."""
        unspaced = LANGUAGES[lang] in _UNSPACED
        found = tokens(text, unspaced)
        if len(found) < 2:
            return
        before, after, pair = _token_cells([f for _, _, f in found], lang, unspaced)
        at = np.searchsorted(np.array(ends), [e for _, e, _ in found[:-1]])
        until = np.searchsorted(np.array(ends), [s for s, _, _ in found[1:]], side="right")
        parted = (until > at).astype(int)
        np.add.at(cells, (GRAM_OFFSET["ends"] + before, parted), 1.0)
        np.add.at(cells, (GRAM_OFFSET["starts"] + after, parted), 1.0)
        np.add.at(cells, (GRAM_OFFSET["pairs"] + pair, parted), 1.0)
        np.add.at(cells, (np.full(len(parted), GRAM_OFFSET["totals"] + lang), parted), 1.0)
        lengths = np.diff(np.append(np.append(-1, np.flatnonzero(parted)), len(found) - 1))
        np.add.at(cells[:, 0], GRAM_OFFSET["units"] + lang * LONGEST + np.minimum(lengths, LONGEST - 1), 1.0)

    def odds(self, forms: list[str], lang: int) -> np.ndarray:
        """For each gap, how much likelier its tokens are with a boundary than without."""
        before, after, pair = _token_cells(forms, lang, LANGUAGES[lang] in _UNSPACED)
        none, one = self.totals[lang] + 1.0
        any_end, any_start = (self.ends[before].sum(1) + 0.5) / (none + one), (self.starts[after].sum(1) + 0.5) / (none + one)
        ends = np.log((self.ends[before, 1] + BACK_OFF * any_end) / (one + BACK_OFF)) - np.log((self.ends[before, 0] + BACK_OFF * any_end) / (none + BACK_OFF))
        inside = (self.starts[after, 0] + BACK_OFF * any_start) / (none + BACK_OFF)
        paired = PAIR_WEIGHT * self.pairs[pair, 0] / (self.ends[before, 0] + 0.5) + (1 - PAIR_WEIGHT) * inside
        return ends + np.log((self.starts[after, 1] + BACK_OFF * any_start) / (one + BACK_OFF)) - np.log(paired)

    def split(self, forms: list[str], lang: int) -> list[int]:
        """Gaps (numbers of the tokens before them) that are boundaries, by forward-backward over units of all lengths."""
        n = len(forms)
        if n < 2:
            return []
        gain = np.append(self.odds(forms, lang), 0.0)
        units = self.units[lang] + 1e-3
        seen = units[1:].cumsum()
        most = int((seen < 0.9999 * seen[-1]).sum()) + 1
        # Lengths beyond those seen get ever less likely, so that any stretch can be parted.
        length = np.log(np.convolve(units[1 : most + 2], [0.25, 0.5, 0.25], "same")[: most + 1] / seen[-1])
        most = len(length)
        ahead, behind = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        ahead[0] = behind[n] = 0.0
        for j in range(1, n + 1):
            a = max(0, j - most)
            x = ahead[a:j] + length[: j - a][::-1] + gain[j - 1]
            ahead[j] = x.max() + np.log(np.exp(x - x.max()).sum()) if np.isfinite(x.max()) else -np.inf
        for i in range(n - 1, -1, -1):
            z = min(n, i + most)
            x = behind[i + 1 : z + 1] + length[: z - i] + gain[i:z]
            behind[i] = x.max() + np.log(np.exp(x - x.max()).sum()) if np.isfinite(x.max()) else -np.inf
        return (np.flatnonzero(ahead[1:n] + behind[1:n] - ahead[n] > math.log(0.5))).tolist()


def unmarked(text: str, open_from: np.ndarray) -> list[tuple[int, list[tuple[int, int, str]]]]:
    """(language, tokens with raw offsets) of each stretch of a text that writes no marks."""
    clean, to_raw = _seen(text)
    name = _language(clean)
    lang, unspaced = _CODE[name], name in _UNSPACED
    specials = [(m.start(), m.end()) for m in _SPECIAL.finditer(clean)]
    if name == "th":
        specials = sorted(specials + [(m.start(), m.end()) for m in re.finditer(r"\s+", clean)])
    out = []
    for a, b, n in _stretches(clean, specials, unspaced):
        if n > open_from[lang]:
            found = tokens(clean, unspaced, a, b)
            out.append((lang, [(to_raw(s + 1) - 1, to_raw(e), f) for s, e, f in found]))
    return out


def _without_marks(texts: DataFrame, keys: list[str], text: str, model: Model) -> DataFrame:
    """keys and end_char of the boundaries in stretches without marks."""
    spark, open_from = texts.sparkSession, model.open_from()
    sent = spark.sparkContext.broadcast(model)

    def count(batch: pa.RecordBatch, cells: np.ndarray) -> None:
        marked = [t for t in batch.column(0).to_pylist() if t and not unmarked(t, open_from)]
        for t, (lang, ends) in zip(marked, boundaries(marked, sent.value)):
            Grams.add(t, _CODE[lang], ends, cells)

    grams = spark.sparkContext.broadcast(Grams(_sums(texts.select(text), count, GRAM_CELLS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, ends = [], []
            for i, t in enumerate(batch.column(len(keys)).to_pylist()):
                for lang, found in unmarked(t, open_from) if t else ():
                    cut = [found[k][1] for k in grams.value.split([f for _, _, f in found], lang)]
                    at += [i] * len(cut)
                    ends += cut
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(take) for k in range(len(keys))], pa.array(ends, pa.int32())], [*keys, "end_char"])

    schema = ", ".join(f"`{k}` {texts.schema[k].dataType.simpleString()}" for k in keys) + ", end_char int"
    return texts.select(*keys, text).mapInArrow(run, schema)


def sentence_ends(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys and end_char, one row for each sentence unit of each text.

    The model is learnt from all the texts given. NULL and empty texts, and those of blanks only, have no units;
    equal rows have theirs each; very long texts are taken whole; an empty table gives an empty one. Texts are searched
    for places once; they are read again only if any of them writes no marks.
    """
    placed = stage(_placed(texts, keys, text))
    model = fit(placed)
    sent = texts.sparkSession.sparkContext.broadcast(model)
    out = _decided(placed, keys, sent).toDF(*keys, "end_char")
    longest = {r["lang"]: r["n"] for r in placed.groupBy("lang").agg(F.max("stretch").alias("n")).collect()}
    if any(n > model.open_from()[lang] for lang, n in longest.items()):
        out = out.unionByName(_without_marks(texts, keys, text, model))
    return out
