"""Problem 9: keyword-stuffed pages and lists of links, tags or goods.

Every text is cut into windows of words. Each window gets the share of function words, of numbers and of markup
(links, tags), its repetition within the text, and its entropy. Per language a robust centre and scatter of these
are estimated from all windows; a window is spam if its robust Mahalanobis distance is beyond a quantile of the
chi-square distribution and it lies in a spam-directed direction. A text is spam if more than half of it is.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlattice.llm.batches import by_size
from voxlattice.runtime import stage

#: Words in a window.
WINDOW = 16
FEATURES = ("function_words", "numbers", "markup", "repetition", "entropy")
#: Different tokens that a worker remembers.
REMEMBERED = 500_000
#: Which way spam lies along each feature.
TOWARDS = (-1, 1, 1, 1, -1)
#: Least spread of a feature, for those that are 0 in most windows.
FLOOR = (0.06, 0.045, 0.05, 0.06, 0.07)
#: 0.999 quantile of chi-square with as many degrees of freedom as features.
LIMIT = 20.52
#: Rounds of re-estimation, and the share of windows nearest to the centre that each takes.
ROUNDS, KEPT = 3, 0.75
#: A language's centre and scatter are drawn to those of all languages as if this many windows of them were its own.
SHRINK = 200

# Frequent words of the closed classes, by language.
FUNCTION_WORDS = {
    "ru": "а без бы был была были было в вас ведь во вот все всё всего г где да даже для до его ее её если есть ещё же за и из или им их к как когда кто ли либо мы на над нам нас не него нее ней нет ни никто них но о об однако он она они оно от по под пока потом потому при про с со так также там те тем то того тоже той только том ты у уже хотя чем что чтобы эта эти это этого я",
    "en": "a about after all although an and any are as at be because been before between but by can could during each every for from had has have he her him his i if in into is it its many no not of off on once or our out she so some than that the their them then there these they this those through to two under until up was we were when where which while who will with without would you",
    "de": "aber als am an auch auf aus bei bis das dass dem den der des die ein eine einem einen einer es für hat ich im in ist jeden man mit nach neben nicht noch nur oder sie sind so über um und uns unter von vor war waren was wenn wer wie wir wo zu zum zur",
    "el": "αν από για δεν ένα η και κάθε κοντά με μετά να ο οι όπως όταν πέρα που πριν σαν σε στα στη στην στις στο στον στους τα τη την της τι τις το τον του τους των",
    "ar": "إلى أن أو إن التي الذي بعد ثم حتى على عن عند في قبل قد قرب كان كانت كانوا كل لا لم ما مع من هذا هذه هل هو هي و عبر",
    "hi": "और का कि की के को कहा जो तक था थी थे ने पर पास पार भी में यह वह से है हैं हो",
    "hy": "այդ են է էին էր և ես կողմ համար հետ ինչ մեջ մի մոտ նա որ որպես վրա այն",
}
_UNSPACED = {"zh": "的了在也和是有我他她它们这那就都而及与或但把被从到后前说着过", "ja": "のはをがにでともへやかられたてだなしいすま", "th": "ที่และใน"}
_SETS = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()} | {k: frozenset(v) for k, v in _UNSPACED.items()}
_SCRIPTS = (("ru", "а", "я"), ("el", "α", "ω"), ("hy", "ա", "ֆ"), ("ar", "ء", "ي"), ("hi", "ऄ", "ह"), ("th", "ก", "ฮ"), ("ja", "ぁ", "ヺ"), ("zh", "一", "鿿"), ("latin", "a", "z"))
LANGUAGES = ("ru", "en", "de", "el", "ar", "hi", "hy", "th", "ja", "zh", "other")
_DROP = {c: None for c in (*range(0x300, 0x306), 0x307, *range(0x309, 0x370), ord("\\"), ord("_"), 0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF)}
_TIME, _NUMBER = r"\d{1,2}:\d\d(?::\d\d)?(?:[.,]\d{1,3})?", r"\d+(?:[.,]\d+)*"
_LINK = r"</?[a-z]+(?: [^<>]*)?>|https?://\S+|(?:[a-z0-9-]+\.)+[a-z]{2,9}(?:/\S*)?(?![\w.])|#\w+"
_OTHER = r"[\u3040-\u30FF\u4E00-\u9FFF]|[\u0E00-\u0E7F]{1,3}|[^\W\d_]+(?:[\u0900-\u0903\u093A-\u094F]+[^\W\d_]*)*"
_TOKENS = re.compile(f"({_TIME}|{_LINK}|{_NUMBER}|{_OTHER})")
_DROPPED = re.compile("[̀-̅̇̉-ͯ\\\\_­​-‏⁠﻿]")


class _Kinds(dict):
    """Token -> WORD, LINK, NUMBER or TIME, each found once."""

    def __missing__(self, token: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        kind = TIME if re.fullmatch(_TIME, token) else LINK if re.fullmatch(_LINK, token) else NUMBER if re.fullmatch(_NUMBER, token) else WORD
        self[token] = kind
        return kind


class _Scripts(dict):
    """Character -> its script or "", each found once."""

    def __missing__(self, c: str) -> str:
        self[c] = next((name for name, a, b in _SCRIPTS if a <= c <= b), "")
        return self[c]


WORD, LINK, NUMBER, TIME = range(4)
_KIND_OF, _SCRIPT_OF = _Kinds(), _Scripts()


def language(words: list[str]) -> str:
    """The language of words by script, and by function words among those in Latin letters."""
    counts: dict[str, int] = {}
    for c, n in Counter("".join(words)).items():
        if name := _SCRIPT_OF[c]:
            counts[name] = counts.get(name, 0) + n
    if counts.get("ja", 0) * 4 > counts.get("zh", 0) > 0:
        return "ja"
    best = max((name for name, _, _ in _SCRIPTS), key=lambda name: counts.get(name, 0))
    if best not in counts:
        return "other"
    if best != "latin":
        return best
    return max(("en", "de"), key=lambda k: sum(map(_SETS[k].__contains__, words)))


def windows(texts: list[str], window: int = WINDOW) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Which text each window is of, its language and characters, and its features (rows), of whole texts.

    Each text is cut into tokens on its own; all else is counted for all texts together. Texts without tokens have none.
    """
    tokens: list[str] = []
    lengths, counts, langs, function = [], [], [], []
    for text in texts:
        parts = _TOKENS.split(_DROPPED.sub("", text.lower()))
        found = parts[1::2]
        counts.append(len(found))
        if not found:
            langs.append("other")
            continue
        lang = language([t for t in found if _KIND_OF[t] == WORD])
        langs.append(lang)
        function.append(np.fromiter(map(_SETS.get(lang, frozenset()).__contains__, found), bool, len(found)))
        # What stands behind a token counts with it.
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        lengths.append(size[1::2] + size[2::2])
        tokens += found
    if not tokens:
        return np.zeros(0, np.int64), [], np.zeros(0, np.int64), np.zeros((0, len(FEATURES)))
    n = np.array(counts)
    of, start = np.repeat(np.arange(len(texts)), n), n.cumsum() - n
    kind = np.fromiter(map(_KIND_OF.__getitem__, tokens), np.int8, len(tokens))
    chars, is_function = np.concatenate(lengths), np.concatenate(function)
    known: dict[str, int] = defaultdict(count().__next__)
    same = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens)) + 2
    same[kind == LINK], same[(kind == NUMBER) | (kind == TIME)] = 0, 1
    # How often each pair of neighbours occurs in its text.
    inner = of[1:] == of[:-1]
    pair = (of[:-1] * (len(known) + 2) + same[:-1])[inner]
    _, pair = np.unique(pair, return_inverse=True)
    _, at, times = np.unique(pair * (len(known) + 2) + same[1:][inner], return_inverse=True, return_counts=True)
    many = np.zeros(len(tokens) + 1)
    many[1:-1][inner] = np.log2(times[at])
    repeated = np.maximum(many[1:], many[:-1]) / np.maximum(1.0, np.log2(n))[of]
    # A short rest belongs to the last window.
    place = np.arange(len(tokens)) - start[of]
    last = np.maximum(0, (n - window // 2) // window)
    number = np.minimum(place // window, last[of])
    first = np.flatnonzero(np.append(True, (number[1:] != number[:-1]) | ~inner))
    length = np.diff(np.append(first, len(tokens)))
    total = lambda x: np.add.reduceat(x, first)
    which = np.repeat(np.arange(len(first)), length)
    _, at, times = np.unique(which * (len(known) + 2) + same, return_inverse=True, return_counts=True)
    # The sum over tokens of -log(share) / length is that over kinds of -share * log(share).
    spread = total(-np.log2(times[at] / length[which])) / length
    entropy = np.where(length > 1, spread / np.log2(np.maximum(length, 2)), 1.0)
    size = total(chars)
    x = np.column_stack([total(is_function.astype(float)) / length, total((kind == NUMBER).astype(float)) / length, total(np.where(kind == LINK, chars, 0)) / np.maximum(size, 1), total(repeated) / length, entropy])
    return of[first], [langs[i] for i in of[first].tolist()], size, x


def window_features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, language, chars and the features of every window; NULL texts and texts without words have no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, 1):
            at, langs, chars, x = windows([t or "" for t in batch.column(1).to_pylist()])
            keys = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(langs, pa.string()), pa.array(chars, pa.int64()), *[pa.array(x[:, k].astype(np.float32)) for k in range(x.shape[1])]],
                ["doc_key", "language", "chars", *FEATURES],
            )

    schema = f"doc_key {docs.schema[key].dataType.simpleString()}, language string, chars bigint, " + ", ".join(f"{f} float" for f in FEATURES)
    return docs.select(key, text).mapInArrow(run, schema)


def _moments(x: DataFrame, weight: Column) -> dict[str, tuple[float, np.ndarray, np.ndarray]]:
    """Number, mean and covariance of the features by language, of the windows for which weight holds."""
    p = len(FEATURES)
    kept = x.where(weight)
    sums = [F.sum(F.col(f).cast("double")).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    crosses = [F.sum(F.col(FEATURES[i]).cast("double") * F.col(FEATURES[j])).alias(f"c{i}_{j}") for i in range(p) for j in range(i, p)]
    out = {}
    for r in kept.groupBy("language").agg(F.count("*").alias("n"), *sums, *crosses).collect():
        n = r["n"]
        mean = np.array([r[f"s{i}"] for i in range(p)]) / n
        cov = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)]) / n - np.outer(mean, mean)
        out[r["language"]] = (n, mean, cov)
    return out


def _with_distance(x: DataFrame, scatter: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """x with the squared distance and the spam-directed sum; there is a row of numbers for each of few languages."""
    p = len(FEATURES)
    rows = []
    for lang, (mean, cov) in scatter.items():
        rows.append((lang, *map(float, mean), *map(float, np.linalg.inv(cov).ravel()), *map(float, np.sqrt(np.diag(cov)))))
    names = ["l_language", *[f"m{i}" for i in range(p)], *[f"q{i}_{j}" for i in range(p) for j in range(p)], *[f"d{i}" for i in range(p)]]
    table = x.sparkSession.createDataFrame(rows, ", ".join([f"{names[0]} string", *[f"{c} double" for c in names[1:]]]))
    off = [F.col(f).cast("double") - F.col(f"m{i}") for i, f in enumerate(FEATURES)]
    distance = sum((off[i] * off[j] * F.col(f"q{i}_{j}") for i in range(p) for j in range(p)), F.lit(0.0))
    along = sum((TOWARDS[i] * off[i] / F.col(f"d{i}") for i in range(p)), F.lit(0.0))
    # The table has one row per language of a fixed list.
    return x.join(F.broadcast(table), F.col("language") == F.col("l_language")).select(*x.columns, distance.alias("distance"), along.alias("along"))


def robust_scatter(x: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Centre and scatter by language, from all windows: medians first, then rounds over the nearest windows."""
    p = len(FEATURES)
    mids = x.groupBy("language").agg(*[F.percentile_approx(f, [0.25, 0.5, 0.75], 1000).alias(f) for f in FEATURES]).collect()
    floor = np.array(FLOOR)
    scatter = {}
    for r in mids:
        q = np.array([r[f] for f in FEATURES])
        spread = np.maximum((q[:, 2] - q[:, 0]) / 1.349, floor)
        scatter[r["language"]] = (q[:, 1], np.diag(spread**2))
    for _ in range(ROUNDS if scatter else 0):
        near = _with_distance(x, scatter)
        limits = {r["language"]: r["q"] for r in near.groupBy("language").agg(F.percentile_approx("distance", KEPT, 1000).alias("q")).collect()}
        cut = F.create_map(*[F.lit(v) for kv in limits.items() for v in kv])
        found = _moments(near, F.col("distance") <= cut[F.col("language")])
        total = sum(n for n, _, _ in found.values())
        pooled, centre = sum(n * c for n, _, c in found.values()) / total, sum(n * m for n, m, _ in found.values()) / total
        for lang, (n, mean, cov) in found.items():
            own = (n * cov + SHRINK * pooled) / (n + SHRINK)
            mean = (n * mean + SHRINK * centre) / (n + SHRINK)
            # The nearest KEPT of a normal sample have less spread than the whole: for 5 features and 3/4, by about 1.9.
            scatter[lang] = (mean, 1.9 * own + np.diag(floor**2))
    assert all(c.shape == (p, p) for _, c in scatter.values())
    return scatter


def scored_windows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    x = stage(window_features(docs, key, text))
    return _with_distance(x, robust_scatter(x)).withColumnRenamed("doc_key", key)


def spam_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and spam_share of the documents of which more than half is spam.

    Texts are taken whole, in windows; a text shorter than a window is one window. NULL and empty texts and those
    without any word are never spam. Equal rows of one key count as one text of their joint windows. An empty
    table gives an empty one.
    """
    scored = scored_windows(docs, key, text)
    bad = (F.col("distance") > LIMIT) & (F.col("along") > 0)
    share = F.sum(F.when(bad, F.col("chars")).otherwise(0)) / F.sum("chars")
    return scored.groupBy(key).agg(share.alias("spam_share")).where("spam_share > 0.5")
