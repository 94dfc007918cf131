"""Problem 5: clean speaker turns from transcripts with noise.

Each line is read once, in Arrow batches: its label is taken off and named, and its tokens are classified until one is
found that is speech. Labels are carried forward, lines without speech are left out, and gradient-boosted trees decide
between neighbouring speech lines whether a turn ends; only where they are undecided are the two speakers compared.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlattice.functions.timecode import code_ms
from voxlattice.llm.boosting import Boosted
from voxlattice.operators.latest import latest
from voxlattice.runtime import broadcast_if_small, drop_stage, stage

#: Lines of a clip that one task scans.
BLOCK = 4096
#: About how many pairs of neighbouring lines the trees are fitted on at most.
TRAINING_ROWS = 20_000
#: Log odds below which a decision of the trees counts as none, so that the speakers are compared.
SURE = 1.0
#: Different words, tags and lists of codes that a worker remembers.
REMEMBERED = 200_000
KEYS = ["origin", "recording_id", "seg_no"]
FEATURES = ["own_label", "label_changed", "carried_changed", "line_gap", "time_gap", "asked", "asks", "words"]
#: The cases that the naming of speakers settles, as observations beside the sample, so that trees of any sample know
#: them: own_label, label_changed, carried_changed, and whether a turn ends. Each counts SETTLED_TIMES.
SETTLED = [(0, 0, 0, 0), (0, 0, 1, 1), (1, 0, 0, 0), (1, 0, 1, 0), (1, 1, 0, 1), (1, 1, 1, 1)]
SETTLED_TIMES = 16

# Latin letters and the Cyrillic ones that look like them.
_LATIN, _CYRILLIC = "ABCEHKMOPTXYaceopxyk", "АВСЕНКМОРТХУасеорхук"
_TO_CYRILLIC = str.maketrans(_LATIN, _CYRILLIC)
# Characters that can't be seen, marks of stress and how they are written.
_UNSEEN = "\u0300\u0301\u034F\u00AD\u0600-\u0605\u061C\u06DD\u070F\u180E\u200B-\u200F\u202A-\u202E\u2060-\u2064\u2066-\u206F\uFEFF\uFFF9-\uFFFB"
_DROP = re.compile(rf"[\\_{_UNSEEN}]")
#: Lines of plain Cyrillic hold none of these.
_ODD = re.compile(rf"[A-Za-z\\_\u0302-\u034E\u0350-\u036F{_UNSEEN}]")
_LETTER = r"[^\W\d_]"
_TIME = r"(?:[0-9]{1,2}:)?[0-9]{1,2}:[0-9]{2}(?:[.,][0-9]{1,3})?"
_STAMP = rf"[\[<({{]?\s*{_TIME}(?:\s*-->\s*{_TIME})?\s*[\])>}}]?"
_LEAD = rf"(?>\s|[\[(<{{*](?!\s*{_TIME})|{_STAMP})*+"
# Signs that set off a note.
_PAIRS = ("[]", "()", "{}", "<>", "**", "♪♪", "~~", "##", "//", "||", "==", "«»", "“”")
_SIGNS = "".join(re.escape(c) for c in sorted(set("".join(_PAIRS))))
_SIGN = re.compile(f"[{_SIGNS}]")
#: 'speaker', 'spk' and their Russian form as they stand after plain().
_NAMED = ("sреакеr", "sрк", "спикер")
_SRT_LABEL = re.compile(rf"{_LEAD}(?:{'|'.join(_NAMED)})[\s-]*([0-9]{{1,3}})\s*(?:\*\*|[\])>}}])?\s*[:.—–]?\s*")
_CODE_LABEL = re.compile(rf"{_LEAD}((?:{_LETTER}\.\s?){{2,8}}|{_LETTER}{{1,8}}(?=\s*[:.—–\])>*]|\s+-\s))\s*(?:\*\*|[\])>])?\s*(?:[:.—–]|-(?=\s))?\s*(?:\*\*|[\])>])?\s*")
_STAMPS = re.compile(_STAMP)
_NUMBER = re.compile("[0-9]{1,9}")
_WIDE = str.maketrans("０１２３４５６７８９", "0123456789")
#: Words of three letters or more that no hyphen joins to another.
_WORD = re.compile(rf"(?<![^\W\d_‐‑–])(?<![‐‑–-]){_LETTER}{{3,}}+(?![‐‑–-])")
_JOINED = re.compile(rf"(?<={_LETTER})[-‐‑–](?={_LETTER})")
_BETWEEN = re.compile(r"[\W_]+")


def plain(text: str) -> str:
    """Lower case in one script, without stress marks, formats and markup of stress."""
    if not _ODD.search(text):
        return text.lower()
    return unicodedata.normalize("NFC", _DROP.sub("", text).translate(_TO_CYRILLIC)).lower()


def drawn_out(term: str) -> str:
    """Pattern of a filler, with letters drawn out and said several times over."""
    runs = ["".join(g) for _, g in groupby(term)]
    one = "".join(r if r == " " else f"{re.escape(r[0])}{{{len(r)},}}" for r in runs)
    return one if " " in term else f"(?:{one})+"


class Noise:
    """Classifies the tokens of a line: speech, or filler, sound note and time stamp."""

    def __init__(self, fillers: list[str], sounds: list[str]):
        longest_first = lambda terms: sorted({t.lower().replace("ё", "е") for t in terms}, key=lambda t: (-len(t), t))
        fillers, sounds = longest_first(fillers), longest_first(sounds)
        one = "|".join(map(drawn_out, fillers)) or "(?!)"
        self.all_fillers = re.compile(f"(?:(?:{one})(?: (?:{one}))*)?")
        self.in_filler = re.compile("|".join(sorted({drawn_out(w) for f in fillers for w in f.split()})) or "(?!)")
        self.notes = None
        if sounds:
            term, word, gap = f"(?:{'|'.join(map(re.escape, sounds))})", r"[^\W_]+", rf"(?:(?![{_SIGNS}?])[\W_])"
            note = rf"{gap}*(?:{term}(?:{gap}+{word}){{0,2}}|{word}{gap}+{term}(?:{gap}+{word})?|{word}{gap}+{word}{gap}+{term}){gap}*"
            self.notes = re.compile("|".join(f"{re.escape(a)}{note}{re.escape(b)}" for a, b in _PAIRS))
        self.known: dict[str, bool] = {}

    def is_speech(self, word: str) -> bool:
        """Whether a word can be no part of a filler."""
        if word not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = self.in_filler.fullmatch(word.replace("ё", "е")) is None
        return self.known[word]

    def surely_speech(self, text: str) -> bool:
        """Whether a word that is no part of a filler stands before the first or after the last sign that sets passages off.

        Such a word stays whatever notes are taken out, so the text holds speech. Words beside a hyphen are left to
        silent(), which joins them first.
        """
        sign = _SIGN.search(text)
        if sign is None:
            return any(map(self.is_speech, _WORD.findall(text)))
        last = max(text.rfind(c) for c in set("".join(_PAIRS)))
        return any(map(self.is_speech, _WORD.findall(text, 0, sign.start()))) or any(map(self.is_speech, _WORD.findall(text, last + 1)))

    def silent(self, text: str) -> bool:
        """Whether a plain() text without label holds nothing but time stamps, fillers and sound notes.

        Innermost passages go first, so a note within other brackets is found; a passage with a question mark is
        speech. Punctuation alone is no speech. Terms are compared in lower case, ё as е.
        """
        s = _STAMPS.sub(" ", " ".join(text.replace("ё", "е").split()))
        if self.notes:
            s = self.notes.sub(" ", s)
        # Words joined by hyphens count as one, so that drawn-out and doubled fillers stay together.
        s = _BETWEEN.sub(" ", _JOINED.sub("", s)).strip()
        return self.all_fillers.fullmatch(s) is not None

    def has_speech(self, text: str) -> bool:
        return self.surely_speech(text) or not self.silent(text)


def read_srt_line(tag: str | None, text: str | None, noise: Noise) -> tuple[str | None, bool, bool, int]:
    """Label, speech, whether it asks, and about how many words, of a recognised block. The tag's number names the
    speaker, else the one at the head of the text."""
    said = plain(text or "")
    number, body = _NUMBER.search((tag or "").translate(_WIDE)), said
    if any(n in said for n in _NAMED) and (head := _SRT_LABEL.match(said)):
        number, body = number or _NUMBER.search(head[1]), said[head.end() :]
    label = f"SPEAKER_{int(number[0]):02d}" if number else None
    return label, noise.has_speech(body), "?" in body, len(body) // 6


def read_manual_line(codes: dict[str, str], text: str | None, noise: Noise) -> tuple[str | None, bool, bool, int]:
    """The same of a hand-made line. codes: plain form of each code of the recording -> the code."""
    body, label = plain(text or ""), None
    if head := _CODE_LABEL.match(body):
        label = codes.get(re.sub(r"[.\s]", "", head[1]))
        body = body[head.end() :] if label else body
    return label, noise.has_speech(body), "?" in body, len(body) // 6


def _read(df: DataFrame, read: Callable[[Noise, str | None, str | None], tuple], fillers: list[str], sounds: list[str]) -> DataFrame:
    """df's last two columns, a hint of the speaker and the text, replaced by what read() makes of them."""
    kept = df.columns[:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        noise = Noise(fillers, sounds)
        for batch in batches:
            rows = [read(noise, hint, text) for hint, text in zip(batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist())]
            label, speech, asks, words = zip(*rows) if rows else ((), (), (), ())
            made = [pa.array(label, pa.string()), pa.array(speech, pa.bool_()), pa.array(asks, pa.bool_()), pa.array(words, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *made], [*kept, "label", "speech", "asks", "words"])

    schema = df.select(*kept).schema.add("label", "string").add("speech", "boolean").add("asks", "boolean").add("words", "integer")
    return df.mapInArrow(run, schema)


def srt_lines(srt: DataFrame, fillers: list[str], sounds: list[str]) -> DataFrame:
    """Lines of recognised blocks, every version of them (see turns())."""
    rows = srt.select(
        F.lit("srt").alias("origin"), "recording_id", F.col("seg_file_no").alias("seg_no"), F.col("srt_index").alias("pos"), "loaded_at",
        code_ms(F.col("start_code")).alias("start_ms"), code_ms(F.col("end_code")).alias("end_ms"), "speaker_tag", "text",
    )
    return _read(rows, lambda noise, tag, text: read_srt_line(tag, text, noise), fillers, sounds)


def manual_lines(manual: DataFrame, catalog: DataFrame, fillers: list[str], sounds: list[str]) -> DataFrame:
    """Lines of hand-made transcripts, every version. A label is a code of the recording, however it is spelt and set off."""
    codes = broadcast_if_small(catalog.select(F.col("recording_id").alias("c_rec"), "speaker_codes"))
    rows = manual.join(codes, F.col("recording_id") == F.col("c_rec"), "left").select(
        F.lit("manual").alias("origin"), "recording_id", "seg_no", "pos", "loaded_at", F.lit(None).cast("bigint").alias("start_ms"), F.lit(None).cast("bigint").alias("end_ms"), "speaker_codes", "text"
    )
    known: dict[str, dict[str, str]] = {}

    def read(noise: Noise, codes: str | None, text: str | None) -> tuple:
        codes = codes or ""
        if codes not in known:
            if len(known) >= REMEMBERED:
                known.clear()
            known[codes] = {plain(c.strip()): c.strip() for c in reversed(codes.split(",")) if c.strip()}
        return read_manual_line(known[codes], text, noise)

    return _read(rows, read, fillers, sounds)


def _scanned(lines: DataFrame) -> DataFrame:
    """Speech lines, and the last line of each block, with the label in force and the speech line before, both within the block."""
    within = Window.partitionBy(*KEYS, "block").orderBy("pos")
    prior = within.rowsBetween(Window.unboundedPreceding, -1)
    known = lines.where("recording_id IS NOT NULL AND seg_no IS NOT NULL AND pos IS NOT NULL")
    df = known.withColumn("block", F.floor(F.col("pos") / BLOCK)).repartition(*KEYS, "block")
    df = df.withColumn("held", F.last("label", True).over(prior)).withColumn("own", F.coalesce("label", "held"))
    this = F.when(F.col("speech"), F.struct("pos", "end_ms", "asks", "own"))
    df = df.withColumn("before", F.last(this, True).over(prior)).withColumn("ends", F.lead("pos").over(within).isNull())
    return df.where("speech OR ends")


def _carried(scanned: DataFrame) -> DataFrame:
    """For each block the label in force and the speech line before it, from all blocks of its clip that come earlier."""
    this = F.struct("pos", "end_ms", "asks", "own")
    out = scanned.where("ends").select(*[F.col(k).alias(f"c_{k}") for k in [*KEYS, "block"]], F.col("own").alias("label_out"), F.when(F.col("speech"), this).otherwise(F.col("before")).alias("line_out"))
    earlier = Window.partitionBy(*[f"c_{k}" for k in KEYS]).orderBy("c_block").rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("label_in", F.last("label_out", True).over(earlier))
    line = F.when(F.col("line_out").isNotNull(), F.col("line_out").withField("own", F.coalesce("line_out.own", "label_in")))
    return out.withColumn("line_in", F.last(line, True).over(earlier)).drop("label_out", "line_out")


def _pairs(said: DataFrame, carried: DataFrame) -> DataFrame:
    """Speech lines with their speaker, that of the speech line before them, and the features of the pair."""
    met = said.join(carried, [F.col(k) == F.col(f"c_{k}") for k in [*KEYS, "block"]])
    last = F.when(F.col("before").isNotNull(), F.col("before").withField("own", F.coalesce("before.own", "label_in"))).otherwise(F.col("line_in"))
    named = met.select(*KEYS, "block", "pos", "label", "start_ms", "asks", "words", F.coalesce("own", "label_in").alias("speaker"), F.coalesce("held", "label_in").alias("carried"), last.alias("last"))
    differs = lambda a, b: F.coalesce((F.col(a) != F.col(b)).cast("int"), F.lit(0))
    return named.where("speaker IS NOT NULL").select(
        *KEYS, "block", "pos", "speaker", F.col("last.own").alias("last_speaker"), F.col("label").isNotNull().cast("int").alias("own_label"), differs("label", "last.own").alias("label_changed"), differs("carried", "last.own").alias("carried_changed"),
        (F.col("pos") - F.coalesce("last.pos", "pos")).cast("int").alias("line_gap"), F.coalesce(F.col("start_ms") - F.col("last.end_ms"), F.lit(0)).alias("time_gap"),
        F.coalesce(F.col("last.asks").cast("int"), F.lit(0)).alias("asked"), F.col("asks").cast("int").alias("asks"), "words",
    )


def fit_boundaries(said: DataFrame, carried: DataFrame, rows: int = TRAINING_ROWS) -> Boosted:
    """Trees fitted on about `rows` pairs at most, chosen by a hash of their place, and on the settled cases."""
    share = min(1.0, rows / max(1, said.count()))
    chosen = F.pmod(F.xxhash64(*KEYS, "pos"), F.lit(1_000_000)) < int(share * 1_000_000)
    known = _pairs(said.where(chosen), carried).where("last_speaker IS NOT NULL")
    sample = known.select(*FEATURES, (F.col("speaker") != F.col("last_speaker")).cast("int").alias("y")).toPandas()
    x, y = sample[FEATURES].to_numpy(float).reshape(-1, len(FEATURES)), sample["y"].to_numpy(float)
    usual = np.median(x[:, 3:], axis=0) if len(x) else np.zeros(len(FEATURES) - 3)
    settled = np.repeat(SETTLED, SETTLED_TIMES, axis=0)
    x = np.vstack([x, np.column_stack([settled[:, :3], np.tile(usual, (len(settled), 1))])])
    return Boosted(FEATURES).fit(x, np.append(y, settled[:, 3]))


def turns(lines: DataFrame, rows: int = TRAINING_ROWS, model: Callable[[DataFrame, DataFrame, int], Boosted] = fit_boundaries) -> DataFrame:
    """origin, recording_id, seg_no, speaker, first_pos, last_pos of every turn.

    Of the versions of a line the latest counts. Lines with NULL in recording, clip or position are left out, as are
    speech lines before the first label of their clip, which have no speaker. NULL and empty texts are lines without
    speech. Clips of any length are scanned in blocks; an empty table gives an empty one. model() gives the trees.
    """
    scanned = stage(_scanned(latest(lines, [*KEYS, "pos"], ["label", "speech", "asks", "words", "start_ms", "end_ms"])))
    said, carried = scanned.where("speech"), _carried(scanned)
    score = model(said, carried, rows).column()
    differ = F.col("speaker") != F.col("last_speaker")
    ends: Column = F.when(F.abs(score) >= SURE, score > 0).otherwise(differ)
    first = F.when(F.col("last_speaker").isNull(), True).otherwise(ends)
    up_to = Window.partitionBy(*KEYS, "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    counted = _pairs(said, carried).withColumn("turn", F.sum(first.cast("int")).over(up_to))
    pieces = counted.groupBy(*KEYS, "block", "turn").agg(F.min_by("speaker", "pos").alias("speaker"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))
    # A turn may reach over blocks: what stands before a block's first boundary goes on with the block before.
    pieces = stage(pieces.withColumn("edge", (F.col("turn") == 0) | (F.col("turn") == F.max("turn").over(Window.partitionBy(*KEYS, "block")))))
    drop_stage(scanned)
    along = Window.partitionBy(*KEYS).orderBy("block", "turn").rowsBetween(Window.unboundedPreceding, 0)
    edges = pieces.where("edge").withColumn("whole", F.sum((F.col("turn") > 0).cast("int")).over(along))
    joined = edges.groupBy(*KEYS, "whole").agg(F.min_by("speaker", "first_pos").alias("speaker"), F.min("first_pos").alias("first_pos"), F.max("last_pos").alias("last_pos")).drop("whole")
    return pieces.where("NOT edge").drop("block", "turn", "edge").unionByName(joined)


def noise_terms(terms: DataFrame, most: int = 2000) -> tuple[list[str], list[str]]:
    """Filler and sound terms; the list is a fixed one and is refused beyond `most` entries."""
    rows = terms.select("term", "kind").where("term IS NOT NULL AND trim(term) <> ''").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} noise terms")
    return [r.term.strip() for r in rows if r.kind == "filler"], [r.term.strip() for r in rows if r.kind == "sound"]
