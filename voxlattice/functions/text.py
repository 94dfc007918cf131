"""Text normalisers, splitters and label parsers as Column expressions.

Java's \\s, \\w and case rules are made Unicode-aware with (?U) and (?iu) where the meaning needs it. NULL gives NULL
unless said otherwise.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

# The combining accents that serve as stress marks, and the mark of segments left out.
STRESS = "\u0300\u0301\u0302\u0303\u0304"
SKIPPED = "РАСПИСАНО"
CONTINUED = "продолж"
CODE = r"[0-9]{2}:[0-9]{2}:[0-9]{2}[.,][0-9]{3}"


def strip(text: Column) -> Column:
    """Without Unicode blanks at the ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def squeeze(text: Column) -> Column:
    """Runs of blanks as one space, none at the ends."""
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def drop_brackets(text: Column, to: str = " ") -> Column:
    return F.regexp_replace(text, r"\[[^\]]*\]", to)


def norm_reorder(text: Column) -> Column:
    """N-1: for comparing descriptions. Bracketed spans, backslashes and time codes go, ASCII punctuation becomes blank; NULL gives ''."""
    s = F.regexp_replace(drop_brackets(F.coalesce(text, F.lit(""))), r"\\", "")
    s = F.regexp_replace(s, r"[0-9]{2}:[0-9]{2}:[0-9]{2}[,.][0-9]{3}", " ")
    return F.lower(squeeze(F.regexp_replace(s, r"[!-/:-@\[-`{-~]", " ")))


def norm_header(text: Column) -> Column:
    """N-2 for recognised sentences: without the header of a block; case and leading blanks stay."""
    return F.regexp_replace(text, rf"[0-9]+\s*\n{CODE} --> {CODE}\s*\n(?:\[SPEAKER_[0-9]+\]:)?", "")


def norm_marks(text: Column) -> Column:
    """N-2 for transcripts: without bracketed spans, ellipses and backslashes; case stays."""
    return F.regexp_replace(drop_brackets(text, ""), r"…|\\", "")


def norm_match(text: Column, srt: bool = False) -> Column:
    """N-3: lower case, a set of punctuation as blanks; with srt, bracketed spans go too."""
    s = F.regexp_replace(text, r"\\", "")
    if srt:
        s = drop_brackets(s, "")
    return F.lower(squeeze(F.regexp_replace(s, r'[.,!?;:—"()…]', " ")))


@F.pandas_udf(StringType())
def _without_marks(s: pd.Series) -> pd.Series:
    plain = lambda x: "".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c) != "Mn")
    return s.map(plain, na_action="ignore")


def norm_tokens(text: Column) -> Column:
    """N-4: ё as е, no combining marks (so й is и), lower case, punctuation but hyphens as blanks.

    The compatibility with letters beyond Cyrillic needs decomposition, which is done in Arrow batches.
    """
    s = F.lower(_without_marks(F.translate(F.regexp_replace(text, r"\\", ""), "ёЁ", "еЕ")))
    return squeeze(F.regexp_replace(s, "[.,!?…—–:;()\\[\\]\"'«»]", " "))


def drop_stress(text: Column) -> Column:
    return F.regexp_replace(text, rf"[\\{STRESS}]", "")


def norm_edit(text: Column) -> Column:
    """N-5: lower case without stress marks and underscores; runs of punctuation and dashes as blanks, ellipses stay."""
    s = F.regexp_replace(F.lower(drop_stress(text)), "_", "")
    return squeeze(F.regexp_replace(s, r"[.,!?;:—–-]+", " "))


def clean_for_matching(text: Column) -> Column:
    """N-6: without stress marks and underscores, blanks squeezed; case and punctuation stay."""
    return squeeze(F.regexp_replace(drop_stress(text), "_", ""))


def clean_without_notes(text: Column) -> Column:
    """The clean form of matched texts (a definition of our own): N-6 without bracketed notes."""
    return clean_for_matching(drop_brackets(text))


def split_sentences(text: Column) -> Column:
    """T-05 and T-06: at blanks after . ! ? and, for T-05's approximation, ellipses; marks stay, empties go."""
    return F.filter(F.split(text, r"(?<=[.!?…])(?U)\s+"), lambda x: x != "")


def split_marks(text: Column) -> Column:
    """T-06: at blanks after . ! ?; the marks stay with their sentence."""
    return F.split(text, r"(?<=[.!?])(?U)\s+")


def bracket_parts(text: Column) -> Column:
    """T-09: parts inside and outside of square brackets, in order, as (text, is_dialect); notes of the collector go."""
    marked = F.regexp_replace(text, r"(\[[^\n]*?\])", "\u0001$1\u0001")
    parts = F.transform(F.split(marked, "\u0001"), strip)
    typed = F.transform(
        F.filter(parts, lambda x: x != ""),
        lambda x: F.when(x.rlike(r"(?s)^\[.*\]$"), F.struct(strip(F.substring(x, 2, F.length(x) - 2)).alias("text"), F.lit(False).alias("is_dialect"))).otherwise(F.struct(x.alias("text"), F.lit(True).alias("is_dialect"))),
    )
    note = lambda x: ~x["is_dialect"] & ((x["text"] == "") | x["text"].startswith("…") | x["text"].startswith("Соб."))
    return F.filter(typed, lambda x: ~note(x))


_LABEL = r"^\[([A-Za-zА-Яа-яЁё.?]{1,8})\s?:"


def prepared_segments(text: Column) -> Column:
    """T-10: bracketed spans and sentences in order, a bare label joined to the utterance after it, as (orig, norm)."""
    marked = F.regexp_replace(text, r"(\[[^\]]+\])", "\u0001$1\u0001")
    parts = F.flatten(F.transform(F.split(marked, "\u0001"), lambda x: F.when(x.rlike(r"^\[[^\]]+\]$"), F.array(x)).otherwise(split_marks(x))))
    clean = F.filter(F.transform(parts, strip), lambda x: x != "")
    bare = lambda x: x.rlike(r"^\[[^\]]+\]$")
    follows = lambda i: F.when(i < F.size(clean), F.element_at(clean, (i + 1).cast("int")))
    at = F.when(F.size(clean) > 0, F.sequence(F.lit(1), F.size(clean))).otherwise(F.array().cast("array<int>"))
    label = lambda x: x.rlike(r"^\[[A-Za-zА-Яа-яЁё.?]{1,8}\s?:\s*\]$")
    this = lambda i: F.element_at(clean, i.cast("int"))
    takes = lambda i: label(this(i)) & follows(i).isNotNull() & ~bare(follows(i))
    kept = F.filter(at, lambda i: (i == 1) | ~F.coalesce(takes(F.greatest(i - 1, F.lit(1))), F.lit(False)))
    joined = F.transform(kept, lambda i: F.when(F.coalesce(takes(i), F.lit(False)), F.concat(this(i), F.lit(" "), follows(i))).otherwise(this(i)))
    return F.transform(joined, lambda x: F.struct(x.alias("orig"), norm_match(F.when(bare(x), drop_brackets(x, "")).otherwise(x)).alias("norm")))


def label_of(text: Column) -> Column:
    """T-11: the speaker label at the head of a bracket, with its colon, or NULL."""
    found = F.regexp_extract(strip(text), _LABEL, 1)
    return F.when(found != "", F.concat(found, F.lit(":")))


def without_label(text: Column) -> Column:
    """T-11: the rest of the bracket and what follows it; one pair of outer brackets goes where there's no label."""
    s = strip(text)
    labelled = F.regexp_replace(s, r"(?s)^\[[A-Za-zА-Яа-яЁё.?]{1,8}\s?:\s*([^\]]*)\]\s*(.*)$", "$1 $2")
    return squeeze(F.when(label_of(s).isNotNull(), labelled).otherwise(F.regexp_replace(s, r"(?s)^\[(.*)\]$", "$1")))


def words(text: Column) -> Column:
    """Parts between Unicode blanks."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda x: x != "")


def pack(text: str, longest: int = 30, shortest: int = 5) -> list[str]:
    """T-07 of one text: parts between runs of . ! ? packed into segments of up to `longest` words; one of fewer than
    `shortest` takes in the next. Marks are lost, ellipses don't split."""
    done: list[str] = []
    now, n = [], 0
    for part in re.split(r"[.!?]+", text):
        part = part.strip()
        if not part:
            continue
        size = len(part.split())
        if now and (n + size > longest or n >= shortest):
            done.append(" ".join(now))
            now, n = [], 0
        now.append(part)
        n += size
    return done + ([" ".join(now)] if now else [])


def clean(text: str) -> str:
    """N-6 of one text."""
    return " ".join(re.sub(rf"[\\_{STRESS}]", "", text).split())


def join_short(segments: list[str], shortest: int = 3) -> list[tuple[str, str]]:
    """T-08: (orig, clean) of the segments; one with fewer words than `shortest` takes in the next, one step only."""
    out: list[tuple[str, str]] = []
    held: tuple[str, str] | None = None
    for orig in segments:
        pair = (orig, clean(orig))
        if not pair[1]:
            continue
        if held:
            out.append((f"{held[0]} {pair[0]}", f"{held[1]} {pair[1]}"))
            held = None
        elif len(pair[1].split()) < shortest:
            held = pair
        else:
            out.append(pair)
    return out + ([held] if held else [])


def token_norm(word: str) -> str:
    """N-4 of one token; brackets around it go."""
    if word.startswith("[") and word.endswith("]"):
        word = word[1:-1]
    plain = unicodedata.normalize("NFD", word.replace("\\", "").translate({0x451: 0x435, 0x401: 0x415}))
    plain = "".join(c for c in plain if unicodedata.category(c) != "Mn").lower()
    return " ".join(re.sub("[.,!?…—–:;()\\[\\]\"'«»]", " ", plain).split())


def tokens(text: str) -> list[tuple[str, str, int, int]]:
    """T-13: (text, norm, start, end) of the parts between blanks, with offsets [start, end) in code points."""
    return [(m.group(), token_norm(m.group()), m.start(), m.end()) for m in re.finditer(r"\S+", text)]


@F.pandas_udf(ArrayType(StringType()))
def packed_sentences(text: pd.Series) -> pd.Series:
    """T-07."""
    return text.map(pack, na_action="ignore")


@F.pandas_udf(ArrayType(StructType([StructField("orig", StringType()), StructField("clean", StringType())])))
def joined_short(segments: pd.Series) -> pd.Series:
    """T-08 of arrays of segments."""
    return segments.map(lambda xs: [{"orig": o, "clean": c} for o, c in join_short(list(xs))], na_action="ignore")


@F.pandas_udf(ArrayType(StructType([StructField("text", StringType()), StructField("norm", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])))
def tokens_with_offsets(text: pd.Series) -> pd.Series:
    """T-13: words with normal form and [start, end) offsets in code points; brackets around one word go from its norm."""
    return text.map(lambda x: [{"text": t, "norm": n, "start": a, "end": z} for t, n, a, z in tokens(x)], na_action="ignore")


def time_code(line: Column) -> Column:
    """T-01: the 12-character code at the head of a line, with a dot, or NULL. The character after it may be nearly any."""
    s = strip(line)
    return F.when(starts_with_code(s), F.regexp_replace(F.regexp_extract(s, r"^[0-9:.,]{12}", 0), ",", "."))


def starts_with_code(line: Column) -> Column:
    """F-01: twelve digits or separators and one character from the blank to the en dash."""
    return strip(line).rlike(r"^[0-9:.,]{12}[ -–]")


def is_transcribed(line: Column) -> Column:
    """F-02: the mark of segments left out isn't there (upper case)."""
    return ~line.contains(SKIPPED)


def continuation_code(line: Column) -> Column:
    """F-03, T-02: the code a line ends with, after marks are taken off its end, if it says that it goes on elsewhere."""
    s = F.regexp_replace(strip(line), r"(?U)[^\d\w]+$", "")
    code = F.regexp_extract(s, r"([0-9:.,]{12})$", 1)
    return F.when((code != "") & s.rlike(f"(?iu){CONTINUED}"), F.regexp_replace(code, ",", "."))


def tolerant_bool(text: Column) -> Column:
    """F-05: true, 1, yes, y and other numbers than 0 are true; anything else, NULL too, is false."""
    s = F.lower(F.trim(text.cast("string")))
    number = s.try_cast("int")
    return F.coalesce(F.when(s.isin("true", "1", "yes", "y"), True).when(s.isin("false", "0", "no", "n", ""), False).otherwise(number != 0), F.lit(False))


def swap_suffix(name: Column, suffix: str) -> Column:
    """T-18: the last suffix replaced by another."""
    return F.regexp_replace(name, r"\.[^.]*$", suffix)


def shown(text: Column, n: int = 60) -> Column:
    """T-19: what messages show of a text."""
    return F.left(text, F.lit(n))


def is_named(text: Column) -> Column:
    """F-06: a name or transcript that isn't empty."""
    return F.length(strip(F.coalesce(text, F.lit("")))) > 0


def safe_time(code: Column) -> Column:
    """T-16: a code that can stand in a file name."""
    return F.translate(code, ":.", "--")


def utterance_name(index: Column, speaker: Column, code: Column) -> Column:
    """T-17."""
    return F.format_string("%03d_%s_%s", index, speaker, safe_time(code))
