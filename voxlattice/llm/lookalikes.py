"""Problem 6: one form for text that looks the same.

Words are the segments, with blanks as their boundaries, so marks keep their base letters. The quick check lets pass
those in a normal form (by Unicode's quick-check property) that are in the plain letters of one script; only the others
are normalised, each as a whole, and spliced back into the unchanged text.

The form keeps what can be seen (letter case, accents, spelling) and drops what can't: formats and ignorable
characters, widths, positional and compatibility forms of one picture, kinds of blanks, ligatures, composition, and the
script of letters of one shape. A word is written in the script whose letters in daily use can show most of it, and in
the home script where several can, so words that look the same always end up the same.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Letters of one shape, in the order Latin, Cyrillic, Greek, Armenian; a hyphen where a script has none.
SHAPES = """
a а α -
c с ϲ -
d ԁ - -
e е - -
h һ - հ
i і ι -
j ј ϳ -
ĸ к κ -
l ӏ - -
n - - ո
o о ο օ
p р ρ -
q ԛ - զ
s ѕ - -
u - υ ս
v ѵ ν -
w ԝ - -
x х χ -
y у γ -
A А Α -
B В Β -
C С Ϲ -
E Е Ε -
G Ԍ - -
H Н Η -
I І Ι -
J Ј Ϳ -
K К Κ -
M М Μ -
N - Ν -
O О Ο Օ
P Р Ρ -
Q Ԛ - -
S Ѕ - Տ
T Т Τ -
U - - Ս
V Ѵ - -
W Ԝ - -
X Х Χ -
Y У Υ -
Z - Ζ -
- Г Γ -
- П Π -
- Ф Φ -
ᴛ т τ -
ʙ в - -
ʜ н - -
ᴍ м - -
ᴦ г - -
ᴨ п - -
"""
# Single characters that are drawn as one of the above, after Unicode's list of confusable characters
# (UTS #39); of that list only those that can't be told apart.
SAME_AS = {
    "ɑ": "a", "ᴏ": "o", "ᴋ": "к", "ү": "у", "Ү": "У", "Ӏ": "І", "Ϻ": "М", "ﬅ": "st", "‐": "-", "‒": "–", "―": "—", "ꙇ": "i", "ⅼ": "l",
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭵ": "i", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮐ": "G", "Ꮓ": "Z", "Ꮪ": "S", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ꮮ": "L", "Ꮩ": "V", "Ᏼ": "B",
    "ꓮ": "A", "ꓐ": "B", "ꓚ": "C", "ꓓ": "D", "ꓰ": "E", "ꓝ": "F", "ꓖ": "G", "ꓧ": "H", "ꓲ": "I", "ꓙ": "J", "ꓗ": "K", "ꓡ": "L", "ꓟ": "M", "ꓠ": "N", "ꓳ": "O", "ꓑ": "P", "ꓣ": "R", "ꓢ": "S", "ꓔ": "T", "ꓴ": "U", "ꓦ": "V", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓜ": "Z",
}
# Kinds of compatibility decomposition that leave the picture as it is, and ranges of further characters
# of which that holds: the micro sign, digraphs, Roman numerals, radicals and ligatures.
_SAME_PICTURE = ("<wide>", "<narrow>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>")
_ALSO_SAME = ((0xB5, 0xB5), (0x132, 0x133), (0x1C4, 0x1CC), (0x1F1, 0x1F3), (0x2160, 0x217F), (0x2E80, 0x2FD5), (0xFB00, 0xFB04), (0xFB06, 0xFB17))
SCRIPTS = ("latn", "cyrl", "grek", "armn")

_ROWS = [r.split() for r in SHAPES.split("\n") if r]
#: script -> character of any script -> the character of the same shape in that script
_TO = {s: {c: r[k] for r in _ROWS if r[k] != "-" for c in r if c != "-"} for k, s in enumerate(SCRIPTS)}
_LATN = "abcdefghijklmnopqrstuvwxyz"
_CYRL = "абвгдежзийклмнопрстуфхцчшщъыьэюяё"
_GREK = "αβγδεζηθικλμνξοπρστυφχψως"
_ARMN = "".join(map(chr, range(0x561, 0x587)))
#: The letters in daily use of each script, in both cases.
_PLAIN = {s: set(a + a.upper()) for s, a in zip(SCRIPTS, (_LATN, _CYRL, _GREK, _ARMN))}
#: What each script writes plainly: its letters, and all letters of the same shape as one of them.
_WRITES = {s: _PLAIN[s] | {c for c, t in _TO[s].items() if t in _PLAIN[s]} for s in SCRIPTS}
_LETTERS = set().union(*_WRITES.values()) | {c for r in _ROWS for c in r} - {"-"}
_IGNORABLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ]")
_BLANK = re.compile("[\t   -   　]")
_WORD = re.compile(r"[^ \n\r]+")
#: Words that can't change, whatever the home script: they hold a letter that no other script writes.
_MARKS = r"""0-9.,!?:;()\[\]«»“”„"'…–—/\\_%№-"""
_OWN = {s: "".join(sorted(_PLAIN[s] - set().union(*(_WRITES[o] for o in SCRIPTS if o != s)))) for s in SCRIPTS}
_CYRL_ONLY, _LATN_ONLY = _OWN["cyrl"], _OWN["latn"]
STABLE_CYRL = rf"[А-Яа-яЁё{_MARKS}]*[{_CYRL_ONLY}][А-Яа-яЁё{_MARKS}]*"
STABLE_LATN = rf"[A-Za-z{_MARKS}]*[{_LATN_ONLY}][A-Za-z{_MARKS}]*"
STABLE_REST = rf"[{_MARKS}]+|[ء-ي٠-٩،؟{_MARKS}]+|[ก-ะา-๎{_MARKS}]+|[ぁ-ゖァ-ヺー一-鿿。、「」，：？！{_MARKS}]+"
_STABLE = re.compile(f"(?:{STABLE_CYRL}|{STABLE_LATN}|{STABLE_REST})")
#: The same check for tokens in Java's syntax, in which $ also matches before a final line break.
STABLE_TOKEN = rf"^(?:{STABLE_CYRL}|{STABLE_LATN}|[{_MARKS}]*)\z"


@lru_cache(maxsize=1 << 16)
def _picture(c: str) -> str:
    """What a character is drawn as: itself, or the characters it stands for in another width, position or ligature."""
    kind = unicodedata.decomposition(c).partition(" ")[0]
    if kind in _SAME_PICTURE or kind == "<compat>" and any(a <= ord(c) <= z for a, z in _ALSO_SAME):
        plain = unicodedata.normalize("NFKC", c)
        # Phrases written as one character don't look like their words.
        c = c if " " in plain else plain
    return "".join(SAME_AS.get(x, x) for x in c)


def _shape(word: str) -> str:
    """The word decomposed, without what can't be seen and in plain widths."""
    return unicodedata.normalize("NFD", "".join(map(_picture, _IGNORABLE.sub("", word))))


def stable(word: str) -> bool:
    """The quick check: whether nothing in a word can change."""
    return unicodedata.is_normalized("NFC", word) and _STABLE.fullmatch(word) is not None


def _script(letters: list[str], home: str) -> str:
    """The first of the home script and the others that writes most of the letters; it depends on their shapes only."""
    return max((home, *SCRIPTS), key=lambda s: sum(1 for c in letters if c in _WRITES[s]))


def canonical_word(word: str, home: str = "cyrl") -> str:
    """The one form of a word."""
    shape = _shape(word)
    to = _TO[_script([c for c in shape if c in _LETTERS], home)]
    # A shape the chosen script lacks is written in the first script that has it.
    mapped = "".join(to.get(c) or next((_TO[s][c] for s in SCRIPTS if c in _TO[s]), c) for c in shape)
    return unicodedata.normalize("NFC", mapped)


def canonical_text(text: str | None, home: str | None = None) -> str | None:
    """The text with every word that isn't stable in its one form and every kind of blank as a space.

    The home script is, unless given, the one that can write most of the text's letters (Cyrillic if several tie).
    NULL stays NULL; an empty text stays empty.
    """
    if text is None:
        return None
    text = _BLANK.sub(" ", text)
    out, kept = [], 0
    for m in _WORD.finditer(text):
        word = m.group()
        if stable(word):
            continue
        if home is None:
            home = _script([c for c in text if c in _LETTERS], "cyrl")
        out += [text[kept : m.start()], canonical_word(word, home)]
        kept = m.end()
    return text if not out else "".join(out) + text[kept:]


def canonical_token(token: str | None) -> str | None:
    """The form by which single words are compared: trimmed, and with one home script for all."""
    if token is None:
        return None
    return canonical_text(_IGNORABLE.sub("", token), "cyrl").strip(" \n\r\x0b\x0c")


def with_canonical(df: DataFrame, column: str, to: str, token: bool = False) -> DataFrame:
    """df with the one form of `column` as `to`; an existing column of that name is replaced.

    With token, values that pass the quick check are kept without leaving the JVM and only the others are sent
    to Python. Every row is treated on its own: nothing is shuffled. NULL gives NULL, empty gives empty.
    """
    df = df.drop(to) if to != column else df
    columns = df.columns
    fix = canonical_token if token else canonical_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(column)
            made = pa.array([fix(x) for x in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*columns, "_canonical"])

    schema = StructType([*df.schema.fields, StructField("_canonical", StringType())])
    if not token:
        return df.mapInArrow(run, schema).withColumnRenamed("_canonical", to)
    stable = F.col(column).isNull() | F.col(column).rlike(STABLE_TOKEN)
    kept = df.where(stable).withColumn("_canonical", F.col(column))
    return kept.unionByName(df.where(~stable).mapInArrow(run, schema)).withColumnRenamed("_canonical", to)


def lookalike_tokens(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(lex_id, token_id) of tokens that look like a lexicon entry without being the same characters.

    The join is on the one form of both; Spark broadcasts the lexicon only if its measured size allows. Several
    lexicon entries of one look each get a row. NULL norms match nothing.
    """
    t = with_canonical(tokens.select("token_id", "norm"), "norm", "form", token=True).where("form IS NOT NULL AND form <> ''")
    x = with_canonical(lexicon.select("lex_id", F.col("norm").alias("lex_norm")), "lex_norm", "lex_form", token=True)
    return t.join(x, F.col("form") == F.col("lex_form")).where("norm <> lex_norm").select("lex_id", "token_id").distinct()
