"""Time codes such as 00:01:02,345 as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"[\s\u00A0\u1680\u2000-\u200B\u202F\u205F\u3000\uFEFF]"

#: Ends with \z, as Java's $ also matches before a final line break.
READABLE = r"^[0-9]{1,6}:[0-5]?[0-9]:[0-5]?[0-9][.,][0-9]{3}\z"


def code_ms(code: Column) -> Column:
    """Milliseconds of hours:minutes:seconds[.,]milliseconds, blanks anywhere allowed; NULL if it can't be read.

    Minutes and seconds must be below 60 and milliseconds have three digits. NULL and empty give NULL.
    """
    # Most codes hold no blanks: for them nothing is replaced.
    clean = F.regexp_replace(code, f"{BLANKS}+", "")
    return F.when(code.rlike(READABLE), _parsed(code)).otherwise(F.when(clean.rlike(READABLE), _parsed(clean)))


def _parsed(s: Column) -> Column:
    """Milliseconds of a code that is known to be readable."""
    last = F.substring_index(s, ":", -1)
    part = (F.substring_index(s, ":", 1), F.substring_index(F.substring_index(s, ":", 2), ":", -1), F.substring(last, F.lit(1), F.length(last) - 4), F.substring(last, -3, 3))
    h, m, sec, ms = (x.try_cast("bigint") for x in part)
    return h * 3_600_000 + m * 60_000 + sec * 1000 + ms


def code_seconds(code: Column) -> Column:
    """D-01: the code as seconds in floating point."""
    return code_ms(code) / F.lit(1000.0)


def ms_code(ms: Column, mark: str = ",") -> Column:
    """HH:MM:SS and milliseconds of a number of milliseconds."""
    return F.format_string(
        f"%02d:%02d:%02d{mark}%03d",
        F.floor(ms / 3_600_000),
        F.floor(ms / 60_000) % 60,
        F.floor(ms / 1000) % 60,
        ms % 1000,
    )


def speaker_number(tag: Column) -> Column:
    """The number in a speaker tag however the tag is written, NULL without one."""
    digits = F.regexp_extract(F.translate(tag, "０１２３４５６７８９", "0123456789"), r"([0-9]{1,9})", 1)
    return F.when(digits != "", digits.cast("int"))
