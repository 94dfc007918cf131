"""A plain, row-by-row version of the turns operator that tests compare with."""

from __future__ import annotations

import re
import unicodedata

LATIN, CYRILLIC = "ABCEHKMOPTXYaceopxyk", "АВСЕНКМОРТХУасеорхук"
OPEN = {"[": "]", "(": ")", "{": "}", "<": ">", "*": "*", "♪": "♪"}
CODE = re.compile(r"[\[<(]?(?:\d{1,2}:)?\d{1,2}:\d\d(?:[.,]\d{1,3})?(?: --> (?:\d{1,2}:)?\d{1,2}:\d\d(?:[.,]\d{1,3})?)?[\]>)]?")


def fold(s: str) -> str:
    s = "".join(c for c in s if c not in "\\_́̀" and unicodedata.category(c) != "Cf")
    return unicodedata.normalize("NFC", s).translate(str.maketrans(LATIN, CYRILLIC)).lower()


def squeeze(s: str) -> str:
    return re.sub(r"(.)\1+", r"\1", s)


def has_speech(s: str, fillers: list[str], sounds: list[str]) -> bool:
    s = CODE.sub(" ", s).replace("ё", "е")
    changed = True
    while changed:
        changed = False
        for m in re.finditer(r"([\[({<*♪])([^\[\](){}<>*♪]*)([\])}>*♪])", s):
            inner = " ".join(re.findall(r"\w+", m[2]))
            if OPEN[m[1]] == m[3] and "?" not in m[2] and any(re.search(rf"\b{x.replace('ё', 'е')}\b", inner) and len(inner.split()) - len(x.split()) <= 2 for x in sounds):
                s, changed = s[: m.start()] + " " + s[m.end() :], True
                break
    s = re.sub(r"(?<=\w)[-‐‑](?=\w)", "", s)
    words = re.findall(r"\w+", s)
    many = [f.split() for f in fillers]
    at = 0
    while at < len(words):
        for f in sorted(many, key=len, reverse=True):
            got = words[at : at + len(f)]
            if len(f) > 1 and [squeeze(w) for w in got] == [squeeze(w) for w in f]:
                at += len(f)
                break
            if len(f) == 1 and got and is_drawn(got[0], f[0]):
                at += 1
                break
        else:
            return True
    return False


def is_drawn(word: str, term: str) -> bool:
    """word is term said one or more times, each letter run at least as long as in term."""
    runs = [(m[1], len(m[0])) for m in re.finditer(r"(.)\1*", term)]
    return re.fullmatch("(?:" + "".join(f"{c}{{{n},}}" for c, n in runs) + ")+", word) is not None


def newest(rows: list[dict], keys: list[str]) -> list[dict]:
    best: dict[tuple, dict] = {}
    for r in rows:
        k = tuple(r[x] for x in keys)
        if k not in best or (r["loaded_at"] or 0) > (best[k]["loaded_at"] or 0):
            best[k] = r
    return [best[k] for k in sorted(best)]


def head_time(s: str) -> str:
    while (m := re.match(r"\s*" + CODE.pattern + r"\s*", s)) is not None:
        s = s[m.end() :]
    return s


def all_turns(srt: list[dict], manual: list[dict], codes: dict[str, list[str]], fillers: list[str], sounds: list[str]) -> set[tuple]:
    lines = []
    for r in newest(srt, ["recording_id", "seg_file_no", "srt_index"]):
        text = fold(r["text"] or "")
        label = re.search(r"\d+", r["speaker_tag"] or "")
        head = re.match(r"[\[<(]?\s*(?:sреакеr|sрк|спикер)[\s_-]*(\d+)\s*[\]>)]?\s*:?", head_time(text))
        if head:
            text = head_time(text)[head.end() :]
        number = label[0] if label else head[1] if head else None
        lines.append(("srt", r["recording_id"], r["seg_file_no"], r["srt_index"], None if number is None else f"SPEAKER_{int(number):02d}", has_speech(text, fillers, sounds)))
    for r in newest(manual, ["recording_id", "seg_no", "pos"]):
        text, label = fold(r["text"] or ""), None
        rest = head_time(text).lstrip("[(<* ")
        rest = head_time(rest)
        for code in codes.get(r["recording_id"], []):
            spelt = r"\.?\s?".join(code.lower()) + r"\s*(?:[:.—–]|\]|\)|>|\*\*)"
            if m := re.match(spelt, rest):
                label, text = code, rest[m.end() :]
        lines.append(("manual", r["recording_id"], r["seg_no"], r["pos"], label, has_speech(text, fillers, sounds)))
    out, clip, speaker, turn = set(), None, None, None
    for origin, rec, seg, pos, label, said in lines:
        if (origin, rec, seg) != clip:
            if turn:
                out.add(tuple(turn))
            clip, speaker, turn = (origin, rec, seg), None, None
        speaker = label or speaker
        if not said or speaker is None:
            continue
        if turn and turn[3] == speaker:
            turn[5] = pos
        else:
            if turn:
                out.add(tuple(turn))
            turn = [origin, rec, seg, speaker, pos, pos]
    if turn:
        out.add(tuple(turn))
    return out
