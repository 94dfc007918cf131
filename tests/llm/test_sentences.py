from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxlattice.llm import sentences as S

UNITS = {
    "ru": ["Рыбаки чинили сети в 1975 г.", "Мы ждали, т. е. не спали.", "«Да, в лесу! Нет, у реки», — говорили бабы.", "[А где косы?]", "В д. Ухотка носили корзины (да, зимой!) весной.", "Л. Г. Овинная помнит, как точили косы.", "Искали сани… ну потом нашли!", "Соседи шутили: «Где сани?»", "Купили 3.5 пуда и т. д."],
    "en": ["Dr. Trask noted that it rained.", "We met at No. 5 St. Ollan Street.", "“Where is it?” asked J. T. Trask quietly.", "They sold pots, e.g. clay ones, until 8 p.m. on that day.", "The elders slept!"],
    "zh": ["渔夫说：“木桶去哪里了？”", "老人们……后来也修理旧渔网。", "节日以前，木匠在河对岸出售木桶！"],
    "ja": ["「網を直した。」と大工が言った。", "漁師は川の向こうで…たぶん網を売った。", "秋に大工は市場で鍋を洗った！"],
    "th": ["ตอนเช้าเด็กๆขายถังไม้ที่ตลาด", "หน้าหนาวคนแก่ตากแห 25 ใบข้างโรงสี"],
    "hi": ["डॉ. वेलकर ने कहा कि वे सोते थे।", "कल मछुआरे जाल बेचते थे?"],
}


def corpus(rng, n):
    out = []
    for i in range(n):
        lang = rng.choice([*UNITS, "ru", "ru"])
        units = [rng.choice(UNITS[lang]) for _ in range(rng.randrange(1, 8))]
        gap = "" if lang in ("zh", "ja") else " "
        text, ends = "", []
        for k, u in enumerate(units):
            text += (gap if k else "") + u
            ends.append(len(text))
        out.append((i, lang, text, ends))
    return out


def test_units_of_many_scripts(spark):
    made = corpus(random.Random(0), 600)
    df = spark.createDataFrame([(i, t) for i, _, t, _ in made], "row_id bigint, text string").withColumn("end_char", F.lit("clash"))
    got: dict[int, list[int]] = {}
    for r in S.sentence_ends(df, ["row_id"]).collect():
        got.setdefault(r.row_id, []).append(r.end_char)
    right = sum(sorted(got[i]) == ends for i, _, _, ends in made)
    assert right / len(made) > 0.97


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "Да"), (5, "«Не закрыто. Да"), (6, "...") , (7, "Да. " * 20_000), (4, "Да")]
    df = spark.createDataFrame(rows, "row_id bigint, text string")
    got: dict[int, list[int]] = {}
    for r in S.sentence_ends(df, ["row_id"]).collect():
        got.setdefault(r.row_id, []).append(r.end_char)
    assert set(got) == {4, 5, 6, 7} and got[4] == [2, 2] and got[5] == [15] and got[6] == [3] and max(got[7]) == 79_999
    assert S.sentence_ends(df.limit(0), ["row_id"]).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_forward_backward_against_all_paths(seed):
    """Three texts at a time: posteriors of places and of pairs of events."""
    rng = random.Random(seed)
    sizes = [6, 1, 4]
    n = sum(sizes)
    logit, near = np.array([rng.uniform(-3, 3) for _ in range(n)]), np.array([rng.randrange(3) for _ in range(n)])
    steps = np.array([[[rng.uniform(-1, 1) for _ in "ab"] for _ in "ab"] for _ in range(3)])
    odds, pairs = S.forward_backward(logit, near, np.repeat(np.arange(3), sizes), steps)
    first = 0
    for size in sizes:
        mass, both = np.zeros((size, 2)), np.zeros((size, 2, 2))
        for path in itertools.product((0, 1), repeat=size):
            w, last = 0.0, 1
            for i, e in enumerate(path):
                w += steps[near[first + i]][last][e] + (logit[first + i] if e else 0.0)
                last = e
            for i, e in enumerate(path):
                mass[i][e] += math.exp(w)
                both[i][path[i - 1] if i else 1][e] += math.exp(w)
        assert np.allclose(odds[first : first + size], np.log(mass[:, 1] / mass[:, 0]))
        assert np.allclose(pairs[first : first + size], both / both.sum((1, 2), keepdims=True))
        first += size


def test_marks_seen_through_keep_raw_offsets():
    text = "Чинили лод\\ки\\. Да\u200b."
    found = [p[0] for p in S.places(text)[2] if p[1] != S.STARTS]
    assert found == [text.index(".") + 1, len(text)]
    clean, to_raw = S._seen("а\u0301б\\\\в")
    assert clean == "абв" and [to_raw(i) for i in range(4)] == [0, 1, 3, 6]


def rows_of(texts: list[str]) -> pa.RecordBatch:
    """Places of texts as they are written."""
    return pa.RecordBatch.from_arrays(S._as_rows([S.places(t) for t in texts]), ["lang", "stretch", *S.PLACE])


def learnt(batch: S.Batch, rounds: int = S.ROUNDS, steps: bool = True) -> S.Model:
    model = S.Model()
    for _ in range(rounds):
        cells = np.zeros((S.CELLS, 2))
        batch.add_counts(model, cells)
        model = S.Model(cells)
        if not steps:
            model.steps = np.zeros_like(model.steps)
    return model


def test_the_first_guess_only_starts():
    """From no guess at all the same boundaries are learnt, and a model once learnt doesn't look at the guess."""
    made = corpus(random.Random(1), 500)
    batch = S.Batch(rows_of([t for _, _, t, _ in made]))
    model = learnt(batch)
    odds = batch.posterior(model)[0]
    batch.first[:] = 0.5
    assert (batch.posterior(model)[0] == odds).all()
    blind = batch.posterior(learnt(batch))[0]
    assert ((blind > 0) == (odds > 0)).mean() > 0.95
    assert (np.abs(blind - odds) > 0.1).any()


def test_events_depend_on_the_events_before_them():
    made = corpus(random.Random(2), 500)
    batch = S.Batch(rows_of([t for _, _, t, _ in made]))
    model = learnt(batch)
    assert model.steps[0, 1, 1] < model.steps[2, 1, 1]  # a boundary a word behind another is less likely
    alone = S.Model()
    alone.__dict__ |= model.__dict__ | {"steps": np.zeros_like(model.steps)}
    assert np.abs(batch.posterior(model)[0] - batch.posterior(alone)[0])[batch.open].max() > 0.3


WHO = {"ru": ["рыбаки", "бабы", "старики", "соседи"], "en": ["the elders", "the smiths", "our neighbours", "some women"], "zh": ["渔夫", "老人们", "邻居们", "木匠"], "th": ["ชาวประมง", "คนแก่", "เพื่อนบ้าน", "ช่างไม้"]}
DID = {"ru": ["чинили", "носили", "прятали", "красили"], "en": ["mended", "carried", "hid", "painted"], "zh": ["修理", "搬运", "出售", "清洗"], "th": ["ซ่อม", "ขาย", "ล้าง", "ตาก"]}
WHAT = {"ru": ["сети у реки", "старые корзины", "лодки весной", "косы на гумне"], "en": ["nets at dawn", "old boots", "boats by the mill", "sickles in autumn"], "zh": ["旧渔网", "竹篮子", "木桶在河边", "铜壶"], "th": ["แหเก่า", "ตะกร้า", "ถังไม้ข้างบ่อ", "หม้อทองแดง"]}


def sentence(rng, lang: str) -> str:
    return ("" if lang in ("zh", "th") else " ").join(rng.choice(x[lang]) for x in (WHO, DID, WHAT))


@pytest.mark.parametrize("lang", ["ru", "en", "zh", "th"])
def test_texts_without_marks_are_split(spark, lang):
    rng = random.Random(7)
    full, gap = {"zh": ("。", ""), "th": ("", " ")}.get(lang, (".", " "))
    marked = [(i, gap.join((u := sentence(rng, lang))[0].upper() + u[1:] + full for _ in range(rng.randrange(2, 7)))) for i in range(400)]
    bare, want = [], {}
    for i in range(20):
        units = [sentence(rng, lang) for _ in range(12)]
        glue = "" if lang in ("zh", "th") else " "
        bare.append((1000 + i, glue.join(units)))
        ends = np.cumsum([len(u) for u in units]) + np.arange(12) * len(glue)
        want[1000 + i] = set(ends.tolist())
    got: dict[int, set[int]] = {}
    for r in S.sentence_ends(spark.createDataFrame(marked + bare, "row_id bigint, text string"), ["row_id"]).where("row_id >= 1000").collect():
        got.setdefault(r.row_id, set()).add(r.end_char)
    both, found, there = (sum(len(x) for x in y) for y in ([got[i] & want[i] for i in want], got.values(), want.values()))
    assert both / found > 0.95 and both / there > 0.95


def test_units_without_marks_against_all_ways_to_part(spark):
    rng = random.Random(0)
    cells = np.zeros((S.GRAM_CELLS, 2))
    ru = S.LANGUAGES.index("ru")
    for _ in range(60):
        units = [sentence(rng, "ru") for _ in range(4)]
        S.Grams.add(" ".join(units), ru, np.cumsum([len(u) + 1 for u in units]).tolist(), cells)
    grams = S.Grams(cells)
    forms = " ".join(sentence(rng, "ru") for _ in range(3)).split()
    n, gain = len(forms), grams.odds(forms, ru)
    units = grams.units[ru] + 1e-3
    seen = units[1:].cumsum()
    most = int((seen < 0.9999 * seen[-1]).sum()) + 1
    length = np.convolve(units[1 : most + 2], [0.25, 0.5, 0.25], "same")[: most + 1] / seen[-1]
    mass, total = np.zeros(n), 0.0
    for cuts in itertools.product((0, 1), repeat=n - 1):
        at = [-1, *[i for i, c in enumerate(cuts) if c], n - 1]
        sizes = np.diff(at)
        if sizes.max() > len(length):
            continue
        w = math.exp(sum(gain[i] for i in at[1:-1])) * math.prod(length[k - 1] for k in sizes)
        total += w
        for i in at[1:-1]:
            mass[i] += w
    assert grams.split(forms, ru) == np.flatnonzero(mass / total > 0.5).tolist()
    assert grams.split(["один"], ru) == [] and grams.split([], ru) == []
