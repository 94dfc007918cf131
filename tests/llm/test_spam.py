from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np

from voxlattice.llm import spam

SUBJECTS, PLACES, VERBS, THINGS = ["рыбаки", "бабы", "кузнецы", "соседи"], ["в лесу", "на гумне", "у брода", "за рекой"], ["чинили", "носили", "точили", "прятали"], ["сети", "корзины", "косы", "лодки", "пояса"]


def honest(rng, n=12):
    return " ".join(rng.choice(["{} {} {} {}.", "Если {1} {0} не {2} {3}, то мы и не ждали.", "Не помню, где {0} {2} {3}, а потом и {1}."]).format(rng.choice(SUBJECTS), rng.choice(PLACES), rng.choice(VERBS), rng.choice(THINGS)) for _ in range(n))


def test_kinds_of_spam(spark):
    rng = random.Random(0)
    rows = [(i, honest(rng)) for i in range(300)]
    spammy = {
        1000: ", ".join(rng.choice(["купить сети", "сети", "купить лодки"]) for _ in range(60)),
        1001: " ".join(f'<a href="http://x{i}.test/p">{rng.choice(THINGS)}</a>' for i in range(40)),
        1002: " ".join("#" + rng.choice(THINGS) for _ in range(60)),
        1003: " - ".join(f"{rng.choice(THINGS)} {rng.randrange(999)} руб" for _ in range(50)),
        1004: honest(rng, 3) + " " + ", ".join("недорого косы" for _ in range(80)),
    }
    decoys = {2000: honest(rng, 14) + " См. http://a.test, http://b.test", 2001: "\n".join(f"00:00:{i:02d},000 – {honest(rng, 1)}" for i in range(20)), 2002: "\n".join(f"{honest(rng, 2)}\nБабы на гумне носили корзины, а мы и не ждали." for _ in range(8)), 2003: honest(rng, 12) + " " + ", ".join("недорого косы" for _ in range(8))}
    odd = [(3000, None), (3001, ""), (3002, "!!!"), (3003, "Да.")]
    df = spark.createDataFrame([*rows, *spammy.items(), *decoys.items(), *odd], "doc_id bigint, text string")
    assert {r.doc_id for r in spam.spam_documents(df).collect()} == set(spammy)
    assert spam.spam_documents(df.limit(0)).collect() == []


def plain_windows(text: str) -> list[list[float]]:
    """Features of the windows of one text, window by window and token by token."""
    tokens = [m.group() for m in spam._TOKENS.finditer(text.lower())]
    kinds = [spam._KIND_OF[t] for t in tokens]
    own = spam._SETS[spam.language([t for t, k in zip(tokens, kinds) if k == spam.WORD])]
    starts = [m.start() for m in spam._TOKENS.finditer(text.lower())] + [len(text)]
    same = ["#" if k == spam.LINK else "0" if k != spam.WORD else t for t, k in zip(tokens, kinds)]
    times = Counter(zip(same, same[1:]))
    many = [math.log2(times[p]) for p in zip(same, same[1:])]
    cuts = list(range(0, len(tokens), spam.WINDOW))
    if len(cuts) > 1 and len(tokens) - cuts[-1] < spam.WINDOW // 2:
        cuts.pop()
    out = []
    for a, z in zip(cuts, [*cuts[1:], len(tokens)]):
        k, size = z - a, starts[z] - starts[a]
        counts = Counter(same[a:z])
        out.append([
            sum(t in own for t in tokens[a:z]) / k, sum(x == spam.NUMBER for x in kinds[a:z]) / k, sum(starts[i + 1] - starts[i] for i in range(a, z) if kinds[i] == spam.LINK) / size,
            sum(max(many[i] if i < len(many) else 0, many[i - 1] if i else 0) for i in range(a, z)) / max(1, math.log2(len(tokens))) / k, -sum(c / k * math.log2(c / k) for c in counts.values()) / math.log2(k) if k > 1 else 1.0,
        ])
    return out


def test_windows_of_many_texts_against_the_plain_rule():
    rng = random.Random(1)
    texts = [honest(rng, rng.randrange(1, 30)) + rng.choice(["", " #сети #сети 3.5 http://a.test/x 12:30 "]) * rng.randrange(4) for _ in range(60)] + ["", "...", "да"]
    at, langs, chars, x = spam.windows(texts)
    assert set(langs) == {"ru"}
    for i, t in enumerate(texts):
        own = at == i
        want = plain_windows(t) if any(map(str.isalnum, t)) else []
        assert own.sum() == len(want) and np.allclose(x[own], want) if want else not own.any()
    assert (chars > 0).all()
    assert spam.language("the cat and the dog".split()) == "en" and spam.language("der hund und die katze".split()) == "de" and spam.language(["木匠在井边"]) == "zh"
