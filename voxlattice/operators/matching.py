"""Sequential matching of recognised segments with a transcript's sentences or tokens.

The matchers are ordered by nature and a clip may be cut nowhere without losing matches across the cut, so each clip
goes whole to one task. What a task holds grows with the lines and tokens of its clip; of a large table the
dynamic programme keeps about 2 * sqrt(segments) rows and computes the others again on the way back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlattice.functions.similarity import partial_ratio, token_set_ratio
from voxlattice.operators.whole_keys import begins, by_keys

#: Tokens and segments of the clips that best_parameters() solves together; a clip is never cut.
TOGETHER = 20_000
#: Places of a table of the dynamic programme that is kept whole, 12 bytes each.
WHOLE_TABLE = 10_000_000


def greedy_run(source: list[str], target: list[str], direct: tuple[float, float] = (75, 80), ahead: tuple[float, float] = (90, 90), retry: int = 5) -> list[list[int]]:
    """J-08: for each source sentence the positions of its target sentences.

    Matching (either ratio above its threshold) takes target sentences as long as they match; the last one is taken
    without moving on, so it may be taken again. After the run, unless it ended on the last sentence, up to `retry`
    sentences beyond the current one are tried with the stricter thresholds, fewer near the end, and a run taken
    from the first that matches.
    """
    # Scores are whole numbers; the search of a part may end at one that is rounded up beyond the threshold.
    fits = lambda a, b, t: round(token_set_ratio(a, b)) > t[0] or round(partial_ratio(a, b, t[1] + 0.501)) > t[1]
    out: list[list[int]] = [[] for _ in source]
    at, last = 0, len(target) - 1
    for i, s in enumerate(source):
        if at > last:
            break
        stopped = False
        while fits(s, target[at], direct):
            out[i].append(at)
            if at == last:
                stopped = True
                break
            at += 1
        if stopped:
            continue
        tries = min(retry, last - 1 - at) if at + retry > last + 1 else retry
        look = at
        for _ in range(max(0, tries)):
            look += 1
            if look > last:
                break
            began = False
            while fits(s, target[look], ahead):
                began = True
                out[i].append(look)
                if look == last:
                    break
                look += 1
            if began:
                at = look
                break
    return out


def greedy_pointer(source: list[str], target: list[str], least: tuple[float, float] = (50, 60), retry: int = 4) -> list[list[int]]:
    """J-09: each source takes all matching target sentences from the pointer on; if none matched, the first of the
    next `retry` that matches, and the pointer moves behind it."""
    fits = lambda a, b: bool(a) and bool(b) and (token_set_ratio(a, b, blanks=True) >= least[0] or partial_ratio(a, b, least[1]) >= least[1])
    out: list[list[int]] = [[] for _ in source]
    at = 0
    for i, s in enumerate(source):
        while at < len(target) and fits(s, target[at]):
            out[i].append(at)
            at += 1
        if not out[i]:
            for look in range(at + 1, min(at + retry, len(target) - 1) + 1):
                if fits(s, target[look]):
                    out[i].append(look)
                    at = look + 1
                    break
    return out


def span_similarities(segments: list[list[str]], tokens: list[str], longest: int = 25) -> Callable[[int], tuple[np.ndarray, np.ndarray]]:
    """A function that gives for a segment the starts near a token it shares, and [start, length - 1] of the similarity of
    those spans, -inf where a span goes beyond the end. All other spans share no token.

    Which tokens of a span repeat earlier ones depends on the tokens only and is found once.
    """
    m, known = len(tokens), {}
    ids = np.array([known.setdefault(t, len(known)) for t in tokens], dtype=np.int64)
    last, places = np.full(m, -1, dtype=np.int64), {}
    for j, t in enumerate(ids.tolist()):
        if t in places:
            last[j] = places[t][-1]
        places.setdefault(t, []).append(j)
    at = {t: np.array(js) for t, js in places.items()}
    lengths = np.arange(longest)

    def of(i: int) -> tuple[np.ndarray, np.ndarray]:
        own = set(segments[i])
        shared_at = [at[known[w]] for w in own if w in known]
        if not shared_at:
            return np.zeros(0, dtype=np.int64), np.zeros((0, longest))
        is_shared, near = np.zeros(m, dtype=bool), np.zeros(m + 1, dtype=np.int64)
        for js in shared_at:
            is_shared[js] = True
            np.add.at(near, np.maximum(js - longest + 1, 0), 1)
            np.add.at(near, js + 1, -1)
        starts = np.flatnonzero(near.cumsum()[:m])
        ends = starts[:, None] + lengths
        inside = ends < m
        ends = np.minimum(ends, m - 1)
        new = (last[ends] < starts[:, None]) & inside
        shared, seen = (new & is_shared[ends]).cumsum(axis=1), new.cumsum(axis=1)
        return starts, np.where(inside, 2 * shared / (len(own) + seen), -np.inf)

    return of


def span_boundaries(
    segments: list[list[str]], tokens: list[str], skip: float = 0.8, least: float = 0.3, shortest: int = 1, longest: int = 25, length_cost: float = 0.02, similar: Callable[[int], tuple[np.ndarray, np.ndarray]] | None = None,
) -> tuple[list[int], list[float]]:
    """J-10: boundaries (one more than segments) of the cheapest monotone matching, and the cumulative costs.

    A segment either takes no token at the cost `skip`, or the span of up to `longest` tokens that follows. Equal
    costs prefer skipping, then the shorter span; tokens may stay over only at the end. similar: span_similarities()
    of the same segments, tokens and longest, if they are at hand. Of a table beyond WHOLE_TABLE every sqrt(segments)-th row
    is kept; the rows between two of them are computed again on the way back.
    """
    n, m = len(segments), len(tokens)
    similar = similar or span_similarities(segments, tokens, longest)

    def step(before: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The row of segment i from the one before, and the length that each place took."""
        row, took = before + skip, np.zeros(m + 1, dtype=np.int32)
        starts, sims = similar(i)
        enough = (sims >= least) & np.isfinite(sims)
        for length in range(shortest, min(longest, m) + 1):
            able = enough[:, length - 1]
            if not able.any():
                continue
            a, s = starts[able], sims[able, length - 1]
            total = before[a] + ((1 - s) + length_cost * length)
            better = total < row[a + length]
            row[a[better] + length], took[a[better] + length] = total[better], length
        return row, took

    every = n if n * (m + 1) <= WHOLE_TABLE else int(n**0.5)
    row = np.full(m + 1, np.inf)
    row[0] = 0.0
    kept, part = {0: row}, [(row, None)]
    for i in range(n):
        if i and i % every == 0:
            kept[i], part = row, [(row, None)]
        part.append(step(row, i))
        row = part[-1][0]
    ends, costs = [int(row.argmin())], []
    for first in sorted(kept if n else (), reverse=True):
        if len(ends) > 1:
            part = [(kept[first], None)]
            for i in range(first, first + every):
                part.append(step(part[-1][0], i))
        for row, took in part[:0:-1]:
            costs.append(float(row[ends[-1]]))
            ends.append(ends[-1] - int(took[ends[-1]]))
    return ends[::-1], costs[::-1]


def _by_clip(left: DataFrame, right: DataFrame, keys: list[str], run: Callable, made: str) -> DataFrame:
    """run() on the two sides of each clip, in order of their places. Rows with NULL in keys or place are left out."""
    known = lambda df, pos: df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, pos]))
    kinds = ", ".join(f"{k} {left.schema[k].dataType.simpleString()}" for k in keys)

    def both(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = a.sort_values("l_pos"), b.sort_values("r_pos")
        rows = [(*key, *x) for x in run(a["l_pos"].tolist(), a["l_norm"].fillna("").tolist(), b["r_pos"].tolist(), b["r_norm"].fillna("").tolist())]
        return pd.DataFrame(rows, columns=[*keys, *[x.split()[0] for x in made.split(", ")]])

    return known(left, "l_pos").groupBy(*keys).cogroup(known(right, "r_pos").groupBy(*keys)).applyInPandas(both, f"{kinds}, {made}")


def aligned(left: DataFrame, right: DataFrame, keys: list[str], matcher: Callable[[list[str], list[str]], list[list[int]]]) -> DataFrame:
    """keys, l_pos, r_pos of the matches. left: keys, l_pos, l_norm; right: keys, r_pos, r_norm; clips in order of pos.

    Clips with one side only have no matches; NULL norms are empty texts; an empty table gives an empty one.
    """

    def run(l_pos: list[int], l_norm: list[str], r_pos: list[int], r_norm: list[str]) -> Iterator[tuple]:
        return ((l_pos[i], r_pos[j]) for i, js in enumerate(matcher(l_norm, r_norm)) for j in js)

    return _by_clip(left, right, keys, run, "l_pos int, r_pos int")


def span_aligned(left: DataFrame, right: DataFrame, keys: list[str], **options: float) -> DataFrame:
    """J-10 by clip: keys, l_pos, tok_from, tok_to, cost. left: keys, l_pos, l_norm; right: keys, r_pos, r_norm (tokens).

    tok_from and tok_to count from the clip's first token.
    """

    def run(l_pos: list[int], l_norm: list[str], _: list[int], tokens: list[str]) -> Iterator[tuple]:
        ends, costs = span_boundaries([x.split() for x in l_norm], tokens, **options)
        return ((p, ends[i], ends[i + 1], costs[i]) for i, p in enumerate(l_pos))

    return _by_clip(left, right, keys, run, "l_pos int, tok_from int, tok_to int, cost double")


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[k], first[k] + 1, ... for sizes[k] numbers of each k."""
    ends = sizes.cumsum()
    return np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def unmatched(clips: list[tuple[list[list[str]], list[str]]], grid: list[dict[str, float]]) -> np.ndarray:
    """[clip, set of grid]: the segments that span_boundaries() leaves without tokens.

    All clips and all sets that share `least` and the lengths are one table, one step for each place of a segment: a row
    of costs, and with each cost the segments left out on the way there, so that no way back is needed. Sums are made in
    the order of span_boundaries(), as equal costs decide.
    """
    order = sorted(range(len(clips)), key=lambda c: -len(clips[c][0]))
    n = np.array([len(clips[c][0]) for c in order], dtype=np.int64)
    m = np.array([len(clips[c][1]) for c in order], dtype=np.int64)
    off, most = m.cumsum() - m, int(m.sum())
    known: dict[str, int] = {}
    ids = np.array([known.setdefault(t, len(known)) for c in order for t in clips[c][1]], dtype=np.int64)
    of, end = np.repeat(np.arange(len(order)), m), np.repeat(off + m, m)
    keys = of * (len(known) + 1) + ids
    by_key = np.argsort(keys, kind="stable")
    keys = keys[by_key]
    last = np.full(most, -1, dtype=np.int64)
    again = keys[1:] == keys[:-1]
    last[by_key[1:][again]] = by_key[:-1][again]
    out = np.zeros((len(clips), len(grid)), dtype=np.int64)
    kinds: dict[tuple[int, int], dict[float, list[int]]] = {}
    for k, options in enumerate(grid):
        kinds.setdefault((int(options.get("shortest", 1)), int(options.get("longest", 25))), {}).setdefault(options.get("least", 0.3), []).append(k)
    words = [[set(s) for s in clips[c][0]] for c in order]
    for (shortest, longest), sets in kinds.items():
        lengths = np.arange(longest)
        ends = np.minimum(np.arange(most)[:, None] + lengths, max(0, most - 1))
        inside = np.arange(most)[:, None] + lengths < end[:, None]
        new = (last[ends] < np.arange(most)[:, None]) & inside
        seen = new.cumsum(axis=1, dtype=np.int32)
        # A clip has one place more than tokens: those of clip c begin at off[c] + c.
        state = {}
        for least, ks in sets.items():
            row = np.full((most + len(order), len(ks)), np.inf)
            row[off + np.arange(len(order))] = 0.0
            state[least] = (row, np.zeros(row.shape, dtype=np.int32), np.array([grid[k].get("skip", 0.8) for k in ks]), np.array([grid[k].get("length_cost", 0.02) for k in ks]))
        for i in range(int(n[0]) if len(n) else 0):
            live = int(np.searchsorted(-n, -i, side="left"))
            tokens = int(off[live - 1] + m[live - 1])
            own = np.array([len(w[i]) for w in words[:live]], dtype=np.int64)
            asked = np.array([c * (len(known) + 1) + known[t] for c in range(live) if m[c] for t in words[c][i] if t in known], dtype=np.int64)
            first = np.searchsorted(keys, asked, side="left")
            held = by_key[_ranges(first, np.searchsorted(keys, asked, side="right") - first)]
            is_shared = np.zeros(most, dtype=bool)
            is_shared[held] = True
            near = np.bincount(np.maximum(held - longest + 1, off[of[held]]), minlength=tokens + 1) - np.bincount(held + 1, minlength=tokens + 1)
            starts = np.flatnonzero(near.cumsum()[:tokens])
            shared = (new[starts] & is_shared[ends[starts]]).cumsum(axis=1, dtype=np.int32)
            sims = 2 * shared / (own[of[starts]][:, None] + seen[starts])
            for least, (row, left, skip, cost) in state.items():
                enough = (sims >= least) & inside[starts]
                upto = tokens + live
                before, was = row[:upto].copy(), left[:upto].copy()
                row[:upto] += skip
                left[:upto] += 1
                reached = np.isfinite(before[starts + of[starts]]).any(axis=1)
                enough &= reached[:, None]
                for length in range(shortest, longest + 1):
                    able = np.flatnonzero(enough[:, length - 1])
                    if not len(able):
                        continue
                    a = starts[able] + of[starts[able]]
                    total = before[a] + ((1 - sims[able, length - 1])[:, None] + cost * length)
                    now = row[a + length]
                    better = total < now
                    row[a + length] = np.where(better, total, now)
                    left[a + length] = np.where(better, was[a], left[a + length])
        for least, (row, left, _, _) in state.items():
            for c, at in enumerate(order):
                mine = slice(int(off[c]) + c, int(off[c] + m[c]) + c + 1)
                best = row[mine].argmin(axis=0)
                out[at, sets[least]] = left[mine][best, np.arange(len(best))]
    return out


def best_parameters(left: DataFrame, right: DataFrame, keys: list[str], grid: list[dict[str, float]]) -> DataFrame:
    """A-08: for each clip the first of the parameter sets that leaves fewest segments without tokens.

    left: keys, l_pos, l_norm; right: keys, r_pos, r_norm, the tokens of a line parted by single blanks. The options of a
    set are those of span_boundaries(). Clips are solved together, about TOGETHER tokens and segments at a time.
    """

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        at = begins(table, len(keys))
        side, norm = table.column("side").to_numpy(), table.column("norm").to_pylist()
        clips = []
        for first, last in zip(at.tolist(), [*at[1:].tolist(), table.num_rows]):
            cut = first + int(np.searchsorted(side[first:last], 1))
            segments, tokens = norm[first:cut], [t for x in norm[cut:last] for t in x.split(" ")]
            # Without tokens all segments stay over, whatever the parameters.
            clips.append(([x.split() for x in segments], tokens) if tokens else len(segments))
        found = np.array([(c if isinstance(c, int) else 0, 0) for c in clips], dtype=np.int64)
        mine = sorted((k for k, c in enumerate(clips) if not isinstance(c, int) and c[0]), key=lambda k: len(clips[k][0]))
        while mine:
            part, size = [], 0
            while mine and (not part or size < TOGETHER):
                part.append(mine.pop())
                size += len(clips[part[-1]][0]) + len(clips[part[-1]][1])
            counts = unmatched([clips[k] for k in part], grid)
            found[part] = np.stack([counts.min(axis=1), counts.argmin(axis=1)], axis=1)
        some = np.flatnonzero([c if isinstance(c, int) else len(c[0]) for c in clips])
        rows = pa.array(at[some])
        yield pa.RecordBatch.from_arrays([*[table.column(k).combine_chunks().take(rows) for k in range(len(keys))], pa.array(found[some, 0]), pa.array(found[some, 1].astype(np.int32))], [*keys, "unmatched", "param_no"])

    known = lambda df, side, pos, norm: df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, pos])).select(*keys, F.lit(side).alias("side"), F.col(pos).cast("bigint").alias("pos"), F.coalesce(norm, F.lit("")).alias("norm"))
    kinds = ", ".join(f"{k} {left.schema[k].dataType.simpleString()}" for k in keys)
    return by_keys(known(left, 0, "l_pos", "l_norm").unionByName(known(right, 1, "r_pos", "r_norm")), keys, ["side", "pos"], run, f"{kinds}, unmatched bigint, param_no int")
