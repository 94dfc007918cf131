"""Putting transcripts back to their segments: similarity matrix, shift, one-to-one assignment."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlattice.functions.similarity import PackedWords, token_set_ratio
from voxlattice.functions.text import norm_reorder, tolerant_bool
from voxlattice.operators.whole_keys import begins, by_keys, whole_keys
from voxlattice.runtime import stage
from voxlattice.sources.sinks import copy_file, write_csv

GRAMS = (3, 4, 5)
#: N-grams kept for a file, by frequency.
FEATURES = 20_000
#: Texts of either side whose products are made at a time.
SIDE = 256
#: Texts of either side of a file that one task takes.
BLOCK = 2048
#: Texts whose grams are counted at a time.
PIECE = 2048
#: Characters of texts whose words are compared with another text's at once.
PACK = 1 << 17
#: Tasks at least for the products.
TASKS = 48


def _coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, code, size and first character of all n-grams of the texts; equal grams, and no others, have one code."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    known, letters = np.unique(points, return_inverse=True)
    letters = letters.astype(np.int64) + 1
    of, ends, width = np.repeat(np.arange(len(texts)), sizes), np.repeat(sizes.cumsum(), sizes), len(known) + 1
    narrow, code, found = width ** max(GRAMS) < 1 << 62, letters, []
    for n in range(2, max(GRAMS) + 1):
        code = code[:-1] * width + letters[n - 1 :]
        if not narrow:
            # Numbers of what is there in place of numbers of what might be.
            code = np.unique(code, return_inverse=True)[1].astype(np.int64) + 1
        if n in GRAMS:
            at = np.flatnonzero(np.arange(len(code)) + n <= ends[: len(code)])
            found.append((of[at], code[at] if narrow else code[at] * len(GRAMS) + len(found), np.full(len(at), n), at))
    return tuple(np.concatenate(x) for x in zip(*found))  # type: ignore[return-value]


def _counted(texts: list[str], more: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, gram, n: counts of grams of each text, in order of texts; first character and size of each gram; the grams that `more` are."""
    of, code, size, at = _coded([*texts, *more])
    known, where, gram = np.unique(code, return_index=True, return_inverse=True)
    whole = (of >= len(texts)) & (size == np.array([0] * len(texts) + [len(x) for x in more], dtype=np.int64)[of]) if more else np.zeros(len(of), bool)
    given = np.zeros(len(more), dtype=np.int64)
    given[of[whole] - len(texts)] = gram[whole]
    of_text = of < len(texts)
    pair, n = np.unique(of[of_text] * max(1, len(known)) + gram[of_text], return_counts=True)
    return pair // max(1, len(known)), pair % max(1, len(known)), n, at[where], size[where], given


def char_grams(docs: DataFrame, file: str, text: str) -> DataFrame:
    """file, gram, df, total: the texts that hold an n-gram of characters, blanks included, and how often. Counted in Arrow
    batches, of which one row for each gram of a file is left."""

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        at = begins(table, 1)
        for first, last in zip(at, [*at[1:], table.num_rows]):
            for k in range(first, last, PIECE):
                texts = table.column(1).slice(k, min(PIECE, last - k)).to_pylist()
                _, gram, n, where, size, _ = _counted(texts, [])
                said = "".join(texts)
                rows = [said[x : x + y] for x, y in zip(where.tolist(), size.tolist())]
                names = table.column(0).slice(first, 1).combine_chunks().take(pa.array(np.zeros(len(rows), np.int64)))
                counts = [pa.array(np.bincount(gram, x, len(rows)).astype(np.int64)) for x in (None, n)]
                yield pa.RecordBatch.from_arrays([names, pa.array(rows, pa.string()), *counts], [file, "gram", "df", "total"])

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(batches, 1):
            yield from run(table)

    kind = docs.schema[file].dataType.simpleString()
    pieces = docs.select(file, text).sortWithinPartitions(file).mapInArrow(both, f"{file} {kind}, gram string, df bigint, total bigint")
    return pieces.groupBy(file, "gram").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def vocabulary(docs: DataFrame, file: str, text: str, number: DataFrame, features: int) -> DataFrame:
    """M-05: file, gram, idf = ln((1 + N) / (1 + df)) + 1 of the `features` most frequent grams of a file and those as frequent as the last."""
    per = char_grams(docs, file, text)
    # The k-th greatest total is found from the counts of totals, so no file's grams pass through one window.
    steps = per.groupBy(file, "total").agg(F.count("*").alias("grams"))
    down = Window.partitionBy(file).orderBy(F.desc("total")).rowsBetween(Window.unboundedPreceding, -1)
    kept_at = steps.withColumn("above", F.coalesce(F.sum("grams").over(down), F.lit(0))).where(F.col("above") < features).groupBy(file).agg(F.min("total").alias("least"))
    idf = F.log((1 + F.col("docs")) / (1 + F.col("df"))) + 1
    return per.join(kept_at, file).where("total >= least").join(number, file).select(file, "gram", idf.alias("idf"))


def _vectors(texts: list[str], number: int, features: int = FEATURES, grams: list[str] | None = None, idf: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """M-05: text, gram, w of unit vectors, in order of texts, and how many grams there may be. The fit is on the texts, of
    `number` with the empty ones, if no grams are given with their idf."""
    of, gram, n, where, _, given = _counted(texts, grams or [])
    weight = np.zeros(len(where))
    if grams is None:
        df, total = np.bincount(gram, minlength=len(where)), np.bincount(gram, n, len(where))
        kept = total >= (np.partition(total, -features)[-features] if len(total) > features else 0)
        weight[kept] = np.log((1 + number) / (1 + df[kept])) + 1
    else:
        weight[given] = idf
    w = n * weight[gram]
    some = w > 0
    of, gram, w = of[some], gram[some], w[some]
    return of, gram, w / np.sqrt(np.bincount(of, w * w, len(texts)))[of], len(where)


def _cosines(left: tuple[np.ndarray, np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, m: int, grams: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """First row, first column and the products of strips of the n x m texts; vectors are (text, gram, w) in order of texts."""
    (i, gi, wi), (j, gj, wj) = left, right
    both = np.zeros(grams, bool)
    both[gi] = True
    at = np.full(grams, -1)
    shared = np.unique(gj[both[gj]])
    at[shared] = np.arange(len(shared))
    keep_i, keep_j = at[gi] >= 0, at[gj] >= 0
    i, gi, wi, j, gj, wj = i[keep_i], at[gi[keep_i]], wi[keep_i], j[keep_j], at[gj[keep_j]], wj[keep_j]
    ends = np.searchsorted(i, np.arange(n + 1))
    for c in range(0, m, SIDE):
        # These columns as one dense table of grams, of which each text on the left adds up its own rows.
        wide, own = min(SIDE, m - c), slice(*np.searchsorted(j, [c, c + SIDE]))
        table = np.zeros((len(shared), wide))
        table[gj[own], j[own] - c] = wj[own]
        for r in range(0, n, SIDE):
            cos = np.zeros((min(SIDE, n - r), wide))
            for k in range(len(cos)):
                mine = slice(ends[r + k], ends[r + k + 1])
                cos[k] = wi[mine] @ table[gi[mine]]
            yield r, c, cos


def _docs(docs: DataFrame, file: str, side: str, pos: str, text: str) -> DataFrame:
    """The texts as _fitted() reads them: _f, _side, _pos, _said."""
    return stage(docs.where(F.col(file).isNotNull()).select(F.col(file).alias("_f"), F.col(side).cast("int").alias("_side"), F.col(pos).cast("bigint").alias("_pos"), F.coalesce(text, F.lit("")).alias("_said")))


def _every(k: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(f"{k}_blocks") - 1))


def _fitted(docs: DataFrame, number: DataFrame, a: DataFrame, b: DataFrame, run: Callable, schema: str) -> DataFrame:
    """run(file, positions of side 0, of side 1, their texts, their vectors, how many grams there may be) on each pair of blocks.

    docs: of _docs(), on which the vectors are fitted; number: _f, docs, a_blocks, b_blocks; a, b: rows of docs with docs and
    their blocks _a, _b. A file of one block fits its grams itself, if that is all its texts but the empty ones; of larger
    files the grams are counted in pieces and go to each pair of blocks.
    """
    columns = ["_f", "_a", "_b", "_side", "_pos", "_said", "docs", F.lit(None).cast("double").alias("idf")]
    whole = a.select(*columns).unionByName(b.select(*columns))
    large = number.where("a_blocks > 1 OR b_blocks > 1")
    if large.limit(1).count():
        grams = vocabulary(docs.join(F.broadcast(large.select("_f")), "_f", "left_semi"), "_f", "_said", number.select("_f", "docs"), FEATURES).join(large, "_f")
        given = grams.withColumn("_a", _every("a")).withColumn("_b", _every("b"))
        whole = whole.unionByName(given.select("_f", "_a", "_b", F.lit(2).alias("_side"), F.lit(None).cast("bigint").alias("_pos"), F.col("gram").alias("_said"), "docs", "idf"))

    def tables(table: pa.Table) -> Iterator[pa.RecordBatch]:
        at = begins(table, 3)
        for first, last in zip(at.tolist(), [*at[1:].tolist(), table.num_rows]):
            t = table.slice(first, last - first)
            n, upto = np.searchsorted(t.column("_side").to_numpy(), [1, 2]).tolist()
            said = t.column("_said").to_pylist()
            if not n or n == upto:
                continue
            of, gram, w, size = _vectors(said[:upto], t.column("docs")[0].as_py(), FEATURES, said[upto:] or None, t.column("idf").to_numpy()[upto:])
            cut = int(np.searchsorted(of, n))
            place = t.column("_pos").combine_chunks()
            yield from run(t.column("_f").slice(0, 1).combine_chunks(), place.slice(0, n), place.slice(n, upto - n), said[:n], said[n:upto], (of[:cut], gram[:cut], w[:cut]), (of[cut:] - n, gram[cut:], w[cut:]), size)

    # A pair of blocks is much more work than its bytes tell.
    parts = max(TASKS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return by_keys(whole, ["_f", "_a", "_b"], ["_side", "_pos"], tables, schema, parts)


def _products(docs: DataFrame, file: str, side: str, pos: str, text: str, empty: bool, run: Callable, schema: str, block_size: int) -> DataFrame:
    """run(file, positions of side 0, of side 1, their texts, strips of their cosines) on each pair of blocks of a file, of
    at most about block_size texts a side. Without empty, empty texts count in the fit only."""
    docs = _docs(docs, file, side, pos, text)
    met = F.lit(True) if empty else F.col("_said") != ""
    blocks = lambda k: F.greatest(F.lit(1), F.ceil(F.count_if((F.col("_side") == k) & met) / block_size)).cast("int")
    number = stage(docs.groupBy("_f").agg(F.count("*").alias("docs"), blocks(0).alias("a_blocks"), blocks(1).alias("b_blocks")))
    block = lambda k: F.pmod(F.xxhash64("_pos"), F.col(f"{k}_blocks")).cast("int")
    rows = docs.where(met).join(number, "_f")
    a = rows.where("_side = 0").withColumn("_a", block("a")).withColumn("_b", _every("b"))
    b = rows.where("_side = 1").withColumn("_b", block("b")).withColumn("_a", _every("a"))
    strips = lambda name, i, j, x, y, u, v, grams: run(name, i, j, x, y, _cosines(u, v, len(i), len(j), grams))
    return _fitted(docs, number, a, b, strips, schema)


def matrix(docs: DataFrame, file: str, side: str, pos: str, text: str, words: bool = True, char_weight: float = 0.7) -> DataFrame:
    """M-05, J-05: file, i, j, cosine and, with words, sim of every text of side 0 with every one of side 1 of its file.

    sim is char_weight of the cosine and the rest of the word-set ratio. Without words, pairs that share no gram are left
    out. The texts of a file are cut into blocks; each pair of blocks is one sparse product in one task, so a file of
    any size spreads over the cluster.
    """

    def run(name: pa.Array, i: pa.Array, j: pa.Array, a: list[str], b: list[str], strips: Iterator) -> Iterator[pa.RecordBatch]:
        for r, c, cos in strips:
            x, y = np.indices(cos.shape).reshape(2, -1) if words else np.nonzero(cos)
            out = [name.take(pa.array(np.zeros(len(x), np.int64))), i.take(pa.array(x + r)), j.take(pa.array(y + c)), pa.array(cos[x, y])]
            if words:
                ratios = np.array([token_set_ratio(a[u], b[v], blanks=True) for u, v in zip((x + r).tolist(), (y + c).tolist())], float) / 100
                out.append(pa.array(char_weight * cos[x, y] + (1 - char_weight) * ratios))
            yield pa.RecordBatch.from_arrays(out, [file, "i", "j", "cosine", "sim"][: len(out)])

    schema = f"{file} {docs.schema[file].dataType.simpleString()}, i bigint, j bigint, cosine double" + (", sim double" if words else "")
    return _products(docs, file, side, pos, text, words, run, schema, BLOCK)


def near_pairs(docs: DataFrame, file: str, side: str, pos: str, text: str, most: int = 0, char_weight: float = 0.7) -> DataFrame:
    """M-05 of near pairs only: file, i, j, sim where j - i is from 0 to most; the fit is on all docs. Positions have no gaps.

    Larger files are cut into ranges of BLOCK positions on the left.
    """
    docs = _docs(docs, file, side, pos, text)
    number = stage(docs.groupBy("_f").agg(F.count("*").alias("docs"), (F.floor(F.max("_pos") / BLOCK) + 1).cast("int").alias("a_blocks"), F.lit(1).alias("b_blocks")))
    rows = docs.join(number, "_f").withColumn("_b", F.lit(0))
    block = lambda p: F.floor(p / BLOCK).cast("int")
    a = rows.where("_side = 0").withColumn("_a", block(F.col("_pos")))
    b = rows.where("_side = 1").withColumn("_a", F.explode(F.sequence(F.greatest(F.lit(0), block(F.col("_pos") - most)), block(F.col("_pos")))))

    def run(name: pa.Array, i: pa.Array, j: pa.Array, a: list[str], b: list[str], u: tuple, v: tuple, grams: int) -> Iterator[pa.RecordBatch]:
        (ri, gi, wi), (rj, gj, wj) = u, v
        upto, ends = np.searchsorted(ri, np.arange(len(a) + 1)), np.searchsorted(rj, np.arange(len(b) + 1))
        at, own, place, found = {p: k for k, p in enumerate(j.to_pylist())}, np.zeros(grams), i.to_pylist(), []
        for k, p in enumerate(place):
            mine = slice(upto[k], upto[k + 1])
            own[gi[mine]] = wi[mine]
            for q in range(p, p + most + 1):
                if (c := at.get(q)) is not None:
                    theirs = slice(ends[c], ends[c + 1])
                    found.append((p, q, char_weight * float(own[gj[theirs]] @ wj[theirs]) + (1 - char_weight) * token_set_ratio(a[k], b[c], blanks=True) / 100))
            own[gi[mine]] = 0.0
        x, y, sims = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([name.take(pa.array(np.zeros(len(x), np.int64))), pa.array(x, pa.int32()), pa.array(y, pa.int32()), pa.array(sims, pa.float64())], [file, "i", "j", "sim"])

    return _fitted(docs, number, a, b, run, f"{file} {number.schema['_f'].dataType.simpleString()}, i int, j int, sim double")


def packed_matrix(docs: DataFrame, file: str, side: str, pos: str, text: str, char_weight: float = 0.7, rounded: bool = False) -> DataFrame:
    """The sims of matrix() between texts that aren't empty, all others being 0: file, i, j, sims, of which each row has the
    positions of a strip and its sims row by row, as numbers of cells would take several times the room. With rounded, sims
    are the bytes of to_bytes()."""

    def run(name: pa.Array, i: pa.Array, j: pa.Array, a: list[str], b: list[str], strips: Iterator) -> Iterator[pa.RecordBatch]:
        y, i, j, at = [set(t.split()) for t in b], i.to_pylist(), j.to_pylist(), -1
        packs = _packs([set(t.split()) for t in a])
        for r, c, cos in strips:
            n, m = cos.shape
            if c != at:
                at, ratios = c, np.zeros((len(a), m))
                for k in range(m):
                    for rows, words in packs if y[c + k] else []:
                        ratios[rows, k] = words.ratios(y[c + k]) / 100
            sims = (char_weight * cos + (1 - char_weight) * ratios[r : r + n]).ravel()
            yield pa.RecordBatch.from_arrays([name, pa.array([i[r : r + n]], pa.list_(pa.int32())), pa.array([j[c : c + m]], pa.list_(pa.int32())), pa.array([to_bytes(sims)], pa.binary()) if rounded else pa.ListArray.from_arrays(pa.array([0, len(sims)], pa.int32()), pa.array(sims))], [file, "i", "j", "sims"])

    # Such a pair of blocks is more work than one of cosines only, and the largest file should be more pairs than there are cores.
    return _products(docs, file, side, pos, text, False, run, f"{file} {docs.schema[file].dataType.simpleString()}, i array<int>, j array<int>, sims {'binary' if rounded else 'array<double>'}", max(1, BLOCK // 2))


def to_bytes(sims: np.ndarray) -> bytes:
    """Numbers from 0 to 1 rounded to 12 digits, five bytes each."""
    return np.rint(sims * 1e12).astype("<i8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def from_bytes(data: bytes) -> np.ndarray:
    whole = np.zeros((len(data) // 5, 8), np.uint8)
    whole[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return whole.view("<i8").ravel() / 1e12


def _packs(sets: list[set[str]]) -> list[tuple[np.ndarray, PackedWords]]:
    """The sets that aren't empty and their numbers, of about PACK characters at a time."""
    some = np.array([k for k, x in enumerate(sets) if x], dtype=np.int64)
    ends = np.cumsum([sum(map(len, sets[k])) + len(sets[k]) for k in some])
    return [(k, PackedWords([sets[x] for x in k])) for k in np.split(some, np.flatnonzero(np.diff(ends // PACK)) + 1) if len(k)]


def _placed(rows: DataFrame, file: str, pos: str, text: str, transcript: str, active: str) -> DataFrame:
    """file, pos, place (among the active rows of the file, or among the others), active, a, b: the texts as they are compared."""
    on = F.coalesce(active, F.lit(False))
    place = F.row_number().over(Window.partitionBy(file, on).orderBy(pos)) - 1
    # The texts are normalised behind the window, so one form of each is shuffled.
    told = rows.select(file, F.col(pos).alias("pos"), place.alias("place"), on.alias("active"), F.col(text).alias("said"), F.col(transcript).alias("raw"))
    return told.select(file, "pos", "place", "active", norm_reorder(F.col("said")).alias("a"), norm_reorder(F.col("raw")).alias("b"), "raw")


def _two_sides(a: DataFrame, b: DataFrame, file: str) -> DataFrame:
    """(file, side, pos, text) of two tables (file, pos, text)."""
    return a.select(file, F.lit(0).alias("side"), "pos", "text").unionByName(b.select(file, F.lit(1).alias("side"), "pos", "text"))


def diagonals(placed: DataFrame, file: str, max_shift: int = 3) -> DataFrame:
    """file, i, j, sim of active rows by place, for shifts j - i from 0 to max_shift; the fit is on active rows only."""
    on = placed.where("active")
    docs = _two_sides(on.select(file, F.col("place").alias("pos"), F.col("a").alias("text")), on.select(file, F.col("place").alias("pos"), F.col("b").alias("text")), file)
    return near_pairs(docs, file, "side", "pos", "text", max_shift)


def best_shift(sim: DataFrame, file: str, max_shift: int = 3) -> DataFrame:
    """A-02: file, shift, mean_sim of the diagonal j = i + shift that is most similar; equal ones prefer the smaller."""
    by = sim.where(F.col("j").between(F.col("i"), F.col("i") + max_shift)).groupBy(file, (F.col("j") - F.col("i")).alias("shift")).agg(F.avg("sim").alias("mean_sim"))
    best = F.max(F.struct(F.round("mean_sim", 12).alias("m"), (-F.col("shift")).alias("s"), F.col("mean_sim").alias("mean_sim"))).alias("b")
    return by.groupBy(file).agg(best).select(file, (-F.col("b.s")).alias("shift"), "b.mean_sim")


def assign(gain: np.ndarray, at: np.ndarray | None = None, columns: int | None = None) -> np.ndarray:
    """J-07: the column of each row in an assignment of greatest total gain (rows <= columns), by shortest paths. No gain is
    negative.

    With at, the gains are those of these ones of `columns` columns, and those of all others are 0. Columns without gains
    are left to the rows that get no other, in order. Paths start from the rows or from the columns, whichever are fewer: the
    more of the others stay free, the sooner a path ends. A gain whose transpose is contiguous is not copied if its columns are fewer.
    """
    gain = np.asarray(gain, float)
    n, m = gain.shape[0], gain.shape[1] if at is None else columns
    if n > m:
        raise ValueError("more rows than columns")
    of = np.arange(m) if at is None else np.asarray(at)
    some = gain.any(axis=0)
    if not some.all():
        of, gain = of[some], gain[:, some]
    out = np.full(n, -1)
    if n <= len(of):
        out[:] = of[_paths(np.ascontiguousarray(gain))]
    else:
        out[_paths(np.ascontiguousarray(gain.T))] = of
    left = np.ones(m, bool)
    left[out[out >= 0]] = False
    out[out < 0] = np.flatnonzero(left)[: np.count_nonzero(out < 0)]
    return out


def _paths(gain: np.ndarray) -> np.ndarray:
    """The column of each row in an assignment of greatest total gain, rows <= columns; all rows get one of these columns."""
    n, m = gain.shape
    out, row, v = np.full(n, -1), np.full(m, -1), np.zeros(m)
    if not n:
        return out
    u, first = -gain.max(axis=1), gain.argmax(axis=1)
    starts = []
    for i, j in enumerate(first.tolist()):
        if row[j] < 0:
            row[j], out[i] = i, j
        else:
            starts.append(i)
    least, way, open_v, r, closer = np.empty(m), np.empty(m, np.int64), np.empty(m), np.empty(m), np.empty(m, bool)
    for start in starts:
        least.fill(np.inf)
        open_v[:] = v
        i, so_far, seen, far = start, 0.0, [], []
        while True:
            # Columns that are done have an open_v of -inf and get no closer.
            np.add(gain[i], open_v, out=r)
            np.subtract(so_far - u[i], r, out=r)
            np.less(r, least, out=closer)
            np.copyto(least, r, where=closer)
            np.copyto(way, i, where=closer)
            j = int(least.argmin())
            so_far = least[j]
            i = int(row[j])
            if i < 0:
                break
            seen.append(j)
            far.append(so_far)
            least[j], open_v[j] = np.inf, -np.inf
        u[start] += so_far
        if seen:
            more = so_far - np.array(far)
            u[row[seen]] += more
            v[seen] -= more
        while True:
            i = int(way[j])
            row[j] = i
            j, out[i] = int(out[i]), j
            if i == start:
                break
    return out


def reordered(rows: DataFrame, file: str, pos: str, text: str, transcript: str, active: str, least_gain: float = 1e-3, max_shift: int = 3) -> tuple[DataFrame, DataFrame]:
    """Stage 5: (rows, summary).

    rows: file, pos, transcript; leftovers of active rows come as rows with pos NULL (U-01). summary: file, shift,
    mean_before, mean_after, applied. Active rows get the transcripts that suit them best, one each, from all rows of
    the file; the order is kept if nothing would change or the mean similarity would rise by less than least_gain.
    Means are of two fits of their own, on what active rows have before and after. Files without active rows stay.

    The assignment takes a file's matrix into one task, as it can't be parted; the similarities, which are most of the
    work, are spread over the cluster.
    """
    placed = stage(_placed(rows, file, pos, text, transcript, active), tidy=True)
    on = placed.where("active")
    # Both the shifts and the means read these few rows.
    before = stage(diagonals(placed, file, max_shift), tidy=True)
    shifts = best_shift(before, file, max_shift)
    means = before.where("i = j").groupBy(file).agg(F.avg("sim").alias("mean_before"))
    docs = _two_sides(on.select(file, "pos", F.col("a").alias("text")), placed.select(file, "pos", F.col("b").alias("text")), file)
    # Equal sims come out equal by the rounding, whatever the order in which they were added up.
    sim = packed_matrix(docs, file, "side", "pos", "text", rounded=True).withColumnRenamed(file, "_file")

    kind = rows.schema[file].dataType.simpleString()
    # Files without active rows have no shift and stay out. A file's own row comes before its strips, which are put into one table
    # as they come: neither they nor a copy of the table are held.
    here = lambda on: F.sort_array(F.collect_list(F.when(on, F.col("pos"))))
    sides = placed.groupBy(file).agg(here(F.col("active")).alias("i"), here(~F.col("active")).alias("j"), here(F.col("b") != "").alias("used")).join(shifts.select(file, "shift"), file)
    none = lambda t: F.lit(None).cast(t)
    heads = sides.select(F.col(file).alias("_file"), F.col("i").cast("array<int>").alias("i"), F.col("j").cast("array<int>").alias("j"), none("binary").alias("sims"), F.col("used").cast("array<int>").alias("used"), "shift")
    strips = sim.select("_file", "i", "j", "sims", none("array<int>").alias("used"), none("int").alias("shift"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None

        def picks() -> pa.RecordBatch:
            name, mine, columns, used, gain = held
            got = np.array(columns)[assign(gain, used, len(columns))] if mine else []
            return pa.RecordBatch.from_arrays([name.take(pa.array(np.zeros(len(mine), np.int64))), *(pa.array(c, pa.int32()) for c in (range(len(mine)), mine, got))], [file, "place", "to", "of"])

        for batch in batches:
            name, i, j, sims, used, shift = (batch.column(k) for k in ("_file", "i", "j", "sims", "used", "shift"))
            for k in range(batch.num_rows):
                if shift[k].is_valid:
                    if held:
                        yield picks()
                    mine, at = i[k].as_py(), shift[k].as_py()
                    columns = mine[at:] + mine[:at] + j[k].as_py()
                    x, y = {v: k for k, v in enumerate(mine)}, {v: k for k, v in enumerate(columns)}
                    # Texts that are empty gain nothing and have no columns of their own.
                    some = np.array(sorted(y[v] for v in used[k].as_py()), dtype=np.int64)
                    held = (name.slice(k, 1), mine, columns, some, np.zeros((len(some), len(mine))).T)
                else:
                    r, c = [x[v] for v in i[k].as_py()], np.searchsorted(held[3], [y[v] for v in j[k].as_py()])
                    held[4][np.ix_(r, c)] = from_bytes(sims[k].as_py()).reshape(len(r), len(c))
        if held:
            yield picks()

    together = heads.unionByName(strips).repartition(max(TASKS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "_file")
    picked = stage(together.sortWithinPartitions("_file", F.col("shift").isNull()).mapInArrow(run, f"{file} {kind}, place int, to int, of int"), tidy=True)
    given = picked.join(placed.select(file, F.col("pos").alias("of"), "b", "raw"), [file, "of"])
    after_docs = _two_sides(on.select(file, F.col("place").alias("pos"), F.col("a").alias("text")), given.select(file, F.col("place").alias("pos"), F.col("b").alias("text")), file)
    after = near_pairs(after_docs, file, "side", "pos", "text").groupBy(file).agg(F.avg("sim").alias("mean_after"))
    moved = picked.groupBy(file).agg(F.bool_or(F.col("to") != F.col("of")).alias("moved"))
    applied = (F.col("moved") | (F.col("shift") != 0)) & (F.col("mean_after") - F.col("mean_before") >= least_gain)
    summary = stage(shifts.join(means, file).join(after, file).join(moved, file).select(file, "shift", "mean_before", "mean_after", applied.alias("applied")), tidy=True)

    where = placed.join(summary.select(file, "applied"), file, "left").withColumn("applied", F.coalesce("applied", F.lit(False)))
    used = picked.select(file, F.col("of").alias("pos"), F.lit(True).alias("used"))
    got = given.select(file, F.col("to").alias("pos"), F.col("raw").alias("got"))
    whole = where.join(got, [file, "pos"], "left").join(used, [file, "pos"], "left")
    kept = F.when(~F.col("applied"), F.col("raw")).when(F.col("active"), F.col("got")).when(F.col("used").isNull(), F.col("raw"))
    left = whole.where("applied AND active AND used IS NULL").select(file, F.lit(None).cast("int").alias("pos"), F.col("raw").alias("transcript"))
    return whole.select(file, "pos", kept.alias("transcript")).unionByName(left), summary


def reordered_file(spark: SparkSession, source: str, target: str) -> str:
    """S-11, K-05, F-05: stage 5 of one CSV file with the columns text and transcript, and trans if there is one.

    Returns `reordered`, or why the file was copied as it is: it can't be read, lacks a column, has no row that counts,
    or nothing is gained. The other columns stay; leftovers come last, with their transcript only.
    """
    read = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "FAILFAST")
    try:
        df = stage(read.csv(source).withColumn("_at", F.monotonically_increasing_id()))
    except (PySparkException, Py4JJavaError):
        copy_file(spark, source, target)
        return "unreadable"
    why = ""
    if not {"text", "transcript"} <= set(df.columns):
        why = "a column is missing"
    else:
        # A file is one recording's index, which is numbered in one task.
        rows = stage(df.withColumn("_pos", F.row_number().over(Window.orderBy("_at"))).drop("_at").withColumn("_active", tolerant_bool(F.col("trans")) if "trans" in df.columns else F.lit(True)).withColumn("_file", F.lit("f")))
        got, summary = reordered(rows, "_file", "_pos", "text", "transcript", "_active")
        found = summary.collect()
        why = "no row counts" if not found else "" if found[0]["applied"] else "nothing is gained"
    if why:
        copy_file(spark, source, target)
        return why
    new = got.where("pos IS NOT NULL").select(F.col("pos").alias("_to"), F.col("transcript").alias("_new"))
    kept = rows.join(new, F.col("_pos") == F.col("_to")).withColumn("transcript", F.col("_new")).drop("_to", "_new")
    whole = kept.unionByName(got.where("pos IS NULL").select("transcript"), allowMissingColumns=True)
    write_csv(whole.orderBy(F.col("_pos").asc_nulls_last()).select(*[c for c in df.columns if c != "_at"]).coalesce(1), target)
    return "reordered"
