"""Problem 2: parent-child links to full hierarchies.

Subtree sizes are added up towards the roots, every node gets a preorder range among its siblings by prefix sums
of their sizes, and the ranges are laid out downwards; a node's descendants are then those whose preorder number
lies in its range. Both passes move by distances of 1, 2, 4, ... links, so a tree of depth d takes log2(d) + 1
rounds. Nodes that no round reaches from a root are on a cycle or below one; each node on a cycle is then taken as the
root of what hangs on it, and the same passes number those trees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlattice.functions.timecode import code_ms
from voxlattice.operators.latest import latest
from voxlattice.operators.ordered import blocked_scan
from voxlattice.runtime import drop_stage, stage

#: Siblings with neighbouring numbers that one task sums up.
BLOCK = 4096


def _climb(nodes: DataFrame) -> DataFrame:
    """Upwards, from g, v, p: the ancestor at distance 2^k, the root and its depth once known, and the size of the subtree.

    In a round each node takes over what its ancestor knows and adds its size to it, in one join and one sum.
    """
    is_root = F.col("p").isNull()
    state = stage(nodes.select("g", "v", "p", F.col("p").alias("anc"), F.when(is_root, F.col("v")).alias("root"), F.when(is_root, F.lit(0)).alias("depth"), F.lit(1).cast("bigint").alias("size"), (~is_root).alias("new")))
    step = 1
    while state.where("new").limit(1).count():
        up = state.select(F.col("g").alias("ug"), F.col("v").alias("uv"), F.col("anc").alias("u_anc"), F.col("root").alias("u_root"), F.col("depth").alias("u_depth"))
        met = state.join(up, (F.col("g") == F.col("ug")) & (F.col("anc") == F.col("uv")), "left")
        found = F.col("root").isNull() & F.col("u_root").isNotNull()
        nothing = lambda kind: F.lit(None).cast(kind)
        own = F.struct("v", "p", F.col("u_anc").alias("anc"), F.coalesce("root", "u_root").alias("root"), F.coalesce("depth", F.col("u_depth") + step).alias("depth"), "size", found.alias("new"))
        above = F.struct(F.col("anc").alias("v"), nothing("bigint").alias("p"), nothing("bigint").alias("anc"), nothing("bigint").alias("root"), nothing("int").alias("depth"), "size", F.lit(False).alias("new"))
        told = met.select("g", F.explode(F.when(F.col("anc").isNull(), F.array(own)).otherwise(F.array(own, above))).alias("x")).select("g", "x.*")
        after = stage(told.groupBy("g", "v").agg(*[F.max(c).alias(c) for c in ("p", "anc", "root", "depth")], F.sum("size").alias("size"), F.max("new").alias("new")))
        drop_stage(state)
        state, step = after, step * 2
    return state


def _circles(lost: DataFrame) -> DataFrame:
    """g, v and circle, the least node of its cycle, of the nodes on cycles. lost: g, v, p, anc, all nodes on or below them.

    The ancestors at distance d of all nodes are those on the cycles as soon as d is no less than the longest way to one;
    the climb has made that distance so great for most.
    """
    same = (F.col("g") == F.col("bg")) & (F.col("far") == F.col("bv"))
    jump = stage(lost.select("g", "v", F.col("anc").alias("far")))
    while True:
        on = jump.select("g", F.col("far").alias("v")).distinct()
        kept = stage(lost.join(on, ["g", "v"]).select("g", "v", "p"))
        if kept.select("g", "p").distinct().count() == kept.count():
            break
        beyond = jump.select(F.col("g").alias("bg"), F.col("v").alias("bv"), F.col("far").alias("b_far"))
        after = stage(jump.join(beyond, same).select("g", "v", F.col("b_far").alias("far")))
        drop_stage(jump)
        drop_stage(kept)
        jump = after
    ring = stage(kept.select("g", "v", F.col("p").alias("far"), F.col("v").alias("circle"), F.lit(True).alias("moved")))
    drop_stage(jump)
    drop_stage(kept)
    while ring.where("moved").limit(1).count():
        beyond = ring.select(F.col("g").alias("bg"), F.col("v").alias("bv"), F.col("far").alias("b_far"), F.col("circle").alias("b_circle"))
        after = stage(ring.join(beyond, same).select("g", "v", F.col("b_far").alias("far"), F.least("circle", "b_circle").alias("circle"), (F.col("b_circle") < F.col("circle")).alias("moved")))
        drop_stage(ring)
        ring = after
    return ring.select("g", "v", "circle")


def _paths(trees: DataFrame) -> DataFrame:
    """g, v, path from the root, of nodes g, v, p, by joining the paths of ancestors at distances 1, 2, 4, ..."""
    state = stage(trees.select("g", "v", F.col("p").alias("anc"), F.array("v").alias("path")))
    while state.where("anc IS NOT NULL").limit(1).count():
        up = state.select(F.col("g").alias("ug"), F.col("v").alias("uv"), F.col("anc").alias("u_anc"), F.col("path").alias("u_path"))
        met = state.join(up, (F.col("g") == F.col("ug")) & (F.col("anc") == F.col("uv")), "left")
        after = stage(met.select("g", "v", F.col("u_anc").alias("anc"), F.when(F.col("anc").isNotNull(), F.concat("u_path", "path")).otherwise(F.col("path")).alias("path")))
        drop_stage(state)
        state = after
    return state.select(F.col("g").alias("yg"), F.col("v").alias("yv"), "path")


def hierarchy(links: DataFrame, group: str, node: str, parent: str, paths: bool = False) -> DataFrame:
    """group, node, parent, root, depth, pre, size, on_cycle and circle for each node of every tree, and path if asked for.

    path leads from the root to the node; the node's subtree has the preorder numbers pre to pre + size - 1, which
    count from 1 within the group. Nodes on a cycle of links, or below one, have on_cycle true and NULL in root,
    depth and path. Of them, those on the cycle itself have its least node in circle, which is NULL for all others; their
    pre and size are those of the tree that hangs on them, without the rest of the cycle. A parent that isn't a node of the group counts as none. Rows whose group or node
    is NULL are left out; of repeated nodes the one with the greatest parent counts; an empty table gives an
    empty one; other columns are dropped.
    """
    raw = links.select(F.col(group).alias("g"), F.col(node).cast("bigint").alias("v"), F.col(parent).cast("bigint").alias("p")).where("g IS NOT NULL AND v IS NOT NULL")
    nodes = raw.groupBy("g", "v").agg(F.max("p").alias("p"))
    known = nodes.select(F.col("g").alias("kg"), F.col("v").alias("kv"))
    state = _climb(nodes.join(known, (F.col("g") == F.col("kg")) & (F.col("p") == F.col("kv")), "left").select("g", "v", F.col("kv").alias("p")))
    trees = state.select("g", "v", "p", F.col("p").alias("cut"), "root", "depth", "size", F.lit(None).cast("bigint").alias("circle"))
    lost = state.where("root IS NULL").select("g", "v", "p", "anc")
    if lost.limit(1).count():
        lost = stage(lost)
        circles = stage(_circles(lost)).select(F.col("g").alias("rg"), F.col("v").alias("rv"), "circle")
        hung = lost.join(circles, (F.col("g") == F.col("rg")) & (F.col("v") == F.col("rv")), "left").select("g", "v", F.when(F.col("circle").isNull(), F.col("p")).alias("p"))
        grown = _climb(hung).select("g", "v", "p", "size")
        entire = grown.join(lost.select(F.col("g").alias("lg"), F.col("v").alias("lv"), F.col("p").alias("lp")), (F.col("g") == F.col("lg")) & (F.col("v") == F.col("lv")))
        entire = entire.join(circles, (F.col("g") == F.col("rg")) & (F.col("v") == F.col("rv")), "left")
        trees = trees.where("root IS NOT NULL").unionByName(entire.select("g", "v", F.col("lp").alias("p"), F.col("p").alias("cut"), F.lit(None).cast("bigint").alias("root"), F.lit(None).cast("int").alias("depth"), "size", "circle"))

    # Downwards: each node's offset in its parent's range, summed along the path.
    sized = trees.select("g", "v", F.col("cut").alias("anc"), "size", F.col("cut").isNull().alias("top"), F.coalesce("cut", F.lit(0)).alias("under"), F.floor(F.col("v") / BLOCK).alias("b"))
    placed = stage(blocked_scan(sized, ["g", "top", "under"], "b", "v", sums={"through": "size"}).select("g", "v", "anc", (F.col("through") - F.col("size") + 1).alias("pre")))
    while placed.where("anc IS NOT NULL").limit(1).count():
        up = placed.select(F.col("g").alias("ug"), F.col("v").alias("uv"), F.col("anc").alias("u_anc"), F.col("pre").alias("u_pre"))
        after = stage(placed.join(up, (F.col("g") == F.col("ug")) & (F.col("anc") == F.col("uv")), "left").select("g", "v", F.col("u_anc").alias("anc"), (F.col("pre") + F.coalesce("u_pre", F.lit(0))).alias("pre")))
        drop_stage(placed)
        placed = after

    full = trees.join(placed.select(F.col("g").alias("pg"), F.col("v").alias("pv"), "pre"), (F.col("g") == F.col("pg")) & (F.col("v") == F.col("pv")))
    if paths:
        full = full.join(_paths(trees.where("root IS NOT NULL")), (F.col("g") == F.col("yg")) & (F.col("v") == F.col("yv")), "left")
    kind = links.schema[node].dataType
    named = {group: F.col("g"), node: F.col("v").cast(kind), parent: F.col("p").cast(kind), "root": F.col("root").cast(kind), "depth": F.col("depth")} | ({"path": F.col("path")} if paths else {})
    return full.select(*[c.alias(n) for n, c in named.items()], "pre", "size", F.col("root").isNull().alias("on_cycle"), F.col("circle").cast(kind).alias("circle"))


#: Preorder numbers are cut into pieces of WIDE^level; a range is made of fewer than 2 * WIDE of each level but the last.
WIDE, LEVELS = 256, 4


def _pieces(a: Column, z: Column) -> Column:
    """The pieces (level, number) that a range from a to z consists of, none of which lie in a greater one of them."""
    out = []
    whole = lambda level: (F.ceil(a / F.lit(WIDE**level)), F.floor((z + 1) / F.lit(WIDE**level)))
    made = lambda level, low, high: F.when(low < high, F.transform(F.sequence(low, high - 1), lambda i: F.struct(F.lit(level).alias("level"), i.alias("piece")))).otherwise(F.array().cast("array<struct<level:int,piece:bigint>>"))
    for level in range(LEVELS):
        low, high = whole(level)
        if level + 1 == LEVELS:
            out.append(made(level, low, high))
            continue
        next_low, next_high = (x * WIDE for x in whole(level + 1))
        some = next_low < next_high
        out += [made(level, low, F.when(some, next_low).otherwise(high)), F.when(some, made(level, next_high, high)).otherwise(F.array().cast("array<struct<level:int,piece:bigint>>"))]
    return F.concat(*out)


def descendants(tree: DataFrame, group: str, node: str, of: DataFrame | None = None, circles: bool = False) -> DataFrame:
    """(group, node, descendant) by preorder ranges, of all nodes or of those in `of` (group, node).

    With circles, also of nodes on and below cycles: what is on a cycle has the other nodes on it and all that hangs on
    any of them, but not itself. Without, such nodes have no rows. The rows are as many as there are pairs. A range is
    cut into pieces of a few widths, so it is a short list however many nodes it holds, and the join on pieces is of
    equal keys with no pair too many.
    """
    tops = tree if circles else tree.where("NOT on_cycle")
    if of is not None:
        tops = tops.join(of.select(group, node).distinct(), [group, node], "left_semi")
    ranges = tops.where("size > 1").select(F.col(group).alias("dg"), F.col(node).alias("top"), (F.col("pre") + 1).alias("a"), (F.col("pre") + F.col("size") - 1).alias("z"))
    if circles:
        members = tree.where("circle IS NOT NULL").select(F.col(group).alias("mg"), F.col(node).alias("mv"), F.col("circle").alias("mc"), F.col("pre").alias("a"), (F.col("pre") + F.col("size") - 1).alias("z"))
        met = tops.select(F.col(group).alias("dg"), F.col(node).alias("top"), "circle").join(members, (F.col("dg") == F.col("mg")) & (F.col("circle") == F.col("mc")) & (F.col("top") != F.col("mv")))
        ranges = ranges.unionByName(met.select("dg", "top", "a", "z"))
    wanted = ranges.select("dg", "top", F.explode(_pieces(F.col("a"), F.col("z"))).alias("x")).select("dg", "top", "x.level", "x.piece")
    held = F.array(*[F.struct(F.lit(k).alias("level"), F.floor(F.col("pre") / F.lit(WIDE**k)).alias("piece")) for k in range(LEVELS)])
    nodes = tree.select(F.col(group).alias("ng"), F.col(node).alias("nv"), F.explode(held).alias("y")).select("ng", "nv", F.col("y.level").alias("n_level"), F.col("y.piece").alias("n_piece"))
    return nodes.join(wanted, (F.col("ng") == F.col("dg")) & (F.col("n_level") == F.col("level")) & (F.col("n_piece") == F.col("piece"))).select(F.col("dg").alias(group), F.col("top").alias(node), F.col("nv").alias("descendant"))


def whole_sizes(tree: DataFrame, group: str) -> DataFrame:
    """tree with the size of nodes on a cycle counting all that is on it or hangs on it."""
    rings = tree.where("circle IS NOT NULL").groupBy(F.col(group).alias("rg"), F.col("circle").alias("rc")).agg(F.sum("size").alias("ring"))
    return tree.join(rings, (F.col(group) == F.col("rg")) & (F.col("circle") == F.col("rc")), "left").withColumn("size", F.coalesce("ring", "size")).drop("rg", "rc", "ring")


def named_paths(tree: DataFrame, names: DataFrame, group: str, node: str, name: str) -> DataFrame:
    """tree with path_names, the names along the path in its order (NULL names keep their place)."""
    steps = tree.where("path IS NOT NULL").select(F.col(group).alias("sg"), F.col(node).alias("sv"), F.posexplode("path").alias("at", "step"))
    named = names.select(F.col(group).alias("ng"), F.col(node).cast("bigint").alias("nv"), F.col(name).alias("nm"))
    spelt = (
        steps.join(named, (F.col("sg") == F.col("ng")) & (F.col("step") == F.col("nv")), "left")
        .groupBy("sg", "sv")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "nm"))), lambda x: x["nm"]).alias("path_names"))
    )
    return tree.join(spelt, (F.col(group) == F.col("sg")) & (F.col(node) == F.col("sv")), "left").drop("sg", "sv")


def continuation_links(index: DataFrame) -> DataFrame:
    """recording_id, seg_no, parent_no, name of the latest version of each segment.

    A set `prev` names the parent (which may not exist: then there is none); else it is the segment whose `cont`
    means the same time as the segment's start code, of several the one with the greatest number.
    """
    parsed = index.select("recording_id", "seg_no", "prev", "name", "loaded_at", code_ms(F.col("start_code")).alias("start_ms"), code_ms(F.col("cont")).alias("cont_ms"))
    now = latest(parsed, ["recording_id", "seg_no"], ["start_ms", "cont_ms", "prev", "name"]).where("recording_id IS NOT NULL AND seg_no IS NOT NULL")
    target = now.where("cont_ms IS NOT NULL").groupBy("recording_id", "cont_ms").agg(F.max("seg_no").alias("from_no")).select(F.col("recording_id").alias("t_rec"), "cont_ms", "from_no")
    linked = now.drop("cont_ms").join(target, (F.col("recording_id") == F.col("t_rec")) & (F.col("start_ms") == F.col("cont_ms")), "left")
    return linked.select("recording_id", "seg_no", F.coalesce("prev", "from_no").cast("int").alias("parent_no"), "name")
