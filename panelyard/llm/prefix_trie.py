"""Prefix trie of conversations, with sums over subtrees by centroid decomposition.

A node of the trie is a distinct sequence of first turns. Turns become two 64-bit hashes,
a prefix the exclusive or of the hashes of (place, turn), 128 bits in all, so prefixes of
any length are equal exactly if their keys are (but for chance of about n^2 / 2^129).
A node is named by its smallest member and its depth: the nodes of which a conversation
is the smallest member are the last ones of its path.

Sums over subtrees: the forest of parent edges is split at a centroid of each component,
a node below which at least half of the component lies, but below none of its children.
What lies below the centroid is summed, component by component, and added to every node from
the centroid up to the component's top; then the parts are split on. A component halves
each time, so there are log2(nodes) rounds at most, whatever the shape; chains of any
length and a top with a third of all nodes as children are one case. Components of
``together`` nodes or fewer are finished in one pass in which a task holds some of them
whole. Paths are found by the table (conversation, depth) -> node and never walked.

No group is gathered whole: the turns of a conversation are numbered by ranges, prefixes are
formed in blocks of turns, members of a node are listed in pieces of ids and hashed as a
stream.

Defined results: rows without ``conv_id`` belong to no conversation; turns are ordered by
``turn``, null first, those with equal turns by the hashes of role and text (repeated rows
are turns of their own); null roles and texts are empty; an empty table has no members and
so no node; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelyard.llm.frames import or_empty, pick
from panelyard.session import staged

BLOCK_TURNS = 4096
LISTED_IDS = 4096
TOGETHER = 20_000

NODE = ["conv_id", "depth"]
KEY = ["depth", "p1", "p2"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1), two hashes of the turn, and bytes of its text.

    Turns are dealt by ranges and numbered within a range; only conversations over several
    ranges need the numbers of the ranges before, at most one row per range.
    """
    role, text = or_empty(F.col("role")), or_empty(F.col("text"))
    narrow = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null").select(
        "conv_id", "turn", F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit("2"), text, role).alias("t2"), F.octet_length(text).alias("bytes"),
        F.monotonically_increasing_id().alias("row"))
    order = ["turn", "t1", "t2", "row"]
    dealt = staged(narrow.repartitionByRange("conv_id", *order)
                   .withColumn("range", F.spark_partition_id()), "turns_by_range")
    by_conv = Window.partitionBy("conv_id").orderBy("range")
    counts = dealt.groupBy("conv_id", "range").count().withColumn(
        "before", F.sum("count").over(by_conv) - F.col("count"))
    within = Window.partitionBy("range", "conv_id").orderBy(*order)
    return dealt.withColumn("n", F.row_number().over(within)).join(
        counts.where("before > 0").select("conv_id", "range", "before"), ["conv_id", "range"], "left") \
        .select("conv_id", (F.col("n") + F.coalesce("before", F.lit(0))).alias("place"), "t1", "t2", "bytes")


def borrowed_starts(turns: DataFrame, lender: Column, n_lent: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation with the first turns of another in place of its own first turns.

    ``lender`` and ``n_lent`` (at most ``most``) are expressions of ``conv_id``. All of the lender's
    turns are taken if it has fewer, none if it is absent; the own turns after the first
    ``n_lent`` follow. Returns the turns, with ``depth`` and the number ``turns`` of all, and
    one row for each conversation, turnless ones too.
    """
    turns = staged(turns, "turns")
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    plan = convs.withColumn("lender", lender).withColumn("n_lent", n_lent).join(
        convs.select(F.col("conv_id").alias("lender"), F.col("own").alias("there")), "lender", "left")
    taken = F.least("n_lent", F.coalesce("there", F.lit(0)))
    plan = staged(plan.select("conv_id", "lender", "n_lent", taken.alias("taken"), (
        taken + F.greatest(F.col("own") - F.col("n_lent"), F.lit(0))).alias("turns")), "conversations")
    values = ["turns", "t1", "t2", "bytes"]
    own = turns.join(plan, "conv_id").where("place > n_lent").select(
        "conv_id", (F.col("taken") + F.col("place") - F.col("n_lent")).alias("depth"), *values)
    first = turns.where(F.col("place") <= most).withColumnRenamed("conv_id", "lender")
    lent = plan.join(first, "lender").where("place <= n_lent").select(
        "conv_id", F.col("place").alias("depth"), *values)
    return own.unionByName(lent), plan.select("conv_id", "turns")


def with_prefixes(turns: DataFrame) -> DataFrame:
    """Adds the keys p1, p2 of the prefix that a turn ends and q1, q2 of the one before."""
    marked = turns.withColumns({
        "g1": F.xxhash64("depth", "t1", "t2"), "g2": F.xxhash64("t2", "depth", "t1"),
        "block": F.expr(f"(depth - 1) div {BLOCK_TURNS}")})
    within = Window.partitionBy("conv_id", "block").orderBy("depth")
    keyed = marked.withColumns({"p1": F.bit_xor("g1").over(within), "p2": F.bit_xor("g2").over(within)})
    # What the blocks before add, for conversations of several blocks.
    long_ = F.col("turns") > BLOCK_TURNS
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = marked.where(long_).groupBy("conv_id", "block").agg(
        F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2")).select(
        "conv_id", "block", *[F.coalesce(F.bit_xor(x).over(earlier), F.lit(0)).alias(y)
                              for x, y in (("x1", "b1"), ("x2", "b2"))])
    whole = keyed.where(~long_).unionByName(
        keyed.where(long_).join(before, ["conv_id", "block"]).withColumns({
            "p1": F.col("p1").bitwiseXOR(F.col("b1")), "p2": F.col("p2").bitwiseXOR(F.col("b2"))}).drop("b1", "b2"))
    return whole.withColumns({"q1": F.col("p1").bitwiseXOR(F.col("g1")), "q2": F.col("p2").bitwiseXOR(F.col("g2"))}) \
        .select("conv_id", "turns", *KEY, "q1", "q2", "bytes")


def trie_nodes(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: names of the node and its parent, members, children, bytes."""
    found = prefixes.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"),
        F.min("q1").alias("q1"), F.min("q2").alias("q2"))
    root = convs.groupBy().agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")) \
        .where("n_convs > 0").select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("p1"),
                                     F.lit(0).cast("long").alias("p2"), "conv_id", "n_convs",
                                     F.lit(0).alias("bytes"), F.lit(None).cast("long").alias("q1"),
                                     F.lit(None).cast("long").alias("q2"))
    found = staged(found.withColumn("depth", F.col("depth").cast("long")).unionByName(root), "nodes")
    children = found.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    parents = found.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"),
                           F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    return found.join(children, KEY, "left").join(parents, ["depth", "q1", "q2"], "left").select(
        *KEY, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "bytes")


def _listed_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids of each node, ascending and joined by commas.

    Ids are listed in pieces of neighbouring numbers; the pieces of a node pass one by one
    through a running hash.
    """
    pieces = ends.groupBy(*NODE, F.floor(F.col("member") / LISTED_IDS).alias("piece")).agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list("member")), lambda x: x.cast("string")))
        .alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, out = None, None, []
        for batch in batches:
            for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids"))):
                if (conv, depth) != now:
                    if now:
                        out.append((*now, digest.hexdigest()))
                    now, digest = (conv, depth), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _digest_batch(out)
            out = []
        yield _digest_batch(out + ([(*now, digest.hexdigest())] if now else []))

    dealt = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece")
    return dealt.mapInArrow(run, "conv_id long, depth long, ends_sha256 string")


def _digest_batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    convs, depths, digests = zip(*rows) if rows else ((), (), ())
    return pa.record_batch([pa.array(convs, pa.int64()), pa.array(depths, pa.int64()),
                            pa.array(digests, pa.string())], names=["conv_id", "depth", "ends_sha256"])


# Centroid decomposition

def rolled_up(nodes: DataFrame, paths: DataFrame, values: list[str], together: int = TOGETHER) -> DataFrame:
    """``conv_id``, ``depth`` and, under the same names, the sum of each value over the subtree.

    ``nodes`` has the name of each node, its parent's ``parent_conv_id``, the name ``top_conv``,
    ``top_depth`` of the tree's top, ``size`` (nodes of the subtree) and the values. ``paths``
    has for a conversation and a depth the ``owner`` of the node there and ``parent_owner``, for
    every conversation that names a node and every depth up to its end.
    """
    top = ["top_conv", "top_depth"]
    sums = [f"sum_{v}" for v in values]
    state = nodes.select(*NODE, "parent_conv_id", *top, "size", *values,
                         *[F.lit(0).cast("long").alias(s) for s in sums])
    split, small = [], []
    while True:
        state = staged(state, "components")
        totals = state.groupBy(*top).agg(F.max("size").alias("total")).where(F.col("total") > together)
        centroids = state.join(totals, top).where("2 * size >= total").groupBy(*top).agg(
            F.min_by(F.struct(*NODE, "size"), "size").alias("c")).select(
            *top, F.col("c.conv_id").alias("c_conv"), F.col("c.depth").alias("c_depth"),
            F.col("c.size").alias("c_size"))
        centroids = staged(centroids, "centroids")
        small.append(state.join(centroids.select(*top), top, "left_anti"))
        if centroids.isEmpty():
            break
        # The node below the centroid that a node's path goes through, if it does.
        via = paths.select("conv_id", (F.col("depth") - 1).alias("c_depth"), F.col("owner").alias("via"),
                           F.col("parent_owner").alias("above"))
        below = F.coalesce((F.col("depth") > F.col("c_depth")) & (F.col("above") == F.col("c_conv")), F.lit(False))
        placed = staged(state.join(centroids, top).join(via, ["conv_id", "c_depth"], "left")
                        .withColumn("below", below).drop("above"), "split_components")
        is_centroid = (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
        under = placed.where(F.col("below") | is_centroid).groupBy(*top).agg(
            *[F.sum(v).alias(f"under_{v}") for v in values])
        up = centroids.join(under, top).join(paths.withColumnRenamed("conv_id", "c_conv"), "c_conv").where(
            "depth between top_depth and c_depth").select(
            F.col("owner").alias("conv_id"), "depth", F.col("c_size").alias("less"),
            *[f"under_{v}" for v in values])
        added = [(F.col(s) + F.coalesce(f"under_{v}", F.lit(0))).alias(s) for s, v in zip(sums, values)]
        done = placed.join(up, NODE, "left").select(
            *NODE, "parent_conv_id",
            F.when(F.col("below"), F.col("via")).otherwise(F.col("top_conv")).alias("top_conv"),
            F.when(F.col("below"), F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
            (F.col("size") - F.coalesce("less", F.lit(0))).alias("size"), *values, *added,
            is_centroid.alias("is_centroid"))
        done = staged(done, "summed_components")
        split.append(done.where("is_centroid").select(*NODE, *sums))
        state = done.where("not is_centroid").drop("is_centroid")
    rest = small[0]
    for part in small[1:]:
        rest = rest.unionByName(part)
    found = _finished(rest, values)
    for part in split:
        found = found.unionByName(part)
    return found.select(*NODE, *[F.col(s).alias(v) for s, v in zip(sums, values)])


def _finished(components: DataFrame, values: list[str]) -> DataFrame:
    """The same for components that a task can hold, several at a time."""
    sums = [f"sum_{v}" for v in values]
    schema = "conv_id long, depth long, " + ", ".join(f"{s} long" for s in sums)

    def finish(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        get = lambda name: rows.column(name).to_numpy()
        conv, depth, size = get("conv_id"), get("depth"), get("size")
        component = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, rows.num_rows)))
        parent = _parents(component, conv, depth, rows.column("parent_conv_id").fill_null(0).to_numpy(),
                          (conv == get("top_conv")) & (depth == get("top_depth")))
        found = subtree_sums(parent, size, [get(v) for v in values])
        return pa.record_batch([pa.array(conv), pa.array(depth)] + [
            pa.array(get(s) + f) for s, f in zip(sums, found)], names=["conv_id", "depth", *sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = pa.concat_tables([*([held] if held else []), pa.Table.from_batches([batch])])
            starts = _component_starts(held)
            if len(starts) > 1:  # the last component may go on in the next batch
                yield finish(held.slice(0, int(starts[-1])), starts[:-1])
                held = held.slice(int(starts[-1])).combine_chunks()
        if held and held.num_rows:
            yield finish(held, _component_starts(held))

    top = ["top_conv", "top_depth"]
    return components.repartition(*top).sortWithinPartitions(*top).mapInArrow(run, schema)


def _component_starts(rows: pa.Table) -> np.ndarray:
    conv, depth = rows.column("top_conv").to_numpy(), rows.column("top_depth").to_numpy()
    return np.flatnonzero(np.append(len(conv) > 0, (conv[1:] != conv[:-1]) | (depth[1:] != depth[:-1])))


def _parents(component: np.ndarray, conv: np.ndarray, depth: np.ndarray, parent_conv: np.ndarray,
             is_top: np.ndarray) -> np.ndarray:
    """The place of each node's parent, -1 for tops."""
    n = len(conv)
    # A node stands right before those whose parent it is.
    order = np.lexsort((np.repeat([0, 1], n), np.concatenate([conv, parent_conv]),
                        np.concatenate([depth, depth - 1]), np.tile(component, 2)))
    is_node = order < n
    last = np.maximum.accumulate(np.where(is_node, np.arange(2 * n), 0))
    parent = np.full(n, -1, np.int64)
    parent[order[~is_node] - n] = order[last[~is_node]]
    parent[is_top] = -1
    return parent


def subtree_sums(parent: np.ndarray, size: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """Sums over subtrees of a forest, by centroid decomposition of all its trees at once.

    ``size`` has the nodes of each subtree. Who lies below whom is read from places in a
    walk from the top: a subtree is an unbroken stretch of it.
    """
    n = len(parent)
    order = np.argsort(parent, kind="stable")  # siblings together
    before = np.cumsum(size[order]) - size[order]
    first = np.append(True, parent[order][1:] != parent[order][:-1])
    before -= np.maximum.accumulate(np.where(first, before, 0))
    walk = np.empty(n, np.int64)
    walk[order] = before
    walk[parent >= 0] += 1
    up = parent.copy()
    while (up >= 0).any():  # twice the distance each time
        moved = np.flatnonzero(up >= 0)
        walk[moved], up[moved] = walk[moved] + walk[up[moved]], up[up[moved]]
    end, size = walk + size, size.copy()
    top = np.where(parent >= 0, parent, np.arange(n))
    while (top[top] != top).any():
        top = top[top]
    sums = [np.zeros(n, np.int64) for _ in values]
    alive = np.arange(n)
    while len(alive):
        own = top[alive]
        half = alive[2 * size[alive] >= size[own]]
        best = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(best, top[half], size[half])
        chosen = half[size[half] == best[top[half]]]
        centroid = np.empty(n, np.int64)
        centroid[top[chosen]] = chosen
        c = centroid[own]
        inside = (walk[alive] >= walk[c]) & (walk[alive] < end[c])  # the centroid and what is below
        above = (walk[alive] <= walk[c]) & (walk[c] < end[alive])  # the centroid and its way up
        for value, total in zip(values, sums):
            under = np.zeros(n, np.int64)
            np.add.at(under, own[inside], value[alive[inside]])
            total[alive[above]] += under[own[above]]
        strictly = above & (alive != c)
        size_c = size[c]
        size[alive[strictly]] -= size_c[strictly]
        # Children of centroids are the tops of what lies below; places are told apart by
        # component, since one component may lie inside the stretch of another.
        place = own * (n + 1) + walk[alive]
        lower = inside & (alive != c)
        child = np.flatnonzero(lower & (parent[alive] == c))
        child = child[np.argsort(place[child])]
        top[alive[lower]] = alive[child[np.searchsorted(place[child], place[lower], side="right") - 1]]
        alive = alive[alive != c]
    return sums


def trie(conversations: DataFrame, lender: Column, n_lent: Column, most_lent: int,
         together: int = TOGETHER) -> DataFrame:
    """One row per node of the trie of conversations with borrowed starts.

    ``n_leaves`` and ``saved_bytes`` are sums over the subtree; ``saved_bytes`` of one node are
    the bytes of its last text for each member but one.
    """
    turns, convs = borrowed_starts(ordered_turns(conversations), lender, n_lent, most_lent)
    prefixes = staged(with_prefixes(turns), "prefixes")
    nodes = staged(trie_nodes(prefixes, convs), "named_nodes")
    whole = nodes.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    root, n_nodes = whole[0], whole[1]
    members = staged(prefixes.select("conv_id", "turns", *KEY).join(
        nodes.select(*KEY, F.col("conv_id").alias("owner"), F.col("parent_conv_id").alias("parent_owner")),
        KEY).select("conv_id", "depth", "turns", "owner", "parent_owner"), "members")
    # The nodes that a conversation names are those behind the first ``shared`` turns.
    naming = members.where("owner = conv_id").groupBy("conv_id").agg(
        (F.min("depth") - 1).alias("shared"), F.first("turns").alias("turns"))
    inner = members.drop("turns").join(naming, "conv_id")
    names_root = naming.where(F.col("conv_id") != F.lit(root)).select("conv_id").unionByName(
        nodes.where("depth = 0").select("conv_id"))
    paths = staged(inner.select("conv_id", "depth", "owner", "parent_owner", "shared", "turns").unionByName(
        names_root.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(root).alias("owner"),
                          F.lit(None).cast("long").alias("parent_owner")), allowMissingColumns=True), "paths")
    sizes = paths.where("depth > 0").groupBy(F.col("owner").alias("conv_id"), "depth").agg(
        F.sum(F.col("turns") - F.greatest(F.col("shared"), F.col("depth") - 1)).alias("size"))
    own = nodes.join(sizes, NODE, "left").select(
        *NODE, "parent_conv_id", F.lit(root).alias("top_conv"), F.lit(0).cast("long").alias("top_depth"),
        F.coalesce("size", F.lit(n_nodes)).cast("long").alias("size"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).cast("long").alias("saved_bytes"))
    sums = rolled_up(own, paths.select("conv_id", "depth", "owner", "parent_owner"),
                     ["n_leaves", "saved_bytes"], together)
    ends = members.where("depth = turns").select(
        F.col("owner").alias("conv_id"), "depth", F.col("conv_id").alias("member")).unionByName(
        convs.where("turns = 0").select(F.lit(root).alias("conv_id"), F.lit(0).cast("long").alias("depth"),
                                        F.col("conv_id").alias("member")))
    return nodes.join(sums, NODE).join(_listed_digests(ends), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
