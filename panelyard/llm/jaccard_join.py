"""Links and components of documents whose word n-gram sets have a large Jaccard similarity.

A grouped prefix join, exact at every size:

1. Every document becomes the set of its distinct word n-grams (64-bit hashes). How many
   documents hold an n-gram is counted over all documents (``gram_counts``). In a set
   ordered by rising count, two sets that reach the threshold share an n-gram among the
   first n - ceil(threshold n) + 1. N-grams that one document alone holds come first and
   match nothing: a document whose whole prefix consists of them is done.
2. Documents with equal sets become one node, and nodes with the same prefix and size
   one group. The index of prefix n-grams holds groups, so a group counts once however
   many members it has. Pairs of groups must pass the size and the position filter.
3. ``with_links`` expands all these pairs of groups, and each group with itself, to pairs of their
   members, which are verified on their whole sets. These are the links, from which it takes
   how many a document has, and the components. A node stands for all documents with its
   set, which are linked without being paired. Of many near copies with sets of their own nearly
   all pairs are links, so their number grows with the square of such a group: pairs
   are written, never held, and a large block is dealt to several tasks.

``join`` wants components alone, where a pair that is already connected needs no test, and
finds them with fewer pairs:

4. A group's members are compared with one of them. Then each group is compared with one node
   of its blocks (the groups that share an n-gram) that is of another component, again
   and again while many of these pairs link: that connects near copies at one comparison
   for each and round, however many they are.
5. What is left is closed in rounds: of blocks that still hold several components, the
   pivots, of different components, are compared with every member of every group that
   passes their filters (size, position, and signatures of the sets, which bound their
   difference) and is not yet connected to them. A pivot is then done, so each pair that
   shares a prefix n-gram was tested or is connected. Later rounds take more pivots, so a
   block of unlike members does not need a round for each.

Of a large group of near copies, each copy is thus compared with a few others. Neither way
drops a candidate.

Defined results: texts without words (null and empty ones too) have no n-grams and are
linked with nothing; a text with fewer words than n is one n-gram, its whole sequence;
rows with equal texts and ids are one document and get equal results; a null id is
never the smallest of a component that holds another; an empty table gives an empty
result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.llm.components import roots
from panelyard.llm.frames import at, named, numbered, pick
from panelyard.llm.gram_counts import BATCH_BYTES, Counting, in_batches
from panelyard.llm.units import chunks
from panelyard.llm.wordhash import windows, word_hashes
from panelyard.session import staged


PART_BYTES = 1 << 20  # of text hashed at a time


def sets_of(column: pa.ChunkedArray | pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    out: list[np.ndarray] = []
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    for part in chunks(flat, PART_BYTES):
        hashes, counts = word_hashes(part)
        grams, numbers = windows(hashes, counts, size)
        a = b = 0
        for words, own in zip(counts.tolist(), numbers.tolist()):
            if own:
                out.append(np.unique(grams[a:a + own]))
            elif words:
                out.append(windows(hashes[b:b + words], np.array([words]), words)[0])
            else:
                out.append(np.zeros(0, np.uint64))
            a, b = a + own, b + words
    return out


def prefix_size(n: int, per_cent: int) -> int:
    return n - -(-per_cent * n // 100) + 1


_SIGNATURE_WORDS = 8


def signature(grams: np.ndarray) -> np.ndarray:
    """512 bits, each the parity of how many n-grams fall on it.

    Two signatures differ in at most as many bits as the sets differ in n-grams.
    """
    places = (grams & np.uint64(64 * _SIGNATURE_WORDS - 1)).astype(np.int64)
    odd = np.bincount(places, minlength=64 * _SIGNATURE_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _prefixes(batches: DataFrame, n: int, n_bytes: int, size: int, per_cent: int, key_type: str) -> DataFrame:
    """For each document its set's size and, where it may have a partner, digest, prefix and set."""
    def items(table: pa.Table) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *sets_of(table.column("text"), size)])

    # The order needs a count that is the same wherever an n-gram occurs, no more: n-grams that
    # share a short hash share a count, and a few that occur once look as if they did twice.
    counting = Counting(n, min(64, n_bytes.bit_length() + 12), items)

    def look_up(texts: pa.Table, answers: pa.Table) -> pa.Table:
        sets, sent = sets_of(texts.column("text"), size), set()
        rows: list[tuple] = []
        all_totals = counting.totals(np.concatenate([np.zeros(0, np.uint64), *sets]), answers)
        end = 0
        for own in sets:
            start, end = end, end + len(own)
            counts = all_totals[start:end]
            shared = np.flatnonzero(counts > 1)
            unshared = len(own) - len(shared)
            k = prefix_size(len(own), per_cent)
            if not len(own) or unshared >= k:
                rows.append((len(own), None, None, None, None, None))
                continue
            first = shared[np.argsort(counts[shared], kind="stable")[:k - unshared]]
            digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
            rows.append((len(own), digest, unshared, own[first].view(np.int64), signature(own),
                         None if digest in sent else own.view(np.int64)))
            sent.add(digest)
        columns = list(zip(*rows)) or [()] * 6
        types = [pa.int64(), pa.binary(), pa.int64(), *[pa.list_(pa.int64())] * 3]
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        return pa.table([texts.column("key"), texts.column("text_hash"), *arrays],
                        names=["key", "text_hash", "n", "digest", "unshared", "prefix", "bits", "grams"])

    return batches.groupBy("batch").cogroup(counting.repeated(batches).groupBy("batch")).applyInArrow(
        look_up, f"key {key_type}, text_hash bigint, n bigint, digest binary, unshared bigint, prefix array<bigint>, "
                 "bits array<bigint>, grams array<bigint>")


# Groups meet one node each for as long as at least one of so many such pairs links.
PAIRS_A_LINK = 4

# Groups of a block that one task pairs with the others.
SLICE_GROUPS = 512

# Pivots of a block in the first round, and how many times as many in each later one.
FIRST_PIVOTS, MORE_PIVOTS = 1, 8


def _blocks(groups: DataFrame) -> DataFrame:
    """Blocks of groups that share a prefix n-gram: ``token``, ``gid`` and the first place ``at``.

    Near copies share most of their prefix, so many n-grams are held by the very same groups.
    They are one block, named by 128 bits of its groups and their number; an n-gram of one
    group is none. The first place among them bounds the overlap no less than each one's own.
    """
    held = groups.select("gid", F.posexplode("prefix").alias("at", "gram"), "unshared").select(
        "gram", "gid", (F.col("at") + F.col("unshared")).alias("at"))
    holders = held.groupBy("gram").agg(
        F.count("*").alias("groups"), F.bit_xor(F.xxhash64("gid")).alias("g1"),
        F.bit_xor(F.xxhash64("gid", F.lit(7))).alias("g2")).where("groups > 1")
    return held.join(holders, "gram").groupBy(F.struct("g1", "g2", "groups").alias("token"), "gid").agg(
        F.min("at").alias("at"))


class _Search:
    """The nodes, groups and prefix index, and the filters of one join."""

    def __init__(self, found: DataFrame, per_cent: int):
        self.per_cent = per_cent
        some = found.where("digest is not null")
        # Only the first document of a batch with a set carries it.
        sets = some.where("grams is not null").dropDuplicates(["digest"])
        self.nodes = staged(sets.drop("key", "text_hash").withColumn(
            "id", F.monotonically_increasing_id()), "nodes")
        same = [F.xxhash64("n", "prefix").alias("g1"), F.xxhash64("prefix", "n", F.lit(7)).alias("g2")]
        plain = self.nodes.select("id", "n", "unshared", "prefix", "bits", *same)
        groups = staged(plain.groupBy("g1", "g2").agg(
            F.min("id").alias("gid"), *[F.first(c).alias(c) for c in ("n", "unshared", "prefix")],
            # The signature of a group of one; in others each member has its own.
            F.when(F.count("*") == 1, F.first("bits")).alias("bits")), "groups")
        self.members = staged(plain.select("id", "g1", "g2", "n", "bits").join(
            groups.select("g1", "g2", "gid"), ["g1", "g2"]).select("id", "gid", "n", "bits"), "members")
        self.index = staged(_blocks(groups).join(groups.select("gid", "n", "bits"), "gid"), "index")

    def may_match(self, a: str, b: str) -> Column:
        """Size and position filter of two index rows with the same n-gram."""
        na, nb, pa_, pb = (F.col(f"{side}.{c}") for c in ("n", "at") for side in (a, b))
        most = 1 + F.least(na - pa_ - 1, nb - pb - 1)
        return (100 * F.least(na, nb) >= self.per_cent * F.greatest(na, nb)) & (
            (100 + self.per_cent) * most >= self.per_cent * (na + nb))

    def may_link(self, a: str, b: str) -> Column:
        """Signature filter: how far two sets differ at least. True where one is unknown."""
        x, y = F.col(f"{a}.bits"), F.col(f"{b}.bits")
        apart = sum((F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(_SIGNATURE_WORDS)),
                    F.lit(0))
        close = (100 + self.per_cent) * apart <= (100 - self.per_cent) * (F.col(f"{a}.n") + F.col(f"{b}.n"))
        return F.coalesce(close, F.lit(True))

    def all_pairs(self, members: DataFrame) -> DataFrame:
        """Every pair of nodes a and b that may reach the threshold, once, with what ``members``
        says they hold: ``own_a`` and ``own_b``."""
        slices = F.ceil(F.col("token.groups") / SLICE_GROUPS)
        dealt = self.index.withColumn("slice", F.pmod(F.xxhash64("gid"), slices))
        copied = self.index.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)))
        near = dealt.alias("p").join(copied.alias("x"), (F.col("p.token") == F.col("x.token"))
                                     & (F.col("p.slice") == F.col("x.slice")) & (F.col("p.gid") < F.col("x.gid"))
                                     & self.may_match("p", "x") & self.may_link("p", "x"))
        near = staged(near.select(F.col("p.gid").alias("gid_a"), F.col("x.gid").alias("gid_b")).distinct(), "near")
        node = F.struct("id", "n", "bits", "own")
        a, b = (members.select(F.col("gid").alias(f"gid_{side}"), node.alias(side)) for side in "ab")
        across = near.join(a, "gid_a").join(b, "gid_b").select("a", "b")
        inside = members.select("gid", node.alias("a")).join(members.select("gid", node.alias("b")), "gid").where(
            "a.id < b.id").select("a", "b")
        return across.unionByName(inside).where(self.may_link("a", "b")).select(
            *[F.col(f"{side}.{c}").alias(name) for side in "ab" for c, name in (("id", side), ("own", f"own_{side}"))])

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The rows of ``pairs`` whose nodes a and b reach the threshold on their whole sets.

        The pairs are to be written before: where they are few, as in later rounds, the
        optimizer sends them to the sets and shuffles no sets.
        """
        own = self.nodes.select("id", "grams")
        met = pairs.join(own.toDF("b", "grams_b"), "b").join(own.toDF("a", "grams_a"), "a")
        both = F.size(F.array_intersect("grams_a", "grams_b"))
        either = F.size("grams_a") + F.size("grams_b") - both
        return met.where(100 * both >= self.per_cent * either).select(*pairs.columns)

    def single_pairs(self, state: DataFrame, turn: int) -> DataFrame:
        """Of each group and label one node, paired with one of another label that may match it.

        A block offers a node of its first label, and of the last one to the first, so the
        rows of a block become no more. Of what its blocks offer, a node takes what most of
        them do. Places of labels and nodes change with every turn; of two labels the one
        with more nodes is the more likely to come first, so the rest gathers around it.
        """
        one = F.struct("id", "bits")
        chance = (F.pmod(F.xxhash64("label", F.lit(turn)), F.lit(1 << 30)) + 1) / ((1 << 30) + 1)
        places = state.groupBy("label").agg((-F.log(chance) / F.count("*")).alias("place"))
        classes = state.groupBy("gid", "label").agg(F.min(one).alias("one")).join(places, "label") \
            .select("gid", "label", "place", "one.id", "one.bits")
        rows = staged(self.index.select("token", "gid", "n", "at").join(classes, "gid"), "offers")
        ends = F.struct("place", "label", F.xxhash64("id", F.lit(turn)).alias("order"), "id", "n", "at", "bits")
        offers = rows.groupBy("token").agg(F.min(ends).alias("first"), F.max(ends).alias("last")) \
            .where("first.label <> last.label")
        met = rows.join(offers, "token").select(
            F.struct("id", "label", "place", "n", "at", "bits").alias("x"),
            F.when(F.col("first.label") != F.col("label"), F.col("first")).otherwise(F.col("last")).alias("p"))
        likely = met.where(self.may_match("p", "x") & self.may_link("p", "x")).groupBy(
            F.struct("x.id", "x.label", "x.place").alias("x"),
            F.struct("p.order", "p.id", "p.label", "p.place").alias("p")).agg(F.count("*").alias("blocks"))
        best = likely.groupBy("x").agg(F.min(F.struct(-F.col("blocks"), "p")).alias("best"))
        return best.select(*[F.col(f"{side}.{c}").alias(f"{c}_{name}".removeprefix("id_")) for side, name in
                             (("best.p", "a"), ("x", "b")) for c in ("id", "label", "place")])

    def unsettled(self, state: DataFrame) -> DataFrame:
        """The index of groups with nodes that are not done, in blocks that hold several labels
        of such nodes; ``low`` and ``high`` are a group's least and greatest label of them."""
        spans = state.where("not done").groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        rows = self.index.join(spans, "gid")
        several = rows.groupBy("token").agg(F.min("low").alias("least"), F.max("high").alias("most")) \
            .where("least <> most").select("token")
        return rows.join(several, "token")

    def pivots(self, state: DataFrame, index: DataFrame, per_block: int) -> DataFrame:
        """Nodes to be compared next: of each block of the unsettled ``index``, the first nodes of
        its first ``per_block`` labels. Nodes that were pivots before do not count."""
        one = F.struct("id", "bits")
        classes = state.where("not done").groupBy("gid", "label").agg(F.min(one).alias("one"))
        blocks = index.join(classes, "gid").groupBy("token", "label").agg(
            F.min(F.struct("one", "gid")).alias("first"))
        ranked = blocks.selectExpr(
            "first.one.id", "first.gid", "first.one.bits", "label",
            "row_number() OVER (PARTITION BY token ORDER BY label) AS place")
        return ranked.where(F.col("place") <= per_block).select("id", "gid", "label", "bits").distinct()

    def candidates(self, pivots: DataFrame, state: DataFrame, index: DataFrame) -> DataFrame:
        """Pairs of a pivot with every node that may match it and has another label."""
        own = index.select("gid", "token", "n", "at")
        sides = pivots.join(own, "gid").select("id", "label", "bits", "token", "n", "at")
        other_label = (F.col("x.low") != F.col("p.label")) | (F.col("x.high") != F.col("p.label"))
        near = sides.alias("p").join(index.alias("x"), (F.col("p.token") == F.col("x.token")) & other_label
                                     & self.may_match("p", "x") & self.may_link("p", "x")).select(
            F.col("p.id").alias("a"), F.col("p.label").alias("label_a"), F.col("p.n").alias("n"),
            F.col("p.bits").alias("bits"), F.col("x.gid").alias("gid")).distinct()
        others = state.where("not done").select(
            "gid", "n", "bits", F.col("id").alias("b"), F.col("label").alias("label_b"))
        return near.alias("p").join(others.alias("x"), (F.col("p.gid") == F.col("x.gid"))
                                    & (F.col("label_a") != F.col("label_b")) & self.may_link("p", "x")).select(
            "a", "label_a", "b", "label_b")


def _relabelled(state: DataFrame, links: DataFrame, place: str = "label") -> DataFrame:
    """Linked labels become the first linked to them by ``place``, a step further where that
    moved too. Nodes with one label are connected, not always the other way round."""
    ends = links.select(*[F.struct(F.col(f"{place}_{x}").alias("place"), F.col(f"label_{x}").alias("label")).alias(x)
                          for x in "ab"])
    hooks = ends.select(F.greatest("a", "b")["label"].alias("from"), F.least("a", "b").alias("to")) \
        .groupBy("from").agg(F.min("to")["label"].alias("to"))
    further = hooks.select(F.col("from").alias("to"), F.col("to").alias("next"))
    hooks = hooks.join(further, "to", "left").select(
        F.col("from").alias("label"), F.coalesce("next", "to").alias("new"))
    return state.join(hooks, "label", "left").withColumn("label", F.coalesce("new", "label")).select(*state.columns)


def _done(state: DataFrame, pivots: DataFrame) -> DataFrame:
    was_pivot = pivots.select("id", F.lit(True).alias("pivot"))
    return state.join(was_pivot, "id", "left").withColumn(
        "done", F.col("done") | F.coalesce("pivot", F.lit(False))).select(*state.columns)


def _components(search: _Search) -> DataFrame:
    """``id`` and ``label`` of every node."""
    # Every member of a group against its first; who is linked takes that one's label.
    links = [staged(search.linked(staged(search.members.where("id <> gid").select(
        F.col("gid").alias("a"), F.col("id").alias("b")), "pairs")), "links")]
    state = staged(search.members.join(links[0], F.col("id") == F.col("b"), "left").select(
        "id", "gid", "n", "bits", F.coalesce("a", "id").alias("label"), F.lit(False).alias("done")), "state")
    for turn in count():
        pairs = staged(search.single_pairs(state, turn), "pairs")
        found = staged(search.linked(pairs), "links")
        links.append(found.select("a", "b"))
        state = staged(_relabelled(state, found, "place"), "state")
        if PAIRS_A_LINK * found.count() <= pairs.count():
            break
    per_block = FIRST_PIVOTS
    while True:
        index = staged(search.unsettled(state), "unsettled")
        pivots = staged(search.pivots(state, index, per_block), "pivots")
        if pivots.isEmpty():
            break
        found = staged(search.linked(staged(search.candidates(pivots, state, index), "pairs")), "links")
        links.append(found.select("a", "b"))
        state = staged(_done(_relabelled(state, found), pivots), "state")
        per_block *= MORE_PIVOTS

    # Links between nodes that still have different labels.
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    ends = [state.select(F.col("id").alias(side), F.col("label").alias(f"label_{side}")) for side in ("a", "b")]
    apart = staged(every.join(ends[0], "a").join(ends[1], "b").where("label_a <> label_b").select(
        F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct(), "apart")
    if apart.isEmpty():
        return state.select("id", "label")
    return state.join(roots(apart), F.col("label") == F.col("node"), "left").select(
        "id", F.coalesce("root", "label").alias("label"))


def _of_links(search: _Search, found: DataFrame) -> DataFrame:
    """``id``, ``label`` and ``n_links`` of every node, from all links."""
    # How many documents hold a node's set: pairs take that along.
    own = found.where("digest is not null").select("digest", "key", "text_hash").distinct().groupBy("digest").agg(
        F.count("*").alias("own"))
    members = staged(search.members.join(search.nodes.select("id", "digest").join(own, "digest").select(
        "id", "own"), "id"), "members")
    links = staged(search.linked(staged(search.all_pairs(members), "pairs")), "links")
    ends = links.select("a", "own_b").union(links.select("b", "own_a")).toDF("node", "others")
    others = ends.groupBy("node").agg(F.sum("others").alias("others"))
    linked = roots(links).join(others, "node")
    return staged(members.join(linked, F.col("id") == F.col("node"), "left").select(
        "id", F.coalesce("root", "id").alias("label"),
        (F.col("own") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "of_links")


def _found(documents: DataFrame, per_cent: int, size: int, id_col: str, text_col: str, batch_bytes: int) -> DataFrame:
    if not 0 < per_cent <= 100:
        raise ValueError(f"per_cent must be in 1..100, not {per_cent}")
    rows = pick(documents, id_col, text_col).toDF("key", "text")
    batches, n, n_bytes = in_batches(rows, batch_bytes)
    key_type = rows.schema["key"].dataType.simpleString()
    return staged(_prefixes(batches, n, n_bytes, size, per_cent, key_type), "prefixes")


def _documents_of(nodes: DataFrame, search: _Search, found: DataFrame, id_col: str) -> DataFrame:
    """What is known of nodes, by document: ``nodes`` has ``id``, ``label`` and maybe more columns."""
    more = [c for c in nodes.columns if c not in ("id", "label")]
    of_set = search.nodes.select("id", "digest").join(nodes, "id").select("digest", "label", *more)
    named = staged(found.select("key", "text_hash", "n", "digest").join(of_set, "digest", "left"), "labelled")
    least = named.where("label is not null").groupBy("label").agg(
        F.min("key").alias("component_id"),
        F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "text_hash")).alias("first"))
    alone = F.col("label").isNull()
    first = F.col("first.key").eqNullSafe(F.col("key")) & (F.col("first.text_hash") == F.col("text_hash"))
    return named.join(least, "label", "left").select(
        F.col("key").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(alone, F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | first).alias("stays"), "text_hash", *[F.coalesce(c, F.lit(0)).alias(c) for c in more])


def join(documents: DataFrame, per_cent: int = 90, size: int = 3, id_col: str = "doc_id",
         text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The id, ``n_shingles`` and ``component_id`` of every document, and which one stays.

    Documents are linked when the Jaccard similarity of their sets of ``size``-word n-grams
    is at least ``per_cent`` / 100. Of a component, ``stays`` marks the document with
    the smallest id (of equal ids, the one with the smallest ``text_hash``).
    """
    found = _found(documents, per_cent, size, id_col, text_col, batch_bytes)
    search = _Search(found, per_cent)
    return _documents_of(_components(search), search, found, id_col)


def with_links(documents: DataFrame, per_cent: int = 90, size: int = 3, id_col: str = "doc_id",
               text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """What ``join`` returns, and ``n_links``: with how many other documents each is linked.

    Every pair that may be a link is verified, also of documents that are connected anyway.
    """
    found = _found(documents, per_cent, size, id_col, text_col, batch_bytes)
    search = _Search(found, per_cent)
    return _documents_of(_of_links(search, found), search, found, id_col)


def representatives(documents: DataFrame, per_cent: int = 80, size: int = 5, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``documents``, all columns, with one document of each component."""
    gone = join(documents, per_cent, size, id_col, text_col).where("not stays").select(
        F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"))
    left = numbered(documents).join(gone, at(documents, id_col).eqNullSafe(F.col("_id"))
                                    & (F.xxhash64(at(documents, text_col)) == F.col("_hash")), "left_anti")
    return named(left, documents)
