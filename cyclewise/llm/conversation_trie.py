"""Prefix trie of conversations: every distinct beginning is a node with its members, children, leaves and savings.

Turns are known by a 128-bit digest of role and text; texts are not shuffled.  Conversations are cut into layers of
``LAYER`` turns, so that no row grows with a conversation; a layer's key is the digest of the layer before it (its
root) and its turns.  Equal keys are one row.  Keys are dealt by range: a shard holds all that begin alike, but a
frequent beginning spreads over as many shards as it needs.  Each shard packs a double-array trie over
dense turn numbers and walks it for members and for sums over subtrees.  Nodes that other shards or layers
may hold too (those on a shard's first and last path, and on paths through a whole layer) are shared: their
aggregates are merged by digest, and sums over the tree of shared nodes go up by pointer doubling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclewise.llm.common import cut_lineage
from cyclewise.llm.double_array import DoubleArray

#: Turns of a layer.
LAYER = 128
#: Bytes of a turn's digest.
DIGEST = 16
#: Turn numbers that one task numbers together within a conversation.
TURN_RANGE = 1 << 16
#: The root of the first layer.
TOP = bytes(DIGEST)
EMPTY_SHA = hashlib.sha256().hexdigest()

NODES = ("key binary, parent_key binary, conv_id long, parent_conv_id long, depth long, n_convs long, n_children long, "
         "n_leaves long, saved long, bytes long, ends string")


def numbered_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as (conv_id, pos, digest, bytes) with 1-based positions, and the conversations (conv_id, n).

    Order: turn, null first; rows of one turn go by the digest of role and text.  Positions are offsets of ranges of
    turn numbers plus row numbers within them.  Rows without conv_id are in no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"),
        F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"), F.floor(F.col("turn") / F.lit(TURN_RANGE)).alias("_b"),
    )
    counts = rows.groupBy("conv_id", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy(F.col("_b").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("conv_id").alias("_c"), F.col("_b").alias("_b2"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    placed = rows.join(offsets, (F.col("conv_id") == F.col("_c")) & F.col("_b").eqNullSafe(F.col("_b2")))
    place = Window.partitionBy("conv_id", "_b").orderBy(F.col("turn").asc_nulls_first(), "digest")
    placed = placed.select("conv_id", (F.row_number().over(place) + F.col("_off")).alias("pos"), "digest", "bytes")
    return placed, counts.groupBy("conv_id").agg(F.sum("_n").alias("n"))


def borrowed(conv_id, group: int, most: int):
    """How many turns a conversation takes from the first of its group: crc32 of its decimal id modulo ``most``."""
    return F.pmod(F.crc32(conv_id.cast("string")), F.lit(most))


def rebuilt_turns(turns: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """(conv_id, pos, digest, bytes, n): the first h turns of conversation c - c % group, then c's own after its first h.

    h is :func:`borrowed`; n counts the rebuilt turns.  Each conversation has one more row with null ``pos``, so that
    those without turns are kept.
    """
    placed, convs = numbered_turns(turns)
    placed, convs = cut_lineage(placed, "trie-turns"), cut_lineage(convs, "trie-convs")
    c = F.col("conv_id")
    heads = convs.select(F.col("conv_id").alias("_p"), F.col("n").alias("_pn"))
    whole = convs.withColumn("_h", borrowed(c, group, most)).withColumn("_q", c - c % F.lit(group)).join(heads, F.col("_q") == F.col("_p"), "left")
    whole = whole.withColumn("_lent", F.least("_h", F.coalesce("_pn", F.lit(0))))
    whole = whole.select(c, (F.col("_lent") + F.greatest(F.col("n") - F.col("_h"), F.lit(0))).alias("n"), "_h", "_lent")
    own = placed.join(whole, "conv_id").filter(F.col("pos") > F.col("_h")).select(
        "conv_id", (F.col("pos") - F.col("_h") + F.col("_lent")).alias("pos"), "digest", "bytes", "n")
    near = F.array(*[F.try_add(c, F.lit(k).cast("long")) for k in range(1 - group, group)])
    first = placed.filter((c % group == 0) & (F.col("pos") < most))
    lent = first.select(F.explode(near).alias("_to"), c.alias("_from"), "pos", "digest", "bytes")
    lent = lent.filter((F.col("_to") - F.col("_to") % F.lit(group) == F.col("_from")) & (F.col("pos") <= borrowed(F.col("_to"), group, most)))
    lent = lent.join(whole.select(F.col("conv_id").alias("_known"), "n"), F.col("_to") == F.col("_known")).select(
        F.col("_to").alias("conv_id"), "pos", "digest", "bytes", "n")
    mark = whole.select("conv_id", *[F.lit(None).cast(t).alias(x) for x, t in (("pos", "long"), ("digest", "string"), ("bytes", "long"))], "n")
    return own.unionByName(lent).unionByName(mark)


def layer_rows(rebuilt: DataFrame, layer: int) -> DataFrame:
    """(conv_id, layer, key, bytes, ends): one row per conversation and layer, never longer than a layer.

    ``key`` is the layer's root and its turns' digests, ``bytes`` the turns' lengths, ``ends`` whether it is the last.
    """
    level = F.coalesce(F.floor((F.col("pos") - 1) / F.lit(layer)), F.lit(0)).cast("long")
    turn = F.when(F.col("pos").isNotNull(), F.struct("pos", "digest", "bytes"))
    rows = rebuilt.groupBy("conv_id", level.alias("layer")).agg(F.sort_array(F.collect_list(turn)).alias("_t"), F.max("n").alias("n"))
    rows = rows.select(
        "conv_id", "layer", F.unhex(F.array_join(F.transform("_t", lambda t: t["digest"]), "")).alias("turns"),
        F.transform("_t", lambda t: t["bytes"]).alias("bytes"),
        (F.col("n") <= (F.col("layer") + 1) * F.lit(layer)).alias("ends"),
    )
    rows = cut_lineage(rows, "trie-layers")
    top = F.lit(TOP)
    if rows.filter(F.col("layer") > 0).limit(1).count() == 0:
        return rows.select("conv_id", "layer", F.concat(top, "turns").alias("key"), "bytes", "ends")
    long = rows.filter(F.col("layer") > 0).select(F.col("conv_id").alias("_c")).distinct()
    parts = rows.join(long, F.col("conv_id") == F.col("_c"), "left_semi").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("layer", F.unhex(F.sha2("turns", 256)).alias("sha")))).alias("_s"))
    link = lambda root, sha: F.substring(F.unhex(F.sha2(F.concat(root, sha), 256)), 1, DIGEST)
    chain = F.aggregate("_s", F.array(top), lambda acc, x: F.concat(acc, F.array(link(F.element_at(acc, -1), x["sha"]))))
    roots = parts.select(F.col("conv_id").alias("_rc"), F.posexplode(chain).alias("_rl", "_root"))
    found = rows.join(roots.filter(F.col("_rl") > 0), (F.col("conv_id") == F.col("_rc")) & (F.col("layer") == F.col("_rl")), "left")
    return found.select("conv_id", "layer", F.concat(F.coalesce("_root", top), "turns").alias("key"), "bytes", "ends")


def _node_key(key: bytes, turns: int) -> bytes:
    """The digest of the node after so many turns of a layer's key."""
    root = key[:DIGEST]
    return hashlib.sha256(root + hashlib.sha256(key[DIGEST : DIGEST * (turns + 1)]).digest()).digest()[:DIGEST] if turns else root


class _Shard:
    """The distinct keys of one shard, in order, as they stream in: members, smallest id, digest of the ids that end."""

    def __init__(self):
        self.keys, self.layer, self.bytes, self.members, self.low, self.ends = [], [], [], [], [], []
        self._hash = None

    def add(self, pdf: pd.DataFrame) -> None:
        for key, layer, sizes, n, low, ids in zip(*(pdf[c] for c in ("key", "layer", "bytes", "n", "low", "ids")), strict=True):
            if not self.keys or key != self.keys[-1]:
                self.close()
                self.keys.append(bytes(key))
                self.layer.append(layer)
                self.bytes.append(np.asarray(sizes, np.int64))
                self.members.append(0)
                self.low.append(low)
            self.members[-1] += n
            self.low[-1] = min(self.low[-1], low)
            if ids:
                self._hash.update(ids.encode()) if self._hash else self._start(ids)

    def _start(self, ids: str) -> None:
        self._hash = hashlib.sha256(ids[1:].encode())

    def close(self) -> None:
        if self.keys:
            self.ends.append(self._hash.hexdigest() if self._hash else None)
        self._hash = None


def shard_nodes(shard: _Shard, layer: int) -> pd.DataFrame:
    """The nodes of one shard by its double-array trie.

    A node that only this shard holds has null ``key`` and final figures; ``parent_key`` is given where its parent is
    shared.  A shared one has its digest as ``key`` and figures of what only this shard holds below it.
    """
    count = len(shard.keys)
    length = np.array([len(k) // DIGEST for k in shard.keys], np.int64)
    parts = np.frombuffer(b"".join(shard.keys), ">u8").reshape(-1, 2).astype(np.uint64)
    start = np.r_[0, np.cumsum(length)]
    depth = np.arange(len(parts)) - np.repeat(start[:-1], length)
    owner = np.repeat(np.arange(count), length)
    sizes = np.concatenate([np.r_[0, b] for b in shard.bytes])
    # dense turn numbers in the order in which the levels show them: children of a node lie close together
    order = np.lexsort((parts[:, 1], parts[:, 0]))
    new = np.r_[True, (parts[order][1:] != parts[order][:-1]).any(axis=1)]
    name = np.empty(len(parts), np.int64)
    name[order] = np.cumsum(new) - 1
    by_level = np.lexsort((owner, depth))
    seen = np.full(int(name.max()) + 1, len(parts), np.int64)
    np.minimum.at(seen, name[by_level], np.arange(len(parts)))
    rank = np.empty(len(seen), np.int64)
    rank[np.argsort(seen)] = np.arange(len(seen))
    symbol = rank[name]
    cuts = np.searchsorted(depth[by_level], np.arange(int(length.max()) + 1))
    levels = [(owner[by_level[a:b]], symbol[by_level[a:b]]) for a, b in zip(cuts, cuts[1:], strict=False)]
    trie = DoubleArray.of(levels, count, len(seen))

    members, low = np.array(shard.members, np.int64), np.array(shard.low, np.int64)
    n = np.zeros(len(trie.check), np.int64)
    least = np.full(len(n), np.iinfo(np.int64).max)
    rep, size, ended = (np.full(len(n), v, np.int64) for v in (0, 0, -1))
    level_of = np.full(len(n), -1, np.int64)
    shared = np.zeros(len(n), bool)
    at = np.zeros(count, np.int64)
    full = (length == layer + 1) | (np.arange(count) == 0) | (np.arange(count) == count - 1)
    for d, (who, what) in enumerate(levels):
        at[who] = trie.step(at[who], what)
        slots = at[who]
        np.add.at(n, slots, members[who])
        np.minimum.at(least, slots, low[who])
        rep[slots], level_of[slots] = who, d
        size[slots] = sizes[start[who] + d]
        shared[slots[full[who]]] = True
        if d == 0:
            shared[slots] = True
        last = length[who] == d + 1
        ended[slots[last]] = who[last]
    nodes = np.flatnonzero(level_of >= 0)
    nodes = nodes[np.argsort(level_of[nodes], kind="stable")]
    parent = trie.check
    children, leaves, saved = (np.zeros(len(n), np.int64) for _ in range(3))
    for d in range(len(levels) - 1, -1, -1):
        here = nodes[np.searchsorted(level_of[nodes], d) : np.searchsorted(level_of[nodes], d, side="right")]
        here = here[~shared[here]]
        leaves[here] += children[here] == 0
        saved[here] += (n[here] - 1) * size[here]
        for total, part in ((children, 1), (leaves, leaves[here]), (saved, saved[here])):
            np.add.at(total, parent[here], part)
    keys = {s: _node_key(shard.keys[rep[s]], int(level_of[s])) for s in np.flatnonzero(shared).tolist()}
    own, up = shared[nodes], parent[nodes]
    rooted = level_of[nodes] == 0
    deep = np.array([shard.layer[r] for r in rep[nodes]], np.int64)
    twice = rooted & (deep > 0)  # a later layer's root: the layer before counts its members
    empty = pd.array([None] * len(nodes), dtype="Int64")
    out = pd.DataFrame({
        "key": [keys.get(s) for s in nodes.tolist()],
        "parent_key": [None if r else keys.get(p) for p, r in zip(up.tolist(), rooted.tolist(), strict=True)],
        "conv_id": pd.array(least[nodes], dtype="Int64"), "parent_conv_id": empty,
        "depth": deep * layer + level_of[nodes], "n_convs": np.where(twice, 0, n[nodes]),
        "n_children": children[nodes], "n_leaves": leaves[nodes], "saved": saved[nodes], "bytes": size[nodes],
        "ends": [shard.ends[e] if e >= 0 else None for e in ended[nodes].tolist()],
    })
    out.loc[twice, "conv_id"] = pd.NA
    alone = ~own & ~shared[up]
    out.loc[alone, "parent_conv_id"] = least[up[alone]]
    return out


def _shards(batches: Iterator[pd.DataFrame], layer: int) -> Iterator[pd.DataFrame]:
    shard = _Shard()
    for pdf in batches:
        shard.add(pdf)
    shard.close()
    if shard.keys:
        yield shard_nodes(shard, layer)


def merge_shared(parts: DataFrame, layer: int) -> DataFrame:
    """Shared nodes with their whole figures: parts added up by digest, then sums over the tree of shared nodes.

    In round k every node's sums go to its ancestor 2^k above, so that the rounds are the logarithm of the depth.
    """
    add = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    rest = [F.min("conv_id").alias("conv_id"), *[F.max(c).alias(c) for c in ("parent_key", "depth", "bytes", "ends")]]
    nodes = parts.groupBy("key").agg(*add, *rest)
    kids = nodes.filter(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("_k")).agg(F.count(F.lit(1)).alias("_kids"))
    nodes = nodes.join(kids, F.col("key") == F.col("_k"), "left").drop("_k")
    nodes = nodes.withColumn("n_children", F.col("n_children") + F.coalesce("_kids", F.lit(0))).drop("_kids")
    nodes = nodes.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
    nodes = nodes.withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes")).withColumn("_up", F.col("parent_key"))
    nodes = cut_lineage(nodes, "trie-shared")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        lift = nodes.filter(F.col("_up").isNotNull()).groupBy(F.col("_up").alias("_to")).agg(F.sum("n_leaves").alias("_l"), F.sum("saved").alias("_s"))
        over = nodes.select(F.col("key").alias("_ok"), F.col("_up").alias("_next"))
        nodes = nodes.join(lift, F.col("key") == F.col("_to"), "left").join(over, F.col("_up") == F.col("_ok"), "left")
        nodes = nodes.withColumn("n_leaves", F.col("n_leaves") + F.coalesce("_l", F.lit(0))).withColumn("saved", F.col("saved") + F.coalesce("_s", F.lit(0)))
        nodes = cut_lineage(nodes.withColumn("_up", F.col("_next")).drop("_to", "_l", "_s", "_ok", "_next"), "trie-shared")
    return nodes


def prefix_trie(turns: DataFrame, layer: int = LAYER) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations (:func:`rebuilt_turns`).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.  Null role or text is empty; rows without conv_id take no part;
    rows of one turn go by the digest of role and text, so repeated rows are as many turns; columns of
    other names are not read.  Without conversations there are no rows, not even a root.
    """
    spark = turns.sparkSession
    rows = layer_rows(rebuilt_turns(turns), layer)
    # ids of one key, joined in order by ranges of ids; a frequent key is one row per range
    dealt = rows.repartitionByRange("conv_id").withColumn("_part", F.spark_partition_id())
    ids = F.sort_array(F.collect_list(F.when(F.col("ends"), F.col("conv_id"))))
    keyed = dealt.groupBy("key", "_part").agg(
        F.first("layer").alias("layer"), F.first("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"),
        F.array_join(F.transform(ids, lambda i: F.concat(F.lit(","), i.cast("string"))), "").alias("ids"))
    keyed = cut_lineage(keyed, "trie-keys")
    shards = keyed.repartitionByRange("key").sortWithinPartitions("key", "_part")
    made = cut_lineage(shards.mapInPandas(lambda batches: _shards(batches, layer), NODES), "trie-nodes")
    shared = merge_shared(made.filter(F.col("key").isNotNull()), layer)
    tops = shared.select(F.col("key").alias("_pk"), F.col("conv_id").alias("_pc"))
    lone = made.filter(F.col("key").isNull())
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
           F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256")]
    inner = lone.filter(F.col("parent_key").isNull()).select(*out)
    below = lone.filter(F.col("parent_key").isNotNull()).drop("parent_conv_id")
    both = below.select(*below.columns).unionByName(shared.select(*below.columns))
    both = both.join(tops, F.col("parent_key") == F.col("_pk"), "left").withColumn("parent_conv_id", F.col("_pc")).select(*out)
    return inner.unionByName(both)
