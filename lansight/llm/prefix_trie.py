"""Prefix tries of conversations, packed as double arrays per prefix shard.

A conversation is the sequence of its turns, a turn the 128-bit hash of (role, text) and the turn's
number of words.  Conversations that are equal turn by turn are folded first.  The distinct sequences
are range-partitioned in their own order into *prefix shards*: however common a prefix is, its
conversations spread over as many shards as they need.

A task numbers the turns of its shard densely and packs the shard's trie into two arrays: the child of
node ``s`` by turn ``c`` is ``t = base[s] + c`` if ``check[t] == s``.  Walking every sequence through
the arrays gives the nodes and their aggregates.

Nodes along the border of two shards (a prefix of the last sequence of one and the first of the next)
are met by both.  Every shard knows the last sequence of the shard before, so a node is counted as new
by one shard only, and a node that the shard before took for a leaf is taken back.  All partial sums
then add up: shared nodes are summed globally by their prefix's hash, all others are final in their
shard.  There are at most two paths of shared nodes a shard.

Defined results: a null role or text is empty; turns are in the order of turn (null first), then role
and text, so repeated rows are turns of their own; a null conv_id is one conversation with itself alone
as donor, a member without a number (its ``conv_id`` is null where it is the only member, its decimal
id the empty text, first in order); an empty table has no nodes, not even a root; other columns are
dropped.

Bounds: a conversation's turns are one row of 24 bytes a turn; the ids that end at a node come in rows
of at most ``id_chunk`` and are hashed as a stream; a task holds one shard, of about ``turns_per_shard``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lansight.llm.common import count_words, materialize, mix64, ship, within
from lansight.session import scratch_path

ship(__name__)

#: Longs that describe a turn: two halves of its hash, its words.
WIDTH = 3


@dataclass(frozen=True)
class TrieRules:
    turns_per_shard: int = 2_000_000
    #: Shards at least; None takes the session's shuffle partitions.
    shards: int | None = None
    id_chunk: int = 4096
    #: Shared nodes up to which their table is broadcast.
    broadcast_nodes: int = 200_000


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq): every conversation's turns in order, WIDTH longs a turn."""
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                 F.coalesce("text", F.lit("")).alias("text"))
    numbered = turns.select(
        "conv_id", F.row_number().over(Window.partitionBy("conv_id").orderBy(
            F.asc_nulls_first("turn"), "role", "text")).alias("i"),
        F.xxhash64("role", F.lit(1), "text").alias("h1"), F.xxhash64("text", F.lit(2), "role").alias("h2"),
        count_words(F.col("text")).alias("words"))
    listed = F.array_sort(F.collect_list(F.struct("i", "h1", "h2", "words")))
    return numbered.groupBy("conv_id").agg(listed.alias("turns")).select(
        "conv_id", F.flatten(F.transform("turns", lambda t: F.array(t["h1"], t["h2"], t["words"]))).alias("seq"))


def rebuilt(own: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """The first h turns of the conversation that leads c's group, then c's own after its first h;
    h is the hash of c modulo ``most``."""
    h = (F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % most).cast("int")
    lead = own.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("lead"), F.slice("seq", 1, WIDTH * (most - 1)).alias("head"))
    none = F.slice("seq", 1, 0)
    return own.withColumn("h", h).withColumn("lead", F.col("conv_id") - F.col("conv_id") % group) \
        .join(lead, "lead", "left") \
        .select("conv_id", F.when(F.col("conv_id").isNull(), F.col("seq")).otherwise(F.concat(
            F.slice(F.coalesce("head", none), F.lit(1), F.col("h") * WIDTH),
            F.slice("seq", F.col("h") * WIDTH + 1, F.greatest(F.size("seq"), F.lit(1))))).alias("seq"))


def folded(members: DataFrame, rules: TrieRules) -> DataFrame:
    """(seq, chunk, n, first, ids): equal sequences together, their members' decimal ids in order,
    at most ``id_chunk`` a row."""
    chunk = F.floor(F.col("conv_id") / rules.id_chunk)
    ids = F.array_sort(F.collect_list(F.col("conv_id")))
    return members.groupBy("seq", chunk.alias("chunk")).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("first"),
        F.array_join(F.transform(ids, lambda i: i.cast("string")), ",").alias("ids"))


class DoubleArray:
    """A trie over dense turn ids in two arrays.  Node 1 is the root; 0 is no node."""

    def __init__(self, offsets, turns, n_turns: int):
        """``turns`` holds all sequences one after the other, sequence i at offsets[i]:offsets[i + 1];
        the sequences are sorted and differ."""
        import numpy as np

        self.np = np
        self.base, self.check = np.zeros(2, np.int64), np.array([0, -1], np.int64)
        self.dense = np.full(n_turns, -1, np.int64)  # numbers in the order of first use, so siblings are close
        self.n_dense = 0
        lengths = np.diff(offsets)
        at, state, depth = np.arange(len(lengths)), np.ones(len(lengths), np.int64), 0
        while True:
            longer = lengths[at] > depth
            at, state = at[longer], state[longer]
            if not len(at):
                break
            turn = turns[offsets[at] + depth]
            # sorted sequences: those with a common prefix stand together
            fresh = np.ones(len(at), bool)
            fresh[1:] = (state[1:] != state[:-1]) | (turn[1:] != turn[:-1])
            child = self._place(state[fresh], self._number(turn[fresh]))
            state = child[np.cumsum(fresh) - 1]
            depth += 1

    def _number(self, turn):
        np = self.np
        new, where = np.unique(turn[self.dense[turn] < 0], return_index=True)
        self.dense[new[np.argsort(where)]] = self.n_dense + np.arange(len(new))
        self.n_dense += len(new)
        return self.dense[turn]

    def _grow(self, size: int) -> None:
        np, have = self.np, len(self.check)
        if size > have:
            more = max(size - have, have // 2 + 16)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.zeros(more, np.int64)])

    def _place(self, parent, c):
        """Slots of the children ``c`` of ``parent`` (children of a parent stand together)."""
        np = self.np
        head = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        size = np.diff(np.append(head, len(parent)))
        slot = np.zeros(len(parent), np.int64)
        for k in np.flatnonzero(size > 1).tolist():  # families that must fit as a whole go first
            a, b = head[k], head[k] + size[k]
            order = c[a:b] - c[a:b].min()
            slot[a:b] = self._fit(order) + order
            self._end = max(self._end, int(slot[a:b].max()) + 1)
            self.check[slot[a:b]] = parent[a]
            self.base[parent[a]] = slot[a] - c[a]
        only = head[size == 1]
        if len(only):
            slot[only] = self._free(len(only))
            self.check[slot[only]] = parent[only]
            self.base[parent[only]] = slot[only] - c[only]
            self._low = int(slot[only[-1]]) + 1
        self._end = max(self._end, int(slot.max()) + 1)
        return slot

    _low, _end = 2, 2  # all slots before the first are taken, all from the second on are free

    def _free(self, count: int):
        """The first free slots; beyond the last used one there is no end of them."""
        np, found, have, at = self.np, [], 0, self._low
        while have < count and at < self._end:
            there = np.flatnonzero(self.check[at:min(at + 4096, self._end)] == 0) + at
            found.append(there)
            have, at = have + len(there), at + 4096
        if have < count:
            self._grow(self._end + count - have)
            found.append(np.arange(self._end, self._end + count - have))
        return np.concatenate(found)[:count]

    def _fit(self, order) -> int:
        """A place where all slots of ``order`` are free: at one of the first free ones, or behind the last used."""
        spread = int(order.max())
        for start in self._free(32).tolist():
            self._grow(start + spread + 1)
            if not self.check[start + order].any():
                return start
        self._grow(self._end + spread + 1)
        return self._end

    def step(self, state, turn):
        """The child of each node by a turn; 0 where there is none."""
        np = self.np
        c = self.dense[turn]
        t = self.base[state] + c
        inside = (c >= 0) & (t > 0) & (t < len(self.check))
        t = np.where(inside, t, 0)
        return np.where(inside & (self.check[t] == state), t, 0)

    def levels(self, offsets, turns):
        """Walk all sequences at once: per depth, (numbers of the sequences that go on, nodes they reach)."""
        np = self.np
        lengths = np.diff(offsets)
        at, state, depth = np.arange(len(lengths)), np.ones(len(lengths), np.int64), 0
        while len(at):
            yield at, state
            longer = lengths[at] > depth
            at, state = at[longer], state[longer]
            state = self.step(state, turns[offsets[at] + depth])
            if not state.all():
                raise ValueError("a sequence is not in the trie")
            depth += 1


NODE = T.StructType(
    [T.StructField(c, T.LongType()) for c in (
        "depth", "k1", "k2", "p1", "p2", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [T.StructField("ends_sha256", T.StringType())]
    + [T.StructField(c, T.BooleanType()) for c in ("shared", "parent_shared")])
NO_ID = (1 << 63) - 1


def shard_nodes(before, sequences, n, first, ends):
    """The nodes of one shard as a dict of columns.  ``sequences``: distinct, sorted, each an array of WIDTH
    longs a turn; ``before``: the last sequence of the shard before (None: there is none); per sequence its
    number of members, the smallest id (NO_ID: none) and the digest of the ids."""
    import numpy as np

    lengths = np.array([len(s) // WIDTH for s in sequences], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    rows = np.concatenate([np.asarray(s, np.int64) for s in sequences] + [np.zeros(0, np.int64) if before is None
                          else np.asarray(before, np.int64)]).reshape(-1, WIDTH)
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[order[1:], :2] != rows[order[:-1], :2]).any(1)
    told = rows[order[fresh]]  # the distinct turns
    turns = np.zeros(len(rows), np.int64)
    turns[order] = np.cumsum(fresh) - 1
    trie = DoubleArray(offsets, turns[:offsets[-1]], len(told))

    size = len(trie.check)
    column = {c: np.zeros(size, np.int64) for c in ("depth", "n_convs", "words")}
    low = np.full(size, NO_ID, np.int64)
    key = np.zeros((2, size), np.uint64)
    end_of, found = np.zeros(len(lengths), np.int64), []
    h1, h2 = (np.ascontiguousarray(told[:, c]).view(np.uint64) for c in (0, 1))
    for depth, (at, state) in enumerate(trie.levels(offsets, turns)):
        head = np.flatnonzero(np.concatenate([[True], state[1:] != state[:-1]]))
        node = state[head]
        found.append(node)
        column["depth"][node] = depth
        column["n_convs"][node] = np.add.reduceat(n[at], head)
        low[node] = np.minimum.reduceat(first[at], head)
        if depth:
            turn, parent = turns[offsets[at[head]] + depth - 1], trie.check[node]
            column["words"][node] = told[turn, 2]
            key[0, node] = mix64(key[0, parent] * np.uint64(0x9E3779B97F4A7C15) + h1[turn] + np.uint64(depth))
            key[1, node] = mix64(key[1, parent] * np.uint64(0xD6E8FEB86659FD93) + h2[turn] + np.uint64(depth))
        end_of[at[lengths[at] == depth]] = state[lengths[at] == depth]

    # nodes that the shards before know already: the path of their last sequence, as far as it goes here
    old = np.zeros(size, bool)
    taken_back = 0
    if before is not None:
        state, path = np.ones(1, np.int64), turns[offsets[-1]:]
        old[1] = True
        for turn in path:
            nxt = trie.step(state, np.array([turn]))
            if not nxt[0]:
                break
            state = nxt
            old[state] = True
        else:
            taken_back = int(state[0])  # its last turn ends a node that goes on here
    nodes = np.concatenate(found)
    parent = trie.check[nodes]
    children = np.bincount(parent[1:], weights=~old[nodes[1:]], minlength=size).astype(np.int64)
    leaf = np.ones(size, bool)
    leaf[parent[1:]] = False
    leaves = np.zeros(size, np.int64)
    leaves[nodes] = leaf[nodes] & ~old[nodes]
    if taken_back:
        leaves[taken_back] -= 1
    saved = (column["n_convs"] - ~old) * column["words"]
    for level in reversed(found[1:]):
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])

    shared = old.copy()
    shared[end_of[-1]] = True  # the last path may go on in the next shard
    up = end_of[-1]
    while up != 1:
        up = trie.check[up]
        shared[up] = True
    digest = np.full(size, None, object)
    digest[end_of] = ends
    parent[0] = 0
    signed = key.view(np.int64)
    return {"depth": column["depth"][nodes], "k1": signed[0, nodes], "k2": signed[1, nodes],
            "p1": signed[0, parent], "p2": signed[1, parent], "conv_id": low[nodes], "parent_conv_id": low[parent],
            "n_convs": column["n_convs"][nodes], "n_children": children[nodes], "n_leaves": leaves[nodes],
            "saved_tokens": saved[nodes], "ends_sha256": digest[nodes], "shared": shared[nodes],
            "parent_shared": shared[parent]}


def _tries(batches):
    """Rows (shard, before, seq, chunk, n, first, ids) sorted by shard, ``before`` rows first, then seq and
    chunk: one batch of nodes per shard."""
    import numpy as np
    import pyarrow as pa

    types = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BooleanType(): pa.bool_()}
    schema = pa.schema([(f.name, types[f.dataType]) for f in NODE.fields])

    def flush():
        if not seqs:
            return
        got = shard_nodes(before, seqs, np.array(ns, np.int64), np.array(firsts, np.int64), [d.hexdigest() for d in digests])
        columns = []
        for f in schema:
            values = got[f.name]
            if f.name in ("conv_id", "parent_conv_id"):
                columns.append(pa.array(values, f.type, mask=values == NO_ID))
            else:
                columns.append(pa.array(values, f.type, from_pandas=f.name == "ends_sha256"))
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    shard, before, seqs, ns, firsts, digests = None, None, [], [], [], []
    for batch in batches:
        lists = batch.column("seq")
        values = lists.values.to_numpy(zero_copy_only=False)
        offsets = lists.offsets.to_numpy()
        for i, (at, is_before, n, first, ids) in enumerate(zip(
                *(batch.column(c).to_pylist() for c in ("shard", "is_before", "n", "first", "ids")))):
            if at != shard:
                yield from flush()
                shard, before, seqs, ns, firsts, digests = at, None, [], [], [], []
            seq = values[offsets[i]:offsets[i + 1]].copy()
            if is_before:
                before = seq
                continue
            first = NO_ID if first is None else first
            if seqs and len(seqs[-1]) == len(seq) and np.array_equal(seqs[-1], seq):
                digests[-1].update(b"," + ids.encode())
                ns[-1] += n
                firsts[-1] = min(firsts[-1], first)
            else:
                seqs.append(seq)
                ns.append(n)
                firsts.append(first)
                digests.append(hashlib.sha256(ids.encode()))
    yield from flush()


def trie_nodes(members: DataFrame, rules: TrieRules = TrieRules()) -> DataFrame:
    """The nodes of the trie of ``members`` (conv_id long, seq)."""
    spark = members.sparkSession
    here = scratch_path(spark, "trie")
    rows = materialize(folded(members, rules), f"{here}/folded")
    turns = rows.agg(F.sum(F.size("seq")) / WIDTH).first()[0] or 0
    least = rules.shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(least, int(turns // rules.turns_per_shard) + 1)
    dealt = materialize(rows.repartitionByRange(shards, "seq").withColumn("shard", F.spark_partition_id()), f"{here}/dealt")
    # one row a shard: the last sequence of the one before
    borders = dealt.groupBy("shard").agg(F.max("seq").alias("seq")) \
        .withColumn("seq", F.lag("seq").over(Window.orderBy("shard"))).where("seq IS NOT NULL")
    both = dealt.withColumn("is_before", F.lit(False)).unionByName(borders.withColumn("is_before", F.lit(True)), True)
    nodes = materialize(both.repartition(shards, "shard").sortWithinPartitions("shard", F.desc("is_before"), "seq", "chunk")
                        .select("shard", "is_before", "seq", "n", "first", "ids").mapInArrow(_tries, NODE), f"{here}/nodes")
    merged = materialize(nodes.where("shared").groupBy("depth", "k1", "k2").agg(
        F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256")), f"{here}/merged")
    lead = merged.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                         F.col("conv_id").alias("true_parent"))
    if within(lead, rules.broadcast_nodes):
        lead = F.broadcast(lead)
    columns = ["n_convs", "n_children", "n_leaves", "saved_tokens"]

    def told(df: DataFrame, parent: Column) -> DataFrame:
        return df.select("conv_id", "depth", parent.alias("parent_conv_id"), *columns,
                         F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))

    inner = nodes.where(~F.col("shared") & ~F.col("parent_shared"))
    below = nodes.where(~F.col("shared") & F.col("parent_shared")).drop("parent_conv_id") \
        .unionByName(merged, allowMissingColumns=True)
    return told(inner, F.col("parent_conv_id")) \
        .unionByName(told(below.join(lead, ["depth", "p1", "p2"], "left"), F.col("true_parent")))


def op11_prefix_trie(conversations: DataFrame) -> DataFrame:
    own = sequences(conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text"))
    return trie_nodes(rebuilt(own)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
