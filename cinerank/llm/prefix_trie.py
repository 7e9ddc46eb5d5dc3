"""Conversation prefix trie, in double arrays per prefix shard.

1. Turns are numbered in their conversation and become a digest of (role, text) and a length: texts go no further.
2. Conversations are rebuilt (``share_prefix``) and streamed in order; each turn gets the chained key of all turns up to it, each
   conversation the keys at depths 1, 2, 4, ...: a header whose size grows with the logarithm of its length.
3. Equal conversations become one path with a count. Paths are dealt to shards by the key of a prefix: of the first
   turn, or, where more turns follow it than a shard holds on average, of the first 2, 4, 8, ... turns. The nodes above that cut
   lie in several shards.
4. A shard numbers its turns densely, packs a trie of its paths into BASE and CHECK arrays (child = BASE[node] + turn, CHECK[child] =
   node), and walks all paths through them, adding up members and, from the leaves up, subtrees.
5. Nodes below the cut are complete in their shard. What shards found at nodes above it is merged by key; each such node belongs to the
   first shard that has it, which adds it to the subtrees of the nodes above. Only sums of shards meet, however many conversations share a turn.
6. The ids of members that end at a node are sorted over all tasks (ranges of node and id), joined to long strings there, and those are hashed in order.

A task holds the paths of a shard (about 300 bytes a turn of ``rows_per_shard``; a single path longer than that is held whole). Number, rebuild, sort
and hash steps stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

ROOT = bytes(16)
#: At most so many prefixes can be hot at one depth; their keys are broadcast (16 bytes each).
MOST_HOT = 100_000
#: Characters of member ids that are handed on in one row.
IDS = 1 << 20
TURN = "conv_id long, depth long, digest binary, chars long, key binary, length long, heads binary"
NODE = ("shard int, key binary, parent_key binary, depth long, upper boolean, conv_id long, parent_conv_id long, n_convs long, n_children long, "
        "ends boolean, chars long, leaves long, n_chars long, own_chars long")


def digest(role: Column, text: Column) -> Column:
    """16 bytes that tell (role, text) pairs apart."""
    return F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, digest, chars), in the order of turn (null first) and, in ties, digest."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest(role, text).alias("digest"),
                                                     F.length(text).cast("long").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "digest", "chars")


def shared_turns(conv_id: Column) -> Column:
    """How many turns conversation ``conv_id`` takes from the first of its hundred: 0 to 5."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 6


def share_prefix(numbered: DataFrame, most: int = 5) -> DataFrame:
    """Rebuilt conversations, (conv_id, part, pos, digest, chars): part 0 is one row per conversation without a turn, part 1 the turns
    taken from the first conversation of its hundred, part 2 its own after as many."""
    h = shared_turns(F.col("conv_id"))
    convs = numbered.where("pos = 1").select("conv_id")
    nothing = [F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars")]
    first = numbered.where((F.col("conv_id") % 100 == 0) & (F.col("pos") <= most)).withColumnRenamed("conv_id", "_base")
    takers = convs.where(h > 0).withColumn("_base", F.col("conv_id") - F.col("conv_id") % 100)  # a base has 199 takers at most
    taken = takers.join(first, "_base").where(F.col("pos") <= h)
    return (convs.select("conv_id", F.lit(0).alias("part"), *nothing)
            .unionByName(taken.select("conv_id", F.lit(1).alias("part"), "pos", "digest", "chars"))
            .unionByName(numbered.where(F.col("pos") > h).select("conv_id", F.lit(2).alias("part"), "pos", "digest", "chars")))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of conv_id, part, pos -> a row per node of each conversation, and a header after them (depth null)."""
    conv, depth, key, heads = None, 0, ROOT, b""
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        names, kinds = ["conv_id", "depth", "digest", "chars", "key", "length", "heads"], [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        out.clear()
        return made

    for rows in batches:
        for c, part, d, chars in zip(*(rows.column(x).to_pylist() for x in ("conv_id", "part", "digest", "chars"))):
            if part == 0:
                if conv is not None:
                    out.append((conv, None, None, None, key, depth, heads))
                conv, depth, key, heads = c, 0, ROOT, b""
            else:
                depth += 1
                key = hashlib.blake2b(key + d, digest_size=16).digest()
                if depth & (depth - 1) == 0:
                    heads += key
            if part or not depth:
                out.append((conv, depth, d, chars, key, None, None))
        if out:
            yield batch()
    if conv is not None:
        out.append((conv, None, None, None, key, depth, heads))
        yield batch()


def rebuilt_paths(rebuilt: DataFrame) -> DataFrame:
    """Chained rows and headers (see ``_chained``) of rebuilt conversations; a task streams whole conversations."""
    ordered = rebuilt.repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos")
    return written(ordered.mapInArrow(_chained, TURN), "trie-turns")


def cut_paths(headers: DataFrame, rows_per_shard: int, least_shards: int) -> tuple[DataFrame, int]:
    """((path, n, conv_id, length, cut, shard_key) of each distinct conversation, number of shards). Nodes of less
    depth than cut may lie in several shards; all paths through any other node have the same shard_key. No shard_key has more turns than a shard
    holds on average, but for a single path."""
    paths = headers.groupBy(F.col("key").alias("path")).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("length").alias("length"), F.first("heads").alias("heads"))
    paths = written(paths.withColumn("hot", F.lit(0)), "trie-paths")
    total = paths.agg(F.sum(F.col("length") + 1)).first()[0] or 0
    shards = max(least_shards, -(-total // rows_per_shard))
    limit = max(-(-total // shards), -(-total // MOST_HOT))  # so that no depth has more than MOST_HOT hot prefixes
    head = lambda j: F.substring("heads", 16 * j + 1, 16)
    j = 0
    while True:
        sizes = paths.where((F.col("hot") == j) & (F.length("heads") > 16 * j)).groupBy(head(j).alias("_k")).agg(F.sum("length").alias("_n"))
        hot = written(sizes.where(F.col("_n") > limit).select("_k"), "trie-hot")
        if hot.isEmpty():
            break
        same = (F.col("hot") == j) & (head(j) == F.col("_k"))
        paths = written(paths.join(F.broadcast(hot), same, "left").withColumn("hot", F.col("hot") + F.col("_k").isNotNull().cast("int")).drop("_k"), "trie-paths")
        j += 1
    at = F.expr("shiftleft(1L, hot)")
    long_enough = F.col("length") >= at
    return paths.select("path", "n", "conv_id", "length", F.when(long_enough, at).otherwise(F.col("length") + 1).alias("cut"),
                        F.when(long_enough, F.expr("substring(heads, 16 * hot + 1, 16)")).otherwise(F.col("path")).alias("shard_key")), shards


@dataclass
class DoubleArray:
    """A trie over dense turn ids (1 and up): the child of state s by turn t is base[s] + t if check[base[s] + t] is s. The root is state 0."""
    base: np.ndarray
    check: np.ndarray

    def step(self, state: np.ndarray, turn: np.ndarray) -> np.ndarray:
        """The children, -1 where there is none."""
        to = self.base[state] + turn
        ok = (to >= 0) & (to < len(self.check))
        ok[ok] = self.check[to[ok]] == state[ok]
        return np.where(ok, to, -1)


def pack(parent: np.ndarray, turn: np.ndarray, tries: int = 1024) -> DoubleArray:
    """The double array of a tree: node i + 1 is the child of node ``parent[i]`` by ``turn[i]``; rows are in the order of (parent, turn), node 0 is the root.

    Nodes with several children come first, those with most before others, at the first free slot where all children fit (``tries`` free slots are
    looked at, then the children go behind the last one); nodes with one child then fill the free slots."""
    m = len(parent)
    nodes, first, count = np.unique(parent, return_index=True, return_counts=True)
    slot, base_of = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    used = np.zeros(2 * m + 64, bool)
    used[0] = True
    low, end = 1, 1  # no slot below low is free, none from end on is used
    several = np.flatnonzero(count > 1)
    for g in several[np.argsort(-count[several], kind="stable")]:
        i, k = first[g], count[g]
        codes = turn[i:i + k]
        span = codes - codes[0]
        need = end + int(span[-1]) + 2
        if need > len(used):
            used = np.concatenate([used, np.zeros(max(len(used), need), bool)])
        at, looked, size = end, 0, 8
        from_slot = low
        while looked < tries and from_slot < end:
            free = from_slot + np.flatnonzero(~used[from_slot:min(end, from_slot + 4 * size)])[:size]
            from_slot = free[-1] + 1 if len(free) == size else min(end, from_slot + 4 * size)
            looked, size = looked + max(1, len(free)), 2 * size
            if len(free):
                fits = free[~used[free[:, None] + span[None, :]].any(axis=1)] if k < 4096 else free[:0]
                if len(fits):
                    at = int(fits[0])
                    break
        slot[i + 1:i + k + 1] = at + span
        used[at + span] = True
        base_of[nodes[g]] = at - codes[0]
        end = max(end, at + int(span[-1]) + 1)
        while low < end and used[low]:
            low += 1
    single = np.flatnonzero(count == 1)
    free = np.flatnonzero(~used[low:end])[:len(single)] + low
    free = np.concatenate([free, np.arange(end, end + len(single) - len(free))])
    i = first[single]
    slot[i + 1] = free
    base_of[nodes[single]] = free - turn[i]
    size = int(slot.max()) + 1
    base, check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
    base[slot] = base_of
    check[slot[1:]] = slot[parent]
    return DoubleArray(base, check)


def build(path: np.ndarray, depth: np.ndarray, raw: np.ndarray) -> tuple[DoubleArray, np.ndarray]:
    """(double array, dense turn id of each row) of paths given as rows (path number, depth from 1, raw turn number) in the order of depth.
    Turns are numbered as they appear from the root down, so that the children of a node get close numbers."""
    dense, seen = np.zeros(int(raw.max(initial=0)) + 1, np.int64), 0
    node = np.zeros(int(path.max(initial=0)) + 1, np.int64)
    turn, parents, turns, n_nodes = np.zeros(len(raw), np.int64), [], [], 1
    levels = np.searchsorted(depth, np.arange(1, int(depth.max(initial=0)) + 2))
    for a, b in zip(levels[:-1], levels[1:]):
        at = node[path[a:b]]
        by = np.argsort(at, kind="stable")
        fresh, where = np.unique(raw[a:b][by], return_index=True)
        fresh = fresh[np.argsort(where)]
        fresh = fresh[dense[fresh] == 0]
        dense[fresh] = np.arange(seen + 1, seen + len(fresh) + 1)
        seen += len(fresh)
        code = turn[a:b] = dense[raw[a:b]]
        order = np.lexsort((code, at))
        new = np.ones(b - a, bool)
        new[1:] = (at[order[1:]] != at[order[:-1]]) | (code[order[1:]] != code[order[:-1]])
        number = np.empty(b - a, np.int64)
        number[order] = n_nodes + np.cumsum(new) - 1
        parents.append(at[order[new]])
        turns.append(code[order[new]])
        node[path[a:b]] = number
        n_nodes += int(new.sum())
    none = np.empty(0, np.int64)
    return pack(np.concatenate([none, *parents]), np.concatenate([none, *turns])), turn


def _shard_nodes(rows: pa.Table, shard: int) -> pa.RecordBatch:
    """The nodes of a shard, from rows (path, n, first conversation, cut, length, depth, digest, chars, key)."""
    col = lambda x: rows[x].to_numpy()
    number = lambda x: rows[x].combine_chunks().dictionary_encode().indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    path, depth, raw = number("path"), col("depth"), number("digest")
    order = np.lexsort((path, depth))
    path, depth, raw = path[order], depth[order], raw[order]
    start = int(np.searchsorted(depth, 1))  # before it: the paths' rows at the root
    trie, turn = build(path[start:], depth[start:], raw[start:])
    at, state = np.zeros(int(path.max()) + 1, np.int64), np.zeros(len(path), np.int64)
    levels = start + np.searchsorted(depth[start:], np.arange(1, int(depth.max()) + 2))
    for a, b in zip(levels[:-1], levels[1:]):
        to = trie.step(at[path[a:b]], turn[a - start:b - start])
        if (to < 0).any():
            raise AssertionError("a path left the trie")
        at[path[a:b]] = state[a:b] = to
    size = len(trie.check)
    n, some, conv, ends = np.zeros(size, np.int64), np.full(size, -1), np.full(size, np.iinfo(np.int64).max), np.zeros(size, bool)
    np.add.at(n, state, col("n")[order])
    np.minimum.at(conv, state, col("conv_id")[order])
    some[state] = order
    ends[state[col("length")[order] == depth]] = True
    live = np.flatnonzero(some >= 0)
    live = live[np.argsort(col("depth")[some[live]], kind="stable")]
    some, up = some[live], trie.check[live]
    index = np.full(size, -1)
    index[live] = np.arange(len(live))
    up = np.where(up >= 0, index[up], -1)
    n, conv, ends, depth, chars = n[live], conv[live], ends[live], col("depth")[some], col("chars")[some]
    upper = depth < col("cut")[some]
    inner = up >= 0
    children = np.bincount(up[inner], minlength=len(live))
    own = np.where(upper, 0, 1)
    leaves, n_chars, own_chars = own * (children == 0), n * chars, own * chars
    bounds = np.searchsorted(depth, np.arange(int(depth.max()) + 2))
    for a, b in zip(bounds[-2:0:-1], bounds[:0:-1]):
        for total in (leaves, n_chars, own_chars):
            np.add.at(total, up[a:b], total[a:b])
    local_children = np.bincount(up[inner], weights=own[inner], minlength=len(live)).astype(np.int64)
    keys = rows["key"].combine_chunks().take(pa.array(some))
    parent_key = keys.take(pa.array(up, mask=~inner))
    parent_conv = pa.array(conv[up], mask=~inner | upper[up])
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(live), shard, np.int32)), keys, parent_key, pa.array(depth), pa.array(upper), pa.array(conv), parent_conv, pa.array(n),
        pa.array(local_children), pa.array(ends), pa.array(chars), pa.array(leaves), pa.array(n_chars), pa.array(own_chars)],
        [x.split()[0] for x in NODE.split(", ")])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    held = [b for b in batches if b.num_rows]
    if held:
        yield _shard_nodes(pa.Table.from_batches(held), TaskContext.get().partitionId())


def _subtrees(group: pa.Table) -> pa.Table:
    """One shard's nodes above the cut -> (key, sub_chars, sub_leaves): what the nodes that belong to this shard add to each subtree."""
    frame = group.select(["key", "parent_key", "depth", "add_chars", "add_leaves"]).to_pydict()
    chars, leaves = dict(zip(frame["key"], frame["add_chars"])), dict(zip(frame["key"], frame["add_leaves"]))
    for _, key, up in sorted(zip(frame["depth"], frame["key"], frame["parent_key"]), key=lambda x: -x[0]):
        if up is not None:
            chars[up] += chars[key]
            leaves[up] += leaves[key]
    return pa.table({"key": pa.array(chars.keys(), pa.binary()), "sub_chars": pa.array(chars.values(), pa.int64()), "sub_leaves": pa.array(leaves.values(), pa.int64())})


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, conv_id) in order -> (path, first id, ids joined by commas), of about ``IDS`` characters at most."""
    path, first, ids, size = None, None, [], 0

    def row():
        return pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(ids)])], ["path", "first", "ids"])

    for batch in batches:
        for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if p != path or size > IDS:
                if ids:
                    yield row()
                path, first, ids, size = p, c, [], 0
            ids.append(str(c))
            size += len(ids[-1]) + 1
    if ids:
        yield row()


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, first, ids) in order -> (path, SHA-256 of all its ids joined by commas)."""
    path, h, out = None, None, []

    def made():
        batch = pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.binary()), pa.array([x for _, x in out])], ["path", "ends_sha256"])
        out.clear()
        return batch

    for batch in batches:
        for p, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if p != path:
                if h is not None:
                    out.append((path, h.hexdigest()))
                path, h = p, hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
        if out:
            yield made()
    if h is not None:
        out.append((path, h.hexdigest()))
        yield made()


def member_digests(headers: DataFrame) -> DataFrame:
    """(path, ends_sha256) of each distinct conversation: a hash of the ids of its copies, in order. Copies are sorted over ranges of
    (path, id), so a conversation with most of the copies takes many tasks; the last task reads strings of about a million characters."""
    ordered = headers.select(F.col("key").alias("path"), "conv_id").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    joined = ordered.mapInArrow(_joined_ids, "path binary, first long, ids string")
    return joined.repartition("path").sortWithinPartitions("path", "first").mapInArrow(_hashed_ids, "path binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, rows_per_shard: int = 100_000, rebuild=share_prefix) -> DataFrame:
    """One row per node of the trie of all conversations of ``turns`` (conv_id, turn, role, text): (conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256). ``rebuild`` turns numbered turns into rebuilt ones (``share_prefix``).

    Turns go by turn (null first), ties by a digest of role and text; null role or text is empty. Turns that are equal in everything are as many
    turns. Rows without conv_id belong to no conversation and are left out. A conversation left without a turn is a member of the root. Other columns are
    ignored; an empty table has no node, not even a root.
    """
    spark = turns.sparkSession
    numbered = written(numbered_turns(turns), "trie-numbered")
    chained = rebuilt_paths(rebuild(numbered))
    headers = chained.where("depth is null")
    paths, shards = cut_paths(headers, rows_per_shard, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = chained.where("depth is not null").select("conv_id", "depth", "digest", "chars", "key").join(paths, "conv_id")
    nodes = written(rows.repartition(shards, "shard_key").mapInArrow(_shards, NODE), "trie-nodes")

    # Nodes above the cut: sums over shards, then subtrees with each node counted once, by the first shard that has it.
    found = nodes.where("upper")
    merged = found.groupBy("key").agg(
        F.min("shard").alias("owner"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("local_children"),
        F.max("ends").alias("ends"), F.first("depth").alias("depth"), F.first("chars").alias("chars"), F.first("parent_key").alias("parent_key"),
        *[F.sum(x).alias(x) for x in ("leaves", "n_chars", "own_chars")])
    merged = written(merged, "trie-merged")
    below = merged.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("upper_children"))
    merged = merged.join(below, "key", "left").withColumn("n_children", F.col("local_children") + F.coalesce("upper_children", F.lit(0)))
    whole = written(merged.select("*", (F.col("n_children") == 0).cast("long").alias("leaf")), "trie-upper")
    there = found.select("shard", "key", "parent_key", "depth").join(whole.select("key", "owner", "conv_id", "chars", "leaf"), "key")
    there = written(there, "trie-there")
    mine = (F.col("owner") == F.col("shard")).cast("long")
    sums = there.select("shard", "key", "parent_key", "depth", (mine * F.col("chars")).alias("add_chars"), (mine * F.col("leaf")).alias("add_leaves"))
    sums = sums.groupBy("shard").applyInArrow(_subtrees, "key binary, sub_chars long, sub_leaves long")
    sums = sums.groupBy("key").agg(F.sum("sub_chars").alias("sub_chars"), F.sum("sub_leaves").alias("sub_leaves"))
    # A shard asks for a parent's conversation once: (shard, key) has no more rows than the shard has nodes.
    parents = there.select("shard", F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    upper = whole.join(sums, "key").join(parents.withColumnRenamed("shard", "owner"), ["owner", "parent_key"], "left").select(
        "key", "ends", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("leaves") + F.col("sub_leaves")).alias("n_leaves"),
        (F.col("n_chars") - F.col("own_chars") - F.col("sub_chars")).alias("saved_tokens"))

    local = nodes.where("not upper").select("shard", "key", "ends", "conv_id", "depth", "parent_key", "parent_conv_id", "n_convs", "n_children",
                                            F.col("leaves").alias("n_leaves"), (F.col("n_chars") - F.col("own_chars")).alias("saved_tokens"))
    tops = local.where("parent_conv_id is null").drop("parent_conv_id").join(parents, ["shard", "parent_key"], "left")
    names = ["key", "ends", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    every = upper.select(names).unionByName(tops.select(names)).unionByName(local.where("parent_conv_id is not null").select(names))
    every = written(every, "trie-every")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    ended = every.where("ends").join(member_digests(headers).withColumnRenamed("path", "key"), "key")
    return ended.select(out).unionByName(every.where("not ends").withColumn("ends_sha256", F.lit(hashlib.sha256().hexdigest())).select(out))
