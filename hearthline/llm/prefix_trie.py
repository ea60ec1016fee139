"""The trie of conversation prefixes, from member intervals over sorted conversations.

A conversation is a sequence of steps; a step is the 128-bit hash of a turn's role and text with its number
of words. Sorted as sequences, the members of a prefix stand next to each other, so a trie node is an
interval. Conversations are dealt by range of their sequence into shards, each one task. Inside a shard
``lcp[i]`` is the number of steps that conversation ``i`` shares with the one before it. A sparse table
holds the minima of all stretches of ``lcp`` whose length is a power of two, and each candidate prefix
``(i, depth)`` finds the left and right end of its members by a binary search in that table, all
candidates at once and none depending on another. Everything else follows from intervals: numbers of
members by their width, the smallest member by another sparse table, and sums over subtrees from running
sums, since nodes in order of first member and depth are in preorder.

Prefixes of a shard's first and last conversation may go on in other shards. Their rows, at most two
conversations' depth per shard, meet by hash of the prefix in one small task, which adds them up; nodes
inside a shard are final at once. A prefix that a third of all conversations share is thus one row per
shard. A shard holds about ``steps_per_shard`` steps of 24 bytes. The numbers of members that end at such a
prefix are hashed as a stream, in pieces of bounded size, since SHA-256 can't be merged.

Defined results: null roles and texts are empty ones; turns are ordered by number, null first, and
turns with the same number by their hash; repeated rows are repeated turns; rows without a conversation
id belong to no conversation and are left out; a conversation without steps is a member of the root
alone; very long texts count as one step; a conversation's steps are one array, so a single
conversation must fit a task; without conversations there are no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from hearthline.llm.mixing import size_of
from hearthline.llm.textwords import mix, randoms
from hearthline.sources.stages import stage

STEPS = "array<struct<a:bigint,b:bigint,w:bigint>>"
FINAL, EDGE, IDS = 0, 1, 2  # of a shard's row: a finished node; part of a node; ids that end at an edge node
_ROWS = (
    "kind int, conv_id long, depth long, parent_conv_id long, a long, b long, pa long, pb long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, words long, longer boolean, ends_sha256 string, "
    "shard int, piece int, ids string"
)
_NODES = "a long, b long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
NODE_COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_NOTHING = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Settings:
    steps_per_shard: int = 1_000_000
    ids_per_piece: int = 512  # conversation ids in one row of a hashed stream


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, steps``: the steps of each conversation in order."""
    said = [F.coalesce(F.col(c), F.lit("")) for c in (role, text)]
    step = F.struct(
        F.col(turn).alias("turn"), F.xxhash64(*said).alias("a"), F.xxhash64(F.lit(1), *said).alias("b"), size_of(text).alias("w")
    )
    rows = turns.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), step.alias("step"))
    ordered = F.array_sort(F.collect_list("step"))
    plain = F.transform(ordered, lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"), s["w"].alias("w")))
    return rows.groupBy("conv_id").agg(plain.cast(STEPS).alias("steps"))


def with_heads(convs: DataFrame, source: Column, length: Column, longest: int) -> DataFrame:
    """Conversations whose first ``length`` steps are those of conversation ``source``.

    Fewer if that has fewer, none if it is not there; own steps follow after the first ``length``.
    """
    heads = convs.select(F.col("conv_id").alias("head_id"), F.slice("steps", 1, longest).alias("head"))
    sources = convs.select("conv_id", "steps", source.alias("head_id"), length.cast("int").alias("h"))
    # Only conversations that lend their head take part in the join, and each of them once.
    lenders = heads.join(sources.select("head_id").distinct(), "head_id", "left_semi")
    joined = sources.join(lenders, "head_id", "left")
    own = F.slice("steps", F.col("h") + 1, F.greatest(F.size("steps") - F.col("h"), F.lit(0)))
    head = F.slice(F.coalesce("head", F.array().cast(STEPS)), F.lit(1), F.col("h"))
    return joined.select("conv_id", F.concat(head, own).alias("steps"))


class Minima:
    """A sparse table: minima of ``values[i : i + 2**k]`` for every ``i`` and ``k``."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The minimum of ``values[first : last + 1]``, element by element."""
        k = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for level in np.unique(k):
            at = np.flatnonzero(k == level)
            table = self.levels[level]
            out[at] = np.minimum(table[first[at]], table[last[at] - (1 << int(level)) + 1])
        return out

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place to which all values after ``at`` are at least ``depth``."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table = self.levels[k]
            go = at + 1 < len(table)
            go[go] = table[at[go] + 1] >= depth[go]
            at[go] += 1 << k
        return at

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place from which all values up to and with ``at`` are at least ``depth``; it may start lower."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table, start = self.levels[k], at - (1 << k) + 1
            go = start >= 1
            go[go] = table[start[go]] >= depth[go]
            at[go] -= 1 << k
        return at


@dataclass
class Shard:
    """Sorted conversations of a task: ids, and the hashes of all prefixes by place in ``starts``."""

    ids: np.ndarray
    starts: np.ndarray
    a: np.ndarray
    b: np.ndarray
    words: np.ndarray

    @classmethod
    def of(cls, batches: list[pa.RecordBatch]) -> Shard:
        table = pa.Table.from_batches(batches).combine_chunks()
        column = table.column("steps").combine_chunks()
        length = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.zeros(len(length) + 1, np.int64)
        np.cumsum(length, out=starts[1:])
        steps = column.flatten()
        place = np.arange(starts[-1]) - np.repeat(starts[:-1], length)
        lanes = []
        for seed, name in ((11, "a"), (12, "b")):
            # The hash of a prefix: a sum over its steps with a random weight for each depth.
            token = mix(steps.field(name).to_numpy().astype(np.int64).view(np.uint64))
            weight = randoms(int(length.max(initial=0)), seed) | np.uint64(1)
            total = np.zeros(len(token) + 1, np.uint64)
            np.cumsum(token * weight[place], out=total[1:])
            lanes.append((total[1:] - np.repeat(total[starts[:-1]], length)).view(np.int64))
        return cls(table.column("conv_id").to_numpy(), starts, *lanes, steps.field("w").to_numpy())

    def shared(self) -> np.ndarray:
        """Steps that each conversation shares with the one before it; -1 for the first."""
        length = np.diff(self.starts)
        n = len(length)
        lcp = np.full(n, -1, np.int64)
        both = np.minimum(length[1:], length[:-1])
        conv = np.repeat(np.arange(1, n), both)
        place = np.arange(both.sum()) - np.repeat(np.cumsum(both) - both, both)
        one, other = self.starts[conv] + place, self.starts[conv - 1] + place
        same = (self.a[one] == self.a[other]) & (self.b[one] == self.b[other])
        # Prefix hashes agree up to the first step that differs and nowhere after it.
        lcp[1:] = np.bincount(conv[same], minlength=n)[1:]
        return lcp

    def prefix(self, at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both hashes of a prefix, and the words of its last step."""
        a, b, w = (np.zeros(len(at), np.int64) for _ in range(3))
        some = depth > 0
        place = self.starts[at[some]] + depth[some] - 1
        a[some], b[some], w[some] = self.a[place], self.b[place], self.words[place]
        return a, b, w


def _batch(n: int, **columns) -> pa.RecordBatch:
    arrays, names = [], []
    for field in _ROWS.split(", "):
        name, kind = field.split(" ")
        kind = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}[kind]
        value = columns.get(name)
        if value is None:
            arrays.append(pa.nulls(n, kind))
        elif isinstance(value, np.ndarray) or isinstance(value, list):
            arrays.append(pa.array(value, kind))
        elif isinstance(value, pa.Array):
            arrays.append(value)
        else:
            arrays.append(pa.array([value] * n, kind))
        names.append(name)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def nodes_of(shard: Shard, number: int, settings: Settings = Settings()) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard: finished ones, parts of edge nodes, ids that end at those."""
    n, length = len(shard.ids), np.diff(shard.starts)
    lcp = shard.shared()
    # A conversation opens the prefixes that the one before it does not have.
    opens = length - lcp
    base = np.zeros(n + 1, np.int64)
    np.cumsum(opens, out=base[1:])
    at = np.repeat(np.arange(n), opens)
    depth = np.arange(base[-1]) - base[at] + lcp[at] + 1
    table = Minima(lcp)
    last = table.right(at, depth)
    convs = last - at + 1
    smallest = Minima(shard.ids).least(at, last)

    def node(place: np.ndarray, deep: np.ndarray) -> np.ndarray:
        first = table.left(place, deep)
        return base[first] + deep - lcp[first] - 1

    parent = np.full(len(at), -1)
    parent[1:] = node(at[1:], depth[1:] - 1)
    a, b, words = shard.prefix(at, depth)
    edge = (at == 0) | (last == n - 1)
    longer = length[last] > depth
    inner = ~edge

    def below(values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(np.where(inner, values, 0), out=total[1:])
        return total[base[last + 1]] - total[:-1]

    leaves = below(~longer)
    saved = below((convs - 1) * words)
    children = np.bincount(parent[inner], minlength=len(at))
    # Members that end at a node stand at the head of its interval.
    end = node(np.arange(n), length)
    group = np.flatnonzero(np.append(True, end[1:] != end[:-1]))
    bounds = np.append(group, n)
    names = shard.ids.astype("U20") if n else np.zeros(0, "U20")
    ended: dict[int, str] = {}
    pieces: list[tuple[int, int, str]] = []
    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        where = int(end[i])
        if edge[where]:
            for p, k in enumerate(range(i, j, settings.ids_per_piece)):
                pieces.append((where, p, ",".join(names[k : min(j, k + settings.ids_per_piece)])))
        else:
            ended[where] = hashlib.sha256(",".join(names[i:j]).encode()).hexdigest()
    mine = np.flatnonzero(inner)
    over = parent[mine]
    known = inner[over]
    size = 100_000
    for k in range(0, len(mine), size):
        m, o, sure = mine[k : k + size], over[k : k + size], known[k : k + size]
        yield _batch(
            len(m), kind=FINAL, conv_id=smallest[m], depth=depth[m], n_convs=convs[m], n_children=children[m],
            parent_conv_id=pa.array(smallest[o], mask=~sure), pa=pa.array(a[o], mask=sure), pb=pa.array(b[o], mask=sure),
            n_leaves=leaves[m], saved_tokens=saved[m], ends_sha256=[ended.get(x, _NOTHING) for x in m.tolist()],
        )
    out = np.flatnonzero(edge)
    over = np.maximum(parent[out], 0)
    # What hangs below an edge node counts for the lowest such node only; parents of edge nodes are edge nodes.
    child = out[parent[out] >= 0]
    for sums in (leaves, saved):
        np.subtract.at(sums, parent[child], sums[child].copy())
    yield _batch(
        len(out), kind=EDGE, conv_id=smallest[out], depth=depth[out], a=a[out], b=b[out], pa=a[over], pb=b[over],
        n_convs=convs[out], n_children=children[out], n_leaves=leaves[out], saved_tokens=saved[out], words=words[out],
        longer=longer[out], shard=number,
    )
    for k in range(0, len(pieces), 1000):
        some = pieces[k : k + 1000]
        where = np.array([x for x, _, _ in some])
        yield _batch(
            len(some), kind=IDS, depth=depth[where], a=a[where], b=b[where], shard=number,
            piece=[p for _, p, _ in some], ids=[s for _, _, s in some],
        )


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of edge nodes put together: a few rows per shard."""
    held = [x for x in batches if x.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    part = {c: table.column(c).to_numpy() for c in table.column_names if c != "longer"}
    longer = table.column("longer").to_numpy(zero_copy_only=False).astype(bool)
    order = np.lexsort((part["b"], part["a"], part["depth"]))
    keys = np.stack([part[c][order] for c in ("depth", "a", "b")])
    first = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
    depth, a, b = keys[:, first]
    add = lambda c: np.add.reduceat(part[c][order], first)
    convs, children, leaves, saved = (add(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"))
    smallest = np.minimum.reduceat(part["conv_id"][order], first)
    childless = ~np.logical_or.reduceat(longer[order], first)
    leaves = leaves + childless
    saved = saved + (convs - 1) * part["words"][order][first]
    # Nodes are ordered by depth and hash: a parent is found among those one level up.
    found = {key: i for i, key in enumerate(zip(depth.tolist(), a.tolist(), b.tolist()))}
    up = zip((depth - 1).tolist(), part["pa"][order][first].tolist(), part["pb"][order][first].tolist())
    parent = np.array([found.get(key, -1) for key in up])
    bounds = np.append(np.flatnonzero(np.append(True, depth[1:] != depth[:-1])), len(depth))
    for i, j in zip(bounds[:-1][::-1], bounds[1:][::-1]):
        if depth[i] > 0:
            np.add.at(children, parent[i:j], 1)
            np.add.at(leaves, parent[i:j], leaves[i:j])
            np.add.at(saved, parent[i:j], saved[i:j])
    above = pa.array(smallest[np.maximum(parent, 0)], mask=depth == 0)
    yield pa.RecordBatch.from_arrays(
        [pa.array(a), pa.array(b), pa.array(depth), pa.array(smallest), above, *map(pa.array, (convs, children, leaves, saved))],
        names=[x.split(" ")[0] for x in _NODES.split(", ")],
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each node, from sorted pieces, as a stream."""
    key, state, done = None, None, []

    def out():
        a, b, depth, digest = zip(*done)
        done.clear()
        return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (a, b, depth)), pa.array(digest)], names=["a", "b", "depth", "digest"])

    for batch in batches:
        for a, b, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "depth", "ids"))):
            if (a, b, depth) != key:
                if state is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (a, b, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(done) >= 1000:
            yield out()
    if state is not None:
        done.append((*key, state.hexdigest()))
        yield out()


def trie(convs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The nodes of the trie of ``convs`` (``conv_id, steps``), one row per distinct prefix.

    ``conv_id`` is the smallest member, so step ``depth`` of that conversation is the node's last;
    ``parent_conv_id`` the parent's, null for the root; ``n_convs`` members, ``n_children``, ``n_leaves`` childless
    nodes of the subtree, ``saved_tokens`` the words that sharing saves in the subtree, ``ends_sha256``.
    """
    spark = convs.sparkSession
    steps = convs.agg(F.sum(F.size("steps") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + steps // settings.steps_per_shard)
    dealt = convs.repartitionByRange(shards, "steps", "conv_id").sortWithinPartitions("steps", "conv_id")

    def run(batches):
        held = [x for x in batches if x.num_rows]
        if held:
            yield from nodes_of(Shard.of(held), TaskContext.get().partitionId(), settings)

    found = stage(dealt.mapInArrow(run, _ROWS), "trie-parts")
    parts = found.where(F.col("kind") == EDGE).select(
        "conv_id", "depth", "a", "b", "pa", "pb", "n_convs", "n_children", "n_leaves", "saved_tokens", "words", "longer"
    )
    edges = stage(parts.repartition(1).mapInArrow(_edges, _NODES), "trie-edges")
    pieces = found.where(F.col("kind") == IDS).select("a", "b", "depth", "shard", "piece", "ids")
    pieces = pieces.repartition("a", "b", "depth").sortWithinPartitions("a", "b", "depth", "shard", "piece")
    digests = pieces.mapInArrow(_hashed, "a long, b long, depth long, digest string")
    whole = edges.join(digests, ["a", "b", "depth"], "left").withColumn("ends_sha256", F.coalesce("digest", F.lit(_NOTHING)))
    final = found.where(F.col("kind") == FINAL)
    inside = final.where("parent_conv_id is not null")
    above = edges.select(F.col("a").alias("pa"), F.col("b").alias("pb"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("up"))
    hanging = final.where("parent_conv_id is null").drop("parent_conv_id").join(above, ["pa", "pb", "depth"])
    hanging = hanging.withColumnRenamed("up", "parent_conv_id")
    return (
        inside.select(*NODE_COLUMNS).unionByName(hanging.select(*NODE_COLUMNS)).unionByName(whole.select(*NODE_COLUMNS))
    )
