"""Groups of near copies: candidates from sketches, links confirmed on full sets, groups by union-find.

A *node* is one distinct set of shingles, so equal texts cost one. A sketch gives
a node its candidate keys and a signature of fixed size. Nodes that share a key
are a bucket.

1. Signatures meet in the buckets. What may be alike there becomes the links of a
   forest, and the forests of all buckets, joined, cut the nodes into *clusters*:
   every pair that shares a key and is not ruled out by its signatures lies in one.
2. The texts of the clusters, each once, come together and are compared exactly:
   an inverted index over the shingles of a block counts the common shingles of
   one set with all others. Links are confirmed, again as forests.
3. Union-find in each task and star contraction between tasks give the groups.

No pairs are formed. In a bucket or cluster a few *pivots* are compared with all
others; of what they leave apart the largest part is taken as settled, and only
the nodes outside it are compared with all. That is complete: a link between two
parts has an end outside the largest. Buckets and clusters over a size are dealt
to blocks, each with the pivots in it; afterwards the nodes outside the largest
part go to every block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.llm.common import sliced, written
from geoloom.operators.skew import connected_components

#: Nodes of one bucket or cluster that meet in one task, and shingles that do.
BLOCK = 2_048
BLOCK_SHINGLES = 1_000_000
PIVOTS = 8
#: Buckets up to this size are compared pair by pair, many buckets at once.
SMALL = 32
_CHUNK = 20_000
_FLUSH = 20_000
_LINKS = "u binary, v binary"


@dataclass(frozen=True)
class Sketch:
    """How nodes are sketched. The callables run inside tasks."""

    #: Sorted distinct 64-bit shingle hashes of a UTF-8 text.
    shingles: Callable[[bytes], np.ndarray]
    #: (signature bytes, candidate keys) of such a set; no keys: linked with nothing.
    sketch: Callable[[np.ndarray], tuple[bytes, np.ndarray]]
    #: Element type of a signature.
    dtype: np.dtype
    #: Likeness of one signature with many, negative where a link is ruled out.
    alike: Callable[[np.ndarray, np.ndarray], np.ndarray]
    #: Least similarity of a link in percent.
    percent: int = 80

    def sizes_allow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)


def sketched(named: DataFrame, how: Sketch) -> DataFrame:
    """``id, row, node, size, sig, keys`` of every row of ``named`` (``id, row, text``)."""
    kinds = [("node", T.BinaryType()), ("size", T.LongType()), ("sig", T.BinaryType()), ("keys", T.ArrayType(T.LongType()))]
    schema = T.StructType([named.schema["id"], named.schema["row"], *(T.StructField(n, k) for n, k in kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            node, size, sig, keys = [], [], [], []
            for value in batch.column(2):
                own = how.shingles(value.as_py() or b"")
                s, k = how.sketch(own)
                node.append(xxhash.xxh3_128_digest(own.tobytes()))
                size.append(len(own))
                sig.append(s)
                keys.append(k.view(np.int64))
            cols = [pa.array(node, pa.binary()), pa.array(size, pa.int64()), pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *cols], names=["id", "row", *(n for n, _ in kinds)])

    return named.select("id", "row", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def _segments(batches: Iterator[pa.RecordBatch], keys: int = 2) -> Iterator[pa.Table]:
    """The rows of each run of equal values in the first ``keys`` columns (integers)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        starts = np.concatenate(([0], np.flatnonzero(change), [batch.num_rows]))
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            now = tuple(c[a] for c in cols)
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            last = now
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def forest(n: int, near: Callable[[int], np.ndarray], visit: np.ndarray | None = None, label: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (positions) that join all of ``n`` nodes which are linked; ``near`` gives the links of one.

    Without ``visit`` the first ``PIVOTS`` nodes are asked, then all that lie
    outside the largest part; with it exactly those nodes are. ``label`` names
    the parts known before.
    """
    label = np.arange(n) if label is None else label.copy()
    found: list[tuple[int, int]] = []

    def ask(x: int) -> None:
        hits = near(x)
        hits = hits[label[hits] != label[x]]
        if len(hits):
            parts, first = np.unique(label[hits], return_index=True)
            found.extend((x, int(hits[k])) for k in first)
            label[np.isin(label, parts)] = label[x]

    if visit is None:
        for x in range(min(PIVOTS, n)):
            ask(x)
        counts = np.bincount(label)
        visit = np.flatnonzero(label != counts.argmax())
        visit = visit[visit >= PIVOTS]
    for x in visit.tolist():
        ask(x)
    return found


class Signatures:
    """Nodes compared by their signatures."""

    def __init__(self, one: pa.Table, how: Sketch, among: np.ndarray | None = None):
        values = one.column("sig").to_pylist()
        self.sizes, self.how = one.column("size").to_numpy(), how
        self.sigs = np.frombuffer(b"".join(values), how.dtype).reshape(len(values), -1)
        self.among = np.arange(len(values)) if among is None else among

    def near(self, x: int) -> np.ndarray:
        at = self.among[self.how.sizes_allow(self.sizes[self.among], self.sizes[x])]
        return at[self.how.alike(self.sigs[x], self.sigs[at]) >= 0]


class Sets:
    """Nodes compared by their sets, with an inverted index over the shingles of those that are ``among``."""

    def __init__(self, one: pa.Table, how: Sketch, among: np.ndarray | None = None):
        self.sets, self.percent = [how.shingles(t.as_py()) for t in one.column("text")], how.percent
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        among = np.arange(len(self.sets)) if among is None else among
        every = np.concatenate([self.sets[k] for k in among]) if len(among) else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.values, self.owner = every[order], np.repeat(among, self.sizes[among])[order]

    def near(self, x: int) -> np.ndarray:
        low = np.searchsorted(self.values, self.sets[x])
        many = np.searchsorted(self.values, self.sets[x], side="right") - low
        ends = np.cumsum(many)
        if not len(ends) or not ends[-1]:
            return np.zeros(0, np.int64)
        at = np.arange(ends[-1]) + np.repeat(low - (ends - many), many)
        both = np.bincount(self.owner[at], minlength=len(self.sets))
        return np.flatnonzero((both > 0) & (100 * both >= self.percent * (self.sizes + self.sizes[x] - both)))


def union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links (u, v) of a task, reduced to one link from each node to the first of its set."""
    parent: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, find(x)) for x in parent]
    pairs = [p for p in pairs if p[0] != p[1]]
    for k in range(0, len(pairs), _FLUSH):
        part = pairs[k : k + _FLUSH]
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in part], pa.binary()) for i in (0, 1)], names=["u", "v"])


def _small_pairs(length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j), i < j, of the pairs inside consecutive groups of the given sizes, in pieces."""
    ends = np.cumsum(length)
    end_of = np.repeat(ends, length)
    at = np.arange(len(end_of))
    for d in range(1, int(length.max(initial=0))):
        at = at[at + d < end_of[at]]
        for k in range(0, len(at), _CHUNK):
            yield at[k : k + _CHUNK], at[k : k + _CHUNK] + d


def _alike_pairs(batches: Iterator[pa.RecordBatch], how: Sketch) -> Iterator[pa.RecordBatch]:
    """Links of the buckets (``key, block``, in order): small buckets pair by pair, large ones as forests."""

    def linked(rows: pa.Table, length: np.ndarray) -> Iterator[pa.RecordBatch]:
        small = length <= SMALL
        keep = np.repeat(small & (length > 1), length)
        part = rows.filter(pa.array(keep))
        node, own = part.column("node").to_pylist(), Signatures(part, how) if part.num_rows else None
        for i, j in _small_pairs(length[small & (length > 1)]):
            near = how.sizes_allow(own.sizes[i], own.sizes[j])
            i, j = i[near], j[near]
            near = how.alike(own.sigs[i], own.sigs[j]) >= 0
            u, v = ([node[k] for k in x[near].tolist()] for x in (i, j))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])
        starts = np.cumsum(length) - length
        for k in np.flatnonzero(~small).tolist():
            one = rows.slice(int(starts[k]), int(length[k]))
            yield from _run(iter(one.combine_chunks().to_batches()), lambda t: forest(t.num_rows, Signatures(t, how).near))

    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        key, block = (rows.column(c).to_numpy() for c in ("key", "block"))
        starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (block[1:] != block[:-1])))) if len(key) else []
        if len(starts) > 1:  # the last bucket may go on in the next batch
            yield from linked(rows.slice(0, int(starts[-1])), np.diff(starts))
            rows = rows.slice(int(starts[-1]))
        held = rows
    if held is not None and held.num_rows:
        yield from linked(held, np.array([held.num_rows]))


def _linked(met: DataFrame, how: Sketch, compare: type) -> DataFrame:
    """Links between the nodes of each ``key``: ``met`` has ``key, blocks, pivot, node`` and what ``compare`` reads."""
    own = [c for c in met.columns if c not in ("blocks", "pivot")]

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if compare is Signatures:
            yield from _alike_pairs(batches, how)
            return
        yield from _run(batches, lambda one: forest(one.num_rows, compare(one, how).near))

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(one: pa.Table) -> list[tuple[int, int]]:
            label = np.unique(np.array(one.column("group").to_pylist(), object), return_inverse=True)[1]
            home, left = (np.flatnonzero(one.column(c).to_numpy()) for c in ("home", "left"))
            return forest(one.num_rows, compare(one, how, home).near, left, label)

        yield from _run(batches, links)

    def reduced(links: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        # One function, so that a task needs one Python worker; two in a row double the workers that an executor keeps.
        return lambda batches: union_find(links(batches))

    at = F.pmod(F.hash("node"), F.col("blocks"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    # Pivots stand first, and in every block.
    first = met.select(*own, F.explode(F.when(F.col("pivot"), every).otherwise(F.array(at))).alias("block"), "pivot")
    first = first.repartition("key", "block").sortWithinPartitions("key", "block", F.col("pivot").desc(), "node")
    links = written(first.select("key", "block", *[c for c in own if c != "key"]).mapInArrow(reduced(inside), _LINKS), "links")
    large = met.where("blocks > 1")
    if large.isEmpty():
        return links
    # Keys over the size of a block: what the blocks left apart.
    group = connected_components(links).select("node", F.col("component").alias("group"))
    parted = large.join(group, "node", "left").withColumn("group", F.coalesce("group", "node"))
    counts = parted.groupBy("key", "group").agg(F.count("*").alias("c")).groupBy("key")
    open_ = counts.agg(F.count("*").alias("parts"), F.max(F.struct("c", "group")).alias("m")).where("parts > 1")
    # The extra join key gives both sides a shuffle of their own, so that a large key can be split among tasks.
    open_ = open_.select(F.hash("key").alias("k"), "key", F.col("m.group").alias("main"))
    parted = parted.withColumn("k", F.hash("key")).join(open_, ["k", "key"])
    left = (F.col("group") != F.col("main")).alias("left")
    rows = parted.select(*own, "group", left, F.explode(F.when(F.col("group") != F.col("main"), every).otherwise(F.array(at))).alias("block"), at.alias("at"))
    rows = rows.withColumn("home", F.col("at") == F.col("block")).drop("at")
    rows = rows.repartition("key", "block").sortWithinPartitions("key", "block")
    rows = rows.select("key", "block", *[c for c in own if c != "key"], "group", "left", "home")
    return links.unionByName(written(rows.mapInArrow(reduced(across), _LINKS), "links"))


def _run(batches: Iterator[pa.RecordBatch], links: Callable[[pa.Table], list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
    u, v = [], []
    batch = lambda: pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])
    for one in _segments(batches):
        if one.num_rows < 2:
            continue
        node = one.column("node").to_pylist()
        for x, y in links(one):
            u.append(node[x])
            v.append(node[y])
        if len(u) > _FLUSH:
            yield batch()
            u, v = [], []
    yield batch()


def _buckets(nodes: DataFrame, merge: bool) -> DataFrame:
    """``key, blocks, pivot, node, size, sig`` of the nodes under each key."""
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
    pivot = ((F.col("node") == F.col("first")) | (F.col("node") == F.col("last"))).alias("pivot")
    counts = keyed.groupBy("key").agg(
        F.count("*").alias("n"), F.min("node").alias("first"), F.max("node").alias("last"), F.bit_xor(F.xxhash64("node")).alias("x")
    )
    if merge:
        # Keys that gather the same nodes are one bucket, and those of one node are none.
        shared = counts.where("n > 1").groupBy("n", "first", "last", "x").agg(F.min("key").alias("key"))
        # The extra join key gives both sides a shuffle of their own, so that a frequent key can be split among tasks.
        members = keyed.withColumn("k", F.hash("key")).join(shared.withColumn("k", F.hash("key")), ["k", "key"])
        met = members.select("key", blocks, pivot, "node").join(nodes.select("node", "size", "sig"), "node")
        return written(met.select("key", "blocks", "pivot", "node", "size", "sig"), "buckets")
    large = written(counts.where(F.col("n") > BLOCK).select("key", "n", "first", "last"), "large-keys")
    met = nodes.select(F.explode("keys").alias("key"), "node", "size", "sig")
    if large.isEmpty():
        return met.select("key", F.lit(1).alias("blocks"), F.lit(False).alias("pivot"), "node", "size", "sig")
    met = met.join(large, "key", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    return met.select("key", blocks, F.coalesce(pivot, F.lit(False)).alias("pivot"), "node", "size", "sig")


def near_groups(named: DataFrame, how: Sketch, *, merge: bool = True) -> DataFrame:
    """``id, row, node, size, group`` of every row of ``named`` (``id, row, text``); equal ``group`` (a node): one group.

    ``merge`` leaves out keys of one node and keys that gather the same nodes
    before signatures travel; it pays where few keys are shared.
    """
    own = written(sketched(named, how), "sketches")
    one = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "size", "sig", "keys"))
    nodes = own.groupBy("node").agg(one.alias("f"))
    nodes = written(nodes.select("node", "f.id", "f.row", "f.size", "f.sig", "f.keys"), "nodes")
    met = _buckets(nodes, merge)
    clusters = connected_components(_linked(met, how, Signatures)).select("node", F.xxhash64("component").alias("key"))

    clusters = written(clusters.join(nodes.select("node", "size", "id", "row"), "node"), "clusters")
    shape = clusters.groupBy("key").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"),
        F.min(F.struct("size", "node")).alias("least"), F.max(F.struct("size", "node")).alias("most"), F.min("node").alias("first"), F.max("node").alias("last"),
    )
    shape = shape.select(F.hash("key").alias("k"), "key", "blocks", F.array("first", "last", "least.node", "most.node").alias("pivots"))
    placed = clusters.withColumn("k", F.hash("key")).join(shape, ["k", "key"])
    placed = placed.select(
        F.col("id").alias("__id"), F.col("row").alias("__row"), "key", "blocks", "node", F.array_contains("pivots", F.col("node")).alias("pivot")
    )
    at = (F.col("row") == F.col("__row")) & F.col("id").eqNullSafe(F.col("__id"))
    # The same plan at every size: a broadcast would spare small inputs the shuffle of the texts.
    texts = named.join(placed.hint("merge"), at).select("key", "blocks", "pivot", "node", F.col("text").cast("binary").alias("text"))
    # Rows equal in key and text stand for one node.
    texts = written(texts.dropDuplicates(["node"]), "texts")
    links = _linked(texts, how, Sets)
    group = connected_components(links).select("node", F.col("component").alias("group"))
    return own.select("id", "row", "node", "size").join(group, "node", "left").withColumn("group", F.coalesce("group", "node"))
