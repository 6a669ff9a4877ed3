"""SimHash near-duplicates with pigeonring filtering.

``fingerprints`` gives every text a 64-bit SimHash over word shingles.
``links`` finds all pairs of fingerprints within ``threshold`` bits: the 64 bits
lie on a ring of ``segments`` segments, and two fingerprints within the
threshold have a start segment from which every chain of l consecutive segments
differs in at most floor(l * threshold / segments) bits. The chains whose budget
is 0 or 1 bits form the join key (the one allowed bit is probed); the longer
chains prune what meets there, before the full Hamming check.

Nothing is squared: equal fingerprints are one node, and a set of fingerprints
that meet under one key yields a spanning forest of its links, not its pairs.
The fingerprints of one key share all bits of the key chain, so near copies of
one text are few distinct values there (2,081 within two bits of it), however
many documents carry them.

Defined results: null and empty texts have fingerprint zero and link like any
other; repeated rows are one node; null keys are carried, and the smallest
non-null key names a component (null if there is none); an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.llm.common import written
from geoloom.operators.skew import connected_components

BITS = 64
SEED = 42
SHINGLE = 4
THRESHOLD = 4
#: More segments give longer keys (fewer chance meetings) for more probe rows: 5 segments 25 bits, 9 segments 28 bits.
SEGMENTS = 5
_CHUNK = 1 << 16


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of UTF-8 ``text``: a bit is set if it is set in over half of the shingles' hashes."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the separators \x20 and \x09-\x0D
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[min(shingle, len(words)) - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for k in range(0, n, _CHUNK):
        octets = hashes[k : k + _CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, text: str = "text", keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """Columns ``keep`` of ``docs`` plus ``fp``, the SimHash as a signed 64-bit number."""
    source = docs.select(*keep, F.col(text).cast("binary").alias("__text"))
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep))
            fps = np.fromiter((simhash(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            cols = [*batch.columns[: len(keep)], pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "fp"])

    return source.mapInArrow(run, schema)


class Ring:
    """Segment masks, chain budgets and join keys of a pigeonring."""

    def __init__(self, threshold: int = THRESHOLD, segments: int = SEGMENTS):
        if not 0 <= threshold < segments <= BITS:
            raise ValueError("pigeonring needs more segments than differing bits")
        cuts = [round(BITS * i / segments) for i in range(segments + 1)]
        masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
        self.segments = segments
        self.budget = [length * threshold // segments for length in range(segments + 1)]
        chain = lambda i, length: sum(masks[(i + k) % segments] for k in range(length))
        #: chains[length - 1, i]: bits of the chain of that length from segment i.
        self.chains = np.array([[chain(i, n) for i in range(segments)] for n in range(1, segments + 1)], np.uint64)
        self.exact = max(n for n in range(segments + 1) if self.budget[n] == 0)
        self.keyed = max(n for n in range(segments + 1) if self.budget[n] <= 1)
        loose = [int(self.chains[self.keyed - 1, i]) & ~int(self.chains[self.exact - 1, i]) for i in range(segments)]
        self.flips = [[1 << b for b in range(BITS) if m >> b & 1] for m in loose]

    def keys(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start segment, key bits, position in ``fps``) under which each fingerprint is stored or probes.

        Of two fingerprints that differ in one bit of the key, the one with a 0
        there probes the other's key.
        """
        starts, bits, rows = [], [], []
        every = np.arange(len(fps))
        for i in range(self.segments):
            own = fps & self.chains[self.keyed - 1, i]
            starts.append(np.full(len(fps), i, np.int8))
            bits.append(own)
            rows.append(every)
            for flip in self.flips[i]:
                hit = np.flatnonzero((fps & np.uint64(flip)) == 0)
                starts.append(np.full(len(hit), i, np.int8))
                bits.append(own[hit] | np.uint64(flip))
                rows.append(hit)
        return np.concatenate(starts), np.concatenate(bits), np.concatenate(rows)

    def near(self, a: np.ndarray, b: np.ndarray, start: np.ndarray | int) -> np.ndarray:
        """Pairs whose chains from ``start`` keep every budget; the longest chain is the full Hamming check."""
        diff = a ^ b
        ok = np.ones(np.shape(diff), bool)
        for length in range(1, self.segments + 1):
            ok &= np.bitwise_count(diff & self.chains[length - 1, start]) <= self.budget[length]
        return ok


def forest(fps: np.ndarray, start: int, ring: Ring) -> list[tuple[np.ndarray, int]]:
    """Links (fingerprints, their neighbour) that connect what is linked under one key."""
    found, rest = [], fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            hit = ring.near(rest, x, start)
            if hit.any():
                found.append((rest[hit], x))
                queue.extend(rest[hit])
                rest = rest[~hit]
    return found


def links(fps: DataFrame, *, threshold: int = THRESHOLD, segments: int = SEGMENTS) -> DataFrame:
    """Links ``u, v`` between distinct fingerprints (column ``fp``) that connect all pairs within the threshold."""
    ring = Ring(threshold, segments)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            start, bits, row = ring.keys(values)
            cols = [pa.array(start), pa.array(bits.view(np.int64)), pa.array(values[row].view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=["start", "bits", "fp"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
            now = (now[0], now[1].view(np.uint64), now[2].view(np.uint64))
            held.append(now)
            if held[0][0][0] == now[0][-1] and held[0][1][0] == now[1][-1]:
                continue  # all rows so far have one key
            start, bits, fp = (np.concatenate(x) for x in zip(*held))
            last = np.flatnonzero((start != start[-1]) | (bits != bits[-1]))[-1] + 1
            held = [(start[last:], bits[last:], fp[last:])]
            yield linked(start[:last], bits[:last], fp[:last])
        if held:
            yield linked(*(np.concatenate(x) for x in zip(*held)))

    def linked(start: np.ndarray, bits: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate(([True], (start[1:] != start[:-1]) | (bits[1:] != bits[:-1]))))
        size = np.diff(np.append(first, len(fp)))
        pair = first[size == 2]
        pair = pair[ring.near(fp[pair], fp[pair + 1], start[pair])]
        u, v = [fp[pair]], [fp[pair + 1]]
        for a, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
            for hit, x in forest(fp[a : a + n], int(start[a]), ring):
                u.append(hit)
                v.append(np.full(len(hit), x, np.uint64))
        cols = [pa.array(np.concatenate(x).view(np.int64)) for x in (u, v)]
        return pa.RecordBatch.from_arrays(cols, names=["u", "v"])

    met = fps.select("fp").distinct().mapInArrow(probe, "start tinyint, bits bigint, fp bigint")
    met = met.repartition("start", "bits").sortWithinPartitions("start", "bits")
    return met.mapInArrow(meet, "u bigint, v bigint").distinct()


def components(fps: DataFrame, *, key: str = "doc_id", threshold: int = THRESHOLD, segments: int = SEGMENTS) -> DataFrame:
    """``fp, first`` for every distinct fingerprint: the smallest ``key`` reachable over links.

    ``fps`` (columns ``key`` and ``fp``) is read twice, so pass a written table.
    """
    smallest = fps.groupBy("fp").agg(F.min(key).alias("first"))
    reached = connected_components(links(fps, threshold=threshold, segments=segments))
    reached = reached.select(F.col("node").alias("fp"), "component")
    nodes = smallest.join(reached, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    nodes = written(nodes, "simhash-nodes")
    heads = nodes.groupBy("component").agg(F.min("first").alias("first"))
    return nodes.select("fp", "component").join(heads, "component").select("fp", "first")


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    threshold: int = THRESHOLD, segments: int = SEGMENTS) -> DataFrame:
    """``key, fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``."""
    fps = written(fingerprints(docs, text=text, keep=[key], shingle=shingle), "simhash")
    first = components(fps, key=key, threshold=threshold, segments=segments)
    return fps.join(first, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id")
    )


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             threshold: int = THRESHOLD, segments: int = SEGMENTS) -> DataFrame:
    """One row of every near-duplicate group: the smallest key, nulls last, then the smallest text hash."""
    from pyspark.sql import Window as W

    row = F.xxhash64(key, text)
    named = docs.select(F.col(key).alias("id"), row.alias("row"), F.col(text).alias("text"))
    fps = written(fingerprints(named, keep=["id", "row"], shingle=shingle), "simhash")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    # Groups are named by their first row; a text and its repeated rows are one node.
    nodes = fps.groupBy("fp").agg(F.min(order).alias("first"))
    reached = connected_components(links(fps, threshold=threshold, segments=segments))
    reached = reached.select(F.col("node").alias("fp"), "component")
    heads = nodes.join(reached, "fp", "left").groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("first").alias("h"))
    heads = heads.select(F.col("h.id").alias("__id"), F.col("h.row").alias("__row"))
    kept = docs.withColumn("__key", row).join(heads, (F.col("__key") == F.col("__row")) & F.col(key).eqNullSafe(F.col("__id")))
    once = F.row_number().over(W.partitionBy("__key", key).orderBy("__key"))
    return kept.withColumn("__n", once).where("__n = 1").select(*docs.columns)
