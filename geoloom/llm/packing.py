"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

1. ``token_pieces`` tokenises whole texts and cuts only documents longer than a
   sequence.
2. ``pack_plan`` packs the histogram of piece lengths (at most ``capacity``
   counts, whatever the number of documents): every bin is filled greedily,
   largest piece first, then its smallest piece gives way to two unpacked ones
   that fit the expanded gap more tightly, from the point on where that costs no bins. Equal bins are planned once, with a
   multiplicity.
3. ``pack`` ranks the pieces of each length (prefix sums over hash blocks, so
   no task sees a whole length class) and looks the rank up in the plan.

Defined results: a null or empty text is one piece that holds only the end
token; repeated rows are packed once per row; an empty table gives no rows;
further columns are ignored by ``token_pieces`` and carried by ``pack``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from geoloom.llm.common import prefix_offsets, written

CAPACITY = 1024
END_ID = 2
#: Rows of one length that share a block of the rank computation.
RANK_BLOCK = 4_096
#: Shares of the tokens left from which on plans make swaps; the last is the plain greedy plan.
SWAP_FROM = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 0.003, 0.0)
#: Texts in these scripts take the fast encoder; all others go to the tokenizer of the file itself.
FAST_TEXT = re.compile(r"[^\x00-ɏ]")


@lru_cache(maxsize=2)
def encoder(path: str):
    """Function from a text to the ids that the tokenizer file gives it.

    The file's merges are ranked by id, so the same vocabulary serves as rank
    table for the faster byte-pair encoder (``tiktoken``). The two split alike as
    long as their tables of letters agree, which Latin text guarantees; other
    texts, and those that hold an added token, are encoded by the file's own
    tokenizer with its defaults. The start-up probe compares both.
    """
    import tiktoken
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)

    def slow(text: str) -> list[int]:
        return own.encode(text, add_special_tokens=False).ids

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    vocab, merges = model.get("vocab", {}), model.get("merges", [])
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or not isinstance(vocab, dict):
        return slow
    special = {t["content"] for t in spec.get("added_tokens", [])}
    to_byte = {c: b for b, c in byte_alphabet().items()}
    ranks = {bytes(to_byte[c] for c in token): i for token, i in vocab.items() if token not in special}
    joined = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
    if any(a >= b for a, b in zip(joined, joined[1:])):
        return slow
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    probe = "It's  two\n\n lines,\t3rd ²½ naïve; I'LL we'll  x\u0085 #%&|<> été—ŷɏ 2024!"
    if fast.encode_ordinary(probe) != slow(probe):
        return slow
    odd = re.compile("|".join([FAST_TEXT.pattern, *map(re.escape, sorted(special))]))
    return lambda text: slow(text) if odd.search(text) else fast.encode_ordinary(text)


def byte_alphabet() -> dict[int, str]:
    """Printable stand-in of every byte in byte-level vocabularies: itself, or the next free code point from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def token_pieces(
    docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pieces of every document: ``key, piece, start, length, ids`` (ids as little-endian 32-bit binary).

    Only documents of more than ``capacity`` ids (end token included) are cut;
    then the first piece takes the remainder and all others are full.
    """
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            rows, piece, start, length, ids = [], [], [], [], []
            held = 0
            for row, value in enumerate(batch.column(1)):
                tokens = np.array([*encode(value.as_py() or ""), end_id], dtype="<u4")
                cut = len(tokens) % capacity or capacity
                for k, (a, b) in enumerate(zip([0, *range(cut, len(tokens), capacity)], range(cut, len(tokens) + 1, capacity))):
                    rows.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    ids.append(tokens[a:b].tobytes())
                held += 4 * len(tokens)
                if held > 16_000_000:
                    yield emit(batch, rows, piece, start, length, ids)
                    rows, piece, start, length, ids, held = [], [], [], [], [], 0
            yield emit(batch, rows, piece, start, length, ids)

    def emit(batch, rows, piece, start, length, ids):
        keys = batch.column(0).take(pa.array(rows, pa.int64()))
        cols = [keys, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=[key, "piece", "start", "length", "ids"])

    return source.mapInArrow(run, schema)


def pack_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bins as (piece lengths, number of equal bins), by best-two-fit over the histogram ``counts``."""
    return best_plan(counts, capacity)[0]


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[list[int], int]], int]:
    """The plan and its number of bins with a swap.

    A swap spends two short pieces, which a later bin with a large piece could
    need; once such bins are filled it costs nothing. Planning works on at most
    ``capacity`` counts, so it is tried with swaps from the start and from later
    points on, given by the share of the tokens still unpacked. The plan of
    fewest bins counts, of equals the one with the most swaps.
    """
    for length in counts:
        if not 1 <= length <= capacity:
            raise ValueError(f"piece of {length} tokens does not fit {capacity}")
    plans = [_planned(counts, capacity, gap, share) for share in SWAP_FROM for gap in (capacity, 0)]
    return min(plans, key=lambda plan: (sum(times for _, times in plan[0]), -plan[1]))


def _planned(counts: dict[int, int], capacity: int, gap: int, share: float) -> tuple[list[tuple[list[int], int]], int]:
    """One plan and its swapped bins; swaps begin at ``share`` of the tokens and may leave a gap of at most ``gap``."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] += n
    sizes, bins, swapped = np.arange(capacity + 1), [], 0
    begin = share * (sizes @ left)
    while left.any():
        greedy = _greedy(left, capacity)
        items = _two_for_smallest(greedy, left, capacity, gap) if sizes @ left <= begin else greedy
        used = np.bincount(items, minlength=capacity + 1)
        times = int((left[used > 0] // used[used > 0]).min())
        left -= used * times
        bins.append((items, times))
        swapped += times * (items is not greedy)
    return bins, swapped


def _greedy(left: np.ndarray, capacity: int) -> list[int]:
    """Largest pieces first, each the largest that still fits."""
    free, items, rest = capacity, [], left.copy()
    while True:
        fits = np.flatnonzero(rest[: free + 1])
        if not len(fits):
            return items
        items.append(int(fits[-1]))
        rest[fits[-1]] -= 1
        free -= int(fits[-1])


def _two_for_smallest(items: list[int], left: np.ndarray, capacity: int, most: int) -> list[int]:
    """Swap the smallest piece of a bin for the two unpacked pieces that leave the least gap, at most ``most``, while that helps."""
    while True:
        gap = capacity - sum(items)
        if gap == 0:
            return items
        smallest = min(items)
        kept = items.copy()
        kept.remove(smallest)
        rest = left - np.bincount(kept, minlength=len(left))
        room = gap + smallest
        best = (smallest, 0, 0)
        sizes = np.flatnonzero(rest > 0)
        for a in sizes[sizes <= room // 2].tolist():
            partners = sizes[(sizes >= a) & (sizes <= room - a)]
            partners = partners[(partners != a) | (rest[a] > 1)]
            if len(partners):
                best = max(best, (a + int(partners[-1]), a, int(partners[-1])))
            if best[0] == room:
                break
        if best[0] <= smallest or room - best[0] > most:
            return items
        items = [*kept, best[2], best[1]]


def pack(pieces: DataFrame, *, length: str = "length", order: list[str], capacity: int = CAPACITY, rank_block: int = RANK_BLOCK) -> DataFrame:
    """``pieces`` plus ``sequence_id`` and ``offset``: as few sequences of ``capacity`` tokens as best-two-fit finds.

    ``order`` names columns that tell rows apart; rows equal in all of them are
    interchangeable. ``pieces`` is read three times, so pass a written table.
    Lengths outside 1..capacity (nulls included) raise an error.
    """
    spark = pieces.sparkSession
    histogram = pieces.groupBy(F.col(length).alias("length")).agg(F.count("*").alias("n")).collect()
    if any(r["length"] is None for r in histogram):
        raise ValueError("a piece has no length")
    counts = {int(r["length"]): int(r["n"]) for r in histogram}
    plan = pack_plan(counts, capacity)
    # A plan row serves ``times * copies`` ranks of one length, from ``rank_from`` on.
    rows, first, seq = [], dict.fromkeys(counts, 0), 0
    for items, times in plan:
        offset = 0
        for item in items:
            rows.append((item, first[item], first[item] + times, seq, offset))
            first[item] += times
            offset += item
        seq += times
    plan_schema = "p_length bigint, rank_from bigint, rank_to bigint, first_seq bigint, p_offset bigint"
    plan_df = spark.createDataFrame(rows, plan_schema)
    blocks = max(1, max(counts.values(), default=1) // rank_block)
    part = F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("bigint")
    # The pieces' own columns stay in a struct, apart from those made here.
    keyed = pieces.select(F.struct(*pieces.columns).alias("row"), F.col(length).cast("bigint").alias("size"), part.alias("part"))
    sums = keyed.groupBy(F.col("size").alias("o_length"), F.col("part").alias("o_part")).agg(F.count("*").alias("n"))
    sums = prefix_offsets(sums, ["o_length"], "o_part", "n", "o_first")
    local = F.row_number().over(W.partitionBy("size", "part").orderBy(*[F.col("row")[c] for c in order])) - 1
    ranked = keyed.withColumn("local", local).join(sums, (F.col("size") == F.col("o_length")) & (F.col("part") == F.col("o_part")))
    ranked = ranked.select("row", "size", (F.col("local") + F.col("o_first")).alias("rank"))
    # The plan has at most a few thousand rows: its size depends on the capacity, not on the input.
    found = ranked.join(
        F.broadcast(plan_df),
        (F.col("size") == F.col("p_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")),
    )
    return found.select(
        *[F.col("row")[c].alias(c) for c in pieces.columns if c not in ("sequence_id", "offset")],
        (F.col("first_seq") + F.col("rank") - F.col("rank_from")).alias("sequence_id"),
        F.col("p_offset").alias("offset"),
    )


def packed_pieces(
    docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """Tokenise and pack ``docs`` (``doc_id, text``): one row per piece with its place, its checksum and, if asked for, its ids."""
    pieces = token_pieces(docs, tokenizer, capacity=capacity, end_id=end_id).withColumn("ids_crc32", F.crc32("ids"))
    # The number tells repeated rows apart and spreads them; it is fixed once the table is written.
    pieces = pieces.withColumn("row_no", F.monotonically_increasing_id())
    pieces = written(pieces if keep_ids else pieces.drop("ids"), "pieces")
    return pack(pieces, order=["row_no"], capacity=capacity).drop("row_no")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids`` (32-bit binary), from the rows of ``packed_pieces(keep_ids=True)``."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("h")))), lambda p: p["h"])
    return packed.groupBy("sequence_id").agg(F.unhex(F.array_join(parts, "")).alias("ids"))
