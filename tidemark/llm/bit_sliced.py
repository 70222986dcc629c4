"""Exact top-k inner products over a bit-sliced index of quantised vectors.

A shard of the index holds, for each attribute and bit of its value, one bitmap over the shard's rows.
A query's inner product with all rows of a shard is one bitmap sum: its digits say which slices are
added at which weight (a negative digit adds the complement, and a constant sets that right), and
carry-save adders bring all slices of a weight down to one. The best rows are then chosen from the
most significant slice of the sums downward; rows level at the end are taken in order of id.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a shard.
SHARD_ROWS = 16_384
#: Queries, and numbers in them, that a task holds; groups of shards that each query is sent to, if four a core are not more.
HELD_QUERIES, HELD_NUMBERS, GROUPS = 32_768, 1 << 22, 64


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """id and q = floor(scale * x) of each component; without null ids, and vectors that are or hold null or non-finite.

    A component whose q is no long, by 2^62 or more, is an error: no score of it could be one.
    """
    x = F.col(vec_col)
    sound = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    scaled = lambda v: v.cast("double") * F.lit(float(scale))
    too_large = F.raise_error(F.lit("a component is too large for integer scores")).cast("long")
    q = F.transform(x, lambda v: F.when(F.abs(scaled(v)) < float(1 << 62), F.floor(scaled(v))).otherwise(too_large))
    return df.where(F.col(id_col).isNotNull() & F.coalesce(sound, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), q.alias("q"))


def pack(bits: np.ndarray) -> np.ndarray:
    """Boolean rows as bitmaps of 64-bit words, row i in bit i % 64 of word i // 64."""
    out = np.packbits(bits, axis=-1, bitorder="little")
    out = np.pad(out, [(0, 0)] * (out.ndim - 1) + [(0, -out.shape[-1] % 8)])
    return np.ascontiguousarray(out).view(np.uint64)


def slices_of(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Bitmaps (attribute, bit, word) of values (row, attribute), less their least value, which is given too."""
    least = int(values.min(initial=0))
    width = max(1, int(values.max(initial=0) - least).bit_length())
    shifted = (values.astype(np.uint64) - np.uint64(least & 0xFFFFFFFFFFFFFFFF)).T
    return np.stack([pack((shifted >> np.uint64(b)) & np.uint64(1) != 0) for b in range(width)], axis=1), least


@functools.lru_cache(1 << 16)
def digits(value: int) -> list[tuple[int, int]]:
    """(place, +1 or -1) of a number's digits, no two next to each other (non-adjacent form)."""
    out, place = [], 0
    while value:
        if value & 1:
            digit = 2 - (value & 3)
            out.append((place, digit))
            value -= digit
        value >>= 1
        place += 1
    return out


def score_slices(slices: np.ndarray, query: list[int]) -> tuple[np.ndarray, int]:
    """Bitmaps (bit, word) of sum(query * attribute) for all rows, plus a constant, all sums at least 0; and that constant."""
    width, words = slices.shape[1], slices.shape[2]
    flat = slices.reshape(-1, words)
    terms = [(attribute, place, digit) for attribute, value in enumerate(query) for place, digit in digits(int(value))]
    terms.sort(key=lambda t: -t[2])
    at, places, signs = np.array(terms, np.int64).reshape(-1, 3).T
    plus = int((signs > 0).sum())
    # -x = (2^width - 1 - x) - (2^width - 1)
    offset = sum(((1 << width) - 1) << place for _, place, _ in terms[plus:])
    n_columns = int(places.max(initial=0)) + width if terms else 0
    stack, above, half = (np.empty((2 * len(terms) + 2, words), np.uint64) for _ in range(3))
    out, k, carried = [], 0, 0
    while k < n_columns or carried:
        # what was carried lies below in stack, and this weight's slices come on top
        here = np.flatnonzero((places <= k) & (places > k - width))
        n = carried + len(here)
        if len(here):
            np.take(flat, at[here] * width + k - places[here], axis=0, out=stack[carried:n], mode="clip")
            negative = stack[carried + int((here < plus).sum()) : n]
            np.invert(negative, out=negative)
        carried = 0
        while n > 2:  # three bitmaps of a weight become one, and one of the next weight
            m = n // 3
            x, y, z = (stack[n - i * m : n - (i - 1) * m] for i in (3, 2, 1))
            rest, carry = half[:m], above[carried : carried + m]
            np.bitwise_xor(x, y, out=rest)
            np.bitwise_and(x, y, out=carry)
            np.bitwise_xor(rest, z, out=x)
            np.bitwise_and(rest, z, out=rest)
            np.bitwise_or(carry, rest, out=carry)
            n, carried = n - 2 * m, carried + m
        if n == 2:
            above[carried] = stack[0] & stack[1]
            stack[0] ^= stack[1]
            carried += 1
        out.append(stack[0].copy() if n else np.zeros(words, np.uint64))
        stack, above, k = above, stack, k + 1
    return (np.stack(out) if out else np.zeros((1, words), np.uint64)), offset


def top_rows(sums: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k greatest sums among the rows of a bitmap; of level rows the first."""
    chosen, level = np.zeros_like(among), among
    taken = 0
    for plane in sums[::-1]:
        higher = level & plane
        n = int(np.bitwise_count(higher).sum())
        if taken + n >= k:
            level = higher
            if taken + n == k:
                break
        else:
            chosen |= higher
            taken += n
            level = level & ~plane
    rows = np.flatnonzero(np.unpackbits(chosen.view(np.uint8), bitorder="little"))
    rest = np.flatnonzero(np.unpackbits(level.view(np.uint8), bitorder="little"))[: k - taken]
    return np.concatenate((rows, rest))


def sums_at(sums: np.ndarray, rows: np.ndarray) -> list[int]:
    bits = (sums[:, rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)
    return [sum(int(bit) << b for b, bit in enumerate(column)) for column in bits.T]


def search_shard(ids: np.ndarray, values: np.ndarray, queries: Sequence[tuple[int, Sequence[int]]], k: int) -> Iterator[tuple[int, int, int]]:
    """(query, id, score) of each query's best rows of a shard, itself left out; ids ascend."""
    dims = max([values.shape[1], *(len(q) for _, q in queries)])
    values = np.pad(values, ((0, 0), (0, dims - values.shape[1])))
    slices, least = slices_of(values)
    everyone = pack(np.ones(len(ids), bool))
    for query, q in queries:
        sums, offset = score_slices(slices, q)
        offset -= least * sum(map(int, q))
        among = everyone.copy()
        for own in range(*np.searchsorted(ids, [query, query + 1])):
            among[own >> 6] &= ~np.uint64(1 << (own & 63))
        rows = top_rows(sums, among, k)
        for row, total in zip(rows, sums_at(sums, rows)):
            yield query, int(ids[row]), total - offset


def top_k(df: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, id, score: the k best inner products of each row whose id `every` divides, ties to smaller ids.

    Every other row with a sound vector is a candidate; shorter vectors count as filled up with zeros, also
    empty ones; a score, or a component, that doesn't fit in a long is an error. Other columns are left out,
    whatever their names. Null ids and unsound vectors take no part; repeated ids are candidates
    of their own, and one query (of its least vector); with fewer than k candidates all are returned; an empty table gives
    no rows. Each group of shards gives at most k rows a query.
    """
    rows = quantised(df, id_col, vec_col, scale)
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    asked = rows.where(F.pmod("id", F.lit(every)) == 0).groupBy("id").agg(F.min("q").alias("q"))
    n_asked, numbers = asked.agg(F.count("*"), F.coalesce(F.sum(F.size("q")), F.lit(0))).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    groups = min(shards, max(GROUPS, 4 * cores))
    blocks = max(1, math.ceil(n_asked / HELD_QUERIES), math.ceil(numbers / HELD_NUMBERS), min(math.ceil(2 * cores / groups), n_asked // 256))
    # each block of queries meets each group of shards in a task of its own; rows are sent to as many tasks as there are blocks, queries to as many as groups
    every_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # dealt by row, not by id alone: a repeated id must not fill one group
    group = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(groups)).cast("int")
    index = rows.withColumn("group", group).withColumn("block", every_of(blocks)).withColumn("row", F.lit(True))
    sent = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("group", every_of(groups)).withColumn("row", F.lit(False))
    tile = F.col("block") * groups + F.col("group")
    tiles = index.unionByName(sent).select(tile.alias("tile"), "row", "id", "q").repartitionById(blocks * groups, "tile")

    def run(parts):
        import pyarrow as pa
        import pyarrow.compute as pc

        asked: list[tuple[int, np.ndarray]] = []
        best: dict[int, list[tuple[int, int]]] = {}
        held, n = [], 0

        def search(shard: pa.Table) -> None:
            ids, q = (shard.column(c).combine_chunks() for c in ("id", "q"))
            sizes = pc.list_value_length(q).to_numpy(zero_copy_only=False)
            values = np.zeros((len(ids), int(sizes.max(initial=0))), np.int64)
            values[np.arange(values.shape[1]) < sizes[:, None]] = q.flatten().to_numpy()
            for query, row, score in search_shard(ids.to_numpy(), values, asked, k):
                if not -(1 << 63) <= score < 1 << 63:
                    raise OverflowError("a score is too large for a long")
                best.setdefault(query, []).append((-score, row))
            for query, found in best.items():
                best[query] = sorted(found)[:k]

        for batch in parts:  # queries come first, then rows by id
            first_row = int(np.searchsorted(batch.column("row").to_numpy(zero_copy_only=False), True))
            asks = batch.slice(0, first_row)
            asked += [(i.as_py(), q.values.to_numpy().copy()) for i, q in zip(asks.column("id"), asks.column("q"))]
            held.append(batch.slice(first_row).select(["id", "q"]))
            n += len(held[-1])
            if n >= SHARD_ROWS:
                table = pa.Table.from_batches(held)
                for begin in range(0, n - SHARD_ROWS + 1, SHARD_ROWS):
                    search(table.slice(begin, SHARD_ROWS))
                n %= SHARD_ROWS
                held = table.slice(len(table) - n).to_batches()
        if n:
            search(pa.Table.from_batches(held))
        found = [(query, row, -worth) for query, rows in best.items() for worth, row in rows]
        for begin in range(0, len(found), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found[begin : begin + 10_000])], names=["query_id", "id", "score"])

    found = tiles.sortWithinPartitions("row", "id").select("row", "id", "q").mapInArrow(run, "query_id long, id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
