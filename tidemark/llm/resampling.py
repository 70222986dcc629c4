"""Importance resampling towards a target: hashed word and pair counts, gains by bucket, and a Gumbel draw.

A head of frequent words and pairs is broadcast: the CRC state that each word leaves, and the bucket of each
pair. Features outside the head take their CRC directly, pairs from the state of their first word on. Which
features are in the head changes the speed only: buckets, and so all totals, are exact for every document.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, mapped, per_worker, written

#: Frequent words and pairs that are broadcast, words that a worker keeps beside them, and bytes of text taken at a time.
HEAD_FEATURES, MAX_WORDS, BLOCK_BYTES = 60_000, 300_000, 4_000_000
#: Bytes of words as they are, A-Z as a-z, and a space for every other ASCII character.
WORD_BYTES = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256)).lower()


class _Codes(dict):
    """A number for each word, in order of appearance, with the CRC state that the word leaves and the word after a space."""

    def __init__(self, head: list[bytes] = ()):
        self.states: list[int] = []
        self.after_space: list[bytes] = []
        for word in head:
            self[word]

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        self.states.append(crc32(word))
        self.after_space.append(b" " + word)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def stretches(texts: list[bytes], most: int = BLOCK_BYTES) -> Iterator[tuple[list[bytes], list[int], bool]]:
    """Words of whole texts in bounded blocks: words, where each text ends in them, and whether the last one goes on.

    The next block of a text that goes on starts with its last word so far, if it has one.
    """
    words, ends, size = [], [], 0
    for text in texts:
        if ends and size + len(text) > most:
            yield words, ends, False
            words, ends, size = [], [], 0
        text, at = text.translate(WORD_BYTES), 0
        while len(text) - at > most and (cut := text.find(b" ", at + most)) >= 0:
            words += text[at:cut].split()
            yield words, [*ends, len(words)], True
            words, ends, size, at = words[-1:], [], 0, cut
        words += text[at:].split()
        ends.append(len(words))
        size += len(text) - at
    if ends:
        yield words, ends, False


def _texts(batch) -> list[bytes]:
    import pyarrow as pa

    return [t or b"" for t in batch.column(batch.schema.names.index("_text")).cast(pa.binary()).to_pylist()]


def frequent_features(df: DataFrame, most: int = HEAD_FEATURES) -> tuple[list[bytes], dict[tuple[int, int], int]]:
    """The words and pairs that all texts hold most often, as far as tasks' own counts show it: words, and pairs by the places of their words.

    Each task counts what comes up often in its blocks and keeps a bounded number of features; the sums meet in
    one shuffle of at most that number of rows a task. Of the sums, the driver gets those from the power of two on
    from which they are no more than `most`.
    """

    def run(batches: Iterator):
        import pyarrow as pa

        seen: Counter = Counter()
        for batch in batches:
            for words, ends, _ in stretches(_texts(batch)):
                codes = _Codes()
                ids = codes.of(words)
                names = list(codes)
                counts = np.bincount(ids, minlength=1)
                seen.update({(names[i],): int(counts[i]) for i in np.nonzero(counts > 1)[0]} if names else {})
                inside = np.ones(max(len(ids) - 1, 0), bool)
                inside[[e - 1 for e in ends if 0 < e < len(ids)]] = False
                pairs, counts = np.unique((ids[:-1] << 32 | ids[1:])[inside], return_counts=True)
                often = counts > 2
                seen.update({(names[p >> 32], names[p & 0xFFFFFFFF]): n for p, n in zip(pairs[often].tolist(), counts[often].tolist())})
                if len(seen) > 4 * most:
                    seen = Counter(dict(seen.most_common(2 * most)))
        top = seen.most_common(most)
        columns = [f[0] for f, _ in top], [f[1] if len(f) > 1 else None for f, _ in top], [n for _, n in top]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.binary(), pa.int64()))], names=["first", "second", "n"])

    summed = df.mapInArrow(run, "first binary, second binary, n long").groupBy("first", "second").agg(F.sum("n").alias("n"))
    counted = written(summed, "frequent")
    sizes = counted.groupBy(F.floor(F.log2("n")).alias("power")).count().orderBy(F.desc("power")).collect()  # 63 rows at most
    least, held = 1 << 62, 0
    for r in sizes:
        held += r["count"]
        if held > most:
            break
        least = 1 << r["power"]
    rows = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "first", "second").collect()
    dropped(counted)
    words = [bytes(r["first"]) for r in rows if r["second"] is None]
    place = {w: i for i, w in enumerate(words)}
    pairs = {}
    for r in rows:
        if r["second"] is not None and r["first"] in place and r["second"] in place:
            a, b = bytes(r["first"]), bytes(r["second"])
            pairs[place[a], place[b]] = crc32(b" " + b, crc32(a))
    return words, pairs


class Hasher:
    """Buckets of all words and pairs of a text."""

    def __init__(self, words: list[bytes], pairs: dict[tuple[int, int], int], buckets: int):
        self.words, self.buckets, self.n_head = words, buckets, max(len(words), 1)
        keys = np.array([a * self.n_head + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        #: one more at the end that no pair has
        self.keys = np.append(keys[order], -1)
        self.found = np.append(np.array(list(pairs.values()), np.int64)[order] % buckets, 0)
        self.kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
        self.reset()

    def reset(self) -> None:
        self.codes = _Codes(self.words)
        self.one = np.empty(0, np.int64)

    def of(self, texts: list[bytes]) -> Iterator[bytes]:
        """For each text the buckets of its features, packed."""
        parts: list[bytes] = []
        carried = False
        for words, ends, more in stretches(texts):
            if len(self.codes) > MAX_WORDS:
                self.reset()
            ids = self.codes.of(words)
            one, two = self._one(ids), self._two(ids, ends)
            start = 0
            for k, end in enumerate(ends):
                first = start + (carried and k == 0)  # a word that the block before has counted
                parts += [one[first:end].tobytes(), two[start : max(end - 1, start)].tobytes()]
                if not (more and k == len(ends) - 1):
                    yield b"".join(parts)
                    parts = []
                start = end
            carried = more and bool(words)

    def _one(self, ids: np.ndarray) -> np.ndarray:
        known = len(self.one)
        if known < len(self.codes):
            self.one = np.append(self.one, np.array(self.codes.states[known:], np.int64) % self.buckets)
        return self.one[ids].astype(self.kind)

    def _two(self, ids: np.ndarray, ends: list[int]) -> np.ndarray:
        """The bucket of each word with the next one; where a text ends there is none, and what stands there is not read."""
        left, right = ids[:-1], ids[1:]
        keys = np.where((left < self.n_head) & (right < self.n_head), left * self.n_head + right, -2)
        at = np.searchsorted(self.keys[:-1], keys)
        out, tail = self.found[at], self.keys[at] != keys
        tail[[e - 1 for e in ends if 0 < e < len(ids)]] = False
        rest, states, after = np.nonzero(tail)[0], self.codes.states, self.codes.after_space
        direct = [crc32(after[b], states[a]) for a, b in zip(left[rest].tolist(), right[rest].tolist())]
        out[rest] = np.array(direct, np.int64) % self.buckets
        return out.astype(self.kind)


def hashed_features(df: DataFrame, head: tuple, buckets: int, keep: list[str]) -> DataFrame:
    """The columns `keep`, n_words, n_features, and the packed buckets of all features of _text."""
    shared, name = df.sparkSession.sparkContext.broadcast(head), uuid.uuid4().hex
    adds = {"n_words": "long", "n_features": "long", "packed": "binary"}

    def run(batches: Iterator):
        hasher = per_worker(("features", name, buckets), lambda: Hasher(*shared.value, buckets))
        wide = hasher.kind.itemsize
        for batch in batches:
            texts, start = _texts(batch), 0
            while start < len(texts):  # slices of bounded size, or one row
                end, size = start, 0
                while end < len(texts) and (end == start or size + len(texts[end]) <= BLOCK_BYTES):
                    size += len(texts[end])
                    end += 1
                packed = list(hasher.of(texts[start:end]))
                counts = [len(p) // wide for p in packed]
                yield batch.slice(start, end - start), {"n_words": [(n + 1) // 2 for n in counts], "n_features": counts, "packed": packed}
                start = end

    return mapped(df, run, adds, keep=keep)


def bucket_totals(hashed: DataFrame, buckets: int) -> np.ndarray:
    """How many features all rows have in each bucket; a task adds its own up first."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator):
        import pyarrow as pa

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(packed, kind), minlength=buckets)
        some = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in hashed.select("packed").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """Thousandths of the log of how much likelier each bucket is in the target, add-one smoothed, floored."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return [math.floor(1000 * math.log(float((t + 1) * (s_all + n)) / float((s + 1) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist())]


def resample(df: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, buckets: int = 10_000, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: id, n_features, weight, score, and rank (from 1) if it is drawn.

    Null and empty texts have no features, weigh 0 and are never drawn; long texts are hashed whole, block
    by block; a null id draws its noise by the seed alone and comes last among equal scores; repeated rows
    get ranks of their own, one after the other; an empty target or table gives gains by smoothing alone, or no
    rows. Other columns are left out, whatever their names. Of df and target, only texts and ids are read.
    """
    docs = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    head = frequent_features(docs.select("_text"))
    hashed = written(hashed_features(docs, head, buckets, ["_id"]), "features")
    wanted = hashed_features(target.select(F.col(text_col).alias("_text")), head, buckets, [])
    gains = np.array(bucket_gains(bucket_totals(hashed, buckets), bucket_totals(wanted, buckets)), np.int64)
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator):
        for batch in batches:
            weights = []
            for packed in batch.column(batch.schema.names.index("packed")).to_pylist():
                features = np.frombuffer(packed, kind)
                weights.append(int(gains[features].sum()) // len(features) if len(features) else 0)
            yield batch, {"weight": weights}

    weighed = mapped(hashed, run, {"weight": "long"}, keep=["_id", "n_words", "n_features"])
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = written(weighed.withColumn("score", F.col("weight") + noise), "scored")
    return ranked(scored, percent, F.col("n_words") >= least_words, "_id").select(F.col("_id").alias(id_col), "n_features", "weight", "score", "rank")


def ranked(scored: DataFrame, percent: int, fit, id_col: str) -> DataFrame:
    """scored with the ranks of the highest scores, floor(percent * N / 100) of the N rows that fit; ties to the smaller id, null ids last.

    Scores are whole thousandths of logarithms: under 200,000 values whatever the number of rows. So their
    counts are added up in one task and broadcast, and only rows of one score are put in order together, equal
    rows as one.
    """
    every, above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    counts = scored.where(fit).groupBy("score").agg(F.count("*").alias("_n"))
    places = counts.select("score", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_before"), F.floor(F.sum("_n").over(every) * percent / 100).alias("_most"))
    places = places.where("_before < _most")
    joined = scored.join(F.broadcast(places), "score", "left").withColumn("_in", F.coalesce(fit, F.lit(False)) & F.col("_before").isNotNull())
    inside = joined.where("_in").groupBy("score", id_col, "n_features", "weight", "_before", "_most").agg(F.count("*").alias("_copies"))
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last(id_col), "n_features", "weight").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_copies").over(order), F.lit(0)))
    inside = inside.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"))
    rank = F.col("_before") + F.col("_copy")
    columns = [id_col, "n_features", "weight", "score"]
    drawn = inside.select(*columns, F.when(rank <= F.col("_most"), rank).alias("rank"))
    return drawn.unionByName(joined.where("not _in").select(*columns, F.lit(None).cast("long").alias("rank")))
