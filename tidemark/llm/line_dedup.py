"""Line dedup by a deletion-neighbourhood join.

Two lines are near copies if one edit (a unit replaced, inserted or deleted) makes them equal. The unit is a
word where the longer line has MIN_WORDS words or more, so at most one word in eight differs; in shorter lines
it is a character, if the longer has MIN_CHARS of them or more. Deleting one unit at a time gives each line its
variants; lines within one edit share a variant at the same place, or one's variant is the other. Two such lines
also share their first or their last half, so only lines with a half that another line has emit variants, and
only for the other half. A line goes if an equal line or a near copy stands before it, by document id and line
number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_dealt, mapped, values_of, written

#: Of two lines the longer must have so many words for one word to differ, or else so many characters for one character.
MIN_WORDS, MIN_CHARS = 8, 16
WORDS, CHARS = 0, 1
#: Bits of the filter for halves that lines share: 32 a half, up to this many, two set for each. A filter
#: too full lets more lines emit variants, and changes no result.
MAX_FILTER_BITS = 1 << 27


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def units(line: str) -> list[tuple[int, list[str] | str]]:
    """(kind, units) by which a line may be near others; one unit fewer than the longer line of two must have is enough."""
    words = line.split()
    out: list[tuple[int, list[str] | str]] = []
    if len(words) >= MIN_WORDS - 1:
        out.append((WORDS, words))
    if len(words) < MIN_WORDS and len(line) >= MIN_CHARS - 1:
        out.append((CHARS, line))
    return out


def _hash(kind: int, part: list[str] | str, seed: int) -> int:
    return _signed(xxhash.xxh3_64_intdigest((part if kind else " ".join(part)).encode("utf-8", "surrogatepass"), 2 * seed + kind))


def halves(kind: int, line: list[str] | str) -> list[tuple[int, int, int]]:
    """(side, units, hash) of the halves by which a line meets lines of as many units, one more or one less."""
    n, out = len(line), []
    for size in {n // 2, (n - 1) // 2}:
        out.append((0, size, _hash(kind, line[:size], 2 * size)))
        out.append((1, size, _hash(kind, line[n - size :], 2 * size + 1)))
    return out


def variants(kind: int, line: list[str] | str, places: list[int]) -> list[tuple[int, int]]:
    """(hash, place) of the line itself, at place -1, and of the line without the unit at each place."""
    out = [(_hash(kind, line, 0), -1)]
    if len(line) < (MIN_CHARS if kind else MIN_WORDS):
        return out  # too short to be the longer of two
    return out + [(_hash(kind, line[:p] + line[p + 1 :], 0), p) for p in places]


def within_one(a: list[str] | str, b: list[str] | str) -> bool:
    """Whether the edit distance is at most 1."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def near_copies(a: str, b: str) -> bool:
    """Whether two lines are within one edit of each other, by words or by characters."""
    v, w = a.split(), b.split()
    if max(len(v), len(w)) >= MIN_WORDS:
        return within_one(v, w)
    return max(len(a), len(b)) >= MIN_CHARS and within_one(a, b)


def _lines(text: str) -> Iterator[tuple[int, str]]:
    """Numbered lines without outer white space; blank ones don't count."""
    for number, line in enumerate(text.split("\n")):
        line = line.strip()
        if line:
            yield number, line


def line_table(docs: DataFrame) -> DataFrame:
    """One row a line: its 128-bit hash, place, and the hashes of its halves."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            ids, numbers, highs, lows, keys = [], [], [], [], []
            for doc, text in zip(pdf["_id"], pdf["_text"]):
                for number, line in _lines(text):
                    h = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
                    ids.append(doc)
                    numbers.append(number)
                    highs.append(h >> 64)
                    lows.append(h & 0xFFFFFFFFFFFFFFFF)
                    keys.append([k for kind, part in units(line) for _, _, k in halves(kind, part)])
            yield pd.DataFrame({"h1": np.array(highs, np.uint64).view(np.int64), "h2": np.array(lows, np.uint64).view(np.int64), "doc": ids, "line": np.array(numbers, np.int32), "halves": keys})

    return docs.mapInPandas(run, "h1 long, h2 long, doc long, line int, halves array<long>")


def half_filter(lines: DataFrame) -> np.ndarray:
    """Bits, as 64-bit words, set for each half that two different lines share."""
    shared = lines.select(F.explode("halves").alias("half"), "h1").groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("half")
    shared = written(shared, "halves")
    bits = 1 << 10
    while bits < min(32 * shared.count(), MAX_FILTER_BITS):
        bits *= 2
    slots = shared.select(F.explode(F.array(F.pmod("half", F.lit(bits)), F.pmod(F.shiftright("half", 32), F.lit(bits)))).alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits"))
    out = np.zeros(bits // 64, np.int64)
    for row in words.toPandas().itertuples(index=False):  # at most MAX_FILTER_BITS / 64 rows
        out[row.word] = row.bits
    return out.view(np.uint64)


def _candidates(docs: DataFrame, filtered: np.ndarray) -> DataFrame:
    """Distinct lines with a shared half, once for each kind of unit: first place, text, and the places at which to delete units."""
    known = docs.sparkSession.sparkContext.broadcast(filtered)  # of MAX_FILTER_BITS at most

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = known.value
        bits = np.uint64(len(table) * 64 - 1)  # a power of two, less one
        place, low6, half = np.uint64(6), np.uint64(63), np.uint64(32)
        for pdf in parts:
            lines, keys = [], []  # of each line and kind, and of its halves
            for doc, text in zip(pdf["_id"], pdf["_text"]):
                for number, line in _lines(text):
                    for kind, part in units(line):
                        mine = halves(kind, part)
                        lines.append((doc, number, line, kind, len(part), mine))
                        keys += [k for _, _, k in mine]
            k = np.array(keys, np.int64).view(np.uint64)
            a, b = k & bits, (k.view(np.int64) >> np.int64(32)).view(np.uint64) & bits
            hit = ((table[a >> place] >> (a & low6)) & (table[b >> place] >> (b & low6)) & np.uint64(1)).astype(bool).tolist() if len(k) else []
            rows, at = [], 0
            for doc, number, line, kind, n, mine in lines:
                low, high = n, 0  # places from `low` on and before `high`
                for (side, size, _), good in zip(mine, hit[at : at + len(mine)]):
                    if good:
                        if side == 0:
                            low = min(low, size)
                        else:
                            high = max(high, n - size)
                at += len(mine)
                if low < n or high > 0:
                    h = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
                    rows.append((_signed(h >> 64), _signed(h & 0xFFFFFFFFFFFFFFFF), kind, doc, number, line, low, high))
            yield pd.DataFrame(rows, columns=["h1", "h2", "kind", "doc", "line", "text", "low", "high"])

    lines = docs.mapInPandas(run, "h1 long, h2 long, kind int, doc long, line int, text string, low int, high int")
    return lines.groupBy("h1", "h2", "kind").agg(F.min(F.struct("doc", "line")).alias("at"), F.first("text").alias("text"), F.first("low").alias("low"), F.first("high").alias("high"))


def near_lines(candidates: DataFrame) -> DataFrame:
    """at and by: for each candidate with a near copy before it, the first of those. No pairs within a group are listed."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for begin in range(0, len(pdf), 500):
                rows = []
                for doc, line, kind, text, low, high in pdf.iloc[begin : begin + 500].itertuples(index=False):
                    part = text if kind else text.split()
                    places = sorted({*range(low, len(part)), *range(min(high, len(part)))})
                    rows += [(key, p, doc, line) for key, p in variants(kind, part, places)]
                yield pd.DataFrame(rows, columns=["key", "place", "doc", "line"])

    flat = candidates.select("at.doc", "at.line", "kind", "text", "low", "high")
    v = written(flat.mapInPandas(run, "key long, place int, doc long, line int"), "variants")
    met = written(v.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "met")  # most variants meet no other
    v = written(join_dealt(v, met, ["key"]).select("key", "place", F.struct("doc", "line").alias("at")), "meeting")
    by_place = written(v.groupBy("key", "place").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n")), "firsts")
    replaced = by_place.where((F.col("place") >= 0) & (F.col("first") < F.col("last"))).select("key", "place", "first", "n")
    whole = F.col("place") == -1
    inserted = by_place.groupBy("key").agg(F.min(F.when(whole, F.col("first"))).alias("whole"), F.min(F.when(~whole, F.col("first"))).alias("part"), F.sum("n").alias("n")).dropna()
    links = join_dealt(v, replaced, ["key", "place"]).select("at", F.col("first").alias("by")).union(
        join_dealt(v, inserted, ["key"]).select("at", F.when(whole, F.col("part")).otherwise(F.col("whole")).alias("by"))
    )
    links = links.where(F.col("by") < F.col("at")).distinct()
    text = candidates.select("at", "text").dropDuplicates(["at"])
    pairs = links.join(text, "at").join(text.select(F.col("at").alias("by"), F.col("text").alias("by_text")), "by")
    near = F.pandas_udf(lambda a, b: pd.Series([near_copies(x, y) for x, y in zip(a, b)], dtype=bool), "boolean")
    return pairs.where(near("text", "by_text")).groupBy("at").agg(F.min("by").alias("by"))


def dropped_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, line, by_doc, by_line: each line that goes, and the earliest line for which it goes."""
    docs = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).dropna()
    lines = written(line_table(docs), "lines")
    candidates = written(_candidates(docs, half_filter(lines)), "candidates")
    classes = candidates.select("at", "h1", "h2").dropDuplicates(["at"])
    near = written(near_lines(candidates).join(classes, "at"), "near")
    often = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("doc", "line")).alias("first")).where("n > 1")
    often = often.join(near.select("h1", "h2", F.col("by").alias("near")), ["h1", "h2"], "left")
    # a line goes for the first of its kind, or with all its repeats for a near copy before that
    by = written(often.select("h1", "h2", "n", F.least("first", "near").alias("by")), "repeats")
    equal = join_dealt(lines.select("h1", "h2", F.struct("doc", "line").alias("at")), by, ["h1", "h2"]).select("at", "by")
    found = equal.union(near.select("at", "by")).where(F.col("by") < F.col("at")).groupBy("at").agg(F.min("by").alias("by"))
    return found.select("at.doc", "at.line", F.col("by.doc").alias("by_doc"), F.col("by.line").alias("by_line"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df without repeated lines, with n_lines, n_dropped and dropped (line, by_doc, by_line of each line that went).

    Lines are what line feeds part; outer white space doesn't count for their comparison; blank lines
    stay. Null texts stay null, with 0 lines; empty texts stay; very long texts and lines are read whole;
    of equal lines the first by id and number stays. Rows with a null id pass through unchanged, as do all
    other columns, exactly, but for those that have one of the three new names: these are replaced. Of
    repeated ids, lines at the same place are one line; an empty table gives no rows.
    """
    names = {"n_lines": "long", "n_dropped": "long", "dropped": "array<struct<line:int,by_doc:bigint,by_line:int>>"}
    gone = dropped_lines(df, id_col, text_col).groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("line", "by_doc", "by_line"))).alias("_dropped"))
    base = df.drop(*names)
    joined = base.join(gone.withColumnRenamed("doc", "_doc"), base[id_col] == F.col("_doc"), "left").drop("_doc")

    def run(parts: Iterator) -> Iterator[tuple]:
        for batch in parts:
            texts, gone = values_of(batch, text_col), [d or [] for d in values_of(batch, "_dropped")]
            kept = []
            for text, rows in zip(texts, gone):
                if rows:
                    numbers = {r["line"] for r in rows}
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in numbers)
                kept.append(text)
            yield batch, {text_col: kept, "n_lines": [0 if t is None else sum(1 for _ in _lines(t)) for t in texts], "n_dropped": list(map(len, gone)), "dropped": gone}

    return mapped(joined, run, {text_col: "string"} | names, keep=base.columns)
