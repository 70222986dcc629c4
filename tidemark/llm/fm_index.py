"""Benchmark decontamination: an FM-index over each shard of the corpus, searched for benchmark phrases.

A shard is a run of documents of one task. Its text is a list of word symbols: words that no phrase
holds become one border symbol, and runs too short for any phrase are left out, since nothing can
occur there. The Burrows-Wheeler transform of the shard is kept as a wavelet matrix with rank counts;
phrases are searched backwards, all of them in step; occurrences are located by walking to the next
sampled suffix position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, values_of, written

#: A-Z lowered, every other ASCII byte that is no word character a space; bytes of other characters kept.
_WORD_BYTES = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: The same words as places in a text.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Positions kept for every so many suffixes; words that a shard holds at most before it is searched.
SAMPLE, SHARD_WORDS = 8, 2_000_000
#: Text of the benchmark, in bytes, that one pass over the corpus takes about (its phrases are broadcast).
PASS_BYTES = 4 << 20
#: Passes in one job; after so many, what has been found is written and read again.
PASSES_AT_ONCE = 8


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def phrases_of(items: list[tuple], size: int) -> tuple[dict[bytes, int], list[tuple[np.ndarray, list]]]:
    """Symbols by word, and each distinct phrase as symbols with the items that have it."""
    symbols: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set] = {}
    for item, text in items:
        words = [symbols.setdefault(w, len(symbols) + 1) for w in words_of(text or "")]
        for i in range(max(1, len(words) - size + 1) if words else 0):
            found.setdefault(tuple(words[i : i + size]), set()).add(item)
    return symbols, [(np.array(p, np.int64), list(having)) for p, having in found.items()]


class WaveletMatrix:
    """Ranks of symbols in a sequence, a bit of the symbol a level."""

    def __init__(self, sequence: np.ndarray, sigma: int):
        self.levels, now = [], sequence
        for shift in range(max(1, int(sigma).bit_length()) - 1, -1, -1):
            bits = (now >> shift) & 1
            ones = np.concatenate(([0], np.cumsum(bits, dtype=np.int32)))
            self.levels.append((shift, ones, len(now) - int(ones[-1])))
            now = np.concatenate((now[bits == 0], now[bits == 1]))

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol stands before a place."""
        low, high = np.zeros_like(upto), upto
        for shift, ones, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            a, b = ones[low], ones[high]
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return high - low


class FMIndex:
    """Over symbols of 1 and more; 0 stands after each run, and nothing that is searched holds it."""

    def __init__(self, sequence: np.ndarray, sigma: int, sample: int = SAMPLE):
        n = len(sequence)
        border = sequence == 0
        runs = np.cumsum(border)
        rank = np.where(border, runs - 1, runs[-1] - 1 + sequence)  # borders differ, so every suffix does
        step = 1
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
        while rank.max() < n - 1:
            after = np.zeros(n, np.int64)
            after[:-step] = rank[step:] + 1
            rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
            step *= 2
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        self.n, self.bwt = n, sequence[order - 1]
        self.wavelet = WaveletMatrix(self.bwt, sigma)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(sequence, minlength=sigma + 1))))
        kept = (order % sample == 0) | (self.bwt == 0)  # at a run's start too: the walk never meets a border
        self.kept, self.place = kept, np.where(kept, order, -1)[kept]
        self.kept_rank = np.cumsum(kept) - 1

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix range of each phrase (rows of symbols, filled up with zeros)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = live[(lengths[live] >= back) & (high[live] > low[live])]
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - back]
            low[live] = self.before[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.wavelet.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            kept = self.kept[rows[live]]
            done = live[kept]
            out[done] = self.place[self.kept_rank[rows[done]]] + steps[done]
            live = live[~kept]
            symbol = self.bwt[rows[live]]
            rows[live] = self.before[symbol] + self.wavelet.rank(symbol, rows[live])
            steps[live] += 1
        return out


class ShardSearch:
    """Finds the phrases of a benchmark in shards of symbol lists."""

    def __init__(self, symbols: dict[bytes, int], phrases: list[tuple[np.ndarray, list]]):
        self.symbols, self.owners = symbols, [having for _, having in phrases]
        self.lengths = np.array([len(p) for p, _ in phrases], np.int64)
        self.table = np.zeros((len(phrases), int(self.lengths.max(initial=1))), np.int64)
        for k, (p, _) in enumerate(phrases):
            self.table[k, : len(p)] = p

    def coded(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.symbols.get, words, repeat(0)), np.int32, len(words))

    def hits(self, docs: list[np.ndarray]) -> Iterator[tuple[list[tuple[int, int]], set]]:
        """Of each document: merged word spans [start, end) that phrases cover, and the items they are of."""
        spans: list[list[tuple[int, int]]] = [[] for _ in docs]
        items: list[set] = [set() for _ in docs]
        if len(self.lengths) and docs:
            starts = np.cumsum([0, *(len(d) + 1 for d in docs)])
            flat = np.zeros(starts[-1] + 1, np.int32)
            for at, d in zip(starts, docs):
                flat[at : at + len(d)] = d
            edges = np.flatnonzero(np.diff(np.concatenate(([0], flat > 0, [0]))))
            begin, end = edges[::2], edges[1::2]
            long = end - begin >= self.lengths.min()
            begin, end = begin[long], end[long]
            if len(begin):
                sizes = end - begin + 1
                to = np.concatenate(([0], np.cumsum(sizes)))
                shift = np.repeat(begin - to[:-1], sizes)
                where = np.arange(to[-1]) + shift  # place in flat of each place in the text; borders fall on other words
                text = flat[where].astype(np.int64)
                text[to[1:] - 1] = 0
                index = FMIndex(text, len(self.symbols))
                low, high = index.search(self.table, self.lengths)
                many = np.maximum(high - low, 0)
                which = np.repeat(np.arange(len(many)), many)
                rows = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
                at = where[index.locate(rows)]
                doc = np.searchsorted(starts, at, side="right") - 1
                at -= starts[doc]
                for i in np.lexsort((at, doc)):
                    d, a, b = doc[i], int(at[i]), int(at[i] + self.lengths[which[i]])
                    items[d].update(self.owners[which[i]])
                    if spans[d] and spans[d][-1][1] >= a:
                        spans[d][-1] = (spans[d][-1][0], max(b, spans[d][-1][1]))
                    else:
                        spans[d].append((a, b))
        yield from zip(spans, items)


def _shards(parts: Iterator, text_col: str, search: ShardSearch) -> Iterator[tuple]:
    """Batches, or slices of them, of at most about SHARD_WORDS words with their documents; a longer document is a shard of its own."""
    for batch in parts:
        docs, begin, held = [], 0, 0
        for k, text in enumerate(values_of(batch, text_col)):
            docs.append(search.coded(words_of(text) if text is not None else []))
            held += len(docs[-1])
            if held >= SHARD_WORDS:
                yield batch.slice(begin, k + 1 - begin), docs
                docs, begin, held = [], k + 1, 0
        if docs:
            yield batch.slice(begin), docs


FOUND = {"n_words": "long", "hit_spans": "array<struct<start:int,end:int>>", "hit_items": "array<string>"}


def item_parts(benchmark: DataFrame, size: int, item_col: str, text_col: str, part_bytes: int) -> DataFrame:
    """item (as a string), part and text: items of over part_bytes are cut into parts that overlap by size - 1 words, so no phrase is lost."""

    def run(parts: Iterator) -> Iterator[tuple]:
        import pyarrow as pa

        for batch in parts:
            items, texts = [], []
            for item, text in zip(values_of(batch, "item"), values_of(batch, "text")):
                words = words_of(text) if len(text) * 4 > part_bytes else []
                if not words:
                    items.append(item)
                    texts.append(text)
                    continue
                begin = 0
                while True:
                    end, held = begin, 0
                    while end < len(words) and (held < part_bytes or end - begin < size):
                        held += len(words[end]) + 1
                        end += 1
                    items.append(item)
                    texts.append(b" ".join(words[begin:end]).decode("utf-8", "surrogatepass"))
                    if end == len(words):
                        break
                    begin = end - size + 1
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(texts, pa.string()), pa.array(range(len(items)), pa.int32())], names=["item", "text", "part"])

    known = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).dropna()
    return known.mapInArrow(run, "item string, text string, part int")


def find_phrases(df: DataFrame, benchmark: DataFrame, size: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", pass_bytes: int = PASS_BYTES, cut: bool = False) -> DataFrame:
    """df with n_words, hit_spans (merged word spans) and hit_items (sorted item ids as strings).

    A phrase is `size` consecutive words of an item, or the whole of a shorter item. Items are read in
    blocks of about pass_bytes of text, longer items in overlapping parts, so what is broadcast is
    bounded; each block is one more narrow step over the corpus, without a shuffle, and after every
    PASSES_AT_ONCE blocks the hits so far are written. With cut, each hit span is taken out of the text,
    from its first letter to its last; other texts stay as they are. Null or empty texts and items have
    no words; an item without an id can't be reported and isn't searched for; very long texts are
    shards of their own; repeated rows are judged each on its own; ids and extra columns pass through
    exactly; columns of the three new names are replaced; an empty corpus or benchmark gives no hits.
    """
    part_bytes = max(1, pass_bytes // 4)
    parts = item_parts(benchmark, size, item_col, item_text_col, part_bytes)
    total = parts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // pass_bytes))
    out = df.drop(*FOUND)
    if blocks > 1:
        parts = written(parts, "items")
    for block in range(blocks):
        mine = parts if blocks == 1 else parts.where(F.pmod(F.xxhash64("item", "part", "text"), F.lit(blocks)) == block)
        items = [(r["item"], r["text"]) for r in mine.select("item", "text").collect()]  # about pass_bytes
        if block and block % PASSES_AT_ONCE == 0:
            out = written(out, "hits")
        out = _one_block(out, items, size, text_col, first=block == 0, cut=cut and block == blocks - 1)
    return out


def _one_block(df: DataFrame, items: list[tuple[str, str]], size: int, text_col: str, first: bool, cut: bool) -> DataFrame:
    known = df.sparkSession.sparkContext.broadcast(phrases_of(items, size))

    def run(parts: Iterator) -> Iterator[tuple]:
        search = ShardSearch(*known.value)
        for batch, docs in _shards(parts, text_col, search):
            found = list(search.hits(docs))
            if first:
                new = {"n_words": [len(d) for d in docs], "hit_spans": [[{"start": a, "end": b} for a, b in spans] for spans, _ in found], "hit_items": [sorted(items) for _, items in found]}
            else:
                new = {
                    "n_words": values_of(batch, "n_words"),
                    "hit_spans": [_merged([(s["start"], s["end"]) for s in old] + spans) for old, (spans, _) in zip(values_of(batch, "hit_spans"), found)],
                    "hit_items": [sorted({*old, *items}) for old, (_, items) in zip(values_of(batch, "hit_items"), found)],
                }
            if cut:
                new[text_col] = [without(t, s) if s else t for t, s in zip(values_of(batch, text_col), new["hit_spans"])]
            yield batch, new

    return mapped(df, run, FOUND | ({text_col: "string"} if cut else {}))


def without(text: str, spans: list[dict]) -> str:
    """A text without the spans of words."""
    places = [m.span() for m in _WORD.finditer(text)]
    parts, at = [], 0
    for span in spans:
        parts.append(text[at : places[span["start"]][0]])
        at = places[span["end"] - 1][1]
    return "".join([*parts, text[at:]])


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and out[-1][1] >= a:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [{"start": a, "end": b} for a, b in out]


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The report of find_phrases: counts, a hash of the item list, and whether anything was hit."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        id_col,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
