"""SimHash near-dedup: fingerprints, exact tiled comparison, and connected components.

Two fingerprints within `radius` bits agree in at least one of radius + 1 blocks of bits, so only
fingerprints with an equal block meet, in tiles by population count; each pair of tiles is compared exactly
with numpy exclusive-or and bit counts, but for those whose population counts differ beyond the radius, as
stripes within a tile are skipped.
Equal fingerprints are one row throughout. A tile gives at most one edge for each of its rows (a
spanning forest of the links that it found), so groups of copies never become lists of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import join_dealt, values_of, written
from tidemark.llm.components import components

#: Fingerprints of one block value that one tile takes; more are dealt over several tiles.
TILE = 4096
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """A bit is set if it is in over half of the hashes of the text's word shingles, repeats included."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    line, k = b" ".join(tokens), min(words, len(tokens))
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(tokens) - k + 1].tolist()
    h64 = xxhash.xxh64_intdigest
    hashes = np.array([h64(line[a:b], seed) for a, b in zip(starts, ends[k - 1 :].tolist())], np.uint64)
    n = len(hashes)
    votes = np.zeros(64, np.int64)
    for bit in range(8):  # eight byte lanes of a word count eight bits at once, 255 hashes a time
        lanes = (hashes >> np.uint64(bit)) & _LANES
        sums = np.add.reduceat(lanes, np.arange(0, n, 255))
        votes[bit::8] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * votes > n).tolist()))


def fingerprints(df: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fp (64 bits as a signed long) of each row with an id; one pass, no shuffle."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in parts:
            fps = np.array([fingerprint(t, words) for t in values_of(batch, "_text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=[id_col, "fp"])

    part = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(text_col).alias("_text"))
    return part.mapInArrow(run, f"`{id_col}` long, fp long")


def block_values(fps: np.ndarray, blocks: int) -> list[np.ndarray]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(fps >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1) for a, b in zip(edges, edges[1:])]


def forest(left: np.ndarray, right: np.ndarray | None, radius: int, stripe: int = 256) -> list[tuple[int, int]]:
    """A spanning forest, as pairs of values, of the links within a tile or between two tiles."""
    values = left if right is None else np.concatenate((left, right))
    values = np.unique(values)
    order = np.argsort(np.bitwise_count(values), kind="stable")
    values, counts = values[order], np.bitwise_count(values[order]).astype(np.int64)
    side = None if right is None else np.isin(values, left)
    label = np.arange(len(values))
    for a in range(0, len(values), stripe):
        b = min(a + stripe, len(values))
        to = np.searchsorted(counts, counts[b - 1] + radius, side="right")
        near = np.bitwise_count(values[a:b, None] ^ values[None, a:to]) <= radius
        i, j = np.nonzero(near)
        i, j = i + a, j + a
        keep = (i < j) if side is None else (i < j) & (side[i] != side[j])
        label = _joined(label, i[keep], j[keep])
    roots = np.flatnonzero(label != np.arange(len(values)))
    return [(int(values[k]), int(values[label[k]])) for k in roots]


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (the least index of each set) after joining pairs, all pairs at once."""
    while len(i):
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            break
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further
    return label


def near_edges(fps: DataFrame, radius: int) -> DataFrame:
    """Edges (src, dst) that connect all distinct fingerprints within the radius of each other."""
    blocks = radius + 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    bits = [F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]
    routed = fps.select("fp", F.posexplode(F.array(*bits)).alias("block", "value"))
    # A block value that many fingerprints have is dealt over tiles, each a range of population counts (or a part of
    # one count); pairs of tiles whose counts all differ beyond the radius never meet.
    routed = routed.withColumn("ones", F.bit_count("fp"))
    counts = routed.groupBy("block", "value", "ones").agg(F.count("*").alias("n"))
    by = Window.partitionBy("block", "value")  # 65 counts at most
    counts = counts.withColumn("total", F.sum("n").over(by)).where(F.col("total") > TILE)
    upto = F.sum("n").over(by.orderBy("ones"))
    counts = counts.withColumn("first", F.floor((upto - F.col("n")) / TILE).cast("int")).withColumn("last", F.floor((upto - 1) / TILE).cast("int"))
    tiles = counts.select("block", "value", "ones", F.explode(F.sequence("first", "last")).alias("tile"))
    tiles = tiles.groupBy("block", "value", "tile").agg(F.min("ones").alias("low"), F.max("ones").alias("high"))
    meeting = tiles.alias("x").join(tiles.alias("y"), ["block", "value"]).where(F.expr(f"x.low - y.high <= {radius} AND y.low - x.high <= {radius}"))
    meeting = meeting.groupBy("block", "value", F.col("x.tile").alias("tile")).agg(F.collect_list("y.tile").alias("others"))
    crowded = counts.select("block", "value", "ones", "first", "last")
    dealt = routed.join(crowded, ["block", "value", "ones"], "left").withColumn("first", F.coalesce("first", F.lit(0)))
    dealt = dealt.withColumn("tile", F.col("first") + F.pmod(F.xxhash64("fp"), F.coalesce("last", F.lit(0)) - F.col("first") + 1).cast("int"))
    dealt = dealt.join(meeting, ["block", "value", "tile"], "left").withColumn("other", F.explode(F.coalesce("others", F.array("tile"))))
    dealt = dealt.select("fp", "block", "value", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile")
    key = ["block", "value", "a", "b"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def compared(held: list[pd.DataFrame]) -> list[tuple[int, int]]:
            rows = pd.concat(held) if len(held) > 1 else held[0]
            if len(rows) < 2:
                return []
            fps, tile = rows["fp"].to_numpy().view(np.uint64), rows["tile"].to_numpy()
            a, b = rows["a"].iat[0], rows["b"].iat[0]
            return forest(fps, None, radius) if a == b else forest(fps[tile == a], fps[tile == b], radius)

        held, at = [], None
        for pdf in parts:
            keys = pdf[key].to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(pdf)]
            found: list[tuple[int, int]] = []
            for x, y in zip(cuts, cuts[1:]):
                if x == y:
                    continue
                if held and tuple(keys[x]) != at:
                    found += compared(held)
                    held = []
                held.append(pdf.iloc[x:y])
                at = tuple(keys[x])
            if found:
                yield _as_edges(found)
        if held and (found := compared(held)):
            yield _as_edges(found)

    ordered = dealt.repartition(*key).sortWithinPartitions(*key)
    return ordered.mapInPandas(run, "src long, dst long")


def _as_edges(found: list[tuple[int, int]]) -> pd.DataFrame:
    pairs = np.array(found, np.uint64).view(np.int64)
    return pd.DataFrame({"src": pairs[:, 0], "dst": pairs[:, 1]})


def near_copies(df: DataFrame, radius: int = 4, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row with an id: id, fingerprint (16 hex digits), component_id.

    component_id is the least id of the documents that links reach. Texts without words (null, empty)
    have fingerprint zero and are linked like any other; fewer than `words` words are one shingle; very
    long texts are read whole; a bit that half of the hashes have is not set; rows with a null id are left
    out, as are other columns, whatever their names; repeated rows and ids each keep a row; an empty table
    gives no rows.
    """
    fps = written(fingerprints(df, words, id_col, text_col), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min(id_col).alias("least"), F.count("*").alias("n")), "distinct")
    edges = written(near_edges(distinct.select("fp"), radius), "edges")
    linked = components(edges)  # node, component: only fingerprints with a link
    of = written(distinct.join(linked, distinct["fp"] == linked["node"], "left").select("fp", "least", "n", F.coalesce("component", "fp").alias("root")), "roots")
    roots = written(of.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")), "components")
    by_fp = written(join_dealt(of.withColumnRenamed("n", "copies"), roots, ["root"]).select("fp", "component_id", F.col("copies").alias("n")), "by_fp")
    return join_dealt(fps, by_fp, ["fp"]).select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
