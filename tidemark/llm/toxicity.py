"""Toxicity: texts are deobfuscated, and their restored words scored by a logistic model over character n-grams.

The character model counts the words of all documents. The classifier is fitted on a bounded sample of
labelled rows; only texts and labels go into it.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, per_worker, release_kept, values_of, written
from tidemark.llm.deobfuscate import Decoder, letters, runs_apart, trigram_counts, trigram_table

#: Labelled rows that the classifier is fitted on at most, and n-grams that it keeps at most.
MAX_TRAIN, MAX_GRAMS = 20_000, 50_000
#: Distinct words that a task counts before it passes them on.
COUNT_WORDS = 400_000


def char_model(df: DataFrame, text_col: str) -> np.ndarray:
    """Trigram counts of all texts: counted in tasks, summed by trigram, and hashed into a table whose size follows their number.

    Distinct trigrams are bounded by the alphabet of the corpus, not by its length.
    """

    def count(parts: Iterator) -> Iterator:
        import pyarrow as pa

        release_kept()
        words: Counter = Counter()

        def flushed():
            grams = trigram_counts(words)
            words.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], names=["gram", "n"])

        for batch in parts:
            for text in values_of(batch, text_col):
                words.update(letters(text.lower()))
                if len(words) > COUNT_WORDS:
                    yield flushed()
        yield flushed()

    counts = df.select(text_col).dropna().mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = counts.collect()  # one row a distinct trigram
    return trigram_table(found, len(found))


def grams_of(word: str, low: int = 3, high: int = 6) -> list[str]:
    """Character n-grams of a word with borders, and the word itself."""
    w = f"^{word}$"
    return [w[i : i + n] for n in range(low, high + 1) for i in range(len(w) - n + 1)] + [w]


class Model:
    """Weights by n-gram; a text's score is the logistic of the sum over the n-grams that it has."""

    def __init__(self, weights: dict[str, float], bias: float, table: np.ndarray):
        self.weights, self.bias, self.table, self.name = weights, bias, table, uuid.uuid4().hex


class Features:
    """The n-grams of a text that are among a given set, by their numbers."""

    def __init__(self, column: dict[str, int], table: np.ndarray, keep: int = 900_000):
        import ahocorasick

        self.keep, self.decoder = keep, Decoder(table)
        self.automaton = ahocorasick.Automaton()
        for gram, k in column.items():
            self.automaton.add_word(gram, k)
        if column:
            self.automaton.make_automaton()
        self.some = bool(column)
        self.without: set[str] = set()  # tokens seen that have none
        self.found: dict[str, tuple[int, ...]] = {}

    def _of(self, words) -> tuple[int, ...]:
        """Of the words' n-grams with borders (a word itself counts as one) those that are known: an n-gram never runs over a border."""
        if not self.some or not words:
            return ()
        return tuple({k for _, k in self.automaton.iter("".join([f"^{w}$" for w in words]))})

    def __call__(self, text: str) -> set[int]:
        tokens, out = text.split(), set()
        distinct = set(tokens)
        for token in distinct - self.without:
            mine = self.found.get(token)
            if mine is None:
                mine = self._of(self.decoder.token(token.lower()))
                if mine:
                    if len(self.found) > self.keep:
                        self.found.clear()
                    self.found[token] = mine
                else:
                    if len(self.without) > self.keep:
                        self.without.clear()
                    self.without.add(token)
            out.update(mine)
        for run in runs_apart(tokens):
            out.update(self._of(self.decoder.apart(run)))
        return out


class Scorer:
    def __init__(self, model: Model):
        grams = list(model.weights)
        self.weights = np.array([model.weights[g] for g in grams])
        self.features, self.bias = Features({g: k for k, g in enumerate(grams)}, model.table), model.bias

    def score(self, text: str) -> float:
        total = self.bias + self.weights[sorted(self.features(text))].sum()
        return float(1 / (1 + np.exp(-np.clip(total, -60, 60))))


def candidate_grams(sample: DataFrame, table, n: dict[int, int], most: int = MAX_GRAMS) -> list[str]:
    """The n-grams that speak for label 1 in the sample, by the words of its texts; the `most` strongest."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_kept()
        decoder, counts = Decoder(table.value), (Counter(), Counter())

        def flushed() -> pd.DataFrame:
            rows = [(w, counts[0][w], counts[1][w]) for w in {*counts[0], *counts[1]}]
            for c in counts:
                c.clear()
            return pd.DataFrame(rows, columns=["word", "clean", "toxic"])

        for pdf in parts:
            for text, label in zip(pdf["_text"], pdf["_label"]):
                counts[label].update(decoder.words(text))
                if len(counts[0]) + len(counts[1]) > COUNT_WORDS:
                    yield flushed()
        yield flushed()

    words = sample.mapInPandas(count, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))

    def spread(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            clean, toxic = Counter(), Counter()
            for word, a, b in pdf.itertuples(index=False):
                for gram in set(grams_of(word)):
                    clean[gram] += a
                    toxic[gram] += b
            yield pd.DataFrame([(g, clean[g], t) for g, t in toxic.items()], columns=["gram", "clean", "toxic"])

    sums = words.mapInPandas(spread, "gram string, clean long, toxic long").groupBy("gram").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    ratio = (F.col("toxic") / (n[1] + 1)) / ((F.col("clean") + 0.5) / (n[0] + 1))
    kept = sums.where((F.col("toxic") >= 2) & (ratio > 4)).orderBy(F.desc(F.col("toxic") * F.log(ratio)), "gram").limit(most)
    return [r["gram"] for r in kept.select("gram").collect()]


def fit(rows: np.ndarray, cols: np.ndarray, labels: np.ndarray, width: int, rounds: int = 600, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model with an L2 penalty, from the places of ones in its matrix (AdaGrad over all rows)."""
    y, n = labels.astype(float), max(1, int(labels.sum()))
    w, b = np.zeros(width), -1.0
    g2w, g2b = np.full(width, 1e-8), 1e-8
    for _ in range(rounds):
        z = b + np.bincount(rows, w[cols], len(y))
        error = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - y
        grad = np.bincount(cols, error[rows], width) / n + penalty * w
        bias = error.sum() / n
        g2w += grad * grad
        g2b += bias * bias
        w -= 0.2 * grad / np.sqrt(g2w)
        b -= 0.2 * bias / np.sqrt(g2b)
    return w, float(b)


def cut_of(rows: np.ndarray, cols: np.ndarray, labels: np.ndarray, width: int, folds: int = 3) -> float:
    """The log odds from which on a row is best called toxic: the greatest F1 over rows that were scored by a fit without them.

    Toxic rows are few and many have one sign only, so even odds would miss those. Never over 0; of equal cuts the greatest.
    """
    fold = np.arange(len(labels)) % folds
    odds = np.zeros(len(labels))
    for k in range(folds):
        inner = np.cumsum(fold != k) - 1  # numbers of the rows that this fit sees
        seen = fold[rows] != k
        w, b = fit(inner[rows[seen]], cols[seen], labels[fold != k], width, rounds=300)
        scored = b + np.bincount(rows, w[cols], len(labels))
        odds[fold == k] = scored[fold == k]
    order = np.argsort(-odds, kind="stable")
    hits, falls = np.cumsum(labels[order] == 1), np.cumsum(labels[order] == 0)
    f1 = 2 * hits / np.maximum(2 * hits + falls + (labels == 1).sum() - hits, 1)
    ends = np.append(odds[order][1:] != odds[order][:-1], True)[: len(order)] & (odds[order] <= 0)  # rows of equal odds fall together
    best = np.flatnonzero(ends & (f1 == f1[ends].max())) if ends.any() and f1[ends].max() > 0 else []
    return float(odds[order][best[0]]) if len(best) else 0.0


def held_out(id_col: str = "doc_id"):
    """Rows kept for the test: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN, max_grams: int = MAX_GRAMS) -> Model:
    """Fits the model. The sample is the max_train labelled rows outside the held-out part with the least hashed ids.

    Labels that are null or neither 0 nor 1, null ids, and texts that are null or missing take no part;
    empty texts speak for their label without features; a document labelled twice, or a repeated id, is
    read once for each; of n-grams that speak as strongly the first by letters is kept; very long texts
    are read whole; other columns are ignored. Without texts, labels, or documents of label 1 there are
    no n-grams, and every score is the bias alone, under 0.5.
    """
    table = char_model(docs, text_col)
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
        .select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(max_train)
    )
    # bounded by max_train rows, so the broadcast is too
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).dropna().join(F.broadcast(chosen), "_id")
    sample = written(sample.select("_text", "_label"), "sample").repartition(docs.sparkSession.sparkContext.defaultParallelism * 2)
    n = {0: 0, 1: 0} | {r["_label"]: r["count"] for r in sample.groupBy("_label").count().collect()}
    shared = docs.sparkSession.sparkContext.broadcast(table)
    grams = candidate_grams(sample, shared, n, max_grams)
    columns = docs.sparkSession.sparkContext.broadcast({g: k for k, g in enumerate(grams)})

    def places(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_kept()
        features = Features(columns.value, shared.value)
        for pdf in parts:
            yield pd.DataFrame({"label": pdf["_label"], "has": [np.array(sorted(features(t)), np.int32) for t in pdf["_text"]]})

    found = sample.mapInPandas(places, "label int, has array<int>").toPandas()  # bounded by max_train
    sizes = np.fromiter(map(len, found["has"]), np.int64, len(found))
    cols = np.concatenate([np.zeros(0, np.int64), *found["has"]]).astype(np.int64)
    rows, given = np.repeat(np.arange(len(found)), sizes), found["label"].to_numpy(np.int64)
    weights, bias = fit(rows, cols, given, len(grams))
    bias = min(bias - cut_of(rows, cols, given, len(grams)), -0.01)  # without evidence nothing is toxic
    return Model({g: float(x) for g, x in zip(grams, weights) if abs(x) > 1e-4}, bias, table)


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep_columns: bool = False) -> DataFrame:
    """One row for each row of docs: id, held_out, score (0 to 1) and predicted (1 from a score of 0.5).

    Null and empty texts have the score of a text without evidence. Long texts are read whole;
    repeated rows are kept and score alike, null ids are kept (not held out), ids exactly; an empty table
    gives no rows. With keep_columns the columns of docs come too, but for those that have one of the
    three new names: these are replaced.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator) -> Iterator[tuple]:
        model = known.value
        scorer = per_worker(("scorer", model.name), lambda: Scorer(model))
        for batch in parts:
            scores = [scorer.score(t or "") for t in values_of(batch, text_col)]
            yield batch, {"score": scores, "predicted": [int(s >= 0.5) for s in scores]}

    part = docs.drop("held_out", "score", "predicted")
    part = (part if keep_columns else part.select(id_col, text_col)).withColumn("held_out", held_out(id_col))
    return mapped(part, run, {"score": "double", "predicted": "int"}, keep=None if keep_columns else [id_col, "held_out"])
