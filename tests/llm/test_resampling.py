import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from tidemark.llm import resampling
from tidemark.llm.resampling import HEAD_FEATURES, Hasher, frequent_features, resample, stretches


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def buckets_of(text, buckets):
    w = words_of(text)
    return [crc32(f.encode()) % buckets for f in [*w, *map(" ".join, zip(w, w[1:]))]]


def brute_force(docs, target, percent, least, buckets, seed):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets_of(text, buckets))
    for text in target:
        t.update(buckets_of(text, buckets))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in s}
    rows = []
    for key, text in docs:
        found = buckets_of(text, buckets)
        weight = sum(map(gain.__getitem__, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words_of(text))])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[4] = k
    return [tuple(r[:5]) for r in rows]


def made_texts(n, seed):
    r = random.Random(seed)
    words = ["the", "of", "naïve", "中文", "x1", "Word", "İ", "a"] + [f"w{k}" for k in range(300)]
    return ["".join(r.choice(words[: r.choice((8, 308))]) + r.choice([" ", " ", ", ", "\n\x1c", "--"]) for _ in range(r.choice((0, 3, 19, 20, 21, 60)))) for _ in range(n)]


@pytest.mark.parametrize("head", [1, 40, HEAD_FEATURES])
def test_resample_against_brute_force(spark, head, monkeypatch):
    monkeypatch.setattr(resampling, "HEAD_FEATURES", head)
    docs = list(enumerate(made_texts(300, 1))) + [(None, None), (None, "the of " * 30), (7, ""), (2**60 + 1, "the long one " * 5000)] + [(5, "same row " * 20)] * 40
    target = made_texts(20, 2) + [None, ""]
    df = spark.createDataFrame([(a, b, "z") for a, b in docs], "doc_id long, text string, score string").repartition(5)
    got = resample(df, spark.createDataFrame([(t,) for t in target], "text string"), 25, 20, 500, 7).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute_force(docs, target, 25, 20, 500, 7), key=key)


def test_head_and_blocks_change_no_bucket(spark, monkeypatch):
    texts = made_texts(60, 3) + ["a " * 400, "   " * 100, "y" * 500 + " z", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "_text string").repartition(2)
    heads = [frequent_features(rows, most) for most in (0, 5, 500)]
    assert len(heads[2][0]) > 50 and heads[2][1]
    for block in (16, 100, 10**6):
        monkeypatch.setattr(resampling, "BLOCK_BYTES", block)
        monkeypatch.setattr(resampling, "stretches", lambda t, most=block: stretches(t, most))
        for words, pairs in heads:
            h = Hasher(words, pairs, 10_000)
            for text, packed in zip(texts, h.of([t.encode() for t in texts]), strict=True):
                assert sorted(memoryview(packed).cast("H")) == sorted(buckets_of(text, 10_000))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(k, "one two three " * 9) for k in range(8)], "doc_id long, text string")
    assert resample(empty, some.select("text")).count() == 0
    got = resample(some, empty.select("text"))
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == [1, 2]
    assert resample(empty, empty).columns == ["doc_id", "n_features", "weight", "score", "rank"]
