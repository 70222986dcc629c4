"""The pipeline's stages, each against a brute-force version over what the one before it kept."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_near import joined, plain_fingerprint, plain_lines
from test_texts import plain_hits, words

import corpus_pipeline as pipeline
from tidemark.llm.bpe import read_ranks
from tidemark.llm.common import written


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(21)
    vocabulary = [f"{a}{b}" for a in ("ta", "re", "mo", "li", "su") for b in ("nd", "ra", "sto", "ve", "ko")]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, say(25)) for i in range(4)]
    docs, labels = [], []
    for i in range(240):
        lines = [say(r.randint(3, 25)) for _ in range(r.randint(1, 5))]
        if i % 6 == 0:
            lines[0] = f"{lines[0]} zwackel {say(2)} grumbler"
        if i % 7 == 0 and i:
            lines = docs[r.randrange(len(docs))][1].split("\n")
        if i % 11 == 0:
            lines.append(r.choice(items)[1])
        docs.append((i, "\n".join(lines)))
        labels.append((i, int("zwackel" in "\n".join(lines)), int("zwackel" in "\n".join(lines))))
    docs += [(900, None), (901, ""), (None, say(30))]
    path = str(tmp_path_factory.mktemp("sf"))
    rows = [(d, t, "en", "s", len(t) if t is not None else None) for d, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, items


def test_stages(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {}
    for k, (name, stage) in enumerate(pipeline.STAGES[:-1]):
        docs = written(stage(spark, docs, path), name)
        assert docs.columns == columns
        rows = docs.collect()
        kept = {r["doc_id"]: r["text"] for r in rows}
        assert len(kept) == len(rows) and all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)
        if k == 0:  # toxic documents go, clean ones stay
            gone = set(before) - set(kept)
            assert gone == {d for d, t in before.items() if t and "zwackel" in t}
            assert all(before[d] == t for d, t in kept.items())
        elif k == 1:
            dropped = plain_lines(list(before.items()))
            for d, t in before.items():
                want = t if d is None or t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in dropped)
                assert kept[d] == want
        elif k == 2:
            known = {d: plain_fingerprint(t) for d, t in before.items() if d is not None}
            fps = sorted(set(known.values()))
            root = joined([(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 4], fps)
            least = {}
            for d in sorted(known):
                least.setdefault(root[known[d]], d)
            assert set(kept) == {*least.values(), None}
            assert all(before[d] == t for d, t in kept.items())
        else:
            for d, t in before.items():
                hit = plain_hits(t, items)[1]
                assert len(words(kept[d])) == len(words(t)) - hit
                assert (kept[d] == t) == (hit == 0)
        before = kept
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    found = {r["doc_id"]: r for r in pipeline.STAGES[-1][1](spark, docs, path).collect()}
    assert set(found) == set(kept)
    for d, t in kept.items():
        ids = encoding.encode_ordinary(t or "")
        assert found[d]["n_tokens"] == len(ids) and found[d]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_columns_of_the_caller_stay(spark, folder):
    names = ("score", "predicted", "held_out", "n_lines", "n_dropped", "dropped", "n_words", "hit_spans", "hit_items", "other")
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    docs = docs.select("*", *[(F.when(F.col("doc_id") % 3 > 0, (1 << 53) + 1 + F.col("doc_id"))).alias(n) for n in names])
    before = {r["doc_id"]: r for r in docs.collect()}
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder[0])
        assert out.dtypes == docs.dtypes
        for r in out.collect():
            assert all(r[n] == before[r["doc_id"]][n] for n in ("lang", "source", *names))


def test_stages_of_nothing(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").where("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, folder[0]).count() == 0


def test_run(spark, folder):
    out = pipeline.run(spark, folder[0]).collect()
    assert len(out) > 100 and all(r["round_trip"] for r in out)
