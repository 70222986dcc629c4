import hashlib
import random
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tidemark.llm.word_bpe import Merges, Trie, WordCodec, byte_names, encode_words, read_vocabulary

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def codec():
    return WordCodec(read_vocabulary(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(codec, library, texts):
    for text, parts, wanted in zip(texts, codec.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        ids = list(chain.from_iterable(parts))
        assert ids == wanted.ids, text[:80]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_character(codec, library):
    each = ["a" + chr(k) + "!1" + chr(k) + "'s" for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    same(codec, library, [" ".join(each[i : i + 512]) for i in range(0, len(each), 512)])


def test_random_texts(codec, library):
    r = random.Random(5)
    letters = ["abcdefgh", "etaoin shrdlu", " \t\n\xa0　\x1c\x85 ", "0123456789½", "!?.,'", "éüñßłж中😀ΣİΣ́", "aaaab", "'s 't 're 'LL 'd"]
    texts = ["".join(r.choice(r.choice(letters)) if r.random() < 0.97 else r.choice(["<|startoftext|>", "<|endoftext|>"]) for _ in range(r.randint(0, 200))) for _ in range(3000)]
    same(codec, library, [*texts, "", " ", "x" * 5000, "ab" * 3000, "<|endoftext|>a<|ENDOFTEXT|>", "é" * 300])


def test_documents(codec, library):
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()]
    same(codec, library, texts)


def test_small_tables_and_stretches_give_the_same(library, monkeypatch):
    import tidemark.llm.word_bpe as module

    monkeypatch.setattr(module, "MAX_KEPT", 20)
    monkeypatch.setattr(module, "STRETCH_CHARS", 30)
    texts = ["Some words and some MORE words, " * 20, "don't\x1c stop " * 10, "<|endoftext|>" + "y" * 200 + " z"]
    same(WordCodec(read_vocabulary(PATH)), library, texts)


def test_random_vocabularies_against_plain_merging():
    def merged(word, ranks, mark):
        parts = [*word[:-1], word[-1] + mark]
        while len(parts) > 1:
            rank, i = min((ranks.get((a, b), 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 30:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    r = random.Random(3)
    for _ in range(60):
        vocab = {name + end: k for k, (name, end) in enumerate((n, e) for e in ("", "$$") for n in byte_names())}
        names, merges = list("abc") + ["a$$", "b$$", "c$$"], []
        for _ in range(25):
            a, b = r.choice([n for n in names if "$" not in n]), r.choice(names)
            if a + b not in vocab and len(a + b) < 10:
                vocab[a + b] = len(vocab)
                merges.append((a, b))
                names.append(a + b)
        ranks, spelled = {pair: k for k, pair in enumerate(merges)}, {v: k for k, v in vocab.items()}
        words = sorted({"".join(r.choice("abc") for _ in range(r.randint(1, 14))) for _ in range(200)})
        for word, ids in Trie([w.encode() for w in words]).encoded(Merges(vocab, merges, "$$")):
            assert [spelled[i] for i in ids] == merged(word.decode(), ranks, "$$")


def test_frame(spark, library):
    rows = [(1, "a B", "x"), (None, "c", "x"), (2, None, "x"), (3, "", "x"), (3, "", "x"), (2**60 + 1, "Word " * 4000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encode_words(docs, PATH, with_ids=True).collect()
    assert [r["doc_id"] for r in got] == [r[0] for r in rows]
    for r, (_, text, _) in zip(got, rows):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r["ids"], r["n_tokens"], r["decoded"]) == (ids, len(ids), decoded)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert encode_words(docs.where("false"), PATH).count() == 0
