import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tidemark.llm.bpe import Codec, Transducer, Utf8Stream, encode_texts, merged, read_ranks


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", " ", "a", "  two  spaces ", "I'll  go\n\n\tnow!! don't", "naïve café ñandú Straße", "中文字符 😀😀 mixed", "x" * 5000, "ab" * 3000, "12345 6,789.00", "<|endoftext|>", "\u200b\ufeff\x00", "the the the thethethe", "É" * 300]


def test_equals_the_library(ranks, reference):
    codec, r = Codec(ranks, public_tokenizers.PATTERN), random.Random(7)
    letters = ["abcdefgh", "etaoin shrdlu", "0123456789", " \n\t!?.,'", "éüñßłж中😀", "aaaab"]
    texts = TEXTS + ["".join(r.choice(r.choice(letters)) for _ in range(r.randint(0, 200))) for _ in range(400)]
    for text in texts:
        assert codec.encode(text) == reference.encode_ordinary(text), text[:80]


def test_equals_the_library_on_runs_of_all_white_space(ranks, reference):
    codec, r = Codec(ranks, public_tokenizers.PATTERN), random.Random(11)
    white = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    for text in ["cell \xa0 \xa0 \xa0 cell", "end. \xa0 \xa0", "a \n \xa0 \xa0 b", "\t \xa0 \xa0 b", "a \xa0 \xa0\n\nb", "a \xa0 \xa0", " a ", "a\n ", "\x1c \x1d a \x1c"]:
        assert codec.encode(text) == reference.encode_ordinary(text), text
    for _ in range(30_000):
        some = r.choice(([" ", "\xa0"], [" ", "\xa0", "\t", "\n"], [" ", "\u3000", "\u2009"], white))
        text = "".join(r.choice(some) if r.random() < 0.7 else r.choice(["cell", "a", ".", "7", "中", "don't"]) for _ in range(r.randint(0, 12)))
        assert codec.encode(text) == reference.encode_ordinary(text), text


def test_small_state_table_gives_the_same(ranks, reference):
    codec = Codec(ranks, public_tokenizers.PATTERN)
    codec.transducer.max_states = 50
    for text in TEXTS:
        assert codec.encode(text) == reference.encode_ordinary(text)


def test_random_vocabularies_against_plain_merging():
    r = random.Random(3)
    for _ in range(40):
        ranks = {bytes((b,)): b for b in range(97, 101)}
        tokens = list(ranks)
        while len(ranks) < 25:
            a, b = r.choice(tokens), r.choice(tokens)
            if a + b not in ranks and len(a + b) < 9 and merged(a + b, ranks) == [a, b]:
                ranks[a + b] = 256 + len(ranks)
                tokens.append(a + b)
        t = Transducer(ranks)
        for _ in range(60):
            piece = bytes(r.choice(b"abcd") for _ in range(r.randint(1, 40)))
            assert [t.tokens[i] for i in t.encode(piece)] == merged(piece, ranks)


def test_utf8_stream():
    text = "aé中😀z" * 50
    data, r = text.encode(), random.Random(1)
    for _ in range(20):
        s, out, at = Utf8Stream(), "", 0
        while at < len(data):
            n = r.randint(1, 5)
            out += s.feed(data[at : at + n])
            at += n
        assert out + s.finish() == text
    broken = Utf8Stream()
    assert broken.feed(b"a\xe4\xb8") + broken.finish() == "a\ufffd"


def test_frame(spark, reference, ranks):
    docs = spark.createDataFrame([(1, "a b", "x"), (None, "c", "x"), (2, None, "x"), (3, "", "x"), (3, "", "x"), (4, "word " * 4000, "x")], "doc_id long, text string, ids string")
    got = encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True).collect()
    assert len(got) == 6 and all(r["round_trip"] for r in got)
    for r, text in zip(got, ["a b", "c", "", "", "", "word " * 4000]):
        ids = reference.encode_ordinary(text)
        assert (r["ids"], r["n_tokens"]) == (ids, len(ids))
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert encode_texts(docs.where("false"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0


def test_rank_file_is_read_as_given(tmp_path):
    (tmp_path / "v").write_bytes(base64.b64encode(b"a") + b" 0\n" + base64.b64encode(b" b") + b" 1\n\n")
    assert read_ranks(str(tmp_path / "v")) == {b"a": 0, b" b": 1}
