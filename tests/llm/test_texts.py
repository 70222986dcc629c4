import pytest
import hashlib
import itertools
import json
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import html_text
from tidemark.llm.deobfuscate import Decoder, trigram_counts, trigram_table
from tidemark.llm.fm_index import FMIndex, WaveletMatrix, digest, find_phrases
from tidemark.llm.html_text import Block, Region, extract_text, main_text
from tidemark.llm.tool_calls import calls_of_turns, link_calls
from tidemark.llm.toxicity import Features, Model, Scorer, grams_of, score_texts, train
from tidemark.llm.url_rules import HostRule, ShiftAnd, judge_urls

# --- FM-index


def test_wavelet_and_index():
    r = np.random.default_rng(1)
    for sigma in (1, 2, 5, 30):
        text = np.concatenate([np.append(r.integers(1, sigma + 1, r.integers(1, 60)), 0) for _ in range(8)])
        w = WaveletMatrix(text, sigma)
        for c in range(sigma + 1):
            for i in (0, 1, len(text) // 2, len(text)):
                assert w.rank(np.array([c]), np.array([i]))[0] == (text[:i] == c).sum()
        index = FMIndex(text, sigma, sample=4)
        for size in (1, 2, 4):
            phrases = r.integers(1, sigma + 1, (20, size))
            low, high = index.search(phrases, np.full(20, size))
            for k, p in enumerate(phrases):
                want = [i for i in range(len(text) - size + 1) if (text[i : i + size] == p).all()]
                assert sorted(index.locate(np.arange(low[k], max(low[k], high[k]))).tolist()) == want


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_hits(text, items, size=10):
    w, hit, which = words(text), set(), set()
    for item, body in items:
        b = words(body)
        for i in range(max(1, len(b) - size + 1) if b else 0):
            p = b[i : i + size]
            for j in range(len(w) - len(p) + 1):
                if w[j : j + len(p)] == p:
                    hit.update(range(j, j + len(p)))
                    which.add(str(item))
    return len(w), len(hit), len(which), hashlib.sha256(",".join(sorted(which)).encode()).hexdigest(), bool(hit)


def test_decontamination_equals_brute_force(spark):
    r = random.Random(3)
    vocabulary = [f"{c}{i}é" for c in "ab" for i in range(12)]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate([3, 10, 11, 30, 30, 1])] + [(90, ""), (91, None), (None, "x y"), (92, "!?")]
    docs = [(i, say(r.randint(0, 30)) + r.choice([" ", " -- ", "\n"]) + r.choice(items[:5])[1].upper() + " " + say(20)) for i in range(40)]
    docs += [(100, None), (101, ""), (102, items[3][1] + " " + items[3][1]), (None, items[1][1]), (102, "again " + items[1][1]), (103, "A_B " * 3000)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, n_words string")
    known = [x for x in items if x[0] is not None]
    want = sorted((str(d), *plain_hits(t, known)) for d, t in docs)
    for pass_bytes in (1 << 20, 100):  # one block, and several
        got = digest(find_phrases(frame, benchmark, pass_bytes=pass_bytes)).collect()
        assert sorted((str(x[0]), *x[1:]) for x in got) == want
    assert digest(find_phrases(frame.where("false"), benchmark)).count() == 0
    assert digest(find_phrases(frame, benchmark.where("false"))).where("n_hit > 0").count() == 0


def test_cut(spark):
    item = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"Before, {item.upper()}! After."), (2, "clean"), (3, None)], "doc_id long, text string")
    out = find_phrases(docs, spark.createDataFrame([(7, item)], "item_id long, text string"), cut=True)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "Before, ! After.", 2: "clean", 3: None}


# --- URL rules


def plain_glob(pattern, text):
    return re.fullmatch("".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern), text, re.S) is not None


def test_shift_and_equals_regex():
    r = random.Random(2)
    patterns = ["".join(r.choice("ab?*") for _ in range(r.randint(1, 9))) for _ in range(60)] + ["a" * 70 + "*b", "*" + "ab" * 40]
    patterns = [p for p in patterns if p.strip("*")]
    texts = ["".join(r.choice("abc") for _ in range(r.randint(0, 12))) for _ in range(200)] + ["a" * 75 + "xb", "zz" + "ab" * 40, "\U0001f600a"]
    got = ShiftAnd(patterns).matches(texts)
    for i, t in enumerate(texts):
        for k, p in enumerate(patterns):
            assert got[i, k] == plain_glob(p, t), (p, t)


def test_judge_urls(spark):
    rules = [HostRule("org", "/", "allow"), HostRule("example.org", "/es/", "block"), HostRule("com", "/de/", "block")]
    urls = [
        ("https://A.Example.ORG/es/1?q#f", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("http://badexample.org/es/1", "badexample.org", "/es/1", "org/", "allow"),
        ("http://x.org", "x.org", "", None, "allow"),
        ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
        ("http://x.com/a.org/", "x.com", "/a.org/", None, "allow"),
        ("http://casino.com?x", "casino.com", "", None, "block"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http://a.casino.com", "a.casino.com", "", None, "block"),
        ("http://track.net/x", "track.net", "/x", None, "block"),
        ("http://a.track.net/x", "a.track.net", "/x", None, "allow"),
        ("ftp://h/p\n://q", "h", "/p\n://q", None, "allow"),
        ("http://İ.ORG/" + "a" * 20000, "İ.org", "/" + "a" * 20000, "org/", "allow"),
    ]
    df = spark.createDataFrame([(i, u[0], "z") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = [tuple(r)[1:] for r in judge_urls(df, rules, ["*casino*", "track.net"]).orderBy("page_id").collect()]
    assert got == [u[1:] for u in urls]
    assert judge_urls(df.where("false"), rules, []).count() == 0


# --- HTML


def test_main_text():
    nav = '<nav><a href="/">Home of the site</a></nav><div class="side-bar x"><p>All the other things that are of interest to the reader of the site, and so on and on.</p></div>'
    page = f"""<html><head><title>T</title><style>p{{}}</style><script>var t="</p><article>";</script></head><body>{nav}<div class='ad'>Buy it</div>
    <article><h1>Head&nbsp;line</h1><p>First <b>bold</b> text &amp; m&ouml;re<br>line<p>Second<div class="comments"><p>I think so</p></div><form><p>Sign up</p></form><!-- <p>no</p> --></article><footer>&copy; x</footer></body></html>"""
    assert main_text(page) == "Head line First bold text & möre line Second"
    assert main_text(None) == main_text("") == main_text("<div><!-- open") == ""
    loose = f"<body>{nav}<div><h2>What it is</h2><p>This is the first of the paragraphs of the text and it is as long as it has to be for the rule that is in use here.</p><p>Short one.</p></div><div id='footer'><p>Short two.</p></div></body>"
    assert main_text(loose).endswith("Short one.") and "What it is" in main_text(loose) and "two" not in main_text(loose) and "Home" not in main_text(loose)
    assert main_text("<article><p>a &lt;b&gt; c</p><p>x < y</p>") == "a <b> c x < y"


PARAGRAPH = "This is the first of the paragraphs of the text and it is as long as it has to be for the rule that is in use here, and on it goes with all of the words that it has."


def test_names_alone_empty_no_page():
    nav = '<ul><li><a href="/a">One of the links</a></li><li><a href="/b">Another of the links</a></li></ul>'
    aside = f'<div class="sidebar"><p>{PARAGRAPH.replace("first", "last")}</p></div>'
    for name in ('<div class="content has-sidebar">', '<div id="main" class="layout search-results">', "<form>"):
        for head in ("<h1>What it is</h1>", ""):
            assert main_text(f"<body>{name}{nav}{head}<p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div></form></body>") == " ".join([*(["What it is"] if head else []), PARAGRAPH, PARAGRAPH])
        text = main_text(f"<body>{name}<h1>What it is</h1><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p>{aside}</div></form><footer><p>{PARAGRAPH}</p></footer></body>")
        assert text == f"What it is {PARAGRAPH} {PARAGRAPH}"
    comments = f'<section class="comments"><article><p>{PARAGRAPH}</p></article></section>' * 5
    assert main_text(f"<main><h1>Head</h1><p>{PARAGRAPH}</p>{comments}</main>") == f"Head {PARAGRAPH}"


def test_pages_without_an_article():
    linked = '<a href="/x"><div>Some of the other things that are on the site</div><div>and more of them</div></a>'
    page = f"<body><p>Home</p>{linked}<div><h2>What it is</h2><p>{PARAGRAPH}</p><p>Short.</p><p>{PARAGRAPH}</p></div><p>Nearer to this.</p>{linked}<p>Last</p></body>"
    assert main_text(page) == f"What it is {PARAGRAPH} Short. {PARAGRAPH} Nearer to this."
    assert main_text(f"<p><a href='/y'>open<p>{PARAGRAPH}</p>") == PARAGRAPH  # a link without end is one up to the next block
    assert main_text("<p>only short</p>") == ""


def test_labels_equal_plain_rules():
    """Labels by plain rules: sums of words and place, and for open blocks a search outward in both directions."""
    r = random.Random(41)
    for _ in range(300):
        regions = [Region(r.randrange(-1, k) if k else -1, r.choice([0, 1, 2, 2]), r.random() < 0.2) for k in range(r.randint(0, 5))]
        articles = [k for k, x in enumerate(regions) if not x.away]
        blocks = []
        for _ in range(r.randint(0, 30)):
            n = r.choice([3, 8, 15, 60])
            blocks.append(Block("x", n, r.choice([0, 0, 0, n // 3, n]), r.choice([0, n // 6, n // 2]), r.randrange(-1, len(regions)), r.choice([-1, *articles]), r.choice([0, 0, 0, 1, 2])))
        said = [html_text.by_words(b) for b in blocks]
        size = lambda some, least=1: sum(b.words for b, t in zip(blocks, said) if t >= least and some(b))
        least = 1 if size(lambda b: True) else 0
        total = size(lambda b: True, least)

        def under(k, top):
            while k >= 0 and k != top:
                k = regions[k].up
            return k == top and k >= 0

        def off(k):
            most = 0
            while k >= 0:
                mine = size(lambda b: under(b.region, k), least)
                heads = any(under(j, k) and regions[j].heads for j in range(len(regions)))
                headed = any(b.heading == 1 or b.article >= 0 for b in blocks)
                void = total > 0 and (2 * mine >= total if heads else not headed and 5 * mine >= 4 * total)
                most = max(most, 0 if void else regions[k].away)
                k = regions[k].up
            return most

        live = {b.article for b in blocks if b.article >= 0 and off(b.article) < 2}
        marked = live and 2 * size(lambda b: b.article in live, least) >= total
        title = lambda b: off(b.region) == 1 and b.heading == 1 and b.article in live
        place = [(0 if title(b) else -2 * off(b.region) + (1 if b.article in live else -2 if marked else 0)) for b in blocks]
        sums = [a + b for a, b in zip(said, place)]
        if not any(x > 0 for x in sums) and any(b.heading == 1 or b.article >= 0 for b in blocks):
            sums = [1 if x == 0 and p >= 0 else x for x, p in zip(sums, place)]
        want = []
        for k, b in enumerate(blocks):
            if sums[k]:
                want.append(sums[k] > 0)
                continue
            good = lambda i: sums[i] > 0 or sums[i] < 0 and not off(blocks[i].region)
            left = next((i for i in range(k - 1, -1, -1) if good(i)), None)
            right = next((i for i in range(k + 1, len(blocks)) if good(i)), None)
            if b.heading and right is not None:
                want.append(sums[right] > 0)
            else:
                near = sorted((abs(i - k), sums[i] < 0) for i in (left, right) if i is not None)
                want.append(bool(near) and not near[0][1])
        assert html_text.labels_of(blocks, regions) == want


def test_long_pages_take_linear_time():
    began = time.time()
    for page in ("<div>x</div>" * 200_000, "<div>x" * 200_000, "<a href=1>x<p>" * 200_000, "<!" * 200_000, "</p></div>" * 200_000):
        main_text(page)
    assert time.time() - began < 50


def test_ids_and_columns_stay_exact(spark):
    """A long over 2^53 beside a null, and columns that have the names that the operators add."""
    from test_near import dedup_lines

    from tidemark.llm.bpe import encode_texts
    from tidemark.llm.simhash import near_copies

    big = (1 << 53) + 1
    names = ("score", "predicted", "held_out", "n_lines", "n_dropped", "dropped", "n_words", "hit_spans", "hit_items", "text_sha256", "rule", "host", "n_chars", "fingerprint")
    rows = [(big, "one two http://a.org/", *([7] * len(names))), (None, "one two", *([None] * len(names)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} long" for n in names))
    more = frame.withColumn("other", F.when(F.col("doc_id").isNotNull(), F.col("doc_id") + 2)).coalesce(1)
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    model = Model({"^one$": 1.0}, 0.0, np.zeros(1 << 10, np.int64))
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = lambda df, c="doc_id": sorted((r[c] for r in df.collect()), key=str)
    want = sorted([big, None], key=str)
    assert ids(find_phrases(more, items)) == ids(score_texts(more, model)) == ids(dedup_lines(more)) == ids(encode_texts(more, ranks, public_tokenizers.PATTERN)) == want
    assert ids(extract_text(more, "doc_id", "text", "text")) == ids(judge_urls(more, [], ["*a*"], "doc_id", "text")) == want and ids(near_copies(more)) == [big]
    for out in (find_phrases(more, items), score_texts(more, model, keep_columns=True), dedup_lines(more)):
        assert ids(out, "other") == sorted([big + 2, None], key=str)


def test_extract_text(spark):
    df = spark.createDataFrame([(1, "u", "<article>é x</article>", 0), (None, None, None, 0), (2, "u", "", 0), (2, "u", "<p>" * 30000, 0)], "page_id long, url string, html string, text int")
    got = sorted(map(tuple, extract_text(df).collect()), key=repr)
    assert got == sorted([(1, "u", "é x", 3), (None, None, "", 0), (2, "u", "", 0), (2, "u", "", 0)], key=repr)


# --- toxicity


def test_decoder():
    counts = trigram_counts(Counter({"idiot": 50, "loser": 50, "people": 80, "all": 80, "hello": 60, "good": 60, "pathetic": 40, "you": 90}))
    table = trigram_table(counts.items(), len(counts))
    d = Decoder(table)
    for spelled in ("1d10t", "!d!ot", "idiooooot", "iiidiot", "id*ot", "i.d.i.o.t"):
        assert "idiot" in d.token(spelled), spelled
    assert any(w.endswith("loser") for w in d.words("what a l 0 $ e r you")) and "pathetic" in d.token("p-a-t-h-e-t-i-c")
    assert d.token("hello") == ("hello",) and d.token("12345") == ("12345",) and d.words("") == set()


def test_decoder_reads_every_word():
    counts = trigram_counts(Counter({"idiot": 50, "worthless": 50, "shithead": 50, "people": 80, "all": 80, "hello": 60, "good": 60, "fat": 40, "you": 90}))
    table = trigram_table(counts.items(), len(counts))
    d = Decoder(table)
    assert "worthless" in d.token("w0r7h1355") and "shithead" in d.token("5h17h34d") and "idiot" in d.token("id" + "i" * 3 + "o" * 60 + "t") and "idiot" in d.token("iiddiioott")
    assert "hello" in d.token("hello") and "good" in d.token("good,") and d.token("2024") == ("2024",)
    assert "fat" in d.words("you f a t people") and "idiot" in d.words("you i d i o t.") and "idiot" in d.words("I D I O T!")
    assert len(d.token("a1" * 20_000)[0]) == 40_000
    column = {"^idiot$": 0, "^fat$": 1}
    for text in ("f a t", "so f a t, f a t.", "i d i o t."):  # what is fitted and what is scored is read alike
        assert Features(column, table)(text) == {column[f"^{w}$"] for w in d.words(text) if f"^{w}$" in column} != set()


def test_decode_equals_enumeration():
    r = random.Random(31)
    letters = "abcdeiot"
    counts = trigram_counts(Counter({"".join(r.choice(letters) for _ in range(r.randint(1, 6))): r.randint(1, 50) for _ in range(60)}))
    d = Decoder(trigram_table(counts.items(), len(counts)))

    def cost(path):
        total, context = 0.0, "^^"
        for chars, extra in path:
            total += extra
            for c in chars:
                total += -math.log((counts.get(context + ("$" if c == " " else c), 0) + 0.05) / (counts.get(context + "\0", 0) + 0.05 * 64))
                context = "^^" if c == " " else context[1] + c
        return total - math.log((counts.get(context + "$", 0) + 0.05) / (counts.get(context + "\0", 0) + 0.05 * 64))

    for _ in range(150):
        lattice = [[("".join(r.choice(letters + " ") for _ in range(r.randint(0, 2))), r.choice([0.0, 0.5, 1.0])) for _ in range(r.randint(1, 4))] for _ in range(r.randint(1, 6))]
        best = min(map(cost, itertools.product(*lattice)))
        got = d.decode(lattice)
        assert any("".join(c for c, _ in path) == got and abs(cost(path) - best) < 1e-9 for path in itertools.product(*lattice))


def test_score_is_the_logistic_of_the_weights():
    weights = {"^idiot$": 2.0, "idi": 0.5, "^fat$": -1.0}
    table = trigram_table(trigram_counts(Counter({"idiot": 9, "fat": 4})).items(), 9)
    scorer = Scorer(Model(weights, -1.5, table))
    for text in ("", "idiot", "1d10t and idiot", "f a t", "an idiom"):
        has = {g for w in scorer.features.decoder.words(text) for g in grams_of(w)} & set(weights)
        assert abs(scorer.score(text) - 1 / (1 + math.exp(1.5 - sum(weights[g] for g in has)))) < 1e-12


def test_toxicity(spark):
    r = random.Random(8)
    clean = [f"{a}{b}" for a in ("ta", "re", "mo", "li") for b in ("nd", "ra", "sto", "ve", "ko")]
    docs, labels = [], []
    for i in range(600):
        w = [r.choice(clean) for _ in range(r.randint(5, 40))]
        toxic = i % 5 == 0
        if toxic:
            for bad in r.sample(["grumbler", "zwackel", "vilewort", "grumblest"], 2):
                w.insert(r.randrange(len(w)), bad)
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    extra = [(9001, "tand relve gr*mbler"), (9002, None), (9003, ""), (9004, "tand " * 5000 + "gruuuumbler"), (9005, "z w a c k e l"), (9006, "tand revo"), (None, "tand")]
    frame = spark.createDataFrame([(*d, 0.5) for d in docs + extra], "doc_id long, text string, score double")
    model = train(frame, spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int"))
    scored = score_texts(frame, model).collect()
    assert len(scored) == len(docs) + len(extra) and all(0 <= x["score"] <= 1 for x in scored)
    kept = [(x["predicted"], dict(labels)[x["doc_id"]]) for x in scored if x["held_out"] and x["doc_id"] in dict(labels)]
    assert len(kept) > 60 and sum(a == b for a, b in kept) / len(kept) > 0.97
    by = {x["doc_id"]: x["predicted"] for x in scored}
    assert (by[9002], by[9003], by[9004], by[9005], by[9006]) == (0, 0, 1, 1, 0)
    assert {x["doc_id"] for x in scored if x["held_out"]} == {d for d, _ in docs + extra if d is not None and zlib.crc32(str(d).encode()) % 5 == 0}
    assert score_texts(frame.where("false"), model).count() == 0
    none = train(frame, spark.createDataFrame([], "doc_id long, toxic int"))
    assert score_texts(frame, none).where("predicted = 1").count() == 0


# --- tool calls

SCHEMAS = {"add": {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": "integer", "minimum": 0}, "tags": {"type": "array", "items": {"type": "string", "minLength": 1}}, "mode": {"enum": ["x", "y"]}}}}


def test_link_calls(spark):
    calls = [
        (1, "c1", None, "add", '{"tags": ["é"], "a": 1}'), (1, "c2", "c1", "add", '{"a": -1, "b": 2, "mode": "z", "tags": [""]}'), (1, "c3", "c2", "none", "{}"), (1, "c4", "gone", "add", "not json"),
        (2, "l1", "l2", "add", '{"a": 1.0}'), (2, "l2", "l1", "add", None), (2, "l3", "l3", "add", '{"a": true}'), (1, None, None, "add", "{}"), (1, "c1", None, "add", '{"a": 2}'),
    ]
    results = [(1, "c1", 5, "late"), (1, "c1", 2, "first"), (1, "orphan", 1, "x"), (2, "l1", 1, None), (1, None, 1, "y")]
    c = spark.createDataFrame(calls, "conv_id long, call_id string, after string, name string, arguments string")
    r = spark.createDataFrame(results, "conv_id long, call_id string, seq long, content string")
    got = {}
    for x in link_calls(c, r, SCHEMAS).collect():
        got.setdefault((x["conv_id"], x["call_id"]), []).append(x)
    one = sorted(got[1, "c1"], key=lambda x: x["canonical"])
    assert len(one) == 2 and one[0]["canonical"] == '{"arguments":{"a":1,"tags":["é"]},"id":"c1","name":"add","result":"first"}' and one[0]["n_results"] == 2 and one[0]["valid"]
    two = got[1, "c2"][0]
    assert two["level"] == 1 and two["errors"] == "$.a: too small; $.b: not known; $.mode: not in enum; $.tags[0]: too short" and two["status"] == "unanswered"
    assert (got[1, "c3"][0]["level"], got[1, "c3"][0]["errors"]) == (2, "no schema")
    assert (got[1, "c4"][0]["level"], got[1, "c4"][0]["errors"], json.loads(got[1, "c4"][0]["canonical"])["arguments"]) == (0, "not JSON", "not json")
    assert got[1, "orphan"][0]["status"] == "orphan" and not got[1, "orphan"][0]["valid"]
    assert [got[2, k][0]["status"] for k in ("l1", "l2", "l3")] == ["circle"] * 3 and (2, None) not in got


def test_calls_with_odd_json(spark):
    digits = "9" * 400
    odd = {
        "s": '{"a": 1, "mode": "\\ud800"}', "i": f'{{"a": {digits}}}', "d": "[" * 5000 + "]" * 5000, "d2": "[" * 150 + "]" * 150, "n": '{"a": NaN}', "inf": '{"a": -Infinity}', "e": '{"a": 1e999}', "k": '{"\\udfff": 1, "a": 1}',
        "q": '{"a": 1, "tags": ["' + "[" * 300 + '\\""]}',
    }
    c = spark.createDataFrame([(1, k, None, "add", v) for k, v in odd.items()], "conv_id long, call_id string, after string, name string, arguments string")
    none = spark.createDataFrame([], "conv_id long, call_id string, seq long, content string")
    got = {x["call_id"]: x for x in link_calls(c, none, SCHEMAS).collect()}
    assert {k for k, x in got.items() if x["errors"] == "not JSON"} == {"d", "n", "inf", "e"}
    assert got["s"]["errors"] == "$.mode: not in enum" and '"mode":"\\ud800"' in got["s"]["canonical"] and got["k"]["errors"] == "$.\\udfff: not known"
    assert got["i"]["valid"] and f'"a":{digits}' in got["i"]["canonical"] and got["q"]["valid"] and got["d2"]["errors"] == "$: not object"
    assert all(json.loads(x["canonical"])["id"] == k for k, x in got.items())
    turns = [(1, i, "user", json.dumps({"name": "f", "arguments": 0}).replace("0", v)) for i, v in enumerate(odd.values())]
    calls, results = calls_of_turns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    assert link_calls(calls, results, SCHEMAS).count() == len(odd)


def test_long_chain_of_calls(spark):
    calls = [(1, f"c{i}", f"c{i - 1}", "add", '{"a": 1}') for i in range(300)]
    c = spark.createDataFrame(calls, "conv_id long, call_id string, after string, name string, arguments string")
    got = {x["call_id"]: x["level"] for x in link_calls(c, spark.createDataFrame([], "conv_id long, call_id string, seq long, content string"), SCHEMAS).collect()}
    assert got == {f"c{i}": i for i in range(300)}


def test_calls_that_wait_for_several(spark):
    r = random.Random(8)
    want, calls = {}, []
    for conv in range(12):
        n = r.randint(1, 25)
        after = {i: sorted(set(r.choices(range(i), k=r.choice([0, 1, 1, 2, 3])))) if i else [] for i in range(n)}
        if conv % 3 == 0 and n > 4:
            after[2] = [0, n - 1]
            after[n - 1] = [2]
        level = {}
        for _ in range(n):
            level |= {i: max([-1, *(level[k] for k in a)]) + 1 for i, a in after.items() if all(k in level for k in a)}
        want |= {(conv, f"c{i}"): level.get(i, -1) for i in after}
        for i, a in after.items():
            calls.append((conv, f"c{i}", json.dumps([f"c{k}" for k in a] + ["gone"]) if len(a) != 1 else f"c{a[0]}", "add", "{}"))
    c = spark.createDataFrame(calls, "conv_id long, call_id string, after string, name string, arguments string")
    none = spark.createDataFrame([], "conv_id long, call_id string, seq long, content string")
    got = link_calls(c, none, SCHEMAS).collect()
    assert {(x["conv_id"], x["call_id"]): x["level"] for x in got} == want
    assert {(x["conv_id"], x["call_id"]) for x in got if x["status"] == "circle"} == {k for k, v in want.items() if v == -1} != set()
    turns = [(1, 0, "assistant", json.dumps({"id": x, "name": "add", "arguments": {}, "after": a})) for x, a in [("a", None), ("b", "a"), ("c", ["a", "b"])]]
    calls, _ = calls_of_turns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    assert {x["call_id"]: x["level"] for x in link_calls(calls, none, SCHEMAS).collect()} == {"a": 0, "b": 1, "c": 2}


def test_calls_of_turns(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "assistant", '{"id": "t1", "name": "add", "arguments": {"a": 1}}'), (1, 3, "tool", '{"tool_call_id": "t1", "content": "ok"}'), (None, 0, "user", "x"), (2, None, "user", "x"), (3, 0, None, None)]
    calls, results = calls_of_turns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    assert sorted((c["call_id"], c["name"]) for c in calls.collect()) == [("1:0", "user"), ("3:0", ""), ("t1", "add")]
    assert sorted((r["call_id"], r["content"]) for r in results.collect()) == [("1:0", "yo"), ("t1", "ok")]


def test_json_of_any_size():
    import time

    from tidemark.llm.tool_calls import canonical, parsed, problems

    long = "-" + "7" * 10_000
    assert canonical(parsed('{"b":[%s,1.5,"x\\ud800"],"a":%s}' % (long, long))) == '{"a":%s,"b":[%s,1.5,"x\\ud800"]}' % (long, long)
    assert problems(parsed(long), {"type": "integer", "minimum": 0}) == ["$: too small"]
    assert problems(parsed(long[1:]), {"type": "integer", "maximum": 10}) == ["$: too large"]
    began = time.time()
    for odd in ('{"a":"' + '\\"' * 1_000_000, '"' * 1_000_001, '{"a":"' + "\\" * 1_000_001, "[" * 1_000_000):
        with pytest.raises(ValueError):
            parsed(odd)
    assert time.time() - began < 2


def test_runs_of_digits_are_shortened_and_read():
    from collections import Counter

    from tidemark.llm.deobfuscate import Decoder, trigram_counts, trigram_table

    words = Counter({"idiot": 50, "kill": 40, "villa": 30, "stool": 20, "the": 500, "moon": 20, "hello": 60})
    counts = trigram_counts(words)
    decoder = Decoder(trigram_table(counts.items(), len(counts)))
    for seen, wanted in {"idi0t": "idiot", "idi00t": "idiot", "idi000t": "idiot", "idi0000000t": "idiot", "1d1100t": "idiot", "111d10t": "idiot", "ki11": "kill", "vi11a": "villa", "v111a": "villa", "m00n": "moon", "he110": "hello", "st0000l": "stool"}.items():
        assert decoder.restore(seen)[0] == wanted, seen
    assert decoder.restore("2000") == ("2000",) and decoder.restore("1" * 5000) == ("1" * 5000,)


def test_cut_is_never_over_even_odds():
    import numpy as np

    from tidemark.llm.toxicity import cut_of

    r = np.random.default_rng(3)
    labels = (np.arange(300) % 10 == 0).astype(np.int64)
    cols = np.where(labels == 1, r.integers(0, 5, 300), r.integers(5, 40, 300))
    cut = cut_of(np.arange(300), cols, labels, 40)
    assert cut <= 0
    none = np.zeros(0, np.int64)
    assert cut_of(none, none, none, 0) == 0.0
    assert cut_of(none, none, np.zeros(9, np.int64), 0) == 0.0


PROSE = "It was on the day that the house by the river stood in the light of the sun and all who came to see it were glad to be there with us in the end of the year, as it is by now known to the people of the town."


@pytest.mark.parametrize(
    "page, wanted",
    [
        (f'<nav><a href=x>Home</a></nav><article><div class="article-header"><h1>A headline</h1><p>The lead is what it says to the reader of the page, and it is for us.</p></div><p>{PROSE}</p></article><footer>Foot</footer>', f"A headline The lead is what it says to the reader of the page, and it is for us. {PROSE}"),
        (f'<article><h1>T</h1><p>{PROSE}</p><section class="notice-period"><p>{PROSE}</p></section></article>', f"T {PROSE} {PROSE}"),
        (f'<div class="entry tags politics"><p>{PROSE}</p></div><p>{PROSE}</p>', f"{PROSE} {PROSE}"),
        ("<div class=nav><a href=x>ホーム</a></div><h1>題名</h1><p>" + "これは日本語の文章です。とても長い段落です。" * 8 + "</p>", "題名 " + "これは日本語の文章です。とても長い段落です。" * 8),
        ('<div class="menu"><a href=x>Дом</a> <a href=y>Новости</a></div><p>' + "Это длинный абзац на русском языке о погоде. " * 7 + "</p>", ("Это длинный абзац на русском языке о погоде. " * 7).strip()),
        ("<h1>Title</h1><p>Short one.</p><p>Another short.</p>", "Title Short one. Another short."),
        (f'<article><p>{PROSE}</p><div class="comments"><p>{PROSE} me too</p></div><div class="cookie-notice">{PROSE}</div><aside>{PROSE}</aside></article><div hidden>{PROSE}</div>', PROSE),
        (f'<article><p>{PROSE}</p><div class="hidden md:block"><p>{PROSE}</p></div></article>', f"{PROSE} {PROSE}"),
        (f'<article><div class="site-notice user-comments">{PROSE}</div><p>{PROSE} end</p></article>', f"{PROSE} end"),
    ],
)
def test_words_outweigh_names_that_say_little(page, wanted):
    from tidemark.llm.html_text import main_text

    assert main_text(f"<html><body>{page}</body></html>") == wanted
