import collections
import os
import random
import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import bit_sliced, passages, simhash
from tidemark.llm.bit_sliced import digits, search_shard, top_k
from tidemark.llm.components import components
from tidemark.llm.line_dedup import dedup_lines, within_one
from tidemark.llm.passages import Fenwick, aligned, chains, repeated_passages, seeds_of
from tidemark.llm.simhash import fingerprint, near_copies
from tidemark.session import shared_dir

WORDS = [f"w{i}" for i in range(400)]


def prose(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


# --- SimHash


def plain_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    n = min(k, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def joined(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint():
    r = random.Random(1)
    for text in [None, "", " \n\t", "One", "one two\x0bthree", "a b c d", "É É a\u00a0b c d e", *[prose(r, r.randint(1, 900)) for _ in range(30)]]:
        assert fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("tile", [4096, 5])
def test_near_copies_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    r = random.Random(4)
    docs = []
    for i in range(120):
        words = prose(r, r.randint(20, 300)).split()
        docs.append((10 * i, " ".join(words)))
        for j in range(r.choice([0, 0, 1, 6])):
            copy = list(words)
            for _ in range(r.choice([0, 1, 3])):
                copy[r.randrange(len(copy))] = r.choice(WORDS)
            docs.append((10 * i + 1 + j, " ".join(copy)))
    docs += [(5000, None), (5001, ""), (5002, "  "), (5003, "one"), (None, "one"), (7, docs[0][1])]
    got = near_copies(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    known = [(d, plain_fingerprint(t)) for d, t in docs if d is not None]
    fps = sorted({f for _, f in known})
    links = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 4]
    root = joined(links, fps)
    least = {}
    for d, f in known:
        least[root[f]] = min(least.get(root[f], d), d)
    assert sorted(map(tuple, got)) == sorted((d, f"{f:016x}", least[root[f]]) for d, f in known)


def test_tiles_by_population_count(spark, monkeypatch):
    """One block value of many fingerprints, of all population counts: no link is lost between tiles."""
    monkeypatch.setattr(simhash, "TILE", 40)
    r = random.Random(6)
    fps = set()
    for _ in range(250):
        f = sum(1 << b for b in range(13, 64) if r.random() < r.choice([0.1, 0.5, 0.9]))
        fps |= {f, f ^ sum(1 << b for b in set(r.choices(range(13, 64), k=r.choice([1, 3, 4, 5, 7]))))}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = [(a % (1 << 64), b % (1 << 64)) for a, b in map(tuple, simhash.near_edges(spark.createDataFrame([(f,) for f in signed], "fp long"), 4).collect())]
    links = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 4]
    assert all((a ^ b).bit_count() <= 64 for a, b in edges) and joined(edges, fps) == joined(links, fps)


def test_near_copies_of_nothing(spark):
    assert near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)]
    want = joined(edges, {n for e in edges for n in e})
    got = components(spark.createDataFrame([*edges, (None, 3)], "src long, dst long")).collect()
    assert {r["node"]: r["component"] for r in got} == want


# --- line dedup


def edits(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def plain_near(a, b):
    v, w = a.split(), b.split()
    if max(len(v), len(w)) >= 8:
        return abs(len(v) - len(w)) <= 1 and edits(v, w) <= 1
    return max(len(a), len(b)) >= 16 and abs(len(a) - len(b)) <= 1 and edits(a, b) <= 1


def plain_lines(docs):
    seen, gone, firsts = [], {}, set()
    for doc, text in sorted((d, t) for d, t in docs if d is not None and t is not None):
        for n, line in enumerate(text.split("\n")):
            line = line.strip()
            if not line:
                continue
            found = next((pos for pos, body in seen if body == line or plain_near(body, line)), None)
            if found:
                gone[doc, n] = found
            if line not in firsts:
                firsts.add(line)
                seen.append(((doc, n), line))
    return gone


def test_within_one():
    a = "a b c d".split()
    assert within_one(a, a) and within_one(a, "a x c d".split()) and within_one(a, "a b c".split()) and within_one("b c d".split(), a) and within_one(a, [*a, "e"])
    assert not within_one(a, "a x y d".split()) and not within_one(a, "b c d e".split()) and not within_one(a, a[:2])


def test_dedup_lines_equals_brute_force(spark):
    r = random.Random(9)
    base = [prose(r, r.randint(3, 20)) for _ in range(25)] + [prose(r, n) for n in (7, 8, 7, 8)]
    docs = []
    for d in range(60):
        lines = []
        for _ in range(r.randint(0, 6)):
            words = r.choice(base).split()
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                at = r.randrange(len(words))
                words = r.choice([words[:at] + words[at + 1 :], words[:at] + [r.choice(WORDS)] + words[at:], words[:at] + [r.choice(WORDS)] + words[at + 1 :]])
            line = r.choice([" ", " ", "  "]).join(words)
            for _ in range(r.choice([0, 0, 1, 2])):
                at = r.randrange(len(line) + 1)
                line = r.choice([line[:at] + line[at + 1 :], line[:at] + "é" + line[at:], line[:at] + "é" + line[at + 1 :]])
            lines.append(r.choice(["", " "]) + line)
        docs.append((d, "\n".join(lines)))
    docs += [(None, base[0]), (100, None), (101, ""), (102, "\n\n"), (103, "same\nsame\nSame"), (104, "tart north\nart north"), (105, "Copyright 2020 by Acme\nCopyright 2021 by Acme\nPage 1\nPage 2"), (106, "x " * 700 + "y\n" + "x " * 700 + "z"), (1 << 53, base[3]), ((1 << 53) + 1, base[3])]
    gone = plain_lines(docs)
    found = dedup_lines(spark.createDataFrame([(*x, "extra") for x in docs], "doc_id long, text string, line string"))
    assert found.columns == ["doc_id", "text", "line", "n_lines", "n_dropped", "dropped"]
    for row in found.collect():
        text = dict(docs)[row["doc_id"]]
        if row["doc_id"] is None or text is None:
            assert row["text"] == text and row["n_dropped"] == 0
            continue
        want = {n: pos for (d, n), pos in gone.items() if d == row["doc_id"]}
        assert {x["line"]: (x["by_doc"], x["by_line"]) for x in row["dropped"]} == want
        assert row["text"] == "\n".join(x for n, x in enumerate(text.split("\n")) if n not in want)
        assert row["n_lines"] == sum(bool(x.strip()) for x in text.split("\n"))


# --- passages


def test_fenwick_and_chains():
    f = Fenwick(8)
    for place, value in [(3, 1.0), (5, 4.0), (1, 2.0)]:
        f.put(place, (value, place))
    assert (f.before(1)[1], f.before(3)[1], f.before(6)[1], f.before(0)[1]) == (-1, 1, 5, -1)
    found = chains([(0, 100), (5, 105), (9, 109), (300, 110), (12, 3), (20, 118)])
    assert [(0, 100), (5, 105), (9, 109), (20, 118)] in found and sum(map(len, found)) == 6


def test_chains_equal_brute_force():
    r = random.Random(12)
    cost = passages.GAP_COST / (2 * passages.K)

    def worth(chain):
        return len(chain) - cost * sum(c - a + d - b for (a, b), (c, d) in zip(chain, chain[1:]))

    for _ in range(300):
        side = r.choice([20, 150, 600])
        anchors = sorted({(r.randrange(side), r.randrange(side)) for _ in range(r.randint(1, 60))} | {(i, i + 5) for i in range(0, r.randint(0, side), 6)})
        best = {}
        for x, y in anchors:
            best[x, y] = 1.0 + max([0.0, *(w - cost * (x - a + y - b) for (a, b), w in best.items() if 0 < x - a <= 60 and 0 < y - b <= 60)])
        found = chains(anchors)
        assert sorted(a for c in found for a in c) == anchors
        assert all(0 < c - a <= 60 and 0 < d - b <= 60 for chain in found for (a, b), (c, d) in zip(chain, chain[1:]))
        assert abs(max(map(worth, found)) - max(best.values())) < 1e-9


@pytest.mark.parametrize("first, gap, second", [(60, 80, 60), (100, 80, 60), (200, 300, 60)])
def test_chains_after_a_gap(first, gap, second):
    places = [*range(0, first, 6), *range(first + gap, first + gap + second, 6)]
    assert sorted(map(len, chains([(x, x + 3) for x in places]))) == sorted([len(range(0, first, 6)), second // 6])


def test_two_passages_of_a_pair(spark):
    r = random.Random(13)
    say = lambda n: " ".join(f"{r.random():.12f}" for _ in range(n))
    a, b, c = say(100), say(60), say(70)
    docs = [(1, " ".join([a, say(90), b, say(300), c])), (2, " ".join([say(5), a, say(80), b, say(310), c]))]
    got = repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((x["start"], x["stop"], x["ref_start"], x["ref_stop"]) for x in got) == [(5, 105, 0, 100), (185, 245, 190, 250), (555, 625, 550, 620)]


def test_seeds_meet():
    r = random.Random(5)
    a = np.array([r.getrandbits(64) for _ in range(300)], np.uint64)
    b = np.concatenate((np.array([r.getrandbits(64) for _ in range(57)], np.uint64), a[100:117], np.array([r.getrandbits(64) for _ in range(80)], np.uint64)))
    shared = set(seeds_of(a, 6, 12)[1].tolist()) & set(seeds_of(b, 6, 12)[1].tolist())
    assert shared  # 17 equal words have a seed in common
    assert len(seeds_of(np.zeros(5, np.uint64), 6, 12)[0]) == 0 and 0 < len(seeds_of(np.zeros(1000, np.uint64), 6, 12)[0]) < 100


def test_aligned():
    a = "a b c d e f".split()
    assert aligned(a, a) == 6 and aligned(a, "a b x d e f".split()) == 5 and aligned(a, "a b d e f".split()) == 5 and aligned([], a) == 0
    assert aligned("x a b c y".split(), "a b z c".split()) == 3


def test_repeated_passages(spark):
    r = random.Random(11)
    passage = prose(r, 60).split()
    changed = list(passage)
    changed[20], changed[45] = "new", "words"
    docs = [(1, prose(r, 80) + " " + " ".join(passage) + " " + prose(r, 30)), (2, prose(r, 400)), (3, prose(r, 50) + " " + " ".join(passage).upper()), (4, " ".join(changed) + " " + prose(r, 90)), (5, prose(r, 100)), (6, None), (7, ""), (8, "short"), (None, " ".join(passage)), (9, prose(r, 20) + " " + " ".join(passage[:25]) + " " + prose(r, 20))]
    got = {x["doc_id"]: x for x in repeated_passages(spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, ref long")).collect()}
    assert set(got) == {3, 4}
    assert (got[3]["ref_doc_id"], got[3]["start"], got[3]["stop"], got[3]["ref_start"], got[3]["ref_stop"], got[3]["identity"]) == (1, 50, 110, 80, 140, 1.0)
    assert got[4]["ref_doc_id"] == 1 and got[4]["n_equal"] >= 55 and got[4]["identity"] < 1
    assert repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_matches_are_longest(monkeypatch):
    r = random.Random(14)
    for _ in range(200):
        a, b = ([r.choice("abcdefgh"[: r.randint(2, 8)]) for _ in range(r.randint(0, 30))] for _ in "ab")
        before = [0] * (len(b) + 1)
        for word in a:
            now = [0]
            for j, other in enumerate(b):
                now.append(before[j] + 1 if word == other else max(now[j], before[j + 1]))
            before = now
        found = passages.matches(a, b)
        assert len(found) == before[-1] and all(a[i] == b[j] for i, j in found)
        assert all(i < k and j < m for (i, j), (k, m) in zip(found, found[1:]))
    monkeypatch.setattr(passages, "BLOCK", 64)
    a = [str(i) for i in range(1000)]
    b = [w if i % 5 else "x" for i, w in enumerate(a)]
    assert passages.matches(a, b) == [(i, i) for i in range(1000) if i % 5]


def test_fuzzy_passages_are_found(spark):
    r = random.Random(15)
    new = lambda: f"{r.random():.12f}"
    docs, want = [], {}
    changes = [("each tenth", 60, lambda i: i % 10 == 9), ("each sixth", 200, lambda i: i % 6 == 5), ("9 and 50", 60, lambda i: i in (9, 50))]
    changes += [(f"{share:.2f} at random", n, None) for share in (0.95, 0.9, 0.85, 0.8) for n in (60, 100) for _ in range(5)]
    for k, (_, n, at) in enumerate(changes):
        passage = [new() for _ in range(n)]
        gone = {i for i in range(n) if at(i)} if at else set(r.sample(range(1, n - 1), round(n * (1 - float(_[:4])))))
        copy = [new() if i in gone else w for i, w in enumerate(passage)]
        while not at and any(2 * sum(i in gone for i in part) > len(part) for m in range(1, n) for part in (range(m), range(n - m, n))):
            gone = set(r.sample(range(1, n - 1), len(gone)))
            copy = [new() if i in gone else w for i, w in enumerate(passage)]
        docs += [(k, " ".join([*(new() for _ in range(90)), *passage, *(new() for _ in range(90))])), (1000 + k, " ".join([*(new() for _ in range(50)), *copy, *(new() for _ in range(90))]))]
        edge = [i for i in range(n) if i not in gone]
        want[1000 + k] = (k, 50 + edge[0], 50 + edge[-1] + 1, n - len(gone))
    got = repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {x["doc_id"]: (x["ref_doc_id"], x["start"], x["stop"], x["n_equal"]) for x in got} == want and len(got) == len(want)


def test_seeds_meet_in_changed_passages():
    """Of passages with words changed at random nearly all share the two seeds of a chain; equal runs of under nine words only may share none."""
    r = np.random.default_rng(17)
    new = lambda n: r.integers(0, 1 << 62, n).astype(np.uint64)
    for share in (0.95, 0.9, 0.85, 0.8):
        met = 0
        for _ in range(200):
            passage = new(50)
            copy = passage.copy()
            gone = r.choice(50, round(50 * (1 - share)), replace=False)
            copy[gone] = new(len(gone))
            sides = [np.concatenate((new(90), p, new(90))) for p in (passage, copy)]
            a, b = (seeds_of(x, passages.K, passages.WINDOW)[1].tolist() for x in sides)
            met += len(set(a) & set(b)) >= passages.MIN_SEEDS
        assert met >= 190


def plain_ties(seeds):
    """Of each occurrence (seed, doc, place): the first occurrence of its seed, and the first of the last document before; in earlier documents."""
    at = {}
    for seed, doc, place in sorted(seeds):
        at.setdefault(seed, {}).setdefault(doc, place)
    want = set()
    for seed, doc, place in seeds:
        before = [d for d in sorted(at[seed]) if d < doc]
        if before:
            first, last = before[0], before[-1]
            want.add((doc, place, first, at[seed][first], last if last != first else None, at[seed][last] if last != first else None))
    return want


@pytest.mark.parametrize("cuts", [1, 7])
def test_ties_equal_brute_force(cuts):
    r = random.Random(19)
    seeds = sorted({(r.randrange(30), r.randrange(-40, 40), r.randrange(50)) for _ in range(900)})
    held, got = [np.zeros(0, t) for t in (np.int64, np.int32, np.int64, np.int32)], set()
    for i in range(cuts):
        part = seeds[len(seeds) * i // cuts : len(seeds) * (i + 1) // cuts]
        columns = [np.array([s[0] for s in part], np.int64), np.zeros(len(part), np.int32), np.array([s[1] for s in part], np.int64), np.array([s[2] for s in part], np.int32)]
        rows = [np.concatenate(c) for c in zip(held, columns)]
        out, last = passages.ties_of(*rows, carried=len(held[0]))
        held = [c[last] for c in rows]
        for _, _, doc, place, ref, ref_place, prev, prev_place in zip(*[c.tolist() for c in out]):
            got.add((doc, place, ref, ref_place, prev if prev_place >= 0 else None, prev_place if prev_place >= 0 else None))
    assert got == plain_ties(seeds)


def test_dealt_ties_have_the_first_holder(spark, monkeypatch):
    r = random.Random(20)
    words = [f"v{i}" for i in range(9)]
    docs = [(i, " ".join(r.choice(words) for _ in range(40))) for i in range(60)]
    frame = spark.createDataFrame(docs, "_id long, _text string").repartition(3)
    first = lambda: {(x["doc"], x["place"], x["ref"], x["ref_place"]) for x in passages.ties(frame, 2, 1).where("ref_place >= 0").collect()}
    dealt = first()
    monkeypatch.setattr(passages, "OFTEN", 1 << 30)
    assert len(dealt) > 1000 and first() == dealt


def test_passage_with_two_first_holders(spark):
    r = random.Random(22)
    new = lambda n: [f"{r.random():.12f}" for _ in range(n)]
    p = new(60)
    docs = [(1, new(70) + p[:45] + new(50)), (2, new(70) + p[40:] + new(50)), (3, new(80) + p + new(20)), (4, new(10) + p + new(90))]
    got = {(x["doc_id"], x["ref_doc_id"], x["start"], x["stop"]) for x in repeated_passages(spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")).collect()}
    assert got == {(4, 3, 10, 70)}


@pytest.mark.parametrize("alone, tile", [(8, 4096), (1, 4), (1 << 30, 4096)])
def test_passage_whose_seeds_have_other_first_and_last_holders(spark, monkeypatch, alone, tile):
    """Each part of a passage is also in many documents before both and between them, so no seed is tied to the other holder of all."""
    monkeypatch.setattr(passages, "ALONE", alone)
    monkeypatch.setattr(passages, "TILE", tile)
    r = random.Random(25)
    new = lambda n: [f"{r.random():.12f}" for _ in range(n)]
    p = new(60)
    parts = [(new(20) + p[i : i + 16] + new(70)) for i in range(0, 48, 4) for _ in range(2)]
    docs = [*enumerate(parts), (100, new(30) + p + new(40)), *[(200 + i, new(5) + w) for i, w in enumerate(parts)], (300, new(7) + p + new(80)), (301, new(7) + p + new(80))]
    docs = [(d, w if d < 200 or d >= 300 else new(5) + w[20:36] + new(60)) for d, w in docs]
    got = {(x["doc_id"], x["ref_doc_id"], x["start"], x["stop"]) for x in repeated_passages(spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")).collect()}
    assert {(300, 100, 7, 67), (301, 300, 7, 67)} <= got and {x[:2] for x in got} <= {(300, 100), (301, 100), (301, 300)}


def test_links_of_all_pairs_are_rows_or_meet_in_a_holder(spark):
    """Passages with changes, in parts and whole, held against all pairs of documents: two that share one have a row, or are rows of one document."""
    r = random.Random(26)
    new = lambda n: [f"{r.random():.12f}" for _ in range(n)]
    pool = [new(64) for _ in range(5)]
    docs, whole = [], {}
    for d in range(70):
        k = r.randrange(5)
        words = [w if r.random() > 0.02 else new(1)[0] for w in pool[k]]
        if r.random() < 0.7:  # a part, too short for a passage
            a = r.randrange(44)
            words = words[a : a + 20]
        else:
            whole[d] = k
        docs.append((d, " ".join(new(70) + words + new(70))))
    rows = {(x["doc_id"], x["ref_doc_id"]) for x in repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    refs = {d: {d} | {b for a, b in rows if a == d} for d in whole}
    assert all(refs[a] & refs[b] for a in whole for b in whole if whole[a] == whole[b])
    assert all(whole.get(a, -1) == whole.get(b, -2) for a, b in rows)


@pytest.mark.parametrize("alone", [8, 1 << 30])
def test_holders_that_meet_in_one_are_not_paired(spark, monkeypatch, alone):
    """The ends of a passage are in earlier documents too, without the rest; each holder has a row with its first holder, and at most one more."""
    monkeypatch.setattr(passages, "ALONE", alone)
    r = random.Random(31)
    new = lambda n: [f"{r.random():.12f}" for _ in range(n)]
    p = new(70)
    docs = [(0, new(40) + p[:16] + new(40)), (1, new(40) + p[54:] + new(40)), *[(10 + i, new(7 + i) + p + new(60)) for i in range(12)]]
    got = [(x["doc_id"], x["ref_doc_id"], x["start"], x["stop"]) for x in repeated_passages(spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")).collect()]
    assert {(10 + i, 10, 7 + i, 77 + i) for i in range(1, 12)} <= set(got) and len(got) <= 22


def test_copies_are_tied_to_the_least_id_of_their_text(spark):
    r = random.Random(27)
    new = lambda n: [f"{r.random():.12f}" for _ in range(n)]
    p = new(60)
    docs = [(1, new(9) + p), (2, q := p + new(30)), (3, q), (4, q), (5, s := new(20)), (6, s)]
    got = {(x["doc_id"], x["ref_doc_id"], x["start"], x["stop"]) for x in repeated_passages(spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")).collect()}
    assert {(2, 1, 0, 60), (3, 2, 0, 90), (4, 2, 0, 90)} <= got and not {5, 6} & {x[0] for x in got}


def test_compared_windows_equal_brute_force():
    """No pair with enough words and neighbours in common is left out, in one tile or in two, and few others come along."""
    r = np.random.default_rng(28)
    codes = (r.zipf(1.3, (200, 124)) % passages.KINDS).astype(np.int16)
    for i in range(0, 200, 3):
        codes[i, r.integers(30, 100) :] = -1
    codes[10:60, 20:34], codes[60:90, 20:80] = codes[0, 20:34], codes[1, 20:80]
    doc, loose, place = r.permutation(200), r.random(200) < 0.6, np.arange(200, dtype=np.int32)
    counts = [(collections.Counter(w := c[c >= 0].tolist()), collections.Counter(zip(w, w[1:]))) for c in codes]
    pairs = [(a, b) for a in range(200) for b in range(200) if doc[a] > doc[b] and (loose[a] or loose[b])]
    least = passages.neighbours(passages.MIN_WORDS, passages.MIN_IDENTITY)
    want = {(doc[a], place[a], doc[b], place[b]) for a, b in pairs if (counts[a][0] & counts[b][0]).total() >= 40 and (counts[a][1] & counts[b][1]).total() >= least}
    for blocks in (np.zeros(200, np.int64), doc % 2):
        got: list[tuple] = []
        for low, high in [(0, 0), (0, 1), (1, 1)][: 1 + 2 * int(blocks.max())]:
            rows = (blocks == low) | (blocks == high)
            got += zip(*passages.compared(np.full(rows.sum(), low), np.full(rows.sum(), high), blocks[rows], doc[rows], place[rows], loose[rows], codes[rows], 40.0, least).tolist())
        assert len(got) == len(set(got)) and want <= set(got) and len(want) > 1000 and len(got) < 1.2 * len(want)


def test_neighbours_are_the_least_of_a_passage():
    equal = ([1] * 4 + [0]) * 10  # every fifth word changed
    assert abs(passages.neighbours(50, 0.8) - 19) < 1e-9 <= sum(a and b for a, b in zip(equal, equal[1:])) - 19


def test_tables_go_when_they_are_read(spark):
    r = random.Random(29)
    p = [f"{r.random():.12f}" for _ in range(90)]
    before = set(os.listdir(shared_dir(spark)))
    assert len(repeated_passages(spark.createDataFrame([(d, " ".join([str(d), *p])) for d in range(3)], "doc_id long, text string")).collect()) == 2
    assert {n.split("-")[0] for n in set(os.listdir(shared_dir(spark))) - before} <= {"texts", "settled", "wanted"}


def test_passages_grow_as_far_as_they_go(spark):
    r = random.Random(23)
    new = lambda n: [f"{r.random():.12f}" for _ in range(n)]
    p, q = new(900), new(460)
    few = q[:60] + [w if i % 5 else "x" for i, w in enumerate(q[60:])]  # after 60 words hardly a seed in common
    docs = [(1, new(30) + p[:400] + new(50)), (2, new(40) + p[500:] + new(50)), (3, new(5) + p + new(20)), (4, p + new(90)), (5, new(10) + q + new(80)), (6, few + new(80))]
    got = repeated_passages(spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")).collect()
    covered = {d: {i for x in got if x["doc_id"] == d for i in range(x["start"], x["stop"])} for d in range(1, 7)}
    assert covered == {1: set(), 2: set(), 3: {*range(5, 405), *range(505, 905)}, 4: set(range(900)), 5: set(), 6: set(range(460))}
    assert [(x["start"], x["stop"], x["ref_start"], x["ref_stop"]) for x in got if x["doc_id"] == 6] == [(0, 460, 10, 470)]


def test_several_passages_and_holders_by_words(spark):
    """Random texts with several passages a pair, several holders, changes and loops: nearly all planted words are in a passage, and no others."""
    r = random.Random(24)
    new = lambda n: [f"{r.random():.12f}" for _ in range(n)]
    pool = [new(r.randint(55, 150)) for _ in range(12)]
    pool += [(x := new(20)) * 4]  # text that goes round
    seen, docs = set(), []
    planted = {}
    for d in range(80):
        words, spans = new(r.randint(0, 60)), []
        for k in r.sample(range(len(pool)), r.choice([0, 1, 2, 3])):
            body = [w if r.random() > 0.07 else new(1)[0] for w in pool[k]]
            if k in seen:
                spans.append((len(words), len(words) + len(body)))
            seen.add(k)
            words += body + new(r.randint(65, 160))
        docs.append((d, " ".join(words)))
        planted[d] = {i for a, b in spans for i in range(a, b)}
    got = {}
    for x in repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        got.setdefault(x["doc_id"], set()).update(range(x["start"], x["stop"]))
    total = sum(map(len, planted.values()))
    assert total > 2000 and sum(len(planted[d] & got.get(d, set())) for d in planted) >= 0.95 * total
    assert sum(len(got[d] - planted[d]) for d in got) <= 0.01 * total


# --- top-k


def test_digits():
    for n in range(-300, 300):
        assert sum(d << p for p, d in digits(n)) == n


def test_search_shard_equals_numpy():
    r = np.random.default_rng(3)
    for _ in range(10):
        n, dims = int(r.integers(1, 200)), int(r.integers(1, 9))
        values = r.integers(-40, 40, (n, dims))
        ids = np.sort(r.choice(1000, n, replace=False))
        queries = [(int(i), r.integers(-60, 60, dims).tolist()) for i in [*ids[:3], 5000]] + [(6000, [0] * dims)]
        got = {}
        for q, i, s in search_shard(ids, values, queries, 5):
            got.setdefault(q, []).append((s, i))
        for q, v in queries:
            want = sorted(((int(s), int(i)) for s, i in zip(values @ np.array(v), ids) if i != q), key=lambda x: (-x[0], x[1]))[:5]
            assert sorted(got.get(q, []), key=lambda x: (-x[0], x[1])) == want


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.5, 0.5]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [nan, 1.0]), (5, [1.0, None]), (6, [inf, 1.0]), (None, [9.0, 9.0]), (7, [2.0]), (8, [1e7, 0.0]), (9, [-1e7, 0.0]), (1, [1.0, 1.0]), (10, [])]
    frame = spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, embedding array<float>, rank int")
    got = [tuple(r) for r in top_k(frame, k=3).orderBy("query_id", "rank").collect()]
    big = 256 * 10_000_000
    assert got == [(0, 1, 8, 256 * big), (0, 2, 7, 256 * 512), (0, 3, 1, 256 * 256), (50, 1, 8, 128 * big), (50, 2, 1, 128 * 512), (50, 3, 1, 128 * 512)]
    with pytest.raises(Exception, match="too large"):
        top_k(spark.createDataFrame([(0, [1e30])], "vec_id long, embedding array<double>")).collect()
    assert top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_top_k_in_tiles_without_broadcast(spark, monkeypatch):
    """Queries meet all shards over several tasks; that they are sent to many is no reason to pass them through the driver."""
    monkeypatch.setattr(bit_sliced, "SHARD_ROWS", 32)
    monkeypatch.setattr(bit_sliced, "HELD_QUERIES", 4, raising=False)
    monkeypatch.setattr(bit_sliced, "GROUPS", 3, raising=False)
    r = np.random.default_rng(4)
    vectors = r.integers(-3, 4, (1500, 4))
    rows = [(i % 1490, (v / 256).tolist()) for i, v in enumerate(vectors)]
    found = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = sorted(tuple(x) for x in found.collect())
    asked = {}
    for i, v in zip((i for i, _ in rows), vectors.tolist()):
        if i % 50 == 0:
            asked[i] = min(asked.get(i, v), v)
    want = []
    for q, v in asked.items():
        best = sorted((-int(s), i) for s, (i, _) in zip(vectors @ np.array(v), rows) if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
