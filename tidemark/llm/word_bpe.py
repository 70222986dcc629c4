"""BPE over whole words with an end mark: the distinct words of a block are encoded along a trie.

A word's encoding is known from its last token: what stands before that token is the encoding of a shorter
prefix of the word. So each node of a trie of words needs one last token, found from those of the nodes above
it, and words that begin alike share the work on what they share. A token may come last if it ends at the
node and is compatible with the last token at its own start: the two alone must encode to themselves. The
last symbol of a word carries the end mark and is looked up apart, so a word and a longer one that begins
with it part only there.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import sys
import unicodedata
import uuid
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, per_worker, values_of

#: Words and pairs that a worker keeps before it starts afresh, characters a block, and a stretch of a long text; results don't depend on them.
MAX_KEPT, BLOCK_CHARS, STRETCH_CHARS = 400_000, 4_000_000, 500_000
NEVER, UNNAMED = 1 << 60, -1

#: Contractions that are words of their own.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: Lower case of capitals that are younger than Python's own table (first, last, distance of the small letter).
YOUNG_CAPITALS = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1),
    (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
)
#: Letters and numbers of Unicode 16, which are younger than Python's own table (first, last).
YOUNG = {
    "L": (
        (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
        (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
        (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
    ),
    "N": ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)),
}
_LOWER = {c: c + d for first, last, d in YOUNG_CAPITALS for c in range(first, last + 1)}


def byte_names() -> list[str]:
    """The character that stands for each byte in the names of tokens: itself if it shows, else the next from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b if b in shown else 0x100 + hidden.index(b)) for b in range(256)]


def character_class(starts: str) -> str:
    """Ranges of a regular expression for the characters whose general category starts with L or N."""
    found, first = [f"\\U{a:08x}-\\U{b:08x}" for a, b in YOUNG[starts]], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == starts
        if inside and first is None:
            first = c
        elif not inside and first is not None:
            found.append(f"\\U{first:08x}-\\U{c - 1:08x}")
            first = None
    return "".join(found)


def read_vocabulary(path: str) -> dict:
    """Of a tokenizer's JSON file: tokens by name, merges in order, end mark, and special tokens with their ids."""
    with open(path, encoding="utf-8") as lines:
        whole = json.load(lines)
    model = whole["model"]
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    special = {t["content"]: t["id"] for t in whole.get("added_tokens", ())}
    return {"vocab": model["vocab"], "merges": merges, "mark": model["end_of_word_suffix"], "special": special}


class Merges:
    """What a vocabulary's merges say about single tokens and about two side by side."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], mark: str):
        byte_of = {name: b for b, name in enumerate(byte_names())}
        plain = lambda name: bytes(byte_of[c] for c in name)
        n = max(vocab.values()) + 1
        self.rank, self.halves = [-1] * n, [(-1, -1)] * n
        self.pairs: dict[tuple[int, int], int] = {}
        self.kept: dict[int, bool] = {}
        self.length = [0] * n
        symbols = [vocab.get(name + end) for name in byte_of for end in ("", mark)]
        if None in symbols:
            raise ValueError("the vocabulary lacks a byte, with or without the end mark")
        made = set(symbols)
        for rank, (a, b) in enumerate(merges):
            left, right, token = vocab[a], vocab[b], vocab[a + b]
            self.pairs[left, right] = rank
            if self.rank[token] >= 0 or token in symbols:
                raise ValueError(f"{a + b!r} comes from two merges")
            self.rank[token], self.halves[token] = rank, (left, right)
            if left in made and right in made and self._apart(left, right, rank):  # else other merges always come first
                made.add(token)
        #: Tokens by spelling, within words and at their ends, and UNNAMED for what only ends such a token.
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for name, token in vocab.items():
            if token in made:
                ends = name.endswith(mark) and len(name) > len(mark)
                spelled = plain(name[: -len(mark)] if ends else name)
                (self.final if ends else self.inner)[spelled] = token
                self.length[token] = len(spelled)
        for table in (self.inner, self.final):
            for spelled in list(table):
                for i in range(1, len(spelled)):
                    table.setdefault(spelled[i:], UNNAMED)

    def _apart(self, left: int, right: int, until: int = NEVER) -> bool:
        """Whether no merge over the border of two tokens comes before the one of rank `until`.

        The merges that made them are taken back, the last made first; of equal ranks the right one was made last.
        A merge over the border comes first if its rank is less than that of the merge taken back, or
        equal to it where it stands to the left of it.
        """
        rank, halves, pairs = self.rank, self.halves, self.pairs
        while True:
            crossing = pairs.get((left, right))
            if crossing is not None and crossing < until:
                return False
            if rank[left] > rank[right]:
                until, left = rank[left], halves[left][1]
            elif rank[right] >= 0:
                until, right = rank[right] + 1, halves[right][0]
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are."""
        key = left << 32 | right
        known = self.kept.get(key)
        if known is None:
            if len(self.kept) > 4 * MAX_KEPT:
                self.kept.clear()
            known = self.kept[key] = self._apart(left, right)
        return known


class Trie:
    """Distinct words as a trie that lies in depth-first order: each word with the number of bytes that it shares with the one before."""

    def __init__(self, words: Iterable[bytes]):
        self.words = sorted(words)
        self.shared = [0] * len(self.words)
        before = b""
        for i, word in enumerate(self.words):
            k, most = 0, min(len(word), len(before)) - 1  # the last byte carries the end mark and is nobody's prefix
            while k < most and word[k] == before[k]:
                k += 1
            self.shared[i], before = max(k, 0), word

    def encoded(self, merges: Merges) -> Iterator[tuple[bytes, tuple[int, ...]]]:
        """Each word with its ids: the last tokens of all prefixes on the way down, a shared prefix's once, lead to the next one's."""
        lasts: list[int] = []  # of the path from the root to where the walk is
        inner, final, length = merges.inner, merges.final, merges.length
        for word, shared in zip(self.words, self.shared):
            del lasts[shared:]
            end = len(word)
            for n in range(len(lasts) + 1, end):
                lasts.append(_last(word, n, lasts, merges, inner))
            token = _last(word, end, lasts, merges, final)
            start = end - length[token]
            if not start:
                yield word, (token,)
                continue
            ids = [token]
            while start:
                token = lasts[start - 1]
                ids.append(token)
                start -= length[token]
            ids.reverse()
            yield word, tuple(ids)


def _last(word: bytes, n: int, lasts: list[int], merges: Merges, tokens: dict[bytes, int]) -> int:
    """The last token of a word's first n bytes, given the last tokens of all that they start with; longer ones are tried first."""
    ending, start = [], n
    while start:
        start -= 1
        token = tokens.get(word[start:n])
        if token is None:
            break
        if token >= 0:
            ending.append((start, token))
    kept = merges.kept
    for start, token in reversed(ending):
        if not start:
            return token
        known = kept.get(lasts[start - 1] << 32 | token)
        if known or known is None and merges.fits(lasts[start - 1], token):
            return token
    raise ValueError("no token ends here")


class WordCodec:
    """Whole texts to ids and back, block by block."""

    def __init__(self, vocabulary: dict):
        vocab, special = vocabulary["vocab"], vocabulary["special"]
        self.merges = Merges(vocab, vocabulary["merges"], vocabulary["mark"])
        self.names = [""] * (max([*vocab.values(), *special.values()]) + 1)
        for name, token in chain(vocab.items(), special.items()):
            self.names[token] = name
        self.special = special
        self.apart = re.compile("(%s)" % "|".join(map(re.escape, sorted(special, key=len, reverse=True)))).split if special else lambda text: [text]
        spaces = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace() and not "\x1c" <= c <= "\x1f")
        self.spaces = re.compile(f"[{spaces}]")
        letters, numbers = character_class("L"), character_class("N")
        self.pieces = re.compile("|".join(CONTRACTIONS) + f"|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+").findall
        self.words: dict[str, tuple[int, ...]] = {}
        self.runs: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def normal(text: str) -> str:
        """Composed and in lower case, each character on its own; young capitals are left to _learn."""
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()  # a sigma doesn't look at its neighbours

    def _stretches(self, text: str) -> Iterator[list[str]]:
        """Runs of what isn't white space, as far as a bounded stretch of the text goes."""
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")  # white space to Python only
        at = 0
        while at < len(text):
            space = self.spaces.search(text, at + STRETCH_CHARS) if len(text) - at > STRETCH_CHARS else None
            cut = space.start() if space else len(text)
            part = text[at:cut] if at or space else text
            yield [run for run in self.spaces.split(part) if run] if odd else part.split()
            at = cut

    def _learn(self, runs: Iterable[str]) -> None:
        """Encodes the words of new runs along one trie."""
        if len(self.runs) > MAX_KEPT or len(self.words) > MAX_KEPT:
            self.runs.clear()
            self.words.clear()
        collected = gc.isenabled()
        gc.disable()  # nothing here forms cycles, and looking for them takes a third of the time
        try:
            found = {run: self.pieces(run if run.isascii() else run.translate(_LOWER)) for run in runs}
            known, kept = self.words, self.runs
            new = set(chain.from_iterable(found.values())) - known.keys()
            for spelled, ids in Trie([word.encode("utf-8") for word in new]).encoded(self.merges):
                known[spelled.decode("utf-8")] = ids
            for run, words in found.items():
                kept[run] = known[words[0]] if len(words) == 1 else tuple(chain.from_iterable(map(known.__getitem__, words)))
        finally:
            if collected:
                gc.enable()

    def encode(self, texts: list[str]) -> Iterator[Iterator[list[int]]]:
        """For each text its ids in stretches. The new words of all short texts go into one trie."""
        split = [[(part, self.special.get(part)) if k % 2 else (self.normal(part), None) for k, part in enumerate(self.apart(text))] for text in texts]
        short = {run for parts, text in zip(split, texts) if len(text) <= STRETCH_CHARS for part, token in parts if token is None for runs in self._stretches(part) for run in runs}
        new = short - self.runs.keys()
        if new:
            self._learn(new if len(self.runs) <= MAX_KEPT else short)
        return map(self._ids, split)

    def _ids(self, parts: list[tuple[str, int | None]]) -> Iterator[list[int]]:
        for part, token in parts:
            if token is not None:
                yield [token]
                continue
            for runs in self._stretches(part):
                try:
                    yield list(chain.from_iterable(map(self.runs.__getitem__, runs)))
                except KeyError:
                    distinct = set(runs)
                    new = distinct - self.runs.keys()
                    self._learn(new if len(self.runs) <= MAX_KEPT else distinct)
                    yield list(chain.from_iterable(map(self.runs.__getitem__, runs)))

    def decode(self, ids: Iterable[int]) -> str:
        """The names of the tokens with spaces between, as for a vocabulary without a decoder of its own."""
        return " ".join(map(self.names.__getitem__, ids))


def encode_words(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row for each row of df: id, n_tokens, ids_sha256 (little-endian unsigned 32-bit ids), decoded_sha256, and with with_ids the ids and the decoded text.

    A null text counts as empty: no tokens and the hashes of nothing. Long texts are encoded whole, in
    stretches that end at white space; strings of special tokens in a text are those tokens; repeated rows
    and null ids are kept, ids exactly; other columns are left out, whatever their names; an empty table gives
    an empty result. The vocabulary is read on the driver and broadcast (it is bounded: one entry a token).
    """
    spark: SparkSession = df.sparkSession
    vocabulary, name = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path)), uuid.uuid4().hex
    adds = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"} | ({"ids": "array<int>", "decoded": "string"} if with_ids else {})

    def run(batches: Iterator) -> Iterator[tuple]:
        codec = per_worker(("words", name), lambda: WordCodec(vocabulary.value))
        for batch in batches:
            for block, texts in blocks_of(batch, "_text"):
                rows = [_digests(codec, parts, with_ids) for parts in codec.encode(texts)]
                yield block, dict(zip(adds, zip(*rows)))

    return mapped(df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text")), run, adds, keep=[id_col])


def _digests(codec: WordCodec, stretches: Iterator[list[int]], with_ids: bool) -> tuple:
    n, ids_sha, text_sha, kept, texts = 0, hashlib.sha256(), hashlib.sha256(), [], []
    for ids in stretches:
        if not ids:
            continue
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        decoded = codec.decode(ids) if n == 0 else " " + codec.decode(ids)
        ids_sha.update(packed.tobytes())
        text_sha.update(decoded.encode("utf-8"))
        n += len(ids)
        if with_ids:
            kept += ids
            texts.append(decoded)
    return (n, ids_sha.hexdigest(), text_sha.hexdigest(), *((kept, "".join(texts)) if with_ids else ()))


def blocks_of(batch, name: str, most: int = BLOCK_CHARS) -> Iterator[tuple]:
    """Slices of an Arrow batch with the values of a text column, each of a bounded number of characters or one row."""
    texts, start, held = values_of(batch, name), 0, 0
    for k, text in enumerate(texts):
        if k > start and held + len(text) > most:
            yield batch.slice(start, k - start), texts[start:k]
            start, held = k, 0
        held += len(text)
    if start < len(texts):
        yield batch.slice(start), texts[start:]
