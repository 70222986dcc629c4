"""Noisy-channel deobfuscation: a lattice of what each character may stand for, decoded under a character model.

The channel writes letters as look-alike digits and signs, repeats them, and puts single letters apart.
A word in which no such thing can be seen has one path through its lattice, itself, and isn't decoded.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from itertools import product

import numpy as np

#: What look-alikes may stand for; fixed values.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "*": "aeiou", "#": "h", "&": "a", "%": "o",
}
#: Buckets of a trigram table at least; a table has several for each distinct trigram.
BUCKETS = 1 << 18
#: Natural-log costs of the channel: a sign read as a letter, a run of letters cut short, a border put between letters set apart.
SIGN_COST, RUN_COST, BORDER_COST = 1.0, 0.5, 3.0

#: A run of one sign that may stand for unlike letters has this many at most: no word has more such letters in a row.
MIXED_RUN = 3

_SIGNS = re.escape("".join(c for c in LOOK_ALIKES if not c.isdigit()))
_PIECE = re.compile(rf"[^\W_]+(?:[{_SIGNS}]{{1,2}}[^\W_]+)*")
_CORE = re.compile(r"^([\W_]*)(.*?)([\W_]*)$", re.S)
_PLAIN = re.compile(r"[^\W\d_]+")
_MARKS = ".,;:?\"'()"  # no letters are read into these at a word's edge
_EDGES = _MARKS + "!"
_RUN = re.compile(r"([^\W\d_])\1")
_LONG_RUN = re.compile(r"([^\W\d_])\1\1")


def slot(gram: str, buckets: int) -> int:
    """A bucket for a short string, the same in every process (FNV-1a over code points)."""
    h = 0xCBF29CE484222325
    for c in gram:
        h = ((h ^ ord(c)) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
    return (h ^ (h >> 32)) % buckets


def trigram_counts(words: Counter) -> Counter:
    """Counts of the trigrams, and of the bigrams before them (two letters and a null), of counted words with borders."""
    if not words:
        return Counter()
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 3
    codes = np.frombuffer("".join([f"^^{w}$" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ends = np.cumsum(sizes)
    inside = np.ones(len(codes), bool)
    inside[ends - 1] = inside[ends - 2] = False  # no trigram begins at a word's last two places
    at = np.flatnonzero(inside)
    grams, which = np.unique(codes[at] << 42 | codes[at + 1] << 21 | codes[at + 2], return_inverse=True)
    weights = np.repeat(np.fromiter(words.values(), np.int64, len(words)), sizes - 2)
    order = np.argsort(which, kind="stable")
    sums = np.add.reduceat(weights[order], np.searchsorted(which[order], np.arange(len(grams))))
    out: Counter = Counter()
    for gram, n in zip(grams.tolist(), sums.tolist()):
        a, b, c = chr(gram >> 42), chr(gram >> 21 & 0x1FFFFF), chr(gram & 0x1FFFFF)
        out[a + b + c] += n
        out[a + b + "\0"] += n
    return out


def trigram_table(grams: Iterable[tuple[str, int]], distinct: int) -> np.ndarray:
    """Counts by bucket, with eight buckets and more for each distinct trigram, so that few share one however large the corpus is."""
    table = np.zeros(max(BUCKETS, 1 << (8 * distinct - 1).bit_length() if distinct else 0), np.int64)
    for gram, n in grams:
        table[slot(gram, len(table))] += n
    return table


def letters(text: str) -> list[str]:
    """The plain words of a lower-case text: what the character model counts."""
    return _PLAIN.findall(text)


class Decoder:
    """Restores words by Viterbi search under a trigram model given as a table of counts by bucket."""

    def __init__(self, table: np.ndarray, alphabet: int = 64, keep: int = 100_000):
        self.table, self.alphabet, self.keep = table, alphabet, keep
        self.costs: dict[str, float] = {}
        self.known: dict[str, tuple[str, ...]] = {}

    def _cost(self, gram: str) -> float:
        cost = self.costs.get(gram)
        if cost is None:
            if len(self.costs) > self.keep:
                self.costs.clear()
            n, m = (0.0 if any(c.isdigit() for c in g) else float(self.table[slot(g, len(self.table))]) for g in (gram, gram[:2] + "\0"))  # counted words have no digits
            cost = self.costs[gram] = -math.log((n + 0.05) / (m + 0.05 * self.alphabet))
        return cost

    def decode(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The cheapest string; each place of the lattice has (letters, cost) choices, a space being a border.

        A state is the last two letters, so a place has no more states than the last two places have pairs of
        choices, whatever the length; none is left out. Of paths that cost the same the first by choice stays.
        """
        paths: dict[str, tuple[float, tuple]] = {"^^": (0.0, ())}  # of each its cost, and its letters as (what was before, letters)
        costs = self.costs
        for place in lattice:
            best: dict[str, tuple[float, tuple]] = {}
            for context, (cost, done) in paths.items():
                for chars, extra in place:
                    if len(chars) == 1 and chars != " ":
                        gram = context + chars
                        step = costs.get(gram)
                        total, now = cost + extra + (self._cost(gram) if step is None else step), gram[1:]
                    else:
                        total, now = cost + extra, context
                        for c in chars:
                            if c == " ":
                                total += self._cost(now + "$")
                                now = "^^"
                            else:
                                total += self._cost(now + c)
                                now = now[1] + c
                    known = best.get(now)
                    if known is None or total < known[0]:
                        best[now] = (total, (done, chars))
            paths = best
        done, out = min((cost + self._cost(context + "$"), context, done) for context, (cost, done) in paths.items())[2], []
        while done:
            done, chars = done
            out.append(chars)
        return "".join(reversed(out))

    def _places(self, word: str) -> list[list[tuple[str, float]]]:
        lattice, i = [], 0
        while i < len(word):
            c, j = word[i], i
            while j < len(word) and word[j] == c:
                j += 1
            stands = [(x, SIGN_COST) for x in LOOK_ALIKES.get(c, "")] or [(c, 0.0)]
            if c.isdigit():
                stands.append((c, 0.0))
            run = j - i
            if run >= 2:
                choices = [(x * k, cost + RUN_COST * (k != run)) for x, cost in stands if x != c or not c.isdigit() for k in (1, 2)]
                if c.isdigit():
                    choices.append((c * run, 0.0))  # digits are never shortened as such
                    if 1 < len(LOOK_ALIKES[c]) and run <= MIXED_RUN:  # unlike letters may stand side by side
                        choices += [("".join(x), SIGN_COST) for x in product(LOOK_ALIKES[c], repeat=run) if len(set(x)) > 1]
                lattice.append(choices)
            else:
                lattice += [stands] * run
            i = j
        return lattice

    def restore(self, word: str) -> tuple[str, ...]:
        """What a lower-case word may have been before the channel, as words."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > self.keep:
                self.known.clear()
            if word.isdigit() or word.isalpha() and not _RUN.search(word):
                found = (word,)
            else:
                found = (self.decode(self._places(word)),)
                if found[0] != word and word.isalpha() and not _LONG_RUN.search(word):
                    found += (word,)  # letters are doubled in plain words too
            self.known[word] = found
        return found

    def apart(self, text: str) -> tuple[str, ...]:
        """What a run of single letters set apart spells: words again."""
        found = self.known.get(text)
        if found is None:
            chars = [c for c in text if c.isalnum() or c in LOOK_ALIKES and c not in "*"]
            lattice: list[list[tuple[str, float]]] = []
            for k, c in enumerate(chars):
                if k:
                    lattice.append([("", 0.0), (" ", BORDER_COST)])
                lattice.append([(x, SIGN_COST) for x in LOOK_ALIKES.get(c, "")] or [(c, 0.0)])
            spelled = self.decode(lattice).split(" ")
            found = (*spelled, "".join(spelled)) if len(spelled) > 1 else tuple(spelled)
            if len(self.known) > self.keep:
                self.known.clear()
            self.known[text] = found
        return found

    def token(self, token: str) -> tuple[str, ...]:
        """The restored words of what stands between white space, in lower case."""
        plain = token.strip(_MARKS)
        if plain.isalpha() and not _RUN.search(plain):
            return (plain,)
        lead, core, trail = _CORE.match(token).groups()
        pieces = _PIECE.findall(core)
        if len(pieces) >= 3 and all(len(x) == 1 for x in pieces) and not core.isdigit():
            return self.apart(core)
        out = [w for x in pieces for w in self.restore(x)]
        if len(pieces) == 1:  # a sign at an edge may be a letter too
            edge = lead[-1:] if lead.strip("\"'([{") in ("$", "@", "!", "|") else ""
            end = trail if trail in ("$", "$$", "@") else ""
            if edge or end:
                out += self.restore(edge + core + end)
        return tuple(out)

    def words(self, text: str) -> set[str]:
        """The distinct restored words of a whole text."""
        out: set[str] = set()
        tokens = text.lower().split()
        for token in set(tokens):
            out.update(self.token(token))
        for run in runs_apart(tokens):
            out.update(self.apart(run))
        return out


def runs_apart(tokens: list[str]) -> set[str]:
    """The runs of three and more tokens of one character, not counting marks at their edges; in lower case."""
    single = {}
    for token in {t for t in set(tokens) if len(t) == 1 or len(t.strip(_EDGES)) == 1}:
        single[token] = (token.strip(_EDGES) or token).lower()
    if len(single) == 0:
        return set()
    has = bytes(map(single.__contains__, tokens))
    return {" ".join(map(single.__getitem__, tokens[m.start() : m.end()])) for m in re.finditer(rb"\x01{3,}", has)}
