"""URL filter: host and path rules and glob rules, simulated together as one bit-parallel automaton."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, mapped, values_of

#: Stands between host and path in the canonical form; one in an url is read as U+FFFD.
BORDER = "￿"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class HostRule:
    """Fits its host and all subdomains when the path starts with its path."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def glob(self) -> list[str]:
        return ["*", *f".{self.host}{BORDER}{self.path}", "*"]


def host_glob(pattern: str) -> list[str]:
    """A glob over the whole host (* any run, ? any one character); any path fits."""
    return [".", *pattern, BORDER, "*"]  # the canonical form begins with a dot


class ShiftAnd:
    """Glob patterns over character lists, packed into the bits of several 64-bit words.

    Each element but `*` is one bit. A step shifts the bits, keeps those whose element takes the
    character, and keeps bits that a `*` follows. All rows of a batch advance together.
    """

    def __init__(self, patterns: Sequence[Sequence[str]]):
        bits = [[c for c in p if c != "*"] for p in patterns]
        if not all(bits):
            raise ValueError("a pattern needs more than stars")
        n = sum(map(len, bits))
        self.words = -(-n // 64)
        chars = sorted({c for p in bits for c in p} - {"?"})
        self.codes = np.array([ord(c) for c in chars], np.uint32)
        takes = np.zeros((len(chars) + 1, self.words), np.uint64)  # row 0: any other character
        first, always, start, loop = (np.zeros(self.words, np.uint64) for _ in range(4))
        self.ends: list[tuple[int, np.uint64]] = []
        at = 0
        for p in patterns:
            star, new = False, True
            for c in p:
                if c == "*":
                    if not new:
                        loop[(at - 1) // 64] |= np.uint64(1 << ((at - 1) % 64))
                    star = True
                    continue
                word, bit = at // 64, np.uint64(1 << (at % 64))
                if new:
                    first[word] |= bit
                    (always if star else start)[word] |= bit
                new = False
                for k in range(len(chars) + 1) if c == "?" else (chars.index(c) + 1,):
                    takes[k, word] |= bit
                at += 1
            self.ends.append(((at - 1) // 64, np.uint64(1 << ((at - 1) % 64))))
        self.takes, self.keep, self.always, self.start, self.loop = takes, ~first, always, start | always, loop

    def matches(self, texts: Sequence[str]) -> np.ndarray:
        """Rows by patterns: whether the whole text fits."""
        n = len(texts)
        state = np.zeros((n, self.words), np.uint64)
        lengths = np.fromiter(map(len, texts), np.int64, n)
        order = np.argsort(-lengths, kind="stable")
        begins = np.concatenate(([0], np.cumsum(lengths)))[:-1][order]
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        slot = np.searchsorted(self.codes, codes).clip(max=len(self.codes) - 1)
        kind = np.where(self.codes[slot] == codes, slot + 1, 0)
        alive = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")
        for t, m in enumerate(alive):
            now = state[:m]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            moved &= self.keep
            moved |= self.always if t else self.start
            moved &= self.takes[kind[begins[:m] + t]]
            moved |= now & self.loop
            state[:m] = moved
        out = np.zeros((n, len(self.ends)), bool)
        for k, (word, bit) in enumerate(self.ends):
            out[order, k] = (state[:, word] & bit) != 0
        return out


def judge_urls(df: DataFrame, rules: Sequence[HostRule], block_globs: Sequence[str], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row for each row of df: id, host, path, the longest host rule that fits, and a verdict.

    Where no host rule fits, the verdict is "block" if a glob over the host fits, else "allow". Null
    urls and those without "://" have an empty host and path, and so are allowed. Very long urls are
    read whole, one step a character for all rows of a batch together. Repeated rows and null ids are
    kept as they are, ids exactly; of rules as long the first by text wins; an empty table gives an
    empty result; other columns are left out, whatever their names.
    """
    by_length = sorted(rules, key=lambda r: (-len(r.text), r.text))
    automaton = ShiftAnd([*(r.glob() for r in by_length), *map(host_glob, block_globs)])
    names = [*(r.text for r in by_length), None]
    verdicts = [*(r.verdict for r in by_length), "allow", "block"]

    def judge(batches: Iterator) -> Iterator[tuple]:
        for batch in batches:
            texts = [f".{h}{BORDER}{p}" for h, p in zip(*[[x.replace(BORDER, "\ufffd") for x in values_of(batch, c)] for c in ("host", "path")])]
            hit = automaton.matches(texts)
            ruled, globbed = hit[:, : len(by_length)], hit[:, len(by_length) :].any(axis=1)
            best = np.where(ruled.any(axis=1), ruled.argmax(axis=1) if by_length else 0, len(by_length))
            yield batch, {"rule": [names[k] for k in best], "verdict": [verdicts[k] for k in best + ((best == len(by_length)) & globbed)]}

    url = F.col(url_col)
    parts = df.select(
        F.col(id_col),
        ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit(""))).alias("host"),
        F.coalesce(F.regexp_extract(url, _URL, 2), F.lit("")).alias("path"),
    )
    return mapped(parts, judge, {"rule": "string", "verdict": "string"})
