"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

The rank file's merges define, for every prefix of a piece, one last token of its encoding. A new
last token must end at the new byte and be compatible with the last token at its own start: the two
alone must encode to themselves. A transducer state is the last token emitted plus the bytes not yet
emitted. Bytes stay pending only while some vocabulary token can still begin at one of their open
boundaries, so what lies before the boundary that all open ones share is emitted at once: the
lookahead is bounded by the longest vocabulary token. States and transitions are made on first use.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, per_worker, values_of

#: States and words that a worker keeps before it starts its tables afresh; results don't depend on them.
MAX_STATES, MAX_WORDS = 120_000, 250_000


NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken rank file: base64 token and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merged(piece: bytes, ranks: dict[bytes, int], below: int = NEVER) -> list[bytes]:
    """Plain merging by ranks under a bound, lowest first and leftmost on ties."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Transducer:
    """Byte strings to token ids, one state change a byte."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.open = {token[:i] for token in ranks for i in range(1, len(token))}
        self.sorted = sorted(ranks)
        self.split: dict[int, tuple[int, int] | None] = {}
        self.reset()

    def reset(self) -> None:
        self.number: dict[tuple, int] = {(-1, b"", ()): 0}
        self.states: list[tuple] = [(-1, b"", ())]
        self.moves: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]
        self.rests: list[tuple[int, ...] | None] = [()]
        self.pairs: dict[tuple[int, int], bool] = {}
        self.alive: dict[tuple[int, bytes], tuple[int, ...]] = {}
        self.lists: dict[tuple[int, ...], tuple[int, ...]] = {}

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one piece; a piece that is a token itself is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(self.states) > self.max_states or max(len(self.pairs), len(self.alive), len(self.lists)) > 8 * self.max_states:
            self.reset()
        out: list[int] = []
        at, moves = 0, self.moves
        for byte in piece:
            move = moves[at].get(byte)
            if move is None:
                move = moves[at][byte] = self._move(at, byte)
            at = move[0]
            if move[1]:
                out += move[1]
        rest = self.rests[at]
        if rest is None:
            rest = self.rests[at] = self._rest(at)
        return (*out, *rest)

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self.split:
            piece = self.tokens[token]
            parts = merged(piece, self.ranks, token) if len(piece) > 1 else []
            self.split[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.split[token]

    def _edge(self, left: int) -> list[tuple[int, int]]:
        """The tokens that end where this one does, from itself down to a byte, each with the rank of the merge that takes it up."""
        edge, until = [], NEVER
        while True:
            edge.append((left, until))
            halves = self._halves(left)
            if halves is None:
                return edge
            left, until = halves[1], left

    def _crossed(self, edge: list[tuple[int, int]], right: int, known: dict[int, int]) -> int:
        """When, in ranks, a merge first crosses the border between a token and one on its right, or NEVER.

        Merges run by rank, the left of two with equal ranks first. Before the right token is made,
        its left half stands at the border, so what crosses there crosses here too.
        """
        found = known.get(right)
        if found is not None:
            return found
        halves = self._halves(right)
        made = right if halves else -1
        found = self._crossed(edge, halves[0], known) if halves else NEVER
        if found > made:
            found, ranks, tokens = NEVER, self.ranks, self.tokens
            for left, until in edge:
                if until <= made:
                    break
                rank = ranks.get(tokens[left] + tokens[right])
                if rank is not None and rank < until:
                    found = min(found, max(rank, made, left if len(tokens[left]) > 1 else -1))
        known[right] = found
        return found

    def _fits(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side stay as they are."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.pairs[left, right] = self._crossed(self._edge(left), right, {}) == NEVER
        return known

    def _following(self, left: int, begun: bytes) -> tuple[int, ...]:
        """The longer tokens that start with these bytes and fit after a token."""
        listed = self.alive.get((left, begun))
        if listed is None:
            found, i, edge, known = [], bisect_right(self.sorted, begun), self._edge(left), {}
            while i < len(self.sorted) and self.sorted[i].startswith(begun):
                token = self.ranks[self.sorted[i]]
                if self._crossed(edge, token, known) == NEVER:
                    found.append(token)
                i += 1
            listed = self.alive[left, begun] = self.lists.setdefault(tuple(found), tuple(found))
        return listed

    def _lives(self, left: int, begun: bytes) -> bool:
        """Whether a longer token that starts with these bytes can follow; one byte counts as such without a look."""
        return begun in self.open and (left < 0 or len(begun) < 2 or bool(self._following(left, begun)))

    def _move(self, at: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The next state and what it emits.

        What a state knows of its left border is the token before it, or, from two pending bytes
        on, just which longer tokens can still begin there: far fewer states.
        """
        before, pending, lasts = self.states[at]
        listed = isinstance(before, tuple)
        pending, n = pending + bytes((byte,)), len(pending) + 1
        ranks = self.ranks
        for start in range(max(0, n - self.longest), n):
            token = ranks.get(pending[start:])
            if token is None:
                continue
            if start == 0:
                if token in before if listed else before < 0 or self._fits(before, token):
                    break
            elif (left := lasts[start - 1]) is not None and self._fits(left, token):
                break
        else:
            raise ValueError(f"no token ends in byte {byte}")
        lasts = (*lasts, token)
        if listed:
            before = tuple(t for t in before if len(self.tokens[t]) > n and self.tokens[t].startswith(pending))
        used, shared = set(), None
        for j in range(n, -1, -1):
            if j == n:
                alive = True
            elif j == 0:
                alive = bool(before) if listed else self._lives(before, pending)
            else:
                alive = lasts[j - 1] is not None and self._lives(lasts[j - 1], pending[j:])
            if alive:
                path, k = {j}, j
                while k:
                    k -= len(self.tokens[lasts[k - 1]])
                    path.add(k)
                used |= path
                shared = path if shared is None else shared & path
        border = max(shared)
        emitted, j = [], border
        while j:
            emitted.append(lasts[j - 1])
            j -= len(self.tokens[lasts[j - 1]])
        if border:
            before = lasts[border - 1]
        rest = pending[border:]
        if len(rest) > 1 and not isinstance(before, tuple) and before >= 0:
            before = self._following(before, rest) if rest in self.open else ()
        key = (before, rest, tuple([t if j in used else None for j, t in enumerate(lasts[border:], border + 1)]))
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            self.rests.append(None)
        return to, tuple(emitted[::-1])

    def _rest(self, at: int) -> tuple[int, ...]:
        _, pending, lasts = self.states[at]
        out, j = [], len(pending)
        while j:
            out.append(lasts[j - 1])
            j -= len(self.tokens[lasts[j - 1]])
        return tuple(out[::-1])


#: What the second byte after some leads may be (no overlong forms, surrogates, or code points over U+10FFFF); after others 80 to BF.
SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}


def utf8_table() -> tuple[list[list[int]], list[int]]:
    """States by byte and the bytes that each state still needs.

    State 0 is between characters; a state stands for a lead's kind and how many bytes are to come. A move of
    -1 is a byte that the state can't take.
    """
    kinds: dict[tuple[int, int, int], int] = {(0x00, 0x00, 0): 0}  # (least and greatest next byte, bytes needed)
    moves: list[list[int]] = [[-1] * 256]
    todo = []

    def state(low: int, high: int, need: int) -> int:
        if (low, high, need) not in kinds:
            kinds[low, high, need] = len(moves)
            moves.append([-1] * 256)
            todo.append((low, high, need))
        return kinds[low, high, need]

    for byte in range(256):
        if byte < 0x80:
            moves[0][byte] = 0
        elif 0xC2 <= byte <= 0xF4:
            moves[0][byte] = state(*SECOND.get(byte, (0x80, 0xBF)), 1 if byte < 0xE0 else 2 if byte < 0xF0 else 3)
    while todo:
        low, high, need = key = todo.pop()
        for byte in range(low, high + 1):
            moves[kinds[key]][byte] = state(0x80, 0xBF, need - 1) if need > 1 else 0
    return moves, [need for _, _, need in kinds]


class Utf8Stream:
    """Incremental UTF-8 by a table of states over bytes: feed bytes in any cut, get text as soon as its last byte is there.

    Held between calls are the state and the code point so far. Bytes that can't go on give one U+FFFD for each
    longest start of a character, as the Unicode standard recommends. ASCII leaves the machine where it is, so only
    runs of other bytes are stepped through, and what a run gives is kept for the next time.
    """

    MOVES, NEED = utf8_table()
    _OTHER = re.compile(rb"([\x80-\xff]+)")
    _known: dict[bytes, str] = {}

    def __init__(self):
        self.state, self.code = 0, 0

    def _steps(self, data: bytes) -> str:
        out, moves, state, code, at = [], self.MOVES, self.state, self.code, 0
        while at < len(data):
            byte = data[at]
            to = moves[state][byte]
            if to < 0:
                out.append("\ufffd")
                at += not state  # a byte that broke off a character is read again on its own
                state = code = 0
                continue
            code = code << 6 | byte & 0x3F if state else byte & (0x7F if byte < 0x80 else 0x1F if byte < 0xE0 else 0x0F if byte < 0xF0 else 0x07)
            state, at = to, at + 1
            if not state:
                out.append(chr(code))
                code = 0
        self.state, self.code = state, code
        return "".join(out)

    def _run(self, data: bytes) -> str:
        """What a run of bytes over 7F gives between ASCII, from state 0."""
        found = self._known.get(data)
        if found is None:
            if len(self._known) > 20_000:
                self._known.clear()
            found = self._known[data] = self._steps(data) + self.finish()
        return found

    def feed(self, data: bytes) -> str:
        head = ""
        if self.state:  # a character is begun: up to the next ASCII byte by steps
            cut = len(data) - len(data.lstrip(bytes(range(128, 256))))
            head, data = self._steps(data[: cut + 1]), data[cut + 1 :]
        parts = self._OTHER.split(data)
        tail = self._steps(parts.pop(-2)) if len(parts) > 1 and not parts[-1] else ""
        parts[1::2] = map(self._run, parts[1::2]) if not self.state else self._runs_apart(parts[1::2])
        parts[0::2] = [p.decode("ascii") for p in parts[0::2]]
        return head + "".join(parts) + tail

    def _runs_apart(self, runs: list[bytes]) -> list[str]:
        fresh = Utf8Stream()
        return [fresh._run(r) for r in runs]

    def finish(self) -> str:
        broken, self.state, self.code = self.state, 0, 0
        return "\ufffd" if broken else ""


class _Words(dict):
    """Ids by the word after a space, as far as memory is set aside for them."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= MAX_WORDS:
            self.clear()
        ids = self[word] = self.encode(f" {word}")
        return ids


class Codec:
    """Whole texts to ids and back.

    split_at_space says that the pattern always begins a new piece at a space before a character that is no
    white space, as the pattern of byte-level vocabularies does; words can then be looked up. A space
    before other white space, or at the end, is part of a run that the pattern takes together.
    """

    _RUN, _CUT = re.compile(r" (?:\s|\Z)").search, re.compile(r" (?=\S)").split

    def __init__(self, ranks: dict[bytes, int], pattern: str, split_at_space: bool = True):
        import regex

        self.split = regex.compile(pattern).findall
        self.transducer = Transducer(ranks)
        self.tokens = self.transducer.tokens
        self.split_at_space = split_at_space
        self.words = _Words(self._pieces)

    def _pieces(self, text: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(self.transducer.encode(piece.encode("utf-8")) for piece in self.split(text)))

    def encode(self, text: str) -> list[int]:
        first, *rest = [text] if not self.split_at_space else self._CUT(text) if self._RUN(text) else text.split(" ")
        ids = list(self._pieces(first))
        ids.extend(chain.from_iterable(map(self.words.__getitem__, rest)))
        return ids

    def decode_stream(self, ids: Iterable[int], step: int = 4096) -> Iterator[tuple[bytes, str]]:
        """Bytes and text of each run of ids; text lags where a character is not complete."""
        ids, utf8 = list(ids), Utf8Stream()
        for i in range(0, len(ids), step):
            data = b"".join(map(self.tokens.__getitem__, ids[i : i + step]))
            yield data, utf8.feed(data)
        yield b"", utf8.finish()


def encode_texts(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", split_at_space: bool = True, with_ids: bool = False) -> DataFrame:
    """One row for each row of df: id, n_tokens, ids_sha256, decoded_sha256, round_trip, and with with_ids the ids.

    A null text counts as empty: no tokens and the hashes of empty strings. Long texts are encoded
    whole, piece by piece; repeated rows and null ids are kept, ids exactly; other columns are left out,
    whatever their names; an empty table gives an empty result. The rank file is read on the driver and
    broadcast (a vocabulary is bounded: one entry a token).
    """
    spark: SparkSession = df.sparkSession
    ranks, name = spark.sparkContext.broadcast(read_ranks(ranks_path)), uuid.uuid4().hex

    def run(batches: Iterator) -> Iterator[tuple]:
        codec = per_worker(("codec", name, pattern, split_at_space), lambda: Codec(ranks.value, pattern, split_at_space))
        names = {rank: str(rank) for rank in codec.tokens}
        sha = hashlib.sha256
        for batch in batches:
            rows = []
            for text in values_of(batch, "_text"):
                ids = codec.encode(text)
                decoded, same, at = sha(), True, 0
                for data, piece in codec.decode_stream(ids):
                    decoded.update(data)
                    same &= text.startswith(piece, at)
                    at += len(piece)
                rows.append((len(ids), sha(" ".join(map(names.__getitem__, ids)).encode()).hexdigest(), decoded.hexdigest(), same and at == len(text), *([ids] if with_ids else [])))
            yield batch, dict(zip(adds, zip(*rows) if rows else [[]] * len(adds)))

    adds = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string", "round_trip": "boolean"} | ({"ids": "array<int>"} if with_ids else {})
    return mapped(df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text")), run, adds, keep=[id_col])
