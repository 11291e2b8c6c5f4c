"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

Encoding. The encoding of a prefix has one last token, and two tokens can stand side
by side exactly if undoing their merges, the latest first, never meets a merge
across the border that would have come earlier. That gives a nondeterministic
transducer: a hypothesis is the last token before some byte and the place in the
vocabulary's trie of the bytes since. Reading a byte moves every hypothesis; the one
that completes a compatible token starts a new one. Sets of hypotheses are the states
of the deterministic machine; states and moves are made when first needed, kept in
a bounded table, and found by one lookup a byte from then on. Each move puts out the
last token of the prefix read so far; the tokens on which all hypotheses rest are
final, and are emitted every ``LOOKAHEAD`` bytes and at the end.

Decoding. Ids become bytes; a state machine over UTF-8 byte classes emits characters as
soon as they are complete and one U+FFFD per ill-formed part, across chunks.

Defined results: null texts count as empty; empty texts have no ids; texts of any
length are encoded whole; repeated rows and equal texts are encoded alike; other
columns pass through. Unknown ids fail the decoding.
"""

from __future__ import annotations

import base64
import contextlib
import gc
import itertools
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

from weirline.llm.common import freeing
from weirline.llm.tokens import ChunkEncoder, spelled

NODE_BITS = 32  # a hypothesis is last + 1 above, its trie node below; 0 is the start
TOKEN_BITS = 24  # a move is the next state above, the last token below
NODE, TOKEN = (1 << NODE_BITS) - 1, (1 << TOKEN_BITS) - 1
ROWS_OUT = 1000  # that leave a task at a time, as ids and text are larger than what came in
LOOKAHEAD = 4096  # bytes of a piece that are read before its tokens are emitted


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Transducer:
    """Encodes pieces by ranks; ``ranks`` must hold every single byte."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 350_000):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.child: dict[int, int] = {}
        self.token_at, self.depth = [None], [0]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key, node_before = node << 8 | byte, node
                node = self.child.get(key, 0)
                if not node:
                    node = self.child[key] = len(self.token_at)
                    self.token_at.append(None)
                    self.depth.append(self.depth[node_before] + 1)
            self.token_at[node] = rank
        self._forget()

    def _forget(self):
        """A machine with the start state alone."""
        self.states: list[tuple[int, ...]] = [(0,)]
        self.number = {self.states[0]: 0}
        self.moves: dict[int, int] = {}
        self.fits.clear()

    def undo(self, token: int) -> tuple[int, int] | None:
        """The pair whose merge made a token; None for a single byte, and the token
        twice for one that no sequence of merges makes."""
        if token not in self.halves:
            parts = [self.ranks[bytes([b])] for b in self.bytes_of[token]]
            last = None
            while len(parts) > 1:
                best = min(
                    (
                        (rank, i)
                        for i in range(len(parts) - 1)
                        if (rank := self._join(parts[i], parts[i + 1])) is not None
                    ),
                    default=None,
                )
                if best is None:
                    break
                rank, i = best
                last = (parts[i], parts[i + 1])
                parts[i : i + 2] = [rank]
            self.halves[token] = last if parts == [token] else (token, token)
        return self.halves[token]

    def _join(self, left: int, right: int) -> int | None:
        return self.ranks.get(self.bytes_of[left] + self.bytes_of[right])

    def made(self, token: int) -> bool:
        return self.undo(token) != (token, token)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens' bytes encode to just these two."""
        if not self.made(right):
            return False
        if left < 0:
            return True
        key = (left, right)
        known = self.fits.get(key)
        if known is None:
            known = self.fits[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        """Undo merges from the latest back; before each, a merge across the border
        must not have been due. Of equal ranks the left one was merged first."""
        due = float("inf")  # merges across the border below this would have happened
        while True:
            across = self._join(left, right)
            if across is not None and across < due:
                return False
            left_parts, right_parts = self.undo(left), self.undo(right)
            if left_parts is None and right_parts is None:
                return True
            if right_parts is None or (left_parts is not None and left > right):
                due, left = left, left_parts[1]
            else:
                due, right = right + 0.5, right_parts[0]

    def _move(self, state: int, byte: int) -> int:
        """Next state, and the last token of the prefix up to this byte."""
        after, ended = [], None
        for hypothesis in self.states[state]:
            node = self.child.get((hypothesis & NODE) << 8 | byte)
            if node is None:
                continue
            last = hypothesis >> NODE_BITS
            after.append(last << NODE_BITS | node)
            token = self.token_at[node]
            if ended is None and token is not None and self.compatible(last - 1, token):
                ended = token
        after.append((ended + 1) << NODE_BITS)
        key = tuple(after)
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.states)
            self.states.append(key)
        found = self.moves[state << 8 | byte] = number << TOKEN_BITS | ended
        return found

    def _rest(self, last: list[int], end: int) -> tuple[list[int], list[int]]:
        """Tokens of ``last[:end]`` from the back, and the places where they start."""
        tokens, starts = [], []
        while end:
            token = last[end - 1]
            end -= len(self.bytes_of[token])
            tokens.append(token)
            starts.append(end)
        return tokens, starts

    def _settled(self, last: list[int], state: int) -> int:
        """The latest place at which every hypothesis has a border."""
        borders = None
        for hypothesis in self.states[state]:
            end = len(last) - self.depth[hypothesis & NODE]
            own = {end, *self._rest(last, end)[1]}
            borders = own if borders is None else borders & own
        return max(borders)

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is itself a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > self.max_states:
            self._forget()
        out, last, state, moves = [], [], 0, self.moves
        for byte in piece:
            found = moves.get(state << 8 | byte)
            if found is None:
                found = self._move(state, byte)
            state = found >> TOKEN_BITS
            last.append(found & TOKEN)
            if len(last) > 2 * LOOKAHEAD:
                settled = self._settled(last, state)
                out += self._rest(last, settled)[0][::-1]
                del last[:settled]
        out += self._rest(last, len(last))[0][::-1]
        return out


class Splitter:
    """Pieces of a text by a pattern, with the character classes of the encoding
    library's own, older Unicode tables: a character on which the two disagree is
    matched as a stand-in of its class there."""

    # A stand-in for letters, numbers, white space and all else.
    CLASSES = ((r"\p{L}", "\u01bb"), (r"\p{N}", "\u00bc"), (r"\s", "\u2003"), (".", "\u2022"))

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        bytewise = {bytes([b]): b for b in range(256)}
        self.tests = [
            (
                regex.compile(kind, regex.DOTALL),
                tiktoken.Encoding(
                    "class", pat_str=kind, mergeable_ranks=bytewise, special_tokens={}
                ),
                shown,
            )
            for kind, shown in self.CLASSES[:3]
        ]
        self.same = {chr(c) for c in range(128)}
        self.shown: dict[str, str] = {}

    def _check(self, characters: set[str]) -> bool:
        """Whether any of the characters needs its stand-in."""
        for c in characters - self.same - self.shown.keys():
            here = [bool(mine.match(c)) for mine, _, _ in self.tests]
            there = [bool(theirs.encode_ordinary(c)) for _, theirs, _ in self.tests]
            if here == there:
                self.same.add(c)
            else:
                kinds = [shown for (_, _, shown), yes in zip(self.tests, there, strict=True) if yes]
                self.shown[c] = (kinds or [self.CLASSES[3][1]])[0]
        return not characters <= self.same

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or not self._check(set(text)):
            return self.pattern.findall(text)
        seen = "".join(self.shown.get(c, c) for c in text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(seen)]


def packed(ids: list[int]) -> bytes:
    """Ids as unsigned little-endian 32-bit integers."""
    words = array("I", ids)
    if sys.byteorder == "big":
        words.byteswap()
    return words.tobytes()


def text_encoder(ranks: dict[bytes, int], pattern: str) -> ChunkEncoder:
    """Packed ids of whole texts; each match of ``pattern`` is encoded on its own."""
    machine, pieces = Transducer(ranks), Splitter(pattern)

    def encode(text: str) -> bytes:
        ids = []
        for piece in pieces(text):
            ids += machine.encode(piece.encode("utf-8", "replace"))
        return packed(ids)

    def keys(missing: pa.Array) -> pa.Array:
        return pa.array(map(encode, spelled(missing).to_pylist()), pa.binary())

    return ChunkEncoder(keys, encode)


def encode(text: Column, ranks_path: str, pattern: str) -> Column:
    """Ids of a text as packed little-endian unsigned 32-bit integers."""

    @F.pandas_udf("binary")
    @freeing
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = text_encoder(read_ranks(ranks_path), pattern)
        with uncollected():
            for texts in batches:
                yield pd.Series(list(encoder.each(pa.array(texts, pa.string()))), dtype=object)

    return encoded(text)


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """The machine's tables are very many small objects without cycles, which the cycle
    collector would walk again and again as they grow."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def _utf8_classes() -> tuple[np.ndarray, dict[tuple[int, int], int]]:
    """Byte classes and moves of the machine over well-formed UTF-8.

    State 0 is between characters; 1 to 3 want that many plain continuation bytes;
    4 to 7 want a first continuation byte of a narrower range (after E0, ED, F0, F4)."""
    kind = np.full(256, 11, np.int8)  # 11: never valid
    for number, (low, high) in enumerate(
        [(0x00, 0x7F), (0x80, 0x8F), (0x90, 0x9F), (0xA0, 0xBF), (0xC2, 0xDF), (0xE0, 0xE0),
         (0xE1, 0xEF), (0xED, 0xED), (0xF0, 0xF0), (0xF1, 0xF3), (0xF4, 0xF4)]
    ):
        kind[low : high + 1] = number
    moves = {(0, 0): 0, (0, 4): 1, (0, 5): 4, (0, 6): 2, (0, 7): 5, (0, 8): 6, (0, 9): 3, (0, 10): 7}
    for tail in (1, 2, 3):
        moves |= {(1, tail): 0, (2, tail): 1, (3, tail): 2}
    moves |= {(4, 3): 1, (5, 1): 1, (5, 2): 1, (6, 2): 2, (6, 3): 2, (7, 1): 2}
    return kind, moves


class Utf8Stream:
    """Incremental UTF-8: ``feed`` returns the characters that are complete."""

    KIND, MOVES = _utf8_classes()

    def __init__(self):
        self.state, self.held = 0, b""

    def feed(self, data: bytes) -> str:
        """Whole well-formed stretches are taken at once; the machine walks the rest."""
        if not self.held:
            keep = self._open_tail(data)
            body = data[: len(data) - keep]
            try:
                out = body.decode("utf-8")
            except UnicodeDecodeError:
                return self._walk(data)
            return out + (self._walk(data[len(body) :]) if keep else "")
        return self._walk(data)

    @staticmethod
    def _open_tail(data: bytes) -> int:
        """Length of the character that the end of ``data`` may have cut."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                return back
            if byte < 0x80:
                return 0
        return 0

    def _walk(self, data: bytes) -> str:
        out, i = [], 0
        while i < len(data):
            byte = data[i]
            after = self.MOVES.get((self.state, int(self.KIND[byte])))
            if after is None:
                out.append("�")
                again = self.state != 0  # this byte may start a character
                self.state, self.held = 0, b""
                i += 0 if again else 1
                continue
            self.held += bytes([byte])
            self.state = after
            if after == 0:
                out.append(self.held.decode("utf-8"))
                self.held = b""
            i += 1
        return "".join(out)

    def finish(self) -> str:
        left, self.state, self.held = self.held, 0, b""
        return "�" if left else ""


class Decoder:
    """Ids to text, in chunks of bounded size; ids beyond the vocabulary fail."""

    def __init__(self, ranks: dict[bytes, int], ids_per_chunk: int = 1 << 19):
        self.chunk = ids_per_chunk
        bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            bytes_of[rank] = token
        self.table = pa.array(bytes_of, pa.binary())

    def _bytes(self, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The tokens' bytes on end, and where each token starts and the last ends."""
        gathered = self.table.take(pa.array(ids))
        _, offsets, data = gathered.buffers()
        places = np.frombuffer(offsets, np.int32)[: len(ids) + 1]
        return memoryview(data) if data is not None else memoryview(b""), places

    def pieces(self, ids: np.ndarray) -> Iterable[str]:
        """Text of one stream of ids, a chunk at a time."""
        stream = Utf8Stream()
        for at in range(0, len(ids), self.chunk):
            yield stream.feed(bytes(self._bytes(ids[at : at + self.chunk])[0]))
        yield stream.finish()

    def each(self, packed: list[bytes]) -> Iterator[str]:
        """Text of each document's packed ids; short ones are gathered together."""
        held, size = [], 0
        for ids in packed:
            if held and size + len(ids) > self.chunk * 4:
                yield from self._group(held)
                held, size = [], 0
            held.append(ids)
            size += len(ids)
        yield from self._group(held)

    def _group(self, packed: list[bytes]) -> Iterator[str]:
        if len(packed) == 1:
            yield "".join(self.pieces(np.frombuffer(packed[0], "<u4")))
            return
        data, places = self._bytes(np.frombuffer(b"".join(packed), "<u4"))
        ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])])
        for a, b in itertools.pairwise(places[ends.astype(int)].tolist() if packed else []):
            stream = Utf8Stream()
            yield stream.feed(bytes(data[a:b])) + stream.finish()

    def __call__(self, packed: bytes) -> str:
        return next(self.each([packed]))


def decode(ids: Column, ranks_path: str) -> Column:
    """Text of packed ids."""

    @F.pandas_udf("string")
    @freeing
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(read_ranks(ranks_path))
        for some in batches:
            yield pd.Series(list(decoder.each([p or b"" for p in some])), dtype=object)

    return decoded(ids)


def round_trip(text: Column, ranks_path: str, pattern: str) -> Column:
    """Struct of ``ids`` (as by ``encode``) and ``decoded`` (as by ``decode``, from the
    ids alone), in one pass over the texts."""

    @F.pandas_udf("ids binary, decoded string")
    @freeing
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ranks = read_ranks(ranks_path)
        encoder, decoder = text_encoder(ranks, pattern), Decoder(ranks)
        with uncollected():
            for texts in batches:
                for at in range(0, len(texts), ROWS_OUT):
                    some = pa.array(texts.iloc[at : at + ROWS_OUT], pa.string())
                    ids = list(encoder.each(some))
                    yield pd.DataFrame({"ids": ids, "decoded": list(decoder.each(ids))})

    return coded(text)
