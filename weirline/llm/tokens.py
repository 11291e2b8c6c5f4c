"""Token ids of whole texts, a batch at a time.

The public splitting pattern never joins anything to a space that is followed by a
non-space: a new piece starts there. Texts are therefore split at spaces, the words of
a batch made unique and looked up in a bounded table of words met lately, and their ids
gathered in the order of the texts; all of that is Arrow's. Only words that are not in
the table reach the tokenizer, so cost follows the number of different words of a task.

A word that a run of white space follows is cut, together with the run, where the
pattern cuts: a run but for its last character is a piece, and the last goes with the
word behind it if it is a space. The parts behind a space are looked up in the same
table, the others in one of their own; the words around are not affected.

Of a new word with line breaks or a mark behind its letters only the parts are looked up
and encoded; those words are cut and joined by Arrow too, but for the few with other white
space or empty lines.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MARKS = ".,"
MARKED = r"\p{L}[.,]$"
# White space of the pattern (Unicode's White_Space; fixed values), the line break apart.
NO_BREAK = (
    r"\t\v-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WHITE = rf"\n{NO_BREAK}"
RUN = rf"^([{WHITE}]|$)"
BEHIND_SPACE = rf"^ [^{WHITE}]"
_WHITE = re.sub(r"x\{(\w+)\}", lambda m: "u" + m[1].zfill(4), WHITE)
CHUNK = re.compile(rf" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]")
ANY_WHITE = re.compile(f"[{_WHITE}]")
ODD = rf"[{NO_BREAK}]|\n\n|\n$"  # a word whose parts are not simply its lines
NOTHING = pa.array([b""], pa.binary())
LONGEST_CACHED = 256  # characters of a text that is kept
BATCH_BYTES = 1 << 24  # of text that is split at a time
WORD_BYTES = 4  # ids are unsigned, little-endian, 32 bits


def spelled(keys: pa.Array) -> pa.Array:
    behind_space = pc.binary_join_element_wise(" ", keys, "")
    return pc.if_else(pc.starts_with(keys, "\n"), keys, behind_space)


def _parts(word: str) -> list[tuple[list[str], str, bool, str]]:
    """What an odd word consists of: white space on its own, a key, whether the line break of
    the key is not in the word, and the mark behind it (the pattern parts a mark from the
    letters before it)."""
    out, white = [], []
    for piece in CHUNK.findall(word):
        if ANY_WHITE.match(piece):
            white.append(piece)
        elif not out:
            out.append((white, *_marked(piece, False)))
            white = []
        else:
            own = white == ["\n"]
            out.append(([] if own else white, *_marked(f"\n{piece}", not own)))
            white = []
    return [*out, (white, "", False, "")] if white else out


def _marked(key: str, bare: bool) -> tuple[str, bool, str]:
    if key[-1] in MARKS and key[-2:-1].isalpha():
        return key[:-1], bare, key[-1]
    return key, bare, ""


class ChunkEncoder:
    """``encode_keys(keys)`` gives the packed ids of each key (binary), ``encode_text(text)``
    those of any text on its own. A key is a word as it stands behind a space, or, if it
    starts with a line break, behind that; ``spelled`` gives the keys' texts."""

    def __init__(
        self,
        encode_keys: Callable[[pa.Array], pa.Array],
        encode_text: Callable[[str], bytes],
        max_cached: int = 1_500_000,
        batch_bytes: int = BATCH_BYTES,
    ):
        self.batch_bytes = batch_bytes
        self.encode_keys, self.encode_text, self.max_cached = encode_keys, encode_text, max_cached
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.binary())
        self.texts: dict[str, bytes] = {}  # ids of first words and of marks

    def __call__(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        return next(self.each(pa.array([text])))

    def each(self, texts: pa.Array) -> Iterator[bytes]:
        """Packed ids of each text; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(texts):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + self.batch_bytes)))
            yield from self._batch(texts.slice(start, stop - start))
            start = stop

    def _batch(self, texts: pa.Array) -> Iterator[bytes]:
        split = pc.split_pattern(texts, " ")
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
        flat = split.flatten()
        firsts = flat.take(pa.array(bounds[:-1])).to_pylist()
        coded = flat.dictionary_encode()
        ids, runs = self._look_up(coded.dictionary)
        at = coded.indices.to_numpy().copy()
        at[bounds[:-1]] = len(ids)  # a first word has no space before it; see below
        here = np.flatnonzero(np.isin(at, runs)) if runs else np.zeros(0, np.int64)
        chunks, heads, starts = self._with_runs(flat, here, bounds)
        at[here] = len(ids)
        at[heads] = len(ids) + 1 + np.arange(len(heads))
        ends, data = _gathered(pa.concat_arrays([ids, NOTHING, chunks]), at, bounds)
        starts = set(starts)
        for i, first in enumerate(firsts):
            own = b"" if i in starts else self._text(first)
            yield own + bytes(data[ends[i] : ends[i + 1]])

    def _with_runs(
        self, words: pa.Array, runs: np.ndarray, bounds: np.ndarray
    ) -> tuple[pa.Array, np.ndarray, list[int]]:
        """Ids of the words that have runs of white space behind them, up to the next
        word, where those words are, and the texts that start with one."""
        if not len(runs):
            return NOTHING.slice(1), runs, []
        heads = runs[np.diff(runs, prepend=-2) != 1] - 1
        parts = np.union1d(heads, runs)
        strings = words.take(pa.array(parts)).to_pylist()
        cuts = [*np.searchsorted(parts, heads).tolist(), len(parts)]
        of = np.searchsorted(bounds, heads, "right") - 1
        first = bounds[of] == heads
        joined = [" ".join(strings[a:b]) for a, b in pairwise(cuts)]
        texts = [t if alone else f" {t}" for t, alone in zip(joined, first.tolist(), strict=True)]
        different = list(dict.fromkeys(texts))
        ids = dict(zip(different, self._chunks(different), strict=True))
        return pa.array([ids[t] for t in texts], pa.binary()), heads, of[first].tolist()

    def _text(self, text: str) -> bytes:
        """Ids of a short text on its own."""
        if not text:
            return b""
        if len(text) > LONGEST_CACHED:
            return self.encode_text(text)
        if text not in self.texts:
            if len(self.texts) > self.max_cached // 8:
                self.texts.clear()
            self.texts[text] = self.encode_text(text)
        return self.texts[text]

    def _look_up(self, words: pa.Array) -> tuple[pa.Array, list[int]]:
        """Ids of different words, and the places of those that belong to a run of white
        space (no ids): empty ones and those that start with white space."""
        at = pc.index_in(words, value_set=self.words)
        absent = pc.is_null(at)
        run = pc.match_substring_regex(words, RUN)  # a key of the table may look like one
        absent = pc.and_not(absent, run)
        odd = pc.and_(absent, pc.match_substring_regex(words, ODD))
        lined = pc.and_not(absent, odd)
        lined = pc.and_(lined, pc.match_substring_regex(words, rf"\n|{MARKED}"))
        masks = [pc.and_not(pc.and_not(absent, odd), lined), lined, odd]
        new = [words.filter(mask) for mask in masks]
        new_ids = [self.encode_keys(new[0])]
        *joined_ids, keys, key_ids = self._encode(*new, new_ids[0])

        known = pa.concat_arrays([self.words, *new, keys])
        ids = pa.concat_arrays([self.ids, *new_ids, *joined_ids, key_ids, NOTHING])
        where = pc.fill_null(at, len(ids) - 1).to_numpy().copy()
        where[run.to_numpy(zero_copy_only=False)] = len(ids) - 1
        start = len(self.words)
        for mask, part in zip(masks, new, strict=True):
            where[mask.to_numpy(zero_copy_only=False)] = start + np.arange(len(part))
            start += len(part)
        out = ids.take(pa.array(where))
        if len(known) > self.max_cached:  # keep what was in use just now, if there is room
            used = np.zeros(len(ids), bool)
            used[where[: self.max_cached // 2]] = True
            used = pa.array(used[:-1])
            known, ids = known.filter(used), ids.slice(0, len(known)).filter(used)
        self.words, self.ids = known, ids.slice(0, len(known))
        return out, np.flatnonzero(run.to_numpy(zero_copy_only=False)).tolist()

    def _encode(
        self, simple: pa.Array, lined: pa.Array, odd: pa.Array, simple_ids: pa.Array
    ) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
        """Ids of words with line breaks or marks (``lined``, ``odd``), from those of their
        parts, which may be known; and the parts that were not, with theirs."""
        lines = pc.split_pattern(lined, "\n")
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lines).to_numpy())])
        first = np.zeros(bounds[-1], bool)
        first[bounds[:-1]] = True
        flat = lines.flatten()
        flat = pc.if_else(pa.array(first), flat, pc.binary_join_element_wise("\n", flat, ""))
        marked = pc.match_substring_regex(flat, MARKED)
        cut = pc.if_else(marked, pc.utf8_slice_codeunits(flat, 0, -1), flat)
        mark = pc.index_in(pc.utf8_slice_codeunits(flat, -1), value_set=pa.array([*MARKS]))
        mark = pc.if_else(marked, mark, len(MARKS))
        parts = [_parts(word) for word in odd.to_pylist()]
        odd_keys = list(dict.fromkeys(key for own in parts for _, key, _, _ in own if key))

        coded = pa.concat_arrays([cut, pa.array(odd_keys, pa.string())]).dictionary_encode()
        keys = coded.dictionary
        met = self.ids.take(pc.index_in(keys, value_set=self.words))
        met = pc.coalesce(met, simple_ids.take(pc.index_in(keys, value_set=simple)))
        unmet = pc.is_null(met)
        new = keys.filter(unmet)
        new_ids = self.encode_keys(new)
        ids = pc.replace_with_mask(met, unmet, new_ids).take(coded.indices)

        marks = pa.array([*map(self._text, MARKS), b""], pa.binary())
        whole = pc.binary_join_element_wise(ids.slice(0, len(flat)), marks.take(mark), b"")
        whole = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), whole)
        of_key = dict(zip(odd_keys, ids.slice(len(flat)).to_pylist(), strict=True)) | {"": b""}
        line_break = len(self._text("\n"))

        def joined(own: list[tuple[list[str], str, bool, str]]) -> bytes:
            out = []
            for white, key, bare, mark in own:
                out += map(self._text, white)
                out.append(of_key[key][line_break:] if bare else of_key[key])
                out.append(self._text(mark))
            return b"".join(out)

        return pc.binary_join(whole, b""), pa.array(map(joined, parts), pa.binary()), new, new_ids

    def _chunks(self, texts: list[str]) -> Iterator[bytes]:
        """Packed ids of texts with runs of white space, piece by piece."""
        found = [CHUNK.findall(text) for text in texts]
        bounds = np.concatenate([[0], np.cumsum([len(f) for f in found])])
        coded = pa.array(chain.from_iterable(found), pa.string()).dictionary_encode()
        behind = pc.match_substring_regex(coded.dictionary, BEHIND_SPACE)
        ids, _ = self._look_up(pc.utf8_slice_codeunits(coded.dictionary.filter(behind), 1))
        others = coded.dictionary.filter(pc.invert(behind)).to_pylist()
        behind = behind.to_numpy(zero_copy_only=False)
        where = np.where(behind, np.cumsum(behind) - 1, len(ids) + np.cumsum(~behind) - 1)
        own = pa.array([self._text(text) for text in others], pa.binary())
        ends, data = _gathered(
            pa.concat_arrays([ids, own]), where[coded.indices.to_numpy()], bounds
        )
        for a, b in pairwise(ends):
            yield bytes(data[a:b])


def _gathered(ids: pa.Array, at: np.ndarray, bounds: np.ndarray) -> tuple[list[int], memoryview]:
    """``ids`` in the order ``at``, on end, and where each of the ``bounds`` is in them."""
    gathered = ids.take(pa.array(at))
    _, offsets, data = gathered.buffers()
    ends = np.frombuffer(offsets, np.int32)[gathered.offset + bounds].tolist()
    return ends, memoryview(data) if data is not None else memoryview(b"")
