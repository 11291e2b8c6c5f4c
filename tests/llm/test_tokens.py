"""Both encoders against their libraries on texts with runs of white space."""

import random

import numpy as np
import public_tokenizers as tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from weirline.llm import bpe, packing, tokens

BYTE, MULTI = (tokenizers.path(f) for f in ("byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"))
ALPHABETS = [
    "ab  \n", "a\x1c\x1d\x1e\x1f \x85 b", "x　   y\r\n", "=-_/ \t\n", "the word, again.  \n\tdon't ",
    "abcdefghij klmnopqrstuvwxyzABC'.,!0123456789éß\n中😀",
]
CODE = '''def f(x):\n\tif x  ==  1:\n\t\treturn "a  b"\n\n    # done.\n\n\n'''


def texts():
    rng = random.Random(6)
    out = ["".join(rng.choices(rng.choice(ALPHABETS), k=rng.randrange(1, 70))) for _ in range(3000)]
    return [*out, None, "", "   ", "\n", CODE, CODE * 50, "a" * 400 + "  " + "b" * 400, " x" + CODE]


@pytest.mark.parametrize("batch", [1 << 24, 9])
def test_runs_of_white_space(batch, monkeypatch):
    monkeypatch.setattr(tokens, "BATCH_BYTES", batch)
    monkeypatch.setattr(tokens, "LONGEST_CACHED", 20)
    some = texts()
    plain = [t or "" for t in some]
    library = Tokenizer.from_file(BYTE)
    want = [e.ids for e in library.encode_batch_fast(plain, add_special_tokens=False)]
    found = packing._encoder(BYTE).each(pa.array(some, pa.string()))
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == want

    ranks = bpe.read_ranks(MULTI)
    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = bpe.text_encoder(ranks, tokenizers.PATTERN).each(pa.array(some, pa.string()))
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [library.encode_ordinary(t) for t in plain]


def test_words_around_a_run_come_from_the_table():
    asked = []
    encoder = packing._encoder(BYTE)
    keys, encoder.encode_keys = encoder.encode_keys, lambda k: asked.extend(k) or keys(k)
    lines = [f"    value{i % 7} = word{i % 11}\n\n" for i in range(300)]
    list(encoder.each(pa.array(["".join(lines)] * 3)))
    assert len(asked) < 60


def test_marks_and_lines_are_cut_without_a_call_a_word(monkeypatch):
    cut, parts = [], tokens._parts
    monkeypatch.setattr(tokens, "_parts", lambda word: cut.append(word) or parts(word))
    some = [f"One{i} two{i}, three.\nFour{i}. five{i}.\n\nSix, 7{i}. é{i}é." for i in range(50)]
    found = list(packing._encoder(BYTE).each(pa.array(some)))
    library = Tokenizer.from_file(BYTE)
    want = [e.ids for e in library.encode_batch_fast(some, add_special_tokens=False)]
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == want
    assert cut == [f"five{i}.\n\nSix," for i in range(50)]  # only these have an empty line


def test_parts_met_before_and_tables_that_overflow():
    rng = random.Random(7)
    words = ["ab", "ab.", "ab,", "ab.\nab,", "\nab.", "é.", "3.", "..", "x\ny", "x.\n", "a\u3000b.", "\t,"]
    some = [" ".join(rng.choices(words, k=rng.randrange(1, 9))) for _ in range(400)]
    library = Tokenizer.from_file(BYTE)
    want = [e.ids for e in library.encode_batch_fast(some, add_special_tokens=False)]
    for batch_bytes, most in [(1, 4), (60, 10), (60, 1000), (1 << 20, 4)]:
        encoder = packing._encoder(BYTE)
        encoder.batch_bytes, encoder.max_cached = batch_bytes, most
        found = encoder.each(pa.array(some))
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == want
