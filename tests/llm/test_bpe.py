import hashlib
import random

import numpy as np
import public_tokenizers as tokenizers
import pytest
import tiktoken
from cases import DATA, documents

from weirline.llm import bpe, queries

PATH = tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [
    "", " ", "a  b", " a b ", "x\n y \n\n z", "don't  you're    x　 y", "\t\t a", " a\x1c b \x1cc",
    "日本語 テキスト です 한국어", "a" * 300, "😀😀 👩‍👩‍👧 é", "ab" * 20_000, "the" * 9000, "é" * 9000,
    "\U0001c978 \U00014fb4x ʼn՘", "<|endoftext|> a",
]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding(
        "own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def random_texts(n):
    rng = random.Random(2)
    alphabets = ["abcdefghij klmnopqrstuvwxyzABC'.,!0123456789éß\n中😀", "aeinrst ", "=-_/ \t\n"]
    return ["".join(rng.choices(rng.choice(alphabets), k=rng.randrange(1, 70))) for _ in range(n)]


def test_ids_are_the_librarys(ranks, library):
    encoder = bpe.text_encoder(ranks, tokenizers.PATTERN)
    for text in [*ODD, *random_texts(1500)]:
        assert np.frombuffer(encoder(text), "<u4").tolist() == library.encode_ordinary(text)


def test_small_tables_change_nothing(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "LOOKAHEAD", 40)
    encoder = bpe.text_encoder(ranks, tokenizers.PATTERN)
    encoder.max_cached = 5
    machine = bpe.Transducer(ranks, max_states=50)
    for text in [*ODD, *random_texts(150)]:
        want = library.encode_ordinary(text)
        assert np.frombuffer(encoder(text), "<u4").tolist() == want
        pieces = bpe.Splitter(tokenizers.PATTERN)(text)
        assert [i for p in pieces for i in machine.encode(p.encode())] == want


def naive(ranks, piece):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        pairs = [(ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        rank, i = min(pairs)
        if rank == 1 << 40:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_a_vocabulary_with_tokens_that_no_merges_make():
    ranks = {bytes([b]): b for b in range(256)}
    for token in (b"ab", b"bc", b"cd", b"abcd", b"abc", b"bcd", b"aa", b"aaaa", b"xyz"):
        ranks[token] = len(ranks)
    machine, rng = bpe.Transducer(ranks), random.Random(0)
    for _ in range(3000):
        piece = "".join(rng.choices("abcdxyz", k=rng.randrange(1, 12))).encode()
        want = [ranks[piece]] if piece in ranks else naive(ranks, piece)
        assert machine.encode(piece) == want


def test_streamed_utf8():
    rng = random.Random(5)
    for _ in range(4000):
        raw = bytes(
            rng.choice([rng.randrange(256), 0xE0, 0xED, 0xF0, 0xF4, 0x80, 0xA0, 0x9F, 0x41])
            for _ in range(rng.randrange(10))
        )
        cuts = sorted(rng.choices(range(len(raw) + 1), k=2))
        stream = bpe.Utf8Stream()
        parts = [raw[: cuts[0]], raw[cuts[0] : cuts[1]], raw[cuts[1] :]]
        text = "".join(map(stream.feed, parts)) + stream.finish()
        assert text == raw.decode("utf-8", "replace")


def test_columns_and_awkward_rows(spark):
    texts = [None, "", "One two.", "One two.", "é中😀", "word " * 30_000]
    docs = documents(spark, texts)
    coded = docs.select("doc_id", bpe.encode(docs["text"], PATH, tokenizers.PATTERN).alias("ids"))
    both = coded.select("doc_id", "ids", bpe.decode(coded["ids"], PATH).alias("back")).collect()
    assert {r.doc_id: r.back for r in both} == {i: t or "" for i, t in enumerate(texts)}
    assert bytes(both[0].ids) == b"" and both[2].ids == both[3].ids
    empty = documents(spark, [])
    assert empty.select(bpe.encode(empty["text"], PATH, tokenizers.PATTERN)).collect() == []


def test_whole_table(spark, library):
    found = {r.doc_id: r for r in queries.op9_byte_bpe(spark, str(DATA)).collect()}
    for doc in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        ids = np.array(library.encode_ordinary(doc.text), "<u4")
        row = found[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(doc.text.encode()).hexdigest()


def test_decoding_in_groups_and_chunks(ranks, library):
    texts = ["", "é中😀 " * 50, "one", "", "word " * 400, "\udcff".encode("utf-8", "replace").decode()]
    packed = [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in texts]
    for chunk in (1, 7, 100, 1 << 19):
        assert list(bpe.Decoder(ranks, chunk).each(packed)) == texts
    assert list(bpe.Decoder(ranks).each([])) == []
    with pytest.raises(IndexError):
        bpe.Decoder(ranks)(np.array([1 << 20], "<u4").tobytes())
