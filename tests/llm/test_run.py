"""``corpus_pipeline.run`` against a plain version of it. The scores of the two models are
taken from their operators; groups, cuts, tokens and places are worked out by brute force."""

from collections import Counter
from zlib import crc32

import numpy as np
from cases import DATA, DOCUMENT
from tokenizers import Tokenizer

import corpus_pipeline
from weirline.llm import langid, quality
from weirline.llm.common import held_out
from weirline.llm.simhash import fingerprint_of

PASSAGE = " ".join(f"{w} harbour of the quiet morning {i}" for i, w in enumerate(
    "stone river window garden market letter silver winter".split() * 2))


def planted(docs):
    """Exact and near copies, a passage in three texts, and rows with nothing in them."""
    longest = sorted((d for d in docs if d[1] and d[2] and 1500 < len(d[1]) < 6000), key=lambda d: d[0])
    first = max(d[0] for d in docs) + 1
    texts = []
    for doc in longest[:3]:
        texts += [doc[1], doc[1] + " word"]
    texts += [f"{d[1]}\n{PASSAGE}\n{d[1][::-1][:40]}" for d in longest[3:6]]
    texts += [None, "", "12 34", " ".join(f"é{i}" for i in range(30))]
    return [(first + i, t, None, None, len(t) if t else None) for i, t in enumerate(texts)]


def one_of_each(texts):
    """The smallest id of each group of fingerprints that link at two bits or fewer."""
    prints = {i: np.uint64(fingerprint_of(t) & (2**64 - 1)) for i, t in texts.items()}
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    group = list(range(len(ids)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for x in range(len(ids)):
        for y in np.nonzero(np.bitwise_count(values ^ values[x]) <= 2)[0].tolist():
            a, b = sorted((root(x), root(y)))
            group[b] = a
    return {ids[x] for x in range(len(ids)) if root(x) == x}


def without_repeats(texts, length=200):
    data = {i: (t or "").encode() for i, t in texts.items()}
    seen = Counter(hash(b[i : i + length]) for b in data.values() for i in range(len(b) - length + 1))
    kept = {}
    for doc, b in data.items():
        keep = bytearray(b"\1" * len(b))
        for i in range(len(b) - length + 1):
            if seen[hash(b[i : i + length])] > 1:
                keep[i : i + length] = bytes(length)
        kept[doc] = bytes(x for x, k in zip(b, keep, strict=True) if k).decode("utf-8", "ignore")
    return kept


def test_run_against_brute_force(spark, tmp_path):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars").collect()]
    docs += planted(docs)
    table = spark.createDataFrame(docs, DOCUMENT)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    texts = {d[0]: d[1] for d in docs}

    # 1 and 2: what the models say of each document, then thresholds in plain Python.
    model = quality.fit(table, labels.where(~held_out()))
    scores = {r.doc_id: r.s for r in table.select("doc_id", quality.score(table["text"], model).alias("s")).collect()}
    texts = {i: t for i, t in texts.items() if scores[i] >= 0.3}
    left = table.where(table["doc_id"].isin(list(texts)))
    profiles = langid.fit(left.where(~held_out()))
    said = {r.doc_id: r.found for r in left.select(
        "doc_id", langid.predict(left["text"], profiles).alias("found")).collect()}
    letters = {
        i: sum(len(w) for w in dict.fromkeys(
            "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()))
        for i, t in texts.items()
    }
    texts = {
        i: t for i, t in texts.items()
        if said[i].lang_pred != "und" and (said[i].score >= 0.2 or letters[i] < 160)
    }
    assert 0 < len(texts) < len(docs)

    # 3 and 4: groups over all pairs, windows over all places.
    chosen = one_of_each(texts)
    assert len(chosen) <= len(texts) - 5
    before = {i: texts[i] for i in chosen}
    kept = without_repeats(before)
    assert sum(kept[i] != before[i] for i in kept) >= 3
    assert not any(PASSAGE in t for t in kept.values())

    # 5: tokens by the tokenizer, and places that fill sequences without gaps.
    tokenizer = Tokenizer.from_file(corpus_pipeline.tokenizer_file(corpus_pipeline.BYTE_BPE))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        found.setdefault(r.doc_id, []).append(r)
    assert set(found) == set(kept)
    for doc, pieces in found.items():
        ids = [*tokenizer.encode(kept[doc], add_special_tokens=False).ids, 0]
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert pieces[0].start == 0 and pieces[-1].start + pieces[-1].length == len(ids), doc
        assert len(ids) > 2048 or len(pieces) == 1
        for p in pieces:
            assert p.piece == 0 or p.length == 2048 or len(ids) > 2048
            part = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            assert (p.length, p.ids_crc32) == (len(part) // 4, crc32(part)), doc
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048
    total = sum(r.length for r in rows)
    assert -(-total // 2048) <= len(sequences) <= -(-total // 2048) + 2
