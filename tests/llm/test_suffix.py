import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from cases import DATA, documents
from pyspark.sql import functions as F

from weirline.llm import queries, suffix


def brute(texts, length):
    """Covered bytes of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        covered = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                covered[p : p + length] = True
        out.append((d, covered))
    return out


def want(texts, length):
    rows = []
    for i, (data, covered) in enumerate(brute(texts, length)):
        kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
        spans = len(suffix.runs(covered))
        rows.append((i, len(data), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return rows


def random_texts(seed, n=60):
    """Texts made of shared, changed and periodic parts."""
    rng = random.Random(seed)
    parts = ["".join(rng.choices("ab é", k=rng.randrange(10, 90))) for _ in range(12)]
    texts = []
    for _ in range(n):
        own = []
        for _ in range(rng.randrange(0, 8)):
            part = rng.choice(parts)
            if rng.random() < 0.3:
                at = rng.randrange(len(part))
                part = part[:at] + rng.choice("xyz") + part[at + 1 :]
            if rng.random() < 0.1:
                part = rng.choice(["a", "ab", "abc"]) * rng.randrange(1, 60)
            own.append(part)
        texts.append("".join(own))
    return [*texts, None, "", texts[0], texts[0], texts[1]]


@pytest.mark.parametrize("seed,hot", [(0, 50_000), (1, 50_000), (2, 3)])
def test_against_brute_force(spark, monkeypatch, seed, hot):
    texts = random_texts(seed)
    settings = suffix.Settings(length=40, gram=9, batch_bytes=2000, hot=hot)
    if seed == 1:
        monkeypatch.setattr(suffix, "SLICE", 120)
    found = suffix.removed_bytes(documents(spark, texts), settings).collect()
    rows = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    assert rows == want(texts, 40)


def test_anchors_cover_every_window_once_and_follow_content():
    rng = np.random.default_rng(0)
    settings = suffix.Settings(length=50, gram=8)
    shared = rng.integers(97, 101, 300).astype(np.uint8)
    keys = []
    for _ in range(3):
        data = np.concatenate([rng.integers(97, 101, 71), shared, rng.integers(97, 101, 40)])
        data = data.astype(np.uint8)
        key, first, last = suffix.anchors(data, settings)
        assert first[0] == 0 and last[-1] == len(data) - 50 and (first[1:] == last[:-1] + 1).all()
        inside = (first >= 71) & (last <= 71 + 250)
        keys.append(set(key[inside].tolist()))
    assert set.intersection(*keys)


def test_hashes_depend_on_the_string_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 4, 400).astype(np.uint8)
    for gram in (1, 2, 7, 40):
        hashes = suffix.gram_hashes(data, gram)
        assert len(hashes) == len(data) - gram + 1
        by = {}
        for i, h in enumerate(hashes.tolist()):
            assert by.setdefault(data[i : i + gram].tobytes(), h) == h
        assert len(set(by.values())) == len(by)


def test_matching_statistics_against_brute_force():
    rng = random.Random(3)
    for _ in range(40):
        base = "".join(rng.choices("ab", k=60))
        stretches = []
        for _ in range(rng.randrange(2, 7)):
            a = rng.randrange(20)
            text = list(base[a : a + rng.randrange(14, 40)])
            text[rng.randrange(len(text))] = rng.choice("abc")
            stretches.append("".join(text).encode())
        stretches = list(dict.fromkeys(stretches))
        index = suffix.RunLengthIndex(stretches, 12)
        found = (index.statistics() >= 12).tolist()
        windows = [s[i : i + 12] for s in stretches for i in range(len(s) - 11)]
        count = Counter(windows)
        assert found == [count[w] > 1 for w in windows]
        assert len(index.heads) == len(index.tails) <= len(windows)


def test_awkward_rows(spark):
    long = "".join(random.Random(1).choices("abcdefgh ", k=300_000))
    texts = [None, "", "short", long, "x" + long[1000:1300] + "y", "é" * 400, "a" * 199, "a" * 199]
    found = suffix.removed_bytes(documents(spark, texts)).collect()
    rows = {r.doc_id: (r.n_removed, r.n_spans) for r in found}
    assert rows == {
        0: (0, 0), 1: (0, 0), 2: (0, 0), 3: (300, 1), 4: (300, 1), 5: (800, 1), 6: (0, 0), 7: (0, 0),
    }
    assert suffix.removed_bytes(documents(spark, [])).collect() == []


def test_remove_keeps_rows_and_columns(spark):
    passage = "the same passage in two texts " * 10
    docs = documents(spark, [f"one {passage} end", f"two {passage} fin", "alone", None])
    docs = docs.union(docs.where("doc_id = 2").withColumn("doc_id", F.lit(None).cast("long")))
    kept = suffix.remove(docs)
    assert kept.columns == docs.columns
    rows = sorted(((-1 if r.doc_id is None else r.doc_id), r.text) for r in kept.collect())
    assert rows == [(-1, "alone"), (0, "oneend"), (1, "twofin"), (2, "alone"), (3, None)]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.op10_suffix_dedup(spark, str(DATA)).collect()}
    for row in want([d.text for d in docs], 200):
        r = found[docs[row[0]].doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == row[1:]


def test_nothing_stays_in_the_catalog(spark):
    before = {t.name for t in spark.catalog.listTables()}
    passage = "".join(f"word{i} " for i in range(60))
    found = suffix.removed_bytes(documents(spark, [f"a {passage}", f"b {passage} c", "short"])).collect()
    assert sum(r.n_removed > 0 for r in found) == 2
    assert {t.name for t in spark.catalog.listTables()} == before
