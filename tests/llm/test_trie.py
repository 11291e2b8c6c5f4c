import random
import zlib
from hashlib import sha256

import pytest
from cases import DATA
from pyspark.sql import functions as F

from weirline.llm import trie as T
from weirline.llm import timeforward
from weirline.llm.queries import op13_prefix_trie

SF = str(DATA).replace("0.001", "0.01")
TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """From (conv_id, turn, role, text)."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        paths[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        own_share = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own_share + sum(saved[b] for b in below)
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            len(children.get(node, [])), leaves[node], saved[node], sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(df):
    assert df.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    ]
    return sorted((tuple(r) for r in df.collect()), key=str)


def shared(n, seed, longest=12, kinds=2):
    """Conversations out of few different turns, so that prefixes are shared."""
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-n, 2 * n), n):
        for turn in range(rng.randrange(1, longest)):
            rows.append((c, turn, rng.choice(["user", None, ""]), rng.choice(["é" * k for k in range(kinds)] + [None])))
    return rows


def build(spark, rows, **options):
    turns = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in ("key", "shard", "place")})
    return T.build(T.spliced(T.cut(T.steps(turns))), **options)


@pytest.mark.parametrize("limits", [{}, {"min_members": 1}, {"min_members": 5, "max_heavy": 30}])
def test_shared_prefixes(spark, limits):
    rows = shared(150, 5)
    assert found(build(spark, rows, **limits)) == brute(rows)


def test_ties_nulls_repeats_and_turnless(spark):
    rows = [
        (1, None, "user", "b"), (1, None, "user", "a"), (1, 0, None, None), (1, 0, None, None),
        (0, 3, "a", "x"), (0, 3, "a", "x"), (0, 1, "", "é"), (None, 1, "user", "lost"),
        (-3, 0, "user", "x"), (-5, 0, "u", "sera"), (-5, 1, "us", "era"), (7, 0, "user", "x"),
        *((c, 0, "user", "only") for c in range(20, 40)),
    ]
    want = brute(rows)
    assert found(build(spark, rows)) == want == found(build(spark, rows, min_members=2))
    assert any(d == 0 and e != sha256(b"").hexdigest() for _, d, *_, e in want)


def test_empty_table(spark):
    assert build(spark, []).collect() == []


def test_long_and_repeated_conversations(spark, monkeypatch):
    rows = [(10, t, "user", str(t)) for t in range(700)]
    rows += [(11 + 5 * c, t, "user", f"same {t}") for c in range(300) for t in range(12)]
    rows += [(10 + 5 * c, t, "user", "first" if t == 0 else f"{c} {t}") for c in range(1, 300) for t in range(3)]
    monkeypatch.setattr(T, "IDS", 7)
    want = brute(rows)
    assert found(build(spark, rows, min_members=20)) == want


def test_sweep_with_a_spilling_queue(spark, monkeypatch):
    rows = shared(200, 9, kinds=4)
    monkeypatch.setattr(T, "MessageQueue", lambda: timeforward.MessageQueue(4))
    assert found(build(spark, rows, min_members=10**6)) == brute(rows)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op13_prefix_trie(spark, SF)) == brute(rows)
