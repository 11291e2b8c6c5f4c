import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import DATA, by_id, documents

from weirline.llm import weak_rules as W
from weirline.llm.queries import op11_quality_rules

COUNTS = [f.split()[0] for f in W.FEATURES.split(", ")]
SF = str(DATA).replace("0.001", "0.01")


def brute(text):
    """The counts, word by word and window by window."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            inside.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    earlier, dup = set(), 0
    for line in lines:
        dup += line in earlier
        earlier.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": dup,
        "n_repeat_words": len(inside),
        "n_lines": len(lines),
        "n_alnum": sum(c.isalnum() for c in text),
        "n_upper": sum(c.isupper() and c.isalnum() for c in text),
        "n_lower": sum(c.islower() and c.isalnum() for c in text),
        "n_shouts": sum(c in "!?" for c in text),
        "n_most": max(Counter(words).values(), default=0),
        "n_echoes": sum(a == b for a, b in zip(words, words[1:], strict=False)),
    }


def awkward():
    rng = random.Random(8)
    texts = [None, "", " \t\n\x0b\x0c\r", "one", "a " * 9, "a " * 8, "x y   z", "Ä#\r\n\r\nÄ#\n\nÄ#"]
    for size in (7, 8, 9, 15, 40, 300):
        for kinds in (1, 2, 5):
            texts.append(" ".join(rng.choice("abcde"[:kinds]) for _ in range(size)))
            texts.append("".join(rng.choice("aB \n\t#*!ẞ字½") for _ in range(size * 3)))
    block = " ".join(f"w{i}" for i in range(20))
    texts += [f"{block}\nfiller {block}", f"{block} {block} {block}", "line\nline\n line\nline"]
    return texts


def test_counts_equal_brute_force():
    kinds = W._kinds()
    for text in awkward():
        assert dict(zip(COUNTS, W.counts(text or "", kinds), strict=True)) == brute(text), repr(text)


def test_slices_cut_no_word(monkeypatch):
    kinds = W._kinds()
    whole = [W.counts(t or "", kinds) for t in awkward()]
    monkeypatch.setattr(W, "SLICE", 5)
    assert [W.counts(t or "", kinds) for t in awkward()] == whole
    assert W.counts("q" * 40, kinds)[0] == 1


def test_rows_through_spark(spark):
    texts = awkward()
    judged = by_id(W.judge(documents(spark, texts)))
    assert sorted(judged) == list(range(len(texts)))
    for i, text in enumerate(texts):
        row, want = judged[i], brute(text)
        assert {c: row[c] for c in COUNTS} == want
        n = want["n_words"]
        assert row.base_failed == (n < 20 or 100 * want["n_repeat_words"] > 30 * n)
        assert not (row.base_failed and row.kept)


def test_clashing_names_and_repeated_ids(spark):
    docs = documents(spark, ["good words here"] * 3).selectExpr(
        "cast(null as long) n_words", "'x' posterior", "text body", "5L key_id", "'y' kept"
    )
    found = W.judge(docs, id_col="key_id", text_col="body").collect()
    assert [r.doc_id for r in found] == [5, 5, 5] and {r.n_words for r in found} == {3}


def test_empty_table(spark):
    assert W.judge(documents(spark, [])).collect() == []


def test_estimate_equals_estimation_row_by_row():
    rng = np.random.default_rng(2)
    truth = rng.random(400) < 0.8
    cast = np.where(truth[:, None], 1, -1) * np.where(rng.random((400, 4)) < 0.85, 1, -1)
    cast[rng.random((400, 4)) < 0.3] = 0
    settings = W.Settings(rounds=25)
    patterns, numbers = np.unique(cast, axis=0, return_counts=True)
    model = W.estimate(patterns, numbers.astype(float), settings)

    good = [0.1 if -1 in row else 0.9 for row in cast.tolist()]
    for _ in range(25):
        weights = []
        for j in range(4):
            voted = [(g, row[j]) for g, row in zip(good, cast.tolist(), strict=True) if row[j]]
            assumed = 0.02 * len(voted) + 1
            right = sum(g for g, v in voted if v == 1) + 0.99 * assumed
            right /= sum(g for g, _ in voted) + assumed
            caught = sum(1 - g for g, v in voted if v == -1) + 0.3 * assumed
            caught /= sum(1 - g for g, _ in voted) + assumed
            weights.append((max(np.log(right / (1 - caught)), 0), min(np.log((1 - right) / caught), 0)))
        share = (sum(good) + 1) / (len(good) + 2)
        prior = np.log(share / (1 - share))
        odds = [prior + sum(w[0] if v == 1 else w[1] if v == -1 else 0 for w, v in zip(weights, row, strict=True))
                for row in cast.tolist()]
        good = [1 / (1 + np.exp(-o)) for o in odds]
    assert model.log_odds(cast) == pytest.approx(odds, abs=1e-6)
    assert ((model.log_odds(cast) > 0) == truth).mean() > 0.85


def test_votes_abstain_and_rule_bound(spark):
    rule = W.Rule("r", "n_words > 10", "n_words < 5")
    frame = spark.createDataFrame([(0,), (3,), (7,), (12,)], "n_words long")
    assert [r.v for r in frame.select(W.votes([rule])[0].alias("v")).collect()] == [0, -1, 0, 1]
    with pytest.raises(ValueError):
        W.fit(frame, [rule] * (W.MAX_RULES + 1))


def test_registered_query_against_labels(spark):
    found = op11_quality_rules(spark, SF).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    assert sorted(found.index) == sorted(docs.index)
    for doc, text in docs.text.items():
        want = brute(text)
        assert all(found.loc[doc, c] == want[c] for c in COUNTS[:5])
    both = found.join(spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id"), how="inner")
    good, bad = both[both.quality == 1], both[both.quality == 0]
    assert good[~good.base_failed].kept.mean() >= 0.995
    assert bad.kept.mean() <= 0.03
