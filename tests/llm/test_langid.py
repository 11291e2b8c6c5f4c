import numpy as np
from cases import DATA, documents

from weirline.llm import langid, queries

SMALL = langid.Settings(dimensions=512)


def test_binding_and_bundling_by_hand():
    encoder = langid.Encoder(langid.Settings(dimensions=64, max_grams=3))
    text = "Ab, ça 12\nab!" * 7
    letters = langid.letter_classes(text)
    total = np.zeros(64)
    for a, b, c in zip(letters, letters[1:], letters[2:], strict=False):
        v = encoder.letters
        total += np.roll(v[a], 2) * np.roll(v[b], 1) * v[c]
    assert (encoder.vector(text) == total).all()


def test_long_texts_are_read_whole(monkeypatch):
    encoder = langid.Encoder(SMALL)
    text = "the quick brown fox jumps " * 200
    whole = encoder.vector(text)
    monkeypatch.setattr(langid, "SLICE", 97)
    assert np.allclose(encoder.vector(text), whole)


def test_awkward_texts(spark):
    texts = ["the cat and the dog", "le chat et le chien", None, "", "123 !?", "the dog", "the dog"]
    langs = ["en", "fr", "en", None, "en", None, "en"]
    docs = documents(spark, texts, langs=langs)
    profiles = langid.fit(docs, SMALL)
    assert profiles.names == ("en", "fr")
    rows = docs.select("doc_id", langid.predict(docs["text"], profiles).alias("f")).collect()
    found = {r.doc_id: r.f for r in rows}
    assert [found[i].lang_pred for i in range(7)] == ["en", "fr", "und", "und", "und", "en", "en"]
    assert found[2].score == 0 and 0 <= found[0].score <= 1
    assert found[5] == found[6]


def test_nothing_to_learn_from(spark):
    docs = documents(spark, ["the cat"], langs=[None])
    profiles = langid.fit(docs, SMALL)
    found = docs.select(langid.predict(docs["text"], profiles).alias("f")).first().f
    assert (found.lang_pred, found.score) == ("und", 0.0)
    empty = documents(spark, [])
    assert langid.fit(empty, SMALL).names == ()
    assert empty.select(langid.predict(empty["text"], profiles)).collect() == []


def test_held_out_accuracy(spark):
    found = queries.op4_language_id(spark, str(DATA)).toPandas()
    truth = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").toPandas()
    both = found.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert len(held) > 20 and (held.lang == held.lang_pred).mean() > 0.95


def test_numbers_are_no_letters(spark):
    texts = ["½ ②", "Ⅷ", "½ ab", "１２３", "ªº"]
    profiles = langid.fit(documents(spark, ["the cat sat", "le chat noir"], langs=["en", "fr"]))
    docs = documents(spark, texts)
    found = docs.select("doc_id", langid.predict(docs["text"], profiles).alias("p")).collect()
    assert {r.doc_id: r.p.lang_pred == "und" for r in found} == {0: True, 1: True, 2: False, 3: True, 4: False}


def test_many_ngrams_stay_within_the_table():
    import resource

    settings = langid.Settings(max_grams=1 << 12)
    rng = np.random.default_rng(5)
    text = "".join(map(chr, rng.integers(0x4E00, 0x9FFF, 1_000_000)))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    encoder = langid.Encoder(settings)
    vector = encoder.vector(text)
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 300
    assert len(encoder.vectors) == 1 << 12 and encoder.known <= 1 << 12

    part = text[:9000]
    codes = langid.letter_classes(part)
    codes = (codes[:-2] * langid.LETTERS + codes[1:-1]) * langid.LETTERS + codes[2:]
    plain = encoder.gram_vectors(codes).astype(float).sum(0)
    assert np.array_equal(encoder.vector(part), plain)
    assert np.array_equal(langid.Encoder(langid.Settings()).vector(part), plain)
    assert np.linalg.norm(vector) > 0
