import numpy as np
from cases import DATA, clash, documents

from weirline.llm import quality, queries

SMALL = quality.Settings(classes=1 << 10, dimensions=16, epochs=15, tasks=2)


def corpus(spark, n=120):
    rng = np.random.default_rng(1)
    good, bad = ["river", "stone", "house", "walk"], ["&&&", "win!!", "###", "click"]
    texts = [" ".join(rng.choice(bad if i % 4 == 0 else good, 30)) for i in range(n)]
    labels = spark.createDataFrame(
        [(i, int(i % 4 != 0), 0) for i in range(n)], "doc_id long, quality int, toxic int"
    )
    return documents(spark, texts), labels


def test_learns_and_scores_awkward_texts(spark):
    docs, labels = corpus(spark)
    model = quality.fit(docs, clash(labels), SMALL)
    scores = {
        r.doc_id: r.s for r in docs.select("doc_id", quality.score(docs["text"], model).alias("s")).collect()
    }
    assert np.mean([(s >= 0.5) == (i % 4 != 0) for i, s in scores.items()]) > 0.95
    odd = documents(spark, [None, "", "river stone " * 100_000, "river stone", "river stone"])
    found = {r.doc_id: r.s for r in odd.select("doc_id", quality.score(odd["text"], model).alias("s")).collect()}
    assert all(0 <= s <= 1 for s in found.values())
    assert found[0] == found[1] and found[3] == found[4]


def test_same_sample_same_model(spark):
    docs, labels = corpus(spark, 60)
    one, two = quality.fit(docs, labels, SMALL), quality.fit(docs.repartition(5), labels, SMALL)
    assert np.allclose(one.vectors, two.vectors, atol=1e-5)
    assert np.allclose(one.layers[0], two.layers[0], atol=1e-3)


def test_no_labels_and_null_labels(spark):
    docs, labels = corpus(spark, 8)
    none = quality.fit(docs, labels.selectExpr("doc_id", "cast(null as int) quality"), SMALL)
    assert {r.s for r in docs.select(quality.score(docs["text"], none).alias("s")).collect()} == {0.5}
    empty = documents(spark, [])
    assert empty.select(quality.score(empty["text"], none)).collect() == []


def test_slices_cover_a_text(monkeypatch):
    monkeypatch.setattr(quality, "SLICE", 10)
    text = "one two three four five " * 20 + "x" * 50
    assert "".join(quality.slices(text)) == text


def test_held_out_accuracy(spark):
    sf = str(DATA).replace("0.001", "0.01")
    found = queries.op2_quality_classifier(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    held = found[found.held_out].merge(labels, on="doc_id")
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.9
    assert ((found.score >= 0.3) == (found.predicted == 1)).all()
