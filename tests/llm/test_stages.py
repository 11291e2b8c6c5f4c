import numpy as np
from cases import DATA, documents

import corpus_pipeline
from weirline.llm import quality
from weirline.llm.common import stored

SF = str(DATA).replace("0.001", "0.01")


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    before = {r.doc_id: r.text for r in docs.collect()}
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), "test-stage")
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
        counts.append(docs.count())
    rows = docs.collect()
    assert len(before) > counts[0] >= counts[1] > counts[2] == counts[3] == len({r.doc_id for r in rows})
    good = set(labels[labels.quality == 1].doc_id)
    assert counts[0] >= 0.97 * len(before) * len(good) / len(labels)
    assert any(r.text != before[r.doc_id] for r in rows)
    assert all(r.n_chars == len(r.text) for r in rows)

    pieces = stored(corpus_pipeline.pack(spark, docs, SF), "test-pieces").toPandas()
    assert set(pieces.doc_id) == {r.doc_id for r in rows}
    sizes = pieces.groupby("sequence_id")["length"].sum()
    assert sizes.max() <= 2048
    assert len(sizes) <= np.ceil(sizes.sum() / 2048) + 2


def test_language_stage_rejects_texts_without_letters(spark):
    docs = documents(spark, ["the cat", None, "", "12 !", "le chat"], langs=["en", "en", None, "en", "fr"])
    kept = corpus_pipeline.keep_language(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 4]


def test_language_stage_rejects_letter_junk(spark):
    rng = np.random.default_rng(3)
    alphabets = ["abcdefghijklmnopqrstuvwxyz   ", "абвгдежзийклмнопрстуфхцчшщыьэюя   ", "αβγδεζηθικλμνξο   "]
    junk = ["".join(rng.choice(list(a), 800)) for a in alphabets]
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null")
    first = 10 + rows.agg({"doc_id": "max"}).first()[0]
    planted = [(first + i, text, None, None, len(text)) for i, text in enumerate(junk)]
    docs = rows.unionByName(spark.createDataFrame(planted, rows.schema))
    kept = {r.doc_id for r in corpus_pipeline.keep_language(spark, docs, SF).collect()}
    assert not kept & {first + i for i in range(len(junk))}
    lettered = {r.doc_id for r in rows.where(rows["text"].rlike(r"\p{L}")).collect()}
    assert kept == lettered  # not one text of a learned language goes, however short


def test_empty_documents(spark):
    docs = documents(spark, [], extra=False)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-empty")
    assert docs.collect() == []


def test_quality_threshold(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.keep_quality(spark, docs, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(~corpus_pipeline.held_out())
    model = quality.fit(docs, labels)
    scored = docs.select("doc_id", quality.score(docs["text"], model).alias("s")).collect()
    assert kept == {r.doc_id for r in scored if r.s >= 0.3}
