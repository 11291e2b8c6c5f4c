"""Quality classifier: random-indexing word vectors and a two-layer network.

Words (runs of word characters, runs of other marks) fall into a fixed number of
hash classes. Each class has a sparse random index vector; its word vector is the
sum of the index vectors of its neighbours in the training texts, plus its own.
A document is the mean and the spread of its words' unit vectors, and the mean inner
product of words one to ``gaps`` apart (high where words repeat). A network with
one hidden layer, in numpy, gives a logit, and a temperature fitted on rows kept
out of its training turns that into a calibrated probability.

Word vectors and network are fitted on a sample of labelled rows whose bound is a
parameter; every document is scored, from its whole text.

Defined results: null and empty texts pool to the zero vector and get a score like
any other; a null quality is no label; without labels every score is 0.5, and with
one kind of label its rate; documents listed twice in the labels count once
per distinct label; very long texts are read in slices; other columns pass through.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirline.llm.common import cut, freeing

WORD = re.compile(r"\w+|[^\w\s]+")
SLICE = 1 << 20  # characters of a text that are pooled at a time
CACHED_WORDS = 300_000
CHUNK = 1024  # word classes in a row of partial sums


@dataclass(frozen=True)
class Settings:
    classes: int = 1 << 15
    dimensions: int = 48
    nonzero: int = 4
    window: int = 2
    gaps: int = 3
    hidden: int = 32
    epochs: int = 40
    seed: int = 11
    max_training_rows: int = 20_000  # bound of the labelled sample
    tasks: int = 12  # of the bounded sample


def slices(text: str) -> Iterator[str]:
    """A long text in parts of about ``SLICE`` characters, cut at white space."""
    start = 0
    while len(text) - start > SLICE:
        end = max(text.rfind(" ", start, start + SLICE), text.rfind("\n", start, start + SLICE))
        end = end if end > start else start + SLICE
        yield text[start:end]
        start = end
    yield text[start:]


class Words:
    """Word classes of texts."""

    def __init__(self, classes: int):
        self.classes, self.known = classes, {}

    def __call__(self, text: str) -> np.ndarray:
        words = WORD.findall(text)
        known = self.known.get
        found = [known(w) for w in words]
        if None in found:
            if len(self.known) > CACHED_WORDS:
                self.known.clear()
            for i, w in enumerate(words):
                if found[i] is None:
                    found[i] = self.known[w] = zlib.crc32(w.encode("utf-8", "replace")) % self.classes
        return np.array(found, np.int64)


def index_vectors(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero parts of each class's index vector."""
    rng = np.random.default_rng(settings.seed)
    shape = (settings.classes, settings.nonzero)
    return rng.integers(0, settings.dimensions, shape), rng.choice([-1.0, 1.0], shape)


def _context_sums(texts: Iterator[str], settings: Settings) -> np.ndarray:
    """Per class, the sum of its neighbours' index vectors."""
    places, signs = index_vectors(settings)
    words, d = Words(settings.classes), settings.dimensions
    total = np.zeros(settings.classes * d)
    for text in texts:
        for part in slices(text):
            ids = words(part)
            for gap in range(1, settings.window + 1):
                for of, by in ((ids[:-gap], ids[gap:]), (ids[gap:], ids[:-gap])):
                    np.add.at(total, of[:, None] * d + places[by], signs[by])
    return total.reshape(settings.classes, d)


@dataclass(frozen=True)
class Model:
    settings: Settings
    vectors: np.ndarray  # unit word vectors by class
    mean: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]  # w1, b1, w2, b2
    temperature: float

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        logits = _logits(self.layers, (pooled - self.mean) / self.scale)
        return 1 / (1 + np.exp(-np.clip(logits / self.temperature, -30, 30)))


def pool(text: str | None, words: Words, vectors: np.ndarray, gaps: int) -> np.ndarray:
    """Mean and spread of a text's word vectors, and how alike near words are."""
    d = vectors.shape[1]
    n, total, squares, near, pairs = 0, np.zeros(d), np.zeros(d), np.zeros(gaps), np.zeros(gaps)
    for part in slices(text or ""):
        found = vectors[words(part)]
        n += len(found)
        total += found.sum(0)
        squares += np.einsum("ij,ij->j", found, found)
        for gap in range(1, min(gaps, len(found) - 1) + 1):
            near[gap - 1] += np.einsum("ij,ij->", found[gap:], found[:-gap])
            pairs[gap - 1] += len(found) - gap
    mean = total / max(n, 1)
    spread = np.sqrt(np.maximum(squares / max(n, 1) - mean**2, 0))
    return np.concatenate([mean, spread, near / np.maximum(pairs, 1)])


def _logits(layers, x):
    w1, b1, w2, b2 = layers
    return np.maximum(x @ w1 + b1, 0) @ w2 + b2


def train(pooled: np.ndarray, labels: np.ndarray, settings: Settings):
    """Two layers by Adam on the cross-entropy; the temperature on every tenth row."""
    rng = np.random.default_rng(settings.seed)
    mean, scale = pooled.mean(0), pooled.std(0) + 1e-6
    x = (pooled - mean) / scale
    kept = np.arange(len(x)) % 10 == 9
    if len(x) < 50:
        kept[:] = False
    fit_x, fit_y = x[~kept], labels[~kept].astype(float)
    width, rate = x.shape[1], np.clip(fit_y.mean(), 0.01, 0.99)
    layers = [
        rng.normal(0, np.sqrt(2 / width), (width, settings.hidden)),
        np.zeros(settings.hidden),
        rng.normal(0, np.sqrt(1 / settings.hidden), settings.hidden),
        np.array(np.log(rate / (1 - rate))),
    ]
    first, second, step = [0 * p for p in layers], [0 * p for p in layers], 0
    for _ in range(settings.epochs):
        order = rng.permutation(len(fit_x))
        for at in range(0, len(order), 128):
            rows = order[at : at + 128]
            a, y = fit_x[rows], fit_y[rows]
            h = np.maximum(a @ layers[0] + layers[1], 0)
            error = (1 / (1 + np.exp(-np.clip(h @ layers[2] + layers[3], -30, 30))) - y) / len(y)
            back = error[:, None] * layers[2] * (h > 0)
            grads = [a.T @ back + 1e-4 * layers[0], back.sum(0), h.T @ error, error.sum()]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                up = first[i] / (1 - 0.9**step)
                layers[i] = layers[i] - 2e-3 * up / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    temperature = 1.0
    if kept.any():
        logits, y = _logits(layers, x[kept]), labels[kept]
        grid = np.geomspace(0.25, 8, 60)
        loss = [np.logaddexp(0, np.where(y == 1, -logits, logits) / t).mean() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
    return mean, scale, tuple(layers), temperature


def fit(
    docs: DataFrame, labels: DataFrame, settings: Settings | None = None, *, id_col="doc_id",
    text_col="text", label_col="quality",
) -> Model:
    """Model from at most ``max_training_rows`` labelled rows, the first by a hash of
    their id. ``labels`` has the id and the label; pass the training rows only."""
    settings = settings or Settings()
    rank = F.xxhash64(F.lit(settings.seed), "id")
    known = labels.select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")
    ).where("label in (0, 1)").distinct()
    limit = (
        known.select(rank.alias("rank")).orderBy("rank").limit(settings.max_training_rows)
        .agg(F.max("rank")).first()[0]
    )
    chosen = known.where(rank <= F.lit(limit).cast("long"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = cut(
        # The chosen ids are bounded by max_training_rows.
        texts.join(F.broadcast(chosen), "id").repartition(settings.tasks)
    )

    @freeing
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = _context_sums((t for b in batches for t in b["text"] if t), settings)
        for chunk in range(0, settings.classes, CHUNK):
            part = total[chunk : chunk + CHUNK]
            if part.any():
                yield pd.DataFrame({"chunk": [chunk], "part": [part.astype("<f4").tobytes()]})

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p, "<f4").astype(float) for p in parts["part"])
        first = parts["chunk"].iloc[0]
        return pd.DataFrame({"chunk": [first], "part": [total.astype("<f4").tobytes()]})

    schema = "chunk int, part binary"
    partial = sample.select("text").mapInPandas(sums, schema)
    places, signs = index_vectors(settings)
    vectors = np.zeros((settings.classes, settings.dimensions))
    for chunk, part in partial.groupBy("chunk").applyInPandas(add, schema).toPandas().values:
        rows = np.frombuffer(part, "<f4").reshape(-1, settings.dimensions)
        vectors[chunk : chunk + len(rows)] += rows
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors /= np.maximum(lengths, 1e-9)
    np.add.at(vectors, (np.arange(settings.classes)[:, None], places), signs / 2)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    vectors = vectors.astype(np.float32)

    @freeing
    def pooled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(settings.classes)
        for batch in batches:
            rows = [pool(t, words, vectors, settings.gaps).tolist() for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "x": rows})

    rows = (
        sample.mapInPandas(pooled, "id long, label int, x array<double>")
        .toPandas().sort_values(["id", "label"])
    )
    if rows.empty:
        width = 2 * settings.dimensions + settings.gaps
        layers = (np.zeros((width, 1)), np.zeros(1), np.zeros(1), np.array(0.0))
        return Model(settings, vectors, np.zeros(width), np.ones(width), layers, 1.0)
    trained = train(np.array(rows["x"].tolist()), rows["label"].to_numpy(), settings)
    return Model(settings, vectors, *trained)


def score(text: Column, model: Model) -> Column:
    """Probability of label 1 for a text."""

    @F.pandas_udf("double")
    @freeing
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = Words(model.settings.classes)
        for texts in batches:
            if len(texts):
                rows = np.array([pool(t, words, model.vectors, model.settings.gaps) for t in texts])
                yield pd.Series(model.probability(rows))
            else:
                yield pd.Series([], dtype="float64")

    return scored(text)
