"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds (multiplies)
its letters' vectors, each permuted (rotated) by its place; a text's vector bundles
(adds) its n-grams' vectors, and a language's prototype bundles its training texts.
A text gets the language whose prototype has the largest cosine with its vector.

A text's vector is worked out from its n-gram counts: counts times the matrix of
n-gram vectors, whose rows are made when first met and dropped when they become
too many. A slice of a text that has more different n-grams than the matrix has rows
is added up in parts, so memory is bounded whatever the alphabet.

Defined results: texts that are null, empty or without letters get ``und`` and
score 0, as does every text if there is nothing to learn from; ties go to the
smaller language name; a text of any length is read whole, in slices; repeated
rows are scored alike; other columns pass through untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirline.llm.common import freeing

UNKNOWN = "und"
NO_LETTERS = re.compile(r"[\W\d_]+")
LETTERS = 128  # letter classes: 0 is the gap, a to z, the rest by code point
SLICE = 1 << 18  # characters of a text that are counted at a time
PART = 1 << 10  # n-gram vectors that are made or added up at a time


@dataclass(frozen=True)
class Settings:
    dimensions: int = 1024
    gram: int = 3
    seed: int = 7
    max_training_rows: int = 20_000  # bound of the labelled sample
    max_grams: int = 1 << 15  # n-gram vectors that a task keeps


def letter_classes(text: str) -> np.ndarray:
    """Letter classes of a text in lower case, gaps between words as 0."""
    words = NO_LETTERS.sub(" ", text.lower())
    if not words.isascii():  # numbers such as one half are word characters, but no letters
        others = {ord(c): " " for c in set(words) - {" "} if not c.isalpha()}
        words = " ".join(words.translate(others).split()) if others else words
    words = words.strip()
    if not words:
        return np.zeros(0, np.int64)
    points = np.frombuffer(f" {words} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    plain = (points >= 97) & (points <= 122)
    return np.where(points == 32, 0, np.where(plain, points - 96, 27 + points % (LETTERS - 27)))


class Encoder:
    """Texts to hypervectors."""

    def __init__(self, settings: Settings):
        self.settings = settings
        rng = np.random.default_rng(settings.seed)
        self.letters = rng.choice(
            np.array([-1, 1], np.int8), (LETTERS, settings.dimensions)
        )
        self._forget()

    def _forget(self):
        self.row = np.full(LETTERS**self.settings.gram, -1, np.int32)
        self.known = 0
        self.vectors = np.empty((self.settings.max_grams, self.settings.dimensions), np.int8)

    def gram_vectors(self, codes: np.ndarray) -> np.ndarray:
        """Binding: the product of the letters' vectors, rotated by place."""
        out = np.ones((len(codes), self.settings.dimensions), np.int8)
        for place in range(self.settings.gram):
            letter = codes // LETTERS**place % LETTERS
            out *= np.roll(self.letters, place, axis=1)[letter]
        return out

    def _learn(self, new: np.ndarray) -> None:
        """Makes room for new codes, at most ``max_grams``, and their vectors."""
        if self.known + len(new) > self.settings.max_grams:
            self.row.fill(-1)
            self.known = 0
        last = self.known + len(new)
        self.row[new] = np.arange(self.known, last)
        for a in range(0, len(new), PART):
            at = self.known + a
            self.vectors[at : min(at + PART, last)] = self.gram_vectors(new[a : a + PART])
        self.known = last

    def _bundle(self, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Vectors of some rows, each as often as it counts, added up."""
        out = np.zeros(self.settings.dimensions)
        for a in range(0, len(rows), PART):
            part = self.vectors[rows[a : a + PART]].astype(np.float32)
            out += counts[a : a + PART].astype(np.float32) @ part
        return out

    def _bundled(self, codes: np.ndarray) -> np.ndarray:
        new = np.unique(codes[self.row[codes] < 0])
        if self.known + len(new) <= self.settings.max_grams:
            self._learn(new)
            counts = np.bincount(self.row[codes], minlength=1)
            seen = np.flatnonzero(counts)
            return self._bundle(seen, counts[seen])
        out, most = np.zeros(self.settings.dimensions), self.settings.max_grams
        different, counts = np.unique(codes, return_counts=True)
        for a in range(0, len(different), most):
            part = different[a : a + most]
            self.known = most  # every part starts from an empty table
            self._learn(part)
            out += self._bundle(self.row[part], counts[a : a + most])
        return out

    def vector(self, text: str | None) -> np.ndarray | None:
        """Bundle of a whole text's n-grams; None without letters."""
        letters = letter_classes(text) if text else ()
        if not len(letters):
            return None
        n, out = self.settings.gram, np.zeros(self.settings.dimensions, np.float64)
        for start in range(0, max(1, len(letters) - n + 1), SLICE):
            part = letters[start : start + SLICE + n - 1]
            codes = np.zeros(max(0, len(part) - n + 1), np.int64)
            for place in range(n):
                codes = codes * LETTERS + part[place : place + len(codes)]
            out += self._bundled(codes)
        return out


@dataclass(frozen=True)
class Profiles:
    """Prototypes by language, as unit vectors in the order of the names."""

    names: tuple[str, ...]
    prototypes: np.ndarray
    settings: Settings


def fit(
    docs: DataFrame, settings: Settings | None = None, *, id_col="doc_id", text_col="text",
    lang_col="lang",
) -> Profiles:
    """Profiles from a sample of at most ``max_training_rows`` rows of ``docs``, the
    first by a hash of their id. Only ids are sorted; a vector per language and task
    comes to the driver, so what it gets does not grow with the texts."""
    settings = settings or Settings()
    labelled = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    limit = (
        labelled.select(F.xxhash64(F.lit(settings.seed), "id").alias("rank"))
        .orderBy("rank")
        .limit(settings.max_training_rows)
        .agg(F.max("rank"))
        .first()[0]
    )
    if limit is None:
        return Profiles((), np.zeros((0, settings.dimensions)), settings)
    sample = labelled.where(F.xxhash64(F.lit(settings.seed), "id") <= limit)

    @freeing
    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, sums = Encoder(settings), {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                vector = encoder.vector(text)
                if vector is not None:
                    unit = vector / max(np.linalg.norm(vector), 1.0)
                    sums[lang] = sums.get(lang, 0) + unit
        if sums:
            yield pd.DataFrame({"lang": list(sums), "v": [v.tolist() for v in sums.values()]})

    parts = sample.select("lang", "text").mapInPandas(bundle, "lang string, v array<double>")
    place = F.posexplode("v").alias("i", "x")
    summed = parts.select("lang", place).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    found = summed.toPandas().pivot(index="lang", columns="i", values="x").sort_index()
    rows = found.to_numpy(dtype=np.float64)
    rows = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    return Profiles(tuple(found.index), rows, settings)


def predict(text: Column, profiles: Profiles) -> Column:
    """Struct of ``lang_pred`` and ``score`` (the cosine, not below 0) of a text."""

    @F.pandas_udf("lang_pred string, score double")
    @freeing
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(profiles.settings)
        for texts in batches:
            langs, scores = [], []
            for text in texts:
                vector = encoder.vector(text) if profiles.names else None
                if vector is None:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosines = profiles.prototypes @ (vector / max(np.linalg.norm(vector), 1e-12))
                best = int(cosines.argmax())
                langs.append(profiles.names[best])
                scores.append(float(min(max(cosines[best], 0.0), 1.0)))
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return score(text)
