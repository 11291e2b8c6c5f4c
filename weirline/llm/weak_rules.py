"""Quality rules by weak supervision: rules vote, a latent quality explains the votes.

A rule looks at counts of a whole text and votes for good, votes for bad, or abstains.
Nobody knows which votes are right, so expectation-maximisation estimates it: given the
accuracies of the rules on good and on bad documents, each document has a posterior
probability of being good; given the posteriors, an accuracy is the share of a rule's
votes that are right. The posterior replaces filtering by all rules at once: one
doubtful vote is outweighed by votes that are more often right.

The vote patterns of all documents are counted; there are at most 3 ** rules of them
(``MAX_RULES`` bounds that), whatever the number of documents, and the estimation runs
over this table on the driver. It is exact: documents with equal votes have equal
posteriors. Counts are taken once, and kept as a narrow table in the shared folder.

Defined results: null and empty texts have no words and fail the base rules; an empty
table gives no rows; repeated rows and repeated ids are rows of their own; votes that
outweigh each other exactly leave the prior; very long texts are read in slices, with
four bytes a word kept; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirline.llm.common import freeing, stored

WORD = re.compile(r"[^ \t-\r]+")
SPACE = re.compile(r"[ \t-\r]")
SYMBOLS = "#*$%&|<>"
WINDOW = 8  # words of a window that may come back
SLICE = 1 << 18  # characters that are split into words at a time
MAX_RULES = 11

FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_alnum long, n_upper long, n_lower long, n_shouts long, n_most long, "
    "n_echoes long"
)


@dataclass(frozen=True)
class Rule:
    """Two conditions over the counts; a text that meets neither gets no vote, and no
    text without words does."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("length", "n_words >= 40", "n_words < 20"),
    Rule("symbols", "50 * n_symbols <= n_words", "5 * n_symbols > n_words"),
    Rule("repeats", "20 * n_repeat_words <= n_words", "10 * n_repeat_words > 3 * n_words"),
    Rule("lines", "20 * n_dup_lines <= n_lines", "3 * n_dup_lines > n_lines"),
    Rule("word length", "word_chars between 3 * n_words and 10 * n_words",
         "word_chars < 2 * n_words or word_chars > 14 * n_words"),
    Rule("letters and digits", "7 * n_alnum >= 6 * word_chars", "4 * n_alnum < 3 * word_chars"),
    Rule("capitals", "n_lower > 0 and 5 * n_upper <= n_lower", "n_upper > n_lower"),
    Rule("shouts", "20 * n_shouts <= n_words", "4 * n_shouts > n_words"),
    Rule("one word", "6 * n_most <= n_words", "3 * n_most > n_words"),
    Rule("echoes", "20 * n_echoes <= n_words", "5 * n_echoes > n_words"),
)


@dataclass(frozen=True)
class Settings:
    base_words: int = 20  # fewer fail
    base_repeats: int = 30  # per cent of the words; more fail
    keep_at_least: float = 0.5  # posterior
    rounds: int = 200
    # Votes assumed beforehand, as a share of the votes that a rule casts, and how many of
    # them are right: each rule knows one kind of bad text, and is seldom wrong on good ones.
    assumed: float = 0.02
    right_on_good: float = 0.99
    right_on_bad: float = 0.3


def words_of(text: str) -> Iterator[list[str]]:
    """The words of a text, some at a time; no word is cut."""
    start = 0
    while start < len(text):
        gap = SPACE.search(text, min(start + SLICE, len(text)))
        end = gap.end() if gap else len(text)
        yield WORD.findall(text, start, end)
        start = end


def repeated(ids: np.ndarray) -> int:
    """Words inside windows that occur twice or more. Windows are told apart exactly:
    equal pairs of words get a number, then equal pairs of pairs, then of those."""
    if len(ids) <= WINDOW:
        return 0
    step = 1
    while step < WINDOW:
        pairs = ids[:-step].astype(np.int64) * (int(ids.max()) + 1) + ids[step:]
        _, ids, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        step *= 2
    starts = np.flatnonzero(counts[ids] > 1)
    if not len(starts):
        return 0
    edges = np.zeros(len(ids) + WINDOW, np.int64)
    edges[starts] = 1
    edges[starts + WINDOW] -= 1
    return int((np.cumsum(edges) > 0).sum())


def _kinds() -> np.ndarray:
    """By code point: 1 a digit or letter without case, 2 a capital, 3 a small letter, else 0."""
    kinds = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        char = chr(point)
        if char.isalnum():
            kinds[point] = 2 if char.isupper() else 3 if char.islower() else 1
    return kinds


def counts(text: str, kinds: np.ndarray) -> tuple[int, ...]:
    """The features of a text, in the order of ``FEATURES``."""
    known: dict[str, int] = {}
    parts, chars = [], 0
    for words in words_of(text):
        chars += sum(map(len, words))
        number = (known.setdefault(w, len(known)) for w in words)
        parts.append(np.fromiter(number, np.int32, len(words)))
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    seen = np.zeros(4, np.int64)
    for start in range(0, len(text), SLICE):
        points = np.frombuffer(text[start : start + SLICE].encode("utf-32-le"), np.uint32)
        seen += np.bincount(kinds[points], minlength=4)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(ids), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
        repeated(ids), len(lines), int(seen[1:].sum()), int(seen[2]), int(seen[3]),
        text.count("!") + text.count("?"), int(np.bincount(ids).max()) if len(ids) else 0,
        int((ids[1:] == ids[:-1]).sum()),
    )


def features(text: Column) -> Column:
    """Struct of the counts of a whole text."""
    names = [f.split()[0] for f in FEATURES.split(", ")]

    @F.pandas_udf(FEATURES)
    @freeing
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        kinds = _kinds()
        for texts in batches:
            rows = [counts(t or "", kinds) for t in texts]
            yield pd.DataFrame(rows, columns=names, dtype="int64")

    return counted(text)


def votes(rules: Sequence[Rule]) -> list[Column]:
    """1, -1 or 0 of each rule, over the columns of ``FEATURES``."""
    return [
        F.when(F.col("n_words") == 0, 0).when(F.expr(r.good), 1).when(F.expr(r.bad), -1)
        .otherwise(0).cast("int")
        for r in rules
    ]


@dataclass(frozen=True)
class Model:
    """Log-odds of being good: beforehand, and for each rule's two votes."""

    prior: float
    for_good: tuple[float, ...]
    for_bad: tuple[float, ...]

    def log_odds(self, patterns: np.ndarray) -> np.ndarray:
        return self.prior + (patterns == 1) @ self.for_good + (patterns == -1) @ self.for_bad


def estimate(patterns: np.ndarray, numbers: np.ndarray, settings: Settings) -> Model:
    """Expectation-maximisation over vote patterns and how often each occurs.

    Abstaining says nothing. A vote never counts for the other side, so a class cannot
    turn into its opposite; the assumed votes keep the classes from settling on one kind
    of bad texts. At first any vote for bad makes a text doubtful."""
    up, down = patterns == 1, patterns == -1
    cast = up | down
    assumed = settings.assumed * (numbers @ cast) + 1
    good = np.where(down.any(axis=1), 0.1, 0.9)
    model = None
    for _ in range(settings.rounds):
        n_good, n_bad = numbers * good, numbers * (1 - good)
        share = (n_good.sum() + 1) / (numbers.sum() + 2)
        right_good = (n_good @ up + assumed * settings.right_on_good) / (n_good @ cast + assumed)
        right_bad = (n_bad @ down + assumed * settings.right_on_bad) / (n_bad @ cast + assumed)
        model = Model(
            float(np.log(share / (1 - share))),
            tuple(np.maximum(np.log(right_good / (1 - right_bad)), 0).tolist()),
            tuple(np.minimum(np.log((1 - right_good) / right_bad), 0).tolist()),
        )
        before, good = good, 1 / (1 + np.exp(-np.clip(model.log_odds(patterns), -500, 500)))
        if len(good) and np.abs(good - before).max() < 1e-9:
            break
    return model


def fit(counted: DataFrame, rules: Sequence[Rule] = RULES, settings: Settings | None = None) -> Model:
    """Accuracies from the votes on all rows of ``counted`` (columns of ``FEATURES``)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules make too many vote patterns")
    names = [f"v{i}" for i in range(len(rules))]
    cast = counted.select(*[v.alias(n) for v, n in zip(votes(rules), names, strict=True)])
    table = cast.groupBy(*names).count().toPandas().sort_values(names)  # 3 ** rules at most
    return estimate(
        table[names].to_numpy(int).reshape(-1, len(rules)), table["count"].to_numpy(float),
        settings or Settings(),
    )


def posterior(model: Model, rules: Sequence[Rule] = RULES) -> Column:
    """Probability of being good, over the columns of ``FEATURES``."""
    total = F.lit(model.prior)
    for vote, good, bad in zip(votes(rules), model.for_good, model.for_bad, strict=True):
        total += F.when(vote == 1, good).when(vote == -1, bad).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def judge(
    docs: DataFrame, rules: Sequence[Rule] = RULES, settings: Settings | None = None, *,
    id_col="doc_id", text_col="text",
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the counts, ``base_failed``, the ``posterior``
    probability of being good, and ``kept``."""
    settings = settings or Settings()
    each = docs.select(F.col(id_col).alias("doc_id"), features(F.col(text_col)).alias("f"))
    counted = stored(each.select("doc_id", "f.*"), "rule-counts")
    probability = posterior(fit(counted, rules, settings), rules)
    failed = (F.col("n_words") < settings.base_words) | (
        100 * F.col("n_repeat_words") > settings.base_repeats * F.col("n_words")
    )
    judged = counted.withColumns({"base_failed": failed, "posterior": probability})
    return judged.withColumn("kept", ~failed & (F.col("posterior") >= settings.keep_at_least))
