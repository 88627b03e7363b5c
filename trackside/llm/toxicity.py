"""Operator 8: severity of toxic language by cumulative-link ordinal regression."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from math import log1p
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.llm.common import sample_by

FEATURES = 1 << 18
WORD = re.compile(r"[^\W\d_]+")


class Severity(NamedTuple):
    """One weight per feature, shared by all thresholds: P(grade >= k) = logistic(score - thresholds[k - 1])."""

    weights: np.ndarray
    thresholds: np.ndarray


def word_features(word: str) -> list[int]:
    """The word and its beginnings of four and five letters, hashed."""
    parts = {word, "^" + word[:4], "^" + word[:5]}
    return [zlib.crc32(part.encode()) % FEATURES for part in parts]


def expected(score: np.ndarray, model: Severity) -> np.ndarray:
    """Expected grade: the sum over thresholds of the chance to reach them."""
    return (1 / (1 + np.exp(-np.clip(score[:, None] - model.thresholds[None, :], -30, 30)))).sum(1)


def telling(index: np.ndarray, row: np.ndarray, marked: np.ndarray, least: float) -> np.ndarray:
    """Features whose presence tells marked rows from others: log-likelihood ratio of ``least`` or more."""
    with_, n = np.bincount(index[marked[row]], minlength=FEATURES).astype(float), float(marked.sum())
    without, m = np.bincount(index[~marked[row]], minlength=FEATURES).astype(float), float((~marked).sum())
    share = (with_ + without) / (n + m)

    def part(seen: np.ndarray, asked: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(asked, 1e-12)), 0)

    ratio = part(with_, n * share) + part(n - with_, n * (1 - share)) + part(without, m * share) + part(m - without, m * (1 - share))
    return 2 * ratio >= least


def fit(index: np.ndarray, value: np.ndarray, starts: np.ndarray, grade: np.ndarray, clean: float = 2.0, rounds: int = 300, rate: float = 0.3, sparse: float = 5e-4, least: float = 12.0) -> Severity:
    """Maximum likelihood with a price on weights, for rows in compressed form (index and value of the
    features of row i from starts[i] on). Grade 0 weighs ``clean`` times as much as the rest.

    Features that do not tell grade 0 from the rest get no weight, and neither do those that are not
    worth the price ``sparse``: words seen by chance in a few rows must not add up in long texts.
    """
    n, top = len(grade), int(grade.max(initial=0))
    weights = np.zeros(FEATURES)
    if not top or (grade > 0).all():  # one side only: nothing to tell apart
        return Severity(weights, np.full(top, -30.0 if top else 0.0))
    row = np.repeat(np.arange(n), np.diff(np.append(starts, len(index))))
    use = telling(index, row, grade > 0, least)
    place, own = np.cumsum(use) - 1, use[index]
    index, value, row, k = place[index[own]], value[own], row[own], int(use.sum())
    share = np.where(grade > 0, 1 / (grade > 0).sum(), clean / (grade == 0).sum()) / (1 + clean)
    # Unknowns: weights, the first threshold, logarithms of the steps to the next ones.
    x, squares, at = np.zeros(k + top), np.full(k + top, 1e-8), np.arange(n)
    for _ in range(rounds):
        steps = np.exp(x[k + 1 :])
        cuts = x[k] + np.concatenate([[0.0], np.cumsum(steps)])
        score = np.bincount(row, value * x[index], minlength=n)
        reach = np.concatenate([np.ones((n, 1)), 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -30, 30))), np.zeros((n, 1))], 1)
        low, high = reach[at, grade], reach[at, grade + 1]
        chance = np.maximum(low - high, 1e-9)
        # Slopes of the log likelihood by the cut below the grade and by the one above it.
        down, up = low * (1 - low) / chance * share, high * (1 - high) / chance * share
        by_cut = (np.bincount(grade + 1, up, minlength=top + 2) - np.bincount(grade, down, minlength=top + 2))[1 : top + 1]
        slope = np.concatenate([np.bincount(index, value * (down - up)[row], minlength=k), [by_cut.sum()], [by_cut[j + 1 :].sum() * steps[j] for j in range(top - 1)]])
        squares += slope**2
        pace = rate / np.sqrt(squares)
        x += pace * slope
        x[:k] = np.sign(x[:k]) * np.maximum(np.abs(x[:k]) - pace[:k] * sparse, 0)
    weights[use] = x[:k]
    return Severity(weights, x[k] + np.concatenate([[0.0], np.cumsum(np.exp(x[k + 1 :]))]))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: tuple[list, list] = [], []
        for text in batch.column("text").to_pylist():
            words = WORD.findall((text or "").lower())
            ids, counts = np.unique(np.array([f for word in words for f in word_features(word)], np.int32), return_counts=True)
            out[0].append(ids.tobytes())
            out[1].append(np.log1p(counts).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], names=["grade", "ids", "values"])


def _arrays(found: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = found["ids"].map(len).to_numpy() // 4
    return np.frombuffer(b"".join(found["ids"]), np.int32), np.frombuffer(b"".join(found["values"]), np.float32).astype(float), np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(int) if len(found) else np.zeros(0, int)


def graded(docs: DataFrame, labels: DataFrame, most: int = 2400) -> DataFrame:
    """(doc_id, text, grade) of about ``most`` labelled documents of each grade: grade 0 or 1.

    Labels are sampled before they meet texts, so the chosen ids, at most about ``most`` for each of a few
    grades, can go to all tasks and no text is shuffled. Labels without a document are lost from the
    sample.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("grade")).filter("_id is not null and grade is not null").distinct()
    chosen = sample_by(known, "grade", "_id", most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "grade")


def learn(labelled: DataFrame, most: int = 2400, grades: int = 3) -> Severity:
    """Fit on whole texts of (doc_id, text, grade), about ``most`` rows of each grade given.

    Where the labels know only 0 and 1, the severity of the ones is not given: they are graded 1 to
    ``grades`` by thirds of the score of a first fit, and fitted again. NULL grades take no part.
    """
    rows = labelled.select("doc_id", "text", F.col("grade").cast("int").alias("grade")).filter(F.col("grade").isNotNull())
    found = sample_by(rows, "grade", "doc_id", most).select("grade", "text").mapInArrow(_sparse, "grade int, ids binary, values binary").toPandas().sort_values(["grade", "ids"])
    index, value, starts = _arrays(found)
    grade = found["grade"].to_numpy().astype(int)
    model = fit(index, value, starts, grade)
    if grade.max(initial=0) != 1 or grades < 2 or (grade > 0).all():
        return model
    row = np.repeat(np.arange(len(grade)), np.diff(np.append(starts, len(index))))
    score = np.bincount(row, value * model.weights[index], minlength=len(grade))
    bounds = np.quantile(score[grade == 1], [k / grades for k in range(1, grades)])
    return fit(index, value, starts, np.where(grade == 1, 1 + np.searchsorted(bounds, score), 0))


class Scorer:
    """Scores of texts. Few features have weight, so words are looked up by whether they have one;
    what was found out about a word is kept while a task runs."""

    def __init__(self, model: Severity, most: int = 500_000):
        self.weights, self.most = model.weights, most
        self.words: dict[str, tuple[int, ...]] = {}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        known, weights, out = self.words, self.weights, np.zeros(len(texts))
        if len(known) > self.most:
            known.clear()
        for k, text in enumerate(texts):
            words = WORD.findall((text or "").lower())
            for word in set(words).difference(known):
                known[word] = tuple(f for f in word_features(word) if weights[f])
            counts = Counter(chain.from_iterable(map(known.__getitem__, words)))
            out[k] = sum(weights[f] * log1p(n) for f, n in counts.items())
        return out


def severity(docs: DataFrame, model: Severity) -> DataFrame:
    """One row per row of ``docs``: doc_id, severity (expected grade), p_toxic (chance of grade 1 or more).

    NULL, empty and wordless texts score 0 words: their severity is that of a text without any known
    word. Rows that repeat are scored each; other columns are not read; an empty table gives no rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            score = scorer(batch.column("text").to_pylist())
            first = 1 / (1 + np.exp(-np.clip(score - model.thresholds[0], -30, 30))) if len(model.thresholds) else np.zeros(len(score))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(expected(score, model)), pa.array(first)], names=["doc_id", "severity", "p_toxic"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, severity double, p_toxic double")


def keep_clean(docs: DataFrame, model: Severity, reject: float) -> DataFrame:
    """The rows of ``docs`` whose chance of grade 1 or more lies below ``reject``, all columns as they are."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, least = Scorer(model), np.log(reject / (1 - reject))
        first = model.thresholds[0] if len(model.thresholds) else np.inf
        for batch in batches:
            yield batch.filter(pa.array(scorer(batch.column("text").to_pylist()) - first < least))

    return docs.mapInArrow(rows, docs.schema)
