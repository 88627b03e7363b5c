"""Operator 3: language identification with error-correcting output codes."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.llm.common import sample_by, utf8_cells

#: Hashed byte trigrams.
FEATURES = 4096
LETTER = re.compile(r"[^\W\d_]")


class Codes(NamedTuple):
    """Codewords of the languages and the classifiers of their bits."""

    languages: list[str]
    words: np.ndarray  # languages x bits, -1 or 1
    trust: np.ndarray  # languages x bits: share of the language's texts whose bit came out right
    weights: np.ndarray  # features x bits
    bias: np.ndarray


def codewords(classes: int, seed: int = 3) -> np.ndarray:
    """A row of -1/1 per class: every split of few classes, else the random code whose two nearest
    rows are farthest apart."""
    if classes < 2:
        return np.zeros((classes, 0))
    if classes <= 5:
        splits = [s for s in itertools.product((-1, 1), repeat=classes - 1) if -1 in s]
        return np.array([[1, *s] for s in splits], float).T
    bits, rng = int(np.ceil(10 * np.log2(classes))), np.random.default_rng(seed)
    draws = [rng.choice((-1.0, 1.0), (classes, bits)) for _ in range(30)]
    return max(draws, key=lambda d: min(int((d[a] != d[b]).sum()) for a, b in itertools.combinations(range(classes), 2)))


def _letters() -> np.ndarray:
    """Byte to byte: ASCII letters in lower case, bytes of other characters kept, the rest blank."""
    table = np.full(256, 32, np.uint32)
    table[128:] = np.arange(128, 256)
    for low in range(ord("a"), ord("z") + 1):
        table[low] = table[low - 32] = low
    return table


def histogram(cell: bytes, table: np.ndarray) -> np.ndarray:
    """Square roots of the shares of hashed letter trigrams, of length 1."""
    b = table[np.frombuffer(cell, np.uint8)]
    b = np.concatenate([[np.uint32(32)], b, [np.uint32(32)]]).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(FEATURES, np.float32)
    grams = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    grams = grams[(b[1:-1] != 32)]
    counts = np.bincount((grams * np.uint32(2654435761)) >> np.uint32(20), minlength=FEATURES)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], rounds: int = 200, rate: float = 4.0, decay: float = 1e-4) -> Codes:
    """All bits' logistic classifiers at once, by gradient steps with momentum; languages count alike."""
    words = codewords(len(languages))
    weights, bias = np.zeros((FEATURES, words.shape[1]), np.float32), np.zeros(words.shape[1], np.float32)
    if not words.size:
        return Codes(languages, words, words, weights, bias)
    target = words[y].astype(np.float32)
    share = (1 / np.maximum(1, np.bincount(y, minlength=len(languages))) / len(languages))[y].astype(np.float32)
    speed, speed_b = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(rounds):
        slope = -target / (1 + np.exp(np.clip(target * (x @ weights + bias), -30, 30))) * share[:, None]
        speed = 0.9 * speed - rate * (x.T @ slope + decay * weights)
        speed_b = 0.9 * speed_b - 0.1 * rate * slope.sum(0)
        weights, bias = weights + speed, bias + speed_b
    right = (np.sign(x @ weights + bias) == target).astype(float)
    trust = np.array([right[y == k].mean(0) if (y == k).any() else np.ones(words.shape[1]) for k in range(len(languages))])
    return Codes(languages, words, trust, weights.astype(np.float32), bias.astype(np.float32))


def decode(x: np.ndarray, codes: Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword by losses of the bits weighed by trust: (class, share of it, gap to the second)."""
    margin = x @ codes.weights + codes.bias
    trust = codes.trust / np.maximum(1e-9, codes.trust.sum(1, keepdims=True)) * max(1, codes.words.shape[1])
    losses = np.stack([(trust[k] * np.logaddexp(0, -margin * codes.words[k])).sum(1) for k in range(len(codes.languages))], 1)
    near = np.exp(losses.min(1, keepdims=True) - losses)
    ordered = np.sort(losses, 1)
    gap = ordered[:, 1] - ordered[:, 0] if losses.shape[1] > 1 else np.full(len(x), np.inf)
    return losses.argmin(1), near.max(1) / near.sum(1), gap


def held_out(doc_id: Column) -> Column:
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5) == 0


def learn(docs: DataFrame, most: int = 2400) -> Codes:
    """Fit on whole texts of about ``most`` labelled documents, dealt evenly to the languages."""
    rows = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    languages = sorted(row.lang for row in rows.select("lang").distinct().collect())
    if not languages:
        return fit(np.zeros((0, FEATURES), np.float32), np.zeros(0, int), [])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _letters()
        for batch in batches:
            cells = [histogram(bytes(cell), table).tobytes() for cell in utf8_cells(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(cells, pa.binary())], names=["lang", "x"])

    sample = sample_by(rows, "lang", "doc_id", max(20, most // len(languages)))
    found = sample.select("lang", "text").mapInArrow(features, "lang string, x binary").toPandas().sort_values(["lang", "x"])
    x = np.frombuffer(b"".join(found["x"]), np.float32).reshape(-1, FEATURES)
    return fit(x, found["lang"].map({name: k for k, name in enumerate(languages)}).to_numpy(), languages)


def identify(docs: DataFrame, codes: Codes, least_gap: float = 1.0) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, ambiguous.

    Bits of language codewords are predicted from the whole text, the nearest codeword wins; score is
    its share (0 to 1), ambiguous says that a second one is nearly as near. NULL texts and texts
    without a letter are `und` with score 0, and so is everything when no language was learned. Only
    the text is an input. Rows that repeat are predicted each; an empty table gives no rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _letters()
        for batch in batches:
            for part in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
                cells = [bytes(cell) for cell in utf8_cells(part.column("text"))]
                known = np.array([bool(codes.languages) and LETTER.search(cell.decode()) is not None for cell in cells], bool)
                best, share, gap = np.zeros(len(cells), int), np.zeros(len(cells)), np.zeros(len(cells))
                if known.any():
                    # Rounded: sums of floats differ in the last places with the rows beside them.
                    best[known], share[known], gap[known] = (np.round(x, 5) for x in decode(np.stack([histogram(cell, table) for cell, k in zip(cells, known) if k]), codes))
                names = [codes.languages[b] if k else "und" for b, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(share, pa.float64()), pa.array(gap < least_gap)],
                    names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
                )

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return picked.mapInArrow(rows, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")
