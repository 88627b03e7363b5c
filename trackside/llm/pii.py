"""Operator 5: personal data by patterns and a linear-chain conditional random field."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.llm.common import WORD, sample_by

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails at its start fails everywhere in it, so matches start at runs only.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# What the field may add as one token: letters of all scripts around the @, and written-out dots.
LOOSE_EMAIL = re.compile(r"[\w.%+!#$&'*/=?^`{|}~-]+@[\w-]+(?:\.[\w-]+)+")
LOOSE_IP = re.compile(r"[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}")
DIGIT = re.compile(r"[0-9]")
TOKEN = re.compile(WORD)


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @, domain: found from the @, so long runs without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = at
        while domain and start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def valid(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in found.split("."))
    digits = "".join(DIGIT.findall(found))
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 8 <= len(digits) <= 15


def fits(kind: str, found: str) -> bool:
    """May the field add this text? Emails and addresses have checks looser than their patterns."""
    if kind == "email":
        return LOOSE_EMAIL.fullmatch(found) is not None
    if kind == "ip":
        return LOOSE_IP.fullmatch(found) is not None and all(int(part) <= 255 for part in re.findall("[0-9]+", found))
    return (kind != "card" or CARD.fullmatch(found) is not None) and valid(kind, found)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns, by kind and start; end is exclusive, in code points."""
    found = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
            if kind != 3 or "+" in text:
                found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(KINDS[kind], m[0])]
    return found


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


SHAPES = 4096
_CLASSES = bytes(
    ord("X") if 65 <= b <= 90 else ord("x") if 97 <= b <= 122 or b >= 128 else ord("d") if 48 <= b <= 57 else b for b in range(256)
)


class Shapes(dict):
    """Word (bytes) to hashed shape and coarse marks: letters by case, digits, signs as they are."""

    def __init__(self, most: int = 400_000):
        self.most, self.shapes = most, {}

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
            self.shapes.clear()
        shape = word.translate(_CLASSES)
        value = self.shapes.get(shape)
        if value is None:
            value = self.shapes[shape] = self._of(shape)
        self[word] = value
        return value

    @staticmethod
    def _of(shape: bytes) -> int:
        digits = shape.count(b"d")
        short = re.sub(rb"d{5,}", b"ddddd", re.sub(rb"([Xx])\1+", rb"\1", shape))
        core = short.strip(b" .,;:!?()[]{}<>\"'-")
        # Emails and numbers with written-out dots: one shape however long their parts, whatever stands around them.
        if b"@" in core:
            short = re.sub(rb"(?:x\.)+x", b"x.x", re.sub(rb"[Xxd_%+'-]+", b"x", core))
        elif re.search(rb"d[\[(](?:\.|x+)[\])]d", core):
            short = re.sub(rb"d+", b"d", core)
        size = 0 if not digits else 1 + int(np.searchsorted((2, 4, 7, 15), digits))
        return zlib.crc32(short) % SHAPES | (size << 2 | (b"@" in shape) << 1 | (b"+" in shape)) << 12


class Field(NamedTuple):
    """Weights: shape of the word, of the one before and after, marks; transitions; first state."""

    here: np.ndarray
    before: np.ndarray
    after: np.ndarray
    marks: np.ndarray
    moves: np.ndarray
    first: np.ndarray


STATES = len(KINDS) + 1  # none, then the kinds


def _empty() -> Field:
    return Field(*[np.zeros((n, STATES), np.float32) for n in (SHAPES, SHAPES + 1, SHAPES + 1, 32, STATES)], np.zeros(STATES, np.float32))


def _around(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Shapes here, before, after (SHAPES beyond a sequence's ends) and marks of flat sequences."""
    shape = ids & (SHAPES - 1)
    before, after = np.concatenate([[SHAPES], shape[:-1]]), np.concatenate([shape[1:], [SHAPES]])
    before[starts], after[ends] = SHAPES, SHAPES
    return shape, before, after, ids >> 12


def scores(field: Field, around: tuple[np.ndarray, ...]) -> np.ndarray:
    here, before, after, marks = around
    return field.here[here] + field.before[before] + field.after[after] + field.marks[marks]


def viterbi(field: Field, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best states of flat sequences and each word's lead of its state over none; sequences are
    walked together, longest first, so that no step works on one that has ended."""
    starts = np.cumsum(lengths) - lengths
    emitted = scores(field, _around(ids, starts, starts + lengths - 1))
    out = np.zeros(len(ids), np.int8)
    order = np.argsort(-lengths, kind="stable")
    for group in (order[at : at + 2048] for at in range(0, len(order), 2048)):
        begin, length = starts[group], lengths[group]
        longest = int(length[0])
        live = np.searchsorted(-length, -np.arange(longest), side="left")  # sequences longer than t
        best = field.first + emitted[begin]
        back = [None]
        for t in range(1, longest):
            n = live[t]
            ways = best[:n, :, None] + field.moves[None]
            came = ways.argmax(1)
            back.append(came.astype(np.int8))
            best[:n] = np.take_along_axis(ways, came[:, None, :], 1)[:, 0] + emitted[begin[:n] + t]
        state = best.argmax(1)
        for t in range(longest - 1, -1, -1):
            n = live[t]
            out[begin[:n] + t] = state[:n]
            if t:
                state[:n] = np.take_along_axis(back[t], state[:n, None], 1)[:, 0]
    return out, emitted[np.arange(len(out)), out] - emitted[:, 0]


def train(sequences: list[tuple[list[int], list[int]]], rounds: int = 60, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Maximum likelihood on (shape ids, states), by forward and backward sums over padded sequences."""
    field = _empty()
    sequences = [s for s in sequences if s[0]]
    if not sequences:
        return field
    n, width = len(sequences), max(len(s[0]) for s in sequences)
    lengths = np.array([len(s[0]) for s in sequences])
    ids, gold = np.concatenate([np.array(s[0]) for s in sequences]), np.concatenate([np.array(s[1]) for s in sequences])
    starts = np.cumsum(lengths) - lengths
    around = _around(ids, starts, starts + lengths - 1)
    inside = np.arange(width)[None, :] < lengths[:, None]
    tables = [field.here, field.before, field.after, field.marks]
    squares = [np.full(t.shape, 1e-6) for t in (*tables, field.moves, field.first)]
    truth = np.zeros((len(gold), STATES))
    truth[np.arange(len(gold)), gold] = 1
    pairs = np.zeros((STATES, STATES))
    follows = np.ones(len(gold), bool)
    follows[starts] = False
    np.add.at(pairs, (gold[np.flatnonzero(follows) - 1], gold[follows]), 1)
    opening = np.bincount(gold[starts], minlength=STATES)
    for _ in range(rounds):
        e = np.zeros((n, width, STATES))
        e[inside] = scores(field, around)
        moves = field.moves.astype(float)
        forward, backward = np.zeros_like(e), np.zeros_like(e)
        forward[:, 0] = field.first + e[:, 0]
        for t in range(1, width):
            forward[:, t] = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves[None], 1) + e[:, t]
        for t in range(width - 2, -1, -1):
            step = np.logaddexp.reduce(moves[None] + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where((t + 1 < lengths)[:, None], step, 0)
        total = np.logaddexp.reduce(forward[np.arange(n), lengths - 1], 1)
        share = np.exp(forward + backward - total[:, None, None])[inside]
        expected = np.zeros((STATES, STATES))
        for t in range(1, width):
            on = t < lengths
            expected += np.exp(forward[on, t - 1, :, None] + moves[None] + (e[on, t] + backward[on, t])[:, None, :] - total[on, None, None]).sum(0)
        miss = truth - share
        slopes = [np.stack([np.bincount(index, miss[:, s], minlength=len(table)) for s in range(STATES)], 1) for index, table in zip(around, tables)]
        slopes += [pairs - expected, opening - share[starts].sum(0)]
        for table, square, slope in zip((*tables, field.moves, field.first), squares, slopes):
            slope = slope / n - decay * table
            square += slope**2
            table += (rate * slope / np.sqrt(square)).astype(np.float32)
    return field


def _lines(cell: bytes, most: int) -> Iterator[list[bytes]]:
    """The words of each line, long lines in parts: the sequences of the field."""
    for line in cell.split(b"\n"):
        words = line.split()
        for at in range(0, len(words), most):
            yield words[at : at + most]


def labelled_lines(docs: DataFrame, most: int = 1500) -> DataFrame:
    """A small labelled table (text, spans): lines of about ``most`` documents with a pattern's span
    and as many without one, spans as the patterns say."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text, has in zip(frame["text"], frame["has"]):
                # One line in ten of those without a span, by its own hash.
                for line in re.split(r"\n", text):
                    spans = base_spans(line)
                    if spans or zlib.crc32(line.encode()) % 10 == 0:
                        out.append((line, written(spans)))
            yield pd.DataFrame(out, columns=["text", "spans"])

    marked = docs.select("doc_id", "text").filter("text is not null").withColumn("has", F.col("text").rlike(r"@[A-Za-z0-9-]+\.|[0-9][0-9 ().-]{6,}[0-9]"))
    return sample_by(marked, "has", "doc_id", most).select("text", "has").mapInPandas(rows, "text string, spans string")


def written_lines() -> list[tuple[str, str]]:
    """A small labelled table (text, spans) of forms that the patterns miss, and lines without a span."""
    names = "josé m.müller françois.dupré søren_k zoë-1 иван 李雷 o'né anaïs22".split()
    hosts = "ejemplo.es bücher.de mail.exämple.org пример.рф a-b.example.co.uk".split()
    numbers = ["7", "42", "190"]
    marks = ["[.]", "(.)", "[dot]"]
    found = [("email", f"{name}@{host}") for name in names for host in hosts]
    found += [("ip", mark.join(parts)) for mark in marks for parts in itertools.product(numbers, repeat=4)]
    frames = ["{}", "write to {} today", "Contact: {}, or call", "the host ({}) is down", "from {} we heard that"]
    out = []
    for k, (kind, text) in enumerate(found):
        frame = frames[k % len(frames)]
        at = frame.index("{")
        out.append((frame.format(text), f"{kind}:{at}:{at + len(text)}"))
    plain = ["write to them today", "see [1] and (2) there", "he said @home and @work", "at 5 @ 3.50 each", "version 1.2.3 [beta]", "a[0] b[1](2) dot", "the host is down", "from there we heard that"]
    return out + [(text, "") for text in plain]


def learn(labelled: DataFrame, most_words: int = 40, most_lines: int = 3000) -> Field:
    """Fit on a small table (text, spans): around each span, and lines without one. The written lines
    come first."""
    table = labelled.select("text", "spans").orderBy(F.xxhash64("text", "spans")).limit(most_lines * 2).toPandas()
    with_, without, shapes = [], [], Shapes()
    for text, spans in [*written_lines(), *zip(table["text"], table["spans"])]:
        tokens = list(TOKEN.finditer(text))
        states = np.zeros(len(tokens), int)
        for span in filter(None, spans.split(",")):
            kind, start, end = span.split(":")
            states[[k for k, t in enumerate(tokens) if t.start() < int(end) and t.end() > int(start)]] = KINDS.index(kind) + 1
        ids = [shapes[t[0].encode()] for t in tokens]
        for at in range(0, len(ids), most_words):
            part = ids[at : at + most_words], states[at : at + most_words].tolist()
            (with_ if any(part[1]) else without).append(part)
    return train(with_[:most_lines] + without[: max(200, len(with_[:most_lines]))])


def find(docs: DataFrame, field: Field, lead: float = 2.0, most_words: int = 200) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Patterns are searched in the whole text (NULL: empty), per kind leftmost and without overlap;
    matches that fail their check are dropped, with no second try inside them. Counts and hash are of
    these. The field then labels the words of every line; a run of words of one kind is added to
    ``spans`` if its lead over no label is ``lead`` per word at least, its text passes the kind's
    check, and it touches no span of a pattern. Words labelled email or ip are taken one by one, under
    checks looser than the patterns (letters of all scripts, dots written as [.], (.) or [dot]). Rows that repeat are searched each; other columns are
    not read; an empty table gives no rows.
    """
    edges = " .,;:!?()[]{}<>\"'-"

    def added(text: str, states: np.ndarray, leads: np.ndarray, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        tokens, out, k = list(TOKEN.finditer(text)), [], 0
        while k < len(states):
            end, kind = k + 1, KINDS[int(states[k]) - 1]
            # An email or an address is one word; numbers may be several.
            while end < len(states) and states[end] == states[k] and kind in ("card", "phone"):
                end += 1
            if states[k] and leads[k:end].mean() >= lead:
                start, stop = tokens[k].start(), tokens[end - 1].end()
                found = text[start:stop]
                left = edges.replace("(", "") if kind in ("card", "phone") else edges
                start, stop = start + len(found) - len(found.lstrip(left)), stop - len(found) + len(found.rstrip(edges))
                if start < stop and fits(kind, text[start:stop]) and not any(a < stop and start < b for _, a, b in taken):
                    out.append((KINDS.index(kind), start, stop))
            k = end
        return out

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                texts = [text or "" for text in part.column("text").to_pylist()]
                lines = [list(_lines(text.encode(), most_words)) for text in texts]
                lengths = np.array([len(line) for own in lines for line in own], np.int64)
                ids = np.fromiter((shapes[word] for own in lines for line in own for word in line), np.int64, int(lengths.sum()))
                states, leads = viterbi(field, ids, lengths) if len(ids) else (np.zeros(0, np.int8), np.zeros(0))
                ends = np.cumsum([sum(map(len, own)) for own in lines])
                out: list[list] = [[] for _ in range(7)]
                for text, end, own in zip(texts, ends, lines):
                    begin = end - sum(map(len, own))
                    base = base_spans(text)
                    more = added(text, states[begin:end], leads[begin:end], base) if states[begin:end].any() else []
                    kinds = [k for k, _, _ in base]
                    row = (*[kinds.count(k) for k in range(len(KINDS))], hashlib.sha256(written(base).encode()).hexdigest(), written(base + more), len(more))
                    for column, value in zip(out, row):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in out[:4]], pa.array(out[4], pa.string()), pa.array(out[5], pa.string()), pa.array(out[6], pa.int64())],
                    names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
                )

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, schema)
