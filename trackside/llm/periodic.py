"""Operator 13: periodic runs of words, by enumerating maximal pairs over an LCP-interval tree."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trackside.llm.common import utf8_cells
from trackside.llm.substring import WordHashes, mixed, sequences


class Runs(NamedTuple):
    """A run has at least ``least`` words and repeats its period at least twice."""

    least: int = 12

    @property
    def gram(self) -> int:
        """Two places of a run that lie a period q apart share its length less q words: with a length of
        max(least, 2 q) or more that is never below half of ``least``."""
        return max(1, (self.least + 1) // 2)


def _ranks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return np.unique(first.astype(np.int64) * (int(second.max(initial=0)) + 2) + second + 1, return_inverse=True)[1]


def _shifted(ranks: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate([ranks[by:], np.full(min(by, len(ranks)), -1, ranks.dtype)])


def gram_ranks(ids: np.ndarray, length: int) -> np.ndarray:
    """A rank per place, equal where the next ``length`` words are."""
    power, have, done, out = ids, 1, 0, None
    while have <= length:
        if length & have:
            out, done = (power, have) if out is None else (_ranks(out, _shifted(power, done)), done + have)
        if 2 * have <= length:
            power = _ranks(power, _shifted(power, have))
        have *= 2
    return out


def suffixes(ids: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The places whose next ``gram`` words stand at another place too, in the order of their
    suffixes, and how many words each shares with the one after it (0 where fewer than ``gram``).

    Every text ends in a number of its own, so no shared words reach over an end. Ranks of doubled
    length are taken of places that are still alike only; all levels are kept to measure what
    neighbours share.
    """
    rank = gram_ranks(ids, gram)
    sizes = np.bincount(rank)
    # The rank of a class is the place of its first suffix in the order.
    rank = (np.cumsum(sizes) - sizes)[rank]
    open_ = chosen = np.flatnonzero(sizes[np.unique(rank, return_inverse=True)[1]] > 1)
    levels, have = [(gram, rank)], gram
    while len(open_):
        one, two = rank[open_], rank[open_ + have]
        order = np.lexsort((two, one))
        open_, one, two = open_[order], one[order], two[order]
        at = np.arange(len(open_))
        old = np.concatenate([[True], one[1:] != one[:-1]])
        new = old | np.concatenate([[True], two[1:] != two[:-1]])
        place = one + at - np.maximum.accumulate(np.where(old, at, 0))
        head = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[open_] = place[head]
        have *= 2
        levels.append((have, rank))
        alone = new & np.append(new[1:], True)
        open_ = open_[~alone]
    order = chosen[np.argsort(rank[chosen], kind="stable")]
    one, two = order[:-1].copy(), order[1:].copy()
    shared, last = np.zeros(len(one), np.int64), len(ids) - 1
    for length, by in reversed(levels):
        same = by[np.minimum(one, last)] == by[np.minimum(two, last)]
        shared[same] += length
        one[same] += length
        two[same] += length
    left = shared >= gram
    for _ in range(gram - 1):
        left &= ids[np.minimum(one, last)] == ids[np.minimum(two, last)]
        shared += left
        one += left
        two += left
    return order, np.append(np.where(shared >= gram, shared, 0), 0)


class _Places:
    """Places below a node of the tree: all of them, and lists by the word to their left."""

    __slots__ = ("all", "by_left")

    def __init__(self, place: int, left: int):
        self.all, self.by_left = [place], {left: [place]}


def _join(one: _Places, two: _Places, depth: int, least: int, before: list[int], found: list[tuple[int, int, int]]) -> _Places:
    """Add the smaller node's places to the larger one's. Pairs across them share exactly ``depth`` words
    to the right; those with unlike words to the left are maximal. Kept are those at most ``depth`` apart
    whose whole stretch has ``least`` words: runs, as they are."""
    if len(one.all) < len(two.all):
        one, two = two, one
    large, classes = one.all, one.by_left
    for left, places in two.by_left.items():
        if len(classes) == 1 and left in classes:
            continue
        for p in places:
            begin, end = bisect_left(large, p - depth), bisect_right(large, p + depth)
            if begin == end:
                continue
            if end - begin <= len(classes):
                near = [q for q in large[begin:end] if before[q] != left]
            else:
                near = [q for other, qs in classes.items() if other != left for q in qs[bisect_left(qs, p - depth) : bisect_right(qs, p + depth)]]
            found += [(min(p, q), abs(p - q), depth) for q in near if abs(p - q) + depth >= least]
    for left, places in two.by_left.items():
        mine = classes.get(left)
        if mine is None:
            classes[left] = places
        else:
            for p in places:
                insort(mine, p)
    for p in two.all:
        insort(large, p)
    return one


def maximal_pairs(order: np.ndarray, shared: np.ndarray, left: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(place, distance, shared words) of the maximal pairs that are runs, from the LCP-interval tree.

    The tree is walked from its leaves up with a stack of open intervals; a place is moved to a larger
    list at most as often as lists can double.
    """
    stack: list[tuple[int, _Places]] = []
    found: list[tuple[int, int, int]] = []
    before = left.tolist()
    for place, depth in zip(order.tolist(), shared.tolist()):
        node = _Places(place, before[place])
        while stack and stack[-1][0] > depth:
            closed, other = stack.pop()
            node = _join(other, node, closed, least, before, found)
        if depth:
            if stack and stack[-1][0] == depth:
                node = _join(stack.pop()[1], node, depth, least, before, found)
            stack.append((depth, node))
    return found


def runs_of(texts: list[list], settings: Runs) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of words, by start and period."""
    ids: list[int] = []
    starts, number = [], 0
    for words in texts:
        known: dict = {}
        starts.append(len(ids))
        ids += [known.setdefault(word, number + len(known)) for word in words]
        ids.append(number + len(known))
        number += len(known) + 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not ids:
        return out
    numbers = np.array(ids, np.int64)
    order, shared = suffixes(numbers, settings.gram)
    # Left of a text's first word is the end of the text before it, a number of its own.
    left = np.concatenate([[-1], numbers[:-1]])
    periods: dict[tuple[int, int], int] = {}
    for place, distance, length in maximal_pairs(order, shared, left, settings.least):
        key = place, distance + length
        periods[key] = min(distance, periods.get(key, distance))
    for (place, length), period in sorted(periods.items(), key=lambda x: (x[0][0], x[1])):
        text = bisect_right(starts, place) - 1
        out[text].append((place - starts[text], length, period))
    return out


def may_repeat(hashes: list[np.ndarray], gram: int) -> np.ndarray:
    """Which texts have ``gram`` equal words in a row at two places; equal hashes may add some."""
    rows = [sequences(h, gram, 17) for h in hashes]
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    if not len(row):
        return np.zeros(len(rows), bool)
    flat = np.concatenate(rows)
    own = mixed(flat + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own)
    row, own = row[order], own[order]
    same = (own[1:] == own[:-1]) & (row[1:] == row[:-1])
    return np.bincount(row[1:][same], minlength=len(rows)) > 0


def _kept(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [word for word, over in zip(words, np.cumsum(change).tolist()) if not over]


def find_runs(docs: DataFrame, settings: Runs = Runs(), change: Callable[[int | None, list[bytes]], list[bytes]] | None = None, together: int = 60_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (structs of start, length, period by start, then
    period), collapsed (the words that no run contains after its first period, joined by a blank).

    A run is a stretch of words with smallest period q, at least ``least`` and 2 q words long, that
    neither neighbour extends. ``change`` may put other words in place of a row's own before. NULL and
    empty texts have no words; rows without doc_id and rows that repeat are searched each; other columns
    are not read; an empty table gives no rows. Runs of texts lie within texts: nothing is shuffled, and
    texts of about ``together`` words are searched at once (a longer one alone).

    Two places a period apart are a pair of suffixes: the words they share to the right and their distance
    make the stretch, unlike words on both sides make it maximal. So the maximal pairs at most as far
    apart as the words they share are the runs; a stretch that several distances give has the smallest
    as its period, the others are multiples of it.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        held: list[tuple] = []

        def searched() -> pa.RecordBatch:
            texts = [words for _, words in held]
            found: list[list] = [[] for _ in texts]
            some = np.flatnonzero(may_repeat([known.of(words) for words in texts], settings.gram)).tolist()
            for k, runs in zip(some, runs_of([texts[k] for k in some], settings)):
                found[k] = runs
            columns = [
                pa.array([doc for doc, _ in held], pa.int64()),
                pa.array([len(words) for words in texts], pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), run)) for run in runs] for runs in found], RUNS),
                pa.array([b" ".join(_kept(words, runs)).decode() for words, runs in zip(texts, found)], pa.string()),
            ]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

        size = 0
        for batch in batches:
            for doc, cell in zip(batch.column("doc_id").to_pylist(), utf8_cells(batch.column("text"))):
                words = bytes(cell).split()
                held.append((doc, change(doc, words) if change else words))
                size += len(words) + 1
                if size >= together:
                    size = 0
                    yield searched()
        if held:
            yield searched()

    picked = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return picked.mapInArrow(rows, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
