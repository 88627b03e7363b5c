"""Operator 4: repeated word windows, found behind a count-min prefilter."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.llm.common import utf8_cells


class WordHashes(dict):
    """Word (bytes) to 64-bit hash; kept while a task runs, up to ``most`` words."""

    def __init__(self, most: int = 400_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, as far as they were asked for."""

    def __init__(self, seed: int):
        self.base = int(np.random.default_rng(seed).integers(1, 2**63, dtype=np.uint64)) * 2 + 1 & 2**64 - 1
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            rows = [np.cumprod(np.array([1] + [x] * (n - 1), np.uint64)) for x in (self.base, pow(self.base, -1, 2**64))]
            self.up, self.down = rows
        return self.up, self.down


_POWERS: dict[int, Powers] = {}


def sequences(hashes: np.ndarray, length: int, seed: int) -> np.ndarray:
    """A hash of every run of ``length`` words: a polynomial in an odd number of its words' hashes
    modulo 2^64, from one running sum, spread over all bits."""
    n = len(hashes) - length + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    if seed not in _POWERS:
        _POWERS[seed] = Powers(seed)
    up, down = _POWERS[seed].upto(len(hashes))
    running = np.cumsum(hashes * up[: len(hashes)])
    total = running[length - 1 :].copy()
    total[1:] -= running[:-length]
    return mixed(total * down[:n])


def _sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """The least (or largest) of every ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        x, size = least(x[:-size], x[size:]), 2 * size
    return least(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def anchors(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of every window, the smallest hash of a gram in it, and the hashes of the places
    that are some window's anchor, each place once.

    Equal windows have equal anchors at the same place within them, so an anchor occurs at least as
    often as each of its windows. Neighbouring windows mostly share theirs.
    """
    if len(hashes) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams, width = sequences(hashes, gram, 5), window - gram + 1
    least = _sliding(grams, width, np.minimum)
    # A place is an anchor if one of the windows over it has its hash; none has a larger one.
    edge = np.zeros(width - 1, np.uint64)
    return least, grams[_sliding(np.concatenate([edge, least, edge]), width, np.maximum) == grams]


class Sketch:
    """Count-min sketch whose counters stop at 2, as two bit maps per row: seen, seen again.

    Estimates never lie below the true count (as far as 2), and neither do those of merged sketches.
    """

    SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0x3C6EF372FE94F82A))
    ROWS = len(SEEDS)

    def __init__(self, bits: int, seen: np.ndarray | None = None, again: np.ndarray | None = None):
        self.bits, self.frequent = bits, np.zeros(0, np.uint64)
        self.seen = np.zeros((self.ROWS, 1 << bits - 3), np.uint8) if seen is None else seen
        self.again = np.zeros((self.ROWS, 1 << bits - 3), np.uint8) if again is None else again

    def _cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        return mixed(hashes + self.SEEDS[row]) >> np.uint64(64 - self.bits)

    @staticmethod
    def _has(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
        return (bits[cells >> np.uint64(3)] >> (cells & np.uint64(7)).astype(np.uint8)) & 1 > 0

    @staticmethod
    def _set(bits: np.ndarray, cells: np.ndarray) -> None:
        if len(cells):  # cells are sorted: those of one byte stand together
            places, first = np.unique(cells >> np.uint64(3), return_index=True)
            bits[places] |= np.bitwise_or.reduceat(np.left_shift(np.uint8(1), (cells & np.uint64(7)).astype(np.uint8)), first)

    def add(self, hashes: np.ndarray) -> None:
        for row in range(self.ROWS):
            cells, counts = np.unique(self._cells(hashes, row), return_counts=True)
            self._set(self.again[row], cells[(counts > 1) | self._has(self.seen[row], cells)])
            self._set(self.seen[row], cells)

    def repeated(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for row in range(self.ROWS):
            found &= self._has(self.again[row], self._cells(hashes, row))
        return found


class Frequent:
    """Anchors that come often, with how often: those with ``least`` places in a flush, the ``most``
    commonest of them. Only the load of buckets depends on them, no result."""

    def __init__(self, most: int = 4096, least: int = 3):
        self.most, self.least = most, least
        self.anchors, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, hashes: np.ndarray) -> None:
        values, counts = np.unique(hashes, return_counts=True)
        often = counts >= self.least
        self.join(values[often], counts[often], 16 * self.most)

    def join(self, anchors: np.ndarray, counts: np.ndarray, most: int) -> None:
        values, place = np.unique(np.concatenate([self.anchors, anchors]), return_inverse=True)
        total = np.bincount(place, np.concatenate([self.counts, counts]), len(values)).astype(np.int64)
        top = np.sort(np.argsort(-total, kind="stable")[:most])
        self.anchors, self.counts = values[top], total[top]

    def written(self) -> tuple[bytes, bytes]:
        self.join(self.anchors[:0], self.counts[:0], self.most)
        return self.anchors.tobytes(), self.counts.tobytes()


def _merge(parts: pd.DataFrame) -> tuple[bytes, bytes]:
    """Bit maps of one slice from several sketches: counts are added, as far as 2. Slice -1 has the
    frequent anchors."""
    if parts["slice"].iloc[0] < 0:
        frequent = Frequent()
        for one, two in zip(parts["seen"], parts["again"]):
            frequent.join(np.frombuffer(one, np.uint64), np.frombuffer(two, np.int64), 16 * frequent.most)
        return frequent.written()
    seen = again = None
    for one, two in zip(parts["seen"], parts["again"]):
        one, two = np.frombuffer(zlib.decompress(one), np.uint8), np.frombuffer(zlib.decompress(two), np.uint8)
        seen, again = (one, two) if seen is None else (seen | one, again | two | (seen & one))
    return zlib.compress(seen.tobytes(), 1), zlib.compress(again.tobytes(), 1)


class Windows:
    """Settings of the search: windows of ``length`` words, anchors of ``gram`` words."""

    def __init__(self, length: int = 13, gram: int = 5, most_bits: int = 28):
        self.length, self.gram, self.most_bits = length, min(gram, length), most_bits

    def bits(self, n_bytes: int) -> int:
        """Cells of a sketch row as a power of two: over twice the anchors, as far as ``most_bits``."""
        return int(np.clip(np.ceil(np.log2(max(1, n_bytes) / 12)), 16, self.most_bits))


def _documents(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("raw"), text.alias("text"))


def anchor_sketch(docs: DataFrame, windows: Windows, bits: int, slices: int = 64, groups: int = 32) -> Sketch:
    """One sketch of the anchors of all documents, with the ``frequent`` ones: every task sketches its
    own, slices are merged by groups of tasks and then whole. Of fixed size, so it may pass through
    the driver."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sketch, known, held, task = Sketch(bits), WordHashes(), [], TaskContext.get().partitionId()
        some, frequent = False, Frequent()

        def flush() -> None:
            if held:
                hashes = np.concatenate(held)
                sketch.add(hashes)
                frequent.add(hashes)
                held.clear()

        for batch in batches:
            some = some or batch.num_rows > 0
            for cell in utf8_cells(batch.column("text")):
                held.append(anchors(known.of(bytes(cell).split()), windows.length, windows.gram)[1])
                if len(held) >= 500:
                    flush()
        flush()
        if some:
            parts = [[cell] for cell in frequent.written()]
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([task % groups], pa.int32()), *[pa.array(p, pa.binary()) for p in parts]], names=["slice", "part", "seen", "again"])
            size = sketch.seen.shape[1] // slices
            for k in range(slices):
                cut = slice(k * size, (k + 1) * size)
                parts = [[zlib.compress(x[:, cut].tobytes(), 1)] for x in (sketch.seen, sketch.again)]
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([task % groups], pa.int32()), *[pa.array(p, pa.binary()) for p in parts]], names=["slice", "part", "seen", "again"])

    def merged(parts: pd.DataFrame) -> pd.DataFrame:
        seen, again = _merge(parts)
        return pd.DataFrame({"slice": [parts["slice"].iloc[0]], "part": [0], "seen": [seen], "again": [again]})

    schema = "slice int, part int, seen binary, again binary"
    by_task = docs.select("text").mapInArrow(sketched, schema)
    whole = by_task.groupBy("slice", "part").applyInPandas(merged, schema).groupBy("slice").applyInPandas(merged, schema)
    sent = whole.select("slice", F.when(F.col("slice") < 0, F.col("seen")).alias("seen"), "again").toPandas().sort_values("slice")
    common, found = sent[sent["slice"] < 0], sent[sent["slice"] >= 0]
    size = (1 << bits - 3) // slices
    again = np.zeros((Sketch.ROWS, 1 << bits - 3), np.uint8)
    for k, cell in zip(found["slice"], found["again"]):
        again[:, k * size : (k + 1) * size] = np.frombuffer(zlib.decompress(cell), np.uint8).reshape(Sketch.ROWS, size)
    out = Sketch(bits, again[:, :0], again)
    out.frequent = np.frombuffer(b"".join(common["seen"]), np.uint64)
    return out


COLUMNS = ["doc_id", "raw", "at", "more", "a", "b"]


def _blobs(bucket: int, sure: bool, columns: list[np.ndarray]) -> tuple:
    return (bucket, sure, *[c.tobytes() for c in columns])


def _joined(keys: list[np.ndarray], at: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that start a run of places with equal keys, and how far the run's last place is from its
    first. Rows are sorted by keys and place; places up to ``gap`` apart are one run, because windows
    of that length over them have all words in between."""
    apart = np.concatenate([[True], at[1:] > at[:-1] + gap])[: len(at)]
    for key in keys:
        apart[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(apart)
    return first, at[np.append(first[1:], len(at)) - 1] - at[first] if len(first) else at


def _candidates(docs: DataFrame, windows: Windows, sketch: Sketch, buckets: int, most: int = 400_000) -> DataFrame:
    """Windows with a repeated anchor, as columns of numbers per bucket of anchors. Windows of a
    frequent anchor, which also those have that only touch a common passage, are dealt by their own
    hash.

    Each task first settles what it can: a window that it also has with a smaller doc_id is sure to
    go. Such windows become runs of their text, which go to any bucket, by a hash of the text; only
    the occurrence with the smallest doc_id goes to the window's bucket, repeats of it over the
    same words as one. A window that a third of all documents share meets there once per ``most``
    windows, or text longer than that; a window that a text repeats further apart than its length
    once per place in that text.
    """
    shared = docs.sparkSession.sparkContext.broadcast((sketch.again, sketch.frequent))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again, frequent = shared.value
        known, sketch = WordHashes(), Sketch(windows.bits_used, again[:, :0], again)
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            bucket, doc, raw, at, a, b = (np.concatenate(c) for c in zip(*held))
            held.clear()
            order = np.lexsort((doc, b, a))
            bucket, doc, raw, at, a, b = (c[order] for c in (bucket, doc, raw, at, a, b))
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            least = np.repeat(doc[new], np.diff(np.append(new, len(a))))
            out = []
            for sure in (False, True):
                mine = np.flatnonzero((doc > least) == sure)
                if not len(mine):
                    continue
                mine = mine[np.lexsort((at[mine], raw[mine], doc[mine], *([] if sure else [b[mine], a[mine]])))]
                first, more = _joined([c[mine] for c in ((doc, raw) if sure else (a, b, doc, raw))], at[mine], windows.length)
                mine = mine[first]
                to = (mixed((doc[mine] ^ raw[mine]).view(np.uint64)) % np.uint64(buckets)).astype(np.int64) if sure else bucket[mine]
                order = np.lexsort((at[mine], raw[mine], doc[mine], to))
                mine, more, to = mine[order], more[order].astype(np.int32), to[order]
                edges = np.flatnonzero(np.diff(to, prepend=-1))
                for begin, end in zip(edges.tolist(), np.append(edges[1:], len(mine)).tolist()):
                    own = mine[begin:end]
                    out.append(_blobs(int(to[begin]), sure, [doc[own], raw[own], at[own], more[begin:end], *([a[own], b[own]] if not sure else [a[:0], b[:0]])]))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.bool_()), *[pa.array(c, pa.binary()) for c in columns[2:]]], names=["bucket", "sure", *COLUMNS]
            )

        size = 0
        for batch in batches:
            for doc, raw, cell in zip(batch.column("doc_id").to_pylist(), batch.column("raw").to_pylist(), utf8_cells(batch.column("text"))):
                hashes = known.of(bytes(cell).split())
                anchor = anchors(hashes, windows.length, windows.gram)[0]
                if not len(anchor):
                    continue
                first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
                open_ = np.flatnonzero(np.repeat(sketch.repeated(anchor[first]), np.diff(np.append(first, len(anchor)))))
                if not len(open_):
                    continue
                a, b = (sequences(hashes, windows.length, seed)[open_].view(np.int64) for seed in (13, 31))
                n, dealt = len(open_), anchor[open_]
                if len(frequent):
                    hot = frequent[np.minimum(np.searchsorted(frequent, dealt), len(frequent) - 1)] == dealt
                    dealt = np.where(hot, mixed(a.view(np.uint64)), dealt)
                held.append(((dealt % np.uint64(buckets)).astype(np.int64), np.full(n, doc, np.int64), np.full(n, raw, np.int64), open_.astype(np.int32), a, b))
                size += n
                if size >= most:
                    size = 0
                    yield from flush()
        yield from flush()

    return docs.filter("doc_id is not null").mapInArrow(rows, "bucket long, sure boolean, doc_id binary, raw binary, at binary, more binary, a binary, b binary")


def _repeats(group: pd.DataFrame) -> pd.DataFrame:
    """Runs of windows (doc_id, raw, start, stop) of one bucket that also start in a smaller doc_id."""
    numbers = lambda frame, name, kind: np.frombuffer(b"".join(frame[name]), kind)
    sent, sure = group[~group["sure"]], group[group["sure"]]
    kinds = dict(zip(COLUMNS, (np.int64, np.int64, np.int32, np.int32, np.int64, np.int64)))
    doc, raw, at, more, a, b = (numbers(sent, n, k) for n, k in kinds.items())
    order = np.lexsort((doc, b, a))
    new = np.flatnonzero(np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])) if len(a) else np.zeros(0, int)
    later = order[doc[order] > np.repeat(doc[order][new], np.diff(np.append(new, len(a))))]
    doc, raw, at, more = (np.concatenate([c[later], numbers(sure, n, kinds[n])]) for c, n in zip((doc, raw, at, more), COLUMNS))
    order = np.lexsort((at, raw, doc))
    doc, raw, at, stop = doc[order], raw[order], at[order], (at + more + 1)[order]
    if not len(doc):
        return pd.DataFrame({"doc_id": doc, "raw": raw, "start": at, "stop": stop})
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (raw[1:] != raw[:-1]) | (at[1:] > stop[:-1])]))
    return pd.DataFrame({"doc_id": doc[first], "raw": raw[first], "start": at[first], "stop": np.maximum.reduceat(stop, first)})


def _cut(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, sha = [], [], []
            for cell, starts, stops in zip(utf8_cells(batch.column("text")), batch.column("starts").to_pylist(), batch.column("stops").to_pylist()):
                words = bytes(cell).split()
                if starts:
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, starts, 1)
                    np.add.at(change, np.array(stops) + (length - 1), -1)
                    stays = np.cumsum(change)[:-1] == 0
                    kept = [word for word, stay in zip(words, stays.tolist()) if stay]
                else:
                    kept = words
                total.append(len(words))
                gone.append(len(words) - len(kept))
                sha.append(b" ".join(kept))
            columns = [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array([s.decode() for s in sha], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_text"])

    return rows


def remove_repeats(docs: DataFrame, windows: Windows | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_text (words joined by a blank).

    A word goes when a window of ``length`` consecutive words over it also starts in a document with
    a smaller doc_id; windows are those of the input. NULL texts have no words; texts shorter than a
    window stay whole; rows without doc_id stay whole and take nothing from others; rows with the
    same doc_id take nothing from each other. Other columns are not read; an empty table gives no rows.

    The first pass counts anchors in a sketch, the second sends only windows whose anchor may occur
    twice, as 128-bit hashes of their words, and groups those exactly. The sketch has a fixed most
    size; where the corpus outgrows it, it lets more windows through and the second pass is larger,
    never wrong.
    """
    windows = windows or Windows()
    rows = _documents(docs)
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    windows.bits_used = windows.bits(n_bytes)
    sketch = anchor_sketch(rows, windows, windows.bits_used)
    # About 400 000 candidates per bucket if a quarter of all words are.
    buckets = max(16, n_bytes // 10_000_000)
    candidates = _candidates(rows, windows, sketch, buckets)
    runs = candidates.groupBy("bucket").applyInPandas(_repeats, "doc_id long, raw long, start int, stop int")
    per_text = runs.groupBy(F.col("doc_id").alias("_id"), F.col("raw").alias("_raw")).agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    joined = rows.join(per_text, (F.col("doc_id") == F.col("_id")) & (F.col("raw") == F.col("_raw")), "left")
    return joined.select("doc_id", "text", F.col("runs.start").alias("starts"), F.col("runs.stop").alias("stops")).mapInArrow(_cut(windows.length), "doc_id long, n_words long, n_removed long, kept_text string")
