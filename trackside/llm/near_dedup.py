"""Operator 6: near duplicates by a chosen-path set similarity join."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackside.llm.common import utf8_cells
from trackside.llm.components import components
from trackside.llm.substring import WordHashes, mixed, sequences
from trackside.session import forget, landed, small_batches


#: Items of a block's sets that are matched at once.
RANGE = 1 << 18


class Settings(NamedTuple):
    """Links need ``share`` of 100 of the union in common; nodes up to ``limit`` texts are compared whole, by one
    task with up to ``shingles`` of them at once."""

    words: int = 5
    share: int = 75
    recall: float = 1 - 1e-6
    sketch: int = 128
    block: int = 512
    limit: int = 4096
    shingles: int = 4_000_000
    splits: int = 2
    depth: int = 12
    seed: int = 6

    levels: int = 2

    @property
    def trees(self) -> int:
        """Half of the misses may be the trees'. A pair at the threshold misses a root with chance
        1 - share/100, and all children of a node too large with that to the power of ``splits``;
        ``levels`` of these are counted."""
        miss = 1 - self.share / 100
        found = (1 - miss) * (1 - miss**self.splits) ** min(self.levels, self.depth)
        return math.ceil(math.log((1 - self.recall) / 2) / math.log(1 - found))

    @property
    def cut(self) -> float:
        """Sketch agreement below which a pair at the threshold falls with half of the misses that the
        recall allows: the sketch is the same in all trees, so they cannot mend it."""
        j, below, agree = self.share / 100, 0.0, 0
        while True:
            below += math.comb(self.sketch, agree) * j**agree * (1 - j) ** (self.sketch - agree)
            if below > (1 - self.recall) / 2:
                return agree / self.sketch
            agree += 1


def shingles(cell: bytes, known: WordHashes, words: int) -> np.ndarray:
    """The distinct runs of ``words`` words, A-Z in lower case, as 64-bit hashes, sorted; the whole
    sequence if it is shorter."""
    hashes = known.of(cell.lower().split())
    return np.unique(sequences(hashes, max(1, min(words, len(hashes))), 100 + min(words, len(hashes))))


class MinHashes:
    """Smallest hashes of a set: 64 bits for each tree's root, one byte each for the sketch."""

    def __init__(self, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        self.roots = rng.integers(1, 2**63, settings.trees, dtype=np.uint64)
        self.factors = rng.integers(1, 2**31, settings.sketch, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.shifts = rng.integers(0, 2**32, settings.sketch, dtype=np.uint32)

    def __call__(self, items: np.ndarray) -> tuple[np.ndarray, bytes]:
        roots = np.array([mixed(items ^ root).min() for root in self.roots])
        low = np.full(len(self.factors), 2**32 - 1, np.uint32)
        short = (items >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(short), 1024):
            np.minimum(low, (short[at : at + 1024, None] * self.factors + self.shifts).min(0), out=low)
        # Equal minima give equal bytes, others agree once in 256.
        return mixed(roots + np.arange(len(roots), dtype=np.uint64)).view(np.int64), ((low * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("raw"), text.alias("text"))


def _sketched(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, raw, cls, n, roots, sketch): cls is a 128-bit digest of the lower-cased words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, least = WordHashes(), MinHashes(settings)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for cell in utf8_cells(batch.column("text")):
                words = bytes(cell)
                items = shingles(words, known, settings.words)
                roots, sketch = least(items) if len(items) else (np.zeros(0, np.int64), b"")
                for column, value in zip(out, (hashlib.blake2b(b" ".join(words.lower().split()), digest_size=16).digest(), len(items), roots.tolist(), sketch)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("raw"), pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.binary())],
                names=["doc_id", "raw", "cls", "n", "roots", "sketch"],
            )

    return _keyed(docs).mapInArrow(rows, "doc_id long, raw long, cls binary, n long, roots array<long>, sketch binary")


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of rows with equal keys, from sorted batches that may cut a run."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        rest = table
        if table.num_rows > 1:
            columns = [table[key].to_numpy() for key in keys]
            same = np.logical_and.reduce([c == c[-1] for c in columns])
            first = table.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
            if first:
                yield table.slice(0, first)
                rest = table.slice(first)
    if rest is not None and rest.num_rows:
        yield rest


def _blocks(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Each block of rows with equal keys as one table, from sorted batches."""
    for table in _runs(batches, keys):
        columns = [table[key].to_numpy() for key in keys]
        new = np.logical_or.reduce([np.concatenate([[True], c[1:] != c[:-1]]) for c in columns])
        starts = np.flatnonzero(new)
        for at, end in zip(starts.tolist(), np.append(starts[1:], len(new)).tolist()):
            yield table.slice(at, end - at)


def _numbered(cells: pa.ChunkedArray) -> np.ndarray:
    return np.unique(np.array(cells.to_pylist(), "S16"), return_inverse=True)[1]


class _Sketches:
    """Sketches of one block's texts: which may be linked with which text of another component."""

    #: Bytes looked at first, and how many of them must agree: at 0.75 fewer do once in 10^8.
    FIRST, LEAST = 32, 8

    def __init__(self, block: pa.Table, settings: Settings):
        self.settings, self.comp, self.n = settings, _numbered(block["comp"]), block["n"].to_numpy()
        self.bytes = np.frombuffer(b"".join(block["sketch"].to_pylist()), np.uint8).reshape(len(self.n), -1)
        self.first = min(self.FIRST, settings.sketch // 4)

    def alike(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For some rows at a time, from the row ``at`` on: pairs (row - at, other row) that may count, and the
        agreement of their sketches."""
        step, share = max(1, (1 << 17) // len(self.n)), self.settings.share
        for at in range(0, len(self.n), step):
            own = slice(at, at + step)
            fits = (self.comp[own, None] != self.comp[None, :]) & (100 * np.minimum(self.n[own, None], self.n[None, :]) >= share * np.maximum(self.n[own, None], self.n[None, :]))
            if fits.sum() * 4 > fits.size:
                near = np.zeros(fits.shape, np.uint8)
                for k in range(self.first):
                    near += self.bytes[own, k, None] == self.bytes[None, :, k]
                i, j = np.nonzero(fits & (near >= self.LEAST * self.first // self.FIRST))
            else:
                i, j = np.nonzero(fits)
            if not len(i):
                continue
            agree = np.concatenate([(self.bytes[own][i[k : k + 20_000]] == self.bytes[j[k : k + 20_000]]).sum(1, dtype=np.uint16) for k in range(0, len(i), 20_000)])
            likely = agree >= self.settings.cut * self.settings.sketch
            yield at, i[likely], j[likely], agree[likely] / np.float32(self.settings.sketch)


def _nearest(blocks: DataFrame, settings: Settings) -> DataFrame:
    """(a, b, alike): of each text its best partner of another component in the block, its node's leader if
    that is close. At most one row per text and block."""
    close = (1 + settings.share / 100) / 2 - 0.05

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, ["node", "block"]):
            if block.num_rows < 2:
                continue
            cls, lead = block["cls"].to_pylist(), block["lead"].to_numpy()
            found: list[tuple] = []
            for at, i, j, agree in _Sketches(block, settings).alike():
                weight = agree + 2 * (lead[j] & (agree >= close))
                order = np.lexsort((-j, weight, i))
                last = order[np.flatnonzero(np.append(i[order][1:] != i[order][:-1], True))] if len(order) else order
                for x, y, share in zip((at + i[last]).tolist(), j[last].tolist(), agree[last].tolist()):
                    found.append((min(cls[x], cls[y]), max(cls[x], cls[y]), share))
            if found:
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.float64())], names=["a", "b", "alike"])

    order = blocks.repartition("node", "block").sortWithinPartitions("node", "block")
    return order.mapInArrow(rows, "a binary, b binary, alike double")


def _likely(blocks: DataFrame, settings: Settings) -> DataFrame:
    """(node, block, cls, comp, n): the texts of each block that may be linked with one of another component
    there. A pair that shares several of the ``nodes`` counts in the smallest, texts of equal ``side`` (but 0)
    count in another block. At most one row per text and block, however many pairs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, ["node", "block"]):
            if block.num_rows < 2:
                continue
            node, side = block["node"][0].as_py(), block["side"].to_pylist()
            places = [set(own) for own in block["nodes"].to_pylist()]
            told = [False] * block.num_rows
            for at, i, j, _ in _Sketches(block, settings).alike():
                for x, y in zip((at + i).tolist(), j.tolist()):
                    if told[x] and told[y] or side[x] and side[x] == side[y]:
                        continue
                    if min(places[x] & places[y]) == node:
                        told[x] = told[y] = True
            if any(told):
                kept = block.filter(pa.array(told)).select(["node", "block", "cls", "comp", "n"]).combine_chunks()
                yield from kept.to_batches()

    order = blocks.repartition("node", "block").sortWithinPartitions("node", "block")
    return order.mapInArrow(rows, "node long, block long, cls binary, comp binary, n long")


def _common(sets: list[np.ndarray], rows: np.ndarray, columns: int) -> np.ndarray:
    """Items that each of ``rows`` has in common with each set: products of 0/1 matrices over the items that
    several sets have, a range of hashes at a time, so that beside the counts little is held at once."""
    m = len(sets)
    common = np.zeros((len(rows), m), np.float32)
    # Items are hashes: ranges of equal width hold about as many each.
    cuts = max(1, sum(len(s) for s in sets) // RANGE)
    inner = np.array([(k << 64) // cuts for k in range(1, cuts)], np.uint64)
    places = np.array([[0, *np.searchsorted(s, inner).tolist(), len(s)] for s in sets], np.int64)
    for k in range(cuts):
        part = [s[a:b] for s, a, b in zip(sets, places[:, k].tolist(), places[:, k + 1].tolist())]
        _, item = np.unique(np.concatenate(part), return_inverse=True)
        row = np.repeat(np.arange(m), places[:, k + 1] - places[:, k])
        several = np.bincount(item) > 1
        place = np.cumsum(several) - 1
        row, item = row[several[item]], place[item[several[item]]]
        order = np.argsort(item, kind="stable")
        row, item = row[order], item[order]
        edges = np.searchsorted(item, np.arange(0, int(several.sum()) + columns, columns))
        for no, (begin, end) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            whole = np.zeros((m, columns), np.float32)
            whole[row[begin:end], item[begin:end] - no * columns] = 1
            for at in range(0, len(rows), 256):
                common[at : at + 256] += whole[rows[at : at + 256]] @ whole.T
    return common


def _forest(sets: list[np.ndarray], comp: np.ndarray, half: np.ndarray, share: int, columns: int = 1024) -> list[tuple[int, int]]:
    """Links (row, row) that join the components of some sets, no more than it takes: fewer than rows.

    Common items are counted for many pairs at once. Rows of the most frequent component are compared with
    the others only, and where ``half`` knows two halves, only across them.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    minor = np.flatnonzero(comp != np.bincount(comp).argmax())
    common = _common(sets, minor, columns)
    root = comp.astype(np.int64).copy()
    links: list[tuple[int, int]] = []
    for at in range(0, len(minor), 256):
        own = minor[at : at + 256]
        both = common[at : at + 256].astype(np.int64)
        linked = (100 * both >= share * (sizes[own, None] + sizes[None, :] - both)) & (comp[own, None] != comp[None, :])
        if half.any():
            linked &= half[own, None] != half[None, :]
        for i, j in zip(*np.nonzero(linked)):
            x, y = int(own[i]), int(j)
            if root[x] != root[y]:
                links.append((x, y))
                root[root == root[y]] = root[x]
    return links


def _joined(members: DataFrame, settings: Settings) -> DataFrame:
    """(a, b): links between components, found on the whole sets of each (node, block, one, two), as few as
    join them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, ["node", "block", "one", "two"]):
            if block.num_rows < 2:
                continue
            cls = block["cls"].to_pylist()
            sets = [np.frombuffer(cell, np.uint64) for cell in block["items"].to_pylist()]
            part = block["part"].to_numpy()
            half = part != block["one"][0].as_py() if block["one"][0].as_py() != block["two"][0].as_py() else np.zeros(len(cls), bool)
            links = [(min(cls[x], cls[y]), max(cls[x], cls[y])) for x, y in _forest(sets, _numbered(block["comp"]), half, settings.share)]
            if links:
                columns = list(zip(*links))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["a", "b"])

    keys = ["node", "block", "one", "two"]
    return members.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(rows, "a binary, b binary")


def _sets(texts: DataFrame, settings: Settings) -> DataFrame:
    """(cls, items) from (cls, text): whole sets, sorted, as little-endian 64-bit numbers."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                items = [shingles(bytes(cell), known, settings.words).tobytes() for cell in utf8_cells(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("cls"), pa.array(items, pa.binary())], names=["cls", "items"])

    return texts.mapInArrow(rows, "cls binary, items binary")


def _confirmed(pairs: DataFrame, settings: Settings) -> DataFrame:
    """(a, b, linked) from (a, b, text_a, text_b): the shares of whole sets."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sets = WordHashes(), {}

        def items(cls: bytes, cell: memoryview) -> np.ndarray:
            if cls not in sets:
                if len(sets) > 200:
                    sets.clear()
                sets[cls] = shingles(bytes(cell), known, settings.words)
            return sets[cls]

        for batch in batches:
            linked = []
            for a, b, one, two in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), utf8_cells(batch.column("text_a")), utf8_cells(batch.column("text_b"))):
                x, y = items(a, one), items(b, two)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= settings.share * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return pairs.mapInArrow(rows, "a binary, b binary, linked boolean")


class _Join:
    """The state of the join: which texts belong together so far, which pairs are settled."""

    def __init__(self, docs: DataFrame, settings: Settings):
        self.docs, self.settings = _keyed(docs), settings
        self.rows = landed(_sketched(docs, settings), "near-rows")
        one = self.rows.filter("n > 0").groupBy("cls").agg(F.min(F.struct("doc_id", "raw", "n", "roots", "sketch")).alias("one"))
        self.classes = landed(one.select("cls", "one.*"), "near-classes")
        self.texts = self.comp = None
        self.read: list[DataFrame] = []

    def components_of(self, members: DataFrame) -> DataFrame:
        if self.comp is None:
            return members.withColumn("comp", F.col("cls"))
        known = self.comp.select(F.col("cls").alias("_cls"), F.col("comp").alias("_comp"))
        return members.join(known, F.col("cls") == F.col("_cls"), "left").withColumn("comp", F.coalesce("_comp", "cls")).drop("_cls", "_comp")

    def open_nodes(self, members: DataFrame) -> DataFrame:
        """Members of nodes with texts of several components: (node, cls, comp, n_node, leader, main, minor)."""
        known = self.components_of(members)
        sizes = known.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("size"), F.min("cls").alias("least"))
        nodes = sizes.groupBy(F.col("node").alias("_node")).agg(
            F.sum("size").alias("n_node"), F.min("least").alias("leader"), F.max(F.struct("size", "comp")).alias("main"), F.count(F.lit(1)).alias("comps")
        )
        mixed = nodes.filter("comps > 1").select("_node", "n_node", "leader", F.col("main.comp").alias("main"), (F.col("n_node") - F.col("main.size")).alias("n_minor"))
        return known.join(mixed, F.col("node") == F.col("_node")).drop("_node")

    def with_sketches(self, members: DataFrame) -> DataFrame:
        own = self.classes.select(F.col("cls").alias("_cls"), "n", "sketch")
        return members.join(own, F.col("cls") == F.col("_cls")).drop("_cls")

    def fetch(self, wanted: DataFrame) -> None:
        """Read the texts of classes that are not read yet."""
        if self.texts is not None:
            wanted = wanted.join(self.texts.select("cls"), "cls", "left_anti")
        places = self.classes.join(wanted, "cls").select("cls", F.col("doc_id").alias("_id"), F.col("raw").alias("_raw"))
        # Both sides grow with the corpus: joined the same way at every size.
        more = self.docs.join(places.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("raw") == F.col("_raw"))).select("cls", "text").dropDuplicates(["cls"])
        more = landed(more, "near-texts")
        self.read.append(more)
        self.texts = more if self.texts is None else self.texts.unionByName(more)

    def settle(self, pairs: DataFrame) -> None:
        """Confirm pairs on whole sets and join the components of those that hold."""
        pairs = landed(pairs.select("a", "b").distinct(), "near-pairs")
        if pairs.isEmpty():
            return
        self.fetch(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct())
        left, right = (self.texts.select(F.col("cls").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
        known = landed(_confirmed(left.join(pairs.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "text_a", "text_b"), self.settings), "near-tested")
        self.link(known.filter("linked").select("a", "b"))
        forget(pairs, known)

    def link(self, links: DataFrame) -> None:
        """Join the components that links connect."""
        if links.isEmpty():
            return
        # Between components known so far: later rounds have few links left.
        between = self.components_of(links.select(F.col("a").alias("cls"), "b")).select(F.col("comp").alias("a"), F.col("b").alias("cls"))
        between = self.components_of(between).select("a", F.col("comp").alias("b"))
        joined = components(between)
        every = links.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        every = every if self.comp is None else every.unionByName(self.comp.select("cls")).distinct()
        moved = joined.select(F.col("node").alias("_node"), "component")
        before, self.comp = self.comp, landed(
            self.components_of(every).join(moved, F.col("comp") == F.col("_node"), "left").select("cls", F.coalesce("component", "comp").alias("comp")), "near-components"
        )
        forget(before, joined)

    def nearest(self, members: DataFrame) -> None:
        """One candidate per text: its best partner among blocks of its nodes."""
        blocks = F.ceil(F.col("n_node") / self.settings.block)
        own = F.array(F.pmod(F.xxhash64("cls", "node"), blocks))
        spread = self.open_nodes(members).withColumn("lead", F.col("cls") == F.col("leader"))
        # A leader of a large node meets every block of it.
        spread = spread.withColumn("block", F.explode(F.when(F.col("lead"), F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(own)))
        found = _nearest(self.with_sketches(spread).select("node", "block", "cls", "comp", "n", "lead", "sketch"), self.settings)
        ends = found.select("a", "b", "alike", F.explode(F.array("a", "b")).alias("cls"))
        best = ends.groupBy("cls").agg(F.max(F.struct("alike", "a", "b")).alias("best"))
        self.settle(best.select("best.a", "best.b"))

    def compare(self, members: DataFrame) -> None:
        """Link texts within blocks of nodes on whole sets. Blocks whose sets do not fit a task are cut into
        parts, which meet two by two."""
        likely = landed(_likely(members, self.settings), "near-likely")
        if likely.isEmpty():
            return
        self.fetch(likely.select("cls").distinct())
        # Classes are distinct on both sides. A semi-join would be made once for each table of texts.
        items = _sets(self.texts.join(likely.select("cls").distinct().hint("merge"), "cls").select("cls", "text"), self.settings)
        # A block has a bounded number of texts, so the window does.
        along = Window.partitionBy("node", "block").orderBy("cls")
        part = F.floor(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, 0)) / self.settings.shingles)
        parts = likely.withColumn("part", part).withColumn("last", F.max("part").over(Window.partitionBy("node", "block")))
        pairs = parts.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
        pairs = pairs.select("node", "block", "cls", "comp", "part", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"))
        links = landed(_joined(pairs.join(items.hint("merge"), "cls"), self.settings), "near-links")
        self.link(links)
        forget(likely, links)

    def whole(self, members: DataFrame, level: int) -> DataFrame | None:
        """Compare open nodes whole; the members of the children of nodes too large and too mixed for it."""
        s = self.settings
        open_ = landed(self.open_nodes(members), "near-open")
        last = level >= s.depth
        fits = (F.col("n_node") <= s.limit) | (F.col("n_minor") <= s.limit) | F.lit(last)
        # Blocks of a node: its few minor texts (not of the main component) meet all of them; where, at the last
        # level, they are many, blocks meet two by two. side: texts of equal side meet in another block.
        blocks = F.ceil(F.col("n_node") / s.limit)
        minor, few = F.col("comp") != F.col("main"), F.col("n_minor") <= s.limit
        each = F.when((blocks == 1) | (few & ~minor), F.array("own")).otherwise(F.sequence(F.lit(0).cast("long"), blocks - 1))
        small = open_.filter(fits).withColumn("own", F.pmod(F.xxhash64("cls", "node"), blocks)).withColumn("other", F.explode(each))
        crossed = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
        small = small.withColumn("block", F.when((blocks == 1) | few, F.col("other")).otherwise(F.least("own", "other") * blocks + F.greatest("own", "other")))
        small = small.withColumn("side", F.when(blocks == 1, 0).when(few, F.when(minor & (F.col("other") > 0), 1).otherwise(0)).otherwise(crossed))
        # A text is in few nodes: as many as there are trees, times the splits of each level.
        places = open_.filter(fits).groupBy(F.col("cls").alias("_cls")).agg(F.collect_set("node").alias("nodes"))
        small = small.join(places, F.col("cls") == F.col("_cls"))
        self.compare(self.with_sketches(small.drop("_cls")).select("node", "block", "cls", "comp", "n", "side", "sketch", "nodes"))
        large = open_.filter(~fits)
        if last or large.isEmpty():
            forget(open_, members)
            return None
        # A node picks its coordinates by its own hash; texts that agree there meet in a child.
        pick = lambda k: F.pmod(F.xxhash64("node", F.lit(k)), F.lit(s.sketch)).cast("int")
        child = F.array(*[F.xxhash64("node", pick(k), F.substring("sketch", pick(k) + 1, F.lit(1))) for k in range(s.splits)])
        children = landed(self.with_sketches(large.select("node", "cls")).select(F.explode(child).alias("node"), "cls"), "near-children")
        forget(open_, members)
        return children


def near_duplicates(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, text_key.

    Texts are linked when their sets of word shingles share 75 % of their union. Texts with the same
    lower-cased words are one class, so copies are never paired. component_id is the smallest doc_id
    reachable; kept marks its row. NULL, empty and blank texts have no shingles and link with
    nothing. A row without doc_id gets the component of its text and stays only where that has no
    doc_id; rows that repeat a doc_id each go by their own text, and the one with the smallest
    text_key (a hash of the text) stays. Other columns are not read; an empty
    table gives no rows.

    Chosen path: each tree sends a text to the node of its smallest shingle hash. Nodes are compared
    by sketches, and pairs that may reach the threshold are confirmed on whole sets. A node too large
    to compare branches on further minima that its hash picks, until its nodes are small. First every
    text tries its best partner only; afterwards a pair matters only if it joins two components, so a
    large group of near copies costs a few pairs per text, not all of them. A node's task tells the
    texts that may have a partner; these meet there again with their whole sets, are compared as one
    matrix product, and the links that join components leave: rows grow with texts, not pairs. Trees are as many as the
    target recall at the threshold needs, and the sketch's cut is as low.
    """
    settings = settings or Settings()
    with small_batches(docs.sparkSession):
        state = _Join(docs, settings)
        roots = state.classes.select(F.explode("roots").alias("node"), "cls")
        several = roots.groupBy("node").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(F.col("node").alias("_node"))
        members = landed(roots.join(several, F.col("node") == F.col("_node"), "left_semi"), "near-roots")
        state.nearest(members)
        level = 1
        while members is not None:
            members = state.whole(members, level)
            level += 1
        forget(state.classes, *state.read)
    rows = state.components_of(state.rows.select("doc_id", "raw", "cls", "n"))
    own = rows.withColumn("comp", F.when(F.col("n") > 0, F.col("comp")))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "raw")).alias("best")
    least = own.filter("comp is not null").groupBy(F.col("comp").alias("_comp")).agg(best)
    joined = own.join(least, F.col("comp") == F.col("_comp"), "left")
    alone = F.col("comp").isNull()
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("component_id"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("raw") == F.col("best.raw")))).alias("kept"),
        F.col("raw").alias("text_key"),
    )
