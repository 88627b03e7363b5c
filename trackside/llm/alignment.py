"""Operator 11: alignment of two tokenizers' tokens, by divide and conquer at shared cuts."""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.llm.common import kept_in_worker
from trackside.llm.token_counts import byte_letters
from trackside.session import landed, small_batches


class Vocabularies(NamedTuple):
    """What two tokenizers are made of: the JSON text of a byte-level BPE (A) and the bytes of a piece
    model (B). Both are a few MB, whatever the corpus."""

    a: str
    b: bytes


class _Encoder(dict):
    """Token ids of pieces of texts, as little-endian 32-bit numbers, kept up to ``most`` pieces.

    ``cut`` takes a text apart where its tokenizer never joins, so the ids of a text are those of its
    pieces; texts in which ``whole`` is found are not taken apart. Pieces in which ``single`` is not found may
    follow each other in one text. ``odd`` has the pieces that their tokens' bytes do not give back.
    """

    def __init__(self, table: list[bytes], encode: Callable[[str], list[int] | np.ndarray], cut: re.Pattern, single: re.Pattern, whole: re.Pattern | None, most: int):
        self.table, self.encode, self.cut, self.single, self.whole, self.most, self.odd = table, encode, cut, single, whole, most, set()
        self.lengths = np.array([len(t) for t in table], np.int64)

    def given_back(self, ids: np.ndarray, text: str) -> bool:
        return b"".join(map(self.table.__getitem__, ids.tolist())) == text.encode()

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.encode(text), "<u4")

    def _learn(self, pieces: list[str]) -> None:
        together = [piece for piece in pieces if not self.single.search(piece)]
        alone = [piece for piece in pieces if self.single.search(piece)]
        for at in range(0, len(together), 2000):
            part = together[at : at + 2000]
            text = "".join(part)
            ids = self._ids(text)
            ends = np.cumsum(self.lengths[ids])
            own = np.cumsum([len(piece.encode()) for piece in part])
            last = np.minimum(np.searchsorted(ends, own), len(ends) - 1)
            if not self.given_back(ids, text) or (ends[last] != own).any():
                alone += part
                continue
            data, stops = ids.tobytes(), (4 * (last + 1)).tolist()
            for piece, begin, end in zip(part, [0, *stops], stops):
                self[piece] = data[begin:end]
        for piece in alone:
            ids = self._ids(piece)
            self[piece] = ids.tobytes()
            if not self.given_back(ids, piece):
                self.odd.add(piece)

    def of(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids per text, None where the tokens' bytes, joined, are not the text."""
        if len(self) > self.most:
            self.clear()
            self.odd.clear()
        parts = [None if self.whole and self.whole.search(text) else self.cut.findall(text) for text in texts]
        self._learn([piece for piece in set().union(*filter(None, parts)) if piece not in self])
        out: list[np.ndarray | None] = []
        for text, pieces in zip(texts, parts):
            ids = self._ids(text) if pieces is None else np.frombuffer(b"".join(map(self.__getitem__, pieces)), "<u4")
            unsure = pieces is None or not self.odd.isdisjoint(pieces)
            out.append(None if unsure and not self.given_back(ids, text) else ids.astype(np.int64))
        return out


#: White space beyond ASCII, or taken for it by one of the libraries only.
OTHER_SPACE = r"\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
#: A blank and what follows up to the next white space; white space at the end; before the last of a run; the last.
WORDS = re.compile(r" ?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z|[\x20\x09-\x0D]+(?=[\x20\x09-\x0D])|[\x20\x09-\x0D]")
#: All but a blank and a word.
NO_WORD = re.compile(r"\A[^ ]|\A.[\x20\x09-\x0D]|\A.\Z")
#: Blanks and what follows: no piece of the model has a blank after another letter.
BLANKS = re.compile(r" +[^ ]*")
#: What WORDS rests on. Fixed value.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
#: The pattern of that kind of vocabulary. Fixed value.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder_a(vocabulary: str, most: int) -> _Encoder:
    """Byte-level BPE whose ids rise with the merges; strings of added tokens in texts are ordinary text."""
    import tiktoken

    told = json.loads(vocabulary)
    vocab = told["model"]["vocab"]
    made = [vocab["".join(pair)] for pair in told["model"]["merges"]]
    if told["normalizer"] is not None or told["pre_tokenizer"] != BYTE_LEVEL or made != sorted(made):
        raise ValueError("a byte-level vocabulary in the order of its merges and without normalizer is needed")
    byte = {letter: k for k, letter in enumerate(byte_letters())}
    ranks = {bytes(byte[letter] for letter in token): k for token, k in vocab.items()}
    table = [b""] * (max(ranks.values()) + 1)
    for token, k in ranks.items():
        table[k] = token
    model = tiktoken.Encoding("a", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _Encoder(table, lambda text: model.encode_to_numpy(text, disallowed_special=()), WORDS, NO_WORD, re.compile(f"[{OTHER_SPACE}]"), most)


def encoder_b(model: bytes, most: int) -> _Encoder:
    """Pieces with byte fallback; the model puts a blank before a text, so texts are given without theirs."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [own.id_to_piece(k) for k in range(own.vocab_size())]
    table = [bytes([int(piece[3:5], 16)]) if own.is_byte(k) else piece.replace("\u2581", " ").encode() for k, piece in enumerate(pieces)]
    apart = not any("\u2581" in piece.lstrip("\u2581") for piece in pieces)
    blank = [own.piece_to_id("\u2581")]
    return _Encoder(table, lambda text: own.encode(text[1:]) if len(text) > 1 else blank, BLANKS, re.compile(r" \Z|\u2581"), None if apart else re.compile(""), most)


def shared_cuts(a: np.ndarray, b: np.ndarray, bounds: np.ndarray, near: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Places in the ascending token ends ``a`` and ``b`` where both have the same one, by divide and conquer.

    ``bounds`` has the first place of each text in ``a``, and the last one's end: a text's last end is
    shared. In each open interval a shared end near the middle is located by bisecting ``b``: ``near``
    steps to both sides, then, in the few intervals with none there, all that is left, whose nearest
    is taken. Both halves go on; an interval without a shared end is done. All intervals of a level are
    handled at once.
    """

    def met(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(b, a[x]), len(b) - 1)
        return at, b[at] == a[x]

    last = bounds[1:][bounds[1:] > bounds[:-1]] - 1
    found = [(last, met(last)[0])]
    low, high = bounds[:-1], bounds[1:] - 1
    while True:
        open_ = high > low
        low, high = low[open_], high[open_]
        if not len(low):
            break
        middle, cut, place, todo = (low + high) // 2, np.full(len(low), -1), np.full(len(low), -1), np.arange(len(low))
        for step in [0, *(s for k in range(1, near + 1) for s in (k, -k))]:
            x = middle[todo] + step
            inside = (x >= low[todo]) & (x < high[todo])
            at, hit = met(np.where(inside, x, 0))
            hit &= inside
            cut[todo[hit]], place[todo[hit]] = x[hit], at[hit]
            todo = todo[~hit]
            if not len(todo):
                break
        for row in todo[(high[todo] - low[todo]) > 2 * near].tolist():
            x = np.arange(low[row], high[row])
            at, hit = met(x)
            if hit.any():
                own = np.where(hit, np.abs(x - middle[row]), len(x)).argmin()
                cut[row], place[row] = x[own], at[own]
        yes = cut >= 0
        low, high, cut, place = low[yes], high[yes], cut[yes], place[yes]
        found.append((cut, place))
        low, high = np.stack([low, cut + 1], 1).ravel(), np.stack([cut, high], 1).ravel()
    at_a, at_b = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(at_a)
    return at_a[order], at_b[order]


class Aligned:
    """Tokens of some texts under both vocabularies, their groups and links.

    Texts without tokens (empty, or not given back by the tokens) have none in both.
    """

    def __init__(self, ids_a: list[np.ndarray], ids_b: list[np.ndarray], a: _Encoder, b: _Encoder):
        self.of_a, self.of_b = (np.concatenate([[0], np.cumsum([len(ids) for ids in own])]).astype(np.int64) for own in (ids_a, ids_b))
        none = [np.zeros(0, np.int64)]
        self.a, self.b = np.concatenate(ids_a + none), np.concatenate(ids_b + none)
        # Ends within all texts, one after the other.
        self.end_a, self.end_b = np.cumsum(a.lengths[self.a]), np.cumsum(b.lengths[self.b])
        self.cut_a, self.cut_b = shared_cuts(self.end_a, self.end_b, self.of_a) if len(self.a) else (none[0], none[0])
        # Groups of each text: its shared ends.
        self.of_group = np.searchsorted(self.cut_a, self.of_a)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A and B ids of all overlapping pairs, and the first link of each text. An overlap ends where either
        token ends, so the ends of a group are its links."""
        open_b = np.ones(len(self.b), bool)
        open_b[self.cut_b] = False
        ends = np.sort(np.concatenate([self.end_a, self.end_b[open_b]]), kind="stable")
        first = np.searchsorted(ends, np.concatenate([[0], self.end_a])[self.of_a], side="right")
        return self.a[np.searchsorted(self.end_a, ends)], self.b[np.searchsorted(self.end_b, ends)], first

    def texts(self, words: list[bytes], n_a: int) -> Iterator[bytes]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``. ``words`` has each id with the sign after it, as
        :func:`signed` writes them."""
        # Where tokens stand when each group's B tokens follow its A tokens.
        n, m = len(self.a), len(self.b)
        last_a, last_b = np.zeros(n, np.int64), np.zeros(m, np.int64)
        last_a[self.cut_a], last_b[self.cut_b] = 1, 1
        code = np.empty(n + m, np.int64)
        sizes_a, sizes_b = np.diff(self.cut_a, prepend=-1), np.diff(self.cut_b, prepend=-1)
        code[np.arange(n) + np.repeat(self.cut_b + 1 - sizes_b, sizes_a)] = 2 * self.a + last_a
        code[np.arange(m) + np.repeat(self.cut_a + 1, sizes_b)] = 2 * (n_a + self.b) + last_b
        both = (self.of_a + self.of_b).tolist()
        for begin, end in zip(both[:-1], both[1:]):
            yield b"".join(map(words.__getitem__, code[begin:end].tolist()))[:-1]


def signed(n_a: int, n_b: int) -> list[bytes]:
    """Each A id with a comma or a bar, then each B id with a comma or a semicolon."""
    return [b"%d%c" % (k, sign) for n, signs in ((n_a, b",|"), (n_b, b",;")) for k in range(n) for sign in signs]


def _aligned(batches: Iterator[pa.RecordBatch], vocabularies: Broadcast, together: int, most: int) -> Iterator[tuple[pa.RecordBatch, Aligned, _Encoder, _Encoder, list[bytes]]]:
    """Batches of texts of about ``together`` letters with their alignment."""
    a, b = vocabularies.value
    key = zlib.crc32(a.encode()), zlib.crc32(b)
    one, two = kept_in_worker(("a", key), lambda: encoder_a(a, most)), kept_in_worker(("b", key), lambda: encoder_b(b, most))
    words = kept_in_worker(("signed", key), lambda: signed(len(one.table), len(two.table)))
    none = np.zeros(0, np.int64)
    for batch in batches:
        sizes = np.cumsum([len(text or "") + 1 for text in batch.column("text").to_pylist()])
        edges = np.unique(np.searchsorted(sizes, np.arange(0, sizes[-1] if len(sizes) else 0, together)))
        for begin, end in zip(edges.tolist(), [*edges[1:].tolist(), batch.num_rows]):
            part = batch.slice(begin, end - begin)
            texts = [text or "" for text in part.column("text").to_pylist()]
            led = [" " + text for text in texts]
            ids = [(x, y) if text and x is not None and y is not None else (none, none) for text, x, y in zip(texts, one.of(led), two.of(led))]
            yield part, Aligned([x for x, _ in ids], [y for _, y in ids], one, two), one, two, words


def _sent(docs: DataFrame, vocabularies: Vocabularies) -> Broadcast:
    return docs.sparkSession.sparkContext.broadcast(tuple(vocabularies))


def token_groups(docs: DataFrame, vocabularies: Vocabularies, together: int = 400_000, most: int = 250_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, groups (``a1,a2|b1;a3|b2,b3``: the ids of A and B between two
    neighbouring shared cuts, in order; '' for a text without tokens)."""
    sent = _sent(docs, vocabularies)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found, one, _, words in _aligned(batches, sent, together, most):
            texts = [text.decode() for text in found.texts(words, len(one.table))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "groups"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(rows, "doc_id long, groups string")


def linked(docs: DataFrame, vocabularies: Vocabularies, together: int = 400_000, most: int = 250_000) -> DataFrame:
    """One row per row of ``docs``, written to the shared folder: row (a number of its own), doc_id, n_a, n_b,
    n_groups, n_links, groups_sha256, pairs and times (the distinct linked id pairs, ``a * n_b + b``, and
    how many links have each: little-endian 64-bit and 32-bit numbers, compressed)."""
    sent = _sent(docs, vocabularies)
    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for part, found, one, two, words in _aligned(batches, sent, together, most):
            n = part.num_rows
            ids_a, ids_b, first = found.links()
            text = np.repeat(np.arange(n), np.diff(first))
            # Ids of one text's links side by side, whatever the sizes of the vocabularies.
            order = np.lexsort((ids_a * len(two.table) + ids_b, text))
            pair, text = (ids_a * len(two.table) + ids_b)[order], text[order]
            new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])])[: len(pair)])
            times, pair = np.diff(np.append(new, len(pair))).astype("<u4"), pair[new]
            at = np.searchsorted(text[new], np.arange(n + 1)).tolist()
            sha = [hashlib.sha256(t).hexdigest() if t else "" for t in found.texts(words, len(one.table))]
            columns = [
                pa.array(np.arange(number, number + n)),
                part.column("doc_id"),
                *(pa.array(np.diff(of)) for of in (found.of_a, found.of_b, found.of_group, first)),
                pa.array(sha, pa.string()),
                pa.array([zlib.compress(pair[i:j].astype("<i8").tobytes(), 1) for i, j in zip(at, at[1:])], pa.binary()),
                pa.array([zlib.compress(times[i:j].tobytes(), 1) for i, j in zip(at, at[1:])], pa.binary()),
            ]
            number += n
            yield pa.RecordBatch.from_arrays(columns, names=[field.split()[0] for field in schema.split(", ")])

    with small_batches(docs.sparkSession):
        return landed(docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(rows, schema), "aligned")


def _numbers(cell: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(cell), kind)


def link_counts(links: DataFrame, n_b: int, flush: int = 2_000_000) -> DataFrame:
    """(pair, n, best), written to the shared folder: how many links of all texts have an id pair, and whether
    that is the most of its B id. Each task adds up its own before anything is shuffled."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            pairs, place = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            return pairs, np.bincount(place, np.concatenate([t for _, t in held]), len(pairs)).astype(np.int64)

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in held.pop()], names=["pair", "n"])

        size = 0
        for batch in batches:
            for pairs, times in zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist()):
                held.append((_numbers(pairs, "<i8"), _numbers(times, "<u4")))
                size += len(held[-1][0])
                if size > flush:
                    held[:] = [merged()]
                    size = len(held[0][0])
                    if 2 * size > flush:
                        yield told()
                        size = 0
        if held:
            held[:] = [merged()]
            yield told()

    with small_batches(links.sparkSession):
        counts = landed(links.select("pairs", "times").mapInArrow(rows, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "link-counts")
    # One row per B id: bounded by the vocabulary.
    most = counts.groupBy(F.pmod("pair", F.lit(n_b)).alias("_b")).agg(F.max("n").alias("_most"))
    return counts.join(F.broadcast(most), F.pmod("pair", F.lit(n_b)) == F.col("_b")).select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))


def align(docs: DataFrame, vocabularies: Vocabularies, common: int = 500_000, links: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A and B encode the text with a blank before it. Byte offsets at which tokens of both end cut them into groups
    (:func:`token_groups` has them); two tokens whose byte ranges overlap are a link. An id pair's
    count is the number of links of all texts that have it; n_best are links whose count is the highest of
    their B id (all of equal ones), count_sum adds up the counts of all links. NULL, empty and
    texts that the joined bytes of A's or B's tokens do not give back have no tokens: zeros, and '' for the
    digest. Rows that repeat and rows without doc_id are aligned and counted each; other columns are
    not read; an empty table gives no rows.

    Texts are read once; what they link is written to the shared folder (``links`` takes the result of an
    earlier :func:`linked`). Counts of the ``common`` commonest pairs at most go to all
    tasks, of fixed size whatever the corpus; links of other pairs meet their counts in a join.
    """
    spark = docs.sparkSession
    links = linked(docs, vocabularies) if links is None else links
    n_b = _pieces(vocabularies.b)
    counts = landed(link_counts(links, n_b), "link-best")
    # Counts from a power of two on, so that there are at most ``common``: at most 64 rows tell.
    by_size = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("size")).agg(F.count(F.lit(1)).alias("pairs")).toPandas().sort_values("size", ascending=False)
    fits = by_size[by_size["pairs"].cumsum() <= common]
    least = 1 << int(fits["size"].min()) if len(fits) else 1 << 62
    top = counts.filter(F.col("n") >= least).toPandas().sort_values("pair")
    known = spark.sparkContext.broadcast((top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(bool)))

    told = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in batches:
            out: list[tuple] = []
            for own, often in zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist()):
                own, often = _numbers(own, "<i8"), _numbers(often, "<u4").astype(np.int64)
                at = np.minimum(np.searchsorted(pair, own), max(0, len(pair) - 1))
                here = pair[at] == own if len(pair) else np.zeros(len(own), bool)
                at, often_here = at[here], often[here]
                out.append((int(often_here[best[at]].sum()), int((often_here * n[at]).sum()), own[~here], often[~here]))
            columns = list(zip(*out)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            kept = [batch.column(name) for name in ("row", *told)]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c, kind) for c, kind in zip(columns, kinds)]], names=["row", *told, "n_best", "count_sum", "rare", "often"])

    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rare array<long>, often array<long>"
    with small_batches(spark):
        whole = landed(links.select("row", *told, "pairs", "times").mapInArrow(sums, schema), "link-sums")
    if len(by_size) and len(fits) < len(by_size):
        rare = whole.filter(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "often")).alias("one")).select("row", F.col("one.rare").alias("pair"), F.col("one.often").alias("often"))
        joined = rare.join(counts.filter(F.col("n") < least), "pair")
        late = joined.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("often")).otherwise(0)).alias("_best"), F.sum(F.col("often") * F.col("n")).alias("_sum"))
        added = [(F.col(name) + F.coalesce(more, F.lit(0))).alias(name) for name, more in (("n_best", "_best"), ("count_sum", "_sum"))]
        whole = whole.drop("rare", "often").join(late, "row", "left").select(*told, *added)
    return whole.select(*told[:-1], "n_best", "count_sum", "groups_sha256")


def _pieces(model: bytes) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model).vocab_size()
