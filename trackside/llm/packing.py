"""Operator 10: vector bin packing of token sequences by the dot-product heuristic."""

from __future__ import annotations

import base64
import re
import sys
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame


class Limits(NamedTuple):
    """What one sequence may hold."""

    tokens: int = 1024
    segments: int = 128
    loss_tokens: int = 1024


class Bins:
    """Fills one sequence after the other from a pool of items.

    An item has tokens, one segment and loss-bearing tokens. The next item of a sequence is the one
    whose demand has the largest dot product with what is left of the limits (each in parts of its
    limit, weighed by how scarce it is in the pool), among those that fit all limits.
    """

    def __init__(self, limits: Limits):
        self.limits = limits
        self.tokens, self.loss = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.keys: list = []

    def add(self, keys: list, tokens: list[int], loss: list[int]) -> None:
        self.keys += keys
        self.tokens = np.concatenate([self.tokens, np.array(tokens, np.int64)])
        self.loss = np.concatenate([self.loss, np.array(loss, np.int64)])

    def __len__(self) -> int:
        return len(self.keys)

    def fill(self, split: Callable | None = None) -> list:
        """Take the items of one sequence out of the pool. ``split(key, n)`` gives the keys of the
        first n tokens and of the rest of an item: then the last item is cut to fill the sequence."""
        limits, taken, gone = self.limits, [], np.zeros(len(self.keys), bool)
        left = np.array([limits.tokens, limits.segments, limits.loss_tokens], np.int64)
        scarce = np.array([self.tokens.sum() / limits.tokens, len(self.keys) / limits.segments, self.loss.sum() / max(1, limits.loss_tokens)])
        scarce = scarce / max(scarce.max(), 1e-9)
        while left[0] > 0 and left[1] > 0:
            fits = ~gone & (self.tokens <= left[0]) & (self.loss <= left[2])
            if not fits.any():
                break
            worth = scarce * left / np.maximum(1, np.array(limits))
            score = worth[0] * self.tokens / limits.tokens + worth[2] * self.loss / max(1, limits.loss_tokens)
            best = int(np.where(fits, score, -1.0).argmax())
            taken.append(self.keys[best])
            gone[best] = True
            left -= (self.tokens[best], 1, self.loss[best])
        room = int(min(left[0], left[2]))
        rest = None
        if split and room > 0 and left[1] > 0 and not gone.all():
            cut = int(np.where(gone, -1, self.tokens).argmax())
            if self.tokens[cut] > room:
                head, rest = split(self.keys[cut], room)
                taken.append(head)
                gone[cut] = True
        keep = ~gone
        self.keys = [key for key, stays in zip(self.keys, keep) if stays]
        self.tokens, self.loss = self.tokens[keep], self.loss[keep]
        if rest is not None:
            self.add([rest], [len(rest[1])], [len(rest[1])])
        return taken


def pack_examples(examples: DataFrame, limits: Limits = Limits(), pool: int = 4096) -> DataFrame:
    """Place examples whole: (example_id, tokens, loss_tokens) to (example_id, sequence_id, offset, placed).

    For instruction data: loss_tokens are those of the answers. Each task fills sequences from a
    pool of at most ``pool`` examples as they come, so memory is bounded and nothing is shuffled.
    NULL counts are 0; an example beyond a limit gets a sequence_id NULL and placed false.
    """

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        bins, number = Bins(limits), TaskContext.get().partitionId() << 40

        def filled(down_to: int) -> Iterator[pd.DataFrame]:
            nonlocal number
            while len(bins) > down_to:
                ids, tokens = zip(*bins.fill())
                yield pd.DataFrame({"example_id": ids, "sequence_id": number, "offset": np.cumsum((0, *tokens))[:-1], "placed": True})
                number += 1

        for frame in frames:
            frame = frame.fillna({"tokens": 0, "loss_tokens": 0})
            large = (frame["tokens"] > limits.tokens) | (frame["loss_tokens"] > limits.loss_tokens)
            if large.any():
                yield pd.DataFrame({"example_id": frame["example_id"][large], "sequence_id": None, "offset": None, "placed": False}).astype({"sequence_id": "Int64", "offset": "Int64"})
            frame = frame[~large]
            bins.add(list(zip(frame["example_id"], frame["tokens"])), frame["tokens"].tolist(), frame["loss_tokens"].tolist())
            yield from filled(pool)
        yield from filled(0)

    picked = examples.selectExpr("cast(example_id as long) example_id", "cast(tokens as long) tokens", "cast(loss_tokens as long) loss_tokens")
    return picked.mapInPandas(rows, "example_id long, sequence_id long, offset long, placed boolean")


#: White space other than blank and line feed.
OTHER_SPACE = re.compile(r"[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
LINE = "\n"


class Tokens:
    """Token ids of texts as little-endian 32-bit bytes, for byte-level vocabularies of ranks.

    The pattern always parts a text before a single blank between words and around a single line
    feed between them, so the ids of a line are those of its first word and of the others with their
    blank, joined. Words come again and again: their ids are kept, up to ``most`` words, for all
    tasks of a worker. Texts with other white space, or more of it in a row, are encoded as they are,
    and so are those that hold a string of ``special``: it is one token there. Strings of special
    tokens that are not in it are ordinary text.
    """

    def __init__(self, ranks: str, pattern: str, most: int = 800_000, longest: int = 60, special: dict[str, int] | None = None):
        import tiktoken

        self.most, self.longest, self.special = most, longest, special or {}
        own = ranks, *sorted(self.special.items())
        # Where the imported library is, because this module is sent by value with every task.
        kept = vars(sys.modules["tiktoken"]).setdefault("_kept_words", {})
        if own not in kept:
            with open(ranks, "rb") as lines:
                known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            model = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=known, special_tokens=self.special)
            blank = np.zeros(max(known.values()) + 1, bool)
            blank[[rank for token, rank in known.items() if token[:1] == b" "]] = True
            kept[own] = model, blank, known[b"\n"], {}, {}
        self.model, self.blank, self.feed, self.first, self.other = kept[own]

    def _plain(self, text: str) -> bool:
        """Words parted by single blanks or line feeds, and nothing else."""
        if any(token in text for token in self.special):
            return False
        odd = "  " in text or " \n" in text or "\n " in text or "\n\n" in text
        return not (odd or text[:1] in ("", " ", LINE) or text[-1] in " \n" or OTHER_SPACE.search(text))

    def _learn(self, words: set[str], known: dict[str, bytes], lead: str, starts) -> list[str]:
        """Encode unknown words in one go and find them again by where ``starts`` says they begin.
        Returns those too long to be kept."""
        new = [word for word in words if word not in known]
        if not new:
            return []
        ids = self.model.encode_to_numpy(lead + lead.join(new), disallowed_special=()).astype("<u4")
        at = np.flatnonzero(starts(ids))
        data = ids.tobytes()
        skip = 4 * (lead == LINE)
        for word, begin, end in zip(new, (4 * at).tolist(), (4 * np.append(at[1:], len(ids))).tolist()):
            known[word] = data[begin + skip : end]
        return [word for word in new if len(word) > self.longest]

    def __call__(self, texts: list[str]) -> list[bytes]:
        first, other = self.first, self.other
        for known in (first, other):
            if len(known) > self.most:
                known.clear()
        plain = [[line.split(" ") for line in text.split(LINE)] if self._plain(text) else None for text in texts]
        heads = {line[0] for lines in plain if lines for line in lines}
        rest = set().union(*[line[1:] for lines in plain if lines for line in lines])
        long = self._learn(heads, first, LINE, lambda ids: ids == self.feed), self._learn(rest, other, " ", lambda ids: self.blank[ids])
        feed, out = np.array([self.feed], "<u4").tobytes(), []
        for text, lines in zip(texts, plain):
            if lines:
                out.append(feed.join([first[line[0]] + b"".join(map(other.__getitem__, line[1:])) for line in lines]))
            else:
                out.append(self.model.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes() if text else b"")
        for known, words in zip((first, other), long):
            for word in words:
                del known[word]
        return out


def pack_documents(docs: DataFrame, ranks: str, pattern: str, limits: Limits = Limits(), pool: int = 512, special: dict[str, int] | None = None) -> DataFrame:
    """Cut documents into pieces and place them in sequences of at most ``limits.tokens`` tokens.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, segments
    (of the sequence). ``ranks`` is the vocabulary file, ``pattern`` parts texts before its merges,
    ``special`` has the ids of strings that are one token wherever they stand (none: all is ordinary text). A
    document's tokens are the ids of its text (NULL: none) and the id 0 at its end; each lies in exactly one piece. Every token bears loss. Full lengths are cut off long
    documents first; what remains of each goes to a pool from which sequences are filled by the
    dot-product heuristic, and the last item of a sequence is cut to fill it. Only the sequences at
    a limit of segments and the last one of a task are shorter. Texts are tokenised and packed in the
    task that reads them: no text or id is shuffled, at most ``pool`` remainders are held, and a task
    that is run again on its split makes the same rows. Rows that repeat are packed each; other
    columns are not read; an empty table gives no rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens, bins, number = Tokens(ranks, pattern, special=special), Bins(limits), TaskContext.get().partitionId() << 40
        size = min(limits.tokens, limits.loss_tokens)
        out: list[tuple] = []

        def split(key: tuple, n: int) -> tuple:
            doc, ids, start, total = key
            return (doc, ids[:n], start, total), (doc, ids[n:], start + n, total)

        def place(pieces: list[tuple]) -> None:
            nonlocal number
            offset = 0
            for doc, ids, start, total in pieces:
                out.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, number, offset, len(pieces)))
                offset += len(ids)
            number += 1

        def done() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*out)] or [[]] * 8
            out.clear()
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "segments"]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in batches:
            for small in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                texts = [text or "" for text in small.column("text").to_pylist()]
                keys = []
                for doc, own in zip(small.column("doc_id").to_pylist(), tokens(texts)):
                    ids = np.frombuffer(own + b"\0\0\0\0", "<u4")
                    whole = len(ids) // size * size
                    for at in range(0, whole, size):
                        place([(doc, ids[at : at + size], at, len(ids))])
                    if whole < len(ids):
                        keys.append((doc, ids[whole:].copy(), whole, len(ids)))
                lengths = [len(key[1]) for key in keys]
                bins.add(keys, lengths, lengths)
                while len(bins) > pool:
                    place(bins.fill(split))
                if len(out) > 20_000:
                    yield done()
        while len(bins):
            place(bins.fill(split))
        yield done()

    picked = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return picked.mapInArrow(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, segments long")
