"""Operator 12: exact token counts at every prefix of a text, by dynamic programming over prefixes."""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, pairwise
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.llm.common import kept_in_worker

#: The words a vocabulary's pattern takes from a text, where they are known here. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same over shapes: letters are a or themselves, numbers 0, white space a blank, the rest a dot.
SHAPES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|0| +|[.']+")
OTHER_BLANKS = "\t\n\x0b\x0c\r"
END = "</w>"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it can be printed,
    else the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Merges:
    """Pair merges by rank. The tokens of a word are the only sequence of tokens whose neighbours, put
    together alone, are merged to themselves: this makes them countable prefix by prefix."""

    def __init__(self, merges: list[tuple[str, str]], most: int = 1_000_000, shared: int = 6):
        self.rank = {tuple(pair): k for k, pair in enumerate(merges)}
        self.split = {a + b: (a, b) for a, b in merges}
        if len(self.split) < len(self.rank):
            raise ValueError("tokens that are made in several ways")
        made = {*self.split, *byte_letters(), *(letter + END for letter in byte_letters())}
        self.longest = max(len(t.removesuffix(END)) for t in made)
        # 1: within a word, 2: at its end, 3: both.
        self.kinds: dict[str, int] = {}
        for token in made:
            bare = token.removesuffix(END)
            self.kinds[bare] = self.kinds.get(bare, 0) | (1 if bare == token else 2)
        # 0: only the end of a token, so that a longer one may be worth a look.
        for bare in [*self.kinds]:
            for at in range(1, len(bare)):
                self.kinds.setdefault(bare[at:], 0)
        self.most, self.shared, self.begun = most, shared, {}
        self.pairs: tuple[dict, dict] = {}, {}
        self.alone: dict[str, bool] = {}
        self.edges: tuple[dict, dict] = {}, {}

    def encode(self, symbols: list[str]) -> list[str]:
        """Merge the pair of lowest rank, the leftmost first, until none is left."""
        rank, never = self.rank, len(self.rank)
        while len(symbols) > 1:
            ranks = [rank.get(pair, never) for pair in pairwise(symbols)]
            best = min(ranks)
            if best == never:
                break
            at = ranks.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """The pieces at one edge of a token while it is merged, and the rank at which each is taken up."""
        known = self.edges[side]
        if token not in known:
            out, until, piece = [], len(self.rank), token
            while True:
                out.append((piece, until))
                if piece not in self.split:
                    break
                until = self.rank[self.split[piece]]
                piece = self.split[piece][side]
            known[token] = out
        return known[token]

    def beside(self, key: tuple[str, str], at_end: int) -> bool:
        """Whether two tokens (the first empty: one) stay what they are next to each other: no pair across
        them is merged before its pieces are taken up within them. Of equal ranks the left one is first."""
        one, two = key
        token = two + END if at_end else two
        if token not in self.alone:
            symbols = [*two]
            symbols[-1] += END * at_end
            self.alone[token] = self.encode(symbols) == [token]
        stays = self.alone[token]
        if stays and one:
            get, never = self.rank.get, len(self.rank)
            right = self.edge(token, 0)
            stays = not any((r := get((x, y), never)) < until and r <= other and r < never for x, until in self.edge(one, 1) for y, other in right)
        known = self.pairs[at_end]
        if len(known) >= self.most:
            known.clear()
        known[key] = stays
        return stays

    def continued(self, letters: str, last: list[str], count: list[int], upto: int, whole: list[int]) -> None:
        """Continue ``last`` and ``count``: the last token and the number of tokens of each prefix of ``letters``
        as a word that goes on; and ``whole``: the tokens of each prefix as a whole word, whose last one
        has the word's end. Both up to ``upto`` letters."""
        kind_of, (inside, ends) = self.kinds.get, self.pairs
        for i in range(len(last), upto + 1):
            open_ = 3
            for begin in range(i - 1, -1, -1):
                token = letters[begin:i]
                kind = kind_of(token)
                if kind is None:
                    break
                kind &= open_
                if not kind:
                    continue
                key = last[begin], token
                if kind & 1:
                    stays = inside.get(key)
                    if stays is None:
                        stays = self.beside(key, 0)
                    if stays:
                        last.append(token)
                        count.append(count[begin] + 1)
                        open_ &= 2
                if kind & 2:
                    stays = ends.get(key)
                    if stays is None:
                        stays = self.beside(key, 1)
                    if stays:
                        whole.append(count[begin] + 1)
                        open_ &= 1
                if not open_:
                    break

    def prefixes(self, letters: str) -> list[int]:
        """Tokens of each prefix of a word, as a word of its own. What the first letters give is kept for other
        words that begin alike."""
        start = letters[: self.shared]
        known = self.begun.get(start)
        if known is None:
            if len(self.begun) >= self.most // 4:
                self.begun.clear()
            known = self.begun[start] = [""], [0], [0]
            self.continued(start, known[0], known[1], len(start), known[2])
        last, count, whole = known
        if len(letters) > self.shared:
            last, count, whole = last.copy(), count.copy(), whole.copy()
            self.continued(letters, last, count, len(letters), whole)
        return whole


class Counter:
    """Token counts of texts under a vocabulary of words with ends: NFC, lower case, white space dropped.

    A text's count is the sum over its pieces between blanks: no step of the tokenizer looks across
    one. What a piece's prefixes count is kept while a worker runs, up to ``most`` pieces, and a third of
    that for the words in them. How letters
    are classed and lower-cased is asked of the tokenizer, letter by letter.
    """

    def __init__(self, vocabulary: str, most: int = 600_000):
        from tokenizers import Tokenizer, normalizers

        told = json.loads(vocabulary)
        split = told["pre_tokenizer"]["pretokenizers"][0]
        added = told["added_tokens"]
        if split["pattern"] != {"Regex": PATTERN} or told["model"]["end_of_word_suffix"] != END or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("a vocabulary of another kind: its pattern, word ends or added tokens differ")
        model = Tokenizer.from_str(vocabulary)
        whole, parts = model.normalizer, model.pre_tokenizer
        nfc, lower = normalizers.NFC(), normalizers.Lowercase()
        self.nfc = nfc.normalize_str
        self.special = re.compile("|".join(re.escape(t["content"]) for t in added)) if added else None
        self.merges = Merges([tuple(pair) for pair in told["model"]["merges"]])
        self.letters = byte_letters()

        class Lower(dict):
            def __missing__(self, code: int) -> str:
                self[code] = value = lower.normalize_str(chr(code))
                return value

        class Shape(dict):
            def __missing__(self, code: int) -> str:
                letter = chr(code)
                if letter in "'strevmld":
                    value = letter
                elif whole.normalize_str(letter) == " ":
                    value = " "
                else:
                    value = {1: "a", 3: ".", 4: "0"}[len(parts.pre_tokenize_str(f"a{letter}{letter}a"))]
                self[code] = value
                return value

        self.lower, self.shape = Lower(), Shape()
        self.most, self.runs, self.steps = most, {}, _Steps(self)
        self.run_steps: dict[str, bytes] = {}
        # Letters and signs of one code point each, whatever stands beside them: a word of such letters and
        # such signs after it are two words of the pattern.
        plain = [c for c in map(chr, range(33, 256)) if c != "'" and self.nfc(c) == c and len(self.lower[ord(c)]) == 1]
        kinds = {c: self.shape[ord(self.lower[ord(c)])] for c in plain}
        letters = "".join(re.escape(c) for c in plain if kinds[c].isalpha())
        signs = "".join(re.escape(c) for c in plain if c.isascii() and kinds[c] == ".")
        self.simple = re.compile(f"([{letters}]+)([{signs}]*)")

    def _letters(self, run: str) -> str:
        return "".join(map(self.letters.__getitem__, run.encode()))

    def _run(self, run: str) -> list[int]:
        """Counts of the prefixes of one word of the pattern."""
        known = self.runs.get(run)
        if known is None:
            if len(self.runs) >= self.most // 3:
                self.runs.clear()
            counts = self.merges.prefixes(self._letters(run))
            known = self.runs[run] = counts[1:] if run.isascii() else [counts[end] for end in accumulate(len(c.encode()) for c in run)]
        return known

    def _run_steps(self, run: str) -> bytes:
        """By how much each code point of one word of the pattern changes the number of tokens."""
        known = self.run_steps.get(run)
        if known is None:
            if len(self.run_steps) >= self.most // 3:
                self.run_steps.clear()
            # ASCII that can be printed stands for itself.
            counts = self.merges.prefixes(run if run.isascii() and run.isprintable() else self._letters(run))
            if not run.isascii():
                counts = [0, *(counts[end] for end in accumulate(len(c.encode()) for c in run))]
            known = self.run_steps[run] = array("h", map(sub, counts[1:], counts)).tobytes()
        return known

    def piece_steps(self, piece: str) -> bytes:
        """The same for a string without blanks, and for one blank after it."""
        simple = self.simple.fullmatch(piece)
        if simple and not (self.special and self.special.search(piece)):
            word, signs = simple.groups()
            steps = self._run_steps(word.lower() if word.isascii() else word.translate(self.lower))
            return steps + self._run_steps(signs) + b"\0\0" if signs else steps + b"\0\0"
        counts = self.prefixes(piece)
        return array("h", [*map(sub, counts, [0, *counts]), 0]).tobytes()

    def _words(self, normal: str) -> tuple[list[int], list[int]]:
        """Counts of the prefixes of an NFC string without added tokens, and where its words start."""
        low = normal.translate(self.lower)
        out, starts, before = [], [], 0
        for word in SHAPES.finditer(low.translate(self.shape)):
            begin, end = word.span()
            run, first = low[begin:end], word[0][0]
            starts.append(begin)
            if first == " ":
                counts = [0] * len(run)
            elif first == "'" and len(run) > 1 and word[0][1] not in ".'":
                # Cut short, a contraction is an apostrophe and maybe a letter.
                mark = self._run("'")[-1]
                counts = [mark, *([mark + self._run(run[1])[-1]] if len(run) > 2 else []), self._run(run)[-1]]
            else:
                counts = self._run(run)
            out += [before + n for n in counts] if before else counts
            before = out[-1]
        if len(low) != len(normal):  # a letter may have two in lower case
            at = list(accumulate(len(self.lower[ord(c)]) for c in normal))
            place = {0: 0} | {end: k + 1 for k, end in enumerate(at)}
            starts = [place[s] for s in starts if s in place]
            out = [out[end - 1] for end in at]
        return out, starts

    def _plain(self, text: str) -> list[int]:
        """Counts of the prefixes of a string without added tokens."""
        if text.isascii():
            return self._words(text)[0]
        normal = self.nfc(text)
        if normal == text:
            return self._words(text)[0]
        counts, starts = self._words(normal)
        # Blocks of a letter and what may be composed with it: before a block, normal forms go on as prefixes.
        firm = [k for k, c in enumerate(text) if not unicodedata.category(c).startswith("M") and not "\u1160" <= c <= "\u11ff"]
        out, done, states = [], 0, {}
        for begin, end in pairwise([*sorted({0, *firm}), len(text)]):
            whole = self.nfc(text[begin:end])
            for k in range(begin + 1, end + 1):
                tail = self.nfc(text[begin:k])
                if whole.startswith(tail):
                    out.append(counts[done + len(tail) - 1])
                else:
                    out.append(self._ending(normal, counts, starts, done, tail, states))
            done += len(whole)
        return out

    def _ending(self, normal: str, counts: list[int], starts: list[int], done: int, tail: str, states: dict) -> int:
        """Tokens of normal[:done] + tail, where the tail is not what follows in ``normal``."""
        word = max(0, bisect_left(starts, done) - 1)
        # From the word before the last one, as an apostrophe may be in it.
        at = starts[max(0, word - 1)] if starts else 0
        if done - at <= 64:
            return (counts[at - 1] if at else 0) + self._words(normal[at:done] + tail)[0][-1]
        start = starts[word]
        if done - start <= 32:  # the long one is the word before
            return counts[start - 1] + self._words(normal[start:done] + tail)[0][-1]
        # A long word: what the tail adds to it needs its last letters only.
        low = tail.translate(self.lower)
        kind = lambda c: "a" if (x := self.shape[ord(c)]).isalpha() else "." if x in ".'" else x
        mine = kind(self.lower[ord(normal[start])][-1])
        same = next((k for k, c in enumerate(low) if kind(c) != mine or mine not in "a."), len(low))
        before, rest = counts[start - 1] if start else 0, low[same:]
        total = counts[done - 1]
        if same:
            if start not in states:
                stop = starts[word + 1] if word + 1 < len(starts) else len(normal)
                letters, last, count = self._letters(normal[start:stop].translate(self.lower)), [""], [0]
                self.merges.continued(letters, last, count, len(letters), [])
                states[start] = letters, last, count, list(accumulate((len(self._letters(self.lower[ord(c)])) for c in normal[start:stop]), initial=0))
            letters, last, count, ends = states[start]
            cut = ends[done - start]
            base = max(0, cut - self.merges.longest)
            own, whole = letters[base:cut] + self._letters(low[:same]), []
            self.merges.continued(own, last[base : cut + 1], count[base : cut + 1], len(own), whole)
            total = before + whole[-1]
        return total + (self._words(rest)[0][-1] if rest else 0)

    def prefixes(self, piece: str) -> list[int]:
        """Tokens of every prefix, code point by code point, of a string without blanks."""
        out, before, begin = [], 0, 0
        for token in self.special.finditer(piece) if self.special else ():
            # A string of an added token is ordinary text until it is complete.
            part = piece[begin : token.end() - 1]
            counts = self._plain(part)
            out += [before + n for n in counts]
            own = token.start() - begin
            before += (counts[own - 1] if own else 0) + 1
            out.append(before)
            begin = token.end()
        if begin < len(piece):
            out += [before + n for n in self._plain(piece[begin:])]
        return out

    def __call__(self, text: str) -> bytes:
        """By how much each code point changes the number of tokens, as 16-bit numbers."""
        if len(self.steps) >= self.most:
            self.steps.clear()
        for blank in OTHER_BLANKS:
            text = text.replace(blank, " ")
        return b"".join(map(self.steps.__getitem__, text.split(" ")))[:-2]


class _Steps(dict):
    """What the code points of a piece and one blank after it add to the count."""

    def __init__(self, counter: Counter):
        self.counter = counter

    def __missing__(self, piece: str) -> bytes:
        self[piece] = value = self.counter.piece_steps(piece)
        return value


def prefix_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, steps.

    ``vocabulary`` is the JSON of a byte-level BPE vocabulary with word ends (its text, read once by
    the driver and sent along, a few MB). ``steps`` has, compressed, by how much each code point changes the number
    of tokens of the prefix that ends with it, so that the count of every prefix can be read without
    the text (:func:`count_at`, :func:`longest_prefix`). Counts are the tokenizer's own for
    that prefix: without begin or end, strings of added tokens are one token where they are complete.
    NULL is an empty text; rows without doc_id and rows that repeat are counted each; other columns
    are not read; an empty table gives no rows. Nothing is shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = kept_in_worker(("token counts", zlib.crc32(sent.value.encode())), lambda: Counter(sent.value))
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            found = [count(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(text.encode()) for text in texts], pa.int64()),
                    pa.array([int(np.frombuffer(steps, np.int16).sum(dtype=np.int64)) for steps in found], pa.int64()),
                    pa.array([zlib.compress(steps, 1) for steps in found], pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "steps"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(rows, "doc_id long, n_bytes long, n_tokens long, steps binary")


def unpacked(steps: bytes) -> np.ndarray:
    """The number of tokens of every prefix, the empty one first."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(zlib.decompress(steps), np.int16), dtype=np.int64)])


def _asked(counted: DataFrame, argument, answer, schema: str) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [answer(unpacked(steps), n) for steps, n in zip(batch.column("steps").to_pylist(), batch.column("n").to_pylist())]
            columns = list(zip(*found)) or [(), ()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", "chars", "tokens"])

    return counted.select("doc_id", "steps", F.coalesce(argument.cast("long"), F.lit(0).cast("long")).alias("n")).mapInArrow(rows, schema)


def longest_prefix(counted: DataFrame, budget) -> DataFrame:
    """doc_id, chars, tokens: the longest prefix of each text with at most ``budget`` tokens (a number or a
    column; NULL is 0), without its text. A longer prefix may have fewer tokens; none longer than
    the one returned fits."""

    def answer(counts: np.ndarray, most: int) -> tuple[int, int]:
        at = int(np.flatnonzero(counts <= max(0, most))[-1])
        return at, int(counts[at])

    return _asked(counted, budget if hasattr(budget, "cast") else F.lit(budget), answer, "doc_id long, chars long, tokens long")


def count_at(counted: DataFrame, chars) -> DataFrame:
    """doc_id, chars, tokens: the tokens of the prefix of ``chars`` code points (a number or a column), or of
    the whole text where that is shorter."""

    def answer(counts: np.ndarray, at: int) -> tuple[int, int]:
        at = min(max(0, at), len(counts) - 1)
        return at, int(counts[at])

    return _asked(counted, chars if hasattr(chars, "cast") else F.lit(chars), answer, "doc_id long, chars long, tokens long")
