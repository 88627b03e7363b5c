"""Alignment of tokenizers, token counts of prefixes and periodic runs, against plain second versions."""

import bisect
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from rows import ODD, documents, words
from tokenizers import Tokenizer

from trackside.llm import alignment, periodic, queries, token_counts
from trackside.llm.alignment import Vocabularies
from trackside.llm.periodic import Runs

SF = "/root/testdata/sf0.01"


def read(name, mode="r"):
    with open(public_tokenizers.path(name), mode, **({} if "b" in mode else {"encoding": "utf-8"})) as file:
        return file.read()


#: Kinds of text on which tokenizers differ most.
KINDS = [
    "abcdefgh", " the an in ing er of", "''''srtvelmd", "éèàçüßÀÉ", "İΣσςǅﬁ", "éạ̧̀ô",
    "각가", "漢字仮名", "0123456789٣½²", "!?.,-_*$%#|<>", "<|endoftext|>", "<|startoftext|>", "<s>", "<0x41>",
    "  　\u0085\u001c​", "\U0001f600\U0001f44d\U0001f3fd‍", "   \n\t\r\x0b", "ãåä̈́ÅΩ", "مرحب", "ୋো", "▁", "\x00",
]


def mixtures(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        parts = [rng.choice(KINDS) for _ in range(rng.randint(1, 8))]
        yield "".join(part if rng.random() < 0.2 else "".join(rng.choice(part) for _ in range(rng.randint(1, 6))) for part in parts)


# --- alignment


@pytest.fixture(scope="module")
def vocabularies():
    return Vocabularies(read("byte_bpe_50k.json"), read("piece_bpe_32k.model", "rb"))


def aligned(vocabularies, texts):
    """Each text's groups and links, from the tokenizers themselves, token by token."""
    a, b = Tokenizer.from_str(vocabularies.a), sentencepiece.SentencePieceProcessor(model_proto=vocabularies.b)
    a.encode_special_tokens = True
    letters = token_counts.byte_letters()
    names = {k: token for token, k in a.get_vocab().items()}

    def bytes_a(k):
        return bytes(letters.index(c) for c in names[k])

    def bytes_b(k):
        return bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()

    for text in texts:
        ids, other = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        one, two = [bytes_a(k) for k in ids], [bytes_b(k) for k in other]
        if not text or not b"".join(one) == b"".join(two) == (" " + text).encode():
            yield None
            continue
        end_a, end_b = np.cumsum([len(x) for x in one]).tolist(), np.cumsum([len(x) for x in two]).tolist()
        groups, i, j = [], 0, 0
        for cut in sorted(set(end_a) & set(end_b)):
            p, q = bisect.bisect(end_a, cut), bisect.bisect(end_b, cut)
            groups.append((ids[i:p], other[j:q]))
            i, j = p, q
        links, j = [], 0
        for i, (k, stop) in enumerate(zip(ids, end_a)):
            start = end_a[i - 1] if i else 0
            j = bisect.bisect(end_b, start)
            while j < len(other) and (end_b[j - 1] if j else 0) < stop:
                links.append((k, other[j]))
                j += 1
        yield len(ids), len(other), groups, links


def alignment_rows(vocabularies, texts):
    found = list(aligned(vocabularies, texts))
    counts = collections.Counter(link for one in found if one for link in one[3])
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    for one in found:
        if one is None:
            yield (0, 0, 0, 0, 0, 0, "")
            continue
        n_a, n_b, groups, links = one
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield n_a, n_b, len(groups), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), hashlib.sha256(told.encode()).hexdigest()


@pytest.mark.parametrize("common", [500_000, 40, 0], ids=["sent", "some", "joined"])
def test_alignment_of_odd_texts(spark, vocabularies, common):
    rows = [r[:2] for r in ODD] + [(100 + k, text) for k, text in enumerate(mixtures(1, 300))] + [(900, "x" * 5000), (901, "漢" * 3000), (902, "\n"), (903, " " * 40)]
    got = alignment.align(documents(spark, rows), vocabularies, common).collect()
    want = list(alignment_rows(vocabularies, [text or "" for _, text in rows]))
    assert collections.Counter(tuple(r) for r in got) == collections.Counter((i, *w) for (i, _), w in zip(rows, want))
    texts = alignment.token_groups(documents(spark, rows), vocabularies).collect()
    assert collections.Counter(hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "" for r in texts) == collections.Counter(w[-1] for w in want)


def test_alignment_of_the_documents(spark, vocabularies):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op11_shared_cuts(spark, sf).collect()
    assert sorted(tuple(r) for r in got) == sorted((i, *w) for (i, _), w in zip(rows, alignment_rows(vocabularies, [text for _, text in rows])))


def test_alignment_of_nothing(spark, vocabularies):
    assert alignment.align(documents(spark, []), vocabularies).collect() == []
    assert [tuple(r) for r in alignment.align(documents(spark, [(1, None)]), vocabularies).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_in_small_batches_and_without_a_join_where_all_counts_are_known(spark, vocabularies, monkeypatch):
    batches, real = {}, alignment.landed

    def noting(df, name):
        batches[name] = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
        return real(df, name)

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    monkeypatch.setattr(alignment, "landed", noting)
    found = alignment.align(documents(spark, [(1, "one two three"), (2, "two three four")]), vocabularies)
    assert [batches[name] for name in ("aligned", "link-counts", "link-sums")] == ["2m"] * 3
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("near", [1, 8])
def test_shared_cuts_wherever_they_lie(near):
    rng = np.random.default_rng(4)
    for n, place in ((1, 0), (300, 0), (300, 150), (300, 299), (2000, None)):
        ends = np.cumsum(rng.integers(2, 5, n))
        b = ends - (rng.random(n) < (0.02 if place is None else 1))  # most ends of b one lower, or few
        b[-1] = ends[-1]
        if place is not None:
            b[place] = ends[place]
        at_a, at_b = alignment.shared_cuts(ends, b, np.array([0, n]), near)
        assert ends[at_a].tolist() == sorted(set(ends.tolist()) & set(b.tolist())) == b[at_b].tolist()


# --- token counts


@pytest.fixture(scope="module")
def words_bpe():
    return read("word_bpe_49k.json")


def library(words_bpe):
    model = Tokenizer.from_str(words_bpe)
    return lambda text: len(model.encode(text, add_special_tokens=False).ids)


def test_counts_of_all_prefixes(words_bpe):
    counter, count = token_counts.Counter(words_bpe), library(words_bpe)
    long = ["ố" * 60, "é" * 40 + "'ré" + "x" * 70 + "ré!" * 3 + "!" * 50 + "á̧", "'" * 40 + "é", "r" * 50 + "'r" + "é", "İ" * 40 + "éİ"]
    for text in [*mixtures(2, 1500), *long, "", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|>b<|endof"]:
        got = np.cumsum(np.frombuffer(counter(text), np.int16)).tolist()
        assert got == [count(text[:k]) for k in range(1, len(text) + 1)], ascii(text)


def test_plain_words_are_counted_by_themselves(words_bpe, monkeypatch):
    """Letters and signs after them give what the tokenizer's own steps give, without those steps."""
    counter, count = token_counts.Counter(words_bpe), library(words_bpe)
    pieces = ["Word", "word,", "STRASSE...", "Stra\u00dfe", "\u00c9t\u00e9!", "na\u00efvement\u00e0?!", "a_", "\u00aa\u00ba\u00b5", "ch\u00df###", "\u00ff", "zqxjkvz" * 9]
    want = [counter.prefixes(piece) for piece in pieces]
    assert want == [[count(piece[: k + 1]) for k in range(len(piece))] for piece in pieces]
    monkeypatch.setattr(counter, "prefixes", None)
    assert [np.frombuffer(counter.piece_steps(piece), np.int16).cumsum().tolist()[:-1] for piece in pieces] == want


def test_only_ends_of_tokens_are_looked_up(words_bpe):
    merges = token_counts.Counter(words_bpe).merges

    class Asked(dict):
        def get(self, key):
            asked.append(key)
            return super().get(key)

    asked, letters = [], "zqxjkvz" * 9
    merges.kinds = Asked(merges.kinds)
    merges.prefixes(letters)
    # The last letters, and one more that ends no token.
    assert 0 < len(asked) < 4 * len(letters)


def test_counts_of_the_documents(spark, words_bpe):
    count = library(words_bpe)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.op12_prefix_counts(spark, SF).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        n = count(text or "")
        assert tuple(got[i]) == (i, len((text or "").encode()), n, n > 2048)


def test_counts_answer_without_texts(spark, words_bpe):
    count = library(words_bpe)
    rows = [r[:2] for r in ODD if r[0] not in (None, 5)] + [(100, "don't stop <|endoftext|> here, l'été"), (101, "é <|endoftext|>")]
    counted = token_counts.prefix_counts(documents(spark, rows), words_bpe)
    texts = {i: text or "" for i, text in rows}
    for budget in (0, 3, 7, 10**6):
        for r in token_counts.longest_prefix(counted, budget).collect():
            text = texts[r.doc_id]
            if len(text) < 200:
                fits = [k for k in range(len(text) + 1) if count(text[:k]) <= budget]
                assert (r.chars, r.tokens) == (fits[-1], count(text[: fits[-1]]))
            assert r.tokens <= budget and r.tokens == count(text[: r.chars])
    for at in (0, 4, 12, 10**9):
        for r in token_counts.count_at(counted, at).collect():
            assert r.chars == min(at, len(texts[r.doc_id])) and r.tokens == count(texts[r.doc_id][:at])


def test_counts_of_odd_rows(spark, words_bpe):
    count = library(words_bpe)
    got = token_counts.prefix_counts(documents(spark, ODD), words_bpe).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == collections.Counter((i, len((t or "").encode()), count(t or "")) for i, t, *_ in ODD)
    assert token_counts.prefix_counts(documents(spark, []), words_bpe).collect() == []


# --- periodic runs


def runs(own, least=12):
    found = {}
    for q in range(1, len(own) // 2 + 1):
        i = 0
        while i + q < len(own):
            if own[i] != own[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(own) and own[i] == own[i + q]:
                i += 1
            if i - start + q >= max(least, 2 * q):
                found.setdefault((start, i - start + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [1, 5, 12, 13])
def test_runs_of_random_words(least):
    rng = random.Random(13)
    texts = []
    for _ in range(800):
        n = rng.randint(0, 60)
        own = rng.choices(rng.choice(["ab", "abc", "abcdefg"]), k=n)
        if rng.random() < 0.5 and n:
            a, p = rng.randrange(n), rng.randint(1, 8)
            own = [own[i] if i < a else own[min(n - 1, a + (i - a) % p)] for i in range(n)]
        texts.append(own)
    assert periodic.runs_of(texts, Runs(least)) == [runs(own, least) for own in texts]


def test_runs_of_long_texts():
    assert periodic.runs_of([["a"] * 30000, list("abc") * 10000, []], Runs()) == [[(0, 30000, 1)], [(0, 30000, 3)], []]
    phrases = [w for k in range(3000) for w in (f"x{k}", *"abcdefgh")]
    assert periodic.runs_of([phrases], Runs()) == [[]]
    many = [w for k in range(500) for w in (f"x{k}", *["a"] * 40)]
    assert periodic.runs_of([many], Runs()) == [[(41 * k + 1, 40, 1) for k in range(500)]]


def digest(doc_id, own):
    found = runs(own)
    stays = [True] * len(own)
    for start, length, period in found:
        for k in range(start + period, start + length):
            stays[k] = False
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(w for w, stay in zip(own, stays) if stay)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def planted(doc_id, own):
    h, n = zlib.crc32(b"%d" % doc_id), len(own)
    if h % 10 or not n:
        return own
    a = (h // 10) % n
    p = 1 + (n - a) // (3 + (h // 10) % 8)
    return own[:a] + [own[a + k % p] for k in range(n - a)]


def test_runs_of_the_documents(spark):
    rows = [(r.doc_id, (r.text or "").encode().split()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r) for r in queries.op13_lcp_runs(spark, SF).collect()}
    assert len(got) == len(rows)
    short = [(i, planted(i, own)) for i, own in rows if len(own) < 800]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in short) > 50
    assert all(got[i] == digest(i, own) for i, own in short)


def test_runs_of_odd_rows(spark):
    rng = random.Random(3)
    line = words(rng, 7)
    rows = [*ODD, (50, " ".join(line * 3)), (51, "\n".join(line * 2)), (52, " ".join(["z", *line * 4, "z"]))]
    got = periodic.find_runs(documents(spark, rows)).collect()
    want = []
    for i, text, *_ in rows:
        own = (text or "").encode().split()
        found = [(0, 30000, 1)] if len(own) == 30000 else runs(own)
        want.append((i, len(own), tuple(found)))
    assert collections.Counter((r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs)) for r in got) == collections.Counter(want)
    collapsed = {r.doc_id: r.collapsed for r in got}
    assert collapsed[8] == "word" and collapsed[2] == collapsed[3] == collapsed[4] == "" and collapsed[50] == collapsed[51] == " ".join(line)
    assert periodic.find_runs(documents(spark, [])).collect() == []
