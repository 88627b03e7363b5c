import collections
import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest
from rows import ODD, documents, words

from trackside.llm.components import components
from trackside.llm.exact_dedup import Hasher, combined, exact_duplicates
from trackside.llm import near_dedup
from trackside.llm.near_dedup import Settings, near_duplicates
from trackside.llm.substring import Sketch, Windows, remove_repeats

BLANKS = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- equal texts


def equal_texts(rows):
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[BLANKS.sub("", text or "")].append((-len(text or ""), i is None, i or 0, i))
    out = []
    for bare, own in groups.items():
        keep = min(own)[3]
        out += [(i, keep, len(own), hashlib.sha256(bare.encode()).hexdigest()) for *_, i in own]
    return collections.Counter(out)


@pytest.mark.parametrize("hasher", [None, Hasher(chunk=4), Hasher(chunk=3, primes=(2, 3))], ids=["plain", "chunks", "collisions"])
def test_exact_against_groups(spark, hasher):
    rng = random.Random(3)
    rows = [r[:2] for r in ODD] + [(100 + k, " ".join(rng.choices("ab cd ab  ef".split(" "), k=rng.randint(0, 3)))) for k in range(60)]
    got = exact_duplicates(documents(spark, rows), hasher).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == equal_texts(rows)
    kept = collections.Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_empty(spark):
    assert exact_duplicates(documents(spark, [])).collect() == []


def test_hashes_compose(spark):
    """The hash of a whole follows from those of its chunks, however it is cut."""
    from pyspark.sql import functions as F

    data = bytes(random.Random(1).randbytes(1000))
    for size in (1, 7, 1000):
        hasher = Hasher(chunk=size)
        parts = [(no, *hasher.hashes(chunk)) for no, chunk in enumerate(hasher.chunks(data))]
        df = spark.createDataFrame([(parts,)], "parts array<struct<no:int,h0:long,s0:long,h1:long,s1:long>>")
        got = df.select(*[combined(F.col("parts"), p, k) for k, p in enumerate(hasher.primes)]).first()
        assert list(got) == [sum(b * pow(base, len(data) - 1 - i, p) for i, b in enumerate(data)) % p for p, base in zip(hasher.primes, (1103515245, 741103597))]


# --- repeated windows


def without_repeats(rows, length):
    least = {}
    split = [(i, WORD.findall(text or "")) for i, text in rows]
    for i, own in split:
        for k in range(len(own) - length + 1):
            if i is not None:
                window = tuple(own[k : k + length])
                least[window] = min(least.get(window, i), i)
    out = []
    for i, own in split:
        gone = set()
        for k in range(len(own) - length + 1):
            if i is not None and least[tuple(own[k : k + length])] < i:
                gone.update(range(k, k + length))
        out.append((i, len(own), len(gone), " ".join(w for k, w in enumerate(own) if k not in gone)))
    return collections.Counter(out)


@pytest.mark.parametrize("length", [1, 3, 13])
def test_windows_against_all(spark, length):
    rng = random.Random(length)
    shared = [words(rng, 40) for _ in range(4)]
    rows = [r[:2] for r in ODD]
    for k in range(60):
        own = words(rng, rng.randint(0, 60))
        if k % 2:
            passage, at = rng.choice(shared), rng.randint(0, 20)
            own[rng.randint(0, len(own)) : 0] = passage[at : at + rng.randint(5, 20)]
        rows.append((100 + k, rng.choice([" ", "\n", "  "]).join(own)))
    rows += [(500, rows[-1][1]), (500, rows[-2][1]), (501, "A a " * 20)]
    got = remove_repeats(documents(spark, rows), Windows(length))
    assert collections.Counter(map(tuple, got.collect())) == without_repeats(rows, length)


def test_hot_windows_do_not_meet_in_one_bucket(spark):
    """A passage in every document and a word said again and again: few rows reach a bucket."""
    from pyspark.sql import functions as F

    from trackside.llm import substring

    rng = random.Random(8)
    passage = words(rng, 40)
    rows = [(k, " ".join(words(rng, 20) + passage + words(rng, 20))) for k in range(600)] + [(1000, "la " * 5000), (1001, "la ti " * 3000)]
    windows = Windows()
    windows.bits_used = 16
    docs = substring._documents(documents(spark, rows))
    sent = substring._candidates(docs, windows, substring.anchor_sketch(docs, windows, 16), 16)
    met = sent.groupBy("bucket").agg(F.sum(F.octet_length("doc_id") / 8).alias("n")).agg(F.max("n")).first()[0]
    assert met <= 2000  # of 28 windows of the passage and up to 24 that touch it in each of 600 documents, and 11 000 of one or two words
    assert collections.Counter(map(tuple, remove_repeats(documents(spark, rows)).collect())) == without_repeats(rows, 13)


@pytest.mark.parametrize("length", [1, 2, 13])
def test_windows_repeated_within_texts(spark, length):
    rng = random.Random(20 + length)
    rows = []
    for k in range(40):
        unit = rng.choices("a b c d e f".split(), k=rng.choice([1, 2, 3, 12, 13, 14, 20]))
        rows.append((k // 2 * 2, " ".join((words(rng, rng.randint(0, 5)) + unit * rng.randint(1, 6)) * rng.randint(1, 2))))
    got = remove_repeats(documents(spark, rows), Windows(length))
    assert collections.Counter(map(tuple, got.collect())) == without_repeats(rows, length)


def test_windows_empty(spark):
    assert remove_repeats(documents(spark, [])).collect() == []


def test_sketch_never_underestimates():
    import numpy as np

    values = np.random.default_rng(1).integers(0, 2000, 5000).astype(np.uint64)
    parts = [Sketch(10), Sketch(10)]
    parts[0].add(values[:2500])
    for at in range(2500, 5000, 100):
        parts[1].add(values[at : at + 100])
    a, b = parts
    merged = Sketch(10, a.seen | b.seen, a.again | b.again | (a.seen & b.seen))
    numbers, counts = np.unique(values, return_counts=True)
    assert merged.repeated(numbers[counts > 1]).all()
    large = Sketch(20)
    large.add(values)
    assert large.repeated(numbers).sum() <= (counts > 1).sum() + 10


# --- near duplicates


def shingles(text):
    own = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(own[k : k + 5]) for k in range(max(1, len(own) - 4))) if own else frozenset()


def near(rows):
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return collections.Counter((i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows))


def copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(len(own))] = rng.choice(words(rng, 1))
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("settings", [Settings(), Settings(limit=4), Settings(limit=3, depth=1)], ids=["plain", "branching", "rest"])
def test_near_against_all_pairs(spark, settings):
    rng = random.Random(5)
    rows, k = [r[:2] for r in ODD], 100
    passage = words(rng, 25)  # that many documents share: large nodes of unlike texts
    for text in [t for n, e in ((1, 0), (2, 1), (6, 2), (40, 3)) for t in copies(rng, words(rng, 60), n, e)] + [" ".join(words(rng, 20) + passage) for _ in range(30)]:
        rows.append((k, text if k % 3 else text.upper()))
        k += 1
    rows += [(900 + n, " ".join(words(rng, 6)[:n])) for n in range(1, 6)] + [(990, "a b c d e f"), (991, "A b c d e f"), (992, "a b c d e")]
    got = near_duplicates(documents(spark, rows), settings).collect()
    want = near(rows)
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    ids = [r.doc_id for r in got if r.doc_id not in (None, 5)]
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id in set(ids))


def test_misses_of_trees_and_sketch_stay_within_the_recall():
    from math import comb

    s = Settings()
    below = sum(comb(s.sketch, k) * 0.75**k * 0.25 ** (s.sketch - k) for k in range(s.sketch) if k / s.sketch < s.cut)
    assert below + (1 - 0.75 * (1 - 0.25**s.splits) ** 2) ** s.trees <= 1 - s.recall


def test_near_empty(spark):
    assert near_duplicates(documents(spark, [])).collect() == []
    got = near_duplicates(documents(spark, [(3, None), (4, "")])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == [(3, 0, 3, True), (4, 0, 4, True)]


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(300)] + [(7, 7), (300, 100)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {**{k: 0 for k in range(41)}, 100: 100, **{200 + k: 100 for k in range(300)}}


def landed_rows(spark, monkeypatch, rows):
    """The result, and how many rows each intermediate table had."""
    counts = collections.Counter()
    real = near_dedup.landed

    def counting(df, name):
        out = real(df, name)
        counts[name] += out.count()
        return out

    with monkeypatch.context() as patch:
        patch.setattr(near_dedup, "landed", counting)
        got = near_duplicates(documents(spark, rows)).collect()
    return got, counts


def test_half_alike_texts_make_rows_by_text_not_by_pair(spark, monkeypatch):
    """A group of texts that share somewhat more than half, without a link: twice as many make about twice
    the rows in every table."""
    rng = random.Random(12)
    base = words(rng, 80)

    def group(n):
        out = []
        for k in range(n):
            own = list(base)
            for at in rng.sample(range(80), 3):
                own[at] = f"{k}x{at}"
            out.append((k, " ".join(own)))
        return out

    rows = group(240)
    few, some = landed_rows(spark, monkeypatch, rows[:120])
    many, more = landed_rows(spark, monkeypatch, rows)
    for got, part in ((few, rows[:120]), (many, rows)):
        assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == near(part)
    assert some["near-likely"] > 0
    assert all(more[name] <= 2.6 * some[name] + 40 for name in more), (some, more)


# --- memory of the tasks


def unlike_sets(m, n):
    """Sets of hashes of which some share three quarters."""
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
    return [np.unique(np.concatenate([base[rng.random(len(base)) < rng.choice([0.5, 0.9])], rng.integers(0, 2**64 - 1, n // 20, dtype=np.uint64)])) for _ in range(m)]


@pytest.mark.parametrize("at_once", [40, 1 << 18])
def test_forest_joins_all_linked(monkeypatch, at_once):
    monkeypatch.setattr(near_dedup, "RANGE", at_once)
    sets = unlike_sets(60, 80)
    links = near_dedup._forest(sets, np.arange(60), np.zeros(60, bool), 75, columns=16)
    sides = [set(s.tolist()) for s in sets]
    expected, got = list(range(60)), list(range(60))

    def join(root, x, y):
        one, other = root[x], root[y]
        root[:] = [one if r == other else r for r in root]

    for x in range(60):
        for y in range(x):
            if 100 * len(sides[x] & sides[y]) >= 75 * len(sides[x] | sides[y]):
                join(expected, x, y)
    for x, y in links:
        assert 100 * len(sides[x] & sides[y]) >= 75 * len(sides[x] | sides[y])
        join(got, x, y)
    parts = lambda root: {frozenset(k for k in range(60) if root[k] == r) for r in root}
    assert parts(got) == parts(expected) and 1 < len(parts(got)) < 60


def test_forest_holds_little_beside_its_counts():
    m = 1500
    sets = unlike_sets(m, 100)
    tracemalloc.start()
    near_dedup._forest(sets, np.arange(m), np.zeros(m, bool), 75)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 4 * 4 * m * m


def test_small_batches_while_duplicates_are_found(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen, sketched = spark.conf.get(name), [], near_dedup._sketched
    monkeypatch.setattr(near_dedup, "_sketched", lambda *a: seen.append(spark.conf.get(name)) or sketched(*a))
    near_duplicates(documents(spark, ODD)).collect()
    assert seen == ["2m"] and spark.conf.get(name) == before


def test_few_links_are_joined_without_rounds_and_slices_agree(spark, monkeypatch):
    from trackside.llm import components as module

    made, real = [], module.landed

    def counting(df, name):
        made.append(name)
        return real(df, name)

    monkeypatch.setattr(module, "landed", counting)
    links = [(k, k + 1) for k in range(60)] + [(500, 600 + k) for k in range(200)] + [(7, 3), (8, 8), (700, 500)]
    frame = spark.createDataFrame(links, "a long, b long")
    wanted = {**{k: 0 for k in range(61)}, 500: 500, **{600 + k: 500 for k in range(200)}}
    assert {r.node: r.component for r in components(frame).collect()} == wanted
    assert len(made) == 2
    monkeypatch.setattr(module, "SLICE", 40)
    rows = components(frame).collect()
    assert {r.node: r.component for r in rows} == wanted and len(rows) == len(wanted)
