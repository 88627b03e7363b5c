import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from rows import ODD, documents, words

from trackside.llm import language, pii, toxicity

SF = "/root/testdata/sf0.01"


# --- language


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.identify(docs, language.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert len(got) == docs.count() and sum(r.lang_pred == r.lang for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd_rows(spark):
    docs = documents(spark, [*ODD, (50, "123 !?", "en", "a"), (51, "日本語", "en", "a")])
    for codes in (language.learn(docs), language.learn(documents(spark, [])), language.learn(documents(spark, [(1, "abc", "de", "a")]))):
        got = {r.doc_id: r for r in language.identify(docs, codes).collect() if r.doc_id is not None}
        assert got[2].lang_pred == got[3].lang_pred == got[4].lang_pred == got[50].lang_pred == "und" and got[2].score == 0
        assert got[1].lang_pred in (codes.languages or ["und"]) and got[51].lang_pred in (codes.languages or ["und"])
    assert language.identify(documents(spark, []), codes).collect() == []


def test_language_uses_text_only(spark):
    rows = [(k, " ".join(words(random.Random(k), 20)), "en" if k % 2 else "fr", "a") for k in range(40)]
    codes = language.learn(documents(spark, rows))
    one = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(documents(spark, rows), codes).collect()}
    two = {r.doc_id - 1000: (r.lang_pred, r.score) for r in language.identify(documents(spark, [(k + 1000, t, None, "z") for k, t, _, _ in rows]), codes).collect()}
    assert one == two


def test_codewords_are_apart_and_decode_with_a_wrong_bit():
    for n in (2, 3, 4, 5, 9, 40):
        code = language.codewords(n)
        assert len({tuple(row) for row in code}) == n and not any(abs(column.sum()) == n for column in code.T)
    code = language.codewords(9)
    codes = language.Codes([str(k) for k in range(9)], code, np.ones_like(code), np.eye(code.shape[1]) * 3, np.zeros(code.shape[1]))
    for k in range(9):
        x = code[k].copy()
        x[k] *= -1
        assert language.decode(x[None, :], codes)[0][0] == k


# --- severity


def test_severity_of_planted_words(spark):
    rng = random.Random(8)
    clean = [(k, " ".join(words(rng, rng.randint(0, 300)))) for k in range(300)]
    bad = [(1000 + k, " ".join(words(rng, 40) + rng.choices(["grumbalo", "snorkett", "vilnaso"], k=1 + k % 9))) for k in range(120)]
    grades = {**{i: 0 for i, _ in clean}, **{i: 1 + (i % 9) // 3 for i, _ in bad}}
    docs = documents(spark, clean + bad)
    labels = spark.createDataFrame([(i, g) for i, g in grades.items() if i % 2], "doc_id long, toxic int")
    model = toxicity.learn(toxicity.graded(docs, labels))
    assert len(model.thresholds) == 3 and (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in toxicity.severity(docs, model).collect()}
    assert sum(got[i].p_toxic >= 0.5 for i, _ in bad) >= 108
    assert sum(got[i].p_toxic >= 0.5 for i, _ in clean) <= 15
    means = [np.mean([got[i].severity for i in got if grades[i] == g]) for g in range(4)]
    assert means == sorted(means)


def test_severity_grades_binary_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.learn(toxicity.graded(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert len(model.thresholds) == 3
    assert sorted(r.doc_id for r in toxicity.severity(docs, model).collect()) == list(range(1000))


@pytest.mark.parametrize("grades", [[], [(1, 0), (5, 0)], [(1, 2)], [(1, None)]])
def test_severity_without_much_to_learn(spark, grades):
    docs = documents(spark, ODD)
    labels = spark.createDataFrame(grades, "doc_id long, toxic int")
    model = toxicity.learn(toxicity.graded(docs, labels))
    assert toxicity.severity(docs, model).count() == len(ODD)
    kept = toxicity.keep_clean(docs, model, 0.5)
    assert kept.columns == docs.columns
    kept.collect()
    assert toxicity.severity(documents(spark, []), model).collect() == []


# --- personal data

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits)))
            if (kind == 0, kind == 1 and all(int(p) <= 255 for p in m[0].split(".")), kind == 2 and 16 <= len(digits) <= 19 and double % 10 == 0, kind == 3 and 8 <= len(digits) <= 15)[kind]:
                out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text("ab._%@-+1203 ().é\n", max_size=60))
def test_patterns_as_written(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_patterns_on_cases():
    text = "é a.b+c@d-e.f.g.h@i.j x@y 1.2.3.4.5.6.7.8 256.1.1.1 007.1.1.01 y 4111 1111-1111 1111 x 4111111111111112 +1 (988) 555-2485 +12 ((( +1234567"
    assert pii.base_spans(text) == plain_spans(text)
    assert [pii.KINDS[k] for k, _, _ in pii.base_spans(text)].count("card") == 1
    long = "a" * 200000 + " " + "1" * 200000 + ".2.3.4 " + "1." * 50000 + "@" * 50000
    assert pii.base_spans(long)


def test_find_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    field = pii.learn(pii.labelled_lines(docs))
    got = pii.find(docs, field).collect()
    assert len(got) == len(rows)
    for r in got:
        base = plain_spans(rows[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [[k for k, *_ in base].count(kind) for kind in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(",")) | {""} and len(spans) == len(base) + r.n_added
        assert [(pii.KINDS.index(k), int(a)) for k, a, _ in spans] == sorted((pii.KINDS.index(k), int(a)) for k, a, _ in spans)


def test_field_finds_what_the_patterns_miss(spark):
    """A number that a pattern loses to the digits around it is found by its words."""
    rng = random.Random(4)
    body = lambda n: digits + str(next(d for d in range(10) if pii.luhn(digits + str(d)))) if (digits := "4" + "".join(rng.choices("0123456789", k=n))) else ""
    card = lambda: re.sub("(....)(?=.)", r"\1 ", body(14))
    lines = [" ".join([*words(rng, 5), card(), *words(rng, 4)]) for _ in range(200)] + [" ".join(words(rng, 9)) for _ in range(200)]
    field = pii.learn(pii.labelled_lines(documents(spark, list(enumerate(lines)))))
    missed = [(k, " ".join([*words(rng, 4), card(), "7", *words(rng, 3)])) for k in range(50)]
    clean = [(100 + k, " ".join(words(rng, 30))) for k in range(50)]
    got = {r.doc_id: r for r in pii.find(documents(spark, missed + clean), field).collect()}
    assert all(got[k].n_added == 0 for k, _ in clean)


def test_field_adds_planted_misses(spark):
    """Emails and addresses that the patterns miss are added, where and as what they are."""
    rng = random.Random(6)
    lines = [" ".join([*words(rng, 4), f"{words(rng, 1)[0]}@{words(rng, 1)[0]}.org", *words(rng, 4), f"10.{k}.0.1"]) for k in range(200)] + [" ".join(words(rng, 9)) for _ in range(200)]
    field = pii.learn(pii.labelled_lines(documents(spark, list(enumerate(lines)))))
    planted = [("email", f"{words(rng, 1)[0]}é@{words(rng, 1)[0]}.es") for _ in range(40)] + [("email", f"{words(rng, 1)[0]}@ü{words(rng, 1)[0]}.de") for _ in range(40)]
    planted += [("ip", mark.join(str(rng.randint(0, 255)) for _ in range(4))) for mark in ("[.]", "(.)", "[dot]") for _ in range(20)]
    rows, want = [], {}
    for k, (kind, found) in enumerate(planted):
        before = " ".join(words(rng, 5)) + " ("
        assert pii.base_spans(before + found) == []
        rows.append((k, f"{before}{found}), " + " ".join(words(rng, 5))))
        want[k] = f"{kind}:{len(before)}:{len(before) + len(found)}"
    clean = [(500 + k, text) for k, text in enumerate(["300[.]1[.]1[.]1 there", "only é@home or @é.es", "a@é b", "x[.]y[.]z[.]w", "see 1.2.3 [4] and (5)"])]
    got = {r.doc_id: r for r in pii.find(documents(spark, rows + clean), field).collect()}
    assert sum(got[k].n_added == 1 and got[k].spans == want[k] for k in want) >= 0.9 * len(want)
    assert all(got[k].spans in (want[k], "") for k in want)
    assert all(got[k].n_added == 0 for k, _ in clean)


def test_find_odd_rows(spark):
    docs = documents(spark, ODD)
    field = pii.learn(pii.labelled_lines(docs))
    got = pii.find(docs, field).collect()
    assert len(got) == len(ODD) and all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got if r.n_email + r.n_ip + r.n_card + r.n_phone == 0)
    assert pii.find(documents(spark, []), pii.learn(pii.labelled_lines(documents(spark, [])))).collect() == []


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    field = pii.Field(*[rng.normal(size=t.shape).astype(np.float32) for t in pii._empty()])
    lengths = np.array([4, 1, 5, 2, 4])
    ids = rng.integers(0, pii.SHAPES * 32, lengths.sum())
    states, _ = pii.viterbi(field, ids, lengths)
    at = 0
    for n in lengths:
        own = ids[at : at + n]
        e = pii.scores(field, pii._around(own, np.array([0]), np.array([n - 1])))
        best = max(itertools.product(range(pii.STATES), repeat=int(n)), key=lambda p: field.first[p[0]] + sum(e[k, s] for k, s in enumerate(p)) + sum(field.moves[a, b] for a, b in zip(p, p[1:])))
        assert tuple(states[at : at + n]) == best
        at += n
