"""Language model, toxicity and personal data: brute force, held-out accuracy, odd inputs."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from rfspark.llm import pii, pitman_yor, string_kernel
from rfspark.llm.common import crc_bucket, ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def corpus(n=400):
    rng = random.Random(6)
    nouns = [f"noun{i}" for i in range(300)]
    rows = []
    for i in range(n):
        out = []
        for _ in range(rng.randint(0, 40)):
            out += ["the", rng.choice(nouns[: rng.randint(1, 300)])] if rng.random() < 0.7 else ["of", "Course"]
        rows.append((i, " ".join(out)))
    return rows


def test_language_model_base_and_held_out(spark):
    rows = corpus() + [(1000, None), (1001, ""), (1002, "neverseen words\x0bhere"), (None, "the the")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    got = {r["id"]: r for r in pitman_yor.score(docs, crc_bucket(F.col("doc_id"), 7) != 2).collect()}

    def held(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2

    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    assert set(got) == {i for i, _ in rows}
    for i, t in rows:
        r, ws = got[i], tokens(t)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
        assert r["score"] < 0
    out = [i for i, _ in rows if held(i)]
    assert sum(got[i]["score"] for i in out) > sum(got[i]["base_score"] for i in out) + 0.1 * sum(got[i]["n_tokens"] for i in out)


def test_language_model_repeats_and_ids_that_repeat(spark):
    rows = corpus(60)
    once = spark.createDataFrame(rows, "doc_id long, text string")
    a = {r["id"]: r["score"] for r in pitman_yor.score(once, F.lit(True)).collect()}
    b = {r["id"]: r["score"] for r in pitman_yor.score(once.repartition(7), F.lit(True)).collect()}
    assert a == pytest.approx(b)
    twice = spark.createDataFrame([(1, "a b"), (1, "c")], "doc_id long, text string")
    assert [r["n_tokens"] for r in pitman_yor.score(twice, F.lit(True)).collect()] == [5]


def test_language_model_with_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = pitman_yor.score(docs, F.lit(False)).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)
    assert pitman_yor.score(docs.limit(0), F.lit(True)).count() == 0


def test_probabilities_of_all_words_and_the_unknown_sum_to_one():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 400, (30, pitman_yor.CONTEXTS)) * (rng.random((30, pitman_yor.CONTEXTS)) < 0.3)
    group, u = np.nonzero(counts)
    n, w = counts[group, u], np.arange(30, dtype=np.int64)
    model = pitman_yor.Model(0.7, 0.6, 1 / 31, [])
    for _ in range(4):
        for _, tables, up, parents in pitman_yor._chain(model, w, group, u, n, 30):
            pass
        assert (tables >= 1).all() and (tables <= n).all()
        sums = [np.bincount(u, weights=x, minlength=pitman_yor.CONTEXTS) for x in (n, tables)]
        model.sweeps.append(pitman_yor.Totals(*sums, up.sum(), parents.sum()))
    ask = np.repeat(np.arange(31), pitman_yor.CONTEXTS), np.tile(np.arange(pitman_yor.CONTEXTS), 31)
    p = pitman_yor._averaged(model, 1, np.arange(31), group, u, n, 31, *ask).reshape(31, -1)
    assert p.sum(axis=0) == pytest.approx(np.ones(pitman_yor.CONTEXTS))


def test_seats_have_the_right_mean():
    """The number of tables against a plain Chinese restaurant, also where tables are drawn several at a time."""
    rng = random.Random(0)
    for customers in (40, 800):
        tables = []
        for _ in range(400):
            t = 1
            for k in range(1, customers):
                t += rng.random() < 2.0 / (2.0 + k - 0.5 * t)
            tables.append(t)
        got = pitman_yor.seated(np.full(4000, customers), np.full(4000, 2.0), 0.5, np.arange(4000, dtype=np.uint64))
        assert got.mean() == pytest.approx(np.mean(tables), rel=0.06)


INSULTS = ["idiot", "moron", "scum", "loser", "clown"]


def labelled(n, seed, spell=lambda w: w):
    rng = random.Random(seed)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(rng.randint(20, 120))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = spell(rng.choice(INSULTS))
        text = " ".join(words)
        rows.append((i, re.sub(r" (\w{9})", r". \1", text), toxic))
    return rows


def test_toxic_texts_are_told_apart_also_when_spelled_oddly(spark):
    rows = labelled(500, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows if i < 350] + [(349, None), (None, 1)], "doc_id long, toxic int")
    machine = string_kernel.fit(docs, labels)
    p = machine.probability(machine.evidence(pa.array([t for _, t, _ in rows[350:]])))
    right = (p >= 0.5) == np.array([x for _, _, x in rows[350:]], bool)
    assert right.mean() > 0.97
    for spell in (lambda w: "-".join(w), lambda w: w.upper() + "!!", lambda w: w.replace("o", "0"), lambda w: w + "###"):
        odd = labelled(200, 2, spell)
        p = machine.probability(machine.evidence(pa.array([t for _, t, _ in odd])))
        assert ((p >= 0.5) == np.array([x for _, _, x in odd], bool)).mean() > 0.9
    extra = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (None, "x " * 200_000, 1.0)], "doc_id long, text string, score double")
    assert all(0 <= r["score"] <= 1 for r in string_kernel.scores(extra, machine).collect())
    kept = string_kernel.keep_clean(docs.unionByName(extra.drop("score")), machine)
    gone = {i for i, _, x in rows if x} & {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns and len(gone) <= 0.05 * sum(x for *_, x in rows)


def test_toxicity_without_two_classes(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    for labels in ([], [(1, 0)], [(1, 1), (2, 1)]):
        machine = string_kernel.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        scores = [r["score"] for r in string_kernel.scores(docs, machine).collect()]
        assert len(set(scores)) == 1 and 0 <= scores[0] <= 0.5 + 1e-9
    assert string_kernel.scores(docs.limit(0), machine).count() == 0


def test_kernel_is_the_plain_sum_over_subsequences():
    def plain(s, t):
        def weights(x):
            x, out = "\0" + x + "\0", Counter()
            for i in range(len(x)):
                for j in range(i + 1, len(x)):
                    for k in range(j + 1, len(x)):
                        if k - i < string_kernel.SPAN:
                            out[x[i], x[j], x[k]] += string_kernel.DECAY ** (k - i - 2)
            return out

        a, b = weights(s), weights(t)
        return sum(v * b[f] for f, v in a.items())

    words = ["idiot", "idxiot", "moron", "trash", "thrash", "aa", "abcabcabc"]
    got = string_kernel.kernel(words, words)
    scale = string_kernel._weights(np.array([len(w) + 2 for w in words]))
    want = np.array([[plain(a, b) for b in words] for a in words]) / np.outer(scale, scale)
    assert got == pytest.approx(want, abs=1e-5)


PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = (
                kind == 0
                or (kind == 1 and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == 2 and 16 <= len(digits) <= 19 and pii.luhn(digits))
                or (kind == 3 and 8 <= len(digits) <= 15)
            )
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(3)
    for alphabet in ("ab.@+-1234567890 ()@%\n..", "0123456789 -", "+0123456789 ().-", "a@.b", "012.5"):
        for _ in range(3000):
            text = "".join(rng.choices(alphabet, k=rng.randint(0, 45)))
            assert pii.base_spans(text) == plain_spans(text), text


def test_very_long_runs_take_no_longer_than_their_length():
    for text in ("1" * 400_000, "1." * 200_000, "a" * 400_000 + "@", "+1 " * 100_000, "1 " * 200_000, "a@" * 100_000):
        pii.spans_of(text, None)


def with_personal(n=600):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(30)]
        kind = i % 6
        if kind == 0:
            words[9] = f"jo{i}@mail{i % 9}.example.com"
        elif kind == 1:
            words[9] = ".".join(str(rng.randint(0, 255)) for _ in range(4))
        elif kind == 2:
            words[9] = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        elif kind == 3:
            digits = "".join(rng.choices("0123456789", k=15))
            words[9] = next(digits + d for d in "0123456789" if pii.luhn(digits + d))
        elif kind == 4:
            words[9] = str(rng.randint(10**9, 10**10)) + " key " + "".join(rng.choices("0123456789abcdef", k=30))
        rows.append((i, " ".join(words)))
    return rows


def test_base_stays_and_loose_forms_are_added(spark):
    rows = with_personal() + [(None, None), (1, ""), (2, rows_text := "mail ann [at] mail3 [dot] example [dot] com or (415) 555-2671")]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, spans string")
    model = pii.fit(docs)
    assert model is not None
    found = pii.find(docs, model).collect()
    assert len(found) == len(rows)
    by = {(r["id"], r["base"]): r for r in found}
    for i, t in rows:
        base = plain_spans(t or "")
        written = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        r = by[i, written]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == j for x in base) for j in range(4)]
        assert set(filter(None, written.split(","))) <= set(r["spans"].split(","))
    added = pii.spans_of(rows_text, model)[1]
    assert {rows_text[s:e] for _, s, e in added} >= {"ann [at] mail3 [dot] example [dot] com"}
    clean = [t for i, t in rows if i is not None and i % 6 == 5 and i < 600]
    assert all(pii.spans_of(t, model)[1] == [] for t in clean)
    hidden = pii.redact(docs, model)
    assert hidden.columns == docs.columns and hidden.count() == docs.count()
    assert not any(plain_spans(r["text"] or "") for r in hidden.collect())
    assert hidden.where("text is null").count() == 1


def test_nothing_to_learn_or_to_search(spark):
    docs = spark.createDataFrame([(1, "plain words"), (2, "a@b.example")], "doc_id long, text string")
    model = pii.fit(docs)
    assert [r["spans"] for r in pii.find(docs.orderBy("doc_id"), model).collect()] == ["", "email:0:11"]
    assert pii.fit(docs.limit(0)) is None and pii.find(docs.limit(0), None).count() == 0
    assert pii.redacted("x a@b.c y", [(0, 2, 7), (3, 4, 7)]) == "x [EMAIL] y"


def test_no_text_with_a_candidate_is_passed_over():
    rng = random.Random(8)
    middle = ["at", "@", "(", ")", "[", "]", "{", "}", " ", "\t", "\u00a0", "\u3000", "dot", "."]
    texts = ["joe{at}example.com", "joe(\tat)example.com", "joe [ at ] example dot com", "joe @ example.com", "joe{ at }example.com"]
    assert all(pii.candidates(t, []) for t in texts)
    for _ in range(30_000):
        here = "".join(rng.choices(middle, k=rng.randint(1, 6)))
        texts.append(rng.choice(["joe", "1.2", "+"]) + here + rng.choice(["example.com", "b dot c", "9"]))
    hopeful = pc.match_substring_regex(pa.array(texts), pii.HOPEFUL).to_pylist()
    found = [bool(pii.candidates(t, []) or pii.base_spans(t)) for t in texts]
    assert sum(found) > 100 and not all(hopeful)
    assert [t for t, f, h in zip(texts, found, hopeful) if f and not h] == []
