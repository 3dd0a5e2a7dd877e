"""Packing and merge-dropout: round trips, limits, and odd inputs."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rfspark.llm import merge_dropout, packing
from rfspark.llm.common import ship, words_of
from rfspark.llm.queries import tokenizer

WORDS, PIECES = tokenizer("word_bpe_49k.json"), tokenizer("piece_bpe_32k.model")
ODD = [
    "", None, " ", "  a  b ", "x▁y", "\x00\n\n", "名前は 田中です。" * 9, "🙂 é́ ﬁ ß İ", "it's DON'T 12ab3\x0bq a\u0085b",
    "a<|endoftext|>b", "q" * 3000, "the weather " * 900, "tail \n",
]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def test_words_are_those_of_plain_python_also_in_slices():
    texts = pa.array(ODD * 3)
    for part in (texts, texts.slice(5, 20), texts.slice(1, 1), texts.slice(0, 0)):
        codes, words, starts = words_of(part)
        words = words.to_pylist()
        got = [[words[c] for c in codes[a:b]] for a, b in zip(starts, starts[1:])]
        assert got == [(t or "").encode().lower().split() for t in part.to_pylist()]


def test_ids_are_the_tokenizers_own():
    plain, coder = Tokenizer.from_file(WORDS), packing.WordIds(WORDS)
    for _ in range(2):  # the second time from what it knows
        ids, starts = coder.encode(pa.array(ODD))
        for t, a, b in zip(ODD, starts, starts[1:]):
            assert ids[a:b].tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_little_is_with_the_tokenizer_at_a_time_and_words_of_two_batches_are_remembered():
    plain, coder = Tokenizer.from_file(WORDS), packing.WordIds(WORDS)
    asked = []

    class Watched:
        def encode_batch_fast(self, texts, **how):
            asked.append(sum(len(t.split()) for t in texts))
            return plain.encode_batch_fast(texts, **how)

    coder.model = Watched()
    words = [f"w{i}x" for i in range(40_000)] + [f"名{i}" for i in range(5000)]
    text = " ".join(words)
    for _ in range(2):
        ids, starts = coder.encode(pa.array([text, None, "the end"]))
        assert ids[: starts[1]].tolist() == plain.encode(text, add_special_tokens=False).ids
        assert ids[starts[2] :].tolist() == plain.encode("the end", add_special_tokens=False).ids
    assert 0 < max(asked) <= 16_000
    asked.clear()
    coder.encode(pa.array([text]))
    assert sum(asked) == 0


@pytest.mark.parametrize("limits", [(2048, 256, 2048), (64, 3, 64), (64, 64, 64)])
def test_no_limit_is_broken_and_every_id_lies_in_one_piece(spark, limits):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["the", "of", "cat", "zebra"], k=rng.choice([0, 1, 5, 40, 300])))) for i in range(120)]
    rows += [(200 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (5, rows[5][1])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, block int")
    cut = packing.pieces(docs, WORDS, tokens=limits[0], with_ids=True)
    got = [r.asDict() for r in packing.pack(cut, *limits).collect()]
    plain = Tokenizer.from_file(WORDS)
    want = sorted(((i, [*plain.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows), key=repr)
    docs_back = {}
    for r in got:
        assert r["length"] == len(r["ids"]) <= limits[0] and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        docs_back.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["ids"]))
    back = []
    for (i, n), parts in docs_back.items():
        copies = sum(s == 0 for s, _ in parts)
        ids = [x for _, p in sorted(parts)[::copies] for x in p]
        assert len(ids) == n
        back += [(i, ids)] * copies
    assert sorted(back, key=repr) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for s in sequences.values():
        s.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in s])
        assert [r["offset"] for r in s] == [0, *ends[:-1].tolist()]
        assert ends[-1] <= limits[0] and len(s) <= limits[1] and sum(r["length"] - 1 for r in s) <= limits[2]
    assert packing.pack(packing.pieces(docs.limit(0), WORDS)).count() == 0


def test_little_is_padded():
    rng = np.random.default_rng(3)
    length = np.minimum(2048, rng.geometric(1 / 600, 4096))
    bins = packing.fill(np.column_stack([length, np.ones(4096, int), length - 1]), np.array([2048, 256, 2048]))
    assert length.sum() / 2048 / (bins.max() + 1) > 0.99


def test_without_dropout_the_ids_are_the_librarys():
    plain, coder = sentencepiece.SentencePieceProcessor(model_file=PIECES), merge_dropout.MergeDropout(PIECES, 0.0)
    texts = [t for t in ODD if t is None or "▁" not in t] + ["a   b", "   x", "don't  stop\tnow", "x" * 40 + " " * 40 + "y"]
    ids, starts = coder.encode(pa.array(texts), np.arange(len(texts), dtype=np.uint64))
    for t, a, b in zip(texts, starts, starts[1:]):
        assert ids[a:b].tolist() == plain.encode(t or "")


def test_dropout_varies_repeats_and_loses_nothing():
    plain = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts, keys = ODD + ["the weather is unbelievable today"] * 30, np.arange(len(ODD) + 30, dtype=np.uint64)
    seen = []
    for seed in (1, 2):
        coder = merge_dropout.MergeDropout(PIECES, 0.3, seed)
        ids, starts = coder.encode(pa.array(texts), keys)
        assert coder.decode(ids, starts).to_pylist() == [t or "" for t in texts]
        again, _ = coder.encode(pa.array(texts), keys)
        assert (again == ids).all()
        alone, _ = coder.encode(pa.array(texts[7:8]), keys[7:8])
        assert alone.tolist() == ids[starts[7] : starts[8]].tolist()
        for t, a, b in zip(texts, starts, starts[1:]):
            assert plain.decode(ids[a:b].tolist()) == (t or "").replace("▁", "▁")
        seen.append([tuple(ids[a:b]) for a, b in zip(starts, starts[1:])])
    assert seen[0] != seen[1] and len(set(seen[0][-30:])) > 10


def test_short_and_long_ways_agree():
    """The arrays and the heap are one agenda."""
    rng = random.Random(4)
    coder = merge_dropout.MergeDropout(PIECES, 0.2, 9)
    for _ in range(200):
        text = "".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 30)))
        sym = coder.char[np.frombuffer((" " + text).encode("utf-32-le"), np.uint32)]
        key = np.array([rng.getrandbits(64)], np.uint64)
        short, size, row = coder._short(sym[None, :], np.zeros(40, np.int64), key + np.arange(40, dtype=np.uint64))
        for i, r in enumerate(row.tolist()):
            assert short[r, : size[r]].tolist() == coder._long(sym.tolist(), key[0] + np.uint64(i))


def test_every_occurrence_of_a_word_is_drawn_on_its_own():
    """The share of occurrences that differ from the plain segmentation is that of a drop among its candidates."""
    coder = merge_dropout.MergeDropout(PIECES, 0.1, 5)
    n = 4000
    for word in ("the", "because", "mother", "government"):
        ids, starts = coder.encode(pa.array([word] * n), np.arange(n, dtype=np.uint64))
        kinds = [tuple(ids[a:b]) for a, b in zip(starts, starts[1:])]
        plain = tuple(merge_dropout.MergeDropout(PIECES, 0.0).encode(pa.array([word]), np.zeros(1, np.uint64))[0])
        share = sum(k != plain for k in kinds) / n
        # One candidate at least has to be skipped, and each is with the rate.
        assert 0.08 < share < 0.95 and len(set(kinds)) >= (3 if len(word) == 3 else 8)
        one, at = coder.encode(pa.array([" ".join([word] * n)]), np.array([7], np.uint64))
        assert at.tolist() == [0, len(one)] and len(one) > n
        assert coder.decode(one, at).to_pylist() == [" ".join([word] * n)]


def test_dropout_in_spark(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)] + [(None, "x y", 2), (1, None, 3)], "doc_id long, text string, ids int")
    encoded = merge_dropout.encode(docs, PIECES, rate=0.2, seed=3)
    back = sorted((tuple(r) for r in merge_dropout.decode(encoded, PIECES).collect()), key=repr)
    assert back == sorted(((r[0], r[1] or "") for r in docs.collect()), key=repr)
    trip = merge_dropout.round_trip(docs, PIECES, rate=0.2, seed=3).collect()
    assert all(r["lossless"] for r in trip) and len(trip) == docs.count()
    assert {r["id"]: len(r["ids"]) for r in encoded.collect()} == {r["id"]: r["n_ids"] for r in trip}
    assert merge_dropout.encode(docs.limit(0), PIECES).count() == 0
