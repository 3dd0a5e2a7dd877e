"""WARC, sharding and embeddings against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rfspark.llm import product_quantisation, sharding, warc
from rfspark.llm.common import ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


PAGES = [
    (1, "http://www.A.example.com:80/x?q=1#top", "p" * 200, "a"),
    (2, "https://b.example.com", "p" * 200, "b"),
    (3, None, "p" * 200, None),
    (4, "ftp://user@c.example.org:21/ü y", "short", "c"),
    (5, "http://a.example.com/x?q=1", "short", "c"),
    (6, "", None, "d"),
    (7, "no scheme\r\nat all", "", "d"),
    (-8, "http://z.example.com/\r\n\r\nx", "ä\r\n\r\n" * 60_000, "e"),
    (9, "http://z.example.com/", "ä\r\n\r\n" * 60_000, "e"),
]


def test_archives_give_back_every_page(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, id string")
    captures = warc.write(pages)
    index = warc.build_index(captures)
    records = {r["id"]: r for r in warc.read(warc.look_up(warc.keys_of(pages), index)).collect()}
    assert set(records) == {p[0] for p in PAGES}
    for i, url, html, _ in PAGES:
        raw = (html or "").encode()
        first = min(p[0] for p in PAGES if p[2] == html) if len(raw) >= 100 else i
        r = records[i]
        assert r["payload_bytes"] == len(raw) and r["payload_digest"] == hashlib.sha256(raw).hexdigest()
        assert r["record_type"] == ("response" if first == i else "revisit")
        assert r["refers_to"] == (None if first == i else first)
        assert r["payload"] == (raw if first == i else None)


def test_many_captures_over_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    rows = [(i, f"http://h{i % 5}.example.com/{i % 3}", f"body {i}") for i in range(300)] + [(5, "http://h0.example.com/2", "again")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.build_index(warc.write(pages))
    asked = warc.keys_of(pages).distinct()
    found = warc.look_up(asked, index)
    assert sorted(r["id"] for r in found.collect()) == sorted(r[0] for r in rows)
    missing = spark.createDataFrame([(1000, "com,example,h1)/0"), (2, "nobody)/")], "id long, key string")
    assert warc.look_up(missing, index).count() == 0


def test_no_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, id string").limit(0)
    index = warc.build_index(warc.write(pages))
    assert warc.read(warc.look_up(warc.keys_of(pages), index)).count() == 0


def test_url_keys():
    assert warc.url_key("HTTP://www.Sub.Example.com:8080/A/b?c#d") == "com,example,sub:8080)/a/b?c"
    assert warc.url_key("https://example.com?x") == "com,example)?x" and warc.url_key(None) == "-"


def sharded(df, shards, **how):
    rows = sharding.shard(df, shards, **how).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
    return rows, {k: sum(r["size"] for r in v) for k, v in by.items()}


def test_shards_are_even_and_keep_equal_texts_together(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choices("ab é", k=rng.randint(0, 400))), "s") for i in range(3000)]
    rows += [(5000 + i, "copied text", None) for i in range(40)] + [(None, None, "t"), (None, "", "t"), (7, rows[7][1], "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size string")
    got, sizes = sharded(docs, 8)
    assert sorted((tuple(r["row"]) for r in got), key=repr) == sorted(rows, key=repr)
    assert sum(sizes.values()) == sum(len((t or "").encode()) + 1 for _, t, _ in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 0.02 * sum(sizes.values()) / 8 + 802
    assert len({r["shard"] for r in got if r["row"]["text"] == "copied text"}) == 1


def test_one_text_fills_many_shards(spark):
    docs = spark.createDataFrame([(i % 3, "the same") for i in range(900)], "doc_id long, text string")
    _, sizes = sharded(docs, 4)
    assert set(sizes) == {0, 1, 2, 3} and max(sizes.values()) - min(sizes.values()) <= 0.02 * 2025 + 18


def test_few_rows_and_none(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert len(sharded(docs, 8)[0]) == 1 and sharded(docs.limit(0), 8)[0] == []


def test_stretches_count_on_within_a_shard(spark, monkeypatch):
    monkeypatch.setattr(sharding, "STRETCH_BYTES", 500)
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    _, sizes = sharded(docs, 3)
    assert max(sizes.values()) - min(sizes.values()) <= 0.02 * sum(sizes.values()) / 3 + 130


def brute(rows, cosine=0.93):
    sound = {}
    for n, (i, v, label) in enumerate(rows):
        ok = label is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)
        if ok:
            x = np.array(v, np.float64) / max(map(abs, v))
            sound[n] = (label, len(v), x / np.linalg.norm(x))
    near = {n: set() for n in range(len(rows))}
    for a in sound:
        for b in sound:
            if a < b and sound[a][:2] == sound[b][:2] and sound[a][2] @ sound[b][2] >= cosine:
                near[a].add(b)
                near[b].add(a)
    out, seen = {}, set()
    for n in near:
        if n in seen:
            continue
        todo, group = [n], {n}
        while todo:
            for m in near[todo.pop()] - group:
                group.add(m)
                todo.append(m)
        seen |= group
        least = min(rows[m][0] for m in group)
        out |= {m: (rows[m][0], len(near[m]), least, rows[m][0] == least) for m in group}
    return sorted(out.values())


@pytest.mark.parametrize("small", [False, True])
def test_embeddings_equal_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(product_quantisation, "BLOCK", 16)
        monkeypatch.setattr(product_quantisation, "PER_LIST", 60)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16))
    rows = []
    for c in range(40):
        for j in range(rng.integers(1, 25)):
            v = centres[c] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.4])
            rows.append((len(rows), v.astype(np.float32).tolist(), int(c % 3)))
    rows += [(1000 + i, rows[0][1], 0) for i in range(60)]  # copies
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, rows[0][1], None)]
    rows += [(2004, [1.0, 2.0], 1), (2005, [2.0, 4.0], 1), (2006, [], 1), (2007, [1.0, None], 1), (2008, [3e38, 1e-38], 1)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, label int, node int")
    got = [tuple(r) for r in product_quantisation.near_groups(df).select("id", "n_links", "component", "kept").collect()]
    want = brute(rows)
    links = sum(w[1] for w in want)
    assert links > 1000 and sum(g[1] for g in got) >= 0.99 * links
    if not small:
        assert sorted(got) == want


def test_no_embeddings(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert product_quantisation.near_groups(df).count() == 0


def test_pairs_across_lists_are_found_when_the_sample_holds_none(spark, monkeypatch):
    monkeypatch.setattr(product_quantisation, "SAMPLE", 200)
    monkeypatch.setattr(product_quantisation, "PER_LIST", 60)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(1500, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    away *= np.sqrt(1 / 0.935**2 - 1) / np.linalg.norm(away, axis=1, keepdims=True)
    both = np.concatenate([x, x + away])
    unit = both / np.linalg.norm(both, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.93
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(both.tolist())], "vec_id long, embedding array<double>, label int")
    got = {r["id"]: r["n_links"] for r in product_quantisation.near_groups(df).collect()}
    assert got == dict(enumerate((near.sum(axis=1) - 1).tolist()))


def test_distances_to_coded_vectors_are_the_sums_of_the_parts():
    rng = np.random.default_rng(4)
    x = product_quantisation._unit(rng.normal(size=(400, 18)))
    index = product_quantisation.fit(x, 4096)
    own = index.lists(x, 1)[:, 0]
    of = int(np.bincount(own).argmax())
    codes, error = index.code(x[own == of], own[own == of])
    coded = index.decoded(codes, of)
    assert np.abs(np.sqrt(((x[own == of] - coded) ** 2).sum(axis=1)) - error).max() < 1e-12
    far = product_quantisation.distances(x, coded)
    for q, row in zip(x[:20], far):
        rest = q - index.centres[of]
        for code, got in zip(codes, row):
            parts = [((rest[a:b] - book[c]) ** 2).sum() for a, b, book, c in zip(index.cuts, index.cuts[1:], index.books, code)]
            assert abs(sum(parts) - got) < 1e-12


def test_vectors_are_written_once_whatever_lists_they_visit(spark, monkeypatch, tmp_path):
    """Spread vectors visit nearly all lists; each was exchanged once for every one of them."""
    for name, value in {"PER_LIST": 20, "BLOCK": 64, "PAIRS": 50}.items():
        monkeypatch.setattr(product_quantisation, name, value)
    monkeypatch.setattr(product_quantisation, "shared_folder", lambda *_: str(tmp_path / "blocks"))
    x = np.random.default_rng(3).normal(size=(600, 8)).astype(np.float32)
    x[::7, 0] += 1e-9  # still exact in four bytes
    df = spark.createDataFrame([(i, v, i % 3) for i, v in enumerate(x.tolist())], "id long, vector array<double>, label int")
    nodes = product_quantisation.nodes_of(df).localCheckpoint()
    found = product_quantisation.links(nodes, 0.6)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    least = {r["node"]: r["least"] for r in nodes.collect()}
    got = [tuple(sorted((least[r["a"]], least[r["b"]]))) for r in found.collect()]
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.6
    want = {(i, j) for i in range(600) for j in range(i + 3, 600, 3) if near[i, j]}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 1000
    each, blocks = 24 + 2 + 8 * 4, 3 * (200 // 64 + 1) + 12
    written = sum(f.stat().st_size for f in (tmp_path / "blocks").iterdir() if not f.name.endswith(".crc"))
    assert 600 * each < written <= 600 * each + blocks * product_quantisation.PLACE.itemsize
