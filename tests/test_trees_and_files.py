import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from rfspark.operators import catalogue as ca, health as hl
from rfspark.plans import captures as cp
from rfspark.sources import chunks as ch, samples as sm


def group(name, *items):
    return {"type": "group", "name": name, "label": name, "items": list(items)}


def number(name, value, **more):
    return {"type": "float", "name": name, "label": "", "value": value, "default": 0, **more}


def text(name, value):
    return {"type": "string", "name": name, "label": "", "value": value, "default": ""}


def nodes(spark, tree):
    df = spark.createDataFrame([(1, 1, 0, json.dumps(tree))], "snapshot long, device_id long, at long, tree string")
    return hl.flatten_tree(df)


STATUS = group("status", text("devstate", "Running"), number("iqsamples", 61391500.5), number("errors", 0.0), number("dsboverflows", 0.7))
HEALTH = group("healthstatus", group("Block", group("info", text("name", "x")), group("health", number("fpgatemp", 48.5)), STATUS))
CONFIG = group(
    "remoteconfig",
    group("Web", group("info", text("title", "web"))),
    group(
        "Block",
        group("info", text("title", "receiver")),
        group(
            "main",
            number("centerfreq0", 1.2e9, min=1e7, max=3e9, step=500),
            {"type": "enum", "name": "decimation0", "label": "", "value": 2, "default": 0,
             "values": "all,half,quarter,eighth"},
            number("reflevel0", -15.0, min=-40, max=10, step=0.25),
            {"type": "enum", "name": "gpsmode", "label": "", "value": 3, "default": 0, "values": "Off, ,Pos,Time,", "disabled": 4},
        ),
    ),
)


def test_capabilities(spark):
    c = hl.capabilities(nodes(spark, CONFIG), nodes(spark, HEALTH)).first()
    assert c.center_frequency_hz.asDict() == {"min": 1e7, "max": 3e9, "step": 500.0}
    assert (c.reference_level_dbm["min"], c.reference_level_dbm["max"], c.reference_level_dbm.step) == (-40.0, 10.0, 0.25)
    assert c.decimation_steps == 4 and c.native_iq_rate_hz == pytest.approx(61391500.5)
    assert c.model == "receiver" and c.sample_rates[0] == 61.44e6
    assert (c.gps_modes, c.gps_mode) == (["Off", "Time"], "Time")


def test_loss_verdicts(spark):
    r = hl.loss_verdict(hl.block_health(nodes(spark, HEALTH))).first()
    assert r.losing_nothing is False and r.summary == "Block [Running] per second: lost=0; dsp=0.7"
    empty = hl.loss_verdict(hl.block_health(nodes(spark, group("h", group("B", group("status")))))).first()
    assert empty.losing_nothing is None and empty.summary == "B [?]"


def test_readings_come_from_the_first_group_of_a_name(spark):
    tree = group("h", group("B", group("status", number("errors", 1.0)), group("status", number("usboverflows", 9.0))))
    r = hl.block_health(nodes(spark, tree)).collect()
    assert len(r) == 1 and r[0].errors_per_second == 1.0 and r[0].usb_overflows_per_second is None


def test_deep_trees_come_whole(spark):
    tree = number("leaf", 1.5)
    for k in range(200):
        tree = group(f"g{k}", tree)
    rows = nodes(spark, tree)
    assert rows.count() == 201
    leaf = rows.filter("name = 'leaf'").first()
    assert leaf.depth == 200 and leaf.value_num == 1.5 and leaf.parent_name == "g0"


def test_what_cannot_be_read_as_a_tree(spark):
    texts = ["", "[1]", "{", '{"name":"x"}', None, '{"type":"group","items":[null,{"type":"bool","value":true}]}', "[" * 200_000]
    df = spark.createDataFrame([(i, 1, 0, t) for i, t in enumerate(texts)], "snapshot long, device_id long, at long, tree string")
    got = sorted((r.snapshot, r.depth, r.type or "", r.value_str or "") for r in hl.flatten_tree(df).collect())
    bad = [(k, 0, "error", "") for k in range(7) if k != 5]
    assert got == sorted([*bad, (5, 0, "group", ""), (5, 1, "", ""), (5, 1, "bool", "true")])


def test_odd_values_do_not_stop_a_tree(spark):
    leaf = lambda value, **more: '{"type":"float","name":"%s","value":%s,"disabled":%s}' % (more.get("name", "x"), value, more.get("disabled", 0))
    leaves = [leaf("NaN"), leaf("Infinity"), leaf("1.5", name="\\ud800"), leaf("2", disabled="99999999999999999999"), leaf("2", disabled='"x"'), leaf('"7"')]
    leaves += [leaf("1e2"), leaf("-0.25", disabled=-1), leaf("true"), '{"type":"string","name":"s","value":[1,"a\u00e9",null],"name":"s"}']
    trees = [(k, 1, 0, '{"type":"group","name":"g","items":[%s]}' % x) for k, x in enumerate(leaves)]
    df = spark.createDataFrame(trees, "snapshot long, device_id long, at long, tree string")
    rows = hl.flatten_tree(df).filter("depth = 1").orderBy("snapshot").collect()
    assert [repr(r.value_num) for r in rows] == ["nan", "inf", "1.5", "2.0", "2.0", "7.0", "100.0", "-0.25", "None", "None"]
    assert [r.disabled for r in rows] == [0] * 7 + [-1, 0, 0] and rows[2].name == "?"
    assert rows[9].value_str == '[1,"a\u00e9",null]' and [r.path for r in rows[:2]] == ["g/x", "g/x"]


def test_masked_options_keep_their_numbers(spark):
    values = ",".join(f"o{k}" for k in range(70))
    got = spark.range(1).select(hl.enum_options(F.lit(values), F.lit(-(2**63)).cast("long")).alias("o")).first().o
    assert [o["index"] for o in got] == [k for k in range(70) if k != 63]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lake")
    rng = np.random.default_rng(3)
    vectors = rng.uniform(-0.9, 0.9, (40, 64)).astype(np.float32)
    for number_ in range(5):
        (folder / f"capture-{number_}.rf").write_bytes(cp.capture_bytes(number_, vectors[: 10 + number_].tolist()))
    (folder / "empty.rf").write_bytes(b"")
    (folder / "noise.rf").write_bytes(rng.integers(0, 256, 200_000, dtype=np.uint8).tobytes())
    (folder / "short.rf").write_bytes(cp.chunk("SAMP", b"\0" * 10) + cp.chunk("DSFH", struct.pack("<d", 5.0)))
    return str(folder), vectors


def test_catalogue_survives_noise_and_short_chunks(spark, lake):
    c = ch.scan_chunks(spark, lake[0], ".rf")
    bad = c.filter("error is not null").collect()
    assert [r.id for r in bad if r.file.endswith("short.rf")] == ["SAMP"]
    assert c.filter("id = 'DSFH' and file like '%short.rf'").count() == 1
    assert c.filter("file like '%capture-0.rf'").count() == 20


def test_samples_come_back(spark, lake):
    folder, vectors = lake
    c = ch.scan_chunks(spark, folder, ".rf").filter("file like '%capture-1.rf'")
    index = sm.iq_index(sm.with_first_sample(ch.view(c, "SAMP")), ch.view(c, "SSTR"))
    blocks = sm.load_iq(index.filter("sub_stream_id = 1"), block=10).orderBy("first_sample").collect()
    got = np.concatenate([np.stack([b.i, b.q], 1).ravel() for b in blocks])
    want = np.concatenate([vectors[k] for k in range(11) if k % 3 != 2])
    np.testing.assert_array_equal(got.astype(np.float32), want)
    again = sm.load_iq(index.filter("sub_stream_id = 1 and first_sample >= 32 and first_sample < 64"))
    assert again.count() == 1


def test_damaged_chunks_are_told_apart(spark):
    schema = (
        "file string, chunk_offset long, size long, header_size int, stream_id long, sub_stream_id long, sample_type int, "
        "payload_type int, compression int, sample_size long, num_samples long, first_sample long"
    )
    base = dict(file="f", chunk_offset=0, size=64 + 80, header_size=64, stream_id=1, sub_stream_id=9, sample_type=5, payload_type=2, compression=0, sample_size=2, num_samples=100, first_sample=0)
    rows = [base, {**base, "compression": 1}, {**base, "sample_size": 3}, {**base, "sample_type": 0}, {**base, "size": 66}]
    sstr = spark.createDataFrame([], "file string, sub_stream_id long, value_minimum double, value_maximum double, chunk_offset long")
    out = sm.iq_index(spark.createDataFrame([tuple(r[n.split()[0]] for n in schema.split(", ")) for r in rows], schema), sstr).collect()
    assert [r.error is None for r in out] == [True, False, False, False, False]
    assert out[0].fits == 10 and out[0].scale == pytest.approx(1 / 32768)


def test_metadata_and_report(spark, lake):
    c = ch.scan_chunks(spark, lake[0], ".rf").filter("file like '%capture-%'")
    meta = {r.file[-4:-3]: r for r in ca.with_completeness(ca.capture_metadata(c)).collect()}
    assert len(meta) == 5 and meta["0"].completeness == pytest.approx(100.0)
    assert meta["0"].sample_rate_hz == 1e6 and meta["0"].center_frequency_hz == 1e9 + 1 + 4e5
    assert meta["3"].stream_type == "RAW_IQ" and meta["3"].total_samples == 13 * 32
    assert meta["1"].creation_time_s == 1.7e9 + 1


def test_links_stop_at_cycles_and_holes(spark):
    edges = [("a", 10, 20), ("a", 20, 30), ("a", 30, 10), ("b", 10, 99), ("c", 5, 0)] + [("d", k, k - 1) for k in range(1, 60)]
    nodes_ = spark.createDataFrame(edges, "file string, chunk_offset long, next long")
    roots = spark.createDataFrame([("a", 10), ("b", 10), ("c", 5), ("d", 59), ("e", 1)], "file string, chunk_offset long")
    got = {(r.file, r.chunk_offset): r.step for r in ca.follow_links(nodes_, roots).collect()}
    want = {("a", 10): 0, ("a", 20): 1, ("a", 30): 2, ("b", 10): 0, ("c", 5): 0} | {("d", k): 59 - k for k in range(1, 60)}
    assert got == want


def test_sdk_options_say_what_is_open(spark):
    got = spark.range(1).select(hl.sdk_options(F.lit("a;; b;c"), F.lit(4).cast("long")).alias("o")).first().o
    assert [(o["index"], o.label, o.enabled) for o in got] == [(0, "a", True), (2, "b", False), (3, "c", True)]


def test_broken_files_are_in_the_report(spark, lake):
    chunks = ch.scan_chunks(spark, lake[0], ".rf")
    names = sorted(r.file for r in chunks.filter("id = 'DSFT'").select("file").distinct().collect())[:3]
    broken = chunks.filter(
        ~((F.col("file") == names[0]) & (F.col("id") == "DSFH")) & ~((F.col("file") == names[1]) & (F.col("id") == "STRM"))
    ).withColumn("error", F.when((F.col("file") == names[2]) & (F.col("id") == "DSFT"), "broken").otherwise(F.col("error")))
    meta = ca.capture_metadata(broken)
    assert meta.count() == chunks.select("file").distinct().count()
    found = ca.capture_findings(meta, *(ch.view(broken, k).withColumn("k", F.lit(0)) for k in ("SSTR", "ANTA", "SPRV")))
    texts = {(r.file, r.text) for r in found.filter("severity = 'error'").collect()}
    assert {(names[0], "no readable file header"), (names[1], "no readable stream header"), (names[2], "chunks that cannot be read")} <= texts
    report = {r.file: r.valid for r in ca.validate_captures(meta, found).collect()}
    assert not any(report[n] for n in names)
