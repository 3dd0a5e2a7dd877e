import pytest
from pyspark.sql import functions as F

from rfspark.functions import scalar as s
from rfspark.operators import geometry as g, linkbudget as lb


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, hz",
    [("146.52M", 146.52e6), ("2.4G", 2.4e9), ("162.5k", 162500.0), ("100000", 1e5), (" 2.4 GHz ", 2.4e9), ("100Hz", 100.0),
     ("-5M", None), ("0", None), ("abc", None), ("", None), ("1e400", None), ("nan", None)],
)
def test_parse_frequency(spark, text, hz):
    got = one(spark, s.parse_frequency(F.lit(text)))
    assert got == (pytest.approx(hz) if hz else None)


@pytest.mark.parametrize("hz, text", [(146520000.0, "146.52 MHz"), (2.4e9, "2.40 GHz"), (162500.0, "162.50 kHz"), (999.994, "1000.0 Hz"), (float("inf"), "inf Hz")])
def test_format_frequency(spark, hz, text):
    assert one(spark, s.format_frequency(F.lit(hz))) == text


def test_decimals_follow_the_binary_value(spark):
    values = [12315.0, 2.675, 0.125, 1.005, 999.95, 0.045, -12.345, 655.25]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(s._decimals(F.col("v"), 2).alias("two"), s._decimals(F.col("v"), 1).alias("one"))
    assert [(r.two, r.one) for r in df.collect()] == [(f"{v:.2f}", f"{v:.1f}") for v in values]


def test_epoch_nanos(spark):
    assert one(spark, s.epoch_seconds_to_nanos(F.lit(1.5))) == 1_500_000_000
    assert one(spark, s.epoch_seconds_to_nanos(F.lit(-1.0))) is None
    assert one(spark, s.epoch_seconds_to_nanos(F.lit(1e300))) is None
    assert one(spark, s.epoch_seconds_to_nanos(F.lit(9_223_372_036.9))) is None
    assert one(spark, s.epoch_nanos_to_seconds(F.lit(-1_500_000_000))) == -1.5


def test_clock_labels(spark):
    for label, hz in (("92MHz", 92.16e6), ("77MHz", 76.8e6), ("300MHz", 300e6), ("junk", 92.16e6), ("-5MHz", 92.16e6)):
        assert one(spark, s.receiver_clock_for_label(F.lit(label))) == hz


def test_ladder(spark):
    rates = [r.rate_hz for r in g.rate_ladder(spark, 61.44e6).orderBy("rung").collect()]
    assert len(rates) == 10 and (rates[0], rates[2], rates[9]) == (61.44e6, 15.36e6, 120e3)
    assert one(spark, g.clock_top(F.lit(245.76e6))) == pytest.approx(163.84e6)
    assert one(spark, F.size(g.ladder(F.lit(1e6), 1000))) == 64
    assert one(spark, F.size(g.ladder(F.lit(0.0), 10))) == 0 and one(spark, F.size(g.ladder(F.lit(1e6), 0))) == 0


def test_rungs(spark):
    for want, rate in ((10e6, 7.68e6), (1e9, 61.44e6), (1.0, 120e3), (-1.0, 120e3), (float("nan"), 120e3)):
        assert one(spark, g.nearest_rate(F.lit(want))) == rate
    assert one(spark, g.rate_for_bandwidth(F.lit(8e6))) == 15.36e6
    assert one(spark, g.rate_for_bandwidth(F.lit(1e9))) == 61.44e6
    assert one(spark, g.decimation_index_for_rate(F.lit(2e6))) == 5


def test_snap(spark):
    top = 61.44e6
    for measured, want in ((61391500.5, top), (61439323.0, top), (top * 0.98, None), (top * 0.995, top)):
        got = one(spark, g.snap_to_top(F.lit(measured)))
        assert got == (pytest.approx(want) if want else None)


def test_required_rate(spark):
    for rate, fmt, need in ((15.36e6, "int16", 61.44e6), (15.36e6, "float32", 122.88e6), (15.36e6, "json", None), (0.0, "int16", None), (float("nan"), "int16", None)):
        assert one(spark, lb.required_rate(F.lit(rate), F.lit(fmt))) == need


def test_sustainable(spark):
    fit = lambda m, top=None: one(spark, lb.sustainable_rate(F.lit(m), F.lit("int16"), top))
    assert (fit(75e6), fit(57e6), fit(479_999.0), fit(480_000.0)) == (15.36e6, 7.68e6, None, 120e3)
    assert fit(500e6, F.lit(163.84e6)) == 81.92e6


def arrivals(spark, rows):
    schema = "connection_id int, seq long, opened double, at double, bytes long, channel_full boolean"
    return spark.createDataFrame([(1, k, 0.0, at, n, full) for k, (at, n, full) in enumerate(rows)], schema)


def test_throughput_leaves_out_the_backlog(spark):
    rows = [(0.1, 20_000_000, False), (0.2, 20_000_000, False), (0.3, 20_000_000, False)]
    rows += [(0.6 + 0.01 * k, 100_000, False) for k in range(150)]
    m = lb.throughput(arrivals(spark, rows), 0.5, 1.0).first()
    assert m.byte_rate == pytest.approx(10e6, rel=0.02)
    assert m.settle == pytest.approx(0.6) and m.settle_bytes >= 60_000_000 and m.closed


def test_throughput_needs_a_closed_window(spark):
    assert lb.throughput(arrivals(spark, [(0.6, 10, False), (0.9, 10, False)]), 0.5, 1.0).first().byte_rate is None
    short = [(0.6, 10, False), (0.7, 10, False), (5.0, 10, False)]
    assert lb.throughput(arrivals(spark, short), 0.5, 1.0).first().byte_rate is None
    full = [(0.6, 10, False), (1.5, 10, True), (5.0, 10, False)]
    measured = lb.throughput(arrivals(spark, full), 0.5, 1.0)
    assert measured.first().consumer_limited and lb.drop_consumer_limited(measured).count() == 0


def test_verdict(spark):
    df = spark.createDataFrame([(60e6, 15.36e6, "int16"), (60.3e6, 15.36e6, "int16")], "byte_rate double, rate_hz double, format string")
    a, b = lb.with_verdict(df).orderBy("byte_rate").collect()
    assert a.short and a.fit_rate_hz == 7.68e6 and a.fit_bandwidth_hz == pytest.approx(6.144e6)
    assert not b.short and b.fit_rate_hz is None
