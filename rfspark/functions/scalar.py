"""Column functions: frequencies, rates, clocks, levels, codes and flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rfspark.functions import tables as t

INF = float("inf")


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < INF)


def positive(x: Column) -> Column:
    return finite(x) & (x > 0)


def parse_frequency(text: Column) -> Column:
    """Hertz from text such as ``146.52M`` or ``2.4 GHz``; null if it is no positive frequency."""
    bare = F.trim(F.regexp_replace(F.trim(text), r"(?i)\s*hz$", ""))
    unit = F.lower(F.regexp_extract(bare, r"([kKmMgG])$", 1))
    number = F.rtrim(F.regexp_replace(bare, r"[kKmMgG]$", ""))
    plain = number.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    scale = F.when(unit == "k", 1e3).when(unit == "m", 1e6).when(unit == "g", 1e9).otherwise(1.0)
    hz = F.when(plain, number.try_cast("double")) * scale
    return F.when(positive(hz), hz)


parse_sample_rate = parse_frequency


def _decimals(x: Column, places: int) -> Column:
    """Decimal text of the exact binary value, ties to even.

    ``format_string`` rounds the shortest decimal form instead, which turns
    12.315 (a little less in binary) into 12.32. The part of ``x * 10^places``
    that the product loses is worked out by splitting ``x``.
    """
    scale = float(10**places)
    a = F.abs(x)
    wide = a * 134217729.0
    high = wide - (wide - a)
    product = a * scale
    lost = (high * scale - product) + (a - high) * scale
    whole = F.floor(product)
    rest = product - whole
    odd = whole % 2 == 1
    up = (rest > 0.5) | ((rest == 0.5) & ((lost > 0) | ((lost == 0) & odd)))
    digits = (whole + up.cast("long")).cast("long")
    step = 10**places
    text = F.concat(
        ((digits - digits % step) / step).cast("long").cast("string"),
        F.lit("."),
        F.lpad((digits % step).cast("string"), places, "0"),
    )
    return F.concat(F.when(x < 0, "-").otherwise(""), text)


def _passthrough(x: Column, unit: str) -> Column:
    name = F.when(F.isnan(x), "NaN").when(x > 0, "inf").otherwise("-inf")
    return F.concat(name, F.lit(f" {unit}"))


def format_frequency(hz: Column) -> Column:
    size = F.abs(hz)
    return (
        F.when(~finite(hz), _passthrough(hz, "Hz"))
        .when(size >= 999_995_000.0, F.concat(_decimals(hz / 1e9, 2), F.lit(" GHz")))
        .when(size >= 999_995.0, F.concat(_decimals(hz / 1e6, 2), F.lit(" MHz")))
        .when(size >= 999.995, F.concat(_decimals(hz / 1e3, 2), F.lit(" kHz")))
        .otherwise(F.concat(_decimals(hz, 1), F.lit(" Hz")))
    )


def format_sample_rate(hz: Column) -> Column:
    size = F.abs(hz)
    return (
        F.when(~finite(hz), _passthrough(hz, "sps"))
        .when(size >= 999_950.0, F.concat(_decimals(hz / 1e6, 1), F.lit(" Msps")))
        .when(size >= 999.95, F.concat(_decimals(hz / 1e3, 1), F.lit(" ksps")))
        .otherwise(F.concat(_decimals(hz, 1), F.lit(" sps")))
    )


def linear_to_db(x: Column) -> Column:
    return F.when(x <= 0, F.lit(-INF)).otherwise(F.log10(x) * 10)


def db_to_linear(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 10)


def file_epoch_seconds(x: Column) -> Column:
    """File clocks come in seconds or, above 1e13, in microseconds."""
    return F.when(finite(x) & (x >= 1e13), x / 1e6).otherwise(x)


def epoch_seconds_to_nanos(s: Column) -> Column:
    """Whole seconds and fraction apart, so no digits are lost; null when out of range."""
    whole = F.floor(s)
    fraction = F.floor((s - whole) * 1e9 + 0.5).cast("long")
    return F.when(
        finite(s) & (s >= 0) & (s < 9.3e9),
        F.try_add(F.try_multiply(whole.cast("long"), F.lit(1_000_000_000).cast("long")), fraction),
    )


def epoch_nanos_to_seconds(ns: Column) -> Column:
    second = F.lit(1_000_000_000).cast("long")
    rest = F.pmod(ns, second)
    return ((ns - rest) / second).cast("double") + rest.cast("double") * F.lit(1e-9)


def iq_bytes_per_sample(fmt: Column) -> Column:
    name = F.lower(fmt)
    out = F.lit(None).cast("int")
    for key, width in t.IQ_BYTES.items():
        out = F.when(name == key, F.lit(width)).otherwise(out)
    return out


def usable_bandwidth_hz(rate: Column) -> Column:
    return rate * t.USABLE_BANDWIDTH_RATIO


def receiver_clock_for_label(label: Column) -> Column:
    """Clock rate behind a label; an unknown label is read as a number of MHz."""
    name = F.trim(label)
    known = F.element_at(_literal_map(t.RECEIVER_CLOCKS_HZ), name)
    number = F.trim(F.regexp_replace(name, "MHz$", ""))
    mhz = F.when(number.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), number.try_cast("double"))
    hz = mhz * 1e6
    return F.coalesce(known, F.when(positive(mhz) & positive(hz), hz), F.lit(t.DEFAULT_RECEIVER_CLOCK_HZ))


def validate_iq_mode(rate: Column, clock: Column) -> Column:
    """Error text for a rate the receiver clock cannot carry, else null."""
    top = clock / t.IQ_RATE_CLOCK_RATIO
    return (
        F.when(~positive(rate), "sample rate must be a finite positive number")
        .when(~positive(clock), "receiver clock must be a finite positive number")
        .when(
            rate > top,
            F.format_string("sample rate %.3f MHz exceeds clock / 1.5 = %.3f MHz", rate / 1e6, top / 1e6),
        )
    )


def sample_type_name(code: Column) -> Column:
    return _decode(code, t.SAMPLE_TYPES)


def unit_name(code: Column) -> Column:
    return _decode(code, t.SAMPLE_UNITS)


def payload_name(code: Column) -> Column:
    return _decode(code, t.FILE_PAYLOADS)


def device_state_name(state: Column) -> Column:
    name = F.lower(state)
    return F.when(name.isin(*t.DEVICE_STATES), name).otherwise("unknown")


def has_flag(flags: Column, name: str) -> Column:
    return flags.bitwiseAND(F.lit(t.PACKET_FLAGS[name]).cast("long")) != 0


def flags_to_array(flags: Column) -> Column:
    names = [F.when(has_flag(flags, n), F.lit(n)) for n in t.PACKET_FLAGS]
    return F.array_compact(F.array(*names))


def value_range(low: Column, high: Column, step: Column) -> Column:
    """A usable range, or null; a step that is not positive is dropped."""
    return F.when(
        finite(low) & finite(high) & (low <= high),
        F.struct(low.alias("min"), high.alias("max"), F.when(positive(step), step).alias("step")),
    )


def value_range_contains(low: Column, high: Column, v: Column) -> Column:
    usable = finite(low) & finite(high) & (low <= high)
    return F.when(usable, finite(v) & (v >= low) & (v <= high))


def span_in_bounds(span: Column, low: Column, high: Column) -> Column:
    return positive(span) & positive(high) & finite(low) & (low >= 0) & (low <= span) & (span <= high)


def value_width(code: Column) -> Column:
    """Bytes of one value of a file sample type; unknown types have none."""
    widths = F.array(*[F.lit(w) for w in t.SAMPLE_WIDTHS])
    known = (code >= 0) & (code < len(t.SAMPLE_WIDTHS))
    return F.when(known, F.get(widths, code.cast("int"))).otherwise(0)


def sample_stride_bytes(sample_size: Column, code: Column) -> Column:
    return sample_size.cast("long") * value_width(code)


def decimation_index(factor: Column) -> Column:
    """Exponent of a positive power of two, else null."""
    n = factor.cast("long")
    power = (n > 0) & (n.bitwiseAND(n - 1) == 0)
    return F.when(power, F.length(F.bin(n)) - 1)


def _literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def _decode(code: Column, names) -> Column:
    known = (code >= 0) & (code < len(names))
    return F.when(known, F.get(F.array(*[F.lit(n) for n in names]), code.cast("int"))).otherwise("Unknown")
