"""Ordered scans and keyed joins that hold when one key has a third of the rows.

A plain ``Window.partitionBy(stream)`` puts a whole stream into one task. Here a
stream is cut into blocks of its order column. Each block is scanned by its own
task, and what flows from one block into the next (a sum, a maximum, the last
row) is worked out on one summary row per block and joined back. Summaries are
built with map-side partial aggregation, and the join uses the same
``(keys, block)`` partitioning as the in-block window, so the rows themselves
are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

DEFAULT_BLOCK = 1 << 20
BLOCK = "__block"


def total(x: Column):
    """Running sum up to and with this row."""
    return ("total", x, None)


def total_before(x: Column):
    """Running sum of the rows ahead of this one."""
    return ("total_before", x, None)


def peak(x: Column):
    """Running maximum up to and with this row."""
    return ("peak", x, None)


def latest(x, present: Column | None = None):
    """Last value up to and with this row, of the rows that have one.

    ``x`` is a column, or a dict of columns that comes back as a struct;
    ``present`` says which rows have one (for a column, where it is not null).
    """
    return ("latest", x, x.isNotNull() if present is None else present)


def latest_before(x, present: Column | None = None):
    """Last value ahead of this row, of the rows that have one."""
    return ("latest_before", x, x.isNotNull() if present is None else present)


def previous(x):
    """The value, or dict of values, on the row just ahead, null included."""
    return ("previous", x, None)


def block_start(order: Column, block) -> Column:
    """The block a position falls in, named by its first position."""
    return order - F.pmod(order, F.lit(block))


def ordered_scan(df: DataFrame, keys, order, scans: dict, block=DEFAULT_BLOCK) -> DataFrame:
    """Add one column per entry of ``scans``, scanned along ``order`` within ``keys``.

    ``order`` is one column name or several; blocks are cut on the first.
    ``block=None`` keeps each key in a single window partition, for callers who
    know that their keys are small. Keys and order must not be null. ``df`` is read
    twice, so a scan over the result of another is best given a written table.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    specs, inputs = {}, {}
    for name, (kind, x, present) in scans.items():
        fields = x if isinstance(x, dict) else {"v": x}
        specs[name] = (kind, list(fields), isinstance(x, dict))
        inputs |= {f"__x_{name}_{f}": c for f, c in fields.items()}
        if present is not None:
            inputs[f"__has_{name}"] = present
    source = df.withColumns(inputs)
    if block is None:
        return _within(source, keys, order, specs, carried=False).drop(*inputs)

    source = source.withColumn(BLOCK, block_start(F.col(order[0]), block))
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    summary = source.groupBy(*keys, BLOCK).agg(*[c for n, s in specs.items() for c in _summary(n, s, at)])
    earlier = Window.partitionBy(*keys).orderBy(BLOCK)
    carry = summary.select(*keys, BLOCK, *[_carry(n, s, earlier).alias(f"__c_{n}") for n, s in specs.items()])
    joined = source.join(carry, [*keys, BLOCK])
    rows = _within(joined, [*keys, BLOCK], order, specs, carried=True)
    return rows.drop(*inputs, *[f"__c_{n}" for n in specs], BLOCK)


def _summary(name, spec, at) -> list:
    """Aggregates of one block. Fields are kept apart, so that numbers stay in a hash aggregate."""
    kind, fields, _ = spec
    if kind in ("total", "total_before"):
        return [F.sum(f"__x_{name}_v").alias(f"__s_{name}")]
    if kind == "peak":
        return [F.max(f"__x_{name}_v").alias(f"__s_{name}")]
    if kind == "previous":
        return [F.max_by(f"__x_{name}_{f}", at).alias(f"__s_{name}_{f}") for f in fields]
    has = F.col(f"__has_{name}")
    last = [F.max_by(f"__x_{name}_{f}", F.when(has, at)).alias(f"__s_{name}_{f}") for f in fields]
    return [*last, F.bool_or(has).alias(f"__s_{name}")]


def _carry(name, spec, earlier) -> Column:
    kind, fields, _ = spec
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    if kind in ("total", "total_before"):
        return F.sum(f"__s_{name}").over(before)
    if kind == "peak":
        return F.max(f"__s_{name}").over(before)
    value = F.struct(*[F.col(f"__s_{name}_{f}").alias(f) for f in fields])
    if kind == "previous":
        return F.lag(value).over(earlier)
    return F.last(F.when(F.col(f"__s_{name}"), value), ignorenulls=True).over(before)


def _within(df, keys, order, specs, carried) -> DataFrame:
    here = Window.partitionBy(*keys).orderBy(*order)
    upto = here.rowsBetween(Window.unboundedPreceding, 0)
    ahead = here.rowsBetween(Window.unboundedPreceding, -1)
    out = {}
    for name, (kind, fields, many) in specs.items():
        c = F.col(f"__c_{name}") if carried else None
        frame = upto if kind in ("total", "latest", "peak") else ahead
        if kind in ("total", "total_before"):
            inside = F.coalesce(F.sum(f"__x_{name}_v").over(frame), F.lit(0))
            out[name] = inside + F.coalesce(c, F.lit(0)) if carried else inside
        elif kind == "peak":
            inside = F.max(f"__x_{name}_v").over(frame)
            out[name] = F.greatest(inside, c) if carried else inside
        else:
            value = F.struct(*[F.col(f"__x_{name}_{f}").alias(f) for f in fields])
            if kind == "previous":
                inside = F.lag(value).over(here)
            else:
                inside = F.last(F.when(F.col(f"__has_{name}"), value), ignorenulls=True).over(frame)
            found = F.coalesce(inside, c) if carried else inside
            out[name] = found if many else found["v"]
    return df.withColumns(out)


def salted_join(big: DataFrame, per_key: DataFrame, keys, how: str = "inner", salts: int = 16) -> DataFrame:
    """Join rows to a one-row-per-key table without piling a hot key on one task.

    The per-key side is repeated ``salts`` times, the other side is spread over
    the copies.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    spread = big.withColumn("__salt", salt_of(big, salts))
    return spread.join(salted_copies(per_key, salts), [*keys, "__salt"], how).drop("__salt")


def salt_of(df: DataFrame, salts: int) -> Column:
    """A number below ``salts`` from a row's short columns; sample arrays are not read for it."""
    short = [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.StringType, T.TimestampType))]
    return F.pmod(F.xxhash64(*short), F.lit(salts)).cast("int")


def salted_copies(df: DataFrame, salts: int) -> DataFrame:
    return df.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def once(df: DataFrame, name: str, x: Column) -> DataFrame:
    """Add a column whose expression is worked out once per row.

    The optimiser copies a plain column's expression into every later use of it,
    filters included; it leaves the output of a generator alone.
    """
    return df.select("*", F.explode(F.array(x)).alias(name))
