"""Rolling aggregates and trend per station.

Frames are RANGE frames over whole seconds, closed at both ends: a reading
exactly ``seconds`` old belongs to the frame, and readings of the same second see
each other. Readings without a time form one frame of their own per station.

``method="range"`` is the plain window form. One task holds the whole history of
a station and re-adds the whole frame for every reading, which is fine for many
small stations.

``method="bucket"`` (default) gives the same values for any distribution:

1. Readings are aggregated to one cell per station and second, with partial
   aggregation before the shuffle. A station and day then has at most 86,400
   cells, however many readings it has.
2. Frames have two levels. Blocks are as long as the shortest frame, an hour for the
   features, and the others are multiples of it. A frame that ends in block ``b`` and is
   ``k`` blocks long is the start of ``b`` up to the current second, the whole blocks
   between, and the end of block ``b-k`` from the same offset on. Start and end are
   running aggregates inside (station, block), where each cell also visits the blocks
   ``k`` ahead; whole blocks come from a table of one row per station and block. So the
   work is linear in the cells, and sums are only merged, never subtracted. Frames that
   are no multiples get blocks of their own.
3. The previous reading of a trend is the one before it in its block, else the last of the
   station's block before, from the same table.
4. The cell values are joined back to the readings on (station, second). Rolling
   alone is a plain join, which adaptive execution can split if a second is hot.
   A trend also orders the readings inside each second, and clean readings, being
   distinct by station and timestamp, are few there. Readings without a time are
   the exception and are spread by a hash of their values.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from plumelake.functions.numbers import ratio, to_units
from plumelake.functions.times import DAY, block_number, epoch_second

STATION = "station_id"
TIME = "timestamp_parsed"

# Stands for "no time"; lies before every timestamp Spark can hold, so readings
# without a time sort first, as nulls do.
NO_TIME = -(10 ** 12)
# Readings without a time have no second to spread them, so a hash does.
NO_TIME_SLOTS = 256
SPREAD = "pm25"
# Whole blocks in a frame: they are added up for each row of the table of blocks.
MOST_BLOCKS = 1000

SECOND, SLOT = "_second", "_slot"
CELL = [STATION, SECOND, SLOT]


class RollingSpec(NamedTuple):
    out: str
    fn: str         # avg, sum, count, min or max
    col: str
    seconds: int


def _is_integral(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.IntegralType)


def _addend(df: DataFrame, col: str, scale: int | None) -> Column:
    """What is summed for a mean: whole numbers wherever the data allow it."""
    if _is_integral(df, col):
        return F.col(col).cast("bigint")
    return F.col(col).cast("double") if scale is None else to_units(col, scale)


def _check(specs: list[RollingSpec]) -> list[RollingSpec]:
    specs = [RollingSpec(*s) for s in specs]
    for s in specs:
        if s.fn not in ("avg", "sum", "count", "min", "max"):
            raise ValueError(f"unknown rolling function {s.fn!r}")
        if s.seconds <= 0:
            raise ValueError("a frame needs a positive number of seconds")
    return specs


# --- plain window form ------------------------------------------------------

def _rolling_range(df: DataFrame, specs: list[RollingSpec], scale: int | None) -> DataFrame:
    by_second = Window.partitionBy(STATION).orderBy(epoch_second(TIME))
    out = {}
    for s in specs:
        frame = by_second.rangeBetween(-s.seconds, Window.currentRow)
        if s.fn in ("min", "max", "count"):
            out[s.out] = getattr(F, s.fn)(s.col).over(frame)
            continue
        units = None if _is_integral(df, s.col) else scale
        total = F.sum(_addend(df, s.col, scale)).over(frame)
        n = F.count(s.col).over(frame) if s.fn == "avg" else F.lit(1)
        plain_sum = s.fn == "sum" and units is None
        out[s.out] = total if plain_sum else ratio(total, n, units)
    return df.withColumns(out)


def _trend_range(df: DataFrame, col: str, out: str) -> DataFrame:
    order = _history_order(df, col)
    history = Window.partitionBy(STATION).orderBy(TIME, _slot(df, col), *order[1:])
    return df.withColumn(out, F.col(col) - F.lag(col).over(history))


def _history_order(df: DataFrame, col: str) -> list[str]:
    """Time first; then every other sortable column, so that readings of the same
    moment (in clean data: only those without a time) have a fixed order."""
    rest = [f.name for f in df.schema.fields
            if f.name not in (STATION, TIME, col, SECOND, SLOT)
            and isinstance(f.dataType, (T.NumericType, T.StringType, T.DateType,
                                        T.TimestampType, T.TimestampNTZType, T.BooleanType))]
    return [TIME, col, *sorted(rest)]


def _slot(df: DataFrame, col: str | None) -> Column:
    """0 for readings with a time; for the others a hash of a few values, which
    spreads them. Few, so that the aggregation scans stay narrow."""
    spread = [c for c in {col: 0, SPREAD: 0} if c in df.columns]
    hashed = F.pmod(F.xxhash64(*spread), F.lit(NO_TIME_SLOTS)) if spread else F.lit(0)
    return F.when(F.col(TIME).isNull(), hashed).otherwise(F.lit(0)).cast("int")


# --- bucket form ------------------------------------------------------------

_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def _partials(df: DataFrame, specs: list[RollingSpec], scale: int | None) -> dict[str, tuple]:
    """Partial results to keep per cell: name -> (merge function, expression)."""
    kept = {}
    for s in specs:
        if s.fn in ("avg", "sum"):
            kept[f"_sum_{s.col}"] = ("sum", F.sum(_addend(df, s.col, scale)))
        if s.fn in ("avg", "count"):
            kept[f"_count_{s.col}"] = ("count", F.count(s.col))
        if s.fn in ("min", "max"):
            kept[f"_{s.fn}_{s.col}"] = (s.fn, getattr(F, s.fn)(s.col))
    return kept


def _parts_of(spec: RollingSpec) -> list[str]:
    kinds = {"avg": ["sum", "count"]}.get(spec.fn, [spec.fn])
    return [f"_{kind}_{spec.col}" for kind in kinds]


def _add_cell(df: DataFrame, col: str | None) -> DataFrame:
    return df.withColumns({
        SECOND: F.coalesce(epoch_second(TIME), F.lit(NO_TIME)),
        SLOT: _slot(df, col),
    })


RUNNING = (Window.unboundedPreceding, Window.currentRow)


def _chains(widths: list[int]) -> list[list[int]]:
    """Frame widths that share their blocks: each chain holds multiples of its first."""
    chains: list[list[int]] = []
    for width in sorted(widths):
        for chain in chains:
            if width % chain[0] == 0 and width // chain[0] <= MOST_BLOCKS:
                chain.append(width)
                break
        else:
            chains.append([width])
    return chains


def _merged(kind: str, parts: list[Column]) -> Column:
    """One value from those of the parts of a frame; null if all are."""
    if len(parts) == 1:
        return parts[0]
    if kind in ("min", "max"):
        return (F.least if kind == "min" else F.greatest)(*parts)
    total = sum((F.coalesce(p, F.lit(0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0)))
    return F.when(F.coalesce(*parts).isNotNull(), total)


def _value(spec: RollingSpec, units: int | None, parts: list[Column]) -> Column:
    """The result of one spec from the merged partial results of its frame."""
    if spec.fn == "avg":
        return ratio(*parts, units)
    if spec.fn == "sum" and units is not None:
        return ratio(parts[0], F.lit(1), units)
    return parts[0]


def _blocks(cells: DataFrame, partials: dict[str, tuple], needs: dict[int, list[str]], base: int,
            widths: list[int], with_trend: bool) -> DataFrame:
    """One row per station and block with what the blocks between the two ends of a frame
    add up to, and the last value before the block."""
    kept = sorted({n for w in widths if w > base for n in needs[w]})
    states = [_MERGE[partials[n][0]](n).alias(n) for n in kept]
    if with_trend:
        states.append(F.max_by("_last", F.col(SECOND) * NO_TIME_SLOTS + F.col(SLOT)).alias("_end"))
    blocks = cells.groupBy(STATION, block_number(F.col(SECOND), base).alias("_block")).agg(*states)
    by_block = Window.partitionBy(STATION).orderBy("_block")
    found = []
    for w in widths:
        inner = by_block.rangeBetween(1 - w // base, -1)
        found += [_MERGE[partials[n][0]](n).over(inner).alias(f"{n}_{w}_inner") for n in needs[w] if w > base]
    if with_trend:
        found.append(F.lag(F.struct(F.col("_end").alias("v"))).over(by_block).alias("_carry"))
    return blocks.select(STATION, "_block", *found)


def _roll_chain(cells: DataFrame, partials: dict[str, tuple], specs: list[tuple[RollingSpec, int | None]],
                needs: dict[int, list[str]], widths: list[int], with_trend: bool) -> DataFrame:
    """Results of some frames, whose widths are multiples of the first, for every cell;
    with a trend also ``_before``, the value ahead of the cell, as a struct."""
    base = widths[0] if widths else DAY
    steps = [w // base for w in widths]
    block, offset = block_number(F.col(SECOND), base), F.pmod(F.col(SECOND), F.lit(base))
    visits = [F.struct((block + k).alias("_block"), F.lit(k).alias("_ahead")) for k in [0, *steps]]
    main = cells.select("*", F.inline(F.array(*visits)))
    group, own = [STATION, "_block"], F.col("_ahead") == 0
    added = {}
    if with_trend:
        # First, so that its order also serves the running values from the start.
        earlier = Window.partitionBy(*group).orderBy(SECOND, SLOT).rowsBetween(Window.unboundedPreceding, -1)
        added["_lagged"] = F.last(F.when(own, F.struct(F.col("_last").alias("v"))), True).over(earlier)

    def running(name: str, frame: WindowSpec, rows: Column) -> Column:
        return _MERGE[partials[name][0]](F.when(rows, F.col(name))).over(frame)
    in_block = Window.partitionBy(*group)
    upward = in_block.orderBy(SECOND).rangeBetween(*RUNNING)
    downward = in_block.orderBy(offset.desc()).rangeBetween(*RUNNING)
    added |= {f"{n}_head": running(n, upward, own) for n in sorted({n for w in widths for n in needs[w]})}
    added |= {f"{n}_{w}_tail": running(n, downward, F.col("_ahead") == k) for w, k in zip(widths, steps) for n in needs[w]}
    main = main.withColumns(added).where(own)
    inner = [w for w in widths if w > base]
    if inner or with_trend:
        main = main.join(_blocks(cells, partials, needs, base, widths, with_trend), group, "left")

    def merged(name: str, w: int) -> Column:
        between = [F.col(f"{name}_{w}_inner")] if w in inner else []
        return _merged(partials[name][0], [F.col(f"{name}_head"), *between, F.col(f"{name}_{w}_tail")])
    results = [_value(s, units, [merged(n, s.seconds) for n in _parts_of(s)]).alias(f"_out_{s.out}")
               for s, units in specs if s.seconds in widths]
    before = [F.coalesce("_lagged", "_carry").alias("_before")] if with_trend else []
    return main.select(*CELL, *results, *before)


def _last_key(df: DataFrame, col: str) -> Column:
    """Sort key inside one second: fraction, then value. For whole numbers it fits
    one bigint, which lets Spark aggregate by hashing."""
    if not isinstance(df.schema[col].dataType, (T.ByteType, T.ShortType, T.IntegerType)):
        return F.struct(TIME, col)
    fraction = F.coalesce(F.pmod(F.unix_micros(F.col(TIME).cast("timestamp")), F.lit(10 ** 6)), F.lit(0))
    value = F.coalesce(F.col(col).cast("bigint") + (2 ** 31 + 1), F.lit(0))
    return fraction * 2 ** 33 + value


def _bucketed(df: DataFrame, specs: list[RollingSpec], scale: int | None,
              trend_col: str | None = None, trend_out: str = "tendencia_aqi") -> DataFrame:
    keyed = _add_cell(df, trend_col)
    partials = _partials(df, specs, scale)
    states = {name: expr for name, (_, expr) in partials.items()}
    if trend_col:
        states["_last"] = F.max_by(trend_col, _last_key(df, trend_col))
    cells = keyed.groupBy(*CELL).agg(*[e.alias(n) for n, e in states.items()])

    needs: dict[int, list[str]] = {}
    for spec in specs:
        known = needs.setdefault(spec.seconds, [])
        known += [p for p in _parts_of(spec) if p not in known]
    typed = [(s, None if _is_integral(df, s.col) else scale) for s in specs]
    first, *others = _chains(list(needs)) or [[]]
    results = _roll_chain(cells, partials, typed, needs, first, bool(trend_col))
    for chain in others:
        results = results.join(_roll_chain(cells, partials, typed, needs, chain, False), CELL)

    if trend_col:
        # Order inside one second; in clean data nearly every cell has one reading.
        in_cell = Window.partitionBy(*CELL).orderBy(*_history_order(df, trend_col))
        keyed = keyed.withColumn(
            "_within", F.lag(F.struct(F.col(trend_col).alias("v"))).over(in_cell))
    added = {s.out: F.col(f"_out_{s.out}") for s in specs}
    if trend_col:
        added[trend_out] = F.col(trend_col) - F.coalesce("_within", "_before")["v"]
    return keyed.join(results, CELL, "left").select(
        *[c for c in df.columns if c not in added], *[e.alias(n) for n, e in added.items()])


# --- public -----------------------------------------------------------------

def rolling(df: DataFrame, specs: list[RollingSpec | tuple], method: str = "bucket",
            scale: int | None = None) -> DataFrame:
    """Add one column per ``(out, fn, col, seconds)``.

    ``scale`` makes sums of decimal readings run over whole units of
    ``10**-scale``, which is exact and independent of the order of addition.
    Rows need a station; clean readings always have one.
    """
    specs = _check(specs)
    if method == "range":
        return _rolling_range(df, specs, scale)
    if method == "bucket":
        return _bucketed(df, specs, scale)
    raise ValueError(f"unknown method {method!r}")


def trend(df: DataFrame, col: str = "aqi", out: str = "tendencia_aqi",
          method: str = "bucket") -> DataFrame:
    """Add ``col`` minus its value in the station's previous reading; null for the
    first reading and when either value is null."""
    if method == "range":
        return _trend_range(df, col, out)
    if method == "bucket":
        return _bucketed(df, [], None, col, out)
    raise ValueError(f"unknown method {method!r}")


def rolling_with_trend(df: DataFrame, specs: list[RollingSpec | tuple], col: str = "aqi",
                       out: str = "tendencia_aqi", method: str = "bucket",
                       scale: int | None = None) -> DataFrame:
    """``rolling`` and ``trend`` in one pass over the readings."""
    if method == "bucket":
        return _bucketed(df, _check(specs), scale, col, out)
    return trend(rolling(df, specs, method, scale), col, out, method)
