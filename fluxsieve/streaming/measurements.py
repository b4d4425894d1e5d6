"""Operators on measurements (signalid, value, ticks, flags) and other time-stamped rows.

Times are ticks of 100 ns since year 1 in a LONG, or columns without zone. Everything here is a composition of built-in
operators: the same function serves batch and Structured Streaming, but for those that say batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ticks.
TICKS_PER_SECOND = 10_000_000
UNIX_TICKS = 621_355_968_000_000_000
LEAP_SECOND = 1 << 63
LEAP_DIRECTION = 1 << 62
VALUE_MASK = (1 << 62) - 1

#: State flags.
STATE_FLAGS = {
    "BadData": 0x1, "SuspectData": 0x2, "OverRange": 0x4, "UnderRange": 0x8, "AlarmHigh": 0x10, "AlarmLow": 0x20, "WarningHigh": 0x40, "WarningLow": 0x80,
    "FlatlineAlarm": 0x100, "ComparisonAlarm": 0x200, "ROCAlarm": 0x400, "ReceivedAsBad": 0x800, "CalculatedValue": 0x1000, "CalculationError": 0x2000,
    "CalculationWarning": 0x4000, "ReservedQuality": 0x8000, "BadTime": 0x10000, "SuspectTime": 0x20000, "LateTimeAlarm": 0x40000, "FutureTimeAlarm": 0x80000,
    "UpSampled": 0x100000, "DownSampled": 0x200000, "DiscardedValue": 0x400000, "ReservedTime": 0x800000, "UserDefined1": 0x1000000, "UserDefined2": 0x2000000,
    "BaseTimeOffset": 0x4000000, "TimeIndex": 0x8000000, "SimulatedData": 0x10000000, "SystemError": 0x20000000, "SystemWarning": 0x40000000, "MeasurementError": 0x80000000,
}
#: Compact flag, mask of the state flags that it stands for.
COMPACT_FLAGS = (("DataRange", 0x01, 0x000000FC), ("DataQuality", 0x02, 0x0000EF03), ("TimeQuality", 0x04, 0x00BF0000), ("SystemIssue", 0x08, 0xE0000000), ("CalculatedValue", 0x10, 0x00001000), ("AlarmValue", 0x20, 0x00400000))
BASE_TIME_OFFSET, TIME_INDEX = 0x40, 0x80


@dataclass(frozen=True)
class StreamOptions:
    """Subscription defaults."""

    lag: float = 10.0
    lead: float = 5.0
    throttled: bool = False
    publish_interval: float = 1.0
    nan_filter: bool = False
    use_local_clock: bool = False
    processing_interval: int = -1
    start: str | None = None
    stop: str | None = None


def ticks_to_time(ticks: Column) -> Column:
    """Time without zone, to the microsecond; flag bits are dropped."""
    return F.timestamp_micros(F.floor((ticks.bitwiseAND(F.lit(VALUE_MASK)) - UNIX_TICKS) / 10).cast("long")).cast("timestamp_ntz")


def time_to_ticks(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp")) * 10 + UNIX_TICKS


def second_of(time: Column) -> Column:
    """Start of the one-second window a time falls in."""
    return F.date_trunc("second", time).cast("timestamp_ntz")


def frame_index(time: Column, samples: int) -> Column:
    """Nearest of the samples in a second, half to even; the last may round to the next second's first: index = samples."""
    us = F.pmod(F.unix_micros(time.cast("timestamp")), F.lit(1_000_000))
    return F.bround(us * F.lit(float(samples)) / 1e6, 0).cast("int")


def aligned(time: Column, samples: int) -> Column:
    """The time moved to its frame, to the microsecond, cut."""
    base = F.unix_micros(second_of(time).cast("timestamp"))
    offset = F.floor(frame_index(time, samples) * F.lit(float(TICKS_PER_SECOND)) / samples / 10).cast("long")
    return F.timestamp_micros(base + offset).cast("timestamp_ntz")


def last_wins(df: DataFrame, slot: list[str], arrival: str) -> DataFrame:
    """The last arrival in each slot, and how many it replaced (n_replaced). Combined before the shuffle."""
    rest = [c for c in df.columns if c not in slot]
    out = df.groupBy(*slot).agg(F.max_by(F.struct(*rest), arrival).alias("r"), (F.count(F.lit(1)) - 1).alias("n_replaced"))
    return out.select(*slot, "r.*", "n_replaced")


def grouped(df: DataFrame, samples: int, time: str = "ts", signal: str = "signalid", arrival: str = "arrival") -> DataFrame:
    """One value for each (second, frame, signal): the last to arrive. The second is that of the raw time, even where the
    frame rounds up to the next."""
    framed = df.withColumns({"second": second_of(F.col(time)), "frame": frame_index(F.col(time), samples)})
    return last_wins(framed, ["second", "frame", signal], arrival)


def down_sampled(df: DataFrame, samples: int, time: str = "ts", signal: str = "signalid") -> DataFrame:
    """How many values a second's frames replaced: (second, down_sampled)."""
    framed = df.select(second_of(F.col(time)).alias("second"), F.struct(frame_index(F.col(time), samples), signal).alias("slot"))
    per_slot = framed.groupBy("second", "slot").agg(F.count(F.lit(1)).alias("n"))
    return per_slot.groupBy("second").agg(F.sum(F.col("n") - 1).alias("down_sampled"))


def windowed_average(df: DataFrame, low: float, high: float, window: str = "1 second", time: str = "ts", value: str = "value") -> DataFrame:
    """Average and count of the values in range, not NaN, for each window."""
    v = F.col(value)
    good = F.when((v >= low) & (v <= high) & ~F.isnan(v), v)
    out = df.groupBy(F.window(time, window).alias("w")).agg(F.avg(good).alias("average"), F.count(good).alias("n"))
    return out.select(F.col("w.start").alias("start"), "average", "n")


def reasonable(df: DataFrame, now: Column, lag: float = 10.0, lead: float = 5.0, time: str = "ts", by_second: bool = True) -> DataFrame:
    """Rows whose second (or exact time) is at most lag before and lead after now; seconds may be fractions."""
    at = second_of(F.col(time)) if by_second else F.col(time)
    late = F.unix_micros(now.cast("timestamp")) - F.unix_micros(at.cast("timestamp"))
    return df.where((late <= int(lag * 1e6)) & (late >= -int(lead * 1e6)))


def publish_windows(df: DataFrame, samples: int, delay: str = "5 seconds", time: str = "ts", signal: str = "signalid", arrival: str = "arrival") -> DataFrame:
    """Streaming: complete seconds, each emitted once the watermark has passed it; late rows are dropped."""
    framed = df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).withColumn("frame", frame_index(F.col(time), samples))
    rest = [c for c in df.columns if c not in (signal, time)]
    per = framed.groupBy(F.window(time, "1 second").alias("w"), "frame", signal).agg(F.max_by(F.struct(time, *rest), arrival).alias("r"), F.count(F.lit(1)).alias("n"))
    return per.select(F.col("w.start").alias("second"), "frame", signal, "r.*", (F.col("n") - 1).alias("n_replaced"))


def throttle(df: DataFrame, interval: str = "1 second", time: str = "ts", signal: str = "signalid", arrival: str | None = None) -> DataFrame:
    """The latest value of each signal in each interval."""
    rest = [c for c in df.columns if c != signal]
    out = df.groupBy(F.window(time, interval).alias("w"), signal).agg(F.max_by(F.struct(*rest), F.col(arrival) if arrival else F.struct(*[time, *[c for c in rest if c != time]])).alias("r"))
    return out.select(F.col("w.start").alias("interval_start"), signal, "r.*")


def without_nan(df: DataFrame, value: str = "value") -> DataFrame:
    return df.where(~F.isnan(value))


def between(df: DataFrame, start: Column | None, stop: Column | None, time: str = "ts") -> DataFrame:
    """Historical replay: rows from start to stop, both included."""
    out = df if start is None else df.where(F.col(time) >= start)
    return out if stop is None else out.where(F.col(time) <= stop)


def route(df: DataFrame, routes: DataFrame, signal: str = "signalid") -> DataFrame:
    """A row for each subscription of its signal; signals that nobody subscribes drop out. routes: (signal, connection)."""
    return df.join(routes.distinct(), signal)


def replace_routes(routes: DataFrame, connection: str, signals: DataFrame, signal: str = "signalid", by: str = "connection") -> DataFrame:
    """The route table after a connection subscribes anew: its old routes go, the new ones come."""
    return routes.where(F.col(by) != connection).unionByName(signals.select(signal, F.lit(connection).alias(by)))


def subscribed(df: DataFrame, signals: DataFrame, signal: str = "signalid") -> DataFrame:
    """Rows whose signal is in a set of ids."""
    return df.join(signals.select(F.col(signals.columns[0]).alias(signal)), signal, "left_semi")


def indexed(df: DataFrame, cache: DataFrame, keep_missing: bool = False, index: str = "signal_index") -> DataFrame:
    """Signal ids for runtime indexes; rows with an unknown index drop out, or get the zero id."""
    out = df.join(cache, index, "left" if keep_missing else "inner")
    return out.withColumn("signalid", F.coalesce("signalid", F.lit("00000000-0000-0000-0000-000000000000"))) if keep_missing else out


def adjusted(df: DataFrame, metadata: DataFrame, signal: str = "signalid", value: str = "value") -> DataFrame:
    """value * multiplier + adder; unchanged where the metadata has none. metadata: (signal, adder, multiplier)."""
    out = df.join(metadata.select(signal, "adder", "multiplier"), signal, "left")
    return out.withColumn("adjusted", F.col(value) * F.coalesce("multiplier", F.lit(1.0)) + F.coalesce("adder", F.lit(0.0)))


def to_compact(flags: Column) -> Column:
    """Eight-bit flags: a bit for each mask that has any state flag set."""
    out = F.lit(0)
    for _, bit, mask in COMPACT_FLAGS:
        out = out + F.when(flags.cast("long").bitwiseAND(F.lit(mask).cast("long")) != 0, bit).otherwise(0)
    return out


def from_compact(compact: Column) -> Column:
    """State flags with the whole mask of each compact bit."""
    out = F.lit(0).cast("long")
    for _, bit, mask in COMPACT_FLAGS:
        out = out.bitwiseOR(F.when(compact.bitwiseAND(F.lit(bit)) != 0, F.lit(mask).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def good_quality(df: DataFrame, mask: int = 0x0000EF03, flags: str = "flags") -> DataFrame:
    """Rows without any of the flags of a mask, those of bad data unless given."""
    return df.where(F.col(flags).cast("long").bitwiseAND(F.lit(mask).cast("long")) == 0)


def time_offset(ticks: Column, bases: tuple[int, int], index: int) -> Column:
    """Struct of the form a time takes beside a base: 2 bytes in milliseconds, 4 bytes in ticks, or 8 bytes whole, and its value."""
    delta = ticks.bitwiseAND(F.lit(VALUE_MASK)) - F.lit(bases[index])
    ms = F.floor(delta / 10_000)
    whole = F.struct(F.lit(8).alias("size"), ticks.alias("value"))
    in_ticks = F.struct(F.lit(4).alias("size"), delta.alias("value"))
    return F.when((bases[index] <= 0) | (delta < 0) | (delta >= 1 << 32), whole).when((ms < 65536) & (delta == ms * 10_000), F.struct(F.lit(2).alias("size"), ms.alias("value"))).otherwise(in_ticks)


def sequence_gaps(df: DataFrame, sequence: str = "sequence", channel: str | None = None) -> DataFrame:
    """Batch: rows whose sequence number is not one more than the one before, and how many are missing (0 for a reset)."""
    w = Window.partitionBy(channel).orderBy(sequence) if channel else Window.orderBy(sequence)
    step = F.col(sequence) - F.lag(sequence).over(w)
    return df.withColumn("missing", step - 1).where(F.col("missing") > 0)


def in_sequence(df: DataFrame, arrival: str, sequence: str = "sequence", channel: str = "channel") -> DataFrame:
    """Batch: rows in order of arrival, without those whose number isn't above all since the channel's last reset (number 0)."""
    by_arrival = Window.partitionBy(channel).orderBy(arrival)
    run = df.withColumn("_run", F.sum(F.when(F.col(sequence) == 0, 1).otherwise(0)).over(by_arrival))
    before = Window.partitionBy(channel, "_run").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    run = run.withColumn("_top", F.max(sequence).over(before))
    return run.where(F.col("_top").isNull() | (F.col(sequence) > F.col("_top"))).drop("_run", "_top")


def dedupe_sequence(df: DataFrame, keys: list[str], time: str | None = None, delay: str = "10 seconds") -> DataFrame:
    """Each sequence number once; a stream keeps state for the delay only."""
    if df.isStreaming and time:
        return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def ordered_blocks(df: DataFrame, channel: str = "channel", sequence: str = "sequence") -> DataFrame:
    """Batch: buffer blocks once each, in order, up to the first gap of their channel; blocks beyond it wait."""
    once = df.dropDuplicates([channel, sequence])
    w = Window.partitionBy(channel).orderBy(sequence)
    return once.withColumn("_n", F.row_number().over(w) - 1).where(F.col(sequence) == F.col("_n")).drop("_n")
