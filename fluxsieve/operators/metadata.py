"""Metadata: the selection view over devices, measurements and phasors, and lookups in it.

Dimension tables are joined by equal keys, the last duplicate in natural order winning. Spark broadcasts a side when its
measured size is under the session's threshold and shuffles by key beyond that; no size is assumed here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.binder import Binder
from ..plans.syntax import parse
from .dataset import RID

#: Signal type mnemonics and their numbers.
SIGNAL_TYPES = {"IPHM": 1, "IPHA": 2, "VPHM": 3, "VPHA": 4, "FREQ": 5, "DFDT": 6, "ALOG": 7, "FLAG": 8, "DIGI": 9, "CALC": 10, "STAT": 11, "ALRM": 12, "QUAL": 13, "UNKN": -1}
#: Signal kinds, their acronyms in references, and their type mnemonics; ? is the phasor type.
SIGNAL_KINDS = (
    ("Angle", "PA", "?PHA"), ("Magnitude", "PM", "?PHM"), ("Frequency", "FQ", "FREQ"), ("DfDt", "DF", "DFDT"), ("Status", "SF", "FLAG"), ("Digital", "DV", "DIGI"),
    ("Analog", "AV", "ALOG"), ("Calculation", "CV", "CALC"), ("Statistic", "ST", "STAT"), ("Alarm", "AL", "ALRM"), ("Quality", "QF", "QUAL"), ("Unknown", "??", "NULL"),
)
#: Beginnings of the names of protocols that carry single measurements rather than frames.
MEASUREMENT_PREFIXES = ("GATEWAY", "MODBUS", "DNP")


def last_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each key: the last in natural order."""
    # combined before the shuffle
    last = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max_by(F.struct(*[F.col(c) for c in df.columns]), RID).alias("_r"))
    return last.select("_r.*")


def protocol_type(protocol: Column, others: Sequence[str] = ()) -> Column:
    """others: further protocols of single measurements, by full name."""
    up = F.upper(F.coalesce(protocol, F.lit("")))
    hit = up.isin(*[p.upper() for p in others]) if others else F.lit(False)
    for p in MEASUREMENT_PREFIXES:
        hit = hit | F.startswith(up, F.lit(p))
    return F.when(hit, F.lit("Measurement")).otherwise(F.lit("Frame"))


def engineering_units(signal_type: Column) -> Column:
    up = F.upper(F.coalesce(signal_type, F.lit("")))
    return F.when(up == "IPHM", "Amps").when(up == "VPHM", "Volts").when(up == "FREQ", "Hz").when(F.endswith(up, F.lit("PHA")), "Degrees").otherwise("")


def _case(key: Column, pairs: dict[str, object], other: object) -> Column:
    out = F.lit(other)
    for k, v in pairs.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def signal_type(text: Column) -> Column:
    """Number of a mnemonic; -1 for an unknown one."""
    return _case(F.upper(F.trim(text)), SIGNAL_TYPES, -1)


def signal_kind(acronym: Column) -> Column:
    return _case(F.upper(F.trim(acronym)), {a: k for k, a, _ in SIGNAL_KINDS}, "Unknown")


def type_of_kind(kind: Column, phasor: Column) -> Column:
    """Mnemonic of a kind; phasor is V or I."""
    out = _case(kind, {k: m for k, _, m in SIGNAL_KINDS}, "NULL")
    return F.replace(out, F.lit("?"), F.upper(phasor))


def key_parts(key: Column) -> tuple[Column, Column]:
    """Source and number of a key such as PPA:12; anything but two parts with a number gives _ and 0."""
    parts = F.split(key, ":")
    n = F.try_element_at(parts, F.lit(2)).try_cast("long")
    good = (F.size(parts) == 2) & n.isNotNull()
    return F.when(good, parts[0]).otherwise("_"), F.when(good, n).otherwise(F.lit(0).cast("long"))


def joined_devices(measurements: DataFrame, devices: DataFrame) -> DataFrame:
    """Measurements with their device's columns, prefixed by device_; null where there is none."""
    d = last_by(devices, ["Acronym"])
    d = d.select(*[F.col(c).alias(f"device_{c}") for c in d.columns])
    return measurements.join(d, F.col("DeviceAcronym") == F.col("device_Acronym"), "left")


def joined_phasors(measurements: DataFrame, phasors: DataFrame) -> DataFrame:
    p = last_by(phasors, ["DeviceAcronym", "SourceIndex"])
    p = p.select(*[F.col(c).alias(f"phasor_{c}") for c in p.columns])
    on = (F.col("DeviceAcronym") == F.col("phasor_DeviceAcronym")) & (F.col("PhasorSourceIndex") == F.col("phasor_SourceIndex"))
    return measurements.join(p, on, "left")


def active_measurements(measurements: DataFrame, devices: DataFrame, phasors: DataFrame, node_id: str = "00000000-0000-0000-0000-000000000000") -> DataFrame:
    """The view that filters select from; rows that are not enabled are left out, those without the flag stay."""
    m = joined_phasors(joined_devices(measurements, devices), phasors)
    enabled = F.coalesce(F.col("Enabled").cast("int") != 0, F.lit(True))
    guid = {"logical": "guid"}
    return m.where(enabled).select(
        F.coalesce("device_NodeID", F.lit(node_id)).alias("SourceNodeID", metadata=guid), F.col("ID"), F.col("SignalID").alias("SignalID", metadata=guid), F.col("PointTag"),
        F.lit("").alias("AlternateTag"), F.col("SignalReference"), F.coalesce(F.col("Internal").cast("int"), F.lit(1)).alias("Internal"), F.lit(0).alias("Subscribed"),
        F.col("DeviceAcronym").alias("Device"), F.col("device_AccessID").alias("DeviceID"), F.coalesce("device_FramesPerSecond", F.lit(30)).alias("FramesPerSecond"),
        F.coalesce("device_ProtocolName", F.lit("")).alias("Protocol"), protocol_type(F.col("device_ProtocolName")).alias("ProtocolType"), F.coalesce("SignalAcronym", F.lit("CALC")).alias("SignalType"),
        engineering_units(F.col("SignalAcronym")).alias("EngineeringUnits"), F.col("phasor_ID").alias("PhasorID"), F.col("phasor_Type").alias("PhasorType"), F.col("phasor_Phase").alias("Phase"),
        F.lit(0.0).alias("Adder"), F.lit(1.0).alias("Multiplier"), F.col("device_CompanyAcronym").alias("Company"), F.col("device_Longitude").alias("Longitude"), F.col("device_Latitude").alias("Latitude"),
        F.col("Description"), F.col("UpdatedOn"), F.col(RID),
    )


def filter_metadata(measurements: DataFrame, expression: str) -> DataFrame:
    """Enabled rows (not those without the flag) that meet a bare expression, with their key split."""
    keep = Binder(measurements).predicate(parse(expression)[0].root)
    source, number = key_parts(F.col("ID"))
    return measurements.where(keep & F.coalesce(F.col("Enabled").cast("int") != 0, F.lit(False))).withColumns({"Source": source, "Number": number})


def phasor_pairs(phasors: DataFrame, measurements: DataFrame) -> DataFrame:
    """Every phasor with the ids of its angle and magnitude; both, or neither if one is missing."""
    by_ref = last_by(measurements, ["SignalReference"]).select("SignalReference", "SignalID")
    key = F.concat(F.col("DeviceAcronym"), F.lit("-"))
    index = F.col("SourceIndex").cast("string")
    p = phasors.withColumns({"_angle": F.concat(key, F.lit("PA"), index), "_magnitude": F.concat(key, F.lit("PM"), index)})
    for name in ("angle", "magnitude"):
        p = p.join(by_ref.select(F.col("SignalReference").alias(f"_{name}"), F.col("SignalID").alias(f"{name}_id")), f"_{name}", "left")
    both = F.col("angle_id").isNotNull() & F.col("magnitude_id").isNotNull()
    return p.withColumns({f"{n}_id": F.when(both, F.col(f"{n}_id")) for n in ("angle", "magnitude")}).drop("_angle", "_magnitude")


def lookup(df: DataFrame, column: str, value: object) -> DataFrame:
    """The last row whose column has the value, no row if none has."""
    return df.where(F.col(column) == F.lit(value)).orderBy(F.desc(RID)).limit(1)


def find_by_signal_type(df: DataFrame, acronym: str, source: str | None = None, column: str = "SignalAcronym", key: str = "ID") -> DataFrame:
    out = df.where(F.upper(column) == acronym.upper())
    return out if source is None else out.where(F.upper(key_parts(F.col(key))[0]) == source.upper())


def _any(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return F.coalesce(out, F.lit(False))


def find_any(df: DataFrame, text: str, exact: Sequence[str], part: Sequence[str]) -> DataFrame:
    """Rows where one column is the text or another holds it; each row once."""
    equal = [F.coalesce(F.col(c) == text, F.lit(False)) for c in exact]
    return df.where(_any([*equal, *[F.coalesce(F.contains(F.col(c), F.lit(text)), F.lit(False)) for c in part]]))


def find_measurements(df: DataFrame, text: str) -> DataFrame:
    return find_any(df, text, ("PointTag", "SignalReference"), ("Description", "DeviceAcronym"))


def find_devices(df: DataFrame, text: str) -> DataFrame:
    return find_any(df, text, ("Acronym",), ("Acronym", "Name", "ParentAcronym", "CompanyAcronym", "VendorAcronym", "VendorDeviceName"))
