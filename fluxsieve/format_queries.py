"""Queries over formats and protocols, each with DuckDB SQL: rows are written and read back, published and received, encoded and
decoded. Tables that a format holds in one document (XML, index caches) are the small fixed ones; streams are whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import metadata as M
from .operators import statements as Q
from .operators.dataset import RID, DataSet, IdFields, field
from .session import shared_dir, ship
from .sources import codec, delta
from .sources.xml_data import read_xml, scan_xml, write_table, write_xml
from .streaming import measurements as S
from .streaming.pubsub import Publisher, Subscriber, sent_totals

Query = Callable[[SparkSession, str], DataFrame]

_TICKS = "epoch_us(ts) * 10 + 621355968000000000"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _folder(spark: SparkSession) -> str:
    """A new one, which goes when the session's JVM ends."""
    path = f"{shared_dir(spark)}/formats-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def _nations(spark: SparkSession, sf_dir: str) -> DataSet:
    """Built row by row: the 25 rows that the table has at any scale."""
    out = DataSet(spark, "Nations")
    rows = [(r.n_nationkey, r.n_name, None if r.n_nationkey % 4 == 0 else r.n_regionkey / 2, r.n_nationkey % 2 == 0, None) for r in _read(spark, sf_dir, "nation").orderBy("n_nationkey").toLocalIterator()]
    out.create("nation", [field("k", "INT32"), field("name", "STRING"), field("half", "DOUBLE"), field("even", "BOOLEAN"), field("twice", "INT32", "k * 2")], rows)
    return out


def xml_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as one document with its schema, gzipped or not, and read back."""
    return read_xml(spark, write_xml(_nations(spark, sf_dir))).table("nation").drop(RID)


def xml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written and read by the executors."""
    path = _folder(spark)
    write_table(_read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), path, "customer")
    return scan_xml(spark, path, "customer", [field("c_custkey", "INT64"), field("c_name", "STRING"), field("c_acctbal", "DOUBLE")])


def table_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _nations(spark, sf_dir)
    d.clone_structure("nation", "empty")
    d.create("gone", [field("x", "INT32")], [[1]])
    d.remove("GONE")
    return d.row_counts()


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("long").alias("signal_index"), F.col("value").cast("double").alias("value"), S.time_to_ticks(F.col("ts")).alias("ticks"), F.lit(0).cast("long").alias("flags"), "event_id", "event_type")


def packets_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    packets = codec.encode_packets(_measured(spark, sf_dir)).withColumn("packet_id", F.monotonically_increasing_id())
    return codec.decode_packets(packets).drop("packet_id")


def packet_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements sent, and the bytes of their records."""
    ship(spark)
    total = sent_totals(codec.encode_packets(_measured(spark, sf_dir)))
    return total.select("measurements", (F.col("bytes") - 4 * F.col("packets")).alias("record_bytes"))


def delta_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A connection for each user: its measurements in order, through the stateful codec."""
    ship(spark)
    rows = _measured(spark, sf_dir).select(F.col("signal_index").cast("string").alias("connection"), F.col("event_id").cast("long").alias("position"), F.pmod("event_id", F.lit(7)).cast("long").alias("signal_index"), "value", "ticks", "flags")
    return delta.decode_connections(delta.encode_connections(rows)).drop("sequence")


def seven_bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys squared, as bytes, and read back."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [codec.write_7bit(v) for v in batch["v"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["o_orderkey"], pa.array(map(len, data), pa.int32()), pa.array([codec.read_7bit(d)[0] for d in data], pa.int64())], ["o_orderkey", "n", "v"])

    rows = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("o_orderkey"), (F.col("o_orderkey").cast("long") * F.col("o_orderkey")).alias("v"))
    return rows.mapInArrow(run, "o_orderkey long, n int, v long")


def index_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cache document of the 25 nations."""
    rows = [(r.n_nationkey, uuid.UUID(int=r.n_nationkey + 1), r.n_name, r.n_regionkey) for r in _read(spark, sf_dir, "nation").toLocalIterator()]
    _, signals, _ = codec.decode_index_cache(codec.encode_index_cache(uuid.UUID(int=9), rows, [uuid.UUID(int=5)]))
    return spark.createDataFrame([(i, str(s), name, n) for i, s, name, n in signals], "signal_index int, signalid string, source string, number long")


def _published(spark: SparkSession, sf_dir: str) -> tuple[Publisher, Subscriber]:
    """Suppliers are the measurements' metadata, in XML, nations the devices; events go to suppliers by user."""
    folder = _folder(spark)
    publisher, out = Publisher(spark, folder), DataSet(spark)
    s, n = _read(spark, sf_dir, "supplier"), _read(spark, sf_dir, "nation")
    # a device's first supplier is its measurement: 25 at any scale
    m = s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("k")).select(
        F.concat(F.lit("PPA:"), F.col("s_nationkey").cast("string")).alias("ID"), F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad((F.col("s_nationkey") + 1).cast("string"), 12, "0")).alias("SignalID"),
        F.concat(F.lit("TAG"), F.col("s_nationkey").cast("string")).alias("PointTag"), F.concat(F.lit("DEV"), F.col("s_nationkey").cast("string")).alias("DeviceAcronym"), F.concat(F.lit("DEV"), F.col("s_nationkey").cast("string"), F.lit("-FQ")).alias("SignalReference"),
        F.lit(0).alias("PhasorSourceIndex"), F.lit("FREQ").alias("SignalAcronym"), F.lit(True).alias("Internal"), F.lit(True).alias("Enabled"), F.lit("").alias("Description"), F.lit(None).cast("timestamp_ntz").alias("UpdatedOn"), F.col("s_nationkey").cast("long").alias(RID),
    )
    d = n.select(
        F.lit("node").alias("NodeID"), F.concat(F.lit("DEV"), F.col("n_nationkey").cast("string")).alias("Acronym"), F.col("n_name").alias("Name"), F.col("n_nationkey").cast("int").alias("AccessID"), F.lit(30).alias("FramesPerSecond"), F.lit("Gateway").alias("ProtocolName"),
        F.lit("C").alias("CompanyAcronym"), F.lit("V").alias("VendorAcronym"), F.lit("VD").alias("VendorDeviceName"), F.lit("").alias("ParentAcronym"), F.lit(0.0).alias("Longitude"), F.lit(0.0).alias("Latitude"), F.lit(None).cast("timestamp_ntz").alias("UpdatedOn"), F.col("n_nationkey").cast("long").alias(RID),
    )
    p = spark.createDataFrame([], "ID int, DeviceAcronym string, Label string, Type string, Phase string, SourceIndex int, UpdatedOn timestamp_ntz")
    for name, df in (("DeviceDetail", d), ("MeasurementDetail", m), ("PhasorDetail", p)):
        out.add(name, df)
    publisher.define_metadata(out)
    e = _measured(spark, sf_dir)
    signals = F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad((F.pmod("signal_index", F.lit(25)) + 1).cast("string"), 12, "0"))
    publisher.publish(e.select(signals.alias("signalid"), "value", "ticks", "flags"))
    return publisher, Subscriber(spark, folder)


def publish_subscribe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter is evaluated on the metadata that were requested; only its signals come."""
    _, subscriber = _published(spark, sf_dir)
    got = subscriber.subscribe("FILTER ActiveMeasurements WHERE Device IN ('dev3', 'DEV7') OR ID = 'ppa:20'")
    return got.groupBy("signalid").agg(F.count(F.lit(1)).alias("n"), F.min("ticks").alias("first"), F.max("ticks").alias("last"))


def metadata_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested, unpacked and parsed; read one record after the other."""
    _, subscriber = _published(spark, sf_dir)
    table = subscriber.request_metadata().table("MeasurementDetail").select("ID", "PointTag", "DeviceAcronym")
    return spark.createDataFrame([tuple(r) for r in subscriber.read(table)], table.schema)


def window_emission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of all events: seconds come out once the watermark of 5 s has passed them."""
    path = _folder(spark)
    e = _read(spark, sf_dir, "events")
    slim = e.select(F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("signalid"), F.col("event_id").alias("arrival"), "value")
    slim.write.parquet(f"{path}/in")
    stream = S.publish_windows(spark.readStream.schema(slim.schema).parquet(f"{path}/in"), 30)
    out = stream.select(F.col("second").cast("timestamp_ntz").alias("second"), "frame", "signalid", "arrival", "value", "n_replaced")
    out.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{path}/out")


def entry_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same filter through each public entry point: rows, rows of a table, distinct rows, signal ids."""
    c = DataSet(spark)
    c.add("customer", _read(spark, sf_dir, "customer"), ["c_custkey"], IdFields("c_name", "c_name", "c_name"))
    text = "FILTER customer WHERE c_nationkey = 3; c_nationkey < 5"
    parts = [
        ("rows", Q.select_rows(c, text, "customer")), ("repeated rows", Q.select_rows(c, text, "customer", distinct=False)), ("row set", Q.select_row_set(c, text, "customer")),
        ("signal ids", Q.select_signal_ids(c, text, "customer")), ("table", c.select("customer", "c_nationkey = 3")), ("expression", Q.evaluate_over(c.table("customer"), "c_nationkey = 3", "v").where("v")),
    ]
    out = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("entry"), "n")
        out = one if out is None else out.unionAll(one)
    return out


def statement_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = ["a = 1", "FILTER t WHERE a = 1; b = 2", "PPA:1; PPA:2; \"TAG\";", "a = 'x;y'; b"]
    return spark.createDataFrame([(t, Q.statement_count(t)) for t in texts], "text string, n int")


def clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Now and UtcNow for every region, in a session of a zone 5:30 ahead: how far they are apart in half hours, and that UtcNow is
    within minutes of the clock."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        r = DataSet(spark)
        r.add("region", _read(spark, sf_dir, "region"), ["r_regionkey"])
        from .plans.binder import Binder
        from .plans.syntax import parse

        t = r.table("region")
        now, utc = (Binder(t).bind(parse(x)[0].root).col for x in ("Now()", "UtcNow()"))
        micros = lambda x: F.unix_micros(x.cast("timestamp_ntz").cast("timestamp"))
        apart = (micros(now) - micros(utc)) / 1_000_000
        # what the session takes for local time is 5:30 ahead of it
        late = F.abs(micros(utc) - F.unix_micros(F.current_timestamp()) + 19_800_000_000) / 1_000_000
        rows = t.select("r_regionkey", F.round(apart / 1800).cast("int").alias("half_hours"), late.alias("late")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return spark.createDataFrame([(int(x.r_regionkey), x.half_hours, bool(x.late < 600)) for x in rows], "r_regionkey long, half_hours int, is_utc boolean")


def metadata_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as measurements with missing values."""
    s = _read(spark, sf_dir, "supplier")
    gap = F.col("s_suppkey") % 3 == 0
    text = lambda x: F.when(~gap, x)
    m = s.select(
        text(F.concat(F.lit("PPA:"), F.col("s_suppkey").cast("string"))).alias("ID"), F.lpad(F.col("s_suppkey").cast("string"), 12, "0").alias("SignalID"), text(F.col("s_name")).alias("PointTag"), text(F.lit("DEV")).alias("DeviceAcronym"), text(F.lit("REF-FQ")).alias("SignalReference"),
        F.lit(None).cast("int").alias("PhasorSourceIndex"), text(F.lit("FREQ")).alias("SignalAcronym"), F.lit(True).alias("Internal"), F.lit(True).alias("Enabled"), text(F.lit("d")).alias("Description"), F.lit(None).cast("timestamp_ntz").alias("UpdatedOn"), F.col("s_suppkey").cast("long").alias(RID),
    )
    d = spark.createDataFrame([], "NodeID string, Acronym string, Name string, AccessID int, FramesPerSecond int, ProtocolName string, CompanyAcronym string, VendorAcronym string, VendorDeviceName string, ParentAcronym string, Longitude double, Latitude double, UpdatedOn timestamp_ntz")
    p = spark.createDataFrame([], "ID int, DeviceAcronym string, Label string, Type string, Phase string, SourceIndex int, UpdatedOn timestamp_ntz")
    return M.active_measurements(m, d.withColumn(RID, F.lit(0).cast("long")), p.withColumn(RID, F.lit(0).cast("long"))).select("SignalID", "FramesPerSecond", "Protocol", "Adder", "Multiplier", "Subscribed")


_NATION = "SELECT CAST(n_nationkey AS INTEGER) AS k, n_name AS name, CASE WHEN n_nationkey % 4 <> 0 THEN n_regionkey / 2.0::DOUBLE END AS half, n_nationkey % 2 = 0 AS even, CAST(n_nationkey * 2 AS INTEGER) AS twice FROM nation"

#: Name, query, DuckDB SQL.
FORMATS: tuple[tuple[str, Query, str], ...] = (
    ("xml_document", xml_document, _NATION),
    ("xml_files", xml_files, "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_acctbal AS DOUBLE) AS c_acctbal FROM customer"),
    ("table_build", table_build, "SELECT 'nation' AS table_name, count(*) AS rows FROM nation UNION ALL SELECT 'empty', 0"),
    ("packets_round_trip", packets_round_trip, f"SELECT CAST(user_id AS BIGINT) AS signal_index, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value, {_TICKS} AS ticks, CAST(0 AS BIGINT) AS flags FROM events"),
    ("packet_totals", packet_totals, "SELECT count(*) AS measurements, 17 * count(*) AS record_bytes FROM events"),
    ("delta_round_trip", delta_round_trip, f"SELECT CAST(user_id AS VARCHAR) AS connection, CAST(event_id % 7 AS BIGINT) AS signal_index, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value, {_TICKS} AS ticks, CAST(0 AS BIGINT) AS flags FROM events"),
    ("seven_bit", seven_bit, "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(least(9, greatest(1, ceil(len(ltrim(bin(CAST(o_orderkey AS BIGINT) * o_orderkey), '0')) / 7.0))) AS INTEGER) AS n, CAST(o_orderkey AS BIGINT) * o_orderkey AS v FROM orders"),
    ("index_cache", index_cache, "SELECT CAST(n_nationkey AS INTEGER) AS signal_index, '00000000-0000-0000-0000-' || lpad(lower(hex(CAST(n_nationkey + 1 AS BIGINT))), 12, '0') AS signalid, n_name AS source, CAST(n_regionkey AS BIGINT) AS number FROM nation"),
    ("publish_subscribe", publish_subscribe, f"SELECT '00000000-0000-0000-0000-' || lpad(CAST(user_id % 25 + 1 AS VARCHAR), 12, '0') AS signalid, count(*) AS n, min({_TICKS}) AS first, max({_TICKS}) AS last FROM events WHERE user_id % 25 IN (3, 7, 20) AND user_id % 25 IN (SELECT s_nationkey FROM supplier) GROUP BY 1"),
    ("metadata_request", metadata_request, "SELECT DISTINCT 'PPA:' || s_nationkey AS ID, 'TAG' || s_nationkey AS PointTag, 'DEV' || s_nationkey AS DeviceAcronym FROM supplier"),
    ("window_emission", window_emission, "WITH f AS (SELECT date_trunc('second', ts)::TIMESTAMP AS second, CAST(round_even((epoch_us(ts) % 1000000) * 30.0::DOUBLE / 1e6, 0) AS INTEGER) AS frame, user_id AS signalid, event_id, value FROM events) SELECT second, frame, signalid, max(event_id) AS arrival, arg_max(value, event_id) AS value, count(*) - 1 AS n_replaced FROM f WHERE second + INTERVAL 1 SECOND <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 5 SECOND GROUP BY 1, 2, 3"),
    ("entry_points", entry_points, "SELECT 'rows' AS entry, count(*) AS n FROM customer WHERE c_nationkey < 5 UNION ALL SELECT 'repeated rows', count(*) + count(*) FILTER (c_nationkey = 3) FROM customer WHERE c_nationkey < 5 UNION ALL SELECT 'row set', count(*) FROM customer WHERE c_nationkey < 5 UNION ALL SELECT 'signal ids', count(*) FROM customer WHERE c_nationkey < 5 UNION ALL SELECT 'table', count(*) FROM customer WHERE c_nationkey = 3 UNION ALL SELECT 'expression', count(*) FROM customer WHERE c_nationkey = 3"),
    ("statement_counts", statement_counts, "SELECT text, CAST(n AS INTEGER) AS n FROM (VALUES ('a = 1', 1), ('FILTER t WHERE a = 1; b = 2', 2), ('PPA:1; PPA:2; \"TAG\";', 3), ('a = ''x;y''; b', 2)) t(text, n)"),
    ("fn_now_utcnow_zone", clock, "SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, CAST(11 AS INTEGER) AS half_hours, true AS is_utc FROM region"),
    ("metadata_defaults", metadata_defaults, "SELECT lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS SignalID, CAST(30 AS INTEGER) AS FramesPerSecond, '' AS Protocol, 0.0::DOUBLE AS Adder, 1.0::DOUBLE AS Multiplier, false AS Subscribed FROM supplier"),
)

QUERIES: dict[str, Query] = {name: query for name, query, _ in FORMATS}
ORACLES: dict[str, str] = {name: sql for name, _, sql in FORMATS}
