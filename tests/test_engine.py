import uuid

import pytest
from pyspark.sql import functions as F

from fluxsieve import format_queries as formats
from fluxsieve.operators import statements as Q
from fluxsieve.operators.dataset import RID, DataSet, IdFields, field
from fluxsieve.plans.types import FilterError
from fluxsieve.queries import ORACLES, QUERIES
from fluxsieve.sources import codec
from fluxsieve.sources.xml_data import read_xml, scan_xml, write_table, write_xml
from fluxsieve.streaming import measurements as S
from fluxsieve.streaming.pubsub import Busy, Publisher, Subscriber
from tests.oracle import connect, same

STAT, FREQ = "aaaaaaaa-0000-0000-0000-000000000001", "aaaaaaaa-0000-0000-0000-000000000002"


@pytest.fixture(scope="module")
def two(spark):
    d = DataSet(spark)
    d.create("ActiveMeasurements", [field("SignalID", "GUID"), field("SignalType", "STRING"), field("ID", "STRING"), field("PointTag", "STRING"), field("Enabled", "BOOLEAN")],
             [[STAT, "STAT", "PPA:1", "TAG1", True], [FREQ, "FREQ", "PPA:12", "Tag2", False], ["00000000-0000-0000-0000-000000000000", None, "PPA:13", None, None]])
    return d


def ids(df):
    return [r.SignalID for r in df.collect()]


def test_statements(two):
    run = lambda text, **k: ids(Q.select_rows(two, text, "ActiveMeasurements", **k))
    assert run("FILTER ActiveMeasurements WHERE SignalType IN ('stat', 'freq') ORDER BY SignalType") == [FREQ, STAT]
    assert run("FILTER TOP 1 ActiveMeasurements WHERE SignalType IN ('stat', 'freq') ORDER BY SignalType") == [STAT]
    assert run("FILTER ActiveMeasurements WHERE True ORDER BY Enabled, SignalID")[1:] == [STAT, FREQ]
    assert run("FILTER ActiveMeasurements WHERE SignalType = 'freq'; {" + STAT + "}") == [STAT, FREQ]
    assert run(f"{STAT}; {FREQ}; {STAT}") == [STAT, FREQ]
    assert run("FILTER ActiveMeasurements WHERE SignalType IN ('stat', 'freq') ORDER BY SignalType; PPA:13; FILTER ActiveMeasurements WHERE True ORDER BY Enabled DESC")[1:] == [FREQ, STAT]
    assert run("ppa:12") == [FREQ]
    assert run('"TAG2";;"tag1"') == [FREQ, STAT]
    assert run("FILTER ActiveMeasurements WHERE Len(SignalType)", strict=False) == []
    with pytest.raises(FilterError):
        run("FILTER ActiveMeasurements WHERE Len(SignalType)")
    for bad in ("", "FILTER Nothing WHERE True", "FILTER ActiveMeasurements WHERE True ORDER BY Nope", "FILTER TOP 0x1 ActiveMeasurements WHERE True"):
        with pytest.raises(FilterError):
            run(bad)
    assert Q.statement_count(f"{STAT};; FILTER ActiveMeasurements WHERE True; True;") == 3


def test_signal_ids(two):
    got = {r.signal_id for r in Q.select_signal_ids(two, f"True; {uuid.UUID(int=5)}", "ActiveMeasurements").collect()}
    assert got == {STAT, FREQ, str(uuid.UUID(int=5))}
    assert Q.select_row_set(two, "True; SignalType = 'stat'", "ActiveMeasurements").count() == 3


def test_table_select(two):
    assert two.select("activemeasurements", "", "", 0).count() == 3
    assert two.select("ActiveMeasurements", "", "SignalID DESC", 2).count() == 2
    assert two.rows_where("ActiveMeasurements", F.col("SignalType").isNotNull(), 1).count() == 1
    assert not two.remove("nope")


def test_xml_round_trip(spark, tmp_path):
    d = DataSet(spark, "Meta")
    kinds = [("a", "STRING"), ("b", "BOOLEAN"), ("c", "DATETIME"), ("d", "SINGLE"), ("e", "DOUBLE"), ("f", "DECIMAL"), ("g", "GUID"), ("h", "INT8"), ("i", "INT64"), ("j", "UINT64")]
    import datetime as dt
    import decimal

    row = ["x<&>", True, dt.datetime(2024, 1, 2, 3, 4, 5, 120000), 1.5, 2.25, decimal.Decimal("3.5"), STAT, 7, 2**40, decimal.Decimal(2**63)]
    d.create("T", [field(*k) for k in kinds] + [field("z", "INT32", "h + 1")], [row + [None], [None] * 11, ["", False, None, 0.0, 0.0, decimal.Decimal(0), FREQ, 0, 0, decimal.Decimal(0), None]])
    text = write_xml(d)
    back = read_xml(spark, text)
    a, b = ([tuple(r) for r in x.table("T").orderBy(RID).collect()] for x in (d, back))
    assert a == b and a[0][10] == 8 and a[1][10] == 0
    import gzip

    assert read_xml(spark, gzip.compress(text.encode())).table("T").count() == 3
    with pytest.raises(FilterError):
        read_xml(spark, "<a><b/></a>")
    with pytest.raises(FilterError):
        read_xml(spark, "<a>")
    empty = read_xml(spark, text.replace("<h>7</h>", "<h/>")).table("T").orderBy(RID).first()
    assert empty["h"] == 0
    fields = [f for f in d.table("T").schema.fields if f.name in ("a", "h", "z")]
    write_table(d.table("T").where("a is not null").select("a", "h"), str(tmp_path / "x"), "T")
    assert {(r.a, r.h, r.z) for r in scan_xml(spark, str(tmp_path / "x"), "T", fields).collect()} == {("x<&>", 7, 8), ("", 0, 1)}


def test_codecs(spark):
    base = 638_396_640_000_000_000
    rows = [(1, 1.5, base + 5 * 10_000, 0x1000), (2, -2.0, base + 123, 0), (3, 0.0, base + 2**40, 0x80000000)]
    for ms in (True, False):
        got = codec.decode_packet(codec.encode_packet(rows, (base, 0), 0, ms), (base, 0), ms)
        assert [(r[0], r[1]) for r in got] == [(1, 1.5), (2, -2.0), (3, 0.0)]
        assert got[0][2] == rows[0][2] and got[2][2] == rows[2][2] and got[0][3] == 0x1000 and got[2][3] == 0xE0000000
        assert ms or got[1][2] == rows[1][2]
    assert [r[2] for r in codec.decode_packet(codec.encode_packet(rows, with_time=False), with_time=False)] == [0, 0, 0]
    df = spark.createDataFrame([(1, bytearray(codec.encode_packet(rows))), (2, None)], "packet_id long, packet binary")
    assert codec.decode_packets(df).count() == 3
    packets = codec.encode_packets(spark.createDataFrame(rows, "signal_index long, value double, ticks long, flags long").coalesce(1), 2)
    assert [r.n for r in packets.collect()] == [2, 1]
    for bits in (16, 32, 64):
        for v in (0, 1, 127, 128, 300, 2 ** (bits - 1) - 1, -1, -300):
            data = codec.write_7bit(v, bits) + b"x"
            assert codec.read_7bit(data, 0, bits, True) == (v, len(data) - 1)
    signals = [(0, uuid.UUID(int=7), "PPA", 12), (5, uuid.UUID(int=8), "Ünï", 2**40)]
    assert codec.decode_index_cache(codec.encode_index_cache(uuid.UUID(int=1), signals, [uuid.UUID(int=9)])) == (uuid.UUID(int=1), signals, [uuid.UUID(int=9)])


def _metadata(spark):
    d = DataSet(spark, "Metadata")
    d.create("DeviceDetail", [field(n, k) for n, k in (("NodeID", "GUID"), ("Acronym", "STRING"), ("Name", "STRING"), ("AccessID", "INT32"), ("ParentAcronym", "STRING"), ("ProtocolName", "STRING"), ("FramesPerSecond", "INT32"), ("CompanyAcronym", "STRING"), ("VendorAcronym", "STRING"), ("VendorDeviceName", "STRING"), ("Longitude", "DECIMAL"), ("Latitude", "DECIMAL"))],
             [[STAT, "SHELBY", "Shelby", 2, "", "IeeeC37_118V1", 30, "C", "V", "D", None, None]])
    d.create("MeasurementDetail", [field(n, k) for n, k in (("DeviceAcronym", "STRING"), ("ID", "STRING"), ("SignalID", "GUID"), ("PointTag", "STRING"), ("SignalReference", "STRING"), ("SignalAcronym", "STRING"), ("PhasorSourceIndex", "INT32"), ("Description", "STRING"), ("Internal", "BOOLEAN"), ("Enabled", "BOOLEAN"), ("UpdatedOn", "DATETIME"))],
             [["SHELBY", "PPA:1", STAT, "T1", "SHELBY-ST1", "STAT", None, "d", True, True, None], ["SHELBY", "PPA:2", FREQ, "T2", "SHELBY-FQ", "FREQ", None, "d", True, True, None], ["OTHER", "PPA:3", str(uuid.UUID(int=3)), "T3", "X", "CALC", None, "d", True, False, None]])
    d.create("PhasorDetail", [field(n, k) for n, k in (("ID", "INT32"), ("DeviceAcronym", "STRING"), ("Label", "STRING"), ("Type", "STRING"), ("Phase", "STRING"), ("SourceIndex", "INT32"))], [[1, "SHELBY", "L", "V", "A", 1]])
    return d


def test_publish_and_subscribe(spark, tmp_path):
    p, s = Publisher(spark, str(tmp_path)), Subscriber(spark, str(tmp_path))
    assert {r.ID: r.EngineeringUnits for r in p.define_metadata(_metadata(spark)).collect()} == {"PPA:1": "", "PPA:2": "Hz"}
    assert [r.ID for r in p.filter_metadata("SignalAcronym <> 'x'").collect()] == ["PPA:1", "PPA:2"]
    t = S.UNIX_TICKS + 1_704_067_200 * S.TICKS_PER_SECOND
    p.publish(spark.createDataFrame([(STAT, 1.0, t, 0), (FREQ, 60.0, t, 0), (FREQ, float("nan"), t + S.TICKS_PER_SECOND, 0)], "signalid string, value double, ticks long, flags long"))
    assert s.subscribe("FILTER ActiveMeasurements WHERE SignalType = 'FREQ'").count() == 2
    assert s.subscribe(options=S.StreamOptions(nan_filter=True)).count() == 2
    assert s.subscribe(options=S.StreamOptions(stop="2024-01-01")).count() == 2
    assert len(list(s.read(s.subscribe(options=S.StreamOptions(throttled=True))))) == 3
    seen = []
    s.receive(s.subscribe(STAT, streaming=True), lambda b: seen.extend(b.collect()), str(tmp_path / "check")).awaitTermination(60)
    assert [r.value for r in seen] == [1.0] and s.total_received == 1


def test_windows_as_a_stream(spark, tmp_path):
    base = spark.createDataFrame([("a", 1.0, "2024-01-01 00:00:00.010", 1), ("a", 2.0, "2024-01-01 00:00:00.012", 2), ("b", 3.0, "2024-01-01 00:00:01.5", 3), ("z", 0.0, "2024-01-01 00:01:00", 9)], "signalid string, value double, t string, arrival long")
    base = base.withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")
    base.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(base.schema).parquet(str(tmp_path / "in"))
    for _ in range(2):
        q = S.publish_windows(stream, 30).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(60)
    got = {(r.signalid, r.frame, r.value, r.n_replaced) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("a", 0, 2.0, 1), ("b", 15, 3.0, 0)}


def test_sequences(spark):
    df = spark.createDataFrame([("c", 0, "x"), ("c", 2, "z"), ("c", 1, "y"), ("c", 1, "y"), ("c", 5, "w")], "channel string, sequence long, buffer string")
    assert sorted(r.sequence for r in S.ordered_blocks(df).collect()) == [0, 1, 2]
    assert [(r.sequence, r.missing) for r in S.sequence_gaps(df.distinct(), "sequence", "channel").collect()] == [(5, 2)]


def test_ids_of_other_columns(spark):
    d = DataSet(spark)
    d.create("T", [field("Name", "STRING"), field("K", "STRING")], [["n1", "a:1"], ["n2", "A:1"]], ids=IdFields("Name", "K", "Name"))
    assert [r.Name for r in Q.select_rows(d, "A:1").collect()] == ["n1"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle(spark, sf, name):
    same(QUERIES[name](spark, sf).toPandas(), connect(sf).sql(ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(formats.QUERIES))
def test_formats(spark, sf, name):
    same(formats.QUERIES[name](spark, sf).toPandas(), connect(sf).sql(formats.ORACLES[name]).df())


def test_busy_callbacks_drop_and_count():
    import threading

    hold, seen = threading.Event(), []
    busy = Busy(lambda x: (hold.wait(10), seen.append(x)))
    assert busy.offer(1) and not busy.offer(2) and not busy.offer(3)
    hold.set()
    busy.wait()
    assert busy.offer(4)
    busy.wait()
    assert seen == [1, 4] and busy.dropped == 2 and busy.done == 2


def test_configuration_changes(spark, tmp_path):
    publisher, subscriber, seen = Publisher(spark, str(tmp_path)), Subscriber(spark, str(tmp_path)), []
    d = DataSet(spark)
    for name, schema in (("DeviceDetail", "NodeID string, Acronym string, Name string, AccessID int, FramesPerSecond int, ProtocolName string, CompanyAcronym string, VendorAcronym string, VendorDeviceName string, ParentAcronym string, Longitude double, Latitude double, UpdatedOn timestamp_ntz"),
                         ("MeasurementDetail", "DeviceAcronym string, ID string, SignalID string, PointTag string, SignalReference string, SignalAcronym string, PhasorSourceIndex int, Internal boolean, Enabled boolean, Description string, UpdatedOn timestamp_ntz"),
                         ("PhasorDetail", "ID int, DeviceAcronym string, Label string, Type string, Phase string, SourceIndex int, UpdatedOn timestamp_ntz")):
        d.add(name, spark.createDataFrame([], schema))
    publisher.define_metadata(d)
    changes = [subscriber.configuration_changed(lambda x: seen.append(x.names())) for _ in range(2)]
    publisher.define_metadata(d)
    changes.append(subscriber.configuration_changed(lambda x: seen.append(x.names())))
    assert changes == [True, False, True] and len(seen) == 2 and len(seen[0]) == 3
