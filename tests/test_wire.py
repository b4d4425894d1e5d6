import socketserver
import struct
import threading
import time

import pytest

from fluxsieve.session import ship
from fluxsieve.sources.codec import decode_packet, encode_packet
from fluxsieve.streaming.wire import Client, MeasurementSource, PacketServer, Released, _rows

T0 = 638_396_640_000_000_000


def until(done, seconds=60):
    for _ in range(seconds * 5):
        if done():
            return
        time.sleep(0.2)


def test_publish_and_subscribe_over_tcp(spark, tmp_path):
    ship(spark)
    spark.dataSource.register(MeasurementSource)
    rows = [(i % 5, float(i), T0 + i, 0) for i in range(250)]
    df = spark.createDataFrame(rows, "signal_index long, value double, ticks long, flags long")
    with PacketServer() as server:
        host, port = server.address
        server.publish(df, 20)
        read = spark.read.format("measurements").option("host", host).option("port", port).option("packets", 4)
        assert sorted(tuple(r) for r in read.load().collect()) == sorted(rows)
        assert sorted(tuple(r) for r in read.option("signals", "2,4").load().collect()) == sorted(r for r in rows if r[0] in (2, 4))
        seen = []
        stream = spark.readStream.format("measurements").option("host", host).option("port", port).option("packets", 5).load()
        q = stream.writeStream.foreachBatch(lambda b, _: seen.extend(tuple(r) for r in b.collect())).option("checkpointLocation", str(tmp_path)).start()
        try:
            until(lambda: len(seen) >= 250)
            server.publish(df.limit(3), 20)
            until(lambda: len(seen) >= 253 and server.first > 0)
        finally:
            q.stop()
        assert len(seen) == 253 and sorted(seen[:250]) == sorted(rows)
        assert server.first > 0


def test_consumers_release_for_themselves():
    packets = [encode_packet([(i, float(i), T0, 0)]) for i in range(4)]
    with PacketServer() as server:
        for p in packets:
            server.append(p)
        a = Client(*server.address)
        assert a.ask("SUBSCRIBE one", ">Q") == 0 and a.ask("SUBSCRIBE two 1,3", ">Q") == 0
        a.ask("RELEASE one 2", ">Q")
        assert list(a.packets("two", 0, 9)) == [packets[0][:0] + struct.pack(">I", 0), packets[1], struct.pack(">I", 0), packets[3]]
        a.ask("RELEASE two 2", ">Q")
        assert server.first == 2 and a.ask("SUBSCRIBE late", ">Q") == 2
        with pytest.raises(Released):
            list(a.packets("two", 1, 1))
        assert [decode_packet(p)[0][0] for p in a.packets("late", 2, 9)] == [2, 3]
        a.file.write(b"STATS\n")
        a.file.flush()
        sent = a.take(">QQQ")
        assert sent == (6, sum(map(len, packets[1:2] + packets[3:])) + 2 * 4 + sum(map(len, packets[2:])), 4)
        a.close()


def test_a_read_goes_on_after_the_connection_broke():
    packets = [encode_packet([(i, float(i), T0, 0)]) for i in range(6)]
    calls = []

    class Flaky(socketserver.StreamRequestHandler):
        """Sends two packets and half of one, then hangs up."""

        def handle(self):
            _, _, start, count = self.rfile.readline().decode().split()
            calls.append(int(start))
            some = packets[int(start) : int(start) + int(count)]
            data = [struct.pack(">I", len(p)) + p for p in some]
            self.wfile.write(struct.pack(">I", len(some)) + b"".join(data[:2]) + (data[2][:7] if len(data) > 2 else b""))

    with socketserver.ThreadingTCPServer(("127.0.0.1", 0), Flaky) as server:
        server.daemon_threads = True
        threading.Thread(target=server.serve_forever, daemon=True).start()
        host, port = server.server_address
        got = list(_rows({"host": host, "port": port}, "x", 0, 6, pause=0.01))
        server.shutdown()
    assert [r[0] for r in got] == list(range(6)) and calls == [0, 2, 4]
