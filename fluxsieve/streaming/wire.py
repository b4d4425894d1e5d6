"""Measurements over TCP: a packet server for publishing, and a Python data source for subscribing.

The server keeps compact packets as numbered files of a folder, so that the driver's memory doesn't grow, and answers a line of text:

    SUBSCRIBE name [signal,...]   the consumer's first packet; only these signals are sent to it
    FILTER name [signal,...]      the same for a batch, which holds no packets back
    END                           the number after the last packet
    READ name start count         the packets, or an error where one of them is gone
    RELEASE name before           this consumer is done with the packets before
    STATS                         packets, bytes and measurements sent

A packet goes once every consumer has released it; a consumer that subscribes later starts at the first one kept. The
source's offsets are packet numbers, so that a micro-batch can be read again after a failure, by any executor; packets are released once
Spark has committed them. A connection that fails, at first or within a read, is tried again with growing pauses, and the read
goes on after the last whole packet.
"""

from __future__ import annotations

import os
import shutil
import socket
import socketserver
import struct
import tempfile
import threading
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from ..sources.codec import decode_packet, encode_packets, only_signals

SCHEMA = "signal_index long, value double, ticks long, flags long"
#: In place of a number of packets: one of them was released.
GONE = 0xFFFFFFFF


class PacketServer:
    """Use as a context; `address` is (host, port)."""

    def __init__(self, host: str = "127.0.0.1", port: int = 0, folder: str | None = None):
        self.folder = folder or tempfile.mkdtemp(prefix="fluxsieve-packets-")
        self.own = folder is None
        self.first = self.end = 0
        self.released: dict[str, int] = {}
        self.wanted: dict[str, frozenset[int] | None] = {}
        self.sent = {"packets": 0, "bytes": 0, "measurements": 0}
        self.lock = threading.Lock()
        outer = self

        class Handler(socketserver.StreamRequestHandler):
            def handle(self) -> None:
                for line in self.rfile:
                    outer._answer(line.decode().split(), self.wfile)

        class Server(socketserver.ThreadingTCPServer):
            allow_reuse_address = daemon_threads = True

        self.server = Server((host, port), Handler)
        self.address = self.server.server_address
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def __enter__(self) -> PacketServer:
        return self

    def __exit__(self, *_: object) -> None:
        self.server.shutdown()
        self.server.server_close()
        if self.own:
            shutil.rmtree(self.folder, ignore_errors=True)

    def _file(self, n: int) -> str:
        return os.path.join(self.folder, f"{n:020d}")

    def append(self, packet: bytes) -> None:
        with self.lock:
            with open(self._file(self.end), "wb") as f:
                f.write(packet)
            self.end += 1

    def _release(self) -> None:
        least = min(self.released.values(), default=self.first)
        while self.first < least:
            os.remove(self._file(self.first))
            self.first += 1

    def _answer(self, command: list[str], out: object) -> None:
        verb, *rest = command or [""]
        with self.lock:
            if verb in ("SUBSCRIBE", "FILTER"):
                self.wanted[rest[0]] = frozenset(map(int, rest[1].split(","))) if len(rest) > 1 else None
                reply = struct.pack(">Q", self.released.setdefault(rest[0], self.first) if verb == "SUBSCRIBE" else self.first)
            elif verb == "END":
                reply = struct.pack(">Q", self.end)
            elif verb == "RELEASE":
                self.released[rest[0]] = max(self.released.get(rest[0], self.first), min(int(rest[1]), self.end))
                self._release()
                reply = struct.pack(">Q", self.first)
            elif verb == "STATS":
                reply = struct.pack(">QQQ", *self.sent.values())
            elif verb == "READ":
                reply = None
            else:
                reply = struct.pack(">Q", 0)
        if reply is None:
            self._send(rest[0], int(rest[1]), int(rest[2]), out)
        else:
            out.write(reply)
        out.flush()

    def _send(self, name: str, start: int, count: int, out: object) -> None:
        with self.lock:
            stop = min(start + count, self.end)
            gone = start < self.first
            wanted = self.wanted.get(name)
        if gone:
            out.write(struct.pack(">I", GONE))
            return
        out.write(struct.pack(">I", max(0, stop - start)))
        for n in range(start, stop):
            with open(self._file(n), "rb") as f:
                packet = f.read()
            packet = packet if wanted is None else only_signals(packet, wanted)
            out.write(struct.pack(">I", len(packet)) + packet)
            with self.lock:
                self.sent["packets"] += 1
                self.sent["bytes"] += len(packet)
                self.sent["measurements"] += struct.unpack_from(">I", packet)[0]

    def publish(self, df: DataFrame, size: int = 1000, checkpoint: str | None = None) -> StreamingQuery | None:
        """Executors encode, the driver holds one partition's packets at a time. A stream runs until its input is used up."""

        def send(batch: DataFrame) -> None:
            for row in encode_packets(batch, size).toLocalIterator():
                self.append(bytes(row["packet"]))

        if not df.isStreaming:
            send(df)
            return None
        return df.writeStream.foreachBatch(lambda b, _: send(b)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Released(ValueError):
    """A packet that is asked for was released."""


class Client:
    def __init__(self, host: str, port: int, tries: int = 5, pause: float = 0.2, longest: float = 5.0):
        for n in range(tries):
            try:
                self.socket = socket.create_connection((host, port), timeout=30)
                break
            except OSError:
                if n == tries - 1:
                    raise
                time.sleep(min(longest, pause * 2**n))
        self.file = self.socket.makefile("rwb")

    def ask(self, text: str, form: str) -> int:
        self.file.write(text.encode() + b"\n")
        self.file.flush()
        return self.take(form)[0]

    def take(self, form: str) -> tuple:
        return struct.unpack(form, self._whole(struct.calcsize(form)))

    def _whole(self, n: int) -> bytes:
        data = self.file.read(n)
        if len(data) < n:
            raise ConnectionError("the connection ended within a packet")
        return data

    def packets(self, name: str, start: int, count: int) -> Iterator[bytes]:
        n = self.ask(f"READ {name} {start} {count}", ">I")
        if n == GONE:
            raise Released(f"packets from {start} on were released")
        for _ in range(n):
            yield self._whole(self.take(">I")[0])

    def close(self) -> None:
        self.file.close()
        self.socket.close()


def _asked(options: dict, text: str) -> int:
    client = Client(options["host"], int(options["port"]))
    try:
        return client.ask(text, ">Q")
    finally:
        client.close()


def _rows(options: dict, name: str, start: int, end: int, tries: int = 5, pause: float = 0.2, longest: float = 5.0) -> Iterator[tuple]:
    """The measurements of the packets from start to end; a broken connection is opened anew, and any packet that comes whole
    sets the tries back."""
    failed = 0
    while start < end:
        client = None
        try:
            client = Client(options["host"], int(options["port"]))
            for p in client.packets(name, start, end - start):
                yield from decode_packet(p)
                start, failed = start + 1, 0
            return
        except OSError:
            failed += 1
            if failed == tries:
                raise
            time.sleep(min(longest, pause * 2 ** (failed - 1)))
        finally:
            if client:
                client.close()


def _subscribed(options: dict, name: str, verb: str = "SUBSCRIBE") -> int:
    return _asked(options, f"{verb} {name} {options.get('signals', '')}")


class MeasurementSource(DataSource):
    """spark.read / readStream.format("measurements") after registering the class. Options: host, port; signals, runtime
    indexes with commas between, which the server filters by; consumer, a name that is kept over restarts of a stream; packets, how many a partition has."""

    @classmethod
    def name(cls) -> str:
        return "measurements"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> DataSourceReader:
        return MeasurementReader(dict(self.options))

    def streamReader(self, schema: object) -> DataSourceStreamReader:  # noqa: N802
        return MeasurementStream(dict(self.options))


class MeasurementReader(DataSourceReader):
    """All packets that the server holds, a partition for each `packets` of them."""

    def __init__(self, options: dict):
        self.options, self.consumer = options, options.get("consumer", f"batch-{uuid.uuid4().hex}")

    def partitions(self) -> list[InputPartition]:
        first = _subscribed(self.options, self.consumer, "FILTER")
        step, end = int(self.options.get("packets", 1000)), _asked(self.options, "END")
        return [InputPartition((a, min(end, a + step))) for a in range(first, end, step)] or [InputPartition((0, 0))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from _rows(self.options, self.consumer, *partition.value)


class MeasurementStream(DataSourceStreamReader):
    """Offsets are packet numbers; executors read a micro-batch in partitions of `packets` packets."""

    def __init__(self, options: dict):
        self.options, self.consumer = options, options.get("consumer", f"stream-{uuid.uuid4().hex}")

    def initialOffset(self) -> dict:  # noqa: N802
        return {"packet": _subscribed(self.options, self.consumer)}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"packet": _asked(self.options, "END")}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        step = int(self.options.get("packets", 1000))
        return [InputPartition((a, min(end["packet"], a + step))) for a in range(start["packet"], end["packet"], step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from _rows(self.options, self.consumer, *partition.value)

    def commit(self, end: dict) -> None:
        _asked(self.options, f"RELEASE {self.consumer} {end['packet']}")
