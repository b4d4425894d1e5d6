"""Binary codecs: compact measurement packets, seven-bit integers and the signal index cache.

A packet is a big-endian count and records of flags (u8), runtime index (u32), value (f32) and a time of 0, 2, 4 or 8
bytes, by the flags: no time, milliseconds or ticks after one of two base times, or whole ticks. Packets are independent rows,
so that decoding is a narrow map over Arrow batches.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..streaming.measurements import BASE_TIME_OFFSET, COMPACT_FLAGS, TIME_INDEX

_HEAD = struct.Struct(">BIf")
_MASKS = [(bit, mask) for _, bit, mask in COMPACT_FLAGS]


def compact_flags(state: int) -> int:
    return sum(bit for bit, mask in _MASKS if state & mask)


def state_flags(compact: int) -> int:
    out = 0
    for bit, mask in _MASKS:
        if compact & bit:
            out |= mask
    return out


def encode_packet(rows: Iterable[tuple[int, float, int, int]], bases: tuple[int, int] = (0, 0), index: int = 0, milliseconds: bool = False, with_time: bool = True) -> bytes:
    """rows of (runtime index, value, ticks, state flags) as one packet."""
    out = []
    base = bases[index]
    for i, value, ticks, flags in rows:
        compact = compact_flags(flags)
        time = b""
        if with_time:
            delta = ticks - base
            if base > 0 and 0 <= delta // 10_000 < 1 << 16 and milliseconds:
                time = struct.pack(">H", delta // 10_000)
            elif base > 0 and 0 <= delta < 1 << 32 and not milliseconds:
                time = struct.pack(">I", delta)
            else:
                time = struct.pack(">Q", ticks)
            if len(time) < 8:
                compact |= BASE_TIME_OFFSET | (TIME_INDEX if index else 0)
        out.append(_HEAD.pack(compact, i, value) + time)
    return struct.pack(">I", len(out)) + b"".join(out)


def decode_packet(data: bytes, bases: tuple[int, int] = (0, 0), milliseconds: bool = False, with_time: bool = True) -> list[tuple[int, float, int, int]]:
    """The rows of a packet, as encode_packet takes them; a time that is not carried is 0."""
    (count,), at, out = struct.unpack_from(">I", data), 4, []
    if not with_time and len(data) >= 4 + 9 * count:
        # records of one size: all at once
        a = np.frombuffer(data, np.dtype([("f", "u1"), ("i", ">u4"), ("v", ">f4")]), count, 4)
        return [(int(i), float(v), 0, state_flags(int(f))) for f, i, v in a]
    if with_time and len(data) == 4 + 17 * count:
        a = np.frombuffer(data, np.dtype([("f", "u1"), ("i", ">u4"), ("v", ">f4"), ("t", ">u8")]), count, 4)
        if not (a["f"] & BASE_TIME_OFFSET).any():  # whole times throughout
            known = {int(f): state_flags(int(f)) for f in np.unique(a["f"])}
            return [(i, v, t, known[f]) for f, i, v, t in zip(a["f"].tolist(), a["i"].tolist(), a["v"].tolist(), a["t"].tolist())]
    for _ in range(count):
        compact, i, value = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        ticks = 0
        if with_time:
            if compact & BASE_TIME_OFFSET:
                base = bases[1 if compact & TIME_INDEX else 0]
                kind, unit = (">H", 10_000) if milliseconds else (">I", 1)
                ticks = base + struct.unpack_from(kind, data, at)[0] * unit
                at += struct.calcsize(kind)
            else:
                ticks = struct.unpack_from(">Q", data, at)[0]
                at += 8
        out.append((i, value, ticks, state_flags(compact)))
    return out


def only_signals(data: bytes, wanted: frozenset[int], milliseconds: bool = False, with_time: bool = True) -> bytes:
    """The packet with the records of these runtime indexes only, as they are."""
    (count,), at, out = struct.unpack_from(">I", data), 4, []
    for _ in range(count):
        compact, i = struct.unpack_from(">BI", data, at)
        size = _HEAD.size + (0 if not with_time else 8 if not compact & BASE_TIME_OFFSET else 2 if milliseconds else 4)
        if i in wanted:
            out.append(data[at : at + size])
        at += size
    return struct.pack(">I", len(out)) + b"".join(out)


MEASUREMENTS = "packet_id long, signal_index long, value double, ticks long, flags long"


def decode_packets(df: DataFrame, bases: tuple[int, int] = (0, 0), milliseconds: bool = False, with_time: bool = True) -> DataFrame:
    """df(packet_id, packet) -> MEASUREMENTS, in the order of records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for key, packet in zip(batch["packet_id"].to_pylist(), batch["packet"].to_pylist()):
                for row in decode_packet(packet, bases, milliseconds, with_time) if packet else ():
                    for c, x in zip(cols, (key, *row)):
                        c.append(x)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["packet_id", "signal_index", "value", "ticks", "flags"])

    return df.select("packet_id", "packet").mapInArrow(run, MEASUREMENTS)


def encode_packets(df: DataFrame, size: int = 1000, bases: tuple[int, int] = (0, 0), milliseconds: bool = False) -> DataFrame:
    """df(signal_index, value, ticks, flags) -> (n, packet): up to `size` records a packet, in the order of a partition's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*[batch[c].to_pylist() for c in ("signal_index", "value", "ticks", "flags")]))
            parts = [rows[a : a + size] for a in range(0, len(rows), size)]
            yield pa.RecordBatch.from_arrays([pa.array([len(p) for p in parts], pa.int32()), pa.array([encode_packet(p, bases, 0, milliseconds) for p in parts], pa.binary())], ["n", "packet"])

    return df.select("signal_index", "value", "ticks", "flags").mapInArrow(run, "n int, packet binary")


def write_7bit(value: int, bits: int = 64) -> bytes:
    """Seven bits a byte, least first, the high bit saying that more follow; negatives as two's complement. The last byte of
    a full width carries what is left whole, so that no more than (bits + 6) // 7 bytes, 9 for 64 bits, are needed."""
    value &= (1 << bits) - 1
    most, out = {16: 3, 32: 5, 64: 9}[bits], bytearray()
    while value > 0x7F and len(out) < most - 1:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value & 0xFF)
    return bytes(out)


def read_7bit(data: bytes, at: int = 0, bits: int = 64, signed: bool = False) -> tuple[int, int]:
    """The value, and the place after it."""
    most, value, n = {16: 3, 32: 5, 64: 9}[bits], 0, 0
    while True:
        b = data[at + n]
        if n == most - 1 or b < 0x80:
            value |= b << 7 * n
            break
        value |= (b & 0x7F) << 7 * n
        n += 1
    value &= (1 << bits) - 1
    return (value - (1 << bits) if signed and value >> (bits - 1) else value), at + n + 1


def encode_index_cache(subscriber: uuid.UUID, signals: list[tuple[int, uuid.UUID, str, int]], unauthorized: Iterable[uuid.UUID] = ()) -> bytes:
    """signals: (index, id, source, number). Total size, subscriber id, then counted records."""
    body = subscriber.bytes + struct.pack(">I", len(signals))
    for index, signal, source, number in signals:
        name = source.encode()
        body += struct.pack(">i", index) + signal.bytes + struct.pack(">I", len(name)) + name + struct.pack(">Q", number)
    missing = list(unauthorized)
    body += struct.pack(">I", len(missing)) + b"".join(x.bytes for x in missing)
    return struct.pack(">I", len(body) + 4) + body


def decode_index_cache(data: bytes) -> tuple[uuid.UUID, list[tuple[int, uuid.UUID, str, int]], list[uuid.UUID]]:
    if struct.unpack_from(">I", data)[0] > len(data):
        raise ValueError("the cache is cut short")
    subscriber, at, signals = uuid.UUID(bytes=data[4:20]), 24, []
    for _ in range(struct.unpack_from(">I", data, 20)[0]):
        index, signal = struct.unpack_from(">i", data, at)[0], uuid.UUID(bytes=data[at + 4 : at + 20])
        size = struct.unpack_from(">I", data, at + 20)[0]
        at += 24
        signals.append((index, signal, data[at : at + size].decode(), struct.unpack_from(">Q", data, at + size)[0]))
        at += size + 8
    count = struct.unpack_from(">I", data, at)[0]
    return subscriber, signals, [uuid.UUID(bytes=data[at + 4 + 16 * i : at + 20 + 16 * i]) for i in range(count)]
