"""Stateful delta codec: measurements as code words, XOR differences and repeated values.

A block mixes two streams in one buffer: whole bytes, and single bits that are packed into bytes reserved where the first of
their bits is written. Each measurement names what changed since the one before: the point (XOR with the point that last
followed), the time (one of the four least deltas, or a varint XOR), the flags, and always the value (one of the point's last three,
zero, or an XOR of 4 to 32 bits). How a code word is spelled adapts: every point counts the codes that follow it, and
gives its most frequent ones prefixes of one to three bits.

State runs through all blocks of a connection, so blocks of one connection are decoded in order of their sequence, and
connections in parallel.
"""

from __future__ import annotations

import bisect
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .codec import read_7bit, write_7bit

#: Code words.
END = 0
POINT_XOR = {4: 1, 8: 2, 12: 3, 16: 4, 20: 5, 24: 6, 32: 7}
TIME_FORWARD, TIME_REVERSE, TIME_SECOND, TIME_XOR = (8, 9, 10, 11), (12, 13, 14, 15), 16, 17
FLAGS_SECOND, FLAGS_VARINT = 18, 19
VALUE_SAME, VALUE_ZERO = (20, 21, 22), 23
VALUE_XOR = {4: 24, 8: 25, 12: 26, 16: 27, 20: 28, 24: 29, 28: 30, 32: 31}
#: Codes seen before the prefixes adapt for the first time, the second, and ever after.
ADAPT_AFTER = (5, 20, 100)
#: Bits of a plain code word by the number of prefixes, and the version of a packet.
PLAIN = (5, 6, 7, 8)
VERSION = 85
_NEVER = (1 << 63) - 1
_WIDTH_OF = {code: width for table in (POINT_XOR, VALUE_XOR) for width, code in table.items()}


class Point:
    """What is remembered of one point."""

    def __init__(self, follows: int = 0):
        self.follows = follows
        self.flags = [0, 0]
        self.values = [0, 0, 0]
        self.short = list(VALUE_SAME)
        self.counts = [0] * 32
        self.seen = self.adapted = 0

    def count(self, code: int) -> None:
        """Prefixes change once enough codes were seen: as many as make these codes shortest, fewest if several do."""
        self.counts[code] += 1
        self.seen += 1
        if self.seen > ADAPT_AFTER[self.adapted]:
            ranked = sorted(range(32), key=lambda c: (-self.counts[c], c))[:3]
            sizes = []
            for n, plain in enumerate(PLAIN):
                few = sum(self.counts[c] for c in ranked[:n])
                sizes.append(sum(self.counts[c] * (i + 1) for i, c in enumerate(ranked[:n])) + (self.seen - few) * plain)
            self.short = ranked[: sizes.index(min(sizes))]
            self.counts = [0] * 32
            self.seen, self.adapted = 0, min(self.adapted + 1, 2)


class State:
    """What both ends of a connection know."""

    def __init__(self) -> None:
        self.points: dict[int, Point] = {}
        self.last = Point()
        self.time = [0, 0]
        self.deltas = [_NEVER] * 4

    def point(self, i: int) -> Point:
        return self.points.setdefault(i, Point(i + 1))

    def advance(self, ticks: int) -> None:
        delta = abs(self.time[0] - ticks)
        if delta < self.deltas[3] and delta not in self.deltas:
            bisect.insort(self.deltas, delta)
            self.deltas.pop()
        self.time = [ticks, self.time[0]]


def _remember(history: list[int], value: int, depth: int) -> None:
    """The value comes first; what stood before it up to its old place moves on by one."""
    history[1 : depth + 1] = history[:depth]
    history[0] = value


class Encoder:
    def __init__(self) -> None:
        self.state = State()
        self.out, self.slot, self.bits, self.count = bytearray(), -1, 0, 0

    def put(self, value: int, width: int) -> None:
        if self.slot < 0:
            self.slot = len(self.out)
            self.out.append(0)
        self.bits, self.count = self.bits << width | value, self.count + width
        while self.count > 7:
            self.count -= 8
            self.out[self.slot] = self.bits >> self.count & 0xFF
            self.bits &= (1 << self.count) - 1
            self.slot = -1
            if self.count:
                self.slot = len(self.out)
                self.out.append(0)

    def code(self, code: int) -> None:
        p = self.state.last
        if code in p.short:
            self.put(1, p.short.index(code) + 1)
        else:
            self.put(code, PLAIN[len(p.short)])
        p.count(code)

    def difference(self, table: dict[int, int], x: int) -> None:
        width = next(w for w in table if x < 1 << w)
        self.code(table[width])
        if width % 8:
            self.put(x & 15, 4)
            x >>= 4
        self.out += x.to_bytes(width // 8, "little")

    def add(self, i: int, value: float, ticks: int, flags: int) -> None:
        s = self.state
        p = s.point(i)
        if s.last.follows != i:
            self.difference(POINT_XOR, i ^ s.last.follows)
            s.last.follows = i
        if ticks != s.time[0]:
            self.move(ticks)
        if flags != p.flags[0]:
            self.code(FLAGS_SECOND if flags == p.flags[1] else FLAGS_VARINT)
            if flags != p.flags[1]:
                self.out += write_7bit(flags, 32)
            p.flags = [flags, p.flags[0]]
        raw = struct.unpack("<I", struct.pack("<f", value))[0]
        if raw in p.values:
            at = p.values.index(raw)
            self.code(VALUE_SAME[at])
            _remember(p.values, raw, at)
        else:
            if raw:
                self.difference(VALUE_XOR, raw ^ p.values[0])
            else:
                self.code(VALUE_ZERO)
            _remember(p.values, raw, 2)
        s.last = p

    def move(self, ticks: int) -> None:
        s = self.state
        delta = ticks - s.time[0]
        if ticks == s.time[1]:
            self.code(TIME_SECOND)
        elif abs(delta) in s.deltas:
            self.code((TIME_FORWARD if delta > 0 else TIME_REVERSE)[s.deltas.index(abs(delta))])
        else:
            self.code(TIME_XOR)
            self.out += write_7bit(ticks ^ s.time[0], 64)
        s.advance(ticks)

    def block(self) -> bytes:
        """What was added since the last block; open bits are closed with the end code."""
        if self.count:
            self.code(END)
            if self.count:
                self.out[self.slot] = self.bits << 8 - self.count & 0xFF
        out = bytes(self.out)
        self.out, self.slot, self.bits, self.count = bytearray(), -1, 0, 0
        return out


class Decoder:
    def __init__(self) -> None:
        self.state = State()

    def block(self, data: bytes) -> Iterator[tuple[int, float, int, int]]:
        """(point, value, ticks, flags) of each measurement."""
        self.data, self.at, self.bits, self.count = data, 0, 0, 0
        s = self.state
        while self.at < len(data) or self.count:
            i, ticks, flags, p = s.last.follows, s.time[0], None, None
            while True:
                code = self.code()
                if code == END:
                    return
                if code in POINT_XOR.values():
                    i = s.last.follows = i ^ self.difference(code)
                elif code <= TIME_XOR:
                    ticks = self.moved(code)
                elif code in (FLAGS_SECOND, FLAGS_VARINT):
                    p = s.point(i)
                    if code == FLAGS_SECOND:
                        flags = p.flags[1]
                    else:
                        flags, self.at = read_7bit(data, self.at, 32)
                    p.flags = [flags, p.flags[0]]
                else:
                    break
            p = s.point(i)
            if code in VALUE_SAME:
                at = VALUE_SAME.index(code)
                raw = p.values[at]
                _remember(p.values, raw, at)
            else:
                raw = 0 if code == VALUE_ZERO else p.values[0] ^ self.difference(code)
                _remember(p.values, raw, 2)
            s.last = p
            yield i, struct.unpack("<f", struct.pack("<I", raw))[0], ticks, p.flags[0]

    def take(self, width: int) -> int:
        while self.count < width:
            self.bits, self.count = self.bits << 8 | self.data[self.at], self.count + 8
            self.at += 1
        self.count -= width
        out = self.bits >> self.count
        self.bits &= (1 << self.count) - 1
        return out

    def code(self) -> int:
        p = self.state.last
        code = next((c for c in p.short if self.take(1)), None)
        if code is None:
            code = self.take(5)
        p.count(code)
        return code

    def difference(self, code: int) -> int:
        width = _WIDTH_OF[code]
        low = self.take(4) if width % 8 else 0
        n = width // 8
        high = int.from_bytes(self.data[self.at : self.at + n], "little")
        self.at += n
        return high << 4 | low if width % 8 else high

    def moved(self, code: int) -> int:
        s = self.state
        if code == TIME_SECOND:
            ticks = s.time[1]
        elif code == TIME_XOR:
            x, self.at = read_7bit(self.data, self.at, 64)
            ticks = s.time[0] ^ x
        else:
            ticks = s.time[0] + s.deltas[code - TIME_FORWARD[0]] if code <= TIME_FORWARD[-1] else s.time[0] - s.deltas[code - TIME_REVERSE[0]]
        s.advance(ticks)
        return ticks


def packet(sequence: int, block: bytes) -> bytes:
    return struct.pack(">BH", VERSION, sequence & 0xFFFF) + block


def decode_connections(df: DataFrame) -> DataFrame:
    """df(connection, sequence long, packet) -> (connection, sequence, signal_index, value, ticks, flags): the packets of a
    connection in order, from its first or a reset (sequence 0 in the packet) on; a packet that repeats is skipped."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        decoder, rows = Decoder(), []
        for r in group.drop_duplicates("sequence").sort_values("sequence").itertuples():
            version, number = struct.unpack_from(">BH", r.packet)
            if version != VERSION:
                raise ValueError(f"packet version {version}")
            if number == 0:
                decoder = Decoder()
            rows += [(r.connection, r.sequence, *m) for m in decoder.block(r.packet[3:])]
        return pd.DataFrame(rows, columns=["connection", "sequence", "signal_index", "value", "ticks", "flags"])

    return df.groupBy("connection").applyInPandas(run, "connection string, sequence long, signal_index long, value double, ticks long, flags long")


def encode_connections(df: DataFrame, size: int = 1000) -> DataFrame:
    """df(connection, position, signal_index, value, ticks, flags) -> (connection, sequence, packet), `size` measurements a packet
    in order of position."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        encoder, out = Encoder(), []
        rows = group.sort_values("position")
        for n, a in enumerate(range(0, len(rows), size)):
            for r in rows.iloc[a : a + size].itertuples():
                encoder.add(int(r.signal_index), float(r.value), int(r.ticks), int(r.flags))
            # the number in a packet wraps past 0, which means a reset
            out.append((group["connection"].iloc[0], n, packet(n if n < 1 else (n - 1) % 65535 + 1, encoder.block())))
        return pd.DataFrame(out, columns=["connection", "sequence", "packet"])

    return df.groupBy("connection").applyInPandas(run, "connection string, sequence long, packet binary")
