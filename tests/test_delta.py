import random
import struct

from hypothesis import given, settings
from hypothesis import strategies as st

from fluxsieve.session import ship
from fluxsieve.sources.delta import Decoder, Encoder, decode_connections, encode_connections


def f32(x):
    return struct.unpack("<f", struct.pack("<f", x))[0]


@settings(max_examples=60, deadline=None)
@given(seed=st.integers(0, 10**6), n=st.integers(0, 400), per=st.integers(1, 90))
def test_blocks_round_trip(seed, n, per):
    r = random.Random(seed)
    t, rows = 638_396_640_000_000_000, []
    for k in range(n):
        t += r.choice((0, 0, 333_333, 333_334, 10_000_000, -333_333, r.randint(-(10**12), 10**12)))
        rows.append((r.choice((k % 7, r.randint(0, 2 ** r.randint(1, 30)))), f32(r.choice((0.0, 60.0, 59.99, r.random() * 10 ** r.randint(-20, 20)))), t, r.choice((0, 0, 0x1000, r.randint(0, 2**32 - 1)))))
    e, d, got = Encoder(), Decoder(), []
    for a in range(0, n, per):
        for x in rows[a : a + per]:
            e.add(*x)
        got += list(d.block(e.block()))
    assert got == rows


def test_regular_data_is_small():
    e = Encoder()
    for k in range(3000):
        e.add(k % 3, 60.0 if k % 3 else 59.5, 638_396_640_000_000_000 + k // 3 * 333_333, 0)
    assert len(e.block()) < 3000


def test_connections(spark):
    ship(spark)
    rows = [(f"c{i % 3}", i, i % 5, float(i % 11), 638_396_640_000_000_000 + i * 333_333, 0) for i in range(500)]
    df = spark.createDataFrame(rows, "connection string, position long, signal_index long, value double, ticks long, flags long")
    packets = encode_connections(df, 40)
    assert packets.count() == 15
    got = decode_connections(packets.unionAll(packets))
    key = lambda r: (r.connection, r.signal_index, r.value, r.ticks, r.flags)
    assert sorted(map(key, got.collect())) == sorted(map(key, df.collect()))


def test_golden_bytes():
    """One measurement from a fresh state, spelled out by the format: point XOR of 4 bits (1, then 1), time XOR (17, varint 5), value
    XOR of 32 bits (31, then 1.0), end (0). Code words of 8 bits and odd bits share reserved bytes."""
    e = Encoder()
    e.add(1, 1.0, 5, 0)
    block = e.block()
    assert block == bytes.fromhex("01 11 11 05 f0 00 00 80 3f 00")
    assert list(Decoder().block(block)) == [(1, 1.0, 5, 0)]
