"""Audio columns: bytes kept as 8-bit sound, and features of the sound that is read back.

A payload is stored losslessly as a mono WAV of unsigned 8-bit samples. Features: polyphase resampling by
UP / DOWN, overlapped log-mel filterbanks, and segments of raised energy with hysteresis. The filterbank
values are cut into patches of one fixed shape, held as an Arrow fixed-shape tensor array, each patch with its
span of time. Values are rounded to eighths, in double precision, so that equal payloads give equal features. The
feature string is worked out from the tensors and spans as they are read back.

Scale: one pass, no shuffle; a sound is resampled and analysed in blocks of BLOCK frames, so that beyond the payload, its
stored form and its patches (about one byte of patches a byte) memory doesn't grow with it. Defined results: a null or empty text is 64 zero bytes; an empty table gives no rows; rows
are independent of each other, so that repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

RATE, UP, DOWN = 10000, 4, 5
TAPS = 24
FRAME, HOP, NFFT, MELS = 200, 80, 256, 20
PATCH = 16
BLOCK = 1024
STEP = 8

OUT = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, n_patches int, segments array<struct<start_ms:int,end_ms:int>>, tensors binary, media binary"
DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def padded(data: bytes, unit: int = 64) -> bytes:
    return data + bytes(max(unit, -(-len(data) // unit) * unit) - len(data))


def write_wav(payload: bytes, rate: int = RATE) -> bytes:
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload))
    return head + payload


def read_wav(media: bytes) -> tuple[int, bytes]:
    """The rate and the samples of the first data chunk."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV")
    at, rate = 12, 0
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"fmt ":
            rate = struct.unpack_from("<I", media, at + 12)[0]
        elif name == b"data":
            return rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def _phases(up: int, down: int, taps: int) -> np.ndarray:
    """Polyphase branches (up, taps) of a Hamming-windowed low-pass sinc."""
    n = up * taps
    t = (np.arange(n) - (n - 1) / 2) / max(up, down)
    h = np.sinc(t) * np.hamming(n)
    h *= up / h.sum()
    return h.reshape(taps, up).T[:, ::-1].copy()


_BRANCHES = _phases(UP, DOWN, TAPS)


def resampled(x: np.ndarray, a: int, b: int, up: int = UP, down: int = DOWN, branches: np.ndarray = _BRANCHES) -> np.ndarray:
    """Samples a to b of x at up / down times its rate; x is silent outside. Output m uses branch (m * down) % up at
    input (m * down) // up: one strided product a branch."""
    taps = branches.shape[1]
    lo, hi = a * down // up - taps // 2, (b - 1) * down // up - taps // 2 + taps
    ext = np.zeros(hi - lo + down)
    inside = x[max(lo, 0) : max(hi, 0)]
    ext[max(-lo, 0) : max(-lo, 0) + len(inside)] = inside
    y = np.empty(b - a)
    for r in range(min(up, b - a)):
        m = a + r
        first = m * down // up - taps // 2 - lo
        rows = np.lib.stride_tricks.as_strided(ext[first:], (-(-(b - m) // up), taps), (ext.strides[0] * down, ext.strides[0]))
        y[r::up] = rows @ branches[(m * down) % up]
    return y


def resample(x: np.ndarray, up: int = UP, down: int = DOWN, branches: np.ndarray = _BRANCHES) -> np.ndarray:
    return resampled(x, 0, -(-len(x) * up // down), up, down, branches)


def _filterbank(rate: int, nfft: int, mels: int) -> np.ndarray:
    mel = np.linspace(0, 2595 * np.log10(1 + rate / 2 / 700), mels + 2)
    edge = 700 * (10 ** (mel / 2595) - 1) * nfft / rate
    k = np.arange(nfft // 2 + 1)[:, None]
    up, down = (k - edge[:-2]) / (edge[1:-1] - edge[:-2]), (edge[2:] - k) / (edge[2:] - edge[1:-1])
    return np.maximum(0, np.minimum(up, down))


_MEL = _filterbank(RATE * UP // DOWN, NFFT, MELS)
_WINDOW = np.hanning(FRAME + 2)[1:-1]


def log_mel(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Of 8-bit samples: rounded log-mel values (frames, MELS) as int16 eighths, and the log energy of each frame."""
    x = np.frombuffer(data, np.uint8)
    size = -(-len(x) * UP // DOWN)
    n = 1 + max(0, -(-(size - FRAME) // HOP))
    mel, energy = np.empty((n, MELS), np.int16), np.empty(n)
    reach = -(-FRAME * DOWN // UP) + 2 * TAPS
    for a in range(0, n, BLOCK):
        b = min(n, a + BLOCK)
        first, last = a * HOP, min(size, (b - 1) * HOP + FRAME)
        # what the filter reaches, moved by whole cycles of its branches
        cycle = max(0, (first * DOWN // UP - reach) // DOWN)
        part = (x[cycle * DOWN : last * DOWN // UP + reach].astype(float) - 128) / 128
        y = np.zeros((b - 1 - a) * HOP + FRAME)
        y[: last - first] = resampled(part, first - cycle * UP, last - cycle * UP)
        frames = np.lib.stride_tricks.as_strided(y, (b - a, FRAME), (y.strides[0] * HOP, y.strides[0]))
        power = np.abs(np.fft.rfft(frames * _WINDOW, NFFT, axis=1)) ** 2
        mel[a:b] = np.rint(np.log(power @ _MEL + 1e-6) * STEP)
        energy[a:b] = np.log((frames * frames).mean(axis=1) + 1e-6)
    return mel, np.rint(energy * 64) / 64


def segments(energy: np.ndarray) -> np.ndarray:
    """(count, 2) frames [start, end): runs above the mean that anywhere rise half a deviation over it."""
    low = energy.mean()
    high = low + 0.5 * energy.std()
    on = np.concatenate([[False], energy >= low, [False]])
    edges = np.flatnonzero(on[1:] != on[:-1]).reshape(-1, 2)
    if not len(edges):
        return edges
    peak = np.maximum.reduceat(energy, edges[:, 0])
    # reduceat runs on to the next start; frames between runs lie below the mean and never decide
    return edges[peak >= high]


def patches(mel: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Patches (count, PATCH, MELS) in float32 and their spans in milliseconds (count, 2)."""
    count = -(-len(mel) // PATCH)
    out = np.full((count * PATCH, MELS), np.log(1e-6), np.float32)
    out[: len(mel)] = mel / np.float32(STEP)
    ms = 1000 * DOWN / (RATE * UP)
    start = np.arange(count) * PATCH * HOP * ms
    end = np.minimum(start + PATCH * HOP * ms, (len(mel) - 1) * HOP * ms + FRAME * ms)
    return out.reshape(count, PATCH, MELS), np.rint(np.stack([start, end], axis=1)).astype(np.int32)


def tensor_batch(values: np.ndarray, spans: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.FixedShapeTensorArray.from_numpy_ndarray(values), pa.array(spans[:, 0], pa.int32()), pa.array(spans[:, 1], pa.int32())],
        ["patch", "start_ms", "end_ms"],
    )


def to_ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_ipc(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The patches and their spans."""
    batch = pa.ipc.open_stream(data).read_next_batch()
    return batch["patch"].to_numpy_ndarray(), np.stack([batch["start_ms"].to_numpy(), batch["end_ms"].to_numpy()], axis=1)


def analyse(text: str | None) -> dict:
    """Everything about one text. The features come from the stored bytes, read back."""
    data = (text or "").encode()
    payload = padded(data)
    media = write_wav(payload)
    rate, back = read_wav(media)
    mel, energy = log_mel(back)
    ms = 1000 * DOWN * HOP // (rate * UP)
    values, spans = patches(mel)
    return {
        "n_bytes": len(data), "payload_bytes": len(back), "payload_sha256": hashlib.sha256(back).hexdigest(), "tail_crc32": zlib.crc32(back[-64:]),
        "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest(), "media": media, "frames": len(mel), "n_patches": len(values), "tensors": to_ipc(tensor_batch(values, spans)), "segments": segments(energy) * ms,
    }


def feature(one: dict) -> str:
    """Of the tensors and spans, read back: frames x mels, shape of the patches, mean level, where the last span ends, segments, and a
    digest of all values and spans."""
    values, spans = from_ipc(one["tensors"])
    mel = np.rint(values.reshape(-1, MELS)[: one["frames"]] * STEP).astype(np.int16)
    seg = one["segments"]
    long_ = int((seg[:, 1] - seg[:, 0]).max()) if len(seg) else 0
    sha = hashlib.sha256(np.ascontiguousarray(values).tobytes() + spans.astype("<i4").tobytes() + seg.astype("<i8").tobytes()).hexdigest()[:32]
    return f"{len(mel)}x{MELS};patches={'x'.join(map(str, values.shape))};mean={int(mel.astype(np.int64).sum()) // mel.size};end_ms={int(spans[-1, 1])};segments={len(seg)};longest_ms={long_};sha={sha}"


def audio(docs: DataFrame, digest: bool = False, rows: int = 64) -> DataFrame:
    """docs(doc_id, text, ...) -> OUT, with the media and the tensors, or DIGEST."""
    schema = DIGEST if digest else OUT
    names = [x.split()[0] for x in schema.replace("array<struct<start_ms:int,end_ms:int>>", "array").split(", ")]

    def one(doc_id: int, text: str | None) -> dict:
        out = analyse(text) | {"doc_id": doc_id}
        if digest:
            return out | {"feature": feature(out)}
        return out | {"segments": [{"start_ms": int(a), "end_ms": int(b)} for a, b in out["segments"]]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = _arrow(digest)
        for batch in batches:
            for a in range(0, batch.num_rows, rows * (64 if digest else 1)):
                part = batch.slice(a, rows * (64 if digest else 1))
                made = [one(d.as_py(), t.as_py()) for d, t in zip(part["doc_id"], part["text"])]
                yield pa.RecordBatch.from_pylist([{k: m[k] for k in names} for m in made], schema=types)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _arrow(digest: bool) -> pa.Schema:
    first = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string())]
    if digest:
        return pa.schema([*first, ("feature", pa.string())])
    return pa.schema([*first, ("n_patches", pa.int32()), ("segments", pa.list_(pa.struct([("start_ms", pa.int32()), ("end_ms", pa.int32())]))), ("tensors", pa.binary()), ("media", pa.binary())])
