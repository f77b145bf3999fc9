"""Headers and samples of WAV, MP4 and MAT files, read from their bytes by Arrow functions."""

from __future__ import annotations

import io
import struct
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wav_header(data: bytes) -> dict | None:
    """rate, channels, bits and frames of a RIFF file; only its first chunks are needed."""
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        return None
    at, form = 12, None
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"fmt " and at + 24 <= len(data):
            form = struct.unpack_from("<HHIIHH", data, at + 8)
        elif name == b"data" and form:
            _, channels, rate, _, block, bits = form
            return {"rate": rate, "channels": channels, "bits": bits, "frames": size // block if block else 0}
        at += 8 + size + size % 2  # chunks are word-aligned
    return None


def _boxes(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Name, start and end of the content of each box between two offsets."""
    while at + 8 <= end:
        size, name = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1 and at + 16 <= end:
            size, head = struct.unpack_from(">Q", data, at + 8)[0], 16
        elif size == 0:
            size = end - at
        if size < head:
            return
        yield name, at + head, min(at + size, end)
        at += size


def _inside(data: bytes, path: list[bytes], at: int, end: int) -> Iterator[tuple[int, int]]:
    for name, a, b in _boxes(data, at, end):
        if name == path[0]:
            if len(path) == 1:
                yield a, b
            else:
                yield from _inside(data, path[1:], a, b)


def _scale_and_duration(data: bytes, a: int) -> tuple[int, int]:
    return struct.unpack_from(">IQ", data, a + 20) if data[a] == 1 else struct.unpack_from(">II", data, a + 12)


def mp4_header(data: bytes) -> dict | None:
    """duration_s of the movie, frames and fps of its first video track."""
    found: dict = {}
    for a, _ in _inside(data, [b"moov", b"mvhd"], 0, len(data)):
        scale, duration = _scale_and_duration(data, a)
        found["duration_s"] = duration / scale if scale else None
    for a, b in _inside(data, [b"moov", b"trak"], 0, len(data)):
        kinds = [data[x + 8 : x + 12] for x, _ in _inside(data, [b"mdia", b"hdlr"], a, b)]
        if kinds != [b"vide"]:
            continue
        frames = 0
        for x, _ in _inside(data, [b"mdia", b"minf", b"stbl", b"stts"], a, b):
            n = struct.unpack_from(">I", data, x + 4)[0]
            frames += sum(struct.unpack_from(">II", data, x + 8 + 8 * k)[0] for k in range(n))
        for x, _ in _inside(data, [b"mdia", b"mdhd"], a, b):
            scale, duration = _scale_and_duration(data, x)
            found |= {"frames": frames, "fps": frames * scale / duration if duration else None}
        break
    return found or None


def mat_kind(data: bytes) -> str | None:
    """`hdf5`, `mat73` (HDF5 behind a text header) or `mat5` by the file's first bytes."""
    magic = b"\x89HDF\r\n\x1a\n"
    if data[:8] == magic:
        return "hdf5"
    if data[:4] == b"MATL":
        return "mat73" if data[128:136] == magic else "mat5"
    return None


#: Element types of MAT files, version 5, that hold numbers.
_NUMBERS = {1: "i1", 2: "u1", 3: "i2", 4: "u2", 5: "i4", 6: "u4", 7: "f4", 9: "f8", 12: "i8", 13: "u8"}
_MATRIX, _COMPRESSED = 14, 15


def _elements(data: bytes, at: int, end: int, order: str) -> Iterator[tuple[int, int, int]]:
    """Type, start and end of the content of each element; small ones have both in their first 8 bytes."""
    while at + 8 <= end:
        kind, size = struct.unpack_from(order + "II", data, at)
        if kind >> 16:
            yield kind & 0xFFFF, at + 4, at + 4 + (kind >> 16)
            at += 8
        else:
            yield kind, at + 8, min(at + 8 + size, end)
            at += 8 + size + (0 if kind == _COMPRESSED else -size % 8)


def mat5_arrays(data: bytes, values: bool = True) -> Iterator[tuple[str, tuple[int, ...], np.ndarray | None]]:
    """Name, shape and values (column-major order undone) of the numeric arrays of a MAT file, version 5; hidden names are left out."""
    if mat_kind(data) != "mat5" or len(data) < 128:
        return
    order = "<" if data[126:128] == b"IM" else ">"
    todo = [(data, kind, a, b) for kind, a, b in _elements(data, 128, len(data), order)]
    for raw, kind, a, b in todo:
        if kind == _COMPRESSED:
            raw = zlib.decompress(raw[a:b])
            kind, a, b = next(_elements(raw, 0, len(raw), order), (0, 0, 0))
        if kind != _MATRIX:
            continue
        parts = list(_elements(raw, a, b, order))
        if len(parts) < 3:
            continue
        shape = tuple(np.frombuffer(raw[parts[1][1] : parts[1][2]], order + "i4").tolist())
        name = raw[parts[2][1] : parts[2][2]].decode("latin-1")
        if name.startswith("_"):
            continue
        own = None
        if values and len(parts) > 3 and parts[3][0] in _NUMBERS:
            own = np.frombuffer(raw[parts[3][1] : parts[3][2]], order + _NUMBERS[parts[3][0]]).astype(np.float64).reshape(shape, order="F")
        yield name, shape, own


def mat_shapes(files: DataFrame) -> DataFrame:
    """binaryFile rows -> path, name and shape of the first array; NULL where there is none that can be read (HDF5 needs `features.external`)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = []
            for x in b["content"]:
                try:
                    found.append(next(mat5_arrays(bytes(x), values=False), (None, None, None)))
                except (struct.error, zlib.error, ValueError):
                    found.append((None, None, None))
            yield pd.DataFrame({"path": b["path"], "name": [f[0] for f in found], "shape": [None if f[1] is None else list(f[1]) for f in found]})

    return files.select("path", "content").mapInPandas(run, "path string, name string, shape array<long>")


def mat_signals(files: DataFrame) -> DataFrame:
    """binaryFile rows -> path, instance, channel, t, value: the first array, (time, channel, instance), in long form."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, data in zip(b["path"], b["content"], strict=True):
                try:
                    x = next(mat5_arrays(bytes(data)), (None, None, None))[2]
                except (struct.error, zlib.error, ValueError):
                    continue
                if x is None or x.ndim not in (2, 3):
                    continue
                x = x.reshape(*x.shape, 1) if x.ndim == 2 else x
                for instance in range(x.shape[2]):
                    for channel in range(x.shape[1]):
                        yield pd.DataFrame(
                            {"path": path, "instance": instance, "channel": channel, "t": np.arange(len(x)), "value": x[:, channel, instance]},
                        )

    return files.select("path", "content").mapInPandas(run, "path string, instance long, channel long, t long, value double")


def frame_metrics(grey: np.ndarray) -> tuple[float, float]:
    """Variance of the Laplacian and share of clipped pixels (below 5 or above 250) of a decoded frame of 8-bit grey values."""
    x = np.pad(grey.astype(np.float64), 1, mode="reflect")
    edges = x[:-2, 1:-1] + x[2:, 1:-1] + x[1:-1, :-2] + x[1:-1, 2:] - 4 * x[1:-1, 1:-1]
    return float(edges.var()), float(((grey < 5) | (grey > 250)).mean())


def headers(files: DataFrame, kind: str) -> DataFrame:
    """binaryFile rows -> path and header fields; NULLs where a file can't be parsed."""
    if kind == "wav":
        names, parse, schema = ("rate", "channels", "bits", "frames"), wav_header, "path string, rate double, channels double, bits double, frames double"
    else:
        names, parse, schema = ("duration_s", "frames", "fps"), mp4_header, "path string, duration_s double, frames double, fps double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [parse(bytes(x)) or {} for x in b["content"]]
            yield pd.DataFrame({"path": b["path"], **{n: [r.get(n) for r in rows] for n in names}}).astype({n: "float64" for n in names})

    out = files.select("path", "content").mapInPandas(run, schema)
    return out.withColumn("duration_s", F.col("frames") / F.col("rate")) if kind == "wav" else out


def wav_samples(files: DataFrame) -> DataFrame:
    """binaryFile rows -> path, idx, value: the mean of the channels, full scale 1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, data in zip(b["path"], b["content"], strict=True):
                with wave.open(io.BytesIO(bytes(data))) as w:
                    width, channels = w.getsampwidth(), w.getnchannels()
                    raw = w.readframes(w.getnframes())
                if width == 3:
                    wide = np.zeros((len(raw) // 3, 4), np.uint8)
                    wide[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
                    x = wide.view("<i4")[:, 0] / 2**31
                else:
                    x = np.frombuffer(raw, {1: np.uint8, 2: "<i2", 4: "<i4"}[width]).astype(np.float64)
                    x = (x - 128) / 128 if width == 1 else x / 2 ** (8 * width - 1)
                mono = x.reshape(-1, channels).mean(1)
                for k in range(0, len(mono), 1 << 16):
                    own = mono[k : k + (1 << 16)]
                    yield pd.DataFrame({"path": path, "idx": np.arange(k, k + len(own)), "value": own})

    return files.select("path", "content").mapInPandas(run, "path string, idx long, value double")
