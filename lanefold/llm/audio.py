"""Telephony audio: mu-law, A-law and IMA ADPCM in WAVE files.

The companding codes are expanded by lookup tables of 256 entries, built from the rule of the
standard; ADPCM blocks are decoded in lockstep, one numpy step for the k-th sample of all blocks of a
batch at once. Decoded sound is resampled by a polyphase windowed sinc and stored as 16-bit PCM.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanefold.llm._common import load, short_batches, written

#: Format tags of WAVE files.
TAGS = {"pcm": 1, "alaw": 6, "mulaw": 7, "ima": 17}
#: The step index change for the magnitude bits of an IMA ADPCM code.
INDEX_STEP = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)
#: The step sizes of IMA ADPCM.
STEPS = np.array(
    [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963,
     1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767],
    np.int32,
)
BLOCK = 64
RATE = 8000


@lru_cache(1)
def mulaw_table() -> np.ndarray:
    """G.711 mu-law: sign, 3 bits of segment and 4 of mantissa, all inverted, with a bias of 33 quarter steps."""
    code = ~np.arange(256) & 0xFF
    size = (((code & 15) << 1 | 33) << (code >> 4 & 7)) - 33
    return (np.where(code & 128, -size, size) * 4).astype(np.int16)


@lru_cache(1)
def alaw_table() -> np.ndarray:
    """G.711 A-law: even bits inverted, segment 0 linear, a set sign bit positive."""
    code = np.arange(256) ^ 0x55
    seg, mant = code >> 4 & 7, code & 15
    size = np.where(seg == 0, mant << 1 | 1, (mant << 1 | 33) << np.maximum(seg - 1, 0))
    return (np.where(code & 128, size, -size) * 8).astype(np.int16)


def decode_ima(blocks: np.ndarray) -> np.ndarray:
    """(blocks, bytes) of mono IMA ADPCM to (blocks, 2 * bytes - 7) samples; an index out of range is clipped."""
    n, width = blocks.shape
    value = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2], len(STEPS) - 1).astype(np.int32)
    out = np.empty((2 * (width - 4) + 1, n), np.int16)
    out[0] = value
    codes = np.empty((2 * (width - 4), n), np.uint8)
    codes[0::2], codes[1::2] = blocks[:, 4:].T & 15, blocks[:, 4:].T >> 4
    for k, code in enumerate(codes):
        step = STEPS[index]
        size = step >> 3
        size += np.where(code & 4, step, 0)
        size += np.where(code & 2, step >> 1, 0)
        size += np.where(code & 1, step >> 2, 0)
        value += np.where(code & 8, -size, size)
        np.clip(value, -32768, 32767, out=value)
        index += INDEX_STEP[code & 7]
        np.clip(index, 0, len(STEPS) - 1, out=index)
        out[k + 1] = value
    return out.T


def wave(data: bytes, codec: str, rate: int = RATE) -> bytes:
    """A mono WAVE file around sample data."""
    bits, align = {"pcm": (16, 2), "ima": (4, BLOCK)}.get(codec, (8, 1))
    per_block = 2 * BLOCK - 7
    speed = rate * align // (per_block if codec == "ima" else 1)
    fmt = struct.pack("<HHIIHH", TAGS[codec], 1, rate, speed, align, bits)
    if codec == "ima":
        fmt += struct.pack("<HH", 2, per_block)
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def parse_wave(media: bytes) -> tuple[str, int, int, bytes] | None:
    """codec, rate, block size and sample data of a mono WAVE file; None if it isn't one of the known kinds."""
    if len(media) < 12 or media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        return None
    at, fmt = 12, None
    while at + 8 <= len(media):
        name, n = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt " and n >= 16:
            fmt = struct.unpack_from("<HHIIHH", media, at + 8)
        elif name == b"data" and fmt:
            codec = {v: k for k, v in TAGS.items()}.get(fmt[0])
            return (codec, fmt[2], fmt[4], media[at + 8 : at + 8 + n]) if codec and fmt[1] == 1 else None
        at += 8 + n + (n & 1)
    return None


@lru_cache(8)
def _filters(up: int, down: int, half: int = 8) -> np.ndarray:
    """One windowed-sinc filter a phase, each summing to 1."""
    cut = min(1.0, up / down)
    t = np.arange(-half + 1, half + 1)[None, :] - np.arange(up)[:, None] / up
    h = np.sinc(t * cut) * np.cos(np.pi * t / (2 * half + 1)) ** 2
    return (h / h.sum(1, keepdims=True)).astype(np.float32)


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """16-bit samples at another rate; ends are held."""
    if rate == to or not len(pcm):
        return pcm
    g = np.gcd(rate, to)
    up, down = to // g, rate // g
    bank, half = _filters(up, down), 8
    padded = np.pad(pcm.astype(np.float32), (half - 1, half), mode="edge")
    view = np.lib.stride_tricks.sliding_window_view(padded, 2 * half)
    n = len(pcm) * up // down
    out = np.empty(n, np.float32)
    for phase in range(up):  # outputs whose position falls on this phase of the filter bank
        first = next(j for j in range(up) if j * down % up == phase)
        j = np.arange(first, n, up)
        out[first::up] = view[j * down // up] @ bank[phase]
    return np.clip(np.rint(out), -32768, 32767).astype(np.int16)


def decode_batch(medias: list[bytes | None]) -> list[tuple[str, int, np.ndarray, bytes] | None]:
    """codec, rate, samples and sample data of each file; ADPCM blocks of equal size are decoded together."""
    parsed = [parse_wave(m) if m else None for m in medias]
    out: list = [None] * len(medias)
    adpcm: dict[int, list[tuple[int, np.ndarray]]] = {}
    for k, p in enumerate(parsed):
        if p is None:
            continue
        codec, rate, align, data = p
        raw = np.frombuffer(data, np.uint8)
        if codec == "ima":
            adpcm.setdefault(max(align, 5), []).append((k, raw[: len(raw) // max(align, 5) * max(align, 5)]))
        else:
            pcm = mulaw_table()[raw] if codec == "mulaw" else alaw_table()[raw] if codec == "alaw" else raw[: len(raw) // 2 * 2].view("<i2")
            out[k] = (codec, rate, pcm, data)
    for align, group in adpcm.items():
        pcm = decode_ima(np.concatenate([r for _, r in group]).reshape(-1, align))
        at = 0
        for k, r in group:
            n = len(r) // align
            out[k] = ("ima", parsed[k][1], pcm[at : at + n].ravel(), parsed[k][3])
            at += n
    return out


FEATURES = "codec string, rate int, n_samples long, rms double, peak int, crossings long, pcm binary, data binary"


def describe(decoded: tuple | None, to_rate: int) -> dict:
    if decoded is None:
        return dict.fromkeys(c.split()[0] for c in FEATURES.split(", "))
    codec, rate, pcm, data = decoded
    out = resample(pcm, rate, to_rate)
    x = out.astype(np.int64)
    rms = float(np.sqrt((x * x).mean())) if len(x) else 0.0
    cross = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    return {"codec": codec, "rate": to_rate, "n_samples": len(x), "rms": rms, "peak": int(np.abs(x).max(initial=0)), "crossings": cross, "pcm": wave(out.tobytes(), "pcm", to_rate), "data": data}


def decode_media(rows: DataFrame, media: str = "media", to_rate: int = 16_000, batch_bytes: int = 4 << 20) -> DataFrame:
    """``rows`` with ``audio``: a struct of codec, rate, n_samples, rms, peak, crossings, pcm (a 16-bit WAVE file at
    ``to_rate``) and data (the sample bytes as stored).

    Files that are null, empty, damaged, of another codec or not mono have a struct of nulls; sample data
    cut short is decoded as far as its last whole block. Rows stay one for one; a column ``audio`` is replaced.
    """
    short_batches(rows.sparkSession)
    kept = rows.drop("audio")
    struct_ = ", ".join(f"{c.split()[0]}:{c.split()[1]}" for c in FEATURES.split(", "))
    schema = kept.withColumn("audio", F.lit(None).cast(f"struct<{struct_.replace('long', 'bigint')}>")).schema
    names = kept.columns
    kinds = pa.struct([("codec", pa.string()), ("rate", pa.int32()), ("n_samples", pa.int64()), ("rms", pa.float64()), ("peak", pa.int32()), ("crossings", pa.int64()), ("pcm", pa.binary()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, medias = 0, batch.column(media)
            while at < len(batch):
                end, held = at, 0
                while end < len(batch) and (end == at or held < batch_bytes):
                    held += len(medias[end].as_py() or b"")
                    end += 1
                part = batch.slice(at, end - at)
                told = [describe(d, to_rate) for d in decode_batch(part.column(media).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(told, kinds)], names=[*names, "audio"])
                at = end

    return kept.mapInArrow(run, schema)


def store_texts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, n_bytes and ``media``: each whole text as the samples of a WAVE file.

    The UTF-8 bytes (null: none) are filled up with zeros to a positive multiple of 64, one ADPCM
    block. The codec (mu-law, A-law, ADPCM) follows from a checksum, so equal texts give equal files.
    """
    short_batches(docs.sparkSession)
    schema = docs.select(F.col(id)).withColumns({"n_bytes": F.lit(0).cast("long"), "media": F.lit(b"")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            files = [wave(r.ljust(max(1, -(-len(r) // BLOCK)) * BLOCK, b"\0"), ("mulaw", "alaw", "ima")[zlib.crc32(r) % 3]) for r in raws]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(r) for r in raws], pa.int64()), pa.array(files, pa.binary())], names=[id, "n_bytes", "media"])

    return docs.select(F.col(id), F.col(text)).mapInArrow(run, schema)


def op6_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores every text as telephony samples, decodes the stored files and describes bytes and sound."""
    found = decode_media(written(store_texts(load(spark, sf_dir, "documents")), "media", compression="zstd"))
    a = F.col("audio")
    feature = F.format_string("%s %d Hz n=%d rms=%.3f peak=%d zc=%d pcm=%s", a["codec"], a["rate"], a["n_samples"], a["rms"], a["peak"], a["crossings"], F.sha2(a["pcm"], 256))
    size = F.octet_length(a["data"])
    return found.select(
        "doc_id", "n_bytes", size.cast("long").alias("payload_bytes"), F.sha2(a["data"], 256).alias("payload_sha256"),
        F.crc32(F.substring(a["data"], -BLOCK, BLOCK)).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"),
    )
