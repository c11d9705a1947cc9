"""Telephony audio columns (operator 6): G.711 mu-law and A-law, and IMA ADPCM, in WAVE files.

Codes are expanded by lookup tables; ADPCM blocks are decoded with numpy across all blocks of a batch,
sample by sample; PCM is resampled by integer interpolation and stored as 16-bit WAVE. All arithmetic
is on integers, so equal bytes give equal results on any machine.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamelake.llm.common import bounded_batches

#: WAVE format tags.
PCM, ALAW, MULAW, IMA = 1, 6, 7, 0x11
RATE, UNIT = 8000, 64
#: Samples that are resampled at once, and bytes of media that are decoded at once.
STRETCH, TOGETHER = 1 << 20, 2 << 20
#: The index changes of IMA ADPCM.
INDEX_CHANGE = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


def ima_steps() -> np.ndarray:
    """The 89 step sizes of IMA ADPCM. They grow by about a tenth; the standard's rounding is fixed."""
    # Fixed values, in the standard's order.
    return np.array(
        [
            7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
            130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060,
            1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484,
            7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
        ],
        np.int32,
    )


def mulaw_table() -> np.ndarray:
    code = ~np.arange(256, dtype=np.int32) & 0xFF
    size = ((((code & 0x0F) << 3) + 0x84) << ((code & 0x70) >> 4)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    code = np.arange(256, dtype=np.int32) ^ 0x55
    exponent, mantissa = (code & 0x70) >> 4, (code & 0x0F) << 4
    size = np.where(exponent == 0, mantissa + 8, (mantissa + 0x108) << np.maximum(exponent - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


TABLES = {MULAW: mulaw_table(), ALAW: alaw_table()}


def wave(tag: int, body: bytes, rate: int = RATE) -> bytes:
    """A mono WAVE file. An IMA body has blocks of 4 + 64 bytes, of 129 samples each."""
    bits, align, extra = {PCM: (16, 2, b""), IMA: (4, 4 + UNIT, struct.pack("<HH", 2, 2 * UNIT + 1))}.get(tag, (8, 1, struct.pack("<H", 0)))
    per_second = rate * (4 + UNIT) // (2 * UNIT + 1) if tag == IMA else rate * align
    fmt = struct.pack("<HHIIHH", tag, 1, rate, per_second, align, bits) + extra
    chunks = b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)
    return b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks


def read_wave(media: bytes | None) -> tuple[int, int, bytes] | None:
    """Format tag, sample rate and data (whole samples or blocks) of a WAVE file; None for what is no mono
    file of 16-bit PCM, G.711 or IMA ADPCM in blocks as ``wave`` writes them, or has no usable header."""
    if not media or len(media) < 12 or media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        return None
    at, tag, rate, unit = 12, None, 0, 1
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack("<I", media[at + 4 : at + 8])[0]
        if name == b"fmt ":
            if size < 16 or at + 24 > len(media):
                return None
            tag, channels, rate, _, unit, bits = struct.unpack("<HHIIHH", media[at + 8 : at + 24])
            if channels != 1 or rate == 0 or (bits, unit) != {PCM: (16, 2), ALAW: (8, 1), MULAW: (8, 1), IMA: (4, 4 + UNIT)}.get(tag):
                return None
        elif name == b"data":
            body = media[at + 8 : at + 8 + size]
            return None if tag is None else (tag, rate, body[: len(body) // unit * unit])
        at += 8 + size + size % 2
    return None


def store(payload: bytes, tag: int) -> bytes:
    """The payload as codes of a G.711 file, or as the nibbles of ADPCM blocks that start at silence."""
    if tag != IMA:
        return wave(tag, payload)
    blocks = np.zeros((len(payload) // UNIT, 4 + UNIT), np.uint8)
    blocks[:, 4:] = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
    return wave(IMA, blocks.tobytes())


def stored_payload(tag: int, body: bytes) -> bytes:
    return body if tag != IMA else np.frombuffer(body, np.uint8).reshape(-1, 4 + UNIT)[:, 4:].tobytes()


def decode_ima(blocks: np.ndarray) -> np.ndarray:
    """Samples (blocks, 129) of ADPCM blocks (blocks, 68): one step of all blocks at a time."""
    steps = ima_steps()
    now = blocks[:, 0].astype(np.int32) | (blocks[:, 1].astype(np.int8).astype(np.int32) << 8)
    index = np.clip(blocks[:, 2].astype(np.int32), 0, 88)
    out = np.empty((len(blocks), 2 * UNIT + 1), np.int16)
    out[:, 0] = now
    for k in range(2 * UNIT):
        code = (blocks[:, 4 + k // 2] >> (4 * (k % 2)) & 15).astype(np.int32)
        step = steps[index]
        change = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
        now = np.clip(np.where(code & 8, now - change, now + change), -32768, 32767)
        index = np.clip(index + INDEX_CHANGE[code & 7], 0, 88)
        out[:, k + 1] = now
    return out


def decode_all(files: list[tuple[int, int, bytes]]) -> list[np.ndarray]:
    """PCM of each file; the ADPCM blocks of all files are decoded together."""
    ima = [np.frombuffer(body, np.uint8)[: len(body) // (4 + UNIT) * (4 + UNIT)].reshape(-1, 4 + UNIT) for tag, _, body in files if tag == IMA]
    samples = decode_ima(np.concatenate(ima)) if ima else None
    out, at = [], 0
    for tag, _, body in files:
        if tag == IMA:
            n = len(body) // (4 + UNIT)
            out.append(samples[at : at + n].reshape(-1))
            at += n
        else:
            out.append(np.frombuffer(body, "<i2") if tag == PCM else TABLES[tag][np.frombuffer(body, np.uint8)])
    return out


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation at the times of the new rate, in integers, a stretch at a time."""
    out = np.empty(len(pcm) * to // rate, np.int16)
    for start in range(0, len(out), STRETCH):
        at = np.arange(start, min(start + STRETCH, len(out)), dtype=np.int64) * rate
        low, part = at // to, at % to
        high = np.minimum(low + 1, len(pcm) - 1)
        out[start : start + len(at)] = (pcm[low].astype(np.int64) * (to - part) + pcm[high].astype(np.int64) * part) // to
    return out


def codec_of(payload: bytes) -> int:
    """The query's choice among the three formats: by the payload alone."""
    return (MULAW, ALAW, IMA)[zlib.crc32(payload) % 3]


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each whole text's UTF-8 bytes, padded with zeros to a positive multiple
    of 64, as a WAVE file. Null and empty texts are 64 zero bytes. Repeated rows are alike, null ids
    are kept, an empty table gives an empty one, other columns are left out."""
    bounded_batches(docs.sparkSession)

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            padded = [b + b"\0" * ((-len(b)) % UNIT or (0 if b else UNIT)) for b in bodies]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(b) for b in bodies], pa.int64()), pa.array([store(p, codec_of(p)) for p in padded], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(stored, "doc_id long, n_bytes long, media binary")


def _parts(media: list[bytes | None]) -> Iterator[tuple[int, int]]:
    """Neighbouring files of about TOGETHER bytes."""
    first = size = 0
    for i, m in enumerate(media):
        size += len(m or b"")
        if size >= TOGETHER or i == len(media) - 1:
            yield first, i + 1
            first, size = i + 1, 0


def to_pcm(table: DataFrame, media: str = "media", rate: int = 16_000) -> DataFrame:
    """The table with pcm, a 16-bit WAVE file of the media at the new rate.

    pcm is null for media that are null, damaged or of no known format (see ``read_wave``). A file that
    ends early gives what is there; half a sample or block at its end is left out. A column called pcm is
    replaced; the others stay. Repeated rows are alike; an empty table gives an empty one."""
    bounded_batches(table.sparkSession)
    own = table.drop("pcm")
    schema = T.StructType([*own.schema.fields, T.StructField("pcm", T.BinaryType())])

    def converted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(batch.schema.get_field_index(media)).to_pylist()
            for a, z in _parts(given):
                files = [read_wave(m) for m in given[a:z]]
                good = [f for f in files if f]
                pcm = iter([wave(PCM, resample(p, f[1], rate).astype("<i2").tobytes(), rate) for p, f in zip(decode_all(good), good, strict=True)])
                yield pa.RecordBatch.from_arrays([*batch.slice(a, z - a).columns, pa.array([next(pcm) if f else None for f in files], pa.binary())], [*batch.schema.names, "pcm"])

    return own.mapInArrow(converted, schema)


def features(table: DataFrame) -> DataFrame:
    """doc_id, n_bytes and what a table with media and pcm (see ``to_pcm``) shows: payload_bytes,
    payload_sha256, tail_crc32 (of its last 64 bytes), media_bytes, media_sha256, and feature (format of
    the media; rate, samples, peak, mean square, zero crossings and a checksum of the PCM).

    Media that can't be read have null for all but their size and hash; null media for these too. PCM
    without samples has zeros. Repeated rows are alike; null ids are kept; an empty table gives an
    empty one; other columns are left out."""
    bounded_batches(table.sparkSession)
    names = {PCM: "pcm", ALAW: "alaw", MULAW: "mulaw", IMA: "ima"}

    def shown(tag: int, pcm: tuple[int, int, bytes]) -> str:
        x = np.frombuffer(pcm[2], "<i2")
        peak = power = crossings = 0
        for at in range(0, len(x), STRETCH):
            part = x[at : at + STRETCH].astype(np.int64)
            peak, power = max(peak, int(np.abs(part).max())), power + int(part @ part)
        crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
        return f"{names[tag]};rate={pcm[1]};n={len(x)};peak={peak};power={power // max(1, len(x))};zc={crossings};crc={zlib.crc32(pcm[2])}"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            media = batch.column("media").to_pylist()
            files, pcm = [read_wave(m) for m in media], [read_wave(m) for m in batch.column("pcm").to_pylist()]
            payloads = [None if f is None else stored_payload(f[0], f[2]) for f in files]
            of = lambda fn, values, kind: pa.array([None if v is None else fn(v) for v in values], kind)
            sha = lambda v: hashlib.sha256(v).hexdigest()
            told = [None if f is None or p is None else shown(f[0], p) for f, p in zip(files, pcm, strict=True)]
            columns = [
                batch.column("doc_id"), batch.column("n_bytes"), of(len, payloads, pa.int64()), of(sha, payloads, pa.string()),
                of(lambda p: zlib.crc32(p[-UNIT:]), payloads, pa.int64()), of(len, media, pa.int64()), of(sha, media, pa.string()), pa.array(told, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    own = table.select("doc_id", "n_bytes", "media", "pcm")
    return own.mapInArrow(read, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
