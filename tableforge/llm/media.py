"""Telephony audio columns: mu-law, A-law and IMA ADPCM payloads, decoded with numpy, stored as resampled PCM.

The companded codes are expanded by 256-entry tables that the codecs' formulas fill. ADPCM blocks are independent, so
all blocks of a batch advance one nibble at a time together. ``telephony_pcm`` returns 16-bit PCM at the wanted rate;
``stored_payload`` keeps any bytes losslessly as 8-bit mu-law samples in a RIFF file, reads them back, expands and
resamples them and stores that as a RIFF file of 16-bit PCM, from whose samples the features come.

Null payloads and texts are empty: a payload of 64 zero bytes. Repeated rows and equal texts give equal values; an empty
table gives no rows. Texts of any length are taken whole, CHUNK bytes at a time. Only the id and payload columns are
read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tableforge.llm import common

RATE, WANTED, BLOCK = 8000, 16000, 64
#: Payload bytes that are decoded together; a multiple of BLOCK.
CHUNK = 1 << 18


def mu_law_table() -> np.ndarray:
    code = ~np.arange(256, dtype=np.int32) & 255
    size = ((((code & 15) << 3) + 132) << ((code >> 4) & 7)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


def a_law_table() -> np.ndarray:
    code = np.arange(256, dtype=np.int32) ^ 0x55
    part, low = (code >> 4) & 7, (code & 15) << 4
    size = np.where(part == 0, low + 8, (low + 264) << np.maximum(part - 1, 0))
    return np.where(code & 128, size, -size).astype(np.int16)


MU_LAW, A_LAW = mu_law_table(), a_law_table()
#: The 89 step sizes and the index moves of IMA ADPCM.
STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)
MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int32)
#: Change of the predictor by (step index, nibble).
CHANGES = (((STEPS[:, None] >> 3) + (STEPS[:, None] >> 2) * ((np.arange(8) & 1) > 0) + (STEPS[:, None] >> 1) * ((np.arange(8) & 2) > 0) + STEPS[:, None] * ((np.arange(8) & 4) > 0))[:, :, None] * np.array([1, -1])).transpose(0, 2, 1).reshape(89, 16).astype(np.int32)


def adpcm(blocks: np.ndarray) -> np.ndarray:
    """PCM of mono IMA blocks (one per row: predictor, step index, a spare byte, then two nibbles a byte, low first)."""
    value = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2], 88).astype(np.int32)
    out = np.empty((1 + 2 * (blocks.shape[1] - 4), len(blocks)), np.int16)
    out[0] = value
    nibbles = np.stack([blocks[:, 4:] & 15, blocks[:, 4:] >> 4], 2).reshape(len(blocks), -1).T.astype(np.int32)
    nibbles = np.ascontiguousarray(nibbles)
    for k in range(len(nibbles)):
        np.clip(value + CHANGES[index, nibbles[k]], -32768, 32767, out=value)
        np.clip(index + MOVES[nibbles[k]], 0, 88, out=index)
        out[k + 1] = value
    return np.ascontiguousarray(out.T)


def resampled(pcm: np.ndarray, rate: int, wanted: int) -> np.ndarray:
    """Linear interpolation to another rate, rounded to 16 bits (halves up)."""
    n = len(pcm) * wanted // rate
    at = np.arange(n) * (rate / wanted)
    return np.floor(np.interp(at, np.arange(len(pcm)), pcm) + 0.5).astype("<i2") if len(pcm) else np.zeros(0, "<i2")


def doubled(pcm: np.ndarray, ends: np.ndarray, after: int | None = None) -> np.ndarray:
    """``resampled`` to twice the rate, of many sounds on end; ``after`` is the sample that follows the last one."""
    wide = pcm.astype(np.int32)
    following = np.append(wide[1:], 0)
    following[ends[1:] - 1] = wide[ends[1:] - 1]
    if after is not None:
        following[-1] = after
    out = np.empty(2 * len(wide), "<i2")
    out[::2], out[1::2] = wide, (wide + following + 1) >> 1
    return out


def telephony_pcm(df: DataFrame, codec: str, wanted: int = 16000, block: int = BLOCK, id_col: str = "id", payload_col: str = "payload") -> DataFrame:
    """id, n_samples, pcm (16-bit little-endian at ``wanted`` Hz) of 8 kHz payloads; codec: mulaw, alaw or adpcm. A last
    ADPCM block that isn't whole is padded with zeros."""
    if codec not in ("mulaw", "alaw", "adpcm"):
        raise ValueError(f"unknown codec {codec}")

    def decode(raw: bytes) -> np.ndarray:
        data = np.frombuffer(raw, np.uint8)
        if codec != "adpcm":
            return (MU_LAW if codec == "mulaw" else A_LAW)[data]
        return adpcm(np.pad(data, (0, -len(data) % block)).reshape(-1, block)).reshape(-1) if len(data) else np.zeros(0, np.int16)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pcm = [resampled(decode(p or b""), RATE, wanted) for p in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(p) for p in pcm], pa.int64()), pa.array([p.tobytes() for p in pcm], pa.binary())], [id_col, "n_samples", "pcm"])

    kind = df.schema[id_col].dataType.simpleString()
    return common.map_arrow(df.select(id_col, payload_col), run, f"`{id_col}` {kind}, n_samples long, pcm binary")


def riff(payload: bytes, code: int = 7, rate: int = RATE, width: int = 1, n_bytes: int | None = None) -> bytes:
    """A WAVE file of mono samples: code 7 is 8-bit mu-law, 1 is PCM. With ``n_bytes`` the head alone, for that many."""
    size = len(payload) if n_bytes is None else n_bytes
    form = struct.pack("<HHIIHHH", code, 1, rate, rate * width, width, 8 * width, 0)
    head = b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"fact" + struct.pack("<II", 4, size // width & 0xFFFFFFFF) + b"data" + struct.pack("<I", size & 0xFFFFFFFF)
    return b"RIFF" + struct.pack("<I", len(head) + size & 0xFFFFFFFF) + head + payload


def samples(file: bytes) -> memoryview:
    """The samples of such a file, found by its chunks."""
    at = 12
    while at + 8 <= len(file):
        name, size = file[at : at + 4], struct.unpack("<I", file[at + 4 : at + 8])[0]
        if name == b"data":
            return memoryview(file)[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


#: How each codec turns payload bytes (whole blocks) into samples, and how many of them a block gives.
CODECS = {"mu": (lambda data: MU_LAW[data], BLOCK), "a": (lambda data: A_LAW[data], BLOCK), "ima": (lambda data: adpcm(data.reshape(-1, BLOCK)).reshape(-1), 1 + 2 * (BLOCK - 4))}


def measures(sound: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Energy, sign changes, peak, sum, and the first and last sample of each sound, all integers."""
    wide = sound.astype(np.int64)
    turn = np.append((sound[1:] < 0) != (sound[:-1] < 0), False)
    turn[ends[1:] - 1] = False
    return np.stack([common.sums(wide * wide, ends), common.sums(turn, ends), np.maximum.reduceat(np.abs(wide), ends[:-1]), common.sums(wide, ends), wide[ends[:-1]], wide[ends[1:] - 1]], 1)


def joined(parts: list[np.ndarray]) -> np.ndarray:
    """``measures`` of a sound from those of its parts."""
    all_ = np.stack(parts)
    out = np.concatenate([all_[:, :4].sum(0), all_[[0, -1], [4, 5]]])
    out[1] += ((all_[1:, 4] < 0) != (all_[:-1, 5] < 0)).sum()
    out[2] = all_[:, 2].max()
    return out


def studied(payloads: list[memoryview]) -> tuple[list[str], list[list[bytes]]]:
    """Of each payload (whole blocks), the features of its resampled sound under each codec, and the parts of its PCM
    under mu-law. Short payloads are decoded together, long ones in chunks with a look at the block that follows."""
    if sum(map(len, payloads)) <= CHUNK or len(payloads) > 1:
        ends = np.append(0, np.cumsum([len(p) for p in payloads]))
        data, pcm, said = np.frombuffer(b"".join(payloads), np.uint8), [], []
        for name, (decode, n) in CODECS.items():
            at = ends // BLOCK * n
            sound = doubled(decode(data), at)
            said.append([feature(name, m, 2 * k) for m, k in zip(measures(sound, 2 * at), np.diff(at), strict=True)])
            if name == "mu":
                pcm = [[sound[2 * a : 2 * b].tobytes()] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        return [";".join(x) for x in zip(*said, strict=True)], pcm
    data, parts, kept = np.frombuffer(payloads[0], np.uint8), {name: [] for name in CODECS}, []
    for lo in range(0, len(data), CHUNK):
        for name, (decode, n) in CODECS.items():
            wide = decode(data[lo : lo + CHUNK + BLOCK])
            size = len(data[lo : lo + CHUNK]) // BLOCK * n
            sound = doubled(wide[:size], np.array([0, size]), int(wide[size]) if len(wide) > size else None)
            parts[name].append(measures(sound, np.array([0, 2 * size]))[0])
            kept += [sound.tobytes()] * (name == "mu")
    return [";".join(feature(name, joined(parts[name]), 2 * (len(data) // BLOCK * n)) for name, (_, n) in CODECS.items())], [kept]


def feature(name: str, measured: np.ndarray, n: int) -> str:
    energy, turns, peak, total = measured[:4].tolist()
    return f"{name}:{energy // n},{turns},{peak},{total}"


def stored_payload(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """id, sizes and digests of each text's payload as read back from its stored form, a feature string of its resampled
    sound, and size and digest of that sound's PCM file; ``media`` (the stored form) and ``pcm`` too if ``keep``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, media, sounds = [], [], []
        for _, _, data, offsets in common.blocks(batch.column(1), CHUNK):
            sizes, files = np.diff(offsets).tolist(), []
            for a, n in zip(offsets[:-1].tolist(), sizes, strict=True):
                files.append(riff(b"".join([data[a : a + n], bytes(max(BLOCK, -(-n // BLOCK) * BLOCK) - n)])))
            back = [samples(f) for f in files]
            said, pcm = studied(back)
            for n, file, payload, text, parts in zip(sizes, files, back, said, pcm, strict=True):
                head = riff(b"", 1, WANTED, 2, sum(map(len, parts)))
                heard = hashlib.sha256(head)
                for part in parts:
                    heard.update(part)
                rows.append((n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(file), hashlib.sha256(file).hexdigest(), text, len(head) + sum(map(len, parts)), heard.hexdigest()))
                sounds += [b"".join([head, *parts])] * keep
            media += files * keep
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        columns = [batch.column(0), *(pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)), *[pa.array(x, pa.binary()) for x in (media, sounds) if keep]]
        return pa.RecordBatch.from_arrays(columns, names)

    names = [id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pcm_bytes", "pcm_sha256", *["media", "pcm"] * keep]
    kind = df.schema[id_col].dataType.simpleString()
    fields = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pcm_bytes long, pcm_sha256 string"
    return common.map_arrow(df.select(id_col, text_col), run, f"`{id_col}` {kind}, {fields}{', media binary, pcm binary' * keep}")


def op4_telephony_audio(spark, sf_dir: str) -> DataFrame:
    return stored_payload(common.documents(spark, sf_dir))
