"""FLAC streams of 8-bit mono samples in a binary column, encoded and decoded.

Frames of one batch are worked on side by side: residuals, Rice codes and check
sums are arrays over all frames, so the cost of a step is shared. The encoder
writes a seek point for every frame; the decoder starts all frames from them,
checks both sums of each, restores the predictors, and gives PCM blocks with the
sample offsets they start at.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import BinaryType

from placeloom.llm.common import bounded_batches

BLOCK, RATE = 1024, 8000
#: Frames worked on at once: bounds a task's memory whatever the length of a text.
FRAMES = 1536
PAD = 64
#: A linear predictor that suits the bytes of text: coefficients in 512ths, of the last sample first. It is fixed, so that equal
#: texts give equal streams; a frame takes it where its residuals are smaller than those of the format's own predictors.
TEXT_LPC = ((186, 48, 133), 9)


def _crc_table(poly: int, bits: int) -> np.ndarray:
    out = np.zeros(256, np.uint32)
    for i in range(256):
        c = i << (bits - 8)
        for _ in range(8):
            c = (c << 1) ^ (poly if c >> (bits - 1) & 1 else 0)
        out[i] = c & ((1 << bits) - 1)
    return out


_CRC8 = _crc_table(0x07, 8).tolist()
_CRC16 = _crc_table(0x8005, 16).astype(np.uint16)


def _crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = _CRC8[c ^ b]
    return c


def _crc16(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Check sums of data[start : start + length], for all of them step by step."""
    order = np.argsort(-length, kind="stable")
    s, n = start[order], length[order]
    c = np.zeros(len(s), np.uint16)
    active = np.searchsorted(-n, -np.arange(int(n[0]) if len(n) else 0), side="left")
    for i, a in enumerate(active):
        x = c[:a]
        c[:a] = (x << np.uint16(8)) ^ _CRC16[(x >> np.uint16(8)) ^ data[s[:a] + i]]
    out = np.empty_like(c)
    out[order] = c
    return out


def _number(k: int) -> bytes:
    """A frame's number as in UTF-8, up to 36 bits."""
    if k < 0x80:
        return bytes([k])
    more = next(m for m in range(1, 7) if k < 1 << (6 * m + max(0, 6 - m)))
    head = (0xFF << (7 - more)) & 0xFF
    return bytes([head | k >> (6 * more), *(0x80 | k >> (6 * j) & 0x3F for j in range(more - 1, -1, -1))])


def _header(number: int, n: int) -> bytes:
    full = n == BLOCK
    head = bytes([0xFF, 0xF8, (0xA0 if full else 0x70), 0x02]) + _number(number) + (b"" if full else struct.pack(">H", n - 1))
    return head + bytes([_crc8(head)])


def _residual(x: np.ndarray, order: int, lpc) -> np.ndarray:
    if lpc is None:
        return np.diff(x, order, axis=1) if order else x
    coefficients, shift = lpc
    predicted = sum(c * x[:, order - 1 - j : x.shape[1] - 1 - j] for j, c in enumerate(coefficients))
    return x[:, order:] - (predicted >> shift)


def _frames(x: np.ndarray, numbers: np.ndarray, predictor=TEXT_LPC) -> list[bytes]:
    """Encoded frames of the rows of x, signed samples, all of one length. predictor None: only the format's own ones."""
    f, n = x.shape
    x = x.astype(np.int32)
    same = (x == x[:, :1]).all(axis=1)
    sums = [np.abs(_residual(x, o, None)[:, 4 - o :] if o < 4 else _residual(x, 4, None)).sum(axis=1) for o in range(5)]
    if predictor and n > 4 + len(predictor[0]):
        sums.append(np.abs(_residual(x, len(predictor[0]), predictor)[:, 4 - len(predictor[0]) :]).sum(axis=1))
    choice = np.stack(sums).argmin(axis=0)
    out: list[bytes] = [b""] * f
    for chosen in np.unique(choice):
        lpc = predictor if chosen == 5 else None
        order = len(lpc[0]) if lpc else int(chosen)
        rows = np.flatnonzero(choice == chosen)
        r = _residual(x[rows], int(order), lpc)
        u = ((r << 1) ^ (r >> 31)).astype(np.int64)
        m = u.shape[1]
        low = np.clip(np.log2(np.maximum(u.mean(axis=1) * 0.69, 1)).astype(np.int64), 0, 13)  # the best parameter, or one less
        costs = np.stack([(u >> (low + j)[:, None]).sum(axis=1) + m * (low + j + 1) for j in (0, 1)])
        ks = low + costs.argmin(axis=0)
        bits = costs.min(axis=0)
        k = ks[:, None]
        q = u >> k
        length = q + 1 + k
        start = np.cumsum(length, axis=1) - length + 10
        size = (10 + bits + 7) // 8
        base = np.cumsum(size + 3) - (size + 3)
        at = start + q + 8 * base[:, None]
        word = ((1 << k) | (u & ((1 << k) - 1))) << (32 - (k + 1) - (at & 7))
        byte = (at >> 3).ravel()
        word = word.ravel()
        total = int((size + 3).sum())
        data = np.zeros(total, np.float64)
        for j in range(3):
            data += np.bincount(byte + j, weights=(word >> (24 - 8 * j)) & 255, minlength=total)[:total]
        data = data.astype(np.uint8)
        data[base] |= (ks >> 2).astype(np.uint8)  # method 0 and order 0 of the partition, then the parameter
        data[base + 1] |= ((ks & 3) << 6).astype(np.uint8)
        warm = x[rows, : int(order)].astype(np.int8)
        for j, row in enumerate(rows):
            if same[row]:
                sub = bytes([0x00, int(x[row, 0]) & 255])
            elif size[j] + order + (0 if lpc is None else 2 * order + 2) >= n:
                sub = b"\x02" + x[row].astype(np.int8).tobytes()
            elif lpc is None:
                sub = bytes([(8 | int(order)) << 1]) + warm[j].tobytes() + data[base[j] : base[j] + size[j]].tobytes()
            else:
                sub = bytes([(32 | int(order) - 1) << 1]) + warm[j].tobytes() + _lpc_bits(lpc, data[base[j] : base[j] + size[j]].tobytes(), 10 + int(bits[j]))
            out[row] = _header(int(numbers[row]), n) + sub
    data = np.frombuffer(b"".join(out), np.uint8)
    length = np.array(list(map(len, out)), np.int64)
    sums16 = _crc16(data, np.cumsum(length) - length, length)
    return [a + struct.pack(">H", int(c)) for a, c in zip(out, sums16, strict=True)]


def _lpc_bits(lpc, residual: bytes, bits: int) -> bytes:
    """Precision (15 bits), shift and coefficients before the residual's bits, which then don't start at a whole byte."""
    coefficients, shift = lpc
    value, n = (15 - 1) << 5 | shift, 9
    for c in coefficients:
        value, n = value << 15 | c & 0x7FFF, n + 15
    value, n = value << bits | int.from_bytes(residual, "big") >> (8 * len(residual) - bits), n + bits
    return (value << -n % 8).to_bytes((n + 7) // 8, "big")


def encode_all(payloads: list[bytes], lpc=TEXT_LPC) -> list[bytes]:
    """A FLAC stream for each payload, whose bytes are 8-bit samples as in WAV: 128 is silence."""
    where = [(d, i) for d, p in enumerate(payloads) for i in range(0, len(p), BLOCK)]
    frames: list[bytes] = [b""] * len(where)
    for low in range(0, len(where), FRAMES):
        part = where[low : low + FRAMES]
        sizes = np.array([min(BLOCK, len(payloads[d]) - i) for d, i in part])
        for n in np.unique(sizes):
            rows = np.flatnonzero(sizes == n)
            x = np.frombuffer(b"".join(payloads[part[r][0]][part[r][1] : part[r][1] + n] for r in rows), np.uint8).reshape(-1, n).astype(np.int16) - 128
            for r, frame in zip(rows, _frames(x, np.array([part[r][1] // BLOCK for r in rows]), lpc), strict=True):
                frames[low + r] = frame
    out, k = [], 0
    for p in payloads:
        mine = frames[k : k + -(-len(p) // BLOCK)]
        k += len(mine)
        signed = (np.frombuffer(p, np.uint8) ^ 0x80).tobytes()
        info = struct.pack(">HH", BLOCK, BLOCK) + b"\0" * 6 + (RATE << 44 | 0 << 41 | 7 << 36 | len(p)).to_bytes(8, "big") + hashlib.md5(signed).digest()
        seek, at = [], 0
        for i, x in enumerate(mine):
            seek.append(struct.pack(">QQH", i * BLOCK, at, min(BLOCK, len(p) - i * BLOCK)))
            at += len(x)
        table = b"".join(seek)
        out.append(b"fLaC\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(table).to_bytes(3, "big") + table + b"".join(mine))
    return out


class Broken(ValueError):
    """A stream that is not whole, or fails one of its check sums."""


def _open(stream: bytes) -> tuple[int, bytes, list[tuple[int, int, int]]]:
    """Samples in all, their MD5, and (first sample, start of the frame, samples) of each seek point."""
    if stream[:4] != b"fLaC":
        raise Broken("no FLAC stream")
    at, last, total, digest, points = 4, False, 0, b"", []
    while not last:
        if at + 4 > len(stream):
            raise Broken("short metadata")
        kind, size = stream[at], int.from_bytes(stream[at + 1 : at + 4], "big")
        last, body = bool(kind & 0x80), stream[at + 4 : at + 4 + size]
        if len(body) < size:
            raise Broken("short metadata")
        if kind & 0x7F == 0:
            packed = int.from_bytes(body[10:18], "big")
            total, digest = packed & (1 << 36) - 1, body[18:34]
            if (packed >> 36 & 31) != 7 or packed >> 41 & 7:
                raise Broken("not 8-bit mono")
        elif kind & 0x7F == 3:
            points = [struct.unpack_from(">QQH", body, i) for i in range(0, size, 18)]
        at += 4 + size
    return total, digest, [(s, at + o, n) for s, o, n in points if s < 1 << 63]


def _frame_header(stream: bytes, at: int) -> tuple[int, int]:
    """Samples in the frame, where its subframe starts."""
    if stream[at : at + 2] != b"\xff\xf8" or stream[at + 3] != 0x02:
        raise Broken("no frame of 8-bit mono")
    code, i = stream[at + 2] >> 4, at + 5
    first = stream[at + 4]
    while first & 0x80 and first & 0x40:
        i, first = i + 1, (first << 1) & 0xFF
    if code == 7:
        n, i = int.from_bytes(stream[i : i + 2], "big") + 1, i + 2
    elif code == 6:
        n, i = stream[i] + 1, i + 1
    elif code >= 8:
        n = 256 << (code - 8)
    else:
        n = 192 if code == 1 else 576 << (code - 2)
    if _crc8(stream[at:i]) != stream[i]:
        raise Broken("a frame header's check sum")
    return n, i + 1


def _rice(data: np.ndarray, pos: np.ndarray, ks: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """m[i] residuals from bit pos[i] on with parameter ks[i], for all i step by step; and where they end."""
    order = np.argsort(-m, kind="stable")
    pos, k, m = pos[order].astype(np.int64), ks[order].astype(np.uint64), m[order]
    out = np.zeros((len(m), int(m[0])), np.int32)
    windows = np.ndarray((len(data) - 7,), ">u8", data, 0, (1,))
    down, one = np.uint64(64) - k, np.uint64(1)
    for i, a in enumerate(np.searchsorted(-m, -np.arange(int(m[0])), side="left")):
        p = pos[:a]
        x = windows[p >> 3].astype(np.uint64) << (p & 7).astype(np.uint64)
        top = (x >> np.uint64(11)).astype(np.float64)
        q = (1075 - (top.view(np.int64) >> 52)).astype(np.uint64)
        kk = k[:a]
        rest = np.where(kk > 0, (x << (q + one)) >> np.minimum(down[:a], np.uint64(63)), np.uint64(0))
        far = np.flatnonzero((x >> np.uint64(24)) == 0)  # long codes, one by one
        u = (q << kk) | rest
        end = p + (q + one + kk).astype(np.int64)
        for j in far:
            b = int(p[j])
            while not data[b >> 3] >> (7 - (b & 7)) & 1:
                b += 1
            z, b, kj = b - int(p[j]), b + 1, int(kk[j])
            w = int.from_bytes(data[b >> 3 : (b >> 3) + 4].tobytes(), "big")
            u[j] = z << kj | (w >> (32 - kj - (b & 7)) & ((1 << kj) - 1))
            end[j] = b + kj
        pos[:a] = end
        v = u.astype(np.int64)
        out[:a, i] = (v >> 1) ^ -(v & 1)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return out[back], pos[back]


def _decode_frames(data: np.ndarray, raw: bytes, starts: list[int], ends: list[int]) -> list[np.ndarray]:
    """Signed samples of the frames raw[start:end]. data: raw and eight bytes more."""
    lengths = np.array(ends, np.int64) - np.array(starts, np.int64)
    got = _crc16(data, np.array(starts, np.int64), lengths - 2)
    if any(int(c) != raw[e - 2] << 8 | raw[e - 1] for c, e in zip(got.tolist(), ends, strict=True)):
        raise Broken("a frame's check sum")
    out: list = [None] * len(starts)
    coded = []
    for f, at in enumerate(starts):
        n, i = _frame_header(raw, at)
        kind = raw[i] >> 1
        if raw[i] & 0x81:
            raise Broken("wasted bits")
        if kind == 0:
            out[f] = np.full(n, np.int8(raw[i + 1] - 256 * (raw[i + 1] > 127)), np.int32)
        elif kind == 1:
            out[f] = np.frombuffer(raw, np.int8, n, i + 1).astype(np.int32)
        else:
            order = kind - 8 if kind < 32 else kind - 31
            bit, lpc = 8 * (i + 1 + order), None
            take = lambda b, w: int.from_bytes(raw[b >> 3 : (b + w + 7) >> 3], "big") >> (-(b + w) % 8) & ((1 << w) - 1)
            if kind >= 32:
                precision, shift, bit = take(bit, 4) + 1, take(bit + 4, 5), bit + 9
                signed = [take(bit + j * precision, precision) for j in range(order)]
                lpc, bit = ([c - ((c >> (precision - 1)) << precision) for c in signed], shift), bit + order * precision
            wide, parts = (4, 5)[take(bit, 2)], take(bit + 2, 4)
            coded.append((f, n, order, lpc, i + 1, bit + 6, wide, parts))
    if coded:
        _decode_coded(data, raw, coded, out)
    return out


def _decode_coded(data: np.ndarray, raw: bytes, coded: list[tuple], out: list) -> None:
    pos = np.array([c[5] for c in coded], np.int64)
    residuals: list[list[np.ndarray]] = [[] for _ in coded]
    for part in range(max(1 << c[7] for c in coded)):
        now = [j for j, c in enumerate(coded) if part < 1 << c[7]]
        ks, m = [], []
        for j in now:
            f, n, order, lpc, _, _, wide, parts = coded[j]
            b = int(pos[j])
            ks.append(int.from_bytes(raw[b >> 3 : (b >> 3) + 2].ljust(2, b"\0"), "big") >> (16 - wide - (b & 7)) & ((1 << wide) - 1))
            if ks[-1] == (1 << wide) - 1:
                raise Broken("unencoded residuals")
            m.append((n >> parts) - (order if part == 0 else 0))
            pos[j] += wide
        got, pos[now] = _rice(data, pos[now], np.array(ks), np.array(m))
        for j, row, count in zip(now, got, m, strict=True):
            residuals[j].append(row[:count])
    groups: dict = {}
    for j, (f, n, order, lpc, warm, *_) in enumerate(coded):
        groups.setdefault((n if lpc is None else 0, order, None if lpc is None else (tuple(lpc[0]), lpc[1])), []).append((f, j, warm))
    for (n, order, lpc), members in groups.items():
        if lpc is not None:
            _predicted(raw, coded, residuals, members, order, lpc, out)
            continue
        r = np.stack([np.concatenate(residuals[j]) for _, j, _ in members]).astype(np.int64)
        w = np.stack([np.frombuffer(raw, np.int8, order, at) for *_, at in members]).astype(np.int64) if order else np.zeros((len(members), 0), np.int64)
        for level in range(order - 1, -1, -1):
            first = np.diff(w, level, axis=1)[:, :1]
            r = np.cumsum(np.concatenate([first, r], axis=1), axis=1)
            # r now holds differences of this level from the first on; those before the warm-up's end are dropped below
        x = r[:, -n:] if order else r
        for (f, *_), row in zip(members, x, strict=True):
            out[f] = row


def _predicted(raw: bytes, coded: list[tuple], residuals: list, members: list[tuple], order: int, lpc, out: list) -> None:
    """Samples of the frames that one linear predictor gives: all frames step by step, the short ones padded."""
    coefficients, shift = lpc
    sizes = [coded[j][1] for _, j, _ in members]
    x = np.zeros((max(sizes), len(members)), np.int32)
    for k, (_, j, at) in enumerate(members):
        x[:order, k] = np.frombuffer(raw, np.int8, order, at)
        x[order : sizes[k], k] = np.concatenate(residuals[j])
    for i in range(order, len(x)):
        total = coefficients[0] * x[i - 1]
        for j in range(1, order):
            total += coefficients[j] * x[i - 1 - j]
        x[i] += total >> shift
    for (f, *_), column, n in zip(members, x.T, sizes, strict=True):
        out[f] = column[:n]


def decode_all(streams: list[bytes]) -> list[list[tuple[int, bytes]]]:
    """(first sample, samples as unsigned bytes) of each block of each stream; raises Broken where a check fails, or the stream ends too soon."""
    try:
        return _decode_all(streams)
    except (IndexError, struct.error) as e:
        raise Broken("a short stream") from e


def _decode_all(streams: list[bytes]) -> list[list[tuple[int, bytes]]]:
    opened = [_open(s) for s in streams]
    jobs = [(d, s, a, (points[i + 1][1] if i + 1 < len(points) else len(streams[d])), n) for d, (_, _, points) in enumerate(opened) for i, (s, a, n) in enumerate(points)]
    parts: list[list[bytes]] = [[] for _ in streams]
    for low in range(0, len(jobs), FRAMES):
        some = jobs[low : low + FRAMES]
        raw = b"".join(streams[d][a:e] for d, _, a, e, _ in some)
        data = np.frombuffer(raw + b"\0" * 8, np.uint8)
        sizes = np.cumsum([0, *(e - a for _, _, a, e, _ in some)]).tolist()
        for (d, *_, n), x in zip(some, _decode_frames(data, raw, sizes[:-1], sizes[1:]), strict=True):
            if len(x) != n:
                raise Broken("a seek point")
            parts[d].append((x + 128).astype(np.uint8).tobytes())
    out = []
    for (total, digest, points), mine in zip(opened, parts, strict=True):
        pcm = b"".join(mine)
        if len(pcm) != total or hashlib.md5((np.frombuffer(pcm, np.uint8) ^ 0x80).tobytes()).digest() != digest:
            raise Broken("the stream's length or sum")
        out.append([(s, block) for (s, *_), block in zip(points, mine, strict=True)])
    return out


def payload(text: str | None) -> bytes:
    """UTF-8 of the text (null: empty) with zero bytes up to a positive multiple of 64."""
    data = (text or "").encode()
    return data + b"\0" * (-len(data) % PAD or PAD * (not data))


@F.arrow_udf(BinaryType())
def _encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array(encode_all([payload(t.as_py()) for t in texts]), pa.binary())


def _feature(pcm: bytes) -> str:
    """Loudness, zero crossings and peak of the samples."""
    x = np.frombuffer(pcm, np.uint8).astype(np.int64) - 128
    crossings = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    return f"mean_square={int((x * x).sum()) // len(x)};crossings={crossings};peak={int(np.abs(x).max())}"


_PCM = pa.struct([("blocks", pa.list_(pa.struct([("sample_offset", pa.int64()), ("pcm", pa.binary())]))), ("feature", pa.string())])


@F.arrow_udf(from_arrow_type(_PCM))
def _decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for media in batches:
        present = iter(decode_all([m.as_py() for m in media if m.is_valid]))
        rows = [next(present) if m.is_valid else None for m in media]
        yield pa.array([None if r is None else {"blocks": [{"sample_offset": s, "pcm": p} for s, p in r], "feature": _feature(b"".join(p for _, p in r))} for r in rows], _PCM)


def to_flac(text: Column) -> Column:
    """The FLAC stream that holds a text's bytes as samples. Null and empty texts: 64 zero bytes."""
    return _encoded(text)


def from_flac(media: Column) -> Column:
    """struct<blocks: array<struct<sample_offset, pcm>>, feature>: the samples in blocks, each with the sample it starts
    at, and what they sound like; null for null. A stream that fails a check fails the job: it must not pass for silence."""
    return _decoded(media)


def whole(blocks: Column) -> Column:
    """The samples of all blocks, one after the other."""
    return F.unhex(F.array_join(F.transform(blocks, lambda b: F.hex(b["pcm"])), ""))


def seek(blocks: Column, sample: Column) -> Column:
    """The block that holds a sample: the last one that starts at it or before; null beyond the last start of none."""
    return F.element_at(F.filter(blocks, lambda b: b["sample_offset"] <= sample), -1)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id_col, n_bytes and media. Repeated rows stay repeated, null ids stay, further
    columns are not read, an empty table gives an empty one."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col), F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"), to_flac(F.col(text_col)).alias("media"))


def blocks(stored: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each PCM block: id_col, sample_offset, pcm; a block can be sought by its offset. Rows with a null
    stream, and tables without rows, give none; repeated rows give their blocks as often."""
    read = stored.select(id_col, from_flac(F.col("media")).alias("r"))
    return read.select(id_col, F.explode("r.blocks").alias("b")).select(id_col, "b.sample_offset", "b.pcm")


def summary(stored: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Digests of what is read back from the PCM blocks of media, and of media."""
    read = stored.select(id_col, "n_bytes", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), from_flac(F.col("media")).alias("r"))
    read = read.select(id_col, "n_bytes", "media_bytes", "media_sha256", whole(F.col("r.blocks")).alias("pcm"), F.col("r.feature").alias("feature"))
    return read.select(
        id_col, "n_bytes", F.octet_length("pcm").cast("long").alias("payload_bytes"), F.sha2("pcm", 256).alias("payload_sha256"), F.crc32(F.substring("pcm", -PAD, PAD)).alias("tail_crc32"), "media_bytes", "media_sha256", "feature"
    )
