"""FLAC media columns (operator 4): mono streams of 8-bit samples, many frames at a time.

Frames are independent of each other, so the encoder and the decoder work on all
frames of a slab of rows at once: predictors and Rice codes are numpy passes over a
frame matrix, and the decoder follows all frames in step, one residual of each at a
time. Each frame has a seek point, so that any block can be read alone.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BLOCK = 1024
PAD = 64
SAMPLE_RATE = 8000
MAX_FIXED = 4
LPC_ORDER = 2
LPC_BITS = 12
#: Frames that are worked on at once, about this many samples.
SLAB_SAMPLES = 1 << 20
CONSTANT, VERBATIM, FIXED, LPC = 0, 1, 8, 32

_LEADING = np.array([16 - int(x).bit_length() for x in range(1 << 16)], dtype=np.int64)


def _crc_table(poly: int, bits: int, length: int) -> np.ndarray:
    """What each byte adds to a CRC when so many bytes follow it; the CRC is the exclusive or of them all."""
    top, mask = 1 << (bits - 1), (1 << bits) - 1
    one = []
    for b in range(256):
        c = b << (bits - 8)
        for _ in range(8):
            c = (c << 1 ^ poly if c & top else c << 1) & mask
        one.append(c)
    first = np.array(one, dtype=np.uint16)
    rows = [first]
    for _ in range(length - 1):
        c = rows[-1].astype(np.int64)
        rows.append(((c << 8 & mask) ^ first[c >> (bits - 8)].astype(np.int64)).astype(np.uint16))
    return np.stack(rows)


class _Crc:
    """Tables grow with the longest frame that was seen."""

    tables: dict[tuple[int, int], np.ndarray] = {}

    @classmethod
    def of(cls, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, poly: int, bits: int) -> np.ndarray:
        """CRCs of the stretches ``data[start : start + size]``, none of them empty."""
        longest = int(sizes.max(initial=1))
        table = cls.tables.get((poly, bits))
        if table is None or len(table) < longest:
            table = cls.tables[poly, bits] = _crc_table(poly, bits, max(longest, 32) + 64)
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1])) - np.repeat(ends - sizes - starts, sizes)
        left = np.repeat(starts + sizes - 1, sizes) - at
        return np.bitwise_xor.reduceat(table[left, data[at]], ends - sizes)


def crc8(data, starts, sizes):
    return _Crc.of(data, starts, sizes, 0x07, 8)


def crc16(data, starts, sizes):
    return _Crc.of(data, starts, sizes, 0x8005, 16)


class _Bits:
    """Fields of up to 32 bits, put at any bit positions that do not overlap."""

    def __init__(self):
        self.at, self.width, self.value = [], [], []

    def put(self, at, width, value) -> None:
        at = np.asarray(at, dtype=np.int64)
        self.at.append(at.ravel())
        self.width.append(np.broadcast_to(np.asarray(width, dtype=np.int64), at.shape).ravel())
        self.value.append(np.broadcast_to(np.asarray(value, dtype=np.int64), at.shape).ravel())

    def pack(self, n_bytes: int) -> np.ndarray:
        at, width, value = (np.concatenate(x) for x in (self.at, self.width, self.value))
        shifted = value.astype(np.uint64) << (64 - width - (at & 31)).astype(np.uint64)
        word, n = at >> 5, (n_bytes + 3 >> 2) + 2
        out = np.bincount(word, weights=(shifted >> np.uint64(32)).astype(np.float64), minlength=n)
        out[1:] += np.bincount(word, weights=(shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=n)[: n - 1]
        return np.frombuffer(out.astype(np.uint64).astype(">u4").tobytes(), dtype=np.uint8)[:n_bytes].copy()


def _lpc(x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised predictor coefficients per frame and their shifts, by autocorrelation and Levinson-Durbin."""
    p, wide = LPC_ORDER, x.astype(np.float64)
    r = np.stack([(wide[:, : x.shape[1] - j] * wide[:, j:]).sum(axis=1) for j in range(p + 1)], axis=1)
    r[:, 0] = r[:, 0] * (1 + 1e-9) + 1e-9
    a, error = np.zeros((len(x), p)), r[:, 0].copy()
    for i in range(p):
        k = (r[:, i + 1] - (a[:, :i] * r[:, i:0:-1]).sum(axis=1)) / error
        a[:, :i] -= k[:, None] * a[:, :i][:, ::-1].copy()
        a[:, i] = k
        error = np.maximum(error * (1 - k * k), 1e-9)
    top = np.abs(a).max(axis=1)
    shift = np.clip(LPC_BITS - 2 - np.ceil(np.log2(np.maximum(top, 1e-6))).astype(np.int64), 0, 15)
    limit = (1 << (LPC_BITS - 1)) - 1
    return np.clip(np.rint(a * (1 << shift)[:, None]), -limit, limit).astype(np.int64), shift


def encode_frames(x: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All frames as bytes one after another, and where each begins (one more entry for the end).

    ``x`` has a frame per row (int64 samples, zeros beyond its size), ``numbers`` the frame numbers.
    """
    n_frames, width = x.shape
    inside = np.arange(width) < sizes[:, None]
    # Candidates: fixed predictors of order 0 to 4 and one linear predictor; warm-up samples count no residual.
    best_cost = np.full(n_frames, np.iinfo(np.int64).max)
    best_kind = np.zeros(n_frames, dtype=np.int64)
    residual = np.zeros((n_frames, width), dtype=np.int32)
    coefficients, shifts = _lpc(x, sizes)
    difference = x.astype(np.int32)
    for kind in [*range(MAX_FIXED + 1), LPC]:
        if kind == LPC:
            order = LPC_ORDER
            guess = np.zeros((n_frames, width), dtype=np.int64)
            for j in range(order):
                guess[:, order:] += coefficients[:, j : j + 1] * x[:, order - 1 - j : width - 1 - j]
            difference = (x - (guess >> shifts[:, None])).astype(np.int32)
        else:
            order = kind
            if kind:
                difference = np.diff(difference, axis=1, prepend=np.int32(0))
        folded = np.where(inside, difference << 1 ^ difference >> 31, 0)
        folded[:, :order] = 0
        cost = folded.sum(axis=1, dtype=np.int64) + (30 * order if kind == LPC else 8 * order)
        better = (cost < best_cost) & (sizes > order)
        best_cost[better], best_kind[better] = cost[better], kind if kind == LPC else FIXED + kind
        residual[better] = folded[better]
    order = np.where(best_kind == LPC, LPC_ORDER, best_kind - FIXED)
    count = sizes - order
    coded = inside & (np.arange(width) >= order[:, None])
    mean = residual.sum(axis=1, dtype=np.int64) / np.maximum(count, 1)
    guess = np.log2(np.maximum(mean * 0.7, 1)).astype(np.int64)
    rice, rice_bits = np.zeros(n_frames, dtype=np.int64), np.full(n_frames, np.iinfo(np.int64).max)
    for step in (-1, 0, 1):
        k = np.clip(guess + step, 0, 14)
        bits = (residual >> k[:, None].astype(np.int32)).sum(axis=1, dtype=np.int64) + count * (k + 1)
        lower = bits < rice_bits
        rice[lower], rice_bits[lower] = k[lower], bits[lower]
    extra = np.where(best_kind == LPC, 4 + 5 + LPC_ORDER * LPC_BITS, 0)
    body = 8 * order + extra + 6 + 4 + rice_bits
    verbatim = 8 * sizes <= body
    constant = (np.where(inside, x, x[:, :1]) == x[:, :1]).all(axis=1)
    kind = np.where(constant, CONSTANT, np.where(verbatim, VERBATIM, np.where(best_kind == LPC, LPC + LPC_ORDER - 1, best_kind)))
    body = np.where(constant, 8, np.where(verbatim, 8 * sizes, body))

    number_bytes = np.select([numbers < 1 << 7, numbers < 1 << 11, numbers < 1 << 16, numbers < 1 << 21, numbers < 1 << 26], [1, 2, 3, 4, 5], 6)
    head_bytes = 4 + number_bytes + 2
    frame_bytes = head_bytes + 1 + (8 + body + 7 >> 3) + 2
    starts = np.concatenate([[0], np.cumsum(frame_bytes)])
    at = 8 * starts[:-1]
    bits = _Bits()
    # Sync code and fixed block size; block size at the head's end, sample rate as the stream says; mono, 8 bits.
    bits.put(at, 32, 0xFFF87002)
    for n in range(1, 7):
        own = number_bytes == n
        if not own.any():
            continue
        v, where = numbers[own], at[own] + 32
        lead = v if n == 1 else (0xFF << (8 - n) & 0xFF) | v >> 6 * (n - 1)
        bits.put(where, 8, lead)
        for j in range(1, n):
            bits.put(where + 8 * j, 8, 0x80 | (v >> 6 * (n - 1 - j) & 0x3F))
    bits.put(at + 32 + 8 * number_bytes, 16, sizes - 1)
    sub = at + 8 * (head_bytes + 1)
    bits.put(sub, 8, kind << 1)
    data_at = sub + 8
    byte = x & 0xFF
    bits.put(data_at[constant], 8, byte[constant, 0])
    plain = np.flatnonzero(verbatim & ~constant)
    if len(plain):
        row, column = np.nonzero(inside[plain])
        bits.put(data_at[plain][row] + 8 * column, 8, byte[plain][row, column])
    packed = np.flatnonzero(~verbatim & ~constant)
    if len(packed):
        for j in range(MAX_FIXED):
            warm = packed[order[packed] > j]
            bits.put(data_at[warm] + 8 * j, 8, byte[warm, j])
        cursor = data_at + 8 * order
        linear = packed[kind[packed] >= LPC]
        if len(linear):
            bits.put(cursor[linear], 4, LPC_BITS - 1)
            bits.put(cursor[linear] + 4, 5, shifts[linear])
            for j in range(LPC_ORDER):
                bits.put(cursor[linear] + 9 + LPC_BITS * j, LPC_BITS, coefficients[linear, j] & (1 << LPC_BITS) - 1)
        cursor = cursor + extra
        bits.put(cursor[packed], 6, 0)
        bits.put(cursor[packed] + 6, 4, rice[packed])
        mask = coded[packed]
        u = residual[packed][mask].astype(np.int64)
        k = np.repeat(rice[packed], mask.sum(axis=1))
        quotient = u >> k
        length = quotient + 1 + k
        ends = np.cumsum(length)
        first = np.concatenate([[0], np.cumsum(mask.sum(axis=1))])[:-1]
        begin = (ends - length) - np.repeat((ends - length)[first], mask.sum(axis=1)) + np.repeat(cursor[packed] + 10, mask.sum(axis=1))
        bits.put(begin + quotient, k + 1, 1 << k | u & (1 << k) - 1)
    data = bits.pack(int(starts[-1]))
    data[starts[:-1] + head_bytes] = crc8(data, starts[:-1], head_bytes)
    check = crc16(data, starts[:-1], frame_bytes - 2)
    data[starts[1:] - 2], data[starts[1:] - 1] = check >> 8, check & 0xFF
    return data, starts


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Bytes of the text, and the text's bytes with zeros up to a positive multiple of PAD."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + b"\0" * (-len(raw) % PAD or (0 if raw else PAD))


def encode_streams(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream per payload; payloads are not empty."""
    counts = np.array([-(-len(p) // BLOCK) for p in payloads], dtype=np.int64)
    out: list[list[bytes]] = [[] for _ in payloads]
    sizes_of: list[list[int]] = [[] for _ in payloads]
    todo = [(d, f) for d, n in enumerate(counts.tolist()) for f in range(n)]
    per_slab = max(1, SLAB_SAMPLES // BLOCK)
    for at in range(0, len(todo), per_slab):
        part = todo[at : at + per_slab]
        x = np.zeros((len(part), BLOCK), dtype=np.int64)
        sizes = np.zeros(len(part), dtype=np.int64)
        for row, (d, f) in enumerate(part):
            piece = np.frombuffer(payloads[d], dtype=np.uint8, count=min(BLOCK, len(payloads[d]) - f * BLOCK), offset=f * BLOCK)
            sizes[row] = len(piece)
            x[row, : len(piece)] = piece
            x[row, : len(piece)] -= 128
        data, starts = encode_frames(x, sizes, np.array([f for _, f in part], dtype=np.int64))
        blob, starts = data.tobytes(), starts.tolist()
        for row, (d, _) in enumerate(part):
            out[d].append(blob[starts[row] : starts[row + 1]])
            sizes_of[d].append(starts[row + 1] - starts[row])
    return [_stream(p, frames, sizes) for p, frames, sizes in zip(payloads, out, sizes_of, strict=True)]


def _stream(payload: bytes, frames: list[bytes], sizes: list[int]) -> bytes:
    # The sample digest of the format is over signed samples.
    signed = np.frombuffer(payload, dtype=np.uint8) ^ 0x80
    block = min(BLOCK, max(16, len(payload)))
    packed = SAMPLE_RATE << 44 | 0 << 41 | 7 << 36 | (len(payload) & (1 << 36) - 1)
    info = struct.pack(">HH", block, block) + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big") + packed.to_bytes(8, "big") + hashlib.md5(signed.tobytes()).digest()
    points = np.zeros(len(sizes), dtype=[("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")])
    points["sample"] = np.arange(len(sizes)) * BLOCK
    points["offset"] = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    points["n"] = np.minimum(BLOCK, len(payload) - points["sample"].astype(np.int64))
    seek = points.tobytes()
    return b"".join([b"fLaC", b"\x00", len(info).to_bytes(3, "big"), info, b"\x83", len(seek).to_bytes(3, "big"), seek, *frames])


def open_stream(media: bytes) -> dict:
    """Metadata of a stream: samples, digest, seek points (sample, offset from the first frame, count), place of the first frame."""
    if media[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, last, found = 4, False, {}
    while not last:
        head, n = media[at], int.from_bytes(media[at + 1 : at + 4], "big")
        last, body = bool(head & 0x80), media[at + 4 : at + 4 + n]
        if head & 0x7F == 0:
            packed = int.from_bytes(body[10:18], "big")
            found |= {"samples": packed & (1 << 36) - 1, "bits": (packed >> 36 & 31) + 1, "channels": (packed >> 41 & 7) + 1, "rate": packed >> 44, "md5": body[18:34]}
        elif head & 0x7F == 3:
            points = np.frombuffer(body, dtype=[("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")])
            found["seek"] = points[points["sample"] != (1 << 64) - 1]
        at += 4 + n
    return found | {"frames_at": at}


def decode_frames(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Samples (a frame per row, int32), frame sizes, subframe kinds, and whether both checksums of each frame hold."""
    raw = np.frombuffer(data, dtype=np.uint8)
    padded = data + b"\0" * 16
    window = np.ndarray(shape=(len(data) + 8,), dtype=">u8", buffer=padded, strides=(1,))

    def peek(at: np.ndarray) -> np.ndarray:
        """At least 57 bits from each bit position, left-aligned."""
        return window[at >> 3].astype(np.uint64) << (at & 7).astype(np.uint64)

    def field(at: np.ndarray, width) -> np.ndarray:
        return (peek(at) >> np.uint64(1) >> np.asarray(63 - np.asarray(width), dtype=np.uint64)).astype(np.int64)

    def signed(value: np.ndarray, width) -> np.ndarray:
        return value - ((value >> width - 1 & 1) << width)

    head = field(8 * starts, 32)
    if not ((head >> 16 & 0xFFFC) == 0xFFF8).all():
        raise ValueError("no frame where the seek table has one")
    lead = field(8 * starts + 32, 8)
    number_bytes = np.select([lead < 0x80, lead < 0xE0, lead < 0xF0, lead < 0xF8, lead < 0xFC, lead < 0xFE], [1, 2, 3, 4, 5, 6], 7)
    code = head >> 12 & 15
    at = starts + 4 + number_bytes
    sizes = np.select([code == 1, (code >= 2) & (code <= 5), code == 6, code == 7], [192, 576 << np.maximum(code - 2, 0), field(8 * at, 8) + 1, field(8 * at, 16) + 1], 256 << np.maximum(code - 8, 0))
    head_bytes = 4 + number_bytes + np.select([code == 6, code == 7], [1, 2], 0)
    good = crc8(raw, starts, head_bytes) == raw[starts + head_bytes]
    good &= crc16(raw, starts, ends - starts - 2) == (raw[ends - 2].astype(np.int64) << 8 | raw[ends - 1])
    n_frames, width = len(starts), int(sizes.max(initial=1))
    sub = 8 * (starts + head_bytes + 1)
    kind = field(sub, 8) >> 1 & 63
    cursor = sub + 8
    out = np.zeros((width, n_frames), dtype=np.int32)  # a column per frame: steps go down the rows
    flat = np.flatnonzero(kind == CONSTANT)
    out[:, flat] = signed(field(cursor[flat], 8), 8)
    for f in np.flatnonzero(kind == VERBATIM).tolist():
        a = int(cursor[f]) >> 3
        out[: sizes[f], f] = np.frombuffer(data, dtype=np.int8, count=int(sizes[f]), offset=a)
    order = np.where(kind >= LPC, kind - LPC + 1, np.where(kind >= FIXED, kind - FIXED, 0))
    predicted = np.flatnonzero(kind >= FIXED)
    if len(predicted):
        for j in range(int(order[predicted].max(initial=0))):
            warm = predicted[order[predicted] > j]
            out[j, warm] = signed(field(cursor[warm] + 8 * j, 8), 8)
        cursor = cursor + 8 * order
        linear = predicted[kind[predicted] >= LPC]
        coefficients, shifts = np.zeros((n_frames, 32), dtype=np.int64), np.zeros(n_frames, dtype=np.int64)
        if len(linear):
            precision = field(cursor[linear], 4) + 1
            shifts[linear] = signed(field(cursor[linear] + 4, 5), 5)
            for j in range(int(order[linear].max())):
                own = order[linear] > j
                coefficients[linear[own], j] = signed(field(cursor[linear[own]] + 9 + precision[own] * j, precision[own]), precision[own])
            cursor[linear] += 9 + precision * order[linear]
        _residuals(out, predicted, sizes, order, cursor, peek, field, signed)
        for p in np.unique(kind[predicted]).tolist():
            own = predicted[kind[predicted] == p]
            if p >= LPC:
                n, c = p - LPC + 1, coefficients[own].T
                block = out[:, own].astype(np.int64)
                for i in range(n, width):
                    guess = c[0] * block[i - 1]
                    for j in range(1, n):
                        guess += c[j] * block[i - 1 - j]
                    block[i] += guess >> shifts[own]
                out[:, own] = block
            elif p > FIXED:
                # Undoing differences is a running sum for each order, begun anew from the warm-up samples' own differences.
                n, block = p - FIXED, out[:, own].astype(np.int64)
                heads = [block[:n]]
                for _ in range(n - 1):
                    heads.append(np.diff(heads[-1], axis=0))
                for level in range(n - 1, -1, -1):
                    begin = heads[level][-1:]
                    block[n:] = np.cumsum(np.concatenate([begin, block[n:]]), axis=0)[1:]
                out[:, own] = block
    out[np.arange(width)[:, None] >= sizes] = 0
    return out.T, sizes, kind, good


def _residuals(out, frames, sizes, order, cursor, peek, field, signed) -> None:
    """Rice codes of all given frames in step, partition by partition, into ``out``."""
    method = field(cursor[frames], 2)
    parts = field(cursor[frames] + 2, 4)
    at = cursor[frames] + 6
    wide = np.where(method == 1, 5, 4)
    row = order[frames].copy()
    for part in range(1 << int(parts.max(initial=0))):
        live = part < 1 << parts
        count = np.where(live, (sizes[frames] >> parts) - (order[frames] if part == 0 else 0), 0)
        k = field(at, wide)
        escape = live & (k == np.where(method == 1, 31, 15))
        at = np.where(live, at + wide, at)
        raw_bits = np.where(escape, field(at, 5), 0)
        at = np.where(escape, at + 5, at)
        by_size = np.argsort(-count, kind="stable")
        a, k, r, f, raw, esc, c = at[by_size], k[by_size], row[by_size], frames[by_size], raw_bits[by_size], escape[by_size], count[by_size]
        more = -c
        any_escape = bool(esc.any())
        for step in range(int(c.max(initial=0))):
            n = int(np.searchsorted(more, -step, side="left"))
            p, kk = a[:n], k[:n]
            w = peek(p)
            q = _LEADING[(w >> np.uint64(48)).astype(np.int64)]
            if (q == 16).any():
                q, end = _long_unary(p, q, peek)
                low = peek(end)
            else:
                end = p + q + 1
                low = w << (q + 1).astype(np.uint64)
            u = q << kk | (low >> np.uint64(1) >> (63 - kk).astype(np.uint64)).astype(np.int64)
            nxt = end + kk
            value = u >> 1 ^ -(u & 1)
            if any_escape:
                e = esc[:n]
                value = np.where(e, np.where(raw[:n] > 0, signed(field(a[:n], raw[:n]), np.maximum(raw[:n], 1)), 0), value)
                nxt = np.where(e, a[:n] + raw[:n], nxt)
            out[r[:n] + step, f[:n]] = value
            a[:n] = nxt
        at[by_size] = a
        row = row + count


def _long_unary(at: np.ndarray, zeros: np.ndarray, peek) -> tuple[np.ndarray, np.ndarray]:
    """Zeros before the next one bit where some have 16 and more, and the position after that bit."""
    total, at, full = zeros.copy(), at + zeros, zeros == 16
    while full.any():
        more = np.where(full, _LEADING[(peek(at) >> np.uint64(48)).astype(np.int64)], 0)
        total, at, full = total + more, at + more, full & (more == 16)
    return total, at + 1


def decode_streams(media: list[bytes]) -> Iterator[tuple[int, int, int, np.ndarray, bool, int]]:
    """``(stream, block, sample offset, samples, checksums hold, subframe kind)`` of every frame, in order."""
    jobs = []
    for d, stream in enumerate(media):
        found = open_stream(stream)
        offsets = found["seek"]["offset"].astype(np.int64) + found["frames_at"]
        ends = [*offsets[1:].tolist(), len(stream)]
        jobs += [(d, f, s, a, b) for f, (s, a, b) in enumerate(zip(found["seek"]["sample"].astype(np.int64).tolist(), offsets.tolist(), ends, strict=True))]
    per_slab = max(1, SLAB_SAMPLES // BLOCK)
    for at in range(0, len(jobs), per_slab):
        part = jobs[at : at + per_slab]
        blob = b"".join(media[d][a:b] for d, _, _, a, b in part)
        ends = np.cumsum([b - a for *_, a, b in part])
        starts = np.concatenate([[0], ends[:-1]])
        samples, sizes, kinds, good = decode_frames(blob, starts, ends)
        for row, (d, f, s, _, _) in enumerate(part):
            yield d, f, s, samples[row, : sizes[row]], bool(good[row]), int(kinds[row])


def read_block(media: bytes, block: int) -> np.ndarray:
    """The samples of one block alone, through the seek table."""
    found = open_stream(media)
    offsets = [*(found["seek"]["offset"].astype(np.int64) + found["frames_at"]).tolist(), len(media)]
    piece = media[offsets[block] : offsets[block + 1]]
    samples, sizes, _, good = decode_frames(piece, np.array([0]), np.array([len(piece)]))
    if not good[0]:
        raise ValueError("a checksum of the frame does not hold")
    return samples[0, : sizes[0]]


def encode_media(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, media)``: every whole text as a FLAC stream of its padded bytes, byte 128 being silence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.pieces(batch):
                told = [payload_of(t) for t in piece.column(1).to_pylist()]
                media = encode_streams([p for _, p in told])
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array([n for n, _ in told], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    slim = common.pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_bytes long, media binary")


def decode_media(streams: DataFrame) -> DataFrame:
    """PCM blocks ``(doc_id, block, sample_offset, n_samples, pcm, checksums_hold)`` of a table with ``doc_id`` and ``media``; pcm is signed 8-bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.pieces(batch):
                ids = piece.column(0).to_pylist()
                rows = [(ids[d], f, s, len(x), x.astype(np.int8).tobytes(), good) for d, f, s, x, good, _ in decode_streams(piece.column(1).to_pylist())]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
                names = ["doc_id", "block", "sample_offset", "n_samples", "pcm", "checksums_hold"]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    slim = common.pick(streams, doc_id="doc_id", media="media")
    return slim.mapInArrow(run, "doc_id long, block long, sample_offset long, n_samples long, pcm binary, checksums_hold boolean")


DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_digests(streams: DataFrame) -> DataFrame:
    """Digests of the payloads read back from ``(doc_id, n_bytes, media)``, by the decoder.

    feature counts the frames and their kinds (constant, verbatim, fixed, linear) and
    tells the root mean square of the samples. A frame whose checksums do not hold is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.pieces(batch):
                media = piece.column(2).to_pylist()
                blocks: list[list[np.ndarray]] = [[] for _ in media]
                kinds = np.zeros((len(media), 4), dtype=np.int64)
                for d, _, _, x, good, kind in decode_streams(media):
                    if not good:
                        raise ValueError("a checksum of a frame does not hold")
                    blocks[d].append(x)
                    kinds[d, 3 if kind >= LPC else 2 if kind >= FIXED else kind] += 1
                rows = []
                for stream, found, kind in zip(media, blocks, kinds.tolist(), strict=True):
                    x = np.concatenate(found)
                    payload = (x + 128).astype(np.uint8).tobytes()
                    power = int((x.astype(np.int64) ** 2).sum())
                    rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-PAD:]), len(stream), hashlib.sha256(stream).hexdigest(), f"flac:{sum(kind)}:{','.join(map(str, kind))}:{(power / len(x)) ** 0.5:.3f}"))
                made = [pa.array([r[i] for r in rows], k) for i, k in enumerate([pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()])]
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), *made], [c.split()[0] for c in DIGESTS.split(", ")])

    return common.pick(streams, doc_id="doc_id", n_bytes="n_bytes", media="media").mapInArrow(run, DIGESTS)


def op4_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` stored as a FLAC stream, read back and digested.

    A null text is an empty one; an empty one is 64 zero bytes; null ids and repeated rows are carried, an empty table
    gives no row, extra columns are ignored. A very long text is one stream of many frames, worked on some thousand
    frames at a time. A frame whose checksums do not hold is an error: the stored form is not what was written.
    """
    streams = common.stage(encode_media(common.table(spark, sf_dir, "documents")), "flac", level=9)
    return media_digests(streams)
