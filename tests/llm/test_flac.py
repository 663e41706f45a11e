"""Exact round trips, a plain decoder written from the format's text, and damaged streams."""

import hashlib
import zlib

import numpy as np
import pytest

from ferrywright.llm import common, flac


class Reader:
    def __init__(self, data):
        self.bits, self.at = "".join(f"{b:08b}" for b in data), 0

    def u(self, n):
        self.at += n
        return int(self.bits[self.at - n : self.at], 2) if n else 0

    def s(self, n):
        v = self.u(n)
        return v - (1 << n) if v >> (n - 1) else v

    def unary(self):
        end = self.bits.index("1", self.at)
        n, self.at = end - self.at, end + 1
        return n


def crc(data, poly, width):
    c = 0
    for b in data:
        c ^= b << (width - 8)
        for _ in range(8):
            c = (c << 1 ^ poly if c >> (width - 1) else c << 1) & ((1 << width) - 1)
    return c


def plain_decode(stream):
    """Sequential decoder of mono 8-bit streams."""
    assert stream[:4] == b"fLaC"
    at, last = 4, 0
    while not last:
        last, n = stream[at] & 0x80, int.from_bytes(stream[at + 1 : at + 4], "big")
        if stream[at] & 0x7F == 0:
            info = stream[at + 4 : at + 4 + n]
        at += 4 + n
    out = []
    while at < len(stream):
        r = Reader(stream[at:])
        assert r.u(16) == 0xFFF8
        size_code, _ = r.u(4), r.u(4)
        assert r.u(8) == 2 and size_code == 7
        lead = r.u(8)
        for _ in range(0 if lead < 0x80 else f"{lead:08b}".index("0") - 1):
            assert r.u(2) == 2
            r.u(6)
        size = r.u(16) + 1
        assert crc(stream[at : at + r.at // 8], 0x07, 8) == r.u(8)
        assert r.u(1) == 0
        kind = r.u(6)
        assert r.u(1) == 0
        if kind == 0:
            x = [r.s(8)] * size
        elif kind == 1:
            x = [r.s(8) for _ in range(size)]
        else:
            order = kind - 31 if kind >= 32 else kind - 8
            x = [r.s(8) for _ in range(order)]
            c, shift = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]][order], 0
            if kind >= 32:
                width, shift = r.u(4) + 1, None
                shift = r.s(5)
                c = [r.s(width) for _ in range(order)]
            assert r.u(2) == 0
            parts = r.u(4)
            for p in range(1 << parts):
                k = r.u(4)
                for _ in range((size >> parts) - (order if p == 0 else 0)):
                    u = r.unary() << k
                    u |= r.u(k)
                    x.append((u >> 1 ^ -(u & 1)) + (sum(a * x[-1 - j] for j, a in enumerate(c)) >> shift))
        r.at += -r.at % 8
        assert crc(stream[at : at + r.at // 8], 0x8005, 16) == r.u(16)
        out += x
        at += r.at // 8
    payload = bytes(v + 128 for v in out)
    assert hashlib.md5(bytes(v & 0xFF for v in out)).digest() == info[18:34]
    return payload


def samples():
    rng = np.random.default_rng(0)
    t = np.arange(5000)
    sine = (128 + 100 * np.sin(t / 9) + rng.normal(0, 2, 5000)).clip(0, 255).astype(np.uint8)
    walk = (np.cumsum(rng.integers(-2, 3, 4096)) + 128).clip(0, 255).astype(np.uint8)
    ramp = (np.arange(3072) // 4 % 256).astype(np.uint8)
    return [
        b"\0" * 64, bytes(range(256)) * 4, rng.integers(0, 256, 2048, dtype=np.uint8).tobytes(), sine[:4992].tobytes(), walk.tobytes(), ramp.tobytes(), b"plain text of some words, repeated. " * 64,
        b"\x80" * 1500 + b"\xff" + b"\x80" * 35, b"a" * 1024 + b"b" * 64, (b"\x80" * 500 + b"\x00\xff" * 6) * 4,
    ]


@pytest.mark.parametrize("k", range(10))
def test_streams_against_a_plain_decoder(k):
    payload = samples()[k]
    payload += b"\0" * (-len(payload) % 64)
    stream = flac.encode_streams([payload])[0]
    assert plain_decode(stream) == payload
    blocks = [x for *_, x, good, _ in flac.decode_streams([stream]) if good]
    assert (np.concatenate(blocks) + 128).astype(np.uint8).tobytes() == payload


def test_all_kinds_of_frames_occur_and_blocks_can_be_read_alone(monkeypatch):
    monkeypatch.setattr(flac, "SLAB_SAMPLES", 3000)
    payloads = [p + b"\0" * (-len(p) % 64) for p in samples()]
    streams = flac.encode_streams(payloads)
    kinds, back = set(), {}
    for d, block, offset, x, good, kind in flac.decode_streams(streams):
        assert good and offset == block * flac.BLOCK
        kinds.add(3 if kind >= 32 else 2 if kind >= 8 else kind)
        back.setdefault(d, []).append(x)
        if block % 2:
            assert flac.read_block(streams[d], block).tolist() == x.tolist()
    assert kinds == {0, 1, 2, 3}
    assert [(np.concatenate(back[d]) + 128).astype(np.uint8).tobytes() for d in range(len(payloads))] == payloads


def test_long_frame_numbers():
    x = np.zeros((6, flac.BLOCK), dtype=np.int64)
    numbers = np.array([0, 127, 128, 2047, 2048, 70000])
    data, starts = flac.encode_frames(x, np.full(6, flac.BLOCK), numbers)
    assert flac.decode_frames(data.tobytes(), starts[:-1], starts[1:])[3].all()


def test_damage_is_noticed():
    stream = bytearray(flac.encode_streams([b"some text here, " * 40])[0])
    stream[-9] ^= 4
    with pytest.raises(ValueError):
        flac.read_block(bytes(stream), 0)


def test_partitions_and_escapes_of_other_encoders():
    """A hand-made frame: fixed order 1, two partitions, the second one escaped with 5 raw bits."""
    x = [3, 4, 6, 5, 1, 0, -1, 2] * 2
    bits = f"{0xFFF8:016b}" + "0111" + "0000" + f"{2:08b}" + "00000000" + f"{15:016b}"
    head = int(bits, 2).to_bytes(len(bits) // 8, "big")
    body = "0" + f"{9:06b}" + "0" + f"{x[0] & 255:08b}" + "00" + "0001" + "0010"
    d = [b - a for a, b in zip(x, x[1:])]
    for v in d[:7]:
        u = v * 2 if v >= 0 else -2 * v - 1
        body += "0" * (u >> 2) + "1" + f"{u & 3:02b}"
    body += "1111" + f"{5:05b}" + "".join(f"{v & 31:05b}" for v in d[7:])
    body += "0" * (-len(body) % 8)
    frame = head + bytes([crc(head, 7, 8)]) + int(body, 2).to_bytes(len(body) // 8, "big")
    frame += crc(frame, 0x8005, 16).to_bytes(2, "big")
    got, sizes, _, good = flac.decode_frames(frame, np.array([0]), np.array([len(frame)]))
    assert good[0] and got[0, : sizes[0]].tolist() == x


def test_table_and_edge_rows(spark, data):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "é😀" * 30000), (3, "same"), (3, "same"), (4, "x" * 64), (5, "x" * 63)]
    docs = common.table(spark, data, "documents").select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string")).selectExpr("doc_id", "text", "'z' as media", "1 as n_bytes")
    want = sorted((r.doc_id, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])) for r in docs.collect() for n, p in [flac.payload_of(r.text)] if r.doc_id is not None)
    streams = common.stage(flac.encode_media(docs), "test-flac")
    got = [tuple(r) for r in flac.media_digests(streams).collect()]
    assert sorted(g[:5] for g in got if g[0] is not None) == want and len(got) == docs.count()
    blocks = flac.decode_media(streams.where("doc_id = 3")).where("checksums_hold").orderBy("block").collect()
    assert len(blocks) == sum(-(-len(flac.payload_of(r.text)[1]) // flac.BLOCK) for r in docs.where("doc_id = 3").collect()) and {r.sample_offset % flac.BLOCK for r in blocks} == {0}
    assert flac.media_digests(flac.encode_media(docs.limit(0))).collect() == []
