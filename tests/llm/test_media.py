import hashlib
import zlib
from pathlib import Path

import numpy as np
import pytest

from mulberry.llm import media
from mulberry.llm.common import table, written


@pytest.mark.parametrize("blocks", [1, 5, 6, 7, 40, 700])
def test_payload_round_trip(blocks):
    payload = np.random.default_rng(blocks).integers(0, 256, 64 * blocks, dtype=np.uint8).tobytes()
    assert media.Jpeg(media.write_jpeg(payload)).payload() == payload


def test_symbol_by_symbol_reading_agrees(monkeypatch):
    payload = np.random.default_rng(2).integers(0, 256, 64 * 9, dtype=np.uint8).tobytes()
    stored = media.write_jpeg(payload)
    whole = media.Jpeg(stored)
    monkeypatch.setattr(media.Jpeg, "_whole", lambda *_: False)
    slow = media.Jpeg(stored)
    assert slow.payload() == payload and (slow.rgb() == whole.rgb()).all()


class Writer:
    """A plain progressive encoder of one component: runs, end-of-band runs, refinement of zero and non-zero coefficients."""

    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [value >> i & 1 for i in range(n - 1, -1, -1)]

    def symbol(self, s):
        self.put(s, 8)  # every symbol below 255 has its own value as its code of 8 bits

    def number(self, v):
        size = abs(v).bit_length()
        self.put(v if v >= 0 else v + (1 << size) - 1, size)


TABLE = (list(range(255)), [8] * 255)


def halved(v, n):
    return (abs(v) >> n) * (1 if v >= 0 else -1)


def encode(blocks, width, height):
    out = [b"\xff\xd8", media._segment(0xDB, b"\0" + bytes(range(1, 65))), media._segment(0xC2, b"\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([1, 1, 0x11, 0])), media._huffman(0, 0, TABLE), media._huffman(1, 0, TABLE)]
    w, before = Writer(), 0
    for b in blocks:
        now = int(b[0]) >> 1
        w.symbol(abs(now - before).bit_length())
        w.number(now - before)
        before = now
    out.append(media._scan(1, 0, 0, 0, 1, 0, 0, np.array(w.bits, np.uint8)))
    for start, stop in ((1, 5), (6, 63)):
        w, ended = Writer(), 0

        def flush():
            nonlocal ended
            if ended:
                n = ended.bit_length() - 1
                w.symbol(n << 4)
                w.put(ended - (1 << n), n)
                ended = 0

        for b in blocks:
            own = [halved(int(v), 1) for v in b[start : stop + 1]]
            last = max((i for i, v in enumerate(own) if v), default=-1)
            run = 0
            if last >= 0:
                flush()
            for v in own[: last + 1]:
                if not v:
                    run += 1
                    continue
                while run > 15:
                    w.symbol(0xF0)
                    run -= 16
                w.symbol(run << 4 | abs(v).bit_length())
                w.number(v)
                run = 0
            if last + 1 < len(own):
                ended += 1
        flush()
        out.append(media._scan(1, start, stop, 0, 1, 0, 0, np.array(w.bits, np.uint8)))
    w = Writer()
    for b in blocks:
        w.put(int(b[0]) & 1, 1)
    out.append(media._scan(1, 0, 0, 1, 0, 0, 0, np.array(w.bits, np.uint8)))
    w = Writer()
    for b in blocks:
        own = [int(v) for v in b[1:]]
        last = max((i for i, v in enumerate(own) if abs(v) == 1), default=-1)
        run, waiting = 0, []
        for v in own[: last + 1]:
            if abs(v) > 1:
                waiting.append(abs(v) & 1)
            elif v:
                w.symbol(run << 4 | 1)
                w.put(int(v > 0), 1)
                for bit in waiting:
                    w.put(bit, 1)
                run, waiting = 0, []
            elif run == 15:
                w.symbol(0xF0)
                for bit in waiting:
                    w.put(bit, 1)
                run, waiting = 0, []
            else:
                run += 1
        waiting += [abs(v) & 1 for v in own[last + 1 :] if abs(v) > 1]
        if last + 1 < len(own):
            w.symbol(0)
            for bit in waiting:
                w.put(bit, 1)
    out.append(media._scan(1, 1, 63, 1, 0, 0, 0, np.array(w.bits, np.uint8)))
    return b"".join([*out, b"\xff\xd9"])


def test_ordinary_progressive_file():
    rng = np.random.default_rng(5)
    blocks = np.zeros((12, 64), np.int64)
    blocks[:, 0] = rng.integers(-200, 200, 12)
    for b in blocks[:9]:
        at = rng.choice(np.arange(1, 64), rng.integers(1, 30), replace=False)
        b[at] = rng.integers(-9, 10, len(at))
    image = media.Jpeg(encode(blocks, 30, 21))
    assert image.parts[1].blocks.reshape(-1, 64).tolist() == blocks.tolist()
    rgb = image.rgb()
    assert rgb.shape == (21, 30, 3)
    # the transform, straight from its definition
    quantised = blocks * np.arange(1, 65)
    freq = np.zeros((12, 64))
    freq[:, media.zigzag()] = quantised
    k = np.arange(8)
    basis = np.cos((2 * k[None] + 1) * k[:, None] * np.pi / 16) * np.where(k == 0, np.sqrt(0.125), 0.5)[:, None]
    plane = np.einsum("nuv,uy,vx->nyx", freq.reshape(12, 8, 8), basis, basis).reshape(3, 4, 8, 8).transpose(0, 2, 1, 3).reshape(24, 32) + 128
    assert np.abs(np.clip(plane, 0, 255)[:21, :30] - rgb[:, :, 0]).max() <= 0.51


def test_other_files_are_refused():
    for bad in (b"", b"GIF89a", b"\xff\xd8" + media._segment(0xC0, b"\x08" + bytes(12))):
        with pytest.raises((ValueError, IndexError)):
            media.Jpeg(bad)


def test_odd_documents(odd, none):
    got = media.digests(media.to_media(odd)).collect()
    by_text = {}
    texts = sorted((r["doc_id"] or -1, (r["text"] or "").encode()) for r in odd.collect())
    assert len(got) == len(texts)
    expected = sorted((i, len(t), hashlib.sha256(p := media.padded(t)).hexdigest(), zlib.crc32(p[-64:]), len(p)) for i, t in texts)
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["payload_sha256"], r["tail_crc32"], r["payload_bytes"]) for r in got) == expected
    for r in got:
        assert by_text.setdefault((r["payload_sha256"], r["n_bytes"]), (r["media_sha256"], r["feature"])) == (r["media_sha256"], r["feature"])
    tensor = media.to_tensors(media.to_media(odd.where("doc_id = 1003"))).first()
    assert len(tensor["rgb"]) == tensor["height"] * tensor["width"] * 3
    assert media.digests(media.to_media(none)).count() == 0


def test_query(llm, sf_dir):
    import hashlib
    import zlib

    texts = {r["doc_id"]: (r["text"] or "").encode() for r in llm.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = media.query(llm, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        payload = texts[r["doc_id"]]
        payload += bytes(-len(payload) % 64 if payload else 64)
        stored = media.write_jpeg(payload)
        rgb = media.Jpeg(stored).rgb()
        means = [float(rgb[:, :, k].astype(float).mean()) for k in range(3)]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(texts[r["doc_id"]]), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
        size, red, green, blue, crc = r["feature"].split(" ")
        assert size == f"{rgb.shape[1]}x{rgb.shape[0]}" and crc == f"crc={zlib.crc32(rgb.tobytes()):08x}"
        assert all(abs(float(x[2:]) - m) < 1e-3 for x, m in zip((red, green, blue), means, strict=True))


def test_stored_texts_take_less_than_their_payload(llm, sf_dir):
    """Each coefficient takes 9 bits of a file at most, and files of texts are compressed where they are stored."""
    payload = bytes(range(256)) * 96
    assert len(media.write_jpeg(payload)) < 9.1 / 8 * len(payload) + 600
    docs = table(llm, sf_dir, "documents")
    stored = written(media.to_media(docs), "test-media", "zstd")
    size = sum(f.stat().st_size for f in Path(stored._mulberry_path.removeprefix("file://")).glob("*.parquet"))
    assert size < 0.8 * docs.selectExpr("sum(octet_length(text))").first()[0]
