import hashlib
import random
import zlib

import numpy as np

from strandline.llm import jpeg, media


def test_round_trip_both_ways_of_decoding():
    r = random.Random(1)
    for n in (64, 384, 448, 64 * 37):
        data = bytes(r.choices([0, 1, 32, 97, 254, 255], k=n))
        stream = jpeg.write(data)
        quick, slow = jpeg.read(stream), jpeg.read(stream, quick=False)
        assert jpeg.payload(quick) == jpeg.payload(slow) == data
        assert quick.pixels().shape == (quick.height, quick.width, 3)


def huffman(symbols):
    """Eight-bit codes for every symbol: a plain table."""
    order = sorted(set(symbols))
    return jpeg._table(0x10, {8: order}), {s: (i, 8) for i, s in enumerate(order)}


def plain_stream(blocks, runs):
    """A one-component stream of small coefficients, written symbol by symbol: DC, two bands, one refinement."""

    def pack(items):
        bits = "".join(f"{v:0{n}b}" for v, n in items if n)
        bits += "1" * (-len(bits) % 8)
        return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))

    def size(v):
        return abs(v).bit_length()

    def extra(v):
        return (v if v > 0 else v + (1 << size(v)) - 1, size(v))

    rows, cols, _ = blocks.shape
    flat = blocks.reshape(-1, 64)
    shifted = np.where(flat[:, 1:] >= 0, flat[:, 1:] >> 1, -(-flat[:, 1:] >> 1))
    every = [s << 4 | z for s in range(16) for z in range(0, 11)] + [0xF0, *[k << 4 for k in range(15)]]
    ac, code = huffman(every)
    dc = jpeg._table(0x00, {4: list(range(12))})
    out = [b"\xff\xd8", jpeg._segment(0xDB, b"\x00" + b"\x01" * 64), jpeg._segment(0xC4, dc + ac), jpeg._segment(0xC2, bytes([8]) + (8 * rows).to_bytes(2, "big") + (8 * cols).to_bytes(2, "big") + bytes([1, 1, 0x11, 0]))]
    items, last = [], 0
    for v in flat[:, 0]:
        d, last = int(v) - last, int(v)
        items += [(size(d), 4), extra(d) if d else (0, 0)]
    out.append(jpeg._scan(((1, 0, 0),), 0, 0, 0, 0, pack(items)))

    def end(pending, items):
        while pending:
            k = min(pending.bit_length() - 1, 14) if runs else 0
            items += [code[k << 4], (pending - (1 << k), k)] if pending < 2 << k else [code[k << 4], ((1 << k) - 1, k)]
            pending -= min(pending, (2 << k) - 1) if pending >= 2 << k else pending
        return 0

    for first, stop in ((1, 5), (6, 63)):
        items, pending = [], 0
        for b in shifted[:, first - 1 : stop]:
            zeros = 0
            for v in map(int, b):
                if not v:
                    zeros += 1
                    continue
                pending = end(pending, items)
                while zeros > 15:
                    items.append(code[0xF0])
                    zeros -= 16
                items += [code[zeros << 4 | size(v)], extra(v)]
                zeros = 0
            if zeros:
                pending += 1
                if not runs:
                    pending = end(pending, items)
        end(pending, items)
        out.append(jpeg._scan(((1, 0, 0),), first, stop, 0, 1, pack(items)))
    items = []
    for full, old in zip(flat[:, 1:], shifted, strict=True):  # refinement, an end in each block
        zeros, buffered = 0, []
        newest = max([k for k in range(63) if full[k] and not old[k]], default=-1)
        for k in range(63):
            v, o = int(full[k]), int(old[k])
            while zeros > 15 and k <= newest:
                items += [code[0xF0], *buffered]
                zeros, buffered = 0, []
            if o:
                buffered.append((abs(v) & 1, 1))
            elif v:
                items += [code[zeros << 4 | 1], (int(v > 0), 1), *buffered]
                zeros, buffered = 0, []
            else:
                zeros += 1
        if zeros or buffered:
            items += [code[0], *buffered]
    out.append(jpeg._scan(((1, 0, 0),), 1, 63, 1, 0, pack(items)))
    return b"".join([*out, b"\xff\xd9"])


def test_general_streams():
    r = np.random.default_rng(2)
    for share in (0.02, 0.2, 0.9):
        blocks = r.integers(-40, 41, (4, 5, 64)) * (r.random((4, 5, 64)) < share)
        for runs in (False, True):
            frame = jpeg.read(plain_stream(blocks, runs))
            assert (frame.coefficients[0] == blocks).all()


def test_pixels_by_the_definition():
    stream = jpeg.write(bytes(range(64)) * 6)
    frame = jpeg.read(stream)
    block, want = frame.coefficients[0][0, 0], np.zeros((8, 8))
    for place, value in zip(jpeg.ZIGZAG, block, strict=True):
        v, u = divmod(int(place), 8)
        scale = (np.sqrt(0.5) if u == 0 else 1) * (np.sqrt(0.5) if v == 0 else 1) / 4
        want += value * scale * np.outer(np.cos((2 * np.arange(8) + 1) * v * np.pi / 16), np.cos((2 * np.arange(8) + 1) * u * np.pi / 16))
    assert np.allclose((block.astype(float) @ jpeg.inverse()).reshape(8, 8), want)
    assert list(jpeg.ZIGZAG[:6]) == [0, 1, 8, 16, 9, 2]


def test_another_decoder_reads_the_streams(spark):
    """The Java library's decoder gives the same grey picture, but for its rounding; its chroma is smoother than repetition, so of a coloured one only the size is compared."""
    r = np.random.default_rng(5)
    image = spark._jvm.javax.imageio.ImageIO
    streams = [(jpeg.write(bytes(range(32, 128)) * 20), True), (plain_stream(r.integers(-9, 10, (3, 4, 64)), True), False)]
    for stream, coloured in streams:
        picture = image.read(spark._jvm.java.io.ByteArrayInputStream(stream))
        frame = jpeg.read(stream)
        rgb = frame.pixels()
        assert (picture.getHeight(), picture.getWidth()) == rgb.shape[:2]
        if not coloured:
            flat = np.array([picture.getRaster().getSample(x, y, 0) for y in range(rgb.shape[0]) for x in range(rgb.shape[1])]).reshape(rgb.shape[:2])
            assert np.abs(flat - rgb[..., 0].astype(int)).max() <= 2


def test_whole_table(spark):
    texts = [None, "", "é" * 31 + "ab", "x" * 64, "plain text " * 500, "\x00\xffĀ", "plain text " * 500]
    df = spark.createDataFrame([(i, t, "m", 3) for i, t in enumerate(texts)] + [(None, "n", "m", 3)], "doc_id long, text string, media string, height int")
    rows = {r.doc_id: r for r in media.media(df, ["doc_id"]).collect()}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        want = data + bytes(-len(data) % 64 if data else 64)
        assert (rows[i].n_bytes, bytes(rows[i].payload)) == (len(data), want)
        assert len(rows[i].rgb) == rows[i].height * rows[i].width * 3
        assert jpeg.payload(jpeg.read(bytes(rows[i].media))) == want
    assert rows[4][2:] == rows[6][2:] and rows[None].n_bytes == 1
    assert media.media(spark.createDataFrame([], "doc_id long, text string"), ["doc_id"]).count() == 0
    assert hashlib.sha256(rows[4].media).digest() == hashlib.sha256(rows[6].media).digest() and zlib.crc32(rows[0].payload[-64:]) == zlib.crc32(bytes(64))
