"""Progressive JPEG streams in numpy: scans accumulate into coefficient arrays.

``write`` stores bytes without loss as quantised coefficients (the format's own unit; the pixels of a JPEG
are not lossless). A byte b becomes the coefficient 256 + b, so that every coefficient has the same
number of bits: the first scan of a component sends all but the last two with a Huffman table of
one code, and two refinement scans send one bit each; DC coefficients go by nine bit planes. The entropy
data then have a fixed width and both directions are array operations.

``read`` takes any progressive stream of 8-bit samples with one or three components: Huffman tables,
spectral selection, successive approximation, runs of empty blocks and restart intervals. Scans of fixed
width are decoded as arrays, others symbol by symbol.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import lru_cache

import numpy as np

UNIT = 64
_MARK = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")
_RESTART = re.compile(rb"\xff[\xd0-\xd7]")
SAMPLING = ((2, 2), (1, 1), (1, 1))


def zigzag() -> np.ndarray:
    """Row-major place of each coefficient of the scan order: diagonals, turning."""
    cells = sorted(((y, x) for y in range(8) for x in range(8)), key=lambda c: (sum(c), c[0] if sum(c) % 2 else c[1]))
    return np.array([8 * y + x for y, x in cells])


ZIGZAG = zigzag()


@lru_cache(1)
def inverse() -> np.ndarray:
    """Pixels of a block from its coefficients in scan order, as a matrix."""
    k = np.arange(8)
    one = np.cos((2 * k[None, :] + 1) * k[:, None] * np.pi / 16) * np.where(k, 0.5, np.sqrt(0.125))[:, None]
    return np.kron(one, one)[ZIGZAG]


def _segment(marker: int, body: bytes) -> bytes:
    return bytes((0xFF, marker)) + (len(body) + 2).to_bytes(2, "big") + body


def _table(kind: int, codes: dict[int, list[int]]) -> bytes:
    return bytes([kind, *[len(codes.get(n, ())) for n in range(1, 17)], *[s for n in sorted(codes) for s in codes[n]]])


def _scan(parts: tuple, first: int, last: int, high: int, low: int, data: bytes) -> bytes:
    """parts: component, DC table, AC table."""
    head = bytes([len(parts), *[x for c, dc, ac in parts for x in (c, dc << 4 | ac)], first, last, high << 4 | low])
    return _segment(0xDA, head) + data.replace(b"\xff", b"\xff\x00")


@lru_cache(1)
def _tables() -> bytes:
    return _segment(0xDB, bytes([0]) + b"\x01" * 64) + _segment(0xC4, _table(0x00, {1: [0], 2: [1]}) + _table(0x10, {1: [7]}) + _table(0x11, {1: [0]}))


def in_units(high: int, wide: int) -> np.ndarray:
    """The order in which interleaved scans take the blocks of the three components, which stand one after another, row by row."""
    n = high * wide
    luma = np.arange(4 * n).reshape(high, 2, wide, 2).transpose(0, 2, 1, 3).reshape(n, 4)
    return np.concatenate((luma, (4 * n + np.arange(n))[:, None], (5 * n + np.arange(n))[:, None]), axis=1).reshape(-1)


def write(payload: bytes) -> bytes:
    """A stream that holds the payload, a positive multiple of 64 bytes."""
    need = -(-len(payload) // (6 * UNIT))
    wide = int(np.ceil(np.sqrt(need)))
    high = -(-need // wide)
    n = high * wide
    blocks = np.zeros((6 * n, 64), np.uint8)
    blocks.reshape(-1)[: len(payload)] = np.frombuffer(payload, np.uint8)
    frame = bytes([8]) + (16 * high).to_bytes(2, "big") + (16 * wide).to_bytes(2, "big") + bytes([3, *[x for c, (h, v) in enumerate(SAMPLING, 1) for x in (c, h << 4 | v, 0)]])
    out = [b"\xff\xd8", _segment(0xFE, len(payload).to_bytes(8, "big")), _tables(), _segment(0xC2, frame)]
    every = tuple((c, 0, 0) for c in (1, 2, 3))
    bits = np.ones(-(-(6 * n + 6) // 8) * 8, np.uint8)
    # the first coefficients are all 256 and more: 1 after the first shift, so each component has one difference of 1
    heads = np.zeros(6 * n, np.int64)
    heads[[0, 4, 5]] = 1
    at = np.arange(6 * n) + 2 * (np.cumsum(heads) - heads)
    bits[at] = heads
    for k in at[[0, 4, 5]]:
        bits[k : k + 3] = (1, 0, 1)
    out.append(_scan(every, 0, 0, 0, 8, np.packbits(bits[: -(-(6 * n + 6) // 8) * 8]).tobytes()))
    planes = np.ones((8, -(-6 * n // 8) * 8), np.uint8)
    planes[:, : 6 * n] = np.unpackbits(blocks[in_units(high, wide), 0][None, :], axis=0)
    for k, row in enumerate(np.packbits(planes, axis=1)):
        out.append(_scan(every, 0, 0, 8 - k, 7 - k, row.tobytes()))
    first = (blocks[:, 1:] >> 2) | 0x40
    later = []
    for shift in (1, 0):
        plane = (blocks >> shift) & 1
        plane[:, 0] = 0
        later.append(np.packbits(plane, axis=1))
    spans = [(1, 0, 4 * n), (2, 4 * n, 5 * n), (3, 5 * n, 6 * n)]
    out += [_scan(((c, 0, 0),), 1, 63, 0, 2, first[a:b].tobytes()) for c, a, b in spans]
    for k, plane in enumerate(later):
        out += [_scan(((c, 0, 1),), 1, 63, 2 - k, 1 - k, plane[a:b].tobytes()) for c, a, b in spans]
    return b"".join([*out, b"\xff\xd9"])


@lru_cache(64)
def codes_of(counts: bytes, symbols: bytes) -> "Codes":
    return Codes(counts, symbols)


class Codes:
    """A Huffman table."""

    def __init__(self, counts: bytes, symbols: bytes):
        self.of, code, k = {}, 0, 0
        for n, count in enumerate(counts, 1):
            for _ in range(count):
                self.of[n, code] = symbols[k]
                code, k = code + 1, k + 1
            code <<= 1
        self.only = symbols[0] if len(self.of) == 1 and (1, 0) in self.of else None


class Bits:
    def __init__(self, data: bytes):
        self.bits, self.at = np.unpackbits(np.frombuffer(data, np.uint8)), 0

    def take(self, n: int) -> int:
        value = 0
        for b in self.bits[self.at : self.at + n].tolist():
            value = value << 1 | b
        self.at += n
        return value

    def symbol(self, codes: Codes) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | int(self.bits[self.at])
            self.at += 1
            if (n, code) in codes.of:
                return codes.of[n, code]
        raise ValueError("no such code")

    def signed(self, n: int) -> int:
        value = self.take(n)
        return value if n == 0 or value >> (n - 1) else value - (1 << n) + 1


@lru_cache(512)
def scan_order(height: int, width: int, sampling: tuple, members: tuple) -> tuple[np.ndarray, np.ndarray]:
    most_h, most_v = max(h for h, _ in sampling), max(v for _, v in sampling)
    high, wide = -(-height // (8 * most_v)), -(-width // (8 * most_h))
    base = np.cumsum([0, *[high * v * wide * h for h, v in sampling]])
    which, block = [], []
    for m, c in enumerate(members):
        h, v = sampling[c]
        grid = base[c] + np.arange(high * v * wide * h).reshape(high * v, wide * h)
        if len(members) == 1:
            grid = grid[: -(-(-(-height * v // most_v)) // 8), : -(-(-(-width * h // most_h)) // 8)].reshape(-1, 1)
        else:
            grid = grid.reshape(high, v, wide, h).transpose(0, 2, 1, 3).reshape(high * wide, -1)
        block.append(grid)
        which.append(np.full(grid.shape, m))
    return np.concatenate(which, axis=1).reshape(-1), np.concatenate(block, axis=1).reshape(-1)


class Frame:
    """What ``read`` gives: coefficients of each component in scan order, and how to make pixels of them."""

    def __init__(self, body: bytes):
        self.height, self.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
        self.parts = [tuple(body[6 + 3 * i : 9 + 3 * i]) for i in range(body[5])]
        self.h, self.v = [p[1] >> 4 for p in self.parts], [p[1] & 15 for p in self.parts]
        self.high, self.wide = -(-self.height // (8 * max(self.v))), -(-self.width // (8 * max(self.h)))
        sizes = [self.high * v * self.wide * h for h, v in zip(self.h, self.v, strict=True)]
        self.base = np.cumsum([0, *sizes])
        self.blocks = np.zeros((self.base[-1], 64), np.int32)  # of all components, one after another
        self.coefficients = [self.blocks[a : a + n].reshape(self.high * v, self.wide * h, 64) for a, n, h, v in zip(self.base, sizes, self.h, self.v, strict=False)]
        self.quant: dict[int, np.ndarray] = {}
        self.note = b""

    def order(self, members: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The blocks of a scan in order: which member, and which of all blocks."""
        return scan_order(self.height, self.width, tuple(zip(self.h, self.v, strict=True)), tuple(members))

    def pixels(self) -> np.ndarray:
        """The full-resolution RGB tensor: inverse transform, chroma upsampled by repetition."""
        planes = []
        for c, (coefficients, part) in enumerate(zip(self.coefficients, self.parts, strict=True)):
            rows, cols, _ = coefficients.shape
            flat = (coefficients * self.quant[part[2]]).reshape(-1, 64).astype(np.float64) @ inverse()
            plane = np.clip(np.floor(flat + 128.5 + 1e-6), 0, 255).reshape(rows, cols, 8, 8).transpose(0, 2, 1, 3).reshape(8 * rows, 8 * cols)
            up, across = max(self.v) // self.v[c], max(self.h) // self.h[c]
            planes.append(plane.repeat(up, axis=0).repeat(across, axis=1)[: self.height, : self.width])
        if len(planes) == 1:
            planes *= 3
            return np.stack(planes, axis=-1).astype(np.uint8)
        y, b, r = planes[0], planes[1] - 128, planes[2] - 128
        rgb = np.stack((y + 1.402 * r, y - 0.344136 * b - 0.714136 * r, y + 1.772 * b), axis=-1)
        return np.clip(np.floor(rgb + 0.5 + 1e-6), 0, 255).astype(np.uint8)


def _dc_first(frame, members, tables, low, segments, interval):
    which, block = frame.order(members)
    per_unit = sum(frame.h[c] * frame.v[c] for c in members) if len(members) > 1 else 1
    k = 0
    for data in segments:
        stop = min(len(which), k + interval * per_unit) if interval else len(which)
        bits, diff, i = Bits(data), np.zeros(stop - k, np.int64), 0
        quick = all(t.of.get((1, 0)) == 0 for t in tables)
        ones = np.flatnonzero(bits.bits).tolist() if quick else []
        while i < stop - k:
            if quick:  # a zero bit is a difference of zero: go on to the next one
                j = bisect_left(ones, bits.at)
                skip = min(stop - k - i, ones[j] - bits.at if j < len(ones) else stop - k - i)
                bits.at, i = bits.at + skip, i + skip
                if i == stop - k:
                    break
            diff[i] = bits.signed(bits.symbol(tables[which[k + i]]))
            i += 1
        for m in range(len(members)):
            own = which[k:stop] == m
            frame.blocks[block[k:stop][own], 0] = np.cumsum(diff[own]) << low
        k = stop


def _dc_again(frame, members, low, segments, interval):
    block = frame.order(members)[1]
    per_unit = sum(frame.h[c] * frame.v[c] for c in members) if len(members) > 1 else 1
    k = 0
    for data in segments:
        stop = min(len(block), k + interval * per_unit) if interval else len(block)
        frame.blocks[block[k:stop], 0] |= np.unpackbits(np.frombuffer(data, np.uint8))[: stop - k].astype(np.int32) << low
        k = stop


def _run(index: np.ndarray):
    """index, as a slice where its blocks follow one another."""
    return slice(index[0], index[-1] + 1) if index[-1] - index[0] + 1 == len(index) else index


def _ac_first(blocks, index, codes, first, last, low, data, quick=True):
    n, band = len(index), last - first + 1
    if quick and codes.only is not None and codes.only and codes.only < 16:  # every coefficient has the same width
        size = codes.only
        if size == 7:
            values = (np.frombuffer(data, np.uint8)[: n * band] & 0x7F).astype(np.int32)
        else:
            values = np.unpackbits(np.frombuffer(data, np.uint8))[: n * band * (1 + size)].reshape(-1, 1 + size).astype(np.int32) @ (1 << np.arange(size, -1, -1))
        values = np.where(values >> (size - 1), values, values - (1 << size) + 1) << low
        blocks[_run(index), first : last + 1] = values.reshape(n, band)
        return
    bits, run = Bits(data), 0
    for b in index:
        if run:
            run -= 1
            continue
        k = first
        while k <= last:
            symbol = bits.symbol(codes)
            zeros, size = symbol >> 4, symbol & 15
            if size:
                k += zeros
                blocks[b, k] = bits.signed(size) * (1 << low)
                k += 1
            elif zeros == 15:
                k += 16
            else:
                run = (1 << zeros) + bits.take(zeros) - 1
                break


def _ac_again(blocks, index, codes, first, last, low, data, quick=True):
    n, band = len(index), last - first + 1
    own = blocks[_run(index), first : last + 1]
    if quick and codes.only == 0 and own.all():  # nothing becomes nonzero: a code and a bit for each coefficient
        bits = np.unpackbits(np.frombuffer(data, np.uint8))[: n * (1 + band)].reshape(n, 1 + band)[:, 1:].astype(np.int32) << low
        blocks[_run(index), first : last + 1] = own + bits * np.sign(own)
        return
    bits, run = Bits(data), 0

    def correct(b, k):
        if bits.take(1):
            blocks[b, k] += (1 << low) if blocks[b, k] > 0 else -(1 << low)

    for b in index:
        k = first
        if not run:
            while k <= last:
                symbol = bits.symbol(codes)
                zeros, size = symbol >> 4, symbol & 15
                if not size and zeros < 15:
                    run = (1 << zeros) + bits.take(zeros)
                    break
                new = (1 if bits.take(1) else -1) * (1 << low) if size else 0
                while k <= last:
                    if blocks[b, k]:
                        correct(b, k)
                    elif zeros:
                        zeros -= 1
                    else:
                        blocks[b, k] = new
                        k += 1
                        break
                    k += 1
        if run:
            for j in range(k, last + 1):
                if blocks[b, j]:
                    correct(b, j)
            run -= 1


def read(stream: bytes, quick: bool = True) -> Frame:
    at, dc, ac, quant, frame, interval, note = 2, {}, {}, {}, None, 0, b""
    while True:
        marker, at = stream[at + 1], at + 2
        if marker == 0xD9:
            frame.quant, frame.note = quant, note
            return frame
        size = int.from_bytes(stream[at : at + 2], "big")
        body, at = stream[at + 2 : at + size], at + size
        if marker == 0xDB:
            while body:
                wide = 1 + (body[0] >> 4)
                quant[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * wide], ">u2" if wide == 2 else np.uint8).astype(np.int32)
                body = body[1 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                (ac if body[0] >> 4 else dc)[body[0] & 15] = codes_of(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xC2:
            frame = Frame(body)
        elif marker == 0xDD:
            interval = int.from_bytes(body, "big")
        elif marker == 0xFE:
            note = body
        elif marker == 0xDA:
            end = _MARK.search(stream, at).start()
            segments = [s.replace(b"\xff\x00", b"\xff") for s in (_RESTART.split(stream[at:end]) if interval else [stream[at:end]])]
            at, n = end, body[0]
            ids = {p[0]: i for i, p in enumerate(frame.parts)}
            members = [ids[body[1 + 2 * i]] for i in range(n)]
            chosen = [body[2 + 2 * i] for i in range(n)]
            first, last, high, low = body[1 + 2 * n], body[2 + 2 * n], body[3 + 2 * n] >> 4, body[3 + 2 * n] & 15
            if first == 0 and high:
                _dc_again(frame, members, low, segments, interval)
            elif first == 0:
                _dc_first(frame, members, [dc[t >> 4] for t in chosen], low, segments, interval)
            else:
                index = frame.order(members)[1]
                for k, data in enumerate(segments):
                    part = index[k * interval : (k + 1) * interval] if interval else index
                    (_ac_again if high else _ac_first)(frame.blocks, part, ac[chosen[0] & 15], first, last, low, data, quick)


def payload(frame: Frame) -> bytes:
    """The bytes that ``write`` stored."""
    return (frame.blocks.reshape(-1) - 256).astype(np.uint8).tobytes()[: int.from_bytes(frame.note, "big")]
