"""Progressive JPEG: scans accumulated into coefficient arrays, then samples in numpy.

:func:`decode` reads a baseline or progressive Huffman JPEG of one or three
components: it accumulates spectral-selection and successive-approximation scans
into one coefficient array a component, inverse-transforms the blocks with two
matrix products, upsamples chroma by repetition and returns a full-resolution
height x width x 3 uint8 tensor with the coefficients.

:func:`encode_payload` stores bytes without loss: the format's unit is the
coefficient, and each byte b is the coefficient b + 256 of one 4:2:0 image. All
values then share one magnitude class, so with one-symbol Huffman tables each scan's
codes have a fixed length and are packed and read as matrices. The stream
is ordinary progressive JPEG: a DC scan and two AC bands without the lowest bit,
then refinement scans for that bit. :func:`decode` tells such scans by their
tables and reads them as matrices; all other scans are read code by code.

Texts are short and numpy calls are dear, so images of one size are written and read
as a stack: one image above the other, with streams of their own.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 192


def _zigzag() -> np.ndarray:
    """Natural index of each zigzag position: along the anti-diagonals, turning each time."""
    cells = sorted(((i, j) for i in range(8) for j in range(8)), key=lambda c: (c[0] + c[1], c[0] if (c[0] + c[1]) % 2 else c[1]))
    return np.array([8 * i + j for i, j in cells])


ZIGZAG = _zigzag()
_k = np.arange(8)
NATURAL = np.argsort(ZIGZAG)  # zigzag position of each natural index
IDCT = (np.cos((2 * _k[:, None] + 1) * _k[None, :] * np.pi / 16) * np.where(_k == 0, np.sqrt(1 / 8), 0.5)).astype(np.float32)
SOI, EOI, SOS, DQT, DHT, SOF0, SOF1, SOF2, DRI = 0xD8, 0xD9, 0xDA, 0xDB, 0xC4, 0xC0, 0xC1, 0xC2, 0xDD
LAYOUT = ((1, 2, 2), (2, 1, 1), (3, 1, 1))  # component, horizontal and vertical sampling
BLOCKS = 6  # of a coded unit
BANDS = ((1, 5), (6, 63))
STACK = 1 << 18  # samples of a channel that are worked on together
SCAN_END = re.compile(rb"\xff[^\x00\xd0-\xd7]")
RESTART = re.compile(rb"\xff[\xd0-\xd7]")


def _stuffed(rows: np.ndarray) -> list[bytes]:
    """Entropy-coded bytes of each row with a zero after each 0xFF."""
    n, whole = rows.shape[1], rows.tobytes()
    return [whole[a : a + n].replace(b"\xff", b"\xff\x00") for a in range(0, len(whole), n)]


def _codes_of(values: np.ndarray) -> np.ndarray:
    """Rows of codes, a 0 bit and then eight bits each, in bytes filled up with ones."""
    m, n = values.shape
    eights = np.zeros((m, -(-n // 8) * 8), np.uint8)
    eights[:, :n] = values
    eights = eights.reshape(m, -1, 8)
    out = np.empty((m, eights.shape[1], 9), np.uint8)
    out[..., 0] = eights[..., 0] >> 1
    for k in range(1, 8):  # the low k bits of a value, a 0 bit, the high bits of the next
        out[..., k] = eights[..., k - 1] << (8 - k) | eights[..., k] >> (k + 1)
    out[..., 8] = eights[..., 7]
    out = out.reshape(m, -1)[:, : -(-9 * n // 8)]
    if n % 8:
        out[:, -1] |= (1 << (-9 * n % 8)) - 1
    return out


def _bits_of(rows: np.ndarray) -> np.ndarray:
    """Rows of bits packed into bytes, filled up with ones."""
    m, n = rows.shape
    full = np.ones((m, -(-n // 8) * 8), np.uint8)
    full[:, :n] = rows
    return np.packbits(full, axis=1)


def _fields(rows: np.ndarray, n: int, width: int) -> np.ndarray:
    """The first n fields of each row of bytes, of width bits (9 at most), as uint16."""
    m, eights = len(rows), -(-n // 8)
    if rows.shape[1] * 8 < n * width:
        raise ValueError("the scan ends early")
    wide = np.zeros((m, eights * width + 1), np.uint8)
    used = min(rows.shape[1], eights * width)
    wide[:, :used] = rows[:, :used]
    # byte s of the groups of eight fields; the byte after the last one is the spare one
    at = lambda s: np.lib.stride_tricks.as_strided(wide[:, s:], (m, eights), (wide.strides[0], width))
    out = np.empty((m, eights, 8), np.uint16)
    for k in range(8):
        s, off = divmod(k * width, 8)
        out[..., k] = (at(s).astype(np.uint16) << 8 | at(s + 1)) >> (16 - off - width) & ((1 << width) - 1)
    return out.reshape(m, -1)[:, :n]


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def geometry(size: int) -> tuple[int, int]:
    """Coded units across and down for so many bytes: near square, within the format's 65,535 samples."""
    units = -(-size // (64 * BLOCKS))
    across = max(1, int(np.ceil(np.sqrt(units))))
    if across > 4095:
        raise ValueError("the text is too long for one image of 65,535 by 65,535 samples")
    return across, -(-units // across)


def encode_payload(payload: bytes) -> bytes:
    """A progressive JPEG whose coefficients are the payload's bytes (a multiple of 192), in order of blocks."""
    return encode_payloads([payload], *geometry(len(payload)))[0]


def encode_payloads(payloads: Sequence[bytes], across: int, down: int) -> list[bytes]:
    """:func:`encode_payload` of payloads that have this geometry."""
    m, size = len(payloads), across * down * BLOCKS * 64
    blocks = np.frombuffer(b"".join(p.ljust(size, b" ") for p in payloads), np.uint8).reshape(-1, BLOCKS, 64)
    frame = struct.pack(">BHHB", 8, down * 16, across * 16, 3) + b"".join(bytes((c, 16 * h + v, 0)) for c, h, v in LAYOUT)
    # one code of one bit in each table: DC class 8; AC run 0 with class 8; AC end of block, for refinement
    counts = b"\x01" + b"\x00" * 15
    head = _segment(DQT, b"\x00" + b"\x01" * 64) + _segment(SOF2, frame) + _segment(DHT, b"\x00" + counts + b"\x08" + b"\x10" + counts + b"\x08" + b"\x11" + counts + b"\x00")
    out = [[b"\xff\xd8" + _segment(0xFE, struct.pack(">Q", len(p))) for p in payloads]]

    def scan(name: int, table: int, ss: int, se: int, ah: int, al: int, data: list[bytes], before: bytes = b"") -> None:
        out.append([before + _segment(SOS, bytes((1, name, table, ss, se, 16 * ah + al)))] * m)
        out.append(data)

    # without its lowest bit, b + 256 is 128 + b // 2: class 8 for all; a restart after each unit starts the DC prediction anew,
    # and only the first block of each component in a unit then has an absolute value: the others differ by class, so DC goes one component a scan
    head += _segment(DRI, struct.pack(">H", 1))
    planes = [x.reshape(m, -1, 64) for x in _planes(blocks, across, m * down)]
    tops = [x >> 1 | np.uint8(128) for x in planes]
    for c, (name, _, _) in enumerate(LAYOUT):
        scan(name, 0, 0, 0, 0, 1, _with_restarts(tops[c][:, :, 0]), head if c == 0 else b"")
    for c, (name, _, _) in enumerate(LAYOUT):
        for ss, se in BANDS:
            scan(name, 0, ss, se, 0, 1, _stuffed(_codes_of(tops[c][:, :, ss : se + 1].reshape(m, -1))), _segment(DRI, struct.pack(">H", 0)) if c == 0 and ss == 1 else b"")
    for c, (name, _, _) in enumerate(LAYOUT):
        scan(name, 0, 0, 0, 1, 0, _stuffed(_bits_of(planes[c][:, :, 0] & 1)))
    for c, (name, _, _) in enumerate(LAYOUT):
        low = planes[c] & 1
        low[:, :, 0] = 0  # its place holds the end-of-block code
        scan(name, 1, 1, 63, 1, 0, _stuffed(np.packbits(low.reshape(m, -1), axis=1)))
    out.append([b"\xff\xd9"] * m)
    return [b"".join(parts) for parts in zip(*out, strict=True)]


def _with_restarts(tops: np.ndarray) -> list[bytes]:
    """An interval for each value, stuffed, with the restart markers between intervals: a 0 bit and eight bits, padded to two bytes."""
    m, n = tops.shape
    rows = np.empty((m, n, 4), np.uint8)
    rows[..., 0] = tops >> 1
    rows[..., 1] = tops << 7 | 127
    rows[..., 2] = 255
    rows[..., 3] = 0xD0 + np.arange(n) % 8
    # a byte of ones is stuffed: the first has a leading 0, so it is the second, and the next byte is that of the marker
    whole, size = rows.tobytes(), 4 * n
    parts = [whole[a : a + size - 2].replace(b"\xff\xff", b"\xff\x00\xff") for a in range(0, len(whole), size)]
    return [x + b"\x00" if x[-1] == 255 else x for x in parts]


def _planes(blocks: np.ndarray, across: int, down: int) -> list[np.ndarray]:
    """Each component's blocks in raster order, from blocks in order of coded units."""
    grid = blocks.reshape(down, across, BLOCKS, *blocks.shape[2:])
    luma = grid[:, :, :4].reshape(down, across, 2, 2, -1).transpose(0, 2, 1, 3, 4).reshape(down * across * 4, -1)
    return [luma, grid[:, :, 4].reshape(down * across, -1), grid[:, :, 5].reshape(down * across, -1)]


def _units(planes: list[np.ndarray], across: int, down: int) -> np.ndarray:
    """The inverse of :func:`_planes`."""
    out = np.empty((down, across, BLOCKS, 64), planes[0].dtype)
    out[:, :, :4] = planes[0].reshape(down, 2, across, 2, 64).transpose(0, 2, 1, 3, 4).reshape(down, across, 4, 64)
    out[:, :, 4] = planes[1].reshape(down, across, 64)
    out[:, :, 5] = planes[2].reshape(down, across, 64)
    return out.reshape(down * across, BLOCKS, 64)


class _Bits:
    """Bits of one scan, interval by interval, for scans with codes of any length."""

    def __init__(self, parts: list[bytes]):
        self.parts, self.at = parts, -1
        self.next()

    def next(self) -> None:
        self.at += 1
        data = self.parts[self.at] if self.at < len(self.parts) else b""
        self.value, self.left = int.from_bytes(data + b"\xff" * 8, "big"), 8 * len(data) + 64

    def take(self, n: int) -> int:
        if not n:
            return 0
        self.left -= n
        if self.left < 0:
            raise ValueError("the scan ends early")
        return self.value >> self.left & ((1 << n) - 1)

    def symbol(self, table: dict[tuple[int, int], int]) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | self.take(1)
            got = table.get((n, code))
            if got is not None:
                return got
        raise ValueError("no such Huffman code")

    def signed(self, n: int) -> int:
        v = self.take(n)
        return v if not n or v >> (n - 1) else v - (1 << n) + 1


def _parsed(data: bytes) -> tuple[list[tuple[int, bytes]], list[bytes], bytes]:
    """A stream's segments (marker, body), the entropy-coded bytes of its scans and its comment."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    segments, scans, comment, at = [], [], b"", 2
    while at < len(data):
        if data[at] != 255:
            raise ValueError("a marker is missing")
        marker = data[at + 1]
        if marker == EOI:
            break
        if marker == 255:
            at += 1
            continue
        to = at + 2 + (data[at + 2] << 8 | data[at + 3])
        if marker == 0xFE:
            comment = data[at + 4 : to]
        else:
            segments.append((marker, data[at + 4 : to]))
        at = to
        if marker == SOS:
            end = SCAN_END.search(data, at)
            at = end.start() if end else len(data)
            scans.append(data[to:at])
    return segments, scans, comment


class Image:
    """A decoded frame: coefficients by component (zigzag order, raster blocks), quantisation tables and geometry.

    Of several streams, which may differ in entropy-coded data and comments only, it is
    the stack: their blocks and samples follow one another.
    """

    def __init__(self, *streams: bytes):
        self.quant: dict[int, np.ndarray] = {}
        self.tables: dict[int, dict[tuple[int, int], int]] = {}
        self.restart = 0
        self.components: list[dict] = []
        self.count = len(streams)
        parsed = [_parsed(x) for x in streams]
        self.comments = [x[2] for x in parsed]
        segments = parsed[0][0]
        if any(x[0] != segments for x in parsed):
            raise ValueError("these images are not alike")
        scans = iter(zip(*(x[1] for x in parsed), strict=True))
        for marker, body in segments:
            if marker == DQT:
                self._quant(body)
            elif marker == DHT:
                self._huffman(body)
            elif marker in (SOF0, SOF1, SOF2):
                self._frame(body, marker == SOF2)
            elif marker == DRI:
                (self.restart,) = struct.unpack(">H", body)
            elif marker == SOS:
                self._scan(body, next(scans))

    def _quant(self, body: bytes) -> None:
        while body:
            wide, name = body[0] >> 4, body[0] & 15
            n = 128 if wide else 64
            self.quant[name] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else np.uint8).astype(np.float32)
            body = body[1 + n :]

    def _huffman(self, body: bytes) -> None:
        while body:
            counts, at, code, table = body[1:17], 17, 0, {}
            for n, count in enumerate(counts, 1):
                for _ in range(count):
                    table[n, code] = body[at]
                    code, at = code + 1, at + 1
                code <<= 1
            self.tables[body[0]] = table
            body = body[at:]

    def _frame(self, body: bytes, progressive: bool) -> None:
        precision, self.height, self.width, n = struct.unpack_from(">BHHB", body)
        if precision != 8 or n not in (1, 3):
            raise ValueError("only 8-bit images of one or three components")
        self.progressive = progressive
        for i in range(n):
            name, hv, q = body[6 + 3 * i : 9 + 3 * i]
            self.components.append({"name": name, "h": hv >> 4, "v": hv & 15, "q": q})
        self.hmax, self.vmax = max(c["h"] for c in self.components), max(c["v"] for c in self.components)
        self.across, self.down = -(-self.width // (8 * self.hmax)), -(-self.height // (8 * self.vmax))
        for c in self.components:
            c["rows"], c["cols"] = self.down * c["v"], self.across * c["h"]
            c["used"] = (-(-self.height * c["v"] // (8 * self.vmax)), -(-self.width * c["h"] // (8 * self.hmax)))
            c["data"] = np.zeros((self.count * c["rows"] * c["cols"], 64), np.int16)

    def _scan(self, body: bytes, raw: tuple[bytes, ...]) -> None:
        n = body[0]
        parts = []
        for i in range(n):
            name, t = body[1 + 2 * i], body[2 + 2 * i]
            parts.append((next(c for c in self.components if c["name"] == name), self.tables.get(t >> 4), self.tables.get(16 + (t & 15))))
        ss, se, a = body[1 + 2 * n : 4 + 2 * n]
        ah, al = a >> 4, a & 15
        if n == 1 and self._matrix(parts[0], ss, se, ah, al, raw):
            return
        for i, data in enumerate(raw):
            self._codes(parts, ss, se, ah, al, _Bits([x.replace(b"\xff\x00", b"\xff") for x in RESTART.split(data)]), i)

    def _matrix(self, part: tuple, ss: int, se: int, ah: int, al: int, raw: tuple[bytes, ...]) -> bool:
        """Read a one-component scan whose codes have a fixed length; False where they have not."""
        c, dc, ac = part
        data, n = c["data"], c["rows"] * c["cols"]
        if not self.progressive or c["used"] != (c["rows"], c["cols"]):
            return False
        # what a scan's codes are is settled first, then its bytes are taken without stuffing and markers
        if ss == 0 and ah == 0:
            size = next(iter(dc.values())) if dc and len(dc) == 1 else 0
            if not 1 <= size <= 8 or self.restart != 1 or next(iter(dc)) != (1, 0):
                return False
            width = -(-(size + 1) // 8)
            bits = np.zeros((self.count * n, 2), np.uint8)
            bits[:, :width] = self._bytes(raw).reshape(-1, width)
            data[:, 0] = self._numbers(_fields(bits, 1, size + 1)[:, 0], size) << al
            return True
        if self.restart:
            return False
        if ss == 0:
            data[:, 0] |= np.unpackbits(self._bytes(raw), axis=1, count=n).reshape(-1).astype(np.int16) << al
            return True
        if not ac or len(ac) != 1 or next(iter(ac)) != (1, 0):
            return False
        (symbol,) = ac.values()
        width = se - ss + 1
        if ah == 0 and 1 <= symbol <= 8:
            data[:, ss : se + 1] = self._numbers(_fields(self._bytes(raw), n * width, symbol + 1), symbol).reshape(-1, width) << al
            return True
        if ah and symbol == 0 and (data[:, ss : se + 1] > 0).all():
            bits = np.unpackbits(self._bytes(raw), axis=1, count=n * (width + 1)).reshape(-1, width + 1)[:, 1:]
            data[:, ss : se + 1] += bits.astype(np.int16) << al
            return True
        return False

    def _bytes(self, raw: tuple[bytes, ...]) -> np.ndarray:
        """A row for each image: a scan's bytes without stuffing and restart markers."""
        if self.restart:
            raw = [RESTART.sub(b"", x) for x in raw]
        return np.frombuffer(b"".join([x.replace(b"\xff\x00", b"\xff") for x in raw]), np.uint8).reshape(self.count, -1)

    @staticmethod
    def _numbers(codes: np.ndarray, size: int) -> np.ndarray:
        """Signed values of a magnitude class from the low bits of their codes."""
        value = (codes & ((1 << size) - 1)).astype(np.int16)
        return np.where(value >> (size - 1), value, value - ((1 << size) - 1))

    def _codes(self, parts: list, ss: int, se: int, ah: int, al: int, bits: _Bits, image: int) -> None:
        """Read an image's scan code by code."""
        if len(parts) == 1:
            c = parts[0][0]
            rows, cols = c["used"]
            order = [[(parts[0], r * c["cols"] + k)] for r in range(rows) for k in range(cols)]
        else:
            order = []
            for r in range(self.down):
                for k in range(self.across):
                    unit = []
                    for p in parts:
                        c = p[0]
                        unit += [(p, (r * c["v"] + y) * c["cols"] + k * c["h"] + x) for y in range(c["v"]) for x in range(c["h"])]
                    order.append(unit)
        last, run = {}, 0
        for i, unit in enumerate(order):
            if self.restart and i and i % self.restart == 0:
                bits.next()
                last, run = {}, 0
            for (c, dc, ac), at in unit:
                block = c["data"][at + image * c["rows"] * c["cols"]]
                if ss == 0:
                    if ah:
                        block[0] |= bits.take(1) << al
                    else:
                        last[c["name"]] = last.get(c["name"], 0) + bits.signed(bits.symbol(dc))
                        block[0] = last[c["name"]] << al
                    if self.progressive:
                        continue
                lo = max(ss, 1)
                run = self._refine(block, lo, se, al, ac, bits, run) if ah else self._first(block, lo, se, al, ac, bits, run)

    def _first(self, block, ss: int, se: int, al: int, ac: dict, bits: _Bits, run: int) -> int:
        if run:
            return run - 1
        k = ss
        while k <= se:
            symbol = bits.symbol(ac)
            zeros, size = symbol >> 4, symbol & 15
            if size:
                k += zeros
                block[k] = bits.signed(size) << al
                k += 1
            elif zeros == 15:
                k += 16
            else:
                return (1 << zeros) + bits.take(zeros) - 1 if self.progressive else 0
        return 0

    def _refine(self, block, ss: int, se: int, al: int, ac: dict, bits: _Bits, run: int) -> int:
        plus, k = 1 << al, ss

        def correct(k: int) -> None:
            if bits.take(1) and not abs(int(block[k])) & plus:
                block[k] += plus if block[k] > 0 else -plus

        if not run:
            while k <= se:
                symbol = bits.symbol(ac)
                zeros, size = symbol >> 4, symbol & 15
                new = 0
                if size:
                    new = plus if bits.take(1) else -plus
                elif zeros < 15:
                    run = (1 << zeros) + bits.take(zeros)
                    break
                while k <= se:
                    if block[k]:
                        correct(k)
                    elif zeros:
                        zeros -= 1
                    else:
                        break
                    k += 1
                if new and k <= se:
                    block[k] = new
                k += 1
        if run:
            for j in range(k, se + 1):
                if block[j]:
                    correct(j)
            run -= 1
        return run

    def _samples(self, c: dict) -> np.ndarray:
        """One component's samples at its own resolution, as whole numbers in float32."""
        values = c["data"].take(NATURAL, axis=1) * self.quant[c["q"]][NATURAL]
        # a product for each image, so that its samples do not depend on the others
        half = values.reshape(self.count, -1, 8) @ IDCT.T  # along rows
        half = half.reshape(-1, 8, 8).transpose(0, 2, 1).reshape(self.count, -1, 8) @ IDCT.T
        rows = half.reshape(-1, c["cols"], 8, 8).transpose(0, 3, 1, 2).reshape(-1, 8 * c["cols"])
        np.rint(rows, out=rows)
        rows += 128
        return np.clip(rows, 0, 255, out=rows)

    def _full(self, rows: np.ndarray, c: dict) -> np.ndarray:
        """Values of one component at full resolution."""
        up, right = self.vmax // c["v"], self.hmax // c["h"]
        if up > 1 or right > 1:
            wide = np.empty((len(rows), up, rows.shape[1], right), rows.dtype)
            for i in range(right):
                wide[:, 0, :, i] = rows
            wide[:, 1:] = wide[:, :1]
            rows = wide.reshape(up * len(rows), -1)
        return rows.reshape(self.count, -1, rows.shape[1])[:, : self.height, : self.width].reshape(-1, self.width)

    def plane(self, c: dict) -> np.ndarray:
        """One component's samples at full resolution, as whole numbers in float32."""
        return self._full(self._samples(c), c)

    def channels(self) -> list[np.ndarray]:
        """Red, green and blue, or the one channel of grey, as uint8."""
        if len(self.components) == 1:
            return [self.plane(self.components[0]).astype(np.uint8)]
        first, blue, red = self.components
        y, cb, cr = self.plane(first), self._samples(blue) - 128, self._samples(red) - 128
        # The format's colour transform.
        green = y - self._full(0.344136 * cb, blue)
        green -= self._full(0.714136 * cr, red)
        out = []
        for plane in (y + self._full(1.402 * cr, red), green, y + self._full(1.772 * cb, blue)):
            np.rint(plane, out=plane)
            out.append(np.clip(plane, 0, 255, out=plane).astype(np.uint8))
        return out

    def rgb(self) -> np.ndarray:
        return np.stack(self.channels() * (3 // len(self.components)), axis=-1)


def decode(data: bytes) -> np.ndarray:
    """The full-resolution RGB tensor of a JPEG."""
    return Image(data).rgb()


def read_payload(image: Image) -> bytes:
    """The bytes that :func:`encode_payload` stored."""
    return read_payloads(image)[0]


def read_payloads(stack: Image) -> list[bytes]:
    blocks = _units([c["data"] for c in stack.components], stack.across, stack.count * stack.down)
    rows = (blocks - 256).astype(np.uint8).reshape(stack.count, -1)
    return [row[: struct.unpack(">Q", comment)[0]].tobytes() for row, comment in zip(rows, stack.comments, strict=True)]


def payload_of(text: str | None) -> tuple[bytes, int]:
    data = (text or "").encode()
    return data + b" " * (-len(data) % UNIT or (0 if data else UNIT)), len(data)


def features_of(channels: list[np.ndarray]) -> list[str]:
    """For each image (first axis): mean of each channel in thousandths, and a 64-bit sign pattern of 8 x 8 grid means of brightness."""
    n, *shape = channels[0].shape
    size = shape[0] * shape[1]
    means = np.stack([x.sum(axis=(1, 2), dtype=np.int64) for x in channels], axis=1) / size
    luma = channels[0].astype(np.int16)
    luma += channels[1]
    luma += channels[2]
    rows, cols = (np.linspace(0, k, 9).astype(int) for k in shape)
    grid = np.add.reduceat(np.add.reduceat(luma, rows[:-1], axis=1, dtype=np.int64), cols[:-1], axis=2)
    bits = grid / np.outer(np.diff(rows), np.diff(cols)) > (grid.sum(axis=(1, 2)) / size)[:, None, None]
    signs = np.packbits(bits.reshape(n, 64), axis=1).tobytes().hex()
    return [":".join(str(round(1000 * m)) for m in row) + ":" + signs[16 * i : 16 * i + 16] for i, row in enumerate(means.tolist())]


def media_columns(docs: DataFrame, keep_media: bool = False, keep_tensor: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature.

    keep_media adds the JPEG (media), keep_tensor the RGB tensor (height, width,
    tensor as raw bytes). Null text counts as empty; equal texts give equal values.
    Columns other than doc_id and text are ignored.
    """
    fields = ["doc_id long", "n_bytes long", "payload_bytes long", "payload_sha256 string", "tail_crc32 long", "media_bytes long", "media_sha256 string", "feature string"]
    fields += ["media binary"] * keep_media + ["height int", "width int", "tensor binary"] * keep_tensor
    names = [f.split()[0] for f in fields]
    most = 256 if keep_media or keep_tensor else 4096  # bounds what one record batch holds of media
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}

    def media(texts, across, down):
        payloads, n_bytes = zip(*map(payload_of, texts), strict=True)
        streams = encode_payloads(payloads, across, down)
        stack = Image(*streams)
        channels = [x.reshape(stack.count, stack.height, stack.width) for x in stack.channels()]
        for i, (n, stream, back, feature) in enumerate(zip(n_bytes, streams, read_payloads(stack), features_of(channels), strict=True)):
            row = [n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(stream), hashlib.sha256(stream).hexdigest(), feature]
            row += [stream] * keep_media
            if keep_tensor:
                row += [stack.height, stack.width, np.stack([x[i] for x in channels], axis=-1).tobytes()]
            yield row

    def convert(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, most):
                part = batch.slice(a, most)
                ids, texts = part.column(0).to_pylist(), part.column(1)
                shapes = {}
                for i, size in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
                    shapes.setdefault(geometry(max(size, 1)), []).append(i)
                rows = [None] * len(ids)
                for (across, down), places in shapes.items():
                    step = max(STACK // (256 * across * down), 1)
                    for b in range(0, len(places), step):
                        some = places[b : b + step]
                        for i, row in zip(some, media(texts.take(pa.array(some)).to_pylist(), across, down), strict=True):
                            rows[i] = [ids[i], *row]
                columns = list(zip(*rows, strict=True))
                yield pa.record_batch([pa.array(c, kinds[f.split()[1]]) for c, f in zip(columns, fields, strict=True)], names)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(convert, ", ".join(fields))
