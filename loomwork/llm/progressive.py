"""Any progressive JPEG of 8 bits and one or three components, as coefficient arrays and as RGB.

Each scan adds to the coefficients: a spectral band's first pass gives all but its lowest bits, each refinement one bit
more. Huffman tables, quantization tables, restart intervals, end-of-band runs and sampling factors are the file's own.
Symbols are looked up by the next 16 bits; the inverse transform, chroma upsampling and colours are numpy. Files of
another kind, and those that end early, raise a ValueError.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator
from functools import lru_cache

import numpy as np


def zigzag() -> np.ndarray:
    """Where the k-th coefficient of the zigzag order stands in a block."""
    at = sorted(((y + x, y if (y + x) % 2 else x, y, x) for y in range(8) for x in range(8)))
    return np.array([8 * y + x for *_, y, x in at])


ZIGZAG = zigzag()
#: The inverse transform, scaled by 2**12 and rounded, so that doubles hold all sums exactly.
COSINES = np.array([[np.round(4096 * (np.sqrt(0.5) if u == 0 else 1.0) / 2 * np.cos((2 * x + 1) * u * np.pi / 16)) for u in range(8)] for x in range(8)])


def samples(blocks: np.ndarray) -> np.ndarray:
    """(..., 8, 8) samples of (..., 64) dequantized coefficients in zigzag order."""
    square = np.zeros(blocks.shape, np.float64)
    square[..., ZIGZAG] = blocks
    plane = COSINES @ square.reshape(*blocks.shape[:-1], 8, 8) @ COSINES.T
    return np.clip(np.floor_divide(plane + (1 << 23), 1 << 24) + 128, 0, 255)


def colours(y: np.ndarray, cb: np.ndarray, cr: np.ndarray) -> np.ndarray:
    """(..., 3): RGB of samples of one size, by the standard's factors, scaled by 2**16."""
    cb, cr = cb - 128, cr - 128
    rgb = np.stack((y * 65536 + 91881 * cr, y * 65536 - 22554 * cb - 46802 * cr, y * 65536 + 116130 * cb), -1)
    return np.clip(np.floor_divide(rgb + 32768, 65536), 0, 255).astype(np.uint8)


@dataclasses.dataclass(frozen=True)
class Part:
    """A component: its name, sampling factors, quantization table, blocks that it has and blocks that whole units have."""

    name: int
    across: int
    down: int
    quant: int
    blocks: tuple[int, int]
    laid: tuple[int, int]


@dataclasses.dataclass(frozen=True)
class Scan:
    """Parts with the numbers of their Huffman tables, the band and its bits, and the entropy-coded intervals."""

    parts: list[tuple[int, int, int]]
    first: int
    last: int
    high: int
    low: int
    tables: dict[int, list[int]]
    restart: int
    intervals: list[bytes]


@dataclasses.dataclass
class Image:
    height: int
    width: int
    units: tuple[int, int]
    parts: list[Part]
    quants: dict[int, np.ndarray]
    scans: list[Scan]
    adobe_rgb: bool = False


@lru_cache(maxsize=64)
def _lookup(counts: bytes, symbols: bytes) -> list[int]:
    """For each 16 bits the code's size times 256 plus its symbol; 0 where no code fits."""
    out = np.zeros(1 << 16, np.int64)
    code = at = 0
    for size, n in enumerate(counts, 1):
        for symbol in symbols[at : at + n]:
            out[code << 16 - size : code + 1 << 16 - size] = size << 8 | symbol
            code += 1
        at, code = at + n, code << 1
    return out.tolist()


def _frame(body: bytes) -> tuple[int, int, tuple[int, int], list[Part]]:
    bits, height, width, n = body[0], int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big"), body[5]
    if bits != 8 or n not in (1, 3) or not height or not width:
        raise ValueError("not a progressive JPEG of 8 bits and one or three components")
    raw = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
    most_across, most_down = max(h for _, h, _, _ in raw), max(v for *_, v, _ in raw)
    units = (-(-height // (8 * most_down)), -(-width // (8 * most_across)))
    parts = []
    for name, h, v, quant in raw:
        blocks = (-(-(-(-height * v // most_down)) // 8), -(-(-(-width * h // most_across)) // 8))
        parts.append(Part(name, h, v, quant, blocks, (units[0] * v, units[1] * h)))
    return height, width, units, parts


def _intervals(media: bytes, at: int) -> tuple[list[bytes], int]:
    """The entropy-coded bytes from ``at`` on, cut at restart markers and without stuffing, and where they end."""
    out, start = [], at
    while True:
        at = media.find(b"\xff", at)
        if at < 0 or at + 1 >= len(media):
            raise ValueError("no marker after a scan")
        after = media[at + 1]
        if after == 0:
            at += 2
        elif after == 0xFF:
            at += 1
        else:
            # fill bytes may stand before a marker; data ends with none
            out.append(media[start:at].rstrip(b"\xff").replace(b"\xff\x00", b"\xff"))
            if not 0xD0 <= after <= 0xD7:
                return out, at
            at += 2
            start = at


def parse(media: bytes) -> Image:
    """The segments of a file."""
    if media[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    at, restart, tables, quants, scans, frame, adobe = 2, 0, {}, {}, [], None, False
    while True:
        if at + 4 > len(media) and media[at : at + 2] != b"\xff\xd9" or media[at] != 0xFF:
            raise ValueError("no marker where one should stand")
        marker = media[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        if marker == 0xD9:
            break
        length = int.from_bytes(media[at + 2 : at + 4], "big")
        body = media[at + 4 : at + 2 + length]
        if len(body) != length - 2:
            raise ValueError("a segment ends early")
        at += 2 + length
        if marker == 0xDB:
            k = 0
            while k < len(body):
                wide, number = body[k] >> 4, body[k] & 15
                kind = ">u2" if wide else "u1"
                quants[number] = np.frombuffer(body, kind, 64, k + 1).astype(np.int64)
                k += 1 + (128 if wide else 64)
        elif marker == 0xC4:
            k = 0
            while k < len(body):
                counts = body[k + 1 : k + 17]
                n = sum(counts)
                tables[body[k]] = _lookup(counts, body[k + 17 : k + 17 + n])
                k += 17 + n
        elif marker == 0xC2:
            frame = _frame(body)
        elif 0xC0 <= marker <= 0xCF and marker != 0xC8 and marker != 0xCC:
            raise ValueError("not a progressive JPEG")
        elif marker == 0xDD:
            restart = int.from_bytes(body, "big")
        elif marker == 0xEE and body[:5] == b"Adobe":
            adobe = body[11] == 0
        elif marker == 0xDA:
            if frame is None:
                raise ValueError("a scan before its frame")
            names = [p.name for p in frame[3]]
            parts = [(names.index(body[1 + 2 * i]), body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])]
            first, last, precision = body[-3:]
            intervals, at = _intervals(media, at)
            scans.append(Scan(parts, first, last, precision >> 4, precision & 15, dict(tables), restart, intervals))
    if frame is None:
        raise ValueError("no frame")
    return Image(*frame, quants, scans, adobe)


class Bits:
    """A cursor over entropy-coded bits."""

    def __init__(self, data: bytes):
        raw = np.frombuffer(data + b"\0" * 4, np.uint8).astype(np.uint32)
        self.words = (raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]).tolist()
        self.at, self.end = 0, 8 * len(data)

    def _next(self) -> int:
        return self.words[self.at >> 3] >> 16 - (self.at & 7) & 0xFFFF

    def _move(self, n: int) -> None:
        self.at += n
        if self.at > self.end:
            raise ValueError("a scan ends early")

    def take(self, n: int) -> int:
        value = self._next() >> 16 - n
        self._move(n)
        return value

    def symbol(self, table: list[int]) -> int:
        found = table[self._next()]
        if not found:
            raise ValueError("bits that are no code")
        self._move(found >> 8)
        return found & 255

    def signed(self, size: int) -> int:
        """A number of ``size`` bits whose first bit says its sign."""
        value = self.take(size)
        return value if not size or value >> size - 1 else value - (1 << size) + 1


def _units(image: Image, scan: Scan) -> Iterator[list[tuple[int, int, int]]]:
    """The (place in the scan, row, column) of the blocks of each unit."""
    if len(scan.parts) == 1:
        rows, columns = image.parts[scan.parts[0][0]].blocks
        yield from ([(0, y, x)] for y in range(rows) for x in range(columns))
        return
    shapes = [(i, image.parts[c].down, image.parts[c].across) for i, (c, _, _) in enumerate(scan.parts)]
    for y in range(image.units[0]):
        for x in range(image.units[1]):
            yield [(i, y * v + dy, x * h + dx) for i, v, h in shapes for dy in range(v) for dx in range(h)]


def _first_band(bits: Bits, table: list[int], block: list[int], scan: Scan, run: int) -> int:
    """A block of a band's first pass, and the end-of-band run that is left after it."""
    if run:
        return run - 1
    k = scan.first
    while k <= scan.last:
        zeros, size = divmod(bits.symbol(table), 16)
        if size:
            k += zeros
            if k > scan.last:
                raise ValueError("a coefficient past its band")
            block[k] = bits.signed(size) * (1 << scan.low)
            k += 1
        elif zeros == 15:
            k += 16
        else:
            return (1 << zeros) + bits.take(zeros) - 1
    return 0


def _refined_band(bits: Bits, table: list[int], block: list[int], scan: Scan, run: int) -> int:
    """A block of a refinement: a bit for each coefficient that isn't zero, among new ones of one bit."""
    step = 1 << scan.low

    def corrected(k: int) -> None:
        if bits.take(1):
            block[k] += step if block[k] > 0 else -step

    k = scan.first
    while not run and k <= scan.last:
        zeros, size = divmod(bits.symbol(table), 16)
        new = (step if bits.take(1) else -step) if size else 0
        if not size and zeros < 15:
            run = (1 << zeros) + bits.take(zeros)
            break
        while k <= scan.last:
            k += 1
            if block[k - 1]:
                corrected(k - 1)
            elif zeros:
                zeros -= 1
            else:
                block[k - 1] = new
                break
    if not run:
        return 0
    for rest in range(k, scan.last + 1):
        if block[rest]:
            corrected(rest)
    return run - 1


def _added(image: Image, scan: Scan, blocks: list[list[list[list[int]]]]) -> None:
    """One scan, added to the blocks of its parts."""
    if scan.first and len(scan.parts) != 1 or scan.last > 63 or (scan.first == 0) != (scan.last == 0):
        raise ValueError("a scan of no progressive kind")
    intervals = iter(scan.intervals)
    bits, before, run = Bits(next(intervals)), [0] * len(scan.parts), 0
    for number, unit in enumerate(_units(image, scan)):
        if scan.restart and number and number % scan.restart == 0:
            following = next(intervals, None)
            if following is None:
                raise ValueError("a restart marker is missing")
            bits, before, run = Bits(following), [0] * len(scan.parts), 0
        for i, y, x in unit:
            part, dc, ac = scan.parts[i]
            block = blocks[part][y][x]
            if scan.first:
                step = _refined_band if scan.high else _first_band
                run = step(bits, scan.tables.get(0x10 | ac, ()), block, scan, run)
            elif scan.high:
                block[0] |= bits.take(1) << scan.low
            else:
                before[i] += bits.signed(bits.symbol(scan.tables[dc]))
                block[0] = before[i] * (1 << scan.low)


def coefficients(image: Image) -> list[np.ndarray]:
    """(rows, columns, 64) of each part, in zigzag order, accumulated scan by scan and not yet dequantized."""
    blocks = [[[[0] * 64 for _ in range(p.laid[1])] for _ in range(p.laid[0])] for p in image.parts]
    for scan in image.scans:
        _added(image, scan, blocks)
    return [np.array(b, np.int64) for b in blocks]


def rgb(media: bytes) -> np.ndarray:
    """(rows, columns, 3) at full resolution: each part's samples are repeated as its sampling factors say."""
    image = parse(media)
    most_across, most_down = max(p.across for p in image.parts), max(p.down for p in image.parts)
    planes = []
    for part, blocks in zip(image.parts, coefficients(image), strict=True):
        if part.quant not in image.quants:
            raise ValueError("a quantization table is missing")
        plane = samples(blocks * image.quants[part.quant]).swapaxes(1, 2).reshape(8 * part.laid[0], 8 * part.laid[1])
        rows, columns = np.arange(image.height) * part.down // most_down, np.arange(image.width) * part.across // most_across
        planes.append(plane[rows[:, None], columns])
    if len(planes) == 1:
        return np.stack(planes * 3, -1).astype(np.uint8)
    return np.stack(planes, -1).astype(np.uint8) if image.adobe_rgb else colours(*planes)
