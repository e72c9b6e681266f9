"""Media columns as progressive JPEG.

``store`` writes bytes losslessly into a progressive JPEG's coefficients, 48 in each 8x8 block, with 4:2:0 chroma, so
that 576 bytes are two 16x16 units. ``coefficients`` accumulates the scans of such an image: per component a DC scan,
two spectral bands of the first AC pass, and a refinement of each that adds the lowest bit. ``tensor`` transforms the
coefficients back in numpy, upsamples chroma and gives full-resolution RGB.

A coefficient is 256 plus its byte. The first pass sends all bits but the lowest: the run/size symbol 0x08, the only one
of its Huffman table, then eight bits. In the refinement no coefficient is still zero, so each band is an end-of-band
run followed by one correction bit a coefficient. Bit positions thus follow from the block count, and whole scans of
many images are packed and unpacked as numpy arrays; any progressive decoder reads the same. A file is read this way only
if its tables and scans are those that ``store`` writes; others are decoded by ``progressive`` and carry no payload.

The transform is done on integers held in doubles, small enough to be exact, so equal texts have equal features
whatever batch they are in. A null text is empty: one unit pair of padding. Very long texts are stored one by one and
take some ten times their size while they are packed; repeated rows and rows without an id are stored each for itself.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomwork.llm import progressive
from loomwork.llm._common import in_arrow, renamed, text_bytes

UNIT = 576
CARRIED = 48  # coefficients of a block that carry a byte: 1 to 48 in zigzag order
BANDS = ((1, 24), (25, 48))
#: Coded units (16x16) in a column at most, so that a side stays below 65,536 pixels.
COLUMN = 4000
#: Bytes of payload worked on at once.
BLOCK_BYTES = 1 << 20
LONGEST_RUN = 32767


def padded(data: bytes) -> bytes:
    """``data`` and bytes 255 up to a positive multiple of 576."""
    return data + b"\xff" * (-len(data) % UNIT if data else UNIT)


def _layout(units: int) -> tuple[int, int]:
    """Columns and rows of 16x16 units."""
    across = -(-units // COLUMN)
    return across, -(-units // across)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _huffman(kind: int, slot: int, lengths: dict[int, int], symbols: list[int]) -> bytes:
    return _segment(0xC4, bytes([kind << 4 | slot, *(lengths.get(n, 0) for n in range(1, 17)), *symbols]))


def _head(units: int, size: int) -> bytes:
    across, down = _layout(units)
    frame = struct.pack(">BHHB", 8, 16 * down, 16 * across, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    return b"".join(
        (
            b"\xff\xd8",
            _segment(0xFE, struct.pack(">Q", size)),  # a comment holds the bytes of payload
            _segment(0xDB, bytes([0]) + bytes([1]) * 64),
            _segment(0xC2, frame),
            _huffman(0, 0, {1: 1}, [0]),
            _huffman(1, 0, {1: 1}, [0x08]),
            _huffman(1, 1, {4: 15}, [r << 4 for r in range(15)]),
        )
    )


def _scan_head(components: tuple[int, ...], tables: int, first: int, last: int, high: int, low: int) -> bytes:
    body = bytes([len(components)]) + b"".join(bytes([c, tables]) for c in components) + bytes([first, last, high << 4 | low])
    return _segment(0xDA, body)


def _runs(blocks: int) -> list[int]:
    """The end-of-band runs that a refinement of so many blocks is cut into."""
    return [LONGEST_RUN] * (blocks // LONGEST_RUN) + ([blocks % LONGEST_RUN] if blocks % LONGEST_RUN else [])


def _run_bits(run: int) -> np.ndarray:
    size = run.bit_length() - 1
    code = [size >> k & 1 for k in (3, 2, 1, 0)]  # the table's codes are the 4-bit numbers in order
    return np.array(code + [run >> k & 1 for k in range(size - 1, -1, -1)], np.uint8)


def _stuffed(bits: np.ndarray) -> Iterator[bytes]:
    """Each row as entropy-coded bytes: filled up with ones, a zero after every 0xFF."""
    fill = -bits.shape[1] % 8
    if fill:
        bits = np.concatenate((bits, np.ones((len(bits), fill), np.uint8)), 1)
    for row in np.packbits(bits, axis=1):
        yield row.tobytes().replace(b"\xff", b"\xff\x00")


def store_many(payloads: list[bytes]) -> list[bytes]:
    """The images of payloads of one length."""
    size, m = len(payloads[0]), len(payloads)
    units = size * 2 // UNIT
    across, down = _layout(units)
    laid = across * down
    data = np.full((m, laid * 6, CARRIED), 255, np.uint8)
    data.reshape(m, -1)[:, :size] = np.frombuffer(b"".join(payloads), np.uint8).reshape(m, size)
    parts = {1: data[:, : 4 * laid], 2: data[:, 4 * laid : 5 * laid], 3: data[:, 5 * laid :]}
    out = [[_head(units, size)] for _ in range(m)]

    def scan(head: bytes, bits: np.ndarray) -> None:
        for image, body in zip(out, _stuffed(bits), strict=True):
            image += (head, body)

    scan(_scan_head((1, 2, 3), 0x00, 0, 0, 0, 0), np.zeros((m, 6 * laid), np.uint8))
    for c, part in parts.items():
        for first, last in BANDS:
            band = part[:, :, first - 1 : last]
            bits = np.zeros((*band.shape, 9), np.uint8)  # the symbol's one-bit code, the leading one, seven bits
            bits[..., 1] = 1
            bits[..., 2:] = np.unpackbits(band[..., None], axis=-1)[..., :7]
            scan(_scan_head((c,), 0x00, first, last, 0, 1), bits.reshape(m, -1))
    for c, part in parts.items():
        for first, last in BANDS:
            low = part[:, :, first - 1 : last] & 1
            at, chunks = 0, []
            for run in _runs(low.shape[1]):
                chunks += (np.broadcast_to(_run_bits(run), (m, len(_run_bits(run)))), low[:, at : at + run].reshape(m, -1))
                at += run
            scan(_scan_head((c,), 0x01, first, last, 1, 0), np.concatenate(chunks, 1))
    return [b"".join(image) + b"\xff\xd9" for image in out]


def store(data: bytes) -> bytes:
    return store_many([padded(data)])[0]


def _own_scans() -> list[bytes]:
    """The scans that ``store`` writes, as their parameters."""
    bands = [(first, last, c) for c in (1, 2, 3) for first, last in BANDS]
    heads = [_scan_head((1, 2, 3), 0x00, 0, 0, 0, 0)]
    heads += [_scan_head((c,), 0x00, first, last, 0, 1) for first, last, c in bands]
    heads += [_scan_head((c,), 0x01, first, last, 1, 0) for first, last, c in bands]
    return [head[4:] for head in heads]


OWN_SCANS = _own_scans()


def _own(media: bytes) -> tuple[int, int, int, list[tuple[bytes, bytes]]] | None:
    """The parsed image, if its tables and scans are those that ``store`` writes."""
    if media[2:6] != b"\xff\xfe\x00\x0a":
        return None
    size = int.from_bytes(media[6:14], "big")
    if not size or size % UNIT or size > UNIT * 1 << 23 or not media.startswith(_head(size * 2 // UNIT, size)):
        return None
    image = _parsed(media)
    return image if [head for head, _ in image[3]] == OWN_SCANS else None


def _parsed(media: bytes) -> tuple[int, int, int, list[tuple[bytes, bytes]]]:
    """Payload bytes, units across and down, and (scan parameters, entropy-coded bytes without stuffing)."""
    at, size, across, down, scans = 2, 0, 0, 0, []
    while media[at + 1] != 0xD9:
        marker, length = media[at + 1], int.from_bytes(media[at + 2 : at + 4], "big")
        body = media[at + 4 : at + 2 + length]
        at += 2 + length
        if marker == 0xFE:
            size = struct.unpack(">Q", body)[0]
        elif marker == 0xC2:
            _, high, wide, _ = struct.unpack_from(">BHHB", body)
            across, down = wide // 16, high // 16
        elif marker == 0xDA:
            end = at
            while media[(end := media.index(b"\xff", end)) + 1] == 0:
                end += 2
            scans.append((body, media[at:end].replace(b"\xff\x00", b"\xff")))
            at = end
    return size, across, down, scans


def coefficients_many(images: list[tuple[int, int, int, list[tuple[bytes, bytes]]]]) -> list[np.ndarray]:
    """For parsed images of one layout: the coefficient arrays (images, blocks, 64) of Y, Cb and Cr, in zigzag order,
    accumulated scan by scan."""
    _, across, down, scans = images[0]
    m, laid = len(images), across * down
    out = [np.zeros((m, n * laid, 64), np.int16) for n in (4, 1, 1)]
    for k, (head, _) in enumerate(scans):
        count, (first, last, precision) = head[0], head[-3:]
        raw = np.frombuffer(b"".join(i[3][k][1] for i in images), np.uint8).reshape(m, -1)
        bits = np.unpackbits(raw, axis=1)
        if not first:  # every DC difference is the one symbol of its table, zero
            if count != 3 or bits[:, : 6 * laid].any():
                raise ValueError("DC differences other than zero")
            continue
        band = out[head[1] - 1][:, :, first : last + 1]
        shape, low = band.shape, precision & 15
        if precision >> 4 == 0:
            each = bits[:, : shape[1] * shape[2] * 9].reshape(*shape, 9)
            if each[..., 0].any() or not each[..., 1].all():
                raise ValueError("a symbol outside the table")
            band[:] = np.packbits(each[..., 1:], axis=-1)[..., 0].astype(np.int16) << low
        else:
            at, done = 0, 0
            while done < shape[1]:
                size = int(bits[0, at : at + 4] @ (8, 4, 2, 1))
                run = 1 << size | int(bits[0, at + 4 : at + 4 + size].astype(np.int64) @ (1 << np.arange(size - 1, -1, -1)))
                at += 4 + size
                n = run * shape[2]
                band[:, done : done + run] |= bits[:, at : at + n].reshape(m, run, shape[2]).astype(np.int16) << low
                at, done = at + n, done + run
    return out


def payloads_of(parts: list[np.ndarray], size: int) -> list[bytes]:
    """The carried bytes of each image."""
    m = len(parts[0])
    data = np.concatenate([p[:, :, 1 : CARRIED + 1] for p in parts], 1)
    return [row.tobytes() for row in (data - 256).astype(np.uint8).reshape(m, -1)[:, :size]]


def _pixels(part: np.ndarray, across: int, down: int) -> np.ndarray:
    """(images, rows, columns) of samples of one component, ``across`` by ``down`` blocks."""
    plane = progressive.samples(part)
    return plane.reshape(len(part), down, across, 8, 8).swapaxes(2, 3).reshape(len(part), down * 8, across * 8)


def tensor(parts: list[np.ndarray], across: int, down: int) -> np.ndarray:
    """(images, rows, columns, 3): full-resolution RGB, chroma repeated over its 2x2 pixels."""
    y = _pixels(parts[0], 2 * across, 2 * down)
    cb, cr = (_pixels(p, across, down).repeat(2, 1).repeat(2, 2) for p in parts[1:])
    return progressive.colours(y, cb, cr)


def rgb(media: bytes) -> np.ndarray:
    """The RGB tensor of one image, whoever wrote it."""
    image = _own(media)
    if image is None:
        return progressive.rgb(media)
    return tensor(coefficients_many([image]), image[1], image[2])[0]


def _feature(pixels: np.ndarray) -> str:
    """The same of one image's pixels."""
    high, wide, _ = pixels.shape
    each = pixels.reshape(-1, 3).astype(np.int64)
    return f"{wide}x{high};" + ",".join(map(str, each.sum(0).tolist())) + ";" + ",".join(map(str, (each * each).sum(0).tolist()))


def _features(parts: list[np.ndarray], across: int, down: int) -> list[str]:
    """Size and, for each colour, the sum and the sum of squares over all pixels; worked out by rows of units."""
    m = len(parts[0])
    sums, squares = np.zeros((m, 3), np.int64), np.zeros((m, 3), np.int64)
    step = max(1, BLOCK_BYTES // (m * across * 288))
    for at in range(0, down, step):
        till = min(at + step, down)
        some = [p[:, at * n * across : till * n * across] for p, n in zip(parts, (4, 1, 1), strict=True)]
        pixels = tensor(some, across, till - at).reshape(m, -1, 3)
        sums += pixels.sum(1, dtype=np.int64)
        squares += np.einsum("ijk,ijk->ik", pixels, pixels, dtype=np.int64)
    return [f"{16 * across}x{16 * down};" + ",".join(map(str, s)) + ";" + ",".join(map(str, q)) for s, q in zip(sums.tolist(), squares.tolist(), strict=True)]


def _grouped(sizes: list, weights: list[int]) -> Iterator[list[int]]:
    """Places with the same size, at most BLOCK_BYTES together."""
    by: dict = defaultdict(list)
    for i, s in enumerate(sizes):
        by[s].append(i)
    for places in by.values():
        step = max(1, BLOCK_BYTES // max(1, weights[places[0]]))
        for at in range(0, len(places), step):
            yield places[at : at + step]


def stored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text in a JPEG column."""
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(text_bytes(batch["text"]))
            sizes = [max(UNIT, len(t) + -len(t) % UNIT) for t in texts]
            media: list[bytes] = [b""] * len(texts)
            for places in _grouped(sizes, sizes):
                for i, image in zip(places, store_many([padded(texts[i]) for i in places]), strict=True):
                    media[i] = image
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return in_arrow(renamed(docs, doc_id=id_col, text=text_col), work, f"doc_id {kind}, n_bytes long, media binary")


def described(media: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature), all read from
    the stored form. A null medium gives nulls; one that ``store`` hasn't written gives no payload. Broken ones raise."""
    kind = media.schema["doc_id"].dataType.simpleString()
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            images = batch["media"].to_pylist()
            out: list[tuple] = [(None,) * 6] * len(images)
            parsed = {i: _own(image) for i, image in enumerate(images) if image is not None}
            for i in [i for i, image in parsed.items() if image is None]:
                out[i] = (None, None, None, len(images[i]), hashlib.sha256(images[i]).hexdigest(), _feature(progressive.rgb(images[i])))
                del parsed[i]
            there = list(parsed)
            for group in _grouped([parsed[i][:3] for i in there], [parsed[i][0] for i in there]):
                places = [there[g] for g in group]
                size, across, down, _ = parsed[places[0]]
                parts = coefficients_many([parsed[i] for i in places])
                for i, payload, feature in zip(places, payloads_of(parts, size), _features(parts, across, down), strict=True):
                    out[i] = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(images[i]), hashlib.sha256(images[i]).hexdigest(), feature)
            cols = [pa.array([row[k] for row in out], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_bytes"], *cols], ["doc_id", "n_bytes", *names])

    schema = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return in_arrow(media.select("doc_id", "n_bytes", "media"), work, schema)


def tensors(media: DataFrame) -> DataFrame:
    """(doc_id, height, width, rgb): the full-resolution RGB tensor of each medium, as row-major bytes."""
    kind = media.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, image in enumerate(batch["media"].to_pylist()):
                pixels = None if image is None else rgb(image)
                high, wide = (None, None) if pixels is None else pixels.shape[:2]
                data = None if pixels is None else pixels.tobytes()
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, 1), pa.array([high], pa.int32()), pa.array([wide], pa.int32()), pa.array([data], pa.binary())], ["doc_id", "height", "width", "rgb"])

    return in_arrow(media.select("doc_id", "media"), work, f"doc_id {kind}, height int, width int, rgb binary")
