"""Progressive files of other encoders: Java's, and hand-made ones with restart intervals and sampling factors."""

import random

import numpy as np
import pytest

from loomwork.llm import jpeg, progressive


def of_java(spark, pixels, quality):
    """A progressive file by the Java library, which subsamples chroma and optimizes its Huffman tables."""
    jvm = spark._jvm
    high, wide = pixels.shape[:2]
    grey = pixels.ndim == 2
    kinds = jvm.java.awt.image.BufferedImage
    image = kinds(wide, high, kinds.TYPE_BYTE_GRAY if grey else kinds.TYPE_INT_RGB)
    for y in range(high):
        for x in range(wide):
            if grey:
                image.getRaster().setSample(x, y, 0, int(pixels[y, x]))
            else:
                r, g, b = map(int, pixels[y, x])
                image.setRGB(x, y, r << 16 | g << 8 | b)
    writer = jvm.javax.imageio.ImageIO.getImageWritersByFormatName("jpeg").next()
    settings = writer.getDefaultWriteParam()
    settings.setProgressiveMode(jvm.javax.imageio.ImageWriteParam.MODE_DEFAULT)
    settings.setCompressionMode(jvm.javax.imageio.ImageWriteParam.MODE_EXPLICIT)
    settings.setCompressionQuality(quality)
    out = jvm.java.io.ByteArrayOutputStream()
    writer.setOutput(jvm.javax.imageio.ImageIO.createImageOutputStream(out))
    writer.write(None, jvm.javax.imageio.IIOImage(image, None, None), settings)
    writer.getOutput().flush()
    return bytes(out.toByteArray())


def read_by_java(spark, media):
    jvm = spark._jvm
    image = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(media))
    raster = image.getRaster()
    data = raster.getPixels(0, 0, image.getWidth(), image.getHeight(), spark.sparkContext._gateway.new_array(jvm.int, image.getWidth() * image.getHeight() * raster.getNumBands()))
    return np.array(list(data)).reshape(image.getHeight(), image.getWidth(), -1)


@pytest.mark.parametrize("quality", [0.3, 0.95])
def test_grey_files_of_another_encoder(spark, quality):
    rnd = np.random.default_rng(5)
    y, x = np.mgrid[:37, :51]
    pixels = np.clip(128 + 90 * np.sin(x / 5) * np.cos(y / 7) + rnd.normal(0, 12, x.shape), 0, 255).astype(np.uint8)
    media = of_java(spark, pixels, quality)
    image = progressive.parse(media)
    assert len(image.scans) > 3 and any(s.high for s in image.scans)
    got, want = jpeg.rgb(media), read_by_java(spark, media)
    assert got.shape == (37, 51, 3) and abs(got[..., :1].astype(int) - want).max() <= 1


def test_colour_files_of_another_encoder(spark):
    y, x = np.mgrid[:45, :70]
    pixels = np.stack((100 + 60 * np.sin(x / 20), 120 + 50 * np.cos(y / 18), 90 + 40 * np.sin((x + y) / 25)), -1).astype(np.uint8)
    media = of_java(spark, pixels, 0.95)
    image = progressive.parse(media)
    assert len(image.parts) == 3 and len(image.scans) > 5
    got, want = jpeg.rgb(media).astype(int), read_by_java(spark, media)
    # chroma is repeated here and interpolated there
    assert got.shape == want.shape and abs(got - want).max() <= 8 and abs(got - want).mean() < 1.5


def test_own_files_by_both_readers():
    data = bytes(range(256)) * 9
    media = jpeg.store(data)
    image = jpeg._own(media)
    fast = jpeg.coefficients_many([image])
    slow = progressive.coefficients(progressive.parse(media))
    for a, b in zip(fast, slow, strict=True):
        assert (a[0] == b.reshape(-1, 64)).all()
    assert (jpeg.rgb(media) == progressive.rgb(media)).all()


class Writer:
    """Entropy-coded bits with one Huffman table of 8-bit codes in the order of their symbols."""

    def __init__(self):
        self.bits, self.out = "", b""

    def put(self, value, n):
        self.bits += f"{value:0{n}b}" if n else ""

    def number(self, v, symbol=0):
        size = abs(v).bit_length()
        self.put(symbol << 4 | size, 8)
        self.put(v if v > 0 else v + (1 << size) - 1, size)

    def flush(self, marker=b""):
        bits = self.bits + "1" * (-len(self.bits) % 8)
        raw = bytes(int(bits[k : k + 8], 2) for k in range(0, len(bits), 8))
        self.out += raw.replace(b"\xff", b"\xff\x00") + marker
        self.bits = ""


def halved(v, low):
    return (abs(v) >> low) * (1 if v >= 0 else -1)


def first_pass(w, rows, first, last, low):
    run = 0

    def close():
        nonlocal run
        if run:
            size = run.bit_length() - 1
            w.put(size << 4, 8)
            w.put(run - (1 << size), size)
            run = 0

    for block in rows:
        zeros = 0
        for k in range(first, last + 1):
            v = halved(block[k], low)
            if not v:
                zeros += 1
                continue
            close()
            while zeros > 15:
                w.put(0xF0, 8)
                zeros -= 16
            w.number(v, zeros)
            zeros = 0
        run += zeros > 0
    close()


def refinement(w, rows, first, last, low):
    """Without end-of-band runs of more than one block."""
    for block in rows:
        now = [halved(block[k], low) for k in range(first, last + 1)]
        new = [k for k, v in enumerate(now) if abs(v) == 1]
        until, zeros, waiting = (new[-1] if new else -1), 0, ""
        for k, v in enumerate(now[: until + 1]):
            if abs(v) > 1:
                waiting += str(abs(v) & 1)
            elif v:
                w.put(zeros << 4 | 1, 8)
                w.bits += ("1" if v > 0 else "0") + waiting
                zeros, waiting = 0, ""
            elif zeros == 15:
                w.put(0xF0, 8)
                w.bits += waiting
                zeros, waiting = 0, ""
            else:
                zeros += 1
        if until < last - first:
            w.put(0x00, 8)
            w.bits += waiting + "".join(str(abs(v) & 1) for v in now[until + 1 :] if abs(v) > 1)
        else:
            assert not waiting


def handmade(rnd, sampling, high, wide, restart):
    """(file, coefficients of each part): DC in two steps, AC in two bands and three steps."""
    seg = lambda m, b: bytes([0xFF, m]) + (len(b) + 2).to_bytes(2, "big") + b
    most_h, most_v = max(h for h, _ in sampling), max(v for _, v in sampling)
    rows, cols = -(-high // (8 * most_v)), -(-wide // (8 * most_h))
    parts = [[[[0] * 64 for _ in range(cols * h)] for _ in range(rows * v)] for h, v in sampling]
    sizes = [(-(-(-(-high * v // most_v)) // 8), -(-(-(-wide * h // most_h)) // 8)) for h, v in sampling]
    for part, (down, across) in zip(parts, sizes, strict=True):
        for y, line in enumerate(part):
            for x, block in enumerate(line):
                block[0] = rnd.randint(-300, 300)
                if y < down and x < across and rnd.random() < 0.7:
                    for k in rnd.sample(range(1, 64), rnd.choice((1, 3, 40))):
                        block[k] = rnd.choice((-1, 1)) * rnd.choice((1, 1, 2, 3, 5, 9, 40))
    frame = bytes([8]) + high.to_bytes(2, "big") + wide.to_bytes(2, "big") + bytes([len(sampling)])
    frame += b"".join(bytes([i + 1, h << 4 | v, 0]) for i, (h, v) in enumerate(sampling))
    table = bytes([0] * 7 + [255] + [0] * 8) + bytes(range(255))
    out = b"\xff\xd8" + seg(0xFE, b"by hand") + seg(0xDB, bytes([0x10]) + b"\x00\x02" * 64) + seg(0xC2, frame)
    out += seg(0xC4, b"\x00" + table + b"\x10" + table)
    out += seg(0xDD, restart.to_bytes(2, "big"))
    for step_high, low in ((0, 1), (1, 0)):
        out += seg(0xDA, bytes([len(parts)]) + b"".join(bytes([i + 1, 0]) for i in range(len(parts))) + bytes([0, 0, step_high << 4 | low]))
        w, before = Writer(), [0] * len(parts)
        units = [(0, y, x) for y in range(sizes[0][0]) for x in range(sizes[0][1])] if len(parts) == 1 else [(None, y, x) for y in range(rows) for x in range(cols)]
        for n, (one, y, x) in enumerate(units):
            if restart and n and n % restart == 0:
                w.flush(bytes([0xFF, 0xD0 + (n // restart - 1) % 8]))
                before = [0] * len(parts)
            each = [(0, y, x)] if one is not None else [(i, y * v + dy, x * h + dx) for i, (h, v) in enumerate(sampling) for dy in range(v) for dx in range(h)]
            for i, by, bx in each:
                v = parts[i][by][bx][0]
                if step_high:
                    w.put(v & 1, 1)
                else:
                    w.number((v >> 1) - before[i])
                    before[i] = v >> 1
        w.flush()
        out += w.out
    for first, last in ((1, 5), (6, 63)):
        for step_high, low in ((0, 2), (2, 1), (1, 0)):
            for i, (part, (down, across)) in enumerate(zip(parts, sizes, strict=True)):
                out += seg(0xDA, bytes([1, i + 1, 0, first, last, step_high << 4 | low]))
                w, blocks = Writer(), [part[y][x] for y in range(down) for x in range(across)]
                span = restart or len(blocks)
                for n, at in enumerate(range(0, len(blocks), span)):
                    if n:
                        w.flush(bytes([0xFF, 0xD0 + (n - 1) % 8]))
                    (refinement if step_high else first_pass)(w, blocks[at : at + span], first, last, low)
                w.flush()
                out += w.out
    return out + b"\xff\xd9", parts


@pytest.mark.parametrize("sampling", [[(1, 1)], [(1, 1)] * 3, [(2, 1), (1, 1), (1, 1)], [(2, 2), (1, 1), (1, 2)]])
@pytest.mark.parametrize("restart", [0, 5])
def test_handmade_files(spark, sampling, restart):
    media, parts = handmade(random.Random(len(sampling) + restart), sampling, 43, 61, restart)
    image = progressive.parse(media)
    for got, want in zip(progressive.coefficients(image), parts, strict=True):
        # a part of its own has no blocks beyond its edge
        rows, columns = image.parts[0].blocks if len(sampling) == 1 else got.shape[:2]
        assert got[:rows, :columns].tolist() == [line[:columns] for line in want[:rows]]
    assert jpeg.rgb(media).shape == (43, 61, 3)
    (row,) = jpeg.described(spark.createDataFrame([(1, 2, bytearray(media))], "doc_id long, n_bytes long, media binary")).collect()
    assert row.payload_bytes is None and row.media_bytes == len(media) and row.feature.startswith("61x43;")


def test_broken_files_raise():
    media, _ = handmade(random.Random(1), [(1, 1)], 20, 20, 0)
    baseline = media.replace(b"\xff\xc2", b"\xff\xc0", 1)
    scan = media.index(b"\xff\xda")
    for broken in (b"", b"\xff\xd8", media[:scan], media[: scan + 12], media[: scan + 10] + b"\xff\xd9", baseline, b"GIF89a" + media):
        with pytest.raises(ValueError):
            jpeg.rgb(broken)
