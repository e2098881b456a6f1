"""Pictures to pixels: PNG of every depth, colour, filter and interlacing, BMP, crops; JPEG files cut off anywhere."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptoria.sources import images, pictures


def chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def packed(samples, depth):
    """Rows of samples as bytes."""
    flat = samples.reshape(len(samples), -1)
    if depth == 16:
        return np.stack([flat >> 8, flat & 255], 2).reshape(len(flat), -1).astype(np.uint8)
    if depth == 8:
        return flat.astype(np.uint8)
    bits = (flat[:, :, None] >> np.arange(depth - 1, -1, -1)) & 1
    return np.packbits(bits.reshape(len(flat), -1).astype(np.uint8), axis=1)


def filtered(lines, step, kinds):
    """Rows under the filters named, the plain way, byte by byte."""
    out, above = [], [0] * lines.shape[1]
    for line, kind in zip(lines.tolist(), kinds, strict=True):
        row = [kind]
        for i, x in enumerate(line):
            a, b, c = (line[i - step] if i >= step else 0), above[i], (above[i - step] if i >= step else 0)
            p = a + b - c
            guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            row.append((x - (0, a, b, (a + b) // 2, guess)[kind]) & 255)
        out.append(bytes(row))
        above = line
    return b"".join(out)


def png_of(samples, depth, colour, rng, kinds=(0, 1, 2, 3, 4), interlaced=False, palette=b""):
    height, width = samples.shape[:2]
    step = max(1, depth * pictures.CHANNELS[colour] // 8)
    header = (width, height, depth, colour, 0, 0, int(interlaced))
    data = b""
    for w, h, (x, y, dx, dy) in pictures.png_passes(header):
        part = samples[y::dy, x::dx]
        assert part.shape[:2] == (h, w)
        data += filtered(packed(part, depth), step, [int(rng.choice(kinds)) for _ in range(h)])
    whole = zlib.compress(data)
    body = chunk(b"IDAT", whole[: len(whole) // 2]) + chunk(b"IDAT", whole[len(whole) // 2 :])
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", *header)) + (chunk(b"PLTE", palette) if palette else b"") + body + chunk(b"IEND", b"")


@pytest.mark.parametrize(("colour", "depth"), [(0, 1), (0, 2), (0, 4), (0, 8), (0, 16), (2, 8), (2, 16), (3, 1), (3, 2), (3, 4), (3, 8), (4, 8), (4, 16), (6, 8), (6, 16)])
@pytest.mark.parametrize("interlaced", [False, True])
def test_png_to_pixels(colour, depth, interlaced):
    rng = np.random.default_rng(colour * 100 + depth)
    palette = rng.bytes(3 << min(depth, 8))
    for height, width in ((1, 1), (5, 3), (13, 17), (8, 9)):
        samples = rng.integers(0, 1 << depth, (height, width, pictures.CHANNELS[colour]))
        if colour == 3:
            want = np.frombuffer(palette, np.uint8).reshape(-1, 3)[samples[:, :, 0]]
        else:
            eight = samples >> 8 if depth == 16 else samples * (255 // ((1 << depth) - 1))
            want = np.repeat(eight[:, :, :1], 3, axis=2) if colour in (0, 4) else eight[:, :, :3]
        for kinds in ((0, 1, 2), (0, 1, 2, 3, 4), (4,)):
            content = png_of(samples, depth, colour, rng, kinds, interlaced, palette if colour == 3 else b"")
            assert np.array_equal(pictures.raster(content), want)
            images.check_body(content)


def bmp_of(pixels, depth, top_down=False):
    height, width, _ = pixels.shape
    colours = b""
    if depth < 24:
        known = sorted({tuple(x) for x in pixels.reshape(-1, 3).tolist()})
        number = {x: i for i, x in enumerate(known)}
        lines = packed(np.array([[number[tuple(x)] for x in row] for row in pixels.tolist()])[:, :, None], depth)
        colours = b"".join(bytes((b, g, r, 0)) for r, g, b in known).ljust(4 << depth, b"\0")
    else:
        more = np.concatenate([pixels[:, :, ::-1], np.full((height, width, 1), 7, np.uint8)], 2)[:, :, : depth // 8]
        lines = more.reshape(height, -1).astype(np.uint8)
    size = -(-width * depth // 32) * 4
    rows = [bytes(x).ljust(size, b"\0") for x in lines]
    body = b"".join(rows if top_down else rows[::-1])
    offset = 54 + len(colours)
    return b"BM" + struct.pack("<IHHI", offset + len(body), 0, 0, offset) + struct.pack("<IiiHHIIiiII", 40, width, -height if top_down else height, 1, depth, 0, len(body), 0, 0, 0, 0) + colours + body


@pytest.mark.parametrize("depth", [1, 4, 8, 24, 32])
def test_bmp_to_pixels(depth):
    rng = np.random.default_rng(depth)
    some = rng.integers(0, 256, (1 << min(depth, 4), 3))
    pixels = some[rng.integers(0, len(some), (7, 11))].astype(np.uint8)
    for top_down in (False, True):
        content = bmp_of(pixels, depth, top_down)
        assert np.array_equal(pictures.raster(content), pixels)
        with pytest.raises(ValueError, match="cut off"):
            pictures.raster(content[:-1])


def test_pictures_that_are_broken_or_too_large():
    rng = np.random.default_rng(1)
    good = png_of(rng.integers(0, 256, (9, 9, 3)), 8, 2, rng)
    for end in range(33, len(good) - 12):
        with pytest.raises(ValueError):
            images.check_body(good[:end])
    # A small header before data that would fill the memory: no more is unpacked than the header asks for.
    bomb = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 2, 2, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(bytes(200 << 20))) + chunk(b"IEND", b"")
    assert len(pictures.png_rows(bomb)[2]) == 14
    with pytest.raises(ValueError, match="pixels"):
        pictures.raster(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 100_000, 100_000, 8, 2, 0, 0, 0)) + chunk(b"IEND", b""))
    with pytest.raises(ValueError, match="neither"):
        pictures.raster(b"GIF89a")


def test_crops_are_the_raster(spark):
    """Crops of several pages are parts of their rasters; one picture that is missing, broken or too small for a box fails the export."""
    rng = np.random.default_rng(8)
    rasters = {i: rng.integers(0, 256, (20 + i, 30, 3)).astype(np.uint8) for i in range(4)}
    content = {i: png_of(x, 8, 2, rng) if i % 2 else bmp_of(x, 24) for i, x in rasters.items()}
    boxes = [(i, n, [n, 2 * n, 10 + n, 12 + n], "OCR:") for i in rasters for n in range(5)]
    crops = spark.createDataFrame(boxes, "page int, order int, box array<int>, prompt string")
    table = lambda d: spark.createDataFrame(list(d.items()), "page int, content binary")
    got = pictures.crop_pictures(crops, table(content)).collect()
    assert len(got) == len(boxes) and got[0].asDict().keys() == {"page", "order", "box", "prompt", "picture"}
    for r in got:
        left, top, right, bottom = r["box"]
        assert np.array_equal(pictures.raster(bytes(r["picture"])), rasters[r["page"]][top:bottom, left:right])
    for bad, message in ((content | {2: content[2][:60]}, "page 2"), ({k: v for k, v in content.items() if k != 3}, "page 3 has no picture"), (content | {1: png_of(rasters[1][:5], 8, 2, rng)}, "outside 30x5")):
        with pytest.raises(Exception, match=message):
            pictures.crop_pictures(crops, table(bad)).collect()


# --- JPEG

DC, AC = list(range(12)), [0x00, 0xF0] + [r << 4 | s for r in range(16) for s in range(1, 11)]


def jpeg_of(rng, width, height, parts, restart=0, apart=False):
    """A sequential JPEG of random coefficients: codes of 4 and 8 bits; parts: {component: (across, down)}; apart: a scan each."""
    segment = lambda kind, body: b"\xff" + bytes([kind]) + struct.pack(">H", len(body) + 2) + body
    across, down = max(h for h, _ in parts.values()), max(v for _, v in parts.values())
    out = b"\xff\xd8" + segment(0xE0, b"JFIF\0") + segment(0xC0, struct.pack(">BHHB", 8, height, width, len(parts)) + b"".join(bytes([c, h << 4 | v, 0]) for c, (h, v) in parts.items()))
    out += segment(0xC4, b"\x00" + bytes([0, 0, 0, 12] + [0] * 12) + bytes(DC)) + segment(0xC4, b"\x10" + bytes([0] * 7 + [len(AC)] + [0] * 8) + bytes(AC))
    if restart:
        out += segment(0xDD, struct.pack(">H", restart))
    begins = []
    for names in [[c] for c in parts] if apart else [list(parts)]:
        if len(names) == 1:
            h, v = parts[names[0]]
            units, blocks = -(-(-(-width * h // across)) // 8) * -(-(-(-height * v // down)) // 8), 1
        else:
            units, blocks = -(-width // (8 * across)) * -(-height // (8 * down)), sum(h * v for h, v in parts.values())
        out += segment(0xDA, bytes([len(names)]) + b"".join(bytes([c, 0]) for c in names) + bytes([0, 63, 0]))
        begins.append(len(out))
        pieces, bits = [], ""
        for unit in range(units):
            for _ in range(blocks):
                s = int(rng.integers(0, 12))
                bits += f"{s:04b}" + "".join(rng.choice(["0", "1"], s))
                k = 1
                while k < 64:
                    i = int(rng.integers(0, len(AC))) if rng.random() < 0.8 else 0
                    if i and k + (AC[i] >> 4) > 63:
                        i = 0
                    bits += f"{i:08b}" + "".join(rng.choice(["0", "1"], AC[i] & 15))
                    if not AC[i]:
                        break
                    k += (AC[i] >> 4) + 1
            if restart and (unit + 1) % restart == 0 and unit + 1 < units:
                pieces.append(bits)
                bits = ""
        pieces.append(bits)
        for n, piece in enumerate(pieces):
            piece += "1" * (-len(piece) % 8)
            out += int(piece, 2).to_bytes(len(piece) // 8, "big").replace(b"\xff", b"\xff\x00") + (b"\xff" + bytes([0xD0 + n % 8]) if n + 1 < len(pieces) else b"")
    return out + b"\xff\xd9", begins


@pytest.mark.parametrize(("width", "height", "parts", "restart", "apart"), [(9, 9, {1: (1, 1)}, 0, False), (20, 17, {1: (2, 2), 2: (1, 1), 3: (1, 1)}, 0, False), (33, 20, {1: (2, 1), 2: (1, 1), 3: (1, 1)}, 2, False), (20, 20, {1: (1, 1), 2: (1, 1)}, 0, True), (40, 8, {1: (1, 1)}, 1, False)])
def test_jpeg_cut_off_anywhere(width, height, parts, restart, apart):
    """Whole, and without its last marker, a picture is good; cut off at any byte of any scan it is not."""
    content, begins = jpeg_of(np.random.default_rng(width), width, height, parts, restart, apart)
    assert images.sides(content) == (width, height)
    images.check_body(content)
    images.check_body(content[:-1])
    images.check_body(content[:-2])
    for end in [*range(20, begins[0]), *range(begins[0], len(content) - 3)]:
        with pytest.raises(ValueError):
            images.check_body(content[:end])


def test_jpeg_of_other_kinds():
    """A marker that comes early ends a scan, as it does for decoders; a progressive picture must come to a marker."""
    content, begins = jpeg_of(np.random.default_rng(3), 30, 30, {1: (1, 1)})
    images.check_body(content[: begins[0] + 5] + b"\xff\xd9")
    progressive = content.replace(b"\xff\xc0", b"\xff\xc2", 1)
    images.check_body(progressive)
    with pytest.raises(ValueError):
        images.check_body(progressive[:-2])


def test_admission_of_jpegs(spark):
    content, _ = jpeg_of(np.random.default_rng(4), 24, 24, {1: (1, 1)})
    df = spark.createDataFrame([(0, content), (1, content[:-9]), (2, b"\xff\xd8"), (3, None)], "id int, content binary")
    got = {r["id"]: r["a"]["problem"] for r in df.select("id", images.admitted()(F.col("content")).alias("a")).collect()}
    assert got == {0: None, 1: "invalid_image", 2: "invalid_image", 3: "invalid_image"}


# --- named files


def test_files_that_rows_name(spark, tmp_path):
    """Each file is read once, those that no row names are not touched (a pipe would never end), links out of the folder are refused, a header far behind the first bytes is found."""
    import os

    from scriptoria.operators import admission
    from scriptoria.sources import datasets

    rng = np.random.default_rng(12)
    root = tmp_path / "pictures"
    root.mkdir()
    good = png_of(rng.integers(0, 256, (9, 7, 3)), 8, 2, rng)
    jpeg, _ = jpeg_of(rng, 24, 16, {1: (1, 1)})
    far = jpeg[:2] + b"".join(b"\xff\xe1" + struct.pack(">H", 65_000) + bytes(64_998) for _ in range(3)) + jpeg[2:]
    for name, content in {"a.png": good, "copy.png": good, "far.jpg": far, "cut.png": good[:-30], "none.png": b"", "tall.bmp": bmp_of(np.zeros((300, 1, 3), np.uint8), 24)}.items():
        (root / name).write_bytes(content)
    (tmp_path / "outside.png").write_bytes(good)
    (root / "link.png").symlink_to(tmp_path / "outside.png")
    (root / "folder.png").mkdir()
    os.mkfifo(root / "pipe.png")
    box = '[{"transcription":"x","points":[[0,0],[5,0],[5,5],[0,5]]}]'
    names = ["a.png", "far.jpg", "copy.png", "cut.png", "none.png", "gone.png", "link.png", "folder.png", "../outside.png", "a.png", "tall.bmp"]
    (tmp_path / "Label.txt").write_text("".join(f"{n}\t{box}\n" for n in names) + "\nno tab\n")
    lines = datasets.read_label_lines(spark, str(tmp_path / "Label.txt")).select(F.lit("s").alias("source"), "line_number", "value", F.lit(str(root)).alias("root"))
    rows, lost = admission.detection_of_files(lines, max_image_pixels=299)
    reasons = [r["reason"] for r in rows.orderBy("line_number").collect()]
    assert reasons[:2] == [None, "invalid_image"]  # 24 x 16 pixels are too many here
    assert reasons[2:] == ["duplicate_image", "invalid_image", "invalid_image", "missing_image", "unsafe_image_path", "missing_image", "unsafe_image_path", "duplicate_image", "invalid_image", "empty_line", "invalid_line"]
    rows, _ = admission.detection_of_files(lines)
    found = {r["line_number"]: (r["reason"], r["width"], r["height"]) for r in rows.collect()}
    assert found[1] == (None, 7, 9) and found[2] == (None, 24, 16) and found[11] == ("no_valid_boxes", 1, 300)
    assert lost.where("reason = 'missing_image'").count() == 2
    values = spark.createDataFrame([(1, (None, "a.png")), (2, (b"own", "a.png")), (3, (None, "gone.png")), (4, (None, str(tmp_path / "outside.png"))), (5, None)], "id int, image struct<bytes:binary,path:string>")
    got = {r["id"]: r["content"] and bytes(r["content"]) for r in images.with_content(values, str(root)).collect()}
    assert got == {1: good, 2: b"own", 3: None, 4: good, 5: None}


def test_rasters_as_values(spark):
    """Values that are arrays: colour, grey and alpha; what is no raster gives null."""
    three = [[[1, 2, 3], [4, 5, 6]], [[7, 8, 9], [250, 251, 255]]]
    cases = [three, [[[1, 2, 3, 9], [4, 5, 6, 9]]], [[[5], [6]]], [[[1, 2], [3, 4]]], [[[256, 0, 0]]], [[[1, 2, 3]], [[1, 2, 3], [4, 5, 6]]], [], None]
    df = spark.createDataFrame(list(enumerate(cases)), "id int, image array<array<array<int>>>")
    got = [r["content"] for r in df.select("id", images.of_arrays("image").alias("content")).orderBy("id").collect()]
    assert np.array_equal(pictures.raster(bytes(got[0])), three) and np.array_equal(pictures.raster(bytes(got[1])), [[[1, 2, 3], [4, 5, 6]]]) and np.array_equal(pictures.raster(bytes(got[2])), [[[5] * 3, [6] * 3]])
    assert got[3:] == [None] * 5
