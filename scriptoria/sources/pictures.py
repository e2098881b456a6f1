"""Pictures as rasters without an imaging library: PNG and BMP to pixels, crops, and PNG again; JPEG scans walked to their ends."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Channels by PNG colour type, and the seven passes of an interlaced PNG: first column and row, steps.
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
PASSES = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))
#: Pixels that a raster may have.
MAX_PIXELS = 100_000_000


def png_chunks(content: bytes) -> tuple[tuple[int, ...], bytes, bytes]:
    """(header, palette, packed data) of a PNG whose chunks are whole and whose check sums are right."""
    at, data, palette, header, ended = 8, [], b"", None, False
    while at + 12 <= len(content) and not ended:
        size, kind = struct.unpack(">I4s", content[at : at + 8])
        body = content[at + 8 : at + 8 + size]
        if len(body) < size or len(content) < at + 12 + size or zlib.crc32(kind + body) != struct.unpack(">I", content[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("broken PNG chunk")
        if kind == b"IHDR" and size == 13:
            header = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = body
        elif kind == b"IDAT":
            data.append(body)
        ended = kind == b"IEND"
        at += 12 + size
    if not ended or header is None:
        raise ValueError("PNG is cut off")
    if header[3] not in CHANNELS or header[2] not in (1, 2, 4, 8, 16) or not header[0] or not header[1]:
        raise ValueError("unknown PNG header")
    return header, palette, b"".join(data)


def png_passes(header: tuple[int, ...]) -> list[tuple[int, int, tuple[int, int, int, int]]]:
    """(width, height, place in the picture) of the pictures that a PNG's data hold: one, or up to seven."""
    width, height, *_, interlaced = header
    if not interlaced:
        return [(width, height, (0, 0, 1, 1))]
    sizes = [(-(-(width - x) // dx), -(-(height - y) // dy), (x, y, dx, dy)) for x, y, dx, dy in PASSES]
    return [s for s in sizes if s[0] > 0 and s[1] > 0]


def png_rows(content: bytes) -> tuple[tuple[int, ...], bytes, bytes]:
    """(header, palette, filtered rows) of a PNG; no more is unpacked than its header's sides ask for."""
    header, palette, packed = png_chunks(content)
    bits = header[2] * CHANNELS[header[3]]
    need = sum(h * (1 + -(-w * bits // 8)) for w, h, _ in png_passes(header))
    try:
        rows = zlib.decompressobj().decompress(packed, need)
    except zlib.error as e:
        raise ValueError("broken PNG data") from e
    if len(rows) < need:
        raise ValueError("PNG is cut off")
    return header, palette, rows


def unfiltered(rows: np.ndarray, step: int) -> np.ndarray:
    """Bytes of rows whose first byte tells a filter (none, left, up, mean, Paeth) by the pixel of `step` bytes before and the row above.

    Rows without mean and Paeth are sums; else all rows are told at once along slanted lines, on which no byte needs another.
    """
    kinds, body = rows[:, 0], rows[:, 1:]
    if kinds.max(initial=0) > 4:
        raise ValueError("unknown PNG filter")
    height, width = body.shape
    if kinds.max(initial=0) < 3:
        out = np.zeros((height, width), np.uint8)
        above = np.zeros(width, np.uint8)
        for y in range(height):
            line = body[y]
            if kinds[y] == 1:
                pixels = np.zeros(-(-width // step) * step, np.uint8)
                pixels[:width] = line
                line = np.add.accumulate(pixels.reshape(-1, step), axis=0, dtype=np.uint8).ravel()[:width]
            elif kinds[y] == 2:
                line = line + above
            out[y] = above = line
        return out
    columns = -(-width // step)
    padded = np.zeros((height, columns * step), np.int16)
    padded[:, :width] = body
    raw = padded.reshape(height, columns, step)
    done = np.zeros((height + 1, columns + 1, step), np.int16)
    kind = kinds.astype(np.int16)[:, None]
    for t in range(height + columns - 1):
        y = np.arange(max(0, t - columns + 1), min(height, t + 1))
        x = t - y
        left, up, corner = done[y + 1, x], done[y, x + 1], done[y, x]
        k = kind[y]
        guess = left + up - corner
        by_left, by_up, by_corner = np.abs(guess - left), np.abs(guess - up), np.abs(guess - corner)
        paeth = np.where((by_left <= by_up) & (by_left <= by_corner), left, np.where(by_up <= by_corner, up, corner))
        before = np.where(k == 1, left, np.where(k == 2, up, np.where(k == 3, (left + up) >> 1, np.where(k == 4, paeth, 0))))
        done[y + 1, x + 1] = (raw[y, x] + before) & 255
    return done[1:, 1:].reshape(height, -1)[:, :width].astype(np.uint8)


def _samples(lines: np.ndarray, width: int, depth: int, channels: int, palette: bool) -> np.ndarray:
    """(height, width, channels) of bytes: 16 bits keep their upper half, fewer than 8 are spread to 0..255, but for palette numbers."""
    height = len(lines)
    if depth == 16:
        lines = lines[:, ::2]
    elif depth < 8:
        bits = np.unpackbits(lines, axis=1).reshape(height, -1, depth)
        lines = (bits * (1 << np.arange(depth - 1, -1, -1, dtype=np.uint8))).sum(2).astype(np.uint8)[:, : width * channels]
        if not palette:
            lines = lines * np.uint8(255 // ((1 << depth) - 1))
    return lines.reshape(height, width, channels)


def _from_png(content: bytes) -> np.ndarray:
    header, palette, rows = png_rows(content)
    width, height, depth, colour, *_ = header
    channels, at = CHANNELS[colour], 0
    out = np.zeros((height, width, channels), np.uint8)
    for w, h, (x, y, dx, dy) in png_passes(header):
        size = 1 + -(-w * depth * channels // 8)
        part = np.frombuffer(rows, np.uint8, h * size, at).reshape(h, size)
        at += h * size
        out[y::dy, x::dx] = _samples(unfiltered(part, max(1, depth * channels // 8)), w, depth, channels, colour == 3)
    if colour == 3:
        colours = np.zeros((256, 3), np.uint8)
        known = np.frombuffer(palette[: len(palette) // 3 * 3], np.uint8).reshape(-1, 3)[:256]
        colours[: len(known)] = known
        return colours[out[:, :, 0]]
    return np.repeat(out[:, :, :1], 3, axis=2) if channels < 3 else out[:, :, :3]


def _from_bmp(content: bytes) -> np.ndarray:
    offset, size = struct.unpack("<I4x", content[10:18])[0], struct.unpack("<I", content[14:18])[0]
    width, height, _, depth, packed = struct.unpack("<iiHHI", content[18:34])
    if packed not in (0, 3) or depth not in (1, 4, 8, 24, 32) or width <= 0 or not height:
        raise ValueError("unknown BMP header")
    line = -(-width * depth // 32) * 4
    if len(content) < offset + abs(height) * line:
        raise ValueError("BMP is cut off")
    lines = np.frombuffer(content, np.uint8, abs(height) * line, offset).reshape(abs(height), line)
    lines = lines[::-1] if height > 0 else lines
    if depth >= 24:
        return np.ascontiguousarray(lines[:, : width * depth // 8].reshape(abs(height), width, depth // 8)[:, :, 2::-1])
    numbers = lines[:, :width] if depth == 8 else _samples(np.ascontiguousarray(lines), line * 8 // depth, depth, 1, True)[:, :width, 0]
    colours = np.zeros((256, 3), np.uint8)
    known = np.frombuffer(content[14 + size : offset][: 4 << depth], np.uint8)
    known = known[: len(known) // 4 * 4].reshape(-1, 4)
    colours[: len(known)] = known[:, 2::-1]
    return colours[numbers]


def raster(content: bytes, max_pixels: int = MAX_PIXELS) -> np.ndarray:
    """(height, width, 3) red, green and blue of a PNG or BMP; alpha is left out. Raises ValueError for other or broken pictures."""
    from scriptoria.sources.images import sides

    if content[:8] != b"\x89PNG\r\n\x1a\n" and content[:2] != b"BM":
        raise ValueError("neither PNG nor BMP")
    width, height = sides(content)
    if width * height > max_pixels:
        raise ValueError(f"{width * height} pixels")
    return _from_png(content) if content[:2] != b"BM" else _from_bmp(content)


def encoded(pixels: np.ndarray) -> bytes:
    """A PNG of a (height, width, 3) raster."""
    from scriptoria.sources.images import png

    return png(pixels.shape[1], pixels.shape[0], np.ascontiguousarray(pixels).tobytes())


def crop_pictures(crops: DataFrame, pictures: DataFrame, page: str = "page") -> DataFrame:
    """`crops` (page, order, box and others) with `picture`, the PNG of what stands in the box of the page's picture.

    `pictures` is (page, content). A page's picture is unpacked once, for all of its crops, whose places alone travel to it. A picture
    that is missing or cannot be read ends the job: an export is whole or is not.
    """
    boxes = crops.groupBy(F.col(page).alias("page")).agg(F.collect_list(F.struct(F.col("order").cast("long").alias("order"), F.col("box").cast("array<int>").alias("box"))).alias("boxes"))
    joined = boxes.join(pictures.select(F.col(page).alias("page"), "content"), "page", "left")
    kind = dict(joined.dtypes)["page"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, some, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if content.as_py() is None:
                    raise ValueError(f"page {name} has no picture")
                try:
                    pixels = raster(content.as_py())
                except (ValueError, struct.error, IndexError) as e:
                    raise ValueError(f"page {name}: {e}") from e
                found = []
                for x in some:
                    left, top, right, bottom = x["box"]
                    if not (0 <= left < right <= pixels.shape[1] and 0 <= top < bottom <= pixels.shape[0]):
                        raise ValueError(f"page {name}: a box {x['box']} outside {pixels.shape[1]}x{pixels.shape[0]}")
                    found.append((x["order"], encoded(pixels[top:bottom, left:right])))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), b.schema.field(0).type), pa.array([o for o, _ in found], pa.int64()), pa.array([p for _, p in found], pa.binary())], ["page", "order", "picture"])

    made = joined.select("page", "boxes", "content").mapInArrow(run, f"page {kind}, order long, picture binary").withColumnsRenamed({"page": "__page", "order": "__order"})
    return crops.join(made, (F.col(page) == F.col("__page")) & (F.col("order") == F.col("__order"))).drop("__page", "__order")


# --- JPEG


def _code_table(lengths: bytes, symbols: bytes) -> list[int]:
    """For each 16 bits that can come next: length << 8 | symbol of the code they begin with, 0 for none."""
    table: list[int] = []
    k = 0
    for length, n in enumerate(lengths, 1):
        for symbol in symbols[k : k + n]:
            table += [length << 8 | symbol] * (1 << (16 - length))
        k += n
    return (table + [0] * 65536)[:65536]


def _walked(data: bytes, units: int, blocks: list[tuple[list[int], list[int]]]) -> int:
    """How many of `units` units of blocks, each of a table for the first and one for the other coefficients, whole data hold; all of them where a code is unknown."""
    bits = int.from_bytes(data, "big")
    total = 8 * len(data)
    at, window, left = 0, 0, 0
    for unit in range(units):
        for first, others in blocks:
            k = 0
            while k < 64:
                if left < 32:  # the next bits, in pieces that stay small numbers
                    take = min(4096, total - at)
                    if take > 0:
                        window = (window & ((1 << left) - 1)) << take | (bits >> (total - at - take)) & ((1 << take) - 1)
                        left += take
                        at += take
                next16 = (window >> (left - 16) if left >= 16 else window << (16 - left)) & 0xFFFF
                entry = (others if k else first)[next16]
                if not entry:
                    return units if left >= 16 else unit
                size = entry & 15
                length = (entry >> 8) + size
                if length > left:
                    return unit
                left -= length
                if k and not entry & 255:
                    break
                k += (entry >> 4 & 15) + 1 if k else 1
    return units


_END_OF_SCAN = re.compile(rb"\xff+[^\x00\xff\xd0-\xd7]", re.DOTALL)
_RESTART = re.compile(rb"\xff+[\xd0-\xd7]")


def check_jpeg(content: bytes) -> None:
    """Raises ValueError where a JPEG ends before its picture does, as decoders do: what stands behind a marker that comes too early is none of theirs.

    A scan that another marker ends is whole by that. One that runs to the end of the file is walked: its codes have to
    give all blocks of the scan. Progressive pictures have to come to a marker, as another scan could follow.
    """
    at, tables, parts, restart, found = 2, {}, {}, 0, set()
    sequential, ended, sides_ = False, False, (0, 0)
    while at + 2 <= len(content):
        if content[at] != 0xFF:
            at += 1
            continue
        kind = content[at + 1]
        if kind in (0xFF, 0x00, 0x01) or 0xD0 <= kind <= 0xD8:
            at += 1 if kind == 0xFF else 2
            continue
        if kind == 0xD9:
            ended = True
            break
        (size,) = struct.unpack(">H", content[at + 2 : at + 4].ljust(2, b"\xff"))
        body = content[at + 4 : at + 2 + size]
        if len(body) < size - 2:
            raise ValueError("JPEG is cut off")
        at += 2 + size
        if kind == 0xC4:
            while len(body) >= 17:
                n = sum(body[1:17])
                tables[body[0]] = (body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif kind == 0xDD:
            (restart,) = struct.unpack(">H", body[:2])
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC8, 0xCC):
            sequential = kind in (0xC0, 0xC1)
            sides_ = struct.unpack(">HH", body[1:5])[::-1]
            parts = {body[6 + 3 * i]: (body[7 + 3 * i] >> 4 or 1, body[7 + 3 * i] & 15 or 1) for i in range(body[5])}
        elif kind == 0xDA:
            end = _END_OF_SCAN.search(content, at)
            names = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])} if body else dict.fromkeys(parts, 0)
            if end is None:
                if not sequential or not _whole_scan(content[at:], names, parts, tables, restart, sides_):
                    raise ValueError("JPEG is cut off")
                found.update(names)
                break
            found.update(names)
            at = end.start()
    if not found or not ended and not (sequential and found >= set(parts)):
        raise ValueError("JPEG is cut off")


def _whole_scan(data: bytes, names: dict[int, int], parts: dict[int, tuple[int, int]], tables: dict[int, tuple[bytes, bytes]], restart: int, sides_: tuple[int, int]) -> bool:
    """Whether entropy-coded data that nothing ends hold all blocks of a sequential scan."""
    known = {c: parts[c] for c in names if c in parts}
    if not known or any(names[c] >> 4 not in tables or (names[c] & 15 | 16) not in tables for c in known):
        return False
    across, down = max(h for h, _ in parts.values()), max(v for _, v in parts.values())
    if len(known) == 1:
        ((h, v),) = known.values()
        units = -(-(-(-sides_[0] * h // across)) // 8) * -(-(-(-sides_[1] * v // down)) // 8)
        repeats = {c: 1 for c in known}
    else:
        units = -(-sides_[0] // (8 * across)) * -(-sides_[1] // (8 * down))
        repeats = {c: h * v for c, (h, v) in known.items()}
    made = {k: _code_table(*t) for k, t in tables.items()}
    blocks = [(made[names[c] >> 4], made[names[c] & 15 | 16]) for c, n in repeats.items() for _ in range(n)]
    pieces = _RESTART.split(data)
    for i, piece in enumerate(pieces):
        want = min(restart, units) if restart else units
        if want and _walked(piece.replace(b"\xff\x00", b"\xff"), want, blocks) < want:
            return False if i == len(pieces) - 1 else units <= want
        units -= want
        if units <= 0:
            return True
    return False


__all__ = ["check_jpeg", "crop_pictures", "encoded", "png_rows", "raster", "unfiltered"]
