"""Catalogues of images and their sidecars. Sides are read from the files' headers; bodies are looked at only behind good ones."""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptoria.functions.text import natural_key
from scriptoria.sources.pictures import check_jpeg, encoded, png_rows
from scriptoria.sources.ranges import Counted, names_in, qualified, store

PROBED = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("error", T.StringType())])
SUFFIXES = ("bmp", "jpeg", "jpg", "png", "tif", "tiff", "webp")


def sides(content: bytes) -> tuple[int, int]:
    """(width, height) from the header of a PNG, JPEG, BMP, GIF, WebP or TIFF file."""
    if content[:8] == b"\x89PNG\r\n\x1a\n" and content[12:16] == b"IHDR":
        return struct.unpack(">II", content[16:24])
    if content[:2] == b"BM" and len(content) >= 26:
        w, h = struct.unpack("<ii", content[18:26])
        return w, abs(h)
    if content[:6] in (b"GIF87a", b"GIF89a"):
        return struct.unpack("<HH", content[6:10])
    if content[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(content):
            if content[at] != 0xFF:
                at += 1
                continue
            kind = content[at + 1]
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", content[at + 5 : at + 9])
                return w, h
            at += 2 if kind in (0xFF, 0x01) or 0xD0 <= kind <= 0xD9 else 2 + struct.unpack(">H", content[at + 2 : at + 4])[0]
    if content[:4] == b"RIFF" and content[8:12] == b"WEBP":
        if content[12:16] == b"VP8X":
            return 1 + int.from_bytes(content[24:27], "little"), 1 + int.from_bytes(content[27:30], "little")
        if content[12:16] == b"VP8L":
            bits = int.from_bytes(content[21:25], "little")
            return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
        if content[12:16] == b"VP8 ":
            w, h = struct.unpack("<HH", content[26:30])
            return w & 0x3FFF, h & 0x3FFF
    if content[:4] in (b"II*\x00", b"MM\x00*"):
        order = "<" if content[:2] == b"II" else ">"
        (at,) = struct.unpack(order + "I", content[4:8])
        (n,) = struct.unpack(order + "H", content[at : at + 2])
        found = {}
        for i in range(n):
            tag, kind, _ = struct.unpack(order + "HHI", content[at + 2 + 12 * i : at + 10 + 12 * i])
            raw = content[at + 10 + 12 * i : at + 14 + 12 * i]
            found[tag] = struct.unpack(order + ("H" if kind == 3 else "I"), raw[: 2 if kind == 3 else 4])[0]
        if 256 in found and 257 in found:
            return found[256], found[257]
    raise ValueError("no known image header")


@F.pandas_udf(PROBED)
def probe(content: pd.Series) -> pd.DataFrame:
    """Sides of image files, or why there are none."""
    out = []
    for c in content:
        try:
            if not c:
                raise ValueError("empty file")
            w, h = sides(bytes(c))
            out.append((w, h, None))
        except (ValueError, struct.error, IndexError) as e:
            out.append((None, None, str(e)))
    return pd.DataFrame(out, columns=["width", "height", "error"])


def check_body(content: bytes) -> None:
    """Raises ValueError where the picture behind a good header is cut off or broken: one answer on every machine, whatever is installed.

    PNG is unpacked, no further than its sides ask for, and its check sums are compared; JPEG scans are walked where nothing ends them; of
    the other formats the lengths and ends that they state are looked at.
    """
    if content[:4] == b"\x89PNG":
        png_rows(content)
    elif content[:2] == b"BM":
        (offset,) = struct.unpack("<I", content[10:14])
        width, height, _, depth, packed = struct.unpack("<iiHHI", content[18:34])
        if packed == 0 and len(content) < offset + abs(height) * (-(-abs(width) * depth // 32) * 4):
            raise ValueError("BMP is cut off")
    elif content[:2] == b"\xff\xd8":
        check_jpeg(content)
    elif content[:4] == b"GIF8":
        if not content.rstrip(b"\0").endswith(b";"):
            raise ValueError("GIF is cut off")
    elif content[:4] == b"RIFF" and len(content) < 8 + struct.unpack("<I", content[4:8])[0]:
        raise ValueError("WebP is cut off")


ADMITTED = "width int, height int, problem string, detail string"


def admitted(max_pixels: int = 100_000_000, min_side: int = 1):
    """A function of image bytes: struct(width, height, problem, detail).

    Sides up to min_side are invalid_image, too many pixels pixel_limit_exceeded; only what passes these cheap
    checks is decoded, and what cannot be is invalid_image. Null and empty bytes are invalid.
    """

    def judged(content: bytes | None) -> tuple[int | None, int | None, str | None, str | None]:
        w = h = None
        try:
            if not content:
                raise ValueError("empty file")
            w, h = sides(content)
            if w <= min_side or h <= min_side:
                raise ValueError(f"invalid dimensions {w}x{h}")
            if w * h > max_pixels:
                return w, h, "pixel_limit_exceeded", f"image has {w * h} pixels; limit is {max_pixels}"
            check_body(content)
        except (ValueError, struct.error, IndexError) as e:
            return w, h, "invalid_image", str(e)
        return w, h, None, None

    @F.pandas_udf(ADMITTED)
    def run(content: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judged(None if c is None else bytes(c)) for c in content], columns=["width", "height", "problem", "detail"]).astype({"width": "Int32", "height": "Int32"})

    return run


def png(width: int, height: int, pixels: bytes) -> bytes:
    """A PNG of rows of red, green and blue bytes."""
    if len(pixels) != 3 * width * height:
        raise ValueError("pixels do not fit the sides")
    rows = b"".join(b"\0" + pixels[3 * width * y : 3 * width * (y + 1)] for y in range(height))
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


#: First bytes of a file in which its sides are looked for; some formats have them far behind, and are then read whole.
HEAD_BYTES = 1 << 16

@lru_cache(1024)
def _real(folder: str) -> str:
    """Where a folder lies when links are followed; asked once for many files."""
    return os.path.realpath(folder)


INSPECTED = "path string, width int, height int, sha256 string, problem string, detail string"


def inspected(path: str, root: str | None = None, max_pixels: int = 100_000_000, min_side: int = 0) -> tuple[int | None, int | None, str | None, str | None, str | None]:
    """(width, height, sha256, problem, detail) of one file: missing, outside (of `root`, where links lead out of it), invalid_image, pixel_limit_exceeded or none.

    The sides are read first; of a picture that is too large nothing more is.
    """
    where, at = store(path)
    if where.get_file_info(at).type != fs.FileType.File:
        return None, None, None, "missing", path
    if root is not None and isinstance(where, fs.LocalFileSystem) and not (os.path.realpath(at) if os.path.islink(at) else f"{_real(os.path.dirname(at))}/").startswith(_real(store(root)[1]).rstrip("/") + "/"):
        return None, None, None, "outside", path
    w = h = None
    with Counted(path) as file:
        size = file.size()
        try:
            if not size:
                raise ValueError("empty file")
            head = file.read(0, min(size, HEAD_BYTES))
            try:
                w, h = sides(head)
            except (ValueError, struct.error, IndexError):
                if size <= HEAD_BYTES:
                    raise
                head = file.read(0, size)
                w, h = sides(head)
            if w <= min_side or h <= min_side:
                raise ValueError(f"invalid dimensions {w}x{h}")
            if w * h > max_pixels:
                return w, h, None, "pixel_limit_exceeded", f"image has {w * h} pixels; limit is {max_pixels}"
            content = head if len(head) == size else head + file.read(len(head), size - len(head))
            check_body(content)
        except (ValueError, struct.error, IndexError) as e:
            return w, h, None, "invalid_image", str(e)
    return w, h, hashlib.sha256(content).hexdigest(), None, None


def named_files(named: DataFrame, max_pixels: int = 100_000_000, min_side: int = 0) -> DataFrame:
    """(path, width, height, sha256, problem, detail) of each file that `named` (path, root) names, read once however often it is named.

    No folder is listed: what no row names is not touched. Null paths are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _real.cache_clear()
        for b in batches:
            found = [inspected(path, root, max_pixels, min_side) for path, root in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            columns = [pa.array(x, t) for x, t in zip(zip(*found, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()), strict=True)] if found else [pa.array([], t) for t in (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], ["path", "width", "height", "sha256", "problem", "detail"])

    distinct = named.where("path is not null").groupBy("path").agg(F.first("root").alias("root"))
    return distinct.repartition(max(1, named.sparkSession.sparkContext.defaultParallelism * 4), "path").mapInArrow(run, INSPECTED)


def contents(named: DataFrame) -> DataFrame:
    """(path, content) of each file that `named` (path) names and that is there, read once; one file a batch, so that a task holds one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                where, at = store(path)
                if where.get_file_info(at).type == fs.FileType.File:
                    with Counted(path) as file:
                        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([file.read(0, file.size())], pa.binary())], ["path", "content"])

    distinct = named.where("path is not null").select("path").distinct()
    return distinct.repartition(max(1, named.sparkSession.sparkContext.defaultParallelism * 4), "path").mapInArrow(run, "path string, content binary")


def with_content(rows: DataFrame, root: str, image: str = "image") -> DataFrame:
    """`rows` with content: the bytes of an image column struct<bytes, path>. Bytes win; else the file at path, which is taken from `root` unless it is absolute.

    Files are read once each, however many rows name them, and no others; a file that is not there gives null.
    """
    own, path = image_bytes(F.col(image))
    full = F.when(path.startswith("/") | path.contains("://"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))
    marked = rows.withColumn("__path", full)
    files = contents(marked.select(F.col("__path").alias("path"))).withColumnsRenamed({"path": "__path", "content": "__content"})
    return marked.join(files, "__path", "left").withColumn("content", F.coalesce(own, F.col("__content"))).drop("__path", "__content")


@F.pandas_udf(T.BinaryType())
def of_arrays(rasters: pd.Series) -> pd.Series:
    """PNG of rasters: rows of pixels, which are numbers (grey) or lists of one, three or four numbers from 0 to 255. Null where it is none."""

    def made(x: object) -> bytes | None:
        try:
            a = np.array([[np.asarray(p, np.int64).reshape(-1) for p in row] for row in x], np.int64)
        except (TypeError, ValueError):
            return None
        if a.ndim != 3 or not a.size or a.shape[2] not in (1, 3, 4) or a.min() < 0 or a.max() > 255:
            return None
        return encoded(np.repeat(a, 3, axis=2).astype(np.uint8) if a.shape[2] == 1 else a[:, :, :3].astype(np.uint8))

    return rasters.map(made)


def image_bytes(image: Column) -> tuple[Column, Column]:
    """(bytes, path) of an image column struct<bytes, path>: bytes come first, the path is used where there are none."""
    return image["bytes"], F.when(image["bytes"].isNull(), image["path"])


def checked_content(catalog: DataFrame, files: DataFrame) -> DataFrame:
    """(name, content, problem) of the pictures of a catalogue (name, size_bytes, modified, sha256) out of files (name, content, modified).

    The bytes are given only where size, time and digest are what the catalogue has; else the problem is
    'missing' or 'changed'.
    """
    now = files.select("name", F.col("content").alias("__content"), F.col("modified").alias("__modified"))
    both = catalog.join(now, "name", "left")
    same = (F.octet_length("__content") == F.col("size_bytes")) & F.col("__modified").eqNullSafe(F.col("modified")) & (F.sha2("__content", 256) == F.col("sha256"))
    problem = F.when(F.col("__content").isNull(), "missing").when(~F.coalesce(same, F.lit(False)), "changed")
    return both.select("name", F.when(problem.isNull(), F.col("__content")).alias("content"), problem.alias("problem"))


def opaque_id(path: Column) -> Column:
    return F.left(F.sha2(path.cast("binary"), 256), F.lit(24))


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """The images right in a folder, in natural order: image_id, name, stem, width, height, sha256, size_bytes, modified, error. A bad file is a row with an error, and so is one without a byte."""
    root = qualified(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sides out of the first bytes, and the digest of the file streamed, however large it is."""
        for b in batches:
            found = []
            for name in b.column(0).to_pylist():
                where, at = store(path := f"{root}/{name}")
                info = where.get_file_info(at)
                if info.type != fs.FileType.File:
                    continue
                w = h = error = None
                length, digest = info.size, hashlib.sha256()
                with Counted(path) as file:
                    head = file.read(0, min(length, HEAD_BYTES))
                    try:
                        w, h = sides(head)
                    except (ValueError, struct.error, IndexError) as e:
                        try:  # some formats have their sides far behind
                            w, h = sides(file.read(0, min(length, 64 << 20))) if length > HEAD_BYTES else (None, None)
                        except (ValueError, struct.error, IndexError):
                            pass
                        error = str(e) if w is None else None
                    for start in range(0, length, 1 << 20):
                        digest.update(file.read(start, 1 << 20))
                # Whole milliseconds, as Spark's listing has them.
                found.append((name, length, None if info.mtime_ns is None else info.mtime_ns // 1_000_000, w, h, error, digest.hexdigest()))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)], ["name", "length", "millis", "width", "height", "error", "sha256"])

    told = names_in(spark, root, tuple(f".{s}" for s in SUFFIXES)).mapInArrow(run, "name string, length long, millis long, width int, height int, error string, sha256 string")
    rows = told.select("name", F.col("length").alias("size_bytes"), F.timestamp_millis("millis").alias("modified"), "sha256", "width", "height", "error")
    out = rows.select(opaque_id(F.col("name")).alias("image_id"), "name", F.regexp_replace("name", r"\.[^.]*$", "").alias("stem"), "width", "height", "sha256", "size_bytes", "modified", "error")
    return out.orderBy(natural_key(F.col("name")), "name")


def duplicate_stems(images: DataFrame) -> DataFrame:
    """(stem, n) of stems that several images have, case apart: their sidecars would be one file."""
    return images.groupBy(F.lower("stem").alias("stem")).agg(F.count("*").alias("n")).where("n > 1")


def sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """(stem, annotation...) of the JSON files in a folder, one an image."""
    from scriptoria.schema import ANNOTATION

    rows = spark.read.schema(ANNOTATION).json(f"{folder}/*.json", multiLine=True)
    return rows.withColumn("stem", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", ""))
