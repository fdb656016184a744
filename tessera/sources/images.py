"""Images: fetched by URL with classed errors, read by name, and their size from the file's header."""

from __future__ import annotations

import hashlib
import struct
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

Fetch = Callable[[str], bytes]


def http_fetch(timeout: int = 10) -> Fetch:
    def fetch(url: str) -> bytes:
        request = urllib.request.Request(url, headers={"User-Agent": "Mozilla/5.0"})
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            return reply.read()

    return fetch


def fake_fetch(url: str) -> bytes:
    """A deterministic stand-in, by the md5 of the URL: failures of each class, what is no image, and headers of PNG files."""
    d = hashlib.md5(url.encode()).hexdigest()
    if d[0] == "0":
        raise TimeoutError("timed out")
    if d[0] == "1":
        raise urllib.error.HTTPError(url, 404, "Not Found", None, None)
    if d[0] == "2":
        raise ConnectionResetError("reset")
    if d[0] == "3":
        return b"<html>no image</html>"
    return b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + struct.pack(">II", int(d[2:4], 16) + 1, int(d[4:6], 16) + 1)


def error_class(e: Exception) -> str:
    """Timeout, HTTP and the status, or RequestError with the exception's name."""
    if isinstance(e, urllib.error.HTTPError):
        return f"HTTP {e.code}"
    if isinstance(e, TimeoutError) or isinstance(getattr(e, "reason", None), TimeoutError):
        return "Timeout"
    return f"RequestError({type(e).__name__})"


def jpeg_size(data: bytes) -> tuple[int, int]:
    at = 2
    while at + 9 <= len(data):
        if data[at] != 0xFF:
            raise ValueError("a marker is missing")
        kind = data[at + 1]
        if kind == 0xFF:
            at += 1
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            return width, height
        elif 0xD0 <= kind <= 0xD8 or kind == 1:
            at += 2
        else:
            at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
    raise ValueError("no frame header")


def webp_size(data: bytes) -> tuple[int, int]:
    kind = data[12:16]
    if kind == b"VP8X":
        return 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little")
    if kind == b"VP8L":
        bits = int.from_bytes(data[21:25], "little")
        return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
    if kind == b"VP8 ":
        width, height = struct.unpack("<HH", data[26:30])
        return width & 0x3FFF, height & 0x3FFF
    raise ValueError("unknown kind of webp")


def tiff_size(data: bytes) -> tuple[int, int]:
    end = "<" if data[:2] == b"II" else ">"
    at = struct.unpack(end + "I", data[4:8])[0]
    found = {}
    for i in range(struct.unpack(end + "H", data[at : at + 2])[0]):
        tag, kind, _ = struct.unpack(end + "HHI", data[at + 2 + 12 * i : at + 10 + 12 * i])
        if tag in (256, 257):
            width = {3: "H", 4: "I"}[kind]
            start = at + 10 + 12 * i
            found[tag] = struct.unpack(end + width, data[start : start + struct.calcsize(width)])[0]
    return found[256], found[257]


def image_size(data: bytes) -> tuple[int, int]:
    """(width, height) as the header says; ValueError for what is no image of a known kind."""
    try:
        if data.startswith(b"\x89PNG\r\n\x1a\n"):
            return struct.unpack(">II", data[16:24])
        if data[:6] in (b"GIF87a", b"GIF89a"):
            return struct.unpack("<HH", data[6:10])
        if data.startswith(b"\xff\xd8"):
            return jpeg_size(data)
        if data.startswith(b"BM"):
            width, height = struct.unpack("<ii", data[18:26])
            return width, abs(height)
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            return webp_size(data)
        if data[:4] in (b"II*\x00", b"MM\x00*"):
            return tiff_size(data)
    except (struct.error, IndexError, KeyError) as e:
        raise ValueError(f"broken header: {e}") from None
    raise ValueError("cannot identify image file")


FETCHED = [StructField("error", StringType()), StructField("load_error", StringType()), StructField("width", IntegerType()), StructField("height", IntegerType()), StructField("mode", StringType())]


def fetched(rows: DataFrame, url: str, filename: str, fetch: Fetch, folder: str | None = None) -> DataFrame:
    """rows with error (null where the fetch worked), load_error, width, height and mode.

    Each URL is fetched once in a task and, where a folder is given, saved under
    its file name: written under a temporary name and moved, so a repeated task
    leaves one good file.  What is no image is saved as it came.  Columns of the
    names made here are replaced.
    """
    low = {f.name for f in FETCHED}
    kept = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() not in low])
    schema = StructType([*kept.schema.fields, *FETCHED])
    at, name_at = kept.columns.index(url), kept.columns.index(filename)

    def one(u: str, name: str, save) -> tuple:
        try:
            data = fetch(u)
        except Exception as e:  # recorded: a raise would fail the job
            return error_class(e), None, 0, 0, ""
        if save:
            save(name, data)
        try:
            return None, None, *image_size(data), "RGB"
        except ValueError as e:
            return None, str(e)[:120], 0, 0, ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        save = None
        if folder:
            fs, root = pafs.FileSystem.from_uri(folder)

            def save(name: str, data: bytes) -> None:
                part = f"{root}/.{name}.{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as out:
                    out.write(data)
                fs.move(part, f"{root}/{name}")

        for b in batches:
            got = [one(u, n, save) for u, n in zip(b.column(at).to_pylist(), b.column(name_at).to_pylist(), strict=True)]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]
            cols = list(zip(*got, strict=True)) or [[]] * len(FETCHED)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=schema.names)

    return kept.mapInArrow(run, schema)


READ = [StructField("image", BinaryType()), StructField("image_exists", BooleanType()), StructField("image_bytes", LongType())]


def with_images(rows: DataFrame, folder: str, filename: str = "filename") -> DataFrame:
    """rows with image (null if there is none), image_exists and image_bytes, read by name where the row is; nothing is shuffled."""
    low = {f.name for f in READ}
    kept = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() not in low])
    schema, at = StructType([*kept.schema.fields, *READ]), kept.columns.index(filename)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)

        def read(name: str) -> bytes | None:
            try:
                with fs.open_input_stream(f"{root}/{name}") as f:
                    return f.read()
            except FileNotFoundError:
                return None

        for b in batches:
            got = [read(n) for n in b.column(at).to_pylist()]
            cols = [pa.array(got, pa.binary()), pa.array([x is not None for x in got]), pa.array([len(x or b"") for x in got], pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=schema.names)

    return kept.mapInArrow(run, schema)


def images(spark: SparkSession, folder: str) -> DataFrame:
    """(filename, image) of a folder, read by Spark: for stores that only Spark opens."""
    found = spark.read.format("binaryFile").load(folder)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("filename"), F.col("content").alias("image"))


def inspected(rows: DataFrame, image: str = "image") -> DataFrame:
    """rows with width, height, mode and load_error of their image bytes; a null image has none of them."""
    names = ("width", "height", "mode", "load_error")
    kept = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() not in names])
    schema = StructType([*kept.schema.fields, StructField("width", IntegerType()), StructField("height", IntegerType()), StructField("mode", StringType()), StructField("load_error", StringType())])
    at = kept.columns.index(image)

    def one(data: bytes | None) -> tuple:
        try:
            return (0, 0, "", None) if data is None else (*image_size(data), "RGB", None)
        except ValueError as e:
            return 0, 0, "", str(e)[:200]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(zip(*[one(x) for x in b.column(at).to_pylist()], strict=True)) or [[]] * 4
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=schema.names)

    return kept.mapInArrow(run, schema)
