"""Rows of pixels written as image files, by a data source of Spark's Python interface."""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: The signature of PNG files, and channels by colour type.
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
PNG_COLOUR = {1: 0, 3: 2, 4: 6}


def png(width: int, height: int, channels: int, pixels: bytes) -> bytes:
    """A PNG file of 8 bits a sample, row by row: grey, RGB or RGBA."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    stride = width * channels
    lines = b"".join(b"\0" + pixels[at : at + stride] for at in range(0, stride * height, stride))
    header = struct.pack(">IIBBBBB", width, height, 8, PNG_COLOUR[channels], 0, 0, 0)
    return PNG_SIGNATURE + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


@dataclass
class _Written(WriterCommitMessage):
    files: int


class _Writer(DataSourceWriter):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        os.makedirs(self.folder, exist_ok=True)
        count = 0
        for row in iterator:
            fits = None not in tuple(row) and row.channels in PNG_COLOUR and min(row.width, row.height) > 0 \
                and len(row.pixels) == row.width * row.height * row.channels
            if not fits:
                raise ValueError(f"{row.name}: pixels do not fit the image's size")
            target = os.path.join(self.folder, f"{row.name}.png")
            # Whole or not at all, and the same again when a lost task is run anew.
            partial = os.path.join(self.folder, f".{uuid.uuid4().hex}")
            with open(partial, "wb") as file:
                file.write(png(row.width, row.height, row.channels, bytes(row.pixels)))
            os.replace(partial, target)
            count += 1
        return _Written(count)


class ImageFiles(DataSource):
    """``df.write.format("image_files").mode("append").save(folder)``: one PNG file for each row.

    Rows are (name string, width int, height int, channels int, pixels binary) with unique names. The folder
    must be a path that all executors have mounted. A row whose pixels do not fit its size fails the job.
    """

    @classmethod
    def name(cls) -> str:
        return "image_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        place = urlparse(self.options["path"])
        if place.scheme not in ("", "file"):
            raise ValueError("image files are written to a mounted folder")
        return _Writer(unquote(place.path))


def write_images(images: DataFrame, folder: str) -> None:
    """Write rows (name, width, height, channels, pixels) as files of a folder; files of the same names are replaced."""
    images.sparkSession.dataSource.register(ImageFiles)
    images.select("name", "width", "height", "channels", "pixels").write.format("image_files").mode("append").save(folder)
