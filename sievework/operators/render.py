"""Pictures for reviewers: polygons over images, and sheets of thumbnails, as PNG.

There is no imaging library here: lines aren't smoothed, and the only glyphs are digits.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.ranks import numbered
from sievework.functions.scalar import golden_bgr
from sievework.operators.features import shrink
from sievework.operators.review import fill_polygon

#: Digits of 3 x 5 dots, a row of dots for each figure.
DIGITS = ["111101101101111", "010110010010111", "111001111100111", "111001111001111", "101101111001001", "111100111001111", "111100111101111", "111001001001001", "111101111101111", "111101111001111"]
FILL = 0.3


def png(bgr: np.ndarray) -> bytes:
    """An image (height, width, 3) of bytes as a PNG file."""
    height, width = bgr.shape[:2]
    lines = np.zeros((height, 1 + 3 * width), np.uint8)
    lines[:, 1:] = bgr[..., ::-1].reshape(height, -1)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")


def resized(bgr: np.ndarray, height: int, width: int) -> np.ndarray:
    return np.stack([np.rint(shrink(bgr[..., c].astype(float), height, width)) for c in range(bgr.shape[2])], 2).astype(np.uint8)


def colours(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """The bytes of a decoded image as (height, width, 3); grey is spread, transparency dropped."""
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(a, 3, 2) if channels == 1 else a[..., :3]


def write_number(canvas: np.ndarray, number: int, x: int, y: int, dot: int = 1) -> None:
    """Digits with their upper left corner at (x, y), in black on white, cut at the border."""
    for k, d in enumerate(str(number)):
        glyph = np.kron(np.array(list(DIGITS[int(d)]), int).reshape(5, 3), np.ones((dot, dot), int))
        at = x + 4 * dot * k
        part = canvas[max(0, y) : max(0, y + 5 * dot), max(0, at) : max(0, at + 3 * dot)]
        part[...] = np.where(glyph[max(0, -y) :, max(0, -at) :][: part.shape[0], : part.shape[1], None] == 1, 0, 255)


def outline(points: np.ndarray, width: int, height: int, thick: int) -> np.ndarray:
    """A mask of a closed line through the points, `thick` pixels wide."""
    mask = np.zeros((height, width), bool)
    for a, b in zip(points, np.roll(points, -1, 0), strict=True):
        n = int(np.abs(b - a).max()) + 1
        at = np.rint(np.linspace(a, b, n)).astype(int)
        for dx in range(thick):
            for dy in range(thick):
                x, y = at[:, 0] + dx - thick // 2, at[:, 1] + dy - thick // 2
                inside = (x >= 0) & (x < width) & (y >= 0) & (y < height)
                mask[y[inside], x[inside]] = True
    return mask


def overlay(bgr: np.ndarray, instances: list[tuple[int, np.ndarray, tuple[int, int, int]]], most: int) -> np.ndarray:
    """A copy of at most `most` pixels a side with each (number, points, colour) filled lightly, outlined and numbered."""
    height, width = bgr.shape[:2]
    scale = min(1.0, most / max(height, width))
    base = resized(bgr, max(1, round(height * scale)), max(1, round(width * scale))) if scale < 1 else bgr
    height, width = base.shape[:2]
    shapes = [(n, np.rint(p.astype(np.float32) * scale).astype(int), c) for n, p, c in instances if len(p)]
    filled = base.copy()
    for _, p, c in shapes:
        filled[fill_polygon(p, width, height)] = c
    canvas = np.rint(filled * FILL + base * (1 - FILL)).astype(np.uint8)
    for n, p, c in shapes:
        canvas[outline(p, width, height, max(2, round(4 * scale)))] = c
        write_number(canvas, n, int(p[0][0]), int(p[0][1]), max(1, round(3 * scale)))
    return canvas


def contact_sheet(images: list[np.ndarray], first: int, columns: int, cell: tuple[int, int], border: int, head: int) -> np.ndarray:
    """Images shrunk into cells (width, height) of a white grid, numbered from `first`."""
    width, height = cell
    rows = -(-len(images) // columns)
    canvas = np.full((rows * height, columns * width, 3), 255, np.uint8)
    for k, image in enumerate(images):
        scale = min(1.0, (width - 2 * border) / image.shape[1], (height - head - 2 * border) / image.shape[0])
        h, w = max(1, int(image.shape[0] * scale)), max(1, int(image.shape[1] * scale))
        x, y = k % columns * width + (width - w) // 2, k // columns * height + head
        canvas[y : y + h, x : x + w] = resized(image, h, w) if scale < 1 else image
        write_number(canvas, first + k, k % columns * width + border, k // columns * height + border, 2)
    return canvas


def overlays(images: DataFrame, polygons: DataFrame, most: int = 1600) -> DataFrame:
    """(filename, content): PNG overlays of the images.

    images: filename, height, width, nChannels, data, as Spark's image source decodes them; those that couldn't be
    decoded (height below 1) are left out, those without polygons stay as they are. polygons: filename,
    instance_index, points; an image's polygons are one row.
    """
    shape = F.struct("instance_index", golden_bgr(F.col("instance_index")).alias("colour"), F.transform("points", lambda p: F.array(p["x"], p["y"])).alias("points"))
    rows = images.where("height > 0").join(polygons.groupBy("filename").agg(F.array_sort(F.collect_list(shape)).alias("shapes")), "filename", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                found = [] if r.shapes is None else [(s["instance_index"], np.array([list(p) for p in s["points"]]).reshape(-1, 2), (s["colour"]["b"], s["colour"]["g"], s["colour"]["r"])) for s in r.shapes]
                out.append((r.filename, png(overlay(colours(r.data, r.height, r.width, r.nChannels), found, most))))
            yield pd.DataFrame(out, columns=["filename", "content"])

    return rows.select("filename", "height", "width", "nChannels", "data", "shapes").mapInPandas(run, "filename string, content binary")


def contact_sheets(images: DataFrame, order: list[str], size: int = 12, columns: int = 3, cell: tuple[int, int] = (360, 300), border: int = 6, head: int = 36) -> DataFrame:
    """(page, first, n, content): sheets of `size` images in order, numbered from 1; images as in overlays."""
    rows = numbered(images.where("height > 0"), order, "number").withColumn("page", (F.col("number") / size).cast("long") + 1)

    def run(key: tuple, page: pd.DataFrame) -> pd.DataFrame:
        page = page.sort_values("number")
        pictures = [colours(r.data, r.height, r.width, r.nChannels) for r in page.itertuples(index=False)]
        first = int(page["number"].iloc[0]) + 1
        return pd.DataFrame([(key[0], first, len(page), png(contact_sheet(pictures, first, columns, cell, border, head)))], columns=["page", "first", "n", "content"])

    return rows.select("page", "number", "height", "width", "nChannels", "data").groupBy("page").applyInPandas(run, "page long, first long, n long, content binary")


def png_size(content: Column) -> Column:
    """(width, height) as a PNG file's header gives them."""
    part = lambda at: F.conv(F.hex(F.substring(content, at, 4)), 16, 10).cast("int")
    return F.struct(part(17).alias("width"), part(21).alias("height"))
