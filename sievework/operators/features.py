"""Image inventory: decoding, pixel statistics and perceptual hashes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LARGEST = 1024
DARK, BRIGHT = 15, 240
_SCHEMA = (
    "filename string, width int, height int, channels int, readable boolean, aspect_ratio double, brightness_mean double, contrast_std double, "
    "blur_laplacian_variance double, dark_fraction double, bright_fraction double, phash long"
)


@lru_cache(64)
def _cover(n: int, m: int) -> np.ndarray:
    """(m, n): the share that each of n pixels has in each of m new ones."""
    edge = np.linspace(0, n, m + 1)
    lo, hi = np.arange(n), np.arange(1, n + 1)
    return np.clip(np.minimum(edge[1:, None], hi) - np.maximum(edge[:-1, None], lo), 0, None) * (m / n)


def shrink(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """Area-averaging resize of a 2-D array: each new pixel is the mean of what it covers."""
    return _cover(a.shape[0], height) @ a @ _cover(a.shape[1], width).T


@lru_cache(32)
def _waves(n: int) -> np.ndarray:
    """(n, 8): the weights of n pixels, stretched to 32, in the lowest DCT coefficients of a side; summed in order."""
    cos = np.array([[math.cos(math.pi * u * (2 * k + 1) / 64) for u in range(8)] for k in range(32)])
    return np.cumsum(cos[:, None, :] * _cover(n, 32)[:, :, None], axis=0)[-1] * [math.sqrt((1 if u == 0 else 2) / 32) for u in range(8)]


def perceptual_hash(gray: np.ndarray) -> int:
    """63 bits: which of the lowest DCT coefficients but the first exceed their median.

    Coefficients of equal size are told apart by rounding alone, so pixels are added one after
    another, by rows: the order in which SQL over a table of pixels adds them.
    """
    small = shrink(gray.astype(float), min(32, gray.shape[0]), min(32, gray.shape[1]))
    down, across = map(_waves, small.shape)
    terms = (small[:, :, None] * down[:, None, :])[..., None] * across[None, :, None, :]
    values = np.cumsum(terms.reshape(-1, 64), axis=0)[-1][1:]
    return sum(1 << i for i in np.flatnonzero(values > np.median(values)).tolist())


def laplacian_variance(gray: np.ndarray) -> float:
    p = np.pad(gray.astype(float), 1, mode="reflect") if min(gray.shape) > 1 else np.pad(gray.astype(float), 1, mode="edge")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def pixel_features(bgr: np.ndarray) -> dict:
    """Statistics of an image (height, width, channels) on a copy of at most LARGEST pixels a side."""
    height, width = bgr.shape[:2]
    gray = bgr[..., 0].astype(float) if bgr.shape[2] == 1 else bgr[..., 0] * 0.114 + bgr[..., 1] * 0.587 + bgr[..., 2] * 0.299
    if (scale := LARGEST / max(height, width)) < 1:
        gray = shrink(gray, round(height * scale), round(width * scale))
    gray = np.rint(gray)
    return {
        "width": width, "height": height, "channels": bgr.shape[2], "readable": True, "aspect_ratio": width / height, "brightness_mean": float(gray.mean()), "contrast_std": float(gray.std()),
        "blur_laplacian_variance": laplacian_variance(gray), "dark_fraction": float((gray <= DARK).mean()), "bright_fraction": float((gray >= BRIGHT).mean()), "phash": perceptual_hash(gray),
    }


def inspect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From (filename, height, width, nChannels, data); undecodable images (height below 1) are unreadable."""
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            row = {"filename": r.filename, "readable": False}
            if r.height > 0 and r.width > 0:
                row |= pixel_features(np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.nChannels))
            rows.append(row)
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in _SCHEMA.split(", ")])
        yield out.astype({"width": "Int32", "height": "Int32", "channels": "Int32", "phash": "Int64"})


def image_inventory(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """The scanned files (filename, bytes, sha256) with pixel features; files that can't be decoded stay, unreadable."""
    images = spark.read.format("image").option("dropInvalid", "false").load(folder)
    rows = images.select(F.regexp_extract("image.origin", r"[^/]*$", 0).alias("filename"), "image.height", "image.width", "image.nChannels", "image.data")
    found = rows.mapInPandas(inspect, _SCHEMA)
    out = files.select("filename", "bytes", "sha256").join(found, "filename", "left").withColumn("readable", F.coalesce("readable", F.lit(False)))
    return out.withColumn("error", F.when(~F.col("readable"), "not decodable"))


def predictions(images: DataFrame, model, key: str, schema: str, chunk: int | None = None) -> DataFrame:
    """Rows that `model(frame)` gives for each Arrow batch of images; the key stays in the row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), chunk or max(1, len(batch))):
                yield model(batch.iloc[at : at + (chunk or len(batch))])

    return images.mapInPandas(run, schema)


def provenance(spark: SparkSession) -> dict[str, str]:
    """What ran: versions and settings, for a record beside results."""
    import platform

    return {"spark": spark.version, "python": platform.python_version(), "numpy": np.__version__, "pandas": pd.__version__, "master": spark.sparkContext.master, "time_zone": spark.conf.get("spark.sql.session.timeZone")}
