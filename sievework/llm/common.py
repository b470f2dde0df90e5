"""What the operators of this subpackage share: tables and text hashing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.ship import ship_package

#: The characters of [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\x0c\r"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    """A column's name as a reference, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def kept(df: DataFrame, *replaced: str) -> list[Column]:
    """A table's columns but those that are replaced."""
    return [F.col(quoted(c)) for c in df.columns if c.lower() not in {r.lower() for r in replaced}]


def fresh(df: DataFrame, name: str) -> str:
    """A name that no column of a table has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def carried(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, and `carried`, a struct of all columns, for operators that add columns of any name."""
    return df.select(*(F.col(quoted(n)) for n in names), F.struct(*kept(df)).alias("carried"))


def released(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of `like` out of `carried`."""
    return df.select(*(F.col("carried").getField(c).alias(c) for c in like.columns))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, ASCII_UPPER, ASCII_UPPER.lower()))


_B = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over all 64."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


_SOLID = np.ones(256, np.int8)
_SOLID[list(map(ord, ASCII_SPACE))] = 0
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * _B)
_INV = np.uint64(pow(int(_B), -1, 1 << 64))


class _Powers:
    """Powers of a number modulo 2**64, kept and extended as longer texts come."""

    def __init__(self, base: np.uint64):
        self.base, self.known = base, np.ones(1, np.uint64)

    def __getitem__(self, n: int) -> np.ndarray:
        while len(self.known) < n:
            with np.errstate(over="ignore"):
                step = self.known[-1] * self.base
                self.known = np.concatenate([self.known, self.known * step])
        return self.known[:n]


_UP, _DOWN = _Powers(_B), _Powers(_INV)


def word_spans(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words [^\\x20\\x09-\\x0D]+ of a text in UTF-8 begin and end."""
    solid = np.zeros(len(a) + 2, np.int8)
    solid[1:-1] = _SOLID[a]
    edge = np.diff(solid)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def span_hashes(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of each span, the same wherever it lies."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(_VALUE[a] * _UP[len(a)], out=total[1:])
        return mix64(((total[hi] - total[lo]) * _DOWN[len(a)][lo]) ^ ((hi - lo).astype(np.uint64) * _M2))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of a text's words, in order."""
    a = np.frombuffer(text, np.uint8)
    if not len(a):
        return np.empty(0, np.uint64)
    return span_hashes(a, *word_spans(a))
