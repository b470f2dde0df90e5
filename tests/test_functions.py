import math
from datetime import datetime
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.functions import geometry as g
from sievework.functions import scalar as s
from sievework.operators.features import perceptual_hash, pixel_features, shrink
from sievework.operators.review import fill_polygon


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first()["x"]


def points(*xy):
    return F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in xy))


SQUARE = (0, 0), (2, 0), (2, 2), (0, 2)
CONCAVE = (0, 0), (2, 0), (1, 1), (2, 2), (0, 2)
BOW_TIE = (0, 0), (2, 2), (0, 2), (2, 0)


def test_capture_time(spark):
    name = F.col("n")
    assert one(spark, s.parse_capture_time(name), n="20260729_103953(0).jpg") == datetime(2026, 7, 29, 10, 39, 53)
    assert one(spark, s.parse_capture_time(name), n="other.jpg") is None
    assert one(spark, s.impossible_capture_time(name), n="20261399_103953.jpg") is True
    assert one(spark, s.impossible_capture_time(name), n="other.jpg") is False


def test_hashes(spark):
    assert one(spark, s.hamming(F.lit(0b1010), F.lit(0b0011)), n=1) == 2
    top = (1 << 63) - 1
    assert one(spark, s.hex_to_long(F.col("h")), h=f"{top:016x}") == top
    assert one(spark, s.long_to_hex(F.col("n")), n=255) == "00000000000000ff"


def test_points(spark):
    text = F.col("t")
    assert [tuple(p) for p in one(spark, s.parse_points(text), t="1,2;3.5,4")] == [(1.0, 2.0), (3.5, 4.0)]
    assert one(spark, s.try_parse_points(text), t="1,2;") is None
    with pytest.raises(Exception):  # noqa: B017
        one(spark, s.parse_points(text), t="1,2;")
    assert one(spark, s.drop_consecutive_points(text), t="1,2;1,2; 3,4 ;1,2") == "1,2;3,4;1,2"


def test_polygon_line_clips(spark):
    line = s.polygon_line(points((-1, 0), (50, 25), (101, 50)), F.lit(100), F.lit(50))
    assert one(spark, line, n=1) == "0 0.00000000 0.00000000 0.50000000 0.50000000 1.00000000 1.00000000"
    with pytest.raises(Exception):  # noqa: B017
        one(spark, s.polygon_line(points((0, 0), (1, 1)), F.lit(1), F.lit(1)), n=1)


def test_jpeg_end(spark):
    end = s.with_jpeg_end(F.col("c"))
    assert one(spark, end, c=bytearray(b"ab")) == b"ab\xff\xd9"
    assert one(spark, end, c=bytearray(b"ab\xff\xd9")) == b"ab\xff\xd9"


def test_names(spark):
    assert one(spark, s.suffix(F.col("p")), p="/a.b/C.JPG") == ".jpg"
    assert one(spark, s.stem(F.col("p")), p="/a.b/C.x.JPG") == "C.x"
    assert one(spark, s.stable_id(F.lit(7), F.lit(3)), n=1) == "image-0007-instance-003"
    assert one(spark, s.split_name(F.col("p")), p="validation") == "val"
    with pytest.raises(Exception):  # noqa: B017
        one(spark, s.split_name(F.col("p")), p="other")


def test_area_and_shape(spark):
    assert one(spark, g.area(points(*SQUARE)), n=1) == 4.0
    assert one(spark, g.area(points((0, 0), (1, 1))), n=1) == 0.0
    assert one(spark, g.is_concave(points(*SQUARE)), n=1) is False
    assert one(spark, g.is_concave(points(*CONCAVE)), n=1) is True
    assert one(spark, g.is_self_intersecting(points(*BOW_TIE)), n=1) is True
    assert one(spark, g.is_self_intersecting(points(*SQUARE)), n=1) is False
    assert one(spark, g.has_duplicate_vertices(points((0, 0), (2, 0), (2, 2), (2, 2))), n=1) is True
    assert one(spark, g.has_duplicate_vertices(points(*SQUARE)), n=1) is False


def test_frame(spark):
    size = F.lit(3000), F.lit(4000)
    assert one(spark, g.has_out_of_bounds_vertex(points((0, 0), (3000, 0), (3000, 4000)), *size), n=1) is False
    assert one(spark, g.has_out_of_bounds_vertex(points((3000.1, 0)), *size), n=1) is True
    assert one(spark, g.touches_frame(points((10, 10), (20, 20)), *size, 2.0), n=1) is False
    assert one(spark, g.touches_frame(points((10, 10), (2997.5, 20)), *size, 2.0), n=1) is True


def test_pixels():
    a = np.arange(64.0).reshape(8, 8)
    assert np.allclose(shrink(a, 8, 8), a)
    assert shrink(a, 1, 1)[0, 0] == pytest.approx(a.mean())
    assert bin(perceptual_hash(np.random.default_rng(1).integers(0, 255, (40, 60)))).count("1") == 31
    grey = np.full((5, 7, 3), 250, np.uint8)
    f = pixel_features(grey)
    assert (f["width"], f["height"], f["bright_fraction"], f["contrast_std"]) == (7, 5, 1.0, 0.0)


def test_fill():
    assert fill_polygon(np.array([[1, 1], [4, 1], [4, 4], [1, 4]]), 10, 10).sum() == 16
    assert fill_polygon(np.array([[-5, -5], [50, -5], [50, 50], [-5, 50]]), 10, 10).all()


def test_hash_of_tied_coefficients():
    # (0, 4) and (4, 0) are equal but for rounding, and one of them is the median; sum() would round otherwise
    data = bytes.fromhex("3d8f40949752a7577058da70894f657f943dcf918098c6af9c57689f0e807563a39cb985978ae25eff618e1bb79baa0074795265be76369f7d887a50cf60a471")
    weight = [[reduce(float.__add__, (math.cos(math.pi * u * (2 * (4 * i + k) + 1) / 64) for k in range(4))) * math.sqrt((1 if u == 0 else 2) / 32) for i in range(8)] for u in range(8)]
    values = []
    for u, v in [(n // 8, n % 8) for n in range(1, 64)]:
        total = 0.0
        for at, p in enumerate(data):
            total += p * weight[u][at // 8] * weight[v][at % 8]
        values.append(total)
    middle = sorted(values)[31]
    assert perceptual_hash(np.frombuffer(data, np.uint8).reshape(8, 8)) == sum(1 << i for i, x in enumerate(values) if x > middle) == 5248855307840925815
