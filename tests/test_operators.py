import random
import statistics
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievework.functions import ranks
from sievework.functions.scratch import Scratch
from sievework.operators import dedup, features, grouping, render, review, selection, splits, validation
from sievework.operators.components import connected_components
from sievework.sources import annotations, files, sinks
from sievework.streaming.sessions import stream_islands


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_components_match_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    expected = {x: top(x) for e in edges if e[0] != e[1] for x in e}
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b", Scratch(spark, "test"))
    got = dict(rows(got))
    assert {k: v for k, v in got.items() if k in expected} == expected


def test_components_of_strings_and_nothing(spark):
    scratch = Scratch(spark, "test")
    got = connected_components(spark.createDataFrame([("a", "b"), ("c", "d")], "a string, b string"), "a", "b", scratch)
    assert rows(got) == [("a", "a"), ("b", "a"), ("c", "c"), ("d", "c")]
    assert rows(connected_components(spark.createDataFrame([], "a long, b long"), "a", "b", Scratch(spark, "test"))) == []


def test_bands_equal_brute_force(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(63) for _ in range(60)]
    sigs = base + [b ^ sum(1 << rng.randrange(63) for _ in range(rng.randrange(9))) & ((1 << 63) - 1) for b in base]
    df = spark.createDataFrame([(i, s, i % 2) for i, s in enumerate(sigs)], "id long, sig long, dim int")
    expected = sorted((i, j, (sigs[i] ^ sigs[j]).bit_count()) for i in range(120) for j in range(i + 1, 120) if (sigs[i] ^ sigs[j]).bit_count() <= 6)
    for banded in (True, False):
        assert rows(dedup.near_pairs(df, "id", F.col("sig"), 6, banded=banded)) == expected
    same = [p for p in expected if (p[0] - p[1]) % 2 == 0]
    assert rows(dedup.near_pairs(df, "id", F.col("sig"), 6, keys=["dim"])) == same


def test_min_distance_in_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(i, i * 7919 % 4096) for i in range(50)], "id long, sig long")
    few = dedup.min_distance(df.where("id >= 20"), df.where("id < 20"), "id", "sig")
    monkeypatch.setattr(dedup, "BROADCAST_ROWS", 6)
    assert rows(dedup.min_distance(df.where("id >= 20"), df.where("id < 20"), "id", "sig")) == rows(few)
    assert rows(dedup.min_distance(df, df.where("id < 0"), "id", "sig")) == []


def test_numbered_components(spark):
    c = spark.createDataFrame([(x,) for x in [5, 5, 9, 1, 30, 30]], "component long")
    assert rows(grouping.numbered(c)) == [(1, "scene-0001"), (5, "scene-0002"), (9, "scene-0003"), (30, "scene-0004")]


def test_gap_is_inclusive(spark):
    events = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ'2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) AS ts, s AS id FROM VALUES (0), (3), (7) AS t(s)")
    assert sorted(r["n"] for r in grouping.gap_islands(events, ["k"], "ts", "3 seconds").collect()) == [1, 2]
    assert rows(grouping.chain_edges(events, "id", "ts", 3)) == [(0, 3)]


def test_splits(spark):
    sizes = {f"g{i}": 1 + i % 5 for i in range(20)}
    got = splits.assign_groups(sizes, {"train": 0.7, "validation": 0.15, "test": 0.15}, 20260731)
    counts = defaultdict(int)
    for k, v in got.items():
        counts[v] += sizes[k]
    assert sum(counts.values()) == 60 and 36 <= counts["train"] <= 46
    assert got == splits.assign_groups(sizes, {"train": 0.7, "validation": 0.15, "test": 0.15}, 20260731)
    df = spark.createDataFrame([("a", "train"), ("a", "test"), ("b", "train"), (None, "test")], "g string, s string")
    assert rows(splits.leaking_groups(df, "g", "s")) == [("test", "train", "a")]


def test_ranks(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([10.0, 5.0, 20.0])], "pos long, v double")
    got = selection.rank_percentiles(df, {"r": F.col("v")}, "pos").orderBy("pos")
    assert [r["r"] for r in got.collect()] == [0.5, 0.0, 1.0]
    tied = spark.createDataFrame([(i, 1.0) for i in range(5)], "pos long, v double")
    got = selection.rank_percentiles(tied, {"r": F.col("v")}, "pos").orderBy("pos")
    assert [r["r"] for r in got.collect()] == [0, 0.25, 0.5, 0.75, 1.0]
    single = selection.rank_percentiles(tied.limit(1), {"r": F.col("v")}, "pos").collect()
    assert [r["r"] for r in single] == [0.0]


def test_greedy_choice(spark):
    data = [("a", "s1", 0.9, 0x0, False), ("b", "s1", 0.8, 0xFF, False), ("c", "s2", 0.7, 0xFF00, True), ("d", "s3", 0.6, 0xFF0000, True), ("e", "s3", 0.5, 0xFF000000, False)]
    df = spark.createDataFrame(data, "id string, group string, score double, sig long, zero boolean")
    chosen = selection.select_diverse(df, 3, 1, 1, 2)
    assert [r["id"] for r in chosen] == ["a", "c", "e"]
    assert [r["id"] for r in selection.scene_representatives(df, 2)] == ["a", "c", "d"]
    same = df.withColumn("sig", F.lit(0).cast("long"))
    with pytest.raises(ValueError):
        selection.scene_representatives(same, 2)


def test_workload_penalty(spark):
    df = spark.createDataFrame([("a", 140), ("b", 50)], "id string, n int").withColumn("s", selection.adjusted_score(F.lit(0.8), F.col("n"), 40, 0.0025))
    assert {r["id"]: round(r["s"], 6) for r in df.collect()} == {"a": 0.55, "b": 0.775}


def test_reasons(spark):
    ranks = {c: 0.8 for c in selection.REASONS}
    df = spark.createDataFrame([(0, *ranks.values()), (3, *(0.1 for _ in ranks))], ["n", *ranks]).select(selection.selection_reason(F.col("n")).alias("r"))
    assert [r["r"] for r in df.collect()] == ["model_hic_yuz_bulamadi;dusuk_guven;kalabalik_sahne", "sahne_cesitliligi"]


def test_gates(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k long"), spark.createDataFrame([(2,), (3,)], "k long")
    assert rows(validation.missing_in(a, b, "k")) == [(1,)]
    assert rows(validation.unequal_names(a, b, "k")) == [(1, True, False), (3, False, True)]
    with pytest.raises(validation.GateError):
        validation.assert_empty(validation.missing_in(a, b, "k"), "present")
    validation.assert_empty(a.where("k > 5"), "none")
    assert validation.policy_violations({"split": "test"}, {"split": "val"}) == ["split: 'test', not 'val'"]


def test_review_ladder(spark):
    cases = {("MISSING_SOURCE_IMAGE", "SELF_INTERSECTION"): "P0", ("SELF_INTERSECTION",): "P1", ("VERY_SMALL_MASK_REVIEW",): "P1", ("POLYGON_OVERLAP_REVIEW:2",): "P1", ("CONCAVE_VISIBLE_REGION_REVIEW",): "P2", ("UNVERIFIED_HUMAN_ANNOTATION",): "P3", (): "P3"}
    df = spark.createDataFrame([(list(k), v) for k, v in cases.items()], "s array<string>, p string")
    assert df.where(review.guidance(F.col("s"))["priority"] != F.col("p")).count() == 0


def test_overlap_of_instances(spark):
    square = lambda x, y, n: [{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + n, y), (x + n, y + n), (x, y + n))]
    data = [(1, 1, 400, 400, square(40, 40, 80)), (1, 2, 400, 400, square(40, 40, 80)), (1, 3, 400, 400, square(300, 300, 40)), (1, 4, 400, 400, square(60, 60, 20)), (2, 1, 400, 400, [])]
    df = spark.createDataFrame(data, "image_id long, instance_index int, width int, height int, points array<struct<x:double,y:double>>")
    got = {r["instance_index"]: sorted(r["signals"]) for r in review.overlap_signals(df).collect()}
    assert got[1] == ["LIKELY_DUPLICATE_INSTANCE:2", "POLYGON_OVERLAP_REVIEW:4"] and 3 not in got


XML = """<?xml version="1.0"?><annotations><version>1.1</version><meta><job><id>9</id><name>j</name><labels><label><name>face</name><type>polygon</type></label></labels></job></meta>
<image id="3" name="b.jpg" width="10" height="20"><polygon label="face" source="manual" occluded="1" points="0,0;0,0;5,0;5,5" z_order="2"><attribute name="q">ok</attribute></polygon></image>
<image id="4" name="a.jpg" width="10" height="20"></image></annotations>"""


def test_annotation_round_trip(spark, tmp_path):
    (tmp_path / "one.xml").write_text(XML)
    path = str(tmp_path / "one.xml")
    annotations.require_export(spark, path)
    assert annotations.read_metadata(spark, path).first()["id"] == "9"
    images = annotations.read_export(spark, path)
    assert rows(annotations.corrections(images)) == [(3, "b.jpg", 1, 1)]
    p = annotations.instances(annotations.normalise(images)).first()
    assert (p["name"], p["instance_index"], p["occluded"], p["z_order"], p["attributes"], len(p["points"])) == ("b.jpg", 1, True, 2, {"q": "ok"}, 3)
    other = images.withColumn("name", F.concat(F.lit("x"), "name"))
    merged = annotations.merge([images, other])
    assert [r["name"] for r in merged.orderBy("image_id").collect()] == ["a.jpg", "b.jpg", "xa.jpg", "xb.jpg"]
    with pytest.raises(Exception):  # noqa: B017
        annotations.merge([images, images]).collect()
    sinks.write_export(merged, str(tmp_path / "out"))
    assert annotations.instances(annotations.read_export(spark, str(tmp_path / "out"))).count() == 2
    with pytest.raises(Exception):  # noqa: B017
        sinks.write_export(merged, str(tmp_path / "out"))


def test_files_and_archives(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("b.jpg", "a.JPG", "c.txt"):
        (tmp_path / "in" / name).write_bytes(name.encode())
    found = files.scan_files(spark, str(tmp_path / "in"), [".jpg"])
    assert sorted(r["filename"] for r in found.collect()) == ["a.JPG", "b.jpg"]
    sinks.write_zip([str(tmp_path / "in" / "b.jpg")], str(tmp_path / "x.zip"))
    assert rows(files.list_archives(spark, str(tmp_path / "x.zip")).select("name", "intact")) == [("b.jpg", True)]
    n = sinks.write_csv_file(found, str(tmp_path / "x.csv"), ["filename", "bytes"], ["filename"])
    assert n == 2 and (tmp_path / "x.csv").read_bytes().startswith(b"\xef\xbb\xbffilename,bytes")
    back = files.read_csv(spark, str(tmp_path / "x.csv"), ["filename", "bytes"])
    assert rows(back) == [("a.JPG", "5"), ("b.jpg", "5")]
    with pytest.raises(FileExistsError):
        sinks.write_csv_file(found, str(tmp_path / "x.csv"), ["filename"], ["filename"])
    copied = sinks.write_files(found.select(F.lit("images").alias("subfolder"), "filename", "content"), str(tmp_path / "out"))
    assert all(r["ok"] for r in copied.collect()) and (tmp_path / "out/images/b.jpg").exists()
    inventory = features.image_inventory(spark, str(tmp_path / "in"), found)
    assert [r["readable"] for r in inventory.collect()] == [False, False]


def test_predictions_keep_keys(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    got = features.predictions(df, lambda b: pd.DataFrame({"k": b["k"], "n": np.full(len(b), len(b))}), "k", "k long, n long", chunk=3)
    assert sorted(r["k"] for r in got.collect()) == list(range(10)) and max(r["n"] for r in got.collect()) <= 3


def test_stream_equals_batch(spark, tmp_path):
    events = spark.sql("SELECT s % 3 AS k, TIMESTAMP'2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, s * 5) AS ts FROM (SELECT id * id % 97 AS s FROM range(60))")
    events.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    q = stream_islands(stream, ["k"], "ts", "30 seconds", "1 hour").writeStream.outputMode("complete").format("memory").queryName("islands").start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("islands")) == rows(grouping.gap_islands(events, ["k"], "ts", "30 seconds"))


def test_chunks_find_all_pairs(spark):
    r = random.Random(5)
    sigs = [r.getrandbits(63) for _ in range(60)]
    sigs += [s ^ sum(1 << p for p in r.sample(range(63), r.randrange(14))) for s in sigs for _ in range(2)]
    df = spark.createDataFrame(list(enumerate(sigs)), "id long, sig long")
    for threshold in (0, 3, 6, 12):
        expected = {(i, j, (a ^ b).bit_count()) for i, a in enumerate(sigs) for j, b in enumerate(sigs) if i < j and (a ^ b).bit_count() <= threshold}
        for banded in (True, False, None):
            assert {tuple(x) for x in dedup.near_pairs(df, "id", F.col("sig"), threshold, banded=banded).collect()} == expected
    assert dedup.chunk_plan(6, 63, 10**9)[1:] != (7, 0)


def test_numbers_and_medians(spark):
    r = random.Random(6)
    rows = [(i, r.choice([None, 1.5, 2.0, 7.0, -3.0]), float(r.randrange(9))) for i in range(101)]
    df = spark.createDataFrame(rows, "id long, a double, b double").repartition(3)
    got = ranks.medians(df, {"a": F.col("a"), "b": F.col("b"), "none": F.lit(None)}).first()
    assert got["a"] == statistics.median(x[1] for x in rows if x[1] is not None) and got["b"] == statistics.median(x[2] for x in rows) and got["none"] is None
    places = {x["id"]: x["number"] for x in ranks.numbered(df, ["b", "id"]).collect()}
    assert places == {x[0]: n for n, x in enumerate(sorted(rows, key=lambda x: (x[2], x[0])))}
    assert ranks.medians(df.where("id < 0"), {"a": F.col("a")}).first()["a"] is None


def test_splits_are_those_of_the_rule(spark):
    r = random.Random(7)
    ratios = {"train": 0.7, "validation": 0.15, "test": 0.15}
    for seed in (1, 20260731):
        sizes = {f"g{i:03d}": r.choice([1, 1, 2, 5, 9]) for i in range(80)}
        got = splits.assign_groups(sizes, ratios, seed)
        draw = list(sizes)
        random.Random(seed).shuffle(draw)
        left = {s: [sum(sizes.values()) * q] * 2 for s, q in ratios.items()}  # goal, unmet
        for size in sorted(set(sizes.values()), reverse=True):
            for g in (x for x in draw if sizes[x] == size):
                best = max(v[1] / max(v[0], 1.0) for v in left.values())
                assert left[got[g]][1] / max(left[got[g]][0], 1.0) > best - 1e-9
                left[got[g]][1] -= size
        items = spark.createDataFrame([(g,) for g, n in sizes.items() for _ in range(n)] + [(None,)], "g string")
        assert {x["g"]: x["split"] for x in splits.split_groups(items, "g", ratios, seed).collect()} == got
    assert splits.split_groups(items.where("g = 'no'"), "g", ratios, 1).count() == 0


def test_files_are_not_overwritten(spark, tmp_path):
    files = lambda text: spark.createDataFrame([("a", "x.txt", bytearray(text))], "subfolder string, filename string, content binary")
    for _ in range(2):  # the same content may be written again
        assert sinks.write_files(files(b"one"), str(tmp_path)).first()["ok"]
    with pytest.raises(Exception, match="FileExistsError"):
        sinks.write_files(files(b"two"), str(tmp_path)).collect()
    assert (tmp_path / "a/x.txt").read_bytes() == b"one"
    sinks.write_readme(str(tmp_path / "README.md"), "Batch", {"images": 3}, ["made by hand"])
    assert "- images: 3" in (tmp_path / "README.md").read_text()
    page = sinks.review_page([{"image": "<a>", "n": 1}], "t")
    assert "localStorage" in page and "JSON.stringify(o)" in page and "&lt;a&gt;" in page


def _greedy(records, k, per_group, most_zero, threshold):
    """The choice, a record at a time over two sorted lists."""
    far = lambda r, c: all((r[3] ^ o[3]).bit_count() > threshold for o in c)
    best = {}
    for r in sorted(records, key=lambda r: (r[2], r[0])):
        best[r[1]] = r
    order = lambda r: (-r[2], r[1], r[0])
    chosen = []
    for r in sorted(best.values(), key=order) + sorted(records, key=order):
        if len(chosen) < k and r not in chosen and sum(o[1] == r[1] for o in chosen) < per_group and not (r[4] and sum(o[4] for o in chosen) >= most_zero) and far(r, chosen):
            chosen.append(r)
    return [r[0] for r in chosen]


def test_greedy_choice_against_brute_force(spark):
    rng = random.Random(5)
    for bits, k in ((6, 40), (16, 300)):
        # many near signatures, so that few qualify and rounds are needed; ties of scores
        records = [(i, rng.randrange(9), rng.randrange(50) / 50, rng.getrandbits(bits), rng.random() < 0.3) for i in range(700)]
        df = spark.createDataFrame([*records, (900, 1, 2.0, None, False)], "id long, group int, score double, sig long, zero boolean")
        assert [r["id"] for r in selection.select_diverse(df, k, 50, 9, 1)] == _greedy(records, k, 50, 9, 1)
    assert selection.select_diverse(df.where("false"), 3, 1, 1, 1) == []


def test_scenes_beyond_their_heads(spark):
    # group b's best 30 are copies of a's choice
    records = [(0, "a", 9.0, 7)] + [(i, "b", 8 - i / 100, 7) for i in range(1, 31)] + [(40, "b", 1.0, 7 << 20), (41, "b", 0.5, 7 << 30)]
    df = spark.createDataFrame(records, "id long, group string, score double, sig long")
    assert [r["id"] for r in selection.scene_representatives(df, 2)] == [0, 40]
    with pytest.raises(ValueError, match="group b"):
        selection.scene_representatives(df.where("id < 40"), 2)
    assert selection.scene_representatives(df.where("false"), 2) == []


def test_pictures(spark, tmp_path):
    image = np.arange(40 * 60 * 3, dtype=np.uint32).reshape(40, 60, 3).astype(np.uint8)
    (tmp_path / "a.png").write_bytes(render.png(image))
    back = spark.read.format("image").load(str(tmp_path)).select("image.*").first()
    assert (back.height, back.width) == (40, 60) and (render.colours(bytes(back.data), 40, 60, back.nChannels) == image).all()

    grey = np.full((40, 60, 3), 100, np.uint8)
    square = np.array([[10, 10], [50, 10], [50, 30], [10, 30]], float)
    drawn = render.overlay(grey, [(1, square, (0, 0, 255))], 60)
    assert drawn[35, 55].tolist() == [100, 100, 100]
    assert drawn[25, 35].tolist() == [70, 70, 146]  # 0.7 of the image and 0.3 of the colour
    assert drawn[30, 40].tolist() == [0, 0, 255]  # outline
    assert render.overlay(grey, [], 30).shape == (20, 30, 3)
    render.overlay(grey, [(12, square - 30, (1, 2, 3)), (3, np.zeros((0, 2)), (1, 2, 3))], 60)  # partly outside; without points

    sheet = render.contact_sheet([grey, grey * 2, grey], 7, 2, (36, 50), 1, 14)
    assert sheet.shape == (100, 72, 3) and sheet[30, 18].tolist() == [100] * 3 and sheet[30, 54].tolist() == [200] * 3 and sheet[80, 54].tolist() == [255] * 3
    rows = [(f"{i:03}", 4, 4, 1, bytes([i] * 16)) for i in range(14)] + [("bad", -1, -1, -1, b"")]
    images = spark.createDataFrame(rows, "filename string, height int, width int, nChannels int, data binary")
    assert [(r.page, r["first"], r.n) for r in render.contact_sheets(images, ["filename"]).orderBy("page").collect()] == [(1, 1, 12), (2, 13, 2)]
    polygons = spark.createDataFrame([("001", 1, [(0.0, 0.0), (3.0, 0.0), (3.0, 3.0)])], "filename string, instance_index int, points array<struct<x:double,y:double>>")
    found = {r.filename: r.content for r in render.overlays(images, polygons).collect()}
    assert len(found) == 14 and found["000"] == render.png(np.zeros((4, 4, 3), np.uint8)) and found["001"] != render.png(np.ones((4, 4, 3), np.uint8))
