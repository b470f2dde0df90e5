import random

from pyspark.sql import functions as F

from sievework.operators import blocks, dedup


def test_pairs_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "MOST_ROWS", 16)
    monkeypatch.setattr(blocks, "PARTS", 7)
    rng = random.Random(8)
    base = [rng.getrandbits(63) for _ in range(40)]
    sigs = base + [b ^ sum(1 << p for p in rng.sample(range(63), rng.randrange(30))) for b in base for _ in range(2)]
    data = [(f"n{i:03}", s, rng.choice([None, "a", "b", "c"]), rng.choice([None, "x", "y"])) for i, s in enumerate(sigs)]
    data += [data[7], ("n200", None, "a", "x"), (None, 5, "a", "x")]
    df = spark.createDataFrame(data, "id string, sig long, k string, c string")
    far = lambda p, q: (p[1] ^ q[1]).bit_count()
    known = [r for r in data if r[0] and r[1] is not None]
    expected = sorted((p[0], q[0], far(p, q)) for p in known for q in known if p[0] < q[0] and far(p, q) <= 20)
    got = lambda **how: sorted(tuple(r) for r in dedup.near_pairs(df, "id", F.col("sig"), 20, **how).collect())
    assert got() == got(banded=False) == got(banded=True) == expected
    both = sorted((p[0], q[0], far(p, q)) for p in known for q in known if p[0] < q[0] and far(p, q) <= 20 and p[2] and p[2] == q[2] and p[3] and q[3] and p[3] != q[3])
    assert got(keys=["k"], different="c") == both and both
    assert rows_of_nothing(df) == []


def rows_of_nothing(df):
    return dedup.near_pairs(df.where("id = 'no'"), "id", F.col("sig"), 20).collect()


def test_wide_thresholds_are_compared_in_blocks(spark):
    df = spark.range(3000).select("id", F.xxhash64("id").bitwiseAND((1 << 63) - 1).alias("sig"))
    for banded in (None, True):
        plan = dedup.near_pairs(df, "id", F.col("sig"), 16, banded=banded)._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "NestedLoop" not in plan and "Cartesian" not in plan and "HashAggregate" not in plan and "SortMergeJoin" not in plan


def test_links_have_the_components_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(blocks, "MOST_ROWS", 50)
    rng = random.Random(9)
    base = [rng.getrandbits(63) for _ in range(12)]
    sigs = [b ^ sum(1 << p for p in rng.sample(range(63), rng.randrange(12))) for b in base for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(sigs)), "id long, sig long")
    found = {}
    for name, edges in ("all", dedup.near_pairs(df, "id", F.col("sig"), 12).select(F.col("left").alias("a"), F.col("right").alias("b"))), ("few", dedup.near_links(df, "id", F.col("sig"), 12)):
        edges = edges.cache()
        linked = {i: {i} for i in range(len(sigs))}
        for a, b in edges.collect():
            if linked[a] is not linked[b]:
                linked[a] |= linked[b]
                for x in linked[b]:
                    linked[x] = linked[a]
        found[name] = (edges.count(), {i: min(s) for i, s in linked.items()})
    assert found["few"][1] == found["all"][1] and len(set(found["few"][1].values())) < 40
    assert found["few"][0] < 15 * 100 < found["all"][0]
