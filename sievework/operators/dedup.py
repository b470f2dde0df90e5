"""Exact and near duplicates: content groups, bit signatures, Hamming joins."""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.scalar import hamming
from sievework.functions.scratch import Scratch
from sievework.operators import blocks

#: Bits of a signature: 64 values without the first, which fits a signed long.
BITS = 63
#: Reference rows that are broadcast by min_distance at most; beyond, they are joined by bands.
BROADCAST_ROWS = 100_000
#: Keys that a row may have in a join by chunks.
MOST_KEYS = 5000
#: Pairs that are compared in blocks in the time of one candidate of such a join.
COMPARED = 100


def exact_groups(items: DataFrame, id_col: str, hash_col: str) -> DataFrame:
    """(hash, size, first) of contents that several items share.

    Members aren't gathered: a group may hold a large part of all rows. `members` lists them.
    """
    return items.groupBy(hash_col).agg(F.count(F.lit(1)).alias("size"), F.min(id_col).alias("first")).where("size > 1")


def members(items: DataFrame, id_col: str, hash_col: str) -> DataFrame:
    """(hash, id, first): each item of a group that has more than one."""
    return items.join(exact_groups(items, id_col, hash_col), hash_col).select(hash_col, id_col, "first")


def median_bits(values: Column, bits: int = BITS) -> Column:
    """A signature of an array: bit i is set where value i + 1 exceeds the median of all but the first."""
    rest = F.slice(values, 2, bits)
    ordered = F.array_sort(rest)
    n = F.size(rest)
    middle = (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2
    bit = lambda v, i, m: F.when(v > m, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    bits_of = lambda z: F.aggregate(F.transform(z["v"], lambda v, i: bit(v, i, z["m"])), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    # in a struct, so that the median is taken once and not for each value
    return F.get(F.transform(F.array(F.struct(rest.alias("v"), middle.alias("m"))), bits_of), F.lit(0))


def chunk_plan(threshold: int, bits: int, rows: int) -> tuple[float, int, int]:
    """(cost a row, chunks, errors) of the cheapest way to meet by equal chunks with so many errors.

    By the pigeonhole principle one of m chunks of a pair has at most (threshold + 1) / m - 1
    errors, rounded up. A row then has a key for each chunk and error, and meets the rows that
    share one of them by chance.
    """
    plans = []
    for m in range(1, min(threshold + 1, bits) + 1):
        errors = -(-(threshold + 1) // m) - 1
        keys = m * sum(comb(-(-bits // m), k) for k in range(errors + 1))
        if keys <= MOST_KEYS:
            plans.append((keys + rows * keys / 2 ** (bits // m), m, errors))
    return min(plans)


def _chunked(left: DataFrame, right: DataFrame, chunks: int, errors: int, keys: list[str], bits: int) -> DataFrame:
    """Candidate pairs that agree in a chunk but for some errors, which are enumerated on the left side."""
    cuts = [i * bits // chunks for i in range(chunks + 1)]
    widths = [b - a for a, b in zip(cuts, cuts[1:], strict=False)]
    value = lambda i: F.expr(f"shiftright(sig, {cuts[i]}) & {(1 << widths[i]) - 1}L")
    masks = lambda w: [sum(1 << p for p in places) for k in range(errors + 1) for places in combinations(range(w), k)]
    wrong = lambda i: F.transform(F.array(*map(F.lit, masks(widths[i]))), lambda x: value(i).bitwiseXOR(x.cast("long")))
    exact = F.explode(F.array(*(F.struct(F.lit(i).alias("no"), value(i).alias("value")) for i in range(chunks))))
    keyed = lambda i: F.transform(wrong(i), lambda v: F.struct(F.lit(i).alias("no"), v.alias("value")))
    near = F.explode(F.flatten(F.array(*map(keyed, range(chunks)))))
    cut = lambda df, how, side: df.select(*keys, "id", "sig", how.alias("chunk")).select(*keys, "chunk.no", "chunk.value", F.col("id").alias(side), F.col("sig").alias(f"sig_{side}"))
    return cut(left, near, "left").join(cut(right, exact, "right"), [*keys, "no", "value"])


def _signatures(items: DataFrame, id_col: str, sig: Column, keys: list[str], different: str | None = None) -> tuple[DataFrame, int]:
    """Rows (id, sig, keys, content) of items that have a signature, written once, and their number."""
    rows = items.select(F.col(id_col).alias("id"), sig.alias("sig"), *keys, *([F.col(different).alias("content")] if different else []))
    # written once: else the optimizer moves the signature's expression into the pairs
    rows = Scratch(items.sparkSession, "signatures").save(rows.where(F.col("sig").isNotNull()), "rows")
    return rows, rows.count()


def near_pairs(items: DataFrame, id_col: str, sig: Column, threshold: int, keys: list[str] | None = None, different: str | None = None, banded: bool | None = None) -> DataFrame:
    """(left, right, distance) of items with left < right, equal `keys` and signatures that differ in at most `threshold` bits.

    Pairs with equal `different` (a content hash) are left out. Chunks with enumerated errors make
    the join exact and an equi-join; they are used where they are the cheaper way for the number of
    rows. Else all pairs of equal keys are compared, in blocks (`blocks.near_pairs`): for wide
    thresholds chance alone makes about as many candidates. `banded` says which; chunks in which a row
    would meet more than a tenth of all rows are not used even so.
    """
    keys = keys or []
    rows, n = _signatures(items, id_col, sig, keys, different)
    cost, chunks, errors = chunk_plan(threshold, BITS, n)
    if banded is False or cost >= (n / 10 if banded else n / 2 / COMPARED):
        return blocks.near_pairs(rows, n, threshold, keys)
    close = hamming(F.col("sig_left"), F.col("sig_right")).cast("int")
    pairs = _chunked(rows, rows, chunks, errors, keys, BITS).where(F.col("left") < F.col("right"))
    pairs = pairs.select("left", "right", close.alias("distance")).where(F.col("distance") <= threshold).distinct()
    if different:
        content = items.select(F.col(id_col).alias("id"), F.col(different).alias("content"))
        pairs = pairs.join(content.select(F.col("id").alias("left"), F.col("content").alias("cl")), "left").join(content.select(F.col("id").alias("right"), F.col("content").alias("cr")), "right")
        pairs = pairs.where("cl <> cr").select("left", "right", "distance")
    return pairs


def near_links(items: DataFrame, id_col: str, sig: Column, threshold: int) -> DataFrame:
    """(a, b): near pairs, not all of them, that link the same items directly or through others as all near pairs do."""
    rows, n = _signatures(items, id_col, sig, [])
    if chunk_plan(threshold, BITS, n)[0] < n / 2 / COMPARED:
        return near_pairs(rows, "id", F.col("sig"), threshold, banded=True).select(F.col("left").alias("a"), F.col("right").alias("b"))
    return blocks.near_links(rows, n, threshold)


def min_distance(candidates: DataFrame, accepted: DataFrame, id_col: str, sig_col: str) -> DataFrame:
    """(id, min_distance) of each candidate to the accepted items; none without accepted items.

    Accepted signatures are made distinct and counted. Up to BROADCAST_ROWS they are broadcast;
    beyond, candidates meet them in blocks by an equi-join on the block, with a partial minimum.
    """
    scratch = Scratch(candidates.sparkSession, "distances")
    known = scratch.save(accepted.select(F.col(sig_col).alias("known")).where("known IS NOT NULL").distinct(), "known")
    pairs = scratch.save(candidates.select(F.col(id_col).alias("id"), F.col(sig_col).alias("sig")), "candidates")
    n = known.count()
    if n <= BROADCAST_ROWS:
        met = pairs.join(F.broadcast(known.agg(F.collect_list("known").alias("all"))), F.lit(True))
        least = F.array_min(F.transform("all", lambda k: hamming(F.col("sig"), k)))
        return met.select("id", least.cast("int").alias("min_distance")).where("min_distance IS NOT NULL")
    blocks = -(-n // BROADCAST_ROWS)
    known = known.withColumn("block", F.pmod(F.xxhash64("known"), F.lit(blocks))).groupBy("block").agg(F.collect_list("known").alias("all"))
    met = pairs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).join(known, "block")
    least = F.array_min(F.transform("all", lambda k: hamming(F.col("sig"), k)))
    return met.select("id", least.alias("d")).groupBy("id").agg(F.min("d").cast("int").alias("min_distance"))
