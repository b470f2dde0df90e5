"""Near-duplicate classes by MinHash signatures and a multi-index Hamming join.

A document is the set of its distinct 5-word shingles. Its signature has WORDS_PER_SIGNATURE
minima, cut to 16 bits each. Two documents at Jaccard similarity 0.75 differ in a quarter of
them on average; the join finds every pair whose signatures differ in at most

    CHUNKS * (CHUNK_ERRORS + 1) - 1 = 19 of 40

places, by the pigeonhole principle: cut in CHUNKS chunks, one chunk of such a pair differs in
at most CHUNK_ERRORS places, and the join enumerates those errors, one key for each place that
may be wrong. (A chunk agrees so at similarity 0.75 with probability 0.738; all ten fail with
probability 1.5e-6, and far less above 0.75.) Pairs further apart that meet anyway are kept:
every candidate is confirmed on the full sets, in integers.

No bucket is expanded into its pairs as rows. Equal sets are one class from the start. Each class
is first compared with one leader, the one it shares most buckets with, and the links are joined
into components. Buckets that then hold members of several components are joined into families,
and each family is settled through its hub, the member h with most links. With A = h - x,
B = x - h, D = A + B and c = 4 |A| + 3 |B|, for members x and y

    100 |x & y| >= 75 |x + y|   if and only if   7 |Dx & Dy| >= c(x) + c(y) - |h|,

and x is linked with h itself if and only if c(x) <= |h|. So the members with c(x) <= |h| are one
component, and only the others, the stragglers, are held against the members, by their short
differences alone. That goes in cells of at most about CELL stragglers and CELL members, as a
product of matrices, and a cell gives a spanning forest of its links, not the links.

Joins on a leader, a hub or a family have a written table on either side, so that adaptive
execution can split the rows of a key with many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.scratch import Scratch
from sievework.llm.common import mix64, quoted, word_hashes
from sievework.operators.components import connected_components

SHINGLE = 5
CHUNKS, CHUNK_SIZE, CHUNK_ERRORS = 10, 4, 1
WORDS_PER_SIGNATURE = CHUNKS * CHUNK_SIZE
#: Stragglers, and members, in a cell; elements that so many pairs of a cell share are counted by a dense product.
CELL, FREQUENT = 1500, 64
_ODD = mix64(np.arange(1, 1 + max(SHINGLE, WORDS_PER_SIGNATURE), dtype=np.uint64)) | np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; the whole sequence where it is shorter."""
    w = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(w):
        return w
    size = min(SHINGLE, len(w))
    with np.errstate(over="ignore"):
        h = w[: len(w) - size + 1] * _ODD[0]
        for i in range(1, size):
            h = mix64(h) + w[i : len(w) - size + 1 + i] * _ODD[i]
        return np.unique(mix64(h ^ np.uint64(size)))


_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)
#: Set elements that are hashed at once, so that what is in work stays in a CPU's cache.
BLOCK = 1 << 15


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """For each set (none empty) 16 bits of its minimum under each of the hash functions."""
    s, starts = np.concatenate(sets), np.cumsum([0, *(len(x) for x in sets[:-1])])
    out = np.empty((len(sets), WORDS_PER_SIGNATURE), np.uint16)
    with np.errstate(over="ignore"):
        high = s >> np.uint64(29)
        for k in range(WORDS_PER_SIGNATURE):
            least = np.minimum.reduceat(((s * _ODD[k]) ^ high) * _MULTIPLIER, starts)
            out[:, k] = (least >> np.uint64(20)) & np.uint64(0xFFFF)
    return out


def _blocks(texts: pd.Series) -> Iterator[list[np.ndarray]]:
    sets, held = [], 0
    for text in texts:
        sets.append(shingle_set(text))
        if (held := held + len(sets[-1])) >= BLOCK:
            yield sets
            sets, held = [], 0
    if sets:
        yield sets


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each set's size, 128 bits that name the set, and its signature (null where empty)."""
    for batch in batches:
        at = 0
        for sets in _blocks(batch["text"]):
            n = np.array([len(x) for x in sets])
            names, sig = np.zeros((2, len(sets)), np.int64), np.full(len(sets), None, object)
            if full := [x for x in sets if len(x)]:
                starts, flat = np.cumsum([0, *n[n > 0][:-1]]), np.concatenate(full)
                with np.errstate(over="ignore"):
                    for i in range(2):
                        names[i, n > 0] = np.add.reduceat(mix64(flat * _ODD[i]), starts).view(np.int64)
                sig[n > 0] = [x.tobytes() for x in signatures(full)]
            yield pd.DataFrame({"id": batch["id"].iloc[at : at + len(sets)].to_numpy(), "n": n, "ha": names[0], "hb": names[1], "sig": sig})
            at += len(sets)


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One key for each chunk and each place of it that may be wrong."""
    for batch in batches:
        if not len(batch):
            continue
        sig = np.frombuffer(b"".join(batch["sig"]), np.uint16).reshape(len(batch), CHUNKS, CHUNK_SIZE).astype(np.uint64)
        with np.errstate(over="ignore"):
            for place in range(CHUNK_SIZE):
                rest = [i for i in range(CHUNK_SIZE) if i != place]
                packed = (sig[:, :, rest[0]] << np.uint64(32)) | (sig[:, :, rest[1]] << np.uint64(16)) | sig[:, :, rest[2]]
                where = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(CHUNK_SIZE) + np.uint64(place)
                key = mix64(packed ^ (where << np.uint64(48))).view(np.int64)
                yield pd.DataFrame({"key": key.ravel(), "rep": np.repeat(batch["rep"].to_numpy(np.int64), CHUNKS)})


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"rep": batch["rep"], "set": [shingle_set(t).tobytes() for t in batch["text"]]})


def _common(p: np.ndarray, q: np.ndarray) -> int:
    both = np.sort(np.concatenate([p, q]))
    return int((both[1:] == both[:-1]).sum())


def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keep = []
        for x, y in zip(batch["set_a"], batch["set_b"], strict=True):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = _common(p, q)
            keep.append(100 * both >= 75 * (len(p) + len(q) - both))
        yield batch.loc[keep, ["a", "b"]]


def _differences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What tells each member from its family's hub."""
    for batch in batches:
        rows = []
        for x, y in zip(batch["set"], batch["hub_set"], strict=True):
            own, hub = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            a, b = np.setdiff1d(hub, own, assume_unique=True), np.setdiff1d(own, hub, assume_unique=True)
            rows.append((len(hub), 4 * len(a) + 3 * len(b), np.concatenate([b, a]).tobytes()))
        yield pd.concat([batch[["family", "hub", "rep"]].reset_index(drop=True), pd.DataFrame(rows, columns=["n_hub", "cost", "diff"])], axis=1)


def _overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many elements each of x has in common with each of y; elements are distinct within a set."""
    out = np.zeros((len(x), len(y)), np.float32)
    ex, ey = np.concatenate([np.empty(0, np.uint64), *x]), np.concatenate([np.empty(0, np.uint64), *y])
    ix, iy = np.repeat(np.arange(len(x)), [len(p) for p in x]), np.repeat(np.arange(len(y)), [len(p) for p in y])
    known = np.intersect1d(ex, ey)
    if not len(known):
        return out
    kx, ky = np.isin(ex, known), np.isin(ey, known)
    ex, ix, ey, iy = np.searchsorted(known, ex[kx]), ix[kx], np.searchsorted(known, ey[ky]), iy[ky]
    met = np.bincount(ex, minlength=len(known)) * np.bincount(ey, minlength=len(known))
    often = np.flatnonzero(met >= FREQUENT)
    for at in range(0, len(often), 512):  # frequent elements: a dense product
        column = np.full(len(known), -1)
        column[part] = np.arange(len(part := often[at : at + 512]))
        dense = [np.zeros((n, len(part)), np.float32) for n in out.shape]
        for m, e, i in zip(dense, (ex, ey), (ix, iy), strict=True):
            m[i[column[e] >= 0], column[e][column[e] >= 0]] = 1
        out += dense[0] @ dense[1].T
    rare = met < FREQUENT
    kx, ky = rare[ex], rare[ey]
    ex, ix, ey, iy = ex[kx], ix[kx], ey[ky], iy[ky]
    order = np.argsort(ey, kind="stable")
    ey, iy = ey[order], iy[order]
    lo = np.searchsorted(ey, ex)
    n = np.searchsorted(ey, ex, "right") - lo
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    np.add.at(out, (np.repeat(ix, n), iy[place]), 1)
    return out


def _cell(rows: pd.DataFrame) -> pd.DataFrame:
    """A spanning forest of the links between a cell's stragglers and members."""
    x, y = rows[rows["stray"]], rows[~rows["stray"]]
    salt = mix64(rows["family"].to_numpy(np.int64).view(np.uint64))
    sets = [np.frombuffer(d, np.uint64) ^ f for d, f in zip(rows["diff"], salt, strict=True)]
    stray = rows["stray"].to_numpy()
    same = _overlaps([s for s, f in zip(sets, stray, strict=True) if f], [s for s, f in zip(sets, stray, strict=True) if not f])
    need = x["cost"].to_numpy()[:, None] + y["cost"].to_numpy()[None, :] - y["n_hub"].to_numpy()[None, :]
    rx, ry = x["rep"].to_numpy(np.int64), y["rep"].to_numpy(np.int64)
    linked = (x["family"].to_numpy()[:, None] == y["family"].to_numpy()[None, :]) & ((7 * same >= need) | (rx[:, None] == ry[None, :]))
    lx, ly, last = rx, ry, None
    far = np.iinfo(np.int64).max
    while last is None or not (np.array_equal(last[0], lx) and np.array_equal(last[1], ly)):
        last = lx, ly
        lx = np.minimum(lx, np.where(linked, ly[None, :], far).min(1, initial=far))
        ly = np.minimum(ly, np.where(linked, lx[:, None], far).min(0, initial=far))
    a, b = np.concatenate([lx, ly]), np.concatenate([rx, ry])
    return pd.DataFrame({"a": a[a != b], "b": b[a != b]})


def _with_components(rows: DataFrame, components: DataFrame) -> DataFrame:
    """rows with the component of `rep`, itself where it has no link."""
    named = rows.join(components.withColumnRenamed("node", "rep"), "rep", "left")
    return named.withColumn("component", F.coalesce("component", "rep"))


def _settle(open_rows: DataFrame, links: DataFrame, sets: DataFrame, scratch: Scratch, n_reps: int) -> DataFrame:
    """The links (a, b) that are missing in buckets (key, first, rep) of several components."""
    families = connected_components(open_rows.where("rep <> first").select("first", "rep"), "first", "rep", scratch, "families")
    families = scratch.save(families.select(F.col("node").alias("rep"), F.col("component").alias("family")), "families", n_reps)
    ends = links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep")))
    degree = ends.groupBy("rep").agg(F.count(F.lit(1)).alias("degree"))
    ranked = families.join(degree, "rep", "left").select("family", "rep", F.coalesce("degree", F.lit(0)).alias("degree"))
    hubs = ranked.groupBy("family").agg(F.max_by("rep", F.struct("degree", -F.col("rep"))).alias("hub"))
    hubs = scratch.save(hubs, "hubs", n_reps)
    members = families.join(hubs, "family").join(sets, "rep")
    members = members.join(sets.select(F.col("rep").alias("hub"), F.col("set").alias("hub_set")), "hub")
    members = members.select("family", "hub", "rep", "set", "hub_set").mapInPandas(_differences, "family long, hub long, rep long, n_hub long, cost long, diff binary")
    members = scratch.save(members, "members")
    direct = members.where("cost <= n_hub AND rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b"))

    strays = members.where("cost > n_hub")
    sizes = members.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cost") > F.col("n_hub")).alias("n_stray")).where("n_stray > 0")
    sizes = scratch.save(sizes, "sizes", n_reps)
    packs = 1 + (sizes.where(F.col("n") <= CELL).agg(F.sum("n")).first()[0] or 0) // CELL
    # small families share a cell with others; large ones are dealt into blocks by a hash
    small = F.col("n") <= CELL
    parts = lambda n: F.when(small, F.lit(1)).otherwise(F.ceil(F.col(n) / CELL)).cast("int")
    base = F.when(small, F.pmod(F.xxhash64("family"), F.lit(packs))).otherwise(F.xxhash64("family", F.lit("own")))
    dealt = sizes.select("family", base.alias("base"), parts("n").alias("blocks"), parts("n_stray").alias("stray_blocks"))
    block = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    fields = ["family", "rep", "cost", "n_hub", "diff"]
    xs = strays.join(dealt, "family").select("base", block("stray_blocks").alias("i"), every("blocks").alias("j"), F.lit(True).alias("stray"), *fields)
    ys = members.join(dealt, "family").select("base", every("stray_blocks").alias("i"), block("blocks").alias("j"), F.lit(False).alias("stray"), *fields)
    found = xs.unionByName(ys).groupBy("base", "i", "j").applyInPandas(_cell, "a long, b long")
    return direct.unionByName(scratch.save(found, "strays"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row with an id.

    component_id is the smallest id reachable over links between sets with Jaccard similarity of
    at least 0.75 (compared as 100 * intersection >= 75 * union). Null, empty and blank texts
    have the empty set, which is linked with nothing; equal short texts are linked; texts of any
    length count whole. Rows with a null id are left out. Rows that repeat an id give a row each,
    with their own n_shingles; an id's sets are linked to each other through it. Other columns are
    left out. An empty table gives an empty table.
    """
    scratch = Scratch(docs.sparkSession, "near")
    key_col, text = F.col(quoted(id_col)), F.col(quoted(text_col))
    source = docs.where(key_col.isNotNull()).select(key_col.cast("long").alias("id"), text.alias("text"))
    described = scratch.save(source.mapInPandas(_describe, "id long, n long, ha long, hb long, sig binary"), "described")
    classes = described.where("n > 0").groupBy("n", "ha", "hb").agg(F.min_by(F.struct("id", "sig"), "id").alias("x"))
    reps = scratch.save(classes.select(F.col("x.id").alias("rep"), "n", "ha", "hb", "x.sig"), "reps")
    n_reps = reps.count()
    keys = reps.select("rep", "sig").mapInPandas(_keys, "key long, rep long")
    shared = keys.groupBy("key").agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "first")
    buckets = scratch.save(keys.join(shared, "key").select("key", "first", "rep"), "buckets")

    texts = source.select(F.col("id").alias("rep"), "text")
    sets = texts.join(buckets.select("rep").distinct().hint("shuffle_hash"), "rep", "left_semi").mapInPandas(_sets, "rep long, set binary")
    sets = scratch.save(sets, "sets")
    led = buckets.where("rep > first").groupBy("rep", "first").agg(F.count(F.lit(1)).alias("n"))
    led = led.groupBy("rep").agg(F.max_by("first", F.struct("n", -F.col("first"))).alias("first"))
    pairs = led.join(sets, "rep").select(F.col("first").alias("a"), F.col("rep").alias("b"), F.col("set").alias("set_b"))
    pairs = pairs.join(sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a")), "a")
    links = scratch.save(pairs.mapInPandas(_confirm, "a long, b long"), "links")

    components = scratch.save(connected_components(links, "a", "b", scratch, "led"), "components", n_reps)
    named = _with_components(buckets, components)
    mixed = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    open_rows = scratch.save(buckets.join(mixed.select("key"), "key", "left_semi"), "open")
    if not open_rows.isEmpty():
        links = links.unionByName(_settle(open_rows, links, sets, scratch, n_reps))
        components = scratch.save(connected_components(links, "a", "b", scratch, "all"), "settled", n_reps)

    named = _with_components(reps, components).select("n", "ha", "hb", F.col("component").alias("component_id"))
    out = described.drop("sig").join(named, ["n", "ha", "hb"], "left").select("id", "n", F.coalesce("component_id", "id").alias("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", (F.col("component_id") == F.col("id")).alias("kept"))
