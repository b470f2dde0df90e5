"""Removal of repeated passages by a difference cover, over all suffixes of all texts.

The order of suffixes is only needed to the depth of MATCH bytes. As in the difference-cover
construction of suffix arrays, a sample of the suffixes is sorted and named first, and the rest is
merged by way of the sample:

1. Sample: suffixes at positions whose remainder by PERIOD lies in the cover. Two positions at
   which the same MATCH bytes start have, less than PERIOD bytes further on, a pair of sampled
   positions at which the same DEPTH = MATCH - PERIOD + 1 bytes start. Sampled prefixes of that
   length get names, names are sorted in buckets, and a name found once is dropped for good.
2. Remaining suffixes: those less than PERIOD before a sampled one that is left. Each gets an
   anchor within its MATCH bytes, the leftmost least hash of SEED bytes, which equal suffixes
   choose alike. Suffixes in a row with the same anchor travel as one piece of text.
3. Merge: where pieces of an anchor meet, their suffixes are sorted by the hash of their first
   MATCH bytes (64 bits, besides the anchor's 64 and the distance to it), and neighbours that are
   equal byte for byte are repeated.

Texts travel in blocks, compressed; names as 32 bits besides their bucket, of which there are as
many as the input asks for, so that a bucket stays small. A name or piece that a block holds many
times is sent once. False meetings of names only cost work.

Beside what is removed, it is told of each document how many runs of words it shares with another
one: of RUN words in a row, and of each RUN_CHOICE such runs one after the other the one with the
least hash (64 bits), so that every passage of RUN + RUN_CHOICE - 1 words (51) has one that all its
documents choose. These names go the same way as those of samples.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.scratch import Scratch
from sievework.llm.common import mix64, quoted, span_hashes, word_hashes

MATCH, SEED = 400, 64
BLOCK_BYTES, BLOCK_DOCS = 2_000_000, 2000
#: Input bytes for each bucket of names, and of pieces.
NAME_BUCKET, PIECE_BUCKET = 8_000_000, 4_000_000
#: Words of a run that documents may share, and runs in a row of which one is chosen.
RUN, RUN_CHOICE = 45, 7
#: Bytes hashed at once, and windows whose anchors are found at once.
CHUNK = 1 << 19


def difference_cover(r: int) -> tuple[int, np.ndarray]:
    """(period, residues) of the cover of Colbourn and Ling with parameter r: 6r + 4 of 24r^2 + 36r + 13."""
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.concatenate([[0], np.cumsum(steps)])


PERIOD, COVER = difference_cover(2)
DEPTH = MATCH - PERIOD + 1


def _packed(rows: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(rows))


def _unpacked(blob: bytes, sizes: np.ndarray) -> list[bytes]:
    whole, ends = zstandard.ZstdDecompressor().decompress(blob), np.cumsum(sizes)
    return [whole[e - n : e] for e, n in zip(ends.tolist(), np.asarray(sizes).tolist(), strict=True)]


_BLOCK = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("text", pa.binary())])
BLOCK_TYPE = "block long, ids array<long>, sizes array<long>, text binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (id, text) in order, in blocks that are numbered within their partition."""
    number = TaskContext.get().partitionId() << 32
    ids, texts, held = [], [], 0

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"block": number, "ids": ids, "sizes": [len(t) for t in texts], "text": _packed(texts)}], schema=_BLOCK)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids.append(doc)
            texts.append(text or b"")
            held += len(texts[-1])
            if held >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                yield block()
                number, ids, texts, held = number + 1, [], [], 0
    if ids:
        yield block()


def _window_hashes(a: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the `size` bytes at each position of `at` (ascending), CHUNK bytes at a time."""
    out = np.empty(len(at), np.uint64)
    for lo in range(0, len(a), CHUNK):
        i, j = np.searchsorted(at, [lo, lo + CHUNK])
        if i < j:
            part = at[i:j] - lo
            out[i:j] = span_hashes(a[lo : lo + CHUNK + size], part, part + size)
    return out


def _samples(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sampled positions of a text that is long enough for a match, and their names (64 bits)."""
    if len(a) < MATCH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = (np.arange(0, len(a) - DEPTH + 1, PERIOD)[:, None] + COVER[None, :]).ravel()
    at = at[at <= len(a) - DEPTH]
    return at, _window_hashes(a, at, DEPTH)


_RUN_BASE = np.uint64(0x9E3779B97F4A7C15)
_RUN_BACK = np.uint64(pow(int(_RUN_BASE), -1, 1 << 64))


def chosen_runs(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the runs of RUN words that are the least of RUN_CHOICE in a row."""
    words = word_hashes(text)
    n = len(words) - RUN + 1
    if n < 1:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(len(words), _RUN_BASE))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up)])
        h = mix64((total[RUN:] - total[:-RUN]) * np.cumprod(np.full(n, _RUN_BACK)))
    if n <= RUN_CHOICE:
        return h.min(keepdims=True)
    return np.unique(np.lib.stride_tricks.sliding_window_view(h, RUN_CHOICE).min(axis=1))


def _place(names: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 bits of a name, as one number."""
    return ((names >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (names & np.uint64(0xFFFFFFFF))


def _names(buckets: int):
    """Each block's names by bucket: of samples, and from `buckets` on of runs of words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, sizes, blob in zip(batch["block"], batch["sizes"], batch["text"], strict=True):
                texts, mark = _unpacked(blob, sizes), zlib.crc32(blob)
                found = [_samples(np.frombuffer(t, np.uint8))[1] for t in texts]
                placed, n = np.unique(_place(np.concatenate(found), buckets), return_counts=True)
                cuts = np.searchsorted(placed, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
                low = placed.astype(np.uint32)
                rows = [(b, block, mark, low[i:j].tobytes(), low[i:j][n[i:j] > 1].tobytes()) for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if i < j]
                runs, n = np.unique(np.concatenate([chosen_runs(t) for t in texts]), return_counts=True)
                bucket = (runs % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                runs, n = runs[order], n[order]
                rows += [(buckets + b, block, mark, runs[i:j].tobytes(), runs[i:j][n[i:j] > 1].tobytes()) for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if i < j]
                yield pd.DataFrame(rows, columns=["bucket", "block", "mark", "names", "again"])

    return run


def _repeated(buckets: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """For each block the names of a bucket that stand at several places."""
        kind = np.uint32 if rows["bucket"].iloc[0] < buckets else np.uint64
        names = [np.frombuffer(x, kind) for x in rows["names"]]
        once = np.sort(np.concatenate(names))
        twice = np.unique(np.concatenate([once[1:][once[1:] == once[:-1]], *(np.frombuffer(x, kind) for x in rows["again"])]))
        if not len(twice):
            return pd.DataFrame([], columns=["block", "mark", "bucket", "names"])
        hits = [x[twice[np.minimum(np.searchsorted(twice, x), len(twice) - 1)] == x].tobytes() for x in names]
        out = rows[["block", "mark", "bucket"]].assign(names=hits)
        return out[out["names"].str.len() > 0]

    return run


def _anchors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of MATCH bytes of a text: its anchor's position, and there the hash of SEED bytes."""
    h = _window_hashes(a, np.arange(len(a) - SEED + 1), SEED)
    places, width = [], MATCH - SEED + 1
    for lo in range(0, len(h) - width + 1, CHUNK):
        part = h[lo : lo + CHUNK + width - 1]
        # the upper bits of the hash, then the place: the least is the leftmost of equal hashes
        key = (part & ~np.uint64((1 << 20) - 1)) | np.arange(len(part), dtype=np.uint64)
        rows = -(-len(key) // width)
        full = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
        full[: len(key)] = key
        full = full.reshape(rows, width)
        ahead = np.minimum.accumulate(full, axis=1).ravel()
        behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(part) - width + 1
        least = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
        places.append((least & np.uint64((1 << 20) - 1)).astype(np.int64) + lo)
    at = np.concatenate(places)
    return at, h[at]


_WIDE = "kind int, bucket int, block long, doc_id long, n_bytes long, shared long, sha string, ids array<long>, sizes array<long>, keys binary, shifts binary, lengths binary, runs binary, docs binary, starts binary, sure binary, both binary, data binary"
_COLUMNS = [c.split()[0] for c in _WIDE.split(", ")]


def _cover_runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _suffixes(name_buckets: int, piece_buckets: int):
    """Of each block: whole documents without a remaining suffix (kind 0), pieces (1), and the other documents (2)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield _block_suffixes(row, name_buckets, piece_buckets)

    return run


def _block_suffixes(row, name_buckets: int, piece_buckets: int) -> pd.DataFrame:
    texts = _unpacked(row.text, row.sizes)
    lists = row.names if row.names is not None else []
    if len(lists) and row.mark != zlib.crc32(row.text):
        raise RuntimeError("the documents came in another order when they were read again")
    known = np.sort(np.concatenate([np.empty(0, np.uint64), *((np.uint64(x["bucket"]) << np.uint64(32)) | np.frombuffer(x["names"], np.uint32).astype(np.uint64) for x in lists if x["bucket"] < name_buckets)]))
    shared = np.sort(np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(x["names"], np.uint64) for x in lists if x["bucket"] >= name_buckets)]))
    out, kept, pieces, seen, runs, sure, both = [], [], [], {}, [], [], []
    for doc, (doc_id, text) in enumerate(zip(row.ids, texts, strict=True)):
        a = np.frombuffer(text, np.uint8)
        n_shared = int(np.isin(chosen_runs(text), shared, assume_unique=True).sum()) if len(shared) else 0
        at, names = _samples(a)
        if len(known) and len(at):
            placed = _place(names, name_buckets)
            at = at[known[np.minimum(np.searchsorted(known, placed), len(known) - 1)] == placed]
        else:
            at = at[:0]
        last = len(a) - MATCH
        mark = np.zeros(len(a) + 2, np.int32)
        np.add.at(mark, np.maximum(at - PERIOD + 1, 0), 1)
        np.add.at(mark, at + 1, -1)
        open_ = np.cumsum(mark[: max(0, last + 1)]) > 0
        if not open_.any():
            out.append({"kind": 0, "doc_id": doc_id, "n_bytes": len(a), "shared": n_shared, "sha": hashlib.sha256(text).hexdigest()})
            continue
        own = len(kept)
        kept.append((doc_id, text))
        both.append(n_shared)
        for lo, hi in zip(*_cover_runs(open_), strict=True):
            place, key = _anchors(a[lo : hi - 1 + MATCH])
            begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            end = np.concatenate([begin[1:], [len(place)]])
            for i, j in zip(begin.tolist(), end.tolist(), strict=True):
                piece, shift = text[lo + i : lo + j - 1 + MATCH], int(place[i]) - i
                number = len(runs)
                runs.append((own, lo + i))
                first = seen.setdefault((shift, piece), number)
                if first != number:
                    sure += [(first, 0, j - i), (number, 0, j - i)]
                else:
                    pieces.append((int(key[i]), shift, piece, number))
    pieces.sort(key=lambda p: p[0] % piece_buckets)
    at = 0
    while at < len(pieces):
        bucket, to = pieces[at][0] % piece_buckets, at
        while to < len(pieces) and pieces[to][0] % piece_buckets == bucket:
            to += 1
        part = pieces[at:to]
        column = lambda k, kind: np.array([k(p) for p in part], kind).tobytes()  # noqa: B023, E731
        out.append({"kind": 1, "bucket": bucket, "block": row.block, "keys": column(lambda p: p[0], np.uint64), "shifts": column(lambda p: p[1], np.int32), "lengths": column(lambda p: len(p[2]), np.int64), "runs": column(lambda p: p[3], np.int32), "data": _packed([p[2] for p in part])})
        at = to
    if kept:
        place = np.array(runs, np.int64).reshape(-1, 2)
        out.append({"kind": 2, "block": row.block, "ids": [k[0] for k in kept], "sizes": [len(k[1]) for k in kept], "docs": place[:, 0].tobytes(), "starts": place[:, 1].tobytes(), "sure": np.array(sorted(set(sure)), np.int64).tobytes(), "both": np.array(both, np.int64).tobytes(), "data": _packed([k[1] for k in kept])})
    frame = pd.DataFrame({c: pd.Series([r.get(c) for r in out], dtype=object) for c in _COLUMNS})
    return frame.astype({"kind": "Int32", "bucket": "Int32", "block": "Int64", "doc_id": "Int64", "n_bytes": "Int64", "shared": "Int64"})


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """For each block the suffixes of a bucket's pieces that are repeated, as (run, from, to)."""
    keys = [np.frombuffer(x, np.uint64) for x in rows["keys"]]
    flat = np.concatenate(keys)
    _, group, n = np.unique(flat, return_inverse=True, return_counts=True)
    meets = n[group] > 1
    block = np.repeat(np.arange(len(rows)), [len(k) for k in keys])
    shift = np.concatenate([np.frombuffer(x, np.int32) for x in rows["shifts"]]).astype(np.int64)
    run = np.concatenate([np.frombuffer(x, np.int32) for x in rows["runs"]])
    hashes, owner, texts_of, first = [], [], {}, 0
    for x, lengths, count in zip(rows["data"], rows["lengths"], [len(k) for k in keys], strict=True):
        here = meets[first : first + count]
        if here.any():
            texts = _unpacked(x, np.frombuffer(lengths, np.int64))
            chosen = np.flatnonzero(here)
            texts_of |= {int(i) + first: texts[i] for i in chosen}
            a = np.frombuffer(b"".join(texts[i] for i in chosen), np.uint8)
            size = np.array([len(texts[i]) for i in chosen])
            windows = size - MATCH + 1
            start = np.cumsum(size) - size
            inner = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
            piece = np.repeat(chosen + first, windows)
            h = _window_hashes(a, np.repeat(start, windows) + inner, MATCH)
            h = mix64(h ^ mix64(flat[piece] + (shift[piece] - inner).astype(np.uint64)))
            hashes.append(h)
            owner.append(np.stack([piece, inner]))
        first += count
    if not hashes:
        return pd.DataFrame([], columns=["block", "found"])
    h, (piece, inner) = np.concatenate(hashes), np.concatenate(owner, axis=1)
    twice = _equal_windows(h, piece, inner, texts_of)
    piece, inner = piece[twice], inner[twice]
    begin = np.flatnonzero(np.concatenate([[True], (piece[1:] != piece[:-1]) | (inner[1:] != inner[:-1] + 1)])) if len(piece) else np.empty(0, np.int64)
    stop = np.concatenate([begin[1:], [len(piece)]]).astype(np.int64) - 1 if len(begin) else begin
    found = np.stack([run[piece[begin]].astype(np.int64), inner[begin], inner[stop] + 1], axis=1) if len(begin) else np.empty((0, 3), np.int64)
    where = block[piece[begin]]
    out = [(rows["block"].iloc[b], found[where == b].tobytes()) for b in np.unique(where)]
    return pd.DataFrame(out, columns=["block", "found"])


def _equal_windows(h: np.ndarray, piece: np.ndarray, inner: np.ndarray, texts: dict[int, bytes]) -> np.ndarray:
    """Which windows (a piece's MATCH bytes from `inner`) equal another one: neighbours by hash, compared byte for byte."""
    order = np.argsort(h, kind="stable")
    twice = np.zeros(len(h), bool)
    near = np.flatnonzero(h[order][1:] == h[order][:-1])
    x, y = order[near], order[near + 1]
    # windows in a row of the same two pieces are compared as one stretch
    stretch = np.lexsort((inner[x], inner[y] - inner[x], piece[y], piece[x]))
    x, y = x[stretch], y[stretch]
    cut = (np.diff(piece[x]) != 0) | (np.diff(piece[y]) != 0) | (np.diff(inner[x]) != 1) | (np.diff(inner[y]) != 1)
    ends = np.flatnonzero(np.concatenate([cut, [True]])) + 1 if len(x) else []
    lo = 0
    for hi in ends:
        size = hi - lo - 1 + MATCH
        i, j = inner[x[lo]], inner[y[lo]]
        if texts[piece[x[lo]]][i : i + size] == texts[piece[y[lo]]][j : j + size]:
            twice[x[lo:hi]] = twice[y[lo:hi]] = True
        else:  # a hash of unequal bytes: whatever has one of these hashes is counted by its bytes
            told = np.flatnonzero(np.isin(h, h[x[lo:hi]]))
            held: dict[bytes, list[int]] = {}
            for k in told.tolist():
                held.setdefault(texts[piece[k]][inner[k] : inner[k] + MATCH], []).append(k)
            for same in held.values():
                twice[same] |= len(same) > 1
        lo = hi
    return twice


_RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string, n_shared long"


def _finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            texts, out = _unpacked(row.data, row.sizes), []
            docs, starts, both = (np.frombuffer(x, np.int64) for x in (row.docs, row.starts, row.both))
            lists = row.found if row.found is not None else []
            found = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 3) for x in (row.sure, *lists)])
            lo, hi = starts[found[:, 0]] + found[:, 1], starts[found[:, 0]] + found[:, 2] - 1 + MATCH
            doc = docs[found[:, 0]]
            order = np.argsort(doc, kind="stable")
            doc, lo, hi = doc[order], lo[order], hi[order]
            cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
            for i, (doc_id, text) in enumerate(zip(row.ids, texts, strict=True)):
                mark = np.zeros(len(text) + 1, np.int32)
                np.add.at(mark, lo[cuts[i] : cuts[i + 1]], 1)
                np.add.at(mark, hi[cuts[i] : cuts[i + 1]], -1)
                gone = np.cumsum(mark[:-1]) > 0
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(*_cover_runs(gone), strict=True)]
                out.append((doc_id, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), int(both[i])))
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256", "n_shared"])
            yield frame.astype({"doc_id": "Int64"})


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256, n_shared) for each row: its bytes in UTF-8
    covered by a MATCH-byte string that also starts anywhere else, in the same document or another.

    spans are the maximal removed runs (byte offsets, end exclusive). Matches never cross
    documents, and are judged on the input. n_shared counts the chosen runs of RUN words that
    another row has too: it is above 0 where a passage of over 50 words is found in another row,
    and 0 where none of RUN words is. A null or empty text has 0 bytes. Texts of any length are
    treated whole, CHUNK bytes at a time. Rows that repeat an id, and equal rows, are documents of
    their own, null ids stay; an empty table gives an empty table. Other columns are left out.
    docs must give the same rows in the same order when it is read again, as a table does; else
    this fails.
    """
    scratch = Scratch(docs.sparkSession, "suffix")
    source = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(text_col)).cast("binary").alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    name_buckets, piece_buckets = max(16, total // NAME_BUCKET), max(16, total // PIECE_BUCKET)
    blocks = source.mapInArrow(_blocks, BLOCK_TYPE)
    names = blocks.select("block", "sizes", "text").mapInPandas(_names(name_buckets), "bucket int, block long, mark long, names binary, again binary")
    hits = names.groupBy("bucket").applyInPandas(_repeated(name_buckets), "block long, mark long, bucket int, names binary")
    hits = hits.groupBy("block").agg(F.max("mark").alias("mark"), F.collect_list(F.struct("bucket", "names")).alias("names"))
    wide = blocks.join(hits, "block", "left").mapInPandas(_suffixes(name_buckets, piece_buckets), _WIDE)
    wide = scratch.save(wide, "suffixes")
    pieces = wide.where("kind = 1").select("bucket", "block", "keys", "shifts", "lengths", "runs", "data")
    found = pieces.groupBy("bucket").applyInPandas(_merge, "block long, found binary")
    found = found.groupBy("block").agg(F.collect_list("found").alias("found"))
    open_docs = wide.where("kind = 2").select("block", "ids", "sizes", "docs", "starts", "sure", "both", "data")
    done = open_docs.join(found, "block", "left").mapInPandas(_finish, _RESULT)
    none = F.array().cast("array<struct<start:long,end:long>>")
    whole = wide.where("kind = 0").select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), none.alias("spans"), F.col("sha").alias("kept_sha256"), F.col("shared").alias("n_shared"))
    return whole.unionByName(done)
