"""Line deduplication with DataFrame functions only.

Every line's key is hashed; the narrow rows (hash, document, position) are written once. They are
range-partitioned by hash, sorted within by document and position. A stream over that order tells
which lines repeat in enough documents; each document gets a sparse bitmap of the lines to drop,
and texts are rebuilt from that.

A key that very many documents share is first dealt over slices of documents, as many as keep any
slice of one key under about SLICE_ROWS rows. A slice alone decides all its rows but those of its
`min_docs` largest documents: with so many larger documents seen, a row goes whatever the other
slices hold. Only the rest, at most `min_docs` documents of a key and slice, meet in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.scratch import Scratch
from sievework.llm.common import ASCII_SPACE, ascii_lower, fresh, kept, quoted

#: Slices of documents at least, and rows that a slice of one key should hold at most.
SLICES, SLICE_ROWS = 16, 200_000
_KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(ASCII_SPACE)))


def _hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(h1, h2, id, version, pos): 128 bits of each key that is long enough, and where it stands."""
    text = F.col(quoted(text_col))
    lines = docs.where(F.col(quoted(id_col)).isNotNull()).select(
        F.col(quoted(id_col)).alias("id"), F.xxhash64(text).alias("version"), F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n", -1)).alias("pos", "line")
    )
    trimmed = lines.select("id", "version", "pos", F.trim("line", F.lit(ASCII_SPACE)).alias("line")).where(F.char_length("line") >= min_chars)
    key = ascii_lower(F.col("line"))
    return trimmed.select(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), "id", "version", "pos")


def drop_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(id, version, n_dropped, words): the lines to drop of each document that has any.

    `words` is a sorted array of (word, bits): bit i of word w stands for line 64 * w + i. Words
    without a dropped line are left out. `version` is a hash of the text, so that rows that share
    an id but not the text keep bitmaps of their own. Rows with a null id hold no lines here.
    """
    rows = Scratch(docs.sparkSession, "lines").save(_hashed_lines(docs, id_col, text_col, min_chars), "hashed")
    slices = max(SLICES, -(-rows.count() // SLICE_ROWS))
    dealt = rows.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int")).repartitionByRange(*_KEY, "slice")
    in_slice = Window.partitionBy(*_KEY, "slice")
    ranked = dealt.withColumn("rank", F.dense_rank().over(in_slice.orderBy(F.desc("id"))))
    sure = ranked.where(F.col("rank") > min_docs).select("id", "version", "pos")
    by_key = Window.partitionBy(*_KEY)
    rest = ranked.where(F.col("rank") <= min_docs).withColumn("rank", F.dense_rank().over(by_key.orderBy(F.desc("id"))))
    rest = rest.withColumn("docs", F.max("rank").over(by_key)).where((F.col("docs") >= min_docs) & (F.col("rank") > 1))
    gone = sure.unionByName(rest.select("id", "version", "pos"))
    bits = gone.groupBy("id", "version", F.shiftright("pos", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    return bits.groupBy("id", "version").agg(F.sum(F.bit_count("bits")).alias("n_dropped"), F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))


def dropped_positions(words: Column) -> Column:
    """The line numbers that a bitmap drops."""
    inside = lambda w: F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(w["bits"], i) == 1)
    return F.flatten(F.transform(words, lambda w: F.transform(inside(w), lambda i: w["word"] * 64 + i)))


def without_lines(text: Column, words: Column) -> Column:
    """A text without the lines that a bitmap drops, in time and space in proportion to the text."""
    lines = F.split(text, "\n", -1)
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped_positions(words))
    # in a struct, so that the text is split once and not for each line
    bound = F.array(F.struct(lines.alias("lines"), keep.alias("keep")))
    return F.get(F.transform(bound, lambda z: F.array_join(F.transform(z["keep"], lambda i: F.get(z["lines"], i)), "\n")), F.lit(0))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The documents with `kept_text`, `n_lines` (before) and `n_dropped` added; no row is lost.

    Lines whose key has at least min_chars code points and is found in at least min_docs
    documents stay only in the largest id that holds it, each time it stands there. A null text
    is one empty line. Rows with a null id, and rows whose own lines are all rare, keep their text.
    Rows of one id are one document, so equal rows are. Work on a text grows with its length, of any
    number of lines. Other columns stay as they are, but those of the added names, which are
    replaced. An empty table gives an empty table.
    """
    maps = drop_bitmaps(docs, id_col, text_col, min_chars, min_docs)
    there = {n: fresh(docs, f"lines_{n}") for n in maps.columns}
    maps = maps.withColumnsRenamed(there)
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    # bitmaps are the build side: texts are shuffled, but not sorted
    mine = (F.col(quoted(id_col)) == F.col(there["id"])) & (F.xxhash64(quoted(text_col)) == F.col(there["version"]))
    joined = docs.join(maps.hint("shuffle_hash"), mine, "left")
    words = F.col(there["words"])
    n_lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    out = {
        "kept_text": F.when(words.isNull(), text).otherwise(without_lines(text, words)),
        "n_lines": n_lines.cast("long"),
        "n_dropped": F.coalesce(F.col(there["n_dropped"]), F.lit(0)).cast("long"),
    }
    return joined.select(*kept(docs, *out), *(c.alias(n) for n, c in out.items()))
