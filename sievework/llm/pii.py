"""Personal data by patterns, and terms that give it away by corpus co-occurrence.

Base spans come from the patterns of KINDS. Strings that tell much by themselves, long words in
which letters and digits alternate as in keys and tokens, are `secret`. For the method's own spans, each mention of a
protected entity has the REACH words on either side as its context. Entities are the values that a
pattern finds, each for itself, and the classes of values of a kind, so that both what goes with one
address and what announces addresses is found.
Over all documents it is counted how many hold a term, an entity, and both together. A term
discloses an entity when enough documents show the pair, the entity stands in a large share of
the term's documents, and far more often than chance would have it:

    n(e, t) >= MIN_DOCS,   n(e, t) / n(t) >= SHARE,
    gain = log(N n(e, t) / (n(e) n(t))) >= min(GAIN, GAIN_SHARE log(N / n(e))),   n(e, t) gain >= MIN_DOCS GAIN

No gain is above log(N / n(e)), what the entity itself tells, so a frequent entity's terms are held
against a share of that; their documents together must then say as much as MIN_DOCS with GAIN do.

Every place of such a term, in any document, becomes a span; the sanitised text generalises
numbers and removes other terms. Counts are combined within batches before they are shuffled.
Disclosing terms are shipped to the second pass in blocks of at most BLOCK_TERMS hashes; of several
blocks each has a pass, whose result is written, so that a worker holds one at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.scratch import Scratch
from sievework.llm.common import fresh, kept, quoted, span_hashes, word_spans

KINDS = ("email", "ip", "card", "phone")
SECRET, TERM = "secret", "term"
#: A secret's characters, and changes between letters and digits, at least.
SECRET_SIZE, SECRET_CHANGES = 20, 6
REACH, MIN_DOCS, SHARE, GAIN, GAIN_SHARE = 5, 3, 0.5, 3.0, 0.5
BLOCK_TERMS = 2_000_000

# Each pattern finds what the plain one does: possessive parts and look-behinds only keep it from
# trying the same run of characters again and again.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_IP_LIKE = re.compile(r"[0-9]\.[0-9]")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_CARD_LIKE = re.compile(r"[0-9](?:[ -]?[0-9]){12}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if not i % 2 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _byte_sized(digits: str) -> bool:
    return len(rest := digits.lstrip("0")) <= 3 and int(rest or 0) <= 255


def emails(text: str) -> list[tuple[int, int]]:
    """By each @: the characters before it that may belong to the local part, then the domain.

    The leftmost match begins at the first of those characters that an earlier match hasn't taken.
    """
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append((start, end := m.end()))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and start; matches that fail a test are dropped."""
    out = [("email", *x) for x in emails(text)] if "@" in text else []
    if _IP_LIKE.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(_byte_sized(p) for p in m[0].split("."))]
    if _CARD_LIKE.search(text):
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


_MIXED = re.compile(r"[0-9][A-Za-z]")
_LONG = re.compile(r"[A-Za-z0-9_/+=-]{%d,}+" % SECRET_SIZE)
_CHANGE = re.compile(r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])")


def secret_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the long words in which letters and digits alternate."""
    if not _MIXED.search(text):
        return []
    return [(SECRET, *m.span()) for m in _LONG.finditer(text) if len(_CHANGE.findall(m[0])) >= SECRET_CHANGES]


def own_spans(text: str) -> list[tuple[str, int, int]]:
    """What is found in a text by itself: base spans, then secrets."""
    return base_spans(text) + secret_spans(text)


_PUNCT = np.isin(np.arange(256), list(rb".,;:!?\"'()[]{}<>*_|&%$#"))


class Terms:
    """A text's terms: words, lower-cased (A-Z), without punctuation at their ends; as hashes with byte spans."""

    def __init__(self, raw: bytes):
        a = np.frombuffer(raw, np.uint8)
        lo, hi = word_spans(a) if len(a) else (np.empty(0, np.int64),) * 2
        for ends, step in ((hi, -1), (lo, 1)):
            at = np.flatnonzero(_PUNCT[a[ends - (step < 0)]]) if len(lo) else lo
            while len(at):
                ends[at] += step
                at = at[lo[at] < hi[at]]
                at = at[_PUNCT[a[ends[at] - (step < 0)]]]
        full = hi - lo >= 2
        self.raw, self.lo, self.hi = raw, lo[full], hi[full]
        self.hash = span_hashes(np.frombuffer(raw.lower(), np.uint8), self.lo, self.hi) if len(self.lo) else np.empty(0, np.uint64)

    def overlaps(self, spans: list[tuple[int, int]]) -> np.ndarray:
        """Which terms lie over one of some byte spans."""
        out = np.zeros(len(self.lo), bool)
        for start, end in spans:
            out[np.searchsorted(self.hi, start, "right") : np.searchsorted(self.lo, end)] = True
        return out


def _byte_spans(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    if text.isascii():
        return [s[1:] for s in spans]
    size = lambda a, b: len(text[a:b].encode("utf-8", "surrogatepass"))
    return [((start := size(0, a)), start + size(a, b)) for _, a, b in spans]


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Once for each document: its entities, and with each the terms near its mentions."""
    for batch in batches:
        rows = []
        for text in batch["text"]:
            if not text or not (spans := own_spans(text)):
                continue
            terms = Terms(text.encode("utf-8", "surrogatepass"))
            own = _byte_spans(text, spans)
            free = np.flatnonzero(~terms.overlaps(own))
            pairs = set()
            for (kind, a, b), (start, end) in zip(spans, own, strict=True):
                entities = (f"{kind}:{text[a:b].lower()}", kind)
                pairs |= {(entity, 0, True) for entity in entities}
                before = free[: np.searchsorted(terms.hi[free], start, "right")][-REACH:]
                after = free[np.searchsorted(terms.lo[free], end) :][:REACH]
                pairs |= {(entity, int(h), False) for h in terms.hash[np.concatenate([before, after])].view(np.int64) for entity in entities}
            rows += pairs
        if rows:
            yield pd.DataFrame(rows, columns=["entity", "term", "alone"])


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many documents of a batch hold each term."""
    for batch in batches:
        held = [np.unique(Terms(t.encode("utf-8", "surrogatepass")).hash) for t in batch["text"] if t]
        term, n = np.unique(np.concatenate([np.empty(0, np.uint64), *held]), return_counts=True)
        yield pd.DataFrame({"term": term.view(np.int64), "n": n})


def disclosing_terms(texts: DataFrame) -> DataFrame:
    """(entity, term, n_both, n_term, n_entity): pairs beyond the thresholds, from rows (text)."""
    pairs = texts.mapInPandas(_contexts, "entity string, term long, alone boolean").groupBy("entity", "term", "alone").agg(F.count(F.lit(1)).alias("n"))
    pairs = Scratch(texts.sparkSession, "pii").save(pairs, "pairs")
    entity = pairs.where("alone").select("entity", F.col("n").alias("n_entity"))
    both = pairs.where(~F.col("alone") & (F.col("n") >= MIN_DOCS)).select("entity", "term", F.col("n").alias("n_both"))
    counts = texts.mapInPandas(_term_counts, "term long, n long")
    counts = counts.join(both.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n_term"))
    total = texts.count()
    out = both.join(counts, "term").join(entity, "entity")
    gain = F.log(F.lit(float(total)) * F.col("n_both") / (F.col("n_entity") * F.col("n_term")))
    enough = (gain >= F.least(F.lit(GAIN), GAIN_SHARE * F.log(F.lit(float(total)) / F.col("n_entity")))) & (F.col("n_both") * gain >= MIN_DOCS * GAIN)
    return out.where((F.col("n_both") >= SHARE * F.col("n_term")) & enough).select("entity", "term", "n_both", "n_term", "n_entity")


def _term_blocks(terms: DataFrame) -> Iterator[np.ndarray]:
    held = []
    for row in terms.select("term").distinct().toLocalIterator():
        held.append(row[0])
        if len(held) == BLOCK_TERMS:
            yield np.sort(np.array(held, np.int64).view(np.uint64))
            held = []
    if held:
        yield np.sort(np.array(held, np.int64).view(np.uint64))


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _parsed(listed: Column) -> Column:
    """Spans as text (kind:start:end, joined by commas), as an array of structs."""
    one = lambda x: F.struct(F.split_part(x, F.lit(":"), F.lit(1)).alias("kind"), F.split_part(x, F.lit(":"), F.lit(2)).cast("int").alias("start"), F.split_part(x, F.lit(":"), F.lit(3)).cast("int").alias("end"))
    return F.when(listed == "", F.array().cast(_SPANS)).otherwise(F.transform(F.split(listed, ","), one))


def _base_column(text: Column) -> Column:
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([_listed(own_spans(t)) if t else "" for t in texts], dtype=object)

    find.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(find, "string")(text)


def _term_column(shipped: Broadcast, text: Column) -> Column:
    """The places of one block's terms that no other span covers."""

    def find(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            found = []
            if text:
                t = Terms(text.encode("utf-8", "surrogatepass"))
                known = shipped.value
                hit = known[np.minimum(np.searchsorted(known, t.hash), len(known) - 1)] == t.hash
                if hit.any():
                    hit &= ~t.overlaps(_byte_spans(text, own_spans(text)))
                    at = np.concatenate([[0], np.cumsum((np.frombuffer(t.raw, np.uint8) & 0xC0) != 0x80)])
                    found = [(TERM, int(a), int(b)) for a, b in zip(at[t.lo[hit]], at[t.hi[hit]], strict=True)]
            out.append(_listed(found))
        return pd.Series(out, dtype=object)

    find.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(find, "string")(text)


def find_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with `spans`: an array of (kind, start, end), base kinds first as in KINDS,
    then `secret` and `term`, each by start; code points, end exclusive.

    Null and empty texts have no spans; texts of any length are searched whole. Each row counts as
    one document, equal rows each on their own, and get equal spans. A table without entities gives
    base spans only; an empty table gives an empty table. Other columns stay as they are, but a
    column `spans`, which is replaced.
    """
    spark, text = docs.sparkSession, F.col(quoted(text_col))
    scratch = Scratch(spark, "pii-terms")
    terms = scratch.save(disclosing_terms(docs.select(text.alias("text"))), "terms")
    base, more = (fresh(docs, x) for x in ("pii_base", "pii_terms"))
    out = docs.select(*kept(docs), _parsed(_base_column(text)).alias(base), F.array().cast(_SPANS).alias(more))
    ahead = None
    for k, block in enumerate(_term_blocks(terms)):
        if ahead is not None:
            out = scratch.save(out, f"block{k}")
            ahead.unpersist()
            if k > 1:
                scratch.drop(f"block{k - 1}")
        ahead = spark.sparkContext.broadcast(block)
        out = out.select(*kept(docs), base, F.concat(more, _parsed(_term_column(ahead, text))).alias(more))
    return out.select(*kept(docs, "spans"), F.concat(base, F.array_sort(more)).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """A text whose spans are generalised; of overlapping ones the first, then the longest."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["kind"])))
    begin = F.struct(F.lit(0).alias("done"), F.lit("").alias("out"))

    def label(s: Column) -> Column:
        number = F.substring(text, s["start"] + 1, -s["back"] - s["start"]).rlike("[0-9]")
        return F.when(s["kind"] != TERM, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).when(number, "[NUMBER]").otherwise("[REMOVED]")

    def add(x: Column, s: Column) -> Column:
        put = F.concat(x["out"], F.substring(text, x["done"] + 1, s["start"] - x["done"]), label(s))
        return F.when(s["start"] < x["done"], x).otherwise(F.struct((-s["back"]).alias("done"), put.alias("out")))

    whole = F.aggregate(ordered, begin, add, lambda x: F.concat(x["out"], F.substring(text, x["done"] + 1, F.char_length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(whole)


def sanitise(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with `spans` and `sanitised`: base spans and secrets become [EMAIL] and the like, numbers
    among the disclosing terms are generalised to [NUMBER], other terms to [REMOVED]. Null texts
    stay null; columns of these names are replaced."""
    found = find_personal_data(docs, text_col)
    return found.select(*kept(found, "sanitised"), sanitised(F.col(quoted(text_col)), F.col("spans")).alias("sanitised"))
