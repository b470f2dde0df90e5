"""The operators against brute force and on edge cases: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from oracle import assert_equal
from pyspark.sql import functions as F

from sievework.llm import chat_format, decontaminate, line_dedup, near_dedup, packing, pii, quality, queries, suffix_dedup, topk, toxicity
from sievework.llm.common import word_hashes

SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"
rng = random.Random(11)
VOCABULARY = [f"{a}{b}{c}" for a in "bdklmnprst" for b in "aeiou" for c in "nrst"]


def prose(n, r=rng):
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def edited(text, share, r=rng):
    return " ".join(r.choice(VOCABULARY) if r.random() < share else w for w in text.split(" "))


def frame(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert_equal(spark, SMALL, queries.QUERIES[name], queries.ORACLES[name])


def test_word_hashes():
    text = "  a b\tab  a\x0bé\x1c ".encode()
    words = text.split()
    h = word_hashes(text)
    assert len(h) == len(text.decode().split(" ")) - 5 or len(h) == len(re.findall(rb"[^\x20\x09-\x0D]+", text))
    expected = re.findall(rb"[^\x20\x09-\x0D]+", text)
    assert len(h) == len(expected) and h[0] == h[3] and len(set(h.tolist())) == len(set(expected))
    assert len(word_hashes(b"")) == len(word_hashes(b" \n ")) == 0
    assert words


# 1: near duplicates


def brute_components(texts):
    sets = {}
    for i, t in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("seed", range(2))
def test_near_duplicates_equal_brute_force(spark, seed):
    r = random.Random(seed)
    texts = {}
    for base in (prose(120, r) for _ in range(6)):
        for share in (0, 0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.08, 0.1):
            texts[len(texts)] = edited(base, share, r)
    texts |= {100: None, 101: "", 102: " \n", 103: "Ab c", 104: "ab  C", 105: prose(3000, r), 106: "x"}
    got = near_dedup.near_duplicates(frame(spark, list(texts.items())).repartition(3)).collect()
    assert {g["doc_id"]: (g["n_shingles"], g["component_id"]) for g in got} == brute_components(texts)
    assert all(g["kept"] == (g["doc_id"] == g["component_id"]) for g in got)


def test_stragglers_are_settled_by_cells(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CELL", 7)
    r = random.Random(3)
    base = prose(150, r)
    texts = {i: edited(base, r.choice([0.01, 0.02, 0.03, 0.04, 0.05, 0.07]), r) for i in range(60)}
    for i in range(60, 75):
        texts[i] = edited(texts[i - 15], 0.01, r)
    got = near_dedup.near_duplicates(frame(spark, list(texts.items()))).collect()
    assert {g["doc_id"]: (g["n_shingles"], g["component_id"]) for g in got} == brute_components(texts)


def test_overlap_counts():
    r = np.random.default_rng(2)
    x, y = ([np.unique(r.integers(0, 90, r.integers(0, 60)).astype(np.uint64)) for _ in range(n)] for n in (40, 50))
    got = near_dedup._overlaps(x, y)
    assert all(got[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(x) for j, b in enumerate(y))


def test_near_duplicates_edge_cases(spark):
    assert near_dedup.near_duplicates(frame(spark, [])).collect() == []
    rows = [(1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (None, "a b c d e f", "s"), (0, "A B c d e F", None)]
    got = near_dedup.near_duplicates(frame(spark, rows, f"{DOC}, component_id string"))
    assert sorted(tuple(g) for g in got.collect()) == [(0, 2, 0, True), (1, 2, 0, False), (1, 2, 0, False)]


# 2: decontamination


def test_templates():
    t = decontaminate.Template("Hello World. John has 3.5 kg, and (Mary) has 12 apples.\nTom ran 5 km!")
    assert t.slot.astype(int).tolist() == [0, 1, 0, 0, 1, 1, 0, 1, 0, 1, 0, 0, 0, 1, 1]
    for text in (None, "", " ", "...", "!!! ?", "7", "é É"):
        assert len(decontaminate.Template(text).windows()) <= 2


QUESTION = "if Anna buys 12 apples and then sells 5 apples to her neighbour how many apples does she keep at home"


def test_leaks_with_other_numbers(spark):
    bench = frame(spark, [(7, QUESTION), (8, prose(30)), (9, None), (None, "x"), (10, "1 2 3")], "item_id long, text string")
    other = QUESTION.replace("12", "40").replace("5", "9").replace("Anna", "Berta")
    docs = [(1, f"{prose(50)} {QUESTION} {prose(50)}", 0), (2, f"{prose(20)} {other}", 0), (3, prose(400), 0), (4, None, 0), (5, "", 0), (6, QUESTION[:40], 0)]
    got = {g["doc_id"]: g for g in decontaminate.decontaminate(frame(spark, docs, f"{DOC}, n_items int"), bench).collect()}
    assert {k for k, g in got.items() if g["contaminated"]} == {1, 2}
    assert got[1]["leaked_item"] == got[2]["leaked_item"] == 7 and got[3]["leaked_item"] is None


def test_inconsistent_slots_are_no_leak():
    item = "take 7 red stones and 7 blue stones then add 7 green stones and 7 grey stones to the heap"
    numbers = iter("11 12 13 14".split())
    other = re.sub("7", lambda m: next(numbers), item)
    block = decontaminate.Block([(1, item)])
    assert block.match(re.sub("7", "8", item)) and not block.match(other)


def test_consistent_slots_at_a_later_place():
    item = "take 7 red stones and 7 blue stones then add 7 green stones and 7 grey stones to the heap"
    numbers = iter("11 12 13 14".split())
    other = re.sub("7", lambda m: next(numbers), item)
    block = decontaminate.Block([(1, item)])
    for copy in (item, re.sub("7", "8", item)):
        for text in (f"{other} and later {copy}", f"{copy} and later {other}", f"{other} {prose(300)} {other} {copy} {other}"):
            assert block.match(text) == [(1, 1.0, 1.0)]
    cut = item.rsplit(" ", 2)[0]
    assert block.match(f"{other} {prose(30)} {cut}")
    assert not block.match(f"{other} and later {other}")


def test_items_of_names_and_short_items():
    block = decontaminate.Block([(1, "Who Wrote The Great Gatsby And When"), (2, "seven grey stones"), (3, "9 8 7 6 5 4 3"), (4, prose(30))])
    for item, text in ((1, "Who Wrote The Great Gatsby And When"), (2, "seven grey stones"), (3, "9 8 7 6 5 4 3")):
        for leak in (text, f"so we ask. {text} is what we ask {prose(40)}", f"{prose(40)} {text}", f"{prose(40)}. {text}"):
            assert [m[0] for m in block.match(leak)] == [item]
    assert not block.match("Who Met The Old Baker Of York") and not block.match("1 2 3 4 5 6 7") and not block.match("seven stones grey")
    # slots of poor windows may change where the others are found
    item = "Tom has 3 4 5 6 7 8 and so he goes with all of them to the old market in town"
    assert decontaminate.Block([(1, item)]).match(re.sub("[0-9]", lambda m: str(int(m[0]) + 20), item))


def test_copies_in_any_case():
    item = "Anna has 3 cats"
    block = decontaminate.Block([(1, item), (2, QUESTION)])
    for text in (f"x {item} y", f"X {item.upper()} Y", item.lower(), f"and so {item}.", f"{item}. More"):
        assert [m[0] for m in block.match(text)] == [1], text
    for text in (QUESTION.upper(), QUESTION.title(), QUESTION.lower(), f"{prose(20)} {QUESTION.upper()} {prose(20)}"):
        assert [m[0] for m in block.match(text)] == [2], text
    assert not block.match(prose(300)) and not block.match(prose(300).upper())
    accents = "où est la forêt éonlee du cœur à ñdo ção"
    assert decontaminate.Block([(3, accents)]).match(f"NST! {accents.upper().replace('Œ', 'œ')} ÉT") and decontaminate.Block([(3, accents.upper().replace("Œ", "œ"))]).match(accents)
    assert decontaminate.Template("À É Þ × Ÿ").words.tolist() == decontaminate.Template("à é þ × Ÿ").words.tolist()


def brute_leaks(item, text):
    """Whether some run of a text's words is the item, but for numbers that are replaced alike (no names, units or punctuation)."""
    i, t = item.lower().split(), text.lower().split()
    for at in range(len(t) - len(i) + 1):
        told = {}
        if all(told.setdefault(x, y) == y if x.isdigit() and y.isdigit() else x == y for x, y in zip(i, t[at : at + len(i)], strict=True)):
            return True
    return False


def test_leaks_equal_brute_force():
    r = random.Random(29)
    words = VOCABULARY[:60]
    item = lambda: " ".join(r.choice("3 4 5 6".split()) if r.random() < 0.2 else r.choice(words) for _ in range(r.randrange(12, 25)))
    items = [(k, item()) for k in range(20)]
    block = decontaminate.Block(items)
    for _ in range(150):
        k, own = r.choice(items)
        kind = r.randrange(3)
        if kind == 0:  # renumbered alike
            new = {d: str(n) for d, n in zip("3456", r.sample(range(10, 99), 4), strict=True)}
            own = " ".join(new.get(w, w) for w in own.split())
        elif kind == 1:  # other words
            own = " ".join(r.choice(words) if r.random() < 0.5 else w for w in own.split())
        text = f"{prose(r.randrange(30), r)} {own} {prose(r.randrange(30), r)}"
        expected = {i for i, x in items if brute_leaks(x, text)}
        assert expected <= {m[0] for m in block.match(text)} and (expected or kind == 1)
        if kind == 1 and not expected:
            shared = lambda x: len({tuple(x.split()[n : n + 5]) for n in range(len(x.split()) - 4)} & {tuple(text.split()[n : n + 5]) for n in range(len(text.split()) - 4)})
            assert all(shared(items[m[0]][1]) for m in block.match(text))


def test_blocks_of_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 25)
    items = [prose(20) for _ in range(6)]
    bench = frame(spark, list(enumerate(items)), "item_id long, text string")
    docs = frame(spark, [(i, f"{prose(9)} {t}") for i, t in enumerate(items)] + [(9, items[4] + " " + items[2])])
    got = {g["doc_id"]: g for g in decontaminate.decontaminate(docs, bench).collect()}
    assert all(got[i]["leaked_item"] == i for i in range(6)) and got[9]["n_items"] == 2 and got[9]["leaked_item"] == 2
    assert decontaminate.decontaminate(docs, bench.where("item_id > 90")).where("contaminated").count() == 0
    assert decontaminate.decontaminate(docs.where("doc_id > 90"), bench).count() == 0


# 3: preferences


def test_preferences(spark):
    rows = [
        (1, "chosen", 0, "user", "q"), (1, "chosen", 1, "assistant", "good"), (1, "rejected", 0, "user", "q"), (1, "rejected", 1, "assistant", "bad"), (1, "rejected", 2, "user", None),
        (2, "chosen", 5, "user", "alone"), (3, "chosen", 0, "user", "same"), (3, "rejected", 0, "user", "same"), (4, "other", 0, "user", "x"), (None, "chosen", 0, "user", "x"),
        (5, "chosen", 0, None, "b"), (5, "chosen", 0, "a", "c"), (5, "rejected", 0, "", "b"),
    ]
    df = frame(spark, rows, "pair long, side string, turn long, role string, text string")
    got = {g["pair_id"]: g for g in chat_format.format_preferences(df, F.col("pair"), F.col("side")).collect()}
    assert set(got) == {1, 2, 3, 5}
    one = got[1]
    assert (one["n_common"], one["prompt"], one["complete"]) == (1, "<|user|>\nq<|end|>\n", True)
    (start, end) = one["chosen_mask"][0]
    assert one["chosen"][start:end] == "good<|end|>\n" and len(one["rejected_mask"]) == 1
    assert got[2]["complete"] is False and got[2]["rejected"] is None and got[2]["prompt"] == ""
    assert got[3]["n_common"] == 1 and got[3]["chosen"] == got[3]["rejected"] == "" and got[3]["chosen_mask"] == []
    assert got[5]["n_common"] == 1
    assert chat_format.format_preferences(df.where("pair > 90"), F.col("pair"), F.col("side")).count() == 0


# 4: repeated passages


def brute_passages(texts, size=suffix_dedup.MATCH):
    raws = {i: (t or "").encode() for i, t in texts}
    count = Counter(r[k : k + size] for r in raws.values() for k in range(len(r) - size + 1))
    out = {}
    for i, r in raws.items():
        gone = np.zeros(len(r), bool)
        for k in range(len(r) - size + 1):
            if count[r[k : k + size]] > 1:
                gone[k : k + size] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i] = (len(r), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(r, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_difference_cover():
    for r in (1, 2, 3):
        period, cover = suffix_dedup.difference_cover(r)
        assert len(cover) == 6 * r + 4 and {(a - b) % period for a in cover.tolist() for b in cover.tolist()} == set(range(period))


def test_passages_equal_brute_force(spark, monkeypatch):
    r = random.Random(4)
    shared = prose(90, r)
    texts = [prose(r.randrange(5, 200), r) for _ in range(25)]
    texts += [prose(9, r) + shared[k : k + n] + prose(9, r) for k, n in ((0, 399), (0, 400), (3, 401), (1, 420), (7, 300), (0, len(shared)))]
    texts += [shared * 2, "a" * 900, "ab" * 250, "é" * 420, None, "", "x" * 399, "y" * 400, "y" * 400, "z\n" * 3000, prose(3000, r)]
    texts.append(texts[-1])
    rows = list(enumerate(texts))
    expected = brute_passages(rows)
    for docs in (2000, 3):
        monkeypatch.setattr(suffix_dedup, "BLOCK_DOCS", docs)
        out = suffix_dedup.repeated_passages(frame(spark, rows).coalesce(2)).collect()
        got = {g["doc_id"]: (g["n_bytes"], g["n_removed"], len(g["spans"]), g["kept_sha256"]) for g in out}
        assert got == expected


def test_anchors_over_chunks(monkeypatch):
    a = np.frombuffer(prose(2000).encode(), np.uint8)
    whole = suffix_dedup._anchors(a)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1000)
    assert all(np.array_equal(x, y) for x, y in zip(whole, suffix_dedup._anchors(a), strict=True))


def test_passages_edge_cases(spark):
    assert suffix_dedup.repeated_passages(frame(spark, [])).collect() == []
    rows = [(None, "q" * 500, "a"), (3, "q" * 500, "b"), (3, None, None)]
    got = suffix_dedup.repeated_passages(frame(spark, rows, f"{DOC}, spans string")).collect()
    assert sorted((g["doc_id"] or 0, g["n_removed"]) for g in got) == [(0, 500), (3, 0), (3, 500)]


def test_shared_runs(spark):
    r = random.Random(41)
    passage = prose(51, r)
    texts = [f"{prose(30, r)} {passage} {prose(40, r)}" for _ in range(4)] + [prose(200, r), prose(20, r), f"{prose(60, r)} {' '.join(passage.split()[:40])} {prose(60, r)}", None, "", passage]
    got = {g["doc_id"]: g["n_shared"] for g in suffix_dedup.repeated_passages(frame(spark, list(enumerate(texts)))).collect()}
    assert {k for k, n in got.items() if n} == {0, 1, 2, 3, 9}


def test_windows_are_compared_by_bytes():
    texts = {0: b"a" * 500, 1: b"b" * 450, 2: b"xa" + b"a" * 400}
    piece, inner = np.array([0, 0, 1, 2, 2]), np.array([0, 1, 0, 1, 2])
    h = np.zeros(5, np.uint64)  # one hash for all
    assert suffix_dedup._equal_windows(h, piece, inner, texts).tolist() == [True, True, False, True, True]


def test_another_order_is_an_error():
    row = lambda mark, text: pd.Series({"block": 0, "ids": [1], "sizes": [len(text)], "text": suffix_dedup._packed([text]), "mark": mark, "names": [{"bucket": 0, "names": b""}]})
    with pytest.raises(RuntimeError, match="another order"):
        suffix_dedup._block_suffixes(row(1, b"x" * 500), 16, 16)


# 5: lines


def test_lines(spark):
    line = "  This line has more than twenty. "
    rows = [(1, f"{line}\nown"), (2, f"x\n{line.upper()}\n{line}"), (5, f"{line}\n\n{line}"), (3, "short\nshort"), (4, None), (None, line), (6, ""), (6, "")]
    got = line_dedup.dedup_lines(frame(spark, [(*r, "k") for r in rows], f"{DOC}, kept_text string")).collect()
    found = defaultdict(list)
    for g in got:
        found[g["doc_id"]].append((g["kept_text"], g["n_lines"], g["n_dropped"]))
    assert found[1] == [("own", 2, 1)] and found[2] == [("x", 3, 2)] and found[5] == [(f"{line}\n\n{line}", 3, 0)]
    assert found[4] == [("", 1, 0)] and found[6] == [("", 1, 0)] * 2 and found[None] == [(line, 1, 0)]
    assert line_dedup.dedup_lines(frame(spark, [])).collect() == []


def test_hot_line_over_slices(spark):
    line = "a line that very many documents share"
    rows = [(i, f"{i}\n{line}" + f"\n{line}" * (i % 3)) for i in range(300)]
    got = {g["doc_id"]: g["n_dropped"] for g in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert got == {i: 0 if i == 299 else 1 + i % 3 for i in range(300)}


def test_texts_that_share_an_id(spark):
    line = "this is a line of twenty and more"
    rows = [(1, f"a\nb\n{line}"), (1, f"{line}\nc"), (2, line), (3, line)]
    got = sorted(g["kept_text"] for g in line_dedup.dedup_lines(frame(spark, rows)).collect())
    assert got == ["", "a\nb", "c", line]


# 6: packing


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    r = random.Random(6)
    texts = [prose(r.randrange(1, 700), r) for _ in range(60)] + [None, "", "\n" * 5000, "é ü 漢字 😀 <|endoftext|> it's", "word " * 9000, "a" * 5000]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    pieces = packing.pack(frame(spark, rows).coalesce(2)).toPandas()
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    for i, t in rows:
        if i is None:
            continue
        own = pieces[pieces["doc_id"] == i].sort_values("start")
        ids = np.frombuffer(b"".join(own["ids"]), "<u4").tolist()
        assert ids == [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        assert own["start"].tolist() == np.concatenate([[0], own["length"].cumsum()[:-1]]).tolist()
        assert (own["doc_tokens"] == len(ids)).all()
    for _, s in pieces.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == np.concatenate([[0], s["length"].cumsum()[:-1]]).tolist()
        total = int(s["length"].sum())
        assert total == 1024 or total & (total - 1) == 0 and total < 1024
    assert packing.pack(frame(spark, [])).count() == 0


def test_neighbours_share_terms():
    docs = [np.array(x, np.uint32) for x in ([5, 6, 7, 0], [1, 2, 3, 0], [5, 6, 9, 0], [1, 4, 8, 0])]
    index = packing.Index(docs)
    assert index.neighbours(0, np.array([0, 4, 4, 4]))[0] == 2
    assert index.neighbours(1, np.array([0, 0, 4, 4]))[0] == 3
    assert 2 not in index.neighbours(0, np.array([0, 4, 0, 4]))


def test_packing_finds_copies_in_other_partitions(spark):
    r = random.Random(16)
    own = ["".join(r.choice("bcdfgklmnprstvz") + r.choice("aeiou") for _ in range(4)) for _ in range(40)]
    texts = [" ".join(r.choice((*VOCABULARY[:40], own[i])) for _ in range(150)) for i in range(40)]
    rows = list(enumerate(texts)) + [(100 + i, texts[i]) for i in r.sample(range(40), 40)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), DOC)
    pieces = packing.pack(docs).toPandas()
    at = pieces.groupby("doc_id")["sequence_id"].agg(set)
    assert sum(bool(at[i] & at[100 + i]) for i in range(40)) >= 36
    ids = {i: np.frombuffer(b"".join(g.sort_values("start")["ids"]), "<u4") for i, g in pieces.groupby("doc_id")}
    assert all((ids[i] == ids[100 + i]).all() for i in range(40))


def test_packing_counts_all_documents(spark):
    texts = [(1, "a b a"), (2, "a"), (3, None), (4, "c")]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(texts, 4), DOC)
    tokens = docs.select("doc_id", "text").mapInArrow(packing._encoded(packing.default_tokenizer()), packing._TOKENS)
    corpus = packing.corpus_of(tokens.where("row IS NULL").select("df"))
    ids = [[*packing.Encoder(packing.default_tokenizer())(t or "").tolist(), 0] for _, t in texts]
    count = Counter(i for x in ids for i in set(x))
    assert (corpus.n, corpus.mean) == (4, sum(map(len, ids)) / 4)
    assert {i: int(n) for i, n in enumerate(corpus.df) if n} == count


def test_neighbours_are_in_the_order_of_bm25():
    r = random.Random(61)
    docs = [np.array([r.randrange(1, 60) for _ in range(r.randrange(1, 80))] + [0], np.uint32) for _ in range(400)]
    docs[7] = docs[3]
    index, n, mean = packing.Index(docs), len(docs), np.mean([len(d) for d in docs])
    counts = [Counter(d.tolist()) for d in docs]
    df = Counter(t for c in counts for t in c)

    def bm25(seed, d):
        total = 0.0
        for t in counts[seed]:
            tf = counts[d][t]
            total += np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(docs[d]) / mean))
        return total

    left = np.array([len(d) for d in docs])
    left[r.sample(range(400), 50)] = 0
    for seed in (0, 3, 50, 399):
        found = index.neighbours(seed, left).tolist()
        assert sorted(found) == [d for d in range(n) if left[d] and bm25(seed, d) > 0] and len(found) > 256
        scores = [bm25(seed, d) for d in found]
        assert all(x >= y - 1e-3 for x, y in zip(scores, scores[1:], strict=False))


def test_slow_tokenizer_agrees():
    encode = packing.Encoder(packing.default_tokenizer())
    text = "It's 12,345 words…  \n\n tab\t<|endoftext|> ünï"
    fast = encode(text).tolist()
    encode.fast = None
    assert encode(text).tolist() == fast


# 7: toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    words = ["idiot", "moron", "trash", "abc"]
    automaton = toxicity.Automaton(words, [])
    r = random.Random(7)
    tried = [*words, ""]
    for w in words:
        for _ in range(150):
            c, k = list(w), r.randrange(3)
            for _ in range(k):
                p = r.randrange(len(c) + 1)
                c[p : p + r.randrange(2)] = r.choice(["", "x", "o", "i", "t"])
            tried.append("".join(c))
    for t in tried:
        d = min(distance(t, w) if len(w) >= toxicity.FUZZY_FROM else 9 * (t != w) for w in words)
        got = automaton.match(t)
        assert (got is None) == (d > 1) and (got is None or got[2] == d)


def test_stems():
    automaton = toxicity.Automaton([], ["lowei", "veq"])
    assert automaton.match("loweischaft") == ("stem", "lowei", 0) and automaton.match("vequ") == ("stem", "veq", 0)
    assert automaton.match("lowei") is None and automaton.match("laweischaft") is None and automaton.match("vaqu") is None
    assert toxicity.Automaton([], ["achlich"]).match("achlochung") == ("stem", "achlich", 1)


def test_context():
    text = 'he said "you idiot" and left'
    at = text.index("idiot")
    assert toxicity.context_weight(text, at, at + 5) < 0.5
    plain = "you are an idiot and a fool"
    assert toxicity.context_weight(plain, plain.index("idiot"), plain.index("idiot") + 5) == 1


def test_toxicity_learns(spark):
    r = random.Random(8)
    docs, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        docs.append((i, prose(40, r) + (" " + r.choice(["zzidiotic", "zzmoronic"]) + " " + prose(5, r) if toxic else "")))
        labels.append((i, int(toxic)))
    docs += [(1000, None), (1001, ""), (1002, prose(30, r) + " zzidiotik"), (None, "zzidiotic")]
    labels += [(None, 1), (3, None), (5000, 1)]
    d, lab = frame(spark, docs), frame(spark, labels, "doc_id long, toxic int")
    got = toxicity.score_toxicity(d.withColumn("score", F.lit("x")), lab, usable=~toxicity.held_out(F.col("doc_id")))
    out = {g["doc_id"]: g for g in got.collect()}
    wrong = sum(out[i]["predicted"] != (i % 5 == 0) for i in range(400))
    assert wrong == 0 and out[1000]["score"] == out[1001]["score"] < 0.3 and 0 <= out[1002]["score"] <= 1
    none = toxicity.score_toxicity(d, lab.where("doc_id > 9000")).agg(F.countDistinct("score")).first()[0]
    assert none == 1
    assert toxicity.score_toxicity(d.where("doc_id > 9000"), lab).count() == 0


def test_lexicon_equals_brute_force(spark):
    r = random.Random(33)
    words = VOCABULARY[:40] + ["zzbad", "zzbadly", "qqworse"]
    rows = []
    for i in range(400):
        toxic = int(i % 4 == 0)
        rows.append((" ".join([*(r.choice(words[:40]) for _ in range(12)), *([r.choice(words[40:])] if r.random() < (0.9 if toxic else 0.02) else [])]), toxic))
    n1, n0 = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    held = {c: Counter(t for text, y in rows if y == c for t in toxicity.terms_of(text)) for c in (0, 1)}
    expected = {}
    for term, a in held[1].items():
        b = held[0][term]
        p1, p0 = (a + 0.5) / (n1 + 1), (b + 0.5) / (n0 + 1)
        g2 = 2 * sum(n * np.log(n / ((a + b) * share)) for n, share in ((a, n1 / len(rows)), (b, n0 / len(rows))) if n)
        if a >= 3 and g2 >= toxicity.EVIDENCE and p1 / (p1 + p0) >= toxicity.PRECISION:
            expected[term] = np.log(p1 / p0)
    got = toxicity.learn_lexicon(frame(spark, rows, "text string, label int")).odds
    assert set(got) == set(expected) and "zzbad" in got and all(abs(got[t] - expected[t]) < 1e-9 for t in got)


# 8: quality


def test_a_round_of_co_training_equals_brute_force():
    r = np.random.default_rng(35)
    n, k = 3000, quality.TEXT_SIZE + quality.META_SIZE
    rows, y, x = r.normal(size=(n, k)), (r.random(80) < 0.5).astype(float), r.normal(size=(80, k))
    x[:, [0, quality.TEXT_SIZE]] += 3 * y[:, None]

    class Held:
        """Two parts of the unlabelled rows, summed as tasks are."""

        def total(self, measure):
            return measure(rows[:1000]) + measure(rows[1000:])

    views = [quality.fit(part, y) for part in quality._split(x)]
    parts = quality._split(rows)
    scaling, chosen, labels = [], [], []
    for v in range(2):
        every = np.concatenate([quality._split(x)[v], parts[v]])
        scaling.append((every.mean(0), every.std(0)))
        odds = np.clip(views[v].logit(parts[v]), -quality.EDGE, quality.EDGE)
        choice = quality._choice(views[v], np.bincount(quality._bins(views[v], parts[v]), minlength=quality.BINS))
        label = quality._pseudo([choice], parts[v])
        # the surest ones at either end, as many as TAKE asks for, if they are sure enough; ties of a bin go together
        least, most = np.sort(odds)[int(quality.TAKE * n) - 1], np.sort(odds)[-int(quality.TAKE * n)]
        width = 1 / quality.PER_UNIT
        assert (label[odds <= min(least, -quality.SURE) - width] == 0).all() and (label[odds >= max(most, quality.SURE) + width] == 1).all()
        assert (label[(odds > min(least, -quality.SURE) + width) & (odds < max(most, quality.SURE) - width)] == -1).all() and (label >= 0).sum() >= 20
        chosen.append([choice])
        labels.append(label)
    new = quality._refit(views, list(quality._split(x)), y, np.ones(len(y)), Held(), chosen, scaling)
    for v in range(2):
        other = labels[1 - v]
        taken = other >= 0
        z = (np.concatenate([quality._split(x)[v], parts[v][taken]]) - scaling[v][0]) / scaling[v][1]
        z = np.column_stack([z, np.ones(len(z))])
        target, weight = np.concatenate([y, other[taken]]), np.concatenate([np.ones(len(y)), np.full(taken.sum(), quality.PSEUDO)])
        b = np.append(new[v].weights, new[v].bias)
        slope = z.T @ (weight * (1 / (1 + np.exp(-z @ b)) - target)) + np.append(b[:-1], 1e-6 * b[-1])
        assert np.abs(slope).max() < 1e-3  # the least of the penalised loss over all rows at once


def test_quality_learns(spark):
    r = random.Random(9)
    docs, labels = [], []
    for i in range(500):
        bad = i % 4 == 0
        text = " ".join(f"{w}|%" for w in prose(30, r).split()) if bad else prose(60, r) + "."
        docs.append((i, text, r.choice(["en", "de", None]), f"src{i % 7}", len(text)))
        if i < 350:
            labels.append((i, int(not bad)))
    docs += [(900, None, None, None, None), (901, "", "en", "s", 0), (None, "x", "en", "s", -1)]
    schema = f"{DOC}, lang string, source string, n_chars long"
    d, lab = frame(spark, docs, schema), frame(spark, labels, "doc_id long, quality int")
    out = {g["doc_id"]: g for g in quality.score_quality(d, lab).collect()}
    assert len(out) == 503 and all(0 <= out[i][c] <= 1 for i in out for c in ("score", "text_score", "meta_score"))
    assert np.mean([(out[i]["score"] >= 0.5) == (i % 4 != 0) for i in range(350, 500)]) > 0.97
    assert quality.score_quality(d.where("doc_id > 9000"), lab).count() == 0
    assert quality.score_quality(d, lab.where("doc_id > 9000")).agg(F.countDistinct(F.round("score", 9))).first()[0] == 1


def test_quality_uses_all_unlabelled_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "POOL", 10, raising=False)  # the unlabelled rows have no bound
    r = random.Random(19)
    docs, labels = [], []
    for i in range(600):
        bad, known = i % 2 == 0, i < 200
        text = " ".join(f"{w}|%" for w in prose(30, r).split()) if bad else prose(40, r) + "."
        docs.append((i, text, "en", None if known else "bad" if bad else "good", 100))
        if known:
            labels.append((i, int(not bad)))
    model = quality.train(frame(spark, docs, f"{DOC}, lang string, source string, n_chars long").repartition(3), frame(spark, labels, "doc_id long, quality int"))
    good, bad = (model.views[1].logit(quality.meta_measures("en", source, 100, 0)) for source in ("good", "bad"))
    assert good > bad + 1


# 9: personal data


def reference_spans(t):
    luhn = lambda d: sum(x if not i % 2 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15]


def test_base_spans_equal_patterns():
    r = random.Random(10)
    parts = ["a", "B", "@", "@", ".", ".", "-", "+", "1", "2", "55", "4", " ", "é", "(", ")", "%", "1.2.3.4", "4111111111111111"]
    for _ in range(20000):
        t = "".join(r.choice(parts) for _ in range(r.randrange(1, 25)))
        assert pii.base_spans(t) == reference_spans(t)
    for t in ("a" * 10**6, "1" * 10**6, "1." * 10**6, "a@" * 10**5, "+1 " * 10**5, "0" * 6000 + ".1.1.1"):
        pii.base_spans(t)


def test_disclosing_terms(spark):
    r = random.Random(12)
    rows = [(i, f"{prose(30, r)} Quentin Zolotov {r.choice(['writes', 'asks'])} at ana.b{1}@mail.example.com {prose(10, r)}") for i in range(5)]
    rows += [(i, prose(60, r)) for i in range(5, 200)] + [(200, f"{prose(9, r)} Zolotov é 7. {prose(5, r)}"), (201, None), (202, ""), (None, "+1 (255) 555-8013")]
    got = {g["doc_id"]: g for g in pii.sanitise(frame(spark, [(*x, 1) for x in rows], f"{DOC}, spans int")).collect()}
    assert "Zolotov" not in got[0]["sanitised"] and "[EMAIL]" in got[0]["sanitised"] and "Zolotov" not in got[200]["sanitised"]
    assert [s["kind"] for s in got[200]["spans"]] == ["term"] and got[201]["spans"] == [] and got[201]["sanitised"] is None
    at = got[200]["spans"][0]
    assert rows[200][1][at["start"] : at["end"]] == "Zolotov"
    assert [s["kind"] for s in got[None]["spans"]] == ["phone"]
    assert pii.find_personal_data(frame(spark, [])).count() == 0


def test_term_counts_equal_brute_force(spark):
    r = random.Random(27)
    mails = ["ana.b@mail.example.com", "info@shop.example.org"]
    rows = [(i, " ".join(r.choice([*VOCABULARY[:30], mails[0], mails[1], "near", "Beside"]) if r.random() < 0.4 else r.choice(VOCABULARY) for _ in range(40))) for i in range(120)]
    both, alone, holds = Counter(), Counter(), Counter()
    for _, text in rows:
        words = text.split()
        at = [i for i, w in enumerate(words) if "@" in w]
        free = [i for i, w in enumerate(words) if "@" not in w]
        pairs = set()
        for i in at:
            near = [k for k in free if k < i][-pii.REACH :] + [k for k in free if k > i][: pii.REACH]
            pairs |= {(e, words[k].lower()) for e in (f"email:{words[i]}", "email") for k in near}
        both.update(pairs)
        alone.update({f"email:{words[i]}" for i in at} | ({"email"} if at else set()))
        holds.update({words[k].lower() for k in free})
    n, expected = len(rows), set()
    for (e, t), x in both.items():
        gain = np.log(n * x / (alone[e] * holds[t]))
        if x >= pii.MIN_DOCS and x >= pii.SHARE * holds[t] and gain >= min(pii.GAIN, pii.GAIN_SHARE * np.log(n / alone[e])) and x * gain >= pii.MIN_DOCS * pii.GAIN:
            expected.add((e, int(word_hashes(t.encode()).view(np.int64)[0]), x, holds[t], alone[e]))
    got = {tuple(g) for g in pii.disclosing_terms(frame(spark, rows).select("text")).collect()}
    assert got == expected


def test_sanitised_texts(spark):
    rows = [(1, "é a.b@c.de, +1 (255) 555-8013 x"), (2, "no"), (3, None), (4, 'k = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'), (5, "1.2.3.4@x.de 4111111111111111")]
    got = {g["doc_id"]: g["sanitised"] for g in pii.sanitise(frame(spark, rows)).collect()}
    assert got == {1: "é [EMAIL], [PHONE] x", 2: "no", 3: None, 4: 'k = "[SECRET]"', 5: "[EMAIL] [CARD]"}
    spans = spark.sql("SELECT 'ab 12 cd' AS t, array(named_struct('kind', 'term', 'start', 3, 'end', 5), named_struct('kind', 'term', 'start', 0, 'end', 2)) AS s")
    assert spans.select(pii.sanitised(F.col("t"), F.col("s"))).first()[0] == "[REMOVED] [NUMBER] cd"


def test_secrets():
    text = 'x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa 12345678901234567890123'
    assert [text[a:b] for _, a, b in pii.secret_spans(text)] == ["04dbebab91ab85687d33eeaaf9ac699e1188f962"]


@pytest.mark.parametrize(("n", "hot"), [(150, 50), (40, 8)])
def test_terms_of_frequent_entities(spark, n, hot):
    r = random.Random(22)
    rows = [(i, f"{prose(20, r)} Zolotov at ana.b@mail.example.com {prose(20, r)}" if i < hot else prose(40, r)) for i in range(n)]
    found = pii.disclosing_terms(frame(spark, rows).select("text")).collect()
    assert {f["term"] for f in found} == {int(word_hashes(w).view(np.int64)[0]) for w in (b"zolotov", b"at")}


# 10: top k


def test_top_k_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 7)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.integers(-3, 4, 6) / 2]) for i in range(60)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, None), (103, []), (104, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (105, [float("nan")] * 6), (106, [float("inf")] * 6), (None, rows[0][1]), (107, [1.0, 2.0]), (110, [0.1] * 6)]
    df = frame(spark, rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, 5).collect()
    valid = {i: np.floor(np.array(v, np.float32).astype(float) * 1024).astype(int) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    for q in (k for k in valid if k % 10 == 0):
        scores = sorted((-int(valid[q] @ v), i) for i, v in valid.items() if i != q and len(v) == len(valid[q]))[:5]
        assert sorted((g["rank"], g["vec_id"], g["score"]) for g in got if g["query_id"] == q) == [(n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    assert topk.top_k(df.where("vec_id > 900"), F.lit(True)).count() == 0


def test_top_k_resolves_survivors_alone(monkeypatch):
    r = np.random.default_rng(5)
    q, c = np.floor(r.normal(size=(3, 16)) * 1024), np.floor(r.normal(size=(500, 16)) * 1024)
    c[:20] = q[0] + np.floor(r.normal(size=(20, 16)) * 100)
    parts, k = topk._partials(q, c), 10
    t = np.sort((q[:1] @ c.T)[0])[-k]
    resolved = []
    monkeypatch.setattr(topk, "resolve", lambda lists, places: resolved.append(len(places)) or sum(p[places] for p in lists))
    batch = pd.DataFrame([{"dim": 16, "q_ids": np.array([1000]).tobytes(), "q_key": np.array([0]).tobytes(), "q_vectors": q[:1].tobytes(), "q_cutoff": np.array([t]).tobytes(), "key": np.arange(500).tobytes(), "ids": np.arange(500).tobytes(), "vectors": c.tobytes()}])
    out = next(topk._collected(k)(iter([batch])))
    assert sorted(out["score"]) == sorted((q[:1] @ c.T)[0])[-k:]
    assert resolved == [int((np.stack([p[0] for p in parts]) >= t / len(parts)).any(axis=0).sum())] and resolved[0] < 250


def test_top_k_beyond_floats(spark):
    rows = [(0, [1e9, 1.0]), (1, [1e9, 3.0]), (2, [1e9, 2.0]), (3, [1e30, 1.0])]
    got = topk.top_k(frame(spark, rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 3).collect()
    exact = lambda a, b: sum(int(np.floor(x * 1024)) * int(np.floor(y * 1024)) for x, y in zip(a, b, strict=True))
    top = (1 << 63) - 1
    expected = sorted(((min(exact(rows[0][1], v), top), -i) for i, v in rows[1:]), reverse=True)
    assert [(g["score"], -g["vec_id"]) for g in sorted(got, key=lambda g: g["rank"])] == expected


@pytest.mark.parametrize("copies", [0, 900])
def test_top_k_cells_do_not_grow(spark, monkeypatch, copies):
    """No cell that is written holds more than a vector, lanes of many tiles are exact, and equal vectors are ordered by id."""
    saved, save = [], topk.Scratch.save
    monkeypatch.setattr(topk.Scratch, "save", lambda self, df, *a, **b: saved.append(out := save(self, df, *a, **b)) or out)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 32)
    r = np.random.default_rng(8)
    m = r.normal(size=(3000, 16)).astype(np.float32)
    m[r.permutation(3000)[:copies]] = m[0]
    rows = [(int(i), [float(x) for x in m[n]]) for n, i in enumerate(r.permutation(3000))]
    got = topk.top_k(frame(spark, rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0).collect()
    ids, v = np.array([i for i, _ in rows]), np.floor(m.astype(float) * 1024).astype(np.int64)
    expected = []
    for n in np.flatnonzero(ids % 100 == 0):
        scores = v @ v[n]
        order = [j for j in np.lexsort((ids, -scores)) if j != n][:10]
        expected += [(ids[n], at, ids[j], scores[j]) for at, j in enumerate(order, 1)]
    assert sorted(map(tuple, got)) == sorted(expected)
    cells = [df.agg(F.max(F.octet_length(c))).first()[0] for df in saved for c, kind in df.dtypes if kind == "binary"]
    assert cells and max(cells) <= 16 * 8


def test_top_k_heads_of_a_lane_have_one_size():
    r, k = np.random.default_rng(9), 4
    m = r.integers(-9, 9, (2000, 8)).astype(np.float32)
    row = lambda side, n: {"dim": 8, "side": side, "key": n, "id": n, "vector": m[n].tobytes(), "cutoff": None}
    rows = pd.DataFrame([row(0, n) for n in range(2000)] + [row(1, n) for n in range(0, 2000, 100)])
    batches = [rows.iloc[at : at + 700] for at in range(0, len(rows), 700)]
    heads = pd.concat(topk._lists(k, 64)(topk._meetings(iter(batches), 6)))
    assert list(heads["key"]) == list(range(0, 2000, 100)) and {len(h) for h in heads["heads"]} == {topk.SLICES * k * 16}
    for key, raw in zip(heads["key"], heads["heads"], strict=True):
        for n, entries in enumerate(np.frombuffer(raw, topk._ENTRY).reshape(topk.SLICES, k)):
            part = m[:, 2 * n : 2 * n + 2] @ m[key, 2 * n : 2 * n + 2]
            assert all(part[e["row"]] == e["partial"] and e["row"] != key for e in entries) and len(set(entries["row"])) == k
            assert sorted(entries["partial"]) == sorted(np.delete(part, key))[-k:]


# columns of any name

INNER = (
    "score predicted kept_text n_lines n_dropped lines_id lines_version lines_words leaked_item containment consistency n_items contaminated leak_best leak_items leak_found "
    "spans pii_base pii_terms sanitised text_score meta_score scores carried id rep key block part row h1 h2 pos line slice n_shared component_id rank embedding ids _s _found _best _words _bid a.b a`b"
).split()


def crowded(spark, rows, schema, *own):
    """Rows with extra columns of all names that the operators add or use inside."""
    df = frame(spark, rows, schema)
    return df.select("*", *(F.lit(f"mine {n}").alias(n) for n in INNER if n not in own))


ADDED = {
    "toxicity": (lambda d, lab: toxicity.score_toxicity(d, lab), {"score", "predicted"}),
    "quality": (lambda d, lab: quality.score_quality(d, lab.withColumnRenamed("toxic", "quality")), {"score", "text_score", "meta_score"}),
    "lines": (lambda d, lab: line_dedup.dedup_lines(d), {"kept_text", "n_lines", "n_dropped"}),
    "leaks": (lambda d, lab: decontaminate.decontaminate(d, lab.select(F.col("doc_id").alias("item_id"), F.lit("a b c d e f g").alias("text"))), {"leaked_item", "containment", "consistency", "n_items", "contaminated"}),
    "personal": (lambda d, lab: pii.sanitise(d), {"spans", "sanitised"}),
}
ODD_ROWS = [(1, "one line that is long enough\na b c d e f g", "en", "s", 9), (2, None, None, None, None), (None, "", "en", None, 0), (4, "ONE LINE THAT IS LONG ENOUGH", "de", "s", 5), (4, "one line that is long enough", "de", "s", 5), (4, "one line that is long enough", "de", "s", 5), (6, "one line that is long enough a.b@c.de", "x", "y", 1)]
ODD_SCHEMA = f"{DOC}, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(ADDED))
def test_columns_of_any_name(spark, name):
    operate, added = ADDED[name]
    labels = frame(spark, [(1, 0), (4, 1), (None, 1), (6, 0)], "doc_id long, toxic int")
    docs = crowded(spark, ODD_ROWS, ODD_SCHEMA)
    out = operate(docs, labels)
    got = out.toPandas()
    assert len(got) == len(ODD_ROWS) and set(got.columns) == set(docs.columns) | added
    for n in set(INNER) - added:
        assert set(got[n]) == {f"mine {n}"}, n


def test_columns_are_left_out(spark):
    docs = crowded(spark, ODD_ROWS, ODD_SCHEMA)
    assert near_dedup.near_duplicates(docs).count() == 6
    assert suffix_dedup.repeated_passages(docs).count() == len(ODD_ROWS)
    assert packing.pack(docs).groupBy("doc_id").agg(F.sum("length")).count() == 5
    rows = crowded(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<double>", "embedding")
    assert topk.top_k(rows, F.col("vec_id") == 0, 5).count() == 2
    turns = crowded(spark, [(0, 0, "user", "q"), (1, 0, "user", "q")], "conv_id long, turn long, role string, text string")
    assert chat_format.format_preferences(turns, F.shiftright("conv_id", 1), F.when(F.col("conv_id") == 0, "chosen").otherwise("rejected")).count() == 1


def test_very_long_texts(spark):
    r = random.Random(31)
    line = "a line that very many documents share"
    long = "\n".join([line if i % 3 == 0 else f"own line number {i} of this text" for i in range(50_000)])
    docs = frame(spark, [(1, long, "en", "s", 1), (2, line, "en", "s", 1), (3, line, "en", "s", 1), (4, QUESTION + " " + prose(60_000, r), "en", "s", 1), (5, prose(9, r), "en", "s", 1)], ODD_SCHEMA)
    begun = time.monotonic()
    got = {g["doc_id"]: (g["n_lines"], g["n_dropped"], g["kept_text"]) for g in line_dedup.dedup_lines(docs).collect()}
    assert time.monotonic() - begun < 60  # with the square of the lines it takes minutes
    assert got[1] == (50_000, 16_667, "\n".join(x for x in long.split("\n") if x != line)) and got[2][1] == 1 and got[3][1] == 0
    bench = frame(spark, [(7, QUESTION)], "item_id long, text string")
    assert [g["doc_id"] for g in decontaminate.decontaminate(docs, bench).where("contaminated").collect()] == [4]
    labels = frame(spark, [(1, 0), (4, 1)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(docs, labels).where("score between 0 and 1").count() == 5
    assert quality.score_quality(docs, labels.withColumnRenamed("toxic", "quality")).where("score between 0 and 1").count() == 5
    assert pii.find_personal_data(docs).count() == 5


# the pipeline


def test_pipeline_equals_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline as p

    r = random.Random(51)
    line = "a line that very many documents share"
    texts, toxic = {}, {}
    for i in range(400):
        toxic[i] = int(i % 5 == 0)
        texts[i] = prose(40, r) + (f" {r.choice(['zzidiotic', 'zzmoronic'])} {prose(5, r)}" if toxic[i] else "") + (f"\n{line}" if i % 7 == 0 else "")
    for i in range(400, 460):  # copies and near copies
        texts[i] = edited(texts[r.choice([1, 2, 3, 4, 6])], r.choice([0, 0.01, 0.02, 0.2]), r)
    for i in range(460, 470):
        texts[i] = f"{prose(30, r)} {QUESTION} {prose(9, r)}"
    texts |= {470: None, 471: "", 472: f"{line}\n{line}"}
    frame(spark, [(i, t, "en", "s", len(t or "")) for i, t in texts.items()], f"{DOC}, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, [(i, x, 1) for i, x in toxic.items()], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    frame(spark, [(1, QUESTION)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = {i: t for i, t in texts.items() if not toxic.get(i)}
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()
    holds = defaultdict(set)
    for i, text in left.items():
        for x in (text or "").split("\n"):
            holds[key(x)].add(i)
    gone = lambda i, x: len(key(x)) >= 20 and len(holds[key(x)]) >= 3 and i != max(holds[key(x)])
    left = {i: "\n".join(x for x in (t or "").split("\n") if not gone(i, x)) for i, t in left.items()}
    left = {i: left[i] for i, (_, c) in brute_components(left).items() if c == i and QUESTION not in left[i]}
    pieces = p.run(spark, str(tmp_path)).toPandas()
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    got = {i: np.frombuffer(b"".join(g.sort_values("start")["ids"]), "<u4").tolist() for i, g in pieces.groupby("doc_id")}
    assert set(got) == set(left)
    assert got == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in left.items()}


def test_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline as p

    docs = crowded(spark, [(i and i + 10**6, *x) for i, *x in ODD_ROWS], ODD_SCHEMA)  # ids without labels
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        got = out.toPandas()
        assert all(set(got[n]) <= {f"mine {n}"} for n in INNER), name
        assert len(got) <= len(ODD_ROWS) and got["doc_id"].isna().any(), name
    assert p.STAGES[-1][1](spark, docs, SMALL).count() > 0


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert len(p.STAGES) == 5
    columns = docs.columns
    before = docs
    for name, stage in p.STAGES[:-1]:
        after = stage(spark, before, SMALL)
        assert after.columns == columns, name
        after.write.mode("overwrite").parquet(path := f"{spark.sparkContext.getConf().get('spark.checkpoint.dir')}/p-{name}")
        after = spark.read.parquet(path)
        assert after.count() <= before.count()
        before = after
    pieces = p.STAGES[-1][1](spark, before, SMALL).toPandas()
    assert set(pieces["doc_id"]) == {r["doc_id"] for r in before.select("doc_id").collect()}
    assert len({r["text"] for r in before.select("text").collect() if r["text"]}) == before.where("text <> ''").count()
    assert zlib.crc32(b"") == 0


def test_stages_on_nothing(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 0")
    for _, stage in p.STAGES:
        assert stage(spark, docs, SMALL).count() == 0
