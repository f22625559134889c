"""Operators that compare texts with one another, against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from retailmill.llm import decontaminate, jaccard, preference, queries
from retailmill.llm.components import components
from retailmill.llm.shingles import shingle_sets
from texts import HARD, documents, prose


def shingles_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def brute_components(rows):
    sets = [shingles_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            root = find(i)
            names[root] = min(names.get(root, doc_id), doc_id)
    return sorted(
        ((d, len(sets[i]), names.get(find(i), d)) for i, (d, _) in enumerate(rows)), key=lambda r: (r[0] is None, r)
    )


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=lambda r: (r[0] is None, r))


def changed(text, r, n):
    words = text.split(" ")
    for _ in range(n):
        words[r.randrange(len(words))] = f"c{r.randrange(10**6)}"
    return " ".join(words)


def test_components(spark):
    pairs = [(k, k + 1) for k in range(1, 60)] + [(100, 101), (103, 101), (7, 7)] + [(200, k) for k in range(201, 260)]
    got = {r.v: r.label for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {got[k] for k in range(1, 61)} == {1} and {got[k] for k in (100, 101, 103)} == {100}
    assert {got[k] for k in range(200, 260)} == {200} and len(got) == 60 + 3 + 60
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingle_sets_follow_words():
    texts = ["A  b\tc d E", "a b c d e", "x", "", " \n", "a b c d e f a b c d e", "é ü a b c"]
    sets = shingle_sets(texts)
    assert [len(s) for s in sets] == [len(shingles_of(t)) for t in texts]
    assert sets[0].tolist() == sets[1].tolist()


def test_near_duplicates_with_a_common_passage(spark):
    """Copies, near copies, chains, and a passage that a third of all texts share, so that
    tiles with many components and leaning sets occur."""
    r, rows = random.Random(3), []
    passage = prose("passage", 45)
    for k in range(150):
        rows.append((len(rows), f"{passage} {prose(('lean', k), r.randrange(4, 70), 5000)}"))
    for k in range(40):
        base = prose(("base", k), r.randrange(30, 600), 5000)
        rows += [(len(rows) + i, t) for i, t in enumerate([base, changed(base, r, 1), changed(base, r, len(base.split()) // 50), base])]
    lean = f"{passage} {prose('near', 30, 5000)}"
    rows += [(len(rows) + i, changed(lean, r, 1)) for i in range(25)]
    chain = prose("chain", 200, 5000)
    for _ in range(12):
        chain = changed(chain, r, 3)
        rows.append((len(rows), chain))
    rows += [(len(rows) + i, t) for i, t in enumerate(["a b c d e f g h", "a b c d e f g h i", "q w e r t", "q w e r", "Q W E R"])]
    docs = documents(spark, rows)
    assert found(jaccard.jaccard_components(docs)) == brute_components(rows)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(x.doc_id for x in kept.collect()) == sorted({c for _, _, c in brute_components(rows)})


@pytest.mark.parametrize("few, block", [(1, 7), (4, 64)])
def test_common_tiles_lose_nothing(spark, monkeypatch, few, block):
    monkeypatch.setattr(jaccard, "FEW_PAIRS", few)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    r, rows = random.Random(few), []
    passage = prose("p", 60)
    for k in range(60):
        own = f"{passage} {prose(('o', k), r.randrange(2, 40), 5000)}"
        rows += [(len(rows) + i, t) for i, t in enumerate([own, changed(own, r, r.randrange(4))])]
    assert found(jaccard.jaccard_components(documents(spark, rows))) == brute_components(rows)


@pytest.mark.parametrize("seed", range(3))
def test_rows_without_an_id_link_in_any_order(spark, seed):
    """Null and repeated ids, in every order and partitioning: a null row may be the first
    that holds a set, and one id may hold two texts."""
    r = random.Random(seed)
    base, other = prose("a", 80, 5000), prose("b", 60, 5000)
    near = changed(base, r, 1)
    rows = [
        (None, base), (1, base), (2, near), (None, other), (None, changed(other, r, 1)), (7, base), (7, "one id, two texts, the other"),
        (9, None), (9, None), (8, "short"), (8, "short"), (None, None), (None, base), (3, "lonely " + prose("c", 40, 5000)),
    ]
    r.shuffle(rows)
    docs = documents(spark, rows).repartition(1 + 2 * seed)
    names = brute_components(rows)
    assert found(jaccard.jaccard_components(docs)) == names
    kept = sorted(((x.doc_id, x.text) for x in jaccard.keep_one(docs).collect()), key=str)
    # one of base and its near copy (the smallest id), one of the null group, every other text
    assert [k for k in kept if k[1] in (base, near)] == [(1, base)]
    assert len([k for k in kept if k[0] is None and k[1] is not None]) == 1
    assert [k for k in kept if k[0] == 7] == [(7, "one id, two texts, the other")]
    assert [k for k in kept if k[0] == 8] == [(8, "short")]
    assert len([k for k in kept if k[1] is None]) == 3 and any(k[0] == 3 for k in kept)


def test_pairs_grow_with_a_group_not_its_square(spark, monkeypatch):
    """Near copies of one text, most of them linked with only some of the others."""
    counts = []
    verify = jaccard.exact_links
    for n in (150, 300):
        r = random.Random(1)
        base = prose("group", 120, 5000)
        rows = [(k, changed(base, r, 1 + k % 2)) for k in range(n)]
        seen = []
        monkeypatch.setattr(jaccard, "exact_links", lambda pairs, *rest: seen.append(pairs.count()) or verify(pairs, *rest))
        assert found(jaccard.jaccard_components(documents(spark, rows, extra=False))) == brute_components(rows)
        counts.append(sum(seen))
    assert counts[1] < 2.6 * counts[0], counts


def test_little_is_apart_after_a_forest_of_a_crowd(spark, monkeypatch):
    """Near copies in several components, of which pairs that the bitmaps allow are not all linked:
    one that is not must not leave all pairs of its two components to be verified."""
    seen, verify = [], jaccard.exact_links
    r = random.Random(1)
    base = prose("group", 100, 5000)
    rows = [(k, changed(base, r, 1 + k % 3)) for k in range(600)]
    monkeypatch.setattr(jaccard, "exact_links", lambda pairs, *rest: seen.append(pairs.count()) or verify(pairs, *rest))
    assert found(jaccard.jaccard_components(documents(spark, rows, extra=False), exact=True)) == brute_components(rows)
    assert seen[-1] < len(rows) / 4, seen


@pytest.mark.parametrize("largest, bits", [(1 << 13, 32), (1 << 13, 3), (60, 32)])
def test_crowded_tiles_lose_nothing(spark, monkeypatch, largest, bits):
    """Also with short hashes that tie sets which are not linked, and sets too large for them."""
    short = jaccard.short_hashes
    monkeypatch.setattr(jaccard, "short_hashes", lambda own: short(np.sort(own & np.uint64((1 << bits) - 1))))
    for name, value in (("LARGEST", largest), ("MANY", 8), ("FEW_PAIRS", 4), ("BLOCK", 32)):
        monkeypatch.setattr(jaccard, name, value)
    r = random.Random(bits)
    rows = []
    for words in (50, 70):
        base = prose(("crowd", words), words, 5000)
        rows += [(len(rows) + k, changed(base, r, 1 + k % 3)) for k in range(90)]
    assert found(jaccard.jaccard_components(documents(spark, rows, extra=False), exact=True)) == brute_components(rows)


def test_exact_enters_every_slice(spark):
    r = random.Random(2)
    rows = []
    for k in range(6):
        text = prose(("long", k), 900, 5000)
        rows += [(len(rows) + i, t) for i, t in enumerate([text, changed(text, r, 18), changed(text, r, 25)])]
    got = found(jaccard.jaccard_components(documents(spark, rows), exact=True))
    assert got == brute_components(rows)
    own = shingle_sets([rows[0][1]])[0]
    every = jaccard.tiles(own, 1 << 31)
    assert all(t["all_known"] for t in every) and max(len(t["tile"]) for t in every) > jaccard.SLICES
    assert all(len(t["tile"]) <= jaccard.SLICES for t in jaccard.tiles(own))


def test_the_queries_leave_nothing_to_chance(spark, monkeypatch):
    """Both enter every slice of a long set, not its first 64."""
    text = prose("long", 900, 5000)
    docs = documents(spark, [(1, text), (2, changed(text, random.Random(4), 18)), (3, "a b c d e f")])
    most, real = [], jaccard.profiles
    monkeypatch.setattr(jaccard, "profiles", lambda docs, n: most.append(n) or real(docs, n))
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert [r[2] for r in found(queries.op6_ngram_jaccard(spark, ""))] == [1, 1, 3]
    assert len(most) == 2 and min(most) > jaccard.SLICES


def test_exact_sets_enter_a_fifth_of_their_shingles(spark, monkeypatch):
    """Few tiles a set, and none lost: a passage that many share, near copies at and about the threshold."""
    monkeypatch.setattr(jaccard, "FEW_PAIRS", 4)
    monkeypatch.setattr(jaccard, "MANY", 16)
    r, rows = random.Random(8), []
    passage = prose("shared", 60)
    for k in range(25):
        own = f"{passage} {prose(('mine', k), r.randrange(2, 40), 5000)}"
        rows += [(len(rows) + i, t) for i, t in enumerate([own, changed(own, r, r.randrange(4))])]
    for k in range(25):
        base = prose(("from", k), r.randrange(5, 400), 5000)
        rows += [(len(rows) + i, t) for i, t in enumerate([base, changed(base, r, 1 + len(base.split()) // 45), base[: len(base) * 4 // 5]])]
    docs = documents(spark, rows, extra=False)
    entered = jaccard.profiles(docs, 1 << 31).where("tiles IS NOT NULL").selectExpr("n_shingles AS n", "flatten(tiles.tile) AS tile").collect()
    assert all(len(x.tile) == x.n - -(-x.n * 4 // 5) + 1 for x in entered)
    assert found(jaccard.jaccard_components(docs, exact=True)) == brute_components(rows)


def test_near_duplicates_of_hard_texts(spark):
    assert found(jaccard.jaccard_components(documents(spark, HARD))) == brute_components(HARD)
    empty = documents(spark, [])
    assert jaccard.jaccard_components(empty).count() == 0 and jaccard.keep_one(empty).count() == 0
    assert jaccard.keep_one(documents(spark, HARD)).where("doc_id IS NULL").count() == 1


# --- benchmark passages ----------------------------------------------------------


def plain_hits(rows, items, masked=True):
    """Every alignment of every document and item, word by word; ``masked``: that a mask would meet."""
    def words(t):
        return [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]

    out = set()
    for doc_id, text in rows:
        x = words(text)
        for item_id, item in items:
            y = words(item)
            if 5 <= len(y) < 12:
                out |= {(doc_id, item_id, i, len(y), len(y)) for i in range(len(x)) if x[i : i + len(y)] == y}
            for i in range(len(x) - 11):
                for j in range(len(y) - 11):
                    if masked and not any(all(x[i + k] == y[j + k] for k in m) for m in decontaminate.MASKS):
                        continue
                    span = range(-min(i, j, 6), min(len(x) - i, len(y) - j, 18))
                    n = sum(x[i + k] == y[j + k] for k in span)
                    own = sum(x[i + k] == y[j + k] for k in range(12))
                    if n >= 10 and n >= 0.6 * len(span) or own >= 11:
                        out.add((doc_id, item_id, i, n, len(span)))
    return out


def leaks(spark, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.contaminated(documents(spark, rows), bench).collect()}


def test_excerpts_of_any_length_and_regular_substitutions(spark):
    items = [(1, prose("item", 60, 9000)), (2, prose("short", 11, 9000)), (3, prose("tiny", 4, 9000)), (4, prose("five", 5, 9000))]
    words = items[0][1].split(" ")
    rows = [(n, f"{prose(n, 40, 9000)} {' '.join(words[20 : 20 + n])} {prose(-n, 40, 9000)}") for n in (11, 12, 13, 14, 15, 16, 20)]
    for every in (3, 4, 5):
        for first in range(every):
            spoilt = [f"z{k}" if k % every == first else w for k, w in enumerate(words)]
            rows.append((100 * every + first, f"{prose((every, first), 30, 9000)} {' '.join(spoilt)}"))
    rows += [(2, f"{prose(2, 30, 9000)} {items[1][1]} end"), (3, f"a {items[2][1]} b"), (4, f"a {items[3][1]} b"), (5, prose(5, 90, 9000))]
    found = leaks(spark, rows, items)
    assert found == {(d, 1) for d, _ in rows if d not in (2, 3, 4, 5)} | {(2, 2), (4, 4)}


def test_recall_against_alignment_without_masks(spark):
    r, items, rows = random.Random(7), [(k, prose(("item", k), 15 + 3 * k, 9000)) for k in range(12)], []
    for k in range(120):
        words = items[k % 12][1].split(" ")
        words = [f"s{r.randrange(9999)}" if r.random() < (k % 4) / 10 else w for w in words]
        rows.append((k, f"{prose(k, 30, 9000)} {' '.join(words)} {prose(-k, 9, 9000)}"))
    want = {h[:2] for h in plain_hits(rows, items, masked=False)}
    found = leaks(spark, rows, items)
    assert found <= want and len(found) >= 0.9 * len(want) and len(want) > 80


def test_repeated_words_multiply_nothing(spark):
    bench = spark.createDataFrame([(1, "word " * 300)], "item_id long, text string")
    docs = documents(spark, [(1, "word " * 8_000), (2, "other " * 500)])
    assert decontaminate.hits(docs, bench).count() < 20 * 8_000
    pair = decontaminate.contaminated(docs, bench).collect()
    assert [tuple(p) for p in pair] == [(1, 1, 7_989, 24, 0)]


@pytest.mark.parametrize("few", [500_000, 0])
def test_decontamination(spark, few):
    items = [(k, prose(("item", k), 20 + k, 3000)) for k in range(5)] + [(9, "too short to tell"), (10, None)]
    r = random.Random(0)
    rows = [(1, prose(1, 200, 3000)), (2, prose(2, 50, 3000) + " " + items[2][1].upper().replace(" ", ", ") + " " + prose(3, 9, 3000)), (3, None)]
    for k in range(4, 9):
        words = items[k % 5][1].split(" ")
        for _ in range(2):
            words[r.randrange(len(words))] = "swapped"
        rows.append((k, prose(k, 30, 3000) + " " + " ".join(words)))
    rows.append((20, items[4][1]))
    docs = documents(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    settings = decontaminate.Settings(broadcast_seeds=few)
    got = {tuple(h) for h in decontaminate.hits(docs, bench, settings).collect()}
    assert got == plain_hits(rows, items) and {h[0] for h in got} >= {2, 20}
    pairs = decontaminate.contaminated(docs, bench, settings).collect()
    assert {(p.doc_id, p.item_id): p.n_hits for p in pairs} == {
        k: len({h[2] for h in got if h[:2] == k}) for k in {h[:2] for h in got}
    }
    kept = decontaminate.without_benchmark(docs, bench, settings)
    assert kept.columns == docs.columns and {x.doc_id for x in kept.collect()} == {d for d, _ in rows} - {h[0] for h in got}
    plan = decontaminate.contaminated(docs, bench, settings)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_decontamination_of_hard_texts(spark):
    bench = spark.createDataFrame([(1, "word " * 15)], "item_id long, text string")
    assert {x.doc_id for x in decontaminate.contaminated(documents(spark, HARD), bench).collect()} == {9}
    assert decontaminate.contaminated(documents(spark, []), bench).count() == 0
    assert decontaminate.contaminated(documents(spark, HARD), bench.limit(0)).count() == 0


def test_decontamination_of_rows_without_ids(spark):
    one, two = prose("one", 20, 3000), prose("two", 25, 3000)
    bench = spark.createDataFrame([(None, one), (None, two), (3, prose("three", 20, 3000))], "item_id long, text string")
    docs = documents(spark, [(1, f"a b {one} c"), (None, f"x {two} y z"), (None, prose("clean", 60, 3000)), (2, prose("other", 60, 3000))])
    got = {(r.doc_id, r.item_id): r.best_equal for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(1, None): 20, (None, None): 24}
    kept = decontaminate.without_benchmark(docs, bench)
    assert sorted(r.text for r in kept.collect()) == sorted([prose("clean", 60, 3000), prose("other", 60, 3000)])


# --- preference pairs --------------------------------------------------------------


def test_preference_pairs(spark):
    rows = [
        (1, "chosen", 0, "user", "hi"), (1, "rejected", 0, "user", "hi"), (1, "chosen", 1, "assistant", "good <|x"),
        (1, "rejected", 1, "assistant", "bad"), (1, "rejected", 2, "user", "why"), (1, "rejected", 3, "assistant", None),
        (2, "chosen", 0, "user", "same"), (2, "rejected", 0, "user", "same"),
        (3, "chosen", 0, None, "only one side"), (None, "chosen", None, "user", "no id"), (None, "rejected", None, "user", "no id"),
        (4, "chosen", 0, "user", "twice"), (4, "chosen", 0, "user", "twice"), (4, "rejected", 0, "user", "twice"),
    ]
    df = spark.createDataFrame(rows, "pair_id long, side string, turn long, role string, text string").withColumn("n", F.lit(1))
    got = {r.pair_id: r for r in preference.preference_pairs(df).collect()}
    one = got[1]
    assert (one.n_prompt_turns, one.prompt) == (1, "<|user|>\nhi<|end|>\n")
    assert one.chosen == "<|assistant|>\ngood < |x<|end|>\n"
    spans = [tuple(map(int, s.split(":"))) for s in one.rejected_mask.split(",")]
    assert [one.rejected[a:b] for a, b in spans] == ["bad<|end|>\n", "<|end|>\n"]
    assert (got[2].n_prompt_turns, got[2].chosen, got[2].rejected, got[2].chosen_mask) == (1, "", "", "")
    assert (got[3].n_prompt_turns, got[3].prompt, got[3].rejected) == (0, "", "") and got[3].chosen.startswith("<|unknown|>")
    assert got[None].n_prompt_turns == 1 and got[4].n_prompt_turns == 1 and got[4].chosen == "<|user|>\ntwice<|end|>\n"
    assert preference.preference_pairs(df.limit(0)).count() == 0
    plan = preference.preference_pairs(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_turns_without_a_conversation_form_one_pair(spark):
    rows = [(None, 0, "user", "hi"), (None, 1, "assistant", "good day"), (1, 0, "user", "u"), (1, 1, "assistant", "reply")]
    turns = preference.cut_reply_pairs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.pair_id: r for r in preference.preference_pairs(turns).collect()}
    assert set(got) == {None, 1} and got[None].prompt == "<|user|>\nhi<|end|>\n"
    assert got[None].chosen == "<|assistant|>\ngood day<|end|>\n" and got[None].rejected == "<|assistant|>\ngood<|end|>\n"
    assert got[1].rejected == "<|assistant|>\nre<|end|>\n"
