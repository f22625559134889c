"""Fill-in-the-middle, packing and hard negatives against plain restatements."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retailmill.llm import fill_middle, hard_negatives, packing
from retailmill.llm.common import slices_by_size
from retailmill.llm.wavelet import WaveletMatrix
from texts import HARD, documents, prose

WORDS = public_tokenizers.path("word_bpe_49k.json")
FILL_CASES = [
    *HARD, (20, "a\n\nb\n"), (21, "a\nb"), (22, "\n"), (23, "has <P> inside\nx"), (24, "<S>"), (25, "<<P\n>\n<"),
    *((100 + k, "\n".join(prose(k, 4) + "." * (k % 3) for _ in range(k % 9))) for k in range(60)),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- fill-in-the-middle -----------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=300))
def test_wavelet_matrix(codes):
    codes = np.array(codes, np.uint8)
    matrix = WaveletMatrix(codes, 2)
    i = np.arange(len(codes) + 1)
    for wanted in ((0,), (3,), (1, 2), (0, 1, 2, 3)):
        places = np.flatnonzero(np.isin(codes, wanted))
        assert (matrix.rank_of(wanted, i) == np.searchsorted(places, i)).all()
        assert (matrix.select_of(wanted, np.arange(len(places))) == places).all()


def plain_fill(doc_id, text, pattern):
    text = text or ""
    units = re.findall(pattern, text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")):
        return (doc_id, len(units), "plain", None, None, text)
    if h[3] % 100 < 50:
        return (doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("unit, pattern", [("line", r"[^\n]*\n|[^\n]+"), ("sentence", r"[^\n.!?]*[\n.!?]|[^\n.!?]+")])
def test_fill_in_middle(spark, unit, pattern):
    docs = documents(spark, FILL_CASES)
    chosen = fill_middle.Settings(unit=unit)
    rows = fill_middle.fill_in_middle(docs, chosen).collect()
    assert sorted(map(tuple, rows), key=str) == sorted((plain_fill(*c, pattern) for c in FILL_CASES), key=str)
    if unit == "line":  # the digests are those of output and text
        got = {(r.doc_id, r.output_sha256, r.restored_sha256) for r in fill_middle.digests(docs).collect()}
        assert got == {(i, sha(plain_fill(i, t, pattern)[5]), sha(t or "")) for i, t in FILL_CASES}


def test_fill_in_middle_draws_and_empty_tables(spark):
    assert fill_middle.digests(documents(spark, [])).count() == 0
    docs = documents(spark, [(k, "a\nb\nc") for k in range(200)])
    forms = fill_middle.fill_in_middle(docs, fill_middle.Settings(percent=40)).groupBy("form").count().collect()
    shares = {r.form: r["count"] for r in forms}
    assert 90 < shares["plain"] < 150 and min(shares.values()) > 15


@given(st.lists(st.integers(0, 50), max_size=40), st.integers(1, 7), st.integers(1, 60))
def test_slices(sizes, rows, most):
    got = list(slices_by_size(np.array(sizes, float), rows, most))
    assert [k for a, b in got for k in range(a, b)] == list(range(len(sizes)))
    assert all(b - a <= rows and (sum(sizes[a:b]) <= most or b - a == 1) for a, b in got)


# --- packing ------------------------------------------------------------------------


ODD = st.text(st.sampled_from(" " * 4 + "aZÉß'sSTt12\t\n\r.,!?<|>éİΣς́ﬁ日😀×\x85\x1c_-"), max_size=24)


@settings(max_examples=300, deadline=None)
@given(st.one_of(ODD, st.lists(st.sampled_from(["<|endoftext|>", "It's", " ", "é", "x<|startoftext|>"]), max_size=6).map("".join)))
def test_word_encoder_equals_the_library(text):
    encoder, fresh = test_word_encoder_equals_the_library.pair
    assert np.frombuffer(encoder(text), "<u4").tolist() == fresh.encode(text, add_special_tokens=False).ids


test_word_encoder_equals_the_library.pair = packing.WordEncoder(WORDS, most=20), Tokenizer.from_file(WORDS)


def fewest_bins(items, capacity):
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for load in {*bins}:
            if load + items[i] <= capacity:
                k = bins.index(load)
                place(i + 1, [*bins[:k], load + items[i], *bins[k + 1 :]])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best


@settings(max_examples=200, deadline=None)
@given(st.sampled_from([6, 10, 17, 30]).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=8))))
def test_bounds_are_below_and_best_fit_is_a_packing(case):
    capacity, items = case[0], np.array(sorted(case[1], reverse=True), np.int64)
    least = packing.lower_bound(np.bincount(items, minlength=capacity + 1))
    assert least <= fewest_bins(items.tolist(), capacity)
    bins, offsets, slack = packing.best_fit_decreasing(items, capacity)
    assert least <= len(slack) == len(set(bins.tolist()))
    for b in range(len(slack)):
        at = 0
        for k in sorted(np.flatnonzero(bins == b), key=lambda k: offsets[k]):
            assert offsets[k] == at
            at += items[k]
        assert at + slack[b] == capacity


def test_bounds_beyond_volume():
    """Three thirds and a bit, halves and a bit: where volume alone says too little."""
    assert packing.lower_bound(np.bincount([51] * 10, minlength=101)) == 10
    assert packing.lower_bound(np.bincount([34] * 10, minlength=101)) == 5
    assert packing.lower_bound(np.bincount([51] * 4 + [26] * 8, minlength=101)) == 6


def check_packing(rows, capacity):
    loads = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == loads.get(r.sequence_id, 0)
        loads[r.sequence_id] = r.offset + r.length
    assert all(load <= capacity for load in loads.values())
    return len(loads)


def test_packing_of_hard_texts(spark):
    rows = packing.pack(documents(spark, HARD), WORDS).collect()
    check_packing(rows, 4096)
    fresh, got = Tokenizer.from_file(WORDS), {}
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.piece)):
        got.setdefault(r.doc_id, []).append(r)
    for doc_id, text in HARD:
        ids = fresh.encode(text or "", add_special_tokens=False).ids + [1]
        copies = sum(i == doc_id for i, _ in HARD)
        whole = [np.frombuffer(r.ids, "<u4").tolist() for r in got[doc_id]]
        assert whole == [ids[a : a + 4096] for a in range(0, len(ids), 4096) for _ in range(copies)]
        assert {(r.piece, r.start, r.length) for r in got[doc_id]} == {
            (k, a, min(4096, len(ids) - a)) for k, a in enumerate(range(0, len(ids), 4096))
        }
    digest = {(r.doc_id, r.piece, r.ids_crc32) for r in packing.digests(documents(spark, HARD), WORDS).collect()}
    assert digest == {(r.doc_id, r.piece, zlib.crc32(r.ids)) for r in rows}
    assert packing.pack(documents(spark, []), WORDS).count() == 0


def test_groups_exchange_documents_until_the_bound_is_met(spark):
    r = random.Random(5)
    items = spark.createDataFrame([(k, 0, r.randint(1, 40)) for k in range(3_000)], "row long, piece int, length long")
    chosen = packing.Settings(capacity=100, group_pieces=200)
    alone = packing._packed(items, 3_000, 1, chosen)
    placed, total, least = packing.placements(items, chosen)
    rows = items.join(placed, ["row", "piece"]).collect()
    assert len(rows) == 3_000 and check_packing(rows, 100) == total
    assert total <= least + 1 < packing._bins(alone)[0]


# --- hard negatives -------------------------------------------------------------------


def plain_negatives(rows):
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        kept.append((vec_id, [math.floor(256 * c) for c in vector], label))
    order = [(v is None, v or 0) for v, _, _ in kept]
    out = []
    for i, (anchor, x, label) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        score = [sum(a * b for a, b in zip(x, y)) for _, y, _ in kept]
        ranked = sorted((j for j in range(len(kept)) if j != i), key=lambda j: (-score[j], order[j]))
        for p in [j for j in ranked if kept[j][2] == label][:5]:
            fit = [j for j in ranked if kept[j][2] != label and 30 * score[p] <= 100 * score[j] <= 90 * score[p]]
            out += [(anchor, kept[p][0], k + 1, kept[j][0], score[p], score[j]) for k, j in enumerate(fit[:10])]
    return sorted(out, key=str)


def vectors(seed, n):
    r = random.Random(seed)
    centres = ([1, 0, 0, 0.2], [0, 1, 0, 0], [0, 0, 1, -0.5])
    rows = []
    for v in range(n):
        c = r.randrange(3)
        rows.append((v, [float(np.float32(r.gauss(m, 0.1))) for m in centres[c]], c if r.random() < 0.7 else r.randrange(10)))
    return rows


ODD_VECTORS = [
    (None, [0.1, 0.2, 0.3, 0.4], 1), (None, [0.1, 0.2, 0.3, 0.4], 2), (901, None, 1), (902, [1.0, None], 1),
    (903, [math.nan, 1.0], 2), (904, [math.inf], 2), (905, [1.0, 2.0], 3), (906, [], 4), (1000, [0.0] * 4, 3),
    (1100, [1.0, 0.0], None), (1200, [-1.0, -1.0, -1.0, 0.0], 5), (1201, [0.25, 0.0, 0.0, 0.0], 5), (1300, [], 6),
    *((2000 + i, [0.5] * 4, 1) for i in range(40)), *((3000 + 100 * i, [0.5] * 4, 2) for i in range(4)),
]


@pytest.mark.parametrize(
    "chosen",
    [hard_negatives.Settings(), hard_negatives.Settings(column_rows=60, part_queries=4, window_rows=8, parts_a_task=2, references=3)],
)
def test_hard_negatives(spark, chosen):
    rows = [*vectors(3, 500), *ODD_VECTORS]
    rows += [rows[100]] * 3  # an anchor repeated
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "1 AS row", "2 AS col", "'x' AS key"
    )
    got = hard_negatives.hard_negatives(df, chosen).collect()
    assert sorted(map(tuple, got), key=str) == plain_negatives(rows)


def test_hard_negatives_of_an_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(none).count() == 0


def test_bounds_hold_and_thin_clustered_rows(spark):
    """No pair's score leaves its bounds, and on clusters most windows are left out."""
    r = np.random.default_rng(4)
    x = np.floor(256 * np.concatenate([r.normal(c, 0.05, (200, 8)) for c in np.eye(8)[:4]]))
    refs = hard_negatives.unit(np.eye(8)[:4])
    angles, norm = np.arccos(np.clip(hard_negatives.unit(x) @ refs.T, -1, 1)), np.linalg.norm(x, axis=1)
    side = {"low": angles, "high": angles, "short": norm, "long": norm}
    low, high = hard_negatives.score_bounds({k: v[:, None] for k, v in side.items()}, {k: v[None] for k, v in side.items()})
    score = x @ x.T
    assert (low <= score).all() and (score <= high).all()
    fifth = np.sort(score, axis=1)[:, -6]
    assert (high >= fifth[:, None]).mean() < 0.3
