"""Operators that work text by text, against plain restatements of what they promise."""

import hashlib
import random
import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retailmill.llm import licenses, merkle, pii, sentencepiece_chunks, token_count, token_files, toxicity
from texts import HARD, documents, prose

PIECES, BYTES = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "byte_bpe_50k.json"))
ODD = st.text(st.sampled_from(" " * 4 + "▁\n\t\x00\x1c\x85abcthe.,1é²ª  'sß日😀ﬁ<>|_-"), max_size=24)


@pytest.fixture(scope="module")
def hard(spark):
    return documents(spark, HARD)


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


def keyed(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))


# --- word-piece counts ---------------------------------------------------------


def greedy(begins, inner, word):
    n = at = 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if word[at:end] in (inner if at else begins):
                break
        else:
            return 1
        n, at = n + 1, end
    return n


def test_automaton_is_greedy_longest_match():
    r = random.Random(0)
    for _ in range(300):
        begins, inner = ([bytes(r.choice(b"abc") for _ in range(r.randrange(1, 6))) for _ in range(k)] for k in (5, 8))
        automaton = token_count.Automaton(begins, inner)
        for _ in range(20):
            word = bytes(r.choice(b"abc") for _ in range(r.randrange(1, 12)))
            assert automaton.tokens(word) == greedy(set(begins), set(inner), word)


def test_token_counts(spark, hard, empty):
    rows = keyed(token_count.token_counts(hard, BYTES))
    assert len(rows) == len(HARD)
    by_id = {r["doc_id"]: r for r in rows}
    assert [(by_id[i]["n_words"], by_id[i]["n_tokens"]) for i in (1, 2, 3)] == [(0, 0)] * 3
    assert by_id[9]["n_words"] == 20_000 and by_id[9]["n_tokens"] == 20_000 * (by_id[9]["n_tokens"] // 20_000)
    assert token_count.token_counts(empty, BYTES).count() == 0


# --- sentencepiece -------------------------------------------------------------


@given(ODD)
@settings(max_examples=300, deadline=None)
def test_chunks_equal_the_library(text):
    table = test_chunks_equal_the_library.table
    ids = table.model.encode(text)
    assert table.encode_with_decimal([text]) == [(ids, ",".join(map(str, ids)))]
    assert table.decode([ids]) == [table.model.decode(ids)]


test_chunks_equal_the_library.table = sentencepiece_chunks.ChunkTable(PIECES, most=50)


def test_sentencepiece_round_trip(spark, hard, empty):
    model = sentencepiece_chunks.ChunkTable(PIECES).model
    rows = keyed(sentencepiece_chunks.round_trip(hard, PIECES))
    want = sorted(HARD, key=lambda r: (r[0] is not None, r[0] or 0))
    for (doc_id, text), r in zip(want, rows):
        ids = model.encode(text or "")
        assert (r["doc_id"], r["n_tokens"]) == (doc_id, len(ids))
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(model.decode(ids).encode() if ids else b"").hexdigest()
    encoded = sentencepiece_chunks.encode(hard, PIECES)
    back = {r.doc_id: r.text for r in sentencepiece_chunks.decode(encoded, PIECES).collect()}
    assert back[4] == "one" and back[7] == HARD[7][1].replace("▁", " ")
    assert sentencepiece_chunks.round_trip(empty, PIECES).count() == 0


def test_ids_and_decoded_texts_are_kept(spark, hard, empty):
    model = sentencepiece_chunks.ChunkTable(PIECES).model
    rows = keyed(sentencepiece_chunks.encoded_and_decoded(hard, PIECES))
    want = sorted(HARD, key=lambda r: (r[0] is not None, r[0] or 0))
    for (doc_id, text), r in zip(want, rows, strict=True):
        ids = model.encode(text or "")
        assert (r["doc_id"], r["n_tokens"], r["ids"]) == (doc_id, len(ids), ids)
        assert r["decoded"] == (model.decode(ids) if ids else "")
    assert sentencepiece_chunks.encoded_and_decoded(empty, PIECES).count() == 0
    _, last = corpus_pipeline.STAGES[-1]
    assert last(spark, hard, "").columns == ["doc_id", "n_tokens", "ids", "decoded"]


# --- token files ---------------------------------------------------------------


@given(st.lists(st.integers(0, 10**7), max_size=300))
@settings(max_examples=100, deadline=None)
def test_elias_fano(steps):
    numbers = np.cumsum(np.array(steps, np.int64))
    coded = token_files.EliasFano.from_bytes(token_files.EliasFano.of(numbers).to_bytes())
    assert coded.numbers().tolist() == numbers.tolist()
    assert [coded.select(i) for i in range(len(numbers))] == numbers.tolist()


def test_a_hundred_thousand_words_are_merged_once():
    encoder, merged = token_files.Encoder(BYTES), []
    make = encoder.words.make
    encoder.words.make = lambda word: merged.append(word) or make(word)
    texts = [" ".join(f"w{k}" for k in range(a, a + 1000)) for a in range(0, 100_000, 1000)]
    assert [encoder(t) for t in texts] == [encoder(t) for t in texts]
    assert len(merged) <= 100_100, len(merged)
    for text in ("'tis A1 b2\n c\t d", texts[7], "é1 x_y  z- 'll", "a"):
        assert np.frombuffer(encoder(text), "<u4").tolist() == encoder.library.encode(text, add_special_tokens=False).ids


@given(st.one_of(ODD, st.lists(st.sampled_from(["<|endoftext|>", "x", " ", " y1", "é"]), max_size=6).map("".join)))
@settings(max_examples=300, deadline=None)
def test_encoder_equals_the_library(text):
    """Special strings included: as an untouched library object takes them."""
    encoder, fresh = test_encoder_equals_the_library.pair
    assert np.frombuffer(encoder(text), "<u4").tolist() == fresh.encode(text, add_special_tokens=False).ids


test_encoder_equals_the_library.pair = token_files.Encoder(BYTES, most=20), Tokenizer.from_file(BYTES)


def test_pieces_of_other_texts_are_encoded_once():
    encoder, seen = token_files.Encoder(BYTES, most=50), []
    make = encoder.pieces.make
    encoder.pieces.make = lambda piece: seen.append(piece) or make(piece)
    text = "Слово и 字 дело " * 30 + "я" * 500
    assert encoder(text) == encoder(text) and len(seen) <= 7
    assert encoder(text) == np.array(encoder.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    for k in range(1000):
        encoder(f"п{k} x{k}")
    assert all(len(t) + len(t.before) <= 2 * 53 and max(map(len, t)) <= t.LONGEST for t in (encoder.words, encoder.pieces))


def test_token_files_of_far_apart_ids(spark):
    ids = [None, None, -(1 << 63), -5, 0, 7, 7, (1 << 62) + 9, (1 << 63) - 1]
    files = token_files.write(documents(spark, [(i, "a") for i in ids]), BYTES, ranges=1)
    assert [r.doc_id for r in sorted(token_files.read_back(files).collect(), key=lambda r: r.start)] == ids


@pytest.mark.parametrize("ranges, block_ids", [(1, 1 << 18), (4, 50)])
def test_token_files(spark, hard, empty, ranges, block_ids):
    encoder = token_files.Encoder(BYTES)
    files = token_files.write(hard, BYTES, ranges=ranges, block_ids=block_ids)
    rows = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_back(files).collect())
    assert [r[1] for r in rows] == [None, 1, 2, 3, 4, 5, 6, 6, 7, 8, 9, 10, 11]
    texts, at = dict(HARD), 0
    for start, doc_id, n, crc in rows:
        ids = encoder(texts[doc_id] or "") + (2).to_bytes(4, "little")
        assert (start, n, crc) == (at, len(ids) // 4, zlib.crc32(ids))
        at += n
    assert files.count() >= ranges and {r.id_bytes for r in files.collect()} == {2}
    none = token_files.write(empty, BYTES)
    assert token_files.read_back(none).count() == 0


# --- personal data -------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if good:
                found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_luhn():
    assert pii.luhn("4242424242424242") and not pii.luhn("4242424242424241")


@given(st.text(st.sampled_from("0123456789" * 2 + "ab@@.. -+()%,"), max_size=40))
@settings(max_examples=600, deadline=None)
def test_base_spans(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_pii(spark, hard, empty):
    card, phone = "4242424242424242", "+1 (212) 555-0199"
    known = [(k, f"call {phone} or pay {card} by {k}@mail{k}.example.com from 10.0.{k}.7 on day {k} of {k + 30}") for k in range(40)]
    repeated = [(100, f"card {card} then {card} {card} and the phone {phone} again 555-0199 ok"), (101, "nothing of 12 interest 7")]
    docs = documents(spark, known + repeated)
    rows = {r.doc_id: r for r in pii.pii(docs).collect()}
    for doc_id, text in known + repeated:
        base = plain_spans(text)
        assert rows[doc_id].base_sha256 == hashlib.sha256(pii.written_out(base).encode()).hexdigest()
        assert rows[doc_id].n_phone == sum(s[0] == "phone" for s in base)
    more = set(rows[100].spans.split(",")) - set(pii.written_out(plain_spans(repeated[0][1])).split(","))
    found = {repeated[0][1][int(a) : int(b)] for _, a, b in (s.split(":") for s in more)}
    assert f"{card} {card}" in found  # 32 digits are no card, but each half was recognised before
    assert rows[101].n_added == 0 and rows[101].spans == ""
    assert len(pii.pii(hard).collect()) == len(HARD) and pii.pii(empty).count() == 0
    clean = {r.doc_id: r for r in pii.redacted(docs).collect()}
    assert card not in clean[100].text and "[PHONE]" in clean[0].text and clean[0].n_chars == len(clean[0].text)
    assert clean[101].text == repeated[1][1] and pii.redacted(docs).columns == docs.columns
    assert {r.doc_id: r.text for r in pii.redacted(hard).collect()}[1] is None


def test_skip_edges_reach_across_a_document():
    features = 3.0 * np.random.default_rng(0).standard_normal((pii.N_FEATURES, 5)) * 0
    strong = pii.Field(features, np.zeros((5, 5)), 6 * np.eye(5))
    far = "id 555-0199 " + "x " * 500 + "+1 212 555-0199"
    graph = pii.graph_of(far, pii.base_spans(far))
    assert len(graph.skip) == 1
    p = pii.beliefs([graph], strong, pii.Settings())
    assert pii.LABELS[p[0].argmax()] == "phone" and p[0].max() > 0.9


def test_a_number_recognised_once_is_recognised_everywhere():
    neutral = np.zeros((pii.N_FEATURES, 5))
    for weight in (4, 10, 20):
        field = pii.Field(neutral, np.zeros((5, 5)), weight * np.eye(5))
        for known in (0, 150, 299):
            text = " x ".join("+1 212 555-0199" if k == known else "555-0199" for k in range(300))
            graph = pii.graph_of(text, pii.base_spans(text))
            assert len(graph.skip) + len(graph.reach) <= 3 * len(graph.places)
            own = [i for i, (a, b) in enumerate(graph.places) if text[a:b] == "555-0199"]
            p = pii.beliefs([graph], field, pii.Settings())[own, pii.LABELS.index("phone")]
            assert len(own) == 300 and p.min() >= 0.9


def test_messages_pass_until_they_rest_each_document_by_itself():
    neutral = np.zeros((pii.N_FEATURES, 5))
    field = pii.Field(neutral, 12 * np.eye(5), np.zeros((5, 5)))
    n = 200
    long = pii.Graph([(0, 1)] * n, [[0]] * n, [2] + [-1] * (n - 1), [(i, i + 1) for i in range(n - 1)], [])
    short = pii.Graph([(0, 1)] * 3, [[0]] * 3, [-1, -1, 1], [(0, 1), (1, 2)], [])
    alone = pii.beliefs([long], field, pii.Settings())
    assert alone[:, 2].min() >= 0.9
    both = pii.beliefs([short, long, short], field, pii.Settings())
    assert (both[3 : 3 + n] == alone).all() and (both[:3] == both[-3:]).all()
    assert (both[:3] == pii.beliefs([short], field, pii.Settings())).all()
    ring = [(i, (i + 1) % 5) for i in range(5)]
    swings = pii.Field(neutral, -9 * np.eye(5), np.zeros((5, 5)))
    odd = pii.Graph([(0, 1)] * 5, [[0]] * 5, [-1] * 5, [(min(e), max(e)) for e in ring], [])
    assert np.isfinite(pii.beliefs([odd], swings, pii.Settings())).all()


# --- toxicity ------------------------------------------------------------------


def test_toxicity_and_neutral_mentions(spark, empty):
    r, rows = random.Random(1), []
    for k in range(600):
        words = [f"w{r.randrange(80)}" for _ in range(25)]
        toxic = k % 5 == 0
        if toxic:
            words[r.randrange(12)] = r.choice(["grobble", "snarfing"])
        if toxic or k % 16 == 0:
            words[12 + r.randrange(12)] = r.choice(["women", "jews", "muslims"])
        rows.append((k, " ".join(words), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels = documents(spark, [r[:2] for r in rows]), df.selectExpr("doc_id", "toxic", "1 AS text")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    held = {k for k, _, _ in rows if zlib.crc32(str(k).encode()) % 4 == 2}
    assert {k for k, r in got.items() if r.held_out} == held and held
    assert all(got[k].predicted == toxic for k, _, toxic in rows if k in held)
    fair = toxicity.train(docs, labels)
    unfair = toxicity.train(docs, labels, toxicity.Settings(counterfactual=0.0))
    mention = "w1 w2 w3 the women here"
    assert fair.score(mention) < unfair.score(mention) and fair.score(mention) < 0.3
    assert abs(fair.score(mention) - fair.score(mention.replace("women", "jews"))) < 0.02
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, flipped) == fair  # held-out labels are never looked at
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(1 for r in got.values() if not r.predicted)
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(empty, labels).count() == 0


def test_toxicity_of_hard_texts(spark, hard):
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity(hard, labels).collect()
    assert len(rows) == len(HARD) and all(0 <= r.score <= 1 for r in rows)


# --- fingerprints --------------------------------------------------------------


def test_fingerprints(spark, hard, empty):
    rows = HARD + [(20, "Same text. Other line.\nThird."), (21, "Same text. Other line.\nThird.")]
    got = merkle.fingerprints(documents(spark, rows), ranges=3).collect()
    order = sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by_id[20].fingerprint == by_id[21].fingerprint
    for k, (doc_id, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1] if doc_id != 6 else None
        r = by_id[doc_id]
        assert r.n_chars == len(text) and r.fingerprint == merkle.fingerprint(text)
        if following is not None:
            cut = len(text) // 3
            edited = text[: len(text) - cut] + following[:cut]
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert r.near_next == merkle.likeness(r.fingerprint, merkle.fingerprint(following))
    assert by_id[21].near_next == 1.0
    assert merkle.fingerprints(empty).count() == 0
    one = merkle.fingerprints(documents(spark, [(5, "Alone. Here.")])).first()
    assert one.near_next == 1.0


def test_trees_locate_edits():
    text = ". ".join(prose(k, 9) for k in range(400))
    at = len(text) // 2
    edited = text[:at] + " changed words" + text[at:]
    a, b = merkle.fingerprint(text), merkle.fingerprint(edited)
    assert a != b and 0.6 < merkle.likeness(a, b) < 1 and merkle.likeness(a, a) == 1
    (sa, ea, sb, eb), = merkle.edits(text, edited)
    assert sa <= at <= ea and text[:sa] == edited[:sb] and text[ea:] == edited[eb:] and ea - sa < 200
    assert merkle.edits(text, text) == []
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("")) == 1
    assert merkle.likeness(merkle.fingerprint(""), a) == 0
    half = text[: len(text) // 2]
    assert 0.4 < merkle.likeness(a, merkle.fingerprint(half)) < 0.55


# --- licences ------------------------------------------------------------------


def test_matching_statistics():
    r = random.Random(0)
    for _ in range(400):
        sequences = [[r.choice("abcd") for _ in range(r.randrange(1, 9))] for _ in range(r.randrange(1, 4))]
        words = [r.choice("abcde") for _ in range(r.randrange(0, 14))]
        occurs = lambda sub: any(s[j : j + len(sub)] == sub for s in sequences for j in range(len(s)))
        longest = [max((n for n in range(1, i + 2) if occurs(words[i - n + 1 : i + 1])), default=0) for i in range(len(words))]
        want = [
            (i - n + 1, n) for i, n in enumerate(longest) if n >= 2 and (i + 1 == len(words) or longest[i + 1] != n + 1)
        ]
        got = licenses.SuffixAutomaton(sequences).anchors(words, 2)
        assert [g[:2] for g in got] == want
        for first, n, ends in got:
            for k, end in ends.items():
                assert sequences[k][end - n + 1 : end + 1] == words[first : first + n]


def test_license_scan(spark, hard, empty):
    mit = licenses.TEMPLATES["mit"]
    changed = mit.replace("without restriction", "with no limits").replace("persons", "people")
    rows = [
        (50, "MIT License\nmit license, the Apache License."), (51, f"intro words {changed} outro"), (52, "license mit"),
        (53, "Licensed under CC BY-NC 4.0."), (54, "x general public  license"), (55, "the quick brown fox of the hills"),
    ]
    got = {r.doc_id: r for r in licenses.license_scan(documents(spark, rows)).collect()}
    assert (got[50].n_base, got[50].first_word, got[50].last_word, got[50].base_labels) == (3, 0, 5, "apache,mit")
    assert got[51].labels == "mit" and got[51].n_base == 0 and 0.8 < got[51].score < 1
    name, a, b = got[51].spans.split(":")
    assert (name, int(a)) == ("mit", 2) and int(b) == got[51].n_words - 1
    assert (got[52].n_base, got[52].labels, got[52].first_word, got[52].score) == (0, "", None, 0.0)
    assert got[53].labels == "cc" and got[54].base_labels == "gpl" and got[55].labels == ""
    by_id = {r.doc_id: r for r in licenses.license_scan(hard).collect()}
    assert by_id[1].n_words == 0 and by_id[9].n_words == 20_000
    assert licenses.license_scan(empty).count() == 0
