"""Each stage of the pipeline on what the one before it kept, against plain restatements."""

import random

import corpus_pipeline
import pytest
from sentencepiece import SentencePieceProcessor

from retailmill.llm import pii, toxicity
from test_joins import brute_components, changed, plain_hits
from texts import prose

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with every case: clean, toxic, copies, near copies, leaks, personal data, nulls, repeats."""
    root, r = tmp_path_factory.mktemp("corpus"), random.Random(11)
    items = [(k, prose(("item", k), 18, 3000)) for k in range(3)]
    base = [prose(("doc", k), r.randrange(20, 90), 3000) for k in range(30)]
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(100 + k, base[k]) for k in range(5)] + [(110 + k, changed(base[k] + " " + base[k + 1], r, 1)) for k in range(3)]
    rows += [(120 + k, base[k] + " " + base[k + 1]) for k in range(3)]
    rows += [(200 + k, f"{base[k]} {items[k % 3][1]} end") for k in range(4)]
    rows += [(300 + k, f"write to a{k}@b{k}.example or call +49 30 123456{k}0 {prose(('pii', k), 40, 3000)}") for k in range(4)]
    rows += [(400 + k, f"vile filth scum {prose(('toxic', k), 12, 3000)}") for k in range(20)]
    rows += [(600 + k, prose(("clean", k), 14, 3000)) for k in range(120)]
    rows += [(None, base[7]), (None, None), (500, None), (501, ""), (502, "few words"), (7, base[7]), (7, base[7])]
    rows = [(i, t, "en", "web", len(t) if t else None) for i, t in rows]
    labels = [(i, 1, int(400 <= i < 420)) for i, *_ in rows if i is not None and (i < 30 or 400 <= i < 420 or i >= 600)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), items


def test_every_stage(spark, tables):
    root, items = tables
    docs = spark.read.parquet(f"{root}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(x) for x in docs.collect()]
        docs = corpus_pipeline.written(stage(spark, docs, root), f"test-{name}")
        kept[name] = (before, docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    before, after = kept["toxicity"]
    model = toxicity.train(spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet"))
    assert sorted(map(tuple, after), key=str) == sorted((x for x in before if model.score(x[1] or "") < 0.3), key=str)
    gone = {x[0] for x in before} - {x.doc_id for x in after}
    assert gone == set(range(400, 420))

    before, after = kept["near_duplicates"]
    groups = {}
    for doc_id, n, name in brute_components([x[:2] for x in before]):
        if n:
            groups.setdefault(name, set()).add(doc_id)
    left = [x.doc_id for x in after if x.text and x.doc_id is not None]
    assert sorted(left) == sorted(groups) and all(x in before for x in map(tuple, after))
    assert sum(not x.text for x in after) == sum(not x[1] for x in before)  # rows without words stay

    before, after = kept["decontamination"]
    leaked = {h[0] for h in plain_hits([x[:2] for x in before], items)}
    assert {200, 202} <= leaked <= {200, 201, 202, 203} and sorted(map(tuple, after), key=str) == sorted((x for x in before if x[0] not in leaked), key=str)

    before, after = kept["personal_data"]
    texts = {x.doc_id: x for x in after}
    assert len(after) == len(before)
    for doc_id, text, *_ in before:
        now = texts[doc_id].text
        spans = pii.base_spans(text or "")
        assert (now is None) == (text is None) and (spans != [] or now == text)
        assert now is None or texts[doc_id].n_chars == len(now)
        assert all(text[a:b] not in now for _, a, b in spans)
    assert sum("[EMAIL]" in (x.text or "") and "[PHONE]" in x.text for x in after) == 4

    before, after = kept["sentencepiece"]
    library = SentencePieceProcessor(model_file=corpus_pipeline.PIECES)
    want = sorted(((i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t, *_ in before), key=str)
    assert sorted(((x.doc_id, x.ids, x.decoded) for x in after), key=str) == want
    assert sorted(((x.doc_id, x.ids, x.decoded) for x in corpus_pipeline.run(spark, root).collect()), key=str) == want
