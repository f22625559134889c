"""Toxicity scores from a counterfactually regularised linear classifier.

Features of a text are its lower-case words and their beginnings (four to six
letters), present or absent. Features tied to the toxic label are selected on
counts over the training rows, then a logistic regression is fitted. For each
labelled text that mentions a group ("identity term"), copies with that term
swapped for the others, and with none, are built, and the squared change of the
score's logit is part of the loss: what group is mentioned must not matter.

Defined cases: null and empty texts have no feature and get the base score; without
training rows every score is 0; repeated rows get a score each; null ids are never
training rows; columns other than doc_id, text and toxic are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmill.llm.common import give_back, held_out, map_rows, sampled_ids, slices, texts

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)

#: Words that name groups, in the languages of the corpus.
IDENTITY_TERMS = (
    "women", "men", "girls", "boys", "gay", "lesbian", "straight", "transgender", "muslims", "christians",
    "jews", "hindus", "buddhists", "atheists", "immigrants", "refugees", "blacks", "whites", "asians", "latinos",
    "africans", "europeans", "americans", "arabs", "disabled", "deaf", "blind", "elderly", "young",
    "frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge",
    "femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés",
    "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados",
)


@dataclass(frozen=True)
class Settings:
    """max_train bounds the labelled rows that the fit uses."""

    max_train: int = 16_000
    max_features: int = 4_096
    min_rows: int = 4
    min_z: float = 5.0
    l2: float = 2e-5
    counterfactual: float = 1.0
    steps: int = 600
    identity_terms: tuple[str, ...] = IDENTITY_TERMS


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, text: str) -> float:
        z = self.bias + sum(self.weights[f] for f in self.present(words_of(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) if self.bias > -math.inf else 0.0

    def present(self, words: set[str]) -> set[str]:
        found = words & self.weights.keys()
        for n in BEGINNINGS:
            found |= {f"{w[:n]}*" for w in words} & self.weights.keys()
        return found


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def features(words: set[str]) -> set[str]:
    """A word, and ``abcd*`` for its beginning ``abcd``."""
    return words.union(*({f"{w[:n]}*" for w in words if len(w) >= n} for n in BEGINNINGS))


def swaps(words: set[str], terms: frozenset[str]) -> Iterator[set[str]]:
    """The words with each term they hold swapped for every other one and for none."""
    for own in words & terms:
        yield words - {own}
        for other in terms - {own}:
            yield words - {own} | {other}


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fits on rows that are not held out, at most ``settings.max_train`` of them."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out())
    ids = sampled_ids(known, settings.max_train)
    per_id = known.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # one row an id, however often an id is repeated
    rows = texts(docs).join(F.broadcast(per_id), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that have a feature, by label: summed within the task first."""
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush():
            keys = list(seen[0].keys() | seen[1].keys())
            out = [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in seen)]
            seen[0].clear(), seen[1].clear()
            return pa.RecordBatch.from_arrays(out, names=["feature", "clean", "toxic"])

        for batch in batches:
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                seen[toxic > 0].update(features(words_of(text)))
                seen[toxic > 0][""] += 1
                if len(seen[0]) + len(seen[1]) > 400_000:
                    yield flush()
        yield flush()

    counts = (
        rows.mapInArrow(count, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("clean") + F.col("toxic") >= settings.min_rows)
    )
    total = counts.where("feature = ''").first()
    if total is None or not total.toxic:
        return Model(-math.inf)
    n1, n0 = total.toxic, total.clean
    share = (F.col("clean") + F.col("toxic")) / (n1 + n0)
    z = (F.col("toxic") - n1 * share) / F.sqrt(n1 * share * (1 - share) + 1e-9)
    chosen = (
        counts.where("feature != ''").withColumn("z", z).where(F.col("z") >= settings.min_z)
        .orderBy(F.desc("z"), "feature").limit(settings.max_features).collect()
    )
    names = sorted({r.feature for r in chosen} | features(set(settings.identity_terms)))
    place = {f: i for i, f in enumerate(names)}
    terms = frozenset(settings.identity_terms)

    def make():
        index = Model(0.0, dict.fromkeys(names, 0.0))

        def fn(text, toxic):
            own = [words_of(t) for t in text]
            hits = [sorted(place[f] for f in index.present(w)) for w in own]
            other = [[sorted(place[f] for f in index.present(s)) for s in swaps(w, terms)] for w in own]
            return {"toxic": [int(t > 0) for t in toxic], "hits": hits, "other": other}

        return fn

    fitted = map_rows(rows, make, "toxic int, hits array<int>, other array<array<int>>").collect()
    return fit(names, [(r.toxic, r.hits, r.other) for r in fitted], settings)


def fit(names: list[str], rows: list[tuple[int, list[int], list[list[int]]]], settings: Settings) -> Model:
    """Logistic loss + l2 + counterfactual * mean squared change of the logit, by Adam."""
    y = np.array([r[0] for r in rows], float)
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    col = np.array([i for r in rows for i in r[1]], int)
    pairs = [(r[1], o) for r in rows for o in r[2]]
    sign = np.array([s for a, b in pairs for s in [1.0] * len(a) + [-1.0] * len(b)])
    pair_row = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs])
    pair_col = np.array([i for a, b in pairs for i in (*a, *b)], int)
    base = (y.sum() + 0.5) / (len(y) + 1)
    w, b = np.zeros(len(names)), math.log(base / (1 - base))
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, settings.steps + 1):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, w[col], len(y)), -30, 30)))
        g = np.bincount(col, (p - y)[row], len(names)) / len(y) + settings.l2 * w
        if pairs:
            change = np.bincount(pair_row, sign * w[pair_col], len(pairs))
            g += 2 * settings.counterfactual / len(pairs) * np.bincount(pair_col, sign * change[pair_row], len(names))
        g = np.append(g, (p - y).mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return Model(float(b), {f: float(x) for f, x in zip(names, w) if abs(x) > 1e-6})


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""

    def make():
        return lambda ids, text: {"doc_id": ids, "score": [model.score(t) for t in text]}

    out = map_rows(texts(docs), make, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3) -> DataFrame:
    return score(docs, train(docs, labels, settings), threshold)


def keep_clean(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3) -> DataFrame:
    """The documents, whole and unchanged, that score below the threshold."""
    model = train(docs, labels, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            text = part.column(part.schema.get_field_index("text")).to_pylist()
            yield part.filter(pa.array([model.score(t or "") < threshold for t in text], pa.bool_()))
        give_back()

    return docs.mapInArrow(run, docs.schema)
