"""Hard negatives by angular triangle filtering.

Vectors become integers, so that scores are exact. Every row stores its angles to a few
reference directions and its norm. By the triangle inequality for angles, a row x and a
query a are at least |angle(x, r) - angle(a, r)| and at most angle(x, r) + angle(a, r) apart
for each reference r; cosine and norms turn that into bounds of the score, rounded to the
safe side. Rows are dealt into *columns* by nearest reference and angle; in a column, rows of
a label that lie next to each other by angle form *windows*, which keep the least and
greatest angles and norms of their rows. A query is scored, in integers, against the windows
only whose bounds overlap the scores it still wants.

Both searches, for positives and for negatives, go the same way: first each query meets
its own column, whose k-th best score raises the least score it wants; then all columns
whose bounds still allow that. What each leaves is at most k rows a query and column.

A query is a row to be searched for, met with all rows in blocks: queries are split into
parts, (part, column) pairs are thinned by the bounds of both, and a pair is one piece of
work in a task that holds one column. Columns are cut at quantiles of a key that tells equal
rows apart, so a hot label, cluster or vector spreads over many of them. How much the
bounds save depends on the data: on directions without any clusters little, whence the
first pass through the own column.

Defined cases: rows with a null label or vector, or a null or non-finite component, take no
part, nor do rows with a component of 2^28 or more after scaling, whose scores would not
fit 64 bits; shorter vectors end in zeros; zero vectors score 0; positives with a negative
score have no negatives, as their window is empty; repeated rows are rows of their own, also as anchors and as
each other's positives; a null vec_id is no anchor and comes last among ties; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from retailmill.llm.common import written


@dataclass(frozen=True)
class Settings:
    scale: int = 256
    anchor_every: int = 100
    relabel_every: int = 7
    labels: int = 10
    positives: int = 5
    negatives: int = 10
    #: wanted negatives: from least to most percent of the positive's score
    least_percent: int = 30
    most_percent: int = 90
    references: int = 12
    #: rows that the references are fitted on; every row is searched
    reference_sample: int = 4_096
    column_rows: int = 8_192
    part_queries: int = 256
    window_rows: int = 128
    #: query parts that a task of one column gets
    parts_a_task: int = 64


#: Slack that covers every rounding of stored angles and of cosines.
ANGLE_SLACK = 1e-5
LOWEST = -(1 << 62)
LARGEST = float(1 << 28)


# --- rows -----------------------------------------------------------------------


def integer_rows(embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """row, vec_id, label, x (integers) of the rows that take part."""
    kept = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: F.coalesce(F.abs(c) < F.lit(LARGEST / settings.scale), F.lit(False)))
    kept = kept.where(F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    shifted = F.col("vec_id").isNotNull() & (F.col("vec_id") % settings.relabel_every == 0)
    label = F.col("label").cast("long")
    label = F.when(shifted, (label + 1) % settings.labels).otherwise(label)
    x = F.transform("v", lambda c: F.floor(c * F.lit(float(settings.scale))).cast("int"))
    return kept.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", label.alias("label"), x.alias("x")
    )


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def references(rows: DataFrame, dim: int, settings: Settings) -> np.ndarray:
    """Directions far apart from each other: farthest-first on a bounded sample that hashes
    choose, each then moved to the mean of the sample's rows nearest to it."""
    sample = rows.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(settings.reference_sample).collect()
    x = unit(np.array([list(r.x) + [0] * (dim - len(r.x)) for r in sample], float).reshape(len(sample), dim))
    x = x[np.abs(x).sum(1) > 0]
    if not len(x):
        return np.zeros((0, dim))
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(settings.references, len(x)):
        far = int(nearest.argmin())
        if nearest[far] > 1 - 1e-9:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, x @ x[far])
    r = x[chosen]
    for _ in range(5):
        own = (x @ r.T).argmax(1)
        sums = np.stack([x[own == k].sum(0) for k in range(len(r))])
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        r = np.where(length > 1e-9, sums / np.where(length > 1e-9, length, 1), r)
    return r


def _matrix(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    """Rows of a binary column as a matrix; all cells have the same length."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype).reshape(-1, width) if width else np.zeros((len(column), 0), dtype)


def profiles(rows: DataFrame, refs: np.ndarray, dim: int) -> DataFrame:
    """row, vec_id, label, x (binary, 32 bits a component), angles (binary floats), norm, key
    (nearest reference and angle, equal rows told apart)."""
    schema = "row long, vec_id long, label long, x binary, angles binary, norm double, key double"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2_048):
                batch = whole.slice(at, 2_048)
                x = np.zeros((batch.num_rows, dim), "<i4")
                for i, own in enumerate(batch.column(3).to_pylist()):
                    x[i, : len(own)] = own
                norm = np.linalg.norm(x.astype(float), axis=1)
                angles = np.arccos(np.clip(unit(x.astype(float)) @ refs.T, -1, 1)).astype("<f4")
                nearest = angles.argmin(1) if len(refs) else np.zeros(len(x), int)
                own = angles[np.arange(len(x)), nearest] if len(refs) else np.zeros(len(x))
                row = batch.column(0).to_numpy().astype(np.uint64)
                spread = (row * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)) / 2.0**53
                cells = (
                    *batch.columns[:3], pa.array([r.tobytes() for r in x], pa.binary()),
                    pa.array([r.tobytes() for r in angles], pa.binary()), pa.array(norm),
                    pa.array(4.0 * nearest + own + 1e-6 * spread),
                )
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cells, arrow)], schema=arrow)

    return rows.select("row", "vec_id", "label", "x").mapInArrow(run, schema)


def _cuts(df: DataFrame, size: int) -> list[float]:
    """Where to cut the key into parts of about ``size`` rows; one number a part."""
    parts = max(1, -(-df.count() // size))
    if parts == 1:
        return []
    shares = [k / parts for k in range(1, parts)]
    return sorted(set(df.agg(F.percentile_approx("key", shares, 100 * parts)).first()[0] or []))


def _placed(df: DataFrame, name: str, cuts: list[float]) -> DataFrame:
    """Adds how many cuts are not above the row's key."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.searchsorted(cuts, batch.column("key").to_numpy(), side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema)


# --- bounds ---------------------------------------------------------------------


def _angles_between(low_a, high_a, low_b, high_b) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest angle between members of two groups whose angles to the references
    lie in [low, high]; references are the last axis."""
    if low_a.shape[-1] == 0:
        shape = np.broadcast_shapes(low_a.shape[:-1], low_b.shape[:-1])
        return np.zeros(shape), np.full(shape, np.pi)
    least = np.maximum(low_a - high_b, low_b - high_a).max(-1)
    most = np.minimum(high_a + high_b, 2 * np.pi - (low_a + low_b)).min(-1)
    return np.clip(least - ANGLE_SLACK, 0, np.pi), np.clip(most + ANGLE_SLACK, 0, np.pi)


def score_bounds(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score between groups, which hold low and high (angles) and short and
    long (norms); safe against rounding."""
    near, far = _angles_between(a["low"], a["high"], b["low"], b["high"])
    best, worst = np.cos(near), np.cos(far)
    short, long = a["short"] * b["short"], a["long"] * b["long"]
    high = np.where(best >= 0, best * long, best * short)
    low = np.where(worst >= 0, worst * short, worst * long)
    slack = 1 + 1e-9 * long
    return low - slack, high + slack


# --- one column -----------------------------------------------------------------


class Windows:
    """The rows of a column, in windows of one label that are neighbours by angle."""

    def __init__(self, row, vec_id, known, label, x, angles, norm, window: int):
        order = np.lexsort((angles[np.arange(len(row)), angles.argmin(1)] if angles.shape[1] else norm, label))
        self.row, self.vec_id, self.known = row[order], vec_id[order], known[order]
        self.label, self.x = label[order], x[order].astype(float)
        self.largest = np.abs(self.x).max(initial=0)
        angles, norm = angles[order].astype(float), norm[order]
        ends = np.flatnonzero(np.diff(self.label)) + 1
        bounds = np.concatenate([[0], ends, [len(row)]])
        self.starts = np.concatenate([np.arange(a, b, window) for a, b in zip(bounds[:-1], bounds[1:])])
        self.stops = np.concatenate([self.starts[1:], [len(row)]])
        least, most = (
            [f.reduceat(v, self.starts, axis=0) for v in (angles, norm)] for f in (np.minimum, np.maximum)
        )
        self.group = {"low": least[0], "high": most[0], "short": least[1], "long": most[1]}
        self.window_label = self.label[self.starts]

    def search(self, q: dict[str, np.ndarray], k: int, same: bool):
        """(query, row) places and scores of at most k rows a query: the best ones that it wants."""
        n = len(q["row"])
        each = {"low": q["angles"], "high": q["angles"], "short": q["norm"], "long": q["norm"]}
        low, high = score_bounds(
            {key: v[:, None] for key, v in each.items()}, {key: v[None] for key, v in self.group.items()}
        )
        alike = q["label"][:, None] == self.window_label[None]
        open_ = (alike == same) & (high >= q["low"][:, None]) & (low <= q["high"][:, None])
        x = q["x"].astype(float)
        exact = np.abs(x).max(initial=0) * self.largest * max(1, x.shape[1]) < 2.0**53
        wanted = q["low"].copy()
        best = np.full((n, k), LOWEST)
        found: list[tuple] = []
        for w in np.argsort(-np.where(open_, high, -np.inf).max(0, initial=-np.inf), kind="stable").tolist():
            own = np.flatnonzero(open_[:, w] & (high[:, w] >= wanted))
            if not len(own):
                continue
            at = slice(self.starts[w], self.stops[w])
            if exact:
                score = (x[own] @ self.x[at].T).astype(np.int64)
            else:
                score = q["x"][own].astype(np.int64) @ self.x[at].T.astype(np.int64)
            fits = (score >= wanted[own][:, None]) & (score <= q["high"][own][:, None])
            fits &= self.row[at][None] != q["row"][own][:, None]
            i, j = np.nonzero(fits)
            if len(i):
                found.append((own[i], j + self.starts[w], score[i, j]))
                both = np.concatenate([best[own], np.where(fits, score, LOWEST)], 1)
                best[own] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
                wanted[own] = np.maximum(wanted[own], best[own].min(1))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        i, j, score = (np.concatenate(f) for f in zip(*found))
        order = np.lexsort((self.vec_id[j], ~self.known[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        first = np.searchsorted(i, np.arange(n))
        keep = np.arange(len(i)) - first[i] < k
        return i[keep], j[keep], score[keep]


STREAM = (
    "col int, task int, kind int, part int, q long, row long, vec_id long, label long, x binary, angles binary, "
    "norm double, low long, high long"
)
FOUND = "q long, found_row long, found_id long, score long"


def _search(work: DataFrame, k: int, same: bool, dim: int, n_refs: int, settings: Settings) -> DataFrame:
    """At most k rows a query and column from a stream that holds, for each column and task,
    first the column's rows (kind 0), then the queries part by part (kind 1)."""
    arrow = to_arrow_schema(T.StructType.fromDDL(FOUND))
    work = work.repartition("col", "task").sortWithinPartitions("col", "task", "kind", "part", "q", "row")

    def arrays(t: pa.Table) -> dict[str, np.ndarray]:
        out = {name: t.column(name).to_numpy() for name in ("q", "row", "label", "norm", "low", "high")}
        ids = t.column("vec_id").combine_chunks()
        out["known"] = ids.is_valid().to_numpy(zero_copy_only=False)
        out["vec_id"] = ids.fill_null(0).to_numpy()
        out["x"] = _matrix(t.column("x"), "<i4", dim)
        out["angles"] = _matrix(t.column("angles"), "<f4", n_refs).astype(float)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column, column_key, held, held_key = None, None, [], None

        def finished():
            nonlocal column, column_key
            a = arrays(pa.Table.from_batches(held))
            if held_key[2] == 0:
                column_key = held_key[:2]
                column = Windows(a["row"], a["vec_id"], a["known"], a["label"], a["x"], a["angles"], a["norm"], settings.window_rows)
                return
            if column_key != held_key[:2]:
                raise ValueError(f"queries before the rows of column {held_key[0]}")
            for at in range(0, len(a["q"]), settings.part_queries):
                some = {name: v[at : at + settings.part_queries] for name, v in a.items()}
                i, j, score = column.search(some, k, same)
                ids = pa.array(column.vec_id[j], pa.int64(), mask=~column.known[j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some["q"][i]), pa.array(column.row[j]), ids, pa.array(score)], schema=arrow
                )

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(4)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                key = tuple(keys[:, a].tolist())
                if held and key != held_key:
                    yield from finished()
                    held = []
                held_key = key
                held.append(batch.slice(a, b - a))
        if held:
            yield from finished()

    return work.mapInArrow(run, FOUND)


# --- the whole search -------------------------------------------------------------


class Index:
    """Profiled rows in columns, with a directory of the columns' bounds."""

    def __init__(self, embeddings: DataFrame, settings: Settings = Settings()):
        self.settings = settings
        rows = written(integer_rows(embeddings, settings), "vectors")
        self.dim = rows.agg(F.max(F.size("x"))).first()[0] or 0
        refs = references(rows, self.dim, settings)
        self.n_refs = len(refs)
        profiled = written(profiles(rows, refs, self.dim), "profiles")
        self.cuts = _cuts(profiled, settings.column_rows)
        self.rows = written(_placed(profiled, "col", self.cuts), "columns")
        self.directory = written(self._bounds(self.rows, ["col"]), "directory")

    def _bounds(self, df: DataFrame, by: list[str]) -> DataFrame:
        """Least and greatest angles and norms of groups, by partial aggregation in Arrow."""
        n, names = self.n_refs, ["short", "long", *(f"l{k}" for k in range(self.n_refs)), *(f"h{k}" for k in range(self.n_refs))]
        schema = ", ".join([*(f"{b} int" for b in by), *(f"{c} double" for c in names)])
        arrow = to_arrow_schema(T.StructType.fromDDL(schema))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                angles = _matrix(batch.column(len(by) + 1), "<f4", n).astype(float)
                norm = batch.column(len(by)).to_numpy()
                keys = [batch.column(k) for k in range(len(by))]
                cells = [*keys, pa.array(norm), pa.array(norm), *(pa.array(angles[:, k]) for k in range(n)),
                         *(pa.array(angles[:, k]) for k in range(n))]
                yield pa.RecordBatch.from_arrays(cells, schema=arrow)

        least = [F.min(c).alias(c) for c in names if c == "short" or c[0] == "l" and c != "long"]
        most = [F.max(c).alias(c) for c in names if c == "long" or c[0] == "h"]
        return df.select(*by, "norm", "angles").mapInArrow(run, schema).groupBy(*by).agg(*least, *most)

    def _pairs(self, queries: DataFrame) -> DataFrame:
        """(part, col) whose bounds allow a score that some query of the part wants."""
        wants = queries.groupBy("part").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        parts = self._bounds(queries, ["part"]).join(wants, "part")
        n, n_columns = self.n_refs, len(self.cuts) + 1
        renamed = parts.select("part", "low", "high", *[F.col(c).alias(f"q_{c}") for c in parts.columns if c not in ("part", "low", "high")])
        met = renamed.withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(n_columns - 1)))).join(self.directory, "col")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                def group(prefix: str) -> dict[str, np.ndarray]:
                    column = lambda c: batch.column(f"{prefix}{c}").to_numpy()
                    sides = {s: np.stack([column(f"{s[0]}{k}") for k in range(n)], 1) if n else np.zeros((batch.num_rows, 0)) for s in ("low", "high")}
                    return {**sides, "short": column("short"), "long": column("long")}

                low, high = score_bounds(group("q_"), group(""))
                keep = (high >= batch.column("low").to_numpy()) & (low <= batch.column("high").to_numpy())
                yield batch.select(["part", "col"]).filter(pa.array(keep))

        return met.mapInArrow(run, "part int, col int")

    def _work(self, queries: DataFrame, pairs: DataFrame) -> DataFrame:
        """The stream that :func:`_search` reads."""
        a_task = self.settings.parts_a_task
        names = [c.split()[0] for c in STREAM.split(", ")]
        asked = queries.drop("col").join(pairs, "part").withColumns(
            {"task": (F.col("part") / a_task).cast("int"), "kind": F.lit(1)}
        )
        used = pairs.select("col", (F.col("part") / a_task).cast("int").alias("task")).distinct()
        stored = self.rows.join(used, "col").withColumns(
            {"kind": F.lit(0), "part": F.lit(0), "q": F.lit(0).cast("long"), "low": F.lit(0).cast("long"), "high": F.lit(0).cast("long")}
        )
        return stored.select(*names).unionByName(asked.select(*names))

    def search(self, queries: DataFrame, k: int, same: bool, purpose: str) -> DataFrame:
        """The best k wanted rows of every query (q, row, vec_id, label, x, angles, norm, key, col,
        low, high): q, found_row, found_id, score, rank. ``same``: rows of the query's own
        label, else of other ones; never the query's own row."""
        s = self.settings
        args = (k, same, self.dim, self.n_refs, s)
        asked = written(_placed(queries, "part", _cuts(queries, s.part_queries)), f"{purpose}-queries")
        own = asked.withColumn("part", F.col("col"))
        first = _search(self._work(own, own.select("part", "col").distinct()), *args)
        best = first.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
        raised = asked.join(best, "q", "left").withColumn("low", F.greatest("low", F.coalesce("kth", F.lit(LOWEST))))
        raised = written(raised.drop("n", "kth"), f"{purpose}-raised")
        pairs = written(self._pairs(raised), f"{purpose}-pairs")
        found = _search(self._work(raised, pairs), *args)
        order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("found_id"), "found_row")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    s, index = settings, Index(embeddings, settings)
    anchors = index.rows.where(F.col("vec_id") % s.anchor_every == 0).withColumns(
        {"q": F.col("row"), "low": F.lit(LOWEST), "high": F.lit(-LOWEST)}
    )
    positives = index.search(anchors, s.positives, True, "positives").select(
        F.col("q").alias("anchor_row"), F.col("found_row").alias("positive_row"), F.col("found_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    positives = written(positives.withColumn("q", F.monotonically_increasing_id()), "positives")
    # whole numbers between least and most percent of the score
    wide = F.col("positive_score").cast("decimal(30,0)")
    low, high = F.ceil(wide * s.least_percent / 100), F.floor(wide * s.most_percent / 100)
    asked = positives.where("positive_score >= 0").select(
        "q", "anchor_row", low.cast("long").alias("low"), high.cast("long").alias("high")
    )
    queries = asked.join(index.rows, asked["anchor_row"] == index.rows["row"]).drop("anchor_row")
    found = index.search(queries, s.negatives, False, "negatives").select(
        "q", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named = positives.join(index.rows.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id")), "anchor_row")
    return named.join(found, "q").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
