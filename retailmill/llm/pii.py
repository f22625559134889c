"""Personal data by patterns and a skip-chain conditional random field.

Base spans come from fixed patterns. The field's nodes are the blank-separated tokens
that hold a digit or an at sign. Chain edges join neighbouring tokens. Tokens that are
equal (case aside) or have the same seven or more digits are mentions of one thing, at
any distance: skip edges join each to the last one before it, further ones to the first
and to the nearest other one in a base span. Tokens in a base span are evidence; the labels of the
others follow by loopy sum-product message passing until no message of the document
changes any more, so that a number recognised once is recognised wherever it turns up
again in the document. Runs of tokens labelled
alike with enough belief become further spans; base spans stay as they are.

Potentials (token features x label, label x label for either edge) are fitted by
pseudo-likelihood on base labels of a bounded sample of documents; the further edges,
which depend on these labels, take no part in it and have the potentials of skip edges.

Defined cases: null and empty texts have no span; repeated rows get a row each; other
columns are not read. Edges are linear in a text's length; the rounds of message passing
are as many as its field needs. Fields that have not settled when messages had time to
go from end to end several times, because they swing, are damped ever more.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from dataclasses import field as dataclass_field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmill.llm.common import give_back, map_rows, sampled_ids, slices, texts

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
Span = tuple[str, int, int]

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TOKEN = re.compile(r"\S+")
OF_INTEREST = re.compile(r"[0-9@]")
AROUND = ".,;:!?()[]{}<>\"'#*&$%|="
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(d * 2 - 9 * (d > 4) for d in map(int, even))) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Found from each at sign, so that texts without one cost nothing."""
    free = 0
    at = text.find("@")
    while at >= 0:
        head = text[free:at]
        begin = free + len(head.rstrip(LOCAL))
        end = DOMAIN.match(text, at + 1) if begin < at else None
        if end:
            yield begin, end.end()
        free = max(at + 1, end.end() if end else 0)
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """By start, then kind."""
    found = [("email", a, b) for a, b in emails(text)]
    if OF_INTEREST.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


@dataclass(frozen=True)
class Settings:
    """max_train bounds the documents of the fit, max_nodes the tokens of each."""

    max_train: int = 6_000
    max_nodes: int = 64
    steps: int = 300
    l2: float = 1e-3
    tolerance: float = 1e-4
    damping: float = 0.5
    belief: float = 0.9


#: What a token's features ask, in order.
N_FEATURES = 17


def token_features(token: str) -> list[int]:
    digits = _NOT_DIGIT.sub("", token)
    n, parts = len(digits), token.split(".")
    asked = (
        True, "@" in token, "@" in token and "." in token.rpartition("@")[2], n == 0, 1 <= n <= 3, 4 <= n <= 6, 7 <= n <= 9, 10 <= n <= 13,
        14 <= n <= 19, n > 19, 14 <= n <= 19 and luhn(digits), len(parts) == 4 and all(p.isdecimal() and p.isascii() and len(p) <= 3 for p in parts),
        token.startswith("+"), "(" in token or ")" in token, "-" in token, any(c.isalpha() for c in token), n == len(token),
    )
    return [i for i, x in enumerate(asked) if x]


@dataclass
class Graph:
    """The field of one document: token places, features, evidence (-1: none), edges:
    of neighbours, to the last mention before, to the first and the nearest known one."""

    places: list[tuple[int, int]]
    features: list[list[int]]
    labels: list[int]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]
    reach: list[tuple[int, int]] = dataclass_field(default_factory=list)


def graph_of(text: str, spans: list[Span], most: int | None = None) -> Graph:
    g = Graph([], [], [], [], [])
    if not OF_INTEREST.search(text):
        return g
    mentions: dict[str, list[int]] = {}
    before, first = -2, 0
    for k, m in enumerate(TOKEN.finditer(text)):
        if not OF_INTEREST.search(m[0]):
            continue
        if most is not None and len(g.places) >= most:
            break
        core = m[0].strip(AROUND.replace("(", "").replace(")", ""))
        a = m.start() + m[0].index(core)
        b = a + len(core)
        i = len(g.places)
        while first < len(spans) and max(s[2] for s in spans[first : first + 1]) <= a:
            first += 1
        label = -1
        for s in spans[first:]:
            if s[1] >= b:
                break
            if s[2] > a:
                label = LABELS.index(s[0])
                break
        g.places.append((a, b))
        g.features.append(token_features(core))
        g.labels.append(label)
        if k == before + 1:
            g.chain.append((i - 1, i))
        before = k
        digits = _NOT_DIGIT.sub("", core)
        for key in {core.lower(), digits if len(digits) >= 7 else core.lower()}:
            mentions.setdefault(key, []).append(i)
    g.skip = sorted({edge for alike in mentions.values() for edge in zip(alike, alike[1:])})
    further = {edge for alike in mentions.values() for edge in further_edges(alike, g.labels)}
    g.reach = sorted(further.difference(g.skip))
    return g


def further_edges(alike: list[int], labels: list[int]) -> Iterator[tuple[int, int]]:
    """For each mention of one thing an edge to the first one, and to the nearest other
    one with evidence (the earlier of two as near)."""
    known = [i for i in alike if labels[i] >= 0]
    n = 0  # how many of the known are before i
    for i in alike:
        if i != alike[0]:
            yield alike[0], i
        after = n + (labels[i] >= 0)
        near = known[max(n - 1, 0) : n] + known[after : after + 1]
        if near:
            j = min(near, key=lambda u: abs(u - i))
            yield min(i, j), max(i, j)
        n = after


@dataclass(frozen=True)
class Field:
    """Log potentials: features x labels, labels x labels (symmetric) for either edge."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def fit(graphs: list[Graph], settings: Settings) -> Field:
    n_labels = len(LABELS)
    sizes = np.cumsum([0, *(len(g.places) for g in graphs)])
    n = int(sizes[-1])
    x = np.zeros((n, N_FEATURES))
    for g, at in zip(graphs, sizes):
        for i, f in enumerate(g.features):
            x[at + i, f] = 1
    y = np.maximum([label for g in graphs for label in g.labels], 0).astype(int)
    onehot = np.eye(n_labels)[y] if n else np.zeros((0, n_labels))
    around = []
    for kind in ("chain", "skip"):
        edges = np.array([(at + u, at + v) for g, at in zip(graphs, sizes) for u, v in getattr(g, kind)], int).reshape(-1, 2)
        sums = np.zeros((n, n_labels))
        np.add.at(sums, edges[:, 0], onehot[edges[:, 1]])
        np.add.at(sums, edges[:, 1], onehot[edges[:, 0]])
        around.append(sums)
    parts = [np.zeros((N_FEATURES, n_labels)), np.zeros((n_labels, n_labels)), np.zeros((n_labels, n_labels))]
    inputs = [x, *around]
    m, v = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, settings.steps + 1 if n else 1):
        z = sum(a @ p for a, p in zip(inputs, parts))
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        error = (p / p.sum(1, keepdims=True) - onehot) / n
        for k, a in enumerate(inputs):
            grad = a.T @ error
            grad = (grad + grad.T) / 2 if k else grad
            grad = grad + settings.l2 * parts[k]
            m[k] = 0.9 * m[k] + 0.1 * grad
            v[k] = 0.999 * v[k] + 0.001 * grad * grad
            parts[k] = parts[k] - 0.05 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-9)
    return Field(*parts)


def train(docs: DataFrame, settings: Settings = Settings()) -> Field:
    ids = F.broadcast(sampled_ids(docs, settings.max_train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            graphs = [graph_of(t, base_spans(t), settings.max_nodes) for t in batch.column(0).to_pylist()]
            graphs = [g for g in graphs if g.places]
            yield pa.RecordBatch.from_pydict(
                {k: [getattr(g, k) for g in graphs] for k in ("features", "labels", "chain", "skip")},
                pa.schema([
                    ("features", pa.list_(pa.list_(pa.int32()))), ("labels", pa.list_(pa.int32())),
                    ("chain", pa.list_(pa.list_(pa.int32()))), ("skip", pa.list_(pa.list_(pa.int32()))),
                ]),
            )

    rows = (
        texts(docs).join(ids, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).select("text")
        .mapInArrow(run, "features array<array<int>>, labels array<int>, chain array<array<int>>, skip array<array<int>>").collect()
    )
    rows = sorted(rows, key=str)  # the fit does not depend on the order of arrival
    return fit([Graph([(0, 0)] * len(r.labels), r.features, r.labels, r.chain, r.skip) for r in rows], settings)


def beliefs(graphs: list[Graph], field: Field, settings: Settings) -> np.ndarray:
    """Label probabilities of all nodes, by loopy sum-product over all graphs at once."""
    n_labels = len(LABELS)
    sizes = np.cumsum([0, *(len(g.places) for g in graphs)])
    n = int(sizes[-1])
    node = np.zeros((n, n_labels))
    for g, at in zip(graphs, sizes):
        for i, f in enumerate(g.features):
            node[at + i] = field.unary[f].sum(0)
    known = np.array([label for g in graphs for label in g.labels], int)
    fixed = known >= 0
    node[fixed] = -50.0
    node[fixed, known[fixed]] = 0.0
    edges = [(at + u, at + v, 0, k) for k, (g, at) in enumerate(zip(graphs, sizes)) for u, v in g.chain]
    edges += [(at + u, at + v, 1, k) for k, (g, at) in enumerate(zip(graphs, sizes)) for u, v in (*g.skip, *g.reach)]
    if edges:
        pass_messages(node, np.array(edges, int), np.stack([field.chain, field.skip]), 100 + 4 * np.diff(sizes), settings)
    p = np.exp(node - node.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def pass_messages(node: np.ndarray, edges: np.ndarray, pair: np.ndarray, patience: np.ndarray, settings: Settings) -> None:
    """Adds to the nodes' log potentials what their edges (node, node, kind, graph) tell
    them at last. Each graph is passed on by itself: it ends when its own messages change
    by no more than the tolerance, whatever else is in the batch. From ``patience[graph]``
    rounds on steps are halved every 50 rounds, so that swinging messages end as well."""
    left = node.copy()
    message = np.zeros((2, len(edges), node.shape[1]))  # to the second node, to the first
    rounds = 0
    ends, used = edges[:, :2], len(edges)
    while len(edges):
        rounds += 1
        if 2 * len(edges) < used:  # go on with the nodes that are still at work
            at, ends = np.unique(edges[:, :2], return_inverse=True)
            left, ends, used = node[at], ends.reshape(-1, 2), len(edges)
        total = left.copy()
        np.add.at(total, ends[:, 1], message[0])
        np.add.at(total, ends[:, 0], message[1])
        out = (total[ends.T] - message[::-1])[..., None] + pair[edges[:, 2]]
        top = out.max(2, keepdims=True)
        new = np.log(np.exp(out - top).sum(2)) + top[:, :, 0]
        new -= new.max(2, keepdims=True)
        graph = edges[:, 3]
        late = np.maximum(rounds - patience, 0)
        step = (1 - settings.damping) * 0.5 ** (late / 50)
        change = step[graph][:, None] * (new - message)
        message = message + change
        largest = np.zeros(len(patience))
        np.maximum.at(largest, graph, np.abs(change).max((0, 2)))
        busy = largest[graph] > settings.tolerance
        if not busy.all():
            np.add.at(node, edges[~busy, 1], message[0, ~busy])
            np.add.at(node, edges[~busy, 0], message[1, ~busy])
            edges, ends, message = edges[busy], ends[busy], message[:, busy]


def all_spans(text: list[str], field: Field, settings: Settings) -> list[tuple[list[Span], list[Span]]]:
    """For each text its base spans and the further ones."""
    base = [base_spans(t) for t in text]
    graphs = [graph_of(t, s) for t, s in zip(text, base)]
    p = beliefs(graphs, field, settings)
    out, at = [], 0
    for g, own, t in zip(graphs, base, text):
        chained = {v for _, v in g.chain}
        more: list[Span] = []
        open_run = None
        for i, (a, b) in enumerate(g.places):
            label = int(p[at + i].argmax())
            if g.labels[i] < 0 and label and p[at + i, label] >= settings.belief and a < b:
                if open_run and i in chained and open_run[0] == label:
                    open_run[2] = b
                    more[-1] = (LABELS[label], open_run[1], b)
                else:
                    open_run = [label, a, b]
                    more.append((LABELS[label], a, b))
            else:
                open_run = None
        at += len(g.places)
        out.append((own, more))
    return out


def written_out(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def find(docs: DataFrame, field: Field, settings: Settings = Settings()) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256, spans, n_added for every row."""

    def make():
        def fn(ids, text):
            found = all_spans(text, field, settings)
            out = {"doc_id": ids}
            for kind in KINDS:
                out[f"n_{kind}"] = [sum(s[0] == kind for s in base) for base, _ in found]
            out["base_sha256"] = [hashlib.sha256(written_out(base).encode()).hexdigest() for base, _ in found]
            out["spans"] = [written_out(base + more) for base, more in found]
            out["n_added"] = [len(more) for _, more in found]
            return out

        return fn

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return map_rows(texts(docs), make, schema)


def pii(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return find(docs, train(docs, settings), settings)


def redact(text: str, spans: list[Span]) -> str:
    """Each span replaced by its kind; of overlapping ones the first counts for all."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if a >= at:
            out += text[at:a], f"[{kind.upper()}]"
        at = max(at, b)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All documents, personal data replaced in text, n_chars set to the new length
    where that column exists; a null text stays null."""
    field, columns, schema = train(docs, settings), docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, n = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None
        for part in slices(batches):
            text = part.column(k).to_pylist()
            found = all_spans([t or "" for t in text], field, settings)
            new = [None if t is None else redact(t, base + more) for t, (base, more) in zip(text, found)]
            cells = list(part.columns)
            cells[k] = pa.array(new, part.schema.field(k).type)
            if n is not None:
                cells[n] = pa.array([None if t is None else len(t) for t in new], part.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(cells, schema=part.schema)
        give_back()

    return docs.mapInArrow(run, schema)
