"""Document fingerprints: Merkle trees over paragraphs and sections.

Leaves are paragraphs, cut at full stops too. A leaf's hash says how high it closes
sections: one in two closes a section of the first level, one in four also one of the
second, and so on; a section's hash is that of its children's. Where sections end thus
depends on what is written there and not on the distance from the beginning, so an
edit changes only the branch that leads to it. Equal roots mean equal texts; where
roots differ, descending the differing branches locates the edits.

A fingerprint is the root and the sections of the one level that has up to about fifty
of them, each with its size: text of bounded length. Fingerprints of texts of
different lengths are compared by building the finer one's sections up.

Defined cases: null and empty texts have the empty tree, alike to itself (1) and
unlike any other (0); repeated rows follow one another in (doc_id, text hash) order,
null ids come last; a single document is its own next one; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from retailmill.llm.common import id_ranges, range_of, texts

LEAF = re.compile(r"[^.\n]{1,400}[.\n]{0,40}|[.\n]{1,40}")
SECTIONS = 48
TOP = 30

#: A tree node: hash, code points, the level up to which it closes sections.
Node = tuple[bytes, int, int]


def hashed(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=8).digest()


def leaves(text: str) -> list[Node]:
    out = []
    for piece in LEAF.findall(text):
        h = hashed(piece.encode())
        n = int.from_bytes(h, "big") | 1 << TOP
        out.append((h, len(piece), (n & -n).bit_length() - 1))
    return out


def sections(nodes: list[Node], level: int) -> list[list[Node]]:
    """The nodes below a level in groups, one for each section of it."""
    out, now = [], []
    for node in nodes:
        now.append(node)
        if node[2] >= level:
            out.append(now)
            now = []
    return [*out, now] if now else out


def built_up(nodes: list[Node], level: int, to: int) -> list[Node]:
    while level < to:
        level += 1
        nodes = [(hashed(b"".join(c[0] for c in s)), sum(c[1] for c in s), s[-1][2]) for s in sections(nodes, level)]
    return nodes


def fingerprint(text: str) -> str:
    """``root|level|hash:size:closes,...``"""
    nodes = leaves(text)
    level = min(TOP, (len(nodes) // SECTIONS).bit_length())
    nodes = built_up(nodes, 0, level)
    root = hashlib.blake2b(b"".join(n[0] for n in nodes) + len(text).to_bytes(8, "big"), digest_size=16).hexdigest()
    return f"{root}|{level}|" + ",".join(f"{h.hex()}:{n}:{c}" for h, n, c in nodes)


def parsed(fp: str) -> tuple[str, int, list[Node]]:
    root, level, rest = fp.split("|")
    cells = (x.split(":") for x in rest.split(",") if x)
    return root, int(level), [(bytes.fromhex(h), int(n), int(c)) for h, n, c in cells]


def likeness(a: str, b: str) -> float:
    """Code points in sections that both have, over those of the longer text."""
    if a == b:
        return 1.0
    (_, la, na), (_, lb, nb) = parsed(a), parsed(b)
    top = max(la, lb)
    sizes: dict[bytes, int] = {}
    counts = []
    for nodes in (built_up(na, la, top), built_up(nb, lb, top)):
        sizes.update((h, n) for h, n, _ in nodes)
        counts.append(Counter(h for h, _, _ in nodes))
    longest = max(sum(n for _, n, _ in na), sum(n for _, n, _ in nb))
    return min(1.0, sum(sizes[h] * n for h, n in (counts[0] & counts[1]).items()) / longest) if longest else 1.0


def edits(a: str, b: str) -> list[tuple[int, int, int, int]]:
    """Places where b differs from a: start and end in a, start and end in b. Descends
    from the roots along branches that differ."""

    def tree(text: str) -> list[list[Node]]:
        levels = [leaves(text)]
        while len(levels[-1]) > 1 and len(levels) <= TOP:
            levels.append(built_up(levels[-1], len(levels) - 1, len(levels)))
        return levels

    ta, tb = tree(a), tree(b)
    for t, other in ((ta, tb), (tb, ta)):
        while len(t) < len(other):
            t.append(built_up(t[-1], len(t) - 1, len(t)))
    found: list[tuple[int, int, int, int]] = []

    def descend(level: int, x: tuple[int, int], y: tuple[int, int], at: int, bt: int) -> None:
        """x, y: index ranges of nodes of a level, whose texts begin at ``at`` and ``bt``."""
        na, nb = ta[level], tb[level]
        (i, ie), (j, je) = x, y
        while i < ie and j < je and na[i][0] == nb[j][0]:
            at, bt, i, j = at + na[i][1], bt + nb[j][1], i + 1, j + 1
        while i < ie and j < je and na[ie - 1][0] == nb[je - 1][0]:
            ie, je = ie - 1, je - 1
        if i == ie and j == je:
            return
        if not level:
            found.append((at, at + sum(n[1] for n in na[i:ie]), bt, bt + sum(n[1] for n in nb[j:je])))
            return

        def below(t: list[list[Node]], first: int, end: int) -> tuple[int, int]:
            ends = [0]
            for s in sections(t[level - 1], level):
                ends.append(ends[-1] + len(s))
            return ends[first], ends[end]

        if ie - i == je - j:  # as many branches on both sides: go into each by itself
            for k in range(ie - i):
                descend(level - 1, below(ta, i + k, i + k + 1), below(tb, j + k, j + k + 1), at, bt)
                at, bt = at + na[i + k][1], bt + nb[j + k][1]
        else:
            descend(level - 1, below(ta, i, ie), below(tb, j, je), at, bt)

    descend(len(ta) - 1, (0, len(ta[-1])), (0, len(tb[-1])), 0, 0)
    return found


def in_order(docs: DataFrame, ranges: int) -> DataFrame:
    """doc_id, text, part, ghost: rows dealt by id range, in each part by descending id.
    The last row of a part meets the next one as a ghost: a copy of the first row of the
    part below (for the lowest part, of the highest). Only part borders, at most
    ``ranges`` ids, come to the driver."""
    rows = texts(docs)
    cuts = id_ranges(docs, ranges)
    part = range_of(F.col("doc_id"), cuts)
    heads = {r.part: r.head for r in rows.groupBy(part.alias("part")).agg(F.max("doc_id").alias("head")).collect()}
    parts = sorted(heads)
    copies = [(heads[low], high) for low, high in zip(parts, [*parts[1:], parts[0]] if parts else [])]
    # the highest part's head goes to the lowest part; any other's to the part above it
    copies = [(heads[p], parts[(k + 1) % len(parts)]) for k, p in enumerate(parts)]
    target = F.lit(None).cast("int")
    known = {h: p for h, p in copies if h is not None}
    if known:
        table = F.create_map(*(F.lit(x) for h, p in known.items() for x in (h, p)))
        target = F.when(F.col("doc_id").isin(*known), table[F.col("doc_id")])
    if None in (h for h, _ in copies):  # a part of null ids only
        target = F.when(F.col("doc_id").isNull(), F.lit(next(p for h, p in copies if h is None))).otherwise(target)
    both = F.array_compact(F.array(
        F.struct(part.alias("part"), F.lit(False).alias("ghost")),
        F.when(target.isNotNull(), F.struct(target.alias("part"), F.lit(True).alias("ghost"))),
    ))
    dealt = rows.select("doc_id", "text", F.explode(both).alias("x")).select("doc_id", "text", "x.part", "x.ghost")
    return dealt.repartition(ranges, "part").sortWithinPartitions(
        "part", "ghost", F.desc_nulls_last("doc_id"), F.xxhash64("text")
    )


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """For each row its fingerprint, that of its edited text (the last third replaced by
    the beginning of the next document's text), and how like they and the next one's are."""
    arrow = to_arrow_schema(T.StructType.fromDDL(SCHEMA))
    ranges = ranges or min(1000, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def row(doc_id, text, own, following, other) -> tuple:
        k = len(text) // 3
        edited = text[: len(text) - k] + following[:k]
        new = fingerprint(edited)
        return doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, new, likeness(own, new), likeness(own, other)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = None, []
        for batch in batches:
            for doc_id, text, part, ghost in zip(*(c.to_pylist() for c in batch.columns)):
                own = fingerprint(text)
                if waiting and waiting[0] == part:
                    rows.append(row(*waiting[1:], text, own))
                waiting = None if ghost else (part, doc_id, text, own)
                if len(rows) >= 512:
                    yield batch_of(rows)
                    rows = []
        if rows:
            yield batch_of(rows)

    return in_order(docs, ranges).mapInArrow(run, SCHEMA)
