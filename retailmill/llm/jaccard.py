"""All groups of documents linked by shingle sets with Jaccard similarity 0.8 or more.

A set falls into a size band. Linked sets of n <= m shingles have 100 n >= 80 m and
differ in at most n / 4 of them, so a band's scheme covers every pair whose smaller
set lies in the band. The scheme cuts the range of the hashes into twice as many slices as
the greatest difference allowed: at least half of the slices of two linked sets are
equal. A *tile* is a band, a slice and the contents of that slice; only sets in a
common tile are compared. Small sets enter all their tiles, so none is missed. Larger
ones (over about 130 shingles) enter the first 64 slices, in an order by hash, that hold
something. At the very threshold at least half of these are expected to be equal, so
that a linked pair stays unseen with a chance under 1e-9; above it, far less.

``exact`` leaves nothing to chance, with fewer tiles. All shingles are put into one order, and
a set of n enters the tiles of its first n - ceil(0.8 n) + 1 shingles: two linked sets have 80 %
of either in common, so one shingle at least that is among the first of both. Any order is
right; this one has the shingles last that several texts of a sample hold, so that a common
passage is a tile only of sets that consist of little else. Tiles that several sets enter are
cut by size, each set in two classes, as linked sets are in the same class or in neighbours.

Compared pairs first meet hashed bitmaps (four to eight bits a shingle): bits in which
they differ bound the overlap from above. Pairs that the bound allows are settled by
exact intersection of the sorted hash arrays.

Not all pairs of a tile are compared. Round one ties each set to the tile's smallest;
components follow. What is then compared are pairs of a tile that lie in different
components. A tile of very many copies thus costs few comparisons a set, yet no link
between components is lost. Sets equal in all shingles are one class from the start.

Tiles with few pairs between components are compared whole. The others are *common*:
a passage that many texts share, or near copies that are not linked. By counting, two
linked sets share other tiles too unless common ones (and empty slices) make up most of
a set's tiles. So only such *leaning* sets are compared there, in as many common tiles
as counting leaves open (of a large set, the first 32; ``exact``: all), block against block
of 2,048 sets. In *crowded* tiles, those of many sets, a pair that the bitmaps allow and whose
components are apart is settled at once, by 32 bits of each shingle, and then ties its
components: what leaves the task is a forest of links, so fewer pairs than sets. These
are verified by whole hashes; should one be no link, the crowded tiles of its sets are compared
again without ties. In other tiles, and where sets have more than 8,192 shingles, a block first
reports a forest by bitmaps; once it is verified and components follow, it reports what is
still apart.

Defined cases: null and empty texts have no shingles and are their own component;
fewer than five words are one shingle; repeated rows, or a null id, follow their text
(the component is the smallest non-null id among the linked rows; null where all are
null). Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailmill.llm.common import Scratch, map_rows, written
from retailmill.llm.components import components, joined_up
from retailmill.llm.shingles import mixed, shingle_sets

PERCENT = 80
#: Texts of which shingles are counted to order them, and how many are put last.
SAMPLED, WIDESPREAD = 8_000, 1 << 16
SLICES = 64
BAND = 1.6
#: Of a large set's tiles, the share that may be common ones: a linked pair then has an
#: equal one among the others with a chance of 1 - 0.62^44.
LEANING = 0.31
#: Pairs between components up to which a tile is compared whole.
FEW_PAIRS = 28
BLOCK = 2_048
#: Bits a shingle, at least, of the bitmaps compared in common tiles of more sets than that.
WIDE, MANY = 16, 64
#: Shingles up to which a set comes to crowded tiles with 32 bits of each (more take more room than
#: the widest bitmap).
LARGEST = 1 << 13
TRIES = 32


def band_starts(n: int) -> list[int]:
    """Smallest sizes of the bands that a set of n can be in or just above."""
    out, low = [], 4
    while low <= n:
        high = max(low + 1, int(low * BAND))
        if n * PERCENT <= 100 * (high - 1):  # the largest partner of the band's largest set
            out.append(low)
        low = high
    return out


def slices_of(low: int) -> int:
    """How many slices the scheme of the band that starts at ``low`` has."""
    largest = max(low + 1, int(low * BAND)) - 1
    return 2 * (differing(largest) + 1)


def differing(n: int) -> int:
    """Most shingles in which a set of n and a linked one of at least n may differ."""
    m = 100 * n // PERCENT
    return (n + m) * (100 - PERCENT) // (100 + PERCENT)


def tiles(own: np.ndarray, most: int = SLICES) -> list[dict]:
    """The tiles that a sorted set enters, by band: ``allowed`` is how many of them can be
    common ones before a linked pair might share no other; ``all_known`` says whether the
    set entered every slice, so that this is exact."""
    out = []
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(own + np.uint64(0x632BE59BD9B4E019)))])
    for low in band_starts(len(own)):
        n = slices_of(low)
        alike = n // 2 + 1  # slices that two linked sets have in common, at least
        step = np.uint64((1 << 64) // n)
        at = np.searchsorted(own, np.arange(1, n, dtype=np.uint64) * step)
        edge = np.concatenate([[0], at, [len(own)]])
        which = np.arange(n, dtype=np.uint64) + np.uint64(low << 32)
        taken = np.flatnonzero(edge[1:] > edge[:-1])
        if n > most:
            order = mixed(which[taken] * np.uint64(0xA24BAED4963EE407))
            taken = taken[np.argsort(order)[:most]]
            allowed = int(LEANING * len(taken))
        elif n - len(taken) < alike:
            allowed = alike - (n - len(taken)) - 1
        else:  # so many empty slices that a linked pair might share no other
            taken, allowed = np.arange(n), alike - 1
        content = total[edge[1:]] - total[edge[:-1]]
        keys = mixed(mixed(content[taken]) + which[taken] * np.uint64(0x9FB21C651E98DF25))
        out.append({"band": low, "allowed": allowed, "all_known": n <= most, "tile": keys.view(np.int64).tolist()})
    return out


def widespread(docs: DataFrame) -> list[int]:
    """Hashes of shingles that several texts of a bounded sample hold, the rarest first."""
    share = int((1 << 20) * min(1.0, SAMPLED / max(1, docs.count())))
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share)
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text")).select(F.coalesce("text", F.lit("")).alias("text"))
    own = map_rows(sample, lambda: lambda text: {"own": [own.view(np.int64) for own in shingle_sets(text)]}, "own array<long>")
    counts = own.select(F.explode("own").alias("h")).groupBy("h").count().where("count > 1")
    most = counts.orderBy(F.desc("count"), "h").limit(WIDESPREAD).collect()  # their number is a parameter
    return [r.h for r in reversed(most)]


def first_shingles(own: np.ndarray, last: np.ndarray, order: np.ndarray) -> np.ndarray:
    """As many of a sorted set's first shingles that a linked set has one of them among its own
    first. The hashes come in ascending order, then those in ``last`` (sorted) by ``order``."""
    n = len(own)
    most = n - (n * PERCENT + 99) // 100 + 1
    if not len(last):
        return own[:most]
    at = np.minimum(np.searchsorted(last, own), len(last) - 1)
    late = last[at] == own
    rare = own[~late][:most]
    return np.concatenate([rare, own[late][np.argsort(order[at[late]])][: most - len(rare)]])


def bitmap(own: np.ndarray, width: int = 4) -> np.ndarray:
    """``width`` bits a shingle to twice as many, in words of 64 bits; at most 2^14 times that."""
    bits = min(width << 14, 1 << max(6, int(width * len(own) - 1).bit_length()))
    flags = np.zeros(bits, np.uint8)
    flags[(own % np.uint64(bits)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view(np.int64)


def short_hashes(own: np.ndarray) -> np.ndarray:
    """The lower 32 bits of each shingle, sorted, two in a word. Sets have at least as many of
    them in common as shingles, and the same bitmap."""
    low = np.zeros(len(own) + len(own) % 2, np.uint32)
    low[: len(own)] = np.sort((own & np.uint64(0xFFFFFFFF)).astype(np.uint32))
    return low.view(np.int64)


def set_hash(own: np.ndarray) -> int:
    return int(mixed(np.array([mixed(own).sum() + np.uint64(len(own))], np.uint64)).view(np.int64)[0])


def row_key() -> Column:
    """Never null; equal only for rows equal in id and text."""
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def profiles(docs: DataFrame, most: int = SLICES) -> DataFrame:
    """doc_id, k (row key), n_shingles, v (hash of the whole set, null without shingles), bits, tiles.
    Within a task mostly only the first copy of a set has bits and tiles. Where ``most`` is over
    the largest number of slices, the tiles are those of the set's first shingles."""
    exact = most >= 1 << 31
    late = np.array(widespread(docs) if exact else [], np.int64).view(np.uint64)
    order = np.argsort(late)
    late = late[order]

    def entered(own: np.ndarray) -> list[dict]:
        if not exact:
            return tiles(own, most)
        keys = first_shingles(own, late, order)
        return [{"band": 0, "allowed": 0, "all_known": True, "tile": keys.view(np.int64)}]

    def make():
        seen: set[int] = set()

        def fn(ids, text, key):
            out = {"doc_id": ids, "k": key, "n_shingles": [], "v": [], "bits": [], "tiles": []}
            for own in shingle_sets(text):
                v = set_hash(own) if len(own) else None
                new = v is not None and v not in seen
                if len(seen) > 100_000:
                    seen.clear()
                seen.add(v)
                out["n_shingles"].append(len(own))
                out["v"].append(v)
                out["bits"].append(bitmap(own) if new else None)
                out["tiles"].append(entered(own) if new else None)
            return out

        return fn

    tile = "struct<band: int, allowed: int, all_known: boolean, tile: array<long>>"
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), row_key().alias("k"))
    return map_rows(rows, make, f"doc_id long, k long, n_shingles long, v long, bits array<long>, tiles array<{tile}>")


def folded(bits: Column, n: Column) -> Column:
    """A bitmap halved until it has n words: the one of that width."""
    return F.when(F.size(bits) == n, bits).otherwise(
        F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.aggregate(
                F.sequence(F.lit(0), (F.size(bits) / n).cast("int") - 1),
                F.lit(0).cast("bigint"),
                lambda acc, k: acc.bitwiseOR(F.element_at(bits, i + k * n)),
            ),
        )
    )


def may_link(a: str, b: str) -> Column:
    """Whether sizes and bitmaps leave an overlap that links the sets."""
    bits_a, bits_b = F.col(f"{a}.bits"), F.col(f"{b}.bits")
    width = F.least(F.size(bits_a), F.size(bits_b))
    differ = F.aggregate(
        F.zip_with(folded(bits_a, width), folded(bits_b, width), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda acc, x: acc + x,
    )
    n = F.col(f"{a}.n") + F.col(f"{b}.n")
    most = F.least(F.floor((n - differ) / 2), F.col(f"{a}.n"), F.col(f"{b}.n"))
    return 100 * most >= PERCENT * (n - most)


def likely(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of set hashes that sizes and bitmaps allow."""
    light = sets.select("v", F.struct("n", "bits").alias("s"))
    left = light.select(F.col("v").alias("a"), F.col("s").alias("x"))
    right = light.select(F.col("v").alias("b"), F.col("s").alias("y"))
    return pairs.join(left, "a").join(right, "b").where(may_link("x", "y")).select("a", "b")


def of_sets(wanted: DataFrame, sets: DataFrame, docs: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """v, own (what ``of`` makes of the sorted set) for the set hashes in ``wanted``."""
    keys = sets.select("k", "v").join(wanted, "v")

    def make():
        return lambda v, text: {"v": v, "own": [of(own) for own in shingle_sets(text)]}

    rows = docs.select(row_key().alias("k"), F.coalesce("text", F.lit("")).alias("text")).join(keys, "k")
    # rows equal in id and text have the same key
    own = rows.groupBy("v").agg(F.min("text").alias("text"))
    return map_rows(own, make, "v long, own array<long>")


def exact_links(near: DataFrame, sets: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Those of the pairs (a, b) of set hashes that are linked, by their sorted arrays. ``sets``
    names a row (k) that holds a set (v)."""
    wanted = near.select(F.col("a").alias("v")).unionByName(near.select(F.col("b").alias("v"))).distinct()
    arrays = scratch.written(of_sets(wanted, sets, docs, lambda own: own.view(np.int64)), "arrays")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            keep = []
            for p, q in zip(x, y):
                p, q = p.view(np.uint64), q.view(np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                common = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                keep.append(100 * common >= PERCENT * (len(p) + len(q) - common))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    both = near.join(arrays.select(F.col("v").alias("a"), F.col("own").alias("p")), "a")
    both = both.join(arrays.select(F.col("v").alias("b"), F.col("own").alias("q")), "b")
    return both.select("a", "b", "p", "q").mapInArrow(settle, "a long, b long")


def apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of tiles that hold several components, with their label and the number of
    pairs between components in the tile."""
    now = members.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))
    own = now.groupBy("tile", "label").agg(F.count("*").cast("double").alias("n"))
    held = own.groupBy("tile").agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs"))
    return now.join(held.where("pairs > 0"), "tile")


def in_few_pairs(now: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets in different components that share a tile with few such pairs."""
    a = now.select("tile", F.col("v").alias("a"), F.col("label").alias("label_a"))
    b = now.select("tile", F.col("v").alias("b"), F.col("label").alias("label_b"))
    return a.join(b, "tile").where("a < b AND label_a != label_b").select("a", "b").distinct()


def leaning(now: DataFrame, scratch: Scratch, exact: bool = False) -> DataFrame:
    """The sets of common tiles that may share no other tile with a linked one: tile, v."""
    by_set = Window.partitionBy("v", "band")
    rows = now.withColumns({"h": F.count("*").over(by_set), "k": F.row_number().over(by_set.orderBy("tile"))})
    needed = F.when(F.col("all_known"), F.col("h") - F.col("allowed")).otherwise(F.col("h") if exact else F.lit(TRIES))
    rows = rows.where((F.col("h") > F.col("allowed")) & (F.col("k") <= needed)).select("tile", "v").distinct()
    return scratch.written(rows, "leaning")


def crowds(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows (tile, v), with many (the tile holds many sets) and crowded (and only such that
    come with short hashes)."""
    own = rows.join(sets.select("v", "n"), "v").groupBy("tile")
    own = own.agg((F.count("*") > MANY).alias("many"), (F.max("n") <= LARGEST).alias("short"))
    return rows.join(own.select("tile", "many", (F.col("many") & F.col("short")).alias("crowded")), "tile")


def in_common_tiles(rows: DataFrame, labels: DataFrame, sets: DataFrame, forest: bool) -> DataFrame:
    """Pairs (a, b) of leaning sets that share a common tile (``rows``: tile, v, many, crowded), lie
    in different components and may be linked (``sets``: v, n, bits, wide); ``settled`` are those
    of crowded tiles. ``forest``: of a block only pairs that tie components not yet tied in it."""
    rows = rows.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))
    blocks = rows.groupBy("tile").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("n"), F.min("label").alias("least"), F.max("label").alias("most")
    )
    blocks = blocks.where("least != most").select("tile", "n")
    own = F.pmod(F.xxhash64("v"), F.col("n")).cast("int")
    cells = rows.join(blocks, "tile").select(
        "tile", "v", "label", "many", "crowded", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other")
    )
    cells = cells.select(
        "tile", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "v", "label", "many", "crowded"
    ).join(sets, "v").withColumn("bits", F.when(F.col("many"), F.coalesce("wide", "bits")).otherwise(F.col("bits")))
    # in order of v, so that the forests of tiles with the same sets are the same
    cells = cells.repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j", "v").select(
        "tile", "i", "j", "own", "v", "label", "n", "many", "crowded", "bits"
    )

    def tied(p: np.ndarray, q: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Places of the pairs that tie components which those before them have not tied."""
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        keep = []
        for k, (a, b) in enumerate(zip(label[p].tolist(), label[q].tolist())):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
                keep.append(k)
        return np.array(keep, np.int64)

    def compare(label, n, bits, x, y) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of the index lists x and y of one cell, the pairs that may be linked. ``label`` may
        change in between."""
        width = min(len(bits[k]) for k in (*x, *y))
        fold = np.stack([np.bitwise_or.reduce(bits[k].reshape(-1, width)) for k in (*x, *y)])
        p, q = fold[: len(x)], fold[len(x) :]
        step = max(1, (1 << 21) // (len(y) * width))  # 16 MB at once
        for a in range(0, len(x), step):
            own = x[a : a + step]
            differ = np.bitwise_count(p[a : a + step, None, :] ^ q[None, :, :]).sum(2, dtype=np.int64)
            size = n[own][:, None] + n[y][None, :]
            most = np.minimum((size - differ) // 2, np.minimum(n[own][:, None], n[y][None, :]))
            at, to = np.nonzero((100 * most >= PERCENT * (size - most)) & (label[own][:, None] != label[y][None, :]))
            yield own[at], y[to]

    def settled(label, n, bits, short, x, y) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Likewise, those of them that short hashes allow; with ``forest``, as long as their
        components are apart."""
        label = label.copy()
        for p, q in compare(label, n, bits, x, y):
            order = np.argsort(p, kind="stable")
            p, q = p[order], q[order]
            for own, others in zip(p[np.flatnonzero(np.diff(p, prepend=-1))], np.split(q, np.flatnonzero(np.diff(p)) + 1)):
                step = max(1, (1 << 20) // n[others].max())
                for a in range(0, len(others), step):
                    some = others[a : a + step]
                    some = some[label[some] != label[own]]
                    if not len(some):
                        continue
                    theirs = np.concatenate([short[k] for k in some])
                    at = np.minimum(np.searchsorted(short[own], theirs), n[own] - 1)
                    starts = np.concatenate([[0], np.cumsum(n[some])[:-1]])
                    common = np.add.reduceat((short[own][at] == theirs).astype(np.int64), starts)
                    some = some[100 * common >= PERCENT * (n[own] + n[some] - common)]
                    if forest and len(some):
                        names, first = np.unique(label[some], return_index=True)
                        some = some[first]
                        label[np.isin(label, names)] = label[own]
                    yield np.full(len(some), own), some

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def cells_of(table: pa.Table, last: bool):
            keys = np.stack([table.column(k).to_numpy() for k in (0, 1, 2)])
            starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)])) if table.num_rows else []
            stops = [*starts[1:], table.num_rows]
            whole = list(zip(starts, stops)) if last else list(zip(starts, stops))[:-1]
            return whole, (starts[-1] if len(starts) else 0)

        def pairs(table: pa.Table, last: bool) -> tuple[list[pa.RecordBatch], pa.Table]:
            whole, tail = cells_of(table, last)
            i, j, own, v, label, n, many, crowded = (table.column(k).to_numpy() for k in range(1, 9))
            words = [b.view(np.uint64) for b in table.column(9).to_pandas()] if whole else []
            found: dict[bool, list] = {False: [], True: []}
            for a, b in whole:
                x, y = np.flatnonzero(own[a:b] == i[a]), np.flatnonzero(own[a:b] == j[a])
                if not len(x) or not len(y):
                    continue
                bits, short = words[a:b], []
                if many[a]:
                    short = [w.view(np.uint32)[:k] if k <= LARGEST else None for w, k in zip(bits, n[a:b])]
                    bits = [w if h is None else bitmap(h, WIDE).view(np.uint64) for w, h in zip(bits, short)]
                its = settled(label[a:b], n[a:b], bits, short, x, y) if crowded[a] else compare(label[a:b], n[a:b], bits, x, y)
                p, q = (np.concatenate(s) for s in zip((x[:0], x[:0]), *its))
                if forest and not crowded[a]:
                    keep = tied(p, q, label[a:b])
                    p, q = p[keep], q[keep]
                found[bool(crowded[a])].append((v[a:b][p], v[a:b][q]))
            out = []
            for of_crowded, own in found.items():
                p, q = (np.concatenate([v[:0], *(f[s] for f in own)]) for s in (0, 1))
                low, high = np.minimum(p, q), np.maximum(p, q)
                both = np.unique(np.stack([low, high], 1)[low < high], axis=0)
                out += pa.table({"a": both[:, 0], "b": both[:, 1], "settled": np.full(len(both), of_crowded)}).to_batches()
            return out, table.slice(tail)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            out, rest = pairs(table, False)
            yield from out
        if rest is not None:
            yield from pairs(rest, True)[0]

    return cells.mapInArrow(run, "a long, b long, settled boolean").distinct()


def shared_tiles(entered: DataFrame) -> DataFrame:
    """tile, least (set) of the tiles that several sets enter."""
    ends = entered.groupBy("tile").agg(F.min("v").alias("least"), F.max("v").alias("most"))
    return ends.where("least != most").select("tile", "least")


def by_size(entered: DataFrame) -> DataFrame:
    """Tiles cut by the size n of the sets: each set is in two classes, the band. The sizes of a
    class differ by 1.26, more than those of linked sets, which so have a class in common."""
    own = F.floor(F.log("n") / F.log(F.lit(1.26))).cast("int")
    rows = entered.select("v", "tile", F.explode(F.array(own, own + 1)).alias("band"))
    return rows.withColumn("tile", F.xxhash64("tile", "band"))


def labelled(docs: DataFrame, exact: bool = False) -> DataFrame:
    """doc_id, k (row key), n_shingles, v (hash of the set), label (of its component) of every row."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.written(profiles(docs, 1 << 31 if exact else SLICES), "profiles")
    sets = scratch.written(
        rows.where("bits IS NOT NULL").select("v", "k", F.col("n_shingles").alias("n"), "bits").dropDuplicates(["v"]), "sets"
    )
    entered = rows.where("tiles IS NOT NULL").select("v", F.col("n_shingles").alias("n"), F.explode("tiles").alias("t"))
    entered = entered.select("v", "n", "t.band", "t.allowed", "t.all_known", F.explode("t.tile").alias("tile"))
    if exact:
        met = entered.select("tile", "v", "n").join(shared_tiles(entered).select("tile"), "tile").distinct()
        entered = by_size(scratch.written(met, "met")).withColumns({"allowed": F.lit(0), "all_known": F.lit(True)})
    entered = entered.select("v", "band", "allowed", "all_known", "tile")
    members = scratch.written(entered.join(shared_tiles(entered), "tile").distinct(), "members")

    first = members.where("v != least").select(F.col("least").alias("a"), F.col("v").alias("b")).distinct()
    near = scratch.written(likely(first, sets), "near")
    linked = scratch.written(exact_links(near, sets, docs, scratch), "linked")
    labels = components(linked)
    now = scratch.written(apart(members.drop("least"), labels), "apart")

    few = in_few_pairs(now.where(F.col("pairs") <= FEW_PAIRS)).join(first, ["a", "b"], "left_anti")
    rest = crowds(leaning(now.where(F.col("pairs") > FEW_PAIRS), scratch, exact), sets)
    rest = scratch.written(rest, "rest")
    wide = of_sets(rest.where("many").select("v").distinct(), sets, docs, lambda own: short_hashes(own) if len(own) <= LARGEST else bitmap(own, WIDE))
    leaners = sets.select("v", "n", "bits").join(rest.select("v").distinct(), "v").join(wide.withColumnRenamed("own", "wide"), "v", "left")
    leaners = scratch.written(leaners, "leaners")
    ties = scratch.written(in_common_tiles(rest, labels, leaners, True), "ties")
    forest = ties.select("a", "b").join(near, ["a", "b"], "left_anti")
    pairs = scratch.written(likely(few, sets).unionByName(forest).distinct(), "pairs")
    links = scratch.written(exact_links(pairs, sets, docs, scratch), "linked")
    labels = scratch.written(joined_up(labels, links), "labels")
    # what may still be apart after that: crowded tiles only where a tie was no link
    wrong = ties.where("settled").join(linked.unionByName(links), ["a", "b"], "left_anti")
    wrong = wrong.select(F.explode(F.array("a", "b")).alias("v")).distinct()
    again = rest.where("crowded").join(wrong, "v", "left_semi").select("tile").distinct()
    rest = rest.where("NOT crowded").unionByName(rest.join(again, "tile", "left_semi"))
    late = in_common_tiles(rest, labels, leaners, False).select("a", "b").distinct()
    late = scratch.written(late.join(near.unionByName(pairs), ["a", "b"], "left_anti"), "late")
    labels = joined_up(labels, scratch.written(exact_links(late, sets, docs, scratch), "linked"))

    named = rows.select("v").where("v IS NOT NULL").distinct().join(labels, "v", "left")
    named = named.select("v", F.coalesce("label", "v").alias("label"))
    out = scratch.written(rows.select("doc_id", "k", "n_shingles", "v").join(named, "v", "left"), "labelled")
    scratch.discard(keep=1)
    return out


def jaccard_components(docs: DataFrame, exact: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id for every row. ``exact`` leaves nothing to chance: every
    set enters all its tiles, whatever its size."""
    rows = labelled(docs, exact)
    names = rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(names, "label", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, exact: bool = False) -> DataFrame:
    """Of each component one row, whole and unchanged: the one with the smallest id, or, if all
    ids are null, the smallest row key; of rows equal in id and text any one. Rows without
    shingles stay. ``exact`` is that of :func:`jaccard_components`."""
    rows = labelled(docs, exact)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "k")
    kept = rows.where("label IS NOT NULL").groupBy("label").agg(F.min(order).alias("first")).select("first.k")
    kept = kept.unionByName(rows.where("label IS NULL").select("k").distinct())
    times = rows.where("label IS NOT NULL").groupBy("k").agg(F.count("*").alias("times"))
    kept = written(kept.join(times, "k", "left").select(F.col("k").alias("_k"), (F.coalesce("times", F.lit(1)) > 1).alias("again")), "kept")
    keyed = docs.withColumn("_k", row_key())
    once = keyed.join(kept.where("NOT again"), "_k", "left_semi")
    again = keyed.join(kept.where("again"), "_k", "left_semi").dropDuplicates(["_k"])
    return once.select(docs.columns).unionByName(again.select(docs.columns))
