"""Best-fit packing of tokenized documents into sequences, certified by lower bounds.

1. Documents become ids; only a document longer than a sequence is cut, into whole
   sequences and a rest. Pieces are written once, with their ids.
2. Piece lengths (not ids) are dealt by hash into groups of bounded size, each packed by
   best-fit decreasing. A group's bin count is compared with the best of several
   dual-feasible-function bounds: such a function maps lengths so that no bin's mapped
   sum exceeds 1, hence the mapped total bounds the bins from below. Where they meet,
   no packing of that group is better.
3. What can still be saved lies in slack. A group gives up its slackest bins: as many as
   hold the slack of one bin more than its gap. Their documents are dealt anew into
   fewer groups and packed again; the exchange counts only if it saves bins. After one
   that saved none, groups give up twice as much. Rounds go on until the count meets the
   bound of the whole (from the counts of each length) or several rounds in a row have
   saved nothing.

A round moves numbers of the given-up pieces only, which shrink by orders of magnitude each
time. No task holds more than a group's lengths, and the driver sees one count for each length.

Defined cases: null and empty texts are their end id alone; repeated rows are pieces of
their own; null ids are kept; no documents, no sequences; a hot source or many equal
lengths change nothing, as groups are dealt by row; other columns are not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from retailmill.llm.common import groups_of_rows, once_a_worker, texts, written
from retailmill.llm.token_count import byte_alphabet


@dataclass(frozen=True)
class Settings:
    capacity: int = 4096
    end_id: int = 1
    #: pieces in a group, on average
    group_pieces: int = 16_384
    #: rounds in a row without a saved bin after which the exchange ends
    patience: int = 4
    most_rounds: int = 16


# --- ids ----------------------------------------------------------------------


class WordEncoder:
    """Ids by a lower-casing vocabulary with word ends, as the tokenizers library gives them.

    Texts of plain Latin characters are cut by the vocabulary's own pattern, which
    Python's expressions can state for them; white space is dropped there, and each distinct
    word is merged once by the library's model while it is in the table. Other texts are cut
    before blanks, and pieces that are not plain, or hold a special token, go to the library whole.
    """

    CUT = re.compile(r"(?<=[0-9A-Za-z!-/:-@])(?= )")
    PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
    WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str, most: int = 150_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.most = most
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        stand_in = {b: c for c, b in byte_alphabet().items()}
        self.alphabet = "".join(stand_in[b] for b in range(256))
        self.specials = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        probe = "It's A test,  of\n\n12 Wörter.\tThey'll 'see'!"
        self.by_word = self._plain_ids(probe) == self._whole(probe)

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _merged(self, word: str) -> bytes:
        symbols = word.encode().decode("latin-1").translate(self.alphabet)
        return np.array([t.id for t in self.library.model.tokenize(symbols)], "<u4").tobytes()

    def _plain_ids(self, text: str) -> bytes:
        words = self.WORDS.findall(text.lower())
        got = list(map(self.known.get, words))
        if None in got:
            if len(self.known) > self.most:
                self.before, self.known = self.known, {}
            known, before = self.known, self.before
            for i, ids in enumerate(got):
                if ids is None:
                    word = words[i]
                    ids = known.get(word) or before.get(word) or self._merged(word)
                    got[i] = known[word] = ids
        return b"".join(got)

    def _is_plain(self, text: str) -> bool:
        return self.PLAIN.fullmatch(text) is not None and not any(s in text for s in self.specials)

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not self.by_word:
            return self._whole(text)
        if self._is_plain(text):
            return self._plain_ids(text)
        return b"".join(
            self._plain_ids(piece) if self._is_plain(piece) else self._whole(piece) for piece in self.CUT.split(text)
        )


def pieces(docs: DataFrame, path: str, settings: Settings = Settings()) -> DataFrame:
    """row (a number of the document row), doc_id, piece, start, length, ids (binary, 32 bits each)."""
    schema = "row long, doc_id long, piece int, start long, length long, ids binary"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    size, end = settings.capacity, np.array([settings.end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = once_a_worker(f"lower words {path}", lambda: WordEncoder(path))
        for ids, text, row in groups_of_rows(batches):
            out: list[list] = [[] for _ in arrow]
            for doc_id, t, r in zip(ids, text, row):
                data = encode(t) + end
                for k, at in enumerate(range(0, len(data), 4 * size)):
                    part = data[at : at + 4 * size]
                    for column, cell in zip(out, (r, doc_id, k, at // 4, len(part) // 4, part)):
                        column.append(cell)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, arrow)], schema=arrow)

    return texts(docs).withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, schema)


# --- one group ----------------------------------------------------------------


def lower_bound(counts: np.ndarray) -> int:
    """Bins that any packing of ``counts[x]`` items of each length x needs at least, where
    a bin holds ``len(counts) - 1``: the best bound of four families of dual feasible functions."""
    c = len(counts) - 1
    x, counts = np.arange(c + 1, dtype=np.int64), counts.astype(np.int64)
    best = -(-int(counts @ x) // c)
    if not counts.any():
        return 0
    # lengths above c - k count as a whole bin, below k as nothing, others as they are
    total, number = np.cumsum(counts * x), np.cumsum(counts)
    k = np.arange(1, c // 2 + 1)
    large, middle = number[c] - number[c - k], total[c - k] - total[k - 1]
    best = max(best, int((large + -(-middle // c)).max()))
    # m + 1 equal parts of a bin: floor((m + 1) x / c) / m, x itself where that is whole
    at = np.flatnonzero(counts)
    for m in range(1, 33):
        scaled = (m + 1) * at
        mapped = np.where(scaled % c == 0, at * m, scaled // c * c)
        best = max(best, -(-int(counts[at] @ mapped) // (m * c)))
    # multiples of lam that fit beside a length of more than half a bin
    lam = np.arange(1, c // 2 + 1)[:, None]
    for some in np.array_split(lam, max(1, len(lam) * len(at) // 1_000_000)):
        fit = c // some
        mapped = np.where(2 * at > c, 2 * (fit - (c - at) // some), np.where(2 * at == c, fit, 2 * (at // some)))
        best = max(best, int((-(-(mapped @ counts[at]) // (2 * fit[:, 0]))).max()))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the slack of each bin. The fullest bin that an item
    fits in is found by a bit mask of the slacks that occur."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_slack: list[list[int]] = [[] for _ in range(capacity + 1)]
    occur, n = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        above = occur >> size
        if above:
            slack = size + (above & -above).bit_length() - 1
            holding = by_slack[slack]
            b = holding.pop()
            if not holding:
                occur &= ~(1 << slack)
        else:
            slack, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - slack
        by_slack[slack - size].append(b)
        occur |= 1 << (slack - size)
    left = np.zeros(n, np.int64)
    for slack, holding in enumerate(by_slack):
        left[holding] = slack
    return bins, offsets, left


def levels(slack: np.ndarray, gap: int, capacity: int) -> np.ndarray:
    """When a bin is given up: the slackest ones that together hold the slack of ``gap``
    bins and one are on level 0, the next that hold as much on level 1, and so on."""
    order = np.argsort(-slack, kind="stable")
    before = np.cumsum(slack[order]) - slack[order]
    out = np.empty(len(slack), np.int64)
    out[order] = np.where(slack[order] > 0, before // ((gap + 1) * capacity), FULL)
    return out


# --- rounds -------------------------------------------------------------------

PLACED = "row long, piece int, length long, sequence_id long, offset long, level long"
FULL = 1 << 40
#: sequence_id holds the round (6 bits), the group (36) and the bin in it (20)
GROUP_BITS, BIN_BITS = 36, 20


def _packed(items: DataFrame, n_items: int, round_no: int, settings: Settings) -> DataFrame:
    """One round: items (row, piece, length) dealt into groups and packed in them."""
    groups = max(1, -(-n_items // settings.group_pieces))
    own = items.withColumn("grp", F.pmod(F.xxhash64("row", "piece", F.lit(round_no)), F.lit(groups)))
    tasks = min(groups, int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = own.repartition(tasks, "grp").sortWithinPartitions("grp", "row", "piece")
    arrow = to_arrow_schema(T.StructType.fromDDL(PLACED))
    capacity = settings.capacity

    def pack(row, piece, length, grp: int) -> pa.RecordBatch:
        bins, offsets, slack = best_fit_decreasing(length, capacity)
        gap = len(slack) - lower_bound(np.bincount(length, minlength=capacity + 1))
        level = levels(slack, gap, capacity)[bins]
        name = ((round_no << GROUP_BITS | grp) << BIN_BITS) + bins
        cells = (row, piece, length, name, offsets, level)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            row, piece, length, grp = (c.to_numpy() for c in batch.columns)
            cuts = np.flatnonzero(np.diff(grp)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(grp)]):
                if held and a < b and held[0][3] != grp[a]:
                    yield pack(*(np.concatenate(c) for c in list(zip(*held))[:3]), held[0][3])
                    held = []
                if a < b:
                    held.append((row[a:b], piece[a:b], length[a:b], int(grp[a])))
        if held:
            yield pack(*(np.concatenate(c) for c in list(zip(*held))[:3]), held[0][3])

    return written(own.select("row", "piece", "length", "grp").mapInArrow(run, PLACED), f"packed{round_no}")


def placements(items: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, int, int]:
    """Items (row, piece, length) with sequence_id and offset; the number of sequences; and
    the number that any packing needs at least."""
    by_length = items.groupBy("length").agg(F.count("*").alias("n")).collect()  # a row a length
    counts = np.zeros(settings.capacity + 1, np.int64)
    for r in by_length:
        counts[r.length] = r.n
    least = lower_bound(counts)
    now = _packed(items, int(counts.sum()), 1, settings)
    total, idle, width = _bins(now)[0], 0, 1
    for round_no in range(2, settings.most_rounds + 2):
        if total <= least or idle >= settings.patience:
            break
        released = now.where(F.col("level") < width)
        before, n_items = _bins(released)
        tried = _packed(released.select("row", "piece", "length"), n_items, round_no, settings)
        saved = before - _bins(tried)[0]
        if saved > 0:
            now = now.where(F.col("level") >= width).unionByName(tried)
            total, idle, width = total - saved, 0, 1
        else:
            idle, width = idle + 1, 2 * width
    return now.drop("level", "length"), total, least


def _bins(placed: DataFrame) -> tuple[int, int]:
    """Sequences and items: each sequence has one item at offset 0, as no length is 0."""
    r = placed.agg(F.count_if(F.col("offset") == 0).alias("bins"), F.count("*").alias("items")).first()
    return r.bins, r["items"]


def pack(docs: DataFrame, path: str, settings: Settings = Settings()) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset of every piece."""
    cut = written(pieces(docs, path, settings), "pieces")
    placed, _, _ = placements(cut.select("row", "piece", "length"), settings)
    return cut.join(placed, ["row", "piece"]).select("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")


def digests(docs: DataFrame, path: str, settings: Settings = Settings()) -> DataFrame:
    """The packing with a checksum in place of the ids."""
    rows = pack(docs, path, settings)
    return rows.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
