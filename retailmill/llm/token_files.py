"""Token-id files with Elias-Fano document boundaries.

Documents are dealt by id range, so that parts and the blocks within them are in
ascending order of id. A block is one row of the file table: the ids of consecutive
documents back to back (16 bits each where the vocabulary allows, else 32), the
Elias-Fano code of where each document ends, and that of the documents' ids above the
block's first. Spark's own writer puts the blocks in place, so a lost or repeated task leaves no half-written file.

Elias-Fano splits each of n non-decreasing numbers up to u: about log2(u / n) low bits are
stored as they are, the high parts in unary as a bit vector with about two bits a
number. The i-th number is found by selecting the i-th set bit; samples of every 64th
say where to look. Reading asks select for each document. No table of 64-bit offsets exists: a part's beginning is the sum of
the parts before it, a block's is kept in its row.

Defined cases: null and empty texts are the end id alone; repeated rows follow one
another in (doc_id, text hash) order; null ids come first; no documents, no blocks;
other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from retailmill.llm.common import give_back, groups_of_rows, id_ranges, once_a_worker, range_of, texts, written
from retailmill.llm.token_count import byte_alphabet

SAMPLE = 64


class EliasFano(NamedTuple):
    """Non-decreasing numbers below 2^63."""

    n: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def of(cls, numbers: np.ndarray) -> EliasFano:
        numbers = np.asarray(numbers, np.int64)
        n = len(numbers)
        u = int(numbers[-1]) + 1 if n else 1
        low_bits = max(0, (u // max(n, 1)).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.int64)
        low = np.packbits(((numbers[:, None] >> shifts) & 1).astype(np.uint8).ravel(), bitorder="little")
        ones = (numbers >> low_bits) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def select(self, i: int) -> int:
        """The i-th number, read from a few bytes after its sample."""
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = at // 8
        word = int(self.high[byte]) >> (at % 8) << (at % 8)
        while left >= word.bit_count():
            left -= word.bit_count()
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        one = byte * 8 + (word & -word).bit_length() - 1
        first = i * self.low_bits
        window = int.from_bytes(self.low[first // 8 : (first + self.low_bits + 7) // 8].tobytes(), "little")
        return (one - i) << self.low_bits | (window >> first % 8) & ((1 << self.low_bits) - 1)

    def numbers(self) -> np.ndarray:
        """All of them at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        low = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        return ((ones - np.arange(self.n)) << self.low_bits) + low.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high)], "<u4")
        return b"".join(x.tobytes() for x in (head, self.low, self.high, self.samples.astype("<u4")))

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, a, b = (int(x) for x in np.frombuffer(data, "<u4", 4))
        low, high = np.frombuffer(data, np.uint8, a, 16), np.frombuffer(data, np.uint8, b, 16 + a)
        return cls(n, low_bits, low, high, np.frombuffer(data, "<u4", offset=16 + a + b))


class Kept(dict):
    """What ``make`` gives for a text, kept if that is short. Two generations bound the size
    and keep frequent texts."""

    LONGEST = 40

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, text: str) -> bytes:
        got = self.before.get(text)
        if got is None:
            got = self.make(text)
        if len(text) <= self.LONGEST:
            self[text] = got
        return got

    def turn(self) -> None:
        if len(self) > self.most:
            self.before = dict(self)
            self.clear()


class Encoder:
    """Ids of whole texts by a byte-level vocabulary of the tokenizers library.

    Texts of plain Latin characters are cut into words by the vocabulary's own pattern,
    which Python's expressions can state for them, and each distinct word is merged once by
    the library's model while it is in the table. In other texts the pattern always starts
    anew at a blank after a character that is none; they are cut there, and pieces that
    are not plain go to the library whole. Pieces have a table, too.
    """

    CUT = re.compile(r"(?<=[\w!-~])(?= )")
    PLAIN = re.compile(r"[\n -~À-ÖØ-öø-ÿ]*")
    WORDS = re.compile(
        r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+"
    )

    def __init__(self, path: str, most: int = 160_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.tokenize = self.library.model.tokenize  # the attribute makes a new object at each access
        self.size = self.library.get_vocab_size()
        self.words, self.pieces = Kept(self._merged, most), Kept(self._piece, most)
        self.as_bytes = [i.to_bytes(4, "little") for i in range(self.size)]
        stand_in = {b: c for c, b in byte_alphabet().items()}
        self.alphabet = "".join(stand_in[b] for b in range(256))
        probe = "It's a test,  of\n\n12 Wörter.\n x"
        plain = b"".join(map(self._merged, self.WORDS.findall(probe)))
        self.by_piece = plain == self._ids(self.library.encode(probe, add_special_tokens=False).ids)
        self.specials = tuple(t.content for t in self.library.get_added_tokens_decoder().values())

    @staticmethod
    def _ids(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def _merged(self, word: str) -> bytes:
        if word.isascii() and word[1:].isalnum():  # only the first may stand for another character
            symbols = self.alphabet[ord(word[0])] + word[1:]
        else:
            symbols = word.encode().decode("latin-1").translate(self.alphabet)
        as_bytes = self.as_bytes
        return b"".join([as_bytes[t.id] for t in self.tokenize(symbols)])

    def _piece(self, piece: str) -> bytes:
        if self._plain(piece):
            return b"".join(map(self.words.__getitem__, self.WORDS.findall(piece)))
        return self._ids(self.library.encode(piece, add_special_tokens=False).ids)

    def _plain(self, text: str) -> bool:
        return self.PLAIN.fullmatch(text) is not None and not any(s in text for s in self.specials)

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not self.by_piece:
            return self._ids(self.library.encode(text, add_special_tokens=False).ids)
        self.words.turn()
        if self._plain(text):
            return b"".join(map(self.words.__getitem__, self.WORDS.findall(text)))
        self.pieces.turn()
        return b"".join(map(self.pieces.__getitem__, self.CUT.split(text)))


BLOCK = (
    "part int, block int, start_in_part long, n_docs long, n_ids long, id_bytes int, n_null long, first_id long, "
    "doc_ids binary, ends binary, ids binary"
)
#: Widest range of ids in a block; what exceeds it begins a new one.
ID_RANGE = 1 << 62


def blocks(docs: DataFrame, path: str, end_id: int = 2, block_ids: int = 1 << 18, ranges: int | None = None) -> DataFrame:
    """The file table's rows."""
    arrow = to_arrow_schema(T.StructType.fromDDL(BLOCK))
    ranges = ranges or min(1000, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = texts(docs).withColumn("part", range_of(F.col("doc_id"), id_ranges(docs, ranges)))
    rows = rows.repartition(ranges, "part").sortWithinPartitions("part", F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = once_a_worker(f"byte pieces {path}", lambda: Encoder(path))
        narrow = max(encode.size, end_id + 1) <= 1 << 16
        part, block, start, own, ids, size, lowest = None, 0, 0, [], [], 0, None

        def packed() -> pa.RecordBatch:
            stops = np.cumsum([len(i) // 4 for i in ids])
            data = np.frombuffer(b"".join(ids), "<u4")
            known = [d for d in own if d is not None]  # ascending
            first = known[0] if known else 0
            above = EliasFano.of(np.array([d - first for d in known], np.int64))
            cells = (part, block, start, len(own), int(stops[-1]), 2 if narrow else 4, len(own) - len(known), first,
                     above.to_bytes(), EliasFano.of(stops).to_bytes(),
                     (data.astype("<u2") if narrow else data).tobytes())
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, arrow)], schema=arrow)

        for columns in groups_of_rows(batches):
            for doc_id, text, its_part in zip(*columns):
                wide = doc_id is not None and lowest is not None and doc_id - lowest >= ID_RANGE
                if own and (its_part != part or size >= block_ids or wide):
                    yield packed()
                    block, start = block + 1, start + size
                    own, ids, size, lowest = [], [], 0, None
                if its_part != part:
                    part, block, start = its_part, 0, 0
                own.append(doc_id)
                lowest = doc_id if lowest is None else lowest
                ids.append(encode(text) + end)
                size += len(ids[-1]) // 4
        if own:
            yield packed()
        del own, ids
        give_back()

    return rows.mapInArrow(run, BLOCK)


def write(docs: DataFrame, path: str, **options) -> DataFrame:
    """Writes the file table to the shared folder and returns it."""
    return written(blocks(docs, path, **options), "token-files")


def read_back(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    sums = files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()  # a row a part, whose number is a parameter
    starts, total = {}, 0
    for r in sorted(sums, key=lambda r: r.part):
        starts[r.part], total = total, total + r.n
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                n = row["n_docs"]
                data = np.frombuffer(row["ids"], "<u2" if row["id_bytes"] == 2 else "<u4").astype("<u4")
                ends, above = EliasFano.from_bytes(row["ends"]), EliasFano.from_bytes(row["doc_ids"])
                stops = np.array([ends.select(i) for i in range(n)], np.int64)
                begins = np.concatenate([[0], stops[:-1]])
                known = [None] * row["n_null"] + [row["first_id"] + above.select(i) for i in range(above.n)]
                crc = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(begins, stops)]
                first = starts[row["part"]] + row["start_in_part"]
                cells = (pa.array(known, pa.int64()), pa.array(begins + first), pa.array(stops - begins), pa.array(crc))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cells, arrow)], schema=arrow)

    return files.mapInArrow(run, schema)
