"""SentencePiece ids of whole texts by a table of distinct chunks, and back.

In vocabularies whose pieces never go on past the beginning of a marked word (no
piece has a whitespace marker after another character), merges never cross from one
marked word to the next. A chunk is a run of markers and the word after it. Each task
keeps a table of the chunks it has met, has the library segment new ones once, and
joins their ids by position: the same ids as for the whole text. Vocabularies that
break the condition are encoded text by text.

Defined cases: null and empty texts have no ids and decode to the empty text; blanks
of any number, markers in the text itself, and characters outside the vocabulary
follow the library; repeated rows get a row each; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmill.llm.common import map_rows, once_a_worker, texts

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


class ChunkTable:
    """Chunk (without its first marker) -> ids. ``most`` bounds the table; a full one
    starts anew, which costs time only."""

    def __init__(self, model_path: str, most: int = 200_000):
        self.model, self.by_chunk = once_a_worker(f"pieces {model_path}", lambda: self.load(model_path))
        self.most = most
        self.ids: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def load(model_path: str) -> tuple:
        """The model, and whether its pieces stay within chunks."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        within = not any(re.search(f"[^{MARK}]{MARK}", model.id_to_piece(i)) for i in range(model.get_piece_size()))
        plain = model.encode("a b") == model.encode(f"a{MARK}b") and model.encode("a  b ") != model.encode("a b")
        return model, within and plain

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [c[1:] for c in CHUNK.findall(MARK + text.replace(" ", MARK))]

    def learn(self, chunks: Iterable[str]) -> None:
        met = set(chunks)
        new = list(met.difference(self.ids))
        if len(self.ids) + len(new) > self.most:
            self.ids.clear()
            new = list(met)
        some = [c for c in new if c]
        self.ids.update(zip(some, map(tuple, self.model.encode(some, num_threads=1))))
        self.ids[""] = (self.model.piece_to_id(MARK),)

    def encode(self, text: list[str]) -> list[list[int]]:
        if not self.by_chunk:
            return self.model.encode(text, num_threads=1) if text else []
        split = [self.chunks(t) for t in text]
        self.learn(chain.from_iterable(split))
        ids = self.ids.__getitem__
        return [list(chain.from_iterable(map(ids, c))) for c in split]

    def encode_with_decimal(self, text: list[str]) -> list[tuple[list[int], str]]:
        """The ids and their decimal text, joined by commas."""
        return [(i, ",".join(map(str, i))) for i in self.encode(text)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return [self.model.decode(i) if i else "" for i in ids]


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids for every row."""

    def make():
        model = ChunkTable(model_path)
        return lambda ids, text: {"doc_id": ids, "ids": model.encode(text)}

    return map_rows(texts(docs), make, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text for rows of doc_id, ids."""

    def make():
        model = ChunkTable(model_path)
        return lambda doc_id, ids: {"doc_id": doc_id, "text": model.decode([i or [] for i in ids])}

    return map_rows(encoded.select("doc_id", "ids"), make, "doc_id long, text string")


def encoded_and_decoded(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded for every row: both directions in one pass."""

    def make():
        model = ChunkTable(model_path)

        def fn(doc_id, text):
            ids = model.encode(text)
            return {"doc_id": doc_id, "n_tokens": [len(i) for i in ids], "ids": ids, "decoded": model.decode(ids)}

        return fn

    return map_rows(texts(docs), make, "doc_id long, n_tokens long, ids array<int>, decoded string")


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of the ids (decimal, joined
    by commas) and of the decoded text."""
    return encoded_and_decoded(docs, model_path).select(
        "doc_id", "n_tokens", F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
