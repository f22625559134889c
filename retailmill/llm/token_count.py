"""Greedy word-piece token counts by one automaton pass, without building pieces.

The vocabulary is a trie whose nodes have a failure link each and a number of tokens
"popped" when the link is followed: when a word's next symbol has no edge, the longest
pieces known to be final are counted, and matching goes on from what is left of the
word, which is again a trie node. Every symbol is read once. The popped counts are
computed with the links, so nothing but numbers is kept.

A word is a run of characters that are not ASCII whitespace; its symbols are UTF-8
bytes. Pieces that begin a word carry a marker, pieces that go on do not (a space
marker before the word is the marker here). A word with no segmentation counts as one
unknown token.

Defined cases: null and empty texts have no tokens; a word of any length is one pass;
repeated rows get a row each; other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections import deque

from pyspark.sql import DataFrame

from retailmill.llm.common import map_rows, once_a_worker, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Automaton:
    """``begins``: pieces for the beginning of a word, ``inner``: pieces after it."""

    def __init__(self, begins: list[bytes], inner: list[bytes]):
        self.edges: list[dict[int, int]] = [{}, {}]
        self.final: list[bool] = [False, False]
        self.root, self.inner_root = 0, 1
        for root, pieces in ((0, begins), (1, inner)):
            for piece in pieces:
                at = root
                for symbol in piece:
                    nxt = self.edges[at].get(symbol)
                    if nxt is None:
                        nxt = self.edges[at][symbol] = len(self.edges)
                        self.edges.append({})
                        self.final.append(False)
                    at = nxt
                self.final[at] |= at > 1
        # link[v]: node for what is left of v's string once its longest pieces are taken
        # off, -1 if none; popped[v]: how many pieces that takes
        self.link = [-1] * len(self.edges)
        self.popped = [0] * len(self.edges)
        queue = deque([0, 1])
        while queue:
            v = queue.popleft()
            for symbol, child in self.edges[v].items():
                if self.final[child]:
                    self.link[child], self.popped[child] = self.inner_root, 1
                else:
                    z, n = self.link[v], self.popped[v]
                    while z >= 0 and symbol not in self.edges[z]:
                        z, n = self.link[z], n + self.popped[z]
                    if z >= 0:
                        self.link[child], self.popped[child] = self.edges[z][symbol], n
                queue.append(child)

    def tokens(self, word: bytes) -> int:
        """Greedy longest-match pieces of a word; 1 if they do not cover it."""
        edges, link, popped = self.edges, self.link, self.popped
        at, n = self.root, 0
        for symbol in word:
            while symbol not in edges[at]:
                if link[at] < 0:
                    return 1
                n, at = n + popped[at], link[at]
            at = edges[at][symbol]
        while at != self.inner_root:  # the end of the word pops what is left
            if link[at] < 0:
                return 1
            n, at = n + popped[at], link[at]
        return n


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins for bytes in byte-level vocabulary files: a printable Latin-1
    character stands for its own byte, the other bytes follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def from_byte_vocabulary(path: str) -> Automaton:
    """Pieces of a byte-level vocabulary file; those that begin with a space begin words."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    alphabet = byte_alphabet()
    pieces = [bytes(alphabet[c] for c in p) for p in vocabulary if all(c in alphabet for c in p)]
    begins = [p[1:] for p in pieces if p[:1] == b" " and len(p) > 1]
    inner = [p for p in pieces if p[:1] != b" "]
    # a lone marker lets any inner piece begin a word, at the cost of one more token
    return Automaton([b" " + p for p in begins] + [b" "], inner)


class Counts:
    """Counts of words met, kept for a bounded number of words."""

    def __init__(self, path: str, most: int = 300_000):
        self.automaton, self.known, self.most = from_byte_vocabulary(path), {}, most

    def __call__(self, text: str) -> tuple[int, int]:
        words = WORD.findall(text)
        known = self.known
        new = set(words).difference(known)
        if new:
            if len(known) + len(new) > self.most:
                known.clear()
                new = set(words)
            tokens = self.automaton.tokens
            known.update((w, tokens(b" " + w.encode())) for w in new)
        return len(words), sum(map(known.__getitem__, words))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words, n_tokens for every row."""

    def make():
        count = once_a_worker(f"word pieces {path}", lambda: Counts(path))

        def fn(ids, text):
            got = [count(t) for t in text]
            return {"doc_id": ids, "n_words": [w for w, _ in got], "n_tokens": [n for _, n in got]}

        return fn

    return map_rows(texts(docs), make, "doc_id long, n_words long, n_tokens long")
