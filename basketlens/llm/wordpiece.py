"""Token counts by greedy longest match, with a linear automaton.

The vocabulary is a trie of byte strings whose nodes carry a failure link and the number of tokens popped when the
link is taken, both computed once. Reading a word follows one edge or a chain of links per byte, links only ever
shorten what is held, so a word costs time linear in its length and no piece is ever built.

Words are `[^\\x20\\x09-\\x0D]+`. A word begins with the marker byte sequence (here a space, as the public vocabulary
marks word beginnings), so pieces with the marker match only at the start of a word and the others only inside it.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from basketlens.llm.byte_bpe import read_ranks
from basketlens.llm.common import prepare, texts

#: Distinct words that a worker remembers before it starts anew, and the longest it remembers.
MEMO, MEMO_BYTES = 500_000, 64


class Matcher:
    """Counts the tokens that repeated longest match from the left takes from a word.

    ``pieces`` match inside a word and, if they begin with ``marker``, at its start. A word that longest match can't
    cover counts as one unknown token, as usual for word pieces; with all single bytes in the vocabulary there is none.
    """

    def __init__(self, pieces: list[bytes], marker: bytes = b" "):
        self.marker = marker
        self.edges: list[dict[int, int]] = [{}, {}]  # the trie of word starts at 0, of continuations at 1
        self.link, self.popped, self.ends = [-1, -1], [0, 0], [False, False]
        for piece in pieces:
            if piece == marker:  # the marker alone is a piece: what stands at the start can be given up for it
                self.link[0], self.popped[0] = 1, 1
            elif piece.startswith(marker):
                self.insert(0, piece[len(marker):])
            elif piece:
                self.insert(1, piece)
        self.link_up()
        self.memo: dict[bytes, int] = {}

    def insert(self, root: int, piece: bytes) -> None:
        node = root
        for byte in piece:
            if byte not in self.edges[node]:
                self.edges[node][byte] = len(self.edges)
                self.edges.append({})
                self.link.append(-1), self.popped.append(0), self.ends.append(False)
            node = self.edges[node][byte]
        self.ends[node] = True

    def link_up(self) -> None:
        """Failure link and popped tokens of each node, parents before children.

        A node that ends a piece pops that piece and goes to the continuation root. Any other goes where its parent's
        link leads with the same byte, taking further links until an edge fits; a chain that breaks has no link.
        """
        queue = deque([0, 1])
        while queue:
            node = queue.popleft()
            for byte, child in self.edges[node].items():
                if self.ends[child]:
                    self.link[child], self.popped[child] = 1, 1
                else:
                    at, popped = self.link[node], self.popped[node]
                    while at >= 0 and byte not in self.edges[at]:
                        popped += self.popped[at]
                        at = self.link[at]
                    if at >= 0:
                        self.link[child], self.popped[child] = self.edges[at][byte], popped
                queue.append(child)

    def count(self, word: bytes) -> int:
        """Tokens of one word, without its marker."""
        node, tokens = 0, 0
        edges, link, popped = self.edges, self.link, self.popped
        for byte in word:
            while byte not in edges[node]:
                tokens += popped[node]
                node = link[node]
                if node < 0:
                    return 1
            node = edges[node][byte]
        while word and node != 1:
            tokens += popped[node]
            node = link[node]
            if node < 0:
                return 1
        return tokens

    def count_text(self, text: bytes) -> tuple[int, int]:
        """Words and tokens of a text."""
        words = text.split()  # of bytes: at \x20 and \x09-\x0D, nothing else
        memo, total = self.memo, 0
        if len(memo) > MEMO:
            memo.clear()
        for word in words:
            n = memo.get(word)
            if n is None:
                n = self.count(word)
                if len(word) <= MEMO_BYTES:
                    memo[word] = n
            total += n
        return len(words), total


_loaded: dict[tuple[int, bytes], Matcher] = {}


def loaded(rank_file: bytes, marker: bytes) -> Matcher:
    key = (hash(rank_file), marker)
    if key not in _loaded:
        _loaded[key] = Matcher([base64.b64decode(line.split()[0]) for line in rank_file.splitlines() if line], marker)
    return _loaded[key]


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 marker: bytes = b" ") -> DataFrame:
    """doc_id, n_words, n_tokens for every row.

    A null or empty text has no words and no tokens. Null and repeated doc_ids stay as they are, one row for each
    input row; an empty table gives no rows; other columns are ignored. Texts are read whole, words of any length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = loaded(shared.value, marker)
        for batch in batches:
            found = [matcher.count_text(t.encode("utf-8", "replace")) for t in batch.column(1).to_pylist()]
            words, tokens = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_words", "n_tokens"])

    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, n_words bigint, n_tokens bigint")
