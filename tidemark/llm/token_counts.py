"""Unigram token counts with prefixes shared in a trie.

A text is cut at white space; every word, led by the mark for a word's start, is
a pre-token.  Its tokens are the pieces of a vocabulary with the largest sum of
scores (Viterbi).  The forward score at a position depends only on the letters
before it, so distinct pre-tokens are inserted in a trie whose nodes hold the
best score and its token count: a shared prefix is scored once, and the count
at a word's last node is the count of the word.

The pieces come from a public vocabulary.  That vocabulary ranks pieces and has
no probabilities, so a piece of rank ``r`` scores ``-log(r + 1)`` (Zipf's law); any
other scores can be given.  A character outside the vocabulary costs one token
per UTF-8 byte, below the score of every piece.

Counting needs no shuffle.  Each task has its own trie; beyond ``MOST_NODES``
nodes it starts anew, and letters after the first ``DEPTH`` of a word are scored
without being stored, so memory is bounded and results are the same.

Defined results: null and empty texts have no pre-token and no token; equal
scores go to fewer tokens; repeated rows count alike; empty tables give no rows.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

MARK = "▁"
DEPTH = 64
MOST_NODES = 600_000
MOST_WORDS = 600_000


def zipf_scores(model_file: str) -> dict[str, float]:
    """The plain pieces of a sentencepiece vocabulary by rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    plain = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return {piece: -math.log(rank + 1) for rank, piece in enumerate(plain, 1)}


class Trie:
    """Forward scores of the prefixes of all pre-tokens seen."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.byte = min(scores.values(), default=0.0) - 1.0
        # Every end of a piece, with its score if it is one itself: what is not here ends no piece.
        self.ends = {p[i:]: None for p in scores for i in range(len(p))} | scores
        self.clear()

    def clear(self) -> None:
        self.root: list = [0.0, 0, None]  # best score, its tokens, nodes by letter
        self.nodes = 1

    def _extend(self, word: str, path: list, end: int) -> tuple[float, int]:
        """Best score and tokens of ``word[:end]``, given those of all its prefixes in ``path``."""
        ends = self.ends
        score, tokens = -math.inf, 0
        if word[end - 1] not in self.scores:
            size = len(word[end - 1].encode("utf-8", "surrogatepass"))
            score, tokens = path[end - 1][0] + self.byte * size, path[end - 1][1] + size
        for start in range(end - 1, -1, -1):
            part = word[start:end]
            if part not in ends:
                break
            piece = ends[part]
            if piece is not None:
                total = path[start][0] + piece
                if total >= score:
                    count = path[start][1] + 1
                    if total > score or count < tokens:
                        score, tokens = total, count
        return score, tokens

    def count(self, word: str) -> int:
        """Tokens of one pre-token."""
        if self.nodes > MOST_NODES:
            self.clear()
        node, path = self.root, [self.root]
        for end, letter in enumerate(word[:DEPTH], 1):
            nodes = node[2]
            if nodes is None:
                nodes = node[2] = {}
            node = nodes.get(letter)
            if node is None:
                node = nodes[letter] = [*self._extend(word, path, end), None]
                self.nodes += 1
            path.append(node)
        for end in range(DEPTH + 1, len(word) + 1):
            path.append(self._extend(word, path, end))
        return path[-1][1]


class Counts(dict):
    """Tokens of the words seen, bounded; an unknown word is looked up in the trie."""

    def __init__(self, scores: dict[str, float]):
        self.trie = Trie(scores)

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        found = self[word] = self.trie.count(MARK + word.decode("utf-8", "replace"))
        return found


def token_counts(docs: DataFrame, scores: dict[str, float]) -> DataFrame:
    """``doc_id``, ``n_pretokens`` and ``n_tokens`` of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    vocabulary = docs.sparkSession.sparkContext.broadcast(scores)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Counts(vocabulary.value)
        gc.disable()  # a trie has no cycles, but millions of nodes to walk over
        try:
            for batch in slices(batches):
                words, tokens = [], []
                for text in batch.column(1).to_pylist():
                    found = (text or b"").split()  # bytes split at the six white-space characters
                    words.append(len(found))
                    tokens.append(sum(map(known.__getitem__, found)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.array(words, np.int64)), pa.array(np.array(tokens, np.int64))],
                    ["doc_id", "n_pretokens", "n_tokens"],
                )
        finally:
            gc.enable()

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        run, f"doc_id {kind}, n_pretokens long, n_tokens long"
    )
