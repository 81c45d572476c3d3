"""Token counts under a unigram vocabulary by dynamic programming on a trie of pre-tokens.

A pre-token is a word [^\\x20\\x09-\\x0D]+ with the vocabulary's word mark before it; its tokens are the pieces of its most
probable division. The forward score of a prefix does not depend on what follows, so the distinct pre-tokens are put in
a trie and each node's score is computed once, from its ancestors' scores and the pieces that end there; the node where a
pre-token ends keeps its number of tokens. A document's count is the sum over its pre-tokens.

The vocabulary file has merge ranks and no probabilities; a piece of rank r gets the Zipf log-probability -log(r + 1).
Characters that no piece covers fall back to their UTF-8 bytes, one token each, at `BYTE` below the last rank's. Equal
scores go to the division with fewer tokens.

Documents are counted where they are read: nothing is shuffled. A worker's trie is dropped when it has `NODES` nodes, which
bounds memory and costs repeated work only. Null and empty texts have no tokens. Repeated rows give repeated results.
Only `doc_id` and `text` are read. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from turnlake.llm.words import batches, id_type, record, schema, text_bytes

NODES = 600_000
BYTE = 10.0
MARK = "▁"


class Vocabulary:
    """Pieces with log-probabilities from a sentencepiece file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [
            model.id_to_piece(i)
            for i in range(model.get_piece_size())
            if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.scores = {piece: -math.log(rank + 1) for rank, piece in enumerate(usable, 1)}
        self.longest = max(map(len, usable), default=1)
        self.byte = -math.log(len(usable) + 1) - BYTE


class Trie:
    """Prefixes of the inserted pre-tokens with their best forward score and its number of tokens."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.child: dict[tuple[int, str], int] = {}
        self.score, self.tokens = [0.0], [0]

    def __len__(self) -> int:
        return len(self.score)

    def _reach(self, text: str, end: int, path: list[int]) -> tuple[float, int]:
        """Best score of text[:end] from the scores along the path."""
        pieces, score, tokens = self.vocabulary.scores, self.score, self.tokens
        n_bytes = len(text[end - 1].encode())
        before = path[end - 1]
        best = (score[before] + n_bytes * self.vocabulary.byte, -(tokens[before] + n_bytes))
        for begin in range(max(0, end - self.vocabulary.longest), end):
            its = pieces.get(text[begin:end])
            if its is not None:
                at = path[begin]
                found = (score[at] + its, -(tokens[at] + 1))
                if found > best:
                    best = found
        return best[0], -best[1]

    def insert(self, text: str) -> int:
        """Number of tokens of the text."""
        path, node, child = [0], 0, self.child
        for end, letter in enumerate(text, 1):
            key = (node, letter)
            node = child.get(key)
            if node is None:
                best, tokens = self._reach(text, end, path)
                node = child[key] = len(self.score)
                self.score.append(best)
                self.tokens.append(tokens)
            path.append(node)
        return self.tokens[node]


class Counter:
    """Counts texts and remembers the terminal counts of the trie's pre-tokens."""

    def __init__(self, path: str, nodes: int = NODES) -> None:
        self.vocabulary, self.nodes = Vocabulary(path), nodes
        self.trie, self.known = Trie(self.vocabulary), {}

    def counts(self, texts: list[bytes]) -> tuple[list[int], list[int]]:
        """(pre-tokens, tokens) of each text."""
        words = [t.split() for t in texts]
        if len(self.trie) > self.nodes or len(self.known) > self.nodes:
            self.trie, self.known = Trie(self.vocabulary), {}
        known = self.known
        for word in sorted(set().union(*words) - known.keys()):
            known[word] = self.trie.insert(MARK + word.decode())
        return [len(w) for w in words], [sum(map(known.__getitem__, w)) for w in words]


@functools.cache
def counter(path: str) -> Counter:
    """One for each Python worker, kept over tasks."""
    return Counter(path)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id, n_pre_tokens, n_tokens` for every row."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches(stream, 500):
            words, tokens = count.counts(batch.column(1).to_pylist())
            yield record({"doc_id": batch.column(0), "n_pre_tokens": pa.array(words, pa.int64()), "n_tokens": pa.array(tokens, pa.int64())})

    fields = schema(("doc_id", id_type(docs)), ("n_pre_tokens", "bigint"), ("n_tokens", "bigint"))
    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(run, fields)
