"""Token counts of documents under a unigram vocabulary, by dynamic programming along a trie.

A pre-token is a word with the vocabulary's word mark before it. Its segmentation is the one with the greatest
sum of scores, and among those with the fewest tokens. The best score of a prefix depends on nothing after it,
so words that begin alike share that work: the sorted distinct words of a slice are the trie of these words in
depth-first order, each node's score is computed once and kept on the path, and a node where a word ends stores
the word's count. A character outside the vocabulary costs one token per UTF-8 byte.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.words import text_slices

WORD_MARK = "▁"
# Fixed value: how much worse than the worst piece an unknown character is.
UNKNOWN_PENALTY = 10.0

SCHEMA = "doc_id long, n_words long, n_tokens long"


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[str, float]:
    """Ordinary pieces of a sentencepiece model with their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        and model.get_score(i) > -1e8
    }


class TrieCounter:
    """Token counts of many words at once."""

    def __init__(self, scores: dict[str, float]):
        self._scores = scores
        self._unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self._suffixes = {piece[i:] for piece in scores for i in range(len(piece))}

    def counts(self, words: Iterable[str]) -> dict[str, int]:
        """Tokens of each distinct word; the word mark is put in front here."""
        scores, suffixes, unknown = self._scores, self._suffixes, self._unknown
        best: list[tuple[float, int]] = [(0.0, 0)]  # along the path: sum of scores, minus the number of tokens
        found, before = {}, ""
        for word in sorted(set(words)):
            marked = WORD_MARK + word
            shared = 0
            for a, b in zip(before, marked):
                if a != b:
                    break
                shared += 1
            del best[shared + 1:]
            for end in range(shared + 1, len(marked) + 1):
                top = None
                for start in range(end - 1, -1, -1):
                    piece = marked[start:end]
                    if piece not in suffixes:
                        break
                    score = scores.get(piece)
                    if score is not None:
                        total, tokens = best[start]
                        option = (total + score, tokens - 1)
                        if top is None or option > top:
                            top = option
                char = marked[end - 1]
                if char not in scores:
                    total, tokens = best[end - 1]
                    option = (total + unknown, tokens - len(char.encode()))
                    if top is None or option > top:
                        top = option
                best.append(top)
            found[word] = -best[-1][1]
            before = marked
        return found


def token_counts(documents: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_words, n_tokens`` of every document. A NULL or empty text has no words and no tokens.

    Rows are counted where they are read: nothing is shuffled, and a task holds the words of one slice. Repeated
    rows are counted each; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TrieCounter(vocabulary(model_path))
        for batch, texts in text_slices(batches):
            words = [x.split() for x in texts]
            distinct = {w for own in words for w in own}
            found = counter.counts(w.decode("utf-8", "replace") for w in distinct)
            tokens = {w: found[w.decode("utf-8", "replace")] for w in distinct}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(own) for own in words], pa.int64()),
                    pa.array([sum(map(tokens.__getitem__, own)) for own in words], pa.int64()),
                ],
                ["doc_id", "n_words", "n_tokens"],
            )

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
