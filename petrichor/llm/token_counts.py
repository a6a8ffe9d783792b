"""Token counts under a unigram vocabulary, by forward scores that words share along a trie."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from petrichor.llm.arrow import slices, split_words, sums

#: The mark that this vocabulary sets before a word (fixed value of the file).
WORD_MARK = "▁"


class Pieces:
    """Log probabilities of the pieces of a vocabulary file.

    The file ranks its pieces by frequency and carries no probabilities, so they follow from the
    rank by Zipf's law: -log(rank + 2.7), normalised. A character without a piece costs a byte
    token per UTF-8 byte, each as improbable as the last piece.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [
            model.id_to_piece(i)
            for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        total = math.log(sum(1 / (rank + 2.7) for rank in range(len(plain))))
        self.scores = {piece: -math.log(rank + 2.7) - total for rank, piece in enumerate(plain)}
        self.byte_score = min(self.scores.values())
        lengths: dict[str, set[int]] = {}
        for piece in plain:
            lengths.setdefault(piece[-2:], set()).add(len(piece))
        self.lengths = {end: tuple(sorted(found)) for end, found in lengths.items()}


def terminal_counts(words: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and byte tokens of each word on its best path.

    In sorted order the words visit their trie depth first. ``best``, ``tokens`` and ``loose`` are
    the forward scores on the path from the root to the current node; a word reuses them as far as
    it shares the path with the word before, so each node of the trie is scored once. Among equal
    scores the path with the longer last piece wins.
    """
    counts = np.zeros(len(words), np.int64)
    bytes_left = np.zeros(len(words), np.int64)
    best, tokens, loose = [0.0], [0], [0]
    last = ""
    scores, lengths, byte_score = pieces.scores, pieces.lengths, pieces.byte_score
    for at in sorted(range(len(words)), key=words.__getitem__):
        word = WORD_MARK + words[at]
        shared = 0
        for a, b in zip(word, last):
            if a != b:
                break
            shared += 1
        del best[shared + 1 :], tokens[shared + 1 :], loose[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            n = len(word[end - 1].encode("utf-8", "surrogatepass"))
            top, back, extra, bare = best[end - 1] + n * byte_score, end - 1, n, n
            one = scores.get(word[end - 1 : end])
            if one is not None:
                top, extra, bare = best[end - 1] + one, 1, 0
            if end > 1:
                for size in lengths.get(word[end - 2 : end], ()):
                    if size > end:
                        break
                    score = scores.get(word[end - size : end])
                    if score is not None and best[end - size] + score >= top:
                        top, back, extra, bare = best[end - size] + score, end - size, 1, 0
            best.append(top)
            tokens.append(tokens[back] + extra)
            loose.append(loose[back] + bare)
        counts[at], bytes_left[at] = tokens[-1], loose[-1]
        last = word
    return counts, bytes_left


def token_counts(docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens and n_byte_tokens of every row.

    Words of a bounded slice of text are made distinct, sorted into a trie and scored there; the
    counts found at its terminals go back to the documents of the slice. Nothing is shuffled and
    no table of words outgrows a slice.

    Null and empty texts have no words and no tokens; repeated rows and null ids are counted row
    by row; other columns are not read. An empty table gives no rows.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(vocabulary)
        for part in slices(batches, most=16 << 20):
            codes, offsets, words = split_words(part.column(1))
            counts, loose = terminal_counts(words.to_pylist(), pieces)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(sums(counts[codes], offsets), pa.int64()),
                    pa.array(sums(loose[codes], offsets), pa.int64()),
                ],
                ["doc_id", "n_words", "n_tokens", "n_byte_tokens"],
            )

    kept = docs.select(docs[id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return kept.mapInArrow(count, "doc_id long, n_words long, n_tokens long, n_byte_tokens long")
