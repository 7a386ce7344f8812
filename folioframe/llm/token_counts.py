"""Token counts under a unigram vocabulary, without building tokens.

A word is marked by U+2581 before it and segmented for itself. Aho-Corasick lists every vocabulary piece in it; dynamic
programming over the end positions carries the best score and the piece count of that path. Ties go as in the
``tokenizers`` library's Unigram model: starts are tried in order and a later one must be strictly better, so of equal
paths the one whose last piece is longest stays. A character that is no piece may be taken as unknown at the smallest score
less 10, and neighbouring unknown characters count as one token.

Whole texts (``whole``) keep their white space: a blank becomes U+2581, one stands before the text, and an unknown character
costs its UTF-8 bytes where the file has the byte pieces, as the library's ``byte_fallback`` does. No piece then crosses from
another character to U+2581 or holds a line break, so chunks between such places are counted for themselves; a vocabulary
with other pieces is run over the text at once.

One stage without a shuffle; each worker keeps the counts of words it has seen in a cache of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textsets import as_bytes

#: Words whose counts a worker keeps.
CACHE_WORDS = 400_000
MARK = "▁"
#: Penalty of an unknown character below the smallest score: a fixed value of the tokenizer.
UNKNOWN_PENALTY = 10.0
#: Blanks and what follows them up to the next blank or line break.
CHUNK = re.compile(rb" *[^ \n]+| +")


def load_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file; control, unknown and byte pieces, which match no text, are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


def has_byte_pieces(path: str) -> bool:
    """Whether the file has a piece for each of the 256 bytes."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return sum(map(sp.is_byte, range(sp.get_piece_size()))) == 256


class Counter(dict):
    """word or chunk (bytes) -> number of pieces, computed when it is first asked for."""

    def __init__(self, vocabulary: list[tuple[str, float]], cache_words: int = CACHE_WORDS, byte_fallback: bool = False):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary:
            self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.cache_words, self.byte_fallback = cache_words, byte_fallback
        self.in_chunks = byte_fallback and not any("\n" in p or MARK in p.lstrip(MARK) for p, _ in vocabulary)

    def pieces(self, text: str) -> int:
        """Pieces of the best path through ``text``."""
        n = len(text)
        best, count, open_unknown = [None] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        best[0] = 0.0
        end = 0
        # Matches come by end; those of one end from the longest to the shortest, that is by rising start.
        matches = self.automaton.iter(text) if len(self.automaton) else iter(())
        at, (size, score) = next(matches, (n, (0, 0.0)))
        while end < n:
            single = False
            while at == end:
                start = end + 1 - size
                value = best[start] + score
                if best[end + 1] is None or value > best[end + 1]:
                    best[end + 1], count[end + 1] = value, count[start] + 1
                if size == 1:
                    single = True
                at, (size, score) = next(matches, (n, (0, 0.0)))
            if not single:
                value = best[end] + self.unknown
                if best[end + 1] is None or value > best[end + 1]:
                    cost = len(text[end].encode("utf-8", "replace")) if self.byte_fallback else not open_unknown[end]
                    best[end + 1], count[end + 1], open_unknown[end + 1] = value, count[end] + cost, True
            end += 1
        return count[n]

    def __missing__(self, word: bytes) -> int:
        text = word.decode("utf-8", "replace")
        n = self.pieces(text.replace(" ", MARK) if self.in_chunks else MARK + text)
        if len(self) >= self.cache_words:
            self.clear()
        self[word] = n
        return n

    def count(self, text: bytes) -> int:
        return sum(map(self.__getitem__, text.split()))

    def count_whole(self, text: bytes) -> int:
        """Pieces of the text with its white space."""
        if not text:
            return 0
        if not self.in_chunks:
            return self.pieces(MARK + text.decode("utf-8", "replace").replace(" ", MARK))
        return text.count(b"\n") + sum(map(self.__getitem__, CHUNK.findall(b" " + text.replace(MARK.encode(), b" "))))


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", cache_words: int = CACHE_WORDS, whole: bool = False) -> DataFrame:
    """(id, n_tokens) of every row, of its words or of the whole text. Null and empty texts have 0 tokens, and blank ones 0 words; repeated rows each get theirs; an empty table gives no rows; other columns aren't read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = count = None
        for b in batches:
            if counter is None:
                counter = Counter(load_vocabulary(vocabulary_path), cache_words, whole and has_byte_pieces(vocabulary_path))
                count = counter.count_whole if whole else counter.count
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([count(as_bytes(t)) for t in b.column(1)], pa.int64())], names=["_id", "n_tokens"])

    rows = docs.select(docs[id_col].cast("long").alias("_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_t"))
    return rows.mapInArrow(run, "_id long, n_tokens long").withColumnRenamed("_id", id_col)
