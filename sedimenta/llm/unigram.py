"""Operator 6: counting the tokens of a unigram tokenizer without making them.

An Aho-Corasick automaton over the vocabulary lists all pieces that end at
each character; dynamic programming carries the best score and the number of
pieces of the best path (Viterbi, counts only).  Ties and unknown characters
follow the tokenizers' own rule:

* of paths with equal scores the one whose last piece is longer stays (paths
  are tried from the earliest start, and only a strictly better one replaces);
* a character that is no piece itself may be unknown, at the lowest score less
  ``UNKNOWN_PENALTY``; with byte pieces it counts one token per UTF-8 byte,
  without them a run of unknown characters is one token.

Spaces become the mark U+2581 and one is put in front.  No piece has the mark
behind another character, and none holds a line break, so texts fall apart at
these places, and each worker remembers the counts of short segments.  That is
exact when sums of scores are exact, as for whole-number scores.
"""

from __future__ import annotations

import re
from functools import partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from sedimenta.llm.store import column

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0
MARK = "▁"
# Segments remembered by a worker; then it starts over.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 48
_SEGMENT = re.compile("\n|" + MARK + "*[^" + MARK + "\n]+|" + MARK + "+")


class Vocabulary:
    """Pieces with scores; ``bytes_known``: characters without a piece become bytes."""

    def __init__(self, pieces: list[tuple[str, float]], bytes_known: bool):
        self.pieces, self.bytes_known = pieces, bytes_known

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        """Normal pieces and scores of a sentencepiece file."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = lambda i: model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        return cls([(model.id_to_piece(i), model.get_score(i)) for i in ids if not special(i)],
                   any(model.is_byte(i) for i in ids))


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.bytes_known = vocabulary.bytes_known
        self.single = {p for p, _ in vocabulary.pieces if len(p) == 1}
        pieces = [p for p, _ in vocabulary.pieces]
        self.splits = not any("\n" in p or MARK in p.lstrip(MARK) for p in pieces)
        self.known: dict[str, int] = {}

    def segment(self, text: str) -> int:
        """Tokens of the best path through a text, by ends of pieces."""
        n = len(text)
        score, count, fused = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        found = [None] * (n + 1)
        for last, piece in self.automaton.iter(text):
            at = found[last + 1]
            if at is None:
                found[last + 1] = [piece]
            else:
                at.append(piece)
        for end in range(1, n + 1):
            best = None
            # Longest piece first, which is the earliest start.
            for size, own in sorted(found[end] or (), reverse=True):
                total = score[end - size] + own
                if best is None or total > best:
                    best, count[end] = total, count[end - size] + 1
            char = text[end - 1]
            if char not in self.single:
                total = score[end - 1] + self.unknown
                if best is None or total > best:
                    best = total
                    new = len(char.encode("utf-8")) if self.bytes_known else int(not fused[end - 1])
                    count[end], fused[end] = count[end - 1] + new, True
            score[end] = best
        return count[n]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        text = MARK + text.replace(" ", MARK)
        if not self.splits:
            return self.segment(text)
        known, total = self.known, 0
        for s in _SEGMENT.findall(text):
            n = known.get(s)
            if n is None:
                n = self.segment(s)
                if len(s) <= LONGEST_REMEMBERED:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[s] = n
            total += n
        return total


_counters: dict = {}


def _count(batches, shared):
    counter = _counters.get(shared.value[2])
    if counter is None:
        counter = _counters[shared.value[2]] = Counter(Vocabulary(*shared.value[:2]))
    for batch in batches:
        texts = batch.column(1)
        n = [counter.text(texts[i].as_py()) for i in range(len(texts))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])


def token_counts(docs: DataFrame, vocabulary: Vocabulary | None = None, path: str = MODEL) -> DataFrame:
    """``(doc_id, n_tokens)`` per row of ``docs(doc_id, text)``.

    NULL and empty texts have none.  Rows are counted one by one: repeated
    rows, NULL ids and any length of text are fine; other columns are ignored.
    The vocabulary is sent to the executors once; its size does not depend on
    the texts.
    """
    vocabulary = vocabulary or Vocabulary.load(path)
    value = (vocabulary.pieces, vocabulary.bytes_known)
    shared = docs.sparkSession.sparkContext.broadcast((*value, hash((tuple(vocabulary.pieces), vocabulary.bytes_known))))
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    return texts.mapInArrow(partial(_count, shared=shared), "doc_id long, n_tokens long")
