"""Token counts by a count-only Viterbi over a unigram vocabulary.

A vocabulary file gives pieces with scores. A text is cut at spaces into words that carry the
space mark, as a metaspace pre-tokenizer does. In each word an Aho-Corasick automaton lists
every piece that ends at each letter, longest first; dynamic programming keeps for each letter
only the best score and the number of pieces that reach it, never the pieces themselves. Ties
follow the unigram tokenizer: a later candidate replaces one that ends at the same letter only
with a strictly larger score, and candidates come in order of their start, so of equal ones the
one whose last piece is longest stays. A letter that is no piece costs ten less than the lowest
score and counts as its UTF-8 bytes where the vocabulary has byte pieces, otherwise a run of
such letters counts as one.

Every word is scored once per worker as long as a bounded table of words holds it; the table
saves time only and changes no result.
"""

from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wellspring.llm.common import and_fields

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words kept with their counts in a worker; the table is emptied when half full.
REMEMBERED = 800_000
#: Characters of one text that are cut into words at once.
SPAN = 1 << 20


def pieces_of(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model file, in order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter(dict):
    """Word (without its mark) to its row in ``counts`` and ``scores``; a word is worked out
    when first asked for."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: int = 0):
        super().__init__()
        self.counts, self.scores = np.zeros(REMEMBERED, np.int64), np.zeros(REMEMBERED)
        self.automaton = ahocorasick.Automaton()
        for number, (piece, score) in enumerate(vocabulary):
            if piece and number != unknown:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for number, (piece, _) in enumerate(vocabulary) if len(piece) == 1 and number != unknown}
        named = {piece for piece, _ in vocabulary}
        self.bytes = all(f"<0x{b:02X}>" in named for b in range(256))
        self.unknown_score = min(score for _, score in vocabulary) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> int:
        row = len(self)
        marked = MARK + word
        known = self.single.issuperset(marked)
        self.counts[row], self.scores[row] = self.plain(marked) if known else self.best(marked)
        self[word] = row
        return row

    def plain(self, word: str) -> tuple[int, float]:
        """``best`` for a word whose letters are all pieces."""
        score, count = [0.0] + [-np.inf] * len(word), [0] * (len(word) + 1)
        for end, (length, worth) in self.automaton.iter(word):
            reached = score[end + 1 - length] + worth
            if reached > score[end + 1]:
                score[end + 1], count[end + 1] = reached, count[end + 1 - length] + 1
        return count[-1], score[-1]

    def best(self, word: str) -> tuple[int, float]:
        size = len(word)
        score: list = [0.0] + [None] * size
        count = [0] * (size + 1)
        unknown = [False] * (size + 1)
        ends: list[list] = [[] for _ in range(size)]
        for end, match in self.automaton.iter(word):
            ends[end].append(match)
        for at in range(size):
            best, pieces, last_unknown = None, 0, False
            for length, worth in ends[at]:
                begin = at + 1 - length
                if (reached := score[begin]) is not None and (best is None or reached + worth > best):
                    best, pieces = reached + worth, count[begin] + 1
            letter = word[at]
            if letter not in self.single:
                reached = score[at] + self.unknown_score
                if best is None or reached > best:
                    best, last_unknown = reached, True
                    if self.bytes:
                        pieces = count[at] + len(letter.encode())
                    else:
                        pieces = count[at] + (not unknown[at])
            score[at + 1], count[at + 1], unknown[at + 1] = best, pieces, last_unknown
        return count[size], score[size]

    def text(self, text: str) -> tuple[int, float]:
        """(pieces, score) of a whole text; an empty one has neither."""
        if not text:
            return 0, 0.0
        total, worth, at = 0, 0.0, 0
        while at < len(text):
            end = len(text)
            if end - at > SPAN:
                end = min((p for c in (" ", MARK) if (p := text.find(c, at + SPAN)) > 0), default=end)
            words = text[at:end].replace(MARK, " ").split(" ")
            if not words[0] and len(words) > 1:
                words = words[1:]
            for first in range(0, len(words), REMEMBERED // 2):
                if len(self) > REMEMBERED // 2:
                    self.clear()
                asked = words[first : first + REMEMBERED // 2]
                rows = np.fromiter(map(self.__getitem__, asked), np.int64, len(asked))
                total += int(self.counts[rows].sum())
                worth += float(self.scores[rows].sum())
            at = end
        return total, worth


@lru_cache(1)
def counter(path: str) -> UnigramCounter:
    return UnigramCounter(pieces_of(path))


def with_token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``docs`` with n_tokens and token_score for every row; ``vocabulary`` is the path of a
    sentencepiece model file that every worker can open.

    Null and empty texts have no tokens and score 0; a word of any length is scored whole;
    repeated rows count alike; an empty table stays empty. Columns of the two names are
    replaced, others are kept.
    """
    kept = docs.drop("n_tokens", "token_score")

    def counted(batches):
        table = counter(vocabulary)
        for batch in batches:
            found = [table.text(t or "") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([s for _, s in found], pa.float64()),
                ],
                names=[*batch.schema.names, "n_tokens", "token_score"],
            )

    return kept.mapInArrow(counted, and_fields(kept, "n_tokens long, token_score double"))
