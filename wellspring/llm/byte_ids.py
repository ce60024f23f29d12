"""Ids of texts by a byte-level vocabulary, word by word.

The tokenizer's own cut puts a single space before a word together with it and parts all other
white space from words, so the ids of a text are those of its spaced words and of the runs of
white space between them. Each distinct one is encoded once as long as the worker's bounded
table holds it. A text in which a word begins or ends with white space beyond ASCII goes
through the tokenizer as it is, cut only before line feeds that follow and precede plain marks.
"""

import re

import numpy as np

from wellspring.llm.audit import CASED
from wellspring.llm.common import grouped, joined, mixed, word_spans
from wellspring.llm.packing import REMEMBERED, RUNS, WordIds

#: Runs the tokenizer's own cut also gives in a word made of nothing else: Latin letters, digits,
#: and ASCII marks other than the apostrophe; a space before the word goes with its first run.
_RUNS = re.compile("(?: ?)(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]+|[!-&(-/:-@\\[-`{-~]+)")
_ONLY_RUNS = re.compile(" ?[A-Za-z0-9À-ÖØ-öø-ÿ!-&(-/:-@\\[-`{-~]+")
#: Bytes of white space beyond ASCII.
_WIDE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_EDGE = re.compile(rb"(?:^|[ \t-\r])(?:%s)|(?:%s)(?:[ \t-\r]|$)" % (_WIDE.pattern, _WIDE.pattern))
_LEADS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_SAFE_CUT = re.compile(rb"(?<=[!-~])(?=\n[!-~])")
#: What tells a word after a space from one without.
_SPACED = np.uint64(0x5851F42D4C957F2D)
#: A long text is cut into pieces of about this size.
PIECE_BYTES = 1 << 21


def has_wide_edge(text: bytes) -> bool:
    return any(lead in text for lead in _LEADS) and _EDGE.search(text) is not None


class SpacedWordIds(WordIds):
    """Ids of texts by a byte-level tokenizers file; words are told apart by 64-bit hashes."""

    def forget(self) -> None:
        super().forget()
        self.spaces: dict[bytes, np.ndarray] = {}

    def encoded(self, word: bytes) -> list[int]:
        if word.isalpha() or word[:1] == b" " and word[1:].isalpha():  # ASCII letters alone
            return self.of_run(word.decode("latin-1"))
        text = word.decode()
        if not _ONLY_RUNS.fullmatch(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return [i for run in _RUNS.findall(text) for i in self.of_run(run)]

    def of_run(self, run: str) -> list[int]:
        if (found := self.runs.get(run)) is None:
            if len(self.runs) >= RUNS:
                self.runs.clear()
            shown = run.encode().decode("latin-1").translate(self.letters)
            found = self.runs[run] = [t.id for t in self.tokenizer.model.tokenize(shown)]
        return found

    def of_space(self, gap: bytes) -> np.ndarray:
        if (found := self.spaces.get(gap)) is None:
            if len(self.spaces) > 10_000:
                self.spaces = {}
            found = self.spaces[gap] = np.array(self.tokenizer.encode(gap.decode(), add_special_tokens=False).ids, np.uint32)
        return found

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, where each text's begin, with the end) of texts without wide edges."""
        text, begins = joined(texts)
        starts, lengths, hashes = word_spans(text, CASED)
        of = np.searchsorted(begins, starts, side="right") - 1
        ends = starts + lengths
        before = begins[of]  # where the white space before each word begins
        before[1:] = np.where(of[1:] == of[:-1], ends[:-1], before[1:])
        whole = np.frombuffer(text, np.uint8)
        spaced = (starts > before) & (whole[starts - 1] == 32)
        hashes = np.where(spaced, mixed(hashes ^ _SPACED), hashes)
        distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self.forget()
        new = ~np.isin(distinct, self.known, assume_unique=True)
        if new.any():
            at = first[new]
            spans = zip((starts[at] - spaced[at]).tolist(), ends[at].tolist())
            self.learn(distinct[new], [text[a:b] for a, b in spans])
        rows = self.rows[np.searchsorted(self.known, distinct)][place]
        sizes = self.starts[rows + 1] - self.starts[rows]
        until = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.starts[rows] - until[:-1], sizes) + np.arange(until[-1])
        ids, edges = self.flat[at], until[np.searchsorted(starts, begins)]
        # white space that is more than the space of the word behind it, and that at a text's end
        wide = np.flatnonzero(starts - spaced > before)
        last = np.searchsorted(starts, begins[1:]) - 1
        tail = np.where((last >= 0) & (of[last] == np.arange(len(texts))) if len(starts) else False, ends[last] if len(starts) else 0, begins[:-1])
        trailing = np.flatnonzero(begins[1:] - 1 > tail)
        if not len(wide) and not len(trailing):
            return ids, edges
        gaps = [(int(until[i]), int(of[i]), text[before[i] : starts[i] - spaced[i]], bool(spaced[i])) for i in wide]
        gaps += [(int(edges[t + 1]), int(t), text[tail[t] : begins[t + 1] - 1], True) for t in trailing]
        gaps.sort(key=lambda g: (g[0], g[1]))
        put, more, added = [], [], np.zeros(len(texts) + 1, np.int64)
        for where, owner, gap, alone in gaps:
            found = [self.of_space(gap)] if alone or len(gap) == 1 else [self.of_space(gap[:-1]), self.of_space(gap[-1:])]
            for ids_of in found:
                put.append(np.full(len(ids_of), where))
                more.append(ids_of)
                added[owner + 1] += len(ids_of)
        return np.insert(ids, np.concatenate(put), np.concatenate(more)), edges + np.cumsum(added)

    def whole(self, text: bytes) -> np.ndarray:
        """The ids of one text of any length and kind."""
        parts = []
        at = 0
        while at < len(text) or not parts:
            cut = _SAFE_CUT.search(text, at + PIECE_BYTES) if len(text) - at > PIECE_BYTES else None
            end = cut.start() if cut else len(text)
            piece = text[at:end]
            if has_wide_edge(piece):
                parts.append(np.array(self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids, np.uint32))
            else:
                parts.append(self.ids([piece])[0])
            at = end
            if not text:
                break
        return np.concatenate(parts)

    def of_texts(self, texts: list[bytes]):
        """The ids of each text in turn."""
        plain = [not (len(t) > PIECE_BYTES or has_wide_edge(t)) for t in texts]
        for a, b in grouped(texts):
            some = [i for i in range(a, b) if plain[i]]
            ids, edges = self.ids([texts[i] for i in some]) if some else (None, None)
            place = {i: k for k, i in enumerate(some)}
            for i in range(a, b):
                k = place.get(i)
                yield self.whole(texts[i]) if k is None else ids[edges[k] : edges[k + 1]]
