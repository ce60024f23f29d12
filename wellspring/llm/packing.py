"""Packing documents into sequences by cutting-stock column generation.

One pass over the texts makes the ids and cuts each document into pieces of a whole sequence
and a rest; only the pieces' lengths and checksums go on, never ids. The histogram of length
classes (at most ``LENGTH / GRAIN`` numbers) is all that reaches the driver, where
``cutting.plan`` finds the patterns. One range sort ranks the pieces inside their class, and
the rank names the pattern's copy, so a class may hold any share of the pieces.

Words are cut at ASCII white space, which the tokenizer always drops and never joins over, so
the ids of a text are the ids of its words, and each distinct word is encoded once as long as
the worker's bounded table holds it.
"""

import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.common import and_fields, as_bytes, grouped, in_slices, joined, pieces, shuffle_partitions, tidy, word_spans
from wellspring.llm.cutting import Pattern, plan
from wellspring.operators.position import in_order, slot_table, with_position
from wellspring.workspace import stage

LENGTH, GRAIN, END_ID = 2048, 8, 1
#: Words kept with their ids in a worker, and runs, which take several times the room of a word.
REMEMBERED, RUNS = 600_000, 60_000
#: Bytes of text that are Python objects at once.
SLICE_BYTES = 1 << 20

#: Runs the tokenizer's own cut also gives in a word made of nothing else: letters that NFC
#: and lower-casing leave alone, single digits, and ASCII marks other than the apostrophe.
_RUNS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\\[-`{-~]+")
_ONLY_RUNS = re.compile("[a-z0-9ß-öø-ÿ!-&(-/:-@\\[-`{-~]+")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 stands
    for itself, the others take the letters from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds:
    """Ids of ASCII-space-separated words by a tokenizers file.

    Words are told apart by their 64-bit hashes. Simple words go to the tokenizer's model run
    by run, all others through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.letters = byte_letters()
        self.forget()

    def forget(self) -> None:
        self.known, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)
        self.runs: dict[str, list[int]] = {}

    def of_run(self, run: str) -> list[int]:
        if (found := self.runs.get(run)) is None:
            if len(self.runs) >= RUNS:
                self.runs.clear()
            shown = run if run.isascii() else "".join([self.letters[b] for b in run.encode()])
            found = self.runs[run] = [t.id for t in self.tokenizer.model.tokenize(shown)]
        return found

    def encoded(self, word: bytes) -> list[int]:
        text = word.decode()
        if not _ONLY_RUNS.fullmatch(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return [i for run in _RUNS.findall(text) for i in self.of_run(run)]

    def learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Add words with their sorted hashes."""
        ids = [self.encoded(w) for w in words]
        ends = self.starts[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        at = np.searchsorted(self.known, hashes)
        self.rows = np.insert(self.rows, at, np.arange(len(words)) + len(self.starts) - 1)
        self.known = np.insert(self.known, at, hashes)
        self.starts = np.concatenate((self.starts, ends))
        self.flat = np.concatenate((self.flat, np.array([i for x in ids for i in x], np.uint32)))

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, where each text's begin, with the end)."""
        text, begins = joined(texts)
        starts, lengths, hashes = word_spans(text)
        distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self.forget()
        new = ~np.isin(distinct, self.known, assume_unique=True)
        if new.any():
            spans = zip(starts[first[new]].tolist(), lengths[first[new]].tolist())
            self.learn(distinct[new], [text[a : a + n].lower() for a, n in spans])
        rows = self.rows[np.searchsorted(self.known, distinct)][place]
        sizes = self.starts[rows + 1] - self.starts[rows]
        until = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.starts[rows] - until[:-1], sizes) + np.arange(until[-1])
        return self.flat[at], until[np.searchsorted(starts, begins)]


@lru_cache(1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def ids_of_texts(texts: list[bytes], table: WordIds):
    """The ids of each text with ``END_ID``, in turn; a long text goes through in pieces."""
    for a, b in grouped(texts):
        if b - a == 1:
            parts = [table.ids([piece])[0] for piece in pieces(texts[a])]
            yield np.concatenate([*parts, [np.uint32(END_ID)]]).astype("<u4")
        else:
            ids, until = table.ids(texts[a:b])
            for i in range(b - a):
                yield np.append(ids[until[i] : until[i + 1]], np.uint32(END_ID)).astype("<u4")


def cut(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): documents cut at every ``LENGTH`` ids."""

    def pieced(batches):
        table = word_ids(tokenizer)
        for batch in in_slices(batches, SLICE_BYTES):
            texts = as_bytes(batch["text"])
            owner, start, length, crc, total = [], [], [], [], []
            for i, ids in enumerate(ids_of_texts(texts, table)):
                raw = memoryview(ids.tobytes())
                for at in range(0, len(ids), LENGTH):
                    part = raw[4 * at : 4 * (at + LENGTH)]
                    owner.append(i)
                    start.append(at)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(len(ids))
            columns = [pa.array(c, pa.int64()) for c in (start, length, crc, total)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(owner, pa.int64())), *columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select("doc_id", "text").mapInArrow(tidy(pieced), schema)


def _places(patterns: list[Pattern]):
    """For each size the ranks its slots begin at, and the pattern of each such run."""
    first, slots = {}, {}
    base = 0
    for pattern in patterns:
        for size, times in zip(pattern.classes, pattern.times):
            runs = slots.setdefault(size, [])
            begin = first.get(size, 0)
            runs.append((begin, base, times))
            first[size] = begin + times * pattern.copies
        base += pattern.copies
    return {size: np.array(runs, np.int64) for size, runs in slots.items()}


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizers file that every worker can open. A null or empty
    text is the end id alone; texts of any length are cut; rows that repeat a doc_id are
    documents of their own with the same id; an empty table gives no rows; columns other than
    doc_id and text are not looked at.
    """
    parts = stage(cut(docs, tokenizer).withColumn("size", F.ceil(F.col("length") / GRAIN).cast("long")), "pieces")
    histogram = {r["size"]: r["n"] for r in parts.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = _places(plan(histogram, LENGTH // GRAIN))
    ordered = sorted(histogram)
    before = dict(zip(ordered, np.cumsum([0, *[histogram[s] for s in ordered]]).tolist()))

    def seated(batches):
        for batch in batches:
            size = batch["size"].to_numpy()
            rank = batch["pos"].to_numpy() - np.array([before[s] for s in size.tolist()], np.int64)
            sequence = np.zeros(len(size), np.int64)
            for s in np.unique(size):
                own, runs = size == s, places[int(s)]
                run = runs[np.searchsorted(runs[:, 0], rank[own], side="right") - 1]
                sequence[own] = run[:, 1] + (rank[own] - run[:, 0]) // run[:, 2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequence)], names=[*batch.schema.names, "sequence_id"]
            )

    order = ["size", "doc_id", "start", "ids_crc32"]
    sorted_parts = stage(in_order(parts, shuffle_partitions(docs.sparkSession), order, parts.columns), "packing-order")
    ranked = with_position(sorted_parts, slot_table(sorted_parts))
    seats = ranked.mapInArrow(tidy(seated), and_fields(ranked, "sequence_id long"))
    inside = Window.partitionBy("sequence_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return seats.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long").alias("offset"),
    )
