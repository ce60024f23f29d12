"""Filter interaction audit: five filters, every order of applying them.

The texts become a sparse document-term matrix. A task cuts its texts into shards of about
``SHARD_BYTES`` and writes each as compressed sparse rows over a vocabulary of its own, with
what the other filters need. The vocabularies alone are then shuffled, by word, and every word
gets one code for the whole table; the codes travel back by shard, where they replace the
shard's own. Row sums (words) and nonzero counts (distinct words) of the encoded matrix decide
filters A and B.

What is left are a few numbers and a digest for each document. Copies are found by grouping the
digests; a text that fills more than a ten-thousandth of the table is joined by broadcast
(there can be no more than ``HOT`` of them), all others by a shuffle. The five verdicts are one
mask, and documents are counted by part, mask and label, so the 120 orders are worked out on at
most 128 rows for each part.
"""

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.llm.common import as_bytes, grouped, joined, letters, pieces, rows, shuffle_partitions, tidy, word_hashes
from wellspring.workspace import stage, stage_measured

FILTERS = "ABCDE"
#: Fixed values of the filters: least words; least percentage of distinct words; most percentage
#: of capitals; characters that none may hold.
WORDS, DISTINCT, CAPITALS, MARKS = 50, 65, 5, b"#$%&*|"
#: Text in one shard of the matrix, about; vocabulary entries in one part of the dictionary, about.
SHARD_BYTES, PART_WORDS = 4 << 20, 4 << 20
#: Texts that may each hold over 1 / HOT of all documents.
HOT = 10_000

SHARD = pa.schema(
    [("shard", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("part", pa.list_(pa.string())), ("facts", pa.binary()),
     ("digests", pa.binary()), ("starts", pa.binary()), ("codes", pa.binary()), ("counts", pa.binary()), ("words", pa.binary())]
)
SHARD_DDL = (
    "shard long, doc_id array<bigint>, part array<string>, facts binary, digests binary, "
    "starts binary, codes binary, counts binary, words binary"
)
FACT = np.dtype([("points", "<i8"), ("capitals", "<i8"), ("marked", "<i8")])


def cased_letters() -> np.ndarray:
    """Byte table for words as they are written: white space alone is made 0."""
    low = letters()
    low[65:91] = np.arange(65, 91)
    return low


CASED = cased_letters()


def word_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(vocabulary, row, column, count) of the nonzero cells of texts taken together, in order;
    the vocabulary holds sorted 64-bit word hashes."""
    text, begins = joined(texts)
    starts, hashes = word_hashes(text, CASED)
    words, column = np.unique(hashes, return_inverse=True)
    row = np.searchsorted(begins, starts, side="right") - 1
    cell, count = np.unique(row * np.int64(max(1, len(words))) + column, return_counts=True)
    return words, cell // max(1, len(words)), cell % max(1, len(words)), count


def text_facts(texts: list[bytes]) -> np.ndarray:
    """Code points, capitals and forbidden characters of each text."""
    out = np.zeros(len(texts), FACT)
    text, begins = joined(texts)
    seen = np.frombuffer(text, np.uint8)
    forbidden = np.zeros(256, bool)
    forbidden[list(MARKS)] = True
    for name, hit in (("points", (seen & 0xC0) != 0x80), ("capitals", (seen >= 65) & (seen <= 90)), ("marked", forbidden[seen])):
        out[name] = np.add.reduceat(hit.view(np.uint8), begins[:-1], dtype=np.int64) if len(texts) else 0
    out["points"] -= 1  # the separator
    return out


def packed(numbers: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the largest needs, which the first byte says."""
    width = next(w for w in (1, 2, 4, 8) if int(numbers.max(initial=0)) < 1 << 8 * w)
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1)


class Shard:
    """Compressed sparse rows of some documents over the words they hold."""

    def __init__(self):
        self.ids, self.parts, self.digests, self.facts = [], [], [], []
        self.cells, self.bytes = [], 0

    def add(self, ids: list, parts: list, texts: list[bytes]) -> None:
        first = len(self.ids)
        self.ids += ids
        self.parts += parts
        self.bytes += sum(map(len, texts))
        self.digests += [hashlib.blake2b(t, digest_size=16).digest() for t in texts]
        self.facts.append(text_facts(texts))
        if len(texts) == 1:
            for piece in pieces(texts[0]):
                words, row, column, count = word_counts([piece])
                self.cells.append((words, row + first, column, count))
        else:
            words, row, column, count = word_counts(texts)
            self.cells.append((words, row + first, column, count))

    def record(self, number: int) -> pa.RecordBatch:
        words = np.unique(np.concatenate([c[0] for c in self.cells]))
        row = np.concatenate([c[1] for c in self.cells])
        code = np.concatenate([np.searchsorted(words, c[0])[c[2]] for c in self.cells])
        cell = row * np.int64(max(1, len(words))) + code
        count = np.concatenate([c[3] for c in self.cells])
        if (np.diff(cell) <= 0).any():  # a long text came in pieces
            cell, of = np.unique(cell, return_inverse=True)
            count = np.bincount(of, weights=count).astype(np.int64)
        starts = np.searchsorted(cell, np.arange(len(self.ids) + 1) * np.int64(max(1, len(words))))
        return rows(
            SHARD,
            shard=[number],
            doc_id=[self.ids],
            part=[self.parts],
            facts=[np.concatenate(self.facts).tobytes()],
            digests=[b"".join(self.digests)],
            starts=[starts.astype("<i8").tobytes()],
            codes=[packed(cell % max(1, len(words)))],
            counts=[packed(count)],
            words=[words.astype("<u8").tobytes()],
        )


def shards(docs: DataFrame) -> DataFrame:
    """Texts to shards of the matrix, each over its own words; a narrow plan."""

    def cut(batches):
        base, number, shard = TaskContext.get().partitionId() << 32, 0, Shard()
        for batch in batches:
            texts = as_bytes(batch["text"])
            ids, parts = batch["doc_id"].to_pylist(), batch["part"].to_pylist()
            for a, b in grouped(texts, SHARD_BYTES):
                shard.add(ids[a:b], parts[a:b], texts[a:b])
                if shard.bytes >= SHARD_BYTES:
                    yield shard.record(base + number)
                    number, shard = number + 1, Shard()
        if shard.ids:
            yield shard.record(base + number)

    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), part, "text").mapInArrow(tidy(cut), SHARD_DDL)


def dictionary(table: DataFrame, parts: int) -> DataFrame:
    """(shard, part, codes): for the words of ``part`` in each shard, in the shard's order, their
    codes in the whole table. A word's code is its place among the words of its part, which are
    dealt by hash, times the number of parts, plus the part."""
    LISTED = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("words", pa.binary())])
    CODED = pa.schema([("shard", pa.int64()), ("piece", pa.int32()), ("codes", pa.binary())])

    def listed(batches):
        for batch in batches:
            for shard, blob in zip(batch["shard"].to_pylist(), batch["words"].to_pylist()):
                words = np.frombuffer(blob, "<u8")
                part = ((words >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # rises with the word
                edges = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
                some = np.flatnonzero(np.diff(edges))
                yield rows(
                    LISTED, part=some, shard=np.full(len(some), shard),
                    words=[words[edges[k] : edges[k + 1]].tobytes() for k in some],
                )

    def coded(batches):
        held: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            for part, shard, blob in zip(*(batch[c].to_pylist() for c in ("part", "shard", "words"))):
                held.setdefault(part, []).append((shard, blob))
        for part in list(held):
            blobs = held.pop(part)
            known = np.zeros(0, np.uint64)
            for k in range(0, len(blobs), 64):
                known = np.unique(np.concatenate([known, *(np.frombuffer(b, "<u8") for _, b in blobs[k : k + 64])]))
            for shard, blob in blobs:
                codes = np.searchsorted(known, np.frombuffer(blob, "<u8")) * parts + part
                yield rows(CODED, shard=[shard], piece=[part], codes=[packed(codes)])

    words = table.select("shard", "words").mapInArrow(tidy(listed), "part int, shard long, words binary")
    return words.repartition(parts, "part").mapInArrow(tidy(coded), "shard long, piece int, codes binary")


def document_terms(docs: DataFrame) -> DataFrame:
    """The document-term matrix of ``docs`` (doc_id, source, text) in shards.

    A row is a shard: lists ``doc_id`` and ``part`` of its documents, their ``facts`` and
    ``digests``, and the matrix in compressed sparse rows: ``starts`` (int64), ``codes`` of words,
    the same in every shard, and ``counts`` (both to be ``unpacked``). Null texts are empty; an
    empty text is a row without cells; a text of any length is one row; repeated rows are rows
    of their own; an empty table has no shards.
    """
    words = F.sum(F.octet_length("words")) / 8
    table, seen = stage_measured(shards(docs), "term-shards", words=words)
    parts = max(shuffle_partitions(docs.sparkSession), int((seen["words"] or 0) // PART_WORDS))
    codes = dictionary(table, parts)
    own = table.withColumn("piece", F.lit(-1)).drop("words")
    both = own.unionByName(codes, allowMissingColumns=True)
    # a shard comes first, then its codes in the order of its words
    met = both.repartition(shuffle_partitions(docs.sparkSession), "shard").sortWithinPartitions("shard", "piece")
    names = [f for f in SHARD.names if f != "words"]

    def encoded(batches):
        current, found = None, []

        def whole():
            of = np.concatenate([np.zeros(0, np.int64), *map(unpacked, found)])
            values = current | {"codes": packed(of[unpacked(current["codes"])].astype(np.int64))}
            schema = pa.schema([SHARD.field(f) for f in names])
            return rows(schema, **{f: [values[f]] for f in names})

        for batch in batches:
            for k, piece in enumerate(batch["piece"].to_pylist()):
                if piece < 0:
                    if current is not None:
                        yield whole()
                    current, found = {f: batch[f][k].as_py() for f in names}, []
                    current["codes"] = batch["codes"][k].as_py()
                else:
                    found.append(batch["codes"][k].as_py())
        if current is not None:
            yield whole()

    return met.select(*names, "piece").mapInArrow(tidy(encoded), SHARD_DDL.removesuffix(", words binary"))


def verdicts(terms: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask) of every document of the matrix; bit k of ``mask`` is set if
    filter k fails, of the first four."""
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("mask", pa.int32())])

    def judged(batches):
        for batch in batches:
            for row in batch.to_pylist():
                starts, counts = np.frombuffer(row["starts"], "<i8"), unpacked(row["counts"]).astype(np.int64)
                facts = np.frombuffer(row["facts"], FACT)
                distinct = np.diff(starts)
                before = np.concatenate(([0], np.cumsum(counts)))
                words = before[starts[1:]] - before[starts[:-1]]
                fails = (
                    words < WORDS,
                    100 * distinct < DISTINCT * words,
                    100 * facts["capitals"] > CAPITALS * facts["points"],
                    facts["marked"] > 0,
                )
                mask = sum(f.astype(np.int32) << k for k, f in enumerate(fails))
                digests = [row["digests"][i : i + 16] for i in range(0, len(row["digests"]), 16)]
                yield rows(schema, doc_id=row["doc_id"], part=row["part"], digest=digests, mask=mask)

    columns = ("doc_id", "part", "facts", "digests", "starts", "counts")
    return terms.select(*columns).mapInArrow(tidy(judged), "doc_id long, part string, digest binary, mask int")


def with_copies(found: DataFrame, total: int) -> DataFrame:
    """Bit 4 of ``mask`` set where the same text has a smaller doc_id; ``found`` is a table of
    ``total`` rows."""
    texts = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")).where("n > 1")
    texts = stage(texts, "audit-copies")
    hot = F.col("n") > total // HOT + 1
    often = texts.where(hot).select("digest", F.col("first").alias("often"))  # fewer than HOT rows
    seldom = texts.where(~hot).select("digest", F.col("first").alias("seldom"))
    met = found.join(F.broadcast(often), "digest", "left")
    rest = met.where("often is null").join(seldom, "digest", "left")
    both = rest.unionByName(met.where("often is not null"), allowMissingColumns=True)
    later = F.coalesce(F.col("doc_id") > F.coalesce("often", "seldom"), F.lit(False))
    return both.withColumn("mask", F.col("mask").bitwiseOR(F.when(later, 16).otherwise(0)))


def with_labels(found: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``good`` and ``toxic``: whether a label of the doc_id says so. Documents without an
    id take no part in the join, where all of them would be one key."""
    said = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(said("quality").alias("good"), said("toxic").alias("toxic"))
    none = {c: F.lit(False) for c in ("good", "toxic")}
    met = found.where("doc_id is not null").join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])
    return met.unionByName(found.where("doc_id is null").withColumns(none))


def has(mask: Column, bits: Column) -> Column:
    return mask.bitwiseAND(bits) != 0


def orders_of(patterns: DataFrame) -> DataFrame:
    """Counts by (part, mask, good, toxic, n) to the audit of all orders.

    What a step does depends on its filter and on the set of filters before it alone; a part has
    80 such cases, and each of the 600 steps is one of them."""
    bit = F.explode(F.array(*[F.lit(1 << k) for k in range(5)])).alias("bit")
    cases = patterns.select("*", bit).select("*", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("before"))
    mask, bit, before, n = F.col("mask"), F.col("bit"), F.col("before"), F.col("n")
    fails, gone = has(mask, bit), has(mask, before)
    counted_by = lambda when, what: F.sum(F.when(when, what).otherwise(0)).cast("long")
    counted = lambda when: counted_by(when, n)
    cases = cases.where(~has(before, bit)).groupBy("part", "bit", "before").agg(
        counted(~fails & ~gone).alias("kept"),
        counted(fails & ~gone).alias("removed"),
        counted(fails & gone).alias("redundant"),
        counted(mask == bit).alias("unique_fails"),
        counted(fails & ~gone & F.col("good")).alias("good_lost"),
        counted(fails & ~gone & F.col("toxic")).alias("toxic_lost"),
        # of a document that fails m filters, each is the first in 120 / m of the orders
        counted_by(fails, F.expr("n * 120 div bit_count(mask)")).alias("shapley"),
    )
    steps = [
        ("".join(order), k + 1, 1 << FILTERS.index(f), sum(1 << FILTERS.index(g) for g in order[:k]))
        for order in permutations(FILTERS)
        for k, f in enumerate(order)
    ]
    plan = patterns.sparkSession.createDataFrame(steps, "filter_order string, step int, bit int, before int")
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return cases.join(F.broadcast(plan), ["bit", "before"]).select("part", "filter_order", "step", *names)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; see ``orders_of``.

    ``docs`` holds doc_id (a whole number), source and text, ``labels`` doc_id, quality and toxic.
    A null text is empty and a null source the part ''. A document without doc_id is a copy of
    none and has no label, but its text makes no other a copy either; repeated rows of one doc_id are
    copies of none of each other. A doc_id labelled more than once is good, or toxic, if any
    label says so. An empty table has no parts. Other columns are not looked at.
    """
    found, seen = stage_measured(verdicts(document_terms(docs)), "audit-verdicts", n=F.count(F.lit(1)))
    found = with_copies(with_labels(found, labels), seen["n"])
    patterns = found.groupBy("part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    return orders_of(patterns)


def oracle() -> str:
    words = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
    steps = ", ".join(f"({i + 1}, substring(filter_order, {i + 1}, 1), substring(filter_order, 1, {i}))" for i in range(5))
    return f"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, {words} AS w, min(doc_id) OVER (PARTITION BY text) AS first FROM texts),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         CASE WHEN len(w) < {WORDS} THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < {DISTINCT} * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {CAPITALS} * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails
  FROM worded LEFT JOIN marks m USING (doc_id)),
patterns AS (SELECT part, good, toxic, fails, count(*) AS n FROM failed GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, s.* FROM orders, LATERAL (VALUES {steps}) AS s(step, f, before)),
judged AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS fail, fails = f AS only_f,
         before <> '' AND regexp_matches(fails, '[' || before || '_]') AS gone
  FROM patterns, steps),
audited AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT fail AND NOT gone THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fail AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fail AND gone THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN only_f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fail AND NOT gone AND good = 1 THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN fail AND NOT gone AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM audited"""
