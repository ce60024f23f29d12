"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits. Every bit position gets one of the non-zero vectors of
GF(2)^(r+1); a mask for each non-zero vector keeps the positions whose product with it is 1.
The vectors of any r differing positions leave some mask that keeps none of them, so every
pair within radius r agrees under one of the 2^(r+1)-1 masks: no pair is missed.

Copies share one fingerprint and are joined before any search. A bucket of up to ``DIRECT``
fingerprints is compared directly. In larger ones each fingerprint also takes the keys that
one flipped free bit gives: two fingerprints share a key exactly if they differ in at most
two bits, so hanging each key's members on one of them links all with rows in proportion to
the bucket, however large it is.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.common import and_fields, as_bytes, keeps_columns, numbered, rows, shuffle_partitions, tidy
from wellspring.llm.components import components
from wellspring.workspace import stage

WORDS, SEED, RADIUS = 3, 42, 2
#: Buckets beyond this are linked by shared one-flip keys instead of comparing pairs.
DIRECT = 48
#: Shingles that are hashed at once.
BLOCK = 1 << 16

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Majority bits over XXH64 of the word shingles; 0 for a text without words."""
    parts = text.translate(_LOWER).split()
    if not parts:
        return 0
    flat = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(words, len(parts))
    first, last = starts[: len(parts) - width + 1].tolist(), ends[width - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), BLOCK):
        spans = zip(first[at : at + BLOCK], last[at : at + BLOCK])
        hashes = np.array([digest(flat[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(first)).tolist())


def masks(radius: int = RADIUS) -> list[int]:
    """The covering masks as unsigned 64-bit numbers."""
    vectors = range(1, 1 << (radius + 1))
    of_bit = [1 + i % (len(vectors)) for i in range(64)]
    return [sum(1 << i for i, m in enumerate(of_bit) if (m & v).bit_count() % 2) for v in vectors]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, fp): one row per input row, staged; fp is the signed 64-bit fingerprint."""

    def hashed(batches):
        for batch in batches:
            marks = np.array([fingerprint(t) for t in as_bytes(batch["text"])], np.uint64)
            prints = pa.array(marks.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], prints], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return numbered(docs.select("doc_id", "text").mapInArrow(tidy(hashed), f"doc_id {kind}, fp long"), "simhash")


PAIR = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _compare(batches):
    """Edges among the members of small buckets; the rows of a bucket come together."""
    bucket, members = None, []

    def near():
        a = np.array(members, np.int64)
        for i in range(len(a) - 1):
            apart = np.bitwise_count((a[i] ^ a[i + 1 :]).view(np.uint64))
            for v in a[i + 1 :][apart <= RADIUS].tolist():
                yield members[i], v

    def batch_of(pairs):
        return rows(PAIR, u=[u for u, _ in pairs], v=[v for _, v in pairs])

    for batch in batches:
        found = []
        for *key, fp in zip(*(batch[c].to_pylist() for c in ("bucket_table", "bucket", "fp"))):
            if key != bucket:
                found += near()
                bucket, members = key, []
            members.append(fp)
        yield batch_of(found)
    yield batch_of(list(near()))


def links(prints: DataFrame) -> DataFrame:
    """Edges (u, v) among distinct fingerprints (fp long) whose components are those of all
    pairs within ``RADIUS`` bits."""
    covering = masks()
    key = ["bucket_table", "bucket"]
    tables = [
        F.struct(F.lit(i).alias("bucket_table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bucket"))
        for i, m in enumerate(covering)
    ]
    keyed = prints.select("fp", F.explode(F.array(*tables)).alias("at")).select("at.*", "fp")
    sizes = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = stage(keyed.join(sizes, key), "simhash-buckets")
    small = (
        placed.where(F.col("n") <= DIRECT)
        .drop("n")
        .repartition(shuffle_partitions(prints.sparkSession), *key)
        .sortWithinPartitions(*key)
        .mapInArrow(tidy(_compare), "u long, v long")
    )
    near = F.lit(None)
    for i, mask in enumerate(covering):
        flips = [F.col("fp").bitwiseXOR(F.lit(_signed(1 << b))) for b in range(64) if not mask >> b & 1]
        near = F.when(F.col("bucket_table") == i, F.array(F.col("fp"), *flips)).otherwise(near)
    shared = placed.where(F.col("n") > DIRECT).select(*key, "fp", F.explode(near).alias("shared_key"))
    heads = shared.groupBy(*key, "shared_key").agg(F.min("fp").alias("v"), F.max("fp").alias("w"))
    large = shared.join(heads.where("v < w").drop("w"), [*key, "shared_key"])
    return small.union(large.select(F.col("fp").alias("u"), "v").where("u <> v"))


def simhash_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, the smallest
    doc_id among the documents it reaches by links.

    Null and empty texts, and texts of white space, have fingerprint zero and link like any
    other. Fewer than three words make one shingle. Rows that repeat a doc_id are each given a
    row. A null doc_id is never a component's id unless the whole component has none. An empty
    table gives no rows; other columns are not looked at.
    """
    prints = fingerprints(docs)
    firsts = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    groups = components(links(firsts.select("fp")), "simhash").withColumnRenamed("node", "fp")
    rooted = firsts.join(groups, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = stage(rooted.join(least, "root").select("fp", "component_id"), "simhash-groups")
    return prints.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@keeps_columns("doc_id", "text")
def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that are the smallest doc_id of their group, with all their columns.

    Each row is judged by its own text, also where rows share a doc_id; equal rows of one
    doc_id stay or go together, and rows without a doc_id stay.
    """
    later = F.col("doc_id") != F.col("component_id")
    found = simhash_groups(docs).where("doc_id is not null").select("doc_id", "fingerprint", later.alias("later"))
    found = stage(found.where("later is not null").distinct(), "simhash-later")
    by_id = found.groupBy("doc_id").agg(F.min("later").alias("whole"), F.max("later").alias("some")).where("some")
    by_id = stage(by_id.select("doc_id", "whole"), "simhash-ids")
    rest = docs.join(by_id.where("whole").select("doc_id"), "doc_id", "left_anti").select(docs.columns)
    # ids of which some rows go and others stay: the fingerprint tells which
    torn = by_id.where(~F.col("whole")).select("doc_id", F.lit(True).alias("_torn"))
    if torn.isEmpty():
        return rest

    names = docs.columns

    def marked(batches):
        for batch in batches:
            prints = [f"{fingerprint(x):016x}" if on else None for x, on in zip(as_bytes(batch["text"]), batch["_torn"].to_pylist())]
            columns = [*(batch[c] for c in names), pa.array(prints, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "_print"])

    rest = rest.join(torn, "doc_id", "left").mapInArrow(tidy(marked), and_fields(docs, "_print string"))
    gone = found.where("later").select("doc_id", F.col("fingerprint").alias("_print"))
    return rest.join(gone, ["doc_id", "_print"], "left_anti").select(docs.columns)
