"""Approximate nearest neighbours by multiprobe p-stable hashing.

The largest inner product is made a distance: vectors are divided by the largest norm and given
one more dimension that brings them to norm 1, queries are brought to norm 1 themselves, and
then the nearest in Euclidean distance is the one of largest product. Each of ``tables`` hash
tables cuts ``cuts`` Gaussian projections into slots of one width. A query visits its own bucket and
those that differ by one slot in some projections, in the order of the squared distances of the
query to the slots' borders, which orders them by estimated success.

Buckets are dealt out by their hash; a bucket that holds more than ``block`` rows is split into
slices that all its queries visit. In a task the rows of its buckets stay and the queries stream
by, with all their buckets there at once, so a vector that several buckets offer is measured
once. Measured on the original vectors in double precision, the best of every task are merged.
A query that found fewer than it should goes past all rows in a second pass.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.common import and_fields, mixed, numbered, shuffle_partitions
from wellspring.llm.near_vectors import valid
from wellspring.workspace import stage


@dataclass(frozen=True)
class Settings:
    """``slot`` is the width of a slot in units of the norm; ``probes`` the buckets a query
    visits in each table; ``block`` the rows of a bucket beyond which it is split."""

    tables: int = 4
    cuts: int = 8
    slot: float = 2.5
    probes: int = 96
    block: int = 16_384
    seed: int = 11


class Hashing:
    """The projections of all tables for vectors of one width."""

    def __init__(self, width: int, largest: float, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        self.largest, self.settings = largest, settings
        self.axes = rng.standard_normal((settings.tables, width + 1, settings.cuts))
        self.shift = rng.uniform(0, settings.slot, (settings.tables, 1, settings.cuts))

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        x = rows / self.largest
        more = np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1, keepdims=True)))
        return np.hstack((x, more))

    def buckets(self, rows: np.ndarray) -> np.ndarray:
        """(table, row) bucket numbers."""
        slots = np.floor((self.lifted(rows) @ self.axes + self.shift) / self.settings.slot)
        return self.number(slots.astype(np.int64))

    def number(self, slots: np.ndarray) -> np.ndarray:
        """One signed 64-bit number for the slots along the last axis, told apart by table."""
        code = np.zeros(slots.shape[:-1], np.uint64)
        for i in range(slots.shape[-1]):
            code = mixed(code * np.uint64(31) + slots[..., i].astype(np.uint64))
        table = np.arange(len(slots), dtype=np.uint64).reshape(-1, *[1] * (code.ndim - 1))
        return mixed(code + table).view(np.int64)

    def probes(self, rows: np.ndarray) -> np.ndarray:
        """(row, visited bucket) numbers: all tables, each in estimated order of success."""
        norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        x = np.hstack((rows / norms, np.zeros((len(rows), 1))))
        s, found = self.settings, []
        at = x @ self.axes + self.shift
        slots = np.floor(at / s.slot)
        inside = at - slots * s.slot
        for t in range(s.tables):
            cost, moves = np.zeros((len(x), 1)), np.zeros((len(x), 1, 0), np.int64)
            for k in range(s.cuts):
                gap = inside[t, :, k]
                step = np.stack((np.zeros(len(x)), gap**2, (s.slot - gap) ** 2), axis=1)
                reached = (cost[:, :, None] + step[:, None, :]).reshape(len(x), -1)
                best = np.argsort(reached, axis=1, kind="stable")[:, : s.probes]
                cost = np.take_along_axis(reached, best, 1)
                moved = np.array([0, -1, 1])[best % 3]
                moves = np.concatenate((np.take_along_axis(moves, (best // 3)[:, :, None], 1), moved[:, :, None]), axis=2)
            found.append(slots[t].astype(np.int64)[:, None, :] + moves)
        return np.concatenate(self.number(np.stack(found)), axis=1)


def _matrix(column, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if isinstance(column, pa.ChunkedArray) else column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _search(rows: DataFrame, asked: DataFrame, width: int, k: int) -> DataFrame:
    """The best ``k`` in every shard. ``rows``: shard, uid, vec_id, vector, bucket. ``asked``:
    shard, query_uid, query_id, vector, visits (buckets, or null for all)."""
    spark = rows.sparkSession
    names = "shard long, is_query boolean, uid long, vec_id long, vector array<double>, bucket long, visits array<long>"
    left = rows.select("shard", F.lit(False).alias("is_query"), "uid", "vec_id", "vector", "bucket", F.lit(None).cast("array<long>").alias("visits"))
    right = asked.select(
        "shard", F.lit(True).alias("is_query"), F.col("query_uid").alias("uid"), F.col("query_id").alias("vec_id"), "vector",
        F.lit(None).cast("long").alias("bucket"), "visits",
    )
    both = left.union(right).repartition(shuffle_partitions(spark), "shard").sortWithinPartitions("shard", "is_query")
    out = ["query_uid", "query_id", "uid", "vec_id", "score"]

    def best(batches):
        shard, parts, held = None, [], None
        for batch in batches:
            shards = batch["shard"].to_numpy()
            edges = np.flatnonzero(np.diff(shards)) + 1
            for a, b in zip([0, *edges], [*edges, len(shards)]):
                if shards[a] != shard:
                    shard, parts, held = shards[a], [], None
                run = batch.slice(a, b - a)
                query = run["is_query"].to_numpy(zero_copy_only=False)
                cut = int(query.argmax()) if query.any() else len(query)
                if cut:
                    parts.append(run.slice(0, cut))
                if cut < len(query) and parts:
                    if held is None:
                        held = table_of(parts)
                    yield answers(held, run.slice(cut))

    def table_of(parts):
        uid, vec, bucket = (np.concatenate([p[c].to_numpy(zero_copy_only=False) for p in parts]) for c in ("uid", "vec_id", "bucket"))
        vectors = np.concatenate([_matrix(p["vector"], width) for p in parts])
        rows, first, inverse = np.unique(uid, return_index=True, return_inverse=True)
        order = np.argsort(bucket, kind="stable")
        return rows, vec[first], vectors[first], bucket[order], inverse[order]

    def answers(held, asking):
        uid, vec, vectors, buckets, of_row = held
        q = _matrix(asking["vector"], width)
        ids, names_, visits = asking["uid"].to_numpy(), asking["vec_id"].to_pylist(), asking["visits"]
        got = [[] for _ in out]
        for begin in range(0, len(q), 256):
            scores = q[begin : begin + 256] @ vectors.T
            for i in range(len(scores)):
                visit = visits[begin + i].values
                if visit is None:
                    seen = np.arange(len(uid))
                else:
                    wanted = visit.to_numpy()
                    lo, hi = (np.searchsorted(buckets, wanted, side=s) for s in ("left", "right"))
                    spans = [of_row[a:b] for a, b in zip(lo, hi) if a < b]
                    seen = np.unique(np.concatenate(spans)) if spans else np.zeros(0, np.int64)
                seen = seen[vec[seen] != names_[begin + i]]
                s = scores[i, seen]
                if len(seen) > k:
                    least = np.partition(s, len(s) - k)[len(s) - k]
                    seen = seen[s >= least - 1e-9 * max(1.0, abs(least))]
                # the product again, in an order that does not depend on the neighbours
                s = np.einsum("ij,j->i", vectors[seen], q[begin + i])
                order = np.lexsort((uid[seen], vec[seen], -s))[:k]
                for column, values in zip(got, ([ids[begin + i]] * len(order), [names_[begin + i]] * len(order), uid[seen[order]], vec[seen[order]], s[order])):
                    column.extend(values)
        types = [pa.int64()] * 4 + [pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(got, types)], names=out)

    assert [f.split()[0] for f in names.split(", ")] == both.columns
    return both.mapInArrow(best, "query_uid long, query_id long, uid long, vec_id long, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_uid", "query_id", "uid", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "uid")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, best first.

    ``vectors`` and ``queries`` hold vec_id (long) and embedding; a query is no candidate for
    itself, that is for rows of its vec_id. Nearness is the inner product, ties go to the smaller
    vec_id. Vectors that are null, empty, zero or hold a null or non-finite element take no part,
    nor do rows without a vec_id; each width is searched for itself. Equal rows are one candidate
    or query; rows of one vec_id with different vectors are each their own. Empty tables give no rows; other columns are not looked at.
    """

    def clean(df):
        v = F.col("embedding").cast("array<double>")
        rows = df.select("vec_id", v.alias("vector")).where(valid(F.col("vector")) & F.col("vec_id").isNotNull())
        return rows.distinct()

    spark = vectors.sparkSession
    rows = numbered(clean(vectors), "ann-rows")
    asked = numbered(clean(queries), "ann-queries")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    widths = rows.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("largest")).collect()
    parts = []
    for w in sorted(widths, key=lambda r: r["width"]):
        own = rows.where(F.size("vector") == w["width"])
        parts.append(_of_width(spark, own, asked.where(F.size("vector") == w["width"]), w, k, settings))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for part in parts:
        empty = empty.union(part)
    return empty


def _of_width(spark, rows: DataFrame, asked: DataFrame, facts, k: int, settings: Settings) -> DataFrame:
    width = facts["width"]
    hashing = Hashing(width, facts["largest"], settings)
    shards = max(1, -(-facts["n"] * settings.tables // settings.block))

    def bucketed(batches):
        for batch in batches:
            numbers = hashing.buckets(_matrix(batch["vector"], width)).T if batch.num_rows else np.zeros((0, settings.tables), np.int64)
            lists = pa.array(list(numbers), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "buckets"])

    def probing(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                visits = hashing.probes(_matrix(part["vector"], width))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(visits), pa.list_(pa.int64()))], names=[*part.schema.names, "visits"])

    keyed = rows.mapInArrow(bucketed, and_fields(rows, "buckets array<long>"))
    keyed = keyed.select("uid", "vec_id", "vector", F.explode("buckets").alias("bucket"))
    hot = stage(
        keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > settings.block)
        .select("bucket", F.ceil(F.col("n") / settings.block).cast("long").alias("slices")),
        "ann-hot",
    )
    keyed = keyed.join(hot, "bucket", "left").withColumn("slice", F.pmod(F.xxhash64("uid"), F.coalesce("slices", F.lit(1))))
    keyed = keyed.withColumn("shard", F.pmod(F.xxhash64("bucket", "slice"), F.lit(shards)))
    visits = asked.mapInArrow(probing, and_fields(asked, "visits array<long>"))
    visits = visits.select(F.col("uid").alias("query_uid"), F.col("vec_id").alias("query_id"), "vector", F.explode("visits").alias("bucket"))
    visits = visits.join(hot, "bucket", "left").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("slices", F.lit(1)) - 1)))
    visits = visits.withColumn("shard", F.pmod(F.xxhash64("bucket", "slice"), F.lit(shards)))
    grouped = visits.groupBy("query_uid", "query_id", "shard").agg(F.collect_set("bucket").alias("visits"))
    grouped = grouped.join(asked.select(F.col("uid").alias("query_uid"), "vector"), "query_uid")
    found = stage(_ranked(_search(keyed, grouped, width, k), k), "ann-found")
    enough = found.groupBy("query_uid").agg(F.count(F.lit(1)).alias("n"))
    # rows of a query's own vec_id are no candidates
    itself = rows.groupBy(F.col("vec_id").alias("query_id")).agg(F.count(F.lit(1)).alias("own"))
    short = asked.select(F.col("uid").alias("query_uid"), F.col("vec_id").alias("query_id"), "vector").join(enough, "query_uid", "left")
    short = short.join(itself, "query_id", "left")
    wanted = F.least(F.lit(k), F.lit(facts["n"]) - F.coalesce("own", F.lit(0)))
    short = stage(short.where(F.coalesce("n", F.lit(0)) < wanted).select("query_uid", "query_id", "vector"), "ann-short")
    if not short.isEmpty():
        everywhere = rows.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards))).withColumn("bucket", F.lit(0).cast("long"))
        past_all = short.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
        past_all = past_all.withColumn("visits", F.lit(None).cast("array<long>"))
        more = _ranked(_search(everywhere, past_all, width, k), k)
        found = found.join(short.select("query_uid"), "query_uid", "left_anti").unionByName(more)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
