"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors of one label and width are compared by cosine. Copies are joined first. The others are
sorted along their first principal direction and cut into tiles of bounded size; pairs of tiles
that hold a common label, and lie near enough in that direction for any link, are compared.
Inside a pair of tiles the products of the leading principal dimensions are summed first; the
norms of the remaining dimensions bound what they can add, and a pair of vectors is given up as
soon as its cosine cannot reach the threshold. What remains is measured on the original vectors
in double precision.

A tile travels as one row. A pair of tiles gives the number of links of each vector and a star
over each local component, so the rows that come out grow with the tiles, not with the links.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.common import and_fields, numbered, shuffle_partitions
from wellspring.llm.components import components
from wellspring.operators.position import in_order, slot_table, with_position
from wellspring.workspace import stage, stage_measured

THRESHOLD, TILE = 0.93, 1024
#: Leading dimensions summed before each check of the bound.
STEPS = (8, 16, 32, 64)
#: Slack for rounding in the rotated products; survivors are measured exactly.
SLACK = 1e-9
#: Share of surviving pairs under which they are followed one by one.
SPARSE = 0.05
#: Widths that get a rotation of their own; vectors of rarer widths keep their dimensions' order.
ROTATED_WIDTHS = 8


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def moments(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Rotation to principal dimensions, by width, from the second moments of all vectors."""

    def partial(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for width, rows in by_width(batch["vector"].to_pylist()):
                x = unit(rows)
                held = sums.setdefault(width, [0, np.zeros((width, width))])
                held[0] += len(x)
                held[1] += x.T @ x
        yield table_of(sums)

    def merged(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for width, n, blob in zip(*(batch[c].to_pylist() for c in ("width", "n", "sums"))):
                held = sums.setdefault(width, [0, np.zeros((width, width))])
                held[0] += n
                held[1] += np.frombuffer(blob).reshape(width, width)
        yield table_of(sums)

    def table_of(sums):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int64()),
                pa.array([s[0] for s in sums.values()], pa.int64()),
                pa.array([s[1].tobytes() for s in sums.values()], pa.binary()),
            ],
            names=["width", "n", "sums"],
        )

    schema = "width long, n long, sums binary"
    parts = vectors.select("vector").mapInArrow(partial, schema)
    whole = parts.repartition(shuffle_partitions(vectors.sparkSession), "width").mapInArrow(merged, schema)
    found = whole.orderBy(F.desc("n"), "width").limit(ROTATED_WIDTHS).collect()
    turned = {}
    for r in found:
        _, axes = np.linalg.eigh(np.frombuffer(r["sums"]).reshape(r["width"], r["width"]))
        turned[r["width"]] = np.ascontiguousarray(axes[:, ::-1])
    return turned


def by_width(lists: list[list[float]]):
    widths = np.array([len(v) for v in lists])
    for width in np.unique(widths):
        yield int(width), np.array([v for v in lists if len(v) == width], np.float64)


def linked(x: np.ndarray, y: np.ndarray, axes: np.ndarray | None, same: bool, threshold: float):
    """Index pairs (i, j) of rows of x and y whose cosine reaches the threshold; i < j if the
    two are the same rows."""
    a, b = unit(x), unit(y)
    if axes is not None:
        a, b = a @ axes, b @ axes
    width = a.shape[1]
    tails = [np.sqrt(np.maximum(np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1], 0)) for m in (a, b)]
    rest_a, rest_b = (np.append(t, np.zeros((len(t), 1)), axis=1) for t in tails)
    done, i = 0, None
    reached = np.zeros((len(a), len(b)))
    for step in [s for s in STEPS if s < width] + [width]:
        if i is None:
            reached += a[:, done:step] @ b[:, done:step].T
            alive = reached + np.outer(rest_a[:, step], rest_b[:, step]) >= threshold - SLACK
            if same:
                alive &= np.arange(len(a))[:, None] < np.arange(len(b))
            if alive.mean() < SPARSE or step == width:
                i, j = np.nonzero(alive)
                reached = reached[i, j]
        else:
            reached = reached + np.einsum("ij,ij->i", a[i, done:step], b[j, done:step])
            keep = reached + rest_a[i, step] * rest_b[j, step] >= threshold - SLACK
            i, j, reached = i[keep], j[keep], reached[keep]
        done = step
    x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
    norms = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    exact = np.einsum("ij,ij->i", x[i], y[j]) / (norms[0][i] * norms[1][j])
    return i[exact >= threshold], j[exact >= threshold]


def stars(ids: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes of the given edges."""
    nodes, place = np.unique(np.concatenate((ids, other)), return_inverse=True)
    u, v = place[: len(ids)], place[len(ids) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, u, least)
        np.minimum.at(root, v, least)
        root = root[root]
        if (root == before).all():
            return nodes, nodes[root]


def valid(vector) -> F.Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(vector.isNotNull() & whole, F.lit(False))


def tiles(distinct: DataFrame, turned: dict[int, np.ndarray]) -> DataFrame:
    """One row per tile: its vectors, in the order of their first principal dimension."""
    first = {width: axes[:, 0].copy() for width, axes in turned.items()}

    def along(batches):
        for batch in batches:
            lists = batch["vector"].to_pylist()
            place = np.zeros(len(lists))
            for k, v in enumerate(lists):
                x = unit(np.array([v]))[0]
                place[k] = x @ first[len(v)] if len(v) in first else 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*batch.schema.names, "along"])

    spark = distinct.sparkSession
    placed = distinct.mapInArrow(along, and_fields(distinct, "along double"))
    placed = placed.withColumn("width", F.size("vector"))
    order = ["label", "width", "along", "gid"]
    ordered = stage(in_order(placed, shuffle_partitions(spark), order, ["gid"]), "vectors-order")
    seated = with_position(ordered, slot_table(ordered)).withColumn("tile", F.expr(f"pos div {TILE}"))
    columns = ["gid", "label", "width", "along", "copies", "vector"]
    schema = "tile long, gid array<long>, label array<string>, width array<int>, along array<double>, copies array<long>, vector array<array<double>>"

    def packed(batches):
        tile, held = None, None
        for batch in batches:
            for key, *row in zip(*(batch[c].to_pylist() for c in ("tile", *columns))):
                if key != tile:
                    if held:
                        yield one(tile, held)
                    tile, held = key, [[] for _ in columns]
                for column, value in zip(held, row):
                    column.append(value)
        if held:
            yield one(tile, held)

    def one(tile, held):
        types = [pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.list_(pa.float64())]
        arrays = [pa.array([v], pa.list_(t)) for v, t in zip(held, types)]
        return pa.RecordBatch.from_arrays([pa.array([tile], pa.int64()), *arrays], names=["tile", *columns])

    by_tile = seated.select("tile", *columns).repartition(shuffle_partitions(spark), "tile")
    return stage(by_tile.sortWithinPartitions("tile", "gid").mapInArrow(packed, schema), "vectors-tiles")


def pairs_of(whole: DataFrame, threshold: float) -> DataFrame:
    """(a, b) with a <= b: tiles that may hold a link."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    spans = whole.select("tile", F.explode(F.arrays_zip("label", "width", "along")).alias("r"))
    spans = spans.groupBy("r.label", "r.width", "tile").agg(F.min("r.along").alias("low"), F.max("r.along").alias("high"))
    a = spans.select("label", "width", F.col("tile").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"))
    b = spans.select("label", "width", F.col("tile").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    near = (F.col("a") <= F.col("b")) & (F.col("low_b") - F.col("high_a") <= reach) & (F.col("low_a") - F.col("high_b") <= reach)
    return a.join(b, ["label", "width"]).where(near).select("a", "b").distinct()


def compared(whole: DataFrame, turned: dict, threshold: float) -> DataFrame:
    """(gid, links, root): for each pair of tiles, what it adds to a vector's links, and the
    smallest vector of its local component."""
    fields = ("gid", "label", "width", "copies", "vector")
    sides = [whole.select(F.col("tile").alias(s), *[F.col(f).alias(f"{f}_{s}") for f in fields]) for s in "ab"]
    pairs, seen = stage_measured(pairs_of(whole, threshold), "vectors-pairs", n=F.count(F.lit(1)))
    paired = pairs.join(sides[0], "a").join(sides[1], "b")
    # a pair is a large row, so a task gets few of them
    paired = paired.repartition(max(shuffle_partitions(whole.sparkSession), seen["n"] // 16), "a", "b")

    def compare(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch[name][r].as_py() for name in batch.schema.names}
                yield joined_links(row)

    def joined_links(row):
        ends = []
        kinds = set(zip(row["label_a"], row["width_a"])) & set(zip(row["label_b"], row["width_b"]))
        ids = [np.array(row[f"gid_{s}"], np.int64) for s in "ab"]
        copies = dict(zip(row["gid_a"] + row["gid_b"], row["copies_a"] + row["copies_b"]))
        for label, width in sorted(kinds):
            own = [np.array([k for k, lw in enumerate(zip(row[f"label_{s}"], row[f"width_{s}"])) if lw == (label, width)]) for s in "ab"]
            x, y = (np.array([row[f"vector_{s}"][k] for k in o]) for s, o in zip("ab", own))
            i, j = linked(x, y, turned.get(width), row["a"] == row["b"], threshold)
            ends.append((ids[0][own[0][i]], ids[1][own[1][j]]))
        u = np.concatenate([e[0] for e in ends]) if ends else np.zeros(0, np.int64)
        v = np.concatenate([e[1] for e in ends]) if ends else np.zeros(0, np.int64)
        nodes, roots = stars(u, v)
        weight = np.array([copies[n] for n in nodes.tolist()], np.int64)
        at_u, at_v = np.searchsorted(nodes, u), np.searchsorted(nodes, v)
        n_links = np.zeros(len(nodes), np.int64)
        np.add.at(n_links, at_u, weight[at_v])
        np.add.at(n_links, at_v, weight[at_u])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (nodes, n_links, roots)], names=["gid", "links", "root"])

    return stage(paired.mapInArrow(compare, "gid long, links long, root long"), "vectors-links")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id,
    kept.

    Only vectors of equal label and width link. A vector that is null, empty, zero or holds a
    null or non-finite element, or has no label, links with nothing and is its own component.
    Repeated vectors, and repeated rows of one vec_id, are vectors of their own that link with
    each other. A null vec_id is never a component's id unless the whole component has none. An
    empty table gives no rows; other columns are not looked at. ``threshold`` is above 0.
    """
    vector = F.col("embedding").cast("array<double>")
    rows = numbered(vectors.select("vec_id", F.col("label").cast("string").alias("label"), vector.alias("vector")), "vectors")
    good = rows.where(valid(F.col("vector")) & F.col("label").isNotNull())
    distinct = good.groupBy("label", "vector").agg(
        F.min("uid").alias("gid"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id")
    )
    distinct = stage(distinct, "vectors-distinct")
    bare = distinct.select("gid", "label", "copies", "vector")
    turned = moments(bare)
    found = compared(tiles(bare, turned), turned, threshold)
    roots = components(found.select(F.col("gid").alias("u"), F.col("root").alias("v")), "vectors")
    roots = roots.withColumnRenamed("node", "gid")
    counts = found.groupBy("gid").agg(F.sum("links").alias("links"))
    groups = distinct.drop("vector").join(counts, "gid", "left").join(roots, "gid", "left")
    groups = groups.withColumn("root", F.coalesce("root", "gid"))
    least = groups.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = groups.join(least, "root").select(
        "gid", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    groups = stage(groups.join(distinct.select("gid", "label", "vector"), "gid"), "vectors-groups")
    joined = rows.join(groups, ["label", "vector"], "left")
    component = F.when(F.col("gid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id").eqNullSafe(component)).alias("kept"),
    )
