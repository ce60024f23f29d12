"""Embedding links, SimHash groups, line matches and nearest neighbours against brute force."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from wellspring.llm import lines, near_vectors, neighbours, queries, simhash
from wellspring.llm.components import components

SF = "/root/testdata/sf0.001"


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def near_cloud(n=220, width=12, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(25, width))
    points = centres[rng.integers(0, 25, n)] + rng.normal(size=(n, width)) * 0.22
    return [(i * 3, points[i].tolist(), int(rng.integers(0, 3))) for i in range(n)]


def expected_vectors(rows, threshold=0.93):
    links = brute.cosine_links(rows, threshold)
    root = brute.components(range(len(rows)), links)
    least = {}
    for i, r in root.items():
        ids = [rows[j][0] for j in root if root[j] == r and rows[j][0] is not None]
        least[i] = min(ids) if ids else None
    count = [sum(i in pair for pair in links) for i in range(len(rows))]
    return sorted(((rows[i][0], count[i], least[i]) for i in range(len(rows))), key=repr)


def found_vectors(df):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in df.collect()), key=repr)


def test_vectors_equal_brute_force(spark, monkeypatch):
    rows = near_cloud()
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(40)]  # copies
    monkeypatch.setattr(near_vectors, "TILE", 32)  # many tiles
    df = near_vectors.near_vectors(vectors(spark, rows))
    assert found_vectors(df) == expected_vectors(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in df.collect())


def test_vectors_of_the_test_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]], r["label"]) for r in table.collect()]
    assert found_vectors(near_vectors.near_vectors(table)) == expected_vectors(rows)


def test_vectors_that_link_with_nothing(spark):
    one = [1.0, 2.0]
    rows = [(1, one, 0), (2, one, 0), (3, one, None), (4, None, 0), (5, [], 0), (6, [0.0, 0.0], 0)]
    rows += [(7, [float("nan"), 2.0], 0), (8, [float("inf"), 2.0], 0), (9, [None, 2.0], 0), (10, [1.0, 2.0, 0.0], 0)]
    rows += [(None, one, 0), (11, [1e200, 2e200], 0), (12, [1e-200, 2e-200], 0), (2, one, 0)]
    df = near_vectors.near_vectors(vectors(spark, rows).withColumn("gid", F.lit("x")).withColumn("links", F.lit(1)))
    assert found_vectors(df) == sorted(
        [(1, 5, 1), (2, 5, 1), (2, 5, 1), (None, 5, 1), (11, 5, 1), (12, 5, 1)] + [(i, 0, i) for i in range(3, 11)], key=repr
    )
    assert near_vectors.near_vectors(vectors(spark, [])).collect() == []


def test_bound_loses_no_link_at_the_threshold():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 70))
    y = np.concatenate([x * 2, x + rng.normal(size=x.shape) * 0.4])
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    i, j = near_vectors.linked(x, y, axes, False, 0.9)
    cos = (x @ y.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(a.tolist() for a in np.nonzero(cos >= 0.9))))


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 440)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long"), "test").collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert got == brute.components(nodes, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "u long, v long"), "test").collect() == []


def test_masks_cover_every_pair_within_radius():
    masks = simhash.masks()
    assert len(masks) == 7
    for i in range(64):
        for j in range(i, 64):
            change = 1 << i | 1 << j
            assert any(not m & change for m in masks)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def groups(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=repr)


def expected_groups(rows):
    prints = [brute.simhash(r[1]) for r in rows]
    root = brute.components(range(len(rows)), brute.fingerprint_links(prints))
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in root if root[j] == root[i] and rows[j][0] is not None]
        out.append((r[0], f"{prints[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=repr)


def test_simhash_of_the_test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    assert groups(simhash.simhash_groups(table)) == expected_groups(rows)


EDGE_TEXTS = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "a b"), (7, "A B c d e"), (8, "ÄÖ Ü ß é x"),
    (9, "one two three four"), (9, "one two three four"), (None, "one two three four"), (10, "w " * 40000),
]


def test_simhash_edge_rows(spark):
    rows = [(i, t, None, "s", 0) for i, t in EDGE_TEXTS]
    df = documents(spark, rows).withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(3))
    assert groups(simhash.simhash_groups(df)) == expected_groups(rows)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 4, 6, 7, 8, 9, 9, None, 10], key=repr)
    assert simhash.simhash_groups(documents(spark, [])).collect() == []


def test_large_buckets_link_what_pairs_link(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 1 << 62))
    prints = {base}
    for _ in range(500):
        flips = rng.integers(0, 64, int(rng.integers(1, 7)))
        prints.add(base ^ int(np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))))
    values = sorted(prints)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    root = brute.components(range(len(values)), brute.fingerprint_links(values))
    shape = sorted(sorted(j for j in root if root[j] == r) for r in set(root.values()))
    for direct in (simhash.DIRECT, 4, 1 << 20):
        monkeypatch.setattr(simhash, "DIRECT", direct)
        edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"))
        got = {r["node"]: r["root"] for r in components(edges, "test").collect()}
        by_root = {}
        for i, s in enumerate(signed):
            by_root.setdefault(got.get(s, s), []).append(i)
        assert sorted(map(sorted, by_root.values())) == shape


def removed(df):
    return {(None if r["doc"] == lines.NO_ID else r["doc"], r["line"]) for r in df.collect()}


def test_lines_of_the_test_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in table.collect()]
    assert removed(lines.repeated_lines(table)) == brute.removed_lines(docs)


def near_lines(seed=2, n=160):
    """Documents of lines that are copies, near copies at all similarities, and strangers."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    bases = [rng.choice(words, int(rng.integers(5, 40)), replace=False).tolist() for _ in range(40)]
    docs = []
    for d in range(n):
        made = []
        for _ in range(int(rng.integers(0, 6))):
            line = list(bases[int(rng.integers(0, len(bases)))])
            for _ in range(int(rng.integers(0, 1 + len(line) // 5))):
                line[int(rng.integers(0, len(line)))] = words[int(rng.integers(0, 400))]
            rng.shuffle(line)
            made.append(" ".join(line).replace("w1", "W1"))
        docs.append((int(d * 7 % n), "\n".join(made)))
    return docs


@pytest.mark.parametrize("limit", [lines.EARLIEST, 1])
def test_lines_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(lines, "EARLIEST", limit)
    docs = near_lines()
    table = documents(spark, [(d, t, None, None, 0) for d, t in docs]).repartition(5)
    want = brute.removed_lines(docs)
    assert removed(lines.repeated_lines(table)) == want
    cleaned = {r["doc_id"]: r for r in lines.dedup_lines(table).collect()}
    for d, t in docs:
        kept = [x for i, x in enumerate(t.split("\n")) if (d, i) not in want]
        assert cleaned[d]["text"] == "\n".join(kept)
        assert cleaned[d]["n_chars"] in (0, len(cleaned[d]["text"]))


def test_texts_are_read_twice_at_most_for_verification(spark, monkeypatch):
    monkeypatch.setattr(lines, "EARLIEST", 1)
    calls, verified = [], lines.verified
    monkeypatch.setattr(lines, "verified", lambda *a: calls.append(a) or verified(*a))
    docs = near_lines()
    table = documents(spark, [(d, t, None, None, 0) for d, t in docs]).repartition(3)
    assert removed(lines.repeated_lines(table)) == brute.removed_lines(docs)
    assert len(calls) == 2


def test_texts_that_lose_nothing_are_not_shuffled(spark):
    rows = [(d, f"line of its own number {d} k{d}\nother words {d} j{d} i{d} h{d}", None, None, 0) for d in range(200)]
    rows += [(300 + d, "\n".join(["the very same line of some words", f"x{d} y{d} z{d} w{d}"]), None, None, 0) for d in range(4)]
    out = lines.dedup_lines(documents(spark, rows).repartition(3))
    held = {r["doc_id"]: r["text"] for r in out.collect()}
    want = {d: t for d, t, *_ in rows} | {300 + d: f"x{d} y{d} z{d} w{d}" for d in (1, 2, 3)}
    assert held == want and out.count() == len(rows)
    # the texts' two ways: one without an exchange, one joined
    plan = out._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union" and sorted("Join" in plan.children().apply(i).toString() for i in range(2)) == [False, True]


def test_postings_are_handed_on_in_narrow_columns():
    rng = np.random.default_rng(5)
    some = np.zeros(1000, lines.POSTING)
    for f in ("token", "set", "low", "high"):
        some[f] = rng.integers(0, 1 << 32, 1000)
    some["doc"], some["line"], some["n"], some["pos"] = np.sort(rng.integers(-5, 90_000, 1000)) + (7 << 50), rng.integers(0, 200, 1000), 60, 12
    assert len(lines.columns_of(some)) <= 24 * 1000 + 5 * 1000 + 100  # 44 each before
    ends = some.copy()
    ends["doc"], ends["line"][:2] = rng.choice([lines.NO_ID, -1, 0, (1 << 63) - 1], 1000), (-1, (1 << 31) - 1)
    for records in (some, ends, some[:1], ends[:2], some[:0]):
        assert (lines.records_of(lines.columns_of(records), lines.POSTING) == records).all()


def test_postings_are_sorted_by_word_and_place():
    rng = np.random.default_rng(6)
    p = np.zeros(2000, lines.POSTING)
    p["token"], p["line"] = rng.integers((1 << 32) - 40, 1 << 32, 2000), rng.integers(0, 9, 2000)
    for docs in ([3, 4, 9], [lines.NO_ID, -1, (1 << 63) - 1], [0, 1 << 31]):
        p["doc"] = rng.choice(docs, 2000)
        keys = ["token", "doc", "line"]
        assert (p[keys][lines.by_word(p)] == np.sort(p[keys], order=keys)).all()
    assert len(lines.by_word(p[:0])) == 0


def test_line_edge_rows(spark):
    long = " ".join(f"z{i}" for i in range(300_000))
    docs = [(1, None), (2, ""), (3, "a b c d\na b c d"), (4, "a a a a a\nx\nA A a a a"), (5, "é b c d e f"), (6, "É b c d e f")]
    docs += [(None, "p q r s t"), (7, "p q r s t"), (8, "k l m n o"), (8, "k l m n o"), (9, long), (10, long + " end"), (11, "\n\n")]
    table = documents(spark, [(d, t, None, None, 1) for d, t in docs]).withColumn("doc", F.lit(1)).withColumn("line", F.lit("q"))
    got = removed(lines.repeated_lines(table))
    assert got == {(3, 1), (4, 2), (7, 0), (10, 0)}
    report = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["removed"]) for r in lines.line_report(table).collect()}
    assert report[4] == (3, 1, [2]) and report[1] == (1, 0, []) and report[11] == (3, 0, [])
    cleaned = lines.dedup_lines(table)
    assert cleaned.columns == table.columns and cleaned.count() == len(docs)
    assert lines.dedup_lines(documents(spark, [])).collect() == []


def test_short_lines_take_part(spark):
    texts = ["References", "a b c d", "References\nA b c d\nb c d a\na b c d e", "a b c\nx\n \n", "a b c a\nX y\ny x\n\n\t", "a b d"]
    texts += [f"p{i % 7} q{i % 3}\nr{i % 5} s t{i % 2} u\nr{i % 5} s t{i % 2} u v" for i in range(40)]
    docs = list(enumerate(texts))
    table = documents(spark, [(d, t, None, None, 0) for d, t in docs]).repartition(5)
    want = brute.removed_lines(docs)
    assert {(2, 0), (2, 1), (2, 2), (2, 3), (4, 0), (4, 2)} <= want
    assert removed(lines.repeated_lines(table)) == want
    cleaned = {r["doc_id"]: r["text"] for r in lines.dedup_lines(table).collect()}
    assert cleaned == {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in want) for d, t in docs}


def test_registered_query_removes_short_lines(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute.removed_lines([(r["doc_id"], r["text"]) for r in table.collect()])
    got = {(r["doc_id"], i) for r in queries.op10_line_dedup(spark, SF).collect() for i in r["removed"]}
    assert got == want


def test_rows_that_share_or_lack_an_id_lose_only_their_own_lines(spark):
    texts = [(None, "h i j k l\na b c d e"), (None, "m n o p q\nr s t u v"), (None, "h i j k l\nw x y z 0"), (None, "1 2 3 4 5\na b c d e")]
    texts += [(3, "h i j k l\none two three four five"), (3, "six seven eight nine ten\na b c d e"), (3, "six seven eight nine ten\nA B C D E F")]
    table = documents(spark, [(d, t, None, None, 0) for d, t in texts]).coalesce(1)
    kept = ["h i j k l\na b c d e", "m n o p q\nr s t u v", "w x y z 0", "1 2 3 4 5", "one two three four five", "six seven eight nine ten", ""]
    got = lines.dedup_lines(table)
    assert got.columns == table.columns
    assert sorted(r["text"] for r in got.collect()) == sorted(kept)
    report = sorted((r["doc_id"] or 0, r["removed"]) for r in lines.line_report(table).collect())
    assert report == sorted([(0, []), (0, []), (0, [0]), (0, [1]), (3, [0]), (3, [1]), (3, [0, 1])])


def test_keep_first_judges_each_row_by_its_text(spark):
    copy, own = "one two three four five six", "quite another text of many words here"
    rows = [(1, copy), (2, copy), (2, own), (3, copy), (4, "a third text that stays"), (None, copy)]
    got = simhash.keep_first(documents(spark, [(d, t, None, None, 0) for d, t in rows])).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted([rows[0], rows[2], rows[4], rows[5]], key=repr)


def test_required_overlap():
    t = Fraction("0.8")
    for n in range(1, 60):
        for m in range(1, 60):
            least = next((o for o in range(1, 200) if o * 10 >= 8 * (n + m - o)), None)
            assert lines.required(t, n, m) == least


def test_one_family_gives_few_candidates():
    rng = np.random.default_rng(0)
    base = rng.choice(10_000, 60, replace=False)
    texts = []
    for _ in range(800):
        line = base.copy()
        line[rng.integers(0, 60, 2)] = rng.integers(20_000, 90_000, 2)
        texts.append(" ".join(f"x{i}" for i in line).encode())
    p, _, _ = lines.postings(texts, np.arange(800), np.zeros(1 << lines.COUNT_BITS, np.uint8), Fraction("0.8"))
    p, _, u, _, _ = lines.candidates(p, Fraction("0.8"), lines.EARLIEST, None)
    assert 0 < len(u) <= lines.EARLIEST * len(p)


def brute_nearest(rows, queries, k):
    out = set()
    for q, x in queries:
        scores = sorted(((-float(np.dot(np.array(v), np.array(x))), i) for i, v in rows if i != q and len(v) == len(x)))
        out |= {(q, i) for _, i in scores[:k]}
    return out


def test_nearest_recall_and_order(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = neighbours.nearest(table, table.where("vec_id % 20 = 0"), 20).collect()
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in table.collect()]
    of = dict(rows)
    queries = [(i, v) for i, v in rows if i % 20 == 0]
    want = brute_nearest(rows, queries, 20)
    assert len({(r["query_id"], r["vec_id"]) for r in got} & want) / len(want) >= 0.9
    per = {}
    for r in got:
        assert r["query_id"] != r["vec_id"]
        assert abs(r["score"] - float(np.dot(of[r["query_id"]], of[r["vec_id"]]))) < 1e-12
        per.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    assert len(per) == len(queries)
    for rows_ in per.values():
        rows_.sort()
        assert [r[0] for r in rows_] == list(range(1, 21))
        assert [r[1:] for r in rows_] == sorted(r[1:] for r in rows_)


def test_nearest_edge_rows(spark, monkeypatch):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [-5.0, 0.5]), (4, None), (5, [0.0, 0.0]), (6, [None, 1.0])]
    rows += [(7, [float("nan"), 1.0]), (8, [1.0]), (20, [3.0, 4.0]), (20, [3.0, 4.0]), (40, [2.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = {}
    for r in neighbours.nearest(table, table.where("vec_id % 20 = 0"), 3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert {q: sorted(v) for q, v in got.items()} == {
        0: [(1, 20, 3.0), (2, 1, 1.0), (3, 2, 1.0)],
        20: [(1, 0, 3.0), (2, 1, 3.0), (3, 2, 3.0)],
        40: [(1, 8, 2.0)],
    }
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(none, none, 3).collect() == []
    # hot buckets are split, and every slice is visited
    many = spark.range(400).selectExpr("id AS vec_id", "array(1D, 0D, id % 2 * 0D) AS embedding")
    small = neighbours.Settings(block=16)
    found = neighbours.nearest(many, many.where("vec_id % 20 = 0"), 5, small).collect()
    assert len(found) == 20 * 5
    assert all(r["vec_id"] == [i for i in range(6) if i != r["query_id"]][r["rank"] - 1] for r in found)
