"""The filter audit, the repair of conversations and best-fit packing."""

import random
import zlib
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import plain
from wellspring.llm import audit, best_fit, queries, repair
from wellspring.llm.byte_ids import SpacedWordIds
from wellspring.workspace import stage

SF = "/root/testdata/sf0.01"
BYTES = public_tokenizers.path("byte_bpe_50k.json")


# audit


def audited(rows):
    return sorted(tuple(r) for r in rows.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect())


def by_sql(docs, labels):
    connection = duckdb.connect()
    documents = docs.toPandas()
    marks = labels.toPandas()
    connection.register("documents", documents)
    connection.register("labels", marks)
    names = "part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley"
    return sorted(connection.sql(f"SELECT {names} FROM ({audit.oracle()})").fetchall())


AUDIT_ROWS = [
    (1, "a b c " * 40, "x"), (2, "a b c " * 40, "x"), (3, None, None), (4, "", ""), (5, "É " * 30 + "A" * 9, None), (6, "\x00 \x1c\x85 x", "y"),
    (7, " ".join(f"w{i}" for i in range(60)), "y"), (8, "100 % #", "y"), (9, " ".join(f"W{i}" for i in range(60)), "y"), (9, "twice", "y"), (9, "twice", "x"),
    (10, "long " * 700_000 + "A end", "z"), (11, "long " * 700_000 + "A end", "z"), (12, " \xa0 a\vb\fc", "z"),
]


def test_audit_of_edge_rows(spark, monkeypatch):
    docs = spark.createDataFrame(AUDIT_ROWS, "doc_id long, text string, source string").repartition(3)
    docs = docs.withColumns({"mask": F.lit("q"), "part": F.lit(1), "digest": F.lit(2)})
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, 1, None), (5, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    want = by_sql(docs.select("doc_id", "text", "source"), labels)
    assert audited(audit.audit(docs, labels)) == want
    monkeypatch.setattr(audit, "SHARD_BYTES", 100)
    monkeypatch.setattr(audit, "HOT", 2)  # both joins of copies
    assert audited(audit.audit(docs, labels)) == want
    none = docs.limit(0)
    assert audit.audit(none, labels).collect() == []


def test_audit_without_ids(spark):
    rows = [(None, "same text", "s"), (None, "same text", "s"), (3, "same text", "s"), (4, "same text", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(4, 1, 1)], "doc_id long, quality int, toxic int")
    got = {(r["filter_order"], r["step"]): r for r in audit.audit(docs, labels).collect()}
    assert len(got) == 600 and {o for o, _ in got} == {"".join(o) for o in permutations("ABCDE")}
    first = got["EABCD", 1]
    assert (first["kept"], first["removed"], first["good_lost"], first["toxic_lost"]) == (3, 1, 1, 1)
    assert got["EABCD", 2]["redundant"] == 1


def test_terms_have_one_code_for_the_whole_table(spark, monkeypatch):
    monkeypatch.setattr(audit, "SHARD_BYTES", 2000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(4)
    told, codes = {}, {}
    for r in audit.document_terms(docs).collect():
        starts, code, count = np.frombuffer(r["starts"], "<i8"), audit.unpacked(r["codes"]), audit.unpacked(r["counts"])
        for k, d in enumerate(r["doc_id"]):
            told[d] = sorted(zip(code[starts[k] : starts[k + 1]].tolist(), count[starts[k] : starts[k + 1]].tolist()))
    for r in docs.collect():
        words = {}
        for w in r["text"].encode().split():
            words[w] = words.get(w, 0) + 1
        assert sorted(words.values()) == sorted(n for _, n in told[r["doc_id"]])
        for w in words:
            codes.setdefault(w, set(c for c, _ in told[r["doc_id"]])).intersection_update(c for c, _ in told[r["doc_id"]])
    assert all(codes.values()) and len({c for t in told.values() for c, _ in t}) == len(codes)


# repair


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_repair_of_the_test_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    left = plain.damaged(rows)
    got = queries.op12_conversation_repair(spark, SF).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == {c: plain.repair(left.get(c, [])) for c in {r[0] for r in rows}}


def test_auction_finds_the_least_of_all_cheapest_repairs():
    rnd, role = random.Random(1), {"s": "system", "u": "user", "a": "assistant", "x": "xx", "": ""}
    for _ in range(800):
        n = rnd.randrange(0, 9)
        initials = [rnd.choice("suaux") if rnd.random() < 0.95 else "" for _ in range(n)]
        marks = [rnd.choice([repair.OK, repair.OK, repair.BLANK, repair.TRUNCATED]) for _ in range(n)]
        rows = [(i, role[c], {0: f"{i}.", 1: " ", 3: f"{i}"}[m]) for i, (c, m) in enumerate(zip(initials, marks))]
        want = plain.repair(rows)
        price = repair.auction(initials, marks)
        edits, _ = repair.trace(initials, marks, price, repair.START, True)
        assert (price[0], "".join(edits)) == (want[5], want[6])
        for k in range(n + 1):  # prices are dual feasible
            for s in range(4):
                assert all(price[4 * k + s] <= cost + price[j] for _, cost, j in repair.arcs(initials, marks, k, s))


def test_repair_across_slots_and_edge_rows(spark):
    rnd = random.Random(7)
    rows = [(1, i, rnd.choice(["user", "assistant", "system", "a", None]), rnd.choice(["Yes.", "no", f"t{i}!", f"t{i}", " ", None])) for i in range(900)]
    rows += [(2, None, "user", "x?"), (2, 5, "assistant", "y" * 200_000 + "."), (3, 9, None, None), (None, 1, "user", "hm."), (None, 2, "assistant", "ok.")]
    rows += [(4, 7, "user", "same."), (4, 7, "user", "same."), (5, 2, "assistant", "a.\x85"), (5, 1, "system", "  .\v"), (6, 1, "", "")]
    table = conversations(spark, rows).withColumns({"slot": F.lit(1), "fault": F.lit("x"), "row_key": F.lit(3)}).repartition(5)
    for harmed, own in ((False, {}), (True, plain.damaged(rows))):
        if not harmed:
            show = lambda x: " " if x is None else x
            for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
                own.setdefault(c, []).append((t, show(r), show(x)))
        found = repair.repair_damaged(table) if harmed else repair.repair(table)
        got = {r["conv_id"]: tuple(r)[1:] for r in found.collect()}
        assert got == {c: plain.repair(own.get(c, [])) for c in {r[0] for r in rows}}
    ordered = repair.in_turn(conversations(spark, rows))
    assert ordered.where("conv_id = 1").select("slot").distinct().count() > 1
    assert repair.repair_damaged(conversations(spark, [])).collect() == []


def test_a_conversation_may_lose_all_rows(spark):
    lost = next(t for t in range(1000) if zlib.crc32(f"8:{t}".encode()) % 20 == 0)
    got = repair.repair_damaged(conversations(spark, [(8, lost, "user", "a.")])).collect()
    assert [tuple(r)[1:] for r in got] == [plain.repair([])]


# best fit


TRICKY = ["a", "The", "don't", "it's 's", "  ", "\n", "\n\n", " ", "\t", "x1y22", "é", "À", "...", "\xa0", "　", "\x85", "ª", "µß", "日本語", "😀",
          "<|endoftext|>", "\r\n", "\x1c", "\x00", "_", "''", "'S", "'re", " ", "1２", "a\xa0b", "١"]


def test_ids_equal_the_library():
    table, library, rnd = SpacedWordIds(BYTES), Tokenizer.from_file(BYTES), random.Random(3)
    library.encode_special_tokens = True
    for _ in range(600):
        texts = ["".join(rnd.choice(TRICKY) for _ in range(rnd.randrange(9))) for _ in range(rnd.randrange(1, 6))]
        got = [x.tolist() for x in table.of_texts([t.encode() for t in texts])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    long = ("Some words,\nand lines. " * 150_000 + "\xa0 end").encode()
    assert list(table.whole(long)) == library.encode(long.decode(), add_special_tokens=False).ids


def check_sequences(rows):
    filled = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= best_fit.LENGTH
    return len(filled)


def test_best_fit_of_the_test_table(spark):
    library = Tokenizer.from_file(BYTES)
    rows = queries.op13_best_fit_packing(spark, SF).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = np.array([*library.encode(d["text"] or "", add_special_tokens=False).ids, best_fit.END_ID], "<u4")
        at = 0
        for number, r in enumerate(sorted(by_doc.pop(d["doc_id"]), key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (number, at) and (number == 0 or r["length"] == best_fit.LENGTH)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and (number == 0) == (at <= best_fit.LENGTH)
    assert not by_doc
    assert check_sequences(rows) <= plain.best_fit_decreasing([r["length"] for r in rows])


@pytest.mark.parametrize("kind", ["mixed", "small", "tiny", "hot"])
def test_rounds_of_sweeps_come_near_the_serial_algorithm(spark, monkeypatch, kind):
    monkeypatch.setattr(best_fit, "SWEEP", 1500)
    rng = np.random.default_rng(1)
    sizes = {
        "mixed": rng.integers(1, 1024, 9000), "small": rng.integers(1, 400, 9000), "tiny": np.full(9000, 7),
        "hot": np.concatenate([np.full(4500, 341), rng.integers(1, 1024, 4500)]),
    }[kind].tolist()
    table = stage(spark.createDataFrame(list(enumerate(sizes)), "key long, length long").repartition(4), "test-sizes")
    placed = {r["key"]: r for r in best_fit.seats(table).collect()}
    rows = [
        {"sequence_id": placed[i]["sequence"], "offset": placed[i]["offset"], "length": s} if i in placed else {"sequence_id": i, "offset": 0, "length": s}
        for i, s in enumerate(sizes)
    ]
    assert check_sequences(rows) <= 1.02 * plain.best_fit_decreasing(sizes) + 1


def test_best_fit_edge_rows(spark):
    texts = ["", None, " ", "a", "a", "word " * 3000, "x" * 5000, "\n\n", "a\xa0 b"]
    docs = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = docs.union(docs.where("doc_id = 5")).withColumns({c: F.lit("q") for c in ("key", "kind", "length", "sequence", "offset")})
    rows = best_fit.pack(docs, BYTES).collect()
    check_sequences(rows)
    library = Tokenizer.from_file(BYTES)
    total = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for t in [*texts, texts[5]])
    assert sum(r["length"] for r in rows) == total and {r["doc_id"] for r in rows} == {None, *range(1, 9)}
    assert best_fit.pack(docs.limit(0), BYTES).collect() == []
