"""Index versions, rejected lines and the life of broadcast tiles."""

import os

import numpy as np
import pytest

from tests.support import collected, embedded_table, question_table, vector_table
from wellspring.operators import search as search_module
from wellspring.operators.search import search
from wellspring.plans.ingest import build_index
from wellspring.sources import index as index_module
from wellspring.sources.index import drop_versions, load_index, versions
from wellspring.sources.tables import checked_chunk_lines
from wellspring.workspace import exists, publish, published, read_published, scratch


def rows(n, value):
    return [(i, 0, f"t{i}", [float(value), float(i)]) for i in range(n)]


def test_readers_keep_their_version_while_another_is_built(spark):
    path = scratch(spark, "t")
    reader = build_index(embedded_table(spark, rows(5, 1)), path, 2)
    plan = reader.positioned()
    newer = build_index(embedded_table(spark, rows(9, 2)), path, 2)
    assert plan.count() == 5 and newer.size().first().ntotal == 9
    assert load_index(spark, path).size().first().ntotal == 9
    assert load_index(spark, path, 0).size().first().ntotal == 5
    with pytest.raises(ValueError):
        load_index(spark, path, 7)


def test_a_build_cut_short_leaves_the_old_index(spark, monkeypatch):
    path = scratch(spark, "t")
    build_index(embedded_table(spark, rows(5, 1)), path, 2)

    def cut(*_):
        raise OSError("killed")

    for name in ("slot_table", "publish"):
        with monkeypatch.context() as patch:
            patch.setattr(index_module, name, cut)
            with pytest.raises(OSError):
                build_index(embedded_table(spark, rows(9, 2)), path, 2)
        assert load_index(spark, path).size().first().ntotal == 5
    assert len(versions(spark, path)) == 1


def test_old_versions_are_dropped(spark):
    path = scratch(spark, "t")
    for n in (1, 2, 3):
        build_index(embedded_table(spark, rows(n, 1)), path, 2)
    first = versions(spark, path)[0]["version"]
    assert drop_versions(spark, path) == 1 and not exists(spark, f"{path}/{first}")
    assert [v["number"] for v in versions(spark, path)] == [1, 2]
    assert load_index(spark, path).size().first().ntotal == 3
    assert drop_versions(spark, scratch(spark, "none")) == 0


def test_manifest_entries_get_the_next_free_number(spark):
    folder = scratch(spark, "m")
    assert published(spark, folder) == []
    assert [publish(spark, folder, {"n": i}) for i in range(12)] == list(range(12))
    assert published(spark, folder) == list(range(12)) and read_published(spark, folder, 10) == {"n": 10}


def test_malformed_lines_are_set_aside(spark, tmp_path):
    good = '{"title":"T","chunk_text":"x y"}'
    (tmp_path / "a.json").write_text(f'{good}\nnot json\n\n   \n{{"title":"T","chunk_no":"many"}}\n[1]\n{good}}}\n')
    (tmp_path / "b.json").write_text(f'{good}\n{{"other":1}}\nnull\n')
    chunks, rejects = checked_chunk_lines(spark, str(tmp_path / "a.json"), str(tmp_path / "b.json"))
    told = [(r.file.rsplit("/", 1)[1], r.line) for r in rejects.collect()]
    assert ("a.json", "not json") in told and ("a.json", '{"title":"T","chunk_no":"many"}') in told and ("b.json", "null") in told
    assert all(f == "a.json" or line == "null" for f, line in told)
    kept = collected(chunks.select("title", "chunk_text"), "title")
    assert len(kept) + len(told) == 8 and kept.count(("T", "x y")) >= 2 and (None, None) in kept


def test_one_broadcast_tile_at_a_time(spark, monkeypatch):
    shared, real = [], search_module._shared

    def watched(*arguments):
        assert all(not os.path.exists(b._path) for b in shared)
        shared.append(real(*arguments))
        return shared[-1]

    monkeypatch.setattr(search_module, "_shared", watched)
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(40, 4)).astype(np.float32)
    table = vector_table(spark, range(40), vectors)
    out = search(table, question_table(spark, vectors), k=1, id_col="vec_id", tile_bytes=4 * 4 * 4)
    assert len(shared) >= 10 and not any(os.path.exists(b._path) for b in shared)
    assert all(int(r.query_id) == r.vec_id for r in out.collect())
