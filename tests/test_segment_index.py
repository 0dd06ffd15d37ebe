"""The index as a log of segments: creation, small writes, commits, pruned reads, changes."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataseek.operators import segment_index
from strataseek.operators.commit_log import CommitLog
from strataseek.operators.fulltext import bm25_top_k
from strataseek.operators.index_table import change_feed
from strataseek.operators.segment_index import create_index, open_index
from strataseek.operators.vector_search import exact_top_k
from strataseek.plans.retrieval import SearchIndex, search


def made(spark, rows):
    return spark.createDataFrame(rows, "chunk_id string, embedding array<double>, tokens array<string>")


@pytest.fixture()
def stored(spark, tmp_path):
    random = np.random.default_rng(3)
    rows = [(f"c{i}", [float(x) for x in random.normal(size=4)], [f"t{i % 7}", f"u{i % 3}", "all"]) for i in range(60)]
    return create_index(made(spark, rows), str(tmp_path / "index"), np.eye(4)), rows


def keys(df):
    return sorted(r[0] for r in df.select("chunk_id").collect())


def ranked(df):
    return sorted((r.query_id, r["rank"], r.chunk_id) for r in df.collect())


def queries(spark):
    return spark.createDataFrame([(1, "t1 all", [1.0, 0.0, 0.5, 0.0]), (2, "none", [0.0, 1.0, 0.0, 0.0]),
                                  (3, "new u2", [0.1, -1.0, 0.0, 0.0])],
                                 "query_id long, query string, query_vector array<double>")


def test_create_open_and_keep(spark, stored, tmp_path):
    index, rows = stored
    assert index.rows.count() == 60 and index.settings["dimension"] == 4 and index.size == (60, 3.0)
    again = create_index(made(spark, rows[:1]), index.path, np.eye(4))
    assert again.rows.count() == 60 and again.version == 0
    with pytest.raises(FileNotFoundError):
        open_index(spark, str(tmp_path / "nothing"))
    with pytest.raises(FileNotFoundError):
        open_index(spark, index.path, 7)
    assert {r.field for r in index.describe().collect()} == {"chunk_id", "embedding", "tokens"}


def test_empty_index(spark, tmp_path):
    index = create_index(made(spark, []), str(tmp_path / "none"), np.eye(4))
    assert index.rows.count() == 0
    assert index.keyword_top_k(queries(spark), 3).count() == 0
    index.upsert(made(spark, [("a", [1.0, 0.0, 0.0, 0.0], ["new"])]))
    assert keys(index.rows) == ["a"] and keys(index.keyword_top_k(queries(spark), 3)) == ["a"]


def check_searches(spark, index):
    """All three searches equal a scan of the living rows."""
    whole, plain = SearchIndex.of(index), SearchIndex(index.rows)
    assert ranked(search(whole, queries(spark), "ANN", 7, columns=())) == ranked(exact_top_k(index.rows, queries(spark), 7))
    assert ranked(search(whole, queries(spark), "FULL_TEXT", 7, columns=())) == ranked(bm25_top_k(index.rows, queries(spark), 7))
    assert ranked(search(whole, queries(spark), "HYBRID", 9, columns=())) == \
        ranked(search(plain, queries(spark), "HYBRID", 9, columns=()))


def test_search_equals_the_scan_after_every_kind_of_write(spark, stored):
    index, _ = stored
    check_searches(spark, index)
    index.upsert(made(spark, [("c1", [0.0, 9.0, 0.0, 0.0], ["new", "all"]), ("x1", [0.0, 8.0, 0.0, 0.0], ["new", "u2"])]))
    index.delete(spark.createDataFrame([("c2",), ("c3",), ("unknown",), (None,)], "chunk_id string"))
    assert index.size[0] == 59
    check_searches(spark, index)
    assert index.merge(share=1.0) and not index.state["operation"] == "upsert"
    assert len([s for s in index.segments if s.rows]) == 1 and index.size[0] == 59
    check_searches(spark, index)
    index.upsert(made(spark, [("x1", [1.0, 0.0, 0.0, 0.0], [])]))
    check_searches(spark, open_index(spark, index.path))


def test_upsert_report_stamps_and_earlier_versions(spark, stored):
    index, rows = stored
    batch = made(spark, [("c1", [0.0, 9.0, 0.0, 0.0], ["new"]), ("x1", [0.0, 8.0, 0.0, 0.0], ["new", "all"]),
                         (None, [0.0, 1.0, 0.0, 0.0], []), ("bad", [1.0], [])])
    report, failed = index.upsert(batch, stamp=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert tuple(report.first()) == ("FAILURE", 2, 2)
    assert {r[0] for r in failed.collect()} == {None, "bad"}
    again = open_index(spark, index.path)
    assert again.version == 1 and again.rows.count() == 61
    assert {r.chunk_id: r.updated_at for r in again.rows.filter("updated_at is not null").collect()} == {
        "c1": "2024-01-01T00:00:00", "x1": "2024-01-01T00:00:00"}
    assert open_index(spark, index.path, 0).rows.count() == 60
    assert keys(open_index(spark, index.path, 0).rows) == sorted(r[0] for r in rows)


def test_an_upsert_writes_in_proportion_to_its_batch(spark, stored):
    index, _ = stored
    index.upsert(made(spark, [("c1", [0.0, 9.0, 0.0, 0.0], ["new"])]))
    first, last = index.segments[0], [s for s in index.segments if s.rows][-1]
    assert (first.rows, last.rows) == (60, 1)
    for kind, rows in (("rows", 1), ("numbers", 1), ("blocks", 1)):
        assert spark.read.parquet(f"{index.path}/{kind}/segment={last.id}").count() == rows


def test_reads_are_pruned(spark, tmp_path):
    random = np.random.default_rng(4)
    rows = made(spark, [(f"c{i}", [float(x) for x in random.normal(size=4)], ["t"]) for i in range(400)])
    cells = segment_index.Quantiser(np.eye(4), np.vstack([np.eye(4) + 0.1, np.eye(4) - 0.1]), np.array([0, 1, 2, 3] * 2))
    index = create_index(rows, str(tmp_path / "pruned"), cells)
    near = index.cells([5])
    assert {f.split("top=")[1].split("/")[0] for f in near.inputFiles()} <= {"0", "1", "2", "3"}
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "top" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r.cell for r in near.select("cell").distinct().collect()} == {5}


def test_two_writers_cannot_take_one_version(spark, stored):
    index, _ = stored
    log = CommitLog(spark, f"{index.path}/commits")
    assert not log.claim(0, {"version": 0}) and log.read(0)["operation"] == "create"
    errors = []

    def write(name):
        try:
            open_index(spark, index.path).upsert(made(spark, [("c5", [1.0, 0.0, 0.0, 0.0], [name]), (name, [0.0, 1.0, 0.0, 0.0], [name])]))
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=write, args=(n,)) for n in ("left", "right")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and log.versions() == [0, 1, 2]
    both = open_index(spark, index.path)
    assert both.rows.count() == 62 and both.size[0] == 62
    assert both.rows.filter("chunk_id = 'c5'").count() == 1
    check_searches(spark, both)


def test_a_late_writer_looks_up_again_what_it_replaces(spark, stored):
    index, _ = stored
    late = open_index(spark, index.path)
    index.upsert(made(spark, [("y", [1.0, 0.0, 0.0, 0.0], ["one"])]))
    late.upsert(made(spark, [("y", [0.0, 1.0, 0.0, 0.0], ["two"])]))
    assert late.version == 2 and [r.tokens for r in late.rows.filter("chunk_id = 'y'").collect()] == [["two"]]
    assert [r.change_type for r in late.changes(1).collect()] == ["update"]


def test_changes_by_version(spark, stored):
    index, rows = stored
    before = made(spark, rows)
    index.upsert(made(spark, [("c1", [0.0, 9.0, 0.0, 0.0], ["new"]), ("x1", [0.0, 8.0, 0.0, 0.0], ["new"]), rows[4]]))
    index.delete(made(spark, [rows[2], ("x1", [], [])]))
    index.upsert(made(spark, [("x2", [0.0, 8.0, 0.0, 0.0], ["new"])]))
    assert sorted((r.version, r.chunk_id, r.change_type) for r in index.changes(0).collect()) == [
        (1, "c1", "update"), (1, "c4", "update"), (1, "x1", "insert"), (2, "c2", "delete"), (2, "x1", "delete"), (3, "x2", "insert")]
    assert keys(index.changes(1, 2)) == ["c2", "x1"] and index.changes(3).count() == 0
    image = index.changes(0, 1).filter("chunk_id = 'c1'").first()
    assert image.before.tokens == rows[1][2] and image.after.tokens == ["new"]
    fields = ["chunk_id", "embedding", "tokens"]
    for after, up_to in ((0, None), (0, 1), (1, 2)):
        old = before if after == 0 else open_index(spark, index.path, after).rows.select(*fields)
        new = open_index(spark, index.path, up_to).rows.select(*fields)
        assert sorted(map(tuple, index.net_changes(after, up_to).collect())) == sorted(map(tuple, change_feed(old, new).collect()))
    plan = index.net_changes(0)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_clone_shares_segments_and_goes_its_own_way(spark, stored, tmp_path):
    index, _ = stored
    copy = index.clone(str(tmp_path / "copy"))
    copy.delete(spark.createDataFrame([("c1",)], "chunk_id string"))
    assert copy.rows.count() == 59 and open_index(spark, index.path).rows.count() == 60
    assert open_index(spark, copy.path).rows.count() == 59
    check_searches(spark, copy)


def test_merge_when_there_are_many_segments(spark, stored, monkeypatch):
    monkeypatch.setattr(segment_index, "MERGE_FROM", 2)
    index, _ = stored
    for k in range(4):
        index.upsert(made(spark, [(f"n{k}", [1.0, 0.0, 0.0, float(k)], ["new"]), ("c7", [1.0, 1.0, 0.0, float(k)], [f"v{k}"])]))
    assert len([s for s in index.segments if s.rows]) <= 3 and index.rows.count() == 64
    check_searches(spark, index)
