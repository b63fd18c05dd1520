"""Runs that overlap: commits, the hash index behind them, loads from several threads."""

import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from scenarios import write_csv

from quittance.plans import settlement
from quittance.plans.settlement import Warehouse
from quittance.sources import hash_index, loading, specs
from quittance.sources.commits import CommitLog
from quittance.sources.loading import FAILED, MISSING, OK, RawStore, Run
from quittance.sources.specs import Export

EXPORT = Export(stem="small", table="small")


def run(day):
    return Run(datetime(2025, 3, day, 6))


def rows(*keys):
    return [{"a": str(k), "b": "x"} for k in keys]


@pytest.fixture
def store(spark, tmp_path):
    return RawStore(spark, str(tmp_path / "raw"))


def load(store, path, day, listed):
    write_csv(path, listed)
    return store.load_one(str(path), EXPORT, run(day))


# ---- commits -------------------------------------------------------------------------------


def test_a_number_is_committed_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.state() == (0, [])
    assert log.commit(1, ["a"])
    assert not log.commit(1, ["b"])
    assert log.commit(2, ["a", "b"])
    assert log.state() == (2, ["a", "b"])
    assert [p.name for p in (tmp_path / "log").iterdir() if p.name.startswith(".draft")] == []


def test_of_many_threads_one_wins_each_number(spark, tmp_path):
    won = []

    def race(name):
        log = CommitLog(spark, str(tmp_path / "log"))
        for _ in range(50):
            number, lines = log.state()
            if log.commit(number + 1, [*lines, name]):
                won.append(name)
                return

    threads = [threading.Thread(target=race, args=(f"r{i}",)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == sorted(CommitLog(spark, str(tmp_path / "log")).state()[1]) == [f"r{i}" for i in range(8)]


# ---- overlapping loads -----------------------------------------------------------------------


def interleave(monkeypatch, store, between):
    """Calls ``between`` once, after the next run has written its rows and before it commits."""
    write, due = RawStore._write, [between]

    def written(self, marked, table, this_run):
        counts = write(self, marked, table, this_run)
        if due:
            due.pop()()
        return counts

    monkeypatch.setattr(RawStore, "_write", written)


@pytest.mark.parametrize("loaded_before", [True, False])
def test_two_interleaved_runs_insert_no_row_twice(store, tmp_path, monkeypatch, loaded_before):
    if loaded_before:
        load(store, tmp_path / "zero.csv", 1, rows(1, 2))
    other = RawStore(store.spark, store.root)
    outcome = []
    interleave(monkeypatch, store, lambda: outcome.append(load(other, tmp_path / "two.csv", 3, rows(1, 2, 3, 4))))
    first = load(store, tmp_path / "one.csv", 2, rows(1, 2, 3, 3, 5))
    (second,) = outcome
    assert (second.status, second.rows_inserted) == (OK, 2 if loaded_before else 4)
    # the loser looked again: 3 is known by now, 5 is not
    assert (first.status, first.rows_in_file, first.rows_inserted, first.rows_skipped) == (OK, 5, 1, 4)
    assert sorted(r.a for r in store.read("small").collect()) == ["1", "2", "3", "4", "5"]
    number, runs = store.commits("small").state()
    assert number == 1 + len(runs) == (4 if loaded_before else 3)  # the first commit named no run


def test_a_run_that_never_committed_is_not_read(store, tmp_path, monkeypatch):
    load(store, tmp_path / "one.csv", 1, rows(1))
    monkeypatch.setattr(CommitLog, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped here")))
    assert load(store, tmp_path / "two.csv", 2, rows(1, 2)).status == FAILED
    monkeypatch.undo()
    assert store.read("small").count() == 1
    assert load(store, tmp_path / "two.csv", 3, rows(1, 2)).rows_inserted == 1


# ---- index -----------------------------------------------------------------------------------


def test_the_index_follows_the_table_even_if_it_was_lost(store, tmp_path, spark):
    load(store, tmp_path / "one.csv", 1, rows(*range(50)))
    load(store, tmp_path / "two.csv", 2, rows(*range(80)))
    index = store.index("small")
    assert index.entered() == {run(1).run_id, run(2).run_id}
    assert index.known([run(2).run_id]).count() == 30
    for marker in (tmp_path / "raw" / "index" / "small").rglob(run(2).run_id):
        marker.unlink()
    assert load(store, tmp_path / "three.csv", 3, rows(*range(81))).rows_inserted == 1
    assert index.entered() == {run(d).run_id for d in (1, 2, 3)}
    # a session that has not seen the table finds it
    spark.sql(f"drop table {index.name}")
    assert index.known([run(1).run_id, run(2).run_id]).count() == 80


def test_a_look_up_moves_no_known_hash_and_reads_only_its_slices(store, tmp_path, spark):
    load(store, tmp_path / "one.csv", 1, rows(*range(300)))
    few = spark.createDataFrame([("0" * 32,), ("00" + "f" * 30,)], "h string").select(F.unhex("h").alias(hash_index.HASH))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = store.index("small").unknown(few, [run(1).run_id])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    (scan,) = [i for i, line in enumerate(lines) if store.index("small").name in line]
    (join,) = [i for i, line in enumerate(lines) if "SortMergeJoin" in line]
    exchanges = [i for i, line in enumerate(lines) if "Exchange" in line]
    assert "Bucketed: true" in lines[scan] and "slice" in lines[scan]
    # the side of the incoming hashes comes first in the text; nothing is exchanged below it
    depth = lambda i: len(lines[i]) - len(lines[i].lstrip(" :+-"))
    right = max(i for i in range(join + 1, scan) if lines[i].lstrip(" :").startswith("+- ") and depth(i) == depth(join) + 3)
    assert exchanges and all(i < right for i in exchanges), plan
    assert store.index("small").known([run(1).run_id], {0}).inputFiles() != store.index("small").known([run(1).run_id]).inputFiles()


# ---- surrogates -------------------------------------------------------------------------------


def test_two_interleaved_runs_number_no_id_twice(spark, tmp_path, monkeypatch):
    for name, ids in (("one", range(0, 30)), ("two", range(20, 60))):
        (tmp_path / name).mkdir()
        listed = [{"Business ID": str(i), "Business name": f"Shop {i}", "Campaign name": "x"} for i in ids]
        write_csv(tmp_path / name / "marketing_promotion.csv", listed)
    house, private = Warehouse(spark, str(tmp_path / "house")), str(tmp_path / "private")
    number_ids, due = settlement.anon.number_ids, [True]

    def numbered(ids, stored=None):
        made = number_ids(ids, stored)
        if due:
            due.pop()
            house.anonymise_folder(str(tmp_path / "two"), private, run(2))
        return made

    monkeypatch.setattr(settlement.anon, "number_ids", numbered)
    house.anonymise_folder(str(tmp_path / "one"), private, run(1))
    mapping = house._mapping(f"{private}/surrogate_mapping")[2].collect()
    assert len(mapping) == len({r.value for r in mapping}) == len({r.surrogate for r in mapping}) == 60
    assert house.repair_mapping(private) == 0


def test_a_mapping_from_before_commits_is_read_and_repaired(spark, tmp_path):
    where = tmp_path / "private" / "surrogate_mapping"
    old = [("business_id", "7", "9000001"), ("business_id", "7", "9000005"), ("business_id", "8", "9000002")]
    spark.createDataFrame(old, "kind string, value string, surrogate string").write.parquet(str(where))
    (tmp_path / "in").mkdir()
    write_csv(tmp_path / "in" / "marketing_promotion.csv", [{"Business ID": "9", "Campaign name": "x"}])
    house, private = Warehouse(spark, str(tmp_path / "house")), str(tmp_path / "private")
    with pytest.raises(ValueError, match="repair_mapping"):
        house.anonymise_folder(str(tmp_path / "in"), private, run(1))
    assert house.repair_mapping(private) == 1
    house.anonymise_folder(str(tmp_path / "in"), private, run(2))
    found = {r.value: r.surrogate for r in house._mapping(str(where))[2].collect()}
    assert found == {"7": "9000001", "8": "9000002", "9": "9000006"}


# ---- several loads at once ----------------------------------------------------------------------


def test_exports_load_at_once_and_one_failure_leaves_the_others(store, tmp_path, monkeypatch, spark):
    folder = tmp_path / "in"
    folder.mkdir()
    names = [f"set{i}" for i in range(8)]
    exports = [Export(stem=n, table=n) for n in names]
    for n in names[:6]:
        write_csv(folder / f"{n}.csv", rows(1, 2, n))
    (folder / "set6.csv").write_text("a,b\n1,2,3\n")  # set7 is missing
    together, pools, barrier = [], [], threading.Barrier(7, timeout=60)
    append = RawStore.append

    def appended(self, export, file_name, table, this_run):
        pools.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        barrier.wait()  # all seven that have a file are inside
        together.append(table)
        return append(self, export, file_name, table, this_run)

    monkeypatch.setattr(RawStore, "append", appended)
    spark.sparkContext.setLocalProperty("quittance.test", "inherited")
    results = store.load_folder(str(folder), run(1), exports=exports)
    spark.sparkContext.setLocalProperty("quittance.test", None)
    assert [r.target_table for r in results] == names
    assert [r.status for r in results] == [OK] * 6 + [FAILED, MISSING]
    assert [r.rows_inserted for r in results] == [3] * 6 + [0, 0]
    assert sorted(pools) == names[:7] and len(together) == 7
    log = store.log().collect()
    assert sorted((r.target_table, r.status, r.rows_inserted) for r in log) == sorted(
        (r.target_table, r.status, r.rows_inserted) for r in results
    )


def test_a_data_set_of_several_files_under_noisy_names(store, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write_csv(folder / "0a1b2c3d-small_2025-01-01_2025-01-31_x.csv", rows(1, 2))
    write_csv(folder / "small_2025-02-01_2025-02-28_y.csv", rows(2, 3))
    (result,) = store.load_folder(str(folder), run(1), exports=[EXPORT])
    assert (result.status, result.rows_in_file, result.rows_inserted) == (OK, 4, 4)
    # the same data under its plain name is known
    write_csv(folder / "small.csv", rows(1, 2, 3, 4))
    (result,) = store.load_folder(str(folder), run(2), exports=[EXPORT])
    assert (result.rows_in_file, result.rows_inserted) == (8, 1)
    assert {r[0] for r in store.read("small").select(specs.SOURCE_FILE).distinct().collect()} == {"small.csv"}


def test_a_missing_folder_is_missing_exports(store, tmp_path):
    results = store.load_folder(str(tmp_path / "nowhere"), run(1), exports=[EXPORT])
    assert [r.status for r in results] == [loading.MISSING]
