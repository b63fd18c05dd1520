import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from scenarios import Scenario, write_csv

from quittance.plans.settlement import Warehouse
from quittance.session import METHOD_LIMIT
from quittance.sources import exports, loading, specs
from quittance.sources.exports import dataset_name, list_exports, read_export, write_export
from quittance.sources.loading import FAILED, MISSING, OK, RawStore, Run
from quittance.streaming.landing import follow

ROWS = [{"a": "1", "b": "x"}, {"a": "2", "b": ""}, {"a": "2", "b": ""}]
EXPORT = specs.Export(stem="small", table="small")


def run(day: int) -> Run:
    return Run(datetime(2025, 3, day, 6, 0, 0, 123456))


@pytest.fixture
def store(spark, tmp_path):
    return RawStore(spark, str(tmp_path / "raw"))


def load(store, path, day, rows, columns=None):
    write_csv(path, rows, columns)
    return store.load_one(str(path), EXPORT, run(day))


def counts(result):
    return (result.status, result.rows_in_file, result.rows_inserted, result.rows_skipped)


def test_run_id_comes_from_the_load_time():
    assert run(1).run_id == hashlib.md5(b"2025-03-01T06:00:00.123456").hexdigest()[:12]


def test_first_load_keeps_every_row(store, tmp_path):
    assert counts(load(store, tmp_path / "small.csv", 1, ROWS)) == (OK, 3, 3, 0)
    table = store.read("small")
    assert [t for n, t in table.dtypes if not n.startswith("_")] == ["string", "string"]
    row = table.filter("a = '1'").first()
    assert (row._source_file, row._loaded_at, row._run_id) == (
        "small.csv", datetime(2025, 3, 1, 6), run(1).run_id,
    )
    assert row._row_hash == hashlib.md5(b"1|x|small.csv").hexdigest()
    # an empty field hashes like a missing one
    assert table.filter("a = '2'").first()._row_hash == hashlib.md5(b"2||small.csv").hexdigest()


def test_loading_again_adds_nothing(store, tmp_path):
    load(store, tmp_path / "small.csv", 1, ROWS)
    assert counts(load(store, tmp_path / "small.csv", 2, ROWS)) == (OK, 3, 0, 3)
    assert store.read("small").count() == 3


def test_grown_export_adds_what_is_new(store, tmp_path):
    load(store, tmp_path / "small.csv", 1, ROWS)
    grown = [*ROWS, {"a": "3", "b": "y"}, {"a": "3", "b": "y"}]
    assert counts(load(store, tmp_path / "small.csv", 2, grown)) == (OK, 5, 2, 3)
    assert store.read("small").count() == 5


def test_same_row_of_another_file_is_another_row(store, tmp_path):
    load(store, tmp_path / "small.csv", 1, ROWS)
    write_csv(tmp_path / "other.csv", ROWS)
    other = specs.Export(stem="other", table="small")
    assert counts(store.load_one(str(tmp_path / "other.csv"), other, run(2))) == (OK, 3, 3, 0)


def test_retry_of_a_run_replaces_its_own_rows(store, tmp_path):
    load(store, tmp_path / "small.csv", 1, ROWS)
    grown = [*ROWS, {"a": "3", "b": "y"}]
    for _ in range(2):
        assert counts(load(store, tmp_path / "small.csv", 2, grown)) == (OK, 4, 1, 3)
    assert store.read("small").count() == 4


def test_unfinished_run_is_not_read(store, tmp_path):
    load(store, tmp_path / "small.csv", 1, ROWS)
    load(store, tmp_path / "small.csv", 2, [{"a": "9", "b": "9"}])
    (tmp_path / "raw" / "small" / run(2).run_id / "_SUCCESS").unlink()
    assert store.read("small").count() == 3
    assert counts(load(store, tmp_path / "small.csv", 3, [{"a": "9", "b": "9"}])) == (OK, 1, 1, 0)


def test_reordered_header_is_matched_by_name(store, tmp_path):
    load(store, tmp_path / "small.csv", 1, ROWS)
    grown = [*ROWS, {"a": "3", "b": "y"}]
    assert counts(load(store, tmp_path / "small.csv", 2, grown, ["b", "a"])) == (OK, 4, 1, 3)
    assert store.read("small").filter("a = '3' and b = 'y'").count() == 1


def test_changed_columns_fail(store, tmp_path):
    load(store, tmp_path / "small.csv", 1, ROWS)
    result = load(store, tmp_path / "small.csv", 2, [{"a": "1", "c": "x"}])
    assert counts(result) == (FAILED, 0, 0, 0)
    assert "missing ['b']" in result.message
    assert store.read("small").count() == 3


@pytest.mark.parametrize("line", ["1\n", "1,2,3\n"], ids=["narrow", "wide"])
def test_row_of_another_width_fails(store, tmp_path, line):
    (tmp_path / "small.csv").write_text("a,b\n1,2\n" + line)
    assert store.load_one(str(tmp_path / "small.csv"), EXPORT, run(1)).status == FAILED
    assert not store.exists("small")


def test_missing_file(store, tmp_path):
    result = store.load_one(str(tmp_path / "none.csv"), EXPORT, run(1))
    assert counts(result) == (MISSING, 0, 0, 0)
    assert result.message == "source file not found"


def test_empty_export(store, tmp_path):
    (tmp_path / "small.csv").write_text("a,b\n")
    assert counts(store.load_one(str(tmp_path / "small.csv"), EXPORT, run(1))) == (OK, 0, 0, 0)
    assert counts(load(store, tmp_path / "small.csv", 2, ROWS)) == (OK, 3, 3, 0)


def test_hot_hash(store, spark):
    """A third of the rows are copies of one row."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("a")
    )
    assert store.append(rows, "small.csv", "small", run(1)) == (30_000, 30_000)
    more = rows.union(spark.range(10).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("a")))
    assert store.append(more, "small.csv", "small", run(2)) == (30_010, 10)
    assert not exports.path_exists(spark, f"{store.root}/arriving/small/{run(2).run_id}")


def test_folder_load_goes_on_after_problems(store, spark, tmp_path):
    Scenario().write(tmp_path / "in")
    (tmp_path / "in" / "product_mix.csv").unlink()
    (tmp_path / "in" / "sales_by_time.csv").write_text("a,b\n1\n")
    results = {r.target_table: r for r in store.load_folder(str(tmp_path / "in"), run(1))}
    assert len(results) == 8
    assert counts(results["transactions_detailed"]) == (OK, 82, 82, 0)
    assert counts(results["error_charges"]) == (OK, 14, 14, 0)
    assert results["product_mix"].status == MISSING
    assert results["sales_by_time"].status == FAILED
    log = store.log()
    assert log.dtypes == [
        ("run_id", "string"), ("loaded_at", "timestamp_ntz"), ("source_file", "string"), ("target_table", "string"),
        ("rows_in_file", "bigint"), ("rows_inserted", "bigint"), ("rows_skipped", "bigint"), ("status", "string"),
        ("message", "string"),
    ]
    assert log.count() == 8
    assert log.agg(F.max(F.length("message"))).first()[0] <= 500
    assert log.first().loaded_at == run(1).loaded_at  # with its fraction
    assert store.load_folder(str(tmp_path / "in"), run(2))[2].rows_inserted == 0
    assert store.log().count() == 16


@pytest.mark.parametrize(
    "hours, status", [(1, "pass"), (36, "pass"), (36.01, "warn"), (72, "warn"), (72.01, "error")]
)
def test_freshness(spark, hours, status):
    from datetime import timedelta

    loaded = datetime(2025, 3, 1, 6)
    table = spark.createDataFrame([(loaded,)], "_loaded_at timestamp_ntz")
    row = loading.freshness(table, "orders", now=loaded + timedelta(hours=hours)).first()
    assert (row.source_table, row.newest_load, row.status) == ("orders", loaded, status)
    assert loading.freshness(table.limit(0), "orders", now=loaded).first().status == "error"


def test_awkward_csv(spark, tmp_path):
    path = tmp_path / "x.csv"
    text = 'a,"b | (c)",d\n"say ""hi"", ok",," lead "\n\\,"",x\n'
    path.write_bytes(b"\xef\xbb\xbf" + text.encode())
    frame = read_export(spark, str(path))
    assert frame.columns == ["a", "b | (c)", "d"]
    expected = [('say "hi", ok', None, " lead "), ("\\", None, "x")]
    assert [tuple(r) for r in frame.collect()] == expected
    write_export(frame, str(tmp_path / "y.csv"))
    assert [tuple(r) for r in read_export(spark, str(tmp_path / "y.csv")).collect()] == expected


def test_line_break_in_quotes(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n"two\nlines",1\n')
    with pytest.raises(Exception):
        read_export(spark, str(tmp_path / "x.csv")).collect()
    assert read_export(spark, str(tmp_path / "x.csv"), multi_line=True).first().a == "two\nlines"


LINE_BREAKS = 'Business ID,Business name,Campaign name\n1,Bob Cafe,"First\nsecond - Bob Cafe (bus id: 1)"\n'


def test_line_breaks_go_through_anonymising_and_loading(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "small.csv").write_text(LINE_BREAKS)
    house = Warehouse(spark, str(tmp_path / "house"), {"small"})
    house.anonymise_folder(str(tmp_path / "in"), str(tmp_path / "private"), run(1))
    folder = house.path("anonymised", run(1).run_id)
    [result] = house.raw.load_folder(folder, run(1), exports=[EXPORT], multi_line=house.multi_line)
    assert counts(result) == (OK, 1, 1, 0)
    assert house.raw.read("small").first()["Campaign name"] == "First\nsecond (bus id: 9000001)"


def test_line_breaks_go_through_the_stream(store, spark, tmp_path):
    (tmp_path / "arriving").mkdir()
    (tmp_path / "arriving" / "1.csv").write_text(LINE_BREAKS)
    query = follow(store, str(tmp_path / "arriving"), EXPORT, str(tmp_path / "checkpoint"), multi_line=True)
    query.awaitTermination(120)
    assert query.exception() is None
    assert store.read("small").first()["Campaign name"] == "First\nsecond - Bob Cafe (bus id: 1)"


def test_files_of_one_export_share_a_header(spark, tmp_path):
    folder = tmp_path / "x.csv"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n")
    (folder / "2.csv").write_text("a,b\n3,4\n")
    assert read_export(spark, str(folder)).count() == 2
    (folder / "3.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception):
        read_export(spark, str(folder)).collect()


@pytest.mark.parametrize(
    "name, data_set",
    [
        ("0a1b2c3d-FINANCIAL_Payout_Summary_2025-01-01_2025-12-31_abc.csv", "financial_payout_summary"),
        ("sales_by_order_20250101_20251231_x.csv", "sales_by_order"),
        ("Product_Mix.csv", "product_mix"),
        ("0A1B2C3D-x.csv", "0a1b2c3d-x"),
        ("x_2025-01-01.csv", "x_2025-01-01"),
    ],
)
def test_data_set_names(name, data_set):
    assert dataset_name(name) == data_set


def test_every_file_of_a_data_set_counts(spark, tmp_path):
    for name in ("orders_20250101_20250131_a.csv", "orders_20250101_20250228_a.csv", "_mapping.csv", "x.txt"):
        (tmp_path / name).write_text("a\n1\n")
    found = list_exports(spark, str(tmp_path))
    assert found == {"orders": [f"{tmp_path}/orders_20250101_{d}_a.csv" for d in ("20250131", "20250228")]}
    assert read_export(spark, found["orders"]).count() == 2


def test_stream_loads_new_files_once(store, spark, tmp_path):
    folder = tmp_path / "arriving"
    folder.mkdir()
    write_csv(folder / "1.csv", ROWS)

    def drain():
        query = follow(store, str(folder), EXPORT, str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
        assert query.exception() is None
        return store.read("small").count()

    assert drain() == 3
    write_csv(folder / "2.csv", [*ROWS, {"a": "3", "b": "y"}])
    assert drain() == 4
    assert drain() == 4
    assert [(r.rows_in_file, r.rows_inserted) for r in store.log().orderBy("loaded_at").collect()] == [(3, 3), (4, 1)]


def test_loading_holds_a_session_to_methods_that_are_compiled(spark):
    before = spark.conf.get(METHOD_LIMIT)
    try:
        spark.conf.set(METHOD_LIMIT, "65535")
        loading.with_load_columns(spark.createDataFrame([("a",)], "A string"), "a.csv", Run(datetime(2025, 3, 1)))
        assert spark.conf.get(METHOD_LIMIT) == "8000"
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def test_kept_tables_take_half_a_byte_a_digit(spark, store):
    frame = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("id"))
    assert store.append(frame, "small.csv", "small", run(1)) == (20_000, 20_000)
    # an id and a row hash of 32 digits each, which take 65 bytes with Spark's own codec
    assert 32 < exports.size_of(spark, store.path("small")) / 20_000 < 45
    assert store.read("small").where(F.col("id") == hashlib.md5(b"7").hexdigest()).count() == 1
