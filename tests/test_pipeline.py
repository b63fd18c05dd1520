"""Exports in, published marts out."""

import shutil
from datetime import datetime, timedelta

import pytest
from scenarios import ADDRESS, IDENTITY, Scenario

from quittance.plans.settlement import MARTS, IncompleteLoad, StaleSource, Warehouse, run
from quittance.sources.loading import Run

FIRST = Run(datetime(2025, 3, 1, 6))
NEXT = Run(datetime(2025, 3, 2, 6))


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    noisy = lambda stem: f"0a1b2c3d-{stem.upper()}_2025-01-01_2025-02-28_x1.csv"
    Scenario().write(base / "exports", noisy)
    return base


@pytest.fixture(scope="module")
def first(spark, folders):
    return run(spark, str(folders / "exports"), str(folders / "house"), private=str(folders / "private"), at=FIRST)


@pytest.fixture(scope="module")
def house(spark, folders, first):
    return Warehouse(spark, str(folders / "house"))


def test_everything_loads_and_is_published(first, house):
    assert {r.status for r in first.loads} == {"OK"}
    assert len(first.loads) == 8
    outcomes = first.checks.collect()
    assert len(outcomes) == 33
    assert {r.status for r in outcomes} == {"pass"}
    assert first.published and house.published_run() == FIRST.run_id
    assert house.read_published("fct_orders").count() == 65
    assert house.read_published("fct_error_events").filter("is_recovered").count() == 5


def test_no_identity_is_left(spark, folders, house):
    real = {v.lower() for k, v in IDENTITY.items() if k not in ("Merchant store ID", "Store ID")} | {"dock 4", ADDRESS.lower()}
    exports = list((folders / "house" / "anonymised").glob("*/*.csv"))
    assert exports
    for export in exports:
        text = "".join(p.read_text() for p in export.glob("part-*")).lower()
        assert not [v for v in real if v in text], export.name
    names = {r.campaign_key: r.campaign_name for r in house.read_published("dim_campaign").collect()}
    assert names == {"c-soup": "Spring soup (bus id: 9000001)", "c-rain": "Rainy day"}


def test_mapping_is_stable_over_runs(spark, folders, house, first):
    where = str(folders / "private" / "surrogate_mapping")
    before = sorted(house._mapping(where)[2].collect())
    written = house.anonymise_folder(str(folders / "exports"), str(folders / "private"))
    assert written["sales_by_order"] == (65, 6) and written["product_mix"] == (3, 5)
    assert written["marketing_promotion"] == (5, 2)
    assert sorted(house._mapping(where)[2].collect()) == before
    assert {tuple(r) for r in before} == {("business_id", "5310", "9000001"), ("store_id", "41", "8000001")}


def test_second_run_adds_nothing(spark, folders, first):
    again = run(spark, str(folders / "exports"), str(folders / "house"), private=str(folders / "private"), at=NEXT)
    assert {(r.rows_inserted, r.status) for r in again.loads} == {(0, "OK")}
    assert again.published
    assert Warehouse(spark, str(folders / "house")).read_published("fct_transactions").count() == 82


def test_freshness_covers_every_table(house):
    ages = house.freshness(NEXT.loaded_at + timedelta(hours=40)).collect()
    assert {r.source_table for r in ages} >= {"orders", "transactions_detailed", "_load_log"}
    # rows loaded by the first run only
    assert {r.status for r in ages if r.source_table == "orders"} == {"warn"}
    assert len(ages) == 9


def test_failed_control_keeps_the_earlier_build_published(spark, tmp_path):
    scenario = Scenario()
    scenario.write(tmp_path / "exports")
    house = str(tmp_path / "house")
    assert run(spark, str(tmp_path / "exports"), house, at=FIRST).published
    scenario.payouts[5]["Net total"] = "1.00"
    scenario.payouts[5]["Payout ID"] = "777"
    scenario.write(tmp_path / "exports")
    second = run(spark, str(tmp_path / "exports"), house, at=NEXT)
    assert not second.published
    failed = {r["check"] for r in second.checks.filter("status = 'fail'").collect()}
    assert "payout net total" in failed and "no unexplained break" in failed
    warehouse = Warehouse(spark, house)
    assert warehouse.published_run() == FIRST.run_id
    assert warehouse.read_published("fct_payouts").count() == 9


def test_missing_export_stops_the_run(spark, tmp_path):
    Scenario().write(tmp_path / "exports")
    house = str(tmp_path / "house")
    run(spark, str(tmp_path / "exports"), house, at=FIRST)
    (tmp_path / "exports" / "product_mix.csv").unlink()
    with pytest.raises(IncompleteLoad, match="product_mix.csv MISSING"):
        run(spark, str(tmp_path / "exports"), house, at=NEXT)
    # a build made all the same would not pass its controls
    warehouse = Warehouse(spark, house)
    outcomes = warehouse.check(warehouse.build(NEXT.run_id))
    assert {r["check"] for r in outcomes.filter("status = 'fail'").collect()} == {"last load clean"}
    assert not warehouse.publish(NEXT.run_id, outcomes)
    assert warehouse.published_run() == FIRST.run_id


def test_stale_source_stops_the_run(spark, folders, first):
    late = Run(FIRST.loaded_at + timedelta(hours=73))
    with pytest.raises(StaleSource, match="orders since 2025-03-01"):
        run(spark, str(folders / "house" / "anonymised"), str(folders / "house"), at=late)


def test_table_never_loaded_is_stale(spark, tmp_path):
    Scenario().write(tmp_path / "exports")
    (tmp_path / "exports" / "product_mix.csv").unlink()
    house = Warehouse(spark, str(tmp_path / "house"))
    house.load(str(tmp_path / "exports"), FIRST)
    found = {r.source_table: r.status for r in house.freshness(FIRST.loaded_at).collect()}
    assert found.pop("product_mix") == "error" and set(found.values()) == {"pass"}


def test_nothing_published_yet(spark, tmp_path):
    with pytest.raises(LookupError):
        Warehouse(spark, str(tmp_path / "house")).read_published(MARTS[0])


def test_no_earlier_copy_stands_in_for_a_missing_export(spark, folders, first, tmp_path):
    exports = tmp_path / "exports"
    shutil.copytree(folders / "exports", exports)
    gone = next(p for p in exports.iterdir() if "sales_by_order" in p.name.lower())
    shutil.rmtree(gone) if gone.is_dir() else gone.unlink()
    with pytest.raises(IncompleteLoad):
        run(spark, str(exports), str(folders / "house"), private=str(folders / "private"))
