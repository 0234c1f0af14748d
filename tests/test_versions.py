"""Versions of a lake: builds that fail, readers during a rebuild, clearing up."""

from __future__ import annotations

from datetime import date, datetime, timezone
from decimal import Decimal
from pathlib import Path

import pytest

from storelens.plans import pipeline, versions
from storelens.plans.metrics import report
from storelens.plans.versions import Versions
from tests.retail import ROWS, write_csv

RUN = datetime(2024, 5, 1, tzinfo=timezone.utc)


def dearer(rows):
    return {**rows, "order_items": [[*r[:5], "1000.00", r[6]] for r in rows["order_items"]]}


def files(folder):
    return {(p, p.stat().st_mtime_ns) for p in Path(folder).rglob("*") if p.is_file()}


def test_a_failed_run_leaves_the_live_version(spark, tmp_path):
    lake = str(tmp_path / "lake")
    first = pipeline.run(spark, str(write_csv(tmp_path / "a")), lake, RUN)
    held, before = pipeline.open_lake(spark, lake), files(first.root)
    # Items cost more; silver is written, then an order outside the calendar ends the run.
    rows = dearer(ROWS)
    rows["orders"] = [*rows["orders"], ["o7", "c6", "shipped", "2031-01-01 00:00:00", "", "", "", ""]]
    with pytest.raises(ValueError, match="outside the calendar"):
        pipeline.run(spark, str(write_csv(tmp_path / "b", rows)), lake, RUN)
    assert files(first.root) == before
    for star in (held, pipeline.open_lake(spark, lake), pipeline.open_lake(spark.newSession(), lake)):
        assert star.root == first.root
        assert report(star, ["gmv"]).first()["gmv"] == Decimal("363.50")
        assert star.silver("order_items").agg({"price": "sum"}).first()[0] == Decimal("429.00")


def test_readers_during_a_rebuild_keep_their_version(spark, tmp_path):
    lake = str(tmp_path / "lake")
    pipeline.run(spark, str(write_csv(tmp_path / "a")), lake, RUN)
    early, unread = pipeline.open_lake(spark, lake), pipeline.open_lake(spark, lake)
    assert report(early, ["total_sales"]).first()["total_sales"] == Decimal("330.00")
    second = pipeline.run(spark, str(write_csv(tmp_path / "b", dearer(ROWS))), lake, RUN)
    late = pipeline.open_lake(spark, lake)
    assert late.root == second.root != early.root
    # Also for tables that were not read before the rebuild.
    for star, sales in ((early, "330.00"), (unread, "330.00"), (late, "7000.00")):
        assert report(star, ["total_sales"]).first()["total_sales"] == Decimal(sales)
        assert star.silver("order_items").where("price = 1000").count() == (0 if star is not late else 8)


def test_a_warehouse_used_directly_does_not_drop_orders(spark, tmp_path):
    built = pipeline.run(spark, str(write_csv(tmp_path / "a")), str(tmp_path / "lake"), RUN)
    bronze = {n: f"{built.root}/bronze/{n}" for n in pipeline.RAW}
    narrow = pipeline.open_bronze(spark, bronze, str(tmp_path / "other"), calendar=(date(2016, 1, 1), date(2017, 12, 31)))
    with pytest.raises(Exception, match="outside the calendar"):
        narrow.gold("FactOrderItems")


def test_bronze_by_ingest_date_keeps_earlier_runs(spark, tmp_path):
    lake = str(tmp_path / "lake")
    pipeline.run(spark, str(write_csv(tmp_path / "a")), lake, RUN, bronze_by_date=True)
    later = {**ROWS, "sellers": [["s1", "1001", "santos", "SP"], ["s3", "3001", "recife", "PE"]]}
    again = pipeline.run(spark, str(write_csv(tmp_path / "b", later)), lake, RUN.replace(day=2), bronze_by_date=True)
    assert {p.name for p in Path(lake, "bronze/sellers").glob("_ingest_date=*")} == {"_ingest_date=2024-05-01", "_ingest_date=2024-05-02"}
    sellers = {r.seller_id: r.seller_city for r in again.star("DimSeller").collect()}
    assert sellers == {"s1": "SANTOS", "s2": "RIO DE JANEIRO", "s3": "RECIFE"}
    assert again.star("FactOrderItems").count() == 7


def test_claims_publishing_and_clearing(spark, tmp_path):
    root = Versions(spark, str(tmp_path / "lake"))
    assert root.live() is None and root.vacuum() == []
    folders = [root.begin() for _ in range(5)]
    assert len(set(folders)) == 5
    for folder in (folders[0], folders[3], folders[1]):
        root.publish(folder)
    assert root.live() == folders[3]  # the order of publishing does not matter
    assert root.vacuum(keep=2) == [folders[0]]
    assert root.vacuum(keep=1) == [folders[1], folders[2]]
    assert root.live() == folders[3] and Path(folders[4]).exists()
    assert root.begin() not in folders


def test_a_load_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        versions.read(spark, root)
    assert versions.load(spark.range(10).selectExpr("id AS x", "id AS y"), root, ["y"]) == 10
    held = versions.read(spark, root)
    failing = spark.range(10).selectExpr("id AS x", "if(id = 7, raise_error('torn'), id) AS y")
    with pytest.raises(Exception, match="torn"):
        versions.load(failing, root, ["y"])
    assert versions.read(spark, root).count() == 10 and held.columns == ["y"]
    assert versions.load(spark.range(3).selectExpr("id AS y"), root) == 3
    assert (held.count(), versions.read(spark, root).count()) == (10, 3)
