"""What a warehouse writes on the way to a gold table."""

from __future__ import annotations

from pathlib import Path

from storelens.plans.warehouse import Warehouse
from tests.conftest import values

STAMP = "timestamp_ntz'2024-01-01' _ingested_at"
SIZES = "3L product_name_lenght, 4L product_description_lenght, 1L product_photos_qty, 700L product_weight_g, 1L product_length_cm, 2L product_height_cm, 3L product_width_cm"


def bronze(spark):
    tables = {
        "products": f"select id product_id, if(id % 2 = 0, 'a', null) product_category_name, {SIZES}, {STAMP} from range(20)",
        "category_translation": f"select 'a' product_category_name, 'A' product_category_name_english, {STAMP}",
    }
    return lambda name: spark.sql(tables[name]).repartition(3)


def files(root, table):
    return [p.name for p in Path(f"{root}/{table}").glob("*.parquet")]


def test_a_silver_table_with_one_reader_is_planned_into_it(spark, tmp_path):
    own = Warehouse(spark, str(tmp_path / "own"), bronze(spark), None, None)
    assert own.gold("DimProduct").count() == 20 and not files(own.root, "silver/products")
    asked = own.silver("products")  # now it is written, and read from then on
    assert files(own.root, "silver/products")
    before = Warehouse(spark, str(tmp_path / "before"), bronze(spark), None, None)
    assert values(before.silver("products")) == values(asked)
    assert values(before.gold("DimProduct")) == values(own.gold("DimProduct"))


def test_layers_are_written_small(spark, tmp_path):
    own = Warehouse(spark, str(tmp_path), bronze(spark), None, None)
    own.gold("DimProduct")
    written = files(own.root, "gold/DimProduct")
    assert written and all(name.endswith(".zstd.parquet") for name in written)
