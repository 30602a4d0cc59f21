"""Declared schemas: the six landed inputs and the eight warehouse tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Column names and types the inputs and the warehouse are declared with. ``{id}`` is the type of
# identifiers: 32-bit as declared, or BIGINT when the data outgrows it.
_BRONZE = {
    "aisles": "aisle_id {id}, aisle STRING",
    "clients": "client_id {id}, fullname STRING, location_area_id {id}",
    "departments": "department_id {id}, department STRING",
    "orders": "order_id {id}, product_id {id}, client_id {id}, store_id {id}, quantity INT, order_date DATE",
    "products": "product_id {id}, product_name STRING, aisle_id {id}, department_id {id}",
    "out_of_stock": "product_id {id}, date DATE",
}

_WAREHOUSE = {
    "clients_dim": (
        "client_id {id}, fullname VARCHAR(30), location_area_id {id}",
        ("client_id", "location_area_id"),
    ),
    "products_dim": (
        "product_id {id}, product_name VARCHAR(130), aisle_id {id}, department_id {id}",
        ("product_id", "aisle_id", "department_id"),
    ),
    "aisles_dim": ("aisle_id {id}, aisle VARCHAR(30)", ("aisle_id",)),
    "departments_dim": ("department_id {id}, department VARCHAR(30)", ("department_id",)),
    "dates_dim": (
        "time_id BIGINT, action_date DATE, action_week INT, action_month INT, action_year INT, "
        "action_weekday INT",
        ("time_id",),
    ),
    "location_areas_dim": ("location_area_id {id}", ("location_area_id",)),
    "orders_fact": (
        "order_id {id}, product_id {id}, client_id {id}, store_id {id}, quantity INT, time_id BIGINT",
        ("order_id", "product_id", "client_id", "store_id", "time_id"),
    ),
    "out_of_stock_fact": ("time_id BIGINT, product_id {id}", ("product_id", "time_id")),
}

# The column that facts are partitioned by.
FACT_DATE = "time_id"

SHOP_TABLES = ("aisles", "clients", "departments", "orders", "products")
FEED = "out_of_stock"

# Warehouse table -> silver dataset, dimensions before facts.
LOAD_ORDER = {
    "clients_dim": "clients",
    "products_dim": "products",
    "aisles_dim": "aisles",
    "departments_dim": "departments",
    "dates_dim": "dates",
    "location_areas_dim": "location_areas",
    "orders_fact": "orders",
    "out_of_stock_fact": "out_of_stock",
}


@dataclass(frozen=True)
class WarehouseTable:
    name: str
    columns: tuple[tuple[str, str], ...]
    distribution: tuple[str, ...]

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.columns)

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def is_fact(self) -> bool:
        return self.name.endswith("_fact")

    @property
    def bucket_keys(self) -> tuple[str, ...]:
        """The declared distribution; facts are divided by date already, so theirs goes by the other keys."""
        return tuple(k for k in self.distribution if not (self.is_fact and k == FACT_DATE))

    @property
    def merge_keys(self) -> list[str]:
        """What tells two rows apart: the identifier of a dimension, the whole row of a fact."""
        return self.column_names if self.is_fact else self.column_names[:1]


def bronze_schema(name: str, id_type: str = "INT") -> T.StructType:
    return T.StructType.fromDDL(_BRONZE[name].format(id=id_type))


def warehouse_tables(id_type: str = "INT") -> dict[str, WarehouseTable]:
    tables = {}
    for name, (columns, distribution) in _WAREHOUSE.items():
        parts = [part.strip().split(" ", 1) for part in columns.format(id=id_type).split(", ")]
        tables[name] = WarehouseTable(name, tuple((col, kind) for col, kind in parts), distribution)
    return tables
