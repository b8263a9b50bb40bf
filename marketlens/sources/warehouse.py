"""K1 on real tables: the canonical views bound to a warehouse's own tables by name.

The reports only see canonical columns. ``CANONICAL`` lists each view's columns
and types; a ``Binding`` says which table or Parquet path holds a view and what
its columns are called there, and ``WarehouseTables`` reads it by exactly the
columns a view needs. One logical table exists with different flag types in
different schemas (BOOL in one, INT 0/1 in another, text in feeds): flags are
normalised from the type that the table's schema has, with plain expressions,
so filters on them and on the date columns still reach the scan.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.operators.hotkeys import Hot, hot_keys, tasks_for
from marketlens.sources.tables import Tables

#: Columns of every canonical view.
CANONICAL: dict[str, str] = {
    "company": "company_id bigint, description string, gst_registered boolean, soft_deleted boolean",
    "product": "product_id bigint, product_name string, brand string, brand_id bigint, level1 string, company_id bigint, "
               "sku string, sell_price double, rrp double, stock bigint, created date",
    "item": "product_id bigint, item_id bigint",
    "variant": "item_id bigint, variant_id bigint, sku string, sell_price double, rrp double, stock bigint, created date",
    "brand": "brand_id bigint, brand_name string",
    "category": "product_id bigint, tag_id bigint, level1 string, level2 string, level3 string, level4 string",
    "lines": "line_id bigint, customer_id bigint, product_id bigint, variant_id bigint, company_id bigint, status int, "
             "order_type int, refund_type int, total_amount double, qty double, customer_price double, "
             "company_pay_price double, accepted_date date, is_freight boolean, is_protection boolean, sku string, "
             "postal_state string",
    "bridge": "line_id bigint, receipt_id bigint",
    "receipts": "receipt_id bigint, customer_id bigint, transaction_date date, amount double, approved boolean, "
                "receipt_type bigint, client_type int, channel string",
    "subscription": "product_id bigint, channel string, subscribed boolean, unsubscribed_reason string, banner_note string, "
                    "last_updated date",
    "secondary": "product_id bigint, variant_id bigint, secondary_id bigint",
    "snapshot": "last_updated_date date, product_id bigint, variant_id bigint, price double, listing_id bigint, "
                "created_date date, name string, link string, sku string, stock bigint, level1 string, level2 string, "
                "level3 string, level4 string, active_status string, rrp double, seller_name string, seller_type string",
    "daily_price": "run_date date, row_no bigint, product_id string, variant_id string, price double, marketplace string",
    "promo": "product_id bigint, variant_id bigint, company_id bigint, promo_price double, commission bigint, "
             "start_date date, end_date date, is_deleted boolean, is_archived boolean",
    "lookup": "product_id string, variant_id string, internal_product_id bigint, seller_id string, published_date date, "
              "active_status string, seller_name string, marketplace string",
    "price_history": "ts timestamp, event_id bigint, product_id bigint, variant_id bigint, price double",
    "stock_out": "oos_date date, event_id bigint, product_id bigint, variant_id bigint",
    "promo_check": "event_id bigint, product_id bigint, variant_id bigint, start_date date, promo_price double",
    "created": "product_id bigint, created date",
    "channel2": "order_id bigint, order_line_id bigint, customer_id bigint, order_date date, product_id bigint, "
                "external_product_id string, gmv double, l_shipdate date, l_suppkey bigint",
    "channel3": "order_id bigint, article_id bigint, customer_id bigint, order_date date, seller_id string, "
                "line_total double, l_shipdate date, l_linenumber bigint, l_suppkey bigint",
    "performance": "level1 string, sale_date date, revenue double, margin double",
}


@dataclass(frozen=True)
class Binding:
    """Where a view's rows are (a catalog table's name, or a path of Parquet files) and its columns' names there."""

    source: str
    columns: Mapping[str, str] = field(default_factory=dict)
    #: columns that the source does not have, as SQL expressions over it (``null`` included)
    derived: Mapping[str, str] = field(default_factory=dict)

    @property
    def is_path(self) -> bool:
        return "/" in self.source


def flag(c: Column, kind: T.DataType) -> Column:
    """A flag as boolean, whatever its type: BOOL as it is, numbers by not being 0, text by its common spellings; null stays null."""
    if isinstance(kind, T.BooleanType):
        return c
    if isinstance(kind, T.NumericType):
        return c != 0
    if isinstance(kind, T.StringType):
        text = F.lower(F.trim(c))
        return F.when(text.isin("true", "t", "yes", "y", "1"), True).when(text.isin("false", "f", "no", "n", "0"), False)
    raise TypeError(f"a flag can't be of type {kind.simpleString()}")


def bind(df: DataFrame, view: str, binding: Binding) -> DataFrame:
    """``df`` as the canonical view: its columns only, with canonical names and types."""
    out = []
    for name, wanted in ((f.name, f.dataType) for f in T.StructType.fromDDL(CANONICAL[view]).fields):
        if name in binding.derived:
            c = F.expr(binding.derived[name])
            kind = df.select(c).schema[0].dataType
        else:
            source = binding.columns.get(name, name)
            if source not in df.columns:
                raise KeyError(f"{binding.source} has no column {source!r} for {view}.{name}")
            c, kind = F.col(f"`{source}`"), df.schema[source].dataType
        if isinstance(wanted, T.BooleanType):
            c = flag(c, kind)
        elif kind != wanted:
            c = c.cast(wanted)
        out.append(c.alias(name))
    return df.select(*out)


class WarehouseTables(Tables):
    """The canonical views over named tables: the same reports as over ``Tables``."""

    def __init__(self, spark: SparkSession, bindings: Mapping[str, Binding]):
        unknown = sorted(set(bindings) - set(CANONICAL))
        if unknown:
            raise KeyError(f"no canonical views: {', '.join(unknown)}")
        super().__init__(spark, "")
        self.bindings = dict(bindings)
        self._views: dict[str, DataFrame] = {}
        self._tasks: dict[str, int] = {}

    def __getattribute__(self, name: str):
        if name in CANONICAL:
            return object.__getattribute__(self, "_view")(name)
        return object.__getattribute__(self, name)

    def line_tasks(self, view: str) -> int:
        if view not in self._tasks:
            self._tasks[view] = tasks_for(self.spark, self._view(view).count())
        return self._tasks[view]

    def hot_products(self, view: str) -> Hot:
        key = {"lines": "product_id", "channel2": "external_product_id", "channel3": "article_id"}[view]
        return hot_keys(self._view(view), [key])

    def dealt(self, view: str) -> DataFrame:
        keys = {"channel2": ("order_id", "order_line_id"), "channel3": ("order_id", "article_id")}[view]
        return self._view(view).repartition(self.line_tasks(view), *keys)

    def _view(self, name: str) -> DataFrame:
        if name not in self._views:
            binding = self.bindings.get(name)
            if binding is None:
                raise KeyError(f"no table is bound to the view {name!r}")
            read = self.spark.read.parquet if binding.is_path else self.spark.table
            self._views[name] = bind(read(binding.source), name, binding)
        return self._views[name]
