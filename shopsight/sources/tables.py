"""The seven logical business tables and their declared keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

TABLE_NAMES = (
    "orders", "order_items", "products", "inventory", "stores", "expenses", "customers",
)

# Columns of each logical table, with Spark SQL types (inferred from use).
SCHEMAS = {
    "orders": "order_id BIGINT, cust_id BIGINT, store_id BIGINT, order_date DATE, "
              "order_status STRING, total_amount DECIMAL(12,2)",
    "order_items": "order_id BIGINT, prod_id BIGINT, quantity INT, unit_price DECIMAL(12,2), "
                   "discount DECIMAL(5,2)",
    "products": "prod_id BIGINT, prod_name STRING, category STRING, brand STRING, price DECIMAL(12,2)",
    "inventory": "prod_id BIGINT, store_id BIGINT, stock_qty INT",
    "stores": "store_id BIGINT, store_name STRING, city STRING, state STRING, region STRING",
    "expenses": "store_id BIGINT, amount DECIMAL(12,2)",
    "customers": "cust_id BIGINT, full_name STRING, city STRING, state STRING, join_date DATE",
}

# Keys that the dimension joins rely on: aggregating facts per key and then
# attaching the dimension row equals grouping by all dimension columns only
# when the key is unique. operators/quality.py verifies them.
DIMENSION_KEYS = {"products": "prod_id", "stores": "store_id", "customers": "cust_id"}


class Tables:
    """The seven logical tables, each given as a DataFrame or built on first use.

    ``factories`` maps table names to zero-argument callables; a job that
    touches two tables only ever builds (and analyzes) those two.
    """

    def __init__(self, orders: DataFrame | None = None, order_items: DataFrame | None = None,
                 products: DataFrame | None = None, inventory: DataFrame | None = None,
                 stores: DataFrame | None = None, expenses: DataFrame | None = None,
                 customers: DataFrame | None = None, unique_keys: dict | None = None,
                 factories: dict | None = None):
        given = dict(orders=orders, order_items=order_items, products=products,
                     inventory=inventory, stores=stores, expenses=expenses, customers=customers)
        self._frames = {k: v for k, v in given.items() if v is not None}
        self._factories = dict(factories or {})
        missing = [n for n in TABLE_NAMES if n not in self._frames and n not in self._factories]
        if missing:
            raise ValueError(f"tables not given: {missing}")
        # Declared primary keys (unique, non-NULL) beyond the dimension keys,
        # e.g. {"orders": "order_id"}. A declared order_id lets COUNT(DISTINCT
        # order_id) over orders alone become COUNT(order_id) (no distinct
        # shuffle of every order id); quality.key_report checks both parts.
        self.unique_keys = dict(unique_keys or {})

    def get(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._factories[name]()
        return self._frames[name]

    def replaced(self, **frames: DataFrame) -> Tables:
        """These tables with some given anew."""
        out = Tables(unique_keys=self.unique_keys, factories={n: (lambda n=n: self.get(n)) for n in TABLE_NAMES})
        out._frames.update(frames)
        return out

    orders = property(lambda self: self.get("orders"))
    order_items = property(lambda self: self.get("order_items"))
    products = property(lambda self: self.get("products"))
    inventory = property(lambda self: self.get("inventory"))
    stores = property(lambda self: self.get("stores"))
    expenses = property(lambda self: self.get("expenses"))
    customers = property(lambda self: self.get("customers"))

    def __repr__(self) -> str:
        return f"Tables(built={sorted(self._frames)}, unique_keys={self.unique_keys})"

    def distinct_count(self, table: str, column: str):
        """COUNT(DISTINCT column) over rows of ``table`` that were not fanned out.

        Only valid on the table itself (or after many-to-one joins): with a
        declared unique key, the distinct count is a plain count.
        """
        if self.unique_keys.get(table) == column:
            return F.count(column)
        return F.count_distinct(column)
