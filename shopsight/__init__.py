"""shopsight — retail KPI analytics as Spark DataFrame jobs.

The library computes sales, customer, store and product KPIs, dashboard
export payloads and a metric catalog from seven logical business tables
(orders, order_items, products, inventory, stores, expenses, customers).

Layout:
  sources/    logical tables, loaders (business parquet, star-schema mapping)
  functions/  column-level semantics (status filter, exact rounding, tiers)
  operators/  reusable DataFrame operators (distributed ranking, quality checks)
  plans/      the KPI, export and catalog jobs built from the above
  streaming/  incremental refresh of the serving outputs with Structured Streaming
"""

from shopsight.params import Params
from shopsight.sources.tables import Tables

__all__ = ["Params", "Tables"]
