"""Run parameters. Defaults are the values the KPI definitions use."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Fixed values of the KPI definitions (must stay as stated to reproduce them).
ORDER_STATUSES = ("Cancelled", "Returned", "Delivered", "Shipped", "Processing")
DISCOUNTS = (0, 2, 4, 6, 8, 10)
EXCLUDED_STATUSES = ("Cancelled", "Returned")
CLV_TIERS = ((10000, "Platinum"), (5000, "Gold"), (2000, "Silver"), (500, "Bronze"))
CLV_DEFAULT = "New"
STORE_TIERS = ((0.8, "Star"), (0.5, "Average"), (0.2, "Improving"))
STORE_TIER_DEFAULT = "Needs Attention"
EXPORT_STORE_TIERS = ((0.8, "Star"), (0.5, "Average"))
OUT_OF_STOCK, LOW_STOCK, OVERSTOCK, IN_STOCK = "Out of Stock", "Low Stock", "Overstock", "In Stock"
LOW_STOCK_BELOW = 10
OVERSTOCK_ABOVE = 100


@dataclass(frozen=True)
class Params:
    """Knobs of the KPI jobs.

    ``as_of`` replaces CURRENT_DATE; ``None`` means the session's current date.
    """

    as_of: dt.date | None = None
    excluded_statuses: tuple[str, ...] = EXCLUDED_STATUSES
    clv_tiers: tuple[tuple[float, str], ...] = CLV_TIERS
    store_tiers: tuple[tuple[float, str], ...] = STORE_TIERS
    export_store_tiers: tuple[tuple[float, str], ...] = EXPORT_STORE_TIERS
    window_days: int = 30
    moving_avg_rows: int = 7
    top_n: int = 10
    rfm_tiles: int = 5
    # Ranking over entity-grain rows (stores, products, customers) is done in
    # range buckets of about this many rows each; see operators/ranking.py.
    rank_bucket_rows: int = 2_000_000


# The date the fixture tests pin CURRENT_DATE to (last test order: 2001-08-01).
FIXTURE_AS_OF = dt.date(2001, 8, 2)
