"""Values the results depend on."""

from __future__ import annotations

# Fixed values. They define which rows are valid, how they are labelled and when a check warns or fails.
CART_ACTIONS = ("add_to_cart", "remove_from_cart")
CHECKOUT_STATUSES = ("checkout_started", "payment_attempted", "payment_failed")
ORDER_STATUSES = ("paid", "cancelled", "refunded")
UNKNOWN_SOURCE = "Unknown"

SOURCE_OPTIONS = ("Meta", "Google", "Direct", "Unknown")
DEVICE_OPTIONS = ("mobile", "desktop", "tablet")
SEGMENT_DIMENSIONS = ("traffic_source", "device")

FUNNEL_STAGES = (
    ("Product View", "product_view_sessions"),
    ("Add to Cart", "add_to_cart_sessions"),
    ("Checkout", "checkout_sessions"),
    ("Purchase", "purchase_sessions"),
)

LEAKAGE_ALERT_THRESHOLD = 0.70
DEFAULT_RELATIVE_IMPROVEMENT = 0.05

# Share of rows at which a data-quality check turns to WARNING, and to FAIL.
DUPLICATE_TRAFFIC_LIMITS = (0.005, 0.05)
DUPLICATE_CART_LIMITS = (0.005, 0.05)
MISSING_SOURCE_LIMITS = (0.02, 0.10)
INVALID_STATUS_LIMITS = (0.001, 0.01)
ORPHAN_ORDER_LIMITS = (0.01, 0.05)
ORPHAN_CART_LIMITS = (0.001, 0.02)
DUPLICATE_ORDER_ID_LIMITS = (0.001, 0.02)
# Report columns, check names in report order, and their fixed texts.
REPORT_COLUMNS = ("Metric", "Value", "Unit", "Status", "Detail")
DUPLICATE_TRAFFIC = "Duplicate traffic rows"
DUPLICATE_CART = "Duplicate cart rows"
MISSING_SOURCE = "Missing traffic source"
NEGATIVE_REVENUE = "Negative revenue"
INVALID_STATUS = "Invalid order status"
ORPHAN_ORDERS = "Orders without checkout"
ORPHAN_CART = "Cart events without session"
DUPLICATE_ORDER_IDS = "Duplicate order IDs"
PURCHASE_BEFORE_CHECKOUT = "Purchase before checkout"
REPORT_ORDER = (
    DUPLICATE_TRAFFIC,
    DUPLICATE_CART,
    MISSING_SOURCE,
    NEGATIVE_REVENUE,
    INVALID_STATUS,
    ORPHAN_ORDERS,
    ORPHAN_CART,
    DUPLICATE_ORDER_IDS,
    PURCHASE_BEFORE_CHECKOUT,
)
NEGATIVE_REVENUE_DETAIL = "Orders with gross_revenue < 0"
DUPLICATE_ORDER_IDS_DETAIL = "Order IDs should be globally unique"
PURCHASE_BEFORE_CHECKOUT_DETAIL = "Impossible sequence: order timestamp precedes checkout"
# Headings and sentences of the display tables.
FUNNEL_HEADINGS = ("Stage", "Sessions", "Conv from prev", "Drop-off")
SEGMENT_HEADINGS = {
    "sessions": "Sessions",
    "orders": "Orders",
    "revenue": "Revenue",
    "atc_rate": "ATC rate",
    "checkout_rate": "Checkout rate",
    "purchase_rate": "Purchase rate",
    "conversion_rate": "Conversion",
    "aov": "AOV",
}
KPI_HEADINGS = ("Revenue", "Paid orders", "Sessions", "Conversion", "AOV", "Est. abandoned $")
SCENARIO_HEADINGS = ("Current rate", "Target rate", "Additional purchases", "Incremental revenue")
LEAKAGE_MESSAGE = ("Critical checkout leakage: ", " of checkout sessions do not convert.")
DEVICE_MESSAGE = ("Mobile checkout→purchase rate is ", ", compared with ", " on desktop.")
FUNNEL_FIGURES = (
    "Product-view sessions",
    "Add-to-cart sessions",
    "Checkout sessions",
    "Purchase sessions",
    "Overall conversion",
    "Checkout drop-off",
)
REVENUE_FIGURES = ("Gross revenue", "Net revenue", "AOV", "Estimated abandoned $")
# End of fixed values.

TRAFFIC_KEY = ("session_id", "timestamp", "product_id_viewed")
CART_KEY = ("session_id", "timestamp", "action", "product_id")

# Amounts below this size are summed as decimals of this type, see functions.money. A sum of them has ten digits more.
OUTSIDE_MONEY = 1e18
MONEY_TYPE = "decimal(28,10)"

MART_DATE = "first_seen_date"
