"""Rollup definitions shared by batch queries and streams."""

from tablehaul.operators.rollup import Rollup

ORDER_SUMMARY = Rollup(
    keys=["order_day", "o_orderpriority"],
    counts={"order_count": "1"},
    sums={"daily_revenue": "o_totalprice"},
)

DAILY_STATS = Rollup(
    keys=["day", "project_id", "referrer_domain", "device_type", "country_code"],
    counts={"sessions": "1"},
    sums={
        "pageviews": "pageview_count",
        "bounces": "is_bounce",
        "total_duration": "duration_seconds",
    },
    distincts={"visitors": "visitor_id"},
)
