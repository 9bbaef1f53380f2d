"""They decide results, so they must stay exactly as they are."""

# Order metadata, picked by order key modulo the length of the list.
PAYMENT_METHODS = ["credit_card", "bank_transfer", "paypal", "invoice"]
CUSTOMER_SEGMENTS = ["premium", "standard", "economy"]
ORDER_SOURCES = ["web", "mobile"]
EXPEDITED_EVERY = 5

# Contact addresses, picked by (customer key + offset) modulo the length of the list.
STREET_SUFFIX = " Demo Street"
CITIES = ["New York", "London", "Tokyo", "Berlin", "Sydney"]
COUNTRIES = ["US", "GB", "JP", "DE", "AU"]

DELIVERY_ZONE = "America/New_York"

# Ledger event kinds that appear as milestones, with their tag and tone.
MILESTONES = {
    "started": ("start", "info"),
    "table_done": ("done", "done"),
    "paused": ("pause", "pause"),
    "resumed": ("info", "info"),
    "cancelled": ("fail", "fail"),
    "failed": ("fail", "fail"),
    "done": ("done", "done"),
    "step_validated": ("info", "info"),
    "step_benchmarked": ("info", "info"),
}
PHASE_MILESTONES = {
    "unloading": ("unload", "start"),
    "staged": ("staged", "done"),
    "loading": ("load", "start"),
    "validating": ("verify", "info"),
}

# Milestone wording.
MILESTONE_TEXTS = {
    "paused": "Paused at batch boundary",
    "resumed": "Resumed",
    "cancelled": "Cancelled",
    "failed": "Failed",
    "done": "Run finished",
    "step_validated": "Step 3 (validate) acknowledged by agent",
    "step_benchmarked": "Step 4 (benchmark) acknowledged by agent",
}
PHASE_TEXTS = {
    "unloading": "unloading to S3",
    "staged": "staged",
    "loading": "loading from S3",
    "validating": "validating row counts",
}

# Rows expected after a scale-factor-1 warehouse load.
SF1_ROWS = {
    "region": 5,
    "nation": 25,
    "supplier": 10_000,
    "part": 200_000,
    "partsupp": 800_000,
    "customer": 150_000,
    "orders": 1_500_000,
    "lineitem": 6_001_215,
}

# Thresholds.
RATE_SERIES_LENGTH = 60
RECENT_RATES = 10
MILESTONE_LIMIT = 100
EVENT_PAGE = 200
SUM_TOLERANCE = 0.0001
STAGE_ROWS_THRESHOLD = 1_000_000
WALL_OVERHEAD_LOG_MS = 200
WALL_OVERHEAD_VIEW_MS = 50
WEAK_SPEEDUP = 3
LOW_CARDINALITY_LIMIT = 10_000
