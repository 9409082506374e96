"""Thresholds and label texts that define the answers of the marts."""

from decimal import Decimal

# Hours of day that count as peak.
PEAK_HOURS = [7, 8, 16, 17]

# Upper bounds on a rank, a percentile or a quartile, and their labels.
REVENUE_TIERS = [(10, "Top Tier (Rank <=10)"), (30, "Mid Tier (Rank 11-30)")]
REVENUE_TIER_REST = "Growth Tier (Rank >30)"

QUALITY_TIERS = [(1, "Platinum (4.8+)"), (2, "Gold (4.5-4.7)"), (3, "Silver (4.0-4.4)")]
QUALITY_TIER_REST = "Development (Below 4.0)"

COMMISSION_TIERS = [
    (Decimal("0.20"), "Top 20% - +15% Commission"),
    (Decimal("0.50"), "Top 50% - +10% Commission"),
]
COMMISSION_TIER_REST = "Growth Pool - +5% Commission"

EFFICIENCY_QUARTILES = [
    (Decimal("0.25"), "Q1 (Best) - Fleet Stars"),
    (Decimal("0.50"), "Q2 (Good) - Reliable"),
    (Decimal("0.75"), "Q3 (Fair) - Training Eligible"),
]
EFFICIENCY_QUARTILE_REST = "Q4 (Development) - Mentoring Program"

VALUE_SEGMENTS = [(1, "VIP (Top 25%)"), (2, "Premium (25-50%)"), (3, "Standard (50-75%)")]
VALUE_SEGMENT_REST = "Basic (Bottom 25%)"

SEGMENT_OFFERS = [
    (1, "VIP: Free upgrades, priority support"),
    (2, "Premium: 5% off future rides"),
    (3, "Standard: Loyalty points"),
]
SEGMENT_OFFER_REST = "Basic: Standard service"

# Idle hours above which a gap is flagged, largest first.
IDLE_FLAGS = [(4, "CHURN RISK: >4hr idle"), (2, "WARNING: 2-4hr idle")]
IDLE_NORMAL = "Normal: <2hr idle"
IDLE_LAST_RIDE = "Last ride (no next ride data)"

# Least fare gain over the first ride, largest first.
PROGRESSION_TRENDS = [
    (20, "Strong Growth (>$20 gain)"),
    (5, "Positive Trend ($5-$20 gain)"),
    (0, "Stable ($0-$5)"),
]
PROGRESSION_REST = "Declining (<$0)"

# Latest rating minus lifetime mean.
TREND_ALERT_BELOW = Decimal("-0.5")
TREND_ALERT = "ALERT: Quality declining >0.5 stars"
TREND_WARNING = "WARNING: Slight quality decline"
TREND_POSITIVE = "POSITIVE: Maintaining or improving"

# Least number of rides per lifecycle stage, largest first.
LIFECYCLE_STAGES = [
    (100, "Active (100+ rides)"),
    (50, "Engaged (50+ rides)"),
    (10, "Onboarded (10+ rides)"),
]
LIFECYCLE_REST = "New (<10 rides)"
STRONG_ONBOARDING = "Strong onboarding (fares increasing)"
MONITOR_ONBOARDING = "Monitor growth pattern"

# Defaults of the sampled reports.
SAMPLE_DRIVER_KEYS = [1, 5, 10, 15, 20]
SAMPLE_DRIVER_NAMES = [
    "Joann Wolfe",
    "Jeremy Bautista",
    "Christina Chang",
    "Mark Davis",
    "Brooke Snyder",
]
MILESTONES = [1, 10, 50, 100]

# English weekday names, Monday first.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
