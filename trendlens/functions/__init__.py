from trendlens.functions.categories import CATEGORY_NAMES, category_name
from trendlens.functions.durations import (
    prepared_duration_bucket,
    prepared_duration_seconds,
    stream_duration_seconds,
)
from trendlens.functions.metrics import avg_hundredths, cents, engagement_rate, half_up_hundredths
from trendlens.functions.naming import snake_case_columns, to_snake_case
from trendlens.functions.timefmt import event_time

__all__ = [
    "CATEGORY_NAMES", "category_name",
    "prepared_duration_bucket", "prepared_duration_seconds", "stream_duration_seconds",
    "avg_hundredths", "cents", "engagement_rate", "half_up_hundredths",
    "snake_case_columns", "to_snake_case", "event_time",
]
