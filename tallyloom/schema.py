"""Message layouts and the fixed values every module shares."""

# --- Fixed values: they must equal the message contract, so they stay literal.

POSITIVE = "긍정"
NEGATIVE = "부정"
NEUTRAL = "중립"
SENTIMENTS = (POSITIVE, NEGATIVE, NEUTRAL)

STEPS = ("collection", "transform", "analysis", "aggregation")
STATUSES = ("done", "failed", "timeout")

# Minutes a step may run before it counts as timed out.
STEP_TIMEOUT_MINUTES = {
    "collection": 60,
    "transform": 30,
    "analysis": 45,
    "aggregation": 15,
}
DEFAULT_TIMEOUT_MINUTES = 30
# Minutes after the end of a collection before the whole job counts as failed.
JOB_TIMEOUT_MINUTES = 10
TIMEOUT_TEXT = "Processing timeout exceeded"
# How long after its event time a review or a finished job is still known to streams.
JOB_LIFETIME = "7 days"

UNKNOWN_JOB = "unknown"
ERROR_JOB = "error"
# The quotes that keys may carry around them.
OUTER_QUOTES = '^"|"$'

JOIN_WITHIN_SECONDS = 90
COUNT_WINDOW = "1 hour"
COUNT_GRACE = "2 minutes"
TOP_KEYWORDS = 10

KST_ZONE = "Asia/Seoul"
KST_OFFSET = "+09:00"

CONTROL_REQUIRED = (
    "job_id",
    "step",
    "status",
    "expected_count",
    "actual_count",
    "timestamp",
)

# Columns of the joined review row, in output order, with their Spark types.
JOINED_COLUMNS = {
    "job_id": "string",
    "review_id": "string",
    "keywords": "variant",
    "rating": "double",
    "clean_text": "string",
    "summary": "string",
    "sentiment": "string",
    "product_id": "string",
    "title": "string",
    "category": "string",
    "review_count": "int",
    "sales_price": "int",
    "final_price": "int",
    "review_date": "string",
    "review_text": "string",
    "review_help_count": "int",
    "crawled_at": "string",
    "is_coupang_trial": "int",
    "is_empty_review": "int",
    "is_valid_rating": "int",
    "is_valid_date": "int",
    "has_content": "int",
    "is_valid": "int",
    "invalid_reason": "array<string>",
    "year": "int",
    "month": "int",
    "day": "int",
    "quarter": "int",
    "yyyymm": "string",
    "yyyymmdd": "string",
    "weekday": "string",
}

# --- End of fixed values.

# Columns of the joined row that come from the analysis side.
ANALYSIS_COLUMNS = ("summary", "sentiment")

# Columns of the joined row that the transform message only carries through:
# parsing skips every one of them that a query does not ask for.
PASS_THROUGH = tuple(
    name
    for name in JOINED_COLUMNS
    if name not in ("job_id", "review_id", "rating", *ANALYSIS_COLUMNS)
)

# The three flags are inspected as VARIANT because a JSON text "0", a JSON
# number 0 and a JSON false mean different things.
FLAG_FIELDS = ("is_valid", "is_empty_review", "is_coupang_trial")
RATING_FIELDS = ("rating", "overall_star_rating", "star_rating")

COHORTS = ("all", "coupang_trial", "regular")
COHORTS_WITH_EMPTY = ("all", "coupang_trial", "regular", "empty_review")
STARS = (1, 2, 3, 4, 5)
