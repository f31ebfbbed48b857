"""Table schemas, column maps and other fixed values of the data contract."""

from __future__ import annotations

from pyspark.sql import types as T

PLATFORMS = ("instagram", "tiktok", "youtube")

# Normalised source header -> canonical sales column.
SALES_RENAMES = {
    "units_sold": "quantity",
    "unitssold": "quantity",
    "price": "unit_price",
    "unitprice": "unit_price",
    "revenue": "amount",
    "productname": "product_name",
}

# Type of each canonical sales column; any other column stays text. Ids are text as
# written; a whole-number column becomes double where the file holds fractions.
SALES_TYPES = {
    "transaction_id": "string",
    "product_id": "string",
    "customer_id": "string",
    "product_name": "string",
    "category": "string",
    "quantity": "bigint",
    "unit_price": "double",
    "amount": "double",
    "discount": "double",
    "units_returned": "bigint",
    "location": "string",
    "platform": "string",
}

# Tokens a CSV reader of the data-frame family reads as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _struct(**fields: str) -> T.StructType:
    kinds = {"s": T.StringType(), "l": T.LongType(), "d": T.DoubleType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in fields.items()])


# Types of the columns a platform's file may have; dates arrive as text and are coerced after the scan.
SOCIAL_SCHEMAS = {
    "instagram": _struct(
        post_id="s", date="s", product_promoted="s", influencer_tier="s", followers="l", reach="l",
        likes="l", comments="l", shares="l", engagement_rate="d"),
    "tiktok": _struct(
        video_id="s", date="s", product_promoted="s", content_type="s", creator_tier="s",
        followers="l", views="l", likes="l", comments="l", shares="l", saves="l",
        duration_seconds="l", completion_rate="d", engagement_rate="d"),
    "youtube": _struct(
        video_id="s", date="s", product_promoted="s", video_type="s", channel_tier="s",
        subscribers="l", views="l", likes="l", dislikes="l", comments="l", shares="l",
        duration_seconds="l", avg_view_duration="d", engagement_rate="d"),
}

RUN_HISTORY_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("error", T.StringType()),
])

RUN_RECORD_SCHEMA = T.StructType([
    T.StructField("start_time", T.StringType()),
    T.StructField("end_time", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("stages_completed", T.ArrayType(T.StringType())),
    T.StructField("stages_failed", T.ArrayType(T.StringType())),
    T.StructField("errors", T.ArrayType(T.StringType())),
])

# Segment labels and how strongly each reacts to engagement.
SEGMENT_WEIGHTS = {"VIP": 1.3, "Leal": 1.1, "Ocasional": 0.9, "Dormido": 0.7}

# Recommended actions per segment label.
SEGMENT_ACTIONS = {
    "VIP": [
        "Programas de fidelidad premium",
        "Lanzamientos exclusivos",
        "Atención personalizada",
    ],
    "Leal": [
        "Incentivos para aumentar ticket promedio",
        "Cross-selling de productos complementarios",
        "Programas de referidos",
    ],
    "Ocasional": [
        "Campañas de retención",
        "Descuentos en segunda compra",
        "Email marketing educativo",
    ],
    "Dormido": [
        "Campañas de reactivación",
        "Descuentos especiales de 'regreso'",
        "Encuestas para entender por qué se fueron",
    ],
}

# Output tables a finished run is expected to leave.
EXPECTED_OUTPUTS = ("sales", "social_media_merged", "daily_aggregates", "customer_segments",
                    "correlation_general")
CRITICAL_OUTPUTS = ("sales", "social_media_merged", "daily_aggregates")

# Settings a run may override, section by section. Only what the job reads is here.
DEFAULT_CONFIG = {
    "data_sources": {
        "sales": {"path": "landing/sales.csv"},
        "social_media": {p: {"enabled": True, "path": f"landing/{p}.json"} for p in PLATFORMS},
    },
    "pipeline": {"enable_validation": True, "skip_stages": []},
    "output": {"clean_data_path": "out"},
}
