"""Review schema, aspect dimension and class order.

Rows are always matched on ``id`` and columns are always addressed by name; nothing
here depends on row order or column position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed values: (index, short code, label column) of the 20 aspects, in index order.
ASPECTS: tuple[tuple[int, str, str], ...] = (
    (1, "ltc", "location_traffic_convenience"),
    (2, "ldfbd", "location_distance_from_business_district"),
    (3, "letf", "location_easy_to_find"),
    (4, "swt", "service_wait_time"),
    (5, "swa", "service_waiters_attitude"),
    (6, "spc", "service_parking_convenience"),
    (7, "ssp", "service_serving_speed"),
    (8, "pl", "price_level"),
    (9, "pce", "price_cost_effective"),
    (10, "pd", "price_discount"),
    (11, "ed", "environment_decoration"),
    (12, "en", "environment_noise"),
    (13, "es", "environment_space"),
    (14, "ec", "environment_cleaness"),
    (15, "dp", "dish_portion"),
    (16, "dt", "dish_taste"),
    (17, "dl", "dish_look"),
    (18, "dr", "dish_recommendation"),
    (19, "ooe", "others_overall_experience"),
    (20, "owta", "others_willing_to_consume_again"),
)

# Class labels in score-vector order.
CLASSES: tuple[int, ...] = (-2, -1, 0, 1)

# Which of two models answers for which aspect in the routed ensemble.
ROUTE_CAPSULE: tuple[int, ...] = (3, 6, 8, 9, 14, 15, 16, 19, 20)
ROUTE_BIGRU: tuple[int, ...] = (1, 2, 4, 5, 7, 10, 11, 12, 13, 17, 18)

MAXLEN = 1200

ASPECT_COLUMNS: tuple[str, ...] = tuple(name for _, _, name in ASPECTS)
ASPECT_INDEX: dict[str, int] = {name: idx for idx, _, name in ASPECTS}


def aspect_code(idx: int) -> str:
    return ASPECTS[idx - 1][1]


def aspect_name(idx: int) -> str:
    return ASPECTS[idx - 1][2]


def review_schema(label_type: T.DataType | None = None) -> T.StructType:
    """``id``, ``content`` and one column per aspect.

    Labels are INT; pass ``StringType()`` for score tables, whose cells hold the text
    of a four-number vector.
    """
    label = label_type or T.IntegerType()
    return T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("content", T.StringType())]
        + [T.StructField(name, label) for name in ASPECT_COLUMNS]
    )


def aspect_table(spark: SparkSession) -> DataFrame:
    """The 20-row aspect dimension ``(aspect_idx, code, aspect)``."""
    return spark.createDataFrame(list(ASPECTS), "aspect_idx int, code string, aspect string")


def route_table(spark: SparkSession, routes: dict[str, tuple[int, ...]] | None = None) -> DataFrame:
    """``(aspect_idx, model)``: exactly one model per aspect, checked here."""
    routes = routes or {"capsule": ROUTE_CAPSULE, "bigru": ROUTE_BIGRU}
    rows = sorted((idx, model) for model, idxs in routes.items() for idx in idxs)
    seen = [idx for idx, _ in rows]
    if len(seen) != len(set(seen)):
        raise ValueError("an aspect is routed to more than one model")
    return spark.createDataFrame(rows, "aspect_idx int, model string")
