"""Appeal economics per reason category: the tunable assumptions.

The assumptions are a small DataFrame (one row per category) rather than
CASE expressions, so a caller can pass its own table. The reason dimension is
left-joined to it: a code whose category is unknown or NULL gets NULL rates
(and hence a NULL recoverable amount downstream), while its high-appeal flag
is false, never NULL.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, StringType, StructField, StructType



@dataclass(frozen=True)
class CategoryAssumption:
    category: str
    appeal_win_rate: Decimal
    category_multiplier: Decimal
    high_appeal_value: bool
    fix_probability: Decimal
    recommended_action: str


# Appeal win rate, recoverability multiplier, whether the
# category is worth appealing, likelihood a workflow fix prevents the denial,
# and the recommended workflow action, per reason category.
DEFAULT_ASSUMPTIONS: tuple[CategoryAssumption, ...] = (
    CategoryAssumption(
        "technical", Decimal("0.72"), Decimal("1.00"), True, Decimal("0.85"),
        "Automate prior-auth / eligibility verification & documentation capture at intake",
    ),
    CategoryAssumption(
        "coding", Decimal("0.68"), Decimal("0.95"), True, Decimal("0.80"),
        "Add pre-submission coding QA with dx-to-procedure edit checks",
    ),
    CategoryAssumption(
        "coverage", Decimal("0.30"), Decimal("0.50"), False, Decimal("0.35"),
        "Verify benefits & coordination-of-benefits up front; appeal upside is limited",
    ),
    CategoryAssumption(
        "medical_necessity", Decimal("0.18"), Decimal("0.35"), False, Decimal("0.25"),
        "Strengthen clinical documentation and align orders to payer medical-necessity policy",
    ),
)

RATE = DecimalType(3, 2)

ASSUMPTIONS_SCHEMA = StructType(
    [
        StructField("category", StringType(), False),
        StructField("appeal_win_rate", RATE),
        StructField("category_multiplier", RATE),
        StructField("high_appeal_value", BooleanType()),
        StructField("fix_probability", RATE),
        StructField("recommended_action", StringType()),
    ]
)


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, Decimal):
        return f"{value:f}BD"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def assumptions_values(assumptions: tuple[CategoryAssumption, ...]) -> str:
    """The assumptions as SQL text: a typed VALUES relation named ``a``."""
    fields = ASSUMPTIONS_SCHEMA.fields
    rows = [
        "(" + ", ".join(f"cast({_literal(getattr(a, f.name))} as {f.dataType.simpleString()})" for f in fields) + ")" for a in assumptions
    ]
    return f"(values {', '.join(rows)}) as a({', '.join(f.name for f in fields)})"


def assumptions_frame(
    spark: SparkSession, assumptions: tuple[CategoryAssumption, ...] = DEFAULT_ASSUMPTIONS
) -> DataFrame:
    """The assumptions as a DataFrame; its size is the length of the tuple.

    Categories must be unique: a repeated category would fan out every reason
    code of that category in the lookup join.
    """
    categories = [a.category for a in assumptions]
    if len(set(categories)) != len(categories):
        raise ValueError(f"repeated category in assumptions: {categories}")
    if not assumptions:
        return spark.createDataFrame([], ASSUMPTIONS_SCHEMA)
    # a VALUES relation: its size is known, so the planner can broadcast it
    return spark.sql(f"select * from {assumptions_values(assumptions)}")


def reason_economics(reason_codes: DataFrame, assumptions: DataFrame) -> DataFrame:
    """One row per reason code with its category's appeal economics.

    ``reason_codes`` is the staged reason dimension (carc_code,
    carc_description, carc_category). ``assumptions`` has one row per category.
    """
    rate = RATE.simpleString()
    a = assumptions.selectExpr(
        "category as carc_category",
        "high_appeal_value",
        f"cast(appeal_win_rate as {rate}) as appeal_win_rate",
        f"cast(category_multiplier as {rate}) as category_multiplier",
    )
    return reason_codes.join(a, "carc_category", "left").selectExpr(
        "carc_code",
        "carc_description",
        "carc_category",
        "coalesce(high_appeal_value, false) as is_high_appeal_value",
        "appeal_win_rate",
        "category_multiplier",
    )


def fix_assumptions(assumptions: DataFrame) -> DataFrame:
    """Category -> fix probability and recommended action."""
    return assumptions.select(
        F.col("category").alias("carc_category"),
        F.col("fix_probability").cast(RATE).alias("fix_probability"),
        "recommended_action",
    )
