"""Column registry: the one place that says which columns exist and their types.

Every generated expression (casts, checks, projections, DDL) is driven from here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, types as T


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # float | int | date | str | timestamp
    nested: bool = False  # list of {action_type, value}, value of type ``kind``
    nullable: bool = True

    @property
    def data_type(self) -> T.DataType:
        scalar = SPARK_TYPES.get(self.kind, T.StringType())
        if not self.nested:
            return scalar
        item = T.StructType(
            [T.StructField("action_type", T.StringType()), T.StructField("value", scalar)]
        )
        return T.ArrayType(item)

    @property
    def comment(self) -> str:
        return _MEANINGS[self.name] + (" Per action type." if self.nested else "")

    @property
    def field_class(self) -> str:
        return "nested" if self.nested else self.kind


SPARK_TYPES = {
    "float": T.DoubleType(),
    "int": T.LongType(),
    "date": T.DateType(),
    "str": T.StringType(),
    "timestamp": T.TimestampType(),
}

# Column names of the metrics table and of the KPI dimension.
_FLOATS = (
    "spend cpc cpm cpp ctr frequency unique_ctr cost_per_unique_click inline_link_click_ctr"
)
_INTS = "impressions reach clicks unique_clicks inline_link_clicks"
_DATES = "date_start date_stop"
_STRINGS = (
    "account_id account_name account_currency ad_id ad_name adset_id adset_name "
    "campaign_id campaign_name quality_ranking engagement_rate_ranking "
    "conversion_rate_ranking objective optimization_goal"
)
_FLOAT_ACTIONS = "website_ctr cost_per_action_type cost_per_unique_action_type"
_INT_ACTIONS = (
    "actions unique_actions video_play_actions video_avg_time_watched_actions "
    "video_p100_watched_actions video_p25_watched_actions video_p50_watched_actions "
    "video_p75_watched_actions video_thruplay_watched_actions"
)
# Requested from the source and readable, but not part of the table.
_READ_ONLY_ACTIONS = "action_values purchase_roas"

_MEANINGS = {
    "spend": "Money spent on the ad that day, in the account's currency.",
    "cpc": "Average price of a click of any kind.",
    "cpm": "Average price of a thousand impressions.",
    "cpp": "Average price of reaching a thousand people.",
    "ctr": "Clicks as a percentage of impressions.",
    "frequency": "How often a person who was reached saw the ad on average.",
    "unique_ctr": "People who clicked as a percentage of people reached.",
    "cost_per_unique_click": "Average price of a person who clicked.",
    "inline_link_click_ctr": "Clicks on the ad's link as a percentage of impressions.",
    "impressions": "Times that the ad was on a screen.",
    "reach": "People who saw the ad at least once.",
    "clicks": "Clicks of any kind on the ad.",
    "unique_clicks": "People who clicked on the ad.",
    "inline_link_clicks": "Clicks on the link in the ad.",
    "date_start": "Day that the row counts; the table's partition.",
    "date_stop": "Last day that the row counts, the same day in daily rows.",
    "account_id": "Advertising account, without a prefix.",
    "account_name": "Name of the advertising account.",
    "account_currency": "Currency of all money in the row, by its three-letter code.",
    "ad_id": "The ad.",
    "ad_name": "Name of the ad.",
    "adset_id": "Group of ads with one budget and audience that the ad is in.",
    "adset_name": "Name of the ad's group.",
    "campaign_id": "Campaign that the group is in.",
    "campaign_name": "Name of the campaign.",
    "quality_ranking": "Perceived quality against ads for the same audience.",
    "engagement_rate_ranking": "Expected engagement against ads for the same audience.",
    "conversion_rate_ranking": "Expected conversions against ads with the same goal and audience.",
    "objective": "What the campaign is to achieve.",
    "optimization_goal": "What delivery of the group is steered by.",
    "website_ctr": "Clicks through to the website as a percentage of impressions.",
    "cost_per_action_type": "Average price of an action.",
    "cost_per_unique_action_type": "Average price of a person who acted.",
    "actions": "Actions that people took because of the ad.",
    "unique_actions": "People who acted because of the ad.",
    "video_play_actions": "Times that the video began to play.",
    "video_avg_time_watched_actions": "Seconds that the video was watched on average.",
    "video_p100_watched_actions": "Times that the video was watched to its end.",
    "video_p25_watched_actions": "Times that a quarter of the video was watched.",
    "video_p50_watched_actions": "Times that half of the video was watched.",
    "video_p75_watched_actions": "Times that three quarters of the video were watched.",
    "video_thruplay_watched_actions": "Times that the video was watched to its end or for fifteen seconds.",
    "user_friendly_name": "Name that people use for a measure.",
    "meta_action_type": "Action type that the name stands for in nested columns.",
    "mapping_type": "Where the mapping is from: standard, custom or pixel.",
    "ad_account_id": "Account that the mapping is for, or all.",
    "facebook_conversion_id": "Id of the custom conversion behind the mapping, if any.",
    "last_updated": "When the mapping was written.",
}

# Merge keys. The first is the upsert key, the second the older one.
UPSERT_KEYS = ("account_id", "ad_id", "date_start")
LEGACY_KEYS = ("date_start", "date_stop", "ad_id")
PARTITION = "date_start"

# Scalar and nested shapes recognised by name.
_SCHEMAS: dict[str, tuple[Field, ...]] = {
    "insights": (
        *(Field(n, "float") for n in _FLOATS.split()),
        *(Field(n, "int") for n in _INTS.split()),
        *(Field(n, "date") for n in _DATES.split()),
        *(Field(n, "str") for n in _STRINGS.split()),
        *(Field(n, "float", nested=True) for n in _FLOAT_ACTIONS.split()),
        *(Field(n, "int", nested=True) for n in _INT_ACTIONS.split()),
    ),
    "kpi_mapping": (
        Field("user_friendly_name", "str", nullable=False),
        Field("meta_action_type", "str", nullable=False),
        Field("mapping_type", "str"),
        Field("ad_account_id", "str"),
        Field("facebook_conversion_id", "str"),
        Field("last_updated", "timestamp"),
    ),
}


def fields(name: str) -> tuple[Field, ...]:
    if name not in _SCHEMAS:
        raise ValueError(f"unknown schema {name!r}; known: {', '.join(_SCHEMAS)}")
    return _SCHEMAS[name]


def schema_for(name: str) -> T.StructType:
    """Typed table schema."""
    return T.StructType(
        [
            T.StructField(f.name, f.data_type, f.nullable, {"comment": f.comment})
            for f in fields(name)
        ]
    )


def field_classes(name: str) -> dict[str, list[str]]:
    """Column names by class: float, int, date, str, timestamp, nested."""
    out: dict[str, list[str]] = {}
    for f in fields(name):
        out.setdefault(f.field_class, []).append(f.name)
    return out


def scan_fields() -> list[str]:
    """Default projection of a scan: the registered columns and two read-only ones."""
    return [f.name for f in fields("insights")] + _READ_ONLY_ACTIONS.split()


def landing_schema() -> T.StructType:
    """Untyped landing schema: text scalars, and VARIANT so that bad shapes survive."""
    nested = {f.name for f in fields("insights") if f.nested} | set(_READ_ONLY_ACTIONS.split())
    return T.StructType(
        [
            T.StructField(n, T.VariantType() if n in nested else T.StringType())
            for n in scan_fields()
        ]
    )


def updatable_columns(df: DataFrame, keys: tuple[str, ...] = LEGACY_KEYS) -> list[str]:
    """All columns of a table except its keys."""
    return [c for c in df.columns if c not in keys]


def conform(df: DataFrame, schema: str | T.StructType = "insights") -> DataFrame:
    """Project to the columns of a schema; absent ones become typed nulls, others go."""
    schema = schema_for(schema) if isinstance(schema, str) else schema
    return df.selectExpr(
        *(
            f"CAST({f'`{f.name}`' if f.name in df.columns else 'NULL'} AS {f.dataType.simpleString()}) "
            f"AS `{f.name}`"
            for f in schema.fields
        )
    )
