"""Message -> event -> enriched event. The same functions serve batch and stream frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.functions import events as measures
from haulmark.functions.calendar import iso_timestamp
from haulmark.schemas import EVENT_SCHEMA, ddl
from haulmark.sources.events import BROKER_POSITION, FILE_POSITION


def decode(messages: DataFrame) -> DataFrame:
    """Event fields plus the message text; what cannot be parsed becomes NULL.

    Position columns, where present, are kept to order events by arrival.
    """
    text = F.col("value").cast("string")
    known = BROKER_POSITION + FILE_POSITION
    position = [name for name in known if name in messages.columns]
    event = F.from_json(text, ddl(EVENT_SCHEMA), {"mode": "PERMISSIVE"})
    return messages.select(event.alias("event"), text.alias("message"), *position).select(
        "event.*", "message", *position
    )


def enrich(events: DataFrame) -> DataFrame:
    c = F.col
    return events.withColumns(
        {
            "event_timestamp": iso_timestamp(c("event_timestamp")),
            "cost_per_km": measures.cost_per_km(c("revenue"), c("distance_km")),
            "weather_risk": measures.weather_risk(c("temperature_c"), c("humidity_pct")),
        }
    )
