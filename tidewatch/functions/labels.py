"""Text labels derived from codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.schemas import VESSEL_TYPES


def vessel_type_label(code: Column) -> Column:
    """`name (code)` for known ship types, `Type n` for others, `Unknown` for NULL."""
    names = F.create_map(*[F.lit(part) for item in VESSEL_TYPES.items() for part in item])
    name = F.element_at(names, code.cast("int"))
    text = code.cast("string")
    return (
        F.when(code.isNull(), F.lit("Unknown"))
        .when(name.isNull(), F.concat(F.lit("Type "), text))
        .otherwise(F.concat(name, F.lit(" ("), text, F.lit(")")))
    )


def cluster_label(cluster_id: Column) -> Column:
    return F.concat(F.lit("Cluster "), cluster_id.cast("string"))


def fleet_status(is_anomaly: Column) -> Column:
    return F.when(is_anomaly, F.lit("Outlier / Anomaly (Distance > P95)")).otherwise(
        F.lit("Normal Navigation Profile")
    )


def congestion_risk(vessels: Column, medium: int = 5, high: int = 15) -> Column:
    return F.when(vessels >= high, "HIGH").when(vessels >= medium, "MEDIUM").otherwise("LOW")


def month_label(month: Column) -> Column:
    # Month names of the chart report.
    names = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sept", "Oct", "Nov", "Dec")
    return F.element_at(F.array(*[F.lit(n) for n in names]), month.cast("int"))
