"""Fill gaps in a vessel's fixed data from its other pings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.dedup import row_order
from tidewatch.operators.lookup import join_lookup
from tidewatch.schemas import VESSEL_INFO_FIELDS
from tidewatch.session import materialize


def vessel_reference(
    pings: DataFrame, fields: Sequence[str] = VESSEL_INFO_FIELDS, order: Sequence[str] | None = None
) -> DataFrame:
    """The earliest known value of each field per vessel."""
    when = F.struct("BaseDateTime", *(order or row_order(pings)))
    return pings.groupBy("MMSI").agg(*[
        F.min_by(F.col(f), F.when(F.col(f).isNotNull(), when)).alias(f"_ref_{f}") for f in fields
    ])


def recover_vessel_info(
    pings: DataFrame, fields: Sequence[str] | None = None, order: Sequence[str] | None = None
) -> DataFrame:
    """Replace missing fields by the vessel's earliest known value."""
    fields = [f for f in (fields or VESSEL_INFO_FIELDS) if f in pings.columns]
    known = materialize(vessel_reference(pings, fields, order), "vessels")
    filled = join_lookup(pings, known, ["MMSI"], "left")
    return filled.select(*[
        F.coalesce(c, f"_ref_{c}").alias(c) if c in fields else F.col(c) for c in pings.columns
    ])
