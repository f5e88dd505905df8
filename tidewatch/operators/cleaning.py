"""From raw text pings to typed, validated ones, with a reason for every row that is turned away."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import geo, text
from tidewatch.functions.calendar import calendar_columns
from tidewatch.operators.dedup import dedup
from tidewatch.operators.enrich import recover_vessel_info
from tidewatch.operators.shape import computed_once
from tidewatch.schemas import (
    CALENDAR_FIELDS, CORRUPT, DOUBLE_FIELDS, INT_FIELDS, RAW_FIELDS, RAW_SCHEMA_WITH_CORRUPT, TEXT_FIELDS,
)
from tidewatch.session import materialize

HEADER = "HEADER"
JSON_CORRUPT = "JSON_CORRUPT"
NO_IMO = "IMO0000000"
MMSI_PATTERN = r"^[0-9]{9}$"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


@dataclass(frozen=True)
class CleanProfile:
    """How one family of jobs cleans pings."""

    name: str
    time_pattern: str | None
    trims_before_header_check: bool
    checks_motion: bool
    imo_ignores_case: bool
    kmh_digits: int | None
    dedup_keys: tuple[str, ...]
    recovers_info: bool


STREAM = CleanProfile(
    name="stream", time_pattern=ISO_SECONDS, trims_before_header_check=False, checks_motion=False,
    imo_ignores_case=False, kmh_digits=None, dedup_keys=("MMSI", "BaseDateTime"), recovers_info=False,
)
BATCH = CleanProfile(
    name="batch", time_pattern=None, trims_before_header_check=True, checks_motion=True,
    imo_ignores_case=True, kmh_digits=2, dedup_keys=("MMSI", "BaseDateTime", "LAT", "LON"), recovers_info=True,
)
PROFILES = {p.name: p for p in (STREAM, BATCH)}


def parse_json(messages: DataFrame, value: str = "value") -> DataFrame:
    """Envelope rows to 17 text columns; unreadable bodies keep their text in the corrupt column."""
    body = F.col(value).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    kept = [c for c in messages.columns if c != value]
    return messages.select(
        *kept, body.alias("raw_json"), F.from_json(body, RAW_SCHEMA_WITH_CORRUPT, options).alias("_ping")
    ).select(*kept, "raw_json", "_ping.*")


def kafka_columns(messages: DataFrame) -> DataFrame:
    """Keep where each message came from under names of our own."""
    return messages.select(
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        "value",
    )


def classify(parsed: DataFrame, profile: CleanProfile = STREAM) -> DataFrame:
    """Type all fields in one pass and add `reject_reason`, NULL for good rows.

    Raw text stays available under `raw_<field>`; repeated header rows get the reason HEADER.
    """
    others = [c for c in parsed.columns if c not in RAW_FIELDS]
    raw = {f: F.col(f) for f in RAW_FIELDS if f in parsed.columns}
    clean = {f: text.blank_to_null(c) for f, c in raw.items()}

    typed: dict[str, Column] = {}
    for field in raw:
        if field == "MMSI":
            typed[field] = F.when(F.trim(raw[field]).rlike(MMSI_PATTERN), raw[field].try_cast("long"))
        elif field == "BaseDateTime":
            typed[field] = text.as_timestamp(F.trim(raw[field]), profile.time_pattern)
        elif field in DOUBLE_FIELDS:
            typed[field] = without_sentinel(field, text.as_double(raw[field]))
        elif field in INT_FIELDS:
            typed[field] = text.as_int(raw[field])
        else:
            typed[field] = clean[field]

    staged = computed_once(parsed.select(
        *others,
        *[c.alias(f) for f, c in typed.items()],
        *[c.alias(f"raw_{f}") for f, c in raw.items()],
    ))
    return staged.withColumn("reject_reason", reject_reason(staged, profile))


def without_sentinel(field: str, value: Column) -> Column:
    """The codes that mean "not available" become NULL."""
    # Heading 511, speed 102.2 and above, course 360 and above.
    if field == "Heading":
        return F.when(value != 511, value)
    if field == "SOG":
        return F.when(~(value >= 102.2), value)
    if field == "COG":
        return F.when(~(value >= 360), value)
    return value


def reject_reason(staged: DataFrame, profile: CleanProfile) -> Column:
    """The first check a row fails, in the order in which the checks run."""
    raw_mmsi = F.col("raw_MMSI")
    header = (F.upper(F.trim(raw_mmsi)) if profile.trims_before_header_check else raw_mmsi) == "MMSI"
    position = geo.valid_position(F.col("LAT"), F.col("LON"))
    checks = []
    if CORRUPT in staged.columns:
        checks.append((F.col(CORRUPT).isNotNull(), JSON_CORRUPT))
    checks += [
        (raw_mmsi.isNull(), "MMSI_MISSING"),
        (header, HEADER),
        (F.col("MMSI").isNull(), "MMSI_FORMAT"),
        (F.col("BaseDateTime").isNull(), "TIMESTAMP"),
        (~position, "LATLON_RANGE"),
        (position.isNull(), "LATLON_MISSING"),
    ]
    if profile.checks_motion:
        checks += [
            (F.col("SOG") < 0, "SOG_RANGE"),
            (F.col("COG") < 0, "COG_RANGE"),
            ((F.col("Heading") < 0) | (F.col("Heading") >= 360), "HEADING_RANGE"),
        ]
    reason = F.lit(None).cast("string")
    for failed, name in reversed(checks):
        reason = F.when(failed, F.lit(name)).otherwise(reason)
    return reason


def accepted(classified: DataFrame) -> DataFrame:
    """Good rows with typed columns only, not yet deduplicated."""
    helpers = [c for c in classified.columns if c.startswith("raw_")] + ["reject_reason", CORRUPT]
    return classified.filter("reject_reason IS NULL").drop(*helpers)


def rejects(classified: DataFrame) -> DataFrame:
    """Validation rejects as text, with reason and raw body; headers and broken JSON are not among them."""
    turned_away = classified.filter(~F.col("reject_reason").isin(HEADER, JSON_CORRUPT))
    return _as_text(turned_away)


def json_rejects(classified: DataFrame) -> DataFrame:
    """The dead letters: bodies that are not readable JSON."""
    return _as_text(classified.filter(F.col("reject_reason") == JSON_CORRUPT))


def _as_text(classified: DataFrame) -> DataFrame:
    origin = [c for c in classified.columns if c.startswith("kafka_")]
    body = ["raw_json"] if "raw_json" in classified.columns else []
    fields = [
        F.col(f"raw_{f}").cast("string").alias(f) for f in RAW_FIELDS if f"raw_{f}" in classified.columns
    ]
    return classified.select(*origin, *fields, *body, "reject_reason")


def union_rejects(*parts: DataFrame) -> DataFrame:
    """Rejects of several sources as one table; columns a part lacks are NULL, all payload is text."""
    def as_strings(part: DataFrame) -> DataFrame:
        return part.select(*[
            F.col(f.name).cast("string").alias(f.name) if f.name in RAW_FIELDS else F.col(f.name)
            for f in part.schema
        ])

    whole = as_strings(parts[0])
    for part in parts[1:]:
        whole = whole.unionByName(as_strings(part), allowMissingColumns=True)
    return whole


def blank_columns_to_null(rows: DataFrame) -> DataFrame:
    """Trim every text column and turn blank text into NULL."""
    return rows.select(*[
        text.blank_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in rows.schema
    ])


def with_defaults(rows: DataFrame, profile: CleanProfile = STREAM) -> DataFrame:
    """UNKNOWN for missing names, call signs, classes and IMO numbers."""
    return rows.withColumns({
        f: text.default_unknown(known_imo(F.col(f), profile) if f == "IMO" else F.col(f))
        for f in TEXT_FIELDS if f in rows.columns
    })


def known_imo(imo: Column, profile: CleanProfile) -> Column:
    """The IMO number, NULL for the all-zero placeholder."""
    seen = F.upper(F.trim(imo)) if profile.imo_ignores_case else imo
    return F.when(seen != NO_IMO, imo)


def with_features(rows: DataFrame, profile: CleanProfile = STREAM) -> DataFrame:
    """Speed in km/h, six calendar numbers and the partition date."""
    calendar = calendar_columns(F.col("BaseDateTime"))
    return rows.withColumn("speed_kmh", geo.speed_kmh(F.col("SOG"), profile.kmh_digits)).withColumns(
        {name: calendar[name] for name in (*CALENDAR_FIELDS, "date")}
    )


def clean(
    parsed: DataFrame, profile: CleanProfile = STREAM, order: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Cleaned pings and rejects of a bounded table of parsed rows; `order` decides between duplicates."""
    classified = classify(parsed, profile)
    good = dedup(accepted(classified), profile.dedup_keys, order)
    if profile.recovers_info:
        # Read twice below: once per vessel and once per row.
        good = materialize(good.withColumn("IMO", known_imo(F.col("IMO"), profile)), "deduplicated")
        good = recover_vessel_info(good, order=order)
    return with_features(with_defaults(good, profile), profile), rejects(classified)


def clean_legacy(rows: DataFrame, run_date: str, order: Sequence[str] | None = None) -> DataFrame:
    """The older CSV form: lower-case columns, complete and in range, one row per (mmsi, timestamp)."""
    good = rows.dropna(subset=["mmsi", "lat", "lon", "sog"]).filter(
        geo.valid_position(F.col("lat"), F.col("lon")) & (F.col("sog") >= 0.0)
    )
    return (
        dedup(good, ["mmsi", "timestamp"], order)
        .withColumn("speed_kmh", geo.speed_kmh(F.col("sog")))
        .withColumn("run_date", F.lit(run_date))
    )


def clean_minimal(parsed: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """The short batch form: typed, complete, in range, not moving backwards, deduplicated, km/h rounded."""
    casts = {f: text.as_double(F.col(f)) for f in DOUBLE_FIELDS if f in parsed.columns}
    casts |= {f: text.as_int(F.col(f)) for f in INT_FIELDS if f in parsed.columns}
    casts["BaseDateTime"] = text.as_timestamp(F.col("BaseDateTime"))
    good = (
        computed_once(parsed.withColumns(casts))
        .dropna(subset=["MMSI", "BaseDateTime", "LAT", "LON"])
        .filter(geo.valid_position(F.col("LAT"), F.col("LON")))
        .filter(F.col("SOG").isNull() | (F.col("SOG") >= 0))
    )
    return dedup(good, ["MMSI", "BaseDateTime", "LAT", "LON"], order).withColumn(
        "speed_kmh", geo.speed_kmh(F.col("SOG"), 2)
    )
