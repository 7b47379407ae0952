"""Silver -> Gold: clean, keep rows with a usable city, cut the venue, display
dates in São Paulo time.  Narrow transformations only (no shuffle).

``event_tz`` (default ``"UTC"``) is the zone the Silver wall-clock values are taken
in; ``"UTC"`` reproduces the original (20:00 shows as 17:00, ingest dates show
the previous day 21:00); ``"America/Sao_Paulo"`` shows them unshifted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.dates import brt_display
from eventlake.functions.text import is_usable_city, venue_local
from eventlake.schemas import GOLD_DISPLAY_NAMES, NULL_LIKE_CITIES

EXPECTED = ["title", "venue", "city", "event_date_text", "event_date", "source", "ingest_date"]
TRIMMED = ["title", "venue", "city", "source", "ingest_date"]


def ensure_columns(df: DataFrame, cols: list[str] = EXPECTED) -> DataFrame:
    """Add each missing expected column as a typed null string."""
    missing = [c for c in cols if c not in df.columns]
    if not missing:
        return df
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])


def build_gold(silver: DataFrame, event_tz: str = "UTC", require_spaces: bool = False) -> DataFrame:
    df = ensure_columns(silver)
    df = df.select(*[F.trim(c).alias(c) if c in TRIMMED else F.col(c) for c in df.columns])
    df = df.filter(is_usable_city("city", NULL_LIKE_CITIES))
    ev = F.col("event_date")
    if dict(df.dtypes)["event_date"] == "string":
        ev = F.try_to_timestamp(F.trim(ev))
    ingest = F.try_to_timestamp(F.col("ingest_date"))
    return df.select(
        F.col("title").alias("nome"),
        venue_local("venue", require_spaces).alias("local"),
        F.col("city").alias("cidade"),
        brt_display(ev, "dd/MM/yyyy", event_tz).alias("data"),
        brt_display(ev, "HH:mm", event_tz).alias("hora"),
        F.col("source").alias("origem"),
        brt_display(ingest, "dd/MM/yyyy HH:mm", event_tz).alias("data_ingestao"),
    )


def to_display_names(gold: DataFrame) -> DataFrame:
    """Rename to the exported Portuguese headers (export only)."""
    return gold.select(*[F.col(k).alias(v) for k, v in GOLD_DISPLAY_NAMES.items()])
