"""Schemas, enumerations and the engine's tunable settings."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENGINE = "chronogeo-1"
SCOPES = ("local", "regional", "national", "global")
#: the order in which tiers take turns when a segment's slots are filled
TIERS = (*SCOPES, "person")
PERSON = ("birth", "death")
PRECISIONS = ("day", "month", "year", "decade", "century")

EVENTS = T.StructType(
    [T.StructField("id", T.StringType(), False)]
    + [T.StructField(c, T.StringType()) for c in ("title", "display_title", "blurb", "date_start", "date_end", "date_precision")]
    + [T.StructField(c, T.DoubleType()) for c in ("lat", "lng")]
    + [T.StructField(c, T.StringType()) for c in ("place_id", "scope", "category", "founding_kind")]
    + [T.StructField(c, T.DoubleType()) for c in ("notability", "significance", "reach_km", "reach_min_lat", "reach_max_lat", "reach_min_lng", "reach_max_lng")]
    + [T.StructField(c, T.StringType()) for c in ("source_url", "source_ids", "ingest_version")]
)
PLACES = "id string, name string, level string, parent_id string, lat double, lng double, aliases array<string>"
META = "key string, value string"


@dataclass(frozen=True)
class EngineConfig:
    """What a caller may tune; the defaults are the tuned ones."""

    significance_floor: float = 0.15
    scope_floor: dict = field(default_factory=lambda: {"global": 0.2, "local": 0.05, "national": 0.15, "regional": 0.15})
    max_per_segment: int = 12
    max_segments: int = 20
    scope_quota: dict = field(default_factory=lambda: {"global": 5, "local": 4, "national": 4, "regional": 3})
    person_quota: int = 2
    category_weights: dict = field(default_factory=lambda: {"founding": 0.7, "death": 0.5, "birth": 0.4})
    founding_kind_weights: dict = field(default_factory=lambda: {"country": 0.9, "subnational": 0.9, "institution": 0.5, "settlement": 0.35})

    @staticmethod
    def of(**given) -> EngineConfig:
        """Defaults overlaid by the caller's values; dictionaries are merged key by key.

        A significance_floor by itself raises every scope's floor that the caller did not set.
        """
        base = EngineConfig()
        merged = {k: {**getattr(base, k), **v} if isinstance(v, dict) else v for k, v in given.items() if v is not None}
        cfg = replace(base, **merged)
        if given.get("significance_floor") is not None:
            own = given.get("scope_floor") or {}
            raised = {s: f if s in own else max(f, cfg.significance_floor) for s, f in cfg.scope_floor.items()}
            cfg = replace(cfg, scope_floor=raised)
        return cfg

    @property
    def least_floor(self) -> float:
        """The one number that can be pushed to the scan."""
        return min(self.significance_floor, *self.scope_floor.values())

    def quota(self, tier: str) -> int:
        return self.person_quota if tier == "person" else self.scope_quota.get(tier, self.max_per_segment)


def with_missing_columns(df: DataFrame, schema: T.StructType = EVENTS) -> DataFrame:
    """df with a typed null for each column of schema that an older table lacks, so that every reader sees one layout."""
    have = set(df.columns)
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in have}) if any(f.name not in have for f in schema.fields) else df
