"""Text keys, feature-name grammar and name-based roles.

The same rules serve two uses: as Column expressions over a table of column
names (profiles, dictionaries) and as predicates on a schema's field names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that decide the role of a column by its name.
IDENTIFIER_NAMES = (
    "id", "gp_id", "block_id", "district_id", "state_id", "latitude", "longitude",
    "lat", "lon", "geometry", "geom", "fid", "objectid",
)
COORDINATE_NAMES = ("latitude", "longitude", "lat", "lon")
TEMPORAL_TOKENS = ("date", "time", "lead_days", "lead_hours", "forecast_run")
PROVENANCE_TOKENS = (
    "source", "provider", "dataset", "collection", "product", "version", "retrieved", "retrieval",
    "url", "api", "provenance", "synthetic", "interpolat", "fallback", "method", "processing",
    "crs", "epsg",
)
AVAILABILITY_TOKENS = (
    "availability", "available", "acquisition_count", "valid_pixel", "valid_count",
    "valid_fraction", "coverage", "cloud_percentage", "cloud_pct", "missing_count",
    "observation_count", "image_count", "scene_count",
)
WEATHER_TOKENS = (
    "temp", "humidity", "precip", "rain", "wind", "pressure", "dewpoint", "dew_point", "cloud",
    "radiation", "shortwave", "longwave", "evapotranspiration", "et0",
)
FORECAST_TOKENS = (
    "forecast", "previous_day", "lead", "_d1", "_d2", "_d3", "_d4", "_d5", "_d6", "_d7", "gfs",
)
REANALYSIS_TOKENS = ("era5", "reanalysis")
SATELLITE_TOKENS = (
    "sentinel1", "sentinel_1", "s1_", "sentinel2", "sentinel_2", "s2_", "landsat", "lst", "ndvi",
    "evi", "savi", "ndmi", "nbr", "vh", "vv", "incidence_angle", "orbit",
)
STATIC_TOKENS = (
    "elevation", "dem", "slope", "aspect", "terrain", "landcover", "land_cover", "soil", "texture",
    "sand", "clay", "silt", "organic_carbon", "bulk_density", "lat", "lon",
)
ACTUAL_PATTERN = r"^(actual_|obs_|observed_)|_actual_"


def match_key(c: Column) -> Column:
    """Lower-case letters and digits only; the join key for place names."""
    return F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "")


def admin_name(c: Column) -> Column:
    """Upper case, underscores and hyphens as spaces; NULL as empty text."""
    return F.coalesce(F.regexp_replace(F.upper(F.trim(c)), "[_-]", " "), F.lit(""))


def snake_name(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), "[ -]", "_")


def parse_history(name: Column) -> dict[str, Column]:
    """Parts of ``hist__<source>__<operation>_<n>d``; NULL parts when it does not match."""
    pattern = r"^hist__(.+?)__(lag|rolling_mean|rolling_std|rolling_sum|wet_days)_(\d+)d$"
    hit = name.rlike(pattern)
    return {
        "source": F.when(hit, F.regexp_extract(name, pattern, 1)),
        "operation": F.when(hit, F.regexp_extract(name, pattern, 2)),
        "days": F.when(hit, F.regexp_extract(name, pattern, 3).cast("int")),
    }


def _any_of(tokens) -> str:
    return "|".join(re.escape(t) for t in tokens)


# Patterns over lower-case names, in the order in which roles are decided.
ROLE_PATTERNS = {
    "identifier": r"^(" + _any_of(IDENTIFIER_NAMES) + r")$|_id$|^(gp|block|district|state)id$",
    "temporal": _any_of(TEMPORAL_TOKENS),
    "provenance": _any_of(PROVENANCE_TOKENS),
    "availability": _any_of(AVAILABILITY_TOKENS),
    "weather": _any_of(WEATHER_TOKENS),
    "actual": ACTUAL_PATTERN,
    "forecast": _any_of(FORECAST_TOKENS),
    "reanalysis": _any_of(REANALYSIS_TOKENS),
    "satellite": _any_of(SATELLITE_TOKENS),
    "static": _any_of(STATIC_TOKENS),
}


def has_role(name: Column, role: str) -> Column:
    """Does the column name carry the role's tokens?  ``actual`` also needs a weather token."""
    low = F.lower(name)
    hit = low.rlike(ROLE_PATTERNS[role])
    return hit & low.rlike(ROLE_PATTERNS["weather"]) if role == "actual" else hit


def name_has_role(name: str, role: str) -> bool:
    """The same test for one schema field name."""
    low = name.lower()
    hit = re.search(ROLE_PATTERNS[role], low) is not None
    if role == "actual":
        return hit and re.search(ROLE_PATTERNS["weather"], low) is not None
    return hit
