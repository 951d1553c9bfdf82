"""Enrichment: integer date keys and place names from coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions.columns import datekey
from refinery.operators.areas import containing_area
from refinery.operators.places import nearest_place
from refinery.sources.tables import keyed_side

# The place written when no lookup table is given.
DEFAULT_COUNTY = "Oslo county"
DEFAULT_STATE = "Norway"


def add_datekeys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<col>_datekey`` (int yyyyMMdd) for each timestamp column."""
    return df.withColumns({f"{c}_datekey": datekey(c) for c in columns})


def add_geography(df: DataFrame, places: DataFrame | None = None, *, areas: DataFrame | None = None,
                  county: str = DEFAULT_COUNTY, state: str = DEFAULT_STATE,
                  radius_km: float = 100.0, latitude: str = "latitude",
                  longitude: str = "longitude") -> DataFrame:
    """Add ``county`` and ``state``.

    Without ``places``: the two constants on every row.  With ``places``
    (columns ``place_id, latitude, longitude, county, state``): the nearest
    place within ``radius_km`` (ties → smallest ``place_id``), NULL when the
    coordinates are NULL or nothing is in range.  See
    :mod:`refinery.operators.places`.  With ``areas`` (``area_id, county,
    state, rings``): the area that contains the point, else NULL.  See
    :mod:`refinery.operators.areas`.
    """
    if areas is not None:
        found = containing_area(df.select(latitude, longitude), areas, latitude=latitude, longitude=longitude)
    elif places is None:
        return df.withColumns({"county": F.lit(county), "state": F.lit(state)})
    else:
        found = nearest_place(df.select(latitude, longitude), places, radius_km=radius_km,
                              latitude=latitude, longitude=longitude)
    # one row per coordinate; a hot coordinate on the left is split by AQE
    found = keyed_side(found.select(latitude, longitude, "county", "state"))
    return df.join(found, on=[latitude, longitude], how="left").select(
        *df.columns, "county", "state")
