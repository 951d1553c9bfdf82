"""Column expressions (JVM-side, codegen-friendly) shared by the operators."""

from refinery.functions.columns import datekey, parse_timestamp, row_digest
from refinery.functions.geo import EARTH_RADIUS_KM, haversine_km

__all__ = ["datekey", "parse_timestamp", "row_digest", "haversine_km", "EARTH_RADIUS_KM"]
