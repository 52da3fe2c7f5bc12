"""Column-expression helpers: every one returns a JVM-side ``Column``."""

from emberlake.functions.geo import geo_cell, with_geo_cell
from emberlake.functions.labels import (
    extremes_label, fire_cause, marker_colour, marker_popup,
)
from emberlake.functions.parse import (
    format_day, iso_text, parse_day, parse_iso_timestamp, split_precipitation, trunc_ntz,
)

__all__ = [
    "geo_cell", "with_geo_cell", "fire_cause", "marker_colour", "marker_popup",
    "extremes_label", "parse_day", "parse_iso_timestamp", "split_precipitation",
    "format_day", "iso_text", "trunc_ntz",
]
