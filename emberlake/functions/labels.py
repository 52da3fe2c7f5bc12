"""Derived labels: fire cause, map-marker fields, extremes captions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cause rule's thresholds and labels.
NATURAL_AIR_TEMPERATURE = 20.0
NATURAL_GHI = 180.0
CAUSE_NATURAL = "natural"
CAUSE_OTHER = "other"

# Marker colours and popup template.
COLOUR_NATURAL = "blue"
COLOUR_OTHER = "red"
POPUP_TEMPLATE = ("<b>Cause:</b> %s</br><b>Surface Temperature:</b> %d</br>"
                  "<b>Air Temperature:</b> %d</br><b>Relative Humidity:</b> %d")

# The rolling-extremes captions.
CAPTION_MIN = "Minimum"
CAPTION_MAX = "Maximum"
CAPTION_TEMPLATE = "%s (Date: %s & Temp: %s)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fire_cause(air_temperature: Column | str, ghi: Column | str,
               air_threshold: float = NATURAL_AIR_TEMPERATURE,
               ghi_threshold: float = NATURAL_GHI) -> Column:
    """'natural' when the day is hot and bright, otherwise 'other'."""
    hot = (_c(air_temperature) > F.lit(air_threshold)) & (_c(ghi) > F.lit(ghi_threshold))
    return F.when(hot, F.lit(CAUSE_NATURAL)).otherwise(F.lit(CAUSE_OTHER))


def marker_colour(cause: Column | str) -> Column:
    return F.when(_c(cause) == F.lit(CAUSE_NATURAL), F.lit(COLOUR_NATURAL)).otherwise(F.lit(COLOUR_OTHER))


def marker_popup(cause: Column | str, surface_temperature: Column | str,
                 air_temperature: Column | str, relative_humidity: Column | str) -> Column:
    """Popup HTML; measures are truncated toward zero like ``%d`` on a float."""
    return F.format_string(
        POPUP_TEMPLATE, _c(cause),
        _c(surface_temperature).cast("int"), _c(air_temperature).cast("int"),
        _c(relative_humidity).cast("int"))


def extremes_label(kind: str, day_label: Column | str, temperature: Column | str) -> Column:
    """``Minimum (Date: 2/01/18 & Temp: 15.0)`` style caption."""
    return F.format_string(CAPTION_TEMPLATE, F.lit(kind), _c(day_label), _c(temperature).cast("string"))
