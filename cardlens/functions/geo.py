"""Distances between cardholder and merchant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0  # fixed value


def _null_as(distance: Column, default: float | None) -> Column:
    return distance if default is None else F.coalesce(distance, F.lit(float(default)))


def _known(coordinate: Column) -> Column:
    """NaN, which CSV and JSON may hold, is a missing coordinate."""
    return F.nanvl(coordinate.cast("double"), F.lit(None).cast("double"))


def haversine_km(
    lat1: Column, long1: Column, lat2: Column, long2: Column, null_as: float | None = 0.0
) -> Column:
    """Great-circle distance in km; any missing coordinate gives ``null_as``.

    The chord term is clamped at 1 so that antipodal points cannot leave the
    domain of ``asin`` by a rounding error.
    """
    lat1, long1, lat2, long2 = map(_known, (lat1, long1, lat2, long2))
    half_dlat = F.sin(F.radians(lat2 - lat1) / F.lit(2.0))
    half_dlong = F.sin(F.radians(long2 - long1) / F.lit(2.0))
    chord = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlong * half_dlong
    known = chord.isNotNull()  # least() skips NULL, so the clamp must not see one
    arc = F.when(known, F.asin(F.sqrt(F.least(F.lit(1.0), chord))))
    return _null_as(F.lit(2.0 * EARTH_RADIUS_KM) * arc, null_as)


def euclid_deg(
    lat1: Column, long1: Column, lat2: Column, long2: Column, null_as: float | None = 0.0
) -> Column:
    """Straight-line distance in degrees, the distance feature of the model."""
    lat1, long1, lat2, long2 = map(_known, (lat1, long1, lat2, long2))
    dlat, dlong = lat1 - lat2, long1 - long2
    return _null_as(F.sqrt(dlat * dlat + dlong * dlong), null_as)
