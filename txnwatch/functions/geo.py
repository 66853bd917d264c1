"""Great-circle distance as a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnwatch.config import EARTH_RADIUS_KM


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str,
                  radius_km: float = EARTH_RADIUS_KM) -> str:
    """SQL text of :func:`haversine_km` over column names (same evaluation order)."""
    p1, p2 = f"radians({lat1})", f"radians({lat2})"
    s_phi = f"sin(({p2} - {p1}) / 2)"
    s_lmb = f"sin((radians({lon2}) - radians({lon1})) / 2)"
    a = f"{s_phi} * {s_phi} + cos({p1}) * cos({p2}) * {s_lmb} * {s_lmb}"
    return f"({float(2 * radius_km)!r}D * asin(least(1.0D, sqrt({a}))))"


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Haversine distance in km.

    ``asin(least(1, sqrt(a)))`` keeps identical or near-identical points at
    0 km: the law-of-cosines form can round its ``acos`` argument above 1 and
    yield NaN, which Spark orders above every number.
    """
    if all(isinstance(x, str) for x in (lat1, lon1, lat2, lon2)):
        def q(name: str) -> str:   # "b.latitude" -> `b`.`latitude`
            return ".".join(f"`{part}`" for part in name.split("."))
        return F.expr(haversine_sql(q(lat1), q(lon1), q(lat2), q(lon2), radius_km))
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dlmb = F.radians(_c(lon2)) - F.radians(_c(lon1))
    s_phi = F.sin(dphi / 2)
    s_lmb = F.sin(dlmb / 2)
    a = s_phi * s_phi + F.cos(p1) * F.cos(p2) * s_lmb * s_lmb
    return F.lit(2 * radius_km) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))
