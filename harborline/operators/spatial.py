"""Distance-bounded spatial self-join without a cross join (survey E7, C29).

Points are hashed into square lat/lon cells whose edge equals the search
radius in degrees of latitude.  Each probe point lists the cells that can hold
a partner within the radius (the adjacent latitude bands and, per band, the
longitude span the radius covers at that latitude, wrapping at +-180), the
probe rows are exploded over that list, and the two sides meet on an
*equality* of cell ids.  The exact haversine test then refines the candidates.
Work is proportional to the points times their neighbourhood, never to the
square of the point count.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import EARTH_RADIUS_KM, haversine_km

KM_PER_DEG = math.pi * EARTH_RADIUS_KM / 180.0


def pairs_within(points: DataFrame, id_col: str, lat: str, lon: str,
                 radius_km: float, precision: int = 6) -> DataFrame:
    """All ordered pairs (id_a, id_b, distance_km) of different ids with
    haversine distance <= radius_km.  ``distance_km`` is rounded to
    ``precision`` decimals (1e-6 km = 1 mm) so it is stable across math libs.
    """
    h = radius_km / KM_PER_DEG * 1.0001            # cell edge in degrees (+ margin)
    n_lon = int(math.ceil(360.0 / h))
    hav_r = math.sin(radius_km / EARTH_RADIUS_KM / 2) ** 2
    base = points.select(F.col(id_col).alias("id"), F.col(lat).cast("double").alias("lat"),
                         F.col(lon).cast("double").alias("lon"))
    cell_lat = F.floor((F.col("lat") + 90.0) / h).cast("long")
    cell_lon = F.pmod(F.floor((F.col("lon") + 180.0) / h).cast("long"), F.lit(n_lon))
    build = base.select(F.col("id").alias("id_b"), F.col("lat").alias("lat_b"),
                        F.col("lon").alias("lon_b"), cell_lat.alias("cy"), cell_lon.alias("cx"))
    # Longitude half-span (degrees) a partner can have: hav(d) >= cos(a)cos(b)hav(dlon)
    # with |lat_b| <= |lat_a| + h.
    far_lat = F.least(F.abs(F.col("lat")) + h, F.lit(90.0))
    denom = F.cos(F.radians(F.col("lat"))) * F.cos(F.radians(far_lat))
    ratio = F.when(denom > 0, F.lit(hav_r) / denom).otherwise(F.lit(2.0))
    dlon = F.when(ratio >= 1.0, F.lit(180.0)).otherwise(F.degrees(2 * F.asin(F.sqrt(ratio))))
    lo = F.floor((F.col("lon") - dlon + 180.0) / h).cast("long")
    hi = F.floor((F.col("lon") + dlon + 180.0) / h).cast("long")
    span = F.when(hi - lo + 1 >= n_lon, F.sequence(F.lit(0).cast("long"), F.lit(n_lon - 1).cast("long"))) \
        .otherwise(F.sequence(lo, hi))
    probe = (base.withColumn("cy0", cell_lat)
             .select(F.col("id").alias("id_a"), F.col("lat").alias("lat_a"), F.col("lon").alias("lon_a"),
                     F.explode(F.sequence(F.col("cy0") - 1, F.col("cy0") + 1)).alias("cy"),
                     F.array_distinct(F.transform(span, lambda c: F.pmod(c, F.lit(n_lon)))).alias("cxs"))
             .select("id_a", "lat_a", "lon_a", "cy", F.explode("cxs").alias("cx")))
    cand = probe.join(build, ["cy", "cx"])
    dist = haversine_km("lat_a", "lon_a", "lat_b", "lon_b")
    return (cand.filter((F.col("id_a") != F.col("id_b")) & (dist <= radius_km))
            .select("id_a", "id_b", F.round(dist, precision).alias("distance_km")))
