"""Lambert conformal conic projection on a sphere, in closed form."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Radius of the model's sphere in metres (fixed value).
EARTH_RADIUS = 6_370_000.0


@dataclass(frozen=True)
class LambertConformal:
    """True latitudes, origin and central meridian in degrees."""

    true_lat1: float
    true_lat2: float
    origin_lat: float
    central_lon: float
    radius: float = EARTH_RADIUS

    @property
    def cone(self) -> float:
        a, b = math.radians(self.true_lat1), math.radians(self.true_lat2)
        if abs(a - b) < 1e-12:
            return math.sin(a)
        quarter = lambda p: math.tan(math.pi / 4 + p / 2)
        return math.log(math.cos(a) / math.cos(b)) / math.log(quarter(b) / quarter(a))

    @property
    def factor(self) -> float:
        a, n = math.radians(self.true_lat1), self.cone
        return math.cos(a) * math.tan(math.pi / 4 + a / 2) ** n / n

    @property
    def origin_rho(self) -> float:
        return self.radius * self.factor / math.tan(math.pi / 4 + math.radians(self.origin_lat) / 2) ** self.cone

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """x and y in metres; the pole that the cone opens to lies at infinity."""
        n = self.cone
        slope = F.pow(F.tan(math.pi / 4 + F.radians(lat) / 2), F.lit(n))
        rho = F.when(slope == 0, F.lit(float("inf"))).otherwise(F.try_divide(F.lit(self.radius * self.factor), slope))
        turn = n * F.radians(F.pmod(lon - self.central_lon + 180, F.lit(360.0)) - 180)
        return rho * F.sin(turn), self.origin_rho - rho * F.cos(turn)

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Longitude in [-180, 180) and latitude in degrees."""
        n, sign = self.cone, math.copysign(1.0, self.cone)
        down = self.origin_rho - y
        rho = sign * F.sqrt(x * x + down * down)
        turn = F.atan2(sign * x, sign * down)
        lat = F.degrees(2 * F.atan(F.pow(self.radius * self.factor / rho, F.lit(1 / n))) - math.pi / 2)
        return F.pmod(F.degrees(turn / n) + self.central_lon + 180, F.lit(360.0)) - 180, lat


def project(df: DataFrame, crs: LambertConformal) -> DataFrame:
    """Adds x and y of longitude and latitude."""
    x, y = crs.forward(F.col("longitude"), F.col("latitude"))
    return df.withColumns({"x": x, "y": y})
