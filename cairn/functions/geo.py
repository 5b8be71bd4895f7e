"""Geodesy as Column expressions: great-circle distance, Albers and UTM.

The projection constants are derived from the published ellipsoid and projection
parameters; the formulas are the textbook ellipsoidal ones, so every transform is
one expression inside whole-stage codegen.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.dims import EARTH_RADIUS_KM

# --- fixed values: GRS80 ellipsoid -------------------------------------------
GRS80_A = 6378137.0
GRS80_F = 1.0 / 298.257222101


def haversine_km(lat0: Column, lon0: Column, lat1: Column, lon1: Column) -> Column:
    dlat = (F.radians(lat1) - F.radians(lat0)) / 2
    dlon = (F.radians(lon1) - F.radians(lon0)) / 2
    a = F.pow(F.sin(dlat), F.lit(2.0)) + F.cos(F.radians(lat0)) * F.cos(
        F.radians(lat1)
    ) * F.pow(F.sin(dlon), F.lit(2.0))
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))))


@dataclass(frozen=True)
class Albers:
    """Ellipsoidal Albers equal-area conic; defaults are the Alaska parameters."""

    lat_0: float = 50.0
    lon_0: float = -154.0
    lat_1: float = 55.0
    lat_2: float = 65.0
    a: float = GRS80_A
    f: float = GRS80_F

    @property
    def e(self) -> float:
        return math.sqrt(self.f * (2 - self.f))

    def _q(self, phi: float) -> float:
        e, s = self.e, math.sin(phi)
        return (1 - e * e) * (
            s / (1 - e * e * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e)
        )

    def _m(self, phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - (self.e * math.sin(phi)) ** 2)

    @property
    def constants(self) -> dict[str, float]:
        """n, C, rho_0 and q at the pole."""
        p1, p2 = math.radians(self.lat_1), math.radians(self.lat_2)
        m1, m2, q1, q2 = self._m(p1), self._m(p2), self._q(p1), self._q(p2)
        n = (m1 * m1 - m2 * m2) / (q2 - q1)
        c = m1 * m1 + n * q1
        rho0 = self.a * math.sqrt(c - n * self._q(math.radians(self.lat_0))) / n
        return {"n": n, "c": c, "rho0": rho0, "qp": self._q(math.pi / 2)}

    @property
    def series(self) -> tuple[float, float, float]:
        """Coefficients of the authalic-to-geodetic latitude series."""
        e2 = self.e**2
        e4, e6 = e2 * e2, e2**3
        return (
            e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040,
            23 * e4 / 360 + 251 * e6 / 3780,
            761 * e6 / 45360,
        )

    def forward_point(self, lon: float, lat: float) -> tuple[float, float]:
        """One point on the driver (grid corners and other parameters)."""
        k = self.constants
        rho = self.a * math.sqrt(k["c"] - k["n"] * self._q(math.radians(lat))) / k["n"]
        theta = k["n"] * math.radians(lon - self.lon_0)
        return rho * math.sin(theta), k["rho0"] - rho * math.cos(theta)

    def inverse_point(self, x: float, y: float) -> tuple[float, float]:
        k, (s2, s4, s6) = self.constants, self.series
        rho = math.hypot(x, k["rho0"] - y)
        theta = math.atan2(x, k["rho0"] - y)
        q = (k["c"] - (rho * k["n"] / self.a) ** 2) / k["n"]
        b = math.asin(max(-1.0, min(1.0, q / k["qp"])))
        phi = b + s2 * math.sin(2 * b) + s4 * math.sin(4 * b) + s6 * math.sin(6 * b)
        slope = 2 * (1 - self.e**2) * math.cos(phi) / (1 - (self.e * math.sin(phi)) ** 2) ** 2
        phi += (q - self._q(phi)) / slope if slope else 0.0
        return self.lon_0 + math.degrees(theta / k["n"]), math.degrees(phi)

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """Geographic degrees to projected metres."""
        k, e = self.constants, self.e
        s = F.sin(F.radians(lat))
        q = (1 - e * e) * (
            s / (1 - e * e * s * s) - F.ln((1 - e * s) / (1 + e * s)) / (2 * e)
        )
        rho = F.sqrt(k["c"] - k["n"] * q) * (self.a / k["n"])
        theta = F.radians(lon - self.lon_0) * k["n"]
        return rho * F.sin(theta), F.lit(k["rho0"]) - rho * F.cos(theta)

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Projected metres to geographic (lon, lat) degrees.

        The series is good to a millimetre; one Newton step takes it to rounding.
        """
        k, e, (s2, s4, s6) = self.constants, self.e, self.series
        dy = F.lit(k["rho0"]) - y
        rho = F.sqrt(x * x + dy * dy)
        theta = F.atan2(x, dy)
        t = rho * (k["n"] / self.a)
        q = (k["c"] - t * t) / k["n"]
        b = F.asin(F.least(F.greatest(q / k["qp"], F.lit(-1.0)), F.lit(1.0)))
        phi = b + s2 * F.sin(2 * b) + s4 * F.sin(4 * b) + s6 * F.sin(6 * b)
        s = F.sin(phi)
        es = s * e
        near = (1 - e * e) * (s / (1 - es * es) - F.ln((1 - es) / (1 + es)) / (2 * e))
        slope = F.cos(phi) * (2 * (1 - e * e)) / ((1 - es * es) * (1 - es * es))
        phi = phi + F.coalesce(F.try_divide(q - near, slope), F.lit(0.0))
        return F.degrees(theta / k["n"]) + self.lon_0, F.degrees(phi)


ALASKA_ALBERS = Albers()


@dataclass(frozen=True)
class UtmNorth:
    """Northern-hemisphere UTM inverse by the Krueger series (zone 4 by default)."""

    zone: int = 4
    a: float = GRS80_A
    f: float = GRS80_F
    k0: float = 0.9996
    false_easting: float = 500000.0

    @property
    def constants(self) -> dict[str, float]:
        n = self.f / (2 - self.f)
        return {
            "lon0": self.zone * 6.0 - 183.0,
            "radius": self.a / (1 + n) * (1 + n**2 / 4 + n**4 / 64),
            "b1": n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96,
            "b2": n**2 / 48 + n**3 / 15,
            "b3": 17 * n**3 / 480,
            "d1": 2 * n - 2 * n**2 / 3 - 2 * n**3,
            "d2": 7 * n**2 / 3 - 8 * n**3 / 5,
            "d3": 56 * n**3 / 15,
        }

    def inverse(self, easting: Column, northing: Column) -> tuple[Column, Column]:
        """Projected metres to geographic (lon, lat) degrees."""
        k = self.constants
        xi = northing / (self.k0 * k["radius"])
        eta = (easting - self.false_easting) / (self.k0 * k["radius"])
        xi1, eta1 = xi, eta
        for j in (1, 2, 3):
            b = k[f"b{j}"]
            xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
            eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        chi = F.asin(F.sin(xi1) / F.cosh(eta1))
        phi = chi
        for j in (1, 2, 3):
            phi = phi + k[f"d{j}"] * F.sin(2 * j * chi)
        lon = F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1))) + k["lon0"]
        return lon, F.degrees(phi)


UTM_4N = UtmNorth()
