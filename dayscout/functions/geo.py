"""Great-circle distance and the grid that turns a radius search into an equi-join."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
METRES_PER_DEGREE = math.pi * EARTH_RADIUS_M / 180.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in metres between two points given in degrees."""
    dlat = F.radians(lat2 - lat1) / 2
    dlon = F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(dlon), 2
    )
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


@dataclass(frozen=True)
class Grid:
    """Rows of latitude as high as the radius, each cut into its own number of columns, so
    that a cell is about as wide as it is high at any latitude, the poles included.

    ``neighbourhood`` is exact: a circle spans three rows, and in each of them the columns
    that its widest extent in longitude touches; around a pole that is all of them, which
    are few there. Longitudes wrap at the date line.
    """

    height: float

    @classmethod
    def for_radius(cls, radius_m: float) -> Grid:
        if radius_m <= 0:
            raise ValueError("radius must be positive")
        return cls(radius_m / METRES_PER_DEGREE * 1.001)

    def _row(self, lat: Column) -> Column:
        return F.floor((lat + 90) / self.height)

    def _columns(self, row: Column) -> Column:
        """Columns of a row, by its edge next to the equator."""
        low, high = row * self.height - 90, (row + 1) * self.height - 90
        edge = F.when((low <= 0) & (high >= 0), 0.0).otherwise(F.least(F.abs(low), F.abs(high)))
        across = 360 * F.cos(F.radians(F.least(edge, F.lit(90.0)))) / self.height
        return F.greatest(F.lit(1), F.floor(across)).cast("long")

    def _struct(self, row: Column, col: Column) -> Column:
        return F.struct(row.cast("long").alias("row"), col.cast("long").alias("col"))

    def cell(self, lat: Column, lon: Column) -> Column:
        row = self._row(lat)
        n = self._columns(row)
        col = F.floor(F.pmod(lon + 180, F.lit(360.0)) * n / 360)
        return self._struct(row, F.least(col, n - 1))

    def _half_width(self, lat: Column) -> Column:
        """Widest extent of the circle in degrees of longitude, to either side."""
        ratio = math.sin(math.radians(min(self.height, 90.0))) / F.cos(F.radians(lat))
        wide = F.degrees(F.asin(F.least(F.lit(1.0), ratio))) * 1.001
        return F.when(F.abs(lat) + self.height < 90, wide).otherwise(180.0)

    def neighbourhood(self, lat: Column, lon: Column) -> Column:
        """Every cell that the circle around a point may touch, each once."""
        half, east = self._half_width(lat), F.pmod(lon + 180, F.lit(360.0))
        rows = []
        for step in (-1, 0, 1):
            row = self._row(lat) + step
            n = self._columns(row)
            first = F.floor((east - half) * n / 360)
            last = F.least(F.floor((east + half) * n / 360), first + n - 1)
            rows.append(F.transform(F.sequence(first, last), self._in_row(row, n)))
        return F.concat(*rows)

    def _in_row(self, row: Column, n: Column):
        return lambda col: self._struct(row, F.pmod(col, n))

    # A crowded cell is split into 2^level by 2^level parts of equal height and width.

    def part(self, lat: Column, lon: Column, cell: Column, level: Column) -> Column:
        """The part of its cell in which a point lies; ``level`` 0 has one."""
        n = self._columns(cell["row"])
        up = (lat + 90) / self.height - cell["row"]
        along = F.pmod(lon + 180, F.lit(360.0)) * n / 360 - cell["col"]
        return self._part(self._slot(up, level), self._slot(along, level))

    def parts(self, lat: Column, lon: Column, cell: Column, level: Column) -> Column:
        """Every part of a cell of the neighbourhood that the circle may touch."""
        n = self._columns(cell["row"])
        middle = (lat + 90) / self.height - cell["row"]
        half = self._half_width(lat)
        east = F.pmod(lon + 180, F.lit(360.0))
        first, last = (east - half) * n / 360, (east + half) * n / 360
        # the cell's column, counted on from the circle's first one
        turns = F.ceil((F.floor(first) - cell["col"]) / n)
        here = cell["col"] + turns * n
        around = last - first >= n - 1  # both ends may lie in one cell
        west = F.when(around, 0.0).otherwise(first - here)
        far = F.when(around, 1.0).otherwise(last - here)
        ups = F.sequence(self._slot(middle - 1, level), self._slot(middle + 1, level))
        alongs = F.sequence(self._slot(west, level), self._slot(far, level))
        return F.flatten(F.transform(ups, lambda u: F.transform(alongs, lambda a: self._part(u, a))))

    @staticmethod
    def _part(up: Column, along: Column) -> Column:
        return F.struct(up.alias("up"), along.alias("along"))

    @staticmethod
    def _slot(share: Column, level: Column) -> Column:
        sides = F.pow(F.lit(2.0), level).cast("long")
        return F.least(F.greatest(F.floor(share * sides), F.lit(0)), sides - 1)
