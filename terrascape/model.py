"""Schemas of the tables that the operators exchange.

Rasters are tables of cells on an integer grid with a header row; vector layers are
tables of features with rings of points; drainage networks are tables of edges.
A missing cell value (nodata) is NULL, or the row is absent.
"""

from __future__ import annotations

from dataclasses import dataclass

CELLS = "raster_id string, row_i int, col_j int, v double"
HEADERS = "raster_id string, x0 double, y0 double, dx double, dy double, width int, height int, nodata double, crs string, dtype string"
TILES = "raster_id string, trow int, tcol int, data array<double>"
FEATURES = "layer string, fid bigint, rings array<array<struct<x:double,y:double>>>"
EDGES = "hybas_id bigint, next_down bigint, next_sink bigint"
MANIFEST = "idx int, offset bigint, size bigint, sha256 string"

#: Cells of a tile's side.
TILE = 256
#: Row and column offsets of the 8 neighbours, and whether the step is diagonal.
NEIGHBOURS = [(i, j, abs(i) + abs(j) == 2) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)]


@dataclass(frozen=True)
class Grid:
    """A north-up grid: corner, cell sizes (dy is negative downwards) and extent."""

    x0: float
    y0: float
    dx: float
    dy: float
    width: int
    height: int
    crs: str = ""

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        x1, y1 = self.x0 + self.dx * self.width, self.y0 + self.dy * self.height
        return min(self.x0, x1), min(self.y0, y1), max(self.x0, x1), max(self.y0, y1)


@dataclass(frozen=True)
class PickedCRS:
    """A coordinate system and why it was chosen."""

    crs: str
    rationale: str


def require(df, fields: list[str], what: str) -> None:
    """Raise if a table lacks fields; names are compared without case."""
    have = {f.lower() for f in df.columns}
    missing = sorted(f for f in fields if f.lower() not in have)
    if missing:
        raise ValueError(f"{what} lacks the fields {', '.join(missing)}")
