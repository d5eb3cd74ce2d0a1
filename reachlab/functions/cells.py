"""Hierarchical cells: bit algebra on hexagonal ids, and a rectangular backend that is integer arithmetic throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reachlab.functions.columns import c

# -- hexagonal ids: resolution in bits 52 to 55, digit r of 3 bits at 45 - 3 r, unused digits 7


def hex_resolution(cell) -> Column:
    return F.shiftright(c(cell), 52).bitwiseAND(F.lit(15)).cast("int")


def hex_digit(cell, r: int) -> Column:
    return F.shiftright(c(cell), 45 - 3 * r).bitwiseAND(F.lit(7)).cast("int")


def hex_parent(cell, res: int) -> Column:
    """Parent at a coarser resolution: finer digits are set to 7 and the resolution is put in."""
    unused = (1 << 3 * (15 - res)) - 1
    cleared = c(cell).bitwiseAND(F.lit(~(15 << 52)).cast("long"))
    return cleared.bitwiseOR(F.lit(res << 52).cast("long")).bitwiseOR(F.lit(unused).cast("long"))


def hex_center_child(cell, res: int) -> Column:
    """The child at a finer resolution whose further digits are 0. Needs the cell's own resolution as a column."""
    own = hex_resolution(cell)
    keep = F.shiftleft(F.lit(-1).cast("long"), 0)
    finer = F.lit(0).cast("long")
    for r in range(1, res + 1):
        finer = F.when(own < r, finer.bitwiseOR(F.lit(7 << 45 - 3 * r).cast("long"))).otherwise(finer)
    cleared = c(cell).bitwiseAND(F.lit(~(15 << 52)).cast("long")).bitwiseAND(finer.bitwiseXOR(keep))
    return cleared.bitwiseOR(F.lit(res << 52).cast("long"))


def hex_slot(cell, parent_res: int, res: int) -> Column:
    """Number of a cell among its ancestor's descendants: its digits read in base 7."""
    out = F.lit(0)
    for r in range(parent_res + 1, res + 1):
        out = out * 7 + hex_digit(cell, r)
    return out.cast("int")


def hex_children(cell, res: int) -> Column:
    """The seven children at the next resolution `res`."""
    base = c(cell).bitwiseAND(F.lit(~(15 << 52)).cast("long")).bitwiseAND(F.lit(~(7 << 45 - 3 * res)).cast("long")).bitwiseOR(F.lit(res << 52).cast("long"))
    return F.array(*[base.bitwiseOR(F.lit(d << 45 - 3 * res).cast("long")) for d in range(7)])


def hex_valid(cell) -> Column:
    """Mode 1, base cell under 122, digits under 7 up to the resolution and 7 beyond."""
    x, res = c(cell), hex_resolution(cell)
    ok = (F.shiftright(x, 59).bitwiseAND(F.lit(31)) == 1) & (F.shiftright(x, 45).bitwiseAND(F.lit(127)) < 122) & (x > 0)
    for r in range(1, 16):
        ok &= F.when(res >= r, hex_digit(cell, r) < 7).otherwise(hex_digit(cell, r) == 7)
    return ok


# -- rectangular cells: res << 52 | row << 26 | col, aperture 4, longitude wraps. Resolution r has 2^r rows and 2^(r+1) columns

_LOW = (1 << 26) - 1


def quad_pack(res, row, col) -> Column:
    return F.shiftleft(c(res).cast("long"), 52).bitwiseOR(F.shiftleft(c(row).cast("long"), 26)).bitwiseOR(c(col).cast("long"))


def quad_cell(lat, lon, res: int) -> Column:
    n = 1 << res
    row = F.least(F.greatest(F.floor((c(lat) + 90.0) * n / 180.0), F.lit(0)), F.lit(n - 1))
    col = F.pmod(F.floor((c(lon) + 180.0) * n / 180.0), F.lit(2 * n))
    return quad_pack(F.lit(res), row, col)


def quad_res(cell) -> Column:
    return F.shiftright(c(cell), 52).cast("int")


def quad_row(cell) -> Column:
    return F.shiftright(c(cell), 26).bitwiseAND(F.lit(_LOW))


def quad_col(cell) -> Column:
    return c(cell).bitwiseAND(F.lit(_LOW))


def quad_parent(cell, up: int = 1) -> Column:
    return quad_pack(quad_res(cell) - up, F.shiftright(quad_row(cell), up), F.shiftright(quad_col(cell), up))


def quad_children(cell) -> Column:
    r, y, x = quad_res(cell) + 1, quad_row(cell) * 2, quad_col(cell) * 2
    return F.array(*[quad_pack(r, y + i, x + j) for i in (0, 1) for j in (0, 1)])


def quad_slot(cell, levels: int) -> Column:
    """Number among the descendants of the ancestor `levels` up: row-major."""
    n = 1 << levels
    return (quad_row(cell) % n * n + quad_col(cell) % n).cast("int")


def quad_center(cell, res: int) -> tuple[Column, Column]:
    n = 1 << res
    return (quad_row(cell) + 0.5) * 180.0 / n - 90.0, (quad_col(cell) + 0.5) * 180.0 / n - 180.0


def quad_disk(cell, res: int, k: int, corners: bool = True) -> Column:
    """The cells within k steps, itself included; columns wrap, rows end at the poles."""
    n = 1 << res
    y, x = quad_row(cell), quad_col(cell)
    steps = [(i, j) for i in range(-k, k + 1) for j in range(-k, k + 1) if corners or abs(i) + abs(j) <= k]
    cells = F.array(*[F.when((y + i >= 0) & (y + i < n), quad_pack(F.lit(res), y + i, F.pmod(x + j, F.lit(2 * n)))) for i, j in steps])
    return F.array_distinct(F.filter(cells, lambda v: v.isNotNull()))
