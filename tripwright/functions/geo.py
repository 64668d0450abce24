"""Points and boxes as plain structs of doubles.

A point is ``struct<x, y>`` (x = longitude, y = latitude); a box is
``struct<x0, y0, x1, y1>`` with (x0, y0) the low corner.  Spark's geospatial
types are disabled by default, and four flat doubles push down to parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The well-known-text wrapper of a point, e.g. "POINT (7.66 45.07)".
WKT_POINT_PREFIX = "POINT ("
WKT_POINT_SUFFIX = ")"
WKT_SEPARATOR = " "
NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _body(text) -> Column:
    return F.replace(F.replace(_col(text), F.lit(WKT_POINT_PREFIX), F.lit("")),
                     F.lit(WKT_POINT_SUFFIX), F.lit(""))


def _parts(body: Column) -> tuple[Column, Column]:
    return (F.split_part(body, F.lit(WKT_SEPARATOR), F.lit(1)),
            F.split_part(body, F.lit(WKT_SEPARATOR), F.lit(2)))


def point_parts(text) -> tuple[Column, Column]:
    """The x and y text of ``POINT (x y)``: strip the wrapper, split on blank."""
    return _parts(_body(text))


def _number(t: Column) -> Column:
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def _finite(value: Column) -> Column:
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def coordinate(text) -> Column:
    """Double of a plain decimal number (sign, digits, point, exponent), else
    NULL.  A cast alone would also take ``45.0d``, ``1f``, ``NaN`` or
    ``Infinity``; a number too large for a double is NULL as well."""
    return _finite(_number(_col(text)))


def _checked(t: Column, x: Column, y: Column) -> Column:
    """x, but an error where the text does not parse to two numbers."""
    bad = t.isNotNull() & (x.isNull() | y.isNull())
    return F.when(bad, F.raise_error(F.concat(F.lit("malformed point: "), t)).cast("double")).otherwise(x)


def point_xy(text, strict: bool = True) -> tuple[Column, Column]:
    """The two coordinates of ``POINT (x y)`` text as doubles (NULL for NULL
    text).  ``strict`` raises on text that does not parse to two numbers,
    whatever the session's ANSI setting."""
    t = _col(text)
    x, y = (coordinate(c) for c in point_parts(t))
    return (_checked(t, x, y) if strict else x), y


def with_points(df: DataFrame, columns: tuple[str, ...], strict: bool = True) -> DataFrame:
    """``df`` with each text column ``c`` replaced, at the end, by ``_c_null``,
    ``_c_x`` and ``_c_y``: whether the text is NULL, and its ``point_xy``.

    A projection per step: what a later step uses more than once is then
    evaluated once a row.  In one expression each use parses the text anew.
    """
    others = [c for c in df.columns if c not in columns]

    def step(rows: DataFrame, make) -> DataFrame:
        return rows.select(*others, *columns, *[new for c in columns for new in make(c)])

    def both(make):
        return lambda c: [make(F.col(f"_{c}_{a}")).alias(f"_{c}_{a}") for a in "xy"]

    rows = step(df, lambda c: [_body(c).alias(f"_{c}_body")])
    rows = step(rows, lambda c: [p.alias(f"_{c}_{a}") for p, a in zip(_parts(F.col(f"_{c}_body")), "xy")])
    rows = step(step(rows, both(_number)), both(_finite))
    out = []
    for c in columns:
        x, y = F.col(f"_{c}_x"), F.col(f"_{c}_y")
        out += [F.col(c).isNull().alias(f"_{c}_null"), (_checked(F.col(c), x, y) if strict else x).alias(f"_{c}_x"), y]
    return rows.select(*others, *out)


def point_is_valid(text) -> Column:
    """True when the text parses to two finite coordinates (lenient check)."""
    t = _col(text)
    x, y = (coordinate(c) for c in point_parts(t))
    return t.isNotNull() & x.isNotNull() & y.isNotNull()


def case_lower(a, b) -> Column:
    """``CASE WHEN a < b THEN a ELSE b END`` - NOT ``least``: with b NULL the
    result is NULL, with a NULL it is b."""
    a, b = _col(a), _col(b)
    return F.when(a < b, a).otherwise(b)


def case_upper(a, b) -> Column:
    """``CASE WHEN a > b THEN a ELSE b END`` (upper arm of the true envelope)."""
    a, b = _col(a), _col(b)
    return F.when(a > b, a).otherwise(b)


def box(x0, y0, x1, y1) -> Column:
    """Box from two corners, normalised so (x0, y0) is the low corner."""
    x0, y0, x1, y1 = (_col(c) for c in (x0, y0, x1, y1))
    return F.struct(case_lower(x0, x1).alias("x0"), case_lower(y0, y1).alias("y0"),
                    case_upper(x0, x1).alias("x1"), case_upper(y0, y1).alias("y1"))


def box_contains(box_col, x, y) -> Column:
    """Inclusive box-overlaps-point test (a point is a degenerate box)."""
    b = _col(box_col)
    x = x if isinstance(x, Column) else F.lit(float(x))
    y = y if isinstance(y, Column) else F.lit(float(y))
    return (b["x0"] <= x) & (x <= b["x1"]) & (b["y0"] <= y) & (y <= b["y1"])


# The range of longitudes and latitudes that the curve spans.
WORLD = (-180.0, -90.0, 180.0, 90.0)
CURVE_BITS = 16      # per axis
# The shifts and masks that put a zero bit after each of 16 bits.
SPREAD = [(8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)]


def _spread_bits(v: Column) -> Column:
    for shift, mask in SPREAD:
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def curve_position(x, y, extent: tuple[float, float, float, float] = WORLD) -> Column:
    """Place of a point on the Z-order curve over ``extent`` (a bigint): points
    that are near each other are mostly near each other in this order as well.
    Points outside are taken to the edge; a NULL or NaN coordinate counts as the
    low edge."""
    def cell(v, low, high):
        v = F.coalesce(F.nanvl(_col(v), F.lit(low)), F.lit(low))
        n = 1 << CURVE_BITS
        return F.greatest(F.least(F.floor((v - F.lit(low)) / F.lit(high - low) * n), F.lit(n - 1)),
                          F.lit(0)).cast("long")
    x0, y0, x1, y1 = extent
    return _spread_bits(cell(x, x0, x1)).bitwiseOR(F.shiftleft(_spread_bits(cell(y, y0, y1)), 1))
