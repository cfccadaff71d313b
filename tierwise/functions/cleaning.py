"""Column -> Column cleaning helpers.

All are Spark built-ins, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import STATE_FIPS_CODE


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def na_float(col) -> Column:
    """P1: "NA" -> null; otherwise float; unparseable text -> null.

    "NA" is not a number, so one ``try_cast`` covers both rules and keeps
    null-on-failure under ANSI mode. Text that parses to NaN ("NaN") becomes
    null too: Spark orders NaN above every number, so it would otherwise land
    in the top risk band. The input is referenced once, which keeps the
    expression small when Catalyst inlines it into pushed-down filters.
    """
    return F.nanvl(_c(col).try_cast("float"), F.lit(None).cast("float"))


# Fixed values that must equal the reference's: banded DTI text -> number.
DTI_BANDS = {
    "<20%": 20.0,
    "20%-<30%": 25.0,
    "30%-<36%": 33.0,
    "50%-60%": 55.0,
    ">60%": 60.0,
}


def decode_dti(col) -> Column:
    """Banded DTI text -> double; plain numbers go through float first."""
    c = _c(col)
    bands = F.create_map(*[F.lit(x) for kv in DTI_BANDS.items() for x in kv])
    # "NA" misses the map and fails the cast -> null
    num = F.nanvl(c.try_cast("float"), F.lit(None).cast("float")).cast("double")
    return F.coalesce(F.try_element_at(bands, c), num)


def coerce_double(col) -> Column:
    """Text -> double, bad text -> null."""
    return _c(col).try_cast("double")


def null_if_negative(col) -> Column:
    """Census sentinel values (< 0) become null."""
    c = _c(col)
    return F.when(c >= 0, c)


def nan_to_null(col) -> Column:
    """NaN -> null at sources (Spark orders NaN above every number)."""
    c = _c(col)
    return F.when(~F.isnan(c), c)


def clamp01(col) -> Column:
    """min(max(v, 0), 1); null stays null (least/greatest skip nulls)."""
    c = _c(col)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)))


def capped(col, k: float) -> Column:
    """min(x / k, 1); null stays null."""
    c = _c(col)
    return F.when(c.isNotNull(), F.least(c / F.lit(float(k)), F.lit(1.0)))


def state_code(col, default: str = "Unknown") -> Column:
    """State FIPS -> postal code, unknown -> default."""
    m = F.create_map(*[F.lit(x) for kv in STATE_FIPS_CODE.items() for x in kv])
    return F.coalesce(m[_c(col)], F.lit(default))


def first_part(col, sep: str = ",") -> Column:
    """Text before the first separator, trimmed."""
    return F.trim(F.split_part(_c(col), F.lit(sep), F.lit(1)))


def iso_now() -> Column:
    """Naive ISO timestamp text of now."""
    return F.date_format(F.localtimestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def zero_if_null(col) -> Column:
    """Null aggregate -> 0."""
    return F.coalesce(_c(col), F.lit(0))


def pad2(col) -> Column:
    return F.lpad(_c(col).cast("string"), 2, "0")


def to_day(col) -> Column:
    """Timestamp -> date for daily grouping."""
    return F.to_date(_c(col))
