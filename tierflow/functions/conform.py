"""Typing and standardisation of staged text: casts, code maps, flags, tiers.

All functions return Column expressions, so they stay inside whole-stage
codegen; lookups are JVM map literals or IN-sets, never Python UDFs.

Cast rules (numbers go through decimal, as the source warehouse does):
``'12.5'`` to an integer rounds half up to 13; strict casts raise on bad
text (ANSI mode), ``try_`` casts give NULL.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Location standardisation rules. These must equal the
# source rules for identical results; kept in their original order.
# ---------------------------------------------------------------------------
CITY_STATE_RENAMES = {"Delhi": "New Delhi"}

STATE_CODES = [
    ("Delhi", "DL"),
    ("New Delhi", "DL"),
    ("Maharashtra", "MH"),
    ("Uttar Pradesh", "UP"),
    ("Gujarat", "GJ"),
    ("Rajasthan", "RJ"),
    ("Kerala", "KL"),
    ("Punjab", "PB"),
    ("Karnataka", "KA"),
    ("Madhya Pradesh", "MP"),
    ("Odisha", "OR"),
    ("Chandigarh", "CH"),
    ("West Bengal", "WB"),
    ("Sikkim", "SK"),
    ("Andhra Pradesh", "AP"),
    ("Assam", "AS"),
    ("Jammu and Kashmir", "JK"),
    ("Puducherry", "PY"),
    ("Uttarakhand", "UK"),
    ("Himachal Pradesh", "HP"),
    ("Tamil Nadu", "TN"),
    ("Goa", "GA"),
    ("Telangana", "TG"),
    ("Chhattisgarh", "CG"),
    ("Jharkhand", "JH"),
    ("Bihar", "BR"),
]

UNION_TERRITORIES = [
    "Delhi", "New Delhi", "Chandigarh", "Puducherry", "Jammu and Kashmir",
    "Lakshadweep", "Ladakh", "Dadra and Nagar Haveli and Daman and Diu",
]

CAPITAL_CITIES = [  # (state, city)
    ("New Delhi", "New Delhi"),
    ("Maharashtra", "Mumbai"),
    ("Madhya Pradesh", "Bhopal"),
    ("Karnataka", "Bangalore"),
    ("Goa", "Panaji"),
    ("Telangana", "Hyderabad"),
    ("Rajasthan", "Jaipur"),
    ("Tamil Nadu", "Chennai"),
]

TIER_1_CITIES = [
    "Mumbai", "Delhi", "New Delhi", "Bengaluru", "Hyderabad", "Chennai", "Kolkata",
    "Pune", "Ahmedabad",
]
TIER_2_CITIES = [
    "Jaipur", "Lucknow", "Kanpur", "Nagpur", "Indore", "Bhopal", "Patna", "Vadodara",
    "Coimbatore", "Ludhiana", "Agra", "Nashik", "Ranchi", "Meerut", "Raipur", "Guwahati",
    "Chandigarh",
]
CITY_TIERS = [("Tier-1", TIER_1_CITIES), ("Tier-2", TIER_2_CITIES)]
DEFAULT_TIER = "Tier-3"

# Date/time formats of the source, in Spark pattern syntax.
FMT_DATE = "yyyy-MM-dd"                              # YYYY-MM-DD
FMT_TS = "yyyy-MM-dd HH:mm:ss"                       # YYYY-MM-DD HH24:MI:SS
FMT_ISO_FF6 = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"         # YYYY-MM-DD"T"HH24:MI:SS.FF6
FMT_ISO = "yyyy-MM-dd'T'HH:mm:ss"                    # YYYY-MM-DD"T"HH24:MI:SS
FMT_TS_FF9 = "yyyy-MM-dd HH:mm:ss.SSSSSSSSS"         # YYYY-MM-DD HH24:MI:SS.FF9


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ------------------------------------------------------------------ values

def standardise(col, renames: dict[str, str] = CITY_STATE_RENAMES) -> Column:
    """Replace listed values, keep all others (``CASE WHEN x='Delhi' ...``)."""
    c = _c(col)
    out = c
    for old, new in reversed(list(renames.items())):
        out = F.when(c == F.lit(old), F.lit(new)).otherwise(out)
    return out


def map_codes(col, pairs=STATE_CODES) -> Column:
    """Look a value up in a fixed code table; unknown or NULL -> NULL.

    A JVM map literal: one hash lookup per row, whatever the table size.
    """
    lookup = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in pairs))
    return F.when(_c(col).isNotNull(), lookup[_c(col)])


def flag_in(col, values, yes="Y", no="N") -> Column:
    """``CASE WHEN x IN (...) THEN yes ELSE no``; NULL input gives ``no``."""
    return F.when(_c(col).isin(list(values)), F.lit(yes)).otherwise(F.lit(no))


def pair_flag(first, second, pairs) -> Column:
    """True when (first, second) equals one of the pairs; else False (NULL too)."""
    a, b = _c(first), _c(second)
    cond = None
    for x, y in pairs:
        term = (a == F.lit(x)) & (b == F.lit(y))
        cond = term if cond is None else cond | term
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def classify(col, tiers=CITY_TIERS, default=DEFAULT_TIER) -> Column:
    """First tier whose list holds the value, else ``default``."""
    c = _c(col)
    out = F.lit(default)
    for label, values in reversed(tiers):
        out = F.when(c.isin(list(values)), F.lit(label)).otherwise(out)
    return out


def text_to_bool(col) -> Column:
    """'true'/'false' in any case -> boolean; anything else -> NULL."""
    low = F.lower(_c(col))
    return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))


def yn_to_bool(col) -> Column:
    """Implicit text->boolean of the source: 'Y'/'N', 'true'/'false', ..."""
    return _c(col).cast("boolean")


# ------------------------------------------------------------------ casts

def to_integer(col, strict: bool = True) -> Column:
    """Text -> BIGINT through DECIMAL(38,0): '12.5' -> 13 (half up).

    strict: bad text raises (ANSI cast); otherwise NULL.
    """
    c = _c(col)
    if strict:
        return c.cast("decimal(38,0)").cast("bigint")
    return c.try_cast("decimal(38,0)").try_cast("bigint")


def to_decimal(col, precision: int, scale: int, strict: bool = False) -> Column:
    """Text -> DECIMAL(p,s), half-up rounding; overflow or junk -> NULL (try)."""
    c = _c(col)
    t = f"decimal({precision},{scale})"
    return c.cast(t) if strict else c.try_cast(t)


def to_text(col) -> Column:
    return _c(col).cast("string")


def to_date(col, fmt: str = FMT_DATE, strict: bool = False) -> Column:
    c = _c(col)
    return F.to_date(c, fmt) if strict else F.try_to_date(c, fmt)


def to_timestamp(col, fmt: str = FMT_TS, strict: bool = False, ntz: bool = False) -> Column:
    """Parse text with a pattern; ``ntz`` gives TIMESTAMP_NTZ, else session-zone TIMESTAMP.

    Fractions beyond microseconds are truncated (Spark keeps microseconds).
    """
    c = _c(col)
    if strict:
        out = F.to_timestamp(c, fmt)
    else:
        out = F.try_to_timestamp(c, F.lit(fmt))
    return out.cast("timestamp_ntz") if ntz else out


def try_timestamp_ntz(col) -> Column:
    """``TRY_CAST(x AS TIMESTAMP_NTZ)`` with the default ISO-like parser."""
    return _c(col).try_cast("timestamp_ntz")


def trimmed(col) -> Column:
    return F.trim(_c(col))


# ------------------------------------------------------------------ location

def location_columns(raw_city="city", raw_state="state") -> dict[str, Column]:
    """Derived location columns. Rules read the *raw* city/state, as the
    source does (its predicates see the source column, not the alias)."""
    city, state = _c(raw_city), _c(raw_state)
    return {
        "city": standardise(city),
        "state": standardise(state),
        "state_code": map_codes(state),
        "is_union_territory": yn_to_bool(flag_in(state, UNION_TERRITORIES)),
        "capital_city_flag": pair_flag(state, city, CAPITAL_CITIES),
        "city_tier": classify(city),
    }
