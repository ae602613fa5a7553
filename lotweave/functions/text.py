"""Parcel keys, labels and text rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mark a record as something other than a parcel.
OREGON_NON_PARCEL_WORDS = "(ROAD|WATER|RAIL|NONTL|CANAL|RIVER|GAP|RR|WTR|STR|R/R)"

# Words that mark public or tribal land in Washington keys.
WASHINGTON_GENERIC_WORDS = "(ALLOTTED|ONF|TRIBAL|DNR|BLM|STATE|WNF|ONP|IS|RES)"

# State names and their abbreviations.
STATE_ABBREVIATIONS = {"oregon": "or", "washington": "wa"}

# Numbers the source database accepts as text, including radix and underscore forms.
_NUMBER = (
    r"(?i)^\s*("
    r"[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?"
    r"|[+-]?0x(_?[0-9a-f]+)+|[+-]?0o(_?[0-7]+)+|[+-]?0b(_?[01]+)+"
    r"|nan|[+-]?inf(inity)?"
    r")\s*$"
)


def clean_key(key: Column) -> Column:
    """Trimmed key, NULL when nothing is left."""
    trimmed = F.trim(key)
    return F.when(trimmed != "", trimmed)


def fallback_key(fips: Column, geohash: Column) -> Column:
    """County code and geohash; NULL when either is missing."""
    return F.concat(fips, F.lit("_"), geohash)


def pad_code(code: Column, width: int = 3) -> Column:
    """Left-pad with zeros without ever cutting a longer code."""
    text = code.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def has_word(key: Column, words: str) -> Column:
    """Case-insensitive match anywhere in the key; NULL stays NULL."""
    return key.rlike(f"(?i){words}")


def is_numeric_text(value: Column) -> Column:
    return value.rlike(_NUMBER)


def blank_or_zero(key: Column) -> Column:
    return clean_key(key).isNull() | (F.trim(key) == "0")


def thinness(area: Column, perimeter: Column) -> Column:
    """4·area/perimeter²: 0.25 for a square, near 0 for a strip, NULL without a perimeter."""
    return F.try_divide(4 * area, perimeter * perimeter)


def district_label(description: Column) -> Column:
    """Fire-district label cut to the 25 characters its column holds."""
    return F.substring(F.replace(description, F.lit("COUNTY"), F.lit("")), 1, 25)


def legal_description(section: Column, township: Column) -> Column:
    """Section and township text; missing pieces are left out."""
    return F.concat_ws("", F.lit("S"), section, F.lit(" ("), township, F.lit(")"))


def normalise_state(state: Column, to: str = "name") -> Column:
    """State name or abbreviation in the wanted form; unknown text is lower-cased."""
    if to not in ("name", "abbr"):
        raise ValueError("to must be 'name' or 'abbr'")
    lowered = F.lower(state)
    result = lowered
    for name, short in STATE_ABBREVIATIONS.items():
        source, target = (short, name) if to == "name" else (name, short)
        result = F.when(lowered == source, F.lit(target)).otherwise(result)
    return result


def normalise_state_name(state: str, to: str = "name") -> str:
    """Driver-side twin of :func:`normalise_state` for single arguments."""
    if to not in ("name", "abbr"):
        raise ValueError("to must be 'name' or 'abbr'")
    table = STATE_ABBREVIATIONS if to == "abbr" else {v: k for k, v in STATE_ABBREVIATIONS.items()}
    return table.get(state.lower(), state.lower())
