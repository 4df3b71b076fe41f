"""API well numbers, as ``NN-NNN-NNNNN``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STATE_CODE = {"TX": "42", "NM": "30", "OK": "35"}
API_PATTERN = r"^\d{2}-\d{3}-\d{5}$"


def _split(ten: Column) -> Column:
    return F.concat_ws("-", F.substring(ten, 1, 2), F.substring(ten, 3, 3), F.substring(ten, 6, 5))


def normalize_api(value: Column, state: str) -> Column:
    """Ten digits as they are, eight behind the state's code, everything else NULL.

    New Mexico drops blanks and dashes only, Oklahoma a decimal tail and every non-digit, Texas every non-digit and
    takes ten digits only with its own code.
    """
    text = F.trim(value.cast("string"))
    if state == "NM":
        digits = F.regexp_replace(text, r"[\s-]", "")
    elif state == "OK":
        digits = F.regexp_replace(F.regexp_replace(text, r"\.0+$", ""), r"\D", "")
    else:
        digits = F.regexp_replace(text, r"\D", "")
    code = STATE_CODE[state]
    ten = digits.rlike(r"^\d{10}$") if state != "TX" else digits.rlike(rf"^{code}\d{{8}}$")
    return F.when(ten, _split(digits)).when(digits.rlike(r"^\d{8}$"), _split(F.concat(F.lit(code), digits)))


def api_from_parts(state: Column, county: Column, well: Column, longer: bool = False) -> Column:
    """From numeric parts of any type; NULL where one is missing, no number or too long. With ``longer``, wells beyond five digits stay whole."""
    parts = [F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint")) for c in (x.cast("string") for x in (state, county, well))]
    fits = parts[0].between(0, 99) & parts[1].between(0, 999) & (parts[2] >= 0 if longer else parts[2].between(0, 99999))
    return F.when(fits, F.format_string("%02d-%03d-%05d", *parts))


def padded(value: Column, width: int) -> Column:
    """Zero-filled on the left; longer values stay whole."""
    return F.when(F.length(value) >= width, value).otherwise(F.lpad(value, width, "0"))


def tx_api(county_code: Column, unique_no: Column) -> Column:
    """Texas numbers from county code and unique number; NULL where one is blank."""
    c, u = F.trim(county_code), F.trim(unique_no)
    return F.when((c != "") & (u != ""), F.concat(F.lit("42-"), padded(c, 3), F.lit("-"), padded(u, 5)))
