"""Column functions: identifiers, codes, dates, geography, volumes, text."""

from .codes import basin_of, county_of_fips, county_of_label, county_of_path, well_status, well_type
from .identifiers import api_from_parts, normalize_api, tx_api
from .values import first_of_month, number, parsed_date, present, volume

__all__ = [
    "api_from_parts", "basin_of", "county_of_fips", "county_of_label", "county_of_path", "first_of_month", "normalize_api", "number",
    "parsed_date", "present", "tx_api", "volume", "well_status", "well_type",
]
