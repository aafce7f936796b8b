"""Column expressions; every function takes and returns a ``Column``."""

from premia.functions.dates import date_key, date_of_key, in_year, parse_date
from premia.functions.keys import hash_key
from premia.functions.money import late_fee_rate, late_months, parse_money
from premia.functions.text import (
    USA_SPELLINGS,
    blank_to_null,
    canonical_value,
    country_name,
    id_text,
    postal_text,
    strip_space,
    title_case,
)

__all__ = [
    "USA_SPELLINGS",
    "blank_to_null",
    "canonical_value",
    "country_name",
    "date_key",
    "date_of_key",
    "hash_key",
    "id_text",
    "in_year",
    "late_fee_rate",
    "late_months",
    "parse_date",
    "parse_money",
    "postal_text",
    "strip_space",
    "title_case",
]
