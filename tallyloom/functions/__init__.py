"""Column expressions: codes, dates, numbers."""

from tallyloom.functions.codes import first_digits, full_symbol, strip_exchange, strip_to_suffix
from tallyloom.functions.dates import (
    date_text,
    day_quarter,
    day_year,
    label_quarter,
    label_year,
    month_text_to_date,
    parse_compact_date,
    parse_date,
    quarter_end,
)
from tallyloom.functions.numbers import nan_to_null, parse_number

__all__ = [
    "date_text",
    "day_quarter",
    "day_year",
    "first_digits",
    "full_symbol",
    "label_quarter",
    "label_year",
    "month_text_to_date",
    "nan_to_null",
    "parse_compact_date",
    "parse_date",
    "parse_number",
    "quarter_end",
    "strip_exchange",
    "strip_to_suffix",
]
