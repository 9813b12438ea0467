"""Company facts and the per-symbol reference tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import parse_compact_date, parse_number
from tallyloom.operators import facts, filters, keys, schema
from tallyloom.plans import columns

_NUMBERS = ("total_shares", "circulating_shares", "total_market_value", "circulating_market_value")


def company_info(
    raw: DataFrame,
    other_items: tuple[str, ...] = (),
    others: str | None = "other_facts",
    as_of: dt.date | None = None,
) -> DataFrame:
    """(symbol, item, value, ord) facts to one typed row per symbol.

    Items outside the map keep their own name when listed in ``other_items``; all further ones are
    in the map column ``others``. ``as_of`` stamps the day the facts were read.
    """
    wide = facts.pivot_facts(raw, [*columns.COMPANY_FACTS, *other_items], others=others)
    renamed = schema.rename(wide, columns.COMPANY_FACTS)
    typed = schema.coerce(
        renamed, {**{name: parse_number for name in _NUMBERS}, "listing_date": parse_compact_date}
    )
    return typed if as_of is None else schema.tag(typed, update_date=as_of)


def company_info_b(raw: DataFrame, as_of: dt.date) -> DataFrame:
    """Company rows of the second layout, stamped with the day they were read."""
    return schema.tag(schema.rename(raw, columns.COMPANY_B), update_date=as_of)


def share_structure(raw: DataFrame) -> DataFrame:
    return schema.rename(raw, columns.SHARE_STRUCTURE)


def index_weights(raw: DataFrame, index_code: str | None = None) -> DataFrame:
    """Index members; a table landed for one index without its code gets it from the job."""
    renamed = schema.rename(raw, columns.INDEX_WEIGHTS)
    if index_code is None:
        return renamed
    return schema.add_if_missing(renamed, "index_code", F.lit(index_code))


def valuation(
    raw: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Daily valuation, all of it or a date range, which reaches the scan."""
    return filters.landed_range(schema.rename(raw, columns.VALUATION), "date", start, end)


def indicators(
    raw: DataFrame, codes: DataFrame, start: int = 0, stop: int | None = None
) -> DataFrame:
    """Indicator rows of the listed codes, columns unchanged; of those at positions [start, stop) of
    the code list when a range is given."""
    if start or stop is not None:
        codes = keys.slice_symbols(codes, start, stop)
    return keys.restrict_symbols(raw, codes)
