"""Daily calendars over sparse events.

Events are rows of (symbol, date, amount). Between two neighbouring events nothing changes except
on the day an event leaves the rolling span and on the first day of a year. The totals are
therefore worked out at those change days only, and each change day is then spread over the days
up to the next one: the windows see a few rows per event and the calendar is produced by the last
step of the job, with nothing sorted or shuffled after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tallyloom.operators.schema import present


def known_events(events: DataFrame) -> DataFrame:
    """Events with a symbol and a date; the time of day is dropped."""
    return events.filter(F.col("symbol").isNotNull() & F.col("date").isNotNull()).withColumn(
        "date", F.col("date").cast("date")
    )


def symbol_span(events: DataFrame) -> DataFrame:
    """First and last date per symbol, of events with both."""
    return known_events(events).groupBy("symbol").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


#: A span of days is cut into pieces of so many, and a task gets pieces of so many days in all. Where that would make more
#: than so many tasks a core, tasks get up to so many times as many days: a sink pays for each task and file.
PIECE_DAYS = 256
DAYS_PER_TASK = 1 << 18
TASKS_PER_CORE = 4
LARGER_TASKS = 8


def _days(first: str, last: str) -> str:
    """Number of days from ``first`` to ``last``, both included, as SQL text."""
    return f"cast(greatest(datediff({last}, {first}) + 1, 0) as long)"


def _written_with_days(df: DataFrame, first: str, last: str) -> tuple[DataFrame, int]:
    """The rows, written to the shared scratch folder, and their days in all, added up while writing."""
    from tallyloom.sources.scratch import scratch_path  # the sources import operators

    path = scratch_path(df.sparkSession, "calendar")
    observed = Observation()
    df.observe(observed, F.expr(f"sum({_days(first, last)})").alias("days")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), observed.get["days"] or 0


def _each_day(df: DataFrame, first: str, last: str, days: int) -> DataFrame:
    """A row for each day from ``first`` to ``last``, its distance to the first in ``offset``.

    Rows are cut into pieces of at most ``PIECE_DAYS`` days and the pieces dealt evenly over tasks, as many as ``days`` in
    all need (fewer and larger ones for a long calendar); then each task multiplies its own. The tasks follow the size of the calendar, whatever
    the number of shuffle partitions, and the days of one row may lie in several tasks.
    Offsets are whole numbers: a sequence of dates would step through timestamps.
    """
    enough = TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(-(-days // DAYS_PER_TASK), max(enough, -(-days // (LARGER_TASKS * DAYS_PER_TASK)))))
    cut = df.selectExpr("*", f"explode(if({first} <= {last}, sequence(0, datediff({last}, {first}), {PIECE_DAYS}), null)) as piece")
    stop = f"least(piece + {PIECE_DAYS - 1}, datediff({last}, {first}))"
    return cut.repartition(tasks).selectExpr("*", f"explode(sequence(piece, {stop})) as offset").drop("piece")


def dense_calendar(span: DataFrame) -> DataFrame:
    """One row per symbol and day from first_date to last_date."""
    spans, days = _written_with_days(span.select("symbol", "first_date", "last_date"), "first_date", "last_date")
    return _each_day(spans, "first_date", "last_date", days).selectExpr(
        "symbol", "date_add(first_date, offset) as date"
    )


def yearly_total(events: DataFrame, amount: str = "dividend") -> DataFrame:
    """Total per symbol and year; NaN is missing."""
    known = known_events(events)
    return known.groupBy("symbol", F.year("date").alias("year")).agg(
        F.sum(present(known, amount)).alias("total")
    )


def prior_year_total(totals: DataFrame) -> DataFrame:
    """Yearly totals with the total of the year before, 0 when that year has none."""
    year_before = Window.partitionBy("symbol").orderBy("year").rangeBetween(-1, -1)
    before = F.sum("total").over(year_before)
    return totals.withColumn(
        "last_year_total", F.coalesce(before, F.lit(0).cast(totals.schema["total"].dataType))
    )


def _leaving_day(day: str, months: int) -> str:
    """First day whose date ``months`` months earlier is after ``day``, as SQL text.

    Going back from a long month to a short one stops at the short month's last day, so an event
    on the last day of a month stays until the whole target month is over.
    """
    ahead = f"add_months({day}, {months})"
    return f"date_add(if({day} = last_day({day}), last_day({ahead}), {ahead}), 1)"


def _change_days(daily: DataFrame, months: int) -> DataFrame:
    """(symbol, date, amount, n_events) at events, at leaving days and at new years in between."""
    leaving = "if(leaving <= last, array(leaving), array())"
    new_years = (
        "if(year(following) > year(date),"
        " transform(sequence(year(date) + 1, year(following)), y -> make_date(y, 1, 1)), array())"
    )
    return (
        daily.selectExpr(
            "*",
            "lead(date) over (partition by symbol order by date) as following",
            "max(date) over (partition by symbol) as last",
            f"{_leaving_day('date', months)} as leaving",
        )
        .selectExpr("*", f"explode(concat(array(date), {leaving}, {new_years})) as change")
        .groupBy("symbol", "change")
        .agg(
            F.expr("sum(if(change = date, amount, null)) as amount"),
            F.expr("sum(if(change = date, n_events, 0)) as n_events"),
        )
        .withColumnRenamed("change", "date")
    )


def _totals(changes: DataFrame, names: DataFrame, months: int) -> DataFrame:
    """What holds from each change day until the next: the day's own sum and the three totals."""
    return (
        changes.selectExpr("*", "year(date) as year")
        .selectExpr(
            "*",
            "lead(date) over (partition by symbol order by date) as next_change",
            "sum(amount) over (partition by symbol order by date"
            f" range between interval '{months}' month preceding and current row) as rolling",
            "sum(amount) over (partition by symbol, year order by date) as to_date",
            "sum(amount) over (partition by symbol order by year"
            " range between 1 preceding and 1 preceding) as before",
        )
        .join(names, "symbol", "left")
        .selectExpr("*", "coalesce(copies, 1) as times")
        .selectExpr(
            "symbol",
            "stock_name",
            "year",
            "times",
            "n_events * times as n_rows",
            "date as change",
            "coalesce(date_sub(next_change, 1), date) as until",
            "coalesce(cast(amount as double), 0D) as amount",
            "coalesce(cast(before as double) * times, 0D) as last_year_total_dividend",
            "coalesce(cast(to_date as double) * times, 0D) as current_year_total_dividend",
            "coalesce(cast(rolling as double) * times, 0D) as rolling_12m_dividend",
        )
    )


_CALENDAR = ("date", "symbol", "stock_name", "dividend", "year")
_TOTALS = ("last_year_total_dividend", "current_year_total_dividend", "rolling_12m_dividend")


def change_totals(
    events: DataFrame, dimension: DataFrame, amount: str = "dividend", months: int = 11
) -> DataFrame:
    """What holds from each change day of a symbol on: its day's own sum and the three totals."""
    paid = known_events(events).select("symbol", "date", present(events, amount).alias("paid"))
    daily = paid.groupBy("symbol", "date").agg(
        F.expr("sum(paid) as amount"), F.expr("count(1) as n_events")
    )
    names = dimension.groupBy("symbol").agg(
        F.expr("min(stock_name) as stock_name"), F.expr("count(1) as copies")
    )
    return _totals(_change_days(daily, months), names, months)


def event_calendar(
    events: DataFrame, dimension: DataFrame, amount: str = "dividend", months: int = 11
) -> DataFrame:
    """Daily calendar per symbol with prior-year, year-to-date and rolling totals.

    ``events`` holds symbol, date and the amount; ``dimension`` holds symbol and stock_name. The
    calendar runs from the first to the last event of a symbol. A day with several events gives a
    row for each, and a symbol listed several times in the dimension counts its events as often.
    The rolling span goes ``months`` months back, both ends included.

    Events are summed per (symbol, date) on the map side before anything is shuffled, so a symbol
    with very many events arrives as at most one row per day. What holds from each change day is
    worked out once and written to the shared scratch folder; days with several events then take
    their own amounts from the events of those days.
    """
    totals, days = _written_with_days(change_totals(events, dimension, amount, months), "change", "until")
    events = known_events(events).select("symbol", "date", present(events, amount).alias("paid"))

    kept = ("symbol", "stock_name", "year", *_TOTALS)
    periods = totals.selectExpr(
        *kept,
        "until",
        "if(n_rows > 1, date_add(change, 1), change) as first",
        "if(n_rows > 1, 0D, amount) as own",
    )
    spread = _each_day(periods, "first", "until", days).selectExpr(
        *kept, "date_add(first, offset) as date", "if(offset = 0, own, 0D) as dividend"
    )
    crowded = (
        events.join(
            totals.filter("n_rows > 1").withColumnRenamed("change", "date"), ["symbol", "date"]
        )
        .selectExpr("*", "explode(sequence(1L, times)) as copy")
        .selectExpr(*kept, "date", "coalesce(cast(paid as double), 0D) as dividend")
    )
    return spread.unionByName(crowded).select(*_CALENDAR, *_TOTALS)
