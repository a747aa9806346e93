"""Star schema over the visit KPI table: one fact and four dimensions.

Dimensions are keyed by their natural values, with NULL as a member.  Three things to
know when querying them: the fact keeps ``date`` as raw text while the date dimension
has a real date; a visitor has one row per engagement type; the fact holds no page.
"""

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import contract
from footfall.functions.dates import date_parts, parse_day
from footfall.operators.profile import table_counts
from footfall.operators.rows import union_lots
from footfall.scratch import write_aside
from footfall.sources.tables import append_table, export_table, read_table, write_table


def visit_facts(kpi: DataFrame) -> DataFrame:
    """One fact row per KPI row."""
    return kpi.select(contract.FACT_COLUMNS)


def date_dimension(kpi: DataFrame) -> DataFrame:
    """One row per distinct raw date, so each unreadable date is an all-NULL row."""
    days = kpi.select("date").distinct().select(parse_day(F.col("date")).alias("date"))
    return days.select("date", *date_parts(F.col("date")))


def visitor_dimension(kpi: DataFrame) -> DataFrame:
    return kpi.select("fullVisitorId", "socialEngagementType").distinct()


def channel_dimension(kpi: DataFrame) -> DataFrame:
    return kpi.select("channelGrouping").distinct()


def page_dimension(kpi: DataFrame) -> DataFrame:
    return kpi.select(
        F.col("pagePath").alias("url_pagina"),
        F.col("referer").alias("pagina_referida"),
        "isInteraction",
    ).distinct()


@dataclass(frozen=True)
class StarTables:
    """Catalog names of the star schema."""

    unified: str = contract.UNIFIED_TABLE
    fact: str = contract.FACT_TABLE
    date: str = contract.DATE_TABLE
    visitor: str = contract.VISITOR_TABLE
    channel: str = contract.CHANNEL_TABLE
    page: str = contract.PAGE_TABLE

    @classmethod
    def in_database(cls, database: str) -> "StarTables":
        return cls(*(f"{database}.{field.default}" for field in fields(cls)))

    def all(self) -> list[str]:
        return [getattr(self, field.name) for field in fields(self)]


def _members(tables: StarTables) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """The dimensions whose members are their rows; days are not, see :func:`date_dimension`."""
    return {tables.visitor: visitor_dimension, tables.channel: channel_dimension, tables.page: page_dimension}


def build_star(
    spark: SparkSession,
    lots: list[str] = contract.LOT_TABLES,
    tables: StarTables = StarTables(),
    export_to: str | None = None,
    single_file: tuple[str, ...] = (contract.DATE_TABLE, contract.CHANNEL_TABLE),
) -> DataFrame:
    """Union the lot tables, write all star tables, and return their row counts.

    Everything after the unified table is read back from tables: each one is computed
    once, and exports and counts only read files.  With ``export_to`` the fact and the
    dimensions are also written as Parquet folders.  Those named in ``single_file`` become one
    file each, through one task: by default the days and the channels, of which there are few
    whatever the number of visits.
    """
    write_table(union_lots(*(read_table(spark, lot) for lot in lots)), tables.unified)
    kpi = read_table(spark, tables.unified)
    derived = {tables.fact: visit_facts(kpi), tables.date: date_dimension(kpi)}
    derived |= {name: of(kpi) for name, of in _members(tables).items()}

    def store(name: str) -> None:
        write_table(derived[name], name)
        if export_to:
            short = name.split(".")[-1]
            export_table(spark, name, f"{export_to.rstrip('/')}/{short}", short in single_file)

    _together(spark, store, derived)
    return _counts(spark, tables)


def extend_star(spark: SparkSession, lots: list[str], tables: StarTables = StarTables()) -> DataFrame:
    """Add the rows of new lot tables to a star that :func:`build_star` made; returns its row counts.

    The star is then the same as one built anew over all lots, but only the new ones are read: they
    are appended to the unified table and the fact, and an anti-join finds the members that a
    dimension lacks.  A date is a member by its raw text, which the dimension does not keep, so
    unreadable dates are looked up among those of the fact; that reads one column, and only where
    the new lots have such dates.

    A lot has to be added once.  The unified table is written last, so after a failure it has fewer
    rows than the fact; that raises ``ValueError``, and the star has to be built anew.
    """
    rows, done = (read_table(spark, name).count() for name in (tables.fact, tables.unified))
    if rows != done:
        raise ValueError(f"{tables.fact} has {rows} rows, {tables.unified} {done}: build the star anew")
    new = write_aside(union_lots(*(read_table(spark, lot) for lot in lots)), "lots")
    lacking = {name: _lacking(of(new), read_table(spark, name)) for name, of in _members(tables).items()}
    lacking[tables.date] = _new_days(new, read_table(spark, tables.date), read_table(spark, tables.fact))

    def store(name: str) -> None:
        # written aside first, as a table cannot be read and appended to at once
        append_table(write_aside(lacking[name], "members"), name)

    _together(spark, store, lacking)
    append_table(visit_facts(new), tables.fact)
    append_table(new, tables.unified)
    return _counts(spark, tables)


def _lacking(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows that are not known, NULL being a value like others."""
    same = reduce(Column.__and__, (rows[name].eqNullSafe(known[name]) for name in rows.columns))
    return rows.join(known, same, "left_anti")


def _new_days(new: DataFrame, days: DataFrame, fact: DataFrame) -> DataFrame:
    """What the date dimension lacks: days it has not, and a row for each new unreadable text."""
    unreadable = new.where(parse_day(F.col("date")).isNull()).select("date")
    unseen = _lacking(unreadable.distinct(), fact.where(parse_day(F.col("date")).isNull()).select("date"))
    readable = date_dimension(new.where(parse_day(F.col("date")).isNotNull()))
    return union_lots(_lacking(readable, days), date_dimension(unseen))


def _together(spark: SparkSession, store: Callable[[str], None], names: Iterable[str]) -> None:
    """Run jobs of their own threads, which share the cluster: small dimensions need not wait for the
    fact.  The threads keep the caller's job group and scheduler pool."""
    names = list(names)
    with ThreadPoolExecutor(len(names)) as threads:
        list(threads.map(inheritable_thread_target(spark)(store), names))


def _counts(spark: SparkSession, tables: StarTables) -> DataFrame:
    return table_counts({name.split(".")[-1]: read_table(spark, name) for name in tables.all()})
