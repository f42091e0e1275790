"""Declarative column tests: unique, not_null, accepted_values.

A test fails once per offending result row: a repeated value, a row with a
NULL, a distinct unexpected value. NULLs are ignored by the other two kinds.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnTest:
    table: str
    column: str
    kind: str
    accepted: tuple[str, ...] = ()


def unique(table: str, column: str) -> ColumnTest:
    return ColumnTest(table, column, "unique")


def not_null(table: str, column: str) -> ColumnTest:
    return ColumnTest(table, column, "not_null")


def accepted_values(table: str, column: str, values: Iterable[str]) -> ColumnTest:
    return ColumnTest(table, column, "accepted_values", tuple(values))


def violations(df: DataFrame, test: ColumnTest) -> DataFrame:
    """The offending values of one test as (value, n_rows)."""
    value = F.col(test.column)
    if test.kind == "not_null":
        bad = df.filter(value.isNull())
    elif test.kind == "accepted_values":
        bad = df.filter(value.isNotNull() & ~value.isin(list(test.accepted)))
    else:
        bad = df.filter(value.isNotNull())
    counted = bad.groupBy(value.cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter("n_rows > 1") if test.kind == "unique" else counted


def _failures(test: ColumnTest) -> Column:
    value = F.col(test.column)
    if test.kind == "not_null":
        return F.count_if(value.isNull())
    return F.count_distinct(F.when(~value.isin(list(test.accepted)), value))


def _labels(test: ColumnTest) -> list[Column]:
    return [
        F.lit(test.table).alias("table_name"),
        F.lit(test.column).alias("column_name"),
        F.lit(test.kind).alias("test"),
    ]


def _row_tests(df: DataFrame, tests: list[ColumnTest]) -> DataFrame:
    """All null and accepted-value tests of one table in a single aggregate."""
    counted = df.agg(*[_failures(t).alias(f"t{i}") for i, t in enumerate(tests)])
    rows = [F.struct(*_labels(t), F.col(f"t{i}").alias("failures")) for i, t in enumerate(tests)]
    return counted.select(F.inline(F.array(*rows)))


def _unique_test(df: DataFrame, test: ColumnTest) -> DataFrame:
    return violations(df, test).agg(F.count(F.lit(1)).alias("failures")).select(*_labels(test), "failures")


def run_tests(tables: dict[str, DataFrame], tests: list[ColumnTest]) -> DataFrame:
    """Result frame (table_name, column_name, test, failures), one row per test."""
    results = []
    for name, df in tables.items():
        mine = [t for t in tests if t.table == name]
        per_row = [t for t in mine if t.kind != "unique"]
        if per_row:
            results.append(_row_tests(df, per_row))
        results += [_unique_test(df, t) for t in mine if t.kind == "unique"]
    return reduce(DataFrame.unionByName, results)


def broken_tests(df: DataFrame, tests: list[ColumnTest], name: str = "broken") -> DataFrame:
    """``df`` with the names of the tests that each row breaks, in the order of ``tests``.

    A row breaks ``unique`` if its value is in several rows; those values are found by one
    aggregate per test and joined back, one row each, however many rows have them.
    """
    found, flags = df, []
    for i, test in enumerate(tests):
        value, label = F.col(test.column), F.lit(f"{test.column} {test.kind}")
        if test.kind == "not_null":
            broken = value.isNull()
        elif test.kind == "accepted_values":
            broken = value.isNotNull() & ~value.isin(list(test.accepted))
        else:
            counted = df.where(value.isNotNull()).groupBy(test.column).agg(F.count(F.lit(1)).alias("n"))
            repeated = counted.where("n > 1").select(test.column, F.lit(True).alias(f"_repeated{i}"))
            found = found.join(repeated, test.column, "left")
            broken = F.col(f"_repeated{i}").isNotNull()
        flags.append(F.when(broken, label))
    marked = F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")
    return found.select(*df.columns, marked.alias(name))


def quarantine(df: DataFrame, tests: list[ColumnTest], path: str) -> tuple[DataFrame, DataFrame]:
    """Write accepted and rejected rows apart in one pass, and read both back.

    Rejected rows keep the names of the tests they break.
    """
    marked = broken_tests(df, tests)
    marked.withColumn("rejected", (F.size("broken") > 0).cast("int")).write.mode("overwrite").partitionBy("rejected").parquet(path)
    written = df.sparkSession.read.parquet(path)
    accepted = written.where("rejected = 0").select(*df.columns)
    return accepted, written.where("rejected = 1").select(*df.columns, "broken")
