"""Registered queries with, where SQL can say it, an equivalent statement to check against."""

from gristmill.catalog import (
    cleaning, explaining, modelling, neighbouring, profiling, quality, sampling, scanning, scoring, storing,
)

MODULES = (
    cleaning, profiling, sampling, scoring, neighbouring, quality, modelling, scanning, explaining, storing)


def queries():
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql():
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
