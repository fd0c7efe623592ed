"""Queries by name, each with the SQL that must give the same rows."""

from . import fixtures

QUERIES = {}
ORACLES = {}


def query(name, sql=None, views=""):
    """Register a query (spark, folder) -> DataFrame; `views` are the stand-in views its SQL reads."""

    def keep(plan):
        QUERIES[name] = plan
        if sql:
            ORACLES[name] = fixtures.with_views(views.split(), sql)
        return plan

    return keep


def decimal_places(n=6):
    """Column rounder for results that are compared across engines."""
    from pyspark.sql import functions as F

    return lambda name: F.round(F.col(name).cast("double"), n).alias(name)


r6 = decimal_places()
