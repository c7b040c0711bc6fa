"""The registered queries, each with its SQL for the result check.

A query takes ``(spark, sf_dir)`` and runs over the whole given tables. The SQL texts state
the same results in another engine's terms.
"""

from curbflow.plans import clustering, decode, metrics, publish, search, spatial, streams

MODULES = [decode, publish, spatial, search, metrics, clustering, streams]


def queries():
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql():
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
