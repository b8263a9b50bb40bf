"""marketlens: retail-marketplace analytics as Spark DataFrame operators.

Layout
------
``sources``    table binding (K1), literal tables (K3), snapshots (K4),
               staging and partitioned publishing (K2, K5)
``functions``  Column-valued helpers: calendar windows, classifiers,
               line economics, compliance checks
``operators``  DataFrame -> DataFrame building blocks: filters, joins,
               aggregates, windows, set operations
``plans``      the reports composed from them (finance, merch,
               compliance, first-party cohort studies)
``checks``     independent DuckDB SQL used as the correctness oracle
"""

__all__ = ["session", "params"]
