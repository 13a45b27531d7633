"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from ambar.plans import cleaning, evaluation, features, learning, profiling, scans, scoring, screening

MODULES = [scans, cleaning, features, profiling, evaluation, learning, scoring, screening]

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: text for module in MODULES for name, text in module.ORACLES.items()}


def flagship(spark, sf_dir):
    """Context features of school and network, temporal split, boosted trees, metrics on both editions."""
    return learning.gbt_engineered(spark, sf_dir)
