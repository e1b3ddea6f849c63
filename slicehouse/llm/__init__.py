"""Operators for training data. Nothing else in the library imports this package; its queries are registered from outside."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Tasks get the package's functions with the job, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from slicehouse.llm import (  # noqa: E402
    decontaminate,
    exact_dedup,
    html_extract,
    packing,
    personal_data,
    preference,
    quality,
    simhash,
    spelling,
    suffix_dedup,
    token_counts,
    turn_repair,
    url_filter,
)

MODULES = (packing, token_counts, exact_dedup, quality, html_extract, simhash, suffix_dedup, url_filter, preference, decontaminate, spelling, personal_data, turn_repair)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
