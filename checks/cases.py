"""Imports every group of cases, which registers them."""

from checks import (  # noqa: F401
    cases_aggregates,
    cases_functions,
    cases_joins,
    cases_models,
    cases_projections,
    cases_quality,
    cases_streaming,
    cases_tables,
    cases_windows,
)
