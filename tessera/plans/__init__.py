"""Registered queries, one module per area of the inventory."""

import importlib

_MODULES = [
    "flagship", "q_scalars", "q_joins", "q_aggs", "q_windows", "q_sequences",
    "q_sets", "q_semi", "q_warehouse", "q_versions", "q_text", "q_vectors",
    "q_quality", "q_sampling", "q_layout", "q_evals", "q_loads", "q_sources", "q_streaming", "q_udfs", "q_files",
    "q_checks",
]


def load_all() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(f"tessera.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"tessera.plans.{m}":
                raise
