"""End-to-end jobs and the registry of named queries (see ``registry``)."""

import importlib
import sys
import traceback

MODULES = ("q_text", "q_agg", "q_split", "q_eval", "q_features", "q_io", "q_model", "q_more", "q_stream")

# module -> traceback of the query modules that could not be loaded (normally empty)
FAILED: dict[str, str] = {}


def load_all():
    """Import every query module so the registry is filled; returns (queries, oracle).

    A module that cannot be loaded is reported on stderr and kept in ``FAILED``; the queries
    of the other modules stay available."""
    from scriptorium.plans import registry
    for mod in MODULES:
        try:
            importlib.import_module(f"scriptorium.plans.{mod}")
        except Exception:  # noqa: BLE001
            FAILED[mod] = traceback.format_exc()
            print(f"scriptorium.plans.{mod} could not be loaded:\n{FAILED[mod]}", file=sys.stderr)
    return registry.QUERIES, registry.ORACLE
