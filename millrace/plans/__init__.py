"""Role tables and the registered queries over them."""

from importlib import import_module

MODULES = (
    "q_sources q_extract q_functions q_filters q_joins q_aggregates q_windows q_upserts q_quality q_graph "
    "q_streams q_steps"
).split()


def load() -> None:
    """Import every query module, which registers its queries."""
    for module in MODULES:
        import_module(f"millrace.plans.{module}")
