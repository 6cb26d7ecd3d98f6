"""Query plans: each registered key is a DataFrame program over the driver
tables plus, where SQL can say the same thing, a DuckDB oracle."""


def load_all():
    from fieldcraft.plans import (  # noqa: F401
        q_counts,
        q_docs,
        q_embed,
        q_encode,
        q_eval,
        q_info,
        q_models,
        q_prep,
        q_target,
        q_trained,
    )
    from fieldcraft.plans.registry import ORACLE, QUERIES
    return QUERIES, ORACLE
