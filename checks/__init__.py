"""Correctness-check material: registered queries and their DuckDB oracle SQL."""


def load_all():
    from checks import q_ensemble, q_eval, q_ml, q_ops, q_prep, registry  # noqa: F401

    return registry
