"""Query plans: registered queries (with their oracle SQL) and pipelines."""

from mcqflow.plans.registry import ORACLE, QUERIES


def load_all():
    """Import every query module so that it registers itself."""
    import importlib
    for m in ("q_clean", "q_mix", "q_balance", "q_prompt", "q_answers", "q_sources", "q_generate", "q_pipeline", "q_stream"):
        importlib.import_module(f"mcqflow.plans.{m}")
    return QUERIES, ORACLE
