"""Named query plans over the test tables (the ``queries()`` catalogue)."""

from reportflow.plans.registry import ORACLES, QUERIES


def load_all() -> None:
    """Import every query module so its queries register."""
    from reportflow.plans import q_delivery, q_metadata, q_reports, q_reshape, q_state, q_store, q_stream  # noqa: F401


__all__ = ["ORACLES", "QUERIES", "load_all"]
