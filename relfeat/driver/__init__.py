"""Queries over the driver tables: one per operator, each with the SQL that checks it."""

from importlib import import_module


def load() -> None:
    for name in ("q_scalar", "q_group", "q_fit", "q_blocks"):
        import_module(f"relfeat.driver.{name}")
