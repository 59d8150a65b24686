"""Registered end-to-end queries over the given tables, with their SQL oracles."""

from importlib import import_module


def load() -> None:
    """Import every plan module, which registers its queries."""
    for name in ("messages", "privacy", "texts", "documents", "publishing", "knowledge", "streams"):
        import_module(f"chatloom.plans.{name}")
