"""The registered queries."""

from importlib import import_module

MODULES = ("forecast", "grading", "transcripts", "criteria", "reviews", "evidence")


def load_all() -> None:
    for name in MODULES:
        import_module(f"gaugeworks.catalog.{name}")
