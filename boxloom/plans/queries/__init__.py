"""Queries over the test tables, by area; ``load`` registers them all."""
from importlib import import_module

AREAS = ["boxes", "objects", "texts", "evaluation", "corpora", "sources"]


def load() -> None:
    for area in AREAS:
        import_module(f"{__name__}.{area}")
