"""The registered queries, one module per family."""

from importlib import import_module
from pkgutil import iter_modules


def load() -> None:
    for module in iter_modules(__path__):
        import_module(f"{__name__}.{module.name}")
