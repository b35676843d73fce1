"""Named queries, one module per family."""

from __future__ import annotations

import importlib
import pkgutil

from coverlake.registry import QUERIES, Query


def load_all() -> dict[str, Query]:
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    return QUERIES
