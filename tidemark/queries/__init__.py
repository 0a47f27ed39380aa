"""All registered queries; importing the package fills the registry."""

import importlib
import pkgutil

from tidemark.queries.registry import ORACLES, QUERIES

for _module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
    if _module != "registry":
        importlib.import_module(f"{__name__}.{_module}")

__all__ = ["ORACLES", "QUERIES"]
