"""The queries of this package and their SQL, for ``__spark_entry__.py``."""

from __future__ import annotations

import importlib

MODULES = ("mixing", "simhash", "chat", "extraction", "lm", "topk", "toxicity", "packing", "ann", "langid", "resampling", "periodic", "repeats")


def _merged(what: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out.update(getattr(importlib.import_module(f"wardstar.llm.{name}"), what, {}))
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracles() -> dict:
    return _merged("ORACLES")
