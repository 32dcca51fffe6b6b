"""Operators a training-data pipeline needs; nothing outside this folder imports it.

``load()`` registers the queries of all operators and returns (queries, oracle SQL).
"""

from __future__ import annotations

from pyspark import cloudpickle

import grantspark

# task-side helpers travel with their functions, so executors need no copy of the package
cloudpickle.register_pickle_by_value(grantspark)

#: The modules with the numbered operators.
MODULES = ("bpe", "simhash", "media", "packing", "substrings", "langid", "toxicity", "quality", "fixity", "quotes", "manifest", "alignment", "ngram_join")


def load():
    """Import every operator module; returns its registered queries and their SQL."""
    import importlib

    from . import common

    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return common.QUERIES, common.ORACLES
