"""Every query of this subpackage with its SQL, for the driver's entry module."""

from __future__ import annotations

import importlib

#: Modules that hold a QUERIES and an ORACLES table.
MODULES = ("toxicity", "records", "simhash", "spotsigs", "mixing", "decontaminate", "langid", "ngrams", "substrings", "arc",
           "whitening", "chat", "merkle")


def _modules():
    return [importlib.import_module(f"{__package__}.{m}") for m in MODULES]


def queries() -> dict:
    import corpus_pipeline
    return {k: f for m in _modules() for k, f in m.QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    import corpus_pipeline
    own = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {k: s for m in _modules() for k, s in m.ORACLES.items()} | own
