"""One query per model."""

from __future__ import annotations

from quarrystone.plans.registry import MODELS
from workload.base import Query, over, query


def _model(name: str) -> Query:
    return query(over(lambda t: t[name]), f"SELECT * FROM {name}")


QUERIES: dict[str, Query] = {m.name: _model(m.name) for m in MODELS}
