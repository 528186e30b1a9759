"""All queries of the package but those of the corpus operators: name -> function, name -> DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from genomill.plans.annotation import QUERIES as ANNOTATION
from genomill.plans.coevolution import QUERIES as COEVOLUTION
from genomill.plans.counting import QUERIES as COUNTING
from genomill.plans.events import QUERIES as EVENTS
from genomill.plans.graphs import QUERIES as GRAPHS
from genomill.plans.mapping import QUERIES as MAPPING
from genomill.plans.texts import QUERIES as TEXTS
from genomill.plans.trees import QUERIES as TREES

_ALL: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {**ANNOTATION, **COEVOLUTION, **COUNTING, **EVENTS, **GRAPHS, **MAPPING, **TEXTS, **TREES}

QUERIES = {name: f for name, (f, _) in _ALL.items()}
ORACLES = {name: sql for name, (_, sql) in _ALL.items() if sql}
