"""What ``__spark_entry__`` adds when this subpackage is there."""

from __future__ import annotations

import corpus_pipeline

from promolens.llm.queries import QUERIES
from promolens.llm.sql import SQL


def queries() -> dict:
    return QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
