"""Schema catalog: the latest registered schema of a subject.

The catalog is a table (subject, version, id, schema); the latest entry per
subject is a grouped ``max_by`` (distributed, one row per subject).  The
subject of a topic's values is ``<topic>-value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_subject(topic: str) -> str:
    return f"{topic}-value"


def latest_schemas(catalog: DataFrame) -> DataFrame:
    """subject, version, id, schema of the highest version per subject."""
    latest = F.max_by(F.struct("version", "id", "schema"), F.col("version")).alias("l")
    return catalog.groupBy("subject").agg(latest).select("subject", "l.version", "l.id", "l.schema")


def latest_schema(catalog: DataFrame, subject: str) -> tuple[int, str]:
    """(id, schema) of the subject's latest version; a missing subject is an
    error, as a failed registry lookup would be."""
    row = latest_schemas(catalog.filter(F.col("subject") == subject)).first()
    if row is None:
        raise LookupError(f"no schema registered for subject {subject!r}")
    return row["id"], row["schema"]


def schemas_by_id(catalog: DataFrame, subject: str) -> dict[int, str]:
    """id -> schema of all of a subject's versions: a few, whatever the log's size."""
    rows = catalog.filter(F.col("subject") == subject).select("id", "schema").distinct().collect()
    if not rows:
        raise LookupError(f"no schema registered for subject {subject!r}")
    return {r["id"]: r["schema"] for r in rows}
