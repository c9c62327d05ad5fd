"""Hand-made record rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from tidemark.schemas import RECORD

T0 = datetime(2024, 1, 1)


def at(seconds: float = 0, micros: int = 0) -> datetime:
    return T0 + timedelta(seconds=seconds, microseconds=micros)


def record(id, version=1, updated=0.0, amount="1.00", deleted=False, **over):
    when = at(updated) if isinstance(updated, (int, float)) else updated
    row = {
        "id": id,
        "external_id": f"ext-{id}",
        "name": f"Name {id}",
        "email": f"n{id}@example.com",
        "company": "Acme",
        "city": "Oslo",
        "country": "Norway",
        "status": "active",
        "tags": ["vip"],
        "amount": amount,
        "version": version,
        "created_at": T0,
        "updated_at": when,
        "deleted_at": when if deleted else None,
    }
    row.update(over)
    return tuple(row[c] for c in RECORD.names)


def table(spark, rows):
    return spark.createDataFrame(rows, RECORD)
