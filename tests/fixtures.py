"""Hand-made raw entities for unit tests (missing entities are empty)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from finspark.plans.pipeline import Pipeline
from finspark.sources.files import ENTITY_SCHEMAS

D = dt.date
T = dt.datetime


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def pipeline(spark, **raw) -> Pipeline:
    overrides = {}
    for entity, schema in ENTITY_SCHEMAS.items():
        rows = raw.get(entity, [])
        overrides[f"raw_{entity}"] = spark.createDataFrame(rows, schema)
    return Pipeline(spark, "/nonexistent", overrides=overrides)


def txn(tid, cust="c1", amount=100, status="success", created=T(2024, 1, 1, 10), ingested=D(2024, 1, 2)):
    return (tid, f"a-{cust}", cust, money(amount), "USD", "m", status, created, None, ingested, "1234", "dev")


def pay(pid, tid, status, attempt, at, ingested=D(2024, 1, 2)):
    return (pid, tid, "card", status, attempt, at, ingested)


def refund(rid, tid, amount, at=D(2024, 1, 5), ingested=D(2024, 1, 6), reason="merchant_error"):
    return (rid, tid, money(amount), reason, at, ingested)


def sub(sid, cust, plan, status, start, end=None, ingested=D(2024, 1, 1)):
    return (sid, cust, plan, status, start, end, ingested)
