"""Publications written batch by batch and read back."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold import definitions as d
from keyfold.operators import published, state
from keyfold.session import shared_dir
from keyfold.sources.events import ENTITY
from workload import inputs
from workload.inputs import EV, MAP_WRITES
from workload.state import ORACLES as STATE_SQL
from workload.state import k2_commit_fold

QUERIES, ORACLES = {}, {}

_BATCHES = 4
_START = datetime(2024, 2, 1, tzinfo=timezone.utc)
_TYPES = ("view", "click", "purchase")
_PLACE = {"subsystem": "checkout", "group_id": "publisher"}


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/publication-{uuid.uuid4().hex}"


def _map_changes(writes: DataFrame) -> DataFrame:
    """What a stretch of a map's writes sets, removes and clears."""
    columns = [*ENTITY, "map_key", "value"]
    fresh = state.map_snapshot(writes).select(*columns, F.lit(False).alias("_deleted"))
    last = writes.filter("op <> 'clear'").groupBy(*ENTITY, "map_key").agg(F.max_by("op", "offset").alias("op"))
    nothing = F.lit(None).cast("string")
    gone = last.filter("op = 'remove'").select(*ENTITY, "map_key", nothing.alias("value"), F.lit(True))
    cleared = writes.filter("op = 'clear'").select(*ENTITY).distinct()
    cleared = cleared.select(*ENTITY, nothing.alias("map_key"), nothing.alias("value"), F.lit(True))
    return fresh.union(gone).union(cleared)


def p1_publish_read(spark, sf_dir):
    """A map published in batches of changes, one per quarter of the log, and read whole."""
    writes, path = inputs.map_writes(spark, sf_dir), _folder(spark)
    carts = d.map("carts", published=True, read_cache=False)
    last = writes.agg(F.max("offset")).first()[0] or 0
    batch = F.floor(F.col("offset") * _BATCHES / F.lit(last + 1))
    for n in range(_BATCHES):
        published.publish_changes(
            _map_changes(writes.filter(batch == n)), path, carts, batch_id=n,
            as_of=_START + timedelta(hours=n), kept=2, **_PLACE,
        )
    found = published.PublishedReader(spark, path, "checkout", carts).snapshot()
    return found.select("topic", "key", "map_key", "value")


def p8_uncommitted(spark, sf_dir):
    """Published values of committed calls, looked up for every order."""
    path, latest = _folder(spark), d.value("latest", published=True, read_cache=False)
    values = k2_commit_fold(spark, sf_dir).select(F.lit("events").alias("topic"), "key", "value")
    published.publish(values, path, latest, batch_id=1, as_of=_START, **_PLACE)
    asked = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("caller"), F.lit("events").alias("topic"),
        F.col("o_custkey").cast("string").alias("key"),
    )
    reader = published.PublishedReader(spark, path, "checkout", latest)
    return reader.get(asked).select("caller", "key", "value")


def p9_retired(spark, sf_dir):
    """The latest value per key and type of event; the clicks' collection is retired."""
    writes, path = inputs.writes(spark, sf_dir).filter("NOT excised"), _folder(spark)
    answers = []
    for name in _TYPES:
        latest = d.value(name, published=True, read_cache=False)
        mine = writes.filter(F.col("type") == name).withColumn("op", F.lit("set"))
        published.publish(
            state.value_snapshot(mine), path, latest, batch_id=1, as_of=_START, **_PLACE
        )
        if name == "click":
            published.publish(
                spark.createDataFrame([], "topic string, key string, value string"), path,
                d.value(name, published=False), batch_id=2, as_of=_START + timedelta(hours=1), **_PLACE,
            )
        label = F.lit(name).alias("collection")
        try:
            found = published.PublishedReader(spark, path, "checkout", latest).snapshot()
            answers.append(found.select(label, "key", "value", F.lit(True).alias("readable")))
        except LookupError:
            nothing = F.lit(None).cast("string")
            answers.append(
                spark.range(1).select(label, nothing.alias("key"), nothing.alias("value"), F.lit(False).alias("readable"))
            )
    return reduce(DataFrame.unionByName, answers)


def _register(function, sql):
    QUERIES[function.__name__] = function
    ORACLES[function.__name__] = sql


_register(p1_publish_read, f"WITH {MAP_WRITES} SELECT topic, key, map_key, value FROM entries")
_register(p8_uncommitted, f"""
SELECT o_orderkey AS caller, CAST(o_custkey AS VARCHAR) AS key, c.value
FROM orders LEFT JOIN ({STATE_SQL["k2_commit_fold"]}) c ON c.key = CAST(o_custkey AS VARCHAR)""")
_register(p9_retired, f"""
WITH {EV}
SELECT etype AS collection, key, arg_max(k, off) AS value, TRUE AS readable
FROM ev WHERE etype IN ('view', 'purchase') GROUP BY 1, 2
UNION ALL SELECT 'click', NULL, NULL, FALSE""")
