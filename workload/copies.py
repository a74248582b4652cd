"""Excision of the copies that calls have left in tables."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from keyfold import definitions as d
from keyfold.operators import copies, failures, published
from keyfold.session import shared_dir
from keyfold.sources.events import ENTITY
from workload import inputs
from workload.inputs import CALLS, EV

QUERIES, ORACLES = {}, {}

_BATCHES = 4
_START = datetime(2024, 2, 1, tzinfo=timezone.utc)


def k12_excise_everywhere(spark, sf_dir):
    """Outputs, dead letters and published state that the log's excise records leave."""
    folder = f"{shared_dir(spark)}/copies-{uuid.uuid4().hex}"
    log = inputs.events(spark, sf_dir)
    last = log.agg(F.max("offset")).first()[0] or 0
    messages = log.filter(F.col("payload").isNotNull()).select(
        *ENTITY, "offset", F.floor(F.col("offset") * _BATCHES / F.lit(last + 1)).alias("batch_id")
    )
    messages.write.partitionBy("batch_id").parquet(f"{folder}/outputs")

    failed = inputs.handler_calls(spark, sf_dir).filter("failed").withColumn("outcome", F.lit("dead_letter"))
    letters = failures.dead_letters(failed, "failed").select("topic", "source_topic", "key", "offset")
    letters.write.parquet(f"{folder}/letters")

    latest = d.value("latest", published=True, read_cache=False)
    for batch in range(_BATCHES):
        newest = messages.filter(F.col("batch_id") == batch).groupBy(*ENTITY).agg(F.max("offset").alias("offset"))
        published.publish_changes(
            newest.withColumn("value", F.col("offset").cast("string")), f"{folder}/state", latest,
            subsystem="copies", group_id="publisher", batch_id=batch, as_of=_START + timedelta(hours=batch),
        )

    copies.excise_copies(
        copies.last_excised(log),
        {f"{folder}/outputs": ENTITY, f"{folder}/letters": ("source_topic", "key")},
        [f"{folder}/state"], order="offset",
    )
    kept = [
        ("output", spark.read.parquet(f"{folder}/outputs")),
        ("letter", spark.read.parquet(f"{folder}/letters")),
        ("published", published.PublishedReader(spark, f"{folder}/state", "copies", latest).snapshot()),
    ]
    outputs, dead, state = [rows.select(F.lit(name).alias("copy"), "key", "offset") for name, rows in kept]
    return outputs.union(dead).union(state)


QUERIES["k12_excise_everywhere"] = k12_excise_everywhere
ORACLES["k12_excise_everywhere"] = f"""
WITH {EV}, {CALLS}, gone AS (SELECT key AS gone_key, max(off) AS mark FROM ev WHERE tomb GROUP BY 1),
held AS (
  SELECT 'output' AS copy, key, off FROM ev WHERE NOT tomb
  UNION ALL SELECT 'letter', key, off FROM calls WHERE failed
  UNION ALL SELECT 'published', key, max(off) FROM ev WHERE NOT tomb GROUP BY key)
SELECT copy, key, off AS "offset" FROM held LEFT JOIN gone ON key = gone_key
WHERE mark IS NULL OR off > mark"""
