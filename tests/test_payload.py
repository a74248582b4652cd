"""Payload fields by name."""

from pyspark.sql import functions as F

from keyfold.functions.payload import field, json_type


def test_names_may_hold_dots(spark):
    payload = '{"order.id": "7", "order": {"id": "8"}, "plain": 9}'
    row = (
        spark.createDataFrame([(payload,)], "payload string")
        .select(
            field(F.col("payload"), "order.id").alias("dotted"),
            field(F.col("payload"), "plain").alias("plain"),
            json_type(F.parse_json("payload"), "order.id").alias("kind"),
            json_type(F.parse_json("payload"), "absent").alias("none"),
        )
        .first()
    )
    assert tuple(row) == ("7", "9", "STRING", None)
