"""Keyed event analytics on Spark.

Two layers share one event model (``keyfold.sources.events.EVENT_SCHEMA``):

* ``keyfold.operators``: DataFrame -> DataFrame operators on Catalyst expressions;
* ``keyfold.streaming``: ``process_keyed``, a user handler per key on
  ``transformWithState``, with typed state, timers and failure modes.
"""
