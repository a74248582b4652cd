"""Chunked scans, ranks, rolling sums and greedy periods against plain folds."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from keyfold.operators import filters, jobs, state, timers, windows
from keyfold.plans.chunked import rolling_sums, with_rank, with_scan, with_tail
from keyfold.plans.greedy import greedy_periods
from keyfold.plans.joins import after_last_mark

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def skewed_log(seed, n=3000):
    """One key holds a third of all rows; times rise with the offset, some tie."""
    rng = random.Random(seed)
    rows, now = [], START
    for offset in range(n):
        key = "hot" if rng.random() < 1 / 3 else f"k{rng.randrange(40)}"
        now += timedelta(milliseconds=rng.choice([0, 200, 900, 5000, 60000]))
        payload = None if rng.random() < 0.01 else '{"id":"%d","n":%d}' % (rng.randrange(n // 2), offset)
        rows.append(("t", 0, offset, now, key, payload))
    return rows


COLUMNS = "topic string, partition int, offset long, timestamp timestamp, key string, payload string"


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(skewed_log(1), COLUMNS).cache()


@pytest.mark.parametrize("chunk_rows", [1, 37, 1000, 1 << 22])
def test_scan_equals_plain_windows(log, chunk_rows):
    amount = F.col("offset") % 17
    chunked = with_scan(
        log, ["topic", "key"], "offset", chunk_rows=chunk_rows,
        running={"s": ("sum", amount), "hi": ("max", amount), "lo": ("min", amount)},
        totals={"all": ("sum", amount), "last": ("max", F.col("offset"))},
        previous={"was": F.col("payload"), "was_offset": F.col("offset")},
    )
    ordered = Window.partitionBy("topic", "key").orderBy("offset")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("topic", "key")
    plain = log.select(
        "*", F.sum(amount).over(so_far).alias("s"), F.max(amount).over(so_far).alias("hi"),
        F.min(amount).over(so_far).alias("lo"), F.sum(amount).over(whole).alias("all"),
        F.max("offset").over(whole).alias("last"),
        F.lag("payload").over(ordered).alias("was"),
        F.lag("offset").over(ordered).alias("was_offset"),
    )
    assert chunked.columns == plain.columns
    assert chunked.count() == log.count()
    assert chunked.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("descending", [False, True])
def test_rank_by_text_of_one_large_key(spark, descending):
    entries = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 9)).alias("key"),
        # All keys share a long prefix, and code point order differs from UTF-16 order.
        F.concat(F.lit("item/"), F.when(F.col("id") % 2 == 0, "😀").otherwise("～"), F.col("id"))
        .alias("name"),
    )
    order = F.col("name").desc() if descending else F.col("name").asc()
    plain = entries.withColumn(
        "r", F.row_number().over(Window.partitionBy("key").orderBy(order)).cast("long") - 1
    )
    ranked = with_rank(entries, ["key"], "name", "r", descending=descending)
    assert ranked.exceptAll(plain).isEmpty() and ranked.count() == 5000


def test_rolling_sums_equal_brute_force(log, rows):
    second = F.unix_seconds("timestamp")
    found = rolling_sums(log, ["topic", "key"], second, 300, {"n": F.lit(1), "s": F.col("offset")})
    by_key = defaultdict(list)
    for _, _, offset, moment, key, _ in skewed_log(1):
        by_key[key].append((int(moment.timestamp()), offset))
    expected = []
    for key, items in by_key.items():
        for at in {second for second, _ in items}:
            inside = [o for s, o in items if at - 300 < s <= at]
            expected.append((key, at, len(inside), sum(inside)))
    assert rows(found, "key", "second", "n", "s") == sorted(expected, key=repr)


def fold_bursts(log, length_us):
    """Windows by a plain loop over each key's events."""
    found, open_ = [], {}
    for _, _, offset, moment, key, payload in log:
        us = int((moment - START) / timedelta(microseconds=1)) + int(START.timestamp()) * 10**6
        window = open_.get(key)
        if window and us // 10**6 >= window["close"]:
            window = open_.pop(key)
            found.append(window)
            window = None
        if payload is None:
            if window:
                found.append(open_.pop(key))
        elif window:
            window["held"].append(offset)
        else:
            close = (us + length_us + 500_000) // 10**6
            open_[key] = {"key": key, "open": offset, "close": close, "held": []}
    return found + list(open_.values())


@pytest.mark.parametrize("seconds,chunk_rows,batch", [(1, 1 << 22, 10_000), (7, 50, 3), (300, 1, 64)])
def test_burst_windows_equal_plain_fold(spark, log, rows, seconds, chunk_rows, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        expected = fold_bursts(skewed_log(1), seconds * 10**6)
        found = windows.burst_windows(log, seconds, 5, chunk_rows=chunk_rows)
        assert rows(found, "key", "open_offset", "close_second", "held", "summarised") == sorted(
            ((w["key"], w["open"], w["close"], len(w["held"]), min(5, len(w["held"]))) for w in expected),
            key=repr,
        )
        held = windows.burst_held(log, seconds, 5, chunk_rows=chunk_rows)
        assert rows(held, "key", "offset", "from_back") == sorted(
            ((w["key"], o, n + 1) for w in expected for n, o in enumerate(reversed(w["held"][-5:]))),
            key=repr,
        )
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_periods_carry_over_arrow_batches(spark, rows):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        seconds = spark.range(50).select(
            F.lit("a").alias("key"), F.col("id").alias("second"), (F.col("id") * 10**6).alias("first_us")
        )
        opened = greedy_periods(seconds, ["key"], 10).filter("opens")
        assert rows(opened, "second", "close_second") == [(n, n + 10) for n in (0, 10, 20, 30, 40)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_periods_shorter_than_a_second_are_refused(log):
    with pytest.raises(ValueError, match="length"):
        greedy_periods(log, ["key"], 0.5)


@pytest.mark.parametrize("ttl", [1, 60, 3600, 10**6])
def test_dedup_with_ttl_equals_plain_fold(spark, rows, ttl):
    # A third of all rows are copies of one event.
    rng = random.Random(5)
    events, now = [], START
    for offset in range(2000):
        now += timedelta(seconds=rng.choice([0, 0.3, 2, 40]))
        name = "same" if rng.random() < 1 / 3 else str(rng.randrange(300))
        payload = rng.choice(['{"id":"%s"}' % name] * 9 + ['{"x":1}'])
        events.append(("t", offset % 3, offset, now, "k", payload))
    kept, ends = [], {}
    for _, _, offset, moment, _, payload in sorted(events, key=lambda e: (e[3], e[1], e[2])):
        second = int(moment.timestamp())
        if "id" in payload:
            if payload in ends and second < ends[payload]:
                continue
            ends[payload] = int((moment + timedelta(seconds=ttl, microseconds=500_000)).timestamp())
        kept.append((offset,))
    frame = spark.createDataFrame(events, COLUMNS)
    assert rows(filters.first_by_id_within(frame, ttl), "offset") == sorted(kept, key=repr)


def test_dedup_without_ttl_keeps_first(log, rows):
    seen, kept = set(), []
    for _, _, offset, _, key, payload in skewed_log(1):
        name = None if payload is None else payload.split('"')[3]
        if name is None or (key, name) not in seen:
            kept.append((offset,))
            seen.add((key, name))
    assert rows(filters.first_by_id(log), "offset") == sorted(kept, key=repr)


@pytest.mark.parametrize("limit", [0, 100_000])
def test_marks_by_either_join(spark, log, rows, limit, monkeypatch):
    monkeypatch.setattr("keyfold.plans.joins.broadcast_if_small.__defaults__", (limit,))
    last = {}
    for _, _, offset, _, key, payload in skewed_log(1):
        if payload is None:
            last[key] = offset
    expected = [(o,) for _, _, o, _, k, p in skewed_log(1) if p and o > last.get(k, -1)]
    found = after_last_mark(log, ["key"], "offset", F.col("payload").isNull()).filter("payload IS NOT NULL")
    assert rows(found, "offset") == sorted(expected, key=repr)


def writes_log(ops, seed, n=1500):
    rng = random.Random(seed)
    rows = []
    for offset in range(n):
        key = "hot" if rng.random() < 1 / 3 else f"k{rng.randrange(20)}"
        rows.append(("t", key, offset, START, rng.choice(ops), f"c{rng.randrange(30)}", str(offset)))
    return rows


WRITES = "topic string, key string, offset long, timestamp timestamp, op string, map_key string, value string"


def test_map_and_deque_folds(spark, rows):
    log = writes_log(["set"] * 20 + ["remove"] * 5 + ["clear"], 3)
    maps = defaultdict(dict)
    for _, key, _, _, op, cell, item in log:
        if op == "set":
            maps[key][cell] = item
        elif op == "remove":
            maps[key].pop(cell, None)
        else:
            maps[key].clear()
    found = state.map_snapshot(spark.createDataFrame(log, WRITES))
    assert rows(found, "key", "map_key", "value") == sorted(
        ((k, c, v) for k, m in maps.items() for c, v in m.items()), key=repr
    )

    log = writes_log(["append"] * 20 + ["appendleft"] * 9 + ["clear"], 4)
    deques = defaultdict(list)
    for _, key, _, _, op, _, item in log:
        if op == "append":
            deques[key].append(item)
        elif op == "appendleft":
            deques[key].insert(0, item)
        else:
            deques[key].clear()
    frame = spark.createDataFrame(log, WRITES)
    for chunk_rows in (10, 1 << 22):
        slots = state.deque_slots(frame, chunk_rows=chunk_rows)
        assert rows(slots, "key", "position", "size", "value") == sorted(
            ((k, n, len(d), v) for k, d in deques.items() for n, v in enumerate(d)), key=repr
        )
    picked = state.deque_get(slots, [0, -1, 2, 9999])
    assert rows(picked, "key", "index", "value") == sorted(
        ((k, i, d[i] if -len(d) <= i < len(d) else None)
         for k, d in deques.items() if d for i in (0, -1, 2, 9999)), key=repr
    )


def test_timers_equal_plain_simulation(spark, rows):
    rng = random.Random(8)
    log, now = [], START
    for offset in range(1200):
        now += timedelta(seconds=rng.choice([0, 1.4, 30, 400]))
        op = rng.choice(["schedule"] * 5 + ["unschedule"] * 2 + ["clear_and_schedule", "clear_scheduled"])
        # Some times lie in the past, some carry half seconds.
        at = START + timedelta(seconds=rng.randrange(0, 90_000, 500) + rng.choice([0, 0.5, 0.49]))
        key = "hot" if rng.random() < 1 / 3 else f"k{rng.randrange(12)}"
        log.append(("t", key, offset, now, op, None if op == "clear_scheduled" else at))
    waiting, fired = defaultdict(set), Counter()
    left = defaultdict(set)
    for _, key, _, moment, op, at in log:
        clock = moment.timestamp()
        for second in [s for s in waiting[key] if s <= clock]:
            waiting[key].discard(second)
            fired[(key, second)] += 1
        second = None if at is None else int((at + timedelta(milliseconds=500)).timestamp())
        for timers_ in (waiting[key], left[key]):
            if op.startswith("clear"):
                timers_.clear()
            if op.endswith("schedule") and op != "unschedule":
                timers_.add(second)
            elif op == "unschedule":
                timers_.discard(second)
    for key, seconds in waiting.items():
        fired.update((key, s) for s in seconds)
    frame = spark.createDataFrame(
        log, "topic string, key string, offset long, timestamp timestamp, op string, time timestamp"
    )
    for chunk_rows in (25, 1 << 22):
        assert rows(timers.fired_timers(frame, chunk_rows=chunk_rows), "key", "second", "firings") == sorted(
            ((k, s, n) for (k, s), n in fired.items()), key=repr
        )
        assert rows(timers.scheduled_timers(frame, chunk_rows=chunk_rows), "key", "second") == sorted(
            ((k, s) for k, seconds in left.items() for s in seconds), key=repr
        )


@pytest.mark.parametrize("chunk_rows", [40, 1 << 22])
def test_counters_equal_plain_fold(log, rows, chunk_rows):
    ttl, as_of = timedelta(minutes=20), START + timedelta(hours=12)
    spans = defaultdict(list)
    last = {}
    for _, _, _, moment, key, payload in skewed_log(1):
        was = last.get(key)
        if was is None or was[1] or moment - was[0] >= ttl:
            spans[key].append(0)
        last[key] = (moment, payload is None)
        spans[key][-1] += payload is not None
    expected = [
        (
            key,
            counts[-1] if not last[key][1] and as_of - last[key][0] < ttl else None,
            sum(n > 0 for n in counts), max(counts),
        )
        for key, counts in spans.items()
    ]
    found = jobs.counters(log, ttl, as_of, chunk_rows=chunk_rows)
    assert rows(found, "key", "counter", "starts", "highest") == sorted(expected, key=repr)


def test_hot_keys_never_meet_in_one_window_group(log):
    """The widest window group of a chunked scan is a chunk, not a key."""
    plan = with_scan(
        log, ["topic", "key"], "offset", running={"n": ("sum", F.lit(1))}, chunk_rows=100
    )._jdf.queryExecution().optimizedPlan().toString()
    wide = [line for line in plan.splitlines() if "Window" in line and "payload" in line]
    assert all("_chunk" in line for line in wide)


@pytest.mark.parametrize("length", [3, 1500])
def test_tail_of_any_length(log, length):
    found = with_tail(log, ["topic", "key"], "offset", length, "back", chunk_rows=100)
    by_key = defaultdict(list)
    for row in log.select("key", "offset").collect():
        by_key[row.key].append(row.offset)
    expected = {
        (key, offset, back)
        for key, offsets in by_key.items()
        for back, offset in enumerate(sorted(offsets, reverse=True)[:length], 1)
    }
    assert {(r.key, r.offset, r.back) for r in found.collect()} == expected


@pytest.mark.parametrize("capacity", [100, 1500])
def test_a_tail_never_ranks_a_whole_key(log, capsys, capacity):
    pushes = log.select(
        "topic", "key", "offset", "timestamp", F.lit("append").alias("op"),
        F.col("offset").cast("string").alias("value"),
    )
    state.bounded_deque(pushes, capacity).explain()
    plan = capsys.readouterr().out
    # Ranks of a key run as a limit below the shuffle, or chunk by chunk.
    assert ("WindowGroupLimit" in plan) == (capacity <= 1000)
    assert ("_chunk" in plan) == (capacity > 1000)


def test_write_positions_hold_any_offset_and_place(spark):
    writes = spark.createDataFrame(
        [("t", "k", 1, (1 << 20) + 5, "a"), ("t", "k", 2, 0, "b"), ("t", "n", 1 << 50, 0, "c"),
         ("t", "n", 5, 9, "d")],
        "topic string, key string, offset long, seq long, value string",
    )
    placed = writes.withColumns({
        "offset": state.write_position(F.col("offset"), F.col("seq")),
        "op": F.lit("set"), "timestamp": F.lit(START),
    })
    found = {(r.key, r.value) for r in state.value_snapshot(placed).collect()}
    assert found == {("k", "b"), ("n", "c")}
