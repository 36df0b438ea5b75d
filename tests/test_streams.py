"""Streaming jobs: restarted batches, keyed entries, tables whose untouched folders stay."""

import os
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestack.plans import notes, streams
from lodestack.sources.tables import read_folders, scratch
from lodestack.streaming import jobs

EVENTS = "event_id long, ts timestamp, user_id long, event_type string"
T0 = datetime(2024, 1, 1)


def rows_at(spark, rows):
    return spark.createDataFrame([(i, T0 + timedelta(hours=h), u, t) for i, h, u, t in rows], EVENTS)


def test_a_restarted_batch_writes_nothing_twice(spark):
    at = scratch(spark)
    run = jobs.sink(spark, at, "q")
    first, second = rows_at(spark, [(1, 0, 1, "a"), (2, 40, 1, "a")]), rows_at(spark, [(3, 27, 1, "a"), (4, 29, 2, "b"), (5, 50, 2, "b")])
    for number, batch in ((0, first), (1, second), (1, second.repartition(3)), (0, first), (1, second)):
        run(batch, number)
    jobs.sink(spark, at, "other")(first, 0)

    def ids(leg, name="q"):
        return sorted(r.event_id for r in spark.read.parquet(f"{at}/{leg}").where(F.col("query") == name).collect())

    assert (ids("on_time"), ids("late")) == ([1, 2, 4, 5], [3])  # later than hour 40 less 12
    assert ids("on_time", "other") == [1, 2]
    run(rows_at(spark, []), 2)
    assert ids("on_time") == [1, 2, 4, 5]


def ended(events, ttl, late):
    """Entries by a loop over the events of each user."""
    out, last = set(), max(h for _, h, _, _ in events)
    for user in {u for _, _, u, _ in events}:
        now = None
        for i, h, _, t in sorted((e for e in events if e[2] == user), key=lambda e: (e[1], e[0])):
            if now and h - now[1] > ttl:
                out.add((user, "expired", now[0], now[1] + ttl, now[2], now[3]))
                now = None
            if t != "close":
                now = (now[0] if now else h, h, i, now[3] + 1 if now else 1)
            elif now:
                out.add((user, "cleared", now[0], h, now[2], now[3]))
                now = None
        if now:
            over = now[1] + ttl <= last - late
            out.add((user, "expired" if over else "open", now[0], now[1] + ttl if over else -1, now[2], now[3]))
    return out


@pytest.mark.parametrize("files", [1, 4])
def test_pending_like_a_loop(spark, files):
    rng = random.Random(8)
    events = [(i, h, rng.randint(0, 5), rng.choice(["open", "open", "close"])) for i, h in enumerate(sorted(rng.sample(range(400), 120)))]
    at = scratch(spark)
    for n in range(files):
        rows_at(spark, events[n * 120 // files : (n + 1) * 120 // files]).coalesce(1).write.mode("append").parquet(f"{at}/in")
    with jobs.keyed_state(spark):
        made = jobs.pending(jobs.events(spark, f"{at}/in", rows_at(spark, []).schema, 1), ("close",), timedelta(hours=9))
        jobs.append(made, f"{at}/out", f"{at}/ck").awaitTermination()
        left = jobs.open_entries(spark, f"{at}/ck").collect()
    base = int(rows_at(spark, [(0, 0, 0, "")]).select(F.unix_micros("ts")).first()[0])

    def hour(us):
        return (us - base) // 3_600_000_000

    got = {(r.user_id, r.how, hour(r.opened_us), hour(r.closed_us), r.last_id, r.n) for r in spark.read.schema(jobs.EPISODE).parquet(f"{at}/out").collect()}
    got |= {(r.user_id, "open", hour(r.opened_us), -1, r.last_id, r.n) for r in left}
    assert got == ended(events, 9, 1)


def test_parts_touch_their_folders_only(spark):
    at = scratch(spark)
    schema = "id long, word string"
    run = jobs.parts(spark, at, {"words": (lambda new: new.select("id", F.explode(F.split("t", " ")).alias("word")).where("word <> ''"), schema)}, 32)
    docs = "id long, t string, ord int"

    def now():
        return sorted(map(tuple, read_folders(spark, f"{at}/words", f"{schema}, bucket int", "id").drop("bucket").collect()))

    def files():
        return {p for r, _, f in os.walk(f"{at}/words") for p in f if p.endswith(".parquet")}

    run(spark.createDataFrame([(i, f"a{i} b", 1) for i in range(60)], docs), 0)
    before = files()
    change = spark.createDataFrame([(3, "new", 2), (3, "older", 1), (7, "", 2), (9, "late", 0), (None, "x", 9)], docs)
    run(change, 1)
    want = sorted([(i, w) for i in range(60) if i not in (3, 7) for w in (f"a{i}", "b")] + [(3, "new")])
    assert now() == want
    kept = before & files()
    assert len(before - kept) <= 3
    run(change, 1)  # again, as after a lost driver
    assert now() == want
    run(spark.createDataFrame([(7, "back", 3)], docs), 2)
    assert (7, "back") in now() and kept & files()


def test_notes_of_both_states_are_made_once(spark, sf, monkeypatch):
    made, plain = spark.sparkContext.accumulator(0), notes.notes

    def counted(spark, d):
        def count(md: pd.Series) -> pd.Series:
            made.add(len(md))
            return md

        return plain(spark, d).withColumn("md", F.pandas_udf(count, "string")("md"))

    monkeypatch.setattr(notes, "notes", counted)
    streams.incremental_spans(spark, sf)
    assert made.value == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_both_arrivals_and_both_tables_reach_the_result(spark, sf, monkeypatch):
    arrived, plain = [], jobs.parts

    def spied(*args, **kwargs):
        run = plain(*args, **kwargs)

        def one(batch, number):
            arrived.append({r.id for r in batch.select("id").collect()})
            run(batch, number)

        return one

    monkeypatch.setattr(jobs, "parts", spied)
    rows = streams.incremental_spans(spark, sf).select("doc_id", "part").collect()
    first, second = arrived
    assert second and second < first  # notes that changed
    of = {part: {r.doc_id for r in rows if r.part == part} for part in ("section", "span")}
    assert of["section"] & second and of["span"] & second and of["span"] - second  # those that did not are kept
