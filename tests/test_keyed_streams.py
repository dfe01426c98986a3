"""Streams with state per key: newest records only, batches that come twice, compaction, alerts for silent streams."""

import uuid
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktally.session import shared_folder
from stocktally.sources import versions
from stocktally.streaming import keyed

SCHEMA = "id int, at long, tie int, v string, gone boolean"


def folder(spark, name="keyed"):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def feed(spark, path, *batches, schema=SCHEMA):
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


BATCHES = (
    [(1, 5, 0, "a", False), (1, 4, 0, "older in the batch", False), (2, 1, 0, "b", None), (None, 1, 0, "n", False), (3, None, 0, "no time", False)],
    [(1, 3, 9, "late", False), (2, 1, 1, "tie", False), (2, 1, 0, "same again", False), (None, 2, 0, "n2", False), (4, 1, 0, "d", True)],
    [(3, 0, 0, "now with one", False), (2, 7, 0, None, True), (4, 0, 0, "older than its end", False)],
    [(2, 6, 0, "older than its end", False), (1, 9, 0, "A", False)],
)


def run(spark, source, path, **mode):
    for batch in BATCHES:  # one start per batch: state and commits go on from the checkpoint
        stream = feed(spark, source, batch)
        keyed.keyed_upsert(stream, path, ["id"], ["at", "tie"], path + "-progress", **mode).awaitTermination()


def test_newest_record_per_key_in_both_modes(spark, rows, monkeypatch):
    def no_reads(*_):
        raise AssertionError("the target was read")

    for mode, want in (("latest_wins", [(1, "A"), (3, "now with one"), (None, "n2")]),
                       ("filter_first", [(1, "A"), (2, "older than its end"), (3, "now with one"), (4, "older than its end"), (None, "n2")])):
        path, source = folder(spark), folder(spark, "in")
        with monkeypatch.context() as patched:
            patched.setattr(keyed, "read_version", no_reads)
            run(spark, source, path, tombstone=F.col("gone"), tombstone_mode=mode, partition_by="tie")
        assert rows(keyed.upserted(spark, path, ["id"], ["at", "tie"]), "id", "v") == sorted(want, key=lambda r: (r[0] is None, str(r[0])))
        stored = versions.read_version(spark, path)
        assert stored.filter("v in ('late', 'older in the batch', 'same again')").count() == 0  # dropped before the sink
        keyed.compact(spark, path, ["id"], ["at", "tie"])
        assert rows(keyed.upserted(spark, path, ["id"], ["at", "tie"]), "id", "v") == sorted(want, key=lambda r: (r[0] is None, str(r[0])))
        assert versions.read_version(spark, path).groupBy("id").count().filter("count > 1").isEmpty()


def test_a_batch_that_comes_twice_is_added_once(spark, monkeypatch):
    path, source = folder(spark), folder(spark, "in")
    stream = feed(spark, source, BATCHES[0])
    commit = keyed.commit_rows

    def stop_after(*args, **kwargs):
        commit(*args, **kwargs)
        raise RuntimeError("stopped after the commit")

    with monkeypatch.context() as patched:
        patched.setattr(keyed, "commit_rows", stop_after)
        with pytest.raises(Exception, match="stopped after the commit"):
            keyed.keyed_upsert(stream, path, ["id"], ["at", "tie"], path + "-progress").awaitTermination()
    n = versions.read_version(spark, path).count()
    keyed.keyed_upsert(stream, path, ["id"], ["at", "tie"], path + "-progress").awaitTermination()
    assert versions.versions(spark, path) == [1] and versions.read_version(spark, path).count() == n == 4


def test_a_batch_goes_on_top_of_a_compaction(spark, rows, monkeypatch):
    path, source = folder(spark), folder(spark, "in")
    keyed.keyed_upsert(feed(spark, source, *BATCHES[:2]), path, ["id"], ["at", "tie"], path + "-progress").awaitTermination()
    commit, done = keyed.commit_rows, []

    def compaction_first(*args, **kwargs):
        if not done:
            done.append(1)
            keyed.compact(spark, path, ["id"], ["at", "tie"])
        return commit(*args, **kwargs)

    monkeypatch.setattr(keyed, "commit_rows", compaction_first)
    keyed.keyed_upsert(feed(spark, source, BATCHES[3]), path, ["id"], ["at", "tie"], path + "-progress").awaitTermination()
    monkeypatch.undo()
    assert versions.versions(spark, path) == [1, 2, 3, 4]
    assert rows(keyed.upserted(spark, path, ["id"], ["at", "tie"]), "id", "v")[:2] == [(1, "A"), (2, "older than its end")]


def test_state_may_expire_and_modes_are_checked(spark, rows):
    path, source = folder(spark), folder(spark, "in")
    keyed.keyed_upsert(feed(spark, source, *BATCHES), path, ["id"], ["at", "tie"], path + "-progress", ttl=timedelta(hours=1)).awaitTermination(120)
    assert rows(keyed.upserted(spark, path, ["id"], ["at", "tie"]), "id", "v")[0] == (1, "A")
    with pytest.raises(ValueError, match="tombstone_mode"):
        keyed.newest_only(feed(spark, source), ["id"], ["at"], None, "both")
    keyed.compact(spark, folder(spark), ["id"], ["at"])  # nothing there, nothing done


START = datetime(2024, 1, 1)


def told_by_force(events, limits, mark, settle):
    """Silences of each key one after the other."""
    out, by_key = [], defaultdict(set)
    for key, at in events:
        by_key[key].add(at)
    for key, times in by_key.items():
        back, worst = None, 0
        ordered = sorted(times)
        for last, until in zip(ordered, [*ordered[1:], None], strict=True):
            crossed = [k for k, (_, limit) in enumerate(limits) if (until is None or last + limit < until) and last + limit < mark]
            if crossed:
                if back is None or last - back >= settle:
                    worst = 0
                out += [(key, limits[k][0], last, last + limits[k][1]) for k in crossed if k >= worst]
                worst = max(worst, crossed[-1] + 1)
                back = until
    return sorted(out, key=str)


@pytest.mark.parametrize("settle", [0, 600])
def test_silences_against_force(spark, settle):
    rng = np.random.default_rng(settle + 1)
    limits = [("WARN", timedelta(minutes=30)), ("ALERT", timedelta(minutes=90))]
    events = []
    for key in ("a", "b", None, "c"):
        at = 0
        for _ in range(60):
            at += int(rng.choice([1, 5, 29, 31, 60, 120, 400], p=[.3, .2, .1, .1, .1, .1, .1]))
            events.append((key, START + timedelta(minutes=at, seconds=int(rng.integers(0, 30)))))
    events += [events[3], ("quiet", START + timedelta(minutes=7))]
    newest = max(at for _, at in events)
    events.sort(key=lambda e: e[1])
    # Within 200 minutes the order of arrival is arbitrary.
    arrived = sorted(events, key=lambda e: e[1] + timedelta(minutes=float(rng.uniform(0, 190))))
    source = folder(spark, "in")
    schema = "stream string, at timestamp"
    batches = [arrived[k : k + 50] for k in range(0, len(arrived), 50)]
    batches[1] = [*batches[1], ("a", None)]
    stream = feed(spark, source, *batches, schema=schema)
    alerts = keyed.silence_alerts(stream, ["stream"], "at", dict(limits), late="200 minutes", settle=timedelta(minutes=settle))
    got = keyed.drain_keyed(alerts, folder(spark, "told"))
    got = sorted(((r.stream, r.level, r.last_seen, r.crossed_at) for r in got.collect()), key=str)
    want = told_by_force(events, limits, newest - timedelta(minutes=200), timedelta(minutes=settle))
    assert got == want and len(want) >= 8 and any(w[0] == "quiet" and w[1] == "ALERT" for w in want)


def test_silence_by_the_clock(spark):
    source = folder(spark, "in")
    now = datetime.now().replace(microsecond=0)
    stream = feed(spark, source, [("old", now - timedelta(hours=2)), ("new", now + timedelta(hours=1))], schema="stream string, at timestamp")
    alerts = keyed.silence_alerts(stream, ["stream"], "at", {"WARN": timedelta(minutes=30)}, clock="processingTime")
    assert [(r.stream, r.level) for r in keyed.drain_keyed(alerts, folder(spark, "told"), by_clock=True).collect()] == [("old", "WARN")]
    with pytest.raises(ValueError):
        keyed.silence_alerts(stream, ["stream"], "at", {})


def test_other_queries_keep_their_state_store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    path, source = folder(spark), folder(spark, "in")
    keyed.keyed_upsert(feed(spark, source, BATCHES[0]), path, ["id"], ["at"], path + "-progress").awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
