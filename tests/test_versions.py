"""Atomic commits: readers see a table before a write or after it; of two writers one wins; checks run with the write."""

import uuid

import pytest
from pyspark.sql import functions as F

from stocktally.plans.quality import Expectation, ExpectationFailed
from stocktally.session import shared_folder
from stocktally.sources import sinks, versions


def folder(spark, name="table"):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, v string, day string")


OLD = [(1, "a", "d1"), (2, "b", "d2"), (3, "c", "d3")]
BATCH = [(2, "moved", "d1"), (4, "x", None)]
NEW = [(1, "a", "d1"), (2, "moved", "d1"), (3, "c", "d3"), (4, "x", None)]


class Stop(Exception):
    pass


def stopping(monkeypatch, where):
    """Make one step of a write raise, before or after it has run."""
    name, when = where
    step = getattr(versions, name)

    def run(*args, **kwargs):
        if when == "before":
            raise Stop
        step(*args, **kwargs)
        raise Stop

    for module in (versions, sinks):
        if hasattr(module, name):
            monkeypatch.setattr(module, name, run)


WRITES = {
    "merge": lambda spark, path: sinks.merge_by_key(spark, path, frame(spark, BATCH), ["id"], "day"),
    "merge whole": lambda spark, path: sinks.merge_by_key(spark, path, frame(spark, BATCH), ["id"]),
    "replace": lambda spark, path: sinks.replace_table(spark, frame(spark, NEW), path, "day"),
}


@pytest.mark.parametrize("write", WRITES)
@pytest.mark.parametrize("where", [("add_rows", "before"), ("add_rows", "after"), ("publish", "before"), ("publish", "after")])
def test_a_stopped_write_shows_the_old_table_or_the_new_one(spark, rows, monkeypatch, write, where):
    path = folder(spark)
    by = None if write == "merge whole" else "day"
    sinks.merge_by_key(spark, path, frame(spark, OLD), ["id"], by)
    with monkeypatch.context() as patched, pytest.raises(Stop):
        stopping(patched, where)
        WRITES[write](spark, path)
    assert rows(sinks.read_table(spark, path)) == sorted(NEW if where == ("publish", "after") else OLD)
    WRITES[write](spark, path)
    assert rows(sinks.read_table(spark, path)) == rows(frame(spark, NEW))
    assert rows(versions.read_version(spark, path, versions.version(spark, path, 1))) == sorted(OLD)


def test_a_draft_of_a_commit_is_no_version(spark, rows):
    path = folder(spark)
    sinks.replace_table(spark, frame(spark, OLD), path)
    fs, draft = versions._files(spark, f"{path}/{versions.COMMITS}/.draft-1")
    fs.create(draft).close()  # a writer stopped while it wrote
    assert versions.versions(spark, path) == [1] and rows(sinks.read_table(spark, path)) == sorted(OLD)


def test_of_two_writers_one_wins(spark, rows):
    path = folder(spark)
    sinks.merge_by_key(spark, path, frame(spark, OLD), ["id"], "day")
    seen = versions.version(spark, path)
    first, second = (versions.add_rows(spark, path, frame(spark, [(9, who, "d9")]), "day") for who in ("first", "second"))
    versions.commit_rows(spark, path, first, seen.schema, seen, "day", add=True)
    with pytest.raises(versions.ConcurrentWrite):
        versions.commit_rows(spark, path, second, seen.schema, seen, "day", add=True)
    assert rows(sinks.read_table(spark, path)) == sorted([*OLD, (9, "first", "d9")])
    fresh = folder(spark)  # also the first version can be made once only
    sinks.replace_table(spark, frame(spark, OLD), fresh)
    with pytest.raises(versions.ConcurrentWrite):
        versions.commit(spark, fresh, frame(spark, BATCH), None)


def test_a_taken_number_is_not_replaced(spark, monkeypatch):
    """Both writers look before either renames: the file system decides."""
    path = folder(spark)
    sinks.replace_table(spark, frame(spark, OLD), path)
    seen = versions.version(spark, path)
    sinks.replace_table(spark, frame(spark, NEW), path)
    monkeypatch.setattr(versions, "versions", lambda *_: [seen.number])
    with pytest.raises(versions.ConcurrentWrite):
        versions.commit(spark, path, frame(spark, BATCH), seen)


def test_untouched_partitions_stay_by_reference(spark):
    path = folder(spark)
    sinks.merge_by_key(spark, path, frame(spark, OLD), ["id"], "day")
    before = versions.version(spark, path).parts
    sinks.merge_by_key(spark, path, frame(spark, BATCH), ["id"], "day")
    after = versions.version(spark, path).parts
    name = lambda v: "null" if v is None else "v" + v.encode().hex().upper()
    assert after[name("d3")] == before[name("d3")] and after[name("d1")] != before[name("d1")]
    assert set(after) == {name("d1"), name("d3"), "null"}  # d2 lost its last row


def test_retention_keeps_what_is_read(spark, rows):
    path = folder(spark)
    for k in range(5):
        sinks.merge_by_key(spark, path, frame(spark, [(k, "x", f"d{k % 2}")]), ["id"], "day")
    want = rows(sinks.read_table(spark, path))
    loose = versions.add_rows(spark, path, frame(spark, OLD))[""][0]
    assert all(g.startswith(versions.COMMITS) for g in versions.retain(spark, path, last=2, idle_hours=1))
    gone = versions.retain(spark, path, last=2, idle_hours=0)
    assert loose in gone and versions.versions(spark, path) == [4, 5] and rows(sinks.read_table(spark, path)) == want
    assert rows(versions.read_version(spark, path, versions.version(spark, path, 4)), "id") == [(k,) for k in range(4)]


def test_columns_may_be_added(spark, rows):
    path = folder(spark)
    sinks.merge_by_key(spark, path, frame(spark, OLD), ["id"], "day")
    sinks.merge_by_key(spark, path, frame(spark, [(4, "x", "d1")]).withColumn("more", F.lit(7)), ["id"], "day")
    assert rows(sinks.read_table(spark, path), "id", "more") == [(1, None), (2, None), (3, None), (4, 7)]
    sinks.merge_by_key(spark, path, frame(spark, [(5, "y", "d3")]), ["id"], "day")
    assert rows(sinks.read_table(spark, path), "id", "more") == [(1, None), (2, None), (3, None), (4, 7), (5, None)]


def test_a_plain_folder_becomes_a_versioned_table(spark, rows):
    path = folder(spark)
    sinks.write_table(frame(spark, OLD), path, partition_by=["day"])
    sinks.merge_by_key(spark, path, frame(spark, BATCH), ["id"], "day")
    assert rows(sinks.read_table(spark, path).select("id", "v", "day")) == rows(frame(spark, NEW))
    with pytest.raises(ValueError, match="partitioned by"):
        sinks.merge_by_key(spark, path, frame(spark, BATCH), ["id"])
    assert versions.version(spark, folder(spark)) is None
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, folder(spark))


def test_empty_batches_and_tables(spark, rows):
    path = folder(spark)
    none = frame(spark, [])
    sinks.merge_by_key(spark, path, none, ["id"], "day")
    assert sinks.read_table(spark, path).columns == ["id", "v", "day"] and sinks.read_table(spark, path).count() == 0
    sinks.merge_by_key(spark, path, frame(spark, OLD), ["id"], "day")
    sinks.merge_by_key(spark, path, none, ["id"], "day")
    assert rows(sinks.read_table(spark, path)) == sorted(OLD)


CHECKS = [
    Expectation("not_null", "day"), Expectation("min_length", "v", (("limit", 2),)), Expectation("numeric_range", "id", (("low", 0), ("high", 99)), "error"),
]


def test_checks_run_in_the_job_that_writes(spark, rows):
    path = folder(spark)
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "write")
    found = sinks.replace_table(spark, frame(spark, NEW), path, "day", CHECKS)
    spark.sparkContext.setJobGroup("", "")
    assert [(f.violations, f.status) for f in found] == [(1, "warn"), (3, "warn"), (0, "pass")]
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 1
    for write in (lambda df: sinks.replace_table(spark, df, path, "day", CHECKS), lambda df: sinks.merge_by_key(spark, path, df, ["id"], "day", CHECKS)):
        with pytest.raises(ExpectationFailed, match=r"numeric_range\(id\): 1 rows"):
            write(frame(spark, [(100, "yy", "d1")]))
        assert rows(sinks.read_table(spark, path)) == rows(frame(spark, NEW)) and versions.versions(spark, path) == [1]
    with pytest.raises(ValueError, match="unique"):
        sinks.replace_table(spark, frame(spark, NEW), path, "day", [Expectation("unique", "id")])


def test_checks_of_empty_rows(spark):
    assert [f.violations for f in sinks.replace_table(spark, frame(spark, []), folder(spark), None, CHECKS)] == [0, 0, 0]


def test_archive_commits_both_tables(spark, rows, monkeypatch):
    root = folder(spark)
    of = lambda v: spark.createDataFrame([(v,)], "v int").withColumn("kind", F.lit("a"))
    run = lambda v, at: sinks.archive_then_overwrite(spark, f"{root}/now", f"{root}/old", of(v), "kind", "a", at)
    run(1, "2024-01-01")
    calls, commit = [], versions.commit

    def second_fails(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise Stop
        return commit(*args, **kwargs)

    with monkeypatch.context() as patched, pytest.raises(Stop):
        patched.setattr(sinks, "commit", second_fails)
        run(2, "2024-02-01")
    assert rows(sinks.read_table(spark, f"{root}/now"), "v") == [(1,)] == rows(sinks.read_table(spark, f"{root}/old"), "v")
    run(2, "2024-02-01")
    assert rows(sinks.read_table(spark, f"{root}/now"), "v") == [(2,)] and rows(sinks.read_table(spark, f"{root}/old"), "v") == [(1,)]
