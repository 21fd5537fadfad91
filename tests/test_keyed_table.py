"""Keyed table: last write wins, replays are harmless, compaction keeps the view."""

import pytest
from pyspark.sql import functions as F

from tidewater.sinks.keyed_table import KeyedTable

SCHEMA = "id string, v string, timestamp long, partition int, offset long"


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def view(t):
    return sorted(tuple(r) for r in t.current().select("id", "v").collect())


def test_last_write_wins_across_batches(spark, scratch):
    t = KeyedTable(spark, scratch, "id", ["timestamp", "partition", "offset"])
    t.upsert(batch(spark, [("a", "1", 1, 0, 0), ("b", "1", 1, 0, 1), ("a", "2", 2, 0, 2)]), 0)
    t.upsert(batch(spark, [("b", "2", 3, 0, 3), ("c", None, 3, 0, 4)]), 1)
    assert view(t) == [("a", "2"), ("b", "2"), ("c", None)]


def test_order_not_batch_decides(spark, scratch):
    t = KeyedTable(spark, scratch, "id", ["timestamp", "partition", "offset"])
    t.upsert(batch(spark, [("a", "late", 9, 0, 9)]), 0)
    t.upsert(batch(spark, [("a", "early", 1, 0, 1)]), 1)
    assert view(t) == [("a", "late")]


def test_replayed_batch_changes_nothing(spark, scratch):
    t = KeyedTable(spark, scratch, "id", ["timestamp", "partition", "offset"])
    b0 = batch(spark, [("a", "1", 1, 0, 0), ("b", "1", 1, 0, 1)])
    t.upsert(b0, 0)
    before = view(t)
    t.upsert(b0, 0)
    assert view(t) == before


def test_uncommitted_attempt_is_invisible(spark, scratch):
    t = KeyedTable(spark, scratch, "id", ["timestamp", "partition", "offset"])
    t.upsert(batch(spark, [("a", "1", 1, 0, 0)]), 0)
    # A half-done write of batch 1: Spark's staging folder, never put in place.
    batch(spark, [("a", "ghost", 5, 0, 5)]).write.parquet(
        f"{scratch}/segments/.spark-staging-1/seg_writer=w-/seg_batch=1")
    assert view(t) == [("a", "1")]


def test_compaction_keeps_view(spark, scratch):
    t = KeyedTable(spark, scratch, "id", ["timestamp", "partition", "offset"])
    t.upsert(batch(spark, [("a", "1", 1, 0, 0), ("b", "1", 1, 0, 1)]), 0)
    t.compact()
    t.upsert(batch(spark, [("a", "2", 2, 0, 2)]), 1)
    assert view(t) == [("a", "2"), ("b", "1")]
    t.compact()
    assert view(t) == [("a", "2"), ("b", "1")]


def test_ingest_with_compaction_keeps_view(spark, scratch):
    from tidewater.plans import derive
    from tidewater.plans.tables import table
    from tidewater.operators import decode, keyed
    from tidewater.schemas import USER_V1, USER_V1_COLUMNS
    from tidewater.sources.replay import read_envelopes, write_envelopes
    from tidewater.streaming.ingest import start_ingest
    from conftest import SF_SMALL

    order = ["timestamp", "partition", "offset"]
    env = derive.events_envelope(table(spark, SF_SMALL, "events"), derive.user_message())
    write_envelopes(env, f"{scratch}/in", files=3)
    t = KeyedTable(spark, f"{scratch}/t", "id", order)
    start_ingest(read_envelopes(spark, f"{scratch}/in", streaming=True, max_files_per_trigger=1),
                 t, f"{scratch}/dlq", f"{scratch}/ck", available_now=True,
                 compact_every=2).awaitTermination()
    assert t._base_versions() and len(t.written()) == 1  # batch 2 came after the compaction
    want = keyed.latest_per_key(decode.accepted(decode.decode_envelope(env, USER_V1)), "id", order)
    cols = list(USER_V1_COLUMNS)
    assert sorted(map(tuple, t.current().select(*cols).collect())) == \
        sorted(map(tuple, want.select(*cols).collect()))


def test_older_write_after_compaction_loses_to_base(spark, scratch):
    t = KeyedTable(spark, scratch, "id", ["timestamp", "partition", "offset"])
    t.upsert(batch(spark, [("a", "new", 9, 0, 9), ("b", "1", 1, 0, 1)]), 0)
    t.compact()
    t.upsert(batch(spark, [("a", "old", 2, 0, 2), ("c", "1", 3, 0, 3)]), 1)
    assert view(t) == [("a", "new"), ("b", "1"), ("c", "1")]


def test_two_writers_and_a_new_checkpoint_lose_nothing(spark, scratch):
    t = KeyedTable(spark, scratch, "id", ["timestamp", "partition", "offset"])
    t.upsert(batch(spark, [("a", "1", 1, 0, 0), ("b", "1", 1, 0, 1)]), 0, writer="first")
    t.upsert(batch(spark, [("c", "1", 1, 0, 2)]), 0, writer="second")
    assert view(t) == [("a", "1"), ("b", "1"), ("c", "1")]
    t.compact()
    t.upsert(batch(spark, [("z", "1", 2, 0, 3)]), 0, writer="third")
    t.upsert(batch(spark, [("y", "1", 2, 0, 4)]))
    assert view(t) == [("a", "1"), ("b", "1"), ("c", "1"), ("y", "1"), ("z", "1")]


def test_null_key_keeps_one_row(spark, scratch):
    t = KeyedTable(spark, scratch, "id", ["timestamp", "partition", "offset"])
    t.upsert(batch(spark, [(None, "old", 1, 0, 0)]), 0)
    t.compact()
    t.upsert(batch(spark, [(None, "new", 2, 0, 1)]), 1)
    assert view(t) == [(None, "new")]


def test_unreadable_store_is_an_error(spark, scratch):
    t = KeyedTable(spark, scratch, "id", ["timestamp", "partition", "offset"])
    with pytest.raises(ValueError):
        t.current()
    import os
    os.makedirs(f"{scratch}/segments/seg_writer=w-/seg_batch=0")
    with open(f"{scratch}/segments/seg_writer=w-/seg_batch=0/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        t.current().collect()


def crash_in(t, monkeypatch, step, after):
    """Let `t` fail at the call number `after` of one of its steps."""
    real, calls = getattr(t, step), [0]

    def stop(*a, **k):
        calls[0] += 1
        if calls[0] > after:
            raise RuntimeError("driver lost")
        return real(*a, **k)

    monkeypatch.setattr(t, step, stop)


@pytest.mark.parametrize("after", [0, 1, 2, 3])
def test_a_crash_while_deleting_loses_nothing(spark, scratch, monkeypatch, after):
    t = KeyedTable(spark, scratch, "id", ["timestamp", "partition", "offset"], buckets=2)
    rows = [(chr(97 + i), "1", i, 0, i) for i in range(6)]
    t.upsert(batch(spark, rows), 0)
    t.compact()
    t.upsert(batch(spark, [("a", "2", 20, 0, 20), ("g", "1", 21, 0, 21)]), 1)
    t.upsert(batch(spark, [("b", "old", -1, 0, 0)]), 2)
    want = view(t)
    with monkeypatch.context() as m:
        crash_in(t, m, "_delete", after)
        try:
            t.compact()
        except RuntimeError:
            pass
    assert view(t) == want
    t.compact()
    t.upsert(batch(spark, []), 3)
    t.compact()
    assert view(t) == want


def test_only_touched_buckets_are_rewritten(spark, scratch):
    t = KeyedTable(spark, scratch, "id", ["timestamp", "partition", "offset"], buckets=8)
    t.upsert(batch(spark, [(f"k{i}", "1", i, 0, i) for i in range(200)]), 0)
    t.compact()
    assert t._base_versions() == {k: {1} for k in range(8)} and t.written() == []
    t.upsert(batch(spark, [("k5", "2", 900, 0, 900)]), 1)
    t.compact()
    versions = sorted(v for vs in t._base_versions().values() for v in vs)
    assert versions == [1] * 7 + [2]
    assert dict(view(t))["k5"] == "2" and len(view(t)) == 200


def test_folders_stay_few_over_many_batches(spark, scratch):
    t = KeyedTable(spark, scratch, "id", ["timestamp", "partition", "offset"], buckets=2)
    for b in range(12):
        t.upsert(batch(spark, [(f"k{b % 3}", str(b), b, 0, b)]), b, "w")
        if b % 4 == 3:
            t.compact()
    assert t.written() == [] and all(len(v) == 1 for v in t._base_versions().values())
    assert view(t) == [("k0", "9"), ("k1", "10"), ("k2", "11")]


def test_history_goes_back(spark, scratch):
    t = KeyedTable(spark, scratch, "id", ["timestamp", "partition", "offset"], history=True)
    t.upsert(batch(spark, [("a", "1", 1, 0, 0)]), 0, "x/1")
    t.upsert(batch(spark, [("a", "2", 2, 0, 1)]), 1, "12")
    t.compact()  # keeps what it has
    assert sorted(t.written()) == [(0, "x/1"), (1, "12")]
    assert [r.v for r in t.snapshot(before=1).collect()] == ["1"] and t.snapshot(before=0) is None
    with pytest.raises(ValueError):
        KeyedTable(spark, scratch, "id", ["timestamp"]).snapshot(before=1)
