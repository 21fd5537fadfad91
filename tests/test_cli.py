from tidewater.__main__ import main
from tidewater.plans import derive
from tidewater.plans.tables import table
from tidewater.sources.replay import write_envelopes

from conftest import SF_SMALL


def test_ingest_count_sample_from_envelope_files(spark, scratch, capsys):
    env = derive.events_envelope(table(spark, SF_SMALL, "events"), derive.mixed_user_message())
    write_envelopes(env, f"{scratch}/in", files=2)
    assert main(["ingest", "--envelopes", f"{scratch}/in", "--table", f"{scratch}/t",
                 "--dead-letters", f"{scratch}/dlq", "--checkpoint", f"{scratch}/ck",
                 "--available-now"], spark) == 0
    main(["count", "--table", f"{scratch}/t"], spark)
    out = capsys.readouterr().out
    n = int(out.strip().split(":")[-1])
    # accepted messages are the purchase and signup events; one row per user
    want = (table(spark, SF_SMALL, "events").where("event_type IN ('purchase', 'signup')")
            .select("user_id").distinct().count())
    assert n == want > 0
    main(["sample", "--table", f"{scratch}/t", "--limit", "3"], spark)
    assert "first_name" in capsys.readouterr().out


def test_wordcount_over_text_files(spark, scratch):
    spark.createDataFrame([("a b a",), ("b",)], "value string").write.text(f"{scratch}/lines")
    assert main(["wordcount", "--lines", f"{scratch}/lines", "--table", f"{scratch}/w",
                 "--checkpoint", f"{scratch}/ck", "--available-now", "--compact-every", "1"],
                spark) == 0
    from tidewater.streaming.wordcount import word_count_table
    got = {r.word: r["count"] for r in word_count_table(spark, f"{scratch}/w").current().collect()}
    assert got == {"a": 2, "b": 2}


def test_ingest_with_dob_keeps_twelve_columns(spark, scratch):
    env = derive.events_envelope(table(spark, SF_SMALL, "events"), derive.user_message())
    write_envelopes(env, f"{scratch}/in", files=1)
    main(["ingest", "--envelopes", f"{scratch}/in", "--table", f"{scratch}/t",
          "--dead-letters", f"{scratch}/dlq", "--checkpoint", f"{scratch}/ck",
          "--available-now", "--with-dob"], spark)
    from tidewater.sinks.keyed_table import KeyedTable
    view = KeyedTable(spark, f"{scratch}/t", "id", ["timestamp", "partition", "offset"]).current()
    assert "dob" in view.columns and view.where("dob IS NOT NULL").count() > 0
