from __future__ import annotations

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bounce, orders, visitors
from tidemark.plans import jobs as batch_jobs
from tidemark.schemas import RECORD, Topic
from tidemark.sources import files, sample_tables as sample
from tidemark.stream_catalog import STEPS, Replay
from tidemark.streaming import jobs
from tidemark.streaming.session import streaming_session

DAY = 86_400_000
T0 = 1_704_067_200_000


@pytest.fixture
def home():
    return tempfile.mkdtemp(prefix="run-stream-")


@pytest.fixture
def session(spark):
    return streaming_session(spark, 2)


def log(mid, is_new, ts, **page):
    return json.dumps({"common": {"mid": mid, "is_new": is_new}, "page": page, "ts": ts})


def feed(spark, root, topic, batch_id, records):
    df = spark.createDataFrame(records, RECORD).withColumn("topic", F.lit(topic)).coalesce(1)
    files.topic_sink(root)(df, batch_id)


def stream(session, root, topic):
    return files.stream_topic(session, root, topic, files_per_trigger=1)


def done(query):
    query.awaitTermination()


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def log_batches():
    """Three batches in event order, devices flagged on several days."""
    batches, key, ts = [], 0, T0
    for batch in range(3):
        rows = []
        for i in range(24):
            ts += DAY // 30 + i
            key += 1
            last = "home" if i % 4 == 3 else None
            rows.append((key, log(f"m{i % 5}", "1" if i % 6 else "0", ts, page_id="p", last_page_id=last)))
        batches.append(rows)
    return batches


def test_log_job_resumes_and_equals_the_batch_job(spark, session, home):
    raw_root, out = f"{home}/raw", f"{home}/out"
    batches = log_batches()

    def run():
        source = stream(session, raw_root, Topic.ODS_LOG)
        done(jobs.start_logs(source, files.topic_sink(out), f"{home}/check"))

    feed(spark, raw_root, Topic.ODS_LOG, 0, batches[0])
    feed(spark, raw_root, Topic.ODS_LOG, 1, batches[1])
    run()
    half = files.read_topic(spark, out, Topic.PAGE).count()
    feed(spark, raw_root, Topic.ODS_LOG, 2, batches[2])
    run()  # from the checkpoint: first days of the earlier batches still count
    assert half == 48

    raw = spark.createDataFrame(sum(batches, []), RECORD)
    flag = F.get_json_object("value", "$.common.is_new")
    expected = batch_jobs.log_outputs(raw).select("topic", "id", flag.alias("flag"))
    got = files.read_topic(spark, out, Topic.PAGE).select(F.lit(Topic.PAGE), "id", flag.alias("flag"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert {r[2] for r in got.collect()} == {"0", "1"}


def test_first_arrived_day_stays_the_first(spark, session, home):
    raw_root, out = f"{home}/raw", f"{home}/out"
    feed(spark, raw_root, Topic.ODS_LOG, 0, [(1, log("a", "1", T0 + DAY))])
    feed(spark, raw_root, Topic.ODS_LOG, 1, [(2, log("a", "1", T0)), (3, log("a", "1", T0 + DAY))])
    done(jobs.start_logs(stream(session, raw_root, Topic.ODS_LOG), files.topic_sink(out), f"{home}/check"))
    pages = files.read_topic(spark, out, Topic.PAGE)
    flags = {r[0]: r[1] for r in pages.select("id", F.get_json_object("value", "$.common.is_new")).collect()}
    assert flags == {1: "1", 2: "0", 3: "1"}


def visits(spark, session, home, batches, ttl_ms=DAY):
    root, out = f"{home}/pages", f"{home}/visits"
    for i, batch in enumerate(batches):
        feed(spark, root, Topic.PAGE, i, batch)
    source = stream(session, root, Topic.PAGE)
    done(jobs.start_unique_visits(source, files.topic_sink(out), f"{home}/check-visits", ttl_ms=ttl_ms))
    return ids(files.read_topic(spark, out, Topic.UNIQUE_VISIT))


def test_unique_visits_by_arrival(spark, session, home):
    """Days one, two, one arriving in three batches open three days."""
    batches = [
        [(2, log("a", "1", T0 + 5)), (1, log("a", "1", T0)), (3, log("a", "1", T0 + 1, last_page_id="home"))],
        [(4, log("a", "1", T0 + 9)), (5, log("a", "1", T0 + DAY)), (6, log("b", "1", T0 + DAY))],
        [(7, log("a", "1", T0 + 10)), (8, log("b", "1", T0 + DAY + 1))],
    ]
    assert visits(spark, session, home, batches) == [1, 5, 6, 7]


def test_unique_visits_resume_and_keep_texts_out_of_python(spark, session, home):
    """After a restart the days of earlier batches still count; repeated records come once, as they came."""
    root, out = f"{home}/pages", f"{home}/visits"

    def run():
        source = stream(session, root, Topic.PAGE)
        query = jobs.start_unique_visits(source, files.topic_sink(out), f"{home}/check-visits")
        done(query)
        return query

    odd = log("b", "1", T0, page_id="é") + "  "
    feed(spark, root, Topic.PAGE, 0, [(1, log("a", "1", T0)), (2, odd), (2, odd)])
    run()
    feed(spark, root, Topic.PAGE, 1, [(3, log("a", "1", T0 + 1)), (4, log("a", "1", T0 + DAY)), (5, log("c", "1", T0))])
    query = run()
    found = files.read_topic(spark, out, Topic.UNIQUE_VISIT).collect()
    assert sorted(r.id for r in found) == [1, 2, 4, 5]
    assert {r.value for r in found if r.id == 2} == {odd}
    plan = query._jsq.explainInternal(False)
    python = [line for line in plan.splitlines() if "MapInPandas" in line or "FlatMapGroupsInPandasWithState" in line]
    assert python and not any("value" in line for line in python)


def test_unique_visits_are_forgotten(spark, session, home):
    batches = [[(1, log("a", "1", T0))], [(2, log("a", "1", T0 + 1))]]
    assert visits(spark, session, home, batches, ttl_ms=1) == [1, 2]


def test_unique_visits_equal_the_batch_job(spark, session, home):
    batches = log_batches()
    pages = jobs.parse_pages(spark.createDataFrame(sum(batches, []), RECORD))
    assert visits(spark, session, home, batches) == ids(visitors.unique_visits(pages))


def test_bounces_equal_the_batch_job_up_to_open_cells(spark, session, home):
    root, out = f"{home}/pages", f"{home}/bounces"
    records, ts = [], T0
    for i in range(90):
        ts += (1_000, 9_999, 10_000, 25_000, 4_000)[i % 5]
        records.append((i, log(f"m{i % 2}", "1", ts, page_id="p", last_page_id="home" if i % 3 == 2 else "")))
    for b in range(3):
        feed(spark, root, Topic.PAGE, b, records[30 * b : 30 * b + 30])
    feed(spark, root, Topic.PAGE, 3, [(1_000, log("end", "1", ts + 60_000, page_id="p"))])
    source = stream(session, root, Topic.PAGE)
    done(jobs.start_bounces(source, files.topic_sink(out), f"{home}/check"))
    pages = jobs.parse_pages(spark.createDataFrame(records, RECORD))
    assert ids(files.read_topic(spark, out, Topic.BOUNCE)) == ids(bounce.bounces(pages))


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_interval_join_on_streams(spark, session, home, limit):
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    left, right, out = f"{home}/orders", f"{home}/details", f"{home}/wide"
    at = "2024-01-01 10:00:%02d"
    for b in range(2):
        feed(spark, left, Topic.ORDER, b, [(i, json.dumps({"id": i, "user_id": i, "create_time": at % i})) for i in range(10 * b, 10 * b + 10)])
        feed(spark, right, Topic.ORDER_DETAIL, b, [(i, json.dumps({"id": i, "order_id": i % 10 + 10 * b, "create_time": at % (i % 10 + 10 * b + i // 10)})) for i in range(20)])
    users = spark.createDataFrame([("3", "2000-01-01", "F")], "id string, birthday string, gender string")
    query = jobs.start_order_wide(
        stream(session, left, Topic.ORDER),
        stream(session, right, Topic.ORDER_DETAIL),
        users,
        files.topic_sink(out),
        f"{home}/check",
    )
    done(query)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    got = files.read_topic(spark, out, Topic.ORDER_WIDE)
    rows = [json.loads(r[0]) for r in got.select("value").collect()]
    assert sorted(r["order_id"] for r in rows) == list(range(20))  # details a second off do not join
    assert [r["order_id"] for r in rows if r.get("user_gender") == "F"] == [3]


def test_old_join_state_is_dropped(session, home, spark):
    root = f"{home}/records"
    for b, at in enumerate(("2024-01-01 10:00:00", "2024-01-01 11:00:00", "2024-01-01 12:00:00")):
        record = json.dumps({"id": b, "order_id": 100 + b, "create_time": at})
        feed(spark, root, Topic.ORDER, b, [(b, record)])
    pairs = orders.interval_join(
        orders.parse_orders(stream(session, root, Topic.ORDER)),
        orders.parse_details(stream(session, root, Topic.ORDER)),
    )
    query = jobs.start(orders.order_wide(pairs), lambda df, i: df.count(), f"{home}/check")
    done(query)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 2  # the last on each side


def test_changes_without_a_sink_stop_the_query(spark, session, home):
    root = f"{home}/changes"
    feed(spark, root, Topic.ODS_DB, 0, [(1, json.dumps({"table": "t", "type": "insert", "data": {"id": 1}}))])
    rules = spark.createDataFrame(
        [("t", "insert", "hbase", "dim_t", "id", "id", None)],
        "source_table string, operate_type string, sink_type string, sink_table string, sink_columns string, sink_pk string, sink_extend string",
    )
    sink = files.topic_sink(f"{home}/out")
    with pytest.raises(Exception, match="no sink for"):
        done(jobs.start_changes(stream(session, root, Topic.ODS_DB), rules, sink, f"{home}/check"))
    tables = {"hbase": files.topic_sink(f"{home}/tables")}
    done(jobs.start_changes(stream(session, root, Topic.ODS_DB), rules, sink, f"{home}/check2", tables))
    assert ids(files.read_topic(spark, f"{home}/tables", "dim_t")) == [1]


def test_a_lagging_topic_holds_windows_open(spark, session, home):
    """Visits and bounces come long after their pages, and none is late."""
    minute = 60_000
    pages = [(i, log(f"m{i}", "0", T0 + i * minute, page_id="p")) for i in range(40)]
    roots = {name: f"{home}/{name}" for name in ("page", "visit", "bounce")}
    for name, topic in (("page", Topic.PAGE), ("visit", Topic.UNIQUE_VISIT), ("bounce", Topic.BOUNCE)):
        for batch in range(4):
            feed(spark, roots[name], topic, batch, pages[10 * batch : 10 * batch + 10])

    far = (99, log("end", "0", T0 + DAY, page_id="p"))
    for name, topic in (("page", Topic.PAGE), ("visit", Topic.UNIQUE_VISIT), ("bounce", Topic.BOUNCE)):
        feed(spark, roots[name], topic, 4, [far])
    # pages come four files at a time, the others one
    sources = [files.stream_topic(session, roots["page"], Topic.PAGE, 4)]
    sources += [stream(session, roots[n], t) for n, t in (("visit", Topic.UNIQUE_VISIT), ("bounce", Topic.BOUNCE))]
    query = jobs.start_visitor_stats(*sources, sink=files.table_sink(f"{home}/out"), checkpoint=f"{home}/check", window="1 minute")
    done(query)
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    assert dropped == 0
    out = files.read_table(spark, f"{home}/out", "stt string, uv_ct bigint, pv_ct bigint, uj_ct bigint")
    sums = out.agg(F.sum("uv_ct"), F.sum("pv_ct"), F.sum("uj_ct"), F.count("*")).first()
    assert tuple(sums) == (40, 40, 40, 40)


def test_late_rows_arrive_once(spark, session, home):
    """No row is lost: each is in a sum or in quarantine, also when the query starts again in between."""
    minute = 60_000

    def row(i, ts):
        return (i, log(f"m{i}", "0", ts, page_id="p", during_time=i))

    steps = [
        [row(1, T0), row(2, T0 + 5 * minute)],
        [row(3, T0 + 10 * minute), row(4, T0)],  # behind the last row, but the first windows are still open
        [row(5, T0 + 20 * minute), row(6, T0 + 5 * minute)],
        [row(7, T0), row(8, T0 + 20 * minute), row(9, T0 + 11 * minute)],
        [row(10, T0 + DAY)],
        [row(11, T0 + DAY), row(12, T0 + 20 * minute), row(12, T0 + 20 * minute)],
        [row(13, T0 + 3 * DAY)],
    ]
    root = f"{home}/pages"

    def run():
        sources = [stream(session, root, Topic.PAGE) for _ in range(3)]
        sinks = {"sink": files.table_sink(f"{home}/sums"), "late": files.topic_sink(f"{home}/late")}
        query = jobs.start_visitor_stats(*sources, checkpoint=f"{home}/check", window="1 minute", watermark="0 seconds", **sinks)
        done(query)
        return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])

    dropped = 0
    for i, step in enumerate(steps):
        feed(spark, root, Topic.PAGE, i, step)
        if i in (3, 5, 6):
            dropped += run()
    late = files.read_topic(spark, f"{home}/late", "quarantine")
    late = [json.loads(r.value) for r in late.collect()]
    sums = files.read_table(spark, f"{home}/sums", "uv_ct bigint, pv_ct bigint, uj_ct bigint, dur_sum bigint")
    for measure in ("uv_ct", "pv_ct", "uj_ct"):
        assert sum(r[measure] for r in late) + sums.agg(F.sum(measure)).first()[0] == sum(map(len, steps)) - 1  # the last is open
    assert dropped > 0 and 7 in {r["dur_sum"] for r in late if r["pv_ct"]}


def test_a_part_of_a_replay_is_one_micro_batch(spark, rows, tmp_path):
    times = [(i, f"2024-01-{1 + i // 10:02d} 00:{i % 10:02d}:00", i % 3, "view", 1.0, '{"k": 1}') for i in range(80)]
    events = rows(times, "event_id bigint, ts string, user_id bigint, event_type string, value double, props string")
    events = events.withColumn("ts", F.to_timestamp_ntz("ts")).repartition(4)
    events.write.parquet(f"{tmp_path}/events.parquet")
    replay = Replay(spark, str(tmp_path))
    parts, _ = replay.steps(sample.log_records)
    batches = []
    for add in parts:
        add()
        sink = lambda records, batch_id: batches.append((batch_id, records.count()))
        jobs.start(replay.raw(), sink, f"{replay.home}/check").awaitTermination()
    assert [batch for batch, _ in batches] == list(range(STEPS))
    assert sum(count for _, count in batches) == 80


def test_orders_and_details_are_replayed_up_to_the_same_times(spark, rows, tmp_path):
    day = "date_add(date'2024-01-01', cast({} as int))"
    orders = spark.range(60).selectExpr(
        "id as o_orderkey", "id as o_custkey", "'O' as o_orderstatus", "1.0d as o_totalprice",
        f"if(id = 7, null, to_timestamp_ntz({day.format('id')})) as o_orderdate",
    )
    lines = spark.range(60).selectExpr(
        "id as l_orderkey", "id as l_partkey", "2.0d as l_quantity", "3.0d as l_extendedprice",
        f"if(id = 9, null, to_timestamp_ntz({day.format('2 * id')})) as l_shipdate",
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    replay = Replay(spark, str(tmp_path))
    *_, parts = replay.timed_orders()
    for add in parts:
        add()
    at = {"orders": "o_orderdate", "lines": "l_shipdate"}
    written = {k: spark.read.parquet(replay.root(k)).select("step", F.col(c).alias("at")) for k, c in at.items()}
    assert {k: w.count() for k, w in written.items()} == {"orders": 60, "lines": 60}
    both = written["orders"].unionByName(written["lines"])
    edges = rows(both.groupBy("step").agg(F.min("at"), F.max("at")))
    edges.sort()
    assert len(edges) > 2
    assert all(one[2] < two[1] for one, two in zip(edges, edges[1:]))
