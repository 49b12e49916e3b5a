from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import event_time
from tidemark.operators import bounce, stats, visitors
from tidemark.plans import jobs

DAY = 86_400_000
T0 = 1_704_067_200_000
PAGE = (
    "id bigint, mid string, ar string, ch string, vc string, is_new string, "
    "page_id string, last_page_id string, during_time bigint, ts bigint"
)


def pages(rows, *given_rows):
    """Page views from ``(mid, last_page_id, ts)``."""
    data = [
        (i, mid, "ar", "ch", "vc", "1", "p", last, 10, ts)
        for i, (mid, last, ts) in enumerate(given_rows)
    ]
    return rows(data, PAGE).withColumn("day", F.to_date(event_time(F.col("ts"))))


def ids(rows, df):
    return [r[0] for r in rows(df.select("id"))]


def test_entry_pages(rows):
    df = pages(rows, ("a", None, T0), ("a", "", T0), ("a", "home", T0))
    assert ids(rows, visitors.entry_pages(df)) == [0, 1]


def test_unique_visits_are_first_of_the_day(rows):
    df = pages(
        rows,
        ("a", "home", T0),
        ("a", None, T0 + 9),
        ("a", None, T0 + 8),
        ("a", None, T0 + 8),
        ("a", None, T0 + DAY),
        ("b", None, T0 + DAY - 1),
        ("a", None, T0 + 7),
    )
    assert ids(rows, visitors.unique_visits(df)) == [4, 5, 6]


def test_bounce_boundaries(rows):
    for gap, bounced in ((9_999, [1]), (10_000, [0, 1]), (10_001, [0, 1])):
        df = pages(rows, ("a", None, T0 + 4_321), ("a", None, T0 + 4_321 + gap))
        assert ids(rows, bounce.bounces(df)) == bounced


def test_bounce_needs_an_entry_page_and_any_successor(rows):
    df = pages(
        rows,
        ("a", "home", T0),  # not an entry page
        ("b", None, T0),
        ("b", "home", T0 + 500),  # follows, and is no entry page
        ("c", None, T0),
        ("d", None, T0 + 1),  # another device does not follow
        ("e", "", T0),
        ("e", "", T0),  # same time: the first of them is followed
    )
    assert ids(rows, bounce.bounces(df)) == [3, 4, 6]


def test_bounce_with_another_first_condition(rows):
    df = pages(rows, ("a", "home", T0), ("b", None, T0))
    assert ids(rows, bounce.bounces(df, first=F.col("last_page_id") == "home")) == [0]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b"]),
            st.sampled_from([None, "", "home"]),
            st.sampled_from([0, 1, 3, 4, 5, 6, 7, 13]),
        ),
        min_size=1,
        max_size=40,
    ),
    st.sampled_from([1, 5, 6]),
)
def test_bounces_equal_the_window_function_form(rows, visits, within):
    ts, data = T0, []
    for mid, last, gap in visits:
        ts += gap
        data.append((mid, last, ts))
    df = pages(rows, *data)
    order = W.partitionBy("mid").orderBy("ts", "id")
    following = df.withColumn("n", F.lead("ts").over(order))
    expected = following.filter(visitors.is_entry() & (F.col("n").isNull() | (F.col("n") - F.col("ts") >= within)))
    assert ids(rows, bounce.bounces(df, within)) == ids(rows, expected)


def test_measures_add_up_in_windows(rows):
    df = pages(rows, ("a", None, T0), ("a", "home", T0 + 9_999), ("a", None, T0 + 30_000), ("b", None, T0 + 1))
    df = df.withColumn("during_time", F.when(F.col("id") > 0, F.col("during_time")))
    got = rows(jobs.visitor_stats(df).drop("ts"))
    dims = ("vc", "ch", "ar", "1")
    assert got == [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:10", *dims, 2, 3, 2, 1, 20),
        ("2024-01-01 00:00:30", "2024-01-01 00:00:40", *dims, 0, 1, 1, 1, 10),
    ]
    assert jobs.visitor_stats(df).columns[-1] == "ts"


def test_separate_and_joint_page_measures_agree(rows):
    df = pages(rows, ("a", None, T0), ("a", "home", T0 + 5), ("b", "", T0 + 20_000))
    apart = stats.union_measures(stats.page_view_measures(df), stats.session_measures(df))
    joint = stats.page_measures(df)
    assert rows(stats.visitor_stats(apart).drop("ts")) == rows(stats.visitor_stats(joint).drop("ts"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_devices_combine_before_the_shuffle(rows):
    df = pages(rows, ("a", None, T0))
    assert "row_number(), 1, Partial" in plan(visitors.unique_visits(df))
    assert "partial_max_by" in plan(bounce.bounces(df))
    assert "partial_sum" in plan(stats.visitor_stats(stats.page_measures(df)))
