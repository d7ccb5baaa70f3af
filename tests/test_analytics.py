import itertools

from hypothesis import given, settings, strategies as st

from fixtures import obs_frame, obs_row
from trendlens import plans
from trendlens.operators import tag_pairs, top_k, top_k_with_ties


def test_moving_average_is_row_based(spark):
    days = [1, 2, 3, 4, 5, 6, 8, 9]  # day 7 missing: the 7-row frame ending on day 8 spans 8 days
    rows = [obs_row(video=f"v{d}", day=d, views=d * 10) for d in days]
    out = {str(r["trending_date"]): r for r in plans.popularity_over_time(obs_frame(spark, rows)).collect()}
    assert out["2026-01-08"]["moving_avg_7d"] == sum([10, 20, 30, 40, 50, 60, 80]) / 7
    assert out["2026-01-09"]["moving_avg_7d"] == sum([20, 30, 40, 50, 60, 80, 90]) / 7
    assert out["2026-01-01"]["video_count"] == 1 and out["2026-01-01"]["total_views"] == 10


def test_view_change_retitled_video_not_duplicated(spark):
    rows = [obs_row(video="v1", day=1, views=10, title="old"),
            obs_row(video="v1", day=2, views=15, title="new"),
            obs_row(video="v1", day=3, views=30, title="new"),
            obs_row(video="v2", day=1, views=5)]
    out = plans.view_count_change_per_day(obs_frame(spark, rows), region="US").collect()
    v1 = [r for r in out if r["video_id"] == "v1"]
    assert len(v1) == 3
    assert [r["previous_day_views"] for r in v1] == [None, 10, 15]
    assert [r["views_difference"] for r in v1] == [None, 5, 15]


def test_fastest_growth_of_fewer_items_than_k(spark):
    """Two items, retitled daily: every (item, title) with a growth has a place in the top 20."""
    rows = [obs_row(video=v, day=d, views=f * d * d, title=f"{v} day {d}") for v, f in (("v1", 1), ("v2", 10))
            for d in range(1, 6)]
    out = plans.fastest_growth_videos(obs_frame(spark, rows))
    got = {(r["video_id"], r["title"]): r["max_daily_views_growth"] for r in out.collect()}
    assert got == {(v, f"{v} day {d}"): f * (2 * d - 1) for v, f in (("v1", 1), ("v2", 10)) for d in range(2, 6)}
    best = plans.fastest_growth_videos(obs_frame(spark, rows), k=2).collect()
    assert [r["title"] for r in best] == ["v2 day 5", "v2 day 4"]


def test_fastest_growth_with_ties_and_retitled_items(spark):
    """Few different growths, many ties, titles that change, an item without an id."""
    import random

    rng = random.Random(12)
    rows = [(rng.choice([None, *(f"v{i}" for i in range(12))]), rng.choice(["US", "DE"]), rng.randint(1, 9), rng.randint(0, 6),
             rng.choice("xyz")) for _ in range(260)]
    daily = {}
    for v, r, d, n, t in rows:
        old = daily.get((v, r, d), (n, t))
        daily[v, r, d] = (max(n, old[0]), max(t, old[1]))
    best = {}
    for (v, r, d), (n, t) in daily.items():
        if (v, r, d - 1) in daily and n >= daily[v, r, d - 1][0]:
            best[v, t] = max(best.get((v, t), 0), n - daily[v, r, d - 1][0])
    ranked = sorted(best.items(), key=lambda x: (-x[1], x[0][0] or "", x[0][1]))
    obs = obs_frame(spark, [obs_row(video=v, region=r, day=d, views=n, title=t) for v, r, d, n, t in rows])
    for k in (1, 3, 7, 100):
        got = [((r["video_id"], r["title"]), r["max_daily_views_growth"]) for r in plans.fastest_growth_videos(obs, k=k).collect()]
        assert got == ranked[:k]


def test_fastest_growth_gaps_and_bounds(spark):
    rows = [obs_row(video="a", day=1, views=100), obs_row(video="a", day=2, views=99),   # -1
            obs_row(video="b", day=1, views=100), obs_row(video="b", day=2, views=100),  # 0
            obs_row(video="c", day=1, views=0), obs_row(video="c", day=2, views=200_000_000),
            obs_row(video="d", day=1, views=0), obs_row(video="d", day=2, views=200_000_001),
            obs_row(video="e", day=1, views=0), obs_row(video="e", day=3, views=50),      # gap 2
            obs_row(video="f", day=1, views=0), obs_row(video="f", day=2, views=7),
            obs_row(video="f", day=2, views=9)]  # two rows on one day: max is used
    out = {r["video_id"]: r["max_daily_views_growth"]
           for r in plans.fastest_growth_videos(obs_frame(spark, rows)).collect()}
    assert out == {"b": 0, "c": 200_000_000, "f": 9}


def test_top_tags_edge_cases(spark):
    rows = [obs_row(tags="a|b"), obs_row(tags="a"), obs_row(tags=""), obs_row(tags="a||b"),
            obs_row(tags=None)]
    out = {r["tag"]: r["number_of_videos"] for r in plans.top_tags(obs_frame(spark, rows)).collect()}
    assert out == {"a": 3, "b": 2, "": 2}


def test_tag_combinations(spark):
    rows = []
    for i in range(20):  # pair a|b on 20 items, pair a|c on 19
        rows.append(obs_row(video=f"x{i}", tags="b|a" if i < 1 else "a|b", day=1))
        rows.append(obs_row(video=f"x{i}", tags="a|b", day=2))
    for i in range(19):
        rows.append(obs_row(video=f"y{i}", tags="c|a", day=1))
    rows.append(obs_row(video="single", tags="solo"))
    rows.append(obs_row(video="dup", tags="q|q"))
    out = {r["tag_pair"]: r for r in plans.top_tag_combinations(obs_frame(spark, rows)).collect()}
    assert set(out) == {"a|b"}
    assert out["a|b"]["video_count"] == 20 and out["a|b"]["average_trending_days"] == 2.0


def test_duplicated_tag_pairs(spark):
    df = obs_frame(spark, [obs_row(tags="q|q|r")])
    pairs = sorted(r["tag_pair"] for r in tag_pairs(df, "tags").collect())
    assert pairs == ["q|q", "q|r", "q|r"]
    distinct = sorted(r["tag_pair"] for r in tag_pairs(df, "tags", distinct_tags=True).collect())
    assert distinct == ["q|r"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdefgh"), min_size=0, max_size=6, unique=True),
                min_size=1, max_size=5))
def test_pairs_property(spark, tag_lists):
    rows = [obs_row(video=f"v{i}", tags="|".join(t)) for i, t in enumerate(tag_lists) if t]
    if not rows:
        return
    got = sorted(r["tag_pair"] for r in tag_pairs(obs_frame(spark, rows), "tags").collect())
    want = sorted(f"{a}|{b}" for t in tag_lists if t for a, b in itertools.combinations(sorted(t), 2))
    assert got == want


def test_day_of_week(spark):
    rows = [obs_row(day=4), obs_row(day=10)]  # 2026-01-04 is a Sunday, 2026-01-10 a Saturday
    out = {r["day_of_week"]: r["video_count"] for r in plans.trending_by_day_of_week(obs_frame(spark, rows)).collect()}
    assert out == {1: 1, 7: 1}


def test_duration_vs_popularity_edges(spark):
    rows = [obs_row(duration=239, views=1), obs_row(duration=240, views=2),
            obs_row(duration=1200, views=4), obs_row(duration=1201, views=8)]
    out = {r["duration_length"]: r["average_views"] for r in plans.duration_vs_popularity(obs_frame(spark, rows)).collect()}
    assert out == {"short (< 4 min)": 1.0, "medium (4-20 min)": 3.0, "long (> 20 min)": 8.0}


def test_top_k_ties_are_deterministic(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 5), ("d", 1)], "k string, v int")
    assert [r["k"] for r in top_k(df, "v", 2, ["k"]).collect()] == ["a", "b"]
    kept = sorted(r["k"] for r in top_k_with_ties(df, "v", 2).collect())
    assert kept == ["a", "b", "c"]
    assert sorted(r["k"] for r in top_k_with_ties(df, "v", 10).collect()) == ["a", "b", "c", "d"]


def test_categories_keep_both_comedy_codes(spark):
    rows = [obs_row(category=23), obs_row(category=34), obs_row(category=34)]
    df = obs_frame(spark, rows).drop("category_name")
    from trendlens.functions import category_name
    df = df.withColumn("category_name", category_name("category_id"))
    out = {r["category_id"]: r["number_of_videos"] for r in plans.top_categories(df).collect()}
    assert out == {23: 1, 34: 2}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdef"), min_size=1, max_size=5), min_size=1, max_size=30),
       st.integers(min_value=1, max_value=6), st.booleans())
def test_pruned_pairs_equal_unpruned(spark, tag_lists, min_videos, distinct):
    rows = [obs_row(video=f"v{i}", tags="|".join(t), day=1 + i % 3) for i, t in enumerate(tag_lists)]
    df = obs_frame(spark, rows)
    kw = dict(region="US", min_videos=min_videos, k=1000, distinct_tags=distinct)
    a = sorted(tuple(r) for r in plans.top_tag_combinations(df, prune=True, **kw).collect())
    b = sorted(tuple(r) for r in plans.top_tag_combinations(df, prune=False, **kw).collect())
    assert a == b


def test_pairs_ignore_rows_without_an_item(spark):
    from trendlens import plans
    from trendlens.sources import observations
    obs = observations(spark, "/root/testdata/sf0.001")
    want = plans.top_tag_combinations(obs, region="ASIA", min_videos=1).collect()
    lost = obs.limit(50).selectExpr(*[("cast(null as string) as video_id" if c == "video_id" else
                                       "'p|q' as tags" if c == "tags" else
                                       "'ASIA' as region_code" if c == "region_code" else c) for c in obs.columns])
    assert plans.top_tag_combinations(obs.unionByName(lost), region="ASIA", min_videos=1).collect() == want
