"""Registered exploration queries over the derived ratings / users / movies."""

from __future__ import annotations

from ..operators import daily as D
from ..operators import explore as X
from ..session import scratch_path
from ..sources.fixtures import load_fixture
from .registry import (age_idx_sql, age_label_sql, occupation_label_sql, register, sql_str,
                       sql_with)
from .. import schema

# The fixture has no movie with 200 ratings; its leaderboard uses 30 (FIXTURES.md 3).
FIXTURE_MIN_RATINGS = 30

_SIZES = ("sizes", "select 'user' as entity, count(*) as n from ratings group by user_id "
                   "union all select 'movie', count(*) from ratings group by movie_id")

_STATS = ("stats", "select movie_id, cast(count(*) as bigint) as rating_count, "
                   "avg(cast(rating as double)) as mean_rating from ratings group by movie_id")


def _stats_body(where: str, order: str) -> str:
    return f"""
select s.movie_id, m.title, m.genres, s.rating_count, round(s.mean_rating, 6) as mean_rating
from (select * from stats {where} {order}) s left join movies m on s.movie_id = m.movie_id"""


@register("table_counts", sql_with(["ratings", "users", "movies"], body="""
select 'ratings' as table_name, cast(count(*) as bigint) as n from ratings
union all select 'users', cast(count(*) as bigint) from users
union all select 'movies', cast(count(*) as bigint) from movies"""))
def q_table_counts(spark, sf_dir):
    return X.table_counts(*load_fixture(spark, sf_dir))


_SUMMARY = sql_with(["ratings"], body="""
select cast(count(*) as bigint) as n_ratings,
  cast(count(distinct user_id) as bigint) as n_users,
  cast(count(distinct movie_id) as bigint) as n_movies,
  round(avg(cast(rating as double)), 6) as rating_mean,
  cast(median(cast(rating as double)) as double) as rating_median,
  cast(epoch_ms(min(ts) * 1000) as date) as first_date,
  cast(epoch_ms(max(ts) * 1000) as date) as last_date
from ratings""")


@register("dataset_summary", _SUMMARY)
def q_dataset_summary(spark, sf_dir):
    return X.dataset_summary(load_fixture(spark, sf_dir).ratings)


@register("dataset_summary_sketched", _SUMMARY)
def q_dataset_summary_sketched(spark, sf_dir):
    """From a table of yearly sketches that is written first; 2^18 slots tell the fixture's users and movies apart exactly."""
    path = scratch_path(spark, "daily")
    D.add_days(path, load_fixture(spark, sf_dir).ratings, lg_k=18, period="year")
    return D.sketched_summary(D.read_days(spark, path))


@register("rating_distribution", sql_with(["ratings"], body="""
select cast(rating as double) as rating, cast(count(*) as bigint) as n from ratings group by 1"""))
def q_rating_distribution(spark, sf_dir):
    return X.rating_distribution(load_fixture(spark, sf_dir).ratings)


@register("activity_per_user", sql_with(["ratings"], body="""
select user_id, cast(count(*) as bigint) as n_ratings from ratings group by user_id"""))
def q_activity_per_user(spark, sf_dir):
    return X.activity_per_user(load_fixture(spark, sf_dir).ratings)


@register("activity_per_movie", sql_with(["ratings"], body="""
select movie_id, cast(count(*) as bigint) as n_ratings from ratings group by movie_id"""))
def q_activity_per_movie(spark, sf_dir):
    return X.activity_per_movie(load_fixture(spark, sf_dir).ratings)


@register("describe_counts", sql_with(["ratings"], [_SIZES], body="""
select entity, cast(count(*) as bigint) as "count", round(avg(n), 6) as "mean",
  round(stddev_samp(n), 6) as "std", cast(min(n) as double) as "min",
  round(quantile_cont(n, 0.25), 6) as p25, round(quantile_cont(n, 0.5), 6) as p50,
  round(quantile_cont(n, 0.75), 6) as p75, cast(max(n) as double) as "max"
from sizes group by entity"""))
def q_describe_counts(spark, sf_dir):
    return X.describe_counts(load_fixture(spark, sf_dir).ratings)


@register("activity_histogram", sql_with(["ratings"], [
    _SIZES,
    ("rng", """select entity,
        case when min(n) = max(n) then min(n) - 0.5 else cast(min(n) as double) end as lo,
        case when min(n) = max(n) then max(n) + 0.5 else cast(max(n) as double) end as hi
      from sizes group by entity"""),
    ("counted", """select s.entity,
        cast(least(floor((cast(s.n as double) - r.lo) * cast(50 as double) / (r.hi - r.lo)), 49) + 1 as integer) as bin,
        cast(count(*) as bigint) as n
      from sizes s join rng r on s.entity = r.entity group by 1, 2"""),
    ("grid", "select entity, lo, hi, cast(unnest(range(1, 51)) as integer) as bin from rng"),
], body="""
select g.entity, g.bin,
  round(g.lo + (g.bin - 1) * ((g.hi - g.lo) / cast(50 as double)), 6) as bin_lo,
  round(g.lo + g.bin * ((g.hi - g.lo) / cast(50 as double)), 6) as bin_hi,
  cast(coalesce(c.n, 0) as bigint) as n
from grid g left join counted c on g.entity = c.entity and g.bin = c.bin"""))
def q_activity_histogram(spark, sf_dir):
    return X.activity_histogram(load_fixture(spark, sf_dir).ratings)


@register("movie_stats", sql_with(["ratings", "movies"], [_STATS], body=_stats_body("", "")))
def q_movie_stats(spark, sf_dir):
    t = load_fixture(spark, sf_dir)
    return X.movie_stats_report(t.ratings, t.movies)


@register("most_rated", sql_with(["ratings", "movies"], [_STATS], body=_stats_body(
    "", "order by rating_count desc, movie_id limit 15")))
def q_most_rated(spark, sf_dir):
    t = load_fixture(spark, sf_dir)
    return X.most_rated(t.ratings, t.movies, 15)


@register("highest_rated", sql_with(["ratings", "movies"], [_STATS], body=_stats_body(
    f"where rating_count >= {FIXTURE_MIN_RATINGS}",
    "order by mean_rating desc, rating_count desc, movie_id limit 15")))
def q_highest_rated(spark, sf_dir):
    t = load_fixture(spark, sf_dir)
    return X.highest_rated(t.ratings, t.movies, 15, min_ratings=FIXTURE_MIN_RATINGS)


@register("genre_counts", sql_with(["movies"], body="""
select genre, cast(count(*) as bigint) as movie_count
from (select unnest(string_split(genres, '|')) as genre from movies)
where genre is not null and genre <> '' group by genre"""))
def q_genre_counts(spark, sf_dir):
    return X.genre_counts(load_fixture(spark, sf_dir).movies)


_AGE_DIM = ", ".join(f"({i}, {sql_str(lab)})" for i, lab in enumerate(schema.AGE_LABELS))


@register("users_by_age", sql_with(["users"], [
    ("dim", f"select * from (values {_AGE_DIM}) t(age_idx, age_label)"),
    ("counts", f"""select {age_idx_sql('age')} as age_idx, cast(count(*) as bigint) as n_users
       from users where age in ({', '.join(str(c) for c in schema.AGE_CODES)}) group by 1"""),
], body="""
select cast(d.age_idx as integer) as age_idx, d.age_label, c.n_users
from dim d left join counts c on d.age_idx = c.age_idx"""))
def q_users_by_age(spark, sf_dir):
    return X.users_by_age(load_fixture(spark, sf_dir).users)


@register("top_occupations", sql_with(["users"], [
    ("counts", f"""select occupation, {occupation_label_sql('occupation')} as occupation_label,
        cast(count(*) as bigint) as n_users from users
      where occupation between 0 and {schema.NUM_OCCUPATION - 1} group by 1, 2"""),
], body="select * from counts order by n_users desc, occupation limit 12"))
def q_top_occupations(spark, sf_dir):
    return X.top_occupations(load_fixture(spark, sf_dir).users, 12)


@register("users_labelled", sql_with(["users"], body=f"""
select user_id, gender, {age_label_sql('age')} as age_label,
  {occupation_label_sql('occupation')} as occupation_label, zip from users"""))
def q_users_labelled(spark, sf_dir):
    return X.users_labelled(load_fixture(spark, sf_dir).users)


@register("monthly_ratings", sql_with(["ratings"], [
    ("by_month", """select last_day(cast(epoch_ms(ts * 1000) as date)) as month_end,
        cast(count(*) as bigint) as n_ratings from ratings group by 1"""),
    ("months", """select last_day(cast(m as date)) as month_end from (
        select unnest(generate_series(
          date_trunc('month', cast(epoch_ms(min(ts) * 1000) as date)),
          date_trunc('month', cast(epoch_ms(max(ts) * 1000) as date)),
          interval 1 month)) as m from ratings)"""),
], body="""
select mo.month_end, cast(coalesce(b.n_ratings, 0) as bigint) as n_ratings
from months mo left join by_month b on mo.month_end = b.month_end"""))
def q_monthly_ratings(spark, sf_dir):
    return X.monthly_ratings(load_fixture(spark, sf_dir).ratings)
