"""Registered queries for request validation, candidates and recommendation."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema
from ..operators import recommend as R
from ..session import scratch_path
from ..sources.fixtures import load_fixture, load_requests
from ..streaming.recommend_stream import run_recommend_stream
from ..model.score import score_sql
from .q_model import fixed_model, trained_model
from .registry import (age_idx_sql, gender_idx_sql, genre_flags_sql, genre_mask_sql, genre_parts_sql, register, sql_str,
                       sql_with, zip_idx_sql, age_label_sql, occupation_label_sql)

_KNOWN = "[" + ", ".join(sql_str(g) for g in schema.GENRES) + "]"
_REQ = ("req", f"""select *,
    case when genres is null or genres = '' then cast([] as varchar[]) else string_split(genres, '|') end as glist,
    coalesce(top_n, {schema.DEFAULT_TOP_N}) as top_n_eff from requests""")
_UNKNOWN = f"list_filter(glist, lambda g: not list_contains({_KNOWN}, g))"
_CHECKED = ("checked", f"""select *, case
    when occupation is null or occupation not between 0 and {schema.NUM_OCCUPATION - 1} then 'occupation_range'
    when len(glist) not between 1 and {schema.MAX_REQUEST_GENRES} then 'genre_count'
    when top_n_eff not between {schema.MIN_TOP_N} and {schema.MAX_TOP_N} then 'top_n_range'
    when gender is null or gender not in ('M', 'F') then 'gender_unknown'
    when age is null or age not in ({', '.join(str(c) for c in schema.AGE_CODES)}) then 'age_unknown'
    when zip_code is null then 'zip_missing'
    when len({_UNKNOWN}) > 0 then 'genre_unknown' end as reject_reason,
    array_to_string({_UNKNOWN}, ',') as unknown_genres from req""")
_MV = ("mv", f"select movie_id, title, genres, {genre_parts_sql('genres')} as gset from movies")
_CAND = ("cand", """select c.rk, c.request_id, c.top_n_eff as top_n, c.gender, c.age, c.occupation, c.zip_code,
    m.movie_id, m.title, m.genres, m.gset
  from checked c join mv m on len(list_intersect(c.glist, m.gset)) > 0
  where c.reject_reason is null""")


@register("validate_requests", sql_with(["requests"], [_REQ, _CHECKED], body="""
select request_id, reject_reason, unknown_genres from checked"""))
def q_validate_requests(spark, sf_dir):
    return R.validate_requests(load_requests(spark, sf_dir)).select("request_id", "reject_reason", "unknown_genres")


@register("candidates", sql_with(["requests", "movies"], [_REQ, _CHECKED, _MV, _CAND], body="""
select c.request_id, count(cand.movie_id) as n_candidates
from checked c left join cand on c.rk = cand.rk where c.reject_reason is null group by c.rk, c.request_id"""))
def q_candidates(spark, sf_dir):
    return R.candidate_counts(load_requests(spark, sf_dir), load_fixture(spark, sf_dir).movies)


_MASK = " + ".join(f"{1 << i} * (case when list_contains(glist, {sql_str(g)}) then 1 else 0 end)" for i, g in enumerate(schema.GENRES))


@register("candidate_links", sql_with(["requests", "movies"], [_REQ, _CHECKED, _MV, ("r", f"select request_id, cast({_MASK} as bigint) as mask from checked where reject_reason is null"),
    ("m", f"select movie_id, cast({genre_mask_sql('gset')} as bigint) as mask from mv")], body="""
select distinct 'link' as kind, r.mask as id, m.mask from r join m on (r.mask & m.mask) <> 0
union all select 'request', request_id, mask from r union all select 'movie', movie_id, mask from m where mask <> 0"""))
def q_candidate_links(spark, sf_dir):
    return R.candidate_links(load_requests(spark, sf_dir), load_fixture(spark, sf_dir).movies)


@register("profile_labels", sql_with(["requests"], body=f"""
select request_id, case gender when 'M' then 'Male' when 'F' then 'Female' end as gender,
  {age_label_sql('age')} as age, {occupation_label_sql('occupation')} as occupation, zip_code,
  array_to_string(case when genres is null or genres = '' then cast([] as varchar[])
                  else string_split(genres, '|') end, ',') as genre_list
from requests"""))
def q_profile_labels(spark, sf_dir):
    out = R.profile_labels(load_requests(spark, sf_dir))
    return out.withColumn("genre_list", F.array_join("genre_list", ","))


def _recommend_oracle(model_type: str, tickets: bool = False) -> str:
    flags = ", ".join(f"cast({f} as double) as g{i}" for i, f in enumerate(genre_flags_sql("gset")))
    inner = (f"select rk, request_id, top_n, movie_id, title, genres, {gender_idx_sql('gender')} as gender_idx, "
             f"{age_idx_sql('age')} as age_idx, occupation as occ_idx, {zip_idx_sql('zip_code')} as zip_idx, "
             f"{flags} from cand")
    scored = ("scored", score_sql(fixed_model(model_type), inner))
    ranked = ("ranked", """select rk, request_id, top_n, movie_id, title, genres, score,
        row_number() over (partition by rk order by score desc, movie_id) as rn from scored""")
    sel = ("select request_id, cast(rn as integer) as rank, movie_id, title, genres, "
           "round_even(score, 3) as predicted_rating")
    if tickets:
        sel += (", lpad(cast(rn as varchar), 2, '0') as rank_label, "
                "array_to_string(list_transform(string_split(genres, '|'), lambda x: trim(x)), ' · ') as genre_label, "
                "least(greatest(round_even(score, 3) / 5.0 * 100.0, 0.0), 100.0) as star_pct, "
                "printf('%.1f', round_even(score, 3)) as score_label")
    return sql_with(["requests", "movies"], [_REQ, _CHECKED, _MV, _CAND, scored, ranked],
                    body=f"{sel} from ranked where rn <= top_n")


@register("recommend_fixed", _recommend_oracle("ncf"))
def q_recommend_fixed(spark, sf_dir):
    return R.recommend(load_requests(spark, sf_dir), load_fixture(spark, sf_dir).movies, fixed_model("ncf"))


@register("recommend_neumf_fixed", _recommend_oracle("neumf"))
def q_recommend_neumf_fixed(spark, sf_dir):
    return R.recommend(load_requests(spark, sf_dir), load_fixture(spark, sf_dir).movies, fixed_model("neumf"))


@register("recommend_tickets", _recommend_oracle("ncf", tickets=True))
def q_recommend_tickets(spark, sf_dir):
    return R.recommend(load_requests(spark, sf_dir), load_fixture(spark, sf_dir).movies, fixed_model("ncf"),
                       with_tickets=True)


@register("recommend_trained")
def q_recommend_trained(spark, sf_dir):
    model, _ = trained_model(spark, sf_dir, "ncf")
    return R.recommend(load_requests(spark, sf_dir), load_fixture(spark, sf_dir).movies, model)


_RESPONSES = """
select c.request_id, case when c.reject_reason is not null then 'rejected' when coalesce(a.n, 0) > 0 then 'answered' else 'empty' end as status,
  c.reject_reason, {gender} as gender_label, {age} as age_label, {occupation} as occupation_label,
  case when c.reject_reason is null then coalesce(a.n, 0) else 0 end as n_items, a.ids
from checked c left join (select rk, count(*) as n, string_agg(cast(movie_id as varchar), ',' order by rn) as ids
  from ranked where rn <= top_n group by rk) a on c.rk = a.rk"""


def _responses_oracle() -> str:
    text = _recommend_oracle("ncf")
    return text[:text.rindex("\nselect request_id, cast(rn")] + _RESPONSES.format(
        gender="case c.gender when 'M' then 'Male' when 'F' then 'Female' end", age=age_label_sql("c.age"),
        occupation=occupation_label_sql("c.occupation"))


def _flat(responses):
    ids = F.when(F.size("items") > 0, F.array_join(F.transform("items", lambda i: i["movie_id"].cast("string")), ","))
    return responses.select("request_id", "status", "reject_reason", "gender_label", "age_label", "occupation_label",
                            F.size("items").cast("bigint").alias("n_items"), ids.alias("ids"))


@register("recommend_responses", _responses_oracle())
def q_recommend_responses(spark, sf_dir):
    """Answered, empty and rejected requests, one row each."""
    return _flat(R.recommend_responses(load_requests(spark, sf_dir), load_fixture(spark, sf_dir).movies, fixed_model("ncf")))


@register("recommend_stream", _responses_oracle())
def q_recommend_stream(spark, sf_dir):
    """The fixture requests written as JSON files and consumed as a stream; returns every response the sink wrote."""
    req_dir = scratch_path(spark, "requests-json")
    load_requests(spark, sf_dir).repartition(4).write.json(req_dir)
    movies = load_fixture(spark, sf_dir).movies
    return _flat(run_recommend_stream(spark, req_dir, movies, fixed_model("ncf"), scratch_path(spark, "recommend-stream-out")))
