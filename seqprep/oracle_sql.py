"""SQL building blocks for the DuckDB value oracles.

The oracles restate each query in plain SQL over the same test tables.
Sequences are kept in long form -- one row per point with its position --
and order-dependent steps use window functions, so the oracle is an
independent formulation of the array kernels, not a copy of them.
"""

from __future__ import annotations

# Fixed values shared with seqprep.sources.fixtures.
CODE_CASE = (
    "CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 "
    "WHEN 'signup' THEN 3 WHEN 'view' THEN 4 END"
)
SPORT_CASE = (
    "CASE {x} WHEN 'signup' THEN 'bike' WHEN 'purchase' THEN 'run' WHEN 'click' THEN 'walk' "
    "WHEN 'view' THEN 'hiking' WHEN 'error' THEN 'kayaking' END"
)
GENDER_CASE = "CASE user_id % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'unknown' END"

EV = """ev AS (
  SELECT event_id AS e, user_id, event_type, day(ts)::BIGINT AS d,
         floor(epoch(ts))::BIGINT AS t,
         40::DOUBLE + (event_id*7919 % 10000)/100000::DOUBLE AS lat,
         10::DOUBLE + (event_id*104729 % 10000)/100000::DOUBLE AS lon,
         (60::DOUBLE + (event_id*31 % 120))::DOUBLE AS hr,
         value::DOUBLE AS alt
  FROM events)"""

# points of seq_type: one row per point, pos 0-based, n = sequence length
PT_TYPE = f"""pt AS (
  SELECT user_id*10 + {CODE_CASE} AS id, user_id AS userId,
         {SPORT_CASE.format(x='event_type')} AS sport, {GENDER_CASE} AS gender,
         e, t, lat, lon, hr, alt,
         (row_number() OVER (PARTITION BY user_id, event_type ORDER BY t, e) - 1)::BIGINT AS pos,
         count(*) OVER (PARTITION BY user_id, event_type)::BIGINT AS n
  FROM {{src}})"""

PT_DAY = f"""pt AS (
  SELECT user_id*100 + d AS id, user_id AS userId,
         {SPORT_CASE.format(x='first_value(event_type) OVER (PARTITION BY user_id, d ORDER BY t, e)')} AS sport,
         {GENDER_CASE} AS gender,
         e, t, lat, lon, hr, alt,
         (row_number() OVER (PARTITION BY user_id, d ORDER BY t, e) - 1)::BIGINT AS pos,
         count(*) OVER (PARTITION BY user_id, d)::BIGINT AS n
  FROM {{src}})"""

VEC = """vec AS (
  SELECT vec_id::BIGINT AS id, label::BIGINT AS userId,
         CASE label % 3 WHEN 0 THEN 'biking' WHEN 1 THEN 'running' WHEN 2 THEN 'walking' END AS sport,
         list_transform(embedding, lambda x: x::DOUBLE) AS y
  FROM embeddings)"""

VEC_PT = """vpt AS (
  SELECT id, userId, sport, (generate_subscripts(y, 1) - 1)::BIGINT AS pos, unnest(y) AS y, len(y)::BIGINT AS n
  FROM vec)"""


def pt_type(src: str = "ev") -> str:
    return PT_TYPE.format(src=src)


def pt_day(src: str = "ev") -> str:
    return PT_DAY.format(src=src)


def seq_of(pt: str = "pt", name: str = "seq", extra: str = "") -> str:
    """Array form of a point CTE (lists ordered by position)."""
    return f"""{name} AS (
  SELECT id, any_value(userId) AS userId, any_value(sport) AS sport, any_value(gender) AS gender,
         list(t ORDER BY pos) AS timestamp, list(e ORDER BY pos) AS eid,
         list(hr ORDER BY pos) AS heart_rate, list(lon ORDER BY pos) AS longitude,
         list(lat ORDER BY pos) AS latitude, list(alt ORDER BY pos) AS altitude{extra}
  FROM {pt} GROUP BY id)"""


def hav_km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Step distance in km by the usual haversine formula."""
    p1, l1, p2, l2 = (f"radians({x})" for x in (lat1, lon1, lat2, lon2))
    a = f"(pow(sin(({p2}-{p1})/2),2) + cos({p1})*cos({p2})*pow(sin(({l2}-{l1})/2),2))"
    return f"(CASE WHEN isnan({a}) THEN 'nan'::DOUBLE ELSE 2*6371.0*asin(least(1.0, sqrt({a}))) END)"


def hav_m(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    p1, l1, p2, l2 = (f"radians({x})" for x in (lat1, lon1, lat2, lon2))
    a = f"(pow(sin(({p2}-{p1})/2),2) + cos({p1})*cos({p2})*pow(sin(({l2}-{l1})/2),2))"
    return f"(atan2(sqrt({a}), sqrt(1-{a}))*2*6378137.0)"


def derived(pt: str = "pt", name: str = "dp") -> str:
    """Per point: elapsed time, step distance and speed, by window lag."""
    return f"""{name}0 AS (
  SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon, lag(t) OVER w AS pt_,
         first_value(t) OVER w AS t0
  FROM {pt} WINDOW w AS (PARTITION BY id ORDER BY pos)),
{name}1 AS (
  SELECT *, t - t0 AS te,
         CASE WHEN pos = 0 THEN 0.0 ELSE {hav_km('plat', 'plon', 'lat', 'lon')} END AS dist,
         CASE WHEN pos = 0 THEN (1e-6)::FLOAT::DOUBLE ELSE (t - pt_)::FLOAT::DOUBLE END AS dt
  FROM {name}0),
{name} AS (
  SELECT *, CASE WHEN dt = 0 THEN (CASE WHEN isnan(dist) OR dist = 0 THEN 'nan'::DOUBLE
                                        WHEN dist > 0 THEN 'inf'::DOUBLE ELSE '-inf'::DOUBLE END)
                 ELSE dist / dt * 3600 END AS speed
  FROM {name}1)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def r6(x: str) -> str:
    return f"round({x}, 6)"


def md5_u32(key: str, first: int = 1) -> str:
    """32-bit draw from hex digits ``first..first+7`` of md5(key)."""
    return f"('0x' || substr(md5({key}), {first}, 8))::BIGINT"


def key(*parts: str) -> str:
    return "concat_ws('|', " + ", ".join(f"({p})::VARCHAR" for p in parts) + ")"
