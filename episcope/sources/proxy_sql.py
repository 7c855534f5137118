"""ANSI SQL twins of the proxy tables and of the shared expressions, for the
DuckDB oracle (views region nation customer ... are registered by the checker).

Each constant is a SELECT usable as a CTE body.
"""

from __future__ import annotations

from episcope.functions.text import TAG_PATTERN, URL_PATTERN, WHITESPACE_CLASS
from episcope.sources.proxy import PROXY_KEYWORDS, SCORE_CHARS, SOCIAL_SHIFT_DAYS


def r_half_up(expr: str, digits: int) -> str:
    s = f"1e{digits}"
    return f"(cast(floor(({expr}) * {s} + 0.5) as double) / {s})"


def clean_text_sql(expr: str) -> str:
    t = f"regexp_replace({expr}, '{URL_PATTERN}', '', 'g')"
    t = f"regexp_replace({t}, '{TAG_PATTERN}', '', 'g')"
    t = f"regexp_replace({t}, '{WHITESPACE_CLASS}+', ' ', 'g')"
    return f"lower(trim({t}))"


def keywords_sql(expr: str, keywords) -> str:
    arr = "[" + ", ".join(f"'{k}'" for k in keywords) + "]"
    return (f"(case when {expr} is null then null else "
            f"list_filter({arr}, lambda k: instr(lower({expr}), k) > 0) end)")


SURV = """
select o.o_orderpriority as disease, r.r_name as region,
       cast(date_trunc('week', o.o_orderdate) as date) as date,
       count(*) as cases,
       cast(sum(case when o.o_orderstatus = 'F' then 1 else 0 end) as bigint) as deaths,
       cast(sum(case when o.o_orderstatus = 'P' then 1 else 0 end) as bigint) as hospitalizations
from orders o join customer c on o.o_custkey = c.c_custkey
join nation n on c.c_nationkey = n.n_nationkey
join region r on n.n_regionkey = r.r_regionkey
group by 1, 2, 3"""

ENV = """
select cast(l_shipdate as date) as date, avg(l_quantity) as temperature,
       avg(l_discount) * 100 as humidity, avg(l_tax) * 100 as precipitation,
       avg(l_extendedprice) / 1000 as air_quality_index, count(*) as uv_index
from lineitem group by 1"""

SOCIAL = f"""
select event_id as id, event_type as platform,
       ts - interval {SOCIAL_SHIFT_DAYS} day as created_at,
       (value - 50) / 50 as polarity, value / 100 as subjectivity, value as engagement_score
from events"""

SOCIAL_TEXT = f"""
select s.*, s.raw_text_ as raw_text, {clean_text_sql('s.raw_text_')} as text,
       {keywords_sql(clean_text_sql('s.raw_text_'), PROXY_KEYWORDS)} as symptoms
from (select e.*, d.text as raw_text_ from ({SOCIAL}) e left join documents d on e.id = d.doc_id) s"""

SCORED = f"""
select l.doc_id, cast(l.quality as integer) as label,
       least(d.n_chars / {SCORE_CHARS}, 1.0) as score,
       cast(least(d.n_chars / {SCORE_CHARS}, 1.0) > 0.5 as integer) as prediction
from labels l join documents d on l.doc_id = d.doc_id"""

# outbreak label: cases above the per-disease 85th percentile (linear interpolation)
SURV_LABELLED = f"""
select s.*, t.outbreak_threshold, cast(s.cases > t.outbreak_threshold as integer) as outbreak
from ({SURV}) s left join (
  select disease, quantile_cont(cast(cases as double), 0.85) as outbreak_threshold
  from ({SURV}) group by disease) t using (disease)"""


def canon_sql(sql: str, double_cols, digits: int = 6) -> str:
    """Wrap ``sql`` so the listed double columns are rounded like ``canon`` does."""
    if not double_cols:
        return sql
    repl = ", ".join(f"{_canon_expr(c, digits)} as {c}" for c in double_cols)
    return f"select * replace ({repl}) from ({sql}) q"


def _canon_expr(c: str, digits: int) -> str:
    s = f"1e{digits}"
    return (f"(case when abs({c}) < 1e9 then cast(floor({c} * {s} + 0.5) as double) / {s} "
            f"else {c} end)")

TWEETS = f"""
select d.doc_id as id, d.text, e.ts - interval {SOCIAL_SHIFT_DAYS} day as created_at,
       cast(floor(e.value) as bigint) as retweet_count, e.user_id as like_count,
       cast(e.user_id as varchar) as author_id
from documents d join events e on d.doc_id = e.event_id"""

REDDIT = f"""
select 'r' || cast(c.conv_id as varchar) || '_' || cast(c.turn as varchar) as id, c.role as title,
       c.text as selftext, c.turn as score, e.value / 500 as upvote_ratio, c.turn as num_comments,
       cast(floor(epoch(e.ts - interval {SOCIAL_SHIFT_DAYS} day)) as bigint) + c.turn as created_utc,
       e.event_type as subreddit, case when c.role = 'user' then cast(e.user_id as varchar) end as author
from conversations c join events e on c.conv_id = e.event_id"""
