"""Registered queries: one per operator of the inventory, each with its SQL twin.

``QUERIES[name] = (build(spark, sf_dir) -> DataFrame, oracle SQL or None)``.
Every query reads the supplied tables (through the proxies) in full.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from episcope.functions.calendar import calendar_features
from episcope.operators.windows import label_outbreaks
from episcope.plans.canon import canon
from episcope.plans.features import prepare_ml_features
from episcope.session import cut_lineage
from episcope.sources import proxy
from episcope.sources import proxy_sql as Q

QUERIES: dict = {}


def register(name: str, sql: str | None = None, doubles=None):
    def deco(fn):
        def build(spark, sf):
            return canon(fn(spark, sf))
        build.__name__ = fn.__name__
        QUERIES[name] = (build, Q.canon_sql(sql, doubles or []) if sql else None)
        return fn
    return deco


# ----------------------------------------------------------------------------- flagship (ML16)

SOCIAL_DAILY_SQL = f"""
select cast(created_at as date) as date,
  {Q.r_half_up('avg(polarity)', 4)} as polarity_mean,
  {Q.r_half_up('stddev_samp(polarity)', 4)} as polarity_std,
  {Q.r_half_up('min(polarity)', 4)} as polarity_min,
  {Q.r_half_up('max(polarity)', 4)} as polarity_max,
  {Q.r_half_up('avg(subjectivity)', 4)} as subjectivity_mean,
  {Q.r_half_up('stddev_samp(subjectivity)', 4)} as subjectivity_std,
  {Q.r_half_up('sum(engagement_score)', 4)} as engagement_score_sum,
  {Q.r_half_up('avg(engagement_score)', 4)} as engagement_score_mean,
  {Q.r_half_up('max(engagement_score)', 4)} as engagement_score_max,
  count(id) as id_count
  {{extra}}
from ({{src}}) p where created_at is not null group by 1"""

SOCIAL_COLS = ["polarity_mean", "polarity_std", "polarity_min", "polarity_max", "subjectivity_mean",
               "subjectivity_std", "engagement_score_sum", "engagement_score_mean", "engagement_score_max"]
ENV_COLS = ["temperature", "humidity", "precipitation", "air_quality_index"]
SYMPTOMS_SUM = ", cast(sum(case when symptoms is null then 0 else len(symptoms) end) as bigint) as symptom_mentions"

FLAGSHIP_DOUBLES = (ENV_COLS + SOCIAL_COLS + ["cases_mean_4w", "cases_std_4w", "polarity_lag_1",
                    "sentiment_trend", "temp_humidity_interaction", "temp_squared",
                    "sentiment_symptoms_interaction", "avg_engagement_per_post"])


def _ffill(c, order="date, disease, region", fill="0"):
    w = f"(order by {order} rows between unbounded preceding and current row)"
    return f"coalesce(last_value({c} ignore nulls) over {w}, {fill}) as {c}"


FLAGSHIP_SQL = f"""
with s as (
  select *, cast(month(date) as integer) as month, cast(quarter(date) as integer) as quarter,
         cast(weekofyear(date) as integer) as week_of_year, cast(dayofyear(date) as integer) as day_of_year,
         cast(floor((month(date) % 12) / 3) as integer) as season
  from ({Q.SURV_LABELLED})),
sd as ({SOCIAL_DAILY_SQL.format(src=Q.SOCIAL_TEXT, extra=SYMPTOMS_SUM)}),
m as (select s.*, {', '.join('e.' + c for c in ENV_COLS + ['uv_index'])},
             {', '.join('sd.' + c for c in SOCIAL_COLS + ['id_count', 'symptom_mentions'])}
      from s left join ({Q.ENV}) e on s.date = e.date left join sd on s.date = sd.date),
f as (select disease, region, date, cases, deaths, hospitalizations, outbreak, outbreak_threshold,
             month, quarter, week_of_year, day_of_year, season,
             {', '.join(_ffill(c) for c in ENV_COLS + ['uv_index'] + SOCIAL_COLS + ['id_count', 'symptom_mentions'])}
      from m),
g as (select f.*,
        lag(cases, 1) over ws as cases_lag_1, lag(cases, 2) over ws as cases_lag_2,
        case when count(cases) over w4 >= 4 then avg(cases) over w4 end as cases_mean_4w,
        case when count(cases) over w4 >= 4 then stddev_samp(cases) over w4 end as cases_std_4w,
        cases - lag(cases, 1) over ws as cases_trend,
        lag(polarity_mean, 1) over ws as polarity_lag_1,
        polarity_mean - lag(polarity_mean, 1) over ws as sentiment_trend
      from f
      window ws as (partition by disease order by date, region),
             w4 as (partition by disease order by date, region rows between 3 preceding and current row)),
h as (select g.*, temperature * humidity as temp_humidity_interaction, pow(temperature, 2) as temp_squared,
             polarity_mean * symptom_mentions as sentiment_symptoms_interaction,
             engagement_score_sum / (id_count + 1) as avg_engagement_per_post from g),
codes as (select disease, cast(dense_rank() over (order by disease) - 1 as integer) as disease_encoded
          from (select distinct disease from h where disease is not null) d)
select h.disease, h.region, h.date, outbreak, month, quarter, week_of_year, day_of_year, season,
       {', '.join(ENV_COLS + ['uv_index'] + SOCIAL_COLS + ['id_count', 'symptom_mentions'])},
       coalesce(cases_lag_1, 0) as cases_lag_1, coalesce(cases_lag_2, 0) as cases_lag_2,
       coalesce(cases_mean_4w, 0) as cases_mean_4w, coalesce(cases_std_4w, 0) as cases_std_4w,
       coalesce(cases_trend, 0) as cases_trend, coalesce(polarity_lag_1, 0) as polarity_lag_1,
       coalesce(sentiment_trend, 0) as sentiment_trend, temp_humidity_interaction, temp_squared,
       sentiment_symptoms_interaction, avg_engagement_per_post, disease_encoded
from h left join codes on h.disease = codes.disease"""


@register("ml16_prepare_ml_features", FLAGSHIP_SQL, FLAGSHIP_DOUBLES)
def q_flagship(spark, sf):
    surv = label_outbreaks(proxy.surveillance(spark, sf), with_trend=False)
    return prepare_ml_features(surv, proxy.environment(spark, sf), proxy.social_with_text(spark, sf))


# ----------------------------------------------------------------------------- shared pieces

from episcope.functions import calendar as cal  # noqa: E402
from episcope.functions.text import clean_text, extract_keywords  # noqa: E402
from episcope.operators import aggregates as A  # noqa: E402
from episcope.operators import filters as FL  # noqa: E402
from episcope.operators import joins as J  # noqa: E402
from episcope.operators import topk as T  # noqa: E402
from episcope.operators import windows as W  # noqa: E402
from episcope.plans.features import interaction_features, merge_all  # noqa: E402


def _surv_l(spark, sf):
    return label_outbreaks(proxy.surveillance(spark, sf), with_trend=False)


SURV_L = Q.SURV_LABELLED
SOCIAL_DAILY_TEXT = SOCIAL_DAILY_SQL.format(src=Q.SOCIAL_TEXT, extra=SYMPTOMS_SUM)
SOCIAL_DAILY_PLAIN = SOCIAL_DAILY_SQL.format(src=Q.SOCIAL, extra="")


# ----------------------------------------------------------------------------- 2.4 aggregations

@register("a1_daily_social_agg", SOCIAL_DAILY_TEXT, SOCIAL_COLS)
def q_a1(spark, sf):
    return A.daily_social_agg(proxy.social_with_text(spark, sf))


@register("a2_daily_symptom_mentions", f"""
select cast(created_at as date) as date,
       cast(sum(case when symptoms is null then 0 else len(symptoms) end) as bigint) as total_symptom_mentions
from ({Q.SOCIAL_TEXT}) p where created_at is not null group by 1""")
def q_a2(spark, sf):
    return A.daily_symptom_mentions(proxy.social_with_text(spark, sf))


@register("a3_dataset_summary", f"""
select 'social_media' as "table", count(*) as records, min(created_at) as start, max(created_at) as "end",
       array_to_string(list_sort(list_distinct(list(platform))), ',') as categories,
       avg(polarity) as mean_value, cast(null as double) as min_value, cast(null as double) as max_value
from ({Q.SOCIAL}) s
union all
select 'surveillance', count(*), cast(min(date) as timestamp), cast(max(date) as timestamp),
       array_to_string(list_sort(list_distinct(list(disease))), ','), avg(cast(outbreak as double)), null, null
from ({SURV_L}) v
union all
select 'environmental', count(*), cast(min(date) as timestamp), cast(max(date) as timestamp), null,
       avg(humidity), min(temperature), max(temperature)
from ({Q.ENV}) e""", ["mean_value", "min_value", "max_value"])
def q_a3(spark, sf):
    d = A.dataset_summary(proxy.social(spark, sf), _surv_l(spark, sf), proxy.environment(spark, sf))
    return d.withColumn("categories", F.array_join("categories", ","))


SPAN_DAYS = "datediff('day', min(date), max(date)) / 365.25"


@register("a4_report_dataset_summary", f"""
select count(*) as total_records, count(distinct region) as countries, min(date) as start_date,
       max(date) as end_date, {Q.r_half_up(SPAN_DAYS, 1)} as span_years,
       cast(sum(outbreak) as bigint) as total_outbreaks, avg(cast(outbreak as double)) as outbreak_rate,
       count(distinct case when outbreak = 1 then region end) as countries_with_outbreaks
from ({SURV_L}) s""", ["span_years", "outbreak_rate"])
def q_a4(spark, sf):
    return A.report_dataset_summary(_surv_l(spark, sf))


@register("a5_regional_stats", f"""
select region, count(outbreak) as outbreak_count, cast(sum(outbreak) as bigint) as outbreak_sum,
       {Q.r_half_up('avg(cast(outbreak as double))', 3)} as outbreak_mean,
       {Q.r_half_up('avg(cases)', 3)} as cases_mean, {Q.r_half_up('stddev_samp(cases)', 3)} as cases_std,
       max(cases) as cases_max
from ({SURV_L}) s group by region""", ["outbreak_mean", "cases_mean", "cases_std"])
def q_a5(spark, sf):
    return A.regional_stats(_surv_l(spark, sf))


RATES = "count(outbreak) as count, cast(sum(outbreak) as bigint) as sum, avg(cast(outbreak as double)) as mean"


@register("a6_region_outbreak_rates", f"select region, {RATES} from ({SURV_L}) s group by region", ["mean"])
def q_a6(spark, sf):
    return A.group_rates(_surv_l(spark, sf), "region")


@register("a7_seasonal_outbreaks",
          f"select cast(month(date) as integer) as month, {RATES} from ({SURV_L}) s group by 1", ["mean"])
def q_a7(spark, sf):
    return A.seasonal_outbreaks(_surv_l(spark, sf))


@register("a8_yearly_outbreaks",
          f"select cast(year(date) as integer) as year, {RATES} from ({SURV_L}) s group by 1", ["mean"])
def q_a8(spark, sf):
    return A.yearly_outbreaks(_surv_l(spark, sf))


@register("a9_cases_by_disease", f"select disease, avg(cases) as cases_mean from ({Q.SURV}) s group by disease",
          ["cases_mean"])
def q_a9(spark, sf):
    return A.mean_by(proxy.surveillance(spark, sf), "disease", "cases")


@register("a10_outbreak_weeks_by_disease",
          f"select disease, cast(sum(outbreak) as bigint) as outbreak_sum from ({SURV_L}) s group by disease")
def q_a10(spark, sf):
    return A.sum_by(_surv_l(spark, sf), "disease", "outbreak").withColumn("outbreak_sum", F.col("outbreak_sum").cast("long"))


@register("a11_outbreak_rate_by_season", f"""
select cast(floor((month(date) % 12) / 3) as integer) as season, avg(cast(outbreak as double)) as outbreak_rate
from ({SURV_L}) s group by 1""", ["outbreak_rate"])
def q_a11(spark, sf):
    s = _surv_l(spark, sf).withColumn("season", cal.season_code("date"))
    return s.groupBy("season").agg(F.avg(F.col("outbreak").cast("double")).alias("outbreak_rate"))


@register("a12_platform_counts",
          f"select platform, count(*) as count from ({Q.SOCIAL}) s where platform is not null group by platform")
def q_a12(spark, sf):
    return A.value_counts(proxy.social(spark, sf), "platform")


@register("a13_target_distribution", f"""
with c as (select outbreak, count(*) as n, cast(floor(count(*) * 0.2 + 0.5) as bigint) as t from ({SURV_L}) s group by outbreak)
select 'all' as split, outbreak, n as count from c union all select 'test', outbreak, t from c where t > 0
union all select 'train', outbreak, n - t from c where n > t""")
def q_a13(spark, sf):
    keys = ["disease", "region", "date"]
    s = _surv_l(spark, sf).select(*keys, "outbreak").withColumn("row_id", F.pmod(F.xxhash64(*keys), F.lit(2147483647)))
    parted = S.stratified_split(s, "outbreak", "row_id", 0.2, 42, tiebreak=keys) \
        .withColumn("split", F.explode(F.array(F.lit("all"), F.when(F.col("is_test"), "test").otherwise("train"))))
    return parted.groupBy("split", "outbreak").agg(F.count(F.lit(1)).alias("count"))


@register("a14_symptom_frequency", f"""
select symptom, count(*) as count from (select unnest(symptoms) as symptom from ({Q.SOCIAL_TEXT}) p) u
where symptom is not null group by symptom""")
def q_a14(spark, sf):
    return A.exploded_counts(proxy.social_with_text(spark, sf), "symptoms", "symptom")


def _hist_sql(src: str, col: str, bins: int, by: str | None = None) -> str:
    byc = f", {by}" if by else ""
    grid = f"select g.bin, k.{by} from range(1, {bins + 1}) g(bin), (select distinct {by} from x) k" if by else \
        f"select g.bin from range(1, {bins + 1}) g(bin)"
    same = f" and g.{by} is not distinct from c.{by}" if by else ""
    return f"""
with x as (select * from ({src}) s where {col} is not null),
mm as (select min(cast({col} as double)) as lo, max(cast({col} as double)) as hi from x),
b as (select case when hi = lo then 1 else least(cast(floor((cast({col} as double) - lo) * ({bins}.0 / (hi - lo))) as integer) + 1, {bins}) end as bin{byc}
      from x, mm),
c as (select bin{byc}, count(*) as n from b group by all),
g as ({grid})
select cast(g.bin as integer) as bin{', g.' + by if by else ''}, lo + (g.bin - 1) * ((hi - lo) / {bins}) as lo, lo + g.bin * ((hi - lo) / {bins}) as hi,
       coalesce(c.n, 0) as count
from g left join c on g.bin = c.bin{same}, mm"""


@register("a15_histogram", _hist_sql(Q.SOCIAL, "polarity", 20), ["lo", "hi"])
def q_a15(spark, sf):
    return A.histogram(proxy.social(spark, sf), "polarity", 20)


@register("a16_histogram_by_class", _hist_sql(SURV_L, "cases", 20, "outbreak"), ["lo", "hi"])
def q_a16(spark, sf):
    return A.histogram(_surv_l(spark, sf), "cases", 20, by="outbreak")


SURV_ENV = f"select s.*, {', '.join('e.' + c for c in ENV_COLS + ['uv_index'])} from ({SURV_L}) s left join ({Q.ENV}) e on s.date = e.date"


def _binned_sql(col: str, bins: int = 5) -> str:
    w = f"((hi - lo) / {bins})"
    edges = " + ".join(f"(case when cast({col} as double) > lo + {w} * {i} then 1 else 0 end)" for i in range(1, bins))
    return f"""
select '{col}' as feature, cast(g.bin as integer) as bin, lo + {w} * (g.bin - 1) as lo, lo + {w} * g.bin as hi, coalesce(n, 0) as count, rate
from (select min(cast({col} as double)) as lo, max(cast({col} as double)) as hi from ({SURV_ENV}) s) mm,
     range(1, {bins + 1}) g(bin)
left join (select {edges} + 1 as bin, count(*) as n, avg(cast(outbreak as double)) as rate
           from (select * from ({SURV_ENV}) s where {col} is not null) x,
                (select min(cast({col} as double)) as lo, max(cast({col} as double)) as hi from ({SURV_ENV}) s) m2 group by 1) c on c.bin = g.bin"""


def _surv_env(spark, sf):
    return J.join_environment(_surv_l(spark, sf), proxy.environment(spark, sf))


@register("a17_binned_rate", " union all ".join(_binned_sql(c) for c in ("temperature", "humidity")), ["lo", "hi", "rate"])
def q_a17(spark, sf):
    x = cut_lineage(_surv_env(spark, sf))
    t, h = (A.binned_rate(x, c, "outbreak", 5).select(F.lit(c).alias("feature"), "*") for c in ("temperature", "humidity"))
    return t.unionByName(h)


def _corr_sql(src: str, cols: list[str]) -> str:
    values = ", ".join(f"cast({c} as double)" for c in cols)
    names = ", ".join(f"'{c}'" for c in cols)
    n = len(cols)
    return f"""
select g.i, g.j, ([{names}])[g.i + 1] as a, ([{names}])[g.j + 1] as b, c.r
from (select cast(a.v as integer) as i, cast(b.v as integer) as j from range({n}) a(v), range({n}) b(v) where b.v > a.v) g
left join (
  select i, j, case when max(x) = min(x) or max(y) = min(y) then null else covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) end as r
  from (select p.i, p.j, t.v[p.i + 1] as x, t.v[p.j + 1] as y
        from (select [{values}] as v from ({src}) s) t,
             (select a.v as i, b.v as j from range({n}) a(v), range({n}) b(v) where b.v > a.v) p) u
  where x is not null and y is not null group by i, j) c on g.i = c.i and g.j = c.j"""


FLAGSHIP_FEATURES = [
    "month", "quarter", "week_of_year", "day_of_year", "season", *ENV_COLS, "uv_index", *SOCIAL_COLS, "id_count",
    "symptom_mentions", "cases_lag_1", "cases_lag_2", "cases_mean_4w", "cases_std_4w", "cases_trend", "polarity_lag_1",
    "sentiment_trend", "temp_humidity_interaction", "temp_squared", "sentiment_symptoms_interaction",
    "avg_engagement_per_post", "disease_encoded"]


@register("a18_correlation_matrix", _corr_sql(FLAGSHIP_SQL, FLAGSHIP_FEATURES), ["r"])
def q_a18(spark, sf):
    feats = q_flagship(spark, sf)
    if sorted(FLAGSHIP_FEATURES) != sorted(set(feats.columns) - {"disease", "region", "date", "outbreak"}):
        raise ValueError("the list of features does not match the feature matrix")
    return A.correlation_matrix(feats, FLAGSHIP_FEATURES)


@register("a19_environment_correlation", _corr_sql(Q.ENV, ENV_COLS), ["r"])
def q_a19(spark, sf):
    return A.correlation_matrix(proxy.environment(spark, sf), ENV_COLS)


@register("a20_high_correlation_pairs", f"""
select * from ({_corr_sql(FLAGSHIP_SQL, FLAGSHIP_FEATURES)}) c where abs(r) > 0.7 order by i, j limit 5""", ["r"])
def q_a20(spark, sf):
    return A.high_correlation_pairs(q_flagship(spark, sf), FLAGSHIP_FEATURES, 0.7, 5)


@register("a21_outbreak_threshold", f"""
select disease, quantile_cont(cast(cases as double), 0.85) as outbreak_threshold from ({Q.SURV}) s group by disease""",
          ["outbreak_threshold"])
def q_a21(spark, sf):
    return W.percentile_threshold(proxy.surveillance(spark, sf), "disease", "cases", 85.0)


# ----------------------------------------------------------------------------- 2.2 filters, 2.3 joins

@register("f1_filter_in", f"select * from ({Q.SURV}) s where disease in ('1-URGENT', '2-HIGH')")
def q_f1(spark, sf):
    return FL.filter_in(proxy.surveillance(spark, sf), "disease", ["1-URGENT", "2-HIGH"])


F2_KEYWORDS = ["sch", "idiot", "src7", "worthless"]


@register("f2_keyword_filter", "select doc_id, source from documents where " + " or ".join(
    f"coalesce(instr(lower({c}), '{k}') > 0, false)" for c in ("text", "source") for k in F2_KEYWORDS))
def q_f2(spark, sf):
    d = proxy.table(spark, sf, "documents")
    return FL.keyword_filter(d, ["text", "source"], F2_KEYWORDS).select("doc_id", "source")


@register("f11_flatten_agg_names", f"""
select platform, avg(polarity) as polarity_mean, max(polarity) as polarity_max, sum(engagement_score) as engagement_score_sum,
       count(id) as id_count from ({Q.SOCIAL}) s group by platform""", ["polarity_mean", "polarity_max", "engagement_score_sum"])
def q_f11(spark, sf):
    wanted = [("polarity", "mean"), ("polarity", "max"), ("engagement_score", "sum"), ("id", "count")]
    how = {"mean": F.avg, "max": F.max, "sum": F.sum, "count": F.count}
    aggs = [how[fn](c).alias(name) for (c, fn), name in zip(wanted, FL.flatten_names(wanted))]
    return proxy.social(spark, sf).groupBy("platform").agg(*aggs)


@register("f3_filter_class", f"select * from ({SURV_L}) s where outbreak = 1", ["outbreak_threshold"])
def q_f3(spark, sf):
    return FL.filter_class(_surv_l(spark, sf), "outbreak", 1)


@register("f4_filter_min_support", f"""
select region, {RATES} from ({SURV_L}) s group by region having count(outbreak) >= 10""", ["mean"])
def q_f4(spark, sf):
    return FL.filter_min_support(A.group_rates(_surv_l(spark, sf), "region"), "count", 10)


MERGE_COLS = ENV_COLS + ["uv_index"] + SOCIAL_COLS + ["id_count", "symptom_mentions"]
J4_SQL = f"""
with m as (select s.*, {', '.join('e.' + c for c in ENV_COLS + ['uv_index'])},
                  {', '.join('sd.' + c for c in SOCIAL_COLS + ['id_count', 'symptom_mentions'])}
           from ({SURV_L}) s left join ({Q.ENV}) e on s.date = e.date
           left join ({SOCIAL_DAILY_TEXT}) sd on s.date = sd.date)
select disease, region, date, cases, deaths, hospitalizations, outbreak_threshold, outbreak,
       {', '.join(_ffill(c) for c in MERGE_COLS)} from m"""


def _j4(spark, sf):
    return merge_all(_surv_l(spark, sf), proxy.environment(spark, sf),
                     A.daily_social_agg(proxy.social_with_text(spark, sf)), ("date", "disease", "region"))


@register("f5_select_features", f"""
select * exclude (date, disease, outbreak, cases, deaths,
       hospitalizations, outbreak_threshold, region) from ({J4_SQL}) q""", ENV_COLS + SOCIAL_COLS)
def q_f5(spark, sf):
    m = _j4(spark, sf)
    return m.select(*FL.select_features(m))


@register("f6_forward_fill", J4_SQL, ENV_COLS + SOCIAL_COLS + ["outbreak_threshold"])
def q_f6(spark, sf):
    return _j4(spark, sf)


@register("f7_fill_zero", f"""
select s.disease, s.region, s.date, s.cases, coalesce(sd.polarity_mean, 0) as polarity_mean,
       coalesce(sd.id_count, 0) as id_count
from ({Q.SURV}) s left join ({SOCIAL_DAILY_PLAIN}) sd on s.date = sd.date""", ["polarity_mean"])
def q_f7(spark, sf):
    sd = A.daily_social_agg(proxy.social(spark, sf)).select("date", "polarity_mean", "id_count")
    j = J.join_social(proxy.surveillance(spark, sf).select("disease", "region", "date", "cases"), sd)
    return W.fill_zero(j, ["polarity_mean", "id_count"])


@register("f8_to_numeric_or_zero", """
select l_orderkey, l_linenumber, coalesce(try_cast(l_returnflag as double), 0) as returnflag_num,
       coalesce(try_cast(cast(l_quantity as varchar) as double), 0) as quantity_num
from lineitem""", ["returnflag_num", "quantity_num"])
def q_f8(spark, sf):
    li = proxy.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("returnflag_num"),
        F.col("l_quantity").cast("string").alias("quantity_num"))
    return FL.object_columns_to_numeric(li, skip=())


@register("f9_every_nth", f"""
select * exclude (rn_) from (select e.*, row_number() over (order by date) as rn_ from ({Q.ENV}) e) x
where (rn_ - 1) % 7 = 0""", ENV_COLS)
def q_f9(spark, sf):
    return W.every_nth(proxy.environment(spark, sf), ["date"], 7)


@register("f10_derive_source_tag", f"select *, 'Environmental_API' as source from ({Q.ENV}) e", ENV_COLS)
def q_f10(spark, sf):
    return FL.with_constant(proxy.environment(spark, sf), "source", "Environmental_API")


@register("j1_join_environment", SURV_ENV, ENV_COLS + ["outbreak_threshold"])
def q_j1(spark, sf):
    return _surv_env(spark, sf)


@register("j2_join_social", f"""
select s.*, {', '.join('sd.' + c for c in SOCIAL_COLS + ['id_count'])}
from ({Q.SURV}) s left join ({SOCIAL_DAILY_PLAIN}) sd on s.date = sd.date""", SOCIAL_COLS)
def q_j2(spark, sf):
    return J.join_social(proxy.surveillance(spark, sf), A.daily_social_agg(proxy.social(spark, sf)))


@register("j3_join_symptom_counts", f"""
select sd.*, sc.total_symptom_mentions from ({SOCIAL_DAILY_SQL.format(src=Q.SOCIAL_TEXT, extra='')}) sd
left join (select cast(created_at as date) as date,
                  cast(sum(case when symptoms is null then 0 else len(symptoms) end) as bigint) as total_symptom_mentions
           from ({Q.SOCIAL_TEXT}) p where created_at is not null group by 1) sc on sd.date = sc.date""", SOCIAL_COLS)
def q_j3(spark, sf):
    # both sides of the join are day tables of one source: aggregated in one pass over it
    return A.daily_social_agg(proxy.social_with_text(spark, sf), symptoms_name="total_symptom_mentions")


@register("j4_merge_all", J4_SQL, ENV_COLS + SOCIAL_COLS + ["outbreak_threshold"])
def q_j4(spark, sf):
    return _j4(spark, sf)


@register("j5_attach_by_key", f"""
select s.doc_id, s.label, s.score, d.n_chars from ({Q.SCORED}) s left join documents d on s.doc_id = d.doc_id""",
          ["score"])
def q_j5(spark, sf):
    s = proxy.scored(spark, sf).select("doc_id", "label", "score")
    return J.attach_by_key(s, proxy.table(spark, sf, "documents"), "doc_id", ["n_chars"])


# ----------------------------------------------------------------------------- 2.5 windows

SURV_W = "partition by disease order by date, region"


def _wsql(select: str) -> str:
    return f"select s.*, {select} from ({Q.SURV}) s"


def _sw(spark, sf, specs):
    return W.series_window(proxy.surveillance(spark, sf), ["disease"], ["date", "region"], specs)


@register("w1_lag_features", _wsql(f"lag(cases, 1) over ({SURV_W}) as cases_lag_1, lag(cases, 2) over ({SURV_W}) as cases_lag_2"))
def q_w1(spark, sf):
    return _sw(spark, sf, [W.lag("cases_lag_1", "cases", 1), W.lag("cases_lag_2", "cases", 2)])


def _roll(fn: str, n: int, name: str, lo: int | None = None, hi: int = 0) -> str:
    lo = n - 1 if lo is None else lo
    fr = f"({SURV_W} rows between {lo} preceding and {'current row' if hi == 0 else str(hi) + ' following'})"
    return f"case when count(cases) over {fr} >= {n} then {fn}(cases) over {fr} end as {name}"


@register("w2_rolling_mean", _wsql(_roll("avg", 4, "cases_mean_4w")), ["cases_mean_4w"])
def q_w2(spark, sf):
    return _sw(spark, sf, [W.rolling_mean("cases_mean_4w", "cases", 4)])


@register("w3_rolling_std", _wsql(_roll("stddev_samp", 4, "cases_std_4w")), ["cases_std_4w"])
def q_w3(spark, sf):
    return _sw(spark, sf, [W.rolling_std("cases_std_4w", "cases", 4)])


@register("w4_centered_mean", _wsql(_roll("avg", 7, "cases_7day_avg", 3, 3)), ["cases_7day_avg"])
def q_w4(spark, sf):
    return _sw(spark, sf, [W.centered_mean("cases_7day_avg", "cases", 7)])


@register("w5_diff", _wsql(f"cases - lag(cases, 1) over ({SURV_W}) as cases_trend"))
def q_w5(spark, sf):
    return _sw(spark, sf, [W.diff("cases_trend", "cases")])


W6_SQL = f"""
with l as (select * from ({SURV_L}) s),
c as (select l.*, {_roll('avg', 7, 'cases_7day_avg', 3, 3)} from l)
select c.*, cases_7day_avg - lag(cases_7day_avg, 1) over ({SURV_W}) as cases_trend from c"""


@register("w6_label_outbreaks", W6_SQL, ["outbreak_threshold", "cases_7day_avg", "cases_trend"])
def q_w6(spark, sf):
    return label_outbreaks(proxy.surveillance(spark, sf), "disease", "cases", 85.0, order=["date", "region"])


W7_SQL = f"""
with p as (select disease, region, date, cases, deaths, hospitalizations,
                  lead(date) over (partition by disease, region order by date) as nd,
                  lead(cases) over (partition by disease, region order by date) as nc,
                  lead(deaths) over (partition by disease, region order by date) as ndt,
                  lead(hospitalizations) over (partition by disease, region order by date) as nh
           from ({Q.SURV}) s),
x as (select p.*, cast(unnest(generate_series(date, coalesce(nd - 1, date), interval 1 day)) as date) as day from p)
select disease, region, day as date,
  case when nd is null or day = date then cast(cases as double) else cases + (nc - cases) * (datediff('day', date, day) / datediff('day', date, nd)) end as cases,
  case when nd is null or day = date then cast(deaths as double) else deaths + (ndt - deaths) * (datediff('day', date, day) / datediff('day', date, nd)) end as deaths,
  case when nd is null or day = date then cast(hospitalizations as double) else hospitalizations + (nh - hospitalizations) * (datediff('day', date, day) / datediff('day', date, nd)) end as hospitalizations
from x"""


@register("w7_resample_daily_interpolate", W7_SQL, ["cases", "deaths", "hospitalizations"])
def q_w7(spark, sf):
    return W.resample_daily_interpolate(proxy.surveillance(spark, sf), ["disease", "region"], "date",
                                        ["cases", "deaths", "hospitalizations"])


from episcope.operators import encoding as ENC  # noqa: E402


@register("w8_encode_rank", f"""
select s.*, cast(dense_rank() over (order by disease) - 1 as integer) as disease_encoded,
       cast(dense_rank() over (order by region) - 1 as integer) as region_encoded from ({Q.SURV}) s""")
def q_w8(spark, sf):
    return ENC.encode_rank(ENC.encode_rank(proxy.surveillance(spark, sf), "disease"), "region")


@register("w9_time_series", f"select disease, date, cases from ({Q.SURV}) s order by disease, date")
def q_w9(spark, sf):
    return T.sort_series(proxy.surveillance(spark, sf).select("disease", "date", "cases"))


# ----------------------------------------------------------------------------- 2.8 scalar functions

from episcope.operators import evaluation as E  # noqa: E402
from episcope.operators import sampling as S  # noqa: E402
from episcope.operators import sets as U  # noqa: E402
from episcope.operators.scaling import standard_scale  # noqa: E402
from episcope.operators.sentiment import LEXICON, lexicon_sentiment, modified_sentiment  # noqa: E402
from episcope.sources import landed  # noqa: E402
from episcope.functions.numeric import round_half_up  # noqa: E402
from episcope.functions.text import parse_list_literal  # noqa: E402

CAL_SQL = ("cast(month(date) as integer) as month, cast(quarter(date) as integer) as quarter, "
           "cast(weekofyear(date) as integer) as week_of_year, cast(dayofyear(date) as integer) as day_of_year")


@register("d1_d4_calendar_features", f"select s.*, {CAL_SQL}, cast(floor((month(date) % 12) / 3) as integer) as season from ({Q.SURV}) s")
def q_d1(spark, sf):
    return calendar_features(proxy.surveillance(spark, sf), "date")


@register("d5_season_code", f"select date, cast(floor((month(date) % 12) / 3) as integer) as season from ({Q.ENV}) e")
def q_d5(spark, sf):
    return proxy.environment(spark, sf).select("date", cal.season_code("date").alias("season"))


@register("d6_season_name", f"""
select date, (['Winter', 'Spring', 'Summer', 'Fall'])[cast(floor((month(date) % 12) / 3) as integer) + 1] as season_name,
       strftime(date, '%b') as month_name from ({Q.ENV}) e""")
def q_d6(spark, sf):
    return proxy.environment(spark, sf).select("date", cal.season_name("date").alias("season_name"),
                                               cal.month_name("date").alias("month_name"))


@register("d7_week_to_date", f"""
with w as (select distinct cast(year(date) as integer) as year, cast(weekofyear(date) as integer) as week from ({Q.SURV}) s),
j as (select *, make_date(year, 1, 1) as jan1, make_date(year, 1, 4) as jan4 from w)
select year, week,
       cast(jan1 + cast((8 - isodow(jan1)) % 7 as integer) + 7 * (week - 1) as date) as week_date,
       cast(jan4 - cast(isodow(jan4) - 1 as integer) + 7 * (week - 1) as date) as iso_week_date
from j""")
def q_d7(spark, sf):
    w = proxy.surveillance(spark, sf).select(F.year("date").alias("year"), F.weekofyear("date").alias("week")).distinct()
    return w.select("year", "week", cal.week_to_date("year", "week").alias("week_date"),
                    cal.week_to_date("year", "week", iso=True).alias("iso_week_date"))


@register("d8_year_to_date", "select distinct cast(year(o_orderdate) as integer) as year, make_date(cast(year(o_orderdate) as integer), 1, 1) as date from orders")
def q_d8(spark, sf):
    o = proxy.table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return o.select("year", cal.year_to_date("year").alias("date"))


_HEALTH_PARTS = """month(date)::int as month, quarter(date)::int as quarter, dayofyear(date)::int as day_of_year, week(date)::int as week_of_year,
       (['Winter','Spring','Summer','Fall'])[(month(date) % 12) // 3 + 1] as season"""


@register("d8_health_features", f"""
select *, {_HEALTH_PARTS} from (select 'dated' as kind, year(date)::int as year, date, cases from ({Q.SURV}) s
  union all select 'yearly', y, make_date(y, 1, 1), n from (select year(date)::int as y, sum(cases)::bigint as n from ({Q.SURV}) s group by 1) t) u""")
def q_d8_health(spark, sf):
    s = proxy.surveillance(spark, sf)
    dated = s.select(F.lit("dated").alias("kind"), F.year("date").alias("year"), "date", "cases")
    yearly = s.groupBy(F.year("date").alias("year")).agg(F.sum("cases").cast("long").alias("cases")).select(F.lit("yearly").alias("kind"), "*")
    return cal.health_features(dated).unionByName(cal.health_features(yearly))


@register("d9_truncate_day_span_years", f"""
select cast(created_at as date) as day, count(*) as posts,
       datediff('day', min(cast(created_at as date)), max(cast(created_at as date))) / 365.25 as span_years
from ({Q.SOCIAL}) s group by 1""", ["span_years"])
def q_d9(spark, sf):
    s = proxy.social(spark, sf).withColumn("day", cal.truncate_day("created_at"))
    return s.groupBy("day").agg(F.count(F.lit(1)).alias("posts"),
                                cal.span_years(F.min("day"), F.max("day")).alias("span_years"))


AS_OF = "1995-01-31 00:00:00"


@register("d10_lookback_window", f"""
select * from ({Q.SOCIAL}) s
where created_at between timestamp '{AS_OF}' - interval 7 day and timestamp '{AS_OF}'""", ["polarity", "subjectivity", "engagement_score"])
def q_d10(spark, sf):
    s = proxy.social(spark, sf)
    start = cal.lookback_start(F.lit(AS_OF).cast("timestamp_ntz"), 7)
    return s.where(F.col("created_at").between(start, F.lit(AS_OF).cast("timestamp_ntz")))


@register("x1_clean_text", f"select doc_id, {Q.clean_text_sql('text')} as text from documents")
def q_x1(spark, sf):
    return proxy.posts_text(spark, sf).select("doc_id", clean_text("text").alias("text"))


@register("x2_extract_symptoms", f"""
select doc_id, array_to_string({Q.keywords_sql(Q.clean_text_sql('text'), proxy.PROXY_KEYWORDS)}, ',') as symptoms
from documents""")
def q_x2(spark, sf):
    d = proxy.posts_text(spark, sf)
    return d.select("doc_id", F.array_join(extract_keywords(clean_text("text"), proxy.PROXY_KEYWORDS), ",")
                    .alias("symptoms"))


LEX_VALUES = ", ".join(f"('{k}', cast({v[0]} as double), cast({v[1]} as double))" for k, v in LEXICON.items())
X3_SQL = f"""
with lex(word, pol, subj) as (values {LEX_VALUES}),
t as (select doc_id, unnest(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}_]+')) as word from documents),
s as (select doc_id, avg(pol) as p, avg(subj) as q from t join lex on t.word = lex.word group by doc_id)
select d.doc_id, coalesce(s.p, 0.0) as polarity, coalesce(s.q, 0.0) as subjectivity
from documents d left join s on d.doc_id = s.doc_id"""


@register("x3_lexicon_sentiment", X3_SQL, ["polarity", "subjectivity"])
def q_x3(spark, sf):
    return lexicon_sentiment(proxy.posts_text(spark, sf), "text").select("doc_id", "polarity", "subjectivity")


# words of the supplied documents stand in for lexicon, negators and intensifiers, which they hardly hold
PROXY_LEXICON = {"the": (0.4, 0.5), "that": (-0.6, 0.7), "und": (-0.5, 0.6), "la": (0.3, 0.9), "with": (0.8, 0.2), "es": (-0.9, 0.4)}
PROXY_NEGATORS = ("no", "of", "en", "der")
PROXY_INTENSIFIERS = {"in": 1.3, "is": 1.5, "de": 0.5}
_WORDS = ", ".join(f"'{w}'" for w in PROXY_LEXICON)
_STOPS = _WORDS + ", '.', '!', '?', ';', chr(10)"
_NEGS = ", ".join(f"'{w}'" for w in PROXY_NEGATORS)
_stop = lambda c: f"coalesce({c} in ({_STOPS}), false)"
_neg = lambda c: f"coalesce({c} in ({_NEGS}), false)"


@register("x3_modified_sentiment", f"""
with lex(word, pol, subj) as (values {', '.join(f"('{k}', cast({v[0]} as double), cast({v[1]} as double))" for k, v in PROXY_LEXICON.items())}),
boost(bword, b) as (values {', '.join(f"('{k}', cast({v} as double))" for k, v in PROXY_INTENSIFIERS.items())}),
d as (select doc_id, regexp_extract_all(regexp_replace(lower(text), 'n[''’]t', 'nt', 'g'), '[\\p{{L}}\\p{{N}}_]+|[.!?;\\n]') as ws from documents),
t as (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as pos from d),
l as (select *, lag(w, 1) over o as w1, lag(w, 2) over o as w2, lag(w, 3) over o as w3 from t window o as (partition by doc_id order by pos)),
h as (select doc_id, coalesce(b, 1.0) as b, pol, subj,
       case when {_neg('w1')} or ({_neg('w2')} and not {_stop('w1')})
                 or ({_neg('w3')} and not {_stop('w2')} and not {_stop('w1')}) then -0.5 else 1.0 end as turned
     from l join lex on w = word left join boost on w1 = bword),
s as (select doc_id, avg(greatest(-1.0, least(1.0, pol * b * turned))) as p, avg(least(1.0, subj * b)) as q from h group by doc_id)
select doc_id, coalesce(p, 0.0) as polarity, coalesce(q, 0.0) as subjectivity from documents left join s using (doc_id)""",
          ["polarity", "subjectivity"])
def q_x3_modified(spark, sf):
    return modified_sentiment(proxy.posts_text(spark, sf), "text", PROXY_LEXICON, PROXY_NEGATORS, PROXY_INTENSIFIERS) \
        .select("doc_id", "polarity", "subjectivity")


U1_SQL = f"""
with t as (select cast(id as varchar) as id, 'twitter' as platform, text as raw_text, created_at,
                  cast(coalesce(like_count, 0) + coalesce(retweet_count, 0) as bigint) as engagement_score,
                  author_id as author from ({Q.TWEETS}) x),
r as (select id, 'reddit' as platform, coalesce(title, '') || ' ' || coalesce(selftext, '') as raw_text,
             to_timestamp(created_utc)::timestamp as created_at, cast(score as bigint) as engagement_score,
             coalesce(author, 'deleted') as author from ({Q.REDDIT}) y),
u as (select *, {Q.clean_text_sql('raw_text')} as text from (select * from t union all select * from r) z),
lex(word, pol, subj) as (values {LEX_VALUES}),
tok as (select id, platform, unnest(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}_]+')) as word from u),
sc as (select id, platform, avg(pol) as p, avg(subj) as q from tok join lex on tok.word = lex.word group by id, platform)
select u.id, u.platform, u.raw_text, u.created_at, u.engagement_score, u.author, u.text,
       coalesce(sc.p, 0.0) as polarity, coalesce(sc.q, 0.0) as subjectivity,
       array_to_string({Q.keywords_sql('u.text', proxy.PROXY_KEYWORDS)}, ',') as symptoms
from u left join sc on u.id = sc.id and u.platform = sc.platform"""


def _union_posts(spark, sf):
    tw = landed.normalize_tweets(proxy.tweet_payloads(spark, sf))
    rd = landed.normalize_reddit(proxy.reddit_payloads(spark, sf), keywords=[""])
    return U.union_posts(tw, rd, proxy.PROXY_KEYWORDS)


@register("u1_union_posts", U1_SQL, ["polarity", "subjectivity"])
def q_u1(spark, sf):
    return _union_posts(spark, sf).withColumn("symptoms", F.array_join("symptoms", ","))


@register("x4_engagement_score", f"""
select cast(id as varchar) as id, cast(coalesce(like_count, 0) + coalesce(retweet_count, 0) as bigint) as engagement_score
from ({Q.TWEETS}) t""")
def q_x4(spark, sf):
    from episcope.functions.text import engagement_score
    t = landed.normalize_tweets(proxy.tweet_payloads(spark, sf))
    return t.select("id", engagement_score("like_count", "retweet_count").cast("long").alias("engagement_score"))


@register("x5_parse_symptom_list", f"""
select id, array_to_string(symptoms, '|') as symptoms from ({Q.SOCIAL_TEXT}) s""")
def q_x5(spark, sf):
    s = proxy.social_with_text(spark, sf)
    lit_text = F.when(F.col("symptoms").isNotNull(), F.concat(
        F.lit("["), F.array_join(F.transform("symptoms", lambda k: F.concat(F.lit("'"), k, F.lit("'"))), ", "),
        F.lit("]")))
    return s.select("id", F.array_join(parse_list_literal(lit_text), "|").alias("symptoms"))


M1_SQL = f"""
select q.*, temperature * humidity as temp_humidity_interaction, pow(temperature, 2) as temp_squared,
       polarity_mean * symptom_mentions as sentiment_symptoms_interaction,
       engagement_score_sum / (id_count + 1) as avg_engagement_per_post from ({J4_SQL}) q"""


@register("m1_interaction_features", M1_SQL, ENV_COLS + SOCIAL_COLS + [
    "outbreak_threshold", "temp_humidity_interaction", "temp_squared", "sentiment_symptoms_interaction",
    "avg_engagement_per_post"])
def q_m1(spark, sf):
    return interaction_features(_j4(spark, sf))


@register("m2_round_n", f"""
select id, {Q.r_half_up('polarity', 4)} as polarity_4, {Q.r_half_up('polarity', 3)} as polarity_3,
       {Q.r_half_up('polarity', 1)} as polarity_1 from ({Q.SOCIAL}) s""", ["polarity_4", "polarity_3", "polarity_1"])
def q_m2(spark, sf):
    s = proxy.social(spark, sf)
    return s.select("id", *[round_half_up("polarity", d).alias(f"polarity_{d}") for d in (4, 3, 1)])


# ----------------------------------------------------------------------------- 2.6 top-k, 2.7 sets

@register("t1_top_outbreak_regions", f"""
select region, {RATES} from ({SURV_L}) s group by region having count(outbreak) >= 10
order by mean desc, region limit 5""", ["mean"])
def q_t1(spark, sf):
    return T.top_outbreak_regions(_surv_l(spark, sf))


@register("t2_peak_months", f"""
select cast(month(date) as integer) as month, {RATES}, strftime(make_date(2000, cast(month(date) as integer), 1), '%b') as month_name
from ({SURV_L}) s group by 1, 5 order by mean desc, month limit 3""", ["mean"])
def q_t2(spark, sf):
    return T.peak_months(_surv_l(spark, sf))


@register("t3_recent_years", f"""
select cast(year(date) as integer) as year, {RATES} from ({SURV_L}) s group by 1 order by year desc limit 5""", ["mean"])
def q_t3(spark, sf):
    return T.recent_years(_surv_l(spark, sf))


@register("t4_top_symptoms", f"""
select symptom, count(*) as count from (select unnest(symptoms) as symptom from ({Q.SOCIAL_TEXT}) p) u
where symptom is not null group by symptom order by count desc, symptom limit 10""")
def q_t4(spark, sf):
    return T.top_counts(A.exploded_counts(proxy.social_with_text(spark, sf), "symptoms", "symptom"), "symptom", 10)


@register("t8_limit_rows", f"select * from ({Q.SOCIAL}) s order by created_at desc, id limit 100",
          ["polarity", "subjectivity", "engagement_score"])
def q_t8(spark, sf):
    return T.limit_rows(proxy.social(spark, sf), [F.col("created_at").desc(), F.col("id")], 100)


@register("u4_distinct_values", f"select distinct disease from ({Q.SURV}) s where disease is not null")
def q_u4(spark, sf):
    return U.distinct_values(proxy.surveillance(spark, sf), "disease")


ORDER_GAPS = """select o_orderkey, o_orderdate, case when o_orderstatus = 'F' and o_orderkey % 7 <> 0 then cast(o_totalprice as double) end as price,
       case when o_orderkey % 11 = 0 then o_orderpriority end as priority from orders"""


@register("f6_forward_fill_gaps", f"""
select o_orderkey, {_ffill('price', 'o_orderdate, o_orderkey')}, {_ffill('priority', 'o_orderdate, o_orderkey', 'null')}
from ({ORDER_GAPS}) g""", ["price"])
def q_f6_gaps(spark, sf):
    # most prices and priorities are missing: long gaps, many buckets that hold no value at all
    o = proxy.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate",
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 7 != 0), F.col("o_totalprice").cast("double")).alias("price"),
        F.when(F.col("o_orderkey") % 11 == 0, F.col("o_orderpriority")).alias("priority"))
    return W.forward_fill(o, ["price", "priority"], ["o_orderdate", "o_orderkey"], fill_value=0, buckets=48) \
        .select("o_orderkey", "price", "priority")


# ----------------------------------------------------------------------------- 2.9 sampling

LEHMER_SQL = "(((({id} % 2147483647) + 42) * 48271) % 2147483647)"


@register("ml1_stratified_split", f"""
with k as (select *, {LEHMER_SQL.format(id='doc_id')} as key_ from ({Q.SCORED}) s),
r as (select *, row_number() over (partition by label order by key_, doc_id) as rn_,
             count(*) over (partition by label) as nc_ from k)
select doc_id, label, score, prediction, rn_ <= floor(nc_ * 0.2 + 0.5) as is_test from r""", ["score"])
def q_ml1(spark, sf):
    return S.stratified_split(proxy.scored(spark, sf), "label", "doc_id", 0.2, 42)


@register("ml2_stratified_sample", f"""
with k as (select *, {LEHMER_SQL.format(id='doc_id')} as key_ from ({Q.SCORED}) s),
r as (select *, row_number() over (partition by label order by key_, doc_id) as rn_ from k),
n as (select count(*) as n_, sum(case when label = 1 then 1 else 0 end) as n1_ from k)
select doc_id, label, score, prediction from r, n
where rn_ <= case when label = 1 then floor(100 * n1_ / n_) else 100 - floor(100 * n1_ / n_) end""", ["score"])
def q_ml2(spark, sf):
    return S.stratified_sample(proxy.scored(spark, sf), "label", "doc_id", 100, 42)


@register("ml3_cv_subsample", f"""
select * from ({Q.SOCIAL}) s order by {LEHMER_SQL.format(id='id')}, id limit 5000""",
          ["polarity", "subjectivity", "engagement_score"])
def q_ml3(spark, sf):
    return S.cv_subsample(proxy.social(spark, sf), "id", 5000, 42)


# ----------------------------------------------------------------------------- 2.10 / 2.11 evaluation

CONF = f"""(select cast(sum(case when label = 1 and prediction = 1 then 1 else 0 end) as bigint) as tp,
  cast(sum(case when label = 0 and prediction = 1 then 1 else 0 end) as bigint) as fp,
  cast(sum(case when label = 1 and prediction = 0 then 1 else 0 end) as bigint) as fn,
  cast(sum(case when label = 0 and prediction = 0 then 1 else 0 end) as bigint) as tn,
  count(*) as n from ({Q.SCORED}) s) c"""

AUC_SQL = f"""
with d as (select cast(score as double) as score, cast(sum(label) as bigint) as pos, cast(sum(1 - label) as bigint) as neg
           from ({Q.SCORED}) s group by 1),
c as (select *, sum(pos) over (order by score desc rows between unbounded preceding and current row) as cp from d)
select cast(sum(neg * (2 * cp - pos)) as double) / (2.0 * sum(pos) * sum(neg)) as auc from c"""


@register("e1_roc_auc", AUC_SQL, ["auc"])
def q_e1(spark, sf):
    return E.roc_auc(proxy.scored(spark, sf))


@register("e2_roc_curve", f"""
with d as (select cast(score as double) as score, cast(sum(label) as bigint) as pos, cast(sum(1 - label) as bigint) as neg
           from ({Q.SCORED}) s group by 1),
c as (select *, sum(pos) over (order by score desc rows between unbounded preceding and current row) as cp,
             sum(neg) over (order by score desc rows between unbounded preceding and current row) as cn,
             sum(pos) over () as p_, sum(neg) over () as n_ from d)
select score as threshold, cast(cn as double) / n_ as fpr, cast(cp as double) / p_ as tpr from c""",
          ["threshold", "fpr", "tpr"])
def q_e2(spark, sf):
    return E.roc_curve(proxy.scored(spark, sf))


@register("e2_roc_curve_thinned", f"""
with d as (select cast(score as double) as score, cast(sum(label) as bigint) as pos, cast(sum(1 - label) as bigint) as neg
           from ({Q.SCORED}) s group by 1),
c as (select *, sum(pos) over (order by score desc rows between unbounded preceding and current row) as cp,
             sum(neg) over (order by score desc rows between unbounded preceding and current row) as cn,
             sum(pos) over () as p_, sum(neg) over () as n_, max(score) over () as top,
             lead(pos) over (order by score desc) as np, lead(neg) over (order by score desc) as nn from d)
select score as threshold, cast(cn as double) / n_ as fpr, cast(cp as double) / p_ as tpr from c
where np is null or np <> pos or nn <> neg or score = top
union all select cast('inf' as double), 0.0, 0.0""", ["fpr", "tpr"])
def q_e2_thinned(spark, sf):
    return E.roc_curve(proxy.scored(spark, sf), thin=True)


@register("e3_accuracy", f"select avg(cast(label = prediction as double)) as accuracy from ({Q.SCORED}) s", ["accuracy"])
def q_e3(spark, sf):
    return E.accuracy(proxy.scored(spark, sf))


@register("e4_confusion_matrix", f"""
select cast(label as bigint) as actual, cast(sum(case when prediction = 0 then 1 else 0 end) as bigint) as predicted_0,
       cast(sum(case when prediction = 1 then 1 else 0 end) as bigint) as predicted_1 from ({Q.SCORED}) s group by 1""")
def q_e4(spark, sf):
    return E.confusion_matrix(proxy.scored(spark, sf))


E5_SQL = f"""
with c as (select * from {CONF}),
p as (select *, coalesce(tn / nullif(tn + fn, 0), 0.0) as p0, coalesce(tn / nullif(tn + fp, 0), 0.0) as r0,
             coalesce(tp / nullif(tp + fp, 0), 0.0) as p1, coalesce(tp / nullif(tp + fn, 0), 0.0) as r1,
             tn + fp as s0, tp + fn as s1 from c),
f as (select *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0.0) as f0, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0.0) as f1,
             coalesce((tp + tn) / nullif(n, 0), 0.0) as acc from p)
select '0' as class, p0 as precision, r0 as recall, f0 as f1_score, s0 as support from f
union all select '1', p1, r1, f1, s1 from f
union all select 'accuracy', acc, acc, acc, n from f
union all select 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n from f
union all select 'weighted avg', coalesce((p0 * s0 + p1 * s1) / nullif(n, 0), 0.0), coalesce((r0 * s0 + r1 * s1) / nullif(n, 0), 0.0),
                 coalesce((f0 * s0 + f1 * s1) / nullif(n, 0), 0.0), n from f"""


@register("e5_classification_report", E5_SQL, ["precision", "recall", "f1_score"])
def q_e5(spark, sf):
    return E.classification_report(proxy.scored(spark, sf))


@register("e6_detection_impact", f"""
select tp + fn as test_outbreaks, tp as correctly_predicted, fn as missed_outbreaks,
       coalesce(cast(tp as double) / nullif(tp + fn, 0), 0.0) as detection_rate from {CONF}""", ["detection_rate"])
def q_e6(spark, sf):
    return E.detection_impact(proxy.scored(spark, sf))


@register("e7_cost_benefit", f"""
with x as (select (tp + fp) * 50000 as response_cost, tp * 500000 as avoided_cost, fp * 10000 as false_alarm_cost,
                  fn * 500000 as missed_cost from {CONF})
select *, avoided_cost - response_cost - false_alarm_cost - missed_cost as net_benefit,
       coalesce(cast(avoided_cost - response_cost - false_alarm_cost - missed_cost as double) * 100 / nullif(response_cost, 0), 0.0) as roi_pct
from x""", ["roi_pct"])
def q_e7(spark, sf):
    return E.cost_benefit(proxy.scored(spark, sf))


@register("e8_operational_tiers", f"""
with x as (select coalesce(cast(tp as double) / nullif(tp + fn, 0), 0.0) as detection_rate,
                  coalesce(cast(tp as double) / nullif(tp + fp, 0), 0.0) as precision from {CONF})
select *, case when detection_rate > 0.7 then 'HIGH' when detection_rate > 0.5 then 'MODERATE' else 'LOW' end as detection_tier,
       case when precision > 0.6 then 'HIGH' else 'LOW' end as precision_tier from x""", ["detection_rate", "precision"])
def q_e8(spark, sf):
    return E.operational_tiers(proxy.scored(spark, sf))


@register("e9_trend_verdict", f"""
with y as (select cast(year(date) as integer) as year, avg(cast(outbreak as double)) as mean from ({SURV_L}) s group by 1),
r as (select *, row_number() over (order by year desc) as r_, count(*) over () as n_ from y),
a as (select max(n_) as n_years, min(year) as first_year, max(year) as last_year,
             arg_max(mean, year) - arg_min(mean, year) as trend_change from r where r_ <= 5)
select *, case when trend_change > 0.01 then 'increasing' when trend_change < -0.01 then 'decreasing' else 'stable' end as verdict
from a where n_years > 3""", ["trend_change"])
def q_e9(spark, sf):
    return E.trend_verdict(A.yearly_outbreaks(_surv_l(spark, sf)))


@register("e10_coverage_projection", f"""
with s as (select count(distinct region) as countries_covered, count(*) as records from ({SURV_L}) v),
p as (select count(*) as social_posts from ({Q.SOCIAL}) q)
select countries_covered, records, cast(records as double) / nullif(countries_covered, 0) as records_per_country,
       social_posts, cast(records as double) / nullif(countries_covered, 0) * 195 as global_projection from s, p""",
          ["records_per_country", "global_projection"])
def q_e10(spark, sf):
    return E.coverage_projection(_surv_l(spark, sf), proxy.social(spark, sf))


@register("e11_effect_size", f"""
select auc, ((auc - 0.5) * 2) / 0.2 as effect_size,
       case when ((auc - 0.5) * 2) / 0.2 > 0.8 then 'Large' when ((auc - 0.5) * 2) / 0.2 > 0.5 then 'Medium' else 'Small' end as magnitude
from ({AUC_SQL}) a""", ["auc", "effect_size"])
def q_e11(spark, sf):
    return E.effect_size(E.roc_auc(proxy.scored(spark, sf)))


@register("ml10_balanced_weights", f"""
with c as (select label, count(*) as nc from ({Q.SCORED}) s group by label),
t as (select sum(nc) as n, count(*) as k from c)
select s.*, cast(t.n as double) / (t.k * c.nc) as weight from ({Q.SCORED}) s join c on s.label = c.label, t""",
          ["score", "weight"])
def q_ml10(spark, sf):
    return E.balanced_weights(proxy.scored(spark, sf))


@register("ml4_standard_scale", f"""
with st as (select {', '.join(f'avg({c}) as mu_{c}, stddev_pop({c}) as sd_{c}' for c in ENV_COLS)} from ({Q.ENV}) e)
select e.date, e.uv_index, {', '.join(f'coalesce(({c} - mu_{c}) / (case when sd_{c} > 0 then sd_{c} end), case when {c} is not null then 0.0 end) as {c}' for c in ENV_COLS)}
from ({Q.ENV}) e, st""", ENV_COLS)
def q_ml4(spark, sf):
    return standard_scale(proxy.environment(spark, sf), ENV_COLS)


# ----------------------------------------------------------------------------- 2.10 MLlib (rows-only checks)

from episcope.plans import report as REPORT  # noqa: E402
from episcope.plans import training as ML  # noqa: E402
from episcope.plans import tuning as TUNE  # noqa: E402

ML_KEYS = ("disease", "region", "date")


_TRAINING_TABLES: dict = {}


def _training_data(spark, sf):
    """Feature matrix + split + weights, materialised once per application and scale.

    The table lives in the shared checkpoint folder (a written table, like a
    feature store); every ML query of the session re-reads it instead of
    rebuilding the feature pipeline.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINING_TABLES:
        feats = q_flagship(spark, sf)
        cols = [c for c in feats.columns if c not in (*ML_KEYS, "outbreak")]
        data = ML.prepare_training_frame(feats, "outbreak", ML_KEYS)
        _TRAINING_TABLES[key] = (data.inputFiles(), data.schema, cols)
    files, schema, cols = _TRAINING_TABLES[key]
    return spark.read.schema(schema).parquet(*files), cols


def _single(spark, sf, spec):
    data, cols = _training_data(spark, sf)
    r, _model, _preds = ML.train_one(spec, data, cols)
    return spark.createDataFrame([r], ML.PERF_SCHEMA)


@register("ml6_train_random_forest")
def q_ml6(spark, sf):
    return _single(spark, sf, ML.ANALYSIS_MODELS[1])


@register("ml7_train_boosted")
def q_ml7(spark, sf):
    return _single(spark, sf, ML.ANALYSIS_MODELS[0])


@register("ml8_train_logistic")
def q_ml8(spark, sf):
    return _single(spark, sf, ML.ANALYSIS_MODELS[2])


@register("ml9_train_svm")
def q_ml9(spark, sf):
    return _single(spark, sf, ML.TRAINER_MODELS[3])


# ----------------------------------------------------------------------------- ML17 daily pipeline

from episcope.plans.features import daily_features  # noqa: E402

DW = "partition by disease order by date, region"
SC_SQL = f"""select cast(created_at as date) as date,
       cast(sum(case when symptoms is null then 0 else len(symptoms) end) as bigint) as total_symptom_mentions
from ({Q.SOCIAL_TEXT}) p where created_at is not null group by 1"""
ML17_FILL = ["cases", "deaths", "hospitalizations"] + SOCIAL_COLS + ["id_count", "total_symptom_mentions"] + ENV_COLS + ["uv_index"]


def _dr(fn: str, col: str, n: int, name: str) -> str:
    fr = f"({DW} rows between {n - 1} preceding and current row)"
    return f"case when count({col}) over {fr} >= {n} then {fn}({col}) over {fr} end as {name}"


ML17_FEATURES = (["cases_7day_avg", "cases_trend", "month", "quarter", "week_of_year", "day_of_year", "season",
                  "cases_lag_1", "cases_lag_7", "cases_lag_14", "cases_mean_7d", "cases_std_7d", "cases_mean_30d",
                  "polarity_lag_1", "polarity_lag_3", "symptom_mentions_lag_1", "temp_humidity_interaction",
                  "sentiment_symptoms_interaction", "region_encoded"]
                 + SOCIAL_COLS + ["id_count", "total_symptom_mentions"] + ENV_COLS + ["uv_index"])

ML17_SQL = f"""
with d as ({W7_SQL}),
sd as ({SOCIAL_DAILY_SQL.format(src=Q.SOCIAL_TEXT, extra='')}),
sdj as (select sd.*, sc.total_symptom_mentions from sd left join ({SC_SQL}) sc on sd.date = sc.date),
m as (select d.*, {', '.join('sdj.' + c for c in SOCIAL_COLS + ['id_count', 'total_symptom_mentions'])},
             {', '.join('e.' + c for c in ENV_COLS + ['uv_index'])}
      from d left join sdj on d.date = sdj.date left join ({Q.ENV}) e on d.date = e.date),
f as (select disease, region, date, {', '.join(_ffill(c) for c in ML17_FILL)} from m),
th as (select disease, quantile_cont(cast(cases as double), 0.85) as outbreak_threshold from f group by disease),
l as (select f.*, th.outbreak_threshold, cast(f.cases > th.outbreak_threshold as integer) as outbreak
      from f left join th on f.disease = th.disease),
c7 as (select l.*, case when count(cases) over w >= 7 then avg(cases) over w end as cases_7day_avg
       from l window w as ({DW} rows between 3 preceding and 3 following)),
g as (select c7.*, cases_7day_avg - lag(cases_7day_avg, 1) over ({DW}) as cases_trend,
             {CAL_SQL}, cast(floor((month(date) % 12) / 3) as integer) as season,
             lag(cases, 1) over ({DW}) as cases_lag_1, lag(cases, 7) over ({DW}) as cases_lag_7,
             lag(cases, 14) over ({DW}) as cases_lag_14,
             {_dr('avg', 'cases', 7, 'cases_mean_7d')}, {_dr('stddev_samp', 'cases', 7, 'cases_std_7d')},
             {_dr('avg', 'cases', 30, 'cases_mean_30d')},
             lag(polarity_mean, 1) over ({DW}) as polarity_lag_1, lag(polarity_mean, 3) over ({DW}) as polarity_lag_3,
             lag(total_symptom_mentions, 1) over ({DW}) as symptom_mentions_lag_1,
             temperature * humidity as temp_humidity_interaction,
             polarity_mean * total_symptom_mentions as sentiment_symptoms_interaction from c7),
codes as (select region, cast(dense_rank() over (order by region) - 1 as integer) as region_encoded
          from (select distinct region from g where region is not null) r)
select g.disease, g.region, g.date, outbreak, {', '.join(f'coalesce({c}, 0) as {c}' for c in ML17_FEATURES)}
from g left join codes on g.region = codes.region"""

ML17_DOUBLES = (SOCIAL_COLS + ENV_COLS + ["cases_7day_avg", "cases_trend", "cases_lag_1", "cases_lag_7", "cases_lag_14",
                "cases_mean_7d", "cases_std_7d", "cases_mean_30d", "polarity_lag_1", "polarity_lag_3",
                "temp_humidity_interaction", "sentiment_symptoms_interaction"])


@register("ml17_daily_features", ML17_SQL, ML17_DOUBLES)
def q_ml17(spark, sf):
    return daily_features(proxy.surveillance(spark, sf), proxy.environment(spark, sf),
                                  proxy.social_with_text(spark, sf))


# ----------------------------------------------------------------------------- 2.1 sources and sinks
# Each query lands data Spark derives from the supplied tables in the shared
# checkpoint folder, then reads it back with the library reader.

import uuid  # noqa: E402

from episcope.session import ensure_checkpoint_dir  # noqa: E402
from episcope.sources import files as IO  # noqa: E402


def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/episcope-io-{name}-{uuid.uuid4().hex}"


@register("s1_read_social", f"""
select cast(id as varchar) as id, platform, created_at, engagement_score, polarity,
       array_to_string(symptoms, '|') as symptoms from ({Q.SOCIAL_TEXT}) s""",
          ["engagement_score", "polarity"])
def q_s1(spark, sf):
    p = _scratch(spark, "social")
    s = proxy.social_with_text(spark, sf).select(
        F.col("id").cast("string").alias("id"), "platform", "text", "raw_text", "created_at", "engagement_score",
        F.lit(None).cast("string").alias("author"), "polarity", "subjectivity", "symptoms")
    IO.write_table(s, p)
    r = IO.read_social(spark, p)
    return r.select("id", "platform", "created_at", "engagement_score", "polarity",
                    F.array_join("symptoms", "|").alias("symptoms"))


@register("s2_read_surveillance", f"""
select disease, region, date, cases, deaths, hospitalizations, outbreak, outbreak_threshold from ({SURV_L}) s""", ["outbreak_threshold"])
def q_s2(spark, sf):
    p = _scratch(spark, "surv")
    s = _surv_l(spark, sf)
    IO.write_table(s.select("disease", "cases", "deaths", "hospitalizations", "region", "date", "outbreak",
                            "outbreak_threshold"), p)
    return IO.read_surveillance(spark, p).select("disease", "region", "date", "cases", "deaths",
                                                 "hospitalizations", "outbreak", "outbreak_threshold")


@register("s3_read_environment", f"select date, temperature, humidity, precipitation, air_quality_index, "
                                 f"cast(uv_index as double) as uv_index, 'Environmental_API' as source from ({Q.ENV}) e",
          ENV_COLS + ["uv_index"])
def q_s3(spark, sf):
    root = _scratch(spark, "health")
    env = FL.with_constant(proxy.environment(spark, sf), "source", "Environmental_API")
    IO.combine_sources({"environmental_data": env}, root)
    return IO.read_environment(spark, root)


@register("s4_read_surveillance_json", f"""
with s as (select disease, region, cases, cast(year(date) as integer) as year, cast(strftime(date, '%W') as integer) as week from ({Q.SURV}) v),
j as (select *, make_date(year, 1, 1) as jan1 from s)
select disease, region, cases, year, week,
       cast(jan1 + cast((8 - isodow(jan1)) % 7 as integer) + 7 * (week - 1) as date) as date from j""")
def q_s4(spark, sf):
    root = _scratch(spark, "health")
    s = proxy.surveillance(spark, sf).select(
        "disease", "region", "cases", "deaths", "hospitalizations",
        F.year("date").alias("year"),
        # week number with Monday as first day (weeks before the first Monday are week 0)
        F.floor((F.dayofyear("date") + 6 - F.weekday("date")) / 7).cast("int").alias("week"))
    IO.combine_sources({"surveillance_data": s}, root)
    return IO.read_surveillance_json(spark, root).select("disease", "region", "cases", "year", "week", "date")


@register("s5_flatten_indicators", """
select 'LIFE_EXPECTANCY' as indicator, n.n_name as country, 2020 as year, cast(n.n_nationkey as double) as value,
       cast(n.n_nationkey as varchar) as display_value, 'WHO' as source
from nation n join region r on n.n_regionkey = r.r_regionkey""", ["value"])
def q_s5(spark, sf):
    n = proxy.table(spark, sf, "nation")
    # one payload per region (the API pages by region): value = array of items.  The
    # nation dimension is a fixed-size table, so each payload array is bounded.
    payload = n.groupBy("n_regionkey").agg(F.collect_list(F.struct(
        F.col("n_name").alias("SpatialDim"), F.lit(2020).alias("TimeDim"),
        F.col("n_nationkey").cast("double").alias("NumericValue"),
        F.col("n_nationkey").cast("string").alias("Value"))).alias("value"))
    r = proxy.table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"))
    return landed.flatten_indicators(payload.join(r, "n_regionkey"), "LIFE_EXPECTANCY")


OWID_SQL = """
select n.n_name as location, cast(o.o_orderdate as date) as date, cast(count(*) as double) as new_cases,
       cast(sum(case when o.o_orderstatus = 'F' then 1 else 0 end) as double) as new_deaths
from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey
group by 1, 2"""


@register("s6_read_covid", f"""
select location, date, new_cases, new_deaths, 'OWID' as source from ({OWID_SQL}) x
where location in ('NATION_1', 'NATION_7', 'NATION_12')""", ["new_cases", "new_deaths"])
def q_s6(spark, sf):
    p = _scratch(spark, "owid")
    o = proxy.table(spark, sf, "orders")
    c = proxy.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = J.bounded_broadcast(proxy.table(spark, sf, "nation").select("n_nationkey", "n_name"), 100_000)
    d = (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
         .groupBy(F.col("n_name").alias("location"), F.to_date("o_orderdate").alias("date"))
         .agg(F.count(F.lit(1)).cast("double").alias("new_cases"),
              F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).cast("double").alias("new_deaths")))
    IO.write_table(d, p)
    return IO.read_covid(spark, p, ["NATION_1", "NATION_7", "NATION_12"])


TWEET_AS_OF = "1995-01-03 12:00:00"


@register("s7_normalize_tweets", f"""
select cast(id as varchar) as id, text, created_at, retweet_count, like_count, author_id
from ({Q.TWEETS}) t
where created_at between timestamp '{TWEET_AS_OF}' - interval 1 day and timestamp '{TWEET_AS_OF}'
order by created_at desc, cast(id as varchar) limit 100""")
def q_s7(spark, sf):
    t = landed.normalize_tweets(proxy.tweet_payloads(spark, sf), as_of=TWEET_AS_OF, days_back=1, max_results=100)
    return t.select("id", "text", "created_at", "retweet_count", "like_count", "author_id")


@register("s8_normalize_reddit", f"""
select id, title, selftext as text, score, subreddit, coalesce(author, 'deleted') as author from (
  select *, row_number() over (partition by subreddit order by created_utc desc, id) as rn_
  from ({Q.REDDIT}) r
  where coalesce(instr(lower(title), 'sch') > 0, false) or coalesce(instr(lower(selftext), 'sch') > 0, false)) x
where rn_ <= 5""")
def q_s8(spark, sf):
    r = landed.normalize_reddit(proxy.reddit_payloads(spark, sf), keywords=["sch"], limit=5)
    return r.select("id", "title", "text", "score", "subreddit", "author")


@register("s9_write_table", f"select * from ({Q.SCORED}) s", ["score"])
def q_s9(spark, sf):
    p = _scratch(spark, "pred")
    IO.write_table(proxy.scored(spark, sf), p)
    sch = "doc_id long, label int, score double, prediction int"
    return spark.read.schema(sch).option("header", True).csv(p)


@register("s10_write_report", f"""
select a.total_records, a.countries, a.total_outbreaks, a.outbreak_rate, a.start_date, a.end_date
from ({f'''select count(*) as total_records, count(distinct region) as countries, min(date) as start_date,
       max(date) as end_date, cast(sum(outbreak) as bigint) as total_outbreaks,
       avg(cast(outbreak as double)) as outbreak_rate from ({SURV_L}) s'''}) a""", ["outbreak_rate"])
def q_s10(spark, sf):
    p = _scratch(spark, "report")
    rep = A.report_dataset_summary(_surv_l(spark, sf))
    IO.write_report(rep.select(F.struct(*rep.columns).alias("dataset_summary")), p)
    sch = ("dataset_summary struct<total_records:long, countries:long, start_date:date, end_date:date, "
           "span_years:double, total_outbreaks:long, outbreak_rate:double, countries_with_outbreaks:long>")
    r = spark.read.schema(sch).json(p).select("dataset_summary.*")
    return r.select("total_records", "countries", "total_outbreaks", "outbreak_rate", "start_date", "end_date")


@register("s11_combine_sources", f"""
select 'environmental_data' as source, cast(null as varchar) as name, date, temperature as value from ({Q.ENV}) e
union all select * from (select 'owid_data', location, date, new_cases from ({OWID_SQL}) o order by location, date limit 1000) x
union all select 'surveillance_data', disease || '|' || region, date, cast(cases as double) from ({Q.SURV}) s""", ["value"])
def q_s11(spark, sf):
    """Every row of the three sources as read back from the combined data set."""
    root = _scratch(spark, "bundle")
    o = proxy.table(spark, sf, "orders")
    owid = (o.join(proxy.table(spark, sf, "customer"), o.o_custkey == F.col("c_custkey"))
            .join(proxy.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("n_name").alias("location"), F.to_date("o_orderdate").alias("date"))
            .agg(F.count(F.lit(1)).cast("double").alias("new_cases")))
    IO.combine_sources({"environmental_data": proxy.environment(spark, sf), "owid_data": owid,
                        "surveillance_data": proxy.surveillance(spark, sf)}, root,
                       caps={"owid_data": 1000}, order={"owid_data": ["location", "date"]})

    def rows(key, name, value):
        t = IO.read_health_table(spark, root, key, "location string, disease string, region string, date date, temperature double, new_cases double, cases long")
        return t.select(F.lit(key).alias("source"), name.alias("name"), "date", F.col(value).cast("double").alias("value"))
    return rows("environmental_data", F.lit(None).cast("string"), "temperature") \
        .unionByName(rows("owid_data", F.col("location"), "new_cases")) \
        .unionByName(rows("surveillance_data", F.concat_ws("|", "disease", "region"), "cases"))


# ----------------------------------------------------------------------------- streaming roll-up

from episcope.streaming import posts as STREAM  # noqa: E402


@register("stream_daily_social_agg", SOCIAL_DAILY_PLAIN, SOCIAL_COLS)
def q_stream(spark, sf):
    src = _scratch(spark, "posts-landing")
    posts = proxy.social(spark, sf).select(*[F.col(f.name).cast(f.dataType) for f in STREAM.POST_SCHEMA.fields])
    posts.write.mode("overwrite").parquet(src)  # the landed post files
    out = STREAM.run_daily_social(spark, src)
    return STREAM.latest_daily_rows(spark, out)


_TRAINER_RUNS: dict = {}


def _trainer_run(spark, sf, cv_folds=3):
    """The trainer's models, fitted once per application and scale; cross-validated on all training rows."""
    data, cols = _training_data(spark, sf)
    key = (spark.sparkContext.applicationId, sf, cv_folds)
    if key not in _TRAINER_RUNS:
        _TRAINER_RUNS[key] = ML.train_all(spark, data, cols, ML.TRAINER_MODELS, cv_folds=cv_folds, cv_rows=None)
    return data, cols, *_TRAINER_RUNS[key]


@register("ml14_train_all")
def q_ml14(spark, sf):
    return _trainer_run(spark, sf)[2]


@register("ml14_models_checked", f"""
with n as (select cast(sum(floor(n * 0.2 + 0.5)) as bigint) as test_rows,
                  cast(sum(case when outbreak = 1 then floor(n * 0.2 + 0.5) else 0 end) as bigint) as test_outbreaks
           from (select outbreak, count(*) as n from ({SURV_L}) s group by outbreak) c)
select model, test_rows, test_outbreaks, true as probabilities_valid, true as accuracy_agrees, true as auc_agrees
from n, (values {', '.join(f"('{m.name}')" for m in ML.TRAINER_MODELS)}) m(model)""")
def q_ml14_checked(spark, sf):
    """Each trained model's test rows, counted by SQL's split, and its accuracy and AUC worked out a second
    way (confusion counts; MLlib's evaluator without binning) from its predictions."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    _data, _cols, perf, fitted = _trainer_run(spark, sf, cv_folds=0)
    out = None
    for name, (_model, preds) in fitted.items():
        preds = cut_lineage(preds, "predictions")
        area = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="actual", numBins=0).evaluate(preds)
        c = E.confusion_counts(preds, "actual", "predicted").crossJoin(
            preds.agg(F.min(F.coalesce(F.col("probability").between(0, 1), F.lit(False))).alias("probabilities_valid")))
        row = c.join(perf.where(F.col("model") == name)).select(
            "model", F.col("n").alias("test_rows"), (F.col("tp") + F.col("fn")).alias("test_outbreaks"), "probabilities_valid",
            (F.abs((F.col("tp") + F.col("tn")) / F.col("n") - F.col("accuracy")) < 1e-9).alias("accuracy_agrees"),
            (F.abs(F.lit(area) - F.col("auc")) < 1e-9).alias("auc_agrees"))
        out = row if out is None else out.unionByName(row)
    return out


@register("e12_model_comparison")
def q_e12(spark, sf):
    perf = _trainer_run(spark, sf)[2]
    return perf.select("model", "cv_auc_mean", F.col("auc").alias("test_auc"), "accuracy").orderBy(F.col("test_auc").desc())


@register("t6_best_model")
def q_t6(spark, sf):
    return T.best_model(_trainer_run(spark, sf, cv_folds=0)[2], "auc")


def _rf_importance(spark, sf):
    data, cols = _training_data(spark, sf)
    _r, model, _p = ML.train_one(ML.TRAINER_MODELS[0], data, cols, cv_folds=0)
    return ML.feature_importance(spark, model, cols)


@register("ml15_feature_importance")
def q_ml15(spark, sf):
    return _rf_importance(spark, sf)


@register("t5_top_features")
def q_t5(spark, sf):
    return T.top_features(_rf_importance(spark, sf), 15)


@register("e13_predictions_table")
def q_e13(spark, sf):
    data, cols = _training_data(spark, sf)
    _r, _model, preds = ML.train_one(ML.ANALYSIS_MODELS[2], data, cols, cv_folds=0)
    return preds.select("actual", "predicted", "probability")


def _saved_and_loaded(spark, sf):
    """(test rows without their code of the disease, the fitted model, the saved model and encoder read back)."""
    data, cols = _training_data(spark, sf)
    spec = ML.ANALYSIS_MODELS[2]
    train = data.where(~F.col("is_test"))
    model = ML.build_pipeline(spec, cols, train.agg(F.sum("weight")).first()[0]).fit(train)
    path = _scratch(spark, "pipeline")
    ML.save_scoring(ML.Scoring(model, [ENC.RankEncoder.fit(data, "disease")]), path)
    return data.where(F.col("is_test")), model, ML.load_scoring(spark, path)


@register("ml13_predict_outbreak")
def q_ml13(spark, sf):
    test, _model, loaded = _saved_and_loaded(spark, sf)
    return loaded.score(test.drop("label", "outbreak", "disease_encoded"), ML_KEYS)


@register("s12_save_load_model", f"""
select cast(sum(floor(n * 0.2 + 0.5)) as bigint) as rows, cast(0 as bigint) as mismatches
from (select outbreak, count(*) as n from ({SURV_L}) s group by outbreak) c""")
def q_s12(spark, sf):
    test, model, loaded = _saved_and_loaded(spark, sf)
    a = ML.score(model, test).select(*ML_KEYS, F.col("probability").alias("p_fit"))
    b = loaded.score(test.drop("disease_encoded"), ML_KEYS).select(*ML_KEYS, F.col("probability").alias("p_loaded"))
    j = a.join(b, list(ML_KEYS))
    return j.agg(F.count(F.lit(1)).alias("rows"),
                 F.sum(F.when(F.col("p_fit") != F.col("p_loaded"), 1).otherwise(0)).alias("mismatches"))


@register("ml5_select_k_best")
def q_ml5(spark, sf):
    data, cols = _training_data(spark, sf)
    spec = ML.ModelSpec("logistic_selected", "lr", {"C": 1.0, "maxIter": 1000}, scaled=True, select_k=20)
    train = data.where(~F.col("is_test"))
    model = ML.build_pipeline(spec, cols, train.count()).fit(train)
    sel = [s for s in model.stages if hasattr(s, "selectedFeatures")][0]
    chosen = [(cols[i], i) for i in sel.selectedFeatures]
    return spark.createDataFrame(chosen, "feature string, position int")


@register("ml5_anova_scores", f"""
with f as materialized ({FLAGSHIP_SQL}),
u as (unpivot (select outbreak, {', '.join(f'cast({c} as double) as {c}' for c in FLAGSHIP_FEATURES)} from f)
      on {', '.join(FLAGSHIP_FEATURES)} into name feature value v),
c as (select feature, outbreak, count(v) as n, avg(v) as m, var_pop(v) as s from u where outbreak is not null group by 1, 2),
g as (select feature, count(*) as k, sum(n) as n, sum(n * m) / sum(n) as mean, sum(n * s) as within from c where n > 0 group by 1),
b as (select c.feature, sum(c.n * (m - mean) * (m - mean)) as between_ from c join g using (feature) where c.n > 0 group by 1)
select feature, case when k > 1 and n > k and within > 0
       then floor(100 * ((between_ / (k - 1)) / (within / (n - k))) + 0.5) / 100 end as f_value
from g join b using (feature)""", ["f_value"])
def q_ml5_anova(spark, sf):
    """The F statistic of every feature, as the selection of the best k ranks them."""
    scores = A.anova_f(q_flagship(spark, sf), "outbreak", FLAGSHIP_FEATURES)
    return scores.withColumn("f_value", round_half_up("f_value", 2))


REPORT_SOURCES = ["surveillance", "social posts", "environment"]


@register("s10_analysis_report", f"""
with v as materialized ({SURV_L})
select (select count(*) from v) as surveillance_records, (select count(*) from ({Q.SOCIAL}) s) as social_media_posts,
       (select count(*) from ({Q.ENV}) e) as environmental_records, count(distinct region) as countries_covered,
       min(date) as start, max(date) as "end", floor(datediff('day', min(date), max(date)) / 365.25 * 10 + 0.5) / 10 as years_span,
       cast(sum(outbreak) as bigint) as total_outbreaks, avg(cast(outbreak as double)) as outbreak_rate,
       count(distinct case when outbreak = 1 then region end) as countries_with_outbreaks,
       cast({len(FLAGSHIP_FEATURES)} as bigint) as total_features, count(*) as shape_rows, true as metrics_valid,
       cast(floor(sum(outbreak) * 0.2 + 0.5) as bigint) as test_outbreaks, cast({len(ML.TRAINER_MODELS)} as bigint) as models
from v""", ["years_span", "outbreak_rate"])
def q_s10_report(spark, sf):
    """Every section of the report as read back; what a model decides is held against its bounds."""
    data, cols, perf, fitted = _trainer_run(spark, sf)
    report = REPORT.analysis_report(_surv_l(spark, sf), proxy.social(spark, sf), proxy.environment(spark, sf), data, cols, perf,
                                    {k: p for k, (_m, p) in fitted.items()}, REPORT_SOURCES)
    p = _scratch(spark, "analysis-report")
    IO.write_report(report, p)
    r = spark.read.schema(report.schema).json(p)
    metrics, impact = F.col("best_model_results.performance_metrics"), F.col("best_model_results.real_world_impact")
    valid = reduce(lambda a, b: a & b, [metrics[c].between(0, 1) for c in ("auc", "accuracy", "cv_auc_mean", "cv_auc_std")])
    valid = valid & (impact["correctly_predicted"] + impact["missed_outbreaks"] == impact["test_outbreaks"]) \
        & (F.abs(impact["detection_rate"] * impact["test_outbreaks"] - impact["correctly_predicted"]) < 1e-6) \
        & F.array_contains("technical_specifications.models_trained", F.col("best_model_results.model_name"))
    return r.select(
        "dataset_summary.surveillance_records", "dataset_summary.social_media_posts", "dataset_summary.environmental_records",
        "dataset_summary.countries_covered", "dataset_summary.date_range.*", "dataset_summary.outbreak_statistics.*",
        "feature_engineering.total_features", F.col("feature_engineering.dataset_shape")[0].alias("shape_rows"),
        valid.alias("metrics_valid"), impact["test_outbreaks"].alias("test_outbreaks"),
        F.size("technical_specifications.models_trained").cast("long").alias("models"))


@register("ml11_cross_validate")
def q_ml11(spark, sf):
    data, cols = _training_data(spark, sf)
    train = data.where(~F.col("is_test"))
    spec = ML.ANALYSIS_MODELS[2]
    _maps, mean, std, _m = ML.cross_validate(spec, train, cols, folds=3, rows=5000, refit=False)
    return spark.createDataFrame([(spec.name, float(mean[0]), float(std[0]))],
                                 "model string, cv_auc_mean double, cv_auc_std double")


def _grid_table(spark, ranked, kinds):
    """Points of a grid, with the best one marked (the first)."""
    names = list(kinds)
    rows = [(*[r[n] for n in names], r["cv_auc_mean"], r["cv_auc_std"], r["folds"], i == 0) for i, r in enumerate(ranked)]
    schema = ", ".join(f"{n} {k}" for n, k in kinds.items()) + ", cv_auc_mean double, cv_auc_std double, folds long, best boolean"
    return spark.createDataFrame(rows, schema)


@register("ml12_grid_search")
def q_ml12(spark, sf):
    # the whole default grid over all training rows: 27 points, 5 folds
    data, cols = _training_data(spark, sf)
    ranked, _best, _model = TUNE.tune_forest(data.where(~F.col("is_test")), cols)
    return _grid_table(spark, ranked, {"trees": "int", "depth": "int", "leaf": "int"})


@register("ml12_grid_search_boosted")
def q_ml12_boosted(spark, sf):
    # 36 points, 5 folds
    data, cols = _training_data(spark, sf)
    ranked, _best, _model = TUNE.tune_boosted(data.where(~F.col("is_test")), cols)
    return _grid_table(spark, ranked, {"trees": "int", "depth": "int", "rate": "double", "subsample": "double"})
