"""Deterministic insights and analytical reports.

Each generator is a small DataFrame over an aggregate (KPI comparison,
period-over-period per dimension, disruption split, weekday x band delay,
complaint categories, anomalies, data quality) with the common schema
``key, category, headline, detail, direction, importance, evidence``; the feed is their
``unionByName`` ranked by importance then key. Numbers inside headlines are
rounded half-even first, then formatted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions.metrics import METRICS, metric_columns, np_round
from ..plans.filters import Selection, period_filters
from ..plans.rollup import Rollup, merged
from . import anomalies, kpis, quality

INSIGHT_COLUMNS = ("key", "category", "headline", "detail", "direction", "importance", "evidence")
DIGITS = 6


def _fmt(pattern: str, *cols: Column) -> Column:
    return F.format_string(pattern, *cols)


def _evidence(texts: dict[str, Column], counts: dict[str, Column],
              numbers: dict[str, Column]) -> Column:
    """The figures behind an insight as one JSON object; numbers with 6 decimals."""
    def member(name: str, value: Column, shown: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), F.when(value.isNull(), "null").otherwise(shown))

    members = [member(k, v, F.regexp_replace(F.to_json(F.array(v)), r"^\[|\]$", ""))
               for k, v in texts.items()]
    members += [member(k, v, v.cast("string")) for k, v in counts.items()]
    members += [member(k, v, _fmt("%.6f", np_round(v, DIGITS))) for k, v in numbers.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}")).alias("evidence")


def _columns(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def _mover_told() -> list[Column]:
    current, previous = F.col("current_value"), F.col("previous_value")
    return [_fmt("%s went from %.2f to %.2f over %d journeys.", F.col("dimension_value"),
                 np_round(previous, 2), np_round(current, 2), F.col("current_journeys"))
            .alias("detail"),
            _evidence(_columns("dimension_value"), _columns("current_journeys"),
                      {"current": current, "previous": previous,
                       "percent_change": F.col("percent_change")})]


def first_by(row: Column, *keys: Column) -> Column:
    """The ``row`` of the group that sorts first on ``keys`` (ascending)."""
    return F.min_by(row, F.struct(*keys))


def kpi_movement(analytics: DataFrame, filters: Selection, rollup: Rollup | None = None) -> DataFrame:
    """Headline KPIs that moved by >= 3 % against the previous period."""
    cmp = kpis.compare_periods(analytics, filters, C.HEADLINE_KPIS, rollup)
    ch, pct = F.col("absolute_change"), F.col("percent_change")
    points = F.col("metric").isin(*[k for k in C.HEADLINE_KPIS if METRICS[k].compare_as_points])
    magnitude = F.when(points, _fmt("%.1f percentage points", np_round(F.abs(ch), 1))) \
        .otherwise(_fmt("%.1f%%", np_round(F.abs(pct), 1)))
    return (cmp.where(ch.isNotNull() & pct.isNotNull() & (F.abs(pct) >= C.MATERIAL_CHANGE_PCT))
            .select(F.concat(F.lit("kpi_"), F.col("metric")).alias("key"),
                    F.when(F.col("unit") == "count", C.CATEGORY_DEMAND)
                    .otherwise(C.CATEGORY_PERFORMANCE).alias("category"),
                    _fmt("%s %s by %s against the previous period.", F.col("label"),
                         F.when(ch > 0, "increased").otherwise("decreased"), magnitude)
                    .alias("headline"),
                    "direction",
                    np_round(F.least(F.abs(pct) / 10.0, F.lit(3.0)), DIGITS).alias("importance"),
                    _fmt("%s is %.2f, against %.2f in the previous period.", F.col("label"),
                         np_round("current", 2), np_round("previous", 2)).alias("detail"),
                    _evidence(_columns("metric", "unit"), {},
                              _columns("current", "previous", "absolute_change",
                                       "percent_change"))))


MOVER_CONFIGS = (
    ("customer_segment", "avg_satisfaction", C.CATEGORY_CUSTOMER, "customer segments"),
    ("region", "on_time_performance", C.CATEGORY_PERFORMANCE, "regions"),
    ("transport_mode", "total_journeys", C.CATEGORY_DEMAND, "transport modes"),
    ("region", "complaint_rate", C.CATEGORY_CUSTOMER, "regions"),
)


def dimension_movers(analytics: DataFrame, filters: Selection, dimension: str, metric: str,
                     category: str, noun: str, pop: DataFrame | None = None) -> DataFrame:
    """Best and worst mover of one metric across one dimension (>= 100
    journeys in both periods, >= 3 % move)."""
    spec = METRICS[metric]
    if pop is None:
        pop = kpis.period_over_period_by_dimension(analytics, filters, dimension, metric,
                                                   C.MIN_SAMPLE_FOR_COMPARISON)
    usable = pop.where(F.col("current_value").isNotNull() & F.col("previous_value").isNotNull())
    improvement = -F.col("absolute_change") if spec.lower_is_better else F.col("absolute_change")
    row = F.struct("dimension_value", "current_value", "previous_value", "current_journeys",
                   "absolute_change", "percent_change")
    # ties: the larger absolute move first (the comparison's order), then the value
    move = F.abs(F.col("absolute_change"))
    picked = usable.agg(first_by(row, -improvement, -move, F.col("dimension_value")).alias("best"),
                        first_by(row, improvement, -move, F.col("dimension_value")).alias("worst"))
    both = picked.select(F.explode(F.array(
        F.struct(F.lit(True).alias("is_best"), F.col("best").alias("r")),
        F.struct(F.lit(False).alias("is_best"), F.col("worst").alias("r")))).alias("x")) \
        .select("x.is_best", "x.r.*").where(F.col("dimension_value").isNotNull())
    ch, pct = F.col("absolute_change"), F.col("percent_change")
    magnitude = (_fmt("%.1f percentage points", np_round(F.abs(ch), 1)) if spec.compare_as_points
                 else _fmt("%.1f%%", np_round(F.abs(pct), 1)))
    return (both.where((F.abs(ch) >= 1e-6) & pct.isNotNull()
                       & (F.abs(pct) >= C.MATERIAL_CHANGE_PCT))
            .select(F.concat(F.lit(f"{dimension}_{metric}_"),
                             F.when(F.col("is_best"), "best").otherwise("worst")).alias("key"),
                    F.lit(category).alias("category"),
                    _fmt(f"%s recorded the largest %s in {spec.label.lower()} among {noun}, "
                         "which %s by %s.", F.col("dimension_value"),
                         F.when(F.col("is_best"), "improvement").otherwise("deterioration"),
                         F.when(ch > 0, "increased").otherwise("decreased"), magnitude)
                    .alias("headline"),
                    F.when(F.col("is_best"), "good").otherwise("bad").alias("direction"),
                    np_round(F.least(F.abs(pct) / 8.0, F.lit(3.0)), DIGITS).alias("importance"),
                    "dimension_value", np_round("current_value", DIGITS).alias("current"),
                    np_round("previous_value", DIGITS).alias("previous"),
                    "current_journeys", *_mover_told()))


CUBE_SETS = (("customer_segment",), ("region",), ("transport_mode",), ("service_disruption",),
             ("day_of_week", "time_band"), ("complaint_category",))
CUBE_METRICS = ("avg_satisfaction", "on_time_performance", "total_journeys", "complaint_rate",
                "avg_delay_minutes")


def _cube_from_rollup(rollup: Rollup, filters: Selection) -> DataFrame:
    """The insight cube from the rollup: the cells of its slices added up over both periods."""
    scan, current, previous = period_filters(filters)
    names = ["time_band" if len(st) > 1 else st[0] for st in CUBE_SETS]     # a weekday is a set of days
    weekday = F.when(F.col("slice") == "time_band", F.dayofweek("date") - 1)
    cells = rollup.cells.where(F.col("slice").isin(*names)).where(
        filters.period.extended_back(filters.period.days).holds())
    sums = cells.groupBy("slice", "value", weekday.alias("weekday")).agg(
        *[merged(m, c).cast("double").alias(f"{m}__{s}") for s, c in (("c", current), ("p", previous)) for m in CUBE_METRICS],
        F.coalesce(F.sum(F.when(current, F.col("journeys"))), F.lit(0)).alias("current_journeys"),
        F.coalesce(F.sum(F.when(previous, F.col("journeys"))), F.lit(0)).alias("previous_journeys"),
        F.coalesce(F.sum(F.when(current, F.col("complaint_flag_sum"))), F.lit(0)).alias("complaints_c"))
    out = []
    for st, name in zip(CUBE_SETS, names):
        for c in st:
            here = F.col("slice") == name
            value = F.col("weekday") if c == "day_of_week" else (
                F.col("value").cast("boolean") if c == "service_disruption" else F.col("value"))
            out += [F.when(here, value).alias(c), F.when(here, 0).otherwise(1).alias(f"_g_{c}")]
    return sums.select(*out, *(c for c in sums.columns if c not in ("slice", "value", "weekday")))


def insight_cube(analytics: DataFrame, filters: Selection, rollup: Rollup | None = None) -> DataFrame:
    """ONE grouping-sets aggregate over previous-start..end feeding four
    generators (movers, disruption split, weekday x band pressure, complaint
    categories): every metric for both periods per set, plus current-period
    complaint counts. The result is small (sum of the sets' cardinalities) and
    is checkpointed so each generator reads it instead of re-scanning journeys."""
    from ..session import ensure_checkpoint_dir
    if rollup and rollup.answers(filters, CUBE_METRICS):
        ensure_checkpoint_dir(analytics.sparkSession)
        return _cube_from_rollup(rollup, filters).checkpoint(eager=True)
    scan, current, previous = period_filters(filters)
    cols = list(dict.fromkeys(c for st in CUBE_SETS for c in st))
    cube = (analytics.where(scan)
            .groupingSets([[F.col(c) for c in st] for st in CUBE_SETS], *[F.col(c) for c in cols])
            .agg(*[F.grouping(c).alias(f"_g_{c}") for c in cols],
                 *[METRICS[m].build(current).cast("double").alias(f"{m}__c") for m in CUBE_METRICS],
                 *[METRICS[m].build(previous).cast("double").alias(f"{m}__p") for m in CUBE_METRICS],
                 F.count(F.when(current, 1)).alias("current_journeys"),
                 F.count(F.when(previous, 1)).alias("previous_journeys"),
                 F.count(F.when(current & F.col("complaint_flag"), 1)).alias("complaints_c")))
    ensure_checkpoint_dir(analytics.sparkSession)
    return cube.checkpoint(eager=True)


def all_dimension_movers(analytics: DataFrame, filters: Selection,
                         cube: DataFrame | None = None) -> DataFrame:
    """I2 for every configured (dimension, metric) as ONE pipeline: a single
    grouping-sets aggregate (both periods, every needed metric), exploded to one
    row per (config, dimension value), then best / worst picked by windows
    partitioned by config (tiny). No per-config re-scan: column pruning would
    otherwise specialise - and so duplicate - the shared aggregate per consumer."""
    if cube is None:
        scan, current, previous = period_filters(filters)
        dims = list(dict.fromkeys(d for d, _, _, _ in MOVER_CONFIGS))
        keys = list(dict.fromkeys(m for _, m, _, _ in MOVER_CONFIGS))
        grouped = (analytics.where(scan)
                   .groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims])
                   .agg(*[F.grouping(d).alias(f"_g_{d}") for d in dims],
                        *[METRICS[m].build(current).cast("double").alias(f"{m}__c")
                          for m in keys],
                        *[METRICS[m].build(previous).cast("double").alias(f"{m}__p")
                          for m in keys],
                        F.count(F.when(current, 1)).alias("current_journeys"),
                        F.count(F.when(previous, 1)).alias("previous_journeys")))
    else:
        grouped = cube
    entries = [F.when(F.col(f"_g_{d}") == 0, F.struct(
        F.lit(f"{d}_{m}").alias("config"), F.col(d).cast("string").alias("dimension_value"),
        F.col(f"{m}__c").alias("current_value"), F.col(f"{m}__p").alias("previous_value")))
        for d, m, _, _ in MOVER_CONFIGS]
    long = (grouped.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull()))
                           .alias("e"), "current_journeys", "previous_journeys")
            .select("e.*", "current_journeys", "previous_journeys")
            .where(F.col("dimension_value").isNotNull()
                   & (F.col("current_journeys") >= C.MIN_SAMPLE_FOR_COMPARISON)
                   & (F.col("previous_journeys") >= C.MIN_SAMPLE_FOR_COMPARISON)
                   & F.col("current_value").isNotNull() & F.col("previous_value").isNotNull()))

    def lookup(values: dict[str, object]) -> Column:
        return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v))])[
            F.col("config")]
    cfg = {f"{d}_{m}": (d, m, cat, noun) for d, m, cat, noun in MOVER_CONFIGS}
    lower_better = lookup({k: METRICS[m].lower_is_better for k, (_, m, _, _) in cfg.items()})
    points = lookup({k: METRICS[m].compare_as_points for k, (_, m, _, _) in cfg.items()})
    ch = F.col("current_value") - F.col("previous_value")
    pct = F.when(F.col("previous_value") == 0, F.lit(None).cast("double")) \
        .otherwise(F.lit(100.0) * ch / F.abs(F.col("previous_value")))
    improvement = F.when(lower_better, -ch).otherwise(ch)
    per_config = Window.partitionBy("config")          # <= values of one dimension
    best = F.row_number().over(per_config.orderBy(
        improvement.desc(), F.abs(ch).desc(), F.col("dimension_value")))
    worst = F.row_number().over(per_config.orderBy(
        improvement.asc(), F.abs(ch).desc(), F.col("dimension_value")))
    ranked = long.select("*", ch.alias("absolute_change"), pct.alias("percent_change"),
                         best.alias("_best"), worst.alias("_worst"))
    picked = ranked.select("*", F.explode(F.filter(F.array(
        F.when(F.col("_best") == 1, F.lit(True)), F.when(F.col("_worst") == 1, F.lit(False))),
        lambda x: x.isNotNull())).alias("is_best"))
    a_ch, a_pct = F.col("absolute_change"), F.col("percent_change")
    magnitude = F.when(points, _fmt("%.1f percentage points", np_round(F.abs(a_ch), 1))) \
        .otherwise(_fmt("%.1f%%", np_round(F.abs(a_pct), 1)))
    label = lookup({k: METRICS[m].label.lower() for k, (_, m, _, _) in cfg.items()})
    noun = lookup({k: n for k, (_, _, _, n) in cfg.items()})
    return (picked.where((F.abs(a_ch) >= 1e-6) & a_pct.isNotNull()
                         & (F.abs(a_pct) >= C.MATERIAL_CHANGE_PCT))
            .select(F.concat(F.col("config"), F.lit("_"),
                             F.when(F.col("is_best"), "best").otherwise("worst")).alias("key"),
                    lookup({k: c for k, (_, _, c, _) in cfg.items()}).alias("category"),
                    _fmt("%s recorded the largest %s in %s among %s, which %s by %s.",
                         F.col("dimension_value"),
                         F.when(F.col("is_best"), "improvement").otherwise("deterioration"),
                         label, noun, F.when(a_ch > 0, "increased").otherwise("decreased"),
                         magnitude).alias("headline"),
                    F.when(F.col("is_best"), "good").otherwise("bad").alias("direction"),
                    np_round(F.least(F.abs(a_pct) / 8.0, F.lit(3.0)), DIGITS).alias("importance"),
                    "dimension_value", np_round("current_value", DIGITS).alias("current"),
                    np_round("previous_value", DIGITS).alias("previous"),
                    "current_journeys", *_mover_told()))


def disruption_impact(analytics: DataFrame, filters: Selection) -> DataFrame:
    """A10 + I3: complaint-rate multiplier of disrupted vs normal journeys (one
    scan, both groups as gated aggregates)."""
    keys = ("complaint_rate", "avg_satisfaction", "avg_delay_minutes")
    disrupted = F.col("service_disruption")
    normal = ~F.col("service_disruption")
    wide = analytics.where(filters.column()).agg(
        F.count(F.when(disrupted, 1)).alias("disrupted_journeys"),
        F.count(F.when(normal, 1)).alias("baseline_journeys"),
        *metric_columns(keys, disrupted, "_d"), *metric_columns(keys, normal, "_n"))
    return _disruption_rows(wide)


def _disruption_from_cube(cube: DataFrame) -> DataFrame:
    rows = cube.where((F.col("_g_service_disruption") == 0)
                      & F.col("service_disruption").isNotNull())
    sd = F.col("service_disruption")
    keys = ("complaint_rate", "avg_satisfaction", "avg_delay_minutes")
    wide = rows.agg(
        F.coalesce(F.max(F.when(sd, F.col("current_journeys"))), F.lit(0)).alias("disrupted_journeys"),
        F.coalesce(F.max(F.when(~sd, F.col("current_journeys"))), F.lit(0)).alias("baseline_journeys"),
        *[F.max(F.when(sd, F.col(f"{k}__c"))).alias(f"{k}_d") for k in keys],
        *[F.max(F.when(~sd, F.col(f"{k}__c"))).alias(f"{k}_n") for k in keys])
    return _disruption_rows(wide)


def _disruption_rows(wide: DataFrame) -> DataFrame:
    d_rate = F.coalesce(F.col("complaint_rate_d"), F.lit(0.0))
    n_rate = F.coalesce(F.col("complaint_rate_n"), F.lit(0.0))
    mult = d_rate / n_rate
    gap = (F.coalesce(F.col("avg_satisfaction_n"), F.lit(0.0))
           - F.coalesce(F.col("avg_satisfaction_d"), F.lit(0.0)))
    return (wide.where((F.col("disrupted_journeys") >= C.MIN_SAMPLE_FOR_COMPARISON)
                       & (F.col("baseline_journeys") > 0) & (n_rate > 0))
            .select(F.lit("disruption_impact").alias("key"),
                    F.lit(C.CATEGORY_OPERATIONS).alias("category"),
                    _fmt("Complaint rates were %.1fx higher on journeys affected by a service "
                         "disruption.", np_round(mult, 1)).alias("headline"),
                    F.when(mult > 1.2, "bad").otherwise("neutral").alias("direction"),
                    np_round(F.least(mult, F.lit(3.0)), DIGITS).alias("importance"),
                    np_round(d_rate, DIGITS).alias("disrupted_complaint_rate"),
                    np_round(n_rate, DIGITS).alias("baseline_complaint_rate"),
                    np_round(mult, 2).alias("multiplier"),
                    np_round(gap, DIGITS).alias("satisfaction_gap"),
                    np_round("avg_delay_minutes_d", DIGITS).alias("disrupted_avg_delay"),
                    np_round("avg_delay_minutes_n", DIGITS).alias("baseline_avg_delay"),
                    "disrupted_journeys", "baseline_journeys",
                    _fmt("The complaint rate is %.1f%% on %d disrupted journeys and %.1f%% on "
                         "%d others.", np_round(d_rate, 1), F.col("disrupted_journeys"),
                         np_round(n_rate, 1), F.col("baseline_journeys")).alias("detail"),
                    _evidence({}, _columns("disrupted_journeys", "baseline_journeys"),
                              {"disrupted_complaint_rate": d_rate, "baseline_complaint_rate": n_rate,
                               "multiplier": mult, "satisfaction_gap": gap,
                               "disrupted_avg_delay": F.col("avg_delay_minutes_d"),
                               "baseline_avg_delay": F.col("avg_delay_minutes_n")})))


def peak_pressure(analytics: DataFrame, filters: Selection) -> DataFrame:
    """A11 + I4: worst weekday x time band when its delay exceeds 1.15 x the
    journey-weighted mean of all groups (>= 100 journeys each)."""
    return _peak_rows(kpis.weekday_band_delay(analytics, filters))


def _peak_from_cube(cube: DataFrame) -> DataFrame:
    return _peak_rows(peak_groups_from_cube(cube))


def peak_groups_from_cube(cube: DataFrame) -> DataFrame:
    """The weekday x time-band groups of A11 read from the insight cube."""
    g = (cube.where(F.col("_g_day_of_week") == 0)
         .select("day_of_week", "time_band", F.col("current_journeys").alias("journeys"),
                 F.col("avg_delay_minutes__c").alias("avg_delay_minutes"),
                 F.col("on_time_performance__c").alias("on_time_performance"))
         .where(F.col("journeys") >= C.MIN_SAMPLE_FOR_COMPARISON))
    everything = Window.partitionBy()   # <= 7 x 4 grouped rows
    weighted = (F.sum(F.col("avg_delay_minutes") * F.col("journeys")).over(everything)
                / F.sum("journeys").over(everything))
    return g.select("*", weighted.alias("overall_delay"))


def _peak_rows(g: DataFrame) -> DataFrame:
    worst = g.agg(first_by(F.struct("day_of_week", "time_band", "avg_delay_minutes",
                                    "on_time_performance", "journeys", "overall_delay"),
                           -F.col("avg_delay_minutes"), F.col("day_of_week"),
                           F.col("time_band")).alias("w")).select("w.*")
    ratio = F.col("avg_delay_minutes") / F.col("overall_delay")
    day = F.element_at(F.array(*[F.lit(n) for n in C.DAY_NAMES]),
                       (F.col("day_of_week") + 1).cast("int"))
    return (worst.where(F.col("overall_delay").isNotNull() & (F.col("overall_delay") > 0)
                        & (F.col("avg_delay_minutes") > F.col("overall_delay") * 1.15))
            .select(F.lit("peak_pressure").alias("key"),
                    F.lit(C.CATEGORY_OPERATIONS).alias("category"),
                    _fmt("%s %s delay levels exceeded the period baseline.", day,
                         F.lower("time_band")).alias("headline"),
                    F.lit("bad").alias("direction"),
                    np_round(F.least((ratio - 1) * 4, F.lit(3.0)), DIGITS).alias("importance"),
                    day.alias("day"), "time_band",
                    np_round("avg_delay_minutes", DIGITS).alias("avg_delay_minutes"),
                    np_round("overall_delay", DIGITS).alias("period_average_delay_minutes"),
                    np_round(ratio, DIGITS).alias("ratio"), "journeys",
                    _fmt("Delay averages %.1f minutes there over %d journeys, %.2f times the "
                         "period average of %.1f.", np_round("avg_delay_minutes", 1),
                         F.col("journeys"), np_round(ratio, 2), np_round("overall_delay", 1))
                    .alias("detail"),
                    _evidence({"day": day, "time_band": F.col("time_band")}, _columns("journeys"),
                              {"avg_delay_minutes": F.col("avg_delay_minutes"),
                               "period_average_delay_minutes": F.col("overall_delay"),
                               "ratio": ratio})))


def complaint_concentration(analytics: DataFrame, filters: Selection) -> DataFrame:
    """A12 + I5: the top complaint category when it holds >= 20 % of >= 100 complaints."""
    return _complaint_rows(kpis.complaint_categories(analytics, filters))


def _complaints_from_cube(cube: DataFrame) -> DataFrame:
    g = (cube.where((F.col("_g_complaint_category") == 0)
                    & F.col("complaint_category").isNotNull() & (F.col("complaints_c") > 0))
         .select("complaint_category", F.col("complaints_c").alias("complaints")))
    total = F.sum("complaints").over(Window.partitionBy())   # one row per category
    return _complaint_rows(g.select("complaint_category", "complaints",
                                    total.alias("total_complaints"),
                                    (F.col("complaints") / total * 100.0).alias("share_pct")))


def _complaint_rows(cats: DataFrame) -> DataFrame:
    top = cats.agg(first_by(F.struct("complaint_category", "complaints", "total_complaints",
                                     "share_pct"),
                            -F.col("complaints"), F.col("complaint_category"))
                   .alias("t")).select("t.*")
    share = F.col("share_pct")
    return (top.where((F.col("total_complaints") >= C.MIN_SAMPLE_FOR_COMPARISON) & (share >= 20))
            .select(F.lit("complaint_concentration").alias("key"),
                    F.lit(C.CATEGORY_CUSTOMER).alias("category"),
                    _fmt("'%s' accounts for %.0f%% of all complaints in the selected population.",
                         F.col("complaint_category"), np_round(share, 0)).alias("headline"),
                    F.lit("neutral").alias("direction"),
                    np_round(F.least(share / 20.0, F.lit(2.5)), DIGITS).alias("importance"),
                    F.col("complaint_category").alias("top_category"),
                    F.col("complaints").alias("top_complaints"), "total_complaints",
                    np_round(share, 1).alias("share_pct"),
                    _fmt("%d of %d complaints that name a category.", F.col("complaints"),
                         F.col("total_complaints")).alias("detail"),
                    _evidence({"top_category": F.col("complaint_category")},
                              {"top_complaints": F.col("complaints"),
                               "total_complaints": F.col("total_complaints")},
                              {"share_pct": share})))


def top_anomaly(analytics: DataFrame, filters: Selection, rollup: Rollup | None = None) -> DataFrame:
    """The most extreme of the top 20 adverse region anomalies."""
    det = anomalies.detect(analytics, filters, "region", adverse_only=True, limit=20, rollup=rollup)
    worst = det.orderBy(F.abs(F.col("z_score")).desc(), F.col("period").desc(),
                        F.col("metric"), F.col("scope")).limit(1)
    return worst.select(F.lit("top_anomaly").alias("key"),
                        F.lit(C.CATEGORY_PERFORMANCE).alias("category"),
                        F.col("statement").alias("headline"),
                        F.lit("bad").alias("direction"),
                        np_round(F.least(F.abs(F.col("z_score")) / 2.0, F.lit(3.0)), DIGITS)
                        .alias("importance"),
                        "metric", "scope", "period", "z_score", "severity",
                        _fmt("A %s deviation of %s in %s: z score %.2f.", F.col("severity"),
                             F.col("metric"), F.col("scope"), np_round("z_score", 2))
                        .alias("detail"),
                        _evidence(_columns("metric", "scope", "severity")
                                  | {"period": F.col("period").cast("string")}, {},
                                  _columns("z_score")))


def data_quality_notice(raw: DataFrame, analytics: DataFrame,
                        filters: Selection) -> DataFrame:
    """Excluded-row notice unless exclusions < 0.1 % and completeness > 99.5 %."""
    s = quality.summary(raw, analytics, filters)
    pct = F.col("excluded_rows") / F.col("total_rows") * 100.0
    return (s.where((F.col("total_rows") > 0)
                    & ~((pct < 0.1) & (F.col("completeness_pct") > 99.5)))
            .select(F.lit("data_quality").alias("key"),
                    F.lit(C.CATEGORY_QUALITY).alias("category"),
                    _fmt("%d of %d rows (%.2f%%) were excluded from analysis by validity rules.",
                         F.col("excluded_rows"), F.col("total_rows"), np_round(pct, 2))
                    .alias("headline"),
                    F.when(pct > 1, "bad").otherwise("neutral").alias("direction"),
                    np_round(F.least(pct, F.lit(1.5)), DIGITS).alias("importance"),
                    "excluded_rows", "total_rows", "quality_score", "rating",
                    np_round("completeness_pct", DIGITS).alias("completeness_pct"),
                    _fmt("Quality is rated %s (%.1f), completeness is %.1f%%.", F.col("rating"),
                         np_round(F.col("quality_score").cast("double"), 1),
                         np_round("completeness_pct", 1)).alias("detail"),
                    _evidence(_columns("rating"), _columns("excluded_rows", "total_rows"),
                              {"quality_score": F.col("quality_score").cast("double"),
                               "completeness_pct": F.col("completeness_pct")})))


def generate(raw: DataFrame, analytics: DataFrame, filters: Selection, limit: int = 8,
             include_quality: bool = True, concurrent: bool = True,
             rollup: Rollup | None = None) -> DataFrame:
    """I8: every generator, ranked by importance (desc) then key; top ``limit``.

    The generators are independent jobs over the same tables. With
    ``concurrent`` they run as parallel Spark jobs (KPI movement, the anomaly
    scan, data quality and the cube chain), each checkpointing its few result
    rows to the shared folder; the feed is the union of those checkpoints."""
    def cube_chain() -> DataFrame:
        cube = insight_cube(analytics, filters, rollup)
        return _union([all_dimension_movers(analytics, filters, cube),
                       _disruption_from_cube(cube), _peak_from_cube(cube),
                       _complaints_from_cube(cube)])

    builders = [lambda: kpi_movement(analytics, filters, rollup), cube_chain,
                lambda: top_anomaly(analytics, filters, rollup)]
    if include_quality:
        builders.append(lambda: data_quality_notice(raw, analytics, filters))
    if concurrent:
        from concurrent.futures import ThreadPoolExecutor

        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(analytics.sparkSession)
        with ThreadPoolExecutor(max_workers=len(builders)) as pool:
            parts = list(pool.map(
                lambda b: b().select(*INSIGHT_COLUMNS).coalesce(1).checkpoint(eager=True),
                builders))
    else:
        parts = [b() for b in builders]
    ranked = _union(parts).orderBy(F.col("importance").desc(), F.col("key"))
    return ranked.limit(limit) if limit else ranked


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0].select(*INSIGHT_COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*INSIGHT_COLUMNS))
    return out


POPULATION = ("journeys", "customers", "regions", "modes", "service_lines", "first_date", "last_date")


def population_lines(analytics: DataFrame, filters: Selection) -> DataFrame:
    """The population of a selection as rows: section, position, text."""
    summary = kpis.population_summary(analytics, filters)
    lines = [F.struct(F.lit("population").alias("section"), F.lit(i).cast("bigint").alias("position"),
                      F.concat(F.lit(f"{name}: "), F.coalesce(F.col(name).cast("string"), F.lit("none"))).alias("text"))
             for i, name in enumerate(POPULATION)]
    return summary.select(F.inline(F.array(*lines)))


def executive_brief(raw: DataFrame, analytics: DataFrame, filters: Selection,
                    rollup: Rollup | None = None) -> DataFrame:
    """Brief sections as rows (section, position, text): the population, current
    performance (headline KPIs), key changes (<= 5), attention (<= 5 bad), positives (<= 4 good)."""
    cmp = kpis.compare_periods(analytics, filters, C.HEADLINE_KPIS, rollup)
    current = cmp.select(
        F.lit("current_performance").alias("section"), F.col("position").cast("bigint"),
        F.when(F.col("current").isNull(), _fmt("%s: no data", "label"))
        .when(F.col("absolute_change").isNull(),
              _fmt("%s: %.2f (no comparison period)", "label", np_round("current", 2)))
        .otherwise(_fmt("%s: %.2f (%+.2f vs previous period)", "label",
                        np_round("current", 2), np_round("absolute_change", 2)))
        .alias("text"))
    found = generate(raw, analytics, filters, limit=10, rollup=rollup)
    first_three = F.col("category").isin(C.CATEGORY_PERFORMANCE, C.CATEGORY_DEMAND,
                                         C.CATEGORY_CUSTOMER)
    # one pass over the (<= 10) ranked insights: each row fans out to the
    # sections it belongs to, then a per-section rank applies the caps
    tagged = found.select("*", F.explode(F.array(
        F.when(first_three, F.lit("key_changes")),
        F.when(F.col("direction") == "bad", F.lit("attention")),
        F.when(F.col("direction") == "good", F.lit("positives")))).alias("section")) \
        .where(F.col("section").isNotNull())
    caps = F.create_map(F.lit("key_changes"), F.lit(5), F.lit("attention"), F.lit(5),
                        F.lit("positives"), F.lit(4))
    pos = F.row_number().over(Window.partitionBy("section").orderBy(
        F.col("importance").desc(), F.col("key")))
    sections = tagged.select("section", pos.alias("p"), F.concat_ws(" ", "headline", "detail").alias("text")) \
        .where(F.col("p") <= caps[F.col("section")]) \
        .select("section", (F.col("p") - 1).cast("bigint").alias("position"), "text")
    return population_lines(analytics, filters).unionByName(current).unionByName(sections)


# ---------------------------------------------------------------------------
# Reports (the analytical tools behind question routing)
# ---------------------------------------------------------------------------

def report_kpi_movers(analytics: DataFrame, filters: Selection) -> DataFrame:
    """Headline KPIs that moved >= 2 %, the three largest."""
    cmp = kpis.compare_periods(analytics, filters, C.HEADLINE_KPIS)
    movers = cmp.where(F.col("percent_change").isNotNull()
                       & (F.abs(F.col("percent_change")) >= 2))
    return movers.orderBy(F.abs(F.col("percent_change")).desc(), F.col("position")).limit(3) \
        .select("metric", "label", "current", "previous", "absolute_change", "percent_change",
                "direction")


def report_kpi_summary(analytics: DataFrame, filters: Selection) -> DataFrame:
    """I10 as rows (section, position, text): the population, every headline KPI, and the
    three largest moves of 2 % or more (one row that says so if there is none)."""
    cmp = kpis.compare_periods(analytics, filters, C.HEADLINE_KPIS)
    level = cmp.select(
        F.lit("kpis").alias("section"), F.col("position").cast("bigint"),
        F.when(F.col("current").isNull(), _fmt("%s: no data", "label"))
        .otherwise(_fmt("%s: %.2f", "label", np_round("current", 2))).alias("text"))
    size = F.abs(F.col("percent_change"))
    # the headline KPIs of one comparison: at most six rows
    largest = cmp.agg(F.slice(F.array_sort(F.collect_list(F.when(size >= 2, F.struct(
        (-size).alias("order"), "position", "label", np_round("percent_change", 2).alias("change"))))), 1, 3).alias("m"))
    text = F.transform("m", lambda m: F.format_string("%s %+.2f %%", m["label"], m["change"]))
    told = F.when(F.size("m") > 0, text).otherwise(F.array(F.lit("no headline metric moved by 2 % or more")))
    moves = largest.select(F.posexplode(told).alias("position", "text")).select(
        F.lit("movements").alias("section"), F.col("position").cast("bigint"), "text")
    return population_lines(analytics, filters).unionByName(level).unionByName(moves)


def report_period_changes(analytics: DataFrame, filters: Selection) -> DataFrame:
    """The first 8 registered metrics ordered by absolute % change; the first
    four moves of >= 2 % are material."""
    keys = tuple(METRICS)[:8]
    cmp = kpis.compare_periods(analytics, filters, keys).where(
        F.col("percent_change").isNotNull())
    rank = F.row_number().over(Window.orderBy(F.abs(F.col("percent_change")).desc(),
                                              F.col("position")))   # <= 8 rows
    ranked = cmp.select("*", rank.cast("bigint").alias("rank"))
    big = F.abs(F.col("percent_change")) >= 2
    nth_big = F.sum(F.when(big, 1).otherwise(0)).over(
        Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    return ranked.select("metric", "label", "current", "previous", "absolute_change",
                         "percent_change", "direction", "rank",
                         (big & (nth_big <= 4)).alias("material"))


def report_dimension(analytics: DataFrame, filters: Selection, dimension: str,
                     focus: str | None, metric: str = "on_time_performance") -> DataFrame:
    """Breakdown of a dimension joined to its period-over-period movement,
    with the focus value and the best / worst mover flagged."""
    spec = METRICS[metric]
    breakdown = kpis.metrics_by_dimension(analytics, filters, dimension)
    move = kpis.period_over_period_by_dimension(analytics, filters, dimension, metric,
                                                C.MIN_SAMPLE_FOR_COMPARISON)
    move = move.where(F.col("absolute_change").isNotNull())
    score = -F.col("absolute_change") if spec.lower_is_better else F.col("absolute_change")
    # one row per dimension value: un-partitioned windows over a tiny result
    size = F.abs(F.col("absolute_change"))
    best = F.row_number().over(Window.orderBy(score.desc(), size.desc(), "dimension_value"))
    worst = F.row_number().over(Window.orderBy(score.asc(), size.desc(), "dimension_value"))
    flagged = move.select("dimension_value",
                          F.col("current_value").alias("move_current"),
                          F.col("previous_value").alias("move_previous"),
                          F.col("absolute_change").alias("move_change"),
                          (best == 1).alias("is_best"), (worst == 1).alias("is_worst"))
    joined = breakdown.join(flagged, "dimension_value", "left")
    return joined.select(
        "*", (F.col("dimension_value") == F.lit(focus)).alias("is_focus") if focus
        else F.lit(False).alias("is_focus"))


def report_complaints(analytics: DataFrame, filters: Selection) -> DataFrame:
    """The mode with the highest complaint rate and the most common reason."""
    by_mode = kpis.metrics_by_dimension(analytics, filters, "transport_mode",
                                        ("total_journeys", "complaint_rate"))
    worst = by_mode.agg(first_by(F.struct("dimension_value", "complaint_rate", "total_journeys"),
                                 -F.col("complaint_rate"), -F.col("total_journeys"),
                                 F.col("dimension_value")).alias("w"))
    by_cat = kpis.metrics_by_dimension(analytics, filters, "complaint_category",
                                       ("total_journeys",))
    top = by_cat.agg(first_by(F.struct("dimension_value", "total_journeys"),
                              -F.col("total_journeys"), F.col("dimension_value")).alias("t"),
                     F.sum("total_journeys").alias("total"))
    from ..sources.feeds import combine_rows
    return combine_rows(
        worst.select(F.col("w.dimension_value").alias("worst_mode"),
                     np_round("w.complaint_rate", DIGITS).alias("worst_mode_complaint_rate"),
                     F.col("w.total_journeys").alias("worst_mode_journeys")),
        top.select(F.col("t.dimension_value").alias("top_reason"),
                   np_round(F.col("t.total_journeys") / F.col("total") * 100, DIGITS)
                   .alias("top_reason_share")))


def report_satisfaction(analytics: DataFrame, filters: Selection) -> DataFrame:
    """I16: the segments with the largest fall and rise in satisfaction, of those with enough journeys in
    both periods, and the current levels of all segments that have one (name: mean (journeys), by name)."""
    move = kpis.period_over_period_by_dimension(analytics, filters, "customer_segment",
                                                "avg_satisfaction", 0)
    row = F.struct("dimension_value", "previous_value", "current_value", "percent_change")
    usable = move.where(F.col("absolute_change").isNotNull()
                        & (F.least("current_journeys", "previous_journeys") >= C.MIN_SAMPLE_FOR_COMPARISON))
    size = F.abs(F.col("absolute_change"))
    # one row per segment
    known = move.where(F.col("current_value").isNotNull()).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("dimension_value", "current_value", "current_journeys"))),
        lambda r: F.format_string("%s: %.2f (%d)", r["dimension_value"], np_round(r["current_value"], 2),
                                  r["current_journeys"])), "; ").alias("current_levels"))
    pick = usable.agg(
        first_by(row, F.col("absolute_change"), -size, F.col("dimension_value")).alias("w"),
        first_by(row, -F.col("absolute_change"), -size, F.col("dimension_value")).alias("b"))
    return pick.select(
        known.scalar().alias("current_levels"),
        F.col("w.dimension_value").alias("worst_segment"),
        np_round("w.previous_value", DIGITS).alias("worst_previous"),
        np_round("w.current_value", DIGITS).alias("worst_current"),
        np_round("w.percent_change", DIGITS).alias("worst_percent_change"),
        F.col("b.dimension_value").alias("best_segment"),
        np_round("b.previous_value", DIGITS).alias("best_previous"),
        np_round("b.current_value", DIGITS).alias("best_current"),
        np_round("b.percent_change", DIGITS).alias("best_percent_change"))


def report_top_issues(raw: DataFrame, analytics: DataFrame, filters: Selection) -> DataFrame:
    """The three most important adverse findings, else the top three."""
    found = generate(raw, analytics, filters, limit=10)
    rank = F.row_number().over(Window.orderBy(
        (F.col("direction") != "bad"), F.col("importance").desc(), F.col("key")))  # <= 10 rows
    has_bad = F.max((F.col("direction") == "bad").cast("int")).over(Window.partitionBy())
    ranked = found.select("*", rank.alias("rank"), has_bad.alias("has_bad"))
    return ranked.where((F.col("rank") <= 3)
                        & ((F.col("has_bad") == 0) | (F.col("direction") == "bad"))) \
        .select(F.col("rank").cast("bigint").alias("rank"), *INSIGHT_COLUMNS)
