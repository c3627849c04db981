"""The registered queries once more, as SQL for DuckDB. Written apart from the Spark plans."""

from __future__ import annotations

ORDERS_DAY = "date '2001-08-02'"
EVENTS_DAY = "date '2024-01-31'"
MID_MONTH = "date '2024-01-15'"
BATCH_SPLIT = "timestamp '1998-07-01 00:00:00'"
FIRST_RUN = "timestamp '2001-08-02 02:00:00'"
SECOND_RUN = "timestamp '2001-08-02 14:30:00'"

ORDERS = """
    select o_custkey as who, o_orderkey as what, o_orderdate as placed,
           cast(o_totalprice as decimal(28,6)) as amount
    from orders where o_orderstatus <> 'P'
"""
EVENTS = """
    select user_id as who, event_id as what, ts as placed, cast(value as decimal(28,6)) as amount
    from events where event_type <> 'error'
"""
EVENT_TYPES = EVENTS.replace("user_id", "cast(ascii(event_type) as bigint)")
TEXT_KEYS = ORDERS.replace("o_custkey as who", "'customer-of-the-shop-' || o_custkey as who")
SINGLE_ORDERS = ORDERS.replace("o_custkey as who", "o_orderkey as who")

# Rule number, label, then the inclusive limits of the three scores.
CORE_RULES = """(values
    (1, 'Champions', 4, 5, 4, 5, 4, 5),
    (2, 'Loyal High Spenders', 1, 5, 4, 5, 4, 5),
    (3, 'Loyal Budget Spenders', 1, 5, 4, 5, 1, 3),
    (4, 'Loyal At Risk', 1, 2, 4, 5, 1, 5),
    (5, 'At Risk', 1, 2, 1, 5, 1, 5),
    (6, 'Others', 1, 5, 1, 5, 1, 5)
) as rule(no, label, r_lo, r_hi, f_lo, f_hi, m_lo, m_hi)"""

# As above.
DETAILED_RULES = """(values
    (1, 'Champions', 4, 5, 4, 5, 4, 5),
    (2, 'Loyal High Spenders', 1, 3, 4, 5, 4, 5),
    (3, 'Loyal Budget Spenders', 1, 5, 4, 5, 1, 3),
    (4, 'Big Spenders', 3, 5, 1, 3, 4, 5),
    (5, 'New High Value Customers', 5, 5, 1, 2, 4, 5),
    (6, 'New Customers', 5, 5, 1, 2, 1, 2),
    (7, 'Potential Loyalists', 4, 5, 3, 3, 3, 3),
    (8, 'Promising Customers', 4, 4, 2, 2, 2, 2),
    (9, 'Loyal At Risk', 1, 2, 4, 5, 1, 5),
    (10, 'Big Spenders At Risk', 1, 2, 1, 5, 4, 5),
    (11, 'About to Churn', 2, 2, 1, 2, 1, 2),
    (12, 'Hibernating', 1, 1, 1, 2, 1, 2),
    (13, 'One-time Buyers', 1, 5, 1, 1, 1, 2),
    (14, 'Bargain Hunters', 1, 5, 3, 5, 1, 1),
    (15, 'Low Value Customers', 1, 3, 1, 2, 1, 2),
    (16, 'Others', 1, 5, 1, 5, 1, 5)
) as rule(no, label, r_lo, r_hi, f_lo, f_hi, m_lo, m_hi)"""

# Label and the inclusive limits of the score sum.
TIER_RULES = """(values
    ('Loyal Customers', 10, 15), ('Potential Loyalists', 8, 9), ('Promising Customers', 6, 7),
    ('At Risk', 4, 5), ('Hibernating', 3, 3)
) as rule(label, lo, hi)"""

SCORES = "r_score, f_score, m_score, rfm_score"


def _by_customer(source: str) -> str:
    return f"""
    select who as customer_id, max(placed) as newest, count(what) as frequency_orders,
           sum(amount) as spent
    from ({source}) group by who
    """


def _with_days(source: str, day: str, elapsed: bool = False) -> str:
    distance = (
        f"date_part('day', cast({day} as timestamp) - newest)"
        if elapsed
        else f"date_diff('day', cast(newest as date), {day})"
    )
    return f"""
    select {day} as run_date, customer_id, cast({distance} as int) as recency_days,
           frequency_orders, spent, cast(spent as double) as monetary_value
    from ({_by_customer(source)})
    """


def _with_scores(metrics: str) -> str:
    def bucket(order: str) -> str:
        ranking = f"partition by run_date order by {order}, customer_id nulls first"
        return f"cast(ntile(5) over ({ranking}) as int)"

    return f"""
    select *, r_score + f_score + m_score as rfm_score
    from (select *, {bucket("recency_days desc nulls first")} as r_score,
                 {bucket("frequency_orders nulls last")} as f_score,
                 {bucket("spent nulls last")} as m_score
          from ({metrics}))
    """


def _behaviour(rules: str) -> str:
    return f"""(
        select arg_min(label, no) from {rules}
        where r_score between r_lo and r_hi and f_score between f_lo and f_hi
          and m_score between m_lo and m_hi)"""


TIER = f"""(
    select coalesce(max(label), 'Others') from {TIER_RULES} where rfm_score between lo and hi)"""

METRICS = "recency_days, frequency_orders, monetary_value"


def _daily(metrics: str) -> str:
    return f"""
    select run_date, customer_id, {METRICS}, {SCORES}, {_behaviour(CORE_RULES)} as rfm_segment
    from ({_with_scores(metrics)})
    """


def _detailed(metrics: str) -> str:
    return f"""
    select run_date, customer_id, {METRICS}, {SCORES}, {TIER} as rfm_segment,
           {_behaviour(DETAILED_RULES)} as comments
    from ({_with_scores(metrics)})
    """


def _upsert(daily, replaced: list[str], kept: list[str], stamps_inserts: bool, logs: str) -> str:
    first = daily(_with_days(f"select * from ({ORDERS}) where placed < {BATCH_SPLIT}", ORDERS_DAY))
    second = daily(
        _with_days(f"select * from ({ORDERS}) where placed >= {BATCH_SPLIT}", ORDERS_DAY)
    )
    inserted = [FIRST_RUN, SECOND_RUN] if stamps_inserts else ["cast(null as timestamp)"] * 2
    taken = [
        f"case when b.customer_id is null then a.{name} else b.{name} end as {name}"
        for name in replaced
    ]
    empty = [f"cast(null as varchar) as {name}" for name in kept]
    return f"""
    select {ORDERS_DAY} as run_date, coalesce(a.customer_id, b.customer_id) as customer_id,
           {", ".join(taken + empty)}{logs},
           case when a.customer_id is null then {SECOND_RUN} else {FIRST_RUN} end as created_at,
           case when b.customer_id is null then {inserted[0]}
                when a.customer_id is null then {inserted[1]}
                else {SECOND_RUN} end as updated_at
    from ({first}) a full join ({second}) b on a.customer_id = b.customer_id
    """


UPSERTED = [name.strip() for name in f"{METRICS}, {SCORES}, rfm_segment".split(",")]

ORDER_METRICS = _with_days(ORDERS, ORDERS_DAY)
SINGLE_METRICS = _with_days(SINGLE_ORDERS, ORDERS_DAY)
EVENT_METRICS = _with_days(EVENTS, EVENTS_DAY)
EVENT_METRICS_ELAPSED = _with_days(EVENTS, EVENTS_DAY, elapsed=True)

LONG_METRICS = f"""
    select 'recency_days' as metric, cast(recency_days as double) as value from ({ORDER_METRICS})
    union all
    select 'frequency_orders', cast(frequency_orders as double) from ({ORDER_METRICS})
    union all
    select 'monetary_value', monetary_value from ({ORDER_METRICS})
"""


def _pairs(measures: str, metrics: str = ORDER_METRICS) -> str:
    pairs = [
        ("recency_days", "frequency_orders"),
        ("recency_days", "monetary_value"),
        ("frequency_orders", "monetary_value"),
    ]
    return " union all ".join(
        f"select '{x}' as x, '{y}' as y, {measures} "
        f"from (select {x} as a, {y} as b from ({metrics}))"
        for x, y in pairs
    )


def _digits(value: str) -> str:
    """Nine significant digits."""
    return f"cast(format('{{:.8e}}', {value}) as double)"


# A pair in which one metric never changes has no correlation.
R = "case when var_pop(a) > 0 and var_pop(b) > 0 then corr(b, a) end as r"


def _correlation(metrics: str) -> str:
    return f"""
    select x, y, {_digits("r")} as r, format('r = {{:.2f}}', r) as label
    from ({_pairs(R, metrics)})
    """


REGRESSION = _pairs(
    f"{_digits('regr_slope(b, a)')} as slope, {_digits('regr_intercept(b, a)')} as intercept, "
    f"{_digits('regr_r2(b, a)')} as r2, cast(regr_count(b, a) as bigint) as n"
)


def _significance(metrics: str) -> str:
    """Student's t density summed by Simpson's rule, as far as the density falls by e^45."""
    measured = _pairs(f"cast(regr_count(b, a) as bigint) as n, {R}", metrics)
    p_value = """2 * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi()) * step / 3
             * list_sum(list_transform(range(0, 6001), lambda i:
                 (case when i in (0, 6000) then 1 when i % 2 = 1 then 4 else 2 end)
                 * pow(1 + pow(t + i * step, 2) / v, -(v + 1) / 2)))"""
    return f"""
    select x, y, n, {_digits("r")} as r, {_digits(p_value)} as p_value
    from (select *, least(60, 45 * (v + t * t) / ((v + 1) * greatest(t, 1e-9))) / 6000 as step
          from (select *, cast(n - 2 as double) as v, abs(r) * sqrt((n - 2) / (1 - r * r)) as t
                from ({measured})))
    """


HISTOGRAM = f"""
    with vals as ({LONG_METRICS}),
    extent as (
        select metric, count(value) as n, min(value) as lo, max(value) as hi,
               2 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25))
                 / pow(count(value), 1 / 3.0) as step
        from vals group by metric),
    layout as (
        select *, (hi - lo) / bins as width
        from (select *, greatest(1, least(50, case when step = 0 then floor(sqrt(n))
                                                   else ceil((hi - lo) / step) end)) as bins
              from extent)),
    placed as (
        select metric, n, lo, width,
               cast(least(floor((value - lo) / width), bins - 1) as int) as bin
        from vals join layout using (metric))
    select metric, bin, {_digits("lo + bin * width")} as bin_start,
           {_digits("lo + bin * width + width")} as bin_end, count(*) as n_rows,
           {_digits("count(*) / (n * width)")} as density
    from placed group by metric, bin, lo, width, n
"""

DENSITY = f"""
    with vals as ({LONG_METRICS}),
    extent as (
        select metric, count(value) as n, min(value) as lo, max(value) as hi,
               stddev_samp(value) * pow(count(value), -0.2) as h
        from vals group by metric),
    grid as (
        select metric, n, h, cast(point as int) as point,
               lo - 3 * h + point * ((hi - lo + 6 * h) / 99) as spot
        from extent cross join range(0, 100) as points(point))
    select metric, point, {_digits("spot")} as x,
           {_digits("sum(exp(-0.5 * pow((spot - value) / h, 2))) / (n * h * sqrt(2 * pi()))")}
             as density
    from grid join vals using (metric)
    group by metric, point, spot, n, h
"""

BACKFILL_METRICS = f"""
    select run_date, customer_id, newest,
           cast(date_diff('day', cast(newest as date), run_date) as int) as recency_days,
           frequency_orders, spent, cast(spent as double) as monetary_value
    from (select cast(day as date) as run_date, who as customer_id, max(placed) as newest,
                 count(what) as frequency_orders, sum(amount) as spent
          from ({ORDERS})
          join generate_series(date '2001-07-30', date '2001-08-02', interval 1 day) as days(day)
            on cast(placed as date) <= day or placed is null
          group by day, who)
"""


BACKFILL_ELAPSED = f"""
    select * replace (cast(date_part('day', cast(run_date as timestamp) - newest) as int)
                      as recency_days)
    from ({BACKFILL_METRICS})
"""


def _scores(metrics: str) -> str:
    return f"select run_date, customer_id, {SCORES} from ({_with_scores(metrics)})"


def _label(name: str, label: str) -> str:
    return f"""
    select run_date, customer_id, {SCORES}, {label} as {name}
    from ({_with_scores(ORDER_METRICS)})
    """


def _recency(metrics: str) -> str:
    return f"select run_date, customer_id, recency_days from ({metrics})"


def _by_date(statistic: str) -> str:
    """A statistic of one date's metrics, for each date of the backfill."""
    days = ("2001-07-30", "2001-07-31", "2001-08-01", "2001-08-02")
    parts = []
    for day in days:
        metrics = f"select * from ({BACKFILL_METRICS}) where run_date = date '{day}'"
        parts.append(
            f"select date '{day}' as run_date, * from ({statistic.replace(ORDER_METRICS, metrics)})"
        )
    return " union all ".join(parts)


UPSERT_CORE = _upsert(_daily, UPSERTED, ["comments", "logs"], False, "")
UPSERT_DETAILED = _upsert(
    _detailed,
    [*UPSERTED, "comments"],
    [],
    True,
    """, '{"source":"daily_rfm_pipeline"}' as logs""",
)


def oracle_sql() -> dict[str, str]:
    return {
        "filter_status": """
            select o_custkey as customer_id, o_orderkey as order_id, o_orderdate as created_at,
                   cast(cast(o_totalprice as decimal(28,6)) as double) as total,
                   o_orderstatus as status
            from orders where o_orderstatus <> 'P'
        """,
        "rfm_base": f"""
            select customer_id, newest as last_order_date, frequency_orders,
                   cast(spent as double) as monetary_value
            from ({_by_customer(ORDERS)})
        """,
        "recency_calendar": _recency(EVENT_METRICS),
        "recency_elapsed": _recency(EVENT_METRICS_ELAPSED),
        "recency_elapsed_negative": _recency(_with_days(EVENTS, MID_MONTH, elapsed=True)),
        "scores": _scores(ORDER_METRICS),
        "scores_distributed": _scores(ORDER_METRICS),
        "scores_small": _scores(_with_days(EVENT_TYPES, EVENTS_DAY)),
        "scores_text_keys": _scores(_with_days(TEXT_KEYS, ORDERS_DAY)),
        "scores_text_keys_distributed": _scores(_with_days(TEXT_KEYS, ORDERS_DAY)),
        "segment_core": _label("rfm_segment", _behaviour(CORE_RULES)),
        "segment_detailed": _label("comments", _behaviour(DETAILED_RULES)),
        "score_tier": _label("rfm_segment", TIER),
        "rfm_daily": _daily(ORDER_METRICS),
        "rfm_daily_incremental": _daily(ORDER_METRICS),
        "rfm_daily_ingested": _daily(ORDER_METRICS),
        "rfm_daily_detailed": _detailed(EVENT_METRICS_ELAPSED),
        "rfm_daily_detailed_distributed": _detailed(EVENT_METRICS_ELAPSED),
        "upsert_core": UPSERT_CORE,
        "upsert_core_bucketed": UPSERT_CORE,
        "upsert_detailed": UPSERT_DETAILED,
        "upsert_detailed_files": UPSERT_DETAILED,
        "run_summary": f"""
            select {ORDERS_DAY} as run_date, count(distinct who) as records from ({ORDERS})
        """,
        "metric_correlation": _correlation(ORDER_METRICS),
        "metric_correlation_constant": _correlation(SINGLE_METRICS),
        "metric_significance_constant": _significance(SINGLE_METRICS),
        "metric_significance": _significance(ORDER_METRICS),
        "metric_significance_events": _significance(EVENT_METRICS),
        "metric_regression": REGRESSION,
        "metric_histogram": HISTOGRAM,
        "metric_histogram_distributed": HISTOGRAM,
        "metric_density": DENSITY,
        "metric_correlation_by_date": _by_date(_correlation(ORDER_METRICS)),
        "metric_significance_by_date": _by_date(_significance(ORDER_METRICS)),
        "metric_regression_by_date": _by_date(REGRESSION),
        "metric_histogram_by_date": _by_date(HISTOGRAM),
        "metric_density_by_date": _by_date(DENSITY),
        "rfm_backfill": _daily(BACKFILL_METRICS),
        "rfm_backfill_incremental": _daily(BACKFILL_METRICS),
        "rfm_backfill_corrected": _daily(BACKFILL_METRICS),
        "rfm_backfill_distributed": _daily(BACKFILL_METRICS),
        "rfm_backfill_detailed": _detailed(BACKFILL_ELAPSED),
        "backfill_summary": f"""
            select run_date, count(*) as records from ({BACKFILL_METRICS}) group by run_date
        """,
    }
