"""Independent SQL for every registered query (DuckDB dialect).

The statements follow the inventory's semantics: one joined relation of listing
and host rows, one aggregate with FILTER clauses a mart, windows for the month
series and the area mapping, dimensions joined after the aggregate - over the
same adapter written in SQL. Six-digit HALF_UP ratios are computed with integers
(round-half-up of |a| * 10^6 / b, sign restored) because the engine's own
decimal division returns DOUBLE; decimals are presented as DOUBLE and sums as
BIGINT on both sides.
"""
from __future__ import annotations

from staylens import schemas

# -- adapter (mirrors sources.testdata) -------------------------------------
_SNAPSHOT = """
snapshot AS (
  SELECT
    l.l_partkey AS listing_id,
    l.l_orderkey AS scrape_id,
    strftime(o.o_orderdate, '%Y-%m-%d') AS scraped_date,
    l.l_suppkey AS host_id,
    s.s_name AS host_name,
    strftime(l.l_shipdate, '%Y-%m-%d') AS host_since,
    CASE WHEN l.l_returnflag = 'A' THEN 't' ELSE 'f' END AS host_is_superhost,
    cn.n_name AS host_neighbourhood,
    sn.n_name AS listing_neighbourhood,
    p.p_type AS property_type,
    p.p_brand AS room_type,
    CAST(p.p_size AS BIGINT) AS accommodates,
    CAST(round(l.l_extendedprice) AS BIGINT) AS price,
    CASE WHEN l.l_linestatus = 'O' THEN 't' ELSE 'f' END AS has_availability,
    CAST(l.l_quantity AS BIGINT) % 31 AS availability_30,
    CAST(l.l_linenumber AS BIGINT) AS number_of_reviews,
    CASE WHEN l.l_returnflag = 'R' THEN NULL
         ELSE CAST(CAST(l.l_quantity AS BIGINT) + 50 AS DOUBLE) END AS review_scores_rating,
    CAST(l.l_linenumber AS DOUBLE) + 0.5 AS review_scores_accuracy,
    CAST(CAST(l.l_quantity AS BIGINT) % 11 AS DOUBLE) AS review_scores_cleanliness,
    CAST(CAST(l.l_quantity AS BIGINT) % 7 AS DOUBLE) AS review_scores_checkin,
    CASE WHEN l.l_linestatus = 'F' THEN NULL
         ELSE CAST(CAST(l.l_quantity AS BIGINT) % 5 AS DOUBLE) END AS review_scores_communication,
    CAST(CAST(l.l_quantity AS BIGINT) % 9 AS DOUBLE) + 0.5 AS review_scores_value
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
)"""

_LISTING_D = """
listing_d AS (
  SELECT listing_id, listing_neighbourhood, property_type, room_type, accommodates,
         price, has_availability, availability_30, number_of_reviews,
         CAST(CAST(review_scores_rating AS DECIMAL(38,0)) AS BIGINT) AS review_scores_rating,
         CAST(CAST(review_scores_accuracy AS DECIMAL(38,0)) AS BIGINT) AS review_scores_accuracy,
         CAST(CAST(review_scores_cleanliness AS DECIMAL(38,0)) AS BIGINT) AS review_scores_cleanliness,
         CAST(CAST(review_scores_checkin AS DECIMAL(38,0)) AS BIGINT) AS review_scores_checkin,
         CAST(CAST(review_scores_communication AS DECIMAL(38,0)) AS BIGINT) AS review_scores_communication,
         CAST(CAST(review_scores_value AS DECIMAL(38,0)) AS BIGINT) AS review_scores_value
  FROM snapshot
)"""

_HOST_D = """
host_d AS (
  SELECT listing_id, scrape_id, scraped_date, host_id, host_name, host_since,
         host_is_superhost, host_neighbourhood
  FROM snapshot
)"""

_LGA_D = """
lga_d AS (
  SELECT CAST(10000 + n_nationkey AS BIGINT) AS lga_code, n_name AS lga_name FROM nation
)"""

_SUBURB_D = """
suburb_d AS (
  SELECT lower(n.n_name) AS lga_name, n.n_name || ' ' || t.side AS suburb_name
  FROM nation n, (VALUES ('NORTH'), ('SOUTH')) t(side)
)"""


def _census_01() -> str:
    bands = {"tot_p": None, "age_0_4_yr": "AUTOMOBILE", "age_5_14_yr": "BUILDING",
             "age_15_19_yr": "FURNITURE", "age_20_24_yr": "HOUSEHOLD"}
    sel = []
    for name in schemas.CENSUS_COUNT_COLUMNS:
        band, sex = name.rsplit("_", 1)
        if band in bands:
            seg = bands[band]
            conds = ["c.c_custkey IS NOT NULL" if seg is None else f"c.c_mktsegment = '{seg}'"]
            if sex == "m":
                conds.append("c.c_custkey % 2 = 0")
            elif sex == "f":
                conds.append("c.c_custkey % 2 <> 0")
            sel.append(f"CAST(count(*) FILTER (WHERE {' AND '.join(conds)}) AS BIGINT) AS {name}")
        else:
            sel.append(f"CAST(0 AS BIGINT) AS {name}")
    return ("census_01 AS (\n  SELECT 'LGA' || CAST(10000 + n.n_nationkey AS VARCHAR) AS lga_code_2016,\n    "
            + ",\n    ".join(sel)
            + "\n  FROM nation n LEFT JOIN customer c ON n.n_nationkey = c.c_nationkey\n"
              "  GROUP BY n.n_nationkey\n)")


_CENSUS_02 = """
census_02 AS (
  SELECT 'LGA' || CAST(10000 + n.n_nationkey AS VARCHAR) AS lga_code_2016,
         CAST(30 + n.n_nationkey AS BIGINT) AS median_age_persons,
         coalesce(max(CAST(round(c.c_acctbal) AS BIGINT)), 0) AS median_mortgage_repay_monthly,
         CAST(count(c.c_custkey) * 10 AS BIGINT) AS median_tot_prsnl_inc_weekly,
         CAST(count(c.c_custkey) * 3 AS BIGINT) AS median_rent_weekly,
         CAST(count(c.c_custkey) * 20 AS BIGINT) AS median_tot_fam_inc_weekly,
         1.25::DOUBLE AS average_num_psns_per_bedroom,
         CAST(count(c.c_custkey) * 15 AS BIGINT) AS median_tot_hhd_inc_weekly,
         2.5::DOUBLE AS average_household_size
  FROM nation n LEFT JOIN customer c ON n.n_nationkey = c.c_nationkey
  GROUP BY n.n_nationkey
)"""


def _census_d() -> str:
    counts = ", ".join(f"c1.{c}" for c in schemas.CENSUS_COUNT_COLUMNS)
    meds = ", ".join(f"c2.{c}" for c in schemas.CENSUS_MEDIAN_COLUMNS)
    return ("census_d AS (\n  SELECT CAST(CAST(right(c1.lga_code_2016, 5) AS DECIMAL(38,0)) AS BIGINT)"
            f" AS lga_code_2016, {counts}, {meds}\n"
            "  FROM census_01 c1 JOIN census_02 c2 ON c1.lga_code_2016 = c2.lga_code_2016\n)")


def _with(*extra: str) -> str:
    ctes = [_SNAPSHOT, _LISTING_D, _HOST_D, _LGA_D, _SUBURB_D, _census_01(), _CENSUS_02, _census_d()]
    return "WITH " + ",\n".join([c.strip() for c in ctes] + [e.strip() for e in extra])


def r6(a: str, b: str, times100: bool = False) -> str:
    """HALF_UP(a / b, 6) [x 100] as DOUBLE; null when b is 0 or null."""
    mul = " * 100" if times100 else ""
    return (f"(CASE WHEN ({b}) = 0 THEN NULL ELSE "
            f"CAST((CASE WHEN ({a}) < 0 THEN -1 ELSE 1 END) * "
            f"((2 * abs(CAST(({a}) AS HUGEINT)) * 1000000 + ({b})) // (2 * CAST(({b}) AS HUGEINT))){mul}"
            f" AS DOUBLE) / 1000000.0::DOUBLE END)")


_PAIR = """
pair AS (
  SELECT ls.listing_neighbourhood, ls.property_type, ls.room_type, ls.accommodates, ls.price,
         ls.has_availability = 't' AS is_open, ls.has_availability = 'f' AS is_shut,
         30 - ls.availability_30 AS nights, ls.review_scores_rating AS rating,
         hs.host_name, hs.host_neighbourhood, hs.host_is_superhost AS flag,
         substr(hs.scraped_date, 1, 7) AS s_date
  FROM listing_d AS ls INNER JOIN host_d AS hs USING (listing_id)
)"""

_CHANGE = """
monthly AS (
  SELECT s_date, count(*) FILTER (is_open) AS open_now, count(*) FILTER (is_shut) AS shut_now
  FROM pair WHERE s_date IS NOT NULL GROUP BY s_date
  HAVING bool_or(is_open) AND bool_or(is_shut)
)""", """
change AS (
  SELECT *, lag(open_now) OVER by_month AS open_before, lag(shut_now) OVER by_month AS shut_before
  FROM monthly WINDOW by_month AS (ORDER BY s_date)
)"""

_HOME = """
home AS (
  SELECT host_neighbourhood, listing_neighbourhood, count(*) AS n
  FROM pair WHERE host_neighbourhood IS NOT NULL GROUP BY 1, 2
  QUALIFY count(*) = max(count(*)) OVER (PARTITION BY host_neighbourhood)
)"""


def _open_figures() -> str:
    """Aggregates over the pairs whose listing is open."""
    return """min(price) FILTER (is_open) AS min_price, max(price) FILTER (is_open) AS max_price,
         avg(price) FILTER (is_open) AS avg_price, median(price) FILTER (is_open) AS median_price,
         count(DISTINCT host_name) FILTER (is_open) AS distinct_host_count,
         avg(rating) FILTER (is_open) AS avg_review_scores_rating,
         sum(nights) FILTER (is_open) AS open_nights, sum(price) FILTER (is_open) AS open_price"""


def _mart_columns(prefix: str = "") -> str:
    return f"""{prefix}{r6('n_open', 'n_all', True)} AS active_listing_rate,
       min_price, max_price, avg_price, median_price, distinct_host_count, avg_review_scores_rating,
       {r6('open_now - open_before', 'open_before', True)} AS active_percentage_change,
       {r6('shut_now - shut_before', 'shut_before', True)} AS inactive_percentage_change,
       {r6('n_super', 'n_flagged', True)} AS superhost_rate,
       CAST(open_nights AS BIGINT) AS total_staying,
       CAST(open_nights * open_price AS DOUBLE) AS average_estimated_revenue"""


def _mart_sql(keys: list[str], include_keys: bool = True, row_no: bool = False) -> str:
    """One pass over the pairs a mart; groups need an open listing, a superhost,
    known keys and a month of the change series."""
    by = ", ".join(keys)
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    grouped = f"""
grouped AS (
  SELECT {by}, s_date, count(*) AS n_all, count(*) FILTER (is_open) AS n_open,
         count(flag) AS n_flagged, count(*) FILTER (flag = 't') AS n_super,
         {_open_figures()}
  FROM pair WHERE {known} GROUP BY {by}, s_date
  HAVING bool_or(is_open) AND bool_or(flag = 't')
)"""
    lead = f"{by}, s_date, " if include_keys else ""
    if row_no:
        lead = f"row_number() OVER (ORDER BY {by}, s_date) - 1 AS row_no, " + lead
    return _with(_PAIR, *_CHANGE, grouped) + f"""
SELECT {_mart_columns(lead)}
FROM grouped INNER JOIN change USING (s_date)"""


def _host_mart_sql() -> str:
    per_area = """
per_area AS (
  SELECT listing_neighbourhood AS host_neighbourhood_lga, s_date,
         count(DISTINCT host_name) AS distinct_host_count, sum(nights) * sum(price) AS revenue
  FROM pair SEMI JOIN home USING (host_neighbourhood, listing_neighbourhood)
  GROUP BY ALL
)"""
    return _with(_PAIR, _HOME, per_area) + f"""
SELECT host_neighbourhood_lga, s_date, distinct_host_count,
       CAST(revenue AS DOUBLE) AS average_estimated_revenue,
       {r6('revenue', 'distinct_host_count')} AS average_revenue_p_host
FROM per_area"""


#: Listing rows per neighbourhood, and its LGA with census and number of suburbs.
_AREA = """
area AS (
  SELECT lga_name AS listing_neighbourhood, lga_code,
         (SELECT count(*) FROM suburb_d WHERE lower(suburb_d.lga_name) = lower(lga_d.lga_name)) AS n_suburbs
  FROM lga_d
)"""


def _lga_revenue_sql(lead: str = "") -> str:
    ages = ",\n       ".join(f"CAST({a} * n_rows * n_suburbs AS BIGINT) AS {a}" for a in schemas.ADHOC_AGE_COLUMNS)
    return _with(_AREA, """
per_nb AS (
  SELECT listing_neighbourhood, count(*) AS n_rows, avg(review_scores_rating) AS rating,
         avg(review_scores_cleanliness) AS clean, sum(30 - availability_30) AS nights, sum(price) AS paid
  FROM listing_d WHERE has_availability = 't' GROUP BY 1
)""") + f"""
SELECT {lead}listing_neighbourhood, rating AS avg_review_scores_rating, clean AS review_scores_cleanliness,
       {ages},
       CAST(nights * n_suburbs AS BIGINT) AS total_staying, CAST(paid * n_suburbs AS BIGINT) AS price,
       CAST(nights * n_suburbs * paid * n_suburbs AS DOUBLE) AS revenue
FROM per_nb INNER JOIN area USING (listing_neighbourhood)
INNER JOIN census_d ON census_d.lga_code_2016 = area.lga_code
WHERE n_suburbs > 0"""


def _mortgage_sql(lead: str = "") -> str:
    return _with(_AREA, """
per_nb AS (
  SELECT listing_neighbourhood, count(*) AS n_rows, sum(30 - availability_30) AS nights, sum(price) AS paid
  FROM listing_d GROUP BY 1
)""") + f"""
SELECT {lead}listing_neighbourhood,
       CAST(median_mortgage_repay_monthly * n_rows * n_suburbs AS BIGINT) AS median_mortgage_annaully,
       CAST(paid * n_suburbs * nights * n_suburbs AS DOUBLE) AS estimated_revenue
FROM per_nb INNER JOIN area USING (listing_neighbourhood)
INNER JOIN census_d ON census_d.lga_code_2016 = area.lga_code
WHERE n_suburbs > 0"""


def _best_type_sql(lead: str = "") -> str:
    return _with() + f"""
SELECT {lead}listing_neighbourhood, property_type, room_type, accommodates,
       CAST(sum(30 - availability_30) AS BIGINT) AS total_staying, CAST(sum(price) AS BIGINT) AS price,
       CAST(sum(30 - availability_30) * sum(price) AS DOUBLE) AS revenue
FROM listing_d WHERE has_availability = 't'
GROUP BY listing_neighbourhood, property_type, room_type, accommodates"""


def _same_diff_sql(where: str = "true", lead: str = "") -> str:
    return _with() + f"""
SELECT {lead}host_name, count(*) FILTER (host_neighbourhood = listing_neighbourhood) AS same_neighbourhood,
       count(*) FILTER (host_neighbourhood <> listing_neighbourhood) AS different_neighbourhood
FROM snapshot WHERE host_name IS NOT NULL AND {where} GROUP BY host_name
HAVING bool_or(host_neighbourhood = listing_neighbourhood) AND bool_or(host_neighbourhood <> listing_neighbourhood)"""


def _numbered(statement: str, order: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {order}) - 1 AS row_no, * FROM (\n{statement}\n) AS t"


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["filter_active"] = _with() + "\nSELECT * FROM listing_d WHERE has_availability = 't'"
    q["agg_sum_expr"] = _with() + """
SELECT listing_neighbourhood, CAST(sum(30 - availability_30) AS BIGINT) AS total_staying
FROM listing_d GROUP BY listing_neighbourhood"""
    q["agg_product_of_sums"] = _with() + """
SELECT listing_neighbourhood, CAST(sum(30 - availability_30) AS BIGINT) AS total_staying,
       CAST(sum(price) AS BIGINT) AS price,
       CAST(sum(30 - availability_30) * sum(price) AS DOUBLE) AS revenue
FROM listing_d WHERE has_availability = 't' GROUP BY listing_neighbourhood"""
    q["adhoc_best_listing_type"] = _best_type_sql()
    q["fn_left_month"] = _with() + """
SELECT substr(scraped_date, 1, 7) AS s_date, count(*) AS n_rows FROM host_d GROUP BY 1"""
    q["expr_ratio_scale6"] = _with("""
shares AS (SELECT listing_neighbourhood, count(*) FILTER (has_availability = 't') AS active_n,
             count(*) AS all_n FROM listing_d GROUP BY listing_neighbourhood)""") + f"""
SELECT *, {r6('active_n', 'all_n')} AS active_ratio, {r6('active_n', 'all_n', True)} AS active_listing_rate
FROM shares"""
    q["expr_lateral_alias"] = _with() + """
SELECT listing_neighbourhood, CAST(sum(30 - availability_30) AS BIGINT) AS total_staying,
       CAST(sum(price) AS BIGINT) AS total_price,
       CAST(sum(30 - availability_30) * sum(price) AS DOUBLE) AS revenue
FROM listing_d WHERE has_availability = 't' GROUP BY listing_neighbourhood"""
    q["agg_count_nonnull"] = _with() + """
SELECT listing_neighbourhood, count(review_scores_rating) AS n_rated, count(*) AS n_rows
FROM listing_d GROUP BY listing_neighbourhood"""
    q["agg_count_distinct"] = _with() + """
SELECT listing_neighbourhood, count(DISTINCT host_name) AS distinct_host_count
FROM snapshot GROUP BY listing_neighbourhood"""
    q["agg_min_max_avg"] = _with() + """
SELECT listing_neighbourhood, min(price) AS min_price, max(price) AS max_price,
       avg(price) AS avg_price
FROM listing_d WHERE has_availability = 't' GROUP BY listing_neighbourhood"""
    q["agg_median"] = _with() + """
SELECT listing_neighbourhood, room_type, median(price) AS median_price
FROM listing_d WHERE has_availability = 't' GROUP BY listing_neighbourhood, room_type"""
    q["agg_conditional_single_pass"] = _with(_PAIR) + """
SELECT listing_neighbourhood, s_date, count(*) FILTER (is_open) AS active_listing_count,
       count(*) AS all_listing_count, count(flag) AS all_count_host_is_superhost,
       count(*) FILTER (flag = 't') AS count_host_is_superhost
FROM pair GROUP BY ALL"""
    q["join_listing_host"] = _with(_PAIR) + """
SELECT s_date, count(*) AS n_rows, CAST(sum(price) AS BIGINT) AS sum_price FROM pair GROUP BY s_date"""
    q["win_lag_pct_change"] = _with(_PAIR, *_CHANGE) + f"""
SELECT s_date, open_now AS active_now, open_before AS active_before,
       {r6('open_now - open_before', 'open_before', True)} AS active_percentage_change,
       shut_now AS inactive_now, shut_before AS inactive_before,
       {r6('shut_now - shut_before', 'shut_before', True)} AS inactive_percentage_change
FROM change"""
    q["argmax_with_ties"] = _with(_PAIR, _HOME) + """
SELECT host_neighbourhood, listing_neighbourhood AS host_neighbourhood_lga, n AS counting FROM home"""
    q["sort_by_hidden_key"] = _mart_sql(["listing_neighbourhood"], include_keys=False)
    q["mart_active_listings"] = _with(_PAIR) + f"""
SELECT * EXCLUDE (open_nights, open_price), CAST(open_nights AS BIGINT) AS total_staying,
       CAST(open_price AS BIGINT) AS price
FROM (SELECT listing_neighbourhood, s_date, count(*) FILTER (is_open) AS active_listing_count,
         {_open_figures()}
      FROM pair GROUP BY ALL HAVING bool_or(is_open)) AS t"""
    q["mart_listing_neighbourhood"] = _mart_sql(["listing_neighbourhood"])
    q["mart_property_type"] = _mart_sql(["property_type", "room_type", "accommodates"])
    q["mart_host_neighbourhood"] = _host_mart_sql()
    q["dim_listing"] = _with() + "\nSELECT * FROM listing_d"
    q["dim_host"] = _with() + "\nSELECT * FROM host_d"
    q["dim_suburb"] = _with() + "\nSELECT * FROM suburb_d"
    q["dim_lga"] = _with() + "\nSELECT * FROM lga_d"
    q["dim_census"] = _with() + "\nSELECT * FROM census_d"
    q["dim_listing_surrogate_key"] = _with() + """
SELECT count(*) AS n_rows, count(*) AS n_distinct_ids, CAST(1 AS BIGINT) AS min_id,
       count(*) AS max_id, CAST(count(*) * (count(*) + 1) // 2 AS BIGINT) AS sum_id
FROM listing_d"""
    q["fn_right_cast_code"] = _with() + """
SELECT lga_code_2016, CAST(CAST(right(lga_code_2016, 5) AS DECIMAL(38,0)) AS BIGINT) AS lga_code
FROM census_01"""
    q["join_listing_lga"] = _with() + """
SELECT lga_code, lga_name, count(*) AS n_rows, CAST(sum(price) AS BIGINT) AS sum_price
FROM lga_d INNER JOIN listing_d ON listing_neighbourhood = lga_name GROUP BY ALL"""
    q["join_census_lga"] = _with() + """
SELECT lga_code, lga_name, tot_p_p, age_0_4_yr_p, median_mortgage_repay_monthly
FROM census_d INNER JOIN lga_d ON lga_code = lga_code_2016"""
    q["join_lower_suburb"] = _with() + """
SELECT lga_code, lga_d.lga_name, suburb_name
FROM suburb_d INNER JOIN lga_d ON lower(suburb_d.lga_name) = lower(lga_d.lga_name)"""
    q["fact_rental_by_month"] = _with(_PAIR, _AREA) + """
SELECT s_date, CAST(sum(n_suburbs) AS BIGINT) AS n_rows, CAST(sum(price * n_suburbs) AS BIGINT) AS sum_price,
       (SELECT CAST(sum(a.n_suburbs) AS BIGINT) FROM area AS a WHERE a.listing_neighbourhood IN
         (SELECT q.listing_neighbourhood FROM pair AS q WHERE q.s_date = p.s_date)
         AND a.lga_code IN (SELECT lga_code_2016 FROM census_d)) AS n_suburbs
FROM pair AS p INNER JOIN area USING (listing_neighbourhood)
WHERE lga_code IN (SELECT lga_code_2016 FROM census_d) AND n_suburbs > 0
GROUP BY s_date"""
    q["adhoc_lga_revenue"] = _lga_revenue_sql()
    q["adhoc_revenue_vs_mortgage"] = _mortgage_sql()
    q["adhoc_host_same_vs_diff"] = _same_diff_sql()
    q["adhoc_host_same_vs_diff_month"] = _same_diff_sql("substr(scraped_date, 1, 7) = '1995-03'")
    # the specified orders as data
    q["order_listing_mart"] = _mart_sql(["listing_neighbourhood"], row_no=True)
    q["order_property_mart"] = _mart_sql(["property_type", "room_type", "accommodates"], row_no=True)
    q["order_lga_revenue"] = _numbered(_lga_revenue_sql(), "revenue DESC NULLS FIRST, listing_neighbourhood")
    q["order_best_listing_type"] = _numbered(
        _best_type_sql(), "total_staying DESC NULLS FIRST, revenue DESC NULLS FIRST, listing_neighbourhood, "
        "property_type, room_type, accommodates")
    q["order_host_same_vs_diff"] = _numbered(
        _same_diff_sql(), "same_neighbourhood + different_neighbourhood DESC, host_name")
    q["order_revenue_vs_mortgage"] = _numbered(
        _mortgage_sql(), "estimated_revenue DESC NULLS FIRST, median_mortgage_annaully DESC NULLS FIRST, "
        "listing_neighbourhood")
    return q


def oracle_sql() -> dict[str, str]:
    from staylens.plans.layers import layer_oracle_sql
    q = _sql()
    q.update(layer_oracle_sql(_with))
    return q
