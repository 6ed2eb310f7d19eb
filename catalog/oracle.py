"""The SQL each query is checked against, from the sample tables alone.

Staging is one common table expression per dataset; views join on natural names, without
surrogate keys. Numbers are summed as decimals, so that sums do not depend on the order of rows.
"""

from __future__ import annotations

import re

from gridmart.fixed_values import CLIMATE_STATES

_KEY = "CAST(strftime({}, '%Y%m01') AS BIGINT)"
_DAY = "strftime({}, '%Y-%m-%d')"

_STATE = "CASE WHEN {0} = 24 THEN 'DC' ELSE lpad(CAST({0} AS VARCHAR), 2, '0') END"

_STATES = ", ".join(f"('{code}', '{abbr}', '{name}')" for code, abbr, name in CLIMATE_STATES)

# Each expression may use the ones before it.
CTES: dict[str, str] = {
    "retail_leaf": f"""
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
               {_STATE.format('c_nationkey')} AS state_code,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Transportation'
                                 WHEN 'BUILDING' THEN 'Commercial'
                                 WHEN 'FURNITURE' THEN 'Commercial'
                                 WHEN 'HOUSEHOLD' THEN 'Residential'
                                 WHEN 'MACHINERY' THEN 'Industrial'
                                 ELSE c_mktsegment END AS sector,
               CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS revenue,
               CAST(l_quantity AS DECIMAL(18,2)) AS quantity,
               c_custkey
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey""",
    "retail_sums": """
        SELECT period, state_code,
               CASE WHEN GROUPING(sector) = 1 THEN 'Total' ELSE sector END AS sector,
               CAST(sum(revenue) AS DOUBLE) / 1000 AS revenue_thousand_dollars,
               CAST(sum(quantity) AS DOUBLE) AS sales_mwh,
               CAST(count(DISTINCT c_custkey) AS DOUBLE) AS customer_count
        FROM retail_leaf
        GROUP BY GROUPING SETS ((period, state_code, sector), (period, state_code))""",
    "stg_retail": """
        SELECT period, year(period) AS year, month(period) AS month, state_code, sector,
               revenue_thousand_dollars, sales_mwh, customer_count,
               CASE WHEN sales_mwh <> 0 THEN revenue_thousand_dollars * 100 / sales_mwh END
                   AS avg_price_cents_per_kwh,
               CASE WHEN year(period) < 2001 THEN 'Final' ELSE 'Preliminary' END AS data_status
        FROM retail_sums""",
    "generation_leaf": f"""
        SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period,
               {_STATE.format('s_nationkey')} AS state_code,
               l_returnflag AS producer_type,
               CASE p_type WHEN 'ECONOMY' THEN 'Wind' WHEN 'LARGE' THEN 'Coal'
                           WHEN 'MEDIUM' THEN 'Natural Gas' WHEN 'SMALL' THEN 'Nuclear'
                           WHEN 'PROMO' THEN 'Pumped Storage' WHEN 'STANDARD' THEN 'Standard Blend'
                           ELSE p_type END AS energy_source,
               CASE WHEN p_type = 'PROMO' THEN -1 ELSE 1 END * CAST(l_quantity AS DECIMAL(18,2)) AS quantity
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey""",
    "stg_generation": """
        SELECT period, year(period) AS year, month(period) AS month, state_code,
               CASE WHEN GROUPING(producer_type) = 1 THEN 'Total Electric Power Industry'
                    ELSE producer_type END AS producer_type,
               CASE WHEN GROUPING(energy_source) = 1 THEN 'Total' ELSE energy_source END AS energy_source,
               CAST(sum(quantity) AS DOUBLE) AS generation_mwh,
               CASE WHEN year(period) < 2001 THEN 'Final' ELSE 'Preliminary' END AS data_status
        FROM generation_leaf
        GROUP BY GROUPING SETS ((period, state_code, producer_type, energy_source),
                                (period, state_code, producer_type),
                                (period, state_code, energy_source),
                                (period, state_code))""",
    "climate_leaf": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, n_nationkey, n_name,
               o_totalprice
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        WHERE c_nationkey <> 24""",
    "stg_climate": f"""
        SELECT period, year(period) AS year, month(period) AS month,
               lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS noaa_state_code,
               {_STATE.format('n_nationkey')} AS state_code, n_name AS state_name,
               CASE WHEN month(period) <> 2
                    THEN CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 10000
               END AS avg_temperature,
               count(*) * 10.0::DOUBLE AS cooling_degree_days,
               max(o_totalprice) AS heating_degree_days,
               min(o_totalprice) AS precipitation
        FROM climate_leaf GROUP BY period, n_nationkey, n_name""",
    "lookup": f"""
        SELECT * FROM (VALUES {_STATES}) AS t(code, abbr, name)""",
    "d_date": """
        SELECT year(period) * 10000 + month(period) * 100 + 1 AS date_key, period AS full_date,
               year(period) AS year, month(period) AS month, monthname(period) AS month_name
        FROM (SELECT period FROM stg_climate UNION SELECT period FROM stg_retail
              UNION SELECT period FROM stg_generation)""",
    "d_state": """
        SELECT row_number() OVER (ORDER BY s.state_code) AS state_key, s.state_code,
               CASE WHEN s.state_code = 'DC' THEN 'District of Columbia' ELSE n.state_name END AS state_name
        FROM (SELECT state_code FROM stg_climate UNION SELECT state_code FROM stg_retail
              UNION SELECT state_code FROM stg_generation) s
        LEFT JOIN (SELECT state_code, max(state_name) AS state_name FROM stg_climate GROUP BY 1) n
               ON n.state_code = s.state_code""",
    "d_sector": """
        SELECT row_number() OVER (ORDER BY sector) AS sector_key, sector AS sector_name
        FROM (SELECT DISTINCT sector FROM stg_retail)""",
    "d_source": """
        SELECT row_number() OVER (ORDER BY energy_source) AS energy_source_key,
               energy_source AS energy_source_name
        FROM (SELECT DISTINCT energy_source FROM stg_generation)""",
    "d_producer": """
        SELECT row_number() OVER (ORDER BY producer_type) AS producer_type_key,
               producer_type AS producer_type_name
        FROM (SELECT DISTINCT producer_type FROM stg_generation)""",
    "f_retail": """
        SELECT date_key, state_key, sector_key, revenue_thousand_dollars, sales_mwh, customer_count,
               avg_price_cents_per_kwh, data_status
        FROM stg_retail r JOIN d_date d ON d.full_date = r.period
        JOIN d_state s ON s.state_code = r.state_code JOIN d_sector c ON c.sector_name = r.sector""",
    "f_generation": """
        SELECT date_key, state_key, producer_type_key, energy_source_key, generation_mwh, data_status
        FROM stg_generation g JOIN d_date d ON d.full_date = g.period
        JOIN d_state s ON s.state_code = g.state_code
        JOIN d_producer p ON p.producer_type_name = g.producer_type
        JOIN d_source e ON e.energy_source_name = g.energy_source""",
    "f_climate": """
        SELECT date_key, state_key, avg_temperature, cooling_degree_days, heating_degree_days,
               precipitation
        FROM stg_climate c JOIN d_date d ON d.full_date = c.period
        JOIN d_state s ON s.state_code = c.state_code""",
    "retail_named": """
        SELECT period AS full_date, year, month, r.state_code, s.state_name, sector AS sector_name,
               revenue_thousand_dollars, sales_mwh, customer_count, avg_price_cents_per_kwh, data_status
        FROM stg_retail r JOIN d_state s ON s.state_code = r.state_code""",
    "retail_detail": "SELECT * FROM retail_named WHERE sector_name <> 'Total'",
    "retail_total": "SELECT * EXCLUDE (sector_name) FROM retail_named WHERE sector_name = 'Total'",
    "generation_named": """
        SELECT period AS full_date, year, month, g.state_code, s.state_name,
               producer_type AS producer_type_name, energy_source AS energy_source_name,
               generation_mwh, data_status
        FROM stg_generation g JOIN d_state s ON s.state_code = g.state_code""",
    "generation_detail": """
        SELECT * FROM generation_named
        WHERE producer_type_name <> 'Total Electric Power Industry' AND energy_source_name <> 'Total'""",
    "generation_total": """
        SELECT * EXCLUDE (producer_type_name, energy_source_name) FROM generation_named
        WHERE producer_type_name = 'Total Electric Power Industry' AND energy_source_name = 'Total'""",
    "climate_monthly": """
        SELECT period AS full_date, year, month, c.state_code, s.state_name, avg_temperature,
               cooling_degree_days, heating_degree_days, precipitation
        FROM stg_climate c JOIN d_state s ON s.state_code = c.state_code""",
    "demand_weather": """
        SELECT r.full_date, r.year, r.month, r.state_code, r.state_name, sales_mwh,
               revenue_thousand_dollars, customer_count, avg_price_cents_per_kwh, avg_temperature,
               cooling_degree_days, heating_degree_days, precipitation
        FROM retail_total r
        LEFT JOIN climate_monthly c ON c.full_date = r.full_date AND c.state_code = r.state_code""",
    "retail_generation": """
        SELECT r.full_date, r.year, r.month, r.state_code, r.state_name,
               sales_mwh AS retail_sales_mwh, generation_mwh,
               generation_mwh - sales_mwh AS generation_minus_retail_mwh
        FROM retail_total r
        LEFT JOIN generation_total g ON g.full_date = r.full_date AND g.state_code = r.state_code""",
    "classification": """
        SELECT energy_source_key, energy_source_name,
               CASE WHEN energy_source_name IN ('Geothermal', 'Hydroelectric Conventional',
                         'Other Biomass', 'Solar Thermal and Photovoltaic', 'Wind',
                         'Wood and Wood Derived Fuels') THEN 'Renewable'
                    WHEN energy_source_name IN ('Coal', 'Natural Gas', 'Other Gases', 'Petroleum')
                         THEN 'Fossil'
                    WHEN energy_source_name = 'Nuclear' THEN 'Nuclear'
                    WHEN energy_source_name = 'Pumped Storage' THEN 'Storage'
                    ELSE 'Other' END AS energy_category
        FROM d_source WHERE energy_source_name <> 'Total'""",
    "generation_mix": """
        SELECT full_date, year, month, state_code, state_name, g.energy_source_name,
               energy_category, generation_mwh
        FROM generation_named g JOIN classification c ON c.energy_source_name = g.energy_source_name
        WHERE producer_type_name = 'Total Electric Power Industry'""",
    "generation_category": """
        SELECT full_date, year, month, state_code, state_name, energy_category,
               sum(generation_mwh) AS generation_mwh
        FROM generation_mix GROUP BY ALL""",
    "generation_share": """
        SELECT *, sum(generation_mwh) OVER w AS classified_generation_mwh,
               CASE WHEN sum(generation_mwh) OVER w <> 0
                    THEN 100.0 * generation_mwh / sum(generation_mwh) OVER w END AS generation_share_pct
        FROM generation_category WINDOW w AS (PARTITION BY full_date, state_code)""",
    "retail_kpi": """
        SELECT full_date, year, month, state_code, state_name, sales_mwh, revenue_thousand_dollars,
               customer_count, avg_price_cents_per_kwh, sales_mwh_previous_year,
               avg_price_previous_year,
               CASE WHEN sales_mwh_previous_year <> 0
                    THEN 100.0 * (sales_mwh - sales_mwh_previous_year) / sales_mwh_previous_year
               END AS sales_yoy_pct,
               CASE WHEN avg_price_previous_year <> 0
                    THEN 100.0 * (avg_price_cents_per_kwh - avg_price_previous_year)
                         / avg_price_previous_year
               END AS price_yoy_pct
        FROM (SELECT *, lag(sales_mwh, 12) OVER w AS sales_mwh_previous_year,
                     lag(avg_price_cents_per_kwh, 12) OVER w AS avg_price_previous_year
              FROM retail_total WINDOW w AS (PARTITION BY state_code ORDER BY full_date))""",
    "sector_kpi": """
        SELECT full_date, year, month, state_code, state_name, sector_name, sales_mwh,
               revenue_thousand_dollars, customer_count, avg_price_cents_per_kwh
        FROM retail_detail""",
}


def with_ctes(query: str) -> str:
    """``query`` behind the expressions it needs."""
    needed: set[str] = set()
    for name in reversed(CTES):
        text = " ".join([query, *(CTES[n] for n in needed)])
        if re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
            needed.add(name)
    if not needed:
        return query
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in CTES if name in needed)
    return f"WITH {parts}\n{query}"


def _day(column: str) -> str:
    return f"{_DAY.format(column)} AS {column.split('.')[-1]}"


def _view(name: str, date: str = "full_date") -> str:
    return f"SELECT * REPLACE ({_day(date)}) FROM {name}"


_PERIOD = "full_date <= DATE '2000-12-31'"
_PRICE = (
    "round(CASE WHEN sum(sales_mwh) <> 0"
    " THEN sum(revenue_thousand_dollars) * 100 / sum(sales_mwh) END, 6)"
)
_REVENUE = "round(sum(revenue_thousand_dollars) * 1000, 4)"


def _of(category: str) -> str:
    return f"sum(CASE WHEN energy_category = '{category}' THEN generation_mwh END)"


def _share(category: str) -> str:
    return f"CASE WHEN sum(generation_mwh) <> 0 THEN {_of(category)} / sum(generation_mwh) END"


_SHARES = ", ".join(
    f"{_share(c)} AS {c.lower()}_share" for c in ("Fossil", "Nuclear", "Renewable")
)

# The newest month of each group, then its customers.
_LATEST = """
    SELECT {by} max_by(customers, full_date) AS customers_latest_month
    FROM (SELECT {by} full_date, sum(customer_count) AS customers FROM retail_kpi
          WHERE {where} GROUP BY ALL) {group}"""


def _cards(*rows: tuple[str, str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{card}' AS card, {value} AS value FROM {source}" for card, value, source in rows
    )


_STG = {"climate": "stg_climate", "retail": "stg_retail", "generation": "stg_generation"}
_GRAIN = {
    "climate": "state_code, year, month",
    "retail": "state_code, year, month, sector",
    "generation": "state_code, year, month, producer_type, energy_source",
}
_FACT_GRAIN = {
    "climate": "date_key, state_key",
    "retail": "date_key, state_key, sector_key",
    "generation": "date_key, state_key, producer_type_key, energy_source_key",
}
_CODES = {"climate": 0, "retail": 1, "generation": 2}


def _gate(dataset: str, source: str) -> str:
    required = {
        "climate": "period IS NULL OR state_code IS NULL",
        "retail": "period IS NULL OR state_code IS NULL OR sector IS NULL",
        "generation": "period IS NULL OR state_code IS NULL OR producer_type IS NULL"
        " OR energy_source IS NULL",
    }[dataset]
    invalid = (
        "year IS NULL OR month IS NULL OR year <> year(period) OR month <> month(period)"
        " OR month < 1 OR month > 12"
    )
    first = 50001 + _CODES[dataset]
    return f"""
        SELECT {first}::BIGINT AS code, '{dataset}' AS dataset, 'empty' AS rule,
               CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS violations FROM {source}
        UNION ALL SELECT {first + 3}, '{dataset}', 'null_required',
               count(*) FILTER (WHERE {required}) FROM {source}
        UNION ALL SELECT {first + 6}, '{dataset}', 'invalid_period',
               count(*) FILTER (WHERE {invalid}) FROM {source}
        UNION ALL SELECT {first + 9}, '{dataset}', 'duplicate_grain', count(*)
        FROM (SELECT {_GRAIN[dataset]} FROM {source} GROUP BY ALL HAVING count(*) > 1)"""


# The faults the broken staging carries, see ``catalog.queries``.
_BROKEN = {
    "climate": """(SELECT CASE WHEN month = 3 THEN NULL ELSE period END AS period,
        CASE WHEN year = 1997 THEN NULL ELSE year END AS year, month,
        CASE WHEN month = 5 THEN NULL ELSE state_code END AS state_code FROM stg_climate)""",
    "retail": """(SELECT period, year, CASE WHEN year = 1998 THEN month + 12 ELSE month END AS month,
        state_code, CASE WHEN sector = 'Industrial' THEN NULL ELSE sector END AS sector FROM stg_retail
        UNION ALL SELECT period, year, month, state_code, sector FROM stg_retail WHERE year = 1996)""",
    "generation": """(SELECT period, CASE WHEN month = 7 THEN year + 1 ELSE year END AS year, month,
        state_code, producer_type,
        CASE WHEN energy_source = 'Coal' THEN NULL ELSE energy_source END AS energy_source
        FROM stg_generation)""",
}

_METRICS = ("avg_temperature", "cooling_degree_days", "heating_degree_days", "precipitation")

_PARSED_CLIMATE = f"""
    SELECT {_day('period')}, year, month, code AS noaa_state_code, abbr AS state_code,
           name AS state_name, {', '.join(_METRICS)}
    FROM stg_climate JOIN lookup
      ON code = lpad(CAST(CAST(noaa_state_code AS INTEGER) + 1 AS VARCHAR), 3, '0')"""

_SHEET_MONTHS = """(SELECT DISTINCT period, year, month, state_code, data_status FROM stg_retail)"""

_UNPIVOTED = f"""
    SELECT {_day('m.period')}, m.year, m.month, m.state_code, s.sector,
           revenue_thousand_dollars, sales_mwh, customer_count, avg_price_cents_per_kwh,
           m.data_status
    FROM {_SHEET_MONTHS} m
    JOIN (VALUES ('Residential'), ('Commercial'), ('Industrial'), ('Transportation'), ('Total'))
         AS s(sector) ON true
    LEFT JOIN stg_retail r ON r.period = m.period AND r.state_code = m.state_code AND r.sector = s.sector"""

_LINE_PROBLEM = """CASE WHEN year = 1995 THEN 'record shorter than 10 characters'
         WHEN year = 1996 THEN 'invalid year'
         WHEN year = 1997 THEN 'unexpected element'
         WHEN nation * 3 NOT BETWEEN 1 AND 50 THEN NULL
         WHEN year = 1998 THEN 'not 12 monthly values'
         WHEN year = 1999 THEN 'invalid numeric value' END"""


def _alerts(closed_only: bool) -> str:
    bound = (
        "AND window_start + INTERVAL 15 MINUTE <= "
        "(SELECT date_trunc('millisecond', max(ts)) FROM events WHERE event_type = 'error')"
        " - INTERVAL 15 MINUTE"
        if closed_only
        else ""
    )
    return f"""
        SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
               strftime(window_start + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
               event_type AS name, count(*) AS failures, 2::BIGINT AS severity
        FROM (SELECT event_type,
                     time_bucket(INTERVAL 5 MINUTE, ts) - back * INTERVAL 5 MINUTE AS window_start
              FROM events JOIN (VALUES (0), (1), (2)) AS b(back) ON true
              WHERE event_type = 'error')
        WHERE true {bound}
        GROUP BY window_start, event_type"""


_QUERIES: dict[str, str] = {
    # staging shapes
    "stg_retail": _view("stg_retail", "period"),
    "stg_generation": _view("stg_generation", "period"),
    "stg_climate": _view("stg_climate", "period"),
    # reshapes and parsing
    "climate_merge": _view("stg_climate", "period"),
    "climate_full_outer": """
        SELECT state_code, year, month, t.avg_temperature, c.cooling_degree_days,
               h.heating_degree_days, p.precipitation
        FROM (SELECT state_code, year, month, avg_temperature FROM stg_climate) t
        FULL JOIN (SELECT state_code, year + 1 AS year, month, cooling_degree_days FROM stg_climate) c
            USING (state_code, year, month)
        FULL JOIN (SELECT state_code, year + 2 AS year, month, heating_degree_days FROM stg_climate) h
            USING (state_code, year, month)
        FULL JOIN (SELECT state_code, year + 3 AS year, month, precipitation FROM stg_climate) p
            USING (state_code, year, month)""",
    "retail_unpivot": _UNPIVOTED,
    "min_year_filter": f"{_UNPIVOTED} WHERE m.year >= 1998",
    "fixed_width_parse": _PARSED_CLIMATE,
    "ingest_climate_files": _PARSED_CLIMATE,
    "ingest_retail_files": _UNPIVOTED,
    "ingest_generation_files": _view("stg_generation", "period"),
    "pipeline_run": f"""
        SELECT 'climate' AS dataset, {_KEY.format('period')} AS date_key, count(*) AS fact_rows,
               count(precipitation) AS known_values, round(sum(precipitation), 3) AS total
        FROM stg_climate GROUP BY period
        UNION ALL
        SELECT 'retail', {_KEY.format('period')}, n * 5, coalesce(known, 0), total
        FROM (SELECT period, count(*) AS n FROM {_SHEET_MONTHS} GROUP BY period) LEFT JOIN
             (SELECT period, count(sales_mwh) AS known, round(sum(sales_mwh), 3) AS total
              FROM stg_retail GROUP BY period) USING (period)
        UNION ALL
        SELECT 'generation', {_KEY.format('period')}, count(*), count(generation_mwh),
               round(sum(generation_mwh), 3)
        FROM stg_generation GROUP BY period""",
    "latest_file_pick": """
        SELECT 'avg_temperature' AS metric, code AS noaa_state_code, y.year, m.month,
               avg_temperature AS value
        FROM (SELECT DISTINCT noaa_state_code, year FROM stg_climate) y
        JOIN (SELECT unnest(range(1, 13)) AS month) m ON true
        JOIN lookup ON code = lpad(CAST(CAST(y.noaa_state_code AS INTEGER) + 1 AS VARCHAR), 3, '0')
        LEFT JOIN stg_climate c
          ON c.noaa_state_code = y.noaa_state_code AND c.year = y.year AND c.month = m.month""",
    "ingest_line_violations": f"""
        SELECT metric, problem, count(*) AS lines
        FROM (SELECT metric, {_LINE_PROBLEM} AS problem
              FROM (SELECT DISTINCT CAST(noaa_state_code AS INTEGER) AS nation, year FROM stg_climate) l
              JOIN (VALUES {', '.join(f"('{m}')" for m in _METRICS)}) AS t(metric) ON true)
        WHERE problem IS NOT NULL GROUP BY metric, problem""",
    "sheet_header_map": _view("stg_generation", "period"),
    "noaa_state_lookup": f"""
        SELECT {_day('period')}, code AS noaa_state_code, abbr AS state_code, name AS state_name,
               precipitation
        FROM stg_climate JOIN lookup
          ON code = lpad(CAST(CAST(noaa_state_code AS INTEGER) * 3 AS VARCHAR), 3, '0')""",
    "reporting_period_filter": f"SELECT * REPLACE ({_day('full_date')}) FROM retail_kpi WHERE {_PERIOD}",
    # curated months
    "curated_roundtrip": _view("stg_retail", "period"),
    "curated_overwrite_month": f"""
        SELECT * REPLACE ({_day('period')},
               CASE WHEN year = 2000 AND month = 3 THEN sales_mwh * 2 ELSE sales_mwh END AS sales_mwh)
        FROM stg_retail""",
    "job_result": "\nUNION ALL\n".join(
        f"""SELECT '{dataset}' AS dataset, 'success' AS status, count(*) AS rows_written,
            strftime(max(period), '%Y-%m') AS max_period,
            count(DISTINCT period) AS partitions_written FROM {source}"""
        for dataset, source in _STG.items()
    ),
    "month_sequence": """
        SELECT strftime(period, '%Y-%m-%d') AS period,
               'curated/eia/retail/year=' || strftime(period, '%Y') || '/month=' || strftime(period, '%m')
                   AS folder
        FROM (SELECT CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS DATE)
                     AS period FROM stg_retail)""",
    # dimensions and facts
    "dim_date": _view("d_date"),
    "dim_state": "SELECT * FROM d_state",
    "dim_sector": "SELECT * FROM d_sector",
    "dim_energy_source": "SELECT * FROM d_source",
    "dim_producer_type": "SELECT * FROM d_producer",
    "fact_retail": "SELECT * FROM f_retail",
    "fact_generation": "SELECT * FROM f_generation",
    "fact_climate": "SELECT * FROM f_climate",
    # incremental loads
    "staging_watermarks": "\nUNION ALL\n".join(
        f"SELECT '{dataset}' AS dataset, {_DAY.format('max(period)')} AS watermark FROM {source}"
        for dataset, source in _STG.items()
    ),
    "fact_watermarks": "\nUNION ALL\n".join(
        f"SELECT '{dataset}' AS dataset, max(date_key) AS watermark FROM f_{dataset}"
        for dataset in _STG
    ),
    "staging_reload": f"""
        SELECT * REPLACE ({_day('period')},
               CASE WHEN period = DATE '2000-06-01' THEN sales_mwh * 2 ELSE sales_mwh END AS sales_mwh)
        FROM stg_retail""",
    "staging_reload_misfiled": f"""
        SELECT * REPLACE (CASE WHEN period = (SELECT max(period) FROM stg_retail) AND sector = 'Commercial'
                               THEN '2000-06-01' ELSE {_DAY.format('period')} END AS period)
        FROM stg_retail""",
    "staging_reload_failed": f"""
        SELECT * REPLACE ({_day('period')}) FROM stg_retail WHERE period <= DATE '2000-12-01'""",
    "rejected_ingests": """
        SELECT dataset, rule, 'refused' AS outcome, row_count
        FROM (VALUES ('climate', 'repeated grain'), ('climate', 'unknown metric'),
                     ('climate', 'metric left out'), ('climate', 'no rows'),
                     ('retail', 'repeated grain'), ('retail', 'month 13'), ('retail', 'no sheet'),
                     ('retail', 'too few columns'), ('retail', 'no rows'),
                     ('retail', 'no month column'), ('generation', 'repeated grain'),
                     ('generation', 'month 13'), ('generation', 'no rows')) AS cases(dataset, rule)
        JOIN (SELECT 'climate' AS dataset, count(*) AS row_count FROM stg_climate
              UNION ALL SELECT 'retail', count(*) FROM stg_retail
              UNION ALL SELECT 'generation', count(*) FROM stg_generation) USING (dataset)""",
    "view_in_other_session": _view("retail_total"),
    "fact_incremental_delta": f"""
        SELECT {_day('period')}, state_code, sector, sales_mwh FROM stg_retail
        WHERE period > DATE '2000-12-01' OR (period = DATE '2000-12-01' AND sector = 'Total')""",
    "fact_after_increment": f"""
        SELECT {_day('period')}, state_code, sector,
               CASE WHEN period = DATE '2000-12-01' AND sector <> 'Total' THEN sales_mwh * 2
                    ELSE sales_mwh END AS sales_mwh
        FROM stg_retail WHERE NOT (period = DATE '2000-06-01' AND sector = 'Commercial')""",
    "dim_state_increment": """
        SELECT * FROM (
        WITH codes AS (SELECT DISTINCT state_code FROM stg_retail),
             early AS (SELECT state_code, row_number() OVER (ORDER BY state_code) AS state_key
                       FROM codes WHERE state_code >= '12')
        SELECT state_key, state_code FROM early
        UNION ALL
        SELECT (SELECT count(*) FROM early) + row_number() OVER (ORDER BY state_code), state_code
        FROM codes WHERE state_code < '12')""",
    "fact_rerun_delta": "\nUNION ALL\n".join(
        f"SELECT '{dataset}' AS dataset, count(*) AS fact_rows, 0::BIGINT AS rows_to_add FROM f_{dataset}"
        for dataset in _STG
    ),
    # quality gate and validation
    "dq_report": "\nUNION ALL\n".join(_gate(dataset, source) for dataset, source in _STG.items()),
    "dq_report_empty": "\nUNION ALL\n".join(
        _gate(dataset, "(SELECT * FROM stg_retail WHERE false)" if dataset == "retail" else source)
        for dataset, source in _STG.items()
    ),
    "dq_report_broken": "\nUNION ALL\n".join(
        _gate(dataset, source) for dataset, source in _BROKEN.items()
    ),
    "dq_pass": """
        SELECT 'PASS' AS dq_status, 'All staging data quality checks passed.' AS message
        WHERE (SELECT count(*) FROM stg_climate) > 0 AND (SELECT count(*) FROM stg_retail) > 0
          AND (SELECT count(*) FROM stg_generation) > 0""",
    "unexpected_members": """
        SELECT 'sector' AS member_of, sector AS member FROM (SELECT DISTINCT sector FROM stg_retail)
        WHERE sector NOT IN ('Residential', 'Commercial', 'Industrial', 'Total')
        UNION ALL
        SELECT 'state_code', state_code FROM (SELECT DISTINCT state_code FROM stg_retail)
        WHERE state_code NOT IN (SELECT state_code FROM stg_climate)""",
    "val_row_counts": "\nUNION ALL\n".join(
        f"SELECT '{dataset}' AS dataset, count(*) AS row_count FROM {source}"
        for dataset, source in _STG.items()
    ),
    "val_period_ranges": "\nUNION ALL\n".join(
        f"SELECT '{dataset}' AS dataset, {_DAY.format('min(period)')} AS min_period,"
        f" {_DAY.format('max(period)')} AS max_period FROM {source}"
        for dataset, source in _STG.items()
    ),
    **{
        f"val_dup_stg_{dataset}": f"""
        SELECT {_GRAIN[dataset]}, count(*) AS duplicate_count
        FROM (SELECT * FROM {source} UNION ALL SELECT * FROM {source} WHERE month = 3)
        GROUP BY {_GRAIN[dataset]} HAVING count(*) > 1"""
        for dataset, source in _STG.items()
    },
    **{
        f"val_dup_fact_{dataset}": f"""
        SELECT {_FACT_GRAIN[dataset]}, count(*) AS cnt
        FROM (SELECT * FROM f_{dataset} UNION ALL
              SELECT * FROM f_{dataset} WHERE date_key // 100 % 100 = 3)
        GROUP BY {_FACT_GRAIN[dataset]} HAVING count(*) > 1"""
        for dataset in _STG
    },
    # views
    "vw_RetailDetail": _view("retail_detail"),
    "vw_RetailTotal": _view("retail_total"),
    "vw_GenerationDetail": _view("generation_detail"),
    "vw_GenerationTotal": _view("generation_total"),
    "vw_ClimateMonthly": _view("climate_monthly"),
    "vw_DemandWeather": _view("demand_weather"),
    "vw_RetailGeneration": _view("retail_generation"),
    "vw_EnergySourceClassification": "SELECT * FROM classification",
    "vw_GenerationMix": _view("generation_mix"),
    "vw_GenerationCategoryMonthly": _view("generation_category"),
    "vw_GenerationShare": _view("generation_share"),
    "vw_RetailKPI": _view("retail_kpi"),
    "vw_SectorKPI": _view("sector_kpi"),
    "vw_WeatherDemandKPI": _view("demand_weather"),
    "vw_RetailGenerationKPI": _view("retail_generation"),
    "dim_filtered_view": f"""
        SELECT * REPLACE ({_day('full_date')}) FROM retail_kpi
        WHERE state_name IN ('NATION_3', 'NATION_7', 'District of Columbia') AND year = 1999""",
    # measures
    "mea_retail_by_state": f"""
        SELECT state_code, total_retail_sales, total_revenue, average_electricity_price,
               customers_latest_month, retail_sales_previous_year, retail_sales_yoy
        FROM (SELECT state_code, sum(sales_mwh) AS total_retail_sales, {_REVENUE} AS total_revenue,
                     {_PRICE} AS average_electricity_price,
                     sum(sales_mwh_previous_year) AS retail_sales_previous_year,
                     CASE WHEN sum(sales_mwh_previous_year) <> 0
                          THEN (sum(sales_mwh) - sum(sales_mwh_previous_year))
                               / sum(sales_mwh_previous_year) END AS retail_sales_yoy
              FROM retail_kpi GROUP BY state_code)
        JOIN ({_LATEST.format(by='state_code,', where='true', group='GROUP BY state_code')}) l
             USING (state_code)""",
    "mea_customers_latest": _LATEST.format(
        by="state_code, year,", where="true", group="GROUP BY state_code, year"
    ),
    "mea_yoy": """
        SELECT year, sum(sales_mwh) AS total_retail_sales,
               sum(sales_mwh_previous_year) AS retail_sales_previous_year,
               CASE WHEN sum(sales_mwh_previous_year) <> 0
                    THEN (sum(sales_mwh) - sum(sales_mwh_previous_year))
                         / sum(sales_mwh_previous_year) END AS retail_sales_yoy
        FROM retail_kpi GROUP BY year""",
    "mea_generation_by_state": f"""
        SELECT state_code, sum(generation_mwh) AS total_generation,
               {_of('Renewable')} AS renewable_generation, {_of('Fossil')} AS fossil_generation,
               {_of('Nuclear')} AS nuclear_generation, {_SHARES}
        FROM generation_mix GROUP BY state_code""",
    "mea_surplus_by_state": """
        SELECT state_code, sum(generation_minus_retail_mwh) AS generation_surplus
        FROM retail_generation GROUP BY state_code""",
    "mea_sector": f"""
        SELECT state_code, sector_name, {_REVENUE} AS sector_revenue, {_PRICE} AS sector_average_price
        FROM sector_kpi GROUP BY state_code, sector_name""",
    # reports
    "rep_executive_cards": _cards(
        ("total_retail_sales", "sum(sales_mwh)", f"retail_kpi WHERE {_PERIOD}"),
        ("total_revenue", _REVENUE, f"retail_kpi WHERE {_PERIOD}"),
        (
            "average_electricity_price",
            _PRICE,
            f"retail_kpi WHERE {_PERIOD}",
        ),
        (
            "customers_latest_month",
            "customers_latest_month",
            f"({_LATEST.format(by='', where=_PERIOD, group='')})",
        ),
    ),
    "rep_price_trend": f"""
        SELECT {_day('full_date')}, {_PRICE} AS average_electricity_price
        FROM retail_kpi WHERE {_PERIOD} GROUP BY retail_kpi.full_date""",
    "rep_sales_and_generation_trend": f"""
        SELECT {_day('full_date')}, sum(retail_sales_mwh) AS retail_sales,
               sum(generation_mwh) AS generation
        FROM retail_generation WHERE {_PERIOD} GROUP BY retail_generation.full_date""",
    "rep_category_trend": f"""
        SELECT {_day('full_date')}, energy_category, sum(generation_mwh) AS total_generation
        FROM generation_mix WHERE {_PERIOD} GROUP BY generation_mix.full_date, energy_category""",
    "rep_state_cards": _cards(
        ("total_retail_sales", "sum(sales_mwh)", f"retail_kpi WHERE {_PERIOD}"),
        ("average_electricity_price", _PRICE, f"retail_kpi WHERE {_PERIOD}"),
        ("total_generation", "sum(generation_mwh)", f"generation_mix WHERE {_PERIOD}"),
        (
            "generation_surplus",
            "sum(generation_minus_retail_mwh)",
            f"retail_generation WHERE {_PERIOD}",
        ),
    ),
    "rep_state_comparison": f"""
        SELECT state_code, total_retail_sales, average_electricity_price, generation_surplus
        FROM (SELECT state_code, sum(sales_mwh) AS total_retail_sales,
                     {_PRICE} AS average_electricity_price
              FROM retail_kpi WHERE {_PERIOD} GROUP BY state_code)
        FULL JOIN (SELECT state_code, sum(generation_minus_retail_mwh) AS generation_surplus
                   FROM retail_generation WHERE {_PERIOD} GROUP BY state_code) USING (state_code)""",
    "rep_sector_comparison": f"""
        SELECT sector_name, {_REVENUE} AS sector_revenue, sum(sales_mwh) AS sector_sales,
               {_PRICE} AS sector_average_price
        FROM sector_kpi WHERE {_PERIOD} GROUP BY sector_name""",
    "rep_sector_trend": f"""
        SELECT {_day('full_date')}, sector_name, sum(sales_mwh) AS sector_sales
        FROM sector_kpi WHERE {_PERIOD} GROUP BY sector_kpi.full_date, sector_name""",
    "rep_mix_cards": _cards(
        ("total_generation", "sum(generation_mwh)", f"generation_mix WHERE {_PERIOD}"),
        *[
            (f"{c.lower()}_share", _share(c), f"generation_mix WHERE {_PERIOD}")
            for c in ("Fossil", "Nuclear", "Renewable")
        ],
    ),
    "rep_generation_by_source": f"""
        SELECT energy_category, energy_source_name, sum(generation_mwh) AS total_generation
        FROM generation_mix WHERE {_PERIOD} GROUP BY ALL""",
    "rep_generation_by_category": f"""
        SELECT energy_category, sum(generation_mwh) AS total_generation
        FROM generation_mix WHERE {_PERIOD} GROUP BY ALL""",
    "rep_share_trend": f"""
        SELECT {_day('full_date')}, {_SHARES}
        FROM generation_mix WHERE {_PERIOD} GROUP BY generation_mix.full_date""",
    "rep_weather_cards": _cards(
        ("average_temperature", "round(avg(avg_temperature), 6)", f"demand_weather WHERE {_PERIOD}"),
        ("total_retail_sales", "sum(sales_mwh)", f"demand_weather WHERE {_PERIOD}"),
        ("average_monthly_cdd", "round(avg(cooling_degree_days), 6)", f"demand_weather WHERE {_PERIOD}"),
        ("average_monthly_hdd", "round(avg(heating_degree_days), 6)", f"demand_weather WHERE {_PERIOD}"),
    ),
    "rep_weather_scatter": f"""
        SELECT state_code, {_day('full_date')}, avg_temperature, cooling_degree_days,
               heating_degree_days, sales_mwh
        FROM demand_weather WHERE {_PERIOD}""",
    "rep_weather_by_quarter": f"""
        SELECT year, quarter(full_date) AS quarter, round(avg(avg_temperature), 6) AS average_temperature,
               round(avg(cooling_degree_days), 6) AS average_monthly_cdd,
               round(avg(heating_degree_days), 6) AS average_monthly_hdd,
               sum(sales_mwh) AS total_retail_sales
        FROM demand_weather WHERE {_PERIOD} GROUP BY year, quarter(full_date)""",
    # alerts
    "alert_windows_batch": _alerts(closed_only=False),
    "alert_windows_stream": _alerts(closed_only=True),
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(query) for name, query in _QUERIES.items()}
