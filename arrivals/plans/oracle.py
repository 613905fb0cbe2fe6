"""DuckDB SQL for every registered check, over the driver's tables.

The relations below are the fixture mappings of
:mod:`arrivals.sources.fixtures` and the jobs of
:mod:`arrivals.operators.transforms`, written independently in plain SQL.
Integer-valued doubles are cast with DuckDB's rounding casts only where the
value is whole; the SAS date is taken from the order date itself.
"""

from __future__ import annotations

RAW_ARR = """
SELECT CAST(o_orderkey AS DOUBLE) AS cicid,
       CAST(c_nationkey AS DOUBLE) AS i94cit,
       CAST(c_nationkey AS DOUBLE) AS i94res,
       CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) + 0.5 AS arrdate,
       CAST(1 + o_orderkey % 3 AS DOUBLE) AS i94mode,
       upper(substr(c_mktsegment, 1, 2)) AS i94addr,
       CAST(20 + o_custkey % 60 AS DOUBLE) AS i94bir,
       CAST(1 + o_custkey % 3 AS DOUBLE) AS i94visa,
       CAST(year(o_orderdate) - (20 + o_custkey % 60) AS DOUBLE) AS biryear,
       o_orderstatus AS gender,
       substr(o_orderpriority, 1, 1) AS visatype
FROM orders JOIN customer ON o_custkey = c_custkey"""

FACT = """
SELECT DISTINCT o_orderkey AS cic_id,
       c_nationkey AS born_country,
       c_nationkey AS res_country,
       CAST(1 + o_orderkey % 3 AS INTEGER) AS i94_mode,
       upper(substr(c_mktsegment, 1, 2)) AS arr_state,
       CAST(20 + o_custkey % 60 AS INTEGER) AS age,
       CAST(1 + o_custkey % 3 AS INTEGER) AS i94_visa,
       CAST(year(o_orderdate) - (20 + o_custkey % 60) AS INTEGER) AS birth_year,
       o_orderstatus AS gender,
       substr(o_orderpriority, 1, 1) AS visa_type,
       CAST(o_orderdate AS DATE) AS arrival_date
FROM orders JOIN customer ON o_custkey = c_custkey"""

FAULTY_FACT = """
SELECT DISTINCT CASE WHEN o_orderkey % 50 = 3 THEN NULL ELSE o_orderkey END AS cic_id,
       c_nationkey AS born_country,
       c_nationkey AS res_country,
       CAST(1 + o_orderkey % 3 AS INTEGER) AS i94_mode,
       CASE WHEN o_orderkey % 40 = 7 THEN 'LONGX' ELSE upper(substr(c_mktsegment, 1, 2)) END AS arr_state,
       CASE WHEN o_orderkey % 7 = 2 THEN NULL ELSE CAST(20 + o_custkey % 60 AS INTEGER) END AS age,
       CAST(1 + o_custkey % 3 AS INTEGER) AS i94_visa,
       CASE WHEN o_orderkey % 9 = 4 THEN NULL
            ELSE CAST(year(o_orderdate) - (20 + o_custkey % 60) AS INTEGER) END AS birth_year,
       o_orderstatus AS gender,
       CASE WHEN o_orderkey % 45 = 13 THEN 'LONG' ELSE substr(o_orderpriority, 1, 1) END AS visa_type,
       CASE WHEN o_orderkey % 60 = 11 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS arrival_date
FROM orders JOIN customer ON o_custkey = c_custkey"""

FAULTY_TMP_RAW = """
SELECT CAST(o_orderdate AS DATE) AS dt,
       CASE WHEN month(o_orderdate) = 2 AND c_mktsegment LIKE 'A%' THEN NULL ELSE l_quantity END AS "AverageTemperature",
       c_mktsegment AS "State",
       CASE WHEN o_orderstatus = 'P' THEN 'Canada' ELSE 'United States' END AS "Country"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""

FAULTY_CC = """
SELECT CAST(c_custkey AS INTEGER) AS code, concat(' ', c_name) AS country FROM customer
UNION ALL
SELECT CAST(c_custkey AS INTEGER), concat(' ', c_name) FROM customer WHERE c_custkey % 25 = 1"""

DEM_RAW = """
SELECT n_name AS "City",
       c_mktsegment AS "State",
       CAST(n_nationkey AS DOUBLE) + 30.5 AS "Median Age",
       CAST(400 * (n_nationkey + 1) + 20 * length(c_mktsegment) AS BIGINT) AS "Male Population",
       CAST(600 * (n_nationkey + 1) + 30 * length(c_mktsegment) AS BIGINT) AS "Female Population",
       CAST(1000 * (n_nationkey + 1) + 50 * length(c_mktsegment) AS BIGINT) AS "Total Population",
       CAST(10 * (n_nationkey + 1) AS BIGINT) AS "Number of Veterans",
       CAST(30 * (n_nationkey + 1) AS BIGINT) AS "Foreign-born",
       CAST(2.0 + (n_nationkey % 4) * 0.25 AS DOUBLE) AS "Average Household Size",
       upper(substr(c_mktsegment, 1, 2)) AS "State Code",
       concat('R', CAST(c_custkey % 5 AS VARCHAR)) AS "Race",
       c_custkey AS "Count"
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

DEM_RENAMED = """
SELECT "City" AS city, "State Code" AS state_code, "State" AS state,
       "Median Age" AS med_age, "Male Population" AS male_pop,
       "Female Population" AS female_pop, "Total Population" AS tot_pop,
       "Number of Veterans" AS num_veterans, "Foreign-born" AS foreign_born,
       "Average Household Size" AS avg_household, "Race" AS race, "Count" AS "count"
FROM dem_raw"""

DEM_TYPED = """
SELECT city, state_code, state, CAST(med_age AS FLOAT) AS med_age, male_pop, female_pop,
       tot_pop, num_veterans, foreign_born, CAST(avg_household AS FLOAT) AS avg_household,
       race, "count"
FROM dem_renamed"""

TMP_RAW = """
SELECT CAST(o_orderdate AS DATE) AS dt,
       l_quantity AS "AverageTemperature",
       l_discount AS "AverageTemperatureUncertainty",
       c_mktsegment AS "State",
       CASE WHEN o_orderstatus = 'P' THEN 'Canada' ELSE 'United States' END AS "Country"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""

TMP_US = """
SELECT dt, "AverageTemperature" AS avg_temp, "State" AS state,
       CAST(month(dt) AS INTEGER) AS "month", CAST(year(dt) AS INTEGER) AS "year"
FROM tmp_raw WHERE "Country" = 'United States'"""


def staging(years: int) -> str:
    return f"""
SELECT DISTINCT dt, state, CAST(avg_temp AS FLOAT) AS avg_temp, "month", "year",
       state AS partition_state
FROM tmp_us
WHERE "year" <= (SELECT MAX("year") FROM tmp_us)
  AND "year" > (SELECT MAX("year") FROM tmp_us) - {years}"""


def dim_st(years: int) -> str:
    return f"""
SELECT state, "month", CAST(AVG(avg_temp) AS FLOAT) AS avg_temperature
FROM staging
WHERE "year" <= (SELECT MAX("year") FROM staging)
  AND "year" > (SELECT MAX("year") FROM staging) - {years}
GROUP BY state, "month\""""


DATE_DIM = """
SELECT d AS "date",
       CAST(dayofmonth(d) AS INTEGER) AS "day",
       CAST(week(d) AS INTEGER) AS week,
       CAST(month(d) AS VARCHAR) AS "month",
       CAST(year(d) AS INTEGER) AS "year",
       CAST(dayofweek(d) AS VARCHAR) AS weekday
FROM (SELECT DISTINCT arrival_date AS d FROM fact WHERE arrival_date IS NOT NULL) x"""

CC = """
SELECT CAST(c_custkey AS INTEGER) AS code, concat(' ', c_name) AS country FROM customer"""


def with_(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes)
    return f"WITH {body}\n{final}"


DEM_CTES = [("dem_raw", DEM_RAW), ("dem_renamed", DEM_RENAMED), ("dem_typed", DEM_TYPED)]
DEMO = "SELECT DISTINCT * FROM dem_typed"


def tmp_ctes(years: int, raw: str = TMP_RAW) -> list[tuple[str, str]]:
    return [("tmp_raw", raw), ("tmp_us", TMP_US), ("staging", staging(years))]


# Window of the "recent years" checks: the data cover about seven years,
# so three years makes the filter drop rows; the pipeline default is ten.
CHECK_YEARS = 3
PIPELINE_YEARS = 10

CORR_DEM = """
SELECT round(corr(CAST(n AS DOUBLE), CAST(pop AS DOUBLE)), 6) AS r
FROM (SELECT arr_state, COUNT(*) AS n FROM fact GROUP BY arr_state) a
JOIN (SELECT state_code, SUM(tot_pop) AS pop
      FROM (SELECT DISTINCT city, state_code, tot_pop FROM demo) d GROUP BY state_code) p
  ON a.arr_state = p.state_code"""

CORR_TMP = """
SELECT round(corr(CAST(n AS DOUBLE), CAST(avg_temperature AS DOUBLE)), 6) AS r
FROM (SELECT arr_state, CAST(month(arrival_date) AS INTEGER) AS "month", COUNT(*) AS n
      FROM fact GROUP BY 1, 2) a
JOIN (SELECT DISTINCT state_code, state FROM demo) b ON a.arr_state = b.state_code
JOIN dim_st t ON t.state = b.state AND t."month" = a."month\""""

DQ_REPORT = """
SELECT 'fact_null_cic_id' AS check_name, 'fact_immigration' AS table_name,
       CAST(COUNT(*) AS VARCHAR) AS actual, '0' AS expected, COUNT(*) = 0 AS passed
FROM fact WHERE cic_id IS NULL
UNION ALL
SELECT 'state_temperature_null_avg', 'state_temperature', CAST(COUNT(*) AS VARCHAR), '0',
       COUNT(*) = 0
FROM dim_st WHERE avg_temperature IS NULL
UNION ALL
SELECT 'country_code_duplicates', 'country_code', CAST(COUNT(*) AS VARCHAR), '0', COUNT(*) = 0
FROM (SELECT code, country FROM cc GROUP BY code, country HAVING COUNT(code) > 1) d"""


def contract_report_sql(table: str, source: str, keys: bool = True) -> str:
    """Report rows of one table's contract checks, over relation ``source``."""
    from arrivals.contracts import BY_NAME
    c = BY_NAME[table]
    parts = []
    for col in c.columns:
        conds = []
        if col.not_null:
            conds.append((f"{table}.{col.name}_not_null", f'"{col.name}" IS NULL'))
        if col.max_len is not None:
            conds.append((f"{table}.{col.name}_max_length", f'length("{col.name}") > {col.max_len}'))
        for name, cond in conds:
            parts.append(f"SELECT '{name}' AS check_name, '{table}' AS table_name, "
                         f"CAST(COUNT(*) FILTER (WHERE {cond}) AS VARCHAR) AS actual, '0' AS expected, "
                         f"COUNT(*) FILTER (WHERE {cond}) = 0 AS passed FROM {source}")
    if keys:
        key = ", ".join(f'"{k}"' for k in c.key)
        parts.append(f"SELECT '{table}.key_unique', '{table}', CAST(COUNT(*) AS VARCHAR), '0', COUNT(*) = 0 "
                     f"FROM (SELECT {key} FROM {source} GROUP BY {key} HAVING COUNT(*) > 1) d")
    return "\nUNION ALL\n".join(parts)


# The six tables, the relation that fills each, and their columns as Spark types.
TABLE_COLUMNS = [
    ("fact_immigration", "fact", "cic_id bigint, born_country int, res_country int, i94_mode int, arr_state varchar(3), "
     "age int, i94_visa int, birth_year int, gender varchar(1), visa_type varchar(3), arrival_date date"),
    ("date_time", "dd", "date date, day int, week int, month varchar(20), year int, weekday varchar(20)"),
    ("city_demographics", "demo", "city varchar(256), state varchar(256), med_age float, male_pop bigint, "
     "female_pop bigint, tot_pop bigint, num_veterans bigint, foreign_born bigint, avg_household float, "
     "race varchar(256), count bigint"),
    ("staging_state_temperature", "staging", "dt date, state varchar(256), avg_temp float, month int, year int"),
    ("state_temperature", "dim_st", "state varchar(256), month int, avg_temperature float"),
    ("country_code", "cc", "code int, country varchar(256)"),
]


def oracle_sql() -> dict[str, str]:
    fact = [("fact", FACT)]
    raw = [("raw_arr", RAW_ARR)]
    st3 = tmp_ctes(CHECK_YEARS)
    st10 = tmp_ctes(PIPELINE_YEARS)
    faulty = [("fact", FAULTY_FACT)]
    faulty3, faulty10 = tmp_ctes(CHECK_YEARS, FAULTY_TMP_RAW), tmp_ctes(PIPELINE_YEARS, FAULTY_TMP_RAW)
    six_tables = with_(
        fact + DEM_CTES + st10 + [("demo", DEMO), ("dim_st", dim_st(PIPELINE_YEARS)), ("dd", DATE_DIM), ("cc", CC)],
        "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows, CAST(SUM({c}) AS BIGINT) AS total FROM {r}"
                             for t, r, c in (
            ("fact_immigration", "fact", "cic_id"), ("date_time", "dd", '"day"'), ("city_demographics", "demo", '"count"'),
            ("staging_state_temperature", "staging", '"month"'), ("state_temperature", "dim_st", '"month"'),
            ("country_code", "cc", "code"))))
    return {
        # sources
        "scan_multi_file": with_(raw, "SELECT * FROM raw_arr"),
        "scan_csv": with_([("tmp_raw", TMP_RAW)], "SELECT * FROM tmp_raw"),
        "scan_csv_semicolon": with_([("dem_raw", DEM_RAW)], "SELECT * FROM dem_raw"),
        "csv_malformed_lines": "SELECT concat('x', CAST(c_custkey AS VARCHAR), ',', c_name) AS line "
                               "FROM customer WHERE c_custkey % 10 = 3",
        "scan_parquet": "SELECT o_orderkey, o_custkey, o_totalprice, "
                        "CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
        "empty_typed_relation": with_(raw, "SELECT * FROM raw_arr"),
        "scan_templated_path": with_(raw, "SELECT * FROM raw_arr"),
        "temp_view_query": with_(raw, "SELECT i94addr AS arr_state, COUNT(*) AS n "
                                      "FROM raw_arr GROUP BY i94addr"),
        "table_read": CC,
        # sinks and loads
        "write_partitioned_year_month": with_(
            fact, 'SELECT *, CAST(year(arrival_date) AS INTEGER) AS "year", '
                  'CAST(month(arrival_date) AS INTEGER) AS "month" FROM fact'),
        "write_partitioned_by_column": with_(DEM_CTES, DEMO),
        "write_partitioned_by_copy": with_(st3, "SELECT * FROM staging"),
        "write_overwrite": CC,
        "write_error_if_exists": CC,
        "load_stage_overwrite": with_(fact, "SELECT * FROM fact"),
        "load_stage_in_place": with_(fact, "SELECT * FROM fact"),
        "load_fact_overwrite": with_(fact, "SELECT * FROM fact"),
        "load_dimension_overwrite": with_(st3 + [("dim_st", dim_st(CHECK_YEARS))],
                                          "SELECT * FROM dim_st"),
        "load_dimension_append": with_(fact + [("dd", DATE_DIM)],
                                       "SELECT * FROM dd UNION ALL SELECT * FROM dd"),
        "insert_column_list": with_(fact, DATE_DIM),
        "create_tables": with_(
            fact + DEM_CTES + st3 + [("demo", DEMO), ("dim_st", dim_st(CHECK_YEARS)), ("dd", DATE_DIM), ("cc", CC)],
            "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, '{c}' AS \"columns\", COUNT(*) AS n_rows FROM {r}"
                                 for t, r, c in TABLE_COLUMNS)),
        # projections
        "project_columns": "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem",
        "project_rename": with_(DEM_CTES[:2], "SELECT * FROM dem_renamed"),
        "fact_typed_projection": with_(fact, "SELECT * FROM fact"),
        "fact_bad_values": with_(faulty, "SELECT * FROM fact"),
        "project_cast_keep_name": with_(DEM_CTES, "SELECT * FROM dem_typed"),
        "derive_columns": with_([("tmp_raw", TMP_RAW)],
                                'SELECT dt, "State" AS state, CAST(month(dt) AS INTEGER) AS "month", '
                                'CAST(year(dt) AS INTEGER) AS "year", "State" AS partition_state '
                                "FROM tmp_raw"),
        "drop_column": with_(raw, "SELECT * EXCLUDE (arrdate), CAST(date_add(DATE '1960-01-01', "
                                  "CAST(trunc(arrdate) AS INTEGER)) AS DATE) AS arrival_date "
                                  "FROM raw_arr"),
        # filters
        "filter_unprojected_col": with_([("tmp_raw", TMP_RAW)],
                                        'SELECT dt, "AverageTemperature" AS avg_temp, "State" AS state '
                                        "FROM tmp_raw WHERE \"Country\" = 'United States'"),
        "recent_window_filter": with_(st3, "SELECT * FROM staging"),
        "dq_null_count": with_(faulty, "SELECT COUNT(*) AS n FROM fact WHERE cic_id IS NULL"),
        "dq_duplicate_keys": "SELECT c_nationkey AS code, c_mktsegment AS country, "
                             "COUNT(c_nationkey) AS n FROM customer "
                             "GROUP BY c_nationkey, c_mktsegment HAVING COUNT(c_nationkey) > 1",
        # aggregation, distinct, sort, set operations
        "distinct_rows": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
        "union_distinct_fold": with_(raw, "SELECT DISTINCT * FROM raw_arr"),
        "global_max": "SELECT CAST(MAX(year(l_shipdate)) AS INTEGER) AS max_year FROM lineitem",
        "dim_state_temperature": with_(st3 + [("dim_st", dim_st(CHECK_YEARS))],
                                       "SELECT * FROM dim_st"),
        "dim_state_temperature_incremental": with_(st3 + [("dim_st", dim_st(CHECK_YEARS))],
                                                   "SELECT * FROM dim_st"),
        "dim_state_temperature_sql": with_(st3 + [("dim_st", dim_st(CHECK_YEARS))],
                                           "SELECT * FROM dim_st"),
        "order_by_keys": "SELECT c_nationkey, c_custkey, c_name FROM customer "
                         "ORDER BY c_nationkey, c_custkey",
        "union_all_positional": "SELECT s_suppkey AS k, s_name AS nm FROM supplier "
                                "UNION ALL SELECT c_custkey, c_name FROM customer",
        # scalar functions
        "sas_date_convert": "SELECT o_orderkey AS cic_id, CAST(o_orderdate AS DATE) AS arrival_date "
                            "FROM orders",
        "partition_columns": with_(fact, 'SELECT CAST(year(arrival_date) AS INTEGER) AS "year", '
                                         'CAST(month(arrival_date) AS INTEGER) AS "month", '
                                         "COUNT(*) AS n FROM fact GROUP BY 1, 2"),
        "dim_date_time": with_(fact, DATE_DIM),
        "dim_date_time_sql": with_(fact, DATE_DIM),
        "dim_date_time_incremental": with_(fact, DATE_DIM),
        # quality and contracts
        "dq_null_measure": with_(faulty3 + [("dim_st", dim_st(CHECK_YEARS))],
                                 "SELECT COUNT(*) AS n FROM dim_st WHERE avg_temperature IS NULL"),
        "contract_not_null": with_(faulty, "SELECT COUNT(*) FILTER (WHERE cic_id IS NULL) AS cic_id_nulls, "
                                         "COUNT(*) FILTER (WHERE arrival_date IS NULL) AS arrival_date_nulls "
                                         "FROM fact"),
        "contract_unique_key": with_(DEM_CTES + [("demo", DEMO)],
                                     "SELECT city, state, race, COUNT(*) AS n FROM demo "
                                     "GROUP BY city, state, race HAVING COUNT(*) > 1"),
        "contract_max_length": with_(faulty, "SELECT COUNT(*) FILTER (WHERE length(arr_state) > 3) AS arr_state_too_long, "
                                           "COUNT(*) FILTER (WHERE length(gender) > 1) AS gender_too_long, "
                                           "COUNT(*) FILTER (WHERE length(visa_type) > 3) AS visa_type_too_long "
                                           "FROM fact"),
        "contract_schema": with_(DEM_CTES + [("demo", DEMO)],
                                 'SELECT city, state, med_age, male_pop, female_pop, tot_pop, num_veterans, '
                                 'foreign_born, avg_household, race, "count" FROM demo'),
        "contract_report": with_(faulty, contract_report_sql("fact_immigration", "fact")),
        "dq_report": with_(faulty + faulty10 + [("dim_st", dim_st(PIPELINE_YEARS)), ("cc", FAULTY_CC)], DQ_REPORT),
        "dq_row_count": with_(fact + DEM_CTES + [("dd", DATE_DIM), ("demo", DEMO), ("cc", CC)], "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, COUNT(*) AS n FROM {r}" for t, r in (
                ("fact_immigration", "fact"), ("date_time", "dd"), ("city_demographics", "demo"),
                ("country_code", "cc")))),
        # jobs
        "job_fact_arrivals": with_(fact, "SELECT * FROM fact"),
        "job_city_demographics": with_(DEM_CTES, DEMO),
        "job_state_temperature_staging": with_(st10, "SELECT * FROM staging"),
        "job_country_code": CC,
        "job_fact_incremental": with_(fact, "SELECT * FROM fact"),
        "job_pipeline": six_tables,
        "load_audited": six_tables,
        "job_fact_corrections": with_(fact + [("deliveries", """
SELECT *, 1 AS day FROM fact
UNION ALL SELECT * REPLACE (age + 1 AS age, arrival_date + 40 AS arrival_date), 2 FROM fact WHERE cic_id % 7 = 1
UNION ALL SELECT * REPLACE (99 AS age, 'X' AS gender), 3 FROM fact WHERE cic_id % 21 = 1""")],
            "SELECT * EXCLUDE (day) FROM deliveries "
            "QUALIFY row_number() OVER (PARTITION BY cic_id ORDER BY day DESC) = 1"),
        "load_backfill_period": with_(fact, """
SELECT * REPLACE (CASE WHEN arrival_date >= DATE '1994-10-01' AND arrival_date < DATE '1995-04-01'
                       THEN age ELSE age + 5 END AS age),
       CAST(year(arrival_date) AS INTEGER) AS "year", CAST(month(arrival_date) AS INTEGER) AS "month" FROM fact"""),
        # Every month is smaller than the target, so one file is left.
        "compact_months": with_(fact, 'SELECT CAST(year(arrival_date) AS INTEGER) AS "year", '
                                      'CAST(month(arrival_date) AS INTEGER) AS "month", '
                                      "CAST(1 AS BIGINT) AS n_files, COUNT(*) AS n_rows FROM fact GROUP BY 1, 2"),
        "dq_observed": with_(
            faulty + faulty10 + [("dim_st", dim_st(PIPELINE_YEARS)), ("cc", FAULTY_CC),
                                 ("short", "SELECT * REPLACE (substr(arr_state, 1, 3) AS arr_state, "
                                           "substr(visa_type, 1, 3) AS visa_type) FROM fact")],
            "\nUNION ALL\n".join([DQ_REPORT] + [
                contract_report_sql(t, r, keys=False) + f"\nUNION ALL\nSELECT '{t}_has_rows', '{t}', "
                f"CAST(COUNT(*) AS VARCHAR), 'more than 0', COUNT(*) > 0 FROM {r}"
                for t, r in (("fact_immigration", "short"), ("state_temperature", "dim_st"), ("country_code", "cc"))])),
        # analyses
        "travel_by_state_month": with_(fact, 'SELECT arr_state, CAST(year(arrival_date) AS INTEGER) AS "year", '
                                             'CAST(month(arrival_date) AS INTEGER) AS "month", '
                                             "COUNT(*) AS arrivals FROM fact GROUP BY 1, 2, 3"),
        "travel_counts_incremental": with_(
            fact, 'SELECT arr_state, CAST(year(arrival_date) AS INTEGER) AS "year", '
                  'CAST(month(arrival_date) AS INTEGER) AS "month", COUNT(*) AS arrivals FROM fact GROUP BY 1, 2, 3'),
        "corr_incremental": with_(
            fact + DEM_CTES + [("demo", DEMO)] + st10 + [("dim_st", dim_st(PIPELINE_YEARS)),
                                                         ("d2", CORR_DEM), ("d3", CORR_TMP)],
            "SELECT 'demographics' AS analysis, r FROM d2 UNION ALL SELECT 'temperature', r FROM d3"),
        "corr_travel_demographics": with_(fact + DEM_CTES + [("demo", DEMO)], CORR_DEM),
        "corr_travel_temperature": with_(fact + DEM_CTES + [("demo", DEMO)] + st10
                                         + [("dim_st", dim_st(PIPELINE_YEARS))], CORR_TMP),
    }
