"""The same results in plain SQL for DuckDB, built from shared table expressions."""

from __future__ import annotations

from workload.adapters import EVENT_VARIABLES, KEEP_THRESHOLD, LI_VARIABLES

EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"
SLOT = f"time_bucket(INTERVAL 4 HOUR, ts, {EPOCH})"


def with_(*parts: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in parts) + "\n"


# --- adapters -------------------------------------------------------------------------

RAW = (
    "raw",
    f"""SELECT user_id AS station_id,
       CASE WHEN event_id % 211 = 0 THEN 'bad' ELSE strftime({SLOT}, '%Y%m%d%H%M') END AS time_text,
       {SLOT} AS time, event_type AS variable,
       CASE WHEN event_id % 37 = 0 THEN '-999' WHEN event_id % 53 = 0 THEN 'eor'
            WHEN event_id % 101 = 0 THEN 'Infinity' ELSE CAST(value AS VARCHAR) END AS raw,
       event_id AS order_key FROM events""",
)
TYPED = (
    "typed",
    """SELECT station_id, CAST(try_strptime(lpad(time_text, 12, '0'), '%Y%m%d%H%M') AS TIMESTAMP) AS time, variable,
       nullif(TRY_CAST(raw AS DOUBLE), -999) AS value, order_key FROM raw""",
)
CELLS = (
    "cells",
    """SELECT CAST(year(time) AS INTEGER) AS year, station_id, time, variable,
       arg_min(value, order_key) FILTER (WHERE value IS NOT NULL) AS value
       FROM typed WHERE time IS NOT NULL GROUP BY ALL""",
)
FINITE = (
    "finite",
    "SELECT year, station_id, time, variable, CASE WHEN NOT isinf(value) THEN value END AS value FROM cells",
)
OBS = (RAW, TYPED, CELLS)
OBS_FINITE = (*OBS, FINITE)
WIDE = (
    "wide",
    "SELECT year, station_id, time, "
    + ", ".join(f"max(value) FILTER (WHERE variable = '{v}') AS \"{v}\"" for v in EVENT_VARIABLES)
    + " FROM cells GROUP BY ALL",
)
GAP = (
    "gap",
    f"""SELECT CAST(year({SLOT}) AS INTEGER) AS year, user_id AS station_id, {SLOT} AS time, 'value' AS variable,
       avg(CASE WHEN event_id % 37 <> 0 THEN value END) AS value FROM events GROUP BY ALL""",
)
FILE_ROWS = (
    "file_rows",
    f"SELECT user_id AS file_id, {SLOT} AS time, count(*) AS n_rows FROM events GROUP BY ALL",
)
ANNOUNCED = (
    "announced",
    """SELECT 'fold_' || (file_id % 3) AS fold, file_id, file_id % 50 AS station_id,
       date_trunc('day', lo) - (file_id % 3 - 1) * INTERVAL 1 DAY AS start_date,
       date_trunc('day', hi) + (file_id % 2) * INTERVAL 1 DAY AS end_date
       FROM (SELECT user_id AS file_id, min(ts) AS lo, max(ts) AS hi FROM events GROUP BY ALL)""",
)
LI = (
    "li",
    " UNION ALL ".join(
        f"""SELECT l_suppkey AS station_id, l_shipdate AS time, CAST(year(l_shipdate) AS INTEGER) AS year,
            '{v}' AS variable, {v} AS value FROM lineitem"""
        for v in LI_VARIABLES
    ),
)
PATCHY = (
    "patchy",
    " UNION ALL ".join(
        f"""SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_suppkey AS station_id, l_shipdate AS time,
            '{v}' AS variable, max(nullif({v}, 0)) AS value FROM lineitem GROUP BY ALL"""
        for v in LI_VARIABLES
    ),
)
LIWIDE = (
    "liwide",
    "SELECT l_suppkey AS station_id, l_shipdate AS time, CAST(year(l_shipdate) AS INTEGER) AS year, "
    + ", ".join(LI_VARIABLES)
    + " FROM lineitem",
)
IVL = (
    "ivl",
    """SELECT o_orderstatus AS fold, o_custkey AS station_id, o_orderdate AS start_date,
       o_orderdate + (o_orderkey % 400) * INTERVAL 1 DAY AS end_date, o_orderkey AS file_id FROM orders""",
)
NAMES = (
    "names",
    """SELECT o_orderstatus AS fold, CASE WHEN o_orderkey % 97 = 0 THEN 'readme_' || o_orderkey || '.pdf'
       ELSE 'f_' || strftime(o_orderdate, '%Y%m%d') || '_'
            || strftime(o_orderdate + (o_orderkey % 400) * INTERVAL 1 DAY, '%Y%m%d') || '_'
            || substr(lpad(CAST(o_custkey AS VARCHAR), 5, '0'), 1, 5) || '.txt' END AS file_name FROM orders""",
)
VERSIONS = (
    "versions",
    """SELECT c_custkey % 100 AS station_id, c_custkey AS ordinal,
       CASE WHEN c_custkey % 29 <> 0 THEN 47.0::DOUBLE + (c_custkey % 80) / 10.0::DOUBLE END AS latitude,
       6.0::DOUBLE + (c_custkey % 90) / 10.0::DOUBLE AS longitude, c_acctbal AS height FROM customer""",
)
STATIONS = (
    "stations",
    """SELECT station_id, latitude, longitude, height FROM versions
       QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY ordinal) = 1""",
)
STATIONS_OK = ("stations_ok", "SELECT * FROM stations WHERE latitude IS NOT NULL AND longitude IS NOT NULL")
STN = (VERSIONS, STATIONS, STATIONS_OK)

# --- profiles --------------------------------------------------------------------------


CALENDAR = """SELECT year, unnest(generate_series(make_timestamp(year, 1, 1, 0, 0, 0),
                make_timestamp(year + 1, 1, 1, 0, 0, 0) - INTERVAL 4 HOUR, INTERVAL 4 HOUR)) AS time"""


def missing_of(source: str, calendar: bool = False) -> tuple[tuple[str, str], ...]:
    """With ``calendar`` a year has all its steps, else those that are reported."""
    times = f"SELECT DISTINCT year, time FROM {source}"
    if calendar:
        times = f"{CALENDAR} FROM (SELECT DISTINCT year FROM {source})"
    return (
        (
            "axes",
            f"""SELECT * FROM (SELECT year, count(DISTINCT station_id) AS n_stations FROM {source} GROUP BY year)
                JOIN (SELECT year, count(*) AS n_times FROM ({times}) GROUP BY year) USING (year)""",
        ),
        (
            "missing",
            f"""SELECT year, variable, total AS total_values, total - present AS missing_count,
                (total - present) / total * 100.0::DOUBLE AS missing_pct, inf_count,
                inf_count / total * 100.0::DOUBLE AS inf_pct,
                total - present > 0 OR inf_count > 0 AS has_issues
                FROM (SELECT s.year, s.variable, any_value(a.n_stations * a.n_times) AS total,
                             count(s.value) AS present, count(*) FILTER (WHERE isinf(s.value)) AS inf_count
                      FROM {source} s JOIN axes a ON s.year = a.year GROUP BY ALL)""",
        ),
    )


def range_of(source: str) -> tuple[tuple[str, str], ...]:
    return (
        (
            "ranges",
            f"""SELECT *, n_valid = 0 AS all_missing, n_valid - below_min - above_max AS in_range,
                CASE WHEN n_valid > 0 THEN (n_valid - below_min - above_max) / n_valid * 100.0::DOUBLE ELSE 0 END
                  AS in_range_pct,
                below_min > 0 OR above_max > 0 AS has_issues
                FROM (SELECT year, variable, true AS range_defined, count(value) AS n_valid,
                      count(*) FILTER (WHERE value < 1) AS below_min, count(*) FILTER (WHERE value > 200) AS above_max,
                      min(value) AS actual_min, max(value) AS actual_max FROM {source} GROUP BY ALL)""",
        ),
    )


def jumps_of(source: str, max_lag: str = "INTERVAL 1000 YEAR") -> tuple[tuple[str, str], ...]:
    """The value before stands in the frame of ``max_lag``, and is the last one in it."""
    frame = "PARTITION BY year, variable, station_id ORDER BY time"
    if max_lag.endswith("DAY"):
        frame += f" RANGE BETWEEN {max_lag} PRECEDING AND INTERVAL 1 SECOND PRECEDING"
        before = f"last_value(value) OVER ({frame})"
    else:
        before = f"lag(value) OVER ({frame})"
    return (
        (
            "jumps",
            f"""SELECT year, variable, 100.0::DOUBLE AS threshold, count(d) AS n_steps,
                count(*) FILTER (WHERE d > 100) AS large_jumps, max(d) AS max_diff,
                count(*) FILTER (WHERE d > 100) > 0 AS has_issues
                FROM (SELECT year, variable, CASE WHEN NOT isnan(d) THEN d END AS d FROM
                      (SELECT year, variable, abs(value - {before}) AS d
                       FROM {source} WHERE value IS NOT NULL))
                GROUP BY year, variable HAVING count(d) > 0""",
        ),
    )


STATUS = (
    "status",
    """SELECT m.year, m.variable, m.has_issues AS missing_issue, coalesce(r.has_issues, false) AS range_issue,
       coalesce(j.has_issues, false) AS jump_issue,
       CASE WHEN m.has_issues OR coalesce(r.has_issues, false) OR coalesce(j.has_issues, false)
            THEN 'WARNING' ELSE 'OK' END AS status
       FROM missing m LEFT JOIN ranges r USING (year, variable) LEFT JOIN jumps j USING (year, variable)""",
)
CLEANING = (
    "cleaning",
    """SELECT year, variable, count(value) AS original_valid,
       count(*) FILTER (WHERE value BETWEEN 1 AND 200) AS clean_valid FROM cells GROUP BY ALL""",
)
REMOVED = """original_valid - clean_valid AS removed,
    round(CASE WHEN original_valid > 0 THEN (original_valid - clean_valid) / original_valid * 100.0::DOUBLE
          ELSE 0 END, 6) AS removed_pct"""
GLOBAL = (
    "pooled",
    f"""SELECT *, missing_pct <= {KEEP_THRESHOLD} AS keep, rank() OVER (ORDER BY missing_pct DESC) AS rank
        FROM (SELECT variable, CAST(sum(total_values) AS BIGINT) AS total_values,
              CAST(sum(missing_count) AS BIGINT) AS missing_count,
              sum(missing_count) / sum(total_values) * 100.0::DOUBLE AS missing_pct FROM missing GROUP BY variable)""",
)

# --- statistics -----------------------------------------------------------------------------

STATION_YEAR = (
    "station_year",
    """SELECT year, variable, station_id, count(value) AS n_values, avg(value) AS mean, stddev_pop(value) AS std
       FROM li WHERE value IS NOT NULL GROUP BY ALL HAVING count(value) >= 30""",
)


def levene_of(source: str) -> tuple[tuple[str, str], ...]:
    """Statistic and p-value: one minus a power series of the incomplete beta function, front factor first."""
    return (
        (
            "centred",
            f"""SELECT s.year, s.variable, s.station_id, s.value, abs(s.value - m.med) AS z
                FROM {source} s JOIN (SELECT year, variable, station_id, median(value) AS med FROM {source}
                     WHERE value IS NOT NULL GROUP BY ALL HAVING count(value) >= 10) m
                USING (year, variable, station_id) WHERE s.value IS NOT NULL""",
        ),
        (
            "per_station",
            """SELECT year, variable, station_id, count(*) AS n_i, avg(z) AS z_mean, var_pop(z) * count(*) AS z_within,
               var_pop(value) AS variance FROM centred GROUP BY ALL""",
        ),
        ("grand", "SELECT year, variable, avg(z) AS z_grand FROM centred GROUP BY ALL"),
        (
            "lev",
            """SELECT *, CASE WHEN min_variance > 0 THEN max_variance / min_variance
                              WHEN min_variance = 0 THEN 'inf'::DOUBLE END AS variance_ratio
               FROM (SELECT year, variable, count(*) AS n_stations, CAST(sum(n_i) AS BIGINT) AS n_values,
                     (sum(n_i) - count(*)) / (count(*) - 1)::DOUBLE * sum(n_i * (z_mean - z_grand) ** 2)
                       / nullif(sum(z_within), 0) AS levene_w,
                     min(variance) AS min_variance, max(variance) AS max_variance, avg(variance) AS mean_variance
                     FROM per_station JOIN grand USING (year, variable) GROUP BY ALL HAVING count(*) >= 2)""",
        ),
        (
            "lev_y",
            """SELECT *, (n_stations - 1) / 2.0::DOUBLE AS a, (n_values - n_stations) / 2.0::DOUBLE AS b,
               (n_stations - 1) * levene_w / ((n_stations - 1) * levene_w + n_values - n_stations) AS y FROM lev""",
        ),
        (
            "lev_p",
            """SELECT *, 1 - exp(a * ln(y) + b * ln(1 - y) + lgamma(a + b) - lgamma(a + 1) - lgamma(b))
               * list_sum(list_transform(range(0, 3000), lambda n:
                   exp(lgamma(a + b + n) - lgamma(a + b) + lgamma(a + 1) - lgamma(a + 1 + n) + n * ln(y)))) AS levene_p FROM lev_y""",
        ),
    )


ECDF = (
    "steps",
    """SELECT year, variable, value, cnt, CAST(sum(cnt) OVER (PARTITION BY year, variable) AS BIGINT) AS n,
       CAST(sum(cnt) OVER (PARTITION BY year, variable ORDER BY value) AS BIGINT) AS cum
       FROM (SELECT year, variable, value, count(*) AS cnt FROM li WHERE value IS NOT NULL GROUP BY ALL)""",
)
SHAPE = (
    "shape",
    """SELECT year, variable, n_values, mean, std, m3 / std ** 3 AS skewness, m4 / std ** 4 - 3 AS kurtosis
       FROM (SELECT year, variable, count(*) AS n_values, any_value(mean) AS mean, any_value(std) AS std,
             avg((value - mean) ** 3) AS m3, avg((value - mean) ** 4) AS m4
             FROM li JOIN (SELECT year, variable, avg(value) AS mean, stddev_pop(value) AS std FROM li GROUP BY ALL)
             USING (year, variable) WHERE value IS NOT NULL GROUP BY ALL HAVING count(*) >= 20)""",
)
KS = (
    (
        "phi",
        """SELECT e.*, x, CASE WHEN abs(x) > 6 THEN CASE WHEN x > 0 THEN 1 ELSE 0 END WHEN x = 0 THEN 0.5 ELSE
           0.5 + 0.5 * sign(x) * list_sum(list_transform(range(0, 160), lambda k:
               exp((2 * k + 1) * ln(abs(x)) - lgamma(k + 1.5) - x * x))) END AS phi
           FROM (SELECT s.*, (s.value - h.mean) / h.std / sqrt(2.0::DOUBLE) AS x
                 FROM steps s JOIN shape h USING (year, variable)) e""",
    ),
    (
        "dist",
        """SELECT year, variable, max(greatest(cum / n - phi, phi - (cum - cnt) / n)) AS ks_d
           FROM phi GROUP BY ALL""",
    ),
    (
        "ks",
        """SELECT *, coalesce(ks_p > 0.05, false) AS is_normal FROM (
           SELECT *, CASE WHEN z >= 1 THEN 2 * list_sum(list_transform(range(1, 30), lambda k:
                            (-1) ** (k - 1) * exp(-2.0::DOUBLE * k * k * z * z)))
                          WHEN z <= 0.05 THEN 1
                          ELSE 1 - sqrt(2 * pi()) / z * list_sum(list_transform(range(1, 8), lambda k:
                            exp(-((2 * k - 1) ** 2) * pi() ** 2 / (8 * z * z)))) END AS ks_p
           FROM (SELECT h.*, ks_d, sqrt(n_values) * ks_d + 1 / (6 * sqrt(n_values))
                        + (sqrt(n_values) * ks_d - 1) / (4 * n_values) AS z
                 FROM shape h JOIN dist USING (year, variable)))""",
    ),
)

# --- intervals --------------------------------------------------------------------------------

PAIRS = (
    "pairs",
    """SELECT fold, station_id, prev_start, prev_end, start_date, end_date, count(*) AS n_pairs,
       CAST(epoch(start_date) - epoch(prev_end) AS BIGINT) AS diff_seconds
       FROM (SELECT fold, station_id, lag(start_date) OVER w AS prev_start, lag(end_date) OVER w AS prev_end,
             start_date, end_date FROM ivl
             WINDOW w AS (PARTITION BY fold, station_id ORDER BY start_date, end_date, file_id))
       WHERE prev_start IS NOT NULL GROUP BY ALL""",
)
OVERLAPS = ("overlapping", "SELECT * FROM pairs WHERE diff_seconds < 0")
HOLES = ("holes", "SELECT * FROM pairs WHERE diff_seconds > 86400")
LOSERS = (
    "losers",
    """SELECT DISTINCT fold, station_id,
       CASE WHEN end_date - start_date < prev_end - prev_start THEN start_date ELSE prev_start END AS start_date,
       CASE WHEN end_date - start_date < prev_end - prev_start THEN end_date ELSE prev_end END AS end_date
       FROM overlapping""",
)
RESOLVED = ("resolved", "SELECT ivl.* FROM ivl ANTI JOIN losers USING (fold, station_id, start_date, end_date)")


def extent_of(source: str) -> tuple[str, str]:
    return (
        "extent",
        f"""SELECT fold, CAST(sum(files) AS BIGINT) AS n_files, count(*) AS n_stations, sum(span) AS span_seconds
            FROM (SELECT fold, station_id, count(*) AS files, epoch(max(end_date)) - epoch(min(start_date)) AS span
                  FROM {source} GROUP BY ALL) GROUP BY fold""",
    )


def pair_shares(pairs: str, sign: str, time_share: str) -> str:
    return f"""SELECT e.fold, n_files, coalesce(n_hit, 0) AS n_stations_hit,
       round(coalesce(n_hit, 0) / n_files * 100.0::DOUBLE, 6) AS stations_per_file_pct,
       round(CASE WHEN span_seconds > 0 THEN coalesce(s, 0) / span_seconds * 100.0::DOUBLE ELSE 0 END, 6)
         AS {time_share}
       FROM extent e LEFT JOIN (SELECT fold, count(DISTINCT station_id) AS n_hit,
            sum({sign}diff_seconds * n_pairs) AS s FROM {pairs} GROUP BY fold) h ON e.fold = h.fold"""


IRREGULAR = (
    "irregular",
    """SELECT file_id, prev_time, time, CAST(epoch(time) - epoch(prev_time) AS BIGINT) AS delta_seconds
       FROM (SELECT file_id, time, lag(time) OVER (PARTITION BY file_id ORDER BY time) AS prev_time FROM file_rows)
       WHERE epoch(time) - epoch(prev_time) <> 14400""",
)
ALIGNMENT = (
    "alignment",
    """SELECT *, expected_length_minutes - length_minutes AS missing_minutes,
       abs(missing_start) + abs(missing_end) + missing_intermediate AS wrong_minutes
       FROM (SELECT a.*, first_time, last_time, coalesce(n, 0) AS n_irregular,
             first_time = date_trunc('day', first_time) AS start_ok,
             last_time = date_trunc('day', last_time) + INTERVAL 20 HOUR AS end_ok,
             date_trunc('day', first_time) = start_date AND date_trunc('day', last_time) = end_date AS date_range_ok,
             (epoch(first_time) - epoch(start_date)) / 60 AS missing_start,
             (epoch(end_date) + 72000 - epoch(last_time)) / 60 AS missing_end,
             coalesce(d, 0) / 60 AS missing_intermediate,
             (epoch(last_time) - epoch(first_time) - coalesce(d, 0)) / 60 AS length_minutes,
             (epoch(end_date) - epoch(start_date) + 72000) / 60 AS expected_length_minutes
             FROM announced a
             JOIN (SELECT file_id, min(time) AS first_time, max(time) AS last_time FROM file_rows GROUP BY ALL)
               USING (file_id)
             LEFT JOIN (SELECT file_id, count(*) AS n, sum(delta_seconds) AS d FROM irregular GROUP BY ALL)
               USING (file_id))
       WHERE NOT (start_ok AND end_ok AND date_range_ok) OR n_irregular > 0""",
)
ALIGNED = (FILE_ROWS, ANNOUNCED, IRREGULAR, ALIGNMENT)
DURATIONS = (
    "durations",
    """SELECT fold, CAST(floor(days / 365.25) AS INTEGER) AS years, count(*) AS n_stations
       FROM (SELECT fold, station_id, sum(date_diff('day', start_date, end_date)) AS days FROM ivl GROUP BY ALL)
       GROUP BY ALL""",
)

# --- gap filling ------------------------------------------------------------------------------


def dense_of(source: str, calendar: bool = False) -> tuple[tuple[str, str], ...]:
    """Every station and variable of a year at every time of that year, reported or in its calendar."""
    times = f"SELECT DISTINCT year, time FROM {source}"
    if calendar:
        times = f"{CALENDAR} FROM (SELECT DISTINCT year FROM {source})"
    return (
        (
            "axis",
            f"""SELECT year, time, row_number() OVER (PARTITION BY year ORDER BY time) - 1 AS pos,
                count(*) OVER (PARTITION BY year) AS n_pos FROM ({times})""",
        ),
        (
            "dense",
            f"""SELECT k.year, k.station_id, k.variable, a.time, a.pos, a.n_pos, s.value
                FROM (SELECT * FROM (SELECT DISTINCT year, station_id FROM {source})
                      JOIN (SELECT DISTINCT year, variable FROM {source}) USING (year)) k
                JOIN axis a ON k.year = a.year
                LEFT JOIN {source} s ON s.year = k.year AND s.station_id = k.station_id
                     AND s.variable = k.variable AND s.time = a.time""",
        ),
    )


RUNS = (
    "runs",
    """SELECT year, station_id, min(pos) AS gap_start, max(pos) + 1 AS gap_end, count(*) AS gap_length
       FROM (SELECT *, sum(CASE WHEN value IS NOT NULL THEN 1 ELSE 0 END)
                OVER (PARTITION BY year, station_id ORDER BY pos) AS island,
             count(value) OVER (PARTITION BY year, station_id) AS n_valid FROM dense)
       WHERE value IS NULL AND n_valid > 0 GROUP BY year, station_id, island""",
)


def filled(max_extrap: int) -> tuple[tuple[str, str], ...]:
    series = "PARTITION BY year, variable, station_id ORDER BY pos"
    back = f"OVER ({series} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = f"OVER ({series} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return (
        (
            "near",
            f"""SELECT *, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) {back} AS lp,
                last_value(value IGNORE NULLS) {back} AS lv,
                first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) {ahead} AS rp,
                first_value(value IGNORE NULLS) {ahead} AS rv FROM dense""",
        ),
        (
            "lined",
            """SELECT *, coalesce(value, CASE WHEN rp - lp - 1 <= 6
                 THEN lv + (rv - lv) * (pos - lp)::DOUBLE / (rp - lp)::DOUBLE END) AS s FROM near""",
        ),
        (
            "trends",
            f"""SELECT year, variable, station_id, pos, n_pos, time, value, s,
                CASE WHEN pos >= 3 THEN (s - lag(s, 3) OVER w) / 3 WHEN pos = 2 THEN (s - lag(s, 2) OVER w) / 2
                     WHEN pos = 1 THEN s - lag(s, 1) OVER w END AS up,
                CASE WHEN n_pos - 1 - pos >= 3 THEN (s - lead(s, 3) OVER w) / 3
                     WHEN n_pos - 1 - pos = 2 THEN (s - lead(s, 2) OVER w) / 2
                     WHEN n_pos - 1 - pos = 1 THEN s - lead(s, 1) OVER w END AS down,
                last_value(CASE WHEN s IS NOT NULL THEN pos END IGNORE NULLS) {back} AS lpos,
                first_value(CASE WHEN s IS NOT NULL THEN pos END IGNORE NULLS) {ahead} AS rpos
                FROM lined WINDOW w AS ({series})""",
        ),
        (
            "ends",
            f"""SELECT t.*, CASE WHEN t.s IS NULL AND t.pos - l.pos <= {max_extrap}
                      THEN l.s + l.up * (t.pos - l.pos) END AS fwd,
                 CASE WHEN t.s IS NULL AND r.pos - t.pos <= {max_extrap}
                      THEN r.s + r.down * (r.pos - t.pos) END AS bwd
                FROM trends t
                LEFT JOIN trends l ON l.year = t.year AND l.variable = t.variable AND l.station_id = t.station_id
                     AND l.pos = t.lpos
                LEFT JOIN trends r ON r.year = t.year AND r.variable = t.variable AND r.station_id = t.station_id
                     AND r.pos = t.rpos""",
        ),
        (
            "filled",
            """SELECT year, station_id, variable, time, round(coalesce(value, s, fwd, bwd), 6) AS value,
               CASE WHEN value IS NOT NULL THEN 'observed' WHEN s IS NOT NULL THEN 'interpolated'
                    WHEN fwd IS NOT NULL THEN 'extrapolated_forward'
                    WHEN bwd IS NOT NULL THEN 'extrapolated_backward' ELSE 'missing' END AS value_method FROM ends""",
        ),
    )


CLEAN_CELLS = (
    "clean_cells",
    """SELECT year, station_id, time, variable, CASE WHEN value BETWEEN 1 AND 200 THEN value END AS value
       FROM cells""",
)
FILL_COUNTS = (
    "counts",
    """SELECT year, variable, count(*) FILTER (WHERE value_method <> 'observed') AS missing_before,
       count(*) FILTER (WHERE value_method = 'interpolated') AS n_interpolated,
       count(*) FILTER (WHERE value_method LIKE 'extrapolated%') AS n_extrapolated,
       count(*) FILTER (WHERE value_method = 'missing') AS missing_after FROM filled GROUP BY ALL""",
)
FILL_SUMS = ", ".join(
    f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("missing_before", "n_interpolated", "n_extrapolated", "missing_after")
)
SUCCESS = "sum(n_interpolated + n_extrapolated) / nullif(sum(missing_before), 0) * 100.0::DOUBLE"
ALL_FILLS = with_(*OBS, CLEAN_CELLS, *dense_of("clean_cells"), *filled(2), FILL_COUNTS)
GAP_FILLED = with_(GAP, *dense_of("gap"), *filled(2))
# The cells over two years; one variable is absent in the earlier one.
YEARS = (
    "years_cells",
    """SELECT CAST(year(t) AS INTEGER) AS year, station_id, t AS time, variable, value
       FROM (SELECT *, CASE WHEN station_id % 2 = 0 THEN time - INTERVAL 366 DAY ELSE time END AS t FROM cells)
       WHERE NOT (station_id % 2 = 0 AND variable = 'view')""",
)
YEARS_FINITE = ("years_finite", YEARS[1].replace("FROM cells", "FROM finite"))
FINITE = "round(CASE WHEN isfinite({0}) THEN {0} END, 6)"
YEARS_CLEAN = (
    "years_clean",
    "SELECT year, station_id, time, variable, CASE WHEN value BETWEEN 1 AND 200 THEN value END AS value FROM years_cells",
)


def banded(value: str, good: str, fair: str) -> str:
    return f"CASE WHEN {value} {good} THEN 'green' WHEN {value} {fair} THEN 'yellow' ELSE 'red' END"


COORDINATES = " UNION ALL ".join(
    f"""SELECT year, '{c}' AS variable, {c} AS value, {lo}::DOUBLE AS lo, {hi}::DOUBLE AS hi
        FROM (SELECT DISTINCT year, station_id FROM liwide) LEFT JOIN stations_ok USING (station_id)"""
    for c, lo, hi in (("latitude", 46, 56), ("longitude", 5, 16), ("height", -50, 3000))
)
POSITION = "round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, round(height, 6) AS height"

ORACLE: dict[str, str] = {
    # sources and sinks
    "scan_delimited": with_(RAW)
    + """SELECT station_id, time, CAST(year(time) AS INTEGER) AS year, QN, value, eor FROM (
         SELECT station_id, CAST(try_strptime(lpad(time_text, 12, '0'), '%Y%m%d%H%M') AS TIMESTAMP) AS time,
         CAST(order_key % 10 AS DOUBLE) AS QN,
         CASE WHEN order_key % 89 <> 0 THEN nullif(TRY_CAST(raw AS DOUBLE), -999) END AS value,
         CASE WHEN order_key % 89 <> 0 THEN 'eor' END AS eor
         FROM raw WHERE order_key % 89 = 0 OR order_key % 97 <> 0) WHERE time IS NOT NULL""",
    "delimited_rejects": with_(RAW)
    + """SELECT CAST(CASE WHEN regexp_matches(time_text, '^[0-9]{12}$') THEN time_text[1:4] END AS INTEGER) AS year,
         count(*) FILTER (WHERE order_key % 89 = 0 OR order_key % 97 <> 0) AS n_rows,
         count(*) FILTER (WHERE order_key % 89 <> 0 AND order_key % 97 = 0) AS n_rejected FROM raw GROUP BY ALL""",
    "interval_catalog": with_(NAMES)
    + r"""SELECT fold, file_name, regexp_extract(file_name, '_(\d+)\.txt$', 1) AS station_id,
         strptime(regexp_extract(file_name, '_(\d{8})_(\d{8})_', 1), '%Y%m%d') AS start_date,
         strptime(regexp_extract(file_name, '_(\d{8})_(\d{8})_', 2), '%Y%m%d') AS end_date
         FROM names WHERE regexp_matches(file_name, '.*_(\d{8})_(\d{8})_(\d+)\.txt$')""",
    "catalog_rejects": with_(NAMES) + "SELECT * FROM names WHERE file_name LIKE 'readme%'",
    "storage_inventory": """SELECT regexp_extract(url, '//([^/:?#]+)', 1) AS fold, count(*) AS file_count,
         round(sum(strlen(html)) / 1024.0::DOUBLE ** 3, 9) AS storage_gb FROM pages GROUP BY ALL""",
    "extract_links": r"""SELECT page_id, position - 1 AS position, links[position] AS link
         FROM (SELECT page_id, links, unnest(range(1, len(links) + 1)) AS position
               FROM (SELECT page_id, regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]+)"', 1) AS links FROM pages))
         WHERE links[position] LIKE '%e'""",
    "expand_archives": """SELECT page_id || '.zip' AS archive, 0::BIGINT AS member_idx, 'url.txt' AS member,
         strlen(url) AS n_bytes, md5(url) AS digest FROM pages
         UNION ALL SELECT page_id || '.zip', 1, 'page_' || page_id || '.html', strlen(html), md5(html) FROM pages""",
    "station_latest": with_(VERSIONS)
    + f"""SELECT station_id, ordinal, {POSITION} FROM versions
         QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY ordinal DESC) = 1""",
    "write_year_partitions": with_(LIWIDE)
    + "SELECT year, count(*) AS n_rows, round(sum(l_quantity), 6) AS quantity FROM liwide GROUP BY year",
    "cleaning_report": with_(*OBS, CLEANING)
    + f"""SELECT year, variable, original_valid, clean_valid, level, {REMOVED} FROM (
         SELECT coalesce(CAST(year AS VARCHAR), 'all') AS year, coalesce(variable, 'all') AS variable,
         CAST(sum(original_valid) AS BIGINT) AS original_valid, CAST(sum(clean_valid) AS BIGINT) AS clean_valid,
         CAST(grouping(year, variable) AS BIGINT) AS level FROM cleaning GROUP BY ROLLUP (year, variable))""",
    # projections and filters
    "lenient_cast": with_(RAW)
    + """SELECT order_key, CASE WHEN NOT isinf(v) THEN v END AS value, v IS NULL AS is_missing
         FROM (SELECT order_key, TRY_CAST(raw AS DOUBLE) AS v FROM raw)""",
    "sentinel_to_null": with_(RAW)
    + """SELECT order_key, variable, CASE WHEN NOT isinf(v) AND v <> -999 THEN v END AS value
         FROM (SELECT order_key, variable, TRY_CAST(raw AS DOUBLE) AS v FROM raw)""",
    "parse_time": with_(RAW)
    + """SELECT order_key, CASE WHEN time_text <> 'bad' THEN time END AS time FROM raw""",
    "year_slice": """SELECT l_suppkey AS station_id, count(*) AS n_rows, round(sum(l_quantity), 6) AS quantity
         FROM lineitem WHERE year(l_shipdate) = 1998 GROUP BY ALL""",
    "files_of_year": with_(IVL)
    + "SELECT * FROM ivl WHERE year(start_date) <= 1998 AND year(end_date) >= 1998",
    "filter_inf": with_(*OBS_FINITE) + "SELECT * FROM finite",
    "filter_range": with_(*OBS, WIDE)
    + "SELECT year, station_id, time, "
    + ", ".join(f'CASE WHEN "{v}" BETWEEN 1 AND 200 THEN "{v}" END AS "{v}"' for v in EVENT_VARIABLES)
    + " FROM wide",
    "clip_range": with_(*OBS, WIDE)
    + "SELECT year, station_id, time, "
    + ", ".join(
        f'CASE WHEN "{v}" < 1 THEN 1 WHEN "{v}" > 200 THEN 200 ELSE "{v}" END AS "{v}"' for v in EVENT_VARIABLES
    )
    + " FROM wide",
    "apply_filters": with_(*OBS, CLEAN_CELLS) + "SELECT * FROM clean_cells",
    "prune_variables": with_(*OBS, *missing_of("cells"), GLOBAL)
    + """SELECT year, count(DISTINCT (station_id, time)) AS n_rows,
         coalesce((SELECT string_agg(variable, ',' ORDER BY variable) FROM pooled WHERE keep), '') AS variables
         FROM cells GROUP BY year""",
    # joins and grid
    "join_station": with_(LIWIDE, *STN)
    + f"""SELECT year, station_id, {POSITION}, n_rows, quantity FROM (
         SELECT year, station_id, latitude, longitude, height, count(*) AS n_rows, round(sum(l_quantity), 6) AS quantity
         FROM liwide LEFT JOIN stations_ok USING (station_id) GROUP BY ALL)""",
    "station_constants": with_(LIWIDE, *STN)
    + f"""SELECT station_id, {POSITION} FROM (SELECT DISTINCT station_id FROM liwide)
         LEFT JOIN stations_ok USING (station_id)""",
    "station_dedupe": with_(*STN)
    + f"""SELECT station_id, ordinal, {POSITION}
         FROM stations_ok JOIN (SELECT station_id, min(ordinal) AS ordinal FROM versions GROUP BY ALL) USING (station_id)""",
    "densify_grid": with_(GAP, *dense_of("gap"))
    + "SELECT year, station_id, time, pos, round(value, 6) AS value FROM dense",
    "regularize_interval": with_(FILE_ROWS, ANNOUNCED)
    + """SELECT s.file_id, s.time, r.n_rows, r.n_rows IS NULL AS is_inserted
         FROM (SELECT file_id, unnest(generate_series(start_date, end_date + INTERVAL 20 HOUR, INTERVAL 4 HOUR)) AS time
               FROM announced) s LEFT JOIN file_rows r ON r.file_id = s.file_id AND r.time = s.time""",
    # interval catalog
    "overlap_intervals": with_(IVL, PAIRS, OVERLAPS) + "SELECT * FROM overlapping",
    "resolve_overlaps": with_(IVL, PAIRS, OVERLAPS, LOSERS, RESOLVED) + "SELECT * FROM resolved",
    "missing_intervals": with_(IVL, PAIRS, HOLES) + "SELECT * FROM holes",
    "fill_missing_intervals": with_(IVL, PAIRS, HOLES)
    + """SELECT fold, station_id, count(*) AS n_rows, min(time) AS first_time, max(time) AS last_time
         FROM (SELECT fold, station_id, unnest(generate_series(prev_end + INTERVAL 1 DAY, start_date - INTERVAL 1 DAY,
               INTERVAL 1 DAY)) AS time FROM holes) GROUP BY ALL""",
    "irregular_steps": with_(FILE_ROWS, IRREGULAR) + "SELECT * FROM irregular",
    "alignment_check": with_(*ALIGNED) + "SELECT * FROM alignment",
    "concat_stations": with_(FILE_ROWS, ANNOUNCED)
    + "SELECT file_id, time, n_rows, fold, station_id, start_date FROM file_rows JOIN announced USING (file_id)",
    "station_durations": with_(IVL, DURATIONS) + "SELECT * FROM durations",
    "duration_stack": with_(IVL, DURATIONS)
    + """SELECT fold, years, n_stations, CAST(coalesce(sum(n_stations) OVER (PARTITION BY years ORDER BY fold
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS base
         FROM (SELECT f.fold, f.years, coalesce(n_stations, 0) AS n_stations
               FROM (SELECT DISTINCT fold, CAST(unnest(range(0, (SELECT greatest(max(years), 34) + 1 FROM durations)))
                            AS INTEGER) AS years FROM durations) f
               LEFT JOIN durations d ON d.fold = f.fold AND d.years = f.years)""",
    "overlap_pct": with_(IVL, PAIRS, OVERLAPS, LOSERS, RESOLVED, extent_of("resolved"))
    + pair_shares("overlapping", "-", "overlap_time_pct"),
    "missing_pct": with_(IVL, PAIRS, HOLES, extent_of("ivl")) + pair_shares("holes", "", "missing_time_pct"),
    "misaligned_pct": with_(*ALIGNED, extent_of("announced"))
    + """SELECT e.fold, n_files, coalesce(n_bad, 0) AS n_bad,
         round(coalesce(n_bad, 0) / n_files * 100.0::DOUBLE, 6) AS bad_files_pct,
         round(coalesce(s, 0) / span_seconds * 100.0::DOUBLE, 6) AS wrong_time_pct
         FROM extent e LEFT JOIN (SELECT fold, count(*) AS n_bad, sum(wrong_minutes) * 60 AS s
              FROM alignment GROUP BY fold) b ON b.fold = e.fold""",
    "correction_totals": with_(*ALIGNED)
    + "SELECT count(*) AS n_files, round(coalesce(sum(wrong_minutes), 0), 6) AS total_minutes FROM alignment",
    "consolidation_pct": with_(IVL, extent_of("ivl"))
    + """SELECT fold, n_files, n_stations, round(n_stations / n_files * 100.0::DOUBLE, 6) AS stations_per_file_pct
         FROM extent""",
    # merging
    "union_folds": with_(RAW)
    + "SELECT station_id, time, order_key, "
    + ", ".join(f"CASE WHEN variable = '{v}' THEN v END AS \"{v}\"" for v in EVENT_VARIABLES)
    + """ FROM (SELECT *, CASE WHEN NOT isinf(TRY_CAST(raw AS DOUBLE)) THEN TRY_CAST(raw AS DOUBLE) END AS v
          FROM raw)""",
    "first_non_null": with_(*OBS_FINITE) + "SELECT * FROM finite",
    # profiles
    "profile_missing": with_(*OBS, *missing_of("cells"))
    + "SELECT * REPLACE (round(missing_pct, 6) AS missing_pct, round(inf_pct, 6) AS inf_pct) FROM missing",
    "profile_range": with_(*OBS_FINITE, *range_of("finite"))
    + """SELECT * REPLACE (round(in_range_pct, 6) AS in_range_pct, round(actual_min, 6) AS actual_min,
         round(actual_max, 6) AS actual_max) FROM ranges""",
    "temporal_jumps": with_(*OBS_FINITE, *jumps_of("finite"))
    + "SELECT * REPLACE (round(max_diff, 6) AS max_diff) FROM jumps",
    "temporal_jumps_lag": with_(*OBS_FINITE, *jumps_of("finite", "INTERVAL 1 DAY"))
    + "SELECT * REPLACE (round(max_diff, 6) AS max_diff) FROM jumps",
    "temporal_jumps_years": with_(*OBS_FINITE, YEARS_FINITE, *jumps_of("years_finite"))
    + "SELECT * REPLACE (round(max_diff, 6) AS max_diff) FROM jumps",
    "check_report": with_(*OBS, YEARS, *missing_of("years_cells"), *range_of("years_cells"), *jumps_of("years_cells"), STATUS)
    + f"""SELECT year, CASE WHEN level = 0 THEN variable ELSE 'all' END AS variable, level, n_stations, n_times, n_variables, n_warnings,
         total_values, missing_count, inf_count, n_valid, below_min, above_max, n_steps, large_jumps,
         {FINITE.format("actual_min")} AS actual_min, {FINITE.format("actual_max")} AS actual_max, threshold,
         {FINITE.format("max_diff")} AS max_diff, missing_issue, range_issue, jump_issue, status,
         round(missing_count / total_values * 100.0::DOUBLE, 6) AS missing_pct,
         round(CASE WHEN n_valid > 0 THEN (n_valid - below_min - above_max) / n_valid * 100.0::DOUBLE ELSE 0 END, 6) AS in_range_pct
         FROM (SELECT s.year, s.variable, CAST(grouping(s.variable) AS BIGINT) AS level,
               any_value(a.n_stations) AS n_stations, any_value(a.n_times) AS n_times, count(*) AS n_variables,
               count(*) FILTER (WHERE status = 'WARNING') AS n_warnings,
               CAST(sum(total_values) AS BIGINT) AS total_values, CAST(sum(missing_count) AS BIGINT) AS missing_count,
               CAST(sum(inf_count) AS BIGINT) AS inf_count, CAST(sum(n_valid) AS BIGINT) AS n_valid,
               CAST(sum(below_min) AS BIGINT) AS below_min, CAST(sum(above_max) AS BIGINT) AS above_max,
               CAST(sum(coalesce(n_steps, 0)) AS BIGINT) AS n_steps, CAST(sum(coalesce(large_jumps, 0)) AS BIGINT) AS large_jumps,
               CASE WHEN grouping(s.variable) = 0 THEN min(actual_min) END AS actual_min,
               CASE WHEN grouping(s.variable) = 0 THEN max(actual_max) END AS actual_max,
               CASE WHEN grouping(s.variable) = 0 THEN 100.0::DOUBLE END AS threshold, max(max_diff) AS max_diff,
               bool_or(missing_issue) AS missing_issue, bool_or(range_issue) AS range_issue, bool_or(jump_issue) AS jump_issue,
               max(status) AS status
               FROM status s JOIN missing m USING (year, variable) JOIN ranges r USING (year, variable)
               LEFT JOIN jumps j USING (year, variable) JOIN axes a ON a.year = s.year
               GROUP BY GROUPING SETS ((s.year, s.variable), (s.year)))""",
    "variable_status": with_(*OBS, *missing_of("cells"), *range_of("cells"), *jumps_of("cells"), STATUS)
    + "SELECT * FROM status",
    "variable_status_full": with_(
        *OBS_FINITE,
        *missing_of("finite"),
        *range_of("finite"),
        *jumps_of("finite"),
        STATUS,
        *levene_of("finite"),
    )
    + """SELECT s.year, s.variable, missing_issue, range_issue, jump_issue,
         coalesce(levene_p <= 0.05, false) AS variance_issue,
         CASE WHEN status = 'WARNING' OR coalesce(levene_p <= 0.05, false) THEN 'WARNING' ELSE 'OK' END AS status
         FROM status s LEFT JOIN lev_p USING (year, variable)""",
    "dataset_overview": with_(*OBS, *missing_of("cells"), *range_of("cells"), *jumps_of("cells"), STATUS)
    + """SELECT a.year, n_stations, n_times, n_variables, variables, n_warnings FROM axes a JOIN (
         SELECT year, count(*) AS n_variables, string_agg(variable, ',' ORDER BY variable) AS variables,
         count(*) FILTER (WHERE status = 'WARNING') AS n_warnings FROM status GROUP BY year) s ON a.year = s.year""",
    "coordinate_checks": with_(LIWIDE, *STN)
    + f"""SELECT *, CASE WHEN missing_count > 0 OR below_min > 0 OR above_max > 0 THEN 'WARNING' ELSE 'OK' END AS status
         FROM (SELECT year, variable, count(*) AS total_values, count(*) FILTER (WHERE value IS NULL) AS missing_count,
               count(*) FILTER (WHERE value < lo) AS below_min, count(*) FILTER (WHERE value > hi) AS above_max
               FROM ({COORDINATES}) GROUP BY ALL)""",
    "cleaning_stats": with_(*OBS, CLEANING) + f"SELECT *, {REMOVED} FROM cleaning",
    "cleaning_rollup": with_(*OBS, CLEANING)
    + f"""SELECT *, rank() OVER (ORDER BY removed_pct DESC) AS rank FROM (SELECT *, {REMOVED} FROM (
         SELECT variable, CAST(sum(original_valid) AS BIGINT) AS original_valid,
         CAST(sum(clean_valid) AS BIGINT) AS clean_valid FROM cleaning GROUP BY variable))""",
    "completeness_by_variable": with_(PATCHY, *missing_of("patchy"))
    + f"""SELECT variable, round(c, 6) AS completeness_pct, round(m, 6) AS missing_pct,
         {banded("c", ">= 95", ">= 80")} AS band, rank() OVER (ORDER BY round(c, 9)) AS rank
         FROM (SELECT variable, avg(100 - missing_pct) AS c, avg(missing_pct) AS m FROM missing GROUP BY variable)""",
    "violations_by_variable": with_(*OBS, *range_of("cells"))
    + """SELECT variable, violations, n_valid, round(p, 6) AS violation_pct, rank() OVER (ORDER BY p DESC) AS rank
         FROM (SELECT variable, CAST(sum(below_min + above_max) AS BIGINT) AS violations,
               CAST(sum(n_valid) AS BIGINT) AS n_valid,
               sum(below_min + above_max) / sum(n_valid) * 100.0::DOUBLE AS p FROM ranges WHERE n_valid > 0
               GROUP BY variable)""",
    "global_missing_pct": with_(*OBS, *missing_of("cells"), GLOBAL)
    + "SELECT * REPLACE (round(missing_pct, 6) AS missing_pct) FROM pooled",
    "keep_list": with_(*OBS, *missing_of("cells"), GLOBAL) + "SELECT variable, keep FROM pooled",
    "prune_summary": with_(*OBS, *missing_of("cells"), GLOBAL)
    + """SELECT year, count(*) AS original_vars, count(*) FILTER (WHERE keep) AS remaining_vars,
         count(*) FILTER (WHERE NOT keep) AS removed_vars FROM missing JOIN pooled USING (variable) GROUP BY year""",
    "year_summary": with_(*OBS)
    + """SELECT year, n_stations, n_times, first_time, last_time,
         round((cells - present) / cells * 100.0::DOUBLE, 6) AS missing_pct,
         round(rows_ / expected, 6) AS data_ratio, rows_ / expected >= 0.8 AS enough_data
         FROM (SELECT year, count(DISTINCT station_id) AS n_stations, count(DISTINCT time) AS n_times,
               min(time) AS first_time, max(time) AS last_time, count(value) AS present,
               count(DISTINCT station_id) * count(DISTINCT time) AS rows_,
               count(DISTINCT station_id) * count(DISTINCT time) * count(DISTINCT variable) AS cells,
               (count(DISTINCT station_id) * 6 * dayofyear(make_date(year, 12, 31)))::DOUBLE AS expected
               FROM cells GROUP BY year)""",
    # statistics
    "station_year_stats": with_(LI, STATION_YEAR)
    + "SELECT * REPLACE (round(mean, 4) AS mean, round(std, 4) AS std) FROM station_year",
    "interannual_cv": with_(LI, STATION_YEAR)
    + f"""SELECT variable, round(m, 6) AS mean_cv, round(s, 6) AS std_cv, n_stations,
         {banded("m", "<= 0.15", "<= 0.3")} AS band, rank() OVER (ORDER BY m DESC) AS rank
         FROM (SELECT variable, avg(mean_cv) AS m, avg(std_cv) AS s, count(mean_cv) AS n_stations
               FROM (SELECT variable, station_id, stddev_pop(mean) / nullif(abs(avg(mean)), 0) AS mean_cv,
                     stddev_pop(std) / nullif(avg(std), 0) AS std_cv
                     FROM station_year GROUP BY ALL HAVING count(*) >= 2) GROUP BY variable)""",
    "levene_stat": with_(LI, *levene_of("li"))
    + """SELECT * REPLACE (round(levene_w, 6) AS levene_w, round(variance_ratio, 6) AS variance_ratio,
         round(min_variance, 2) AS min_variance, round(max_variance, 2) AS max_variance,
         round(mean_variance, 2) AS mean_variance) FROM lev""",
    "levene": with_(LI, *levene_of("li"))
    + """SELECT year, variable, n_stations, n_values, round(levene_w, 6) AS levene_w,
         round(variance_ratio, 6) AS variance_ratio, round(levene_p, 6) AS levene_p,
         levene_p > 0.05 AS homogeneous, levene_p <= 0.05 AS has_issues FROM lev_p""",
    "variance_ratio_by_variable": with_(LI, *levene_of("li"))
    + f"""SELECT variable, round(r, 6) AS variance_ratio, n_years, {banded("r", "<= 5", "<= 10")} AS band,
         rank() OVER (ORDER BY r DESC) AS rank
         FROM (SELECT variable, avg(variance_ratio) AS r, count(*) AS n_years FROM lev
               WHERE variance_ratio > 0 AND NOT isinf(variance_ratio) GROUP BY variable)""",
    "ecdf": with_(LI, ECDF)
    + """SELECT year, variable, round(value, 6) AS value, cnt, n, round((cum - cnt) / n, 6) AS below,
         round(cum / n, 6) AS upto FROM steps""",
    "shape_stats": with_(LI, SHAPE)
    + """SELECT * REPLACE (round(mean, 4) AS mean, round(std, 4) AS std, round(skewness, 6) AS skewness,
         round(kurtosis, 6) AS kurtosis) FROM shape""",
    "ks_normality": with_(LI, ECDF, SHAPE, *KS)
    + """SELECT year, variable, n_values, round(ks_d, 6) AS ks_d, round(ks_p, 6) AS ks_p, is_normal FROM ks""",
    "distribution_by_variable": with_(LI, ECDF, SHAPE, *KS)
    + f"""SELECT variable, n_years, round(p, 6) AS mean_p, round(share, 6) AS normal_pct, round(sk, 6) AS mean_skewness,
         round(ku, 6) AS mean_kurtosis, CASE WHEN p > 0.05 THEN 'green' ELSE 'red' END AS p_band,
         {banded("share", "> 80", "> 50")} AS normal_band, {banded("abs(sk)", "< 0.5", "< 1")} AS skewness_band,
         {banded("abs(ku)", "< 1", "< 3")} AS kurtosis_band,
         CASE WHEN share > 80 THEN 'normal' WHEN share > 50 THEN 'moderate' ELSE 'non-normal' END AS distribution_class,
         rank() OVER (ORDER BY p) AS p_rank, rank() OVER (ORDER BY share DESC) AS normal_rank,
         rank() OVER (ORDER BY abs(sk) DESC) AS skewness_rank, rank() OVER (ORDER BY abs(ku) DESC) AS kurtosis_rank
         FROM (SELECT variable, count(*) AS n_years, avg(ks_p) AS p, avg(is_normal::INTEGER) * 100 AS share,
               avg(skewness) AS sk, avg(kurtosis) AS ku FROM ks GROUP BY variable)""",
    # gap filling
    "gap_runs": with_(GAP, *dense_of("gap"), RUNS)
    + """SELECT r.year, r.station_id, gap_start, gap_end, gap_length, round(a.value, 6) AS left_value,
         round(b.value, 6) AS right_value FROM runs r
         LEFT JOIN dense a ON a.year = r.year AND a.station_id = r.station_id AND a.pos = gap_start - 1
         LEFT JOIN dense b ON b.year = r.year AND b.station_id = r.station_id AND b.pos = gap_end""",
    "interpolate": with_(GAP, *dense_of("gap"), *filled(0))
    + "SELECT year, station_id, time, value, value_method FROM filled",
    "extrapolate": GAP_FILLED
    + """SELECT year, station_id, time, value, value_method FROM filled WHERE value_method LIKE 'extrapolated%'""",
    "fill_gaps": GAP_FILLED + "SELECT year, station_id, time, value, value_method FROM filled",
    "fill_stats": ALL_FILLS
    + f"""SELECT *, {banded("success_pct", "> 50", "> 10")} AS band, rank() OVER (ORDER BY success_pct DESC) AS rank
         FROM (SELECT variable, {FILL_SUMS}, round({SUCCESS}, 6) AS success_pct FROM counts GROUP BY variable)""",
    "densify_calendar": with_(GAP, *dense_of("gap", calendar=True))
    + "SELECT year, station_id, time, pos, round(value, 6) AS value FROM dense",
    "fill_gaps_calendar": with_(GAP, *dense_of("gap", calendar=True), *filled(2))
    + "SELECT year, station_id, time, value, value_method FROM filled",
    "profile_missing_calendar": with_(*OBS, *missing_of("cells", calendar=True))
    + "SELECT * REPLACE (round(missing_pct, 6) AS missing_pct, round(inf_pct, 6) AS inf_pct) FROM missing",
    "profile_missing_years": with_(*OBS, YEARS, *missing_of("years_cells"))
    + "SELECT * REPLACE (round(missing_pct, 6) AS missing_pct, round(inf_pct, 6) AS inf_pct) FROM missing",
    "gapfill_report_years": with_(*OBS, YEARS, YEARS_CLEAN, *dense_of("years_clean"), *filled(2), FILL_COUNTS)
    + f"""SELECT coalesce(CAST(year AS VARCHAR), 'all') AS year, coalesce(variable, 'all') AS variable,
         {FILL_SUMS}, CAST(grouping(year, variable) AS BIGINT) AS level, round({SUCCESS}, 6) AS success_pct
         FROM counts GROUP BY ROLLUP (year, variable)""",
    "gapfill_report": ALL_FILLS
    + f"""SELECT coalesce(CAST(year AS VARCHAR), 'all') AS year, coalesce(variable, 'all') AS variable,
         {FILL_SUMS}, CAST(grouping(year, variable) AS BIGINT) AS level, round({SUCCESS}, 6) AS success_pct
         FROM counts GROUP BY ROLLUP (year, variable)""",
    "fill_overall": ALL_FILLS
    + f"""SELECT {FILL_SUMS}, round({SUCCESS}, 6) AS success_pct,
         round(sum(n_interpolated) / sum(n_interpolated + n_extrapolated) * 100.0::DOUBLE, 6) AS interpolated_pct,
         round(sum(n_extrapolated) / sum(n_interpolated + n_extrapolated) * 100.0::DOUBLE, 6) AS extrapolated_pct
         FROM counts""",
}
