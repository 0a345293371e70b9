import datetime as dt
import random
from collections import Counter, defaultdict

from gaugeloom.operators import catalog_stats, intervals


def day(n):
    return dt.datetime(2000, 1, 1) + dt.timedelta(days=n)


def catalog(spark, rows):
    data = [(f, s, day(a), day(b), i) for i, (f, s, a, b) in enumerate(rows)]
    return spark.createDataFrame(
        data, "fold string, station_id string, start_date timestamp_ntz, end_date timestamp_ntz, file_id int"
    )


def pairs_by_hand(rows):
    groups = defaultdict(list)
    for f, s, a, b in rows:
        groups[f, s].append((a, b))
    return Counter(
        (f, s, *p, *q) for (f, s), g in groups.items() for p, q in zip(sorted(g), sorted(g)[1:])
    )


def spread(df):
    out = Counter()
    for r in df.collect():
        key = [(x - day(0)).days for x in (r.prev_start, r.prev_end, r.start_date, r.end_date)]
        out[(r.fold, r.station_id, *key)] += r.n_pairs
    return out


def random_rows(seed=3):
    rng = random.Random(seed)
    # One station holds a third of the files; some intervals occur several times.
    rows = [("wind", "hot", a := rng.randrange(4000), a + rng.randrange(300)) for _ in range(120)]
    rows += [
        (f, s, a := rng.randrange(4000), a + rng.randrange(900)) for f in ("wind", "solar") for s in "abcde" for _ in range(20)
    ]
    return rows + rows[:10] + rows[:5] + [("solar", "x", 5, 5), ("solar", "x", 5, 5)]


def test_pairs_match_a_sort_per_station(spark):
    rows = random_rows()
    cat = catalog(spark, rows)
    every = pairs_by_hand(rows)
    assert spread(intervals.interval_pairs(cat)) == every
    assert spread(intervals.overlap_intervals(cat)) == Counter({k: n for k, n in every.items() if k[4] < k[3]})
    assert spread(intervals.missing_intervals(cat)) == Counter({k: n for k, n in every.items() if k[4] - k[3] > 1})


def test_resolution_splits_the_catalog(spark):
    rows = random_rows()
    cat = catalog(spark, rows)
    losers = set()
    for (f, s, a, b, c, d), _ in pairs_by_hand(rows).items():
        if c < b:
            losers.add((f, s, c, d) if d - c < b - a else (f, s, a, b))
    kept = intervals.resolve_overlaps(cat).collect()
    assert sorted(r.file_id for r in kept) == [i for i, r in enumerate(rows) if r not in losers]
    assert intervals.overlap_losers(cat).count() == len(losers)


def test_touching_and_one_day_holes_are_fine(spark):
    cat = catalog(spark, [("wind", "a", 0, 10), ("wind", "a", 10, 20), ("wind", "a", 21, 30), ("wind", "a", 32, 40)])
    assert intervals.overlap_intervals(cat).isEmpty()
    assert [r.diff_seconds for r in intervals.missing_intervals(cat).collect()] == [2 * 86400]


def test_hole_is_filled_up_to_the_next_start(spark):
    cat = catalog(spark, [("wind", "a", 0, 10), ("wind", "a", 13, 20)])
    full = intervals.fill_missing_intervals(cat, ["FF_10"]).orderBy("time").collect()
    assert len(full) == 2 * 144 and full[0].time == day(11) and full[-1].time == day(13) - dt.timedelta(minutes=10)
    assert all(r.FF_10 is None for r in full)
    assert intervals.fill_missing_intervals(cat, parity_end=True).count() == 144


def test_long_hole_has_every_step(spark):
    cat = catalog(spark, [("wind", "a", 0, 1), ("wind", "a", 400, 401)])
    rows = intervals.fill_missing_intervals(cat)
    assert rows.count() == rows.distinct().count() == (400 - 2) * 144


def file_rows(spark, minutes):
    data = [("f", i, day(0) + dt.timedelta(minutes=m)) for i, m in enumerate(minutes)]
    return spark.createDataFrame(data, "file_id string, pos int, time timestamp_ntz")


def test_alignment_metrics(spark):
    minutes = [m for m in range(20, 2880, 10) if m not in (500, 510)]
    announced = spark.createDataFrame(
        [("wind", "a", "f", day(0), day(1))],
        "fold string, station_id string, file_id string, start_date timestamp_ntz, end_date timestamp_ntz",
    )
    for order in (None, "pos"):
        (row,) = intervals.alignment_check(file_rows(spark, minutes), announced, order=order).collect()
        assert (row.start_ok, row.end_ok, row.date_range_ok, row.n_irregular) == (False, True, True, 1)
        assert (row.missing_start, row.missing_end, row.missing_intermediate) == (20.0, 0.0, 30.0)
        assert row.expected_length_minutes == 2870.0 and row.length_minutes == 2850.0 - 30.0
        assert row.wrong_minutes == 50.0
    whole = file_rows(spark, range(0, 2880, 10))
    assert intervals.alignment_check(whole, announced).isEmpty()


def test_deltas_that_cancel_are_still_flagged(spark):
    minutes = [*range(0, 2880, 10)]
    minutes[100], minutes[101] = minutes[101], minutes[100]
    announced = spark.createDataFrame(
        [("wind", "a", "f", day(0), day(1))],
        "fold string, station_id string, file_id string, start_date timestamp_ntz, end_date timestamp_ntz",
    )
    (row,) = intervals.alignment_check(file_rows(spark, minutes), announced, order="pos").collect()
    assert row.n_irregular == 3


def test_duration_histogram_keeps_long_stations(spark):
    cat = catalog(spark, [("a", "1", 0, 800), ("a", "2", 0, 400), ("b", "1", 0, 800), ("b", "9", 0, 14000)])
    stack = {(r.fold, r.years): (r.n_stations, r.base) for r in catalog_stats.duration_stack(
        catalog_stats.station_durations(cat)).collect()}
    assert stack["a", 2] == (1, 0) and stack["b", 2] == (1, 1) and stack["a", 1] == (1, 0) and stack["b", 1] == (0, 1)
    assert stack["b", 38] == (1, 0) and len(stack) == 2 * 39


def test_shares_cover_folds_without_hits(spark):
    cat = catalog(spark, [("a", "1", 0, 10), ("a", "1", 5, 20), ("b", "1", 0, 10)])
    rows = {r.fold: r for r in catalog_stats.overlap_pct(intervals.overlap_intervals(cat), cat).collect()}
    assert rows["a"].stations_per_file_pct == 50.0 and rows["a"].overlap_time_pct == 25.0
    assert rows["b"].stations_per_file_pct == 0.0 and rows["b"].overlap_time_pct == 0.0
