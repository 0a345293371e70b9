import datetime as dt
import io
import json
import zipfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gaugeloom.config import FOLD_COLUMNS
from gaugeloom.plans import stages
from gaugeloom.sources import catalog, dataset, delimited, station_text
from workload.queries import QUERIES

HEADERS = {
    "wind": "STATIONS_ID;MESS_DATUM;  QN;FF_10;DD_10;eor",
    "ex_temp": "STATIONS_ID;MESS_DATUM;  QN;TX_10;TX5_10;TN_10;TN5_10",
    "solar": "STATIONS_ID;MESS_DATUM;QN;DS_10;GS_10;SD_10;LS_10",
}


def lines(fold, station, first, n, spoil=()):
    out = [HEADERS[fold]]
    n_values = len(FOLD_COLUMNS[fold]) - 1 - (fold == "wind")
    for i in range(n):
        t = (first + dt.timedelta(minutes=10 * i)).strftime("%Y%m%d%H%M")
        values = [f"{'-999' if i % 7 == 3 else i % 30:>6}"] * n_values
        fields = [f"{station:>11}", t, "    3", *values, *(["eor"] if fold == "wind" else [])]
        fields = fields[:4] if ("short", i) in spoil else fields
        out.append(";".join(fields + (["x"] if ("long", i) in spoil else [])))
    return out


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Three categories, two stations, two intervals; one short row, one long row, one odd file."""
    root = tmp_path_factory.mktemp("raw")
    for fold in HEADERS:
        (root / fold).mkdir()
        for station in (44, 91):
            for first, last in ((dt.datetime(1999, 12, 31), "20000101"), (dt.datetime(2000, 1, 2), "20000103")):
                spoil = {("short", 5), ("long", 8)} if (fold, station, first.day) == ("wind", 44, 2) else ()
                name = f"produkt_{fold}_{first:%Y%m%d}_{last}_{station:05d}.txt"
                (root / fold / name).write_text("\n".join(lines(fold, station, first, 288, spoil)) + "\n", "latin-1")
    (root / "wind" / "Beschreibung.pdf").write_bytes(b"no data")
    meta = root / "meta"
    meta.mkdir()
    for station, place in ((44, "Großenkneten"), (91, "Alsfeld")):
        (meta / f"Metadaten_{station}.txt").write_text(
            "Stations_id;Stationshoehe;Geogr.Breite;Geogr.Laenge;von;Name\n"
            f"{station:>11};  10.00; 51.0000;   8.0000;19900101;{place}\n"
            f"{station:>11};  {station}.00; 52.5000;   9.2500;20000101;{place}\n",
            "latin-1",
        )
    return root


def test_scan_drops_long_rows_and_pads_short_ones(spark, raw):
    got = delimited.scan_delimited(spark, f"{raw}/wind/*.txt")
    assert got.columns == ["file_name", "STATIONS_ID", "MESS_DATUM", "QN", "FF_10", "DD_10", "eor"]
    assert got.count() == 4 * 288 - 1
    assert got.filter("eor is null").select("FF_10", "DD_10").collect() == [("5", None)]


def test_scan_decodes_latin1(spark, tmp_path):
    (tmp_path / "a.txt").write_text("STATIONS_ID;MESS_DATUM;Ort\n 1;200001010000; Köln \n\n", "latin-1")
    assert delimited.scan_delimited(spark, str(tmp_path)).first().Ort == "Köln"


def test_scan_takes_all_columns_of_mixed_headers(spark, raw):
    got = delimited.scan_delimited(spark, [f"{raw}/wind/*.txt", f"{raw}/solar/*.txt"])
    assert set(got.columns) == {"file_name", "STATIONS_ID", "MESS_DATUM", "QN", "FF_10", "DD_10", "eor", "DS_10", "GS_10", "SD_10", "LS_10"}
    counts = got.agg(F.count("FF_10").alias("wind"), F.count("LS_10").alias("sun"), F.count(F.lit(1)).alias("n")).first()
    assert (counts.wind, counts.sun, counts.n) == (4 * 288 - 1, 4 * 288, 8 * 288 - 1)
    with pytest.raises(ValueError):
        delimited.scan_delimited(spark, f"{raw}/wind/*.pdf")


def test_rejects_are_counted(spark, raw):
    counts = {r.file_path.rsplit("/", 1)[-1]: (r.n_rows, r.n_rejected) for r in delimited.count_rejects(spark, f"{raw}/wind/*.txt").collect()}
    assert counts.pop("produkt_wind_20000102_20000103_00044.txt") == (287, 1)
    assert set(counts.values()) == {(288, 0)}


@pytest.mark.parametrize("range_bytes", [1, 7, 64, 10_000])
def test_ranges_hold_every_line_once(spark, tmp_path, range_bytes):
    header = " stations_id ;MESS_DATUM;Wert"
    body = [f"{i};20000101{i:04d};{'ä' * (i % 40)}{i}" for i in range(120)]
    body[7] = ""
    body[9] += ";zu;lang"
    (tmp_path / "a.txt").write_bytes("\r\n".join([header, *body[:60], " STATIONS_ID;junk", *body[60:]]).encode("latin-1"))
    (tmp_path / "b.txt").write_bytes(b"1;200001010000;x\n\n2;200001010010")
    (tmp_path / "c.txt").write_bytes(b"")
    rows = station_text.scan(spark, str(tmp_path), ["STATIONS_ID", "MESS_DATUM", "WERT"], range_bytes=range_bytes).collect()
    own = sorted((r for r in rows if r.file_name == "a.txt"), key=lambda r: r.place)
    want = [b for i, b in enumerate(body) if i != 7]
    assert [r.rejected for r in own] == [len(b.split(";")) > 3 for b in want]
    assert [(r.STATIONS_ID, r.WERT) for r in own if not r.rejected] == [(b.split(";")[0], b.split(";")[2]) for b in want if len(b.split(";")) == 3]
    raw_bytes = (tmp_path / "a.txt").read_bytes()
    assert all(raw_bytes[r.place :].decode("latin-1").startswith(b) for r, b in zip(own, want, strict=True))
    assert sorted((r.STATIONS_ID, r.WERT, r.year) for r in rows if r.file_name == "b.txt") == [("1", "x", 2000), ("2", None, 2000)]
    assert not any(r.file_name == "c.txt" for r in rows)


def test_year_reaches_the_reader(spark, raw):
    rows = station_text.scan(spark, f"{raw}/wind/*.txt", ["STATIONS_ID", "MESS_DATUM", "FF_10"])
    for test, want in (("year = 1999", 2 * 144), ("year in (1999, 2001)", 2 * 144), ("year > 1999 and year < 2001", 6 * 144), ("year >= 2001", 0)):
        assert rows.filter(test).count() == want
    fold = delimited.read_fold(spark, f"{raw}/wind/*.txt", "wind", years=[1999])
    assert fold.count() == 2 * 144 and {r.year for r in fold.select("year").distinct().collect()} == {1999}
    reader = station_text.PushingReader({"path": json.dumps([f"{raw}/wind/*.txt"]), "columns": json.dumps(["STATIONS_ID", "MESS_DATUM"])})
    condition = station_text.ds.EqualTo(("year",), 1999)
    assert list(reader.pushFilters([condition])) == [condition]
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 2 * 144


def test_rows_rank_by_their_place_in_the_file(spark, tmp_path):
    at = "200001010000"
    (tmp_path / "x_20000101_20000102_00001.txt").write_text(f"{HEADERS['wind']}\n1;{at};3;-999;20;eor\n1;{at};1;5;30;eor\n1;{at};2;6;40;eor\n", "latin-1")
    merged = stages.merge_stage([delimited.read_fold(spark, str(tmp_path), "wind")], spark.createDataFrame([], "station_id long, latitude double, longitude double, height double, ordinal int"))
    row = merged.first()
    assert (row.QN, row.FF_10, row.DD_10) == (3.0, 5.0, 20.0)


def test_typed_fold(spark, raw):
    wind = delimited.read_fold(spark, f"{raw}/wind/*.txt", "wind")
    row = wind.filter("station_id = 44 and time = timestamp_ntz'2000-01-02 00:30:00'").first()
    assert row.FF_10 is None and row.eor is None and row.QN == 3.0 and row.year == 2000


def test_fold_reads_every_file_by_its_own_header(spark, tmp_path):
    at = "200001010000"
    files = {
        "plain": ["STATIONS_ID;MESS_DATUM;QN;DS_10;GS_10;SD_10;LS_10", f"1;{at};3;1;2;3;4"],
        "padded": ["STATIONS_ID;MESS_DATUM;   QN;DS_10; GS_10;SD_10;LS_10;eor", f"  2;{at}; 3;1;2;3;4;eor"],
        "swapped": ["STATIONS_ID;MESS_DATUM;LS_10;SD_10;GS_10;DS_10;QN", f"3;{at};4;3;2;1;3"],
        "lacking": ["STATIONS_ID;MESS_DATUM;GS_10", f"4;{at};2", f"4;{at};2;7;7;7;7"],
    }
    for name, rows in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "same.txt").write_text("\n".join(rows), "latin-1")
    got = {r.station_id: r for r in delimited.read_fold(spark, str(tmp_path), "solar").collect()}
    assert sorted(got) == [1, 2, 3, 4]
    for station in (1, 2, 3):
        assert [got[station][c] for c in ("QN", "DS_10", "GS_10", "SD_10", "LS_10")] == [3, 1, 2, 3, 4]
    assert [got[4][c] for c in ("DS_10", "GS_10", "SD_10", "LS_10")] == [None, 2, None, None]


def test_catalog_and_inventory(spark, raw):
    files = catalog.list_files(spark, [f"{raw}/wind", f"{raw}/solar"])
    assert "content" not in files._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    rows = catalog.interval_catalog(files).orderBy("folder", "start_date", "station_id").collect()
    assert len(rows) == 8 and rows[0].station_id == "00044" and rows[0].end_date == dt.datetime(2000, 1, 1)
    assert [r.file_name for r in catalog.catalog_rejects(files).collect()] == ["Beschreibung.pdf"]
    stored = {r.folder: r for r in catalog.storage_inventory(files, "folder").collect()}
    size = sum(p.stat().st_size for p in (raw / "solar").iterdir())
    assert stored["solar"].file_count == 4 and stored["solar"].storage_gb == pytest.approx(size / 1024**3)


def test_last_row_of_station_files(spark, raw):
    rows = delimited.station_files(spark, f"{raw}/meta").orderBy("station_id").collect()
    assert [(r.station_id, r.latitude, r.longitude, r.height) for r in rows] == [(44, 52.5, 9.25, 44.0), (91, 52.5, 9.25, 91.0)]


def zipped(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in members:
            z.writestr(name, content)
    return out.getvalue()


def test_station_fields_keep_digits_that_equal_their_place(spark, tmp_path):
    header, row = "Stations_id;Stationshoehe;Geogr.Breite;Geogr.Laenge", " 100;  11.01; 52.2; 13.3"
    (tmp_path / "m.txt").write_text(f"{header}\n{row}\n", "latin-1")
    got = delimited.station_files(spark, str(tmp_path)).first()
    assert (got.station_id, got.height, got.latitude, got.longitude) == (100, 11.01, 52.2, 13.3)


def test_archives(spark):
    data = [("a.zip", zipped([("m1", "x" * 10), ("m2", "yy")])), ("b.zip", zipped([("m1", "zzz")]))]
    archives = spark.createDataFrame(data, "archive string, content binary")
    everything = {(r.archive, r.member_idx, r.member): bytes(r.content) for r in catalog.expand_archives(archives, flush_bytes=5).collect()}
    assert everything == {("a.zip", 0, "m1"): b"x" * 10, ("a.zip", 1, "m2"): b"yy", ("b.zip", 0, "m1"): b"zzz"}
    first = catalog.expand_archives(archives, first_only=True).collect()
    assert [(r.archive, r.member) for r in first] == [("a.zip", "m1")]


def test_archives_are_read_where_they_lie(spark, tmp_path):
    """No batch of archives or pages becomes a table of Python objects; empty archives and folders have no members."""
    data = [(f"{i:03d}.zip", zipped([("d/", ""), (f"m{i}", "x" * i)])) for i in range(300)] + [("none.zip", zipped([]))]
    archives = spark.createDataFrame(data, "archive string, content binary").coalesce(1)
    got = catalog.expand_archives(archives, flush_bytes=1000)
    assert sorted((r.archive, r.member_idx, r.member, len(r.content)) for r in got.collect()) == [(f"{i:03d}.zip", 0, f"m{i}", i) for i in range(300)]
    pages = spark.createDataFrame([(7, "http://a/", "<p>é</p>"), (8, "", "")], "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    df = QUERIES["expand_archives"](spark, str(tmp_path))
    assert sorted((r.archive, r.member_idx, r.member, r.n_bytes) for r in df.collect()) == [
        ("7.zip", 0, "url.txt", 9), ("7.zip", 1, "page_7.html", 9), ("8.zip", 0, "url.txt", 0), ("8.zip", 1, "page_8.html", 0)
    ]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan


def test_links(spark):
    html = '<a href="x.zip">x</a><A class="c" href="y.ZIP">y</A><link href="z.zip"><a href="">e</a><a href="w.zip">w</a>'
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert [(r.position, r.link) for r in catalog.extract_links(pages).collect()] == [(0, "x.zip"), (2, "w.zip")]


def test_links_in_other_quotes_and_comments(spark):
    html = """<a class='x>y' href='a.zip'>a</a><a href=b.zip>b</a><!-- <a href="c.zip">c</a> -->
<a data-href="d.zip">d</a><a
 href = "e'e.zip">e</a><!-- open <a href=f.zip>"""
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert [r.link for r in catalog.extract_links(pages).collect()] == ["a.zip", "b.zip", "e'e.zip"]


def test_links_in_odd_tags(spark):
    html = {
        1: "<a " + " ".join(f'data-{i}="{i}"' for i in range(100_000)) + ' href="far.zip">x</a><a href="b.zip">',
        2: "<a " + "x" * 1_000_000 + " href='far.zip'>" + "y" * 1_000_000 + "<a href=b.zip>",
        3: """<a title="1 > 0" class='>' href="a.zip" href="second.zip">a</a> it's <a name="n">href="no.zip"</a>""",
        4: '<a title="open href=a.zip>x</a><a href="b.zip"',
        5: "<a " * 200_000 + 'href="b.zip">' + '"' * 100_001 + "'" * 100_001,
        6: "<!--" * 50_000 + '<a href="no.zip">',
        7: "<a href>x</a><a href=>y</a><a href= 'c.zip' >z</a><a\nHREF\t=d.zip?e=f.zip>",
        8: "",
    }
    pages = spark.createDataFrame([*html.items(), (9, None)], "page_id int, html string")
    got = {}
    for r in catalog.extract_links(pages).collect():
        got.setdefault(r.page_id, []).append(r.link)
    both = ["far.zip", "b.zip"]
    assert got == {1: both, 2: both, 3: ["a.zip"], 4: ["a.zip", "b.zip"], 5: ["b.zip"], 7: ["c.zip", "d.zip?e=f.zip"]}


def test_years_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "data")
    table = spark.createDataFrame([(2000, 1), (2001, 2), (2001, 3)], "year int, v int")
    dataset.write_years(table, path)
    dataset.write_years(spark.createDataFrame([(2001, 9)], "year int, v int"), path)
    assert sorted((r.year, r.v) for r in dataset.read_years(spark, path).collect()) == [(2000, 1), (2001, 9)]
    assert len(list((tmp_path / "data" / "year=2001").glob("*.parquet"))) == 1
    plan = dataset.read_years(spark, path).filter("year = 2000")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    empty = str(tmp_path / "empty")
    table.limit(0).write.parquet(empty)
    with pytest.raises(ValueError):
        dataset.read_years(spark, empty)


def scan_metrics(spark, df):
    """Rows that the scan of a plan gave, after it has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_a_slice_of_stations_skips_row_groups(spark, tmp_path):
    path, rows = str(tmp_path / "data"), 200_000
    table = spark.range(rows).selectExpr(
        "2001 AS year", "id * 7919 % 200 AS station_id", "timestamp_ntz'2001-01-01 00:00:00' + make_dt_interval(0, 0, 10 * (id div 200)) AS time", "rand(1) AS a", "rand(2) AS b"
    )
    dataset.write_years(table, path, row_group_bytes=1 << 18)
    groups, met = 0, 0
    for file in (tmp_path / "data" / "year=2001").glob("*.parquet"):
        about = pq.ParquetFile(file).metadata
        column = about.schema.names.index("station_id")
        for g in range(about.num_row_groups):
            known = about.row_group(g).column(column).statistics
            groups, met = groups + 1, met + (known.min <= 17 <= known.max)
    assert groups > 5 and met <= groups / 3
    part = dataset.read_years(spark, path).filter("station_id = 17")
    assert part.count() == rows // 200
    assert scan_metrics(spark, part) < rows / 3


def test_a_failed_report_leaves_the_old_one(spark, tmp_path):
    path = tmp_path / "report"
    dataset.write_report(spark.createDataFrame([(1,)], "n int"), str(path))
    dataset.write_report(spark.createDataFrame([(2,)], "n int"), str(path))
    with pytest.raises(Exception, match="no such luck"):
        dataset.write_report(spark.range(1).select(F.raise_error(F.lit("no such luck")).cast("int").alias("n")), str(path))
    assert [r.n for r in spark.read.json(str(path)).collect()] == [2]
    assert [p.name for p in tmp_path.iterdir()] == ["report"]


def test_report_is_one_json_file(spark, tmp_path):
    path = tmp_path / "report"
    dataset.write_report(spark.createDataFrame([(2000, None), (2001, 1.5)], "year int, pct double"), str(path))
    (part,) = path.glob("part-*")
    assert [json.loads(x) for x in part.read_text().splitlines()] == [{"year": 2000, "pct": None}, {"year": 2001, "pct": 1.5}]


def test_full_run_from_files(spark, raw, tmp_path):
    folds = [delimited.read_fold(spark, f"{raw}/{fold}/*.txt", fold) for fold in HEADERS]
    stations = delimited.station_files(spark, f"{raw}/meta").withColumn("ordinal", F.lit(0)).drop("file_name")
    out = stages.full_run(folds, stations, str(tmp_path / "run"))
    v1, v3, v4 = out["v1"], out["v3"], out["v4"]
    # Long rows are lost, everything else meets on (station, time).
    assert v1.count() == 2 * 2 * 288
    assert {"eor"} == set(v1.columns) - set(v3.columns)
    assert v1.groupBy("year").count().orderBy("year").collect() == [(1999, 288), (2000, 864)]
    row = v4.filter("station_id = 44 and time = timestamp_ntz'2000-01-02 00:30:00'").first()
    assert (row.FF_10, row.FF_10_method, row.height, row.QN) == (3.0, "interpolated", 44.0, 3.0)
    assert v4.count() == v1.count()
    assert v4.filter("DD_10_method = 'missing'").isEmpty() == v4.filter("DD_10 is null").isEmpty()
