"""Files on disk: listing, instruments, text of any encoding, unit lists, sinks."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fathomline.functions import text as texts
from fathomline.operators import export, stations
from fathomline.plans import jobs
from fathomline.sources import files, instruments, tables
from fathomline.storage import save_stage


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("level0")
    (root / "RBR").mkdir()
    (root / "idro_Idronaut.txt").write_text(
        "Press Temp O2ppm DateX Time\n[dbar] [C] [ppm] [d] [t]\n1.5 4.0 10 03.25.2024 10:00:00\nbad 4.1 NaN 03.25.2024 10:00:01\n")
    (root / "a.cnv").write_text("* head\n# name 0 = prdM: P\n# name 1 = c0S/m: C\n*END*\n 1.0 2.5\n 2.0 2.6\n")
    (root / "KOR_1.csv").write_bytes("\r\n".join(
        [*["pre"] * 9, "DATE (MM/DD/YYYY),TIME (HH:MM:SS),COND µS/CM,DEPTH M", "07/03/2024,08:00:00,100,1.5"]).encode("utf-16"))
    (root / "RBR" / "x_data.txt").write_text("Time,Temperature,Conductivity,Temperature,My col\n2024-07-03 08:00:00.250,1,3,2,9\n")
    (root / "RBR" / "x_metadata.json").write_text(json.dumps(
        {"dataheader": [{"name": "Conductivity", "units": "mS/cm"}, {"name": "Depth"}]}))
    (root / "A.TXT").write_text("h\nh\n1 2** 3 4 5 6 7 8 9 10 11\n")
    (root / "activity_log_ODV.csv").write_text(
        "Activity,station_ID,station_ODV,date,lat IN,lat OUT,long IN,time In\n"
        "CTD,A,4,03.07.24,,\"60°30,0'\",\"45°15,0'\",09:30\nNET,A,4,03.07.24,,\"60°30,0'\",\"45°15,0'\",09:30\n")
    (root / "suboceanexperiment_1.txt").write_text("x\n")
    return str(root)


def test_listing_and_rejects(spark, tree):
    listing = files.classify(files.file_manifest(spark, tree))
    kinds = {r.path.rsplit("/", 1)[1]: r.ctd_type for r in listing.collect()}
    assert kinds == {"idro_Idronaut.txt": "idronaut", "a.cnv": "seabird", "KOR_1.csv": "exo", "x_data.txt": "rbr",
                     "A.TXT": "gf23", "activity_log_ODV.csv": None, "suboceanexperiment_1.txt": None}
    assert {r.reason for r in files.rejected(listing).collect()} == {"subocean", "unknown instrument"}


def test_ingest_tree(spark, tree):
    scans, _ = jobs.ingest_tree(spark, tree)
    got = {}
    for r in scans.orderBy("path", "scan").collect():
        got.setdefault(r.ctd_type, []).append(r)
    idro = got["idronaut"]
    assert [r.pressure_dbar for r in idro] == [1.5, None]
    assert idro[0].oxygen_concentration_ml_per_L == pytest.approx(7.0) and idro[1].oxygen_concentration_ml_per_L is None
    assert idro[0].datetime == datetime(2024, 3, 25, 10) and idro[0].units["Press"] == "dbar"
    assert [(r.scan, r.pressure_dbar, r.conductivity_mS_per_m) for r in got["seabird"]] == [(0, 1.0, 2500.0), (1, 2.0, 2600.0)]
    exo = got["exo"][0]
    assert exo.conductivity_mS_per_m == pytest.approx(10.0) and exo.datetime == datetime(2024, 7, 3, 8)
    rbr = got["rbr"][0]
    assert (rbr.temperature_C, rbr.temperature_secondary_C, rbr.extras["My_col"]) == (1.0, 2.0, "9")
    assert rbr.timestamp == datetime(2024, 7, 3, 8, 0, 0, 250000)
    gf = got["gf23"][0]
    assert (gf.temperature_C, gf.pressure_dbar, gf.Station) == (2.0, 11.0, "A")
    assert (gf.Latitude, gf.Longitude) == (60.5, -45.25) and gf.datetime == datetime(2024, 7, 3, 9, 30)


def test_unit_lists(spark, tree):
    listing = files.file_manifest(spark, tree, (".txt", ".json"))
    data = files.classify(listing).where("ctd_type = 'rbr'").select("path")
    side = tables.sidecar_texts(files.tree_lines(spark, tree, (".txt", ".json")))
    units = tables.unit_table(data, side)
    assert units.first().units == {"Conductivity": "mS/cm"}
    lines = files.tree_lines(spark, tree).join(data, "path", "left_semi")
    assert instruments.ingest_rbr(lines, units).first().conductivity_mS_per_m == 3.0
    assert instruments.ingest_rbr(lines, units, convert=True).first().conductivity_mS_per_m == 300.0


def scan_in_ranges(spark, path, size):
    """The scan of ``files.text_scan`` with byte ranges of that size, written as a table."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    for n, value in zip(names, (str(size), "1")):
        spark.conf.set(n, value)
    try:
        return save_stage(files.text_scan(spark, path, files.any_case_glob(files.CAST_EXTENSIONS)), "ranges")
    finally:
        for n, value in zip(names, old):
            spark.conf.set(n, value)


TEXTS = {
    "a b/é+x%20#1/f 1.csv": ("utf-16-le", b"\xff\xfe", ["h1,Ċ", "av,漢", "Ā਀x", "", "ਊ"]),
    "a b/BE.CSV": ("utf-16-be", b"\xfe\xff", ["h1,Ċ", "", "av,漢", "ĀĊ਀x", "ਊ", "\U0001f600"]),
    "a b/u8.txt": ("utf-8", b"\xef\xbb\xbf", ["h1,Ċ", "av,漢", "", " ", "last"]),
    "latin.Txt": ("latin-1", b"", ["4 °C", "µS"]),
}


@pytest.mark.parametrize("size,end", [(3, "\n"), (5, "\r\n"), (10**6, "\n")])
def test_text_of_any_encoding_in_byte_ranges(spark, tmp_path, size, end):
    for name, (encoding, mark, lines) in TEXTS.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(mark + end.join(lines).encode(encoding))
    got = {}
    for r in files.numbered_lines(scan_in_ranges(spark, str(tmp_path), size)).orderBy("path", "line_no").collect():
        got.setdefault(r.path.split(f"{tmp_path}/")[1], []).append((r.line_no, r.row_no, r.line))
    want = {}
    for name, (_, _, lines) in TEXTS.items():
        full = [bool(x.strip()) for x in lines]
        want[name] = [(i, sum(full[:i]), x) for i, x in enumerate(lines)]
    assert got == want


def test_one_scan_of_the_text(spark, tmp_path, capsys):
    (tmp_path / "x.txt").write_text("a\nb\n")
    files.text_scan(spark, str(tmp_path)).explain()
    assert capsys.readouterr().out.count("FileScan text") == 1
    files.read_lines(spark, str(tmp_path)).explain()
    assert "FileScan text" not in capsys.readouterr().out


def test_quoted_cells(spark):
    lines = spark.createDataFrame([(0, 'a,"b,1",c'), (1, '"x'), (2, 'y",2'), (3, '"say ""hi""",'), (4, ",,"), (5, 'stray " quote')],
                                  "line_no long, line string").selectExpr("'p' path", "current_timestamp() modified", "line_no", "line_no row_no", "line")
    got = files.csv_records(lines).select("line_no", "row_no", files.csv_cells(F.col("line")).alias("c")).orderBy("line_no").collect()
    assert [tuple(r) for r in got] == [(0, 0, ["a", "b,1", "c"]), (1, 1, ["x\ny", "2"]), (3, 2, ['say "hi"', ""]), (4, 3, ["", "", ""]),
                                       (5, 4, ['stray " quote'])]


def test_line_numbers_over_many_blocks(spark, tmp_path):
    path = tmp_path / "big.txt"
    path.write_text("\n".join(f"line {i}" for i in range(5000)) + "\n")
    got = files.numbered_lines(scan_in_ranges(spark, str(path), 4096)).collect()
    assert sorted((r.line_no, r.line) for r in got) == [(i, f"line {i}") for i in range(5000)]


def test_logbook(spark, tmp_path):
    (tmp_path / "LogBook.csv").write_text("Station;CTD file\nA;x_1.csv\nB;\n")
    found = files.find_named(files.file_manifest(spark, str(tmp_path)), "logbook.csv").first().path
    book = tables.read_logbook(spark, found)
    assert [(r.Station, r.ctd_file, r.campaign) for r in book.orderBy("entry_no").collect()] == [
        ("A", "x_1.csv", None), ("B", None, None)]


def test_prefix_match_rules(spark):
    profiles = spark.createDataFrame([("l/cast_1_1.csv",), ("l/cast_1_2.csv",), ("l/plain.csv",)], "path string")
    book = spark.createDataFrame([(1, "cast_12_9.csv"), (2, "plain.csv"), (3, "plain2.csv"), (4, None)],
                                 "entry_no bigint, ctd_file string")
    got = {r.entry_no: r.path for r in stations.logbook_prefix(profiles, book).collect()}
    # No delimiter in the rule: base cast_1 also starts cast_12_9.csv.
    assert got == {1: "l/cast_1_1.csv", 2: "l/plain.csv"}


def test_layout_files(spark, tmp_path):
    rows = spark.createDataFrame([("p", 0, 1.0), ("p", 1, 3.0), ("p", 2, 2.0), ("q", 0, 1.0), ("q", 1, 2.0)],
                                 "cast_id string, scan bigint, pressure_dbar double").selectExpr(
        "*", "5D temperature_C", "30D salinity_psu", "90D oxygen_saturation_percent")
    out = str(tmp_path / "a2ps")
    tables.write_layout(export.a2ps_split(rows), out, direction="direction")
    names = {p.name for p in (tmp_path / "a2ps").iterdir() if p.is_dir()}
    # q has one row from its maximum on, so no upward file.
    assert names == {"file=p_downward_formatted", "file=p_upward_formatted", "file=q_downward_formatted"}
    part = next((tmp_path / "a2ps" / "file=p_upward_formatted").glob("*.asc")).read_text().splitlines()
    assert part[0].split("\t") == ["PrdE", "Tv2C", "Sal2", "Sbeox2PS"]
    assert [float(x.split("\t")[0]) for x in part[1:]] == pytest.approx([2 * 1.45038, 3 * 1.45038])


def test_layout_in_parts_counts_on(spark, tmp_path):
    rows = spark.range(5000).selectExpr("concat('p', id % 2) cast_id", "id scan", "(id * 7919) % 5000 / 10D pressure_dbar",
                                        "id * 1D temperature_C", "30D salinity_psu", "90D oxygen_saturation_percent")
    out = str(tmp_path / "a2ps")
    tables.write_layout(export.a2ps_whole(rows), out, file_bytes=8 * 1000 * 5)
    assert len(list((tmp_path / "a2ps" / "file=p0_formatted").glob("*.asc"))) > 1
    got = tables.read_layout(spark, out).select("file", "row_no", F.col("cells")["PrdE"].try_cast("double").alias("p")).collect()
    for name in ("p0_formatted", "p1_formatted"):
        mine = sorted((r.row_no, r.p) for r in got if r.file == name)
        assert [n for n, _ in mine] == list(range(2500)) and [p for _, p in mine] == sorted(p for _, p in mine)


def test_profile_sink_is_clustered(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("concat('c', id % 3) campaign", "concat('cast_', id % 500) cast_id", "id scan", "id * 0.5 x",
                                          "map('k', cast(id as string)) extras")
    out = str(tmp_path / "level2")
    tables.write_profiles(rows, out, file_bytes=8 * 5 * 2000)
    found = sorted((tmp_path / "level2").rglob("*.parquet"))
    assert {p.parent.name for p in found} == {"campaign=c0", "campaign=c1", "campaign=c2"} and 10 <= len(found) <= 13
    assert spark.read.parquet(out).count() == 20_000
    tables.write_profiles(rows.limit(10), out, form="csv")
    assert sorted(r.extras for r in spark.read.option("header", True).csv(out).collect())[0].startswith('{"k":')
    with pytest.raises(Exception):
        tables.write_profiles(rows.withColumn("x", F.raise_error(F.lit("broken"))), out)
    assert spark.read.option("header", True).csv(out).count() == 10


def test_nearest_folder(spark):
    casts = spark.createDataFrame([("t/a/b/x.TXT",), ("t/a/y.TXT",), ("t/c/z.TXT",), ("w.TXT",)], "path string")
    logs = spark.createDataFrame([("t/a",), ("t/a/b/d",), ("t",), ("t/a",)], "folder string")
    assert {r.path: r.folder for r in tables.nearest_folder(casts, logs).collect()} == {
        "t/a/b/x.TXT": "t/a", "t/a/y.TXT": "t/a", "t/c/z.TXT": "t"}


@pytest.mark.parametrize("mode", [None, "concatenate", "segment"])
def test_files_to_level2(spark, tmp_path, mode):
    for k, folder in enumerate(("one", "two")):
        (tmp_path / folder).mkdir()
        depths = [0.3] * 5 + [abs(60 - abs(i % 120 - 60)) + 0.5 for i in range(240)]
        lines = [f"{p} {8 - p / 20:.3f} {0.01 if i < 5 else 3000 + k} 30 100 07.03.2024 10:{i // 60:02}:{i % 60:02}" for i, p in enumerate(depths)]
        (tmp_path / folder / "same_Idronaut.txt").write_text("Pres Temp Cond Sal O2% Date Time\n" + "\n".join(lines) + "\n")
    done = jobs.process_tree(spark, str(tmp_path), mode=mode, level2=str(tmp_path / "out"))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert done["rejected"].count() == 0 and written.count() == done["level2"].count()
    casts = {r.campaign: r.n for r in written.groupBy("campaign").agg(F.count_distinct("cast_id").alias("n")).collect()}
    assert casts == {None: {"one": 1, "two": 1}, "concatenate": {"one": 1, "two": 1}, "segment": {"one": 2, "two": 2}}[mode]
    assert written.where("processed AND pressure_dbar > 0 AND density_kg_m3 IS NULL").count() == 0


def test_station_sink_overwrites_only_its_stations(spark, tmp_path):
    out = str(tmp_path / "level2b")
    make = lambda rows: spark.createDataFrame(rows, "campaign string, Station string, cast_id string, scan bigint")
    tables.write_stations(make([("c", "A", "x", 1), ("c", "B", "y", 1)]), out)
    tables.write_stations(make([("c", "A", "z", 2)]), out)
    got = sorted((r.Station, r.cast_id) for r in spark.read.parquet(out).collect())
    assert got == [("A", "z"), ("B", "y")]


def scattered(path, n=300):
    """Files of several folders and encodings, some with blank lines."""
    for i in range(n):
        folder = path / f"f {i % 7}" / f"é{i % 3}"
        folder.mkdir(parents=True, exist_ok=True)
        text = f"﻿a,{i}\r\n\r\nb°\n \nlast"
        data = text.encode("utf-8") if i % 4 else text.encode(("utf-16-le", "utf-16-be")[i // 4 % 2])
        (folder / (f"n{i}.TXT" if i % 2 else f"n[{i}]%20.csv")).write_bytes(data if i % 5 else data[:-1])
    (path / "f 1" / "_skipped").mkdir()
    (path / "f 1" / "_skipped" / "x.csv").write_text("x\n")
    (path / "f 1" / ".x.csv.crc").write_text("x\n")
    (path / "f 1" / "empty.csv").write_text("")
    (path / "f 1" / "latin.csv").write_bytes(b"4 \xb0C\n\x00\nok \xc2\xb0\n\n")


def test_tree_is_listed_by_tasks(spark, tmp_path):
    scattered(tmp_path)
    found = files.file_manifest(spark, str(tmp_path))
    # Spark's own readers list files on the driver; only the tables that the tasks wrote are read here.
    assert all("/listing-" in f for f in found.inputFiles())
    want = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path)).select("path", "modificationTime", "length")
    assert sorted(found.collect()) == sorted(files.with_extensions(want).collect()) and found.count() == 301
    assert files.file_manifest(spark, str(tmp_path / "f 1"), recursive=False).count() == 1
    assert files.file_manifest(spark, str(tmp_path / "f 1" / "*.csv")).count() == 1
    with pytest.raises(FileNotFoundError):
        files.file_manifest(spark, str(tmp_path / "none"))


def test_whole_files_give_the_lines_of_byte_ranges(spark, tmp_path):
    scattered(tmp_path)
    listing = files.file_manifest(spark, str(tmp_path)).withColumn("kind", F.length("path") % 3)
    want = files.numbered_lines(files.text_scan(spark, str(tmp_path), files.any_case_glob(files.CAST_EXTENSIONS)))
    want = sorted(want.select("path", "modified", "line_no", "row_no", "line").collect())
    assert len(want) > 1200
    for limit in (files.WHOLE_BYTES, 24, 0):
        got = files.file_lines(listing, ("kind",), limit)
        assert got.columns == ["path", "modified", "kind", "line_no", "row_no", "line"] and not got.where("kind <> length(path) % 3").count()
        assert sorted(got.drop("kind").collect()) == want


def test_a_line_is_not_classified_again(spark, tree):
    scans, rejected = jobs.ingest_tree(spark, tree)
    plan = rejected._jdf.queryExecution().optimizedPlan().toString()
    # What a file is, is a column of the listing: the scans that it meets carry no condition on the path's text.
    assert "idronaut" not in plan and "binaryFile" not in plan


def test_dates_of_a_layout_that_cannot_fit_are_not_tried(spark):
    found = ["2024-07-03", "2024/7/3", "07-03-2024", "7/3/2024", "07.03.2024", "13-07-2024", "13/07/2024", "13.07.2024", "24-07-03", "2024-13-03",
             "2024.07.03", "-2024-07-03", "-24-07-03", "+12024-07-03", "+2-7-3", "12024-07-03", "", "x-y/z.w", "7-3", None, " 2024-07-03 "]
    rows = spark.createDataFrame([(t,) for t in found], "t string")
    day = F.coalesce(*[F.try_to_date(F.trim("t"), layout) for layout in texts.DATE_LAYOUTS])
    both = rows.select("t", texts.instant(F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), F.lit("07:08:09"))).cast("string").alias("want"),
                       texts.clock(F.col("t"), F.lit("07:08:09")).cast("string").alias("got")).collect()
    assert [r.got for r in both] == [r.want for r in both] and sum(r.got is not None for r in both) >= 9


def test_csv_profiles_are_written_by_tasks_and_read_back(spark, tmp_path):
    rows = spark.range(4000).selectExpr("if(id % 40 = 39, null, concat('a:b ', id % 40)) profile_name", "id scan", "if(id = 5, null, id / 3D) x",
                                        "if(id % 2 = 0, 'say \"é\", x', '') note", "id % 3 = 0 is_downcast")
    out, plain = str(tmp_path / "tasks"), str(tmp_path / "spark")
    tables.write_csv_profiles(rows, out)
    rows.repartition("profile_name").write.partitionBy("profile_name").option("header", True).csv(plain)
    names = sorted(p.name for p in (tmp_path / "tasks").iterdir())
    assert names == sorted(p.name for p in (tmp_path / "spark").iterdir() if p.is_dir()) and len(names) == 40
    assert all(len(list(p.iterdir())) == 1 for p in (tmp_path / "tasks").iterdir())
    (tmp_path / "tasks" / "profile_name=the Metadata").mkdir()
    (tmp_path / "tasks" / "profile_name=the Metadata" / "p.csv").write_text("scan\n1\n")
    (tmp_path / "tasks" / "one.CSV").write_text('note,scan\n"two\nlines",1\n\n')
    columns = {"scan": "bigint", "x": "double", "note": "string", "is_downcast": "boolean"}
    got = tables.read_profiles(spark, out, columns)
    want = [tuple(r) for r in tables.read_profiles(spark, plain, columns).collect()]
    assert len(want) == 4000 and got.columns == [*columns, "profile_name"]
    assert sorted(map(str, [tuple(r) for r in got.collect()])) == sorted(map(str, [*want, (1, None, "two\nlines", None, "one")]))


def test_layout_is_read_without_the_driver_listing_its_folders(spark, tmp_path):
    for i in range(120):
        (tmp_path / f"file=p{i}").mkdir()
        (tmp_path / f"file=p{i}" / "part-00000.asc").write_text(f"a\tb\n{i}\t\n\n2\tx\n")
        (tmp_path / f"file=p{i}" / "part-00001.ASC").write_text(f"b\ta\ny\t{i}\n")
    seen = []
    read = files.text_scan
    try:
        files.text_scan = lambda *more: seen.append(more) or read(*more)
        rows = tables.read_layout(spark, str(tmp_path))
        assert not seen and not any(f.lower().endswith(".asc") for f in rows.inputFiles())
    finally:
        files.text_scan = read
    got = sorted((r.file, r.row_no, tuple(sorted(r.cells.items()))) for r in rows.collect())
    assert got == sorted((f"p{i}", n, c) for i in range(120) for n, c in enumerate(
        [(("a", str(i)), ("b", "")), (("a", "2"), ("b", "x")), (("a", str(i)), ("b", "y"))]))
