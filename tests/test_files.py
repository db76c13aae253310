"""CSV sources, landing zone and file checks on files written at test time."""

import datetime as dt
import os

from pyspark.sql import functions as F

from roadlens.fixture import raw_accidents, source_files
from roadlens.session import scratch_path
from roadlens.sources import landing
from roadlens.sources.csv import file_report, read_accident_csvs, write_csv


def test_csv_union_by_name_with_differing_columns(spark):
    root = scratch_path(spark, "csv-test")
    a = spark.createDataFrame([("A1", " lead", 3)], "Accident_Index string, Junction_Detail string, `2nd_Road_Number` int")
    b = spark.createDataFrame([("A2", "trail ")], "Accident_Index string, Junction_Detail string")
    write_csv(a, os.path.join(root, "a"))
    write_csv(b, os.path.join(root, "b"))
    df = read_accident_csvs(spark, [os.path.join(root, "a"), os.path.join(root, "b")], source_col=None)
    rows = sorted(tuple(r) for r in df.select("Accident_Index", "Junction_Detail", "2nd_Road_Number").collect())
    assert rows == [("A1", " lead", 3), ("A2", "trail ", None)]
    assert dict(df.dtypes)["2nd_Road_Number"] == "int"


def test_landing_layout_and_checks(spark, sf_small):
    raw = raw_accidents(spark, sf_small)
    root = scratch_path(spark, "landing-test")
    folders = landing.land_sources(source_files(raw), root, dt.date(2026, 4, 1))
    assert all("/year=2026/month=04/source_file=" in f for f in folders.values())
    back = landing.read_landed(spark, folders)
    assert back.count() == raw.count()
    checks = {r.source_file: r for r in landing.file_checks(spark, folders).collect()}
    assert set(checks) == set(folders)
    assert all(r.valid_utf8 for r in checks.values())
    report = {r.source_file: r for r in file_report(spark, folders).collect()}
    per_file = {r.source_file: r["count"] for r in back.groupBy("source_file").count().collect()}
    for name in folders:
        assert checks[name].rows == report[name].rows == per_file[name]
    assert report["accidents_3.csv"].columns == report["accidents_1.csv"].columns - 1
    # landing the same source again replaces it instead of adding to it
    landing.land_sources({"accidents_1.csv": source_files(raw)["accidents_1.csv"]}, root, dt.date(2026, 4, 1))
    assert landing.read_landed(spark, folders).count() == raw.count()


def test_whitespace_survives_csv_round_trip(spark, sf_small):
    raw = raw_accidents(spark, sf_small)
    root = scratch_path(spark, "ws-test")
    folders = landing.land_sources(source_files(raw), root, dt.date(2026, 4, 1))
    back = landing.read_landed(spark, folders)
    lead = back.filter(F.col("Junction_Detail").startswith(" ")).count()
    assert lead == raw.filter(F.col("Junction_Detail").startswith(" ")).count() > 0


def test_sorted_glob_with_differing_headers(spark):
    root = scratch_path(spark, "glob-test")
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, "accidents_2.csv"), "w") as f:
        f.write("Accident_Index,Speed_limit\nB1,30\n")
    with open(os.path.join(root, "accidents_1.csv"), "w") as f:
        f.write("Accident_Index,Road_Type,Speed_limit\nA1,Roundabout,20\n")
    with open(os.path.join(root, "other.csv"), "w") as f:
        f.write("x\n1\n")
    from roadlens.sources.csv import list_files

    files = list_files(spark, os.path.join(root, "accidents_*.csv"))
    assert [os.path.basename(f) for f in files] == ["accidents_1.csv", "accidents_2.csv"]
    df = read_accident_csvs(spark, [os.path.join(root, "accidents_*.csv")])
    rows = sorted((r.Accident_Index, r.Road_Type, r.Speed_limit) for r in df.collect())
    assert rows == [("A1", "Roundabout", 20), ("B1", None, 30)]


def test_dynamic_partition_overwrite(spark):
    from roadlens.sources.sinks import write_table

    root = scratch_path(spark, "dyn-test")
    df = spark.createDataFrame([(1, 2005), (2, 2006)], "v int, Year_Derived int")
    write_table(df, root, "Year_Derived")
    write_table(spark.createDataFrame([(3, 2006)], "v int, Year_Derived int"), root, "Year_Derived",
                dynamic_overwrite=True)
    got = sorted(tuple(r) for r in spark.read.parquet(root).select("v", "Year_Derived").collect())
    assert got == [(1, 2005), (3, 2006)]


def test_land_existing_csv_files(spark):
    root = scratch_path(spark, "land-csv-test")
    os.makedirs(root, exist_ok=True)
    src = os.path.join(root, "accidents_9.csv")
    with open(src, "w") as f:
        f.write("Accident_Index,Time,Junction_Detail\nA1,07:05,Roundabout \nA2,,x\n")
    folders = landing.land_csv_files(spark, [src], os.path.join(root, "zone"), dt.date(2026, 4, 1))
    back = landing.read_landed(spark, folders)
    rows = sorted((r.Accident_Index, r.Time, r.Junction_Detail, r.year, r.month, r.source_file)
                  for r in back.collect())
    assert rows == [("A1", "07:05", "Roundabout ", 2026, 4, "accidents_9.csv"),
                    ("A2", None, "x", 2026, 4, "accidents_9.csv")]


def test_keep_first_follows_file_and_line_order(spark):
    from roadlens.operators.clean import dedup_accidents

    root = scratch_path(spark, "first-test")
    os.makedirs(root, exist_ok=True)
    # the same key twice in one file (later line has the smaller value) and once in a later file
    with open(os.path.join(root, "accidents_1.csv"), "w") as f:
        f.write("Accident_Index,Speed_limit\nK1,70\nK2,30\nK1,20\n")
    with open(os.path.join(root, "accidents_2.csv"), "w") as f:
        f.write("Accident_Index,Speed_limit\nK1,10\nK3,40\n")
    raw = read_accident_csvs(spark, [os.path.join(root, "accidents_*.csv")])
    got = sorted((r.Accident_Index, r.Speed_limit) for r in dedup_accidents(raw).collect())
    assert got == [("K1", 70), ("K2", 30), ("K3", 40)]
    assert "source_row" not in dedup_accidents(raw).columns


def _files(spark, **texts):
    root = scratch_path(spark, "csv-files")
    os.makedirs(root)
    for name, text in texts.items():
        with open(os.path.join(root, f"{name}.csv"), "wb") as f:
            f.write(text if isinstance(text, bytes) else text.encode())
    return root


def test_folder_with_headers_in_different_order(spark):
    root = _files(spark, a="Accident_Index,Accident_Severity,Speed_limit\nA1,3,60\n", b="Accident_Index,Speed_limit,Accident_Severity\nB1,30,2\n")
    df = read_accident_csvs(spark, [root], source_col=None)
    assert sorted((r.Accident_Index, r.Accident_Severity, r.Speed_limit) for r in df.collect()) == [("A1", 3, 60), ("B1", 2, 30)]


def test_header_that_does_not_match_its_schema_fails(spark):
    import pytest

    root = _files(spark, a="Accident_Index,Speed_limit\nA1,3\n", b="Speed_limit,Accident_Index\n30,B1\n")
    from roadlens.sources.csv import read_csv_group

    with pytest.raises(Exception, match="(?i)header"):
        read_csv_group(spark, root, None, ["Accident_Index", "Speed_limit"]).collect()


def test_unknown_columns_are_typed_by_all_their_values(spark):
    root = _files(spark, a="Accident_Index,flow,share,road,empty\nA1,12,3,M1,\n", b="road,share,flow,Accident_Index\nA40,0.25,7,B1\n")
    df = read_accident_csvs(spark, [root], source_col=None)
    assert {c: t for c, t in df.dtypes} == {"Accident_Index": "string", "flow": "bigint", "share": "double", "road": "string", "empty": "string"}
    assert sorted((r.flow, r.share) for r in df.collect()) == [(7, 0.25), (12, 3.0)]


def test_records_that_do_not_fit_are_kept_and_counted(spark):
    from roadlens.sources.csv import CORRUPT_COL, load_report

    root = _files(spark, a="Accident_Index,Speed_limit\nA1,fast\nA2,30\n", b="Accident_Index,Speed_limit\nB1,20\n")
    rows = {r.Accident_Index: (r.Speed_limit, r[CORRUPT_COL]) for r in read_accident_csvs(spark, [root], corrupt=True).collect()}
    assert rows == {"A1": (None, "A1,fast"), "A2": (30, None), "B1": (20, None)}
    report = {os.path.basename(r.source_file): (r.records, r.corrupt, r.blank) for r in load_report(spark, [root]).collect()}
    assert report == {"a.csv": (2, 1, 0), "b.csv": (1, 0, 0)}


def test_quoted_line_breaks_are_one_record(spark):
    root = _files(spark, a='Accident_Index,Road_Type\nA1,"two\nlines"\nA2,x\n')
    df = read_accident_csvs(spark, [root], source_col=None, multi_line=True)
    assert sorted(tuple(r) for r in df.collect()) == [("A1", "two\nlines"), ("A2", "x")]
    check = landing.incoming_checks(spark, [root], multi_line=True).first()
    assert (check.lines, check.records, check.ok) == (4, 2, True)


def test_gate_lands_nothing_when_a_file_fails(spark):
    import pytest

    for bad, why in [(b"Accident_Index\nA\xff1\n", "not UTF-8"), (b"", "empty")]:
        root = _files(spark, good="Accident_Index\nA1\n", worse=bad)
        zone = os.path.join(root, "zone")
        with pytest.raises(landing.LandingRefused, match=f"worse.csv: {why}"):
            landing.land_csv_files(spark, [os.path.join(root, "*.csv")], zone, dt.date(2026, 4, 1))
        assert not os.path.exists(zone)
    checks = {os.path.basename(r.file): (r.bytes, r.lines, r.records, r.ok) for r in landing.incoming_checks(spark, [os.path.join(root, "*.csv")]).collect()}
    assert checks == {"good.csv": (18, 2, 1, True), "worse.csv": (0, 0, 0, False)}
    with pytest.raises(landing.LandingRefused):
        landing.land_csv_files(spark, [os.path.join(root, "none-*.csv")], zone, dt.date(2026, 4, 1))


def _zone(spark, root, **texts):
    folder = _files(spark, **texts)
    return landing.land_csv_files(spark, [os.path.join(folder, "*.csv")], root, dt.date(2026, 4, 1))


def _jobs(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_many_files_land_in_as_many_writes_as_headers(spark):
    few = {f"f{i}": f"Accident_Index,Speed_limit\nA{i},30\n" for i in range(3)} | {"g0": "Accident_Index\nB\n"}
    many = {f"f{i}": f"Accident_Index,Speed_limit\nA{i},30\n" for i in range(60)} | {f"g{i}": f"Accident_Index\nB{i}\n" for i in range(20)}
    roots = [scratch_path(spark, "zone") for _ in range(2)]
    jobs = [_jobs(spark, f"land-{i}", lambda: _zone(spark, roots[i], **texts)) for i, texts in enumerate([few, many])]
    assert jobs[1] <= jobs[0] + 10  # Spark lists more than 32 files in jobs of its own
    base = landing.landing_folder(roots[1], dt.date(2026, 4, 1))
    assert len([f for f in os.listdir(base) if f.startswith("source_file=")]) == 80
    got = landing.landed_report(spark, base).collect()
    assert len(got) == 80 and all(r.rows == 1 and r.lines == 2 and r.valid_utf8 for r in got)
    folders = {f"f{i}.csv": os.path.join(base, f"source_file=f{i}.csv") for i in range(60)}
    assert sorted(r.Accident_Index for r in landing.read_landed(spark, folders).collect()) == sorted(f"A{i}" for i in range(60))


def test_landing_again_replaces_files_rows_and_manifest(spark):
    root = scratch_path(spark, "zone")
    _zone(spark, root, a="Accident_Index,flow\nA1,1\nA2,2\n", b="Accident_Index,flow\nB1,x\n")
    folders = _zone(spark, root, a="Accident_Index,flow\n")  # no records: the old ones go
    base = os.path.dirname(folders["a.csv"])
    report = {r.source_file: (r.rows, r.columns) for r in landing.landed_report(spark, base).collect()}
    assert report == {"a.csv": (0, 2), "b.csv": (1, 2)}
    both = {n: os.path.join(base, f"source_file={n}") for n in ("a.csv", "b.csv")}
    assert [r.Accident_Index for r in landing.read_landed(spark, both).collect()] == ["B1"]


def test_manifest_statistics_and_types(spark):
    root = scratch_path(spark, "zone")
    folders = _zone(spark, root, a='Accident_Index,flow,share,note,none\nA1,12,3,"x, y",\n\nA2,,0.5,z,\n',
                    b="flow,Accident_Index,share\n7,B1,1e3\n", c="flow,k\n1,2\nflow,k\n3,4\n")
    base = os.path.dirname(folders["a.csv"])
    rows = {r.source_file: r for r in landing.manifest(spark, base).collect()}
    a = rows["a.csv"]
    assert (a.lines, a.records, a.files, a.valid_utf8) == (4, 2, 1, True) and a.bytes == 64
    assert {c.name: (c.non_null, c.whole, c.decimal) for c in a.columns} == {
        "Accident_Index": (2, False, False), "flow": (1, True, True), "share": (2, False, True), "note": (2, False, False), "none": (0, None, None)}
    assert rows["c.csv"].records == 3  # a header that comes again is a record, and makes its columns texts
    types = {c: t.simpleString() for c, t in landing.landed_types(spark, base).items()}
    assert types == {"flow": "string", "share": "double", "note": "string", "k": "string"}
    two = {n: f for n, f in folders.items() if n != "c.csv"}
    assert dict(landing.read_landed(spark, two, typed=True).dtypes)["share"] == "double"


def test_headers_take_bytes_that_do_not_grow_with_the_files(spark):
    from roadlens.sources.csv import FIRST_BYTES, first_lines, header_groups

    small, large = "Accident_Index,Speed_limit\nA,1\n", "Accident_Index,Speed_limit\n" + "A,1\n" * 400_000
    wide = ",".join(f"column_{i}" for i in range(12_000)) + "\n1\n"  # a header longer than one read
    root = _files(spark, a=small, b=large, c="", d=wide)
    files = [os.path.join(root, f"{n}.csv") for n in "abcd"]
    got = {os.path.basename(r.path): r for r in first_lines(spark, files).collect()}
    assert set(got) == {"a.csv", "b.csv", "d.csv"} and os.path.getsize(files[1]) > 20 * FIRST_BYTES
    assert got["a.csv"].bytes_read == len(small) and got["b.csv"].bytes_read == FIRST_BYTES
    assert got["d.csv"].header == wide.split("\n")[0]
    assert list(header_groups(spark, files[:3]).values()) == [files[:3]]  # one header: the paths as given
    assert len(header_groups(spark, files)) == 2
    from roadlens.sources import csv as source

    assert {r.header for r in source._scanned_lines(spark, files).collect()} == {r.header for r in got.values()}


def test_compressed_files_have_headers(spark):
    import gzip

    root = scratch_path(spark, "gz")
    os.makedirs(root)
    with gzip.open(os.path.join(root, "a.csv.gz"), "wt") as f:
        f.write("Accident_Index,Speed_limit\nA1,30\n")
    assert [tuple(r) for r in read_accident_csvs(spark, [root], source_col=None).collect()] == [("A1", 30)]
