"""Schedule files cut at every place give the rows of the file read as a whole."""

from __future__ import annotations

import pytest

from headway.schemas import RAW_COLUMNS
from headway.sources.gtfs_files import scan_gtfs_file

HEADER = "﻿stop_name,stop_id, stop_lat,stop_lon"
BODIES = {
    "quoted newlines": 'Plain,1,-37.1,145.2\n"Two\nlines",2,-37.2,145.1\n"a ""quoted"" name\n\nover, four\nlines",3,1,2\n'
                       '"comma, inside",4,3,4\n\n   \n"",5,,\n"x","6","7",8\nlast,7,1,2',
    "stray quotes": '5" pipe,1,1,2\nodd "word" inside,2,1,2\n"Two\nlines, 5"" wide",3,1,2\n"sure",4,5" pipe,1\nend,5,1,2\n',
    "turning lines": '"one\n","two\n",3,4\n"\n",1,2,3\n"a,\n"",b",1,"c\n""d""\n",e\nf,1,2,3\n',
    "ragged": 'short,1\n"long\nname",2,1,2,extra,more\n,,,\n"open ""and"" shut",9\n',
    "no rows": "",
}


def rows(spark, root, multiline):
    found = scan_gtfs_file(spark, root, "stops", sources=[3], multiline=multiline)
    return sorted(map(str, found.select("stop_id", "stop_name", "stop_lat", "stop_lon").collect()))


@pytest.mark.parametrize("ending, sizes", [("\n", (1, 7, 1 << 20)), ("\r\n", (5,))])
@pytest.mark.parametrize("body", BODIES)
def test_a_file_cut_at_every_place(spark, tmp_path, body, ending, sizes):
    folder = tmp_path / "3" / "google_transit"
    folder.mkdir(parents=True)
    text = (HEADER + "\n" + BODIES[body]).replace("\n", ending).encode()
    (folder / "stops.txt").write_bytes(text)
    whole = rows(spark, str(tmp_path), True)
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        for size in sizes:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            assert rows(spark, str(tmp_path), None) == whole, size
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_part_files_of_one_table_and_a_gap_in_the_columns(spark, tmp_path):
    folder = tmp_path / "3" / "google_transit" / "stops.txt"
    folder.mkdir(parents=True)
    (folder / "part-0").write_text('stop_id,stop_name\n1,"a\nb"\n')
    (folder / "part-1").write_text('stop_id,stop_name\n2,"c')  # never closed
    found = scan_gtfs_file(spark, str(tmp_path), "stops", sources=[3])
    assert found.columns == [*RAW_COLUMNS["stops"], "source_id"]
    assert sorted((r["stop_id"], r["stop_name"], r["stop_lat"]) for r in found.collect()) == [
        ("1", "a\nb", None), ("2", "c", None)]


def test_lines_are_read_once_and_by_split(spark, tmp_path, physical):
    folder = tmp_path / "3" / "google_transit"
    folder.mkdir(parents=True)
    lines = "".join(f'"stop\n{i}",{i},1,2\n' for i in range(2000))
    (folder / "stops.txt").write_text("stop_name,stop_id,stop_lat,stop_lon\n" + lines)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        found = scan_gtfs_file(spark, str(tmp_path), "stops").select("stop_name").distinct()
        assert len(found.collect()) == 2000
        plan = found._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()
        assert plan.count("FileScan text") - plan.count("ReusedExchange") <= 1
        scan = spark.read.text(str(folder / "stops.txt"))
        assert scan.rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
