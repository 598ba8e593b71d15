"""Round trips: archives, JSON drops, CSV to partitioned Parquet, page-view dumps, sinks."""

import io
import json
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from tablecraft.operators import ingest as I
from tablecraft.operators.series import mean_daily_views, read_pageviews
from tablecraft.operators.text import save_matching
from tablecraft.sources.sinks import save_small_csv
from tablecraft.operators.rankings import top_saved


def _tar(path, members):
    with tarfile.open(path, "w:gz") as tar:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


def _paper(title, countries):
    return json.dumps({"metadata": {"title": title, "authors": [
        {"first": "A", "last": "B", "affiliation": {"location": {"country": c}}} for c in countries]}}).encode()


def test_archives_to_rows_and_counts(spark, tmp_path):
    _tar(tmp_path / "day1.tar.gz", [("d/p1.json", _paper("one", ["China"])),
                                    ("d/p2.json", _paper("two", ["USA", "UK"])),
                                    ("d/readme.txt", b"not json")])
    _tar(tmp_path / "day3.tar.gz", [("d/p3.json", _paper("three", [])), ("d/bad.json", b"{oops")])
    (tmp_path / "broken.tar.gz").write_bytes(b"this is not gzip")
    rows = I.read_archives(spark, str(tmp_path / "*.tar.gz"))
    got = {(r["member"], r["error"]) for r in rows.collect()}
    assert ("d/p1.json", None) in got and ("d/bad.json", "malformed json") in got
    assert not any(m == "d/readme.txt" for m, _ in got)
    assert any(m is None and e for m, e in got)  # broken archive → one error row
    counts = {r["path"].rsplit("/", 1)[-1]: (r["members"], r["complete"])
              for r in I.archive_counts(spark, str(tmp_path / "*.tar.gz")).collect()}
    assert counts == {"day1.tar.gz": (3, True), "day3.tar.gz": (2, True), "broken.tar.gz": (0, False)}
    titles = sorted(r["title"] for r in rows.filter(F.col("error").isNull()).select("metadata.title").collect())
    assert titles == ["one", "three", "two"]
    files = I.count_files(spark, str(tmp_path / "*.tar.gz")).first()
    assert files["files"] == 3 and files["bytes"] > 0


def test_cut_archive_is_flagged_and_missing_file_fails(spark, tmp_path):
    rng = random.Random(1)
    _tar(tmp_path / "whole.tar.gz", [(f"p{i}.json", rng.randbytes(400).hex().encode()) for i in range(500)])
    data = (tmp_path / "whole.tar.gz").read_bytes()
    (tmp_path / "cut.tar.gz").write_bytes(data[:len(data) // 2])
    (tmp_path / "tail.tar.gz").write_bytes(data[:-4])
    counts = {r["path"].rsplit("/", 1)[-1]: r for r in I.archive_counts(spark, str(tmp_path / "*.tar.gz")).collect()}
    assert counts["whole.tar.gz"]["members"] == 500 and counts["whole.tar.gz"]["complete"]
    assert 0 < counts["cut.tar.gz"]["members"] < 500 and not counts["cut.tar.gz"]["complete"]
    assert not counts["tail.tar.gz"]["complete"]
    rows = I.archive_members(spark, str(tmp_path / "cut.tar.gz"))
    assert rows.filter("member IS NULL AND error IS NOT NULL").count() == 1
    gone = spark.createDataFrame([(f"{(tmp_path / 'gone.tar.gz').as_uri()}",)], "path string")
    with pytest.raises(Exception, match="gone.tar.gz"):
        gone.mapInPandas(I._count_members, schema=I.ARCHIVE_COUNT_SCHEMA).collect()


def test_merge_drops_round_trip(spark, tmp_path):
    for i, (title, cs) in enumerate([("a", ["X"]), ("b", ["Y"])]):
        d = tmp_path / f"drop{i}"
        d.mkdir()
        (d / "part.json").write_bytes(_paper(title, cs) + b"\n{}\n")
    out = str(tmp_path / "merged")
    merged = I.merge_drops(spark, [str(tmp_path / "drop0"), str(tmp_path / "drop1")], out)
    row = I.drop_counts(merged).first()
    assert (row["rows"], row["non_null"]) == (4, 2)


def test_csv_to_partitioned(spark, tmp_path):
    src = tmp_path / "m.csv"
    src.write_text("match_id,lobby_type\n1,0\n2,7\n3,7\n")
    back = I.csv_to_partitioned(spark, str(src), str(tmp_path / "out"), by="lobby_type")
    got = {r["lobby_type"]: r["count"] for r in back.groupBy("lobby_type").count().collect()}
    assert got == {0: 1, 7: 2}
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["lobby_type=0", "lobby_type=7"]


def test_pageview_dump_with_backslash_day(spark, tmp_path):
    # day 28 is written as a backslash, day 27 as '['; quotes appear in titles
    lines = ['en.z Big_Data 12 AA1B2,[C3,\\A4D2,', 'en.z "Quoted"_Page 5 AA5,', 'de.z Big_Data 9 AA9,']
    (tmp_path / "pagecounts-2020-01-views-ge-5").write_text("\n".join(lines) + "\n")
    df = read_pageviews(spark, str(tmp_path / "pagecounts-2020-??-views-ge-5"))
    assert df.count() == 3
    got = [tuple(r) for r in mean_daily_views(df, "en.z", "Big_Data").collect()]
    assert got == [(1, 3.0), (27, 3.0), (28, 6.0)]


def test_save_matching_partitions(spark, tmp_path):
    rows = [(1, "2024-01-01", "a Geek!"), (2, None, "geek"), (3, "2024-01-02", "geeky")]
    df = spark.createDataFrame(rows, "id long, created_at string, description string")
    out = str(tmp_path / "geek")
    save_matching(df, "description", "geek", out, by="created_at")
    back = spark.read.parquet(out)
    assert sorted(r["id"] for r in back.collect()) == [1, 2]


def test_small_csv_and_top_saved(spark, tmp_path):
    df = spark.createDataFrame([("x", 3), ("y", 9), ("z", 9), ("w", 1)], "country string, count long")
    out = str(tmp_path / "saved")
    save_small_csv(df, out, limit=100)
    got = [tuple(r) for r in top_saved(spark, out, "country STRING, count BIGINT", n=3).collect()]
    assert got == [("y", 9), ("z", 9), ("x", 3)]


def test_archive_tasks_follow_bytes(spark, tmp_path):
    assert I._archive_tasks(0, 0, 8) == 1
    assert I._archive_tasks(5, 100, 8) == 5  # fewer archives than cores: one each
    assert I._archive_tasks(10**8, 10**8 * 1000, 8) == -(-10**11 // I.ARCHIVE_TASK_BYTES)
    assert I._archive_tasks(1000, 1000 * (1 << 30), 8) == 1000  # none without an archive
    for i in range(40):
        _tar(tmp_path / f"a{i}.tar.gz", [("x.json", b"{}"), ("y.json", b"{}")][i % 2:])
    glob = str(tmp_path / "*.tar.gz")
    listing = I._archive_listing(spark, glob)
    assert listing.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    counts = {r["path"].rsplit("/")[-1]: r["members"] for r in I.archive_counts(spark, glob).collect()}
    assert counts == {f"a{i}.tar.gz": 2 - i % 2 for i in range(40)}


def test_plain_members_cost_few_calls_and_headers_are_the_library_s(spark, tmp_path):
    import cProfile
    import pstats

    import pandas as pd
    for name in ("p.json", "d/p.json", "x" * 100, "x" * 101, "d" * 90 + "/" + "x" * 90, "märz.json", "a b"):
        for size in (0, 1, 511, 8 ** 11 - 1, 8 ** 11):
            info = tarfile.TarInfo(name)
            info.size = size
            header = I._member_header(name, size)
            assert header == info.tobuf(tarfile.DEFAULT_FORMAT, "utf-8", "surrogateescape")
            if len(header) == tarfile.BLOCKSIZE:
                one, two = (t.frombuf(header, "utf-8", "surrogateescape") for t in (I._Header, tarfile.TarInfo))
                assert (one.name, one.size, one.type, one.mode) == (two.name, two.size, two.type, two.mode)
                with pytest.raises(tarfile.HeaderError):
                    I._Header.frombuf(header[:200] + b"!" + header[201:], "utf-8", "surrogateescape")
    many = pd.DataFrame({"archive": "a.tar.gz", "member": [f"p{i}.json" for i in range(1999)] + ["ü" * 120], "doc": "x" * 700})

    def calls(run):
        profile = cProfile.Profile()
        found = profile.runcall(run)
        return found, pstats.Stats(profile).total_calls / len(many)
    written, packing = calls(lambda: list(I._archive_writer(tmp_path.as_uri())([many])))
    assert written[0].values.tolist() == [["a.tar.gz", 2000]] and packing < 30  # 126 by the library alone
    paths = pd.DataFrame({"path": [(tmp_path / "a.tar.gz").as_uri()]})
    counted, reading = calls(lambda: list(I._count_members([paths])))
    assert counted[0].values.tolist() == [[paths["path"][0], 2000, True, None]] and reading < 60  # 109 by the library alone
    with tarfile.open(tmp_path / "a.tar.gz") as tar:
        assert [m.name for m in tar] == list(many["member"]) and tar.extractfile("p7.json").read() == b"x" * 700
