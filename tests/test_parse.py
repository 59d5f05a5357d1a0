"""Parsing, width check, and the edge rows of FIXTURES."""

import pytest
from pyspark.sql import functions as F

from linfold.sources.text import feature_width, parse_points, parse_report

EDGE = ["1999.0,0.1,0.2", "", "2000.0,abc,0.3", "2001.0,0.1", "x,0.1,0.2", "1998.0, 0.5 ,0.25"]


def test_permissive_flags_bad_rows(spark):
    lines = spark.createDataFrame([(v,) for v in EDGE], "value string")
    parsed = parse_points(lines, mode="permissive", expected_width=2)
    ok = {r.point_id: r.parse_ok for r in parsed.collect()}
    assert sum(ok.values()) == 2  # first and last line (whitespace is trimmed)
    rep = parse_report(parsed).collect()[0]
    assert (rep.n_lines, rep.n_parsed, rep.n_bad) == (6, 2, 4)
    assert rep.min_width == rep.max_width == 2


def test_permissive_without_width_keeps_ragged(spark):
    lines = spark.createDataFrame([("1.0,2.0,3.0",), ("1.0,2.0",)], "value string")
    rep = parse_report(parse_points(lines, mode="permissive")).collect()[0]
    assert rep.n_bad == 0 and rep.min_width == 1 and rep.max_width == 2
    fw = feature_width(parse_points(lines, mode="permissive")).collect()[0]
    assert not fw.consistent


def test_strict_raises_on_bad_token(spark):
    lines = spark.createDataFrame([("2000.0,abc,0.3",)], "value string")
    with pytest.raises(Exception, match="unparseable point"):
        parse_points(lines, mode="strict").collect()


def test_strict_raises_on_empty_line(spark):
    lines = spark.createDataFrame([("",)], "value string")
    with pytest.raises(Exception, match="unparseable point"):
        parse_points(lines).collect()


def test_strict_ok_and_ids_stable(spark):
    lines = spark.createDataFrame([("1.0,2.0",), ("3.0,4.0",)], "value string")
    a = sorted(r.point_id for r in parse_points(lines).collect())
    b = sorted(r.point_id for r in parse_points(lines.repartition(3)).collect())
    assert a == b


def test_text_round_trip(spark, tmp_path):
    from linfold.sources.text import points_to_lines, write_lines
    pts = spark.createDataFrame([(1, 2001.0, [0.1, 1 / 3, 2.5e-7])],
                                "point_id long, label double, features array<double>")
    path = str(tmp_path / "pts")
    write_lines(points_to_lines(pts, 3), path)
    back = parse_points(spark.read.text(path), expected_width=3).collect()[0]
    assert back.label == 2001.0 and back.features == [0.1, 1 / 3, 2.5e-7]


def test_read_lines_min_partitions(spark, tmp_path):
    from linfold.sources.text import read_lines
    p = tmp_path / "x.txt"
    p.write_text("1.0,2.0\n3.0,4.0\n")
    df = read_lines(spark, str(p), min_partitions=2)
    assert df.rdd.getNumPartitions() >= 2 and df.count() == 2
