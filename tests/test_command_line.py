"""Whole jobs from files to files."""

import csv

import pytest

from rillwork.__main__ import main


@pytest.fixture
def run(spark, tmp_path):
    def go(*argv):
        out = tmp_path / "out"
        main([*map(str, argv), str(out), "--one-file"])
        (part,) = out.glob("part-*.csv")
        with part.open(newline="") as file:
            return list(csv.reader(file))

    return go


PRICES = """stockId,timeStamp,stockPrice
101,1,53.0
101,10,28.0
101,2,null
101,3,57.0
101,4,71.0
102,1,5.0
102,2,6.0
102,3,7.0
"""


def test_moving_average(run, tmp_path):
    (tmp_path / "prices.csv").write_text(PRICES)
    got = run("moving-average", tmp_path / "prices.csv")
    assert got == [
        ["stockId", "timeStamp", "stockPrice", "moving_average"],
        ["101", "4", "71.0", "60.33"],
        ["101", "10", "28.0", "52.0"],
        ["102", "3", "7.0", "6.0"],
    ]


def test_moving_average_of_one_stock_with_info(run, tmp_path):
    (tmp_path / "prices.csv").write_text(PRICES)
    (tmp_path / "info.csv").write_text("stockId,stockName,stockCategory\n101,StockA,small\n102,StockB,mid\n")
    got = run("moving-average", tmp_path / "prices.csv", "--size", 2, "--key", 102, "--info", tmp_path / "info.csv")
    assert got[1:] == [["102", "2", "6.0", "5.5", "StockB", "mid"], ["102", "3", "7.0", "6.5", "StockB", "mid"]]


def test_sessions(run, tmp_path):
    (tmp_path / "clicks.txt").write_text("2018-01-01T11:00:00Z\tu1\n2018-01-01T11:30:00Z\tu1\n2018-01-01T14:15:00Z\tu1\n")
    got = run("sessions", tmp_path / "clicks.txt")
    assert sorted(r[2] for r in got[1:]) == ["u1--1", "u1--1", "u1--2"]


def test_merge_history(run, tmp_path):
    (tmp_path / "base.csv").write_text("prodid,lastupdatedate,indicator\n00001,,A\n00002,01-25-1981,A\n")
    (tmp_path / "new.csv").write_text("prodid,lastupdatedate,indicator\n00002,01-25-2018,U\n00006,01-25-2018,A\n")
    got = run("merge-history", tmp_path / "base.csv", tmp_path / "new.csv")
    assert sorted(got[1:]) == [
        ["1", "0001-01-01", "9999-12-31", "A"],
        ["2", "1981-01-25", "2018-01-25", "I"],
        ["2", "2018-01-25", "9999-12-31", "A"],
        ["6", "2018-01-25", "9999-12-31", "A"],
    ]


def test_log_report(run, tmp_path):
    line = "t lb 1.1.1.1:1 10.0.0.1:80 0.1 0.2 0.3 200 200 0 29 GET http://{}.shop.example.com/v1 HTTP/1.1 curl/7 (x)\n"
    (tmp_path / "log").write_text(line.format("api") * 3 + line.format("www") + "broken line\n")
    got = run("log-report", tmp_path / "log")
    assert got[1:] == [["api.shop.example", "3", "75.0"], ["www.shop.example", "1", "25.0"]]


def test_registered_query(run):
    assert run("query", "order_count", "/root/testdata/sf0.001")[0] == ["n"]
