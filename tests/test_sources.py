import gzip
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalar as sc
from tickloom.sources import (
    parse_bar_envelope, price_history, read_bars_csv, read_bars_dir, read_series_csv, read_vendor_folder,
)
from tickloom.sources.landed import within


def test_csv_in_either_case_and_order(spark, tmp_path):
    (tmp_path / "AA.csv").write_text("Date,High,Low,Close,Volume,Adj\n2020-01-02,3,1,2,10,9\n")
    (tmp_path / "B B#1.csv").write_text("volume,close,low,high,date\n20,5,4,6,2020-01-03\n")
    one = read_bars_csv(spark, str(tmp_path / "AA.csv"), "AA").first()
    assert (one.symbol, one.date, one.close, one.volume) == ("AA", date(2020, 1, 2), 2.0, 10.0)
    (tmp_path / "ignored.txt").write_text("x")
    (tmp_path / "d").mkdir()
    for name in ("AA.csv", "B B#1.csv"):
        lines = "date,open,high,low,close,volume\n2020-01-02,1,3,1,2,10\n"
        (tmp_path / "d" / name).write_text(lines)
    out = read_bars_dir(spark, str(tmp_path / "d")).collect()
    assert {r.symbol for r in out} == {"AA", "B B#1"}


def test_series_skips_blank_lines(spark, tmp_path):
    (tmp_path / "g.csv").write_text("DATE,GDP\n2000-01-01,10.5\n2000-04-01,11\n\n")
    rows = read_series_csv(spark, str(tmp_path / "g.csv"), "gdp").orderBy("date").collect()
    assert [(r.date, r.gdp) for r in rows] == [(date(2000, 1, 1), 10.5), (date(2000, 4, 1), 11.0)]


def test_envelope(spark):
    good = json.dumps({"results": [{"t": 86_400_000, "o": 1, "h": 3, "l": 0.5, "c": 2, "v": 7}]})
    df = spark.createDataFrame([("A", good), ("B", "{\"status\": \"ERROR\"}")], "symbol string, body string")
    row = parse_bar_envelope(df.filter("symbol = 'A'")).first()
    assert str(row.ts.date()) == "1970-01-02" and (row.open, row.close, row.volume) == (1.0, 2.0, 7.0)
    assert parse_bar_envelope(df, on_missing="skip").count() == 1
    with pytest.raises(Exception, match="without results"):
        parse_bar_envelope(df).collect()


def test_history_keeps_empty_symbols(spark):
    df = spark.createDataFrame(
        [("A", date(2020, 1, 1), 1.0), ("A", date(2021, 1, 1), 2.0), ("B", date(2019, 1, 1), 3.0)],
        "symbol string, date date, close double",
    )
    got = {(r.symbol, r.close) for r in price_history(df, ["A", "B", "C"], date(2020, 1, 1), date(2020, 12, 31)).collect()}
    assert got == {("A", 1.0), ("B", None), ("C", None)}


def test_history_filters_at_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("A", date(2020, 1, 1), 1.0)], "symbol string, date date, close double").write.parquet(path)
    plan = within(spark.read.parquet(path), ["A"], date(2020, 1, 1), date(2020, 2, 1))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in text and "EqualTo(symbol,A)" in text or "In(symbol, [A])" in text


def test_scalars(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0, 3.0], "Čas je 3x zlato!")], "x double, a array<double>, t string")
    tokens, mask = sc.token_window(F.col("t"), 5)
    row = df.select(
        sc.clip(F.col("x"), 0.0).alias("clip"), sc.keep_where(F.col("x"), F.col("x") > 0).alias("kept"),
        sc.fit_length(F.col("a"), 5, 0.0).alias("long"), sc.fit_length(F.col("a"), 2, 0.0).alias("short"),
        sc.middle(F.col("a")).alias("mid"), tokens.alias("tokens"), mask.alias("mask"),
        sc.news_prompt(F.lit("N"), F.lit("positive")).alias("prompt"),
    ).first()
    assert row.clip is None and row.kept == 0.0
    assert (row.long, row.short, row.mid) == ([1, 2, 3, 0, 0], [1, 2], 2.0)
    assert row.tokens == ["Čas", "je", "3x", "zlato", ""] and row["mask"] == [1, 1, 1, 1, 0]
    assert row.prompt.startswith("News: N The news has sentiment: positive.")


def test_folder_of_differing_headers(spark, tmp_path):
    (tmp_path / "AA.csv").write_text("date,open,high,low,close,volume\n2020-01-02,1,3,0.5,2,10\n2020-01-03,.,3,0.5,2,10\n")
    (tmp_path / "BB.csv").write_text("Date,Close,High,Low,Open,Volume\n2020-01-02,5,6,3,4,20\n")
    (tmp_path / "CC.csv").write_text("volume,date,close\n7,2020-01-02,9\n")
    got = {(r.symbol, r.date.day): r for r in read_bars_dir(spark, str(tmp_path)).collect()}
    assert (got["AA", 2].open, got["AA", 2].close) == (1.0, 2.0) and got["AA", 3].open is None
    assert (got["BB", 2].open, got["BB", 2].close, got["BB", 2].low) == (4.0, 5.0, 3.0)
    assert (got["CC", 2].volume, got["CC", 2].close, got["CC", 2].high) == (7.0, 9.0, None)
    (tmp_path / "none").mkdir()
    assert read_bars_dir(spark, str(tmp_path / "none")).count() == 0


def envelope(*days):
    return json.dumps({"results": [{"t": d * 86_400_000, "o": 1, "h": 3, "l": 0.5, "c": d, "v": 7} for d in days]}, indent=1)


def vendor_folder(root):
    files = {
        "A/1.json": envelope(1, 2, 3), "A/2.json": envelope(4, 40), "B/1.json": envelope(1, 2)[:-20],
        "B/2.json": envelope(2), "C/1.json": '{"status": "ERROR"}', "D/1.json": envelope(90), "E/1.json": envelope(1),
        "007/1.json": envelope(2), "Z/1.json": "", "Y/1.json": '{"results": []}',
    }
    for name, text in files.items():
        path = root / f"symbol={name}"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    (root / "symbol=G").mkdir()
    (root / "symbol=G" / "1.json.gz").write_bytes(gzip.compress(envelope(*range(500)).encode())[:200])


def test_vendor_folder_survives_bad_files(spark, tmp_path):
    vendor_folder(tmp_path)
    wanted = ["A", "B", "C", "D", "G", "007", "Y", "Z", "none", "none"]
    out = read_vendor_folder(spark, str(tmp_path), wanted, date(1970, 1, 3), date(1970, 2, 15))
    assert out.columns == ["symbol", "ts", "open", "high", "low", "close", "volume", "error"]
    got = sorted((r.symbol, r.close, r.error) for r in out.collect() if r.error is None)
    assert got == [("007", 2.0, None), ("A", 2.0, None), ("A", 3.0, None), ("A", 4.0, None), ("A", 40.0, None), ("B", 2.0, None)]
    errors = sorted((r.symbol, r.error) for r in out.where("error IS NOT NULL").collect())
    assert errors == [
        ("B", "malformed"), ("C", "without results"), ("D", "no bars"), ("G", "unreadable"), ("Y", "no bars"),
        ("Z", "no bars"), ("none", "no bars"),
    ]
    everything = read_vendor_folder(spark, str(tmp_path))
    assert everything.where("error IS NULL").count() == 9
    assert {(r.symbol, r.error) for r in everything.where("error IS NOT NULL").collect()} == {
        ("B", "malformed"), ("C", "without results"), ("G", "unreadable")}


def test_vendor_lines_and_nulls(spark, tmp_path):
    (tmp_path / "symbol=A").mkdir()
    good = json.dumps({"results": [{"t": 0, "c": 1}, {"t": None, "c": 2}, {"t": 86_400_000}]})
    wrong = json.dumps({"results": [{"t": 0, "c": "x"}]})
    (tmp_path / "symbol=A" / "a.json").write_text(f"{good}\n{wrong}\n{{\n\n{good}\n")
    rows = read_vendor_folder(spark, str(tmp_path), lines=True).collect()
    assert sorted((r.close, r.error) for r in rows if r.error is None and r.close is not None) == [(1.0, None)] * 2
    assert len([r for r in rows if r.error is None]) == 4
    assert [r.error for r in rows if r.error] == ["malformed"] * 2
    (tmp_path / "symbol=G").mkdir()
    (tmp_path / "symbol=G" / "a.json.gz").write_bytes(gzip.compress(f"{good}\n".encode() * 9)[:60])
    with pytest.raises(Exception):
        read_vendor_folder(spark, str(tmp_path), lines=True).count()
