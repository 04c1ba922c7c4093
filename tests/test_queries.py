from __future__ import annotations

import json
from datetime import datetime, timedelta

from newsloom.plans import article_queries, signal_queries
from newsloom.streaming.recovery import Watch, step


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_titles_of_json_cells(spark, tmp_path):
    cell = lambda link: json.dumps({"text": "somewhere", "link": link})
    records = [("1", " ", cell("https://www.a/1"), None), ("2", None, cell("https://a/9"), "B"), ("3", "T", cell("https://a/1"), "C"), ("4", "", "https://a/1", None), ("5", "", None, None), ("6", "", "{broken", None), ("7", "", cell("https://a/8"), None)]
    spark.createDataFrame(records, "record_id string, title string, url_cell string, backup_title string").write.parquet(str(tmp_path / "records.parquet"))
    spark.createDataFrame([("http://a/1", "F"), (None, "x")], "url string, title string").write.parquet(str(tmp_path / "articles.parquet"))
    got = rows(article_queries.titles_repaired(spark, str(tmp_path)))
    assert got == [("1", "F", True), ("2", "B", True), ("3", "T", False), ("4", "F", True), ("5", "", False), ("6", "", False), ("7", "", False)]
    assert rows(article_queries.migration_audit(spark, str(tmp_path))) == [("1", "title"), ("2", "title"), ("4", "title")]


def test_recovery_of_all_users(spark, tmp_path):
    start = datetime(2026, 1, 1)
    events = [(i, i * 7 % 4 + 8, start + timedelta(hours=i), "error" if i % 3 == 0 else "view") for i in range(60)]
    spark.createDataFrame(events, "event_id long, user_id long, ts timestamp, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    watches, expected = {}, []
    for i, user, ts, kind in events:
        day = (ts.replace(hour=0) - datetime(1970, 1, 1)) // timedelta(milliseconds=1)
        action = step(watches.setdefault(user, Watch()), str(user), ts, int(kind != "error"), day if kind != "error" else 0, i % 7 != 0, i % 5 != 0)
        expected.append((str(user), ts, action, watches[user].phase))
    got = signal_queries.recovery_states(spark, str(tmp_path)).select("account", "polled_at", "action", "phase")
    assert rows(got) == sorted(expected, key=str) and len(watches) == 4


def test_stale_sources_over_all_rows(spark, tmp_path):
    data = [("a", 9, 1), ("a", 10, 4), ("b", 3, 2), ("b", 12, 6), ("c", 9, 8), ("c", 10, 7), ("d", 1, 5)]
    spark.createDataFrame(data, "source string, batch_no int, pos long").write.parquet(str(tmp_path / "articles.parquet"))
    assert rows(signal_queries.stale_sources(spark, str(tmp_path))) == [("c",), ("d",)]


def test_summaries_with_invented_numbers(spark, tmp_path):
    said = "卖家在三月把运营成本下调{}，并在{}年继续调整物流与清关安排"
    data = [
        ("a", "T", datetime(2026, 3, 1, 5, 6, 7), "降幅12%", said.format("12%", 2026)), ("b", "T", datetime(2026, 3, 1, 5, 6, 7), "降幅12%", said.format("13%", 2026)),
        ("c", "T 12%", None, None, said.format("12%", 2026)), ("d", "T 12%", datetime(2026, 3, 1, 5, 6, 7, 890), "x", said.format("12%", 2026)),
    ]
    spark.createDataFrame(data, "signal_id string, title string, published_at timestamp, evidence string, summary_zh string").write.parquet(str(tmp_path / "signals.parquet"))
    assert rows(signal_queries.signal_summary_checks(spark, str(tmp_path))) == [("a", ""), ("b", "number"), ("c", "number"), ("d", "")]


def test_contents_with_invented_numbers(spark, tmp_path):
    content = lambda n: "\n".join([f"渠道商把账期缩短到{n}天" + "并且继续调整门店的维修与售后安排" * 2] * 3)
    cell = json.dumps({"text": "x", "link": "https://a/2"})
    records = [("1", "X", "https://a/1", content(12)), ("2", "X", cell, content(13)), ("3", "Y", None, content(14)), ("4", "Z", "https://a/7", content(15)), ("5", "Y", "https://a/3", content(12)), ("6", "Y", "https://a/1", None)]
    spark.createDataFrame(records, "record_id string, title string, url_cell string, content string").write.parquet(str(tmp_path / "records.parquet"))
    articles = [("https://a/1", "P", "账期12天"), ("https://a/2", "Q", "账期12天，共13家"), ("https://a/3", "R", "短"), ("https://a/3", "R", "账期缩短到12天"), ("https://a/5", "Y", "账期14天")]
    spark.createDataFrame(articles, "url string, title string, body string").write.parquet(str(tmp_path / "articles.parquet"))
    assert rows(article_queries.record_content_checks(spark, str(tmp_path))) == [("1", ""), ("2", "number"), ("3", ""), ("4", ""), ("5", "")]
