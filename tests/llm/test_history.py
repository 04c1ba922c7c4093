from __future__ import annotations

import random

import pytest

from newsloom.llm.history import HashHistory, address_key, document_keys, find_known, keys_of, title_halves

SAME_ADDRESS = [
    "https://site.example/a/b?aid=5", "http://WWW.Site.example//a/b/?x=1&aid=5#top", " HTTPS://site.example/a//b?aid=5&utm=1 ", '{"text": "t", "link": "https://www.site.example/a/b/?aid=5"}', "//site.example/a/b?aid=5",
]
SAME_TITLES = [
    ["空气炸锅出口波兰增长8.4%，某某扩产", "快讯｜空气炸锅外销波兰上涨８.４％，某某已加产", "某某扩产，空气炸锅出口波兰增长8.4%", "【深度】空气炸锅出口波兰增长8.4%，某某率先扩产 - 灯塔周报", "《空气炸锅出口波兰增长8.4%，某某扩产》"],
    ["某某联手他他，共同切入波兰市场，斥资5万元", "某某联手他他进军波兰市场，投入5万元", "斥资5万元，某某联手他他布局波兰市场"],
    ["Why sun shirts stall in France: Acme points to 5.3 points", "Acme points to 5.3 points; Here is why sun shirts slow down in France", "BREAKING: WHY SUN SHIRTS STALL IN FRANCE: ACME POINTS TO 5.3 POINTS!"],
    ["Acme launches earbuds in Chile with 5 units", "Acme quietly rolls out earbuds in Chile with 5 units", "Acme unveils earbuds in Chile with 5 units_灯塔周报"],
]
OTHER_TITLES = ["空气炸锅出口波兰增长8.5%，某某扩产", "空气炸锅出口德国增长8.4%，某某扩产", "空气炸锅出口波兰增长8.4%，他他扩产", "植物奶出口波兰增长8.4%，某某扩产", "空气炸锅出口波兰增长84%，某某扩产", "某某第1期观察：波兰价格变动1%", "某某第2期观察：波兰价格变动1%"]


def test_addresses():
    assert len({address_key(u) for u in SAME_ADDRESS}) == 1
    assert address_key("https://site.example/a/b?aid=6") != address_key(SAME_ADDRESS[0]) and address_key("https://site.example/A/b?aid=5") != address_key(SAME_ADDRESS[0])
    assert [address_key(x) for x in (None, "", "  ", "{}", '{"link": ""}')] == [None] * 5


@pytest.mark.parametrize("titles", SAME_TITLES)
def test_same_titles(titles):
    assert len({tuple(title_halves(t, "灯塔周报")) for t in titles}) == 1


def test_other_titles():
    keys = [tuple(title_halves(t, "灯塔周报")) for t in [SAME_TITLES[0][0], *OTHER_TITLES]]
    assert len(set(keys)) == len(keys)
    assert title_halves(None) == title_halves(" ") == title_halves("！？") == []


def loop(history, batch):
    """Rows whose address or title is in the history or comes before in the batch."""
    out, seen = set(), {k for h in history for k in document_keys(*h)}
    for seq, *row in sorted(batch):
        keys = document_keys(*row)
        if any(k in seen for k in keys):
            out.add(seq)
        seen |= set(keys)
    return out


def test_batches_against_loop(spark):
    r = random.Random(5)

    def row():
        group = r.choice(SAME_TITLES)
        return (r.choice([f"https://site.example/{r.randint(0, 30)}", "http://www.site.example/hot/", None, ""]), r.choice([r.choice(group), f"单独的标题{r.randint(0, 60)}", None, " "]), r.choice(["灯塔周报", None]))

    past = [row() for _ in range(6)]
    rows = [(i, *row()) for i in range(150)]
    schema = "pos long, url string, title string, source string, key int"
    history = HashHistory(spark, buckets=4)
    history.append(keys_of(spark.createDataFrame([(i, *p, 1) for i, p in enumerate(past)], schema), "pos", "url", "title", "source"))
    expected = loop(past, rows)
    one = HashHistory(spark, buckets=4)
    one.append(history.keys())
    whole = {x["pos"] for x in find_known(spark.createDataFrame([(*x, 1) for x in rows], schema), one).collect()}
    assert whole == expected
    parts = set()
    for k in range(3):
        batch = spark.createDataFrame([(*x, 1) for x in rows[k * 50 : k * 50 + 50]], schema)
        parts |= {x["pos"] for x in find_known(batch, history).collect()}
    assert parts == expected
    again = HashHistory(spark, history.path, buckets=4)
    assert again.keys().distinct().count() == one.keys().distinct().count()


def test_edges(spark):
    schema = "pos long, url string, title string, source string"
    df = spark.createDataFrame([(1, None, None, None), (2, "", " ", "s"), (3, "https://a.example/x", None, None), (3, "https://a.example/x", None, None), (4, "https://a.example/x", "t" * 100_000, None), (None, "https://a.example/x", None, None)], schema)
    assert [r[0] for r in find_known(df, HashHistory(spark, buckets=2)).collect()] == [4]
    assert find_known(df.limit(0), HashHistory(spark, buckets=2)).count() == 0


def test_history_side_is_not_shuffled(spark):
    history = HashHistory(spark, buckets=4)
    df = spark.createDataFrame([(1, "https://a.example/x", "t", None)], "pos long, url string, title string, source string")
    keys = keys_of(df, "pos", "url", "title", "source")
    history.append(keys)
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        firsts = keys.groupBy("key").agg(F.min("seq").alias("seq")).repartition(4, "key")
        plan = firsts.join(history.keys(), "key", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    side = plan[plan.index("Bucketed: true") - 900 :]
    assert "Exchange hashpartitioning(key" not in side.split("FileScan")[0].rsplit("+- ", 1)[-1]
