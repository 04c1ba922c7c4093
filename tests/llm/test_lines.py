from __future__ import annotations

from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm.main_content import find_foreign_lines, foreign_lines, keep_main_text, main_text
from newsloom.llm.repeated_lines import drop_repeated_lines, find_repeated_lines, normal_line
from newsloom.llm.residue import SURE, core, evidence, find_residue

PROSE = "过去三个季度里，渠道商开始把咖啡机的账期缩短到71天，但消费者更在意维修便利，而不是价格。面对库存压力，供应链负责人把订单拆成两批，第一批为94121件。"
ENGLISH = "Over three quarters, dealers in the valley cut payment terms for smart locks to 12 days, while buyers care more about repairs than price. Returns fell by 4.1%."
PAGE = f"""首页　快讯　视频　登录
我们与合作方会存储少量信息用于统计，您可以随时在设置中修改。
作者：远山

{PROSE}
背景：某某集团与5.3万元
• 供应链负责人把订单拆成两批，第一批为100件；
广告
“{PROSE[:40]}。”
{PROSE}
喜欢这篇文章的话，转给正在做选品的同事吧～
相关阅读
某某集团第3期观察：咖啡机价格变动5%
3. 从5元说起：某某如何做好咖啡机
用户a1b2：等一个后续
Copyright 2024-2025 site.example"""


def test_page():
    assert foreign_lines(PAGE) == [1, 2, 3, 8, 11, 12, 13, 14, 15, 16]
    assert main_text(PAGE).split("\n")[0] == PROSE
    english = f"Home | News | Sign in\nBy Ravel Osk\n{ENGLISH}\nWhat is missing: Acme Labs / 5 tonnes\n* Acme quoted 7 dollars less than Other Works\nADVERTISEMENT\n{ENGLISH}\nYou may also like\nAcme recalls smart locks in the valley after 5 units\n© 2025 Harbor. All rights reserved."
    assert foreign_lines(english) == [1, 2, 6, 8, 9, 10]


def test_carriage_returns_markup_and_long_lines():
    assert foreign_lines(f"广告\r\n{PROSE}\r\n") == [1]
    assert foreign_lines(f"<div>广告</div>\n<p>{PROSE}</p>") == [1]
    assert foreign_lines(PROSE * 3000) == []
    assert foreign_lines("\n \n") == [] and foreign_lines("") == []


def test_copyright_in_prose_stays():
    line = "版权所有者与绮屿沐家居就露营帐篷的外观设计在奥登堡达成和解，金额为91％，双方同意不再公开评论。 换个角度看，心理咨询师建议把车载冰箱当作提醒，而不是任务。"
    assert foreign_lines(f"{PROSE}\n{line}\n{PROSE}") == []


RESIDUE = [
    "404 - we could not find x.example/a/1.html", "502 网关错误 a.example q1\n请求编号 q1\n服务器 a.example 暂时无法响应", "您的浏览器未启用脚本，请开启后刷新 a.example/x", "Please confirm you are not a robot to reach a.example/x",
    "{{title}} {{body}} {{date}}", "<%= title %>\n来源：<%= source %>", "据${date-1}报道，${name}在${place}表示，${body}将于近期公布。", "[object Object] [object Object] (x1)", "<p>NaN</p><p class='a1'>NaN</p>", "null null null (a1)",
    "Lorem ipsum dolor sit amet consectetur adipiscing elit sed tempor incididunt labore magna aliqua", "示例文字" * 12, "xxxgf5xxxxxxxxxxxxxxxx", "啊啊啊啊啊啊啊啊vz1啦啦啦啦啦啦啦", "TBD x1", "待补充 / 待补充 / 待补充 c1", "Error: empty completion a1",
    "根据现有材料无法提炼《某某》的要点。", "第一段：……\n第二段：……\n第三段：……（m1）", "要点一：XXX；要点二：XXX；要点三：XXX（b1）", "该内容因发布者某某操作已被删除", "Your session has ended. Log in again to see \"x\"", "据 报道, 在 表示, 将于近期公布。", "1. ______\n2. ______\n3. ______ n1",
]
CONTENT = [
    PROSE, ENGLISH, "讲到邮件模板时，讲师演示了如果变量 {{name}} 没有被替换，法国的买家会怎样看待某某家居，现场有14件的人笑了。", "某某的前端同事解释，关闭JavaScript后二手相机页面仍然能显示价格，是因为节点做了预渲染，首屏快了46%。",
    "某某家居在复盘里写道，活动页上线当晚返回了404，客服用了38件才定位到失效的短链，这件事后来成为南屏团队的教学案例。", "设计师习惯用 lorem ipsum 占位，某某电商却坚持用真实的评论做排版，理由是误差只在真实文字里出现。", "The team said its landing page returned 404 for 7 tonnes after the launch, and now teaches the case to new staff.",
    "验证码让法国的老年用户放弃了4%的订单，某某实验室因此改用短信确认，并把投影仪的登录步骤减少一半。", "", "  \n ",
]


@pytest.mark.parametrize("text", RESIDUE)
def test_residue(text):
    assert evidence(core(text)) >= SURE
    around = f"首页　快讯　视频　登录\n作者：远山\n{text}\n广告\n相关阅读\n某某集团第3期观察：咖啡机价格变动5%\n© 2025 某某 版权所有"
    assert evidence(core(around)) >= SURE
    assert foreign_lines(around) == [i for i, x in enumerate(around.split("\n"), 1) if x.strip()]


@pytest.mark.parametrize("text", CONTENT)
def test_content(text):
    assert evidence(core(text)) < SURE


def test_residue_operator(spark):
    weak = "无法显示某个东西（样例文字）"
    assert evidence(core(weak)) < SURE
    data = [("articles", "1", "a", RESIDUE[0], 1), ("articles", "1", "a", RESIDUE[0], 1), ("articles", "2", None, PROSE, 1), ("articles", "3", "a", None, 1), ("records", None, "a", RESIDUE[0], 1), ("records", "4", "b", " ", 1)]
    data += [("records", f"w{i}", f"s{i % 3}", weak, 1) for i in range(9)]
    df = spark.createDataFrame(data, "origin string, row_key string, source string, text string, score int")
    got = {tuple(r) for r in find_residue(df).collect()}
    assert got == {("articles", "1"), *(("records", f"w{i}") for i in range(9))}
    assert {tuple(r) for r in find_residue(df, wide_rows=10).collect()} == {("articles", "1")}
    assert find_residue(df.limit(0)).count() == 0


def test_main_content_operator(spark):
    df = spark.createDataFrame([(1, PAGE, 5), (1, PAGE, 5), (2, None, 5), (None, PAGE, 5), (3, "", 5), (4, RESIDUE[0], 5)], "pos long, body string, line_no int")
    got = sorted(map(tuple, find_foreign_lines(df).collect()))
    assert got == sorted([(1, n) for n in foreign_lines(PAGE)] * 2 + [(4, 1)])
    kept = {r["pos"]: r["main_text"] for r in keep_main_text(df.where("pos in (2, 4)")).collect()}
    assert kept == {2: None, 4: ""}
    assert find_foreign_lines(df.limit(0)).count() == 0


def test_normal_line():
    assert normal_line("  ＡＢ c １２３ 45,6 ") == "abc0,0" and normal_line("　\t") == ""


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "t", None]), st.lists(st.sampled_from(["a", "A 1", "a2", "b", "", " ", "Ｂ", "c\r"]), max_size=5)), min_size=1, max_size=24))
def test_repeated_lines_against_loop(spark, docs):
    data = [(i, s, "\n".join(lines), 7) for i, (s, lines) in enumerate(docs)]
    data.append(data[0])  # a repeated row is the same document
    df = spark.createDataFrame(data, "pos long, source string, body string, key int")
    seen = defaultdict(set)
    for pos, s, body, _ in data:
        for line in body.split("\n"):
            if normal_line(line):
                seen[s, normal_line(line)].add(pos)
    expected = [(pos, n) for pos, s, body, _ in data for n, line in enumerate(body.split("\n"), 1) if len(seen[s, normal_line(line)]) >= 3]
    assert sorted(map(tuple, find_repeated_lines(df, least=3).collect())) == sorted(expected)


def test_repeated_lines_rebuilt(spark):
    df = spark.createDataFrame([(i, "s", f"own {chr(97 + i)}\nshared 5{i}") for i in range(8)] + [(8, "s", None), (9, "t", "shared 1")], "pos long, source string, body string")
    got = {r["pos"]: r["clean_text"] for r in drop_repeated_lines(df).collect()}
    assert got == {**{i: f"own {chr(97 + i)}" for i in range(8)}, 8: None, 9: "shared 1"}
    assert find_repeated_lines(df.limit(0)).count() == 0
