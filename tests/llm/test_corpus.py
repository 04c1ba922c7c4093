from __future__ import annotations

import random
from math import ceil, floor

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm.mixing import mix, plan_shares
from newsloom.llm.spam import find_spam, measures
from newsloom.llm.tokenize import VOCABULARIES, Encoder, encode_texts, piece_starts, read_ranks

ALPHABET = "ab Z'sdmtlvre \n\t　\xa0\x85 09²½ı中文，。!?''’ éñ́😀\x1c​_\0"


@pytest.fixture(scope="module")
def coder():
    return Encoder(read_ranks())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{VOCABULARIES}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=50), min_size=1, max_size=6))
def test_ids_against_library(coder, library, texts):
    assert coder.encode(texts) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_block_borders_and_round_trip(coder, library):
    r = random.Random(1)
    texts = ["".join(r.choice(ALPHABET) for _ in range(n)) for n in (255, 256, 257, 511, 512, 5000)] + ["a" * 3000, "中" * 2000, " " * 700, "it's we'll they've 'tis ''s <|endoftext|>", None, ""]
    got = coder.encode(texts)
    assert got == [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [coder.decode(x) for x in got] == [t or "" for t in texts]
    for t, starts in zip(texts, piece_starts([t or "" for t in texts])):
        pieces = [t[a:b] for a, b in zip(starts, [*starts[1:], len(t)])] if t else []
        assert "".join(pieces) == (t or "")


def test_encode_operator(spark, coder):
    df = spark.createDataFrame([(1, "Hello world", "x"), (1, "Hello world", "x"), (2, None, "x"), (3, "", "x"), (None, "a", "x")], "doc_id long, text string, ids string")
    got = sorted(((r["doc_id"], r["ids"]) for r in encode_texts(df).collect()), key=str)
    hello = coder.encode(["Hello world"])[0]
    assert got == sorted([(1, hello), (1, hello), (2, []), (3, []), (None, coder.encode(["a"])[0])], key=str)
    assert encode_texts(df.limit(0)).count() == 0
    assert dict(map(tuple, encode_texts(df.where("doc_id in (1, 2)").distinct(), counts_only=True).collect())) == {1: 2, 2: 0}


SIZES = "doc_id long, source string, n_tokens int, copies int"


def test_mix(spark):
    r = random.Random(4)
    data = [(i, "big" if i % 4 else "small", r.randint(1, 400), 9) for i in range(4000)] + [(9000 + i, "tiny", 10, 9) for i in range(5)] + [(9999, "other", 50, 9)]
    sizes = spark.createDataFrame(data, SIZES)
    targets = spark.createDataFrame([("big", 0.4, 1), ("small", 0.5, 3), ("tiny", 0.0001, 4), ("none", 0.0999, 2), ("small", 0.5, 3), (None, 0.1, 1), ("zero", None, 0)], "source string, target_share double, max_repeats int")
    mixture, report = mix(sizes, targets, chunk_rows=100)
    by = {x["source"]: x.asDict() for x in report.collect()}
    rows = mixture.collect()
    copies = {}
    for x in rows:
        copies[x["doc_id"]] = copies.get(x["doc_id"], 0) + 1
    plan = {x["source"]: x for x in plan_shares(sizes.drop("copies"), targets).collect()}
    for d, s, _, _ in data:
        rate = plan[s]["rate"] if s in plan else 0
        assert floor(rate) <= copies.get(d, 0) <= ceil(rate)
    tokens = {s: sum(x["n_tokens"] for x in rows if x["source"] == s) for s in by}
    whole = sum(tokens.values())
    assert set(by) == {"big", "small", "tiny", "none", "zero"} and whole == sum(x["mixed_tokens"] for x in by.values())
    assert abs(tokens["big"] / tokens["small"] - 0.8) < 0.01
    assert all(abs(by[s]["reached_share"] - tokens[s] / whole) < 1e-9 for s in by)
    assert by["none"]["state"] == "no documents" and by["big"]["state"] == by["small"]["state"] == "reached"
    assert by["small"]["most_copies"] <= 3 and len({(x["doc_id"], x["copy_no"]) for x in rows}) == len(rows)
    again, _ = mix(sizes, targets, chunk_rows=100)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_mix_that_falls_short(spark):
    sizes = spark.createDataFrame([(i, "a" if i < 10 else "b", 10, 1) for i in range(100)], SIZES)
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 2)], "source string, target_share double, max_repeats int")
    mixture, report = mix(sizes, targets, total_tokens=1000)
    by = {x["source"]: x for x in report.collect()}
    assert by["a"]["state"] == "falls short" and by["a"]["copies"] == 20 and by["b"]["mixed_tokens"] == 500
    empty, report = mix(sizes.limit(0), targets)
    assert empty.count() == 0 and {x["state"] for x in report.collect()} == {"no documents"}


PROSE = {
    "zh": "据内部会议纪要，{a}的负责人承认，咖啡机的预测偏差达到{n}%，这意味着渠道商开始把账期缩短到{n}天。换个角度看，{b}没有继续扩张，而是把售后放在首位。",
    "en": "Over {n} quarters, the head of {a} conceded that forecasts for coffee makers were off by {n} percent, while dealers in the valley cut payment terms for {b} to {n} days.",
}


def corpus():
    r = random.Random(6)
    names = ["星河", "云杉", "Acme", "Borealis", "Cedar", "暖木", "Delta", "Ember"]
    docs = [(i, " ".join(PROSE["zh" if i % 2 else "en"].format(a=r.choice(names), b=r.choice(names), n=r.randint(1, 99)) for _ in range(r.randint(2, 9)))) for i in range(400)]
    links = [f"Shop {w}: https://best{k}.site.example/{w}{k}" for k, w in enumerate("locks lamps bikes tents shirts snacks fryers bands".split() * 3)]
    spam = [
        "咖啡机 优惠 包邮 咖啡机 正品 咖啡机 优惠 " * 20, "cheap sun shirts sun shirts sale cheap buy online sun shirts " * 20, "\n".join(links), " ".join(f"#tag{k} #包邮" for k in range(60)),
        " / ".join(f"咖啡机 SKU-{k}87 220V 正品" for k in range(30)), "Looking for cheap solar lamps? Our cheap solar lamps are the best solar lamps for cheap solar lamps buyers in town. " * 15, docs[0][1][:90] + "\n" + "\n".join(links * 2),
    ]
    fine = [docs[1][1] * 4 + "\nhttps://a.example/x\nhttps://b.example/y\n#标签 #别的", "\n".join(f"{k}. 标题{k}\n{PROSE['zh'].format(a='星河', b='云杉', n=k)}\nhttps://a.example/{k}" for k in range(1, 6))]
    return docs, [(1000 + i, t) for i, t in enumerate(spam)], [(2000 + i, t) for i, t in enumerate(fine)]


def test_spam(spark):
    docs, spam, fine = corpus()
    data = [(i, t, "wrong", 1.0) for i, t in docs + spam + fine] + [(3000, None, None, 1.0), (3001, "", None, 1.0), (3002, " \n", None, 1.0), (None, spam[0][1], None, 1.0), (1000, spam[0][1], None, 1.0)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, entropy double")
    got = sorted(r[0] for r in find_spam(df).collect())
    assert got == sorted([1000, *(i for i, _ in spam)])
    assert find_spam(df.limit(0)).count() == 0


def test_measures_bounds():
    for text in ["a", "。", "123", "😀", "x" * 100_000, "the " * 50_000, "#", "https://a.example"]:
        lang, values = measures(text)
        assert lang in ("zh", "en", "de", "es", "pt") and all(-1e-9 <= v <= 1 + 1e-9 for v in values)
