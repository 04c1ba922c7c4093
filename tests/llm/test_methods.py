"""Whether the step that gives each operator its name decides, and that no length, prefix or list stands in for it."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from newsloom.llm import lines as L
from newsloom.llm.history import HashHistory, find_covered, find_known, keys_of, known_by_batch, paragraphs
from newsloom.llm.lines import article_lines, plain, read_body
from newsloom.llm.main_content import foreign_lines
from newsloom.llm.mixing import mix
from newsloom.llm.repeated_lines import drop_repeated_lines, find_repeated_lines
from newsloom.llm.residue import SURE, core, evidence, find_residue
from newsloom.llm.spam import find_spam, language
from newsloom.llm.tokenize import Encoder, encode_texts, read_ranks

FRENCH = """Accueil | Actualités | Contact
Nous respectons votre vie privée sur ce site.
Les distributeurs de la vallée ont réduit les délais de paiement de leurs clients à douze jours, tandis que les acheteurs se soucient davantage des réparations que du prix. Les retours ont baissé de quatre pour cent.
Le port a ouvert un nouvel entrepôt pour les lampes solaires, qui a coûté neuf millions d'euros, et la direction s'attend à une hausse des ventes dans les prochains mois de l'année.
« Nous avons choisi de réparer avant de vendre », dit la directrice de l'atelier, qui emploie désormais trente personnes dans la région et forme chaque année dix apprentis.
Toute copie sans accord écrit est interdite.
Site réalisé par notre équipe à Lyon."""


def test_windows_find_the_article_without_a_cue_for_the_language():
    assert foreign_lines(FRENCH) == [1, 2, 6, 7]
    assert foreign_lines(FRENCH, cues=False) == [1, 2, 6, 7]
    assert foreign_lines(FRENCH, windows=False) == [1]  # the notices are sentences like others


def test_subheadings_of_any_wording_stay_between_paragraphs():
    text = "这家公司把仓库搬到了港口旁边的新园区里，因为旧仓库的租金在三年里上涨了一半还多，而且道路也越来越拥挤。" * 2
    body = f"市场反应\n{text}\n市场反应\n{text}\nBackground\n{text}\n热门"
    assert foreign_lines(body) == [1, 7]


def test_markup_of_any_length_is_no_text():
    tag = f"<p class=\"{'x' * 5000}\">"
    assert plain(f"{tag}word</p><!--{'y' * 5000}-->") == "word"
    assert L.columns(plain(tag)) == 0


def test_a_long_paragraph_is_kept_and_a_long_row_of_links_is_not():
    prose = "The mill has been rebuilt twice since the flood, and its owners expect to reopen in spring. " * 20
    links = " ".join(f"#tag{k}" for k in range(400))
    assert foreign_lines(f"{prose}\n{links}\n{prose}") == [2]
    assert article_lines(read_body("")) == [False] and article_lines([]) == []


LONG_CASES = [
    "\n".join("404 - Not Found: the page /a/%d" % k for k in range(40)),
    "\n".join("404 - Not Found: the page /a/%d" % k for k in range(4)),
    "${" + "x" * 118 + "}",
    "${" + "x" * 5000 + "}",
    "{{ title }}\n" * 500,
    "Heading of the page in plain words, as such pages have it, which goes on for a good while before the filler begins\n" + "fill this space later " * 60,
    "null " * 400,
]


@pytest.mark.parametrize("text", LONG_CASES)
def test_residue_of_any_length(text):
    assert evidence(core(text)) >= SURE


def test_rules_of_signs_are_no_filler():
    assert evidence(core("-----------------------------\nThe shop on the corner has new owners, who kept the staff and the prices.\n=============================")) == 0


def test_recurrence_decides_without_a_phrase(spark):
    notice = "Our kettle shop moved next door on day {}, thanks for your patience."
    schema = "origin string, row_key string, source string, text string"
    few = [("a", f"n{i}", f"s{i % 3}", notice.format(i)) for i in range(7)]
    one_source = [("a", f"n{i}", "s", notice.format(i)) for i in range(20)]
    many = [("a", f"n{i}", f"s{i % 3}", notice.format(i)) for i in range(20)]
    prose = " ".join(f"Sentence {w} of a story that was delivered by many sources." for w in "one two three four five".split())
    story = [("a", f"p{i}", f"s{i % 5}", prose) for i in range(20)]
    assert find_residue(spark.createDataFrame(few, schema)).count() == 0
    assert find_residue(spark.createDataFrame(one_source, schema)).count() == 0
    assert find_residue(spark.createDataFrame(many, schema)).count() == 20
    assert find_residue(spark.createDataFrame(story, schema)).count() == 0


def test_vocabularies_of_one_name(spark, tmp_path):
    ranks = read_ranks()
    turned = {k: (v if len(k) == 1 else 256 + (50_255 - v)) for k, v in ranks.items() if len(k) == 1 or v < 5000}
    import base64

    folder = tmp_path / "other"
    folder.mkdir()
    (folder / "byte_bpe_50k.tiktoken").write_text("\n".join(f"{base64.b64encode(k).decode()} {v}" for k, v in turned.items()))
    df = spark.createDataFrame([(k, "hello world and more") for k in range(8)], "doc_id long, text string").coalesce(1)
    ids = lambda **more: {tuple(r["ids"]) for r in encode_texts(df, **more).collect()}
    first, other = tuple(Encoder(ranks).encode(["hello world and more"])[0]), tuple(Encoder(turned).encode(["hello world and more"])[0])
    assert first != other
    assert (ids(), ids(folder=str(folder)), ids()) == ({first}, {other}, {first})
    from newsloom.llm import tokenize

    big, tokenize.MOST_BYTES = tokenize.MOST_BYTES, 10
    try:
        with pytest.raises(ValueError):
            encode_texts(df)
    finally:
        tokenize.MOST_BYTES = big


def test_share_of_documents(spark):
    data = [(i, "s", f"own {chr(97 + i)}\nin all\n" + ("in half" if i % 2 else "")) for i in range(12)] + [(20 + i, "t", "in all") for i in range(3)]
    df = spark.createDataFrame(data, "pos long, source string, body string")
    of = lambda share: {r["line_no"] for r in find_repeated_lines(df, least=2, share=share).where("pos < 20").collect()}
    assert of(0.0) == {2, 3} and of(0.5) == {2, 3} and of(0.51) == {2}
    kept = {r["pos"]: r["clean_text"] for r in drop_repeated_lines(df, least=2, share=0.9).collect()}
    assert kept[1] == "own b\nin half" and kept[20] == ""


def test_mixture_as_large_as_its_sources(spark):
    sizes = spark.createDataFrame([(i, "scarce" if i < 4 else "rich", 10) for i in range(100)], "doc_id long, source string, n_tokens int")
    targets = spark.createDataFrame([("scarce", 0.5, 2), ("rich", 0.5, 1), ("none", 0.0, 1)], "source string, target_share double, max_repeats int")
    by = {r["source"]: r for r in mix(sizes, targets, total_tokens="listed")[1].collect()}
    assert (by["scarce"]["state"], by["scarce"]["copies"], by["rich"]["state"]) == ("falls short", 8, "reached") and 480 <= by["rich"]["mixed_tokens"] <= 520


def test_prose_in_other_languages_is_no_spam(spark):
    r = random.Random(3)
    word = lambda parts: "".join(r.choice(parts) for _ in range(r.randint(2, 4)))
    ru = lambda: " ".join(word("мель ница вес на по ку па ре монт це на лам зи ма".split()) for _ in range(9)) + "."
    fr = lambda: f"Les {word('ven deur mai son lam pe ca fe'.split())} de {word('val lée port rue'.split())} ont {word('ré duit ven du ou vert'.split())} la {word('pri x dé lai com man de'.split())} que les {word('a che teur cli ent'.split())} attendent."
    docs = [(i, " ".join((ru if i % 2 else fr)() for _ in range(8))) for i in range(60)]
    links = [(100, "\n".join(f"https://лампы{k}.example/{k}" for k in range(80)))]
    df = spark.createDataFrame(docs + links, "doc_id long, text string")
    assert {language(t) for i, t in docs if i % 2} == {"other"}
    assert sorted(x[0] for x in find_spam(df).collect()) == [100]
    assert find_spam(df, towards=1e9).count() == 0 and find_spam(df, far=1e9).count() == 0


def test_paragraph_coverage_against_loop(spark):
    r = random.Random(4)
    pool = ["Alpha  one", "ALPHA one", "beta", "Gamma２", "gamma2", "", "delta", "epsilon"]
    docs = [(i, r.choice([None, "", "\n".join(r.choice(pool) for _ in range(r.randint(1, 5)))]), 1) for i in range(80)]
    past = ["beta\nzeta", "x"]
    history = HashHistory(spark, buckets=4)
    history.append(keys_of(spark.createDataFrame(list(enumerate(past)), "pos long, body string"), "pos", None, None, None, "body"))
    got = {x["pos"]: (x["known"], x["paragraphs"], x["covered"], round(x["covered_share"], 9)) for x in find_covered(spark.createDataFrame(docs, "pos long, body string, size int"), history).collect()}
    seen, wholes, expected = {p for t in past for p in paragraphs(t)}, {tuple(paragraphs(t)) for t in past}, {}
    for i, t, _ in docs:
        parts = list(dict.fromkeys(paragraphs(t)))
        if parts:
            met = [p for p in parts if p in seen]
            expected[i] = (tuple(paragraphs(t)) in wholes, len(parts), len(met), round(sum(map(len, met)) / sum(map(len, parts)), 9))
            seen |= set(parts)
            wholes.add(tuple(paragraphs(t)))
    assert got == expected
    assert find_covered(spark.createDataFrame([], "pos long, body string"), history).count() == 0


def test_history_is_rewritten_and_taken_up_again(spark, tmp_path):
    at = str(tmp_path / "history")
    history = HashHistory(spark, at, most_appends=3)
    rows = lambda a, b: spark.createDataFrame([(i, f"https://a.example/{i % 40}", None, None) for i in range(a, b)], "pos long, url string, title string, source string")
    for k in range(5):
        find_known(rows(10 * k, 10 * k + 10), history)
    assert history.version == 2 and history.keys().count() == 40 and {p.name for p in (tmp_path / "history").iterdir()} == {f"v2-b{history.buckets}"}
    (tmp_path / "history" / "v9-b8").mkdir()  # a version that was never written to its end
    again = HashHistory(spark, at)
    assert (again.version, again.buckets) == (2, history.buckets) and find_known(rows(0, 60), again).count() == 60
    history = HashHistory(spark, at)
    history.compact(least_rows=9 * 4_000_000)
    assert history.buckets == 9 and history.keys().count() == 40


def test_batches_one_after_another(spark):
    df = spark.createDataFrame([(i, i // 5, f"https://a.example/{(i * 7) % 11}", None, None) for i in range(30)], "pos long, batch_no int, url string, title string, source string")
    whole = {x["pos"] for x in find_known(df, HashHistory(spark)).collect()}
    parts = known_by_batch(df, "batch_no", list(range(6)), HashHistory(spark)).collect()
    assert {x["pos"] for x in parts} == whole and all(x["batch"] == x["pos"] // 5 for x in parts)
    assert df.select(F.col("pos")).count() - len(whole) == 11
