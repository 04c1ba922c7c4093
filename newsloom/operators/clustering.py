"""Articles about the same event: groups around leaders, with increments and repetitions told apart."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from difflib import SequenceMatcher
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.text import normalize_title
from newsloom.session import stored, unsent

TITLE_LEAST, EVENT_LEAST, POINT_LEAST = 0.90, 0.84, 0.80
MAIN, INCREMENT, REPETITION = "main", "increment", "repetition"


def ratio(left: str, right: str) -> float:
    """Likeness of two normal texts; 1.0 for two empty ones. It depends on which comes first."""
    return SequenceMatcher(None, left, right).ratio()


def _reaches(left: str, right: str, least: float) -> bool:
    both = len(left) + len(right)
    if not both:
        return True
    if 2 * min(len(left), len(right)) < least * both:
        return False
    m = SequenceMatcher(None, left, right)
    return m.quick_ratio() >= least and m.ratio() >= least


def _pair_test(least: float):
    @F.pandas_udf(T.BooleanType())
    def test(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([_reaches(a, b, least) for a, b in zip(left, right)])

    return test


#: Slots of the table of sign frequencies, which only orders signs: a fixed size, whatever the texts.
SLOTS = 1 << 16
#: Length from which texts are compared by pairs of characters rather than single ones.
LONG = 8


def _numbered(elements: list[str], kind: str) -> list[str]:
    """The elements of a text, each with its number among equal ones."""
    seen: dict[str, int] = {}
    out = []
    for e in elements:
        seen[e] = seen.get(e, 0) + 1
        out.append(f"{kind}{e}{seen[e]}")
    return out


def _slot(sign: str) -> int:
    return zlib.crc32(sign.encode("utf-8", "replace")) % SLOTS


def signs_of(text: str, least: float, frequencies: np.ndarray) -> list[str]:
    """Signs of which two texts of that likeness must share one, the rarest of a text.

    A likeness of r matches at least r / (2 - r) of either text's characters, so of single characters a text may
    leave out all but that share. The matched characters lie in as many blocks as there are unmatched ones, and
    one, at most; so of n characters at least 2n(1.5r - 1) / (2 - r) - 1 pairs are common. Pairs are used when both
    texts are ``LONG``; a text that may meet shorter ones has signs of both kinds.
    """
    n, share = len(text), least / (2 - least)
    out: list[str] = []
    for kind, wanted, elements, common in (
        ("1", n * share < LONG, list(text), ceil(n * share - 1e-9)),
        ("2", n >= LONG, [text[k : k + 2] for k in range(n - 1)], max(1, ceil(2 * n * (1.5 * least - 1) / (2 - least) - 1 - 1e-9))),
    ):
        if wanted:
            signs = sorted(_numbered(elements, kind), key=lambda s: (frequencies[_slot(s)], s))
            out += signs[: max(0, len(signs) - common + 1)]
    return out


def _frequencies(values: DataFrame) -> np.ndarray:
    """How many signs of all texts fall into each of ``SLOTS`` slots: counted where the texts lie, summed up by slot."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SLOTS, np.int64)
        for f in frames:
            for t in f["text"]:
                for s in {*_numbered(list(t), "1"), *_numbered([t[k : k + 2] for k in range(len(t) - 1)], "2")}:
                    total[_slot(s)] += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"slot": at.astype("int32"), "n": total[at]})

    counts = np.zeros(SLOTS, np.int64)
    for r in values.select("text").mapInPandas(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():  # at most SLOTS rows
        counts[r["slot"]] = r["n"]
    return counts


def _with_signs(values: DataFrame, least: float, frequencies: np.ndarray) -> DataFrame:
    """(block, text, sign) of each text and each of its signs."""

    @F.pandas_udf("array<string>")
    def signs(texts: pd.Series) -> pd.Series:
        return pd.Series([signs_of(t, least, frequencies) for t in texts])

    return values.select("block", "text", F.explode(signs(F.col("text"))).alias("sign"))


def similar_values(values: DataFrame, least: float, parts: int = 8) -> DataFrame:
    """(block, later, earlier) of the distinct texts of one block that are alike: likeness of ``later`` to ``earlier``,
    which depends on the order; each pair is tested both ways.

    ``values`` has block and text, distinct and not blank. Pairs are found through shared rare signs, which loses
    none, and tested in batches. Signs that many texts share are split into ``parts`` on one side, and neither side is
    broadcast. Texts that are equal are one value, so only different texts that are alike are paired.
    """
    values = stored(values, "values")
    signs = stored(_with_signs(values, least, _frequencies(values)), "signs")
    salt = F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int")
    a = signs.select("block", "sign", F.col("text").alias("later"), salt.alias("part"))
    b = signs.select("block", "sign", F.col("text").alias("earlier"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    size = F.length("later") + F.length("earlier")
    near = a.join(unsent(b), ["block", "sign", "part"]).where((F.col("later") != F.col("earlier")) & (2 * F.least(F.length("later"), F.length("earlier")) >= least * size))
    near = near.select("block", "later", "earlier").distinct()
    return near.where(_pair_test(least)(F.col("later"), F.col("earlier")))


def _salted(rows: DataFrame, small: DataFrame, keys: list[str], salts: int = 16) -> DataFrame:
    """Left join with a table of one row a key, each of its rows spread over ``salts`` parts; it is not broadcast."""
    left = rows.withColumn("__nl_salt", F.pmod(F.xxhash64("rank"), F.lit(salts)).cast("int"))
    right = small.withColumn("__nl_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(unsent(right), [*keys, "__nl_salt"], "left").drop("__nl_salt")


def _nearest(ranks: DataFrame, edges: DataFrame) -> DataFrame:
    """(day, kind, text, first): of the rows of a text and of the texts that it is like, the first rank."""
    own = ranks.groupBy("day", "kind", "text").agg(F.min("rank").alias("first"))
    of_others = edges.join(unsent(own.withColumnRenamed("text", "earlier")), ["day", "kind", "earlier"]).select("day", "kind", F.col("later").alias("text"), "first")
    return own.unionByName(of_others).groupBy("day", "kind", "text").agg(F.min("first").alias("first"))


def cluster_events(articles: DataFrame, day: str = "daily_date", id_col: str = "pos", most_rounds: int = 60) -> DataFrame:
    """(id, day, leader, status) of each article of a day.

    Articles are taken by quality (total score, information gain, evidence density, number of facts, all
    descending, then id). One joins the first group whose leader it is like in title (0.90) or event key (0.84
    or equal, neither blank), else it leads a group (main). In a group it is an increment if its information
    gain is 4 or more, its evidence density 3 or more and one of its points is less than 0.80 like every
    point of the group so far; else a repetition.

    Needs title, ai_result and the two columns named; rows with a null day or id are left out, other nulls
    count as empty or 0, repeated ids are not allowed; extra columns are ignored. Blank titles are alike.

    Only different texts of a day are compared (``similar_values``); articles are never paired. Who leads is settled
    in rounds over all days at once, by the first rank under each text: an open article leads once no earlier one
    under its texts, or texts like them, is open and none leads. Joins with texts are salted, so a day, a title or an
    event key may have any number of articles.
    """
    score = lambda p: F.coalesce(F.col(p).cast("int"), F.lit(0))
    own = articles.where(F.col(day).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(day).alias("day"), F.col(id_col).cast("long").alias("id"),
        F.coalesce(normalize_title(F.col("title")), F.lit("")).alias("title"),
        F.coalesce(normalize_title(F.col("ai_result.event_key")), F.lit("")).alias("event"),
        F.struct((-score("ai_result.score_total")).alias("a"), (-score("ai_result.scores.information_gain")).alias("b"), (-score("ai_result.scores.evidence_density")).alias("c"), (-F.greatest(F.coalesce(F.size("ai_result.core_facts"), F.lit(0)), F.lit(0))).alias("d"), F.col(id_col).cast("long").alias("id")).alias("rank"),
        F.transform(F.coalesce("ai_result.unique_points", F.array().cast("array<string>")), lambda p: F.coalesce(normalize_title(p), F.lit(""))).alias("points"),
    )
    own = stored(own, "articles")
    # each article under its texts: its title, and its event key if there is one
    cells = F.array(F.struct(F.lit("t").alias("kind"), F.col("title").alias("text")), F.struct(F.lit("e").alias("kind"), F.col("event").alias("text")))
    links = stored(own.select("day", "rank", F.inline(cells)).where("kind = 't' or text <> ''"), "links")
    texts = links.where("text <> ''").select("day", "kind", "text").distinct()
    edges = None
    for kind, least in (("t", TITLE_LEAST), ("e", EVENT_LEAST)):
        found = similar_values(texts.where(F.col("kind") == kind).select(F.col("day").alias("block"), "text"), least)
        found = found.select(F.col("block").alias("day"), F.lit(kind).alias("kind"), "later", "earlier")
        edges = found if edges is None else edges.unionByName(found)
    edges = stored(edges, "edges")
    open_, leaders = links, None
    for _ in range(most_rounds):
        if open_.isEmpty():
            break
        met = _salted(open_, _nearest(open_, edges), ["day", "kind", "text"])
        fresh = stored(met.groupBy("day", "rank").agg(F.bool_and(F.col("first") >= F.col("rank")).alias("leads")).where("leads").select("day", "rank"), "leaders")
        fresh = stored(open_.join(unsent(fresh), ["day", "rank"], "left_semi"), "leading")
        leaders = fresh if leaders is None else leaders.unionByName(fresh)
        met = _salted(open_, _nearest(fresh, edges), ["day", "kind", "text"])
        gone = met.groupBy("day", "rank").agg(F.bool_or(F.coalesce(F.col("first") <= F.col("rank"), F.lit(False))).alias("gone")).where("gone").select("day", "rank")
        open_ = stored(open_.join(unsent(gone), ["day", "rank"], "left_anti"), "open")
    else:
        raise RuntimeError(f"leaders are still open after {most_rounds} rounds")
    leaders = links.limit(0) if leaders is None else leaders
    met = _salted(links, _nearest(leaders, edges), ["day", "kind", "text"])
    led = met.groupBy("day", "rank").agg(F.min("first").alias("leader"))
    members = stored(own.join(unsent(led), ["day", "rank"]).select("day", "id", "rank", "leader", "points"), "members")
    out = members.join(unsent(_fresh_points(members)), "id", "left")
    status = F.when(F.col("rank") == F.col("leader"), MAIN).when(F.col("fresh"), INCREMENT).otherwise(REPETITION)
    return out.select(F.col("id").alias(id_col), F.col("day").alias(day), F.col("leader.id").alias("leader"), status.alias("status"))


def _fresh_points(members: DataFrame) -> DataFrame:
    """(id, fresh): articles that may be an increment and have a point unlike all that the group had before.

    Points of a group are compared as different texts, each known since the first article that has it, or one
    like it; blank points are alike.
    """
    points = stored(members.select(F.col("leader.id").alias("block"), "id", "rank", "leader", F.posexplode("points").alias("k", "text")), "points")
    had = points.groupBy("block", "text").agg(F.min("rank").alias("since"))
    alike = similar_values(points.where("text <> ''").select("block", "text").distinct(), POINT_LEAST)
    of_others = alike.join(unsent(had.withColumnRenamed("text", "earlier")), ["block", "earlier"]).select("block", F.col("later").alias("text"), "since")
    since = had.unionByName(of_others).groupBy("block", "text").agg(F.min("since").alias("since"))
    asked = points.where("-rank.b >= 4 and -rank.c >= 3 and rank <> leader")
    met = _salted(asked, since, ["block", "text"])
    return met.groupBy("id").agg(F.bool_or(~(F.col("since") < F.col("rank"))).alias("fresh")).where("fresh")
