"""Pages of repeated keywords, links or tags.

Each text is measured whole: densities of links, tags and prose, repetition, concentration and entropy of its
words, and its share of function words. Within a language, location and scale of each measure are robust
(median and median deviation over all texts) and the scatter is that of the texts near the middle. A text is
spam if it lies far out by Mahalanobis distance and in the direction in which spam lies; no rule beside the two
decides.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import dealt, stored

#: Frequent function words of the languages of the corpus.
FUNCTION_WORDS = {
    "en": "the of and to in a is that it for on was with as by at from are be this have not or were its an but which has their had they will than less more who these been also into after over such only so while because when even said whose what why here how for there our we you your if can could would may must about between per no during before".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man weil während wenn heißt gilt sowie wieder neu weniger jetzt wer wo was".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante ante ellos tras menos mientras según frente este deben hacia qué".split(),
    "pt": "de a o que e do da em um para é com não uma os no se na por mais as dos como mas foi ao ele das tem à seu sua ou ser quando muito há nos já está eu também só pelo pela até isso ela entre era depois sem mesmo aos menos enquanto segundo após neste devem".split(),
}
#: Function characters of Chinese.
FUNCTION_HAN = "的了在是和与把被就都而也很但因为这那从对以及到让给向将其之里中上下个一不没有用据如若则或者并且更已需要往比"
#: Measures, and the direction in which spam lies: 1 above, -1 below the usual.
MEASURES = {"link_share": 1, "tag_share": 1, "repetition": 1, "function_share": -1, "concentration": 1, "entropy": -1, "prose_share": -1}
_NAMES = list(MEASURES)
#: Squared distance, in 7 dimensions, that 0.1 % of usual texts exceed; least projection on the spam direction.
FAR, TOWARDS = 24.3, 5.8
#: Deviation up to which a text counts for the scatter; weight of independent measures in it; bound of a deviation.
NEAR, SHRINK, MOST = 3.5, 0.3, 30.0
#: Function words in a sentence from which it is whole prose, as one in so many words.
PROSE_WORDS = 8

_URL = re.compile(r"(?:https?://|www\.)[^\s<>\"'，。、）)]+|<a\s[^>]*>|</a>|<br\s*/?>", re.IGNORECASE)
_ANCHOR = re.compile(r"<a\s[^>]*>.*?</a>", re.IGNORECASE | re.DOTALL)
_CODE = re.compile(r"(?<!\w)(?:[A-Z]{2,6}|货号|型号|编号)[-_ ]?\d{3,}", re.ASCII)
_CUT = re.compile(r"(?<=[。！？!?；;])|(?<=[a-zäöüßáéíóúñçãõâê%\d][.])\s+|\n")
_TOKEN = re.compile(r"[^\W\d_]+|\d+")
_NOT_HAN = re.compile(r"[^㐀-鿿]+")
_OTHER_LETTER = re.compile(r"[^\W\d_a-zA-ZÀ-ɏ㐀-鿿]")
_TAG = re.compile(r"#[^\s#]+")
_SETS = {k: frozenset(v) for k, v in FUNCTION_WORDS.items()}
_SENTENCE_END = tuple("。！？!?；;.”\"」…")
_IS_FUNCTION_HAN = np.zeros(0x10000, bool)
_IS_FUNCTION_HAN[[ord(c) for c in FUNCTION_HAN]] = True


def language(text: str) -> str:
    """zh by script, other for further scripts than Latin, else the language most of whose function words stand in
    the text (en if none does); the lang column is not relied on."""
    if not text.isascii():
        han = len(_NOT_HAN.sub("", text))
        if han >= 0.2 * len(text):
            return "zh"
        if len(_OTHER_LETTER.findall(text)) >= 0.3 * len(text):
            return "other"
    words = set(text.lower().split())
    hits = {k: len(words & s) / len(s) for k, s in _SETS.items()}
    best = max(hits, key=lambda k: hits[k])
    return best if hits[best] else "en"


def _han(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts whose words are not parted: pairs of characters as words, runs of four as grams, each with its unit;
    words and function characters of each unit."""
    codes = np.frombuffer("\n".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    unit = np.cumsum(codes == 10)
    han = (codes >= 0x3400) & (codes <= 0x9FFF)
    two = np.flatnonzero(han[:-1] & han[1:]) if len(codes) > 1 else np.zeros(0, np.int64)
    words = codes[two] << np.uint64(16) | codes[two + 1]
    four = two[np.isin(two + 2, two, assume_unique=True)]
    grams = codes[four] << np.uint64(48) | codes[four + 1] << np.uint64(32) | codes[four + 2] << np.uint64(16) | codes[four + 3]
    functions = np.bincount(unit, weights=han & _IS_FUNCTION_HAN[codes.astype(np.int64) & 0xFFFF], minlength=len(units))
    return words, grams, unit[four], np.bincount(unit[two], minlength=len(units)), functions


def _latin(units: list[str], functions: frozenset[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same for texts whose words are parted: content words as numbers, pairs of them as grams."""
    known: dict[str, int] = {}
    words, own, sizes, common = [], [], [], []
    for k, u in enumerate(units):
        found = _TOKEN.findall(u.lower())
        content = [known.setdefault(w, len(known)) for w in found if w not in functions]
        words += content
        own += [k] * len(content)
        sizes.append(len(found))
        common.append(len(found) - len(content))
    ids, unit = np.array(words, np.uint64), np.array(own, np.int64)
    at = np.flatnonzero(unit[:-1] == unit[1:])
    return ids, ids[at] << np.uint64(32) | ids[at + 1], unit[at], np.array(sizes), np.array(common)


def measures(text: str) -> tuple[str, list[float]]:
    """Language and measures of a text, which must not be blank.

    Shares of links and of tags and product codes; repeated word sequences; function words; concentration
    (chance that two words are the same) and entropy of the content words; and prose: the share of the text in ended
    sentences, each counted as far as it says what was not said before and has the function words of a sentence.
    """
    lang, n, low = language(text), len(text), text.lower()
    links = 0
    if "<a" in low:
        links += sum(len(m[0]) for m in _ANCHOR.finditer(text))
        text = _ANCHOR.sub("\n", text)
    if "http" in low or "www." in low or "<" in low:
        links += sum(map(len, _URL.findall(text)))
        text = _URL.sub(" ", text)
    tags = (sum(map(len, _TAG.findall(text))) if "#" in text else 0) + sum(map(len, _CODE.findall(text)))
    units = [u.strip() for part in _CUT.split(text) for u in part.split("\n") if u.strip()]
    if not units:
        return lang, [min(1.0, links / n), min(1.0, tags / n), 0.0, 0.0, 0.0, 1.0, 0.0]
    words, grams, unit, sizes, functions = _han(units) if lang == "zh" else _latin(units, _SETS.get(lang, frozenset()))
    counts = np.unique(words, return_counts=True)[1].astype(float)
    size = len(words)
    concentration = float((counts * (counts - 1)).sum()) / max(1, size * (size - 1))
    entropy = 1.0 - float((counts * np.log(counts)).sum()) / (size * math.log(size)) if size > 1 else 1.0
    first = np.unique(grams, return_index=True)[1]
    repetition = 1.0 - len(first) / len(grams) if len(grams) else 0.0
    fresh = np.bincount(unit[first], minlength=len(units)) / np.maximum(1, np.bincount(unit, minlength=len(units)))
    spoken = np.minimum(1.0, PROSE_WORDS * functions / np.maximum(1, sizes)) if lang != "other" else np.ones(len(units))
    ended = np.array([len(u) if u.endswith(_SENTENCE_END) else 0 for u in units])
    prose = float((ended * fresh * spoken).sum())
    return lang, [min(1.0, links / n), min(1.0, tags / n), repetition, float(functions.sum() / max(1, sizes.sum())), concentration, entropy, min(1.0, prose / n)]


FEATURES = "doc_id long, language string, " + ", ".join(f"{m} double" for m in _NAMES)


def _measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = [(i, *((r := measures(t))[0], *r[1])) for i, t in zip(f["doc_id"], f["text"])]
        yield pd.DataFrame(rows, columns=["doc_id", "language", *_NAMES])


def text_measures(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, language, measures) of each text that is not blank."""
    texts = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return dealt(texts.where("doc_id is not null and text is not null and text rlike '\\\\S'")).mapInPandas(_measured, FEATURES)


#: Texts that a language must have to be measured against itself; those of smaller ones are measured against all texts.
LEAST_TEXTS = 50
ALL = "all"


def by_group(features: DataFrame, least: int = LEAST_TEXTS) -> tuple[DataFrame, DataFrame]:
    """The features with the group whose usual texts each is measured against (as language), and those that the groups'
    models are made of: every language by itself, and all texts together if some language is too small."""
    sizes = {r["language"]: r["count"] for r in features.groupBy("language").count().collect()}  # a few languages
    small = [name for name, n in sizes.items() if n < least]
    if not small:
        return features, features
    judged = features.withColumn("language", F.when(F.col("language").isin(small), ALL).otherwise(F.col("language")))
    return judged, features.where(~F.col("language").isin(small)).unionByName(features.withColumn("language", F.lit(ALL)))


def robust_model(features: DataFrame) -> dict[str, dict[str, np.ndarray]]:
    """For each language the centre, scale and inverse scatter over all texts.

    Three aggregations with partial sums: medians and median deviations by mergeable sketches, then the sums
    of products over the texts none of whose measures lies far out. The result is a few numbers for each of
    the few languages.
    """
    k = F.col("language")
    middle = {r["language"]: np.array([r[m] for m in _NAMES]) for r in features.groupBy(k).agg(*(F.percentile_approx(m, 0.5, 5000).alias(m) for m in _NAMES)).collect()}
    if not middle:
        return {}
    away = features.groupBy(k).agg(*(F.percentile_approx(F.abs(F.col(m) - _by_language(middle, i)), 0.5, 5000).alias(m) for i, m in enumerate(_NAMES)))
    scale = {r["language"]: np.array([max(1.4826 * r[m], _FLOOR[m]) for m in _NAMES]) for r in away.collect()}
    n = len(_NAMES)
    names = ["n", *(f"s_{i}_{j}" for i in range(n) for j in range(i + 1))]

    def products(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sums over the texts near the middle, a row for each language of a batch."""
        for f in frames:
            rows = []
            for lang, part in f.groupby("language"):
                z = (part[_NAMES].to_numpy() - middle[lang]) / scale[lang]
                z = z[(np.abs(z) <= NEAR).all(axis=1)]
                s = z.T @ z
                rows.append((lang, float(len(z)), *(s[i, j] for i in range(n) for j in range(i + 1))))
            yield pd.DataFrame(rows, columns=["language", *names])

    near = features.mapInPandas(products, ", ".join(["language string", *(f"{x} double" for x in names)]))
    sums = {r["language"]: r for r in near.groupBy(k).agg(*(F.sum(x).alias(x) for x in names)).collect()}
    model = {}
    for lang in middle:
        scatter = np.eye(n)
        if lang in sums and sums[lang]["n"]:
            r = sums[lang]
            scatter = (1 - SHRINK) * np.array([[r[f"s_{max(i, j)}_{min(i, j)}"] / r["n"] for j in range(n)] for i in range(n)]) + SHRINK * scatter
        model[lang] = {"centre": middle[lang], "scale": scale[lang], "inverse": np.linalg.inv(scatter)}
    return model


#: Least scale of each measure: most texts have no links at all, and a deviation below this means nothing.
_FLOOR = {"link_share": 0.03, "tag_share": 0.02, "repetition": 0.05, "function_share": 0.02, "concentration": 0.004, "entropy": 0.03, "prose_share": 0.1}


def _by_language(values: dict[str, np.ndarray], i: int):
    return F.create_map(*(x for k, v in values.items() for x in (F.lit(k), F.lit(float(v[i])))))[F.col("language")]


def standing(values: np.ndarray, model: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Squared Mahalanobis distance of measures from the usual, and how far they lie in the direction of spam."""
    z = np.clip((values - model["centre"]) / model["scale"], -MOST, MOST)
    return np.einsum("ij,jk,ik->i", z, model["inverse"], z), z @ np.array(list(MEASURES.values())) / math.sqrt(len(MEASURES))


def find_spam(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", far: float = FAR, towards: float = TOWARDS) -> DataFrame:
    """(id) of the texts that consist mostly of repeated keywords, links or tags.

    Null, empty and blank texts and null ids are no case; repeated rows give repeated results; extra columns
    are ignored; the lang column is not used. Measures are taken once and kept in the shared folder.
    """
    features = stored(text_measures(rows, id_col, text_col), "measures")
    judged, usual = by_group(features)
    model = robust_model(usual)
    if not model:
        return features.select(F.col("doc_id").alias(id_col))

    def far_out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            hit = np.zeros(len(f), bool)
            for lang, at in f.groupby("language").indices.items():
                distance, direction = standing(f[_NAMES].to_numpy()[at], model[lang])
                hit[at] = (distance > far) & (direction > towards)
            yield f.loc[hit, ["doc_id"]]

    return judged.mapInPandas(far_out, "doc_id long").withColumnRenamed("doc_id", id_col)
