"""New batches against everything already accepted.

A document is known by hashes: of its address in one form, of its title and of its text in normal form. Its
paragraphs have hashes too, which tell how much of it stood in others before. Hashes of the history lie in a
bucketed table. A batch is joined to it bucket by bucket on hashes alone, and what is new is appended; texts of
the history are never read again.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.session import dealt, new_path, stored

#: Labels that may be put before a title.
LABELS = [
    "快讯", "独家", "早报", "晚报", "深度", "重磅", "最新", "突发", "更新", "专访", "观察", "分析", "午报", "日报", "周报", "简讯", "要闻", "头条",
    "breaking", "update", "updated", "exclusive", "analysis", "opinion", "just in", "report", "live", "news", "in depth", "watch", "alert",
    "última hora", "urgente", "análisis", "exclusiva", "actualización", "análise", "exclusivo", "atualização",
    "analyse", "eilmeldung", "eil", "exklusiv", "aktuell", "update",
]
#: Words that mean the same in a title; the first stands for all.
SYNONYMS = [
    "发布 上线 推出 亮相", "首批 第一批", "扩产 加产 增产", "出口 外销", "增长 上涨 攀升", "召回 下架", "监管部门 主管机构 监管机构", "价格 报价", "滞销 遇冷 卖不动",
    "交出 给出", "修订 收紧 调整", "承压 受影响", "打磨 做好", "进军 切入 布局", "斥资 投入 豪掷", "联手 携手",
    "launches unveils rolls_out introduces debuts", "bets wagers", "bet wager", "tightens revises changes", "faces hit_by", "slow_down stall", "slows_down stalls", "recalls withdraws pulls",
    "prices quotes", "investieren stecken", "ändert verschärft", "zeigt startet", "invierten destinan", "lanza presenta", "endurece revisa", "investem aplicam", "lança apresenta", "endurece revê",
]
#: Adverbs and the like that may be added to a title.
ADDED = {
    "cjk": ["正式", "近日", "今日", "日前", "率先", "重新", "相关", "现行", "共同", "再次", "悄然", "已经", "宣布", "已", "为什么", "为何", "了"],
    "word": "quietly officially again its today now reportedly formally here is why hoy ya las los hoje já as os jetzt nun die heute erneut the a".split(),
}
_LABEL_HEAD = re.compile(rf"\s*(?:【[^】]{{1,12}}】|\[[^\]]{{1,24}}\]|(?:{'|'.join(sorted(map(re.escape, LABELS), key=len, reverse=True))})\s*[:|·丨-])\s*", re.IGNORECASE)
_HAN = re.compile(r"[㐀-鿿]")
_HALVES = re.compile(r"(?<!\d)[,:;|](?:\s|(?=\D))|(?<=\d)[,:;|](?=\s|[^\d\s])|[?？。、]")
_JOINED_ADVERB = re.compile(r",\s*共同")
_SAME = {w: group.split()[0] for group in SYNONYMS for w in group.split()}
_HAN_SAME = [(w, to) for w, to in sorted(_SAME.items(), key=lambda x: -len(x[0])) if _HAN.match(w)]
_PHRASES = [(w.replace("_", " "), w) for w in _SAME if "_" in w]


def address_key(url: str | None) -> str | None:
    """An article's address without scheme, www., case of the host, extra and final slashes, fragment and all
    parameters but aid. A cell may be JSON with text and link. Blank gives None."""
    if not url or not url.strip():
        return None
    url = url.strip()
    if url[0] == "{":
        try:
            cell = json.loads(url)
            url = str(cell.get("link") or cell.get("url") or "").strip()
        except (ValueError, AttributeError):
            pass
        if not url:
            return None
    url = re.sub(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//", "", url.partition("#")[0].strip())
    url, _, query = url.partition("?")
    host, _, path = url.partition("/")
    host = re.sub(r"^(?:www\.)+", "", host.lower().rstrip(".")).removesuffix(":443").removesuffix(":80")
    if not host:
        return None
    path = "/".join(p for p in path.split("/") if p)
    aid = next((v for k, _, v in (p.partition("=") for p in query.replace(";", "&").split("&")) if k == "aid" and v), "")
    return f"{host}/{path}" + (f"?aid={aid}" if aid else "")


def title_halves(title: str | None, source: str | None = None) -> list[str]:
    """The halves of a title in one wording, sorted: without labels, the source's name, adverbs, case, width and
    punctuation, synonyms as one word. Numbers, units and names stay. Blank gives an empty list."""
    if not title or not title.strip():
        return []
    t = " ".join(unicodedata.normalize("NFKC", title).split())
    name = " ".join(unicodedata.normalize("NFKC", source or "").split())
    if name:
        t = re.sub(rf"(?:[\s\-_|–—·•/(\[]+){re.escape(name)}[\s)\]]*$|^{re.escape(name)}\s*[\-_|–—·•:]+\s*", "", t, flags=re.IGNORECASE)
    t = t.strip("《》“”\"'「」『』 ")
    while (m := _LABEL_HEAD.match(t)) and m.end() < len(t):
        t = t[m.end() :]
    t = _JOINED_ADVERB.sub("", t.casefold())
    for phrase, joined in _PHRASES:
        t = t.replace(phrase, joined)
    halves = []
    for half in _HALVES.split(t):
        han = bool(_HAN.search(half))
        if han:
            for w, to in _HAN_SAME:
                half = half.replace(w, to)
            for w in ADDED["cjk"]:
                half = half.replace(w, "")
            words = ["".join(re.findall(r"\d+(?:[.,]\d+)*|%|[^\W_]", half))]
        else:
            words = [_SAME.get(w, w) for w in re.findall(r"\d+(?:[.,]\d+)*|%|[^\W\d_]+(?:_[^\W\d_]+)*", half)]
            words = [w for w in words if w not in ADDED["word"]]
        if any(words):
            halves.append(" ".join(words))
    return sorted(halves)


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - 2**63


def paragraphs(text: str | None) -> list[str]:
    """The lines of a text in normal form (NFKC, lower case, without white space), blank ones left out."""
    return [p for line in (text or "").split("\n") if (p := "".join(unicodedata.normalize("NFKC", line).casefold().split()))]


WHOLE, PARAGRAPH = 0, 1


def document_keys(url: str | None, title: str | None, source: str | None) -> list[int]:
    """Hashes under which a document is known: of its address, and of its title as the sum of its halves' hashes,
    which is equal for two titles just if each half of either stands in the other."""
    keys = []
    address = address_key(url)
    if address:
        keys.append(_hash("a\0" + address))
    halves = title_halves(title, source)
    if halves:
        total = sum(_hash("t\0" + h) for h in halves) + len(halves)
        keys.append((total + 2**63) % 2**64 - 2**63)
    return keys


def text_keys(text: str | None) -> list[tuple[int, int, int]]:
    """(key, part, characters) of a text: one hash of the whole and one of each distinct paragraph."""
    parts = paragraphs(text)
    if not parts:
        return []
    whole = [(_hash("c\0" + "\n".join(parts)), WHOLE, sum(map(len, parts)))]
    return whole + [(_hash("p\0" + p), PARAGRAPH, len(p)) for p in dict.fromkeys(parts)]


KEYS = "seq long, key long, part byte, size int"


def _keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = []
        for seq, url, title, source, text in zip(f["seq"], f["url"], f["title"], f["source"], f["text"]):
            rows += [(seq, key, WHOLE, 0) for key in document_keys(url, title, source)]
            rows += [(seq, *k) for k in text_keys(text)]
        yield pd.DataFrame(rows, columns=["seq", "key", "part", "size"]).astype({"seq": "int64", "key": "int64", "part": "int8", "size": "int32"})


def keys_of(rows: DataFrame, seq_col: str, url_col: str | None, title_col: str | None, source_col: str | None, text_col: str | None = None) -> DataFrame:
    """(seq, key, part, size) of each row that has an address, a title or, where a column of texts is named, a text.
    A column given as None is left aside."""
    of = lambda c: (F.col(c) if c else F.lit(None)).cast("string")
    cells = rows.select(F.col(seq_col).cast("long").alias("seq"), of(url_col).alias("url"), of(title_col).alias("title"), of(source_col).alias("source"), of(text_col).alias("text"))
    return dealt(cells.where("seq is not null")).mapInPandas(_keyed, KEYS)


#: Hashes that a bucket of the history should hold, fewest buckets, and appends after which buckets are rewritten as one file each.
BUCKET_ROWS, LEAST_BUCKETS, MOST_APPENDS = 4_000_000, 8, 16


class HashHistory:
    """The hashes of everything accepted so far, in a table bucketed and sorted by hash.

    ``path`` is a shared folder; a history that is there already is taken up again. Buckets are as many as its
    size asks for, or ``buckets``. Each append adds a file to each bucket, so after ``most_appends`` the table is
    rewritten (``compact``) as a new version beside the old one, which goes once the new one is whole.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, most_appends: int = MOST_APPENDS):
        self.spark, self.path, self.wanted, self.most_appends = spark, path or new_path(spark, "history"), buckets, most_appends
        self.version = self.buckets = self.appends = 0
        self.table: str | None = None
        for version, n in self._versions():
            if version > self.version:
                self._open(version, n)

    def _fs(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _versions(self) -> list[tuple[int, int]]:
        """Number and buckets of each version that was written to its end."""
        fs, at = self._fs(self.path)
        found = []
        for status in fs.listStatus(at) if fs.exists(at) else []:
            m = re.fullmatch(r"v(\d+)-b(\d+)", status.getPath().getName())
            if m and fs.exists(self._fs(f"{status.getPath()}/_SUCCESS")[1]):
                found.append((int(m[1]), int(m[2])))
        return found

    def _folder(self, version: int, buckets: int) -> str:
        return f"{self.path}/v{version}-b{buckets}"

    def _open(self, version: int, buckets: int) -> None:
        self.version, self.buckets, self.appends = version, buckets, 0
        self.table = f"history_{_hash(self.path) % 2**63:x}_v{version}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (key BIGINT) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{self._folder(version, buckets)}'")

    def _buckets_for(self, rows: int) -> int:
        return self.wanted or max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))

    def keys(self) -> DataFrame:
        return self.spark.table(self.table) if self.table else self.spark.createDataFrame([], "key long")

    def append(self, keys: DataFrame) -> None:
        """Adds hashes, one file for each bucket. Hashes that are there already do no harm, so a repeated append
        changes nothing. ``keys`` is read twice if the history is new, so it should be a written table."""
        if self.table is None:
            self._open(self.version + 1, self._buckets_for(keys.count()))
        self._write(keys)
        self.appends += 1
        if self.appends >= self.most_appends:
            self.compact()

    def _write(self, keys: DataFrame) -> None:
        once = keys.select("key").distinct().repartition(self.buckets, "key")
        once.write.mode("append").bucketBy(self.buckets, "key").sortBy("key").format("parquet").saveAsTable(self.table, path=self._folder(self.version, self.buckets))
        self.spark.catalog.refreshTable(self.table)

    def compact(self, least_rows: int = 0) -> None:
        """Rewrites the history as one file a bucket, with as many buckets as its rows, or ``least_rows``, ask for."""
        old, folder, all_keys = self.table, self._folder(self.version, self.buckets), self.keys()
        self._open(self.version + 1, self._buckets_for(max(least_rows, all_keys.count())))
        self._write(all_keys)
        self.spark.sql(f"DROP TABLE {old}")
        fs, at = self._fs(folder)
        fs.delete(at, True)

    def check(self, keys: DataFrame, accept: bool = True) -> DataFrame:
        """(seq, known, paragraphs, covered, size, covered_size) of the batch's documents.

        ``keys`` is the batch as a written table of (seq, key, part, size). A document is known if the history,
        or the batch under a smaller seq, has one of its whole hashes; covered are those of its paragraphs that
        stood there, in whichever document.

        Each hash is first reduced to its smallest seq, by partial sums, so that a hash shared by a large part
        of the batch does not gather in one task; then it meets the history in its own bucket. Whether a hash is
        new is carried back by seq, not joined back by hash. With ``accept`` the batch's hashes are appended, so
        a document is known from then on under all its addresses and titles, duplicates' included.
        """
        rows = keys.count()
        if self.table and self.wanted is None and rows > 2 * BUCKET_ROWS * self.buckets:
            self.compact(rows)
        firsts = keys.groupBy("key").agg(F.min("seq").alias("seq")).repartition(self.buckets or self._buckets_for(rows), "key")
        fresh = stored(firsts.join(self.keys(), "key", "left_anti"), "fresh")
        both = keys.select("seq", "key", "part", "size", F.lit(0).alias("fresh")).unionByName(fresh.select("seq", "key", F.lit(-1).cast("byte").alias("part"), F.lit(0).alias("size"), F.lit(1).alias("fresh")))
        one = both.repartition("seq").groupBy("seq", "key").agg(F.max("fresh").alias("fresh"), F.max("part").alias("part"), F.max("size").alias("size"))
        paragraph, met = F.col("part") == PARAGRAPH, F.col("fresh") == 0
        marks = one.groupBy("seq").agg(
            F.bool_or(~paragraph & met).alias("known"), F.count_if(paragraph).alias("paragraphs"), F.count_if(paragraph & met).alias("covered"),
            F.coalesce(F.sum(F.when(paragraph, F.col("size"))), F.lit(0)).alias("size"), F.coalesce(F.sum(F.when(paragraph & met, F.col("size"))), F.lit(0)).alias("covered_size"),
        )
        if accept:
            self.append(fresh)
        return marks


def find_known(batch: DataFrame, history: HashHistory, seq_col: str = "pos", url_col: str | None = "url", title_col: str | None = "title", source_col: str | None = "source") -> DataFrame:
    """(seq) of the batch's documents whose story is in the history or in the batch under a smaller seq.

    Rows with null seq and rows with neither address nor title have no result; of rows that share a seq, each
    is judged with all hashes of that seq; extra columns are ignored. The batch's hashes are written once
    to the shared folder and appended to the history.
    """
    keys = stored(keys_of(batch, seq_col, url_col, title_col, source_col), "keys")
    return history.check(keys).where("known").select(F.col("seq").alias(seq_col))


def find_covered(batch: DataFrame, history: HashHistory, seq_col: str = "pos", text_col: str = "body") -> DataFrame:
    """(seq, known, paragraphs, covered, covered_share) of the batch's documents that have a text: whether the whole
    text stood in the history or earlier in the batch, and how many of its paragraphs, and what share of its
    characters, did. Null seq and blank texts have no result; repeated rows of one seq count as one document.
    """
    keys = stored(keys_of(batch, seq_col, None, None, None, text_col), "keys")
    share = F.col("covered_size") / F.col("size")
    return history.check(keys).select(F.col("seq").alias(seq_col), "known", "paragraphs", "covered", share.alias("covered_share"))


def known_by_batch(rows: DataFrame, batch_col: str, numbers: list[int], history: HashHistory, seq_col: str = "pos", url_col: str = "url", title_col: str = "title", source_col: str = "source") -> DataFrame:
    """(seq, batch) of the documents found known when the batches are checked one after another, each against what
    was accepted before it. Each step reads its own batch and the hashes only."""
    parts = []
    for n in numbers:
        found = find_known(rows.where(F.col(batch_col) == n), history, seq_col, url_col, title_col, source_col)
        parts.append(stored(found.withColumn("batch", F.lit(n)), "known"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
