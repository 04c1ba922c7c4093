"""Mixtures of sources by target shares of tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.tokenize import DEFAULT, VOCABULARIES, encode_texts
from newsloom.session import stored

#: Documents of a source that are numbered in one task.
CHUNK_ROWS = 50_000


def token_sizes(documents: DataFrame, name: str = DEFAULT, folder: str = VOCABULARIES) -> DataFrame:
    """(doc_id, source, n_tokens) of the documents that have an id, a source and a token."""
    return encode_texts(documents.where("doc_id is not null and source is not null and text is not null"), name=name, folder=folder, counts_only=True, keep=("source",)).where("n_tokens > 0")


def plan_shares(sizes: DataFrame, targets: DataFrame, total_tokens: float | str | None = None) -> DataFrame:
    """One row for each source of ``targets``: what it has, what it should give, and copies expected of each document.

    Without ``total_tokens`` the mixture is the largest in which no source that has documents falls short. A number
    is the size that is wanted, and "listed" wants as many tokens as the listed sources have; sources then fall
    short where even all their documents, repeated as often as is allowed, do not give their share.
    A source listed twice counts once, with its greatest share; a share or cap that is null, or not above
    0, gives nothing.
    """
    wanted = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    wanted = wanted.select("source", F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).cast("int").alias("max_repeats"))
    there = sizes.groupBy("source").agg(F.count("*").alias("documents"), F.sum("n_tokens").cast("long").alias("tokens"))
    plan = wanted.join(there, "source", "left").fillna(0, ["documents", "tokens"])
    usable = (F.col("tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    fits = F.when(usable, F.col("max_repeats") * F.col("tokens") / F.col("target_share"))
    listed = Window.partitionBy(F.lit(1))  # a window over the listed sources only
    if total_tokens is None:
        whole = F.min(fits).over(listed)
    else:
        whole = F.sum("tokens").over(listed).cast("double") if total_tokens == "listed" else F.lit(float(total_tokens))
    plan = plan.withColumn("planned_total", F.coalesce(whole, F.lit(0.0)))
    rate = F.when(usable, F.least(F.col("max_repeats").cast("double"), F.col("target_share") * F.col("planned_total") / F.col("tokens"))).otherwise(0.0)
    return plan.withColumn("rate", rate)


def mix(sizes: DataFrame, targets: DataFrame, total_tokens: float | str | None = None, seed: int = 7, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, n_tokens, copy_no) of the mixture, and the report of each source's share.

    Systematic sampling: each document of a source expects ``rate`` copies; these are summed up along the
    source, with one random offset, and a copy is given for each whole number that the sum crosses. A document
    thus has the rate rounded down or up, never more than max_repeats, and equal input gives equal output.

    A source may hold any share of the rows: its documents are numbered in chunks of about ``chunk_rows``
    by hash, and only the chunks' sizes are summed up along the source. Within a chunk documents are taken by
    size, which keeps the tokens close to the plan. Documents without id, source or token, and of unlisted
    sources, are not used; rows that share a doc_id count as documents of their own; extra columns are
    ignored. With no usable source the mixture is empty and the report still has each listed source.
    """
    sizes = stored(sizes, "sizes")
    plan = stored(plan_shares(sizes, targets, total_tokens), "plan")
    used = plan.where("rate > 0").select("source", "rate", "max_repeats", F.ceil(F.col("documents") / chunk_rows).alias("chunks"))
    docs = sizes.join(used, "source").withColumn("order", F.xxhash64(F.lit(seed), "doc_id"))
    docs = docs.withColumn("chunk", F.pmod("order", F.col("chunks")))
    counts = docs.groupBy("source", "chunk").agg(F.count("*").alias("n"))
    before = counts.select("source", "chunk", (F.sum("n").over(Window.partitionBy("source").orderBy("chunk")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("source", "chunk").orderBy("n_tokens", "order", "doc_id"))
    offset = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    numbered = docs.join(before, ["source", "chunk"]).withColumn("k", F.col("before") + number)
    copies = F.floor(offset + F.col("rate") * F.col("k")) - F.floor(offset + F.col("rate") * (F.col("k") - 1))
    numbered = numbered.withColumn("copies", F.least(copies, F.col("max_repeats")).cast("int")).where("copies > 0")
    numbered = stored(numbered.select("doc_id", "source", "n_tokens", "copies"), "copies")
    given = numbered.groupBy("source").agg(F.sum(F.col("n_tokens").cast("long") * F.col("copies")).alias("mixed_tokens"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"))
    report = plan.join(given, "source", "left").fillna(0, ["mixed_tokens", "copies", "most_copies"])
    whole = F.sum("mixed_tokens").over(Window.partitionBy(F.lit(1)))
    report = report.withColumn("reached_share", F.when(whole > 0, F.col("mixed_tokens") / whole).otherwise(0.0))
    full = F.col("target_share") * F.col("planned_total")
    state = F.when(F.col("documents") == 0, "no documents").when(F.col("rate") * F.col("tokens") < 0.999 * full, "falls short").otherwise("reached")
    report = report.select("source", "target_share", "reached_share", "max_repeats", "most_copies", "documents", "copies", "tokens", "mixed_tokens", state.alias("state"))
    mixture = numbered.select("doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no"))
    return mixture, report
