"""Exact duplicates by keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import stored, unsent


def best_per_key(df: DataFrame, keys: list[Column], best: list[Column], id_col: str = "pos") -> DataFrame:
    """The row of each key that is greatest in ``best``; ties go to the smaller id, which must be unique.

    Keys are hashed for the shuffle and combined before it, so a key with a large part of all rows costs
    one row a task. Null keys are equal to one another. A null in ``best`` is least.
    """
    key = F.sha2(F.concat_ws("", *(F.coalesce(k.cast("string"), F.lit("")) for k in keys)), 256)
    scored = df.select(key.alias("__nl_key"), F.struct(*(b.alias(f"b{i}") for i, b in enumerate(best)), (-F.col(id_col)).alias("id")).alias("__nl_best"))
    kept = scored.groupBy("__nl_key").agg(F.max("__nl_best").alias("__nl_best")).select((-F.col("__nl_best.id")).alias(id_col))
    return df.join(kept, id_col, "left_semi")


def first_per_key(df: DataFrame, key: Column, id_col: str = "pos") -> DataFrame:
    """The row of each key with the smallest id; rows with null keys are all dropped but the first."""
    return best_per_key(df, [key], [F.lit(0)], id_col)


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``: what an index or keyed table holds after writes in that order.

    Of rows that tie in all of ``order`` the greatest as a whole is kept. The rows must be comparable (no maps).
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*order, *(c for c in rest if c not in order))
    return df.groupBy(*keys).agg(F.max(row).alias("__nl_row")).select(*(F.col(c) if c in keys else F.col(f"__nl_row.{c}").alias(c) for c in df.columns))


def either_key(df: DataFrame, keys: list[Column], best: list[Column], id_col: str = "pos", most_rounds: int = 60, salts: int = 16) -> DataFrame:
    """Rows that remain when rows are taken best first and dropped if any of their keys is a kept row's.

    The order is ``best`` descending, then id; null and blank keys match nothing. Kept rows are the first,
    in that order, among their neighbours; this is worked out in rounds over all rows at once: whoever is first
    under each of its keys is kept, whoever then shares a key with a kept row is dropped.

    A round sends back what it needs by aggregation: the first row of each key, by partial sums, and from these how
    many keys a row leads. Only the keys of kept rows are joined to the rows, each spread over ``salts`` parts, so
    a key that a third of all rows share gathers nowhere; none of these tables is broadcast. A written table cuts the lineage. Chains of more than
    ``most_rounds`` undecided rows are settled with more rounds (the parameter); beyond it, an error.
    """
    order = F.struct(*(b.alias(f"b{i}") for i, b in enumerate(best)), (-F.col(id_col)).alias("id"))
    cells = F.array_compact(F.array(*(F.when(F.coalesce(k, F.lit("")) != "", F.xxhash64(F.lit(i), k)) for i, k in enumerate(keys))))
    own = stored(df.select(F.col(id_col).alias("id"), order.alias("order"), cells.alias("cells")), "keys")
    kept = [own.where("size(cells) = 0").select("id")]
    open_ = own.where("size(cells) > 0")
    for _ in range(most_rounds):
        if open_.isEmpty():
            break
        links = open_.select("id", "order", F.size("cells").alias("n"), F.explode("cells").alias("key"))
        firsts = stored(links.groupBy("key").agg(F.max(F.struct("order", "id", "n")).alias("first")).select("key", "first.id", "first.n"), "firsts")
        led = stored(firsts.groupBy("id", "n").agg(F.count("*").alias("led")).where("led = n").select("id"), "kept")
        kept.append(led)
        taken = firsts.join(unsent(led), "id", "left_semi").select("key", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        salted = links.select("id", "key", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"))
        gone = salted.join(unsent(taken), ["key", "salt"], "left_semi").select("id").distinct()
        open_ = stored(open_.join(unsent(gone), "id", "left_anti"), "keys")
    else:
        raise RuntimeError(f"rows are still open after {most_rounds} rounds")
    ids = kept[0]
    for k in kept[1:]:
        ids = ids.unionByName(k)
    return df.join(unsent(ids.withColumnRenamed("id", id_col)), id_col, "left_semi")
