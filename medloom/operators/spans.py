"""Joins and greedy selection of spans by position."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from medloom.functions.scores import overlap_of_shorter


def nearest(left: DataFrame, right: DataFrame, by: str, reach: int) -> DataFrame:
    """Each left span (id, by, pos) with the nearest right one (id, pos) within ``reach``.

    A range join through cells of that width: both sides meet by equality on
    (by, cell), so a document with very many spans is spread over its cells.
    Ties go to the smaller position, then id.
    """
    a = left.select(F.col("id").alias("left_id"), by, F.col("pos").alias("p"), F.explode(F.array(*[F.floor(F.col("pos") / reach) + k for k in (-1, 0, 1)])).alias("cell"))
    b = right.select(F.col("id").alias("right_id"), by, F.col("pos").alias("q"), F.floor(F.col("pos") / reach).alias("cell"))
    pairs = a.join(b, [by, "cell"]).withColumn("distance", F.abs(F.col("p") - F.col("q"))).where(F.col("distance") <= reach)
    return pairs.groupBy("left_id").agg(F.min(F.struct("distance", "q", "right_id")).alias("m")).select("left_id", "m.right_id", "m.distance")


def first_within(left: DataFrame, right: DataFrame, by: str, reach: int) -> DataFrame:
    """Each left span with the first (not the nearest) right one within ``reach``."""
    a = left.select(F.col("id").alias("left_id"), by, F.col("pos").alias("p"), F.explode(F.array(*[F.floor(F.col("pos") / reach) + k for k in (-1, 0, 1)])).alias("cell"))
    b = right.select(F.col("id").alias("right_id"), by, F.col("pos").alias("q"), F.floor(F.col("pos") / reach).alias("cell"))
    pairs = a.join(b, [by, "cell"]).where(F.abs(F.col("p") - F.col("q")) <= reach)
    return pairs.groupBy("left_id").agg(F.min(F.struct("q", "right_id")).alias("m")).select("left_id", "m.right_id")


def overlapping(spans: DataFrame, by: list[str], least: float = 0.5, cell: int = 256) -> DataFrame:
    """Pairs (a, b), a < b, of different ranges that share ``least`` of the shorter one.

    Equal ranges are met once, by their smallest id, so copies make no pairs.
    """
    distinct = spans.groupBy(*by, "start", "end").agg(F.min("id").alias("id"))
    cells = distinct.select("*", F.explode(F.sequence(F.floor(F.col("start") / cell), F.floor(F.col("end") / cell))).alias("cell"))
    a, b = cells.alias("a"), cells.alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in (*by, "cell")]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    share = overlap_of_shorter(F.col("a.start"), F.col("a.end"), F.col("b.start"), F.col("b.end"))
    return a.join(b, cond & (F.col("a.id") < F.col("b.id")) & (share >= least)).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()


def greedy_spans(spans: DataFrame, by: list[str], gap: int = 0) -> DataFrame:
    """Keep spans from the highest score down, dropping those that overlap a kept one.

    Runs of overlapping spans, found by windows over distinct ranges, are the
    groups; the highest scored copy stands for equal ranges.
    """
    top = spans.withColumn("r", F.row_number().over(W.partitionBy(*by, "start", "end").orderBy(F.desc("score"), "id"))).where("r = 1").drop("r")
    order = W.partitionBy(*by).orderBy("start", "end", "id")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    runs = top.withColumn("new", (F.coalesce(reach, F.lit(-1)) <= F.col("start") + gap).cast("int")).withColumn("run", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    sized = runs.withColumn("many", F.count("*").over(W.partitionBy(*by, "run")))

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        kept: list[tuple[int, int]] = []
        ids = []
        for r in pdf.sort_values(["score", "id"], ascending=[False, True]).itertuples():
            if all(r.end <= s or r.start >= e for s, e in kept):
                kept.append((r.start, r.end))
                ids.append(r.id)
        return pd.DataFrame({"id": pd.Series(ids, dtype="int64")})

    return sized.where("many = 1").select("id").unionByName(sized.where("many > 1").groupBy(*by, "run").applyInPandas(keep, "id long"))


def forward_fill(df: DataFrame, by: str, order: str, value: str, default: str) -> DataFrame:
    """The last non-null ``value`` up to each row, as ``current``."""
    w = W.partitionBy(by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("current", F.coalesce(F.last(value, ignorenulls=True).over(w), F.lit(default)))


def islands(df: DataFrame, by: list[str], order: list[str], starts) -> DataFrame:
    """Number the runs of rows between those where ``starts`` holds, as ``island``."""
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("island", F.sum(F.coalesce(starts, F.lit(True)).cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
