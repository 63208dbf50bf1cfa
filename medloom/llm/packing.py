"""Items of varying length packed into containers of fixed capacity.

Conflict-constrained best fit: items come largest first; open containers are
ordered by their residual space and carry bitmaps of the sources and of the
duplicate clusters they can take no more of.  The search starts at the
residual equal to the item's size and goes on to the next larger one until a
compatible container is found: the tightest one.  Duplicate conflicts are
strict; where no container is left without a source conflict, the search goes
over them again for duplicates alone, and only then is a container opened.

A container takes ``ceil(members / containers)`` items of a duplicate cluster
(one, unless the copies outnumber the containers) and ``spread`` times a
source's even share, so a source or a cluster that holds a third of the rows
costs no space.  Rows are dealt to groups of about ``group_rows`` by a hash of
their id, whatever their source or cluster; each group is packed in one task
and leaves at most a few containers that aren't full.

Defined results: items above the capacity are cut into full pieces and a rest;
items of size 0 (null and empty texts) take no space but stand in a container;
ties go by id; an empty table gives no containers.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUT = "container_id string, item_id bigint, piece_no int, piece_start int, size int, place int"


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, source_limit: list[int], cluster_limit: list[int]) -> list[int]:
    """Container number of each item; items must come largest first.

    ``sources`` and ``clusters`` are small numbers; cluster -1 has no conflicts.
    """
    # by residual: {(bitmap of full sources, bitmap of full clusters): [containers]}
    by_residual: list[dict[tuple[int, int], list[int]]] = [{} for _ in range(capacity + 1)]
    occupied = 0  # bit r: some container has the residual r
    state: list[tuple[int, int]] = []
    taken: list[dict[int, int]] = []  # counts below a limit above one, by source or ~cluster
    out = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        bit, cbit = 1 << source, (1 << cluster) if cluster >= 0 else 0
        found, residual = None, size
        for sbit in (bit, 0):
            rest, residual = occupied >> size, size
            while rest:
                step = (rest & -rest).bit_length() - 1  # the successor residual
                residual += step
                rest >>= step
                found = next(((key, boxes) for key, boxes in by_residual[residual].items() if not key[0] & sbit and not key[1] & cbit), None)
                if found:
                    break
                rest >>= 1
                residual += 1
            if found:
                break
        if found is None:
            box, residual = len(state), capacity
            state.append((0, 0))
            taken.append({})
        else:
            key, boxes = found
            box = boxes.pop()
            if not boxes:
                del by_residual[residual][key]
                if not by_residual[residual]:
                    occupied &= ~(1 << residual)
        s, c = state[box]
        n = taken[box][source] = taken[box].get(source, 0) + 1
        if n >= source_limit[source]:
            s |= bit
        if cluster >= 0:
            n = taken[box][~cluster] = taken[box].get(~cluster, 0) + 1
            if n >= cluster_limit[cluster]:
                c |= cbit
        state[box] = s, c
        residual -= size
        by_residual[residual].setdefault((s, c), []).append(box)
        occupied |= 1 << residual
        out.append(box)
    return out


def pack_group(pdf: pd.DataFrame, capacity: int, spread: float) -> pd.DataFrame:
    """Pack the items of one group: group, item_id, piece_no, piece_start, size, source, cluster."""
    pdf = pdf.sort_values(["size", "item_id", "piece_no"], ascending=[False, True, True], kind="stable")
    boxes = max(1, math.ceil(pdf["size"].sum() / capacity))
    source, names = pd.factorize(pdf["source"], use_na_sentinel=False)
    source_n = np.bincount(source, minlength=len(names))
    # only clusters with several members can conflict
    code, keys = pd.factorize(pdf["cluster"].where(pdf["size"] > 0), use_na_sentinel=True)
    count = np.bincount(code[code >= 0], minlength=max(1, len(keys)))
    many = np.flatnonzero(count > 1)
    number = np.full(len(count) + 1, -1)
    number[many] = np.arange(len(many))
    cluster = number[code]
    limit = [max(1, math.ceil(spread * n / boxes)) for n in source_n]
    box = best_fit(pdf["size"].tolist(), source.tolist(), cluster.tolist(), capacity, limit, [max(1, math.ceil(n / boxes)) for n in count[many]])
    pdf = pdf.assign(box=box)
    pdf["place"] = pdf.groupby("box")["size"].cumsum() - pdf["size"]
    pdf["container_id"] = pdf["group"].astype(str) + "-" + pdf["box"].astype(str)
    return pdf[["container_id", "item_id", "piece_no", "piece_start", "size", "place"]]


def pack(df: DataFrame, key: str, size: Column, source: str, cluster: Column, capacity: int = 2048, group_rows: int = 20_000, spread: float = 2.0) -> DataFrame:
    """Containers of the rows of ``df``: one row for each item or piece of one.

    Columns: container_id, item_id, piece_no, piece_start, size, place (the
    offset in the container).
    """
    groups = max(1, -(-df.count() // group_rows))
    items = df.select(F.col(key).alias("item_id"), F.coalesce(size.cast("int"), F.lit(0)).alias("n"), F.col(source).alias("source"), cluster.alias("cluster"))
    pieces = items.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / capacity).cast("int") - 1, F.lit(0)))).alias("piece_no"))
    start = F.col("piece_no") * capacity
    dealt = pieces.select(
        F.pmod(F.xxhash64("item_id", "piece_no"), F.lit(groups)).cast("int").alias("group"), "item_id", "piece_no", start.cast("int").alias("piece_start"),
        F.least(F.lit(capacity), F.col("n") - start).cast("int").alias("size"), "source", F.when(F.col("n") <= capacity, F.col("cluster")).alias("cluster"),
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pack_group(pdf, capacity, spread)

    return dealt.groupBy("group").applyInPandas(run, OUT)


def fill_report(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """Containers used, the least number possible, and the unused share of space."""
    boxes = packed.groupBy("container_id").agg(F.sum("size").alias("used"), F.count("*").alias("items"))
    return boxes.agg(
        F.count("*").alias("containers"), F.ceil(F.coalesce(F.sum("used"), F.lit(0)) / capacity).alias("least_containers"),
        F.round(1 - F.sum("used") / (F.count("*") * capacity), 6).alias("unused_share"), F.max("used").cast("bigint").alias("fullest"), F.sum("items").alias("pieces"),
    )


