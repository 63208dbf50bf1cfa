"""One surviving record for each group of records that report the same mention.

Grouping: records of one document and category group are linked if their
ranges share at least half of the shorter one or, where one has no range, if
their texts are equal apart from case, spacing, punctuation and character
forms.  Ranges of one length make runs (each start within half a length of the
next); runs, not pairs of records, are linked, so the number of links depends
on places in the text and not on how often they are reported.

Quality: every source has a sensitivity (it reports a value that is true) and
a specificity (it leaves out a value that isn't); the truth of each value of a
mention is latent.  All are inferred together by expectation-maximisation over
the distinct patterns of claims (which sources reported a value, which covered
the mention without it) with their counts.  A mention keeps every value whose
posterior is at least one half; its best text is the most probable one.  Every
E-step is an aggregate over the patterns, for any number of sources; only two
numbers for each source come to the driver.

Defined results: a null document or a category without a group is linked to
nothing; null and blank texts are equal to nothing; a range that is null,
empty or reversed is no range; repeated rows are separate records unless their
ids are equal too; ties go to the smaller span_id.
"""

from __future__ import annotations

import math
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from medloom.plans.components import connected_components
from medloom.session import broadcast_if_small, materialize

#: Characters of a stretch of text whose starts one run may hold.
BLOCK = 65_536
#: Width in characters of the cells that runs are joined by.
CELL = 256


@F.pandas_udf(T.StringType())
def _fold(texts: pd.Series) -> pd.Series:
    def fold(t: str | None) -> str | None:
        if t is None:
            return None
        t = unicodedata.normalize("NFKC", t).casefold()
        return "".join(c for c in unicodedata.normalize("NFKC", t) if c.isalnum())

    return texts.map(fold, na_action="ignore")


def folded(text: Column) -> Column:
    """A text without case, spacing, punctuation and character forms; only non-ASCII texts leave the JVM."""
    plain = text.rlike(r"^[\x00-\x7f]*$")
    ascii_only = F.regexp_replace(F.lower(text), "[^a-z0-9]", "")
    key = F.when(plain, ascii_only).otherwise(_fold(F.when(~plain, text)))
    return F.when(key != "", key)


def source_key(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def placed_records(spans: DataFrame, categories: DataFrame) -> DataFrame:
    """(span_id, doc_id, grp, start, end, text_id): what grouping needs of every record."""
    groups = broadcast_if_small(categories.select(F.col("category_label").alias("category"), F.col("category_group").alias("grp")).dropDuplicates(["category"]))
    has_range = F.coalesce(F.col("span_end") > F.col("span_start"), F.lit(False))
    named = spans.select("span_id", "doc_id", "category", F.when(has_range, F.col("span_start")).alias("start"), F.when(has_range, F.col("span_end")).alias("end"), folded(F.col("text")).alias("norm"))
    text_id = F.when(F.col("norm").isNotNull(), F.xxhash64("norm")).alias("text_id")
    return named.join(groups, "category", "left").select("span_id", "doc_id", "grp", "start", "end", text_id)


def sourced_records(spans: DataFrame, sources: DataFrame) -> DataFrame:
    """Records with their canonical source and its trust rank; an unknown source keeps its name and has no rank."""
    ranks = sources.select(source_key(F.col("source_name")).alias("k"), "source_name", "trust_rank").dropDuplicates(["k"])
    full = broadcast_if_small(ranks.select(F.col("k").alias("k1"), F.col("source_name").alias("s1"), F.col("trust_rank").alias("r1")))
    bare = broadcast_if_small(ranks.select(F.col("k").alias("k2"), F.col("source_name").alias("s2"), F.col("trust_rank").alias("r2")))
    named = spans.select(
        "span_id", "text", "confidence", "source", "entity_type", "extracted_at",
        source_key(F.col("source")).alias("k1"), source_key(F.regexp_replace(F.trim("source"), r"(?i)[\s/_-]+v?[0-9.]+$", "")).alias("k2"),
    )
    out = named.join(full, "k1", "left").join(bare, "k2", "left")
    return out.select("span_id", "text", "confidence", "entity_type", "extracted_at", F.coalesce("s1", "s2", F.trim("source")).alias("source"), F.coalesce("r1", "r2").alias("trust_rank"))


def _runs(ranged: DataFrame) -> DataFrame:
    """(doc_id, grp, len, start, run): the run of each distinct range, named by its least span_id."""
    distinct = ranged.groupBy("doc_id", "grp", (F.col("end") - F.col("start")).alias("len"), "start").agg(F.min("span_id").alias("span_id"))
    parts = ["doc_id", "grp", "len", F.floor(F.col("start") / BLOCK)]
    order = W.partitionBy(*parts).orderBy("start")
    apart = F.coalesce(2 * (F.col("start") - F.lag("start").over(order)) > F.col("len"), F.lit(False))
    numbered = distinct.withColumn("apart", apart.cast("int")).withColumn("no", F.sum("apart").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.withColumn("run", F.min("span_id").over(W.partitionBy(*parts, "no"))).select("doc_id", "grp", "len", "start", "run")


def _run_edges(runs: DataFrame) -> DataFrame:
    """Links of runs some of whose ranges share at least half of the shorter one."""
    spans = runs.groupBy("doc_id", "grp", "len", "run").agg(F.min("start").alias("lo"), F.max("start").alias("hi"))
    cells = spans.select("*", F.explode(F.sequence(F.floor(F.col("lo") / CELL), F.floor((F.col("hi") + F.col("len")) / CELL))).alias("cell"))
    s, l = cells.alias("s"), cells.alias("l")
    shorter = (F.col("s.len") < F.col("l.len")) | ((F.col("s.len") == F.col("l.len")) & (F.col("s.run") < F.col("l.run")))
    from_ = 2 * F.col("l.lo") - F.col("s.len") <= 2 * F.col("s.hi")
    to = 2 * (F.col("l.hi") + F.col("l.len")) - F.col("s.len") >= 2 * F.col("s.lo")
    same = [F.col(f"s.{k}") == F.col(f"l.{k}") for k in ("doc_id", "grp", "cell")]
    return s.join(l, reduce(Column.__and__, [*same, shorter, from_, to])).select(F.col("s.run").alias("a"), F.col("l.run").alias("b"))


def mentions(placed: DataFrame) -> DataFrame:
    """The placed records with ``first_span_id``, the least span_id of their mention."""
    slim = materialize(placed)
    linked = slim.where("doc_id IS NOT NULL AND grp IS NOT NULL")
    ranged, loose = linked.where("start IS NOT NULL"), linked.where("start IS NULL AND text_id IS NOT NULL")
    runs = materialize(_runs(ranged))
    key, place = ["doc_id", "grp", "text_id"], ["doc_id", "grp", "len", "start"]
    classes = materialize(loose.groupBy(*key).agg(F.min("span_id").alias("class")))
    length = (F.col("end") - F.col("start")).alias("len")
    # copies of a range with one text meet once
    by_text = ranged.where("text_id IS NOT NULL").select(*key, length, "start").distinct().join(classes, key).join(runs, place)
    edges = _run_edges(runs).union(by_text.select(F.col("run").alias("a"), F.col("class").alias("b")))
    labels = connected_components(edges)
    # each record meets the nodes of its own kind only
    columns = ["span_id", "doc_id", "grp", "start", "end", "text_id"]
    alone = slim.where("doc_id IS NULL OR grp IS NULL OR (start IS NULL AND text_id IS NULL)").select(*columns, F.col("span_id").alias("node"))
    noded = ranged.withColumn("len", length).join(runs, place).select(*columns, F.col("run").alias("node"))
    noded = noded.unionByName(loose.join(classes, key).select(*columns, F.col("class").alias("node"))).unionByName(alone)
    # a node's name is its least span_id, so the least node of a component is its first record
    return noded.join(labels, "node", "left").withColumn("first_span_id", F.coalesce("component", "node")).drop("node", "component")


# --- the quality model ---------------------------------------------------


def claim_patterns(values: Column, covered: Column) -> Column:
    """The sources that covered a mention, each with whether it reported the value."""
    return F.transform(F.array_sort(covered), lambda s: F.struct(s.alias("s"), F.array_contains(values, s).alias("v")))


def _log_odds(model: dict[str, tuple[float, float]], prior: float) -> Column:
    """Log odds that a value with the claims ``c`` is true."""
    start = F.lit(math.log(prior / (1 - prior)))
    if not model:
        return start
    pairs = [(F.lit(s), F.array(F.lit(math.log(a / (1 - b))), F.lit(math.log((1 - a) / b)))) for s, (a, b) in model.items()]
    terms = F.create_map(*[x for pair in pairs for x in pair])
    return F.aggregate("c", start, lambda sum_, x: sum_ + F.when(x["v"], terms[x["s"]][0]).otherwise(terms[x["s"]][1]))


def fit_sources(patterns: DataFrame, rounds: int = 30, tolerance: float = 1e-3) -> tuple[dict[str, tuple[float, float]], float]:
    """Sensitivity and specificity of every source, and the prior, by expectation-maximisation.

    ``patterns``: (c, n), claims and the number of values that have them.
    Beta(4, 2) and Beta(8, 2) priors keep the two labels from changing places.
    The names of the sources, a dimension, are the only rows the driver holds.
    """
    # few patterns are one task, and its rounds need no shuffle
    patterns = patterns.coalesce(1 + patterns.count() // 4096)
    names = [r[0] for r in patterns.select(F.explode("c.s").alias("s")).distinct().collect()]
    model, prior = dict.fromkeys(names, (0.7, 0.85)), 0.6
    for _ in range(rounds):
        p = patterns.withColumn("p", 1 / (1 + F.exp(-_log_odds(model, prior))))
        # the claim of no source counts every value once
        each = p.select("n", "p", F.explode(F.concat("c", F.array(F.struct(F.lit(None).cast("string").alias("s"), F.lit(False).alias("v"))))).alias("x"))
        n, t, v = F.col("n"), F.col("n") * F.col("p"), F.col("x.v")
        sums = {r.s: r for r in each.groupBy(F.col("x.s").alias("s")).agg(F.sum(F.when(v, t).otherwise(0.0)).alias("pt"), F.sum(t).alias("ct"), F.sum(F.when(v, n).otherwise(0)).alias("pa"), F.sum(n).alias("ca")).collect()}
        if None not in sums:
            break
        new = {}
        for s in names:
            r = sums[s]
            false = r.ca - r.ct
            a, b = (r.pt + 3) / (r.ct + 4), (false - (r.pa - r.pt) + 7) / (false + 8)
            new[s] = min(max(a, 1e-3), 1 - 1e-3), min(max(b, 1e-3), 1 - 1e-3)
        prior = (sums[None].ct + 5) / (sums[None].ca + 10)
        moved = max([0.0, *(abs(x - y) for s in names for x, y in zip(new[s], model[s], strict=True))])
        model = new
        if moved < tolerance:
            break
    return model, prior


def judged_values(records: DataFrame) -> tuple[DataFrame, tuple[dict[str, tuple[float, float]], float]]:
    """(first_span_id, text_id, text, reports, posterior, is_true) of every value a mention has, and the model."""
    trusted = F.struct(-F.coalesce("trust_rank", F.lit(2**30)), F.length("text"), F.negative("span_id"))
    claims = records.groupBy("first_span_id", "text_id", "source").agg(F.count("*").alias("n"), F.max(F.struct(trusted.alias("by"), "text")).alias("best"))
    values = claims.where("text_id IS NOT NULL").groupBy("first_span_id", "text_id").agg(F.collect_set("source").alias("pos"), F.sum("n").alias("reports"), F.max("best")["text"].alias("text"))
    covered = claims.groupBy("first_span_id").agg(F.collect_set("source").alias("cov"))
    facts = materialize(values.join(covered, "first_span_id").withColumn("c", claim_patterns(F.col("pos"), F.col("cov"))).drop("pos", "cov"))
    model, prior = fit_sources(materialize(facts.groupBy("c").agg(F.count("*").alias("n"))))
    out = facts.withColumn("posterior", 1 / (1 + F.exp(-_log_odds(model, prior)))).withColumn("is_true", F.col("posterior") >= 0.5)
    return out.drop("c"), (model, prior)


def survivors(records: DataFrame) -> DataFrame:
    """One record for each mention, built field by field.

    Text: the most probable value under the model; confidence, source and id:
    of the record with the highest confidence, then the most trusted source,
    the latest work and the smallest id; type and range: of the most trusted
    record that has one.
    """
    rank = F.coalesce("trust_rank", F.lit(2**30))
    best = F.struct(F.coalesce("confidence", F.lit(-1.0)), -rank, F.coalesce(F.col("extracted_at").cast("timestamp"), F.lit("0001-01-01").cast("timestamp")), F.negative("span_id"))
    trust = F.struct(-rank, F.coalesce("confidence", F.lit(-1.0)), F.negative("span_id"))
    only = lambda field: F.when(F.col(field).isNotNull(), trust)
    fields = records.groupBy("first_span_id").agg(
        F.count("*").alias("records"), F.max_by("span_id", best).alias("best_span_id"), F.max("confidence").alias("confidence"), F.max_by("source", best).alias("source"), F.min("doc_id").alias("doc_id"), F.min("grp").alias("category_group"),
        F.max_by("entity_type", only("entity_type")).alias("entity_type"), F.max_by("start", only("start")).alias("span_start"), F.max_by("end", only("start")).alias("span_end"),
    )
    values, _ = judged_values(records)
    texts = values.groupBy("first_span_id").agg(F.max_by("text", F.struct("posterior", "reports", F.length("text"), "text")).alias("text"), F.max("posterior").alias("posterior"), F.count_if("is_true").alias("true_values"))
    return fields.join(texts, "first_span_id", "left")


def resolve(spans: DataFrame, categories: DataFrame, sources: DataFrame) -> DataFrame:
    """All records with their mention; rows that repeat a whole record with its id count once."""
    placed = mentions(placed_records(spans, categories))
    firsts = placed.groupBy("span_id").agg(F.min_by(F.struct("doc_id", "grp", "start", "end", "text_id", "first_span_id"), F.struct("first_span_id", "start")).alias("x")).select("span_id", "x.*")
    return materialize(firsts.join(sourced_records(spans, sources).dropDuplicates(["span_id"]), "span_id"))
