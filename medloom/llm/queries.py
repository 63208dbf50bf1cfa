"""Queries of the text problems (1, 2, 4, 5, 7, 8 and 9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.llm.encode import encode_corpus, token_count
from medloom.llm.lookalikes import canonical_fields, vocabulary
from medloom.llm.mapping import NONE, forms, map_rows, map_values
from medloom.llm.packing import fill_report, pack
from medloom.llm.scanned import noise_lines, paragraphs
from medloom.llm.survivors import judged_values, resolve, survivors
from medloom.llm.truncation import judge, source_report
from medloom.session import materialize, table

CAPACITY = 2048


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Container and place of every document (or piece of one above the capacity)."""
    docs = table(spark, d, "documents", "doc_id", "text", "source")
    copies = F.xxhash64(F.regexp_replace(F.lower(F.trim("text")), r"\s+", " "))
    packed = pack(docs, "doc_id", token_count(F.col("text")), "source", copies, CAPACITY)
    return packed.withColumnRenamed("item_id", "doc_id").withColumnRenamed("size", "n_tokens").withColumnRenamed("piece_start", "token_start")


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Number of containers against the least possible, and the unused share."""
    return fill_report(p8_containers(spark, d).withColumnRenamed("n_tokens", "size"), CAPACITY)


def _records(spark: SparkSession, d: str):
    spans = table(spark, d, "ner_spans", "span_id", "doc_id", "text", "category", "confidence", "source", "span_start", "span_end", "entity_type", "extracted_at")
    return resolve(spans, table(spark, d, "ner_categories"), table(spark, d, "ner_sources"))


def p1_survivors(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record of every mention with two or more records."""
    return survivors(_records(spark, d)).where("records > 1")


def p1_values(spark: SparkSession, d: str) -> DataFrame:
    """Every text of every mention with its posterior; all judged true are kept."""
    return judged_values(_records(spark, d))[0].drop("text_id")


def p1_sources(spark: SparkSession, d: str) -> DataFrame:
    """What the model infers of every source: its sensitivity and specificity."""
    model, prior = judged_values(_records(spark, d))[1]
    rows = [(s, float(a), float(b), float(prior)) for s, (a, b) in sorted(model.items())]
    return spark.createDataFrame(rows, "source string, sensitivity double, specificity double, prior double")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_survivors(spark, d).select("first_span_id", "best_span_id")


def lexicon_words(spark: SparkSession, d: str) -> DataFrame:
    genes, terms = table(spark, d, "gene_lexicon"), table(spark, d, "term_lexicon")
    return vocabulary([genes.select(c) for c in ("symbol", "full_name", "aliases")] + [terms.select(c) for c in ("preferred_label", "abbreviation", "synonyms")])


def p2_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Every text that changes, with its consistent form."""
    words = materialize(lexicon_words(spark, d))
    genes = table(spark, d, "gene_candidates", "candidate_id", "matched_text", "context_text")
    entities = table(spark, d, "ner_entities", "entity_id", "text")
    return canonical_fields(genes, "gene_candidates", "candidate_id", ["matched_text", "context_text"], words).unionByName(canonical_fields(entities, "ner_entities", "entity_id", ["text"], words))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_canonical(spark, d).select("table_name", "row_id", "field_name")


def _surface(spark: SparkSession, d: str) -> DataFrame:
    genes, terms = table(spark, d, "gene_lexicon"), table(spark, d, "term_lexicon")
    gene = lambda form, rank: genes.select(F.col("symbol").alias("entry_key"), form.alias("form"), F.lit(rank).alias("form_rank"))
    term = lambda form, rank: terms.select(F.col("term_id").alias("entry_key"), form.alias("form"), F.lit(rank).alias("form_rank"))
    return materialize(forms([
        ("gene", gene(F.col("symbol"), 0).unionByName(gene(F.col("full_name"), 1)).unionByName(gene(F.explode("aliases"), 2))),
        ("term", term(F.col("preferred_label"), 0).unionByName(term(F.explode("synonyms"), 1)).unionByName(term(F.col("abbreviation"), 2))),
    ]))


def p4_mapped(spark: SparkSession, d: str) -> DataFrame:
    """The entry of every typed gene and term, with its score; NONE where there is none."""
    genes = table(spark, d, "gene_candidates", "candidate_id", "matched_text", "hgnc_symbol")
    symbols = table(spark, d, "gene_lexicon").select(F.col("symbol").alias("hgnc_symbol")).distinct()
    genes = genes.join(symbols, "hgnc_symbol", "left_anti")
    entities = table(spark, d, "ner_entities", "entity_id", "normalized").where("normalized IS NOT NULL")
    labels = table(spark, d, "term_lexicon").select(F.col("preferred_label").alias("normalized")).distinct()
    entities = entities.join(labels, "normalized", "left_anti")
    gene_rows = genes.select(F.col("candidate_id").alias("row_id"), F.lit("gene").alias("kind"), F.posexplode(F.array("hgnc_symbol", "matched_text")).alias("place", "value"))
    term_rows = entities.select(F.col("entity_id").alias("row_id"), F.lit("term").alias("kind"), F.lit(0).alias("place"), F.col("normalized").alias("value"))
    mapped = materialize(map_values(gene_rows.unionByName(term_rows), _surface(spark, d)))
    return (
        map_rows(gene_rows, mapped).withColumn("table_name", F.lit("gene_candidates"))
        .unionByName(map_rows(term_rows, mapped).withColumn("table_name", F.lit("ner_entities")))
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_mapped(spark, d).select("table_name", "row_id", "entry_key")


def p4_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """How many rows of each table have no entry."""
    return p4_mapped(spark, d).groupBy("table_name").agg(F.count("*").alias("typed"), F.count_if(F.col("entry_key") == NONE).alias("unmatched"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    found = noise_lines(table(spark, d, "pipeline_state", "state_id", "full_text_with_pages"), "state_id", "full_text_with_pages")
    return found.select(F.col("doc").alias("state_id"), F.col("no").cast("int").alias("line_no"), "noise_kind")


def p5_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """The readable paragraphs of every text; a run without the text with pages gives those of ``full_text``."""
    texts = table(spark, d, "pipeline_state", "state_id", "full_text_with_pages", "full_text").select("state_id", F.coalesce("full_text_with_pages", "full_text").alias("text"))
    return paragraphs(texts, "state_id", "text").withColumnRenamed("doc", "state_id")


def p9_judged(spark: SparkSession, d: str) -> DataFrame:
    """Every text with its log odds of being cut and the limit it ends at."""
    return judge(table(spark, d, "documents", "doc_id", "text", "source", "n_chars"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_judged(spark, d).where("is_cut").select("doc_id")


def p9_sources(spark: SparkSession, d: str) -> DataFrame:
    return source_report(p9_judged(spark, d))


QUERIES = {f.__name__: f for f in (p1_found, p1_survivors, p1_values, p1_sources, p2_found, p2_canonical, p4_found, p4_mapped, p4_unmatched, p5_found, p5_paragraphs, p7_ids, p8_containers, p8_fill, p9_found, p9_judged, p9_sources)}

SQL: dict[str, str] = {}
