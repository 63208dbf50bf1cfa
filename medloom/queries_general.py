"""Queries of the general data problems (3 and 6) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.operators.nested import child_links, child_tables, infer_levels
from medloom.operators.quantities import array_quantities, union_all, value_quantities
from medloom.session import table


def p3_quantities(spark: SparkSession, d: str) -> DataFrame:
    """Every single amount in its common unit, with its residual and uniqueness."""
    drugs = table(spark, d, "zeroshot_results", "result_id", "source_text", "dosages", "strengths")
    values = table(spark, d, "feasibility_entries", "entry_id", "text", "structured_data")
    return union_all([
        array_quantities(drugs, "result_id", ["dosages", "strengths"], "source_text").withColumn("table_name", F.lit("zeroshot_results")),
        value_quantities(values, "entry_id", F.col("structured_data.value"), "text", "structured_data.value").withColumn("table_name", F.lit("feasibility_entries")),
    ])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_quantities(spark, d).select("table_name", "row_id", "field_name", "item_pos", "common_amount", "common_unit")


#: Names of the levels that the schemas turn out to have.
KINDS = {
    "gene_candidates": ("candidate_id", {"identifiers": "identifier"}),
    "extraction_results": ("result_id", {"genes": "gene", "genes.identifiers": "gene_identifier", "genes.supporting_evidence": "gene_evidence", "genes.associated_diseases": "gene_disease"}),
    "zeroshot_results": ("result_id", {"raw_entities": "raw_entity", "raw_entities.attributes": "raw_attribute"}),
}


def p6_links(spark: SparkSession, d: str) -> DataFrame:
    """Every child object of the inferred levels, whatever their names and depth, with its path."""
    parts = []
    for name, (key, kinds) in KINDS.items():
        column = next(iter(kinds)).split(".")[0]
        links = child_links(table(spark, d, name, key, column), key, column)
        parts.append(links.select(F.lit(name).alias("table_name"), "row_id", "label", "path"))
    return union_all(parts)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    names = F.create_map(*[F.lit(x) for t, (_, kinds) in KINDS.items() for label, kind in kinds.items() for x in (label, kind)])
    links = p6_links(spark, d).withColumn("child_kind", names[F.col("label")]).where("child_kind IS NOT NULL")
    return links.select("table_name", "row_id", "child_kind", F.col("path")[0].alias("pos1"), F.coalesce(F.try_element_at("path", F.lit(2)), F.lit(-1)).alias("pos2"))


def p6_genes(spark: SparkSession, d: str) -> DataFrame:
    return child_tables(table(spark, d, "extraction_results", "result_id", "genes"), "result_id", "genes")["genes"]


def p6_gene_evidence(spark: SparkSession, d: str) -> DataFrame:
    return child_tables(table(spark, d, "extraction_results", "result_id", "genes"), "result_id", "genes")["genes.supporting_evidence"]


def p6_gene_identifiers(spark: SparkSession, d: str) -> DataFrame:
    return child_tables(table(spark, d, "extraction_results", "result_id", "genes"), "result_id", "genes")["genes.identifiers"]


def p6_gene_diseases(spark: SparkSession, d: str) -> DataFrame:
    return child_tables(table(spark, d, "extraction_results", "result_id", "genes"), "result_id", "genes")["genes.associated_diseases"]


def p6_candidate_identifiers(spark: SparkSession, d: str) -> DataFrame:
    return child_tables(table(spark, d, "gene_candidates", "candidate_id", "identifiers"), "candidate_id", "identifiers")["identifiers"]


def p6_raw_entities(spark: SparkSession, d: str) -> DataFrame:
    return infer_levels(table(spark, d, "zeroshot_results", "result_id", "raw_entities"), "result_id", "raw_entities")["raw_entities"]


def p6_raw_attributes(spark: SparkSession, d: str) -> DataFrame:
    return infer_levels(table(spark, d, "zeroshot_results", "result_id", "raw_entities"), "result_id", "raw_entities")["raw_entities.attributes"]


QUERIES = {f.__name__: f for f in (p3_found, p3_quantities, p6_found, p6_links, p6_genes, p6_gene_evidence, p6_gene_identifiers, p6_gene_diseases, p6_candidate_identifiers, p6_raw_entities, p6_raw_attributes)}

_EACH = "unnest(range(len({0}))) AS {1}(i)"

SQL = {
    "p6_found": """
WITH g AS (SELECT result_id, i, genes[i + 1] AS g FROM extraction_results, unnest(range(len(genes))) AS u(i) WHERE genes[i + 1] IS NOT NULL),
j AS (SELECT result_id, CASE WHEN json_valid(raw_entities) THEN raw_entities::JSON END AS r FROM zeroshot_results),
o AS (SELECT result_id, CASE json_type(r) WHEN 'ARRAY' THEN from_json(r, '["JSON"]') WHEN 'OBJECT' THEN [r] END AS l FROM j),
e AS (SELECT result_id, i, l[i + 1] AS v FROM o, unnest(range(len(l))) AS u(i) WHERE json_type(l[i + 1]) = 'OBJECT'),
a AS (SELECT result_id, i, json_extract(v, '$.attributes') AS x FROM e),
b AS (SELECT result_id, i, CASE json_type(x) WHEN 'ARRAY' THEN from_json(x, '["JSON"]') WHEN 'OBJECT' THEN [x] END AS l FROM a)
SELECT 'gene_candidates' AS table_name, candidate_id AS row_id, 'identifier' AS child_kind, i::INT AS pos1, -1 AS pos2 FROM gene_candidates, unnest(range(len(identifiers))) AS u(i) WHERE identifiers[i + 1] IS NOT NULL
UNION ALL SELECT 'extraction_results', result_id, 'gene', i::INT, -1 FROM g
UNION ALL SELECT 'extraction_results', result_id, 'gene_identifier', g.i::INT, u.i::INT FROM g, unnest(range(len(g.g.identifiers))) AS u(i) WHERE g.g.identifiers[u.i + 1] IS NOT NULL
UNION ALL SELECT 'extraction_results', result_id, 'gene_evidence', g.i::INT, u.i::INT FROM g, unnest(range(len(g.g.supporting_evidence))) AS u(i) WHERE g.g.supporting_evidence[u.i + 1] IS NOT NULL
UNION ALL SELECT 'extraction_results', result_id, 'gene_disease', g.i::INT, u.i::INT FROM g, unnest(range(len(g.g.associated_diseases))) AS u(i) WHERE g.g.associated_diseases[u.i + 1] IS NOT NULL
UNION ALL SELECT 'zeroshot_results', result_id, 'raw_entity', i::INT, -1 FROM e
UNION ALL SELECT 'zeroshot_results', result_id, 'raw_attribute', b.i::INT, u.i::INT FROM b, unnest(range(len(l))) AS u(i) WHERE json_type(l[u.i + 1]) = 'OBJECT'""",
    "p6_genes": """
SELECT result_id AS parent_key, '' AS parent_path, i::INT AS pos, g.candidate_id AS f_candidate_id, g.matched_text AS f_matched_text, g.hgnc_symbol AS f_hgnc_symbol, g.is_alias AS f_is_alias,
g.primary_evidence.quote_text AS f_primary_evidence_quote_text, g.primary_evidence.scope_ref AS f_primary_evidence_scope_ref, g.primary_evidence.loc.page_num AS f_primary_evidence_loc_page_num,
g.primary_evidence.loc.block_id AS f_primary_evidence_loc_block_id, g.status AS f_status, g.confidence_score AS f_confidence_score, g.pages_mentioned AS f_pages_mentioned
FROM (SELECT result_id, i, genes[i + 1] AS g FROM extraction_results, unnest(range(len(genes))) AS u(i)) WHERE g IS NOT NULL""",
    "p6_gene_evidence": """
WITH g AS (SELECT result_id, i, genes[i + 1] AS g FROM extraction_results, unnest(range(len(genes))) AS u(i)),
e AS (SELECT result_id, g.i AS p, u.i AS i, g.g.supporting_evidence[u.i + 1] AS e FROM g, unnest(range(len(g.g.supporting_evidence))) AS u(i))
SELECT result_id AS parent_key, p::VARCHAR AS parent_path, i::INT AS pos, e.quote_text AS f_quote_text, e.scope_ref AS f_scope_ref, e.loc.page_num AS f_loc_page_num, e.loc.block_id AS f_loc_block_id
FROM e WHERE e IS NOT NULL""",
}
