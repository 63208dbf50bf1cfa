"""Queries of the joins, aggregations, windows, set operations, sources and sinks."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from medloom.functions import scores as S
from medloom.functions.extract import definitions, reference_keys
from medloom.operators import dedup as D
from medloom.operators import matching as M
from medloom.operators import spans as SP
from medloom.registry import BLOCKS, PAGES, PLANTED, Registry, blocks, pages, planted
from medloom.session import broadcast_if_small, table

query = Registry()


# --- scans and linear views ---------------------------------------------------------


@query(f"SELECT doc_id, block_no, block, CASE WHEN block_no = 0 THEN 'first' WHEN length(block) < 40 THEN 'short' ELSE 'body' END AS zone FROM {BLOCKS}")
def sc02_blocks(spark, d):
    return blocks(spark, d).withColumn("zone", F.when(F.col("block_no") == 0, "first").when(F.length("block") < 40, "short").otherwise("body"))


@query(f"SELECT state_id, page, line_no, row_number() OVER (PARTITION BY state_id ORDER BY line_no)::INT AS reading_order FROM {PAGES}")
def sc04_linear_lines(spark, d):
    return pages(spark, d).select("state_id", "page", "line_no", F.row_number().over(W.partitionBy("state_id").orderBy("line_no")).alias("reading_order"))


@query(f"SELECT doc_id, string_agg(block, chr(10) ORDER BY block_no) AS joined, count(*) AS n FROM {BLOCKS} GROUP BY doc_id")
def sc05_full_text(spark, d):
    b = blocks(spark, d).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("block_no", "block"))).alias("a"), F.count("*").alias("n"))
    return b.select("doc_id", F.array_join(F.transform("a", lambda x: x["block"]), "\n").alias("joined"), "n")


@query(f"SELECT doc_id, string_agg(CASE WHEN length(block) < 40 THEN '## ' || block ELSE block END, chr(10) || chr(10) ORDER BY block_no) AS markdown FROM {BLOCKS} GROUP BY doc_id")
def sc06_markdown(spark, d):
    m = F.when(F.length("block") < 40, F.concat(F.lit("## "), "block")).otherwise(F.col("block"))
    b = blocks(spark, d).select("doc_id", "block_no", m.alias("m")).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("block_no", "m"))).alias("a"))
    return b.select("doc_id", F.array_join(F.transform("a", lambda x: x["m"]), "\n\n").alias("markdown"))


@query("""SELECT symbol, alias, 0 AS priority FROM (SELECT symbol, unnest(aliases) AS alias FROM gene_lexicon) WHERE alias IS NOT NULL
UNION ALL SELECT symbol, regexp_replace(symbol, '^([A-Z]{1,4})([0-9]+)([A-Z]?)$', '\\1-\\2\\3') AS alias, 1 FROM gene_lexicon WHERE regexp_matches(symbol, '^([A-Z]{1,4})([0-9]+)([A-Z]?)$')""")
def sc14_gene_aliases(spark, d):
    g = table(spark, d, "gene_lexicon")
    rx = "^([A-Z]{1,4})([0-9]+)([A-Z]?)$"
    return g.select("symbol", F.explode("aliases").alias("alias"), F.lit(0).alias("priority")).where("alias IS NOT NULL").unionByName(g.where(F.col("symbol").rlike(rx)).select("symbol", F.regexp_replace("symbol", rx, "$1-$2$3").alias("alias"), F.lit(1).alias("priority")))


@query("SELECT term_id AS entry, form, priority FROM (SELECT term_id, preferred_label AS form, 0 AS priority FROM term_lexicon UNION ALL SELECT term_id, abbreviation, 1 FROM term_lexicon UNION ALL SELECT term_id, unnest(synonyms), 2 FROM term_lexicon) WHERE form IS NOT NULL AND length(form) >= 2")
def sc16_lexicon_union(spark, d):
    t = table(spark, d, "term_lexicon")
    part = lambda c, p: t.select(F.col("term_id").alias("entry"), c.alias("form"), F.lit(p).alias("priority"))
    return part(F.col("preferred_label"), 0).unionByName(part(F.col("abbreviation"), 1)).unionByName(part(F.explode("synonyms"), 2)).where("form IS NOT NULL AND length(form) >= 2")


@query("SELECT w AS word FROM (VALUES ('the'),('a'),('an'),('and'),('or'),('of'),('in')) v(w)")
def sc18_builtin_words(spark, d):
    from medloom.functions.predicates import STOP_STARTS

    return spark.createDataFrame([(w,) for w in STOP_STARTS], "word string")


@query("SELECT l.symbol, coalesce(s.n, 0) AS uses, list_sort(l.aliases)[1] AS first_alias FROM gene_lexicon l LEFT JOIN (SELECT hgnc_symbol AS symbol, count(*) AS n FROM gene_candidates GROUP BY 1) s USING (symbol)")
def sc28_lexicon_enriched(spark, d):
    uses = table(spark, d, "gene_candidates").groupBy(F.col("hgnc_symbol").alias("symbol")).agg(F.count("*").alias("n"))
    return table(spark, d, "gene_lexicon").join(uses, "symbol", "left").select("symbol", F.coalesce("n", F.lit(0)).alias("uses"), F.get(F.array_sort("aliases"), F.lit(0)).alias("first_alias"))


# --- sinks: what they would write ------------------------------------------------------


@query("SELECT doc_id, backend, count(*) AS listed, count_if(score >= 0.5) AS confident FROM ner_entities WHERE score IS NOT NULL GROUP BY ALL")
def sk03_entity_export(spark, d):
    return table(spark, d, "ner_entities").where("score IS NOT NULL").groupBy("doc_id", "backend").agg(F.count("*").alias("listed"), F.count_if(F.col("score") >= 0.5).alias("confident"))


@query("SELECT doc_id, model, sum(input_tokens) AS input_tokens, sum(output_tokens) AS output_tokens, count(*) AS calls FROM llm_usage WHERE doc_id IS NOT NULL GROUP BY ALL")
def sk07_additive_upsert(spark, d):
    u = table(spark, d, "llm_usage").where("doc_id IS NOT NULL")
    return u.groupBy("doc_id", "model").agg(F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.count("*").alias("calls"))


# --- joins ------------------------------------------------------------------------------

_SPAN = "SELECT span_id AS id, doc_id, span_start AS pos, category_group AS g, text FROM ner_spans JOIN ner_categories ON category = category_label WHERE span_start IS NOT NULL"


def _grouped(spark, d):
    c = broadcast_if_small(table(spark, d, "ner_categories").select(F.col("category_label").alias("category"), F.col("category_group").alias("g")))
    return table(spark, d, "ner_spans", "span_id", "doc_id", "span_start", "span_end", "category", "text", "confidence").where("span_start IS NOT NULL AND span_end > span_start").join(c, "category").withColumnsRenamed({"span_id": "id", "span_start": "pos"})


@query(f"WITH s AS ({_SPAN}), p AS (SELECT a.id AS left_id, b.id AS right_id, abs(a.pos - b.pos) AS distance, b.pos AS q FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.g = 'lab_value' AND b.g = 'drug_admin' AND abs(a.pos - b.pos) <= 200) SELECT left_id, right_id, distance FROM (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY distance, q, right_id) AS r FROM p) WHERE r = 1")
def jn11_nearest_neighbour(spark, d):
    s = _grouped(spark, d)
    return SP.nearest(s.where("g = 'lab_value'"), s.where("g = 'drug_admin'"), "doc_id", 200)


@query(f"WITH s AS ({_SPAN}), p AS (SELECT a.id AS left_id, b.id AS right_id, b.pos AS q FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.g = 'procedure' AND b.g = 'symptom' AND abs(a.pos - b.pos) <= 100) SELECT left_id, right_id FROM (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY q, right_id) AS r FROM p) WHERE r = 1")
def jn12_first_within(spark, d):
    s = _grouped(spark, d)
    return SP.first_within(s.where("g = 'procedure'"), s.where("g = 'symptom'"), "doc_id", 100)


@query("""WITH r AS (SELECT doc_id, category, span_start AS s, span_end AS e, min(span_id) AS id FROM ner_spans WHERE span_start IS NOT NULL AND span_end > span_start GROUP BY ALL)
SELECT a.id AS a, b.id AS b FROM r a JOIN r b ON a.doc_id = b.doc_id AND a.category = b.category AND a.id < b.id AND a.s < b.e AND b.s < a.e WHERE 2 * (least(a.e, b.e) - greatest(a.s, b.s)) >= least(a.e - a.s, b.e - b.s)""")
def jn14_span_overlap(spark, d):
    s = table(spark, d, "ner_spans", "span_id", "doc_id", "category", "span_start", "span_end").where("span_start IS NOT NULL AND span_end > span_start").withColumnsRenamed({"span_id": "id", "span_start": "start", "span_end": "end"})
    return SP.overlapping(s, ["doc_id", "category"])


@query("""WITH k AS (SELECT DISTINCT candidate_id, unnest(list_transform(range(greatest(length(context_text) - 59, 0)), lambda i: substring(context_text, i + 1, 60))) AS g FROM gene_candidates WHERE context_text IS NOT NULL),
r AS (SELECT g, min(candidate_id) AS rep FROM k GROUP BY g HAVING count(*) > 1) SELECT candidate_id, min(rep) AS shares_with FROM k JOIN r USING (g) GROUP BY candidate_id""")
def jn15_shared_context(spark, d):
    """Each context with the first one it shares a stretch of 60 characters with; representatives, not all pairs."""
    c = table(spark, d, "gene_candidates", "candidate_id", "context_text")
    return D.firsts_of_stretches(c, "candidate_id", "context_text", 60).groupBy("candidate_id").agg(F.min("rep").alias("shares_with"))


@query("""WITH k AS (SELECT DISTINCT candidate_id, unnest(list_transform(range(greatest(length(context_text) - 19, 0)), lambda i: substring(context_text, i + 1, 20))) AS g FROM gene_candidates WHERE context_text IS NOT NULL),
r AS (SELECT g, min(candidate_id) AS rep FROM k GROUP BY g HAVING count(*) > 1) SELECT DISTINCT candidate_id, rep AS shares_with FROM k JOIN r USING (g) WHERE candidate_id <> rep""")
def jn15_context_links(spark, d):
    """Links of the contexts that share any 20 characters: each with the first context of every shared stretch, which connects all pairs without listing them."""
    c = table(spark, d, "gene_candidates", "candidate_id", "context_text")
    return D.shared_stretches(c, "candidate_id", "context_text", 20).select("candidate_id", F.col("rep").alias("shares_with"))


_GOLD = "SELECT DISTINCT doc_id, lower(text) AS k FROM ner_entities WHERE text IS NOT NULL AND backend = 'GeneticEnricher'"
_SYS = "SELECT DISTINCT doc_id, lower(text) AS k FROM ner_entities WHERE text IS NOT NULL AND backend = 'BiomedicalNER'"
_COUNTS = f"SELECT coalesce(s.doc_id, g.doc_id) AS doc_id, count_if(s.k IS NOT NULL AND g.k IS NOT NULL) AS tp, count_if(g.k IS NULL) AS fp, count_if(s.k IS NULL) AS fn FROM ({_SYS}) s FULL OUTER JOIN ({_GOLD}) g ON s.doc_id = g.doc_id AND s.k = g.k GROUP BY 1"


def _counts(spark, d):
    e = table(spark, d, "ner_entities", "entity_id", "doc_id", "text", "backend").where("text IS NOT NULL").withColumn("k", F.lower("text"))
    return M.compare_sets(e.where("backend = 'BiomedicalNER'"), e.where("backend = 'GeneticEnricher'"), "doc_id", ["k"])


@query(_COUNTS)
def jn17_gold_match(spark, d):
    return _counts(spark, d)


@query()
def jn18_one_to_one(spark, d):
    """Greedy one-to-one fuzzy matching of two annotators' entities per document."""
    e = table(spark, d, "ner_entities", "entity_id", "doc_id", "text", "backend").where("text IS NOT NULL").withColumnRenamed("entity_id", "id")
    return M.match_texts(e.where("backend = 'BiomedicalNER'"), e.where("backend = 'GeneticEnricher'"), "doc_id", "text", 0.8)


_SEC = "CASE WHEN regexp_matches(line, '^([0-9]+[.] )?(Methods|Results|Discussion|Background|Conclusions|Eligibility)$') THEN regexp_extract(line, '([A-Z][a-z]+)$', 1) END"


@query(f"SELECT state_id, line_no, coalesce(last_value(s IGNORE NULLS) OVER (PARTITION BY state_id ORDER BY line_no ROWS UNBOUNDED PRECEDING), 'unknown') AS section FROM (SELECT state_id, line_no, {_SEC} AS s FROM {PAGES})")
def jn21_latest_header(spark, d):
    s = F.when(F.col("line").rlike(r"^([0-9]+[.] )?(Methods|Results|Discussion|Background|Conclusions|Eligibility)$"), F.regexp_extract("line", "([A-Z][a-z]+)$", 1))
    return SP.forward_fill(pages(spark, d).withColumn("s", s), "state_id", "line_no", "s", "unknown").select("state_id", "line_no", F.col("current").alias("section"))


@query(r"""WITH r AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '\b((?:Figure|Table) [0-9]+)', 1)) AS ref FROM """ + PLANTED + r""") SELECT ref, count(*) AS docs FROM r GROUP BY ref""")
def jn22_body_references(spark, d):
    r = planted(spark, d).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\b((?:Figure|Table) [0-9]+)"), 1)).alias("ref")).distinct()
    return r.groupBy("ref").agg(F.count("*").alias("docs"))


@query()
def jn22_body_reference_keys(spark, d):
    """Figures, tables and exhibits by key, each number of a range on its own, with their documents."""
    r = planted(spark, d).select("doc_id", F.explode(reference_keys(F.col("text"))).alias("key")).distinct()
    return r.groupBy("key").agg(F.count("*").alias("docs"))


# --- aggregations -------------------------------------------------------------------------


@query(r"SELECT sf, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, upper(unnest(regexp_extract_all(text, '(?:^|[^A-Za-z0-9])([A-Za-z]*[A-Z][A-Za-z0-9]+)', 1))) AS sf FROM documents) GROUP BY sf")
def ag01_token_frequency(spark, d):
    t = table(spark, d, "documents", "doc_id", "text").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"(?:^|[^A-Za-z0-9])([A-Za-z]*[A-Z][A-Za-z0-9]+)"), 1)).alias("t")).select("doc_id", F.upper("t").alias("sf"))
    return t.groupBy("sf").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs"))


@query(r"SELECT lang, w, count(*) AS n FROM (SELECT lower(lang) AS lang, unnest(regexp_extract_all(lower(text), '([a-z0-9-]{3,})', 1)) AS w FROM documents) GROUP BY ALL")
def ag02_bag_of_words(spark, d):
    t = table(spark, d, "documents", "lang", "text").select(F.lower("lang").alias("lang"), F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z0-9-]{3,})"), 1)).alias("w"))
    return t.groupBy("lang", "w").agg(F.count("*").alias("n"))


_DEF = r"""SELECT doc_id, unnest(regexp_extract_all(text, '((?:[A-Za-z][a-z]+ ){1,6}[A-Za-z][a-z]+) \(([A-Z][A-Za-z0-9-]{1,9})\)', 1)) AS lf, unnest(regexp_extract_all(text, '((?:[A-Za-z][a-z]+ ){1,6}[A-Za-z][a-z]+) \(([A-Z][A-Za-z0-9-]{1,9})\)', 2)) AS sf FROM """ + PLANTED


@query(f"""WITH d AS ({_DEF}), k AS (SELECT doc_id, lf, CASE WHEN regexp_matches(sf, '^[A-Za-z]{{2,}}[sS]$') THEN regexp_replace(sf, '[sS]$', '') ELSE sf END AS sf, 180 + least(length(lf), 50) AS score FROM d),
m AS (SELECT sf, count(*) AS mentions, count(DISTINCT doc_id) AS docs FROM k GROUP BY sf), b AS (SELECT sf, lf, score, row_number() OVER (PARTITION BY sf ORDER BY score DESC, lf DESC) AS r FROM k)
SELECT sf AS short_form, lf AS long_form, mentions, docs FROM m JOIN b USING (sf) WHERE r = 1""")
def ag03_short_form_dedup(spark, d):
    """Flagship: defined short forms of all documents, de-pluralised, with the best long form."""
    x = planted(spark, d).select("doc_id", F.explode(definitions(F.col("text"), ("parenthetical",))).alias("x")).select("doc_id", "x.*").where("style = 'parenthetical'")
    x = x.select("doc_id", D.singular(F.col("short_form")).alias("short_form"), "long_form", (F.lit(180) + F.least(F.length("long_form"), F.lit(50))).alias("score"))
    return D.merge_by_key(x, ["short_form"], F.col("score"), ["long_form"], "doc_id")


@query("""SELECT k AS entity_key, count(*) AS mentions, count(DISTINCT doc_id) AS docs, max(initial_confidence) AS confidence FROM (SELECT doc_id, initial_confidence, coalesce('symbol:' || nullif(hgnc_symbol, ''), 'alias:' || alias_of, 'text:' || lower(trim(matched_text))) AS k FROM gene_candidates) GROUP BY k""")
def ag04_entity_dedup(spark, d):
    g = table(spark, d, "gene_candidates", "doc_id", "hgnc_symbol", "alias_of", "matched_text", "initial_confidence")
    key = D.ontology_key(("symbol", F.nullif("hgnc_symbol", F.lit(""))), ("alias", F.col("alias_of")), text=F.col("matched_text"))
    return g.groupBy(key.alias("entity_key")).agg(F.count("*").alias("mentions"), F.count_distinct("doc_id").alias("docs"), F.max("initial_confidence").alias("confidence"))


@query()
def ag05_absorbed_labels(spark, d):
    """Entity texts that are parts of longer ones of the same document."""
    return D.absorbed(table(spark, d, "ner_entities", "doc_id", "text"), "doc_id", "text")


@query("""SELECT doc_id, category, text, span_id FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, category, text ORDER BY coalesce(confidence, -1) DESC, source, span_id) AS r FROM ner_spans WHERE text IS NOT NULL) WHERE r = 1""")
def ag06_merge_resolve(spark, d):
    s = table(spark, d, "ner_spans", "span_id", "doc_id", "category", "text", "confidence", "source").where("text IS NOT NULL")
    return D.first_wins(s, ["doc_id", "category", "text"], [F.desc(F.coalesce("confidence", F.lit(-1.0))), F.col("source"), F.col("span_id")]).select("doc_id", "category", "text", "span_id")


@query("SELECT doc_id, lower(matched_text) AS k, min(candidate_id) AS first_id FROM gene_candidates GROUP BY ALL")
def ag07_candidate_first_wins(spark, d):
    return table(spark, d, "gene_candidates").groupBy("doc_id", F.lower("matched_text").alias("k")).agg(F.min("candidate_id").alias("first_id"))


@query("""SELECT doc_id, hgnc_symbol, candidate_id FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, hgnc_symbol ORDER BY CASE field_type WHEN 'EXACT_MATCH' THEN 0 WHEN 'PATTERN_MATCH' THEN 1 ELSE 2 END, initial_confidence DESC NULLS LAST, candidate_id) AS r FROM gene_candidates WHERE hgnc_symbol IS NOT NULL) WHERE r = 1""")
def ag08_gene_priority(spark, d):
    g = table(spark, d, "gene_candidates", "candidate_id", "doc_id", "hgnc_symbol", "field_type", "initial_confidence").where("hgnc_symbol IS NOT NULL")
    rank = F.when(F.col("field_type") == "EXACT_MATCH", 0).when(F.col("field_type") == "PATTERN_MATCH", 1).otherwise(2)
    return D.first_wins(g, ["doc_id", "hgnc_symbol"], [rank, F.desc_nulls_last("initial_confidence"), F.col("candidate_id")]).select("doc_id", "hgnc_symbol", "candidate_id")


_BEST = "first_value({0} IGNORE NULLS) OVER (PARTITION BY hgnc_symbol ORDER BY ({0} IS NULL), initial_confidence DESC NULLS LAST, candidate_id)"


@query(f"""SELECT hgnc_symbol, full_name, locus_type, chromosome, confidence, n FROM (SELECT hgnc_symbol, {_BEST.format('full_name')} AS full_name, {_BEST.format('locus_type')} AS locus_type, {_BEST.format('chromosome')} AS chromosome,
max(initial_confidence) OVER (PARTITION BY hgnc_symbol) AS confidence, count(*) OVER (PARTITION BY hgnc_symbol) AS n, row_number() OVER (PARTITION BY hgnc_symbol ORDER BY candidate_id) AS r FROM gene_candidates WHERE hgnc_symbol IS NOT NULL) WHERE r = 1""")
def ag09_coalesced_merge(spark, d):
    """One record per gene: each field from the surest record that has it; one aggregate with map-side combining."""
    g = table(spark, d, "gene_candidates", "candidate_id", "hgnc_symbol", "full_name", "locus_type", "chromosome", "initial_confidence").where("hgnc_symbol IS NOT NULL")
    rank = F.struct(F.coalesce("initial_confidence", F.lit(-1.0)), F.negative("candidate_id"))
    best = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c)
    return g.groupBy("hgnc_symbol").agg(best("full_name"), best("locus_type"), best("chromosome"), F.max("initial_confidence").alias("confidence"), F.count("*").alias("n"))


@query()
def ag10_span_dedup(spark, d):
    """Greedy: the most confident spans of a document and category, none overlapping."""
    s = _grouped(spark, d).select("id", "doc_id", "g", F.col("pos").alias("start"), F.col("span_end").alias("end"), F.coalesce("confidence", F.lit(-1.0)).alias("score"))
    return SP.greedy_spans(s, ["doc_id", "g"])


@query(f"SELECT sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, round(sum(tp) / (sum(tp) + sum(fp)), 4) AS precision, round(sum(tp) / (sum(tp) + sum(fn)), 4) AS recall, round(2 * round(sum(tp) / (sum(tp) + sum(fp)), 4) * round(sum(tp) / (sum(tp) + sum(fn)), 4) / (round(sum(tp) / (sum(tp) + sum(fp)), 4) + round(sum(tp) / (sum(tp) + sum(fn)), 4)), 4) AS f1 FROM ({_COUNTS})")
def ag11_micro_scores(spark, d):
    return M.micro(_counts(spark, d))


@query(f"SELECT count(*) AS docs, round(avg(coalesce(tp / nullif(tp + fp, 0), 0)), 4) AS precision, round(avg(tp / (tp + fn)), 4) AS recall FROM ({_COUNTS}) WHERE tp + fn > 0")
def ag12_macro_scores(spark, d):
    return M.macro(_counts(spark, d))


@query("""WITH s AS (SELECT DISTINCT entity_type, doc_id, lower(text) AS k FROM ner_entities WHERE backend = 'BiomedicalNER' AND text IS NOT NULL), g AS (SELECT DISTINCT entity_type, doc_id, lower(text) AS k FROM ner_entities WHERE backend = 'GeneticEnricher' AND text IS NOT NULL)
SELECT entity_type, sum(n_s)::BIGINT AS system, sum(n_g)::BIGINT AS gold, sum(n_b)::BIGINT AS both FROM (SELECT coalesce(s.entity_type, g.entity_type) AS entity_type, count(s.k) AS n_s, count(g.k) AS n_g, count_if(s.k IS NOT NULL AND g.k IS NOT NULL) AS n_b FROM s FULL OUTER JOIN g ON s.entity_type = g.entity_type AND s.doc_id = g.doc_id AND s.k = g.k GROUP BY 1) GROUP BY 1""")
def ag13_scores_by_type(spark, d):
    e = table(spark, d, "ner_entities").where("text IS NOT NULL").select("entity_type", "doc_id", F.lower("text").alias("k"), "backend")
    s = e.where("backend = 'BiomedicalNER'").drop("backend").distinct().withColumn("s", F.lit(1))
    g = e.where("backend = 'GeneticEnricher'").drop("backend").distinct().withColumn("g", F.lit(1))
    return s.join(g, ["entity_type", "doc_id", "k"], "full_outer").groupBy("entity_type").agg(F.count("s").alias("system"), F.count("g").alias("gold"), F.count_if(F.col("s").isNotNull() & F.col("g").isNotNull()).alias("both"))


@query("SELECT model, count(*) AS calls, sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens, count(DISTINCT doc_id) AS docs FROM llm_usage GROUP BY model")
def ag15_usage_by_model(spark, d):
    return table(spark, d, "llm_usage").groupBy("model").agg(F.count("*").alias("calls"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.count_distinct("doc_id").alias("docs"))


@query("SELECT model, call_type, count(*) AS calls, sum(cache_read_tokens)::BIGINT AS cached FROM llm_usage GROUP BY ALL")
def ag16_usage_by_call(spark, d):
    return table(spark, d, "llm_usage").groupBy("model", "call_type").agg(F.count("*").alias("calls"), F.sum("cache_read_tokens").alias("cached"))


@query("SELECT lexicon_source, count(DISTINCT doc_id) AS docs, count(*) AS matches, round(avg(initial_confidence), 6) AS confidence FROM gene_candidates GROUP BY ALL")
def ag17_lexicon_stats(spark, d):
    return table(spark, d, "gene_candidates").groupBy("lexicon_source").agg(F.count_distinct("doc_id").alias("docs"), F.count("*").alias("matches"), F.round(F.avg("initial_confidence"), 6).alias("confidence"))


@query("SELECT backend, count(*) AS queries, count(normalized) AS results, CASE WHEN count(*) > 0 THEN round(count(normalized) / count(*), 4) END AS ratio FROM ner_entities GROUP BY backend")
def ag18_source_stats(spark, d):
    return table(spark, d, "ner_entities").groupBy("backend").agg(F.count("*").alias("queries"), F.count("normalized").alias("results"), S.safe_ratio(F.count("normalized"), F.count("*")).alias("ratio"))


@query("SELECT l.symbol FROM gene_lexicon l LEFT JOIN gene_candidates g ON g.hgnc_symbol = l.symbol GROUP BY l.symbol HAVING count(g.candidate_id) = 0")
def ag19_unused_entries(spark, d):
    g = table(spark, d, "gene_candidates").groupBy(F.col("hgnc_symbol").alias("symbol")).agg(F.count("*").alias("n"))
    return table(spark, d, "gene_lexicon").select("symbol").join(g, "symbol", "left").where("n IS NULL").select("symbol")


@query(f"WITH m AS (SELECT state_id, page, regexp_replace(trim(lower(line)), '[0-9]+', '#', 'g') AS k FROM {PAGES}) SELECT state_id, k, count(*) AS n, count(DISTINCT page) AS on_pages FROM m GROUP BY ALL HAVING count(*) >= 3 AND count(DISTINCT page) >= 3")
def ag22_repeated_lines(spark, d):
    m = pages(spark, d).select("state_id", "page", F.regexp_replace(F.trim(F.lower("line")), "[0-9]+", "#").alias("k"))
    return m.groupBy("state_id", "k").agg(F.count("*").alias("n"), F.count_distinct("page").alias("on_pages")).where("n >= 3 AND on_pages >= 3")


@query("""SELECT status, count(*) AS runs, count(DISTINCT doc_id) AS docs, count_if(full_text IS NULL) AS without_text, count_if(status = 'failed' AND full_text IS NOT NULL) AS failed_with_text, count_if(coalesce(finished_at < started_at, false)) AS ended_early,
count_if(status = 'completed' AND finished_at IS NULL) AS completed_unfinished, count_if(coalesce(page_count, 0) <> len(regexp_extract_all(coalesce(full_text_with_pages, ''), '--- Page [0-9]+ ---')) AND full_text_with_pages IS NOT NULL) AS pages_differ FROM pipeline_state GROUP BY 1""")
def ag24_run_invariants(spark, d):
    """Runs by status, and how many break each invariant."""
    p = table(spark, d, "pipeline_state", "status", "doc_id", "full_text", "full_text_with_pages", "started_at", "finished_at", "page_count")
    counted = F.regexp_count(F.coalesce("full_text_with_pages", F.lit("")), F.lit("--- Page [0-9]+ ---"))
    return p.groupBy("status").agg(
        F.count("*").alias("runs"), F.count_distinct("doc_id").alias("docs"), F.count_if(F.col("full_text").isNull()).alias("without_text"), F.count_if((F.col("status") == "failed") & F.col("full_text").isNotNull()).alias("failed_with_text"),
        F.count_if(F.coalesce(F.col("finished_at") < F.col("started_at"), F.lit(False))).alias("ended_early"), F.count_if((F.col("status") == "completed") & F.col("finished_at").isNull()).alias("completed_unfinished"),
        F.count_if((F.coalesce("page_count", F.lit(0)) != counted) & F.col("full_text_with_pages").isNotNull()).alias("pages_differ"),
    )


@query("SELECT category, entity_type, count(*) AS n, count(DISTINCT lower(text)) AS texts FROM ner_spans GROUP BY ALL")
def ag25_ner_rollup(spark, d):
    return table(spark, d, "ner_spans").groupBy("category", "entity_type").agg(F.count("*").alias("n"), F.count_distinct(F.lower("text")).alias("texts"))


@query()
def ag26_regression_hash(spark, d):
    return D.fingerprint(table(spark, d, "ner_spans"), ["span_id", "doc_id", "text", "category", "confidence"])


@query("""WITH v AS (SELECT doc_id, structured_data.data_type AS t, min(structured_data.value) AS lo, max(structured_data.value) AS hi, count(DISTINCT structured_data.value) AS n FROM feasibility_entries WHERE structured_data.value <> '' GROUP BY ALL) SELECT doc_id, t AS data_type, lo, hi, n FROM v WHERE n > 1""")
def ag27_contradictions(spark, d):
    """Documents that state different values of one measure: one row per measure instead of all pairs."""
    f = table(spark, d, "feasibility_entries", "doc_id", "structured_data").select("doc_id", F.col("structured_data.data_type").alias("data_type"), F.col("structured_data.value").alias("v")).where("v <> ''")
    return f.groupBy("doc_id", "data_type").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count_distinct("v").alias("n")).where("n > 1")


@query("""WITH k AS (SELECT DISTINCT doc_id, lower(text) AS t FROM ner_entities WHERE text IS NOT NULL) SELECT doc_id, t FROM k WHERE NOT (t LIKE '%s' AND EXISTS (SELECT 1 FROM k x WHERE x.doc_id = k.doc_id AND x.t || 's' = k.t))""")
def ag28_plural_dedup(spark, d):
    k = table(spark, d, "ner_entities").where("text IS NOT NULL").select("doc_id", F.lower("text").alias("t")).distinct()
    return k.join(k.select("doc_id", F.concat("t", F.lit("s")).alias("t")), ["doc_id", "t"], "left_anti")


@query(f"SELECT state_id, page, count(*) AS lines, median(length(line)) AS median_length, max(length(line)) AS widest FROM {PAGES} GROUP BY ALL")
def ag29_page_geometry(spark, d):
    return pages(spark, d).groupBy("state_id", "page").agg(F.count("*").alias("lines"), F.median(F.length("line")).alias("median_length"), F.max(F.length("line")).cast("bigint").alias("widest"))


@query("SELECT doc_id, entity_type, count(*) AS n FROM ner_entities GROUP BY GROUPING SETS ((doc_id, entity_type), (doc_id), ())")
def ag30_grouping_sets(spark, d):
    e = table(spark, d, "ner_entities", "doc_id", "entity_type")
    return e.rollup("doc_id", "entity_type").agg(F.count("*").alias("n"))


# --- windows ------------------------------------------------------------------------------


@query(f"""WITH d AS ({_DEF}), c AS (SELECT sf, lf, count(*) AS n FROM d GROUP BY ALL) SELECT sf, lf, n FROM (SELECT *, row_number() OVER (PARTITION BY sf ORDER BY n DESC, lf) AS r FROM c) WHERE r <= 2""")
def wn01_top_long_forms(spark, d):
    x = planted(spark, d).select(F.explode(definitions(F.col("text"), ("parenthetical",))).alias("x")).select("x.*").where("style = 'parenthetical'").groupBy(F.col("short_form").alias("sf"), F.col("long_form").alias("lf")).agg(F.count("*").alias("n"))
    return x.withColumn("r", F.row_number().over(W.partitionBy("sf").orderBy(F.desc("n"), "lf"))).where("r <= 2").drop("r")


@query("SELECT doc_id, entity_type, t AS text, n FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, entity_type ORDER BY n DESC, t) AS r FROM (SELECT doc_id, entity_type, lower(text) AS t, count(*) AS n FROM ner_entities WHERE text IS NOT NULL GROUP BY ALL)) WHERE r <= 2")
def wn02_top_entities(spark, d):
    n = table(spark, d, "ner_entities").where("text IS NOT NULL").groupBy("doc_id", "entity_type", F.lower("text").alias("text")).agg(F.count("*").alias("n"))
    return n.withColumn("r", F.row_number().over(W.partitionBy("doc_id", "entity_type").orderBy(F.desc("n"), "text"))).where("r <= 2").drop("r")


@query("""SELECT doc_id, hgnc_symbol, arg_max(full_name, initial_confidence * 1000000 + candidate_id / 1000000) AS full_name FROM gene_candidates WHERE full_name IS NOT NULL AND initial_confidence IS NOT NULL AND hgnc_symbol IS NOT NULL GROUP BY ALL""")
def wn03_best_expansion(spark, d):
    g = table(spark, d, "gene_candidates").where("full_name IS NOT NULL AND initial_confidence IS NOT NULL AND hgnc_symbol IS NOT NULL")
    return g.groupBy("doc_id", "hgnc_symbol").agg(F.max_by("full_name", F.struct("initial_confidence", "candidate_id")).alias("full_name"))


@query(f"SELECT doc_id, block_no, right(coalesce(lag(block) OVER (PARTITION BY doc_id ORDER BY block_no), ''), 140) AS carried FROM {BLOCKS}")
def wn04_carry_over(spark, d):
    prev = F.coalesce(F.lag("block").over(W.partitionBy("doc_id").orderBy("block_no")), F.lit(""))
    return blocks(spark, d).select("doc_id", "block_no", F.right(prev, F.lit(140)).alias("carried"))


@query("SELECT doc_id, category, span_id FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, category, lower(text) ORDER BY span_start, span_id) AS r FROM ner_spans WHERE span_start IS NOT NULL) WHERE r = 1")
def wn06_first_seen(spark, d):
    s = table(spark, d, "ner_spans", "span_id", "doc_id", "category", "text", "span_start").where("span_start IS NOT NULL").withColumn("k", F.lower("text"))
    return D.first_wins(s, ["doc_id", "category", "k"], [F.col("span_start"), F.col("span_id")]).select("doc_id", "category", "span_id")


@query("SELECT doc_id, span_id FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY span_start, span_id) AS r FROM ner_spans WHERE span_start IS NOT NULL) WHERE r <= 200")
def wn07_budget(spark, d):
    s = table(spark, d, "ner_spans", "span_id", "doc_id", "span_start").where("span_start IS NOT NULL")
    return s.withColumn("r", F.row_number().over(W.partitionBy("doc_id").orderBy("span_start", "span_id"))).where("r <= 200").select("doc_id", "span_id")


@query("""WITH o AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events), i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM o)
SELECT user_id, island::BIGINT AS island, count(*) AS n FROM i GROUP BY ALL""")
def wn08_sessions(spark, d):
    e = table(spark, d, "events", "event_id", "user_id", "ts")
    gap = F.col("ts").cast("timestamp") - F.lag("ts").over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("timestamp") > F.expr("INTERVAL 30 MINUTE")
    return SP.islands(e.withColumn("new", F.coalesce(gap, F.lit(True))), ["user_id"], ["ts", "event_id"], F.col("new")).groupBy("user_id", F.col("island").cast("bigint").alias("island")).agg(F.count("*").alias("n"))


@query("SELECT span_id, doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY category NULLS FIRST, span_start NULLS FIRST, span_end NULLS FIRST, confidence DESC NULLS LAST, lower(text) NULLS FIRST, source NULLS FIRST, span_id) AS place FROM ner_spans")
def wn13_ordered_output(spark, d):
    """The place of every mention in its document's output: seven fields decide."""
    order = W.partitionBy("doc_id").orderBy("category", "span_start", "span_end", F.desc_nulls_last("confidence"), F.lower("text"), "source", "span_id")
    return table(spark, d, "ner_spans", "span_id", "doc_id", "category", "span_start", "span_end", "confidence", "text", "source").select("span_id", "doc_id", F.row_number().over(order).cast("bigint").alias("place"))


@query("SELECT doc_id, left(text, 200) AS start FROM documents ORDER BY doc_id LIMIT 10")
def wn14_examples(spark, d):
    return table(spark, d, "documents").orderBy("doc_id").limit(10).select("doc_id", F.left("text", F.lit(200)).alias("start"))


@query("WITH e AS (SELECT DISTINCT doc_id AS a, hgnc_symbol AS b FROM gene_candidates WHERE hgnc_symbol <> '') SELECT b AS node, count(*) AS incoming FROM e GROUP BY b")
def wn15_graph_degree(spark, d):
    e = table(spark, d, "gene_candidates").where("hgnc_symbol <> ''").select(F.col("doc_id").alias("a"), F.col("hgnc_symbol").alias("b")).distinct()
    return e.groupBy(F.col("b").alias("node")).agg(F.count("*").alias("incoming"))


# --- set operations --------------------------------------------------------------------------


@query("SELECT doc_id FROM ner_entities UNION ALL SELECT doc_id FROM ner_spans")
def st01_union_all(spark, d):
    return table(spark, d, "ner_entities", "doc_id").unionByName(table(spark, d, "ner_spans", "doc_id"))


@query("SELECT DISTINCT doc_id, category FROM ner_spans")
def st02_distinct(spark, d):
    return table(spark, d, "ner_spans", "doc_id", "category").distinct()


@query("SELECT doc_id FROM ner_spans EXCEPT SELECT doc_id FROM gene_candidates")
def st03_except(spark, d):
    return table(spark, d, "ner_spans", "doc_id").distinct().join(table(spark, d, "gene_candidates", "doc_id"), "doc_id", "left_anti")


@query("SELECT doc_id FROM ner_spans INTERSECT SELECT doc_id FROM gene_candidates")
def st04_intersect(spark, d):
    return table(spark, d, "ner_spans", "doc_id").intersect(table(spark, d, "gene_candidates", "doc_id"))


@query("SELECT doc_id, 'span' AS origin, text FROM ner_spans UNION ALL SELECT doc_id, 'entity', text FROM ner_entities")
def st05_merge_results(spark, d):
    s, e = table(spark, d, "ner_spans", "doc_id", "text"), table(spark, d, "ner_entities", "doc_id", "text")
    return s.withColumn("origin", F.lit("span")).unionByName(e.withColumn("origin", F.lit("entity"))).select("doc_id", "origin", "text")


@query("SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.n AS spans, b.n AS entities FROM (SELECT doc_id, count(*) AS n FROM ner_spans GROUP BY 1) a FULL OUTER JOIN (SELECT doc_id, count(*) AS n FROM ner_entities GROUP BY 1) b ON a.doc_id = b.doc_id")
def st06_doc_union(spark, d):
    a = table(spark, d, "ner_spans", "doc_id").groupBy("doc_id").agg(F.count("*").alias("spans"))
    return a.join(table(spark, d, "ner_entities", "doc_id").groupBy("doc_id").agg(F.count("*").alias("entities")), "doc_id", "full_outer")


QUERIES, SQL = query.queries, query.sql
