"""Queries of the text projections and predicates (survey 2.3 and 2.4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.functions import predicates as P
from medloom.functions import scores as S
from medloom.functions import text as X
from medloom.registry import BLOCKS, PLANTED, Registry, blocks, planted
from medloom.session import table

query = Registry()


def _spans(spark: SparkSession, d: str, *extra: str) -> DataFrame:
    return table(spark, d, "ner_spans", "span_id", "text", *extra)


@query(r"SELECT doc_id, trim(regexp_replace(text, '[\s ]+', ' ', 'g')) AS clean FROM documents".replace(" ]", X.NBSP + "]"))
def pr01_clean_whitespace(spark, d):
    return table(spark, d, "documents").select("doc_id", X.clean_whitespace(F.col("text")).alias("clean"))


@query()
def pr02_dehyphenate(spark, d):
    return planted(spark, d).select("doc_id", X.dehyphenate(F.col("text")).alias("joined"))


@query(r"""SELECT span_id, trim(regexp_replace(regexp_extract(text, '^(.*?)(?:[,;:.()]| which | that | who | was | were | is | are |$)', 1), '(?: (?:and|or|of|the|with|in))+ *$', '')) AS head FROM ner_spans""")
def pr03_clause_cut(spark, d):
    return _spans(spark, d).select("span_id", X.truncate_at_clause(F.col("text")).alias("head"))


@query()
def pr04_long_form(spark, d):
    return _spans(spark, d).select("span_id", X.long_form(F.col("text")).alias("long_form"))


@query(r"""SELECT candidate_id, lower(trim(regexp_replace(regexp_replace(translate(matched_text, '‐‑‒–—−', '------'), ' *- *', '-', 'g'), '[\s ]+', ' ', 'g'), ' ')) AS dedup_key FROM gene_candidates""".replace(" ]", X.NBSP + "]"))
def pr05_dedup_key(spark, d):
    return table(spark, d, "gene_candidates").select("candidate_id", X.dedup_key(F.col("matched_text")).alias("dedup_key"))


@query()
def pr06_short_form(spark, d):
    return table(spark, d, "gene_candidates").select("candidate_id", X.short_form(F.col("matched_text")).alias("short_form"))


@query(r"""SELECT state_id, regexp_replace(full_text, '([a-z])-\r?\n([a-z])', '\1\2', 'g') AS joined FROM pipeline_state""")
def pr07_join_line_breaks(spark, d):
    return table(spark, d, "pipeline_state").select("state_id", F.regexp_replace("full_text", r"([a-z])-\r?\n([a-z])", "$1$2").alias("joined"))


@query(r"""SELECT doc_id, block_no, trim(regexp_replace(regexp_replace(block, '^\|+ *', ''), '[\s]+', ' ', 'g')) AS clean FROM """ + BLOCKS + r""" WHERE NOT (length(regexp_replace(block, '\s', '', 'g')) >= 10 AND 2 * length(regexp_replace(block, '[^A-Za-z]', '', 'g')) < length(regexp_replace(block, '\s', '', 'g')))""")
def pr08_clean_blocks(spark, d):
    return blocks(spark, d).where(~P.garbled(F.col("block"))).select("doc_id", "block_no", F.trim(F.regexp_replace(F.regexp_replace("block", r"^\|+ *", ""), r"\s+", " ")).alias("clean"))


@query(r"""SELECT span_id, regexp_replace(trim(regexp_replace(lower(text), '[\s ]+', ' ', 'g')), '[0-9]+', '#', 'g') AS masked FROM ner_spans""".replace(" ]", X.NBSP + "]"))
def pr10_mask_digits(spark, d):
    return _spans(spark, d).select("span_id", X.mask_digits(F.col("text")).alias("masked"))


def _places(part: str, source: str) -> str:
    """(doc_id, text, p) of every place of a part, in SQL."""
    return f"(SELECT doc_id, text, unnest(list_filter(range(length(text)), lambda i: substr(text, i + 1, {len(part)}) = '{part}')) AS p FROM {source})"


@query(f"SELECT doc_id, p::INT AS place, substring(text, (greatest(p - 40, 0) + 1)::INT, (p - greatest(p - 40, 0) + 1 + 40)::INT) AS around FROM {_places('(', PLANTED)}")
def pr11_context_window(spark, d):
    """What stands round every opening bracket."""
    at = planted(spark, d).select("doc_id", "text", F.explode(X.places(F.col("text"), "(")).alias("place"))
    return at.select("doc_id", "place", X.window_around(F.col("text"), F.col("place"), F.lit(1), 40).alias("around"))


@query(r"""SELECT term_id, translate(preferred_label, 'áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ', 'aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNC') AS plain,
regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(preferred_label, '\banemia', 'anaemia', 'g'), '\bedema', 'oedema', 'g'), '\btumor', 'tumour', 'g'), '\bhemo', 'haemo', 'g'), '\bestrogen', 'oestrogen', 'g'), '\besoph', 'oesoph', 'g') AS british FROM term_lexicon""")
def pr12_spelling_variants(spark, d):
    c = F.col("preferred_label")
    return table(spark, d, "term_lexicon").select("term_id", X.strip_accents(c).alias("plain"), X.british(c).alias("british"))


@query(r"""SELECT term_id, CASE WHEN length(preferred_label) >= 5 AND NOT regexp_matches(preferred_label, '^[A-Z0-9-]+$') THEN CASE WHEN regexp_matches(preferred_label, '[^aeiou]y$') THEN regexp_replace(preferred_label, 'y$', '') || 'ies'
WHEN regexp_matches(preferred_label, '(s|x|ch|sh)$') THEN preferred_label || 'es' ELSE preferred_label || 's' END END AS many FROM term_lexicon""")
def pr13_plural(spark, d):
    return table(spark, d, "term_lexicon").select("term_id", X.plural(F.col("preferred_label")).alias("many"))


@query(r"""SELECT entity_id, regexp_replace(trim(regexp_replace(lower(normalized), '[\s ]+', ' ', 'g')), '^[^a-z0-9]+|[^a-z0-9]+$', '', 'g') AS term_key FROM ner_entities""".replace(" ]", X.NBSP + "]"))
def pr14_term_key(spark, d):
    return table(spark, d, "ner_entities").select("entity_id", X.term_key(F.col("normalized")).alias("term_key"))


@query(r"""SELECT doc_id, 'c.' || upper(substr(v, 3)) AS variant FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\b(c\.[0-9]+[ACGTacgt]>[ACGTacgt])', 1)) AS v FROM """ + PLANTED + ")")
def pr15_hgvs(spark, d):
    v = F.explode(F.regexp_extract_all("text", F.lit(r"\b(c\.[0-9]+[ACGTacgt]>[ACGTacgt])"), 1))
    return planted(spark, d).select("doc_id", v.alias("v")).select("doc_id", X.hgvs(F.col("v")).alias("variant"))


@query(r"""SELECT doc_id, regexp_replace('doi 10.1000/ ' || doc_id || ' end', '(10\.[0-9]{4,9}/) +([^ ]+)', '\1\2', 'g') AS repaired FROM documents""")
def pr16_repair_doi(spark, d):
    return table(spark, d, "documents").select("doc_id", X.repair_doi(F.concat(F.lit("doi 10.1000/ "), "doc_id", F.lit(" end"))).alias("repaired"))


@query(r"""SELECT doc_id, block_no, substring(b, 1, length(b) - greatest(0, least(length(b) - length(regexp_replace(b, '\)+$', '')), (length(b) - length(replace(b, ')', ''))) - (length(b) - length(replace(b, '(', '')))))) AS balanced
FROM (SELECT doc_id, block_no, block || ')' AS b FROM """ + BLOCKS + ")")
def pr17_balance_brackets(spark, d):
    return blocks(spark, d).select("doc_id", "block_no", X.balance_brackets(F.concat("block", F.lit(")"))).alias("balanced"))


@query(r"""WITH v AS (SELECT entry_id, regexp_replace(regexp_replace(structured_data.value, '([0-9]),([0-9]{3})', '\1\2', 'g'), '([0-9]),([0-9]{3})', '\1\2', 'g') AS x FROM feasibility_entries)
SELECT entry_id, CASE WHEN regexp_extract(x, '([0-9.]+) ?(?:in|per|/) ?([0-9]+)', 1) <> '' AND try_cast(regexp_extract(x, '([0-9.]+) ?(?:in|per|/) ?([0-9]+)', 2) AS DOUBLE) > 0
THEN round(try_cast(regexp_extract(x, '([0-9.]+) ?(?:in|per|/) ?([0-9]+)', 1) AS DOUBLE) / try_cast(regexp_extract(x, '([0-9.]+) ?(?:in|per|/) ?([0-9]+)', 2) AS DOUBLE) * 1e6, 4)
WHEN regexp_extract(x, '([0-9.]+) ?%', 1) <> '' THEN round(try_cast(regexp_extract(x, '([0-9.]+) ?%', 1) AS DOUBLE) * 1e4, 4) END AS rate FROM v""")
def pr18_per_million(spark, d):
    return table(spark, d, "feasibility_entries").select("entry_id", X.per_million(F.col("structured_data.value")).alias("rate"))


@query(r"""SELECT n_nationkey, CASE WHEN k IN ('us','usa','unitedstates') THEN 'United States' WHEN k IN ('uk','greatbritain','unitedkingdom') THEN 'United Kingdom' ELSE array_to_string(list_transform(string_split(lower(n_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') END AS country
FROM (SELECT n_nationkey, n_name, lower(regexp_replace(n_name, '[. ]', '', 'g')) AS k FROM nation)""")
def pr19_country(spark, d):
    return table(spark, d, "nation").select("n_nationkey", X.country(F.col("n_name")).alias("country"))


@query(r"""SELECT doc_id, CASE WHEN try_cast(g AS INT) IS NOT NULL THEN try_cast(g AS INT) ELSE CASE upper(g) WHEN 'I' THEN 1 WHEN 'II' THEN 2 WHEN 'III' THEN 3 WHEN 'IV' THEN 4 WHEN 'V' THEN 5 END END AS grade
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(?:NYHA|ECOG|type) ([0-9IV]+)\b', 1)) AS g FROM """ + PLANTED + ")")
def pr20_grade(spark, d):
    g = F.explode(F.regexp_extract_all("text", F.lit(r"(?:NYHA|ECOG|type) ([0-9IV]+)\b"), 1))
    return planted(spark, d).select("doc_id", g.alias("g")).select("doc_id", X.grade(F.col("g")).alias("grade"))


@query("SELECT doc_id, sha256(text) AS full_hash, substring(sha256(text), 1, 16) AS short_hash FROM documents")
def pr21_fingerprints(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("full_hash"), X.short_hash(F.col("text")).alias("short_hash"))


@query("SELECT span_id, substring(sha256(concat_ws('|', doc_id, category, coalesce(cast(span_start AS VARCHAR), ''), coalesce(cast(span_end AS VARCHAR), ''), text)), 1, 16) AS result_id FROM ner_spans")
def pr22_result_id(spark, d):
    parts = F.concat_ws("|", "doc_id", "category", F.coalesce(F.col("span_start").cast("string"), F.lit("")), F.coalesce(F.col("span_end").cast("string"), F.lit("")), "text")
    return _spans(spark, d, "doc_id", "category", "span_start", "span_end").select("span_id", X.short_hash(parts).alias("result_id"))


@query(r"SELECT doc_id, substring(regexp_replace(regexp_replace(title, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 60) AS name FROM documents")
def pr23_file_name(spark, d):
    return table(spark, d, "documents").select("doc_id", X.file_name(F.col("title")).alias("name"))


@query(r"SELECT symbol, substring(md5(lower(trim(full_name))), 1, 12) AS k FROM gene_lexicon")
def sk9_cache_key(spark, d):
    return table(spark, d, "gene_lexicon").select("symbol", F.substring(F.md5(F.lower(F.trim("full_name"))), 1, 12).alias("k"))


# --- predicates -------------------------------------------------------------


@query(r"""SELECT candidate_id, length(matched_text) BETWEEN 2 AND 10 AND regexp_matches(matched_text, '[A-Z]') AND NOT regexp_matches(matched_text, '^[0-9]+$') AND regexp_matches(matched_text, '^[A-Za-z0-9-]+(?: [A-Za-z0-9-]+){0,2}$') AS ok FROM gene_candidates""")
def fl01_short_form_like(spark, d):
    return table(spark, d, "gene_candidates").select("candidate_id", P.looks_like_short_form(F.col("matched_text")).alias("ok"))


@query(r"""SELECT span_id FROM ner_spans WHERE regexp_matches(text, '[0-9] ?(?:mg|g|kg|mL|L|weeks|days|months|years|%)$') OR (length(regexp_replace(text, '[^0-9]', '', 'g')) >= length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AND length(regexp_replace(text, '[^0-9]', '', 'g')) > 0)""")
def fl03_measurements(spark, d):
    return _spans(spark, d).where(P.looks_like_measurement(F.col("text"))).select("span_id")


@query()
def fl04_letters_in_order(spark, d):
    return table(spark, d, "gene_lexicon").select("symbol", P.is_subsequence(F.col("symbol"), F.col("full_name")).alias("ok"))


@query(r"""SELECT term_id, array_to_string(list_transform(list_filter(regexp_split_to_array(trim(preferred_label), '[ -]+'), lambda w: w <> ''), lambda w: upper(w[1])), '') AS initials FROM term_lexicon""")
def fl05_initials(spark, d):
    return table(spark, d, "term_lexicon").select("term_id", P.initials(F.col("preferred_label")).alias("initials"))


@query(r"SELECT candidate_id FROM gene_candidates WHERE regexp_matches(context_text, '[0-9%=]')")
def fl07_numeric_evidence(spark, d):
    return table(spark, d, "gene_candidates").where(P.numeric_evidence(F.col("context_text"))).select("candidate_id")


@query(r"""SELECT c.candidate_id FROM gene_candidates c WHERE c.matched_text NOT IN (SELECT symbol FROM gene_lexicon) AND length(c.matched_text) >= 3""")
def fl08_not_blacklisted(spark, d):
    known = table(spark, d, "gene_lexicon").select(F.col("symbol").alias("matched_text"))
    return table(spark, d, "gene_candidates", "candidate_id", "matched_text").join(known, "matched_text", "left_anti").where(F.length("matched_text") >= 3).select("candidate_id")


@query(r"""WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '\b([A-Z][A-Z0-9]{1,5})\b', 1)) AS sf FROM """ + PLANTED + r"""),
n AS (SELECT doc_id, sf, count(*) AS hits FROM m GROUP BY ALL), k AS (SELECT DISTINCT upper(abbreviation) AS sf FROM term_lexicon WHERE abbreviation IS NOT NULL)
SELECT doc_id, sf, hits FROM n WHERE hits >= 2 OR sf IN (SELECT sf FROM k)""")
def fl10_corroborated(spark, d):
    m = planted(spark, d).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\b([A-Z][A-Z0-9]{1,5})\b"), 1)).alias("sf")).groupBy("doc_id", "sf").agg(F.count("*").alias("hits"))
    known = table(spark, d, "term_lexicon").where("abbreviation IS NOT NULL").select(F.upper("abbreviation").alias("sf"), F.lit(True).alias("known")).distinct()
    return m.join(known, "sf", "left").where((F.col("hits") >= 2) | F.col("known")).select("doc_id", "sf", "hits")


@query(r"""SELECT candidate_id, (SELECT count(*) FROM (VALUES ('expression'),('variants'),('antibodies'),('loss'),('sequencing'),('change')) v(w) WHERE strpos(lower(context_text), w) > 0) AS cues FROM gene_candidates WHERE context_text IS NOT NULL""")
def fl13_context_cues(spark, d):
    words = ["expression", "variants", "antibodies", "loss", "sequencing", "change"]
    n = sum(F.lower("context_text").contains(w).cast("bigint") for w in words)
    return table(spark, d, "gene_candidates").where("context_text IS NOT NULL").select("candidate_id", n.alias("cues"))


@query(f"SELECT doc_id, p::INT AS place, regexp_matches(substring(text, (greatest(p - 100, 0) + 1)::INT, (p - greatest(p - 100, 0) + 50)::INT), 'prevalence|incidence|per million') AS ok FROM {_places('%', PLANTED)}")
def fl18_anchor_near(spark, d):
    """Whether an anchor stands near each percentage."""
    at = planted(spark, d).select("doc_id", "text", F.explode(X.places(F.col("text"), "%")).alias("place"))
    return at.select("doc_id", "place", P.near(F.col("text"), F.col("place"), "prevalence|incidence|per million").alias("ok"))


@query(r"""SELECT doc_id, v, CASE WHEN regexp_matches(v, '^NCT[0-9]{8}$') THEN 'NCT' WHEN regexp_matches(v, '^PMC[0-9]{5,8}$') THEN 'PMCID' WHEN regexp_matches(v, '^[1-9][0-9]{5,8}$') THEN 'PMID' WHEN regexp_matches(v, '^10\.[0-9]{4,9}/[^ ]+$') THEN 'DOI' WHEN regexp_matches(v, '^https?://[A-Za-z0-9.-]+\.[a-z]{2,}(?:/.*)?$') THEN 'URL' END AS kind
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(NCT[0-9]+|PMC[0-9]+|[0-9]{6,9}|10\.[0-9]{4,9}/[a-z0-9]+|https?://[A-Za-z0-9./-]+)', 1)) AS v FROM """ + PLANTED + ")")
def fl20_identifier_kind(spark, d):
    v = F.explode(F.regexp_extract_all("text", F.lit(r"(NCT[0-9]+|PMC[0-9]+|[0-9]{6,9}|10\.[0-9]{4,9}/[a-z0-9]+|https?://[A-Za-z0-9./-]+)"), 1))
    return planted(spark, d).select("doc_id", v.alias("v")).select("doc_id", "v", P.identifier_kind(F.col("v")).alias("kind"))


@query(r"""SELECT doc_id, v FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\b([A-Z][a-z]+ [A-Z][a-z]+), (?:MD|PhD)', 1)) AS v FROM """ + PLANTED + r""") WHERE length(v) BETWEEN 5 AND 60 AND NOT regexp_matches(lower(v), '\b(university|hospital|institute|department|center|centre)\b')""")
def fl21_person_names(spark, d):
    v = F.explode(F.regexp_extract_all("text", F.lit(r"\b([A-Z][a-z]+ [A-Z][a-z]+), (?:MD|PhD)"), 1))
    return planted(spark, d).select("doc_id", v.alias("v")).where(P.person_name(F.col("v"))).select("doc_id", "v")


_WORDS = lambda ws: "(?:^|[^a-z])(?:" + "|".join(ws) + ")(?:[^a-z]|$)"


@query(f"""SELECT doc_id, place, CASE WHEN regexp_matches(b, '{P.NO_FAMILY}') THEN 'negated' WHEN regexp_matches(b, '{_WORDS(P.FAMILY)}') THEN 'family' WHEN regexp_matches(b, '{_WORDS(P.HYPOTHETICAL)}') THEN 'possible' WHEN regexp_matches(b, '{_WORDS(P.NEGATIONS)}') THEN 'negated' ELSE 'present' END AS status
FROM (SELECT doc_id, p::INT AS place, regexp_extract(lower(substring(text, (greatest(p - 50, 0) + 1)::INT, (p - greatest(p - 50, 0))::INT)), '{P.SCOPE}', 1) AS b FROM {_places('syndrome', PLANTED)})""")
def fl22_assertion(spark, d):
    """The class of every mention of a syndrome by what precedes it in its clause."""
    at = planted(spark, d).select("doc_id", "text", F.explode(X.places(F.col("text"), "syndrome")).alias("place"))
    lo = F.greatest(F.col("place") - 50, F.lit(0))
    return at.select("doc_id", "place", P.assertion(F.substring(F.col("text"), lo + 1, F.col("place") - lo)).alias("status"))


@query(r"""SELECT doc_id, block_no, length(regexp_replace(block, '\s', '', 'g')) >= 10 AND 2 * length(regexp_replace(block, '[^A-Za-z]', '', 'g')) < length(regexp_replace(block, '\s', '', 'g')) AS noise FROM """ + BLOCKS)
def fl23_garbled(spark, d):
    return blocks(spark, d).select("doc_id", "block_no", P.garbled(F.col("block")).alias("noise"))


@query(r"""SELECT state_id, line_no FROM (SELECT state_id, (unnest(range(len(l))) + 1)::INT AS line_no, rtrim(unnest(l), chr(13) || ' ') AS b FROM (SELECT state_id, string_split(full_text, chr(10)) AS l FROM pipeline_state WHERE full_text IS NOT NULL))
WHERE length(trim(b)) BETWEEN 3 AND 60 AND NOT regexp_matches(trim(b), '[.;,]$') AND (regexp_matches(trim(b), '^[A-Z0-9 &-]{3,}$') OR regexp_matches(trim(b), '^[A-Z][^.]*:$') OR regexp_matches(trim(b), '^[0-9]+\.? [A-Z][a-z]+$') OR regexp_matches(trim(b), '^(?:[A-Z][a-z]+)(?: [A-Z][a-z]+){0,4}$'))""")
def fl24_section_headers(spark, d):
    cut = table(spark, d, "pipeline_state").select("state_id", F.posexplode(F.split("full_text", "\n")).alias("i", "x"))
    return cut.select("state_id", (F.col("i") + 1).alias("line_no"), F.rtrim("x", F.lit("\r ")).alias("b")).where(P.is_header(F.col("b"))).select("state_id", "line_no")


@query("SELECT entity_id, score >= 0.5 AS passes FROM ner_entities WHERE score IS NOT NULL")
def fl27_threshold(spark, d):
    return table(spark, d, "ner_entities").where("score IS NOT NULL").select("entity_id", (F.col("score") >= 0.5).alias("passes"))


@query("""SELECT e.entity_id FROM ner_entities e WHERE e.text IS NOT NULL AND e.doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM gene_candidates g WHERE g.doc_id = e.doc_id AND upper(g.matched_text) = upper(e.text)) AND NOT EXISTS (SELECT 1 FROM ner_spans s WHERE s.doc_id = e.doc_id AND lower(s.text) = lower(e.text))""")
def fl28_cross_entity(spark, d):
    e = table(spark, d, "ner_entities", "entity_id", "doc_id", "text").where("text IS NOT NULL AND doc_id IS NOT NULL").withColumn("u", F.upper("text")).withColumn("l", F.lower("text"))
    genes = table(spark, d, "gene_candidates").select("doc_id", F.upper("matched_text").alias("u")).distinct()
    spans = table(spark, d, "ner_spans").select("doc_id", F.lower("text").alias("l")).distinct()
    return e.join(genes, ["doc_id", "u"], "left_anti").join(spans, ["doc_id", "l"], "left_anti").select("entity_id")


# --- scoring -----------------------------------------------------------------


@query("""SELECT entity_id, round(least(0.95, greatest(0.1, 0.5 + (CASE WHEN category = 'clinical' THEN 0.15 ELSE 0 END) + least(coalesce(score, 0) * 0.3, 0.3) + (CASE WHEN normalized IS NOT NULL THEN 0.1 ELSE 0 END) - (CASE WHEN text LIKE '%no %' THEN 0.2 ELSE 0 END))), 6) AS confidence FROM ner_entities WHERE text IS NOT NULL AND category IS NOT NULL""")
def ma01_unified_confidence(spark, d):
    e = table(spark, d, "ner_entities").where("text IS NOT NULL AND category IS NOT NULL")
    no = F.lit(False)
    return e.select("entity_id", F.round(S.unified_confidence(F.col("category") == "clinical", F.coalesce("score", F.lit(0.0)) * 0.3, no, F.col("normalized").isNotNull(), no, F.col("text").contains("no ")), 6).alias("confidence"))


@query("""SELECT usage_id, CASE usage_id % 3 WHEN 0 THEN input_tokens >= output_tokens WHEN 1 THEN input_tokens < output_tokens ELSE input_tokens BETWEEN output_tokens AND output_tokens * 4 END AS holds FROM llm_usage""")
def ma06_compare(spark, d):
    op = F.when(F.col("usage_id") % 3 == 0, ">=").when(F.col("usage_id") % 3 == 1, "<").otherwise("between")
    return table(spark, d, "llm_usage").select("usage_id", S.compare(op, F.col("input_tokens"), F.col("output_tokens"), F.col("output_tokens") * 4).alias("holds"))


@query("""WITH b AS (SELECT vec_id, abs(embedding[1]::DOUBLE) AS x0, abs(embedding[2]::DOUBLE) AS y0, abs(embedding[1]::DOUBLE) + 1 + abs(embedding[3]::DOUBLE) AS x1, abs(embedding[2]::DOUBLE) + 1 + abs(embedding[4]::DOUBLE) AS y1 FROM embeddings),
w AS (SELECT *, greatest(0, least(x1, 1.5) - greatest(x0, 0)) * greatest(0, least(y1, 1.5) - greatest(y0, 0)) AS i FROM b) SELECT vec_id, round(i / ((x1 - x0) * (y1 - y0) + 2.25 - i), 5) AS iou FROM w""")
def ma10_box_overlap(spark, d):
    e = lambda k: F.abs(F.col("embedding")[k].cast("double"))
    box = F.struct(e(0).alias("x0"), e(1).alias("y0"), (e(0) + 1 + e(2)).alias("x1"), (e(1) + 1 + e(3)).alias("y1"))
    fixed = F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(1.5).alias("x1"), F.lit(1.5).alias("y1"))
    return table(spark, d, "embeddings").select("vec_id", F.round(S.iou(box, fixed), 5).alias("iou"))


@query()
def ma11_text_similarity(spark, d):
    e = table(spark, d, "ner_entities").where("normalized IS NOT NULL")
    return e.select("entity_id", F.round(S.matcher_ratio(F.lower("text"), F.lower("normalized")), 4).alias("ratio"))


QUERIES, SQL = query.queries, query.sql
