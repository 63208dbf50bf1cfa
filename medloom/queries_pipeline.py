"""Queries of recovery joins, comparisons, definitions, filters, confidences and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from medloom.functions.ladders import first_reason, first_reason_sql, matches, rule, stepped, stepped_sql
from medloom.operators import expressions as E
from medloom.operators import recovery as R
from medloom.registry import PAGES, PLANTED, Registry, pages, planted
from medloom.session import broadcast_if_small, table

query = Registry()

# --- recovery and correction ----------------------------------------------

_FORMS = "(SELECT term_id, kind, lower(preferred_label) AS form FROM term_lexicon UNION SELECT term_id, kind, lower(s) FROM (SELECT term_id, kind, unnest(synonyms) AS s FROM term_lexicon) WHERE s IS NOT NULL)"
_DETECTED = f"(SELECT DISTINCT n.doc_id, f.term_id FROM ner_spans n JOIN {_FORMS} f ON lower(n.text) = f.form WHERE n.doc_id IS NOT NULL)"


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ner_entities", "doc_id", "text", "normalized").select("doc_id", F.lower("text").alias("short"), F.lower("normalized").alias("form"))


def _detected(spark: SparkSession, d: str) -> DataFrame:
    forms = R.term_forms(table(spark, d, "term_lexicon")).select("term_id", "form")
    return table(spark, d, "ner_spans", "doc_id", "text").select("doc_id", F.lower("text").alias("form")).join(broadcast_if_small(forms), "form").select("doc_id", "term_id").distinct()


@query(f"""SELECT e.doc_id, f.term_id, count(*) AS mentions FROM ner_entities e JOIN {_FORMS} f ON lower(e.normalized) = f.form AND f.kind = 'drug'
WHERE NOT EXISTS (SELECT 1 FROM {_DETECTED} x WHERE x.doc_id = e.doc_id AND x.term_id = f.term_id) GROUP BY ALL""")
def jn06_drug_recovery(spark, d):
    """Drugs that a long form names and that their document hasn't yet."""
    return R.recovered(_mentions(spark, d), R.term_forms(table(spark, d, "term_lexicon")).where("kind = 'drug'"), _detected(spark, d))


_GENE_NAMES = "(SELECT lower(symbol) AS name FROM gene_lexicon UNION SELECT lower(a) FROM (SELECT unnest(aliases) AS a FROM gene_lexicon) WHERE a IS NOT NULL)"


def _gene_names(spark: SparkSession, d: str) -> DataFrame:
    genes = table(spark, d, "gene_lexicon", "symbol", "aliases")
    aliases = genes.select(F.explode("aliases").alias("name")).select(F.lower("name").alias("name"))
    return genes.select(F.lower("symbol").alias("name")).union(aliases).where("name IS NOT NULL").distinct()


@query(f"""SELECT e.doc_id, f.term_id, count(*) AS mentions FROM ner_entities e JOIN {_FORMS} f ON lower(e.normalized) = f.form AND f.kind = 'disease'
WHERE NOT EXISTS (SELECT 1 FROM {_DETECTED} x WHERE x.doc_id = e.doc_id AND x.term_id = f.term_id) AND NOT EXISTS (SELECT 1 FROM {_GENE_NAMES} g WHERE g.name = lower(e.text)) GROUP BY ALL""")
def jn07_disease_recovery(spark, d):
    """The same of diseases, where the short form isn't the name of a gene."""
    return R.recovered(_mentions(spark, d), R.term_forms(table(spark, d, "term_lexicon")).where("kind = 'disease'"), _detected(spark, d), _gene_names(spark, d))


@query("""SELECT e.entity_id, e.text, coalesce(t.preferred_label, e.normalized) AS long_form, coalesce(t.preferred_label IS DISTINCT FROM e.normalized AND t.preferred_label IS NOT NULL, false) AS corrected
FROM ner_entities e LEFT JOIN (SELECT abbreviation, min(preferred_label) AS preferred_label FROM term_lexicon WHERE kind = 'disease' AND abbreviation IS NOT NULL GROUP BY 1) t ON e.text = t.abbreviation""")
def jn09_long_form_corrected(spark, d):
    """A short form that is a known disease abbreviation takes its long form."""
    known = table(spark, d, "term_lexicon").where("kind = 'disease' AND abbreviation IS NOT NULL").groupBy(F.col("abbreviation").alias("text")).agg(F.min("preferred_label").alias("label"))
    e = table(spark, d, "ner_entities", "entity_id", "text", "normalized").join(broadcast_if_small(known), "text", "left")
    changed = F.col("label").isNotNull() & ~F.col("label").eqNullSafe(F.col("normalized"))
    return e.select("entity_id", "text", F.coalesce("label", "normalized").alias("long_form"), changed.alias("corrected"))


@query(r"""WITH t AS (SELECT DISTINCT doc_id, w FROM (SELECT doc_id, unnest(string_split_regex(full_text, '[^A-Za-z0-9-]+')) AS w FROM pipeline_state WHERE full_text IS NOT NULL))
SELECT t.doc_id, t.w AS short_form, min(l.name) AS long_form FROM t JOIN (SELECT abbreviation AS sf, preferred_label AS name FROM term_lexicon UNION ALL SELECT symbol, full_name FROM gene_lexicon) l ON l.sf = t.w
WHERE NOT EXISTS (SELECT 1 FROM ner_spans s WHERE s.doc_id = t.doc_id AND s.text = t.w) GROUP BY 1, 2""")
def jn10_missing_short_forms(spark, d):
    """Short forms of the dictionary that stand in a text and weren't found there."""
    words = table(spark, d, "pipeline_state", "doc_id", "full_text").select("doc_id", F.explode(F.array_distinct(F.split("full_text", "[^A-Za-z0-9-]+"))).alias("short_form"))
    listed = table(spark, d, "term_lexicon").select(F.col("abbreviation").alias("short_form"), F.col("preferred_label").alias("name")).union(table(spark, d, "gene_lexicon").select("symbol", "full_name"))
    known = listed.where("short_form IS NOT NULL").groupBy("short_form").agg(F.min("name").alias("long_form"))
    hit = words.join(broadcast_if_small(known), "short_form").distinct()
    return hit.join(table(spark, d, "ner_spans", "doc_id", F.col("text").alias("short_form")), ["doc_id", "short_form"], "left_anti").select("doc_id", "short_form", "long_form")


@query(r"""WITH w AS (SELECT DISTINCT candidate_id, context_text, t FROM (SELECT candidate_id, context_text, unnest(string_split_regex(context_text, '[^A-Za-z0-9]+')) AS t FROM gene_candidates WHERE context_text IS NOT NULL))
SELECT candidate_id, symbol, n::INT AS hits FROM (SELECT candidate_id, symbol, len(regexp_extract_all(context_text, '\b' || symbol || '(?:[- ](?:positive|negative|mutant|related))?\b')) AS n FROM w JOIN gene_lexicon g ON g.symbol = w.t) WHERE n > 0""")
def jn02_pattern_lexicon(spark, d):
    """Every entry's own pattern against every text that has the entry's token."""
    texts = table(spark, d, "gene_candidates", "candidate_id", "context_text")
    words = texts.select("candidate_id", "context_text", F.explode(F.array_distinct(F.split("context_text", "[^A-Za-z0-9]+"))).alias("symbol"))
    rx = F.concat(F.lit(r"\b"), "symbol", F.lit(r"(?:[- ](?:positive|negative|mutant|related))?\b"))
    hit = words.join(broadcast_if_small(table(spark, d, "gene_lexicon", "symbol")), "symbol").select("candidate_id", "symbol", F.regexp_count("context_text", rx).alias("hits"))
    return hit.where("hits > 0")


_WORDS = "list_distinct(list_filter(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda x: length(x) >= 6))"
_SPACED = "(' ' || trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g')) || ' ')"


@query(f"""WITH v AS (SELECT value, unnest({_WORDS.format('value')}) AS word FROM (SELECT DISTINCT normalized AS value FROM ner_entities WHERE normalized IS NOT NULL)),
r AS (SELECT term_id, preferred_label AS label, unnest({_WORDS.format('preferred_label')}) AS word FROM term_lexicon),
p AS (SELECT DISTINCT v.value, r.term_id, r.label FROM v JOIN r ON v.word = r.word),
s AS (SELECT value, min((CASE WHEN lower(value) = lower(label) THEN '1' WHEN contains({_SPACED.format('value')}, {_SPACED.format('label')}) OR contains({_SPACED.format('label')}, {_SPACED.format('value')}) THEN '2' ELSE '3' END) || term_id) AS m FROM p GROUP BY 1)
SELECT value, substr(m, 2) AS term_id, substr(m, 1, 1)::INT AS rule FROM s""")
def jn13_registry_link(spark, d):
    return R.linked(table(spark, d, "ner_entities", F.col("normalized").alias("value")), table(spark, d, "term_lexicon", "term_id", F.col("preferred_label").alias("label")))


def _passes(system: str, gold: str, aliases: str) -> str:
    return f"""WITH s AS ({system}), g AS ({gold}), al AS (SELECT name, min(entry) AS entry FROM ({aliases}) GROUP BY 1),
e AS (SELECT doc_id, name FROM s INTERSECT SELECT doc_id, name FROM g),
s2 AS (SELECT DISTINCT x.doc_id, coalesce(al.entry, x.name) AS entry FROM (SELECT * FROM s EXCEPT SELECT * FROM e) x LEFT JOIN al ON al.name = x.name),
g2 AS (SELECT DISTINCT x.doc_id, coalesce(al.entry, x.name) AS entry FROM (SELECT * FROM g EXCEPT SELECT * FROM e) x LEFT JOIN al ON al.name = x.name),
b AS (SELECT coalesce(s2.doc_id, g2.doc_id) AS doc_id, count_if(s2.entry IS NOT NULL AND g2.entry IS NOT NULL) AS tp_alias, count_if(g2.entry IS NULL) AS fp, count_if(s2.entry IS NULL) AS fn FROM s2 FULL OUTER JOIN g2 ON s2.doc_id = g2.doc_id AND s2.entry = g2.entry GROUP BY 1),
x AS (SELECT doc_id, count(*) AS tp_exact FROM e GROUP BY 1)
SELECT coalesce(x.doc_id, b.doc_id) AS doc_id, coalesce(tp_exact, 0)::BIGINT AS tp_exact, coalesce(tp_alias, 0)::BIGINT AS tp_alias, coalesce(fp, 0)::BIGINT AS fp, coalesce(fn, 0)::BIGINT AS fn FROM x FULL OUTER JOIN b ON x.doc_id = b.doc_id"""


_BY = "SELECT DISTINCT doc_id, lower(text) AS name FROM ner_entities WHERE text IS NOT NULL AND doc_id IS NOT NULL AND entity_type = 'Disease' AND backend = '{0}'"


@query(_passes(_BY.format("BiomedicalNER"), _BY.format("GeneticEnricher"), f"SELECT form AS name, term_id AS entry FROM {_FORMS}"))
def jn19_disease_comparison(spark, d):
    """Diseases of one annotator against another's per document: equal names, then names of one entry."""
    e = table(spark, d, "ner_entities", "doc_id", "text", "entity_type", "backend").where("entity_type = 'Disease'").withColumn("name", F.lower("text"))
    forms = R.term_forms(table(spark, d, "term_lexicon")).select(F.col("form").alias("name"), F.col("term_id").alias("entry"))
    return R.compared_in_passes(e.where("backend = 'BiomedicalNER'"), e.where("backend = 'GeneticEnricher'"), forms)


@query(_passes(
    "SELECT DISTINCT doc_id, lower(hgnc_symbol) AS name FROM gene_candidates WHERE hgnc_symbol IS NOT NULL AND doc_id IS NOT NULL",
    "SELECT DISTINCT doc_id, lower(g.hgnc_symbol) AS name FROM (SELECT doc_id, unnest(genes) AS g FROM extraction_results) WHERE g.hgnc_symbol IS NOT NULL AND doc_id IS NOT NULL",
    "SELECT lower(a) AS name, lower(symbol) AS entry FROM (SELECT symbol, unnest(aliases) AS a FROM gene_lexicon) WHERE a IS NOT NULL UNION SELECT lower(symbol), lower(symbol) FROM gene_lexicon",
))
def jn20_gene_comparison(spark, d):
    """Gene candidates against the exported genes per document: symbols, then aliases of one gene."""
    system = table(spark, d, "gene_candidates", "doc_id", F.lower("hgnc_symbol").alias("name"))
    gold = table(spark, d, "extraction_results", "doc_id", "genes").select("doc_id", F.explode("genes").alias("g")).select("doc_id", F.lower("g.hgnc_symbol").alias("name"))
    genes = table(spark, d, "gene_lexicon", "symbol", "aliases").select(F.lower("symbol").alias("entry"), "aliases")
    names = genes.select(F.explode("aliases").alias("name"), "entry").select(F.lower("name").alias("name"), "entry").where("name IS NOT NULL").union(genes.select(F.col("entry").alias("name"), "entry"))
    return R.compared_in_passes(system, gold, names)


# --- definitions ------------------------------------------------------------

#: Patterns that both dialects read alike: one match, then its parts.
COMMA = r"[A-Z]{2,6}[0-9]{0,2}, (?:[A-Z]?[a-z]+[ -]){1,5}[a-z]+"
CODE_NAME = r"[a-z]{6,} \(?[A-Z]{2,5}-?[0-9]{2,5}\b"
INLINE = {
    "bracket": (r"(?:[A-Z]?[a-z]+ ){1,6}\([A-Z]{2,8}\)", r"\(([A-Z]{2,8})\)$", r"^(.*) \("),
    "equals": (r"\b[A-Z]{2,8} = [a-z]+(?: [a-z]+){0,5}", r"^([A-Z]{2,8})", r"= (.*)$"),
    "stands": (r"\b[A-Z]{2,8} stands for (?:the )?[a-z]+(?: [a-z]+){0,3}", r"^([A-Z]{2,8})", r"stands for (.*)$"),
    "colon": (r"\b[A-Z]{2,8}: [a-z]+(?: [a-z]+){0,5}", r"^([A-Z]{2,8})", r": (.*)$"),
    "reversed": (r"\b[A-Z]{2,8} \((?:[a-z]+[ -]){1,5}[a-z]+\)", r"^([A-Z]{2,8})", r"\((.*)\)$"),
}
#: Sentences and captions made of the list's own entries.
_SENTENCES = "(SELECT term_id AS doc_id, 'We studied ' || abbreviation || ', ' || preferred_label || ', in ' || length(preferred_label) || ' centres.' AS text FROM term_lexicon WHERE abbreviation IS NOT NULL)"
_CAPTIONS = "(SELECT term_id AS doc_id, 'Table ' || length(preferred_label) || '. Outcomes; ' || regexp_extract(abbreviation, '^([A-Z]+)', 1) || ' = ' || preferred_label || '. n = 5' AS block FROM term_lexicon WHERE abbreviation IS NOT NULL)"


def _made(spark: SparkSession, d: str, sql: str) -> DataFrame:
    return table(spark, d, "term_lexicon").where("abbreviation IS NOT NULL").selectExpr("term_id AS doc_id", sql)


#: Words before a long form that don't belong to it.
LEAD_IN = r"^(?:(?:[Tt]he|[Aa]n?|[Ww]ith|[Oo]f|[Ii]n|[Pp]atients|[Ff]or|[Aa]nd) )+"


def _initials(spark_lf: str) -> str:
    return f"regexp_replace(lower({spark_lf}), '(^|[ -])([a-z])[a-z]*', '$2')"


@query(rf"""SELECT doc_id, short_form, long_form, starts_with(regexp_replace(lower(long_form), '(^|[ -])([a-z])[a-z]*', '\2', 'g'), lower(short_form)) AS aligned
FROM (SELECT doc_id, regexp_extract(m, '^([A-Z0-9]+)', 1) AS short_form, regexp_extract(m, '^[A-Z0-9]+, (.*)$', 1) AS long_form FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{COMMA}')) AS m FROM {_SENTENCES}))""")
def ex07_comma_definitions(spark, d):
    """``SF, long form`` wherever it stands, with whether the initials agree."""
    text = _made(spark, d, "concat('We studied ', abbreviation, ', ', preferred_label, ', in ', length(preferred_label), ' centres.') AS text")
    hit = text.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(COMMA), F.lit(0))).alias("m"))
    out = hit.select("doc_id", F.regexp_extract("m", "^([A-Z0-9]+)", 1).alias("short_form"), F.regexp_extract("m", "^[A-Z0-9]+, (.*)$", 1).alias("long_form"))
    return out.withColumn("aligned", F.expr(f"startswith({_initials('long_form')}, lower(short_form))"))


@query(rf"""SELECT doc_id, regexp_extract(m, '^([a-z]+)', 1) AS name, regexp_extract(m, '([A-Z]{{2,5}}-?[0-9]{{2,5}})$', 1) AS code, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{CODE_NAME}')) AS m FROM (SELECT term_id AS doc_id, 'They took ' || preferred_label || ' (' || unnest(synonyms) || ') daily.' AS text FROM term_lexicon WHERE kind = 'drug')) GROUP BY ALL""")
def ex04_named_codes(spark, d):
    """A code behind the name it stands for, in brackets or not."""
    drugs = table(spark, d, "term_lexicon").where("kind = 'drug'").select(F.col("term_id").alias("doc_id"), "preferred_label", F.explode("synonyms").alias("s"))
    text = drugs.select("doc_id", F.concat(F.lit("They took "), "preferred_label", F.lit(" ("), "s", F.lit(") daily.")).alias("text"))
    hit = text.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(CODE_NAME), F.lit(0))).alias("m"))
    return hit.groupBy("doc_id", F.regexp_extract("m", "^([a-z]+)", 1).alias("name"), F.regexp_extract("m", "([A-Z]{2,5}-?[0-9]{2,5})$", 1).alias("code")).agg(F.count("*").alias("n"))


def _inline_sql(source: str, text: str) -> str:
    parts = [f"SELECT doc_id, '{k}' AS style, regexp_extract(m, '{sf}', 1) AS short_form, regexp_replace(regexp_extract(m, '{lf}', 1), '{LEAD_IN}', '') AS long_form FROM (SELECT doc_id, unnest(regexp_extract_all({text}, '{rx}')) AS m FROM {source})" for k, (rx, sf, lf) in INLINE.items()]
    return " UNION ALL ".join(parts)


def _inline(df: DataFrame, text: str) -> DataFrame:
    """One row for each definition of every style: all styles are cut from a text in one pass."""

    def style(k: str, rx: str, sf: str, lf: str) -> Column:
        part = lambda m: F.struct(F.lit(k).alias("style"), F.regexp_extract(m, sf, 1).alias("short_form"), F.regexp_replace(F.regexp_extract(m, lf, 1), LEAD_IN, "").alias("long_form"))
        return F.transform(F.regexp_extract_all(text, F.lit(rx), F.lit(0)), part)

    found = F.flatten(F.array(*[style(k, *parts) for k, parts in INLINE.items()]))
    return df.where(F.col(text).isNotNull()).select("doc_id", F.explode(found).alias("x")).select("doc_id", "x.*")


@query(_inline_sql(PLANTED, "text"))
def ex09_inline_styles(spark, d):
    """Definitions of five styles, lead-in words trimmed."""
    return _inline(planted(spark, d), "text")


@query(_inline_sql(f"(SELECT doc_id, block FROM {_CAPTIONS} WHERE regexp_matches(block, '^(?:Figure|Fig[.]|Table) [0-9]+'))", "block"))
def ex08_caption_definitions(spark, d):
    """Definitions in the captions of figures and tables."""
    captions = _made(spark, d, "concat('Table ', length(preferred_label), '. Outcomes; ', regexp_extract(abbreviation, '^([A-Z]+)', 1), ' = ', preferred_label, '. n = 5') AS block")
    return _inline(captions.where(F.col("block").rlike(r"^(?:Figure|Fig[.]|Table) [0-9]+")), "block")


IDENTIFIERS = r"\b(?:NCT[0-9]{8}|PMC[0-9]{5,8}|PMID:? ?[0-9]{6,8}|HGNC:[0-9]+|ORPHA:[0-9]+|HP:[0-9]{7}|rs[0-9]{4,})\b"


@query(rf"""WITH ids AS (SELECT DISTINCT doc_id, regexp_extract(m, '^([A-Za-z]+)', 1) AS v FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{IDENTIFIERS}')) AS m FROM {PLANTED})),
sf AS (SELECT doc_id, s, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\b[A-Z][A-Z0-9]{{1,7}}\b')) AS s FROM {PLANTED}) GROUP BY 1, 2)
SELECT doc_id, s AS short_form, n FROM sf WHERE NOT EXISTS (SELECT 1 FROM ids WHERE ids.doc_id = sf.doc_id AND (ids.v = sf.s OR regexp_matches(sf.s, '^' || ids.v || '[0-9]+$')))""")
def ex12_identifier_blacklist(spark, d):
    """Short-form-like words of a text that aren't part of its identifiers."""
    text = planted(spark, d)
    ids = text.select("doc_id", F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(IDENTIFIERS), F.lit(0)), lambda m: F.regexp_extract(m, "^([A-Za-z]+)", 1)))).alias("v"))
    found = text.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\b[A-Z][A-Z0-9]{1,7}\b"), F.lit(0))).alias("short_form")).groupBy("doc_id", "short_form").agg(F.count("*").alias("n"))
    # a short form with digits is the identifier's letters and a number
    keyed = found.withColumn("v", F.explode(F.array_distinct(F.array("short_form", F.regexp_extract("short_form", "^([A-Z]+)[0-9]*$", 1)))))
    bad = keyed.join(ids, ["doc_id", "v"], "left_semi").select("doc_id", "short_form")
    return found.join(bad, ["doc_id", "short_form"], "left_anti")


GENE_LIKE = r"\b[A-Z]{2,6}[0-9]{1,2}[A-Z]?\b"


@query(rf"SELECT doc_id, symbol, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(full_text, '{GENE_LIKE}')) AS symbol FROM pipeline_state WHERE full_text IS NOT NULL) GROUP BY 1, 2")
def ex17_gene_like_symbols(spark, d):
    hit = table(spark, d, "pipeline_state", "doc_id", "full_text").select("doc_id", F.explode(F.regexp_extract_all("full_text", F.lit(GENE_LIKE), F.lit(0))).alias("symbol"))
    return hit.groupBy("doc_id", "symbol").agg(F.count("*").alias("n"))


DISEASE_LIKE = r"[a-z-]{5,} (?:syndrome|disease|disorder|dystrophy|deficiency|anemia|edema|nephritis|neuropathy)(?: type [0-9IVX]+| [0-9]+)?"


@query(rf"SELECT result_id, lower(m) AS disease, count(*) AS n FROM (SELECT result_id, unnest(regexp_extract_all(lower(source_text), '{DISEASE_LIKE.replace('IVX', 'ivx')}')) AS m FROM zeroshot_results WHERE source_text IS NOT NULL) GROUP BY 1, 2")
def ex18_disease_patterns(spark, d):
    """Phrases that end in a disease word, with type numbers."""
    hit = table(spark, d, "zeroshot_results", "result_id", "source_text").select("result_id", F.explode(F.regexp_extract_all(F.lower("source_text"), F.lit(DISEASE_LIKE.replace("IVX", "ivx")), F.lit(0))).alias("disease"))
    return hit.groupBy("result_id", "disease").agg(F.count("*").alias("n"))


_AGE = r"(?:at least|aged?|older than|under|over) ([0-9]{1,3})(?: years)?"


@query(rf"""SELECT entry_id, i::INT AS part_no, part, CASE WHEN regexp_matches(lower(part), 'exclud|not been|without|must not') THEN 'exclusion' WHEN regexp_matches(lower(part), 'eligible|includ|required|at least') THEN 'inclusion' ELSE 'other' END AS polarity,
try_cast(nullif(regexp_extract(lower(part), '{_AGE}', 1), '') AS INT) AS age FROM (SELECT entry_id, unnest(range(len(l))) AS i, trim(unnest(l)) AS part FROM (SELECT entry_id, string_split_regex(text, '[.;] |\n') AS l FROM feasibility_entries WHERE text IS NOT NULL)) WHERE part <> ''""")
def ex23_criteria(spark, d):
    """Sentences of an entry with their polarity and the age they name."""
    cut = table(spark, d, "feasibility_entries", "entry_id", "text").select("entry_id", F.posexplode(F.split("text", r"[.;] |\n")).alias("part_no", "part")).withColumn("part", F.trim("part")).where("part <> ''")
    low = F.lower("part")
    polarity = F.when(low.rlike("exclud|not been|without|must not"), "exclusion").when(low.rlike("eligible|includ|required|at least"), "inclusion").otherwise("other")
    return cut.select("entry_id", "part_no", "part", polarity.alias("polarity"), F.regexp_extract(low, _AGE, 1).try_cast("int").alias("age"))


#: Families of journey statements, tried in this order at each place.
JOURNEY = {"delay": r"delay between [a-z ]+ and [a-z]+", "follow_up": r"follow-up was [0-9]+ [a-z]+", "onset": r"onset (?:reached|was|at) [0-9]+ [a-z]+", "dosing": r"for [0-9]+ (?:days|weeks|months)", "visit": r"within [0-9]+ (?:days|weeks|months)", "duration": r"after [0-9]+ (?:days|weeks|months|years)"}


@query(" UNION ALL ".join(rf"SELECT state_id, '{k}' AS family, m AS statement, count(*) AS n FROM (SELECT state_id, unnest(regexp_extract_all(replace(full_text, chr(10), ' '), '{rx}')) AS m FROM pipeline_state WHERE full_text IS NOT NULL) GROUP BY ALL" for k, rx in JOURNEY.items()))
def ex32_journey_patterns(spark, d):
    """Statements of six families over whole texts, line ends being spaces."""
    flat = table(spark, d, "pipeline_state", "state_id", F.replace("full_text", F.lit("\n"), F.lit(" ")).alias("t")).where("t IS NOT NULL")
    family = lambda k, rx: F.transform(F.regexp_extract_all("t", F.lit(rx), F.lit(0)), lambda m: F.struct(F.lit(k).alias("family"), m.alias("statement")))
    found = F.flatten(F.array(*[family(k, rx) for k, rx in JOURNEY.items()]))
    return flat.select("state_id", F.explode(found).alias("x")).groupBy("state_id", "x.family", "x.statement").agg(F.count("*").alias("n"))


@query(r"""WITH s AS (SELECT state_id, i, x FROM (SELECT state_id, unnest(range(len(l))) AS i, unnest(l) AS x FROM (SELECT state_id, string_split(replace(full_text, chr(10), ' '), '. ') AS l FROM pipeline_state WHERE full_text IS NOT NULL)) WHERE regexp_matches(lower(x), 'recommend|should|may consider|prefer|received|treatment with')),
w AS (SELECT DISTINCT state_id, i, w FROM (SELECT state_id, i, unnest(string_split_regex(lower(x), '[^a-z0-9-]+')) AS w FROM s))
SELECT state_id, i::INT AS sentence_no, term_id FROM w JOIN (SELECT DISTINCT term_id, lower(preferred_label) AS drug FROM term_lexicon WHERE kind = 'drug') t ON t.drug = w.w""")
def ex35_recommended_drugs(spark, d):
    """Sentences that advise something and name a known drug."""
    s = table(spark, d, "pipeline_state", "state_id", "full_text").select("state_id", F.posexplode(F.split(F.replace("full_text", F.lit("\n"), F.lit(" ")), r"\. ")).alias("sentence_no", "x"))
    s = s.where(F.lower("x").rlike("recommend|should|may consider|prefer|received|treatment with"))
    words = s.select("state_id", "sentence_no", F.explode(F.array_distinct(F.split(F.lower("x"), "[^a-z0-9-]+"))).alias("drug"))
    drugs = table(spark, d, "term_lexicon").where("kind = 'drug'").select("term_id", F.lower("preferred_label").alias("drug")).distinct()
    return words.join(broadcast_if_small(drugs), "drug").select("state_id", "sentence_no", "term_id")


#: Key words of disease categories; the category with most of them wins, the first one where equal.
CATEGORIES = {"renal": ["nephr", "renal", "kidney"], "neurological": ["neuro", "epilep", "dystroph"], "haematological": ["anemi", "anaemi", "platelet"], "cardiac": ["cardi", "heart"], "metabolic": ["storage", "deficien", "metabol"], "dermal": ["derm", "skin", "scal"], "oedema": ["edema"]}


@query("SELECT term_id, CASE WHEN best = 0 THEN 'other' ELSE category END AS category FROM (SELECT term_id, max(n) AS best, max_by(category, n * 100 - k) AS category FROM (" + " UNION ALL ".join(
    f"SELECT term_id, '{c}' AS category, {k} AS k, " + " + ".join(f"contains(lower(preferred_label), '{w}')::INT" for w in words) + " AS n FROM term_lexicon WHERE kind = 'disease'" for k, (c, words) in enumerate(CATEGORIES.items())) + ") GROUP BY 1)")
def ex37_disease_category(spark, d):
    label = F.lower("preferred_label")
    scores = [F.struct(sum(label.contains(w).cast("int") for w in words).alias("n"), F.lit(-k).alias("k"), F.lit(c).alias("c")) for k, (c, words) in enumerate(CATEGORIES.items())]
    best = F.array_max(F.array(*scores))
    return table(spark, d, "term_lexicon").where("kind = 'disease'").select("term_id", F.when(best["n"] == 0, "other").otherwise(best["c"]).alias("category"))


@query("""SELECT e.entity_id, CASE WHEN e.normalized IS NOT NULL THEN 'VALIDATED' WHEN EXISTS (SELECT 1 FROM term_lexicon t WHERE t.abbreviation = e.text) THEN 'VALIDATED' ELSE 'AMBIGUOUS' END AS status
FROM ner_entities e WHERE regexp_matches(e.text, '^[A-Z][A-Z0-9-]{1,9}$')""")
def ex41_unexpanded(spark, d):
    """Short forms without a long form that no list allows unexpanded."""
    allowed = table(spark, d, "term_lexicon").where("abbreviation IS NOT NULL").select(F.col("abbreviation").alias("text"), F.lit(True).alias("ok")).distinct()
    e = table(spark, d, "ner_entities", "entity_id", "text", "normalized").where(F.col("text").rlike("^[A-Z][A-Z0-9-]{1,9}$")).join(broadcast_if_small(allowed), "text", "left")
    return e.select("entity_id", F.when(F.col("normalized").isNotNull() | F.col("ok").isNotNull(), "VALIDATED").otherwise("AMBIGUOUS").alias("status"))


@query(r"SELECT doc_id, regexp_replace(text, '\b([A-Z][A-Za-z0-9]{0,5})- ([A-Z]{2,5})\b', '\1-\2', 'g') AS fixed FROM documents WHERE text IS NOT NULL")
def pr09_short_form_hyphens(spark, d):
    """``MG- ADL`` becomes ``MG-ADL`` where both sides look like short forms."""
    return table(spark, d, "documents", "doc_id", "text").where("text IS NOT NULL").select("doc_id", F.regexp_replace("text", r"\b([A-Z][A-Za-z0-9]{0,5})- ([A-Z]{2,5})\b", "$1-$2").alias("fixed"))


# --- filters ----------------------------------------------------------------

FORM_RULES = [
    rule("empty", "text IS NULL OR trim(text) = ''"), matches("text", r"^(?:Figure|Fig|Table|Box|Appendix)\b", "caption"), matches("text", r"^10[.][0-9]{4,}", "doi"), matches("text", r"^[0-9.,%]+$", "number"), matches("text", r"^[A-Z][.](?: ?[A-Z][.])*$", "initials"),
    matches("text", r"^(?:Ig|IG)[AGMED]$", "immunoglobulin"), matches("text", r"^[0-9.]+ ?(?:mg|g|kg|mL|L|weeks|days|months|years|%|units)$", "measure"), rule("long", "length(text) > 60"), matches("text", r"^[a-z]+$", "plain_word"),
    rule("short", "length(text) < 2"), matches("text", r"^(?:no|not|and|or|the|some|any) ", "stop_start"), matches("text", r"[.] [A-Z]", "two_sentences"),
]


@query(f"SELECT span_id, {first_reason_sql(FORM_RULES)} AS reason FROM ner_spans")
def fl06_form_ladder(spark, d):
    """The first form rule that a mention breaks."""
    return table(spark, d, "ner_spans", "span_id", "text").select("span_id", first_reason(FORM_RULES).alias("reason"))


AUTHOR_RULES = [
    rule("not_initials", r"matched_text IS NULL OR NOT matched_text rlike r'^[A-Z]{2,3}$'", "matched_text IS NULL OR NOT regexp_matches(matched_text, '^[A-Z]{2,3}$')"), rule("no_context", "context_text IS NULL"),
    matches("context_text", r"(?i)\b(?:authors?|correspondence|contributed|conceived|drafted|wrote|analysed by|reviewed by)\b", "author_word"), matches("context_text", r"\b[A-Z][a-z]+ [A-Z]{2,3}[0-9,]", "name_with_mark"),
    rule("many_initials", r"size(regexp_extract_all(context_text, r'\b[A-Z]{2,3}\b', 0)) >= 3", r"len(regexp_extract_all(context_text, '\b[A-Z]{2,3}\b')) >= 3"),
]


@query(f"SELECT candidate_id, {first_reason_sql(AUTHOR_RULES, 'short_form')} AS reason FROM gene_candidates")
def fl02_author_initials(spark, d):
    return table(spark, d, "gene_candidates", "candidate_id", "matched_text", "context_text").select("candidate_id", first_reason(AUTHOR_RULES, "short_form").alias("reason"))


@query(r"""SELECT g.candidate_id, regexp_matches(coalesce(g.matched_text, ''), '^NCT[0-9]+$') AS is_trial, coalesce(regexp_matches(lower(g.context_text), CASE WHEN l.locus_type = 'protein-coding' THEN 'gene|protein|expression|variant|mutation|change in|loss of|antibod' ELSE 'gene|variant|mutation|sequenc|change in|loss of' END), false) AS in_context
FROM gene_candidates g JOIN gene_lexicon l ON l.symbol = g.hgnc_symbol""")
def fl09_required_context(spark, d):
    """Whether the context has one of the words that the entry's kind requires, and whether the text is a trial id."""
    kinds = table(spark, d, "gene_lexicon", F.col("symbol").alias("hgnc_symbol"), F.col("locus_type").alias("kind"))
    g = table(spark, d, "gene_candidates", "candidate_id", "matched_text", "hgnc_symbol", "context_text").join(broadcast_if_small(kinds), "hgnc_symbol")
    need = F.when(F.col("kind") == "protein-coding", "gene|protein|expression|variant|mutation|change in|loss of|antibod").otherwise("gene|variant|mutation|sequenc|change in|loss of")
    return g.select("candidate_id", F.coalesce("matched_text", F.lit("")).rlike("^NCT[0-9]+$").alias("is_trial"), F.coalesce(F.regexp(F.lower("context_text"), need), F.lit(False)).alias("in_context"))


DISEASE_RULES = [
    rule("empty", "text IS NULL OR trim(text) = ''"), rule("short", "length(text) < 3"), matches("text", r"^[0-9 .,/-]+$", "number"), matches("text", r"^(?:[0-9]{1,2}|X|Y)[pq][0-9.]+$", "chromosome"), rule("gene", "is_gene"),
    matches("text", r"(?i)^(?:disease|disorder|syndrome|condition|illness|deficiency)s?$", "generic"), matches("text", r"\bet al\b|^[A-Z][a-z]+ [0-9]{4}$", "citation"), matches("text", r"(?i)\b(?:week|month|day|year)s?\b", "time"), rule("unsure", "score < 0.3"),
]


@query(f"SELECT entity_id, {first_reason_sql(DISEASE_RULES)} AS reason FROM (SELECT e.entity_id, e.text, e.score, EXISTS (SELECT 1 FROM {_GENE_NAMES} g WHERE g.name = lower(e.text)) AS is_gene FROM ner_entities e WHERE e.entity_type = 'Disease')")
def fl12_disease_filter(spark, d):
    """The first hard rule that speaks against a disease mention."""
    e = table(spark, d, "ner_entities", "entity_id", "text", "score", "entity_type").where("entity_type = 'Disease'").withColumn("name", F.lower("text"))
    e = e.join(broadcast_if_small(_gene_names(spark, d).withColumn("is_gene", F.lit(True))), "name", "left")
    return e.select("entity_id", first_reason(DISEASE_RULES).alias("reason"))


GENERIC_RULES = [
    rule("phrase", r"text IS NULL OR text rlike r'\s'", r"text IS NULL OR regexp_matches(text, '\s')"), rule("known", "is_known"), matches("text", r"(?i)^(?:pain|fatigue|stiffness|weakness|swelling|tenderness|numbness|itching|bruising|cramping)$", "generic_symptom"), rule("rare_word", "n < 3"),
]


@query(f"""SELECT entity_id, {first_reason_sql(GENERIC_RULES, 'frequent_word')} AS reason FROM (SELECT e.entity_id, e.text, EXISTS (SELECT 1 FROM {_FORMS} f WHERE f.form = lower(e.text)) AS is_known, count(*) OVER (PARTITION BY lower(e.text)) AS n FROM ner_entities e)""")
def fl14_generic_words(spark, d):
    """Single words without an entry: generic, frequent or rare in all documents."""
    e = table(spark, d, "ner_entities", "entity_id", "text").withColumn("form", F.lower("text"))
    counts = e.groupBy("form").agg(F.count("*").alias("n"))
    known = R.term_forms(table(spark, d, "term_lexicon")).select("form", F.lit(True).alias("is_known")).distinct()
    return e.join(broadcast_if_small(known), "form", "left").join(counts, "form", "left").select("entity_id", first_reason(GENERIC_RULES, "frequent_word").alias("reason"))


DRUG_RULES = [
    rule("empty", "text IS NULL OR trim(text) = ''"), rule("short", "length(text) < 3"), matches("text", r"^[0-9]", "number_first"), matches("text", r"(?i)\b(?:tablet|capsule|injection|infusion|patch|placebo|vehicle|dose)s?\b", "form_or_control"),
    matches("text", r"(?i)(?:ase|ose)$", "enzyme_or_sugar"), matches("text", r"(?i)^(?:water|saline|oxygen|glucose|alcohol|protein)$", "substance"), matches("text", r"(?i)(?:mab|tinib|pril|stat|olol|sartan|ciclib|tide)$", "keep_by_ending"), rule("unsure", "score < 0.5"), rule("backend", "backend IS NULL"),
]


@query(f"SELECT entity_id, {first_reason_sql(DRUG_RULES)} AS reason FROM ner_entities WHERE entity_type = 'Drug'")
def fl15_drug_filter(spark, d):
    return table(spark, d, "ner_entities", "entity_id", "text", "score", "backend", "entity_type").where("entity_type = 'Drug'").select("entity_id", first_reason(DRUG_RULES).alias("reason"))


_GENE_WORDS = r"(?i)\b(?:gene|genes|protein|variant|variants|mutation|expression|sequencing|carriers|loss|phenotype|families|siblings)\b"
GENE_RULES = [
    rule("empty", "matched_text IS NULL OR trim(matched_text) = ''"), matches("matched_text", r"^e?GFR$", "filtration_rate"), matches("matched_text", r"^[0-9 ]+$", "number"), rule("disease_short_form", "is_disease"),
    rule("short_without_context", f"length(matched_text) <= 4 AND size(regexp_extract_all(coalesce(context_text, ''), r'{_GENE_WORDS}', 0)) < 2 AND generator_type <> 'gen:gene_lexicon_orphadata'", f"length(matched_text) <= 4 AND len(regexp_extract_all(coalesce(context_text, ''), '{_GENE_WORDS}')) < 2 AND generator_type <> 'gen:gene_lexicon_orphadata'"),
    matches("matched_text", r"^[a-z]+$", "plain_word"), rule("alias_alone", "is_alias AND context_text IS NULL"),
]


@query(f"SELECT candidate_id, {first_reason_sql(GENE_RULES)} AS reason FROM (SELECT g.*, EXISTS (SELECT 1 FROM term_lexicon t WHERE t.abbreviation = g.matched_text) AS is_disease FROM gene_candidates g)")
def fl16_gene_filter(spark, d):
    """The first rule that speaks against a gene mention; short symbols need two gene words beside them."""
    short = table(spark, d, "term_lexicon").where("abbreviation IS NOT NULL").select(F.col("abbreviation").alias("matched_text"), F.lit(True).alias("is_disease")).distinct()
    g = table(spark, d, "gene_candidates", "candidate_id", "matched_text", "context_text", "generator_type", "is_alias").join(broadcast_if_small(short), "matched_text", "left")
    return g.select("candidate_id", first_reason(GENE_RULES).alias("reason"))


FEASIBILITY_RULES = [
    rule("empty", "text IS NULL OR trim(text) = ''"), matches("text", r"(?i)\b(?:prevalence|incidence|eligible|enrolled|screened|excluded|age at onset|mortality)\b", "anchored"), matches("text", r"^(?:Figure|Fig[.]|Table) ?[0-9]", "caption"), matches("text", r"(?i)\b(?:is defined as|stands for|refers to)\b", "definition"),
    matches("text", r"(?i)\bp ?[=<] ?0?[.][0-9]|(?:^|[^A-Za-z])(?:95% CI|SD [0-9])", "statistics"), matches("text", r"^[0-9]+ ?/ ?[0-9]+$", "bare_fraction"), rule("garbled", "2 * length(regexp_replace(text, '[^A-Za-z]', '')) < length(text)", "2 * length(regexp_replace(text, '[^A-Za-z]', '', 'g')) < length(text)"),
]


@query(f"SELECT entry_id, {first_reason_sql(FEASIBILITY_RULES)} AS reason FROM feasibility_entries")
def fl17_feasibility_filter(spark, d):
    """Captions, definitions, statistics and fractions, unless an anchor word stands in the text."""
    return table(spark, d, "feasibility_entries", "entry_id", "text").select("entry_id", first_reason(FEASIBILITY_RULES).alias("reason"))


_COUNTRY = r"(?:\b(?:Dr|Mr|Prof)[.]? )?\b(?:Germany|France|Spain|Kalverra|USA|Ostrava Bay|Southlin)\b.{0,8}"


@query(rf"""SELECT state_id, regexp_extract(m, '(Germany|France|Spain|Kalverra|USA|Ostrava Bay|Southlin)', 1) AS country, count(*) AS mentions, count_if(NOT regexp_matches(m, '^(?:Dr|Mr|Prof)') AND NOT regexp_matches(m, ' America')) AS accepted
FROM (SELECT state_id, unnest(regexp_extract_all(replace(replace(full_text, chr(13), ' '), chr(10), ' '), '{_COUNTRY}')) AS m FROM pipeline_state WHERE full_text IS NOT NULL) GROUP BY 1, 2""")
def fl19_country_context(spark, d):
    """Countries of a text: all mentions, and those that no title precedes and no 'America' follows."""
    flat = F.replace(F.replace("full_text", F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    hit = table(spark, d, "pipeline_state", "state_id", "full_text").select("state_id", F.explode(F.regexp_extract_all(flat, F.lit(_COUNTRY), F.lit(0))).alias("m"))
    ok = ~F.col("m").rlike("^(?:Dr|Mr|Prof)") & ~F.col("m").rlike(" America")
    return hit.groupBy("state_id", F.regexp_extract("m", "(Germany|France|Spain|Kalverra|USA|Ostrava Bay|Southlin)", 1).alias("country")).agg(F.count("*").alias("mentions"), F.count_if(ok).alias("accepted"))


# --- confidences and expressions ------------------------------------------

_FEATURES = [("hgnc_symbol IS NOT NULL", 0.1), ("context_text IS NOT NULL", 0.05), ("lexicon_source IS NOT NULL", 0.1), ("coalesce(size(identifiers), 0) > 0", 0.08), ("locus_type IS NOT NULL", 0.04), ("chromosome IS NOT NULL", 0.03), ("full_name IS NOT NULL", 0.05), ("coalesce(size(associated_diseases), 0) > 0", 0.07), ("length(matched_text) >= 5", 0.03), ("NOT is_alias", 0.05)]
_PENALTIES = [("is_alias AND alias_of IS NULL", 0.8), ("matched_text IS NULL", 0.5), ("context_text IS NULL", 0.9)]


def _to_duck(cond: str) -> str:
    return cond.replace("size(", "len(")


@query("SELECT candidate_id, round(least(1.0, greatest(0.0, (coalesce(initial_confidence, 0.5) + " + " + ".join(f"CASE WHEN {_to_duck(c)} THEN {w}::DOUBLE ELSE 0.0 END" for c, w in _FEATURES) + ") * " + " * ".join(f"CASE WHEN {c} THEN {w}::DOUBLE ELSE 1.0 END" for c, w in _PENALTIES) + ")), 6) AS confidence FROM gene_candidates")
def ma02_feature_confidence(spark, d):
    """Base, ten additive features and multiplicative penalties, within 0 and 1."""
    total = F.coalesce("initial_confidence", F.lit(0.5))
    for cond, w in _FEATURES:
        total = total + F.when(F.expr(cond), w).otherwise(0.0)
    for cond, w in _PENALTIES:
        total = total * F.when(F.expr(cond), w).otherwise(1.0)
    columns = ["candidate_id", "hgnc_symbol", "context_text", "lexicon_source", "identifiers", "locus_type", "chromosome", "full_name", "associated_diseases", "matched_text", "is_alias", "alias_of", "initial_confidence"]
    return table(spark, d, "gene_candidates", *columns).select("candidate_id", F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)), 6).alias("confidence"))


#: Weights of kinds of entries.
WEIGHTS = {"ELIGIBILITY_INCLUSION": 1.0, "ELIGIBILITY_EXCLUSION": 0.95, "EPIDEMIOLOGY": 0.9, "EPIDEMIOLOGY_NER": 0.8, "PATIENT_JOURNEY": 0.7}


@query("SELECT f.entry_id, round(least(1.0, coalesce(f.confidence, 0.5) * coalesce(w.w, 0.6) + CASE WHEN f.section IN ('methods', 'eligibility') THEN 0.1 ELSE 0.0 END + CASE WHEN f.structured_data.value IS NOT NULL THEN 0.05 ELSE 0.0 END + CASE WHEN length(f.text) BETWEEN 20 AND 200 THEN 0.05 ELSE 0.0 END), 6) AS confidence FROM feasibility_entries f LEFT JOIN (VALUES " + ", ".join(f"('{k}', {w}::DOUBLE)" for k, w in WEIGHTS.items()) + ") AS w(k, w) ON w.k = f.field_type")
def ma03_criterion_confidence(spark, d):
    weights = spark.createDataFrame(list(WEIGHTS.items()), "field_type string, w double")
    f = table(spark, d, "feasibility_entries", "entry_id", "field_type", "section", "text", "structured_data", "confidence").join(F.broadcast(weights), "field_type", "left")
    bonus = F.when(F.col("section").isin("methods", "eligibility"), 0.1).otherwise(0.0) + F.when(F.col("structured_data.value").isNotNull(), 0.05).otherwise(0.0) + F.when(F.length("text").between(20, 200), 0.05).otherwise(0.0)
    return f.select("entry_id", F.round(F.least(F.lit(1.0), F.coalesce("confidence", F.lit(0.5)) * F.coalesce("w", F.lit(0.6)) + bonus), 6).alias("confidence"))


_STEPS = [("normalized IS NOT NULL", 0.15, 0.0, 0.95), ("length(text) <= 3", -0.1, 0.2, 1.0), ("category = 'unknown'", -0.2, 0.1, 1.0), ("lower(text) = lower(normalized)", 0.1, 0.0, 0.99), ("backend IS NULL", -0.3, 0.05, 1.0)]


@query(f"SELECT entity_id, round({stepped_sql('coalesce(score, 0.5)', _STEPS)}, 6) AS confidence FROM ner_entities")
def ma04_calibrated_confidence(spark, d):
    """Ordered steps up and down, each within its own bounds."""
    e = table(spark, d, "ner_entities", "entity_id", "text", "normalized", "category", "backend", "score")
    return e.select("entity_id", F.round(stepped(F.coalesce("score", F.lit(0.5)), [(F.expr(c), *rest) for c, *rest in _STEPS]), 6).alias("confidence"))


_ADJUST = [("length(text) < 4", -0.2), ("category = 'unknown'", -0.15), ("normalized IS NULL", -0.1), ("start_pos IS NULL", -0.05), ("score IS NULL", -0.05)]
_SUM = " + ".join(f"CASE WHEN {c} THEN {w}::DOUBLE ELSE 0.0 END" for c, w in _ADJUST)


@query(f"SELECT entity_id, round(CASE WHEN regexp_matches(text, '\\bet al\\b|\\[[0-9]+\\]') THEN -0.55 ELSE greatest(-0.45, {_SUM}) END, 6) AS adjustment FROM ner_entities WHERE entity_type = 'Disease'")
def ma05_disease_adjustment(spark, d):
    """Sum of what speaks against a mention, at most 0.45; a citation counts 0.55."""
    total = sum((F.when(F.expr(c), w).otherwise(0.0) for c, w in _ADJUST), F.lit(0.0))
    e = table(spark, d, "ner_entities", "entity_id", "text", "category", "normalized", "start_pos", "score", "entity_type").where("entity_type = 'Disease'")
    return e.select("entity_id", F.round(F.when(F.col("text").rlike(r"\bet al\b|\[[0-9]+\]"), -0.55).otherwise(F.greatest(F.lit(-0.45), total)), 6).alias("adjustment"))


TREE = ("AND", ("OR", ("field_type", "=", "EPIDEMIOLOGY"), ("field_type", "=", "EPIDEMIOLOGY_NER")), ("NOT", ("section", "=", "abstract")), ("OR", ("confidence", ">=", 0.6), ("text", "like", "%registry%")))


@query(f"SELECT entry_id, {E.to_sql(TREE)} AS holds FROM feasibility_entries")
def ma07_expression_column(spark, d):
    """A tree of criteria compiled to a column."""
    return table(spark, d, "feasibility_entries", "entry_id", "field_type", "section", "confidence", "text").select("entry_id", E.to_column(TREE).alias("holds"))


@query(f"SELECT entry_id FROM feasibility_entries WHERE {E.to_sql(TREE)}")
def ma08_expression_where(spark, d):
    """The same tree as a WHERE text."""
    return table(spark, d, "feasibility_entries", "entry_id", "field_type", "section", "confidence", "text").where(E.to_sql(TREE)).select("entry_id")


# --- documents and exports -------------------------------------------------

_ROLES = """CASE WHEN regexp_matches(line, '^Page [0-9]+ of [0-9]+$') THEN 'known_footer' WHEN docs >= 2 AND top <= 2 THEN 'header' WHEN docs >= 2 AND bottom <= 2 THEN 'footer' WHEN docs >= 3 AND length(line) < 20 THEN 'noise' WHEN regexp_matches(line, '^([0-9]+[.] )?[A-Z][a-z]+( [a-z]+)?$') AND length(line) < 40 THEN 'section' ELSE 'body' END"""


@query(rf"""WITH p AS (SELECT state_id, line_no, line, page, row_number() OVER (PARTITION BY state_id, page ORDER BY line_no) AS top, row_number() OVER (PARTITION BY state_id, page ORDER BY line_no DESC) AS bottom, regexp_replace(line, '[0-9]+', '#', 'g') AS k FROM {PAGES}),
r AS (SELECT state_id, k, count(DISTINCT page) AS docs FROM p GROUP BY 1, 2)
SELECT p.state_id, p.line_no, {_ROLES} AS role FROM p JOIN r ON p.state_id = r.state_id AND p.k = r.k""")
def sc03_line_roles(spark, d):
    """The role of every line by ordered rules over its place and how many pages of its text repeat it; nothing is dropped."""
    p = pages(spark, d).withColumn("k", F.regexp_replace("line", "[0-9]+", "#"))
    of_page = W.partitionBy("state_id", "page")
    p = p.withColumn("top", F.row_number().over(of_page.orderBy("line_no"))).withColumn("bottom", F.row_number().over(of_page.orderBy(F.desc("line_no"))))
    p = p.join(p.groupBy("state_id", "k").agg(F.count_distinct("page").alias("docs")), ["state_id", "k"])
    line = F.col("line")
    role = (
        F.when(line.rlike("^Page [0-9]+ of [0-9]+$"), "known_footer").when(F.expr("docs >= 2 AND top <= 2"), "header").when(F.expr("docs >= 2 AND bottom <= 2"), "footer").when((F.col("docs") >= 3) & (F.length(line) < 20), "noise")
        .when(line.rlike("^([0-9]+[.] )?[A-Z][a-z]+( [a-z]+)?$") & (F.length(line) < 40), "section").otherwise("body")
    )
    return p.select("state_id", "line_no", role.alias("role"))


@query(rf"""WITH r AS (SELECT DISTINCT state_id, page, kind, n FROM (SELECT state_id, page, lower(regexp_extract(m, '^([A-Za-z]+)', 1)) AS kind, regexp_extract(m, '([0-9]+)$', 1) AS n FROM (SELECT state_id, page, unnest(regexp_extract_all(line, '\b(?:Week|Table|Figure|Protocol|Page|type) [0-9]+')) AS m FROM {PAGES})) WHERE page IS NOT NULL),
i AS (SELECT *, page - row_number() OVER (PARTITION BY state_id, kind, n ORDER BY page) AS g FROM r)
SELECT state_id, kind, n AS number, min(page) AS first_page, max(page) AS last_page, count(*) AS pages FROM i GROUP BY state_id, kind, n, g""")
def wn09_multi_page_items(spark, d):
    """Items named on consecutive pages merged to one, by islands of page numbers."""
    hit = pages(spark, d).where("page IS NOT NULL").select("state_id", "page", F.explode(F.regexp_extract_all("line", F.lit(r"\b(?:Week|Table|Figure|Protocol|Page|type) [0-9]+"), F.lit(0))).alias("m"))
    r = hit.select("state_id", "page", F.lower(F.regexp_extract("m", "^([A-Za-z]+)", 1)).alias("kind"), F.regexp_extract("m", "([0-9]+)$", 1).alias("number")).distinct()
    island = F.col("page") - F.row_number().over(W.partitionBy("state_id", "kind", "number").orderBy("page"))
    return r.withColumn("g", island).groupBy("state_id", "kind", "number", "g").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.count("*").alias("pages")).drop("g")


@query("""SELECT doc_id, count_if(status = 'VALIDATED') AS validated, count_if(status = 'REJECTED') AS rejected, count_if(status = 'AMBIGUOUS') AS ambiguous, coalesce(string_agg(DISTINCT CASE WHEN status = 'VALIDATED' THEN symbol END, '|' ORDER BY CASE WHEN status = 'VALIDATED' THEN symbol END), '') AS listed
FROM (SELECT doc_id, g.status AS status, g.hgnc_symbol AS symbol FROM (SELECT doc_id, unnest(genes) AS g FROM extraction_results) WHERE g IS NOT NULL) GROUP BY 1""")
def sk02_validated_export(spark, d):
    """One row for each document: totals by status, and only validated entries listed."""
    g = table(spark, d, "extraction_results", "doc_id", "genes").select("doc_id", F.explode("genes").alias("g")).where("g IS NOT NULL")
    n = lambda s: F.count_if(F.col("g.status") == s)
    listed = F.array_join(F.array_sort(F.collect_set(F.when(F.col("g.status") == "VALIDATED", F.col("g.hgnc_symbol")))), "|")
    return g.groupBy("doc_id").agg(n("VALIDATED").alias("validated"), n("REJECTED").alias("rejected"), n("AMBIGUOUS").alias("ambiguous"), listed.alias("listed"))


_BUCKETS = {"inclusion": "ELIGIBILITY_INCLUSION", "exclusion": "ELIGIBILITY_EXCLUSION", "epidemiology": "EPIDEMIOLOGY", "epidemiology_ner": "EPIDEMIOLOGY_NER", "journey": "PATIENT_JOURNEY"}


@query("SELECT doc_id, " + ", ".join(f"count_if(field_type = '{v}') AS {k}" for k, v in _BUCKETS.items()) + ", count(structured_data.value) AS structured, coalesce(string_agg(DISTINCT structured_data.data_type, '|' ORDER BY structured_data.data_type), '') AS data_types FROM feasibility_entries GROUP BY 1")
def sk04_feasibility_export(spark, d):
    """One row for each document with its entries in buckets by kind."""
    f = table(spark, d, "feasibility_entries", "doc_id", "field_type", "structured_data")
    counts = [F.count_if(F.col("field_type") == v).alias(k) for k, v in _BUCKETS.items()]
    return f.groupBy("doc_id").agg(*counts, F.count("structured_data.value").alias("structured"), F.array_join(F.array_sort(F.collect_set("structured_data.data_type")), "|").alias("data_types"))


@query("""WITH c AS (SELECT doc_id, lower(text) AS t, count(*) AS n FROM ner_entities WHERE text IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, t) AS k FROM c)
SELECT p.doc_id, p.runs, p.pages, coalesce(e.top_entities, '') AS top_entities FROM (SELECT doc_id, count(*) AS runs, max(page_count) AS pages FROM pipeline_state GROUP BY 1) p LEFT JOIN (SELECT doc_id, string_agg(t, '|' ORDER BY k) AS top_entities FROM r WHERE k <= 5 GROUP BY 1) e ON e.doc_id = p.doc_id""")
def sk05_metadata_export(spark, d):
    """Runs, pages and the five commonest entities of every document."""
    counts = table(spark, d, "ner_entities", "doc_id", "text").where("text IS NOT NULL").groupBy("doc_id", F.lower("text").alias("t")).agg(F.count("*").alias("n"))
    top = counts.withColumn("k", F.row_number().over(W.partitionBy("doc_id").orderBy(F.desc("n"), "t"))).where("k <= 5")
    top = top.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "t"))), lambda x: x["t"]), "|").alias("top_entities"))
    p = table(spark, d, "pipeline_state", "doc_id", "page_count").groupBy("doc_id").agg(F.count("*").alias("runs"), F.max("page_count").alias("pages"))
    return p.join(top, "doc_id", "left").fillna("", ["top_entities"])


QUERIES, SQL = query.queries, query.sql
