"""Queries of the extraction operators (survey 2.9) and dictionary joins (2.5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions import extract as E
from medloom.functions import predicates as P
from medloom.functions import scores as S
from medloom.operators import lexicon as L
from medloom.operators import matching as M
from medloom.registry import BLOCKS, PAGES, PLANTED, Registry, blocks, pages, planted
from medloom.session import broadcast_if_small, table

query = Registry()


def _union(patterns: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, {r} AS rank, nth, value FROM (SELECT doc_id, unnest(range(len(m)))::INT AS nth, unnest(m) AS value FROM (SELECT doc_id, regexp_extract_all(text, '{p}', 1) AS m FROM {PLANTED}))" for r, (k, p) in enumerate(patterns.items()))


@query(_union(E.PATTERNS))
def ex10_typed_patterns(spark, d):
    return E.typed_mentions(planted(spark, d), "doc_id", "text")


@query(_union(E.GENETIC))
def ex31_genetic_patterns(spark, d):
    return E.typed_mentions(planted(spark, d), "doc_id", "text", E.GENETIC)


@query("SELECT doc_id, kind, value FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, kind, lower(value) ORDER BY rank, nth) AS r FROM (" + _union({k: E.PATTERNS[k] for k in ("trial_id", "doi", "pmid", "pmcid", "url", "orcid")}) + ")) WHERE r = 1")
def ex11_identifiers_first_seen(spark, d):
    from pyspark.sql import Window as W

    m = E.typed_mentions(planted(spark, d), "doc_id", "text", {k: E.PATTERNS[k] for k in ("trial_id", "doi", "pmid", "pmcid", "url", "orcid")})
    return m.withColumn("r", F.row_number().over(W.partitionBy("doc_id", "kind", F.lower("value")).orderBy("rank", "nth"))).where("r = 1").select("doc_id", "kind", "value")


@query(r"""SELECT doc_id, sf AS short_form, lf AS long_form FROM (SELECT doc_id, unnest(regexp_extract_all(text, '((?:[A-Za-z][a-z]+ ){1,6}[A-Za-z][a-z]+) \(([A-Z][A-Za-z0-9-]{1,9})\)', 1)) AS lf, unnest(regexp_extract_all(text, '((?:[A-Za-z][a-z]+ ){1,6}[A-Za-z][a-z]+) \(([A-Z][A-Za-z0-9-]{1,9})\)', 2)) AS sf FROM """ + PLANTED + ")")
def ex01_parenthetical(spark, d):
    rows = planted(spark, d).select("doc_id", F.explode(E.definitions(F.col("text"))).alias("x")).select("doc_id", "x.*")
    return rows.where("style = 'parenthetical'").select("doc_id", "short_form", "long_form")


@query()
def ex02_initial_words(spark, d):
    rows = planted(spark, d).select("doc_id", F.explode(E.definitions(F.col("text"))).alias("x")).select("doc_id", "x.*").where("style = 'parenthetical'")
    return rows.select("doc_id", "short_form", E.initial_words(F.col("short_form"), F.col("long_form")).alias("long_form")).where("long_form IS NOT NULL")


@query()
def ex03_aligned_long_form(spark, d):
    rows = planted(spark, d).select("doc_id", F.explode(E.definitions(F.col("text"))).alias("x")).select("doc_id", "x.*").where("style = 'parenthetical'")
    return rows.select("doc_id", "short_form", E.aligned_long_form("short_form", "long_form").alias("long_form"))


@query(r"""SELECT doc_id, sf AS short_form, lf AS long_form FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\b([A-Z][A-Z0-9-]{1,9}) stands for ((?:[A-Za-z][a-z]+ ){1,6}[A-Za-z][a-z]+)', 1)) AS sf, unnest(regexp_extract_all(text, '\b([A-Z][A-Z0-9-]{1,9}) stands for ((?:[A-Za-z][a-z]+ ){1,6}[A-Za-z][a-z]+)', 2)) AS lf FROM """ + PLANTED + ")")
def ex05_spoken_definitions(spark, d):
    rows = planted(spark, d).select("doc_id", F.explode(E.definitions(F.col("text"))).alias("x")).select("doc_id", "x.*")
    return rows.where("style = 'spoken'").select("doc_id", "short_form", "long_form")


@query(r"""SELECT doc_id, sf AS short_form, lf AS long_form FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\b([A-Z][A-Z0-9-]{1,9}) ?[=:] ?((?:[A-Za-z][a-z]+ ){1,6}[A-Za-z][a-z]+)', 1)) AS sf, unnest(regexp_extract_all(text, '\b([A-Z][A-Z0-9-]{1,9}) ?[=:] ?((?:[A-Za-z][a-z]+ ){1,6}[A-Za-z][a-z]+)', 2)) AS lf FROM """ + PLANTED + ")")
def ex06_inline_definitions(spark, d):
    rows = planted(spark, d).select("doc_id", F.explode(E.definitions(F.col("text"))).alias("x")).select("doc_id", "x.*")
    return rows.where("style = 'equals'").select("doc_id", "short_form", "long_form")


def _all(df: DataFrame, key: str, text: str, rx: str, *names: str) -> DataFrame:
    """One row for every match in a text, its groups named."""
    hit = df.select(key, F.explode(F.regexp_extract_all(text, F.lit(rx), F.lit(0))).alias("m"))
    return hit.select(key, *[F.regexp_extract("m", rx, i).alias(n) for i, n in enumerate(names, 1)])


def _all_sql(source: str, key: str, text: str, rx: str, *names: str) -> str:
    groups = ", ".join(f"regexp_extract(m, '{rx}', {i}) AS {n}" for i, n in enumerate(names, 1))
    return f"(SELECT {key}, {groups} FROM (SELECT {key}, unnest(regexp_extract_all({text}, '{rx}')) AS m FROM {source}))"


_LABELLED = r"[A-Z][A-Za-z]{2,20}(?: [a-z]{2,15})?: [^\n.;]{2,80}"


@query(rf"""SELECT doc_id, regexp_extract(m, '^([^:]+): ', 1) AS label, trim(regexp_extract(m, ': (.*)$', 1)) AS value FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{_LABELLED}')) AS m FROM {PLANTED})""")
def ex13_label_value(spark, d):
    """Every label with a colon and the value behind it."""
    hit = planted(spark, d).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(_LABELLED), F.lit(0))).alias("m"))
    return hit.select("doc_id", F.regexp_extract("m", "^([^:]+): ", 1).alias("label"), F.trim(F.regexp_extract("m", ": (.*)$", 1)).alias("value"))


@query("SELECT doc_id, code FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\\b([A-Z]{2,4}-[0-9]{3,6})\\b', 1)) AS code FROM " + PLANTED + ") GROUP BY ALL")
def ex16_compound_codes(spark, d):
    return E.typed_mentions(planted(spark, d), "doc_id", "text", {"compound": E.PATTERNS["compound"]}).select("doc_id", F.col("value").alias("code")).distinct()


@query(r"""SELECT doc_id, kind, value, substring(text, greatest(strpos(text, value) - 1 - 30, 0) + 1, strpos(text, value) - 1 - greatest(strpos(text, value) - 1 - 30, 0) + length(value) + 30) AS around FROM (""" + _union({k: E.PATTERNS[k] for k in ("trial_id", "doi", "pmid")}) + ") JOIN " + PLANTED + " p USING (doc_id)")
def ex19_citations(spark, d):
    from medloom.functions.text import window_around

    p = planted(spark, d)
    m = p.select("doc_id", "text", F.explode(E.all_matches(F.col("text"), {k: E.PATTERNS[k] for k in ("trial_id", "doi", "pmid")})).alias("m")).select("doc_id", "text", "m.kind", "m.value")
    at = F.instr(F.col("text"), F.col("value")) - 1
    return m.select("doc_id", "kind", "value", window_around(F.col("text"), at, F.length("value"), 30).alias("around"))


@query(r"""SELECT doc_id, name, credential FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\b([A-Z][a-z]+ [A-Z][a-z]+), (MD|PhD)\b', 1)) AS name, unnest(regexp_extract_all(text, '\b([A-Z][a-z]+ [A-Z][a-z]+), (MD|PhD)\b', 2)) AS credential FROM """ + PLANTED + ")")
def ex20_credentials(spark, d):
    rx = F.lit(r"\b([A-Z][a-z]+ [A-Z][a-z]+), (MD|PhD)\b")
    z = F.arrays_zip(F.regexp_extract_all("text", rx, 1).alias("n"), F.regexp_extract_all("text", rx, 2).alias("c"))
    return planted(spark, d).select("doc_id", F.explode(z).alias("x")).select("doc_id", F.col("x.n").alias("name"), F.col("x.c").alias("credential"))


_SECTION = r"""CASE WHEN regexp_matches(k, '^(abstract|summary)$') THEN 'abstract' WHEN regexp_matches(k, '^(background|introduction)$') THEN 'introduction' WHEN regexp_matches(k, '^(methods?|materials and methods)$') THEN 'methods'
WHEN regexp_matches(k, '^(results?|findings)$') THEN 'results' WHEN regexp_matches(k, '^(discussion|conclusions?)$') THEN 'discussion' WHEN regexp_matches(k, '^eligibility') THEN 'eligibility' WHEN regexp_matches(k, '^(references|bibliography)$') THEN 'references' END"""


@query(f"SELECT state_id, line_no, section FROM (SELECT state_id, line_no, {_SECTION} AS section FROM (SELECT state_id, line_no, lower(regexp_replace(line, '^[0-9.]+ *|[: ]+$', '', 'g')) AS k FROM {PAGES})) WHERE section IS NOT NULL")
def ex21_sections(spark, d):
    return pages(spark, d).select("state_id", "line_no", P.section_of(F.col("line")).alias("section")).where("section IS NOT NULL")


@query(r"""SELECT doc_id, measure, value FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(prevalence|incidence|Prevalence|Incidence|Mortality)[^.]{0,80}? ([0-9]+(?:\.[0-9]+)?) (?:per|in) [0-9m]', 1)) AS measure, unnest(regexp_extract_all(text, '(prevalence|incidence|Prevalence|Incidence|Mortality)[^.]{0,80}? ([0-9]+(?:\.[0-9]+)?) (?:per|in) [0-9m]', 2)) AS value FROM """ + PLANTED + ")")
def ex24_epidemiology(spark, d):
    rx = F.lit(r"(prevalence|incidence|Prevalence|Incidence|Mortality)[^.]{0,80}? ([0-9]+(?:\.[0-9]+)?) (?:per|in) [0-9m]")
    z = F.arrays_zip(F.regexp_extract_all("text", rx, 1).alias("m"), F.regexp_extract_all("text", rx, 2).alias("v"))
    return planted(spark, d).select("doc_id", F.explode(z).alias("x")).select("doc_id", F.col("x.m").alias("measure"), F.col("x.v").alias("value"))


@query(r"""SELECT doc_id, phase, n::INT AS n, unit FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(for|after|within|every) ([0-9]+) (days|weeks|months|years)', 1)) AS phase, unnest(regexp_extract_all(text, '(for|after|within|every) ([0-9]+) (days|weeks|months|years)', 2)) AS n, unnest(regexp_extract_all(text, '(for|after|within|every) ([0-9]+) (days|weeks|months|years)', 3)) AS unit FROM """ + PLANTED + ")")
def ex25_phases(spark, d):
    rx = F.lit(r"(for|after|within|every) ([0-9]+) (days|weeks|months|years)")
    z = F.arrays_zip(*[F.regexp_extract_all("text", rx, i).alias(n) for i, n in ((1, "p"), (2, "n"), (3, "u"))])
    return planted(spark, d).select("doc_id", F.explode(z).alias("x")).select("doc_id", F.col("x.p").alias("phase"), F.col("x.n").cast("int").alias("n"), F.col("x.u").alias("unit"))


_ENDPOINT = r"([Pp]rimary|[Ss]econdary|[Mm]ain|[Cc]o-primary) (?:endpoint|outcome|end point)s? (?:was|were|is|:) ([^.]+)"


@query("SELECT doc_id, lower(rank) AS rank, endpoint, regexp_extract(endpoint, 'at (week|month|day|year) ([0-9]+)', 2) AS at FROM " + _all_sql("documents", "doc_id", "text", _ENDPOINT, "rank", "endpoint"))
def ex26_endpoints(spark, d):
    """Every endpoint of a text with its rank and the time it is measured."""
    hit = _all(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", _ENDPOINT, "rank", "endpoint")
    return hit.select("doc_id", F.lower("rank").alias("rank"), "endpoint", F.regexp_extract("endpoint", "at (week|month|day|year) ([0-9]+)", 2).alias("at"))


_SITES = r"(?:at|in|from) ([0-9]+) (centres|centers|sites|hospitals)(?: in ([A-Z][a-z]+(?: [A-Z][a-z]+)?))?"


@query("SELECT doc_id, n::INT AS centres, kind, place FROM " + _all_sql("documents", "doc_id", "text", _SITES, "n", "kind", "place"))
def ex27_sites(spark, d):
    """Every number of centres with its place where one is named."""
    return _all(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", _SITES, "n", "kind", "place").select("doc_id", F.col("n").cast("int").alias("centres"), "kind", "place")


_SCREENED = r"([0-9]+) (?:patients |adults |participants |were )*screened(?: and|,)? ([0-9]+) (?:patients |were )*(?:enrolled|randomised|randomized|included)"


@query("SELECT doc_id, s::INT AS screened, e::INT AS enrolled, round((s::DOUBLE - e::DOUBLE) / s::DOUBLE * 100, 1) AS failure_rate FROM " + _all_sql(PLANTED, "doc_id", "text", _SCREENED, "s", "e") + " WHERE s::INT > 0")
def ex28_screening(spark, d):
    """Every pair of screened and enrolled numbers with the share that failed."""
    hit = _all(planted(spark, d), "doc_id", "text", _SCREENED, "s", "e").select("doc_id", F.col("s").cast("int").alias("screened"), F.col("e").cast("int").alias("enrolled")).where("screened > 0")
    return hit.withColumn("failure_rate", F.round((F.col("screened") - F.col("enrolled")) / F.col("screened") * 100, 1))


_LAB = r"(eGFR|h[a]?emoglobin|creatine kinase|filtration rate|(?:plasma|serum|urine) [a-z]+) (>=|<=|>|<|was|of|below|above|at least) ([0-9]+(?:[.][0-9]+)?)(?: ?(mL/min|mL|g/dL|units|mmol))?"


@query("SELECT doc_id, analyte, CASE WHEN op IN ('was', 'of') THEN '=' WHEN op = 'below' THEN '<' WHEN op = 'above' THEN '>' WHEN op = 'at least' THEN '>=' ELSE op END AS op, v::DOUBLE AS value, unit FROM " + _all_sql(PLANTED, "doc_id", "text", _LAB, "analyte", "op", "v", "unit"))
def ex29_lab_values(spark, d):
    """Every analyte with its comparison, value and unit."""
    op = F.when(F.col("op").isin("was", "of"), "=").when(F.col("op") == "below", "<").when(F.col("op") == "above", ">").when(F.col("op") == "at least", ">=").otherwise(F.col("op"))
    return _all(planted(spark, d), "doc_id", "text", _LAB, "analyte", "op", "v", "unit").select("doc_id", "analyte", op.alias("op"), F.col("v").cast("double").alias("value"), "unit")


@query(r"""SELECT result_id, i::INT AS part_no, trim(p) AS part, regexp_extract(p, '([0-9.]+) ?(?:mg|g|ug|mcg)', 1) AS dose FROM (SELECT result_id, unnest(range(len(l))) AS i, unnest(l) AS p FROM (SELECT result_id, regexp_split_to_array(source_text, ' because of | for | \(|\) ') AS l FROM zeroshot_results WHERE source_text IS NOT NULL))""")
def ex30_combination_parts(spark, d):
    z = table(spark, d, "zeroshot_results", "result_id", "source_text").where("source_text IS NOT NULL")
    p = z.select("result_id", F.posexplode(F.split("source_text", r" because of | for | \(|\) ")).alias("part_no", "p"))
    return p.select("result_id", "part_no", F.trim("p").alias("part"), F.regexp_extract("p", r"([0-9.]+) ?(?:mg|g|ug|mcg)", 1).alias("dose"))


_DATE = r"(?:[12][0-9]{3}-[01][0-9]-[0-3][0-9]|[0-3][0-9][.][01][0-9][.][12][0-9]{3})"


@query(f"SELECT doc_id, CAST(try_cast(CASE WHEN contains(v, '.') THEN v[7:10] || '-' || v[4:5] || '-' || v[1:2] ELSE v END AS DATE) AS VARCHAR) AS day, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{_DATE}')) AS v FROM {PLANTED}) GROUP BY ALL")
def ex33_dates(spark, d):
    """Every date of a text, written with hyphens or dots; impossible ones are null."""
    v = F.col("v")
    iso = F.when(v.contains("."), F.concat(F.substring(v, 7, 4), F.lit("-"), F.substring(v, 4, 2), F.lit("-"), F.substring(v, 1, 2))).otherwise(v)
    hit = planted(spark, d).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(_DATE), F.lit(0))).alias("v"))
    return hit.groupBy("doc_id", iso.try_cast("date").cast("string").alias("day")).agg(F.count("*").alias("n"))


@query(r"""SELECT doc_id, kind, n::INT AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\b(Figure|Table|Exhibit) ([0-9]+)', 1)) AS kind, unnest(regexp_extract_all(text, '\b(Figure|Table|Exhibit) ([0-9]+)', 2)) AS n FROM """ + PLANTED + ")")
def ex36_references(spark, d):
    rx = F.lit(r"\b(Figure|Table|Exhibit) ([0-9]+)")
    z = F.arrays_zip(F.regexp_extract_all("text", rx, 1).alias("k"), F.regexp_extract_all("text", rx, 2).alias("n"))
    return planted(spark, d).select("doc_id", F.explode(z).alias("x")).select("doc_id", F.col("x.k").alias("kind"), F.col("x.n").cast("int").alias("n"))


@query("SELECT e.entity_id, strpos(lower(s.t), lower(e.text)) > 0 AS quoted FROM ner_entities e JOIN (SELECT doc_id, max(full_text) AS t FROM pipeline_state GROUP BY doc_id) s USING (doc_id) WHERE e.text IS NOT NULL AND s.t IS NOT NULL")
def ex42_quotes(spark, d):
    t = table(spark, d, "pipeline_state").groupBy("doc_id").agg(F.lower(F.max("full_text")).alias("t")).where("t IS NOT NULL")
    e = table(spark, d, "ner_entities", "entity_id", "doc_id", "text").where("text IS NOT NULL")
    return e.join(t, "doc_id").select("entity_id", F.col("t").contains(F.lower("text")).alias("quoted"))


@query()
def ex42_quotes_windowed(spark, d):
    """As ``ex42_quotes``, white space folded, with the best window's ratio where the text hasn't the quote."""
    fold = lambda c: F.trim(F.regexp_replace(F.lower(c), r"[\s\u00a0\u2002\u2003\u2009]+", " "))
    t = table(spark, d, "pipeline_state").groupBy("doc_id").agg(F.max("full_text").alias("t")).where("t IS NOT NULL").select("doc_id", fold("t").alias("t"))
    e = table(spark, d, "ner_entities", "entity_id", "doc_id", "text").where("text IS NOT NULL").select("entity_id", "doc_id", fold("text").alias("q"))
    some = e.select("doc_id", "q").distinct().groupBy("doc_id").agg(F.collect_list("q").alias("q"))
    found = some.join(t, "doc_id").select("doc_id", F.explode(F.arrays_zip("q", E.quote_ratios("t", "q").alias("ratio"))).alias("x")).select("doc_id", "x.q", "x.ratio")
    return e.join(found, ["doc_id", "q"]).select("entity_id", F.col("ratio").isNotNull().alias("quoted"), F.round("ratio", 4).alias("ratio"))


@query(r"""SELECT entry_id, len(list_filter(v, lambda x: NOT list_contains(t, x))) AS unverified, round(power(0.7, len(list_filter(v, lambda x: NOT list_contains(t, x)))) * CASE WHEN strpos(text, structured_data.value) > 0 THEN 1.0 ELSE 0.5 END, 6) AS penalty
FROM (SELECT *, regexp_extract_all(structured_data.value, '[0-9]+(?:\.[0-9]+)?') AS v, regexp_extract_all(text, '[0-9]+(?:\.[0-9]+)?') AS t FROM feasibility_entries WHERE structured_data.value IS NOT NULL AND text IS NOT NULL)""")
def ex43_numbers_and_penalty(spark, d):
    f = table(spark, d, "feasibility_entries", "entry_id", "text", "structured_data").where("structured_data.value IS NOT NULL AND text IS NOT NULL")
    rx = F.lit(r"([0-9]+(?:\.[0-9]+)?)")
    missing = F.size(F.filter(F.regexp_extract_all("structured_data.value", rx, 1), lambda x: ~F.array_contains(F.regexp_extract_all("text", rx, 1), x))).cast("bigint")
    ok = F.col("text").contains(F.col("structured_data.value"))
    return f.select("entry_id", missing.alias("unverified"), F.round(S.verified_penalty(ok, missing), 6).alias("penalty"))


@query(r"""WITH v AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS w FROM """ + PLANTED + r"""), k(w, sense) AS (VALUES ('registry','registry'),('regional','registry'),('trial','trial'),('enrolled','trial'),('placebo','trial'),('biopsy','clinic'),('referred','clinic'),('underwent','clinic')),
s AS (SELECT doc_id, sense, count(*) AS n FROM v JOIN k USING (w) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, sense) AS p, lead(n) OVER (PARTITION BY doc_id ORDER BY n DESC, sense) AS second FROM s)
SELECT doc_id, sense, n FROM r WHERE p = 1 AND n >= 2 AND n - coalesce(second, 0) >= 1""")
def ex38_disambiguation(spark, d):
    from pyspark.sql import Window as W

    senses = {"registry": "registry", "regional": "registry", "trial": "trial", "enrolled": "trial", "placebo": "trial", "biopsy": "clinic", "referred": "clinic", "underwent": "clinic"}
    words = planted(spark, d).select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{4,})"), 1)).alias("w"))
    keys = F.create_map(*[F.lit(x) for kv in senses.items() for x in kv])
    votes = words.where(F.col("w").isin(*senses)).groupBy("doc_id", keys[F.col("w")].alias("sense")).agg(F.count("*").alias("n"))
    w = W.partitionBy("doc_id").orderBy(F.desc("n"), "sense")
    ranked = votes.withColumn("p", F.row_number().over(w)).withColumn("second", F.lead("n").over(w))
    return ranked.where((F.col("p") == 1) & (F.col("n") >= 2) & (F.col("n") - F.coalesce("second", F.lit(0)) >= 1)).select("doc_id", "sense", "n")


@query()
def ud02_span_table_function(spark, d):
    spark.udtf.register("mention_spans", E.MentionSpans)
    planted(spark, d).createOrReplaceTempView("planted_texts")
    return spark.sql("SELECT doc_id, kind, span_start, span_end, value FROM planted_texts, LATERAL mention_spans(text)")


# --- dictionary joins -------------------------------------------------------------


def _terms(spark, d):
    t = table(spark, d, "term_lexicon")
    return L.entries(t, "term_id", [F.array("preferred_label"), F.coalesce("synonyms", F.array().cast("array<string>"))])


_TOK = r"list_filter(string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
#: (gram, entry, priority, n) of the list's forms and (doc_id, start, n, entry) of the longest form at each place of a text.
_LEXICON = f"""f AS (SELECT gram, min(priority || entry)[2:] AS entry, min(priority)::INT AS priority, len(string_split(gram, ' ')) AS n FROM (SELECT term_id AS entry, priority, array_to_string({_TOK.format('form')}, ' ') AS gram
FROM (SELECT term_id, '0' AS priority, preferred_label AS form FROM term_lexicon UNION ALL SELECT term_id, (unnest(range(len(synonyms))))::VARCHAR, unnest(synonyms) FROM term_lexicon) WHERE form IS NOT NULL) WHERE gram <> '' GROUP BY gram),
"""


def _hits(source: str) -> str:
    return _LEXICON + f"""d AS (SELECT doc_id, {_TOK.format('text')} AS t FROM ({source}) WHERE text IS NOT NULL),
g AS (SELECT doc_id, p AS start, z AS n, array_to_string(list_slice(t, p + 1, p + z), ' ') AS gram FROM (SELECT doc_id, t, unnest(range(len(t))) AS p FROM d), (SELECT DISTINCT n AS z FROM f) WHERE p + z <= len(t)),
h AS (SELECT doc_id, start::INT AS start, n::INT AS n, entry, priority FROM (SELECT g.doc_id, g.start, g.n, f.entry, f.priority, row_number() OVER (PARTITION BY g.doc_id, g.start ORDER BY g.n DESC, f.priority, f.entry) AS r FROM g JOIN f ON f.gram = g.gram) WHERE r = 1)"""


@query(f"""WITH RECURSIVE {_hits('SELECT doc_id, text FROM documents')},
nx AS (SELECT a.doc_id, a.start, min(b.start) AS after FROM h a LEFT JOIN h b ON b.doc_id = a.doc_id AND b.start >= a.start + a.n GROUP BY 1, 2),
k AS (SELECT doc_id, min(start) AS start FROM h GROUP BY 1 UNION ALL SELECT k.doc_id, nx.after FROM k JOIN nx ON nx.doc_id = k.doc_id AND nx.start = k.start WHERE nx.after IS NOT NULL)
SELECT h.doc_id, h.start, h.n, h.entry, h.priority FROM k JOIN h ON h.doc_id = k.doc_id AND h.start = k.start""")
def jn01_dictionary_join(spark, d):
    """Longest, leftmost, non-overlapping lexicon terms in the documents."""
    return L.longest_leftmost(L.hits(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", broadcast_if_small(_terms(spark, d))), "doc_id")


@query("""SELECT e.entity_id, min(t.term_id) AS term_id FROM ner_entities e JOIN term_lexicon t ON lower(e.text) = lower(t.preferred_label) GROUP BY e.entity_id""")
def jn03_full_term(spark, d):
    t = table(spark, d, "term_lexicon").select(F.lower("preferred_label").alias("k"), "term_id")
    e = table(spark, d, "ner_entities").select("entity_id", F.lower("text").alias("k"))
    return e.join(broadcast_if_small(t), "k").groupBy("entity_id").agg(F.min("term_id").alias("term_id"))


@query(f"""WITH {_hits('SELECT doc_id, title AS text FROM documents')}, x AS (SELECT g.doc_id, f.entry, row_number() OVER (PARTITION BY g.doc_id ORDER BY g.n DESC, f.priority, f.entry DESC) AS r FROM g JOIN f ON f.gram = g.gram) SELECT doc_id, entry FROM x WHERE r = 1""")
def jn04_contained_term(spark, d):
    return L.contained(table(spark, d, "documents", "doc_id", "title"), "doc_id", "title", broadcast_if_small(_terms(spark, d)))


@query()
def jn05_exact_then_fuzzy(spark, d):
    """Exact term, else the most similar one with a ratio of 0.9 or more."""
    t = table(spark, d, "term_lexicon").select("term_id", F.lower("preferred_label").alias("k"))
    v = table(spark, d, "ner_entities").where("normalized IS NOT NULL").select(F.lower("normalized").alias("v")).distinct()
    exact = v.join(t, v["v"] == t["k"]).select("v", "term_id", F.lit(1.0).alias("ratio"))
    rest = v.join(exact, "v", "left_anti")
    similar = M.similar_texts(rest.select(F.col("v").alias("l")), t.select(F.col("k").alias("r")), [], 0.89995)
    near = similar.select(F.col("l").alias("v"), F.col("r").alias("k"), F.round("score", 4).alias("ratio")).where("ratio >= 0.9").join(t, "k")
    best = near.groupBy("v").agg(F.min(F.struct((-F.col("ratio")).alias("r"), "term_id")).alias("m")).select("v", "m.term_id", (-F.col("m.r")).alias("ratio"))
    return exact.unionByName(best)


@query(r"""SELECT d.doc_id, t.term_id FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '\b([A-Z]{3,6}[0-9]?)\b', 1)) AS sf FROM documents) d JOIN term_lexicon t ON t.abbreviation = d.sf WHERE NOT EXISTS (SELECT 1 FROM documents x WHERE x.doc_id = d.doc_id AND strpos(lower(x.text), lower(t.preferred_label)) > 0)""")
def jn08_abbreviation_recovery(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text")
    sf = docs.select("doc_id", "text", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\b([A-Z]{3,6}[0-9]?)\b"), 1))).alias("abbreviation"))
    t = table(spark, d, "term_lexicon").select("abbreviation", "term_id", F.lower("preferred_label").alias("label"))
    return sf.join(broadcast_if_small(t), "abbreviation").where(~F.lower("text").contains(F.col("label"))).select("doc_id", "term_id")


QUERIES, SQL = query.queries, query.sql
