"""Registry of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.session import table


class Registry:
    """Collects queries by name; ``sql`` is the same in DuckDB's dialect, or None."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def add(f):
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return add


#: Sentences planted behind document texts, so that every pattern has hits that grow with the data.
TEMPLATES = [
    "Tumor Necrosis Factor (TNF) rose, see NCT01234567 and PMID: 12345678.",
    "Patients with systemic lupus erythematosus (SLE) took ABC-1234 at 10 mg, doi 10.1000/xyz123.",
    "GFR = glomerular filtration rate; contact jane.doe@example.org or 0000-0002-1825-0097.",
    "ACE stands for angiotensin converting enzyme and the variant c.123A>G (rs123456) was absent.",
    "The prevalence was 5 in 100,000 and 12% had p.Arg97Cys, HP:0001250 and ORPHA:558.",
    "No evidence of renal failure was seen; NYHA II and eGFR >= 30 mL were required.",
    "See Figure 2 and Table 3, published 2021-05-17 at https://example.org/data/set1 under PMC1234567.",
    "Mother had possible Marfan syndrome; dose 20 mg/kg for 12 weeks (p < 0.01).",
    "Major Adverse Cardiac Event (MACE) rates were 1/2000; Jane Doe, MD signed the report.",
    "Forced Vital Capacity (FVC) fell by 4.5% within 6 months in HGNC:1100 carriers.",
    "Randomized trial in Germany and USA, 45 sites; 120 screened and 80 enrolled.",
    "BMI: body mass index was 24.1 and hemoglobin was 11.5 g/dL.",
]


def planted(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, text): documents with a planted sentence each."""
    n = len(TEMPLATES)
    pick = F.element_at(F.array(*map(F.lit, TEMPLATES)), (F.col("doc_id") % n + 1).cast("int"))
    return table(spark, d, "documents", "doc_id", "text").where("text IS NOT NULL").select("doc_id", F.concat("text", F.lit(" "), pick).alias("text"))


PLANTED = "(SELECT doc_id, text || ' ' || (CASE doc_id % %d %s END) AS text FROM documents WHERE text IS NOT NULL)".replace("% %d", f"% {len(TEMPLATES)}").replace("%s", " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TEMPLATES)))


def blocks(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, block_no, block): the non-blank lines of the documents, in order."""
    cut = table(spark, d, "documents", "doc_id", "text").select("doc_id", F.posexplode(F.split("text", "\n")).alias("block_no", "block"))
    return cut.select("doc_id", "block_no", F.trim("block").alias("block")).where("block <> ''")


BLOCKS = "(SELECT doc_id, block_no, trim(block) AS block FROM (SELECT doc_id, unnest(range(len(l)))::INT AS block_no, unnest(l) AS block FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)) WHERE trim(block) <> '')"


def pages(spark: SparkSession, d: str) -> DataFrame:
    """(state_id, line_no, line, page): the non-blank lines of runs' texts with their page."""
    from pyspark.sql import Window as W

    cut = table(spark, d, "pipeline_state", "state_id", "full_text_with_pages").select("state_id", F.posexplode(F.split("full_text_with_pages", "\n")).alias("i", "x"))
    rows = cut.select("state_id", (F.col("i") + 1).alias("line_no"), F.rtrim("x", F.lit("\r ")).alias("line")).where("line <> ''")
    mark = F.regexp_extract("line", r"^--- Page ([0-9]+) ---$", 1).try_cast("int")
    page = F.last(mark, ignorenulls=True).over(W.partitionBy("state_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn("page", page).where(~F.col("line").rlike(r"^--- Page [0-9]+ ---$"))


PAGES = r"""(SELECT state_id, line_no, line, page FROM (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY state_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS page
FROM (SELECT *, try_cast(regexp_extract(line, '^--- Page ([0-9]+) ---$', 1) AS INT) AS mark FROM (SELECT state_id, (unnest(range(len(l))) + 1)::INT AS line_no, rtrim(unnest(l), chr(13) || ' ') AS line
FROM (SELECT state_id, string_split(full_text_with_pages, chr(10)) AS l FROM pipeline_state WHERE full_text_with_pages IS NOT NULL)) WHERE line <> '')) WHERE NOT regexp_matches(line, '^--- Page [0-9]+ ---$'))"""
