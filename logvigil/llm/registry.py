"""The registered queries of the corpus operators, and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logvigil.llm.common import fold
from logvigil.llm.exact_dedup import exact_dedup
from logvigil.llm.html_text import extract_main_text
from logvigil.llm.jaccard_join import jaccard_groups
from logvigil.llm.line_dedup import line_dedup
from logvigil.llm.neighbours import nearest
from logvigil.llm.ngram_model import lm_scores
from logvigil.llm.ngram_model import train as train_ngrams
from logvigil.llm.packing import pack
from logvigil.llm.phrases import collocations
from logvigil.llm.pii import KINDS, personal_data
from logvigil.llm.quality import THRESHOLD, quality_scores, train
from logvigil.llm.segments import segments
from logvigil.llm.simhash import simhash_groups
from logvigil.llm.source_audit import source_divergence


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract_main_text(_table(spark, sf_dir, "pages")).select("page.page_id", "page.url", "text", "n_chars")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents."""
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents under a model of those outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 7) == 2
    plan = train_ngrams(docs.filter(~held_out))
    return lm_scores(docs.withColumn("held_out", held_out), plan).select(
        "doc.doc_id",
        "doc.held_out",
        "n_tokens",
        "n_known",
        F.lit(plan.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty nearest vectors of each vector whose id is divisible by 20."""
    return nearest(_table(spark, sf_dir, "embeddings"), "id % 20 = 0")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of windows."""
    return pack(_table(spark, sf_dir, "documents"))


def op6_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best segmentations of all documents, and whether the best one decodes to the text."""
    found = segments(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.transform(
        F.arrays_zip("scores", "ids"),
        lambda x: F.struct(x["scores"].alias("score"), F.size(x["ids"]).cast("long").alias("n_pieces"), F.xxhash64(x["ids"]).alias("ids_hash")),
    )
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        "round_trip",
        F.posexplode(digest).alias("pos", "d"),
    ).select("doc_id", (F.col("pos") + 1).alias("rank"), "d.score", "d.n_pieces", "d.ids_hash", "round_trip")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learnt from labels outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    model = train(docs, _table(spark, sf_dir, "labels"), "quality")
    return quality_scores(docs, model).select(
        F.col("doc.doc_id").alias("doc_id"),
        (fold("doc.doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    groups = simhash_groups(_table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents, and the lines removed."""
    return line_dedup(_table(spark, sf_dir, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"),
        "n_lines",
        F.size("removed").cast("long").alias("n_removed"),
        F.concat_ws(",", F.col("removed").cast("array<string>")).alias("removed"),
        "text",
    )


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return personal_data(_table(spark, sf_dir, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"),
        *[f"n_{kind}" for kind in KINDS],
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
    )


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose shingle sets reach a Jaccard similarity of 0.8."""
    return jaccard_groups(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of all documents whose words keep together, per language."""
    return collocations(_table(spark, sf_dir, "documents"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of each language, and their strongest terms, over all documents."""
    return source_divergence(_table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": op1_main_text,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_lm_scores": op3_lm_scores,
    "op4_nearest": op4_nearest,
    "op5_packing": op5_packing,
    "op6_segments": op6_segments,
    "op7_quality": op7_quality,
    "op8_simhash": op8_simhash,
    "op9_line_dedup": op9_line_dedup,
    "op10_personal_data": op10_personal_data,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_collocations": op12_collocations,
    "op13_source_audit": op13_source_audit,
}

LLM_ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op9_line_dedup": """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, p - 1 AS pos, trim(lines[p], concat(' ', chr(9), chr(11), chr(12), chr(13))) AS line
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS p FROM d)),
w AS (
  SELECT doc_id, pos AS first, lead(pos, 2) OVER v AS last,
         concat(line, chr(10), lead(line, 1) OVER v, chr(10), lead(line, 2) OVER v) AS win
  FROM l WHERE line <> '' WINDOW v AS (PARTITION BY doc_id ORDER BY pos)),
r AS (
  SELECT doc_id, last, row_number() OVER v AS nth,
         CASE WHEN first_value(doc_id) OVER v = doc_id THEN greatest(first, first_value(last) OVER v + 1) ELSE first END AS start
  FROM w WHERE last IS NOT NULL WINDOW v AS (PARTITION BY win ORDER BY doc_id, first)),
marked AS (
  SELECT l.doc_id, l.pos, bool_or(r.nth > 1) AS gone
  FROM l JOIN r ON r.doc_id = l.doc_id AND l.pos BETWEEN r.start AND r.last GROUP BY ALL)
SELECT d.doc_id, len(d.lines) AS n_lines,
       (SELECT count(*) FROM marked m WHERE m.doc_id = d.doc_id AND gone) AS n_removed,
       coalesce((SELECT string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) FROM marked m WHERE m.doc_id = d.doc_id AND gone), '') AS removed,
       coalesce((SELECT string_agg(d.lines[p], chr(10) ORDER BY p) FROM (SELECT unnest(range(1, len(d.lines) + 1)) AS p)
                 WHERE p - 1 NOT IN (SELECT pos FROM marked m WHERE m.doc_id = d.doc_id AND gone)), '') AS text
FROM d""",
    "op12_collocations": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
s AS (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, range(1, 6) AS r(k)),
f AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*)::HUGEINT AS f
  FROM s GROUP BY ALL),
n AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY ALL),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS words, f AS a FROM f WHERE k > 1 AND f >= 100),
cuts AS (
  SELECT c.lang, c.k, c.phrase, a, x.cut, l.f AS l, r.f AS r, n, 1000 * a * n // (l.f * r.f) AS score
  FROM c JOIN range(1, 5) AS x(cut) ON x.cut < c.k JOIN n USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(words[1:x.cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(words[x.cut + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM c WHERE c.lang = b.lang AND c.k > b.k AND c.a >= b.a
      AND contains(concat(' ', c.phrase, ' '), concat(' ', b.phrase, ' '))))
SELECT lang, row_number() OVER w AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= 2000""",
    "op13_source_audit": r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (
  SELECT lang, term, count(*)::HUGEINT AS c FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY ALL),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c,
         1 + 1000000000 * (coalesce(c.c, 0) + 5) // (coalesce(n.n, 0) + 5 * v.v) AS p,
         1 + 1000000000 * (kept.c + 5) // (v.n + 5 * v.v) AS q
  FROM g JOIN kept USING (lang) JOIN v USING (lang)
  LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(apart.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE c > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM rows
QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 50""",
}
