"""Queries of the training-data problems tagged llm, with their SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litweft.llm.lookalike import canonical, equal_looking, look_classes
from litweft.llm.mixture import mix, shares, target_tree
from litweft.llm.names import link_names, linked_pairs
from litweft.llm.pairs import PairTable, baskets, row_baskets
from litweft.llm.terms import mark_terms, record_key, term_rows
from litweft.llm.tokens import count_tokens, encode
from litweft.llm.topn import top_n
from litweft.session import materialise, spread, table

MX_KEY = ["mirna_family", "gene_family", "interaction", "chunk_id"]


# -- 1: items that appear together -------------------------------------------------------------------
def _pair_table(spark: SparkSession, sf: str) -> PairTable:
    concepts = baskets(table(spark, sf, "mx_annot"), "concept", "doc_id", "concept")
    families = row_baskets(table(spark, sf, "mx"), "family", MX_KEY, ["mirna_family", "gene_family"])
    return PairTable(spark).update(concepts.unionByName(families))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs in at least 4 records and at least 5 times as often together as by chance."""
    return _pair_table(spark, sf).scores(min_pair=4, min_lift=5).select("kind", "item_a", "item_b")


def p1_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Every pair with its count and ratio to chance."""
    return _pair_table(spark, sf).scores().select("kind", "item_a", "item_b", "n_ab", F.round("lift", 6).alias("lift"))


def p1_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The same counts, by a first load and one update.

    The rows loaded in the first half of the time come first; then every record that a later row touches is taken back
    as it was and entered as it is.
    """
    annot, mx = table(spark, sf, "mx_annot"), table(spark, sf, "mx")
    rows: dict[str, tuple[DataFrame, DataFrame]] = {}
    for name, df in (("annot", annot), ("mx", mx)):
        at = F.unix_micros(F.col("loaded_at").cast("timestamp"))
        first, last = df.agg(F.min(at), F.max(at)).first()
        late = F.coalesce(at > F.lit(((first or 0) + (last or 0)) // 2), F.lit(False))
        rows[name] = df.where(~late), df.where(late)
    early, late = rows["annot"]
    touched = late.select("doc_id").distinct()
    concepts = lambda df: baskets(df, "concept", "doc_id", "concept")
    families = lambda df: row_baskets(df, "family", MX_KEY, ["mirna_family", "gene_family"])
    now = families(rows["mx"][1])
    t = PairTable(spark).update(concepts(early).unionByName(families(rows["mx"][0])))
    was = concepts(early.join(touched, "doc_id", "left_semi")).unionByName(families(rows["mx"][0]).join(now.select("basket"), "basket", "left_semi"))
    t = PairTable.open(spark, t.path).update(concepts(annot.join(touched, "doc_id", "left_semi")).unionByName(now), was)
    return t.scores().select("kind", "item_a", "item_b", "n_ab", F.round("lift", 6).alias("lift"))


# -- 2: top N items within every group ---------------------------------------------------------------
def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """The five genes of every miRNA family with the highest evidence."""
    best = top_n(table(spark, sf, "mx"), "mirna_family", "gene_family", "evidence_count", 5)
    return best.select("mirna_family", "place", "gene_family")


# -- 5: variant spellings of names --------------------------------------------------------------------
def _links(spark: SparkSession, sf: str) -> DataFrame:
    return link_names(table(spark, sf, "mx_authors"), table(spark, sf, "short_names"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs of spellings that name the same person or organisation."""
    return linked_pairs(_links(spark, sf))


def p5_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Every spelling's cluster, both named by their smallest row id."""
    return _links(spark, sf).select(F.col("id").alias("row_id"), F.col("cluster").alias("cluster_id"))


# -- 6: frequency of every value ---------------------------------------------------------------------
def _terms(spark: SparkSession, sf: str) -> DataFrame:
    annot, mx = table(spark, sf, "mx_annot"), table(spark, sf, "mx")
    docs = annot.where("doc_id is not null and doc_id <> ''")
    rows = term_rows(docs, record_key("doc_id"), ["concept", "annotation"])
    return mark_terms(rows.unionByName(term_rows(mx, record_key(*MX_KEY), ["gene_family"])))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Values in too few or too many records."""
    return _terms(spark, sf).where("mark is not null").select("field_name", "val", "mark")


def p6_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and records of every value, marked."""
    return _terms(spark, sf).select("field_name", "val", "occurrences", "records", "mark")


# -- 7: encoding -------------------------------------------------------------------------------------
def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document by byte_bpe_50k."""
    return encode(spread(table(spark, sf, "documents").select("doc_id", "text")))


# -- 8: mixture --------------------------------------------------------------------------------------
#: Sources that the targets may name; they are planned on the driver, and more are refused.
MAX_TARGETS = 100_000


def _mixture(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The tree is domain (last word of the source: article, note, ...) / source / language."""
    domain = F.substring_index(F.coalesce("source", F.lit("")), "_", -1)
    docs = spread(table(spark, sf, "documents").select("doc_id", "source", "lang", "text", domain.alias("domain")))
    docs = materialise(count_tokens(docs, keep=("doc_id", "domain", "source", "lang")), "sizes")
    targets = table(spark, sf, "mix_targets")
    weights, repeats = target_tree(named_targets(targets), lambda s: s.rsplit("_", 1)[-1])
    return docs, mix(docs, "n_tokens", ["domain", "source", "lang"], weights, repeats).drop("domain"), targets


def named_targets(targets: DataFrame) -> list[tuple[str, float, int]]:
    """The rows of the list of targets; too many raise, as a dropped one would change every share.

    Rows without a source or a share aim at nothing; without a number of repeats it is 1.
    """
    rows = targets.where("source is not null and target_share is not null")
    rows = rows.select("source", "target_share", F.coalesce("max_repeats", F.lit(1))).limit(MAX_TARGETS + 1).collect()
    if len(rows) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    return [tuple(r) for r in rows]


def p8_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """The mixture: one row per use of a document."""
    return _mixture(spark, sf)[1]


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    """The shares that the mixture reaches, by source."""
    docs, mixture, targets = _mixture(spark, sf)
    return shares(docs, mixture, "n_tokens", "source", targets, "target_share", "max_repeats")


# -- 9: visually identical text ----------------------------------------------------------------------
def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of documents whose texts differ but look the same."""
    return equal_looking(spread(table(spark, sf, "documents").select("doc_id", "text")))


def p9_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Every such document with its class and the number of its partners."""
    return look_classes(spread(table(spark, sf, "documents").select("doc_id", "text")))


def p9_canonical(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's text in its consistent form."""
    return canonical(spread(table(spark, sf, "documents").select("doc_id", "text"))).select("doc_id", "canon")


QUERIES = {
    "p1_found": p1_found, "p1_pairs": p1_pairs, "p1_incremental": p1_incremental, "p2_found": p2_found, "p5_found": p5_found, "p5_clusters": p5_clusters, "p6_found": p6_found, "p6_terms": p6_terms, "p7_ids": p7_ids,
    "p8_mixture": p8_mixture, "p8_shares": p8_shares, "p9_found": p9_found, "p9_classes": p9_classes, "p9_canonical": p9_canonical,
}

_PAIRS = """
WITH rec AS (
  SELECT DISTINCT 'concept' AS kind, doc_id AS r, concept AS item FROM mx_annot WHERE concept <> '' AND doc_id <> ''
), fam AS (
  SELECT DISTINCT mirna_family, gene_family, interaction, chunk_id FROM mx WHERE mirna_family <> '' AND gene_family <> ''
), single AS (
  SELECT kind, item, count(*) AS n FROM rec GROUP BY ALL
  UNION ALL
  SELECT 'family', item, count(*) FROM (SELECT mirna_family AS item FROM fam UNION ALL SELECT gene_family FROM fam WHERE gene_family <> mirna_family) GROUP BY ALL
), pair AS (
  SELECT x.kind, x.item AS a, y.item AS b, count(*) AS n FROM rec x JOIN rec y ON x.r = y.r AND x.item < y.item GROUP BY ALL
  UNION ALL
  SELECT 'family', least(mirna_family, gene_family), greatest(mirna_family, gene_family), count(*) FROM fam WHERE mirna_family <> gene_family GROUP BY ALL
), total AS (
  SELECT 'concept' AS kind, count(DISTINCT r) AS n FROM rec UNION ALL SELECT 'family', count(*) FROM fam
), scored AS (
  SELECT p.kind, a AS item_a, b AS item_b, p.n AS n_ab, t.n AS n_records, sa.n AS n_a, sb.n AS n_b
  FROM pair p JOIN total t USING (kind) JOIN single sa ON sa.kind = p.kind AND sa.item = a JOIN single sb ON sb.kind = p.kind AND sb.item = b)
"""
_TERMS = """
WITH v AS (
  SELECT 'concept' AS field_name, concept AS val, doc_id AS r FROM mx_annot WHERE concept <> '' AND doc_id <> ''
  UNION ALL SELECT 'annotation', annotation, doc_id FROM mx_annot WHERE annotation <> '' AND doc_id <> ''
  UNION ALL SELECT 'gene_family', gene_family, CAST((mirna_family, gene_family, interaction, chunk_id) AS VARCHAR) FROM mx WHERE gene_family <> ''
), n AS (SELECT field_name, count(DISTINCT r) AS n FROM v GROUP BY 1
), c AS (SELECT field_name, val, count(*) AS occurrences, count(DISTINCT r) AS records FROM v GROUP BY 1, 2
), m AS (
  SELECT c.*, CASE WHEN records < 3 THEN 'rare' WHEN records * 20 > n THEN 'common' END AS mark FROM c JOIN n USING (field_name))
"""

ORACLE = {
    "p1_found": _PAIRS + "SELECT kind, item_a, item_b FROM scored WHERE n_ab >= 4 AND n_ab * n_records >= 5 * n_a * n_b",
    "p1_pairs": _PAIRS + "SELECT kind, item_a, item_b, n_ab, round(n_ab * CAST(n_records AS DOUBLE) / (n_a * CAST(n_b AS DOUBLE)), 6) AS lift FROM scored",
    "p1_incremental": _PAIRS + "SELECT kind, item_a, item_b, n_ab, round(n_ab * CAST(n_records AS DOUBLE) / (n_a * CAST(n_b AS DOUBLE)), 6) AS lift FROM scored",
    "p2_found": """
SELECT mirna_family, place, gene_family FROM (
  SELECT mirna_family, gene_family, CAST(row_number() OVER (PARTITION BY mirna_family ORDER BY s DESC, gene_family) AS INTEGER) AS place
  FROM (SELECT mirna_family, gene_family, max(evidence_count) AS s FROM mx
        WHERE mirna_family <> '' AND gene_family <> '' AND evidence_count IS NOT NULL GROUP BY ALL)) WHERE place <= 5""",
    "p6_found": _TERMS + "SELECT field_name, val, mark FROM m WHERE mark IS NOT NULL",
    "p6_terms": _TERMS + "SELECT field_name, val, occurrences, records, mark FROM m",
}
