"""Queries of the two general (non-llm) training-data problems, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litweft.operators.skew import heavy_keys, per_key_summary
from litweft.operators.unpack import IDS, NAMES, SPANS, unpack
from litweft.session import spread, table


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Values of either family column that at least one fiftieth of all rows of mx hold."""
    return heavy_keys(table(spark, sf, "mx"), ["mirna_family", "gene_family"], one_in=50).select("field_name", "family")


def p3_per_family(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, partners and evidence of every value of both family columns."""
    mx = table(spark, sf, "mx")
    parts = [
        per_key_summary(mx, key, partner, "evidence_count").select(F.lit(key).alias("field_name"), "*")
        for key, partner in (("mirna_family", "gene_family"), ("gene_family", "mirna_family"))
    ]
    return parts[0].unionByName(parts[1])


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """One row per value packed in organisms, evidence_documents and sent_evidences of every row of mx."""
    return unpack(spread(table(spark, sf, "mx")), {"organisms": NAMES, "evidence_documents": IDS, "sent_evidences": SPANS}, keep=["row_id"])


QUERIES = {"p3_found": p3_found, "p3_per_family": p3_per_family, "p4_found": p4_found}

_FAMILIES = """
WITH v AS (
  SELECT 'mirna_family' AS field_name, mirna_family AS family, gene_family AS partner, evidence_count FROM mx
  UNION ALL SELECT 'gene_family', gene_family, mirna_family, evidence_count FROM mx)
"""

ORACLE = {
    "p3_found": _FAMILIES + """
SELECT field_name, family FROM v WHERE family <> ''
GROUP BY field_name, family HAVING count(*) * 50 >= (SELECT count(*) FROM mx)""",
    "p3_per_family": _FAMILIES + """
SELECT field_name, family, count(*) AS n_rows, count(DISTINCT CASE WHEN partner <> '' THEN partner END) AS partners,
       CAST(coalesce(sum(evidence_count), 0) AS BIGINT) AS evidence
FROM v WHERE family <> '' GROUP BY field_name, family""",
}
