"""Delimited sources: sentences, hits, relations, side files, mappings, genome tables, lists."""

from __future__ import annotations

import ast
import json
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of the tab-separated side files, in order; a line needs at least so many columns.
SIDE_FILES = {
    "title": ["doc_id", "title"],
    "author": ["doc_id", "firstname", "initials", "lastname"],
    "journal": ["doc_id", "journal", "journal_iso"],
    "citation": ["doc_id", "cited_id"],
    "date": ["doc_id", "year", "month", "day"],
    "pubtype": ["doc_id", "pub_type"],
    "pmid": ["pmc_id", "pmid"],
}
LEAST = {"journal": 2}
HITS = ["sent_id", "entry", "matched", "start", "length", "syn", "exact", "prefix", "suffix", "variant"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where("trim(value) <> ''").withColumn("_p", F.split("value", "\t"))


def sentences(spark: SparkSession, path: str) -> DataFrame:
    """``(sent_id, doc_id, par_id, sen_id, text)`` of .sent files; lines without exactly two columns are skipped."""
    from litweft.functions.text import sentence_parts

    two = _lines(spark, path).where(F.size("_p") == 2).select(F.col("_p")[0].alias("sent_id"), F.col("_p")[1].alias("text"))
    return two.select("sent_id", sentence_parts(F.col("sent_id")).alias("_s"), "text").select("sent_id", "_s.*", "text")


def hits(spark: SparkSession, path: str, shift_by_id: bool = False) -> DataFrame:
    """Hits of .index files; lines under seven columns are skipped. ``shift_by_id`` mends offsets that count the
    sentence id and its tab."""
    p = _lines(spark, path).where(F.size("_p") >= 7)
    cols = [F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(HITS)]
    h = p.select(*cols)
    entry = F.split("entry", ":")
    start = F.col("start").try_cast("int") - (F.length("sent_id") + 1 if shift_by_id else F.lit(0))
    return h.select(
        "sent_id", F.get(entry, F.lit(0)).try_cast("int").alias("dict_id"), F.get(entry, F.lit(1)).try_cast("int").alias("syn_idx"), "matched", start.alias("start"),
        (start + F.col("length").try_cast("int")).alias("end"), "syn", (F.lower("exact") == "true").alias("exact"), "prefix", "suffix", F.col("variant").try_cast("int").alias("variant"),
    )


def side_file(spark: SparkSession, path: str, kind: str, docs: DataFrame | None = None) -> DataFrame:
    """A side file by kind, short lines skipped; only documents in ``docs`` if given (semi-join). Author files get
    ``author_ord`` from the order of the lines of a document."""
    names = SIDE_FILES[kind]
    need = LEAST.get(kind, len(names))
    src = _lines(spark, path)
    if kind == "author":
        src = src.withColumn("_at", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))
    out = src.where(F.size("_p") >= need).select(*(F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(names)), *(["_at"] if kind == "author" else []))
    if kind == "date":
        out = out.select("doc_id", *(F.col(c).try_cast("int").alias(c) for c in names[1:]))
    if kind == "author":
        from pyspark.sql import Window

        out = out.withColumn("author_ord", F.row_number().over(Window.partitionBy("doc_id").orderBy("_at"))).drop("_at")
    return out if docs is None else out.join(docs.select("doc_id"), "doc_id", "left_semi")


def literal_column(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A column of Python literals (tuples, lists, texts, numbers) read as ``schema``.

    The text is parsed as a literal, never evaluated; tuples become JSON arrays in field order and go
    through from_json. A text that is no literal becomes null.
    """

    @F.pandas_udf("string")
    def to_json(s: pd.Series) -> pd.Series:
        def one(x):
            try:
                return None if x is None else json.dumps(ast.literal_eval(x))
            except (ValueError, SyntaxError, MemoryError, RecursionError):
                return None

        return s.map(one)

    target = T._parse_datatype_string(schema)
    as_json = df.withColumn(column, to_json(column))
    return as_json.withColumn(column, _from_arrays(F.from_json(column, _arrays(target)), target))


def _arrays(t: T.DataType) -> T.DataType:
    """The shape that a literal has as JSON: tuples are arrays, read as arrays of texts."""
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_arrays(t.elementType))
    return T.ArrayType(T.StringType()) if isinstance(t, T.StructType) else t


def _from_arrays(c: Column, t: T.DataType) -> Column:
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: _from_arrays(x, t.elementType))
    if isinstance(t, T.StructType):
        fields = []
        for i, f in enumerate(t.fields):
            raw = F.get(c, F.lit(i))
            inner = _from_arrays(F.from_json(raw, _arrays(f.dataType)), f.dataType) if isinstance(f.dataType, (T.ArrayType, T.StructType)) else raw.try_cast(f.dataType)
            fields.append(inner.alias(f.name))
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def delimited(spark: SparkSession, path: str, sep: str = "\t", header: bool = True, schema: str | None = None) -> DataFrame:
    """A delimited file with a header; types as given, else inferred."""
    r = spark.read.option("sep", sep).option("header", header)
    return r.schema(schema).csv(path) if schema else r.option("inferSchema", True).csv(path)


def gene2go(spark: SparkSession, path: str, taxa: list[str] | None = None, evidence: list[str] | None = None) -> DataFrame:
    """Gene annotations (tax_id, gene_id, go_id, evidence) of some organisms and evidence codes."""
    d = spark.read.option("sep", "\t").option("comment", "#").schema("tax_id string, gene_id string, go_id string, evidence string, qualifier string, term string, pubmed string, category string").csv(path)
    if taxa:
        d = d.where(F.col("tax_id").isin(taxa))
    return d.where(F.col("evidence").isin(evidence)) if evidence else d


#: Bytes of a synonym file; it is read as one row, so that its lines can be numbered.
MAX_SYNONYM_FILE = 512 << 20


def synonym_file(spark: SparkSession, path: str, dict_id: int = 0, fallback: str = "ISO-8859-1") -> DataFrame:
    """``(dict_id, syn_idx, syn_id, syn)`` of a synonym file; syn_idx is the line number from 0, duplicate ids keep
    their first line.

    A file that is no valid UTF-8 is read in the encoding ``fallback``. The file is one dictionary and is read by one
    task; one over MAX_SYNONYM_FILE bytes raises.
    """
    from litweft.functions.synonyms import from_line

    whole = spark.read.format("binaryFile").load(path)
    too_large = F.raise_error(F.lit(f"a synonym file is larger than {MAX_SYNONYM_FILE} bytes"))
    content = F.when(F.col("length") <= MAX_SYNONYM_FILE, F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), F.decode("content", fallback))).otherwise(too_large.cast("string"))
    lines = whole.select(F.posexplode(F.split(content, "\r?\n")).alias("syn_idx", "line")).where("line <> ''")
    parsed = lines.select("syn_idx", from_line(F.col("line")).alias("s")).select("syn_idx", "s.*")
    first = parsed.groupBy("syn_id").agg(F.min_by(F.struct("syn_idx", "syns"), "syn_idx").alias("r")).select("syn_id", "r.*")
    return first.select(F.lit(dict_id).alias("dict_id"), "syn_idx", "syn_id", F.explode("syns").alias("syn"))


def exclude_lists(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``(category, word)`` of word lists; all but manual and taxnames also in upper case."""
    out = None
    for name, path in paths.items():
        w = spark.read.text(path).select(F.lit(name).alias("category"), F.trim("value").alias("word")).where("word <> ''")
        if name not in ("manual", "taxnames"):
            w = w.unionByName(w.withColumn("word", F.upper("word")))
        out = w if out is None else out.unionByName(w)
    return out.distinct() if out is not None else spark.createDataFrame([], "category string, word string")


def gtf(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a GTF file with gene_id, gene_type and gene_name taken out of the attributes."""
    d = spark.read.option("sep", "\t").option("comment", "#").option("quote", "").schema("seqname string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string").csv(path)
    attr = lambda n: F.nullif(F.regexp_extract("attributes", f'{n} "([^"]*)"', 1), F.lit("")).alias(n)
    return d.select("seqname", "feature", "start", "end", "strand", attr("gene_id"), attr("gene_type"), attr("gene_name"))


def bed(spark: SparkSession, path: str) -> DataFrame:
    """Target sites of a BED file with 'gene:family' names."""
    return spark.read.option("sep", "\t").schema("chrom string, start long, end long, gene_mir string, score double, strand string, start2 long, end2 long, rgb string, blocks string, sizes string, starts string").csv(path)


def mirna_families(spark: SparkSession, path: str, species: int | None = None) -> DataFrame:
    """``(family, mirna)`` of a family table with the columns 'miR family', 'Species ID' and 'MiRBase ID'."""
    d = spark.read.option("sep", "\t").option("header", True).csv(path)
    d = d.select(F.col("miR family").alias("family"), F.col("Species ID").try_cast("int").alias("species"), F.col("MiRBase ID").alias("mirna"))
    return (d.where(F.col("species") == species) if species is not None else d).select("family", "mirna").distinct()


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """``(name, sequence)`` of FASTA records; a record is one row."""
    d = spark.read.option("lineSep", ">").text(path).where("trim(value) <> ''")
    lines = F.split("value", "\r?\n")
    return d.select(F.split(lines[0], "\\s")[0].alias("name"), F.array_join(F.slice(lines, F.lit(2), F.size(lines)), "").alias("sequence"))


def spans_of_inclusive(offset: Column) -> Column:
    """struct(start, end), half-open, of 'a-b' with an inclusive end."""
    p = F.split(offset, "-")
    return F.struct(p[0].try_cast("int").alias("start"), (F.get(p, F.lit(1)).try_cast("int") + 1).alias("end"))


def corpus_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Candidate pairs of an evaluation corpus: document / sentence / entity(id, text, type, charOffset) and
    pair(id, e1, e2, interaction), one row per pair with both entities' texts and spans."""
    ent = "array<struct<_id:string,_text:string,_type:string,_charOffset:string>>"
    pair = "array<struct<_id:string,_e1:string,_e2:string,_interaction:string>>"
    d = spark.read.format("xml").option("rowTag", "document").schema(f"_origId string, sentence array<struct<_id:string,_text:string,entity:{ent},pair:{pair}>>").load(path)
    s = d.select(F.col("_origId").alias("doc_id"), F.explode("sentence").alias("s")).select("doc_id", F.col("s._id").alias("sent_id"), F.col("s._text").alias("text"), "s.entity", F.explode("s.pair").alias("p"))
    pick = lambda c: F.get(F.filter("entity", lambda e: e["_id"] == F.col(c)), F.lit(0))
    s = s.withColumn("_x", pick("p._e1")).withColumn("_y", pick("p._e2"))
    return s.select(
        "doc_id", "sent_id", "text", F.col("p._id").alias("pair_id"), (F.lower("p._interaction") == "true").alias("interaction"), F.col("_x._text").alias("e1"), F.col("_x._type").alias("type1"),
        spans_of_inclusive(F.col("_x._charOffset")).alias("loc1"), F.col("_y._text").alias("e2"), F.col("_y._type").alias("type2"), spans_of_inclusive(F.col("_y._charOffset")).alias("loc2"),
    )
