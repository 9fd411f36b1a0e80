"""Search, filter, page, facet and statistics over the serving tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INTERACTION = ("mirna_family", "gene_family", "interaction")


def anchored(column: Column, term: str) -> Column:
    """Case-insensitive search: '^' anchors the start and '$' the end, '%' and '_' are ordinary characters."""
    head, tail = term.startswith("^"), term.endswith("$")
    core = term[head : len(term) - tail if tail else None]
    escaped = core.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return column.ilike(("" if head else "%") + escaped + ("" if tail else "%"))


@dataclass
class TableQuery:
    """A request of the table view.

    ``search`` must match one of ``search_columns``; ``columns`` are per-column anchored searches;
    ``ranges`` are (low, high) with None for open; ``equals`` are exact ('yes'/'no' mean 1/0);
    ``order`` is (column, descending); ties are settled by ``tie``.
    """

    search: str = ""
    search_columns: Sequence[str] = ("mirna_family", "gene_family")
    columns: Mapping[str, str] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    equals: Mapping[str, object] = field(default_factory=dict)
    order: Sequence[tuple[str, bool]] = ()
    tie: Sequence[str] = ("row_id",)
    start: int = 0
    length: int = 10

    @classmethod
    def from_request(cls, args: Mapping[str, str], range_mark: str = "-yadcf_delim-", exact: Sequence[str] = ()) -> TableQuery:
        """From the parameters of a table request: search[value], columns[i][data], columns[i][search][value],
        order[i][column|dir], start, length."""
        q = cls(search=args.get("search[value]", ""), start=int(args.get("start", 0)), length=int(args.get("length", 10)))
        names, cols, ranges, equals, i = [], {}, {}, {}, 0
        while (name := args.get(f"columns[{i}][data]")) is not None:
            names.append(name)
            if term := args.get(f"columns[{i}][search][value]", ""):
                if range_mark in term:
                    low, _, high = term.partition(range_mark)
                    ranges[name] = (float(low) if low else None, float(high) if high else None)
                elif name in exact:
                    equals[name] = term
                else:
                    cols[name] = term
            i += 1
        order, i = [], 0
        while (at := args.get(f"order[{i}][column]")) is not None:
            order.append((names[int(at)], args.get(f"order[{i}][dir]") == "desc"))
            i += 1
        q.columns, q.ranges, q.equals, q.order = cols, ranges, equals, order
        return q


def predicate(q: TableQuery) -> Column:
    """The condition of a request; a conjunction of plain column predicates, so it reaches the scan."""
    ok = F.lit(True)
    if q.search:
        hit = F.lit(False)
        for c in q.search_columns:
            hit = hit | F.coalesce(anchored(F.col(c), q.search), F.lit(False))
        ok = ok & hit
    for c, term in q.columns.items():
        ok = ok & anchored(F.col(c), term)
    for c, (low, high) in q.ranges.items():
        if low is not None:
            ok = ok & (F.col(c) >= low)
        if high is not None:
            ok = ok & (F.col(c) <= high)
    for c, v in q.equals.items():
        ok = ok & (F.col(c) == F.lit({"yes": 1, "no": 0}.get(v, v) if isinstance(v, str) else v))
    return ok


def matching(df: DataFrame, q: TableQuery) -> DataFrame:
    """The rows that a request selects, before order and page."""
    return df.where(predicate(q))


def page(df: DataFrame, q: TableQuery) -> DataFrame:
    """The ordered page of a request."""
    order = [F.desc_nulls_last(c) if d else F.asc_nulls_last(c) for c, d in q.order] + [F.asc(c) for c in q.tie]
    return matching(df, q).orderBy(*order).offset(q.start).limit(q.length)


def counts(df: DataFrame, q: TableQuery) -> DataFrame:
    """``(total, filtered)`` in one pass: the filter is a conditional count."""
    return df.agg(F.count("*").alias("total"), F.count_if(predicate(q)).alias("filtered"))


def search(df: DataFrame, q: TableQuery) -> tuple[DataFrame, DataFrame]:
    """(page, counts) of a request."""
    return page(df, q), counts(df, q)


def by_context(mx: DataFrame, mx_int: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of ``mx`` with an interaction seen in one of ``docs``: semi-joins on the three-column key."""
    keys = mx_int.join(docs.select("doc_id"), "doc_id", "left_semi").select(*INTERACTION)
    return mx.join(keys, list(INTERACTION), "left_semi")


def facet_documents(annots: DataFrame, facets: Sequence[tuple[Sequence[str], Sequence[str] | None]]) -> DataFrame:
    """``doc_id`` of documents that meet every facet; a facet is (vocabularies, concepts), met by
    any of them; concepts None means any concept of the vocabularies.

    One aggregation for all facets, with the rows of no facet filtered out before the exchange.
    """
    each = [F.coalesce(F.col("annotation").isin(list(v)) & (F.lit(True) if c is None else F.col("concept").isin(list(c))), F.lit(False)) for v, c in facets]
    any_ = F.lit(False)
    for e in each:
        any_ = any_ | e
    flags = [F.max(e).alias(f"_f{i}") for i, e in enumerate(each)]
    found = annots.where(any_).groupBy("doc_id").agg(*flags)
    for i in range(len(each)):
        found = found.where(f"_f{i}")
    return found.select("doc_id")


def relation(mx: DataFrame, mirna: str | None = None, gene: str | None = None, interaction: str | None = None) -> DataFrame:
    """Rows of one miRNA, gene and/or interaction, most evidence first."""
    for c, v in (("mirna_family", mirna), ("gene_family", gene), ("interaction", interaction)):
        if v is not None:
            mx = mx.where(F.col(c) == v)
    return mx.orderBy(F.desc_nulls_last("evidence_count"), "mirna_family", "gene_family", "interaction", "row_id")


def details(relations: DataFrame, sentences: DataFrame, annots: DataFrame) -> DataFrame:
    """``(mirna_family, gene_family, interaction, doc_id, sent_id, text, concepts)`` of relations (keys, doc_id,
    sent_id): the sentence of every evidence and the sorted concepts annotated in its document."""
    per = annots.where("concept <> ''").groupBy("doc_id").agg(F.array_sort(F.collect_set("concept")).alias("concepts"))
    out = relations.join(sentences.select("sent_id", "text"), "sent_id").join(per, "doc_id", "left")
    return out.select(*INTERACTION, "doc_id", "sent_id", "text", F.coalesce("concepts", F.array().cast("array<string>")).alias("concepts"))


def as_object(**fields: Column) -> Column:
    """A row as a JSON object of the given fields, in their order; a null is written as null."""
    return F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())), {"ignoreNullFields": "false"})


def source_link(doc: Column) -> Column:
    """struct(source, id) of a document for the row view."""
    return F.struct(F.when(doc.startswith("PMC"), "PMC").otherwise("PUBMED").alias("source"), doc.alias("id"))


def lookup(df: DataFrame, docs: DataFrame, vocabularies: Sequence[str] | None = None) -> DataFrame:
    """Rows of a side table for a set of documents; annotations of some vocabularies only."""
    if vocabularies is not None:
        df = df.where(F.col("annotation").isin(list(vocabularies)))
    return df.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")


def word_cloud(annots: DataFrame, keys: Sequence[str] = (), top: int = 250, many: int = 100, floor: int = 2) -> DataFrame:
    """``(*keys, concept, n)``: the most frequent concepts. Where there are more than ``many`` distinct ones and
    the top count reaches ``floor``, only counts above ``floor``; ties by name."""
    n = annots.where("concept <> ''").groupBy(*keys, "concept").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    if not keys:
        # few rows per concept: limits come from a one-row aggregate instead of a window over everything
        lim = n.agg(F.count("*").alias("_d"), F.max("n").alias("_m"))
        n = n.crossJoin(F.broadcast(lim))
        return n.where(~((F.col("_d") > many) & (F.col("_m") >= floor)) | (F.col("n") > floor)).orderBy(F.desc("n"), "concept").limit(top).select("concept", "n")
    n = n.withColumn("_d", F.count("*").over(w)).withColumn("_m", F.max("n").over(w))
    kept = n.where(~((F.col("_d") > many) & (F.col("_m") >= floor)) | (F.col("n") > floor))
    rank = F.row_number().over(w.orderBy(F.desc("n"), F.col("concept")))
    return kept.withColumn("_r", rank).where(F.col("_r") <= top).select(*keys, "concept", "n")


def statistics(mx: DataFrame) -> DataFrame:
    """One row: distinct miRNAs, genes, pairs, and consensus pairs."""
    pair = F.struct("mirna_family", "gene_family")
    both = F.col("mirna_family").isNotNull() & F.col("gene_family").isNotNull()
    return mx.agg(
        F.countDistinct("mirna_family").alias("mirnas"), F.countDistinct("gene_family").alias("genes"), F.countDistinct(F.when(both, pair)).alias("pairs"),
        F.countDistinct(F.when(both & (F.col("is_consensus") == 1), pair)).alias("consensus_pairs"),
    )


def evidence_by_interaction(mx: DataFrame) -> DataFrame:
    """Consensus rows by interaction."""
    return mx.where("is_consensus = 1").groupBy("interaction").agg(F.count("*").alias("n"))


def natural_key(c: Column) -> list[Column]:
    """Sort key of 'prefix + number' texts: the prefix, then the number as a number, then the text."""
    return [F.regexp_extract(c, "^[^0-9]*", 0), F.nullif(F.regexp_extract(c, "[0-9]+", 0), F.lit("")).try_cast("decimal(38,0)"), c]
