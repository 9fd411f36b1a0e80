"""Queries of the text operators over the documents, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litweft.functions import mirna, parse, synonyms
from litweft.functions import text as tx
from litweft.operators import consensus, cooccur, matcher, relations
from litweft.plans.project import SENTENCES_SQL
from litweft.plans.project import sentences as sents
from litweft.session import exchange_partitions, materialise, table

# A small lexicon of words of the corpus; dictionary 1 are processes, 2 are things, 3 is short.
LEXICON = [
    (1, 0, "expression"), (1, 1, "binding site"), (1, 2, "binding"), (1, 3, "down-regulates"), (1, 4, "target"),
    (2, 0, "cells"), (2, 1, "cell"), (2, 2, "Luciferase reporters"), (2, 3, "luciferase"), (2, 4, "plasma"), (2, 5, "target"), (2, 6, "microRNA"),
    (3, 0, "of"), (3, 1, "nt"), (3, 2, "RT-PCR"), (3, 3, "UTR"),
]
SUBMATCH = ["binding", "luciferase"]
STEMS = [("POS", "activ"), ("POS", "increas"), ("NEG", "suppress"), ("NEG", "inhibit"), ("NEG", "down"), ("NEU", "target"), ("NEU", "bind"), ("NEU", "regul"), ("POS", "rais"), ("NEG", "reduc")]


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "dict_id int, syn_idx int, syn string")


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    return sents(spark, sf)


def sentence_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of the sentence id of every evidence of every row."""
    ids = table(spark, sf, "mx_annot").where("sent_evidences <> ''").select("row_id", F.explode(F.split("sent_evidences", "\\|")).alias("e")).select("row_id", F.split("e", ",")[0].alias("sid"))
    return ids.select("row_id", tx.sentence_parts(F.col("sid")).alias("p")).select("row_id", "p.doc_id", F.col("p.par_id").cast("long").alias("par_id"), F.col("p.sen_id").cast("long").alias("sen_id"))


def usable_sentences(spark: SparkSession, sf: str) -> DataFrame:
    s = sents(spark, sf)
    return s.where(tx.usable_sentence(F.col("text"), 120) & tx.long_enough(F.col("text"), F.col("sent_id"), 5, 3)).select("sent_id")


def _hits(spark: SparkSession, sf: str, **kw) -> DataFrame:
    return matcher.match(sents(spark, sf), lexicon(spark), **kw)


HIT = ["sent_id", "dict_id", "syn", "cast(start as bigint) as start", "cast(end as bigint) as end"]


def exact_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Hits whose surface is the synonym itself."""
    return _hits(spark, sf, only_longest=False).where("exact").selectExpr(*HIT)


def dictionary_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Hits of plain words in any case, short ones exact only."""
    words = lexicon(spark).where("syn rlike '^[A-Za-z]+$'")
    return matcher.match(sents(spark, sf), words, only_longest=False).selectExpr(*HIT)


def longest_match(spark: SparkSession, sf: str) -> DataFrame:
    return _hits(spark, sf, only_longest=True).where("exact").selectExpr(*HIT)


def submatch_exclude(spark: SparkSession, sf: str) -> DataFrame:
    return _hits(spark, sf, only_longest=False, submatch=["expression"]).where("exact").selectExpr(*HIT)


def high_frequency_surface(spark: SparkSession, sf: str) -> DataFrame:
    words = lexicon(spark).where("syn rlike '^[A-Za-z]+$'")
    return matcher.frequent_surfaces(matcher.match(sents(spark, sf), words, only_longest=False), 20)


def common_word_removal(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "mx_annot").where("concept <> ''").select("row_id", F.col("concept").alias("syn"))
    return matcher.drop_common_words(d, 30, 10)


def cooccurrence(spark: SparkSession, sf: str) -> DataFrame:
    s = sents(spark, sf)
    h = cooccur.dense_sentences_out(materialise(_hits(spark, sf, only_longest=False).where("exact"), "hits"), 4)
    p = cooccur.pairs(h.where("dict_id = 1"), h.where("dict_id = 2"), s, 300)
    return p.select("sent_id", "syn_a", "syn_b", F.col("start_a").cast("long").alias("start_a"), F.col("start_b").cast("long").alias("start_b"))


def tagged_pairs(spark: SparkSession, sf: str) -> DataFrame:
    h = materialise(_hits(spark, sf, only_longest=False).where("exact"), "hits")
    p = cooccur.distinct_pairs(cooccur.pairs(h.where("dict_id = 1"), h.where("dict_id = 2"), sents(spark, sf)))
    return p.select("sent_id", tx.tag_pair(F.col("text"), F.col("start_a"), F.col("end_a"), F.col("start_b"), F.col("end_b")).alias("tagged"))


def all_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Every accepted hit of the whole lexicon, in all forms of a sentence."""
    return _hits(spark, sf, only_longest=False).selectExpr(*HIT, "matched", "exact")


def all_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of the two dictionaries over all accepted hits, with the usual limits on density and length."""
    h = cooccur.dense_sentences_out(materialise(_hits(spark, sf, only_longest=False), "hits"))
    p = cooccur.pairs(h.where("dict_id = 1"), h.where("dict_id = 2"), sents(spark, sf))
    return p.select("sent_id", "syn_a", "matched_a", "start_a", "end_a", "syn_b", "matched_b", "start_b", "end_b")


def all_longest(spark: SparkSession, sf: str) -> DataFrame:
    """The longest of all accepted hits at each place of a dictionary."""
    return _hits(spark, sf, only_longest=True).selectExpr(*HIT, "matched", "exact")


def all_submatch_excluded(spark: SparkSession, sf: str) -> DataFrame:
    """All accepted hits but those that begin where a blocked word stands."""
    return _hits(spark, sf, only_longest=False, submatch=SUBMATCH).selectExpr(*HIT, "matched", "exact")


def all_frequent_surfaces(spark: SparkSession, sf: str) -> DataFrame:
    """Surfaces of all accepted hits that occur more than twenty times."""
    return matcher.frequent_surfaces(_hits(spark, sf, only_longest=False), 20)


def all_tagged_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The first pair of the two dictionaries in every sentence over all accepted hits, tagged."""
    h = materialise(cooccur.dense_sentences_out(_hits(spark, sf, only_longest=False)), "hits")
    p = cooccur.distinct_pairs(cooccur.pairs(h.where("dict_id = 1"), h.where("dict_id = 2"), sents(spark, sf)))
    return p.select("sent_id", "syn_a", "syn_b", tx.tag_pair(F.col("text"), F.col("start_a"), F.col("end_a"), F.col("start_b"), F.col("end_b")).alias("tagged"))


def sentence_fragments(spark: SparkSession, sf: str) -> DataFrame:
    return relations.fragments(sents(spark, sf)).select("sent_id", F.col("pos").cast("long").alias("pos"), F.col("start").cast("long").alias("start"), "fragment")


def stem_direction(spark: SparkSession, sf: str) -> DataFrame:
    words = sents(spark, sf).select(F.explode(F.split("text", " ")).alias("word")).where("length(word) > 0").distinct()
    stems = spark.createDataFrame([(i, c, s) for i, (c, s) in enumerate(STEMS)], "ord int, class string, stem string")
    return relations.stem_classes(words, stems).select("word", "class", "found")


def relation_rules_text(spark: SparkSession, sf: str) -> DataFrame:
    """The phrase rules on the text between the first miRNA and the first gene-like word of a sentence, as far as its
    SQL twin goes; relation_rules_pairs takes every pair."""
    s = sents(spark, sf).select("sent_id", "text", F.regexp_extract("text", "MIR-[0-9]+", 0).alias("mir"), F.regexp_extract("text", "\\b[QXZ][A-Z]{2}[0-9]+\\b", 0).alias("gene"))
    s = s.where("mir <> '' and gene <> ''").withColumn("m", F.instr("text", F.col("mir"))).withColumn("g", F.instr("text", F.col("gene")))
    before = F.substring("text", F.lit(1), F.least("m", "g") - 1)
    between = F.when(F.col("m") < F.col("g"), F.substring("text", F.col("m") + F.length("mir"), F.greatest(F.col("g") - F.col("m") - F.length("mir"), F.lit(0)))).otherwise(
        F.substring("text", F.col("g") + F.length("gene"), F.greatest(F.col("m") - F.col("g") - F.length("gene"), F.lit(0)))
    )
    rule = relations.phrase_rules(F.col("m") < F.col("g"), F.col("text"), before, between)
    return s.select("sent_id", rule.alias("r")).select("sent_id", "r.rule", "r.direction", "r.regulation")


def context_reject_exact(spark: SparkSession, sf: str) -> DataFrame:
    s = sents(spark, sf).withColumn("gene", F.regexp_extract("text", "\\b[QXZ][A-Z]{2}[0-9]+\\b", 0)).where("gene <> ''")
    start = F.instr("text", F.col("gene")) - 1
    return s.where(relations.context_reject_exact(F.col("text"), start, start + F.length("gene"))).select("sent_id")


def relation_rules_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The phrase rules of every pair of mentions of a sentence, in the windows of the decision list."""
    return relations.pair_rules(sents(spark, sf))


def context_reject_fuzzy(spark: SparkSession, sf: str) -> DataFrame:
    """The context check of every pair of mentions of a sentence."""
    return relations.pair_contexts(sents(spark, sf))


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    """Every pair of mentions of the usable sentences, judged by all checks and classified, over the plain parse."""
    s = materialise(sents(spark, sf).where(tx.usable_sentence(F.col("text"), 500)).select("doc_id", "sent_id", "text"), "sentences")
    parsed = parse.chain_parse(s, [stem for _, stem in STEMS])
    # the rules run in Python and cost far more than the rows weigh: all cores, a sentence's pairs in one place
    pairs = relations.mentions(s).join(parsed, "sent_id").repartition(exchange_partitions(spark), "sent_id")
    return relations.relations(pairs, STEMS, keep=("doc_id", "sent_id", "mir", "gene", "start_a", "end_a", "start_b", "end_b"))


def relations_full(spark: SparkSession, sf: str) -> DataFrame:
    """Checks, acceptance and class of every pair of mentions."""
    return _judged(spark, sf)


def relation_consensus(spark: SparkSession, sf: str) -> DataFrame:
    """From texts to serving rows: sentences, mentions, accepted relations, consensus interactions."""
    ok = _judged(spark, sf).where("accepted")
    ev = ok.select(
        F.col("mir").alias("mirna_family"), F.col("gene").alias("gene_family"), "direction", "regulation", F.lit("").alias("organism"), F.col("doc_id").cast("string").alias("doc_id"), "sent_id"
    )
    c = consensus.consensus_counts(consensus.reject_rows(ev))
    return c.select("mirna_family", "gene_family", F.concat_ws(";", "direction", "regulation").alias("interaction"), "evidence_count", "sent_count", "is_consensus")


def highlight_spans(spark: SparkSession, sf: str) -> DataFrame:
    s = sents(spark, sf)
    at = lambda *ps: F.struct(*(F.least(F.lit(p), F.length("text")).alias(n) for p, n in zip(ps, ("start", "end"))))
    spans = F.array(at(2, 5), at(9, 12))
    return s.select("sent_id", tx.highlight(F.col("text"), spans).alias("marked"))


def collapsed_text(spark: SparkSession, sf: str) -> DataFrame:
    s = sents(spark, sf)
    return s.select("sent_id", tx.collapse(F.col("text")).alias("form"))


def mirna_parse(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "mx").where("mirna_family <> ''").select(F.concat(F.lower("mirna_family"), F.element_at(F.array(F.lit("-5p"), F.lit("-3p"), F.lit(""), F.lit("a-1-3p")), F.pmod("row_id", F.lit(4)).cast("int") + 1)).alias("name")).distinct()
    p = m.select("name", mirna.parse(F.col("name")).alias("p"))
    return p.select("name", "p.organism", "p.mature", "p.id", "p.precursor", "p.mature_seq", "p.arm")


def synonym_clean(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "mx_annot").where("concept <> ''").select("concept").distinct()
    raw = F.concat(F.element_at(F.array(F.lit("see "), F.lit(""), F.lit('"'), F.lit("  ")), F.pmod(F.length("concept"), F.lit(4)) + 1), "concept", F.when(F.pmod(F.length("concept"), F.lit(4)) == 2, '"').otherwise(""))
    return c.select("concept", synonyms.clean(raw).alias("syn"))


def hyphen_variants(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "mx").where("gene_family <> ''").select("gene_family").distinct()
    return g.select("gene_family", F.array_join(synonyms.hyphen_variants(F.array("gene_family")), "|").alias("syns"))


def greek_variants(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "part").select(F.concat("p_name", F.lit("A")).alias("syn")).distinct()
    return g.select("syn", F.array_join(synonyms.greek_variants(F.array(F.col("syn"), F.concat("syn", F.lit(" alpha")))), "|").alias("syns"))


def acronyms(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "mx_annot").where("concept like '% cell'").select("concept").distinct()
    return c.select("concept", synonyms.acronym(F.col("concept")).alias("short"))


QUERIES = {
    f.__name__: f
    for f in (
        sentences, sentence_ids, usable_sentences, exact_hits, dictionary_hits, longest_match, submatch_exclude, high_frequency_surface, common_word_removal, cooccurrence, tagged_pairs, all_hits, all_pairs,
        all_longest, all_submatch_excluded, all_frequent_surfaces, all_tagged_pairs,
        sentence_fragments, stem_direction, relation_rules_text, relation_rules_pairs, relations_full, relation_consensus, context_reject_exact, context_reject_fuzzy, highlight_spans, collapsed_text, mirna_parse, synonym_clean, hyphen_variants,
        greek_variants, acronyms,
    )
}

_LEX = "lex(dict_id, syn_idx, syn) AS (VALUES " + ", ".join(f"({d}, {k}, '{s}')" for d, k, s in LEXICON) + ")"
_B = "' ,.;:-()[]{}=!\"§$%&/=?+*''#-'"
# position of every occurrence, boundary on both sides; the sentence's last mark is cut as the matcher does
_CUT = "cut AS (SELECT *, CASE WHEN right(rtrim(text), 1) IN ('.', ':', ',', ';') THEN left(rtrim(text), length(rtrim(text)) - 1) ELSE rtrim(text) END AS t FROM sent)"
_BOUND = f"(i = 1 OR contains({_B}, substr(t, i - 1, 1))) AND (i + length(syn) > length(t) OR contains({_B}, substr(t, i + length(syn), 1)))"
_EXACT = f"""WITH {SENTENCES_SQL}, {_CUT}, {_LEX},
pos AS (SELECT sent_id, t, dict_id, syn, unnest(generate_series(1, length(t) - length(syn) + 1)) AS i FROM cut JOIN lex ON contains(t, syn)),
hit AS (SELECT sent_id, t, dict_id, syn, i - 1 AS start, i - 1 + length(syn) AS "end" FROM pos WHERE substr(t, i, length(syn)) = syn AND {_BOUND})
"""
_ANYCASE = f"""WITH {SENTENCES_SQL}, {_CUT}, {_LEX},
pos AS (SELECT sent_id, t, dict_id, syn, unnest(generate_series(1, length(t) - length(syn) + 1)) AS i FROM cut JOIN lex ON contains(upper(replace(t, 'ß', 'ẞ')), upper(syn)) WHERE regexp_matches(syn, '^[A-Za-z]+$')),
hit AS (SELECT sent_id, dict_id, syn, substr(t, i, length(syn)) AS matched, i - 1 AS start, i - 1 + length(syn) AS "end" FROM pos
  WHERE (substr(t, i, length(syn)) = syn OR (length(syn) > 4 AND (upper(substr(t, i, length(syn))) = upper(syn)))) AND {_BOUND})
"""
_HIT = 'sent_id, dict_id, syn, start, "end"'
_REL = f"""WITH {SENTENCES_SQL},
x AS (SELECT sent_id, text, regexp_extract(text, 'MIR-[0-9]+') AS mir, regexp_extract(text, '\\b[QXZ][A-Z]{{2}}[0-9]+\\b') AS gene FROM sent),
y AS (SELECT *, instr(text, mir) AS m, instr(text, gene) AS g FROM x WHERE mir <> '' AND gene <> ''),
z AS (SELECT *, substr(text, 1, least(m, g) - 1) AS l, CASE WHEN m < g THEN substr(text, m + length(mir), greatest(g - m - length(mir), 0)) ELSE substr(text, g + length(gene), greatest(m - g - length(gene), 0)) END AS b FROM y)
"""


def _any(col: str, phrases: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({col}, '{p}')" for p in phrases) + ")"


def _rule_sql(what: str) -> str:
    """The rules as CASE, in order: what is 'name', 'direction' or 'regulation'."""
    at = {"name": 0, "direction": 5, "regulation": 4}[what]
    col = {"text": "text", "before": "l", "between": "b"}
    whens = " ".join(f"WHEN {'m < g' if r[1] == 'mir gene' else 'NOT m < g'} AND {_any(col[r[2]], r[3])} THEN '{r[at]}'" for r in relations.PHRASE_RULES)
    return f"CASE {whens} END"


ORACLE = {
    "sentences": f"WITH {SENTENCES_SQL} SELECT * FROM sent",
    "sentence_ids": """SELECT row_id, split_part(s, '.', 1) AS doc_id, try_cast(split_part(s, '.', 2) AS BIGINT) AS par_id, try_cast(split_part(s, '.', 3) AS BIGINT) AS sen_id
FROM (SELECT row_id, split_part(unnest(string_split(sent_evidences, '|')), ',', 1) AS s FROM mx_annot WHERE sent_evidences <> '')""",
    "usable_sentences": f"""WITH {SENTENCES_SQL} SELECT sent_id FROM sent WHERE length(text) <= 120 AND length(trim(text, ' ')) > 3
AND NOT (starts_with(text, 'Table ') OR starts_with(text, 'Figure ') OR starts_with(text, 'Tab. ') OR starts_with(text, 'Fig. '))""",
    "exact_hits": _EXACT + f"SELECT DISTINCT {_HIT} FROM hit",
    "dictionary_hits": _ANYCASE + f"SELECT DISTINCT {_HIT} FROM hit",
    "longest_match": _EXACT + f'SELECT DISTINCT {_HIT} FROM (SELECT *, max("end") OVER (PARTITION BY sent_id, dict_id, start) AS m FROM hit) WHERE "end" = m',
    "submatch_exclude": _EXACT + f"""
, blk AS (SELECT sent_id, i - 1 AS start FROM (SELECT sent_id, t, 'expression' AS syn, unnest(generate_series(1, length(t) - 9)) AS i FROM cut WHERE contains(upper(t), 'EXPRESSION'))
  WHERE upper(substr(t, i, 10)) = 'EXPRESSION' AND {_BOUND})
SELECT DISTINCT {_HIT} FROM hit WHERE (sent_id, start) NOT IN (SELECT (sent_id, start) FROM blk)""",
    "high_frequency_surface": _ANYCASE + 'SELECT matched, count(*) AS n FROM (SELECT DISTINCT sent_id, dict_id, syn, matched, start, "end" FROM hit) GROUP BY 1 HAVING count(*) > 20',
    "common_word_removal": """
WITH d AS (SELECT row_id, concept AS syn FROM mx_annot WHERE concept <> ''), c AS (SELECT syn FROM d GROUP BY 1 HAVING count(*) > 10 ORDER BY count(*) DESC, syn LIMIT 30)
SELECT row_id, syn FROM d WHERE syn NOT IN (SELECT syn FROM c)""",
    "cooccurrence": _EXACT + """, h AS (SELECT DISTINCT * FROM hit), ok AS (SELECT sent_id FROM h GROUP BY 1 HAVING count(*) <= 4)
SELECT a.sent_id, a.syn AS syn_a, b.syn AS syn_b, a.start AS start_a, b.start AS start_b FROM h a JOIN h b USING (sent_id) JOIN sent USING (sent_id)
WHERE sent_id IN (SELECT sent_id FROM ok) AND a.dict_id = 1 AND b.dict_id = 2 AND a.syn <> b.syn AND NOT (a.start <= b."end" AND b.start <= a."end")
  AND length(text) <= 300 AND NOT (starts_with(text, 'Table ') OR starts_with(text, 'Figure ') OR starts_with(text, 'Tab. ') OR starts_with(text, 'Fig. '))""",
    "tagged_pairs": _EXACT + """, p AS (SELECT a.sent_id, text, a.syn AS x, b.syn AS y, a.start AS sa, a."end" AS ea, b.start AS sb, b."end" AS eb,
  row_number() OVER (PARTITION BY a.sent_id, a.syn, b.syn ORDER BY a.start, b.start, a."end", b."end") AS r
 FROM (SELECT DISTINCT * FROM hit WHERE dict_id = 1) a JOIN (SELECT DISTINCT * FROM hit WHERE dict_id = 2) b USING (sent_id) JOIN sent USING (sent_id)
 WHERE a.syn <> b.syn AND NOT (a.start <= b."end" AND b.start <= a."end") AND length(text) <= 500
  AND NOT (starts_with(text, 'Table ') OR starts_with(text, 'Figure ') OR starts_with(text, 'Tab. ') OR starts_with(text, 'Fig. ')))
SELECT sent_id, CASE WHEN ea <= sb THEN substr(text, 1, sa) || '<e1>' || x || '</e1>' || substr(text, ea + 1, sb - ea) || '<e2>' || y || '</e2>' || substr(text, eb + 1)
  ELSE substr(text, 1, sb) || '<e2>' || y || '</e2>' || substr(text, eb + 1, sa - eb) || '<e1>' || x || '</e1>' || substr(text, ea + 1) END AS tagged FROM p WHERE r = 1""",
    "sentence_fragments": f"""WITH {SENTENCES_SQL},
m AS (SELECT sent_id, text, list_filter(generate_series(1, length(text)), lambda i: substr(text, i, 2) IN (': ', '; ') AND regexp_matches(substr(text, i + 2, 1), '[A-Za-z0-9]')
  AND NOT (contains(substr(text, greatest(i - 10, 1), least(i + 12, length(text)) - greatest(i - 10, 1) + 1), '(') AND contains(substr(text, greatest(i - 10, 1), least(i + 12, length(text)) - greatest(i - 10, 1) + 1), ')'))) AS c FROM sent),
f AS (SELECT sent_id, text, unnest(generate_series(0, len(c))) AS pos, c FROM m),
g AS (SELECT sent_id, pos, CASE WHEN pos = 0 THEN 0 ELSE c[pos] END AS start, text, CASE WHEN pos = len(c) THEN length(text) ELSE c[pos + 1] - 1 END AS e FROM f)
SELECT sent_id, pos, start, substr(text, start + 1, e - start) AS fragment FROM g WHERE e > start""",
    "stem_direction": f"""WITH {SENTENCES_SQL}, w AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM sent),
st(ord, class, stem) AS (VALUES {", ".join(f"({i}, '{c}', '{s}')" for i, (c, s) in enumerate(STEMS))})
SELECT word, CASE WHEN lower(word) LIKE '%-stressed' AND NOT starts_with(lower(word), 'activ') THEN 'POS'
  ELSE coalesce((SELECT arg_min(class, ord) FROM st WHERE starts_with(lower(word), stem) AND lower(word) NOT IN ('enhancer', 'inhibitor')), 'NEU') END AS class,
  (SELECT count(*) > 0 FROM st WHERE starts_with(lower(word), stem) AND lower(word) NOT IN ('enhancer', 'inhibitor')) OR lower(word) LIKE '%-stressed' AS found FROM w WHERE length(word) > 0""",
    "relation_rules_text": _REL + f"SELECT sent_id, {_rule_sql('name')} AS rule, {_rule_sql('direction')} AS direction, {_rule_sql('regulation')} AS regulation FROM z",
    "context_reject_exact": f"""WITH {SENTENCES_SQL}, x AS (SELECT sent_id, text, regexp_extract(text, '\\b[QXZ][A-Z]{{2}}[0-9]+\\b') AS gene FROM sent), y AS (SELECT *, instr(text, gene) - 1 AS s FROM x WHERE gene <> '')
SELECT sent_id FROM y WHERE """ + " OR ".join(
        [f"regexp_matches(substr(text, s + 2, length(gene) + {n}), '{p}')" for p, n in relations.exact_context_patterns(relations.AFTER_GENE)]
        + [f"regexp_matches(substr(text, greatest(s - 1 - {n}, 0) + 1, s - greatest(s - 1 - {n}, 0)), '{p}')" for p, n in relations.exact_context_patterns(relations.BEFORE_GENE)]
    ),
    "highlight_spans": f"WITH {SENTENCES_SQL} SELECT sent_id, substr(text, 1, 2) || '<b>' || substr(text, 3, 3) || '</b>' || substr(text, 6, 4) || '<b>' || substr(text, 10, 3) || '</b>' || substr(text, 13) AS marked FROM sent",
    "collapsed_text": f"""WITH {SENTENCES_SQL} SELECT sent_id, regexp_replace(text, '[-()\\[\\]{{}}=!"§$%&/?+*''#]+', ' ', 'g') AS form FROM sent""",
    "mirna_parse": """
WITH m AS (SELECT DISTINCT lower(mirna_family) || (CASE row_id % 4 WHEN 0 THEN '-5p' WHEN 1 THEN '-3p' WHEN 2 THEN '' ELSE 'a-1-3p' END) AS name FROM mx WHERE mirna_family <> '')
SELECT name, CAST(NULL AS VARCHAR) AS organism, CASE WHEN starts_with(name, 'mir') THEN 'miR' ELSE 'let' END AS mature, regexp_extract(name, '-([0-9]+)', 1) AS id,
  nullif(regexp_extract(name, '[0-9]([a-z])-1', 1), '') AS precursor, nullif(regexp_extract(name, 'a-([0-9])-', 1), '') AS mature_seq, nullif(regexp_extract(name, '-([35]p)$', 1), '') AS arm FROM m""",
    "synonym_clean": """
WITH c AS (SELECT DISTINCT concept, trim(concept, ' ') AS t FROM mx_annot WHERE concept <> '')
SELECT concept, CASE WHEN length(trim((['see ', '', '"', '  '])[length(concept) % 4 + 1] || concept || CASE WHEN length(concept) % 4 = 2 THEN '"' ELSE '' END, ' ')) >= 3
  AND regexp_matches(concept, '[A-Za-z]') AND length(concept) >= 3 THEN regexp_replace(CASE WHEN length(concept) % 4 = 2 THEN concept ELSE t END, '\\s\\s+', ' ', 'g') END AS syn FROM c""",
    "hyphen_variants": """
SELECT gene_family, gene_family || CASE WHEN regexp_matches(gene_family, '[A-Za-z][0-9]+[AB]?$') AND NOT regexp_matches(gene_family, '^(HGNC|MGI)') THEN '|' || regexp_replace(gene_family, '([A-Za-z])([0-9]+[AB]?)$', '\\1-\\2') ELSE '' END AS syns
FROM (SELECT DISTINCT gene_family FROM mx WHERE gene_family <> '')""",
    "greek_variants": """
SELECT DISTINCT p_name || 'A' AS syn, p_name || 'A|' || p_name || 'A alpha|' || p_name || 'α|' || p_name || '-α|' || p_name || 'A α' AS syns FROM part""",
    "acronyms": """
SELECT concept, CASE WHEN len(w) BETWEEN 2 AND 4 THEN list_aggregate(list_transform(w, lambda x: substr(x, 1, 1)), 'string_agg', '') END AS short
FROM (SELECT DISTINCT concept, string_split(upper(concept), ' ') AS w FROM mx_annot WHERE concept LIKE '% cell')""",
}
