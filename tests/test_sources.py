from __future__ import annotations

import gzip
import io
import tarfile

from conftest import rows
from pyspark.sql import functions as F

from litweft.sources import jats, obo, pubmed, sinks, tables

ARTICLE = """<PubmedArticle><MedlineCitation><PMID Version="1">{pmid}</PMID><Article>
<Journal><JournalIssue><PubDate><Year>1999</Year><Month>Mar</Month></PubDate></JournalIssue><Title>Long name</Title><ISOAbbreviation>{iso}</ISOAbbreviation></Journal>
<ArticleTitle>[A <i>bold</i> title].</ArticleTitle><ELocationID EIdType="doi">10.1/x</ELocationID>
<Abstract><AbstractText Label="Methods">First.</AbstractText><AbstractText>We   did. It worked! OK</AbstractText><AbstractText Label="METHODS">Second.</AbstractText></Abstract>
<AuthorList><Author ValidYN="Y"><LastName>Fluvo</LastName><ForeName>Bob</ForeName><Initials>B</Initials></Author><Author ValidYN="N"><LastName>Bad</LastName></Author>
<Author><CollectiveName>The Group</CollectiveName></Author></AuthorList>{date}
<PublicationTypeList><PublicationType UI="D1">Review</PublicationType></PublicationTypeList></Article>
<CommentsCorrectionsList><CommentsCorrections RefType="Cites"><PMID>7</PMID></CommentsCorrections><CommentsCorrections RefType="CommentOn"><PMID>8</PMID></CommentsCorrections></CommentsCorrectionsList>
</MedlineCitation></PubmedArticle>"""


def test_pubmed(spark, tmp_path):
    own = "<ArticleDate><Year>2001</Year><Month>02</Month><Day>03</Day></ArticleDate>"
    body = "<?xml version='1.0'?>\n<PubmedArticleSet>" + ARTICLE.format(pmid="1", iso="Short", date=own) + ARTICLE.format(pmid="2", iso="", date="") + "</PubmedArticleSet>"
    with gzip.open(tmp_path / "pubmed20n0007.xml.gz", "wt") as f:
        f.write(body)
    arts = pubmed.articles(spark, str(tmp_path))
    got = {r.doc_id: r for r in pubmed.fields(arts).collect()}
    a, b = got["1"], got["2"]
    assert a.title == "A bold title" and a.journal == "Short" and b.journal == "Long name" and a.doi == "10.1/x"
    assert (a.pub_date, b.pub_date) == ("2001-02-03", "1999-03-01")
    assert [(x.author_ord, x.firstname, x.lastname) for x in a.authors] == [(1, "Bob", "Fluvo"), (2, "", "The Group")]
    assert [(x.label, x.text) for x in a.abstract] == [("METHODS", "Second."), ("GENERAL", "We   did. It worked! OK")]
    assert a.pub_types == ["Review"] and a.citations == ["7"]
    s = rows(pubmed.sentences(pubmed.fields(arts).where("doc_id = '1'")).select("sent_id", "text"))
    assert s[0] == ("1.1.1", "A bold title") and ("1.2.1", "Second.") in s and s[-1][1] == "OK"
    assert pubmed.articles(spark, str(tmp_path), first_file=8).count() == 0 and pubmed.articles(spark, str(tmp_path), 0, 7).count() == 2


JATS = """<article xmlns="http://x"><front><journal-meta><journal-title>J</journal-title></journal-meta><article-meta><article-id pub-id-type="pmc">12</article-id>
<article-id pub-id-type="pmid">34</article-id><title-group><article-title>On <italic>x</italic></article-title></title-group>
<contrib-group><contrib contrib-type="author"><name><surname>Fluvo</surname><given-names>Bob</given-names></name></contrib></contrib-group>
<pub-date pub-type="epub"><day>4</day><month>5</month><year>2010</year></pub-date><abstract><p>Short.</p></abstract></article-meta></front>
<body><sec><title>Methods</title><p>We did <xref>[1]</xref>things.</p></sec><sec id="s2"><p>More.</p></sec><sec><title>Methods</title><p>Again.</p></sec></body>
<back><ref-list><ref><pub-id pub-id-type="pmid">99</pub-id></ref></ref-list></back></article>"""


def test_jats_tar(spark, tmp_path):
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as tar:
        for name, text in (("x/1.nxml", JATS), ("x/2.nxml", "<broken"), ("x/3.txt", "no")):
            data = text.encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    got = {r.member: r for r in jats.fields(jats.tar_members(spark, str(tmp_path / "a.tar.gz"))).collect()}
    a = got["x/1.nxml"]
    assert (a.doc_id, a.pmid, a.title, a.year, a.month, a.day) == ("PMC12", "34", "On x", 2010, 5, 4)
    assert [(x.label, x.text) for x in a.body] == [("METHODS", "We did things. Again."), ("S2", "More.")] and a.citations == ["99"]
    assert [(x.firstname, x.lastname) for x in a.authors] == [("Bob", "Fluvo")]
    assert got["x/2.nxml"].problem and got["x/2.nxml"].doc_id is None and len(got) == 2


def write(path, text):
    path.write_text(text)
    return str(path)


def test_line_files(spark, tmp_path):
    s = write(tmp_path / "a.sent", "1.2.3\tText here\n\nno columns\n1.2.4\ta\tb\nPMC1.x\tz\n")
    assert rows(tables.sentences(spark, s)) == [("1.2.3", "1", 2, 3, "Text here"), ("PMC1.x", "PMC1", None, None, "z")]
    h = write(tmp_path / "a.index", "1.2.3\t4:5\tmiR-1\t8\t5\tmiR-1\ttrue\t\t.\t0\nshort\tline\n1.2.3\t4:5\tX\t8\t1\tx\tFalse\n")
    assert rows(tables.hits(spark, h)) == [("1.2.3", 4, 5, "X", 8, 9, "x", False, None, None, None), ("1.2.3", 4, 5, "miR-1", 8, 13, "miR-1", True, "", ".", 0)]
    assert tables.hits(spark, h, shift_by_id=True).first().start == 2
    a = write(tmp_path / "a.author", "1\tB\tB\tX\n1\tC\tC\tY\n2\tD\tD\tZ\nbad\n")
    assert rows(tables.side_file(spark, a, "author").select("doc_id", "lastname", "author_ord")) == [("1", "X", 1), ("1", "Y", 2), ("2", "Z", 1)]
    d = write(tmp_path / "a.date", "1\t2001\t0\tx\n")
    keep = spark.createDataFrame([("1",)], "doc_id string")
    assert rows(tables.side_file(spark, d, "date", keep)) == [("1", 2001, 0, None)]
    assert tables.side_file(spark, d, "date", keep.limit(0)).count() == 0


def test_literals_are_parsed_not_run(spark):
    df = spark.createDataFrame([("[('1.2.3', (1, 2), True)]",), ("__import__('os')",), (None,), ("[]",)], "c string")
    got = rows(tables.literal_column(df, "c", "array<struct<sent:string,loc:struct<start:int,end:int>,ok:boolean>>"))
    assert got == sorted([((("1.2.3", (1, 2), True),),), (None,), (None,), ((),)], key=repr)


def test_synonyms_lists_genome(spark, tmp_path):
    f = write(tmp_path / "a.syn", "A_1:x|y\nB:z\nA_1:again\n")
    assert rows(tables.synonym_file(spark, f, 3)) == [(3, 0, "A_1", "A_1"), (3, 0, "A_1", "x"), (3, 0, "A_1", "y"), (3, 1, "B", "B"), (3, 1, "B", "z")]
    w = write(tmp_path / "w", "of\n\n")
    assert rows(tables.exclude_lists(spark, {"common": w, "manual": w})) == [("common", "OF"), ("common", "of"), ("manual", "of")]
    g = write(tmp_path / "a.gtf", '#x\nchr1\ts\texon\t5\t9\t.\t-\t.\tgene_id "G"; gene_name "N";\n')
    assert rows(tables.gtf(spark, g)) == [("chr1", "exon", 5, 9, "-", "G", None, "N")]
    fa = write(tmp_path / "a.fa", ">c1 more\nACG\nT\n>c2\nGG\n")
    assert rows(tables.fasta(spark, fa)) == [("c1", "ACGT"), ("c2", "GG")]
    fam = write(tmp_path / "fam", "miR family\tSpecies ID\tMiRBase ID\nlet-7\t9606\thsa-let-7a\nlet-7\t10090\tmmu-let-7a\n")
    assert rows(tables.mirna_families(spark, fam, 9606)) == [("let-7", "hsa-let-7a")]


def test_corpus(spark, tmp_path):
    x = write(tmp_path / "c.xml", '<corpus><document origId="9"><sentence id="s" text="miR-1 hits ABC"><entity id="e1" text="miR-1" type="m" charOffset="0-4"/><entity id="e2" text="ABC" type="g" charOffset="11-13"/><pair id="p" e1="e1" e2="e2" interaction="True"/></sentence></document></corpus>')
    r = tables.corpus_pairs(spark, x).first()
    assert (r.e1, r.e2, r.interaction, r.loc1.start, r.loc1.end, r.loc2.end) == ("miR-1", "ABC", True, 0, 5, 14)
    assert r.text[r.loc2.start : r.loc2.end] == "ABC"


OBO = """format-version: 1.2

[Term]
id: A:1
name: root
namespace: n

[Term]
id: A:2
name: child
namespace: n
def: "Some \\"quoted\\" text" [x]
synonym: "a \\"b\\"" EXACT [ref]
property_value: http://x#Related_Synonym "kid" xsd:string
is_a: A:1 ! root
relationship: derived_from A:3 ! other
relationship: part_of A:4
alt_id: A:9
is_obsolete: true

[Typedef]
id: part_of
"""


def test_obo(spark, tmp_path):
    b = obo.blocks(spark, write(tmp_path / "o.obo", OBO)).cache()
    t = {r.term_id: r for r in obo.terms(b).collect()}
    assert set(t) == {"A:1", "A:2"} and t["A:2"].is_obsolete and t["A:2"].alt_ids == ["A:9"] and not t["A:1"].is_obsolete
    assert rows(obo.edges(b)) == [("A:2", "A:1", "is_a"), ("A:2", "A:3", "is_a"), ("A:2", "A:4", "part_of")]
    assert rows(obo.synonyms(b)) == [("A:2", 'a "b"', "EXACT"), ("A:2", "kid", "EXACT")]
    out = obo.text(obo.terms(b), spark.createDataFrame([("A:2", ["A:1"])], "child string, parents array<string>"))
    assert any("is_a: A:1" in r.value for r in out.collect())


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("A:1", ["x", "y"], ["n", "m"])], "term_id string, syns array<string>, namespaces array<string>")
    sinks.synonym_file(df, str(tmp_path / "s"))
    assert rows(spark.read.text(str(tmp_path / "s"))) == [("A_1:x|y",)]
    sinks.by_namespace(df, str(tmp_path / "n"))
    assert rows(spark.read.text(str(tmp_path / "n")).select("namespace")) == [("m",), ("n",)]
    sinks.serving_tables({"mx": spark.range(10).withColumn("k", F.col("id") % 3)}, str(tmp_path / "t"), {"mx": ["k"]})
    assert spark.read.parquet(str(tmp_path / "t/mx")).count() == 10
    sinks.single_file(spark.range(3), str(tmp_path / "d"))
    assert len(list((tmp_path / "d").glob("*.csv"))) == 1
    sinks.json_tracks(spark.range(1), str(tmp_path / "j"))
    assert rows(spark.read.text(str(tmp_path / "j"))) == [('{"id":0}',)]


def test_side_files_round_trip(spark, tmp_path):
    schema = "doc_id string, title string, journal string, pub_date string, pmid string, authors array<struct<firstname:string,initials:string,lastname:string>>, citations array<string>, pub_types array<string>"
    docs = spark.createDataFrame(
        [("1", "T", "J", "2001-02-00", "77", [("Bob", "B", "Fluvo"), ("", "", "The Group")], ["7", "8"], ["Review"]), ("2", None, None, None, None, [], None, None), ("3", "U", "K", "1999", None, None, [], [])], schema
    )
    sinks.side_files(docs, spark.createDataFrame([("1.1.1", "A text.")], "sent_id string, text string"), str(tmp_path / "s"))
    read = lambda kind: rows(tables.side_file(spark, str(tmp_path / "s" / kind), kind))
    assert read("title") == [("1", "T"), ("3", "U")] and read("journal") == [("1", "J", ""), ("3", "K", "")]
    assert read("author") == [("1", "", "", "The Group", 2), ("1", "Bob", "B", "Fluvo", 1)]
    assert read("citation") == [("1", "7"), ("1", "8")] and read("pubtype") == [("1", "Review")] and read("pmid") == [("1", "77")]
    assert read("date") == [("1", 2001, 2, 0), ("3", 1999, 0, 0)]
    assert rows(tables.sentences(spark, str(tmp_path / "s" / "sent")).select("sent_id", "text")) == [("1.1.1", "A text.")]


def test_synonym_file_in_another_encoding(spark, tmp_path, monkeypatch):
    (tmp_path / "l.syn").write_bytes("A:caf\u00e9|x\r\nB:z\n".encode("latin-1"))
    (tmp_path / "u.syn").write_bytes("A:caf\u00e9\n".encode())
    assert [r.syn for r in tables.synonym_file(spark, str(tmp_path / "l.syn")).orderBy("syn_idx", "syn").collect()] == ["A", "caf\u00e9", "x", "B", "z"]
    assert {r.syn for r in tables.synonym_file(spark, str(tmp_path / "u.syn")).collect()} == {"A", "caf\u00e9"}
    monkeypatch.setattr(tables, "MAX_SYNONYM_FILE", 3)
    import pytest

    with pytest.raises(Exception, match="larger than"):
        tables.synonym_file(spark, str(tmp_path / "u.syn")).collect()


def test_sentence_ends_mind_abbreviations(spark):
    text = "We tested miR-1 vs. MIR-2 in E. coli K12 (see Fig. 2). It worked! Did it? Yes, e.g. ABC1 et al. Then 3 more. B. subtilis too."
    docs = spark.createDataFrame([("1", None, [("G", text)])], "doc_id string, title string, abstract array<struct<label:string,text:string>>")
    got = [r.text for r in pubmed.sentences(docs).orderBy("sen_id").collect()]
    assert got == ["We tested miR-1 vs. MIR-2 in E. coli K12 (see Fig. 2).", "It worked!", "Did it?", "Yes, e.g. ABC1 et al. Then 3 more.", "B. subtilis too."]
