from __future__ import annotations

from conftest import rows

from litweft.operators import dictionaries as d


def test_hgnc(spark):
    cols = ["HGNC ID", "Approved symbol", "Approved name", "Previous symbols", "Previous name", "Alias symbols", "Alias names", "Status"]
    data = [
        ("HGNC:1", "ABC1", "a big cat", "OLD2, OLDER", None, 'X"', '"name, with comma", other name', "Approved"),
        ("HGNC:2", "GONE~withdrawn", "symbol withdrawn, see ABC1", None, None, None, None, "Symbol Withdrawn"),
        ("HGNC:3", "MIR155", "microRNA 155", None, None, None, None, "Approved"),
        ("HGNC:4", "MIR155HG", "host gene", None, None, None, None, "Approved"),
    ]
    got = dict(rows(d.from_hgnc(spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols)))))
    assert set(got) == {"HGNC:1", "HGNC:4"}
    assert {"ABC1", "ABC-1", "a big cat", "OLD2", "OLD-2", "OLDER", "name, with comma", "other name"} <= set(got["HGNC:1"])


def test_mouse_mirbase_and_rows(spark):
    m = spark.createDataFrame([("MGI:1", "Abc1"), ("MGI:2", "Mir21a"), ("MGI:1", "Abc1"), ("MGI:3", None)], "marker_id string, symbol string")
    mouse = d.from_mgi(m, spark.createDataFrame([("MGI:1", "Xyz")], "marker_id string, symbol string"))
    assert rows(mouse) == [("MGI:1", ("Abc-1", "Abc1", "Xyz"))]
    mir = d.from_mirbase(spark.createDataFrame([("MI1", "hsa-let-7a")], "accession string, name string"), spark.createDataFrame([("MI1", "let7a;hsa-let-7a")], "accession string, names string"))
    assert rows(mir) == [("MI1", ("hsa-let-7a", "let7a"))]
    assert rows(d.as_rows(mouse.unionByName(mir), 7)) == [(7, 0, "MGI_1", "Abc-1"), (7, 0, "MGI_1", "Abc1"), (7, 0, "MGI_1", "Xyz"), (7, 1, "MI1", "hsa-let-7a"), (7, 1, "MI1", "let7a")]


def test_ontology_variants_and_finish(spark):
    t = spark.createDataFrame([("A:1", "root", False), ("A:2", "epithelial cell of lung", False), ("A:3", "natural killer cell", False), ("A:4", "old", True), ("B:1", "drug", False)], "term_id string, name string, is_obsolete boolean")
    s = spark.createDataFrame([("A:3", "interferon alpha"), ("A:3", "IFNA"), ("A:4", "x old")], "term_id string, syn string")
    e = spark.createDataFrame([("A:2", "A:1"), ("A:3", "A:1"), ("B:1", "B:0")], "child string, parent string")
    got = d.from_ontology(t, s, e, excluded_roots=["B:0"], excluded_terms=["A:1"])
    assert [r[0] for r in rows(got)] == ["A:2", "A:3"]
    full = dict(rows(d.with_variants(got, greek=True, cells=True, acronyms=True)))
    assert "lung epithelial cell" in full["A:2"] and {"NKC", "IFNα", "IFN-α", "interferon α"} <= set(full["A:3"])
    done = dict(rows(d.finish(d.with_variants(got, acronyms=True), {"common": ["NKC", "A:2"]})))
    assert "NKC" not in done["A:3"] and "__A:2__" in done
    assert d.from_ontology(t.limit(0), s.limit(0)).count() == 0
