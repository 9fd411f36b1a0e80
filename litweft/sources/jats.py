"""Full texts: JATS XML, one article per member of (compressed) tar files."""

from __future__ import annotations

import re
import tarfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "doc_id string, pmid string, title string, journal string, doi string, year int, month int, day int, "
    "authors array<struct<author_ord:int,firstname:string,lastname:string>>, abstract array<struct<label:string,text:string>>, "
    "body array<struct<label:string,text:string>>, citations array<string>, member string, problem string"
)


def _stream(path: str):
    from pyarrow import fs

    where, inner = fs.FileSystem.from_uri(path.replace("file:///", "file:/").replace("file:/", "file:///"))
    return where.open_input_stream(inner, compression=None)


def tar_members(spark: SparkSession, path: str, suffixes: tuple[str, ...] = (".nxml", ".xml")) -> DataFrame:
    """``(file, member, xml)``: members are read as a stream, so neither a tar file nor its list has to fit in memory."""
    files = spark.read.format("binaryFile").load(path).select("path")  # the content column is not read

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p in pdf["path"]:
                with _stream(p) as raw, tarfile.open(fileobj=raw, mode="r|*") as tar:
                    for m in tar:
                        if m.isfile() and m.name.endswith(suffixes):
                            text = tar.extractfile(m).read().decode("utf-8", "replace")
                            yield pd.DataFrame({"file": [p], "member": [m.name], "xml": [text]})

    return files.mapInPandas(run, "file string, member string, xml string")


def _inner(node: ET.Element | None, skip: tuple[str, ...] = ()) -> str:
    """All text inside a node but that of ``skip`` elements, blanks collapsed."""
    if node is None:
        return ""
    out: list[str] = []

    def walk(n: ET.Element) -> None:
        if n.text:
            out.append(n.text)
        for c in n:
            if c.tag not in skip:
                walk(c)
            if c.tail:
                out.append(c.tail)

    walk(node)
    return re.sub(r"\s+", " ", "".join(out)).strip()


def _strip_names(root: ET.Element) -> None:
    for n in root.iter():
        if isinstance(n.tag, str):
            n.tag = n.tag.rpartition("}")[2]


def _sections(parent: ET.Element | None) -> list[dict]:
    """Label (title, else id, else GENERAL) and text without references; texts of one label are joined."""
    if parent is None:
        return []
    found: dict[str, list[str]] = {}
    secs = parent.findall(".//sec") or [parent]
    for sec in secs:
        label = _inner(sec.find("title")) or sec.get("id") or "GENERAL"
        text = " ".join(t for p in sec.findall("p") if (t := _inner(p, ("xref", "table-wrap", "fig"))))
        if text:
            found.setdefault(label.upper(), []).append(text)
    return [{"label": k, "text": " ".join(v)} for k, v in found.items()]


def _number(node: ET.Element | None, name: str) -> int | None:
    text = _inner(node.find(name)) if node is not None else ""
    return int(text) if text.isdigit() else None


def parse(xml: str) -> dict:
    """Fields of one article; raises ParseError on broken XML."""
    root = ET.fromstring(xml)
    _strip_names(root)
    meta = root.find(".//article-meta")
    if meta is None:
        raise ET.ParseError("no article-meta")
    ids = {n.get("pub-id-type"): _inner(n) for n in meta.findall("article-id")}
    pmc = ids.get("pmc") or ids.get("pmcid") or ""
    dates = meta.findall("pub-date")
    date = next((d for t in ("epub", "ppub", "pmc-release") for d in dates if d.get("pub-type") == t), dates[0] if dates else None)
    authors = []
    for c in meta.findall(".//contrib[@contrib-type='author']"):
        name = c.find(".//name")
        first, last = (_inner(name.find("given-names")), _inner(name.find("surname"))) if name is not None else ("", _inner(c.find(".//collab")))
        authors.append({"author_ord": len(authors) + 1, "firstname": first, "lastname": last})
    cited = [_inner(n) for n in root.findall(".//ref-list//pub-id[@pub-id-type='pmid']")]
    return {
        "doc_id": pmc if pmc.startswith("PMC") or not pmc else f"PMC{pmc}", "pmid": ids.get("pmid"), "title": _inner(meta.find(".//article-title"), ("xref",)),
        "journal": _inner(root.find(".//journal-title")), "doi": ids.get("doi"), "year": _number(date, "year"), "month": _number(date, "month"), "day": _number(date, "day"),
        "authors": authors, "abstract": _sections(meta.find("abstract")), "body": _sections(root.find("body")), "citations": [c for c in cited if c], "problem": None,
    }


def fields(members: DataFrame) -> DataFrame:
    """Fields of every member; a member that is no article has only ``member`` and ``problem``, so nothing is lost silently."""
    names = [c.strip().split(" ")[0] for c in re.split(r",\s(?![^<]*>)", SCHEMA)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for member, xml in zip(pdf["member"], pdf["xml"]):
                try:
                    row = parse(xml)
                except ET.ParseError as e:
                    row = dict.fromkeys(names) | {"problem": str(e)}
                rows.append(row | {"member": member})
            yield pd.DataFrame(rows, columns=names).astype({"year": "Int32", "month": "Int32", "day": "Int32"})

    return members.select("member", "xml").mapInPandas(run, SCHEMA)


def id_map(docs: DataFrame) -> DataFrame:
    """``(pmc_id, pmid)`` of articles that have both."""
    return docs.where("doc_id <> '' and pmid <> ''").select(F.col("doc_id").alias("pmc_id"), "pmid").distinct()
