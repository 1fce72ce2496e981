"""Record sources and sinks: bibliographic XML, enriched JSON lines, dictionaries, lexica, plain lines; sharded outputs."""

from __future__ import annotations

import logging
import re
import time
import xml.etree.ElementTree as ET
from itertools import groupby, islice
from urllib.request import urlopen

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

log = logging.getLogger(__name__)

AUTHOR = "struct<Affiliation:string,CollectiveName:string,ForeName:string,Identifier:string,Initials:string,LastName:string,Suffix:string,full_name:string,short_name:string>"
PUBLICATION = (
    f"abstract string, authors array<{AUTHOR}>, chemicals array<struct<name:string,name_id:string,registryNumber:string>>, date string, doi string, filename string, full_text string, is_deleted boolean, "
    "journal struct<medlineAbbreviation:string,title:string>, journal_reference struct<issue:string,pgn:string,volume:string>, keywords array<string>, mesh_headings array<struct<id:string,label:string>>, pub_date string, pub_id string, pub_type array<string>, title string"
)
NAMES = [f.split(" ", 1)[0] for f in re.split(r", (?=\w+ (?:string|array|boolean|struct))", PUBLICATION)]
#: How the lines begin between which a record lies.
OPENINGS, CLOSINGS = ("<MedlineCitation ", "<DeleteCitation>"), ("</MedlineCitation>", "</DeleteCitation>")
#: Types of a table schema as JSON.
TYPES = {"STRING": StringType(), "INTEGER": LongType(), "FLOAT": DoubleType(), "BOOLEAN": BooleanType(), "DATE": DateType(), "TIMESTAMP": TimestampType()}
#: English month names as records abbreviate them.
MONTHS = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}


def frame(lines):
    """Records of a file: lines from an opening to a closing one, stripped and joined without a separator."""
    held = None
    for line in lines:
        line = line.strip()
        if line.startswith(OPENINGS):
            held = held if held is not None else []
        if held is not None:
            held.append(line)
            if line.startswith(CLOSINGS):
                yield "".join(held)
                held = None


def iso(year, month, day) -> str | None:
    try:
        m = MONTHS.get((month or "")[:3].lower()) or int(month)
        y, d = int(year), int(day)
        import datetime

        return datetime.date(y, m, d).isoformat()
    except (TypeError, ValueError):
        return None


def text_of(node, path: str) -> str | None:
    found = node.find(path) if node is not None else None
    return None if found is None else found.text


def date_of(node, default=None) -> str | None:
    if node is None:
        return None
    y, m, d = (text_of(node, x) for x in ("Year", "Month", "Day"))
    return iso(y or (default and default[0]), m or (default and default[1]), d or "1")


def parse_record(xml: str, filename: str) -> list[dict]:
    """One publication, or a tombstone for each id of a deletion. A record that isn't XML, or has no id, gives none."""
    try:
        root = ET.fromstring(xml)
    except ET.ParseError as e:
        log.error("a record of %s isn't XML, left out: %s", filename, e)
        return []
    empty = dict.fromkeys(NAMES)
    if root.tag == "DeleteCitation":
        return [empty | {"pub_id": p.text, "filename": filename, "is_deleted": True} for p in root.iter("PMID") if p.text]
    if not text_of(root, "PMID"):
        return []
    out = empty | {"pub_id": text_of(root, "PMID"), "filename": filename, "is_deleted": False, "full_text": "", "date": date_of(root.find("DateCreated"))}
    chemicals = root.find("ChemicalList")
    if chemicals is not None:
        out["chemicals"] = [{"name": text_of(c, "NameOfSubstance"), "name_id": c.find("NameOfSubstance").get("UI") if c.find("NameOfSubstance") is not None else None, "registryNumber": text_of(c, "RegistryNumber")} for c in chemicals]
    for words in root.findall("KeywordList"):  # a later list takes an earlier one's place
        out["keywords"] = [k.text for k in words]
    mesh = root.find("MeshHeadingList")
    if mesh is not None:
        out["mesh_headings"] = [{"id": d.get("UI"), "label": d.text} for d in mesh.iter("DescriptorName")]
    article = root.find("Article")
    return [out if article is None else out | parse_article(article)]


def parse_article(article) -> dict:
    out = {"title": text_of(article, "ArticleTitle")}  # what stands before inner markup
    abstract = article.find("Abstract")
    if abstract is not None:
        out["abstract"] = " ".join(a.text for a in abstract.findall("AbstractText") if a.text)
    journal = article.find("Journal")
    if journal is not None:
        last = journal[-1] if len(journal) else None
        out["journal"] = {"title": text_of(journal, "Title"), "medlineAbbreviation": (last.text or "") if last is not None and last.tag == "ISOAbbreviation" else ""}
        issue = journal.find("JournalIssue")
        if issue is not None and issue.find("PubDate") is not None:
            out["pub_date"] = date_of(issue.find("PubDate"), ("1800", "Jan"))
    out["journal_reference"] = {"volume": text_of(article, "Journal/JournalIssue/Volume"), "issue": text_of(article, "Journal/JournalIssue/Issue"), "pgn": text_of(article, "Pagination/MedlinePgn")}
    kinds = article.find("PublicationTypeList")
    if kinds is not None and len(kinds):
        out["pub_type"] = [k.text for k in kinds]
    for e in article.findall("ELocationID"):
        if e.get("EIdType") == "doi":
            out["doi"] = e.text
    authors = article.find("AuthorList")
    if authors is not None:
        out["authors"] = [author(a) for a in authors]
    return out


def author(node) -> dict:
    out = {}
    for child in node:
        out["Affiliation" if child.tag == "AffiliationInfo" else child.tag] = text_of(child, "Affiliation") if child.tag == "AffiliationInfo" else child.text
    last = out.get("LastName")
    if last:
        out["short_name"] = " ".join(x for x in (last, out.get("Initials")) if x)
        out["full_name"] = " ".join(x for x in (last, out.get("ForeName")) if x)
    return {k: out.get(k) for k in ("Affiliation", "CollectiveName", "ForeName", "Identifier", "Initials", "LastName", "Suffix", "full_name", "short_name")}


def parse_records(raw: DataFrame) -> DataFrame:
    """raw (xml, filename) to publications."""

    kind = pa.struct(to_arrow_schema(StructType.fromDDL(PUBLICATION)))

    def run(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 1000):
                part = batch.slice(s, 1000)
                rows = [r for x, f in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) for r in parse_record(x, f)]
                yield pa.RecordBatch.from_struct_array(pa.array(rows, kind))

    return raw.select("xml", "filename").mapInArrow(run, PUBLICATION)


def _lines(spark: SparkSession, paths, suffix: str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """value, filename, file, block: lines in order within a block of a file. Plain files are split, packed ones aren't."""
    reader = spark.read
    if suffix:
        reader = reader.option("pathGlobFilter", suffix)
    at = F.col("_metadata.file_path")
    value = F.col("value") if encoding.upper() in ("UTF-8", "UTF8") else F.decode(F.col("value").cast("binary"), encoding).alias("value")
    return reader.text(list(paths)).select(value, F.element_at(F.split(at, "/"), -1).alias("filename"), at.alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _by_block(batches):
    """((file, filename, block), its lines), one block after the other."""
    rows = (r for batch in batches for r in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
    for key, mine in groupby(rows, key=lambda r: r[1:]):
        yield (key[1], key[0], key[2]), (r[0] for r in mine)


def _frame_block(batches):
    """Lines to records, and to what a block has of records that begin before it or end behind it: rows (xml, filename, file, block, rest)."""
    names, types = ["xml", "filename", "file", "block", "rest"], [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    out, size = [], 0
    for (file, filename, block), lines in _by_block(batches):
        rest: list[str] = []
        begun = block == 0
        held: list[str] = []
        for line in lines:
            line = line.strip()
            begun = begun or line.startswith(OPENINGS)
            if not begun:
                rest.append(line)
                continue
            if held or line.startswith(OPENINGS):
                held.append(line)
                if line.startswith(CLOSINGS):
                    out.append(("".join(held), filename, file, block, None))
                    size += len(out[-1][0])
                    held = []
            if size > 4_000_000:
                yield batch_of(out)
                out, size = [], 0
        if rest or held:
            out.append((None, filename, file, block, "\n".join(rest + held)))
    if out:
        yield batch_of(out)


def _stitch(rows: pa.Table) -> pa.Table:
    """What the blocks of a file have of records across their borders, in order, to whole records."""
    rows = rows.sort_by("block")
    found = list(frame(line for rest in rows["rest"].to_pylist() for line in rest.split("\n")))
    return pa.table([found, [rows["filename"][0].as_py()] * len(found)], schema=pa.schema([("xml", pa.string()), ("filename", pa.string())]))


def read_raw_records(spark: SparkSession, *paths: str) -> DataFrame:
    """xml, filename of the records in (gzipped) XML files. Lines stream; a plain file is read by several tasks, and a record that lies
    across a border of theirs is put together from its parts, which are few."""
    spec = "xml string, filename string, file string, block long, rest string"
    framed = _lines(spark, paths).mapInArrow(_frame_block, spec)
    across = framed.where("xml is null").groupBy("file").applyInArrow(_stitch, "xml string, filename string")
    return framed.where("xml is not null").select("xml", "filename").unionByName(across)


def read_records(spark: SparkSession, *paths: str) -> DataFrame:
    """Publications of (gzipped) XML files; the newest of a record isn't chosen here."""
    return parse_records(read_raw_records(spark, *paths))


def read_lines(spark: SparkSession, *paths: str, prefix: str = "", suffix: str = "", encoding: str = "UTF-8", skip_header_lines: int = 0, strip: bool = True, validate: bool = True) -> DataFrame:
    """value, filename of the lines of plain or packed text files, by the beginnings and endings of their names.

    skip_header_lines: lines left out at the beginning of each file; strip: whether lines lose the newline at their end;
    validate: whether it is an error that no file is there. Large plain files are read by several tasks.
    """
    lines = _lines(spark, paths, f"{prefix}*{suffix}" if prefix or suffix else None, encoding)
    if validate and not lines.inputFiles():
        raise FileNotFoundError(f"no file {prefix}*{suffix} in {paths}")
    if skip_header_lines:

        def run(batches):
            for (_, filename, block), mine in _by_block(batches):
                rest = iter(mine if block else islice(mine, skip_header_lines, None))
                while some := list(islice(rest, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([filename] * len(some))], ["value", "filename"])

        lines = lines.mapInArrow(run, "value string, filename string")
    return lines.select("value" if strip else F.concat("value", F.lit("\n")).alias("value"), "filename")


def schema_of(spec: dict) -> StructType:
    """A table schema as JSON, {fields: [{name, type, mode, fields}]}, to a schema: type is STRING and mode NULLABLE by default."""

    def field(one: dict) -> StructField:
        inner = one.get("fields")
        kind = StructType([field(f) for f in inner]) if inner else TYPES[one.get("type", "STRING").upper()]
        mode = one.get("mode", "NULLABLE").upper()
        return StructField(one["name"], ArrayType(kind) if mode == "REPEATED" else kind, mode != "REQUIRED")

    return StructType([field(f) for f in spec["fields"]])


def read_enriched(spark: SparkSession, path: str, schema: str = PUBLICATION) -> DataFrame:
    return spark.read.schema(schema).json(path)


def fetch(url: str, tries: int = 3, pause: float = 1.0) -> str | None:
    """What a URL holds; after ``tries`` failures it is logged and left out."""
    for k in range(tries):
        try:
            with urlopen(url) as answer:
                return answer.read().decode()
        except OSError as e:
            log.warning("%s: %s", url, e)
            if k + 1 < tries:
                time.sleep(pause)
    log.error("cannot read dictionary %s, left out", url)
    return None


def read_dictionary(spark: SparkSession, *paths: str, tries: int = 3, pause: float = 1.0) -> DataFrame:
    """Entries of files CATEGORY-DB[_more].json, {surface: {ids, pref_name}}, in files or at URLs: surface, label, category,
    reference_db, ids, idx. idx: the order of paths, then files, then entries. Of URLs the driver reads one at a time.
    """
    kind = "map<string,struct<ids:array<string>,pref_name:string>>"
    out = None
    for place, path in enumerate(paths):
        if path.startswith(("http://", "https://", "ftp://")):
            found = fetch(path, tries, pause)
            if found is None:
                continue
            files = spark.createDataFrame([(found, path.split("?")[0])], "value string, path string")
        else:
            files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
        files = files.select("value", F.element_at(F.split("path", "/"), -1).alias("name"))
        one = files.select("name", F.posexplode(F.from_json("value", kind)).alias("pos", "surface", "v"))
        part = lambda i: F.regexp_extract("name", r"^([^-]+)-([^._]+)", i)
        idx = F.struct(F.lit(place).alias("place"), F.col("name"), F.col("pos"))
        one = one.select("surface", F.col("v.pref_name").alias("label"), part(1).alias("category"), part(2).alias("reference_db"), F.col("v.ids").alias("ids"), idx.alias("idx"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = spark.createDataFrame([], "surface string, label string, category string, reference_db string, ids array<string>, idx struct<place:int,name:string,pos:int>")
    return out


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a lexicon and their variants: entry_id, base_form, written_form, frequency."""
    schema = "_entryId string, _baseForm string, Variant array<struct<_writtenForm:string,_type:string,_mlfreq:int>>"
    entries = spark.read.format("xml").option("rowTag", "Entry").schema(schema).load(path)
    return entries.select(F.col("_entryId").alias("entry_id"), F.col("_baseForm").alias("base_form"), F.explode_outer("Variant").alias("v")).select("entry_id", "base_form", F.col("v._writtenForm").alias("written_form"), F.col("v._mlfreq").alias("frequency"))


def as_json(df: DataFrame) -> DataFrame:
    """A JSON line for each row: keys sorted at every level, nulls kept, letters unescaped."""
    return df.select(F.to_json(F.parse_json(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})), {"ignoreNullFields": "false"}).alias("value"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    as_json(df).write.mode(mode).option("compression", "gzip").text(path)
