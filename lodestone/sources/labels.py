"""Label documents in XML to records: two dialects, one pass, a document in memory at a time.

Spark's own XML source infers types from codes and loses the order of words in mixed content, so the
documents are read from bytes with the standard parser inside an Arrow function.
"""

from __future__ import annotations

import gzip
import io
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import scalars as S
from lodestone.schemas import SPL_DOCUMENTS, conform

# Identifiers of the document standard and of section codes.
HL7_NAMESPACE = b"urn:hl7-org:v3"
APPLICATION_OID, APPLICATION_CODES, LOINC_OID = "2.16.840.1.113883.3.150", "2.16.840.1.113883.3.26.1.1", "2.16.840.1.113883.6.1"
SECTION_NAMES = {
    "34067-9": "indications", "34070-3": "contraindications", "34066-1": "boxed_warning", "34071-1": "warnings", "43685-7": "warnings_and_precautions",
    "34084-4": "adverse_reactions", "34073-7": "drug_interactions", "34068-7": "dosage_and_administration", "42232-9": "precautions",
}
ROW = (
    "file string, ordinal int, set_id string, approvals array<struct<approval_id:string,code:string,type:string>>, "
    "ingredients array<struct<name:string,unii:string,role:string>>, "
    "sections array<struct<loinc:string,name:string,title:string,raw_text:string,clean_text:string>>, warnings array<string>"
)


@dataclass
class Document:
    set_id: str = ""
    approvals: list[dict] = field(default_factory=list)
    ingredients: list[dict] = field(default_factory=list)
    sections: list[dict] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)


def _local(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2]


def is_loinc(code: str) -> bool:
    head, dash, tail = code.partition("-")
    return bool(dash and head.isdigit() and tail)


def _prefixed(code: str) -> str:
    return f"UNII:{code}" if code else ""


def _attr(e: ET.Element, name: str) -> str:
    return (e.get(name) or "").strip()


class _Reader:
    """Builds a document's record from the parser's events, in one pass.

    `opened` and `closed` look up what to do by tag; `above` holds the tags that are open. Sections that
    are open collect the codes and titles met in them, so nested sections are not searched again.
    """

    def __init__(self) -> None:
        self.doc = Document()
        self.above: list[str] = []
        self.sections: list[dict] = []  # open ones, innermost last
        self.finished: list[tuple[int, dict]] = []
        self.started = 0
        self.opened = {"section": self.section_opens, "code": self.code_opens}
        self.closed = {"section": self.section_closes, "title": self.title_closes}

    def start(self, e: ET.Element) -> None:
        tag = _local(e)
        if act := self.opened.get(tag):
            act(e)
        self.above.append(tag)

    def end(self, e: ET.Element) -> None:
        tag = self.above.pop()
        if act := self.closed.get(tag):
            act(e)

    def section_opens(self, e: ET.Element) -> None:
        self.started += 1
        self.sections.append({"at": self.started, "official": "", "shaped": "", "any": "", "title": ""})

    def code_opens(self, e: ET.Element) -> None:
        code = e.get("code")
        if not code:
            return
        for s in self.sections:
            s["any"] = s["any"] or code
            if is_loinc(code):
                s["shaped"] = s["shaped"] or code
            if e.get("codeSystem") == LOINC_OID:
                s["official"] = s["official"] or code

    def title_closes(self, e: ET.Element) -> None:
        title = "".join(e.itertext()).strip()
        for s in self.sections:
            s["title"] = s["title"] or title

    def section_closes(self, e: ET.Element) -> None:
        s = self.sections.pop()
        loinc = s["official"] or s["shaped"] or s["any"] or _attr(e, "loinc")
        name = _attr(e, "name") or SECTION_NAMES.get(loinc, loinc)
        raw = "".join(e.itertext()).strip()
        if not loinc:
            self.doc.warnings.append("section missing LOINC code")
        self.finished.append((s["at"], {"loinc": loinc, "name": name, "title": s["title"] or name, "raw_text": raw, "clean_text": " ".join(raw.split())}))

    def result(self) -> Document:
        self.doc.sections = [s for _, s in sorted(self.finished, key=lambda x: x[0])]
        self.doc.ingredients.sort(key=lambda i: i["role"] != "active")
        return self.doc


class _Simple(_Reader):
    """The plain dialect: what is not a section stands right below the document."""

    def __init__(self) -> None:
        super().__init__()
        self.closed |= {"setId": self.set_id, "approval": self.approval, "activeIngredient": self.ingredient, "inactiveIngredient": self.ingredient}

    def end(self, e: ET.Element) -> None:
        if len(self.above) == 2 or self.above[-1] in ("section", "title"):
            super().end(e)
        else:
            self.above.pop()

    def set_id(self, e: ET.Element) -> None:
        self.doc.set_id = self.doc.set_id or (e.text or "").strip()

    def approval(self, e: ET.Element) -> None:
        self.doc.approvals.append({"approval_id": _attr(e, "code"), "code": _attr(e, "code"), "type": _attr(e, "type")})

    def ingredient(self, e: ET.Element) -> None:
        self.doc.ingredients.append({"name": _attr(e, "name"), "unii": _prefixed(_attr(e, "unii")), "role": "active" if _local(e)[0] == "a" else "inactive"})

    def result(self) -> Document:
        if not self.doc.set_id:
            self.doc.warnings.insert(0, "document missing setId")
        return super().result()


class _Standard(_Reader):
    """The namespaced standard: ids and codes are attributes, at any depth."""

    def __init__(self) -> None:
        super().__init__()
        self.numbers: dict[str, str] = {}  # a row per number; the type of its last approval holds
        self.approval = {"number": None, "type": None}
        self.found: dict[tuple[str, str, str], dict] = {}
        self.inert: list[bool] = []
        self.opened |= {"setId": self.set_id, "approval": self.approval_opens, "id": self.id_opens, "ingredient": self.ingredient_opens}
        self.closed |= {"approval": self.approval_closes, "ingredient": lambda e: self.inert.pop(), "inactiveIngredientSubstance": self.inactive, "ingredientSubstance": self.substance}
        self.closed |= {"activeMoiety": self.active, "activeIngredientSubstance": self.active}

    def set_id(self, e: ET.Element) -> None:
        self.doc.set_id = self.doc.set_id or (e.get("root") or "").strip().lower()

    def approval_opens(self, e: ET.Element) -> None:
        self.approval = {"number": None, "type": None}

    def id_opens(self, e: ET.Element) -> None:
        if "approval" in self.above and self.approval["number"] is None and e.get("root") == APPLICATION_OID:
            self.approval["number"] = _attr(e, "extension")

    def code_opens(self, e: ET.Element) -> None:
        super().code_opens(e)
        if "approval" in self.above and self.approval["type"] is None and e.get("codeSystem") == APPLICATION_CODES:
            self.approval["type"] = e.get("code") or ""

    def approval_closes(self, e: ET.Element) -> None:
        if self.approval["number"]:
            self.numbers[self.approval["number"]] = self.approval["type"] or ""

    def ingredient_opens(self, e: ET.Element) -> None:
        self.inert.append(e.get("classCode") == "IACT")

    def add(self, e: ET.Element, role: str) -> None:
        said = {_local(c): c for c in reversed(e)}  # the first child of each tag
        name = "".join(said["name"].itertext()).strip() if "name" in said else ""
        code = _prefixed(_attr(said["code"], "code")) if "code" in said else ""
        if name:
            self.found.setdefault((role, code, name.lower()), {"name": name, "unii": code, "role": role})

    def active(self, e: ET.Element) -> None:
        if "activeMoiety" in self.above:
            self.add(e, "active")

    def inactive(self, e: ET.Element) -> None:
        self.add(e, "inactive")

    def substance(self, e: ET.Element) -> None:
        if any(self.inert):
            self.add(e, "inactive")

    def result(self) -> Document:
        if not self.doc.set_id:
            self.doc.warnings.insert(0, "document missing setId root")
        self.doc.approvals = [{"approval_id": n, "code": n, "type": t} for n, t in self.numbers.items()]
        self.doc.ingredients = list(self.found.values())
        return super().result()


def parse_label_file(data: bytes) -> Iterator[Document]:
    """Documents of one XML file, gzip or not; each is freed after it was read."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    dialect = _Standard if HL7_NAMESPACE in stream.read(4096) else _Simple
    stream.seek(0)
    reader = None
    for event, e in ET.iterparse(stream, events=("start", "end")):
        if reader is None:
            if event == "end" or _local(e) != "document":
                continue
            reader = dialect()
        getattr(reader, event)(e)
        if event == "end" and not reader.above:
            yield reader.result()
            reader = None
            e.clear()


def label_documents(rows: DataFrame) -> DataFrame:
    """Records of label files `(path, name, content)`; a file that is no XML gives one record with a warning.

    Documents before a fault in a file are kept. `ordinal` counts the documents of a file from 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = pa.string()
        shape = lambda *names: pa.list_(pa.struct([(n, text) for n in names]))
        schema = pa.schema([
            ("file", text), ("ordinal", pa.int32()), ("set_id", text), ("approvals", shape("approval_id", "code", "type")), ("ingredients", shape("name", "unii", "role")),
            ("sections", shape("loinc", "name", "title", "raw_text", "clean_text")), ("warnings", pa.list_(text)),
        ])
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n = 0
                try:
                    for d in parse_label_file(data or b""):
                        yield pa.RecordBatch.from_pylist([{"file": name, "ordinal": n, **vars(d)}], schema=schema)
                        n += 1
                except (ET.ParseError, OSError, EOFError) as e:
                    yield pa.RecordBatch.from_pylist([{"file": name, "ordinal": n, **vars(Document(warnings=[f"parse error: {e}"]))}], schema=schema)

    xml = rows.where(F.lower("name").rlike(r"\.xml(\.gz)?$"))
    return xml.select("name", "content").mapInArrow(run, ROW)


def label_tables(documents: DataFrame) -> dict[str, DataFrame]:
    """The flat tables of label records: sets, approvals, ingredients, sections, documents and warnings.

    Every table carries source_record_id, spl_set_id, release_file and xml_path; sections have an
    ordinal, as a section code may repeat within a label.
    """
    base = documents.select(F.col("set_id").alias("spl_set_id"), F.col("file").alias("release_file"), F.col("file").alias("xml_path"), "ordinal", "approvals", "ingredients", "sections", "warnings")
    source = ["spl_set_id", "release_file", "xml_path"]

    def flat(column: str, kind: str, keys: list[str], **names: str) -> DataFrame:
        one = base.select(*source, "ordinal", F.posexplode(column).alias("at", "x"))
        record = S.stable_id(F.col("release_file"), F.lit(kind), F.col("ordinal"), F.col("spl_set_id"), *[F.col(f"x.{k}") for k in keys])
        return one.select(record.alias("source_record_id"), *source, "ordinal", "at", *[F.col(f"x.{v}").alias(k) for k, v in names.items()])

    sections = flat("sections", "section", ["loinc", "clean_text"], loinc_code="loinc", section_name="name", section_title="title", raw_text="raw_text", clean_text="clean_text")
    sections = sections.withColumn("spl_document_id", S.document_id(F.col("spl_set_id"), F.col("loinc_code")))
    first = lambda c, cond: F.get(F.filter(c, cond), F.lit(0))
    active, approval = first("ingredients", lambda i: i["role"] == "active"), first("approvals", lambda a: F.lit(True))
    blank = lambda c, name: F.coalesce(c, F.lit("")).alias(name)
    wide = base.select(
        "spl_set_id", "xml_path", "release_file", blank(approval["code"], "approval_code"), blank(approval["type"], "approval_type"), blank(active["name"], "active_ingredient_name"),
        blank(active["unii"], "active_ingredient_unii"), F.explode("sections").alias("x"),
    )
    wide = wide.select("*", F.col("x.loinc").alias("loinc_code"), F.col("x.name").alias("section_name"), F.col("x.clean_text").alias("section_text"))
    wide = wide.withColumn("spl_document_id", S.document_id(F.col("spl_set_id"), F.col("loinc_code")))
    return {
        "spl_sets": base.where("spl_set_id <> ''").select(S.stable_id(F.col("release_file"), F.lit("set"), F.col("ordinal"), F.col("spl_set_id")).alias("source_record_id"), *source),
        "spl_approvals": flat("approvals", "approval", ["approval_id"], approval_id="approval_id", approval_code="code", approval_type="type"),
        "spl_ingredients": flat("ingredients", "ingredient", ["role", "unii", "name"], ingredient_name="name", ingredient_unii="unii", role="role"),
        "spl_sections": sections,
        "spl_documents": conform(wide, SPL_DOCUMENTS),
        "warnings": base.select("release_file", "ordinal", F.explode("warnings").alias("message")),
    }
