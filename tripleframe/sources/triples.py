"""Facts as N-Triples text, and expansion of prefixed names.

Blank nodes keep their ``_:`` name. A language tag is the type of its text, as ``@en``. Lines that cannot be read are rows of
``bad_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripleframe.model import QUAD_COLUMNS
from tripleframe.operators.update import shadows

# Fixed pattern: one N-Triples line.
_LINE = r'^\s*(<[^>]*>|_:[^\s<>]+)\s+<([^>]*)>\s+(?:(<[^>]*>|_:[^\s<>]+)|"((?:[^"\\]|\\.)*)"(?:\^\^<([^>]*)>|(@[A-Za-z0-9-]+))?)\s*\.\s*(?:#.*)?$'

# Short names of common terms.
SHORT_NAMES: dict[str, str] = {
    "type": "rdf:type",
    "label": "rdfs:label",
    "Class": "owl:Class",
    "DatatypeProperty": "owl:DatatypeProperty",
    "ObjectProperty": "owl:ObjectProperty",
    "comment": "rdfs:comment",
    "range": "rdfs:range",
    "domain": "rdfs:domain",
    "subClassOf": "rdfs:subClassOf",
    "boolean": "xsd:boolean",
    "string": "xsd:string",
    "integer": "xsd:integer",
    "decimal": "xsd:decimal",
    "email": "xdd:email",
    "json": "xdd:json",
    "dateTime": "xsd:dateTime",
    "date": "xsd:date",
    "coordinate": "xdd:coordinate",
    "line": "xdd:coordinatePolyline",
    "polygon": "xdd:coordinatePolygon",
}

# Namespaces of the standard vocabularies.
PREFIXES: dict[str, str] = {
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "owl": "http://www.w3.org/2002/07/owl#",
}

# Escapes of N-Triples text, the backslash first.
_ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))
_MARK = "\u0000"


def _escape(text: Column) -> Column:
    for plain, escaped in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def _unescape(text: Column) -> Column:
    # Escaped backslashes are set aside first, so that \\n is not read as a line break.
    text = F.replace(text, F.lit("\\\\"), F.lit(_MARK))
    for plain, escaped in _ESCAPES[1:]:
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return F.replace(text, F.lit(_MARK), F.lit("\\"))


def to_ntriples(quads: DataFrame) -> DataFrame:
    """One N-Triples line per fact."""

    def iri(c: str) -> Column:
        name = F.col(c)
        return F.when(name.startswith("_:"), name).otherwise(F.concat(F.lit("<"), name, F.lit(">")))

    mark = F.when(F.col("o_type").startswith("@"), F.col("o_type")).otherwise(F.concat(F.lit("^^"), iri("o_type")))
    typed = F.concat(F.lit('"'), _escape(F.col("o")), F.lit('"'), mark)
    obj = F.when(F.col("o_kind") == "node", iri("o")).otherwise(typed)
    return quads.select(F.concat_ws(" ", iri("s"), iri("p"), obj, F.lit(".")).alias("value"))


def from_ntriples(lines: DataFrame, graph: str = "instance") -> DataFrame:
    """Facts of N-Triples lines; blank lines and comments are skipped."""
    line = F.col("value")

    def name(group: int) -> Column:
        held = F.regexp_extract(line, _LINE, group)
        return F.when(held.startswith("<"), held.substr(F.lit(2), F.length(held) - 2)).otherwise(held)

    rows = lines.where(line.rlike(_LINE)).select(
        F.lit(graph).alias("graph"),
        name(1).alias("s"),
        F.regexp_extract(line, _LINE, 2).alias("p"),
        name(3).alias("_node"),
        F.regexp_extract(line, _LINE, 4).alias("_text"),
        F.concat(F.regexp_extract(line, _LINE, 5), F.regexp_extract(line, _LINE, 6)).alias("_type"),
        # A node is never the empty text, but its brackets may hold nothing.
        (F.regexp_extract(line, _LINE, 3) != "").alias("_is_node"),
    )
    node = F.col("_is_node")
    typed = F.when(F.col("_type") == "", F.lit("xsd:string")).otherwise(F.col("_type"))
    out = rows.select(
        "graph",
        "s",
        "p",
        F.when(node, F.col("_node")).otherwise(_unescape(F.col("_text"))).alias("o"),
        F.when(node, "node").otherwise("data").alias("o_kind"),
        F.when(~node, typed).alias("o_type"),
    )
    return shadows(out).select(*QUAD_COLUMNS)


def bad_lines(lines: DataFrame) -> DataFrame:
    """Lines that are neither facts, blank, nor comments."""
    line = F.col("value")
    return lines.where(~line.rlike(_LINE) & ~line.rlike(r"^\s*(#.*)?$"))


def read_triples(spark: SparkSession, path: str, graph: str = "instance") -> DataFrame:
    return from_ntriples(spark.read.text(path), graph)


def write_triples(quads: DataFrame, path: str, graph: str = "instance") -> None:
    """Write one graph as N-Triples text."""
    to_ntriples(quads.where(F.col("graph") == graph)).write.mode("overwrite").text(path)


def insert_triples(quads: DataFrame, new: DataFrame) -> DataFrame:
    """Facts after adding new ones; a fact exists once."""
    return quads.select(*QUAD_COLUMNS).unionByName(new.select(*QUAD_COLUMNS)).repartition("s", "o").distinct()


def update_triples(quads: DataFrame, new: DataFrame, graph: str = "instance") -> DataFrame:
    """Facts after replacing a whole graph."""
    # Dealt by fact first, so that no task holds all facts it reads to find equal ones.
    once = new.select(*QUAD_COLUMNS).repartition("s", "o").distinct()
    return quads.where(F.col("graph") != graph).select(*QUAD_COLUMNS).unionByName(once)


def expand(iri: Column, prefixes: dict[str, str], short_names: dict[str, str] | None = None) -> Column:
    """Full IRI of a prefixed or short name; unknown names stay."""
    out = iri
    if short_names:
        table = F.create_map(*[F.lit(x) for pair in short_names.items() for x in pair])
        out = F.coalesce(F.try_element_at(table, out), out)
    spaces = F.create_map(*[F.lit(x) for pair in prefixes.items() for x in pair])
    prefix = F.substring_index(out, ":", 1)
    local = F.substring(out, F.length(prefix) + 2, F.length(out))
    space = F.when(F.contains(out, F.lit(":")), F.try_element_at(spaces, prefix))
    return F.when(space.isNotNull(), F.concat(space, local)).otherwise(out)


def compact(iri: Column, prefixes: dict[str, str]) -> Column:
    """Prefixed name of a full IRI; the longest namespace wins, unknown IRIs stay."""
    out = None
    for name, space in sorted(prefixes.items(), key=lambda p: -len(p[1])):
        short = F.concat(F.lit(f"{name}:"), F.substring(iri, F.lit(len(space) + 1), F.length(iri)))
        test = F.startswith(iri, F.lit(space))
        out = F.when(test, short) if out is None else out.when(test, short)
    return iri if out is None else out.otherwise(iri)
