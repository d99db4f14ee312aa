"""Data model: variables, literals, classes and the graph handed to the match operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RDF_TYPE = "rdf:type"
RDF_NIL = "rdf:nil"

# Spark type for each literal datatype.
SPARK_TYPES: dict[str, str] = {
    "xsd:string": "string",
    "xsd:boolean": "boolean",
    "xsd:double": "double",
    "xsd:float": "float",
    "xsd:decimal": "decimal(38,10)",
    "xsd:integer": "bigint",
    "xsd:int": "int",
    "xsd:long": "bigint",
    "xsd:short": "smallint",
    "xsd:byte": "tinyint",
    "xsd:unsignedByte": "smallint",
    "xsd:unsignedShort": "int",
    "xsd:unsignedInt": "bigint",
    "xsd:unsignedLong": "decimal(20,0)",
    "xsd:positiveInteger": "bigint",
    "xsd:nonNegativeInteger": "bigint",
    "xsd:negativeInteger": "bigint",
    "xsd:nonPositiveInteger": "bigint",
    "xsd:dateTime": "timestamp_ntz",
    "xsd:dateTimeStamp": "timestamp",
    "xsd:date": "date",
    "xsd:time": "string",
    "xsd:duration": "string",
    "xsd:yearMonthDuration": "string",
    "xsd:dayTimeDuration": "string",
    "xsd:gYear": "string",
    "xsd:gMonth": "string",
    "xsd:gDay": "string",
    "xsd:gYearMonth": "string",
    "xsd:base64Binary": "binary",
    "xsd:hexBinary": "binary",
    "xsd:anyURI": "string",
    "xsd:language": "string",
    "xsd:normalizedString": "string",
    "xsd:token": "string",
    "xsd:NMTOKEN": "string",
    "xsd:Name": "string",
    "xsd:NCName": "string",
    "xsd:anySimpleType": "string",
    "xdd:dateTimeInterval": "string",
    "sys:JSON": "string",
}

# Literal datatype for each Spark type.
LITERAL_TYPES: dict[str, str] = {
    "string": "xsd:string",
    "boolean": "xsd:boolean",
    "double": "xsd:double",
    "float": "xsd:float",
    "tinyint": "xsd:byte",
    "smallint": "xsd:short",
    "int": "xsd:integer",
    "bigint": "xsd:integer",
    "timestamp": "xsd:dateTime",
    "timestamp_ntz": "xsd:dateTime",
    "date": "xsd:date",
    "binary": "xsd:base64Binary",
}

NUMERIC = {
    "xsd:double", "xsd:float", "xsd:decimal", "xsd:integer", "xsd:int", "xsd:long", "xsd:short", "xsd:byte",
    "xsd:unsignedByte", "xsd:unsignedShort", "xsd:unsignedInt", "xsd:unsignedLong", "xsd:positiveInteger",
    "xsd:nonNegativeInteger", "xsd:negativeInteger", "xsd:nonPositiveInteger",
}
TEMPORAL = {"xsd:dateTime", "xsd:dateTimeStamp", "xsd:date"}

QUAD_COLUMNS = ["graph", "s", "p", "o", "o_kind", "o_type", "o_num", "o_ts"]
QUAD_SCHEMA = (
    "graph string, s string, p string, o string, o_kind string, o_type string, o_num double, o_ts timestamp_ntz"
)
#: Columns that identify a fact; the typed shadows follow from them.
QUAD_KEY = ["graph", "s", "p", "o", "o_kind", "o_type"]


def literal_type(spark_type: str) -> str:
    """Literal datatype of a Spark type name."""
    return "xsd:decimal" if spark_type.startswith("decimal") else LITERAL_TYPES.get(spark_type, "xsd:string")


@dataclass(frozen=True)
class Var:
    """A query variable; it names a column of the binding frame."""

    name: str


@dataclass(frozen=True)
class Lit:
    """A typed literal in object position."""

    value: Any
    type: str | None = None

    @property
    def datatype(self) -> str:
        if self.type:
            return self.type
        if isinstance(self.value, bool):
            return "xsd:boolean"
        if isinstance(self.value, int):
            return "xsd:integer"
        if isinstance(self.value, float):
            return "xsd:decimal"
        return "xsd:string" if isinstance(self.value, str) else "xsd:dateTime"


def literal(value: Any, datatype: str) -> Lit:
    """A constant of a datatype."""
    return Lit(value, datatype if ":" in datatype else f"xsd:{datatype}")


def string(value: Any) -> Lit:
    return Lit(str(value), "xsd:string")


def boolean(value: Any) -> Lit:
    return Lit(bool(value), "xsd:boolean")


def datetime(value: dt.datetime | str) -> Lit:
    """A moment, from a Python value or ISO text."""
    held = dt.datetime.fromisoformat(value.replace("Z", "")) if isinstance(value, str) else value
    return Lit(held, "xsd:dateTime")


def date(value: dt.date | str) -> Lit:
    """A day, from a Python value or ISO text."""
    return Lit(dt.date.fromisoformat(value) if isinstance(value, str) else value, "xsd:date")


def iri(name: str) -> str:
    """A node name, as it is in subject, predicate and object position."""
    return name


def local_table(spark: SparkSession, **columns: list[str]) -> DataFrame:
    """Text columns held by the driver as a table whose size the optimizer knows."""
    return spark.createDataFrame(pa.table({name: pa.array(values, pa.string()) for name, values in columns.items()}))


def variable(arg: Any) -> str | None:
    """Column name of a variable (``Var`` or text with the ``v:`` mark), None for a constant."""
    if isinstance(arg, Var):
        return arg.name
    if isinstance(arg, str) and arg.startswith("v:"):
        return arg[2:]
    return None


def names(args: Iterable[Any]) -> list[str]:
    """Column names of variables; plain text is taken as a column name."""
    return [variable(a) or a for a in args]


def column(arg: Any) -> Column:
    """Column for an operand: a Column, a variable or column name, or a Python constant."""
    if isinstance(arg, Column):
        return arg
    if isinstance(arg, Lit):
        return F.lit(arg.value)
    name = variable(arg)
    if name is not None:
        return F.col(name)
    return F.col(arg) if isinstance(arg, str) else F.lit(arg)


@dataclass(frozen=True)
class Prop:
    """A property: datatype or class name, and whether it is required, optional, a set or a list."""

    name: str
    range: str
    kind: str = "required"

    @property
    def is_data(self) -> bool:
        return ":" in self.range


@dataclass(frozen=True)
class ClassDef:
    """A document class, enum or tagged union."""

    name: str
    props: tuple[Prop, ...] = ()
    parents: tuple[str, ...] = ()
    key: str = "Random"
    key_fields: tuple[str, ...] = ()
    kind: str = "class"
    values: tuple[str, ...] = ()
    abstract: bool = False
    subdocument: bool = False


class Schema:
    """The classes of a graph. Metadata only: its size does not grow with the documents."""

    def __init__(self, classes: Iterable[ClassDef] = ()):
        self.classes = {c.name: c for c in classes}

    def __getitem__(self, name: str) -> ClassDef:
        return self.classes[name]

    def __contains__(self, name: str) -> bool:
        return name in self.classes

    def ancestors(self, name: str) -> list[str]:
        """The class and everything it inherits from, nearest first."""
        seen, queue = [], [name]
        while queue:
            current = queue.pop(0)
            if current not in seen:
                seen.append(current)
                queue.extend(self.classes[current].parents if current in self.classes else ())
        return seen

    def properties(self, name: str) -> dict[str, Prop]:
        """All properties of a class, inherited ones included; the nearest definition wins."""
        found: dict[str, Prop] = {}
        for cls in self.ancestors(name):
            for prop in self.classes[cls].props if cls in self.classes else ():
                found.setdefault(prop.name, prop)
        return found

    def class_frame(self, name: str) -> dict[str, Any]:
        """Class description with inherited properties."""
        cls = self.classes[name]
        if cls.kind == "enum":
            return {"@type": "Enum", "@values": list(cls.values)}
        frame: dict[str, Any] = {"@type": "TaggedUnion" if cls.kind == "union" else "Class"}
        if cls.abstract:
            frame["@abstract"] = []
        if cls.subdocument:
            frame["@subdocument"] = []
        for prop in self.properties(name).values():
            wrapped = {"@type": prop.kind.capitalize(), "@class": prop.range}
            frame[prop.name] = prop.range if prop.kind == "required" else wrapped
        return frame

    def existing_classes(self) -> dict[str, dict[str, Any]]:
        return {name: self.class_frame(name) for name in self.classes}

    def closure(self, spark: SparkSession) -> DataFrame:
        """(child, parent) pairs of the subclass relation, reflexive and transitive."""
        pairs = [(c, a) for c in self.classes for a in self.ancestors(c)]
        return local_table(spark, child=[c for c, _ in pairs], parent=[a for _, a in pairs])

    def frame_table(self, spark: SparkSession) -> DataFrame:
        """(class, property, range, kind) of every class, inherited properties included."""
        props = [(c, p) for c in self.classes for p in self.properties(c).values()]
        return local_table(
            spark,
            **{"class": [c for c, _ in props]},
            property=[p.name for _, p in props],
            range=[p.range for _, p in props],
            kind=[p.kind for _, p in props],
        )

    def struct(self, name: str) -> T.StructType:
        """Spark schema of the class table."""
        fields = [T.StructField("id", T.StringType())]
        for prop in self.properties(name).values():
            kind: T.DataType = T.StringType()
            if prop.is_data:
                kind = T._parse_datatype_string(SPARK_TYPES.get(prop.range, "string"))
            elif prop.range in self.classes and self.classes[prop.range].subdocument:
                kind = T.StructType(self.struct(prop.range).fields[1:])
            if prop.kind in ("set", "list"):
                kind = T.ArrayType(kind)
            fields.append(T.StructField(prop.name, kind))
        return T.StructType(fields)


@dataclass
class Graph:
    """A dataset: one table per class, and/or facts as quads.

    Class tables are preferred; only patterns with an unbound predicate pay for turning them into quads.
    """

    tables: dict[str, DataFrame] = field(default_factory=dict)
    schema: Schema = field(default_factory=Schema)
    facts: DataFrame | None = None
    name: str = "instance"

    def quads(self) -> DataFrame:
        """All facts, class tables included."""
        from tripleframe.operators.documents import triplify

        parts = [] if self.facts is None else [self.facts]
        parts += [triplify(df, self.schema, cls, self.name) for cls, df in self.tables.items()]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def using(self, *classes: str, graph: str | None = None) -> Graph:
        """The same dataset restricted to some classes or to one named graph."""
        tables = {c: df for c, df in self.tables.items() if not classes or c in classes}
        facts = self.facts
        if graph is not None:
            tables = tables if graph == self.name else {}
            facts = None if facts is None else facts.where(F.col("graph") == graph)
        return Graph(tables, self.schema, facts, self.name)
