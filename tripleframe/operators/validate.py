"""Checks of documents against their class, and classes inferred from tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleframe.functions.ids import hashed, lexical
from tripleframe.model import SPARK_TYPES, ClassDef, Prop, Schema, literal_type, local_table

VIOLATIONS = "struct<property:string,rule:string,value:string>"

# Ranges of the bounded integer datatypes.
INTEGER_RANGES: dict[str, tuple[int | None, int | None]] = {
    "xsd:byte": (-128, 127),
    "xsd:short": (-32768, 32767),
    "xsd:int": (-2147483648, 2147483647),
    "xsd:unsignedByte": (0, 255),
    "xsd:unsignedShort": (0, 65535),
    "xsd:unsignedInt": (0, 4294967295),
    "xsd:unsignedLong": (0, None),
    "xsd:positiveInteger": (1, None),
    "xsd:nonNegativeInteger": (0, None),
    "xsd:negativeInteger": (None, -1),
    "xsd:nonPositiveInteger": (None, 0),
}

# Fixed patterns: lexical forms of the restricted text datatypes.
TEXT_PATTERNS: dict[str, str] = {
    "xsd:gYear": r"^-?\d{4,}$",
    "xsd:gMonth": r"^--(0[1-9]|1[0-2])$",
    "xsd:gDay": r"^---(0[1-9]|[12]\d|3[01])$",
    "xsd:gYearMonth": r"^-?\d{4,}-(0[1-9]|1[0-2])$",
    "xsd:time": r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?$",
    "xsd:language": r"^[a-zA-Z]{1,8}(-[a-zA-Z0-9]{1,8})*$",
    "xsd:NMTOKEN": r"^[\w.:-]+$",
    "xsd:Name": r"^[A-Za-z_:][\w.:-]*$",
    "xsd:NCName": r"^[A-Za-z_][\w.-]*$",
    "xsd:normalizedString": r"^[^\r\n\t]*$",
    "xsd:token": r"^(\S+( \S+)*)?$",
    "xsd:yearMonthDuration": r"^-?P(\d+Y)?(\d+M)?$",
    "xsd:dayTimeDuration": r"^-?P(\d+D)?(T(\d+H)?(\d+M)?(\d+(\.\d+)?S)?)?$",
}


def _violation(prop: str, rule: str, value: Column, when: Column) -> Column:
    row = F.struct(F.lit(prop).alias("property"), F.lit(rule).alias("rule"), value.cast("string").alias("value"))
    return F.when(when, row)


def _value_rules(prop: Prop, value: Column, kind: T.DataType, schema: Schema) -> list[Column]:
    rules = []
    if prop.range in schema and schema[prop.range].kind == "enum":
        wrong = value.isNotNull() & ~value.isin(*schema[prop.range].values)
        return [_violation(prop.name, "enum", value, wrong)]
    if not prop.is_data:
        return rules
    wanted = SPARK_TYPES.get(prop.range, "string")
    typed = value
    if isinstance(kind, T.StringType) and wanted not in ("string", "binary"):
        typed = value.try_cast(wanted)
        rules.append(_violation(prop.name, "type", value, value.isNotNull() & typed.isNull()))
    elif not isinstance(kind, T.StringType) and wanted == "string":
        rules.append(_violation(prop.name, "type", value, value.isNotNull()))
    if prop.range in INTEGER_RANGES:
        low, high = INTEGER_RANGES[prop.range]
        number = value.try_cast("decimal(38,0)")
        outside = F.lit(False)
        if low is not None:
            outside = outside | (number < low)
        if high is not None:
            outside = outside | (number > high)
        rules.append(_violation(prop.name, "range", value, outside))
    if prop.range in TEXT_PATTERNS and isinstance(kind, T.StringType):
        rules.append(_violation(prop.name, "form", value, ~value.rlike(TEXT_PATTERNS[prop.range])))
    return rules


def _any_broken(rules: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [r.isNotNull() for r in rules], F.lit(False))


def _element_test(prop: Prop, kind: T.DataType, schema: Schema) -> Callable[[Column], Column]:
    return lambda x: _any_broken(_value_rules(prop, x, kind, schema))


def _class_rules(
    schema: Schema, cls: str, struct: T.StructType, at: Callable[[str], Column], prefix: str, present: Column
) -> list[Column]:
    """Rules of a class on the fields of a document; nested documents are checked by their own class where they are present."""
    definition, props = schema[cls], schema.properties(cls)
    kinds = {f.name: f.dataType for f in struct.fields}
    rules: list[Column] = []
    if definition.abstract:
        rules.append(_violation(f"{prefix}@type", "abstract", F.lit(cls), present))
    if definition.kind == "union":
        held = sum((F.when(at(p).isNotNull(), 1).otherwise(0) for p in props if p in kinds), F.lit(0))
        rules.append(_violation(f"{prefix}@type", "tagged_union", held, present & (held != 1)))
    for prop in (replace(p, name=f"{prefix}{p.name}") for p in props.values()):
        name = prop.name.removeprefix(prefix)
        needed = prop.kind == "required" and definition.kind != "union"
        if name not in kinds:
            if needed:
                rules.append(_violation(prop.name, "required", F.lit(None), present))
            continue
        value, kind = at(name), kinds[name]
        if needed:
            rules.append(_violation(prop.name, "required", F.lit(None), present & value.isNull()))
        if isinstance(kind, T.ArrayType):
            broken = F.filter(value, _element_test(prop, kind.elementType, schema))
            rules.append(_violation(prop.name, "element", F.to_json(broken), F.size(broken) > 0))
        elif isinstance(kind, T.StructType):
            if prop.range in schema:
                rules.extend(_class_rules(schema, prop.range, kind, value.getField, f"{prop.name}.", present & value.isNotNull()))
        else:
            rules.extend(_value_rules(prop, value, kind, schema))
    return rules


def validate_documents(df: DataFrame, schema: Schema, cls: str) -> DataFrame:
    """(id, property, rule, value) of every broken rule, in one pass over the documents.

    Rules: required, type, range, form, enum, abstract, tagged_union, key; the properties of nested documents are named with
    their path. References need the target tables:
    see ``dangling_references``.
    """
    definition = schema[cls]
    rules = _class_rules(schema, cls, df.schema, lambda name: F.col(f"`{name}`"), "", F.lit(True))
    if definition.key in ("Lexical", "Hash") and definition.key_fields and "id" in df.columns:
        make = lexical if definition.key == "Lexical" else hashed
        wanted = make(cls, definition.key_fields)
        rules.append(_violation("@id", "key", F.col("id"), ~F.col("id").eqNullSafe(wanted)))
    if not rules:
        return df.select("id").where(F.lit(False)).selectExpr("id", "'' property", "'' rule", "'' value")
    found = F.filter(F.array(*rules), lambda x: x.isNotNull())
    return df.select("id", F.inline(found))


def dangling_references(df: DataFrame, prop: str, target: DataFrame) -> DataFrame:
    """(id, property, rule, value) of references to documents that do not exist."""
    refs = df.select("id", F.col(prop).alias("value"))
    if isinstance(df.schema[prop].dataType, T.ArrayType):
        refs = df.select("id", F.explode(prop).alias("value"))
    refs = refs.where(F.col("value").isNotNull())
    missing = refs.join(target.select(F.col("id").alias("value")), "value", "left_anti")
    return missing.select("id", F.lit(prop).alias("property"), F.lit("reference").alias("rule"), "value")


def key_changes(before: DataFrame, after: DataFrame, definition: ClassDef) -> DataFrame:
    """(id, property, rule, value) of key properties that changed in place."""
    both = before.alias("b").join(after.alias("a"), F.col("b.id") == F.col("a.id"))
    rules = [
        _violation(k, "key changed", F.col(f"a.`{k}`"), ~F.col(f"b.`{k}`").eqNullSafe(F.col(f"a.`{k}`")))
        for k in definition.key_fields
    ]
    return both.select(F.col("b.id").alias("id"), F.inline(F.filter(F.array(*rules), lambda x: x.isNotNull())))


# Inference ------------------------------------------------------------------------------------------

# Datatypes tried on text columns, the one to prefer first. A value has a bit for each datatype it can be read
# as, and a column has the datatypes that all its values have in common.
_LATTICE = ("xsd:integer", "xsd:double", "xsd:decimal", "xsd:boolean", "xsd:date", "xsd:dateTime", "xsd:duration")
# Fixed patterns: texts of datatypes. Text that fails its pattern is never parsed, which is much cheaper than a failed parse.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?([Nn]a[Nn]|[Ii]nf(inity)?)$"
_INTEGER = r"^[+-]?0*\d{1,19}$"
_BLANKS = r"[\s\p{Cntrl}]*"
_BOOLEAN = f"(?i)^{_BLANKS}(t|true|y|yes|1|f|false|n|no|0){_BLANKS}$"
_MOMENT = rf"^{_BLANKS}[+-]?\d{{4,}}(-|{_BLANKS}$)"
_LONG_NUMBER = r"^[+-]?0*(\d\.?){18,}$"
_DECIMAL = r"^[+-]?\d{1,28}(\.\d{0,10})?$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_DURATION = r"^-?P(?=.)(\d+Y)?(\d+M)?(\d+D)?(T(?=.)(\d+H)?(\d+M)?(\d+(\.\d+)?S)?)?$"


@dataclass(frozen=True)
class Profile:
    """What one pass over a table tells: datatype of each column, and the columns that hold a null."""

    ranges: dict[str, str]
    nulls: frozenset[str]
    rows: int

    def kind(self, name: str) -> str:
        """Spark type a text column is read as."""
        return SPARK_TYPES.get(self.ranges[name], "string")


def _readable(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Add the datatypes a text can be read as, a bit each. Texts are trimmed and held against the number pattern once."""
    value, number = F.col("_value"), F.col("_number")
    rows = rows.withColumn("_value", F.trim(text)).withColumn("_number", value.rlike(_NUMBER))
    tests = {
        "xsd:integer": value.rlike(_INTEGER) & value.try_cast("bigint").isNotNull(),
        # A number of more digits than a double holds is one only if its column has no other way.
        "xsd:double": number & ~value.rlike(_LONG_NUMBER),
        "xsd:decimal": value.rlike(_DECIMAL),
        "xsd:boolean": value.rlike(_BOOLEAN) & value.try_cast("boolean").isNotNull(),
        "xsd:date": value.rlike(_DATE) & value.try_cast("date").isNotNull(),
        "xsd:dateTime": ~number & value.rlike(_MOMENT) & value.try_cast("timestamp_ntz").isNotNull(),
        "xsd:duration": value.rlike(_DURATION),
    }
    bits = [F.when(tests[kind], F.lit(1 << i)).otherwise(F.lit(0)) for i, kind in enumerate(_LATTICE)]
    state = reduce(lambda a, b: a + b, bits, F.when(number, F.lit(1 << len(_LATTICE))).otherwise(F.lit(0)))
    return rows.withColumn(name, F.when(value.isNotNull(), state)).drop("_value", "_number")


def _range_of(state: int | None) -> str:
    for i, kind in enumerate(_LATTICE):
        if state and state & 1 << i:
            return kind
    # Numbers of any length, some of which are no decimals either.
    return "xsd:double" if state and state & 1 << len(_LATTICE) else "xsd:string"


def profile(df: DataFrame, complete: bool = False) -> Profile:
    """Datatypes and nulls of a table, in one aggregation whatever the number of columns.

    Typed columns keep their type. A text column takes the first datatype of the lattice that all its values can be read as: integer,
    double, decimal (where some number has more digits than a double holds), boolean, date, dateTime, duration; a column without values
    is text. States of parts of a table are merged by intersecting them. ``complete`` looks at rows without nulls only, for datatypes.
    """
    names = [F.col(f"`{f.name}`") for f in df.schema.fields]
    whole = reduce(lambda a, b: a & b, [c.isNotNull() for c in names], F.lit(True))
    is_text = [isinstance(f.dataType, T.StringType) for f in df.schema.fields]
    # The values of all columns are tested by the same code, a row each: tests of every column side by side are too much to compile.
    entries = [
        F.struct(F.lit(i).alias("at"), c.isNotNull().alias("held"), ((F.when(whole, c) if complete else c) if text else F.lit(None).cast("string")).alias("text"))
        for i, (c, text) in enumerate(zip(names, is_text, strict=True))
    ]
    rows = df.select(F.inline(F.array(*entries)).alias("_at", "_held", "_text"))
    found = _readable(rows, "_text", "_state").groupBy("_at").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("_held"), 1)).alias("n"), F.bit_and("_state").alias("state")
    )
    # One row a column.
    seen = {r["_at"]: r for r in found.collect()}
    count = seen[0]["rows"] if seen else 0
    ranges = {}
    for i, f in enumerate(df.schema.fields):
        if is_text[i]:
            ranges[f.name] = _range_of(seen[i]["state"] if seen else None)
        elif isinstance(f.dataType, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
            ranges[f.name] = "xsd:duration"
        else:
            ranges[f.name] = literal_type(f.dataType.simpleString())
    nulls = frozenset(f.name for i, f in enumerate(df.schema.fields) if seen and seen[i]["n"] < count)
    return Profile(ranges, nulls, count)


def infer_types(df: DataFrame) -> dict[str, str]:
    """Spark type of each column; text columns take the type their datatype is read as."""
    found = profile(df)
    return {f.name: found.kind(f.name) if isinstance(f.dataType, T.StringType) else f.dataType.simpleString() for f in df.schema.fields}


def infer_class(
    df: DataFrame,
    class_name: str,
    keys: Sequence[str] = (),
    na_mode: str | None = None,
    id_col: str | None = None,
    embedded: Sequence[str] = (),
    found: Profile | None = None,
) -> ClassDef:
    """Class of a table from its profile. Each column has a role: a link to a document of the class (``embedded``), part of the
    identity (keys and id column, always required), or a plain value that may be missing where ``na_mode`` is ``optional``."""
    found = found or profile(df)
    identity = {*keys, id_col}
    links = dict.fromkeys(embedded, class_name)
    value_kind = "optional" if na_mode == "optional" else "required"
    props = tuple(Prop(c, links.get(c, r), "required" if c in identity else value_kind) for c, r in found.ranges.items())
    return ClassDef(class_name, props, key="Lexical" if keys else "Random", key_fields=tuple(keys))


def class_table(df: DataFrame, class_name: str) -> DataFrame:
    """(class, property, range, nullable) of an inferred class as rows."""
    found = profile(df)
    props = infer_class(df, class_name, found=found).props
    table = local_table(
        df.sparkSession,
        property=[p.name for p in props],
        range=[p.range for p in props],
        nullable=[str(p.name in found.nulls).lower() for p in props],
    )
    return table.select(F.lit(class_name).alias("class"), "property", "range", F.col("nullable").cast("boolean"))
