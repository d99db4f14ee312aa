"""Documents: class tables, their facts, scans, and batches of inserts, replacements and deletes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleframe.model import QUAD_COLUMNS, RDF_NIL, RDF_TYPE, SPARK_TYPES, ClassDef, Prop, Schema, literal_type
from tripleframe.session import cut
from tripleframe.sources.triples import compact, expand


# Documents as facts ---------------------------------------------------------------------------------


def _fact(s: Column, p: str, o: Column, kind: T.DataType, node: bool) -> dict[str, Column]:
    """Columns of one fact; the typed shadows come straight from the native column.

    A missing value gives a fact without predicate, so that counting predicates never builds the texts.
    """
    numeric = isinstance(kind, T.NumericType)
    moment = isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType))
    return {
        "s": s,
        "p": F.when(o.isNotNull(), F.lit(p)),
        "o": o.cast("string"),
        "o_kind": F.lit("node" if node else "data"),
        "o_type": F.lit(None if node else literal_type(kind.simpleString())).cast("string"),
        "o_num": o.cast("double") if numeric else F.lit(None).cast("double"),
        "o_ts": o.cast("timestamp_ntz") if moment else F.lit(None).cast("timestamp_ntz"),
    }


def _stacked(rows: DataFrame, facts: Sequence[dict[str, Column]], graph: str) -> DataFrame:
    """Facts of each row as rows, by UNPIVOT: compiled code, and columns nobody reads are not computed."""
    names = QUAD_COLUMNS[1:]
    wide = rows.select([fact[c].alias(f"{c}_{i}") for i, fact in enumerate(facts) for c in names])
    sets = ", ".join("(" + ", ".join(f"{c}_{i}" for c in names) + f") as f{i}" for i in range(len(facts)))
    text = f"select {', '.join(names)} from {{wide}} unpivot include nulls (({', '.join(names)}) for _f in ({sets}))"
    out = rows.sparkSession.sql(text, wide=wide).where(F.col("p").isNotNull())
    return out.select(F.lit(graph).alias("graph"), *names)


@dataclass(frozen=True)
class _Collection:
    """A set or list property of the documents named by ``subject``; ``inner`` is the class of nested documents in it."""

    subject: Column
    value: Column
    name: str
    kind: T.DataType
    node: bool
    ordered: bool
    inner: str


def _nested_facts(
    node: Column, value: Column, kind: T.StructType, schema: Schema, cls: str
) -> tuple[list[dict[str, Column]], list[_Collection]]:
    """Type and properties of a nested document; a null one has no facts."""
    facts, collections = _facts_of(node, value.getField, kind.fields, schema, cls)
    return [_fact(node, RDF_TYPE, F.when(value.isNotNull(), F.lit(cls)), T.StringType(), True), *facts], collections


def _facts_of(
    s: Column, value_of: Callable[[str], Column], fields: Sequence[T.StructField], schema: Schema, cls: str
) -> tuple[list[dict[str, Column]], list[_Collection]]:
    """Facts of scalar properties and nested documents, and the collections found on the way."""
    props = schema.properties(cls) if cls in schema else {}
    facts: list[dict[str, Column]] = []
    collections: list[_Collection] = []
    for f in fields:
        value, kind, prop = value_of(f.name), f.dataType, props.get(f.name)
        is_enum = prop is not None and prop.range in schema and schema[prop.range].kind == "enum"
        node = prop is not None and not prop.is_data and not is_enum
        inner = prop.range if prop else f.name
        if isinstance(kind, T.StructType):
            sub = F.concat(s, F.lit(f"/{f.name}"))
            facts.append(_fact(s, f.name, F.when(value.isNotNull(), sub), T.StringType(), True))
            deeper, deeper_collections = _nested_facts(sub, value, kind, schema, inner)
            facts += deeper
            collections += deeper_collections
        elif isinstance(kind, T.ArrayType):
            ordered = prop is not None and prop.kind == "list"
            collections.append(_Collection(s, value, f.name, kind.elementType, node, ordered, inner))
        else:
            facts.append(_fact(s, f.name, value, kind, node))
    return facts, collections


def _collection_facts(rows: DataFrame, held: _Collection, schema: Schema, graph: str, lists: bool) -> DataFrame:
    """Facts of a set or list, of its nested documents, and of the collections in these: one pass for each collection.

    Elements of a list hang on cells ``subject/name/position``, nested documents are the nodes ``cell/item``. In a set
    nested documents are the nodes ``subject/name/position`` of the distinct elements.
    """
    text = T.StringType()
    value = held.value if held.ordered else F.array_distinct(held.value)
    explode = F.posexplode_outer(value) if held.ordered else F.posexplode(value)
    entries = rows.select(
        held.subject.alias("_s"), value.isNotNull().alias("_held"), F.size(value).alias("_n"), explode.alias("_pos", "_x")
    )
    s, x = F.col("_s"), F.col("_x")
    place = lambda pos: F.concat(s, F.lit(f"/{held.name}/"), pos.cast("string"))
    here, deeper, collections = place(F.col("_pos")), [], []
    element, kind = x, held.kind
    if isinstance(kind, T.StructType):
        node = F.concat(here, F.lit("/item")) if held.ordered else here
        deeper, collections = _nested_facts(node, x, kind, schema, held.inner)
        element, kind = F.when(x.isNotNull(), node), text
    is_node = held.node or isinstance(held.kind, T.StructType)
    if held.ordered:
        full, first = F.col("_pos").isNotNull(), F.coalesce(F.col("_pos"), F.lit(0)) == 0
        rest = F.when(F.col("_pos") + 1 < F.col("_n"), place(F.col("_pos") + 1)).otherwise(F.lit(RDF_NIL))
        facts = [
            _fact(s, held.name, F.when(first & F.col("_held"), F.coalesce(here, F.lit(RDF_NIL))), text, True),
            _fact(here, RDF_TYPE, F.when(full, F.lit("rdf:List")), text, True),
            _fact(here, "rdf:first", element, kind, is_node),
            _fact(here, "rdf:rest", F.when(full, rest), text, True),
        ]
    else:
        facts = [_fact(s, held.name, element, kind, is_node)]
    out = _stacked(entries, [*facts, *deeper], graph)
    for inner in collections:
        if lists or not inner.ordered:
            out = out.unionByName(_collection_facts(entries, inner, schema, graph, lists))
    return out


def triplify(df: DataFrame, schema: Schema, cls: str, graph: str = "instance", lists: bool = False) -> DataFrame:
    """Facts of a class table: type, scalar properties and nested documents in one pass, each collection in another.

    Nested documents may be single or elements of sets and lists, at any depth. With ``lists`` lists become linked cells;
    without it they are left out because they are ordered: see ``list_rows`` and ``list_facts``. A null list has no fact and an
    empty one is nil; a set that is null or empty has no fact, and null elements of a set have none.
    """
    fields = [f for f in df.schema.fields if f.name != "id"]
    s = F.col("id")
    facts, collections = _facts_of(s, lambda name: F.col(f"`{name}`"), fields, schema, cls)
    out = _stacked(df, [_fact(s, RDF_TYPE, F.lit(cls), T.StringType(), True), *facts], graph)
    for held in collections:
        if lists or not held.ordered:
            out = out.unionByName(_collection_facts(df, held, schema, graph, lists))
    return out


def list_rows(df: DataFrame, prop: str) -> DataFrame:
    """(id, prop, pos, value) of a list property."""
    return df.select("id", F.lit(prop).alias("prop"), F.posexplode(prop).alias("pos", "value"))


def list_facts(df: DataFrame, prop: str, graph: str = "instance", schema: Schema | None = None, cls: str = "") -> DataFrame:
    """A list property as linked cells ``id/prop/pos``; with the schema nested documents and links in it have their classes."""
    held = schema.properties(cls).get(prop) if schema and cls in schema else None
    is_enum = held is not None and held.range in schema and schema[held.range].kind == "enum"
    node = held is not None and not held.is_data and not is_enum
    kind = df.schema[prop].dataType.elementType
    values = _Collection(F.col("id"), F.col(f"`{prop}`"), prop, kind, node, True, held.range if held else prop)
    return _collection_facts(df, values, schema or Schema(), graph, True)


def _is_nested(schema: Schema, prop: Prop) -> bool:
    return not prop.is_data and prop.range in schema and schema[prop.range].subdocument


def _classes_below(schema: Schema, cls: str) -> list[str]:
    """The class and the classes of the documents nested in it."""
    found = [cls]
    for current in found:
        below = [p.range for p in schema.properties(current).values() if _is_nested(schema, p)]
        found += [c for c in dict.fromkeys(below) if c not in found]
    return found


def assemble_documents(quads: DataFrame, schema: Schema, cls: str) -> DataFrame:
    """Class table from facts, the inverse of ``triplify`` and ``list_facts``.

    One aggregation by subject for the documents and all documents nested in them, whatever their class; nested documents are
    then put in from the innermost out, all properties of a class together, and so are the values of lists. Sets come
    sorted; one without facts is empty. A list is null without a fact and empty where it is nil. A nested document
    without facts of its own is null, in a set it is left out. A document is one row, and so are its sets and lists. Of
    several values of a single-valued property the smallest is taken; ``assembly_conflicts`` names them all.
    """
    classes = _classes_below(schema, cls)
    held = [p for c in classes for p in schema.properties(c).values()]
    is_type = F.col("p") == RDF_TYPE
    rows = quads.where(F.col("p").isin([p.name for p in held]) | (is_type & F.col("o").isin(classes)))
    aggs = [F.max(F.when(is_type & (F.col("o") == c), True)).alias(f"_is_{i}") for i, c in enumerate(classes)]
    columns: dict[tuple[str, str], str] = {}
    for c in classes:
        for name, prop in schema.properties(c).items():
            key = (name, _text_kind(schema, prop).simpleString())
            if key not in columns:
                columns[key] = f"_v_{len(columns)}"
                aggs.append(_value(prop, _text_kind(schema, prop)).alias(columns[key]))
    subjects = rows.groupBy(F.col("s").alias("id")).agg(*aggs)
    ordered = [p for p in held if p.kind == "list"]
    if len(classes) > 1 or ordered:
        subjects = cut(subjects)
    items = None
    if ordered:
        from tripleframe.operators.rdflist import cells_from_quads, list_positions

        items = cut(list_positions(cells_from_quads(quads)).select("head", "pos", "value"))

    def of_class(c: str) -> DataFrame:
        props = schema.properties(c)
        values = [F.col(columns[n, _text_kind(schema, p).simpleString()]).alias(n) for n, p in props.items()]
        plain = subjects.where(f"_is_{classes.index(c)}").select("id", *values)
        inner = {p.range: of_class(p.range) for p in props.values() if _is_nested(schema, p)}
        return _filled(plain, schema, c, inner, items)

    return of_class(cls)


def _text_kind(schema: Schema, prop: Prop) -> T.DataType:
    """What the facts of a property are read as: nodes and heads of lists are texts, a set is an array."""
    kind: T.DataType = T.StringType()
    if prop.is_data and prop.kind != "list":
        kind = T._parse_datatype_string(SPARK_TYPES.get(prop.range, "string"))
    return T.ArrayType(kind) if prop.kind == "set" else kind


def _value(prop: Prop, kind: T.DataType) -> Column:
    held = F.when(F.col("p") == prop.name, F.col("o"))
    if isinstance(kind, T.ArrayType):
        return F.array_sort(F.collect_set(held.try_cast(kind.elementType)))
    return F.min(held.try_cast(kind))


def _link_of(slot: int) -> Callable[[Column, Column], Column]:
    return lambda x, pos: F.struct(F.lit(slot).alias("slot"), pos.cast("bigint").alias("pos"), x.alias("text"))


def _cast_to(kind: T.DataType) -> Callable[[Column], Column]:
    return lambda x: x.try_cast(kind)


def _filled(plain: DataFrame, schema: Schema, cls: str, inner: dict[str, DataFrame], items: DataFrame | None) -> DataFrame:
    """Nodes and heads of lists replaced by what they stand for: one join with the inner documents, one grouping by document.

    Links are rows (id, slot, pos, text), where a slot is a property; documents without any take part in neither.
    """
    props = schema.properties(cls)
    slots = [n for n, p in props.items() if p.kind == "list" or _is_nested(schema, p)]
    if not slots:
        return plain
    kinds = schema.struct(cls)
    ranges = list(inner)
    direct, heads = [], []
    for i, name in enumerate(slots):
        value = F.col(f"`{name}`")
        at = _link_of(i)
        if props[name].kind == "list":
            heads.append(F.when(value.isNotNull() & (value != RDF_NIL), F.struct(F.lit(i).alias("slot"), value.alias("head"))))
        elif props[name].kind == "set":
            direct.append(F.transform(value, at))
        else:
            direct.append(F.when(value.isNotNull(), F.array(at(value, F.lit(0)))).otherwise(F.array()))
    parts = []
    if direct:
        parts.append(plain.select("id", F.inline(F.concat(*direct))))
    if heads:
        found = plain.select("id", F.inline(F.filter(F.array(*heads), lambda h: h.isNotNull())))
        parts.append(found.join(items, "head").select("id", "slot", "pos", F.col("value").alias("text")))
    links = reduce(lambda a, b: a.unionByName(b), parts)
    if inner:
        class_of = F.element_at(
            F.array(*[F.lit(ranges.index(props[n].range) if props[n].range in inner else None).cast("int") for n in slots]),
            F.col("slot") + 1,
        )
        links = links.withColumn("_k", class_of)
        made = [
            df.select(F.lit(k).alias("_k"), F.col("id").alias("text"), F.struct(*df.columns[1:]).alias(f"_in_{k}"))
            for k, df in enumerate(inner.values())
        ]
        documents = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), made)
        # Values of lists, and missing elements, are no nodes and take no part in the join.
        is_link = F.col("_k").isNotNull() & F.col("text").isNotNull()
        linked = links.where(is_link).join(documents, ["_k", "text"], "left")
        links = linked.unionByName(links.where(~is_link), allowMissingColumns=True)
    aggs = []
    for i, name in enumerate(slots):
        here = F.col("slot") == i
        value = F.col(f"_in_{ranges.index(props[name].range)}") if props[name].range in inner else F.col("text")
        if props[name].kind in ("set", "list"):
            aggs.append(F.array_sort(F.collect_list(F.when(here, F.struct("pos", value.alias("value"))))).alias(f"_slot_{i}"))
        else:
            aggs.append(F.first(F.when(here, value), ignorenulls=True).alias(f"_slot_{i}"))
    joined = plain.join(links.groupBy("id").agg(*aggs), "id", "left")
    out = []
    for name, prop in props.items():
        if name not in slots:
            out.append(F.col(f"`{name}`"))
            continue
        filled, kind = F.col(f"_slot_{slots.index(name)}"), kinds[name].dataType
        if prop.kind in ("set", "list"):
            nested = isinstance(kind.elementType, T.StructType)
            none, values = F.array().cast(kind), F.transform(filled, lambda x: x["value"])
            filled = values if nested else F.transform(values, _cast_to(kind.elementType))
            if prop.kind == "set":
                filled = F.coalesce(F.array_sort(F.array_distinct(F.filter(filled, lambda x: x.isNotNull()))), none)
            else:
                head = F.col(f"`{name}`")
                filled = F.when(head == RDF_NIL, none).when(head.isNotNull(), filled)
        out.append(filled.alias(name))
    return joined.select("id", *out)


def assembly_conflicts(quads: DataFrame, schema: Schema, cls: str) -> DataFrame:
    """(id, property, n) where a document of the class holds several values of a single-valued property."""
    single = [name for name, prop in schema.properties(cls).items() if prop.kind not in ("set",)]
    members = quads.where((F.col("p") == RDF_TYPE) & (F.col("o") == cls)).select("s").distinct()
    rows = quads.where(F.col("p").isin(single)).select("s", "p", "o").distinct().join(members, "s", "left_semi")
    counted = rows.groupBy(F.col("s").alias("id"), F.col("p").alias("property")).agg(F.count(F.lit(1)).alias("n"))
    return counted.where("n > 1")


def read_document(df: DataFrame, iri: str, table: DataFrame, output: str) -> DataFrame:
    """Bind the whole document of each bound id as JSON."""
    body = table.select(F.col("id").alias(iri), F.to_json(F.struct(*table.columns)).alias(output))
    return df.join(body, iri)


# Scans ----------------------------------------------------------------------------------------------


def documents_by_type(table: DataFrame, skip: int = 0, count: int | None = None) -> DataFrame:
    """Documents of a class by id; pages are numbered slice by slice."""
    if skip == 0 and count is None:
        return table
    if count is None:
        from tripleframe.operators.combine import start

        return start(table, skip, "id")
    from tripleframe.operators.combine import page

    return page(table, skip, count, "id")


def all_documents(
    tables: dict[str, DataFrame],
    skip: int = 0,
    count: int | None = None,
    schema: Schema | None = None,
    unfolded: int = 0,
    prefixes: dict[str, str] | None = None,
    prefixed: bool = True,
) -> DataFrame:
    """(id, type, body) of every class table.

    ``unfolded`` puts linked documents in, so many links deep (see ``unfold``). With ``prefixes`` all ids are prefixed names, or
    full ones where ``prefixed`` is false (see ``with_prefixes``). Both need the schema.
    """
    parts = []
    for cls, df in tables.items():
        held = unfold(tables, schema, cls, unfolded) if unfolded else df
        held = with_prefixes(held, schema, cls, prefixes, prefixed) if prefixes else held
        parts.append(held.select("id", F.lit(cls).alias("type"), F.to_json(F.struct(*held.columns)).alias("body")))
    return documents_by_type(reduce(lambda a, b: a.unionByName(b), parts), skip, count)


def _subclasses(schema: Schema, cls: str) -> list[str]:
    return [c for c in schema.classes if cls in schema.ancestors(c)]


def _props_below(schema: Schema, classes: Sequence[str]) -> dict[str, Prop]:
    """Properties of the classes; the first that has a name defines it."""
    found: dict[str, Prop] = {}
    for c in classes:
        for name, prop in schema.properties(c).items():
            found.setdefault(name, prop)
    return found


def unfold(tables: dict[str, DataFrame], schema: Schema, cls: str, depth: int = 3) -> DataFrame:
    """Class table whose links are replaced by the documents they name, ``depth`` links deep.

    Links stand in properties, in single nested documents, and in sets and lists; those within collections of nested documents
    stay ids. A link to a document that the way to it has been through already, or that no table holds, becomes a document
    with nothing but its ``id``, so cycles end. Documents of subclasses come with their own properties. Null stays null.
    """
    return _unfolded(tables, schema, [cls], depth)[0]


def _unfolded(tables: dict[str, DataFrame], schema: Schema, classes: list[str], depth: int) -> tuple[DataFrame, set[str]]:
    """Documents of the classes with their links put in, and the classes met below."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [tables[c] for c in classes])
    met: set[str] = set()
    if depth == 0:
        return out, met
    for path, prop in _links(out.schema, schema, classes):
        below = [c for c in _subclasses(schema, prop.range) if c in tables]
        if below:
            inner, deeper = _unfolded(tables, schema, below, depth - 1)
            met |= {*below, *deeper}
            own = F.col("id") if {*classes} & {*below, *deeper} else None
            out = _with_documents(out, path, prop, inner, own)
    return out, met


def _links(kind: T.StructType, schema: Schema, classes: Sequence[str], path: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], Prop]]:
    """Paths to the properties that hold ids of documents."""
    found = []
    for name, prop in _props_below(schema, classes).items():
        if name not in kind.names or prop.is_data or prop.range not in schema or schema[prop.range].kind == "enum":
            continue
        if not schema[prop.range].subdocument:
            if prop.kind not in ("set", "list") or not path:
                found.append(((*path, name), prop))
        elif isinstance(kind[name].dataType, T.StructType):
            found += _links(kind[name].dataType, schema, [prop.range], (*path, name))
    return found


def _bare(doc_id: Column, kind: T.StructType) -> Column:
    """A document of which nothing but the id is known."""
    return F.struct(doc_id.alias("id"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields if f.name != "id"])


def _without(value: Column, kind: T.DataType, own: Column) -> Column:
    """A document in which every document of the id ``own`` is left bare."""
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return F.transform(value, lambda x: _without(x, kind.elementType, own))
    if not isinstance(kind, T.StructType):
        return value
    held = F.struct(*[_without(value.getField(f.name), f.dataType, own).alias(f.name) for f in kind.fields])
    if "id" in kind.names:
        held = F.when(value.getField("id") == own, _bare(own, kind)).otherwise(held)
    return F.when(value.isNotNull(), held)


def _with_documents(df: DataFrame, path: tuple[str, ...], prop: Prop, inner: DataFrame, own: Column | None) -> DataFrame:
    """The ids at a path replaced by documents; ``own`` names documents that must not occur again below themselves."""
    columns = df.columns
    top = F.col(f"`{path[0]}`")
    documents = inner.select(F.col("id").alias("_ref"), F.struct(*inner.columns).alias("_doc"))
    kind = documents.schema["_doc"].dataType

    def found(ref: Column) -> Column:
        doc = F.coalesce("_doc", _bare(ref, kind))
        return F.when(ref.isNotNull(), doc if own is None else _without(doc, kind, F.col("id")))

    # Missing links get keys of their own, spread by document, that no document has.
    if prop.kind in ("set", "list"):
        links = df.select("id", F.posexplode(top).alias("_pos", "_x"))
        key = F.coalesce("_x", F.concat(F.lit("\0"), "id", F.lit("/"), F.col("_pos").cast("string")))
        held = links.withColumn("_key", key).join(documents, F.col("_key") == F.col("_ref"), "left")
        whole = F.array_sort(F.collect_list(F.struct("_pos", found(F.col("_x")).alias("_d"))))
        groups = held.groupBy("id").agg(F.transform(whole, lambda x: x["_d"]).alias("_all"))
        value = F.when(top.isNotNull(), F.coalesce("_all", F.array().cast(T.ArrayType(kind))))
        return df.join(groups, "id", "left").withColumn(path[0], value).select(*columns)
    ref = reduce(lambda x, name: x.getField(name), path[1:], top)
    key = F.coalesce(ref, F.concat(F.lit("\0"), "id"))
    held = df.withColumn("_key", key).join(documents, F.col("_key") == F.col("_ref"), "left")
    value = found(ref) if len(path) == 1 else F.when(top.isNotNull(), top.withField(".".join(path[1:]), found(ref)))
    return held.withColumn(path[0], value).select(*columns)


def with_prefixes(df: DataFrame, schema: Schema, cls: str, prefixes: dict[str, str], prefixed: bool = True) -> DataFrame:
    """Class table whose ids, those of its links and of documents in it included, are prefixed names or full ones.

    Of several namespaces that fit the longest gives the prefix. The namespace ``@base`` belongs to names without prefix. Other
    names stay.
    """
    named = {name: space for name, space in prefixes.items() if name != "@base"}
    base = prefixes.get("@base")
    mark = "@base:"

    def short(x: Column) -> Column:
        name = compact(x, prefixes)
        return F.when(F.startswith(name, F.lit(mark)), F.substring(name, F.lit(len(mark) + 1), F.length(name))).otherwise(name)

    def full(x: Column) -> Column:
        name = expand(x, named)
        return name if base is None else F.when(F.contains(x, F.lit(":")), name).otherwise(F.concat(F.lit(base), x))

    change = short if prefixed else full

    def fields(kind: T.StructType, value_of: Callable[[str], Column], classes: Sequence[str]) -> list[Column]:
        props = _props_below(schema, classes)
        return [
            (change(value_of("id")) if f.name == "id" else told(value_of(f.name), f.dataType, props.get(f.name))).alias(f.name)
            for f in kind.fields
        ]

    def told(value: Column, kind: T.DataType, prop: Prop | None) -> Column:
        if prop is None or prop.is_data or (prop.range in schema and schema[prop.range].kind == "enum"):
            return value
        if isinstance(kind, T.ArrayType):
            return F.transform(value, lambda x: told(x, kind.elementType, prop))
        if isinstance(kind, T.StructType):
            return F.when(value.isNotNull(), F.struct(*fields(kind, value.getField, _subclasses(schema, prop.range))))
        return change(value)

    return df.select(*fields(df.schema, lambda name: F.col(f"`{name}`"), [cls]))


def _matches(value: Column, template: Any) -> Column:
    if isinstance(template, dict):
        tests = [_matches(value[k], v) for k, v in template.items() if not k.startswith("@")]
        if "@id" in template:
            tests.append(value == template["@id"])
        return reduce(lambda a, b: a & b, tests) if tests else F.lit(True)
    if isinstance(template, (list, tuple, set)):
        return reduce(lambda a, b: a & b, [F.array_contains(value, v) for v in template])
    return value == F.lit(template)


def query_document(
    table: DataFrame, template: dict[str, Any], skip: int = 0, count: int | None = None
) -> DataFrame:
    """Documents equal to the template on its keys; nested keys test nested documents, lists test elements."""
    for key, want in template.items():
        if key == "@id":
            table = table.where(F.col("id") == want)
        elif not key.startswith("@"):
            table = table.where(_matches(F.col(key), want))
    return documents_by_type(table, skip, count)


def parse_template(schema: Schema, cls: str, pairs: Sequence[str]) -> dict[str, Any]:
    """Template from ``name=text``: each text is cast to the Spark type of the property's datatype, links stay text.

    A pair of double quotes around a text is taken off. Text that is no value of the datatype fails when the scan runs.
    """
    held = schema.properties(cls)
    template: dict[str, Any] = {"@type": cls}
    for name, text in (pair.split("=", 1) for pair in pairs):
        if name not in held:
            raise ValueError(f"{cls} has no property {name}")
        inner = text[1:-1] if len(text) > 1 and text[0] == text[-1] == '"' else text
        template[name] = F.lit(inner).cast(SPARK_TYPES.get(held[name].range, "string"))
    return template


def get_document(table: DataFrame, doc_id: str) -> DataFrame:
    return table.where(F.col("id") == doc_id)


def has_doc(table: DataFrame, doc_id: str) -> bool:
    """Whether a document exists; reads no property."""
    return not get_document(table, doc_id).select("id").isEmpty()


# Batches --------------------------------------------------------------------------------------------


def insert_document(table: DataFrame, batch: DataFrame, full_replace: bool = False) -> DataFrame:
    """Table after adding the batch; ids that exist already are left as they are, ``insert_conflicts`` names them."""
    if full_replace:
        return batch
    fresh = batch.join(table.select("id"), "id", "left_anti")
    return table.unionByName(_one_each(fresh), allowMissingColumns=True)


def _one_each(batch: DataFrame) -> DataFrame:
    """One document per id: of several in a batch, the one that is smallest as JSON."""
    body = F.to_json(F.struct(*batch.columns))
    held = batch.groupBy("id").agg(F.min_by(F.struct(*batch.columns), body).alias("_d"))
    return held.select("_d.*")


def insert_conflicts(table: DataFrame, batch: DataFrame) -> DataFrame:
    """(id, conflict) of what an insert leaves out: ``exists`` for taken ids, ``repeated`` for ids given several times."""
    taken = existing_ids(table, batch).distinct().select("id", F.lit("exists").alias("conflict"))
    again = batch.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return taken.unionByName(again.select("id", F.lit("repeated").alias("conflict")))


def existing_ids(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Ids of the batch that are taken."""
    return batch.select("id").join(table.select("id"), "id", "left_semi")


def missing_ids(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Ids of the batch that no document has."""
    return batch.select("id").join(table.select("id"), "id", "left_anti")


def replace_document(table: DataFrame, batch: DataFrame, create: bool = False) -> DataFrame:
    """Table after replacing documents by id; unknown ids are added only with ``create``."""
    new = _one_each(batch if create else batch.join(table.select("id"), "id", "left_semi"))
    return table.join(batch.select("id"), "id", "left_anti").unionByName(new, allowMissingColumns=True)


def update_document(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Table after replacing known documents and adding new ones."""
    return replace_document(table, batch, create=True)


def delete_document(table: DataFrame, ids: DataFrame) -> DataFrame:
    """Table without the documents of the ids."""
    return table.join(ids.select("id").distinct(), "id", "left_anti")


def resolve_references(batch: DataFrame, ref_cols: Sequence[str], capture: str = "capture") -> DataFrame:
    """Replace references to captured documents of the same batch by their ids; other values stay."""
    captured = batch.where(F.col(capture).isNotNull()).select(F.col(capture).alias("_c"), F.col("id").alias("_id"))
    out = batch
    for name in ref_cols:
        # Documents without the reference take no part in the join: null would be one hot key.
        held = out.where(F.col(name).isNotNull()).join(captured.withColumnRenamed("_c", name), name, "left")
        held = held.withColumn(name, F.coalesce("_id", name)).select(*out.columns)
        out = held.unionByName(out.where(F.col(name).isNull()))
    return out.select(*[c for c in batch.columns if c != capture])


def raw_json(batch: DataFrame, body: str = "body") -> DataFrame:
    """Untyped documents: JSON text parsed into a variant column, bad text gives null."""
    return batch.withColumn(body, F.try_parse_json(F.col(body)))


__all__ = [
    "ClassDef", "all_documents", "assemble_documents", "assembly_conflicts", "delete_document", "documents_by_type", "existing_ids",
    "get_document", "has_doc", "insert_conflicts", "insert_document", "list_facts", "list_rows", "missing_ids", "parse_template",
    "query_document", "raw_json", "read_document", "replace_document", "resolve_references", "triplify",
    "unfold", "update_document", "with_prefixes",
]
