"""Graph views of the given tables, as class tables and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripleframe.model import ClassDef, Graph, Prop, Schema
from tripleframe.plans.registry import Tables

# (class, source table, id, properties as (name, source, range))
_VIEWS: dict[str, tuple[str, str, list[tuple[str, str, str]]]] = {
    "Region": ("region", "r_regionkey", [("name", "r_name", "xsd:string")]),
    "Nation": ("nation", "n_nationkey", [("name", "n_name", "xsd:string"), ("region", "n_regionkey", "Region")]),
    "Customer": (
        "customer",
        "c_custkey",
        [
            ("name", "c_name", "xsd:string"),
            ("nation", "c_nationkey", "Nation"),
            ("acctbal", "c_acctbal", "xsd:double"),
            ("segment", "c_mktsegment", "xsd:string"),
        ],
    ),
    "Supplier": (
        "supplier",
        "s_suppkey",
        [("name", "s_name", "xsd:string"), ("nation", "s_nationkey", "Nation"), ("acctbal", "s_acctbal", "xsd:double")],
    ),
    "Part": (
        "part",
        "p_partkey",
        [
            ("name", "p_name", "xsd:string"),
            ("brand", "p_brand", "xsd:string"),
            ("line", "p_type", "xsd:string"),
            ("size", "p_size", "xsd:integer"),
            ("retailprice", "p_retailprice", "xsd:double"),
        ],
    ),
    "Order": (
        "orders",
        "o_orderkey",
        [
            ("customer", "o_custkey", "Customer"),
            ("status", "o_orderstatus", "xsd:string"),
            ("totalprice", "o_totalprice", "xsd:double"),
            ("orderdate", "o_orderdate", "xsd:dateTime"),
            ("priority", "o_orderpriority", "xsd:string"),
        ],
    ),
    "Lineitem": (
        "lineitem",
        "l_orderkey",
        [
            ("order", "l_orderkey", "Order"),
            ("part", "l_partkey", "Part"),
            ("supplier", "l_suppkey", "Supplier"),
            ("linenumber", "l_linenumber", "xsd:integer"),
            ("quantity", "l_quantity", "xsd:double"),
            ("extendedprice", "l_extendedprice", "xsd:double"),
            ("discount", "l_discount", "xsd:double"),
            ("tax", "l_tax", "xsd:double"),
            ("returnflag", "l_returnflag", "xsd:string"),
            ("linestatus", "l_linestatus", "xsd:string"),
            ("shipdate", "l_shipdate", "xsd:dateTime"),
        ],
    ),
}

SCHEMA = Schema(
    ClassDef(cls, tuple(Prop(n, r) for n, _, r in props), key="Lexical" if cls != "Lineitem" else "Random")
    for cls, (_, _, props) in _VIEWS.items()
)

#: Line items are named by their order, part, supplier and line.
_LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def class_table(t: Tables, cls: str) -> DataFrame:
    """One class table."""
    source, key, props = _VIEWS[cls]
    df = getattr(t, source)
    doc_id = F.concat(F.lit(f"{cls}/"), F.col(key).cast("string"))
    if cls == "Lineitem":
        doc_id = F.concat(F.lit(f"{cls}/"), F.concat_ws("_", *[F.col(k).cast("string") for k in _LINE_KEY]))
    cols = []
    for name, held, range_ in props:
        value = F.col(held)
        if range_ in SCHEMA:
            value = F.concat(F.lit(f"{range_}/"), value.cast("string"))
        cols.append(value.alias(name))
    return df.select(doc_id.alias("id"), *cols)


def graph(t: Tables, *classes: str) -> Graph:
    """Class tables of the star-shaped graph; all classes by default."""
    return Graph({c: class_table(t, c) for c in classes or _VIEWS}, SCHEMA)


def class_sql(cls: str) -> str:
    """The class table as SQL."""
    source, key, props = _VIEWS[cls]
    doc_id = f"'{cls}/' || {key}"
    if cls == "Lineitem":
        doc_id = f"'{cls}/' || concat_ws('_', {', '.join(_LINE_KEY)})"
    cols = []
    for name, held, range_ in props:
        value = f"'{range_}/' || {held}" if range_ in SCHEMA else held
        cols.append(f'{value} as "{name}"')
    return f"(select {doc_id} as id, {', '.join(cols)} from {source})"


def facts_sql(*classes: str, table: dict[str, str] | None = None) -> str:
    """The facts of classes as SQL: (s, p, o, o_kind, o_type)."""
    parts = []
    for cls in classes or _VIEWS:
        source = (table or {}).get(cls) or class_sql(cls)
        parts.append(f"select id as s, 'rdf:type' as p, '{cls}' as o, 'node' as o_kind, null::varchar as o_type from {source}")
        for name, _, range_ in _VIEWS[cls][2]:
            node = range_ in SCHEMA
            kind, datatype = ("'node'", "null::varchar") if node else ("'data'", f"'{range_}'")
            parts.append(f"select id, '{name}', \"{name}\"::varchar, {kind}, {datatype} from {source} where \"{name}\" is not null")
    return "(" + " union all ".join(parts) + ")"


# Two versions of the orders: open ones of low priority are gone, urgent ones are re-marked, pending ones of high
# priority are repeated under new ids.
_GONE = "o_orderpriority = '5-LOW' and o_orderstatus = 'O'"
_MARKED = "o_orderpriority = '1-URGENT'"
_COPIED = "o_orderpriority = '2-HIGH' and o_orderstatus = 'P'"
COPY_OFFSET = 1_000_000_000_000

ORDERS_AFTER_SQL = f"""(
  select o_orderkey, o_custkey, case when {_MARKED} then 'X' else o_orderstatus end as o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  from orders where not ({_GONE})
  union all
  select o_orderkey + {COPY_OFFSET}, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  from orders where {_COPIED}
)"""


def orders_after(t: Tables) -> DataFrame:
    """The later version of the orders table, in one pass."""
    original = F.struct(
        F.col("o_orderkey"), F.when(F.expr(_MARKED), F.lit("X")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    )
    copy = F.struct((F.col("o_orderkey") + COPY_OFFSET).alias("o_orderkey"), F.col("o_orderstatus"))
    rows = F.array(F.when(~F.expr(_GONE), original), F.when(F.expr(_COPIED), copy))
    kept = t.orders.withColumn("_r", F.explode(F.filter(rows, lambda r: r.isNotNull())))
    return kept.select(
        "_r.o_orderkey", "o_custkey", "_r.o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )


def order_documents(df: DataFrame) -> DataFrame:
    """Class table of an orders table."""
    props = _VIEWS["Order"][2]
    cols = [
        (F.concat(F.lit(f"{r}/"), F.col(c).cast("string")) if r in SCHEMA else F.col(c)).alias(n) for n, c, r in props
    ]
    return df.select(F.concat(F.lit("Order/"), F.col("o_orderkey").cast("string")).alias("id"), *cols)


def order_documents_sql(source: str) -> str:
    cols = ", ".join(
        (f"'{r}/' || {c}" if r in SCHEMA else c) + f' as "{n}"' for n, c, r in _VIEWS["Order"][2]
    )
    return f"(select 'Order/' || o_orderkey as id, {cols} from {source})"


def conversation_cells(t: Tables) -> DataFrame:
    """Conversations as linked lists: one cell per turn."""
    cell = F.concat(F.lit("Cell/"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"))
    after = F.concat(F.lit("Cell/"), F.col("conv_id").cast("string"), F.lit("/"), (F.col("turn") + 1).cast("string"))
    turns = t.conversations.select(cell.alias("cell"), F.col("text").alias("first"), after.alias("_after"))
    known = turns.select(F.col("cell").alias("_after"), F.lit(True).alias("_known"))
    rest = F.when(F.col("_known"), F.col("_after")).otherwise(F.lit("rdf:nil"))
    return turns.join(known, "_after", "left").select("cell", "first", rest.alias("rest"))


CELLS_SQL = """(
  select 'Cell/' || conv_id || '/' || turn as cell, text as first, conv_id, turn,
         case when turn = max(turn) over (partition by conv_id) then 'rdf:nil'
              else 'Cell/' || conv_id || '/' || (turn + 1) end as rest,
         'Cell/' || conv_id || '/0' as head, turn as pos
  from conversations)"""


def event_cells(t: Tables) -> DataFrame:
    """The events of each user as one long linked list in order of time."""
    from tripleframe.operators.spread import neighbours

    rows = t.events.select("user_id", F.struct("ts", "event_id").alias("at"), "event_type")
    rows = neighbours(rows, ["user_id"], "at", following="next")
    name = lambda c: F.concat(F.lit("Event/"), F.col(f"{c}.event_id").cast("string"))
    return rows.select(
        name("at").alias("cell"),
        F.col("event_type").alias("first"),
        F.coalesce(name("next"), F.lit("rdf:nil")).alias("rest"),
    )


def supplier_hops(t: Tables) -> Graph:
    """A cyclic graph over the suppliers: s to 3s + 1 and s to s squared, both modulo their number."""
    keys = t.supplier.select(F.col("s_suppkey").alias("s"))
    # One row: the number of suppliers.
    total = F.broadcast(keys.agg(F.count(F.lit(1)).alias("n")))
    rows = keys.join(total, how="cross")
    node = lambda c: F.concat(F.lit("Supplier/"), c.cast("string"))
    table = rows.select(
        node(F.col("s")).alias("id"),
        node((F.col("s") * 3 + 1) % F.col("n")).alias("hop"),
        node((F.col("s") * F.col("s")) % F.col("n")).alias("jump"),
    )
    schema = Schema([ClassDef("Supplier", (Prop("hop", "Supplier"), Prop("jump", "Supplier")))])
    return Graph({"Supplier": table}, schema)


HOPS_SQL = """(
  select 'Supplier/' || s_suppkey as id,
         'Supplier/' || ((3 * s_suppkey + 1) % (select count(*) from supplier)) as hop,
         'Supplier/' || ((s_suppkey * s_suppkey) % (select count(*) from supplier)) as jump
  from supplier)"""
