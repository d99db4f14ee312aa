"""Queries over sources, sinks, documents and pattern scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleframe.model import Graph, Var, date, datetime
from tripleframe.operators import combine as c
from tripleframe.operators import documents as docs
from tripleframe.operators import match, update
from tripleframe.operators.update import changes_between
from tripleframe.plans import views
from tripleframe.plans.registry import Tables, query
from tripleframe.plans.views import class_sql, class_table, facts_sql, graph
from tripleframe.session import cut
from tripleframe.sources import csv, flatten, triples
from tripleframe.sources import json as json_lines

FACTS = ["s", "p", "o", "o_kind", "o_type"]


# Sources and sinks ----------------------------------------------------------------------------------

ORDER_FIELDS = [csv.as_("order", "v:o_orderkey"), csv.as_("status", "v:o_orderstatus"), csv.as_("price", "v:o_totalprice")]


@query(
    "A1_get_by_name_and_index",
    "select o_orderkey as order_no, o_orderstatus as status, o_totalprice as price from orders",
)
def get_by_name_and_index(t: Tables) -> DataFrame:
    source = csv.file(t.scratch())
    csv.put(t.orders, ORDER_FIELDS, source)
    wanted = [csv.as_("order", "v:order_no", "xsd:integer"), csv.as_(1, "v:status"), csv.as_(2, "v:price", "xsd:double")]
    return csv.get(t.spark, wanted, source)


@query("A2_csv_source_options", "select p_partkey as part, p_name as name, p_size as size from part")
def csv_source_options(t: Tables) -> DataFrame:
    path = t.scratch()
    csv.put(t.part, [csv.as_("k", "p_partkey"), csv.as_("n", "p_name"), csv.as_("s", "p_size")], csv.post(path, {"sep": "|"}))
    source = csv.remote(path, {"sep": "|", "format": "csv", "format_header": True})
    wanted = [csv.as_("k", "v:part", "xsd:integer"), csv.as_("n", "v:name"), csv.as_("s", "v:size", "xsd:int")]
    return csv.get(t.spark, wanted, source)


@query(
    "A3_put_round_trip",
    "select doc_id, lang, md5(text) as digest from documents",
)
def put_round_trip(t: Tables) -> DataFrame:
    """Texts with line breaks, quotes and blanks at the ends come back as they were."""
    source = csv.file(t.scratch(), {"multiLine": True, "lineSep": "\n"})
    csv.put(t.documents, [csv.as_("id", "v:doc_id"), csv.as_("lang", "v:lang"), csv.as_("text", "v:text")], source)
    back = csv.get(t.spark, [csv.as_("id", "v:doc_id", "xsd:integer"), csv.as_("lang", "v:lang"), csv.as_("text", "v:text")], source)
    return back.select("doc_id", "lang", F.md5("text").alias("digest"))


def _part_csv(t: Tables) -> str:
    """Part table as CSV with odd headers and missing brands."""
    path = t.scratch()
    part = t.part.select(
        F.col("p_partkey").alias("Part Key"),
        F.col("p_name").alias("P.Name"),
        F.when(F.col("p_type") != "PROMO", F.col("p_brand")).alias("Brand"),
        F.col("p_size").alias("Size"),
        F.col("p_retailprice").alias("Price"),
    )
    csv.export_csv(part, path)
    return path


@query(
    "A4_import_csv_skip",
    """select 'Part/' || p_partkey as id, p_partkey as part_key, p_name, p_brand as brand, p_size::bigint as size, p_retailprice as price
       from part where p_type <> 'PROMO'""",
)
def import_csv_skip(t: Tables) -> DataFrame:
    return csv.import_csv(t.spark, _part_csv(t), keys=["part_key"], class_name="Part", na="skip")[0]


@query(
    "A4_import_csv_optional",
    """select 'Part/' || p_partkey || '_' || replace(p_name, ' ', '%20') as id, p_partkey as part_key, p_name,
              case when p_type <> 'PROMO' then p_brand end as brand, p_size::bigint as size, p_retailprice as price
       from part""",
)
def import_csv_optional(t: Tables) -> DataFrame:
    return csv.import_csv(t.spark, _part_csv(t), keys=["part_key", "p_name"], class_name="Part", na="optional")[0]


@query(
    "A4_import_csv_embedded",
    """select 'Part/' || p_partkey as id, p_partkey as part_key, p_name, 'Part/' || p_brand as brand, p_size::bigint as size,
              p_retailprice as price from part where p_type <> 'PROMO'""",
)
def import_csv_embedded(t: Tables) -> DataFrame:
    return csv.import_csv(t.spark, _part_csv(t), class_name="Part", id_="part_key", embedded=["brand"])[0]


@query(
    "A4_import_csv_error_mode",
    "select 'Part/' || p_partkey as id, p_partkey as key, p_name as name, p_size::bigint as size, p_retailprice as price from part",
)
def import_csv_error_mode(t: Tables) -> DataFrame:
    """A file without missing values passes the strict mode whole."""
    path = t.scratch()
    csv.export_csv(t.part.select(*[F.col(f"p_{c}").alias(n) for c, n in (("partkey", "Key"), ("name", "Name"), ("size", "Size"), ("retailprice", "Price"))]), path)
    return csv.import_csv(t.spark, path, keys=["key"], class_name="Part", na="error")[0]


@query(
    "A4_import_csv_dates",
    """select 'Order/' || o_orderkey as id, o_orderkey as key, o_orderdate::date as day, o_orderdate::timestamp as moment,
         'P' || (o_orderkey % 90) || 'DT6H' as lasts, (o_orderkey::decimal(38, 10) + 1000000000000000000.25)::decimal(38, 10) as exact from orders""",
)
def import_csv_dates(t: Tables) -> DataFrame:
    """Dates, moments, durations and numbers that no double holds keep their datatypes."""
    path = t.scratch()
    at = F.col("o_orderdate").cast("timestamp_ntz")
    lasts = F.concat(F.lit("P"), (F.col("o_orderkey") % 90).cast("string"), F.lit("DT6H"))
    exact = F.col("o_orderkey").cast("decimal(28,2)") + F.lit("1000000000000000000.25").cast("decimal(28,2)")
    csv.export_csv(
        t.orders.select(
            F.col("o_orderkey").alias("Key"), at.cast("date").cast("string").alias("Day"), at.cast("string").alias("Moment"),
            lasts.alias("Lasts"), exact.cast("string").alias("Exact"),
        ),
        path,
    )
    table, found = csv.import_csv(t.spark, path, keys=["key"], class_name="Order", na="error")
    kinds = {p.name: p.range for p in found.props}
    expected = {"key": "xsd:integer", "day": "xsd:date", "moment": "xsd:dateTime", "lasts": "xsd:duration", "exact": "xsd:decimal"}
    if kinds != expected:
        raise ValueError(f"inferred {kinds}")
    return table


def _flatten_sql(depth: int) -> str:
    cols = ['o.id as "Document id"', "o.status", "o.totalprice", "o.orderdate", "o.priority"]
    joins = f"from {class_sql('Order')} o left join {class_sql('Customer')} c on c.id = o.customer"
    cols += [f'c."{n}" as "customer.{n}"' for n in ("name", "acctbal", "segment")]
    if depth == 1:
        cols.append('c.nation as "customer.nation"')
    if depth >= 2:
        joins += f" left join {class_sql('Nation')} n on n.id = c.nation"
        cols.append('n.name as "customer.nation.name"')
        if depth == 2:
            cols.append('n.region as "customer.nation.region"')
    if depth >= 3:
        joins += f" left join {class_sql('Region')} r on r.id = n.region"
        cols.append('r.name as "customer.nation.region.name"')
    return f"select {', '.join(cols)} {joins}"


def _flatten(t: Tables, depth: int) -> DataFrame:
    g = graph(t, "Region", "Nation", "Customer", "Order")
    return flatten.flatten_documents(g.tables["Order"], g.schema, "Order", g.tables, depth)


@query("A5_flatten_depth_1", _flatten_sql(1))
def flatten_depth_1(t: Tables) -> DataFrame:
    return _flatten(t, 1)


@query("A5_flatten_depth_2", _flatten_sql(2))
def flatten_depth_2(t: Tables) -> DataFrame:
    return _flatten(t, 2)


@query("A5_flatten_depth_3", _flatten_sql(3))
def flatten_depth_3(t: Tables) -> DataFrame:
    return _flatten(t, 3)


@query(
    "A5_export_csv",
    f"""select o.id as doc, c.name as customer, o.totalprice as price from {class_sql('Order')} o
        join {class_sql('Customer')} c on c.id = o.customer""",
)
def export_csv(t: Tables) -> DataFrame:
    path = t.scratch()
    csv.export_csv(_flatten(t, 2), path)
    wanted = [
        csv.as_("Document id", "v:doc"), csv.as_("customer.name", "v:customer"), csv.as_("totalprice", "v:price", "xsd:double"),
    ]
    return csv.get(t.spark, wanted, csv.file(path))


@query("A6_ntriples_round_trip", f"select * from {facts_sql('Customer', 'Part')}")
def ntriples_round_trip(t: Tables) -> DataFrame:
    path = t.scratch()
    triples.write_triples(graph(t, "Customer", "Part").quads(), path)
    return triples.read_triples(t.spark, path).select(*FACTS)


@query(
    "A6_insert_triples",
    f"select distinct * from (select * from {facts_sql('Supplier', 'Nation')} union all select * from {facts_sql('Nation', 'Region')})",
)
def insert_triples(t: Tables) -> DataFrame:
    old, new = graph(t, "Supplier", "Nation").quads(), graph(t, "Nation", "Region").quads()
    return triples.insert_triples(old, new).select(*FACTS)


@query("A6_update_triples", f"select * from {facts_sql('Part')}")
def update_triples(t: Tables) -> DataFrame:
    old, new = graph(t, "Supplier").quads(), graph(t, "Part").quads()
    return triples.update_triples(old, new).select(*FACTS)


@query(
    "A7_documents_by_type_page",
    f"select * from {class_sql('Order')} order by id limit 50 offset 100",
)
def documents_by_type_page(t: Tables) -> DataFrame:
    return docs.documents_by_type(class_table(t, "Order"), skip=100, count=50)


def json_sql(cls: str, alias: str = "x") -> str:
    names = ["id", *[p.name for p in views.SCHEMA.properties(cls).values()]]
    return "json_object(" + ", ".join(f"'{n}', {alias}.\"{n}\"" for n in names) + ")::varchar"


@query(
    "A7_all_documents",
    " union all ".join(
        f"select id, '{cls}' as type, {json_sql(cls)} as body from {class_sql(cls)} x" for cls in ("Customer", "Supplier", "Part")
    ),
)
def all_documents(t: Tables) -> DataFrame:
    return docs.all_documents(graph(t, "Customer", "Supplier", "Part").tables)


@query(
    "A8_query_document",
    f"select * from {class_sql('Customer')} where segment = 'BUILDING' and nation = 'Nation/3'",
)
def query_document(t: Tables) -> DataFrame:
    template = docs.parse_template(views.SCHEMA, "Customer", ["segment=BUILDING", "nation=Nation/3"])
    return docs.query_document(class_table(t, "Customer"), template)


@query("A8_get_document", f"select * from {class_sql('Customer')} where id = 'Customer/42'")
def get_document(t: Tables) -> DataFrame:
    return docs.get_document(class_table(t, "Customer"), "Customer/42")


BEFORE_DOCS = views.order_documents_sql("orders")
AFTER_DOCS = views.order_documents_sql(views.ORDERS_AFTER_SQL)


def _versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    return class_table(t, "Order"), views.order_documents(views.orders_after(t))


@query(
    "A9_insert_document",
    f"select * from {BEFORE_DOCS} union all select * from {AFTER_DOCS} a where a.id not in (select id from {BEFORE_DOCS})",
)
def insert_document(t: Tables) -> DataFrame:
    before, after = _versions(t)
    return docs.insert_document(before, after)


@query(
    "A10_update_document",
    f"select * from {AFTER_DOCS} union all select * from {BEFORE_DOCS} b where b.id not in (select id from {AFTER_DOCS})",
)
def update_document(t: Tables) -> DataFrame:
    before, after = _versions(t)
    return docs.update_document(before, after)


@query(
    "A10_replace_document",
    f"""select a.* from {AFTER_DOCS} a where a.id in (select id from {BEFORE_DOCS})
        union all select * from {BEFORE_DOCS} b where b.id not in (select id from {AFTER_DOCS})""",
)
def replace_document(t: Tables) -> DataFrame:
    before, after = _versions(t)
    return docs.replace_document(before, after)


@query(
    "A10_replace_missing_ids",
    f"select id from {AFTER_DOCS} a where a.id not in (select id from {BEFORE_DOCS})",
)
def replace_missing_ids(t: Tables) -> DataFrame:
    before, after = _versions(t)
    return docs.missing_ids(before, after)


@query("A10_delete_document", f"select * from {BEFORE_DOCS} b where b.id not in (select id from {AFTER_DOCS})")
def delete_document(t: Tables) -> DataFrame:
    before, after = _versions(t)
    return docs.delete_document(before, after)


@query("A11_triplify", f"select * from {facts_sql('Customer', 'Order')}")
def triplify(t: Tables) -> DataFrame:
    return graph(t, "Customer", "Order").quads().select(*FACTS)


@query(
    "A11_triplify_sets_and_lists",
    """with w as (select p_partkey, string_split(p_name, ' ') as words from part),
            e as (select p_partkey, words, unnest(words) as word, generate_subscripts(words, 1) - 1 as i from w)
       select distinct 'Part/' || p_partkey as s, 'tag' as p, word as o from e
       union all select 'Part/' || p_partkey, 'rdf:type', 'Part' from w
       union all select 'Part/' || p_partkey, 'words', 'Part/' || p_partkey || '/words/0' from w
       union all select 'Part/' || p_partkey || '/words/' || i, 'rdf:type', 'rdf:List' from e
       union all select 'Part/' || p_partkey || '/words/' || i, 'rdf:first', word from e
       union all select 'Part/' || p_partkey || '/words/' || i, 'rdf:rest',
         case when i + 1 < len(words) then 'Part/' || p_partkey || '/words/' || (i + 1) else 'rdf:nil' end from e""",
)
def triplify_sets_and_lists(t: Tables) -> DataFrame:
    from tripleframe.model import ClassDef, Prop, Schema

    schema = Schema([ClassDef("Part", (Prop("tag", "xsd:string", "set"), Prop("words", "xsd:string", "list")))])
    words = F.split("p_name", " ")
    part = t.part.select(F.concat(F.lit("Part/"), F.col("p_partkey").cast("string")).alias("id"), words.alias("tag"), words.alias("words"))
    facts = docs.triplify(part, schema, "Part").unionByName(docs.list_facts(part, "words"))
    return facts.select("s", "p", "o")


@query("A12_assemble_documents", f"select * from {class_sql('Order')}")
def assemble_documents(t: Tables) -> DataFrame:
    return docs.assemble_documents(graph(t, "Order", "Customer").quads(), views.SCHEMA, "Order")


_NESTED_SQL = """(select 'Order/' || o_orderkey as id, {'status': o_orderstatus, 'price': o_totalprice} as state,
    list_sort(list_distinct([o_orderstatus, substr(o_orderpriority, 1, 1)])) as tags,
    [o_orderpriority, o_orderstatus, o_orderpriority] as steps from orders)"""


@query("A12_assemble_nested", f"""select id, state.status as status, state.price as price, array_to_string(tags, '|') as tags,
       array_to_string(steps, '|') as steps from {_NESTED_SQL}""")
def assemble_nested(t: Tables) -> DataFrame:
    """Documents with a nested document, a set and a list become facts, and documents again."""
    from tripleframe.model import ClassDef, Prop, Schema

    schema = Schema([
        ClassDef("Order", (Prop("state", "State"), Prop("tags", "xsd:string", "set"), Prop("steps", "xsd:string", "list"))),
        ClassDef("State", (Prop("status", "xsd:string"), Prop("price", "xsd:double")), subdocument=True),
    ])
    table = t.orders.select(
        F.concat(F.lit("Order/"), F.col("o_orderkey").cast("string")).alias("id"),
        F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")).alias("state"),
        F.array("o_orderstatus", F.substring("o_orderpriority", 1, 1)).alias("tags"),
        F.array("o_orderpriority", "o_orderstatus", "o_orderpriority").alias("steps"),
    )
    facts = docs.triplify(table, schema, "Order").unionByName(docs.list_facts(table, "steps"))
    back = docs.assemble_documents(facts, schema, "Order")
    return back.select("id", "state.status", "state.price", F.array_join("tags", "|").alias("tags"), F.array_join("steps", "|").alias("steps"))


@query(
    "A12_assemble_collections",
    """with l as (select 'Order/' || l_orderkey as id, l_linenumber as linenumber, l_quantity as quantity, l_returnflag as f,
              l_linestatus as s, l_discount as d, l_tax as t, l_suppkey as supplier from lineitem),
            p as (select id, count(distinct supplier) as parties, max('Supplier/' || supplier) as last_party from l group by id)
       select l.id, row_number() over (partition by l.id order by linenumber, quantity, f, s, d, t) - 1 as pos, linenumber, quantity,
         case when f < s then f || '|' || s when f > s then s || '|' || f else f end as flags,
         2 as charges, case when d > 0 then d end as discount, t as tax, parties, last_party
       from l join p on l.id = p.id""",
)
def assemble_collections(t: Tables) -> DataFrame:
    """Orders with a list of line documents, each with a set and a list of documents, become facts, and documents again."""
    from tripleframe.model import ClassDef, Prop, Schema

    schema = Schema([
        ClassDef("Order", (Prop("lines", "Line", "list"), Prop("parties", "Party", "set"))),
        ClassDef(
            "Line",
            (Prop("linenumber", "xsd:int"), Prop("quantity", "xsd:double"), Prop("flags", "xsd:string", "set"), Prop("charges", "Charge", "list")),
            subdocument=True,
        ),
        ClassDef("Charge", (Prop("name", "xsd:string"), Prop("rate", "xsd:double")), subdocument=True),
        ClassDef("Party", (Prop("supplier", "Supplier"),), subdocument=True),
    ])
    row = F.struct("l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_discount", "l_tax")
    party = F.struct(F.concat(F.lit("Supplier/"), F.col("l_suppkey").cast("string")).alias("supplier"))
    grouped = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(row)).alias("lines"), F.collect_list(party).alias("parties"))
    charge = lambda name, rate: F.struct(F.lit(name).alias("name"), rate.alias("rate"))
    lines = F.transform(
        "lines",
        lambda x: F.struct(
            x["l_linenumber"].alias("linenumber"),
            x["l_quantity"].alias("quantity"),
            F.array(x["l_returnflag"], x["l_linestatus"]).alias("flags"),
            F.array(F.when(x["l_discount"] > 0, charge("discount", x["l_discount"])), charge("tax", x["l_tax"])).alias("charges"),
        ),
    )
    table = grouped.select(F.concat(F.lit("Order/"), F.col("l_orderkey").cast("string")).alias("id"), lines.alias("lines"), "parties")
    # The facts are read for the documents and for the lists: written once, not derived each time.
    facts = cut(docs.triplify(table, schema, "Order", lists=True))
    back = docs.assemble_documents(facts, schema, "Order")
    each = back.select("id", "parties", F.posexplode("lines").alias("pos", "line"))
    return each.select(
        "id", "pos", "line.linenumber", "line.quantity", F.array_join("line.flags", "|").alias("flags"),
        F.size("line.charges").alias("charges"), F.col("line.charges")[0]["rate"].alias("discount"), F.col("line.charges")[1]["rate"].alias("tax"),
        F.size("parties").alias("parties"), F.element_at("parties", -1)["supplier"].alias("last_party"),
    )


@query(
    "A7_unfold",
    """select 'Order/' || o_orderkey as id, 'Customer/' || o_custkey as customer, c_name as customer_name, 'Nation/' || c_nationkey as nation,
         n_name as nation_name, r_name as region_name
       from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
)
def unfold(t: Tables) -> DataFrame:
    """Orders with their customers, these with their nations, these with their regions."""
    g = graph(t, "Order", "Customer", "Nation", "Region")
    whole = docs.unfold(g.tables, g.schema, "Order", depth=3)
    customer, nation = F.col("customer"), F.col("customer.nation")
    return whole.select(
        "id", customer["id"].alias("customer"), customer["name"].alias("customer_name"), nation["id"].alias("nation"),
        nation["name"].alias("nation_name"), nation["region"]["name"].alias("region_name"),
    )


@query(
    "A7_all_documents_prefixed",
    """with docs as (
         select 'd:Customer/' || c_custkey as id, 'Customer' as type,
           json_object('id', 'd:Customer/' || c_custkey, 'name', c_name, 'nation', 'n:' || c_nationkey, 'acctbal', c_acctbal, 'segment', c_mktsegment)::varchar as body
         from customer
         union all
         select 'd:Supplier/' || s_suppkey, 'Supplier',
           json_object('id', 'd:Supplier/' || s_suppkey, 'name', s_name, 'nation', 'n:' || s_nationkey, 'acctbal', s_acctbal)::varchar
         from supplier)
       select * from docs""",
)
def all_documents_prefixed(t: Tables) -> DataFrame:
    """Documents under full ids, scanned as prefixed names; the longest namespace wins."""
    base = "https://data.example/"
    g = graph(t, "Customer", "Supplier")
    full = {cls: docs.with_prefixes(df, g.schema, cls, {"@base": base}, prefixed=False) for cls, df in g.tables.items()}
    return docs.all_documents(full, schema=g.schema, prefixes={"d": base, "n": f"{base}Nation/"})


@query("A9_insert_conflicts", """select 'Customer/' || c_custkey as id, 'exists' as conflict from customer where c_custkey % 3 = 0 and c_custkey % 2 = 0""")
def insert_conflicts(t: Tables) -> DataFrame:
    table = class_table(t, "Customer")
    key = F.substring_index("id", "/", -1).cast("bigint")
    return docs.insert_conflicts(table.where(key % 2 == 0), table.where(key % 3 == 0))


@query("A9_full_replace", f"select * from {class_sql('Customer')} where segment = 'BUILDING'")
def full_replace(t: Tables) -> DataFrame:
    table = class_table(t, "Customer")
    return docs.insert_document(table, table.where("segment = 'BUILDING'"), full_replace=True)


@query("A8_has_doc", "select count(*) > 0 as held from customer where c_custkey = 42")
def has_doc(t: Tables) -> DataFrame:
    held = docs.has_doc(class_table(t, "Customer"), "Customer/42")
    return t.spark.range(1).select(F.lit(held).alias("held"))


@query(
    "A12_read_document",
    f"select x.id as doc, {json_sql('Customer')} as body from {class_sql('Customer')} x where x.segment = 'MACHINERY'",
)
def read_document(t: Tables) -> DataFrame:
    g = graph(t, "Customer")
    bound = match.triple(g, "v:doc", "segment", "MACHINERY")
    return docs.read_document(bound, "doc", g.tables["Customer"], "body")


@query("A13_json_lines_round_trip", "select doc_id, lang, source, n_chars, md5(text) as digest from documents")
def json_lines_round_trip(t: Tables) -> DataFrame:
    path = t.scratch()
    json_lines.write_documents(t.documents, path)
    back = json_lines.read_documents(t.spark, path, t.documents.schema)
    kept = back.where(F.col(json_lines.CORRUPT).isNull())
    return kept.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("digest"))


# Pattern scans --------------------------------------------------------------------------------------


@query("B1_triple", "select 'Customer/' || c_custkey as customer, 'Nation/' || c_nationkey as nation from customer")
def triple(t: Tables) -> DataFrame:
    return match.triple(graph(t, "Customer"), "v:customer", "nation", "v:nation")


@query("B1_triple_constant_object", "select 'Order/' || o_orderkey as doc from orders where o_orderstatus = 'F'")
def triple_constant_object(t: Tables) -> DataFrame:
    return match.triple(graph(t, "Order"), "v:doc", "status", "F")


@query(
    "B1_triple_repeated_variable",
    f"select id as node from {views.HOPS_SQL} where id = jump",
)
def triple_repeated_variable(t: Tables) -> DataFrame:
    return match.triple(views.supplier_hops(t), "v:node", "jump", "v:node")


@query(
    "B1_triple_opt",
    f"""select c.id as customer, o.id as doc from {class_sql('Customer')} c
        left join {class_sql('Order')} o on o.customer = c.id""",
)
def triple_opt(t: Tables) -> DataFrame:
    g = graph(t, "Customer", "Order")
    customers = match.triple(g, "v:customer", "rdf:type", "Customer")
    return match.triple(g, "v:doc", "customer", "v:customer", opt=customers).select("customer", "doc")


def _two_graphs(t: Tables) -> Graph:
    """Suppliers in the instance graph, customers in a second one."""
    facts = docs.triplify(class_table(t, "Customer"), views.SCHEMA, "Customer", "archive")
    return Graph({"Supplier": class_table(t, "Supplier")}, views.SCHEMA, facts)


@query("B2_quad", f"select id as doc, nation from {class_sql('Customer')}")
def quad(t: Tables) -> DataFrame:
    return match.quad(_two_graphs(t), "v:doc", "nation", "v:nation", "archive")


@query(
    "B2_quad_graph_variable",
    f"""select g, count(*) as n from (select 'archive' as g from {class_sql('Customer')}
        union all select 'instance' from {class_sql('Supplier')}) group by g""",
)
def quad_graph_variable(t: Tables) -> DataFrame:
    rows = match.quad(_two_graphs(t), "v:doc", "nation", "v:nation", "v:g")
    return rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"))


@query("B3_star", f"select p as pred, count(*) as n from {facts_sql()} group by p")
def star(t: Tables) -> DataFrame:
    rows = match.star(graph(t))
    return rows.groupBy(F.col("Predicate").alias("pred")).agg(F.count(F.lit(1)).alias("n"))


@query("B3_all", f"select s as \"Subject\", p as \"Predicate\" from {facts_sql('Customer', 'Supplier')} where o = 'Nation/7'")
def all_facts(t: Tables) -> DataFrame:
    return match.all_facts(graph(t, "Customer", "Supplier"), obj="Nation/7")


def order_changes(t: Tables) -> DataFrame:
    """Changes of facts between the two versions of the orders."""
    before, after = _versions(t)
    return changes_between(docs.triplify(before, views.SCHEMA, "Order"), docs.triplify(after, views.SCHEMA, "Order"))


FACTS_BEFORE = facts_sql("Order", table={"Order": BEFORE_DOCS})
FACTS_AFTER = facts_sql("Order", table={"Order": AFTER_DOCS})


@query("B4_added_triple", f"select s, p, o from (select * from {FACTS_AFTER} except select * from {FACTS_BEFORE})")
def added_triple(t: Tables) -> DataFrame:
    return match.added(order_changes(t), "v:s", "v:p", "v:o")


@query(
    "B4_added_quad",
    f"select s, o from (select * from {FACTS_AFTER} except select * from {FACTS_BEFORE}) where p = 'status'",
)
def added_quad(t: Tables) -> DataFrame:
    return match.added(order_changes(t), "v:s", "status", "v:o", "instance")


@query("B5_removed_triple", f"select s, p, o from (select * from {FACTS_BEFORE} except select * from {FACTS_AFTER})")
def removed_triple(t: Tables) -> DataFrame:
    return match.removed(order_changes(t), "v:s", "v:p", "v:o")


@query(
    "B5_removed_quad",
    f"select s, o from (select * from {FACTS_BEFORE} except select * from {FACTS_AFTER}) where p = 'status'",
)
def removed_quad(t: Tables) -> DataFrame:
    return match.removed(order_changes(t), "v:s", "status", "v:o", "instance")


@query("B6_triple_slice", f"select id as item, quantity as q from {class_sql('Lineitem')} where quantity >= 10 and quantity < 20")
def triple_slice(t: Tables) -> DataFrame:
    return match.triple_slice(graph(t, "Lineitem"), "v:item", "quantity", "v:q", 10, 20)


_AMOUNTS_SQL = """(select 'Part/' || p_partkey as s, p_size::double as o from part union all
    select 'Supplier/' || s_suppkey, s_acctbal from supplier union all select 'Order/' || o_orderkey, o_orderkey::double from orders)"""


def _amounts(t: Tables) -> Graph:
    """One property that three classes hold in three numeric types, and a fourth as text."""
    def named(cls: str, key: str) -> Column:
        return F.concat(F.lit(f"{cls}/"), F.col(key).cast("string")).alias("id")

    return Graph({
        "Part": t.part.select(named("Part", "p_partkey"), F.col("p_size").cast("int").alias("amount")),
        "Supplier": t.supplier.select(named("Supplier", "s_suppkey"), F.col("s_acctbal").cast("double").alias("amount")),
        "Order": t.orders.select(named("Order", "o_orderkey"), F.col("o_orderkey").cast("bigint").alias("amount")),
        "Customer": t.customer.select(named("Customer", "c_custkey"), F.col("c_mktsegment").alias("amount")),
    })


@query("B6_mixed_types", f"select s, o from {_AMOUNTS_SQL} where o >= 5 and o < 40")
def slice_mixed_types(t: Tables) -> DataFrame:
    return match.triple_slice(_amounts(t), "v:s", "amount", "v:o", 5, 40)


@query("B1_mixed_constant", f"select s from {_AMOUNTS_SQL} where o = 7")
def mixed_constant(t: Tables) -> DataFrame:
    return match.triple(_amounts(t), "v:s", "amount", 7)


@query(
    "B8_mixed_types",
    """select * from (select s, o, lead(o) over (partition by s order by o) as n from (
         select distinct 'Nation/' || s_nationkey as s, s_suppkey::double as o from supplier union
         select distinct 'Nation/' || c_nationkey, c_acctbal from customer)) where n is not null""",
)
def next_mixed_types(t: Tables) -> DataFrame:
    node = lambda c: F.concat(F.lit("Nation/"), F.col(c).cast("string")).alias("id")
    g = Graph({
        "Supplier": t.supplier.select(node("s_nationkey"), F.col("s_suppkey").cast("bigint").alias("value")),
        "Customer": t.customer.select(node("c_nationkey"), F.col("c_acctbal").cast("double").alias("value")),
    })
    return match.triple_next(g, "v:s", "value", "v:o", "v:n")


@query(
    "B6_date_bounds",
    "select 'Order/' || o_orderkey as doc, o_orderdate as d from orders where o_orderdate >= timestamp '1995-01-01' and o_orderdate < timestamp '1995-03-01'",
)
def slice_date_bounds(t: Tables) -> DataFrame:
    return match.triple_slice(graph(t, "Order"), "v:doc", "orderdate", "v:d", date("1995-01-01"), date("1995-03-01"))


@query(
    "B6_quad_slice",
    f"select id as doc, acctbal as b from {class_sql('Customer')} where acctbal >= 0 and acctbal < 1000",
)
def quad_slice(t: Tables) -> DataFrame:
    return match.quad_slice(_two_graphs(t), "v:doc", "acctbal", "v:b", 0.0, 1000.0, "archive")


@query(
    "B7_triple_slice_rev",
    f"""select id as doc, totalprice as price from {class_sql('Order')} where totalprice >= 100000 and totalprice < 400000
        order by totalprice desc, id limit 25""",
)
def triple_slice_rev(t: Tables) -> DataFrame:
    return match.triple_slice_rev(graph(t, "Order"), "v:doc", "totalprice", "v:price", 100000.0, 400000.0).limit(25)


@query(
    "B7_quad_slice_rev",
    f"select id as doc, acctbal as b from {class_sql('Customer')} where acctbal >= 0 and acctbal < 1000 order by acctbal desc, id limit 25",
)
def quad_slice_rev(t: Tables) -> DataFrame:
    return match.quad_slice_rev(_two_graphs(t), "v:doc", "acctbal", "v:b", 0.0, 1000.0, "archive").limit(25)


def _visits(t: Tables) -> Graph:
    """What each user did and when, as a multi-valued property."""
    user = F.concat(F.lit("User/"), F.col("user_id").cast("string"))
    return Graph({"Visit": t.events.select(user.alias("id"), F.col("ts").alias("seen"))})


VISITS_SQL = "(select distinct 'User/' || user_id as u, ts from events)"


@query(
    "B8_triple_next",
    f"""select * from (select u as "user", ts, lead(ts) over (partition by u order by ts) as "next" from {VISITS_SQL})
        where "next" is not null""",
)
def triple_next(t: Tables) -> DataFrame:
    return match.triple_next(_visits(t), "v:user", "seen", "v:ts", "v:next")


@query(
    "B8_triple_next_bound_object",
    f"select u as \"user\", min(ts) as \"next\" from {VISITS_SQL} where ts > timestamp '2024-01-15 12:00:00' group by u",
)
def triple_next_bound_object(t: Tables) -> DataFrame:
    return match.triple_next(_visits(t), "v:user", "seen", datetime("2024-01-15T12:00:00Z"), "v:next")


@query(
    "B9_triple_previous",
    f"""select * from (select u as "user", ts, lag(ts) over (partition by u order by ts) as "previous" from {VISITS_SQL})
        where "previous" is not null""",
)
def triple_previous(t: Tables) -> DataFrame:
    return match.triple_previous(_visits(t), "v:user", "seen", "v:ts", "v:previous")


@query(
    "B9_triple_previous_bound_object",
    f"select u as \"user\", max(ts) as \"previous\" from {VISITS_SQL} where ts < timestamp '2024-01-15 12:00:00' group by u",
)
def triple_previous_bound_object(t: Tables) -> DataFrame:
    return match.triple_previous(_visits(t), "v:user", "seen", datetime("2024-01-15T12:00:00Z"), "v:previous")


REFERENCES_SQL = "(select event_id, 'User/' || user_id as u, ts + interval 6 hour as \"at\" from events)"


def _references(t: Tables) -> DataFrame:
    """For each event its user and the moment six hours later, which need not be one of the user's."""
    user = F.concat(F.lit("User/"), F.col("user_id").cast("string"))
    return t.events.select("event_id", user.alias("user"), F.expr("ts + interval 6 hours").alias("at"))


@query(
    "B8_next_of_solutions",
    f"""select event_id, r.u as "user", r."at", v.ts as "next" from {REFERENCES_SQL} r
        asof join {VISITS_SQL} v on r.u = v.u and r."at" < v.ts""",
)
def next_of_solutions(t: Tables) -> DataFrame:
    return match.next_of(_references(t), _visits(t), "v:user", "seen", "v:at", "v:next")


@query(
    "B9_previous_of_solutions",
    f"""select event_id, r.u as "user", r."at", v.ts as "previous" from {REFERENCES_SQL} r
        asof join {VISITS_SQL} v on r.u = v.u and r."at" > v.ts""",
)
def previous_of_solutions(t: Tables) -> DataFrame:
    return match.previous_of(_references(t), _visits(t), "v:user", "seen", "v:at", "v:previous")


@query(
    "B8_quad_next",
    f"""select * from (select 'User/' || user_id as "user", value, lead(value) over (partition by user_id order by value) as "next"
        from (select distinct user_id, value from events)) where "next" is not null""",
)
def quad_next(t: Tables) -> DataFrame:
    user = F.concat(F.lit("User/"), F.col("user_id").cast("string"))
    g = Graph({"Visit": t.events.select(user.alias("id"), F.col("value").alias("spent"))})
    return match.quad_next(g, "v:user", "spent", "v:value", "v:next", "instance")


@query(
    "B9_quad_previous",
    """select * from (select 'User/' || user_id as "user", value, lag(value) over (partition by user_id order by value) as "previous"
        from (select distinct user_id, value from events)) where "previous" is not null""",
)
def quad_previous(t: Tables) -> DataFrame:
    user = F.concat(F.lit("User/"), F.col("user_id").cast("string"))
    g = Graph({"Visit": t.events.select(user.alias("id"), F.col("value").alias("spent"))})
    return match.quad_previous(g, "v:user", "spent", "v:value", "v:previous", "instance")


@query("B10_into", f"select 'copy' as graph, s, p, o from {facts_sql('Customer')}")
def into(t: Tables) -> DataFrame:
    """The facts of one graph written into another."""
    rows = match.star(graph(t, "Customer"))
    changes = update.into(update.add_triple(rows, "v:Subject", "v:Predicate", "v:Object"), "copy")
    return update.apply_changes(docs.triplify(class_table(t, "Supplier"), views.SCHEMA, "Supplier"), changes).where(
        "graph = 'copy'"
    ).select("graph", "s", "p", "o")


@query(
    "B10_using",
    f"select p as pred, count(*) as n from {facts_sql('Customer')} group by p",
)
def using(t: Tables) -> DataFrame:
    rows = match.star(_two_graphs(t).using(graph="archive"), None, Var("s"), Var("pred"), Var("o"))
    return c.select(rows, "v:pred").groupBy("pred").agg(F.count(F.lit(1)).alias("n"))
