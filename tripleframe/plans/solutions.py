"""Queries over binding frames: projection, filters, joins, aggregation, order, lists and sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleframe.functions import lists, text
from tripleframe.model import ClassDef, Schema
from tripleframe.operators import agg, match
from tripleframe.operators import combine as c
from tripleframe.plans import views
from tripleframe.plans.registry import Tables, query
from tripleframe.plans.views import class_sql, class_table, facts_sql, graph

MONEY = "decimal(12,2)"


def joined(col: str) -> Column:
    """A list as text."""
    return F.array_join(col, "|")


# Projection, filters, predicates ----------------------------------------------------------------------


@query("C1_select", "select p_brand as brand from part")
def select(t: Tables) -> DataFrame:
    return c.select(match.triple(graph(t, "Part"), "v:part", "brand", "v:brand"), "v:brand")


@query("C1_select_empty", "select count(*) as n from customer")
def select_empty(t: Tables) -> DataFrame:
    """A selection without variables keeps one empty row per solution."""
    return agg.count(c.select(match.triple(graph(t, "Customer"), "v:customer", "nation", "v:nation")), "v:n")


@query(
    "C2_distinct",
    """select segment, nation, customer from (select c_mktsegment as segment, 'Nation/' || c_nationkey as nation,
         'Customer/' || c_custkey as customer, row_number() over (partition by c_mktsegment, c_nationkey order by 'Customer/' || c_custkey) as n
       from customer) where n = 1""",
)
def distinct(t: Tables) -> DataFrame:
    df = class_table(t, "Customer").select("segment", "nation", F.col("id").alias("customer"))
    return c.distinct(df, "v:segment", "v:nation")


@query("C2_distinct_only", "select distinct c_mktsegment as segment, c_nationkey as nation from customer")
def distinct_only(t: Tables) -> DataFrame:
    return c.distinct(t.customer.select(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")))


@query(
    "C3_eq",
    "select o_orderkey as doc, 'F' as wanted, o_totalprice as price, o_totalprice as same from orders where o_orderstatus = 'F'",
)
def eq(t: Tables) -> DataFrame:
    df = t.orders.select(F.col("o_orderkey").alias("doc"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    df = c.eq(df, "v:wanted", "F")
    df = c.eq(c.eq(df, "v:status", "v:wanted"), "v:same", "v:price")
    return c.select(df, "v:doc", "v:wanted", "v:price", "v:same")


@query(
    "C4_compare",
    """select o_orderkey, o_totalprice from orders
       where (o_totalprice < 1000 or o_totalprice > 490000) and o_totalprice <= 499000 and o_totalprice >= 900""",
)
def compare(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", "o_totalprice")
    ends = c.or_(c.less(df, "v:o_totalprice", 1000), c.greater(df, "v:o_totalprice", 490000))
    return c.gte(c.lte(ends, "v:o_totalprice", 499000), "v:o_totalprice", 900)


@query("C5_in_range", "select l_orderkey, l_quantity from lineitem where l_quantity >= 5 and l_quantity < 8")
def in_range(t: Tables) -> DataFrame:
    return c.in_range(t.lineitem.select("l_orderkey", "l_quantity"), "v:l_quantity", 5, 8)


#: Classes of parts: a line is a kind of item, a size is a kind of line.
PART_CLASSES = Schema(
    [
        ClassDef("Item"),
        ClassDef("Sized", parents=("Item",)),
        ClassDef("Ranged", parents=("Item",)),
        ClassDef("SMALL", parents=("Sized",)),
        ClassDef("MEDIUM", parents=("Sized",)),
        ClassDef("LARGE", parents=("Sized",)),
        ClassDef("ECONOMY", parents=("Ranged",)),
        ClassDef("STANDARD", parents=("Ranged",)),
        ClassDef("PROMO", parents=("Ranged",)),
    ]
)
CLASSES_SQL = """(values ('Item','Item'), ('Sized','Sized'), ('Sized','Item'), ('Ranged','Ranged'), ('Ranged','Item'),
  ('SMALL','SMALL'), ('SMALL','Sized'), ('SMALL','Item'), ('MEDIUM','MEDIUM'), ('MEDIUM','Sized'), ('MEDIUM','Item'),
  ('LARGE','LARGE'), ('LARGE','Sized'), ('LARGE','Item'), ('ECONOMY','ECONOMY'), ('ECONOMY','Ranged'), ('ECONOMY','Item'),
  ('STANDARD','STANDARD'), ('STANDARD','Ranged'), ('STANDARD','Item'), ('PROMO','PROMO'), ('PROMO','Ranged'), ('PROMO','Item'))"""


@query("C6_isa", "select 'Part/' || p_partkey as part, p_brand as brand from part where p_type in ('SMALL', 'MEDIUM', 'LARGE')")
def isa(t: Tables) -> DataFrame:
    parts = class_table(t, "Part")
    types = parts.select(F.col("id").alias("s"), F.col("line").alias("o"))
    return c.isa(parts.select(F.col("id").alias("part"), "brand"), "v:part", "Sized", types, PART_CLASSES)


@query(
    "C7_subsumption",
    f"""select p_partkey as part, x.parent as kind from part join {CLASSES_SQL} x(child, parent) on x.child = p_type""",
)
def subsumption(t: Tables) -> DataFrame:
    parts = t.part.select(F.col("p_partkey").alias("part"), F.col("p_type").alias("line"))
    return c.select(c.subsumption(parts, "v:kind", "v:line", PART_CLASSES), "v:part", "v:kind")


@query("C8_type_of", f"select o_type as datatype, count(*) as n from {facts_sql()} where o_kind = 'data' group by 1")
def type_of(t: Tables) -> DataFrame:
    data = graph(t).quads().where("o_kind = 'data'")
    return data.groupBy(F.col("o_type").alias("datatype")).agg(F.count(F.lit(1)).alias("n"))


@query("C8_type_of_column", "select p_partkey as part, 'xsd:double' as datatype from part")
def type_of_column(t: Tables) -> DataFrame:
    df = t.part.select(F.col("p_partkey").alias("part"), "p_retailprice")
    return c.select(c.type_of(df, "v:p_retailprice", "v:datatype"), "v:part", "v:datatype")


@query(
    "C9_cast",
    "select p_partkey as part, p_size::bigint as number from part where p_type <> 'PROMO'",
)
def cast(t: Tables) -> DataFrame:
    words = F.when(F.col("p_type") == "PROMO", F.col("p_brand")).otherwise(F.col("p_size").cast("string"))
    df = t.part.select(F.col("p_partkey").alias("part"), words.alias("word"))
    return c.select(c.cast(df, "v:word", "xsd:integer", "v:number"), "v:part", "v:number")


@query("C10_member", "select p_partkey as part, unnest(string_split(p_name, ' ')) as word from part")
def member(t: Tables) -> DataFrame:
    df = t.part.select(F.col("p_partkey").alias("part"), text.split("v:p_name", " ").alias("words"))
    return c.select(c.member(df, "v:word", "v:words"), "v:part", "v:word")


@query(
    "C10_member_bound",
    "select part from (select p_partkey as part, unnest(string_split(p_name || ' ring', ' ')) as word from part) where word = 'ring'",
)
def member_bound(t: Tables) -> DataFrame:
    words = text.split(F.concat("p_name", F.lit(" ring")), " ")
    df = t.part.select(F.col("p_partkey").alias("part"), words.alias("words"))
    return c.select(c.member(df, "ring", "v:words"), "v:part")


@query("C11_set_member", "select p_partkey as part from part where list_contains(string_split(p_name, ' '), 'ring')")
def set_member(t: Tables) -> DataFrame:
    df = t.part.select(F.col("p_partkey").alias("part"), lists.list_to_set(text.split("v:p_name", " ")).alias("words"))
    return c.select(c.set_member(df, "ring", "v:words"), "v:part")


@query("C12_true", "select c_custkey as customer from customer")
def true(t: Tables) -> DataFrame:
    return c.and_(t.customer.select(F.col("c_custkey").alias("customer")), c.true(t.spark))


@query(
    "C13_like",
    """select p_partkey as part, 1 - levenshtein(p_brand, 'Brand#12')::double / greatest(length(p_brand), 8) as similarity from part""",
)
def like(t: Tables) -> DataFrame:
    df = t.part.select(F.col("p_partkey").alias("part"), F.col("p_brand").alias("brand"))
    return c.select(c.like(df, "v:brand", "Brand#12", "v:similarity"), "v:part", "v:similarity")


@query(
    "C13_like_hamming",
    """select p_partkey as part, hamming(substr(p_brand, 1, 7), 'Brand#1') + length(p_brand) - 7 as distance from part""",
)
def like_hamming(t: Tables) -> DataFrame:
    df = t.part.select(F.col("p_partkey").alias("part"), F.col("p_brand").alias("brand"))
    return c.select(c.like(df, "v:brand", "Brand#1", "v:distance", method="hamming"), "v:part", "v:distance")


@query(
    "C14_regexp",
    r"""select o_orderkey as doc, concat_ws('|', regexp_extract(o_orderpriority, '(\d)-([A-Z]+)', 0),
          regexp_extract(o_orderpriority, '(\d)-([A-Z]+)', 1), regexp_extract(o_orderpriority, '(\d)-([A-Z]+)', 2)) as found
        from orders where regexp_matches(o_orderpriority, '(\d)-([A-Z]+)')""",
)
def regexp(t: Tables) -> DataFrame:
    df = t.orders.select(F.col("o_orderkey").alias("doc"), "o_orderpriority")
    found = c.regexp(df, r"(\d)-([A-Z]+)", "v:o_orderpriority", "v:parts")
    return found.select("doc", joined("parts").alias("found"))


# Joins ------------------------------------------------------------------------------------------------


@query(
    "JN1_and",
    f"""select r.name as region, sum(o.totalprice::{MONEY})::double as revenue, count(*) as orders
        from {class_sql('Region')} r join {class_sql('Nation')} n on n.region = r.id
        join {class_sql('Customer')} c on c.nation = n.id join {class_sql('Order')} o on o.customer = c.id
        group by r.name order by revenue desc limit 5""",
)
def and_(t: Tables) -> DataFrame:
    """Revenue per region of the customers reached through order, customer, nation and region; the top five."""
    g = graph(t, "Region", "Nation", "Customer", "Order")
    solutions = c.and_(
        match.triple(g, "v:o", "customer", "v:c"),
        match.triple(g, "v:o", "totalprice", "v:price"),
        match.triple(g, "v:c", "nation", "v:n"),
        match.triple(g, "v:n", "region", "v:r"),
        match.triple(g.using("Region"), "v:r", "name", "v:region"),
    )
    priced = solutions.withColumn("price", F.col("price").cast(MONEY))
    by_region = priced.groupBy("region").agg(
        F.sum("price").cast("double").alias("revenue"), F.count(F.lit(1)).alias("orders")
    )
    return c.limit(c.order_by(by_region, "v:revenue", order="desc"), 5)


@query(
    "JN1_and_rows",
    """select 'Order/' || o_orderkey as doc, n_name as nation from orders join customer on c_custkey = o_custkey
       join nation on n_nationkey = c_nationkey""",
)
def and_rows(t: Tables) -> DataFrame:
    g = graph(t, "Nation", "Customer", "Order")
    return c.and_(
        match.triple(g, "v:doc", "customer", "v:c"),
        match.triple(g, "v:c", "nation", "v:n"),
        match.triple(g.using("Nation"), "v:n", "name", "v:nation"),
    ).select("doc", "nation")


@query(
    "JN2_theta_join",
    """select o_orderkey as doc, l_linenumber as line, l_shipdate as shipped from orders join lineitem on l_orderkey = o_orderkey
       where l_shipdate > o_orderdate""",
)
def theta_join(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_orderkey").alias("doc"), F.col("o_orderdate").alias("ordered"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("line"), F.col("l_shipdate").alias("shipped")
    )
    return c.select(c.greater(c.and_(orders, lines), "v:shipped", "v:ordered"), "v:doc", "v:line", "v:shipped")


def _months(t: Tables) -> DataFrame:
    """Calendar months in which there are orders."""
    first = F.trunc("o_orderdate", "MM").cast("date")
    months = t.orders.select(first.alias("m")).distinct()
    return months.select(
        F.date_format("m", "yyyy-MM").alias("month"),
        F.col("m").cast("timestamp_ntz").alias("opens"),
        F.add_months("m", 1).cast("timestamp_ntz").alias("closes"),
    )


MONTHS_SQL = """(select distinct strftime(date_trunc('month', o_orderdate), '%Y-%m') as month,
  date_trunc('month', o_orderdate)::timestamp as opens,
  (date_trunc('month', o_orderdate) + interval 1 month)::timestamp as closes from orders)"""


@query(
    "JN2_range_join",
    f"select l_orderkey as doc, l_linenumber as line, month from lineitem join {MONTHS_SQL} m on l_shipdate >= opens and l_shipdate < closes",
)
def range_join(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("line"), "l_shipdate")
    pairs = c.range_join(lines, _months(t), "l_shipdate", "opens", "closes")
    return c.select(pairs, "v:doc", "v:line", "v:month")


@query(
    "JN3_interval_join",
    f"""select o_orderkey as doc, month from orders join {MONTHS_SQL} m
        on o_orderdate < opens and o_orderdate + interval 30 day > opens and o_orderdate + interval 30 day < closes""",
)
def interval_join(t: Tables) -> DataFrame:
    windows = t.orders.select(
        F.col("o_orderkey").alias("doc"), F.col("o_orderdate").alias("x0"), F.expr("o_orderdate + interval 30 day").alias("x1")
    )
    pairs = c.interval_join(windows, _months(t), "overlaps", ("x0", "x1"), ("opens", "closes"))
    return c.select(pairs, "v:doc", "v:month")


@query(
    "JN3_interval_join_meets",
    f"select o_orderkey as doc, month from orders join {MONTHS_SQL} m on o_orderdate + interval 1 day = opens",
)
def interval_join_meets(t: Tables) -> DataFrame:
    windows = t.orders.select(
        F.col("o_orderkey").alias("doc"), F.col("o_orderdate").alias("x0"), F.expr("o_orderdate + interval 1 day").alias("x1")
    )
    pairs = c.interval_join(windows, _months(t), "meets", ("x0", "x1"), ("opens", "closes"))
    return c.select(pairs, "v:doc", "v:month")


_SPANS_SQL = f"""(select month as span, opens, closes from {MONTHS_SQL}
  union all select 'all', min(o_orderdate), max(o_orderdate) from orders
  union all select 'day ' || o_orderkey, o_orderdate, o_orderdate + interval 1 day from orders where o_orderstatus = 'P')"""


@query(
    "JN3_long_spans",
    f"""select span, count(*) as n, sum(l_orderkey) as keys from lineitem join {_SPANS_SQL} on l_shipdate >= opens and l_shipdate < closes
        group by span""",
)
def long_spans(t: Tables) -> DataFrame:
    """One span over all data beside months and single days."""
    lines = t.lineitem.select("l_orderkey", "l_shipdate")
    at = F.col("o_orderdate").cast("timestamp_ntz")
    every = t.orders.agg(F.min(at).alias("opens"), F.max(at).alias("closes")).select(F.lit("all").alias("span"), "opens", "closes")
    days = t.orders.where("o_orderstatus = 'P'").select(
        F.concat(F.lit("day "), F.col("o_orderkey").cast("string")).alias("span"), at.alias("opens"), (at + F.expr("interval 1 day")).alias("closes")
    )
    spans = _months(t).select(F.col("month").alias("span"), "opens", "closes").unionByName(every).unionByName(days)
    totals = c.range_totals(lines, spans, "l_shipdate", "opens", "closes", ["l_orderkey"])
    return totals.groupBy("span").agg(F.sum("n").alias("n"), F.sum("l_orderkey").alias("keys"))


#: Windows that start and end with months, and others: which hold of (a, b) against (m0, m1) for each relation.
_RELATION_SQL = {
    "starts": "a = m0 and b < m1", "started_by": "a = m0 and b > m1", "finishes": "b = m1 and a > m0", "finished_by": "b = m1 and a < m0",
    "equals": "a = m0 and b = m1", "during": "a > m0 and b < m1", "contains": "a < m0 and b > m1",
    "overlaps": "a < m0 and b > m0 and b < m1", "overlapped_by": "a > m0 and a < m1 and b > m1", "met_by": "a = m1",
}
_WINDOWS_SQL = f"""(select doc, a, case doc % 4 when 0 then date_trunc('month', a) + interval 1 month when 1 then a + interval 3 day else a + interval 40 day end as b
    from (select o_orderkey as doc, case when o_orderkey % 2 = 0 then date_trunc('month', o_orderdate) else o_orderdate end as a from orders))"""


def _relation_join(relation: str) -> None:
    @query(
        f"JN3_relation_{relation}",
        f"select doc, month from {_WINDOWS_SQL} join (select month, opens as m0, closes as m1 from {MONTHS_SQL} m) on {_RELATION_SQL[relation]}",
    )
    def run(t: Tables) -> DataFrame:
        begin = F.when(F.col("o_orderkey") % 2 == 0, F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")).otherwise(F.col("o_orderdate").cast("timestamp_ntz"))
        ends = F.expr("case doc % 4 when 0 then add_months(cast(date_trunc('month', a) as date), 1) when 1 then a + interval 3 day else a + interval 40 day end")
        windows = t.orders.select(F.col("o_orderkey").alias("doc"), begin.alias("a")).withColumn("b", ends.cast("timestamp_ntz"))
        pairs = c.interval_join(windows, _months(t), relation, ("a", "b"), ("opens", "closes"))
        return c.select(pairs, "v:doc", "v:month")


for _relation in _RELATION_SQL:
    _relation_join(_relation)


@query("C3_mixed", "select 0 as n")
def eq_mixed(t: Tables) -> DataFrame:
    """Text and numbers are never equal."""
    df = t.orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderkey").cast("string").alias("text"))
    return agg.count(c.eq(df, "v:key", "v:text"), "v:n")


@query(
    "JN4_opt",
    """select c_custkey as customer, o_orderkey as doc from customer
       left join (select * from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'P') on o_custkey = c_custkey""",
)
def opt(t: Tables) -> DataFrame:
    urgent = t.orders.where("o_orderpriority = '1-URGENT' and o_orderstatus = 'P'")
    return c.opt(
        t.customer.select(F.col("c_custkey").alias("customer")),
        urgent.select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("doc")),
    )


@query(
    "JN5_not",
    """select c_custkey as customer from customer where c_custkey not in
       (select o_custkey from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'P')""",
)
def not_(t: Tables) -> DataFrame:
    urgent = t.orders.where("o_orderpriority = '1-URGENT' and o_orderstatus = 'P'")
    return c.not_(t.customer.select(F.col("c_custkey").alias("customer")), urgent.select(F.col("o_custkey").alias("customer")))


@query(
    "JN6_semi",
    "select l_orderkey as doc, l_partkey as part from lineitem where l_orderkey in (select o_orderkey from orders where o_orderpriority = '1-URGENT')",
)
def semi(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("doc"), F.col("l_partkey").alias("part"))
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("doc"))
    return c.exists(lines, urgent)


@query(
    "JN7_or",
    """select c_custkey as customer, c_acctbal as balance, null as segment from customer where c_acctbal < 0
       union all select c_custkey, null, c_mktsegment from customer where c_mktsegment = 'BUILDING'""",
)
def or_(t: Tables) -> DataFrame:
    poor = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("customer"), F.col("c_acctbal").alias("balance"))
    build = t.customer.where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("customer"), F.col("c_mktsegment").alias("segment")
    )
    return c.or_(poor, build)


_LOOSE_SQL = """(select o_custkey as customer, o_orderkey as doc, o_orderstatus as status from orders where o_orderpriority = '1-URGENT'
  union all select o_custkey, o_orderkey, null from orders where o_orderpriority = '2-HIGH')"""


@query(
    "JN8_compatibility_join",
    f"""select a.customer, a.doc, b.status, b.n from {_LOOSE_SQL} a
        join (select o_custkey as customer, o_orderstatus as status, count(*) as n from orders group by 1, 2) b
        on a.customer = b.customer and (a.status = b.status or a.status is null)""",
)
def compatibility_join(t: Tables) -> DataFrame:
    """Orders with a status that may be unbound, joined to the statuses each customer has."""
    named = t.orders.select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("doc"), "o_orderstatus", "o_orderpriority")
    loose = c.or_(
        named.where("o_orderpriority = '1-URGENT'").select("customer", "doc", F.col("o_orderstatus").alias("status")),
        named.where("o_orderpriority = '2-HIGH'").select("customer", "doc"),
    )
    statuses = named.groupBy("customer", F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return c.and_(loose, statuses)


_TWO_LOOSE_SQL = """(select o_custkey as customer, {n}, case when o_orderpriority <> '1-URGENT' then o_orderstatus end as status,
  case when o_orderpriority <> '2-HIGH' then o_orderpriority end as priority from orders where {which})"""


@query(
    "JN8_two_masks",
    f"""select a.customer, coalesce(a.status, b.status) as status, coalesce(a.priority, b.priority) as priority, doc, other
        from {_TWO_LOOSE_SQL.format(n="o_orderkey as doc", which="o_orderkey % 2 = 0")} a
        join {_TWO_LOOSE_SQL.format(n="o_orderkey as other", which="o_orderkey % 2 = 1")} b on a.customer = b.customer
        and (a.status = b.status or a.status is null or b.status is null) and (a.priority = b.priority or a.priority is null or b.priority is null)""",
)
def two_masks(t: Tables) -> DataFrame:
    """Two variables that may be unbound on both sides."""

    def loose(number: str, rest: int) -> DataFrame:
        status = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderstatus"))
        priority = F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_orderpriority"))
        own = t.orders.where(F.col("o_orderkey") % 2 == rest)
        df = own.select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias(number), status.alias("status"), priority.alias("priority"))
        return c.mark_unbound(df, ["status", "priority"])

    return c.and_(loose("doc", 0), loose("other", 1)).select("customer", "status", "priority", "doc", "other")


# Aggregation ------------------------------------------------------------------------------------------


@query(
    "E1_group_rows",
    """select o_custkey as customer, row_number() over (partition by o_custkey order by o_orderkey) - 1 as pos, o_orderkey as doc
       from orders""",
)
def group_rows(t: Tables) -> DataFrame:
    df = t.orders.select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("doc"))
    return agg.group_rows(df, ["v:customer"], "v:doc", "doc")


@query(
    "E1_group_by",
    """select segment, chunk, string_agg(customer, '|' order by pos) as customers from (
         select c_mktsegment as segment, c_custkey::varchar as customer,
           row_number() over (partition by c_mktsegment order by c_custkey) - 1 as pos,
           (row_number() over (partition by c_mktsegment order by c_custkey) - 1) // 100 as chunk from customer)
       group by segment, chunk""",
)
def group_by(t: Tables) -> DataFrame:
    df = t.customer.select(F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("customer"))
    return agg.group_by(df, ["v:segment"], "v:customer", "customers", size=100).withColumn("customers", joined("customers"))


@query(
    "E1_group_by_template",
    """select user_id as "user", row_number() over (partition by user_id order by ts, event_id) - 1 as pos, ts, event_id as event from events""",
)
def group_by_template(t: Tables) -> DataFrame:
    df = t.events.select(F.col("user_id").alias("user"), "ts", F.col("event_id").alias("event"))
    rows = agg.group_rows(df, ["v:user"], {"ts": "v:ts", "event": "v:event"})
    return rows.select("user", "pos", "item.ts", "item.event")


@query(
    "E2_collect",
    """select chunk, string_agg(name, '|' order by pos) as names from (
         select c_name as name, row_number() over (order by c_name) - 1 as pos,
           (row_number() over (order by c_name) - 1) // 1000 as chunk from customer) group by chunk""",
)
def collect(t: Tables) -> DataFrame:
    names = match.triple(graph(t, "Customer"), "v:doc", "name", "v:name")
    return agg.collect(names, "v:name", "names").withColumn("names", joined("names"))


@query("E2_collect_none", "select 0 as chunk, 0 as n")
def collect_none(t: Tables) -> DataFrame:
    """No solutions give one row with an empty list."""
    names = match.triple(graph(t, "Customer"), "v:doc", "name", "no such name")
    return agg.collect(names.select(F.col("doc").alias("name")), "v:name", "names").select("chunk", F.size("names").alias("n"))


@query("E3_count", "select count(*) as n from orders where o_orderstatus = 'P'")
def count(t: Tables) -> DataFrame:
    return agg.count(match.triple(graph(t, "Order"), "v:doc", "status", "P"), "v:n")


@query("E3_count_none", "select count(*) as n from orders where o_orderstatus = 'no such status'")
def count_none(t: Tables) -> DataFrame:
    return agg.count(match.triple(graph(t, "Order"), "v:doc", "status", "no such status"), "v:n")


@query("E4_sum", f"select o_custkey as customer, sum(o_totalprice::{MONEY})::double as revenue from orders group by 1")
def sum_(t: Tables) -> DataFrame:
    df = t.orders.select(F.col("o_custkey").alias("customer"), F.col("o_totalprice").cast(MONEY).alias("price"))
    return agg.group_sum(df, ["v:customer"], "v:price", "v:revenue").withColumn("revenue", F.col("revenue").cast("double"))


@query(
    "E4_sum_of_list",
    "select p_partkey as part, (select sum(length(w)) from unnest(string_split(p_name, ' ')) u(w))::bigint as letters from part",
)
def sum_of_list(t: Tables) -> DataFrame:
    sizes = F.transform(text.split("v:p_name", " "), F.length)
    return t.part.select(F.col("p_partkey").alias("part"), lists.sum_(sizes, "bigint").alias("letters"))


@query("E5_length", "select p_partkey as part, len(string_split(p_name, ' '))::int as words from part")
def length(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("part"), lists.length(text.split("v:p_name", " ")).alias("words"))


@query("E5_group_length", "select l_orderkey as doc, count(*) as items from lineitem group by 1")
def group_length(t: Tables) -> DataFrame:
    return agg.group_count(t.lineitem.select(F.col("l_orderkey").alias("doc")), ["v:doc"], "v:items")


@query(
    "E6_range_min_max",
    """select p_partkey as part, list_min(string_split(p_name, ' ')) as low, list_max(string_split(p_name, ' ')) as high from part""",
)
def range_min_max(t: Tables) -> DataFrame:
    words = text.split("v:p_name", " ")
    df = t.part.select(
        F.col("p_partkey").alias("part"), lists.range_min(words).alias("low"), lists.range_max(words).alias("high")
    )
    return c.drop_unbound(df, "v:low", "v:high")


@query(
    "E6_range_min_empty",
    "select doc_id as doc from documents where list_min(list_filter(string_split(text, ' '), lambda w: w = 'the')) is not null",
)
def range_min_empty(t: Tables) -> DataFrame:
    hits = F.filter(text.split("v:text", " "), lambda w: w == "the")
    df = t.documents.select(F.col("doc_id").alias("doc"), lists.range_min(hits).alias("low"))
    return c.select(c.drop_unbound(df, "v:low"), "v:doc")


@query("E6_group_range", "select l_orderkey as doc, min(l_quantity) as low, max(l_quantity) as high from lineitem group by 1")
def group_range(t: Tables) -> DataFrame:
    df = t.lineitem.select(F.col("l_orderkey").alias("doc"), "l_quantity")
    return agg.group_range(df, ["v:doc"], "v:l_quantity", "v:low", "v:high")


@query("E7_having", "select o_custkey as customer, count(*) as n from orders group by 1 having count(*) > 12")
def having(t: Tables) -> DataFrame:
    df = agg.group_count(t.orders.select(F.col("o_custkey").alias("customer")), ["v:customer"], "v:n")
    return c.greater(df, "v:n", 12)


@query("E8_count_distinct", "select l_suppkey as supplier, count(distinct l_partkey) as parts from lineitem group by 1")
def count_distinct(t: Tables) -> DataFrame:
    df = t.lineitem.select(F.col("l_suppkey").alias("supplier"), F.col("l_partkey").alias("part"))
    return agg.count_distinct(df, ["v:supplier"], ["v:part"], "v:parts")


@query("E9_triple_count", f"select 'instance' as graph, count(*) as n from {facts_sql()}")
def triple_count(t: Tables) -> DataFrame:
    return agg.triple_count(graph(t).quads(), "v:n")


@query(
    "E10_size",
    f"select 'instance' as graph, sum(octet_length(encode(s)) + octet_length(encode(p)) + octet_length(encode(o)))::bigint as bytes from {facts_sql('Customer', 'Supplier', 'Part', 'Order')}",
)
def size(t: Tables) -> DataFrame:
    return agg.size(graph(t, "Customer", "Supplier", "Part", "Order").quads(), "v:bytes")


# Order and paging -------------------------------------------------------------------------------------


@query("O1_order_by", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey")
def order_by(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", "o_totalprice")
    return c.order_by(df, "v:o_totalprice", "v:o_orderkey", order=["desc", "asc"])


@query("O2_limit", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def limit(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", "o_totalprice")
    return c.limit(c.order_by(df, "v:o_totalprice", "v:o_orderkey", order={"v:o_totalprice": "desc"}), 10)


@query("O3_start", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey offset 20")
def start(t: Tables) -> DataFrame:
    return c.start(t.orders.select("o_orderkey", "o_totalprice"), 20, "v:o_totalprice", order="desc")


@query("O3_page", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10 offset 20")
def page(t: Tables) -> DataFrame:
    return c.page(t.orders.select("o_orderkey", "o_totalprice"), 20, 10, "v:o_totalprice", "v:o_orderkey", order=["desc", "asc"])


@query("O4_once", "select o_custkey as customer, min(o_orderkey) as doc from orders group by 1")
def once(t: Tables) -> DataFrame:
    return c.once(t.orders.select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("doc")), "v:customer")


# Lists and sets ---------------------------------------------------------------------------------------


def _words(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("part"),
        text.split("v:p_name", " ").alias("words"),
        F.array(*[F.lit(w) for w in ("ring", "small", "blue", "ring")]).alias("known"),
    )


_KNOWN = "['ring', 'small', 'blue', 'ring']"


@query(
    "S1_set_union",
    f"select p_partkey as part, array_to_string(list_sort(list_distinct(list_concat(string_split(p_name, ' '), {_KNOWN}))), '|') as words from part",
)
def set_union(t: Tables) -> DataFrame:
    return _words(t).select("part", F.array_join(lists.set_union("v:words", "v:known"), "|").alias("words"))


@query(
    "S2_set_intersection",
    f"select p_partkey as part, array_to_string(list_sort(list_intersect(string_split(p_name, ' '), {_KNOWN})), '|') as words from part",
)
def set_intersection(t: Tables) -> DataFrame:
    return _words(t).select("part", F.array_join(lists.set_intersection("v:words", "v:known"), "|").alias("words"))


@query(
    "S3_set_difference",
    f"""select p_partkey as part, array_to_string(list_sort(list_distinct(list_filter(string_split(p_name, ' '),
          lambda w: not list_contains({_KNOWN}, w)))), '|') as words from part""",
)
def set_difference(t: Tables) -> DataFrame:
    return _words(t).select("part", F.array_join(lists.set_difference("v:words", "v:known"), "|").alias("words"))


@query(
    "S4_list_to_set",
    "select doc_id as doc, array_to_string(list_sort(list_distinct(string_split(text, ' '))), '|') as words from documents",
)
def list_to_set(t: Tables) -> DataFrame:
    words = lists.list_to_set(text.split("v:text", " "))
    return t.documents.select(F.col("doc_id").alias("doc"), F.array_join(words, "|").alias("words"))


@query(
    "S5_slice",
    """with w as (select doc_id as doc, string_split(text, ' ') as x from documents)
       select doc, array_to_string(list_slice(x, 2, 5), '|') as middle,
         array_to_string(list_slice(x, greatest(len(x) - 3, 0) + 1, len(x) - 1), '|') as tail,
         array_to_string(list_slice(x, 4, len(x)), '|') as rest from w""",
)
def slice_(t: Tables) -> DataFrame:
    df = t.documents.select(F.col("doc_id").alias("doc"), text.split("v:text", " ").alias("x"))
    return df.select(
        "doc",
        F.array_join(lists.slice_("v:x", 1, 5), "|").alias("middle"),
        F.array_join(lists.slice_("v:x", -3, -1), "|").alias("tail"),
        F.array_join(lists.slice_("v:x", 3), "|").alias("rest"),
    )


@query("S6_concat", "select p_partkey as part, p_brand || ' of ' || p_type || '!' as label from part")
def concat(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("part"), text.concat("v:p_brand of v:p_type!").alias("label"))


@query("S7_join", "select p_partkey as part, array_to_string(string_split(p_name, ' '), '-') as label from part")
def join(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("part"), text.join(text.split("v:p_name", " "), "-").alias("label"))


@query("S8_split", "select doc_id as doc, array_to_string(string_split(text, '. '), '|') as parts from documents")
def split(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("doc"), F.array_join(text.split("v:text", ". "), "|").alias("parts"))


@query("S9_union", "select c_nationkey as nation from customer union all select s_nationkey from supplier")
def union(t: Tables) -> DataFrame:
    return c.or_(t.customer.select(F.col("c_nationkey").alias("nation")), t.supplier.select(F.col("s_nationkey").alias("nation")))


@query(
    "S9_intersect",
    "select o_custkey as customer, o_orderkey as doc from orders where o_orderstatus = 'F' and o_orderpriority = '5-LOW'",
)
def intersect(t: Tables) -> DataFrame:
    pairs = t.orders.select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("doc"), "o_orderstatus", "o_orderpriority")
    done = pairs.where("o_orderstatus = 'F'").select("customer", "doc")
    return c.and_(done, pairs.where("o_orderpriority = '5-LOW'").select("customer", "doc"))


@query(
    "S9_except",
    "select p_partkey as part from part where p_partkey not in (select l_partkey from lineitem where l_quantity < 5)",
)
def except_(t: Tables) -> DataFrame:
    cheap = t.lineitem.where("l_quantity < 5").select(F.col("l_partkey").alias("part"))
    return c.not_(t.part.select(F.col("p_partkey").alias("part")), cheap)
