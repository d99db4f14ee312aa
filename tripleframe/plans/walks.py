"""Queries over paths and linked lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripleframe.operators import paths as p
from tripleframe.operators import rdflist
from tripleframe.plans import views
from tripleframe.plans.registry import Tables, query
from tripleframe.plans.views import CELLS_SQL, HOPS_SQL, class_sql, graph
from tripleframe.session import cut

# Paths ------------------------------------------------------------------------------------------------

_TREE = ("Region", "Nation", "Customer", "Order")
_UP = p.alt("customer", "nation", "region")

_LEVELS_SQL = f"""
  o as (select o.id as o, o.customer as c, c.nation as n, n.region as r from {class_sql('Order')} o
        join {class_sql('Customer')} c on c.id = o.customer join {class_sql('Nation')} n on n.id = c.nation),
  up as (select o as s, c as o from o union select o, n from o union select o, r from o
         union select id, nation from {class_sql('Customer')}
         union select c.id, n.region from {class_sql('Customer')} c join {class_sql('Nation')} n on n.id = c.nation
         union select id, region from {class_sql('Nation')})"""


@query(
    "P1_path",
    f"select o as node, c as near from (with {_LEVELS_SQL} select distinct o, c from o where r = 'Region/2')",
)
def path(t: Tables) -> DataFrame:
    """Orders reached backwards from one region, with their customers."""
    g = graph(t, *_TREE)
    inside = p.path(g, "v:near", p.seq("nation", "region"), "Region/2")
    return p.path(g, "v:node", "customer", "v:near", seeds=None).join(inside, "near").select("node", "near")


@query("P1_path_bound_subject", "select 'Nation/' || c_nationkey as nation from customer where c_custkey = 7")
def path_bound_subject(t: Tables) -> DataFrame:
    return p.path(graph(t, *_TREE), "Customer/7", "nation", "v:nation")


@query(
    "P1_path_seeds",
    f"""select o.id as s, n.region as o from {class_sql('Order')} o join {class_sql('Customer')} c on c.id = o.customer
        join {class_sql('Nation')} n on n.id = c.nation where o.status = 'P'""",
)
def path_seeds(t: Tables) -> DataFrame:
    g = graph(t, *_TREE)
    seeds = g.tables["Order"].where("status = 'P'").select("id")
    return p.path(g, "v:s", p.seq("customer", "nation", "region"), "v:o", seeds=seeds)


@query("P2_predicate", f"select distinct id as s, nation as o from {class_sql('Customer')}")
def predicate(t: Tables) -> DataFrame:
    return p.path(graph(t, *_TREE), "v:s", p.pred("nation"), "v:o")


@query(
    "P2_any",
    f"""select id as s, customer as o from {class_sql('Order')} union select id, nation from {class_sql('Customer')}
        union select id, region from {class_sql('Nation')}""",
)
def any_edge(t: Tables) -> DataFrame:
    return p.path(graph(t, *_TREE), "v:s", p.any_(), "v:o")


@query("P3_inverse", f"select nation as s, id as o from {class_sql('Customer')}")
def inverse(t: Tables) -> DataFrame:
    return p.path(graph(t, *_TREE), "v:s", p.inv("nation"), "v:o")


@query(
    "P4_sequence",
    f"with {_LEVELS_SQL} select distinct o as s, r as o from o",
)
def sequence(t: Tables) -> DataFrame:
    return p.path(graph(t, *_TREE), "v:s", p.seq("customer", "nation", "region"), "v:o")


@query("P5_alternative", f"select id as s, hop as o from {HOPS_SQL} union select id, jump from {HOPS_SQL}")
def alternative(t: Tables) -> DataFrame:
    return p.path(views.supplier_hops(t), "v:s", p.alt("hop", "jump"), "v:o")


@query("P6_plus", f"with {_LEVELS_SQL} select s, o from up")
def plus(t: Tables) -> DataFrame:
    """Everything above each node of the tree."""
    return p.path(graph(t, *_TREE), "v:s", p.plus(_UP), "v:o")


@query(
    "P6_plus_cyclic",
    f"""with recursive e as (select id as s, hop as o from {HOPS_SQL} union select id, jump from {HOPS_SQL}),
        r as (select o from e where s = 'Supplier/1' union select e.o from r join e on e.s = r.o) select o from r""",
)
def plus_cyclic(t: Tables) -> DataFrame:
    """Everything reached from one supplier in a cyclic graph."""
    return p.path(views.supplier_hops(t), "Supplier/1", p.plus(p.alt("hop", "jump")), "v:o")


@query(
    "P6_plus_cyclic_backward",
    f"""with recursive e as (select hop as s, id as o from {HOPS_SQL} union select jump, id from {HOPS_SQL}),
        r as (select o from e where s = 'Supplier/4' union select e.o from r join e on e.s = r.o) select o as s from r""",
)
def plus_cyclic_backward(t: Tables) -> DataFrame:
    """Every supplier that leads to a given one."""
    return p.path(views.supplier_hops(t), "v:s", p.plus(p.alt("hop", "jump")), "Supplier/4")


@query(
    "P7_star",
    f"""with {_LEVELS_SQL}, nodes as (select s as n from up union select o from up) select s, o from up union select n, n from nodes""",
)
def star(t: Tables) -> DataFrame:
    return p.path(graph(t, *_TREE), "v:s", p.star(_UP), "v:o")


@query(
    "P8_times",
    f"""with e as (select id as s, hop as o from {HOPS_SQL}),
        e2 as (select a.s, b.o from e a join e b on b.s = a.o), e3 as (select a.s, b.o from e2 a join e b on b.s = a.o)
        select * from e union select * from e2 union select * from e3""",
)
def times(t: Tables) -> DataFrame:
    return p.path(views.supplier_hops(t), "v:s", p.times("hop", 1, 3), "v:o")


@query(
    "P9_path_variable",
    f"""with e as (select id as s, hop as o from {HOPS_SQL}),
        e2 as (select a.s, a.o as m, b.o from e a join e b on b.s = a.o where b.s <> a.s),
        e3 as (select a.s, b.o from e2 a join e b on b.s = a.o where b.s <> a.s and b.s <> a.m)
        select s, o, 1 as hops from e union all select s, o, 2 from e2 union all select s, o, 3 from e3""",
)
def path_variable(t: Tables) -> DataFrame:
    """Routes of one to three edges that use no edge twice, with their length."""
    routes = p.path(views.supplier_hops(t), "v:s", p.times("hop", 1, 3), "v:o", path="v:route")
    return routes.select("s", "o", p.hops("v:route").alias("hops"))


@query(
    "P9_path_text",
    f"""with {_LEVELS_SQL} select o.o as s, o.r as o, o.o || '>' || o.c || '>' || o.n || '>' || o.r as route from o""",
)
def path_text(t: Tables) -> DataFrame:
    routes = p.path(graph(t, *_TREE), "v:s", p.seq("customer", "nation", "region"), "v:o", path="v:route")
    nodes = F.transform("route", lambda e: e["o"])
    return routes.select("s", "o", F.concat_ws(">", "s", F.array_join(nodes, ">")).alias("route"))


# Linked lists -----------------------------------------------------------------------------------------


def _lists(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Cells and positions of the conversations, each written once."""
    cells = cut(views.conversation_cells(t))
    return cells, rdflist.list_positions(cells)


@query("H0_list_positions", f"select head, pos, cell, text as value from (select head, pos, cell, first as text from {CELLS_SQL})")
def list_positions(t: Tables) -> DataFrame:
    return _lists(t)[1]


_CHAIN_SQL = """(select event_id, user_id, event_type, row_number() over (partition by user_id order by ts, event_id) - 1 as pos,
  first_value(event_id) over (partition by user_id order by ts, event_id) as head from events)"""


@query("H0_long_lists", f"select 'Event/' || head as head, pos, 'Event/' || event_id as cell, event_type as value from {_CHAIN_SQL}")
def long_lists(t: Tables) -> DataFrame:
    """The events of each user as one list."""
    return rdflist.list_positions(views.event_cells(t))


@query("H0_cells_from_quads", f"select cell, first, rest from {CELLS_SQL}")
def cells_from_quads(t: Tables) -> DataFrame:
    cells = views.conversation_cells(t)
    facts = [F.struct(F.lit(f"rdf:{n}").alias("p"), F.col(n).alias("o")) for n in ("first", "rest")]
    quads = cells.select(F.col("cell").alias("s"), F.inline(F.array(*facts)))
    return rdflist.cells_from_quads(quads)


@query(
    "H1_list",
    f"select head, (pos // 1000)::bigint as chunk, md5(string_agg(first, '|' order by pos)) as digest from {CELLS_SQL} group by 1, 2",
)
def list_(t: Tables) -> DataFrame:
    chunks = rdflist.list_chunks(_lists(t)[1])
    return chunks.select("head", "chunk", F.md5(F.array_join("items", "|")).alias("digest"))


@query("H2_peek", f"select head, first as value from {CELLS_SQL} where pos = 0")
def peek(t: Tables) -> DataFrame:
    return rdflist.peek(views.conversation_cells(t))


@query("H3_last", f"select head, first as value from {CELLS_SQL} where rest = 'rdf:nil'")
def last(t: Tables) -> DataFrame:
    cells, positions = _lists(t)
    return rdflist.last(positions, cells)


@query("H4_nth0", f"select head, pos as index, first as value from {CELLS_SQL} where pos = 2")
def nth0(t: Tables) -> DataFrame:
    return rdflist.nth0(_lists(t)[1], 2)


@query("H4_nth0_generated", f"select head, pos as index, first as value from {CELLS_SQL}")
def nth0_generated(t: Tables) -> DataFrame:
    return rdflist.nth0(_lists(t)[1])


@query("H5_nth1", f"select head, pos + 1 as index, first as value from {CELLS_SQL} where pos = 0")
def nth1(t: Tables) -> DataFrame:
    return rdflist.nth1(_lists(t)[1], 1)


@query("H6_member", "select 'Event/' || head as head, event_type as value from " + _CHAIN_SQL + " where event_type = 'error'")
def member(t: Tables) -> DataFrame:
    return rdflist.member(rdflist.list_positions(views.event_cells(t)), "error")


@query("H7_length", f"select head, max(pos) + 1 as length from {CELLS_SQL} group by 1")
def length(t: Tables) -> DataFrame:
    return rdflist.length(_lists(t)[1])


@query("H8_slice", f"select head, pos - 1 as pos, first as value from {CELLS_SQL} where pos >= 1 and pos < 4")
def slice_(t: Tables) -> DataFrame:
    return rdflist.slice_(_lists(t)[1], 1, 4)


@query("H9_is_empty", f"select cell, rest from {CELLS_SQL} where rest = 'rdf:nil'")
def is_empty(t: Tables) -> DataFrame:
    return rdflist.is_empty(views.conversation_cells(t).select("cell", "rest"), "rest")


def _after(cells: DataFrame, changes: DataFrame) -> DataFrame:
    """(head, pos, value) of the lists after a set of changes."""
    positions = rdflist.list_positions(cut(rdflist.apply_cell_changes(cells, changes)))
    return positions.select("head", "pos", "value")


def _heads(positions: DataFrame) -> DataFrame:
    return positions.where("pos = 0").select("head")


@query(
    "H10_push",
    f"select head, pos + 1 as pos, first as value from {CELLS_SQL} union all select head, 0, 'pushed' from {CELLS_SQL} where pos = 0",
)
def push(t: Tables) -> DataFrame:
    cells, positions = _lists(t)
    return _after(cells, rdflist.push(cells, _heads(positions).withColumn("value", F.lit("pushed"))))


@query(
    "H10_append",
    f"select head, pos, first as value from {CELLS_SQL} union all select head, max(pos) + 1, 'appended' from {CELLS_SQL} group by head",
)
def append(t: Tables) -> DataFrame:
    cells, positions = _lists(t)
    return _after(cells, rdflist.append(positions, cells, _heads(positions).withColumn("value", F.lit("appended"))))


@query(
    "H10_insert",
    f"""select head, case when pos >= 1 then pos + 1 else pos end as pos, first as value from {CELLS_SQL}
        union all select head, 1, 'inserted' from {CELLS_SQL} where pos = 0""",
)
def insert(t: Tables) -> DataFrame:
    cells, positions = _lists(t)
    edits = _heads(positions).select("head", F.lit(1).cast("bigint").alias("position"), F.lit("inserted").alias("value"))
    return _after(cells, rdflist.insert(positions, cells, edits))


_LONG = f"(select head from {CELLS_SQL} group by head having count(*) > 1)"


@query(
    "H11_pop",
    f"""select head, pos - 1 as pos, first as value from {CELLS_SQL} where pos > 0
        union all select head, 0, first from {CELLS_SQL} where head not in {_LONG}""",
)
def pop(t: Tables) -> DataFrame:
    cells, positions = _lists(t)
    return _after(cells, rdflist.pop(cells, _heads(positions)))


@query("H11_popped", f"select head, first as value from {CELLS_SQL} where pos = 0 and head in {_LONG}")
def popped(t: Tables) -> DataFrame:
    cells, positions = _lists(t)
    return rdflist.popped(cells, _heads(positions))


@query(
    "H11_drop",
    f"select head, case when pos > 2 then pos - 1 else pos end as pos, first as value from {CELLS_SQL} where pos <> 2",
)
def drop(t: Tables) -> DataFrame:
    cells, positions = _lists(t)
    edits = _heads(positions).withColumn("position", F.lit(2).cast("bigint"))
    return _after(cells, rdflist.drop(positions, cells, edits))


@query(
    "H11_clear",
    f"select head, pos, first as value from {CELLS_SQL} where head in (select head from {CELLS_SQL} group by head having count(*) < 4)",
)
def clear(t: Tables) -> DataFrame:
    """The lists of at least four values are cleared."""
    cells, positions = _lists(t)
    gone = rdflist.length(positions).where("length >= 4").select("head")
    return _after(cells, rdflist.clear(positions, cells, gone))


@query(
    "H12_swap",
    f"""select head, case when head in {_LONG} and pos < 2 then 1 - pos else pos end as pos, first as value from {CELLS_SQL}""",
)
def swap(t: Tables) -> DataFrame:
    cells, positions = _lists(t)
    edits = _heads(positions).select("head", F.lit(0).cast("bigint").alias("pos_a"), F.lit(1).cast("bigint").alias("pos_b"))
    return _after(cells, rdflist.swap(positions, edits))
