"""Queries over changes, versions, schema checks and prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleframe.model import ClassDef, Lit, Prop, Schema
from tripleframe.operators import documents as docs
from tripleframe.operators import update, validate, versions
from tripleframe.plans import views
from tripleframe.plans.registry import Tables, query
from tripleframe.plans.scans import FACTS, FACTS_AFTER, FACTS_BEFORE
from tripleframe.plans.solutions import CLASSES_SQL, PART_CLASSES
from tripleframe.plans.views import class_sql, class_table, facts_sql, graph
from tripleframe.sources import json as json_lines
from tripleframe.sources import triples
from tripleframe.streaming import documents as streams

# Updates ----------------------------------------------------------------------------------------------

_ORDER_FACTS = facts_sql("Order")


def _orders(t: Tables) -> DataFrame:
    return class_table(t, "Order")


def _facts(df: DataFrame) -> DataFrame:
    return docs.triplify(df, views.SCHEMA, "Order")


@query(
    "I1_add_triple",
    f"""select distinct * from (select * from {_ORDER_FACTS} union all
        select id, 'flag', 'Flag/late', 'node', null from {class_sql('Order')} where priority = '1-URGENT')""",
)
def add_triple(t: Tables) -> DataFrame:
    orders = _orders(t)
    urgent = orders.where("priority = '1-URGENT'").select("id")
    changes = update.add_triple(urgent, "v:id", "flag", "Flag/late")
    return update.apply_changes(_facts(orders), changes).select(*FACTS)


@query(
    "I1_add_quad",
    f"""select 'instance' as graph, count(*) as n from {_ORDER_FACTS} union all
        select 'audit', count(*) from {class_sql('Order')} where status = 'F'""",
)
def add_quad(t: Tables) -> DataFrame:
    orders = _orders(t)
    changes = update.add_quad(orders.where("status = 'F'"), "v:id", "seen", Lit(True), "audit")
    return update.apply_changes(_facts(orders), changes).groupBy("graph").agg(F.count(F.lit(1)).alias("n"))


@query(
    "I2_delete_triple",
    f"select * from {_ORDER_FACTS} where not (p = 'priority' and o = '5-LOW')",
)
def delete_triple(t: Tables) -> DataFrame:
    orders = _orders(t)
    low = orders.where("priority = '5-LOW'").select("id", "priority")
    changes = update.delete_triple(low, "v:id", "priority", Lit("v:priority", "xsd:string"))
    return update.apply_changes(_facts(orders), changes).select(*FACTS)


@query(
    "I3_update_triple",
    f"""select s, p, case when p = 'status' and s in (select id from {class_sql('Order')} where priority = '1-URGENT') then 'X' else o end as o,
          o_kind, o_type from {_ORDER_FACTS}""",
)
def update_triple(t: Tables) -> DataFrame:
    orders = _orders(t)
    facts = _facts(orders)
    urgent = orders.where("priority = '1-URGENT'").select("id")
    changes = update.update_triple(facts, urgent, "v:id", "status", Lit("X"))
    return update.apply_changes(facts, changes).select(*FACTS)


@query(
    "I4_update_document",
    f"""select id, customer, case when priority = '1-URGENT' then 'X' else status end as status, totalprice, orderdate, priority
        from {class_sql('Order')}""",
)
def update_document(t: Tables) -> DataFrame:
    orders = _orders(t)
    edited = orders.where("priority = '1-URGENT'").withColumn("status", F.lit("X"))
    return docs.update_document(orders, edited)


@query("I4_delete_document", f"select * from {class_sql('Order')} where priority <> '1-URGENT'")
def delete_document(t: Tables) -> DataFrame:
    orders = _orders(t)
    return docs.delete_document(orders, orders.where("priority = '1-URGENT'"))


def _versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    return _orders(t), views.order_documents(views.orders_after(t))


@query("I5_apply_changes", f"select * from {FACTS_AFTER}")
def apply_changes(t: Tables) -> DataFrame:
    before, after = map(_facts, _versions(t))
    return update.apply_changes(before, update.changes_between(before, after), net=True).select(*FACTS)


@query(
    "I5_change_counts",
    f"""select (select count(*) from (select * from {FACTS_AFTER} except select * from {FACTS_BEFORE})) as inserts,
          (select count(*) from (select * from {FACTS_BEFORE} except select * from {FACTS_AFTER})) as deletes""",
)
def change_counts(t: Tables) -> DataFrame:
    before, after = map(_facts, _versions(t))
    return update.change_counts(before, update.changes_between(before, after))


# Versions ---------------------------------------------------------------------------------------------

_DOC = ["id", "customer", "status", "totalprice", "priority", "orderdate"]
_COLS = ", ".join(_DOC)
# The later version moves some dates by a day, the other branch some of these and others by two.
_MOVED = "priority = '5-LOW' and totalprice > 200000"
_MOVED_OTHER = "priority = '5-LOW' and (totalprice > 300000 or totalprice < 50000)"
_B = f"(select {_COLS} from {views.order_documents_sql('orders')})"
_A = f"""(select {", ".join(_DOC[:-1])}, case when {_MOVED} then orderdate + interval 1 day else orderdate end as orderdate
  from {views.order_documents_sql(views.ORDERS_AFTER_SQL)})"""
# Another branch: expensive finished orders carry another status and expensive pending ones are gone.
_OTHER_WHERE = "totalprice > 400000"
_T = f"""(select id, customer, case when {_OTHER_WHERE} and status = 'F' then 'Z' else status end as status, totalprice, priority,
  case when {_MOVED_OTHER} then orderdate + interval 2 day else orderdate end as orderdate from {_B} where not ({_OTHER_WHERE} and status = 'P'))"""


def _told(value: str) -> str:
    """A date as the JSON of a document has it; paths and their values have the plain text of a cast."""
    return f"strftime({value}, '%Y-%m-%dT%H:%M:%S.000')"


_CHANGED = "(a.status <> b.status or a.orderdate <> b.orderdate)"


def _changed_json(status: str, date: str) -> str:
    """A JSON object with what changed of the status and the date."""
    parts = f"case when a.status <> b.status then '\"status\":' || {status} end, case when a.orderdate <> b.orderdate then '\"orderdate\":' || {date} end"
    return f"'{{' || concat_ws(',', {parts}) || '}}'"


def _swap(before: str, after: str) -> str:
    return f"""'{{"@op":"SwapValue","@before":"' || {before} || '","@after":"' || {after} || '"}}'"""


def _quoted(value: str) -> str:
    return f"""'"' || {value} || '"'"""


_SWAP = _changed_json(_swap("b.status", "a.status"), _swap(_told("b.orderdate"), _told("a.orderdate")))


def _doc_json(alias: str) -> str:
    return "json_object(" + ", ".join(f"'{c}', " + (_told(f"{alias}.{c}") if c == "orderdate" else f"{alias}.{c}") for c in _DOC) + ")::varchar"


def _docs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    moved = lambda df, where, days: df.withColumn("orderdate", F.when(F.expr(where), F.expr(f"orderdate + interval {days} days")).otherwise(F.col("orderdate")))
    before, after = (df.select(*_DOC) for df in _versions(t))
    after = moved(after, _MOVED, 1)
    other = before.where(f"not ({_OTHER_WHERE} and status = 'P')").withColumn(
        "status", F.when(F.expr(_OTHER_WHERE) & (F.col("status") == "F"), "Z").otherwise(F.col("status"))
    )
    other = moved(other, _MOVED_OTHER, 2)
    return before, after, other


@query(
    "J1_diff_version",
    f"""select coalesce(b.id, a.id) as id, case when b.id is null then '@insert' when a.id is null then '@delete' else '@patch' end as op,
          case when b.id is null then {_doc_json('a')} when a.id is null then {_doc_json('b')} else {_SWAP} end as body
        from {_B} b full join {_A} a on a.id = b.id where b.id is null or a.id is null or {_CHANGED}""",
)
def diff_version(t: Tables) -> DataFrame:
    before, after, _ = _docs(t)
    return versions.diff_version(before, after)


@query(
    "J2_diff_object",
    f"""select b.id, 'status' as path, b.status as before, a.status as after from {_B} b join {_A} a on a.id = b.id where a.status <> b.status
        union all select b.id, 'orderdate', b.orderdate::varchar, a.orderdate::varchar from {_B} b join {_A} a on a.id = b.id where a.orderdate <> b.orderdate""",
)
def diff_object(t: Tables) -> DataFrame:
    before, after, _ = _docs(t)
    return versions.diff_object(before, after)


@query(
    "J3_patch",
    f"""select b.id, b.customer, coalesce(a.status, b.status) as status, b.totalprice, b.priority, coalesce(a.orderdate, b.orderdate) as orderdate
        from {_B} b left join {_A} a on a.id = b.id""",
)
def patch(t: Tables) -> DataFrame:
    before, after, _ = _docs(t)
    return versions.patch(before, versions.diff_object(before, after))


@query("J3_patch_json", f"select b.id, {_SWAP} as patch from {_B} b join {_A} a on a.id = b.id where {_CHANGED}")
def patch_json(t: Tables) -> DataFrame:
    before, after, _ = _docs(t)
    return versions.patch_json(versions.diff_object(before, after), before.schema)


@query(
    "J4_patch_update",
    f"""select b.id, {_changed_json(_quoted("a.status"), _quoted(_told("a.orderdate")))} as update from {_B} b join {_A} a on a.id = b.id where {_CHANGED}""",
)
def patch_update(t: Tables) -> DataFrame:
    before, after, _ = _docs(t)
    return versions.patch_update(versions.diff_object(before, after), before.schema)


@query(
    "J4_patch_before",
    f"""select b.id, {_changed_json(_quoted("b.status"), _quoted(_told("b.orderdate")))} as before from {_B} b join {_A} a on a.id = b.id where {_CHANGED}""",
)
def patch_before(t: Tables) -> DataFrame:
    before, after, _ = _docs(t)
    return versions.patch_before(versions.diff_object(before, after), before.schema)


# A stored value that is neither the one before nor the one after; such a document is left alone.
_CLASH_STATUS = "(a.status <> b.status and t.status <> b.status and t.status <> a.status)"
_CLASH_DATE = "(a.orderdate <> b.orderdate and t.orderdate <> b.orderdate and t.orderdate <> a.orderdate)"
_CLASH = f"({_CLASH_STATUS} or {_CLASH_DATE})"


@query(
    "J5_patch_resource",
    f"""select id, customer, case when clash or a_status is null then status else a_status end as status, totalprice, priority,
          case when clash or a_status is null then orderdate else a_date end as orderdate
        from (select t.*, case when a.status <> b.status then a.status else t.status end as a_status, case when a.orderdate <> b.orderdate then a.orderdate else t.orderdate end as a_date,
                coalesce({_CLASH}, false) as clash
              from {_T} t left join {_B} b on b.id = t.id left join {_A} a on a.id = t.id)""",
)
def patch_resource(t: Tables) -> DataFrame:
    before, after, other = _docs(t)
    return versions.patch_resource(other, versions.diff_object(before, after))


@query(
    "J5_patch_conflicts",
    f"""select t.id, 'status' as path, t.status as stored, b.status as before, a.status as after
        from {_T} t join {_B} b on b.id = t.id join {_A} a on a.id = t.id where {_CLASH_STATUS}
        union all select t.id, 'orderdate', t.orderdate::varchar, b.orderdate::varchar, a.orderdate::varchar
        from {_T} t join {_B} b on b.id = t.id join {_A} a on a.id = t.id where {_CLASH_DATE}""",
)
def patch_conflicts(t: Tables) -> DataFrame:
    before, after, other = _docs(t)
    return versions.patch_conflicts(other, versions.diff_object(before, after))


_MERGED = f"""(select coalesce(t.id, b.id, a.id) as id, b.id as b, a.id as a, t.id as t, a.status as as_, t.status as ts, a.orderdate as ad, t.orderdate as td,
  coalesce(t.customer, a.customer) as customer, coalesce(t.totalprice, a.totalprice) as totalprice, coalesce(t.priority, a.priority) as priority,
  a.status <> b.status as s_new, a.orderdate <> b.orderdate as d_new, {_CHANGED} as a_new, (t.status <> b.status or t.orderdate <> b.orderdate) as t_new, {_CLASH} as clash
  from {_B} b full join {_A} a on a.id = b.id full join {_T} t on t.id = coalesce(b.id, a.id))"""


@query(
    "J6_apply_difference",
    f"""select id, customer, case when t is null or (b is not null and a is not null and s_new and not clash) then as_ else ts end as status, totalprice, priority,
          case when t is null or (b is not null and a is not null and d_new and not clash) then ad else td end as orderdate from {_MERGED}
        where case when b is null then true when a is null then t is not null and t_new else t is not null end""",
)
def apply_difference(t: Tables) -> DataFrame:
    return versions.apply_difference(*_docs(t))


@query(
    "J6_apply_conflicts",
    f"""select id, case when a is null then 'delete' when t is null then 'missing' else 'patch' end as conflict from {_MERGED}
        where b is not null and ((a is null and t is not null and t_new) or (a is not null and t is null and a_new) or (a is not null and t is not null and clash))""",
)
def apply_conflicts(t: Tables) -> DataFrame:
    return versions.apply_conflicts(*_docs(t))


@query("J6_apply_then_diff", "select count(*) as n from orders where o_orderstatus = 'no such status'")
def apply_then_diff(t: Tables) -> DataFrame:
    """After the difference has been applied to the old version nothing differs."""
    before, after, _ = _docs(t)
    applied = versions.apply_difference(before, after, before)
    return versions.diff_version(applied, after).agg(F.count(F.lit(1)).alias("n"))


# (commit number, op, flag, condition): a log of four commits over the orders.
_LOG = [
    (1, "+", "a", "priority = '1-URGENT'"),
    (1, "+", "b", "priority = '2-HIGH'"),
    (2, "-", "a", "priority = '1-URGENT' and status = 'P'"),
    (2, "+", "c", "priority = '1-URGENT' and status = 'P'"),
    (3, "+", "a", "priority = '1-URGENT' and status = 'P' and totalprice > 250000"),
    (3, "-", "b", "priority = '2-HIGH' and status = 'F'"),
    (3, "-", "d", "priority = '3-MEDIUM' and status = 'O'"),
    (4, "+", "d", "priority = '3-MEDIUM' and status = 'O' and totalprice > 250000"),
]
_LOG_SQL = "(" + " union all ".join(
    f"select {n} as seq, '{op}' as op, id as s, 'flag' as p, '{flag}' as o from {class_sql('Order')} where {where}"
    for n, op, flag, where in _LOG
) + ")"
_BASE_SQL = f"(select id as s, 'flag' as p, 'd' as o from {class_sql('Order')} where priority = '3-MEDIUM')"


def _log(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Base facts and the change log, in one pass over the orders."""
    orders = _orders(t)
    entry = [
        F.when(F.expr(where), F.struct(F.lit(n).alias("seq"), F.lit(op).alias("op"), F.lit(flag).alias("flag")))
        for n, op, flag, where in _LOG
    ]
    rows = orders.select("id", F.inline(F.filter(F.array(*entry), lambda x: x.isNotNull())))
    fact = [F.lit("instance").alias("graph"), F.col("id").alias("s"), F.lit("flag").alias("p")]
    kind = [F.lit("data").alias("o_kind"), F.lit("xsd:string").alias("o_type")]
    changes = update.shadows(rows.select(F.col("seq").cast("bigint"), "op", *fact, F.col("flag").alias("o"), *kind))
    base = update.shadows(orders.where("priority = '3-MEDIUM'").select(*fact, F.lit("d").alias("o"), *kind))
    return base, changes


def _replayed_sql(upto: int) -> str:
    last = f"(select s, p, o, arg_max(op, seq) as op from {_LOG_SQL} where seq <= {upto} group by s, p, o)"
    return f"""select s, p, o from {_BASE_SQL} b where not exists (select 1 from {last} l where l.s = b.s and l.o = b.o)
      union all select s, p, o from {last} where op = '+'"""


@query(
    "J7_squash",
    f"""select op, s, p, o from (select s, p, o, arg_min(op, seq) as first, arg_max(op, seq) as op from {_LOG_SQL} group by s, p, o)
        where first = op""",
)
def squash(t: Tables) -> DataFrame:
    base, changes = _log(t)
    return versions.squash(changes, base).select("op", "s", "p", "o")


@query("J7_rebase", _replayed_sql(4))
def rebase(t: Tables) -> DataFrame:
    base, changes = _log(t)
    return versions.rebase(base, changes).select("s", "p", "o")


@query("J8_snapshot", _replayed_sql(2))
def snapshot(t: Tables) -> DataFrame:
    base, changes = _log(t)
    return versions.snapshot(base, changes, 2).select("s", "p", "o")


def _commits(t: Tables) -> DataFrame:
    """One commit per day on which orders were placed."""
    day = F.datediff(F.to_date("o_orderdate"), F.lit("1990-01-01").cast("date"))
    per_day = t.orders.groupBy(F.col("o_orderdate").alias("ts"), day.cast("bigint").alias("seq")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_day.select(
        F.concat(F.lit("commit"), F.col("seq").cast("string")).alias("commit_id"),
        F.lit("main").alias("branch"),
        F.lit("clerk").alias("author"),
        F.concat(F.col("n").cast("string"), F.lit(" orders")).alias("message"),
        "ts",
        "seq",
    )


_SEQ = "date_diff('day', date '1990-01-01', o_orderdate::date)"
_COMMITS_SQL = f"""(select 'commit' || {_SEQ} as commit_id, 'main' as branch, 'clerk' as author, count(*) || ' orders' as message,
  o_orderdate as ts, {_SEQ} as seq from orders group by o_orderdate, {_SEQ})"""


def _doc_changes(t: Tables) -> DataFrame:
    """Each order touches the document of its customer."""
    day = F.datediff(F.to_date("o_orderdate"), F.lit("1990-01-01").cast("date"))
    return t.orders.select(
        F.concat(F.lit("Customer/"), F.col("o_custkey").cast("string")).alias("doc_id"),
        F.concat(F.lit("commit"), day.cast("string")).alias("commit_id"),
    )


_TOUCH_SQL = f"""(select distinct 'Customer/' || o_custkey as doc_id, 'commit' || {_SEQ} as commit_id, o_orderdate as ts, {_SEQ} as seq from orders)"""


@query("J8_snapshot_at", f"select s, p, o from ({_replayed_sql(3)})")
def snapshot_at(t: Tables) -> DataFrame:
    base, changes = _log(t)
    commits = changes.select(F.concat(F.lit("c"), F.col("seq").cast("string")).alias("commit_id"), "seq").distinct()
    return versions.snapshot_at(base, changes, commits, "c3").select("s", "p", "o")


@query("J9_log", f"select * from {_COMMITS_SQL} order by ts desc, seq desc")
def log(t: Tables) -> DataFrame:
    return versions.log(_commits(t))


@query("J9_log_page", f"select * from {_COMMITS_SQL} order by ts desc, seq desc limit 20 offset 10")
def log_page(t: Tables) -> DataFrame:
    return versions.log(_commits(t), start=10, count=20)


@query("J9_commit_history", f"select * from {_COMMITS_SQL} order by ts desc, seq desc limit 500")
def commit_history(t: Tables) -> DataFrame:
    return versions.commit_history(_commits(t))


@query(
    "J10_document_history",
    f"""select doc_id, commit_id, author, message, ts, pos from (select x.doc_id, x.commit_id, c.author, c.message, x.ts,
          row_number() over (partition by x.doc_id order by x.ts desc, x.seq desc) - 1 as pos
        from {_TOUCH_SQL} x join {_COMMITS_SQL} c on c.commit_id = x.commit_id) where pos >= 2 and pos < 5""",
)
def document_history(t: Tables) -> DataFrame:
    rows = versions.document_history(_doc_changes(t), _commits(t), start=2, count=3)
    return rows.select("doc_id", "commit_id", "author", "message", "ts", "pos")


@query("J10_document_times", f"select doc_id, min(ts) as created, max(ts) as updated from {_TOUCH_SQL} group by 1")
def document_times(t: Tables) -> DataFrame:
    return versions.document_times(_doc_changes(t), _commits(t))


# Schema -----------------------------------------------------------------------------------------------


@query(
    "K1_class_closure",
    f"select x.parent as kind, count(*) as parts from part join {CLASSES_SQL} x(child, parent) on x.child = p_type group by 1",
)
def class_closure(t: Tables) -> DataFrame:
    pairs = PART_CLASSES.closure(t.spark).select(F.col("child").alias("p_type"), F.col("parent").alias("kind"))
    return t.part.select("p_type").join(pairs, "p_type").groupBy("kind").agg(F.count(F.lit(1)).alias("parts"))


_CHECKED = Schema(
    [
        ClassDef("Line", kind="enum", values=("SMALL", "MEDIUM", "LARGE", "ECONOMY", "STANDARD")),
        ClassDef(
            "Part",
            (
                Prop("name", "xsd:string"),
                Prop("brand", "xsd:NCName"),
                Prop("line", "Line"),
                Prop("weight", "xsd:byte"),
                Prop("code", "xsd:integer"),
                Prop("note", "xsd:string", "optional"),
            ),
            key="Lexical",
            key_fields=("number",),
        ),
    ]
)


@query(
    "K2_validate_documents",
    """with d as (select p_partkey, case when p_size = 7 then 'Odd/' || p_partkey else 'Part/' || p_partkey end as id,
              case when p_size <> 9 then p_name end as name, replace(p_brand, '#1', '1') as brand, p_type as line,
              p_size * 4 as weight, case when p_size > 45 then p_name else p_size::varchar end as code from part)
       select id, 'name' as property, 'required' as rule, null::varchar as value from d where name is null
       union all select id, 'brand', 'form', brand from d where contains(brand, '#')
       union all select id, 'line', 'enum', line from d where line = 'PROMO'
       union all select id, 'weight', 'range', weight::varchar from d where weight > 127
       union all select id, 'code', 'type', code from d where try_cast(code as bigint) is null
       union all select id, '@id', 'key', id from d where id <> 'Part/' || p_partkey""",
)
def validate_documents(t: Tables) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    parts = t.part.select(
        F.concat(F.when(size == 7, "Odd/").otherwise("Part/"), key).alias("id"),
        F.col("p_partkey").alias("number"),
        F.when(size != 9, F.col("p_name")).alias("name"),
        F.replace("p_brand", F.lit("#1"), F.lit("1")).alias("brand"),
        F.col("p_type").alias("line"),
        (size * 4).alias("weight"),
        F.when(size > 45, F.col("p_name")).otherwise(size.cast("string")).alias("code"),
        F.lit(None).cast("string").alias("note"),
    )
    return validate.validate_documents(parts, _CHECKED, "Part")


@query(
    "K2_dangling_references",
    """select 'Order/' || o_orderkey as id, 'customer' as property, 'reference' as rule, 'Customer/' || o_custkey as value from orders
       where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
)
def dangling_references(t: Tables) -> DataFrame:
    customers = class_table(t, "Customer").where("segment <> 'BUILDING'")
    return validate.dangling_references(_orders(t), "customer", customers)


@query(
    "K2_key_changes",
    f"""select b.id, 'status' as property, 'key changed' as rule, a.status as value from {_B} b join {_A} a on a.id = b.id where a.status <> b.status
        union all select b.id, 'orderdate', 'key changed', a.orderdate::varchar from {_B} b join {_A} a on a.id = b.id where a.orderdate <> b.orderdate""",
)
def key_changes(t: Tables) -> DataFrame:
    before, after, _ = _docs(t)
    return validate.key_changes(before, after, ClassDef("Order", key="Lexical", key_fields=("status", "priority", "orderdate")))


_FRAMED = ("Nation", "Customer", "Order")


@query(
    "K3_class_frame",
    " union all ".join(
        f"select '{cls}' as class, '{p.name}' as property, '{p.range}' as range, count(\"{p.name}\") as facts from {class_sql(cls)}"
        for cls in _FRAMED
        for p in views.SCHEMA.properties(cls).values()
    ),
)
def class_frame(t: Tables) -> DataFrame:
    """The properties of classes with the number of facts each has."""
    facts = graph(t, *_FRAMED).quads()
    kind = F.split_part("s", F.lit("/"), F.lit(1))
    held = facts.groupBy(kind.alias("class"), F.col("p").alias("property")).agg(F.count(F.lit(1)).alias("facts"))
    frame = views.SCHEMA.frame_table(t.spark).where(F.col("class").isin(*_FRAMED))
    joined = frame.join(held, ["class", "property"], "left")
    return joined.select("class", "property", "range", F.coalesce("facts", F.lit(0)).alias("facts"))


def _inferred_sql(cls: str, table: str, columns: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{cls}' as class, '{c}' as property, '{r}' as range, count(*) > count({c}) as nullable from {table}" for c, r in columns.items()
    )


@query(
    "K4_infer_class",
    _inferred_sql(
        "Orders",
        "orders",
        {
            "o_orderkey": "xsd:integer", "o_custkey": "xsd:integer", "o_orderstatus": "xsd:string", "o_totalprice": "xsd:double",
            "o_orderdate": "xsd:dateTime", "o_orderpriority": "xsd:string",
        },
    ),
)
def infer_class(t: Tables) -> DataFrame:
    return validate.class_table(t.orders, "Orders")


@query(
    "K4_infer_class_from_text",
    """select 'Visit' as class, p as property, r as range, n as nullable from (
         select 'event_id' as p, 'xsd:integer' as r, false as n union all select 'ts', 'xsd:dateTime', false
         union all select 'event_type', 'xsd:string', false
         union all select 'value', 'xsd:double', count(*) filter (where event_type = 'error') > 0 from events)""",
)
def infer_class_from_text(t: Tables) -> DataFrame:
    """Datatypes found in text columns."""
    value = F.when(F.col("event_type") != "error", F.col("value"))
    texts = t.events.withColumn("value", value).select(
        *[F.col(c).cast("string").alias(c) for c in ("event_id", "ts", "event_type", "value")]
    )
    return validate.class_table(texts, "Visit")


@query(
    "K6_resolve_references",
    """select 'Customer/' || c_custkey as id, null as customer from customer
       union all select 'Order/' || o_orderkey, 'Customer/' || o_custkey from orders""",
)
def resolve_references(t: Tables) -> DataFrame:
    """One batch in which orders refer to customers by capture name."""
    mark = lambda c: F.concat(F.lit("new"), F.col(c).cast("string"))
    none = F.lit(None).cast("string")
    people = t.customer.select(
        F.concat(F.lit("Customer/"), F.col("c_custkey").cast("string")).alias("id"), mark("c_custkey").alias("capture"), none.alias("customer")
    )
    bought = t.orders.select(
        F.concat(F.lit("Order/"), F.col("o_orderkey").cast("string")).alias("id"), none.alias("capture"), mark("o_custkey").alias("customer")
    )
    return docs.resolve_references(people.unionByName(bought), ["customer"])


@query("A9_raw_json", "select event_id as event, (props->>'$.k')::bigint as k from events")
def raw_json(t: Tables) -> DataFrame:
    stored = docs.raw_json(t.events.select(F.col("event_id").alias("event"), F.col("props").alias("body")))
    return stored.select("event", F.try_variant_get("body", "$.k", "bigint").alias("k"))


# Prefixes and streams -----------------------------------------------------------------------------------

_SPACES = {**triples.PREFIXES, "base": "https://example.org/data/"}


@query(
    "L1_expand",
    f"""select case when p = 'rdf:type' then 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' else 'https://example.org/data/' || p end as pred,
          case when p = 'rdf:type' then p else 'base:' || p end as short, count(*) as n
        from {facts_sql('Customer', 'Order')} group by p""",
)
def expand(t: Tables) -> DataFrame:
    facts = graph(t, "Customer", "Order").quads()
    short = F.when(F.col("p") == "rdf:type", F.lit("type")).otherwise(F.concat(F.lit("base:"), "p"))
    full: Column = triples.expand(short, _SPACES, triples.SHORT_NAMES)
    counted = facts.groupBy(full.alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("short", triples.compact(F.col("pred"), _SPACES))


@query("A13_stream_append", "select doc_id, lang, md5(text) as digest from documents")
def stream_append(t: Tables) -> DataFrame:
    """Documents that arrive as JSON files, appended to a table by a stream."""
    arrived, table = t.scratch(), t.scratch()
    json_lines.write_documents(t.documents, arrived)
    stream = streams.stream_documents(t.spark, arrived, t.documents.schema)
    streams.append_documents(stream, table, t.scratch())
    return t.spark.read.parquet(table).select("doc_id", "lang", F.md5("text").alias("digest"))
