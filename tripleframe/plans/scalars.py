"""Queries over column functions: text, arithmetic, dates, durations, intervals, dictionaries and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleframe.functions import dates, ids, lists, math, text
from tripleframe.model import datetime, string
from tripleframe.operators import combine as c
from tripleframe.operators.spread import neighbours
from tripleframe.plans.registry import Tables, query
from tripleframe.plans.views import class_sql, class_table
from tripleframe.session import cut

MONEY = "decimal(12,2)"


# Text -------------------------------------------------------------------------------------------------


@query("F1_upper", "select p_partkey as part, upper(p_name) as name from part")
def upper(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("part"), text.upper("v:p_name").alias("name"))


@query("F2_lower", "select p_partkey as part, lower(p_type) as name from part")
def lower(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("part"), text.lower("v:p_type").alias("name"))


@query(
    "F3_trim",
    r"select doc_id as doc, regexp_replace(chr(9) || ' ' || text || chr(10) || ' ', '^\s+|\s+$', '', 'g') as trimmed from documents",
)
def trim(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("\t "), "text", F.lit("\n "))
    return t.documents.select(F.col("doc_id").alias("doc"), text.trim(padded).alias("trimmed"))


@query("F4_pad", "select p_partkey as part, rpad(p_name, 12, '*') as name, rpad(p_name, 4, '*') as short from part")
def pad(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("part"), text.pad("v:p_name", "*", 12).alias("name"), text.pad("v:p_name", "*", 4).alias("short")
    )


@query(
    "F5_substr",
    "select p_partkey as part, substr(p_name, 3, 4) as piece, (length(p_name) - 6)::int as after from part where length(p_name) >= 6",
)
def substr(t: Tables) -> DataFrame:
    df = t.part.select(
        F.col("p_partkey").alias("part"),
        text.substr("v:p_name", 4, 2).alias("piece"),
        text.substr_after("v:p_name", 4, 2).alias("after"),
    )
    return c.drop_unbound(df, "v:piece")


@query(
    "F5_substr_generate",
    """select part, before::int as before, substr(p_name, before + 1, 3) as piece, (length(p_name) - before - 3)::int as after
       from (select p_partkey as part, p_name, unnest(range(0, length(p_name) - 2)) as before from part)""",
)
def substr_generate(t: Tables) -> DataFrame:
    df = t.part.select(F.col("p_partkey").alias("part"), "p_name")
    out = text.substrings(df, "p_name", "piece", "before", "length", "after", fixed_length=3)
    return out.select("part", "before", "piece", "after")


@query(
    "F5_substring_positions",
    """select part, before::int as before from (select p_partkey as part, p_name, unnest(range(0, length(p_name))) as before from part)
       where substr(p_name, before + 1, 2) = 'in'""",
)
def substring_positions(t: Tables) -> DataFrame:
    df = t.part.select(F.col("p_partkey").alias("part"), "p_name")
    return text.substring_positions(df, "v:p_name", "in", "before", "after").select("part", "before")


# Arithmetic -------------------------------------------------------------------------------------------


def _line(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.col("l_quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.col("l_discount").cast(MONEY).alias("discount"),
        F.col("l_tax").cast(MONEY).alias("tax"),
    )


_KEYS = "l_orderkey, l_partkey, l_linenumber"
_KEY_COLS = ["l_orderkey", "l_partkey", "l_linenumber"]


@query("F10_eval", f"select {_KEYS}, (l_extendedprice::{MONEY} * (1 - l_discount::{MONEY}))::double as revenue from lineitem")
def eval_(t: Tables) -> DataFrame:
    one = F.lit(1).cast(MONEY)
    revenue = math.times("v:price", math.minus(one, "v:discount")).cast("double")
    return math.evaluate(_line(t), revenue, "v:revenue").select(*_KEY_COLS, "revenue")


@query("F11_plus", f"select {_KEYS}, l_orderkey + l_partkey + l_linenumber as total from lineitem")
def plus(t: Tables) -> DataFrame:
    return math.evaluate(_line(t), math.plus("v:l_orderkey", "v:l_partkey", "v:l_linenumber"), "v:total").select(*_KEY_COLS, "total")


@query("F12_minus", f"select {_KEYS}, l_orderkey - l_partkey - l_linenumber as rest from lineitem")
def minus(t: Tables) -> DataFrame:
    return math.evaluate(_line(t), math.minus("v:l_orderkey", "v:l_partkey", "v:l_linenumber"), "v:rest").select(*_KEY_COLS, "rest")


@query("F13_times", f"select {_KEYS}, l_quantity * l_linenumber * 2 as product from lineitem")
def times(t: Tables) -> DataFrame:
    return math.evaluate(_line(t), math.times("v:l_quantity", "v:l_linenumber", 2), "v:product").select(*_KEY_COLS, "product")


@query(
    "F14_divide",
    f"select {_KEYS}, l_quantity / l_linenumber / (l_linenumber - 1) as share from lineitem where l_linenumber <> 1",
)
def divide(t: Tables) -> DataFrame:
    share = math.divide("v:l_quantity", "v:l_linenumber", F.col("l_linenumber") - 1)
    return math.evaluate(_line(t), share, "v:share").select(*_KEY_COLS, "share")


@query(
    "F15_div",
    f"select {_KEYS}, (5 - l_partkey) // l_linenumber // 2 as whole from lineitem",
)
def div(t: Tables) -> DataFrame:
    whole = math.div(5 - F.col("l_partkey"), "v:l_linenumber", F.lit(2))
    return math.evaluate(_line(t), whole, "v:whole").select(*_KEY_COLS, "whole")


@query("F16_exp", f"select {_KEYS}, pow(l_linenumber::double, 3) as cube from lineitem")
def exp(t: Tables) -> DataFrame:
    return math.evaluate(_line(t), math.exp("v:l_linenumber", 3), "v:cube").select(*_KEY_COLS, "cube")


@query("F17_floor", f"select {_KEYS}, floor(l_quantity / 7)::bigint as weeks from lineitem")
def floor(t: Tables) -> DataFrame:
    return math.evaluate(_line(t), math.floor(F.col("l_quantity") / 7), "v:weeks").select(*_KEY_COLS, "weeks")


@query(
    "F18_sequence",
    "select p_partkey as part, unnest(range(0, p_size, 5)) as step, len(range(0, p_size, 5))::int as n from part",
)
def sequence(t: Tables) -> DataFrame:
    df = t.part.select(F.col("p_partkey").alias("part"), F.col("p_size").cast("bigint").alias("size"))
    out = math.sequence(df, "v:step", F.lit(0).cast("bigint"), "v:size", F.lit(5).cast("bigint"), count="v:n")
    return c.select(out, "v:part", "v:step", "v:n")


@query(
    "F18_sequence_dates",
    """select o_orderkey as doc, strftime(unnest(range(o_orderdate, o_orderdate + interval 5 day, interval 1 day)), '%Y-%m-%d') as day from orders""",
)
def sequence_dates(t: Tables) -> DataFrame:
    df = t.orders.select(F.col("o_orderkey").alias("doc"), F.to_date("o_orderdate").alias("d"))
    out = math.sequence(df, "v:day", "v:d", F.date_add("d", 5), count=5)
    return out.select("doc", F.col("day").cast("string").alias("day"))


# Calendar ---------------------------------------------------------------------------------------------


def _dated(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("doc"), F.to_date("o_orderdate").alias("d"))


def _text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


@query("F20_month_start_date", "select o_orderkey as doc, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as first from orders")
def month_start_date(t: Tables) -> DataFrame:
    month = F.date_format("d", "yyyy-MM")
    return _dated(t).select("doc", dates.month_start_date(month).cast("string").alias("first"))


@query("F21_month_end_date", "select o_orderkey as doc, last_day(o_orderdate)::varchar as last from orders")
def month_end_date(t: Tables) -> DataFrame:
    month = F.date_format("d", "yyyy-MM")
    return _dated(t).select("doc", dates.month_end_date(month).cast("string").alias("last"))


@query(
    "F22_month_start_dates",
    """select doc, first::date::varchar as first from (select o_orderkey as doc, o_orderdate::date as d,
         unnest(range(date_trunc('month', o_orderdate)::timestamp, (o_orderdate::date + 100)::timestamp, interval 1 month)) as first from orders)
       where first >= d and first < d + 100""",
)
def month_start_dates(t: Tables) -> DataFrame:
    out = dates.month_start_dates(_dated(t), "v:first", "v:d", F.date_add("d", 100))
    return out.select("doc", _text("first"))


@query(
    "F23_month_end_dates",
    """select doc, last_day(first)::varchar as last from (select o_orderkey as doc, o_orderdate::date as d,
         unnest(range(date_trunc('month', o_orderdate)::timestamp, (o_orderdate::date + 100)::timestamp, interval 1 month)) as first from orders)
       where last_day(first) >= d and last_day(first) < d + 100""",
)
def month_end_dates(t: Tables) -> DataFrame:
    out = dates.month_end_dates(_dated(t), "v:last", "v:d", F.date_add("d", 100))
    return out.select("doc", _text("last"))


@query("F24_day_after", "select o_orderkey as doc, (o_orderdate::date + 1)::varchar as following, o_orderdate::date::varchar as back from orders")
def day_after(t: Tables) -> DataFrame:
    df = dates.day_after(_dated(t), "v:d", "v:following").drop("d")
    return dates.day_after(df, "v:back", "v:following").select("doc", _text("following"), _text("back"))


@query("F25_day_before", "select o_orderkey as doc, (o_orderdate::date - 1)::varchar as previous, o_orderdate::date::varchar as back from orders")
def day_before(t: Tables) -> DataFrame:
    df = dates.day_before(_dated(t), "v:d", "v:previous").drop("d")
    return dates.day_before(df, "v:back", "v:previous").select("doc", _text("previous"), _text("back"))


@query("F26_weekday", "select o_orderkey as doc, isodow(o_orderdate)::int as weekday from orders")
def weekday(t: Tables) -> DataFrame:
    return _dated(t).select("doc", dates.weekday("v:d").alias("weekday"))


@query("F27_weekday_sunday_start", "select o_orderkey as doc, (dayofweek(o_orderdate) + 1)::int as weekday from orders")
def weekday_sunday_start(t: Tables) -> DataFrame:
    return _dated(t).select("doc", dates.weekday_sunday_start("v:d").alias("weekday"))


@query("F28_iso_week", "select o_orderkey as doc, isoyear(o_orderdate)::int as year, weekofyear(o_orderdate)::int as week from orders")
def iso_week(t: Tables) -> DataFrame:
    return _dated(t).select("doc", dates.iso_year("v:d").alias("year"), dates.iso_week("v:d").alias("week"))


# Durations and intervals --------------------------------------------------------------------------------


def _plus_month_sql(d: str, n: int) -> str:
    shift = f"({d} + interval ({n}) month)::date"
    return f"case when {d} = last_day({d}) then last_day({shift}) else {shift} end"


@query(
    "F29_date_duration_end",
    f"select o_orderkey as doc, ({_plus_month_sql('o_orderdate::date', 1)})::varchar as finish from orders",
)
def date_duration_end(t: Tables) -> DataFrame:
    df = _dated(t).withColumn("duration", F.lit("P1M"))
    return dates.date_duration(df, "v:d", "v:finish", "v:duration").select("doc", _text("finish"))


@query(
    "F29_date_duration_start",
    f"select o_orderkey as doc, ({_plus_month_sql('o_orderdate::date', -1)})::varchar as begin from orders",
)
def date_duration_start(t: Tables) -> DataFrame:
    df = _dated(t).withColumn("duration", F.lit("P1M"))
    return dates.date_duration(df, "v:begin", "v:d", "v:duration").select("doc", _text("begin"))


_NEXT_SQL = """(select o_orderkey as doc, o_custkey as customer, o_orderdate as x,
  lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as y from orders)"""


def _consecutive(t: Tables) -> DataFrame:
    """Each order with the date of the customer's next order."""
    at = t.orders.select("o_custkey", F.struct("o_orderdate", "o_orderkey").alias("at"))
    rows = neighbours(at, ["o_custkey"], "at", following="next").where(F.col("next").isNotNull())
    return rows.select(
        F.col("at.o_orderkey").alias("doc"), F.col("at.o_orderdate").alias("x"), F.col("next.o_orderdate").alias("y")
    )


@query(
    "F29_date_duration_between",
    f"select doc, 'P' || date_diff('day', x, y) || 'D' as duration from {_NEXT_SQL} where y is not null",
)
def date_duration_between(t: Tables) -> DataFrame:
    return dates.date_duration(_consecutive(t), "v:x", "v:y", "v:duration").select("doc", "duration")


_EVENT_GAP = """(select event_id, user_id, ts, epoch_us(lead(ts) over (partition by user_id order by ts)) - epoch_us(ts) as gap from events)"""


@query(
    "F29_date_duration_time",
    f"""select event_id as event, 'P' || case when gap // 86400000000 > 0 then (gap // 86400000000) || 'D' else '' end || 'T'
          || case when gap // 3600000000 % 24 > 0 then (gap // 3600000000 % 24) || 'H' else '' end
          || case when gap // 60000000 % 60 > 0 then (gap // 60000000 % 60) || 'M' else '' end
          || (gap // 1000000 % 60) || case when gap % 1000000 > 0 then '.' || rtrim(lpad((gap % 1000000)::varchar, 6, '0'), '0') else '' end || 'S'
          as duration
        from {_EVENT_GAP} where gap is not null""",
)
def date_duration_time(t: Tables) -> DataFrame:
    at = t.events.select("user_id", F.struct("ts", "event_id").alias("at"))
    rows = neighbours(at, ["user_id"], "at", following="next").where(F.col("next").isNotNull())
    df = rows.select(F.col("at.event_id").alias("event"), F.col("at.ts").alias("x"), F.col("next.ts").alias("y"))
    return dates.date_duration(df, "v:x", "v:y", "v:duration").select("event", "duration")


@query(
    "F29_date_duration_check",
    f"select doc from {_NEXT_SQL} where date_diff('day', x, y) = 30",
)
def date_duration_check(t: Tables) -> DataFrame:
    df = _consecutive(t).withColumn("duration", F.lit("P30D"))
    return dates.date_duration(df, "v:x", "v:y", "v:duration").select("doc")


@query(
    "F30_interval",
    "select o_orderkey as doc, strftime(o_orderdate, '%Y-%m-%d') || '/' || strftime(o_orderdate + interval 36 hour, '%Y-%m-%dT%H:%M:%SZ') as span from orders",
)
def interval(t: Tables) -> DataFrame:
    df = _dated(t).withColumn("y", F.col("d").cast("timestamp_ntz") + F.expr("interval 36 hour"))
    return dates.interval(df, "v:d", "v:y", "v:span").select("doc", "span")


@query(
    "F30_interval_split",
    "select o_orderkey as doc, strftime(o_orderdate, '%Y-%m-%d') as x, strftime(o_orderdate + interval 36 hour, '%Y-%m-%dT%H:%M:%SZ') as y, 'xsd:dateTime' as kind from orders",
)
def interval_split(t: Tables) -> DataFrame:
    df = interval(t)
    return dates.interval(df, "v:x", "v:y", "v:span").select("doc", "x", "y", dates.endpoint_type("v:y").alias("kind"))


@query(
    "F31_interval_start_duration",
    "select o_orderkey as doc, strftime(o_orderdate, '%Y-%m-%d') || '/' || strftime(o_orderdate + interval 90 day, '%Y-%m-%d') as span, 'P90D' as back from orders",
)
def interval_start_duration(t: Tables) -> DataFrame:
    df = dates.interval_start_duration(_dated(t).withColumn("n", F.lit("P90D")), "v:d", "v:n", "v:span")
    return dates.interval_start_duration(df, "v:begin", "v:back", "v:span").select("doc", "span", "back")


@query(
    "F32_interval_duration_end",
    "select o_orderkey as doc, strftime(o_orderdate - interval 90 day, '%Y-%m-%d') || '/' || strftime(o_orderdate, '%Y-%m-%d') as span, 'P90D' as back from orders",
)
def interval_duration_end(t: Tables) -> DataFrame:
    df = dates.interval_duration_end(_dated(t).withColumn("n", F.lit("P90D")), "v:n", "v:d", "v:span")
    return dates.interval_duration_end(df, "v:back", "v:finish", "v:span").select("doc", "span", "back")


_ALLEN_SQL = """case when b < c then 'before' when b = c then 'meets' when a > d then 'after' when a = d then 'met_by'
  when a = c and b = d then 'equals' when a = c and b < d then 'starts' when a = c then 'started_by'
  when b = d and a > c then 'finishes' when b = d then 'finished_by' when a > c and b < d then 'during'
  when a < c and b > d then 'contains' when a < c then 'overlaps' else 'overlapped_by' end"""


@query(
    "F33_interval_relation",
    f"""select doc, {_ALLEN_SQL} as relation from (select doc, x as a, y as b, timestamp '1997-01-01' as c, timestamp '1998-01-01' as d
        from {_NEXT_SQL} where y > x)""",
)
def interval_relation(t: Tables) -> DataFrame:
    df = _consecutive(t).where("y > x")
    year = [F.lit(v).cast("timestamp_ntz") for v in ("1997-01-01", "1998-01-01")]
    return df.select("doc", dates.interval_relation("v:x", "v:y", *year).alias("relation"))


@query(
    "F34_interval_relation_typed",
    f"""select doc, {_ALLEN_SQL} as relation from (select doc, x as a, y as b, date_trunc('year', x)::timestamp as c,
          (date_trunc('year', x) + interval 1 year)::timestamp as d from {_NEXT_SQL} where y > x)""",
)
def interval_relation_typed(t: Tables) -> DataFrame:
    df = dates.interval(_consecutive(t).where("y > x"), "v:x", "v:y", "v:span")
    first = F.trunc("x", "YEAR").cast("date")
    year = dates.interval_text(first.cast("string"), F.add_months(first, 12).cast("string"))
    return df.select("doc", dates.interval_relation_typed("v:span", year).alias("relation"))


@query(
    "F34_interval_relation_test",
    f"select doc from {_NEXT_SQL} where y > x and x > timestamp '1997-01-01' and y < timestamp '1998-01-01'",
)
def interval_relation_test(t: Tables) -> DataFrame:
    year = [F.lit(v).cast("timestamp_ntz") for v in ("1997-01-01", "1998-01-01")]
    return _consecutive(t).where("y > x").where(dates.holds("during", "v:x", "v:y", *year)).select("doc")


@query(
    "F35_literals",
    "select o_orderkey as doc from orders where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1998-01-01' and o_orderstatus = 'F'",
)
def literals(t: Tables) -> DataFrame:
    df = c.in_range(t.orders, "v:o_orderdate", datetime("1997-01-01T00:00:00Z"), datetime("1998-01-01T00:00:00Z"))
    return c.eq(df, "v:o_orderstatus", string("F")).select(F.col("o_orderkey").alias("doc"))


# Dictionaries and ids -----------------------------------------------------------------------------------


@query("F40_dot", "select event_id as event, (props->>'$.k')::bigint as k from events where props->>'$.k' is not null")
def dot(t: Tables) -> DataFrame:
    df = t.events.select(F.col("event_id").alias("event"), lists.dot(lists.JsonText("v:props"), "k", "bigint").alias("k"))
    return c.drop_unbound(df, "v:k")


@query("F40_dot_struct", "select o_orderkey as doc, o_orderstatus as status from orders")
def dot_struct(t: Tables) -> DataFrame:
    df = t.orders.select(F.col("o_orderkey").alias("doc"), F.struct(F.col("o_orderstatus").alias("status")).alias("d"))
    return df.select("doc", lists.dot("v:d", "status").alias("status"))


@query(
    "F41_doc",
    "select p_partkey as part, json_object('name', p_name, 'size', p_size, 'words', string_split(p_name, ' '))::varchar as body from part",
)
def doc(t: Tables) -> DataFrame:
    body = F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("size"), text.split("v:p_name", " ").alias("words"))
    return t.part.select(F.col("p_partkey").alias("part"), F.to_json(body).alias("body"))


@query(
    "F42_idgen",
    "select p_partkey as part, 'base.url_' || p_partkey || '_' || replace(p_name, ' ', '%20') || '_' || replace(p_brand, '#', '%23') as doc from part",
)
def idgen(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("part"), ids.idgen("base.url", ["v:p_partkey", "v:p_name", "v:p_brand"]).alias("doc"))


@query("F43_unique", "select p_partkey as part, 'base.url' || md5(p_name || p_partkey) as doc from part")
def unique(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("part"), ids.unique("base.url", ["v:p_name", "v:p_partkey"]).alias("doc"))


_RANDOM_SQL = """select count(*) as n, count(*) as distinct_ids, count(*) as well_formed from {table}"""


def _random_told(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """What can be foretold of random ids: how many, how many different ones, and how many of the right form."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(column).alias("distinct_ids"), F.count_if(F.col(column).rlike(pattern)).alias("well_formed"))


@query("F44_idgen_random_form", _RANDOM_SQL.format(table="part"))
def idgen_random_form(t: Tables) -> DataFrame:
    return _random_told(idgen_random(t), "doc", "^Part/[A-Za-z0-9_-]{16}$")


@query("F44_idgen_random")
def idgen_random(t: Tables) -> DataFrame:
    return cut(t.part.select(F.col("p_partkey").alias("part"), ids.random_id("Part/").alias("doc")))


@query(
    "F45_value_hash",
    f"""select 'Customer/' || sha256(json_object('acctbal', acctbal, 'name', name, 'nation', nation, 'segment', segment)::varchar) as id
        from {class_sql('Customer')}""",
)
def value_hash(t: Tables) -> DataFrame:
    return class_table(t, "Customer").select(ids.value_hash("Customer", ["name", "nation", "acctbal", "segment"]).alias("id"))


@query(
    "K5_assign_ids_lexical",
    "select 'Order/' || o_orderkey || '_' || replace(o_orderpriority, ' ', '%20') as id, o_orderkey, o_orderpriority from orders",
)
def assign_ids_lexical(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", "o_orderpriority")
    return ids.assign_ids(df, "Order", "Lexical", ["o_orderkey", "o_orderpriority"])


@query(
    "K5_assign_ids_hash",
    "select 'Order/' || sha256(o_orderkey || '_' || replace(o_orderpriority, ' ', '%20')) as id, o_orderkey, o_orderpriority from orders",
)
def assign_ids_hash(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", "o_orderpriority")
    return ids.assign_ids(df, "Order", "Hash", ["o_orderkey", "o_orderpriority"])


@query(
    "K5_assign_ids_value_hash",
    """select 'Order/' || sha256(json_object('o_orderkey', o_orderkey, 'o_orderpriority', o_orderpriority)::varchar) as id, o_orderkey, o_orderpriority
       from orders""",
)
def assign_ids_value_hash(t: Tables) -> DataFrame:
    return ids.assign_ids(t.orders.select("o_orderkey", "o_orderpriority"), "Order", "ValueHash")


@query("K5_assign_ids_random_form", _RANDOM_SQL.format(table="orders"))
def assign_ids_random_form(t: Tables) -> DataFrame:
    return _random_told(assign_ids_random(t), "id", "^Order/[A-Za-z0-9_-]{16}$")


@query("K5_assign_ids_random")
def assign_ids_random(t: Tables) -> DataFrame:
    return ids.assign_ids(t.orders.select("o_orderkey", "o_orderpriority"), "Order", "Random")
