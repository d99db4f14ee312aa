"""Projection, filters, joins, union and negation over binding frames.

A binding frame is an ordinary DataFrame: one column per variable, a bag of rows, null = unbound. Columns
that may hold unbound values carry a mark in their metadata, so joins only pay for them where needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleframe.model import Schema, column, names, variable
from tripleframe.operators.spread import number_rows, slices
from tripleframe.session import cut, cut_counted

_MARK = "maybe_unbound"


def maybe_unbound(df: DataFrame) -> set[str]:
    """Columns marked as possibly unbound."""
    return {f.name for f in df.schema.fields if f.metadata.get(_MARK)}


def mark_unbound(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mark columns as possibly unbound."""
    cols = set(cols)
    return df.select([F.col(c).alias(c, metadata={_MARK: True}) if c in cols else F.col(c) for c in df.columns])


def mark_bound(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Remove the mark, after a filter that rules unbound values out."""
    cols = set(cols)
    return df.select([F.col(c).alias(c, metadata={}) if c in cols else F.col(c) for c in df.columns])


# Projection -----------------------------------------------------------------------------------------


def select(df: DataFrame, *variables: Any) -> DataFrame:
    """Keep the named variables, one row per solution; without names each solution is an empty row."""
    return df.select(*[F.col(n) for n in names(variables)])


def distinct(df: DataFrame, *variables: Any) -> DataFrame:
    """One solution per value of the variables: the smallest by the order of the other columns."""
    keys = names(variables) or df.columns
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    if len(rest) == 1:
        # One other column needs no struct, so the aggregation is hash-based; unbound comes first.
        low = df.groupBy(*keys).agg(F.min(rest[0]).alias("_low"), F.max(F.col(rest[0]).isNull()).alias("_none"))
        value = F.when(~F.col("_none"), F.col("_low"))
        return low.select(*[value.alias(c) if c == rest[0] else F.col(c) for c in df.columns])
    best = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def once(df: DataFrame, *per: Any) -> DataFrame:
    """At most one solution, or at most one per value of the variables of an outer query."""
    return distinct(df, *per) if per else df.limit(1)


def true(spark: Any) -> DataFrame:
    """One solution without variables."""
    return spark.range(1).select()


# Filters and binding --------------------------------------------------------------------------------


def eq(df: DataFrame, left: Any, right: Any) -> DataFrame:
    """Unify two operands: compare bound ones, bind a variable that has no column yet."""
    free_left = variable(left) is not None and variable(left) not in df.columns
    free_right = variable(right) is not None and variable(right) not in df.columns
    if free_left and free_right:
        raise ValueError("both sides of eq are unbound")
    if free_left:
        return df.withColumn(variable(left), _operand(df, right))
    if free_right:
        return df.withColumn(variable(right), _operand(df, left))
    if not _alike(df, left, right):
        return df.where(F.lit(False))
    return df.where(_operand(df, left) == _operand(df, right))


def family(kind: T.DataType) -> str:
    """Values are compared within a family of types; between families nothing is equal or ordered."""
    if isinstance(kind, T.NumericType):
        return "number"
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return "moment"
    return kind.typeName()


def _alike(df: DataFrame, *args: Any) -> bool:
    """Whether operands are of one family of types; values of unlike types are never equal and have no order."""
    kinds = df.select(*[_operand(df, a).alias(f"_{i}") for i, a in enumerate(args)]).schema
    return len({family(f.dataType) for f in kinds if not isinstance(f.dataType, T.NullType)}) <= 1


def _alike_item(df: DataFrame, element: Any, items: Column) -> bool:
    return _alike(df, element, F.element_at(items, 1))


def _operand(df: DataFrame, arg: Any) -> Column:
    if isinstance(arg, str) and variable(arg) is None:
        return F.lit(arg)
    if isinstance(arg, (list, tuple)):
        return F.array(*[_operand(df, a) for a in arg])
    return column(arg)


def _compare(test: str) -> Any:
    tests = {
        "<": lambda a, b: a < b,
        ">": lambda a, b: a > b,
        "<=": lambda a, b: a <= b,
        ">=": lambda a, b: a >= b,
    }

    def apply(df: DataFrame, left: Any, right: Any) -> DataFrame:
        if not _alike(df, left, right):
            return df.where(F.lit(False))
        return df.where(tests[test](_operand(df, left), _operand(df, right)))

    return apply


less, greater, lte, gte = _compare("<"), _compare(">"), _compare("<="), _compare(">=")


def in_range(df: DataFrame, value: Any, start: Any, end: Any) -> DataFrame:
    """``start <= value < end``; values of unlike types are in no range."""
    if not _alike(df, value, start, end):
        return df.where(F.lit(False))
    v = _operand(df, value)
    return df.where((v >= _operand(df, start)) & (v < _operand(df, end)))


def drop_unbound(df: DataFrame, *variables: Any) -> DataFrame:
    """Drop solutions in which a goal failed, that is where its variable is null."""
    return df.where(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names(variables)]))


def member(df: DataFrame, element: Any, mem_list: Any) -> DataFrame:
    """One solution per list element; a bound element keeps one solution per equal element."""
    items = column(mem_list)
    name = variable(element)
    if name is not None and name not in df.columns:
        return df.select("*", F.explode(items).alias(name))
    if not _alike_item(df, element, items):
        return df.where(F.lit(False))
    value = _operand(df, element)
    copies = df.withColumn("_hit", F.explode(F.filter(items, lambda x: x == value)))
    return copies.drop("_hit")


def set_member(df: DataFrame, element: Any, set_list: Any) -> DataFrame:
    """Keep solutions whose element is in the set; a set of unlike type holds nothing equal."""
    if not _alike_item(df, element, column(set_list)):
        return df.where(F.lit(False))
    return df.where(F.array_contains(column(set_list), _operand(df, element)))


def isa(df: DataFrame, element: Any, of_type: str, types: DataFrame, schema: Schema) -> DataFrame:
    """Keep solutions whose element is an instance of a class or of one of its subclasses.

    ``types`` holds (s, o) pairs of element and class.
    """
    name = names([element])[0]
    wanted = [c for c in schema.classes if of_type in schema.ancestors(c)] or [of_type]
    hits = types.where(F.col("o").isin(wanted)).select(F.col("s").alias(name)).distinct()
    return df.join(hits, name, "left_semi")


def subsumption(df: DataFrame, parent: Any, child: Any, schema: Schema) -> DataFrame:
    """Relate parent and child classes; an unbound side is generated."""
    pairs = schema.closure(df.sparkSession)
    cols = []
    for source, arg in (("parent", parent), ("child", child)):
        name = variable(arg)
        if name is None:
            pairs = pairs.where(F.col(source) == arg)
        else:
            cols.append(F.col(source).alias(name))
    return and_(df, pairs.select(*cols)) if cols else df.join(pairs.limit(1).select(F.lit(1)), how="left_semi")


def type_of(df: DataFrame, value: Any, vtype: Any) -> DataFrame:
    """Bind the literal datatype of a column."""
    from tripleframe.model import literal_type

    name = names([value])[0]
    return eq(df, vtype, F.lit(literal_type(df.schema[name].dataType.simpleString())))


def cast(df: DataFrame, val: Any, user_type: str, result: Any) -> DataFrame:
    """Bind a value converted to a datatype; solutions that do not convert are dropped."""
    from tripleframe.model import SPARK_TYPES

    name = names([result])[0]
    return drop_unbound(df.withColumn(name, column(val).try_cast(SPARK_TYPES.get(user_type, user_type))), name)


def like(df: DataFrame, left: Any, right: Any, dist: Any, method: str = "edit") -> DataFrame:
    """Bind the similarity of two texts, or keep those at least as similar as a bound number."""
    from tripleframe.functions.text import hamming, similarity

    value = similarity(_operand(df, left), _operand(df, right))
    if method == "hamming":
        value = hamming(_operand(df, left), _operand(df, right))
    name = variable(dist)
    return df.where(value >= F.lit(dist)) if name is None else df.withColumn(name, value)


def regexp(df: DataFrame, pattern: str, text: Any, found: Any = None) -> DataFrame:
    """Keep solutions whose text matches; bind the list of the match and its groups."""
    import re

    kept = df.where(_operand(df, text).rlike(pattern))
    if found is None:
        return kept
    groups = range(re.compile(pattern).groups + 1)
    parts = F.array(*[F.regexp_extract(_operand(df, text), pattern, g) for g in groups])
    return kept.withColumn(names([found])[0], parts)


# Joins ----------------------------------------------------------------------------------------------


def _shared(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c in right.columns]


def _flags(left: DataFrame, right: DataFrame, shared: Sequence[str]) -> tuple[list[str], list[str]]:
    lu, ru = maybe_unbound(left), maybe_unbound(right)
    return [c for c in shared if c in lu], [c for c in shared if c in ru]


def _with_mask(df: DataFrame, flags: Sequence[str], mask: Sequence[bool]) -> DataFrame:
    for name, unbound in zip(flags, mask):
        df = df.where(F.col(name).isNull() if unbound else F.col(name).isNotNull())
    return df


def _masks(flags: Sequence[str]) -> list[tuple[bool, ...]]:
    return list(product((False, True), repeat=len(flags)))


def _join(left: DataFrame, right: DataFrame, pairs: bool) -> DataFrame:
    if not right.columns or not left.columns:
        # A frame without variables only says whether there is a solution; one row of it decides.
        held, test = (left, right) if not right.columns else (right, left)
        return held.join(F.broadcast(test.select(F.lit(1).alias("_any")).limit(1)), how="left_semi")
    shared = _shared(left, right)
    left_flags, right_flags = _flags(left, right, shared)
    if not pairs and not set(shared) - set(left_flags) - set(right_flags):
        raise ValueError("the patterns share no variable that is always bound: add one, or ask for all pairs")
    if not shared:
        return left.join(right, how="cross")
    unlike = [c for c in shared if family(left.schema[c].dataType) != family(right.schema[c].dataType)]
    if unlike:
        # Only a null agrees with a value of another family; as text of its own family no value equals one of the other.
        left, right = (
            df.withColumns({c: F.concat(F.lit(f"{family(df.schema[c].dataType)} "), F.col(c).cast("string")) for c in unlike}) for df in (left, right)
        )
        left, right = mark_unbound(left, left_flags), mark_unbound(right, right_flags)
        plain = {c: F.regexp_replace(c, "^[a-z]+ ", "") for c in unlike}
        joined = _join(left, right, pairs)
        return mark_unbound(joined.withColumns(plain), list(maybe_unbound(joined)))
    if not left_flags and not right_flags:
        return left.join(right, shared)
    unbound = maybe_unbound(left) | maybe_unbound(right)
    both = _routed(left, right, shared, left_flags, right_flags)
    still = [c for c in unbound if c not in shared or (c in left_flags and c in right_flags)]
    return mark_unbound(mark_bound(both, shared), still)


def _mask(flags: Sequence[str]) -> Column:
    """Which of the flagged columns are null, a bit each."""
    bits = [F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(flags)]
    return reduce(lambda a, b: a + b, bits, F.lit(0))


def _routed(left: DataFrame, right: DataFrame, shared: list[str], left_flags: list[str], right_flags: list[str]) -> DataFrame:
    """One equi-join over columns that may be unbound.

    A row is copied to every mask of nulls the other side may have. The key is the pair of masks and the shared columns that
    both masks leave bound, so rows meet exactly where they agree, and each input is read once.
    """

    def keyed(df: DataFrame, own: list[str], other: list[str], own_mask: str, other_mask: str, mark: str) -> DataFrame:
        every = F.array(*[F.lit(m) for m in range(1 << len(other))])
        df = df.withColumn(own_mask, _mask(own)).withColumn(other_mask, F.explode(every))
        keys = []
        for c in shared:
            null = F.col(c).isNull()
            if c in other:
                null = null | (F.col(other_mask).bitwiseAND(F.lit(1 << other.index(c))) != 0)
            keys.append((F.when(~null, F.col(c)) if c in left_flags + right_flags else F.col(c)).alias(f"{mark}{c}"))
        renamed = [F.col(c).alias(f"_v{mark}{c}") if c in shared else F.col(c) for c in df.columns if c not in (own_mask, other_mask)]
        return df.select(*renamed, *keys, F.col(own_mask).alias(f"{mark}{own_mask}"), F.col(other_mask).alias(f"{mark}{other_mask}"))

    mine = keyed(left, left_flags, right_flags, "_lm", "_rm", "_l_")
    theirs = keyed(right, right_flags, left_flags, "_rm", "_lm", "_r_")
    condition = (F.col("_l__lm") == F.col("_r__lm")) & (F.col("_l__rm") == F.col("_r__rm"))
    for c in shared:
        a, b = F.col(f"_l_{c}"), F.col(f"_r_{c}")
        condition = condition & (a.eqNullSafe(b) if c in left_flags + right_flags else a == b)
    out = [F.coalesce(f"_v_l_{c}", f"_v_r_{c}").alias(c) if c in shared else F.col(c) for c in left.columns]
    return mine.join(theirs, condition).select(*out, *[c for c in right.columns if c not in shared])


def and_(*frames: DataFrame, pairs: bool = False) -> DataFrame:
    """Natural join on the shared variables; an unbound value agrees with any value.

    Frames must share a variable that is always bound, whatever their sizes. ``pairs`` lifts that for frames the caller
    knows to be small, such as constants: then every solution meets every one it agrees with.
    """
    return reduce(lambda a, b: _join(a, b, pairs), frames)


def not_(df: DataFrame, sub: DataFrame) -> DataFrame:
    """Keep solutions for which the sub-query has none; binds nothing.

    Keys of the sub-query are made unique before the join, so a hot key there is one row.
    """
    shared = _shared(df, sub)
    left_flags, right_flags = _flags(df, sub, shared)
    parts = []
    for lm in _masks(left_flags):
        rest = _with_mask(df, left_flags, lm)
        for rm in _masks(right_flags):
            other = _with_mask(sub, right_flags, rm)
            nulls = {c for c, u in zip(left_flags, lm) if u} | {c for c, u in zip(right_flags, rm) if u}
            keys = [c for c in shared if c not in nulls]
            if keys:
                rest = rest.join(other.select(*keys).distinct(), keys, "left_anti")
            else:
                rest = rest.join(F.broadcast(other.select(F.lit(1).alias("_any")).limit(1)), how="left_anti")
        parts.append(rest)
    return reduce(lambda a, b: a.unionByName(b), parts)


def exists(df: DataFrame, sub: DataFrame) -> DataFrame:
    """Keep solutions for which the sub-query has at least one; binds nothing."""
    shared = _shared(df, sub)
    left_flags, right_flags = _flags(df, sub, shared)
    if shared and not left_flags and not right_flags:
        return df.join(sub.select(*shared).distinct(), shared, "left_semi")
    if not shared:
        return df.join(F.broadcast(sub.select(F.lit(1).alias("_any")).limit(1)), how="left_semi")
    # An agreeing solution exists exactly where negation drops the row.
    parts = []
    for lm in _masks(left_flags):
        mine = _with_mask(df, left_flags, lm)
        null_left = {c for c, u in zip(left_flags, lm) if u}
        found = mine.withColumn("_hit", F.lit(0))
        for rm in _masks(right_flags):
            null_right = {c for c, u in zip(right_flags, rm) if u}
            keys = [c for c in shared if c not in null_left | null_right]
            other = _with_mask(sub, right_flags, rm)
            if keys:
                marks = other.select(*keys).distinct().withColumn("_m", F.lit(1))
                found = found.join(marks, keys, "left")
            else:
                found = found.join(F.broadcast(other.select(F.lit(1).alias("_m")).limit(1)), how="left")
            found = found.withColumn("_hit", F.greatest("_hit", F.coalesce("_m", F.lit(0)))).drop("_m")
        parts.append(found.where("_hit = 1").select(*df.columns))
    return reduce(lambda a, b: a.unionByName(b), parts)


def opt(df: DataFrame, sub: DataFrame, pairs: bool = False) -> DataFrame:
    """Extend each solution by the sub-query where it matches, else leave its variables unbound; ``pairs`` as in ``and_``."""
    shared = _shared(df, sub)
    added = [c for c in sub.columns if c not in shared]
    left_flags, right_flags = _flags(df, sub, shared)
    if shared and not left_flags and not right_flags:
        return mark_unbound(df.join(sub, shared, "left").select(*df.columns, *added), added)
    matched = and_(df, sub, pairs=pairs)
    missed = not_(df, sub)
    for c in added:
        missed = missed.withColumn(c, F.lit(None).cast(sub.schema[c].dataType))
    out = matched.unionByName(missed)
    return mark_unbound(out, [*added, *maybe_unbound(df)])


def or_(*frames: DataFrame) -> DataFrame:
    """Bag union; variables a branch does not bind stay unbound."""
    every = list(dict.fromkeys(c for f in frames for c in f.columns))
    loose = {c for f in frames for c in every if c not in f.columns or c in maybe_unbound(f)}
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return mark_unbound(out.select(*every), loose)


#: Rows of one key and bucket that meet the other side in one piece.
HOT_ROWS = 100_000
#: Bits of a double; a bucket is never finer than the numbers it holds.
_MANTISSA = 52
#: Buckets of a level are this many times (as a power of two) as wide as those of the level below.
_STEP = 2


def _number(value: Column, kind: T.DataType) -> Column:
    """A value as a double in the order of its type; moments in microseconds."""
    if isinstance(kind, T.TimestampNTZType):
        value = F.unix_micros(value.cast("timestamp"))
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, T.DateType):
        value = F.datediff(value, F.lit("1970-01-01").cast("date")).cast("double") * 86_400_000_000
    return value.cast("double")


def _level(start: Column, end: Column) -> Column:
    """The level whose buckets are at least as wide as a span, so that it touches two of them at most."""
    finest = F.log2(F.greatest(F.abs(start), F.abs(end))) - _MANTISSA
    wide = F.greatest(F.log2(end - start), finest, F.lit(-1000.0))
    return (F.ceil(F.least(wide, F.lit(1024.0)) / _STEP) * _STEP).cast("int")


def _bucket(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level))


def _salted(left: DataFrame, right: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Cut hot keys of either side into pieces of about ``HOT_ROWS`` rows and repeat the rows of the same keys opposite.

    Keys below that are one piece and nothing is repeated for them. Both sides are written tables, which the counts and the
    join read; the hot keys are written too, so that the join knows their size.
    """
    tells = [df.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / HOT_ROWS).cast("int").alias("_n")).where(F.col("_n") > 1) for df in (left, right)]
    hot = cut(tells[0].withColumn("_side", F.lit(0)).unionByName(tells[1].withColumn("_side", F.lit(1))))
    for side, name in enumerate(("_sl", "_sr")):
        pieces = hot.where(F.col("_side") == side).drop("_side")
        own, other = (left, right) if side == 0 else (right, left)
        n = F.coalesce(F.col("_n"), F.lit(1))
        own = own.join(pieces, on, "left").withColumn(name, F.pmod(F.xxhash64(*[_hashable(own, c) for c in own.columns]), n).cast("int")).drop("_n")
        other = other.join(pieces, on, "left").withColumn(name, F.explode(F.sequence(F.lit(0), n - 1))).drop("_n")
        left, right = (own, other) if side == 0 else (other, own)
    return left, right, [*on, "_sl", "_sr"]


def _hashable(df: DataFrame, name: str) -> Column:
    plain = isinstance(df.schema[name].dataType, T.AtomicType) and not isinstance(df.schema[name].dataType, T.VariantType)
    return F.col(name) if plain else F.to_json(F.struct(F.col(name)))


def range_join(points: DataFrame, spans: DataFrame, point: str, start: str, end: str, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs with ``start <= point < end``, without comparing every pair, for spans of any length.

    A span lives on the level of its length, in the one or two buckets it touches there; a point looks up one bucket on each
    level that has spans. A point and a span that meet in a bucket are at most four span lengths (or two steps of the
    numbers themselves) apart, so a long span beside short ones costs them nothing. Both inputs are read once and written;
    hot buckets of either side are cut into pieces, and only the rows that meet them are repeated. Rows with a null point,
    start or end join nothing, and neither do empty spans.
    """
    kinds = points.schema[point].dataType, spans.schema[start].dataType, spans.schema[end].dataType
    low, high = _number(F.col(start), kinds[1]), _number(F.col(end), kinds[2])
    placed = spans.where(F.col(start) < F.col(end)).withColumn("_level", _level(low, high))
    buckets = F.sequence(_bucket(low, F.col("_level")), _bucket(high, F.col("_level")))
    right, seen = cut_counted(placed.withColumn("_bucket", F.explode(buckets)), levels=F.collect_set("_level"))
    levels = F.array(*[F.lit(n) for n in sorted(seen["levels"])]).cast("array<int>")
    left = cut(points.where(F.col(point).isNotNull()).withColumn("_level", F.explode(levels)))
    left = left.withColumn("_bucket", _bucket(_number(F.col(point), kinds[0]), F.col("_level")))
    left, right, on = _salted(left, right, [*keys, "_level", "_bucket"])
    inside = (F.col(point) >= F.col(start)) & (F.col(point) < F.col(end))
    return left.join(right, on).where(inside).drop("_level", "_bucket", "_sl", "_sr")


def range_totals(points: DataFrame, spans: DataFrame, point: str, start: str, end: str, sums: Sequence[str] = (), count: str = "n") -> DataFrame:
    """The spans that hold points (``start <= point < end``), with the number of these and the sums of their whole-numbered columns.

    What ``range_join`` and a grouping by span would give, without a row for each pair: points of one value are added up, then
    all values and span ends are sorted together in slices, running totals tell what lies below each end, and a span has the
    difference of its ends. So the work grows with points and spans, however many points a span holds.
    """
    unlike = [c for c in sums if not isinstance(points.schema[c].dataType, T.IntegralType)]
    if unlike:
        raise ValueError(f"differences of running sums are exact for whole numbers only: {unlike}")
    adds = [F.count(F.lit(1)), *[x for c in sums for x in (F.count(c), F.sum(F.col(c).cast("decimal(38,0)")))]]
    told = [f"_t{i}" for i in range(len(adds))]
    values = points.where(F.col(point).isNotNull()).groupBy(F.col(point).alias("_at")).agg(*[a.alias(t) for a, t in zip(adds, told, strict=True)])
    held = spans.where(F.col(start) < F.col(end))
    ends = held.select(F.explode(F.array(start, end)).alias("_at")).distinct().withColumn("_end", F.lit(True))
    rows = values.unionByName(ends, allowMissingColumns=True).groupBy("_at").agg(
        F.max("_end").alias("_end"), *[F.coalesce(F.sum(t), F.lit(0)).cast("decimal(38,0)").alias(t) for t in told]
    )
    sliced = slices(rows, [], [F.col("_at")])
    within = Window.partitionBy("_slice").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row a slice, as many as there are shuffle partitions.
    totals = sliced.groupBy("_slice").agg(*[F.sum(t).alias(t) for t in told])
    offsets = totals.select("_slice", *[F.coalesce(F.sum(t).over(before), F.lit(0)).alias(f"_o{t}") for t in told])
    running = sliced.select("_slice", "_at", "_end", *[F.coalesce(F.sum(t).over(within), F.lit(0)).alias(t) for t in told]).where("_end")
    below = cut(running.join(F.broadcast(offsets), "_slice").select("_at", *[(F.col(t) + F.col(f"_o{t}")).alias(t) for t in told]))
    for side, name in enumerate((start, end)):
        held = held.join(below.select(F.col("_at").alias(f"_at{side}"), *[F.col(t).alias(f"{t}_{side}") for t in told]), F.col(name) == F.col(f"_at{side}"))
    inside = [(F.col(f"{t}_1") - F.col(f"{t}_0")).cast("bigint") for t in told]
    made = [F.when(inside[1 + 2 * i] > 0, inside[2 + 2 * i]).alias(c) for i, c in enumerate(sums)]
    return held.where(inside[0] > 0).select(*spans.columns, inside[0].alias(count), *made)


# Relations that hold only where one endpoint of each interval is the same.
_TOUCHING = {
    "meets": (1, 0), "met_by": (0, 1), "starts": (0, 0), "started_by": (0, 0), "equals": (0, 0), "finishes": (1, 1), "finished_by": (1, 1),
}
# Relations in which the second interval starts within the first; in the others with common points it is the other way round.
_STARTS_WITHIN = ("overlaps", "contains")


def interval_join(
    x: DataFrame, y: DataFrame, relation: str, x_ends: tuple[str, str], y_ends: tuple[str, str], keys: Sequence[str] = ()
) -> DataFrame:
    """Pairs of intervals in a named relation.

    Touching intervals join on the endpoint they share. Of intervals with common points one starts within the other, which
    is a ``range_join``, so each pair appears once. Intervals apart share nothing: they need keys.
    """
    from tripleframe.functions.dates import holds

    test = holds(relation, *x_ends, *y_ends)
    if relation in _TOUCHING:
        i, j = _TOUCHING[relation]
        left, right = cut(x.withColumn("_end", F.col(x_ends[i]))), cut(y.withColumn("_end", F.col(y_ends[j])))
        left, right, on = _salted(left, right, [*keys, "_end"])
        return left.join(right, on).where(test).drop("_end", "_sl", "_sr")
    if relation in ("before", "after"):
        if not keys:
            raise ValueError("intervals apart from each other need a shared variable")
        return x.join(y, list(keys)).where(test)
    if relation in _STARTS_WITHIN:
        return range_join(y, x, y_ends[0], *x_ends, keys=keys).where(test)
    return range_join(x, y, x_ends[0], *y_ends, keys=keys).where(test)


# Order and paging -----------------------------------------------------------------------------------


def _sort_columns(variables: Sequence[Any], order: str | Sequence[str] | dict[str, str]) -> list[Column]:
    keys = names(variables)
    if isinstance(order, str):
        directions = [order] * len(keys)
    elif isinstance(order, dict):
        by_name = {names([k])[0]: d for k, d in order.items()}
        directions = [by_name.get(k, "asc") for k in keys]
    else:
        if len(order) != len(keys):
            raise ValueError("one direction per variable is needed")
        directions = list(order)
    return [F.col(k).desc_nulls_last() if d == "desc" else F.col(k).asc_nulls_last() for k, d in zip(keys, directions)]


def order_by(df: DataFrame, *variables: Any, order: str | Sequence[str] | dict[str, str] = "asc") -> DataFrame:
    """Sort by variables; ``order`` is one direction, one per variable, or a mapping. Unbound comes last."""
    return df.orderBy(*_sort_columns(variables, order))


def limit(df: DataFrame, n: int) -> DataFrame:
    """The first n solutions."""
    return df.limit(n)


def start(
    df: DataFrame, n: int, *variables: Any, order: str | Sequence[str] | dict[str, str] = "asc"
) -> DataFrame:
    """Skip the first n solutions in the order of the variables, the other columns breaking ties.

    Rows are numbered slice by slice, so the rest is never gathered in one task as a plain offset would.
    """
    numbered = number_rows(df, [], _sort_columns(variables, order), "_pos")
    return numbered.where(F.col("_pos") >= n).drop("_pos")


def page(
    df: DataFrame, n: int, count: int, *variables: Any, order: str | Sequence[str] | dict[str, str] = "asc"
) -> DataFrame:
    """Skip n solutions and return the next ``count`` of them, in order. A deep page is numbered slice by slice, as by ``start``."""
    numbered = number_rows(df, [], _sort_columns(variables, order), "_pos")
    return numbered.where((F.col("_pos") >= n) & (F.col("_pos") < n + count)).orderBy("_pos").drop("_pos")


__all__ = [
    "and_", "cast", "distinct", "drop_unbound", "eq", "exists", "family", "greater", "gte", "in_range", "interval_join", "isa", "less", "like",
    "limit", "lte", "mark_bound", "mark_unbound", "maybe_unbound", "member", "not_", "once", "opt", "or_", "order_by",
    "page", "range_join", "range_totals", "regexp", "select", "set_member", "start", "subsumption", "true", "type_of",
]
