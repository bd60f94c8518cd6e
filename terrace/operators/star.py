"""Star schemas: dimensions with dense keys, fact builds by look-up, and roll-ups.

Broadcast policy: a dimension is broadcast only when its measured size (rows and
payload bytes, gathered while its keys are assigned, or measured on demand) is under
the broadcast limit. Otherwise the look-up is an ordinary equi-join, which AQE plans
as a shuffled join with skew splitting of hot fact keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators.combine import distinct_members
from terrace.operators.keys import measure as _measure
from terrace.operators.keys import measure_bounded, order_of, payload_row_bytes, write_tagged
from terrace.session import shared_dir
from terrace.sources.tables import read_table, write_table

DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


@dataclass
class Dimension:
    """A dimension table: natural key, dependent attributes and a dense surrogate key."""

    df: DataFrame
    natural_key: list[str]
    sk: str
    attributes: list[str] = field(default_factory=list)
    rows: int | None = None
    bytes: int | None = None

    @property
    def columns(self) -> list[str]:
        return self.natural_key + self.attributes + [self.sk]

    def measured(self) -> "Dimension":
        if self.rows is None or self.bytes is None:
            self.rows, self.bytes = _measure(self.df)
        return self


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and return the
    stored copy: cuts the lineage (and its re-evaluation) and survives executor loss."""
    path = shared_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def build_dimension(df: DataFrame, natural_key: Sequence[str], sk: str,
                    attributes: Sequence[str] = (), derived: Mapping[str, Column] | None = None,
                    members_unique: bool = False, allow_fanout: bool = False) -> Dimension:
    """Distinct members of ``natural_key`` (+ ``attributes`` that depend on it) with a dense
    key 1..n in natural-key order. ``derived`` adds columns computed from the members
    (e.g. the hour of a timestamp). The member list is written once to shared storage, so
    keys, measurements and later look-ups all read the same rows.

    ``members_unique=True`` states that ``df`` already has one row per member (e.g. the
    output of :func:`dedupe` or of a ``groupBy`` on the key): the distinct, a full shuffle
    of the member list, is then skipped."""
    return build_dimensions(df, {"_": DimensionSpec(tuple(natural_key), sk, tuple(attributes), derived, allow_fanout)},
                            members_unique)["_"]


@dataclass(frozen=True)
class DimensionSpec:
    natural_key: tuple[str, ...]
    sk: str
    attributes: tuple[str, ...] = ()
    derived: Mapping[str, Column] | None = None
    allow_fanout: bool = False  # attributes need not depend on the natural key

    @property
    def members(self) -> list[str]:
        return list(dict.fromkeys(self.natural_key + self.attributes))

    @property
    def key(self) -> list[str]:
        """The columns that tell members apart: the natural key, with the attributes if they may differ."""
        return self.members if self.allow_fanout else list(dict.fromkeys(self.natural_key))


def _merged(orders: Sequence[Sequence[str]]) -> list[str] | None:
    """One order of all columns that keeps each of ``orders``, or None if they contradict."""
    left, out = [list(o) for o in orders], []
    while any(left):
        head = next((o[0] for o in left if o and not any(o[0] in other[1:] for other in left)), None)
        if head is None:
            return None
        out.append(head)
        left = [o[1:] if o and o[0] == head else o for o in left]
    return out


def _passes(specs: Mapping[str, DimensionSpec]) -> list[dict[str, DimensionSpec]]:
    """Dimensions that one pass can build: at most ``MAX_GROUPING_COLUMNS`` columns (grouping_id
    is a 64-bit mask), key orders that don't contradict, and the same key where the columns are
    the same."""
    out: list[dict[str, DimensionSpec]] = []
    for name, spec in specs.items():
        for batch in out:
            both = [*batch.values(), spec]
            if (len({c for s in both for c in s.members}) <= MAX_GROUPING_COLUMNS
                    and _merged([s.key for s in both]) is not None
                    and all(s.key == spec.key for s in batch.values() if set(s.members) == set(spec.members))):
                batch[name] = spec
                break
        else:
            out.append({name: spec})
    return out


def build_dimensions(df: DataFrame, specs: Mapping[str, DimensionSpec],
                     members_unique: bool = False) -> dict[str, Dimension]:
    """Build several dimensions of one source with a single scan, a single sort and one write.

    All member lists come out of one ``GROUPING SETS`` aggregation (partial aggregation
    map-side, one shuffle), tagged by ``grouping_id``. The combined list is range-sorted by that
    tag and the natural keys, so each dimension is a stretch of it, and written once with row
    ids. The same write observes rows and bytes per dimension and the rows per sort partition,
    from which the keys are a projection. Where attributes should depend on the natural key, the
    sorted rows of a key are merged before the write (no further shuffle) and keys with more than
    one combination are counted along with the rest.
    """
    out: dict[str, Dimension] = {}
    for batch in _passes(specs):
        out.update(_build_pass(df, batch, members_unique))
    return {name: out[name] for name in specs}


def _build_pass(df: DataFrame, specs: Mapping[str, DimensionSpec], members_unique: bool) -> dict[str, Dimension]:
    keys = _merged([s.key for s in specs.values()])
    all_cols = keys + [c for c in dict.fromkeys(c for s in specs.values() for c in s.members) if c not in keys]
    n = len(all_cols)
    sets = {name: sum(1 << (n - 1 - i) for i, c in enumerate(all_cols) if c not in spec.members)
            for name, spec in specs.items()}
    gids = sorted(set(sets.values()))
    if len(specs) == 1:
        grouped = df.select(*[_q(c) for c in all_cols]) if members_unique else distinct_members(df, all_cols)
        tag: list[Column] = []
    else:
        # A set is its columns, whatever their order: one grouping set for each grouping_id.
        unique_sets = list(dict.fromkeys(tuple(c for c in all_cols if c in spec.members) for spec in specs.values()))
        grouped = df.groupingSets([[_q(c) for c in cols] for cols in unique_sets], *[_q(c) for c in all_cols])
        grouped = grouped.agg(F.grouping_id().alias("_gid"))
        tag = [F.col("_gid")]
    # A column can be part of one dimension's key and an attribute of another.
    keyed_in = {c: [sets[m] for m, s in specs.items() if c in s.key] for c in keys}
    member_in = {c: [sets[m] for m, s in specs.items() if c in s.members] for c in keys}
    masked = [c for c in keys if set(keyed_in[c]) != set(member_in[c])]
    attributes = [c for c in all_cols if c not in keys] + masked
    key_names = [f"_key_{c}" if c in masked else c for c in keys]
    grouped = grouped.withColumns({f"_key_{c}": F.when(F.col("_gid").isin(keyed_in[c]), _q(c)) for c in masked})
    ranged = grouped.repartitionByRange(*tag, *order_of(key_names))
    metrics: dict[str, Column] = {}
    if attributes:
        one = F.struct(*[_q(c) for c in attributes])
        ranged = (ranged.groupBy(*tag, *[_q(c) for c in key_names]).agg(F.min(one).alias("_low"), F.max(one).alias("_high"))
                  .withColumns({f"_attr_{c}": F.col(f"_low.`{c}`") for c in attributes}))
    ranged = ranged.sortWithinPartitions(*tag, *order_of(key_names))
    row_bytes = payload_row_bytes(key_names + [f"_attr_{c}" for c in attributes])
    for g in gids:
        mine = F.col("_gid") == g if tag else F.lit(True)
        metrics[f"n{g}"] = F.count_if(mine)
        metrics[f"b{g}"] = F.sum(F.when(mine, row_bytes))
        if attributes:
            metrics[f"v{g}"] = F.count_if(mine & ~F.col("_low").eqNullSafe(F.col("_high")))
    tagged = write_tagged(ranged, "members", metrics)
    base, before = {}, 0
    for g in gids:
        base[g] = before
        before += int(tagged.metrics[f"n{g}"] or 0)
    out: dict[str, Dimension] = {}
    for name, spec in specs.items():
        g = sets[name]
        rows, size = int(tagged.metrics[f"n{g}"] or 0), int(tagged.metrics[f"b{g}"] or 0)
        several = int(tagged.metrics.get(f"v{g}") or 0)
        if several:
            raise ValueError(f"{spec.sk}: {several} of {rows} natural keys have more than one combination of the attributes "
                             f"{list(spec.attributes)}, which do not depend on {list(spec.natural_key)}; rows would fan out. "
                             "Add them to the key or pass allow_fanout=True")
        stored = {c: (f"_key_{c}" if c in masked else c) if c in spec.key else f"_attr_{c}" for c in spec.members}
        members = tagged.df.filter(F.col("_gid") == g) if tag else tagged.df
        members = members.select(*[_q(stored[c]).alias(c) for c in spec.members],
                                 (tagged.rank() - F.lit(base[g])).alias(spec.sk))
        derived_names: list[str] = []
        if spec.derived:
            members = members.withColumns(dict(spec.derived))
            derived_names = [c for c in spec.derived if c not in spec.members]
            members = members.select(*[_q(c) for c in spec.members + derived_names], _q(spec.sk))
        attrs = [c for c in spec.members if c not in spec.natural_key] + derived_names
        # The key and the derived columns count as well: 8 bytes for each, text measured on demand.
        fixed = all(not isinstance(members.schema[c].dataType, T.StringType) for c in derived_names)
        out[name] = Dimension(members, list(spec.natural_key), spec.sk, attrs, rows if fixed else None,
                              size + 8 * rows * (1 + len(derived_names)) if fixed else None)
    return out


def store_dimension(dim: Dimension, path: str, fmt: str = "parquet") -> Dimension:
    """Write the dimension and return it re-read from storage: the fact is then built from
    exactly the keys that were stored."""
    write_table(dim.df, path, fmt)
    return Dimension(read_table(dim.df.sparkSession, path, fmt), dim.natural_key, dim.sk,
                     dim.attributes, dim.rows, dim.bytes)


def size_checked_broadcast(df: DataFrame, size_bytes: int, limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint only when the measured size is under ``limit``."""
    return F.broadcast(df) if size_bytes <= limit else df


@dataclass
class DimRef:
    """How a fact row finds its dimension member.

    ``on``            dimension columns to match (default: the full natural key)
    ``fact_on``       fact columns matched to ``on`` when they are named differently
    ``allow_fanout``  permit matching on part of the natural key (each fact row then
                      joins every member sharing that part, and counters inflate)
    ``null_policy``   "drop" (plain equality: a NULL key part loses the row) or "match"
                      (NULL-safe equality); a dict sets it per column
    ``carry``         extra dimension columns copied into the fact (snowflake keys)
    """

    dim: Dimension
    on: list[str] | None = None
    fact_on: list[str] | None = None
    allow_fanout: bool = False
    null_policy: str | Mapping[str, str] = "drop"
    carry: list[str] = field(default_factory=list)

    def key_columns(self) -> list[str]:
        on = list(self.on or self.dim.natural_key)
        missing = [c for c in self.dim.natural_key if c not in on]
        if missing and not self.allow_fanout:
            raise ValueError(
                f"look-up of {self.dim.sk} on {on} omits natural-key columns {missing}: rows would fan "
                "out; match the full key or pass allow_fanout=True")
        return on

    def policy(self, column: str) -> str:
        if isinstance(self.null_policy, str):
            return self.null_policy
        return self.null_policy.get(column, "drop")


def lookup(fact: DataFrame, ref: DimRef, alias: str, broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
           how: str = "inner") -> DataFrame:
    """Join ``fact`` to one dimension; adds ``ref.dim.sk`` and the carried columns."""
    on = ref.key_columns()
    fact_on = list(ref.fact_on or on)
    if len(fact_on) != len(on):
        raise ValueError("fact_on and on must have the same length")
    check_key_types(fact, fact_on, ref.dim.df, on)
    dim = ref.dim.measured()
    right_cols = list(dict.fromkeys(on + [dim.sk] + list(ref.carry)))
    right = dim.df.select(*[_q(c).alias(f"{alias}__{c}") for c in right_cols])
    right = size_checked_broadcast(right, dim.bytes or 0, broadcast_limit)
    conds = []
    for f_col, d_col in zip(fact_on, on):
        left, r = _q(f_col), F.col(f"`{alias}__{d_col}`")
        conds.append(left.eqNullSafe(r) if ref.policy(d_col) == "match" else left == r)
    joined = fact.join(right, reduce(lambda a, b: a & b, conds), how)
    keep = [F.col(f"`{alias}__{c}`").alias(c) for c in [dim.sk] + list(ref.carry)]
    return joined.select(*[_q(c) for c in fact.columns if c not in {dim.sk, *ref.carry}], *keep)


def _together(silver: DataFrame, dims: Sequence[DimRef], broadcast_limit: int) -> list[DimRef]:
    """The look-ups too large to broadcast, if there are several and all their key columns are
    ``silver``'s own (not keys that other look-ups add)."""
    added = {c.lower() for ref in dims for c in [ref.dim.sk, *ref.carry]}
    own = {c.lower() for c in silver.columns} - added
    large = [ref for ref in dims if (ref.dim.measured().bytes or 0) > broadcast_limit
             and all(c.lower() in own for c in ref.fact_on or ref.key_columns())]
    return large if len(large) > 1 else []


def _map_side_first(silver: DataFrame, dims: Sequence[DimRef], broadcast_limit: int) -> list[DimRef]:
    """The look-ups that are broadcast and may come before all others: on ``silver``'s own columns,
    without fan-out, and adding no column that ``silver`` has or that two look-ups add."""
    added = [c.lower() for ref in dims for c in [ref.dim.sk, *ref.carry]]
    clash = {c for c in added if added.count(c) > 1} | {c.lower() for c in silver.columns}
    own = {c.lower() for c in silver.columns} - set(added)
    return [ref for ref in dims if (ref.dim.measured().bytes or 0) <= broadcast_limit and not ref.allow_fanout
            and all(c.lower() in own for c in ref.fact_on or ref.key_columns())
            and not any(c.lower() in clash for c in [ref.dim.sk, *ref.carry])]


def lookup_together(fact: DataFrame, refs: Sequence[DimRef], broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Several look-ups with one shuffle of ``fact``: its distinct key combinations (partial
    aggregation map-side, key columns only) are joined to every dimension, and the combinations
    with all their surrogate keys once to ``fact``. NULL policies and fan-out hold as in
    :func:`lookup`; adaptive execution splits hot combinations of the last join."""
    null_safe: dict[str, bool] = {}
    for ref in refs:
        on = ref.key_columns()
        for f_col, d_col in zip(ref.fact_on or on, on):
            # One look-up that drops NULLs is enough to lose the row.
            null_safe[f_col] = null_safe.get(f_col, True) and ref.policy(d_col) == "match"
    combos = fact.select(*[_q(c) for c in null_safe])
    for c, kept in null_safe.items():
        if not kept:
            combos = combos.where(_q(c).isNotNull())
    combos = combos.distinct()
    for i, ref in enumerate(refs):
        combos = lookup(combos, ref, f"g{i}", broadcast_limit)
    added = list(dict.fromkeys(c for ref in refs for c in [ref.dim.sk, *ref.carry]))
    right = combos.select(*[_q(c).alias(f"_combo_{c}") for c in [*null_safe, *added]])
    conds = [_q(c).eqNullSafe(F.col(f"`_combo_{c}`")) if kept else _q(c) == F.col(f"`_combo_{c}`") for c, kept in null_safe.items()]
    joined = fact.join(right, reduce(lambda a, b: a & b, conds))
    return joined.select(*[_q(c) for c in fact.columns if c not in added], *[F.col(f"`_combo_{c}`").alias(c) for c in added])


def build_fact(silver: DataFrame, dims: Sequence[DimRef], measures: Sequence[str | Column] = (),
               degenerate: Sequence[str] = (), constants: Mapping[str, object] | None = None,
               broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Chain one inner look-up per dimension and keep keys, measures and ``degenerate``
    (pass-through) columns. Under the default NULL policy a row whose natural key has a
    NULL part has no member to match and is dropped.

    Dimensions below the broadcast limit are map-side joins. They come first, as far as they
    neither fan out nor need keys that other look-ups add: rows that are shuffled for the large
    ones then carry surrogate keys in place of natural ones. Two or more above the limit are looked
    up together (:func:`lookup_together`), so the fact is shuffled once, not once for each."""
    large = _together(silver, dims, broadcast_limit)
    small = _map_side_first(silver, dims, broadcast_limit)
    fact = silver
    for i, ref in enumerate(dims):
        if any(ref is x for x in small):
            fact = lookup(fact, ref, f"d{i}", broadcast_limit)
    fact = lookup_together(fact, large, broadcast_limit) if large else fact
    for i, ref in enumerate(dims):
        if not any(ref is x for x in [*small, *large]):
            fact = lookup(fact, ref, f"d{i}", broadcast_limit)
    sk_cols = []
    for ref in dims:
        sk_cols += [ref.dim.sk] + [c for c in ref.carry if c not in sk_cols]
    out = [_q(c) for c in sk_cols]
    out += [_q(m) if isinstance(m, str) else m for m in measures]
    out += [_q(c) for c in degenerate]
    out += [F.lit(v).alias(k) for k, v in (constants or {}).items()]
    return fact.select(*out)


MERGES = ("sum", "count", "min", "max", "avg")


def star_rollup(fact: DataFrame, dims: Sequence[Dimension], group_by: Sequence[str],
                measures: Mapping[str, tuple[str, str | Column]],
                broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Aggregate a fact by dimension attributes.

    ``measures`` declares name -> (merge, fact column or expression), the merge one of
    ``sum``, ``count``, ``min``, ``max`` and ``avg``; anything else is an error. ``count`` counts
    non-NULL values, ``avg`` is a double.

    Dimensions small enough to broadcast are joined map-side. If all are, the fact is aggregated
    once (partial aggregation before the single shuffle). Otherwise it is first reduced to one row
    per attribute group of the small dimensions and surrogate keys of the large ones, so only that
    reduced set takes part in the shuffled joins, and the partial results are merged. Values and
    types are the same either way.
    """
    for name, (merge, _) in measures.items():
        if merge not in MERGES:
            raise ValueError(f"measure {name!r}: {merge!r} is not one of {MERGES}")
    value = {n: (_q(c) if isinstance(c, str) else c) for n, (_, c) in measures.items()}
    # Partial aggregates that merge exactly; an average is its sum and count.
    first: dict[str, Column] = {}
    for name, (merge, _) in measures.items():
        if merge == "avg":
            first |= {f"{name}__s": F.sum(value[name]), f"{name}__n": F.count(value[name])}
        else:
            first[name] = getattr(F, merge)(value[name])
    whole = fact.agg(*[e.alias(n) for n, e in first.items()]).schema
    small = [d for d in dims if (d.measured().bytes or 0) <= broadcast_limit]
    large = [d for d in dims if not any(d is x for x in small)]

    def attributes(d: Dimension) -> list[str]:
        return [c for c in d.natural_key + d.attributes if c in group_by]

    base, aggregates = fact, first
    for d in small:
        base = base.join(F.broadcast(d.df.select(_q(d.sk), *[_q(c) for c in attributes(d)])), d.sk)
    if large:
        later = {c for d in large for c in attributes(d)}
        groups = [c for c in group_by if c not in later]
        base = base.groupBy(*[_q(c) for c in groups], *[_q(d.sk) for d in large]).agg(*[e.alias(n) for n, e in first.items()])
        again = {n: (merge if merge in ("min", "max") else "sum") for n, (merge, _) in measures.items()}
        aggregates = {n: getattr(F, again.get(n, "sum"))(_q(n)) for n in first}
    for d in large:
        base = base.join(d.df.select(_q(d.sk), *[_q(c) for c in attributes(d)]), d.sk)
    out = base.groupBy(*[_q(c) for c in group_by]).agg(*[e.alias(n) for n, e in aggregates.items()])

    def result(name: str, merge: str) -> Column:
        if merge == "avg":
            return F.when(_q(f"{name}__n") > 0, _q(f"{name}__s").cast("double") / _q(f"{name}__n")).alias(name)
        return _q(name).cast(whole[name].dataType).alias(name)

    return out.select(*[_q(c) for c in group_by], *[result(n, merge) for n, (merge, _) in measures.items()])


def join_small(df: DataFrame, small: DataFrame, on: Column | Sequence[Column] | Sequence[str],
               how: str = "inner", broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Equi-join ``df`` to a table expected to be small. ``on`` is a condition, a list of
    conditions (AND-ed) or a list of names (USING: one copy of each key). The broadcast
    hint is applied only after measuring ``small`` (one distributed aggregation); beyond
    the limit AQE picks the join."""
    if isinstance(on, (list, tuple)) and all(isinstance(c, str) for c in on):
        check_key_types(df, on, small, on)
    fits = measure_bounded(small, broadcast_limit)
    right = F.broadcast(small) if fits is not None else small
    if isinstance(on, (list, tuple)) and on and all(isinstance(c, Column) for c in on):
        on = reduce(lambda a, b: a & b, on)
    return df.join(right, on, how)


MAX_GROUPING_COLUMNS = 60
HOT_KEY_ROWS = 5_000_000
# Keys that one sketch follows, how many hot ones are used at most, and groups that merge sketches first.
TRACKED_KEYS = 20_000
HOT_KEYS = 1_000
SKETCH_GROUPS = 256
_SKETCHED = (T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType, T.DateType, T.TimestampType)


def hot_keys(df: DataFrame, keys: Sequence[str], more_than: int, names: Sequence[str], tracked: int = TRACKED_KEYS) -> DataFrame | None:
    """The keys that hold more than ``more_than`` rows of ``df`` by a heavy-hitter sketch, as a
    local table of the key columns (called ``names``) and ``_hot``, how many times ``more_than``
    they hold; None if there is none. Keys with a NULL part are left out.

    One pass over the key columns. Every task keeps a sketch of ``tracked`` keys; they merge in
    ``SKETCH_GROUPS`` groups first, then those do, so no task reads all of them. A key
    with more than about four times rows / ``tracked`` rows cannot be missed. Estimates may be a
    little high, which costs a salt and no result. Every listed key occurs in ``df``.
    """
    types = [df.schema[k].dataType for k in keys]
    whole = len(keys) == 1 and isinstance(types[0], _SKETCHED)
    item = _q(keys[0]) if whole else F.to_json(F.struct(*[_q(k).alias(n) for k, n in zip(keys, names)]))
    not_null = reduce(lambda a, b: a & b, [_q(k).isNotNull() for k in keys])
    first = (df.where(not_null).select(item.alias("_item"), F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_some"))
             .groupBy("_some").agg(F.expr(f"approx_top_k_accumulate(_item, {tracked})").alias("_sketch")))
    # Grouped by a constant: without rows there is no sketch to combine.
    top = first.groupBy(F.lit("all").alias("_all")).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(_sketch, {tracked}), {min(HOT_KEYS, tracked)})").alias("t")).first()
    hot = [(r["item"], -(-r["count"] // more_than)) for r in (top["t"] if top else []) if r["count"] > more_than]
    if not hot:
        return None
    kind = types[0] if whole else T.StringType()
    table = df.sparkSession.createDataFrame(hot, T.StructType([T.StructField("_item", kind), T.StructField("_hot", T.LongType())]))
    if whole:
        return table.select(F.col("_item").alias(names[0]), F.col("_hot").cast("int").alias("_hot"))
    back = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])
    return table.select(F.from_json("_item", back).alias("k"), F.col("_hot").cast("int").alias("_hot")).select("k.*", "_hot")


def check_key_types(left: DataFrame, left_keys: Sequence[str], right: DataFrame, right_keys: Sequence[str]) -> None:
    """Key pairs must be of comparable kinds: under ANSI rules one text that is no number would
    otherwise stop the job that compares it with numbers."""
    def kind(t: T.DataType) -> str:
        return "number" if isinstance(t, T.NumericType) else "time" if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) \
            else "any" if isinstance(t, T.NullType) else t.typeName()

    for lk, rk in zip(left_keys, right_keys):
        lt, rt = left.schema[lk].dataType, right.schema[rk].dataType
        if kind(lt) != kind(rt) and "any" not in (kind(lt), kind(rt)):
            raise TypeError(f"join keys {lk!r} ({lt.simpleString()}) and {rk!r} ({rt.simpleString()}) have different types; "
                            "cast one of them (try_cast keeps dirty values as NULL)")


def enrich(df: DataFrame, other: DataFrame, on: Sequence[str] | tuple[Sequence[str], Sequence[str]],
           dedupe_other: bool = True, hot_key_rows: int = HOT_KEY_ROWS, other_unique: bool = False) -> DataFrame:
    """Left join that keeps every row of ``df`` (NULLs where ``other`` has no partner).

    ``on`` is a key name or list of shared key names (USING: one copy of each key) or a
    pair ``(df_keys, other_keys)`` of differently named keys (the two sides must then
    have no other column name in common). ``other`` is de-duplicated first
    unless ``dedupe_other=False``.

    Skew: in a shuffled LEFT OUTER join only the preserved (left) side can be split, so a
    key of ``other`` with a large share of its rows would land in one task. One pass over the
    keys of ``other`` sketches its heavy hitters (:func:`hot_keys`). If any has more than
    ``hot_key_rows`` rows, its rows are spread over salts by a hash of the whole row (the same
    whenever a task is run again), its left rows are copied to every salt, and copies that meet
    no row are dropped: a hot key has partners, so each left row keeps some. All other keys have
    one salt. It is one left join either way: ``df`` is scanned once, ``other`` twice.
    ``other_unique=True`` states that ``other`` has at most one row a key; there is no sketch then.
    """
    if isinstance(on, str):
        on = [on]
    using = not (isinstance(on, tuple) and len(on) == 2 and not isinstance(on[0], str))
    left_keys, right_keys = (list(on), list(on)) if using else (list(on[0]), list(on[1]))
    check_key_types(df, left_keys, other, right_keys)
    names = [f"_h{i}" for i in range(len(right_keys))]
    hot = None if other_unique else hot_keys(other, right_keys, hot_key_rows, names)
    right = other.dropDuplicates() if dedupe_other else other

    # Positions instead of names inside the join, so the sides cannot clash.
    l_names, r_names = [f"_l{i}" for i in range(len(df.columns))], [f"_r{i}" for i in range(len(right.columns))]
    l_of, r_of = dict(zip(df.columns, l_names)), dict(zip(right.columns, r_names))
    lt, rt = df.toDF(*l_names), right.toDF(*r_names)
    conds = [F.col(l_of[lk]) == F.col(r_of[rk]) for lk, rk in zip(left_keys, right_keys)]
    if hot is not None:
        def with_salts(side: DataFrame, keys: list[str]) -> DataFrame:
            match = reduce(lambda a, b: a & b, [F.col(k) == F.col(n) for k, n in zip(keys, names)])
            return side.join(F.broadcast(hot), match, "left").drop(*names).withColumn("_hot", F.coalesce("_hot", F.lit(1)))

        lt = (with_salts(lt, [l_of[k] for k in left_keys])
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_hot") - 1))))
        rt = (with_salts(rt, [r_of[k] for k in right_keys])
              .withColumn("_rsalt", F.pmod(F.xxhash64(*r_names), F.col("_hot")).cast("int")).drop("_hot"))
        conds.append(F.col("_salt") == F.col("_rsalt"))
    joined = lt.join(rt, reduce(lambda a, b: a & b, conds), "left")
    if hot is not None:
        joined = joined.where((F.col("_hot") == 1) | F.col("_rsalt").isNotNull())
    if using:
        out = [(l_of[c], c) for c in left_keys + [c for c in df.columns if c not in left_keys]]
        out += [(r_of[c], c) for c in right.columns if c not in right_keys]
    else:
        out = [(l_of[c], c) for c in df.columns] + [(r_of[c], c) for c in right.columns]
    return joined.select(*[F.col(n).alias(c) for n, c in out])


def left_lookup_first(df: DataFrame, df_key: str, other: DataFrame, other_key: str, value: str,
                      alias: str | None = None) -> DataFrame:
    """``df`` left-joined to ``other`` and grouped back to one row per ``df_key`` with the
    first (smallest) non-NULL ``value``. ``other`` is reduced to one row per key *before*
    the join (min is decomposable), so a key with millions of matches never fans out."""
    check_key_types(df, [df_key], other, [other_key])
    reduced = other.groupBy(_q(other_key).alias("_k")).agg(F.min(_q(value)).alias(alias or value))
    joined = df.join(reduced, _q(df_key) == F.col("_k"), "left").drop("_k")
    return joined.groupBy(_q(df_key)).agg(F.min(_q(alias or value)).alias(alias or value))
