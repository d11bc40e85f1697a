"""Look-back range join: count the touches that fall in each probe's window.

The reference joins touches to orders on equality keys plus a half-open time
window ``lo <= touch_time < hi`` (24 h before the order), then sums or counts
over the matches.  A plain equi join with the window as a residual compares
every (touch, order) pair inside a key; if one key is hot (a third of all
rows), that is quadratic work in one task.

``count_in_window`` computes the same numbers from cumulative counts.  With R(x)
the number of touches of a key and group before x, a window holds R(hi) - R(lo)
touches, so it needs two lookups, however long it is:

1. the distinct windows (key, lo, hi) of the probes are taken -- narrow rows, many
   probes share one (all lines of an order share its window);
2. touches and window ends are sorted together within (key, part), where the part
   is the hour of a timestamp or the first 13 characters of a text, and running
   counts give each end the touches before it in its part;
3. the totals of the parts, carried on by the last row of each, are summed over
   the parts before: what remains to be sorted by key are the window ends and one
   row for each part;
4. the difference per window is joined back to the (wide) probes on (key, lo, hi):
   many-to-one, so wide rows are shuffled once and never multiplied.

A group whose values are known (the origin of a touch) has a running count for each of
them in the same pass (``split``), so a window makes two rows in all.  Groups of unknown
values (the platform of a touch) are part of the key; a window is first joined with those
that its key has, and makes two rows for each.

A hot key is split by its parts, and touches of the same time are folded map-side, so
a task sorts at most the distinct times of an hour and the windows that end in it.  The
result is exact for any text: of two texts that differ in their first 13 characters these
decide the order, and all others meet in one part.

With ``once`` a window asks only whether a touch lies in it: the last touch before
``hi`` must not lie before ``lo``.  That is one lookup, of a running maximum instead
of a count, and nothing is summed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

N = "n"
#: Characters of a time text that name its part (``yyyy-MM-dd HH``), and seconds of a timestamp's part.
PART_CHARACTERS, PART_SECONDS = 13, 3600
#: Sign of a window that has nothing to look up.
NOTHING = 2


class Source(NamedTuple):
    """Touches with the windows that look them up: pairs (probe column, touch column) to be
    equal, probe columns with the window's ends, and the touch column with the time.

    In place of a probe column there may be a list of them (all lists of one length): the window
    makes a lookup with each, and what they find is added up.  No touch must be found twice."""

    touches: DataFrame
    on: Sequence
    lo: str | Column | list
    hi: str | Column | list
    at: str


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _value(compare: str, c: Column) -> Column:
    if compare == "string":
        return c
    if compare == "timestamp":
        return c.try_cast("timestamp")
    raise ValueError(f"compare must be 'string' or 'timestamp', not {compare!r}")


def _part(compare: str, value: Column) -> Column:
    """Coarser than the value, in the same order."""
    if compare == "string":
        return F.substring(value, 1, PART_CHARACTERS)
    return F.floor(F.unix_seconds(value) / PART_SECONDS).cast("bigint")


def count_in_window(probes: DataFrame, touches: DataFrame, *, on, lo, hi, at, groups=(), split=None, compare: str = "string",
                    how: str = "inner", weight=None, preaggregate: bool = True, expand: str = "windows",
                    once: bool = False) -> DataFrame:
    """Probe rows joined with the number of touches in their window.

    ``on``: list of (probe column, touch column) equality pairs (names or
    Columns; null keys never match).  ``lo``/``hi``: probe columns with the
    window bounds as text; ``at``: touch column with the touch time as text.
    ``compare``: ``"string"`` (text order, as the loaders) or ``"timestamp"``
    (cast to timestamp, as the GMV report).  ``groups``: touch columns kept
    in the output; counts are per group value.  ``split``: (touch column, all
    its values) of one more group; another value stops the job.  ``weight``:
    touch column with a multiplicity (default 1 per touch row).  ``once``:
    ``n`` is 1 for a window with any touch of the group.

    Output: all probe columns, ``groups``, the split column and ``n``; one or
    more rows per (probe, group) whose ``n`` sum to the count.  With
    ``how="left"`` every probe appears, those without touches with ``n = 0``.
    Aggregate ``n`` downstream (sums are linear, so duplicates of a probe count
    separately, as they do in the reference's join).

    ``preaggregate=False`` skips folding touches per exact time before the
    shuffle.  Use it when the touches are already distinct at second grain
    (every job here extracts them with DISTINCT).

    ``expand="windows"`` (default) looks up the distinct windows and joins the
    counts back to the probes: right when probes are wide and several share
    a window.  ``expand="probes"`` looks up the probe rows themselves, without
    the distinct and the join back, and gives one row with ``-R(lo)`` and one
    with ``R(hi)``, which also add up to 0 for a probe without touches: right when
    each probe is its own window and the rows are narrow (the reports' order rows)."""
    source = Source(touches, on, lo, hi, at)
    if expand == "windows":
        return count_in_windows(probes, [source], groups=groups, split=split, compare=compare, how=how, weight=weight,
                                preaggregate=preaggregate, once=once)
    if expand != "probes":
        raise ValueError("expand must be 'windows' or 'probes'")
    groups = _check(probes, groups, split, how)
    keys = [f"__k{i}" for i in range(len(on))]
    p = probes.select(F.struct(*probes.columns).alias("__probe"), *[_col(c).alias(k) for (c, _), k in zip(on, keys)],
                      _value(compare, _col(lo)).alias("__lo"), _value(compare, _col(hi)).alias("__hi"))
    side = _touch_side(source, keys, groups, split, compare, weight, preaggregate)
    found = _look_up(p, side, keys, groups, split, ["__probe"], compare, how, once)
    return _by_value(found, split).select("__probe.*", *groups, *_name(split), F.col("__n").cast("long").alias(N))


def count_in_windows(probes: DataFrame, sources: Sequence[Source], *, groups=(), split=None, compare: str = "string",
                     how: str = "inner", weight=None, preaggregate: bool = True, once: bool = False, window=None) -> DataFrame:
    """``count_in_window`` over several sources of touches, each with its own keys and window
    ends: the counts of a probe are added up (with ``once`` any of them decides).

    ``window`` names the probe columns that the sources' expressions are made of, where these
    are fewer than the expressions: the windows are then distinct by them."""
    groups = _check(probes, groups, split, how)
    # what each source looks up, and what the windows are: by default all of that
    looks, named = [], {}
    for i, s in enumerate(sources):
        look = {f"__key{j}": c for j, (c, _) in enumerate(s.on)} | {"__lo": s.lo, "__hi": s.hi}
        look = {k: [_col(x) for x in c] if isinstance(c, list) else [_col(c)] for k, c in look.items()}
        if window is None:
            names = {k: [f"{k}_{i}_{a}" for a in range(len(c))] for k, c in look.items()}
            named |= {n: c for k, ns in names.items() for n, c in zip(ns, look[k])}
            look = {k: [F.col(n) for n in ns] for k, ns in names.items()}
        looks.append(look)
    p = probes.select("*", *[c.alias(n) for n, c in named.items()])
    names = list(named) if window is None else list(window)
    windows = p.select(*names).distinct()
    found, apart = [], len(sources) > 1
    for s, look in zip(sources, looks):
        keys = [f"__key{j}" for j in range(len(s.on))]
        ways = max(map(len, look.values()))
        apart = apart or ways > 1

        def way(a, look=look):
            ends = {k: c[a if len(c) > 1 else 0] for k, c in look.items()}
            return [(_value(compare, c) if k in ("__lo", "__hi") else c).alias(k) for k, c in ends.items()]
        w = windows.select("*", *way(0)) if ways == 1 else windows.select(
            "*", F.explode(F.array(*[F.struct(*way(a)) for a in range(ways)])).alias("__look")).select(*names, "__look.*")
        side = _touch_side(s, keys, groups, split, compare, weight, preaggregate)
        n = _look_up(w, side, keys, groups, split, names, compare, "inner", once)
        if not once and not apart:  # both ends of a window are in one partition already
            n = n.groupBy(*keys, *groups, *names).agg(*[F.sum(c).alias(c) for c in _counts(split)])
        found.append(n.select(*names, *groups, *_counts(split)))
    counts = reduce(DataFrame.unionByName, found)
    if apart:
        counts = counts.groupBy(*names, *groups).agg(*[(F.max if once else F.sum)(c).alias(c) for c in _counts(split)])
    counts = _by_value(counts, split).where("__n > 0")
    # back to the probes, many-to-one; what only another lookup needs may be null
    counts = counts.withColumnsRenamed({n: f"__c{n}" for n in names})
    plain = {c for s in sources[:1] for c in [*[c for c, _ in s.on], s.lo, s.hi] if isinstance(c, str)} if len(sources) == 1 else set()
    same = [F.col(n) == F.col(f"__c{n}") if not apart or n in plain else F.col(n).eqNullSafe(F.col(f"__c{n}")) for n in names]
    j = p.join(counts, reduce(lambda a, b: a & b, same), how)
    return j.select(*probes.columns, *groups, *_name(split), F.coalesce("__n", F.lit(0)).cast("long").alias(N))


def _check(probes: DataFrame, groups, split, how: str) -> list[str]:
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    clash = {*groups, *_name(split)} & set(probes.columns)
    if clash:
        raise ValueError(f"group columns collide with probe columns: {sorted(clash)}")
    return list(groups)


def _name(split) -> list[str]:
    return [split[0]] if split else []


def _counts(split) -> list[str]:
    """Columns with the counts: one for each value of the split column, or one in all."""
    return [f"__n{v}" for v in range(len(split[1]))] if split else ["__n"]


def _by_value(found: DataFrame, split) -> DataFrame:
    """A row for each value of the split column."""
    if not split:
        return found
    column, values = split
    rows = [F.struct(F.lit(v).alias(column), F.col(c).alias("__n")) for v, c in zip(values, _counts(split))]
    return found.select("*", F.explode(F.array(*rows)).alias("__row")).select(
        *[c for c in found.columns if c not in _counts(split)], "__row.*")


def _touch_side(source: Source, keys: list[str], groups: list[str], split, compare: str, weight, preaggregate: bool) -> DataFrame:
    """``(keys, groups, split column, __p, __t, __w)`` of touches that can lie in a window."""
    wt = _col(weight) if weight is not None else F.lit(1).cast("long")
    t = source.touches.select(*[_col(c).alias(k) for (_, c), k in zip(source.on, keys)], *groups, *_name(split),
                              _value(compare, _col(source.at)).alias("__t"), wt.alias("__w"))
    t = t.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, "__t"]]))
    if split:
        column, values = split
        t = t.withColumn(column, F.when(F.col(column).isin(*values), F.col(column)).otherwise(
            F.raise_error(F.concat(F.lit(f"unexpected {column}: "), F.coalesce(F.col(column).cast("string"), F.lit("null"))))))
    if preaggregate:
        t = t.groupBy(*keys, *groups, *_name(split), "__t").agg(F.sum("__w").alias("__w"))
    return t.withColumn("__p", _part(compare, F.col("__t")))


def _look_up(windows: DataFrame, side: DataFrame, keys: list[str], groups: list[str], split, kept: list[str], compare: str,
             how: str, once: bool) -> DataFrame:
    """``(keys, groups, kept, counts)``: for each window (and group of its key) a row with -R(lo) and one with R(hi),
    or with ``once`` one row with 1 or 0.  With ``how="left"`` a window that has nothing to look up has a row with 0."""
    fits = F.col("__lo") < F.col("__hi")
    if how == "left" and groups:
        raise ValueError("a left join of the probe rows takes no groups of unknown values")
    if how == "inner":
        windows = windows.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], fits))
    if groups:
        # the filter keeps the count, so that the optimizer does not fold the touches' own DISTINCT into this
        # one: both uses of the touches then share one exchange
        owners = side.groupBy(*keys, *groups).agg(F.count("*").alias("__many")).where("__many > 0").drop("__many")
        renamed = {k: f"__o{k}" for k in keys}
        same = reduce(lambda a, b: a & b, [F.col(k) == F.col(o) for k, o in renamed.items()])
        windows = windows.join(owners.withColumnsRenamed(renamed), same).drop(*renamed.values())
    ends = [F.struct(F.col("__hi").alias("__t"), F.lit(1).alias("__sign"))]
    if not once:
        ends.append(F.struct(F.col("__lo").alias("__t"), F.lit(-1).alias("__sign")))
    ends, by, salt = F.array(*ends), [*keys, *groups], []
    if how == "left":  # without a key or a time a window needs no neighbours: its key may be as hot as it likes
        idle = F.coalesce(~fits, F.lit(True)) | reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        nothing = F.array(F.struct(F.lit(None).cast(windows.schema["__hi"].dataType).alias("__t"), F.lit(NOTHING).alias("__sign")))
        ends, salt = F.when(idle, nothing).otherwise(ends), [F.when(idle, F.xxhash64(*kept)).otherwise(0).alias("__s")]
        side, by = side.withColumn("__s", F.lit(0).cast("long")), [*by, "__s"]
    low = ["__lo"] if once else []
    ends = windows.select(*keys, *groups, *salt, *kept, *low, F.explode(ends).alias("__end"))
    ends = ends.select(*by, *kept, *low, "__end.*").withColumn("__p", _part(compare, F.col("__t")))
    rows = side.withColumn("__sign", F.lit(0)).unionByName(ends, allowMissingColumns=True)
    # at equal times ends come before touches: R counts what is earlier
    in_part = Window.partitionBy(*by, "__p").orderBy("__t", F.col("__sign") == 0)
    so_far, parts_before = in_part.rowsBetween(Window.unboundedPreceding, Window.currentRow), \
        Window.partitionBy(*by).orderBy("__p", "__last").rowsBetween(Window.unboundedPreceding, -1)
    add, what = (F.max, "__t") if once else (F.sum, "__w")
    counts = _counts(split)
    mine = [F.col(split[0]) == v for v in split[1]] if split else [F.col("__sign") == 0]
    rows = rows.select("*", *[add(F.when(m & (F.col("__sign") == 0), F.col(what))).over(so_far).alias(f"__in{c}") for m, c in zip(mine, counts)],
                       F.lead(F.lit(1)).over(in_part).isNull().alias("__last")).where("__sign <> 0 OR __last")
    # the last row of a part carries its totals to the parts after it
    rows = rows.select("*", *[add(F.when(F.col("__last"), F.col(f"__in{c}"))).over(parts_before).alias(f"__before{c}")
                              for c in counts]).where("__sign <> 0")
    out = []
    for c in counts:
        inside, before = F.col(f"__in{c}"), F.col(f"__before{c}")
        if once:
            n = F.when(F.greatest(inside, before) >= F.col("__lo"), F.lit(1).cast("long")).otherwise(0)
        else:
            n = F.col("__sign") * (F.coalesce(inside, F.lit(0)) + F.coalesce(before, F.lit(0)))
        out.append(F.when(F.col("__sign") == NOTHING, 0).otherwise(n).cast("long").alias(c))
    return rows.select(*keys, *groups, *kept, *out)
