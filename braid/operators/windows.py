"""Window columns over groups of any size.

A SQL window keeps all rows of a group in one task. Here the groups that have a large part of all rows are found first, by a sketch
of fixed size; all others go through Spark's own windows as they are. A heavy group is cut into slices along its order, at places
taken from a sample of bounded size. Each slice works out its own part, and a table with one row per slice, whose size depends
on the number of tasks alone, says what the rows of other slices add.

Frames of rows around a row (``sliding``) get the rows beyond the ends of a slice as a halo. Frames by value (``ranged``) take
differences of running sums, looked up where the frame begins and ends, however far away that is.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braid.operators.skew import heavy_hashes, key_hash, partitions

# Rows of the sample for each task, and steps of a search among the slices of a group.
SAMPLED, STEPS = 64, 20


def over_groups(
    df: DataFrame, keys: list[str], order: list[str], *,
    row_number: str | None = None, rank: str | None = None, dense_rank: str | None = None,
    percent_rank: str | None = None, cume_dist: str | None = None, ntile: dict[str, int] | None = None,
    last_rows: dict[str, int] | None = None, running: dict[str, tuple[str, str]] | None = None,
    previous: dict[str, str | tuple[str, int]] | None = None, following: dict[str, str | tuple[str, int]] | None = None,
    sliding: dict[str, tuple[str, str, int, int]] | None = None, ranged: dict[str, tuple] | None = None,
    share: float | None = None,
) -> DataFrame:
    """``df`` with more columns, as windows that partition by ``keys`` and order by ``order`` would add them.

    ``order`` names columns, ``"name DESC"`` for falling order, nulls where Spark's ORDER BY puts them. Rows that it does not
    tell apart are peers for ``rank``, ``dense_rank``, ``percent_rank``, ``cume_dist`` and ``ranged``; for all else a hash of the
    whole row decides among them, the same each time.

    ``row_number``, ``rank``, ``dense_rank``, ``percent_rank`` and ``cume_dist`` name the columns to add. Others map a column to
    what it holds. ``ntile``: the number of parts of even size. ``last_rows``: the number n of rows counted in ``ROWS BETWEEN n - 1
    PRECEDING AND CURRENT ROW``. ``running``: ``("max" | "min" | "sum" | "count", column)`` over all rows so far. ``previous`` and
    ``following``: the column whose value in the row before or after it has, or ``(column, n)`` for n rows before or after.
    ``sliding``: ``("sum" | "avg" | "min" | "max" | "count", column, a, b)`` over ``ROWS BETWEEN a PRECEDING AND b FOLLOWING``.
    ``ranged``: ``("sum" | "count", column, a, b)`` over ``RANGE BETWEEN a PRECEDING AND b FOLLOWING`` of the one rising column in
    ``order``; a and b are numbers, or ``timedelta`` for timestamps. Sums need whole numbers or decimals, which are exact.

    A group is heavy if it has ``share`` of all rows, by default half of what an even shuffle gives a task.
    """
    asked = _Asked(keys, order, df, dict(
        row_number=row_number, rank=rank, dense_rank=dense_rank, percent_rank=percent_rank, cume_dist=cume_dist, ntile=ntile or {},
        last_rows=last_rows or {}, running=running or {}, sliding=sliding or {}, ranged=ranged or {},
    ), previous or {}, following or {})
    rows = df.withColumn("_tie", F.xxhash64(*[f"`{c}`" for c in df.columns]))
    hashed = key_hash(df, keys)
    share = share or 1 / (2 * partitions(df))
    heavy, total = heavy_hashes(df, hashed, share)
    if not heavy:
        return asked.plain(rows)
    in_heavy = hashed.isin(sorted(heavy))
    pieces = {item: -(-count // max(1, int(share * total))) for item, count in heavy.items()}
    light = asked.plain(rows.filter(~in_heavy))
    sliced = asked.sliced(rows.filter(in_heavy).withColumn("_group", hashed), pieces)
    # Sums of sums are wider than sums.
    return light.unionAll(sliced.withColumns({name: F.col(f"`{name}`").cast(light.schema[name].dataType) for name in asked.added()}))


# Aggregate, and how what a slice has so far meets what the slices before had.
_FUNCTIONS = {
    "max": (F.max, lambda here, before: F.greatest(here, before)),
    "min": (F.min, lambda here, before: F.least(here, before)),
    "sum": (F.sum, lambda here, before: F.coalesce(here + before, here, before)),
    "count": (F.count, lambda here, before: here + F.coalesce(before, F.lit(0))),
}
_COMBINED = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.sum}
_SLIDING = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count, "avg": F.avg}


class _Asked:
    row_number = rank = dense_rank = percent_rank = cume_dist = None
    ntile = last_rows = running = sliding = ranged = {}

    def __init__(self, keys: list[str], order: list[str], df: DataFrame, wanted: dict, previous: dict, following: dict):
        self.keys, self.columns = keys, df.columns
        self.names = [name.removesuffix(" DESC") for name in order]
        self.falling = [name.endswith(" DESC") for name in order]
        self.directed = [F.desc(f"`{n}`") if down else F.asc(f"`{n}`") for n, down in zip(self.names, self.falling, strict=True)] + [F.asc("_tie")]
        self.__dict__.update(wanted)
        self.by = [f"`{k}`" for k in keys]
        steps = lambda asked: {name: (c, 1) if isinstance(c, str) else c for name, c in asked.items()}
        self.previous, self.following = steps(previous), steps(following)
        self.ranked = bool(self.rank or self.dense_rank or self.percent_rank or self.cume_dist)
        for function, column, _, _ in self.ranged.values():
            if len(order) != 1 or self.falling[0]:
                raise ValueError("a frame by value needs one rising column to order by")
            if function not in ("sum", "count") or function == "sum" and isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
                raise ValueError("frames by value count, or sum whole numbers or decimals")
        if self.ranged:
            self.order_type = df.schema[self.names[0]].dataType

    def added(self) -> list[str]:
        ranks = [self.row_number, self.rank, self.dense_rank, self.percent_rank, self.cume_dist]
        more = (self.ntile, self.last_rows, self.running, self.previous, self.following, self.sliding, self.ranged)
        return [name for name in ranks if name] + [name for part in more for name in part]

    def result(self, rows: DataFrame, added: dict[str, Column]) -> DataFrame:
        return rows.select(*[F.col(f"`{c}`") for c in self.columns], *[added[name].alias(name) for name in self.added()])

    # All groups that fit a task.

    def plain(self, rows: DataFrame) -> DataFrame:
        within = Window.partitionBy(*self.by).orderBy(*self.directed)
        peers = Window.partitionBy(*self.by).orderBy(*self.directed[:-1])
        so_far = within.rowsBetween(Window.unboundedPreceding, 0)
        added = {}
        for name, column in ((self.row_number, F.row_number().over(within)), (self.rank, F.rank().over(peers)), (self.dense_rank, F.dense_rank().over(peers))):
            if name:
                added[name] = column.cast("bigint")
        for name, column in ((self.percent_rank, F.percent_rank()), (self.cume_dist, F.cume_dist())):
            if name:
                added[name] = column.over(peers)
        added |= {name: F.ntile(n).over(within).cast("bigint") for name, n in self.ntile.items()}
        added |= {name: F.count("*").over(within.rowsBetween(1 - n, 0)) for name, n in self.last_rows.items()}
        added |= {name: _FUNCTIONS[f][0](f"`{c}`").over(so_far) for name, (f, c) in self.running.items()}
        added |= {name: F.lag(f"`{c}`", n).over(within) for name, (c, n) in self.previous.items()}
        added |= {name: F.lead(f"`{c}`", n).over(within) for name, (c, n) in self.following.items()}
        added |= {name: _SLIDING[f](f"`{c}`").over(within.rowsBetween(-a, b)) for name, (f, c, a, b) in self.sliding.items()}
        added |= {name: F.expr(self.by_value(*spec)) for name, spec in self.ranged.items()}
        return self.result(rows, added)

    def by_value(self, function: str, column: str, back, ahead) -> str:
        by = f"PARTITION BY {', '.join(self.by)}" if self.by else ""
        return f"{function}(`{column}`) OVER ({by} ORDER BY `{self.names[0]}` RANGE BETWEEN {_text(back)} PRECEDING AND {_text(ahead)} FOLLOWING)"

    def shifted(self, value: Column, width) -> Column:
        """The order's value, so much further."""
        if isinstance(self.order_type, T.DateType):
            return F.date_add(value, width)
        return value + F.lit(width)

    # Heavy groups.

    def sliced(self, rows: DataFrame, pieces: dict[int, int]) -> DataFrame:
        rows = self.cut(rows, pieces)
        within = Window.partitionBy(*self.by, "_slice").orderBy(*self.directed)
        so_far = within.rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("_place", F.row_number().over(within).cast("bigint"))
        if self.ranked:
            peers = Window.partitionBy(*self.by, "_slice").orderBy(*self.directed[:-1])
            rows = rows.withColumns({"_rank": F.rank().over(peers), "_dense": F.dense_rank().over(peers), "_order": F.struct(*[f"`{n}`" for n in self.names])})
            if self.cume_dist:
                rows = rows.withColumn("_up_to", F.count("*").over(peers))
        rows = rows.withColumns({f"_run_{name}": _FUNCTIONS[f][0](f"`{c}`").over(so_far) for name, (f, c) in self.running.items()})
        around = self.around(rows)
        on = reduce(Column.__and__, [rows[name].eqNullSafe(around[f"_of_{i}"]) for i, name in enumerate([*self.by, "_slice"])])
        # One row per slice, of which there are as many as the share of a heavy group allows.
        rows = rows.join(F.broadcast(around), on)
        added = {}
        place = F.col("_place") + F.col("_before")
        if self.row_number:
            added[self.row_number] = place
        if self.ranked:
            # A slice that begins with the value that the slice before ended with goes on with its rank.
            ranked = F.when(F.col("_continues") & (F.col("_rank") == 1), F.col("_rank_at_start")).otherwise(F.col("_rank") + F.col("_before"))
            if self.rank:
                added[self.rank] = ranked
            if self.dense_rank:
                added[self.dense_rank] = F.col("_dense") + F.col("_dense_before") - F.col("_continues").cast("int")
            if self.percent_rank:
                added[self.percent_rank] = F.when(F.col("_all") > 1, (ranked - 1) / (F.col("_all") - 1)).otherwise(0.0)
            if self.cume_dist:
                added[self.cume_dist] = F.when(F.col("_up_to") == F.col("_n"), F.col("_end_of_last")).otherwise(F.col("_up_to") + F.col("_before")) / F.col("_all")
        for name, n in self.ntile.items():
            # The first parts have one row more if rows are left over.
            size, over = F.floor(F.col("_all") / n), F.col("_all") % n
            first = over * (size + 1)
            added[name] = F.when(place <= first, F.ceil(place / (size + 1))).otherwise(over + F.ceil(F.try_divide(place - first, size))).cast("bigint")
        for name, n in self.last_rows.items():
            added[name] = F.least(place, F.lit(n).cast("bigint"))
        for name, (function, _) in self.running.items():
            added[name] = _FUNCTIONS[function][1](F.col(f"_run_{name}"), F.col(f"_run_before_{name}"))
        rows = rows.withColumns({f"_add_{name}": column for name, column in added.items()} | {"_at": place})
        kept = [*self.columns, "_group", "_at", *[f"_add_{name}" for name in added]]
        rows = self.with_halo(rows.select(*[f"`{c}`" for c in kept]))
        rows = self.with_ranged(rows)
        return self.result(rows, {name: F.col(f"`_add_{name}`") for name in self.added()})

    def cut(self, rows: DataFrame, pieces: dict[int, int]) -> DataFrame:
        """``_slice`` for every row: the number of cuts of its group at or before it. Cuts come from the rows with the least
        hashes, the same ones each time, and are fixed before anything is dealt by them."""
        at = F.struct(*[F.col(f"`{n}`").alias(f"f{i}") for i, n in enumerate(self.names)], F.col("_tie").alias("tie"))
        wanted = SAMPLED * partitions(rows)
        sample = rows.select("_group", *[f"`{n}`" for n in self.names], "_tie").orderBy(F.xxhash64("_tie", F.lit("sample")), "_tie").limit(wanted)
        along = Window.partitionBy("_group").orderBy(*self.directed)
        sample = sample.select("_group", at.alias("at"), F.row_number().over(along).alias("i"), F.count("*").over(Window.partitionBy("_group")).alias("n"))
        sizes = F.create_map(*[F.lit(x) for item in pieces.items() for x in item])
        step = F.greatest(F.col("n") / F.element_at(sizes, F.col("_group")), F.lit(1.0))
        # The last of every ``step`` rows, in the sample's order.
        chosen = sample.filter(F.floor(F.col("i") / step) > F.floor((F.col("i") - 1) / step))
        lists = chosen.groupBy("_group").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "at"))), lambda x: x["at"]).alias("_cuts"))
        cuts = rows.sparkSession.createDataFrame(lists.collect(), lists.schema).withColumnRenamed("_group", "_cut_group")
        rows = rows.join(F.broadcast(cuts), F.col("_group") == F.col("_cut_group"), "left")
        reached = lambda cut: cut.isNotNull() & self.not_after(cut, at)
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(STEPS))])
        found = F.aggregate(steps, F.lit(0), lambda low, size: F.when(reached(F.get("_cuts", low + size - 1)), low + size).otherwise(low))
        return rows.withColumn("_slice", found).drop("_cuts", "_cut_group")

    def not_after(self, cut: Column, row: Column) -> Column:
        """Whether the cut comes before the row in the order asked for, or is like it."""
        out = cut["tie"] <= row["tie"]
        for i, falling in reversed(list(enumerate(self.falling))):
            a, b = cut[f"f{i}"], row[f"f{i}"]
            before = (a > b) | (a.isNotNull() & b.isNull()) if falling else (a < b) | (a.isNull() & b.isNotNull())
            out = F.coalesce(before, F.lit(False)) | (a.eqNullSafe(b) & out)
        return out

    def around(self, rows: DataFrame) -> DataFrame:
        """One row per group and slice: what its rows need to know of the other slices of the group."""
        groups = [*self.by, "_slice"]
        facts = [F.count("*").alias("_n")]
        facts += [_FUNCTIONS[f][0](f"`{c}`").alias(f"_all_{name}") for name, (f, c) in self.running.items()]
        if self.ranked:
            facts += [F.max("_dense").alias("_kinds"), F.min_by("_order", "_place").alias("_first"), F.max_by("_order", "_place").alias("_last")]
            facts += [F.max("_rank").alias("_last_rank"), F.sum((F.col("_dense") == 1).cast("int")).alias("_head")]
        ends = rows.groupBy(*groups).agg(*facts)
        whole = Window.partitionBy(*self.by)
        along = whole.orderBy("_slice")
        earlier = along.rowsBetween(Window.unboundedPreceding, -1)
        out = ends.withColumns({"_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "_all": F.sum("_n").over(whole)})
        wanted = ["_n", "_before", "_all"]
        for name, (function, _) in self.running.items():
            out = out.withColumn(f"_run_before_{name}", _COMBINED[function](f"_all_{name}").over(earlier))
            wanted.append(f"_run_before_{name}")
        if self.ranked:
            out = out.withColumn("_continues", F.col("_first").eqNullSafe(F.lag("_last").over(along)) & F.lag("_n").over(along).isNotNull())
            new = F.col("_kinds") - F.col("_continues").cast("int")
            out = out.withColumn("_dense_before", F.coalesce(F.sum(new).over(earlier), F.lit(0)))
            # The slice in which a slice's last value begins is the last one that has other values, too, or starts with a new one.
            begins = (F.col("_kinds") > 1) | ~F.col("_continues")
            start = F.when(begins, F.col("_before") + F.when(F.col("_kinds") > 1, F.col("_last_rank")).otherwise(1))
            out = out.withColumn("_rank_of_last", F.last(start, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0)))
            out = out.withColumn("_rank_at_start", F.lag("_rank_of_last").over(along))
            # And it ends where a later slice starts with another value, or has one.
            stop = F.when(~F.col("_continues"), F.col("_before")).when(F.col("_kinds") > 1, F.col("_before") + F.col("_head"))
            later = along.rowsBetween(1, Window.unboundedFollowing)
            out = out.withColumn("_stop", stop).withColumn("_end_of_last", F.coalesce(F.first("_stop", ignorenulls=True).over(later), F.col("_all")))
            wanted += ["_continues", "_dense_before", "_rank_at_start", "_end_of_last"]
        return out.select(*[F.col(g).alias(f"_of_{i}") for i, g in enumerate(groups)], *wanted)

    def with_halo(self, rows: DataFrame) -> DataFrame:
        """Columns from frames of rows: blocks of consecutive rows, each with copies of the rows that its frames reach."""
        frames = {name: (f, c, a, b) for name, (f, c, a, b) in self.sliding.items()}
        frames |= {name: ("at", c, n, -n) for name, (c, n) in self.previous.items()}
        frames |= {name: ("at", c, -n, n) for name, (c, n) in self.following.items()}
        if not frames:
            return rows
        back, ahead = max(0, *(a for _, _, a, _ in frames.values())), max(0, *(b for _, _, _, b in frames.values()))
        # Blocks as long as the halo at least, so that a row has at most three copies.
        size = max(back + ahead, HALO_ROWS)
        block = lambda at: F.floor((at - 1) / size)
        first, last = block(F.greatest(F.col("_at") - ahead, F.lit(1))), block(F.col("_at") + back)
        copies = rows.withColumn("_block", F.explode(F.sequence(first, last)))
        near = Window.partitionBy(*self.by, "_block").orderBy("_at")
        columns = {}
        for name, (function, column, a, b) in frames.items():
            # As lag and lead: nothing where there is no such row, also of those that are copies.
            column = F.col(f"`{column}`")
            taken = F.lag(column, a) if a > 0 else F.lead(column, b)
            columns[f"_add_{name}"] = taken.over(near) if function == "at" else _SLIDING[function](column).over(near.rowsBetween(-a, b))
        return copies.withColumns(columns).filter(F.col("_block") == block(F.col("_at"))).drop("_block")

    def with_ranged(self, rows: DataFrame) -> DataFrame:
        """Columns from frames by value: for every row the running sums before its frame and at its end, which are looked up by
        sorting these two places among the rows."""
        if not self.ranged:
            return rows
        key = [F.col(k).alias(f"k{i}") for i, k in enumerate(self.by)]
        value, row = F.col(f"`{self.names[0]}`"), F.struct(*[F.col(f"`{c}`") for c in rows.columns])
        specs = list(self.ranged.values())
        place = lambda v, kind, spec, carry: F.struct(
            v.alias("v"), F.lit(kind).alias("kind"), F.lit(spec).alias("spec"), F.when(F.lit(carry), row).alias("row"),
            *[(F.col(f"`{c}`") if kind == 1 else F.lit(None).cast(rows.schema[c].dataType)).alias(f"c{i}") for i, (_, c, _, _) in enumerate(specs)],
        )
        # Before all rows of equal value, among them, after them.
        places = [place(value, 1, -1, False)]
        for i, (_, _, a, b) in enumerate(specs):
            places += [place(self.shifted(value, -a), 0, i, False), place(self.shifted(value, b), 2, i, i == 0)]
        spread = rows.select(*key, F.col("_at").alias("at"), F.inline(F.array(*places)))
        wanted = {f"n{i}": ("count", f"c{i}") for i in range(len(specs))} | {f"s{i}": ("sum", f"c{i}") for i, spec in enumerate(specs) if spec[0] == "sum"}
        keys = [f"k{i}" for i in range(len(self.keys))]
        # Rows are told apart by group and place; the row itself, which may hold what cannot be compared, only travels along.
        summed = over_groups(spread, keys, ["v", "kind"], running=wanted)
        sign = F.when(F.col("kind") == 2, 1).when(F.col("kind") == 0, -1)
        facts = [F.first("row", ignorenulls=True).alias("row")]
        for i, (function, _, _, _) in enumerate(specs):
            mine = lambda column: F.sum(F.when(F.col("spec") == i, column * sign))
            facts.append(mine(F.col(f"n{i}")).alias(f"n{i}"))
            if function == "sum":
                facts.append(mine(F.coalesce(F.col(f"s{i}"), F.lit(0))).alias(f"s{i}"))
        found = summed.filter("kind <> 1").groupBy(*keys, "at").agg(*facts)
        columns = []
        for i, (name, (function, column, _, _)) in enumerate(self.ranged.items()):
            kind = rows.select(_FUNCTIONS[function][0](f"`{column}`")).schema[0].dataType
            total = F.when(F.col(f"n{i}") > 0, F.col(f"s{i}")) if function == "sum" else F.col(f"n{i}")
            columns.append(total.cast(kind).alias(f"_add_{name}"))
        return found.select("row.*", *columns)


# Rows of a block, unless its frames reach further.
HALO_ROWS = 100_000


def _text(width) -> str:
    if isinstance(width, timedelta):
        seconds, rest = divmod(width // timedelta(microseconds=1), 1_000_000)
        return f"INTERVAL '{seconds}.{rest:06d}' SECOND"
    return str(width)
