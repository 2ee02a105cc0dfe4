"""Step functions of sets: the features over each base, as disjoint segments, and their lookup by binary search.

segments() sweeps over the ends of features: between two neighbouring ends the set of features is one and the same.  The sweep
runs in bins, so no task holds a chromosome.  Steps keeps the segments sorted in arrays that every task gets; a lookup finds
an interval's first and last segment by binary search and adds up what its features share with it.  Rows stay where they
are: a lookup needs no join and no exchange.

What is broadcast is bounded: steps() returns None for more than MOST features or MEMBERS entries of the sets.  Tiles then
brings rows and features of one stretch together by one exchange of the rows, a row each; rows that reach beyond their
stretch's margin are for the caller to join by bins.  A crowded segment never becomes rows; a batch is looked up in pieces
of CHUNK entries.

Empty features are nowhere; empty intervals, null intervals, null lists and groups that no feature has find nothing.  Places
lie within 2^39 of 0.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .intervals import bins, containment_join

MOST = 500_000
MEMBERS = 4_000_000
CHUNK = 1_000_000
#: Places of one group take 2^40 numbers, with 0 in the middle.
SPAN, HALF = 1 << 40, 1 << 39
#: A stretch's length, how far beyond its end its rows may reach, and the parts that its rows are dealt into.
TILE, MARGIN, DEALS = 1 << 17, 1 << 14, 4
#: An interval's place and the caller's mark of it.
AT = "array<struct<start:bigint,end:bigint,tag:int>>"


def segments(features: DataFrame, on: str, width: int = 1 << 14, names: str = "id") -> DataFrame:
    """on, start, end, id: each disjoint segment with each feature that covers it.  A bin's edge inside a feature ends a segment too."""
    some = features.where("start < end").select(on, "start", "end", names)
    inside = F.array(F.greatest("start", F.col("bin") * width), F.least("end", (F.col("bin") + 1) * width))
    cuts = bins(some, "start", "end", width).select(on, "bin", F.explode(inside).alias("start")).distinct()
    ahead = F.lead("start").over(Window.partitionBy(on, "bin").orderBy("start"))
    pieces = cuts.withColumn("end", ahead).where("end IS NOT NULL").select(on, "start", "end")
    return containment_join(pieces, some, [on], width).select(on, "start", "end", names)


def step_function(features: DataFrame, on: str, width: int = 1 << 14, names: str = "id") -> DataFrame:
    """on, start, end, ids: each segment with its sorted set."""
    return segments(features, on, width, names).groupBy(on, "start", "end").agg(F.sort_array(F.collect_set(names)).alias("ids"))


def _keys(group: np.ndarray, place: np.ndarray) -> np.ndarray:
    return group.astype(np.int64) * SPAN + np.clip(place + HALF, 0, SPAN - 1)


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of n numbers each, in one array."""
    before = np.cumsum(n) - n
    return np.arange(n.sum(), dtype=np.int64) + np.repeat(first - before, n)


def _flat(lists: pa.Array) -> tuple[np.ndarray, ...]:
    """row, start, end, tag of all intervals in an array of lists."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    flat = lists.flatten()
    return np.repeat(np.arange(len(size)), size), *(pc.fill_null(pc.struct_field(flat, c), 0).to_numpy() for c in ("start", "end", "tag"))


def _pieces(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of neighbours whose sizes sum up to CHUNK at most, or that are one."""
    total, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + CHUNK, "right")))
        yield slice(a, b)
        a = b


def _units(table: pa.Table, unit: list[str], payload: list[str]) -> tuple[np.ndarray, pa.Table]:
    """The unit's number of each feature, and the payload of each unit."""
    code = table.select(unit).to_pandas().groupby(unit, dropna=False, sort=False).ngroup().to_numpy()
    return code, table.select(payload).take(pa.array(np.unique(code, return_index=True)[1])).combine_chunks()


class Segments:
    """The sorted arrays of a step function, as tasks hold them."""

    def __init__(self, table: pa.Table, on: str, unit: list[str], payload: list[str], rows: pa.Table):
        """table: the features by number; rows: group code, start, end and id of every entry of the sets."""
        self.unit, self.payload = _units(table, unit, payload)
        self.start, self.end = (table[c].combine_chunks().to_numpy() for c in ("start", "end"))
        self.groups = table[on].combine_chunks().unique().drop_null()
        group = pc.index_in(rows[on].combine_chunks(), value_set=self.groups).to_numpy(zero_copy_only=False)
        begin, stop, member = (rows[c].combine_chunks().to_numpy() for c in ("start", "end", "id"))
        key = _keys(group, begin)
        order = np.lexsort((member, key))
        self.members = member[order].astype(np.int32)
        self.begins, at = np.unique(key[order], return_index=True)
        self.stops = _keys(group, stop)[order][at]
        self.offsets = np.append(at, len(order))
        self.beside: pa.Table | None = None

    def look(self, group: pa.Array, lists: pa.Array, whole: bool) -> tuple[np.ndarray, ...]:
        """row, tag, unit, shared bases of all that the intervals of each row meet."""
        return self.met(group, len(lists), *_flat(lists), whole)

    def met(self, group: pa.Array, size: int, row: np.ndarray, start: np.ndarray, end: np.ndarray, tag: np.ndarray, whole: bool = False) -> tuple[np.ndarray, ...]:
        """As look(), of intervals in arrays, in order of their rows, which are `size`."""
        codes = pc.fill_null(pc.index_in(group, value_set=self.groups), -1).to_numpy().astype(np.int64)
        lo, hi = _keys(codes[row], start), _keys(codes[row], end)
        live = (codes[row] >= 0) & (end > start)
        first = np.searchsorted(self.stops, lo, "right")
        last = np.searchsorted(self.begins, hi, "left")
        if whole:  # what holds the interval covers its first base
            last = np.minimum(last, np.searchsorted(self.begins, lo, "right"))
        last = np.where(live, np.maximum(first, last), first)
        entries = np.bincount(row, (self.offsets[last] - self.offsets[first]).astype(float), minlength=size).astype(np.int64)
        stops = np.append(0, np.cumsum(np.bincount(row, minlength=size)))
        out = []
        for piece in _pieces(entries):
            i = np.arange(stops[piece.start], stops[piece.stop])
            n = (last - first)[i]
            seg, at = _spread(first[i], n), np.repeat(i, n)
            m = self.offsets[seg + 1] - self.offsets[seg]
            member, by = self.members[_spread(self.offsets[seg], m)], np.repeat(at, m)
            if whole:
                held = (self.start[member] <= start[by]) & (self.end[member] >= end[by])
                member, by = member[held], by[held]
                shared = (end - start)[by]
            else:
                shared = np.repeat(np.minimum(hi[at], self.stops[seg]) - np.maximum(lo[at], self.begins[seg]), m)
            out.append(self._summed(row[by], tag[by], self.unit[member], shared))
        return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.empty(0, np.int64),) * 4

    @staticmethod
    def _summed(row: np.ndarray, tag: np.ndarray, unit: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, ...]:
        if not len(row):
            return row, tag, unit, shared
        tags, units = int(tag.max()) + 1, int(unit.max()) + 1
        if tag.min() < 0 or (int(row.max()) + 1) * tags * units >= 1 << 63:  # too much for one number
            tag_at = np.unique(tag, return_inverse=True)[1]
            order = np.lexsort((unit, tag_at, row))
            new = np.flatnonzero(np.r_[True, (np.diff(row[order]) != 0) | (np.diff(tag_at[order]) != 0) | (np.diff(unit[order]) != 0)])
        else:
            key = (row.astype(np.int64) * tags + tag) * units + unit
            order = np.argsort(key)
            new = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
        first = order[new]
        return row[first], tag[first], unit[first], np.add.reduceat(shared[order], new)


class Binned:
    """The features of one stretch by bins, looked up as Segments are."""

    def __init__(self, table: pa.Table, unit: list[str], payload: list[str], width: int):
        self.unit, self.payload = _units(table, unit, payload)
        self.start, self.end = (table[c].combine_chunks().to_numpy() for c in ("start", "end"))
        self.width = width
        low = self.start // width
        n = (self.end - 1) // width - low + 1
        bin = _spread(low, n)
        order = np.argsort(bin, kind="stable")
        self.bin, self.feature = bin[order], np.repeat(np.arange(len(low)), n)[order]
        self.beside: pa.Table | None = None

    def look(self, group: pa.Array, lists: pa.Array, whole: bool) -> tuple[np.ndarray, ...]:
        return self.met(group, len(lists), *_flat(lists), whole)

    def met(self, group: pa.Array, size: int, row: np.ndarray, start: np.ndarray, end: np.ndarray, tag: np.ndarray, whole: bool = False) -> tuple[np.ndarray, ...]:
        live = np.flatnonzero(end > start)
        low = start[live] // self.width
        n = np.ones(len(live), np.int64) if whole else (end[live] - 1) // self.width - low + 1
        bin, at = _spread(low, n), np.repeat(live, n)
        first = np.searchsorted(self.bin, bin, "left")
        m = np.searchsorted(self.bin, bin, "right") - first
        out: list[tuple[np.ndarray, ...]] = []
        for i in _pieces(m):
            f, by = self.feature[_spread(first[i], m[i])], np.repeat(at[i], m[i])
            a, b = np.maximum(self.start[f], start[by]), np.minimum(self.end[f], end[by])
            held = (a == start[by]) & (b == end[by]) if whole else (a < b) & (a // self.width == np.repeat(bin[i], m[i]))
            out.append(Segments._summed(row[by[held]], tag[by[held]], self.unit[f[held]], (b - a)[held]))
        # a row's intervals may lie in two pieces
        return Segments._summed(*(np.concatenate(c) for c in zip(*out))) if out else (np.empty(0, np.int64),) * 4


class Lookup:
    """What meets the intervals of a row, in tasks; Steps and Tiles say where the features come from.

    A lookup may bring a table `beside`, which is not looked up: the found index of a task has as `beside` those of its rows that
    may concern the task's rows by their place."""

    unit: StructType

    def each(self, df: DataFrame, group: Column, intervals: Column | None, use, schema: StructType, whole: bool = False, spare: tuple[str, ...] = ()) -> DataFrame:
        """use(df's columns but the spare ones as arrays, the found index, what its look() gives) -> the arrays of schema, for each
        batch.  Without intervals, use() makes them of the columns and gets a function of their row, start, end and tag instead
        of what they meet."""
        raise NotImplementedError

    def meet(self, df: DataFrame, group: Column, intervals: Column, name: str, whole: bool = False, spare: tuple[str, ...] = ()) -> DataFrame:
        """df and `name`, an array of (tag, overlap, unit): the units that a row's intervals (an array of start, end, tag) meet,
        with the bases that its intervals of one tag share with the unit's features.  Features of one unit that overlap count
        for each.  whole: only features that hold an interval as a whole count.  df must not have columns __group, __at or
        `name`."""
        if name in df.columns:
            raise ValueError(f"columns are taken: {[name]}")

        def found(rest: list[pa.Array], index, hits: tuple[np.ndarray, ...]) -> list[pa.Array]:
            row, tag, unit, shared = hits
            columns = index.payload.take(pa.array(unit)).combine_chunks()
            held = pa.StructArray.from_arrays([c.combine_chunks() for c in columns.columns], names=columns.column_names)
            every = pa.StructArray.from_arrays([pa.array(tag, pa.int32()), pa.array(shared, pa.int64()), held], names=["tag", "overlap", "unit"])
            return [*rest, pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=len(rest[0])))), pa.int32()), every)]

        type = ArrayType(StructType().add("tag", IntegerType()).add("overlap", LongType()).add("unit", self.unit))
        fields = [f for f in df.schema.fields if f.name not in spare]
        return self.each(df, group, intervals, found, StructType([*fields, StructField(name, type)]), whole, spare)


def _free(df: DataFrame, *names: str) -> None:
    if clash := set(names) & set(df.columns):
        raise ValueError(f"columns are taken: {sorted(clash)}")


def _blank(field: StructField) -> Column:
    """Nothing of a field's type: a list is empty, as Arrow's writer goes over all nulls before it again for each null list."""
    return F.array().cast(field.dataType) if isinstance(field.dataType, ArrayType) else F.lit(None).cast(field.dataType)


def extent(*blocks: str, beyond: int = 0) -> tuple[Column, Column]:
    """Between which places the blocks of a row lie, and so many bases more."""
    low = F.least(*[F.array_min(F.col(b)["start"]) for b in blocks]) - beyond
    return low, F.greatest(*[F.array_max(F.col(b)["end"]) for b in blocks]) + beyond


class Steps(Lookup):
    """A step function in every task; made by steps()."""

    def __init__(self, spark, kept: Segments, fields: StructType):
        self.kept, self.unit = spark.sparkContext.broadcast(kept), fields

    def each(self, df: DataFrame, group: Column, intervals: Column | None, use, schema: StructType, whole: bool = False, spare: tuple[str, ...] = ()) -> DataFrame:
        _free(df, "__group", "__at")
        columns = [c for c in df.columns if c not in spare]
        kept, n, names = self.kept, len(columns), schema.names

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = kept.value
            for batch in batches:
                hits = partial(index.met, batch.column(n), batch.num_rows) if bare else index.look(batch.column(n), batch.column(n + 1), whole)
                yield pa.RecordBatch.from_arrays(use(batch.columns[:n], index, hits), names=names)

        bare = intervals is None
        return df.select(*columns, group.alias("__group"), *([] if bare else [intervals.cast(AT).alias("__at")])).mapInArrow(found, schema)


class Tiles(Lookup):
    """Features and rows of one stretch in one task: each row goes to the stretch in which `low` lies, where its intervals begin at the earliest, each
    feature to all stretches whose rows may meet it.  Features come first in a stretch and are held; rows pass by in batches,
    so a crowded place takes time but no memory; its rows are dealt into DEALS parts by the columns `by`.  A feature goes as JSON, for
    which a row has one null; so unit and carry are numbers, strings and lists of them.

    Only rows for which near() holds may be looked up, and `low` is told from columns of df alone.  beside: on, start, end and
    columns of other names than the features', the first without nulls.
    """

    def __init__(self, features: DataFrame, on: str, unit: list[str], carry: tuple[str, ...], width: int, by: tuple[str, ...], low: Column, beside: DataFrame | None = None):
        self.on, self.keys, self.payload, self.width, self.by, self.low = on, unit, [*unit, *carry], width, by, low
        self.features = features.where("start < end").select(on, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), *self.payload)
        self.unit = StructType([self.features.schema[c] for c in self.payload])
        self.extra = [c for c in beside.columns if c not in (on, "start", "end")] if beside is not None else []
        if beside is not None:
            self.features = self.features.unionByName(beside.where("start < end"), allowMissingColumns=True)

    @staticmethod
    def _tile(low: Column) -> Column:
        return F.coalesce(F.floor(low / TILE), F.lit(0))

    @staticmethod
    def near(low: Column, high: Column) -> Column:
        """Whether intervals within low and high end at most MARGIN behind the stretch in which low lies."""
        return F.coalesce(high <= (Tiles._tile(low) + 1) * TILE + MARGIN, F.lit(True))

    def each(self, df: DataFrame, group: Column, intervals: Column | None, use, schema: StructType, whole: bool = False, spare: tuple[str, ...] = ()) -> DataFrame:
        _free(df, "__group", "__at", "__tile", "__deal", "__feature")
        fields = [f for f in df.schema.fields if f.name not in spare]
        n, names, width, unit, payload, extra = len(fields), schema.names, self.width, self.keys, self.payload, self.extra
        bare = intervals is None
        spots = [] if bare else [F.coalesce(intervals.cast(AT), F.array().cast(AT)).alias("__at")]
        rows = df.select(*[f.name for f in fields], *spots, F.lit(None).cast("string").alias("__feature"), group.alias("__group"), self._tile(self.low).alias("__tile"), F.pmod(F.xxhash64(*self.by), F.lit(DEALS)).cast("int").alias("__deal"))
        low, high = F.col("__tile") * TILE, (F.col("__tile") + 1) * TILE + MARGIN
        tiled = self.features.withColumn("__tile", F.explode(F.sequence(F.floor((F.col("start") - MARGIN) / TILE), F.floor((F.col("end") - 1) / TILE)))).withColumn("__deal", F.explode(F.array(*[F.lit(i) for i in range(DEALS)])))
        feature = F.to_json(F.struct(F.greatest("start", low).alias("start"), F.least("end", high).alias("end"), *payload, *extra)).alias("__feature")
        tiled = tiled.select(*[_blank(f).alias(f.name) for f in fields], *([] if bare else [F.array().cast(AT).alias("__at")]), feature, F.col(self.on).alias("__group"), "__tile", "__deal")
        typed = to_arrow_schema(StructType([self.features.schema[c] for c in ("start", "end", *payload, *extra)]))
        key = ["__group", "__tile", "__deal"]
        both = tiled.union(rows).repartition(*key).sortWithinPartitions(*key, F.col("__feature").isNull())

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, held, index = None, [], None
            for batch in batches:
                feature, *keys = batch.columns[-4:]
                change = np.zeros(batch.num_rows, bool)
                change[:1] = True
                of_feature = feature.is_valid().to_numpy(zero_copy_only=False)
                change[1:] = of_feature[1:] != of_feature[:-1]
                for k in keys:
                    code = k.dictionary_encode().indices.fill_null(-1).to_numpy()
                    change[1:] |= code[1:] != code[:-1]
                edges = [*np.flatnonzero(change).tolist(), batch.num_rows]
                for a, b in zip(edges, edges[1:]):
                    if (at := tuple(k[a].as_py() for k in keys)) != now:
                        now, held, index = at, [], None
                    if of_feature[a]:
                        held.append(feature.slice(a, b - a))
                        continue
                    if index is None:
                        table = pa.Table.from_pylist([json.loads(x) for h in held for x in h.to_pylist()], schema=typed)
                        apart = pc.is_valid(table[extra[0]]) if extra else None
                        index, held = Binned(table.filter(pc.invert(apart)) if extra else table, unit, payload, width), []
                        index.beside = table.filter(apart).select(extra) if extra else None
                    part = batch.slice(a, b - a)
                    hits = partial(index.met, None, part.num_rows) if bare else index.look(None, part.column(n), whole)
                    yield pa.RecordBatch.from_arrays(use(part.columns[:n], index, hits), names=names)

        return both.mapInArrow(found, schema)


def steps(features: DataFrame, on: str, unit: list[str], carry: tuple[str, ...] = (), width: int = 1 << 14, most: int = MOST, members: int = MEMBERS, beside: DataFrame | None = None) -> Steps | None:
    """features: on, start, end, the unit's columns, and columns that are one for a unit (carry).  None where the features or the
    entries of their sets are more than may be sent to every task, or where `beside`, as Tiles takes it with `entries`, a list in
    each row, has more rows than features may be or more entries in all than sets may have."""
    spark = features.sparkSession
    payload = [*unit, *carry]
    cols = features.where("start < end").select(on, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), *payload)
    table = cols.limit(most + 1).toArrow()
    if table.num_rows > most:
        return None
    if beside is not None:
        n, entries = beside.agg(F.count(F.lit(1)), F.sum(F.size("entries"))).first()
        if n > most or (entries or 0) > members:
            return None
    numbered = table.select([on, "start", "end"]).append_column("id", pa.array(np.arange(table.num_rows)))
    schema = StructType([f for f in cols.schema if f.name in (on, "start", "end")]).add("id", LongType())
    rows = segments(spark.createDataFrame(numbered.to_pandas(), schema) if table.num_rows else spark.createDataFrame([], schema), on, width).limit(members + 1).toArrow()
    if rows.num_rows > members:
        return None
    made = Segments(table, on, unit, payload, rows)
    made.beside = beside.drop(on, "start", "end").toArrow() if beside is not None else None
    return Steps(spark, made, StructType([cols.schema[c] for c in payload]))
