"""The four exon policies over the views; the SQL builds the same weights from lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assign_exon, counts
from .queries import PID, V, WIDTH
from .views import exon_view, pair_view

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def assigned(spark: SparkSession, sf: str, method: str) -> DataFrame:
    p = pair_view(spark, sf, spliced=True)
    return assign_exon.assign(p, PID, exon_view(spark, sf), method, WIDTH)


def per_exon(spark: SparkSession, sf: str, method: str) -> DataFrame:
    """exon or status -> rows and summed weight of each pair-level contribution."""
    a = assigned(spark, sf, method)
    return a.groupBy("pid", F.coalesce("exon_id", "status").alias("feature")).agg(F.round(F.sum("weight"), 6).alias("weight"))


# sets of exons as lists of 'gene-exon', sense first, else antisense
SETS = """, half AS (SELECT pid, 1 AS mate, 0 AS part, s1 AS bs, s1 + 15 AS be FROM pair UNION ALL {mate2}),
m AS (SELECT pair.pid, mate, part, strand2 = exon.strand AS sense, gene_id || '-' || exon_id AS x FROM half JOIN pair ON half.pid = pair.pid JOIN exon ON pair.chrom = exon.chrom AND exon.s <= bs AND exon.e >= be),
anys AS (SELECT pid, bool_or(sense) AS sense FROM m GROUP BY pid),
u AS (SELECT DISTINCT m.pid, mate, part, x FROM m JOIN anys ON m.pid = anys.pid AND m.sense = anys.sense),
l AS (SELECT pid, list(x ORDER BY x) FILTER (mate = 1) AS x1, list(x ORDER BY x) FILTER (mate = 2 AND part = 0) AS x2, list(x ORDER BY x) FILTER (mate = 2 AND part = 1) AS x3 FROM u GROUP BY pid),
z AS (SELECT pair.pid, s1, s2, s1 + 15 AS e1, e2, cut, coalesce(x1, CAST([] AS VARCHAR[])) AS a, coalesce(x2, CAST([] AS VARCHAR[])) AS b, coalesce(x3, CAST([] AS VARCHAR[])) AS c FROM pair LEFT JOIN l ON pair.pid = l.pid)"""
SPAN = "SELECT pid, 2, 0, s2, e2 FROM pair"
PARTS = "SELECT pid, 2, 0, s2, CASE WHEN cut THEN s2 + 8 ELSE s2 + 15 END FROM pair UNION ALL SELECT pid, 2, 1, s2 + 48, s2 + 55 FROM pair WHERE cut"


def genes(x: str) -> str:
    return f"list_distinct(list_transform({x}, lambda y: split_part(y, '-', 1)))"


def within(x: str, g: str) -> str:
    return f"list_filter({x}, lambda y: split_part(y, '-', 1) = {g})"


def even(x: str, total: float) -> str:
    return f"list_transform({x}, lambda y: {{'f': split_part(y, '-', 2), 'w': {total}::DOUBLE / len({x})}})"


def note(status: str, w: float) -> str:
    return f"[{{'f': '{status}', 'w': {w}::DOUBLE}}]"


def cat(*xs: str) -> str:
    out = xs[0]
    for x in xs[1:]:
        out = f"list_concat({out}, {x})"
    return out


NF1, AM1 = note("no_feature", 1), note("ambiguous", 1)
END = " AS ws FROM z{more}), r AS (SELECT pid, unnest(ws) AS w FROM k) SELECT pid, w.f AS feature, round(sum(w.w), 6) AS weight FROM r GROUP BY 1, 2"
COMMON = f"list_intersect({genes('a')}, {genes('b')})"


def _alone(x: str, nf: float, one: float) -> str:
    return f"list_concat({note('no_feature', nf)}, CASE WHEN len({genes(x)}) = 1 THEN {even(x, one)} ELSE {note('ambiguous', one)} END)"


def _mixed(s: str, m: str) -> str:
    g = f"split_part({s}[1], '-', 1)"
    return f"list_concat({even(s, 0.5)}, CASE WHEN list_contains({genes(m)}, {g}) THEN {even(within(m, g), 0.5)} ELSE {note('ambiguous', 0.5)} END)"


G = f"{COMMON}[1]"
SPLIT_HALF = f"""{V}{SETS.replace('{mate2}', SPAN)}, k AS (SELECT pid, CASE WHEN len(a) = 0 AND len(b) = 0 THEN {NF1} WHEN len(b) = 0 THEN {_alone('a', 0.5, 0.5)} WHEN len(a) = 0 THEN {_alone('b', 0.5, 0.5)}
 WHEN len(a) = 1 AND len(b) > 1 THEN {_mixed('a', 'b')} WHEN len(a) > 1 AND len(b) = 1 THEN {_mixed('b', 'a')}
 WHEN len({COMMON}) = 1 THEN {cat(even(within('a', G), 0.5), even(within('b', G), 0.5))} ELSE {AM1} END{END.replace('{more}', '')}"""
SHARED = f"list_intersect({within('a', G)}, {within('b', G)})"
PAIR_ONCE = f"""{V}{SETS.replace('{mate2}', SPAN)}, k AS (SELECT pid, CASE WHEN len(a) = 0 AND len(b) = 0 THEN {NF1} WHEN len(b) = 0 THEN {_alone('a', 1, 1)} WHEN len(a) = 0 THEN {_alone('b', 1, 1)}
 WHEN len({COMMON}) <> 1 THEN {AM1} WHEN len({SHARED}) > 0 THEN {even(SHARED, 1)} ELSE {cat(even(within('a', G), 1), even(within('b', G), 1))} END{END.replace('{more}', '')}"""

# blocks: mate 1 has one (a), mate 2 one (b) or two (b, c)
LADDER = f"""g AS (SELECT *, {genes('a')} AS u1, {genes('list_concat(b, c)')} AS u2, CASE WHEN len(b) > 0 AND len(c) > 0 THEN list_intersect({genes('b')}, {genes('c')}) WHEN len(b) > 0 THEN {genes('b')} ELSE {genes('c')} END AS i2 FROM z),
h AS (SELECT *, CASE WHEN s1 >= s2 THEN [list_intersect(i2, u1), list_intersect(i2, u1), list_intersect(u2, u1), list_intersect(u2, u1)] ELSE [list_intersect(u1, i2), list_intersect(u1, u2), list_intersect(u1, i2), list_intersect(u1, u2)] END AS tries FROM g),
t AS (SELECT *, list_filter(tries, lambda y: len(y) = 1)[1][1] AS gene FROM h)"""


def _count(blocks: list[str], w: float, g: str = "gene") -> str:
    found = cat(*[even(within(x, g), w) for x in blocks])
    return f"CASE WHEN len({found}) > 0 THEN {found} ELSE {AM1} END"


AB, AC = "list_intersect(a, b)", "list_intersect(a, c)"
NONE = "CAST([] AS VARCHAR[])"
# mate 2 first and apart: its last block against a; mate 1 first and apart: a against b
APART2 = f"CASE WHEN cut THEN CASE WHEN len({AC}) > 0 THEN {_count([AC, 'b'], 1)} ELSE {_count(['a', 'b', 'c'], 1)} END ELSE CASE WHEN len({AB}) > 0 THEN {_count([AB], 1)} ELSE {_count(['a', 'b'], 1)} END END"
APART1 = f"CASE WHEN len({AB}) > 0 THEN {_count([AB, 'c'], 1)} ELSE {_count(['a', 'b', 'c'], 1)} END"
CROSS = _count([AB, AC, f"(CASE WHEN len({AB}) = 0 AND len({AC}) = 0 THEN a ELSE {NONE} END)", f"(CASE WHEN len({AB}) = 0 THEN b ELSE {NONE} END)", f"(CASE WHEN len({AC}) = 0 THEN c ELSE {NONE} END)"], 1)
EMPTY = "len(a) = 0 AND len(b) = 0 AND len(c) = 0"
BLOCK_ONCE = f"""{V}{SETS.replace('{mate2}', PARTS)}, {LADDER}, k AS (SELECT pid, CASE WHEN {EMPTY} THEN {NF1} WHEN gene IS NULL THEN {AM1} WHEN s1 >= s2 AND e2 <= s1 THEN {APART2} WHEN s1 < s2 AND e1 <= s2 THEN {APART1} ELSE {CROSS} END{END.replace('FROM z{more}', 'FROM t')}"""
BLOCK_HALF = f"""{V}{SETS.replace('{mate2}', PARTS)}, {LADDER}, k AS (SELECT pid, CASE WHEN {EMPTY} THEN {NF1}
 WHEN len(u1) = 1 AND len(i2) = 1 THEN CASE WHEN u1[1] = i2[1] THEN {cat(_count(['a'], 0.5, 'u1[1]'), _count(['b', 'c'], 0.5, 'u1[1]'))} ELSE {AM1} END
 WHEN len(u1) = 1 AND len(i2) > 1 THEN list_concat({_count(['a'], 0.5, 'u1[1]')}, CASE WHEN list_contains(i2, u1[1]) THEN {_count(['b', 'c'], 0.5, 'u1[1]')} ELSE {AM1} END)
 WHEN len(u1) > 1 AND len(i2) = 1 THEN list_concat({_count(['b', 'c'], 0.5, 'i2[1]')}, CASE WHEN list_contains(u1, i2[1]) THEN {_count(['a'], 0.5, 'i2[1]')} ELSE {AM1} END)
 WHEN gene IS NULL THEN {AM1} ELSE {cat(_count(['a'], 0.5), _count(['b', 'c'], 0.5))} END{END.replace('FROM z{more}', 'FROM t')}"""

for _name, _sql in (("split_half", SPLIT_HALF), ("pair_once", PAIR_ONCE), ("block_once", BLOCK_ONCE), ("block_half", BLOCK_HALF)):
    QUERIES[f"exon_{_name}"] = lambda spark, sf, m=_name: per_exon(spark, sf, m)
    ORACLES[f"exon_{_name}"] = _sql


def cell_exon_counts(spark: SparkSession, sf: str) -> DataFrame:
    a = assign_exon.assign(pair_view(spark, sf, spliced=True), [*PID, "cell"], exon_view(spark, sf), "split_half", WIDTH)
    return counts.feature_counts(a.where("exon_id IS NOT NULL"), ["cell", "exon_id"], "weight").withColumn("count", F.round("count", 6))


QUERIES["cell_exon_counts"] = cell_exon_counts
ORACLES["cell_exon_counts"] = SPLIT_HALF.replace("SELECT pid, w.f AS feature, round(sum(w.w), 6) AS weight FROM r GROUP BY 1, 2", "SELECT cell, w.f AS exon_id, round(sum(w.w), 6) AS count FROM r JOIN pair ON r.pid = pair.pid WHERE w.f NOT IN ('no_feature', 'ambiguous') GROUP BY 1, 2")
