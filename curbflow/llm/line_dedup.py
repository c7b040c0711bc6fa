"""Removal of repeated runs of lines with a suffix array over line ids.

Lines become ids. Lines that occur once in the corpus can't be in a repeated run and end it, so
the suffix array is built over stretches of consecutive lines that occur more often. Prefix
doubling sorts their suffixes as Spark jobs. A suffix's rank is the number of suffixes with a
smaller prefix; a round counts the distinct pairs (rank, rank 2^k lines on), sorts these, and adds
up the counts within each rank. Suffixes whose rank is theirs alone, or whose stretch ends within
the prefix, are placed for good and take no part in further rounds. Neighbours in the final order
get their longest common prefixes by descending through the rounds' ranks; a pair joins in at the
first round that is not longer than its stretches. Passes with a stack over ranges of the suffix
array turn the prefix intervals into the longest run that also begins at an earlier place. Ranges
have at most ``RANGE`` suffixes, whatever lines they start with; what a range must know of all others is, for
each length of common prefix at its two ends, the earliest place beyond that shares it. These
borders compose, so they are passed on in a tree: along the ranges of a task, then from task to task.

A run goes when it begins at an earlier place, too (smaller doc_id, then text, then line), and
weighs at least ``min_words`` words; the first copy stays. Two letters of a script without spaces
weigh as a word. Shorter runs stay, as headings and closing lines of a few words are alike without
being copies. A line that lies in any such run is deleted with its newline.

Defined results: a null text stays null. A null id comes after all others. Rows of one id and
text are one document: they lose the same lines, none to another. Empty lines count as lines
without words. Texts whose lines all go become empty; ``drop_emptied`` leaves such rows out.
All columns of the documents come back, in place, other columns untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbflow.llm.groups import sorted_groups, stored
from curbflow.llm.workers import give_back, lean

MIN_WORDS = 10
RANGE = 1 << 14
HOT = 64  # a value of more than one in so many rows is dealt to several tasks
SALT = 16

_KEY = ["id", "key"]

# Letters of scripts that set no spaces between words (Thai to Lao, Burmese, Khmer,
# Japanese syllables, Chinese characters).
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")


def weight(line: str) -> int:
    """The words of a line; two letters of a script without spaces weigh as one."""
    words = len(line.split())
    return words if line.isascii() else words + len(_UNSPACED.findall(line)) // 2


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(p, r, r2, n, within, edge): how many of rank r have a smaller r2 in this partition, which is
    sorted; a last row tells of the first and of the last rank (r and how many in the partition), of
    all rows and of the most rows of one pair."""
    p = TaskContext.get().partitionId()
    first, last, all_, most, names = None, None, 0, 0, ["p", "r", "r2", "n", "within", "edge"]
    for batch in batches:
        if not batch.num_rows:
            continue
        r, r2, n = (c.to_numpy() for c in batch.columns)
        all_, most = all_ + int(n.sum()), max(most, int(n.max()))
        total = np.concatenate([[0], np.cumsum(n)])
        starts = np.flatnonzero(np.append(True, np.diff(r) != 0))
        sizes = np.diff(np.append(starts, len(r)))
        base = np.repeat(total[starts], sizes)
        sums = np.add.reduceat(n, starts)
        if last is not None and last[0] == r[0]:
            base[: sizes[0]] -= last[1]
            sums[0] += last[1]
        if first is None or first[0] == r[0]:
            first = (int(r[0]), int(sums[0]))
        last = (int(r[-1]), int(sums[-1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(r), p)), *batch.columns, pa.array(total[:-1] - base), pa.nulls(len(r), pa.list_(pa.int64()))], names=names
        )
    if first is not None:
        none = [pa.nulls(1, pa.int64())] * 4
        yield pa.RecordBatch.from_arrays([pa.array([p]), *none, pa.array([[*first, *last, all_, most]], pa.list_(pa.int64()))], names=names)


def ranked(spark: SparkSession, pairs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(r, r2, n, name) of rows (r, r2, n): r plus the count of all rows of r with a smaller r2; and
    the pairs (r, r2) that hold more than one in ``HOT`` rows, if there are any."""
    dealt = pairs.select("r", "r2", "n").repartitionByRange("r", "r2").sortWithinPartitions("r", "r2")
    table = stored(spark, dealt.mapInArrow(lean(_within), "p long, r long, r2 long, n long, within long, edge array<long>"), "names")
    # a rank that goes on from partition to partition: one row for each partition
    carries, rank, held, total, most = [], None, 0, 0, 0
    for row in table.where("edge IS NOT NULL").select("p", "edge").orderBy("p").collect():
        first, first_n, last, last_n, own, own_most = row["edge"]
        total, most = total + own, max(most, own_most)
        carry = held if first == rank else 0
        carries.append((row["p"], first, carry))
        rank, held = last, last_n + (carry if first == last else 0)
    at = spark.createDataFrame(carries or [(0, 0, 0)], "p long, first long, carry long")
    hot = table.where(F.col("n") * HOT > total).select("r", "r2") if most * HOT > total else None
    names = table.where("edge IS NULL").join(F.broadcast(at), "p")
    return names.select("r", "r2", "n", F.expr("r + within + IF(r = first, carry, 0L)").alias("name")), hot


def with_names(rows: DataFrame, names: DataFrame, hot: DataFrame | None, keys: list[str], own: str) -> DataFrame:
    """``rows`` joined with their ``names`` by ``keys``. Rows of ``hot`` keys, of which there are less
    than ``HOT``, are dealt to ``SALT`` tasks by ``own``."""
    if hot is None:
        return rows.join(names, keys)
    hot = hot.select(*keys, F.lit(SALT).alias("salts"))
    flagged = lambda frame: frame.join(F.broadcast(hot), keys, "left")
    salt = F.pmod(F.xxhash64(own), F.coalesce("salts", F.lit(1))).cast("int")
    copies = F.explode(F.expr("sequence(0, coalesce(salts, 1) - 1)"))
    left = flagged(rows).withColumn("salt", salt).drop("salts")
    right = flagged(names).withColumn("salt", copies).drop("salts")
    return left.join(right, [*keys, "salt"]).drop("salt")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """The lines that occur more than once: g (number in document order), id, key, pos, ``last`` (the
    g at which its stretch ends), rank r by the line alone, and n, how many lines have this rank."""
    spark = docs.sparkSession
    lines = docs.select("id", "key", F.posexplode(F.split("text", "\n")).alias("pos", "line")).select(
        "id", "key", "pos", F.xxhash64("line").alias("r2")
    )
    shared = lines.groupBy("r2").agg(F.count("*").alias("n")).where("n > 1").select(F.lit(0).cast("long").alias("r"), "r2", "n")
    names, hot = ranked(spark, shared)
    kept = with_names(lines, names.select("r2", "n", "name"), hot, ["r2"], "pos").select("id", "key", "pos", "n", F.col("name").alias("r"))
    dealt = kept.repartitionByRange(F.col("id").asc_nulls_last(), "key")
    doc = Window.partitionBy(*_KEY).orderBy("pos")
    # rows of one id and text are one document
    once = dealt.withColumn("before", F.lag("pos").over(doc)).where("before IS NULL OR before < pos").drop("before")
    stretch = once.withColumn("stretch", F.col("pos") - F.row_number().over(doc)).withColumn(
        "rest", F.count("*").over(Window.partitionBy(*_KEY, "stretch"))
    )
    numbered = stretch.withColumn("inner", F.row_number().over(Window.partitionBy(*_KEY, "stretch").orderBy("pos")))
    ordered = numbered.sortWithinPartitions(F.col("id").asc_nulls_last(), "key", "pos").withColumn("g", F.monotonically_increasing_id())
    out = ordered.select("g", "id", "key", "pos", (F.col("g") + F.col("rest") - F.col("inner")).alias("last"), "r", "n")
    return stored(spark, out, "numbered")


def prefix_doubling(lines: DataFrame) -> list[DataFrame]:
    """Tables (g, last, first, r, n) by the first 1, 2, 4, ... lines: ranks r and their counts n of
    the suffixes that take part in the round. A suffix's final rank is that of its last round."""
    spark = lines.sparkSession
    levels = [lines.select("g", "last", F.col("r").alias("first"), "r", "n")]
    while True:
        size = 1 << (len(levels) - 1)
        active = levels[-1].where(_active(size))
        if active.isEmpty():
            return levels
        ranks = final_ranks(levels).select(F.col("g").alias("at"), F.col("r").alias("r2"))
        further = active.where(f"g + {size} <= last").withColumn("at", F.col("g") + size).join(ranks, "at").drop("at")
        pairs = further.union(active.where(f"g + {size} > last").withColumn("r2", F.lit(-1).cast("long")))
        pairs = stored(spark, pairs.select("g", "last", "first", "r", "r2"), "pairs")
        names, hot = ranked(spark, pairs.groupBy("r", "r2").agg(F.count("*").alias("n")))
        levels.append(stored(spark, with_names(pairs, names, hot, ["r", "r2"], "g").select("g", "last", "first", F.col("name").alias("r"), "n"), "ranks"))


def _active(size: int) -> str:
    """SQL: the suffixes of a round by ``size`` lines that take part in the next one."""
    return f"n > 1 AND last - g + 1 >= {size}"


def final_ranks(levels: list[DataFrame]) -> DataFrame:
    """(g, last, first, r) of all suffixes by their latest rank."""
    out = None
    for k, level in enumerate(levels):
        rows = level if k == len(levels) - 1 else level.where(f"NOT ({_active(1 << k)})")
        rows = rows.select("g", "last", "first", "r")
        out = rows if out is None else out.union(rows)
    return out


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, x, g, last, first, p, last_p, first_p, tail): each suffix of a sorted partition with the
    one before; ``tail`` marks the partition's last."""
    part, x, held = TaskContext.get().partitionId(), 0, None
    names = ["part", "x", "g", "last", "first", "p", "last_p", "first_p", "tail"]

    def rows(table: pa.Table, tail: bool) -> Iterator[pa.RecordBatch]:
        nonlocal x, before
        g, last, first = (table.column(c).to_numpy() for c in ("g", "last", "first"))
        n = len(g)
        shifted = [np.append(b, c[:-1]) for b, c in zip(before, (g, last, first))]
        end = np.zeros(n, bool)
        end[-1] = tail
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (np.full(n, part), np.arange(x, x + n), g, last, first, *shifted, end)], names=names
        )
        x, before = x + n, [c[-1] for c in (g, last, first)]

    before = [np.int64(-1)] * 3
    for batch in batches:
        if batch.num_rows:
            if held is not None:
                yield from rows(pa.Table.from_batches([held]), False)
            held = batch
    if held is not None:
        yield from rows(pa.Table.from_batches([held]), True)


def neighbours(spark: SparkSession, levels: list[DataFrame]) -> DataFrame:
    """The suffix array (part, x, g, last, first) with the suffix before, p, last_p, first_p (-1 for none)."""
    order = final_ranks(levels).repartitionByRange("r", "g").sortWithinPartitions("r", "g").select("g", "last", "first")
    schema = "part long, x long, g long, last long, first long, p long, last_p long, first_p long, tail boolean"
    order = stored(spark, order.mapInArrow(lean(_beside), schema), "order")
    # across partitions: one row for each
    fixes, before = [], (-1, -1, -1)
    for r in order.where("tail").select("part", "g", "last", "first").orderBy("part").collect():
        fixes.append((r["part"], *before))
        before = (r["g"], r["last"], r["first"])
    at = spark.createDataFrame(fixes or [(0, -1, -1, -1)], "part long, fix_p long, fix_last_p long, fix_first_p long")
    fixed = [F.expr(f"IF(x = 0, fix_{c}, {c})").alias(c) for c in ("p", "last_p", "first_p")]
    return order.join(F.broadcast(at), "part").select("part", "x", "g", "last", "first", *fixed)


def common_prefixes(lines: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(range, x, g, lcp): the suffix array in ranges, with common prefixes of neighbours, in lines."""
    spark = lines.sparkSession
    pairs = neighbours(spark, levels)
    range_ = (F.shiftleft("part", 33) + F.floor(F.col("x") / RANGE)).alias("range")
    alike = pairs.where("first = first_p").select(
        range_, "x", "g", "last", "p", "last_p", F.expr("least(last - g, last_p - p) + 1").alias("most"), F.lit(0).cast("long").alias("l")
    )
    alike = stored(spark, alike, "alike")
    done = [pairs.where("first <> first_p").select(range_, "x", "g", F.lit(0).cast("long").alias("lcp"))]
    done.append(alike.where("most = 1").select("range", "x", "g", F.lit(1).cast("long").alias("lcp")))
    now = None
    for k in reversed(range(len(levels))):
        size, rank = 1 << k, levels[k].select("g", "r")
        # pairs join in at the longest round that fits them; those longer than all rounds at the last round
        new = alike.where(f"most > 1 AND most >= {size}" + (f" AND most < {2 * size}" if k < len(levels) - 1 else ""))
        now = new if now is None else now.union(new)
        again = True
        while again:  # at the last round more than one step may fit
            fits = f"l + {size} <= most"
            step = now.where(fits).withColumn("at", F.col("g") + F.col("l")).withColumn("at_p", F.col("p") + F.col("l"))
            step = step.join(rank.toDF("at", "r"), "at", "left").join(rank.toDF("at_p", "r_p"), "at_p", "left")
            same = "coalesce(r = r_p, false)"
            moved = step.select("range", "x", "g", "last", "p", "last_p", "most", F.expr(f"l + IF({same}, {size}L, 0L)").alias("l"), F.expr(same).alias("on"))
            now = stored(spark, moved.union(now.where(f"NOT ({fits})").withColumn("on", F.lit(False))), "prefixes")
            again = k == len(levels) - 1 and not now.where(f"on AND l + {size} <= most").isEmpty()
            now = now.drop("on")
    if now is not None:
        done.append(now.select("range", "x", "g", F.col("l").alias("lcp")))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


_RANGES = (
    "range long, g array<long>, lcp array<long>, low long, left_g array<long>, left_lcp array<long>, right_g array<long>, right_lcp array<long>"
)


def _border(g: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of places with the lines that they share with one suffix: the earliest for each number of
    lines, where it is earlier than all that share more. Both ascend."""
    order = np.lexsort((g, -shared))
    g, shared = g[order], shared[order]
    least = np.minimum.accumulate(g)
    keep = np.append(True, g[1:] < least[:-1])[: len(g)] & (shared > 0)
    return g[keep][::-1], shared[keep][::-1]


def packed_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each range: its suffixes, the least prefix within, and what it shows on both sides."""

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        number, g, lcp = (table.column(c).to_numpy() for c in ("range", "g", "lcp"))
        edges = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [len(number)]])
        rows = []
        for a, b in zip(edges, edges[1:]):
            inner = lcp[a + 1 : b]
            whole = np.array([np.iinfo(np.int64).max])
            left = _border(g[a:b], np.append(np.minimum.accumulate(inner[::-1])[::-1], whole))
            right = _border(g[a:b], np.append(whole, np.minimum.accumulate(inner)))
            rows.append((int(number[a]), g[a:b], lcp[a:b], int(np.append(inner, whole).min()), *left, *right))
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), *[pa.list_(pa.int64())] * 4]
        names = ["range", "g", "lcp", "low", "left_g", "left_lcp", "right_g", "right_lcp"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    yield from sorted_groups(batches, "range", work)


_NONE = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _passed(g, lcp, beyond, low: int, head: int):
    """The border one range on: the range's own places and those beyond it."""
    places = np.concatenate([np.asarray(g, np.int64), beyond[0]])
    return _border(places, np.minimum(np.concatenate([np.asarray(lcp, np.int64), np.minimum(beyond[1], low)]), head))


def passed_on(ends: list, first_before=_NONE, last_after=_NONE) -> tuple[list, list]:
    """Of ranges in order the borders of all that lies before each, and of all that lies after."""
    before, after = [first_before], [last_after]
    for r, following in zip(ends, ends[1:]):
        before.append(_passed(r["left_g"], r["left_lcp"], before[-1], r["low"], following["head"]))
    for r in ends[:0:-1]:
        after.append(_passed(r["right_g"], r["right_lcp"], after[-1], r["low"], r["head"]))
    return before, after[::-1]


def as_one(ends: list) -> dict:
    """What consecutive ranges show together."""
    whole = np.iinfo(np.int64).max
    left, right, low = _NONE, [_NONE], whole
    for i, r in enumerate(ends):
        if i:
            low = min(low, r["head"])
            left = (left[0], np.minimum(left[1], r["head"]))
        right.append((np.asarray(r["right_g"], np.int64), np.minimum(np.asarray(r["right_lcp"], np.int64), low)))
        left = _passed(r["left_g"], r["left_lcp"], left, r["low"], whole)
        low = min(low, r["low"])
    right = _border(*(np.concatenate(c) for c in zip(*right)))
    return {"head": ends[0]["head"], "low": low, "left_g": left[0], "left_lcp": left[1], "right_g": right[0], "right_lcp": right[1]}


_END = "head long, low long, left_g array<long>, left_lcp array<long>, right_g array<long>, right_lcp array<long>"
_BORDER = "before_g array<long>, before_lcp array<long>, after_g array<long>, after_lcp array<long>"


def _rows(rows: list[dict], key: str, schema: str) -> pa.RecordBatch:
    names = [key, *(c.split()[0] for c in schema.split(", "))]
    kinds = [pa.int64(), *(pa.list_(pa.int64()) if "array" in c else pa.int64() for c in schema.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)


def _borders(ends: list[dict], key: str, first_before=_NONE, last_after=_NONE) -> pa.RecordBatch:
    before, after = passed_on(ends, first_before, last_after)
    rows = [{key: r[key], "before_g": b[0], "before_lcp": b[1], "after_g": a[0], "after_lcp": a[1]} for r, b, a in zip(ends, before, after)]
    return _rows(rows, key, _BORDER)


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, part)), *batch.columns], names=["part", *batch.schema.names])


def _parts(table: pa.Table) -> Iterator[list[dict]]:
    rows = table.to_pylist()
    k = 0
    while k < len(rows):
        end = next((i for i in range(k, len(rows)) if rows[i]["part"] != rows[k]["part"]), len(rows))
        yield rows[k:end]
        k = end


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        yield _rows([{"part": rows[0]["part"], **as_one(rows)} for rows in _parts(table)], "part", _END)

    return sorted_groups(batches, "part", work)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ends = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["part"])
    if ends:
        yield _borders(ends, "part")


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for rows in _parts(table):
            one = {c: np.array(rows[0][c], np.int64) for c in ("before_g", "before_lcp", "after_g", "after_lcp")}
            yield _borders(rows, "range", (one["before_g"], one["before_lcp"]), (one["after_g"], one["after_lcp"]))

    return sorted_groups(batches, "part", work)


def borders(ranges: DataFrame) -> DataFrame:
    """(range, before_g, before_lcp, after_g, after_lcp): what each range shares with all that lie
    before, by its first suffix, and with all that lie after, by its last one. A border has at most
    as many places as the suffix there has lines.

    Each task sums up its stretch of consecutive ranges; one task passes borders on from stretch to
    stretch (a row for each partition), and every task then from range to range.
    """
    spark = ranges.sparkSession
    ends = ranges.select("range", F.expr("lcp[0]").alias("head"), "low", "left_g", "left_lcp", "right_g", "right_lcp")
    ends = ends.repartitionByRange("range").sortWithinPartitions("range").mapInArrow(lean(_placed), f"part long, range long, {_END}")
    ends = stored(spark, ends, "ends")
    dealt = lambda frame: frame.repartition("part").sortWithinPartitions("part", "range")
    parts = dealt(ends).mapInArrow(lean(_summaries), f"part long, {_END}")
    across = stored(spark, parts.repartition(1).mapInArrow(lean(_across), f"part long, {_BORDER}"), "across")
    return dealt(ends.join(across, "part")).mapInArrow(lean(_down), f"range long, {_BORDER}")


def longest_earlier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, lines): the longest run of lines from g that begins at an earlier place, too.

    One pass in suffix order for each range, with a stack: a suffix leaves it when a neighbour with
    a smaller place, or with a shorter common prefix, settles its longest run. The borders stand in
    for all suffixes before and after the range.
    """
    for batch in batches:
        for i in range(batch.num_rows):
            own_g, own_lcp, before_g, before_lcp, after_g, after_lcp = (batch.column(c)[i].as_py() for c in range(6))
            place = [*before_g, *own_g, *after_g[::-1]]
            # places of a border share with each other what the one further off shares with the range
            common = [0, *before_lcp, *own_lcp[1:], *after_lcp[::-1]]
            out_g: list[int] = []
            out_l: list[int] = []
            stack: list[tuple[int, int]] = []
            for g, run in zip(place, common):
                while stack and (g < stack[-1][0] or run <= stack[-1][1]):
                    top, kept = stack.pop()
                    out_g.append(top)
                    if g < top:
                        out_l.append(max(run, kept))
                        run = min(run, kept)
                    else:
                        out_l.append(kept)
                stack.append((g, run if stack else 0))
            for g, run in stack:
                out_g.append(g)
                out_l.append(run)
            found_g, found_l = np.array(out_g, np.int64), np.array(out_l, np.int64)
            keep = (found_l > 0) & ~np.isin(found_g, [*before_g, *after_g])
            yield pa.RecordBatch.from_arrays([pa.array(found_g[keep]), pa.array(found_l[keep])], names=["g", "lines"])


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(id, key, starts, lines): each document's runs that begin at an earlier place, too, by its line numbers."""
    spark = docs.sparkSession
    lines = repeated_lines(docs)
    array = common_prefixes(lines, prefix_doubling(lines))
    ranges = stored(spark, array.repartition("range").sortWithinPartitions("range", "x").select("range", "g", "lcp").mapInArrow(lean(packed_ranges), _RANGES), "ranges")
    both = ranges.select("range", "g", "lcp").join(borders(ranges), "range")
    found = both.select("g", "lcp", "before_g", "before_lcp", "after_g", "after_lcp").mapInArrow(lean(longest_earlier), "g long, lines long")
    runs = found.join(lines.select("g", *_KEY, "pos"), "g").groupBy(*_KEY).agg(F.collect_list(F.struct("pos", "lines")).alias("runs"))
    return runs.select(*_KEY, F.col("runs.pos").alias("starts"), F.col("runs.lines").alias("lines"))


def without_runs(text: str, starts: np.ndarray, lines: np.ndarray, min_words: int) -> tuple[str, int]:
    """The text without the lines of the runs that weigh enough, and how many these are."""
    own = text.split("\n")
    step = np.zeros(len(own) + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lines, -1)
    total = np.zeros(len(own) + 1, np.int64)
    total[1:] = np.cumsum([weight(line) if some else 0 for line, some in zip(own, np.cumsum(step[:-1]) > 0)])
    heavy = total[starts + lines] - total[starts] >= min_words
    step[:] = 0
    np.add.at(step, starts[heavy], 1)
    np.add.at(step, (starts + lines)[heavy], -1)
    gone = np.cumsum(step[:-1]) > 0
    return "\n".join(line for line, g in zip(own, gone) if not g), int(gone.sum())


def deduplicate(docs: DataFrame, min_words: int = MIN_WORDS, drop_emptied: bool = False) -> DataFrame:
    """``docs`` without the later copies of repeated runs of lines, with the same columns and ``lines_removed``."""
    keyed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        docs["doc_id"].cast("long").alias("id"),
        F.xxhash64(docs["text"].cast("string")).alias("key"),
    )
    text = F.col("row.text").cast("string")
    runs = repeated_runs(keyed.where("row.text IS NOT NULL").select("id", "key", text.alias("text"))).toDF("of", "of_key", "starts", "lines")
    joined = keyed.join(runs, F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")), "left")

    @F.arrow_udf("text string, gone long")
    def cut(texts: pa.Array, starts: pa.Array, lines: pa.Array) -> pa.Array:
        rows = []
        for i in range(len(texts)):
            if starts[i].is_valid:
                rows.append(without_runs(texts[i].as_py(), starts[i].values.to_numpy(), lines[i].values.to_numpy(), min_words))
            else:
                rows.append((None, 0))
        give_back()
        columns = [pa.array([t for t, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())]
        return pa.StructArray.from_arrays(columns, names=["text", "gone"])

    # only texts with runs go to Python, and only once
    cut = cut.asNondeterministic()
    done = joined.select("row", cut(F.when(F.col("starts").isNotNull(), text), "starts", "lines").alias("cut"))
    done = done.select(F.col("row").withField("text", F.coalesce("cut.text", text)).alias("row"), F.col("cut.gone").alias("gone"))
    if drop_emptied:
        done = done.where("NOT (gone > 0 AND trim(row.text) = '')")
    return done.select("row.*", F.col("gone").alias("lines_removed"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return deduplicate(docs)
