"""How the sources of a language differ in their words, with late materialisation of the words.

Words are counted by fixed-width digests. A task finds the words of whole texts and counts them by
(language, source, digest) over a window of blocks; only digests and counts are shuffled. They add
up to the counts of every source and the documents of every language, which settle the kept
digests. A second pass over the texts, past a bit field of fixed size that holds all kept digests,
takes each kept digest's least and greatest word: where they differ, two words share a digest, and
that digest is split. Its words (few at 64 bits, but any number is handled) are counted anew from
the texts under a number of their own. A digest whose words fall short together is not looked at:
apart they'd hold no more documents. The words come back as text only for the rows of the report.

Shares are whole numbers: p = 1 + floor(10^9 (count + 2) / (N + 2 V)) with N the kept words'
occurrences in the group and V the language's kept words; f = floor((p - q)^2 / (p + q)). The sum of
f over all kept words is taken from those that occur: for sources a and b it is the sum over a's
words against b's share of an absent word (from a's few distinct counts, not from its words), the
same the other way round, the words that neither has, and a correction for the words that both
have. Those are met word by word in tasks that add up all pairs of sources before anything leaves.

Defined results: null text, lang and source are ''. A document without words still makes its group
occur. Repeated rows count each. A language without kept words has value 0 in all pairs. A source
that is alone in its language has no pair rows. An empty table gives no rows. Other columns are
not read. Counts are exact up to 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbflow.llm import textbytes as tb
from curbflow.llm.groups import stored

LEAST_DOCS = 10
TOP = 10
UNIT = 1_000_000_000
WINDOW_ROWS = 1_000_000  # counts that a task holds at once
NAME_ROWS = 100_000  # digests whose words a task holds at once
FIELD_BITS = 25  # 2 ** FIELD_BITS bits that stand for all kept digests
PAIR_ROWS = 1 << 18  # pairs of sources that a task works on at once

# the word pattern [^\x00-\x40\x5B-\x60\x7B-\x7F]+ after lower-casing A-Z, by bytes of UTF-8
_IN_WORD = tb.byte_table(lambda b: 97 <= b <= 122 or b >= 128)

_COUNTS = ["lang_id", "source_id", "digest", "n", "docs"]


def _grouped(keys: list[np.ndarray], values: list[np.ndarray]):
    """Distinct rows of ``keys`` with the sums of ``values``."""
    if not len(keys[0]):
        return keys, values
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    first = np.append(True, np.any([np.diff(k) != 0 for k in keys], axis=0)) if len(order) > 1 else np.ones(1, bool)
    at = np.flatnonzero(first)
    return [k[at] for k in keys], [np.add.reduceat(v[order], at) for v in values]


class _Names:
    """The least and the greatest word of each digest."""

    def __init__(self):
        self.low: dict[int, bytes] = {}
        self.high: dict[int, bytes] = {}

    def block(self, low: np.ndarray, digests: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """``low`` holds the words' bytes; every word is compared with the first of its digest."""
        if not len(digests):
            return
        uniq, first, inverse = np.unique(digests, return_index=True, return_inverse=True)
        raw = low.tobytes()
        words = [raw[starts[i] : ends[i]] for i in first]
        for d, w in zip(uniq.tolist(), words):
            self._add(d, w)
        size = ends - starts
        head = first[inverse]
        other = size != size[head]
        for k in range(0, len(size), 1 << 17):  # byte by byte, in steps
            own = size[k : k + (1 << 17)]
            inner = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
            a = np.repeat(starts[k : k + len(own)], own) + inner
            b = np.minimum(np.repeat(starts[head[k : k + len(own)]], own) + inner, len(low) - 1)
            bad = np.flatnonzero(low[a] != low[b])
            other[k + np.searchsorted(np.cumsum(own), bad, side="right")] = True
        for i in np.flatnonzero(other):
            self._add(int(digests[i]), raw[starts[i] : ends[i]])

    def _add(self, digest: int, word: bytes) -> None:
        now = self.low.get(digest)
        if now is None:
            self.low[digest] = self.high[digest] = word
        elif now != word:
            self.low[digest] = min(now, word)
            self.high[digest] = max(self.high[digest], word)


def digested(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).view(np.int64) if bits < 64 else hashes.view(np.int64)


def _blocks(batch: pa.RecordBatch, column: int, bits: int):
    """(rows, low bytes, digests, starts, ends, document of each word) block by block."""
    data, offsets = tb.utf8(batch.column(column))
    for first, last in tb.blocks(offsets):
        part = data[offsets[first] : offsets[last]]
        own = offsets[first : last + 1] - offsets[first]
        hashes, starts, ends = tb.hashed_words(part, own, _IN_WORD)
        document = np.searchsorted(own, starts, side="right") - 1
        yield slice(first, last), tb.LOWER[part], digested(hashes, bits), starts, ends, document


def _block_counts(source: np.ndarray, digests: np.ndarray, document: np.ndarray):
    """(source, digest), (occurrences, documents) of a block's words; ``source`` is each word's."""
    words, word = np.unique(digests, return_inverse=True)
    sources, own = np.unique(source, return_inverse=True)
    pairs, first, n = np.unique(document * len(words) + word, return_index=True, return_counts=True)
    rows, at = np.unique(own[first] * len(words) + word[first], return_inverse=True)
    counts = [np.bincount(at, n, len(rows)).astype(np.int64), np.bincount(at, minlength=len(rows))]
    return [sources[rows // len(words)], words[rows % len(words)]], counts


def word_counts(docs: DataFrame, bits: int = 64) -> DataFrame:
    """Tasks' partial counts of (lang_id, source_id, digest) with their documents."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, rows, langs = [], [], 0, {}

        def merged():
            return _grouped([np.concatenate(k) for k in zip(*keys)], [np.concatenate(v) for v in zip(*values)])

        def rows_of(k, v) -> pa.RecordBatch:
            sources, own = np.unique(k[0], return_inverse=True)
            lang = np.array([langs[x] for x in sources.tolist()], np.int64)[own]
            return pa.RecordBatch.from_arrays([*map(pa.array, [lang, *k, *v])], names=_COUNTS)

        for batch in batches:
            lang, source = (batch.column(c).to_numpy() for c in (0, 1))
            langs.update(zip(source.tolist(), lang.tolist()))
            for own, _, digests, _, _, document in _blocks(batch, 2, bits):
                if not len(digests):
                    continue
                k, v = _block_counts(source[own][document], digests, document)
                keys.append(k)
                values.append(v)
                rows += len(k[0])
                if rows > WINDOW_ROWS:
                    k, v = merged()
                    keys, values, rows = [k], [v], len(k[0])
                    if rows > WINDOW_ROWS // 4 * 3:
                        yield rows_of(k, v)
                        keys, values, rows = [], [], 0
        if keys:
            yield rows_of(*merged())

    schema = "lang_id long, source_id long, digest long, n long, docs long"
    return docs.select("lang_id", "source_id", "text").mapInArrow(task, schema)


def _place(digests: np.ndarray, field_bits: int) -> np.ndarray:
    return (tb.mixed(digests.view(np.uint64)) >> np.uint64(64 - field_bits)).astype(np.int64)


def bit_field(digests: DataFrame, field_bits: int = FIELD_BITS) -> np.ndarray:
    """A field of 2 ** field_bits bits (as bytes), set at the place of every row's ``digest``.

    Tasks make its sections, so what reaches the driver has the field's size, whatever the rows.
    """
    section = max(3, field_bits - 10)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = _place(batch.column(0).to_numpy(), field_bits)
            yield pa.RecordBatch.from_arrays([pa.array(place >> section), pa.array(place & ((1 << section) - 1))], names=["section", "place"])

    def sections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            number, place = (c.to_numpy() for c in batch.columns)
            for k in np.unique(number).tolist():
                made.setdefault(k, np.zeros(1 << section, bool))[place[number == k]] = True
        packed = [np.packbits(m, bitorder="little").tobytes() for m in made.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.int64()), pa.array(packed, pa.binary())], names=["section", "bits"])

    dealt = digests.select("digest").mapInArrow(places, "section long, place long").distinct().repartition("section")
    field = np.zeros((1 << (field_bits - section), (1 << section) // 8), np.uint8)
    for r in dealt.mapInArrow(sections, "section long, bits binary").collect():
        field[r["section"]] = np.frombuffer(r["bits"], np.uint8)
    return field.ravel()


def word_names(docs: DataFrame, wanted: DataFrame, bits: int = 64, field_bits: int = FIELD_BITS) -> DataFrame:
    """(digest, low, high): the least and the greatest word of each digest in ``wanted``."""
    field = docs.sparkSession.sparkContext.broadcast(bit_field(wanted, field_bits))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = _Names(), field.value

        def rows_of(names: _Names) -> pa.RecordBatch:
            high = [h if h != names.low[d] else None for d, h in names.high.items()]
            columns = [pa.array(names.low.keys(), pa.int64()), pa.array(names.low.values(), pa.binary()), pa.array(high, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["digest", "low", "high"])

        for batch in batches:
            for _, low, digests, starts, ends, _ in _blocks(batch, 2, bits):
                place = _place(digests, field_bits)
                some = (held[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                names.block(low, digests[some], starts[some], ends[some])
                if len(names.low) > NAME_ROWS:
                    yield rows_of(names)
                    names = _Names()
        if names.low:
            yield rows_of(names)

    found = docs.select("lang_id", "source_id", "text").mapInArrow(task, "digest long, low binary, high binary")
    found = found.join(wanted, "digest", "left_semi")
    return found.groupBy("digest").agg(F.min("low").alias("low"), F.max(F.coalesce("high", "low")).alias("high"))


def split_counts(docs: DataFrame, split: DataFrame, bits: int) -> DataFrame:
    """(lang_id, source_id, digest, word, n, docs) of the words of the digests in ``split``.

    The digests go to the tasks in slices of bounded size, one pass over the texts for each.
    """
    slices = max(1, -(-split.count() // WINDOW_ROWS))
    out = None
    for k in range(slices):
        wanted = np.array(sorted(r[0] for r in split.where(F.pmod(F.xxhash64("digest"), F.lit(slices)) == k).collect()), np.int64)
        part = docs.select("lang_id", "source_id", "text").mapInArrow(_of_split(wanted, bits), "lang_id long, source_id long, digest long, word binary, n long, docs long")
        out = part if out is None else out.union(part)
    return out.groupBy("lang_id", "source_id", "digest", "word").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _of_split(wanted: np.ndarray, bits: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, source = (batch.column(c).to_numpy() for c in (0, 1))
            for own, low, digests, starts, ends, document in _blocks(batch, 2, bits):
                at = np.flatnonzero(np.isin(digests, wanted))
                raw = low.tobytes()
                counts: dict[tuple, list[int]] = {}
                seen = set()
                for i in at:
                    d, word = int(document[i]), raw[starts[i] : ends[i]]
                    row = counts.setdefault((int(lang[own][d]), int(source[own][d]), int(digests[i]), word), [0, 0])
                    row[0] += 1
                    row[1] += (d, word) not in seen
                    seen.add((d, word))
                rows = [(*k, *v) for k, v in counts.items()]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["lang_id", "source_id", "digest", "word", "n", "docs"]
                )

    return task


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with lang_id and source_id, and the table (lang_id, source_id, lang, source) of all groups.

    Ids are hashes; where two names share one, other hashes are taken for all.
    """
    named = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = stored(docs.sparkSession, named.select("lang", "source").distinct(), "groups")
    seed = 0
    while True:
        lang_id, source_id = F.xxhash64(F.lit(seed), "lang"), F.xxhash64(F.lit(seed), "lang", "source")
        ids = groups.select(lang_id.alias("lang_id"), source_id.alias("source_id"), "lang", "source")
        total, langs, lang_ids, source_ids = ids.agg(
            F.count("*"), F.count_distinct("lang"), F.count_distinct("lang_id"), F.count_distinct("source_id")
        ).first()
        if langs == lang_ids and total == source_ids:
            return named.select(lang_id.alias("lang_id"), source_id.alias("source_id"), "text"), ids
        seed += 1


_TERM = ["lang_id", "digest", "sub"]


def kept_terms(docs: DataFrame, bits: int = 64, least: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """(lang_id, source_id, digest, sub, n, whole, first): counts of kept terms by source, with the
    language's count and a flag on one row of each term; and the terms' names (digest, sub, word).
    ``sub`` is 0, or the number of a word that shares its digest."""
    spark = docs.sparkSession

    def summed(frame: DataFrame, keys: list[str]) -> DataFrame:
        term = Window.partitionBy(*keys)
        frame = frame.repartition(*keys).groupBy(*keys, "source_id").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        frame = frame.withColumn("df", F.sum("docs").over(term)).where(F.col("df") >= least)
        return frame.withColumn("whole", F.sum("n").over(term)).withColumn("first", F.row_number().over(term.orderBy("source_id")) == 1).drop("docs", "df")

    plain = summed(word_counts(docs, bits), ["lang_id", "digest"])
    kept = stored(spark, plain.withColumn("sub", F.lit(0).cast("long")).select(*_TERM, "source_id", "n", "whole", "first"), "kept")
    names = stored(spark, word_names(docs, kept.select("digest").distinct(), bits), "names")
    split = stored(spark, names.where("low <> high").select("digest"), "split")
    plain = names.select("digest", F.lit(0).cast("long").alias("sub"), F.col("low").cast("string").alias("word"))
    if split.isEmpty():
        return kept, plain
    again = stored(spark, split_counts(docs, split, bits), "again")
    words = again.select("digest", "word").distinct().withColumn("sub", F.row_number().over(Window.partitionBy("digest").orderBy("word")).cast("long"))
    words = stored(spark, words, "words")
    apart = summed(again.join(words, ["digest", "word"]).drop("word"), _TERM).select(*kept.columns)
    kept = stored(spark, kept.join(split, "digest", "left_anti").select(*kept.columns).union(apart), "kept")
    return kept, plain.join(split, "digest", "left_anti").union(words.select("digest", "sub", F.col("word").cast("string")))


def _share(count: str, total: str, terms: str) -> str:
    """SQL: the whole-number share, exact for any 64-bit counts."""
    return f"(1 + (CAST({UNIT} AS DECIMAL(10, 0)) * CAST({count} + 2 AS DECIMAL(20, 0))) div CAST({total} + 2 * {terms} AS DECIMAL(20, 0)))"


def _apart(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div (({p}) + ({q}))"


def _both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, part): of sources that share terms, what these terms add to the sums over a's and over b's own.

    Rows come sorted by term. Pairs are made in steps of bounded size and added up before they leave.
    """

    def f(p, q):
        return (p - q) * (p - q) // (p + q)

    def added(terms: list[np.ndarray], source, p, absent) -> pa.RecordBatch:
        a, b = terms
        value = f(p[a], p[b]) - f(p[a], absent[b]) - f(absent[a], p[b]) + f(absent[a], absent[b])
        (left, right), (total,) = _grouped([source[a], source[b]], [value])
        return pa.RecordBatch.from_arrays([pa.array(left), pa.array(right), pa.array(total)], names=["a", "b", "part"])

    def pairs(edges: np.ndarray, rows) -> Iterator[pa.RecordBatch]:
        size = np.diff(edges)
        mates = np.repeat(size, size)  # rows of each row's term
        begin = np.repeat(edges[:-1], size)
        ends = np.cumsum(mates)
        k = 0
        while k < len(mates):
            base = ends[k - 1] if k else 0
            stop = max(k + 1, int(np.searchsorted(ends, base + PAIR_ROWS, side="right")))
            own = mates[k:stop]
            a = np.repeat(np.arange(k, stop), own)
            b = np.repeat(begin[k:stop], own) + np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
            apart = a != b
            yield added([a[apart], b[apart]], *rows)
            k = stop

    held: list[pa.RecordBatch] = []

    def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
        lang, digest, sub, source, p, absent = (table.column(c).to_numpy() for c in range(6))
        change = (np.diff(lang) != 0) | (np.diff(digest) != 0) | (np.diff(sub) != 0)
        yield from pairs(np.concatenate([[0], np.flatnonzero(change) + 1, [len(lang)]]), (source, p, absent))

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        key = [table.column(c).to_numpy() for c in range(3)]
        same = (key[0] == key[0][-1]) & (key[1] == key[1][-1]) & (key[2] == key[2][-1])
        cut = int(np.argmax(same))  # the last term may go on
        if cut:
            yield from flush(table.slice(0, cut))
            held = table.slice(cut).to_batches()
    if held:
        yield from flush(pa.Table.from_batches(held))


def audit(docs: DataFrame, bits: int = 64, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) as described above."""
    spark = docs.sparkSession
    numbered, groups = _numbered(docs)
    kept, names = kept_terms(numbered, bits, least)
    langs = kept.groupBy("lang_id").agg(F.sum("n").alias("lang_total"), F.sum(F.col("first").cast("long")).alias("terms"))
    own = kept.groupBy("source_id").agg(F.sum("n").alias("total"), F.count("*").alias("present"))
    zero = lambda *names: [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names]
    stats = groups.join(own, "source_id", "left").join(langs, "lang_id", "left").select(
        "lang_id", "source_id", "lang", "source", *zero("total", "present", "lang_total", "terms")
    )
    stats = stored(spark, stats.withColumn("absent", F.expr(f"IF(terms = 0, 0L, {_share('0', 'total', 'terms')})")), "groups")
    shares = kept.join(stats.drop("lang_id"), "source_id").withColumn("p", F.expr(_share("n", "total", "terms")))
    shares = stored(spark, shares.withColumn("q", F.expr(_share("whole", "lang_total", "terms"))).select(*_TERM, "source_id", "p", "q", "absent"), "shares")

    # terms: the top by value with all ties, then by text
    telling = shares.where("p > q").withColumn("value", F.expr(_apart("p", "q")))
    by_value = Window.partitionBy("source_id").orderBy(F.desc("value"))
    telling = telling.withColumn("place", F.rank().over(by_value)).where(F.col("place") <= top)
    telling = telling.join(names, ["digest", "sub"]).withColumn(
        "rank", F.row_number().over(Window.partitionBy("source_id").orderBy(F.desc("value"), "word"))
    ).where(F.col("rank") <= top)
    terms = telling.join(stats.select("source_id", "lang", "source"), "source_id").select(
        "lang", "source", F.lit("term").alias("part"), F.col("word").alias("item"), "value", "rank"
    )

    # pairs: each source's terms against every other's absent share, from its distinct shares
    few = shares.groupBy("source_id", "p").agg(F.count("*").alias("n")).groupBy("source_id").agg(F.collect_list(F.struct("p", "n")).alias("shares"))
    left = stats.join(few, "source_id", "left")
    right = stats.select("lang_id", F.col("source_id").alias("other_id"), F.col("source").alias("item"), F.col("absent").alias("other_absent"), F.col("present").alias("other_present"))
    one_sided = F.expr(f"aggregate(coalesce(shares, array()), 0L, (s, x) -> s + x.n * ({_apart('x.p', 'other_absent')}))")
    sides = left.join(right, "lang_id").where("source_id <> other_id")
    neither = f"(terms - present - other_present) * ({_apart('absent', 'other_absent')})"
    sides = stored(spark, sides.select("source_id", "other_id", "lang", "source", "item", one_sided.alias("own"), F.expr(f"IF(terms = 0, 0L, {neither})").alias("neither")), "sides")
    both = shares.select(*_TERM, "source_id", "p", "absent").repartition(*_TERM).sortWithinPartitions(*_TERM)
    both = both.mapInArrow(_both, "a long, b long, part long").groupBy("a", "b").agg(F.sum("part").alias("part"))
    back = sides.select(F.col("source_id").alias("other_id"), F.col("other_id").alias("source_id"), F.col("own").alias("theirs"))
    value = F.col("own") + F.col("theirs") + F.col("neither") + F.coalesce("part", F.lit(0))
    pairs = sides.join(back, ["source_id", "other_id"]).join(both.toDF("source_id", "other_id", "part"), ["source_id", "other_id"], "left").withColumn("value", value)
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("source_id").orderBy(F.desc("value"), "item"))).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"
    )
    return pairs.union(terms)


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Every kept word against every source and every pair of sources.
ORACLES = {
    "op12_source_audit": rf"""WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all({_SQL_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
occ AS (SELECT row, lang, source, unnest(ws) AS w FROM d),
kept AS MATERIALIZED (SELECT lang, w FROM occ GROUP BY lang, w HAVING count(DISTINCT row) >= {LEAST_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
counts AS MATERIALIZED (SELECT lang, source, w, count(*) AS c FROM occ JOIN kept USING (lang, w) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
n AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL),
nl AS (SELECT lang, sum(c) AS n FROM counts GROUP BY ALL),
p AS MATERIALIZED (SELECT g.lang, g.source, k.w, coalesce(c, 0) AS c,
  1 + (CAST({UNIT} AS HUGEINT) * (coalesce(c, 0) + 2)) // (coalesce(n.n, 0) + 2 * v.v) AS p
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN counts USING (lang, source, w) LEFT JOIN n USING (lang, source)),
q AS (SELECT lang, w, 1 + (CAST({UNIT} AS HUGEINT) * (sum(c) + 2)) // (any_value(nl.n) + 2 * any_value(v.v)) AS q
  FROM counts JOIN nl USING (lang) JOIN v USING (lang) GROUP BY lang, w),
t AS (SELECT lang, source, 'term' AS part, w AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM p JOIN q USING (lang, w) WHERE c > 0 AND p > q),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.w = b.w AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM t UNION ALL SELECT * FROM pairs))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP}"""
}
