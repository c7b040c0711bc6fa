"""Benchmark decontamination with suffix arrays of the training text.

Every task cuts its documents into shards of about a MB and builds a suffix array of each shard's
words. Every suffix of every benchmark item is then located in it by binary search, word by word
and for all suffixes at once: the interval of training suffixes that agree so far shrinks until
it is empty, which gives the longest verbatim match and all its places. A match counts from a
window of ``WINDOW`` words on, or a whole shorter item. Words in such windows are hit, and
documents with hits can be removed.

Training words that no item holds can't be part of a match and stand as one separator; a stretch
between separators that is shorter than the shortest window is left out of the array. That
changes no result. Words are compared by 64-bit hashes.

The benchmark goes to the executors in slices of about ``SLICE_BYTES`` of text, one after the other
with a written table between them, so its size is not limited. Only texts go to the Python workers,
and only matches come back. Documents are never shuffled, and a hot passage costs only the places
it has within each shard. A document that is longer than a shard is a shard of its own, of whose
words only the hashes are held.

Defined results: null or empty texts have no words, no hits and no items. Items without words or
with a null id are left out; rows of one item id count as one item. Repeated document rows are
judged each for itself. An empty benchmark hits nothing. Other columns ride along untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm import textbytes as tb
from curbflow.llm.groups import stored
from curbflow.llm.suffixes import doubled
from curbflow.llm.workers import give_back

WINDOW = 10
SLICE_BYTES = 16 << 20
SHARD_BYTES = 1 << 20

# the word pattern [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z, by bytes of UTF-8
_IN_WORD = tb.byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)

_FOUND = "array<struct<item: string, words: int, item_word: int, doc_word: int>>"
_SPANS = "array<struct<start: int, end: int>>"


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and n + 1 offsets of each document's words."""
    hashes, starts, _ = tb.hashed_words(data, offsets, _IN_WORD)
    return hashes, tb.word_rows(starts, offsets)


class TestSuffixes:
    """All suffixes of the items of one slice, as symbols of the slice's own vocabulary (from 1)."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        hashes, rows = word_hashes(*tb.utf8(pa.array([text or "" for _, text in items], pa.string())))
        self.vocabulary = np.unique(hashes)
        self.symbols = np.searchsorted(self.vocabulary, hashes) + 1
        lengths = np.diff(rows)
        used = np.flatnonzero(lengths)
        self.names = [items[i][0] for i in used]
        self.item = np.repeat(np.arange(len(used)), lengths[used])
        self.inside = np.arange(len(hashes)) - np.repeat(rows[:-1], lengths)  # word number in the item
        self.left = np.repeat(lengths, lengths) - self.inside  # words from here to the item's end
        self.need = np.minimum(window, np.repeat(lengths, lengths))  # words that make a window
        self.shortest = int(self.need.min()) if len(self.need) else 0

    def search(self, hashes: np.ndarray, rows: np.ndarray):
        """(document, item, words, item_word, doc_word) of longest matches, and the hit spans.

        ``hashes`` are the shard's words, ``rows`` their offsets by document.
        """
        none = np.zeros(0, np.int64)
        if not len(self.vocabulary) or not len(hashes):
            return (none,) * 5, (none, none)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == hashes
        starts, ends = tb.runs(known, rows)
        long = ends - starts >= self.shortest
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return (none,) * 5, (none, none)
        # the kept stretches one after the other, a separator behind each
        size = ends - starts + 1
        stretch = np.repeat(np.arange(len(size)), size)
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        place = starts[stretch] + inner  # of each symbol in the shard's words
        symbols = np.where(inner < size[stretch] - 1, at[np.minimum(place, len(at) - 1)] + 1, 0)
        array = doubled(symbols)
        found = self._intervals(symbols, array)
        return self._matches(found, array, place, rows), self._spans(found, array, place, rows)

    def _intervals(self, symbols: np.ndarray, array: np.ndarray):
        """Of each test suffix its interval at the length of a window, and at its longest match."""
        padded = np.append(symbols, 0)
        n, k = len(array), len(self.symbols)
        low, high = np.zeros(k, np.int64), np.full(k, n)
        window = np.zeros((k, 2), np.int64)
        best, longest = np.zeros((k, 2), np.int64), np.zeros(k, np.int64)
        todo, depth = np.arange(k), 0
        while len(todo):
            want = self.symbols[todo + depth]
            first = self._bound(padded, array, low[todo], high[todo], depth, want)
            last = self._bound(padded, array, first, high[todo], depth, want + 1)
            alive = last > first
            todo, first, last = todo[alive], first[alive], last[alive]
            low[todo], high[todo] = first, last
            depth += 1
            best[todo, 0], best[todo, 1], longest[todo] = first, last, depth
            full = todo[(self.need[todo] == depth)]
            window[full, 0], window[full, 1] = low[full], high[full]
            todo = todo[self.left[todo] > depth]
        return window, best, longest

    @staticmethod
    def _bound(padded, array, low, high, depth, want):
        """First places in [low, high) whose symbol at ``depth`` is ``want`` or more."""
        low, high, n = low.copy(), high.copy(), len(padded) - 1
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            less = padded[np.minimum(array[middle] + depth, n)] < want[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]

    @staticmethod
    def _places(intervals: np.ndarray, array: np.ndarray):
        """(row, place in the array's text) of every member of every interval."""
        many = intervals[:, 1] - intervals[:, 0]
        row = np.repeat(np.arange(len(many)), many)
        inner = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        return row, array[intervals[row, 0] + inner]

    def _matches(self, found, array, place, rows):
        window, best, longest = found
        is_window = np.flatnonzero(window[:, 1] > window[:, 0])
        # one row for each document, item and window with places; equal windows of an item come once
        _, once = np.unique(np.stack([self.item[is_window], window[is_window, 0]]), axis=1, return_index=True)
        chosen = is_window[once]
        row, at = self._places(window[chosen], array)
        documents = np.searchsorted(rows, place[at], side="right") - 1
        suffix = chosen[row]
        words = self.need[suffix]
        # the longest matches, where they reach beyond the window
        more = is_window[longest[is_window] > self.need[is_window]]
        row2, at2 = self._places(best[more], array)
        suffix = np.concatenate([suffix, more[row2]])
        words = np.concatenate([words, longest[more[row2]]])
        at = np.concatenate([at, at2])
        documents = np.concatenate([documents, np.searchsorted(rows, place[at2], side="right") - 1])
        item = self.item[suffix]
        doc_word = place[at] - rows[documents]
        order = np.lexsort((self.inside[suffix], doc_word, -words, item, documents))
        order = order[np.append(True, (np.diff(documents[order]) != 0) | (np.diff(item[order]) != 0))] if len(order) else order
        return documents[order], item[order], words[order], self.inside[suffix][order], doc_word[order]

    def _spans(self, found, array, place, rows):
        """Starts and ends of the hit runs of words, in the shard's numbering."""
        window, _, _ = found
        chosen = np.flatnonzero(window[:, 1] > window[:, 0])
        _, once = np.unique(np.stack([self.need[chosen], window[chosen, 0]]), axis=1, return_index=True)
        row, at = self._places(window[chosen[once]], array)
        begin = place[at]
        step = np.zeros(int(rows[-1]) + 1, np.int64)
        np.add.at(step, begin, 1)
        np.add.at(step, begin + self.need[chosen[once]][row], -1)
        return tb.runs(np.cumsum(step[:-1]) > 0, rows)


def slices(benchmark: DataFrame, window: int = WINDOW, limit: int = SLICE_BYTES) -> Iterator[TestSuffixes]:
    """The items, collected slice by slice; a slice has about ``limit`` bytes of text."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / limit))
    for k in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k) if count > 1 else items
        yield TestSuffixes(sorted(tuple(r) for r in part.collect()), window)


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each row of ``docs`` as struct ``row``, with n_words, n_hit, ``spans`` (hit runs of words)
    and ``found``: for each item with a window here its longest match and where it lies."""
    spark, shared = docs.sparkSession, None
    frame = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        F.expr(f"CAST(array() AS {_SPANS})").alias("spans"), F.expr(f"CAST(array() AS {_FOUND})").alias("found"),
    )
    for tests in slices(benchmark, window):
        if shared:
            frame = stored(spark, frame, "matches")
            shared.unpersist()
        shared = spark.sparkContext.broadcast(tests)
        match = F.arrow_udf(_pass(shared), f"n_words int, n_hit int, spans {_SPANS}, found {_FOUND}")
        frame = frame.select("row", match(F.col("row.text").cast("string"), "spans", "found").alias("m")).select("row", "m.*")
    return frame


def _pass(shared):
    """One pass: what an earlier pass found stays, and this slice's matches join it."""

    def match(texts: pa.Array, old_spans: pa.Array, old_found: pa.Array) -> pa.Array:
        tests = shared.value
        data, offsets = tb.utf8(texts)
        words, hits, spans, found = [], [], [], []
        for first, last in tb.blocks(offsets, SHARD_BYTES):
            hashes, rows = word_hashes(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            (documents, item, length, item_word, doc_word), (begin, end) = tests.search(hashes, rows)
            owner = np.searchsorted(rows, begin, side="right") - 1
            span_rows = np.searchsorted(owner, np.arange(last - first + 1))
            item_rows = np.searchsorted(documents, np.arange(last - first + 1))
            for d in range(last - first):
                own = [{"start": int(a - rows[d]), "end": int(b - rows[d])} for a, b in zip(begin[span_rows[d] : span_rows[d + 1]], end[span_rows[d] : span_rows[d + 1]])]
                own = _merged(old_spans[first + d].as_py(), own)
                at = range(item_rows[d], item_rows[d + 1])
                new = [{"item": tests.names[item[i]], "words": int(length[i]), "item_word": int(item_word[i]), "doc_word": int(doc_word[i])} for i in at]
                spans.append(own)
                found.append(_by_item(old_found[first + d].as_py() + new))
                words.append(int(rows[d + 1] - rows[d]))
                hits.append(sum(s["end"] - s["start"] for s in own))
        give_back()
        columns = [pa.array(words, pa.int32()), pa.array(hits, pa.int32()), pa.array(spans, old_spans.type), pa.array(found, old_found.type)]
        return pa.StructArray.from_arrays(columns, names=["n_words", "n_hit", "spans", "found"])

    match.__annotations__ = {"texts": pa.Array, "old_spans": pa.Array, "old_found": pa.Array, "return": pa.Array}
    return match


def _merged(old: list[dict], new: list[dict]) -> list[dict]:
    """The union of two lists of spans; spans that overlap become one."""
    if not old or not new:
        return old or new
    out: list[dict] = []
    for span in sorted(old + new, key=lambda s: (s["start"], s["end"])):
        if out and span["start"] < out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(out[-1]["end"], span["end"])}
        else:
            out.append(span)
    return out


def _by_item(found: list[dict]) -> list[dict]:
    """One entry for each item id, the longest match."""
    best: dict[str, dict] = {}
    for f in found:
        if f["item"] not in best or f["words"] > best[f["item"]]["words"]:
            best[f["item"]] = f
    return list(best.values())


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a hit, with their columns."""
    return find_matches(docs, benchmark, window).where("n_hit = 0").select("row.*")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    hits = find_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return hits.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("n_words").cast("long"),
        F.col("n_hit").cast("long"),
        F.size("found").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.item"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SQL_WORDS = rf"regexp_extract_all({_SQL_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES = {
    "op6_decontaminate": f"""WITH w AS (SELECT doc_id, {_SQL_WORDS} AS ws FROM documents),
items AS (SELECT item_id, {_SQL_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
sized AS (SELECT item_id, ws, least({WINDOW}, len(ws)) AS k FROM items WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item_id, k, ws[i:i + k - 1] AS win
  FROM (SELECT item_id, k, ws, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM sized)),
places AS (SELECT doc_id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i
  FROM w, (SELECT DISTINCT k FROM windows)),
dw AS (SELECT doc_id, k, i, ws[i:i + k - 1] AS win FROM places),
found AS (SELECT doc_id, item_id, dw.k, i FROM dw JOIN windows USING (k, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""
}
