"""Benchmark decontamination by a distributed positional inverted index.

``write_index`` stores the postings of every word of the documents, in segments of ``SEGMENT_BYTES`` of text: a segment has its
documents, its distinct words, and each word's running positions. A segment holds whole documents, so that no word's list, however
frequent, gathers in one place, and intersections need no shuffle. Searches read the stored index, whatever the test items. A query
goes from the rarest word of a window: its positions, less its offset, are the window's possible starts, and the lists of the
other words, offset-adjusted, are intersected with them from the next rarest on. ``phrase_matches`` gives exact phrases,
``proximity_matches`` stretches of text that hold all of a window's words.

Test items are searched for in blocks of ``BLOCK_BYTES``: the driver holds one block at a time, and the workers one. Each further
block reads the index again; the blocks' results are written before they are united.

Defined results: null or empty text has no words and no hit; an item without words has no window; an item of fewer words than
a window is one window. An item with a null id causes hits but isn't listed. Repeated items, ids and documents each count as
they stand. Columns of documents other than the id and the text aren't read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.common import lean, scratch, slices, utf8

WINDOW, BLOCK_BYTES, SEGMENT_BYTES = 10, 4 << 20, 4 << 20
#: Words that a proximity match may have beyond its window's length.
SLOP = 5
#: A-Z lowered; what isn't a digit, a letter or beyond ASCII parts words.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


class Block:
    """Some test items: their vocabulary and their distinct windows, each with the items that hold it."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        whose: dict[tuple[int, ...], set] = {}
        for name, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            for i in range(max(1, len(ids) - window + 1)) if ids else ():
                whose.setdefault(tuple(ids[i : i + window]), set()).add(name)
        self.windows = np.full((len(whose), window), -1, np.int64)
        self.lengths = np.fromiter(map(len, whose), np.int64, len(whose))
        for i, w in enumerate(whose):
            self.windows[i, : len(w)] = w
        self.items = [sorted(x for x in names if x is not None) for names in whose.values()]
        self.shortest = int(self.lengths.min()) if len(whose) else 0


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """The items in blocks of bounded size, read one after another; at least one block."""
    held, size = [], 0
    for name, text in benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator():
        words = words_of((text or "").encode())
        if held and size + sum(map(len, words)) > most:
            yield Block(held, window)
            held, size = [], 0
        held.append((name, words))
        size += sum(map(len, words))
    yield Block(held, window)


class Segment:
    """A stored segment's lists of a block's terms, one after another."""

    def __init__(self, terms: list[bytes], counts: np.ndarray, positions: np.ndarray, block: Block):
        place = {t: i for i, t in enumerate(terms)}
        local = np.fromiter((place.get(t, -1) for t in block.vocabulary), np.int64, len(block.vocabulary))
        there = local >= 0
        self.counts = np.zeros(len(local), np.int64)
        self.counts[there] = counts[local[there]]
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        begins = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        term = np.repeat(np.arange(len(local)), self.counts)
        within = np.arange(len(term)) - self.starts[term]
        self.at = positions[begins[local[term]] + within].astype(np.int64)
        self.room = int(self.at.max()) + 1 if len(self.at) else 1
        self.keys = term * self.room + self.at

    def has(self, terms: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether each position is in its term's list."""
        keys = terms * self.room + at
        found = np.searchsorted(self.keys, keys)
        ok = (at >= 0) & (at < self.room) & (found < len(self.keys))
        ok[ok] = self.keys[found[ok]] == keys[ok]
        return ok

    def phrases(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every occurrence."""
        if not len(self.at) or not len(block.windows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = np.where(block.windows >= 0, self.counts[block.windows], np.iinfo(np.int64).max)
        by_rarity = np.argsort(sizes, axis=1, kind="stable")
        seed = by_rarity[:, 0]
        which = np.flatnonzero(sizes[np.arange(len(sizes)), seed] > 0)
        which = which[(sizes[which] > 0).all(axis=1)]
        terms = block.windows[which, seed[which]]
        n = self.counts[terms]
        window = np.repeat(which, n)
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        start = self.at[np.repeat(self.starts[terms], n) + within] - np.repeat(seed[which], n)
        for rank in range(1, block.windows.shape[1]):
            offset = by_rarity[window, rank]
            term = block.windows[window, offset]
            ok = (term < 0) | self.has(np.maximum(term, 0), start + offset)
            window, start = window[ok], start[ok]
        return window, start

    def distance(self, terms: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How far from each position the nearest place in its term's list is."""
        keys = terms * self.room + at
        i = np.searchsorted(self.keys, keys)
        out = np.full(len(keys), self.room, np.int64)
        for j in (i - 1, i):
            ok = (j >= self.starts[terms]) & (j < self.starts[terms + 1])
            out[ok] = np.minimum(out[ok], np.abs(self.at[j[ok]] - at[ok]))
        return out

    def near(self, block: Block, slop: int, base: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(window, document, first, last) of the shortest stretches with all distinct words of a window in at most its length and slop words.

        base: the first running position of each document."""
        if not len(self.at) or not len(block.windows):
            return []
        sizes = np.where(block.windows >= 0, self.counts[block.windows], np.iinfo(np.int64).max)
        by_rarity = np.argsort(sizes, axis=1, kind="stable")
        which = np.flatnonzero((sizes > 0).all(axis=1))
        terms = block.windows[which, by_rarity[which, 0]]
        n = self.counts[terms]
        window = np.repeat(which, n)
        seed = self.at[np.repeat(self.starts[terms], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
        for rank in range(1, block.windows.shape[1]):  # a word of each kind near enough on either side
            term = block.windows[window, by_rarity[window, rank]]
            ok = (term < 0) | (self.distance(np.maximum(term, 0), seed) < block.lengths[window] + slop)
            window, seed = window[ok], seed[ok]
        out = set()
        owner = np.searchsorted(base, seed, side="right") - 1
        for w, p, own in zip(window.tolist(), seed.tolist(), owner.tolist(), strict=True):
            room = int(block.lengths[w]) + slop
            lo, hi = max(p - room + 1, int(base[own])), min(p + room, int(base[own + 1]))
            lists = [self.at[self.starts[t] : self.starts[t + 1]].tolist() for t in {int(t) for t in block.windows[w] if t >= 0}]
            near = sorted((q, k) for k, x in enumerate(lists) for q in x[bisect_left(x, lo) : bisect_left(x, hi)])
            best, last = None, [-1] * len(lists)
            for q, k in near:
                last[k] = q
                if min(last) >= 0 and min(last) <= p <= q and q - min(last) < room and (best is None or q - min(last) < best[1] - best[0]):
                    best = min(last), q
            if best:
                out.add((w, own, *best))
        return sorted(out)


def index_schema(id_type: T.DataType) -> T.StructType:
    """A segment: its documents in order, its distinct words, how often each occurs, and its running positions, word after word."""
    rest = T._parse_datatype_string("n_words array<long>, terms array<binary>, counts array<int>, positions array<int>")
    return T.StructType([T.StructField("ids", T.ArrayType(id_type)), *rest.fields])


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def segments(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The segments of an index of df."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SEGMENT_BYTES):
                vocabulary: dict[bytes, int] = {}
                number, ids, n_words = vocabulary.setdefault, [], []
                for text in utf8(part.column(1)):
                    words = words_of(text)
                    n_words.append(len(words))
                    ids.append(np.fromiter((number(w, len(vocabulary)) for w in words), np.int32, len(words)))
                sizes = np.array(n_words, np.int64)
                base = np.cumsum(sizes + 1) - sizes - 1  # a gap between documents, over which no phrase goes
                terms = np.concatenate(ids)
                at = np.repeat(base - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(terms))
                order = np.argsort(terms, kind="stable")
                counts = np.bincount(terms, minlength=len(vocabulary)).astype(np.int32)
                columns = [part.column(0), pa.array(sizes), pa.array(list(vocabulary), pa.binary()), pa.array(counts), pa.array(at[order].astype(np.int32))]
                yield pa.RecordBatch.from_arrays([_one_list(c) for c in columns], ["ids", "n_words", "terms", "counts", "positions"])

    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(lean(run), index_schema(source.schema["id"].dataType))


def write_index(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Store the index of df, segment by segment, through Spark's own committer."""
    segments(df, id_col, text_col).write.option("parquet.block.size", 16 << 20).parquet(path)


def read_index(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _opened(batch: pa.RecordBatch, block: Block):
    """(ids, words of each document, first running position of each, the segment) of every stored segment."""
    for i in range(len(batch)):
        ids, n_words, terms, counts, positions = (batch.column(batch.schema.get_field_index(c))[i].values for c in ("ids", "n_words", "terms", "counts", "positions"))
        sizes = n_words.to_numpy()
        base = np.concatenate([[0], np.cumsum(sizes + 1)])
        yield ids, sizes, base, Segment(terms.to_pylist(), counts.to_numpy(), positions.to_numpy(), block)


MATCHES = "n_words long, spans array<struct<start:int,stop:int>>, items array<string>"


def _span_lists(owner: np.ndarray, start: np.ndarray, stop: np.ndarray, rows: int) -> pa.Array:
    """Maximal runs of covered words for each row, from pieces sorted by row and start."""
    if len(owner):
        reach = np.maximum.accumulate(owner * (1 << 40) + stop)
        fresh = np.concatenate([[True], (owner[1:] << 40) + start[1:] > reach[:-1]])
        first = np.flatnonzero(fresh)
        owner, start, stop = owner[first], start[first], (reach[np.concatenate([first[1:], [len(fresh)]]) - 1] & ((1 << 40) - 1))
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))]).astype(np.int32))
    spans = pa.StructArray.from_arrays([pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))], ["start", "stop"])
    return pa.ListArray.from_arrays(offsets, spans)


def _own_id(index: DataFrame) -> T.StructField:
    return T.StructField("id", index.schema["ids"].dataType.elementType)


def phrase_matches(index: DataFrame, block: Block) -> DataFrame:
    """(id, n_words, spans, items): runs of words inside occurrences of windows, and the items with occurring windows, as sorted strings."""

    def run(batches):
        for batch in batches:
            for ids, sizes, base, segment in _opened(batch, block):
                window, start = segment.phrases(block)
                owner = np.searchsorted(base, start, side="right") - 1
                order = np.lexsort((start, owner))
                window, owner, start = window[order], owner[order], (start - base[owner])[order]
                spans = _span_lists(owner, start, start + block.lengths[window], len(sizes))
                found: list[set] = [set() for _ in range(len(sizes))]
                for row, w in np.unique(np.column_stack([owner, window]), axis=0).tolist():
                    found[row].update(block.items[w])
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), spans, pa.array([sorted(x) for x in found], pa.list_(pa.string()))], ["id", "n_words", "spans", "items"])

    return index.mapInArrow(lean(run), T.StructType([_own_id(index), *T._parse_datatype_string(MATCHES).fields]))


def proximity_matches(index: DataFrame, block: Block, slop: int = SLOP) -> DataFrame:
    """(id, item, start, stop): stretches of words that hold all distinct words of an item's window, in any order, within its length and slop."""

    def run(batches):
        for batch in batches:
            for ids, _, base, segment in _opened(batch, block):
                rows = [(own, item, first - int(base[own]), last + 1 - int(base[own])) for w, own, first, last in segment.near(block, slop, base) for item in block.items[w]]
                own = ids.take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays([own, pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int32())], ["id", "item", "start", "stop"])

    return index.mapInArrow(lean(run), T.StructType([_own_id(index), *T._parse_datatype_string("item string, start int, stop int").fields]))


def matches(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, most: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, spans, items) of every row of df against every item of the benchmark. Rows are numbered where several blocks' results are united, since ids may be repeated."""
    spark = df.sparkSession
    numbered = df.select(F.struct(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id")).alias("id"), F.col(text_col).alias("text"))
    write_index(numbered, path := scratch(spark, "index"), "id", "text")
    index, each = read_index(spark, path), blocks(benchmark, item_col, item_text_col, window, most)
    found, more = phrase_matches(index, next(each)), next(each, None)
    if more is None:
        return found.select("id.id", "n_words", "spans", "items")
    found.write.parquet(united := scratch(spark, "matches"))
    while more is not None:
        phrase_matches(index, more).write.mode("append").parquet(united)
        more = next(each, None)
    merged = spark.read.parquet(united).groupBy("id").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    far = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("stop"))
    start = lambda acc, x: F.when(x["start"] <= F.get(acc, F.lit(0))["stop"], F.concat(F.array(F.struct(F.get(acc, F.lit(0))["start"].alias("start"), F.greatest(F.get(acc, F.lit(0))["stop"], x["stop"]).alias("stop"))), F.slice(acc, 2, F.size(acc)))).otherwise(F.concat(F.array(x), acc))
    joined = F.filter(F.aggregate(F.array_sort("spans"), F.array(far), start), lambda x: x["start"] >= 0)
    return merged.select("id.id", "n_words", F.array_sort(joined).alias("spans"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of documents against the benchmark's items."""
    found = matches(docs, benchmark)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + (x["stop"] - x["start"]).cast("long"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


_SPLIT = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT doc_id, {_SPLIT} AS w FROM documents), b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_SPLIT} AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, array_to_string(w[s:s + {WINDOW - 1}], ' ') AS t, least(len(w), {WINDOW}) AS n FROM b, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 2))) r(s) WHERE len(w) > 0),
x AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS t FROM d, (SELECT DISTINCT n FROM i), unnest(range(1, greatest(len(w) - n + 2, 1))) u(s)),
m AS (SELECT x.doc_id, x.s, x.n, i.item_id FROM x JOIN i ON x.t = i.t AND x.n = i.n),
h AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT DISTINCT doc_id, s, n FROM m), unnest(range(s, s + n)) u(place) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)
"""
