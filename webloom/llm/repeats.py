"""Repeated byte windows by a depth-limited, most-significant-digit-first radix sort of suffixes.

Suffixes are ordered only through the threshold: two of them belong to the same group at the end exactly if their first
``length`` bytes are equal, so the groups of two and more are the repeated windows. A pass refines groups by the next digit and
drops groups of one. The digits, most significant first:

1. The window's anchor: the leftmost smallest hash among its 48-byte strings. Equal windows have equal anchors at equal
   places, and neighbouring windows share theirs, so that this pass moves one row for about 170 suffixes.
2. All windows of an anchor together: if their whole stretch occurs again, all of them are repeated, and they leave the sort.
   Occurrences of a stretch within a task are merged before the shuffle, so a group of copies sends two rows a task, and so does
   an anchor among many different stretches: what a task has of it beyond ``LOCAL`` goes straight to the next pass.
3. For the stretches left, where copies begin, end or differ: their suffixes are sorted by digits of a quarter of the length
   each. The stretches of an anchor meet in one task, up to ``HOT`` of them. The suffixes of anchors with more are dealt out
   one by one by their own digits, merged within a task as above, so that no anchor's group grows with the corpus.

Digits are hashes of the bytes: polynomials over random values, odd base, mod 2^64. Suffixes and stretches count as equal only
if two such hashes, of other values and bases, are: 128 bits. Rows are told apart by two 64-bit hashes over id and text; equal
rows have equal spans.

Defined results: null text is empty; texts shorter than the length have no window. Equal rows are copies of each other. Ids may
be null or repeated. Texts of any length are read in pieces that overlap by one window. Other columns pass through. The input is
read more than once, in the same order: give a table or a checkpoint.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.common import checkpointed, lean, slices, unused, utf8

LENGTH, GRAM = 400, 48
#: Bytes hashed at once; anchor stretches that a task remembers in order to merge copies.
PIECE, REMEMBERED = 1 << 18, 100_000
#: Different stretches of an anchor that a task sends to the anchor's group; stretches of an anchor that are sorted in one task.
LOCAL, HOT = 8, 1024
#: Suffixes sorted at once, but for a group of more; bytes of stretches that are held for it.
SUFFIXES = 1 << 17
GROUP_BYTES = 1 << 20
_MASK = (1 << 64) - 1
_LOW = np.uint64((1 << 24) - 1)


class _Hash:
    """A polynomial hash mod 2^64: random values for bytes; powers of the base and of its inverse, as many as asked for so far."""

    def __init__(self, base: int, seed: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.values = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def powers(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up))
            for name, factor in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                x = np.full(size, np.uint64(factor), np.uint64)
                x[0] = 1
                setattr(self, name, np.cumprod(x, dtype=np.uint64))

    def sums(self, buffer: np.ndarray) -> np.ndarray:
        """Prefix sums, for ``of``."""
        self.powers(len(buffer))
        out = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(self.values[buffer] * self.up[: len(buffer)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The hashes of buffer[start:stop]."""
        return (sums[stop] - sums[start]) * self.down[start]


_FIRST, _SECOND = _Hash(0x9E3779B97F4A7C15, 7), _Hash(0xC2B2AE3D27D4EB4F, 11)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each stretch of ``width``, from minima of blocks' beginnings and ends."""
    padded = np.full(-(-len(x) // width) * width, _MASK, np.uint64)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(x) - width + 1], ahead[width - 1 : len(x)])


def anchors(buffer: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """(anchor's hash, two hashes of the stretch, first and last window start) of each run of windows with one anchor; no window goes over an end."""
    sums = _FIRST.sums(buffer)
    grams = mixed((sums[gram:] - sums[:-gram]) * _FIRST.down[: len(buffer) - gram + 1])
    least = sliding_minimum((grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    at = (least & _LOW).astype(np.int64)
    for end in ends:  # windows that would go over it
        at[max(0, end - length + 1) : end] = -1
    edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]]))
    first, last, place = edge[:-1], edge[1:] - 1, at[edge[:-1]]
    real = place >= 0
    first, last, place = first[real], last[real], place[real]
    shape = (place - first).astype(np.uint64) * np.uint64(0x94D049BB133111EB) + (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    one = mixed(_FIRST.of(sums, first, last + length) + shape)
    two = mixed(_SECOND.of(_SECOND.sums(buffer), first, last + length) + shape)
    return grams[place], one, two, first, last


def _pieces(texts: list[bytes], length: int, piece: int):
    """(row, offset, bytes) such that every window lies in one piece; short texts come whole."""
    for row, text in enumerate(texts):
        for start in range(0, max(1, len(text) - length + 1), piece):
            if len(text) >= length:
                yield row, start, text[start : start + piece + length - 1]


def _packed(texts: list[bytes], length: int, piece: int):
    """Pieces in lists of about that many bytes."""
    held, size = [], 0
    for one in _pieces(texts, length, piece):
        held.append(one)
        size += len(one[2])
        if size >= piece:
            yield held
            held, size = [], 0
    if held:
        yield held


class _Merged:
    """What a task has seen: of equal digits the first is to be grouped (0), later ones are known to be repeated (1), and once it
    must be said that there is another (2)."""

    def __init__(self, most: int = REMEMBERED):
        self.seen: dict[tuple[int, int], bool] = {}
        self.most = most

    def kinds(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """(kind of each, numbers of those that also go out with kind 2)."""
        if len(self.seen) > self.most:
            self.seen.clear()
        kind, again, seen = np.zeros(len(one), np.int32), [], self.seen
        for i, pair in enumerate(zip(one.tolist(), two.tolist(), strict=True)):
            if pair in seen:
                kind[i] = 1
                if not seen[pair]:
                    seen[pair] = True
                    again.append(i)
            else:
                seen[pair] = False
        return kind, again


RUNS = "kind int, spread long, key long, one long, two long, k1 long, k2 long, first int, last int"


def _runs_of(length: int, gram: int):
    """Runs of every row. Kinds 0 to 2 as above; 3: not the only one of its anchor, and to be sorted as it is. A stretch that was
    sent so and comes again is sorted once more, so that the first finds it."""

    def run(batches):
        merged_runs, stretches, sent = _Merged(), {}, set()
        for batch in batches:
            for part in slices(batch, "text", 4 * PIECE):
                k1, k2 = part.column(0).to_numpy(), part.column(1).to_numpy()
                for held in _packed(utf8(part.column(2)), length, PIECE):
                    ends = np.cumsum([len(p[2]) for p in held])
                    key, one, two, first, last = anchors(np.frombuffer(b"".join(p[2] for p in held), np.uint8), ends, length, gram)
                    if not len(key):
                        continue
                    which = np.searchsorted(ends, first, side="right")
                    shift = np.array([p[1] for p in held]) - np.concatenate([[0], ends[:-1]])
                    row = np.array([p[0] for p in held])[which]
                    first, last = first + shift[which], last + shift[which]
                    kind, again = merged_runs.kinds(one, two)
                    fresh = np.flatnonzero(kind == 0)
                    for i, k in zip(fresh.tolist(), key[fresh].tolist(), strict=True):
                        n = stretches[k] = stretches.get(k, 0) + 1
                        if n > LOCAL:
                            kind[i] = 3
                            sent.add((int(one[i]), int(two[i])))
                    witness = [i for i in again if (int(one[i]), int(two[i])) in sent]
                    for seen in (stretches, sent):
                        if len(seen) > REMEMBERED:
                            seen.clear()
                    take = np.concatenate([np.arange(len(key)), np.array(again, np.int64), np.array(witness, np.int64)])
                    kind = np.concatenate([kind, np.full(len(again), 2, np.int32), np.full(len(witness), 3, np.int32)])
                    a, b = k1[row[take]], k2[row[take]]
                    digits = [x[take].view(np.int64) for x in (key, one, two)]
                    spread = np.where((kind == 1) | (kind == 3), a, digits[0])
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (kind, spread, *digits, a, b, first[take].astype(np.int32), last[take].astype(np.int32))], ["kind", "spread", "key", "one", "two", "k1", "k2", "first", "last"])

    return lean(run)


def _whole_groups(batches, key_col: str):
    """Sorted batches cut anew so that no group of equal keys goes over an end."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column(batch.schema.get_field_index(key_col)).to_numpy()
        edge = np.flatnonzero(keys[1:] != keys[:-1])
        if held and held[-1].column(held[-1].schema.get_field_index(key_col))[-1].as_py() != keys[0]:
            yield held
            held = []
        if len(edge):
            cut = int(edge[-1]) + 1
            yield [*held, batch.slice(0, cut)]
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield held


FOUND = "known boolean, key long, k1 long, k2 long, first int, last int"


def suffix_digits(buffer: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of the first ``length`` bytes of each suffix."""
    return tuple(mixed(h.of(h.sums(buffer), start, start + length)).view(np.int64) for h in (_FIRST, _SECOND))


def _pair(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    out = np.empty(len(one), [("one", np.int64), ("two", np.int64)])
    out["one"], out["two"] = one, two
    return out


@lean
def _grouped(batches):
    """Of runs sorted by anchor: those known to be repeated, and those whose anchor occurs again but not with the whole stretch."""
    for held in _whole_groups(batches, "spread"):
        table = pa.Table.from_batches(held)
        kind, _, key, one, two, k1, k2, first, last = (table.column(i).to_numpy() for i in range(9))
        done, sent = np.flatnonzero(kind == 1), np.flatnonzero(kind == 3)
        open_ = np.flatnonzero((kind == 0) | (kind == 2))
        _, group, n_key = np.unique(key[open_], return_inverse=True, return_counts=True)
        _, first_of, same, n_whole = np.unique(_pair(one[open_], two[open_]), return_index=True, return_inverse=True, return_counts=True)
        again = n_whole[same] > 1
        own = kind[open_] == 0
        known = np.concatenate([done, open_[own & again]])
        # Where a task may have sent stretches straight to the sort, what is here is held against them, too.
        doubted = np.bincount(group[first_of], minlength=len(n_key)) >= LOCAL
        doubt = own & ~again & (doubted | (n_key > 1))[group]
        doubted[group[doubt]] = True
        # One of each stretch that is settled itself is a witness: others are held against it.
        witness = np.flatnonzero(own & again & doubted[group])
        _, one_of = np.unique(same[witness], return_index=True)
        unsure = np.concatenate([sent, open_[np.concatenate([np.flatnonzero(doubt), witness[one_of]])]])
        take = np.concatenate([known, unsure])
        if len(take):
            flag = np.concatenate([np.ones(len(known), bool), np.zeros(len(unsure), bool)])
            yield pa.RecordBatch.from_arrays([pa.array(flag), *[pa.array(x[take]) for x in (key, k1, k2, first, last)]], ["known", "key", "k1", "k2", "first", "last"])


#: kind as in _Merged, for single suffixes of hot anchors; -1: a whole stretch.
STRETCHES = "kind int, spread long, one long, two long, k1 long, k2 long, first int, last int, stretch binary"
_NAMES = [c.split()[0] for c in STRETCHES.split(", ")]


def _stretches(length: int, text_col: str):
    """The bytes of the runs that are still in doubt; of hot anchors, the digits of each suffix."""

    def whole(out):
        n = len(out)
        columns = [pa.array([-1] * n, pa.int32()), *[pa.array([o[i] for o in out], pa.int64()) for i in (0, 1, 1, 2, 3)]]
        return pa.RecordBatch.from_arrays([*columns, *[pa.array([o[4] for o in out], pa.int32())] * 2, pa.array([o[5] for o in out], pa.binary())], _NAMES)

    def single(out, seen):
        sizes = np.fromiter((len(o[5]) for o in out), np.int64, len(out))
        base, n = np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes - length + 1
        buffer = np.frombuffer(b"".join(o[5] for o in out), np.uint8)
        owner = np.repeat(np.arange(len(n)), n)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        start = base[owner] + offset
        one, two = suffix_digits(buffer, start, length)
        kind, again = seen.kinds(one, two)
        k1, k2, first = (np.array([o[i] for o in out], np.int64) for i in (2, 3, 4))
        at = first[owner] + offset
        known = kind == 1  # in runs of neighbours
        edge = np.ones(len(kind), bool)
        edge[1:] = ~(known[1:] & known[:-1] & (owner[1:] == owner[:-1]))
        starts = np.flatnonzero(edge)
        stops = np.concatenate([starts[1:], [len(kind)]]) - 1
        lo, hi = np.concatenate([starts, again]).astype(np.int64), np.concatenate([stops, again]).astype(np.int64)
        kinds = np.concatenate([kind[starts], np.full(len(again), 2, np.int32)])
        a, b = k1[owner[lo]], k2[owner[lo]]
        columns = (kinds, np.where(kinds == 1, a, one[lo]), one[lo], two[lo], a, b, at[lo].astype(np.int32), at[hi].astype(np.int32))
        return pa.RecordBatch.from_arrays([*[pa.array(c) for c in columns], pa.nulls(len(lo), pa.binary())], _NAMES)

    def run(batches):
        seen = _Merged(2 * REMEMBERED)
        for batch in batches:
            texts = pa.RecordBatch.from_struct_array(batch.column(2)).column(text_col)
            for part in slices(pa.RecordBatch.from_arrays([*batch.columns[:2], texts, batch.column(3)], ["k1", "k2", "text", "runs"]), "text", 4 * PIECE):
                cold, hot, size = [], [], 0
                for a, b, text, runs in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), utf8(part.column(2)), part.column(3).to_pylist(), strict=True):
                    for r in runs:
                        stretch = text[r["first"] : r["last"] + length]
                        (hot if r["hot"] else cold).append((r["key"], 0, a, b, r["first"], stretch))
                        size += len(stretch)
                        if size > GROUP_BYTES:
                            yield from ([whole(cold)] if cold else []) + ([single(hot, seen)] if hot else [])
                            cold, hot, size = [], [], 0
                yield from ([whole(cold)] if cold else []) + ([single(hot, seen)] if hot else [])

    return lean(run)


def sort_through(buffer: np.ndarray, at: np.ndarray, length: int, passes: int = 4) -> np.ndarray:
    """Indices of those suffixes whose first ``length`` bytes some other of them has: most significant digit first."""
    sums, second = _FIRST.sums(buffer), _SECOND.sums(buffer)
    alive, group = np.arange(len(at)), np.zeros(len(at), np.uint64)
    edges = np.linspace(0, length, passes + 1).astype(int).tolist()
    digits = [(_FIRST, sums, a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)] + [(_SECOND, second, 0, length)]
    for h, from_, a, b in digits:
        start = at[alive]
        digit = mixed(h.of(from_, start + a, start + b)).view(np.int64)
        _, inverse, counts = np.unique(mixed(digit.view(np.uint64)) ^ mixed(group * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)), return_inverse=True, return_counts=True)
        keep = counts[inverse] > 1
        alive, group = alive[keep], inverse[keep].astype(np.uint64)
    return alive


RESOLVED = "k1 long, k2 long, first int, last int"


def _resolved(length: int):
    """Of stretches sorted by anchor and single suffixes sorted by digits, the runs of windows that occur more than once."""

    def run(batches):
        held, size = [], 0
        for group in _whole_groups(batches, "spread"):
            held += group
            size += sum(b.nbytes for b in group)
            if size >= GROUP_BYTES:
                yield from work(held)
                held, size = [], 0
        if held:
            yield from work(held)

    def work(held):
        table = pa.Table.from_batches(held)
        kind = table.column(0).to_numpy()
        if (single := np.flatnonzero(kind >= 0)).size:
            one, two, k1, k2, first, last = (table.column(i).to_numpy()[single] for i in (2, 3, 4, 5, 6, 7))
            kinds = kind[single]
            _, same, n = np.unique(_pair(one, two), return_inverse=True, return_counts=True)
            # A known run of several suffixes goes by its first one's digits; it counts for nothing else.
            hit = (kinds == 1) | ((kinds == 0) & (np.bincount(same, kinds != 1, len(n))[same] > 1))
            if hit.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (k1, k2, first, last)], ["k1", "k2", "first", "last"])
        if not (whole := np.flatnonzero(kind < 0)).size:
            return
        spread, sizes = table.column(1).to_numpy()[whole], pc.binary_length(table.column(8)).to_numpy(zero_copy_only=False)[whole].astype(np.int64)
        group = np.flatnonzero(np.concatenate([[True], spread[1:] != spread[:-1]]))
        suffixes = np.concatenate([[0], np.cumsum(sizes - length + 1)])
        start = 0
        for stop in [*group[1:].tolist(), len(whole)]:  # whole groups, until there are enough suffixes to sort at once
            if suffixes[stop] - suffixes[start] >= SUFFIXES or stop == len(whole):
                yield from sort(table.take(pa.array(whole[start:stop])))
                start = stop

    def sort(table):
        stretches = table.column(8).to_pylist()
        sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
        base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        buffer = np.frombuffer(b"".join(stretches), np.uint8)
        n = sizes - length + 1
        first = table.column(6).to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(n)), n)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        hit = sort_through(buffer, base[owner] + offset, length)
        owner, offset = owner[hit], offset[hit]
        if not len(owner):
            return
        order = np.lexsort((offset, owner))
        owner, offset = owner[order], offset[order]
        fresh = np.concatenate([[True], (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)])
        starts = np.flatnonzero(fresh)
        stops = np.concatenate([starts[1:], [len(owner)]]) - 1
        o = owner[starts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(table.column(i).to_numpy()[o]) for i in (4, 5)] + [pa.array((first[o] + offset[starts]).astype(np.int32)), pa.array((first[o] + offset[stops]).astype(np.int32))],
            ["k1", "k2", "first", "last"],
        )

    return lean(run)


def merged(runs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal covered stretches of bytes from runs of window starts."""
    out: list[list[int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [(a, b) for a, b in out]


def _applied(df: DataFrame, id_col: str, text_col: str, length: int, schema: T.StructType, function) -> DataFrame:
    """function(rows, their texts, their covered stretches) of all rows, in batches."""
    gram = min(GRAM, max(1, length // 4))
    a, b = F.col(id_col).cast("string"), F.col(text_col).cast("string")
    one, two = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    fields = [b.alias(c) if c == text_col else F.col(c) for c in df.columns]
    every = df.select(F.xxhash64(one, two, a.isNull()).alias("k1"), F.xxhash64(two, one).alias("k2"), F.struct(*fields).alias("row"))
    # What merges copies depends on the rows' order: it reads the source itself and not a shuffle, whose order a retry may change.
    runs = every.select("k1", "k2", F.col("row").getField(text_col).alias("text")).mapInArrow(_runs_of(length, gram), RUNS)
    found = checkpointed(runs.repartition("spread").sortWithinPartitions("spread").mapInArrow(_grouped, FOUND))
    open_ = found.where("not known")
    hot = open_.groupBy("key").count().where(F.col("count") > HOT).select("key", F.lit(True).alias("hot"))
    doubt = open_.join(hot, "key", "left").groupBy("k1", "k2").agg(F.collect_set(F.struct("key", "first", "last", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("runs"))
    # Both joins read one shuffle of the rows: they ask for the same columns of it.
    stretches = every.join(doubt.hint("merge"), ["k1", "k2"]).select("k1", "k2", "row", "runs").mapInArrow(_stretches(length, text_col), STRETCHES)
    settled = stretches.repartition("spread").sortWithinPartitions("spread").mapInArrow(_resolved(length), RESOLVED)
    covered = found.where("known").select("k1", "k2", "first", "last").unionByName(settled).groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    rows = every.join(covered.hint("merge"), ["k1", "k2"], "left").select("row", "runs")
    columns = df.columns
    held = unused("runs", columns)

    def run(batches):
        for batch in batches:
            inner = pa.RecordBatch.from_struct_array(batch.column(0))
            for part in slices(pa.RecordBatch.from_arrays([*inner.columns, batch.column(1)], [*columns, held]), text_col):
                spans = [[{"start": x, "stop": y} for x, y in merged([(r["first"], r["last"]) for r in runs or []], length)] for runs in part.column(len(columns)).to_pylist()]
                yield function(part.select(columns), utf8(part.column(part.schema.get_field_index(text_col))), spans)

    return rows.mapInArrow(lean(run), schema)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, spans_col: str = "repeat_spans") -> DataFrame:
    """df with the maximal stretches of bytes inside windows that occur again: array<struct<start, stop>>; a column of that name is replaced."""
    source = df.drop(spans_col)

    def with_spans(part, texts, spans):
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(spans, kind)], [*part.schema.names, spans_col])

    return _applied(source, id_col, text_col, length, T.StructType([*source.schema.fields, T.StructField(spans_col, SPANS)]), with_spans)


def cut(text: bytes, spans: list[dict]) -> bytes:
    """What stays of a text."""
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : span["start"]])
        at = span["stop"]
    return b"".join([*kept, text[at:]])


def of_words(text: bytes, spans: list[dict], least: int) -> list[dict]:
    """The stretches with at least so many words, or parts of words."""
    return [s for s in spans if len(text[s["start"] : s["stop"]].split()) >= least] if least > 1 else spans


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, least_words: int = 0) -> DataFrame:
    """df, same columns, its texts without the repeated windows; stretches of fewer words than ``least_words`` stay. A character
    that a cut leaves incomplete goes too; a null text stays null."""

    def shortened(part, texts, spans):
        spans = [of_words(t, s, least_words) for t, s in zip(texts, spans, strict=True)]
        old = part.column(part.schema.get_field_index(text_col))
        new = pa.array([None if not valid else cut(t, s).decode("utf-8", "ignore") if s else t.decode() for valid, t, s in zip(old.is_valid().to_pylist(), texts, spans, strict=True)], pa.string())
        return pa.RecordBatch.from_arrays([new if c == text_col else part.column(i) for i, c in enumerate(part.schema.names)], part.schema.names)

    return _applied(df, id_col, text_col, length, df.schema, shortened)


DIGEST = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def repeats_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of documents(doc_id, text)."""
    source = docs.select("doc_id", "text")

    def digest(part, texts, spans):
        removed = [sum(x["stop"] - x["start"] for x in s) for s in spans]
        kept = [hashlib.sha256(cut(t, s)).hexdigest() for t, s in zip(texts, spans, strict=True)]
        columns = [pa.array(list(map(len, texts)), pa.int64()), pa.array(removed, pa.int64()), pa.array(list(map(len, spans)), pa.int64()), pa.array(kept)]
        return pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _applied(source, "doc_id", "text", LENGTH, T.StructType([source.schema["doc_id"], *T._parse_datatype_string(DIGEST).fields]), digest)
