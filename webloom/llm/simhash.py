"""SimHash fingerprints, linked within a radius by covering locality-sensitive hashing.

Each of the 64 bits gets a non-zero vector m(i) of F_2^(r+1). For every non-zero v of that space, table v masks a fingerprint
to the bits with <m(i), v> = 1. At most r differing bits span at most r dimensions, so some v is orthogonal to all their
vectors: in table v the pair has equal keys. 2^(r+1)-1 tables therefore miss no pair, by construction and not by chance.

A bucket's fingerprints agree on about 34 bits. Buckets of more than ``BUCKET`` distinct fingerprints are covered once more on
their other bits, by the same construction; fingerprints that agree on both masks leave at most about 2^14 values, so that no
bucket of the second level can grow with the corpus. Inside a bucket a breadth-first search gives a spanning forest: at most
one edge a fingerprint, never all pairs.

Null text counts as empty; no words give fingerprint zero, which is linked like any other. Rows with equal ids or a null id
each keep their row; component ids are the smallest non-null id. Extra columns aren't read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.common import checkpointed, components, lean, slices, utf8

BITS = 64
#: Distinct fingerprints of a bucket that is searched as it is.
BUCKET = 4096
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BYTE_BITS = np.array([[b >> i & 1 for i in range(8)] for b in range(256)], np.float64)


#: Bytes of a text whose words are held at once.
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(text: bytes, most: int):
    """The text in parts of about that size, cut at white space."""
    at = 0
    while len(text) - at > most:
        found = _SPACE.search(text, at + most)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.end()
    yield text[at:]


def shingle_hashes(text: bytes, words: int, seed: int = 42, most: int = PIECE):
    """XXH64 of each shingle of a UTF-8 text, repeats included, in arrays: A-Z lowered, words between ASCII white space, one space between."""
    from xxhash import xxh64_intdigest

    carried: list[bytes] = []
    whole = True  # the text so far has no more words than a shingle
    for piece in _pieces(text, most):
        parts = carried + piece.translate(LOWER).split()
        if len(parts) > words or (not whole and len(parts) == words):
            joined = b" ".join(parts)
            ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
            starts = np.concatenate([[0], ends[: len(parts) - words]])
            stops = ends[words - 1 :] - 1
            yield np.fromiter((xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts.tolist(), stops.tolist(), strict=True)), np.uint64, len(stops))
            carried, whole = parts[len(parts) - words + 1 :], False
        else:
            carried = parts
    if whole and carried:
        yield np.array([xxh64_intdigest(b" ".join(carried), seed)], np.uint64)


def fingerprint_many(texts: list[bytes], words: int) -> np.ndarray:
    """The uint64 fingerprints of some texts: a bit is set if it is in over half of the hashes."""
    ones, sizes = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)

    def count(held):
        rows = np.array([i for i, _ in held])
        flat = np.concatenate([h for _, h in held])
        whose = np.repeat(np.arange(len(held)), [len(h) for _, h in held]) * 256
        octets = flat.view(np.uint8).reshape(-1, 8)
        for j in range(8):
            found = np.bincount(whose + octets[:, j], minlength=len(held) * 256).reshape(-1, 256) @ _BYTE_BITS
            np.add.at(ones[:, 8 * j : 8 * j + 8], rows, found.astype(np.int64))
        np.add.at(sizes, rows, [len(h) for _, h in held])

    held, size = [], 0
    for i, text in enumerate(texts):
        for hashes in shingle_hashes(text, words):
            held.append((i, hashes))
            size += len(hashes)
            if size >= PIECE >> 3:
                count(held)
                held, size = [], 0
    if held:
        count(held)
    bits = (2 * ones > sizes[:, None]).astype(np.uint64)
    return (bits << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed 64-bit number."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                fp = fingerprint_many(utf8(part.column(1)), words)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(lean(run), T.StructType([T.StructField("id", source.schema["id"].dataType), T.StructField("fp", T.LongType())]))


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """The masks over these bits such that any ``radius`` of them all lie outside of some mask."""
    space = 1 << (radius + 1)
    vectors = [1 + i % (space - 1) for i in range(len(bits))]
    return [sum(1 << b for b, m in zip(bits, vectors, strict=True) if (m & v).bit_count() & 1) for v in range(1, space)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of distinct fingerprints that link within the radius."""
    left, edges = fp, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                edges += [(x, y) for y in found]
                queue.extend(found)
    return edges


def _runs(batches, keys: list[str], radius: int, limit: int | None):
    """Spanning edges of each run of equal keys in sorted batches; runs over the limit come out as they are, with their first key."""

    def emit(key, run):
        fp = np.unique(np.concatenate(run)) if len(run) > 1 else np.unique(run[0])
        return forest(fp.view(np.uint64), radius)

    def table(edges=(), over=()):
        a = np.array([e[0] for e in edges], np.uint64).view(np.int64)
        b = np.array([e[1] for e in edges], np.uint64).view(np.int64)
        v = np.concatenate([np.full(len(a), -1, np.int32), *[np.full(len(x), k, np.int32) for k, x in over]])
        a, b = np.concatenate([a, *[x for _, x in over]]), np.concatenate([b, *[x for _, x in over]])
        return pa.RecordBatch.from_arrays([pa.array(v), pa.array(a), pa.array(b)], ["v", "a", "b"])

    last, held, size = None, [], 0
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        fp = batch.column(batch.schema.get_field_index("fp")).to_numpy()
        change = np.zeros(len(fp), bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.concatenate([[0], np.flatnonzero(change), [len(fp)]])
        edges, over = [], []
        lengths = np.diff(starts)
        for i in range(len(lengths)):
            first_or_last = i in (0, len(lengths) - 1)
            if lengths[i] == 1 and not first_or_last:
                continue
            s, e = starts[i], starts[i + 1]
            key = tuple(c[s] for c in columns) if first_or_last else None
            if i == 0 and key == last:
                held.append(fp[s:e])
                size += e - s
            else:
                if i == 0 or first_or_last:
                    if size > 1 and held:
                        edges += emit(last, held)
                    last, held, size = key, [fp[s:e]], e - s
                if not first_or_last:
                    part = np.unique(fp[s:e])
                    if limit and len(part) > limit:
                        over.append((int(columns[0][s]), part))
                    else:
                        edges += forest(part.view(np.uint64), radius)
            if limit and size > limit and held:  # once over, the rest of the run follows as it comes
                over.append((int(last[0]), np.concatenate(held)))
                held = []
        if edges or over:
            yield table(edges, over)
    if held and size > 1:
        yield table(emit(last, held))


EDGE = "v int, a long, b long"


def links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b): edges between distinct fingerprints ``fp`` whose components are those of all pairs within the radius."""
    masks = covering_masks(list(range(BITS)), radius)

    first = distinct.select(
        F.explode(F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for v, m in enumerate(masks)])).alias("t"), "fp"
    ).select("t.v", "t.k", "fp").repartition("v", "k").sortWithinPartitions("v", "k")
    found = checkpointed(first.mapInArrow(lean(lambda it: _runs(it, ["v", "k"], radius, BUCKET)), EDGE), distinct.count() * len(masks))
    edges = found.where("v < 0").select("a", "b")
    over = found.where("v >= 0").select("v", F.col("a").alias("fp")).distinct()
    if over.isEmpty():
        return edges
    inner = []
    for mask in masks:
        inner.append([_signed(m) for m in covering_masks([b for b in range(BITS) if not mask >> b & 1], radius)])
    outer = F.array(*[F.lit(_signed(m)) for m in masks])
    table = F.array(*[F.array(*[F.lit(m) for m in row]) for row in inner])
    second = (
        over.select("v", "fp", F.col("fp").bitwiseAND(F.get(outer, F.col("v"))).alias("k"), F.posexplode(F.get(table, F.col("v"))).alias("w", "m"))
        .select("v", "k", "w", F.col("fp").bitwiseAND(F.col("m")).alias("l"), "fp")
        .repartition("v", "k", "w", "l")
        .sortWithinPartitions("v", "k", "w", "l")
    )
    return edges.union(second.mapInArrow(lambda it: _runs(it, ["v", "k", "w", "l"], radius, None), EDGE).select("a", "b"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """(id, fp, component): every row with its fingerprint and the smallest id among all rows that links can reach."""
    each = checkpointed(fingerprints(df, id_col, text_col, words))
    distinct = checkpointed(each.groupBy("fp").agg(F.min("id").alias("least")), each.count())
    nodes = components(links(distinct, radius), "a", "b")
    rooted = distinct.join(nodes, distinct.fp == nodes.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return each.join(rooted.join(named, "root").select("fp", "component"), "fp").select("id", "fp", "component")


def simhash_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of documents(doc_id, text)."""
    found = near_duplicates(docs)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


#: Words of 64 bits of the wide fingerprint; share of pairs at the similarity that tables may miss; tables' least key width.
WIDE, MISS, LEAST_BITS = 8, 0.01, 18
#: Shingles of candidates that one task compares at once; candidates that are broadcast.
BLOCK, BROADCAST = 1 << 19, 1 << 18


def differing_share(similarity: float) -> float:
    """The share of bits in which the fingerprints of two sets of this Jaccard similarity are expected to differ."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes): the distinct shingles of each text, in ascending order, one text after another."""
    hashes = [np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(t, words)]) for t in texts]
    whose = np.repeat(np.arange(len(texts)), [len(h) for h in hashes])
    flat = np.concatenate([np.zeros(0, np.uint64), *hashes])
    order = np.lexsort((flat, whose))
    whose, flat = whose[order], flat[order]
    fresh = np.ones(len(flat), bool)
    fresh[1:] = (flat[1:] != flat[:-1]) | (whose[1:] != whose[:-1])
    return flat[fresh], np.bincount(whose[fresh], minlength=len(texts))


def _mixed(flat: np.ndarray, w: int) -> np.ndarray:
    x = (flat + np.uint64(0x9E3779B97F4A7C15 * (w + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def set_keys(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set: the sum of its mixed hashes; the empty set's is zero."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(flat, WIDE), dtype=np.uint64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def wide_fingerprints(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows of ``WIDE`` 64-bit words: SimHash over each set of shingles."""
    n = len(sizes)
    whose = np.repeat(np.arange(n), sizes) * 256
    out = np.zeros((n, WIDE), np.uint64)
    for w in range(WIDE):
        octets = _mixed(flat, w).view(np.uint8).reshape(-1, 8)
        for j in range(8):
            ones = np.bincount(whose + octets[:, j], minlength=n * 256).reshape(-1, 256) @ _BYTE_BITS
            for bit in range(8):
                out[:, w] |= (2 * ones[:, bit] > sizes).astype(np.uint64) << np.uint64(8 * j + bit)
    return out


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _linked(rows: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(first, other): rows that links within the radius reach from each other, by the first of them."""
    left, edges = np.arange(len(rows)), []
    while len(left) > 1:
        first, left = left[0], left[1:]
        queue = [first]
        while queue and len(left):
            x = queue.pop()
            near = _far(rows[left], rows[x]) <= radius
            found, left = left[near], left[~near]
            edges += [(first, y) for y in found]
            queue.extend(found.tolist())
    return edges


def _bucket_edges(radius: int, short: int = 8):
    """Edges within each bucket of batches sorted by key: neighbours at every shift for short buckets, a search for others.

    An edge goes from the smaller row to the larger, and in large buckets from the smallest of those that links reach, so that
    the tables name the same edges of a large group again and again, and each is kept once."""

    def run(batches):
        held = []
        for batch in batches:
            if not len(batch):
                continue
            keys = batch.column(0).to_numpy()
            if held and held[-1].column(0)[-1].as_py() != keys[0]:
                yield from work(held)
                held = []
            edge = np.flatnonzero(keys[1:] != keys[:-1])
            if len(edge):
                cut = int(edge[-1]) + 1
                yield from work([*held, batch.slice(0, cut)])
                held = [batch.slice(cut)]
            else:
                held.append(batch)
        if held:
            yield from work(held)

    def work(held):
        table = pa.Table.from_batches(held)
        key, ref = table.column(0).to_numpy(), table.column(1).to_numpy()
        order = np.lexsort((ref, key))
        key, ref = key[order], ref[order]
        fp = np.column_stack([table.column(2 + w).to_numpy()[order] for w in range(WIDE)]).view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(key)]]))
        size = np.repeat(sizes, sizes)
        a, b = [], []
        for shift in range(1, short):
            i = np.flatnonzero((key[shift:] == key[:-shift]) & (size[shift:] <= short))
            i = i[_far(fp[i], fp[i + shift]) <= radius]
            a.append(ref[i])
            b.append(ref[i + shift])
        for s, n in zip(starts[sizes > short].tolist(), sizes[sizes > short].tolist(), strict=True):
            found = np.array(_linked(fp[s : s + n], radius), np.int64).reshape(-1, 2) + s
            a.append(ref[found[:, 0]])
            b.append(ref[found[:, 1]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return lean(run)


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the components of these: every node to its smallest neighbour below it, and that one to the others.

    The tables give a node no more than a bounded number of neighbours each, so its list is bounded, too; the neighbours of a
    large group's rows are the same few, so that hardly more than an edge a row is left of an edge a row and table."""
    near = edges.groupBy("b").agg(F.array_sort(F.collect_set("a")).alias("near"))
    first = F.get("near", F.lit(0)).alias("a")
    each = F.transform("near", lambda x, i: F.struct(first, F.when(i == 0, F.col("b")).otherwise(x).alias("b")))
    return near.select(F.explode(each).alias("e")).select("e.a", "e.b").distinct()


def _similar(rows: np.ndarray, sets: list[np.ndarray], radius: int, similarity: float) -> list[tuple[int, int]]:
    """Edges (row numbers) of a spanning forest of the sets that have the Jaccard similarity; rows beyond the radius aren't compared."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    left, edges = np.arange(len(sets)), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            least, most = np.minimum(sizes[left], sizes[x]), np.maximum(sizes[left], sizes[x])
            at = np.flatnonzero((least >= similarity * most - 1e-6) & (_far(rows[left], rows[x]) <= radius))
            if not len(at):
                continue
            flat = np.concatenate([sets[y] for y in left[at]])
            place = np.minimum(np.searchsorted(sets[x], flat), max(sizes[x] - 1, 0))
            both = np.concatenate([[0], np.cumsum(sets[x][place] == flat)]) if sizes[x] else np.zeros(len(flat) + 1, np.int64)
            ends = np.cumsum(sizes[left[at]])
            common = both[ends] - both[ends - sizes[left[at]]]
            union = sizes[left[at]] + sizes[x] - common
            near = np.zeros(len(left), bool)
            near[at[(union == 0) | (common / np.maximum(union, 1) >= similarity)]] = True
            found, left = left[near], left[~near]
            edges += [(x, y) for y in found]
            queue.extend(found.tolist())
    return edges


def _group_edges(radius: int, similarity: float):
    """(whole, a, b) within each group of batches sorted by key, by the sets themselves: b is linked to a, the first of its rows."""

    def edges(held):
        ref = np.concatenate([b.column(1).to_numpy() for b in held])
        _, once = np.unique(ref, return_index=True)
        if len(once) < 2:
            return None
        fp = np.concatenate([np.column_stack([b.column(4 + w).to_numpy() for w in range(WIDE)]) for b in held]).view(np.uint64)
        sets = [np.frombuffer(x.as_py(), np.uint64) for b in held for x in b.column(3)]
        first = np.arange(len(once))
        for x, y in _similar(fp[once], [sets[i] for i in once.tolist()], radius, similarity):
            first[y] = first[x]
        linked = np.flatnonzero(first != np.arange(len(once)))
        whole = pa.array(np.full(len(linked), held[0].column(2)[0].as_py() == 1))
        return pa.RecordBatch.from_arrays([whole, pa.array(ref[once][first[linked]]), pa.array(ref[once][linked])], ["whole", "a", "b"])

    def run(batches):
        held, last = [], None
        for batch in batches:
            if not len(batch):
                continue
            keys = batch.column(0).to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]).tolist()
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if held and keys[s] != last:
                    if (out := edges(held)) is not None:
                        yield out
                    held = []
                held.append(batch.slice(s, e - s))
                last = keys[s]
        if held and (out := edges(held)) is not None:
            yield out

    return lean(run)


def similar_nodes(source: DataFrame, members: DataFrame, words: int, radius: int, similarity: float) -> DataFrame:
    """(node, root): components of the sets of shingles that have the similarity, for members (ref, root, n, text_key) of source(text, text_key).

    The members of a root with over ``BLOCK`` shingles are dealt into blocks, and every two blocks meet in one task, so that each
    two members of a root are compared, whatever their number.
    """
    count = members.count()
    blocks = members.groupBy("root").agg(F.ceil(F.sum("n") / BLOCK).alias("blocks"))
    wanted = checkpointed(members.join(blocks, "root").select("text_key", "ref", "root", F.greatest("blocks", F.lit(1)).cast("long").alias("blocks")), count)
    if count <= BROADCAST:
        wanted = F.broadcast(wanted)
    else:
        source = source.dropDuplicates(["text_key"])
    texts = source.join(wanted, "text_key").select("text", "ref", "root", "blocks")
    names = [f"f{w}" for w in range(WIDE)]

    def sets(batches):
        seen = set()
        for batch in batches:
            for part in slices(batch, "text"):
                fresh = []
                for i, ref in enumerate(part.column(1).to_pylist()):
                    if ref not in seen:
                        seen.add(ref)
                        fresh.append(i)
                part = part.take(pa.array(fresh, pa.int64()))
                flat, sizes = shingle_sets(utf8(part.column(0)), words)
                same = set_keys(flat, sizes).view(np.int64) == part.column(1).to_numpy()
                fp = wide_fingerprints(flat, sizes).view(np.int64)
                ends = np.cumsum(sizes)
                each = pa.array([flat[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.binary())
                out = pa.RecordBatch.from_arrays([part.column(1), part.column(2), part.column(3), each, *[pa.array(fp[:, w]) for w in range(WIDE)]], ["ref", "root", "blocks", "items", *names])
                yield out.filter(pa.array(same))

    rows = texts.mapInArrow(lean(sets), "ref long, root long, blocks long, items binary, " + ", ".join(f"{n} long" for n in names))
    own = F.pmod(F.xxhash64("ref"), F.col("blocks"))
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).otherwise(F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: j != F.col("own")))
    met = rows.withColumn("own", own).withColumn("other", F.explode(others))
    key = F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other"))
    dealt = met.select(key.alias("key"), "ref", "blocks", "items", *names).repartition("key").sortWithinPartitions("key")
    found = checkpointed(dealt.mapInArrow(_group_edges(radius, similarity), "whole boolean, a long, b long"))
    nodes, parted = found.where("whole").select(F.col("b").alias("node"), F.col("a").alias("root")), found.where("not whole")
    return nodes if parted.isEmpty() else nodes.union(components(parted, "a", "b"))


def row_key(id_col: str, text_col: str) -> Column:
    """A 64-bit key of a row's id and text; null is no value of either."""
    return F.xxhash64(F.col(id_col).isNull(), id_col, F.col(text_col).isNull(), F.col(text_col).cast("string"))


def similar_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, row_key, component, kept): rows whose distinct shingles have this Jaccard similarity or more are linked.

    Covering tables for the ten differing bits of 64 that a similarity of 0.8 gives would be two thousand; so this mode keys wide
    fingerprints by bands of their bits. The bands' width follows the logarithm of the number of fingerprints, their number
    the share ``MISS`` of pairs at the similarity that all of them may miss, at every size of input. Pairs in a bucket whose
    fingerprints differ in at most the expected number of bits and six standard deviations are candidates only. Within what
    candidates connect, rows are linked by the sets of shingles themselves, so that no link is below the similarity. Equality of
    shingles and of sets rests on 64-bit hashes. ``kept`` tells the row with the smallest id (null last) of all that links reach;
    rows are told apart by ``row_key``, so that rows of one id and other texts are decided each for itself. The input is read twice: give a table or a checkpoint.
    """
    p = differing_share(similarity)
    total = 64 * WIDE
    radius = int(round(total * p + 6 * (total * p * (1 - p)) ** 0.5))
    names = [f"f{w}" for w in range(WIDE)]
    text = F.col(text_col).cast("string")
    source = df.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"), row_key(id_col, text_col).alias("row_key"))

    def fingerprint(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                flat, sizes = shingle_sets(utf8(part.column(1)), words)
                fp = wide_fingerprints(flat, sizes).view(np.int64)
                ref = set_keys(flat, sizes).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(3), part.column(2), pa.array(ref), pa.array(sizes), *[pa.array(fp[:, w]) for w in range(WIDE)]], ["id", "row_key", "text_key", "ref", "n", *names])

    fields = [source.schema["id"], *[T.StructField(n, T.LongType()) for n in ["row_key", "text_key", "ref", "n", *names]]]
    each = checkpointed(source.mapInArrow(lean(fingerprint), T.StructType(fields)))
    distinct = checkpointed(each.groupBy("ref", "n", *names).agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row_key")).alias("least"), F.min("text_key").alias("text_key")), each.count())
    count = distinct.count()
    width = max(LEAST_BITS, int(np.ceil(np.log2(count + 1))))
    bands = int(np.ceil(np.log(MISS) / np.log(1 - (1 - p) ** width)))
    chosen = [np.random.default_rng(b).choice(total, width, replace=False) for b in range(bands)]

    def banded(batches):
        for batch in batches:
            fp = np.column_stack([batch.column(1 + w).to_numpy() for w in range(WIDE)]).view(np.uint64)
            for b, bits in enumerate(chosen):
                key = np.full(len(fp), b, np.uint64)
                for bit in bits.tolist():
                    key = (key << np.uint64(1)) | ((fp[:, bit >> 6] >> np.uint64(bit & 63)) & np.uint64(1))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *batch.columns], ["key", "ref", *names])

    keyed = distinct.select("ref", *names).mapInArrow(lean(banded), "key long, ref long, " + ", ".join(f"{n} long" for n in names))
    candidates = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_bucket_edges(radius), "a long, b long")
    groups = components(_contracted(candidates), "a", "b")
    members = distinct.join(groups, distinct.ref == groups.node).select("ref", "root", "n", "text_key")
    nodes = similar_nodes(source.select("text", "text_key"), members, words, radius, similarity)
    rooted = distinct.join(nodes, distinct.ref == nodes.node, "left").select("ref", "least", F.coalesce("root", "ref").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("first"))
    found = each.select("id", "row_key", "ref").join(rooted.join(named, "root").select("ref", "first"), "ref")
    return found.select("id", "row_key", F.col("first.id").alias("component"), (F.col("row_key") == F.col("first.row_key")).alias("kept"))
