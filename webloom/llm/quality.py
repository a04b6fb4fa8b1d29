"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of the lines beside it; forward-backward gives each line's
marginal, and their length-weighted mean, calibrated on the training documents, is the document's score. In training a
line carries its document's label.

Defined results: null and empty text are one empty line; a table without labels gives 0.5 everywhere. Ids may be null or
repeated. Whole texts are scored, however many lines they have: features are made for ``BLOCK_LINES`` at a time, and a long chain
is summed in stretches, all of them abreast. Only the fit is bounded: about ``SAMPLE_ROWS`` labelled documents of each label, of
each a window of ``FIT_BYTES`` that begins where a hash of the text says. Extra columns aren't read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.common import lean, logistic, replaced, slices, stable_sample, utf8

SAMPLE_ROWS, FIT_BYTES, STEPS = 1500, 1 << 14, 200
#: Bytes and lines whose features are held at once; lines of a chain that are summed one after another.
SLICE, BLOCK_LINES, STRETCH = 1 << 20, 1 << 15, 128
#: Classes of bytes: other, lower, upper, digit, space, stop, shout, symbol.
CLASSES = np.zeros(256, np.uint8)
for _c, _bytes in enumerate([b"", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b" \t\r\x0b\x0c", b".,;:'\"-()", b"!?", b"#$%&*|@~^_=<>+/\\{}[]`"]):
    CLASSES[list(_bytes)] = _c
_WIDE_UPPER = np.zeros(256, bool)
_WIDE_UPPER[0x80:0x9F] = True
OWN = 14
WIDTH = 1 + OWN + 8


def _shares(line: bytes) -> tuple[np.ndarray, int, int, int]:
    """(bytes of each class, words, distinct words, words that repeat the one before) of a line."""
    kinds = np.zeros(8, np.int64)
    for start in range(0, len(line), SLICE):
        buffer = np.frombuffer(line, np.uint8)[max(0, start - 1) : start + SLICE]
        kind = CLASSES[buffer]
        kind[1:][(buffer[:-1] == 0xC3) & _WIDE_UPPER[buffer[1:]]] = 2  # upper case of Latin-1 letters in UTF-8
        kinds += np.bincount(kind[start > 0 :], minlength=8)
    parts = line.split()
    return kinds, len(parts), len(set(parts)), sum(map(bytes.__eq__, parts, parts[1:]))


def own_features(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features of each line by itself, its bytes)."""
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    if len(lines) == 1:  # however long
        kinds, *counted = _shares(lines[0])
        share, words = kinds[None, :].astype(float), np.array([counted], float)
    else:
        buffer = np.frombuffer(b"".join(lines), np.uint8)
        kinds = CLASSES[buffer]
        if len(buffer) > 1:
            kinds[1:][(buffer[:-1] == 0xC3) & _WIDE_UPPER[buffer[1:]]] = 2
        share = np.bincount(np.repeat(np.arange(len(lines)) * 8, sizes) + kinds, minlength=8 * len(lines)).reshape(-1, 8)[:, :8].astype(float)
        words = np.zeros((len(lines), 3))
        for i, line in enumerate(lines):
            parts = line.split()
            if parts:
                words[i] = len(parts), len(set(parts)), sum(map(bytes.__eq__, parts, parts[1:]))
    share /= np.maximum(sizes, 1)[:, None]
    count = np.maximum(words[:, 0], 1)
    return np.column_stack([share, words[:, 1] / count, words[:, 2] / count, np.log1p(sizes) / 8, np.log1p(words[:, 0]) / 6, np.minimum(sizes / count / 10, 3), sizes == 0]), sizes


#: Of the lines beside a line: upper, shout, symbol, distinct words.
BESIDE = [2, 6, 7, 8]


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features by line, bytes by line, lines by text) of some texts."""
    counts = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    own, sizes = own_features([line for t in texts for line in t.split(b"\n")])
    first = np.zeros(len(own), bool)
    first[np.concatenate([[0], np.cumsum(counts)[:-1]])] = True
    last = np.roll(first, -1)
    before, after = np.roll(own[:, BESIDE], 1, axis=0), np.roll(own[:, BESIDE], -1, axis=0)
    before[first] = own[first][:, BESIDE]
    after[last] = own[last][:, BESIDE]
    return np.column_stack([np.ones(len(own)), own, before, after]), sizes, counts


def line_blocks(text: bytes):
    """The lines of a text, in lists of bounded size; a line over it stands alone."""
    at, n = 0, len(text)
    while True:
        ends, stop, count = [], at, 0
        while count < BLOCK_LINES:
            end = text.find(b"\n", stop)
            end = n if end < 0 else end
            if count and end - at > SLICE:
                break
            ends.append((stop, end))
            count += 1
            stop = end + 1
            if end == n:
                yield [text[a:b] for a, b in ends]
                return
        yield [text[a:b] for a, b in ends]
        at = stop


def long_scores(text: bytes, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(score of each line, its bytes) of one text, its features made block by block."""
    scores, sizes, held, before = [], [], None, None
    for lines in _then_none(line_blocks(text)):
        made = own_features(lines) if lines is not None else None
        if held is not None:
            own, size = held
            ahead = np.vstack([own[1:, BESIDE], (made[0] if made is not None else own)[0 if made is not None else -1, BESIDE][None]])
            behind = np.vstack([(own[0] if before is None else before)[BESIDE][None], own[:-1, BESIDE]])
            scores.append(np.column_stack([np.ones(len(own)), own, behind, ahead]) @ weights)
            sizes.append(size)
            before = own[-1]
        held = made
    return np.concatenate(scores), np.concatenate(sizes)


def _then_none(blocks):
    yield from blocks
    yield None


def _by_position(counts: np.ndarray):
    """Texts from the one with most lines on, and for each position the rows of the lines there."""
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    order = np.argsort(-counts, kind="stable")
    starts, sizes = starts[order], counts[order]
    alive = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
    return [starts[:k] + t for t, k in enumerate(alive)]


def marginals(unary: np.ndarray, transition: np.ndarray, counts: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(P(good) by line, expected transitions) by forward-backward, all texts abreast.

    unary: a line's score for good over bad; transition: 2 x 2 scores; weight: of each line in the expected transitions."""
    rows = _by_position(counts)
    e = np.column_stack([np.zeros(len(unary)), unary])
    ahead, back = np.zeros_like(e), np.zeros_like(e)
    for t, at in enumerate(rows):
        if t:
            came = ahead[at - 1]
            ahead[at] = e[at] + np.logaddexp(came[:, :1] + transition[0], came[:, 1:] + transition[1])
        else:
            ahead[at] = e[at]
    for t in range(len(rows) - 2, -1, -1):
        at = rows[t + 1]
        goes = e[at] + back[at]
        back[at - 1] = np.logaddexp(goes[:, :1] + transition[:, 0], goes[:, 1:] + transition[:, 1])
    total = np.logaddexp(*(ahead + back).T)
    pairs = np.zeros((2, 2))
    inner = np.concatenate(rows[1:]) if len(rows) > 1 else np.zeros(0, np.int64)
    if weight is not None:
        for a in range(2):
            for b in range(2):
                pairs[a, b] = weight[inner] @ np.exp(ahead[inner - 1, a] + transition[a, b] + e[inner, b] + back[inner, b] - total[inner])
    return np.exp(ahead[:, 1] + back[:, 1] - total), pairs


def chain_marginals(unary: np.ndarray, transition: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """P(good) by line of one long chain: messages through each stretch for either label it may begin with, all stretches abreast;
    then from stretch to stretch; then within the stretches."""
    n = len(unary)
    m = -(-n // stretch)
    e = np.zeros((m * stretch, 2))
    e[:n, 1] = unary
    real = np.zeros(m * stretch, bool)
    real[:n] = True
    e, real = e.reshape(m, stretch, 2), real.reshape(m, stretch)
    add = np.logaddexp

    def step(came, scores, mask):  # came[..., label before] -> [..., label here]; a line that isn't there changes nothing
        new = np.stack([add(came[..., 0] + transition[0, k], came[..., 1] + transition[1, k]) + scores[..., k] for k in (0, 1)], axis=-1)
        return np.where(mask[..., None], new, came)

    # through[s, a, b]: label a on the line before the stretch, b on its last line
    through = np.full((m, 2, 2), -np.inf)
    through[:, 0, 0] = through[:, 1, 1] = 0.0
    for t in range(stretch):
        through = step(through, e[:, None, t], real[:, None, t])
    enter = np.zeros((m, 2))  # messages on the line before each stretch
    came = e[0, 0].copy()
    for t in range(1, stretch):
        came = step(came, e[0, t], real[0, t])
    for i in range(1, m):
        enter[i] = came
        came = add(came[0] + through[i, 0], came[1] + through[i, 1])
    leave = np.zeros((m, 2))  # messages from all lines behind each stretch, on its last line
    for i in range(m - 1, 0, -1):
        leave[i - 1] = add(through[i, :, 0] + leave[i, 0], through[i, :, 1] + leave[i, 1])
    ahead, back = np.zeros_like(e), np.zeros_like(e)
    ahead[:, 0] = step(enter, e[:, 0], real[:, 0])
    ahead[0, 0] = e[0, 0]
    for t in range(1, stretch):
        ahead[:, t] = step(ahead[:, t - 1], e[:, t], real[:, t])
    back[:, -1] = leave
    for t in range(stretch - 2, -1, -1):
        goes = e[:, t + 1] + back[:, t + 1]
        new = np.stack([add(goes[:, 0] + transition[k, 0], goes[:, 1] + transition[k, 1]) for k in (0, 1)], axis=-1)
        back[:, t] = np.where(real[:, t + 1, None], new, back[:, t + 1])
    ahead, back = ahead.reshape(-1, 2)[:n], back.reshape(-1, 2)[:n]
    return np.exp(ahead[:, 1] + back[:, 1] - add(*(ahead + back).T))


class LineField:
    """Weights of the field and of the calibration."""

    def __init__(self, weights: np.ndarray, transition: np.ndarray, scale: float, shift: float):
        self.weights, self.transition, self.scale, self.shift = weights, transition, scale, shift

    def raw(self, texts: list[bytes]) -> np.ndarray:
        """The length-weighted mean of the lines' marginals."""
        out = np.zeros(len(texts))
        long = np.array([len(t) > SLICE or t.count(b"\n") >= STRETCH * 4 for t in texts], bool)
        for i in np.flatnonzero(long).tolist():
            unary, sizes = long_scores(texts[i], self.weights)
            out[i] = np.average(chain_marginals(unary, self.transition), weights=sizes + 1.0)
        if not long.all():
            features, sizes, counts = line_features([t for t, x in zip(texts, long.tolist(), strict=True) if not x])
            good, _ = marginals(features @ self.weights, self.transition, counts)
            weight = sizes + 1.0
            at = np.concatenate([[0], np.cumsum(counts)[:-1]])
            out[~long] = np.add.reduceat(good * weight, at) / np.add.reduceat(weight, at)
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.raw(texts) + self.shift, -50, 50)))


def window_of(text: bytes, most: int = FIT_BYTES) -> bytes:
    """The part of a text that a fit sees: whole lines from one that a hash of the text picks, up to ``most`` bytes; a longer line's beginning."""
    if len(text) <= most:
        return text
    start = text.rfind(b"\n", 0, zlib.crc32(text) % (len(text) - most + 1)) + 1
    stop = text.rfind(b"\n", start, start + most)
    return text[start : stop if stop > start else start + most]


def fit_lines(texts: list[bytes], labels: np.ndarray, steps: int = STEPS) -> LineField:
    """Maximum likelihood by Adam over all the lines; then a logistic calibration of the documents' raw scores."""
    if not len(texts):
        return LineField(np.zeros(WIDTH), np.zeros((2, 2)), 0.0, 0.0)
    features, _, counts = line_features(texts)
    gold = np.repeat(labels, counts).astype(float)
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) / counts
    by_line = np.repeat(weight, counts)
    pairs_gold = np.diag([float(((counts - 1) * weight)[labels == k].sum()) for k in (0, 1)])
    decay = np.concatenate([np.full(WIDTH, 1e-4), np.full(4, 2e-2)])  # documents' labels overstate how alike neighbours are
    theta, m, v = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
    for t in range(1, steps + 1):
        good, pairs = marginals(features @ theta[:WIDTH], theta[WIDTH:].reshape(2, 2), counts, by_line)
        slope = np.concatenate([features.T @ ((gold - good) * by_line), (pairs_gold - pairs).ravel()]) - decay * theta
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        theta = theta + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    field = LineField(theta[:WIDTH], theta[WIDTH:].reshape(2, 2), 1.0, 0.0)
    x = field.raw(texts)
    w = logistic(np.column_stack([x, np.ones(len(x))]), labels)
    field.scale, field.shift = float(w[0]), float(w[1])
    return field


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = SAMPLE_ROWS) -> LineField:
    """Learn from rows with a label of 0 or 1: a window of about ``rows`` of each."""
    source = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    chosen = stable_sample(source.select("id", "label"), "id", rows, "label").select("id").distinct()
    sampled = source.join(F.broadcast(chosen), "id", "left_semi").select("id", "text", "label")

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield replaced(part, "text", pa.array([window_of(t) for t in utf8(part.column(1))], pa.binary()))

    windows = sampled.mapInArrow(lean(cut), T.StructType([sampled.schema["id"], sampled.schema["label"], T.StructField("text", T.BinaryType())]))
    found = sorted(windows.collect(), key=lambda r: (zlib.crc32(str(r["id"]).encode()), str(r["id"]), bytes(r["text"]), r["label"]))
    return fit_lines([bytes(r["text"]) for r in found], np.array([r["label"] for r in found], int))


def score(df: DataFrame, field: LineField, text_col: str = "text", score_col: str = "quality_score") -> DataFrame:
    """df with a score from 0 to 1 for each whole text; a column of that name is replaced."""
    keep = [c for c in df.columns if c != score_col]
    schema = T.StructType([f for f in df.schema.fields if f.name in keep] + [T.StructField(score_col, T.DoubleType())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                if len(part):
                    values = field.scores(utf8(part.column(part.schema.get_field_index(text_col))))
                    columns = [part.column(part.schema.get_field_index(c)) for c in keep]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(values)], [*keep, score_col])

    return df.mapInArrow(lean(run), schema)


def labelled_documents(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, text, label) of the documents that have one."""
    return docs.select("doc_id", "text").join(labels.where(F.col(label).isNotNull()).select("doc_id", label), "doc_id")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of documents, learned from the labelled rows that aren't held out."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    field = fit(labelled_documents(docs.where(~held), labels.where(~held), "quality"))
    scored = score(docs.select("doc_id", "text"), field, "text", "score")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
