"""Language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary get a probability per language. A word's likelihood in a language is the sum, over all
its segmentations into pieces, of the products of their probabilities: one forward pass over the word. Probabilities come from
expectation-maximisation over the words of a bounded sample of labelled rows. A text's log likelihood is the sum
over its words (pieces of this vocabulary don't cross white space), so each distinct word is summed over once by a worker.

Defined results: null text, or text without a letter, is ``und`` with score 0; so is everything when no labelled row is given.
Letters are what Unicode calls so: digits of any kind, Roman numerals and the like are none. Ties go to the language that sorts
first. Words of any length are summed over whole. Extra columns aren't read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.common import TwoGenerations, lean, slices, stable_sample
from webloom.llm.sentencepiece_codec import codec, default_model

#: Rows of the sample for each language; distinct words that a worker remembers; longer words aren't.
SAMPLE_ROWS, ROUNDS = 2000, 3
TABLE_HALF, LONGEST_KEPT = 150_000, 48
#: Letters of the words whose sums stay within what doubles hold; longer ones are summed by logarithms.
LINEAR = 24
WORD = re.compile(r"[^\W\d_]+")
MARK = "▁"


class _NoLetters(dict):
    """Code point -> a space for what the pattern takes as a letter and isn't one (numerals); others stay."""

    def __missing__(self, code: int) -> int:
        char = chr(code)
        self[code] = out = 32 if WORD.fullmatch(char) and not char.isalpha() else code
        return out


_LETTERS = _NoLetters()


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    if not text:
        return []
    lower = text.lower()
    return WORD.findall(lower if lower.isascii() else lower.translate(_LETTERS))


def vocabulary(model: str) -> list[str]:
    """The pieces that can stand in a marked lower-case word."""
    sp = codec(model).sp
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)))
    return [p for p in pieces if MARK not in p[1:] and p == p.lower() and (p == MARK or WORD.fullmatch(p.lstrip(MARK)))]


class Lattice:
    """Arcs of words over the vocabulary; a letter outside of it is an arc of its own."""

    def __init__(self, pieces):
        self.known = set(pieces)
        self.prefixes = {p[:i] for p in pieces for i in range(1, len(p) + 1)}
        self.longest = max(map(len, pieces), default=1)

    def arcs(self, word: str):
        """Arcs (from, to, piece) by where they begin."""
        n = len(word)
        for i in range(n):
            single = False
            for j in range(i + 1, n + 1):
                part = word[i:j]
                if part not in self.prefixes:
                    break
                if part in self.known:
                    yield i, j, part
                    single |= j == i + 1
            if not single:
                yield i, i + 1, ""


def _plus(a: float, b: float) -> float:
    """The logarithm of the sum, of logarithms."""
    return a if b == -math.inf else b if a == -math.inf else max(a, b) + math.log1p(math.exp(-abs(a - b)))


def expected(arcs: list[tuple[int, int, str]], n: int, prob: dict[str, float]) -> list[float]:
    """Each arc's probability given the word: forward and backward sums; of long words by their logarithms."""
    if n <= LINEAR:
        ahead, back = [1.0] + [0.0] * n, [0.0] * n + [1.0]
        for i, j, piece in arcs:
            ahead[j] += ahead[i] * prob[piece]
        for i, j, piece in reversed(arcs):
            back[i] += back[j] * prob[piece]
        z = ahead[n]
        return [ahead[i] * prob[piece] * back[j] / z for i, j, piece in arcs] if z > 0 else [0.0] * len(arcs)
    none = -math.inf
    logs = {piece: math.log(prob[piece]) if prob[piece] > 0 else none for _, _, piece in arcs}
    ahead, back = [0.0] + [none] * n, [none] * n + [0.0]
    for i, j, piece in arcs:
        ahead[j] = _plus(ahead[j], ahead[i] + logs[piece])
    for i, j, piece in reversed(arcs):
        back[i] = _plus(back[i], back[j] + logs[piece])
    return [math.exp(ahead[i] + logs[piece] + back[j] - ahead[n]) for i, j, piece in arcs] if ahead[n] > none else [0.0] * len(arcs)


def fit_language(counts: list[tuple[str, int]], lattice: Lattice, rounds: int = ROUNDS) -> dict[str, float]:
    """Piece probabilities by expectation-maximisation over (word, count) pairs; '' is a letter outside the vocabulary."""
    words = [(list(lattice.arcs(MARK + w)), len(w) + 1, c) for w, c in counts]
    start: Counter = Counter()
    for arcs, _, c in words:
        for i, j, piece in arcs:
            start[piece] += c * (j - i)
    total = sum(start.values())
    prob = {p: v / total for p, v in start.items()}
    for _ in range(rounds):
        got: Counter = Counter()
        for arcs, n, c in words:
            for (_, _, piece), share in zip(arcs, expected(arcs, n, prob), strict=True):
                got[piece] += c * share
        total = sum(got.values()) or 1.0
        prob = {p: max(got[p] / total, 1e-12) for p in start}
    return prob


class Model:
    """Languages and, for each piece, its probabilities."""

    def __init__(self, languages: list[str], table: dict[str, tuple[float, ...]]):
        self.languages, self.table = languages, table

    def __reduce__(self):
        return Model, (self.languages, self.table)

    def ready(self):
        if not hasattr(self, "lattice"):
            self.lattice = Lattice([p for p in self.table if p])
            self.logs = {p: [math.log(v) if v > 0 else -math.inf for v in vs] for p, vs in self.table.items()}
            self.seen = TwoGenerations(TABLE_HALF)
        return self

    def word(self, word: str) -> list[float]:
        """The log likelihoods of a word: the forward algorithm, for all languages at once. Of a long word only the sums within a piece's reach are held."""
        k, marked = range(len(self.languages)), MARK + word
        n = len(marked)
        if n <= LINEAR:
            ahead = [[1.0] * len(k)] + [[0.0] * len(k) for _ in marked]
            for i, j, piece in self.lattice.arcs(marked):
                a, b, p = ahead[i], ahead[j], self.table[piece]
                for x in k:
                    b[x] += a[x] * p[x]
            return [math.log(v) if v > 0 else -700.0 for v in ahead[n]]
        none, room = -math.inf, self.lattice.longest + 1
        ring = [[none] * len(k) for _ in range(room)]
        ring[0], at = [0.0] * len(k), 0
        for i, j, piece in self.lattice.arcs(marked):
            while at < i:  # the place behind is used up: it becomes the farthest one ahead
                ring[at % room] = [none] * len(k)
                at += 1
            a, b, p = ring[i % room], ring[j % room], self.logs[piece]
            for x in k:
                b[x] = _plus(b[x], a[x] + p[x])
        return ring[n % room]

    def texts(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Predicted languages and scores: each language's share of the likelihood."""
        cut = [words_of(t) for t in texts]
        distinct = list(set().union(*cut)) if cut else []
        if not self.languages or not distinct:
            return ["und"] * len(texts), [0.0] * len(texts)
        self.seen.rotate()
        long = {w: self.word(w) for w in distinct if len(w) > LONGEST_KEPT}
        for w in self.seen.missing([w for w in distinct if w not in long]):
            self.seen.young[w] = self.word(w)
        at = {w: i for i, w in enumerate(distinct)}
        matrix = np.array([long[w] if w in long else self.seen.young[w] for w in distinct])
        names, scores = [], []
        for words in cut:
            if not words:
                names.append("und")
                scores.append(0.0)
                continue
            total = matrix[np.fromiter(map(at.__getitem__, words), np.int64, len(words))].sum(axis=0)
            best = int(total.argmax())
            names.append(self.languages[best])
            scores.append(float(1 / np.exp(np.minimum(total - total[best], 0)).sum()))
        return names, scores


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: str | None = None, rows: int = SAMPLE_ROWS) -> Model:
    """Learn from rows with a text and a language: all words of about ``rows`` rows a language."""
    source = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("id is not null and lang is not null")
    chosen = stable_sample(source.select("id", "lang"), "id", rows, "lang").select("id")

    def count(batches):
        for batch in batches:
            found: Counter = Counter()
            for part in slices(batch, "text"):
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for w, n in Counter(words_of(text)).items():
                        found[lang, w] += n
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])

    sampled = source.join(F.broadcast(chosen.distinct()), "id", "left_semi").select("text", "lang")
    counted = sampled.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    by: dict[str, list] = {}
    for row in counted.collect():  # the sample's words
        by.setdefault(row[0], []).append((row[1], row[2]))
    languages = sorted(by)
    pieces = vocabulary(model or default_model())
    lattice = Lattice(pieces)
    each = [fit_language(sorted(by[x]), lattice) for x in languages]
    used = set().union(*each, [""]) if each else {""}
    pooled = {p: sum(e.get(p, 0.0) for e in each) / max(1, len(each)) for p in used}
    floor = 1e-7
    return Model(languages, {p: tuple(0.97 * e.get(p, 0.0) + 0.03 * pooled[p] + floor for e in each) for p in used})


def identify(df: DataFrame, fitted: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "lang_score") -> DataFrame:
    """df with the predicted language of each whole text and its score; columns of those names are replaced."""
    keep = [c for c in df.columns if c not in (lang_col, score_col)]
    schema = T.StructType([f for f in df.schema.fields if f.name in keep] + [T.StructField(lang_col, T.StringType()), T.StructField(score_col, T.DoubleType())])

    def run(batches):
        ready = fitted.ready()
        for batch in batches:
            for part in slices(batch, text_col):
                names, scores = ready.texts(part.column(part.schema.get_field_index(text_col)).to_pylist())
                columns = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*keep, lang_col, score_col])

    return df.mapInArrow(lean(run), schema)


def language_prediction(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of documents, learned from the rows that aren't held out."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    fitted = fit(docs.where(~held))
    return identify(docs.select("doc_id", "text"), fitted, "text", "lang_pred", "score").select("doc_id", held.alias("held_out"), "lang_pred", "score")
