"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lowers case, strips accents, maps letters of other scripts that look like Latin ones, and reads signs inside words, and one or
two digits beside a letter, as the letters they stand for; numbers stay numbers. The lexicon holds whole words and word beginnings whose share of toxic training
documents is far above that of the others; its weights are log ratios. A match counts where its word begins, unless it lies
in an exception phrase: two words around a lexicon entry that training documents only have where they aren't toxic. The sum of
weights, and that sum for the length of the text, go into a logistic score fitted on the training rows.

Defined results: null and empty text have no match and get the score of such texts. Without labelled rows of both kinds the
lexicon is empty and every score 0. Whole texts are scored, words of any length; only the fit is bounded: about ``SAMPLE_ROWS``
labelled rows of each label, and an entry must be in ``SHARE`` of the toxic ones. Ids may be null or repeated; extra columns aren't read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.common import lean, logistic, slices, stable_sample

SAMPLE_ROWS, LEAST_WEIGHT = 5000, 2.5
#: Toxic training documents that an entry is in: so many, and this share of them.
SUPPORT, SHARE = 3, 0.01
#: Lengths of the word beginnings that may become entries.
STEMS = (4, 5, 6, 7)
#: Cyrillic and Greek letters and others by the Latin letter they look like.
LOOKALIKES = dict(zip("аесорхуіјѕһԁԛԝьгтпкмнвᴀαβεικνορτυχγωσñłøđ", "aecopxyijshdqwbrtnkmhbaabeiknoptuxywonlod", strict=True))
DIGITS = dict(zip("0134578", "oieastb", strict=True))
_SIGNS = re.compile(r"(?<=[^\W\d_])(?:[@$]+|!(?=[^\W\d_]))")
_SIGN = str.maketrans("@$!", "asi")
_DIGIT = str.maketrans(DIGITS)
_BESIDE = re.compile(r"(?<=[^\W\d_])[0-9]{1,2}(?![0-9])|(?<![0-9])[0-9]{1,2}(?=[^\W\d_])")
WORD = re.compile(r"\w+")
_AFTER = re.compile(r"\W*(\w+)")


class _Folds(dict):
    """Code point -> folded string, worked out once for each."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        out = "".join(c for c in unicodedata.normalize("NFKD", char.lower()) if not unicodedata.combining(c))
        out = "".join(LOOKALIKES.get(c, c) for c in out)
        self[code] = out = " " if unicodedata.category(char) in ("Zl", "Zp") else "" if unicodedata.category(char) == "Cf" else out
        return out


FOLDS = _Folds()


def fold(text: str) -> str:
    """The text as the lexicon sees it."""
    if "@" in text or "$" in text or "!" in text:
        text = _SIGNS.sub(lambda m: m[0].translate(_SIGN), text)
    return _BESIDE.sub(lambda m: m[0].translate(_DIGIT), text.translate(FOLDS))


class Lexicon:
    """Entries with their weights (``stem*`` for beginnings), exception phrases, and the logistic weights."""

    def __init__(self, weights: dict[str, float], exceptions: set[str], logit: tuple[float, ...]):
        self.weights, self.exceptions, self.logit = weights, exceptions, logit

    def __reduce__(self):
        return Lexicon, (self.weights, self.exceptions, self.logit)

    def matcher(self):
        if not hasattr(self, "_matcher"):
            import ahocorasick

            self._matcher = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                key = entry.rstrip("*")
                kinds = self._matcher.get(key, ()) if key in self._matcher else ()
                self._matcher.add_word(key, (*kinds, (len(key), entry.endswith("*"), weight)))
            if self.weights:
                self._matcher.make_automaton()
        return self._matcher

    def matches(self, folded: str) -> dict[int, tuple[int, float]]:
        """Start of a matched word -> (end of the match, weight), the heaviest entry of a word."""
        found: dict[int, tuple[int, float]] = {}
        if not self.weights or not folded:
            return found
        n = len(folded)
        for last, kinds in self.matcher().iter(folded):
            end = last + 1
            for length, stem, weight in kinds:
                start = end - length
                if start and (folded[start - 1].isalnum() or folded[start - 1] == "_"):
                    continue
                if not stem and end < n and (folded[end].isalnum() or folded[end] == "_"):
                    continue
                if start not in found or found[start][1] < weight:
                    found[start] = end, weight
        return found

    def features(self, text: str | None) -> tuple[float, float]:
        """(sum of weights, words) of a whole text."""
        folded = fold(text) if text else ""
        found = self.matches(folded)
        total = 0.0
        for start, (end, weight) in found.items():
            if not (self.exceptions and any(p in self.exceptions for p in phrases(folded, start, end))):
                total += weight
        return total, float(folded.count(" ") + folded.count("\n") + 1)

    def scores(self, pairs: list[tuple[float, float]]) -> np.ndarray:
        if not self.logit:
            return np.zeros(len(pairs))
        return 1 / (1 + np.exp(-np.clip(design(pairs) @ np.array(self.logit), -50, 50)))


def design(pairs: list[tuple[float, float]]) -> np.ndarray:
    x = np.array(pairs, float).reshape(-1, 2)
    return np.column_stack([np.ones(len(x)), x[:, 0] > 0, np.log1p(x[:, 0]), np.log1p(100 * x[:, 0] / np.maximum(x[:, 1], 20))])


def phrases(folded: str, start: int, end: int) -> list[str]:
    """The matched word with the word before and with the one after it, however far off they are."""
    stop = WORD.match(folded, start).end()
    word, out = folded[start:stop], []
    last = start
    while last and not (folded[last - 1].isalnum() or folded[last - 1] == "_"):
        last -= 1
    if last:
        first = last
        while first and (folded[first - 1].isalnum() or folded[first - 1] == "_"):
            first -= 1
        out.append(f"{folded[first:last]} {word}")
    if after := _AFTER.match(folded, stop):
        out.append(f"{word} {after[1]}")
    return out


def terms(text: str | None) -> set[str]:
    """The distinct words of a folded text and their beginnings."""
    words = set(WORD.findall(fold(text))) if text else set()
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = SAMPLE_ROWS) -> Lexicon:
    """Learn from rows with a label of 0 or 1: about ``rows`` of each."""
    source = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    chosen = stable_sample(source.select("id", "label"), "id", rows, "label").select("id").distinct()
    sampled = source.join(F.broadcast(chosen), "id", "left_semi").select("text", "label").distinct()

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found: dict[str, list[int]] = {}
                for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for term in terms(text):
                        found.setdefault(term, [0, 0])[label] += 1
                    found.setdefault("", [0, 0])[label] += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), *[pa.array([v[k] for v in found.values()], pa.int64()) for k in (0, 1)]], ["term", "clean", "toxic"])

    counted = sampled.mapInArrow(count, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).persist()
    total = counted.where("term = ''").first()
    if total is None or not total["toxic"] or not total["clean"]:
        counted.unpersist()
        return Lexicon({}, set(), ())
    weight = F.log((F.col("toxic") + 0.5) / (total["toxic"] + 1)) - F.log((F.col("clean") + 0.5) / (total["clean"] + 1))
    top = counted.where((F.col("term") != "") & (F.col("toxic") >= max(SUPPORT, math.ceil(SHARE * total["toxic"])))).withColumn("weight", weight).where(F.col("weight") >= LEAST_WEIGHT)
    entries = {r["term"]: r["weight"] for r in top.collect()}
    counted.unpersist()
    stems = {e[:-1] for e in entries if e.endswith("*")}
    short = {s for s in stems if not any(s[:n] in stems for n in STEMS if n < len(s))}
    weights = {e: w for e, w in entries.items() if (e[:-1] in short if e.endswith("*") else not any(e[:n] in short for n in STEMS))}
    lexicon = Lexicon(weights, set(), ())

    def context(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found: dict[str, list[int]] = {}
                for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    folded = fold(text) if text else ""
                    for phrase in {p for s, (e, _) in lexicon.matches(folded).items() for p in phrases(folded, s, e)}:
                        found.setdefault(phrase, [0, 0])[label] += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), *[pa.array([v[k] for v in found.values()], pa.int64()) for k in (0, 1)]], ["phrase", "clean", "toxic"])

    innocent = sampled.mapInArrow(context, "phrase string, clean long, toxic long").groupBy("phrase").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(f"toxic = 0 and clean >= {SUPPORT}")
    lexicon.exceptions = {r["phrase"] for r in innocent.collect()}
    seen = sampled.mapInArrow(_features(lexicon), "total double, words double, label int").toPandas()
    labels = seen["label"].to_numpy(int)
    pairs = list(zip(seen["total"], seen["words"], strict=True))
    lexicon.logit = tuple(float(x) for x in logistic(design(pairs), labels, ridge=1e-3))
    return lexicon


def _features(lexicon: Lexicon):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                pairs = [lexicon.features(t) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.float64()), pa.array([p[1] for p in pairs], pa.float64()), part.column(1)], ["total", "words", "label"])

    return run


def score(df: DataFrame, lexicon: Lexicon, text_col: str = "text", score_col: str = "toxicity") -> DataFrame:
    """df with a score from 0 to 1 for each whole text; a column of that name is replaced."""
    keep = [c for c in df.columns if c != score_col]
    schema = T.StructType([f for f in df.schema.fields if f.name in keep] + [T.StructField(score_col, T.DoubleType())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                values = lexicon.scores([lexicon.features(t) for t in part.column(part.schema.get_field_index(text_col)).to_pylist()])
                yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in keep], pa.array(values, pa.float64())], [*keep, score_col])

    return df.mapInArrow(lean(run), schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of documents, learned from the labelled rows that aren't held out."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    labelled = docs.where(~held).select("doc_id", "text").join(labels.where(~held & F.col("toxic").isNotNull()).select("doc_id", "toxic"), "doc_id")
    scored = score(docs.select("doc_id", "text"), fit(labelled), "text", "score")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
