import pytest
from pyspark.sql import functions as F

#: Names that operators use inside; inputs may have columns of these names, too.
CLASHES = ["id", "fp", "key", "k1", "k2", "row", "runs", "score", "piece_ids", "decoded", "sha", "best", "n", "v", "q", "c", "held_out", "label", "lang_pred", "predicted", "spans", "items", "block", "rank", "tree", "up", "root", "repeat_spans", "n_words", "fingerprint", "component_id"]


def clashing(df):
    """df with extra columns named like the operators' own."""
    return df.select("*", *[F.lit(f"x{i}").alias(name) for i, name in enumerate(CLASHES) if name not in df.columns])


def rows_of(df):
    """Rows as sorted tuples of printable values, columns in order of name."""
    names = sorted(df.columns)
    return sorted(tuple(repr(r[c]) for c in names) for r in df.select(*names).collect())


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text, lang, source, n_chars): nulls, empty and very long texts, ties, repeated rows and ids."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    running = lambda n, seed: " ".join(words[(i * i * 7 + i * seed + seed * 13) % len(words)] + str((i * seed) % 97) for i in range(n))
    passage = running(120, 5)
    texts = [
        (1, None), (2, ""), (3, " "), (4, "\n\n\n"), (5, "one"), (6, "Two Words"), (7, "three words here"), (8, "THREE words\there"),
        (9, running(60, 3)), (10, running(60, 3)), (11, running(60, 3) + " tail"), (12, passage), (13, "before it " + passage + " after it"),
        (14, passage[:500] + passage[:500]), (15, "é" * 900), (16, "naïve façade über ▁ marker ▁▁ twice  spaces\tand tabs\r\n end"),
        (17, running(30_000, 11)), (18, running(30_000, 11)[:90_000]), (19, "a" * 5000), (20, "日本語のテキスト と English mixed 🙂🙂"),
        (None, "a row without an id"), (None, "a row without an id"), (21, "same id"), (21, "same id"), (21, "another text of the same id"),
        (22, running(60, 3).replace("alpha", "alpha")), (23, "0" * 399 + "x"), (24, "0" * 399 + "x" + "0" * 400),
    ]
    langs = ["en", "fr", None]
    rows = [(i, t, langs[k % 3], "web" if k % 2 else None, None if t is None else len(t)) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).checkpoint()
