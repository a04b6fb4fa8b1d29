"""SentencePiece encoding and decoding by a distinct-chunk table.

In the public vocabulary no piece goes on past a character into a following whitespace marker, and none holds a line feed, so
merges never cross those places: a text's ids are the ids of its marked words (a run of markers and the word after it) one
after another. Each slice of documents is cut into marked words, every distinct one that the worker's table lacks is segmented
once by the library, and the ids are joined back by position. The two properties are checked against the model when it is
loaded; a model without them is encoded text by text.

Null text is encoded as the empty text: no ids. A column named like the output is replaced; other columns pass through.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.common import TwoGenerations, replaced, slices, with_field

#: Distinct marked words kept by a worker: half of the table's two generations.
TABLE_HALF = 80_000
#: Longer words are segmented where they occur and not kept.
LONGEST_KEPT = 32
#: Bytes of text that are cut into words at once.
SLICE = 2 << 20
#: Texts between two marked words: a run of markers (a space is normalized into one) and what follows it up to the next
#: marker or line feed; markers that nothing follows; a line feed.
CHUNK = re.compile("[ ▁]*[^ ▁\n]+|[ ▁]+|\n")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Codec:
    """The library's processor and the table of distinct chunks."""

    def __init__(self, model: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.table = TwoGenerations(TABLE_HALF)
        self.head = self.sp.encode("\n")
        self.separable = self._separable()

    def _separable(self) -> bool:
        """No merge crosses a chunk's border, and spaces are kept as they are."""
        sp = self.sp
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        crosses = any(re.search("[^▁]▁|.\n|\n.", p, re.S) for p in pieces)
        plain = sp.normalize(" a  b \n c") == "▁▁a▁▁b▁\n▁c"
        return not crosses and plain and sp.encode("\na") == self.head + sp.encode("\n\na")[len(self.head) + 1 :]

    def _segment(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk as int32 bytes. Behind a line feed no marker is added to a chunk."""
        n = len(self.head)
        return [np.array(ids[n:], np.int32).tobytes() for ids in self.sp.encode(["\n" + c for c in chunks], num_threads=1)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as int32 bytes."""
        if not self.separable:
            return [np.array(self.sp.encode(t or ""), np.int32).tobytes() for t in texts]
        cut = [CHUNK.findall(" " + t) if t else [] for t in texts]
        distinct = set()
        for chunks in cut:
            distinct.update(chunks)
        self.table.rotate()
        lack = self.table.missing(distinct)
        found = dict(zip(lack, self._segment(lack), strict=True))
        kept, ids = self.table.young, {}
        for chunk, value in found.items():
            if len(chunk) <= LONGEST_KEPT:
                kept[chunk] = value
            else:
                ids[chunk] = value
        if ids:
            return [b"".join([kept[c] if c in kept else ids[c] for c in chunks]) for chunks in cut]
        return [b"".join([kept[c] for c in chunks]) for chunks in cut]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.sp.decode(ids) if ids else []


@lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    """One to a worker and model."""
    return Codec(model)


def _id_lists(values: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) // 4 for v in values], out=offsets[1:])
    flat = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(values))])
    return pa.ListArray.from_arrays(pa.array(offsets), flat)


def encode(df: DataFrame, text_col: str = "text", ids_col: str = "piece_ids", model: str | None = None, decoded_col: str | None = None) -> DataFrame:
    """df with the ids of every whole text, without begin or end ids: array<int>, empty for null or empty text.

    decoded_col: also the library's text for those ids, in the same pass."""
    model = model or default_model()

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                values = codec(model).encode(part.column(part.schema.get_field_index(text_col)).to_pylist())
                out = replaced(part, ids_col, _id_lists(values))
                if decoded_col:
                    texts = [t for v in values for t in codec(model).decode([np.frombuffer(v, np.int32).tolist()])]
                    out = replaced(out, decoded_col, pa.array(texts, pa.string()))
                yield out

    schema = with_field(df.schema, ids_col, T.ArrayType(T.IntegerType()))
    return df.mapInArrow(run, with_field(schema, decoded_col, T.StringType()) if decoded_col else schema)


def decode(df: DataFrame, ids_col: str = "piece_ids", text_col: str = "decoded", model: str | None = None) -> DataFrame:
    """df with the library's text for each list of ids; null ids give the empty text."""
    model = model or default_model()

    def run(batches):
        for batch in batches:
            step = max(1, int(len(batch) * (2 << 20) / max(1, batch.column(batch.schema.get_field_index(ids_col)).nbytes)))
            for start in range(0, len(batch), step):
                part = batch.slice(start, step)
                texts = codec(model).decode([x or [] for x in part.column(part.schema.get_field_index(ids_col)).to_pylist()])
                yield replaced(part, text_col, pa.array(texts, pa.string()))

    return df.mapInArrow(run, with_field(df.schema, text_col, T.StringType()))


def codec_digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of documents(doc_id, text)."""
    both = encode(docs.select("doc_id", "text"), "text", "piece_ids", model, "decoded")
    return both.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("piece_ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
