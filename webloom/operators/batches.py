"""Results of Python stages in frames of a bounded size, whatever the size of the batches that come in."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd

#: What a frame holds at most: rows, and characters of their texts but for its last row.
ROWS, CHARS = 10_000, 4_000_000


def frames(rows: Iterable[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """The rows in frames, each sent on before the next is made."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= ROWS or chars >= CHARS:
            yield pd.DataFrame(held, columns=columns)
            held, chars = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)
