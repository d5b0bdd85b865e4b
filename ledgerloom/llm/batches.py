"""Arrow batches in Python tasks. Columns that are only handed on stay Arrow arrays, so their values cannot change."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa

GROUP_CHARS = 2_000_000


def groups_of_rows(batch: pa.RecordBatch, chars: int = GROUP_CHARS) -> Iterator[tuple[int, list[str | None]]]:
    """Consecutive texts of a batch, about ``chars`` characters together, with the place of the first."""
    group: list[str | None] = []
    first = held = 0
    for k, value in enumerate(batch.column("text")):
        text = value.as_py()
        group.append(text)
        held += len(text or "")
        if held > chars:
            yield first, group
            group, first, held = [], k + 1, 0
    if group:
        yield first, group


def ids_of(batch: pd.DataFrame) -> pd.Series:
    """The ids of ``exact_id``, null where there is none."""
    return batch["id"].astype("Int64").mask(~batch["named"])


def names_of(batch: pd.DataFrame) -> list[int | None]:
    return [i if named else None for i, named in zip(batch["id"].tolist(), batch["named"].tolist())]
