"""A ledger of requests: who may ask now, who must wait, who is refused."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def decisions(requests: DataFrame, key: str, at: str, row: str, request: str, apart: int, budget: int) -> DataFrame:
    """Decides the rows of each key in order of time (`at`, a long), then of `row`.

    REPLAY if the request was granted before; else DENY once the budget is used up, WAIT if the last grant is less than
    `apart` ago, and RESERVED otherwise. A decision depends on those before it, so each key's rows pass in order through
    one task: a key is not dealt over tasks, however many rows it has. The task holds the grants of one key, `budget` of
    them at most, and a batch of rows.
    """

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last, granted = None, 0, set()
        for batch in batches:
            out = []
            for k, t, asked in zip(batch.column(0).to_pylist(), batch.column(2).to_numpy().tolist(), batch.column(3).to_pylist(), strict=True):
                if k != now:
                    now, last, granted = k, None, set()
                if asked in granted:
                    out.append("REPLAY")
                elif len(granted) >= budget:
                    out.append("DENY")
                elif last is not None and t - last < apart:
                    out.append("WAIT")
                else:
                    out.append("RESERVED")
                    last = t
                    granted.add(asked)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=[key, row, "decision"])

    rows = requests.select(key, row, F.col(at).cast("long").alias("_at"), F.col(request).alias("_request")).repartition(key).sortWithinPartitions(key, "_at", row)
    kinds = {c: requests.schema[c].dataType.simpleString() for c in (key, row)}
    return rows.mapInArrow(decide, f"`{key}` {kinds[key]}, `{row}` {kinds[row]}, decision string")
