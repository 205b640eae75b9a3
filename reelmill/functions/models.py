"""Steps that need a model: a protocol, and the loop that loads it once a Python worker. No model is shipped."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class Model(Protocol):
    """Anything that turns a batch of rows (path first) into as many rows of results."""

    def __call__(self, rows: pd.DataFrame) -> pd.DataFrame: ...


def apply_model(df: DataFrame, load: Callable[[], Model], schema: str) -> DataFrame:
    """Runs a model over batches. ``schema`` has path and status; a batch that raises gives a failed row a clip.

    Put gates and anti-joins with cached results before it: semi-joins above a Python step are not pushed below it.
    """
    columns = [c.strip().split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for rows in batches:
            try:
                yield model(rows)[columns]
            except Exception as e:  # a bad clip is a row, not the end of the job
                failed = pd.DataFrame({"path": rows["path"], "status": f"failed: {e}"}).reindex(columns=columns).astype(object)
                yield failed.where(failed.notna(), None)

    return df.mapInPandas(run, schema)


class HashedText:
    """Stand-in for tests: a unit vector from a hash of the text, with no meaning at all."""

    def __init__(self, dim: int = 8):
        self.dim = dim

    def __call__(self, rows: pd.DataFrame) -> pd.DataFrame:
        import hashlib

        import numpy as np

        out = []
        for text in rows["text"]:
            v = np.frombuffer(hashlib.sha256(text.encode()).digest()[: self.dim], dtype=np.uint8).astype(float) - 127.5
            out.append((v / np.linalg.norm(v)).tolist())
        return rows.assign(status="ok", embedding=out)
