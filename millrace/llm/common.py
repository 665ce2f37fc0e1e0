"""What the operators share: batches through Python, bounded caches, keys of rows."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH = "__hash"
KEY = "__key"
_UNSPACED = "\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
#: A word; where a script sets no spaces (Chinese, Japanese), two characters count as one.
WORD = re.compile(rf"[{_UNSPACED}]{{1,2}}|[^\W{_UNSPACED}]+")


class Cache(dict):
    """A dict that computes missing values and starts afresh at `limit` entries, so that it never outgrows a worker."""

    def __init__(self, compute: Callable, limit: int = 400_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def add_columns(df: DataFrame, make: Callable[[], Callable], added: str) -> DataFrame:
    """`df` with the columns of the DDL `added`, computed batch by batch.

    `make()` runs once per task and gives `f(batch) -> arrays`.  Columns of `df` that bear an added name give way.
    """
    extra = T.StructType.fromDDL(added)
    kept = df.drop(*[f.name for f in extra])
    types = [T.StructType([f]) for f in extra]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        compute, kinds = make(), [to_arrow_schema(t).field(0).type for t in types]
        for batch in batches:
            arrays = [a if isinstance(a, pa.Array) else pa.array(a, kind) for a, kind in zip(compute(batch), kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *extra.names])
        del compute
        pa.default_memory_pool().release_unused()  # workers live on, and those of later stages share the executor

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *extra.fields]))


def with_key(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Adds `__key` (the id, null last of all) and `__hash` (of the text): together they name a document.

    Rows that agree in both are one document for every operator and fare alike.
    """
    return docs.withColumns({
        KEY: F.coalesce(F.col(key).cast("long"), F.lit(2**63 - 1)),
        HASH: F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
    })


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
