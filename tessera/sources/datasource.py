"""SRC1 and SRC4 as Python data sources: ``spark.read.format("tessera_synthetic")`` and ``("tessera_registry")``.

``tessera_synthetic`` makes the generator's rows (the same as ``synthetic_corpus``) in the tasks that read it, range by
range, as Arrow batches; option ``rows``, and optionally ``lang``, ``seed``, ``partitions``.  As a stream its offset is
a row number: a run reads from the last committed offset up to ``rows``, so a restart repeats nothing and a later
run with more rows goes on where the last one ended.

``tessera_registry`` is the table of a configured registry (option ``entries``: its JSON list).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..config import SEED
from .synthetic import SLOTS, TEMPLATES

BATCH_ROWS = 4_096
SYNTHETIC_SCHEMA = "doc_id bigint, text string, lang string, source string"
REGISTRY_SCHEMA = "lang string, source string, source_rank int, path string, fmt string, max_samples bigint, readable boolean"


def _draw(values: list[str], doc_id: int, slot: str, seed: int) -> str:
    return values[int(hashlib.md5(f"{seed}:{doc_id}:{slot}".encode()).hexdigest()[:8], 16) % len(values)]


def synthetic_line(doc_id: int, seed: int = SEED) -> str:
    """The generator's text of one id."""
    text = _draw(TEMPLATES, doc_id, "template", seed)
    for slot, values in SLOTS:
        text = text.replace("{" + slot + "}", _draw(values, doc_id, slot, seed))
    return text


@dataclass
class Rows(InputPartition):
    """Row numbers from ``start`` up to ``end``."""

    start: int
    end: int


def _ranges(start: int, end: int, parts: int) -> list[Rows]:
    n = max(1, min(parts, end - start))
    cuts = [start + (end - start) * i // n for i in range(n + 1)]
    return [Rows(a, b) for a, b in zip(cuts, cuts[1:])]


class _Synthetic:
    def __init__(self, options):
        self.rows = int(options.get("rows", "0"))
        self.lang = options.get("lang", "indonesian")
        self.seed = int(options.get("seed", str(SEED)))
        self.parts = int(options.get("partitions", "8"))

    def read(self, partition: Rows) -> Iterator:
        import pyarrow as pa
        for a in range(partition.start, partition.end, BATCH_ROWS):
            ids = range(a, min(a + BATCH_ROWS, partition.end))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([synthetic_line(i, self.seed) for i in ids], pa.string()),
                 pa.array([self.lang] * len(ids), pa.string()), pa.array(["synthetic"] * len(ids), pa.string())],
                names=["doc_id", "text", "lang", "source"])


class SyntheticReader(_Synthetic, DataSourceReader):
    def partitions(self) -> list[Rows]:
        return _ranges(0, self.rows, self.parts)


class SyntheticStream(_Synthetic, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        return {"row": self.rows}

    def partitions(self, start: dict, end: dict) -> list[Rows]:
        return _ranges(start["row"], max(start["row"], end["row"]), self.parts)


class SyntheticSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tessera_synthetic"

    def schema(self) -> str:
        return SYNTHETIC_SCHEMA

    def reader(self, schema) -> SyntheticReader:
        return SyntheticReader(self.options)

    def streamReader(self, schema) -> SyntheticStream:
        return SyntheticStream(self.options)


class RegistryReader(DataSourceReader):
    def __init__(self, entries: str):
        self.entries = entries

    def read(self, partition) -> Iterator[tuple]:
        from .registry import READABLE_FORMATS
        for i, e in enumerate(json.loads(self.entries)):
            fmt = e.get("fmt", "parquet")
            yield (e["lang"], e["source"], int(e.get("rank", i)), e.get("path"), fmt, e.get("max_samples"), fmt in READABLE_FORMATS and e.get("path") is not None)


class RegistrySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tessera_registry"

    def schema(self) -> str:
        return REGISTRY_SCHEMA

    def reader(self, schema) -> RegistryReader:
        return RegistryReader(self.options.get("entries", "[]"))


def register_sources(spark: SparkSession) -> None:
    """Make the formats known to the session."""
    spark.dataSource.register(SyntheticSource)
    spark.dataSource.register(RegistrySource)
