"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import json
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanefold.functions.shared import shared_dir, written  # noqa: F401

#: Rows of an Arrow batch that goes to Python: whole texts are long, so batches are kept short.
BATCH_ROWS = 512


def byte_level_spec(path: str) -> dict:
    """The tokenizer file as a dict, if texts fall apart at its byte-level pattern; raises ValueError otherwise.

    Asked for are byte-level BPE with the pattern, no normalizer, no prefix space, and added tokens that take no
    white space or word borders with them. Any other file would give wrong ids or counts.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    odd = [name for name, bad in (
        ("pre-tokenizer", pre.get("type") != "ByteLevel" or pre.get("add_prefix_space", True) or not pre.get("use_regex", True)),
        ("normalizer", spec.get("normalizer") is not None),
        ("model", model.get("type", "BPE") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))),
        ("added tokens", any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized"))),
    ) if bad]
    if odd:
        raise ValueError(f"{path}: not a plain byte-level BPE file ({', '.join(odd)})")
    return spec


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Bound the rows that one Arrow batch hands to Python, if nobody chose a number below it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def text_key(text: str = "text") -> list:
    """Two 64-bit hashes that identify a text (null as empty): equal texts share every result that depends on text alone."""
    t = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(7), t).alias("t2")]


def own_columns(docs: DataFrame, made: list[str], needed: list[str]) -> DataFrame:
    """``docs`` without the columns that an operator makes (names compare without case, as Spark's do).

    Raises ValueError if the operator would replace a column that it reads.
    """
    new = {name.lower() for name in made}
    if taken := sorted(c for c in needed if c.lower() in new):
        raise ValueError(f"columns {taken} are read and made; rename them first")
    return docs.drop(*[c for c in docs.columns if c.lower() in new])


def own_names(n: int) -> list[str]:
    """Names for columns on the way, which no table has."""
    return [f"_{uuid.uuid4().hex}" for _ in range(n)]


def apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names of its own, which clash with none that an operator uses on the way, and the new name of each column."""
    names = dict(zip(docs.columns, own_names(len(docs.columns)), strict=True))
    return docs.toDF(*names.values()), names


def back(rows: DataFrame, names: dict[str, str], made: list[str] = []) -> DataFrame:  # noqa: B006
    """``rows`` under the names that they had, with the columns that were made; those replace columns of equal names."""
    new = {m.lower() for m in made}
    return rows.select(*[F.col(k).alias(c) for c, k in names.items() if c.lower() not in new], *made)


def give_back() -> None:
    """Hands what a task has freed back to the system: Python workers live on, and stages that follow need the room."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
