"""Line dedup: lines found in many documents stay in one of them only.

Normalised lines are hashed to 128 bits and exploded, each at most once per
document, so a plain count per hash is the count of documents and combines on
the map side: a line found everywhere is one row per task. The hashes to drop
come back as one short list per document, and each document is put together
again from its own lines in their order; whole texts are shuffled once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almenara.llm.tables import free_name, row_key, stored, text_bytes

_BLANK = b" \t\n\r\x0b\x0c"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of the normalised line; None if it is under ``min_chars`` code points."""
    key = line.strip(_BLANK).lower()  # of bytes: lower-cases A-Z alone
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """Lines to drop per document: ``_id``, ``_key``, ``_drop`` (list of line hashes)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), row_key(id_col, text_col).alias("_key"), text_bytes(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({k for line in text.as_py().split(b"\n") if (k := line_key(line, min_chars))}) for text in batch["_text"]]
            yield pa.RecordBatch.from_arrays([batch["_id"], batch["_key"], pa.array(found, pa.list_(pa.binary()))], names=["_id", "_key", "_lines"])

    lines = rows.mapInArrow(hashes, f"_id {id_type}, _key bigint, _lines array<binary>").select("_id", "_key", F.explode("_lines").alias("_line"))
    counted = lines.groupBy("_line").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_keeper"))
    common = stored(counted.where(F.col("_n") >= min_docs).drop("_n"), "shared-lines")  # so that the join's hot keys can be split
    dropped = lines.join(common, "_line").where(~F.col("_id").eqNullSafe(F.col("_keeper")))
    return dropped.groupBy("_id", "_key").agg(F.collect_set("_line").alias("_drop"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """The documents with repeated lines taken out of ``text_col``, and counts per document.

    A line's key is the line without blanks (0x20, 0x09-0x0D) at both ends and
    with A-Z lower-cased. Keys of at least ``min_chars`` code points found in
    at least ``min_docs`` documents stay only in the smallest id that holds
    them, there in every place. Returns the columns of ``docs`` (text replaced)
    and ``_n_lines`` (before), ``_n_dropped``, ``_kept_sha256``.

    A null text is one empty line; it stays null where nothing was dropped.
    Null ids come last and lose their lines to any other id; if only null ids
    hold a line, it stays. Rows with the same id count as holding the line
    together and all keep it. Other columns pass through, whatever their names;
    those of the three names above are replaced.
    """
    docs = docs.drop("_n_lines", "_n_dropped", "_kept_sha256")
    names, mine, theirs, own, drop_col = docs.columns, *(free_name(docs, n) for n in ("_key", "_key_r", "_id_r", "_drop"))
    drops = shared_lines(docs, id_col, text_col, min_chars, min_docs).withColumnsRenamed({"_key": theirs, "_id": own, "_drop": drop_col})
    rows = docs.withColumn(mine, row_key(id_col, text_col))
    same = F.col(mine).eqNullSafe(F.col(theirs)) & F.col(f"`{id_col}`").eqNullSafe(F.col(own))
    joined = rows.join(drops, same, "left").drop(mine, theirs, own)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, dropped, digests = [], [], [], []
            for text, drop in zip(batch[text_col], batch[drop_col], strict=True):
                value = text.as_py()
                lines = (value or "").encode().split(b"\n")
                bad = set(drop.as_py() or ())
                kept = [line for line in lines if line_key(line, min_chars) not in bad] if bad else lines
                new = b"\n".join(kept)
                texts.append(value if len(kept) == len(lines) else new.decode())
                counts.append(len(lines))
                dropped.append(len(lines) - len(kept))
                digests.append(hashlib.sha256(new).hexdigest())
            columns = [pa.array(texts, batch[n].type) if n == text_col else batch[n] for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digests)], names=[*names, "_n_lines", "_n_dropped", "_kept_sha256"])

    return joined.mapInArrow(rebuild, f"{kinds}, _n_lines bigint, _n_dropped bigint, _kept_sha256 string")
