"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

#: A word is a maximal run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None,
                codec: str = "zstd") -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back: later
    jobs start from stored rows, whatever executors are lost meanwhile."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text) -> Column:
    """Number of words (NULL text: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def whole_rows(docs: DataFrame, **keys: Column) -> DataFrame:
    """The keys beside each whole input row as one struct ``_row``, so that no name of the input
    can clash with a key's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       *[c.alias(k) for k, c in keys.items()])


def bitmap(keys: Column, rows: DataFrame, most_bits: int = 28) -> tuple[int, bytes]:
    """(log2 of its bits, bits): a bitmap with the bit of every key's hash set. It has about 16 bits
    per key and never more than 2**most_bits (32 MB), so it may go to the driver and to every task;
    beyond that it only lets more keys through that were not put in."""
    import numpy as np
    import pyarrow as pa
    n = rows.count()
    bits = min(most_bits, max(16, (16 * n).bit_length()))
    cut = min(bits, 17)

    def fill(batches):
        found = {}
        for batch in batches:
            at = batch.column(0).to_numpy()
            for piece in np.unique(at >> cut).tolist():
                found.setdefault(piece, np.zeros(1 << cut, bool))[at[at >> cut == piece] & ((1 << cut) - 1)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([np.packbits(x).tobytes() for x in found.values()], pa.binary())],
                                         names=["piece", "bits"])

    cells = rows.select(F.pmod(keys, F.lit(1 << bits)).alias("cell")).repartition(F.shiftright("cell", cut))
    out = np.zeros(1 << bits >> 3, np.uint8)
    size = 1 << cut >> 3
    for r in cells.mapInArrow(fill, "piece long, bits binary").collect():
        out[r["piece"] * size:(r["piece"] + 1) * size] |= np.frombuffer(r["bits"], np.uint8)
    return bits, out.tobytes()
