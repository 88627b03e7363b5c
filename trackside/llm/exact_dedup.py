"""Operator 2: exact duplicates by composable polynomial fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.llm.common import BLANKS, utf8_cells
from trackside.session import forget, landed, small_batches

#: Two moduli below 2^31, so that products fit in 63 bits, and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 741103597)
CHUNK = 1 << 16


def _powers(prime: int, base: int, n: int) -> np.ndarray:
    """base^(n-1), ..., base, 1 modulo the prime."""
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:  # the front is the back times a power
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, prime)) % np.uint64(prime)
        have += more
    return out[::-1].copy()


class Hasher:
    """Polynomial hashes of byte chunks: of b0..bn, the sum of bi * base^(n-i) for both moduli."""

    def __init__(self, chunk: int = CHUNK, primes: tuple[int, ...] = PRIMES):
        self.chunk, self.primes = chunk, primes
        self.powers = [_powers(p, b, chunk) for p, b in zip(primes, BASES)]

    def chunks(self, cell: bytes) -> Iterator[bytes]:
        """Pieces of a text without its blanks; an empty text has one empty piece."""
        for at in range(0, max(1, len(cell)), self.chunk):
            yield cell[at : at + self.chunk]

    def hashes(self, chunk: bytes) -> list[int]:
        """Hash and shift (base^length) for each modulus."""
        data = np.frombuffer(chunk, np.uint8).astype(np.uint64)
        out = []
        for prime, base, powers in zip(self.primes, BASES, self.powers):
            out += [int(np.dot(data, powers[self.chunk - len(data) :])) % prime, pow(base, len(data), prime)]
        return out


def combined(parts: Column, prime: int, k: int) -> Column:
    """Hash of a whole from its ordered chunks: shift what came before by the chunk's length, add it."""
    return F.aggregate(parts, F.lit(0).cast("long"), lambda at, c: (at * c[f"s{k}"] + c[f"h{k}"]) % F.lit(prime))


def _hash_rows(hasher: Hasher):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("raw", pa.int64()), ("n_points", pa.int64()), ("text_sha256", pa.string()), ("no", pa.int32()), ("n", pa.int64()), ("h0", pa.int64()), ("s0", pa.int64()), ("h1", pa.int64()), ("s1", pa.int64())])
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = [[] for _ in schema]
            for doc_id, raw, cell in zip(batch.column("doc_id").to_pylist(), batch.column("raw").to_pylist(), utf8_cells(batch.column("text"))):
                points = int(np.count_nonzero((np.frombuffer(cell, np.uint8) & 0xC0) != 0x80))
                bare = bytes(cell).translate(None, BLANKS.encode())
                sha = hashlib.sha256(bare).hexdigest()
                for no, chunk in enumerate(hasher.chunks(bare)):
                    for column, value in zip(out, (uid, doc_id, raw, points, sha if no == 0 else None, no, len(chunk), *hasher.hashes(chunk))):
                        column.append(value)
                uid += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return rows


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("raw"), text.alias("text"))


def fingerprints(docs: DataFrame, hasher: Hasher) -> DataFrame:
    """Row per row of ``docs``: uid, doc_id, raw (hash of the cell), n_points, text_sha256, n, f0, f1.

    Tasks hash chunks; the chunks of a row are combined from their hashes and lengths alone, so a
    huge text costs its reader one chunk of numbers at a time.
    """
    chunks = _keyed(docs).mapInArrow(
        _hash_rows(hasher), "uid long, doc_id long, raw long, n_points long, text_sha256 string, no int, n long, h0 long, s0 long, h1 long, s1 long"
    )
    parts = F.array_sort(F.collect_list(F.struct("no", "h0", "s0", "h1", "s1")))
    whole = chunks.groupBy("uid").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("raw").alias("raw"),
        F.first("n_points").alias("n_points"),
        F.max("text_sha256").alias("text_sha256"),
        F.sum("n").alias("n"),
        parts.alias("parts"),
    )
    return whole.select("uid", "doc_id", "raw", "n_points", "text_sha256", "n", *[combined(F.col("parts"), p, k).alias(f"f{k}") for k, p in enumerate(hasher.primes)])


def _cut_rows(hasher: Hasher):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "raw", "n", "f0", "f1"]
        for batch in batches:
            for k, cell in enumerate(utf8_cells(batch.column("text"))):
                bare = bytes(cell).translate(None, BLANKS.encode())
                chunks = list(hasher.chunks(bare))
                same = [pa.repeat(batch.column(name)[k], len(chunks)) for name in names]
                yield pa.RecordBatch.from_arrays([*same, pa.array(range(len(chunks)), pa.int32()), pa.array(chunks, pa.binary())], names=[*names, "no", "chunk"])

    return rows


KEY = ["n", "f0", "f1"]


def _verified(docs: DataFrame, rows: DataFrame, hasher: Hasher) -> DataFrame:
    """(doc_id, raw, n, f0, f1, round): texts that differ from the leader of their fingerprint.

    Texts of fingerprints that occur more than once are compared with one leader text each, chunk by
    chunk in a join, so a hot fingerprint costs one comparison per row and its rows may be dealt to
    many tasks. Those that differ get a leader of their own in the next round, until none differ.
    """
    texts = rows.select("doc_id", "raw", *KEY).distinct()
    several = texts.groupBy(*KEY).agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").drop("texts")
    members = texts.join(several, KEY).select(F.col("doc_id").alias("_id"), F.col("raw").alias("_raw"), *KEY)
    # Equal rows hold equal texts: one of them is compared.
    own = _keyed(docs).join(members, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("raw") == F.col("_raw"))).drop("_id", "_raw")
    left = landed(own.mapInArrow(_cut_rows(hasher), "doc_id long, raw long, n long, f0 long, f1 long, no int, chunk binary"), "dedup-chunks")
    spark, split, k = docs.sparkSession, None, 0
    while True:
        leads = left.groupBy(*KEY).agg(F.min(F.struct("raw", "doc_id")).alias("lead")).select(*[F.col(c).alias(f"_{c}") for c in KEY], F.col("lead.raw").alias("_raw"), F.col("lead.doc_id").alias("_id"))
        first = left.join(leads, (F.col("raw") == F.col("_raw")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("n") == F.col("_n")) & (F.col("f0") == F.col("_f0")) & (F.col("f1") == F.col("_f1")))
        first = first.select(*KEY, "no", F.col("chunk").alias("other")).dropDuplicates([*KEY, "no"])
        differ = left.join(first, [*KEY, "no"]).filter(F.col("chunk") != F.col("other")).select("doc_id", "raw", *KEY).distinct()
        k += 1
        differ = landed(differ.withColumn("round", F.lit(k)), "dedup-differing")
        split = differ if split is None else split.unionByName(differ)
        if differ.isEmpty():
            forget(left)
            return split
        again = differ.select(F.col("doc_id").alias("_id"), F.col("raw").alias("_raw"))
        before, left = left, landed(left.join(again, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("raw") == F.col("_raw")), "left_semi"), "dedup-chunks")
        forget(before)


def exact_duplicates(docs: DataFrame, hasher: Hasher | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, text_key.

    Texts are equal when identical without blanks; NULL counts as empty, and all empty texts are
    equal. Of equal texts the row with the most code points stays, then the smallest doc_id (NULL
    last); of rows that repeat with the same doc_id one is marked as kept. Equal fingerprints only
    nominate: their texts are compared whole. text_key is a hash of the text as it is. Other columns are not read; an empty table gives no
    rows.
    """
    hasher = hasher or Hasher()
    with small_batches(docs.sparkSession):
        rows = landed(fingerprints(docs, hasher), "dedup-fingerprints")
        split = _verified(docs, rows, hasher)
    split = split.groupBy("doc_id", "raw").agg(F.max("round").alias("round"))
    split = split.select(F.col("doc_id").alias("_id"), F.col("raw").alias("_raw"), "round")
    classed = rows.join(split, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("raw") == F.col("_raw")), "left").withColumn("round", F.coalesce("round", F.lit(0)))
    best = F.min(F.struct((-F.col("n_points")).alias("least"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("uid").alias("uid")))
    groups = classed.groupBy(*KEY, "round").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    return classed.join(groups, [*KEY, "round"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("uid") == F.col("best.uid")).alias("kept"), "text_sha256", F.col("raw").alias("text_key")
    )
