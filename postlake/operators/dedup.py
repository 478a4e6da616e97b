"""Messages delivered more than once: one copy of each identifier.

The operator keeps an index of identifiers in the shared folder: immutable runs of sorted arrays in
files by hash prefix, and a manifest of the runs that count. A batch is deduplicated locally, its identifiers are
binary-searched in the stored arrays of the prefixes it touches, what is new or better becomes a
further run, and runs are merged every few batches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.session import file_system, materialise, remove, scratch_path

#: White space and brackets that may surround an identifier.
_EDGE = r"[\s\u00a0\u200b\ufeff<>\[\](){}]+"
_LATEST = np.iinfo(np.int64).max
#: A row holds sorted identifiers of one prefix, as arrays of 16 and 8 bytes.
RUN_SCHEMA = "shard int, chunk int, n int, keys binary, first_us binary, nids binary"
#: Parts in which the batches of a table enter an index, in their order.
WAVES = 4


def canonical_id(raw: Column) -> Column:
    """An identifier without surrounding spaces and brackets, lower case after the first ``@``.

    NULL, blank and empty-bracket values give NULL: they are no identifiers.
    """
    bare = F.regexp_replace(F.regexp_replace(raw, "^" + _EDGE, ""), _EDGE + "$", "")
    at = F.instr(bare, "@")
    low = F.lower(bare)
    whole = F.when(at > 0, F.concat(F.substring(bare, F.lit(1), at), F.substring(low, at + 1, F.length(bare)))).otherwise(bare)
    return F.when(F.length(bare) > 0, whole)


Arrays = tuple[np.ndarray, np.ndarray, np.ndarray]


def _best(keys: np.ndarray, when: np.ndarray, nid: np.ndarray) -> Arrays:
    """Sorted by key, and of equal keys only the earliest delivery, then the smallest nid."""
    order = np.lexsort((nid, when, keys))
    keys, when, nid = keys[order], when[order], nid[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return keys[first], when[first], nid[first]


def _novel(batch: Arrays, run: Arrays) -> np.ndarray:
    """Which of a batch a sorted run does not hold, or holds only with a later copy: a binary search."""
    (keys, when, nid), (rk, rw, rn) = batch, run
    keep = np.ones(len(keys), bool)
    at = np.searchsorted(rk, keys)
    inside = np.flatnonzero(at < len(rk))
    hit = inside[rk[at[inside]] == keys[inside]]
    i = at[hit]
    keep[hit] = (when[hit] < rw[i]) | ((when[hit] == rw[i]) & (nid[hit] < rn[i]))
    return keep


def _unpack(row: tuple) -> Arrays:
    return np.frombuffer(row.keys, "S16"), np.frombuffer(row.first_us, "<i8"), np.frombuffer(row.nids, "<i8")


def _prefix(keys: np.ndarray, bits: int) -> np.ndarray:
    """The first bits of each key."""
    return (keys.astype("S16").view(np.uint8).reshape(-1, 16)[:, :4].copy().view(">u4").ravel().astype(np.int64)) >> (32 - bits)


def _rows(arrays: Arrays, bits: int, chunk: int) -> pd.DataFrame:
    """Stored rows of sorted arrays: cut where the prefix changes, and every ``chunk`` identifiers."""
    keys, when, nid = arrays
    shard = _prefix(keys, bits)
    cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(keys)] if len(keys) else [0]
    spans = [(i, min(i + chunk, b)) for a, b in zip(cuts, cuts[1:]) for i in range(a, b, chunk)]
    return pd.DataFrame(
        {
            "shard": [int(shard[a]) for a, _ in spans], "chunk": range(len(spans)), "n": [b - a for a, b in spans], "keys": [keys[a:b].astype("S16").tobytes() for a, b in spans],
            "first_us": [when[a:b].astype("<i8").tobytes() for a, b in spans], "nids": [nid[a:b].astype("<i8").tobytes() for a, b in spans],
        }
    )


def _join(parts: list[Arrays]) -> Arrays:
    none = np.empty(0, "S16"), np.empty(0, "i8"), np.empty(0, "i8")
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else none


class IdentifierIndex:
    """Identifiers seen so far, persisted at ``path`` in the shared folder; an index that is there is reopened.

    ``per_shard``: identifiers of a prefix; prefixes grow by a bit as the index does, and what is stored under
    shorter ones is cut as it is read. ``chunk``: identifiers of a stored row, so that no row grows with the
    data; ``merge_every``: runs before they are merged. A run is never rewritten: the manifest names
    those that count, the last is valid, and a merge removes what it took in. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, per_shard: int = 200_000, chunk: int = 50_000, merge_every: int = 4, least_bits: int = 3):
        self.spark, self.path = spark, path or scratch_path(spark, "ids")
        self.per_shard, self.chunk, self.merge_every, self.least_bits = per_shard, chunk, merge_every, least_bits
        self.state = self._manifest() or {"version": 0, "runs": []}

    def _manifest(self) -> dict | None:
        fs, at = file_system(self.spark, self.path)
        if not fs.exists(at):
            return None
        names = sorted(x.getPath().getName() for x in fs.listStatus(at) if x.getPath().getName().startswith("manifest-"))
        if not names:
            return None
        stream = fs.open(at.suffix(f"/{names[-1]}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, runs: list[dict]) -> None:
        self.state = {"version": self.state["version"] + 1, "runs": runs}
        fs, at = file_system(self.spark, self.path)
        made, final = at.suffix("/.manifest"), at.suffix(f"/manifest-{self.state['version']:08d}.json")
        stream = fs.create(made, True)
        stream.writeBytes(json.dumps(self.state))
        stream.close()
        fs.rename(made, final)

    @property
    def size(self) -> int:
        """Stored entries at most: what a merge counted, and all identifiers of the batches since."""
        return sum(r["n"] for r in self.state["runs"])

    def _bits(self, size: int) -> int:
        return max(self.least_bits, (-(-size // self.per_shard) - 1).bit_length(), *[r["bits"] for r in self.state["runs"]]) if self.state["runs"] else max(self.least_bits, (-(-size // self.per_shard) - 1).bit_length())

    def stored(self, bits: int) -> DataFrame:
        """Rows of all runs that count, under prefixes of ``bits``."""
        out, chunk = None, self.chunk

        def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in parts:
                for row in pdf.itertuples():
                    yield _rows(_unpack(row), bits, chunk)

        for r in self.state["runs"]:
            rows = self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.path}/{r['name']}")
            rows = rows.select("shard", "chunk", "n", "keys", "first_us", "nids") if r["bits"] == bits else rows.mapInPandas(cut, RUN_SCHEMA)
            out = rows if out is None else out.unionByName(rows)
        return out

    def _write(self, rows: DataFrame, bits: int, n: int | None = None) -> dict:
        """A run; ``n`` is the most entries it may have, without it they are counted."""
        name = f"run-{self.state['version']:08d}"
        rows.write.option("compression", "zstd").partitionBy("shard").parquet(f"{self.path}/{name}")
        if n is None:
            n = self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.path}/{name}").agg(F.sum("n")).first()[0] or 0
        return {"name": name, "bits": bits, "n": n}

    def ingest(self, rows: DataFrame) -> None:
        """Take in rows (ident, delivered_us, nid).

        Rows without identifier are ignored. Copies within the rows are combined before the shuffle, so one identifier
        costs at most a row a task. Of the stored files only those of prefixes that the rows touch are read.
        """
        key = F.unhex(F.md5(F.col("ident").cast("binary")))
        local = rows.where(F.col("ident").isNotNull()).select(key.alias("key"), F.coalesce("delivered_us", F.lit(_LATEST)).alias("w"), "nid").groupBy("key").agg(F.min(F.struct("w", "nid")).alias("m"))
        local = materialise(local.select("key", F.col("m.w").alias("w"), F.col("m.nid").alias("nid")), "batch")
        n = local.count()
        if not n:
            return
        bits, chunk = self._bits(self.size + n), self.chunk
        first = F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long")
        local = local.withColumn("shard", F.shiftright(first, 32 - bits).cast("int"))
        arrays = lambda pdf: _best(np.array(list(pdf["key"]), "S16"), pdf["w"].to_numpy("int64"), pdf["nid"].to_numpy("int64")) if len(pdf) else _join([])

        def probe(batch: pd.DataFrame, runs: pd.DataFrame) -> pd.DataFrame:
            found = arrays(batch)
            for row in runs.itertuples():
                keep = _novel(found, _unpack(row))
                found = tuple(x[keep] for x in found)
            return _rows(found, bits, chunk)

        stored = self.stored(bits)
        if stored is None:
            made = local.groupBy("shard").applyInPandas(lambda pdf: _rows(arrays(pdf), bits, chunk), RUN_SCHEMA)
        else:
            # One row a prefix: those that are not touched are not read.
            touched = F.broadcast(local.select("shard").distinct())
            made = local.groupBy("shard").cogroup(stored.join(touched, "shard", "left_semi").groupBy("shard")).applyInPandas(probe, RUN_SCHEMA)
        self._commit([*self.state["runs"], self._write(made, bits, n)])
        if len(self.state["runs"]) > self.merge_every:
            self.merge()

    def merge(self) -> None:
        """All runs into one, in which each identifier has its best copy."""
        old = self.state["runs"]
        if len(old) < 2:
            return
        bits, chunk = self._bits(self.size), self.chunk

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            return _rows(_best(*_join([_unpack(row) for row in pdf.itertuples()])), bits, chunk)

        self.state["version"] += 1
        made = self._write(self.stored(bits).groupBy("shard").applyInPandas(run, RUN_SCHEMA), bits)
        self._commit([made])
        for r in old:
            remove(self.spark, f"{self.path}/{r['name']}")

    def kept(self) -> DataFrame:
        """(nid): the copy of each identifier that stays."""
        self.merge()

        def nids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                whole = b"".join(b.column("nids").to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(whole, "<i8"))], ["nid"])

        if not self.state["runs"]:
            return self.spark.createDataFrame([], "nid long")
        return self.stored(self.state["runs"][0]["bits"]).select("nids").mapInArrow(nids, "nid long")


def message_keys(messages: DataFrame, bodies: DataFrame) -> DataFrame:
    """nid, delivered_us, batch_id and canonical identifier of each message."""
    ids = bodies.select("nid", canonical_id(F.col("internet_message_id")).alias("ident"))
    return messages.select("nid", "delivered_us", "batch_id").join(ids, "nid")


def further_copies(messages: DataFrame, bodies: DataFrame, index: IdentifierIndex | None = None, waves: int = WAVES) -> DataFrame:
    """(nid) of every row that repeats another row's identifier and is not the copy to keep.

    The earliest ``delivered_us`` stays (NULL counts as latest), then the smallest nid. Rows without
    identifier are never returned. The batches enter the index in their order (NULL first), in at most ``waves`` parts,
    each probing what the parts before have stored. Empty input gives no rows; other columns are ignored.
    """
    keys = materialise(message_keys(messages, bodies).where(F.col("ident").isNotNull()), "keys")
    index = index or IdentifierIndex(messages.sparkSession)
    batch = F.coalesce(F.col("batch_id"), F.lit(-1))
    # A number a batch, whatever its rows: as many as there were deliveries.
    order = [r[0] for r in keys.select(batch.alias("b")).distinct().orderBy("b").collect()]
    step = max(1, -(-len(order) // waves))
    for part in (order[i : i + step] for i in range(0, len(order), step)):
        index.ingest(keys.where(batch.between(part[0], part[-1])))
    return keys.select("nid").join(index.kept(), "nid", "left_anti")


def deduplicated(messages: DataFrame, bodies: DataFrame) -> DataFrame:
    """The messages without their further copies."""
    return messages.join(further_copies(messages, bodies), "nid", "left_anti")

