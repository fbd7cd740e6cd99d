"""URL filter over a sorted array of 64-bit digests.

The entries (a host, or a host and the start of a path) are sorted by the xxhash of their
text and written to the shared folder in files of consecutive digests. Every executor fetches
them once and maps digests, text offsets and texts into memory, so that its workers share the
pages and none holds the array. A URL is looked up under its host and all parent domains,
alone and with the starts of its path that entries have, by binary search of whole batches of
digests at once; the stored text of every hit is compared, so that equal digests of different
texts change nothing. URLs are never shuffled.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Seed of the digests, the one that Spark's ``xxhash64`` has.
SEED = 42
#: Entries in a file on average.
SHARD = 2_000_000
ALLOW, BLOCK = "allow", "block"


def digests(texts: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t, SEED) for t in texts), np.uint64, len(texts)).view(np.int64)


class Shard:
    """A file of entries, as arrays that are mapped from the executor's own copy."""

    def __init__(self, name: str) -> None:
        base = os.path.join(SparkFiles.getRootDirectory(), name)
        if not os.path.exists(base + ".texts.npy"):
            table = pq.read_table(SparkFiles.get(name), columns=["digest", "entry", "blocks", "rule"])
            texts = [t.encode() for t in table.column("entry").to_pylist()]
            arrays = {
                "digests": table.column("digest").to_numpy().astype(np.int64),
                "edges": np.cumsum([0, *map(len, texts)]),
                "kinds": np.array(table.column("blocks").to_pylist(), np.uint8) + 2 * np.array(table.column("rule").to_pylist(), np.uint8),
                "texts": np.frombuffer(b"".join(texts), np.uint8),  # last: its file says that all are there
            }
            for part, array in arrays.items():
                own = f"{base}.{uuid.uuid4().hex}.npy"
                np.save(own, array)
                os.replace(own, f"{base}.{part}.npy")
        self.digests, self.edges, self.kinds, self.texts = (self._map(f"{base}.{part}.npy") for part in ("digests", "edges", "kinds", "texts"))

    @staticmethod
    def _map(path: str) -> np.ndarray:
        return np.load(path, mmap_mode="r") if os.path.getsize(path) > 128 else np.load(path)

    def find(self, probes: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """For each probe the kind of the entry with its text, or -1."""
        out = np.full(len(probes), -1)
        at = np.searchsorted(self.digests, probes, "left")
        live = np.flatnonzero(at < len(self.digests))
        live = live[self.digests[at[live]] == probes[live]]
        while len(live):
            missed = []
            for k in live.tolist():
                p = at[k]
                if self.texts[self.edges[p] : self.edges[p + 1]].tobytes() == texts[k]:
                    out[k] = self.kinds[p]
                else:
                    missed.append(k)
            # another text with the same digest: try the next entry
            live = np.array(missed, np.int64)
            at[live] += 1
            live = live[at[live] < len(self.digests)]
            live = live[self.digests[at[live]] == probes[live]]
        return out


_OPEN: dict[str, Shard] = {}


def _shard(name: str) -> Shard:
    if name not in _OPEN:
        _OPEN[name] = Shard(name)
    return _OPEN[name]


def url_parts(url) -> tuple:
    """Host and path columns: what follows the first ``://``, A-Z of the host lower-cased."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), part(2)


class UrlFilter:
    """Entries in files of sorted digests, and the lengths that their paths have."""

    def __init__(self, entries: DataFrame) -> None:
        """``entries`` has ``entry`` (``host`` or ``host/path``), ``verdict`` and ``rule``.

        Of entries with one text, a rule counts before others, and ``allow`` before ``block``.
        Null entries are left out.
        """
        spark = entries.sparkSession
        rows = entries.where("entry is not null").groupBy("entry").agg(F.max(F.struct("rule", (F.col("verdict") == ALLOW).alias("allows"))).alias("m"))
        rows = stored(rows.select(F.xxhash64("entry").alias("digest"), "entry", (~F.col("m.allows")).alias("blocks"), F.col("m.rule").alias("rule")), "url-entries")
        cut = F.when(F.instr("entry", "/") == 0, 0).otherwise(F.length("entry") - F.instr("entry", "/") + 1)
        self.lengths = sorted(r[0] for r in rows.select(cut.alias("n")).distinct().collect())
        shards = max(1, rows.count() // SHARD)
        ranged = stored(rows.repartitionByRange(shards, "digest").sortWithinPartitions("digest", "entry"), "url-digests")
        self.files = sorted(ranged.inputFiles())
        for file in self.files:
            spark.sparkContext.addFile(file)
        self.names = [file.rsplit("/", 1)[-1] for file in self.files]

    def judge(self, pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
        """(id, host, path, rule, verdict, listed) of every row.

        An entry fits its host and all subdomains, if the path starts with the entry's. Of the
        rules that fit, the longest decides; without one, the row is blocked if any other entry
        fits that blocks, and ``listed`` is the longest such entry. A null url, or one without
        ``://``, has an empty host and path and is allowed. Repeated rows are each judged.
        """
        host, path = url_parts(F.col(url_col))
        rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
        lengths, names = self.lengths, self.names

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, owner = [], []
                for k, (h, p) in enumerate(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())):
                    parts = h.split(".") if h else []
                    for j in range(len(parts)):
                        domain = ".".join(parts[j:])
                        for n in lengths:
                            if n <= len(p):
                                texts.append((domain + p[:n]).encode())
                                owner.append(k)
                probes = digests(texts)
                kind = np.full(len(texts), -1)
                for name in names:
                    kind = np.maximum(kind, _shard(name).find(probes, texts))
                rule, verdict, listed = [None] * batch.num_rows, [ALLOW] * batch.num_rows, [None] * batch.num_rows
                for x in np.flatnonzero(kind >= 0).tolist():
                    k, text = owner[x], texts[x].decode()
                    best = rule if kind[x] >= 2 else listed
                    if kind[x] > 0 and len(text) > len(best[k] or ""):
                        best[k] = text
                        if kind[x] >= 2:
                            verdict[k] = BLOCK if kind[x] == 3 else ALLOW
                verdict = [v if r is not None else BLOCK if x is not None else ALLOW for v, r, x in zip(verdict, rule, listed)]
                columns = [batch.column("id"), batch.column("host"), batch.column("path"), pa.array(rule, pa.string()), pa.array(verdict, pa.string()), pa.array(listed, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "host", "path", "rule", "verdict", "listed"])

        kind = rows.schema["id"].dataType.simpleString()
        return rows.mapInArrow(run, f"id {kind}, host string, path string, rule string, verdict string, listed string").withColumnRenamed("id", id_col)


def labelled_domains(pages: DataFrame, labels: list[str], url_col: str = "url") -> DataFrame:
    """Entries that block every domain of ``pages`` whose first label is one of ``labels``."""
    host, _ = url_parts(F.col(url_col))
    parts = pages.select(F.split(host, r"\.").alias("parts")).distinct()
    found = parts.select(F.posexplode("parts").alias("at", "label"), "parts").where(F.col("label").isin(labels))
    entry = F.array_join(F.slice("parts", F.col("at") + 1, F.size("parts")), ".")
    return found.select(entry.alias("entry")).distinct().select("entry", F.lit(BLOCK).alias("verdict"), F.lit(False).alias("rule"))
