"""Shared helpers: tables in the working folder, and words of whole Arrow batches as arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom.session import work_dir
from tickerloom.sources import files

#: Bytes of text that the array code handles at once, so that memory does not follow the text.
BLOCK = 1 << 20

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes between words where punctuation doesn't count: ASCII other than letters and digits.
MARKS = np.array([k < 128 and not chr(k).isalnum() for k in range(256)])
_UPPER = np.arange(256)
_UPPER[ord("A") : ord("Z") + 1] += 32
_LETTER = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = _LETTER[_UPPER]
_BASE = 0x9E3779B97F4A7C15
_ONE = np.uint64(1)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder that all executors share, and read back: a cut in the lineage."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where a column of the frame already bears one, in any letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def dropped(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` wrote; nothing that still has to be computed may read them."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            files.delete(table.sparkSession, folder)


def small_batches(spark: SparkSession) -> None:
    """Let rows go to Python in batches of bounded size, however long their texts are.

    The setting stays on the session, as plans run after they are made; it changes no result.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20))


def parallelism(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session sets them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def few_of_each(df: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """The ``n`` rows of each group with the smallest ``key``, a column of 64-bit hashes.

    Rows above a bound that the groups' sizes give go first, so that what is ranked does not
    grow with the table. A group whose rows share few hashes may get fewer rows.
    """
    bounds = []
    for row in df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).collect():
        part = min(1.0, 4 * n / row["n"])
        bounds.append((F.col(group) == F.lit(row[group])) & (F.shiftrightunsigned(key, 1) <= min(int(part * (1 << 62)) * 2, (1 << 63) - 1)))
    if not bounds:
        return df
    some = df.where(reduce(or_, bounds)).dropDuplicates([group, key])
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.shiftrightunsigned(key, 1), key))
    return some.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as they were needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (
                np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, base, np.uint64))])
                for base in (_BASE, pow(_BASE, -1, 1 << 64))
            )
        return self.up[:n], self.down[:n]


POWERS = _Powers()


def text_pieces(batch: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``limit`` bytes: first row, end row, their bytes, their offsets.

    A null counts as an empty text. A text longer than the limit makes a run of its own.
    """
    whole = pc.fill_null(batch.cast(pa.large_binary()), b"")
    if isinstance(whole, pa.ChunkedArray):
        whole = whole.combine_chunks()
    if not len(whole):
        return
    _, offsets, data = whole.buffers()
    offsets = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(whole):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of every word, a run of bytes that are not ``between`` words."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~between[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | cut))
    ends = np.flatnonzero(before & (~inside | cut))
    return starts, ends


def word_hashes(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, A-Z lower-cased, and for each text the place of its first word.

    The hash is a polynomial over random values of the bytes, taken from running sums, so no
    word is looked at by itself. Long runs are cut into blocks at ends of words.
    """
    starts, ends = word_spans(data, offsets, between)
    places = np.searchsorted(starts, offsets).astype(np.int64)
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK, "right")))
        low, high = int(starts[at]), int(ends[to - 1])
        up, down = POWERS.to(max(high - low, min(BLOCK, len(data))))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE[data[low:high]] * up[: high - low], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out, places


_PLACE = mixed(np.arange(1, 65, dtype=np.uint64)) | _ONE


def shingles(hashes: np.ndarray, places: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words.

    A text with fewer words has one, of all its words; a text without words has none.
    """
    n = len(hashes)
    if n >= width:
        rolled = np.zeros(n - width + 1, np.uint64)
        for j in range(width):
            rolled += hashes[j : n - width + 1 + j] * _PLACE[j]
        rolled = mixed(rolled)
    out = []
    for first, end in zip(places[:-1].tolist(), places[1:].tolist()):
        if end - first >= width:
            run = np.sort(rolled[first : end - width + 1])
            keep = np.empty(len(run), bool)
            keep[0] = True
            np.not_equal(run[1:], run[:-1], out=keep[1:])
            out.append(run[keep])
        elif end > first:
            short = (hashes[first:end] * _PLACE[: end - first]).sum(dtype=np.uint64, keepdims=True)
            out.append(mixed(short + _PLACE[-1:] * np.uint64(end - first)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


#: Bits of a bitmap of ids: 2 MB, whatever the number of ids.
BITS = 1 << 24


def _bits(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bit = mixed(ids.astype(np.int64).view(np.uint64)) % np.uint64(BITS)
    return bit >> np.uint64(6), bit & np.uint64(63)


def bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size in which the bits of all ids (one long column) are set.

    It lets rows go early that are not among the ids; a join must follow, as others may pass.
    """

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(BITS // 64, np.uint64)
        for batch in batches:
            word, bit = _bits(batch.column(0).to_numpy())
            np.bitwise_or.at(words, word, _ONE << bit)
        some = np.flatnonzero(words)
        yield pa.RecordBatch.from_pydict({"word": some, "bits": words[some].view(np.int64)})

    out = np.zeros(BITS // 64, np.int64)
    found = ids.mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def in_bitmap(ids: np.ndarray, words: np.ndarray) -> np.ndarray:
    word, bit = _bits(ids)
    return (words[word] >> bit) & _ONE == 1
