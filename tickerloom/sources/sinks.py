"""Writing tables: append, partition replacement, upsert, layout, backfill, profiles."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import date, timedelta
from functools import reduce
from zlib import crc32

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyed import first_of_few, latest, merged, split_by_age
from . import files, versions


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The frame with a row count taken while it is written, without a second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), json_columns: Sequence[str] = ()) -> int:
    """Append rows, structs in ``json_columns`` as JSON text; returns how many were written."""
    df = df.withColumns({c: F.to_json(c) for c in json_columns})
    df, seen = counted(df)
    df.write.mode("append").partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def write_run(df: DataFrame, path: str, run: str) -> int:
    """Append-only history by run: a run's rows in their own folder, which the same run replaces."""
    df, seen = counted(df)
    # written once and seldom read: small rather than fast
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/run={run}")
    return seen.get["rows"]


def laid_out(
    df: DataFrame, cluster: Sequence[str], sort: Sequence[str], spread: int = 1, partitions: int | None = None
) -> DataFrame:
    """Rows that share ``cluster`` in the same files, sorted for min/max pruning.

    ``spread`` divides each cluster key over that many tasks, by a hash of the sort
    columns, for keys too large for one. Without ``partitions`` their number follows the
    data's size at run time.
    """
    keys = [F.col(c) for c in cluster]
    if spread > 1:
        keys.append(F.pmod(F.xxhash64(*sort), F.lit(spread)))
    spread_out = df.repartition(partitions, *keys) if partitions else df.repartition(*keys)
    return spread_out.sortWithinPartitions(*cluster, *sort)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], batch: tuple[str, int] | None = None, note: tuple[str, int] | None = None
) -> list[tuple[str, str]]:
    """Overwrite the partitions that occur in ``df`` and leave the others, in one version.

    The rows are written once, to a folder of their own; the manifest that names it appears last
    (see ``versions``). A failure at any point leaves the table as it was. The feed of changes has
    all rows as changed, or those that ``df`` marks in the column ``_action``. A ``batch`` is
    written once, see ``upsert_table``; a ``note`` is only kept with the version. Returns the
    partitions written with their folder.
    """
    spark = df.sparkSession
    known = versions.newest(spark, path)
    if versions.written(known, batch):
        return []
    columns = T.StructType([f for f in df.schema.fields if f.name != versions.ACTION])
    folder, partitions = versions.write(df, path, partition_by)
    if partitions or batch or note or known is versions.NOTHING:
        versions.publish(spark, path, known, columns, folder, partitions, batch or note)
    return [(p, folder) for p in partitions]


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table of versions as it is now; later writes don't change what the frame reads."""
    return versions.read(spark, path, schema)


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    spark.read.parquet(source).write.mode("errorifexists").parquet(target)


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    order: Sequence,
    update: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    contest: bool = False,
    batch: tuple[str, int] | None = None,
    near: DataFrame | None = None,
    unique: bool = False,
) -> dict[str, int]:
    """Upsert into a partitioned table, reading and rewriting only the partitions touched.

    ``partition_by`` must follow from ``keys``, so a row never changes partition. The source's
    partitions, a short list, tell which folders of the table are read. The merged rows are written
    once; partitions in which no row differs keep their folders, and the others are switched
    together (see ``versions``). After a failure at any point, running the same upsert again gives
    the same table, and consumers of its changes get each of them. ``schema`` is needed for a new table.

    With ``contest`` a stored row stays if it comes first in ``order``. A ``batch``, a writer's name
    and a rising number, is written once however often it is repeated.

    ``near`` has the ``partition_by`` columns and rows in all of the source's partitions, maybe in
    more. Where it is cheap to read it tells the partitions in place of the source, which is then
    made once and not kept for a second look. ``unique`` says that the source's keys hardly ever repeat.
    """
    known = versions.newest(spark, path)
    if versions.written(known, batch):
        return {"inserted": 0, "updated": 0, "unchanged": 0}
    columns = schema or known.columns
    source = source.select(*[F.col(c).cast(columns[c].dataType).alias(c) for c in source.columns])
    coming = first_of_few(source, keys, order) if unique else latest(source, keys, order)
    keep = bool(known.folders) and near is None
    if keep:
        # used for the list of partitions and for the merge; a lost part is computed again
        coming = coming.persist()
    try:
        touched = versions.stored_as(known, versions.partition_names(coming if near is None else near, partition_by)) if known.folders else []
        affected = versions.frame(spark, path, columns, known.pairs(touched))
        winners = coming
        if contest and touched:
            both = affected.select(*source.columns, F.lit(False).alias("_new")).unionByName(coming.withColumn("_new", F.lit(True)))
            winners = latest(both, keys, [*order, "_new"]).where("_new").drop("_new")
        folder, partitions = versions.write(merged(affected, winners, keys, update, action=versions.ACTION), path, partition_by)
    finally:
        if keep:
            coming.unpersist()

    done = versions.frame(spark, path, T.StructType([*columns.fields, T.StructField(versions.ACTION, T.StringType())]), [(p, folder) for p in partitions])
    by = [F.col(c).cast("string") for c in partition_by]
    # as many rows as there are partitions and actions
    counts, differing = dict.fromkeys("IUN", 0), set()
    for row in done.groupBy(*by, versions.ACTION).agg(F.count(F.lit(1)).alias("rows")).collect():
        *values, action, rows = row
        counts[action] += rows
        if action != "N":
            differing.add(versions.partition_name(dict(zip(partition_by, values))))
    fresh = versions.Version(0, {}, dict.fromkeys(partitions, folder))
    changed = versions.stored_as(fresh, differing)
    for p in set(partitions) - set(changed):
        files.delete(spark, f"{path}/{versions.DATA}/{folder}/{p}")
    if changed or batch:
        versions.publish(spark, path, known, columns, folder, changed, batch)
    return {"inserted": counts["I"], "updated": counts["U"], "unchanged": counts["N"]}


def combine_into(
    spark: SparkSession, path: str, partial: DataFrame, keys: Sequence[str], partition_by: Sequence[str],
    states: Mapping[str, Column], batch: tuple[str, int] | None = None, near: DataFrame | None = None,
) -> None:
    """Merge partial states into a stored table that has one row per key.

    ``states`` gives for each other column the aggregate that merges it, such as a sum of sums or
    the price at the first time; it must not matter in which order or in how many parts states
    are merged. Only the partitions that ``partial`` touches are read and written, so the table
    keeps the size of its keys however many batches come. ``partition_by`` is part of the keys.
    ``near`` as in ``upsert_table``.
    """
    known = versions.newest(spark, path)
    if versions.written(known, batch):
        return
    columns = known.columns
    partial = partial.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns.fields])
    keep = bool(known.folders) and near is None
    if keep:
        # for the list of partitions and for the merge; a lost part is computed again
        partial = partial.persist()
    try:
        touched = versions.stored_as(known, versions.partition_names(partial if near is None else near, partition_by)) if known.folders else []
        stored = versions.frame(spark, path, columns, known.pairs(touched)).withColumn("_came", F.lit(False))
        # few rows share a key: they are dealt out once and not sorted and combined before
        both = stored.unionByName(partial.withColumn("_came", F.lit(True))).repartition(*[F.col(c) for c in keys])
        rows = both.groupBy(*keys).agg(*[e.alias(c) for c, e in states.items()], F.max("_came").alias("_came"))
        rows = rows.withColumn(versions.ACTION, F.when(F.col("_came"), "U").otherwise("N")).select(*columns.names, versions.ACTION)
        replace_partitions(rows, path, partition_by, batch)
    finally:
        if keep:
            partial.unpersist()


def create_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty table of versions, unless there is one."""
    versions.create(spark, path, schema)


def date_slices(start: date, end: date, days: int = 90) -> Iterator[tuple[date, date]]:
    """Inclusive slices that cover ``start`` to ``end`` without overlap."""
    while start <= end:
        stop = min(start + timedelta(days=days - 1), end)
        yield start, stop
        start = stop + timedelta(days=1)


def backfill(
    build: Callable[[date, date], DataFrame],
    start: date,
    end: date,
    path: str,
    partition_by: Sequence[str],
    days: int = 90,
    position: Callable[[date, date], int] | None = None,
) -> int:
    """Build and write slice by slice; returns the rows written.

    Slices bound the work of one job. Where that is not needed, one slice over the whole
    range is faster. ``partition_by`` must not be coarser than a slice. A slice that was
    interrupted is left out as a whole, see ``replace_partitions``.

    ``position`` tells for a slice where its input stands, such as ``input_position``. The table's
    ledger then has the position of each slice written, in the same step as its rows: run again,
    the backfill does the slices that are open and those whose input has changed. Without it all
    slices are written each time.
    """
    total = 0
    for low, high in date_slices(start, end, days):
        at = None if position is None else position(low, high)
        entry = f"slice {low} {high}"
        df = build(low, high)
        if at is not None and versions.newest(df.sparkSession, path).batches.get(entry) == at:
            continue
        pairs = replace_partitions(df, path, partition_by, note=None if at is None else (entry, at))
        # the files' footers tell
        total += versions.frame(df.sparkSession, path, df.schema, pairs).count()
    return total


def input_position(spark: SparkSession, path: str, within: Callable[[str], bool]) -> int:
    """A number that changes when the partitions of a table that ``within`` names are rewritten."""
    pairs = sorted((p, f) for p, f in versions.newest(spark, path).folders.items() if within(p))
    return crc32(repr(pairs).encode())


# ---- layout ------------------------------------------------------------------------------

def _place(value: Column, bounds: Sequence, first: int = 0) -> Column:
    """``first`` and how many of the sorted bounds a value reaches, none if it is NULL: each row compares
    it with as many as halving takes."""
    if not bounds:
        return F.lit(first).cast("long")
    k = len(bounds) // 2
    return F.when(value >= F.lit(bounds[k]), _place(value, bounds[k + 1 :], first + k + 1)).otherwise(_place(value, bounds[:k], first))


def interleaved(df: DataFrame, keys: Sequence[str], name: str, bits: int = 6) -> DataFrame:
    """``df`` with a sort key in which the keys' places take turns bit by bit, so that rows near in
    it are near in every key. A key's place is its bucket among ``2**bits`` of about equal size,
    whose bounds are approximate quantiles: one pass, and one row of bounds for the driver. Numbers,
    dates and times only; NULL has the first place."""

    def number(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, T.DateType):
            return F.unix_date(c)
        return F.unix_micros(F.col(c).cast("timestamp")) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else F.col(c).cast("double")

    shares = [k / 2**bits for k in range(1, 2**bits)]
    bounds = df.agg(*[F.percentile_approx(number(c), shares, 1000).alias(c) for c in keys]).first()
    places = {}
    for j, c in enumerate(keys):
        places[f"{name}_{j}"] = _place(number(c), sorted(set(bounds[c] or [])))
    bit = [
        F.shiftleft(F.shiftright(f"{name}_{j}", k).bitwiseAND(1), k * len(keys) + j)
        for j in range(len(keys))
        for k in range(bits)
    ]
    return df.withColumns(places).withColumn(name, reduce(lambda a, b: a + b, bit)).drop(*places)


def cluster_table(
    spark: SparkSession, path: str, partition_by: Sequence[str], keys: Sequence[str], files_each: int, partitions: Sequence[str] | None = None
) -> int:
    """Rewrite partitions so that a read of few values of any key opens few of their files.

    Each partition is cut into about ``files_each`` files by ranges of the ``interleaved`` keys;
    the others stay. The rows don't change, and consumers of changes see none. Returns the number of
    partitions rewritten.
    """
    known = versions.newest(spark, path)
    names = list(known.folders) if partitions is None else [p for p in partitions if p in known.folders]
    if not names:
        return 0
    rows = interleaved(versions.frame(spark, path, known.columns, known.pairs(names)), keys, "_place")
    parts = [F.col(c) for c in partition_by]
    laid = rows.withColumn(versions.ACTION, F.lit("N")).repartitionByRange(files_each * len(names), *parts, "_place")
    laid = laid.sortWithinPartitions(*parts, "_place").drop("_place")
    folder, written = versions.write(laid, path, partition_by, dealt=True)
    versions.publish(spark, path, known, known.columns, folder, written)
    return len(written)


# ---- profiles ----------------------------------------------------------------------------

#: Cells of a distinct count's sketch, as a power of two: a standard error of about 1.6 %.
CELLS = 12


def _sketched(columns: T.StructType) -> T.StructType:
    schema = T.StructType([T.StructField("part", T.StringType()), T.StructField("folder", T.StringType()), T.StructField("row_count", T.LongType())])
    for f in columns.fields:
        schema = schema.add(f"{f.name}_present", T.LongType()).add(f"{f.name}_distinct", T.BinaryType())
    return schema.add("bucket", T.IntegerType())


def update_sketches(spark: SparkSession, path: str, sketches: str) -> int:
    """Bring the sketches of a table of versions up to it, reading only folders that have none.

    A partition's folder never changes, so its sketch (rows, and for each column values present
    and a mergeable distinct count) holds for as long as a version names the folder. The sketches'
    table has one row per partition. Returns the number of folders read.
    """
    known = versions.newest(spark, path)
    schema = _sketched(known.columns)
    create_table(spark, sketches, schema)
    have = {(r.part, r.folder) for r in read_table(spark, sketches, schema).select("part", "folder").collect()}
    lacking = [pair for pair in known.pairs() if pair not in have]
    if not lacking:
        return 0
    cells = [F.count(F.lit(1)).alias("row_count")]
    for f in known.columns.fields:
        cells += [F.count(f.name).alias(f"{f.name}_present"), F.hll_sketch_agg(F.col(f.name).cast("string"), F.lit(CELLS)).alias(f"{f.name}_distinct")]
    # a file's address is escaped once more than its folder's name; a plus sign is itself there
    where = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    at = [F.regexp_extract(where, f"/{versions.DATA}/([^/]*)/(.*)/[^/]*$", k).alias(c) for k, c in ((2, "part"), (1, "folder"))]
    new = versions.frame(spark, path, known.columns, lacking, at).groupBy("part", "folder").agg(*cells)
    new = new.withColumn("bucket", F.pmod(F.xxhash64("part"), F.lit(16)).cast("int"))
    upsert_table(spark, sketches, new, ["part", "bucket"], ["bucket"], ["folder"], schema=schema)
    return len(lacking)


def profile_from_sketches(spark: SparkSession, path: str, sketches: str) -> DataFrame:
    """Rows and, per column, how many values are present and about how many differ, of the table's
    newest version, from its sketches alone."""
    known = versions.newest(spark, path)
    now = spark.createDataFrame(known.pairs(), "part string, folder string")
    rows = read_table(spark, sketches).join(now, ["part", "folder"])
    merged_cells = [F.sum("row_count").alias("_rows")]
    lines = []
    for f in known.columns.fields:
        merged_cells += [F.sum(f"{f.name}_present").alias(f"{f.name}_present"), F.hll_union_agg(f"{f.name}_distinct").alias(f"{f.name}_distinct")]
        lines.append(
            F.struct(
                F.lit(f.name).alias("column_name"), F.col("_rows").alias("row_count"), F.col(f"{f.name}_present").alias("present"),
                F.hll_sketch_estimate(f"{f.name}_distinct").alias("approx_distinct"),
            )
        )
    return rows.agg(*merged_cells).select(F.explode(F.array(*lines)).alias("l")).select("l.*")


# ---- others ------------------------------------------------------------------------------

def write_snapshot(symbols: DataFrame, path: str, taken_at: str) -> None:
    """A membership list as JSON lines, each with the snapshot's time and member count.

    The count is taken first, as one number.
    """
    members = symbols.where(F.col("symbol").isNotNull()).select("symbol").distinct()
    stamped = members.withColumns({"taken_at": F.lit(taken_at), "member_count": F.lit(members.count())})
    stamped.orderBy("symbol").write.mode("overwrite").json(path)


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows, read from as few files as give them."""
    return df.limit(n)


def archive(df: DataFrame, column: str, before, archive_path: str, kept_path: str) -> dict[str, int]:
    """Rows older than ``before`` to their own folder of the archive, all others to ``kept_path``.

    Both are written whole before the caller points readers to ``kept_path``, so a failure
    leaves the old table as it was, and running it again replaces what was written.
    """
    old, kept = split_by_age(df, column, before)
    old, moved = counted(old, "archived")
    old.write.mode("overwrite").parquet(f"{archive_path}/before={before}")
    kept, stayed = counted(kept, "kept")
    kept.write.mode("overwrite").parquet(kept_path)
    return {"archived": moved.get["rows"], "kept": stayed.get["rows"]}


def table_columns(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Name, type and nullability of each column, as rows."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def table_profile(df: DataFrame) -> DataFrame:
    """Row count and, per column, how many values are present and how many differ, in one pass.

    Distinct counts are approximate.
    """
    cells = [F.count(F.lit(1)).alias("_rows")]
    for c in df.columns:
        cells += [F.count(c).alias(f"{c}_present"), F.approx_count_distinct(c).alias(f"{c}_distinct")]
    one = df.agg(*cells)
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_rows").alias("row_count"),
            F.col(f"{c}_present").alias("present"),
            F.col(f"{c}_distinct").alias("approx_distinct"),
        )
        for c in df.columns
    ]
    return one.select(F.explode(F.array(*lines)).alias("l")).select("l.*")


def layer_summary(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Tables and rows per layer; ``layers`` maps layer name to its tables."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "rows"
        )
        for layer, tables in layers.items()
        for table, df in tables.items()
    ]
    return (
        reduce(DataFrame.unionByName, counts)
        .groupBy("layer")
        .agg(F.count_distinct("table_name").alias("table_count"), F.sum("rows").alias("total_rows"))
    )
