"""Landed JSON payloads as DataFrames.

Every feed is read with a declared schema. One landed file holds an array of records, a
single record, an object with the records under ``historical``, an error object, or text
that is not JSON; ``read_feed`` returns the records and, apart, what was rejected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyed import newest_n
from ..schemas import PAYLOADS

ERROR_FIELD = "Error Message"
CORRUPT = "_corrupt"
# Request word -> period label kept from a statement feed.
PERIOD_WORDS = {"annual": ("FY",), "quarterly": ("Q1", "Q2", "Q3", "Q4")}


def _envelope(feed: str) -> T.StructType:
    record = PAYLOADS[feed]
    return (
        T.StructType(list(record.fields))
        .add("historical", T.ArrayType(record))
        .add(ERROR_FIELD, T.StringType())
        .add(CORRUPT, T.StringType())
    )


def _reason(symbol_required: bool) -> Column:
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed payload").when(
        F.col(f"`{ERROR_FIELD}`").isNotNull(), "error payload"
    )
    if symbol_required:
        reason = reason.when(
            F.col("historical").isNull() & (F.coalesce("symbol", F.lit("")) == ""), "missing symbol"
        )
    return reason


def _unwrap(envelopes: DataFrame, feed: str) -> DataFrame:
    """Records of either shape; the symbol of an object envelope goes to its records."""
    fields = [f.name for f in PAYLOADS[feed].fields]
    extra = [c for c in envelopes.columns if c not in (*fields, "historical", ERROR_FIELD, CORRUPT)]
    own = F.array(F.struct(*fields))
    records = envelopes.select(
        *extra,
        *([F.col("symbol").alias("_outer")] if "symbol" in fields else []),
        F.explode(F.coalesce("historical", own)).alias("_r"),
    )
    return records.select(
        *extra,
        *[
            (F.coalesce(F.col("_r.symbol"), F.col("_outer")).alias("symbol") if f == "symbol" else F.col(f"_r.{f}"))
            for f in fields
        ],
    )


def _split(envelopes: DataFrame, feed: str, symbol_required: bool) -> tuple[DataFrame, DataFrame]:
    judged = envelopes.withColumn("reject_reason", _reason(symbol_required))
    good = judged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = judged.where(F.col("reject_reason").isNotNull()).select(
        F.lit(feed).alias("feed"),
        "reject_reason",
        F.coalesce(CORRUPT, F.col(f"`{ERROR_FIELD}`")).alias("detail"),
    )
    return _unwrap(good, feed), bad


def _read(spark: SparkSession, path: str | Sequence[str], feed: str, symbol_from_file: str | None) -> DataFrame:
    raw = (
        spark.read.schema(_envelope(feed))
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("encoding", "UTF-8")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    if symbol_from_file:
        found = F.nullif(F.regexp_extract(F.input_file_name(), symbol_from_file, 1), F.lit(""))
        raw = raw.withColumn("symbol", F.coalesce("symbol", found))
    return raw


def read_feed(
    spark: SparkSession,
    path: str | Sequence[str],
    feed: str,
    symbol_from_file: str | None = None,
    symbol_required: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Records and rejects of all files under ``path``; compression goes by file extension.

    ``symbol_from_file`` is a pattern whose first group takes the symbol from the file
    name, for feeds whose records carry none.
    """
    return _split(_read(spark, path, feed, symbol_from_file), feed, symbol_required)


#: What is wrong with a payload: its feed, no symbol, reason and text.
REFUSED = "_refused"


def read_judged(spark: SparkSession, path: str | Sequence[str], feed: str, symbol_from_file: str | None = None) -> DataFrame:
    """Records and rejects as ``read_feed`` has them, in one frame: a reject is a row without fields
    that stands in ``_refused``. For readers that take all of it and parse the payloads once."""
    reason = _reason(symbol_required=False)
    detail = F.coalesce(CORRUPT, F.col(f"`{ERROR_FIELD}`"))
    refused = F.struct(F.lit(feed).alias("feed"), F.lit(None).cast("string").alias("symbol"), reason.alias("reject_reason"), detail.alias("detail"))
    judged = _read(spark, path, feed, symbol_from_file).withColumn(REFUSED, F.when(reason.isNotNull(), refused))
    fields = [f.name for f in PAYLOADS[feed].fields]
    bare = judged.select(
        REFUSED,
        *[F.when(F.col(REFUSED).isNull(), F.col(c)).alias(c) for c in fields],
        F.when(F.col(REFUSED).isNull(), F.col("historical")).alias("historical"),
    )
    return _unwrap(bare, feed)


def parse_feed(
    df: DataFrame, payload: str, feed: str, symbol: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """As ``read_feed`` for payload text that already sits in a column.

    Other columns are kept next to the records. ``symbol`` names a column that supplies
    the symbol where the payload has none.
    """
    # an array schema also takes a lone object, as an array of one
    parsed = F.from_json(
        payload,
        T.ArrayType(_envelope(feed)),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    kept = [c for c in df.columns if c not in (payload, symbol)]
    broken = F.array(
        F.from_json(F.lit("{}"), _envelope(feed)).withField(CORRUPT, F.col(payload))
    )
    rows = df.select(
        *kept,
        *([F.col(symbol).alias("_given")] if symbol else []),
        F.explode(F.coalesce(parsed, broken)).alias("_e"),
    ).select(*kept, *(["_given"] if symbol else []), "_e.*")
    if symbol:
        rows = rows.withColumn("symbol", F.coalesce("symbol", "_given")).drop("_given")
    return _split(rows, feed, symbol_required=False)


def read_lines(spark: SparkSession, path: str, feed: str) -> tuple[DataFrame, DataFrame]:
    """Bulk load of one record per line, columns matched by name in any letter case.

    Bad lines are set apart and the load goes on.
    """
    parsed = spark.read.text(path).select("value", F.from_json("value", "map<string,string>").alias("_m"))
    entries = F.map_entries("_m")

    def pick(field: T.StructField) -> Column:
        same = F.filter(entries, lambda e: F.lower(e["key"]) == field.name.lower())
        return F.try_element_at(same, F.lit(1))["value"].try_cast(field.dataType).alias(field.name)

    error = F.try_element_at("_m", F.lit(ERROR_FIELD))
    judged = parsed.withColumn(
        "reject_reason",
        F.when(F.col("_m").isNull(), "malformed payload").when(error.isNotNull(), "error payload"),
    )
    records = judged.where(F.col("reject_reason").isNull()).select(*[pick(f) for f in PAYLOADS[feed].fields])
    bad = judged.where(F.col("reject_reason").isNotNull()).select(
        F.lit(feed).alias("feed"), "reject_reason", F.col("value").alias("detail")
    )
    return records, bad


def metrics_long(df: DataFrame, payload: str) -> DataFrame:
    """A vendor's wide metric payload as rows of symbol, metric, value and text.

    Takes whatever fields the payload has, so a new field needs no new schema. A field that is
    not a number keeps its text and has no value; a null field has neither. A payload without
    symbol keeps a null one.
    """
    kept = [c for c in df.columns if c != payload]
    maps = df.select(*kept, F.explode(F.from_json(payload, "array<map<string,string>>")).alias("_m"))
    cells = maps.select(
        *kept,
        F.try_element_at("_m", F.lit("symbol")).alias("symbol"),
        F.explode(F.map_filter("_m", lambda k, _: k != "symbol")).alias("metric", "_v"),
    ).withColumn("value", F.col("_v").try_cast("double"))
    return cells.withColumn("text", F.when(F.col("value").isNull(), F.col("_v"))).drop("_v")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Landed metric payloads, one small file per symbol, as rows."""
    files = spark.read.option("wholetext", True).text(path)
    return metrics_long(files.withColumnRenamed("value", "payload"), "payload")


def payload_records(texts: DataFrame, text: str = "value", symbol: Column | None = None) -> DataFrame:
    """Payload texts as they came, one row per record: the record as a variant, whatever its fields.

    An array gives a row for each element, any other JSON one row. ``symbol`` is the record's
    own, or the given one where it has none. Text that isn't JSON keeps a null payload and stands
    in ``unparsed``. Other columns are kept.
    """
    kept = [c for c in texts.columns if c != text]
    whole = F.try_parse_json(text)
    records = F.coalesce(F.try_variant_get(whole, "$", "array<variant>"), F.array(whole))
    given = F.lit(None).cast("string") if symbol is None else symbol
    # the text is parsed below the generator: columns beside it are made again for each record
    told = texts.select(*kept, given.alias("_given"), F.when(whole.isNull(), F.col(text)).alias("unparsed"), records.alias("_records"))
    rows = told.select(*kept, "_given", "unparsed", F.explode("_records").alias("payload"))
    own = F.nullif(F.try_variant_get("payload", "$.symbol", "string"), F.lit(""))
    return rows.select(*kept, F.coalesce(own, "_given").alias("symbol"), "payload", "unparsed")


def read_payloads(spark: SparkSession, path: str | Sequence[str], symbol_from_file: str | None = None) -> DataFrame:
    """Landed files as ``payload_records`` with their ``source_file``; ``symbol_from_file`` as in ``read_feed``."""
    texts = spark.read.option("wholetext", True).text(path).select("value", F.col("_metadata.file_name").alias("source_file"))
    found = F.nullif(F.regexp_extract("source_file", symbol_from_file, 1), F.lit("")) if symbol_from_file else None
    return payload_records(texts, symbol=found)


def fields(rows: DataFrame, payload: str, wanted: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Fields of a variant column by path, as ``{name: (path, type)}``, in place of it; one that is
    missing or of another type is NULL."""
    kept = [c for c in rows.columns if c != payload]
    return rows.select(*kept, *[F.try_variant_get(payload, path, kind).alias(name) for name, (path, kind) in wanted.items()])


def statement_periods(
    records: DataFrame, request: str = "annual", limit: int | None = None
) -> DataFrame:
    """Records of the requested kind, the newest ``limit`` per symbol."""
    kept = records.where(F.coalesce("period", F.lit("FY")).isin(*PERIOD_WORDS[request]))
    if limit is None:
        return kept
    return newest_n(kept, ["symbol"], [F.desc("date"), F.desc("period")], limit)


def dated(records: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Records whose ISO ``date`` lies in the inclusive range."""
    if start is not None:
        records = records.where(F.col("date") >= start)
    if end is not None:
        records = records.where(F.col("date") <= end)
    return records


def historical_market_cap(
    records: DataFrame, start: str | None = None, end: str | None = None, limit: int | None = None
) -> DataFrame:
    """Records of the range, the newest ``limit`` per symbol if one is given."""
    if limit is None:
        return dated(records, start, end)
    return newest_n(dated(records, start, end), ["symbol"], [F.desc("date")], limit)


def sector_pe(
    records: DataFrame, day: str, exchange: str | None = None, sector: str | None = None
) -> DataFrame:
    kept = records.where(F.col("date") == day)
    if exchange is not None:
        kept = kept.where(F.col("exchange") == exchange)
    if sector is not None:
        kept = kept.where(F.col("sector") == sector)
    return kept


def indicator(records: DataFrame, name: str, start: str | None = None, end: str | None = None) -> DataFrame:
    return dated(records.where(F.col("name") == name), start, end)


def rates_long(wide: DataFrame, keys: Sequence[str] = ("date",)) -> DataFrame:
    """One row per date and maturity instead of one column per maturity; a gap is a row without rate."""
    maturities = [c for c in wide.columns if c not in keys]
    return wide.unpivot(list(keys), maturities, "maturity", "rate")


def constituents(records: DataFrame) -> DataFrame:
    """Distinct symbols of a constituents feed that has one row per member."""
    return records.where(F.coalesce("symbol", F.lit("")) != "").select("symbol").distinct()


def constituent_changes(previous: DataFrame, current: DataFrame, key: str = "symbol") -> DataFrame:
    """Members that joined or left between two snapshots."""
    joined = current.select(key).distinct().join(previous, key, "left_anti")
    left = previous.select(key).distinct().join(current, key, "left_anti")
    return joined.withColumn("change", F.lit("added")).unionByName(
        left.withColumn("change", F.lit("removed"))
    )
