"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language_id, license_scan, line_dedup, merkle, ngram_join, pfair, quality_crf, span_dedup, token_count, url_filter, vector_dedup, whitening

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6_SQL = rf"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(coalesce({_LOWER}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
s as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [hash(w)]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(w[i:i+4]))) end as s
  from w),
inc as (select doc_id, len(s) as n, unnest(s) as g from s),
links as (
  select a.doc_id as a, b.doc_id as b
  from inc a join inc b on a.g = b.g and a.doc_id <> b.doc_id and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n having 180 * count(*) >= 80 * (a.n + b.n)),
reach as (
  select doc_id as a, doc_id as b from s
  union
  select r.a, l.b from reach r join links l on l.a = r.b)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, min(r.b) as component_id
from s join reach r on r.a = s.doc_id group by s.doc_id, len(s.s)
"""


@query("op6_ngram_jaccard_join", OP6_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_groups(_table(spark, folder, "documents"))


@query("op1_benchmark_decontamination")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Every leaked item of every contaminated document."""
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@query("op9_sentence_span_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Each document that loses sentences: where its runs stood first, and its runs."""
    runs = span_dedup.repeated_spans(_table(spark, folder, "documents")).groupBy("doc_id")
    return runs.agg(
        F.sort_array(F.collect_set("first_id")).alias("first_doc_ids"),
        F.count(F.lit(1)).alias("n_runs"),
        F.sort_array(F.collect_list(F.struct("sentence", "low", "high", "words"))).alias("runs"),
    )


@query("op2_fuzzy_line_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Every line that repeats an earlier one, with that one."""
    found = line_dedup.repeated_lines(_table(spark, folder, "documents"), radius=None)
    return found.select("doc_id", "line_no", F.col("first_id").alias("first_doc_id"), "first_line_no")


def quality_chain(spark: SparkSession, folder: str):
    """The chain that learns from the labels that aren't held out."""
    labels = _table(spark, folder, "labels").where("crc32(cast(doc_id as string)) % 5 != 0")
    return quality_crf.train(_table(spark, folder, "documents"), labels)


@query("op7_quality_crf")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    out = quality_crf.scored(_table(spark, folder, "documents"), quality_chain(spark, folder))
    held = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 5 = 0"), F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


@query("op8_pfair_mixing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Block and slot of every document, with sources weighted by their characters to 0.7."""
    out = pfair.mixed_order(_table(spark, folder, "documents"))
    return out.select("doc_id", "source", "block", "slot", "place", "release", "deadline", "in_mix")


@query("op10_embedding_near_dedup")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_vectors(_table(spark, folder, "embeddings"))


@query("op4_language_id")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    held = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 4 = 2"), F.lit(False))
    model = language_id.train(documents.where(~held))
    out = language_id.predicted(documents, model)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "runner_up", "ambiguous")


#: A public unigram vocabulary; its place is a parameter of ``token_count.read_vocabulary``.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


@query("op5_unigram_token_counts")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return token_count.token_counts(_table(spark, folder, "documents"), *token_count.read_vocabulary(VOCABULARY))


#: The rules that every judgement follows, and first labels of domains to block.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
BLOCKED_LABELS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]

OP3_SQL = f"""
with rules(rule, verdict) as (values {", ".join(f"('{r}', '{v}')" for r, v in RULES)}),
u as (
  select page_id, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
listed as (
  select *, (select max_by(substr(host, k), length(host) - k) from (
      select unnest(range(1, length(host) + 1)) as k)
    where (k = 1 or substr(host, k - 1, 1) = '.')
      and split_part(substr(host, k), '.', 1) in ({", ".join(f"'{x}'" for x in BLOCKED_LABELS)})) as listed
  from u)
select page_id, host, path, r.rule, coalesce(r.verdict, case when listed is null then 'allow' else 'block' end) as verdict, listed
from listed left join rules r
  on ('.' || host) like ('%.' || split_part(r.rule, '/', 1)) and starts_with(path, substr(r.rule, instr(r.rule, '/')))
qualify row_number() over (partition by page_id order by length(r.rule) desc nulls last) = 1
"""


@query("op3_url_filter", OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    rules = spark.createDataFrame([(r, v, True) for r, v in RULES], "entry string, verdict string, rule boolean")
    return url_filter.UrlFilter(rules.union(url_filter.labelled_domains(pages, BLOCKED_LABELS))).judge(pages)


def _fields(text: str) -> str:
    values = ["cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


#: CRC-32 of a decimal number: by a table of the bytes' remainders, itself made bit by bit.
_CRC_TABLE = "select list_transform(range(256), lambda b: list_reduce([b] || range(8), lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t"
_CRC = (
    "xor(4294967295, list_reduce([4294967295] || list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint)),"
    " lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"
)

OP11_SQL = f"""
with recursive crc as (select t from ({_CRC_TABLE})),
leaves as (
  select doc_id, source, {_fields("text")} as leaf,
    case when {_CRC} % 2 = 0 then {_fields("replace(text, chr(10), '')")} else {_fields("text")} end as found
  from documents, crc),
placed as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by source) as n
  from leaves),
nodes as (
  select 0 as lvl, source, i, n, leaf as h from placed
  union all
  select lvl + 1, source, i // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' order by i))
  from nodes where n > 1 group by lvl, source, i // 3),
subroots as (
  select source, h as subroot, row_number() over (order by source nulls first) - 1 as i, count(*) over () as n
  from nodes where n = 1),
tops as (
  select 0 as lvl, i, n, subroot as h from subroots
  union all
  select lvl + 1, i // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' order by i)) from tops where n > 1 group by lvl, i // 3),
runs as (select lvl, source, i // 3 as run, list(h order by i) as hs from nodes where n > 1 group by lvl, source, i // 3),
top_runs as (select lvl, i // 3 as run, list(h order by i) as hs from tops where n > 1 group by lvl, i // 3),
up as (
  select doc_id, source, leaf, 0 as lvl, i, n, found as now, '' as proof from placed
  union all
  select doc_id, u.source, leaf, u.lvl + 1, i // 3, (n + 2) // 3,
    sha256(array_to_string(list_transform(hs, lambda h, k: case when k = i % 3 + 1 then now else h end), '')),
    proof || array_to_string(list_filter(hs, lambda h, k: k <> i % 3 + 1), '')
  from up u join runs r on r.lvl = u.lvl and r.source is not distinct from u.source and r.run = i // 3 where n > 1),
over as (
  select doc_id, leaf, subroot, 0 as lvl, s.i, s.n, now, proof
  from up u join subroots s on s.source is not distinct from u.source where u.n = 1
  union all
  select doc_id, leaf, subroot, o.lvl + 1, i // 3, (n + 2) // 3,
    sha256(array_to_string(list_transform(hs, lambda h, k: case when k = i % 3 + 1 then now else h end), '')),
    proof || array_to_string(list_filter(hs, lambda h, k: k <> i % 3 + 1), '')
  from over o join top_runs r on r.lvl = o.lvl and r.run = i // 3 where n > 1)
select doc_id, leaf, subroot, t.h as root, sha256(proof) as proof_sha256, now as folded_root, now = t.h as verified
from over o, tops t where o.n = 1 and t.n = 1
"""


@query("op11_merkle_manifest", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf and proof; half of the documents are checked without their line ends."""
    tampered = F.when(F.expr("crc32(cast(doc_id as string)) % 2 = 0"), F.translate("text", "\n", "")).otherwise(F.col("text"))
    out = merkle.manifest(_table(spark, folder, "documents"), found={"text": tampered})
    proof = F.sha2(merkle.as_text(merkle.siblings(F.col("path"))), 256)
    return out.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", "verified")


@query("op12_embedding_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable vector's coordinate on each of the eight leading components."""
    vectors = _table(spark, folder, "embeddings")
    model = whitening.fit(vectors, components=8)
    error = whitening.identity_error(vectors, model)
    rows = whitening.whitened(vectors, model).select("vec_id", F.expr("try_cast(deviation as long)").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    explained = F.element_at(F.array(*map(F.lit, model.explained or [0.0])), F.col("at") + 1)
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(error).alias("identity_error"),
    )


def _consecutive(words: list[str]) -> str:
    here = " and ".join(f"w[i + {k}] = '{w}'" for k, w in enumerate(words))
    return f"list_filter(range(1, len(w) - {len(words) - 2}), lambda i: {here})"


_BASE = [t for t in license_scan.TEMPLATES if t.base]
_EVIDENCE = ", ".join(
    f"case when regexp_matches(t, '{license_scan.as_pattern(t.text)} ') then {{'label': '{t.label}', 'weight': {t.weight}, 'base': {t.base}}} end"
    for t in license_scan.TEMPLATES
)
_LABELS = "array_to_string(list_sort(list_distinct(list_transform({}, lambda x: x.label))), ',')"

OP13_SQL = rf"""
with w as (
  select doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as w from documents),
t as (
  select doc_id, len(w) as n_words, flatten([{", ".join(_consecutive(license_scan.words_of(t.text)) for t in _BASE)}]) as places,
    ' ' || array_to_string(w, ' ') || ' ' as t
  from w),
e as (select *, list_filter([{_EVIDENCE}], lambda x: x is not null) as e from t)
select doc_id, cast(n_words as bigint) as n_words, cast(len(places) as bigint) as n_base,
  list_min(places) - 1 as first_word, list_max(places) - 1 as last_word,
  {_LABELS.format("list_filter(e, lambda x: x.base)")} as base_labels, {_LABELS.format("e")} as labels,
  cast(coalesce(list_max(list_transform(e, lambda x: x.weight)), 0) as double) as score
from e
"""


@query("op13_license_scan", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """The license phrases and wordings of every document; the score is the strongest evidence."""
    found = license_scan.license_places(_table(spark, folder, "documents"), license_scan.TEMPLATES)
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["first"])

    def labels(places):
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))))

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["weight"])), F.lit(0.0)).alias("score"),
    )
