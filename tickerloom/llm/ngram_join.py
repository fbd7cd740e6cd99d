"""N-gram Jaccard join: a sparse product of the document by n-gram incidence, in blocks.

The incidence matrix is cut into blocks of columns (ranges of n-gram hashes). A block says,
for each document, how many of its n-grams any other document has: the sum over all blocks
bounds every overlap the document can have. A document whose bound is below what its own size
asks for takes no further part; in a corpus without copies that is nearly all of them.

Of the rest, the product is taken over the columns that the bound leaves open: n-grams are put
in order of their number of documents, and only the rarest ``n - ceil(t n) + 1`` of a document
can be the first it shares with a partner. Pairs that meet in such a column are discarded by
their sizes, by the places of the column in both documents, and by a lower bound of their
difference from 1024-bit parities; the overlap of the others is counted in full.

Documents that meet are first compared with one document per column (the one with the fewest
n-grams of its own), and then only across the components found so far, so that a large group
of copies costs about one comparison for each of them. Equal sets are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap, in_bitmap, mixed, parallelism, shingles, small_batches, stored, text_pieces, unused, word_hashes
from .components import components

#: Shingles that a task gathers before it sends them, and documents from which it sends none.
CHUNK, COMMON = 400_000, 8
#: Shingles of open documents for which a block of columns is worth its while.
CELLS = 50_000
#: Bytes of text for which there is a block of the whole incidence.
BYTES = 64 << 20
#: Members of a column that one task compares with each other.
CELL = 512
PARITIES = 16
_LOW = np.uint64(0xFFFFFFFF)


def _node(run: np.ndarray) -> int:
    """A 64-bit name of a set; equal sets have equal names."""
    total = mixed(run ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(run))
    return int(mixed(total)[0])


def _parity(run: np.ndarray) -> np.ndarray:
    bits = np.bincount((run >> np.uint64(17)).astype(np.int64) % (64 * PARITIES), minlength=64 * PARITIES) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch], width: int, chosen: np.ndarray | None = None):
    """(ids, sets) of runs of rows; with ``chosen``, only of ids whose bit is set."""
    for batch in batches:
        if chosen is not None and batch.num_rows:
            batch = batch.filter(pa.array(in_bitmap(batch.column("id").to_numpy(), chosen)))
        for first, end, data, offsets in text_pieces(batch.column("text")):
            yield batch.column("id").slice(first, end - first).to_pylist(), shingles(*word_hashes(data, offsets), width)


def _binary(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


_SENT = "block int, nodes binary, counts binary, grams binary, common binary, ids array<bigint>, sizes binary"


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [("block", pa.int32()), ("nodes", pa.binary()), ("counts", pa.binary()), ("grams", pa.binary()), ("common", pa.binary()), ("ids", pa.list_(pa.int64())), ("sizes", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([r.get(k) for r in rows], t) for k, t in kinds], schema=pa.schema(kinds))


def _blocks(nodes: np.ndarray, grams: np.ndarray, sizes: np.ndarray, blocks: int, wide: bool) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """Rows of (block, its part of the incidence); and of every shingle, whether it is common here.

    A shingle of ``COMMON`` documents of the chunk is known to be shared: its documents are not
    sent, only the shingle, so that a shingle of very many documents loads no task.
    """
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    order = np.argsort(grams)
    ranked = grams[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    n = np.diff(np.concatenate([first, [len(ranked)]]))
    often = np.empty(len(grams), bool)
    often[order] = np.repeat(n >= COMMON, n)
    common = ranked[first[n >= COMMON]]
    place = ((grams >> np.uint64(32)) % np.uint64(blocks)).astype(np.uint32)
    home = (common >> np.uint64(32)) % np.uint64(blocks)
    cut = (lambda x: x) if wide else (lambda x: (x & _LOW).astype(np.uint32))
    if not wide:
        # of a document's shingles in a block that the cut makes equal one is sent and all count as shared
        names = (owner.astype(np.uint64) << np.uint64(32)) | (grams & _LOW)
        ranked = np.sort(names)
        equal = ranked[1:][ranked[1:] == ranked[:-1]]
        if len(equal):
            doubled = np.flatnonzero(np.isin(names, equal))
            _, kept = np.unique(np.stack([names[doubled], place[doubled].astype(np.uint64)]), axis=1, return_index=True)
            often[np.delete(doubled, kept)] = True
    rest = np.flatnonzero(~often)
    rest = rest[np.argsort(place[rest], kind="stable")]
    edges = np.searchsorted(place[rest], np.arange(blocks + 1, dtype=np.uint32))
    rows = []
    for k in range(blocks):
        part = rest[edges[k] : edges[k + 1]]
        here = common[home == k]
        if not len(part) and not len(here):
            continue
        who = owner[part]
        change = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])) if len(who) else np.zeros(0, np.int64)
        rows.append({
            "block": k, "nodes": _binary(nodes[who[change]]),
            "counts": _binary(np.diff(np.concatenate([change, [len(who)]])).astype(np.uint32) if len(who) else np.zeros(0, np.uint32)),
            "grams": _binary(cut(grams[part])), "common": _binary(cut(here)),
        })
    return rows, owner, often


def _incidence(width: int, blocks: int):
    """Documents in, blocks of the incidence out; ids, nodes and sizes ride along."""

    def flush(ids: list, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        names = np.array([_node(s) if len(s) else 0 for s in sets], np.uint64)
        sizes = np.array([len(s) for s in sets], np.int64)
        known = {}
        for k, (name, size) in enumerate(zip(names.tolist(), sizes.tolist())):
            if size:
                known.setdefault(name, k)
        rows, local = [], np.zeros(len(sets), np.int64)
        if known:
            kept = list(known.values())
            rows, owner, often = _blocks(names[kept], np.concatenate([sets[k] for k in kept]), sizes[kept], blocks, False)
            local[kept] = np.bincount(owner, often, minlength=len(kept)).astype(np.int64)
        rows.append({"block": int(names[0] % np.uint64(blocks)), "ids": ids, "nodes": _binary(names), "sizes": _binary(sizes), "counts": _binary(local)})
        for first in range(0, len(rows), 64):
            yield _batch(rows[first : first + 64])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets, held = [], [], 0
        for some, found in _sets(batches, width):
            ids += some
            sets += found
            held += sum(map(len, found))
            if held >= CHUNK or len(ids) >= CHUNK // 10:
                yield from flush(ids, sets)
                ids, sets, held = [], [], 0
        if ids:
            yield from flush(ids, sets)

    return run


def _parts(table: pa.Table, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes and shingles of a block, sorted by shingle and without repeats; common shingles."""
    read = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in table.column(c).to_pylist() if x is not None] or [np.zeros(0, t)])
    nodes, grams = np.repeat(read("nodes", np.uint64), read("counts", np.uint32)), read("grams", kind)
    order = np.lexsort((nodes, grams))
    nodes, grams = nodes[order], grams[order]
    new = np.concatenate([[True], (grams[1:] != grams[:-1]) | (nodes[1:] != nodes[:-1])]) if len(grams) else np.zeros(0, bool)
    return nodes[new], grams[new], np.unique(read("common", kind))


def _degrees(grams: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each entry, the documents that have its shingle; very many for a common one."""
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
    n = np.diff(np.concatenate([first, [len(grams)]]))
    return np.repeat(np.where(np.isin(grams[first], common, assume_unique=True), 1 << 30, n), n)


def _bounds(table: pa.Table) -> pa.Table:
    """Of one block: (node, number of its shingles that others have); and what rides along."""
    alone = table.filter(pc.is_valid(table.column("ids")))
    nodes, grams, common = _parts(table.filter(pc.is_null(table.column("ids"))), np.uint32)
    names, at = np.unique(nodes, return_inverse=True)
    shared = np.bincount(at, _degrees(grams, common) > 1, minlength=len(names)).astype(np.int64)
    some = shared > 0
    out = [(np.full(some.sum(), None), names[some], np.full(some.sum(), None), shared[some])]
    for row in alone.to_pylist():
        size = np.frombuffer(row["sizes"], np.int64)
        out.append((np.array(row["ids"], object), np.frombuffer(row["nodes"], np.uint64), size.astype(object), np.frombuffer(row["counts"], np.int64)))
    column = lambda k, t: pa.array(np.concatenate([x[k] for x in out]).tolist(), t)
    nodes = np.concatenate([x[1] for x in out]).view(np.int64)
    return pa.table({"id": column(0, pa.int64()), "node": pa.array(nodes), "size": column(2, pa.int64()), "shared": column(3, pa.int64())})


def _chosen_sets(width: int, chosen: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, width, chosen):
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_pydict({
                "node": pa.array([_node(s) for s in sets], pa.uint64()).cast(pa.int64(), safe=False),
                "grams": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                "parity": pa.array([_parity(s) for s in sets], pa.list_(pa.int64())),
            })

    return run


def _columns(blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("grams")
            grams, edges = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
            nodes = batch.column("node").to_numpy().view(np.uint64)
            first = 0
            while first < len(nodes):
                end = max(first + 1, int(np.searchsorted(edges, edges[first] + CHUNK, "right")) - 1)
                part = grams[edges[first] : edges[end]]
                rows, owner, often = _blocks(nodes[first:end], part, np.diff(edges[first : end + 1]), blocks, True)
                part, owner = part[often], owner[often]
                starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else []
                for a, b in zip(starts, [*starts[1:], len(owner)]):
                    node = nodes[first + owner[a]]
                    rows.append({"block": int(node % np.uint64(blocks)), "ids": [int(node.astype(np.int64))], "grams": _binary(part[a:b])})
                for at in range(0, len(rows), 64):
                    yield _batch(rows[at : at + 64])
                first = end

    return run


def _frequencies(table: pa.Table) -> pa.Table:
    """Of one block: (node, shingle, its number of documents) for each entry that others share."""
    alone = table.filter(pc.is_valid(table.column("ids"))).to_pylist()
    nodes, grams, common = _parts(table.filter(pc.is_null(table.column("ids"))), np.uint64)
    n = _degrees(grams, common)
    some = n > 1
    more = [np.frombuffer(r["grams"], np.uint64) for r in alone]
    owners = [np.full(len(x), r["ids"][0], np.int64) for r, x in zip(alone, more)]
    return pa.table({
        "node": np.concatenate([nodes[some].view(np.int64), *owners]), "gram": np.concatenate([grams[some], *more]).view(np.int64),
        "n": np.concatenate([n[some], *(np.full(len(x), 1 << 30) for x in more)]).astype(np.int64),
    })


def jaccard_groups(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: id, ``n_shingles`` and ``component_id``.

    Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased; a document's
    set holds its distinct ``width``-word shingles (the whole sequence, if it is shorter). Two
    documents are linked when ``100 * intersection >= percent * union``; ``component_id`` is
    the smallest id reachable by links. No link is lost.

    Null, empty and blank texts have no shingles and no links. Rows that repeat an id each have
    their own set, and all are returned; rows with a null id link others but give no component
    its name, and get a null component if they reach no id. An empty table gives no rows.
    """
    spark = documents.sparkSession
    small_batches(spark)
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # a block is one task's group: it keeps its size however long the corpus is
    length = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(parallelism(spark), -(-length // BYTES))
    sent = docs.mapInArrow(_incidence(width, blocks), _SENT)
    counted = stored(sent.groupBy("block").applyInArrow(_bounds, "id long, node long, size long, shared long"), "bounds")
    rows = counted.where("size is not null").select("id", "size", F.when(F.col("size") > 0, F.col("node")).alias("node"))
    nodes = counted.groupBy("node").agg(F.max("size").alias("size"), F.sum("shared").alias("shared"), F.min("id").alias("id"))
    open_ = stored(nodes.where(f"size > 0 and id is not null and 100 * shared >= {percent} * size"), "open")

    sets = docs.where("id is not null").mapInArrow(_chosen_sets(width, bitmap(open_.select("id"))), "node long, grams array<long>, parity array<long>")
    sets = stored(sets.join(open_.select("node"), "node", "left_semi").groupBy("node").agg(F.any_value("grams").alias("grams"), F.any_value("parity").alias("parity")), "sets")

    blocks = max(1, (open_.agg(F.sum("size")).first()[0] or 0) // CELLS)
    blocked = sets.select("node", "grams").mapInArrow(_columns(blocks), _SENT)
    parts = blocked.groupBy("block").applyInArrow(_frequencies, "node long, gram long, n long")
    order = F.sort_array(F.collect_list(F.struct("n", "gram")))
    ranked = parts.groupBy("node").agg(order.alias("order")).join(sets.select("node", F.size("grams").cast("long").alias("size"), *[F.col("parity")[k].alias(f"p{k}") for k in range(PARITIES)]), "node")
    ranked = ranked.withColumn("own", F.col("size") - F.size("order"))
    prefix = F.expr(f"cast(size - ceil({percent} * size / 100) + 1 - own as int)")
    ranked = ranked.withColumn("open", prefix).where("open > 0")
    keys = stored(
        ranked.select("node", "size", "own", *[f"p{k}" for k in range(PARITIES)], F.posexplode(F.expr("slice(order, 1, open)")).alias("at", "key"))
        .select("node", "size", "own", *[f"p{k}" for k in range(PARITIES)], (F.col("own") + F.col("at")).alias("at"), F.col("key.gram").alias("gram")),
        "columns",
    )

    def meet(a: str, b: str) -> str:
        """Bounds that every linked pair satisfies, from its sizes, places and parities."""
        differ = " + ".join(f"bit_count({a}.p{k} ^ {b}.p{k})" for k in range(PARITIES))
        most = f"least({a}.at, {b}.at) + least({a}.size - {a}.at, {b}.size - {b}.at)"
        return (
            f"100 * least({a}.size, {b}.size) >= {percent} * greatest({a}.size, {b}.size)"
            f" and (100 + {percent}) * ({most}) >= {percent} * ({a}.size + {b}.size)"
            f" and (100 + {percent}) * ({differ}) <= (100 - {percent}) * ({a}.size + {b}.size)"
        )

    def linked(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
        right = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
        both = pairs.join(left, "a").join(right, "b").withColumn("n", F.size(F.array_intersect("ga", "gb")))
        return stored(both.where(f"100 * n >= {percent} * (size(ga) + size(gb) - n)").select("a", "b"), "links")

    lead = keys.groupBy("gram").agg(F.min(F.struct((F.col("own") * 1000 / F.col("size")).cast("long").alias("part"), "node")).alias("l"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # the leader's own row carries its size, place and parities
    heads = keys.join(lead.select("gram", F.col("l.node").alias("node")), ["gram", "node"])
    star = keys.alias("x").join(heads.alias("y"), F.expr(f"x.gram = y.gram and x.node != y.node and {meet('x', 'y')}"))
    star = star.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    first = linked(star)
    label = components(first, "a", "b").withColumnRenamed("component", "label")

    tagged = keys.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    split = tagged.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high")
    tagged = stored(tagged.join(split.select("gram", F.ceil(F.col("n") / CELL).cast("int").alias("cells")), "gram"), "across")
    left = tagged.withColumn("cell", F.expr("pmod(xxhash64(node), cells)"))
    right = tagged.withColumn("cell", F.explode(F.expr("sequence(0L, cells - 1L)")))
    across = left.alias("x").join(right.alias("y"), F.expr(f"x.gram = y.gram and x.cell = y.cell and x.label < y.label and {meet('x', 'y')}"))
    across = across.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    links = first.union(linked(across))
    label = components(links, "a", "b").withColumnRenamed("component", "label")

    named = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("least"))
    named = named.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    whole = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(whole, "label").select("node", "component_id")
    out = rows.join(named, "node", "left")
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def without_copies(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One document of each group of ``jaccard_groups``: the one with the smallest id.

    Rows that repeat an id and its text are one document. Rows with a null id are kept.
    """
    groups = stored(jaccard_groups(documents, id_col, text_col, **how), "groups")
    of, by = unused(documents, "__id", "__hash")
    kept = groups.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias(of))
    repeated = kept.groupBy(of).count().where("count > 1").limit(1).count()
    out = documents.join(kept.distinct(), documents[id_col] == F.col(of), "left_semi")
    if repeated:
        out = out.withColumn(by, F.xxhash64(text_col)).dropDuplicates([id_col, by]).drop(by)
    return out.union(documents.where(F.col(id_col).isNull()))
