"""Ranked lexical search by two hierarchies: the best documents of each item, found exactly without scoring all pairs.

A document is a vector of impacts over the items' terms, an item one of weights; a score is their inner product. Documents and items are put into trees
whose nodes hold the greatest value of each coordinate below them. The inner product of two nodes bounds every score between their
members, so a pair of nodes goes as a whole when it is less than the weakest k-th best score among the node's items. What is left goes down
one level in both trees, and the last level gives the scores themselves.

Texts are read once per wave of items (a wave's text, and so its terms, is of bounded size) and staged as impacts; df, N and L are counted by Spark over all documents.
Then packs of items go round: a pack's tree is broadcast, every task builds trees over its batches of documents and keeps the k best per item. A first round
over one document in ``PRIME`` gives k-th best scores to begin with.

Defined cases: NULL, empty and blank texts have no terms; items without terms and items with NULL id have no rows; an id with several
texts asks with the least; every document row counts, repeated ones are listed repeatedly; NULL doc_ids come last among equal
scores; long texts are read in pieces; further columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.llm.topk import kth_scores, merged
from riskmart.session import stage_path, staged

#: Letters, digits and all that is not ASCII make terms; only A-Z are lower-cased.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: Bytes of item texts in one wave and in one pack, and items in a pack; a single larger item is one of its own.
WAVE_BYTES, PACK_BYTES, PACK_ITEMS = 4 << 20, 128 << 10, 256
#: Members of a node, from the top: of a batch of documents, and of a pack of items.
DOC_NODES, ITEM_NODES = (1024, 128, 16, 1), (64, 8, 1, 1)
PIECE, PRIME = 1 << 20, 16
SIZES = "doc_id long, n long, terms array<int>, tfs array<int>"


def pieces_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of about ``PIECE`` bytes at a time."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(PLAIN)
    at = 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            end = data.find(b" ", end)
            end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def counted(documents: DataFrame, doc_id: str, text: str, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, tfs): terms of a document, and how often it has which of ``terms`` (by number)."""
    shared = documents.sparkSession.sparkContext.broadcast(b" ".join(terms))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(shared.value.split())}.get
        for batch in batches:
            sizes, ends, known, tfs = [], [0], [], []
            for value in batch.column("text"):
                found, n = Counter(), 0
                for words in pieces_of(value.as_py()):
                    n += len(words)
                    found.update(map(number, words))
                found.pop(None, None)
                sizes.append(n)
                known.extend(found.keys())
                tfs.extend(found.values())
                ends.append(len(known))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (known, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SIZES)


def maxima(rows: np.ndarray, size: int) -> np.ndarray:
    """The coordinate maxima of every ``size`` consecutive rows."""
    return rows if size == 1 or not len(rows) else np.maximum.reduceat(rows, np.arange(0, len(rows), size), axis=0)


def tree(rows: np.ndarray, nodes: tuple[int, ...]) -> list[np.ndarray]:
    """The maxima level by level from the top, each made from the one below."""
    levels = [maxima(rows, nodes[-1])]
    for size, below in zip(nodes[-2::-1], nodes[:0:-1]):
        levels.insert(0, maxima(levels[0], size // below))
    return levels


def likeness_order(rows: np.ndarray) -> np.ndarray:
    """An order that puts like rows side by side: along the second main direction of their directions."""
    if len(rows) < 3:
        return np.arange(len(rows))
    unit = rows / np.maximum(np.sqrt((rows.astype(float) ** 2).sum(1, keepdims=True)), 1e-300)
    return np.argsort(np.linalg.eigh(unit @ unit.T)[1][:, -2], kind="stable")


def surviving(docs: list[np.ndarray], items: list[np.ndarray], least: np.ndarray, doc_nodes: tuple[int, ...] = DOC_NODES, item_nodes: tuple[int, ...] = ITEM_NODES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document row, item row, score) of the pairs no node bound rules out, that score ``least`` of the item or more."""
    alive = np.ones((len(docs[0]), len(items[0])), bool)
    for level, (a, b) in enumerate(zip(docs, items)):
        weakest = -maxima(-least[:, None], item_nodes[level])[:, 0]
        rows, cols = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        if not len(rows):
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int64)
        bound = a[rows] @ b[cols].T
        alive[np.ix_(rows, cols)] &= bound >= weakest[cols]
        if level == len(docs) - 1:
            i, j = np.nonzero(alive[np.ix_(rows, cols)])
            return rows[i], cols[j], bound[i, j].astype(np.int64)
        up, over = doc_nodes[level] // doc_nodes[level + 1], item_nodes[level] // item_nodes[level + 1]
        alive = np.repeat(np.repeat(alive, up, axis=0)[:len(docs[level + 1])], over, axis=1)[:, :len(items[level + 1])]
    raise AssertionError("no levels")


def _found(vectors: DataFrame, pack: dict, k: int) -> DataFrame:
    """(item, doc_id, score): per task, the k best documents of every item of a pack (by its number)."""
    shared = vectors.sparkSession.sparkContext.broadcast(pack)
    doc_nodes, item_nodes = DOC_NODES, ITEM_NODES

    def impacts(part: pa.RecordBatch, own: dict) -> tuple[np.ndarray, np.ndarray]:
        """The matrix of impacts over the columns that occur, and these columns."""
        ends = part.column("terms").offsets.to_numpy()
        term, tf = (part.column(c).values.to_numpy()[ends[0]:ends[-1]].astype(np.int64) for c in ("terms", "tfs"))
        row, col = np.repeat(np.arange(part.num_rows), np.diff(ends)), own["column"][term]
        row, col, tf = row[col >= 0], col[col >= 0], tf[col >= 0]
        m = 75 + (25 * part.column("n").to_numpy() * own["N"]) // max(1, own["L"])
        cols, at = np.unique(col, return_inverse=True)
        out = np.zeros((part.num_rows, len(cols)), own["items"].dtype)
        out[row, at] = (1_000_000_000 * tf) // (1000 * tf + 12 * m[row])
        return out, cols

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, have = shared.value, tuple(np.zeros(0, np.int64) for _ in range(4))
        least = own["least"]
        for batch in batches:
            for i in range(0, batch.num_rows, doc_nodes[0]):
                part = batch.slice(i, doc_nodes[0])
                rows, cols = impacts(part, own)
                if not len(cols):
                    continue
                # documents whose heaviest terms are the same stand together
                order = np.argsort((rows * own["weight"][cols]).argmax(1), kind="stable")
                doc, item, score = surviving(tree(rows[order], doc_nodes), tree(own["items"][:, cols], item_nodes), least, doc_nodes, item_nodes)
                ids = part.column("doc_id")
                named, none = ids.fill_null(0).to_numpy()[order][doc], ids.is_null().to_numpy(zero_copy_only=False)[order][doc]
                have = merged(have, (item, score, none.astype(np.int64), named), k)
                least = kth_scores(have[0], have[1], least, k)
        named = pa.array(have[3], mask=have[2].astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(have[0]), named, pa.array(have[1])], ["item", "doc_id", "score"])

    return vectors.mapInArrow(run, "item long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of what the tasks found: at most k rows per item and task meet here."""
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def weights_of(df: np.ndarray, n: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)


def search(documents: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item that score above 0."""
    spark, kind = documents.sparkSession, items.schema[item_id].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    asked = items.where(F.col(item_id).isNotNull()).groupBy(F.col(item_id).alias("item_id")).agg(F.min(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    asked = staged(asked.withColumn("size", F.octet_length("text").cast("long")), "search-items")
    total = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    waves = max(1, -(-total["bytes"] // WAVE_BYTES))
    path = stage_path(spark, "search")
    spark.createDataFrame([], schema).write.parquet(path)
    for wave in range(waves):
        # a wave's items come to the driver: their texts are of bounded size
        own = [(r["item_id"], Counter(w for words in pieces_of(r["text"]) for w in words))
               for r in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(waves)) == wave).orderBy("item_id").toLocalIterator()]
        own = [(i, c) for i, c in own if c]
        if not own:
            continue
        terms = sorted(set().union(*[c for _, c in own]))
        number = {t: i for i, t in enumerate(terms)}
        vectors = staged(counted(documents, doc_id, text, terms), "search-vectors")
        sums = vectors.agg(F.count_if(F.col("n") > 0).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
        df = np.zeros(len(terms), np.int64)
        seen = vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).toArrow()
        df[seen.column("t").to_numpy()] = seen.column("n").to_numpy()
        weight = weights_of(df, sums["N"])
        for pack in _packs(own):
            _search_pack(spark, vectors, pack, number, weight, sums, k, kind).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _packs(own: list) -> Iterator[list]:
    """Runs of items with at most ``PACK_ITEMS`` members and ``PACK_BYTES`` bytes of distinct terms."""
    pack, size = [], 0
    for item in own:
        more = sum(len(t) + 1 for t in item[1])
        if pack and (len(pack) == PACK_ITEMS or size + more > PACK_BYTES):
            yield pack
            pack, size = [], 0
        pack.append(item)
        size += more
    if pack:
        yield pack


def _search_pack(spark, vectors: DataFrame, pack: list, number: dict, weight: np.ndarray, sums, k: int, kind: str) -> DataFrame:
    used = np.array(sorted({number[t] for _, c in pack for t in c}), dtype=np.int64)
    column = np.full(len(weight), -1, np.int64)
    column[used] = np.arange(len(used))
    rows = np.zeros((len(pack), len(used)), np.int64)
    for i, (_, c) in enumerate(pack):
        for t, n in c.items():
            rows[i, column[number[t]]] = n * weight[number[t]]
    if int(rows.sum(1).max(initial=0)) * 1_000_000 < 2 ** 53 and int(rows.max(0).sum()) * 1_000_000 < 2 ** 53:
        rows = rows.astype(float)  # all sums below stay exact
    order = likeness_order(rows)
    shared = {"items": rows[order], "column": column, "weight": weight[used], "N": int(sums["N"]), "L": int(sums["L"]), "least": np.ones(len(pack))}
    some = vectors.where(F.size("terms") > 0)
    primed = _ranked(_found(some.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(PRIME)) == 0), shared, k), k).where(F.col("rank") == k).toArrow()
    for item, score in zip(primed.column("item").to_pylist(), primed.column("score").to_pylist()):
        shared["least"][item] = max(1, score)
    names = spark.createDataFrame([(i, pack[at][0]) for i, at in enumerate(order.tolist())], f"item long, item_id {kind}")
    return _ranked(_found(some, shared, k), k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
