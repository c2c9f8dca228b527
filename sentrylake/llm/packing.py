"""Best-fit packing of documents into sequences of a fixed number of tokens, bulk-synchronously.

Documents longer than a sequence are cut, their remainder first. As many sequences as all tokens need at least are opened by
the longest documents. Then rounds follow, each over all that is open. Documents and gaps are range-sorted in one line by size,
documents first among equals. Sweeping it upwards, every gap takes the largest document before it that no gap has taken: the line is
a row of brackets, and a document and its gap are a pair of brackets. Their level, the running count of documents less gaps,
tells who belongs together. Each task sweeps its range and pairs what it can; what is left, once the ranges' sums have
lifted its levels, is paired across ranges, and the rank within a level resolves who of several takes whom. A level holds a
row of either kind per range at most, so no level is large. Gaps shrink by what they took, and the next round begins. Where
nothing fits any more, what is left opens sequences again.

Sizes that very many documents share lie in several ranges, as ids break ties. Only sums per range and a few totals meet in one place;
once no more than LAST_ROWS documents and gaps are left, one task goes through the rounds that remain for them.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_tokens import ByteTokenizer
from .common import discard, give_back, materialize, small_batches

#: Tokens of a sequence.
CAPACITY = 2048
#: Rows of a sweep's task, about.
ROWS_PER_TASK = 250_000
#: Documents and gaps whose last rounds one task takes.
LAST_ROWS = 50_000
#: Where sequences would hold more documents than this on average, short ones are bundled for as long as bundles fit.
CROWDED = 16
#: Tokens of a bundle at most, as a part of a sequence.
BUNDLE = 24
#: Id that ends a document.
END = 0

DOCUMENT, GAP = 0, 1


def cut_documents(docs: DataFrame, vocabulary: str, ranks: bytes, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of each row's whole text, its ids and the end id.

    Null texts count as empty and are one piece of the end id. Ids stay as they are, null or repeated.
    """
    import pyarrow as pa

    kind = docs.schema["doc_id"].dataType
    small_batches(docs)

    def run(batches):
        tokenizer = ByteTokenizer(vocabulary, ranks)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                row, pieces, starts, lengths, crcs = [], [], [], [], []
                for i, text in enumerate(batch.column(1)):
                    ids = tokenizer.encode(text.as_py())
                    ids.append(END)
                    raw, n = memoryview(ids).cast("B"), len(ids)
                    start, end, piece = 0, n % capacity or capacity, 0
                    while start < n:
                        row.append(i)
                        pieces.append(piece)
                        starts.append(start)
                        lengths.append(end - start)
                        crcs.append(zlib.crc32(raw[4 * start : 4 * end]))
                        start, end, piece = end, end + capacity, piece + 1
                columns = [batch.column(0).take(pa.array(row, pa.int32())), pa.array(pieces, pa.int32()), *(pa.array(c, pa.int64()) for c in (starts, lengths, crcs))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long")


def paired(value, kind):
    """(places of gaps, places of their documents) of a sorted line: the brackets that close within it."""
    import numpy as np

    level = np.cumsum(1 - 2 * kind.astype(np.int64)) + kind
    order = np.argsort(level, kind="stable")
    gap, doc = order[1:], order[:-1]
    pair = (level[gap] == level[doc]) & (kind[gap] == GAP) & (kind[doc] == DOCUMENT)
    return gap[pair], doc[pair], level


def _sweep(line: DataFrame, tasks: int) -> DataFrame:
    """kind, id, value, part, level, mate, mate_value of a range-sorted line: what a range pairs by itself has its mate."""
    import pyarrow as pa

    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        held = [[b.column(k).to_numpy(zero_copy_only=False) for k in range(3)] for b in batches if b.num_rows]
        if not held:
            return
        value, kind, ids = (np.concatenate(c) for c in zip(*held))
        del held
        gap, doc, level = paired(value, kind)
        mate, mate_value, alone = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int32), np.ones(len(ids), bool)
        for mine, other in ((gap, doc), (doc, gap)):
            mate[mine], mate_value[mine], alone[mine] = ids[other], value[other], False
        columns = [pa.array(kind), pa.array(ids), pa.array(value), pa.array(np.full(len(ids), TaskContext.get().partitionId(), np.int32)), pa.array(level), pa.array(mate, mask=alone), pa.array(mate_value, mask=alone)]
        made = pa.Table.from_arrays(columns, ["kind", "id", "value", "part", "level", "mate", "mate_value"])
        yield from made.to_batches(65536)

    line = line.select(F.col("value").cast("int"), F.col("kind").cast("int"), F.col("id").cast("long"))
    line = line.repartitionByRange(tasks, "value", "kind", "id").sortWithinPartitions("value", "kind", "id")
    return line.mapInArrow(run, "kind int, id long, value int, part int, level long, mate long, mate_value int")


def _matched(docs: DataFrame, gaps: DataFrame | None, rows: int) -> tuple[DataFrame, DataFrame]:
    """(pairs that a range made by itself, the other rows): one round over documents (id, size) and gaps (id, size)."""
    line = docs.select(F.col("size").alias("value"), F.lit(DOCUMENT).alias("kind"), "id")
    if gaps is not None:
        line = line.unionByName(gaps.select(F.col("size").alias("value"), F.lit(GAP).alias("kind"), "id"))
    swept = materialize(_sweep(line, max(1, -(-rows // ROWS_PER_TASK))), "pack-sweep")
    alone = swept.where(F.col("mate").isNull())
    net = alone.groupBy("part").agg(F.sum(1 - 2 * F.col("kind")).alias("net"))
    lift = net.select("part", (F.sum("net").over(Window.orderBy("part")) - F.col("net")).alias("lift"))  # a row per range
    lifted = alone.join(F.broadcast(lift), "part").withColumn("level", F.col("level") + F.col("lift"))
    side = Window.partitionBy("level").orderBy("part", F.col("kind").desc())
    own = F.struct("kind", "id", "value")
    lifted = lifted.withColumn("below", F.lag(own).over(side)).withColumn("above", F.lead(own).over(side))
    other = F.when((F.col("kind") == GAP) & (F.col("below.kind") == DOCUMENT), F.col("below")).when((F.col("kind") == DOCUMENT) & (F.col("above.kind") == GAP), F.col("above"))
    rest = materialize(lifted.withColumn("other", other).select("kind", "id", "value", "level", F.col("other.id").alias("mate"), F.col("other.value").alias("mate_value")), "pack-rest")
    return swept, rest


def _last_rounds(docs: DataFrame, gaps: DataFrame | None, capacity: int, bundled: bool) -> DataFrame:
    """state, id, sequence_id, number of a bounded number of rows: all rounds until every document is placed ("placed", with its offset), or,
    for bundles, until no bundle fits any gap; what is left then comes out as "document" and "gap" with its size."""
    import pyarrow as pa

    def run(batches):
        import numpy as np

        held = [[b.column(k).to_numpy(zero_copy_only=False) for k in range(3)] for b in batches if b.num_rows]
        if not held:
            return
        value, kind, ids = (np.concatenate(c).astype(np.int64) for c in zip(*held))
        docs, gaps = ((value[kind == k], ids[kind == k]) for k in (DOCUMENT, GAP))
        out = []
        put = lambda state, i, sequence, number: out.append(pa.table([pa.array([state] * len(i), pa.string()), *(pa.array(c, pa.int64()) for c in (i, sequence, number))], ["state", "id", "sequence_id", "number"]))
        while len(docs[0]):
            v, i = np.concatenate((docs[0], gaps[0])), np.concatenate((docs[1], gaps[1]))
            k = np.repeat([DOCUMENT, GAP], [len(docs[0]), len(gaps[0])])
            order = np.lexsort((i, k, v))
            v, i, k = v[order], i[order], k[order]
            gap, doc, _ = paired(v, k)
            put("placed", i[doc], i[gap], capacity - v[gap])
            alone = np.ones(len(v), bool)
            alone[gap] = alone[doc] = False
            left = alone & (k == DOCUMENT)
            docs, gaps = (v[left], i[left]), (v[gap] - v[doc], i[gap])
            if bundled:
                other = alone & (k == GAP)
                gaps = tuple(np.concatenate(x) for x in zip(gaps, (v[other], i[other])))
            if not len(docs[0]):
                break
            wide = gaps[0] >= (1 if bundled else docs[0][0])
            gaps = gaps[0][wide], gaps[1][wide]
            if len(gaps[0]) and gaps[0].max() >= docs[0][0]:
                continue
            if bundled and len(gaps[0]):
                break
            opened = min(len(docs[0]), max(-(-int(docs[0].sum()) // capacity), int((2 * docs[0] > capacity).sum())))
            size, i = docs[0][-opened:], docs[1][-opened:]
            put("placed", i, i, np.zeros(opened, np.int64))
            docs, gaps = (docs[0][:-opened], docs[1][:-opened]), (capacity - size, i)
        if len(docs[0]):
            put("document", docs[1], docs[1], docs[0])
            put("gap", gaps[1], gaps[1], gaps[0])
        if out:
            yield from pa.concat_tables(out).to_batches(65536)

    line = docs.select(F.col("size").cast("long").alias("value"), F.lit(DOCUMENT).alias("kind"), "id")
    if gaps is not None:
        line = line.unionByName(gaps.select(F.col("size").cast("long").alias("value"), F.lit(GAP).alias("kind"), "id"))
    return line.repartition(1).mapInArrow(run, "state string, id long, sequence_id long, number long")


def _bundles(items: DataFrame, most: int) -> DataFrame:
    """id, item, inner, size: documents shorter than ``most`` that lie side by side share an item of ``most`` tokens at most."""
    import pyarrow as pa

    def run(batches):
        item, filled = None, most
        for b in batches:
            items, inners = [], []
            for i, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if size >= most:
                    items.append(i)
                    inners.append(0)
                    continue
                if filled + size > most:
                    item, filled = i, 0
                items.append(item)
                inners.append(filled)
                filled += size
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(items, pa.int64()), pa.array(inners, pa.int64()), b.column(1)], ["id", "item", "inner", "size"])

    return items.select("id", "size").mapInArrow(run, "id long, item long, inner long, size long")


def best_fit(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """id, sequence_id, offset for every row (unique ``id``, ``size`` from 1 to ``capacity``) of a stored table.

    A sequence has the id of the document that opened it. Equal sizes are interchangeable; ids break ties.
    """
    n, total = items.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not n:
        return items.select("id", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    bundled = n > CROWDED * -(-total // capacity)
    if bundled:
        members = materialize(_bundles(items, max(1, capacity // BUNDLE)), "pack-bundles")
        docs = members.groupBy(F.col("item").alias("id")).agg(F.sum("size").alias("size"))
    else:
        docs = items.select("id", "size")

    placed: list[DataFrame] = []
    singles: list[DataFrame] = []  # documents whose bundles found no place as a whole
    used: list[DataFrame] = []
    gaps, n_gaps = None, 0
    while True:
        if n + n_gaps <= LAST_ROWS:
            done = materialize(_last_rounds(docs, gaps, capacity, bundled), "pack-last")
            used.append(done)
            placed.append(done.where("state = 'placed'").select("id", "sequence_id", F.col("number").alias("offset")))
            rest = done.where("state = 'document'")
            if not bundled or rest.isEmpty():
                break
            docs = materialize(members.join(rest.select(F.col("id").alias("item")), "item", "left_semi").select("id", "size"), "pack-loose")
            gaps, bundled = done.where("state = 'gap'").select("id", F.col("number").alias("size")), False
            singles.append(docs)
            n, n_gaps = docs.count(), gaps.count()
            continue
        swept, rest = _matched(docs, gaps, n + n_gaps)
        used += [swept, rest]
        pairs = swept.unionByName(rest.withColumn("part", F.lit(0)), allowMissingColumns=True).where((F.col("kind") == GAP) & F.col("mate").isNotNull())
        if gaps is not None:
            placed.append(pairs.select(F.col("mate").alias("id"), F.col("id").alias("sequence_id"), (capacity - F.col("value")).cast("long").alias("offset")))
        left = rest.where((F.col("kind") == DOCUMENT) & F.col("mate").isNull())
        n, total, least, top, long = left.agg(F.count(F.lit(1)), F.sum("value"), F.min("value"), F.max("level"), F.count_if(F.col("value") * 2 > capacity)).first()
        if not n:
            break
        after = pairs.select("id", (F.col("value") - F.col("mate_value")).alias("size"))
        if bundled:  # single documents may still fit where no bundle does
            after = after.unionByName(rest.where((F.col("kind") == GAP) & F.col("mate").isNull()).select("id", F.col("value").alias("size")))
        after = after.where(F.col("size") >= (1 if bundled else least))
        n_gaps, widest = after.agg(F.count(F.lit(1)), F.max("size")).first() if gaps is not None else (0, None)
        if widest is not None and widest >= least:
            docs, gaps = left.select("id", F.col("value").alias("size")), after
        elif bundled and n_gaps:
            loose = members.join(left.select(F.col("id").alias("item")), "item", "left_semi")
            docs, gaps, bundled = materialize(loose.select("id", "size"), "pack-loose"), after, False
            singles.append(docs)
            n = docs.count()
        else:  # levels of documents that are left rise by one from the shortest to the longest
            opened = min(n, max(-(-total // capacity), long))
            first = F.col("level") > top - opened
            placed.append(left.where(first).select("id", F.col("id").alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
            docs = left.where(~first).select("id", F.col("value").alias("size"))
            gaps = left.where(first).select("id", (capacity - F.col("value")).alias("size")).where("size > 0")
            n, n_gaps = n - opened, opened
    places = placed[0]
    for more in placed[1:]:
        places = places.unionByName(more)
    if singles or bundled:
        alone = members.join(singles[0].select("id"), "id", "left_semi") if singles else members.limit(0)
        inner = members if not singles else members.join(singles[0].select("id"), "id", "left_anti")
        held = inner.select("id", "item", "inner").unionByName(alone.select("id", F.col("id").alias("item"), F.lit(0).cast("long").alias("inner")))
        # A bundle that was taken apart lends its id to its first document, which has a place of its own.
        places = held.join(places.withColumnRenamed("id", "item"), "item").select("id", "sequence_id", (F.col("offset") + F.col("inner")).alias("offset"))
    done = materialize(places, "pack-places")
    for table in used:
        discard(table)
    return done


def pack(docs: DataFrame, vocabulary: str, ranks: bytes, capacity: int = CAPACITY) -> DataFrame:
    """A row per piece of every row of ``docs`` (``doc_id``, ``text``): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its whole text and an end id; null and empty texts are the end id alone. Documents of more than
    ``capacity`` tokens are cut into pieces of ``capacity``, the first of which may be shorter; no other is cut. A sequence holds
    whole pieces from offset 0 on without gaps. Repeated rows, null ids and different texts with one id are documents each for
    itself. Among equal lengths it is open which document goes where. No rows in, no rows out; other columns are dropped, whatever their names.
    """
    pieces = materialize(cut_documents(docs, vocabulary, ranks, capacity).withColumn("id", F.monotonically_increasing_id()), "pack-pieces")
    shorter = pieces.where(F.col("length") < capacity)
    places = best_fit(shorter.select("id", F.col("length").alias("size")), capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = pieces.where(F.col("length") == capacity).withColumns({"sequence_id": F.col("id"), "offset": F.lit(0).cast("long")})
    return shorter.join(places, "id").select(*columns).unionByName(full.select(*columns))
