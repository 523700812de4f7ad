"""N-gram Jaccard join: shingle sets, count vectors in an R-tree, exact verification.

A document's set holds its distinct 5-word shingles (A-Z lower-cased); documents of equal sets are
one node.  Two nodes link when 100 * |A & B| >= 80 * |A | B|, that is 9 * |A & B| >= 4 * (|A| + |B|).

Candidates share a shingle among the ceil-based prefix of n - ceil(0.8 n) + 1 shingles in one global
order, which loses no link.  The order puts shingles that are frequent somewhere last; it is only a hint,
so the bounded table behind it (``HOT_SHINGLES`` rows) never changes results.  A shingle's nodes are then
joined in two steps.  First each node meets one smallest node of its shingles; in a group of near
copies that links nearly all, with one pair per node.  Then, where a shingle's nodes still lie in several
components, blocks of nodes meet in an R-tree: shingles are hashed into ``GROUPS`` groups, the
group counts are a point, and the summed minima of two points bound the overlap, of a point and a box's
upper corner that of all points in it.  The pairs that survive the bound and are not connected yet make clusters,
whose nodes meet in blocks and R-trees once more, now with their whole sets: surviving pairs are verified
there, pairs that earlier links of the block connect are skipped, and only the links found leave the block,
fewer than it has nodes.  So the pairs of a large group are neither written nor joined.  Links between nodes already connected change no
component and ``join`` does not verify them; ``links`` verifies all pairs that the blocks of R-trees leave, and
``link_report`` counts them per document.

Defined cases: documents without words are linked with nothing; with fewer than five words the whole
sequence is the one shingle; a null ``doc_id`` keeps a null component unless its group has another id;
rows of the same ``doc_id`` are judged one by one; an empty table gives an empty result; other columns
are ignored by ``join`` and kept by ``dedup``.  Shingles and sets are compared by 64-bit hashes, groups by
128 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from designlab.llm.stored import components, drop, plain_names, stored
from designlab.llm.textarrays import Words, mix, per_doc, slices, small_batches, text_bytes

SHINGLE = 5
#: groups of the R-tree's points (a power of two); pairs are bounded with up to one group per FILL shingles
GROUPS, FILL = 64, 4
#: most frequent shingles that the global order knows (16 bytes each, on the driver and every executor)
HOT_SHINGLES = 200_000
#: a shingle is counted where this many documents of one slice (HOT_SLICE bytes of text) hold it
HOT_LOCAL, HOT_SLICE = 4, 2 << 20
#: nodes, and bytes of their sets, per block of a residual group
BLOCK = 2000
BLOCK_BYTES = 32 << 20
LEAF = 32


def _sets(batch, most: int = 1 << 20):
    """(part, flat distinct shingle hashes sorted within each document, offsets) per slice."""
    for part in slices(batch, most=most):
        data, offsets = text_bytes(part.column("text"))
        data = data + ((data >= 0x41) & (data <= 0x5A)) * np.uint8(32)
        words = Words(data, offsets)
        hashes = words.hashes(21)
        at, keys = words.windows(hashes, SHINGLE, 21)
        doc = words.doc[at]
        short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
        if len(short):
            own = np.zeros(len(short), np.uint64)
            for j in range(SHINGLE - 1):
                has = words.counts[short] > j
                own[has] = mix(own[has] + hashes[words.first[short[has]] + j])
            keys, doc = np.concatenate([keys, own]), np.concatenate([doc, short])
        # documents with short texts are out of order by now; every document is sorted on its own
        order = np.argsort(doc, kind="stable") if len(short) else slice(None)
        keys, doc = keys[order], doc[order]
        bounds = np.searchsorted(doc, np.arange(words.n_docs + 1)).tolist()
        for x, y in zip(bounds[:-1], bounds[1:], strict=True):
            keys[x:y].sort()
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
        keys, doc = keys[new], doc[new]
        yield part, keys, np.searchsorted(doc, np.arange(words.n_docs + 1)), doc


def _node(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64-bit id of each document's set (its members' mixed hashes, summed and mixed with the count)."""
    n = np.diff(first)
    return mix(per_doc_u64(mix(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first) + n.astype(np.uint64)).view(np.int64)


def per_doc_u64(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    running = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=running[1:])
    return running[first[1:]] - running[first[:-1]]


def _vector(keys: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles per group."""
    groups = max(GROUPS, 1 << (len(keys) // FILL).bit_length())
    return np.bincount((keys & np.uint64(groups - 1)).astype(np.int64), minlength=groups)


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends * data.itemsize]).astype(np.int64)
    big = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()),
                                                               pa.py_buffer(data.tobytes())])
    return big.cast(pa.binary())


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, node, n): set id and set size per document."""
    def run(batches):
        for batch in batches:
            for part, keys, first, _ in _sets(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_node(keys, first)), pa.array(np.diff(first))],
                                                 names=["doc_id", "node", "n"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, node long, n long")


def members(docs: DataFrame) -> DataFrame:
    """``sizes`` with ``vec``: group counts (little-endian 32-bit) per document.

    Long sets have more groups, a power of two with at most FILL shingles each, or the bound would prune little.
    """
    def run(batches):
        for batch in batches:
            for part, keys, first, doc in _sets(batch):
                bounds = first.tolist()
                vecs = [_vector(keys[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                vec = np.concatenate(vecs).astype("<u4") if vecs else np.zeros(0, "<u4")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(_node(keys, first)), pa.array(np.diff(first)),
                    _binary(vec, np.cumsum([len(v) for v in vecs], dtype=np.int64))], names=["doc_id", "node", "n", "vec"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, node long, n long, vec binary"))


def hot_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted shingles, level) of the most frequent shingles; level is the bit length of the count."""
    def run(batches):
        for batch in batches:
            for _, keys, _, _ in _sets(batch, HOT_SLICE):
                found, count = np.unique(keys, return_counts=True)
                hot = count >= HOT_LOCAL
                yield pa.RecordBatch.from_arrays([pa.array(found[hot].view(np.int64)), pa.array(count[hot])],
                                                 names=["key", "n"])

    rows = (docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "key").limit(HOT_SHINGLES).toPandas())
    keys = rows["key"].to_numpy(np.int64).view(np.uint64)
    level = np.frexp(rows["n"].to_numpy(np.float64))[1].astype(np.int64)
    order = np.argsort(keys)
    return keys[order], level[order]


def prefixes(docs: DataFrame, hot) -> DataFrame:
    """(key, node): each set's first n - ceil(0.8 n) + 1 shingles in the global order."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        known, levels = shared.value
        for batch in batches:
            for _, keys, first, doc in _sets(batch):
                n = np.diff(first)
                level = np.zeros(len(keys), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                    level = np.where(known[at] == keys, levels[at], 0)
                order = np.arange(len(keys))
                for d in np.unique(doc[level > 0]).tolist():
                    x, y = first[d], first[d + 1]
                    order[x:y] = x + np.argsort(level[x:y], kind="stable")
                rank = np.arange(len(keys)) - first[doc]
                take = rank < (n - (4 * n + 4) // 5 + 1)[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[order][take].view(np.int64)), pa.array(_node(keys, first)[doc[take]])],
                    names=["key", "node"])

    return docs.select("text").mapInArrow(run, "key long, node long")


def sets_of(docs: DataFrame) -> DataFrame:
    """(node, items): the sorted 64-bit shingles of every document's set."""
    def run(batches):
        for batch in batches:
            for _, keys, first, _ in _sets(batch):
                yield pa.RecordBatch.from_arrays([pa.array(_node(keys, first)), _binary(keys, first[1:])],
                                                 names=["node", "items"])

    return docs.select("text").mapInArrow(run, "node long, items binary")


def may_link(x: np.ndarray, y: np.ndarray, sizes: int) -> bool:
    """The count-vector bound of two sets with ``sizes`` shingles together allows a link."""
    if len(x) != len(y):
        both = min(len(x), len(y))
        x, y = _folded(x, both), _folded(y, both)
    return 9 * int(np.minimum(x, y).sum()) >= 4 * sizes


def bounded(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that the count-vector bound allows."""
    left = nodes.select(F.col("node").alias("a"), F.col("vec").alias("vec_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("vec").alias("vec_b"))

    def run(batches):
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("vec_a"), batch.column("vec_b"), strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), "<u4") for v in (x, y))
                ok[i] = may_link(x, y, int(x.sum()) + int(y.sum()))
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def _items(needed: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, items): the sets of the needed nodes and of some others."""
    # one row per needed node: copies of one text go before their sets are read
    first = nodes.join(needed, "node").select("node", "doc_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return (sets_of(texts.join(first, texts["doc_id"].eqNullSafe(first["doc_id"]), "left_semi"))
            .groupBy("node").agg(F.first("items").alias("items")))


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    close = stored(pairs)
    # not written: both joins read the exchange that drops duplicates
    items = _items(close.select(F.col("a").alias("node")).union(close.select("b")).distinct(), docs, nodes)
    both = (close.join(items.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
            .join(items.select(F.col("node").alias("b"), F.col("items").alias("y")), "b"))

    def run(batches):
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                ok[i] = linked(x, y)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return both.mapInArrow(run, "a long, b long")


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Two sorted sets have four fifths of their union in common."""
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return 9 * int(np.count_nonzero(y[at] == x)) >= 4 * (len(x) + len(y))


def _folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """Counts of fewer groups (both numbers are powers of two and groups are taken modulo them)."""
    return counts.reshape(-1, groups).sum(0, dtype=np.int64)


class CountTree:
    """Two levels of boxes over count vectors, packed by set size and then by the widest groups."""

    def __init__(self, points: np.ndarray):
        self.sizes = points.sum(1)
        widest = np.argsort(-points.var(0), kind="stable")[:2] if len(points) else [0, 1]
        self.order = np.lexsort((points[:, widest[1]], points[:, widest[0]], self.sizes))
        self.points, self.sizes = points[self.order], self.sizes[self.order]
        self.levels = []
        top, low = self.points, self.sizes
        while len(top) > 1 and len(self.levels) < 2:
            at = np.arange(0, len(top), LEAF)
            top, low = np.maximum.reduceat(top, at), np.minimum.reduceat(low, at)
            self.levels.append((top, low))

    def search(self, point: np.ndarray) -> np.ndarray:
        """Rows whose overlap bound with ``point`` allows a link."""
        size = point.sum()
        rows = None
        for top, low in [*self.levels[::-1], (self.points, self.sizes)]:
            if rows is None:
                rows = np.arange(len(top))
            else:
                rows = (rows[:, None] * LEAF + np.arange(LEAF)).ravel()
                rows = rows[rows < len(top)]
            rows = rows[9 * np.minimum(top[rows], point).sum(1) >= 4 * (low[rows] + size)]
        return self.order[rows]


class Block:
    """Two blocks of one shingle's nodes (or one block with itself) and the pairs between them."""

    def __init__(self, table: pa.Table, vecs: list[np.ndarray]):
        side = table.column("side").to_numpy()
        self.node, self.comp = table.column("node").to_numpy(), table.column("comp").to_numpy()
        self.vecs = vecs
        self.points = np.array([_folded(v, GROUPS) for v in vecs]).reshape(-1, GROUPS)
        self.sizes = self.points.sum(1)
        self.left, self.right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        self.within = not len(self.right)
        if self.within:
            self.right = self.left
        self.tree = CountTree(self.points[self.left])

    def candidates(self):
        """(row, rows) of each right row: those on the left of other components that the bound allows."""
        for r in self.right.tolist():
            hit = self.left[self.tree.search(self.points[r])]
            hit = hit[(self.comp[hit] != self.comp[r]) & ((self.node[hit] < self.node[r]) | (not self.within))]
            # long sets once more by their finer counts
            yield r, [h for h in hit.tolist() if len(self.vecs[h]) == len(self.vecs[r]) == GROUPS
                      or may_link(self.vecs[h], self.vecs[r], int(self.sizes[h] + self.sizes[r]))]


def _counted(table: pa.Table) -> Block:
    return Block(table, [np.frombuffer(v, "<u4") for v in table.column("vec").to_pylist()])


def _block_pairs(table: pa.Table) -> pa.Table:
    """Unconnected pairs across two blocks of one shingle's nodes that survive the bound."""
    block, a, b = _counted(table), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for r, hit in block.candidates():
        a.append(np.minimum(block.node[hit], block.node[r]))
        b.append(np.maximum(block.node[hit], block.node[r]))
    return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})


def _forest(block: Block, joins) -> pa.Table:
    """Pairs (a, b) for which ``joins(row, row)`` holds, without those that earlier pairs or components connect."""
    top = {c: c for c in block.comp.tolist()}

    def find(c):
        while top[c] != c:
            top[c] = top[top[c]]
            c = top[c]
        return c

    comp, a, b = block.comp.tolist(), [], []
    for r, hit in block.candidates():
        for h in hit:
            x, y = find(comp[h]), find(comp[r])
            if x != y and joins(h, r):
                top[x] = y
                a.append(int(block.node[h]))
                b.append(int(block.node[r]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _block_forest(table: pa.Table) -> pa.Table:
    """Surviving pairs that connect the block's components as far as all of them do."""
    return _forest(_counted(table), lambda x, y: True)


def _block_links(table: pa.Table) -> pa.Table:
    """Links (a, b) that connect the components of two blocks of nodes as far as all their links do."""
    items = [np.frombuffer(v, np.uint64) for v in table.column("items").to_pylist()]
    return _forest(Block(table, [_vector(x) for x in items]), lambda x, y: linked(items[x], items[y]))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of (key, node, ...) with ``blocks`` per key, dealt to the pairs (i, j) of their key's blocks."""
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return rows.select("*", other).withColumns({
        "i": F.least("own", "other"), "j": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int"),
    }).drop("own", "other", "blocks")


def _unsettled(groups: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, comp, vec, i, j, side): nodes of the shingles whose nodes lie in several components, dealt."""
    named = stored(groups.join(labels, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp")))
    code = [F.sum(F.xxhash64("node", *salt).cast("decimal(20,0)")).alias(f"code{len(salt)}") for salt in ((), (F.lit(1),))]
    split = (named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"), *code)
             .where("lo < hi"))
    # shingles with the same nodes are one group
    split = split.groupBy("size", "code0", "code1").agg(F.min("key").alias("key"))
    return _dealt(named.join(split.select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "key")
                  .join(nodes.select("node", "vec"), "node"))


def residual_pairs(groups: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of nodes that share a prefix shingle but not yet a component."""
    return (_unsettled(groups, nodes, labels).groupBy("key", "i", "j").applyInArrow(_block_pairs, "a long, b long").distinct())


def residual_links(groups: DataFrame, docs: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Links (a, b) that connect the components as far as all links among nodes with a common prefix shingle do.

    Pairs that survive the bound connect the components to clusters; a block tells only enough of them to do
    that.  Every surviving pair lies in one cluster, where its nodes meet with their whole sets.
    """
    near = stored(_unsettled(groups, nodes, labels).groupBy("key", "i", "j")
                  .applyInArrow(_block_forest, "a long, b long").distinct())
    # a component is one node of the cluster graph: its own nodes need no pairs among each other
    own = labels.select("node", "comp")

    def top(side: str) -> DataFrame:
        return own.select(F.col("node").alias(side), F.col("comp").alias(f"{side}_comp"))

    tops = near.join(top("a"), "a", "left").join(top("b"), "b", "left").select(
        F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b"))
    clusters = components(tops).select(F.col("node").alias("comp"), F.col("comp").alias("key"))
    members_of = nodes.select("node").join(own, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"))
    some = stored(members_of.join(clusters, "comp").select("key", "node", "comp"))
    sets = stored(some.join(_items(some.select("node"), docs, nodes), "node"))
    drop(near, some)
    size = sets.groupBy("key").agg(F.count("*").alias("size"), F.sum(F.octet_length("items")).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    return (_dealt(sets.join(size.select("key", blocks.alias("blocks")), "key")).groupBy("key", "i", "j")
            .applyInArrow(_block_links, "a long, b long"))


def _prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members of docs, one row per node, (key, node, lo) of shared prefix shingles with their smallest node)."""
    rows = stored(sizes(small_batches(docs)))
    nodes = stored(members(docs).where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("vec").alias("vec")))
    keys = prefixes(docs, hot_shingles(docs))
    shared = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    return rows, nodes, stored(keys.join(shared.select("key", "lo"), "key").distinct())


def _all_links(docs: DataFrame, nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """Every linked pair (a, b) of nodes, a < b, from the R-tree blocks of every shared prefix shingle."""
    apart = docs.sparkSession.createDataFrame([], "node long, comp long")
    return stored(verified(residual_pairs(groups.select("key", "node"), nodes, apart), docs, nodes))


def _star_links(docs: DataFrame, nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """Links (a, b) among one pair per node: with the smallest node that it shares most prefix shingles with."""
    star = (groups.where("node <> lo").groupBy("node", "lo").agg(F.count("*").alias("times"))
            .groupBy("node").agg(F.max(F.struct("times", "lo")).alias("best"))
            .select(F.col("best.lo").alias("a"), F.col("node").alias("b")))
    return stored(verified(bounded(star, nodes), docs, nodes))


def _named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with their component's smallest id (``component_id``)."""
    named = rows.join(labels, "node", "left").withColumn("comp", F.when(F.col("n") > 0, F.coalesce("comp", "node")))
    best = named.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return named.join(best, "comp", "left").withColumn(
        "component_id", F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")))


def links(docs: DataFrame) -> DataFrame:
    """The join: every pair (a, b) of linked nodes, a < b; ``members`` has the node of every document.

    Documents of one node have equal sets and are linked with each other too, without a row here.
    """
    _, nodes, groups = _prepared(docs)
    return _all_links(docs, nodes, groups)


def link_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id): how many other documents each one is linked with."""
    rows, nodes, groups = _prepared(docs)
    edges = _all_links(docs, nodes, groups)
    copies = rows.where("n > 0").groupBy("node").agg(F.count("*").alias("copies"))
    others = (edges.union(edges.select("b", "a")).join(copies.withColumnRenamed("node", "b"), "b")
              .groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("others")))
    count = copies.join(others, "node", "left").select(
        "node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return _named(rows, components(edges)).join(count, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id")


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    return _connected(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _connected(docs: DataFrame) -> DataFrame:
    """``members`` of docs with their ``comp`` and ``component_id``."""
    rows, nodes, groups = _prepared(docs)
    edges = _star_links(docs, nodes, groups)
    labels = components(edges)
    more = stored(residual_links(groups.select("key", "node"), docs, nodes, labels))
    drop(nodes, groups)
    if not more.isEmpty():
        labels = components(edges.union(more))
    drop(edges, more)
    return _named(rows, labels)


def _with_node(docs: DataFrame) -> DataFrame:
    """``docs`` with each row's ``node`` and set size ``n``."""
    def run(batches):
        for batch in batches:
            for part, keys, first, _ in _sets(batch):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(_node(keys, first)), pa.array(np.diff(first))],
                                                 names=[*part.schema.names, "node", "n"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("node", LongType()), StructField("n", LongType())]))


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: that of smallest ``doc_id`` (rows without an id or without words stay).

    Rows of a repeated ``doc_id`` are judged by their own sets; of a group's rows with its smallest id, one of the
    smallest node stays.
    """
    plain = plain_names(docs)
    found = stored(_connected(docs).select("doc_id", "node", "n", "comp", "component_id"))
    repeated = (found.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_rows"))
                .where("_rows > 1").select("_id"))
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_id")).union(repeated).distinct()
    stay = (found.where("n > 0 and doc_id = component_id").groupBy(F.col("component_id").alias("_id"), "comp")
            .agg(F.min("node").alias("_node")))
    single = plain.join(gone, plain["doc_id"] == gone["_id"], "left_anti")
    several = _with_node(plain.join(repeated, plain["doc_id"] == repeated["_id"], "left_semi"))
    first = (several.join(stay, (several["doc_id"] == stay["_id"]) & (several["node"] == stay["_node"]), "left_semi")
             .where("n > 0").dropDuplicates(["doc_id", "node"]))
    return (single.union(first.select(*plain.columns)).union(several.where("n = 0").select(*plain.columns))
            .toDF(*docs.columns))


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5_number(array_to_string(w[i:i + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY 1, 2),
e AS MATERIALIZED (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * i >= 80 * (na.n + nb.n - i)),
r AS (SELECT a AS doc_id, a AS c FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.c),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(c, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""
# the same links, counted per document
OP9_LINKS_SQL = OP9_SQL.replace("AS n_shingles, ", """AS n_shingles,
  coalesce(l.n_links, 0)::BIGINT AS n_links, """).rstrip() + """
  LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM e GROUP BY a) l USING (doc_id)
"""
