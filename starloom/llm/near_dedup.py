"""Near-dedup: chosen-path set similarity join over word shingles.

A document is its set of distinct five-word shingles (64-bit hashes).  Equal
sets collapse first to one representative, so exact copies cost one row
however many there are.  Then, in each of ``trees`` independent trees,
representatives branch by their minwise token under the hash function of
the tree and depth: the children of a node are the documents that chose the
same token.  A node of at most ``leaf`` members is compared; larger nodes
branch again, down to ``depth``.  Two sets of similarity j stay together
through d levels with probability j**d, so with j = 0.75, depth 3 and 16
trees a pair that only ever meets in the deepest nodes is missed with
probability (1 - 0.42)**16 = 0.0002, one that meets in small nodes with
far less.

Nodes are compared without listing their pairs.  First every member meets the
node's smallest one; links confirmed on full sets give components, and nodes
whose members already hang together are done (the usual case, however many
near copies a node holds).  In the other small nodes every member outside the
component of the node's smallest member meets every member of other components.
Other large nodes hold documents that share a common passage and little else:
their members branch on, in ``deep_trees`` trees straight to ``deep`` levels,
where a pair of similarity 0.75 meets at least once with probability
1 - (1 - 0.75**10)**128 = 0.9994 and one of 0.4 with probability 0.013; the nodes
there are compared in the same two steps, where a pair that shares nodes of several
trees is taken in one of them.  A link that is not tested joins
documents that are connected already, so the components are those of all links.

Defined results
* null or empty text, or text without words: an empty set, linked with nothing.
* fewer than five words: the whole word sequence is the only shingle.
* repeated rows have equal sets and share a component.
* a row is known by a 64-bit hash of its id and text, so different texts of one
  doc_id are different documents, and so are texts without one; two rows of one
  hash (among n different ones with probability n**2 / 2**65) could cost a link.
* a null doc_id takes part and names no component: the smallest id that is not
  null does.  Where a component has none, component_id is null and ``kept``
  marks one text of it (and its repeated rows).
* other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import batch_bytes, bitmap_place, id_bitmap, in_bitmap, lowered, mix, prefix_hash, span_hash, stored, word_spans
from starloom.llm.graph import connected_components

SEEDS = np.random.default_rng(30).integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles of the texts, with repeats, and the first shingle's index of each text."""
    data = lowered(data)
    starts, ends, first = word_spans(data, offsets)
    words = span_hash(prefix_hash(data), starts, ends)
    counts = np.diff(first)
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    at = np.concatenate(([0], np.cumsum(n)))
    lead = np.repeat(first[:-1] - at[:-1], n) + np.arange(at[-1])
    out = np.zeros(len(lead), np.uint64)
    for j in range(k):
        # places after a short text's last word hold the same filler in every text
        within = lead + j < np.repeat(first[1:], n)
        word = np.where(within, words[np.minimum(lead + j, max(len(words) - 1, 0))], np.uint64(7 + j)) if len(words) else out
        out = out * np.uint64(0x9E3779B97F4A7C15) + mix(word + np.uint64(j))
    return mix(out), at


def distinct_shingles(column, k: int):
    """(rows of the batch, sorted distinct hashes, offsets) for runs of rows of an Arrow column."""
    for row, data, offsets in batch_bytes(column):
        h, at = shingle_hashes(data, offsets, k)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
        order = np.argsort(h, kind="stable")
        order = order[np.argsort(owner[order], kind="stable")]
        h, owner = h[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, owner = h[new], owner[new]
        yield row, h, np.searchsorted(owner, np.arange(len(offsets)))


def _reduce(ufunc, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """ufunc over each text's hashes; 0 for a text without any."""
    n = len(at) - 1
    out = np.zeros(n, np.uint64)
    full = np.flatnonzero(np.diff(at) > 0)
    if len(full):
        out[full] = ufunc.reduceat(values, at[full])
    return out


def _profiles(trees: int, depth: int, k: int):
    def run(batches):
        for batch in batches:
            sizes, f1, f2, keys = [], [], [], []
            for _, h, at in distinct_shingles(batch.column(1), k):
                sizes.append(np.diff(at).astype(np.int64))
                f1.append(_reduce(np.add, mix(h), at))
                f2.append(_reduce(np.bitwise_xor, mix(h ^ SEEDS[-1]), at))
                paths = np.zeros((len(at) - 1, trees, depth), np.uint64)
                for t in range(trees):
                    path = np.full(len(at) - 1, t, np.uint64)
                    for d in range(depth):
                        token = _reduce(np.minimum, (h ^ SEEDS[2 * (t * depth + d)]) * SEEDS[2 * (t * depth + d) + 1], at)
                        path = mix(path * np.uint64(31) + token + np.uint64(d))
                        paths[:, t, d] = path
                keys.append(paths.reshape(len(at) - 1, -1))
            cat = lambda x, kind: np.concatenate(x).view(kind) if x else np.zeros(0, kind)
            all_keys = np.concatenate(keys).view(np.int64) if keys else np.zeros((0, trees * depth), np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, all_keys.size + 1, trees * depth, dtype=np.int32), all_keys.ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(cat(sizes, np.int64)), pa.array(cat(f1, np.int64)), pa.array(cat(f2, np.int64)), lists],
                names=["doc_id", "id", "n_shingles", "f1", "f2", "paths"])

    return run


def _wanted(batches, bitmap):
    """Batches (id, text) of the rows whose id may be wanted."""
    for batch in batches:
        keep = in_bitmap(bitmap.value, batch.column(2).to_numpy())
        if keep.any():
            yield batch.filter(pa.array(keep))


def _deep_nodes(bitmap, trees: int, depth: int, k: int):
    """(nodes, rep, size, sketch): the node of every deep tree that a document falls into, and two bits of each minwise token."""

    def run(batches):
        for batch in _wanted(batches, bitmap):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, h, at in distinct_shingles(batch.column(1), k):
                n = len(at) - 1
                nodes, bits = np.zeros((n, trees), np.uint64), np.zeros((n, trees * depth, 2), np.uint8)
                for t in range(trees):
                    path = np.full(n, t + 1, np.uint64)
                    for d in range(depth):
                        s = 400 + 2 * (t * depth + d)
                        token = _reduce(np.minimum, (h ^ SEEDS[s]) * SEEDS[s + 1], at)
                        path = mix(path * np.uint64(31) + token)
                        two = mix(token)
                        bits[:, t * depth + d, 0] = (two & np.uint64(1)).astype(np.uint8)
                        bits[:, t * depth + d, 1] = (two >> np.uint64(1) & np.uint64(1)).astype(np.uint8)
                    nodes[:, t] = path
                sketch = np.packbits(bits.reshape(n, -1), axis=1).view(np.int64)
                lists = lambda x: pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())
                yield pa.RecordBatch.from_arrays([lists(nodes.view(np.int64)), pa.array(ids[row:row + n]), pa.array(np.diff(at)), lists(np.ascontiguousarray(sketch))],
                                                 names=["nodes", "rep", "size", "sketch"])

    return run


def _sets(bitmap, k: int):
    def run(batches):
        for batch in _wanted(batches, bitmap):
            for row, h, at in distinct_shingles(batch.column(1), k):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(at) - 1), pa.ListArray.from_arrays(at.astype(np.int32), h.view(np.int64))], names=["id", "set"])

    return run


def sketches_agree(a: str, b: str, words: int, percent: int, deviations: float = 4.5):
    """Whether two sketches of two-bit fields allow the similarity j: a field differs with probability
    0.75 * (1 - j), and no more may differ than ``deviations`` standard deviations above what is expected
    at the threshold (which bars one linked pair in 300,000 there)."""
    fields, p = 32 * words, 0.75 * (1 - percent / 100)
    most = int(p * fields + deviations * float(np.sqrt(p * (1 - p) * fields)))

    def differing(i: int):
        x = F.get(F.col(a), i).bitwiseXOR(F.get(F.col(b), i))
        return F.bit_count(x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    return sum((differing(i) for i in range(words)), F.lit(0)) <= most


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and ``id``, the hash of both that a row is known by."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.withColumn("id", F.xxhash64("doc_id", "text"))


def profiles(docs: DataFrame, trees: int, depth: int, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, id, n_shingles, a fingerprint of the set (f1, f2) and the path keys of every row."""
    return keyed_texts(docs, id_col, text_col).mapInArrow(
        _profiles(trees, depth, k), "doc_id long, id long, n_shingles long, f1 long, f2 long, paths array<long>")


def leaf_members(reps: DataFrame, trees: int, depth: int, leaf: int) -> DataFrame:
    """(node, rep, size) of every node with two members or more at which branching stops;
    only nodes of the last level have more than ``leaf`` members."""
    one = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.slice(F.col("paths"), t * depth + 1, depth))
    rows = reps.select("rep", F.col("n_shingles").alias("size"), F.explode(one).alias("path"))
    out = None
    for d in range(depth):
        rows = rows.withColumn("node", F.element_at("path", d + 1))
        nodes = rows.groupBy("node").agg(F.count("*").alias("_members")).filter("_members > 1")
        rows = stored(rows.join(nodes, "node"), f"depth{d}")
        done = (rows if d == depth - 1 else rows.filter(F.col("_members") <= leaf)).select("node", "rep", "size")
        out = done if out is None else out.unionByName(done)
        rows = rows.filter(F.col("_members") > leaf).drop("node", "_members")
    return out


def similar_size(a: str, b: str, percent: int):
    """Necessary for similarity: the smaller set reaches the threshold's share of the larger."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def crossed(placed: DataFrame, percent: int, words: int = 0) -> DataFrame:
    """(a, b): members outside the component of their node's smallest, with all members of other components.
    With ``words`` the sketches of both must agree, and a pair comes only from the first of the nodes it
    shares (``shared`` lists a member's nodes), so as many rows are made as there are pairs."""
    extra = ("sketch", "shared") if words else ()
    outside = placed.filter("comp <> hub_comp").select("node", F.col("rep").alias("_r"), F.col("size").alias("_z"), F.col("comp").alias("_c"),
                                                       *[F.col(c).alias("_" + c) for c in extra])
    allowed = (F.col("comp") != F.col("_c")) & (F.col("rep") != F.col("hub")) & similar_size("size", "_z", percent)
    allowed = allowed & ((F.col("comp") == F.col("hub_comp")) | (F.col("rep") < F.col("_r")))  # two outside members meet once
    if words:
        allowed = allowed & sketches_agree("sketch", "_sketch", words, percent) & (F.array_min(F.array_intersect("shared", "_shared")) == F.col("node"))
    return placed.join(outside, "node").filter(allowed).select(F.greatest("rep", "_r").alias("a"), F.least("rep", "_r").alias("b")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * |A and B| >= percent * |A or B|."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("_sa")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("set").alias("_sb")), "b")
    shared = F.size(F.array_intersect("_sa", "_sb"))
    return both.filter(100 * shared >= percent * (F.size("_sa") + F.size("_sb") - shared)).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = 75, k: int = 5, trees: int = 16, depth: int = 3, leaf: int = 8,
                    deep_trees: int = 128, deep: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    rows = stored(profiles(docs, trees, depth, k, id_col, text_col), "profiles")
    full = rows.filter("n_shingles > 0")
    classes = (full.groupBy("n_shingles", "f1", "f2")
               .agg(F.min("id").alias("rep"), F.min("doc_id").alias("doc"), F.first("paths").alias("paths")))
    texts = keyed_texts(docs, id_col, text_col).select("id", "text", bitmap_place(F.col("id")).alias("_h"))
    context = docs.sparkSession.sparkContext

    def confirm(pairs: DataFrame) -> DataFrame:
        """Full sets are made where the texts lie, for documents in ``pairs``, and only the sets travel."""
        wanted = context.broadcast(id_bitmap(pairs.select(F.col("a").alias("_w")).unionByName(pairs.select(F.col("b").alias("_w"))), "_w"))
        sets = stored(texts.mapInArrow(_sets(wanted, k), "id long, set array<long>"), "sets").dropDuplicates(["id"])
        return confirmed(pairs, sets, percent)

    def grown(component: DataFrame, links: DataFrame) -> DataFrame:
        """The components of the new links and of those that made ``component``."""
        held = component.filter("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
        return connected_components(stored(held.unionByName(confirm(links)), "links"))

    def stars_of(members: DataFrame) -> DataFrame:
        """Every member with the smallest of its node."""
        hubs = members.groupBy("node").agg(F.min(F.struct("rep", "size")).alias("_hub"))
        return (members.join(hubs, "node").filter(F.col("rep") > F.col("_hub.rep"))
                .filter(similar_size("size", "_hub.size", percent))
                .select(F.col("rep").alias("a"), F.col("_hub.rep").alias("b")).distinct())

    def mixed_of(members: DataFrame, component: DataFrame) -> DataFrame:
        """Members, with components, of the nodes that hold more than one component."""
        placed = members.join(component.withColumnRenamed("id", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep"))
        nodes = (placed.groupBy("node").agg(F.min(F.struct("rep", "comp")).alias("_hub"), F.min("comp").alias("_lo"), F.max("comp").alias("_hi"),
                                            F.count("*").alias("members")).filter("_lo < _hi"))
        return placed.join(nodes, "node").select("node", "rep", "size", "comp", F.col("_hub.rep").alias("hub"), F.col("_hub.comp").alias("hub_comp"), "members")

    members = stored(leaf_members(classes, trees, depth, leaf), "leaves")
    stars = stored(stars_of(members), "stars")
    component = connected_components(stored(confirm(stars), "links"))

    mixed = stored(mixed_of(members, component), "mixed")
    rest = crossed(mixed.filter(F.col("members") <= leaf), percent)
    far = stored(mixed.filter(F.col("members") > leaf).select(F.col("rep").alias("_w")).distinct(), "far")
    deep_members = None
    if not far.isEmpty():
        wanted = context.broadcast(id_bitmap(far, "_w"))
        found = stored(texts.mapInArrow(_deep_nodes(wanted, deep_trees, deep, k), "nodes array<long>, rep long, size long, sketch array<long>")
                       .join(far, F.col("rep") == F.col("_w"), "left_semi").dropDuplicates(["rep"]), "sketches")
        nodes = found.select("rep", "size", F.explode("nodes").alias("node"))
        groups = nodes.groupBy("node").agg(F.count("*").alias("_n")).filter("_n > 1").select("node")
        deep_members = stored(nodes.join(stored(groups, "groups"), "node"), "deep")
        rest = rest.unionByName(stars_of(deep_members)).distinct()
    rest = stored(rest.join(stars, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        component = grown(component, rest)
    if deep_members is not None:
        placed = stored(mixed_of(deep_members, component), "deep_mixed")
        lists = placed.groupBy("rep").agg(F.collect_list("node").alias("shared"))  # one node of each deep tree at most
        placed = placed.join(stored(lists.join(found.select("rep", "sketch"), "rep"), "deep_lists"), "rep")
        last = stored(crossed(placed, percent, deep_trees * deep // 32).join(rest, ["a", "b"], "left_anti"), "last")
        if not last.isEmpty():
            component = grown(component, last)

    # the smallest doc_id of every component; a class without links is its own
    linked = classes.select("rep", "doc").join(component, F.col("rep") == F.col("id"))
    first = linked.groupBy("component").agg(F.min("doc").alias("_doc"))
    placed = component.join(first, "component").select(F.col("id").alias("rep"), F.col("component").alias("_rep"), "_doc")
    named = classes.select("n_shingles", "f1", "f2", "rep", "doc").join(placed, "rep", "left").select(
        "n_shingles", "f1", "f2", F.coalesce("_rep", "rep").alias("_rep"), F.when(F.col("_rep").isNull(), F.col("doc")).otherwise(F.col("_doc")).alias("_doc"))
    out = rows.select("doc_id", "id", "n_shingles", "f1", "f2").join(named, ["n_shingles", "f1", "f2"], "left")
    component_id = F.when(F.col("n_shingles") > 0, F.col("_doc")).otherwise(F.col("doc_id"))
    kept = F.when(component_id.isNull() & (F.col("n_shingles") > 0), F.col("id") == F.col("_rep")).otherwise(F.col("doc_id").eqNullSafe(component_id))
    return out.select("doc_id", "n_shingles", component_id.alias("component_id"), kept.alias("kept"))
