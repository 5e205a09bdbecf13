"""Exact Jaccard join of word shingles with signature trees.

Documents link when ``percent`` * (union of their shingle sets) <= 100 *
(intersection); the result gives every document its class of equal sets and its
component of links.  Nothing is sampled and no link is lost:

1. *Sets.*  One pass computes each document's set size and a 128-bit key of
   the set; equal keys are one class, which goes on as its first document.
2. *Shared shingles.*  A link misses at most n - ceil(percent * n / 100) of a
   document's n shingles.  Shingles whose hash falls into a quarter of the hash
   space are brought together (one row per document and block of input, four
   bytes a shingle); a document that has more unshared ones among them
   cannot link and leaves here, before any set travels.
3. *Clusters.*  For the documents left, shingles are ordered rare first; those
   nobody shares count as missing, and two linked documents share one of
   the first (allowed misses + 1) others.  Documents connected through such
   shingles form a cluster, so links stay within clusters.
4. *Signature trees.*  A cluster is cut into blocks of bounded size, and pairs
   of blocks are joined by a dual traversal of two trees whose nodes hold the
   OR of their documents' bitmaps and the range of their sizes: a pair of nodes
   is left when no pair below can overlap enough.  Pairs that remain are
   verified exactly, and pairs already connected are skipped, so a block gives
   at most a spanning forest, never all pairs of a group.  Large clusters are
   first joined within blocks of two random cuts; only what is not connected
   by then meets across blocks.

Words are runs of non-white bytes with A-Z lower-cased; a document with fewer
words than a shingle has its whole sequence as one shingle.  Null and empty texts
and texts without words have no shingles, link with nothing and are their own
component.  Repeated rows (same id and text) get the same result; rows that
share only the id are told apart by their texts; null ids come first.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.lineage import materialize
from quire.llm.common import (
    SpanHash,
    bounded_batches,
    byte_codes,
    connected_components,
    document_groups,
    ids_unique,
    mix64,
    shuffle_partitions,
    string_buffer,
    tidy,
    with_unique_key,
)

SHINGLE, PERCENT = 4, 85
SAMPLED = 4  # one shingle in so many takes part in the test for shared shingles
BLOCK_BYTES = 4 << 20
BLOCK_DOCS, BLOCK_TOKENS = 1024, 1 << 20
SIGNATURE_BITS = 8192
FANOUT = 16


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all documents, n + 1 offsets)."""
    codes = byte_codes(4, lower=True)
    white = np.zeros(256, bool)
    white[[0x20, *range(0x09, 0x0E)]] = True
    owners, hashes = [], []
    for i, j in document_groups(offsets):
        a, b = int(offsets[i]), int(offsets[j])
        part = raw[a:b]
        if not len(part):
            continue
        gap = white[part]
        edge = np.ones(len(part), bool)
        edge[1:] = gap[1:] != gap[:-1]
        bounds = offsets[i:j] - a
        edge[bounds[bounds < len(part)]] = True
        start = np.flatnonzero(edge)
        end = np.append(start[1:], len(part))
        keep = ~gap[start]
        start, end = start[keep], end[keep]
        if not len(start):
            continue
        owner = np.searchsorted(offsets, start + a, "right") - 1
        word = mix64(SpanHash(part, codes).spans(start, end) + (end - start).astype(np.uint64))
        full = word.copy()
        full, n = word[: len(word) - words + 1].copy() if len(word) >= words else word[:0], words
        for k in range(1, words):
            full = mix64(full * np.uint64(3) + word[k : len(word) - words + 1 + k])
        whole = owner[: len(full)] == owner[n - 1 : n - 1 + len(full)] if len(full) else np.zeros(0, bool)
        owners.append(owner[: len(full)][whole])
        hashes.append(full[whole])
        # sequences that are too short, folded word by word and marked by their length
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        count = np.diff(np.append(first, len(owner)))
        for m in range(1, words):
            f = first[count == m]
            x = np.full(len(f), m, np.uint64)
            for k in range(m):
                x = mix64(x * np.uint64(5) + word[f + k])
            owners.append(owner[f])
            hashes.append(x)
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    value = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[new], value[new]
    return value, np.searchsorted(owner, np.arange(len(offsets)))


def set_keys(value: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit key of each set, as two signed words; 0 for empty sets."""
    out = []
    for salt in (0, 0x5851F42D4C957F2D):
        sums = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(mix64(value ^ np.uint64(salt)), out=sums[1:])
        out.append((sums[cuts[1:]] - sums[cuts[:-1]]).view(np.int64))
    return out[0], out[1]


def allowed_misses(n: Column, percent: int) -> Column:
    """Shingles a linked document of ``n`` can lack in its partner."""
    return (n - F.ceil(F.lit(percent) * n / 100)).cast("long")


_DOC = "doc long, n long, sampled long, k1 long, k2 long, shared long"
_DOC_NAMES = ["doc", "n", "sampled", "k1", "k2", "shared"]


def _pack(doc: np.ndarray, token: np.ndarray) -> bytes:
    body = struct.pack("<I", len(doc)) + np.diff(doc, prepend=0).astype("<i8").tobytes() + token.astype("<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(block)
    (n,) = struct.unpack_from("<I", body)
    return np.cumsum(np.frombuffer(body, "<i8", n, 4)), np.frombuffer(body, "<u4", n, 4 + 8 * n)


def document_sets(keyed: DataFrame, text: str, words: int = SHINGLE) -> DataFrame:
    """(doc, n, sampled, k1, k2, shared) per document key: set size, shingles in
    the sampled quarter, key of the set, and how many of the sampled ones some
    other document has too (for the first document of its set in a block)."""
    spark = keyed.sparkSession
    bounded_batches(spark)
    parts = shuffle_partitions(spark)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(held):
            docs = np.concatenate([k for k, _, _ in held])
            raw = np.concatenate([r for _, r, _ in held])
            offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(o) for _, _, o in held]))])
            value, cuts = shingle_sets(raw, offsets, words)
            n = np.diff(cuts)
            k1, k2 = set_keys(value, cuts)
            owner = np.repeat(np.arange(len(docs)), n)
            pick = value % np.uint64(SAMPLED) == 0
            sampled = np.bincount(owner[pick], minlength=len(docs))
            size = len(docs)
            spread = pa.array((np.arange(size) % parts).astype(np.int32))
            columns = [pa.array(np.asarray(c, np.int64)) for c in (docs, n, sampled, k1, k2, np.zeros(size))]
            yield pa.RecordBatch.from_arrays([spread, pa.nulls(size, pa.binary()), *columns], names=["part", "block", *_DOC_NAMES])
            # the first document of each set speaks for its copies in this block
            order = np.lexsort((docs, k2, k1))
            first = np.ones(size, bool)
            first[1:] = (k1[order[1:]] != k1[order[:-1]]) | (k2[order[1:]] != k2[order[:-1]])
            speaks = np.zeros(size, bool)
            speaks[order[first]] = True
            pick &= speaks[owner]
            token, doc = value[pick] // np.uint64(SAMPLED), docs[owner[pick]]
            part = (token % np.uint64(parts)).astype(np.int64)
            by_part = np.lexsort((doc, part))
            token, doc, part = token[by_part] // np.uint64(parts), doc[by_part], part[by_part]
            edge = np.flatnonzero(np.diff(part, prepend=-1))
            packed = [_pack(doc[a:b], token[a:b]) for a, b in zip(edge, np.append(edge[1:], len(part)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[edge], pa.int32()), pa.array(packed, pa.binary()), *[pa.nulls(len(edge), pa.int64())] * 6],
                names=["part", "block", *_DOC_NAMES],
            )

        held, size = [], 0
        for b in batches:
            raw, offsets = string_buffer(b.column(1))
            held.append((np.asarray(b.column(0)), raw.copy(), offsets))
            size += len(raw)
            if size >= BLOCK_BYTES:
                yield from block(held)
                held, size = [], 0
        if held:
            yield from block(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for b in batches:
            known = b.filter(b.column(1).is_null())
            if known.num_rows:
                yield pa.RecordBatch.from_arrays(known.columns[2:], names=_DOC_NAMES)
            blocks += [_unpack(x.as_py()) for x in b.column(1) if x.is_valid]
        if not blocks:
            return
        doc, token = (np.concatenate(c) for c in zip(*blocks))
        order = np.lexsort((doc, token))
        doc, token = doc[order], token[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (token[1:] != token[:-1])
        doc, token = doc[new], token[new]
        edge = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
        size = np.repeat(np.diff(edge), np.diff(edge))
        who, times = np.unique(doc[size > 1], return_counts=True)
        if len(who):
            none = pa.nulls(len(who), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(who), none, none, none, none, pa.array(times.astype(np.int64))], names=_DOC_NAMES
            )

    routed = keyed.select("_quire_key", F.col(text).alias("_text")).mapInArrow(tidy(route), "part int, block binary, " + _DOC)
    seen = materialize(routed.repartitionById(parts, F.col("part")).mapInArrow(tidy(count), _DOC))
    return seen.groupBy("doc").agg(
        *[F.max(c).alias(c) for c in ("n", "sampled", "k1", "k2")], F.sum("shared").alias("shared")
    )


def full_sets(keyed: DataFrame, text: str, words: int = SHINGLE) -> DataFrame:
    """(doc, n, tokens) with the sorted shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            value, cuts = shingle_sets(*string_buffer(b.column(1)), words)
            tokens = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(value.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(cuts)), tokens], names=["doc", "n", "tokens"])

    return keyed.select("_quire_key", F.col(text).alias("_text")).mapInArrow(tidy(run), "doc long, n long, tokens array<long>")


class SignatureTree:
    """Nodes of FANOUT children: OR of the bitmaps, size range, and the most
    shingles that share a bit with another one of their document."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, excess: np.ndarray, percent: int):
        self.percent = percent
        self.levels = [(bits, sizes, sizes, excess)]
        while len(self.levels[-1][0]) > FANOUT:
            b, low, high, ex = self.levels[-1]
            cut = np.arange(0, len(b), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(b, cut),
                    np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut),
                    np.maximum.reduceat(ex, cut),
                )
            )

    def pairs(self, other: SignatureTree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Chunks of leaf pairs (i, j) that may link; of a tree with itself, i < j."""
        top = min(len(self.levels), len(other.levels)) - 1
        a, b = np.meshgrid(
            np.arange(len(self.levels[top][0])), np.arange(len(other.levels[top][0])), indexing="ij"
        )
        yield from self._descend(other, a.ravel(), b.ravel(), top)

    def _descend(self, other, a, b, level):
        one = self is other
        for at in range(0, len(a), 4096):
            x, y = a[at : at + 4096], b[at : at + 4096]
            if one:
                x, y = (v[x < y] for v in (x, y)) if level == 0 else (v[x <= y] for v in (x, y))
            keep = self._may_link(other, x, y, level)
            x, y = x[keep], y[keep]
            if not len(x):
                continue
            if level == 0:
                yield x, y
                continue
            child = np.arange(FANOUT)
            cx = (x[:, None, None] * FANOUT + child[None, :, None]).repeat(FANOUT, 2).ravel()
            cy = (y[:, None, None] * FANOUT + child[None, None, :]).repeat(FANOUT, 1).ravel()
            real = (cx < len(self.levels[level - 1][0])) & (cy < len(other.levels[level - 1][0]))
            yield from self._descend(other, cx[real], cy[real], level - 1)

    def _may_link(self, other, x, y, level):
        bits, low, high, ex = self.levels[level]
        obits, olow, ohigh, oex = other.levels[level]
        keep = (100 * high[x] >= self.percent * olow[y]) & (100 * ohigh[y] >= self.percent * low[x])
        keep = np.flatnonzero(keep)
        x, y = x[keep], y[keep]
        most = np.bitwise_count(bits[x] & obits[y]).sum(1, dtype=np.int64) + np.minimum(ex[x], oex[y])
        most = np.minimum(most, np.minimum(high[x], ohigh[y]))
        # |x & y| * (100 + percent) >= percent * (|x| + |y|) for a link
        return keep[most * (100 + self.percent) >= self.percent * (low[x] + olow[y])]


def block_links(
    tokens: np.ndarray, cuts: np.ndarray, group: np.ndarray, side: np.ndarray | None, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is not connected yet: pairs (i, j) of documents of
    one block (``side`` None), or across the two sides.  ``group`` holds the
    component each document is known to be in."""
    sizes = np.diff(cuts)
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    _, dense, times = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = times[dense] > 1
    names = np.cumsum(times > 1) - 1
    dense, who = names[dense[shared]], owner[shared]
    width = int(min(max(names[-1] + 1 if len(names) else 1, 1), SIGNATURE_BITS))
    exact = len(names) == 0 or names[-1] + 1 <= SIGNATURE_BITS
    flags = np.zeros((n, -(-width // 64) * 64), np.uint8)
    flags[who, dense % width] = 1
    bits = np.packbits(flags, axis=1).view(np.uint64)
    del flags
    count = np.bincount(who, minlength=n)
    excess = count - np.bitwise_count(bits).sum(1, dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(count)])
    # similar documents side by side: by size, then by their rarest bits
    order = np.lexsort((*bits.T[:2], sizes))
    members = [order] if side is None else [order[side[order] == s] for s in (0, 1)]
    if any(len(m) == 0 for m in members):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    trees = [SignatureTree(bits[m], sizes[m], excess[m], percent) for m in members]
    _, label = np.unique(group, return_inverse=True)
    links: list[tuple[np.ndarray, np.ndarray]] = []
    for x, y in trees[0].pairs(trees[-1]):
        i, j = members[0][x], members[-1][y]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
        if not len(i):
            continue
        if exact:
            both = np.bitwise_count(bits[i] & bits[j]).sum(1, dtype=np.int64)
        else:
            both = _overlaps(dense, start, i, j, int(names[-1]) + 1)
        hit = 100 * both >= percent * (sizes[i] + sizes[j] - both)
        if hit.any():
            i, j = i[hit], j[hit]
            # keep the links of a spanning forest of the labels
            k = label.max() + 1
            roots, tree = np.arange(k), []
            for p, q in zip(i.tolist(), j.tolist()):
                u, v = _root(roots, label[p]), _root(roots, label[q])
                if u != v:
                    roots[max(u, v)] = min(u, v)
                    tree.append((p, q))
            label = np.array([_root(roots, u) for u in range(k)])[label]
            links.append(tuple(np.array(tree).T))
    if not links:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = (np.concatenate(c) for c in zip(*links))
    return a, b


def _root(roots: np.ndarray, u: int) -> int:
    while roots[u] != u:
        roots[u] = roots[roots[u]]
        u = roots[u]
    return u


def _overlaps(dense, start, i, j, width):
    """Exact overlaps of the pairs (i, j), one ``i`` at a time."""
    out, mark = np.zeros(len(i), np.int64), np.zeros(width, bool)
    order = np.argsort(i, kind="stable")
    edge = np.flatnonzero(np.diff(i[order], prepend=-1))
    for a, b in zip(edge, np.append(edge[1:], len(order))):
        mine = dense[start[i[order[a]]] : start[i[order[a]] + 1]]
        mark[mine] = True
        for p in order[a:b]:
            out[p] = mark[dense[start[j[p]] : start[j[p] + 1]]].sum()
        mark[mine] = False
    return out


_LINKS = "src long, dst long"


def _join_blocks(rows: DataFrame, across: bool, percent: int) -> DataFrame:
    """Links of the groups (cluster, p, q) of ``rows``."""

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        doc, lists = np.asarray(t["doc"]), t["tokens"].combine_chunks()
        cuts = np.asarray(lists.offsets).astype(np.int64)
        tokens = np.asarray(lists.values)[cuts[0] : cuts[-1]]
        i, j = block_links(tokens, cuts - cuts[0], np.asarray(t["known"]), np.asarray(t["side"]) if across else None, percent)
        return pa.table({"src": doc[i], "dst": doc[j]})

    return rows.groupBy("cluster", "p", "q").applyInArrow(run, _LINKS)


def links_of(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(src, dst) links that connect every component of ``sets`` (doc, n, tokens)."""
    tokens = sets.select("doc", "n", F.explode("tokens").alias("token"))
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = tokens.join(common, "token")
    have = shared.groupBy("doc").agg(F.count(F.lit(1)).alias("have"))
    rare = Window.partitionBy("doc").orderBy("df", "token")
    spare = allowed_misses(F.col("n"), percent) - (F.col("n") - F.col("have"))
    leading = (
        shared.withColumn("place", F.row_number().over(rare))
        .join(have, "doc")
        .where(F.col("place") <= spare + 1)
        .select("doc", "token")
    )
    leading = materialize(leading)
    heads = leading.groupBy("token").agg(F.min("doc").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    clusters = connected_components(
        leading.join(heads, "token").where("doc <> head").select("doc", "head").distinct(), "doc", "head"
    )
    members = materialize(
        sets.join(clusters.withColumnRenamed("node", "doc").withColumnRenamed("component", "cluster"), "doc")
    )
    sizes = members.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_DOCS, F.sum("n") / BLOCK_TOKENS)).alias("blocks")
    )
    members = members.join(sizes, "cluster")

    def cut(seed: int):
        return F.pmod(F.xxhash64("doc", F.lit(seed)), F.col("blocks"))

    within = members.withColumn(
        "p", F.explode(F.when(F.col("blocks") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    ).withColumn("q", F.when(F.col("p") == 0, cut(0)).otherwise(cut(1)))
    found = materialize(
        _join_blocks(within.select("cluster", "p", "q", "doc", "tokens", F.col("doc").alias("known")), False, percent)
    )
    large = members.where("blocks > 1")
    if large.isEmpty():
        return found
    known = connected_components(found).withColumnRenamed("node", "doc")
    large = large.join(known, "doc", "left").withColumn("known", F.coalesce("component", "doc"))
    # clusters that are one component by now need no more
    apart = large.groupBy("cluster").agg(F.min("known").alias("a"), F.max("known").alias("b")).where("a < b")
    large = large.join(apart.select("cluster"), "cluster", "left_semi")
    mine = cut(0)
    pairs = (
        large.withColumn("mine", mine)
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .where("mine <> with")
        .select(
            "cluster",
            F.least("mine", "with").alias("p"),
            F.greatest("mine", "with").alias("q"),
            "doc",
            "tokens",
            "known",
            (F.col("mine") > F.col("with")).cast("int").alias("side"),
        )
    )
    return found.unionByName(materialize(_join_blocks(pairs, True, percent)))


def components(
    keyed: DataFrame, text: str, words: int = SHINGLE, percent: int = PERCENT, unique: bool = False
) -> DataFrame:
    """(_quire_key, n_shingles, _class, _component) for each ``_quire_key`` of ``keyed``: set
    size, smallest key with the same set, smallest key that links reach.
    ``unique``: no key occurs twice."""
    seen = materialize(document_sets(keyed, text, words))
    classes = materialize(
        seen.where("n > 0")
        .groupBy("k1", "k2")
        .agg(F.min_by(F.struct("doc", "n", "sampled", "shared"), "doc").alias("r"))
        .select("k1", "k2", "r.*")
    )
    lacking = F.col("sampled") - F.col("shared")
    left = classes.where(lacking <= allowed_misses(F.col("n"), percent)).select(F.col("doc").alias("_quire_key"))
    # keys are hashed, so that no text is sorted; repeated rows give a set once
    rows = keyed.select("_quire_key", text).join(left.hint("shuffle_hash"), "_quire_key")
    sets = materialize(full_sets(rows, text, words))
    if not unique:
        sets = sets.dropDuplicates(["doc"])
    parts = connected_components(links_of(sets, percent))
    reps = classes.select("k1", "k2", F.col("doc").alias("rep")).join(
        parts.withColumnRenamed("node", "rep"), "rep", "left"
    )
    return seen.join(reps, ["k1", "k2"], "left").select(
        F.col("doc").alias("_quire_key"),
        F.col("n").alias("n_shingles"),
        F.coalesce(F.when(F.col("n") > 0, F.col("rep")), F.col("doc")).alias("_class"),
        F.coalesce(F.when(F.col("n") > 0, F.coalesce("component", "rep")), F.col("doc")).alias("_component"),
    )


def join(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(id, n_shingles, class_id, component_id) for every row: ``class_id`` is
    the smallest id with the same set, ``component_id`` the smallest id that
    links reach."""
    keyed = with_unique_key(docs, id_col, text)
    found = components(keyed, text, words, percent, ids_unique(docs, id_col))
    rows = keyed.select(F.col(id_col), "_quire_key").join(found, "_quire_key")
    names = rows.select(F.col("_quire_key").alias("_name"), F.col(id_col).alias("_quire_id")).distinct()
    for column, name in (("_class", "class_id"), ("_component", "component_id")):
        rows = rows.join(names.select(F.col("_name").alias(column), F.col("_quire_id").alias(name)), column)
    return rows.select(id_col, "n_shingles", "class_id", "component_id")


def first_of_groups(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one row of each component: its first document."""
    keyed = with_unique_key(docs, id_col, text)
    unique = ids_unique(docs, id_col)
    found = components(keyed, text, words, percent, unique)
    first = found.where("_quire_key = _component").select("_quire_key")
    kept = keyed.join(first.hint("shuffle_hash"), "_quire_key", "left_semi")
    return (kept if unique else kept.dropDuplicates(["_quire_key"])).drop("_quire_key")
