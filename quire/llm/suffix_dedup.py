"""Removal of repeated byte strings by an enhanced suffix array.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts
earlier (smaller document, or same document and earlier start).

1. *Routing.*  Every window of LENGTH bytes has an anchor: its smallest hashed
   GRAM.  Equal windows have equal anchors at equal places, so sending windows
   to the partition of their anchor brings all copies of a string together.  A
   run of windows with one anchor travels as one fragment.  Fragments that are
   equal within a block of input are sent once, so a passage that a third
   of all documents share costs one row per block.
2. *Enhanced suffix array.*  Each partition sorts the suffixes that start at
   anchors that occur more than once, with the common prefixes (LCP) of
   neighbours, and scans the LCPs with a stack for the intervals of the
   common-prefix tree.  In each interval the members are grouped by what
   stands left of the anchor: the intervals of the tree of reversed left
   contexts are the left-maximal extensions, and one whose members all go on
   with the same byte on the right is left to the deeper interval.
   What remains are the maximal repeats with all their occurrences.
3. *Removal.*  All occurrences of a group but the earliest are removed; their
   union per document is cut from the text.

Documents are ordered by id.  Null and empty texts hold no window.  Repeated
rows (same id and text) are one document and get the same result; rows that
share only the id are documents of their own, ordered by the hash of the text;
null ids come first.  Texts of any length are read in chunks.  Extra columns stay,
unless an output has the same name.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.lineage import materialize
from quire.llm.common import (
    SpanHash,
    bounded_batches,
    byte_codes,
    ids_unique,
    mix64,
    shuffle_partitions,
    string_buffer,
    tidy,
    with_unique_key,
)

LENGTH, GRAM = 100, 20
REACH = LENGTH - GRAM  # an anchor starts at most so many bytes into its window
CHUNK = 1 << 18
PLACE = np.uint64((1 << 21) - 1)
BLOCK_BYTES = 16 << 20


def fragments(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, length, offset of the anchor, hash of the anchor, hash of the
    bytes) of each run of windows with one anchor, a chunk at a time."""
    codes = byte_codes(3)
    n = len(raw)
    for a in range(0, max(n - LENGTH + 1, 0), CHUNK):
        b = min(a + CHUNK + LENGTH - 1, n)
        hashes = SpanHash(raw[a:b], codes)
        grams = mix64(hashes.windows(GRAM))
        least = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while 2 * width <= REACH + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if rest := REACH + 1 - width:
            least = np.minimum(least[:-rest], least[rest:])
        anchor = (least & PLACE).astype(np.int64)
        whole = np.ones(len(anchor), bool)
        first, last = np.searchsorted(offsets, [a, b], "right")
        for end, begin in zip(offsets[first : last + 1], offsets[first - 1 : last]):
            whole[max(begin, end - LENGTH + 1, a) - a : max(end - a, 0)] = False
        cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])) + 1
        start = np.concatenate([[0], cut])
        stop = np.append(cut, len(anchor))
        keep = whole[start]
        start, stop = start[keep], stop[keep]
        length = stop - start + LENGTH - 1
        at = anchor[start]
        yield start + a, length, at - start, grams[at], hashes.spans(start, start + length)


def _label(*parts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = mix64(out + p.astype(np.uint64))
    return out.astype(np.int64)


def _words(data: np.ndarray, kind: str) -> np.ndarray:
    """The 8-byte word at every place of ``data``."""
    return np.ndarray((len(data) - 7,), kind, data.data, 0, (1,))


def gather(raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    ends = np.cumsum(length)
    return raw[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - length), length)]


def pack(doc, lo, length, at, data) -> bytes:
    order = [doc.astype("<i8"), lo.astype("<i8"), length.astype("<u2"), at.astype("<u1"), data]
    order[0] = np.diff(order[0], prepend=0)
    return zstandard.ZstdCompressor(level=1).compress(
        struct.pack("<I", len(doc)) + b"".join(x.tobytes() for x in order)
    )


def unpack(block: bytes):
    body = zstandard.ZstdDecompressor().decompress(block)
    (n,), at, out = struct.unpack_from("<I", body), 4, []
    for kind, width in (("<i8", 8), ("<i8", 8), ("<u2", 2), ("<u1", 1)):
        out.append(np.frombuffer(body, kind, n, at))
        at += n * width
    return np.cumsum(out[0]), out[1], out[2].astype(np.int64), out[3].astype(np.int64), np.frombuffer(body, np.uint8, offset=at)


GROUPS = "grp long, doc long, start long, length long, earliest boolean"
_NAMES = ["grp", "doc", "start", "length", "earliest"]


def _group_batch(grp, doc, start, length, earliest) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(x)) for x in (grp, doc, start, length, earliest)], names=_NAMES
    )


def route_block(keys: np.ndarray, raw: np.ndarray, offsets: np.ndarray, parts: int):
    """(groups within the block, [(part, packed fragments)]): of equal fragments
    the earliest goes on, the others are known to repeat it."""
    found = [np.concatenate(c) for c in zip(*fragments(raw, offsets))]
    if not found:
        return None, []
    start, length, at, gram, digest = found
    row = np.searchsorted(offsets, start, "right") - 1
    doc, lo = keys[row], start - offsets[row]
    tag = mix64(gram + length.astype(np.uint64) * np.uint64(256) + at.astype(np.uint64))
    order = np.lexsort((lo, doc, tag, digest))
    d, t = digest[order], tag[order]
    new = np.ones(len(order), bool)
    new[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1])
    again = order[~new]
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    word = _words(padded, ">u8")
    label = _label(word[start[again]], word[start[again] + length[again] - 8], length[again], at[again])
    groups = _group_batch(label, doc[again], lo[again], length[again], np.zeros(len(again), bool))
    kept = np.sort(order[new])
    part = (gram[kept] % np.uint64(parts)).astype(np.int64)
    by_part = np.argsort(part, kind="stable")
    kept, part = kept[by_part], part[by_part]
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    packed = []
    for x, y in zip(cuts, np.append(cuts[1:], len(kept))):
        k = kept[x:y]
        packed.append((int(part[x]), pack(doc[k], lo[k], length[k], at[k], gather(raw, start[k], length[k]))))
    return groups, packed


def lcp_intervals(lcp: list[int], least: int) -> list[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval of the tree with a common
    prefix of at least ``least``: one stack scan; lcp[i] is that of i - 1 and i."""
    out, stack = [], []  # (prefix, first)
    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else 0
        first = i - 1
        while stack and stack[-1][0] > now:
            prefix, first = stack.pop()
            out.append((prefix, first, i - 1))
        if now >= least and (not stack or stack[-1][0] < now):
            stack.append((now, first))
    return out


def _common(x: np.ndarray, y: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the rows of two byte tables."""
    same = x == y
    found = np.where(same.all(1), x.shape[1], np.argmin(same, 1))
    return np.minimum(found, room)


class SuffixArray:
    """Enhanced suffix array over the anchored suffixes of fragments."""

    def __init__(self, doc, lo, length, at, base, data):
        """``data``: arrays of the fragments' bytes, ``base``: where each fragment
        starts in their concatenation."""
        front = 96
        padded = np.concatenate([np.zeros(front, np.uint8), *data, np.zeros(128, np.uint8)])
        data.clear()  # one copy is enough
        big, little = _words(padded, ">u8"), _words(padded, "<u8")
        place = base + at + front
        gram = mix64(mix64(mix64(big[place].astype(np.uint64)) + big[place + 8]) + (big[place + 16] >> np.uint64(32)))
        order = np.argsort(gram, kind="stable")
        g = gram[order]
        edge = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1], [True]]))
        size = np.repeat(np.diff(edge), np.diff(edge)) if len(g) else np.zeros(0, int)
        pick = order[size > 1]
        self.doc, self.lo, self.length, self.at = doc[pick], lo[pick], length[pick], at[pick]
        place, gram = place[pick], gram[pick]
        self.right, self.left = self.length - self.at, self.at
        rights = self._cut([big[place + 8 * j] for j in range(13)], self.right)
        lefts = self._cut([little[place - 8 * (j + 1)] for j in range(10)], self.left)
        start = place - self.at
        self.label = _label(big[start], big[start + self.length - 8], self.length, self.at)
        self.age = np.empty(len(pick), np.int64)
        self.age[np.lexsort((self.lo + self.at, self.doc))] = np.arange(len(pick))
        keys = [self.age, self.left, *lefts[::-1], self.right, *rights[::-1], gram]
        self.order = np.lexsort(keys) if len(pick) else np.zeros(0, np.int64)
        self.gram, self.rights, self.lefts = gram, rights, lefts

    @staticmethod
    def _cut(words: list[np.ndarray], room: np.ndarray) -> list[np.ndarray]:
        """Words with the bytes beyond ``room`` cleared."""
        out = []
        for j, w in enumerate(words):
            bits = np.clip(room - 8 * j, 0, 8) * 8
            mask = np.where(bits == 64, ~np.uint64(0), ~(~np.uint64(0) >> np.minimum(bits, 63).astype(np.uint64)))
            out.append(w.astype(np.uint64) & mask)
        return out

    def groups(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int, int]]:
        """(label, members, bytes left of the anchor, bytes right of it) of each
        maximal repeat; members of equal fragments come as one group each."""
        if not len(self.order):
            return
        o = self.order
        same = np.ones(len(o) - 1, bool)
        for w in (self.gram, self.right, self.left, *self.rights, *self.lefts):
            same &= w[o[1:]] == w[o[:-1]]
        head = np.flatnonzero(np.concatenate([[True], ~same]))
        tail = np.append(head[1:], len(o))
        for a, b in zip(head[tail - head > 1].tolist(), tail[tail - head > 1].tolist()):
            m = o[a:b]
            yield int(self.label[m[0]]), m, int(self.left[m[0]]), int(self.right[m[0]])
        # the earliest of each class of equal fragments stands for it from here on
        o = o[head]
        R = np.stack([w[o] for w in self.rights], 1).astype(">u8").view(np.uint8)
        L = np.stack([w[o] for w in self.lefts], 1).astype(">u8").view(np.uint8)
        right, left, gram = self.right[o], self.left[o], self.gram[o]
        lcp = np.zeros(len(o), np.int64)
        lcp[1:] = _common(R[1:], R[:-1], np.minimum(right[1:], right[:-1]))
        lcp[1:][gram[1:] != gram[:-1]] = 0
        found = lcp_intervals(lcp.tolist(), LENGTH - REACH)
        if not found:
            return
        prefix, first, last = np.array(found).T
        by_left = np.empty(len(o), np.int64)
        by_left[np.lexsort([left, *[self.lefts[j][o] for j in range(9, -1, -1)]])] = np.arange(len(o))
        # intervals of two: the left extension is one comparison
        pair = last - first == 1
        i, j, r = first[pair], last[pair], prefix[pair]
        l = _common(L[i], L[j], np.minimum(left[i], left[j]))
        long = l + r >= LENGTH
        for x, y, le, ri in zip(i[long].tolist(), j[long].tolist(), l[long].tolist(), r[long].tolist()):
            yield self._name(o[x], le, ri), o[[x, y]], le, ri
        for r, a, b in zip(prefix[~pair].tolist(), first[~pair].tolist(), last[~pair].tolist()):
            need = LENGTH - r
            m = np.arange(a, b + 1)
            m = m[left[m] >= need]
            if len(m) < 2:
                continue
            m = m[np.argsort(by_left[m])]
            lcs = np.zeros(len(m), np.int64)
            lcs[1:] = _common(L[m[1:]], L[m[:-1]], np.minimum(left[m[1:]], left[m[:-1]]))
            if lcs.max() < need:
                continue
            onward = np.where(right[m] > r, R[m, min(r, R.shape[1] - 1)].astype(np.int64), -1)
            for le, x, y in lcp_intervals(lcs.tolist(), max(need, 1)) if need else self._any_left(lcs):
                go = onward[x : y + 1]
                if go[0] >= 0 and (go == go[0]).all():
                    continue  # the deeper interval has the longer string
                members = o[m[x : y + 1]]
                yield self._name(members[0], le, r), members, le, r

    @staticmethod
    def _any_left(lcs: np.ndarray):
        """Intervals when the right side alone is long enough: also that of all members."""
        found = lcp_intervals(lcs.tolist(), 1)
        whole = (int(lcs[1:].min()), 0, len(lcs) - 1)
        return found if whole in found else [*found, whole]

    def _name(self, member: int, left: int, right: int) -> int:
        return int(_label(self.label[member : member + 1], np.array([left]), np.array([right]))[0])

    def _earliest(self, m: np.ndarray) -> np.ndarray:
        """The member whose anchor comes first, which may be there twice (repeated rows)."""
        first = m[np.argmin(self.age[m])]
        return (self.doc[m] == self.doc[first]) & (self.lo[m] + self.at[m] == self.lo[first] + self.at[first])

    def all_groups(self) -> Iterator[pa.RecordBatch]:
        """Every occurrence of every group."""
        for label, m, le, ri in self.groups():
            yield _group_batch(
                np.full(len(m), label), self.doc[m], self.lo[m] + self.at[m] - le,
                np.full(len(m), le + ri), self._earliest(m),
            )

    def repeated_spans(self) -> pa.RecordBatch:
        """One span per fragment: all that some group removes of it.  Spans of a
        fragment all hold its anchor, so their union is one span."""
        left, right = np.zeros(len(self.doc), np.int64), np.zeros(len(self.doc), np.int64)
        for _, m, le, ri in self.groups():
            later = m[~self._earliest(m)]
            left[later] = np.maximum(left[later], le)
            right[later] = np.maximum(right[later], ri)
        hit = np.flatnonzero(right)
        return _group_batch(
            self.label[hit], self.doc[hit], self.lo[hit] + self.at[hit] - left[hit],
            left[hit] + right[hit], np.zeros(len(hit), bool),
        )


def _united(groups: pa.RecordBatch) -> pa.RecordBatch:
    """One span for each run of spans of a document that touch or overlap."""
    if not groups.num_rows:
        return groups
    label, doc, start, length = (np.asarray(groups.column(c)) for c in range(4))
    order = np.lexsort((start, doc))
    label, doc, start, end = label[order], doc[order], start[order], (start + length)[order]
    # ends that are reached so far, apart for each document
    step = int(end.max()) + 1
    place = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]])) * step
    reach = np.maximum.accumulate(end + place)
    first = np.concatenate([[True], start[1:] + place[1:] > reach[:-1]])
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(doc)) - 1
    return _group_batch(label[at], doc[at], start[at], reach[last] - place[last] - start[at], np.zeros(len(at), bool))


def _repeats(keyed: DataFrame, text: str, spans_only: bool, unique: bool) -> DataFrame:
    """Spans or groups of all keys; unless keys are ``unique``, of one row for
    each, as a repeated row would be found to repeat itself."""
    spark = keyed.sparkSession
    bounded_batches(spark)
    parts = shuffle_partitions(spark)
    routed_schema = "part int, block binary, " + GROUPS

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(held):
            keys = np.concatenate([k for k, _, _ in held])
            raw = np.concatenate([r for _, r, _ in held])
            sizes = np.concatenate([np.diff(o) for _, _, o in held])
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            groups, packed = route_block(keys, raw, offsets, parts)
            if groups is not None and spans_only:
                groups = _united(groups)
            if groups is not None and groups.num_rows:
                n = groups.num_rows
                spread = pa.array(np.arange(n, dtype=np.int32) * 1009 // max(n, 1) % parts, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [spread, pa.nulls(n, pa.binary()), *groups.columns], names=["part", "block", *_NAMES]
                )
            if packed:
                p, b = zip(*packed)
                none = [pa.nulls(len(p), c) for c in [pa.int64()] * 4 + [pa.bool_()]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p, pa.int32()), pa.array(b, pa.binary()), *none], names=["part", "block", *_NAMES]
                )

        held, size = [], 0
        for b in batches:
            raw, offsets = string_buffer(b.column(1))
            held.append((np.asarray(b.column(0)), raw.copy(), offsets))
            size += len(raw)
            if size >= BLOCK_BYTES:
                yield from block(held)
                held, size = [], 0
        if size:
            yield from block(held)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for b in batches:
            known = b.filter(b.column(1).is_null())
            if known.num_rows:
                yield pa.RecordBatch.from_arrays(known.columns[2:], names=_NAMES)
            blocks += [unpack(x.as_py()) for x in b.column(1) if x.is_valid]
        if not blocks:
            return
        *columns, data = map(list, zip(*blocks))
        del blocks
        doc, lo, length, at = map(np.concatenate, columns)
        array = SuffixArray(doc, lo, length, at, np.cumsum(length) - length, data)
        if spans_only:
            yield array.repeated_spans()
        else:
            yield from array.all_groups()

    rows = keyed.select("_quire_key", F.col(text).alias("_text"))
    rows = rows if unique else rows.dropDuplicates(["_quire_key"])
    routed = rows.mapInArrow(tidy(route), routed_schema)
    return routed.repartitionById(parts, F.col("part")).mapInArrow(tidy(scan), GROUPS)


def maximal_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(grp, key, start, length, earliest) of every occurrence of every maximal
    repeat of at least LENGTH bytes within the reach of an anchor; longer ones
    come as overlapping groups, one for each anchor.  The earliest occurrence
    is marked where the group was formed in a suffix array; copies that were
    equal within a block follow with the label of their group."""
    unique = ids_unique(docs, id_col)
    return _repeats(with_unique_key(docs, id_col, text, unique), text, False, unique).withColumnRenamed("doc", "key")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", as_text: bool = False, prefix: str = ""
) -> DataFrame:
    """``docs`` without ``text``, with n_bytes, n_removed, n_spans and ``kept``:
    the remaining bytes, or with ``as_text`` the characters that are whole in them;
    the names stand behind ``prefix`` and replace input columns of the same name."""
    unique = ids_unique(docs, id_col)
    keyed = with_unique_key(docs, id_col, text, unique)
    spans = materialize(_repeats(keyed, text, True, unique).select("doc", "start", "length"))
    cuts = spans.groupBy(F.col("doc").alias("_quire_key")).agg(
        F.collect_list("start").alias("_quire_start"), F.collect_list("length").alias("_quire_length")
    )
    # the spans of a partition are small: hash them, so that no text is sorted
    joined = keyed.join(cuts.hint("shuffle_hash"), "_quire_key", "left").drop("_quire_key")
    added = [T.StructField(prefix + n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    gone = {text.lower(), (prefix + "kept").lower(), *(f.name.lower() for f in added)}
    others = [f for f in docs.schema.fields if f.name.lower() not in gone]
    schema = T.StructType([*others, *added, T.StructField(prefix + "kept", T.StringType() if as_text else T.BinaryType())])
    names = [f.name for f in schema.fields]
    rest = [f.name for f in others]
    joined = joined.select(*rest, F.col(text).alias("_quire_text"), "_quire_start", "_quire_length")
    k = len(rest)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = string_buffer(b.column(k))
            size, removed, count, kept = [], [], [], []
            for i, (s, n) in enumerate(zip(b.column(k + 1), b.column(k + 2))):
                body = raw[offsets[i] : offsets[i + 1]]
                gone = np.zeros(len(body) + 1, np.int32)
                if s.is_valid and len(s):
                    s, n = np.asarray(s.values), np.asarray(n.values)
                    np.add.at(gone, s, 1)
                    np.add.at(gone, s + n, -1)
                gone = np.cumsum(gone[:-1]) > 0
                size.append(len(body))
                removed.append(int(gone.sum()))
                count.append(int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()))
                kept.append(body[~gone].tobytes() if removed[-1] else body.tobytes())
            rest_of = pa.array([x.decode("utf-8", "ignore") for x in kept]) if as_text else pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:k], *[pa.array(x, pa.int64()) for x in (size, removed, count)], rest_of], names=names
            )

    return joined.mapInArrow(tidy(cut), schema)
