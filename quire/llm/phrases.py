"""Phrase collocations from the counts of all contiguous word runs.

1. Words are counted per language; those with at least ``min_count`` occurrences
   get consecutive numbers, most frequent first.  Texts are written once as
   these numbers, with a mark where a piece ends or a rarer word stands: no
   phrase that reaches the count can reach over a mark.
2. Candidates are Apriori-safe: a phrase is one only if its words are frequent,
   both its parts without the last or first word are candidates, and its bucket's
   count reaches ``min_count``.  A bucket is 32 bits of the phrase's hash and
   counts all phrases in it, so it never hides a frequent phrase.  Of the
   buckets that pass, a bitmap of fixed size (16 MB) is broadcast; it holds 32
   buckets to a bit, which can only add candidates.
3. Candidates go by their first two words into shards of bounded size.  A task
   builds the double-array trie of a shard: a state's child for word w is at
   base + w and names the state in check.  One shard at a time is broadcast
   (counting reads the texts once per shard), and numpy advances the states of
   all positions of a batch together, a word a level; the accepting states are
   counted with bincount, and the counts of all tasks are summed by state.
   These are the phrases' counts.
4. Cuts, scores, coverage by longer candidates and the ranking are joins and
   aggregations on the counted phrases, in decimals where products may pass 64 bits.

Broadcast: the word numbers, at most ``WORDS`` at a time (the texts are read once
per part), the bitmaps (16 MB each), one trie (at most about ``STATES`` states).
Words and phrases are known by 64-bit hashes while they are counted in a task,
by themselves in all that is returned.  A word, line or phrase of any frequency
is summed inside the tasks before anything is shuffled.

Null and empty texts hold no word; null languages are ``und``; every row counts,
repeated rows too; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.lineage import materialize
from quire.functions.ranking import consecutive_index
from quire.llm.common import SpanHash, bounded_batches, byte_codes, document_groups, mix64, string_buffer, tidy
from quire.llm.words import byte_class, span_bytes, word_spans

# fixed values: what ends a piece, what ends a word besides
PIECE_ENDS = byte_class(0x2E, 0x2C, 0x3B, 0x3A, 0x21, 0x3F, (0x0A, 0x0D))
WORD_BYTES = ~(PIECE_ENDS | byte_class(0x20, 0x09))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
SCORE_SCALE = 2_000_000

MIN_COUNT, MAX_WORDS, TOP, COVER_PERCENT = 30, 4, 2000, 80
# bounds of what is broadcast and of what a task holds
WORDS = 4_000_000
STATES = 2_000_000
HELD = 4_000_000
RANGES = 1_024  # of 2^22 buckets each, or of candidates
SLICE = 1_024  # states of one row of counts
MARK = -1

RESULT = "lang string, rank int, phrase string, a long, l long, r long, n long, score long"


def _lang_seeds(langs: list[str | None]) -> np.ndarray:
    """A 64-bit number per language."""
    out = np.zeros(len(langs), np.uint64)
    for i, lang in enumerate(langs):
        raw = np.frombuffer((lang or "").encode(), np.uint8)
        whole = SpanHash(raw, byte_codes(5))
        out[i] = whole.spans(np.zeros(1, np.int64), np.array([len(raw)]))[0]
    return mix64(out)


class Texts:
    """Words of a group of texts, with hashes that tell languages apart."""

    codes = byte_codes(4, lower=True)

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, seeds: np.ndarray):
        self.raw = LOWER[raw]
        self.start, self.end, self.row = word_spans(self.raw, offsets, WORD_BYTES)
        self.hash = mix64(SpanHash(self.raw, self.codes).spans(self.start, self.end) ^ seeds[self.row]).view(np.int64)

    def ends_piece(self) -> np.ndarray:
        """Whether a piece (or a text) ends after each word."""
        seen = np.concatenate([[0], np.cumsum(PIECE_ENDS[self.raw])])
        out = np.ones(len(self.start), bool)
        out[:-1] = (seen[self.start[1:]] != seen[self.end[:-1]]) | (np.diff(self.row) != 0)
        return out


def _groups(b: pa.RecordBatch) -> Iterator[tuple[int, int, Texts, np.ndarray, list]]:
    """(first row, past-the-end row, texts, language of each row, languages)."""
    coded = b.column(0).dictionary_encode()
    langs = coded.dictionary.to_pylist()
    which = np.asarray(coded.indices)
    seeds = _lang_seeds(langs)[which]
    raw, offsets = string_buffer(b.column(1))
    for i, j in document_groups(offsets):
        here = Texts(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], seeds[i:j])
        yield i, j, here, which[i:j], langs


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, hash, n) of all words of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def merged() -> tuple:
            h, n = (np.concatenate([x[i] for x in held]) for i in range(2))
            words, langs = (pa.concat_arrays([x[i] for x in held]) for i in (2, 3))
            h, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            n = np.bincount(inverse.reshape(-1), weights=n).astype(np.int64)
            return h, n, words.take(pa.array(first)), langs.take(pa.array(first))

        def out() -> Iterator[pa.RecordBatch]:
            h, n, words, langs = merged()
            for a in range(0, len(h), 1 << 16):
                z = min(a + (1 << 16), len(h))
                yield pa.RecordBatch.from_arrays(
                    [langs[a:z], words[a:z], pa.array(h[a:z]), pa.array(n[a:z])], names=["lang", "word", "hash", "n"]
                )

        for b in batches:
            for _, _, here, which, langs in _groups(b):
                if not len(here.hash):
                    continue
                h, first, n = np.unique(here.hash, return_index=True, return_counts=True)
                data, at = span_bytes(here.raw, here.start[first], here.end[first])
                words = pa.Array.from_buffers(
                    pa.string(), len(h), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)]
                )
                names = pa.array(langs, pa.string()).take(pa.array(which[here.row[first]]))
                held.append((h, n, words, names))
                size += len(h)
                if size > HELD // 2:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > HELD // 4:  # few repeats: hand over
                        yield from out()
                        held, size = [], 0
        if held:
            yield from out()

    found = docs.mapInArrow(tidy(run), "lang string, word string, hash long, n long")
    return found.groupBy("lang", "word").agg(F.min("hash").alias("hash"), F.sum("n").alias("n"))


def number_texts(docs: DataFrame, words: DataFrame, most_words: int = WORDS) -> DataFrame:
    """(ids binary): the texts as int32 word numbers, ``MARK`` where no phrase goes
    on.  ``words``: (hash, gid)."""
    spark = docs.sparkSession
    parts = max(1, -(-words.count() // most_words))
    numbered = docs.select("lang", "text", F.lit(None).cast("binary").alias("ids"))
    for p in range(parts):
        pdf = words.where(F.pmod(F.xxhash64("hash"), F.lit(parts)) == p).select("hash", "gid").toPandas()
        hashes, gids = pdf["hash"].to_numpy(np.int64), pdf["gid"].to_numpy(np.int32)
        order = np.argsort(hashes)
        shared = spark.sparkContext.broadcast((hashes[order], gids[order]))
        numbered = numbered.mapInArrow(tidy(_numbering(shared, p == parts - 1)), "lang string, text string, ids binary")
        if p < parts - 1:
            numbered = materialize(numbered)
    return numbered.where(F.octet_length("ids") > 4).select("ids")


def _numbering(shared, last: bool):
    """Give words their numbers where this part knows them; in the last part, put
    the marks in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, gids = shared.value
        for b in batches:
            for i, j, here, _, _ in _groups(b):
                ids = np.full(len(here.hash), MARK, np.int32)
                before = b.column(2).slice(i, j - i)
                if before.null_count < len(before):
                    ids = np.concatenate([np.frombuffer(x or b"", "<i4") for x in before.to_pylist()])
                    ids = ids.copy()
                if len(hashes):
                    at = np.searchsorted(hashes, here.hash)
                    at[at == len(hashes)] = 0
                    hit = hashes[at] == here.hash
                    ids[hit] = gids[at[hit]]
                row = here.row
                if last:
                    ends = here.ends_piece()
                    place = np.arange(len(ids)) + np.concatenate([[0], np.cumsum(ends)[:-1]]) if len(ids) else ids
                    marked = np.full(len(ids) + int(ends.sum()), MARK, np.int32)
                    marked[place] = ids
                    row = np.repeat(row, 1 + ends)
                    # one mark is enough, also before the first word of a text
                    keep = marked >= 0
                    keep[1:] |= (marked[:-1] >= 0) & (row[1:] == row[:-1])
                    ids, row = marked[keep], row[keep]
                edge = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32) * 4
                packed = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(edge), pa.py_buffer(ids.astype("<i4"))])
                text = pa.nulls(j - i, pa.string()) if last else b.column(1).slice(i, j - i)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), text, packed], names=["lang", "text", "ids"])

    return run


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The word numbers of a batch, text after text (each ends with a mark)."""
    for b in batches:
        c = b.column(0)
        at = np.frombuffer(c.buffers()[1], np.int32, len(c) + 1, c.offset * 4)
        size = int(at[-1] - at[0])
        if size:
            yield np.frombuffer(c.buffers()[2], "<i4", size // 4, int(at[0]))


def _buckets(h: np.ndarray, nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of phrases one word longer, and their buckets."""
    h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + nxt.astype(np.uint64) + np.uint64(1))
    return h, (h >> np.uint64(32)).astype(np.uint32)


def _passes(bitmap: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return (bitmap[bucket >> np.uint32(8)] >> ((bucket >> np.uint32(5)) & np.uint32(7)).astype(np.uint8)) & 1 == 1


def _levels(ids: np.ndarray, bitmaps: list[np.ndarray], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 2, 3, ... ``depth`` words: (positions of possible phrases, their buckets).
    A position goes on if its phrase passed and so did the one a word later."""
    at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0)) if len(ids) > 1 else np.zeros(0, np.int64)
    h = mix64(ids[at].astype(np.uint64))
    for words in range(2, depth + 1):
        h, bucket = _buckets(h, ids[at + words - 1])
        yield at, bucket
        if words == depth:
            return
        good = _passes(bitmaps[words - 2], bucket)
        at, h = at[good], h[good]
        # the phrase that starts a word later
        later = np.searchsorted(at, at + 1)
        later[later == len(at)] = 0
        both = at[later] == at + 1 if len(at) else np.zeros(0, bool)
        at, h = at[both], h[both]


def frequent_buckets(numbered: DataFrame, bitmaps: list[np.ndarray], min_count: int) -> np.ndarray:
    """The bitmap of buckets that ``min_count`` phrases of the next length fall into."""
    depth = len(bitmaps) + 2
    kind = np.uint16 if min_count < 1 << 16 else np.uint32
    shared = numbered.sparkSession.sparkContext.broadcast(bitmaps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            bucket, n = np.unique(np.concatenate(held), return_counts=True)
            n = np.minimum(n, min_count).astype(kind)  # more than enough is enough
            edge = np.searchsorted(bucket >> np.uint32(22), np.arange(RANGES + 1))
            some = np.flatnonzero(np.diff(edge))
            columns = [[x[edge[r] : edge[r + 1]].tobytes() for r in some] for x in (bucket, n)]
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], names=["part", "bucket", "n"]
            )

        for ids in _ids(batches):
            for _, bucket in _levels(ids, shared.value, depth):
                pass  # the last level is the one to count
            held.append(bucket)
            size += len(bucket)
            if size > HELD:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    def summed(table: pa.Table) -> pa.Table:
        bucket = np.concatenate([np.frombuffer(x, np.uint32) for x in table["bucket"].to_pylist()])
        n = np.concatenate([np.frombuffer(x, kind) for x in table["n"].to_pylist()]).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, first = np.unique(bucket[order], return_index=True)
        good = bucket[np.add.reduceat(n[order], first) >= min_count]
        bits = np.zeros(1 << 17, np.uint8)
        bits[(good & np.uint32((1 << 22) - 1)) >> np.uint32(5)] = 1
        part = table["part"][0].as_py()
        none = [] if not len(good) else [np.packbits(bits, bitorder="little").tobytes()]
        return pa.table({"part": pa.array([part] * len(none), pa.int32()), "bits": pa.array(none, pa.binary())})

    counted = numbered.mapInArrow(tidy(run), "part int, bucket binary, n binary")
    slices = counted.groupBy("part").applyInArrow(summed, "part int, bits binary").collect()  # 16 MB at most
    bitmap = np.zeros(1 << 24, np.uint8)
    for r in slices:
        bitmap[r["part"] << 14 : (r["part"] + 1) << 14] = np.frombuffer(r["bits"], np.uint8)
    return bitmap


def candidates(numbered: DataFrame, bitmaps: list[np.ndarray]) -> DataFrame:
    """(part, n, phrases binary): distinct candidates as rows of int32 word numbers,
    filled up with ``MARK``; those with the same first two words are in one part."""
    longest = len(bitmaps) + 1
    shared = numbered.sparkSession.sparkContext.broadcast(bitmaps)

    def distinct(found: np.ndarray) -> np.ndarray:
        found = found[np.lexsort(found.T[::-1])]
        new = np.ones(len(found), bool)
        new[1:] = (found[1:] != found[:-1]).any(1)
        return found[new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            found = distinct(np.concatenate(held))
            pair = mix64(found[:, 0].astype(np.uint64) << np.uint64(32) | found[:, 1].astype(np.uint64))
            part = (pair >> np.uint64(54)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            found, edge = found[order], np.searchsorted(part[order], np.arange(RANGES + 1))
            some = np.flatnonzero(np.diff(edge))
            packed = [found[edge[r] : edge[r + 1]].tobytes() for r in some]
            return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(packed, pa.binary())], names=["part", "phrases"])

        for ids in _ids(batches):
            for words, (at, bucket) in enumerate(_levels(ids, shared.value, longest), 2):
                at = at[_passes(shared.value[words - 2], bucket)]
                phrase = np.full((len(at), longest), MARK, "<i4")
                for w in range(words):
                    phrase[:, w] = ids[at + w]
                held.append(distinct(phrase) if len(at) else phrase)
                size += len(held[-1])
            if size > HELD // 4:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    def once(table: pa.Table) -> pa.Table:
        found = distinct(np.concatenate([np.frombuffer(x, "<i4") for x in table["phrases"].to_pylist()]).reshape(-1, longest))
        return pa.table(
            {
                "part": pa.array([table["part"][0].as_py()], pa.int32()),
                "n": pa.array([len(found)], pa.int64()),
                "phrases": pa.array([found.tobytes()], pa.binary()),
            }
        )

    found = numbered.mapInArrow(tidy(run), "part int, phrases binary")
    return found.groupBy("part").applyInArrow(once, "part int, n long, phrases binary")


class DoubleArray:
    """A double-array trie over word numbers.  The first ``words`` places are the
    states of single words; a state s has the child base[s] + w for word w if
    check there is s."""

    def __init__(self, words: int, base: np.ndarray, check: np.ndarray):
        self.words, self.base, self.check = words, base, check

    @classmethod
    def build(cls, phrases: np.ndarray, words: int) -> tuple[DoubleArray, np.ndarray]:
        """The trie of rows of word numbers (each with its prefixes from two words
        on), and the state of each row."""
        size = np.argmax(phrases == MARK, axis=1)
        size[(phrases != MARK).all(1)] = phrases.shape[1]
        room = words + 2 * len(phrases) + 1024
        base, check = np.zeros(room, np.int32), np.full(room, -1, np.int32)
        free = np.ones(room, bool)
        free[:words] = False
        state = np.full(len(phrases), -1, np.int64)
        parents = phrases[:, 0].astype(np.int64)  # of rows of the level at hand
        low = words
        for level in range(2, phrases.shape[1] + 1):
            mine = np.flatnonzero(size == level)
            if level > 2:
                # a parent is the row that holds all words but the last
                above = np.flatnonzero(size == level - 1)
                parents = state[above[_find(phrases[above, : level - 1], phrases[mine, : level - 1])]]
            else:
                parents = phrases[mine, 0].astype(np.int64)
            order = np.lexsort((phrases[mine, level - 1], parents))
            mine, parents = mine[order], parents[order]
            code = phrases[mine, level - 1].astype(np.int64)
            edge = np.append(np.flatnonzero(np.diff(parents, prepend=-1)), len(mine))
            many = np.diff(edge)
            for g in np.argsort(-many, kind="stable"):
                if many[g] == 1:
                    break
                child = code[edge[g] : edge[g + 1]]
                while True:
                    tries = low + np.flatnonzero(free[low : low + 4096])[:256] - child[0]
                    span = int(child[-1]) + 1
                    if len(free) < low + 4096 + span + 1:
                        grow = len(free) + span + 4096
                        base, check = np.append(base, np.zeros(grow, np.int32)), np.append(check, np.full(grow, -1, np.int32))
                        free = np.append(free, np.ones(grow, bool))
                        continue
                    good = np.ones(len(tries), bool)
                    for c in child[:64]:
                        good[good] = free[tries[good] + c]
                        if not good.any():
                            break
                    for b in tries[good]:
                        if free[b + child].all():
                            break
                    else:
                        # nothing fits here: look further on
                        low += 1024
                        continue
                    break
                place = b + child
                free[place] = False
                base[parents[edge[g]]], check[place] = b, parents[edge[g]]
                state[mine[edge[g] : edge[g + 1]]] = place
            # only children fit anywhere
            single = np.flatnonzero(many == 1)
            slots = words + np.flatnonzero(free[words:])[: len(single)]
            if len(slots) < len(single):
                start = len(free)
                grow = len(single) - len(slots) + 1024
                base, check = np.append(base, np.zeros(grow, np.int32)), np.append(check, np.full(grow, -1, np.int32))
                free = np.append(free, np.ones(grow, bool))
                slots = np.append(slots, np.arange(start, start + len(single) - len(slots)))
            at = edge[:-1][single]
            free[slots] = False
            base[parents[at]], check[slots] = slots - code[at], parents[at]
            state[mine[at]] = slots
            low = words
        last = int(state.max(initial=words - 1)) + 1
        return cls(words, base[:last].copy(), check[:last].copy()), state

    def advance(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which states have a child for their word, those children)."""
        to = self.base[state] + word
        good = (to >= self.words) & (to < len(self.check))
        good[good] = self.check[to[good]] == state[good]
        return good, to[good]

    def count(self, ids: np.ndarray, longest: int, total: np.ndarray) -> None:
        """Add the occurrences of every phrase in ``ids`` to ``total``."""
        at = np.flatnonzero(ids >= 0)
        state = ids[at].astype(np.int64)
        for level in range(1, longest):
            inside = at + level < len(ids)
            at, state = at[inside], state[inside]
            word = ids[at + level]
            on = word >= 0
            at, state, word = at[on], state[on], word[on]
            good, state = self.advance(state, word)
            at = at[good]
            if not len(at):
                return
            total += np.bincount(state, minlength=len(total))


def _find(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Place in ``table`` (distinct rows) of each of ``rows``, which are all there."""
    both = np.concatenate([table, rows])
    _, group = np.unique(both, axis=0, return_inverse=True)
    group = group.reshape(-1)
    place = np.zeros(group.max(initial=-1) + 1, np.int64)
    place[group[: len(table)]] = np.arange(len(table))
    return place[group[len(table) :]]


def count_phrases(numbered: DataFrame, found: DataFrame, words: int, longest: int, most_states: int = STATES) -> DataFrame:
    """(gids array<int>, f): how often each candidate occurs."""
    spark = numbered.sparkSession
    total = found.agg(F.sum("n").alias("n")).first()["n"] or 0
    shards = max(1, -(-total // most_states))

    def build(table: pa.Table) -> pa.Table:
        phrases = np.concatenate([np.frombuffer(x, "<i4") for x in table["phrases"].to_pylist()]).reshape(-1, longest)
        trie, state = DoubleArray.build(phrases, words)
        return pa.table(
            {
                "shard": pa.array([table["shard"][0].as_py()], pa.int32()),
                "base": pa.array([trie.base.tobytes()], pa.large_binary()),
                "check": pa.array([trie.check.tobytes()], pa.large_binary()),
                "state": pa.array([state.astype("<i8").tobytes()], pa.large_binary()),
                "phrases": pa.array([phrases.tobytes()], pa.large_binary()),
            }
        ).cast(pa.schema([("shard", pa.int32())] + [(c, pa.binary()) for c in ("base", "check", "state", "phrases")]))

    sharded = found.select(F.pmod("part", F.lit(shards)).cast("int").alias("shard"), "phrases")
    tries = materialize(
        sharded.groupBy("shard").applyInArrow(build, "shard int, base binary, check binary, state binary, phrases binary")
    )
    counted = None
    for shard in range(shards):
        one = tries.where(F.col("shard") == shard).select("base", "check").first()
        if one is None:
            continue
        shared = spark.sparkContext.broadcast((np.frombuffer(one["base"], np.int32), np.frombuffer(one["check"], np.int32)))
        part = materialize(_shard_counts(numbered, shared, shard, words, longest))
        counted = part if counted is None else counted.unionByName(part)

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, state, phrases in zip(*(b.column(i).to_pylist() for i in range(3))):
                state, phrases = np.frombuffer(state, "<i8"), np.frombuffer(phrases, "<i4").reshape(-1, longest)
                for a in range(0, len(state), 1 << 16):
                    p = phrases[a : a + (1 << 16)]
                    at = np.concatenate([[0], np.cumsum((p != MARK).sum(1))]).astype(np.int32)
                    gids = pa.ListArray.from_arrays(pa.array(at), pa.array(p[p != MARK]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(p), shard, np.int32)), pa.array(state[a : a + (1 << 16)]), gids],
                        names=["shard", "state", "gids"],
                    )

    if counted is None:
        return spark.createDataFrame([], "gids array<int>, f long")
    named = tries.select("shard", "state", "phrases").mapInArrow(tidy(states), "shard int, state long, gids array<int>")
    return named.join(counted, ["shard", "state"]).select("gids", "f")


def _shard_counts(numbered: DataFrame, shared, shard: int, words: int, longest: int) -> DataFrame:
    """(shard, state, f): counts of one trie's states, summed over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = DoubleArray(words, *shared.value)
        total = np.zeros(-(-len(trie.check) // SLICE) * SLICE, np.int64)
        for ids in _ids(batches):
            trie.count(ids, longest, total)
        rows = total.reshape(-1, SLICE)
        some = np.flatnonzero(rows.any(1))
        packed = pa.array([rows[s].tobytes() for s in some], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(some), packed], names=["slice", "n"])

    def summed(table: pa.Table) -> pa.Table:
        total = np.zeros(SLICE, np.int64)
        for x in table["n"].to_pylist():
            total += np.frombuffer(x, np.int64)
        some = np.flatnonzero(total)
        state = table["slice"][0].as_py() * SLICE + some
        return pa.table(
            {"shard": pa.array(np.full(len(some), shard, np.int32)), "state": pa.array(state), "f": pa.array(total[some])}
        )

    slices = numbered.mapInArrow(tidy(run), "slice long, n binary")
    return slices.groupBy("slice").applyInArrow(summed, "shard int, state long, f long")


def mine(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int | None = TOP,
    cover_percent: int = COVER_PERCENT,
    most_words: int = WORDS,
    most_states: int = STATES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases (None: all) of
    2 to ``max_words`` words of each language."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    texts = texts.where(F.col("text").isNotNull())
    counted = materialize(count_words(texts))
    frequent = counted.where(F.col("n") >= min_count)
    order = [F.desc("n"), F.col("lang"), F.col("word")]
    words = materialize(
        consecutive_index(frequent, order, "gid").select(F.col("gid").cast("int").alias("gid"), "lang", "word", "hash", "n")
    )
    size = words.count()
    if not size:
        return spark.createDataFrame([], RESULT)
    numbered = materialize(number_texts(texts, words, most_words))
    bitmaps: list[np.ndarray] = []
    for _ in range(2, max_words + 1):
        bitmaps.append(frequent_buckets(numbered, bitmaps, min_count))
    found = materialize(candidates(numbered, bitmaps))
    phrases = count_phrases(numbered, found, size, max_words, most_states)
    phrases = materialize(phrases.where(F.col("f") >= min_count))
    return _ranked(phrases, words, counted, top, cover_percent)


def _ranked(phrases: DataFrame, words: DataFrame, counted: DataFrame, top: int | None, cover_percent: int) -> DataFrame:
    single = words.select(F.array("gid").alias("gids"), F.col("n").alias("f"))
    known = phrases.unionByName(single)
    wide = lambda c: c.cast("decimal(38,0)")

    cuts = phrases.select("gids", "f", F.explode(F.sequence(F.lit(1), F.size("gids") - 1)).alias("k"))
    cuts = cuts.select(
        "gids", "f", "k", F.slice("gids", 1, F.col("k")).alias("first"), F.expr("slice(gids, k + 1, size(gids) - k)").alias("rest")
    )
    cuts = cuts.join(known.select(F.col("gids").alias("first"), F.col("f").alias("l")), "first")
    cuts = cuts.join(known.select(F.col("gids").alias("rest"), F.col("f").alias("r")), "rest")
    cuts = cuts.withColumn("scaled", wide(F.col("f")) * wide(F.lit(SCORE_SCALE)))
    score = F.expr("cast(cast(scaled as decimal(38,0)) div cast(l + r as decimal(38,0)) as bigint)")
    scored = cuts.groupBy("gids", "f").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = phrases.where(F.size("gids") > 2).select("f", "gids", F.explode(F.sequence(F.lit(2), F.size("gids") - 1)).alias("m"))
    inner = inner.select("f", "gids", "m", F.explode(F.expr("sequence(1, size(gids) - m + 1)")).alias("i"))
    inner = inner.groupBy(F.expr("slice(gids, i, m)").alias("gids")).agg(F.max("f").alias("longer"))
    covered = F.coalesce(wide(F.col("longer")) * 100 >= wide(F.col("f")) * cover_percent, F.lit(False))
    kept = scored.join(inner, "gids", "left").where(~covered).select("gids", "f", "cut")

    spelled = kept.select("gids", F.posexplode("gids").alias("at", "gid")).join(words.select("gid", "lang", "word"), "gid")
    spelled = spelled.groupBy("gids").agg(
        F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("parts")
    )
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    out = kept.join(spelled, "gids").join(totals, "lang")
    out = out.select(
        "lang",
        F.array_join("parts.word", " ").alias("phrase"),
        F.col("f").alias("a"),
        F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"),
        "n",
        F.col("cut.score").alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = out.withColumn("rank", F.row_number().over(order))
    if top is not None:
        out = out.where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
