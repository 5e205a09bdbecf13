"""WARC archives, mixing, the pipeline and the registered queries."""

from __future__ import annotations

import hashlib
import os

import brute
import corpus_pipeline
import duckdb
import numpy as np
import pytest
import tiktoken
import public_tokenizers
import zstandard
from pyspark.sql import functions as F

from quire.llm import byte_bpe, importance, mixing, queries, warc

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string, payload_digest string"


def _pages(spark):
    rows = [(i, f"http://x/{i}", f"<p>{'é' * (i % 7)}{i % 5}</p>" * 40, "x") for i in range(60)]
    rows += [(60, None, None, "x"), (61, "http://y\r\nWARC-Type: z", "", "x"), (62, "u", "a\r\n\r\nb\x00" + "z" * 300_000, "x")]
    rows += [(5, "again", rows[5][2], "x"), (7, "other", "another payload", "x"), (None, "n", rows[3][2], "x")]
    return spark.createDataFrame(rows, PAGES).repartition(3)


def test_archives_round_trip(spark, scratch):
    pages = _pages(spark)
    path = warc.write_archives(pages, os.path.join(scratch, "w"))
    read = warc.read_archives(spark, path)
    rows = read.collect()
    assert len(rows) == pages.count()
    by_payload = {}
    for p in pages.collect():
        by_payload.setdefault((p.html or "").encode(), []).append(p.page_id)
    largest = {k: max((i for i in v if i is not None), default=None) for k, v in by_payload.items()}
    digests = {warc.payload_digest(k): k for k in by_payload}
    for r in rows:
        payload = digests[r.payload_digest]
        page = r.record_id.removeprefix("urn:page:")
        assert r.payload_bytes == len(payload)
        if page == str(largest[payload]):
            assert r.record_type == "response" and r.payload == payload and r.refers_to is None
        else:
            assert r.record_type == "revisit" and r.payload is None
            assert r.refers_to == f"urn:page:{largest[payload]}"
    assert read.where("target_uri like '%WARC-Type%'").count() == 1
    assert warc.read_archives(spark, path, with_payload=False).where("payload is not null").count() == 0


def test_revisit_threshold(spark, scratch):
    path = warc.write_archives(_pages(spark), os.path.join(scratch, "w"), revisit_bytes=10**6)
    assert warc.read_archives(spark, path).where("record_type = 'revisit'").count() == 0


def test_archive_layout_and_damage(spark, scratch):
    path = warc.write_archives(_pages(spark), os.path.join(scratch, "w"))
    file = next(os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("part"))
    data = open(file, "rb").read()
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_MAGIC
    frames = list(warc.frames_of(data))
    assert len(frames) > 5
    at, body = frames[0]
    # any zstd reader decodes a frame given the dictionary
    n = int.from_bytes(data[4:8], "little")
    codec = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + n]))
    assert codec.decompress(data[at : warc.frame_end(memoryview(data), at)]) == body
    with pytest.raises(ValueError):
        list(warc.frames_of(data[: len(data) - 20]))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.frames_of(data[: at + 30] + b"\xff\xff\xff" + data[at + 33 :]))
    good = warc.record(1, "u", b"payload", None)
    assert warc.parse_record(good)["payload"] == b"payload"
    for bad in (
        good.replace(b"payload\r\n\r\n", b"payl0ad\r\n\r\n"),
        good.replace(b"WARC/1.1", b"HTTP/1.1"),
        good.replace(b"WARC-Record-ID", b"X-Record-ID"),
        good + b"x",
        good[:-4],
        good.replace(b"WARC-Type: response", b"WARC-Type: unknown"),
    ):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def test_archives_of_an_empty_table(spark, scratch):
    path = warc.write_archives(spark.createDataFrame([], PAGES), os.path.join(scratch, "w"))
    assert warc.read_archives(spark, path).count() == 0


# --- mixing -------------------------------------------------------------------------


def _targets(sizes, weights, share, copies):
    """Water filling by hand."""
    left, target = share * sum(sizes.values()), {}
    open_ = dict(zip(sizes, weights))
    while open_:
        level = left / sum(open_.values())
        dry = [s for s in open_ if copies * sizes[s] <= open_[s] * level]
        if not dry:
            return target | {s: w * level for s, w in open_.items()}
        for s in dry:
            target[s] = copies * sizes[s]
            left -= target[s]
            del open_[s]
    return target


def test_shares(spark, odd, repeated):
    for df in (odd, repeated):
        out = mixing.shares(df).toPandas()
        sizes = {}
        for r in df.collect():
            sizes[r.source] = sizes.get(r.source, 0) + len(brute.WORDS.findall((r.text or "").encode()))
        order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
        want = _targets({s: sizes[s] for s in order}, [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5, 2)
        assert len(out) == df.count()
        assert set(np.round(out.target, 6)) == set(np.round(list(want.values()), 6))
        assert ((out.taken == 0) | (out.taken == out["size"]) | (out.taken == 2 * out["size"])).all()
        for target, rows in out.groupby("target"):
            assert rows.taken.sum() <= target * (1 + 1e-9)


def test_shares_come_near_their_targets(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    named = docs.select("doc_id", "source")
    out = mixing.shares(docs).join(named, "doc_id").toPandas()
    largest = out["size"].max()
    for _, rows in out.groupby("source"):
        assert 0 <= rows.target.iloc[0] - rows.taken.sum() <= largest


def test_mix_is_the_sorted_queue(spark, odd, empty):
    wide = odd.withColumn("virtual_finish", F.lit("old"))
    rows = mixing.mix(wide).collect()
    times = [r.virtual_finish for r in rows]
    assert times == sorted(times)
    taken = {r.doc_id: r.taken // r["size"] for r in mixing.shares(odd).collect() if r["size"]}
    found = {}
    for r in rows:
        found[r.doc_id] = found.get(r.doc_id, 0) + 1
    assert found == {k: n for k, n in taken.items() if n}
    assert [r.doc_id for r in mixing.mix(wide).collect()] == [r.doc_id for r in rows]
    assert mixing.mix(empty).count() == 0 and mixing.shares(empty).count() == 0


def test_buckets_do_not_change_the_queue(spark, odd, monkeypatch):
    want = sorted(mixing.shares(odd).collect())
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 0.01)  # four digits, two levels
    assert sorted(mixing.shares(odd).collect()) == want


def test_mixing_runs_no_python(spark):
    plan = mixing.shares(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# --- pipeline -----------------------------------------------------------------------


def test_pipeline_equals_brute_force(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    drawn = importance.resample(spark.read.parquet(f"{SMALL}/documents.parquet"), labels).toPandas()
    k = int(drawn.selected.sum())
    good = set(drawn.nlargest(k, "draw").doc_id)
    assert good == set(drawn[drawn.selected].doc_id)
    _, parts = brute.jaccard_components({i: docs[i].text for i in good}, 5, 80)
    first = {i: docs[i].text for i in good if parts[i] == i}
    cut = {
        i: bytes(b for b, g in zip(body, gone) if not g).decode("utf-8", "ignore")
        for i, (body, gone) in brute.repeated_bytes(first).items()
    }
    sizes, queue = {}, {}
    for i, t in cut.items():
        s = docs[i].source
        n = len(brute.WORDS.findall(t.encode()))
        queue.setdefault(s, []).append((hashlib.md5(str(i).encode()).hexdigest(), i, n))
        sizes[s] = sizes.get(s, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = [(3, 1, 2)[i % 3] for i in range(len(order))]
    target = _targets({s: sizes[s] for s in order}, weights, 1.5, 2)
    want = []
    for s in order:
        done = 0
        for _ in range(2):
            for _, i, n in sorted(queue[s]):
                done += n
                if n and done <= target[s] * (1 + 1e-12):
                    want.append(i)
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(r.doc_id for r in out) == sorted(want)
    bpe = tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS)),
    )
    for r in out:
        ids = np.array(bpe.encode_ordinary(cut[r.doc_id]), "<u4")
        assert r.ids == ids.tobytes() and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(cut[r.doc_id].encode()).hexdigest()


def test_stages_take_odd_documents(spark, odd, empty, repeated):
    clash = odd.withColumnRenamed("score", "draw").withColumnRenamed("kept", "n_bytes")
    for df in (clash, empty, repeated):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, MEDIUM)
            if name != "tokens":
                assert out.columns == df.columns
            out.collect()
    # each stage's decision, one by one
    assert corpus_pipeline.near_dups(spark, odd, MEDIUM).count() < odd.count()
    assert corpus_pipeline.passages(spark, odd, MEDIUM).agg(F.sum("n_chars")).first()[0] < odd.agg(F.sum("n_chars")).first()[0]


# --- registered queries ------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    out = queries.QUERIES[name](spark, SMALL)
    assert sorted(out.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, out.select(columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
