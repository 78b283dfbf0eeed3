"""Exact dedup, sharding, token codes and packing against brute force."""

from __future__ import annotations

import hashlib
import re
import tempfile
import zlib
from collections import defaultdict

import numpy as np
import pytest

from skyvane.llm import exact_dedup, packing, sharding, token_codes
from skyvane.llm._tokens import default_path

from .fixtures import awkward_docs, awkward_texts, empty_docs


@pytest.fixture(scope="module")
def docs(spark):
    return awkward_docs(spark)


def texts_by_id():
    return {3 * i + 1: t or "" for i, t in enumerate(awkward_texts())}


def ids_by_doc():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(default_path())
    return {d: t.encode(x, add_special_tokens=False).ids for d, x in texts_by_id().items()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_exact_dedup(docs):
    groups = defaultdict(list)
    norm = {d: re.sub(r"[\x20\x09-\x0D]+", " ", t) for d, t in texts_by_id().items()}
    for d, t in norm.items():
        groups[t].append(d)
    got = exact_dedup.deduplicate(docs, bucket_digests=4).collect()
    assert len(got) == len(norm)
    for r in got:
        g = groups[norm[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (min(g), len(g), r.doc_id == min(g))
        assert r.text_sha256 == hashlib.sha256(norm[r.doc_id].encode()).hexdigest()


def test_exact_dedup_null_and_repeated_ids(spark):
    rows = [(None, "a"), (None, "a"), (4, "b"), (4, "b"), (None, "b"), (2, None), (9, "")]
    got = exact_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r)
    assert sorted(sum(r.kept for r in g) for g in by.values()) == [1, 1, 1]
    b = by[hashlib.sha256(b"b").hexdigest()]
    assert {r.keep_id for r in b} == {4} and {r.group_size for r in b} == {3}
    assert {r.keep_id for r in by[hashlib.sha256(b"a").hexdigest()]} == {None}


def test_cuckoo_filter_insert_delete_resize():
    keys = [hashlib.sha256(str(i).encode()).digest()[:16] for i in range(3000)]
    x = exact_dedup.Bucket()
    for i, k in enumerate(keys):
        assert x.add(k, i, i)
        assert not x.add(k, i + 1, i)
    assert x.filter.resizes > 0 and all(k in x.filter for k in keys)
    packed = exact_dedup.CuckooFilter.unpack(x.filter.pack())
    assert all(k in packed for k in keys)
    for k in keys[:1500]:
        assert not x.remove(k)
        assert x.remove(k)
        assert not x.remove(k)
    assert all(k in x.filter for k in keys[1500:])
    assert sum(k in x.filter for k in keys[:1500]) < 30          # false positives only
    assert len(x.keys) == 1500


def test_digest_index_over_time(spark, docs):
    index = exact_dedup.DigestIndex(spark, 3).insert(docs)
    live = index.live.count()
    assert index.duplicates(docs).count() == docs.count()
    index.insert(docs).delete(docs)
    assert index.live.count() == live
    index.delete(docs)
    assert index.live.count() == 0 and index.duplicates(docs).count() == 0


def test_sharding(docs):
    got = sharding.assign(docs, 16).collect()
    texts = texts_by_id()
    assert len(got) == len(texts)
    slots = defaultdict(list)
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_jump_hash_against_scalar_form():
    def scalar(k, n):
        b, j = -1, 0
        while j < n:
            b = j
            k = (k * 2862933555777941757 + 1) % (1 << 64)
            j = int((b + 1) * (float(1 << 31) / ((k >> 33) + 1)))
        return b
    keys = np.arange(-500, 500, dtype=np.int64)
    mixed = sharding.mix(keys.view(np.uint64))
    for n in (1, 2, 16, 17, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [scalar(int(k), n) for k in mixed]
    grown = sharding.jump_hash(np.arange(40000), 17)
    assert abs(np.mean(grown == 16) - 1 / 17) < 0.01


def test_token_codes_round_trip(spark, docs):
    path = tempfile.mkdtemp(prefix="dac-") + "/files"
    token_codes.write(docs, path, segment_ids=3000)
    want = ids_by_doc()
    start, stream = 0, []
    got = sorted(token_codes.documents(spark, path).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == sorted(want)
    for r in got:
        ids = [*want[r.doc_id], 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
        stream += ids
    places = [0, 1, 77, start - 1, start, -1, *range(3, start, 977)]
    found = {r.place: r.token for r in token_codes.lookup(
        spark, path, spark.createDataFrame([(p,) for p in places], "place long")).collect()}
    assert found == {p: stream[p] if 0 <= p < start else None for p in places}


@pytest.mark.parametrize("top", [1, 15, 16, 255, 300, 4095, 70000, 1 << 31])
def test_segment_random_access(top):
    ids = (np.random.default_rng(top).random(5000) ** 4 * (top + 1)).astype(np.uint32)
    s = token_codes.Segment(token_codes.encode_segment([1, None], np.array([0, 10, 5000]), ids))
    at = np.random.default_rng(1).integers(0, 5000, 800)
    assert (s.tokens(at) == ids[at]).all() and (s.all() == ids).all()
    assert s.null.tolist() == [False, True]


def test_packing(docs):
    path = tempfile.mkdtemp(prefix="packed-") + "/pieces"
    want = {d: [*x, 2] for d, x in ids_by_doc().items()}
    got = packing.pack(docs, path).collect()
    pieces, sequences, steps = defaultdict(list), defaultdict(list), defaultdict(int)
    for r in got:
        ids = want[r.doc_id][r.start:r.start + r.length]
        assert (r.length, r.doc_tokens, r.ids_crc32) == (len(ids), len(want[r.doc_id]), crc(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
        steps[r.step_group] += r.length
    assert set(pieces) == set(want)
    for d, p in pieces.items():
        at = 0
        for s, n in sorted(p):
            assert s == at
            at += n
        assert at == len(want[d])
    for p in sequences.values():
        at = 0
        for o, n in sorted(p):
            assert o == at
            at += n
        assert at <= 4096 and at & (at - 1) == 0             # nothing to pad
    assert sorted(sequences) == list(range(len(sequences)))
    assert max(steps.values()) <= packing.STEP_TOKENS


def test_empty_tables(spark):
    e = empty_docs(spark)
    base = tempfile.mkdtemp(prefix="empty-")
    assert exact_dedup.deduplicate(e).count() == 0
    assert sharding.assign(e, 16).count() == 0
    token_codes.write(e, base + "/t")
    assert token_codes.documents(spark, base + "/t").count() == 0
    assert packing.pack(e, base + "/p").count() == 0


def test_digest_index_names_live_keepers(spark):
    """After the keeper goes the next smallest live id is named; unknown deletions and repeated rows count as they should."""
    def table(*rows):
        return spark.createDataFrame(rows, "doc_id long, text string")

    def named(*rows):
        return sorted((r.doc_id or -1, r.keep_id) for r in index.duplicates(table(*rows)).collect())

    index = exact_dedup.DigestIndex(spark, 2, 4)
    index.insert(table((1, "a b"), (5, "a  b"), (3, "a b"), (3, "a b"), (9, "c"), (None, "c"), (None, "d"), (7, None)))
    assert named((100, "a\tb"), (101, "c"), (102, "x"), (103, ""), (100, "a b")) == [(100, 1), (100, 1), (101, 9), (103, 7)]
    index.delete(table((1, "a b"), (8, "a b"), (9, "c"), (2, "never there")))
    assert named((100, "a b"), (101, "c"), (104, "d")) == [(100, 3), (101, None), (104, None)]
    index.delete(table((3, "a b"), (5, "a b")))
    assert named((100, "a b")) == [(100, 3)]
    index.delete(table((3, "a b"), (None, "c"), (None, "c")))
    assert named((100, "a b"), (101, "c"), (104, "d")) == [(104, None)]
    # buckets follow the live digests, and the filters go on knowing all of them
    index.insert(table(*[(i, f"text {i}") for i in range(200)]))
    assert index.n_buckets == 64 and index.filters.count() <= 64
    assert len(named(*[(1000 + i, f"text {i}") for i in range(0, 200, 7)])) == 29
    index.delete(table(*[(i, f"text {i}") for i in range(100)]))
    assert len(named(*[(1000 + i, f"text {i}") for i in range(200)])) == 100


def test_lookup_opens_wanted_segments_only(spark, docs, monkeypatch):
    path = tempfile.mkdtemp(prefix="codes-")
    token_codes.write(docs, path + "/t", segment_ids=500)
    want = np.concatenate([np.append(np.array(i, np.int64), 1) for _, i in sorted(ids_by_doc().items())])
    places = [0, 499, 500, 501, len(want) - 1, len(want), -1, None, 7, 7]
    df = spark.createDataFrame([(p,) for p in places], "place long")
    for stretch in (64, 500, 1 << 18):
        got = sorted((r.place is None, r.place or 0, r.token) for r in token_codes.lookup(spark, path + "/t", df, stretch=stretch).collect())
        assert [g[:2] for g in got] == sorted((p is None, p or 0) for p in places)
        assert all(t == (int(want[p]) if not null and 0 <= p < len(want) else None) for null, p, t in got)
    plan = token_codes.lookup(spark, path + "/t", df)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "NestedLoop" not in plan
