"""Near dedup, substring dedup and decontamination against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from skyvane.llm import _tables, decontaminate, near_dedup, substring_dedup
from skyvane.llm._text import Words, buffers, ngram_hash

from .fixtures import awkward_docs, awkward_texts, empty_docs

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def near_texts():
    """A chain of edits, a star, pairs on either side of 0.75, and a large group of near copies."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice(["ba", "do", "ki", "mu", "ra"]) for _ in range(3))
    out = []
    base = [word() for _ in range(150)]
    for k in range(40):                                     # chain: each a few edits from the one before
        base = list(base)
        for _ in range(2):
            base[rnd.randrange(150)] = word()
        out.append(" ".join(base))
    hub = [word() for _ in range(120)]
    for k in range(150):                                    # group: all edits of one text, most pairs near 0.75
        x = list(hub)
        for _ in range(rnd.randint(1, 4)):
            x[rnd.randrange(120)] = word()
        out.append(" ".join(x))
    for n in range(2, 12):                                  # short texts
        x = [word() for _ in range(n)]
        out += [" ".join(x), " ".join(x).upper(), " ".join(x + [word()])]
    return out


def brute_near(rows):
    sets = {}
    for d, t in rows:
        w = split((t or "").translate(LOWER))
        sets[d] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


@pytest.mark.parametrize("block,stars", [(near_dedup.BLOCK, near_dedup.STARS), (4, 1)])
def test_near_dedup(spark, monkeypatch, block, stars):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "STARS", stars)
    monkeypatch.setattr(near_dedup, "MEMBERS", 256 if block > 4 else 5)
    monkeypatch.setattr(_tables, "BROADCAST_ROWS", 0 if block == 4 else 500_000)
    rows = [(7 * i % 1009, t) for i, t in enumerate(awkward_texts() + near_texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_near(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == want


def test_near_estimate_is_corrected_for_collisions():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    for j in (0.0, 0.5, 0.75, 1.0):
        n = int(round(1000 * 2 * j / (1 + j)))
        errors = []
        for _ in range(30):
            b = np.concatenate([a[:n], rng.integers(0, 1 << 63, 1000 - n, dtype=np.uint64)])
            x, y = (np.frombuffer(near_dedup.pack_bits(near_dedup.minima(s)), np.uint64)[None, :] for s in (a, b))
            errors.append(float(near_dedup.estimate(x, y)[0]) - j)
            a = rng.permutation(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
        assert abs(np.mean(errors)) < 0.03


def test_near_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "x y z"), (5, None), (None, "")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == sorted(
        [(1, 2, 1, True), (1, 2, 1, True), (0, 2, 1, False), (0, 1, 0, True), (5, 0, 5, True), (0, 0, 0, True)])


def brute_removed(rows):
    first = {}
    for d, t in rows:
        w = split(t)
        for k in range(len(w) - 12):
            g = tuple(w[k:k + 13])
            first[g] = min(first.get(g, d), d)
    out = {}
    for d, t in rows:
        w = split(t)
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k:k + 13])] < d for j in range(13)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("chunk,bucket", [(substring_dedup.CHUNK, substring_dedup.BUCKET_BYTES), (3000, 600)])
def test_substring_dedup(spark, monkeypatch, chunk, bucket):
    if chunk == 3000:
        monkeypatch.setattr(substring_dedup, "BROADCAST_BYTES", 0)
    rnd = random.Random(3)
    vocabulary = ["a", "b", "cc", "d"]
    rows = [(5 * i % 997, t) for i, t in enumerate(awkward_texts() + near_texts())]
    passage = " ".join(f"w{i}" for i in range(60))
    for k in range(120):                     # few words: shared symbols everywhere, runs, windows at the edges
        t = " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(5, 60)))
        if k % 3 == 0:
            at = rnd.randrange(40)
            t += " " + " ".join(passage.split()[at:at + rnd.randint(12, 16)]) + " " + rnd.choice(vocabulary) * 3
        rows.append((2000 + k, t + " x" * (k % 17)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.deduplicate(docs, chunk=chunk, bucket_bytes=bucket).collect()}
    assert got == brute_removed(rows)


def test_recompression_gives_equal_substrings_equal_symbols():
    import pyarrow as pa
    rnd = random.Random(5)
    words = [rnd.choice("abcdefgh") for _ in range(400)]
    for _ in range(60):
        n, at = rnd.randint(13, 60), rnd.randrange(300)
        piece = words[at:at + n]
        texts = [" ".join([rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 9))] + piece
                          + [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 9))]) for _ in range(2)]
        found = []
        for t in texts:
            data, off = buffers(pa.array([t]))
            w = Words(data, off)
            name, lo, hi = substring_dedup.recompress(w.hash, w.first)
            start = next(i for i in range(len(w)) if t.split()[i:i + len(piece)] == piece)
            inside = (lo >= start) & (hi <= start + len(piece))
            found.append([(int(a), int(b - start), int(c - start)) for a, b, c in zip(name[inside], lo[inside], hi[inside])])
        assert set(found[0]) == set(found[1])


def leak_rows():
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice(["sel", "tor", "vim", "pag", "lun", "é"]) for _ in range(3))
    items = [(i, " ".join(word() for _ in range(rnd.randint(15, 59)))) for i in range(40)]
    items += [(50, "too short"), (51, None), (52, ""), (53, items[3][1]), (None, items[4][1])]
    docs, leaks = [], {}
    for d in range(300):
        w = [word() for _ in range(rnd.randint(30, 400))]
        kind = d % 6
        if kind < 3:
            i, t = items[d % 40]
            p = t.split()
            if kind == 1:                                   # edited: every seventh word replaced
                p = [word() if k % 7 == 3 else x for k, x in enumerate(p)]
            if kind == 2:                                   # words dropped and put in, other case and punctuation
                p = [x.upper() + "," for k, x in enumerate(p) if k % 9 != 5]
                p.insert(5, word())
            at = rnd.randrange(len(w))
            w[at:at] = p
            leaks[d] = i
        docs.append((d, " ".join(w)))
    # one passage that many documents share is still found
    docs += [(1000 + k, f"{word()} " + items[0][1] + f" {word()}") for k in range(60)]
    leaks.update({1000 + k: 0 for k in range(60)})
    docs += [(5000, None), (5001, ""), (5002, "too short")]
    return items, docs, leaks


@pytest.mark.parametrize("shard", [decontaminate.SHARD_WORDS, 300])
def test_decontamination(spark, shard):
    items, docs, leaks = leak_rows()
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = decontaminate.contaminated(table, bench, shard).collect()
    pairs = defaultdict(set)
    for r in got:
        pairs[r.doc_id].add(r.item_id)
        assert 0.4 <= r.score <= 1 and r.end_word > r.first_word
    assert set(pairs) == set(leaks)
    assert all(leaks[d] in pairs[d] for d in pairs)
    assert any(pairs[d] == {3, 53} for d in pairs)          # equal items are both reported
    clean = {r.doc_id for r in decontaminate.clean(table, bench, shard).collect()}
    assert clean == {d for d, _ in docs} - set(leaks)


@pytest.mark.parametrize("step", [4, 5, 6])
def test_decontamination_of_close_edits(spark, step):
    rnd = random.Random(step)
    word = lambda: "".join(rnd.choice(["sel", "tor", "vim", "pag", "lun", "é"]) for _ in range(4))
    items = [(i, " ".join(word() for _ in range(rnd.randint(8, 59)))) for i in range(40)]
    docs = []
    for i, t in items:
        p = [word() if k % step == i % step else x for k, x in enumerate(t.split())]
        docs.append((i, " ".join([word() for _ in range(rnd.randint(0, 90))] + p + [word() for _ in range(rnd.randint(0, 90))])))
        docs += [(1000 + 10 * i + k, f"{word()} {t}") for k in range(i % 3)]          # whole copies beside it
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {(d, d if d < 1000 else (d - 1000) // 10) for d, _ in docs}


def test_decontamination_of_short_items_and_scripts(spark):
    chinese = "中国的首都是哪一座城市，它有多少人口？"
    thai = "เมืองหลวงของประเทศไทยคือเมืองอะไร"
    quoted = "Who wrote \u201cthe old man and the sea\u201d\u00a0and when was it printed first?"
    items = [(1, "Who is Zorvex Quill?"), (2, "zorvex"), (3, chinese), (4, thai), (5, quoted), (6, "who is zorvex quill"), (7, "?!"), (8, "首都在哪")]
    docs = [(10, "They asked: who is “Zorvex Quill”, and left."), (11, "Who is Zorvex A. Quill?"), (12, "答案：" + chinese + "谢谢"),
            (13, "คำถาม " + thai), (14, "who wrote the old man and the sea and when was it printed first"), (15, "quill who is"),
            (16, chinese[:8] + "很" + chinese[9:]), (17, "首都在哪里"), (18, "首都"), (19, "在哪"), (20, None), (21, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = decontaminate.contaminated(table, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [
        (10, 1), (10, 6), (12, 3), (13, 4), (14, 5), (16, 3), (17, 8)]
    assert {r.doc_id for r in decontaminate.clean(table, bench).collect()} == {11, 15, 18, 19, 20, 21}


def test_segment_sets_characters_apart():
    texts = ["a漢字b\u00a0c", "字", "", "x—y", "ÀÉ “q”", "\U00020000z", "漢", "漢a"]
    data, off = decontaminate.segment(*buffers(pa.array(texts)))
    w = Words(data, off, decontaminate.NON_WORD, keep_spans=True)
    words = [[bytes(data[w.start[i]:w.end[i]]).decode() for i in range(w.first[d], w.first[d + 1])] for d in range(len(texts))]
    assert words == [["a", "漢", "字", "b", "c"], ["字"], [], ["x", "y"], ["àé", "q"], ["\U00020000", "z"], ["漢"], ["漢", "a"]]


def test_reach_bounds_the_alignment():
    rnd = np.random.default_rng(3)
    for _ in range(300):
        a, b = (rnd.integers(0, 9, rnd.integers(1, n)).astype(np.uint64) for n in (15, 40))
        assert decontaminate.reach(np.unique(a), b) >= decontaminate.smith_waterman(a, b)[0]


def test_smith_waterman_against_plain_form():
    rnd = np.random.default_rng(2)

    def plain(a, b):
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        return h.max()
    for _ in range(150):
        a, b = rnd.integers(0, 5, rnd.integers(1, 15)), rnd.integers(0, 5, rnd.integers(1, 40))
        score, end, start, hits = decontaminate.smith_waterman(a.astype(np.uint64), b.astype(np.uint64))
        assert score == plain(a, b)
        assert 0 <= start <= end <= len(b) and 2 * hits >= score


def test_awkward_and_empty(spark):
    e = empty_docs(spark)
    assert near_dedup.near_duplicates(e).count() == 0
    assert substring_dedup.deduplicate(e).count() == 0
    bench = spark.createDataFrame([(1, "a b c d e f g h i")], "item_id long, text string")
    assert decontaminate.contaminated(e, bench).count() == 0
    assert decontaminate.contaminated(awkward_docs(spark), bench.limit(0)).count() == 0
    docs = awkward_docs(spark)
    assert near_dedup.near_duplicates(docs).count() == substring_dedup.deduplicate(docs).count() == len(awkward_texts())


def test_near_null_ids_meet_their_own_class_only(spark, monkeypatch):
    """Rows without an id join one row each, whatever their number."""
    rng = np.random.default_rng(3)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 40)) for _ in range(150)]
    texts = base + [t + " end" for t in base] + base[:50]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(7, t) for t in base], "doc_id long, text string")
    joined = []
    real = near_dedup.materialize

    def spy(df, kind):
        out = real(df, kind)
        if kind == "shingle-sets":
            joined.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "materialize", spy)
    got = near_dedup.near_duplicates(docs).collect()
    assert joined and joined[0] <= len(texts) + len(base)
    assert all(r.component_id == 7 for r in got)


def test_near_cut_off_loses_no_more_than_the_bands():
    p = 0.75 + 0.25 / 16
    least = next(k for k in range(129) if (k / 128 - 1 / 16) / (15 / 16) >= near_dedup.PASS)
    lost = sum(math.comb(128, k) * p ** k * (1 - p) ** (128 - k) for k in range(least))
    assert lost <= (1 - 0.75 ** 3) ** 32 < lost + math.comb(128, least) * p ** least * (1 - p) ** (128 - least)


def _seeds(texts):
    return decontaminate.Seeds(decontaminate.Items(list(range(len(texts))), texts))


def test_common_phrases_are_no_seeds():
    """Work on a text that repeats a phrase does not grow with the items that begin with it; their copies are still found."""
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("bcdfgklmnprst") + rnd.choice("aeiou") for _ in range(3))
    phrase = "which of the following is"
    aligned = []
    for n in (100, 1600):
        items = [f"{phrase} {' '.join(word() for _ in range(12))}" for _ in range(n)]
        seeds = _seeds(items)
        assert len(seeds.gram) < 14 * n
        text = " ".join([phrase] * 4000)
        copy = items[7].split()
        copy[9] = "changed"
        data, off = buffers(pa.array([text, " ".join(copy), f"well {items[n - 1]} said"]))
        met = np.isin(ngram_hash(Words(*decontaminate.segment(*buffers(pa.array([text]))), decontaminate.NON_WORD).hash, 3), seeds.gram)
        aligned.append(int(met.sum()))
        assert {(r[0], r[1]) for r in decontaminate.find(data, off, seeds)} == {(1, 7), (2, n - 1)}
    assert aligned == [0, 0]


def test_items_without_a_rare_gram_keep_their_rarest():
    """Every ordering of a few words: all grams are common, each item is still found."""
    words = ["ale", "bun", "cod", "dip"]
    import itertools
    items = [" ".join(p) for p in itertools.islice(itertools.product(words, repeat=8), 0, 40000, 13)]
    seeds = _seeds(items)
    assert set(seeds.item.tolist()) == set(range(len(items)))
    for i in (0, 500, len(items) - 1):
        data, off = buffers(pa.array(["so: " + items[i]]))
        assert i in {r[1] for r in decontaminate.find(data, off, seeds)}


def test_rare_grams_against_plain_form():
    rnd = np.random.default_rng(7)
    for _ in range(50):
        rows = sorted(zip(rnd.integers(0, 12, 400).tolist(), rnd.integers(0, 120, 400).tolist()))
        gram, item = np.array([g for g, _ in rows], np.uint64), np.array([i for _, i in rows])
        holders = {g: len({i for h, i in rows if h == g}) for g, _ in rows}
        kept = decontaminate.rare_grams(gram, item)
        for k, (g, i) in enumerate(rows):
            own = [holders[h] for h, j in rows if j == i]
            if holders[g] <= decontaminate.RARE_ITEMS:
                assert kept[k]
            elif min(own) < 32:
                assert not kept[k]
            else:
                assert kept[k] == (math.floor(math.log2(holders[g])) <= math.floor(math.log2(min(own))))
