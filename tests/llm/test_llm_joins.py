"""Tokenizer alignment, clustering and the n-gram join against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gradus.llm import orchard, tile_join, tokenizer_pairs
from gradus.llm.queries import A_TOKENIZER, B_TOKENIZER, QUERIES

FOLDER = "/root/testdata/sf0.001"
A, B = public_tokenizers.path(A_TOKENIZER), public_tokenizers.path(B_TOKENIZER)


def _aligned(texts: list) -> list[tuple]:
    """Whole texts by the libraries, links by comparing all ends."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = tokenizer_pairs._byte_letters()
    docs, counts = [], Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        ours = a.encode(" " + text, add_special_tokens=False) if text else None
        ids_a, ids_b = (ours.ids, b.encode(text)) if text else ([], [])
        parts_a = [bytes(letters[c] for c in t) for t in ours.tokens] if text else []
        parts_b = []
        for i in ids_b:
            piece = b.id_to_piece(i)
            parts_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
        if not text or b"".join(parts_a) != raw or b"".join(parts_b) != raw:
            docs.append(None)
            continue
        ends_a, ends_b = (np.cumsum([len(p) for p in parts]).tolist() for parts in (parts_a, parts_b))
        links = [(x, y) for x, e in zip(ids_a, ends_a) for y in [dict(zip(ends_b, ids_b)).get(e)] if y is not None]
        cuts, groups = sorted(set(ends_a) & set(ends_b)), []
        for low, high in zip([0, *cuts], cuts):
            of = [",".join(str(i) for i, e in zip(ids, ends) if low < e <= high) for ids, ends in ((ids_a, ends_a), (ids_b, ends_b))]
            groups.append("|".join(of))
        counts.update(links)
        docs.append((ids_a, ids_b, groups, links))
    top: dict = defaultdict(int)
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        best = sum(counts[link] == top[link[1]] for link in d[3])
        total = sum(counts[link] for link in d[3])
        digest = sha256(";".join(d[2]).encode()).hexdigest()
        out.append((len(d[0]), len(d[1]), len(d[2]), len(d[3]), best, total, digest))
    return out


_COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _short_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return {r.doc_id: r.text for r in docs.collect()}


def test_alignment_equals_brute_force(spark):
    texts = _short_texts(spark)
    got = QUERIES["op11_cross_tokenizer_alignment"](spark, FOLDER)
    assert got.columns == ["doc_id", *_COLUMNS]
    wanted = dict(zip(texts, _aligned(list(texts.values()))))
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == wanted
    assert any(w[0] for w in wanted.values())


def test_alignment_cases(spark, monkeypatch):
    rng = random.Random(3)
    letters = "ab  \n\té日本  \u0085.'s0<>|Ω🙂́"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(150)]
    texts += [None, "", " ", "  ", "a ", " a", "a\n b", "▁", "a▁ b", "a ▁ b", "<s> </s>", "<|endoftext|>", "<unk>"]
    texts += ["it's  twice\n\n  done", "\x00 a\x00", "x" * 5000, "word " * 3000, "same text", "same text", "<0x41>"]
    rows = [(i if i != 5 else None, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = df.withColumn("pairs", F.lit("clash")).withColumn("radix", F.lit(1))
    # Several batches, slices and rounds of merging.
    monkeypatch.setattr(tokenizer_pairs, "SLICE_BYTES", 300)
    monkeypatch.setattr(tokenizer_pairs, "FAN", 2)
    got = tokenizer_pairs.align(df, A, B).collect()
    wanted = _aligned([t for _, t in rows])
    pairs = [(i, *w) for (i, _), w in zip(rows, wanted)]
    assert Counter(tuple(r) for r in got) == Counter(pairs)
    empty = tokenizer_pairs.align(df.where("false"), A, B)
    assert empty.columns == ["doc_id", *_COLUMNS] and empty.count() == 0


def test_alignment_over_batches(spark):
    """Runs of several batches count as one corpus."""
    own = tokenizer_pairs.Words(A, B)
    texts = ["one two, one", "two one", "one"] * 3
    batches = []
    for n in range(3):
        batch = tokenizer_pairs._Batch(n)
        batch.add(own, list(range(3)), texts[3 * n : 3 * n + 3])
        batches.append(batch)
    runs = [run for batch in batches for run in batch.runs()]
    assert len(runs) > len({r for r, _, _ in runs})
    for _, pairs, holders in runs:
        keys, counts = tokenizer_pairs._keys(pairs)
        held, docs, times = tokenizer_pairs._unpack(holders)
        assert (np.diff(keys.astype(np.int64)) > 0).all() and held.sum() == len(docs)
        assert counts.sum() == times.sum()


def _kmeans(vectors: list[tuple], k: int = 8, rounds: int = 10) -> list[tuple]:
    kept = []
    for i, v in vectors:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(1024.0 * x)) for x in v]))
    chosen = sorted(kept, key=lambda r: (sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "z", r[1]))
    centroids = [list(v) for _, v in chosen[:k]]

    def nearest(v: list[int]) -> tuple[int, int]:
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for n, members in groups.items():
            centroids[n] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    by = Counter()
    for _, n, d in found:
        by[n] += d
    told = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, d, by[n], sum(by.values()), told[n]) for i, n, d in found]


def test_clusters_equal_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    got = QUERIES["op12_centroid_clustering"](spark, FOLDER)
    assert Counter(tuple(r) for r in got.collect()) == Counter(_kmeans(rows))


def test_cluster_cases(spark):
    rng = np.random.default_rng(5)
    points = [(i, rng.integers(-3, 3, 64).astype(float).tolist()) for i in range(60)]
    rows = points + [(60 + i, points[0][1]) for i in range(40)] + [(7, points[7][1]), (None, points[1][1])]
    rows += [(200, None), (201, []), (202, [0.5] * 63), (203, [None, *[0.0] * 63]), (204, [float("nan")] * 64)]
    rows += [(205, [float("inf")] * 64), (206, [3000.25, *[-0.0001] * 63]), (207, [1e6] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("clash"))
    df = df.withColumn("id", F.lit(1)).withColumn("vector", F.lit(2)).repartition(4)
    got = orchard.cluster(df).collect()
    assert Counter(tuple(r) for r in got) == Counter(_kmeans(rows))
    few = orchard.cluster(df.where("vec_id < 3"))
    assert Counter(tuple(r) for r in few.collect()) == Counter(_kmeans([r for r in rows if r[0] is not None and r[0] < 3]))
    far = spark.createDataFrame([(1, [1e300] * 64), (2, [0.0] * 64), (3, [-1e300] * 64)], "vec_id long, embedding array<double>")
    assert orchard.cluster(far, k=1, rounds=1).agg(F.max("distance"), F.max("inertia")).first()[0] == 2**63 - 1
    assert orchard.cluster(df.where("false")).columns == got[0].__fields__
    assert orchard.cluster(df.where("vec_id = 201")).count() == 0


def test_search_visits_less_and_finds_ties(spark):
    rng = np.random.default_rng(7)
    rows = (rng.integers(-50, 50, (40, 3)) * 2).tolist() + [[0, 0, 0], [2, 0, 0]]
    points = np.vstack([rng.integers(-60, 60, (500, 3)), [[1, 0, 0]]])
    for pts in (points, points.astype(object)):
        best, distance = orchard.Centroids(rows).search(pts)
        whole = ((points[:, None, :] - np.array(rows)[None]) ** 2).sum(axis=2)
        assert best.tolist() == whole.argmin(axis=1).tolist()
        assert distance.tolist() == whole.min(axis=1).tolist()


def _components(texts: dict, width: int = 5, percent: int = 80) -> dict:
    sets = {}
    for i, text in texts.items():
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return {i: (len(sets[i]), root[i]) for i in sets}


def test_join_equals_brute_force(spark):
    wanted = _components(_short_texts(spark))
    got = QUERIES["op13_ngram_jaccard_join"](spark, FOLDER)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == wanted
    assert any(i != root for i, (_, root) in wanted.items())


def _variants(rng: random.Random, words: int, groups: int, copies: int) -> dict[int, str]:
    """Texts round about the limit: a base with some words changed, dropped or added."""
    texts = {}
    for g in range(groups):
        base = [f"g{g}w{rng.randint(0, 400)}" for _ in range(words)]
        for _ in range(copies):
            out = list(base)
            for _ in range(rng.randint(0, max(1, words // 20))):
                out[rng.randrange(len(out))] = f"x{rng.randint(0, 9)}"
            out = out[: len(out) - rng.randint(0, words // 8)]
            texts[len(texts)] = " ".join(out)
    return texts


@pytest.mark.parametrize(("tile", "few"), [(1024, 2), (4, 0), (4, 100)])
def test_join_variants(spark, monkeypatch, tile, few):
    # Few or many tiles; members or pairs out of each meeting.
    monkeypatch.setattr(tile_join, "TILE", tile)
    monkeypatch.setattr(tile_join, "FEW", few)
    rng = random.Random(11)
    texts = _variants(rng, 60, 4, 30)
    # A passage in many documents that are otherwise different.
    passage = " ".join(f"p{i}" for i in range(60))
    for _ in range(40):
        texts[len(texts)] = passage + " " + " ".join(f"y{rng.randint(0, 10**6)}" for _ in range(rng.randint(3, 30)))
    got = tile_join.join_alike(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == _components(texts)


def test_join_cases(spark):
    base = [f"w{i}" for i in range(200)]
    chain = [(i, " ".join(base[i : i + 60])) for i in range(0, 140)]
    rows = chain + [(1000 + i, "the same words over and over") for i in range(500)]
    rows += [(2000, None), (2001, ""), (2002, " \t"), (2003, "one"), (2004, "ONE"), (None, "one"), (2003, "one")]
    rows += [(2005, "y " * 3000), (2006, "a b c d"), (2006, "one"), (2007, "A b c D"), (2007, ""), (2008, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumn("n", F.lit("clash")).withColumn("component_id", F.lit(1)).withColumn("body", F.lit(2))
    got = tile_join.join_alike(df).collect()
    assert len(got) == len(rows)
    by = Counter(tuple(r) for r in got)
    assert {r.component_id for r in got if r.doc_id is not None and r.doc_id < 1000} == {0}
    assert {r.component_id for r in got if r.doc_id is not None and 1000 <= r.doc_id < 2000} == {1000}
    assert by[(2000, 0, 2000)] == by[(2001, 0, 2001)] == by[(2002, 0, 2002)] == 1
    assert by[(None, 1, None)] == 1
    assert by[(2003, 1, 2003)] == 2 and by[(2004, 1, 2003)] == 1 and by[(2005, 1, 2005)] == 1
    # 2006 is one node of two texts, so what is linked with either is joined.
    assert by[(2006, 1, 2003)] == 2 and by[(2007, 1, 2003)] == 1 and by[(2007, 0, 2007)] == 1
    assert by[(2008, 1, 2008)] == 1
    assert tile_join.join_alike(df.where("false")).count() == 0


def test_bitmaps_bound_from_above():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 3000), dtype=np.uint64))
        y = np.union1d(x[: rng.integers(0, len(x) + 1)], rng.integers(0, 1 << 63, rng.integers(0, 300), dtype=np.uint64))
        bits = [tile_join.bitmap(s) for s in (x, y)]
        for width in {64, min(map(len, bits))}:
            differ = int(np.bitwise_count(np.bitwise_xor(*[tile_join._folded(b, width) for b in bits])).sum())
            assert len(np.intersect1d(x, y)) <= (len(x) + len(y) - differ) // 2
