"""Centroid clusters, periodic runs and prefix token counts against plain versions, and on odd tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from martloom.llm import centroid_clusters, periodic_runs, queries, token_counts
from tests.check_results import checker, differences
from tests.llm.test_text_operators import FOLDER, documents, labels, odd, texts  # noqa: F401

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("run", [
    lambda docs: periodic_runs.run_digests(docs), lambda docs: token_counts.document_counts(docs, WORD_BPE),
])
def test_one_row_for_each_row(odd, run):  # noqa: F811
    assert Counter(r["doc_id"] for r in run(odd).collect()) == Counter(r["doc_id"] for r in odd.collect())
    assert run(odd.where("false")).collect() == []


# ---- 11 -------------------------------------------------------------------------------------------------------------


def floor_64(x: float) -> int:
    a, b = x.as_integer_ratio()
    return 64 * a // b


def plain_clusters(rows: list[tuple[int, list]], many: int = 16, rounds: int = 3) -> list[tuple]:
    kept = [
        (k, [floor_64(x) for x in v]) for k, v in rows
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)
    ]
    code = {k: hashlib.sha256(f"1:{k if k is not None else ''}".encode()).hexdigest() for k, _ in kept}
    centroids = [v for _, v in sorted(kept, key=lambda r: (code[r[0]], r[1]))[:many]]

    def assign():
        found = []
        for _, v in kept:
            gaps = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            found.append((gaps.index(min(gaps)), min(gaps)))
        return found

    for _ in range(rounds):
        at = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (x, _) in zip(kept, at, strict=True) if x == c]
            if mine:
                centroids[c] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    at = assign()
    inertia = Counter()
    for c, d in at:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(k, c, d, inertia[c], sum(inertia.values()), digest[c]) for (k, _), (c, d) in zip(kept, at, strict=True)]


def found_clusters(df) -> Counter:
    names = "vec_id cluster distance cluster_inertia inertia centroid_sha256".split()
    return Counter(tuple(r) for r in df.select(*names).collect())


def test_clusters_against_a_plain_version_and_sql(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    df = queries.op11_centroid_clusters(spark, FOLDER)
    assert found_clusters(df) == Counter(plain_clusters(rows))
    assert differences(df, checker(FOLDER), queries.ORACLE_SQL["op11_centroid_clusters"]) == []


def test_clusters_of_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.integers(-3, 4, 64).astype(float).tolist()) for k in range(40)]
    rows += [(40, [1.0] * 63), (41, None), (42, []), (43, [1.0] * 63 + [None]), (44, [float("nan")] * 64), (45, [float("inf")] * 64)]
    rows += [rows[0], rows[0], (None, [0.5] * 64), (7, [0.25] * 64), (46, [-0.001] * 64), (47, [3e5 + k for k in range(64)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS cluster", "'x' AS vector", "2 AS distance")
    assert found_clusters(centroid_clusters.clustered(df)) == Counter(plain_clusters(rows))
    few = [(k, v) for k, v in rows if k in (1, 2, 40)]
    found = found_clusters(centroid_clusters.clustered(df.where("vec_id IN (1, 2, 40)")))
    assert found == Counter(plain_clusters(few)) and {x[2] for x in found} == {0}
    assert centroid_clusters.clustered(df.where("false")).collect() == []


@pytest.mark.parametrize("kind", [np.int64, object])
def test_progressive_search_is_exact_with_ties(kind):
    rng = np.random.default_rng(0)
    for k in range(60):
        v, c = rng.integers(-4, 5, (int(rng.integers(1, 200)), 64)), rng.integers(-4, 5, (int(rng.integers(1, 17)), 64))
        if k % 3 == 0:
            c[len(c) // 2 :] = c[0]
        gaps = ((v[:, None] - c[None]) ** 2).sum(axis=2)
        cluster, distance = centroid_clusters.nearest(v.astype(kind), c.astype(kind))
        assert (cluster == gaps.argmin(axis=1)).all() and (distance == gaps.min(axis=1)).all()


def test_large_components_are_exact():
    rng = np.random.default_rng(1)
    values = rng.normal(0, 1e18, (5, 64))
    v = centroid_clusters.integers(values)
    assert [[floor_64(x) for x in row] for row in values.tolist()] == v.tolist()
    cluster, distance = centroid_clusters.nearest(v, v[:3])
    gaps = [[sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) for y in v[:3].tolist()] for x in v.tolist()]
    assert cluster.tolist() == [g.index(min(g)) for g in gaps] and distance.tolist() == [min(g) for g in gaps]


# ---- 12 -------------------------------------------------------------------------------------------------------------


def plain_runs(words: list[str]) -> list[tuple[int, int, int]]:
    """Runs by comparing all words at all distances: (start, length, period)."""
    n, stretches = len(words), {}
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            stop = at
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            if stop - at + q >= max(6, 4 * q) and stop > at:
                stretches.setdefault((at, stop - at + q), q)
            at = max(stop, at) + 1
    return sorted(((s, length, q) for (s, length), q in stretches.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], runs) -> str:
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_runs_of_made_texts():
    draw = random.Random(3)
    for _ in range(120):
        docs = []
        for _ in range(draw.randint(1, 8)):
            kinds, size = draw.choice([1, 2, 3, 6, 200]), draw.choice([0, 1, 6, 30, 90, 400])
            words = [f"w{draw.randrange(kinds)}" for _ in range(size)]
            for _ in range(draw.randint(0, 4) if size > 8 else 0):
                a = draw.randrange(size)
                p, end = draw.randint(1, max(1, (size - a) // 3)), draw.randint(a, size)
                for i in range(a, end):
                    words[i] = words[a + (i - a) % p]
            docs.append(words)
        counts, runs, texts = periodic_runs.runs_of_texts(pa.array([draw.choice([" ", "\n", " \t"]).join(d) for d in docs]), 4, 6)  # noqa: F811
        for words, n, found, text in zip(docs, counts.to_pylist(), runs.to_pylist(), texts.to_pylist(), strict=True):
            want = plain_runs(words)
            assert n == len(words) and [(r["start"], r["length"], r["period"]) for r in found] == want
            assert text == collapsed(words, want)


@pytest.mark.parametrize("period", [1, 2, 4, 5, 8, 9, 16, 17, 64, 65, 1000])
def test_runs_at_the_borders_of_scales(period):
    block = [f"x{k}" for k in range(period)]
    least = max(6, 4 * period)
    for size in (least - 1, least, least + 1, 9 * period + 3):
        words = ["begin"] + (block * 10)[:size] + ["end"]
        _, runs, _ = periodic_runs.runs_of_texts(pa.array([" ".join(words)]), 4, 6)
        found = [(r["start"], r["length"], r["period"]) for r in runs.to_pylist()[0]]
        assert found == ([(1, min(size, 10 * period), period)] if min(size, 10 * period) >= least else [])


def test_run_digests(spark, odd, texts):  # noqa: F811
    def row(doc_id, text):
        words, h = words_of(text), zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        about = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        return (doc_id, len(runs), *about, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs))))

    got = Counter(tuple(r) for r in queries.op12_periodic_runs(spark, FOLDER).collect())
    want = Counter(row(k, t) for k, t in texts.items() if len(t) < 20_000)
    assert not want - got and sum(got.values()) == len(texts)
    assert sum(r[1] > 0 for r in want) > 5
    short = odd.where("text IS NULL OR length(text) < 1000")
    assert Counter(tuple(r) for r in periodic_runs.run_digests(short).collect()) == Counter(
        row(r["doc_id"], r["text"]) for r in short.collect()
    )


def test_runs_need_four_periods(odd):  # noqa: F811
    with pytest.raises(ValueError):
        periodic_runs.with_runs(odd, periods=3)


# ---- 13 -------------------------------------------------------------------------------------------------------------

TRICKY = [
    "", "it's 're 'REST don't!'s ''s '", "a" * 60, "abab" * 30, "1 22 333½²", "É é É ß İ ı ſ K Å ẞ ΑΣ ς", "漢字 한가 각 क्षि",
    "🙂🙃 x​y­z", "<|endoftext|>", "a<|endoftext|>b<|startoftext|><|endof", "e<|endoftext|>́x", "\x1c\x85   　x", "ǅ Ⱥ ﬁ",
    "the THE The tHe", "\x00\x01", "'ll'll''ll x'm'm", "ª²º¼",
]


def library_counts(texts: list[str]) -> list[int]:  # noqa: F811
    from tokenizers import Tokenizer

    return [len(e.ids) for e in Tokenizer.from_file(WORD_BPE).encode_batch(texts, add_special_tokens=False)]


def test_every_prefix_has_the_count_of_the_library(texts):  # noqa: F811
    draw = random.Random(5)
    counter = token_counts.PrefixCounter(WORD_BPE)
    mixed = ["".join(draw.choice(TRICKY)[: draw.randint(0, 9)] for _ in range(8)) for _ in range(300)]
    for text in [*TRICKY, *mixed, *[t[:700] for t in draw.sample(sorted(texts.values()), 25)]]:
        [found] = counter.counts([text])
        want = library_counts([text[:k] for k in range(1, len(text) + 1)])
        cut = [k for k in range(len(text)) if found[k] >= 0]
        assert [int(found[k]) for k in cut] == [want[k] for k in cut], ascii(text)
        assert not text or found[-1] >= 0
        if text.isascii():
            assert len(cut) == len(text)
        stored = token_counts.pack(found)
        assert (token_counts.unpack(stored) == found).all()
        assert token_counts.count_at(stored, len(text) + 5) == (want[-1] if want else 0)


def test_texts_together_count_like_texts_alone():
    counter = token_counts.PrefixCounter(WORD_BPE)
    together = counter.counts(TRICKY * 2)
    for text, found in zip(TRICKY * 2, together, strict=True):
        assert (token_counts.PrefixCounter(WORD_BPE).counts([text])[0] == found).all()


def test_counts_of_documents_and_a_long_piece(spark, texts, odd):  # noqa: F811
    want = {k: (len(t.encode()), n, n > 2048) for (k, t), n in zip(texts.items(), library_counts(list(texts.values())), strict=True)}
    rows = queries.op13_token_counts(spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows} == want and len(rows) == len(want)
    assert any(r["over_limit"] for r in rows)
    [found] = token_counts.PrefixCounter(WORD_BPE).counts(["xyzzy" * 40_000])
    assert [int(found[-1])] == library_counts(["xyzzy" * 40_000])
    odd_rows = token_counts.document_counts(odd, WORD_BPE).collect()
    source = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    counts = library_counts([t for _, t in source])
    assert Counter((r["doc_id"], r["n_tokens"]) for r in odd_rows) == Counter((k, n) for (k, _), n in zip(source, counts, strict=True))


def test_truncation_by_the_stored_counts(spark, odd):  # noqa: F811
    cut = token_counts.truncated(odd, WORD_BPE, 7)
    assert cut.columns == odd.columns
    before = {r["doc_id"]: r["text"] for r in odd.collect()}
    for r in cut.collect():
        whole = before[r["doc_id"]]
        if whole is None:
            assert r["text"] is None
            continue
        assert whole.startswith(r["text"]) and library_counts([r["text"]])[0] <= 7
        longer = [whole[:k] for k in range(len(r["text"]) + 1, min(len(whole), len(r["text"]) + 40) + 1)]
        assert all(n > 7 for n in library_counts(longer))


def test_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_REMEMBERED", 2_000)
    monkeypatch.setattr(token_counts, "MOST_PAIRS", 50)
    counter = token_counts.PrefixCounter(WORD_BPE)
    many = [" ".join(f"piece{a}{chr(97 + b)}" for b in range(26)) for a in range(20)]
    assert [int(c[-1]) for c in counter.counts(many)] == library_counts(many)
    assert counter.held < 3_000 and len(counter.merges.known) <= 52
