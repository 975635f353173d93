"""The text operators against plain versions of themselves, and on odd tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from martloom.llm import (
    bpe, exact_dedup, license_scan, lm_scoring, ngram_join, quality_compression, quality_rules, queries, source_mixing,
    token_ids, toxicity,
)
from tests.check_results import checker, differences

FOLDER = "/root/testdata/sf0.001"
KINDS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{k % 997}" for k in range(60_000))
WORDS = "the river ran past an old mill where nobody had lived since winter came down from those dark hills".split()
ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "Two words", "é 漢字 🙂", LONG, "same same same same same same", " ".join(WORDS),
    " ".join(WORDS), " ".join(WORDS) + " ", "  ".join(WORDS) + " again", "<|endoftext|> it's\x1c\t  x ",
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a repeated row, NULLs in every column, and columns named like those of the results."""
    rows = [(k, t, "en" if k % 3 else None, "s" if k % 2 else None, 1) for k, t in enumerate(ODD_TEXTS)]
    rows += [rows[9], (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, KINDS)
    return frame.selectExpr("*", "1 AS score", "'x' AS label", "2 AS kept", "3 AS node", "'k' AS key", "4 AS topic", "5 AS token_ids")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(k, k % 2, int(k % 3 == 0)) for k in range(12)] + [(3, None, None), (None, 1, 1), (999, 1, 0), (5, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def all_operators(docs, labels):
    path = public_tokenizers.path
    return {
        1: lambda: quality_compression.scores(docs, labels),
        2: lambda: token_ids.round_trip(docs, path("byte_bpe_50k.json"), 2),
        3: lambda: bpe.digests(docs, path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN),
        4: lambda: ngram_join.near_duplicates(docs),
        5: lambda: exact_dedup.exact_duplicates(docs),
        6: lambda: lm_scoring.cross_entropy_difference(docs, labels.where("quality = 1")),
        7: lambda: source_mixing.sampled(docs),
        8: lambda: license_scan.scan(docs),
        9: lambda: quality_rules.verdicts(docs),
        10: lambda: toxicity.scores(docs, labels),
    }


@pytest.mark.parametrize("n", range(1, 11))
def test_odd_and_empty_tables(odd, labels, n):
    """One row for each row, whatever is in it; none from an empty table, also without labels."""
    found = all_operators(odd, labels)[n]().collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in odd.collect())
    assert all(0 <= r["score"] <= 1 for r in found if n in (1, 8, 10))
    assert all_operators(odd.where("false"), labels.where("false"))[n]().collect() == []


def test_stages_on_odd_and_empty_tables(spark, odd, labels, tmp_path):
    import corpus_pipeline

    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd, odd.where("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, str(tmp_path))
            assert after.columns == docs.columns, name
            rows = after.collect()
            assert len(rows) <= docs.count() and {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.collect()}
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()


def test_pipeline_stages_decide(spark, documents):
    import corpus_pipeline

    copies = exact_dedup.exact_duplicates(documents)
    kept = {r["doc_id"] for r in copies.where("kept").collect()}
    assert {r["doc_id"] for r in corpus_pipeline.drop_copies(spark, documents, FOLDER).collect()} == kept
    near = {r["doc_id"] for r in ngram_join.near_duplicates(documents).where("doc_id = class_id").collect()}
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, documents, FOLDER).collect()} == near
    calm = {r["doc_id"] for r in queries.op10_toxicity(spark, FOLDER).where("predicted = 0").collect()}
    assert {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, documents, FOLDER).collect()} == calm
    drawn = {r["doc_id"] for r in source_mixing.sampled(documents).where("kept").collect()}
    assert {r["doc_id"] for r in corpus_pipeline.mix_sources(spark, documents, FOLDER).collect()} == drawn
    assert corpus_pipeline.run(spark, FOLDER).where("NOT decodes").count() == 0


# ---- 1, 10: held-out accuracy ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("query, label, parts, held, least", [
    (queries.op1_quality_classifier, "quality", 3, 1, 0.95), (queries.op10_toxicity, "toxic", 5, 0, 0.9),
])
def test_held_out_accuracy(spark, query, label, parts, held, least):
    folder = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = query(spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % parts == held) for r in found)
    scored = [(r["predicted"], truth[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in scored) / len(scored) >= least


def test_quality_curve_keeps_the_share_of_labels_beyond_the_bound(spark):
    """Where text says nothing of the label, the mean score is the label's share, also if the bound cuts the commoner one."""
    rng = np.random.default_rng(9)
    rows = [(k, " ".join(rng.choice(WORDS, 60)), int(k % 7 > 0)) for k in range(1400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")

    def mean_score(most_rows):
        good, bad, beta = quality_compression.fit(docs, docs, "doc_id", "text", "quality", most_rows)
        found = quality_compression.with_features(docs, "text", good, bad).select("difference", "ratio").toPandas()
        return (1 / (1 + np.exp(-(quality_compression.basis(found.to_numpy()) @ beta)))).mean()

    assert mean_score(1400) == pytest.approx(6 / 7, abs=0.05)
    assert mean_score(120) == pytest.approx(mean_score(1400), abs=0.08)


def test_calibration_weights_stand_for_repeated_rows():
    rng = np.random.default_rng(5)
    features = np.stack([rng.normal(0, 0.05, 400), rng.uniform(0.3, 0.6, 400)], axis=1)
    kinds = (rng.random(400) < 1 / (1 + np.exp(-30 * features[:, 0]))).astype(float)
    times = np.where(kinds == 1, 6, 1)
    again = quality_compression.calibrate(features.repeat(times, axis=0), kinds.repeat(times), ridge=1e-9)
    assert quality_compression.calibrate(features, kinds, times.astype(float), ridge=1e-9) == pytest.approx(again, rel=1e-4)


def test_training_does_not_see_held_out_labels(spark, documents):
    table = spark.read.parquet(f"{FOLDER}/labels.parquet")
    changed = table.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.scores(documents, t).collect()} for t in (table, changed))
    assert a == b


# ---- 2, 3: encoding -------------------------------------------------------------------------------------------------


def test_token_files_match_the_library(spark, odd, texts, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = documents.select("doc_id", "text").union(odd.where("doc_id IS NOT NULL").distinct().selectExpr("doc_id + 100000", "text"))
    found = {r["doc_id"]: r for r in token_ids.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), 2).collect()}
    start = 0
    for row in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        ids = [*library.encode(row["text"] or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(found[row["doc_id"]]) == (row["doc_id"], start, len(ids), crc)
        start += len(ids)


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 1, 2, 3]])
def test_variable_length_values(values):
    control, data = token_ids.encode_values(np.array(values, dtype=np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert token_ids.decode_values(control, data, len(values)).tolist() == values


def test_blocks_round_trip():
    ids = np.array([7, 7, 7, 50_000, 3, 7], dtype="<u4")
    names, counts, again = token_ids.unpack(token_ids.pack([5, None, -1], [4, 0, 2], ids))
    assert (names, counts.tolist(), again.tolist()) == ([5, None, -1], [4, 0, 2], ids.tolist())
    with pytest.raises(ValueError):
        token_ids.unpack(b"\0" * 64)


def plain_bpe(ranks, piece):
    """Merge the leftmost pair of least rank until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [bytes([b]) for b in piece]
    while True:
        found = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        k = min(found)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_bpe_matches_the_library_and_a_plain_loop(texts):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    vocab = bpe.vocabulary(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})
    asked = [*texts.values(), *[t or "" for t in ODD_TEXTS], "a" * 3000, "x  ", "x \n \n y", "a   b\n\n  c"]
    for text, coded in zip(asked, bpe.encoder(path, public_tokenizers.PATTERN).encode(asked), strict=True):
        assert np.frombuffer(coded, "<u4").tolist() == library.encode_ordinary(text)
    pieces = ["aaaaaaaaaaaa", "abababababa", "ññññ", "zqxjkv", "é", "incomprehensibilities"]
    for piece, coded in zip(pieces, bpe.encode_pieces(vocab, pieces), strict=True):
        assert np.frombuffer(coded, "<u4").tolist() == plain_bpe(vocab.ranks, piece.encode())


def test_decoded_digest_is_that_of_the_text(spark, texts):
    for row in queries.op3_byte_bpe(spark, FOLDER).collect():
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


# ---- 4, 5: duplicates -----------------------------------------------------------------------------------------------


def plain_links(texts, similarity=0.8):
    """Links and classes by comparing every pair that shares an n-gram."""
    sets = {}
    for doc, text in texts.items():
        words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[doc] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    holders, label, links = defaultdict(list), {d: d for d in sets}, Counter()
    for doc, grams in sets.items():
        for gram in grams:
            holders[gram].append(doc)

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for doc, grams in sets.items():
        for other, common in Counter(d for g in grams for d in holders[g]).items():
            if other != doc and common >= similarity * (len(grams) + len(sets[other]) - common) - 1e-9:
                links[doc] += 1
                a, b = root(doc), root(other)
                label[max(a, b)] = min(a, b)
    return {d: (root(d), links[d]) for d in sets}


def test_near_duplicates_match_all_pairs(spark, texts):
    found = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in queries.op4_ngram_jaccard_join(spark, FOLDER).collect()}
    assert found == plain_links(texts)


def test_large_group_of_near_copies_in_several_cells(spark, monkeypatch):
    """A group beyond one cell gives the same links and class as in one."""
    monkeypatch.setattr(ngram_join, "CELL_MEMBERS", 16)
    base = [f"w{k}" for k in range(200)]
    texts = {k: " ".join([*base[:k], f"new{k}", *base[k + 1 :]]) for k in range(60)} | {100: "alone among all of these words"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.near_duplicates(docs).collect()}
    assert found == plain_links(texts)
    assert found[3] == (0, 59)


def test_an_id_on_several_texts_is_a_document_each(spark):
    """Classes go by text: a repeated id links no unrelated texts, loses no links and takes no clean text along."""
    def near(name, k):
        return " ".join([*(f"{name}{j}" for j in range(k)), f"new{k}", *(f"{name}{j}" for j in range(k + 1, 200))])

    rows = [(3, near("a", 5)), (7, near("a", 60)), (7, "alone among all of these words"), (7, near("b", 9))]
    rows += [(8, near("b", 120)), (9, near("c", 4)), (9, near("c", 90)), (9, near("d", 3)), (9, near("c", 150))]
    rows += [(3, ""), (10, near("d", 80)), (10, near("d", 130))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = plain_links(dict(enumerate(t for _, t in rows)))
    wanted = Counter((rows[k][0], min(rows[j][0] for j in plain if plain[j][0] == c), n) for k, (c, n) in plain.items())
    assert Counter(tuple(r) for r in ngram_join.near_duplicates(docs).collect()) == wanted
    kept = Counter(tuple(r) for r in ngram_join.one_of_each(docs).collect())
    assert not kept - Counter(rows) and len({c for c, _ in plain.values()}) == kept.total() == 6
    assert kept.keys() >= {rows[0], rows[2], rows[3], rows[7], rows[9]} and sum(r in kept for r in (rows[5], rows[6], rows[8])) == 1


def test_band_plan_reaches_the_recall():
    for similarity, recall in ((0.8, 0.99), (0.5, 0.9), (0.9, 0.999)):
        bands, rows = ngram_join.band_plan(similarity, recall)
        assert bands * rows <= ngram_join.MOST_HASHES and 1 - (1 - similarity**rows) ** bands >= recall


def test_exact_dedup_matches_sql(spark):
    df = queries.op5_exact_dedup(spark, FOLDER)
    assert differences(df, checker(FOLDER), queries.ORACLE_SQL["op5_exact_dedup"]) == []


def test_copies_by_length_then_id(spark):
    rows = [(4, "a b"), (2, "ab"), (3, "a  b"), (1, "a\tb "), (9, None), (8, " "), (7, "x")]
    found = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: r["keep_id"] for k, r in found.items()} == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8, 7: 7}
    assert found[2]["group_size"] == 4 and found[1]["kept"] and not found[4]["kept"]
    assert found[9]["text_sha256"] == hashlib.sha256(b"").hexdigest()


def test_directory_splits_only_overfull_buckets(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) AS key").union(spark.range(500).selectExpr("id AS key"))
    rows = exact_dedup.directory(keys, 64).collect()
    assert sum(r["entries"] for r in rows) == 3500
    # Ranges neither overlap nor leave a used gap: every key is in exactly one bucket.
    placed = exact_dedup.placed(keys, spark.createDataFrame(rows)).groupBy("key").count()
    assert placed.count() == 3500 and placed.where("count <> 1").count() == 0
    depths = {r["depth"] for r in rows}
    assert len(depths) > 1 and max(r["entries"] for r in rows if r["depth"] < max(depths)) <= 64


def plain_mix(rows, draws):
    """Ids that stay: raking of cells in numpy, one factor for the wanted size, the operator's own draw."""
    ids = sorted(rows)
    counts, topics = (c.to_numpy() for c in source_mixing.token_topics(pa.array([rows[k]["text"] for k in ids], pa.string())))
    cells = Counter()
    for k, n, topic in zip(ids, counts, topics, strict=True):
        if n:
            cells[rows[k]["source"], rows[k]["lang"], int(topic)] += int(n)
    held, weight = np.array(list(cells.values()), float), np.ones(len(cells))
    for _ in range(300):
        for axis, name in enumerate(source_mixing.MARGINS):
            values = {v: j for j, v in enumerate(dict.fromkeys(c[axis] for c in cells))}
            at = np.array([values[c[axis]] for c in cells])
            wanted = np.bincount(at, held) ** source_mixing.TEMPERATURES[name]
            weight *= (wanted / wanted.sum() * held.sum() / np.bincount(at, held * weight))[at]
    low, high = 0.0, 1 / weight.min()
    for _ in range(200):
        f = (low + high) / 2
        low, high = (f, high) if (held * np.minimum(1, f * weight)).sum() < source_mixing.KEEP_TOKENS * held.sum() else (low, f)
    chance = dict(zip(cells, np.minimum(1, high * weight), strict=True))
    return {
        k for k, n, topic in zip(ids, counts, topics, strict=True)
        if not n or draws[k] < chance[rows[k]["source"], rows[k]["lang"], int(topic)]
    }


def test_pipeline_matches_a_plain_run(spark, documents):
    """Stage after stage in plain Python, with the fitted weights of the first; ids and token ids agree exactly."""
    import tiktoken

    import corpus_pipeline
    from martloom.llm.common import unit_hash

    rows = {r["doc_id"]: r for r in documents.collect()}
    weights, intercept = toxicity.fit(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id", "text", "toxic")

    def logit(text):
        return intercept + sum(weights.get(b, 0.0) for b in set(toxicity.features(pa.array([text], pa.string()))[1].tolist()))

    calm = {k: r for k, r in rows.items() if logit(r["text"]) < 0}
    best = {}
    for k in sorted(calm):
        text = calm[k]["text"] or ""
        norm = re.sub(r"[\x20\x09-\x0D]+", "", text)
        if norm not in best or len(text) > len(rows[best[norm]]["text"] or ""):
            best[norm] = k
    single = {k: calm[k] for k in best.values()}
    least = {k: single[k] for k, (c, _) in plain_links({k: r["text"] or "" for k, r in single.items()}).items() if k == c}
    draws = dict(tuple(r) for r in documents.select("doc_id", unit_hash(documents["doc_id"], seed=source_mixing.SEED)).collect())
    stay = plain_mix(least, draws)
    assert len(rows) > len(calm) > len(single) > len(least) > len(stay) > 0

    vocab = bpe.vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(stay) and all(r["decodes"] for r in found)
    for r in found:
        ids = library.encode_ordinary(rows[r["doc_id"]]["text"] or "")
        assert (np.frombuffer(r["token_ids"], "<u4").tolist(), r["n_tokens"]) == (ids, len(ids))


# ---- 6 to 9 ---------------------------------------------------------------------------------------------------------


def test_cross_entropy_difference_matches_a_plain_model(spark):
    texts = {1: "a b a b c", 2: "a b b", 3: "C c D", 4: "", 5: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r for r in lm_scoring.cross_entropy_difference(docs, docs.where("doc_id IN (1, 2)")).collect()}
    lists = {k: (t or "").lower().split() for k, t in texts.items()}

    def model(ids, scale):
        pairs = Counter(p for k in ids for p in zip(["^", *lists[k]], lists[k], strict=False))
        single, before = Counter(), Counter()
        for (a, b), n in pairs.items():
            single[b] += n * scale
            before[a] += n * scale
        total = sum(single.values()) + len({w for words in lists.values() for w in words})
        return lambda a, b: -math.log(
            (pairs[a, b] * scale + lm_scoring.PRIOR * (single[b] + 1) / total) / (before[a] + lm_scoring.PRIOR)
        )

    target, everything = model((1, 2), 1.0), model((1, 2, 3), 8 / 11)
    for k in (1, 2, 3):
        pairs = list(zip(["^", *lists[k]], lists[k], strict=False))
        means = [sum(m(a, b) for a, b in pairs) / len(pairs) for m in (target, everything)]
        assert found[k]["score"] == pytest.approx(means[0] - means[1], abs=1e-5)
    assert found[1]["score"] < 0 < found[3]["score"] and found[4]["score"] == found[5]["score"] == 0


def test_cross_entropy_difference_does_not_depend_on_chunks(spark, documents, monkeypatch):
    """One chunk and one bucket, or many of both that share keys."""
    target = documents.where("doc_id % 3 = 0")

    def found():
        return {r["doc_id"]: tuple(r)[1:] for r in lm_scoring.cross_entropy_difference(documents, target).collect()}

    one = found()
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 5_000)
    monkeypatch.setattr(lm_scoring, "BUCKET_BYTES", 20_000)
    many = found()
    assert many.keys() == one.keys() and len({values[3] for values in one.values()}) > len(one) // 2
    assert all(many[k] == pytest.approx(one[k], abs=1e-9) for k in one)


def test_raked_weights_meet_all_margins(spark):
    rows = [(s, l, t, 10 * s + 7 * l + 3 * t + 1) for s in range(3) for l in range(2) for t in range(3)]
    cells = spark.createDataFrame([(str(a), str(b), c, n) for a, b, c, n in rows], "source string, lang string, topic long, tokens long")
    found = source_mixing.rake(cells, {"source": 0.5, "lang": 0.0, "topic": 0.7}).toPandas()
    table = np.zeros((3, 2, 3))
    for a, b, c, n in rows:
        table[a, b, c] = n
    plain, total = table.copy(), table.sum()
    for _ in range(200):
        for axis, power in ((0, 0.5), (1, 0.0), (2, 0.7)):
            others = tuple(k for k in range(3) if k != axis)
            wanted = table.sum(axis=others) ** power
            shape = [1, 1, 1]
            shape[axis] = -1
            plain *= (wanted / wanted.sum() * total / plain.sum(axis=others)).reshape(shape)
    for row in found.itertuples():
        assert row.tokens * row.weight == pytest.approx(plain[int(row.source), int(row.lang), row.topic], rel=1e-4)


def test_sample_has_the_wanted_size(spark):
    rows = source_mixing.sampled(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    total = sum(r["n_tokens"] for r in rows)
    expected = sum(r["n_tokens"] * r["probability"] for r in rows if r["n_tokens"])
    assert expected == pytest.approx(source_mixing.KEEP_TOKENS * total, rel=1e-3)
    assert sum(r["n_tokens"] for r in rows if r["kept"]) == pytest.approx(0.8 * total, rel=0.05)


def test_margins_after_the_cut_are_as_near_as_documented(spark):
    rows = source_mixing.sampled(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("n_tokens > 0").toPandas()
    rows["expected"] = rows["n_tokens"] * rows["probability"]
    for name, most in (("source", 0.0034), ("lang", 0.0368), ("topic", 0.0132)):
        sums = rows.groupby(name, dropna=False)[["n_tokens", "expected"]].sum()
        wanted = sums["n_tokens"] ** source_mixing.TEMPERATURES[name]
        off = (sums["expected"] / sums["expected"].sum() - wanted / wanted.sum()).abs().max()
        assert off <= most and (name != "lang" or off > 0.03), name


def test_license_phrases_match_a_plain_search(spark, texts):
    for row in queries.op8_license_scan(spark, FOLDER).collect():
        text = re.sub("[A-Z]", lambda m: m[0].lower(), texts[row["doc_id"]])
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        at = [
            (k, label) for phrase, label in license_scan.PHRASES.items()
            for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()
        ]
        places = [k for k, _ in at]
        assert (row["n_words"], row["n_base"]) == (len(words), len(at))
        assert (row["first_word"], row["last_word"]) == (min(places, default=None), max(places, default=None))
        assert row["base_labels"] == ",".join(sorted({label for _, label in at}))
        assert set(row["base_labels"].split(",")) <= set(row["labels"].split(","))


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the Apache License, Version 2.0 (the \"License\")", "Apache-2.0,apache"),
    ("the Apache License, Version 1.1", "apache"),
    ("This library is licensed under the MIT License", "MIT,mit"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0,cc-by"),
    ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted,"
     " provided that the above copyright notice and this permission notice appear in all copies", ""),
    ("Permission to use, copy, modify, and distribute this program for any purpose", ""),
    (license_scan.BSD_HEAD.replace("[[", "").replace("]]", "") + " THIS SOFTWARE IS PROVIDED BY THE AUTHORS \"AS IS\" AND ANY"
     " EXPRESS OR IMPLIED WARRANTIES", ""),
    (license_scan.BSD_HEAD.replace("[[1.]]", "") + " THIS SOFTWARE IS PROVIDED \"AS IS\" AND ANY EXPRESS", ""),
])
def test_templates(text, labels):
    assert license_scan.scan_texts(pa.array(["before. " + text + " after", None, ""]))[5].to_pylist() == [labels, "", ""]


def test_text_counts_match_a_plain_count(texts):
    asked = [*texts.values(), *[t or "" for t in ODD_TEXTS], "a\n a\na\n\n\na", "x y z x y z x y z x y z"]
    found = zip(*(c.to_pylist() for c in quality_rules.text_counts(pa.array(asked))), strict=True)
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for text, counts in zip(asked, found, strict=True):
        words = word.findall(text)
        times = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        repeated = {k + j for k in range(len(words) - 4) if times[tuple(words[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if word.search(x)]
        wanted = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        assert counts == wanted


def test_outliers_are_rejected_and_plain_documents_kept(spark):
    rng = np.random.default_rng(3)

    def prose(n):
        return " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(n))

    rows = [(k, prose(int(rng.integers(30, 400))), "en", f"s{k % 2}") for k in range(400)]
    rows += [(1000 + k, prose(100).replace(" ", "### "), "en", "s0") for k in range(5)]
    found = {r["doc_id"]: r["kept"] for r in quality_rules.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(found[1000 + k] for k in range(5))
    assert sum(found[k] for k in range(400)) >= 398
