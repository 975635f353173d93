"""No row is lost or changed by near duplicates, mixing and the pipeline: odd ids, no ids, and odd column names."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest

from martloom.llm import bpe, exact_dedup, ngram_join, pieces, source_mixing, token_ids
from tests.llm.test_text_operators import labels, plain_links  # noqa: F401

NAMES = ("_key", "_hash", "_kept_id", "_row", "_rank", "_exact_id", "_rep", "key", "rep", "node", "label", "at")


def near(name: str, k: int, size: int = 200) -> str:
    return " ".join([*(f"{name}{j}" for j in range(k)), f"new{k}", *(f"{name}{j}" for j in range(k + 1, size))])


def wide(spark, rows):
    """Documents with columns of all names that the operators might use themselves, of several types."""
    extra = [f"'{n}-x' AS `{n}`" if k % 2 else f"doc_id * 10 + {k} AS `{n}`" for k, n in enumerate(NAMES)]
    full = [(i, t, "en" if n % 2 else "de", f"s{n % 3}", len(t or "")) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *extra)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, near("a", 5)), (1, near("b", 3)), (2, near("a", 60)), (None, near("a", 90)), (None, near("c", 4)), (None, near("c", 80))]
    rows += [(None, near("d", 1)), (3, near("e", 7)), (3, near("e", 7)), (4, near("e", 50)), (None, ""), (5, None), (6, "..."), (None, near("a", 90))]
    return wide(spark, rows)


def test_links_of_rows_without_an_id(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    plain = plain_links({k: t or "" for k, (_, t) in enumerate(rows)})
    members = {}
    for k, (c, _) in plain.items():
        members.setdefault(c, []).append(k)
    least = {c: min((rows[k][0] for k in ks if rows[k][0] is not None), default=None) for c, ks in members.items()}
    wanted = Counter((rows[k][0], least[c], n) for k, (c, n) in plain.items())
    assert Counter(tuple(r) for r in ngram_join.near_duplicates(docs).collect()) == wanted


def test_one_of_each_keeps_one_and_changes_nothing(docs):
    kept = ngram_join.one_of_each(docs)
    assert kept.dtypes == docs.dtypes
    rows, before = Counter(tuple(r) for r in kept.collect()), Counter(tuple(r) for r in docs.collect())
    assert not rows - before
    texts = Counter((r[0], r[1]) for r in rows.elements())
    assert texts.keys() - {(None, near("c", 4)), (None, near("c", 80))} == {
        (1, near("a", 5)), (1, near("b", 3)), (None, near("d", 1)), (3, near("e", 7)), (None, ""), (5, None), (6, "..."),
    }
    assert texts[3, near("e", 7)] == 2 and sum(t.startswith("c0 ") for _, t in texts.elements() if t) == 1


def test_mixing_draws_every_row_by_itself(spark, docs):
    kept = source_mixing.kept_documents(docs)
    assert kept.dtypes == docs.dtypes
    assert not Counter(tuple(r) for r in kept.collect()) - Counter(tuple(r) for r in docs.collect())
    rows = [(k // 2, near(f"w{k}", 3, 30)) for k in range(200)] + [(None, near(f"v{k}", 3, 30)) for k in range(200)]
    many = wide(spark, rows)
    verdicts = source_mixing.sampled(many)
    drawn = Counter((r["doc_id"], r["source"], r["lang"]) for r in verdicts.where("kept").collect())
    found = Counter((r["doc_id"], r["source"], r["lang"]) for r in source_mixing.kept_documents(many).collect())
    assert found == drawn and 250 < drawn.total() < 390
    # Rows without an id are not one row: some stay and some go.
    nameless = sum(n for (k, _, _), n in drawn.items() if k is None)
    assert 100 < nameless < 200


def test_texts_without_words_stay_and_have_no_weight(docs):
    rows = [r for r in source_mixing.sampled(docs).collect() if not r["n_tokens"]]
    assert len(rows) == 2 and all(r["kept"] and r["weight"] is None and r["probability"] is None for r in rows)


def test_stages_return_rows_as_they_were(spark, docs, labels, tmp_path):  # noqa: F811
    import corpus_pipeline

    labels.write.parquet(str(tmp_path / "labels.parquet"))
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, str(tmp_path))
        assert after.dtypes == docs.dtypes, name
        before = Counter(tuple(r) for r in now.collect())
        rows = Counter(tuple(r) for r in after.collect())
        assert rows and not rows - before, name
        now = spark.createDataFrame([r for r in after.collect()], after.schema)


def test_exact_copies_with_odd_columns(docs):
    kept = exact_dedup.without_copies(docs)
    assert kept.dtypes == docs.dtypes
    assert {r["text"] or "" for r in kept.collect()} == {r["text"] or "" for r in docs.collect()}


def test_band_plan_says_if_it_cannot_reach_the_recall():
    with pytest.raises(ValueError):
        ngram_join.band_plan(0.01, 0.99)


def test_remembered_pieces_are_bounded(monkeypatch):
    """What an encoder keeps does not grow with the texts, and ids do not depend on what it keeps."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    texts = [" ".join(f"word{a}x{b}" for b in range(40)) + ("  \n\n  end" if a % 5 == 0 else "") for a in range(60)]
    free = bpe.encoder(path, public_tokenizers.PATTERN)
    wanted = [x.tolist() for x in free.encode(texts)]
    monkeypatch.setattr(pieces, "MOST_REMEMBERED", 5_000)
    tight = bpe.encoder(path, public_tokenizers.PATTERN)
    ids = [[x.tolist() for x in tight.encode([t])] for t in texts]
    assert [k for x, _ in ids for k in x] == wanted[0] and [n for _, [n] in ids] == wanted[1]
    held = tight.known
    assert sum(len(s) + len(i) + pieces.ENTRY_BYTES for table in (held.new, held.old) for s, i in table.items()) < 40_000


def test_encoders_of_no_texts_and_empty_texts():
    encoder = bpe.encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    library = token_ids.LibraryEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    for known in (encoder, library):
        assert [x.tolist() for x in known.encode([])] == [[], []]
        assert [x.tolist() for x in known.encode(["", ""])] == [[], [0, 0]]
        ids, counts = known.encode(["", "a  \n\n b", "<|endoftext|>", "a"])
        assert counts.tolist()[0] == 0 and len(ids) == counts.sum() and counts.tolist()[3] == 1
    assert bpe.binaries(*encoder.encode(["a", "", "b c"])).to_pylist()[1] == b"" and pa.types.is_binary(bpe.binaries(*encoder.encode([])).type)
