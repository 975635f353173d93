"""Near duplicates: a Jaccard self-join on word n-grams by MinHash banding, checked on the full n-gram sets.

1. Every text becomes its set of hashed n-grams. Texts with the same set are one class from here on, whatever their number.
2. A class has a MinHash signature, cut into bands. Band and row counts follow from the threshold and the wanted recall.
   Classes with an equal band meet through a shuffle on the band's hash; each is linked to the least class in its bucket
   only, so a bucket of any size gives as many rows as it has members.
3. Connected groups of these links hold every pair that shares a band. The texts of a group are brought together, and
   there each pair is compared on the full n-gram sets. A group beyond the size of one cell is dealt into blocks, and each
   pair of blocks is a cell of its own, in its own task: no group is cut short, and none has to fit one task.
4. A cell gives one row per member (links found, and the least member it is linked with), never its pairs. Connected
   components of these rows are the classes of near duplicates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import tokens
from martloom.llm.common import arrow_map, fresh, slices, stored
from martloom.llm.components import components

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.99
MOST_HASHES = 256
# Size of a block in a large group: members, and n-grams altogether.
CELL_MEMBERS, CELL_GRAMS = 1024, 1 << 19


def band_plan(similarity: float, recall: float, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows in a band (fewest chance meetings) that find a pair just at the threshold with the
    wanted probability, 1 - (1 - s^rows)^bands, within so many hashes. A recall that these cannot reach is an error."""
    best = None
    for rows in range(1, most_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(similarity**rows))) if similarity < 1 else 1
        if bands * rows > most_hashes:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError(f"{most_hashes} hashes cannot find pairs of similarity {similarity} with a chance of {recall}")
    return best


def gram_sets(strings: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams: the text of each, ascending, and its hash. Texts of fewer words have one gram of all of them.

    Words are runs of digits, letters and characters beyond ASCII, in lower case (ASCII).
    """
    words = tokens.find_words(strings, tokens.IS_NAME, tokens.LOWER_ASCII)
    hashes, counts = words.hashes(), words.counts()
    first, grams = tokens.windows(hashes, words.doc, size)
    docs = words.doc[first]
    short = np.flatnonzero((counts > 0) & (counts < size))
    whole = np.zeros(len(short), dtype=np.uint64)
    at, left = words.firsts()[short], counts[short]
    for k in range(size - 1):
        have = left > k
        whole[have] = tokens.mixed(whole[have] + hashes[at[have] + k] + tokens.nth(k + 1))
    docs, grams = np.concatenate([docs, short]), np.concatenate([grams, whole])
    order = np.lexsort((grams, docs))
    docs, grams = docs[order], grams[order]
    new = np.ones(len(docs), dtype=bool)
    new[1:] = (docs[1:] != docs[:-1]) | (grams[1:] != grams[:-1])
    return docs[new], grams[new]


def set_keys(docs: np.ndarray, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """128 bits that stand for each set, as two columns of signed numbers."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    parts = [np.add.reduceat(tokens.mixed(grams ^ salt), starts) for salt in (tokens.MIX_1, tokens.MIX_2)]
    return np.stack(parts, axis=1).view(np.int64)


def identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text and text_hash: an id may stand on several texts, so a row is known by its id and its text's hash."""
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash")
    )


def signatures(docs: DataFrame, doc_id: str, text: str, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, a hash of the text, the key of the n-gram set, its size, and a hash for each band; texts without a word are
    left out."""
    salts = np.random.default_rng(7).integers(1, 1 << 63, (2, bands * rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                at, grams = gram_sets(part.column("text"), words)
                present, starts = np.unique(at, return_index=True)
                if not len(present):
                    continue
                sizes = np.diff(np.append(starts, len(at)))
                folded = np.empty((bands, len(present)), dtype=np.uint64)
                for b in range(bands):
                    band = np.full(len(present), b, dtype=np.uint64)
                    for r in range(b * rows, (b + 1) * rows):
                        band = tokens.mixed(band + np.minimum.reduceat(grams * salts[0, r] + salts[1, r], starts))
                    folded[b] = band
                keys = set_keys(at, grams, starts)
                flat = pa.array(np.ascontiguousarray(folded.T).reshape(-1).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(present) + 1, dtype=np.int32) * bands), flat)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c).take(pa.array(present)) for c in ("doc_id", "text_hash")],
                     pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), pa.array(sizes.astype(np.int64)), lists],
                    names=["doc_id", "text_hash", "key_1", "key_2", "n_grams", "bands"],
                )

    return arrow_map(
        identified(docs, doc_id, text),
        run,
        "doc_id long, text_hash long, key_1 long, key_2 long, n_grams long, bands array<long>",
    )


def candidate_groups(classes: DataFrame) -> DataFrame:
    """(node, label): the classes that share a band with another one, in connected groups."""
    banded = classes.select("node", F.posexplode("bands").alias("band", "hash"))
    least = banded.groupBy("band", "hash").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    shared = least.where("first < last").select("band", "hash", "first")
    edges = banded.join(shared, ["band", "hash"]).where("node > first")
    return components(stored(edges.select(F.col("node").alias("a"), F.col("first").alias("b")).distinct(), "band-links"))


def dealt(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """The cells in which each candidate takes part: (label, i, j) with i <= j, and its own block."""
    sized = groups.join(classes.select("node", "rep", "text_hash", "key_1", "key_2", "n_grams", "copies"), "node")
    blocks = sized.groupBy("label").agg(
        F.greatest(
            F.ceil(F.count("*") / CELL_MEMBERS), F.ceil(F.sum("n_grams") / F.lit(CELL_GRAMS))
        ).cast("int").alias("blocks")
    )
    members = sized.join(blocks, "label").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return members.select("*", other).select(
        "node", "rep", "text_hash", "label", "key_1", "key_2", "copies", "block",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )


def overlaps(docs: np.ndarray, grams: np.ndarray, members: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each member, how many grams it shares with every member; work follows the grams that are shared at all."""
    _, ids, counts = np.unique(grams, return_inverse=True, return_counts=True)
    shared = counts[ids] > 1
    docs, ids = docs[shared], ids[shared]
    order = np.argsort(ids, kind="stable")
    holders = docs[order]
    begin = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(np.where(counts > 1, counts, 0), out=begin[1:])
    edges = np.searchsorted(docs, np.arange(members + 1))
    for m in range(members):
        own = ids[edges[m] : edges[m + 1]]
        lengths = counts[own]
        at = np.repeat(begin[own] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        yield m, np.bincount(holders[at], minlength=members)


def linked(node: np.ndarray, copies: np.ndarray, block: np.ndarray, same: bool, docs, grams, similarity: float):
    """Links of each member of a cell, weighted by copies, and the least member that it hangs together with.

    In a cell of two blocks only pairs across them count: pairs inside a block belong to the block's own cell.
    """
    members = len(node)
    sizes = np.bincount(docs, minlength=members)
    links, label = np.zeros(members, dtype=np.int64), np.arange(members)

    def root(x: int) -> int:
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for m, common in overlaps(docs, grams, members):
        near = common >= similarity * (sizes[m] + sizes - common) - 1e-9
        near &= (common > 0) & (same | (block != block[m]))
        near[m] = False
        found = np.flatnonzero(near)
        links[m] = copies[found].sum()
        for x in found[found > m]:
            a, b = root(m), root(int(x))
            label[max(a, b)] = min(a, b)
    return links, np.array([node[root(x)] for x in range(members)], dtype=np.int64)


def verified(cells: DataFrame, docs: DataFrame, doc_id: str, text: str, words: int, similarity: float) -> DataFrame:
    """(node, links, least) for every member of every cell."""
    texts = identified(docs, doc_id, text).withColumnRenamed("doc_id", "_rep").withColumnRenamed("text_hash", "_hash")
    # Any number of rows may have no id; of those, each text is there once.
    named, nameless = texts.where("_rep IS NOT NULL"), texts.where("_rep IS NULL").dropDuplicates(["_hash"])
    texts = named.unionByName(nameless)
    same = (F.col("text_hash") == F.col("_hash")) & F.col("rep").eqNullSafe(F.col("_rep"))
    rows = cells.join(texts, same).repartition("label", "i", "j").sortWithinPartitions("label", "i", "j", "node")
    numbers = ("node", "key_1", "key_2", "copies", "block")

    def parsed(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Numbers of the rows, and the n-grams of their texts; the texts themselves are not kept."""
        docs_of, grams_of, before = [], [], 0
        for part in slices(batch, "text"):
            at, grams = gram_sets(part.column("text"), words)
            docs_of.append(at + before)
            grams_of.append(grams)
            before += part.num_rows
        return [np.array(batch.column(c)) for c in numbers], np.concatenate(docs_of), np.concatenate(grams_of)

    def work(held: list[tuple], same: bool) -> pa.RecordBatch:
        node, key_1, key_2, copies, block = (np.concatenate([h[0][k] for h in held]) for k in range(len(numbers)))
        shifts = np.cumsum([0] + [len(h[0][0]) for h in held])
        at = np.concatenate([h[1] + shift for h, shift in zip(held, shifts[:-1], strict=True)])
        grams = np.concatenate([h[2] for h in held])
        keys = np.stack([key_1, key_2], axis=1)
        present, starts = np.unique(at, return_index=True)
        mine = np.zeros(len(node), dtype=bool)
        mine[present] = (set_keys(at, grams, starts) == keys[present]).all(axis=1)
        # A node whose id and text are there twice is taken once, from a row with the set that was announced.
        pick = np.flatnonzero(mine)
        pick = pick[np.unique(node[pick], return_index=True)[1]]
        mine[:] = False
        mine[pick] = True
        place = np.full(len(node), -1)
        place[pick] = np.arange(len(pick))
        keep = mine[at]
        links, least = linked(node[pick], copies[pick], block[pick], same, place[at[keep]], grams[keep], similarity)
        return pa.RecordBatch.from_arrays([pa.array(node[pick]), pa.array(links), pa.array(least)], names=["node", "links", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            cell = np.stack([np.asarray(batch.column(c)) for c in ("label", "i", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1).tolist(), len(cell)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    if now is not None and (cell[a] != now).any():
                        yield work(held, now[1] == now[2])
                        held = []
                    now = cell[a]
                    held.append(parsed(batch.slice(a, b - a)))
        if held:
            yield work(held, now[1] == now[2])

    columns = ["label", "i", "j", "node", "key_1", "key_2", "copies", "block", "text"]
    return arrow_map(rows.select(*columns), run, "node long, links long, least long")


def classified(docs: DataFrame, doc_id: str, text: str, words: int, similarity: float, recall: float) -> DataFrame:
    """doc_id, text_hash, class_id, n_links and stays for every row.

    Of a class the text that stays is that of the least id, then of the least n-gram set, then of the least hash; no id comes
    after all ids.
    """
    bands, rows = band_plan(similarity, recall)
    signed = stored(signatures(docs, doc_id, text, words, bands, rows), "signatures")
    # Classes are numbered before they are stored: ids may repeat on different texts, so they cannot tell classes apart.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash"))
    classes = stored(
        signed.groupBy("key_1", "key_2").agg(
            least.alias("least"), F.count("*").alias("copies"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands"),
        ).select(
            "key_1", "key_2", F.col("least.doc_id").alias("rep"), F.col("least.text_hash").alias("text_hash"), "copies", "n_grams",
            "bands", F.monotonically_increasing_id().alias("node"),
        ),
        "gram-classes",
    )
    groups = stored(candidate_groups(classes), "band-groups")
    found = stored(verified(dealt(groups, classes), docs, doc_id, text, words, similarity), "cells")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.where("node > least").select(F.col("node").alias("a"), F.col("least").alias("b")))
    labels = stored(labels.join(classes.select("node", "rep", "key_1", "key_2"), "node"), "gram-labels")
    firsts = labels.groupBy("label").agg(F.min(F.struct(F.col("rep").isNull().alias("nameless"), "rep", "key_1", "key_2")).alias("first"))
    verdict = (
        classes.select("node", "key_1", "key_2", "rep", F.col("text_hash").alias("own_hash"), "copies")
        .join(links, "node", "left")
        .join(labels.join(firsts, "label").select("node", "first"), "node", "left")
        .select(
            "key_1", "key_2", "rep", "own_hash", F.when(F.col("first").isNull(), F.col("rep")).otherwise(F.col("first.rep")).alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce((F.col("first.key_1") == F.col("key_1")) & (F.col("first.key_2") == F.col("key_2")), F.lit(True)).alias("leads"),
        )
    )
    with_words = signed.select("doc_id", "text_hash", "key_1", "key_2").join(verdict, ["key_1", "key_2"]).select(
        "doc_id", "text_hash", "class_id", "n_links",
        (F.col("leads") & F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("text_hash") == F.col("own_hash"))).alias("stays"),
    )
    # What has no signature has no word: counted by rows, since ids may repeat.
    blank = identified(docs, doc_id, text).where(
        F.col("text").isNull() | ~F.col("text").rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]")
    )
    return with_words.unionByName(
        blank.select("doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("stays"))
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """One row per document: doc_id, class_id (least id of its class), n_links (other documents at the threshold or above).

    A text without a word is like no other: it is its own class, with no link. Rows without an id are linked and classed like
    all others; a class that has no id at all has the class id NULL. Rows that share an id are documents of their own: each
    has the class of its own text, though two classes may then have the same least id. An empty table gives an empty result.
    Other columns of docs are not read.
    """
    return classified(docs, doc_id, text, words, similarity, recall).select("doc_id", "class_id", "n_links")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay: of each class of near duplicates the least, by id (none comes last), n-gram set and hash
    of the text. Rows that agree in id and text all stay; so do all texts without a word.
    """
    verdicts = classified(docs, doc_id, text, WORDS, SIMILARITY, RECALL).where("stays")
    key, code, stay, stay_code = (fresh(n) for n in ("key", "hash", "stay", "stay_hash"))
    ids = verdicts.select(F.col("doc_id").alias(stay), F.col("text_hash").alias(stay_code)).distinct()
    rows = docs.withColumn(key, F.col(doc_id).cast("long")).withColumn(code, F.xxhash64(F.col(text)))
    same = F.col(key).eqNullSafe(F.col(stay)) & (F.col(code) == F.col(stay_code))
    return rows.join(ids, same, "left_semi").select(*docs.columns)
