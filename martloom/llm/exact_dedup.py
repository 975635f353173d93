"""Exact duplicates through an extendible-hash index over the texts, with DataFrame functions only.

The directory comes first, in the way of extendible hashing (Fagin et al., 1979): it maps the leading bits of a 64-bit hash to
buckets. It starts with one bucket; each round doubles the directory and splits the buckets that hold more distinct hashes
than fit, while the others keep their fewer bits. Copies share one hash and never overfill a bucket.

A bucket is a range of hashes. Neighbouring buckets are dealt to owners, so that each owner has about as many hashes; a text
goes to the owner of its bucket. There texts of one bucket and hash are chained and compared by their bytes, so a collision
makes a second entry and never a false copy. The index files in the shared folder hold one entry for each distinct text, in
a folder for each owner, and a document finds its entry through the directory: by owner, bucket, hash and SHA-256.

Copies are combined in each task before anything is shuffled, so a text that makes up a third of all rows costs one row
for each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import stored

BLANKS = r"[\x20\x09-\x0D]+"
# Distinct hashes in a bucket of the directory; documented size of an owner's smallest unit of work.
BUCKET_ENTRIES = 1 << 16
# Entries of one owner, about: what a task chains at a time.
OWNER_ENTRIES = 1 << 20
# Bits by which the directory is cut into stretches that are put in order on their own.
PART_BITS = 12
# The directory looks at no more than the leading 40 bits: 2^40 buckets.
MOST_BITS = 40


def normalised(text: Column) -> Column:
    """The text without any white space of ASCII; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def prefix(key: Column, bits: Column | int) -> Column:
    """The leading bits of a hash (0 bits: 0)."""
    bits = F.lit(bits) if isinstance(bits, int) else bits
    return F.when(bits > 0, F.call_function("shiftrightunsigned", key, (F.lit(64) - bits).cast("int"))).otherwise(
        F.lit(0).cast("long")
    )


def directory(keys: DataFrame, capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """Buckets (depth, bucket) whose ranges cover all hashes, none with more distinct keys than its capacity.

    A round counts the keys below the overfull buckets only, one bit deeper. The number of rounds grows with the
    logarithm of the number of keys, and only one number comes to the driver in each.
    """
    distinct = keys.select("key").distinct()
    most = distinct.count()
    fine = 0
    while fine < MOST_BITS and (most >> fine) > max(1, capacity // 8):
        fine += 1
    counted = distinct.groupBy(prefix(F.col("key"), fine).alias("fine")).agg(F.count("*").alias("entries"))
    counted = stored(counted, "hash-counts")
    settled = None
    overfull = counted.select("fine", "entries", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("bucket"))
    for depth in range(fine + 1):
        bucket = F.shiftright("fine", fine - depth)
        at = overfull.select("fine", "entries", F.lit(depth).alias("depth"), bucket.alias("bucket"))
        sizes = at.groupBy("bucket").agg(F.sum("entries").alias("held"))
        full = (F.col("held") > capacity) & F.lit(depth < fine)
        done = sizes.where(~full).select(F.lit(depth).alias("depth"), "bucket", F.col("held").alias("entries"))
        settled = done if settled is None else settled.unionByName(done)
        overfull = stored(at.join(sizes.where(full).select("bucket"), "bucket", "left_semi"), "hash-overfull")
        if overfull.isEmpty():
            break
    return settled


def owned(buckets: DataFrame, entries: int = OWNER_ENTRIES) -> DataFrame:
    """The directory with the owner of each bucket: owners hold neighbouring buckets and about so many entries each.

    Entries are counted by the leading bits first, so that no task has to put all buckets in order; a stretch of the
    directory that has more than one owner's entries has owners of its own.
    """
    first = prefix_of_bucket(F.col("depth"), F.col("bucket"))
    parts = buckets.withColumn("part", F.shiftrightunsigned(first, 64 - PART_BITS).cast("int")).withColumn("first", first)
    sizes = parts.groupBy("part").agg(F.sum("entries").alias("held"))
    # At most 2^PART_BITS rows.
    before = F.sum("held").over(Window.orderBy("part")) - F.col("held")
    begins = sizes.select("part", before.alias("before"))
    inside = F.sum("entries").over(Window.partitionBy("part").orderBy(F.col("first").bitwiseXOR(F.lit(-(1 << 63)).cast("long")))) - F.col("entries")
    placed = parts.join(F.broadcast(begins), "part").withColumn("at", F.col("before") + inside)
    return placed.select("depth", "bucket", F.floor(F.col("at") / entries).cast("long").alias("owner"))


def prefix_of_bucket(depth: Column, bucket: Column) -> Column:
    """The least hash of a bucket."""
    return F.when(depth > 0, F.call_function("shiftleft", bucket, (F.lit(64) - depth).cast("int"))).otherwise(F.lit(0).cast("long"))


def placed(keys: DataFrame, buckets: DataFrame) -> DataFrame:
    """Each key with its bucket and owner: for every depth that the directory uses, the leading bits are looked up.

    A key is in exactly one bucket. Keys that the directory was not built for would be in one too, but a directory that lacks
    a bucket loses its keys.
    """
    depths = [r["depth"] for r in buckets.select("depth").distinct().collect()]  # at most MOST_BITS + 1
    at = F.array(*[F.struct(F.lit(d).alias("depth"), prefix(F.col("key"), d).alias("bucket")) for d in sorted(depths) or [0]])
    wide = keys.withColumn("at", F.explode(at)).select("*", "at.*").drop("at")
    return wide.join(buckets, ["depth", "bucket"])


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = BUCKET_ENTRIES
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree after all ASCII white space is deleted; NULL is the empty text. Of equal texts the
    longest original (in code points) stays, then the one with the smallest id. A NULL id loses every tie. Rows that
    repeat an id are rows of their own for group_size; if such a row wins, all rows with its id and text are kept. An
    empty table gives an empty result. Other columns of docs are not read.
    """
    norm = normalised(F.col("raw"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("raw")).select(
        "doc_id",
        norm.alias("norm"),
        F.xxhash64(norm).alias("key"),
        F.length(F.coalesce("raw", F.lit(""))).alias("points"),
    )
    buckets = stored(owned(directory(rows, capacity)), "hash-directory")
    best = F.max(F.struct("points", F.bitwise_not("doc_id").alias("unlike")))
    # A chain is what one bucket holds of one hash; its texts are compared byte by byte, as part of the grouping, and a task
    # combines its own first.
    chains = placed(rows, buckets).groupBy("owner", "depth", "bucket", "key", "norm").agg(F.count("*").alias("group_size"), best.alias("best"))
    entries = chains.select(
        "owner", "depth", "bucket", "key", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.bitwise_not("best.unlike").alias("keep_id"), "group_size",
    )
    index = stored(entries.repartitionByRange("owner", "key").sortWithinPartitions("owner", "bucket", "key"), "hash-index")
    asked = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("norm")).select(
        "doc_id", F.xxhash64("norm").alias("key"), F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")
    )
    found = placed(asked, buckets).join(index, ["owner", "depth", "bucket", "key", "text_sha256"])
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, one for each distinct text, with all their columns.

    Of rows that agree in id and text the longest stays, then the one whose columns hash highest.
    """
    verdicts = exact_duplicates(docs, doc_id, text).where("kept")
    names = ["_exact_null", "_exact_id", "_exact_sha"]

    def identity(sha: Column) -> list[Column]:
        key = F.col(doc_id)
        values = [key.isNull(), F.coalesce(key, F.lit(0)), sha]
        return [v.alias(n) for v, n in zip(values, names, strict=True)]

    verdicts = verdicts.withColumnRenamed("doc_id", doc_id) if doc_id != "doc_id" else verdicts
    winners = verdicts.select(*identity(F.col("text_sha256")))
    rows = F.struct(*docs.columns)
    rank = F.struct(F.length(F.coalesce(F.col(text), F.lit(""))), F.xxhash64(*docs.columns))
    marked = docs.select(
        *identity(F.sha2(normalised(F.col(text)).cast("binary"), 256)), rows.alias("_row"), rank.alias("_rank")
    )
    kept = marked.join(winners, names, "left_semi").groupBy(*names).agg(F.max_by("_row", "_rank").alias("_row"))
    return kept.select("_row.*")
