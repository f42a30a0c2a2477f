"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

Stages, each a Spark job over narrow tables: (1) every document becomes the set of its
word shingles, hashed to 64 bits, and the set a signature; (2) documents of equal sets
form one class and only its smallest id goes on, so a group of exact copies is one row;
(3) bands of the signature are grouped, and every member of a bucket is paired with the
bucket's hub, never with all others; (4) pairs are confirmed on full shingle sets;
(5) confirmed links are merged; (6) buckets that still hold members of several components
are compared in blocks, by signature and then by full sets, so that the choice of hubs
decides nothing. A block hands on no pairs but links that connect its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.components import component_labels, union_find
from tallyhouse.session import write_through

# Registers of a signature; a power of two, so that odd steps visit every register once.
REGISTERS = 256
# Bands and registers per band: a pair at similarity 0.8 is missed with (1-0.8**6)**42 < 3e-6.
BANDS, BAND_WIDTH = 42, 6
# Signature agreement under which a pair is not confirmed: six deviations under 0.8.
_LIKELY = 0.65
# Members and shingles of one block when buckets are compared inside.
_BLOCK, _BLOCK_SHINGLES = 1500, 2_000_000
_WORDS_HELD = 400_000
_U = np.uint64
_held_words: dict[bytes, int] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64 bits for each of ``x`` (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    held = _held_words
    if len(held) > _WORDS_HELD:
        held.clear()
    hashes = []
    for word in words:
        value = held.get(word)
        if value is None:
            value = held[word] = xxhash.xxh3_64_intdigest(word)
        hashes.append(value)
    return np.array(hashes, np.uint64)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words (A-Z in lower case).

    A text of fewer words is one shingle; one without words has none.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = _word_hashes(words)
    width = min(width, len(words))
    count = len(words) - width + 1
    mixed = np.full(count, width, np.uint64)
    for i in range(width):
        mixed = _mixed(mixed * _U(0x9E3779B97F4A7C15) + hashes[i : i + count])
    return np.unique(mixed)


def super_minhash(elements: np.ndarray, owners: np.ndarray, n_sets: int) -> np.ndarray:
    """Signatures (n_sets x REGISTERS) of sets given as hashed elements and their owners.

    In round j each element puts ``j + u`` (u uniform in [0, 1)) into the register that is
    j-th in its own seeded order of registers, so its ranks over the registers are a
    permutation and not independent draws. A set is done as soon as every register holds
    a value under j + 1: later rounds can't lower any.
    """
    # The whole part of a value is its round: 10 bits of round over 22 of fraction.
    best = np.full((n_sets, REGISTERS), 0xFFFFFFFF, np.uint32)
    flat = best.reshape(-1)
    start = elements & _U(REGISTERS - 1)
    step = (elements >> _U(32)) & _U(REGISTERS - 1) | _U(1)
    owners = owners.astype(np.uint64)
    for j in range(REGISTERS):
        register = (start + step * _U(j)) & _U(REGISTERS - 1)
        fraction = _mixed(elements + _U((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> _U(42)
        value = (fraction | _U(j << 22)).astype(np.uint32)
        np.minimum.at(flat, (owners * _U(REGISTERS) + register).astype(np.int64), value)
        open_sets = best.max(axis=1) >= ((j + 1) << 22)
        if not open_sets.any():
            break
        going = open_sets[owners.astype(np.int64)]
        if not going.all():
            elements, start, step, owners = elements[going], start[going], step[going], owners[going]
        if not len(elements):
            break
    return best


def _band_hashes(signatures: np.ndarray) -> np.ndarray:
    """(n_sets x BANDS) hashes of consecutive registers; the band's number goes in too."""
    mixed = np.zeros((len(signatures), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
    taken = signatures[:, : BANDS * BAND_WIDTH].reshape(len(signatures), BANDS, BAND_WIDTH)
    for i in range(BAND_WIDTH):
        mixed = _mixed(mixed * _U(0x9E3779B97F4A7C15) + taken[:, :, i].astype(np.uint64))
    return mixed


def _sets(batch: pa.RecordBatch, width: int, most: int = 200_000) -> Iterator[tuple[list, list]]:
    """Ids and shingle sets, in slices of at most about ``most`` shingles."""
    ids, sets, held = [], [], 0
    for i in range(batch.num_rows):
        ids.append(batch.column(0)[i].as_py())
        sets.append(shingle_set(batch.column(1)[i].as_py(), width))
        held += len(sets[-1])
        if held >= most or len(sets) >= 1000:
            yield ids, sets
            ids, sets, held = [], [], 0
    if ids:
        yield ids, sets


_SIGNED = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
    ("bands", pa.list_(pa.int64())), ("sketch", pa.binary()),
])


def signed(documents: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, band hashes and a one-byte-per-register sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sets in _sets(batch, width):
                lengths = [len(one) for one in sets]
                owners = np.repeat(np.arange(len(sets)), lengths)
                signatures = super_minhash(np.concatenate(sets), owners, len(sets))
                bands = _band_hashes(signatures).view(np.int64)
                sketches = _mixed(signatures.astype(np.uint64)).astype(np.uint8)
                offsets = np.arange(len(sets) + 1, dtype=np.int32) * BANDS
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(one.tobytes()) for one in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.reshape(-1))),
                    pa.array([row.tobytes() for row in sketches], pa.binary()),
                ], schema=_SIGNED)

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary"
    )


def shingle_table(documents: DataFrame, width: int) -> DataFrame:
    """doc_id and the sorted shingle set as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.list_(pa.int64()))])
        for batch in batches:
            for ids, sets in _sets(batch, width):
                offsets = np.concatenate([[0], np.cumsum([len(one) for one in sets])]).astype(np.int32)
                values = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                    schema=schema,
                )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, shingles array<long>")


def similar_sizes(a: str, b: str) -> Column:
    """False where the sizes alone keep the similarity under 0.8."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * 80


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * common >= 80 * union."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    counted = both.select("a", "b", common.alias("common"), (F.size("of_a") + F.size("of_b")).alias("total"))
    return counted.where(F.col("common") * 100 >= (F.col("total") - F.col("common")) * 80).select("a", "b").distinct()


def _undecided(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(rep, hash, n_shingles, component) of buckets with members of several components.

    The hub has met both members of a bucket of two, so larger ones are left.
    """
    marked = buckets.join(labels.withColumnRenamed("doc_id", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    several = marked.groupBy("hash").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members")
    ).where("low < high AND members > 2").select("hash")
    return marked.join(several, "hash", "left_semi")


def _stars(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each bucket's hub with its other members.

    The hub has the bucket's smallest draw, so that it is the same one in most buckets of
    a group and its pairs with a member are one pair.
    """
    member = F.struct(F.xxhash64("rep").alias("draw"), "rep", "n_shingles")
    hubs = members.groupBy("hash").agg(F.min(member).alias("hub"))
    hub = F.col("hub.rep")
    return members.join(hubs, "hash").where(
        (hub != F.col("rep")) & similar_sizes("hub.n_shingles", "n_shingles")
    ).select(F.least(hub, "rep").alias("a"), F.greatest(hub, "rep").alias("b")).distinct()


def _agreeing(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(row, other rows) of one cell: other component, sizes and sketches that allow a link.

    A pair that shares several buckets is met in the first of them only. Rows of half 1
    and 2 are two blocks of a bucket, rows of half 0 are one block compared with itself.
    """
    ids, labels = table.column("rep").to_numpy(), table.column("component").to_numpy()
    sizes, halves = table.column("n_shingles").to_numpy(), table.column("half").to_numpy()
    sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, REGISTERS)
    bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    here = bands == table.column("hash")[0].as_py()
    band = int(np.argmax(here.any(axis=0)))
    second = np.flatnonzero(halves != 1)
    for i in np.flatnonzero(halves < 2):
        other = second[labels[second] != labels[i]]
        if halves[i] == 0:
            other = other[ids[other] > ids[i]]
        small, large = np.minimum(sizes[other], sizes[i]), np.maximum(sizes[other], sizes[i])
        other = other[small * 100 >= large * 80]
        if band and len(other):
            other = other[~(bands[other, :band] == bands[i, :band]).any(axis=1)]
        if len(other):
            other = other[(sketches[other] == sketches[i]).mean(axis=1) >= _LIKELY]
        if len(other):
            yield int(i), other


def _likely(table: pa.Table) -> pa.Table:
    """(hash, rep) of the rows of a cell that look linked with another one."""
    found: set[int] = set()
    for i, other in _agreeing(table):
        found.add(i)
        found.update(other.tolist())
    return table.select(["hash", "rep"]).take(pa.array(sorted(found), pa.int64()))


def _linked(table: pa.Table) -> pa.Table:
    """The links inside a cell, confirmed on full sets, as few as connect the same rows."""
    ids = table.column("rep").to_numpy()
    lists = table.column("shingles").combine_chunks()
    starts = lists.offsets.to_numpy()
    names, places = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    sizes, present = np.diff(starts), np.zeros(len(names), np.int64)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, other in _agreeing(table):
        present[places[starts[i] : starts[i + 1]]] = 1
        common = np.array([present[places[starts[j] : starts[j + 1]]].sum() for j in other])
        present[places[starts[i] : starts[i + 1]]] = 0
        met = other[100 * common >= 80 * (sizes[i] + sizes[other] - common)]
        left.append(np.full(len(met), ids[i]))
        right.append(ids[met])
    a, b = union_find(np.concatenate(left), np.concatenate(right))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _cells(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` (hash, rep, ...) once for each pair of blocks (x, y) of their bucket.

    ``sizes`` has (hash, n_shingles) of the same rows: a bucket has as many blocks as keep
    each within ``_BLOCK`` rows and ``_BLOCK_SHINGLES``, about.
    """
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / _BLOCK), F.ceil(F.sum("n_shingles") / _BLOCK_SHINGLES))
    counted = sizes.groupBy("hash").agg(blocks.cast("int").alias("blocks"))
    block, other = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"), F.sequence(F.lit(0), F.col("blocks") - 1)
    spread = rows.join(counted, "hash").withColumn("block", block).withColumn("other", F.explode(other))
    half = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    return spread.select(
        *rows.columns, F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), half.alias("half")
    )


def _across(members: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) inside buckets between different components; ``members`` as from :func:`_undecided`.

    Rows whose sketches look linked with none go first; sets are sent for the others only.
    """
    signatures = classes.select("rep", "sketch", "bands")
    first = _cells(members.join(signatures, "rep"), members)
    likely = write_through(
        first.groupBy("hash", "x", "y").applyInArrow(_likely, "hash long, rep long").distinct()
        .join(members, ["hash", "rep"])
    )
    full = likely.join(signatures.join(sets.withColumnRenamed("doc_id", "rep"), "rep"), "rep")
    return _cells(full, likely).groupBy("hash", "x", "y").applyInArrow(_linked, "a long, b long").distinct()


def near_duplicates(documents: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links) and kept, per row.

    Links join texts whose sets of ``width``-word shingles (A-Z in lower case) have a
    Jaccard similarity of 0.8 or more. Texts that are null, empty or without words have no
    shingles and link with nothing. Rows that share an id are one node: they get the same
    component and stay or go together. A row without an id cannot be named in a
    link: its component is null and it is kept. Other columns are not read.
    """
    documents = documents.select("doc_id", "text")
    table = write_through(signed(documents, width))
    named = table.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = write_through(
        named.groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
        )
    )
    entries = classes.select("rep", "n_shingles", F.explode("bands").alias("hash"))
    shared = entries.groupBy("hash").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    buckets = write_through(entries.join(shared.select("hash"), "hash", "left_semi"))
    # Rows that share an id share a node; any of its texts can confirm a link.
    members = write_through(buckets.select(F.col("rep").alias("doc_id")).distinct())
    sets = write_through(shingle_table(documents.join(members, "doc_id", "left_semi"), width))
    stars = _stars(buckets)
    links = write_through(confirm(write_through(stars), sets))
    left = write_through(_undecided(buckets, component_labels(links)))
    across = write_through(_across(left, classes, sets))
    # Members of a class link with its smallest id.
    same = named.join(classes.select("digest", "rep"), "digest").where("doc_id <> rep").select(
        F.col("rep").alias("a"), F.col("doc_id").alias("b")
    )
    final = component_labels(links.union(across).union(same))
    joined = table.select("doc_id", "n_shingles").join(final, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(documents: DataFrame, width: int = 5) -> DataFrame:
    """One document of each near-duplicate group, the one of the smallest id, all columns."""
    gone = near_duplicates(documents, width).where(~F.col("kept")).select("doc_id").distinct()
    return documents.join(gone, "doc_id", "left_anti").select(*documents.columns)
