"""MinHash near-duplicates by min-max hashing.

Every permutation of the shingle hashes yields two signature values, the
smallest and the largest, so 126 hash evaluations give 252 values; 42 bands of
six values find candidates. A pair of similarity 0.75 shares no band with a
probability of 0.00026, one of 0.8 with 0.000003. That holds for long texts; the
fewer shingles, the less often both extremes survive. So sets of up to SMALL
shingles have exact candidates instead: in the order of their hashes, two sets that
are similar enough share one of their first n - ceil(0.75 n) + 1 shingles. Sets a
little larger have both, as a small set may be similar to them. Candidates are
confirmed on the full shingle sets.

Documents with equal sets form one class first, and only classes are compared.
Within a band's bucket the classes are compared with the bucket's most central
class; classes that this leaves in different components are then compared with
the bucket's classes in other components, unless an upper bound of what the two
share rules a link out. Pairs within a component cannot change it, so a
group of n copies costs about n comparisons and no link that joins two components
is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import discard, sized, stage
from .components import connected_components
from .words import chunks, distinct_sets, mix, shingles

BANDS, PERMUTATIONS_PER_BAND = 42, 3
PERMUTATIONS = BANDS * PERMUTATIONS_PER_BAND
SIMILAR_PERCENT = 75
SMALL = 20  # shingles up to which all candidates are found
MEETS_SMALL = SMALL * 100 // SIMILAR_PERCENT  # the largest set that one of so many can be similar to
PIECE = 1 << 16  # hashes permuted at a time, so that they stay in the processor's cache

_random = np.random.default_rng(99)
_FACTOR = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_VALUE_SALT = _random.integers(0, 2**63, (BANDS, 2 * PERMUTATIONS_PER_BAND), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PREFIX_SALT = np.uint64(_random.integers(0, 2**63))

SIGNATURES = "doc_id long, n_shingles long, digest binary, bands array<long>"
SETS = "class long, doc_id long, shingles array<long>"
CROWDED = 8  # classes in a bucket from which on a bound spares comparisons
PARTS = 32  # of the shingles, by which that bound counts


def min_max_values(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Per text and permutation the smallest and largest permuted hash; no text may be empty."""
    texts = len(begin) - 1
    out = np.empty((texts, PERMUTATIONS, 2), np.uint32)
    first = 0
    while first < texts:
        last = max(first + 1, int(np.searchsorted(begin, begin[first] + PIECE, "right")) - 1)
        part, edges = hashes[begin[first] : begin[last]], begin[first:last] - begin[first]
        for p in range(PERMUTATIONS):
            permuted = ((part * _FACTOR[p] + _SHIFT[p]) >> np.uint64(32)).astype(np.uint32)
            out[first:last, p, 0] = np.minimum.reduceat(permuted, edges)
            out[first:last, p, 1] = np.maximum.reduceat(permuted, edges)
        first = last
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per text and band; keys of different bands differ."""
    grouped = values.reshape(len(values), BANDS, 2 * PERMUTATIONS_PER_BAND).astype(np.uint64)
    return mix((grouped * _VALUE_SALT).sum(axis=2, dtype=np.uint64) + _VALUE_SALT[:, 0]).view(np.int64)


def prefix_keys(own: np.ndarray) -> np.ndarray:
    """Keys of a set's first shingles: of two similar sets at least one is the same. ``own`` rises."""
    first = len(own) - -(-SIMILAR_PERCENT * len(own) // 100) + 1
    return mix(own[:first] ^ _PREFIX_SALT).view(np.int64)


def bucket_keys(hashes: np.ndarray, begin: np.ndarray) -> list[np.ndarray | None]:
    """Every text's buckets; none for a text without shingles."""
    many = np.diff(begin)
    banded = np.flatnonzero(many > SMALL)
    keys: list[np.ndarray | None] = [None] * len(many)
    if len(banded):
        every = np.concatenate([hashes[begin[i] : begin[i + 1]] for i in banded])
        for i, bands in zip(banded, band_keys(min_max_values(every, np.concatenate(([0], np.cumsum(many[banded]))))), strict=True):
            keys[i] = bands
    for i in np.flatnonzero((many > 0) & (many <= MEETS_SMALL)):
        prefix = prefix_keys(hashes[begin[i] : begin[i + 1]])
        keys[i] = prefix if keys[i] is None else np.concatenate((keys[i], prefix))
    return keys


def _set_digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, bands = [], [], []
        for chunk in chunks(batch.column("text")):
            hashes, begin = distinct_sets(*shingles(chunk.words, chunk.at))
            many = np.diff(begin)
            sizes.extend(many.tolist())
            digests.extend(_set_digest(hashes[a:b]) if b > a else None for a, b in zip(begin[:-1], begin[1:], strict=True))
            bands.extend(bucket_keys(hashes, begin))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["doc_id", "n_shingles", "digest", "bands"],
        )


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full sets of the texts whose set is the one that the class stands for."""
    for batch in batches:
        wanted, classes, documents = (batch.column(c).to_pylist() for c in ("digest", "class", "doc_id"))
        for chunk in chunks(batch.column("text")):
            of_class, of_document, sets = [], [], []
            hashes, begin = distinct_sets(*shingles(chunk.words, chunk.at))
            for i, (a, b) in enumerate(zip(begin[:-1], begin[1:], strict=True), chunk.first):
                if _set_digest(hashes[a:b]) == wanted[i]:
                    of_class.append(classes[i])
                    of_document.append(documents[i])
                    sets.append(hashes[a:b].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(of_class, pa.int64()), pa.array(of_document, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                ["class", "doc_id", "shingles"],
            )


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs (x, y) of classes those whose full sets are similar enough, as links (a, b) of their documents."""
    left = sets.select(F.col("class").alias("x"), F.col("doc_id").alias("a"), F.col("shingles").alias("of_x"))
    right = sets.select(F.col("class").alias("y"), F.col("doc_id").alias("b"), F.col("shingles").alias("of_y"))
    counted = pairs.join(right, "y").join(left, "x").select(
        "a",
        "b",
        F.size(F.array_intersect("of_x", "of_y")).cast("long").alias("shared"),
        (F.size("of_x") + F.size("of_y")).cast("long").alias("total"),
    )
    return counted.where(100 * F.col("shared") >= SIMILAR_PERCENT * (F.col("total") - F.col("shared"))).select("a", "b")


def _could_be_similar(size: str, other_size: str) -> Column:
    """Sets of these sizes can reach the similarity: the smaller one would have to lie in the larger."""
    return 100 * F.least(size, other_size) >= SIMILAR_PERCENT * F.greatest(size, other_size)


def _centres(rows: DataFrame) -> DataFrame:
    """(bucket, centre, centre_size, weight): the bucket's class that meets most others over all its buckets."""
    weight = rows.groupBy("class").agg(F.sum("filled").alias("weight"))
    first = F.max(F.struct("weight", "class", "size")).alias("first")
    return rows.join(weight, "class").groupBy("bucket").agg(first).select(
        "bucket", F.col("first.class").alias("centre"), F.col("first.size").alias("centre_size"), "first.weight"
    )


def _star_pairs(rows: DataFrame, centres: DataFrame) -> DataFrame:
    """Each bucket's classes with its centre."""
    return (
        rows.join(centres, "bucket")
        .where((F.col("class") != F.col("centre")) & _could_be_similar("size", "centre_size"))
        .select(F.least("centre", "class").alias("x"), F.greatest("centre", "class").alias("y"))
        .distinct()
    )


def _counts_by_part(hashes: Column) -> Column:
    def count(part: Column) -> Column:
        return F.size(F.filter(hashes, lambda h: F.pmod(h, F.lit(PARTS)) == part)).cast("long")

    return F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), count)


def _profiles(crowded: DataFrame, sets: DataFrame) -> DataFrame:
    """How a class's shingles lie: (class, middle, inside, outside) for the given (class, middle).

    Shingles fall into PARTS parts. ``inside`` counts, part by part, those that
    the middle class has too, ``outside`` the others that at least one more of
    these classes has. What two classes of one middle share lies in both's counts,
    so the smaller counts, summed up, bound it.
    """
    members = crowded.select("class").union(crowded.select("middle")).distinct()
    each = sets.join(members, "class", "left_semi").select("class", F.explode("shingles").alias("shingle"))
    owned = each.groupBy("shingle").agg(F.count("*").alias("owners"), F.min("class").alias("class")).where("owners = 1")
    own = owned.groupBy("class", F.pmod("shingle", F.lit(PARTS)).cast("int").alias("part")).agg(F.count("*").alias("n"))
    own = own.groupBy("class").agg(F.map_from_entries(F.collect_list(F.struct("part", "n"))).alias("own"))
    of_middle = sets.select(F.col("class").alias("middle"), F.col("shingles").alias("of_middle"))
    both = crowded.join(sets, "class").join(of_middle, "middle").join(own, "class", "left")
    counted = both.select(
        "class",
        "middle",
        _counts_by_part(F.array_intersect("shingles", "of_middle")).alias("inside"),
        _counts_by_part(F.array_except("shingles", "of_middle")).alias("beyond"),
        "own",
    )
    # Shingles of one owner are beyond the middle, but for the middle's own.
    rest = F.transform("beyond", lambda n, part: F.greatest(n - F.coalesce(F.col("own")[part], F.lit(0).cast("long")), F.lit(0).cast("long")))
    return stage(counted.select("class", "middle", "inside", rest.alias("outside")), "profiles")


def _middles(rows: DataFrame) -> DataFrame:
    """(class, middle): the most central class its buckets lead to, or that one's in turn."""
    nearest = stage(rows.groupBy("class").agg(F.max(F.struct("weight", "centre")).alias("nearest")).select("class", "nearest.centre"), "nearest")
    # Centres are few, and one of them may be that of most classes: what they lead to comes to the classes.
    further = nearest.select(F.col("class").alias("centre"), F.col("centre").alias("beyond"))
    further = stage(further.join(nearest.select("centre").distinct(), "centre", "left_semi"), "further")
    return nearest.join(sized(further), "centre", "left").select("class", F.coalesce("beyond", "centre").alias("middle"))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)


def _smaller(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _bridge_pairs(placed: DataFrame, centres: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of classes that share a bucket but no component, as far as they can be similar.

    All classes outside a bucket's largest component meet those of other
    components there. In crowded buckets the bound of ``_profiles`` goes first, so
    a copy that is too far from all others is compared with next to none of them.
    """
    parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("many")).groupBy("bucket").agg(
        F.count("*").alias("parts"), F.sum("many").alias("filled"), F.max(F.struct("many", "component")).alias("main")
    )
    split = parts.where("parts > 1").select("bucket", "filled", F.col("main.component").alias("main"))
    open_rows = stage(placed.drop("filled").join(split, "bucket").join(centres.select("bucket", "centre", "weight"), "bucket"), "open")
    crowded = F.col("filled") >= CROWDED
    profiles = _profiles(stage(_middles(open_rows.where(crowded)), "middles"), sets)
    known = open_rows.join(profiles, "class", "left").withColumns(
        {side: F.when(crowded, F.col(side)) for side in ("middle", "inside", "outside")}
    )
    bounded = known.withColumn("common", F.coalesce(_total(F.col("inside")) + _total(F.col("outside")), F.col("size")))
    # What a class can reach at best: its common part lies in the smallest class of the bucket that is large enough.
    smallest = open_rows.groupBy("bucket").agg(F.min("size").alias("smallest"))
    reach = F.greatest(F.col("smallest"), F.ceil(F.col("size") * SIMILAR_PERCENT / 100))
    able = stage(
        bounded.join(smallest, "bucket").where(
            100 * F.col("common") >= SIMILAR_PERCENT * (F.col("size") + reach - F.least(F.col("common"), reach))
        ),
        "able",
    )
    apart = able.where("component <> main").select("bucket", "class", "component", "size", "middle", "inside", "outside")
    others = able.select(
        "bucket",
        F.col("class").alias("other"),
        F.col("component").alias("other_component"),
        F.col("size").alias("other_size"),
        F.col("middle").alias("other_middle"),
        F.col("inside").alias("other_inside"),
        F.col("outside").alias("other_outside"),
        (F.col("component") == F.col("main")).alias("in_main"),
    )
    by_parts = _total(F.zip_with("inside", "other_inside", _smaller)) + _total(F.zip_with("outside", "other_outside", _smaller))
    most = F.coalesce(F.when(F.col("middle") == F.col("other_middle"), by_parts), F.least("size", "other_size"))
    return (
        apart.join(others, "bucket")
        .where((F.col("component") != F.col("other_component")) & (F.col("in_main") | (F.col("class") < F.col("other"))))
        .where(_could_be_similar("size", "other_size"))
        .where(100 * most >= SIMILAR_PERCENT * (F.col("size") + F.col("other_size") - most))
        .select(F.least("class", "other").alias("x"), F.greatest("class", "other").alias("y"))
        .distinct()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Only ``doc_id`` and ``text`` are read, whatever other columns there are.
    Words are runs of bytes without ASCII blanks, A-Z lower-cased. A text with
    fewer than five words has its whole sequence as one shingle; a NULL or blank
    text has none and is linked with nothing. Rows that repeat a doc_id are one
    document with the links of all of them. A row without doc_id gets no
    component, is linked with nothing and is kept.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stage(texts.mapInArrow(_sign, SIGNATURES).withColumn("row", F.monotonically_increasing_id()), "signatures")
    known = signed.where("doc_id is not null and digest is not null")

    # A class is named by the row of its first document.
    first = F.min(F.struct("doc_id", "row", "n_shingles")).alias("first")
    classes = stage(
        known.groupBy("digest").agg(first).select("digest", "first.doc_id", F.col("first.row").alias("class"), F.col("first.n_shingles").alias("size")),
        "classes",
    )
    members = known.select("digest", F.col("doc_id").alias("a")).join(classes.select("digest", F.col("doc_id").alias("b")), "digest")
    members = members.where("a <> b").select("a", "b").distinct()

    in_buckets = known.join(classes.select(F.col("class").alias("row")), "row", "left_semi").select(
        F.col("row").alias("class"), F.explode("bands").alias("bucket")
    )
    shared = in_buckets.groupBy("bucket").agg(F.count("*").alias("filled")).where("filled > 1")
    met = stage(in_buckets.join(shared, "bucket"), "buckets")
    named = stage(classes.join(met.select("class").distinct(), "class", "left_semi"), "named")
    rows = met.join(named.select("class", "size"), "class")
    sets = stage(
        texts.where("text is not null").join(sized(named.select("doc_id", "class", "digest")), "doc_id").mapInArrow(_shingle_sets, SETS), "sets"
    )
    many, different = sets.agg(F.count("*"), F.count_distinct("class")).first()
    if many > different:  # the same row twice in the table
        sets = stage(sets.dropDuplicates(["class"]), "sets")

    centres = stage(_centres(rows), "centres")
    star = stage(_star_pairs(rows, centres), "star")
    links = stage(confirmed(star, sets), "links")
    joined = connected_components(links)
    known_part = named.select("class", F.col("doc_id").alias("node")).join(joined, "node", "left")
    placed = stage(rows.join(known_part.select("class", F.coalesce("component", "node").alias("component")), "class"), "placed")
    bridges = confirmed(_bridge_pairs(placed, centres, sets).join(star, ["x", "y"], "left_anti"), sets)
    # What is joined already goes on as one link a document to its component.
    known_links = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
    components = connected_components(known_links.unionByName(bridges).unionByName(members))
    for table in (classes, met, named, sets, centres, star, links, joined, placed):
        discard(table)
    return (
        signed.join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that are not the first of their group.

    Rows that repeat a doc_id and its text are one document: one of them stays, as
    does one of all rows without doc_id that have equal texts (NULL like any other).
    Rows of one doc_id with different texts all stay, or go, together.
    """
    groups = stage(near_duplicates(docs), "groups")
    going = stage(groups.where("not kept").select("doc_id").distinct(), "copies")
    left = docs.join(sized(going), "doc_id", "left_anti").select(*docs.columns)
    again = stage(groups.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select(F.col("doc_id").alias("id_again")), "again")
    if again.isEmpty():
        return left
    same_id = left["doc_id"].cast("long").eqNullSafe(F.col("id_again"))
    single = left.join(sized(again), same_id, "left_anti")
    row = F.struct(*(left[c] for c in left.columns))
    repeated = left.join(sized(again), same_id, "left_semi").select(row.alias("row"), F.xxhash64(row.cast("string")).alias("pick"))
    by_text = F.sha2(F.coalesce(F.concat(F.lit("t"), F.col("row.text").cast("string")), F.lit("")), 256)
    once = repeated.groupBy(F.col("row.doc_id").alias("id_again"), by_text.alias("said")).agg(F.max_by("row", "pick").alias("row"))
    return single.unionByName(once.select("row.*"))
