"""Near-duplicate documents: DartMinHash signatures of word shingles, banded joins, exact verification.

Every element of a weighted set owns a region as wide as its weight. Darts fall on it at random but fixed places: the
hash of the element, a cell of weights and a box of ranks says how many and where. Each dart that lands within the weight
has a coordinate and a rank; a signature keeps the earliest dart of each coordinate. Two sets agree in a coordinate with
the probability of their weighted Jaccard similarity, and a set of any size needs only some k ln k darts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegrid.llm.common import chunks, having, join_groups, map_batches, mix, ramps, released, shingle_hashes, stored, without, word_hashes, words
from tidegrid.llm.components import components, joined

WIDTH = 5  # words of a shingle
SIMILAR = 0.8
BANDS, ROWS = 20, 4  # a pair at 0.8 misses all bands with a chance of 3 in 100,000
POISSON = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)])
#: Counters that tell common shingles from rare ones; only the order of a prefix depends on them, never a result.
SLOTS = 2**18
CHUNK = 1_000_000
CHUNK_DOCS = 400


def unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(elements: np.ndarray, weights: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """Signatures of weighted sets: ``n`` elements each, behind each other. One row of ``k`` dart ids per set; empty sets get zeros."""
    out = np.zeros((len(n), k), np.uint64)
    sets = np.flatnonzero(n > 0)
    starts = np.cumsum(n) - n
    total = np.bincount(np.repeat(np.arange(len(n)), n), weights, len(n))
    limit = np.zeros(len(n))
    limit[sets] = (k * np.log(k) + 2 * k) / total[sets]
    while len(sets):
        own = np.repeat(np.arange(len(sets)), n[sets])
        at = np.repeat(starts[sets], n[sets]) + ramps(n[sets])
        element, weight, t = elements[at], weights[at], limit[sets][own]
        # cells of weights [2^v - 1, 2^(v+1) - 1) that the element reaches into
        cells = np.ceil(np.log2(weight + 1)).astype(np.int64).clip(1)
        v = ramps(cells)
        own, element, weight, t = (np.repeat(x, cells) for x in (own, element, weight, t))
        # boxes of ranks, all of area one
        boxes = np.ceil(t * 2.0**v).astype(np.int64)
        q = ramps(boxes)
        own, element, weight, t, v = (np.repeat(x, boxes) for x in (own, element, weight, t, v))
        box = mix(element ^ mix((v.astype(np.uint64) << np.uint64(48)) | q.astype(np.uint64), 1), 2)
        darts = np.searchsorted(POISSON, unit(box), side="right")
        j = ramps(darts)
        own, weight, t, v, q, box = (np.repeat(x, darts) for x in (own, weight, t, v, q, box))
        dart = mix(box + j.astype(np.uint64), 3)
        place = 2.0**v - 1 + 2.0**v * unit(mix(dart, 4))
        rank = (q + unit(mix(dart, 5))) * 2.0**-v
        hit = (place < weight) & (rank < t)
        own, dart, rank = own[hit], dart[hit], rank[hit]
        cell = own * k + (mix(dart, 6) % np.uint64(k)).astype(np.int64)
        order = np.lexsort((rank, cell))
        first = np.ones(len(order), bool)
        first[1:] = cell[order][1:] != cell[order][:-1]
        cell, dart = cell[order][first], dart[order][first]
        full = np.bincount(cell // k, minlength=len(sets)) == k
        kept = full[cell // k]
        out[sets[cell[kept] // k], cell[kept] % k] = dart[kept]
        sets = sets[~full]
        limit[sets] *= 2  # some coordinate without a dart: throw on, further out
    return out


def shingles(texts: list[str | None], width: int, counted: bool) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text behind each other, and their number.

    With ``counted`` a shingle's second, third ... occurrence are elements of their own, so that the similarity of the sets
    is that of the multisets.
    """
    found, n = shingle_hashes(*word_hashes([words(t) for t in texts]), width)
    text = np.repeat(np.arange(len(texts)), n)
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    if not counted:
        return found[fresh], np.bincount(text[fresh], minlength=len(texts))
    runs = np.diff(np.append(np.flatnonzero(fresh), len(found)))
    return mix(found ^ mix(ramps(runs).astype(np.uint64), 8), 9), n


def weighted(texts: list[str | None], width: int, counted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes, their weights (1, or how often they occur) and their number per text."""
    found, n = shingle_hashes(*word_hashes([words(t) for t in texts]), width)
    if not counted:  # repeated elements throw the same darts, so they need not be removed
        return found, np.ones(len(found)), n
    text = np.repeat(np.arange(len(texts)), n)
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    counts = np.diff(np.append(np.flatnonzero(fresh), len(found)))
    return found[fresh], counts.astype(np.float64), np.bincount(text[fresh], minlength=len(texts))


def text_key(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def small_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text", CHUNK):
        for at in range(0, batch.num_rows, CHUNK_DOCS):
            yield batch.slice(at, CHUNK_DOCS)


def band_rows(docs: DataFrame, text: str, width: int, counted: bool, bands: int, rows: int) -> DataFrame:
    """``key`` of each distinct text with words, and the hash of each band of its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_chunks(batches):
            elements, weights, n = weighted(batch.column("text").to_pylist(), width, counted)
            signed = signatures(elements, weights, n, bands * rows).reshape(len(n), bands, rows)
            hashed = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(n), bands))
            for r in range(rows):
                hashed = mix(signed[:, :, r] ^ mix(hashed, 11), 12)
            some = n > 0
            values = pa.array(hashed[some].ravel().view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(some.sum() + 1) * bands, pa.int32()), values)
            yield pa.RecordBatch.from_pydict({"key": batch.column("key").filter(pa.array(some)), "bands": lists})

    keyed = docs.select(text_key(text).alias("key"), F.col(text).alias("text"))
    signed = map_batches(keyed, run, "key binary, bands array<bigint>")
    return signed.groupBy("key").agg(F.first("bands").alias("bands"))


def shingle_rows(docs: DataFrame, keys: DataFrame, text: str, width: int, counted: bool) -> DataFrame:
    """``key`` and distinct shingles of the texts with these keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_chunks(batches):
            found, n = shingles(batch.column("text").to_pylist(), width, counted)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(found.view(np.int64)))
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "shingles": lists})

    keyed = docs.select(text_key(text).alias("key"), F.col(text).alias("text"))
    made = map_batches(having(keyed, keys, "key"), run, "key binary, shingles array<bigint>")
    return made.groupBy("key").agg(F.first("shingles").alias("shingles"))


def verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Pairs whose sets are at least that similar, exactly."""
    one = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    both = pairs.join(two, "b").join(one, "a")
    return both.where(shared >= F.lit(similar) * (F.size("sa") + F.size("sb") - shared) - 1e-9).select("a", "b")


def shingle_counts(sets: DataFrame) -> np.ndarray:
    """How often shingles occur over all sets, by SLOTS counters that several shingles may share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            counts += np.bincount(batch.column("shingles").flatten().to_numpy().view(np.uint64) % np.uint64(SLOTS), minlength=SLOTS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(used, pa.int32()), "n": pa.array(counts[used], pa.int64())})

    summed = map_batches(sets.select("shingles"), run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SLOTS, np.int64)
    counts[summed["slot"]] = summed["n"]  # one row per counter
    return counts


def prefixes(sets: DataFrame, similar: float) -> DataFrame:
    """The rarest shingles of each set (``key``, ``label``, ``shingles``), as many as a set that is similar enough cannot all lack.

    All sets order their shingles alike, rare ones first. Two sets with |x & y| >= similar * |x | y| share a shingle among the
    first |x| - ceil(similar |x|) + 1 of the larger and the first |y| - ceil(2 similar / (1 + similar) |y|) + 1 of the smaller one
    (``narrow``). So sets that have only a common passage do not meet.
    """
    counts = sets.sparkSession.sparkContext.broadcast(shingle_counts(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = counts.value
        for batch in batches:
            lists = batch.column("shingles")
            n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            flat = lists.flatten().to_numpy().view(np.uint64)
            owner = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((flat, common[flat % np.uint64(SLOTS)], owner))
            flat, place = flat[order], ramps(n)
            size = n[owner]
            # a little longer where rounding could make them too short
            keep = place < size - np.ceil(similar * size - 1e-9) + 1
            narrow = place < size - np.ceil(2 * similar / (1 + similar) * size - 1e-9) + 1
            own = owner[keep]
            columns = {"shingle": pa.array(flat[keep].view(np.int64)), "key": batch.column("key").take(pa.array(own)), "label": batch.column("label").take(pa.array(own))}
            yield pa.RecordBatch.from_pydict(columns | {"size": pa.array(size[keep]), "left": pa.array((size - place)[keep]), "narrow": pa.array(narrow[keep])})

    return map_batches(sets.select("key", "label", "shingles"), run, "shingle bigint, key binary, label binary, size bigint, left bigint, narrow boolean")


def meetings(rows: DataFrame, similar: float) -> DataFrame:
    """Pairs (``a``, ``b``) of ``prefixes`` with different labels that may be similar enough.

    At the first shingle that two sets share they can share no more than what is ``left`` of either, that shingle with it; a
    pair for which that is too little is left out there. Whether it meets again further on does not matter.
    """
    groups = stored(rows.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("shingle"))
    rest = stored(rows.join(groups, "shingle", "left_semi"))
    x, y = rest.alias("x"), rest.where("narrow").alias("y")
    longer = F.struct(F.col("x.size"), F.col("x.key")) > F.struct(F.col("y.size"), F.col("y.key"))
    fits = F.col("y.size") >= F.lit(similar) * F.col("x.size") - 1e-9
    enough = F.least("x.left", "y.left") >= F.lit(similar / (1 + similar)) * (F.col("x.size") + F.col("y.size")) - 1e-9
    met = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.label") != F.col("y.label")) & longer & fits & enough)
    return met.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()


def links(docs: DataFrame, text: str = "text", width: int = WIDTH, similar: float = SIMILAR, counted: bool = False, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Components of distinct texts (``key``, ``label``) linked by similarity; texts without a link are left out.

    Texts that share a bucket are candidates. First each is compared with the leader of its bucket, the text that shares
    the most buckets with others. Buckets whose texts are then one component are settled: no further link can matter. The
    texts of all other buckets meet on their rarest shingles (``prefixes``), which loses no pair that is similar enough, and
    those of different components are verified. So copies cost no more than their number, and texts that only have a
    passage in common never meet.
    """
    signed = stored(band_rows(docs, text, width, counted, bands, rows))
    shared = signed.select("key", F.explode("bands").alias("bucket"))
    buckets = stored(shared.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    members = stored(join_groups(shared, buckets, "bucket", "n", "inner"))
    released(signed, buckets)
    # An original shares more buckets with its copies than these do among themselves, so it leads all that it is in.
    company = members.groupBy("key").agg(F.sum("n").alias("company"))
    best = F.max_by("key", F.struct("company", "key")).alias("leader")
    leading = stored(members.join(company, "key").groupBy("bucket").agg(best, F.max("n").alias("n")))
    met = join_groups(members.select("bucket", "key"), leading, "bucket", "n", "inner")
    sets = stored(shingle_rows(docs, stored(members.select("key").distinct()), text, width, counted))
    tested = stored(met.where("key != leader").select(F.least("leader", "key").alias("a"), F.greatest("leader", "key").alias("b")).distinct())
    released(leading)
    labels = components(verified(tested, sets, similar))
    placed = stored(members.join(labels, "key", "left").select("bucket", "key", F.coalesce("label", "key").alias("label")))
    released(members)
    open_ = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("bucket")
    unsettled = stored(placed.join(open_, "bucket", "left_semi").select("key", "label").distinct())
    few = stored(sets.join(unsettled, "key"))
    released(placed)
    fresh = stored(meetings(stored(prefixes(few, similar)), similar).join(tested, ["a", "b"], "left_anti"))
    found = stored(verified(fresh, few, similar))
    if not found.isEmpty():
        labels = joined(labels, found)
    released(sets, tested, unsettled, few, fresh)
    return labels


def classes(docs: DataFrame, id: str, text: str, **options) -> tuple[DataFrame, DataFrame]:
    """Key and id of every row, and of every distinct text its class (``label``), least id and number of rows."""
    rows = stored(docs.select(F.col(f"`{id}`").alias("_tg_id"), text_key(text).alias("key")))
    labels = links(docs, text, **options)
    texts = rows.groupBy("key").agg(F.min("_tg_id").alias("first"), F.count("*").alias("copies"))
    return rows, stored(texts.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key")))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: ``id``, the class it belongs to and how many rows that has.

    A class is named after its least id. Equal texts are one class, null texts count as empty, texts without words are
    alike only if equal. Null ids stay null and never name a class unless it has no other; other columns are ignored.
    """
    rows, texts = classes(docs, id, text, **options)
    named = texts.groupBy("label").agg(F.min("first").alias("class_id"), F.sum("copies").alias("class_rows"), F.count("*").alias("texts"))
    named = join_groups(texts.select("key", "label", "copies"), stored(named), "label", "texts", "inner").drop("label", "texts")
    out = join_groups(rows, stored(named), "key", "copies", "inner")
    return out.select(F.col("_tg_id").alias(id), "class_id", "class_rows")


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class of near duplicates: that with the least id (nulls last), of such with the least text digest.

    If rows repeat both id and text, one of them stays, chosen by a hash of its columns. All columns are kept.
    """
    rows, texts = classes(docs, id, text, **options)
    best = F.min(F.struct(F.col("first").isNull().alias("nameless"), "first", "key")).alias("best")
    keep = texts.groupBy("label").agg(best).select("best.key", F.col("best.first").alias("_tg_id"))
    own = lambda key, id_: F.concat(key, F.coalesce(id_.cast("string"), F.lit("-")).cast("binary"))
    # Which rows go: by far the fewer. Of those that stay, some may still be there twice.
    named = keep.select(own(F.col("key"), F.col("_tg_id")).alias("_tg_row"), F.lit(True).alias("stays"))
    counted = rows.groupBy(own(F.col("key"), F.col("_tg_id")).alias("_tg_row")).agg(F.count("*").alias("n"))
    counted = stored(counted.join(named, "_tg_row", "left"))
    gone = stored(counted.where("stays IS NULL").select("_tg_row"))
    twice = stored(counted.where("stays AND n > 1").select("_tg_row"))
    kept = without(docs.withColumn("_tg_row", own(text_key(text), F.col(f"`{id}`"))), gone, "_tg_row")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if twice.isEmpty():
        return kept.select(*columns)
    one = F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("row")
    again = having(kept, twice, "_tg_row").groupBy("_tg_row").agg(one).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
    return without(kept, twice, "_tg_row").select(*columns).unionByName(again)
