"""SimHash fingerprints by pivot distance tables, and near duplicates by shingle sets.

A fingerprint has one or more 64-bit lanes. For every fingerprint the Hamming distances to a fixed
set of reference fingerprints, the pivots, are computed once. A pair whose distances to any one
pivot differ by more than the wanted distance cannot be close (triangle inequality), so such pairs
are discarded before the survivors are compared bit by bit.

Which pairs are looked at: two ways, both by equal keys.
* ``close_links`` (one lane, small even distance d) misses nothing: the 64 bits are cut into d + 2
  blocks, of which a close pair shares at least two entirely; every two blocks make a key. A key
  with more than ``BUCKET`` fingerprints is not paired out: each of its members is filed under all
  fingerprints within d/2 bits of itself, and two fingerprints share such a place exactly when
  they are within d bits. Linking each to the smallest of its place keeps the components.
* ``near_duplicates`` (four lanes over the distinct shingles, ``bit_limit``) proposes by rare
  shingles, as blocks of bits miss pairs so far apart: of two sets alike to s, each of n shingles,
  one of the n - ceil(s n) + 1 rarest of the first is among those of the second (in any one order of
  all shingles), and these are the keys. Pairs that share too few keys are dropped, then those whose
  pivots or bits are too far apart, and the sets of the survivors are compared. The members of a
  crowded key are dealt over blocks, and tasks search all pairs of two blocks, by pivots, bits and
  sets again, for links with the same components.

Defined results: a null or empty text has fingerprint zero; fewer words than a shingle count as one
shingle; repeated rows share a component; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import random
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import connected_components, drop_staged, free_name, id_and_text, staged, texts
from tallyhouse.llm.repeats import longs, per_document, word_symbols
from tallyhouse.llm.rolling import Rolling, mix

BUCKET = 32
PIVOTS = 12
SEED = 42
CHUNK = 1 << 15
BUCKETS = 1 << 18  # of shingles, counted to order them by rarity
BLOCK = 1 << 21  # shingles of a block of a crowded key
LANES = 4  # of the fingerprints of shingle sets


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words of a lower-cased text; words are joined by one space."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    first = np.concatenate(([0], ends[:-1] + 1))[: len(last)]
    digest = xxhash.xxh64_intdigest
    hashes = (digest(joined[a:b], SEED) for a, b in zip(first.tolist(), last.tolist(), strict=True))
    return np.fromiter(hashes, np.uint64, len(last))


def _lane(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Lane 0 is the hash itself; further lanes mix it anew."""
    if not lane:
        return hashes
    mixed = hashes + np.uint64(lane * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    mixed = (mixed ^ mixed >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ mixed >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return mixed ^ mixed >> np.uint64(31)


def simhash(hashes: np.ndarray, lanes: int = 1) -> list[int]:
    """Per lane, the bits set in more than half of the hashes, as signed 64-bit numbers."""
    result = []
    for lane in range(lanes):
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), CHUNK):
            octets = _lane(hashes[at : at + CHUNK], lane).astype("<u8").view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
        bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
        result.append(int(bits.view("<i8")[0]))
    return result


def fingerprints(docs: DataFrame, shingle: int = 3, lanes: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every whole text; ``fp`` is an array of ``lanes`` longs."""

    def compute(batches):
        for batch in batches:
            found = [simhash(shingle_hashes(text, shingle), lanes) for _, text in texts(batch)]
            column = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), column], ["id", "fp"])

    source = id_and_text(docs, id_col, text_col)
    return source.mapInArrow(compute, f"id {source.schema['id'].dataType.simpleString()}, fp array<long>")


def _pivots(lanes: int) -> list[list[int]]:
    draw = random.Random(SEED)
    return [[_signed(draw.getrandbits(64)) for _ in range(lanes)] for _ in range(PIVOTS)]


def _distance(a: Column, b: Column | list[int], lanes: int) -> Column:
    other = (lambda i: F.lit(b[i])) if isinstance(b, list) else b.getItem
    return reduce(Column.__add__, [F.bit_count(a.getItem(i).bitwiseXOR(other(i))) for i in range(lanes)])


def pivot_table(fps: DataFrame, lanes: int) -> DataFrame:
    """``fps`` with ``pivots``: the distances of ``fp`` to every pivot."""
    return fps.withColumn("pivots", F.array(*[_distance(F.col("fp"), p, lanes) for p in _pivots(lanes)]))


def close(a: str, b: str, lanes: int, distance: int) -> Column:
    """Discard by the largest coordinate difference, then compare the bits."""
    gaps = [F.abs(F.col(f"{a}.pivots")[i] - F.col(f"{b}.pivots")[i]) for i in range(PIVOTS)]
    return F.when(F.greatest(*gaps) > distance, False).otherwise(
        _distance(F.col(f"{a}.fp"), F.col(f"{b}.fp"), lanes) <= distance
    )


def _keyed(table: DataFrame, keys: list[Column]) -> DataFrame:
    """(k, v, f): one row per fingerprint, whose short name is f, and key."""
    entries = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), key.alias("v")) for i, key in enumerate(keys)]))
    return table.select("f", entries.alias("key")).select("key.k", "key.v", "f")


def _survivors(pairs: DataFrame, table: DataFrame, lanes: int, distance: int) -> DataFrame:
    """Pairs (a, b) of short names whose pivots and bits allow it, with their fingerprints (x.fp, y.fp)."""
    side = lambda name, x: table.select(F.col("f").alias(name), F.struct("fp", "pivots").alias(x))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").where(close("x", "y", lanes, distance))


def _pairs(keyed: DataFrame, small: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of short names that share a key of ``small``."""
    rows = keyed.join(small, ["k", "v"])
    pairs = rows.withColumnRenamed("f", "a").join(rows.withColumnRenamed("f", "b"), ["k", "v"]).where("a < b")
    return pairs.select("a", "b").distinct()


def _named(fps: DataFrame, lanes: int) -> DataFrame:
    return pivot_table(fps.withColumn("f", F.xxhash64("fp")), lanes)


def _neighbour_masks(radius: int) -> list[int]:
    masks = [0]
    for size in range(1, radius + 1):
        masks += [_signed(sum(1 << i for i in bits)) for bits in combinations(range(64), size)]
    return masks


def close_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``distance`` bits; fps are distinct, one lane."""
    if distance % 2:
        raise ValueError("the distance must be even")
    blocks = distance + 2
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    mask = lambda i: (1 << edges[i + 1]) - (1 << edges[i])
    one = F.col("fp").getItem(0)
    keys = [one.bitwiseAND(_signed(mask(i) | mask(j))) for i, j in combinations(range(blocks), 2)]
    table = _named(fps, 1)
    keyed = _keyed(table, keys)
    sizes = staged(keyed.groupBy("k", "v").count().where("count > 1"), "simhash-keys")
    pairs = _pairs(keyed, sizes.where(F.col("count") <= BUCKET).select("k", "v"))
    links = _survivors(pairs, table, 1, distance).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    crowded = keyed.join(sizes.where(F.col("count") > BUCKET).select("k", "v"), ["k", "v"], "left_semi").select("f").distinct()
    crowded = table.join(crowded, "f").select("fp")
    places = F.explode(F.array(*[F.lit(m) for m in _neighbour_masks(distance // 2)]))
    near = crowded.withColumn("mask", places).select("fp", F.col("fp").getItem(0).bitwiseXOR(F.col("mask")).alias("place"))
    least = near.groupBy("place").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("place", "least")
    stars = near.join(least, "place").where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    return links.union(stars)


def _components(rows: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, fp, component) of ``rows`` (id, fp): the smallest id of the fingerprints that links join."""
    groups = connected_components(classes.select(F.col("fp").alias("node")), links)
    groups = staged(groups.withColumnRenamed("node", "fp").join(classes, "fp"), "simhash-groups")
    least = groups.groupBy("component").agg(F.min("least_id").alias("least"))
    named = groups.join(least, "component").select("fp", F.col("least").alias("component"))
    return rows.join(named, "fp").select("id", "fp", "component")


def simhash_components(docs: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component): the smallest id reachable over links of at most ``distance`` bits, for every row."""
    rows = staged(fingerprints(docs, shingle, 1, id_col, text_col), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("id").alias("least_id"))
    return _components(rows, classes, close_links(classes.select("fp"), distance))


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of every run of ``shingle`` words of a lower-cased text; fewer words are one run."""
    symbols = word_symbols(text.lower()).symbols
    return np.unique(mix(Rolling(symbols).all(min(shingle, max(len(symbols), 1)))))


def bit_limit(similarity: float, bits: int) -> int:
    """The distance that the fingerprints of two sets alike to ``similarity`` exceed with a chance below 2^-64.

    A bit of large sets differs with chance arccos(2s / (1 + s)) / pi. Small sets, whose majorities tie, come
    up to sqrt(pi / 2) times that; Chernoff's bound does the rest.
    """
    share = math.acos(2 * similarity / (1 + similarity)) / math.sqrt(2 * math.pi)
    for limit in range(math.ceil(share * bits), bits - 1):
        x = (limit + 1) / bits
        if share == 0 or bits * (x * math.log(x / share) + (1 - x) * math.log((1 - x) / (1 - share))) >= 64 * math.log(2):
            return limit
    return bits


def _set_name(found: np.ndarray) -> int:
    return _signed(xxhash.xxh3_64_intdigest(found.tobytes()))


def _at_least(share: float, n):
    """The least whole number that is no smaller than ``share * n``."""
    return np.ceil(share * n - 1e-9).astype(np.int64)


def _named_sets(source: DataFrame, shingle: int) -> DataFrame:
    """(id, f, fp) of every row, f naming its shingle set; and (bucket, c), in how many texts of a task a bucket of shingles is."""

    def compute(batches):
        counts = np.zeros(BUCKETS, np.int64)
        names = ["id", "f", "fp", "bucket", "c"]
        kinds = [None, pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
        nulls = lambda n, kinds: [pa.nulls(n, kind) for kind in kinds]
        for batch in batches:
            kinds[0], f, fp = batch.schema.field("id").type, [], []
            for _, text in texts(batch):
                found = shingle_set(text, shingle)
                f.append(_set_name(found))
                fp.append(simhash(found, LANES))
                np.add.at(counts, found & np.uint64(BUCKETS - 1), 1)
            columns = [batch.column("id"), pa.array(f, kinds[1]), pa.array(fp, kinds[2]), *nulls(len(f), kinds[3:])]
            yield pa.RecordBatch.from_arrays(columns, names)
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays([*nulls(len(used), kinds[:3]), *longs(used, counts[used])], names)

    id_type = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(compute, f"id {id_type}, f long, fp array<long>, bucket long, c long")


def _prefix_keys(source: DataFrame, shingle: int, similarity: float, counts: np.ndarray) -> DataFrame:
    """(key, f, size): of each set the rarest shingles, one of which any set alike to it has among its own rarest."""
    shared = source.sparkSession.sparkContext.broadcast(counts)

    def compute(batches):
        done = set()

        def keys(row):
            found = shingle_set(row["text"] or b"", shingle)
            name, n = _set_name(found), len(found)
            if not n or name in done:
                return None
            done.add(name)
            rarest = np.lexsort((found, shared.value[found & np.uint64(BUCKETS - 1)]))
            taken = found[rarest[: n - int(_at_least(similarity, n)) + 1]]
            return taken, np.full(len(taken), name, np.int64), np.full(len(taken), n)

        yield from per_document(batches, keys, ["key", "f", "size"], [])

    return source.mapInArrow(compute, "key long, f long, size long")


def _prefix_pairs(members: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs (a, b) that share a key of at most ``BUCKET`` sets, less those that share too few for the similarity.

    A set of n shingles has its r = ceil(s n) - 1 commonest ones outside its keys. Of two sets, whatever
    they share beyond their common keys lies among the r commonest of one of them.
    """
    small = members.where(F.col("n") <= BUCKET)
    side = lambda x: small.select("key", F.col("f").alias(x), F.col("size").alias(f"{x}_size"))
    sizes = [F.least("a_size", "b_size"), F.greatest("a_size", "b_size")]
    pairs = side("a").join(side("b"), "key").where("a < b").where(sizes[0] >= F.lit(similarity) * sizes[1] - 1e-9)
    pairs = pairs.groupBy("a", "b", "a_size", "b_size").agg(F.count(F.lit(1)).alias("m"))
    crowded = members.where(F.col("n") > BUCKET).groupBy("f").agg(F.count(F.lit(1)).alias("more"))
    for x in ("a", "b"):
        pairs = pairs.join(crowded.select(F.col("f").alias(x), F.col("more").alias(f"{x}_more")), x, "left")
    unseen = F.least(F.coalesce("a_more", F.lit(0)), F.coalesce("b_more", F.lit(0)))
    needed = F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("a_size") + F.col("b_size")) - 1e-6)
    outside = F.ceil(F.lit(similarity) * sizes[1] - 1e-6) - 1
    return pairs.where(F.col("m") + unseen >= needed - outside).select("a", "b")


def _crowded_units(members: DataFrame) -> DataFrame:
    """(key, i, j, f): the sets of a key of more than ``BUCKET``, cut into blocks, every two of which make a unit.

    Keys with the same members count once. A unit holds about 2 ``BLOCK`` shingles, whatever the key has.
    """
    crowded = members.where(F.col("n") > BUCKET)
    h = F.xxhash64("f")
    low, high = F.sum(h.bitwiseAND((1 << 31) - 1)), F.sum(F.shiftrightunsigned(h, 33))
    keys = crowded.groupBy("key").agg(low.alias("low"), high.alias("high"), F.count(F.lit(1)).alias("of"))
    keys = keys.groupBy("low", "high", "of").agg(F.min("key").alias("key")).select("key")
    blocks = F.ceil(F.col("total") / BLOCK).cast("long")
    dealt = crowded.join(keys, "key").select("key", "f", blocks.alias("blocks"), F.pmod(F.xxhash64("f", F.lit(SEED)), blocks).alias("own"))
    other = dealt.select("key", "f", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    return other.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "f")


def spanning_links(
    sets: list[np.ndarray], fps: np.ndarray, pivots: np.ndarray, similarity: float, distance: int
) -> list[tuple[int, int]]:
    """Links between places of alike sets whose components are those of all alike pairs; no set is empty.

    Each set that was reached is compared with all that were not, so a group alike to one member takes a step or
    two: their pivots first, then the bits of those that remain (``fps``, unsigned), then their sets.
    """
    sizes = np.array(list(map(len, sets)))
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    of = np.split(ids, np.cumsum(sizes)[:-1])
    mark = np.zeros(int(ids.max()) + 1, bool)
    left, links, reached = np.arange(len(sets)), [], []
    while len(left):
        if not reached:
            reached.append(int(left[0]))
            left = left[1:]
            continue
        hub = reached.pop()
        near = left[np.abs(pivots[left] - pivots[hub]).max(axis=1) <= distance]
        near = near[np.bitwise_count(fps[near] ^ fps[hub]).sum(axis=1) <= distance]
        if len(near):
            starts = np.cumsum(sizes[near]) - sizes[near]
            mark[of[hub]] = True
            common = np.add.reduceat(mark[np.concatenate([of[other] for other in near])], starts, dtype=np.int64)
            mark[of[hub]] = False
            near = near[common >= similarity * (sizes[hub] + sizes[near] - common) - 1e-9]
            left = np.setdiff1d(left, near, assume_unique=True)
            links += [(hub, other) for other in near.tolist()]
            reached += near.tolist()
    return links


def _crowded_links(units: DataFrame, sets: DataFrame, table: DataFrame, similarity: float, distance: int) -> DataFrame:
    """(a, b): links that keep the components of every unit; the pairs are looked at inside the tasks."""
    unit, columns = ["key", "i", "j"], ["f", "shingles", "fp", "pivots"]
    rows = units.join(sets.join(table, "f"), "f").select(*unit, *columns).repartition(*unit).sortWithinPartitions(*unit)

    def compute(batches):
        now, held = None, {}

        def links():
            names, found = list(held), []
            if len(names) > 1:
                sets, fps, pivots = zip(*held.values(), strict=True)
                sets = [np.frombuffer(x, np.uint64) for x in sets]
                found = spanning_links(sets, np.array(fps, np.int64).view(np.uint64), np.array(pivots, np.int64), similarity, distance)
            ends = [pa.array([names[link[x]] for link in found], pa.int64()) for x in (0, 1)]
            return pa.RecordBatch.from_arrays(ends, ["a", "b"])

        for batch in batches:
            for *at, f, shingles, fp, pivots in zip(*[batch.column(c) for c in unit + columns], strict=True):
                at = [x.as_py() for x in at]
                if at != now:
                    if held:
                        yield links()
                    now, held = at, {}
                held[f.as_py()] = shingles.as_py(), fp.as_py(), pivots.as_py()
        if held:
            yield links()

    return rows.mapInArrow(compute, "a long, b long")


def _shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(f, shingles): the sorted hashes of every distinct shingle."""

    def compute(batches):
        for batch in batches:
            found = [shingle_set(text, shingle) for _, text in texts(batch)]
            columns = [pa.array(map(_set_name, found), pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["f", "shingles"])

    return docs.mapInArrow(compute, "f long, shingles binary").dropDuplicates(["f"])


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose shingle sets have the Jaccard similarity."""
    side = lambda name: sets.select(F.col("f").alias(name), F.col("shingles").alias(f"{name}_set"))

    def compute(batches):
        for batch in batches:
            near = []
            for a, b in zip(batch.column("a_set"), batch.column("b_set"), strict=True):
                a, b = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                near.append(common >= similarity * (len(a) + len(b) - common) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_set", "b_set")
    return joined.mapInArrow(compute, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component) of texts whose sets of word shingles are alike to ``similarity`` or more.

    ``fp`` names the set, so rows with one ``fp`` are alike. All alike pairs are found, or others that join the same rows;
    a SimHash loses one with a chance below 2^-64 (``bit_limit``).
    """
    limit = bit_limit(similarity, 64 * LANES)
    source = id_and_text(docs, id_col, text_col)
    described = staged(_named_sets(source, shingle), "shingle-names")
    named = described.where("bucket is null")
    rows = named.select("id", F.array("f").alias("fp"))
    table = staged(pivot_table(named.groupBy("f").agg(F.first("fp").alias("fp")), LANES), "near-pivots")
    classes = staged(rows.groupBy("fp").agg(F.min("id").alias("least_id")), "shingle-classes")
    seen = described.where("bucket is not null").groupBy("bucket").agg(F.sum("c").alias("c")).toArrow()  # BUCKETS rows at most
    counts = np.zeros(BUCKETS, np.int64)
    counts[seen.column("bucket").to_numpy()] = seen.column("c").to_numpy()
    keys = staged(_prefix_keys(source, shingle, similarity, counts), "prefix-keys")
    ends = [F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), F.min("f").alias("low"), F.max("f").alias("high")]
    shared = staged(keys.groupBy("key").agg(*ends).where("low <> high").select("key", "n", "total"), "prefix-shared")
    members = staged(keys.join(shared, "key"), "prefix-members")
    drop_staged(keys)
    pairs = staged(_survivors(_prefix_pairs(members, similarity), table, LANES, limit).select("a", "b"), "near-pairs")
    units = staged(_crowded_units(members), "crowded-units")
    asked = pairs.select(F.col("a").alias("f")).union(pairs.select(F.col("b").alias("f"))).union(units.select("f")).distinct()
    wanted = classes.join(asked.select(F.array("f").alias("fp")), "fp").select(F.col("least_id").alias("wanted")).distinct()
    texts_of = source.join(wanted, source["id"].eqNullSafe(wanted["wanted"]), "left_semi")
    sets = staged(_shingle_sets(texts_of, shingle), "shingle-sets")
    links = _alike(pairs, sets, similarity).union(_crowded_links(units, sets, table, similarity, limit))
    return _components(rows, classes, links.select(F.array("a").alias("a"), F.array("b").alias("b")))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group of near duplicates the rows of the smallest id, with all their columns."""
    groups = near_duplicates(docs, shingle, id_col=id_col, text_col=text_col)
    key = free_name(docs, "_id")
    gone = groups.where(~F.col("id").eqNullSafe(F.col("component"))).select(F.col("id").alias(key)).distinct()
    return docs.join(staged(gone, "near-duplicates"), F.col(id_col).eqNullSafe(F.col(key)), "left_anti")
