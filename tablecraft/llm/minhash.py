"""Near-duplicate groups by circulant MinHash.

One permutation scatters a document's shingles over ``UNIVERSE`` places, a
second one, shifted by 0, 1, ... K-1 places, gives all K signature coordinates:
coordinate k is the least of ``pi[(sigma(shingle) + k) mod UNIVERSE]``.  Bands
of coordinates name candidates, whose whole shingle sets are then compared.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.common import bitmap_of, in_bitmap, map_texts, mix64, scratch, share, shuffles_freed, space_words, written
from tablecraft.llm.components import components

SHINGLE = 5
#: Similarity to link: 100 * intersection >= PERCENT * union.
PERCENT = 75
UNIVERSE = 1 << 20
#: 56 bands of 5 coordinates: a pair at similarity 0.75 is missed with probability 3e-7.
BANDS, ROWS = 56, 5
#: Word hashes remembered by a worker before it starts afresh.
CACHE_WORDS = 200_000
#: Rounds, at most, of comparing bucket members with one of them; then the exact join of what is left.
LEADER_ROUNDS = 4
#: A round of leaders that merges a smaller share of the open components than this is the last one.
LEAST_MERGED = 0.1
#: Classes of sets for the exact join: each begins at this many times the one before.
CLASS_RATIO = 1.25
#: Longs of 64 bits in which a set notes the hashes of its differences.
NOTES = 4


class _WordHashes(dict):
    """word -> 64-bit hash, computed on first use."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_hashes(words: list[bytes], cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles; fewer words: of the whole sequence."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, n)
    width = min(n, SHINGLE)
    with np.errstate(over="ignore"):
        acc = np.full(n - width + 1, width, np.uint64)
        for i in range(width):
            acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + h[i:n - width + 1 + i])
    return np.unique(acc)


class Circulant:
    """The two permutations and the band keys they give."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 1):
        k = bands * rows
        self.bands, self.rows = bands, rows
        pi = np.random.Generator(np.random.PCG64(seed)).permutation(UNIVERSE).astype(np.uint32)
        # row s of ``windows`` is pi shifted by 0..k-1, read at place s
        self.windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[:k]]), k)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            places = (mix64(shingles * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(44)).astype(np.int64)
        out = None
        for at in range(0, len(places), 256):
            low = self.windows[places[at:at + 256]].min(axis=0)
            out = low if out is None else np.minimum(out, low)
        return out

    def band_keys(self, shingles: np.ndarray) -> np.ndarray:
        sig = self.signature(shingles).reshape(self.bands, self.rows).astype(np.uint64)
        with np.errstate(over="ignore"):
            key = np.arange(self.bands, dtype=np.uint64)
            for i in range(self.rows):
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, i] + np.uint64(1))
        return key.view(np.int64)


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns, ``n_shingles, set_key`` (16 bytes that equal sets share; null for an
    empty set) and ``bands`` (the band keys as packed int64)."""
    def setup():
        circulant, cache = Circulant(bands, rows), _WordHashes()

        def work(texts):
            size, keys, packed = [], [], []
            for text in texts:
                s = shingle_hashes(space_words(text), cache)
                size.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                packed.append(circulant.band_keys(s) if len(s) else [])
            return [size, keys, packed]
        return work

    return map_texts(docs, setup, "n_shingles long, set_key binary, bands array<long>", carry=carry)


def _shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key, shingles`` (packed sorted uint64) of the sets listed in ``wanted`` (columns key, id).

    A fixed-size bitmap of the wanted ids thins the scan; the semi-join decides.
    """
    bitmap = share(docs.sparkSession, bitmap_of(wanted.select(F.xxhash64("id").alias("bit")), "bit"))

    def setup():
        cache, bits = _WordHashes(), bitmap.value

        def work(cells):
            out = [shingle_hashes(space_words(c["text"]), cache).tobytes() if in_bitmap(bits, c["key"]) else None
                   for c in cells]
            return [[xxhash.xxh3_128_digest(x) if x else None for x in out], out, [bool(x) for x in out]]
        return work

    cells = docs.select(F.struct("text", F.xxhash64("doc_id").alias("key")).alias("cell"))
    return (map_texts(cells, setup, "set_key binary, shingles binary, there boolean", carry=(), text="cell", keep=True)
            .select(_set_id().alias("key"), "shingles").join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"]))


def _set_id():
    """The 64-bit name of a shingle set, from its 128-bit digest."""
    return F.xxhash64("set_key")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets pass 100 * intersection >= PERCENT * union.

    A set that stands in very many pairs is salted: it is repeated once per
    thousand of its pairs, and they are spread over the copies.
    """
    load = written(pairs.groupBy("a").agg(F.count("*").alias("n"))
                   .select("a", F.ceil(F.col("n") / 1000).cast("int").alias("salts")), "load")
    left = (sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")).join(load, "a")
            .select("a", "x", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))
    salted = pairs.join(load, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
    both = (salted.join(left, ["a", "salt"]).join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")
            .select("a", "b", F.struct("x", "y").alias("cell")))

    def setup():
        def work(cells):
            out = []
            for c in cells:
                x, y = np.frombuffer(c["x"], np.uint64), np.frombuffer(c["y"], np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                common = int((large[at] == small).sum()) if len(large) else 0
                out.append(common > 0 and 100 * common >= PERCENT * (len(x) + len(y) - common))
            return [out]
        return work

    return map_texts(both, setup, "linked boolean", carry=("a", "b"), text="cell", keep=True)


def _leaders(slots: DataFrame, turn: int) -> DataFrame:
    """``band, l``: the leader (by a hash that changes with ``turn``) of every bucket that holds several components."""
    return slots.groupBy("band").agg(
        F.min(F.struct(F.xxhash64("key", F.lit(turn)).alias("o"), "key", "n", "comp")).alias("l"),
        F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("band", "l")


def _led_pairs(slots: DataFrame, turn: int) -> DataFrame:
    """The leader of every bucket against its members of other components."""
    return (slots.join(written(_leaders(slots, turn), "leaders"), "band").filter(f"comp <> l.comp AND {_near('n', 'l.n')}")
            .select(F.least("key", "l.key").alias("a"), F.greatest("key", "l.key").alias("b")).distinct())


def _near(n: str, m: str) -> str:
    """Sizes further apart than PERCENT cannot link."""
    return f"least({n}, {m}) * 100 >= greatest({n}, {m}) * {PERCENT}"


def _mixed(slots: DataFrame) -> DataFrame:
    """The slots of buckets that hold several components."""
    mixed = slots.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("band")
    return written(slots.join(written(mixed, "mixed"), "band", "left_semi"), "slots")


def _note_names() -> list[str]:
    return [f"note{i}" for i in range(NOTES)]


def _unshared(other: str, own: str) -> str:
    """SQL: a set has at least so many differences that the other one has not, by their notes."""
    return "(" + " + ".join(f"bit_count({n}{own} & ~{n}{other})" for n in _note_names()) + ")"


def _features(slots: DataFrame, sets: DataFrame) -> DataFrame:
    """Every set of the open buckets as its differences from what its group has in common.

    A group is what buckets hold together; its core are the shingles that more
    than half of its sets have.  One row per set: ``key, n, comp, g, core`` (size
    of the core), ``missing`` (core shingles that it lacks) and ``shared``: the
    differences that another set of the group has too, core shingles that both
    lack among them, as (number of sets, name), rarest first, and their hashes' bits.
    """
    stars = (slots.join(written(_leaders(slots, LEADER_ROUNDS), "leaders"), "band").filter("key <> l.key")
             .select(F.col("key").alias("a"), F.col("l.key").alias("b")).distinct())
    groups = written(components(stars).select(F.col("id").alias("key"), F.col("component_id").alias("g")), "groups")
    opened = slots.select("key", "n", "comp").distinct().join(groups, "key")
    opened = written(opened.join(sets, "key"), "open")

    def unpack():
        return lambda packed: [[np.frombuffer(x, np.int64) for x in packed]]

    often = written(map_texts(opened, unpack, "s array<long>", carry=("g",), text="shingles").select("g", F.explode("s").alias("s"))
                    .groupBy("g", "s").agg(F.count("*").alias("df")).filter("df > 1"), "often")
    sizes = groups.groupBy("g").agg(F.count("*").alias("m"))
    cores = written(often.join(sizes, "g").filter("2 * df > m").groupBy("g")
                    .agg(F.array_sort(F.collect_list(F.struct("s", (F.col("m") - F.col("df")).alias("lack")))).alias("core")), "cores")

    def differ():
        def work(cells):
            lacks, extras, missing = [], [], []
            for c in cells:
                own = np.frombuffer(c["shingles"], np.int64)
                core = c["core"] or []
                names = np.fromiter((x["s"] for x in core), np.int64, len(core))
                there = np.isin(names, own)
                # a core shingle that nobody else lacks cannot be a shared difference
                lacks.append([(x["lack"], x["s"]) for x, has in zip(core, there.tolist(), strict=True) if not has and x["lack"] > 1])
                extras.append(own[~np.isin(own, names)])
                missing.append(len(core) - int(there.sum()))
            return [missing, lacks, extras]
        return work

    cells = opened.join(cores, "g", "left").select(
        "key", "n", "comp", "g", F.coalesce(F.size("core"), F.lit(0)).alias("core"), F.struct("shingles", "core").alias("cell"))
    rows = written(map_texts(cells, differ, "missing long, lacks array<struct<df:long,s:long>>, extras array<long>",
                             carry=("key", "n", "comp", "g", "core"), text="cell"), "differences")
    named = (rows.select("g", "key", F.explode("extras").alias("s")).join(often, ["g", "s"]).select("key", "df", F.col("s").alias("f"))
             .unionByName(rows.select("key", F.explode("lacks").alias("l")).select("key", "l.df", F.xxhash64("l.s", F.lit("lacks")).alias("f"))))
    notes = [F.expr(f"bit_or(IF(pmod(f, {64 * NOTES}) DIV 64 = {i}, shiftleft(1L, CAST(pmod(f, 64) AS INT)), 0L))").alias(f"note{i}") for i in range(NOTES)]
    shared = named.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("df", "f"))).alias("shared"), *notes)
    return rows.drop("lacks", "extras").join(shared, "key", "left").withColumns(
        {"shared": F.coalesce("shared", F.array().cast("array<struct<df:long,f:long>>"))} | {n: F.coalesce(n, F.lit(0)) for n in _note_names()})


def _remaining_pairs(slots: DataFrame, sets: DataFrame) -> DataFrame:
    """Every pair across components that may still link, of sets in buckets of several components.

    Exact prefix filtering on differences.  Sets a, b with ``lack`` core
    shingles missing share |core| - lack_a - lack_b shingles and one more for
    each difference they have in common, so they link if and only if these are
    at least e_a + e_b, with e = P n / (100 + P) + lack - |core| / 2.  Hence
    either e_a + e_b <= 0: then both link with the set of the least e in their
    group, which one pair each shows.  Or, of c differences that others have,
    one of the c - (e_a + e_b) + 1 rarest is common.  The set of the smaller e
    is listed under its class of e, the other under every class from its own
    down, by the least e of the class.  Bits of their differences' hashes then
    bound what two sets can have in common, which leaves few pairs that do not
    link: copies of one text that differ at random are hardly ever compared.
    """
    whole = 100 + PERCENT
    rows = _features(slots, sets)
    e = F.col("n") * 2 * PERCENT + F.col("missing") * 2 * whole - F.col("core") * whole  # 2 (100 + P) e, a whole number
    step = np.log(CLASS_RATIO)
    unit = 2 * whole
    rows = written(rows.withColumn("e", e).withColumn("c", F.size("shared"))
                   .withColumn("class", F.when(F.col("e") < unit, 0).otherwise(F.floor(F.log(F.col("e") / unit) / step) + 1).cast("int")), "features")

    least = written(rows.groupBy("g").agg(F.min(F.struct("e", "key", "comp", "n")).alias("l")), "centres")
    sure = (rows.join(least, "g").filter("e + l.e <= 0 AND comp <> l.comp")
            .select(F.least("key", "l.key").alias("a"), F.greatest("key", "l.key").alias("b")))

    def prefix(need):
        """Of the differences, those of which linked sets must share one: all but ``need - 1`` of the commonest."""
        return F.slice("shared", F.lit(1), F.greatest(F.lit(0), F.col("c") - F.greatest(F.lit(1), F.ceil(need / unit)).cast("int") + 1))

    def listed(df):
        return df.select("g", "class", "key", "n", "comp", "e", "c", *_note_names(), F.posexplode("tokens").alias("at", "t")).select(
            "g", "class", F.col("t.f").alias("f"), "key", "n", "comp", "e", "c", (F.col("c") - F.col("at")).alias("left"), *_note_names())

    small = listed(rows.withColumn("tokens", prefix(F.col("e") * 2)))
    # a partner has at least PERCENT of n shingles, so its e is no less than this
    low = F.floor(F.col("n") * PERCENT / 100) * 2 * PERCENT - F.col("core") * whole
    low_class = F.when(low < unit, 0).otherwise(F.floor(F.log(low / unit) / step)).cast("int")
    start = F.when(F.col("class") == 0, F.greatest(low, F.col("l.e"))).otherwise(F.floor(F.lit(unit) * F.pow(F.lit(CLASS_RATIO), F.col("class") - 1)) - 1)
    large = listed(rows.join(least, "g").withColumn("class", F.explode(F.sequence(F.least(low_class, "class"), "class")))
                   .withColumn("tokens", prefix(F.col("e") + start)))
    large = large.select("g", "class", "f", *[F.col(x).alias(f"{x}2") for x in ("key", "n", "comp", "e", "c", "left", *_note_names())])
    on = ["g", "class", "f"]
    found = (written(small, "prefixes").join(written(large, "prefixes"), on)
             .filter(f"(e < e2 OR (e = e2 AND key < key2)) AND comp <> comp2 AND {_near('n', 'n2')} AND least(left, left2) * {unit} >= e + e2 "
                     f"AND least(c - {_unshared('2', '')}, c2 - {_unshared('', '2')}) * {unit} >= e + e2")
             .select(F.least("key", "key2").alias("a"), F.greatest("key", "key2").alias("b")).distinct())
    return found.unionByName(sure).distinct()


def _components_of_sets(docs: DataFrame, made: DataFrame) -> DataFrame:
    """``set_key, component_id``: the least document id that a shingle set's documents can reach."""
    named = made.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = written(named.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"))
                      .withColumn("key", _set_id()), "classes")
    reps = (classes.join(named.select("set_key", F.col("doc_id").alias("id"), "bands"), ["set_key", "id"])
            .dropDuplicates(["key"]).select("key", "n", F.explode("bands").alias("band")))
    slots = written(reps, "bands")
    # buckets of one class can link nothing
    shared = slots.groupBy("band").agg(F.count("*").alias("in_band")).filter("in_band > 1").select("band")
    slots = written(slots.join(written(shared, "shared"), "band").withColumn("comp", F.col("key")), "slots")
    wanted = written(slots.select("key").distinct().join(classes.select("key", "id"), "key"), "wanted")
    sets = written(_shingle_sets(docs, wanted), "sets")

    links, few = [], False
    for turn in range(LEADER_ROUNDS + 1):
        last = turn == LEADER_ROUNDS or few
        with scratch(docs.sparkSession) as kept:
            kept.update(("links", "slots"))
            pairs = _remaining_pairs(slots, sets) if last else _led_pairs(slots, turn)
            links.append(written(_confirmed(written(pairs, "pairs"), sets), "links"))
            if last:
                break
            merged = written(slots.select("key", "comp").distinct(), "members")
            ends = (links[-1].join(merged.select(F.col("key").alias("a"), F.col("comp").alias("x")), "a")
                    .join(merged.select(F.col("key").alias("b"), F.col("comp").alias("y")), "b"))
            joined = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")))
            joined = written(joined.filter("id <> component_id").select(F.col("id").alias("comp"), "component_id"), "joined")
            few = joined.count() < LEAST_MERGED * merged.select("comp").distinct().count()
            slots = _mixed(slots.join(joined, "comp", "left")
                           .select("key", "n", "band", F.coalesce("component_id", "comp").alias("comp")))
            if slots.isEmpty():
                break
    everything = links[0]
    for more in links[1:]:
        everything = everything.unionByName(more)
    found = written(classes.join(components(everything).select(F.col("id").alias("key"), F.col("component_id").alias("comp")), "key", "left")
                    .select("set_key", "id", F.coalesce("comp", "key").alias("comp")), "found")
    least = written(found.groupBy("comp").agg(F.min("id").alias("component_id")), "least")
    return written(found.join(least, "comp").select("set_key", "component_id"), "components")


def near_groups(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``; other ``carry`` columns follow the id.

    Equal shingle sets are one class (a grouped minimum), so a large group of
    copies is one node.  Classes are banded; in each band bucket one class is
    compared with the others, links are merged into components, and the next
    round looks only at buckets that still hold more than one component, until
    a round merges few (or after ``LEADER_ROUNDS``).  An exact prefix-filter
    join on the differences within what is left finds every other link.

    Null and blank texts have the empty set and stay alone.  Null ids stay
    alone too, with a null component, and are kept.  Rows that repeat an id
    and text share its component; an id that stands with several texts has a
    row for each, and all their links count.  Other columns of ``docs`` are not
    looked at.
    """
    made = written(sketches(docs, bands, rows, carry), "sketches")
    with scratch(docs.sparkSession) as kept, shuffles_freed(docs.sparkSession):
        kept.add("components")
        found = _components_of_sets(docs.select("doc_id", "text"), made)
    return (made.select(*carry, "n_shingles", "set_key").join(found, "set_key", "left")
            .select(*carry, "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
