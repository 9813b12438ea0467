"""Documents whose sets of word n-grams overlap, by T-occurrence search.

Documents with equal sets are one class, told by 64 bits of a digest. A partner of a class of n
shingles shares at least 3n/4 of them (at similarity 0.75), and a partner that is not smaller at least 6n/7. So in any
order that all agree on, the first n - 6n/7 + 1 shingles of the smaller partner and the first n - 3n/4 + 1
of the larger one have one in common. The order puts frequent shingles last, as far as a bounded
list of them (``FREQUENT``) goes, and is arbitrary else. These first shingles are shuffled; those that two
classes share say who must be compared.

Each class is at home in the cell of one of its shared shingles in the first 1/7, and visits the cells where a
class lives that is not larger and has one of the visitor's first shingles there. Bit maps of the sets then bound each overlap from above: a shingle whose bit the other
set lacks is not shared. Classes that no bound lets through leave the cell, so that sets are
read for few documents. In a cell the sets of its classes are an inverted index, and every other class there is
a query: DivideSkip sets the longest lists aside, merges the short ones to find the classes that
occur often enough for the rest to suffice, and looks those up in the long ones by binary search, until each
class that reaches the overlap for its own size is known or already connected.

A cell is cut into blocks of bounded size. A group of near copies that fills many blocks is linked inside each
block first, and through the cell's first class; after that only classes of different components
still meet, so that a large group costs as much as its rows and not their square. Links of a group are
reduced to a spanning forest before they leave it. Components come from joins over written tables.

Defined results: A-Z are lower-cased, nothing else. A text of fewer words than n is one shingle; null and wordless
texts have none and stay alone, also if their ids repeat. A row without id has its class's component, or null.
An empty table gives no rows. A text of any length is read whole; one text and its set have to fit a task. Columns beyond the
two named ones are ignored, whatever their names; ``representatives`` returns them as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import connected_components
from tallyloom.llm.tables import written

N = 5
#: Similarity in hundredths.
SIMILARITY = 75
#: Shingles in the list of frequent ones, and the count from which they can be there. Any list is right.
FREQUENT = 1 << 18
FREQUENT_FROM = 16
#: Shingles in a block of a cell, or in a set of its queries.
BLOCK = 1 << 20
MU = 0.0085
_LAST = 1 << 62
_FIRST = "shingle long, class long, leading long"
_CLASSIFIED = "doc_id long, n_shingles long, class long, shingle long, classes long, bits binary"


def shingle_sets(column: pa.Array, n: int = N) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, as numbers of 62 bits."""
    from tallyloom.llm.words import LOWER, gram_hashes, sequence_hash, word_hashes

    words, bounds = word_hashes(column, LOWER)
    grams = (gram_hashes(words, n) >> np.uint64(2)).astype(np.int64)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= n:
            sets.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            sets.append(np.array([sequence_hash(words[a:b]) >> np.uint64(2)]).astype(np.int64))
        else:
            sets.append(np.zeros(0, dtype=np.int64))
    return sets


def _class(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _parts(batches: Iterator[pa.RecordBatch], n: int):
    from tallyloom.llm.words import slices

    for batch in batches:
        for part in slices(batch, "text"):
            yield batch, part, shingle_sets(part.column("text"), n)


def _batch(names: list[str], *columns: list | np.ndarray) -> pa.RecordBatch:
    kinds = [pa.binary() if name == "bits" else pa.int64() for name in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def bit_map(shingles: np.ndarray) -> bytes:
    """The set's shingles by their low bits, in the next power of two above four bits a shingle."""
    width = 1 << max(6, int(4 * len(shingles) - 1).bit_length())
    bits = np.zeros(width, dtype=bool)
    bits[shingles & (width - 1)] = True
    return np.packbits(bits).tobytes()


def _folded(bits: np.ndarray) -> np.ndarray:
    """Bit maps in half the width."""
    half = bits.shape[1] // 2
    return bits[:, :half] | bits[:, half:]


_NARROW = 1024
_AT_ONCE = 256


class BitMaps:
    """Bit maps of sets, to bound overlaps from above.

    Maps of up to ``_NARROW`` bits are compared as products of 0/1 matrices, many queries at a time; wider ones, of which a
    group holds few, one query at a time. Sets of one width are sorted by size, so a query meets only
    those whose size can reach the similarity.
    """

    def __init__(self, sizes: np.ndarray, maps: list[bytes]):
        self.parts = []
        widths = np.array([len(m) for m in maps])
        for width in np.unique(widths).tolist():
            at = np.flatnonzero(widths == width)
            at = at[np.argsort(sizes[at], kind="stable")]
            bits = np.frombuffer(b"".join(maps[i] for i in at.tolist()), dtype=np.uint64).reshape(len(at), -1)
            self.parts.append((width, at, sizes[at], bits))

    def reach(self, size: int, bits: bytes, similarity: int) -> np.ndarray:
        """The sets that may reach the similarity with a set of that size and bit map."""
        found = []
        for _, at, sizes, own in self.parts:
            low, high = _size_range(sizes, size, size, similarity)
            if low == high:
                continue
            query, rows = np.frombuffer(bits, dtype=np.uint64).reshape(1, -1), own[low:high]
            while query.shape[1] > rows.shape[1]:
                query = _folded(query)
            while rows.shape[1] > query.shape[1]:
                rows = _folded(rows)
            most = np.minimum(
                size - np.bitwise_count(query & ~rows).sum(axis=1, dtype=np.int64),
                sizes[low:high] - np.bitwise_count(rows & ~query).sum(axis=1, dtype=np.int64),
            )
            found.append(at[low:high][(100 + similarity) * most >= similarity * (size + sizes[low:high])])
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def marks(self, queries: "BitMaps", similarity: int, self_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the queries have a set in reach, and which sets a query reaches; ``self_of`` says which
        set a query is itself (-1: none)."""
        found = np.zeros(sum(len(at) for _, at, _, _ in queries.parts), dtype=bool)
        met = np.zeros(sum(len(at) for _, at, _, _ in self.parts), dtype=bool)
        for width, asking, asked_sizes, asked_bits in queries.parts:
            if 8 * width > _NARROW:
                for q, size, bits in zip(asking.tolist(), asked_sizes.tolist(), asked_bits, strict=True):
                    hits = self.reach(size, bits.tobytes(), similarity)
                    hits = hits[hits != self_of[q]]
                    found[q] |= len(hits) > 0
                    met[hits] = True
                continue
            for _, at, sizes, bits in self.parts:
                low, high = _size_range(sizes, int(asked_sizes[0]), int(asked_sizes[-1]), similarity)
                at, sizes, left, right = at[low:high], sizes[low:high], asked_bits, bits[low:high]
                if not len(at):
                    continue
                while left.shape[1] > right.shape[1]:
                    left = _folded(left)
                while right.shape[1] > left.shape[1]:
                    right = _folded(right)
                left, right = _spread(left), _spread(right)
                spare_left, spare_right = asked_sizes - left.sum(axis=1), sizes - right.sum(axis=1)
                for i in range(0, len(asking), _AT_ONCE):
                    some = asked_sizes[i : i + _AT_ONCE]
                    low, high = _size_range(sizes, int(some[0]), int(some[-1]), similarity)
                    for j in range(low, high, 1 << 14):
                        k = min(high, j + (1 << 14))
                        both = left[i : i + _AT_ONCE] @ right[j:k].T
                        most = both + np.minimum(spare_left[i : i + _AT_ONCE, None], spare_right[j:k])
                        near = (100 + similarity) * most >= similarity * (some[:, None] + sizes[j:k])
                        near &= self_of[asking[i : i + _AT_ONCE], None] != at[j:k]
                        found[asking[i : i + _AT_ONCE]] |= near.any(axis=1)
                        met[at[j:k]] |= near.any(axis=0)
        return found, met


def _spread(bits: np.ndarray) -> np.ndarray:
    """Bit maps as rows of 0 and 1."""
    return np.unpackbits(np.ascontiguousarray(bits).view(np.uint8), axis=1).astype(np.float32)


def _size_range(sizes: np.ndarray, least: int, most: int, similarity: int) -> tuple[int, int]:
    """Where sorted sizes can reach the similarity with any size from ``least`` to ``most``."""
    low = int(np.searchsorted(100 * sizes, similarity * least, side="left"))
    return low, int(np.searchsorted(similarity * sizes, 100 * most, side="right"))


def _sieve(similarity: int):
    """Rows of groups that have a partner in reach."""

    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tallyloom.llm.grouped import groups

        for group in groups(batches, ["cell"]):
            role = np.asarray(group.column("role"))
            inside = np.flatnonzero(role < 2)
            if not len(inside) or len(role) < 2:
                continue
            sizes = np.asarray(group.column("n"))
            maps = group.column("bits").to_pylist()
            asking = np.flatnonzero(role > 0)
            index = BitMaps(sizes[inside], [maps[i] for i in inside.tolist()])
            queries = BitMaps(sizes[asking], [maps[i] for i in asking.tolist()])
            self_of = np.full(len(role), -1)
            self_of[inside] = np.arange(len(inside))
            found, met = index.marks(queries, similarity, self_of[asking])
            kept = np.zeros(len(role), dtype=bool)
            kept[asking] |= found
            kept[inside] |= met
            if kept.any():
                kept = group.select(["cell", "role", "class"]).filter(pa.array(kept))
                yield from kept.combine_chunks().to_batches()

    return sieve


def _classified(n: int):
    """A row for each document: id, set size, class; and a row for each shingle that several classes of a
    batch have: the shingle and how many."""

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "class", "shingle", "classes", "bits"]
        at, held, met = None, [], set()

        def repeated() -> pa.RecordBatch:
            shingles, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts > 1
            none = [None] * int(many.sum())
            return _batch(names, none, none, none, shingles[many], counts[many], none)

        for batch, part, sets in _parts(batches, n):
            if batch is not at:
                if held:
                    yield repeated()
                at, held, met = batch, [], set()
            classes = [_class(s) if len(s) else None for s in sets]
            for c, s in zip(classes, sets, strict=True):
                if c is not None and c not in met:
                    met.add(c)
                    held.append(s)
            none = [None] * len(sets)
            ids, bits = part.column("doc_id").to_pylist(), [bit_map(s) if len(s) else None for s in sets]
            yield _batch(names, ids, [len(s) for s in sets], classes, none, none, bits)
        if held:
            yield repeated()

    return classify


def _first_shingles(n: int, similarity: int, frequent):
    """``(shingle, class, leading)`` for the first shingles of every class; frequent ones come last in the
    order and carry a high bit. ``leading`` is 1 for those by which larger partners find the class."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = frequent.value
        at, met = None, set()
        for batch, _, sets in _parts(batches, n):
            if batch is not at:
                at, met = batch, set()
            shingles, classes, leading = [], [], []
            for s in sets:
                c = _class(s) if len(s) else None
                if c is None or c in met:
                    continue
                met.add(c)
                wanted = len(s) - -(-similarity * len(s) // 100) + 1
                common = np.isin(s, last, assume_unique=True) if len(last) else np.zeros(len(s), dtype=bool)
                taken = np.concatenate([s[~common], s[common] | _LAST])[:wanted]
                shingles.append(taken)
                classes.append(np.full(len(taken), c))
                own = len(s) - -(-2 * similarity * len(s) // (100 + similarity)) + 1
                leading.append((np.arange(len(taken)) < own).astype(np.int64))
            if shingles:
                columns = (np.concatenate(c) for c in (shingles, classes, leading))
                yield _batch(["shingle", "class", "leading"], *columns)

    return first


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by shingle and class, once each those whose shingle another class has; all of a
    frequent shingle."""
    names = ["shingle", "class", "leading"]
    tail = np.zeros((0, 3), dtype=np.int64)
    told = 0  # rows of the tail that are decided

    def keep(rows: np.ndarray, until: int) -> pa.RecordBatch:
        like = rows[1:, 0] == rows[:-1, 0]
        kept = rows[:, 0] >= _LAST
        kept[1:] |= like
        kept[:-1] |= like
        kept[:told] = False
        kept[until:] = False
        return _batch(names, rows[kept, 0], rows[kept, 1], rows[kept, 2])

    for batch in batches:
        rows = np.concatenate([tail, np.stack([np.asarray(batch.column(c)) for c in names], axis=1)])
        fresh = np.ones(len(rows), dtype=bool)
        fresh[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        rows = rows[fresh]
        if len(rows) > 2:
            yield keep(rows, len(rows) - 1)
            tail, told = rows[-2:], 1
        else:
            tail = rows
    if len(tail):
        yield keep(tail, len(tail))


def _sets(n: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part, found in _parts(batches, n):
            wanted = part.column("class").to_pylist()
            right = [len(s) > 0 and _class(s) == w for s, w in zip(found, wanted, strict=True)]
            kept = part.filter(pa.array(right))
            data = [s.tobytes() for s, r in zip(found, right, strict=True) if r]
            yield pa.RecordBatch.from_arrays(
                [kept.column("class"), kept.column("doc_id"), pa.array(data, pa.binary())], ["class", "rep", "shingles"]
            )

    return sets


class Index:
    """Inverted lists of shingle sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        shingles = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(shingles, kind="stable")
        self.owner = owner[order]
        shingles = shingles[order]
        self.starts = np.flatnonzero(np.append(True, shingles[1:] != shingles[:-1]))
        self.shingles = shingles[self.starts]
        self.lengths = np.diff(np.append(self.starts, len(shingles)))
        # list and owner as one number, sorted, for binary searches in many lists at once
        self.places = np.repeat(np.arange(len(self.starts)), self.lengths) * len(sets) + self.owner

    def search(self, query: np.ndarray, similarity: int, label: np.ndarray) -> Iterator[int]:
        """Sets that reach the similarity with the query, at least one of each label that has such and is not
        the query's. ``label`` holds the sets' labels and the query's last; the caller joins labels of
        what is found."""
        n = len(query)
        at = np.minimum(np.searchsorted(self.shingles, query), len(self.shingles) - 1)
        at = at[self.shingles[at] == query]
        least = -(-similarity * n // 100)
        if len(at) < least:
            return
        at = at[np.argsort(self.lengths[at], kind="stable")]
        longest = int(self.lengths[at[-1]])
        aside = min(least - 1, int(least / (MU * np.log2(longest + 1) + 1)))
        short, long = at[: len(at) - aside], at[len(at) - aside :]
        sizes = self.lengths[short]
        ends = np.cumsum(sizes)
        merged = self.owner[np.arange(ends[-1]) + np.repeat(self.starts[short] - ends + sizes, sizes)]
        # the lists are sorted runs, which a stable sort merges; only sets that occur in one are looked at
        merged = np.sort(merged, kind="stable")
        firsts = np.flatnonzero(np.append(True, merged[1:] != merged[:-1]))
        occurring, counts = merged[firsts], np.diff(np.append(firsts, len(merged)))
        needed = -(-similarity * (n + self.sizes[occurring]) // (100 + similarity))
        open_ = np.flatnonzero((counts + aside >= needed) & (label[occurring] != label[-1]))
        batch = 1
        while len(open_):
            # one of each label first: where it links, the others of that label need no look
            _, first = np.unique(label[occurring[open_]], return_index=True)
            tried = open_[first] if batch == 1 else open_[:batch]
            found = self.places
            wanted = long[:, None] * len(self.sizes) + occurring[tried]
            where = np.minimum(np.searchsorted(found, wanted), len(found) - 1)
            total = counts[tried] + (found[where] == wanted).sum(axis=0)
            yield from occurring[tried[total >= needed[tried]]].tolist()
            open_ = np.setdiff1d(open_, tried, assume_unique=True)
            open_ = open_[label[occurring[open_]] != label[-1]]
            batch = max(64, 4 * batch)


def _search(similarity: int):
    """Links that connect what the groups' queries and index have in common."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tallyloom.llm.grouped import groups

        a, b = [], []
        for group in groups(batches, ["cell"]):
            for x, y in _group_links(group, similarity):
                a.append(x)
                b.append(y)
            if len(a) >= 1 << 15:
                yield _batch(["a", "b"], a, b)
                a, b = [], []
        yield _batch(["a", "b"], a, b)

    return search


def _group_links(group: pa.Table, similarity: int) -> Iterator[tuple[int, int]]:
    role = np.asarray(group.column("role"))
    inside = np.flatnonzero(role < 2)
    asking = np.flatnonzero(role > 0)
    if not len(inside) or not len(asking) or len(role) < 2:
        return
    sets = [np.frombuffer(s, dtype=np.int64) for s in group.column("shingles").to_pylist()]
    reps = np.asarray(group.column("rep"))
    known = np.asarray(group.column("component"))
    index = Index([sets[i] for i in inside])
    # labels of the index, and of the query last
    label = np.append(np.unique(known, return_inverse=True)[1][inside], 0)
    names = {k: i for i, k in enumerate(np.unique(known).tolist())}
    outside = {}
    for q in asking.tolist():
        own = np.flatnonzero(inside == q)
        if len(own):
            label[-1] = label[own[0]]
        else:
            label[-1] = outside.get(known[q], names[known[q]])
        for hit in index.search(sets[q], similarity, label):
            if label[hit] == label[-1]:
                continue
            yield int(reps[q]), int(reps[inside[hit]])
            old, new = label[-1], label[hit]
            label[label == old] = new
            for k, v in outside.items():
                if v == old:
                    outside[k] = new
        if not len(own):
            outside[known[q]] = label[-1]


def _linked(rows: DataFrame, sets: DataFrame, similarity: int, label: str) -> DataFrame:
    """Links in groups of ``rows`` ``(cell, role, class, component)``; role 0 is index, 1 both, 2 query."""
    cells = rows.join(sets, "class").select("cell", F.col("role").cast("long").alias("role"), "rep", "component", "shingles")
    cells = cells.withColumn("component", F.coalesce("component", "rep"))
    cells = cells.repartition("cell").sortWithinPartitions("cell")
    return written(cells.mapInArrow(_search(similarity), "a long, b long"), label)


def components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    n: int = N,
    similarity: int = SIMILARITY,
) -> DataFrame:
    """One row per document: id, ``n_shingles`` and ``component_id``, the smallest id reachable by links."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    found = written(texts.mapInArrow(_classified(n), _CLASSIFIED), "sets")
    rows = found.where("shingle is null").select("doc_id", "n_shingles", "class")
    kinds = found.where("class is not null").groupBy("class")
    classes = written(
        kinds.agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("bits").alias("bits")), "classes"
    )
    frequent = (
        found.where("shingle is not null").groupBy("shingle").agg(F.sum("classes").alias("classes"))
        .where(F.col("classes") >= FREQUENT_FROM).orderBy(F.desc("classes"), "shingle").limit(FREQUENT)
        .select("shingle").toArrow()
    )
    frequent = spark.sparkContext.broadcast(np.sort(np.asarray(frequent.column("shingle").combine_chunks(), dtype=np.int64)))
    first = texts.mapInArrow(_first_shingles(n, similarity, frequent), _FIRST)
    salt = F.when(F.col("shingle") >= _LAST, F.pmod(F.col("class"), F.lit(64))).otherwise(0)
    first = first.withColumn("salt", salt).repartition("shingle", "salt").sortWithinPartitions("shingle", "class")
    shared = written(first.select("shingle", "class", "leading").mapInArrow(_shared, _FIRST), "shared")

    # a frequent shingle, if there is one: texts made of the same passages then live together
    frequent_home = F.min(F.when(F.col("shingle") >= _LAST, F.col("shingle")))
    homes = shared.where("leading = 1").groupBy("class").agg(F.coalesce(frequent_home, F.min("shingle")).alias("home"))
    homes = written(homes, "homes")
    known = classes.where("rep is not null").select("class", "rep", "n")
    placed = written(shared.join(known, "class").join(homes, "class", "left").drop("rep"), "placed")
    # Who lives where, for each leading shingle. Of two classes that both lead with it, that with the larger home
    # visits; else the larger class does.
    lived = (
        placed.where("leading = 1").groupBy("shingle", F.col("home").alias("cell"))
        .agg(F.min("n").alias("least"), F.max("n").alias("most"))
    )
    lived = written(lived, "lived")
    members = written(homes.join(known, "class").select("class", F.col("home").alias("cell"), "n", "rep"), "members")
    sizes = members.groupBy("cell").agg(
        F.count("*").alias("live"), F.sum("n").alias("weight"), F.min("class").alias("leader")
    )
    visits = placed.join(lived, "shingle").where(
        f"100 * most >= {similarity} * n and 100 * n >= {similarity} * least"
        " and if(leading = 1, cell < home, least <= n and not cell <=> home)"
    )
    visits = written(visits.select("class", "cell", "n").distinct(), "visits")
    callers = visits.groupBy("cell").agg(F.count("*").alias("calls"), F.sum("n").alias("call_weight"))
    cells = (
        sizes.join(callers, "cell", "left").na.fill(0, ["calls", "call_weight"])
        .where("live + calls > 1")
        .withColumn("blocks", F.ceil(F.col("weight") / BLOCK))
        .withColumn("parts", F.when(F.col("blocks") > 1, 1).otherwise(F.greatest(F.lit(1), F.ceil(F.col("call_weight") / BLOCK))))
        .select("cell", "blocks", "parts", "leader")
    )
    cells = written(cells, "cells")
    inside = members.join(cells, "cell").withColumn("block", F.pmod(F.xxhash64("class"), "blocks"))

    def group(*keys: str):
        return F.xxhash64(*keys).alias("cell")

    index = inside.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)))
    role = F.when(F.col("part") == 0, 1).otherwise(0).cast("long").alias("role")
    small = index.where("blocks = 1").select(group("cell", "block", "part"), role, "class")
    index = index.where("blocks > 1").select(group("cell", "block", "part"), role, "class")
    calls = visits.join(cells.where("blocks = 1"), "cell").withColumn("block", F.lit(0).cast("long"))
    calls = calls.withColumn("part", F.pmod(F.xxhash64("class"), "parts"))
    calls = calls.select(group("cell", "block", "part"), F.lit(2).cast("long").alias("role"), "class")
    small = small.unionByName(calls).join(classes.select("class", "n", "bits"), "class")
    small = small.select("cell", "role", "class", "n", "bits").repartition("cell").sortWithinPartitions("cell")
    small = written(small.mapInArrow(_sieve(similarity), "cell long, role long, class long"), "sieved")
    large = cells.where("blocks > 1")
    leaders = large.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
    leaders = leaders.where(F.col("block") != F.pmod(F.xxhash64("leader"), "blocks")).withColumn("part", F.lit(0).cast("long"))
    leaders = leaders.select(
        group("cell", "block", "part"), F.lit(2).cast("long").alias("role"), F.col("leader").alias("class")
    )
    together = small.unionByName(index).unionByName(leaders)
    in_large = members.join(large.select("cell"), "cell").select("class").unionByName(
        visits.join(large.select("cell"), "cell").select("class")
    )
    wanted = small.select("class").unionByName(in_large).distinct().join(known.select("class", "rep"), "class")
    wanted = written(wanted.select("class", F.col("rep").alias("doc_id")), "wanted")
    sets = written(texts.join(wanted, "doc_id").mapInArrow(_sets(n), "class long, rep long, shingles binary"), "shingles")
    links = _linked(together.withColumn("component", F.lit(None).cast("long")), sets, similarity, "links")
    joined = connected_components(links)

    if large.limit(1).count():
        links = links.unionByName(_across(large, members, visits, known, joined, sets, similarity))
        joined = connected_components(links)
    component = F.coalesce("component", "rep", "doc_id")
    return (
        rows.join(classes.select("class", "rep"), "class", "left")
        .join(joined, F.col("rep") == F.col("node"), "left")
        .select(F.col("doc_id").alias(id_column), "n_shingles", component.alias("component_id"))
    )


def _across(
    large: DataFrame,
    members: DataFrame,
    visits: DataFrame,
    known: DataFrame,
    joined: DataFrame,
    sets: DataFrame,
    similarity: int,
) -> DataFrame:
    """Links between classes of different components in cells of several blocks.

    A large component has chunks of its own, the others of a cell share chunks; a class meets the chunks
    that hold anything but its own component.
    """
    reps = known.select("class", "rep")
    both = members.select("class", "cell", "n", F.lit(True).alias("lives")).unionByName(
        visits.withColumn("lives", F.lit(False))
    )
    both = both.join(large.select("cell"), "cell").join(reps, "class")
    both = both.join(joined, F.col("rep") == F.col("node"), "left").withColumn("component", F.coalesce("component", "rep"))
    both = written(both.select("class", "cell", "n", "lives", "component"), "across")
    living = both.where("lives")
    weights = living.groupBy("cell", "component").agg(F.sum("n").alias("weight"))
    own = weights.where(F.col("weight") >= BLOCK // 4).select(
        "cell", "component", F.lit(True).alias("own"), F.ceil(F.col("weight") / BLOCK).alias("own_chunks")
    )
    rest = (
        weights.where(F.col("weight") < BLOCK // 4).groupBy("cell")
        .agg(F.ceil(F.sum("weight") / BLOCK).alias("rest_chunks"))
    )
    chunked = living.join(own, ["cell", "component"], "left").join(rest, "cell", "left")
    draw = F.xxhash64("class")
    chunk = F.when(
        F.col("own"), F.xxhash64("component", F.pmod(draw, F.coalesce("own_chunks", F.lit(1))))
    ).otherwise(F.pmod(draw, F.greatest(F.lit(1), F.coalesce("rest_chunks", F.lit(1)))))
    chunked = written(chunked.select("class", "cell", "component", chunk.alias("chunk")), "chunks")
    chunks = chunked.groupBy("cell", "chunk").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    asked = both.join(chunks, "cell").where("not (low = high and low = component)")
    asked = asked.select("cell", "chunk", "class", "n", "component")
    parts = asked.groupBy("cell", "chunk").agg(F.greatest(F.lit(1), F.ceil(F.sum("n") / BLOCK)).alias("parts"))
    index = chunked.join(parts, ["cell", "chunk"]).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))
    )
    asked = asked.join(parts, ["cell", "chunk"]).withColumn("part", F.pmod(F.xxhash64("class"), "parts"))
    columns = [F.xxhash64("cell", "chunk", "part").alias("cell"), "role", "class", "component"]
    groups = index.withColumn("role", F.lit(0)).select(*columns).unionByName(
        asked.withColumn("role", F.lit(2)).select(*columns)
    )
    return _linked(groups, sets, similarity, "links")


def representatives(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with the smallest id of their component, with all columns; others go. Rows without id
    stay."""
    found = components(docs, id_column, text_column)
    lost = found.where(F.col(id_column) > F.col("component_id")).select(F.col(id_column).alias("lost_id")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("id"))
    return rows.join(lost, F.col("id") == F.col("lost_id"), "left_anti").select("row.*")
