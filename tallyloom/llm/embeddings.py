"""Near-duplicate vectors by randomised-rotation binary codes.

Each vector is turned by a random rotation and kept as the signs of its coordinates, with the stored
factor <code, vector> that makes <code, q> / factor an unbiased estimate of <vector, q> for a
unit vector q. Two steps use them. First codes alone are compared: the share of signs that differ estimates the angle, and
a vector goes on where it has a partner whose angle may reach the threshold (up to ``CODE_CONFIDENCE`` standard errors). Only such
vectors are sent to their buckets. There the estimate's error is below ``CONFIDENCE`` sqrt((1 - factor^2) / factor^2 / (D - 1)) but in rare cases, so
only pairs whose upper bound reaches the threshold are computed from the vectors, in doubles, and
linked by that.

Which pairs are estimated: sign bits of further random directions give each vector a bucket in each of
several tables. Bits grow with the logarithm of the rows, so that buckets keep their size, and the number
of tables follows from the threshold: two vectors at the threshold share a bucket with probability
``RECALL`` at least, closer ones more surely. Equal vectors are one row with a weight. A large bucket
is cut into blocks, and each pair of blocks is a group of its own: the group sizes are bounded and
all pairs are seen. A pair counts in the first table that it shares; only sums and a spanning forest
leave a group, never its pairs. A vector is sent to a table only for partners that it first meets there, so most are
sent once or not at all.

Defined results: a vector that is null, zero, or holds a null or non-finite component links with
nothing, as does a row without id (its component is null). Vectors of different length never link.
Rows that repeat an id are vectors of their own. An empty table gives no rows. Columns beyond the two named ones are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.components import connected_components
from tallyloom.llm.tables import written

THRESHOLD = 0.95
RECALL = 0.99
CONFIDENCE = 3.0
CODE_CONFIDENCE = 4.0
#: At most so many large buckets are sent to all tasks; more are joined.
SENT = 1 << 18
BUCKET = 256
BLOCK = 2048
SEED = 29

CODED = "rep long, weight long, dim int, vector binary, code binary, factor double, keys binary, buckets array<long>"


def tables_for(rows: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """Bits of a bucket and number of tables."""
    bits = min(28, max(4, round(math.log2(max(1, rows) / BUCKET))))
    same = 1 - math.acos(threshold) / math.pi
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same**bits)))


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def codes(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs of the turned unit vectors as packed bits, and the factors."""
    turned = vectors @ turn.T
    factor = np.abs(turned).sum(axis=1) / math.sqrt(vectors.shape[1])
    return np.packbits(turned >= 0, axis=1), factor


def _code(bits: int, tables: int, seed: int, form: str):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                if dim not in made:
                    planes = np.random.default_rng([seed, dim, 1]).standard_normal((tables * bits, dim))
                    made[dim] = rotation(dim, seed), planes
                turn, planes = made[dim]
                raw = np.asarray(part.column("embedding").flatten(), dtype=np.float64).reshape(-1, dim)
                unit = raw / _norms(raw)
                packed, factor = codes(unit, turn)
                signs = (unit @ planes.T >= 0).reshape(len(unit), tables, bits)
                keys = signs @ (np.int64(1) << np.arange(bits, dtype=np.int64))
                place = (np.int64(dim) * tables + np.arange(tables)) << np.int64(32)
                names = ["rep", "weight", "dim", "vector", "code", "factor", "keys", "buckets"]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("rep"), part.column("weight"), part.column("dim"),
                        pa.array([v.tobytes() for v in raw.astype(form)], pa.binary()),
                        pa.array([c.tobytes() for c in packed], pa.binary()), pa.array(factor),
                        pa.array([k.tobytes() for k in keys.astype("<i4")], pa.binary()),
                        pa.array((keys + place).tolist(), pa.list_(pa.int64())),
                    ],
                    names,
                )

    return code


def _norms(raw: np.ndarray) -> np.ndarray:
    scale = np.abs(raw).max(axis=1, keepdims=True)
    return np.sqrt(((raw / scale) ** 2).sum(axis=1, keepdims=True)) * scale


def most_apart(dim: int, threshold: float) -> int:
    """The most signs that may differ between the codes of two vectors at the threshold."""
    share = math.acos(threshold) / math.pi
    return math.floor(dim * share + CODE_CONFIDENCE * math.sqrt(dim * share * (1 - share)))


_OPEN = "bucket long, left long, right long, second boolean, rep long"


def _open(threshold: float, tables: int):
    """From codes alone: the rows of each group with a partner that may be near, and that first meets them in this table."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tallyloom.llm.grouped import groups, matrix

        for group in groups(batches, ["bucket", "left", "right"]):
            bucket, left, right = (group.column(c)[0].as_py() for c in ("bucket", "left", "right"))
            second = np.asarray(group.column("second"))
            cross = second.any() and not second.all()
            if group.num_rows < 2 or (left != right and not cross):
                continue
            dim = group.column("dim")[0].as_py()
            signs = np.unpackbits(matrix(group.column("code"), "u1"), axis=1, count=dim).astype(np.float32) * 2 - 1
            keys = matrix(group.column("keys"), "<i4")
            table = int((bucket >> 32) % tables)
            least = dim - 2 * most_apart(dim, threshold)
            n = len(signs)
            found = np.zeros(n, dtype=bool)
            for a in range(0, n, 256):
                near = signs[a : a + 256] @ signs.T >= least
                near &= np.arange(a, a + len(near))[:, None] < np.arange(n)
                if cross:
                    near &= second[a : a + 256, None] != second
                i, j = np.nonzero(near)
                for k in range(0, len(i), 1 << 16):
                    p, q = i[k : k + (1 << 16)] + a, j[k : k + (1 << 16)]
                    fresh = ~(keys[p, :table] == keys[q, :table]).any(axis=1)
                    found[p[fresh]] = found[q[fresh]] = True
            at = np.flatnonzero(found)
            rep = np.asarray(group.column("rep"))[at]
            same = [pa.array(np.full(len(at), x, dtype=np.int64)) for x in (bucket, left, right)]
            names = ["bucket", "left", "right", "second", "rep"]
            yield pa.RecordBatch.from_arrays([*same, pa.array(second[at]), pa.array(rep)], names)

    return opened


def _search(threshold: float, confidence: float, tables: int, seed: int, form: str):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tallyloom.llm.grouped import groups

        turns: dict[int, np.ndarray] = {}
        rows: list[tuple] = []
        for group in groups(batches, ["bucket", "left", "right"]):
            if group.num_rows < 2:
                continue
            dim = group.column("dim")[0].as_py()
            if dim not in turns:
                turns[dim] = rotation(dim, seed)
            rows += _links(group, turns[dim], threshold, confidence, tables, form)
            if len(rows) >= 1 << 15:
                yield _rows(rows)
                rows = []
        yield _rows(rows)

    return search


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "n"])


def _links(
    group: pa.Table, turn: np.ndarray, threshold: float, confidence: float, tables: int, form: str
) -> list[tuple]:
    """From the pairs that first meet in this table: rows ``(a, null, n)``: n more vectors link with a; and ``(a, b, null)``: links that join what is linked."""
    from tallyloom.llm.grouped import matrix

    raw = matrix(group.column("vector"), form).astype(np.float64)
    dim = raw.shape[1]
    unit = raw / _norms(raw)
    signs = np.unpackbits(matrix(group.column("code"), "u1"), axis=1, count=dim).astype(np.float32) * 2 - 1
    factor = np.asarray(group.column("factor"))
    keys = matrix(group.column("keys"), "<i4")
    weight = np.asarray(group.column("weight"))
    rep = np.asarray(group.column("rep"))
    second = np.asarray(group.column("second"))
    table = int((group.column("bucket")[0].as_py() >> 32) % tables)
    cross = second.any() and not second.all()
    if np.asarray(group.column("left"))[0] != np.asarray(group.column("right"))[0] and not cross:
        return []
    turned = (unit @ turn.T).astype(np.float32)
    bound = confidence * np.sqrt(np.maximum(0.0, 1 - factor**2) / factor**2 / max(1, dim - 1)) + 1e-5
    n = len(rep)
    linked = np.zeros((n, n), dtype=bool)
    gained = np.zeros(n, dtype=np.int64)
    for a in range(0, n, 256):
        b = min(n, a + 256)
        estimate = (turned[a:b] @ signs.T) / (math.sqrt(dim) * factor)
        near = estimate + bound >= threshold
        near &= np.arange(a, b)[:, None] < np.arange(n)
        if cross:
            near &= second[a:b, None] != second
        i, j = np.nonzero(near)
        i += a
        for k in range(0, len(i), 1 << 16):
            p, q = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            fresh = ~(keys[p, :table] == keys[q, :table]).any(axis=1)
            p, q = p[fresh], q[fresh]
            exact = np.einsum("ij,ij->i", unit[p], unit[q]) >= threshold
            p, q = p[exact], q[exact]
            linked[p, q] = linked[q, p] = True
            np.add.at(gained, p, weight[q])
            np.add.at(gained, q, weight[p])
    rows = [(a, None, g) for a, g in zip(rep[gained > 0].tolist(), gained[gained > 0].tolist(), strict=True)]
    return rows + _forest(linked, rep)


def _forest(linked: np.ndarray, rep: np.ndarray) -> list[tuple]:
    seen = ~linked.any(axis=1)
    rows = []
    for start in range(len(rep)):
        if seen[start]:
            continue
        seen[start] = True
        todo = [start]
        while todo:
            i = todo.pop()
            new = np.flatnonzero(linked[i] & ~seen)
            seen[new] = True
            rows += [(int(rep[i]), int(rep[j]), None) for j in new]
            todo += new.tolist()
    return rows


def near_duplicates(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = THRESHOLD,
    seed: int = SEED,
) -> DataFrame:
    """One row per vector: id, ``n_links`` (other vectors at ``threshold`` or above), ``component_id`` and ``kept``
    (it is the smallest of its component)."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("embedding"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("valid", F.col("vec_id").isNotNull() & F.coalesce(~odd & some, F.lit(False)))
    rows = rows.withColumn("digest", F.when(F.col("valid"), F.sha2(F.col("embedding").cast("string"), 256)))
    ids = written(rows.select("vec_id", "valid", "digest"), "vectors")
    classes = written(
        rows.where("valid").groupBy("digest").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("embedding").alias("embedding")
        ).withColumn("dim", F.size("embedding")),
        "classes",
    )
    bits, tables = tables_for(classes.count(), threshold)
    single = isinstance(classes.schema["embedding"].dataType.elementType, T.FloatType)
    form = "<f4" if single else "<f8"
    coded = written(
        classes.select("rep", "weight", "dim", "embedding").mapInArrow(_code(bits, tables, seed, form), CODED), "codes"
    )
    large = written(
        coded.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("rows"))
        .where(F.col("rows") > BLOCK).select("bucket", F.ceil(F.col("rows") / BLOCK).alias("blocks")),
        "large",
    )
    if large.count() <= SENT:
        large = F.broadcast(large)
    placed = coded.select("rep", "dim", "code", "keys", F.explode("buckets").alias("bucket")).join(large, "bucket", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rep"), blocks)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    )
    pairs = placed.select(
        "bucket", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
        (F.col("block") > F.col("other")).alias("second"), "rep", "dim", "code", "keys",
    )
    group = ["bucket", "left", "right"]
    pairs = pairs.repartition(*group).sortWithinPartitions(*group)
    sent = written(pairs.mapInArrow(_open(threshold, tables), _OPEN), "open")
    sent = sent.join(coded.drop("buckets"), "rep").repartition(*group).sortWithinPartitions(*group)
    found = written(
        sent.mapInArrow(_search(threshold, CONFIDENCE, tables, seed, form), "a long, b long, n long"), "found"
    )
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    components = connected_components(found.where("b is not null").select("a", "b"))
    result = (
        classes.select("digest", "rep", "weight")
        .join(counts, F.col("rep") == F.col("a"), "left")
        .join(components, F.col("rep") == F.col("node"), "left")
        .select(
            "digest",
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    every = ids.join(result, "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return every.select(
        F.col("vec_id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
