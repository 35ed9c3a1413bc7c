"""Product quantisation of vectors by member-resident Lloyd rounds.

Components become integers ``floor(256 * x)``. A vector is cut into equal consecutive parts, and
each part position has a codebook of entries. Training keeps a table of members, one row per part of
a vector, dealt out by (position, entry, salt). A round has the owners sum up the members that
reside with them; the sums of at most positions * entries * width numbers make the new codebooks.
Members then look for their nearest entry where they are. Those that keep their entry stay in the
task that read them; only those that change it migrate, by a shuffle to their new owners. The salt
is a running number within the task that read a row, so that no entry, however popular, and no set
of copies makes one large owner. At last one scan codes all vectors, with no shuffle.

Distances are whole numbers. They are formed as ``|x|^2 - 2 x.c + |c|^2`` in doubles when every
term is below 2^53, and exact either way.

Edge cases: vectors that are null, or hold null, NaN or an infinity are dropped; fewer kept ids than
entries make shorter codebooks; a repeated id starts one entry, from its smallest vector; rows
without id start none but are coded, with null codes if no row has an id; repeated rows are coded
alike; labels are compared with null equal to null; an empty table gives no rows. Vectors of
different lengths, a length that the parts do not divide, or components so large that the error may
not fit a long raise an error that says so. Extra columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracheck.llm.common import read_table, written
from terracheck.llm.lookup import look_up
from terracheck.llm.registry import register

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Rows of the table for each salt.
ROWS_PER_SALT = 100_000
#: Rows whose distances are held at once.
BLOCK_ROWS = 4096

Codebooks = np.ndarray  # (parts, entries, width), whole numbers


def usable(vector: Column) -> Column:
    """Whether a vector is present and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def whole_numbers(column: pa.Array, width: int) -> np.ndarray:
    """``floor(SCALE * x)`` of a column of finite vectors, one row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != width * len(column) or (len(column) and pc.min_max(pc.list_value_length(column))["min"].as_py() != width):
        raise ValueError(f"vectors must all have {width} components, as the first has")
    scaled = np.floor(flat.astype(np.float64) * SCALE)
    if len(scaled) and 4.0 * width * np.abs(scaled).max() ** 2 >= 2.0**62:
        raise ValueError("components are too large for whole-number errors in a long")
    return scaled.astype(np.int64).reshape(len(column), width)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry (the lowest of equal ones) and the squared distance."""
    best, error = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
    if not x.size:
        return best, error
    top = max(int(np.abs(x).max()), int(np.abs(entries).max()))
    exact = 4 * x.shape[1] * top * top < 1 << 53
    kind = np.float64 if exact else np.int64
    c = entries.astype(kind)
    squares = (c * c).sum(axis=1)
    for at in range(0, len(x), BLOCK_ROWS):
        y = x[at : at + BLOCK_ROWS].astype(kind)
        distance = (y * y).sum(axis=1)[:, None] - 2 * (y @ c.T) + squares
        best[at : at + len(y)] = distance.argmin(axis=1)  # the first of equal ones
        error[at : at + len(y)] = distance.min(axis=1)
    return best, error


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The parts of the vectors of the smallest ids; None if no row has an id."""
    ids = [r.vec_id for r in vectors.where("vec_id IS NOT NULL").select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    rows = vectors.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("vector").alias("vector")).collect() if ids else []
    if not rows:
        return None
    width = len(rows[0].vector)
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    x = whole_numbers(pa.array([r.vector for r in sorted(rows, key=lambda r: r.vec_id)], pa.list_(pa.float64())), width)
    return x.reshape(len(x), parts, width // parts).transpose(1, 0, 2)


def _columns(width: int) -> list[str]:
    return [f"v{i}" for i in range(width)]


def settle(vectors: DataFrame, books: Codebooks, salts: int) -> DataFrame:
    """``position, entry, salt, v0, v1, ...``: all parts with their nearest entry, at their owners."""
    parts, _, width = books.shape
    share = vectors.sparkSession.sparkContext.broadcast(books)
    names = ["position", "entry", "salt", *_columns(width)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            x = whole_numbers(batch.column(0), parts * width).reshape(-1, parts, width)
            salt = pa.array((np.arange(seen, seen + len(x)) % salts).astype(np.int32))
            seen += len(x)
            for p in range(parts):
                entry, _ = nearest(x[:, p], share.value[p])
                heads = [pa.array(np.full(len(x), p, dtype=np.int16)), pa.array(entry.astype(np.int16)), salt]
                yield pa.RecordBatch.from_arrays(heads + [pa.array(x[:, p, i].astype(np.int32)) for i in range(width)], names=names)

    schema = "position smallint, entry smallint, salt int" + "".join(f", {c} int" for c in _columns(width))
    return vectors.select("vector").mapInArrow(cut, schema).repartition("position", "entry", "salt")


def updated(members: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry becomes the floor of its members' mean; entries without members stay."""
    width = books.shape[2]
    sums = members.groupBy("position", "entry").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in _columns(width)])
    out = books.copy()
    for r in sums.collect():  # positions * entries rows at most
        out[r.position, r.entry] = [r[c] // r.n for c in _columns(width)]
    return out


def migrate(members: DataFrame, books: Codebooks) -> DataFrame:
    """``members`` with their nearest entries under ``books``: rows that keep their entry stay in
    their task, the others go to the owners of their new ones."""
    names = members.columns
    share = members.sparkSession.sparkContext.broadcast(books)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position = batch.column(0).to_numpy()
            x = np.stack([c.to_numpy() for c in batch.columns[3:]], axis=1) if len(names) > 3 else np.zeros((len(position), 0), dtype=np.int32)
            to = np.zeros(len(position), dtype=np.int16)
            for p in np.unique(position).tolist():
                here = np.flatnonzero(position == p)
                to[here], _ = nearest(x[here], share.value[p])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to)], names=[*names, "to"])

    moved = members.mapInArrow(look, T.StructType([*members.schema.fields, T.StructField("to", T.ShortType())]))
    stay = moved.where("to = entry").select(names)
    go = moved.where("to <> entry").withColumn("entry", F.col("to")).select(names)
    return stay.union(go.repartition("position", "entry", "salt"))


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of ``vectors (vec_id, vector)``, all of them usable, after so many rounds."""
    books = first_codebooks(vectors, parts, entries)
    if books is None:
        return None
    salts = max(8, -(-vectors.count() // ROWS_PER_SALT))
    for r in range(rounds):
        members = written(settle(vectors, books, salts) if r == 0 else migrate(members, books), "members")
        books = updated(members, books)
    return books


def coded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` of ``vectors (vec_id, label, vector)``, in one scan."""
    parts, _, width = books.shape
    share = vectors.sparkSession.sparkContext.broadcast(books)
    rows = vectors.select("vec_id", "label", "vector")
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    digits = np.array([f"{i:02x}" for i in range(max(books.shape[1], 1))], dtype="S2")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(batch.column(2), parts * width).reshape(-1, parts, width)
            entry, error = np.zeros((len(x), parts), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
            for p in range(parts):
                entry[:, p], off = nearest(x[:, p], share.value[p])
                error += off
            text = np.ascontiguousarray(digits[entry]).view(f"S{2 * parts}").ravel().astype(str)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(error)], names=schema.names)

    return rows.mapInArrow(code, schema)


def decoded(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``codes`` with ``vector``: the entries that ``code`` names, scaled back."""
    share = codes.sparkSession.sparkContext.broadcast(books)
    at = codes.columns.index("code")
    schema = T.StructType([*codes.schema.fields, T.StructField("vector", T.ArrayType(T.DoubleType()))])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                None if c is None else np.concatenate([share.value[p, int(c[2 * p : 2 * p + 2], 16)] for p in range(len(c) // 2)]) / SCALE
                for c in batch.column(at).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.float64()))], names=schema.names)

    return codes.mapInArrow(expand, schema)


def books_digest(books: Codebooks) -> str:
    """SHA-256 of all components by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(table: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS):
    """``(vec_id, label, code, error, label_error)`` of the usable rows of ``table (vec_id, label,
    vector)``, and the codebooks (None, with null codes, if no usable row has an id)."""
    vectors = table.select("vec_id", "label", F.col(vector).alias("vector")).where(usable(F.col(vector)))
    books = train(vectors, parts, entries, rounds)
    if books is None:
        nothing = {"code": "string", "error": "long", "label_error": "long"}
        return vectors.select("vec_id", "label", *[F.lit(None).cast(kind).alias(c) for c, kind in nothing.items()]), None
    codes = written(coded(vectors, books), "codes")
    # null labels are a label of their own: a flag beside the label keeps them apart in the join
    keyed = codes.withColumn("_none", F.col("label").isNull()).withColumn("_label", F.coalesce(F.col("label").cast("string"), F.lit("")))
    sums = keyed.groupBy("_none", "_label").agg(F.sum("error").alias("label_error"))
    return look_up(keyed, sums, ["_none", "_label"]).drop("_none", "_label"), books


def _assigned(stage: int, books: str) -> str:
    """SQL of the parts' nearest entries, and of the entries after them."""
    return f"""
near{stage} AS (
  SELECT rid, position, entry, dist FROM (
    SELECT p.rid, p.position, b.entry, sum((p.v - b.v) * (p.v - b.v)) AS dist,
      row_number() OVER (PARTITION BY p.rid, p.position ORDER BY sum((p.v - b.v) * (p.v - b.v)), b.entry) AS place
    FROM pieces p JOIN {books} b ON p.position = b.position AND p.i = b.i GROUP BY p.rid, p.position, b.entry
  ) WHERE place = 1
), book{stage + 1} AS (
  SELECT b.position, b.entry, b.i, coalesce(m.v, b.v) AS v FROM {books} b LEFT JOIN (
    SELECT n.position, n.entry, p.i, CAST(floor(CAST(sum(p.v) AS DOUBLE) / count(*)) AS BIGINT) AS v
    FROM near{stage} n JOIN pieces p ON n.rid = p.rid AND n.position = p.position GROUP BY n.position, n.entry, p.i
  ) m ON b.position = m.position AND b.entry = m.entry AND b.i = m.i
)"""


SQL = f"""
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id, label, embedding AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), flat AS (
  SELECT rid, unnest(e) AS x, unnest(range(len(e))) AS k, len(e) // {PARTS} AS width FROM kept
), pieces AS (
  SELECT rid, k // width AS position, k % width AS i, CAST(floor({SCALE} * x) AS BIGINT) AS v FROM flat
), starts AS (
  SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept WHERE vec_id IS NOT NULL ORDER BY vec_id LIMIT {ENTRIES}
), book0 AS (
  SELECT position, entry, i, v FROM starts JOIN pieces USING (rid)
), {_assigned(0, "book0").strip()}, {_assigned(1, "book1").strip()}, {_assigned(2, "book2").strip()}, digest AS (
  SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY position, entry, i)) AS codebooks_sha256 FROM book2
), codes AS (
  SELECT rid, string_agg(format('{{:02x}}', entry), '' ORDER BY position) AS code, CAST(sum(dist) AS BIGINT) AS error FROM near2 GROUP BY rid
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (rid), digest
"""


@register("op13_vector_codes", SQL)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all usable embeddings, their errors, and the digest of the codebooks."""
    rows, books = compress(read_table(spark, sf_dir, "embeddings"))
    digest = F.lit(None if books is None else books_digest(books)).cast("string")
    return rows.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))
