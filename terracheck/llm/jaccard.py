"""N-gram Jaccard join: all links between sets of word shingles, without a list of all pairs.

1. One scan hashes each text's shingles to a set. Equal sets are one node.
2. Set elements have one global order: hash order, with the (at most ``HEAVY``) elements that are
   frequent within slices of the corpus last. Two sets that link share ``l`` elements or more among
   the first ``n - ceil(t n) + l`` of each, so those make up an inverted index; ``l`` is one more
   than 3 % of the smaller set, and sets with fewer elements in lists that others share are skipped.
3. Index lists are cut into blocks by set size. A pair is possible only within a block or between
   neighbouring blocks, and by the positions of the shared element in both sets: blocks and
   positions that cannot reach the threshold are skipped.
4. Answers come in rounds. A round takes one set of each list as its pivot; the others of the list
   that are in no common component with it yet are verified against it. Links unite components, so a
   group of copies costs one verification for each copy and not one for each pair.
5. A set that was compared with its pivot keeps the difference. Two sets of one pivot are verified
   from their (small) differences: |a xor b| = |da| + |db| - 2 |da and db|.
6. Before the rounds, and again before pairs are listed, sets that cannot link (any more) leave the
   lists: a set's partners can share only those of its elements that a set of another component has
   too, which is counted over whole sets before any pair exists, and compared with what the sizes in
   its lists ask for. Two more rounds take the sets with the largest share of such elements as pivots,
   the least changed ones of a group of near copies. The pairs left in different components are
   verified one by one, so no link is lost.
7. ``op4_ngram_jaccard_join`` also counts each row's links. The members of a pivot are cut into blocks by
   the size of their differences. Sizes alone rule out some pairs of blocks and show that others link
   whole; two blocks of the rest meet in a task that counts links from their differences and
   writes a row for each set, none for a pair. Sets of different pivots are verified pair by pair where
   a list and whole sets' counts of shared elements leave a link possible. Pairs are counted and not
   returned; the pipeline's ``keep_one`` needs components only and does not count links.

All steps are joins and aggregations; sets of different texts that share no list are never built.

Edge cases: a text with fewer words than a shingle has one shingle of all its words; null, empty and
blank texts have an empty set, link with nothing and are their own component; repeated rows and
exact copies are one node; a null id never is a component's id unless all its ids are null; an
empty table gives no rows. Only ``doc_id`` and ``text`` are read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terracheck.llm.common import SLICE_BYTES, SPACE_TABLE, forget, fresh_name, pack_texts, read_table, shingle_hashes, text_slices, tokenise, unpack, word_hashes, written
from terracheck.llm.components import merge_labels
from terracheck.llm.registry import register

#: Bound on the broadcast frequent elements, and on those that one slice of text proposes.
HEAVY, HEAVY_OF_SLICE = 65_536, 4_096
ROUNDS = 2
#: Rounds with central pivots before the pairs that are left are verified.
CENTRAL_ROUNDS = 2
#: Sets of one pivot, and elements of their differences, that a block holds on average.
BLOCK_SETS, BLOCK_ELEMENTS = 512, 1 << 18
#: Bytes of text whose sets are made at once: hashing takes some 50 bytes of memory for each.
SET_BYTES = 1 << 19


def shingle_sets(raw: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Elements of all rows' sets, each row's sorted, and the edges between rows."""
    w = tokenise(raw, off, SPACE_TABLE)
    h, count = word_hashes(w), np.diff(w.first)
    size = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    edges = np.concatenate(([0], np.cumsum(size)))
    element = np.empty(int(edges[-1]), dtype=np.uint64)
    every = shingle_hashes(h, k)
    at = w.first[:-1] - edges[:-1]  # from a row's place here to its first word
    source = np.arange(len(element)) + np.repeat(at, size)
    whole = np.repeat(count >= k, size)
    element[whole] = every[source[whole]]
    for r in np.flatnonzero((count > 0) & (count < k)).tolist():
        element[edges[r]] = shingle_hashes(h[w.first[r] : w.first[r + 1]], int(count[r]))[0]
    for r in np.flatnonzero(size > 1).tolist():  # row by row: far faster than one sort by row and element
        element[edges[r] : edges[r + 1]].sort()
    new = np.ones(len(element), dtype=bool)
    new[1:] = element[1:] != element[:-1]
    new[edges[:-1][size > 0]] = True
    return element[new], np.concatenate(([0], np.cumsum(new)))[edges]


def heavy_elements(docs: DataFrame, k: int) -> np.ndarray:
    """At most ``HEAVY`` elements that several texts of a slice share, sorted; they come last in the
    global order, by count. Any choice gives the same links."""

    def count(batches):
        for batch in batches:
            sets, held, last = [], 0, batch.num_rows
            for _, j, raw, off in text_slices(batch.column(0), SET_BYTES):
                sets.append(shingle_sets(raw, off, k)[0])
                held += len(raw)
                if held < SLICE_BYTES and j < last:
                    continue
                element, n = np.unique(np.concatenate(sets), return_counts=True)
                sets, held = [], 0
                many = np.flatnonzero(n > 1)
                many = many[np.argsort(-n[many], kind="stable")[:HEAVY_OF_SLICE]]
                yield pa.RecordBatch.from_arrays([pa.array(element[many].view(np.int64)), pa.array(n[many])], names=["element", "n"])

    found = docs.select("text").mapInArrow(count, "element long, n long").groupBy("element").agg(F.sum("n").alias("n"))
    rows = found.orderBy(F.desc("n"), "element").limit(HEAVY).collect()
    out = np.array(sorted((r.element & (2**64 - 1), r.n) for r in rows), dtype=np.uint64).reshape(-1, 2)
    return out


def _shared_least(n):
    """How many elements of their prefixes two linked sets share, the smaller one of size ``n``."""
    return 1 + n * 3 // 100


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def prefixes(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """``doc_id, th, n, node, prefix``: text hash, set size, set id and the set's first elements of
    every row."""
    heavy = docs.sparkSession.sparkContext.broadcast(heavy_elements(docs, k))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = np.ascontiguousarray(heavy.value[:, 0]), heavy.value[:, 1]
        for batch in batches:
            for i, j, raw, off in text_slices(batch.column(2), SET_BYTES):
                element, edges = shingle_sets(raw, off, k)
                size = np.diff(edges)
                keep = np.where(size > 0, np.minimum(size, size - -(-size * num // den) + _shared_least(size)), 0)
                node = [xxhash.xxh3_64_intdigest(element[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:])]
                at = np.minimum(np.searchsorted(known, element), max(len(known) - 1, 0))
                weight = np.where(known[at] == element, rank[at], np.uint64(0)) if len(known) else np.zeros(len(element), np.uint64)
                first = first_elements(element, edges, weight, keep)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(keep))), pa.int32()), pa.array(element[first].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(size, pa.int64()), pa.array(np.array(node, dtype=np.uint64).view(np.int64)), lists],
                    names=["doc_id", "th", "n", "node", "prefix"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", _text_hash().alias("th"), "text").mapInArrow(scan, f"doc_id {id_type}, th long, n long, node long, prefix array<long>")


def first_elements(element: np.ndarray, edges: np.ndarray, weight: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Where each row's first ``keep`` elements by weight and element stand, row by row. A row's
    elements are sorted, and only rows with too few elements of weight 0 need another order."""
    size = np.diff(edges)
    light = np.concatenate(([0], np.cumsum(weight == 0)))
    before = light[:-1] - np.repeat(light[edges[:-1]], size)
    missing = keep - np.minimum(np.diff(light[edges]), keep)
    first = (weight == 0) & (before < np.repeat(keep, size))
    heavy = np.flatnonzero((weight > 0) & np.repeat(missing > 0, size))
    row = np.repeat(np.arange(len(size)), size)
    heavy = heavy[np.lexsort((element[heavy], weight[heavy], row[heavy]))]
    of = row[heavy]
    heavy = heavy[np.arange(len(of)) - np.searchsorted(of, of) < missing[of]]
    at = np.concatenate((np.flatnonzero(first), heavy))
    return at[np.argsort(row[at], kind="stable")]


def _possible(na, pa_, nb, pb, num: int, den: int) -> Column:
    """The sizes fit, and what is left from the shared element on can reach the threshold."""
    need = _needed(na, nb, num, den)
    sizes = F.expr(f"{den} * least({na}, {nb}) >= {num} * greatest({na}, {nb})")
    return sizes & (F.expr(f"least({na} - {pa_}, {nb} - {pb})") >= need)


def _needed(na: str, nb: str, num: int, den: int) -> Column:
    """How many elements two sets of these sizes share at least if they link."""
    return F.expr(f"({num} * ({na} + {nb}) + {num + den - 1}) div {num + den}")


def build_sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """``node, elements`` (packed 64-bit numbers, sorted) of the given ``(node, doc_id, th)`` rows."""

    def scan(batches):
        for batch in batches:
            for node, text in zip(batch.column(0), unpack(batch.column(1))):
                element, _ = shingle_sets(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]), k)
                yield pa.RecordBatch.from_arrays([pa.array([node.as_py()], pa.int64()), pa.array([element.tobytes()], pa.binary())], names=["node", "elements"])

    chosen = nodes.select(F.col("doc_id").alias("_doc"), F.col("th").alias("_th"), "node")
    packed = pack_texts(docs.select("doc_id", _text_hash().alias("th"), "text"))
    texts = packed.join(chosen, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("th") == F.col("_th"))).select("node", "text")
    return texts.dropDuplicates(["node"]).mapInArrow(scan, "node long, elements binary")


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, dtype=np.uint64)


def _common(x: bytes, y: bytes) -> int:
    return len(np.intersect1d(_unpack(x), _unpack(y), assume_unique=True))


def replaced(df: DataFrame, name: str, *done: DataFrame) -> DataFrame:
    """``df`` written; the tables ``done`` that only it reads are deleted after that."""
    out = written(df, name)
    for table in done:
        forget(table)
    return out


class Join:
    """The link search over the nodes of one prefix table."""

    def __init__(self, docs: DataFrame, table: DataFrame, k: int, num: int, den: int):
        self.num, self.den = num, den
        self.bucket = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(den / num)))
        nodes = table.where("n > 0").groupBy("node").agg(F.min(F.struct("doc_id", "th")).alias("one")).select("node", "one.*")
        # size and place share a number: all elements are shuffled once, and most are in one set only
        place = (F.col("n") * F.lit(1 << 32) + F.col("pos")).alias("place")
        rows = table.where("n > 0").select("node", "n", F.posexplode("prefix").alias("pos", "element")).select("element", "node", place)
        shared = rows.groupBy("element").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("element")
        # a table of its own: a join of two shuffles is one that Spark splits where a list is long
        lists = written(shared, "lists")
        posts = rows.join(lists, "element").groupBy("element", "node").agg(F.max("place").alias("place"))
        posts = posts.select("element", "node", F.shiftright("place", 32).alias("n"), F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).alias("pos")).withColumn("block", self.bucket)
        posts = replaced(posts, "shared", lists)
        posts = replaced(posts.join(self.enough(posts), "node", "left_semi"), "posts", posts)
        # sets that leave here link with no other set: all later steps see the few that stay
        rows = posts.withColumn("label", F.col("node"))
        rows = self.crowded(self.crowded(rows))
        forget(posts)
        self.sets = written(build_sets(docs, nodes.join(rows.select("node").distinct(), "node"), k), "sets")
        # posts with ``label``, the node itself, and ``shared``
        self.reach = self.narrowed(self.reachable(rows), 1)
        self.posts = self.reach.drop("label", "shared")
        self.labels = written(self.posts.select(F.col("node").alias("id"), F.col("node").alias("label")).distinct(), "labels")
        self.deltas: DataFrame | None = None

    def enough(self, posts: DataFrame) -> DataFrame:
        """``node`` of the sets with as many lists as a link asks for: a partner has num / den of a
        set's size at least."""
        least = F.expr(f"1 + ((n * {self.num} + {self.den - 1}) div {self.den}) * 3 div 100")
        return posts.groupBy("node").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n")).where(F.col("c") >= least).select("node")

    def crowded(self, rows: DataFrame) -> DataFrame:
        """``rows`` (posts with a label) of lists that hold another label in the same or the next
        block, of the sets with enough such lists."""
        ends = rows.groupBy("element", "block").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        near = ends.select("element", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("block"), "lo", "hi")
        near = near.groupBy("element", "block").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi").select("element", "block")
        mixed = written(rows.join(near, ["element", "block"], "left_semi"), "mixed")
        return replaced(mixed.join(self.enough(mixed), "node", "left_semi"), "crowded", mixed)

    def labelled(self) -> DataFrame:
        at = self.labels.select(F.col("id").alias("node"), "label")
        return self.posts.join(at, "node")

    def pivot_pairs(self, turn: int) -> DataFrame:
        """(a, pivot, lists): sets and the pivot of a block that they share, if it is possible."""
        rows = self.labelled() if turn else self.posts.withColumn("label", F.col("node"))
        best = F.struct(F.xxhash64(F.lit(turn), "node").alias("order"), F.col("node").alias("pivot"), F.col("n").alias("pn"), F.col("pos").alias("pp"), F.col("label").alias("plabel"))
        pivots = rows.groupBy("element", "block").agg(F.min(best).alias("p")).select("element", "block", "p.*").drop("order")
        pivots = written(pivots, "pivots-of-lists")
        joined = rows.join(pivots, ["element", "block"]).where((F.col("label") != F.col("plabel")) & _possible("n", "pos", "pn", "pp", self.num, self.den))
        return joined.groupBy(F.col("node").alias("a"), "pivot").agg(F.count(F.lit(1)).alias("lists"))

    def reachable(self, rows: DataFrame) -> DataFrame:
        """``rows`` (posts with a label) whose set can link with a set of another label in that list,
        with ``shared``: how many elements of the whole set sets of another label have too. A link
        needs that many shared elements on both sides."""
        num, den = self.num, self.den

        def elements(batches):
            for batch in batches:
                for node, label, x in zip(*batch.columns):  # one set at a time
                    element = _unpack(x.as_py()).view(np.int64)
                    same = [pa.array(np.full(len(element), y.as_py(), dtype=np.int64)) for y in (node, label)]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(element)], names=["node", "label", "element"])

        whole = self.sets.join(rows.select("node", "label").distinct(), "node").select("node", "label", "elements")
        whole = whole.mapInArrow(elements, "node long, label long, element long")
        common = whole.groupBy("element").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("element")
        common = written(common, "common")
        counted = whole.join(common, "element").groupBy("node").agg(F.count(F.lit(1)).alias("shared"))
        own = F.expr(f"(n * {num} + {den - 1}) div {den}")  # the least size of a partner, and the least that is shared with it
        kept = first = replaced(rows.join(counted, "node").where(F.col("shared") >= own), "reach", common)
        # the smallest set that shares a block or its neighbours asks for the least
        least = kept.groupBy("element", "block").agg(F.min("n").alias("m"))
        least = least.select("element", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("block"), "m")
        least = least.groupBy("element", "block").agg(F.min("m").alias("m"))
        kept = kept.join(least, ["element", "block"]).withColumn("m", F.greatest("m", own))
        kept = kept.where(F.col("shared") >= _needed("n", "m", num, den)).drop("m")
        mixed = kept.groupBy("element").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
        return replaced(kept.join(mixed.select("element"), "element", "left_semi"), "reachable", first)

    def narrowed(self, rows: DataFrame, times: int = 2) -> DataFrame:
        """:func:`crowded` and :func:`reachable` again on what they leave: fewer sets share fewer
        elements."""
        for _ in range(times):
            rows = self.reachable(self.crowded(self.crowded(rows.drop("shared"))))
        return rows

    def _pairs(self, rows: DataFrame, columns: tuple[str, ...], where: Column) -> DataFrame:
        """(a, b) of the possible pairs of a list; ``where`` sees the columns of one side and, with an
        ``l`` in front, of the other one."""
        names = ("node", "n", "pos", "block", "shared", *columns)
        left = rows.select("element", F.explode(F.array(F.col("block"), F.col("block") + 1)).alias("block"), *[F.col(c).alias(f"l{c}") for c in names])
        # within a block each pair once; from a block to the next one all pairs
        once = (F.col("lblock") < F.col("block")) | (F.col("lnode") < F.col("node"))
        reach = F.least("shared", "lshared") >= _needed("n", "ln", self.num, self.den)
        pairs = left.join(rows, ["element", "block"]).where(once & where & reach & _possible("n", "pos", "ln", "lpos", self.num, self.den))
        return pairs.select(F.least("lnode", "node").alias("a"), F.greatest("lnode", "node").alias("b")).distinct()

    def central_pairs(self, rows: DataFrame, turn: int) -> DataFrame:
        """(a, b): a set and the most central pivot of its lists that has another label. Central are
        sets that share most of their elements: the least changed of a group of near copies. ``turn``
        picks among equally central ones."""
        rows = rows.withColumn("central", F.floor(F.col("shared") * 20 / F.col("n")))
        best = F.struct("central", F.xxhash64(F.lit(turn), "node").alias("order"), F.col("node").alias("pivot"), F.col("n").alias("pn"), F.col("pos").alias("pp"), F.col("label").alias("plabel"))
        pivots = rows.groupBy("element", "block").agg(F.max(best).alias("p")).select("element", "block", F.col("p.central").alias("pc"), "p.order", "p.pivot", "p.pn", "p.pp", "p.plabel")
        joined = rows.join(written(pivots, "pivots-of-lists"), ["element", "block"])
        joined = joined.where((F.col("label") != F.col("plabel")) & _possible("n", "pos", "pn", "pp", self.num, self.den))
        return joined.groupBy(F.col("node").alias("a")).agg(F.max(F.struct("pc", "order", "pivot")).alias("p")).select("a", F.col("p.pivot").alias("b"))

    def open_pairs(self) -> DataFrame:
        """(a, b): every possible pair of a list that is in different components, after rounds with
        central pivots, which unite groups of near copies without their pairs."""
        rows = self.narrowed(self.labelled(), 1)
        for turn in range(CENTRAL_ROUNDS):
            self.settle(self.central_pairs(rows, turn))
            at = self.labels.select(F.col("id").alias("node"), "label")
            rows = replaced(self.crowded(rows.drop("label").join(at, "node")), "open", rows)
        return self._pairs(self.narrowed(rows), ("label",), F.col("label") != F.col("llabel"))

    def _with(self, pairs: DataFrame, column: str, table: DataFrame, key: str, payload: str) -> DataFrame:
        side = table.select(F.col(key).alias("_key"), F.col(payload).alias(f"{column}_{payload}"))
        return pairs.join(side, pairs[column] == F.col("_key")).drop("_key")

    def compare_with_pivots(self, pairs: DataFrame) -> DataFrame:
        """(a, b, linked, delta): each pair verified on whole sets, with the sets' difference."""
        num, den = self.num, self.den

        def verify(batches):
            for batch in batches:
                a, b = (batch.column(c).to_pylist() for c in range(2))
                linked, delta = [], []
                for x, y in zip(batch.column(2), batch.column(3)):  # one pair of sets at a time
                    s, t = x.as_py(), y.as_py()
                    n, m, both = len(s) // 8, len(t) // 8, _common(s, t)
                    linked.append(den * both >= num * (n + m - both))
                    delta.append(np.setxor1d(_unpack(s), _unpack(t), assume_unique=True).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(linked, pa.bool_()), pa.array(delta, pa.binary())], names=["a", "b", "linked", "delta"])

        whole = self._with(self._with(pairs.select("a", "b"), "a", self.sets, "node", "elements"), "b", self.sets, "node", "elements")
        return whole.select("a", "b", "a_elements", "b_elements").mapInArrow(verify, "a long, b long, linked boolean, delta binary")

    def first_round(self) -> None:
        """Each set meets the pivot that it shares most lists with, and keeps the difference."""
        pairs = self.pivot_pairs(0)
        best = pairs.groupBy("a").agg(F.max(F.struct("lists", "pivot")).alias("p")).select("a", F.col("p.pivot").alias("b"))
        done = written(self.compare_with_pivots(best), "pivots")
        self.keep_deltas(done)
        self.labels = merge_labels(self.labels, done.where("linked").select("a", "b"))
        self.drop_settled()

    def keep_deltas(self, done: DataFrame) -> None:
        """``deltas`` (id, pivot, delta) of compared sets and pivots."""
        own = done.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("pivot"), F.expr("cast('' as binary)").alias("delta"))
        # a pivot counts as its own; it is left out as a member of another one's
        members = done.select(F.col("a").alias("id"), F.col("b").alias("pivot"), "delta").join(own.select("id"), "id", "left_anti")
        self.deltas = written(members.unionByName(own), "deltas")

    def drop_settled(self) -> None:
        """Forget the lists whose sets are all in one component."""
        mixed = self.labelled().groupBy("element").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
        self.posts = written(self.posts.join(mixed.select("element"), "element", "left_semi"), "posts")

    def settle(self, pairs: DataFrame) -> None:
        """Verify pairs and unite links."""
        found = self.linked_pairs(pairs)
        if found is not None:
            self.labels = merge_labels(self.labels, found)

    def linked_pairs(self, pairs: DataFrame) -> DataFrame | None:
        """(a, b) of the pairs that link, verified from differences to a common pivot where there is
        one; None without pairs."""
        num, den = self.num, self.den
        size = self.sets.select("node", F.expr("octet_length(elements) div 8").alias("size"))
        kept = self.deltas.select("id", "pivot", "delta").join(size.withColumnRenamed("node", "id"), "id")
        a = kept.select(F.col("id").alias("a"), F.col("pivot").alias("ap"), F.col("delta").alias("ad"), F.col("size").alias("an"))
        b = kept.select(F.col("id").alias("b"), F.col("pivot").alias("bp"), F.col("delta").alias("bd"), F.col("size").alias("bn"))
        at_pivot = kept.select(F.col("id"), F.col("pivot").alias("pivot"))
        where = pairs.join(at_pivot.select(F.col("id").alias("a"), F.col("pivot").alias("ap")), "a", "left").join(at_pivot.select(F.col("id").alias("b"), F.col("pivot").alias("bp")), "b", "left")
        where = written(where.select("a", "b", F.coalesce(F.col("ap") == F.col("bp"), F.lit(False)).alias("near")), "pairs")
        if where.isEmpty():
            return None

        def derive(batches):
            for batch in batches:
                x, y, n, m = (batch.column(c).to_pylist() for c in (0, 1, 4, 5))
                hit = []
                for r, (s, t) in enumerate(zip(batch.column(2), batch.column(3))):
                    u, v = s.as_py(), t.as_py()
                    apart = (len(u) + len(v)) // 8 - 2 * _common(u, v)
                    both = (n[r] + m[r] - apart) // 2
                    if den * both >= num * (n[r] + m[r] - both):
                        hit.append(r)
                yield pa.RecordBatch.from_arrays([pa.array([x[r] for r in hit], pa.int64()), pa.array([y[r] for r in hit], pa.int64())], names=["a", "b"])

        near = where.where("near").select("a", "b").join(a.drop("ap"), "a").join(b.drop("bp"), "b").select("a", "b", "ad", "bd", "an", "bn").mapInArrow(derive, "a long, b long")
        far = self.compare_with_pivots(where.where("NOT near")).where("linked").select("a", "b")
        return near.unionByName(far)

    def blocks_of(self, members: DataFrame) -> DataFrame:
        """``members`` with ``block``: sets of one pivot whose differences are alike in share of the set,
        about ``BLOCK_SETS`` sets and ``BLOCK_ELEMENTS`` numbers of differences in each."""
        members = members.withColumn("band", F.floor(F.col("d") * 16 / F.col("n")))
        wanted = F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("d") / BLOCK_ELEMENTS)
        parts = members.groupBy("pivot", "band").agg(F.ceil(wanted).alias("parts"))
        salt = F.pmod(F.xxhash64("node"), F.col("parts"))
        return members.join(parts, ["pivot", "band"]).withColumn("block", F.shiftleft("band", 32) + salt).drop("band", "parts")

    def block_pairs(self, members: DataFrame) -> DataFrame:
        """(pivot, i, j, irows, jrows, certain) of the blocks of a pivot that can link: sizes and sizes of
        differences alone rule out the others. ``certain``: they show that all their sets link."""
        total, apart = self.num + self.den, self.den - self.num
        ends = [f(c).alias(f"{c}{k}") for c in ("n", "d") for f, k in ((F.min, 0), (F.max, 1))]
        one = members.groupBy("pivot", "block").agg(*ends, F.sum("c").alias("rows"), F.count(F.lit(1)).alias("k"))
        left = one.select("pivot", *[F.col(c).alias(f"i{c}") for c in one.columns[1:]])
        right = one.select("pivot", *[F.col(c).alias(f"j{c}") for c in one.columns[1:]])
        once = (F.col("iblock") < F.col("jblock")) | ((F.col("iblock") == F.col("jblock")) & (F.col("ik") > 1))
        sizes = F.expr(f"{self.den} * in1 >= {self.num} * jn0 AND {self.den} * jn1 >= {self.num} * in0")
        near = F.expr(f"greatest(id0 - jd1, jd0 - id1) * {total} <= (in1 + jn1) * {apart}")
        certain = F.expr(f"(id1 + jd1 + 2) * {total} <= (in0 + jn0) * {apart}")
        pairs = left.join(right, "pivot").where(once & sizes & near)
        return pairs.select("pivot", F.col("iblock").alias("i"), F.col("jblock").alias("j"), "irows", "jrows", certain.alias("certain"))

    def links_at_pivots(self, members: DataFrame) -> DataFrame:
        """``node, links``: rows of the other sets of its pivot that a set links with. ``members`` is
        ``node, pivot, d, n, c``. Blocks that link for certain are counted by their rows; of others two
        meet in a task, which has the shared numbers of all their differences from a matrix product
        and writes one row for each set."""
        num, den = self.num, self.den
        members = written(self.blocks_of(members), "blocks")
        pairs = written(self.block_pairs(members), "block-pairs")
        sure = pairs.where("certain")
        sure = sure.select("pivot", F.col("i").alias("block"), F.col("jrows").alias("o"), (F.col("i") == F.col("j")).cast("long").alias("itself")).unionByName(
            sure.where("i <> j").select("pivot", F.col("j").alias("block"), F.col("irows").alias("o"), F.lit(0).cast("long").alias("itself"))
        )
        sure = sure.groupBy("pivot", "block").agg(F.sum("o").alias("o"), F.sum("itself").alias("itself"))
        sure = members.join(sure, ["pivot", "block"]).select("node", (F.col("o") - F.col("itself") * F.col("c")).alias("links"))

        def count(table: pa.Table) -> pa.Table:
            delta = [_unpack(x.as_py()) for x in table["delta"]]
            node, n, c, side = (table[x].to_numpy() for x in ("node", "n", "c", "side"))
            d = np.array([len(x) for x in delta])
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            alone = not len(right)
            right = left if alone else right
            _, at, often = np.unique(np.concatenate(delta), return_inverse=True, return_counts=True)
            shared = often[at] > 1
            _, at = np.unique(at[shared], return_inverse=True)
            owner = np.repeat(np.arange(len(d)), d)[shared]
            order = np.argsort(at, kind="stable")
            at, owner = at[order], owner[order]
            both = np.zeros((len(left), len(right)), dtype=np.int64)
            for first in range(0, int(at[-1]) + 1 if len(at) else 0, 4096):
                a, b = np.searchsorted(at, (first, first + 4096))
                has = np.zeros((len(d), 4096), dtype=np.float32)
                has[owner[a:b], at[a:b] - first] = 1
                both += (has[left] @ has[right].T).astype(np.int64)
            total = n[left][:, None] + n[right][None, :]
            needed = -(-num * total // (num + den))
            hit = d[left][:, None] + d[right][None, :] - 2 * both <= total - 2 * needed
            if alone:
                np.fill_diagonal(hit, False)
                return pa.table({"node": node[left], "links": hit @ c[left]})
            return pa.table({"node": np.concatenate((node[left], node[right])), "links": np.concatenate((hit @ c[right], hit.T @ c[left]))})

        sides = F.array(F.struct(F.col("i").alias("block"), F.lit(0).alias("side")), F.struct(F.col("j").alias("block"), F.lit(1).alias("side")))
        meet = pairs.where("NOT certain").select("pivot", "i", "j", F.explode(sides).alias("one")).select("pivot", "i", "j", "one.*").where("i <> j OR side = 0")
        full = members.join(self.deltas.select(F.col("id").alias("node"), "pivot", "delta"), ["node", "pivot"])
        rows = full.join(meet, ["pivot", "block"]).select("pivot", "i", "j", "side", "node", "n", "c", "delta")
        return sure.unionByName(rows.groupBy("pivot", "i", "j").applyInArrow(count, "node long, links long"))

    def link_counts(self, copies: DataFrame) -> DataFrame:
        """``node, links``: rows of other sets that a set of ``reach`` links with; ``copies`` has
        the number of rows, ``(node, c)``, of each set. To be called after ``run``."""
        reach = self.reach
        self.keep_deltas(written(self.compare_with_pivots(self.central_pairs(reach, 0)), "pivots"))
        apart = self.deltas.select(F.col("id").alias("node"), "pivot", F.expr("octet_length(delta) div 8").alias("d"))
        sizes = self.sets.select("node", F.expr("octet_length(elements) div 8").alias("n"))
        members = written(apart.join(sizes, "node").join(copies, "node"), "members")
        counted = self.links_at_pivots(members)
        # sets of different pivots: pairs of a list, each once
        rows = reach.join(members.select("node", "pivot"), "node", "left")
        found = self.linked_pairs(self._pairs(rows, ("pivot",), ~F.coalesce(F.col("pivot") == F.col("lpivot"), F.lit(False))))
        if found is not None:
            found = written(found, "links")
            both = found.select(F.col("a").alias("of"), F.col("b").alias("node")).unionByName(found.select(F.col("b").alias("of"), F.col("a").alias("node")))
            counted = counted.unionByName(both.join(copies, "node").select(F.col("of").alias("node"), F.col("c").alias("links")))
        return counted.groupBy("node").agg(F.sum("links").alias("links"))

    def run(self, rounds: int = ROUNDS) -> DataFrame:
        """``id, label`` of every set that can link with another."""
        self.first_round()
        for turn in range(1, rounds):
            pairs = self.pivot_pairs(turn)
            best = pairs.groupBy("a").agg(F.max(F.struct("lists", "pivot")).alias("p")).select(F.least("a", "p.pivot").alias("a"), F.greatest("a", "p.pivot").alias("b"))
            self.settle(best.distinct())
            self.drop_settled()
        self.settle(self.open_pairs())
        return self.labels


def _labelled_rows(docs: DataFrame, k: int, num: int, den: int, rounds: int, links: bool = False) -> DataFrame:
    table = written(prefixes(docs, k, num, den), "prefixes")
    join = Join(docs, table, k, num, den)
    # from here on nobody reads the prefixes
    table = replaced(table.select("doc_id", "th", "n", "node"), "rows", table)
    labels = join.run(rounds).select(F.col("id").alias("node"), "label")
    rows = table.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    if not links:
        return rows
    copies = written(table.where("n > 0").groupBy("node").agg(F.count(F.lit(1)).alias("c")), "copies")
    counted = copies.join(join.link_counts(copies), "node", "left").select("node", (F.col("c") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    return rows.join(counted, "node", "left").withColumn("links", F.when(F.col("n") > 0, F.col("links")).otherwise(F.lit(0).cast("long")))


def _components(rows: DataFrame) -> DataFrame:
    least = rows.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "label", "left").withColumn("component_id", F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")))


def link_components(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    return _components(_labelled_rows(docs, k, num, den, rounds)).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def link_numbers(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row: the last is the number of other rows
    whose sets link with its set, exact copies included."""
    return _components(_labelled_rows(docs, k, num, den, rounds, True)).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("links").alias("n_links"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, rounds: int = ROUNDS) -> DataFrame:
    """One row of each component: that of the smallest id, nulls last, then of the smallest text
    hash. Rows with an empty set all stay."""
    rows = _labelled_rows(docs, k, num, den, rounds).where("n > 0")
    first = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("one"))
    keys = first.select(F.col("one.doc_id").alias("_doc"), F.col("one.th").alias("_th")).distinct()
    th, kept = fresh_name(docs, "th"), docs.columns
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    one = docs.where(worded).withColumn(th, _text_hash()).join(keys, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col(th) == F.col("_th")))
    return one.dropDuplicates(["doc_id", th]).select(*kept).unionByName(docs.where(~worded))


@register("op4_ngram_jaccard_join")
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, component and number of links of every document."""
    return link_numbers(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
