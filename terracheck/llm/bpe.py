"""Byte-level BPE encoding and decoding with a pair occurrence index.

The texts of a partition are taken in slices. A slice is cut into pieces (runs of letters, digits,
other signs or white space, with the space before them) by array operations on code point classes,
and each distinct piece is encoded once. All distinct pieces lie behind one another as linked lists
of symbols, initially bytes. An index maps each pair of adjacent symbols that the vocabulary merges
to the positions of all its occurrences. Ranks that occur are applied in ascending order: one step
merges a pair at all its positions, then adds the pairs that the new symbol forms with its
neighbours to the lists of their own ranks. A position whose pair has changed meanwhile is passed
over. A merge only ever forms pairs of higher ranks, which is checked when a vocabulary is read, so
the order is that of merging each piece by itself.

The vocabulary is a tokenizers JSON file: byte-level BPE without normaliser, prefix space or
dropout; its path is a parameter. Added tokens are found in the text first, longest first, and cut
it.

Edge cases: a null text is the empty text, with no tokens and an empty decoded text; long texts are
cut before a space or line feed that follows something else, where a piece ends in any case, so the
memory of a task depends on its longest piece; ids that are null or unknown decode to nothing;
repeated rows are encoded alike; an empty table gives no rows. All columns pass through; added ones
avoid their names."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from tokenizers.pre_tokenizers import ByteLevel

from terracheck.llm.common import fresh_name, read_table, text_slices
from terracheck.llm.registry import register

VOCABULARY = "byte_bpe_50k.json"
#: Bytes of text that are encoded at once.
ENCODE_BYTES = 8 << 20
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_CUT = re.compile(rb"(?<=[^\s])[\x20\x0A]")


def byte_names() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names, spare = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in names:
            names[b] = chr(spare)
            spare += 1
    return [names[b] for b in range(256)]


@cache
def code_point_classes() -> np.ndarray:
    """Class of each code point: letter, number, white space or other. Code points that this Python
    does not know yet are classed by the tokenizers library, whose Unicode tables may be newer."""
    out = np.full(0x110000, _OTHER, dtype=np.uint8)
    kinds = {"L": _LETTER, "N": _NUMBER, "Z": _SPACE}
    for point in range(0x110000):
        kind = kinds.get(category(chr(point))[0])
        if kind is not None:
            out[point] = kind
    out[[*range(0x09, 0x0E), 0x85]] = _SPACE
    unknown = [p for p in [*range(0x40000), *range(0xE0000, 0xF0000)] if category(chr(p)) == "Cn"]
    pieces = ByteLevel(add_prefix_space=False).pre_tokenize_str("".join(f"\na{chr(p)}\n1{chr(p)}" for p in unknown))
    begins = np.zeros(6 * len(unknown), dtype=bool)
    begins[[at for _, (at, _) in pieces]] = True
    for place, kind in ((2, _LETTER), (5, _NUMBER)):  # joins the letter, or the digit, before it
        out[np.array(unknown)[~begins[place::6]]] = kind
    return out


@dataclass
class Vocabulary:
    """The tables of a vocabulary, small enough to broadcast (some ten MB for 50,000 tokens)."""

    classes: np.ndarray  # by code point
    byte_ids: np.ndarray  # symbol of each byte
    keys: np.ndarray  # merged pairs as left << 32 | right, ascending
    ranks: np.ndarray  # their ranks
    left: np.ndarray  # by rank
    right: np.ndarray
    made: np.ndarray  # symbol that the rank's merge makes
    tokens: list[bytes]  # bytes of each id
    added: dict[bytes, int]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a tokenizers JSON file on the driver."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        odd += [k for k in ("normalizer", "post_processor") if spec.get(k)] + [t["content"] for t in spec["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"]]
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or odd:
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary {odd}")
        ids = model["vocab"]
        names = byte_names()
        value = {name: b for b, name in enumerate(names)}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [b""] * (max([*ids.values(), *added.values()]) + 1)
        for name, i in ids.items():
            tokens[i] = bytes(value[c] for c in name) if all(c in value for c in name) else name.encode()
        for name, i in added.items():
            tokens[i] = name.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, made = (np.array([ids[x] for x in column], dtype=np.int64) for column in (*zip(*pairs), [a + b for a, b in pairs]))
        made_at = np.full(len(tokens), -1)
        made_at[made[::-1]] = np.arange(len(made))[::-1]
        if (np.maximum(made_at[left], made_at[right]) >= np.arange(len(made))).any():
            raise ValueError(f"{path}: a merge comes before the symbols it joins")
        keys = left << 32 | right
        order = np.argsort(keys)
        return cls(
            code_point_classes(), np.array([ids[n] for n in names], dtype=np.int64), keys[order], order.astype(np.int32),
            left, right, made, tokens, {k.encode(): v for k, v in added.items()},
        )


def _runs(sorted_values: np.ndarray) -> tuple[list[int], list[int]]:
    """Distinct values and the start of each, with the length at the end."""
    starts = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))
    return sorted_values[starts].tolist(), [*starts.tolist(), len(sorted_values)]


class Codec:
    """Encodes slices of texts and decodes ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.added = re.compile(b"|".join(re.escape(t) for t in sorted(vocabulary.added, key=len, reverse=True))) if vocabulary.added else None

    def cut(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """First byte of each piece of the texts ``raw[off[i]:off[i + 1]]``, and the end of all."""
        heads = np.flatnonzero((raw & 0xC0) != 0x80)
        if len(heads) == len(raw):
            points = raw.astype(np.uint32)
        else:
            points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        n = len(points)
        kind = self.v.classes[points]
        edge = np.zeros(n + 1, dtype=bool)  # a text or an added token begins, or all ends
        edge[np.searchsorted(heads, off)] = True
        edge[n] = True
        inside = np.zeros(n, dtype=bool)  # of an added token, past its first code point
        if self.added:
            data = raw.tobytes()
            if self.added.search(data):
                for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                    for m in self.added.finditer(data[a:b]):
                        x, y = np.searchsorted(heads, (a + m.start(), a + m.end())).tolist()
                        edge[x] = edge[y] = True
                        inside[x + 1 : y] = True
        space = kind == _SPACE
        start = edge[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        # the last of several white spaces before something else is apart; a space joins what follows
        last = np.zeros(n, dtype=bool)
        last[:-1] = space[:-1] & ~space[1:] & ~edge[1:n]
        start |= last
        joins = last & (points == 0x20)
        start[1:] &= ~joins[:-1]
        # contractions: an apostrophe that begins a piece, and certain letters
        at = np.flatnonzero((points == 0x27) & start)
        at = at[at + 1 < n]
        at = at[~edge[at + 1]]
        one = points[at + 1]
        short = np.isin(one, np.frombuffer(b"stmd", dtype=np.uint8))
        two = points[np.minimum(at + 2, n - 1)]
        long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))) & ~edge[np.minimum(at + 2, n)]
        for where, length in ((at[short], 2), (at[long & ~short], 3)):
            start[where + 1] = False
            after = where + length
            start[after[after < n]] = True
        start &= ~inside
        return np.append(heads[start], len(raw))

    def merge(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the pieces ``raw[off[i]:off[i + 1]]`` and the offsets of each piece's."""
        v, n = self.v, len(raw)
        symbol = v.byte_ids[raw]
        after = np.arange(1, n + 1)
        after[off[1:][off[1:] > off[:-1]] - 1] = -1
        before = np.arange(-1, n - 1)
        before[off[:-1][off[1:] > off[:-1]]] = -1
        # the symbols of a pair only grow, so no position is listed twice for one rank
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(positions: np.ndarray) -> None:
            """Put the pairs that begin at ``positions`` into the lists of their ranks."""
            key = symbol[positions] << 32 | symbol[after[positions]]
            place = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
            known = v.keys[place] == key
            rank, positions = v.ranks[place[known]], positions[known]
            if not len(rank):
                return
            order = np.argsort(rank, kind="stable")
            positions = positions[order]
            values, starts = _runs(rank[order])
            for i, r in enumerate(values):
                listed = index.get(r)
                if listed is None:
                    index[r] = listed = []
                    heapq.heappush(active, r)
                listed.append(positions[starts[i] : starts[i + 1]])

        if len(v.keys):
            note(np.flatnonzero(after >= 0))
        while active:
            r = heapq.heappop(active)
            listed = index.pop(r)
            at = listed[0] if len(listed) == 1 else np.concatenate(listed)
            follow = after[at]
            at = at[(symbol[at] == v.left[r]) & (follow >= 0) & (symbol[follow] == v.right[r])]
            if not len(at):
                continue
            if v.left[r] == v.right[r] and len(at) > 1:  # in a run of one symbol, every other pair
                at = np.sort(at)
                fresh = np.concatenate(([True], after[at[:-1]] != at[1:]))
                begin = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - begin) % 2 == 0]
            gone = after[at]
            beyond = after[gone]
            symbol[at], symbol[gone] = v.made[r], -1
            after[at] = beyond
            more = beyond >= 0
            before[beyond[more]] = at[more]
            ahead = before[at]
            ahead = ahead[ahead >= 0]
            note(np.concatenate((ahead[symbol[ahead] != v.made[r]], at[more])))  # each position once
        alive = symbol >= 0
        return symbol[alive].astype(np.int32), np.concatenate(([0], np.cumsum(alive)))[off]

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``raw[off[i]:off[i + 1]]`` and the offsets of each text's."""
        if not len(raw):
            return np.zeros(0, dtype=np.int32), np.zeros(len(off), dtype=np.int64)
        ends = self.cut(raw, off)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw)])
        named = pieces.dictionary_encode()
        which = named.indices.to_numpy()
        words = named.dictionary.cast(pa.large_binary())
        first = np.frombuffer(words.buffers()[1], dtype=np.int64)[: len(words) + 1]
        ids, spans = self.merge(np.frombuffer(words.buffers()[2], dtype=np.uint8)[: first[-1]], first)
        begin, length = spans[:-1].copy(), np.diff(spans)
        if self.added:
            ids = np.concatenate((ids, np.array(list(self.v.added.values()), dtype=np.int32)))
            for k, token in enumerate(self.v.added):
                at = pa.compute.index(words, pa.scalar(token, pa.large_binary())).as_py()
                if at >= 0:  # such bytes are always cut out as the token
                    begin[at], length[at] = len(ids) - len(self.v.added) + k, 1
        sizes = length[which]
        total = np.concatenate(([0], np.cumsum(sizes)))
        out = ids[np.arange(total[-1]) + np.repeat(begin[which] - total[:-1], sizes)]
        return out, total[np.searchsorted(ends[:-1], off)]

    def decode(self, ids: np.ndarray) -> bytes:
        tokens = self.v.tokens
        return b"".join([tokens[i] for i in ids.tolist() if 0 <= i < len(tokens)])


def text_chunks(raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(bytes, offsets, whether the last text goes on) of a slice; a text that is longer than
    ``ENCODE_BYTES`` is cut before white space that follows something else."""
    at = 0
    while len(off) == 2 and len(raw) - at > ENCODE_BYTES:
        cut = _CUT.search(raw, at + ENCODE_BYTES)
        if cut is None:
            break
        yield raw[at : cut.start()], np.array([0, cut.start() - at]), True
        at = cut.start()
    yield raw[at:], off if at == 0 else np.array([0, len(raw) - at]), False


def _share(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(Vocabulary.read(path))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the token ids of each text, under a fresh name."""
    share, at = _share(docs.sparkSession, path), docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(fresh_name(docs, "ids"), T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(share.value)
        for batch in batches:
            for i, j, raw, off in text_slices(batch.column(at), ENCODE_BYTES):
                found = [codec.encode(r, o) for r, o, _ in text_chunks(raw, off)]
                ends = found[0][1] if len(found) == 1 else np.array([0, sum(len(f[0]) for f in found)])
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate([f[0] for f in found])))
                yield pa.RecordBatch.from_arrays([c.slice(i, j - i) for c in batch.columns] + [ids], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of the token ids, under a fresh name."""
    share, at = _share(rows.sparkSession, path), rows.columns.index(ids)
    schema = T.StructType([*rows.schema.fields, T.StructField(fresh_name(rows, "decoded"), T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(share.value)
        for batch in batches:
            listed = [np.array([-1 if i is None else i for i in x.as_py() or []], dtype=np.int64) for x in batch.column(at)]
            texts = [codec.decode(x).decode("utf-8", "replace") for x in listed]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` without its text and with ``n_tokens, ids_sha256, decoded_sha256`` under fresh names."""
    share, at = _share(docs.sparkSession, path), docs.columns.index(text)
    kept = [i for i in range(len(docs.columns)) if i != at]
    added = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    schema = T.StructType([docs.schema.fields[i] for i in kept] + [T.StructField(fresh_name(docs, n), kind) for n, kind in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(share.value)
        for batch in batches:
            counts, id_sums, text_sums = [], [], []
            for _, _, raw, off in text_slices(batch.column(at), ENCODE_BYTES):
                n, by_ids, by_text = 0, hashlib.sha256(), hashlib.sha256()
                for part, ends, goes_on in text_chunks(raw, off):
                    ids, spans = codec.encode(part, ends)
                    for a, b in zip(spans[:-1].tolist(), spans[1:].tolist()):
                        n += b - a
                        by_ids.update(ids[a:b].astype("<u4").tobytes())
                        # whole pieces decode to whole characters, so parts can be decoded apart
                        by_text.update(codec.decode(ids[a:b]).decode("utf-8", "replace").encode())
                        if not goes_on:
                            counts.append(n)
                            id_sums.append(by_ids.hexdigest())
                            text_sums.append(by_text.hexdigest())
                            n, by_ids, by_text = 0, hashlib.sha256(), hashlib.sha256()
            columns = [pa.array(counts, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in kept] + columns, names=schema.names)

    return docs.mapInArrow(run, schema)


@register("op12_bpe_codec")
def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded texts of all documents."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, public_tokenizers.path(VOCABULARY))
