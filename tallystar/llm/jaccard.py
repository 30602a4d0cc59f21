"""Exact Jaccard join of shingle sets, with skipping by position and by set relations.

1. A first scan gives each document's set size and digest, and counts the sets that shingles are in. The most frequent
   shingles form a list of bounded size that only settles the order of shingles: rare first. Any order gives the same
   result.
2. A second scan sends the first ``n - ceil(0.75 n) + 1`` shingles of each set, and a parity bitmap of eight bits per
   shingle, to index lists. Two sets that reach the threshold share a list. Equal sets have equal entries and meet in
   every list, so a list keeps one of them, the smallest document.
3. In a list, entries are in the order of set size. Pairs are formed only within the size range that can reach the
   threshold, and a pair is skipped if what its two positions leave over can't reach the overlap that it needs
   (block skipping). Long lists only pair their sets with a few leaders at first.
4. Pairs whose bitmaps differ in more places than the threshold allows are dropped, the others are verified on the whole
   sets. A set that is verified to be highly similar to another shares its answer, the component. Only pairs of sets
   with different answers remain to be verified, and long lists are gone through again with these answers until none
   holds such a pair. For this, lists whose sets share one answer stay behind, and a long list is split into parts that
   meet two at a time in a cell of their own. The result needs no more than this: no pair of different components is left unchecked.

Shingles are compared by 64-bit hashes. Defined results: a null or empty text, or one without words, has 0 shingles and
is linked with nothing. Rows that share an id, or have none, are told apart by their numbers: each has the class of its own
text. The component is the smallest id in the class, null if no row of it has one. Repeated rows share a component. A text
of any length is one set. An empty table gives no rows; other input columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import texts
from tallystar.llm.components import components
from tallystar.llm.shingles import digest, mixed, shingle_sets
from tallystar.scratch import stage

PERCENT = 75
LOW = np.uint64(0xFFFFFFFF)
COUNTED_TO = np.uint64(int(0.36 * 2**64))  # smaller shingles are counted; larger ones are hardly ever in a prefix
FREQUENT = 3  # sets that a shingle must be in to be listed as frequent
FREQUENT_LIST = 1 << 20  # length of the list that goes to all tasks
BYTES_PER_WORD = 6
LIST_ENTRIES = 1 << 20  # entries of a partition of index lists
HELD_ENTRIES = 1 << 20
SHORT_LIST = 24  # sets of a list that pairs all of them at once
LEADERS = 4
OPEN_PER_SET = 2048  # pairs that a long list may leave open per set before it is thinned out
OWN_LISTS = 16  # long lists of a set, the smallest numbers first, that tell which list gives a pair
CELL_ROWS = 1 << 15  # of a part of a long list; every two parts that hold different answers meet in a cell
ROUNDS = 6  # that a long list is thinned out by leaders before all its open pairs are formed
FILTER_BITS = 1 << 24  # of the filter for the sets that verification needs


def needed(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The overlap that two sets of these sizes need."""
    return -(-PERCENT * (n_a + n_b) // (100 + PERCENT))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    for batch in batches:
        yield texts(batch, "doc_id"), shingle_sets([(t or "").encode() for t in texts(batch, "text")])


def _rows(**columns: np.ndarray | pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


# ---- first scan ---------------------------------------------------------------------------------------------


def _tokens(shingles: np.ndarray, lists: int) -> np.ndarray:
    """The index list of each shingle and 32 bits of it, in one number. Equal shingles stay equal; others may meet."""
    spread = mixed(shingles)
    return ((spread >> np.uint64(32)) % np.uint64(lists)).astype(np.int64) << 32 | (spread & LOW).astype(np.int64)


def _by_list(tokens: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each list with the places of its tokens."""
    by = np.argsort(tokens >> 32, kind="stable")
    for own in np.split(by, np.flatnonzero(np.diff(tokens[by] >> 32)) + 1):
        yield int(tokens[own[0]] >> 32), own


def _survey(lists: int):
    """A row per document (size, digest), and rows without one: what is to be counted for each index list."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0

        def counted() -> pa.RecordBatch:
            tokens = _tokens(np.concatenate(list(held.values())), lists)
            parts = [(k, tokens[own].astype(np.uint32).tobytes()) for k, own in _by_list(tokens)] if len(tokens) else []
            none = pa.nulls(len(parts), pa.int64())
            names, blobs = pa.array([k for k, _ in parts], pa.int64()), pa.array([v for _, v in parts], pa.binary())
            return _rows(row=none, n=none, digest=none, list=names, tokens=blobs)

        for ids, sets in _sets(batches):
            digests = [digest(s) for s in sets]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            none = pa.nulls(len(ids), pa.int64())
            row = {"row": pa.array(ids, pa.int64()), "n": sizes, "digest": pa.array(digests, pa.int64())}
            yield _rows(**row, list=none, tokens=pa.nulls(len(ids), pa.binary()))
            for d, s in zip(digests, sets, strict=True):
                if len(s) and d not in held:
                    held[d] = s[: np.searchsorted(s, COUNTED_TO)]
                    size += len(held[d])
            if size >= HELD_ENTRIES:
                yield counted()
                held, size = {}, 0
        if held:
            yield counted()

    return work


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of each list that are in at least ``FREQUENT`` sets."""
    for number, table in _by_key(batches, "list"):
        tokens = np.concatenate([np.frombuffer(b, dtype=np.uint32) for b in table.column("tokens").to_pylist()])
        found, n = np.unique(tokens, return_counts=True)
        found, n = found[n >= FREQUENT], n[n >= FREQUENT]
        yield _rows(token=number << 32 | found.astype(np.int64), n=n.astype(np.int64))


# ---- second scan --------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Order:
    """Tokens of frequent shingles in ascending order with their counts: rare shingles come first."""

    tokens: np.ndarray
    counts: np.ndarray
    lists: int

    def prefix(self, shingles: np.ndarray) -> np.ndarray:
        """The first shingles of a set, among which any set that reaches the threshold has one."""
        n = len(shingles)
        length = n - -(-PERCENT * n // 100) + 1
        if len(self.tokens):
            own = _tokens(shingles, self.lists)
            at = np.minimum(np.searchsorted(self.tokens, own), len(self.tokens) - 1)
            counts = np.where(self.tokens[at] == own, self.counts[at], 0)
            if counts.any():
                return shingles[np.lexsort((shingles, counts))[:length]]
        return shingles[:length]


def bitmap(shingles: np.ndarray) -> bytes:
    """Parity of the shingles in each of 8 n places (rounded up to a power of two)."""
    bits = max(64, 1 << int(8 * len(shingles) - 1).bit_length())
    counts = np.bincount((mixed(shingles) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1, bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the size of the symmetric difference."""
    x, y = sorted((np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _entries(order, lists: int):
    """Rows ``list``, ``entries``: the entries of one of ``lists`` lists from some rows, as bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        size = 0

        def emit() -> pa.RecordBatch:
            docs = np.array([(i, d, n) for (n, d), (i, _) in held.items()], dtype=np.int64)
            prefixes = [p for _, p in held.values()]
            lengths = np.array([len(p) for p in prefixes])
            tokens = np.concatenate(prefixes)
            owner = np.repeat(np.arange(len(docs)), lengths)
            place = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            key = _tokens(tokens, lists)
            names, parts = [], []
            for number, own in _by_list(key):
                used, local = np.unique(owner[own], return_inverse=True)
                parts.append(
                    np.array([len(used), len(own)]).tobytes()
                    + docs[used].tobytes()
                    + key[own].astype(np.uint32).tobytes()
                    + local.astype(np.uint32).tobytes()
                    + place[own].astype(np.uint32).tobytes()
                )
                names.append(number)
            return _rows(list=pa.array(names, pa.int64()), entries=pa.array(parts, pa.binary()))

        for ids, sets in _sets(batches):
            for i, s in zip(ids, sets, strict=True):
                if i is None or not len(s):
                    continue
                key = len(s), digest(s)
                if key in held:
                    held[key] = min(i, held[key][0]), held[key][1]
                else:
                    held[key] = i, order.value.prefix(s)
                    size += len(held[key][1])
            if size >= HELD_ENTRIES:
                yield emit()
                held, size = {}, 0
        if held:
            yield emit()

    return work


# ---- index lists --------------------------------------------------------------------------------------------


def _unpack(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token, smallest document of the set, size and position of each entry, in the order of token and size."""
    docs, tokens, owners, places = [], [], [], []
    base = 0
    for blob in blobs:
        n_docs, n = np.frombuffer(blob, dtype=np.int64, count=2).tolist()
        at = 16
        docs.append(np.frombuffer(blob, dtype=np.int64, count=3 * n_docs, offset=at).reshape(-1, 3))
        at += 24 * n_docs
        tokens.append(np.frombuffer(blob, dtype=np.uint32, count=n, offset=at))
        owners.append(np.frombuffer(blob, dtype=np.uint32, count=n, offset=at + 4 * n).astype(np.int64) + base)
        places.append(np.frombuffer(blob, dtype=np.uint32, count=n, offset=at + 8 * n))
        base += n_docs
    doc = np.concatenate(docs)
    order = np.lexsort((doc[:, 0], doc[:, 1], doc[:, 2]))
    first = np.append(True, (np.diff(doc[order, 1]) != 0) | (np.diff(doc[order, 2]) != 0))
    smallest = np.empty(len(doc), dtype=np.int64)
    smallest[order] = doc[order[first], 0][np.cumsum(first) - 1]
    token, owner, place = np.concatenate(tokens), np.concatenate(owners), np.concatenate(places).astype(np.int64)
    rep, n = smallest[owner], doc[owner, 2]
    order = np.lexsort((rep, n, token))
    token, rep, n, place = token[order], rep[order], n[order], place[order]
    keep = np.append(True, (np.diff(token.astype(np.int64)) != 0) | (np.diff(rep) != 0))  # one of equal sets
    return token[keep], rep[keep], n[keep], place[keep]


def reachable(n_a: np.ndarray, at_a: np.ndarray, n_b: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """Whether sets with a common shingle at these positions can still have the overlap that they need."""
    most = np.minimum(at_a, at_b) + 1 + np.minimum(n_a - at_a - 1, n_b - at_b - 1)
    return most >= needed(n_a, n_b)


class Pairs:
    """Pairs of one list partition, each once, with the number of lists that they share there."""

    def __init__(self) -> None:
        self.low, self.high = [], []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.low.append(np.minimum(a, b))
        self.high.append(np.maximum(a, b))

    def batch(self, **more: pa.Array) -> pa.RecordBatch:
        low = np.concatenate([np.zeros(0, dtype=np.int64), *self.low])
        high = np.concatenate([np.zeros(0, dtype=np.int64), *self.high])
        order = np.lexsort((high, low))
        low, high = low[order], high[order]
        first = np.append(True, (np.diff(low) != 0) | (np.diff(high) != 0))[: len(low)]
        starts = np.flatnonzero(first)
        shared = np.diff(np.append(starts, len(low)))
        return _rows(a=low[first], b=high[first], shared=shared.astype(np.int64))


def _priority(ids: np.ndarray, round_: int) -> np.ndarray:
    """The same order of leaders in every list, so that lists of similar sets agree on them."""
    return mixed(ids.view(np.uint64) + mixed(np.array([round_], dtype=np.uint64)))


def _in_blocks(groups: Iterator[tuple[int, list[bytes]]]) -> Iterator[pa.RecordBatch]:
    """Pairs of short lists, pairs with leaders of long lists, and the entries of long lists."""
    nulls = lambda n, kind: pa.nulls(n, kind)
    for number, blobs in groups:
        token, rep, n, place = _unpack(blobs)
        starts = np.flatnonzero(np.append(True, np.diff(token.astype(np.int64)) != 0))
        lengths = np.diff(np.append(starts, len(token)))
        length = np.repeat(lengths, lengths)
        pairs = Pairs()
        for step in range(1, SHORT_LIST):
            i = np.flatnonzero((length[:-step] <= SHORT_LIST) & (token[:-step] == token[step:]))
            if not len(i):
                break
            j = i + step
            fits = reachable(n[i], place[i], n[j], place[j])
            pairs.add(rep[i[fits]], rep[j[fits]])
        for start, size in zip(starts[lengths > SHORT_LIST], lengths[lengths > SHORT_LIST], strict=True):
            own = np.arange(start, start + size)
            for leader in own[np.argsort(_priority(rep[own], 0), kind="stable")[:LEADERS]]:
                others = own[own != leader]
                fits = reachable(n[others], place[others], n[leader], place[leader])
                pairs.add(rep[others[fits]], np.full(int(fits.sum()), rep[leader]))
        found = pairs.batch()
        none = len(found)
        yield _rows(**{c: found.column(i) for i, c in enumerate(found.schema.names)}, list=nulls(none, pa.int64()), doc=nulls(none, pa.int64()), n=nulls(none, pa.int64()), place=nulls(none, pa.int64()))
        long = length > SHORT_LIST
        none = int(long.sum())
        if none:
            key = number << 32 | token[long].astype(np.int64)
            empty = {c: nulls(none, pa.int64()) for c in ("a", "b", "shared")}
            yield _rows(**empty, list=key, doc=rep[long], n=n[long], place=place[long])


def _by_key(batches: Iterator[pa.RecordBatch], *key: str) -> Iterator[tuple[int, pa.Table]]:
    """Consecutive rows of one key with its first number; memory holds one key's rows at a time."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        keys = np.stack([np.asarray(batch.column(batch.schema.get_field_index(k))) for k in key], axis=1)
        cuts = [0, *(np.flatnonzero(np.diff(keys, axis=0).any(axis=1)) + 1).tolist(), len(keys)] if len(keys) else [0]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if current is not None and keys[start].tolist() != current:
                yield current[0], pa.Table.from_batches(held)
                held = []
            current = keys[start].tolist()
            held.append(batch.slice(start, end - start))
    if held:
        yield current[0], pa.Table.from_batches(held)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _in_blocks((k, t.column("entries").to_pylist()) for k, t in _by_key(batches, "list"))


class Bitmaps:
    """The bitmaps of the sets of one list, by number of bits. Any two sets are compared at the smaller number."""

    def __init__(self, bits: list[bytes]):
        self.words = np.array([len(b) // 8 for b in bits])
        self.folded: dict[int, np.ndarray] = {}
        for words in sorted(set(self.words.tolist()), reverse=True):
            table = np.zeros((len(bits), words), dtype=np.uint64)
            for larger, held in self.folded.items():
                own = self.words >= larger
                table[own] = np.bitwise_xor.reduce(held[own].reshape(-1, larger // words, words), axis=1)
                break
            own = np.flatnonzero(self.words == words)
            table[own] = np.array([np.frombuffer(bits[i], dtype=np.uint64) for i in own])
            self.folded = {words: table} | self.folded

    def least_differences(self, i: int, others: np.ndarray) -> np.ndarray:
        found = np.zeros(len(others), dtype=np.int64)
        common = np.minimum(self.words[others], self.words[i])
        for words in set(common.tolist()):
            at = common == words
            table = self.folded[words]
            found[at] = np.bitwise_count(table[others[at]] ^ table[i]).sum(axis=1)
        return found


def _in_cells(answered: DataFrame) -> DataFrame:
    """The rows of long lists with different answers, once per cell (``list``, ``low``, ``high``) and with their ``part``.

    An answer of more than ``CELL_ROWS`` rows has parts of its own, the other answers of a list share parts. Parts of one
    answer don't meet, any other two parts meet in one cell. A shared part also meets itself.
    """
    sizes = answered.groupBy("list", "answer").agg(F.count("*").alias("rows"))
    parts = F.ceil(F.col("rows") / CELL_ROWS).cast("int")
    large = F.col("rows") > CELL_ROWS
    lists = sizes.groupBy("list").agg(
        F.count("*").alias("answers"),
        F.ceil(F.sum(F.when(~large, F.col("rows")).otherwise(0)) / CELL_ROWS).cast("int").alias("shared"),
        F.collect_list(F.when(large, F.struct("answer", parts.alias("parts")))).alias("large"),
    )
    owners = "concat(array_repeat(cast(null as long), shared), flatten(transform(large, x -> array_repeat(x.answer, x.parts))))"
    # Stored, so that the join has an exchange of its own and adaptive execution can split a long list.
    lists = stage(lists.where("answers > 1").select("list", F.expr(owners).alias("owners")), "open-lists")
    rows = answered.join(lists, "list")
    rows = rows.withColumn("owner", F.expr("if(array_contains(owners, answer), answer, cast(null as long))"))
    own = "filter(sequence(0, size(owners) - 1), i -> owners[i] <=> owner)"
    rows = rows.withColumn("mine", F.expr(own))
    rows = rows.withColumn("part", F.expr("mine[cast(pmod(xxhash64(doc), size(mine)) as int)]"))
    others = "filter(sequence(0, size(owners) - 1), i -> owners[i] is null or not (owners[i] <=> owner))"
    rows = rows.withColumn("other", F.explode(F.expr(others)))
    rows = rows.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    return rows.drop("owners", "owner", "mine", "other")


def _again(round_: int):
    """Pairs of long lists whose sets have different answers and that their bitmaps leave possible: all such pairs, or
    those with new leaders while they are many."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in _by_key(batches, "list", "low", "high"):
            doc, n, place, answer, part = (np.asarray(table.column(c)) for c in ("doc", "n", "place", "answer", "part"))
            low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
            _, answers = np.unique(answer, return_inverse=True)
            in_low, in_high = (np.bincount(answers[part == p], minlength=answers.max() + 1) for p in (low, high))
            unequal = int(in_low.sum()) * int(in_high.sum()) - int((in_low * in_high).sum())
            if low == high:
                unequal //= 2
            if not unequal:
                continue
            order = np.lexsort((doc, n))
            doc, n, place, answer, part = doc[order], n[order], place[order], answer[order], part[order]
            bitmaps = Bitmaps([table.column("bits")[int(i)].as_py() for i in order])
            own_lists = np.full((len(doc), OWN_LISTS), -1, dtype=np.int64)
            for row, i in enumerate(order.tolist()):
                first = table.column("own")[i].as_py()
                own_lists[row, : len(first)] = first
            largest = np.searchsorted(n, n * 100 // PERCENT, side="right")  # by size, the last partner of each set
            few = unequal <= OPEN_PER_SET * len(doc) or round_ >= ROUNDS
            chosen = np.arange(len(doc))
            if not few:
                chosen = np.argsort(_priority(doc, round_), kind="stable")[: 2 * LEADERS]
            for i in chosen.tolist():
                j = np.arange(i + 1, largest[i]) if few else np.flatnonzero(np.arange(len(doc)) != i)
                j = j[(answer[j] != answer[i]) & ((part[j] != part[i]) | (low == high))]
                j = j[reachable(n[j], place[j], n[i], place[i])]
                j = j[bitmaps.least_differences(i, j) <= n[j] + n[i] - 2 * needed(n[j], n[i])]
                # If the first lists of two sets meet, their smallest common list is among them: it alone gives the pair.
                shared = (own_lists[j][:, :, None] == own_lists[i][own_lists[i] >= 0]).any(axis=2)
                smallest = own_lists[j, shared.argmax(axis=1)]
                j = j[~shared.any(axis=1) | (smallest == number)]
                if len(j):
                    yield _rows(a=np.minimum(doc[j], doc[i]), b=np.maximum(doc[j], doc[i]), finished=pa.array([True] * len(j), pa.bool_()))
            if not few:
                yield _rows(a=doc[:1], b=doc[:1], finished=pa.array([False], pa.bool_()))

    return work


# ---- verification -------------------------------------------------------------------------------------------


def _filter_positions(ids: np.ndarray) -> Iterator[np.ndarray]:
    for k in range(3):
        yield (mixed(ids.view(np.uint64) + np.uint64(k)) % np.uint64(FILTER_BITS)).astype(np.int64)


def _filter_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(FILTER_BITS, dtype=bool)
    for batch in batches:
        for at in _filter_positions(np.asarray(batch.column(0))):
            bits[at] = True
    places = np.flatnonzero(np.packbits(bits))
    yield _rows(place=places.astype(np.int64), byte=np.packbits(bits)[places].astype(np.int64))


class Sets:
    """Whole sets of documents, made anew from the texts for those that are needed."""

    def __init__(self, docs: DataFrame):
        self.docs = docs

    def of(self, ids: DataFrame) -> DataFrame:
        """Columns ``doc``, ``shingles``. A filter of fixed size spares most other documents the work; where it is
        full, more sets are made than needed, and the join leaves them out."""
        parts = ids.mapInArrow(_filter_of, "place long, byte long").groupBy("place").agg(F.bit_or("byte").alias("byte"))
        bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
        found = parts.toArrow()  # at most FILTER_BITS / 8 rows
        bits[np.asarray(found["place"])] = np.asarray(found["byte"])
        shared = self.docs.sparkSession.sparkContext.broadcast(bits)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = np.unpackbits(shared.value).view(bool)
            for batch in batches:
                numbers = np.asarray(batch.column(0))
                wanted = np.logical_and.reduce([known[at] for at in _filter_positions(numbers)])
                own = batch.filter(pa.array(wanted))
                sets = [s.tobytes() for s in shingle_sets([t.encode() for t in texts(own, "text")])]
                yield _rows(doc=own.column(0), shingles=pa.array(sets, pa.binary()))

        rows = self.docs.where("doc_id is not null and text is not null").select("doc_id", "text")
        return rows.mapInArrow(work, "doc long, shingles binary")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            a, b = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
            common = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * common >= PERCENT * (len(a) + len(b) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, sets: Sets) -> DataFrame:
    """The pairs (a, b) that reach the threshold."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    whole = stage(sets.of(ids).dropDuplicates(["doc"]), "sets")
    both = pairs.select("a", "b").join(whole.toDF("a", "x"), "a").join(whole.toDF("b", "y"), "b")
    return stage(both.select("a", "b", "x", "y").mapInArrow(_verify, "a long, b long"), "verified")


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose bitmaps leave the threshold possible."""
    for batch in batches:
        n, m = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("n", "m"))
        most = n + m - 2 * needed(n, m)
        least = [least_difference(x, y) for x, y in zip(texts(batch, "x"), texts(batch, "y"), strict=True)]
        yield batch.select(["a", "b", "shared"]).filter(pa.array(np.array(least, dtype=np.int64) <= most))


def possible(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``pairs`` (a, b, shared) without those that the bitmaps rule out."""
    left, right = bitmaps.toDF("a", "n", "x"), bitmaps.toDF("b", "m", "y")
    schema = "a long, b long, shared long"
    return pairs.join(left, "a").join(right, "b").select("a", "b", "shared", "n", "m", "x", "y").mapInArrow(_alike, schema)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, sets in _sets(batches):
        yield _rows(
            doc=pa.array(ids, pa.int64()),
            n=pa.array([len(s) for s in sets], pa.int64()),
            bits=pa.array([bitmap(s) if len(s) else b"" for s in sets], pa.binary()),
        )


# ---- the join -----------------------------------------------------------------------------------------------


def _open(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """The pairs whose sets have different answers so far."""
    out = pairs.join(named.toDF("a", "of_a"), "a", "left").join(named.toDF("b", "of_b"), "b", "left")
    differ = F.coalesce("of_a", "a") != F.coalesce("of_b", "b")
    return out.where(differ).select(*pairs.columns)


def with_keys(df: DataFrame, doc_id: str) -> tuple[DataFrame, bool]:
    """``df`` with a column ``__key`` that tells its rows apart: the id where every row has one of its own (then the second
    value is true), else the number of the stored row."""
    rows, ids, different = df.agg(F.count("*"), F.count(doc_id), F.count_distinct(doc_id)).first()
    if rows == ids == different:
        return df.withColumn("__key", F.col(doc_id).cast("long")), True
    return stage(df.withColumn("__key", F.monotonically_increasing_id()), "rows"), False


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``n_shingles``, ``component_id``, the smallest id of the row's class."""
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows, by_id = with_keys(docs, "doc_id")
    found = classes(rows, "__key", "text")
    if by_id:
        return found.withColumnsRenamed({"key": "doc_id", "component": "component_id"})
    found = stage(found.join(rows.select("__key", "doc_id"), F.col("key") == F.col("__key")), "classes")
    least = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return found.join(least, "component").select("doc_id", "n_shingles", "component_id")


def classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` (unique, long), ``n_shingles`` and ``component``, the smallest key of the class, for each row of ``df``."""
    spark = df.sparkSession
    docs = df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lists = max(1, -(-size * (100 - PERCENT) // 100 // BYTES_PER_WORD // LIST_ENTRIES))
    survey = docs.mapInArrow(_survey(lists), "row long, n long, digest long, list long, tokens binary")
    survey = stage(survey, "survey")
    sizes = survey.where("list is null").select(F.col("row").alias("doc_id"), "n", "digest")
    tokens = survey.where("list is not null").select("list", "tokens").repartition(lists, "list")
    counts = stage(tokens.sortWithinPartitions("list").mapInArrow(_frequent, "token long, n long"), "frequent")
    top = counts.orderBy(F.desc("n"), "token").limit(FREQUENT_LIST).toArrow()
    found = np.asarray(top["token"]).astype(np.int64)
    by = np.argsort(found)
    order = spark.sparkContext.broadcast(Order(found[by], np.asarray(top["n"])[by], lists))

    entries = docs.mapInArrow(_entries(order, lists), "list long, entries binary")
    lists_rows = entries.repartition(lists, "list").sortWithinPartitions("list")
    schema = "a long, b long, shared long, list long, doc long, n long, place long"
    indexed = stage(lists_rows.mapInArrow(_index, schema), "index")
    pairs = indexed.where("list is null").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    long = indexed.where("list is not null").select("list", "doc", "n", "place")

    sets = Sets(docs)
    in_pairs = stage(pairs, "pairs")
    bitmaps = docs.mapInArrow(_bitmaps, "doc long, n long, bits binary").where("n > 0")
    firsts = sizes.where("n > 0").groupBy("n", "digest").agg(F.min("doc_id").alias("first"))
    wanted = in_pairs.select(F.explode(F.array("a", "b")).alias("doc")).union(long.select("doc")).distinct()
    bitmaps = stage(bitmaps.join(wanted, "doc", "left_semi").dropDuplicates(["doc"]), "bitmaps")
    candidates = stage(possible(in_pairs, bitmaps), "candidates")

    # Each set first meets the one that it shares most lists with; this alone gives most sets their answer.
    sides = candidates.select("a", "b", "shared").union(candidates.select("b", "a", "shared")).toDF("x", "y", "shared")
    best = sides.groupBy("x").agg(F.max_by("y", F.struct("shared", -F.col("y"))).alias("y"))
    best = best.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    links = verified(best, sets)
    named = stage(components(links), "answers")
    rest = _open(candidates.join(best, ["a", "b"], "left_anti"), named)
    links = links.union(verified(rest, sets))
    named = stage(components(links), "answers")

    own = F.slice(F.array_sort(F.collect_set("list")), 1, OWN_LISTS)
    about = stage(bitmaps.select("doc", "bits").join(long.groupBy("doc").agg(own.alias("own")), "doc"), "about")
    checked = candidates.select("a", "b")
    for round_ in range(1, ROUNDS + 1):
        answered = long.join(named.toDF("doc", "answer"), "doc", "left")
        answered = answered.withColumn("answer", F.coalesce("answer", "doc"))
        cell = ["list", "low", "high"]
        placed = _in_cells(answered).join(about, "doc").repartition(*cell).sortWithinPartitions(*cell)
        found = stage(placed.mapInArrow(_again(round_), "a long, b long, finished boolean"), "again")
        new = found.where("a <> b").select("a", "b").distinct().join(checked, ["a", "b"], "left_anti")
        new = stage(new, "open")
        if not new.isEmpty():
            links = links.union(verified(new, sets))
            named = stage(components(links), "answers")
        if found.where("not finished").isEmpty():
            break
        checked = checked.union(new)

    answers = firsts.join(named.toDF("first", "component"), "first", "left")
    answers = answers.select("n", "digest", F.coalesce("component", "first").alias("component"))
    linked = sizes.where("n > 0").join(answers, ["n", "digest"])
    alone = sizes.where("n = 0").withColumn("component", F.col("doc_id"))
    out = linked.select("doc_id", "n", "component").union(alone.select("doc_id", "n", "component"))
    return out.select(F.col("doc_id").alias("key"), F.col("n").alias("n_shingles"), "component")
