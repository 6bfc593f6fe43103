"""Suffix-array dedup: repeated byte strings, found by deep-shallow sorting of suffixes.

A string of ``LENGTH`` bytes always holds the same minimizer, the smallest hash among its
``GRAM``-grams, wherever it occurs.  So equal strings can meet by minimizer: only suffixes
below minimizers that occur in more than one text are sorted, each bucket of minimizers in
one group.  Steps, each a Spark stage over all documents:

1. every text's minimizers go to buckets, which tell the texts the repeated ones; of equal
   texts only that of the smallest doc_id takes part;
2. the bytes around those go to buckets, which sort the suffixes and find each string's
   smallest doc_id; around a minimizer of very many places every string goes by its own
   bytes, so that no bucket grows with a minimizer;
3. the covered ranges go back to the texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.llm.common import materialize, read_table, slices

LENGTH = 50
GRAM = 20
SHALLOW = 3                # words of eight bytes that the multikey quicksort looks at
CHUNK = 1 << 23            # bytes of text whose minimizers are found together
BLOCK = 1 << 17            # bytes hashed at once, at some 200 bytes of arrays each, which a CPU's cache holds
BUCKET_BYTES = 1 << 23     # text whose minimizers meet in one bucket of the first stage, on average at most
BUCKETS = 1 << 8           # of the first stage where fewer would do: each takes a row of each chunk
HOT = 1 << 14              # surroundings of one minimizer from which its strings are dealt out one by one
GROUP = 1 << 15            # surroundings that a bucket gets on average at most
SPLIT = 1 << 18            # strings of such minimizers that are compared at once before they are sent
MARKS = 1 << 27            # bits that tell the hot minimizers, at most
LOWEST = -(1 << 63)        # stands for a null doc_id, below all others
_POS = np.uint64(0xFFFFFF)  # low bits of a sort key, the place in a chunk


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit hash of every ``gram`` bytes, from the hashes of halves."""
    part, mult, size = data.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
    out, done, left = None, 0, gram
    while left:
        if left & 1:
            n = len(data) - done - size + 1
            out = part[:n] if out is None else out[:n] * np.uint64(mult) + part[done:done + n]
            done += size
        left >>= 1
        if left:
            n = len(data) - 2 * size + 1
            part = part[:n] * np.uint64(mult) + part[size:size + n]
            mult, size = mult * mult & (1 << 64) - 1, 2 * size
    for _ in range(2):
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values, size = np.minimum(values[:len(values) - size], values[size:]), 2 * size
    rest = width - size
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def minimizers(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring strings with one minimizer: (text number, start of the first
    string, number of strings, hash).  Every string of ``length`` bytes is in one run."""
    out: list[tuple[np.ndarray, ...]] = []
    size = min(BLOCK, int(_POS)) // 2

    def chunk(parts: list[tuple[int, int, bytes]]) -> None:
        data = np.frombuffer(b"".join(x for _, _, x in parts), np.uint8)
        if len(data) < length:
            return
        lens = np.array([len(x) for _, _, x in parts])
        offset = np.cumsum(lens) - lens
        stop = offset + np.maximum(0, lens - length + 1)
        hashes = _gram_hashes(data, gram)
        key = (hashes & ~_POS) | np.arange(len(hashes), dtype=np.uint64)
        owner = _sliding_min(key, length - gram + 1) & _POS
        # A run ends where the minimizer changes, or the text has no further string.
        cut = np.unique(np.concatenate([offset, stop, np.flatnonzero(owner[1:] != owner[:-1]) + 1]))
        cut = cut[cut < len(owner)]
        which = np.searchsorted(offset, cut, "right") - 1
        count = np.diff(np.append(cut, len(owner)))
        inside = cut < stop[which]
        cut, which = cut[inside], which[inside]
        number = np.array([k for k, _, _ in parts])[which]
        at = cut - offset[which] + np.array([a for _, a, _ in parts])[which]
        out.append((number, at, count[inside], hashes[owner[cut].astype(np.int64)]))

    held: list[tuple[int, int, bytes]] = []
    total = 0
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), size):
            piece = text[at:at + size + length - 1]  # pieces of a long text share length - 1 bytes
            if total + len(piece) > 2 * size:
                chunk(held)
                held, total = [], 0
            held.append((k, at, piece))
            total += len(piece)
    if held:
        chunk(held)
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(x) for x in zip(*out))


def seed_id(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """A seed's bucket, and 40 bits that tell it from others there, in one number."""
    low = np.uint64((1 << 40) - 1)
    return ((hashes >> np.uint64(40)) % np.uint64(buckets)) << np.uint64(40) | (hashes & low)


def multikey_quicksort(word, n: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``n`` strings by their first ``depth`` words, and the starts of equal runs.

    ``word(level, items)`` gives a word of the strings ``items``.  All open segments are
    split at once, each by its own pivot into smaller, equal and larger; the equal part goes
    on with the next word.
    """
    order = np.arange(n)
    starts, levels = np.zeros(min(n, 1), np.int64), np.zeros(min(n, 1), np.int64)
    done: list[np.ndarray] = []
    ends = np.full(len(starts), n)
    while len(starts):
        closed = (ends - starts < 2) | (levels >= depth)
        done.append(starts[closed])
        starts, ends, levels = starts[~closed], ends[~closed], levels[~closed]
        if not len(starts):
            break
        size = ends - starts
        at = np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())
        seg = np.repeat(np.arange(len(starts)), size)
        items = order[at]
        value = np.empty(len(at), np.uint64)
        for level in np.unique(levels):
            mine = (levels == level)[seg]
            value[mine] = word(int(level), items[mine])
        base = np.cumsum(size) - size
        three = np.stack([value[base], value[base + size // 2], value[base + size - 1]])
        pivot = np.sort(three, axis=0)[1][seg]
        side = (value >= pivot).astype(np.int8) + (value > pivot)
        counts = np.stack([np.add.reduceat(side == k, base, dtype=np.int64) for k in range(3)], axis=1)
        begin = starts[:, None] + np.cumsum(counts, axis=1) - counts
        for k in range(3):
            mine = np.flatnonzero(side == k)
            owner = seg[mine]
            rank = np.arange(len(mine)) - np.concatenate(([0], np.cumsum(counts[:, k])[:-1]))[owner]
            order[begin[owner, k] + rank] = items[mine]
        live = counts.ravel() > 0
        starts = begin.ravel()[live]
        ends = starts + counts.ravel()[live]
        levels = (levels[:, None] + np.array([0, 1, 0])).ravel()[live]
    return order, np.sort(np.concatenate(done)) if done else np.zeros(0, np.int64)


def blind_trie_order(strings: list[bytes]) -> list[int]:
    """Order of distinct strings of one length, by a trie that keeps only branching places.

    A string goes down blindly by the bytes at the branching places to some leaf; one
    comparison with that leaf shows where it really leaves the path, and there it branches.
    """
    root: int | list = 0  # a leaf is a string's number, a node is [place, {byte: child}]
    for k in range(1, len(strings)):
        s = strings[k]
        node = root
        while not isinstance(node, int):
            node = node[1].get(s[node[0]], next(iter(node[1].values())))
        other = strings[node]
        lcp = next(i for i in range(len(s)) if s[i] != other[i])
        parent, node = None, root
        while not isinstance(node, int) and node[0] < lcp:
            parent, node = node, node[1][s[node[0]]]
        if not isinstance(node, int) and node[0] == lcp:
            node[1][s[lcp]] = k
            continue
        branch = [lcp, {other[lcp]: node, s[lcp]: k}]
        if parent is None:
            root = branch
        else:
            parent[1][s[parent[0]]] = branch
    out: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, int):
            out.append(node)
        else:
            stack += [node[1][b] for b in sorted(node[1], reverse=True)]
    return out


def sort_suffixes(data: bytes, places: np.ndarray, length: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings of ``length`` bytes at ``places`` of ``data``, and a mark at the
    first of each run of equal ones: shallow multikey quicksort, then blind tries."""
    raw = data + b"\0" * 8
    eight = np.ndarray((len(data) + 1,), ">u8", raw, strides=(1,))  # eight bytes from every place on

    words: dict[int, np.ndarray] = {}

    def word(level: int, items: np.ndarray) -> np.ndarray:
        if level not in words:
            beyond = np.uint64(max(0, 64 * level + 64 - 8 * length))
            words[level] = eight[places + 8 * level].astype(np.uint64) >> beyond << beyond
        return words[level][items]

    order, starts = multikey_quicksort(word, len(places), min(shallow, -(-length // 8)))
    new = np.zeros(len(order), bool)
    new[starts] = True
    ends = np.append(starts[1:], len(order))
    wide = ends - starts > 1
    starts, ends = starts[wide], ends[wide]
    size = ends - starts
    at = np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())
    begin = np.cumsum(size) - size
    first = np.repeat(begin, size)
    side = np.zeros(len(at), np.int8)  # of each string to the first of its group: equal, below or above
    for level in range(shallow, -(-length // 8)):
        value = word(level, order[at])
        side = np.where(side == 0, (value > value[first]).astype(np.int8) - (value < value[first]), side)
    differ = np.add.reduceat(side != 0, begin) > 0 if len(begin) else np.zeros(0, bool)
    # Two different strings need no trie.
    two = differ & (size == 2)
    low = starts[two]
    swap = low[side[begin[two] + 1] < 0]
    order[swap], order[swap + 1] = order[swap + 1], order[swap]
    new[low + 1] = True
    more = differ & (size > 2)
    for lo, hi in zip(starts[more].tolist(), ends[more].tolist()):
        members = order[lo:hi].tolist()
        equal: dict[bytes, list[int]] = {}
        for m, place in zip(members, places[order[lo:hi]].tolist()):
            equal.setdefault(data[place:place + length], []).append(m)
        strings = list(equal)
        for k in blind_trie_order(strings):
            same = equal[strings[k]]
            order[lo:lo + len(same)] = same
            new[lo] = True
            lo += len(same)
    return order, new


def perhaps_repeated(data: bytes, places: np.ndarray, length: int) -> np.ndarray:
    """Which of the strings of ``length`` bytes at ``places`` may be equal to another there: all
    that are, and up to a fifth of the others, whose hashes share a slot by chance."""
    if not len(places):
        return places
    bits = int(4 * len(places)).bit_length()
    raw = np.frombuffer(data, np.uint8)
    hashes = [_gram_hashes(raw[at:at + BLOCK + length - 1], length) >> np.uint64(64 - bits)
              for at in range(0, len(raw) - length + 1, BLOCK)]
    slot = np.concatenate(hashes)[places].astype(np.int64)
    last = np.empty(1 << bits, np.int32)
    number = np.arange(len(places), dtype=np.int32)
    last[slot] = number
    shared = np.zeros(1 << bits, bool)
    shared[slot[last[slot] != number]] = True
    return np.flatnonzero(shared[slot])


def covered(contexts: list[bytes], keys: np.ndarray, which: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Ranges of bytes of records that smaller keys hold too: (record, from, to).

    Record r has the bytes ``contexts[which[r]]`` and the key ``keys[r]``; a range is covered
    if each of its bytes is in a string of ``length`` bytes that a record of a smaller key
    has.  Equal contexts are sorted once, with their smallest key.
    """
    low = np.full(len(contexts), np.iinfo(np.int64).max)
    np.minimum.at(low, which, keys)
    size = np.array([len(c) for c in contexts])
    count = size - length + 1
    owner = np.repeat(np.arange(len(contexts)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    data, places = b"".join(contexts), (np.cumsum(size) - size)[owner] + inside
    more = perhaps_repeated(data, places, length)
    order, new = sort_suffixes(data, places[more], length)
    order, first = more[order], np.flatnonzero(new)
    least = np.minimum.reduceat(low[owner[order]], first) if len(first) else np.zeros(0, np.int64)
    smallest = np.full(len(owner), np.iinfo(np.int64).max)
    smallest[order] = np.repeat(least, np.diff(np.append(first, len(order))))
    # A record above its context's smallest key is covered whole.
    above = np.flatnonzero(keys > low[which])
    hit = smallest < low[owner]
    edge = np.flatnonzero(hit & np.concatenate(([True], ~hit[:-1] | (owner[1:] != owner[:-1]))))
    stop = np.flatnonzero(hit & np.concatenate((~hit[1:] | (owner[1:] != owner[:-1]), [True])))
    rest = np.flatnonzero(keys == low[which])
    rest = rest[np.argsort(which[rest], kind="stable")]
    begin, end = (np.searchsorted(which[rest], owner[edge], side) for side in ("left", "right"))
    times = end - begin
    run = np.repeat(np.arange(len(edge)), times)
    record = rest[np.repeat(begin - np.cumsum(times) + times, times) + np.arange(times.sum())]
    return (np.concatenate([above, record]), np.concatenate([np.zeros(len(above), np.int64), inside[edge][run]]),
            np.concatenate([size[which[above]], inside[stop][run] + length]))


def merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges, as maximal ranges in order."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]


def _blobs(data: np.ndarray | bytes, sizes: np.ndarray) -> pa.Array:
    """``data`` cut into binary values of ``sizes`` bytes."""
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    data = data if isinstance(data, bytes) else np.ascontiguousarray(data).view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _joined(table: pa.Table, column: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column without nulls, one after the other, and the bytes of each row."""
    sizes = [np.zeros(0, np.int64)]
    data = []
    for part in table.column(column).chunks:
        ends = np.frombuffer(part.buffers()[1], np.int32)[part.offset:part.offset + len(part) + 1] if len(part) else np.zeros(1, np.int32)
        sizes.append(np.diff(ends).astype(np.int64))
        if ends[-1] > ends[0]:
            data.append(memoryview(part.buffers()[2])[int(ends[0]):int(ends[-1])])
    return np.frombuffer(b"".join(data), kind), np.concatenate(sizes)


def _cuts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal neighbours."""
    at = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))[:len(values)])
    return at, np.diff(np.append(at, len(values)))


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[dict]]:
    """Rows in lists of about ``size`` bytes of text."""
    held, total = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            held.append(row)
            total += len(row["text"])
            if total >= size:
                yield held
                held, total = [], 0
    if held:
        yield held


def _opened(batches: Iterator[pa.RecordBatch], carry: list[str]) -> Iterator[pa.RecordBatch]:
    """``carry`` and the texts that ``packed`` has compressed."""
    unpress = zstandard.ZstdDecompressor()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            text = pa.array([unpress.decompress(z.as_py()) for z in some.column("z")], pa.binary())
            yield pa.RecordBatch.from_arrays([*(some.column(c) for c in carry), text], names=[*carry, "text"])


def repeated_seeds(texts: DataFrame, first: DataFrame, length: int, gram: int, buckets: int) -> DataFrame:
    """(key, h1, h2, seeds, n): the minimizers of each text that occur in another text too, as
    ``seeds`` of eight bytes each.  Rows without a key have the seeds of more than ``HOT`` runs,
    and in ``n`` the number of runs of all repeated ones.

    ``first`` (h1, h2, key, n) has the smallest key of equal texts and their number; other
    copies are left out, as they would make all that they hold look repeated.  A Bloom filter
    tells the texts that may have copies, so that only these are joined.

    A task tells of a seed once for each chunk of texts, and passes on itself what a chunk
    shows to be repeated, so a seed that very many texts hold makes no large group.  A chunk
    and a bucket share one row, however many seeds that has.
    """
    spark = texts.sparkSession
    ident = ["key", "h1", "h2"]
    long = texts.select(*ident, "text").where(F.octet_length("text") >= length)
    twice = first.where("n > 1")
    copied = twice.count()
    marks = spark.sparkContext.broadcast(mark_seeds(twice.select(F.col("h1").alias("seed")), copied))

    def sieve(batches: Iterator[pa.RecordBatch], want: bool) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(marked(marks.value, batch.column("h1").to_numpy().view(np.uint64)) == want))

    def tell(batches: Iterator[pa.RecordBatch], branch: int) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for number, rows in enumerate(_chunks(batches, CHUNK)):
            single: dict[tuple, dict] = {}
            for row in rows:
                old = single.setdefault((row["h1"], row["h2"]), row)
                if row["key"] < old["key"]:
                    single[row["h1"], row["h2"]] = row
            rows = list(single.values())
            chunk = task + 2 * number + branch
            text, _, _, hashes = minimizers([r["text"] for r in rows], length, gram)
            seed = seed_id(hashes, buckets)
            order = np.argsort(seed, kind="stable")  # texts stay in order
            text, seed = text[order], seed[order]
            at, n = _cuts(seed)
            other = text != np.repeat(text[at], n)
            many = np.repeat(np.logical_or.reduceat(other, at), n) if len(at) else other
            many &= np.concatenate(([True], (seed[1:] != seed[:-1]) | (text[1:] != text[:-1])))[:len(seed)]
            bucket = (seed[at] >> np.uint64(40)).astype(np.int64)
            cut, size = _cuts(bucket)
            # The last row goes to no bucket in particular: repeated seeds, and whose texts these are.
            more = int(many.sum())
            low = seed[at].view(np.uint8).reshape(-1, 8)[:, :5]
            sizes = lambda width, last: np.append(size * width, last)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.append(bucket[cut], zlib.crc32(chunk.to_bytes(8, "little")) % buckets), pa.int32()), pa.array(np.full(len(cut) + 1, chunk)),
                _blobs(low.tobytes() + seed[many].tobytes(), sizes(5, 8 * more)),
                _blobs(np.append(text[at], text[many]).astype(np.uint32), sizes(4, 4 * more)),
                _blobs(np.minimum(n, 0xFFFF).astype(np.uint16), sizes(2, 0)),
                _blobs(np.array([[r[c] for c in ident] for r in rows], np.int64).ravel(), sizes(0, 24 * len(rows)))],
                names=["bucket", "chunk", "seed", "text", "times", "ids"])

    def judge(group: pa.Table) -> pa.Table:
        bucket = group["bucket"][0].as_py()
        whose = pa.compute.binary_length(group["ids"])
        test = group.filter(pa.compute.equal(whose, 0))
        low, size = _joined(test, "seed", np.uint8)
        seed = np.zeros((len(low) // 5, 8), np.uint8)
        seed[:, :5] = low.reshape(-1, 5)
        seed = seed.view(np.uint64).ravel() | np.uint64(bucket) << np.uint64(40)
        text, times = _joined(test, "text", np.uint32)[0], _joined(test, "times", np.uint16)[0]
        chunk = np.repeat(test["chunk"].to_numpy(), size // 5)
        order = np.argsort(seed, kind="stable")
        at, n = _cuts(seed[order])
        sums = np.add.reduceat(times[order].astype(np.int64), at) if len(at) else at
        hot = seed[order][at[sums > HOT]]
        many = np.sort(order[np.repeat(n > 1, n)])  # a chunk names a seed once
        seed, text, chunk = seed[many], text[many], chunk[many]
        cut, size = _cuts(chunk)
        none, figures = np.zeros(len(cut), np.int64), [-1 - bucket // BUCKETS]
        tables = [pa.table({"chunk": pa.array(chunk[cut]), "seed": _blobs(seed, 8 * size), "text": _blobs(text, 4 * size),
                            "ids": _blobs(b"", none), "n": pa.array(none)}),
                  pa.table({"chunk": pa.array(figures, pa.int64()), "seed": _blobs(hot, np.array([8 * len(hot)])), "text": _blobs(b"", np.zeros(1)),
                            "ids": _blobs(b"", np.zeros(1)), "n": pa.array([int(sums[sums > 1].sum())], pa.int64())})]
        passed = group.filter(pa.compute.greater(whose, 0)).select(["chunk", "seed", "text", "ids"])
        return pa.concat_tables([*tables, passed.append_column("n", pa.array(np.zeros(len(passed), np.int64)))])

    def gather(group: pa.Table) -> pa.Table:
        seed, size = _joined(group, "seed", np.int64)
        if group["chunk"][0].as_py() < 0:
            none = pa.nulls(len(size), pa.int64())
            return pa.table({"key": none, "h1": none, "h2": none, "seeds": _blobs(seed, size), "n": group["n"]})
        text, ids = _joined(group, "text", np.uint32)[0], _joined(group, "ids", np.int64)[0].reshape(-1, 3)
        order = np.argsort(text, kind="stable")
        at, n = _cuts(text[order])
        ids = ids[text[order][at]]
        return pa.table({**{c: pa.array(ids[:, k]) for k, c in enumerate(ident)}, "seeds": _blobs(seed[order], 8 * n),
                         "n": pa.array(np.zeros(len(at), np.int64))})

    kind = "bucket int, chunk long, seed binary, text binary, times binary, ids binary"
    told = long.mapInArrow(lambda batches: tell(sieve(batches, False), 0), kind)
    if copied:
        # Written, so that a task that runs again cuts the same chunks.
        those = packed(long, ident, lambda batches: sieve(batches, True))
        held = materialize(those.join(first.select(*ident), ident).dropDuplicates(ident), "suffix-copied")
        told = told.union(held.mapInArrow(lambda batches: tell(_opened(batches, ident), 1), kind))
    found = told.groupBy("bucket").applyInArrow(judge, "chunk long, seed binary, text binary, ids binary, n long")
    return found.groupBy("chunk").applyInArrow(gather, "key long, h1 long, h2 long, seeds binary, n long")


def _mark_places(seeds: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for mult in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9):
        x = (seeds ^ (seeds >> np.uint64(31))) * np.uint64(mult)
        yield (x >> np.uint64(24)) & np.uint64(bits - 1)


def mark_seeds(seeds: DataFrame, count: int) -> np.ndarray:
    """A Bloom filter of the column ``seed``, of at most ``MARKS`` bits however many seeds there
    are, put together in Spark.  A seed marked by chance is dealt out like a hot one, which
    gives the same ranges."""
    bits = 64
    while bits < min(MARKS, 16 * count):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(list(_mark_places(batch.column("seed").to_numpy().view(np.uint64), bits))))
            word = (at >> np.uint64(6)).view(np.int64)
            new = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))[:len(word)]
            mark = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), new) if len(new) else at
            yield pa.RecordBatch.from_arrays([pa.array(word[new]), pa.array(mark.view(np.int64))], names=["word", "mark"])

    out = np.zeros(bits // 64, np.uint64)
    if count:
        rows = seeds.select("seed").mapInArrow(run, "word long, mark long").groupBy("word").agg(F.bit_or("mark").alias("mark")).toArrow()
        out[rows["word"].to_numpy()] = rows["mark"].to_numpy().view(np.uint64)
    return out


def marked(marks: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    out = np.ones(len(seeds), bool)
    for at in _mark_places(seeds, 64 * len(marks)):
        out &= (marks[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The seeds of packed ones."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_joined(pa.table(batch.columns, batch.schema.names), "seeds", np.int64)[0])], names=["seed"])


def packed(texts: DataFrame, carry: list[str], sieve: Callable | None = None) -> DataFrame:
    """``carry`` and the compressed text: what a shuffle of whole texts moves; of the rows that ``sieve`` lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(1)
        for batch in sieve(batches) if sieve else batches:
            z = pa.array([press.compress(t.as_py()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), z], names=[*carry, "z"])

    fields = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in carry)
    return texts.select(*carry, "text").mapInArrow(run, f"{fields}, z binary")


def repeated_ranges(texts: DataFrame, first: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(key, h1, h2, starts, ends): the ranges of each text that a smaller key's text covers;
    ``first`` as in ``repeated_seeds``.  In between a text goes by a number."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(1 << 24, max(min(BUCKETS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-size // BUCKET_BYTES)))
    seeds = materialize(repeated_seeds(texts, first, length, gram, buckets).withColumn(
        "number", F.monotonically_increasing_id()), "suffix-seeds")
    ident = ["key", "h1", "h2"]
    figures = seeds.where(F.col("key").isNull())
    total, hot = figures.agg(F.sum("n"), F.sum(F.octet_length("seeds"))).first()
    marks = spark.sparkContext.broadcast(mark_seeds(figures.mapInArrow(one_by_one, "seed long"), (hot or 0) // 8))
    groups = max(buckets, -(-(total or 0) // GROUP))
    met = packed(texts, ident).join(seeds.where(F.col("key").isNotNull()).select(*ident, "number", "seeds"), ident).select(
        "key", "number", "seeds", "z")

    names = ["bucket", "n", "whole", "z"]

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(_opened(batches, ["key", "number", "seeds"]), CHUNK):
            text, start, count, hashes = minimizers([r["text"] for r in rows], length, gram)
            seed = seed_id(hashes, buckets)
            # All texts that hold a repeated seed are told of it, so a chunk's seeds are those of each text.
            want = np.unique(np.frombuffer(b"".join(r["seeds"] for r in rows), np.uint64))
            slot = np.zeros(1 << 22, bool)
            slot[(want & np.uint64(len(slot) - 1)).astype(np.int64)] = True
            hit = np.flatnonzero(slot[(seed & np.uint64(len(slot) - 1)).astype(np.int64)])
            hit = hit[np.isin(seed[hit], want)]
            text, start, count, seed, hashes = text[hit], start[hit], count[hit], seed[hit], None
            ids = np.array([[r["key"], r["number"]] for r in rows], np.int64)
            raw = [r["text"] for r in rows]
            many = marked(marks.value, seed)
            alone = np.flatnonzero(~many)
            bucket = ((seed[alone] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)
            yield from dealt(raw, ids, bucket, text[alone], start[alone], count[alone])
            hit, step = np.flatnonzero(many), max(1, SPLIT // (length - gram + 1))
            for lo in range(0, len(hit), step):
                part = hit[lo:lo + step]
                n = count[part]
                owner = np.repeat(text[part], n)
                place = np.repeat(start[part] - np.cumsum(n) + n, n) + np.arange(n.sum())
                least = np.repeat(smallest([raw[t][a:a + k + length - 1] for t, a, k in zip(
                    text[part].tolist(), start[part].tolist(), n.tolist())], ids[text[part], 0])[0], n)
                open_ = np.flatnonzero(least)
                strings = [raw[t][a:a + length] for t, a in zip(owner[open_].tolist(), place[open_].tolist())]
                least[open_], which, known = smallest(strings, ids[owner[open_], 0])
                bucket = np.array([zlib.crc32(x) % groups for x in known], np.int64)[which[least[open_]]]
                yield from dealt(raw, ids, bucket, owner[least], place[least], np.ones(least.sum(), np.int64))
                yield from settled(ids, owner[~least], place[~least])

    def smallest(strings: list[bytes], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Which strings have the smallest key of equal ones; each one's number among the different ones; these."""
        known: dict[bytes, int] = {}
        which = np.array([known.setdefault(x, len(known)) for x in strings], np.int64)
        low = np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(low, which, keys)
        return keys == low[which], which, list(known)

    def dealt(raw: list[bytes], ids: np.ndarray, bucket: np.ndarray, text: np.ndarray, start: np.ndarray,
              count: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(bucket, kind="stable")
        bucket, text, start, count = bucket[order], text[order], start[order], count[order]
        cut, size = _cuts(bucket)

        def part(at: slice) -> tuple:
            t, a, n = text[at], start[at], count[at]
            return ids[t], a, n, [raw[i][lo:hi] for i, lo, hi in zip(t.tolist(), a.tolist(), (a + n + length - 1).tolist())]

        yield from rows_of(bucket[cut], False, (part(slice(lo, lo + n)) for lo, n in zip(cut.tolist(), size.tolist())))

    def rows_of(bucket: np.ndarray, whole: bool, parts: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
        """A row for each part (ids, starts, counts, bodies), in one compressed value."""
        press = zstandard.ZstdCompressor(1)
        rows = [(len(start), press.compress(b"".join([
            ids.T.tobytes(), start.astype(np.int32).tobytes(), count.astype(np.int32).tobytes(), *body])))
            for ids, start, count, body in parts]
        for lo in range(0, len(rows), 1024):
            n, z = zip(*rows[lo:lo + 1024])
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[lo:lo + 1024], pa.int32()), pa.array(n, pa.int32()), pa.array([whole] * len(n)), pa.array(z, pa.binary())], names=names)

    def settled(ids: np.ndarray, text: np.ndarray, start: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Strings that a smaller key of the same chunk has, as ranges without a body."""
        if not len(text):
            return
        order = np.lexsort((start, text))
        text, start = text[order], start[order]
        first = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (start[1:] > start[:-1] + length))))
        last = np.append(first[1:], len(text)) - 1
        size = start[last] + length - start[first]
        yield from rows_of(np.array([int(text[0] + start[0]) % groups]), True, [(ids[text[first]], start[first], size, [])])

    def judge(group: pa.Table) -> pa.Table:
        unpress = zstandard.ZstdDecompressor()
        which: list[int] = []
        known: dict[bytes, int] = {}
        ids, starts, done = [], [], []
        for n, whole, z in zip(*(group[c].to_pylist() for c in names[1:])):
            blob = unpress.decompress(z)
            who = np.frombuffer(blob, np.int64, 2 * n).reshape(2, -1)
            start, count = np.frombuffer(blob, np.int32, 2 * n, 16 * n).reshape(2, -1)
            if whole:
                done.append(ranges(who[1], start, start + count))
                continue
            ids.append(who)
            starts.append(start)
            ends = (np.cumsum(count + length - 1) + 24 * n).tolist()
            which += [known.setdefault(blob[a:b], len(known)) for a, b in zip([24 * n, *ends], ends)]
        if not ids:
            return pa.concat_tables(done)
        ids, start = np.concatenate(ids, axis=1), np.concatenate(starts)
        record, lo, hi = covered(list(known), ids[0], np.array(which), length)
        return pa.concat_tables([*done, ranges(ids[1, record], start[record] + lo, start[record] + hi)])

    def ranges(number: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Table:
        return pa.table({k: pa.array(x, pa.int64()) for k, x in (("number", number), ("lo", lo), ("hi", hi))})

    sent = met.mapInArrow(contexts, "bucket int, n int, whole boolean, z binary")
    found = sent.groupBy("bucket").applyInArrow(judge, "number long, lo long, hi long").groupBy("number").agg(
        F.collect_list("lo").alias("starts"), F.collect_list("hi").alias("ends"))
    return found.join(seeds.select("number", *ident), "number").select(*ident, "starts", "ends")


def text_identity(docs: DataFrame) -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("key"), F.xxhash64(text).alias("h1"),
            F.xxhash64(F.lit(1), text).alias("h2"), text.cast("binary").alias("text")]


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, starts, ends, kept): the removed byte ranges and the bytes left.

    A byte goes if it is in a string of ``length`` bytes that also starts in a document with
    a smaller doc_id.  A document equal to one of a smaller id goes whole, if it is long
    enough; only the first of equal texts is looked at further.

    Nulls and odd input: a null text is empty; a null doc_id is smaller than all others;
    rows that share a doc_id never remove from each other; strings never cross rows; other
    columns are not read; an empty table gives an empty result.  Texts are told apart by two
    64-bit hashes.
    """
    texts = docs.select("doc_id", *text_identity(docs))
    ident = texts.select("key", "h1", "h2")
    first = materialize(ident.groupBy("h1", "h2").agg(F.min("key").alias("key"), F.count("*").alias("n")), "suffix-first")
    ranges = materialize(repeated_ranges(texts, first, length, gram), "suffix-ranges")
    # Written, as Spark splits a hot key of a join only if both sides come straight from a shuffle.
    known = materialize(first.join(ranges, ["key", "h1", "h2"], "left").select(
        "h1", "h2", F.col("key").alias("first"), "starts", "ends"), "suffix-texts")
    met = packed(texts, ["doc_id", "key", "h1", "h2"]).join(known, ["h1", "h2"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in slices(batches):
            out = []
            for key, first, starts, ends, z in zip(*(batch.column(c) for c in ("key", "first", "starts", "ends", "z"))):
                text = unpress.decompress(z.as_py())
                lo, hi = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if key.as_py() > first.as_py():
                    if len(text) >= length:
                        lo, hi = np.array([0]), np.array([len(text)])
                elif starts.is_valid:
                    lo, hi = merge(starts.values.to_numpy(), ends.values.to_numpy())
                marks = np.concatenate(([0], np.stack([lo, hi], axis=1).ravel(), [len(text)])).tolist()
                kept = b"".join([text[a:b] for a, b in zip(marks[::2], marks[1::2])])
                out.append((len(text), lo.tolist(), hi.tolist(), kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(
                    zip(*out), (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())))],
                names=["doc_id", "n_bytes", "starts", "ends", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return met.mapInArrow(cut, f"doc_id {kind}, n_bytes long, starts array<long>, ends array<long>, kept binary")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda acc, x: acc + x)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
q AS (SELECT doc_id, unnest(range((length(x) // 2 + 255) // 256)) AS k, x FROM d),
y AS (SELECT doc_id, k, substr(x, 512 * k + 1, {512 + 2 * LENGTH}) AS z FROM q),
b AS (SELECT doc_id, k, z, unnest(range(least(256, length(z) // 2))) AS j FROM y),
s AS (SELECT doc_id, 256 * k + j AS p, substr(z, 2 * j + 1, {2 * LENGTH}) AS g, substr(z, 2 * j + 1, 2) AS byte FROM b),
m AS (SELECT g, min(doc_id) AS low FROM s WHERE length(g) = {2 * LENGTH} GROUP BY g HAVING min(doc_id) <> max(doc_id)),
f AS (SELECT s.doc_id, s.p, s.byte, m.low < s.doc_id AS hit FROM s LEFT JOIN m ON s.g = m.g),
c AS (SELECT doc_id, p, byte, coalesce(max(CASE WHEN hit THEN p END) OVER (PARTITION BY doc_id ORDER BY p) > p - {LENGTH}, false) AS gone FROM f),
r AS (SELECT doc_id, p, byte, gone, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens FROM c)
SELECT d.doc_id, length(any_value(d.x)) // 2 AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed,
       count(*) FILTER (WHERE opens) AS n_spans,
       sha256(unhex(coalesce(string_agg(byte, '' ORDER BY p) FILTER (WHERE NOT gone), ''))) AS kept_sha256
FROM d LEFT JOIN r ON d.doc_id = r.doc_id GROUP BY d.doc_id
"""
