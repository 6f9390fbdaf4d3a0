"""Exact Jaccard join of word-shingle sets (operator 8).

Documents of equal sets form a class. Two sets that link share a shingle among
their first ones in any fixed order (the prefix filter): for the smaller one the
first n - ceil(2Pn / (100+P)) + 1, for the larger one the first
n - ceil(Pn / 100) + 1, where P is the percentage. The order goes by frequency,
rare first, as a table of counters over all documents has it (a shingle's
counter also counts some others). What is known of frequencies only changes the
work, never the result.

With ``NEED - 1`` shingles more, two sets that link share NEED of them. One that
is shared by chance is what a growing input has ever more of, and it would chain
most documents together; two are seldom. So sets of at least DEEP shingles show
one more, and two of them are tied by two.

First shingles travel as packed, sorted arrays by key range. Sets that meet
often enough in bands of sizes that may link are tied to each other, and what is
tied together is a family: sets of different families never link. Where more
than RUN sets hold a shingle it ties them by itself, so pairs aren't counted
there. A family's texts meet in one task. There its sets form tiles in the order of their sizes; two
tiles whose sizes may link are held against each other by hashed bitmaps (each
bit that only one side has is a shingle the other lacks), and the pairs that
these don't rule out are decided by intersecting the sorted arrays. Pairs that
other links have already joined are passed over: the links found connect all
documents that link, and pairs never become rows.

A family over ``most`` shingles is dealt to several tasks, block against block.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, roots
from .pretoken import mixed
from .shared import partitions, possibly_in, released, temporary, written
from .shingles import Shingler, byte_groups

#: Counters of shingle frequencies, 2 bytes each where they are sent: 8 MB at any size of the input.
COUNTERS = 1 << 22
CHUNK_COUNTERS = 1 << 16
BATCH_SHINGLES = 1 << 20
#: First shingles that a task holds until it packs them, and those of a range of keys.
CHUNK_KEYS, RANGE_KEYS = 1 << 20, 2 << 20
#: Sizes of a band differ by less than 5 %.
STEP = math.log(1.05)
#: Shingles that sets of at least DEEP (the least size of a band) share if they link; holders of one up to which pairs are counted; entries that do so at once.
NEED, DEEP, RUN, SLICE = 2, 16, 16, 1 << 18
#: Holders of a shingle in a task's chunk and band, beyond which one stands for all; the flag of those that do.
CROWD, STANDS = 8, 1 << 13
#: Weight of a family that one task compares; a set weighs its shingles and BASE more.
MOST, BASE = 4 << 20, 64
CENTRES = 4
#: Rows of (task, side, node) up to which they are sent to every executor: 16 MB at 64 bytes each.
DEALT_ROWS = 1 << 18
TILE, TILE_SHINGLES, BITS_A_SHINGLE = 256, 1 << 20, 16


def _class_hashes(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, the same in any order of its members."""
    with np.errstate(over="ignore"):
        a = (s * np.uint64(0xFF51AFD7ED558CCD)).sum(dtype=np.uint64)
        b = ((s ^ (s >> np.uint64(29))) * (s | np.uint64(1))).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _place(s: np.ndarray) -> np.ndarray:
    """The counter of each shingle."""
    return (s >> np.uint64(42)).astype(np.int64)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """Rows (doc_id, n, h1, h2) of documents, and each task's shingle counters in chunks: (chunk, places, counts)."""
    schema = pa.schema([("chunk", pa.int32()), ("places", pa.binary()), ("counts", pa.binary()), ("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])

    def run(batches):
        shingler, held, size = Shingler(words), [], 0
        table = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            ids = batch.column(0)
            for first, data, offsets in byte_groups(batch.column(1)):
                n, h = [], []
                for s in shingler.sets(data, offsets):
                    n.append(len(s))
                    h.append(_class_hashes(s))
                    held.append(_place(s))
                    size += len(s)
                k = len(n)
                h1, h2 = zip(*h, strict=True)
                yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()), ids.slice(first, k), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())], schema=schema)
                if size >= BATCH_SHINGLES:
                    table += np.bincount(np.concatenate(held), minlength=COUNTERS).astype(np.uint32)
                    held, size = [], 0
        if held:
            table += np.bincount(np.concatenate(held), minlength=COUNTERS).astype(np.uint32)
        for chunk in range(COUNTERS // CHUNK_COUNTERS):
            part = table[chunk * CHUNK_COUNTERS : (chunk + 1) * CHUNK_COUNTERS]
            places = np.flatnonzero(part)
            if len(places):
                narrow = part[places].astype(np.uint8 if part.max() < 256 else np.uint32)
                gaps = np.diff(places, prepend=0).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([zlib.compress(gaps.tobytes(), 1)]), pa.array([zlib.compress(narrow.tobytes(), 1)]), *[pa.nulls(1, pa.int64())] * 4], schema=schema)

    return docs.mapInArrow(run, "chunk int, places binary, counts binary, doc_id long, n long, h1 long, h2 long")


def _frequencies(parts: DataFrame) -> np.ndarray:
    """The sum of all tasks' counters, each as a 16-bit logarithm. A task adds up its chunks as they stream by."""
    chunks = COUNTERS // CHUNK_COUNTERS

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, places, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = np.cumsum(np.frombuffer(zlib.decompress(places), np.uint16).astype(np.int64))
                raw = zlib.decompress(counts)
                sums.setdefault(chunk, np.zeros(CHUNK_COUNTERS, np.int64))[at] += np.frombuffer(raw, np.uint8 if len(raw) == len(at) else np.uint32)
        for chunk, total in sums.items():
            logs = (np.log2(total + 1.0) * 1024).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([logs.tobytes()], pa.binary())], names=["chunk", "logs"])

    out = np.zeros(COUNTERS, np.uint16)
    for chunk, logs in parts.repartition(min(chunks, 16), "chunk").mapInArrow(run, "chunk int, logs binary").collect():
        out[chunk * CHUNK_COUNTERS : (chunk + 1) * CHUNK_COUNTERS] = np.frombuffer(bytes(logs), np.uint16)
    return out


def index_length(n, percent: int):
    """How many first shingles the smaller set of a pair has to show."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


def probe_length(n, percent: int):
    """How many first shingles the larger set of a pair has to show."""
    return n - -(-percent * n // 100) + 1


def reach(percent: int) -> int:
    """Two sets that link lie at most so many bands of sizes apart."""
    return int(math.log(100 / percent) / STEP + 1e-9) + 1


def _band(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(n) / STEP).astype(np.int16)


def deep_from(percent: int) -> int:
    """The band from which sets show NEED - 1 first shingles more: all that link to them share NEED."""
    return int(_band(np.float64(max(DEEP, 100 * NEED / percent)))) + 1


def _planes(x: np.ndarray) -> bytes:
    """The first bytes of all numbers, then their second bytes, ...: what compresses well of ascending numbers' steps."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _unplaned(raw: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    if not raw:
        return np.zeros(0, kind)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


PACKED = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("keys", "sets", "classes", "bands", "left", "right"))])


def _thinned(key, band, of):
    """Which entries remain, which of them stand for all of their key and band (index and probe apart; more than CROWD), and who is tied to whom by that.

    The band's lowest bit tells index from probe.
    """
    keep, stand = np.ones(len(key), bool), np.zeros(len(key), bool)
    run = key[1:] == key[:-1]
    among = np.flatnonzero(np.append(run, False) | np.append(False, run))
    if not len(among):
        return keep, stand, np.zeros((0, 2), np.int64)
    among = among[np.lexsort((of[among], band[among], key[among]))]
    new = np.append(True, (key[among][1:] != key[among][:-1]) | (band[among][1:] != band[among][:-1]))
    group = np.cumsum(new) - 1
    first = among[new][group]
    crowd = np.bincount(group)[group] > CROWD
    again = crowd & ~new
    keep[among[again]] = False
    stand[among[crowd & new]] = True
    ties = np.unique(np.stack([of[first[again]], of[among[again]]], 1), axis=0)
    return keep, stand, ties[ties[:, 0] != ties[:, 1]]


def _packed(docs: DataFrame, words: int, percent: int, frequency: np.ndarray, parts: int) -> DataFrame:
    """The first shingles of all documents by range of keys, in the columns of PACKED.

    keys: ascending, as steps. sets: which of the row's classes each key is of,
    and classes and bands say what these are, a band with STANDS that the entry
    stands for others. left, right: classes tied already, because another entry
    of the same task stands for theirs.
    """
    shared, least = docs.sparkSession.sparkContext.broadcast(frequency), deep_from(percent)

    def packed(held):
        seen: dict[int, int] = {}
        keys, of, flags, sizes = [], [], [], []
        for name, first, n, index in held:
            if name in seen:
                continue
            seen[name] = len(sizes)
            sizes.append(n)
            keys.append(first)
            of.append(np.full(len(first), seen[name], np.int64))
            flags.append(np.arange(len(first)) >= index)
        key, of, probe = mixed(np.concatenate(keys)), np.concatenate(of), np.concatenate(flags)
        name, size = np.array(list(seen), np.int64), _band(np.array(sizes))
        order = np.argsort(key, kind="stable")
        key, of = key[order], of[order]
        band = size[of] * 2 + probe[order]
        keep, stand, ties = _thinned(key, band, of)
        tie_at = np.arange(len(ties)) % parts
        key, of, kind = key[keep], of[keep], (band[keep] & 1) + 2 * stand[keep]
        part = (((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        edge = np.searchsorted(part, np.arange(parts + 1))
        for p in range(parts):
            here = slice(edge[p], edge[p + 1])
            tied = ties[tie_at == p]
            if here.start == here.stop and not len(tied):
                continue
            # A class and its band with its flags, as a row's sets: so an entry needs only its number among them.
            pairs, number = np.unique((of[here] << 2) | kind[here], return_inverse=True)
            columns = [_planes(np.diff(key[here], prepend=np.uint64(0))), _planes(number.astype(np.uint32)), name[pairs >> 2].tobytes(), (size[pairs >> 2] * 2 + (pairs & 1) + STANDS * (pairs >> 1 & 1)).astype(np.int16).tobytes(), name[tied[:, 0]].tobytes(), name[tied[:, 1]].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), *(pa.array([c], pa.binary()) for c in columns)], schema=PACKED)

    def run(batches):
        shingler, often, held, size = Shingler(words), shared.value, [], 0
        for batch in batches:
            for _, data, offsets in byte_groups(batch.column(0)):
                for s in shingler.sets(data, offsets):
                    if not len(s):
                        continue
                    more = NEED - 1 if _band(np.float64(len(s))) >= least else 0
                    rare_first = np.argsort(often[_place(s)], kind="stable")[: probe_length(len(s), percent) + more]
                    held.append((_class_hashes(s)[0], s[rare_first], len(s), index_length(len(s), percent) + more))
                    size += len(rare_first)
                    if size >= CHUNK_KEYS:
                        yield from packed(held)
                        held, size = [], 0
        if held:
            yield from packed(held)

    return docs.filter("doc_id is not null").select("text").mapInArrow(run, "part int, keys binary, sets binary, classes binary, bands binary, left binary, right binary")


def _met(key, name, band, stands, least: int, far: int):
    """Pairs of names that share a key in bands that may link, coded as name * (largest name + 1) + name, and how often (NEED for those tied by one); and chains.

    In the order of (key, band, index first) an entry meets the index entries
    before it. Keys of more than RUN entries give chains: an entry is tied to
    the index entry before it, which reaches every pair of an index entry with
    an entry of the same or a higher band.
    """
    none = np.zeros(0, np.int64)
    if not len(key):
        return none, none, none, (none, none)
    many = int(name.max()) + 1
    index, size = (band & 1) == 0, band >> 1
    at = np.arange(len(key))
    new = np.append(True, key[1:] != key[:-1])
    run = np.cumsum(new) - 1
    long = np.bincount(run)[run] > RUN
    before = np.append(-1, np.maximum.accumulate(np.where(index, at, -1))[:-1])
    ok = long & (before >= 0)
    ok[ok] = (key[before[ok]] == key[ok]) & (size[ok] - size[before[ok]] <= far)
    chain = name[before[ok]], name[ok]
    starts = np.flatnonzero(new)
    cuts = np.unique(starts[np.maximum(np.searchsorted(starts, np.arange(0, len(key), SLICE), "right") - 1, 0)])
    codes, counts = [none], [none]
    for low, high in zip(cuts, [*cuts[1:], len(key)], strict=True):
        short = low + np.flatnonzero(~long[low:high] & index[low:high])
        code, count = [], []
        for d in range(1, RUN):
            short = short[short + d < high]
            short = short[key[short] == key[short + d]]
            if not len(short):
                break
            i = short[(size[short + d] - size[short] <= far) & (name[short] != name[short + d])]
            j = i + d
            code.append(np.minimum(name[i], name[j]) * many + np.maximum(name[i], name[j]))
            count.append(np.where((size[i] >= least) & (size[j] >= least) & ~stands[i] & ~stands[j], 1, NEED))
        if code:
            code, back = np.unique(np.concatenate(code), return_inverse=True)
            codes.append(code)
            counts.append(np.minimum(np.bincount(back, np.concatenate(count)), NEED).astype(np.int64))
    code, back = np.unique(np.concatenate(codes), return_inverse=True)
    return code // many, code % many, np.bincount(back, np.concatenate(counts)).astype(np.int64), chain


def _ties(packed: DataFrame, parts: int, percent: int) -> DataFrame:
    """a, b, n: classes (by h1) that meet at n keys of a range in bands that may link. Those whose n add up to NEED connect all that link."""
    far, least = reach(percent), deep_from(percent)

    def run(batches):
        keys, names, bands, left, right = [], [], [], [], []
        for batch in batches:
            for _, k, s, c, b, x, y in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                number = _unplaned(s, np.uint32)
                keys.append(np.cumsum(_unplaned(k, np.uint64), dtype=np.uint64))
                names.append(np.frombuffer(c, np.int64)[number])
                bands.append(np.frombuffer(b, np.int16)[number])
                left.append(np.frombuffer(x, np.int64))
                right.append(np.frombuffer(y, np.int64))
        if not keys:
            return
        key, name, band = np.concatenate(keys), np.concatenate(names), np.concatenate(bands)
        del keys, names, bands
        order = np.argsort(key, kind="stable")
        key = key[order]
        same = key[1:] == key[:-1]
        meets = np.append(same, False) | np.append(False, same)
        key, name, band = key[meets], name[order][meets], band[order][meets]
        nodes, ends = np.unique(np.concatenate([name, *left, *right]), return_inverse=True)
        tied = ends[len(name) :].reshape(2, -1)
        name, stands, band = ends[: len(name)], band >= STANDS, band % STANDS
        order = np.lexsort((~stands, name, band, key))
        key, name, band, stands = key[order], name[order], band[order], stands[order]
        once = np.append(True, (key[1:] != key[:-1]) | (band[1:] != band[:-1]) | (name[1:] != name[:-1]))[: len(key)]
        a, b, n, chain = _met(key[once], name[once], band[once], stands[once], least, far)
        sure = n >= NEED
        root = roots(len(nodes), np.concatenate([tied[0], chain[0], a[sure]]), np.concatenate([tied[1], chain[1], b[sure]]))
        moved = np.flatnonzero(root != np.arange(len(root)))
        rest = ~sure & (root[a] != root[b])
        yield pa.RecordBatch.from_arrays([pa.array(nodes[np.append(root[moved], a[rest])]), pa.array(nodes[np.append(moved, b[rest])]), pa.array(np.append(np.full(len(moved), NEED), n[rest]))], names=["a", "b", "n"])

    return packed.repartitionById(parts, "part").mapInArrow(run, "a long, b long, n long")


def _bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """A row of words for each set: its shingles' leading bits, as places."""
    out = np.zeros((len(sets), bits), bool)
    shift = np.uint64(64 - bits.bit_length() + 1)
    for row, s in zip(out, sets, strict=True):
        row[(s >> shift).astype(np.int64)] = True
    return np.packbits(out, axis=1).view(np.uint64)


def _overlap_bounds(x: np.ndarray, n_x: int, y: np.ndarray, n_y: np.ndarray) -> np.ndarray:
    """At most so many shingles are both of the set with bitmap x and of each of those with bitmaps y."""
    both = np.bitwise_count(x & y).sum(1, dtype=np.int64)
    return np.minimum(n_x - (int(np.bitwise_count(x).sum()) - both), n_y - (np.bitwise_count(y).sum(1, dtype=np.int64) - both))


def _overlaps(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many members the sorted array x shares with each of the others. None is empty."""
    every = np.concatenate(others)
    hit = x[np.minimum(np.searchsorted(x, every), len(x) - 1)] == every
    lengths = np.array([len(y) for y in others])
    return np.add.reduceat(hit, np.cumsum(lengths) - lengths, dtype=np.int64)


def _tiles(n: np.ndarray) -> list[slice]:
    """Runs of sets in the order of their sizes: at most TILE, of sizes within a factor of two, of bounded weight."""
    out, a = [], 0
    while a < len(n):
        b = min(a + TILE, int(np.searchsorted(n, 2 * n[a], "right")))
        b = a + max(1, int(np.searchsorted(np.cumsum(n[a:b]), TILE_SHINGLES, "right")))
        out.append(slice(a, b))
        a = b
    return out


def linked(nodes: list[int], sets: list[np.ndarray], percent: int, side: list[int] | None = None) -> list[tuple[int, int]]:
    """Links between nodes, enough of them to connect all whose sets link. With ``side``, only pairs of different sides count."""
    n = np.array([len(s) for s in sets])
    order = np.argsort(n, kind="stable")
    n, sets, nodes = n[order], [sets[i] for i in order], np.array(nodes)[order]
    side = None if side is None else np.array(side)[order]
    _, root = np.unique(nodes, return_inverse=True)
    out: list[tuple[int, int]] = []
    tiles = _tiles(n)
    for t, p in enumerate(tiles):
        own: dict[int, np.ndarray] = {}
        for q in tiles[t:]:
            if n[q.start] * percent > 100 * n[p.stop - 1]:
                break
            if p == q and p.stop - p.start == 1:
                continue
            bits = max(64, 1 << (BITS_A_SHINGLE * int(n[q.stop - 1]) - 1).bit_length())
            theirs = None
            for i in range(p.start, p.stop):
                j = np.arange(max(q.start, i + 1), q.stop)
                j = j[(root[j] != root[i]) & (n[j] * percent <= 100 * n[i])]
                if side is not None:
                    j = j[side[j] != side[i]]
                if not len(j):
                    continue
                if theirs is None:
                    theirs = _bitmaps(sets[q], bits)
                    if bits not in own:
                        own = {bits: theirs if p == q else _bitmaps(sets[p], bits)}
                most = _overlap_bounds(own[bits][i - p.start], n[i], theirs[j - q.start], n[j])
                j = j[100 * most >= percent * (n[i] + n[j] - most)]
                if not len(j):
                    continue
                both = _overlaps(sets[i], [sets[x] for x in j])
                for x in j[100 * both >= percent * (n[i] + n[j] - both)]:
                    if root[x] != root[i]:
                        out.append((int(nodes[i]), int(nodes[x])))
                        root[root == root[x]] = root[i]
    return out


def _compared(docs: DataFrame, dealt: DataFrame, words: int, percent: int) -> DataFrame:
    """a, b: links found by the tasks of ``dealt`` (task, side, node). A task of one side compares all its pairs.

    Up to DEALT_ROWS rows, ``dealt`` is sent to the texts, which then move once;
    beyond, they meet by a shuffle of those that the bitmap lets through.
    """
    few = written(dealt, "dealt")
    sent = F.broadcast(few) if few.count() <= DEALT_ROWS else few
    rows = possibly_in(docs, F.col("doc_id"), few, "node").join(sent, F.col("node") == F.col("doc_id")).select("task", "side", "node", "text")
    rows = rows.repartition(partitions(docs.sparkSession), "task").sortWithinPartitions("task")

    def run(batches):
        shingler, task, held = Shingler(words), None, []

        def found():
            sides, nodes, sets = zip(*held, strict=True)
            links = linked(nodes, sets, percent, None if len(set(sides)) == 1 else sides)
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            ids, sides, nodes = (batch.column(i).to_pylist() for i in range(3))
            for first, data, offsets in byte_groups(batch.column(3)):
                for i, s in enumerate(shingler.sets(data, offsets), first):
                    if ids[i] != task:
                        if held:
                            yield from found()
                        task, held = ids[i], []
                    if len(s):
                        held.append((sides[i], nodes[i], s))
        if held:
            yield from found()

    return rows.mapInArrow(run, "a long, b long")


def _in_blocks(members: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """The members of families over ``most`` with their block: a band of sizes, and within it a share by hash of at most about half of ``most``."""
    large = members.join(sizes.filter(F.col("weight") > most).select("family"), "family", "left_semi")
    large = large.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(STEP)).cast("int"))
    shares = large.groupBy("family", "band").agg(F.ceil(F.sum(F.col("n") + BASE) * 2 / most).alias("shares"))
    return large.join(shares, ["family", "band"]).select("family", "node", "band", F.pmod(F.xxhash64("node"), F.col("shares")).alias("share"))


def _links_of_large(docs: DataFrame, blocks: DataFrame, words: int, percent: int) -> DataFrame:
    """Links within families that are too large for a task.

    First every block is compared by itself, together with a few centres of its
    family, which join blocks of near copies. The sets outside a family's
    largest component then are compared with those of all other blocks whose
    sizes may link; a pair within that component needs no more.
    """
    name = lambda *c: F.concat_ws(":", *c)
    centres = blocks.groupBy("family").agg(F.array_distinct(F.array(*[F.min_by("node", F.xxhash64("node", F.lit(i))) for i in range(CENTRES)])).alias("centres"))
    keys = blocks.select("family", "band", "share").distinct()
    added = keys.join(centres, "family").select("family", "band", "share", F.explode("centres").alias("node"))
    first = blocks.select("family", "band", "share", "node").unionByName(added).distinct()
    near = written(_compared(docs, first.select(name("family", "band", "share").alias("task"), F.lit(0).alias("side"), "node"), words, percent), "block-links", keep=True)
    placed = blocks.join(components(near), "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = written(placed, "blocks")
    counted = placed.groupBy("family", "component").agg(F.count("*").alias("c"))
    main = counted.groupBy("family").agg(F.max_by("component", F.struct("c", "component")).alias("main"))
    outside = placed.join(main, "family").filter(F.col("component") != F.col("main")).select("family", "node", "band", "share")
    ours = outside.select("family", "band", "share").distinct()
    theirs = keys.select("family", F.col("band").alias("band2"), F.col("share").alias("share2"))
    pairs = ours.join(theirs, "family").filter((F.abs(F.col("band") - F.col("band2")) <= reach(percent)) & ((F.col("band") != F.col("band2")) | (F.col("share") != F.col("share2"))))
    task = name("family", "band", "share", "band2", "share2").alias("task")
    one = outside.join(pairs, ["family", "band", "share"]).select(task, F.lit(0).alias("side"), "node")
    two = blocks.select("family", F.col("band").alias("band2"), F.col("share").alias("share2"), "node").join(pairs, ["family", "band2", "share2"]).select(task, F.lit(1).alias("side"), "node")
    return near.unionByName(written(_compared(docs, written(one.unionByName(two), "block-pairs"), words, percent), "far-links", keep=True))


def link_classes(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text", most: int = MOST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, classes, links).

    documents: doc_id, n, h1, h2, a row per input row; n is its number of
    distinct shingles. classes: n, h1, h2, node (smallest id), members. links:
    a, b (nodes), enough of the links between classes to connect all that link.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    spark = docs.sparkSession
    with temporary():
        found = written(_sets(docs, words), "shingle-sets", keep=True)
        documents = found.filter("chunk is null").select("doc_id", "n", "h1", "h2")
        frequency = _frequencies(found.filter("chunk is not null").select("chunk", "places", "counts"))
        some = documents.filter("n > 0 and doc_id is not null")
        classes = written(some.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("node"), F.count("*").alias("members")), "classes", keep=True)
        total = classes.agg(F.sum("n")).first()[0] or 0
        parts = max(partitions(spark), -(-total * (100 - percent) // (100 * RANGE_KEYS)))
        met = written(_ties(_packed(docs, words, percent, frequency, parts), parts, percent), "ties")
        released(spark)
        families = components(met.groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= NEED))
        members = classes.join(families, classes["h1"] == families["node"]).select(F.col("component").alias("family"), classes["node"], "n")
        members = written(members, "families")
        sizes = members.groupBy("family").agg(F.sum(F.col("n") + BASE).alias("weight"))
        sizes = written(sizes, "family-sizes")
        small = members.join(sizes.filter(F.col("weight") > most).select("family"), "family", "left_anti")
        dealt = small.select(F.col("family").cast("string").alias("task"), F.lit(0).alias("side"), "node").distinct()
        links = written(_compared(docs, dealt, words, percent), "family-links", keep=True)
        if sizes.filter(F.col("weight") > most).limit(1).count():
            blocks = written(_in_blocks(members, sizes, most), "family-blocks")
            links = links.unionByName(written(_links_of_large(docs, blocks, words, percent), "large-links", keep=True))
    return documents, classes, links


def ngram_join(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """doc_id, n_shingles, component_id for every row: its set's size and the smallest id reachable by links.

    Words are maximal runs outside [\\x20\\x09-\\x0D] with A-Z lower-cased; a set
    holds the distinct runs of ``words`` words. Two documents link when their
    intersection is at least ``percent`` hundredths of their union.

    ``most`` bounds the shingles that one task compares (a single set may be
    larger); it changes the work and not the result.

    Defined results: null, empty and blank texts have no shingles and are their
    own component; a text of fewer words is one shingle; whole texts of any
    length count; rows that share an id are one node, linked by any of them;
    repeated rows are kept and alike; pairs at exactly ``percent`` link; rows of
    null id link with nothing and have a null component; an empty table gives no
    rows; other columns of any name don't matter. Shingles are compared as
    64-bit hashes.
    """
    with temporary():
        documents, classes, links = link_classes(docs, words, percent, doc_id, text, most)
        documents = written(documents, "documents", keep=True)
        groups = components(links)
        named = classes.join(groups, classes["node"] == groups["node"], "left").select("n", "h1", "h2", F.coalesce("component", classes["node"]).alias("component"), classes["node"].alias("node"), "members")
        named = written(named.filter("members > 1 or component <> node").drop("members", "node"), "named", keep=True)
    same = documents.join(named, ["n", "h1", "h2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return same


def one_per_group(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """The documents, with all their columns, of which none of a smaller id is in the same component.

    Rows of null id stay; of rows that share an id all stay or go together. All
    else is as ngram_join() has it.
    """
    with temporary():
        joined = ngram_join(docs, words, percent, doc_id, text, most)
        gone = joined.filter("component_id < doc_id").select(F.col("doc_id").alias("copy__id")).distinct()
        gone = written(gone, "copies", keep=True)
    return docs.join(gone, F.col(doc_id) == F.col("copy__id"), "left_anti")
