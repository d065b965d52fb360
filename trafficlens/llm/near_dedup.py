"""Near duplicates by improved consistent weighted sampling.

A document is its multiset of five-word shingles, each weighted by TF-IDF.
Equal word sequences are one node from the start (``fp``, 128 bits), so copies
are never paired. Then

1. document frequencies, exact whatever the partitioning: every window of documents
   hands on the shingles that reach ``LOSSY`` of its documents (two at least, all of a
   small window), Spark adds them up, and since no count lacks more than the windows
   kept back, the sums name all candidates; a second pass counts these in full.
   Small partitions share tasks, so that windows are large however finely the
   documents are cut, and the last window of a task keeps back what it holds once;
   Weights are the smooth TF-IDF, 1 + ln((1 + documents) / (1 + frequency)), over its
   highest value. Shingles in fewer than 1/``RARE`` of the documents (and two) have
   that highest value, so the table that is broadcast has at most ``RARE`` x (mean
   shingles per document) rows whatever the corpus;
2. improved consistent weighted sampling draws ``BANDS * ROWS`` samples (shingle,
   level), equal in two documents with the probability of their weighted Jaccard
   similarity. Four samples make a band key: at similarity 0.8 a pair shares one
   of twelve with 0.998, at 0.9 with 0.99999;
3. rows (bucket, following keys, fp) of the buckets that hold two nodes or more
   are range-sorted, so no bucket has to fit a task, and each row is paired with
   the one before it in its bucket (near copies stand next to each other, in
   every band anew). These links give first classes;
4. buckets that still hold two classes or more are compared in full. The rows of a
   bucket's largest class, its main class, and its other rows are cut into blocks of
   about ``BLOCK_ROWS`` rows and ``BLOCK_TEXT`` bytes; a block of others makes a cell
   with every block, and a cell looks at its pairs of different classes, in the
   first band that the pair shares. It sends on the links that join classes it
   hasn't joined yet, never more than it has rows. No partner is left out, so the
   comparisons (of 48 bytes) in a bucket grow with its rows outside of its main
   class times all its rows;
5. a pair whose 48 one-byte sample digests agree in fewer than ``AGREE`` is taken
   to lie below 0.8 (a pair at 0.8 is lost so with 7e-7, against the 2e-3 of the
   bands); the others are verified: exact weighted Jaccard similarity of the whole
   texts, 0.8 or more;
6. verified links join to classes by repeated minimum and pointer jumping,
   checkpointed each round.

Result: one row per document with its class (smallest doc_id in it) and the
size of the class. A document without
words is its own class. Null ids come last; of rows that repeat id and words one
stays. Extra columns are kept by ``drop_near_copies``. Empty in, empty out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .arrow import small_batches
from .slot import free
from .textbatch import Words, blocks, buffers, mix, shingles

SIZE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
BLOCK_ROWS = 1024
BLOCK_TEXT = 16 << 20
AGREE = 24
RARE = 256
LOSSY = 1 / 2048
WINDOW_SHINGLES = 1_000_000
SMALL_WINDOW = 4 * RARE  # documents
TASK_BYTES = 32 << 20  # from here on partitions share no task

_TABLE = 1 << 16
_BITS = 44
_LOW = np.uint64((1 << _BITS) - 1)
_SAMPLES = BANDS * ROWS


def _random_tables():
    """(r, ln c, beta) of the sampling scheme for 65,536 random numbers, and the
    float bits of the sampling value of a shingle of weight 1."""
    g = np.random.default_rng(20240229)
    r, c, beta = g.gamma(2.0, 1.0, _TABLE), g.gamma(2.0, 1.0, _TABLE), g.random(_TABLE)
    one = np.exp(np.log(c) + r * beta - r).astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)
    return r, np.log(c), beta, one


_R, _LNC, _BETA, _ONE = _random_tables()
_MULTIPLIERS = mix(np.arange(1, _SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Bag:
    """Distinct shingles of a block of texts: ``key`` (44 bits of the hash),
    ``weight`` and ``first`` (limits of the texts)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, frequent: Frequent | None):
        self.words = Words(data, offsets)
        h, first = shingles(self.words, SIZE)
        n = len(offsets) - 1
        doc = np.repeat(np.arange(n, dtype=np.uint64), np.diff(first))
        both = np.sort((doc << np.uint64(_BITS)) | (h & _LOW))
        new = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
        tf = np.diff(np.append(new, len(both)))
        both = both[new]
        self.key, self.doc = both & _LOW, (both >> np.uint64(_BITS)).astype(np.int64)
        self.first = np.searchsorted(self.doc, np.arange(n + 1))
        self.weight = tf.astype(np.float64) if frequent is None else tf * frequent.idf(self.key)

    def fingerprints(self) -> list[bytes | None]:
        """128 bits of the word sequence of each text, None without words."""
        hashes = self.words.hashes(2)
        n = self.words.counts
        at = (np.arange(hashes.shape[1]) - np.repeat(self.words.first[:-1], n)).astype(np.uint64)
        full = np.flatnonzero(n)
        out: list[bytes | None] = [None] * len(n)
        parts = []
        for h, salt in zip(hashes, (0x2545F4914F6CDD1D, 0xD1342543DE82EF95)):
            step = mix(h ^ mix((at + np.uint64(1)) * np.uint64(salt)))
            parts.append(mix(np.add.reduceat(step, self.words.first[:-1][full]) + n[full].astype(np.uint64)) if len(full) else step)
        raw = np.stack(parts, axis=1).tobytes()
        for i, row in enumerate(full.tolist()):
            out[row] = raw[16 * i:16 * i + 16]
        return out

    def samples(self) -> np.ndarray:
        """(documents with shingles, _SAMPLES): each sample names shingle and level."""
        full = np.flatnonzero(np.diff(self.first))
        out = np.zeros((len(full), _SAMPLES), dtype=np.uint64)
        if not len(full):
            return out
        at = self.first[:-1][full]
        h = mix(self.key)
        name = h & np.uint64(0xFFFFFFFF)
        other = np.flatnonzero(self.weight != 1)
        ln_w = np.log(self.weight[other])
        for k, m in enumerate(_MULTIPLIERS):
            pick = ((h * m) >> np.uint64(48)).astype(np.int64)
            value = _ONE[pick]
            if len(other):
                p = pick[other]
                r, beta = _R[p], _BETA[p]
                y = r * (np.floor(ln_w / r + beta) - beta)
                value[other] = np.exp(_LNC[p] - y - r).astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)
            value |= name
            out[:, k] = np.minimum.reduceat(value, at)
        return out


class Frequent:
    """IDF of shingles: ``keys`` (sorted) are frequent, all others have IDF 1."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, documents: int):
        self.keys = keys
        highest = 1 + np.log((1 + documents) / (1 + max(documents / RARE, 1)))
        self.values = np.minimum((1 + np.log((1 + documents) / (1 + counts))) / highest, 1)
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def idf(self, key: np.ndarray) -> np.ndarray:
        out = np.ones(len(key))
        if len(self.keys):
            at = np.flatnonzero(self.maybe[(key & np.uint64((1 << 20) - 1)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.keys, key[at]), len(self.keys) - 1)
            hit = self.keys[place] == key[at]
            out[at[hit]] = self.values[place[hit]]
        return out


def _least(documents: int, small: int) -> int:
    """The count from which a window of so many documents hands a shingle on (``small``: a small one)."""
    return small if documents < SMALL_WINDOW else max(2, int(np.ceil(LOSSY * documents)))


def _candidates(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, int, bool]:
    """(keys, counts, documents, whole): all shingles that may be frequent; their
    counts lack nothing if ``whole``."""
    documents, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    tasks = max(1, documents // (2 * SMALL_WINDOW), size // TASK_BYTES)
    spare = 1 if tasks * SMALL_WINDOW <= documents else 0  # what the last window of a task may keep back if it is small

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free()
        keys, n, documents = [], 0, 0

        def counted(small):
            k, c = np.unique(np.concatenate(keys), return_counts=True)
            least = _least(documents, small)
            at = np.flatnonzero(c >= least)
            k, c = np.append(k[at].astype(np.int64), -1), np.append(c[at], least - 1)  # -1: what a count may lack
            return pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], names=["key", "n"])

        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for a, b in blocks(offsets):
                keys.append(Bag(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], None).key)
                n, documents = n + len(keys[-1]), documents + b - a
                if n >= WINDOW_SHINGLES and (documents >= SMALL_WINDOW or n >= 8 * WINDOW_SHINGLES):
                    yield counted(1)
                    keys, n, documents = [], 0, 0
        if keys:
            yield counted(1 + spare)
        keys = []
        free()

    counts = docs.select("text").coalesce(tasks).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    reach = max(2, documents / RARE) - documents / SMALL_WINDOW - spare * tasks  # no sum lacks more than that
    rows = counts.where((F.col("key") < 0) | (F.col("n") >= reach)).toArrow()
    keys, n = rows.column("key").to_numpy(), rows.column("n").to_numpy()
    return keys[keys >= 0].astype(np.uint64), n[keys >= 0], documents, not n[keys == -1].any()


def _counted(docs: DataFrame, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts): the documents that hold each of the ``keys`` (sorted)."""
    wanted = docs.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = wanted.value
        counts = np.zeros(len(keys), np.int64)
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for a, b in blocks(offsets):
                key = Bag(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], None).key
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                counts += np.bincount(place[keys[place] == key], minlength=len(keys))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(keys[at].astype(np.int64)), pa.array(counts[at])], names=["key", "n"])

    rows = docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    return rows.column("key").to_numpy().astype(np.uint64), rows.column("n").to_numpy()


def frequent_shingles(docs: DataFrame) -> Frequent:
    """Step 1. The driver receives the candidates only."""
    keys, counts, documents, whole = _candidates(docs)
    if not whole and len(keys):
        keys, counts = _counted(docs, np.sort(keys))
    at = np.flatnonzero(counts >= max(2, documents / RARE))
    at = at[np.argsort(keys[at])]
    return Frequent(keys[at], counts[at], documents)


def _signatures(docs: DataFrame, frequent) -> DataFrame:
    """Per row: doc_id, fp, size (bytes), keys (the band keys), digest (a byte per sample)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for a, b in blocks(offsets):
                bag = Bag(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], frequent.value)
                s = bag.samples()
                band = np.zeros((len(s), BANDS), dtype=np.uint64)
                for j in range(ROWS):
                    band = mix(band ^ s[:, j::ROWS]) + np.uint64(j + 1)
                digest = (mix(s) >> np.uint64(56)).astype(np.uint8)
                keys, digests = band.tobytes(), digest.tobytes()
                fp = bag.fingerprints()
                at = iter(range(len(s)))
                place = [None if f is None else next(at) for f in fp]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(fp, pa.binary()), pa.array(np.diff(offsets[a:b + 1])),
                     pa.array([None if p is None else keys[8 * BANDS * p:8 * BANDS * (p + 1)] for p in place], pa.binary()),
                     pa.array([None if p is None else digests[_SAMPLES * p:_SAMPLES * (p + 1)] for p in place], pa.binary())],
                    names=["doc_id", "fp", "size", "keys", "digest"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp binary, size long, keys binary, digest binary")


def _digests(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, _SAMPLES)


def _shared(nodes: DataFrame) -> DataFrame:
    """(bucket, band, fp, size, keys, digest) of the nodes that share a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), np.uint64).reshape(n, BANDS)
            band = np.arange(BANDS, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(mix(keys ^ mix(band + np.uint64(1))).ravel().view(np.int64)), pa.array(np.tile(band.astype(np.int32), n)),
                 batch.column("fp").take(pa.array(np.repeat(np.arange(n), BANDS)))], names=["bucket", "band", "fp"])

    rows = nodes.select("fp", "keys").mapInArrow(run, "bucket long, band int, fp binary")
    several = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    return rows.join(several, "bucket").join(nodes.select("fp", "size", "keys", "digest"), "fp").select(
        "bucket", "band", "fp", "size", "keys", "digest")


def _next_neighbours(shared: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of rows that stand next to each other in a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch])
            held = batch.slice(batch.num_rows - 1)
            bucket, digest = table.column("bucket").to_numpy(), _digests(table.column("digest"))
            fp = table.column("fp").to_pylist()
            at = np.flatnonzero((bucket[1:] == bucket[:-1]) & ((digest[1:] == digest[:-1]).sum(1) >= AGREE))
            pairs = sorted({(min(fp[i], fp[i + 1]), max(fp[i], fp[i + 1])) for i in at.tolist()})
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])

    order = ["bucket", "following", "fp"]
    rows = shared.select("bucket", F.expr(f"substring(concat(keys, keys), 8 * band + 9, {8 * (BANDS - 1)})").alias("following"), "fp", "digest")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "a binary, b binary").distinct()


_CELL = "bucket long, low long, high long, block long, band int, fp binary, label binary, keys binary, digest binary"
_CELL_KEY = ["bucket", "low", "high"]


def _cells(shared: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one class, dealt to cells. Rows of a
    bucket's largest class (its main class) need no comparison with each other: only
    the other rows are dealt to all blocks, those of the main class to the blocks of
    the others. A bucket that fits one block is one cell."""
    rows = (shared.join(known.select(F.col("node").alias("fp"), "label"), "fp", "left")
            .withColumn("label", F.coalesce("label", "fp")))
    classes = rows.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))

    def blocks(n, size):
        return F.least(n, F.greatest(F.ceil(n / BLOCK_ROWS), F.ceil(size / BLOCK_TEXT)))

    top = F.max(F.struct("n", "bytes", "label"))
    mixed = (classes.groupBy("bucket").agg(F.count("*").alias("classes"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), top.alias("top"))
             .where("classes > 1"))
    small = blocks(F.col("n"), F.col("bytes")) == 1
    mixed = mixed.select("bucket", F.when(~small, F.col("top.label")).alias("main"),
                         F.when(small, 1).otherwise(blocks(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes"))).alias("others"),
                         F.when(small, 0).otherwise(blocks(F.col("top.n"), F.col("top.bytes"))).alias("mains"))
    in_main = F.col("label").eqNullSafe(F.col("main"))
    block = F.when(in_main, F.col("others") + F.pmod(F.xxhash64("fp"), "mains")).otherwise(F.pmod(F.xxhash64("fp"), "others"))
    last = F.when(in_main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    dealt = rows.join(mixed, "bucket").withColumn("block", block)
    return (dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
            .select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                    "block", "band", "fp", "label", "keys", "digest"))


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one cell after another, from batches sorted by cell."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in _CELL_KEY], axis=1)
        cut = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cut, cut[1:]):
            if held and tuple(key[a]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = tuple(key[a])
    if held:
        yield pa.Table.from_batches(held)


def _cell_pairs(cell: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each row, left, right): the pairs of rows of different classes
    that may reach the similarity and share no earlier band."""
    n, band = cell.num_rows, cell.column("band")[0].as_py()
    ids: dict[bytes, int] = {}
    label = np.array([ids.setdefault(x, len(ids)) for x in cell.column("label").to_pylist()])
    block, inner = cell.column("block").to_numpy(), cell.column("low")[0] == cell.column("high")[0]
    keys = np.frombuffer(b"".join(cell.column("keys").to_pylist()), np.int64).reshape(n, BANDS)[:, :band]
    digest = _digests(cell.column("digest"))
    left, right = [], []
    for a in range(0, n, 32):
        part = slice(a, a + 32)
        open_ = (label[part, None] != label) & (np.arange(n)[part, None] < np.arange(n))
        if not inner:
            open_ &= block[part, None] != block
        i, j = np.nonzero(open_)
        i += a
        good = (digest[i] == digest[j]).sum(1) >= AGREE
        i, j = i[good], j[good]
        first = ~(keys[i] == keys[j]).any(1)
        left.append(i[first])
        right.append(j[first])
    return label, np.concatenate(left), np.concatenate(right)


def _open_rows(cells: DataFrame) -> DataFrame:
    """The rows of each cell that have a pair to verify there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _whole_cells(batches):
            _, left, right = _cell_pairs(cell)
            if len(left):
                yield from cell.take(pa.array(np.unique(np.concatenate([left, right])))).combine_chunks().to_batches()

    return cells.repartition(*_CELL_KEY).sortWithinPartitions(*_CELL_KEY).mapInArrow(run, _CELL)


def _cell_links(rows: DataFrame, texts: DataFrame, frequent, similarity: float) -> DataFrame:
    """Links (a, b) that join different classes of a cell, a spanning forest of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for cell in _whole_cells(batches):
            label, left, right = _cell_pairs(cell)
            order = np.argsort(left, kind="stable")
            left, right = left[order], right[order]
            key, weight, first = _bags([unpack(t) for t in cell.column("text").to_pylist()], frequent.value)
            total = np.add.reduceat(weight, first[:-1])
            fp, found = cell.column("fp").to_pylist(), []
            for x in np.unique(left).tolist():
                own, w = key[first[x]:first[x + 1]], weight[first[x]:first[x + 1]]
                partners = right[np.searchsorted(left, x):np.searchsorted(left, x, "right")]
                partners = partners[label[partners] != label[x]]
                if not len(partners):
                    continue
                n = first[partners + 1] - first[partners]
                ends = np.cumsum(n)
                at = np.arange(ends[-1]) + np.repeat(first[partners] - (ends - n), n)
                place = np.minimum(np.searchsorted(own, key[at]), len(own) - 1)
                common = np.add.reduceat(np.where(own[place] == key[at], np.minimum(w[place], weight[at]), 0.0), ends - n)
                s = common / (total[x] + total[partners] - common)
                for j in partners[s >= similarity - 1e-9].tolist():
                    if label[j] != label[x]:
                        found.append((min(fp[x], fp[j]), max(fp[x], fp[j])))
                        label[label == label[j]] = label[x]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return (rows.join(texts, "fp").repartition(*_CELL_KEY).sortWithinPartitions(*_CELL_KEY)
            .mapInArrow(run, "a binary, b binary"))


def _bags(texts: list[bytes], frequent: Frequent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles, weights and limits of texts with words, a block at a time."""
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    bags = []
    for a, b in blocks(offsets):
        bags.append(Bag(np.frombuffer(b"".join(texts[a:b]), np.uint8), offsets[a:b + 1] - offsets[a], frequent))
    sizes = np.concatenate([np.diff(x.first) for x in bags])
    return np.concatenate([x.key for x in bags]), np.concatenate([x.weight for x in bags]), np.concatenate([[0], np.cumsum(sizes)])


def _packed(docs: DataFrame) -> DataFrame:
    """fp and the compressed text of each row with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for a, b in blocks(offsets):
                part, off = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                fp = Bag(part, off, None).fingerprints()
                raw, off = part.tobytes(), off.tolist()
                rows = [i for i, f in enumerate(fp) if f is not None]
                yield pa.RecordBatch.from_arrays([pa.array([fp[i] for i in rows], pa.binary()),
                                                  pa.array([pack(raw[off[i]:off[i + 1]]) for i in rows], pa.binary())], names=["fp", "text"])

    return docs.select("text").mapInArrow(run, "fp binary, text binary").groupBy("fp").agg(F.first("text").alias("text"))


def weighted_jaccard(texts: list[bytes], frequent: Frequent | None) -> np.ndarray:
    """Similarity of texts 0 and 1, 2 and 3, and so on."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    bag = Bag(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]), frequent)
    pair, side = bag.doc >> 1, bag.doc & 1
    both = (pair.astype(np.uint64) << np.uint64(_BITS)) | bag.key
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    n = len(texts) // 2
    total = np.bincount(pair, bag.weight, n)
    if not len(a) or not len(b):
        return np.zeros(n)
    place = np.minimum(np.searchsorted(both[b], both[a]), len(b) - 1)
    hit = both[b][place] == both[a]
    common = np.bincount(pair[a[hit]], np.minimum(bag.weight[a[hit]], bag.weight[b[place[hit]]]), n)
    return common / np.maximum(total - common, 1e-300)


def _verified(pairs: DataFrame, texts: DataFrame, frequent, similarity: float) -> DataFrame:
    """The pairs (a, b) whose whole texts reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for x in range(0, batch.num_rows, 256):
                part = batch.slice(x, 256)
                both = [unpack(t) for pair in zip(part.column(2).to_pylist(), part.column(3).to_pylist()) for t in pair]
                s = weighted_jaccard(both, frequent.value)
                rows = pa.array(np.flatnonzero(s >= similarity - 1e-9))
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(1).take(rows)], names=["a", "b"])

    first = pairs.join(texts.select(F.col("fp").alias("a"), F.col("text").alias("ta")), "a")
    both = first.join(texts.select(F.col("fp").alias("b"), F.col("text").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that links reach, for each linked node."""
    both = links.union(links.select(F.col("b"), F.col("a"))).toDF("node", "other").checkpoint()
    labels = both.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("label")).checkpoint()
    while True:
        near = (both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("seen")), "other")
                .groupBy("node").agg(F.min("seen").alias("seen")))
        step = labels.join(near, "node").select("node", "label", F.least("label", "seen").alias("low"))
        jump = step.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        new = step.join(jump, "low", "left").select("node", F.col("label").alias("old"), F.least("low", "lower").alias("label")).checkpoint()
        labels = new.select("node", "label")
        if new.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def _classes(docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, fp) and (nodes: fp, label, class_id, top_fp, class_size)."""
    sc = docs.sparkSession.sparkContext
    ensure_checkpoint_dir(docs.sparkSession)
    small_batches(docs.sparkSession)
    frequent = sc.broadcast(frequent_shingles(docs))
    rows = _signatures(docs, frequent).checkpoint()
    nodes = (rows.where(F.col("fp").isNotNull()).groupBy("fp")
             .agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n"), F.max("size").alias("size"),
                  F.first("keys").alias("keys"), F.first("digest").alias("digest"))
             .checkpoint())
    shared = _shared(nodes).checkpoint()
    near = _verified(_next_neighbours(shared), _packed(docs), frequent, similarity).checkpoint()
    first = components(near)
    rest = _open_rows(_cells(shared, first)).checkpoint()
    far = _cell_links(rest, _packed(docs), frequent, similarity)
    # the later links join classes of the first ones
    own = F.col("of")
    for end in ("a", "b"):
        far = (far.join(first.select(F.col("node").alias(end), F.col("label").alias("of")), end, "left")
               .withColumn(end, F.coalesce(own, end)).drop("of"))
    joined = components(far.select("a", "b").where("a != b").distinct().checkpoint())
    labelled = (nodes.select("fp", "least_id", "n").join(first.select(F.col("node").alias("fp"), F.col("label").alias("of")), "fp", "left")
                .withColumn("node", F.coalesce(own, "fp")).join(joined, "node", "left")
                .select("fp", "least_id", "n", F.coalesce("label", "node").alias("label")))
    keeper = F.min(F.struct(F.col("least_id").isNull().alias("without"), "least_id", "fp"))
    top = labelled.groupBy("label").agg(keeper.alias("top"), F.sum("n").alias("class_size"))
    return rows.select("doc_id", "fp"), labelled.join(top, "label").select(
        "fp", F.col("top.least_id").alias("class_id"), F.col("top.fp").alias("top_fp"), "class_size")


def near_duplicate_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size."""
    rows, nodes = _classes(docs, similarity)
    return rows.join(nodes, "fp", "left").select(
        "doc_id", F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"))


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows that stay (one of each class), with the columns of ``docs``."""
    _, nodes = _classes(docs.select("doc_id", "text"), similarity)
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    id_name, text_at = names[docs.columns.index("doc_id")], docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(text_at))
            for a, b in blocks(offsets):
                fp = Bag(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], None).fingerprints()
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(fp, pa.binary())], names=[*names, "fp"])

    marked = plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("fp", T.BinaryType())]))
    stay = nodes.select(F.col("top_fp").alias("fp"), F.col("class_id").alias("stays")).distinct()
    on = (marked["fp"] == stay["fp"]) & marked[id_name].eqNullSafe(stay["stays"])
    worded = marked.where(F.col("fp").isNotNull()).join(stay, on, "left_semi").dropDuplicates(["fp", id_name])
    back = [F.col(n).alias(c) for n, c in zip(names, docs.columns)]
    return worded.select(*back).union(marked.where(F.col("fp").isNull()).select(*back))
