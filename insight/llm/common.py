"""Word classes, byte-level tokenising and small helpers shared by the operators.

Text is UTF-8.  Both word classes are unions of ASCII ranges plus every
non-ASCII character, so cutting the bytes gives the same words as cutting the
characters: all bytes of a non-ASCII character are >= 0x80.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.sources.checkpoint import materialize

#: What stands between the words of the operator contracts, whose
#: words are runs of all other characters.
SPACED_GAP = r"[\x20\x09-\x0D]+"
LETTER_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Text handled at once inside a task.  Bounds the numpy temporaries; a longer
#: single text is still handled whole, alone.
SLICE_BYTES = 1 << 20
CHUNK = 1 << 18


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column, between: str = SPACED_GAP) -> Column:
    """All words of a text; null has none.

    Splitting between words is several times faster than matching the words.
    """
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def unit_hash(*parts: Column | str) -> Column:
    """Uniform number in [0, 1) from the MD5 of the parts (48 bits).

    Written with MD5 so that other SQL engines can repeat it.
    """
    cols = [F.coalesce(F.lit(p) if isinstance(p, str) else p.cast("string"), F.lit("null")) for p in parts]
    digits = F.substring(F.md5(F.concat_ws(":", *cols).cast("binary")), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 48))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the fold; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def unused_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


# --- bytes -----------------------------------------------------------------

_byte = np.arange(256)
IS_SPACE = (_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D))
IS_LETTER = ((_byte >= 0x30) & (_byte <= 0x39)) | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)
TO_LOWER = np.where((_byte >= 0x41) & (_byte <= 0x5A), _byte + 32, _byte).astype(np.uint8)

MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)


def salt(i: int) -> np.uint64:
    """The i-th multiple of a fixed odd number."""
    return np.uint64(i * int(MULT) & (1 << 64) - 1)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """Words of consecutive texts: 64-bit hash, byte range, and words per text."""

    def __init__(self, hashes, starts, ends, counts):
        self.hashes, self.starts, self.ends, self.counts = hashes, starts, ends, counts
        self.offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    @property
    def text_ids(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def segments(flags: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags, also cut at every bound."""
    if not len(flags):
        e = np.zeros(0, np.int64)
        return e, e
    cut = np.zeros(len(flags) + 1, bool)
    cut[bounds] = True
    prev = np.concatenate([[False], flags[:-1]])
    nxt = np.concatenate([flags[1:], [False]])
    starts = np.flatnonzero(flags & (~prev | cut[:-1]))
    ends = np.flatnonzero(flags & (~nxt | cut[1:])) + 1
    return starts, ends


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte run (polynomial over the run, mixed with its length)."""
    out = np.zeros(len(starts), np.uint64)
    lens = ends - starts
    total = np.cumsum(lens)
    a = 0
    while a < len(starts):  # about CHUNK bytes at a time: small temporaries that stay in the cache
        done = total[a] - lens[a]
        b = max(a + 1, int(np.searchsorted(total, done + CHUNK, side="right")))
        own = lens[a:b]
        first = total[a:b] - own - done
        pos = np.arange(int(own.sum()), dtype=np.int64) - np.repeat(first, own)
        vals = (data[pos + np.repeat(starts[a:b], own)].astype(np.uint64) + np.uint64(1)) * _powers(int(own.max()))[pos]
        # an empty run (a cut-off word) would take the next one's first value
        filled = own > 0
        out[a:b][filled] = np.add.reduceat(vals, first[filled]) if filled.any() else 0
        a = b
    return mix(out + lens.astype(np.uint64) * MULT)


def words_in(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
    """Words in ``data`` (bytes of consecutive texts at ``offsets``) made of ``kind`` bytes."""
    starts, ends = segments(kind[data], offsets)
    counts = np.diff(np.searchsorted(starts, offsets))
    return Words(run_hashes(data, starts, ends), starts, ends, counts)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an Arrow string column in runs of rows with about ``limit`` bytes.

    Yields (first row, end row, bytes, offsets); null texts are empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, off_buf, data_buf = column.buffers()
    offs = np.frombuffer(off_buf, np.int64)[column.offset: column.offset + n + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
    lens = np.diff(offs)
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    packed = not (nulls & (lens > 0)).any()
    a = 0
    while a < n:
        b = int(np.searchsorted(offs, offs[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        if packed:
            yield a, b, data[offs[a]: offs[b]], offs[a: b + 1] - offs[a]
        else:
            keep = np.where(nulls[a:b], 0, lens[a:b])
            parts = [data[offs[i]: offs[i] + keep[i - a]] for i in range(a, b)]
            yield a, b, np.concatenate(parts), np.concatenate([[0], np.cumsum(keep)]).astype(np.int64)
        a = b


def lists(values, counts: Sequence[int], kind: pa.DataType) -> pa.Array:
    """Arrow list column from flat values and lengths."""
    offs = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(values, kind))


# --- labelled rows -----------------------------------------------------------

def labelled_ids(labels: DataFrame, column: str, keep: Column | None = None) -> DataFrame:
    """(doc_id, label): one row per labelled id; of several labels the largest counts."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    if keep is not None:
        ids = ids.where(keep)
    return ids.groupBy("doc_id").agg(F.max(column).alias("label"))


def labelled_sample(labels: DataFrame, column: str, bound: int, keep: Column | None = None) -> DataFrame:
    """At most about ``bound`` labelled ids with their label, chosen by id hash.

    One row per non-null doc_id; of several labels the largest counts.  The
    sample rate is set from the number of rows, so the result's size is
    bounded whatever the table's size is (it can be broadcast).
    """
    ids = labelled_ids(labels, column, keep)
    n = ids.count()
    if n > bound:
        ids = ids.where(unit_hash("sample", F.col("doc_id")) < F.lit(bound / n))
    return ids


def text_draw(seed: str, *parts: Column) -> Column:
    """Uniform number in [0, 1) from the seed and the parts (52 bits)."""
    return F.xxhash64(F.lit(seed), *parts).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))


def labelled_texts(docs: DataFrame, ids: DataFrame, bound: int, seed: str = "sample") -> DataFrame:
    """(doc_id, text, label): at most ``bound`` distinct (doc_id, text) of ``docs`` with a label in ``ids``.

    Equal rows count once; a doc_id that holds many texts is drawn text by text, so it is
    represented like the others and cannot fill the sample.  The draw sees ids and text
    hashes only; its result, at most ``bound`` rows of numbers, is sent to the scan that
    fetches the texts.
    """
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    keys = stored(hashed.select("doc_id", "text_key").distinct().join(ids, "doc_id"), "sample-keys")
    n = keys.count()
    drawn = keys
    if n > bound:  # about a fifth too many, then the smallest draws
        draw = text_draw(seed, F.col("doc_id"), F.col("text_key"))
        drawn = keys.withColumn("draw", draw).where(F.col("draw") < F.lit(1.2 * bound / n)).orderBy("draw").limit(bound).drop("draw")
    drawn = stored(drawn, "sample-drawn")
    rows = hashed.join(F.broadcast(drawn), ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "label")
    return rows.dropDuplicates(["doc_id", "text_key"]).select("doc_id", "text", "label")


# --- stored steps and grouped tasks -------------------------------------------

def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and return a scan of it."""
    return materialize(df, f"llm-{name}")


#: Bits of a key filter: 2,048 bitmaps of 4 KB, 8 MB in all, whatever the number of keys.
FILTER_BITS = 1 << 26


def maybe_in(df: DataFrame, key: str, ids: DataFrame, name: str) -> DataFrame:
    """``df`` with a flag that is true for every row whose key is in ``ids``, and for few others.

    A hash filter like a Bloom filter of one hash.  It decides which rows need
    an exact join, so that the others are not shuffled.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    maps = (ids.select(F.bitmap_bucket_number(slot).alias("__map"), F.bitmap_bit_position(slot).alias("__bit"))
            .groupBy("__map").agg(F.bitmap_construct_agg("__bit").alias("__bits")))
    bit = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    flag = F.coalesce(F.expr("shiftright(__byte, cast(__bit % 8 as int)) & 1") == 1, F.lit(False))
    return (df.withColumn("__map", F.bitmap_bucket_number(slot)).join(F.broadcast(maps), "__map", "left")
            .withColumn("__byte", byte).withColumn("__bit", bit).withColumn(name, flag)
            .drop("__map", "__bits", "__byte", "__bit"))


#: Bits of a filter that tasks are sent (16 MB), and where in a 64-bit hash its two places come from.
BLOOM_BITS, BLOOM_SHIFTS = 1 << 27, (0, 32)


def bloom_bits(hashes: DataFrame) -> np.ndarray:
    """Bloom filter of a one-column frame of 64-bit hashes, two bits each: ``BLOOM_BITS`` bits whatever their number."""
    (column,) = hashes.columns
    slots = [F.shiftright(column, s).bitwiseAND(F.lit(BLOOM_BITS - 1)) + 1 for s in BLOOM_SHIFTS]  # Spark's bitmaps number from 1
    slot = F.col("slot")
    maps = (hashes.select(F.explode(F.array(*slots)).alias("slot"))
            .select(F.bitmap_bucket_number(slot).alias("map"), F.bitmap_bit_position(slot).alias("bit"))
            .groupBy("map").agg(F.bitmap_construct_agg("bit").alias("bits"))).toArrow()
    out = np.zeros(BLOOM_BITS // 8, np.uint8)
    for number, bits in zip(maps.column("map").to_pylist(), maps.column("bits").to_pylist()):
        out[(number - 1) * len(bits): number * len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def in_bloom(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Positions of the hashes that may be in the filter."""
    some = np.arange(len(hashes))
    for shift in BLOOM_SHIFTS:
        slot = (hashes[some] >> np.uint64(shift) & np.uint64(BLOOM_BITS - 1)).astype(np.int64)
        some = some[(bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0]
    return some


def only(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is in ``ids`` (a one-column frame of that name); few others are shuffled."""
    flagged = maybe_in(df, key, ids, "__maybe").where("__maybe").drop("__maybe")
    return flagged.join(ids, key, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])


def without(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is not in ``ids``; rows that surely are not are not shuffled."""
    flagged = maybe_in(df, key, ids, "__maybe")
    columns = [F.col(f"`{c}`") for c in df.columns]
    sure = flagged.where("not __maybe").select(*columns)
    return sure.unionByName(flagged.where("__maybe").join(ids, key, "left_anti").select(*columns))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of start, start + 1, ... (count of them) per entry."""
    if not len(counts):
        return np.zeros(0, np.int64)
    before = np.concatenate([[0], np.cumsum(counts)[:-1]])
    return np.arange(int(counts.sum())) - np.repeat(before - starts, counts)


def key_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal keys, of batches sorted by an integer key."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)
