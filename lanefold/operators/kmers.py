"""k-mers: counting, histograms, peaks and comparison of reads with assemblies.

Sequences are cut where the bucket of their minimizer changes, and the runs are packed two bits a letter; a shuffle
by sample and bucket brings all windows of a k-mer to one task, which counts bucket by bucket. Windows overlap
in a run, so a letter costs little more than a byte. Reads and an assembly that are compared meet in their buckets
and only the numbers of k-mers by both multiplicities leave them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from lanefold.functions import minimizers as M

#: Buckets of a sample; letters of a piece of a long sequence; letters that are cut, and windows that are counted at once; bytes of packed letters that
#: a task gathers, so that a bucket's row holds many runs; rows that are unpacked at once.
BUCKETS, PIECE, SLICE, CHUNK, GATHERED, ROWS = 4096, 1 << 14, 1 << 20, 1 << 20, 1 << 24, 256


def _pieces(seqs: DataFrame, k: int) -> DataFrame:
    """sample and raw, the bytes of sequences; long ones in pieces that overlap by k - 1, so every window is in one piece."""
    if not 0 < k < 32:
        raise ValueError("k must be 1 to 31")
    whole = seqs.select("sample", F.encode("seq", "UTF-8").alias("seq")).filter(F.octet_length("seq") >= k)
    parts = whole.select("sample", "seq", F.explode(F.sequence(F.lit(0), F.octet_length("seq") - k, F.lit(PIECE))).alias("at"))
    return parts.select("sample", F.substring("seq", F.col("at") + 1, F.lit(PIECE + k - 1)).alias("raw"))


def _slices(batches: Iterator[pa.RecordBatch], k: int, number: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Digits of some sequences, parted by a 4, and the number of the sample of each letter."""
    for batch in batches:
        held, size = [], 0
        for sample, raw in _rows(batch):
            held.append((number.setdefault(sample, len(number)), raw))
            size += len(raw) + 1
            if size >= SLICE:
                yield _slice(held)
                held, size = [], 0
        if held:
            yield _slice(held)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for at in range(0, batch.num_rows, ROWS):
        yield from zip(*(c.to_pylist() for c in batch.slice(at, ROWS).columns), strict=True)


def _slice(held: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    return M.DIGITS[np.frombuffer(b"\n".join(raw for _, raw in held) + b"\n", np.uint8)], np.repeat([n for n, _ in held], [len(raw) + 1 for _, raw in held])


def packed_kmers(seqs: DataFrame, k: int = 21) -> DataFrame:
    """sample, kmer: each canonical k-mer of ``seq`` as a whole number of two bits a letter; k is 31 at most.

    Other letters than A, C, G and T part a sequence; null sequences and parts below k letters give no rows.
    """
    rows = _pieces(seqs, k)
    schema = StructType([rows.schema["sample"], StructField("kmer", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict = {}
        for digits, owner in _slices(batches, k, number):
            least = np.minimum(*M.packed(np.minimum(digits, 3), k))
            bad = np.concatenate([[0], np.cumsum(digits > 3)])
            at = np.flatnonzero(bad[k:] == bad[: len(digits) - k + 1]) if len(digits) >= k else np.empty(0, np.int64)
            samples = pa.array(list(number), _arrow(schema["sample"]))
            yield pa.RecordBatch.from_arrays([samples.take(pa.array(owner[at])), pa.array(least[at].view(np.int64))], names=["sample", "kmer"])

    return rows.mapInArrow(run, schema)


def _arrow(field: StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


def _runs(seqs: DataFrame, k: int, side: int, buckets: int) -> DataFrame:
    """sample, side, bucket, sizes, letters, kmers, counts: packed runs, or counts of buckets that are shorter that way.

    Counts stay in the task until it ends, so a k-mer that fills much of the data leaves each task once.
    """
    rows = _pieces(seqs, k)
    binary = [StructField(n, BinaryType()) for n in ("sizes", "letters", "kmers", "counts")]
    schema = StructType([rows.schema["sample"], StructField("side", IntegerType()), StructField("bucket", LongType()), *binary])

    def batch(samples: pa.Array, keys: np.ndarray, *columns: pa.Array | list[bytes] | None) -> pa.RecordBatch:
        n = len(keys)
        made = [c if isinstance(c, pa.Array) else pa.array(c if c is not None else [None] * n, pa.binary()) for c in columns]
        return pa.RecordBatch.from_arrays([samples.take(pa.array(keys // buckets)), pa.array(np.full(n, side, np.int32)), pa.array(keys % buckets), *made], names=schema.names)

    def split(raw: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        ends = np.cumsum(sizes).tolist()
        raw = raw.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        holds = 0
        gathered: list[M.Packed] = []
        bytes_ = 0

        def packed() -> pa.RecordBatch:
            keys = np.concatenate([p.keys for p in gathered])
            order = np.argsort(keys, kind="stable")
            head = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0]))
            sizes = _joined([p.sizes for p in gathered], [p.runs for p in gathered], order, head)
            letters = _joined([p.letters for p in gathered], [p.bytes for p in gathered], order, head)
            return batch(pa.array(list(number), _arrow(schema["sample"])), keys[order][head], sizes, letters, None, None)

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            key, kmer, count = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((kmer, key))
            key, kmer, count = key[order], kmer[order], count[order]
            new = np.flatnonzero(np.concatenate([[True], (np.diff(key) != 0) | (kmer[1:] != kmer[:-1])]))
            return key[new], kmer[new], np.add.reduceat(count, new)

        def out() -> Iterator[pa.RecordBatch]:
            key, kmer, count = held[0]
            head = np.flatnonzero(np.concatenate([[True], np.diff(key) != 0]))
            n = np.diff(np.append(head, len(key))) * 8
            yield batch(pa.array(list(number), _arrow(schema["sample"])), key[head], None, None, split(kmer, n), split(count.astype(np.int64), n))

        for digits, owner in _slices(batches, k, number):
            runs, counted = M.cut(digits, owner, k, buckets)
            if len(runs.keys):
                gathered.append(runs)
                bytes_ += len(runs.letters)
                if bytes_ >= GATHERED:
                    yield packed()
                    gathered, bytes_ = [], 0
            if len(counted[0]):
                held.append(counted)
                holds += len(counted[0])
                if holds > CHUNK:
                    held = [merged()]
                    holds = len(held[0][0])
                    if holds > CHUNK // 2:
                        yield from out()
                        held, holds = [], 0
        if gathered:
            yield packed()
        if held:
            held = [merged()]
            yield from out()

    return rows.mapInArrow(run, schema)


def _joined(raw: list[np.ndarray], sizes: list[np.ndarray], order: np.ndarray, head: np.ndarray) -> pa.Array:
    """``raw``, cut by ``sizes`` and put in order, with all from one head to the next as one value."""
    value = lambda ends, data: pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), data])
    ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    sorted_ = value(ends, pa.py_buffer(np.concatenate(raw))).take(pa.array(order))
    ends = np.frombuffer(sorted_.buffers()[1], np.int32, len(order) + 1, sorted_.offset * 4)
    return value(ends[np.append(head, len(order))], sorted_.buffers()[2])


def _counted(runs: DataFrame, k: int, sides: int, schema: StructType, told) -> DataFrame:
    """``told(sample, kmers, counts by side)`` gives the columns after sample; each k-mer of a sample is told once.

    Rows come sorted by sample and bucket. Whole buckets are counted together up to a chunk; a larger one is summed
    up as it comes, chunks with chunks of their size, so a task holds different k-mers, not windows, and each is sorted a few times only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: dict[object, list] = {}  # sample: its k-mers and counts so far, larger parts first
        rows: list[tuple] = []
        last, size = None, 0

        def add() -> None:
            by_sample: dict = {}
            for r in rows:
                by_sample.setdefault(r[0], []).append(r)
            for sample, mine in by_sample.items():
                kmers, counts = [], []
                for s in range(sides):
                    packed = [r for r in mine if r[1] == s and r[3] is not None]
                    found = [M.windows_of([r[3] for r in packed], [r[4] for r in packed], k)[0]] if packed else []
                    n = [np.ones(len(x), np.int64) for x in found]
                    found += [np.frombuffer(r[5], np.uint64) for r in mine if r[1] == s and r[5] is not None]
                    n += [np.frombuffer(r[6], np.int64) for r in mine if r[1] == s and r[6] is not None]
                    for x, c in zip(found, n, strict=True):
                        both = np.zeros((len(x), sides), np.int64)
                        both[:, s] = c
                        kmers.append(x)
                        counts.append(both)
                parts = done.setdefault(sample, [])
                parts.append(M.summed(np.concatenate(kmers), np.concatenate(counts)))
                while len(parts) > 1 and len(parts[-2][0]) <= 2 * len(parts[-1][0]):
                    join(parts)
            rows.clear()

        def join(parts: list) -> None:
            (x, m), (y, n) = parts.pop(), parts.pop()
            parts.append(M.summed(np.concatenate([x, y]), np.concatenate([m, n])))

        def give() -> Iterator[pa.RecordBatch]:
            add()
            for sample, parts in done.items():
                while len(parts) > 1:
                    join(parts)
                columns = told(*parts.pop())
                for at in range(0, len(columns[0]), CHUNK):
                    part = [pa.array(c[at : at + CHUNK]) for c in columns]
                    yield pa.RecordBatch.from_arrays([pa.array([sample] * len(part[0]), _arrow(schema["sample"])), *part], names=schema.names)
            done.clear()

        for batch in batches:
            for row in _rows(batch):
                if size >= CHUNK:
                    if (row[0], row[2]) != last:
                        yield from give()
                    else:
                        add()
                    size = 0
                last = row[0], row[2]
                rows.append(row)
                size += len(row[4] or b"") * 4 + len(row[5] or b"") // 8
        if rows or done:
            yield from give()

    return runs.repartition("sample", "bucket").sortWithinPartitions("sample", "bucket").mapInArrow(run, schema)


def count_kmers(seqs: DataFrame, k: int = 21, buckets: int = BUCKETS) -> DataFrame:
    """sample, kmer, cnt of canonical k-mers, packed into whole numbers (see ``kmer_text``); k is 31 at most.

    Other letters than A, C, G and T part a sequence; null sequences and parts below k letters give no rows, a null sample
    is one like others. Repeated sequences count repeatedly.
    """
    return count_together(seqs, k=k, buckets=buckets)


def count_together(*tables: DataFrame, k: int = 21, buckets: int = BUCKETS) -> DataFrame:
    """``union_sum`` of the counts of several tables (sample and seq, samples of one type); k-mers of all meet in their buckets, counts aren't shuffled."""
    runs = _runs(tables[0], k, 0, buckets)
    for t in tables[1:]:
        runs = runs.unionByName(_runs(t, k, 0, buckets))
    schema = StructType([runs.schema["sample"], StructField("kmer", LongType()), StructField("cnt", LongType())])
    return _counted(runs, k, 1, schema, lambda kmers, counts: (kmers.view(np.int64), np.ascontiguousarray(counts[:, 0])))


def joint_spectrum(reads: DataFrame, assembly: DataFrame, k: int = 21, buckets: int = BUCKETS) -> DataFrame:
    """sample, multiplicity (in the reads), copies (in the assembly), n: how many different k-mers have both numbers.

    Both tables are sample and seq, and their samples are of one type. k-mers meet in their buckets and never leave them.
    """
    runs = _runs(reads, k, 0, buckets).unionByName(_runs(assembly, k, 1, buckets))
    names = ("multiplicity", "copies", "n")
    schema = StructType([runs.schema["sample"], *(StructField(n, LongType()) for n in names)])

    def told(kmers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort((counts[:, 1], counts[:, 0]))
        both = counts[order]
        new = np.flatnonzero(np.concatenate([[True], (both[1:] != both[:-1]).any(1)])) if len(both) else order
        return np.ascontiguousarray(both[new, 0]), np.ascontiguousarray(both[new, 1]), np.diff(np.append(new, len(both)))

    return _counted(runs, k, 2, schema, told).groupBy("sample", "multiplicity", "copies").agg(F.sum("n").alias("n"))


def joint_of_counts(reads: DataFrame, assembly: DataFrame) -> DataFrame:
    """``joint_spectrum`` of counted k-mers (sample, kmer, cnt)."""
    r, a = reads.select("sample", "kmer", F.col("cnt").alias("multiplicity")), assembly.select("sample", "kmer", F.col("cnt").alias("copies"))
    t = r.join(a, ["sample", "kmer"], "full").fillna(0, ["multiplicity", "copies"])
    return t.groupBy("sample", "multiplicity", "copies").agg(F.count("*").alias("n"))


def union_sum(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.groupBy("sample", "kmer").agg(F.sum("cnt").alias("cnt"))


def kmer_histogram(counts: DataFrame, most: int | None = None) -> DataFrame:
    """sample, cov, cnt: how many different k-mers occur ``cov`` times."""
    out = counts.groupBy("sample", F.col("cnt").alias("cov")).agg(F.count("*").alias("n")).withColumnRenamed("n", "cnt")
    return out if most is None else out.filter(F.col("cov") <= most)


def find_kmer_peak(hist: DataFrame, least_rows: int = 20, floor: float = 0.001, ahead: int = 5, rise: float = 1.05, contrast: float = 1.3) -> DataFrame:
    """sample, peak_cov, trough_cov and reason of the peak that rises after the first trough.

    Rows below ``floor`` of the first row's count are dropped; the trough is the first row, not the last, that one
    of the next ``ahead`` rows exceeds by the factor ``rise``; the peak is the highest count from there on, lowest
    coverage on ties, if it is ``contrast`` times the trough.
    """
    by = Window.partitionBy("sample").orderBy("cov")
    every = Window.partitionBy("sample")
    t = hist.withColumns({"rows0": F.count("*").over(every), "first_cnt": F.first("cnt").over(by)})
    kept = t.filter(F.col("cnt") >= floor * F.col("first_cnt"))
    kept = kept.withColumns({"rows1": F.count("*").over(every), "next_max": F.max("cnt").over(by.rowsBetween(1, ahead))})
    kept = kept.withColumn("trough_cov", F.min(F.when(F.col("next_max") > rise * F.col("cnt"), F.col("cov"))).over(every))
    found = kept.groupBy("sample").agg(
        F.first("rows0").alias("rows0"), F.first("rows1").alias("rows1"), F.first("trough_cov").alias("trough_cov"),
        F.max(F.when(F.col("cov") == F.col("trough_cov"), F.col("cnt"))).alias("trough_cnt"),
        F.max(F.when(F.col("cov") >= F.col("trough_cov"), F.struct("cnt", (-F.col("cov")).alias("minus")))).alias("best"),
    )
    reason = (
        F.when((F.col("rows0") < least_rows) | (F.col("rows1") < least_rows), "histogram_too_short")
        .when(F.col("trough_cov").isNull(), "no_trough_histogram_monotone")
        .when((F.col("trough_cnt") <= 0) | (F.col("best.cnt") < contrast * F.col("trough_cnt")), "no_mode_above_trough")
        .otherwise("ok")
    )
    found = found.withColumn("reason", reason)
    shown = F.col("reason").isin("ok", "no_mode_above_trough")
    return found.select("sample", F.when(F.col("reason") == "ok", -F.col("best.minus")).alias("peak_cov"), F.when(shown, F.col("trough_cov")).alias("trough_cov"), "reason")


def qv_of(spectrum: DataFrame, k: int = 21) -> DataFrame:
    """sample, only_kmers, total_kmers, error, qv: k-mers of the assembly that the reads lack, by copies.

    A sample without assembled k-mers has no row; qv is null where nothing is wrong.
    """
    t = spectrum.filter("copies > 0").withColumn("all", F.col("copies") * F.col("n"))
    t = t.groupBy("sample").agg(F.sum(F.when(F.col("multiplicity") == 0, F.col("all")).otherwise(0)).alias("only_kmers"), F.sum("all").alias("total_kmers"))
    t = t.withColumn("error", 1 - F.pow(1 - F.try_divide("only_kmers", "total_kmers"), F.lit(1.0 / k)))
    return t.withColumn("qv", F.when(F.col("error") > 0, -10 * F.log10("error")))


def completeness_of(spectrum: DataFrame, solid: int | None = None) -> DataFrame:
    """sample, solid and found k-mers of the reads, and the percentage found in the assembly.

    Solid are k-mers at or above ``solid``; None takes the trough of each sample's histogram, 2 where it has none. A
    sample without solid k-mers has no row.
    """
    t = spectrum.filter("multiplicity > 0")
    least = F.lit(solid)
    if solid is None:
        hist = t.groupBy("sample", F.col("multiplicity").alias("cov")).agg(F.sum("n").alias("cnt"))
        t, least = t.join(find_kmer_peak(hist).select("sample", F.coalesce("trough_cov", F.lit(2)).alias("least")), "sample"), F.col("least")
    t = t.filter(F.col("multiplicity") >= least).groupBy("sample").agg(F.sum("n").alias("solid_kmers"), F.sum(F.when(F.col("copies") > 0, F.col("n")).otherwise(0)).alias("found_kmers"))
    return t.withColumn("completeness", F.try_divide(F.col("found_kmers") * 100.0, F.col("solid_kmers")))


def copies_of(spectrum: DataFrame, most: int = 5) -> DataFrame:
    """sample, multiplicity in the reads, copies in the assembly (``most`` and more together), k-mers; those that only the assembly has are left out."""
    t = spectrum.filter("multiplicity > 0").withColumn("copies", F.least("copies", F.lit(most)))
    return t.groupBy("sample", "multiplicity", "copies").agg(F.sum("n").alias("n"))


def assembly_qv(assembly: DataFrame, reads: DataFrame, k: int = 21) -> DataFrame:
    """``qv_of`` counted k-mers."""
    return qv_of(joint_of_counts(reads, assembly), k)


def kmer_completeness(reads: DataFrame, assembly: DataFrame, solid: int | None = None) -> DataFrame:
    """``completeness_of`` counted k-mers."""
    return completeness_of(joint_of_counts(reads, assembly), solid)


def spectra_cn(reads: DataFrame, assembly: DataFrame, most: int = 5) -> DataFrame:
    """``copies_of`` counted k-mers."""
    return copies_of(joint_of_counts(reads, assembly), most)
