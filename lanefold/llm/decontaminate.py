"""Benchmark decontamination with a distributed positional inverted index.

1. The words of the test items are counted over the whole corpus. Words are named by 64-bit hashes.
2. Every test window (``window`` consecutive words of an item, or a shorter item as a whole) is
   represented by its rarest words; the corpus positions of those words are the index, one row for
   each word and text, stored as Parquet.
3. Postings meet the items on the word. A posting at position p of a word that stands at place o of an
   item votes for the alignment p - o of item and text. Alignments of a single vote end there; the others
   meet the windows on (item, place of its first chosen word), and are candidates where all chosen words
   of the window have voted: the offset-adjusted lists are intersected from the rarest words on.
4. Candidate windows are compared with the words of their texts by a 128-bit hash of the window, so a word that
   only shares the hash of another gives no match.

``near_matches`` finds, from the same index, chosen words of a window that are near each other in a text.

Items never pass the driver: their words, windows and chosen words are tables, however many there are. What
the tasks are sent is a bitmap of the words that matter, 64 bits a word and 16 MB at most, which lets other
words through by chance; these end at the next join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lanefold.llm._bitmap import Bitmap, bitmap
from lanefold.llm._common import give_back, load, own_columns, own_names, short_batches, text_key, written

#: What the contract's words consist of, after lower-casing A-Z; all else separates.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text; none for null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def windows_of(n: int, window: int) -> list[tuple[int, int]]:
    """(place, length) of each window of an item with ``n`` words."""
    return [(0, n)] if 0 < n < window else [(k, window) for k in range(n - window + 1)] if n else []


def stored_items(items: DataFrame, id: str, text: str) -> DataFrame:
    """item_no, item and text of the different items, written, so that a number stays with its item."""
    rows = items.select(F.coalesce(F.col(id).cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    return written(rows.select(F.monotonically_increasing_id().alias("item_no"), "item", "text"), "items")


def term_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42)


def signed(terms: Iterable[int]) -> pa.Array:
    return pa.array(np.fromiter(terms, np.uint64).view(np.int64))


class Wanted:
    """The words that a bitmap may hold, and their hashes; what was decided is forgotten when it is much."""

    def __init__(self, bits: Bitmap):
        self.raw, self.mask = bits.bytes.tobytes(), (1 << bits.bits) - 1  # bytes are read faster than array elements
        self.decided: set[bytes] = set()
        self.hashes: dict[bytes, int] = {}

    def among(self, words: Iterable[bytes]) -> dict[bytes, int]:
        """The hashes of words that may be held, those of ``words`` included."""
        if len(self.decided) > 200_000:
            self.decided, self.hashes = set(), {}
        new = set(words) - self.decided
        for word in new:
            h = term_of(word)
            k = h & self.mask
            if self.raw[k >> 3] >> (k & 7) & 1:
                self.hashes[word] = h
        self.decided |= new
        return self.hashes


def item_terms(items: DataFrame) -> DataFrame:
    """item_no, place and term of every word of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ws = words_of(t)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ws), no, np.int64)), pa.array(np.arange(len(ws), dtype=np.int32)), signed(map(term_of, ws))], names=["item_no", "place", "term"])

    return items.select("item_no", "text").mapInArrow(run, "item_no long, place int, term long")


def count_terms(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """term and n: how often each word of ``wanted`` (term, different ones) occurs in the whole corpus, if it does."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.select(F.col("term").alias("h"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        known = Wanted(bits.value)
        for batch in batches:
            said: Counter = Counter()
            for t in batch.column(0).to_pylist():
                said.update(words_of(t))
            hashes = known.among(said)
            for word in said.keys() & hashes.keys():
                total[hashes[word]] += said[word]
            if len(total) > 300_000:
                yield pa.RecordBatch.from_arrays([signed(total), pa.array(list(total.values()), pa.int64())], names=["term", "n"])
                total.clear()
        yield pa.RecordBatch.from_arrays([signed(total), pa.array(list(total.values()), pa.int64())], names=["term", "n"])
        del total, known
        give_back()

    return docs.select(text).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).join(wanted, "term", "left_semi")


def build_index(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """term, t1, t2, positions: where each word of ``wanted`` (term), and a few others, stand in each text (named by two hashes), as a stored table.

    Positions count words from 0. Equal texts give equal rows; a task stores those of a text once.
    """
    short_batches(docs.sparkSession)
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.select(F.col("term").alias("h"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        known = Wanted(bits.value)
        for batch in batches:
            out: list[tuple] = []
            for t, a, b in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if (a, b) in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add((a, b))
                ws = words_of(t)
                hashes = known.among(ws)
                if hashes.keys().isdisjoint(ws):
                    continue
                at: dict[int, list[int]] = {}
                for p, w in enumerate(ws):
                    if w in hashes:
                        at.setdefault(hashes[w], []).append(p)
                out += [(k, a, b, ps) for k, ps in at.items()]
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            types = [pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([signed(cols[0]), *(pa.array(c, x) for c, x in zip(cols[1:], types, strict=True))], names=["term", "t1", "t2", "positions"])
        del seen, known
        give_back()

    rows = docs.select(F.col(text), *text_key(text)).mapInArrow(run, "term long, t1 long, t2 long, positions array<int>")
    return written(rows, "postings")


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def indexed_windows(docs: DataFrame, items: DataFrame, window: int, anchors: int, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The index of the chosen words; their places in the items (item_no, place, term, alone: a window needs no other word);
    and the windows: item_no, item, place, n words, digest, need (places of the chosen words) and first (of them).

    An item is one row at most; its windows are made where its words have met their counts.
    """
    terms = written(item_terms(items), "item-terms")
    counts = count_terms(docs, terms.select("term").distinct(), text)
    counted = terms.join(counts, "term", "left").groupBy("item_no").agg(F.sort_array(F.collect_list(F.struct("place", F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("counted"))
    rows = items.join(counted, "item_no").select("item_no", "item", "text", F.col("counted")["n"].alias("freq"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, item, t, freq in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ws, out = words_of(t), []
                for place, length in windows_of(len(ws), window):
                    order = sorted(range(place, place + length), key=lambda o: (freq[o], o))
                    if freq[order[0]] == 0:
                        continue  # a word that the corpus doesn't have
                    need = sorted(order[:anchors])
                    out.append((no, item, place, length, _digest(ws[place : place + length]), need, need[0], [term_of(ws[o]) for o in need]))
                if out:
                    cols = list(zip(*out, strict=True))
                    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.int32()]
                    flat = pa.ListArray.from_arrays(np.cumsum([0, *map(len, cols[7])]).astype(np.int32), signed(x for xs in cols[7] for x in xs))
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(cols[:7], kinds, strict=True)), flat], names=[*_WINDOW, "terms"])

    windows = written(rows.mapInArrow(run, "item_no long, item string, place int, n int, digest binary, need array<int>, first int, terms array<long>"), "windows")
    spots = windows.select("item_no", (F.size("need") == 1).alias("alone"), F.explode(F.arrays_zip("need", "terms")).alias("x"))
    spots = written(spots.groupBy("item_no", F.col("x.need").alias("place"), F.col("x.terms").alias("term")).agg(F.max("alone").alias("alone")), "spots")
    return build_index(docs, spots.select("term").distinct(), text), spots, windows.select(*_WINDOW)


_WINDOW = ["item_no", "item", "place", "n", "digest", "need", "first"]


def phrase_candidates(docs: DataFrame, items: DataFrame, window: int, anchors: int, text: str) -> DataFrame:
    """t1, t2, item, at (position in the text, 0 or more), n and digest of windows whose rarest words all stand where they should."""
    index, spots, windows = indexed_windows(docs, items, window, anchors, text)
    votes = index.join(spots, "term").select("item_no", "t1", "t2", "place", "alone", F.explode("positions").alias("p"))
    met = votes.groupBy("item_no", "t1", "t2", (F.col("p") - F.col("place")).alias("shift")).agg(F.collect_set("place").alias("met"), F.max("alone").alias("alone"))
    met = met.filter((F.size("met") > 1) | F.col("alone"))
    # Windows meet alignments at one place, so an item costs its alignments what they match, not all its windows.
    found = met.withColumn("first", F.explode("met")).join(windows, ["item_no", "first"])
    found = found.filter((F.col("shift") + F.col("place") >= 0) & (F.size(F.array_except("need", "met")) == 0))
    return found.select("t1", "t2", "item", (F.col("shift") + F.col("place")).alias("at"), "n", "digest")


def near_matches(docs: DataFrame, items: DataFrame, within: int = 5, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """t1, t2 (see ``text_key``), item, place, p, q: where the two rarest words of an item's window lie at most ``within`` words
    apart in a text, in any order. Windows of one word, and of two equal ones, have none; an empty table gives an empty one."""
    index, spots, windows = indexed_windows(docs, stored_items(items, item_id, item_text), window, 2, text)
    pairs = windows.filter(F.size("need") == 2).select("item_no", "item", "place", F.col("need")[0].alias("o1"), F.col("need")[1].alias("o2"))
    term = lambda o, name: spots.select("item_no", F.col("place").alias(o), F.col("term").alias(name))
    pairs = pairs.join(term("o1", "k1"), ["item_no", "o1"]).join(term("o2", "k2"), ["item_no", "o2"]).filter("k1 <> k2").select("item", "place", "k1", "k2")
    asked = written(pairs.select("k1", "k2").distinct(), "pairs")
    cell = max(within, 1)
    a = index.join(asked, F.col("term") == F.col("k1")).select("k1", "k2", "t1", "t2", F.explode("positions").alias("p")).withColumn("cell", F.floor(F.col("p") / cell))
    b = index.join(asked, F.col("term") == F.col("k2")).select("k1", "k2", "t1", "t2", F.explode("positions").alias("q"))
    b = b.withColumn("cell", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col("q") / cell) + d)))
    near = a.join(b, ["k1", "k2", "t1", "t2", "cell"]).filter(F.abs(F.col("p") - F.col("q")) <= within).select("k1", "k2", "t1", "t2", "p", "q").distinct()
    return near.join(pairs, ["k1", "k2"]).select("t1", "t2", "item", "place", "p", "q").distinct()


def _contaminated(docs: DataFrame, items: DataFrame, new: list[str], window: int = 10, anchors: int = 2, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` and the results of ``contamination`` under the names ``new``, which ``docs`` doesn't have."""
    short_batches(docs.sparkSession)
    found = written(phrase_candidates(docs, stored_items(items, item_id, item_text), window, anchors, text), "candidates")
    one, two, cands = own_names(3)
    per_text = found.groupBy(F.col("t1").alias(one), F.col("t2").alias(two)).agg(F.collect_set(F.struct("item", "at", "n", "digest")).alias(cands))
    k1, k2 = own_names(2)
    keyed = docs.withColumns({k1: text_key(text)[0], k2: text_key(text)[1]})
    rows = keyed.join(per_text, (F.col(k1) == F.col(one)) & (F.col(k2) == F.col(two)), "left").select(*[F.col(f"`{c}`") for c in docs.columns], cands)
    made = [("long", pa.int64()), ("long", pa.int64()), ("array<string>", pa.list_(pa.string())), ("array<struct<start:int,end:int>>", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(", ".join(f"`{n}` {k}" for n, (k, _) in zip(new, made, strict=True))).fields])
    where = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, cands in zip(batch.column(where).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                ws = words_of(t)
                hit, whose = np.zeros(len(ws) + 1, np.int64), set()
                for c in cands or ():
                    a, n = c["at"], c["n"]
                    if a + n <= len(ws) and _digest(ws[a : a + n]) == c["digest"]:
                        hit[a] += 1
                        hit[a + n] -= 1
                        whose.add(c["item"])
                covered = (np.cumsum(hit) > 0).astype(np.int8)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], covered))))
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]
                out.append((len(ws), int(covered.sum()), sorted(whose), spans))
            cols = [pa.array([o[k] for o in out], made[k][1]) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], names=schema.names)

    return rows.mapInArrow(run, schema)


def contamination(docs: DataFrame, items: DataFrame, **params) -> DataFrame:
    """``docs`` with n_words, n_hit, items (sorted array of string) and spans (array of word ranges, end exclusive).

    A word is hit if it lies in an occurrence of any window. Null, empty and word-free texts have no
    words and no hits; such items have no windows. Item identifiers are taken as strings (null: "null");
    several rows of one identifier are all searched. Repeated documents get equal results, rows are kept
    one for one. Either table may be empty. Columns of ``docs`` with the names of the new ones are replaced.
    """
    new = ["n_words", "n_hit", "items", "spans"]
    return _contaminated(own_columns(docs, new, [params.get("text", "text")]), items, new, **params)


def decontaminated(docs: DataFrame, items: DataFrame, **params) -> DataFrame:
    """``docs``, in its own columns, without the documents that hold any window of an item."""
    new = own_names(4)
    return _contaminated(docs, items, new, **params).filter(F.col(new[1]) == 0).drop(*new)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_words, n_hit and the items found, of every document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, load(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
