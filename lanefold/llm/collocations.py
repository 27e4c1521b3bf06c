"""Phrases whose words occur together more often than apart, from FM-indexes over word numbers.

Every task gathers its pieces of text by language into shards and indexes each shard twice, forwards and
backwards. A phrase is an interval of each index; the words beside its occurrences are read from the
Burrows-Wheeler transform of one index, which gives the intervals of all longer phrases at once, and
their places in the other follow from the numbers of smaller words. Counts of shards are summed.

Phrases are counted in four passes. The first counts words. In the second, words that are rare everywhere
part the text, and pairs are counted; in the third, rare pairs part it too, and triples are counted. The last
enumerates the longer phrases whose pairs and triples are frequent. What is frequent goes to the tasks as a bitmap of hashes, at most 2^27 bits
(16 MB): a rare phrase that passes it by chance is counted in full and dropped by its count, so results are
exact whatever the bitmap lets through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanefold.llm._bitmap import Bitmap, bitmap
from lanefold.llm._common import load, short_batches, written

LEAST, LONGEST, TOP = 100, 5, 2000
#: Phrases up to this length have a pass of their own.
ALONE = 3
#: Words of a shard, different words that are counted before they are given out, and bytes of text that are split at once.
SHARD, DISTINCT, SLICE = 1 << 20, 1 << 18, 1 << 22
UNKNOWN = "und"
#: A byte that UTF-8 doesn't use stands for what parts pieces.
PART = b"\xff"
CLEAN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + PART * 10)


def words_of(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text with ``PART`` between pieces and at the end, some MB at a time."""
    clean = raw.translate(CLEAN).replace(PART, b" \xff ") + b" \xff"
    at = 0
    while at < len(clean):
        end = len(clean) if at + SLICE >= len(clean) else clean.rfind(b" ", at, at + SLICE) + 1 or clean.find(b" ", at + SLICE) + 1
        yield clean[at:end].split()
        at = end


class Index:
    """A text of numbers (0 parts pieces), sorted by its next ``depth`` numbers or more: enough for phrases up to that length."""

    def __init__(self, text: np.ndarray, depth: int):
        self.n, rank, span = len(text), text, 1
        while True:
            nxt = np.zeros(self.n, np.int64)
            nxt[: self.n - span] = rank[span:]
            key = rank * (int(rank.max()) + 1) + nxt
            order = np.argsort(key)
            span *= 2
            if span >= depth:
                break
            sorted_key = key[order]
            rank = np.empty(self.n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[1], sorted_key[1:] != sorted_key[:-1]]))
            # what starts with a separator is in no phrase
            rank[text == 0] = 0
        before = np.zeros(self.n, np.int64)
        before[1:] = text[:-1]
        self.bwt = before[order]

    @cached_property
    def places(self) -> np.ndarray:
        """Numbers and rows of the transform as one sorted key: where a key would go is where a longer phrase begins."""
        return np.sort(self.bwt * self.n + np.arange(self.n))

    def beside(self, low: np.ndarray, size: np.ndarray, letters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each interval and each number before it: the interval's place in the list, the number, how often, and how many rows of the interval have smaller numbers."""
        owner = np.repeat(np.arange(len(low)), size)
        start = np.cumsum(size) - size
        rows = np.arange(len(owner)) + (low - start)[owner]
        key = np.sort(owner * letters + self.bwt[rows])
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        count = np.diff(np.append(first, len(key)))
        whose, number = key[first] // letters, key[first] % letters
        return whose, number, count, first - start[whose]


class Shard:
    """Both indexes of a text and the phrases in it."""

    def __init__(self, text: np.ndarray, depth: int):
        # a separator at either end, so that each direction's transform has the numbers of the text
        self.text, self.depth, self.letters = np.concatenate([[0], text, [0]]), depth, int(text.max(initial=0)) + 1

    @cached_property
    def forward(self) -> Index:
        return Index(self.text, self.depth)

    @cached_property
    def backward(self) -> Index:
        return Index(self.text[::-1], self.depth)

    def longer(self, low: tuple[np.ndarray, np.ndarray], size: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All phrases one word longer, on the right or on the left: the phrase each comes from, the word, the count, and the rows with smaller words."""
        mine, other = (self.backward, 1) if right else (self.forward, 0)
        whose, word, count, smaller = mine.beside(low[other], size, self.letters)
        real = word > 0
        return whose[real], word[real], count[real], smaller[real]

    def phrases(self, hashes: np.ndarray, known: dict[int, Bitmap]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool, np.ndarray]]:
        """By length from 2: the phrase that each comes from (of one word: its number), the word added, the count, whether it was added on the right, and the hash.

        The side alternates, so both indexes do half of the work. Phrases that ``known`` of their length, or of the length
        below for the part without the oldest end, doesn't hold are left out, with all that would come from them.
        """
        sizes = np.bincount(self.text, minlength=self.letters)
        low = np.cumsum(sizes) - sizes
        low, size, right = (low, low), sizes.copy(), True
        size[0] = 0
        h, ends = hashes, (np.arange(self.letters), np.arange(self.letters))
        for length in range(2, self.depth + 1):
            whose, word, count, smaller = self.longer(low, size, right)
            ends = (ends[0][whose], word) if right else (word, ends[1][whose])
            with np.errstate(over="ignore"):
                h = h[whose] + hashes[word] * ROLL[length - 1] if right else hashes[word] + h[whose] * ROLL[1]
                inner = (h - hashes[ends[0]]) * BACK if right else h - hashes[ends[1]] * ROLL[length - 1]
            keep = np.ones(len(h), bool)
            if length in known:
                keep &= known[length].has(mixed(h))
            if length > 2 and length - 1 in known:  # words were tested when they were numbered
                keep &= known[length - 1].has(mixed(inner))
            whose, word, count, smaller, h, ends = whose[keep], word[keep], count[keep], smaller[keep], h[keep], (ends[0][keep], ends[1][keep])
            yield whose, word, count, right, h
            if length < self.depth:
                mine, other = (self.backward, 1) if right else (self.forward, 0)
                begin = np.searchsorted(mine.places, word * mine.n + low[other][whose])
                beside = low[1 - other][whose] + smaller
                low, size, right = (beside, begin) if right else (begin, beside), count, not right


def word_hash(lang: str | Column, word: str | Column) -> Column:
    return F.xxhash64(lang, word)


#: The hash of a phrase is the sum of its words' hashes by powers of an odd number, so it grows on either side; the inverse takes the first word off.
ODD = 0x9E3779B97F4A7C15
ROLL = [np.uint64(pow(ODD, k, 1 << 64)) for k in range(64)]
BACK = np.uint64(pow(ODD, -1, 1 << 64))


def phrase_hashes(phrases: DataFrame) -> DataFrame:
    """h, the hashes of phrases (lang and phrase) as the shards have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seed = xxhash.xxh64_intdigest(lang.encode(), 42)
                h.append(sum(xxhash.xxh64_intdigest(w, seed) * int(ROLL[k]) for k, w in enumerate(phrase.encode().split(b" "))) % (1 << 64))
            yield pa.RecordBatch.from_arrays([pa.array(mixed(np.array(h, np.uint64)).view(np.int64))], names=["h"])

    return phrases.select("lang", "phrase").mapInArrow(run, "h long")


def rolled(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of pairs of words."""
    with np.errstate(over="ignore"):
        return a + b * ROLL[1]


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


class Numbers(dict):
    """Numbers of the words of one language that may be frequent; 0 for others."""

    def __init__(self, lang: str, frequent: Bitmap):
        super().__init__({PART: 0})
        self.seed = xxhash.xxh64_intdigest(lang.encode(), 42)
        self.frequent, self.words, self.hashes = frequent, [b""], [0]

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, self.seed)
        self[word] = n = len(self.words) if h in self.frequent else 0
        if n:
            self.words.append(word)
            self.hashes.append(h)
        return n


class Gatherer:
    """The text of one language in a task, given out shard by shard: each ends where a piece ends, so no phrase is cut.

    A piece without any rare word that is longer than a shard is in memory as a whole.
    """

    def __init__(self, lang: str, frequent: Bitmap, pairs: Bitmap | None, shard: int):
        self.lang, self.frequent, self.pairs, self.shard = lang, frequent, pairs, shard
        self.numbers, self.parts, self.held = Numbers(lang, frequent), [], 0

    def add(self, words: list[bytes]) -> Iterator[tuple[Numbers, np.ndarray]]:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
        self.held += len(words)
        if self.held >= self.shard:
            yield from self.give(False)

    def give(self, all_of_it: bool = True) -> Iterator[tuple[Numbers, np.ndarray]]:
        text = np.concatenate([*self.parts, np.zeros(int(all_of_it), np.int64)])
        end = np.flatnonzero(text == 0)[-1:] + 1
        end = int(end[0]) if len(end) else 0
        numbers, rest = self.numbers, text[end:]
        self.numbers = Numbers(self.lang, self.frequent)
        self.parts = [np.fromiter((self.numbers[numbers.words[k]] for k in rest.tolist()), np.int64, len(rest))]
        self.held = len(rest)
        text = self.parted(text[:end], np.array(numbers.hashes, np.uint64))
        if len(text):
            yield numbers, text

    def parted(self, text: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The text parted at rare pairs, without words that stand alone."""
        joined = (text[:-1] > 0) & (text[1:] > 0)
        if self.pairs is not None:
            joined[joined] = self.pairs.has(mixed(rolled(hashes[text[:-1][joined]], hashes[text[1:][joined]])))
        after, before = np.append(joined, False), np.append(False, joined)
        kept = after | before
        ends = kept & ~after
        out = np.zeros(int(kept.sum() + ends.sum()), np.int64)
        out[np.cumsum(kept + ends.astype(np.int64))[kept] - 1 - ends[kept]] = text[kept]
        return out


def _task(lang: str, text: str, known: dict[int, Broadcast], shard: int, told: Callable[[str, Numbers, np.ndarray, dict[int, Bitmap]], Iterator[pa.RecordBatch]]):
    """A function over batches that hands every shard of a task to ``told``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Gatherer] = {}
        maps = {m: x.value for m, x in known.items()}
        for batch in batches:
            for name, raw in zip(batch.column(lang).to_pylist(), batch.column(text).cast(pa.binary()).to_pylist(), strict=True):
                if name not in held:
                    held[name] = Gatherer(name, maps[1], maps.get(2), shard)
                mine = held[name]
                for words in words_of(raw or b""):
                    for numbers, codes in mine.add(words):
                        yield from told(name, numbers, codes, maps)
            if sum(x.held for x in held.values()) > 2 * shard:  # many languages: the fullest is given out
                name, mine = max(held.items(), key=lambda x: x[1].held)
                for numbers, codes in mine.give():
                    yield from told(name, numbers, codes, maps)
        for name, mine in held.items():
            for numbers, codes in mine.give():
                yield from told(name, numbers, codes, maps)

    return run


def count_words(rows: DataFrame) -> DataFrame:
    """lang, word and c, over all of ``rows`` (lang and text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, c in held.items():
                c.pop(PART, None)
                if c:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c)), pa.array(list(c), pa.binary()).cast(pa.string()), pa.array(list(c.values()), pa.int64())], names=["lang", "word", "c"])
            held.clear()

        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                mine = held.setdefault(lang, Counter())
                for words in words_of(raw or b""):
                    mine.update(words)
            if sum(map(len, held.values())) > DISTINCT:
                yield from out()
        yield from out()

    return rows.mapInArrow(run, "lang string, word string, c long").groupBy("lang", "word").agg(F.sum("c").alias("c"))


def frequent_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, shard: int = SHARD, bits: int = 27) -> tuple[DataFrame, DataFrame]:
    """(phrases, sizes): lang, phrase, length and f of all phrases up to ``longest`` words that occur ``least`` times or more;
    lang and n, the number of all words.

    A null language is ``und``, a null text empty. Both tables are written in the shared folder.
    """
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    words = written(count_words(rows), "words")
    sizes = words.groupBy("lang").agg(F.sum("c").alias("n"))
    single = words.filter(F.col("c") >= least)
    send = lambda hashes: spark.sparkContext.broadcast(bitmap(hashes, most=bits))
    known = {1: send(single.select(word_hash("lang", "word").alias("h")))}
    often = [single.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("length"), F.col("c").alias("f"))]
    steps = [(m, m) for m in range(2, min(longest, ALONE + 1))] + [(min(longest, ALONE + 1), longest)]
    for first, last in steps if longest > 1 else []:

        def phrases_of(name: str, numbers: Numbers, codes: np.ndarray, maps: dict[int, Bitmap], first: int = first, last: int = last) -> Iterator[pa.RecordBatch]:
            said, single = numbers.words, numbers.words
            for length, (whose, word, count, right, _) in enumerate(Shard(codes, last).phrases(np.array(numbers.hashes, np.uint64), maps), 2):
                whose, word = whose.tolist(), word.tolist()
                said = [said[a] + b" " + single[b] for a, b in zip(whose, word, strict=True)] if right else [single[b] + b" " + said[a] for a, b in zip(whose, word, strict=True)]
                for k in range(0, len(said) if length >= first else 0, 1 << 16):
                    own = said[k : k + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(own)), pa.array(own, pa.binary()).cast(pa.string()), pa.array(np.full(len(own), length, np.int32)), pa.array(count[k : k + len(own)])], names=["lang", "phrase", "length", "c"])

        found = rows.mapInArrow(_task("lang", "text", dict(known), shard, phrases_of), "lang string, phrase string, length int, c long")
        found = written(found.groupBy("lang", "phrase", "length").agg(F.sum("c").alias("f")).filter(F.col("f") >= least), f"often-{first}")
        often.append(found)
        if last < longest:
            known[last] = send(phrase_hashes(found))
    return reduce(DataFrame.unionByName, often), sizes


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, top: int = TOP, **params: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best ``top`` phrases of each language.

    a, l and r are the counts of the phrase and of the two parts of its weakest cut, n all words of the language;
    score is 1000 a n / (l r), rounded down. Of cuts that score alike the first counts. A phrase that lies in a longer
    one of the same count is left out: a count never grows with the words, so one more word on a side decides. Ties are
    ordered by a, then by the bytes of the phrase. Rows without words and empty tables give nothing.
    """
    phrases, sizes = frequent_phrases(docs, lang, text, least, longest, **params)
    word = F.split("phrase", " ")
    part = lambda first, n: F.array_join(F.slice(word, first, n), " ")
    long = phrases.filter("length > 1")
    inner = long.filter("length > 2").select("lang", "f", F.explode(F.array(part(F.lit(1), F.col("length") - 1), part(F.lit(2), F.col("length") - 1))).alias("phrase"))
    widest = inner.groupBy("lang", "phrase").agg(F.max("f").alias("wide"))
    kept = long.join(widest, ["lang", "phrase"], "left").filter(F.coalesce("wide", F.lit(0)) < F.col("f"))
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("length") - F.col("k")).alias("rest"))
    count = phrases.select("lang", "phrase", "f")
    cuts = cuts.join(count.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(count.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(sizes, "lang")
    # counts have 18 digits at most, so products stay within 38
    cuts = cuts.withColumn("score", F.expr("(1000 * cast(a as decimal(18,0)) * cast(n as decimal(18,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"))
    weakest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = weakest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language of the documents."""
    return collocations(load(spark, sf_dir, "documents").select("lang", "text"))


OP13_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), said AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
sizes AS (SELECT lang, sum(len(words)) AS n FROM said GROUP BY lang),
grams AS (
  SELECT lang, m, list_aggregate(words[i:i + m - 1], 'string_agg', ' ') AS phrase
  FROM said, range(1, {LONGEST + 1}) AS lengths(m), unnest(range(1, len(words) - m + 2)) AS places(i)
), phrases AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
inner_of AS (
  SELECT lang, unnest([list_aggregate(w[1:m - 1], 'string_agg', ' '), list_aggregate(w[2:m], 'string_agg', ' ')]) AS phrase, f
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM phrases WHERE m > 2)
), kept AS (
  SELECT p.*, string_split(phrase, ' ') AS w FROM phrases p WHERE m > 1
  AND NOT EXISTS (SELECT 1 FROM inner_of x WHERE x.lang = p.lang AND x.phrase = p.phrase AND 100 * x.f >= 100 * p.f)
), cuts AS (
  SELECT lang, phrase, f AS a, k, list_aggregate(w[1:k], 'string_agg', ' ') AS first, list_aggregate(w[k + 1:m], 'string_agg', ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, p.f AS l, q.f AS r, s.n, (1000::HUGEINT * c.a * s.n) // (p.f::HUGEINT * q.f) AS score
  FROM cuts c JOIN phrases p ON p.lang = c.lang AND p.phrase = c.first JOIN phrases q ON q.lang = c.lang AND q.phrase = c.rest JOIN sizes s ON s.lang = c.lang
), weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM weakest QUALIFY rank <= {TOP}
"""
