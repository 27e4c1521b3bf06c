"""Taxonomy: closure, clades, names and fuzzy matches."""

from __future__ import annotations


from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanefold.functions import shared


def clean_species(name: Column) -> Column:
    """The first two words without brackets, quotes, open-nomenclature qualifiers and letters' neighbours."""
    t = F.regexp_replace(name, r"\([^)]*\)|`[^`]*`|[\"']", " ")
    t = F.regexp_replace(t, r"(?i)\b(spp?|cf|aff|nr|TBC)\b\.?", " ")
    words = F.filter(F.transform(F.split(F.trim(t), r"\s+"), lambda w: F.regexp_replace(w, "^[^A-Za-z]+|[^A-Za-z]+$", "")), lambda w: w != "")
    return F.array_join(F.slice(words, 1, 2), " ")


def written(df: DataFrame) -> DataFrame:
    return shared.written(df, "taxonomy")


def closure(nodes: DataFrame) -> DataFrame:
    """taxid, ancestor, depth for every node and itself (0), by doubling: paths of up to 2**n steps after n joins.

    A root's missing or dangling parent ends a path; joins go on until no path grows. Raises ValueError on a cycle
    of several nodes: one of them comes back to itself. Each round is written, so that plans don't double too.
    """
    links = nodes.select("taxid", F.col("parent").alias("up")).join(nodes.select(F.col("taxid").alias("up")), "up", "left_semi").filter("up <> taxid")
    reach = nodes.select("taxid", F.col("taxid").alias("ancestor"), F.lit(0).alias("depth"))
    jump, step = written(links.select("taxid", "up")), 1
    while True:
        far = reach.join(jump.withColumnRenamed("taxid", "mid"), F.col("ancestor") == F.col("mid"))
        far = written(far.select(reach["taxid"], F.col("up").alias("ancestor"), (F.col("depth") + step).alias("depth")))
        if far.isEmpty():
            return reach
        if not far.filter("taxid = ancestor").isEmpty():
            raise ValueError("the parents of the taxonomy form a cycle")
        reach = reach.unionByName(far)
        jump = written(jump.alias("a").join(jump.alias("b"), F.expr("a.up = b.taxid")).select("a.taxid", "b.up"))
        step *= 2


def in_clade(closed: DataFrame, clade: int) -> DataFrame:
    """taxid of the clade itself and of everything below it; an unknown clade has none."""
    return closed.filter(F.col("ancestor") == clade).select("taxid")


def _paths(nodes: DataFrame, carried: dict[str, Column], joined: dict[str, Callable[[Column, Column], Column]], sizes: bool = False) -> DataFrame:
    """taxid and what each node carries, joined over its path to the root, in as many rounds as the depth has binary digits.

    Before round n a row holds what lies on the next 2**n steps and where they lead, so one join doubles it; ``sizes`` also
    adds up how many nodes are below each, itself included. Tables have a row a node and are written each round.
    Raises ValueError on a cycle.
    """
    ids = nodes.select(F.col("taxid").alias("up"))
    links = nodes.join(ids, (F.col("parent") == F.col("up")) & (F.col("up") != F.col("taxid")), "left")
    more = {"size": F.lit(1).cast("long")} if sizes else {}
    now = written(links.select("taxid", "up", *[c.alias(n) for n, c in (carried | more).items()]))
    most = now.count().bit_length() + 1
    for _ in range(most):
        if now.filter("up is not null").isEmpty():
            return now.drop("up")
        far = now.select(F.col("taxid").alias("_mid"), F.col("up").alias("_up"), *[F.col(n).alias(f"_{n}") for n in carried])
        t = now.join(far, F.col("up") == F.col("_mid"), "left")
        new = [F.when(F.col("_mid").isNull(), F.col(n)).otherwise(joined[n](F.col(n), F.col(f"_{n}"))).alias(n) for n in carried]
        t = t.select("taxid", F.col("_up").alias("up"), *new, *more)
        if sizes:
            below = now.filter("up is not null").groupBy(F.col("up").alias("taxid")).agg(F.sum("size").alias("_below"))
            t = t.join(below, "taxid", "left").withColumn("size", F.col("size") + F.coalesce("_below", F.lit(0))).drop("_below")
        now = written(t)
    raise ValueError("the parents of the taxonomy form a cycle")


def tree_labels(nodes: DataFrame) -> DataFrame:
    """taxid, parent (null for roots), level, size, first, last: a node's clade are the nodes whose ``first`` lies from its first to its last.

    ``first`` numbers the nodes so that each is followed by those below it, siblings by taxid; ``size`` counts a clade. No table has
    more rows than there are nodes (taxid, parent, one row each). A missing, own or unknown parent makes a root.
    """
    add = lambda a, b: a + b
    known = nodes.select(F.col("taxid").alias("parent"))
    tree = nodes.select("taxid", "parent").join(known, "parent", "left_semi").filter("parent <> taxid")
    tree = nodes.select("taxid").join(tree.select("taxid", "parent"), "taxid", "left")
    sized = _paths(tree, {"level": F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("long")}, {"level": add}, sizes=True)
    beside = Window.partitionBy("parent").orderBy("taxid").rowsBetween(Window.unboundedPreceding, -1)
    placed = written(tree.join(sized, "taxid").withColumn("step", F.coalesce(F.sum("size").over(beside), F.lit(0)) + F.col("parent").isNotNull().cast("long")))
    first = _paths(placed, {"first": F.col("step")}, {"first": add})
    out = placed.join(first, "taxid")
    return out.select("taxid", "parent", "level", "size", "first", (F.col("first") + F.col("size") - 1).alias("last"))


def clade_test(labels: DataFrame, taxids: list[int]) -> Column:
    """Whether ``first`` lies in the clade of any of ``taxids``; unknown ones have none. The driver gets two numbers for each that is asked for."""
    spans = labels.filter(F.col("taxid").isin(taxids)).select("first", "last").collect()
    return reduce(lambda a, b: a | b, [F.col("first").between(r["first"], r["last"]) for r in spans], F.lit(False))


def clade_members(labels: DataFrame, taxids: list[int]) -> DataFrame:
    """taxid of the clades themselves and of everything below them, each once."""
    return labels.filter(clade_test(labels, taxids)).select("taxid")


def lineage_of(nodes: DataFrame, ranks: tuple[str, ...] = ("class", "order", "family")) -> DataFrame:
    """``lineage`` without a closure: the nearest named node of each rank on the way up, the node itself included."""
    wanted = list(dict.fromkeys([*ranks, *(["phylum"] if "class" in ranks else [])]))
    own = {f"r{k}": F.when((F.col("rank") == r) & (F.col("name") != ""), F.col("name")) for k, r in enumerate(wanted)}
    t = _paths(nodes, own, {n: lambda a, b: F.coalesce(a, b) for n in own})
    of = {r: F.col(f"r{k}") for k, r in enumerate(wanted)}
    return t.select("taxid", *[(F.coalesce(of[r], of["phylum"]) if r == "class" else of[r]).alias(f"{r}_name") for r in ranks])


def name_index(nodes: DataFrame) -> DataFrame:
    """Lower-cased names that belong to one taxid only."""
    return nodes.groupBy(F.lower("name").alias("key")).agg(F.min("taxid").alias("taxid"), F.countDistinct("taxid").alias("n")).filter("n = 1").select("key", "taxid")


def lineage(closed: DataFrame, nodes: DataFrame, ranks: tuple[str, ...] = ("class", "order", "family")) -> DataFrame:
    """The name of the nearest ancestor of each wanted rank that has one; a class that is wanted falls back to the phylum."""
    up = closed.join(nodes.select(F.col("taxid").alias("ancestor"), "rank", "name"), "ancestor")
    of = lambda r: F.min(F.when((F.col("rank") == r) & (F.col("name") != ""), F.struct("depth", "name")))["name"]
    near = [(F.coalesce(of(r), of("phylum")) if r == "class" else of(r)).alias(f"{r}_name") for r in ranks]
    return up.groupBy("taxid").agg(*near)


def trigrams(c: Column) -> Column:
    """Different trigrams of the words of a name, each padded by two blanks before and one behind."""
    words = F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: w != "")
    grams = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))
    return F.array_distinct(F.flatten(F.transform(words, grams)))


#: Rows of one set that are written out together.
TOGETHER = 64


def _size_class(n: Column) -> Column:
    """Sizes below 16 are their own class, then eight classes lie between a power of two and the next."""
    steps = F.greatest(F.length(F.bin(n)) - 4, F.lit(0))
    return steps * 8 + F.call_function("shiftright", n, steps)


def _least_size(size_class: int) -> int:
    steps = max(size_class // 8 - 1, 0)
    return (size_class - 8 * steps) << steps


def trigram_matches(left: DataFrame, right: DataFrame, least: float = 0.65) -> DataFrame:
    """left_id, right_id, similarity of pairs of names with set similarity ``least`` or more; identifiers are unique.

    Sets of n and m trigrams that are so similar share ``(n + m) * least / (1 + least)`` at least. So the first trigram that they share, in a common
    order, has so many from it on in both. A set is listed under those of its trigrams for which that holds, once for each class of sizes
    that the other side has and that is near enough, and meets the sets of that class that are listed there. The order is by rarity, which keeps frequent trigrams out
    of the lists. Lists hold the sets themselves, as pairs grow faster than lists: a pair is compared where it meets, if the bits of the two sets don't
    rule it out, and counts under the first trigram it shares only. Names without letters match nothing.
    Names of equal sets are compared once, by the least of their identifiers, and their pairs are written out at the end, ``TOGETHER`` rows of a set at
    a time. No table that grows is broadcast: packed files of sets look far smaller than they are in the driver.
    """
    spark = left.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    met = ["g", "left_class", "right_class"]
    # the trigrams are ASCII, so three characters are one whole number, which sets compare faster than text
    number = lambda g: F.ascii(g) * 16384 + F.ascii(F.substr(g, F.lit(2), F.lit(1))) * 128 + F.ascii(F.substr(g, F.lit(3), F.lit(1)))
    grams = lambda t: t.select("*", F.explode(trigrams(F.col("name"))).alias("g")).withColumn("g", number(F.col("g")))
    named = lambda t: t.filter("name IS NOT NULL").repartition(tasks, "name").groupBy("name")
    # a row for each trigram of 36 letters and digits and the blank, some 50,000 at most
    every = written(grams(named(left.select("name").union(right.select("name"))).agg(F.count("*").alias("rows"))).groupBy("g").agg(F.count("*").alias("df")))

    def sets(t: DataFrame, side: str) -> DataFrame:
        """A row for each name: its set, the identifier that stands for it, whether that is its own, and how many rows it stands for."""
        s = grams(named(t).agg(F.min("id").alias("id"), F.count("*").alias("rows"))).join(F.broadcast(every), "g")
        s = s.groupBy("name", "id", "rows").agg(F.array_sort(F.collect_set(F.struct("df", "g")))["g"].alias(side))
        equal = Window.partitionBy(side)
        s = s.select("name", F.min("id").over(equal).alias(f"{side}_id"), "id", F.sum("rows").over(equal).alias("rows"), side)
        bit = lambda g: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(g), F.lit(64)))
        bits = F.aggregate(side, F.lit(0).cast("long"), lambda all_, g: all_.bitwiseOR(bit(g)))
        return written(s.select("name", f"{side}_id", (F.col("id") == F.col(f"{side}_id")).alias("own"), "rows", side, bits.alias(f"{side}_bits"), _size_class(F.size(side)).alias(f"{side}_class")))

    def lists(s: DataFrame, side: str, other: str, classes: list[int]) -> DataFrame:
        n = F.size(side)
        spans = F.array(*[F.struct(F.lit(c).alias("class"), F.lit(_least_size(c)).alias("first"), F.lit(_least_size(c + 1)).alias("end")) for c in classes])
        near = F.explode(F.filter(spans, lambda x: (x["end"] > n * least - 1e-9) & (x["first"] <= n / least + 1e-9)))
        s = s.filter("own").select(f"{side}_id", side, f"{side}_bits", f"{side}_class", near.alias("near"))
        wanted = F.ceil((n + F.greatest(F.col("near.first"), n * least)) * (least / (1 + least)) - 1e-9).cast("int")
        s = s.select(f"{side}_id", side, f"{side}_bits", f"{side}_class", F.col("near.class").alias(f"{other}_class"), F.explode(F.slice(side, F.lit(1), F.greatest(n - wanted + 1, F.lit(0)))).alias("g"))
        return s.repartition(tasks, *met)  # a number of its own: lists are short beside the pairs that come of them

    def rows(t: DataFrame, s: DataFrame, side: str) -> DataFrame:
        part = F.pmod(F.xxhash64("id"), F.ceil(F.col("rows") / TOGETHER))
        t = t.join(s.select("name", f"{side}_id", "rows").hint("merge"), "name").repartition(tasks, f"{side}_id").groupBy(f"{side}_id", part.alias("part"))
        return t.agg(F.collect_list(F.struct("id")).alias(side)).drop("part").hint("merge")

    a, b = sets(left, "left"), sets(right, "right")
    # a hundred classes or so at most, as there are some 50,000 trigrams
    has = a.select(F.lit(0).alias("side"), F.col("left_class").alias("c")).union(b.select(F.lit(1), "right_class")).distinct().collect()
    of_left, of_right = ([r["c"] for r in has if r["side"] == k] or [0] for k in (0, 1))
    pairs = lists(a, "left", "right", of_right).join(lists(b, "right", "left", of_left).hint("merge"), met)
    both = F.size("left") + F.size("right")
    differ = F.bit_count(F.col("left_bits").bitwiseXOR(F.col("right_bits")))  # a bit that one set has alone stands for a trigram that it has alone
    pairs = pairs.filter((both - differ) / 2 >= both * (least / (1 + least)) - 1e-9)
    # exploded, so that it is made once and not in each place that uses it
    pairs = pairs.select("left_id", "right_id", "g", both.alias("both"), F.explode(F.array(F.array_intersect("left", "right"))).alias("common"))
    n = F.size("common")
    pairs = pairs.filter(F.get("common", F.lit(0)) == F.col("g")).select("left_id", "right_id", (n / (F.col("both") - n)).alias("similarity")).filter(F.col("similarity") >= least)
    pairs = pairs.join(rows(left, a, "left"), "left_id").join(rows(right, b, "right"), "right_id")
    pairs = pairs.select(F.explode("left").alias("left"), "right", "similarity").select("left", F.explode("right").alias("right"), "similarity")
    return pairs.select(F.col("left.id").alias("left_id"), F.col("right.id").alias("right_id"), "similarity")


#: Qualifiers that name no species.
OPEN_NOMENCLATURE = ("sp", "sp.", "spp", "spp.", "cf", "cf.", "aff", "aff.", "nr", "nr.")


def candidates(name: Column) -> Column:
    """Forms of a name to look up, the binomial (where the second word is one) before the genus; empty without words."""
    words = F.filter(F.split(F.trim(name), r"\s+"), lambda w: w != "")
    first, second = F.get(words, F.lit(0)), F.get(words, F.lit(1))
    both = F.when(second.rlike(r"^\p{L}+$") & ~F.lower(second).isin(*OPEN_NOMENCLATURE), F.concat_ws(" ", first, second))
    return F.array_compact(F.array(both, first))


def lineage_for_name(names: DataFrame, index: DataFrame, lineages: DataFrame) -> DataFrame:
    """id, matched_name, taxid and the lineage of the first candidate of ``name`` that is unambiguous and has any; else no row."""
    ranks = [c for c in lineages.columns if c != "taxid"]
    forms = names.select("id", F.posexplode(candidates(F.col("name"))).alias("pos", "matched_name")).withColumn("key", F.lower("matched_name"))
    hit = forms.join(index, "key").join(lineages.filter(F.coalesce(*ranks).isNotNull()), "taxid")
    best = hit.groupBy("id").agg(F.min(F.struct("pos", "matched_name", "taxid", *ranks)).alias("b"))
    return best.select("id", "b.matched_name", "b.taxid", *[f"b.{r}" for r in ranks])


#: Tiers of a curated match in order of trust.
TIERS = ("species_exact", "synonym_exact", "genus_exact", "family_exact", "order_exact", "family_fuzzy", "order_fuzzy")


def curated_match(names: DataFrame, curated: DataFrame, least: float = 0.65) -> DataFrame:
    """id, taxid, class, species, match_level of the best curated row of each name (id, raw, clean, genus); else no row.

    The order is tier, similarity, taxid (null last), species. ``curated`` (taxid, class, species, synonym, genus,
    family, order_name) is first reduced to its best row for each tier and key, so a frequent family joins one row; the
    fuzzy tiers compare with the different family and order names only.
    """
    def keyed(tier: int, key: Column) -> DataFrame:
        row = F.struct(F.col("taxid").isNull().alias("none"), "taxid", "species", "class")
        t = curated.select(F.lit(tier).alias("tier"), key.alias("key"), row.alias("row")).filter("key is not null and key <> ''")
        return t.groupBy("tier", "key").agg(F.min("row").alias("row"))

    synonyms = F.explode(F.transform(F.split("synonym", ","), lambda s: F.lower(F.trim(s))))
    exact = keyed(1, F.lower("species")).unionByName(keyed(2, synonyms)).unionByName(keyed(3, F.lower("genus"))).unionByName(keyed(4, F.lower("family"))).unionByName(keyed(5, F.lower("order_name")))
    both = F.array_distinct(F.array_compact(F.array(F.lower("raw"), F.lower("clean"))))
    asked = names.select("id", F.explode(both).alias("key")).crossJoin(F.broadcast(names.sparkSession.createDataFrame([(1,), (2,), (4,), (5,)], "tier int")))
    asked = asked.unionByName(names.select("id", F.lower("genus").alias("key"), F.lit(3).alias("tier")))
    found = asked.join(exact, ["tier", "key"]).select("id", "tier", F.lit(-1.0).alias("order"), "row")
    words = names.select("clean").filter("clean is not null").distinct()
    for tier, c in ((6, "family"), (7, "order_name")):
        rows = keyed(tier, F.col(c))
        near = trigram_matches(words.select(F.col("clean").alias("id"), F.col("clean").alias("name")), rows.select(F.col("key").alias("id"), F.col("key").alias("name")), least)
        near = near.join(rows.select(F.col("key").alias("right_id"), "row"), "right_id")
        near = near.groupBy("left_id").agg(F.min(F.struct((-F.col("similarity")).alias("order"), "row")).alias("b"))
        found = found.unionByName(names.join(near, F.col("clean") == F.col("left_id")).select("id", F.lit(tier).alias("tier"), "b.order", "b.row"))
    best = found.groupBy("id").agg(F.min(F.struct("tier", "order", "row")).alias("b"))
    level = F.element_at(F.array(*[F.lit(t) for t in TIERS]), F.col("b.tier"))
    return best.select("id", "b.row.taxid", "b.row.class", "b.row.species", level.alias("match_level"))
