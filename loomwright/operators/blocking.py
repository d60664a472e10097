"""Blocking: schemes give keys, blocks stay a membership table (tag, key, side, id) and are never materialised as lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ranges import fresh, running, small
from ..session import durable

UNDEFINED = "undefined"


def simple(name: Column, n: int = 5) -> Column:
    bare = F.regexp_replace(name, "^The ", "")
    return F.array(F.lower(F.substring(bare, 1, n)))


def last_letters(name: Column, n: int = 5) -> Column:
    return F.array(F.lower(F.right(name, F.lit(n))))


def listed(*values: Column) -> Column:
    return F.filter(F.array(*values), lambda x: x.isNotNull())


def mapped(values: Column, f: Callable[[Column], Column]) -> Column:
    """``undefined`` if there are no values."""
    return F.when(F.size(values) > 0, F.array_distinct(F.transform(values, f))).otherwise(F.array(F.lit(UNDEFINED)))


def geo_grid(lat: Column, lon: Column, digits: int = 1) -> Column:
    """The four corners around a coordinate at 10**-digits degrees."""
    k = 10**digits
    a, b = F.floor(lat * k), F.floor(lon * k)
    return F.array(*[F.concat_ws(";", ((a + i) / k).cast("string"), ((b + j) / k).cast("string")) for i in (0, 1) for j in (0, 1)])


def hashed(id_: Column, n: int = 1000) -> Column:
    return F.array(F.pmod(F.xxhash64(id_), F.lit(n)).cast("string"))


def assign(df: DataFrame, id_col: str, side: str, schemes: dict[str, Column]) -> DataFrame:
    """(tag, key, side, id), one row for each different key."""
    entries = F.array(*[F.struct(F.lit(tag).alias("tag"), F.array_distinct(keys).alias("keys")) for tag, keys in schemes.items()])
    rows = df.select(F.col(id_col).alias("id"), F.explode(entries).alias("e")).select("id", "e.tag", F.explode("e.keys").alias("key"))
    return rows.select("tag", F.coalesce("key", F.lit(UNDEFINED)).alias("key"), F.lit(side).alias("side"), "id")


SCHEMES: dict[str, Callable[..., Column]] = {}


def scheme(name: str) -> Callable[..., Column]:
    """A registered scheme; an unknown one raises."""
    if name not in SCHEMES:
        raise ValueError(f"no scheme {name!r}; there are {', '.join(SCHEMES)}")
    return SCHEMES[name]


SCHEMES |= {"simple": simple, "last": last_letters, "list": listed, "mapped": mapped, "geo": geo_grid, "random": hashed}


def merge_prefixes(members: DataFrame, n: int = 5) -> DataFrame:
    """Keys of n letters also get the members of shorter keys that are their prefixes; short keys stay, and so does every other
    key."""
    short = members.where(F.length("key") < n)
    full = members.where(F.length("key") == n).select("tag", F.col("key").alias("full")).distinct()
    cut = full.select("tag", "full", F.explode(F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda i: F.substring("full", F.lit(1), i))).alias("key"))
    return members.unionByName(short.join(cut, ["tag", "key"]).select("tag", F.col("full").alias("key"), "side", "id")).distinct()


def sizes(members: DataFrame, drop_undefined: bool = True, least: int = 0) -> DataFrame:
    """(tag, key, subjects, staged, comparisons)."""
    by = members.groupBy("tag", "key").agg(F.count_if(F.col("side") == "subject").alias("subjects"), F.count_if(F.col("side") == "staging").alias("staged")).withColumn("comparisons", F.col("subjects") * F.col("staged"))
    by = by.where(F.col("key") != UNDEFINED) if drop_undefined else by
    return by.where((F.col("comparisons") >= least) & (F.col("comparisons") > 0))


def scheme_totals(block_sizes: DataFrame) -> DataFrame:
    """(tag, blocks, comparisons) of each scheme and of all."""
    return block_sizes.rollup("tag").agg(F.count(F.lit(1)).alias("blocks"), F.sum("comparisons").alias("comparisons")).withColumn("tag", F.coalesce("tag", F.lit("combined")))


def _chunked(members: DataFrame, most: int, drop_undefined: bool = False, least: int = 0) -> DataFrame:
    """Members of blocks with both sides, with how many subjects (``a``) and staged members (``b``) a part takes: as near to equal as the
    smaller side allows, with a * b <= most; and into how many ``rows`` and ``cols`` that cuts the block."""
    by = sizes(members, drop_undefined, least)
    root = F.greatest(F.lit(1), F.floor(F.sqrt(F.lit(float(most))))).cast("long")
    fit = lambda mine, other: F.least(F.col(mine), F.greatest(F.floor(F.lit(most) / F.greatest(F.lit(1), F.least(F.col(other), root))).cast("long"), F.lit(1)))
    by = by.withColumn("a", fit("subjects", "staged")).withColumn("b", F.greatest(F.lit(1), F.least(F.col("staged"), F.floor(F.lit(most) / F.col("a")).cast("long"))))
    by = by.select("tag", "key", "a", "b", F.ceil(F.col("subjects") / F.col("a")).alias("rows"), F.ceil(F.col("staged") / F.col("b")).alias("cols"))
    return members.join(by, ["tag", "key"])


def _dealt(members: DataFrame, most: int) -> DataFrame:
    """Members with ``mine``: the chunk of their side to which the order of their ids deals them."""
    m = running(_chunked(members, most), ["tag", "key", "side"], ["id"], F.lit(1), "place")
    return m.withColumn("mine", F.floor(F.col("place") / F.when(F.col("side") == "subject", F.col("a")).otherwise(F.col("b"))).cast("long"))


def split(members: DataFrame, most: int) -> DataFrame:
    """(tag, key, part, side, id): parts of at most ``most`` comparisons.  Both sides of a block are dealt to chunks in the order of their ids, and each
    pair of chunks is a part, so that every comparison is in just one."""
    subject = F.col("side") == "subject"
    other = F.sequence(F.lit(0).cast("long"), F.when(subject, F.col("cols")).otherwise(F.col("rows")) - 1)
    m = _dealt(members, most).withColumn("other", F.explode(other))
    part = F.when(subject, F.col("mine") * F.col("cols") + F.col("other")).otherwise(F.col("other") * F.col("cols") + F.col("mine"))
    return m.select("tag", "key", part.alias("part"), "side", "id")


def part_sizes(members: DataFrame, most: int) -> DataFrame:
    """(tag, key, subject, staging, parts): how many of ``split``'s parts have how many members of either side, counted by chunks, as there are far
    fewer of them than of parts."""
    chunks = _dealt(members, most).groupBy("tag", "key", "side", "mine").agg(F.count(F.lit(1)).alias("n"))
    by = chunks.groupBy("tag", "key", "side", "n").agg(F.count(F.lit(1)).alias("k"))
    s, t = (by.where(F.col("side") == x).select("tag", "key", F.col("n").alias(x), F.col("k").alias(f"{x}_k")) for x in ("subject", "staging"))
    return s.join(t, ["tag", "key"]).select("tag", "key", "subject", "staging", (F.col("subject_k") * F.col("staging_k")).alias("parts"))


def with_blocks(df: DataFrame, schemes: dict[str, Column]) -> DataFrame:
    """``df`` with ``blocks``: an array of the (tag, key) of its schemes in their order, defined ones only."""
    def tagged(tag: str, keys: Column) -> Column:
        return F.transform(F.array_distinct(keys), lambda k: F.struct(F.lit(tag).alias("tag"), k.alias("key")))

    lists = [tagged(tag, keys) for tag, keys in schemes.items()]
    return df.withColumn("blocks", F.filter(F.concat(*lists), lambda b: b["key"].isNotNull() & (b["key"] != UNDEFINED)))


def group_pairs(left: DataFrame, right: DataFrame, by: list[str], most: int = 1 << 20) -> DataFrame:
    """The inner join of ``by``, in as many tasks as its pairs need, however few bytes the sides have.  Groups of more than ``most`` pairs are dealt by
    a hash of the rows to parts of about that many: the left's to rows and the right's to columns of parts."""
    size, row, col = (fresh(left, x) for x in ("pairs_of_group", "row_of_part", "col_of_part"))
    count = lambda df, name: df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
    groups = durable(count(left, row).join(count(right, col), by).withColumn(size, F.col(row).cast("double") * F.col(col)))
    total = groups.agg(F.sum(size)).first()[0] or 0
    root = F.lit(max(1, int(most**0.5)))
    large = groups.where(F.col(size) > most).select(*by, F.ceil(F.col(row) / root).cast("int").alias(f"{row}s"), F.ceil(F.col(col) / root).cast("int").alias(f"{col}s"))

    def dealt(df: DataFrame, mine: str, other: str) -> DataFrame:
        d = df.join(small(large), by, "left").withColumn(mine, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind]), F.coalesce(f"{mine}s", F.lit(1))).cast("int"))
        return d.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(f"{other}s", F.lit(1)) - 1))).drop(f"{row}s", f"{col}s")

    # a number of partitions that is asked for isn't lowered again where the rows are few
    sc, key = left.sparkSession.sparkContext, [*by, row, col]
    n = min(1 << 13, max(sc.defaultParallelism, int(total / (4 * most)) + 1))
    sides = [x.repartition(n, *key) for x in (dealt(left, row, col), dealt(right, col, row))] if total > most else [dealt(left, row, col), dealt(right, col, row)]
    return sides[0].join(sides[1], key).drop(row, col)


def block_pairs(subjects: DataFrame, staging: DataFrame, schemes: tuple[dict[str, Column], dict[str, Column]], most: int = 1 << 20) -> DataFrame:
    """Pairs that share a block, each once, in the first block that both have: the columns of both sides as s_* and t_*, with ``blocks`` in
    s_blocks and t_blocks.  Attributes travel with the block key, so that pairs needn't be looked up, and no pair is shuffled."""
    return paired(with_blocks(subjects, schemes[0]), with_blocks(staging, schemes[1]), most)


def paired(subjects: DataFrame, staging: DataFrame, most: int = 1 << 20) -> DataFrame:
    """The same for sides that have ``blocks``."""
    left = subjects.select("*", F.posexplode("blocks").alias("i", "b")).select("b", F.slice("blocks", F.lit(1), F.col("i")).alias("earlier"), *[F.col(c).alias(f"s_{c}") for c in subjects.columns])
    right = staging.select("*", F.explode("blocks").alias("b")).select("b", *[F.col(c).alias(f"t_{c}") for c in staging.columns])
    return group_pairs(left, right, ["b"], most).where(~F.arrays_overlap("earlier", "t_blocks")).drop("b", "earlier")


def pairs(members: DataFrame, kept: DataFrame) -> DataFrame:
    """Different (subject, staging) pairs that share a kept block."""
    m = members.join(kept.select("tag", "key"), ["tag", "key"])
    s = m.where("side = 'subject'").select("tag", "key", F.col("id").alias("subject"))
    t = m.where("side = 'staging'").select("tag", "key", F.col("id").alias("staging"))
    return s.join(t, ["tag", "key"]).select("subject", "staging").distinct()


def statistics(block_sizes: DataFrame, found: DataFrame, gold: DataFrame) -> DataFrame:
    """(tag, blocks, comparisons, found, gold, completeness, precision) of each scheme and of all; ``found`` has (tag, subject, staging), the pairs
    that each scheme puts in one block, ``gold`` (subject, staging), and ``n`` where a row stands for so many pairs.  Precision is found gold pairs over
    comparisons, 0 without any."""
    g = gold.select("subject", "staging", F.col("n") if "n" in gold.columns else F.lit(1).cast("long").alias("n")).distinct()
    hits = found.select("tag", "subject", "staging").distinct().join(g, ["subject", "staging"])
    once = hits.select("subject", "staging", "n").distinct()
    both = hits.groupBy("tag").agg(F.sum("n").alias("found")).unionByName(once.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("found")).withColumn("tag", F.lit("combined")))
    out = scheme_totals(block_sizes).join(both, "tag", "left").crossJoin(F.broadcast(g.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("gold"))))  # one row
    n = F.coalesce("found", F.lit(0))
    return out.select("tag", "blocks", "comparisons", n.alias("found"), "gold", F.when(F.col("gold") > 0, F.round(n / F.col("gold"), 6)).otherwise(0.0).alias("completeness"), F.when(F.col("comparisons") > 0, F.round(n / F.col("comparisons"), 6)).otherwise(0.0).alias("precision"))


def evaluation_record(stats: DataFrame, job: str, comment: str) -> DataFrame:
    """One row (job, comment, blocks): the different statistics of the schemes, sorted."""
    cols = [c for c in stats.columns if c != "tag"]
    return stats.agg(F.array_sort(F.collect_set(F.struct("tag", *cols))).alias("blocks")).select(F.lit(job).alias("job"), F.lit(comment).alias("comment"), "blocks")


def pairs_completeness(found: DataFrame, gold: DataFrame) -> DataFrame:
    """One row (found, gold, completeness); a row of ``gold`` with ``n`` stands for that many pairs."""
    one = F.col("n") if "n" in gold.columns else F.lit(1)
    n = gold.join(found.withColumn("hit", F.lit(1)), ["subject", "staging"], "left").agg(F.coalesce(F.sum(F.when(F.col("hit").isNotNull(), one)), F.lit(0)).cast("long").alias("found"), F.coalesce(F.sum(one), F.lit(0)).cast("long").alias("gold"))
    return n.withColumn("completeness", F.when(F.col("gold") > 0, F.col("found") / F.col("gold")).otherwise(0.0))
